"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Join sides are never hinted: a side is broadcast
# only when its size, estimated or measured at run time, is under the threshold;
# otherwise the join shuffles and AQE splits the skewed partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Rows of a hundred columns generate methods above HotSpot's 8,000-byte limit,
    # which would then run interpreted (measured: 3 to 4 times slower).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # Without these options (a session made elsewhere) such a plan runs operator by operator,
    # in the small methods of its projections; see ``compiled``.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Wide plans have more generated classes than the default cache of 100 holds.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Saves a call-site capture per Column call when plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "ledgermill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compiled(spark: SparkSession) -> SparkSession:
    """The session, told never to generate a method that HotSpot would only interpret.

    For sessions not made by ``build_session``: a JVM option cannot be set once it
    runs, this setting can.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])
    return spark


def literal_rows(spark: SparkSession, rows: list[tuple], columns: list[str],
                 type_name: str = "string") -> DataFrame:
    """A few fixed rows as a local relation, whose exact size the optimizer knows.

    (``createDataFrame`` gives a relation of unknown size, which is never
    chosen for broadcast when the join is planned.)
    """
    if not rows:
        return spark.createDataFrame([], ", ".join(f"{c} {type_name}" for c in columns))
    def text(value):
        if value is None:
            return f"CAST(NULL AS {type_name})"
        return "'" + str(value).replace("'", "''") + "'" if type_name == "string" else str(value)

    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def shared_folder(spark: SparkSession) -> str:
    """Root folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of this machine, because there all tasks run on it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="ledgermill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


# Folders made by the jobs that are open, innermost last.
_OPEN: list[list[str]] = []


def _applications(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, in a folder of this application, that nothing has used before."""
    path = f"{_applications(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


# Codec of staged and stored tables: on the account fact of sf0.1 a quarter less than snappy.
PARQUET = {"compression": "zstd"}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go once it is written.

    By default they stay until the driver collects garbage, so the disk would hold the
    shuffles of all steps of a job at once. Only for writes: each has a plan of its own,
    which nothing runs again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, held) if held is not None else spark.conf.unset(name)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and lets every
    consumer read only the columns it needs.
    """
    path = fresh_folder(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("errorifexists").options(**PARQUET).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


@contextmanager
def staging(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end what was staged inside, also when the job fails.

    Only for jobs that leave nothing unread: what a frame still reads must be staged outside.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield made
    finally:
        _OPEN.remove(made)
        for path in made:
            fs, there = _file_system(spark, path)
            fs.delete(there, True)


@contextmanager
def staged_apart() -> Iterator[None]:
    """What is staged inside outlives the jobs that are open."""
    held, _OPEN[:] = list(_OPEN), []
    try:
        yield
    finally:
        _OPEN[:] = held


def sweep(spark: SparkSession, hours: float = 7 * 24) -> list[str]:
    """Deletes the staged folders of other applications in which nothing was made for so long.

    A job that died cannot delete its own. Choose a time that no running job exceeds
    between two stages. Returns the folders deleted.
    """
    fs, root = _file_system(spark, shared_folder(spark))
    own, gone = _applications(spark).rsplit("/", 1)[1], []
    before = (time.time() - hours * 3600) * 1000
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("staged-") and name != own and status.getModificationTime() < before:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
