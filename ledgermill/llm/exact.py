"""Exact deduplication as a stateful stream.

Two streaming queries run until what has arrived is used up:

1. The log: every document becomes a narrow row of digest, id, length and
   content locator (file and row), appended to a file sink.
2. The state: a stateful aggregation by digest in RocksDB, on disk and without
   expiry, holds for each digest how many rows it has met and the id, length and
   locator of the row to keep. Rows that repeat a digest are combined before the
   shuffle, so a digest with a third of all rows meets no single task.

A repeated digest is a hit. The full bytes of all hits are then fetched by
locator and compared; digests whose texts differ are grouped anew by text. New
files under the same path are picked up by running the same folders again.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import fresh_folder, stage

# The white space that is deleted before texts are compared.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # A store preallocates 4 MB on disk while it is open; the stream runs to its end, so close each after its task.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: str = "text") -> Column:
    """The text without blanks; null counts as empty."""
    out = F.coalesce(F.col(text).cast("string"), F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _finish(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _located(rows: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias("id"), *more,
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def run_streams(spark: SparkSession, path: str, work: str, key: str = "doc_id", text: str = "text",
                digest=sha256, batch_bytes: int = 64 << 30) -> tuple[DataFrame, DataFrame]:
    """Bring the log and the state in ``work`` up to date with the Parquet at ``path``.

    Returns the log (id, digest, n_chars, file, row) and the state (digest, n, n_chars,
    id, file, row): one row for each digest, naming the row to keep, which is the
    longest in code points, then the one with the smallest id (a null id loses).
    """
    schema = spark.read.parquet(path).schema
    # A pattern, because a stream accepts a single file only by pattern.
    files = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    docs = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(files)
    log = _located(docs, key, text, digest(normalised(text)).alias("digest"),
                   F.coalesce(F.length(F.col(text).cast("string")), F.lit(0)).alias("n_chars"))
    _finish(log.writeStream.format("parquet").option("path", f"{work}/log")
               .option("checkpointLocation", f"{work}/log-progress"))
    rows = spark.readStream.schema(log.schema).option("maxBytesPerTrigger", batch_bytes).parquet(f"{work}/log")
    # ~id descends as id ascends, without overflow.
    held = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("n_chars", F.expr("~id").alias("rest"), "file", "row")).alias("keep"))
    with _set(spark, ROCKSDB):
        _finish(held.writeStream.format("noop").outputMode("update")
                    .option("checkpointLocation", f"{work}/state"))
        state = spark.read.format("statestore").load(f"{work}/state")
        n, keep = (F.col(f"value.`{c}`") for c in state.schema["value"].dataType.names)
        state = stage(state.select(
            F.col("key.digest").alias("digest"), n.alias("n"), keep["n_chars"].alias("n_chars"),
            F.bitwise_not(keep["rest"]).alias("id"), keep["file"].alias("file"), keep["row"].alias("row")),
            "exact-state")
    return spark.read.schema(log.schema).parquet(f"{work}/log"), state


def clashes(spark: SparkSession, path: str, hits: DataFrame, text: str = "text") -> DataFrame:
    """Full bytes of ``hits`` (digest, file, row): the rows whose digest stands for several texts, with text."""
    there = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        normalised(text).alias("text"))
    read = there.join(hits.hint("shuffle_hash"), ["file", "row"])
    # Equal bytes exactly if the smallest and the largest text are equal; combined before the shuffle.
    bad = stage(read.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
                    .where("a <> b").select("digest"), "exact-clashes")
    if bad.isEmpty():
        return spark.createDataFrame([], "file string, row bigint, text string")
    return stage(read.join(bad, "digest", "left_semi").select("file", "row", "text"), "exact-texts")


def dedup(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text", digest=sha256,
          work: str | None = None, batch_bytes: int = 64 << 30) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of every row at ``path``.

    Texts are equal if they are without blanks; a null text is empty. Exactly one
    row of a group is kept, also among repeated rows with the same id. A null id
    stays null. Other columns are not read. An empty table gives no rows.
    ``work``: folder of the log and the state; give it again to go on from there.
    """
    log, state = run_streams(spark, path, work or fresh_folder(spark, "exact"), key, text, digest, batch_bytes)
    kept = state.select("digest", "n", F.col("id").alias("keep_id"), F.col("file").alias("keep_file"),
                        F.col("row").alias("keep_row"))
    rows = log.join(kept, "digest")
    hits = rows.where("n > 1").select("digest", "file", "row")
    apart = clashes(spark, path, hits, text)
    if not apart.isEmpty():  # different texts under one digest: group those rows by text
        odd = log.join(apart, ["file", "row"])
        best = odd.groupBy("digest", "text").agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.struct("n_chars", F.expr("~id").alias("rest"), "file", "row")).alias("keep"))
        best = best.select("digest", "text", "n", F.bitwise_not("keep.rest").alias("keep_id"),
                           F.col("keep.file").alias("keep_file"), F.col("keep.row").alias("keep_row"))
        odd = odd.join(best, ["digest", "text"]).drop("text")
        rows = rows.join(apart, ["file", "row"], "left_anti").unionByName(odd)
    return rows.select("id", "keep_id", F.col("n").alias("group_size"),
                       ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
                       "digest")
