"""Helpers shared by the training-data operators."""

from __future__ import annotations

import shutil
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import ledgermill


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python, once for each application.

    Only the driver reads the archive in its own folder; executors get it from Spark.
    """
    sc, root = spark.sparkContext, Path(ledgermill.__file__).parent
    if not root.is_dir() or getattr(sc, "sent_ledgermill", None):
        return
    sc.sent_ledgermill = shutil.make_archive(f"{sc._temp_dir}/ledgermill", "zip", root.parent, root.name)
    sc.addPyFile(sc.sent_ledgermill)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable, rows: int = 256) -> Iterator[dict[str, list]]:
    """The columns of Arrow batches as Python lists, a few rows at a time.

    Bounds what a task holds as Python objects when texts are very long.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).to_pydict()


def utf8(value: bytes | None) -> str:
    """Text of a binary column: null is empty, malformed bytes become U+FFFD."""
    return "" if value is None else bytes(value).decode("utf-8", "replace")
