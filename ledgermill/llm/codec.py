"""BPE encoding and decoding of whole texts by speculation and verification.

Texts are never shuffled: each task splits its own into words, encodes words it
has not met in vectorised batches (see ``bpe.Codec``) and joins the codes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.bpe import Codec
from ledgermill.llm.common import ship, slices, utf8

# Characters whose words are looked up together.
TOGETHER = 1_000_000

ENCODED = "id bigint, ids array<int>, n_tokens bigint"


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker process; the file must be at this path on every executor."""
    return Codec(path)


def _in_groups(batches, weight) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for rows in slices(batches):
        for i, t in zip(rows["id"], rows["text"], strict=True):
            ids.append(i)
            texts.append(utf8(t))
            held += len(texts[-1])
            if held >= weight:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _lists(codes: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in codes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), "<i4")))


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, n_tokens) of every row.

    No special tokens are added; special strings inside a text become their
    tokens. A null text is empty and has no tokens, a null key stays null, every
    repeated row is returned, other columns of ``df`` are not.
    """
    def run(batches):
        c = codec(path)
        for ids, texts in _in_groups(batches, TOGETHER):
            codes = c.encode(texts)
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(ids, pa.int64()), "ids": _lists(codes),
                 "n_tokens": pa.array([len(x) // 4 for x in codes], pa.int64())})

    return _rows(df, key, text).mapInArrow(run, ENCODED)


def decode(df: DataFrame, path: str) -> DataFrame:
    """(id, text) of rows (id, ids); null ids give an empty text."""
    def run(batches):
        c = codec(path)
        for rows in slices(batches):
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(rows["id"], pa.int64()),
                 "text": pa.array([c.decode(np.array(x or [], "<u4").tobytes()) for x in rows["ids"]], pa.string())})

    ship(df.sparkSession)
    return df.select("id", "ids").mapInArrow(run, "id bigint, text string")


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, same): encode, then decode the ids, in one pass.

    same: whether decoding gave the text back.
    """
    def run(batches):
        c = codec(path)
        for ids, texts in _in_groups(batches, TOGETHER):
            codes = c.encode(texts)
            back = [c.decode(x) for x in codes]
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(ids, pa.int64()), "n_tokens": pa.array([len(x) // 4 for x in codes], pa.int64()),
                 "ids_sha256": pa.array(map(sha, codes), pa.string()),
                 "decoded_sha256": pa.array([sha(t.encode()) for t in back], pa.string()),
                 "same": pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_())})

    return _rows(df, key, text).mapInArrow(
        run, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, same boolean")


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    ship(df.sparkSession)
    return df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
