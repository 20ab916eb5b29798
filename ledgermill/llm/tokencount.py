"""Token counts by the whole-token shortcut.

Before any text is read, it is proved which strings of the vocabulary encode
alone as one token (``Merges.whole``). A pre-token that is one of them counts as
one; only the others are merged, once for each distinct string a task meets.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.bpe import Recent, byte_alphabet, load, spelled, splitter
from ledgermill.llm.common import ship, slices, utf8

# The pre-tokens of the lower-casing word vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def folded(text: str) -> str:
    """NFC and lower case, character by character (a capital sigma is never final)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Counter:
    """Counts tokens as a file with word ends, lower case and dropped white space gives them."""

    def __init__(self, path: str):
        self.merges, specials = load(path)
        self.split, self.words = splitter(specials), regex.compile(WORDS)
        back, end = {c: b for b, c in enumerate(byte_alphabet())}, self.merges.suffix
        self.whole: dict[str, int] = {}
        for i, ok in enumerate(self.merges.whole()):
            s = self.merges.strings[i]
            if ok and s.endswith(end):
                try:
                    self.whole[bytes(back[c] for c in s[:len(s) - len(end)]).decode("utf-8")] = 1
                except UnicodeDecodeError:
                    pass  # part of a character: no pre-token
        self.known = Recent()
        self.known.update(self.whole)
        self.merged = 0

    def _learn(self, words: list[str]) -> None:
        if len(self.known) > self.known.room:
            self.known.age()
            self.known.update(self.whole)
        for w in self.known.unmet(words):
            self.known[w] = len(self.merges.merge(spelled(w)))
            self.merged += 1

    def count(self, text: str) -> int:
        total, known = 0, self.known
        for k, part in enumerate(self.split.split(text)):
            if k % 2:
                total += 1
                continue
            words = self.words.findall(folded(part))
            try:
                total += sum(map(known.__getitem__, words))
            except KeyError:
                self._learn(words)
                total += sum(map(known.__getitem__, words))
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker process; the file must be at this path on every executor."""
    return Counter(path)


def count_tokens(df: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    A null text is empty: 0 bytes and tokens. A null key stays null, repeated
    rows are all returned, other columns of ``df`` are not.
    """
    def run(batches):
        c = counter(path)
        for rows in slices(batches):
            counts = [c.count(utf8(t)) for t in rows["text"]]
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(rows["id"], pa.int64()),
                 "n_bytes": pa.array([len(t or b"") for t in rows["text"]], pa.int64()),
                 "n_tokens": pa.array(counts, pa.int64()),
                 "over_limit": pa.array([n > limit for n in counts], pa.bool_())})

    ship(df.sparkSession)
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
