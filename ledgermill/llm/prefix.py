"""Byte-level BPE by dynamic programming over byte prefixes.

Ranks alone define the encoding: the adjacent pair whose joined bytes have the
lowest rank is merged first, the left one of equals. Every prefix of a piece has
exactly one last token, and the last token of a longer prefix is the one token
ending there that can stand after the last token of the rest. So one number for
each byte is the whole state: bytes can be appended without touching what is
stored, and after an edit only the numbers from the edit on are found anew, up to
where they agree with the old ones again.

Texts are never shuffled: tasks split their own, and pieces met before are
looked up.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.bpe import Recent
from ledgermill.llm.common import ship, slices, utf8

# Pair checks and pieces that a worker remembers.
REMEMBERED_PAIRS = 1_000_000
NEVER = 1 << 40
# No byte: between pieces that are searched together.
GAP = "\u0100"
# Characters of texts whose pieces are looked up together.
TOGETHER = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def white_space(pattern: str) -> str:
    r"""The pattern with ``\s`` and ``\S`` as Unicode's white space, which excludes U+001C to U+001F."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Ranks:
    """A ranked vocabulary: the parts each token is made of, and which tokens can be neighbours.

    The parts of a merge rank before what it makes, as training leaves them. A token
    that no merge makes stands only where it is a whole piece.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        top = max(ranks.values(), default=-1) + 1
        self.bytes, self.size = [b""] * top, [0] * top
        for t, i in ranks.items():
            self.bytes[i], self.size[i] = t, len(t)
        self.longest = max(map(len, ranks), default=1)
        #: Parts of a token's last merge; a single byte, and a token that merging never makes, has none.
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        #: Pair checks made before.
        self.met: dict[tuple[int, int], bool] = {}
        reached = {i for t, i in ranks.items() if len(t) == 1}
        for token, i in sorted(ranks.items(), key=lambda x: len(x[0])):
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                # Both parts exist in time, and no merge across their boundary comes earlier.
                if a in reached and b in reached and max(a, b) < i and self._stay(a, b, i):
                    self.parts[i], self.made[a, b] = (a, b), i
                    reached.add(i)
                    break
        self.met.clear()
        self.finder = ahocorasick.Automaton()
        for token, i in ranks.items():
            if i in reached:
                self.finder.add_word(token.decode("latin-1"), (i, len(token)))
        self.finder.make_automaton()

    def _stay(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge across the boundary a|b has its turn before ``limit``.

        Goes back in time: undoes whichever of the two was made last and looks up
        the pair that stood there then. Of equal merges the left one comes first.
        """
        parts, made = self.parts, self.made
        while True:
            if made.get((a, b), NEVER) < limit:
                return False
            born_a = a if a in parts else -1
            born_b = b if b in parts else -1
            if born_a > born_b:
                a, limit = parts[a][1], min(limit, born_a)
            elif born_b >= 0:
                b, limit = parts[b][0], min(limit, born_b + 1)
            else:
                return True

    def neighbours(self, a: int, b: int) -> bool:
        """Whether b can follow a in an encoding."""
        pair = (a, b)
        known = self.met.get(pair)
        if known is None:
            if len(self.met) >= REMEMBERED_PAIRS:
                self.met.clear()
            known = self.met[pair] = self._stay(a, b, NEVER)
        return known


class Prefixes:
    """One piece as the last token of each of its prefixes."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", array("i")
        self.append(data)

    def _extend(self, last: array, agree=None) -> None:
        """Adds the last tokens of the prefixes of the data that ``last`` does not have yet.

        With ``agree(n)``, asked after each prefix of length n, stops where it says so.
        """
        met = self.ranks.neighbours
        offset = max(len(last) - self.ranks.longest + 1, 0)  # tokens that end behind ``last`` start here or later
        have = len(last)
        for end, (token, length) in self.ranks.finder.iter(self.data[offset:].decode("latin-1")):
            end += offset + 1
            if end <= have:
                continue  # stored, or found by another match that ends here
            start = end - length
            if not start or met(last[start - 1], token):
                last.append(token)
                have = end
                if agree and agree(end):
                    return

    def append(self, more: bytes) -> None:
        """Adds bytes at the end; the stored numbers stay."""
        self.data += more
        self._extend(self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces bytes start to end; returns how many prefixes were found anew.

        Behind the edit the numbers are taken over from where as many in a row agree
        with the old ones as a token can have bytes: from there on both only look
        back at equal bytes and equal numbers.
        """
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        kept, run = old[:start], 0

        def agree(n: int) -> bool:
            nonlocal run
            run = run + 1 if n - shift > end and kept[n - 1] == old[n - 1 - shift] else 0
            return run >= self.ranks.longest

        self._extend(kept, agree)
        self.last = kept + old[len(kept) - shift:]
        return len(kept) - start

    def ids(self) -> list[int]:
        """The encoding: the stored tokens read from the end."""
        out, at, size = [], len(self.last), self.ranks.size
        while at:
            out.append(self.last[at - 1])
            at -= size[out[-1]]
        return out[::-1]


class Encoder:
    """Encodes and decodes whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.ranks, self.words = Ranks(ranks), regex.compile(white_space(pattern))
        self.decimal = list(map(str, range(len(self.ranks.bytes))))
        self.known = Recent()

    def learn(self, words: list[str]) -> None:
        """Ids of new pieces. A piece that is a token is that token; the matches of the others are found together."""
        whole, rest = self.ranks.ids, []
        for w in words:
            data = w.encode("utf-8")
            alone = whole.get(data)
            if alone is None:
                rest.append((w, data.decode("latin-1")))
            else:
                self.known[w] = (alone,)
        if not rest:
            return
        met, known, size = self.ranks.met.get, self.ranks.neighbours, self.ranks.size
        starts = [0, *accumulate(len(t) + 1 for _, t in rest)]
        k, base, until, last, n = 0, 0, starts[1], [], 0
        for end, (token, length) in self.ranks.finder.iter(GAP.join(t for _, t in rest)):
            while end >= until:
                self._keep(rest[k][0], last, size)
                k, last, n = k + 1, [], 0
                base, until = until, starts[k + 1]
            have = end - base
            if n > have:
                continue  # another match that ends here was the one
            if length > have or (ok := met((last[have - length], token))) or ok is None and known(last[have - length], token):
                last.append(token)
                n += 1
        self._keep(rest[k][0], last, size)

    def _keep(self, word: str, last: list[int], size: list[int]) -> None:
        out, at = [], len(last)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= size[token]
        self.known[word] = tuple(out[::-1])

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        pieces = [self.words.findall(t) for t in texts]
        self.known.age()
        self.learn(self.known.unmet(chain.from_iterable(pieces)))
        ids = self.known.__getitem__
        return [list(chain.from_iterable(map(ids, p))) for p in pieces]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids."""
        return b"".join(map(self.ranks.bytes.__getitem__, ids))


class Edited:
    """A text that stays encoded while it is edited: its pieces, each with its prefixes."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.pieces: list[tuple[int, str, Prefixes | None]] = []
        self.edit(0, 0, text)

    def edit(self, start: int, end: int, new: str) -> int:
        """Replaces characters start to end; returns how many pieces were split and encoded anew.

        A match looks at most two characters past its end, so pieces that end two
        before the edit stay; behind it, pieces stay from the first old boundary met.
        """
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        head = [p for p in self.pieces if p[0] + len(p[1]) + 2 <= start]
        old = self.pieces[len(head):]
        later = {p[0] + shift: k for k, p in enumerate(old) if p[0] >= end}
        before = {p[0]: p for p in old if p[0] < start}  # these are not taken over
        at, fresh, tail = (head[-1][0] + len(head[-1][1]) if head else 0), [], []
        for m in self.encoder.words.finditer(self.text, at):
            if m.start() in later and m.start() >= start + len(new):
                tail = [(p[0] + shift, *p[1:]) for p in old[later[m.start()]:]]
                break
            fresh.append((m.start(), m.group(), self._piece(m.start(), m.group(), before)))
        self.pieces = head + fresh + tail
        return len(fresh)

    def _piece(self, at: int, word: str, before: dict) -> Prefixes | None:
        """Prefixes of a piece, made from those of the old piece at its place; None if it is a token."""
        data = word.encode("utf-8")
        if data in self.encoder.ranks.ids:
            return None
        _, _, held = before.get(at, (0, "", None))
        if held is None:
            return Prefixes(self.encoder.ranks, data)
        same = 0
        for a, b in zip(held.data, data, strict=False):
            if a != b:
                break
            same += 1
        back = 0
        while back < min(len(held.data), len(data)) - same and held.data[-1 - back] == data[-1 - back]:
            back += 1
        held.edit(same, len(held.data) - back, data[same:len(data) - back])
        return held

    def ids(self) -> list[int]:
        known = self.encoder.ranks.ids
        return [i for _, w, p in self.pieces for i in (p.ids() if p else [known[w.encode("utf-8")]])]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process; the file must be at this path on every executor."""
    return Encoder(read_ranks(path), pattern)


def _groups(batches) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, so many that their pieces are worth finding together."""
    ids, texts, held = [], [], 0
    for rows in slices(batches):
        for i, t in zip(rows["id"], rows["text"], strict=True):
            ids.append(i)
            texts.append(utf8(t))
            held += len(texts[-1])
            if held >= TOGETHER:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    ship(df.sparkSession)
    return df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, n_tokens) of every row.

    A null text is empty and has no tokens, a null key stays null, every repeated
    row is returned, other columns of ``df`` are not. An empty table gives no rows.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for ids, texts in _groups(batches):
            codes = e.encode_all(texts)
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(ids, pa.int64()), "ids": pa.array(codes, pa.list_(pa.int32())),
                 "n_tokens": pa.array(list(map(len, codes)), pa.int64())})

    return _rows(df, key, text).mapInArrow(run, "id bigint, ids array<int>, n_tokens bigint")


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, data) of rows (id, ids), the bytes of the ids; null ids give none."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for rows in slices(batches):
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(rows["id"], pa.int64()),
                 "data": pa.array([e.decode(x or []) for x in rows["ids"]], pa.binary())})

    ship(df.sparkSession)
    return df.select(F.col("id").cast("bigint").alias("id"), "ids").mapInArrow(run, "id bigint, data binary")


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, same): encode, then decode the ids, in one pass.

    ids_sha256 is of the decimal ids joined by one space; same: whether decoding gave the bytes back.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        e, sha = encoder(path, pattern), lambda x: hashlib.sha256(x).hexdigest()
        for ids, texts in _groups(batches):
            codes = e.encode_all(texts)
            back = [e.decode(x) for x in codes]
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(ids, pa.int64()), "n_tokens": pa.array(list(map(len, codes)), pa.int64()),
                 "ids_sha256": pa.array([sha(" ".join(map(e.decimal.__getitem__, x)).encode()) for x in codes], pa.string()),
                 "decoded_sha256": pa.array(map(sha, back), pa.string()),
                 "same": pa.array([a == b.encode("utf-8") for a, b in zip(back, texts, strict=True)], pa.bool_())})

    return _rows(df, key, text).mapInArrow(
        run, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, same boolean")
