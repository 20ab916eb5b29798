"""Spelling variants by permuterm rotations.

A word with a terminator is rotated to every place. The rotation that ends in a
character, without it, is a prefix which every word shares that differs in just
that character, and which is a whole rotation of the word that lacks it. So
replacements, insertions and deletions are all found in groups of equal prefixes:
a group holds at most one word that lacks the character, and one word for each
character there is. It is scanned once, and each member gets the number of its
neighbours there and the best of them; pairs are never made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship, slices
from ledgermill.session import stage

# Runs that count as words.
RUNS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form is at least this many times as frequent.
RATIO = 2
# Rotations of longer words are digests, for as text they take the square of the length.
LONGEST_SPELT = 48
# Primes below 2**31 and the bases of the four digests of a rotation.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1299709, 65793313, 7368787)
# Rotations of long words that leave a task at a time.
ROWS = 4096


def runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, run): every maximal run of letters, A to Z in lower case; a null text has none."""
    return df.select(F.col(key).alias("id"), F.expr(
        f"explode(regexp_extract_all(translate(CAST({text} AS STRING), '{UPPER}', '{LOWER}'), '{RUNS}', 0)) AS run"))


def misspelt(found: DataFrame, share: int) -> DataFrame:
    """Runs of which one in ``share``, by a checksum of id and run, lost a code point; a null id counts as empty."""
    h = "crc32(CAST(concat(coalesce(CAST(id AS STRING), ''), ':', run) AS BINARY))"
    at = f"CAST({h} % char_length(run) AS INT)"
    return found.selectExpr("id", f"IF({h} % {share} = 0, concat(substr(run, 1, {at}), substr(run, {at} + 2)), run) AS run")


def words(found: DataFrame) -> DataFrame:
    """(word, n) of the runs that are long and frequent enough."""
    return found.where(f"char_length(run) >= {LEAST_LENGTH}").groupBy(F.col("run").alias("word")).agg(
        F.count(F.lit(1)).alias("n")).where(f"n >= {LEAST_COUNT}")


# A rotation and its word's number and count. lacks: nothing is skipped, so the word lacks the
# character. first: what is skipped is the first of a run of equal characters; skipping any of
# them gives the same word, and so a deletion is found once.
ROTATION = "rotation string, num bigint, n bigint, lacks boolean, first boolean"


def _spelt(numbered: DataFrame) -> DataFrame:
    """Rotations as text; the terminator is a line end, which no word has."""
    skipped = f"""IF(char_length(word) > {LONGEST_SPELT + 1}, array(), transform(sequence(1, char_length(word)), i -> struct(
        concat(substr(word, i + 1), '\n', substr(word, 1, i - 1)) AS rotation, false AS lacks,
        i = 1 OR substr(word, i, 1) <> substr(word, i - 1, 1) AS first)))"""
    whole = f"""IF(char_length(word) > {LONGEST_SPELT}, array(), transform(sequence(1, char_length(word) + 1), i -> struct(
        concat(substr(word, i), '\n', substr(word, 1, i - 1)) AS rotation, true AS lacks, true AS first)))"""
    return numbered.where(f"char_length(word) <= {LONGEST_SPELT + 1}").selectExpr(
        "num", "n", f"explode(concat({skipped}, {whole})) AS r").selectExpr("r.rotation", "num", "n", "r.lacks", "r.first")


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out, step = np.ones(1, np.uint64), base
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(step) % np.uint64(prime)))
        step = step * step % prime
    return out[:n]


def rotation_digests(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the rotations with each character skipped, and of the whole rotations, one a line.

    A rotation is told by its place and by the word without what is skipped, so the
    digest is the place, that word's length, and that word as a polynomial modulo four
    primes (124 bits). All come from running sums over the word.
    """
    x = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
    n, zero = len(x), np.zeros(1, np.uint64)
    skipped = [np.arange(n), np.full(n, n - 1)]
    whole = [np.arange(n + 1), np.full(n + 1, n)]
    for prime, base in zip(PRIMES, BASES, strict=True):
        w, p = _powers(base, prime, n), np.uint64(prime)
        before = np.concatenate((zero, np.cumsum(x * w % p))) % p
        # Behind the skipped character the others move up by one place.
        moved = np.concatenate((zero, zero, np.cumsum(x[1:] * w[:-1] % p))) % p
        skipped.append((before[:-1] + moved[-1] + p - moved[1:]) % p)
        whole.append(np.full(n + 1, before[-1]))
    return tuple(np.stack([a.astype("<u8") for a in parts], 1) for parts in (skipped, whole))


def _digested(batches) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, 16):
        for word, num, n in zip(rows["word"], rows["num"], rows["n"], strict=True):
            skipped, whole = rotation_digests(word)
            first = np.array([i == 0 or word[i] != word[i - 1] for i in range(len(word))])
            parts = [(whole, np.ones(len(whole), bool), True)]
            if len(word) > LONGEST_SPELT + 1:
                parts.append((skipped, first, False))
            for digests, firsts, lacks in parts:
                for at in range(0, len(digests), ROWS):
                    held = digests[at:at + ROWS]
                    yield pa.RecordBatch.from_pydict({
                        "rotation": pa.array([d.tobytes().hex() for d in held]),
                        "num": pa.array(np.full(len(held), num)), "n": pa.array(np.full(len(held), n)),
                        "lacks": pa.array(np.full(len(held), lacks)), "first": pa.array(firsts[at:at + ROWS])})


def rotations(numbered: DataFrame) -> DataFrame:
    """All rotations of (num, word, n): as text or, of long words, as digests. Which one, the length
    without the skipped character says, so that words that can meet have the same."""
    long = numbered.where(f"char_length(word) > {LONGEST_SPELT}").select("num", "word", "n")
    return _spelt(numbered).unionByName(long.mapInArrow(_digested, ROTATION))


def neighbours(numbered: DataFrame) -> DataFrame:
    """(num, n_near, best_n, best): how many near words a word has, and the best of them.

    The best has the largest n, then the smallest number. Words without near words
    have no row. A group of one rotation has at most one word that lacks the character
    and one for each character, so the arrays have a fixed bound.
    """
    groups = rotations(numbered).groupBy("rotation").agg(
        F.sort_array(F.collect_list(F.expr("struct(-n AS less, num, lacks, first)"))).alias("g")).where("size(g) > 1")
    near = "filter(g, y -> y.num <> x.num AND IF(x.lacks, y.first, NOT y.lacks OR x.first))"
    members = groups.selectExpr(f"explode(transform(g, x -> struct(x.num, {near} AS near))) AS m").where("size(m.near) > 0")
    return members.selectExpr("m.num", "size(m.near) AS k", "m.near[0].less AS less", "m.near[0].num AS other").groupBy("num").agg(
        F.sum("k").alias("n_near"), F.expr("min(struct(less, other)) AS b")).selectExpr(
        "num", "n_near", "-b.less AS best_n", "b.other AS best")


def roots(forms: DataFrame) -> DataFrame:
    """(num, root) of links (num, form), followed to the last, twice as far in each round.

    A form is RATIO times as frequent as its word, so chains end after a few rounds.
    """
    at = stage(forms.selectExpr("num", "form AS root"), "roots")
    while True:
        on = at.alias("a").join(at.selectExpr("num AS step", "root AS further"), F.expr("root = step"), "left").selectExpr(
            "num", "coalesce(further, root) AS root", "further IS NOT NULL AS moved")
        on = stage(on, "roots")
        at = on.select("num", "root")
        if not on.where("moved").limit(1).count():
            return at


def variants(counted: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n); words are distinct and not null.

    Two words are near if they differ by one inserted, deleted or replaced code point.
    The form of a word is its near word of largest n (ties: smallest in code-point
    order) if that n is at least twice the word's; root is where forms lead in the end,
    the word itself if it has none. Other columns are ignored, an empty table gives no
    rows, words of any length are compared whole.
    """
    ship(counted.sparkSession)
    # Numbers of sorted rows follow the order of the words, and stand for them in ties.
    numbered = stage(counted.select("word", "n").orderBy("word").withColumn("num", F.monotonically_increasing_id()), "words")
    near = stage(neighbours(numbered), "near-words")
    forms = stage(numbered.select("num", "n").join(near, "num").where(f"best_n >= {RATIO} * n").selectExpr(
        "num", "best AS form", "best_n AS form_n"), "forms")
    led = forms.join(roots(forms), "num").join(numbered.selectExpr("num AS form", "word AS form_word"), "form").join(
        numbered.selectExpr("num AS root", "word AS root_word"), "root").select("num", "form_word", "root_word", "form_n")
    return numbered.join(near.select("num", "n_near"), "num", "left").join(led, "num", "left").selectExpr(
        "word", "form_word AS form", "coalesce(root_word, word) AS root", "n", "coalesce(n_near, 0L) AS n_near", "form_n")
