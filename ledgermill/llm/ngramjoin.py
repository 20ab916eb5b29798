"""N-gram Jaccard join by token-combination prefixes.

A document is its set of k-word shingles, hashed and ordered by hash. Two sets
that are similar enough differ in few tokens, so a prefix of each, long enough,
must share something. Tokens that few documents have count one each and are
indexed alone. Frequent tokens are too common to index alone: they are dealt into
classes, and only pairs of tokens of one class are indexed. A class with p tokens
in the prefix can lose p - 1 before no pair is left, so it counts p - 1, and
prefixes are extended until the count exceeds what two similar sets may miss.
Documents with many rare tokens, and all that could be similar to them, need no
pairs at all: their prefixes run past the frequent tokens.

Documents with equal sets are one node. Nodes that share an index entry are
candidates: all pairs of a small entry, a star around the smallest node of a
large one. Those that share too few single tokens to reach the threshold are
screened out, the others verified on their whole sets: first one candidate of each
node, then those that lie in different components still, as only these can
change a component. A second round compares what large entries hold of different
components, in blocks, so no link between components is lost. There each set has a
parity sketch: one bit for each of 256 classes of tokens, set if their number is odd.
Bits in which two sketches differ are tokens of one set alone, so pairs that differ in
too many never leave the task.

Sets are of 63-bit hashes. Which tokens are frequent is a bitmap of fixed size; it
only steers the index, so a wrong bit costs time, never a link.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship
from ledgermill.llm.graph import components
from ledgermill.session import stage

# A token in more prefixes than this is frequent.
FREQUENT = 16
# Entries of up to so many nodes give all their pairs.
SMALL = 24
# Members of a large entry that are compared with as many others in one group.
BLOCK = 4096
# log2 of the bits of each broadcast bitmap: 4 MB, whatever the data.
BITS = 25

# The four BIGINTs of a parity sketch.
SKETCH = ["s0", "s1", "s2", "s3"]

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of a published 64-bit generator: every bit depends on every other."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Hashes of the distinct word shingles of a text, ascending."""

    def __init__(self, words: int = 4, seed: int = 0):
        rng = np.random.default_rng((seed, 77))
        self.words = words
        self.byte = rng.integers(0, 2 ** 64, 256, np.uint64, endpoint=False)
        self.base = int(rng.integers(0, 2 ** 61)) * 8 + 5
        self._grow(1 << 14)

    def _grow(self, size: int) -> None:
        def powers(x):
            out = np.full(size, x, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.power, self.inverse = powers(self.base), powers(pow(self.base, -1, 2 ** 64))

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # of bytes: A-Z and the white space of ASCII
        if not words:
            return np.empty(0, np.uint64)
        joined = np.frombuffer(b" ".join(words), np.uint8)
        if len(joined) > len(self.power):
            self._grow(2 * len(joined))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        k = min(self.words, len(words))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.byte[joined] * self.power[:len(joined)])))
        a, b = starts[:len(words) - k + 1], ends[k - 1:]
        return np.unique(_mixed((sums[b] - sums[a]) * self.inverse[a]) >> np.uint64(1))


def may_miss(n, percent: int):
    """How many tokens of a set of n a similar set may lack."""
    return n - -(-n * percent // 100)


def _name(tokens: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _sketch(tokens: np.ndarray) -> np.ndarray:
    odd = np.bincount((tokens & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _texts(batches, rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column("text").to_pylist()


def sets(rows: DataFrame, words: int, percent: int, seed: int) -> DataFrame:
    """(id, body, n, node, check, s0 to s3, low): the size, 128-bit name, parity sketch and lowest tokens of each set."""
    def run(batches):
        shingle = Shingler(words, seed)
        for part, texts in _texts(batches):
            all_ = [shingle(t or b"") for t in texts]
            names = [_name(s) for s in all_]
            low = [s[:(may_miss(len(s), percent) + 1) * 3 // 2 + 2].view(np.int64) for s in all_]
            sketches = np.array([_sketch(s) for s in all_], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_pydict(
                {"id": part.column("id"), "body": part.column("body"), "n": pa.array([len(s) for s in all_], pa.int64()),
                 "node": pa.array([x[0] for x in names], pa.int64()), "check": pa.array([x[1] for x in names], pa.int64()),
                 **{c: pa.array(sketches[:, k]) for k, c in enumerate(SKETCH)},
                 "low": pa.array(low, pa.list_(pa.int64()))})

    return rows.select("id", "body", "text").mapInArrow(
        run, f"id bigint, body bigint, n bigint, node bigint, check bigint, {', '.join(f'{c} bigint' for c in SKETCH)}, low array<bigint>")


def bitmap(df: DataFrame, bucket: Column) -> np.ndarray:
    """Which of 2**BITS buckets occur, as bytes of 8 bits. Its size does not depend on the data."""
    words = (df.select(bucket.alias("b")).groupBy(F.expr("b DIV 64").alias("at"))
               .agg(F.expr("bit_or(shiftleft(1L, CAST(b % 64 AS INT)))").alias("bits")))
    out = np.zeros(2 ** BITS // 64, np.int64)
    got = words.toArrow()
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _in(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bits[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1).astype(bool)


def _token_bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(2 ** BITS - 1)).astype(np.int64)


def _level(n: int, percent: int) -> int:
    """log2 of the number of classes for sets of n tokens: about three frequent tokens in each."""
    return max((may_miss(n, percent) + 1) // 2, 1).bit_length() - 1


def entries(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The index entries of a set: single tokens, and (negative) names of token pairs."""
    n = len(tokens)
    need = may_miss(n, percent) + 1
    none = np.empty(0, np.int64)
    if not frequent[:need].any():
        return tokens[:need].view(np.int64), none
    rare = np.cumsum(~frequent)
    past = int(np.searchsorted(rare, need)) + 1 if rare[-1] >= need else n
    # A similar set lacks at most `need - 1` of these tokens. If it has no more rare ones
    # than it may miss itself, this one has fewer than:
    if rare[-1] >= n * (100 - percent) // percent + need:
        return tokens[:past][~frequent[:past]].view(np.int64), none
    levels = {_level(m, percent) for m in (-(-n * percent // 100), n, n * 100 // percent)}
    pairs = []
    cut = past if rare[-1] >= need else 0
    where = np.flatnonzero(frequent)
    for level in range(min(levels), max(levels) + 1):
        cls = (tokens[where] >> np.uint64(BITS)) % np.uint64(1 << level)
        counts = np.ones(n, np.int64)
        counts[where[np.unique(cls, return_index=True)[1]]] = 0  # the first of a class adds nothing
        end = min(int(np.searchsorted(np.cumsum(counts), need)) + 1, n)
        cut = max(cut, end)
        inside = where < end
        by: dict[int, list[int]] = {}
        for c, t in zip(cls[inside].tolist(), tokens[where[inside]].tolist(), strict=True):
            by.setdefault(c, []).append(t)
        found = [p for group in by.values() for p in combinations(group, 2)]
        if found:
            p = np.array(found, np.uint64)
            pairs.append(_mixed(p[:, 0] * _MIX1 ^ _mixed(p[:, 1] + np.uint64(level))) | np.uint64(1 << 63))
    return (tokens[:cut][~frequent[:cut]].view(np.int64),
            np.concatenate(pairs).view(np.int64) if pairs else none)


def index(rows: DataFrame, frequent: np.ndarray, words: int, percent: int, seed: int) -> DataFrame:
    """(entry, node, n, singles) of every set; a task skips sets it has just met."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        shingle, bits, met = Shingler(words, seed), shared.value, set()
        for _, texts in _texts(batches):
            parts = []
            if len(met) > 200_000:
                met.clear()
            for t in texts:
                tokens = shingle(t or b"")
                node = _name(tokens)[0]
                if len(tokens) < 2 or node in met:  # a set of one token is similar only to its equal
                    continue
                met.add(node)
                single, pair = entries(tokens, _in(bits, _token_bucket(tokens)), percent)
                parts.append((np.concatenate((single, pair)), node, len(tokens), len(single)))
            if parts:
                sizes = [len(p[0]) for p in parts]
                repeat = lambda k: np.repeat(np.array([p[k] for p in parts], np.int64), sizes)
                yield pa.RecordBatch.from_pydict(
                    {"entry": pa.array(np.concatenate([p[0] for p in parts])), "node": pa.array(repeat(1)),
                     "n": pa.array(repeat(2)), "singles": pa.array(repeat(3))})

    return rows.select("text").mapInArrow(run, "entry bigint, node bigint, n bigint, singles bigint")


_PAIR = "a bigint, b bigint, single bigint, na bigint, nb bigint, sa bigint, sb bigint"


def _groups(batches, columns: list[str], limit: int = 1 << 16):
    """Runs of equal first columns in sorted batches, as arrays; runs are cut at ``limit`` rows (then last is False)."""
    held = None
    for batch in batches:
        now = np.stack([batch.column(c).to_numpy() for c in columns])
        now = now if held is None else np.concatenate((held, now), 1)
        cuts = np.flatnonzero(now[0, 1:] != now[0, :-1]) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        yield now[:, :last], True
        held = now[:, last:]
        if held.shape[1] > limit:
            yield held, False
            held = None
    if held is not None:
        yield held, True


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1)) if len(key) else np.empty(0, np.int64)
    return starts, np.diff(np.concatenate((starts, [len(key)])))


def _pairs_of(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.triu_indices(size, 1)
    return (starts[:, None] + i).ravel(), (starts[:, None] + j).ravel()


def _candidates(percent: int):
    """Sorted (entry, node, n, singles) to candidate pairs; large entries also give their members (b is null)."""
    def frame(g, left, right):
        keep = np.minimum(g[2, left], g[2, right]) * 100 >= np.maximum(g[2, left], g[2, right]) * percent
        left, right = left[keep], right[keep]
        single = (g[0, left] >= 0).astype(np.int64)
        cols = [g[1, left], g[1, right], single, g[2, left], g[2, right], g[3, left], g[3, right]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [c.split()[0] for c in _PAIR.split(", ")])

    def members(g):
        n = g.shape[1]
        nothing = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(g[1]), nothing, pa.array(g[0]), pa.array(g[2]), nothing, nothing, nothing],
            [c.split()[0] for c in _PAIR.split(", ")])

    def run(batches):
        leader = None  # of a large entry that came in several pieces
        for g, whole in _groups(batches, ["entry", "node", "n", "singles"]):
            if g.shape[1] == 0:
                continue
            fresh = np.ones(g.shape[1], bool)
            fresh[1:] = (g[0, 1:] != g[0, :-1]) | (g[1, 1:] != g[1, :-1])  # copies of a set
            g = g[:, fresh]
            starts, sizes = _runs(g[0])
            if leader is not None and leader[0, 0] == g[0, 0]:  # goes on
                rest = np.concatenate((leader, g[:, :sizes[0]]), 1)
                yield frame(rest, np.zeros(sizes[0], np.int64), np.arange(1, sizes[0] + 1))
                yield members(g[:, :sizes[0]])
                starts, sizes = starts[1:], sizes[1:]
            leader = None if whole else g[:, :1] if leader is None or leader[0, 0] != g[0, 0] else leader
            for size in np.unique(sizes[(sizes > 1) & (sizes <= (SMALL if whole else 0))]).tolist():
                at = starts[sizes == size]
                for k in range(0, len(at), 20_000):
                    yield frame(g, *_pairs_of(at[k:k + 20_000], size))
            for s, size in zip(starts, sizes, strict=True):
                if size > SMALL or not whole and size:
                    yield frame(g, np.full(size - 1, s), np.arange(s + 1, s + size))
                    yield members(g[:, s:s + size])

    return run


def _across(percent: int):
    """Sorted (entry, part, node, n, sketch) of large entries to pairs of nodes of different parts, a block at a time."""
    def run(batches):
        # A group has two blocks of members, so it is never cut.
        for g, _ in _groups(batches, ["entry", "part", "node", "n", *SKETCH], 1 << 62):
            starts, sizes = _runs(g[0])
            for s, size in zip(starts, sizes, strict=True):
                part, node, n = g[1:4, s:s + size]
                sketch = g[4:, s:s + size]
                if part[0] == part[-1]:
                    continue
                for at in range(0, size, 256):
                    rows = slice(at, at + 256)
                    fits = (part[rows, None] < part[None, :]) & (
                        np.minimum(n[rows, None], n[None, :]) * 100 >= np.maximum(n[rows, None], n[None, :]) * percent)
                    i, j = np.nonzero(fits)
                    apart = np.zeros(len(i), np.int64)
                    for word in sketch:  # counts bits without their sign
                        apart += np.bitwise_count((word[rows][i] ^ word[j]).view(np.uint64))
                    near = apart * (100 + percent) <= (n[rows][i] + n[j]) * (100 - percent)
                    i, j = i[near], j[near]
                    if len(i):
                        yield pa.RecordBatch.from_pydict({"a": pa.array(node[rows][i]), "b": pa.array(node[j])})

    return run


def _in_blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(entry, part, node, n, sketch) of entries with several parts, large ones as one group for each two blocks of members."""
    mixed = (members.groupBy("entry").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("m"))
                    .where("p <> q").selectExpr("entry", f"(m - 1) DIV {BLOCK} + 1 AS blocks"))
    each = members.join(mixed, "entry").join(classes.select("node", *SKETCH), "node").selectExpr(
        "entry", "part", "node", "n", *SKETCH, "blocks", "pmod(xxhash64(node), blocks) AS own", "explode(sequence(0L, blocks - 1)) AS other")
    # Two groups of one name by chance are compared with each other too.
    return each.selectExpr("IF(blocks = 1, entry, xxhash64(entry, least(own, other), greatest(own, other))) AS entry",
                           "part", "node", "n", *SKETCH)


def whole_sets(rows: DataFrame, pairs: DataFrame, classes: DataFrame, words: int, seed: int) -> DataFrame:
    """(node, tokens) of the nodes in ``pairs``: their texts are read again."""
    both = pairs.select(F.col("a").alias("node")).distinct().union(pairs.select("b").distinct()).distinct()
    nodes = stage(both.join(classes.select("node", "first"), "node"), "ngram-nodes")
    # Ids of the documents to read again, by a bitmap of fixed size; the join by node is exact.
    bucket = F.expr(f"pmod(xxhash64(first), {2 ** BITS})")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(nodes, bucket))

    def run(batches):
        shingle = Shingler(words, seed)
        for batch in batches:
            wanted = np.flatnonzero(_in(shared.value, batch.column("bucket").to_numpy()))
            for at in range(0, len(wanted), 256):
                texts = batch.column("text").take(pa.array(wanted[at:at + 256])).to_pylist()
                tokens = [shingle(t or b"") for t in texts]
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array([_name(s)[0] for s in tokens], pa.int64()),
                     "tokens": pa.array([s.tobytes() for s in tokens], pa.binary())})

    found = (rows.select(F.expr(f"pmod(xxhash64(id), {2 ** BITS})").alias("bucket"), "text")
                 .mapInArrow(run, "node bigint, tokens binary").join(nodes.select("node"), "node", "left_semi"))
    return stage(found.groupBy("node").agg(F.min("tokens").alias("tokens")), "ngram-sets")


def verify(found: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar, written to the shared folder."""
    def similar(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keep = []
                for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(found.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
                   .join(found.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a"))
    return stage(joined.select("a", "b", "x", "y").mapInArrow(similar, "a bigint, b bigint"), "ngram-links")


def connect(found: DataFrame, pairs: DataFrame, percent: int, links: DataFrame | None = None) -> DataFrame:
    """Similar pairs that, with ``links``, join the nodes into the components that all similar pairs would.

    Whole sets are far larger than names, so each node first meets its smallest candidate
    alone; of the other pairs only those between different components are verified.
    """
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = verify(found, first, percent) if links is None else links.unionByName(verify(found, first, percent))
    part = components(links)
    of = lambda c: part.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    rest = (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
                 .where("coalesce(a_part, a) <> coalesce(b_part, b)").select("a", "b"))
    rest = stage(rest.join(first, ["a", "b"], "left_anti"), "ngram-rest")
    return links if rest.isEmpty() else links.unionByName(verify(found, rest, percent))


def link(df: DataFrame, percent: int = 85, words: int = 4, key: str = "doc_id", text: str = "text",
         frequent: int = FREQUENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    Words are what lies between ASCII white space, with A-Z in lower case. A set is the
    distinct shingles of ``words`` words; a shorter text is one shingle; a null or blank
    text has none and links with nothing. Two rows link if 100 times the size of the
    intersection is at least ``percent`` times that of the union. component_id: the
    smallest id reachable. A null id counts in its component and is the smallest only if
    there is no other; repeated rows link like copies; other columns are left aside.
    """
    return _linked(df, percent, words, key, text, frequent).drop("body", "part")


def dedup(df: DataFrame, percent: int = 85, words: int = 4, key: str = "doc_id", text: str = "text",
          frequent: int = FREQUENT) -> DataFrame:
    """``df`` with one row of each component of ``link``: that with the smallest id, a null id last.

    Rows whose texts have no words link with nothing and all stay.
    """
    rows = _linked(df, percent, words, key, text, frequent).where("n_shingles > 0")
    # Rows with equal id and text are one row with a count.
    same = stage(rows.groupBy("part", "id", "body").agg(F.count(F.lit(1)).alias("n")), "ngram-rows")
    best = same.groupBy("part").agg(F.min(F.struct(F.col("id").isNull(), "id", "body")).alias("best"))
    name = lambda t: (F.col(f"{t}.id").alias("_ngram_id"), F.col(f"{t}.body").alias("_ngram_body"))
    both = same.alias("r").join(best.alias("b"), F.expr("r.part = b.part"))
    gone = both.where("NOT (r.id <=> b.best.id AND r.body = b.best.body)").select(*name("r"))
    twice = stage(both.where("r.id <=> b.best.id AND r.body = b.best.body AND r.n > 1").select(*name("r")), "ngram-twice")
    body = F.xxhash64(F.col(text).cast("string"))
    docs = df.withColumn("_ngram_hash", body)
    here = F.expr(f"CAST(`{key}` AS BIGINT) <=> _ngram_id AND _ngram_hash = _ngram_body")
    left = docs.join(gone, here, "left_anti")
    if twice.isEmpty():
        return left.select(*[F.col(f"`{c}`") for c in df.columns])
    single = left.join(twice, here, "left_anti")
    first = left.join(twice, here, "left_semi").dropDuplicates([key, "_ngram_hash"])
    return single.unionByName(first).select(*[F.col(f"`{c}`") for c in df.columns])


def _linked(df: DataFrame, percent: int, words: int, key: str, text: str, frequent: int) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("body"),
                     F.col(text).cast("string").cast("binary").alias("text"))
    seed = 0
    while True:
        every = stage(sets(rows, words, percent, seed), "ngram-sets")
        classes = stage(every.where("n > 0").groupBy("node").agg(
            F.min("id").alias("first"), F.min("check").alias("check"), F.max("check").alias("other"),
            *[F.min(c).alias(c) for c in SKETCH]), "ngram-classes")
        if classes.where("check <> other").isEmpty():
            break
        seed += 1  # two sets share 64 bits of their names: name all anew
    tokens = every.where("n > 1").select(F.explode("low").alias("t")).groupBy("t").count().where(F.col("count") > frequent)
    common = bitmap(tokens, F.expr(f"t & {2 ** BITS - 1}"))
    met = stage(index(rows, common, words, percent, seed).repartition("entry").sortWithinPartitions("entry", "node")
                .mapInArrow(_candidates(percent), _PAIR), "ngram-candidates")
    least = f"CAST(ceil({percent} * (na + nb) / {100 + percent}) AS BIGINT)"
    pairs = (met.where("b IS NOT NULL").groupBy("a", "b")
                .agg(F.sum("single").alias("single"), *[F.max(c).alias(c) for c in ("na", "nb", "sa", "sb")])
                .where(f"single >= least(sa - (na - {least}), sb - (nb - {least}))").select("a", "b"))
    pairs = stage(pairs, "ngram-pairs")
    links = connect(whole_sets(rows, pairs, classes, words, seed), pairs, percent)
    # What large entries hold of different components.
    large = met.where("b IS NULL").selectExpr("a AS node", "single AS entry", "na AS n")
    part = components(links)
    parted = (large.join(part, "node", "left").withColumn("part", F.coalesce("component", "node"))
                   .select("entry", "part", "node", "n"))
    more = stage(_in_blocks(parted, classes).repartition("entry")
                 .sortWithinPartitions("entry", "part").mapInArrow(_across(percent), "a bigint, b bigint")
                 .distinct(), "ngram-pairs")
    if not more.isEmpty():
        links = connect(whole_sets(rows, more, classes, words, seed), more, percent, links)
        part = components(links)
    part = part.withColumnRenamed("component", "part")
    joined = classes.join(part, "node", "left").withColumn("part", F.coalesce("part", "node"))
    first = joined.groupBy("part").agg(F.min("first").alias("component_id"))
    names = joined.join(first, "part").select("node", "part", "component_id")
    full = every.where("n > 0").select("id", "body", "n", "node").join(names, "node")
    out = full.select("id", "body", F.col("n").alias("n_shingles"), "component_id", "part")
    return out.unionByName(every.where("n = 0").select(
        "id", "body", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"),
        F.lit(None).cast("bigint").alias("part")))
