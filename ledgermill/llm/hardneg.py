"""Hard negatives by slot-decomposed selection.

Every positive of an anchor has a window of scores from which its negatives
come. Windows of one anchor overlap, but each reaches down from its positive's
upper limit, and the limits, in descending order, cut the scores into disjoint
slots. A row falls into one slot, combiners keep the best k of each slot, and
what a window selects is the best k of its slot and all below it, so one merge of
slots from the lowest up answers all windows of the anchor.

Scores are taken block by block: rows and anchors are dealt to cells of (block of
anchors, slice of rows) by generated numbers, so no label and no repeated vector
makes a hot task, and a task holds one block of anchors and a few rows at a time.
Only k rows for each anchor, slot and slice leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.common import ship
from ledgermill.session import stage

POSITIVES = 5
NEGATIVES = 3
# A positive's window, in hundredths of its score.
LOWEST, HIGHEST = 50, 95
# Factor before components are rounded down to integers.
SCALE = 256
# Anchors of a block; rows of a slice at most, and at least if there are fewer slices than tasks.
BLOCK = 8192
SLICE = 65_536
LEAST_SLICE = 1024
# Rows scored at a time.
STEP = 128
# Products of two components and their sums are exact in double precision up to here.
EXACT = 1 << 53
# Components of this size or more would make scores that are no long.
LARGEST = 1 << 18

CELL = "block bigint, slice bigint, num bigint, id bigint, label bigint, vector array<int>, high array<bigint>, low array<bigint>"
FOUND = "anchor bigint, slot int, num bigint, id bigint, score bigint"


def scaled(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(num, id, label, vector) of the rows that take part, with generated row numbers.

    Rows with a null id, label or vector, or a null or non-finite component, do not.
    Nor do those with a component of 2**18 or more, whose scores need not be a long.
    """
    x = "CAST(x AS DOUBLE)"
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
                     F.col(vector).alias("v")).where(
        f"id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL "
        f"AND NOT exists(v, x -> x IS NULL OR isnan({x}) OR abs({x}) >= {LARGEST})")
    return rows.select(F.monotonically_increasing_id().alias("num"), "id", "label",
                       F.expr(f"transform(v, x -> CAST(floor({SCALE}D * {x}) AS INT))").alias("vector"))


class Best:
    """The k highest scores of every column so far, ties by smaller id, then number."""

    def __init__(self, columns: int, k: int):
        self.k = k
        self.least = np.full(columns, np.iinfo(np.int64).min)  # below this a score can no longer be among the k
        self.score, self.id, self.num, self.col = (np.empty(0, np.int64) for _ in range(4))

    def add(self, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, nums: np.ndarray) -> None:
        """Scores of some rows (one a line) against all columns, where they fit."""
        row, col = np.nonzero(fits & (scores >= self.least))
        if not len(row):
            return
        score = np.concatenate((self.score, scores[row, col]))
        ident = np.concatenate((self.id, ids[row]))
        num, col = np.concatenate((self.num, nums[row])), np.concatenate((self.col, col))
        order = np.lexsort((num, ident, -score, col))
        col = col[order]
        new = np.concatenate(([True], col[1:] != col[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(col)), 0))
        place = np.arange(len(col)) - first
        kept = place < self.k
        self.score, self.id, self.num, self.col = score[order][kept], ident[order][kept], num[order][kept], col[kept]
        full = place == self.k - 1
        self.least[col[full]] = score[order][full]


def _products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products, by double precision where it is exact."""
    widest = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(rows.shape[1], 1)
    if widest < EXACT:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows @ anchors.T


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Lists of integers as lines of a matrix; shorter ones end in zeros."""
    sizes = np.asarray(vectors.value_lengths())
    line = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, held = np.zeros((len(sizes), width), np.int64), place < width
    out[line[held], place[held]] = np.asarray(vectors.flatten())[held]
    return out


class _Cell:
    """One block of anchors, and the best rows of one slice for them."""

    def __init__(self, k: int, same: bool):
        self.k, self.same, self.parts, self.best = k, same, [], None

    def anchors(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def _start(self) -> None:
        t = pa.Table.from_batches(self.parts)
        vectors = t["vector"].combine_chunks()
        self.width = max(vectors.value_lengths().to_pylist(), default=0)
        self.vectors = _matrix(vectors, self.width)
        self.num, self.label = t["num"].to_numpy(), t["label"].to_numpy()
        high, low = t["high"].to_pylist(), t["low"].to_pylist()
        slots = 1 if self.same else max(map(len, high))
        self.best = [Best(len(self.num), self.k) for _ in range(slots)]
        if not self.same:
            none = np.iinfo(np.int64).min
            self.high = np.array([[*h, *[none] * (slots - len(h))] for h in high], np.int64)
            self.low = np.array([[*x, *[0] * (slots - len(x))] for x in low], np.int64)

    def score(self, num: np.ndarray, ids: np.ndarray, label: np.ndarray, vectors: pa.ListArray) -> None:
        if not self.parts:
            return
        if self.best is None:
            self._start()
        scores = _products(_matrix(vectors, self.width), self.vectors)
        alike = label[:, None] == self.label[None]
        if self.same:
            self.best[0].add(scores, alike & (num[:, None] != self.num[None]), ids, num)
            return
        for j, best in enumerate(self.best):
            # Slot j: at most its own upper limit, above the next one. A row below the window of j
            # lies below the windows of all higher limits too.
            fits = ~alike & (scores <= self.high[:, j]) & (scores >= self.low[:, j])
            if j + 1 < len(self.best):
                fits &= scores > self.high[:, j + 1]
            best.add(scores, fits, ids, num)

    def found(self) -> Iterator[pa.RecordBatch]:
        for j, best in enumerate(self.best or []):
            if len(best.col):
                yield pa.RecordBatch.from_pydict(
                    {"anchor": pa.array(self.num[best.col]), "slot": pa.array(np.full(len(best.col), j, np.int32)),
                     "num": pa.array(best.num), "id": pa.array(best.id), "score": pa.array(best.score)})


def _cells(k: int, same: bool):
    """Reads partitions sorted by cell, anchors first, and gives the best rows of each cell."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        at, cell = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, min(STEP, batch.num_rows - start))
                keys = list(zip(part["block"].to_pylist(), part["slice"].to_pylist(), strict=True))
                isrow = part["high"].is_null().to_pylist()
                i = 0
                while i < len(keys):
                    end = i
                    while end < len(keys) and keys[end] == keys[i] and isrow[end] == isrow[i]:
                        end += 1
                    if keys[i] != at:
                        if cell:
                            yield from cell.found()
                        at, cell = keys[i], _Cell(k, same)
                    run_of = part.slice(i, end - i)
                    if isrow[i]:
                        cell.score(*(np.asarray(run_of[c]) for c in ("num", "id", "label")), run_of["vector"])
                    else:
                        cell.anchors(run_of)
                    i = end
        if cell:
            yield from cell.found()

    return run


def _slices(n: str, tasks: int) -> str:
    return f"greatest(ceil({n} / {SLICE}), least(ceil({n} / {LEAST_SLICE}), {tasks}), 1)"


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _deal(what: str, count: str) -> str:
    return f"pmod(xxhash64({what}), {count})"


def _best(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """The best k (anchor, slot, num, id, score) of each cell, for anchors (block, slices) and rows (blocks, slice).

    ``block`` is of an anchor, ``blocks`` how many there are for a row; likewise slices.
    """
    empty = "CAST(NULL AS ARRAY<BIGINT>)"
    limits = ["array() AS high", "array() AS low"] if same else ["high", "low"]
    left = anchors.selectExpr("block", "explode(sequence(0L, slices - 1)) AS slice", "num", "id", "label", "vector", *limits)
    right = rows.selectExpr("explode(sequence(first_block, first_block + blocks - 1)) AS block", "slice", "num", "id", "label", "vector",
                            f"{empty} AS high", f"{empty} AS low")
    # Casts give both sides one type.
    cast = lambda df: df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in (x.split(" ") for x in CELL.split(", "))])
    cells = cast(left).unionByName(cast(right)).repartition("block", "slice").sortWithinPartitions(
        "block", "slice", F.col("high").isNull())
    return cells.mapInArrow(_cells(k, same), FOUND)


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id", "num")
    return found.withColumn("place", F.row_number().over(order)).where(f"place <= {k}")


def positives(rows: DataFrame, every: int, k: int = POSITIVES) -> DataFrame:
    """(anchor, place, num, id, score): each anchor's best other rows of its label, place from 1.

    Anchors and rows of a label meet in cells of (block of its anchors, slice of its
    rows), so a label with a third of the rows is many tasks.
    """
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.expr(f"count_if(id % {every} = 0)").alias("anchors"))
    sizes = stage(sizes.where("anchors > 0").selectExpr(
        "label", f"{_slices('n', _tasks(rows))} AS slices", f"ceil(anchors / {BLOCK}) AS blocks",
        "shiftright(xxhash64(label), 1) AS first_block"), "labels")
    both = rows.join(sizes, "label").selectExpr(
        "*", f"{_deal('num, 1', 'slices')} AS slice", f"first_block + {_deal('num, 2', 'blocks')} AS block")
    return _top(_best(both.where(f"id % {every} = 0"), both, k, True), ["anchor"], k)


def mine(df: DataFrame, every: int = 50, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives_of: int = POSITIVES, negatives_of: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Anchors are the rows whose id is divisible by ``every``. Components times 256,
    rounded down, are integers, and scores their exact inner products. An anchor's
    positives are its best other rows of the same label; for each, the best rows of
    other labels with a score from 50 to 95 hundredths of the positive's are its
    negatives. Ties go to the smaller id. A positive without such rows, as any with
    a negative score, has no row in the result.

    Rows that take no part: see ``scaled``. Repeated rows are rows of their own: a
    repeated anchor is another anchor, and its copy its first positive. Vectors of
    unequal length are compared as if the shorter ended in zeros. Other columns are
    ignored; an empty table gives no rows.
    """
    ship(df.sparkSession)
    rows = stage(scaled(df, key, vector, label), "vectors")
    best = stage(positives(rows, every, positives_of), "positives")
    # Scores are a long; the limits are rounded so that integers meet them exactly.
    limits = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("best")).selectExpr(
        "anchor AS num", "best",
        f"transform(best, p -> CAST(floor(CAST(p.score AS DECIMAL(25,0)) * {HIGHEST} / 100) AS BIGINT)) AS high",
        f"transform(best, p -> CAST(ceil(CAST(p.score AS DECIMAL(25,0)) * {LOWEST} / 100) AS BIGINT)) AS low")
    anchors = stage(rows.join(limits, "num"), "anchors")
    n_rows, n_anchors = rows.count(), anchors.count()
    blocks = max(-(-n_anchors // BLOCK), 1)
    slices = _slices(n_rows, -(-_tasks(rows) // blocks))
    cells = _best(
        anchors.selectExpr("num", "id", "label", "vector", "high", "low", f"{_deal('num, 2', blocks)} AS block", f"{slices} AS slices"),
        rows.selectExpr("num", "id", "label", "vector", f"{_deal('num, 1', slices)} AS slice", "0L AS first_block", f"{blocks}L AS blocks"),
        negatives_of, False)
    slots = _top(cells, ["anchor", "slot"], negatives_of).groupBy("anchor").agg(
        F.collect_list(F.struct("slot", (-F.col("score")).alias("less"), "id", "num")).alias("kept"))
    return _windows(anchors.join(slots.withColumnRenamed("anchor", "num"), "num"), negatives_of)


def _windows(held: DataFrame, k: int) -> DataFrame:
    """Answers all windows of an anchor from its slots, merged from the lowest up.

    At most k rows of each slot come in, so an anchor's arrays are of a fixed size.
    """
    merged = f"""aggregate(
        sequence(size(best) - 1, 0, -1), CAST(array() AS ARRAY<ARRAY<STRUCT<less: BIGINT, id: BIGINT, num: BIGINT>>>),
        (down, j) -> concat(array(slice(sort_array(concat(
            IF(size(down) > 0, down[0], CAST(array() AS ARRAY<STRUCT<less: BIGINT, id: BIGINT, num: BIGINT>>)),
            transform(filter(kept, x -> x.slot = j), x -> struct(x.less, x.id, x.num)))), 1, {k})), down))"""
    windows = held.selectExpr("id AS anchor_id", "best", "low", f"{merged} AS merged").selectExpr(
        "anchor_id", "low", "best", "merged", "posexplode(best) AS (j, positive)")
    return windows.selectExpr(
        "anchor_id", "positive", "posexplode(filter(merged[j], x -> -x.less >= low[j])) AS (at, negative)").selectExpr(
        "anchor_id", "positive.id AS positive_id", "CAST(at + 1 AS INT) AS rank", "negative.id AS negative_id",
        "positive.score AS positive_score", "-negative.less AS negative_score")
