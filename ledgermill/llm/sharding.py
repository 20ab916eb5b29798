"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a pseudo-random number from the key and its own id; the
largest wins. A shard's draw does not depend on the other shards, so adding
one moves only the keys that the new shard wins, and removing one moves only
its own. Weights enter as ``ln(u) / weight`` (an exponential race), which gives
each shard keys in proportion to its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Slots are counted within slices of the key's hash, so that no task sorts a
# whole shard. The slot order is that of the hash and does not depend on it.
SLICES = 4096
CHUNK = 65_536


def key_text(key: str) -> str:
    """SQL text of a key as hashed; a null key is one key of its own."""
    return f"coalesce(concat('k', CAST({key} AS STRING)), 'null')"


def draw(key: str, salt: str) -> str:
    """SQL text: 52 bits of the MD5 of key and salt, a BIGINT."""
    return f"CAST(conv(substring(md5(concat({key_text(key)}, '/', {salt})), 1, 13), 16, 10) AS BIGINT)"


def bid(key: str, shard: str, weight: str) -> str:
    """SQL text: what a shard bids for a key; the smaller id wins a tie."""
    unit = f"(({draw(key, f'CAST({shard} AS STRING)')} + 0.5D) / 4503599627370496D)"
    return f"struct(ln({unit}) / {weight} AS score, -{shard} AS tie)"


def assign(df: DataFrame, key: str, shards: Sequence[tuple[int, float]], grown: tuple[int, float] | None = None,
           name: str = "shard", grown_name: str = "grown_shard") -> DataFrame:
    """``df`` with the shard of each row and, if asked, its shard once ``grown`` is added.

    shards: (id, weight > 0). Equal keys go to the same shard, null keys too.
    Columns already called like the added ones are replaced.
    """
    if not shards or any(w <= 0 for _, w in shards):
        raise ValueError("shards need positive weights")
    pool = "array(" + ", ".join(f"struct({int(i)} AS id, {float(w)}D AS weight)" for i, w in shards) + ")"
    out = df.drop(name, grown_name)
    best = _free("best", out.columns)
    out = out.withColumn(best, F.expr(f"array_max(transform({pool}, s -> {bid(f'`{key}`', 's.id', 's.weight')}))"))
    if grown:
        new = bid(f"`{key}`", str(int(grown[0])), f"{float(grown[1])}D")
        out = out.withColumn(grown_name, F.expr(f"CAST(-greatest({best}, {new}).tie AS INT)"))
    return out.withColumn(name, F.expr(f"CAST(-{best}.tie AS INT)")).drop(best)


def number(df: DataFrame, shard: str, key: str, columns: Sequence[str], name: str = "slot") -> DataFrame:
    """``columns`` of every row of ``df`` with a gapless slot from 0 within its shard.

    Rows are ordered by the hash of the key, then by ``columns`` (nulls first).
    Equal rows are counted before they are shuffled and written out again after,
    so neither a hot key nor a repeated row meets in one task.
    """
    cols = [c for c in columns if c != name]
    place, n = _free("place", cols), _free("n", cols)
    part, first, base = _free("part", cols), _free("first", cols), _free("base", cols)
    rows = (df.select(*cols, F.expr(draw(f"`{key}`", "'slot'")).alias(place))
              .groupBy(*cols, place).agg(F.count(F.lit(1)).alias(n))
              .withColumn(part, F.expr(f"CAST({place} DIV {2 ** 52 // SLICES} AS INT)")))
    by = [shard, part]
    inside = Window.partitionBy(*by).orderBy(place, *cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn(first, F.sum(n).over(inside) - F.col(n))
    # One row for each shard and slice at most.
    above = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = rows.groupBy(*by).agg(F.sum(n).alias(base)).withColumn(base, F.sum(base).over(above) - F.col(base))
    left, right = rows.alias("l"), sizes.alias("r")
    same = F.col(f"l.{shard}").eqNullSafe(F.col(f"r.{shard}")) & (F.col(f"l.{part}") == F.col(f"r.{part}"))
    placed = left.join(right, same).select(
        *[F.col(f"l.{c}") for c in cols], F.col(f"l.{n}").alias(n),
        (F.col(f"l.{first}") + F.col(f"r.{base}")).alias(first))
    few = placed.where(F.col(n) <= CHUNK).select(
        *cols, F.explode(F.sequence(F.col(first), F.col(first) + F.col(n) - 1)).alias(name))
    chunk = _free("chunk", cols)
    many = (placed.where(F.col(n) > CHUNK)
                  .select(*cols, first, n, F.explode(F.expr(f"sequence(0L, ({n} - 1) DIV {CHUNK})")).alias(chunk))
                  .repartition(chunk, first)
                  .select(*cols, F.explode(F.expr(
                      f"sequence({first} + {chunk} * {CHUNK}, {first} + least({n}, ({chunk} + 1) * {CHUNK}) - 1)")).alias(name)))
    return few.unionByName(many)


def _free(name: str, taken: Sequence[str]) -> str:
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
