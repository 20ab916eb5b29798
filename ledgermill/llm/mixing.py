"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed by cell (source, language, topic). Raking multiplies the
cells of each value of one margin so that they sum to its target, one margin after
the other, until nothing changes. The cell's factor, divided by the largest, is the
probability with which its documents are sampled: the expected sample then has all
target shares, and no document is asked for more than once. A document is kept if
a number drawn from its key is below the probability, so the sample is repeatable.

Cells and factors are tables; no margin has to fit into one task or the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgermill.llm.sharding import draw
from ledgermill.session import stage

NONE = "(none)"
TOLERANCE, SWEEPS = 1e-9, 100
# Factors that move more than this, by the same ratio sweep after sweep, show targets that contradict each other.
DRIFT = 1e-3
# Shares are raised to this power: 1 leaves them as they are, 0 makes them equal.
POWER = 0.7
# Topics by the first list of which a text holds a string; else "prose".
TOPICS = (("legal", ("icense", "opyright")), ("contact", ("@", "http")), ("table", (" | ",)))


def topic(text: str = "text", topics=TOPICS, other: str = "prose") -> Column:
    out = F.lit(other)
    for name, marks in reversed(topics):
        found = " OR ".join(f"contains(`{text}`, '{m}')" for m in marks)
        out = F.when(F.expr(f"coalesce({found}, false)"), F.lit(name)).otherwise(out)
    return out


def tokens(text: str = "text") -> Column:
    """Words between ASCII white space; an empty or null text weighs one."""
    return F.expr(f"CAST(greatest(coalesce(regexp_count(`{text}`, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0), 1) AS BIGINT)")


def tempered(cells: DataFrame, margins: Sequence[str], power: float) -> dict[str, DataFrame]:
    """Targets of each margin: shares of the tokens raised to ``power`` and made to sum to 1."""
    out = {}
    for m in margins:
        raised = cells.groupBy(m).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("target"))
        total = raised.agg(F.sum("target").alias("whole"))  # one row
        out[m] = stage(raised.join(F.broadcast(total)).select(m, (F.col("target") / F.col("whole")).alias("target")), "mix-target")
    return out


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE,
         sweeps: int = SWEEPS, strict: bool = True) -> DataFrame:
    """``cells`` (margins, tokens > 0) with the factor that makes every margin meet its target share.

    targets: for each margin a table (value, target). Values without a target or with
    target 0 get the factor 0. Stops when no factor changes by more than ``tolerance``
    (relatively). Targets that contradict each other do so never: the weights of the
    cells then come to a cycle, one state for each margin that has just been met. If
    ``strict`` this is an error after ``sweeps``; otherwise it ends as soon as the cycle
    repeats, or after ``sweeps``, with the mean of the states, so that no margin is
    preferred to another. ``missed`` tells by how much each value then misses its target.
    """
    margins = list(targets)
    total = cells.agg(F.sum("tokens")).first()[0]
    if total is None:
        return cells.withColumn("factor", F.lit(1.0))
    # (value, target, factor): small next to the cells, one row for each value.
    factors = {m: stage(cells.select(m).distinct().join(targets[m], m, "left")
                        .selectExpr(m, "coalesce(target, 0D) AS target", "CASE WHEN target > 0 THEN 1D ELSE 0D END AS factor",
                                    "1D AS step"), "mix-factor")
               for m in margins}
    for _ in range(sweeps):
        moved, turned = [], []
        for m in margins:
            weighed = cells.withColumn("w", F.col("tokens") / F.lit(float(total)))
            for other in margins:
                if other != m:
                    weighed = weighed.join(factors[other].select(other, F.col("factor").alias(f"factor_{other}")), other)
                    weighed = weighed.withColumn("w", F.expr(f"w * factor_{other}")).drop(f"factor_{other}")
            seen = Observation()
            new = weighed.groupBy(m).agg(F.sum("w").alias("w")).join(factors[m], m).selectExpr(
                m, "target", "CASE WHEN target > 0 AND w > 0 THEN target / w ELSE 0D END AS factor", "factor AS old", "step AS before")
            new = new.withColumn("step", F.expr("CASE WHEN old = 0 THEN 1 + factor ELSE factor / old END"))
            new = new.observe(seen, F.max(F.expr("abs(step - 1)")).alias("moved"),
                              F.max(F.expr("CASE WHEN step = before THEN 0D ELSE abs(step / before - 1) END")).alias("turned"))
            factors[m] = stage(new.drop("before"), "mix-factor")
            moved.append(seen.get["moved"] or 0.0)
            turned.append(seen.get["turned"] or 0.0)
        settled = max(moved) <= tolerance
        if settled or not strict and max(moved) > DRIFT and max(turned) <= tolerance:
            break
    if not settled and strict:
        raise ValueError("the targets contradict each other: raking does not settle")
    out = cells
    for m in margins:
        out = out.join(factors[m].select(m, F.col("factor").alias(f"factor_{m}"), F.col("old").alias(f"old_{m}")), m)
    # The states of the last sweep: margins up to k have been met again, the others not yet.
    states = [" * ".join(f"`{'factor' if i <= k else 'old'}_{m}`" for i, m in enumerate(margins)) for k in range(len(margins))]
    whole = states[-1] if settled else f"({' + '.join(states)}) / {len(states)}"
    return stage(out.select(*cells.columns, F.expr(whole).alias("factor")), "mix-cells")


def missed(raked: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """(margin, value, target, share) of every value of the cells: the share it has after raking."""
    total = raked.agg(F.sum("tokens").cast("double").alias("whole"))  # one row
    out = None
    for m, target in targets.items():
        share = raked.groupBy(m).agg(F.sum(F.col("tokens") * F.col("factor")).alias("w")).join(target, m, "left")
        share = share.join(F.broadcast(total)).selectExpr(
            f"'{m}' AS margin", f"{m} AS value", "coalesce(target, 0D) AS target", "w / whole AS share")
        out = share if out is None else out.unionByName(share)
    return out


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, source, lang, topic, tokens) of every row; null values are a value of their own."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c)
    return docs.select(F.col(key).alias("id"), value("source"), value("lang"), topic(text).alias("topic"),
                       tokens(text).alias("tokens"))


def probabilities(measured: DataFrame, power: float = POWER, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(source, lang, topic, probability) of each cell of ``measured``.

    Tempered targets contradict each other where, say, a source has a language of its
    own, for each margin is tempered by itself. Then the targets are met as nearly as
    ``rake`` can without ``strict``, and the largest miss is logged.
    """
    margins = ["source", "lang", "topic"]
    cells = stage(measured.groupBy(*margins).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    targets = targets or tempered(cells, margins, power)
    raked = rake(cells, targets, strict=False)
    worst = missed(raked, targets).agg(F.max(F.expr("abs(share - target)"))).first()[0]
    if worst is not None and worst > 1e-6:
        logging.getLogger(__name__).warning("the targets contradict each other: a share misses its target by %.3g", worst)
    top = raked.agg(F.max("factor").alias("top"))  # one row
    return stage(raked.join(F.broadcast(top)).select(*margins, F.expr("factor / top").alias("probability")), "mix-cells")


def below(key: str, probability: str) -> Column:
    """Whether the number drawn from the key, from 0 to 1, is below the probability."""
    return F.expr(f"""({draw(key, "'mix'")} + 0.5D) / 4503599627370496D < {probability}""")


def sample(docs: DataFrame, power: float = POWER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` sampled so that the expected token shares meet the tempered targets.

    Needs the columns source and lang; all columns are returned as they are. Rows with
    equal keys (null is one) share one draw. An empty table gives an empty sample.
    """
    chances = probabilities(measure(docs, key, text), power)
    names = {"source": "_mix_source", "lang": "_mix_lang", "topic": "_mix_topic", "probability": "_mix_chance"}
    wide = docs.withColumns({
        "_mix_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
        "_mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)), "_mix_topic": topic(text)})
    joined = wide.join(chances.withColumnsRenamed(names), ["_mix_source", "_mix_lang", "_mix_topic"])
    return joined.where(below(f"`{key}`", "_mix_chance")).select(*[F.col(f"`{c}`") for c in docs.columns])
