"""Mixing sources to target weights.

Weights are a temperature mixture: source token shares raised to an exponent that is found by bisection, so that a target
entropy is met or no source has to be repeated more often than allowed. The weights are realised as budgeted block
permutations: the documents of a source are dealt into blocks in pseudo-random order; whole passes use every document, and
the last, partial pass takes blocks, and of the last one documents, as long as they fit.

Defined cases: a source without target, and a target without documents, get nothing; documents with null or empty text
have no tokens and are used as often as their block; a null source has no target; repeated rows are documents of their
own; if no source with a target has tokens, nothing is used.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TOKENS, BLOCKS_A_GROUP = 1 << 20, 1_000


def tempered(shares: dict[str, float], exponent: float) -> dict[str, float]:
    """Shares raised to ``exponent``, normalised."""
    raised = {s: v**exponent if v > 0 else 0.0 for s, v in shares.items()}
    total = sum(raised.values())
    return {s: v / total if total else 0.0 for s, v in raised.items()}


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def bisect(holds: Callable[[float], bool], low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The largest value in [low, high] for which ``holds``, which holds at ``low`` and up to some point."""
    if holds(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


def exponent_for_entropy(shares: dict[str, float], target: float) -> float:
    """The exponent in [0, 8] at which the tempered shares have the target entropy (it falls as the exponent grows)."""
    return bisect(lambda t: entropy(tempered(shares, t)) >= target, 0.0, 8.0)


def exponent_for_repeats(shares: dict[str, float], tokens: dict[str, int], repeats: dict[str, int], budget: float) -> float:
    """How far target shares can be followed from natural ones: exponent 0 gives the natural, 1 the target shares.

    The mixture at t is natural^(1-t) * target^t, normalised; the largest t is taken at which ``budget`` tokens need no
    source more often than ``repeats``.
    """
    natural = {s: float(tokens[s]) for s in shares}
    total = sum(natural.values()) or 1.0

    def fits(t: float) -> bool:
        tilted = tempered({s: (natural[s] / total) ** (1 - t) * shares[s] ** t for s in shares}, 1.0)
        return all(tilted[s] * budget <= repeats[s] * tokens[s] * (1 + 1e-12) for s in shares)

    return bisect(fits)


def plan(tokens: dict[str, int], targets: dict[str, tuple[float, int]], budget: float | None = None) -> dict[str, dict[str, float]]:
    """Per source with target: ``weight`` and token ``quota``. Without ``budget``: the largest at which the targets hold exactly."""
    live = {s: t for s, t in targets.items() if t[0] and t[0] > 0 and tokens.get(s, 0) > 0 and (t[1] or 0) > 0}
    if not live:
        return {}
    shares = tempered({s: t[0] for s, t in live.items()}, 1.0)
    repeats = {s: t[1] for s, t in live.items()}
    most = min(repeats[s] * tokens[s] / shares[s] for s in live)
    budget = most if budget is None else budget
    t = exponent_for_repeats(shares, tokens, repeats, budget)
    natural = tempered({s: float(tokens[s]) for s in live}, 1.0)
    weights = tempered({s: natural[s] ** (1 - t) * shares[s] ** t for s in live}, 1.0)
    return {s: {"weight": weights[s], "quota": min(weights[s] * budget, repeats[s] * tokens[s]), "exponent": t} for s in live}


def tempered_plan(tokens: dict[str, int], targets: dict[str, tuple[float, int]], budget: float) -> dict[str, dict[str, float]]:
    """Per source with target: ``weight``, token ``quota`` and ``exponent`` of a temperature mixture of ``budget`` tokens.

    The sources' token shares are raised to an exponent, bisected to the one at which their entropy is that of the target
    shares; if a source would then be repeated more often than allowed, the exponent rises, by bisection, to the first at
    which none is. A budget beyond what all repeats hold is met as far as they go.
    """
    live = {s: t for s, t in targets.items() if t[0] and t[0] > 0 and tokens.get(s, 0) > 0 and (t[1] or 0) > 0}
    if not live:
        return {}
    natural = tempered({s: float(tokens[s]) for s in live}, 1.0)
    wanted = exponent_for_entropy(natural, entropy(tempered({s: t[0] for s, t in live.items()}, 1.0)))
    fits = lambda t: all(w * budget <= live[s][1] * tokens[s] * (1 + 1e-12) for s, w in tempered(natural, t).items())
    exponent = wanted
    if not fits(wanted) and wanted < 1:
        exponent = 1.0 - bisect(lambda back: fits(1.0 - back), 0.0, 1.0 - wanted) if fits(1.0) else 1.0
    weights = tempered(natural, exponent)
    return {s: {"weight": weights[s], "quota": min(weights[s] * budget, live[s][1] * tokens[s]), "exponent": exponent} for s in live}


def realised(sizes: DataFrame, quotas: dict[str, dict[str, float]], repeats: dict[str, int], seed: int = 0) -> DataFrame:
    """From ``doc_id, source, n_tokens``: the same with ``uses``, how often each document of a source with quota is used."""
    spark = sizes.sparkSession
    rows = [(s, float(q["quota"]), int(repeats[s])) for s, q in quotas.items()]
    quota = spark.createDataFrame(rows, "source string, quota double, max_uses int")  # one row for each target
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("total"))
    per = quota.join(totals, "source").select(
        "source", F.floor(F.col("quota") / F.greatest("total", F.lit(1))).alias("passes"), "max_uses", "quota", "total", F.ceil((F.col("total") + 1) / BLOCK_TOKENS).alias("blocks")
    )
    per = per.withColumn("rest", F.when(F.col("passes") < F.col("max_uses"), F.floor(F.col("quota") - F.col("passes") * F.col("total"))).otherwise(F.lit(0)))
    per = per.select("source", F.least("passes", "max_uses").alias("passes"), "rest", "blocks")
    docs = sizes.join(F.broadcast(per), "source").withColumn("turn", F.xxhash64(F.lit(seed), "doc_id"))
    docs = docs.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("blocks")))
    sums = docs.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"))
    sums = placed_before(sums)
    within = Window.partitionBy("source", "block").orderBy("turn", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.join(sums, ["source", "block"]).withColumn("upto", F.col("before") + F.sum("n_tokens").over(within))
    return placed.select("doc_id", "source", "n_tokens", (F.col("passes") + (F.col("upto") <= F.col("rest")).cast("long")).alias("uses"))


def placed_before(sums: DataFrame, fan: int = BLOCKS_A_GROUP) -> DataFrame:
    """``source, block, before``: the tokens in the blocks before each, by sums within and before groups of ``fan`` blocks, so that a source's blocks aren't one task's work."""
    sums = sums.withColumn("part", F.floor(F.col("block") / fan))
    inner = Window.partitionBy("source", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for a thousand blocks of a million tokens
    groups = sums.groupBy("source", "part").agg(F.sum("in_block").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(outer), F.lit(0))).select("source", "part", "ahead")
    within = sums.withColumn("inside", F.coalesce(F.sum("in_block").over(inner), F.lit(0)))
    return within.join(groups, ["source", "part"]).select("source", "block", (F.col("inside") + F.col("ahead")).alias("before"))


def shares_reached(used: DataFrame, quotas: dict[str, dict[str, float]], targets: dict[str, tuple[float, int]]) -> DataFrame:
    """Per source of the targets: documents, uses, tokens and share reached beside the target share and the weight."""
    spark = used.sparkSession
    rows = [(s, float(t[0] or 0), float(quotas.get(s, {}).get("weight", 0.0))) for s, t in targets.items()]
    aims = spark.createDataFrame(rows, "source string, target_share double, weight double")
    per = used.where("uses > 0").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("uses").alias("n_uses"), F.max("uses").alias("most_uses"), F.sum(F.col("uses") * F.col("n_tokens")).alias("n_tokens"))
    total = per.agg(F.sum("n_tokens").alias("all_tokens"))
    joined = aims.join(per, "source", "left").join(F.broadcast(total))
    return joined.select(
        "source", "target_share", "weight", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_docs", "n_uses", "most_uses", "n_tokens")),
        F.coalesce(F.col("n_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("share"),
    )
