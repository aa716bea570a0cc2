import math

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import mixing


def test_exponents():
    shares = {"a": 0.7, "b": 0.2, "c": 0.1}
    t = mixing.exponent_for_entropy(shares, 0.9)
    assert abs(mixing.entropy(mixing.tempered(shares, t)) - 0.9) < 1e-9
    assert mixing.exponent_for_entropy(shares, math.log(3)) == pytest.approx(0, abs=1e-6)
    tokens, repeats = {"a": 700, "b": 200, "c": 100}, {"a": 1, "b": 2, "c": 3}
    even = {"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}
    assert mixing.exponent_for_repeats(even, tokens, repeats, 900) == 1.0
    t = mixing.exponent_for_repeats(even, tokens, repeats, 1000)
    assert 0 < t < 1
    plan = mixing.plan(tokens, {s: (even[s], repeats[s]) for s in even}, budget=1000)
    assert all(q["quota"] <= repeats[s] * tokens[s] + 1e-6 for s, q in plan.items()) and sum(q["quota"] for q in plan.values()) == pytest.approx(1000, rel=1e-6)


def test_plan_without_budget_meets_the_targets():
    plan = mixing.plan({"a": 1000, "b": 100, "z": 5}, {"a": (0.5, 1), "b": (0.5, 4), "n": (0.1, 2), "m": (None, None)})
    assert set(plan) == {"a", "b"} and plan["a"]["quota"] == plan["b"]["quota"] == 400
    assert mixing.plan({}, {"a": (1.0, 1)}) == {} and mixing.plan({"a": 0}, {"a": (1.0, 1)}) == {}


def test_realised_shares(spark):
    sizes = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, F.lit("a")).when(F.col("id") % 10 < 9, F.lit("b")).when(F.col("id") % 100 == 9, F.lit(None)).otherwise(F.lit("c")).alias("source"), (F.col("id") * 37 % 400).alias("n_tokens")
    )
    targets = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 3)}
    tokens = {r.source: r.n for r in sizes.where("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    plan = mixing.plan(tokens, targets)
    used = mixing.realised(sizes, plan, {s: t[1] for s, t in targets.items()}).cache()
    assert used.count() == sizes.where("source is not null").count()
    reached = {r.source: r for r in mixing.shares_reached(used, plan, targets).collect()}
    for s, (share, repeats) in targets.items():
        assert abs(reached[s].share - share) < 0.002 and reached[s].most_uses <= repeats
        assert plan[s]["quota"] - 400 <= reached[s].n_tokens <= plan[s]["quota"]
    again = mixing.realised(sizes.repartition(7), plan, {s: t[1] for s, t in targets.items()})
    assert again.exceptAll(used).count() == 0


def test_blocks_make_no_difference(spark, monkeypatch):
    sizes = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), (F.col("id") % 50).alias("n_tokens"))
    total = 50 * 49 // 2 * 60
    plan = {"a": {"weight": 1.0, "quota": total * 1.4}}
    for tokens in (1 << 20, 500):
        monkeypatch.setattr(mixing, "BLOCK_TOKENS", tokens)
        uses = mixing.realised(sizes, plan, {"a": 2}).agg(F.sum(F.col("uses") * F.col("n_tokens")), F.max("uses"), F.min("uses")).first()
        assert total * 1.4 - 50 <= uses[0] <= total * 1.4 and (uses[1], uses[2]) == (2, 1)


def test_empty(spark):
    sizes = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    assert mixing.realised(sizes, {"a": {"weight": 1.0, "quota": 5.0}}, {"a": 1}).collect() == []
    assert [r.share for r in mixing.shares_reached(sizes.withColumn("uses", F.lit(1)), {}, {"a": (1.0, 1)}).collect()] == [0.0]


def test_tempered_plan():
    """The exponent gives the targets' entropy; caps raise it; both are found by bisection."""
    tokens, even = {"a": 1_000_000, "b": 100_000, "c": 10_000}, {"a": (0.4, 100), "b": (0.3, 100), "c": (0.3, 100)}
    free = mixing.tempered_plan(tokens, even, 1e5)
    weights = {s: q["weight"] for s, q in free.items()}
    assert abs(mixing.entropy(weights) - mixing.entropy({s: t[0] for s, t in even.items()})) < 1e-6 and abs(sum(weights.values()) - 1) < 1e-9
    capped = mixing.tempered_plan(tokens, {s: (t[0], 2) for s, t in even.items()}, 1.11e6)
    assert free["a"]["exponent"] < capped["a"]["exponent"] <= 1
    assert all(q["quota"] <= 2 * tokens[s] * (1 + 1e-9) for s, q in capped.items()) and max(q["quota"] / tokens[s] for s, q in capped.items()) > 1.99
    over = mixing.tempered_plan(tokens, {s: (t[0], 2) for s, t in even.items()}, 1e9)
    assert {s: q["quota"] for s, q in over.items()} == {s: 2 * n for s, n in tokens.items()}
    assert mixing.tempered_plan({}, even, 1e6) == {} and mixing.tempered_plan(tokens, {}, 1e6) == {}


def test_blocks_are_placed_as_by_one_window(spark):
    rows = [(s, k, (k * 7919) % 101) for s in ("a", None, "b") for k in range(57)]
    got = {(r.source, r.block): r.before for r in mixing.placed_before(spark.createDataFrame([r for r in rows if r[0]], "source string, block long, in_block long"), fan=10).collect()}
    for s in ("a", "b"):
        total = 0
        for _, k, n in (r for r in rows if r[0] == s):
            assert got[s, k] == total
            total += n
