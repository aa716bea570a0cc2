import random

import pytest

from taxaloom.operators import diff

SCHEMA = "data_source_id int, record_id string, name string, status string, loaded_at timestamp_ntz, extra int"
KEYS, COLUMNS = ["data_source_id", "record_id"], ["name", "status"]


def found(spark, a, b):
    x, y = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    return sorted((r.data_source_id or 0, r.record_id or "", r.diff, r.value_a, r.value_b) for r in diff.differences(x, y, KEYS, COLUMNS).collect())


def test_defined_cases(spark):
    from datetime import datetime as d

    a = [(1, "a", "x", None, None, 1), (1, "b", "old", "s", d(2024, 1, 1), 1), (1, "b", "new", "s", d(2024, 1, 2), 1), (1, "c", "x", "s", None, 1), (1, "c", "x", "s", None, 1), (None, "n", "x", "s", None, 1), (1, None, "x", "s", None, 1)]
    b = [(1, "a", "x", "", None, 2), (1, "b", "new", "s", d(2023, 1, 1), 2), (1, "d", "x", "s", None, 2), (None, "n", "y", "s", None, 2), (1, None, "x", "s", None, 2)]
    assert found(spark, a, b) == [(0, "n", "name", "x", "y"), (1, "a", "status", None, ""), (1, "c", "only_a", None, None), (1, "d", "only_b", None, None)]
    assert {r[2] for r in found(spark, a, [])} == {"only_a"} and found(spark, [], []) == [] and found(spark, b, b) == []


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    a = {(rng.randrange(3), f"r{k}"): (rng.choice(["x", "y", None]), rng.choice(["s", "t"])) for k in range(1500)}
    b = {k: v if rng.random() < 0.97 else (rng.choice(["x", "z", None]), v[1]) for k, v in a.items() if rng.random() < 0.99}
    want = [(*k, "only_a", None, None) for k in a if k not in b] + [(*k, c, u, v) for k in b for c, u, v in zip(COLUMNS, a[k], b[k], strict=True) if u != v]
    rows = lambda t: [(*k, *v, None, 0) for k, v in t.items()]
    assert found(spark, rows(a), rows(b)) == sorted(want, key=str) or sorted(found(spark, rows(a), rows(b)), key=str) == sorted(want, key=str)


def test_ties_with_different_values(spark):
    """Of rows tied at the latest loaded_at the one with the greatest values holds, whatever their hashes."""
    from datetime import datetime as d

    rng = random.Random(5)
    rows_a, rows_b, want = [], [], []
    for k in range(200):
        at = rng.choice([None, d(2024, 1, 1)])
        low, high = (rng.choice([None, f"a{k}"]), rng.choice([None, "s", "t"])), (f"b{k}", rng.choice([None, "s", "t"]))
        other = rng.choice([low, high, (f"b{k}", "u")])
        early = [] if at is None else [(1, f"r{k}", "z", "z", d(2023, 1, 1), 0)]
        rows_a += [(1, f"r{k}", *v, at, 0) for v in rng.sample([low, high], 2)] + early
        rows_b += [(1, f"r{k}", *other, at, 0)]
        want += [(1, f"r{k}", c, u, v) for c, u, v in zip(COLUMNS, high, other, strict=True) if u != v]
    assert sorted(found(spark, rows_a, rows_b), key=str) == sorted(want, key=str)
    assert sorted(found(spark, rows_b, rows_a), key=str) == sorted([(*w[:3], w[4], w[3]) for w in want], key=str)
    assert found(spark, rows_a, rows_a[::-1]) == []


def test_the_holding_row_is_chosen_by_all_columns(spark):
    """A column equal in its whole bucket still decides between tied rows."""
    a = [(1, "a", "y", "s", None, 0), (1, "a", "x", "t", None, 0)]
    b = [(1, "a", "y", "r", None, 0)]
    assert found(spark, a, b) == [(1, "a", "status", "s", "r")]


def test_beyond_the_bitmap_buckets_are_joined(spark):
    """Past its bound the bitmap gives way to a join; both give the same."""
    rng = random.Random(9)
    rows = [(1, f"r{k}", rng.choice("xyz"), rng.choice(["s", None]), None) for k in range(3000)]
    other = [r if rng.random() < 0.99 else (*r[:2], "w", *r[3:]) for r in rows]
    make = lambda t: spark.createDataFrame(t, "data_source_id int, record_id string, name string, status string, loaded_at timestamp_ntz")
    a, b = make(rows), make(other)
    of = lambda **k: sorted(map(tuple, diff.differences(a, b, ["data_source_id", "record_id"], ["name", "status"], **k).collect()), key=str)
    assert of() == of(most_bits=0) and len(of()) == sum(u != v for u, v in zip(rows, other, strict=True))


def test_only_rows_of_unequal_buckets_are_kept(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(F.pmod("id", F.lit(256)).alias("_bucket"), "id")
    bad = spark.createDataFrame([(0,), (63,), (64,), (255,)], "_bucket long")
    assert {r[0] for r in diff.in_buckets(rows, bad, 256).select("_bucket").distinct().collect()} == {0, 63, 64, 255}
    assert diff.in_buckets(rows, bad.limit(0), 256).count() == 0
