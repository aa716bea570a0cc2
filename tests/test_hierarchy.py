"""Hierarchies against a plain walk, with chunks of all sizes."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from taxaloom.operators import hierarchy as h

SCHEMA = "data_source_id int, col__id string, col__parent_id string, loaded_at timestamp_ntz"


def walk(up):
    """State, root, depth and path of every node by going from parent to parent."""
    out = {}
    for key in up:
        seen, (s, x) = [], key
        while True:
            seen.append(x)
            p = up[s, x]
            if not p or p == x or (s, p) not in up:
                out[key] = ("rooted", x, len(seen) - 1, seen[::-1])
                break
            if p in seen:
                out[key] = ("cycle" if p == key[1] else "below_cycle", None, None, None)
                break
            x = p
    return out


def forest(seed, n):
    rng = random.Random(seed)
    rows = []
    for s, size in ((1, n), (2, 40)):
        for i in range(size):
            p = rng.choice([None, "", f"n{i}", "absent", f"n{rng.randrange(size)}", f"n{(i + 9) % size}", *[f"n{(i - 1) % size}"] * 12])
            rows.append((s, f"n{i}", p, None))
    return rows


@pytest.mark.parametrize("chunk_rows", [100_000, 300, 37, 11])
def test_against_a_plain_walk(spark, chunk_rows):
    rows = forest(3, 1200)
    want = walk({(s, i): p for s, i, p, _ in rows})
    assert {w[0] for w in want.values()} == {"rooted", "cycle", "below_cycle"}
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.grp, r.id): (r.state, r.root, r.depth) for r in h.resolved(df, chunk_rows).collect()}
    assert got == {k: w[:3] for k, w in want.items()}
    paths = h.paths(df, chunk_rows)
    assert {(r.grp, r.id): r.path for r in paths.collect()} == {k: w[3] for k, w in want.items() if w[3]}
    pairs = {(r.grp, r.ancestor, r.descendant, r.distance) for r in h.descendants(paths).collect()}
    assert pairs == {(k[0], a, k[1], len(w[3]) - 1 - at) for k, w in want.items() if w[3] for at, a in enumerate(w[3][:-1])}


def test_defined_cases(spark):
    rows = [
        (1, " a ", None, None), (1, "b", "\ta", None), (1, None, "a", None), (1, "  ", "a", None), (1, "c", "gone", None), (1, "d", "d ", None),
        (None, "x", "y", None), (None, "y", "", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({}).selectExpr("*", "'other' id", "'other' grp", "1 root")
    got = {(r.grp, r.id): (r.root, r.depth, r.state) for r in h.resolved(df).collect()}
    assert got == {(1, "a"): ("a", 0, "rooted"), (1, "b"): ("a", 1, "rooted"), (1, "c"): ("c", 0, "rooted"), (1, "d"): ("d", 0, "rooted"), (None, "x"): ("y", 1, "rooted"), (None, "y"): ("y", 0, "rooted")}
    assert h.resolved(df.limit(0)).collect() == [] and h.paths(df.limit(0)).collect() == []


def test_latest_row_holds_and_ties_go_to_the_greatest_parent(spark):
    df = spark.sql(
        """select 1 data_source_id, id col__id, p col__parent_id, cast(t as timestamp_ntz) loaded_at from values
        ('a', 'b', '2024-01-02'), ('a', 'c', '2024-01-01'), ('a', null, null), ('b', '', '2024-01-01'), ('c', '', null),
        ('t', 'b', '2024-01-01'), ('t', 'c', '2024-01-01'), ('t', 'c', '2024-01-01') v(id, p, t)"""
    )
    got = {r.id: r.root for r in h.resolved(df).collect()}
    assert got == {"a": "b", "b": "b", "c": "c", "t": "c"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 30), min_size=1, max_size=31))
def test_compressed_arrays(parents):
    parents = np.array([p if p < len(parents) else -1 for p in parents])
    parents[parents == np.arange(len(parents))] = -1
    want = walk({(0, str(i)): None if p < 0 else str(p) for i, p in enumerate(parents)})
    top, off, circle, below = h.compressed(parents)
    for i in range(len(parents)):
        state, root, depth, _ = want[0, str(i)]
        assert (state == "cycle", state == "below_cycle") == (circle[i], below[i])
        if state == "rooted":
            assert (str(top[i]), off[i]) == (root, depth)
