import random

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import orphans
from taxaloom.operators.orphans import KEY


def brute(refs, parents):
    return sorted((k, n, t) for k, n, t in refs if not any(pk == k and pn == n and not gone and (pt is None or pt <= t) for pk, pn, pt, gone in parents))


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    parents = [(rng.choice("ab"), n, rng.choice([None, *range(1, 9)]), rng.random() < 0.1) for n in range(0, 400) if rng.random() < 0.8 for _ in range(rng.choice([1, 1, 2]))]
    refs = [(rng.choice("abc"), rng.randrange(-3, 420), rng.randrange(1, 9)) for _ in range(1500)]
    day = lambda c: F.to_timestamp_ntz(F.date_add(F.lit("2024-01-01"), F.col(c)))
    p = spark.createDataFrame(parents, "space string, num long, t int, gone boolean").select("space", "num", F.lit("").alias("rest"), F.lit(4).alias("shift"), day("t").alias("loaded_at"), F.when(F.col("gone"), F.lit("x")).alias("deleted_at"))
    r = spark.createDataFrame(refs, "space string, num long, t int").select("space", "num", F.lit("").alias("rest"), F.lit(4).alias("shift"), day("t").alias("at"), "t")
    got = sorted((x.space, x.num, x.t) for x in orphans.dangling(r, p).collect())
    assert got == brute(refs, parents)


def test_runs(spark):
    rows = [("s", n, "", 4, None) for n in (1, 2, 3, 7, 8, 16, 17)]
    p = spark.createDataFrame(rows, "space string, num long, rest string, shift int, since timestamp_ntz")
    assert {(r.start, r.stop) for r in orphans.runs(p).collect()} == {(1, 3), (7, 8), (16, 17)}


def uuid(n):
    return f"{n:08x}-0000-5000-8000-00000000abcd"


def test_catalogue(spark):
    ts, date = "cast(null as timestamp_ntz)", "timestamp_ntz'2024-01-0{}'"
    names = spark.sql(f"""select * from values ('{uuid(1)}', '{uuid(9)}', {date.format(1)}, {ts}), ('{uuid(2)}', null, {date.format(1)}, {date.format(2)}), ('{uuid(3)}', '{{{uuid(8).upper()}}}', {date.format(5)}, {ts})
        as v(id, canonical_id, loaded_at, deleted_at)""")
    canonicals = spark.sql(f"select * from values ('{uuid(8)}', {date.format(1)}, {ts}) as v(id, loaded_at, deleted_at)")
    indices = spark.sql(f"""select * from values
        (1, 'r1', 'urn:uuid:{uuid(1).upper()}', ' r1 ', {date.format(3)}, {ts}), (1, 'r2', '{uuid(2)}', 'r1', {date.format(3)}, {date.format(4)}), (1, 'r3 ', '{uuid(3)} ', 'r9', {date.format(4)}, {ts}),
        (1, 'r4', '{uuid(4).replace("-", "")}', 'r2', {date.format(5)}, {ts}), (2, 'r5', '00000000-0000-0000-0000-000000000000', 'r1', {date.format(5)}, {ts}), (2, 'r6', '', '0', null, {ts}),
        (2, 'r7', 'no uuid', null, {date.format(5)}, {ts}), (2, 'r7', 'no uuid', null, {date.format(5)}, {ts}), (2, 'tx', null, 'tz', null, {ts})
        as v(data_source_id, record_id, name_string_id, accepted_record_id, loaded_at, deleted_at)""")
    got = {(r.tab, r.field, r.row_key, r.ref_id) for r in orphans.catalogue_orphans(indices, names, canonicals).collect()}
    nsi = "name_string_indices"
    assert got == {
        (nsi, "name_string_id", "1/r2", uuid(2)), (nsi, "name_string_id", "1/r3", uuid(3)), (nsi, "name_string_id", "1/r4", uuid(4)), (nsi, "name_string_id", "2/r7", "no uuid"),
        (nsi, "accepted_record_id", "1/r3", "r9"), (nsi, "accepted_record_id", "1/r4", "r2"), (nsi, "accepted_record_id", "2/r5", "r1"), (nsi, "accepted_record_id", "2/tx", "tz"),
        ("name_strings", "canonical_id", uuid(1), uuid(9)),
    }
    assert orphans.catalogue_orphans(indices.limit(0), names.limit(0), canonicals).collect() == []
    assert {r.field for r in orphans.catalogue_orphans(indices, names, canonicals.limit(0)).collect()} >= {"canonical_id"}


def test_keys_are_one_to_one(spark):
    texts = ["1", "01", "001", "gn_1", "gn_01", "a1b2", "", "9" * 30, "tx:5", "5", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(*orphans.record_key(F.lit(1), F.col("t")))
    assert len({tuple(r) for r in df.select(*KEY).collect()}) == len(texts)
