import os
import sqlite3
import zipfile

from pyspark.sql import functions as F

from taxaloom.sources import archives, sqlite
from taxaloom.streaming import incremental


def checklist(path, n=1000):
    with sqlite3.connect(path) as con:
        con.execute("create table taxon (col__id text, col__parent_id text, n integer)")
        con.executemany("insert into taxon values (?, ?, ?)", [(f"t{k}", None if k % 7 == 0 else f"t{k - 1}", k) for k in range(n)])
        con.execute("create table empty (a text)")


def test_sqlite_round_trip(spark, tmp_path):
    path = str(tmp_path / "a.sqlite")
    checklist(path)
    df = sqlite.read(spark, path, "taxon", parts=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 1000 and dict(df.dtypes)["n"] == "bigint"
    for pushed in ("true", "false"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", pushed)
        df = sqlite.read(spark, path, "taxon", parts=3)
        assert df.where("n > 990 and col__parent_id is not null").count() == sum(k % 7 > 0 for k in range(991, 1000))
        assert df.where("col__id in ('t1', 't5', 'none') and n = 5").count() == 1
    assert sqlite.read(spark, path, "taxon", ["n"]).columns == ["n"]
    assert sqlite.read(spark, path, "empty").count() == 0
    out = str(tmp_path / "out.sqlite")
    assert sqlite.write(df.select("col__id", "n"), out, "name", batch=64) == 1000
    assert sqlite.read(spark, out, "name").agg(F.sum(F.col("n").cast("long"))).first()[0] == sum(range(1000))


def test_archives_are_opened(spark, tmp_path):
    path = str(tmp_path / "a.sqlite")
    checklist(path, 10)
    with sqlite3.connect(path) as con:
        (tmp_path / "d.sql").write_text("\n".join(con.iterdump()))
    for name in ("a.sqlite", "d.sql"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.write(tmp_path / name, name)
    for name in ("a.sqlite", "a.sqlite.zip", "d.sql.zip"):
        folder = tmp_path / f"to-{name}"
        folder.mkdir()
        assert sqlite.read(spark, sqlite.opened(str(tmp_path / name), str(folder)), "taxon").count() == 10


def test_files_of_sources(spark):
    files = ["0001-a-2023-01-01.sqlite", "001_a_2024-01-01.sql", "1.sqlite.zip", "01-a-2024-01-01.sqlite.zip", "0002-b.sql", "2-b.sqlite", "1001-c-2020-02-02.sql.zip", "0003-x.txt", "note.sql"]
    df = spark.createDataFrame([(f,) for f in files], "file string")
    assert {(r.source, r.file, r.n_files) for r in archives.latest(df).collect()} == {(1, "01-a-2024-01-01.sqlite.zip", 4), (2, "2-b.sqlite", 2), (1001, "1001-c-2020-02-02.sql.zip", 1)}
    assert archives.latest(df.limit(0)).collect() == []


def test_stream_adds_each_key_once(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("id"))
    rows(0, 10).unionByName(rows(5, 10)).write.parquet(source)
    stream = lambda: spark.readStream.schema("id string").parquet(source)
    incremental.load(stream(), folder, str(tmp_path / "cp")).awaitTermination()
    rows(8, 15).write.mode("append").parquet(source)
    incremental.load(stream(), folder, str(tmp_path / "cp")).awaitTermination()
    assert sorted(int(r.id) for r in spark.read.parquet(folder).collect()) == list(range(15))


def test_a_file_for_each_source(spark, tmp_path):
    """Written in tasks, read back by source; null sources have no file, a second run replaces the first."""
    df = spark.range(500).select((F.col("id") % 3).cast("int").alias("data_source_id"), F.concat(F.lit("r'"), F.col("id")).alias("record_id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"), F.timestamp_seconds("id").alias("at"))
    df = df.unionByName(df.limit(1).withColumn("data_source_id", F.lit(None).cast("int")))
    for _ in range(2):
        told = {r.data_source_id: r.n_rows for r in sqlite.write_each(df, str(tmp_path / "out"), "name", batch=64).collect()}
        assert told == {0: 167, 1: 167, 2: 166} and sorted(os.listdir(tmp_path / "out")) == ["0.sqlite", "1.sqlite", "2.sqlite"]
    back = sqlite.read(spark, str(tmp_path / "out" / "1.sqlite"), "name")
    assert back.columns == ["record_id", "n", "at"] and back.count() == 167 and back.where("n is null").count() == df.where("data_source_id = 1 and n is null").count()
    assert sqlite.write_each(df.limit(0), str(tmp_path / "none"), "name").collect() == []
