"""Golden cases of the catalogue's expressions and operators."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from taxaloom.functions import codes, text
from taxaloom.functions.ids import bare_uuid, clean_id, uuid5, uuid_text
from taxaloom.operators import audit, classification, export, maintain, names, parse, verification, vernacular


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r.out for r in df.select("k", expression(F.col("v")).alias("out")).orderBy("k").collect()]


def test_uuid5(spark):
    space = uuid.UUID("90181196-fecf-5082-a4c1-411d4f314cda")
    texts = ["Homo sapiens", "", "Çelmar é 日本", "a" * 5000]
    assert column(spark, [*texts, None], uuid5) == [*(str(uuid.uuid5(space, t)) for t in texts), None]
    assert column(spark, ["Homo sapiens"], uuid5) == ["16f235a0-e4a3-529c-9b83-bd15fe722110"]


def test_spellings_of_ids(spark):
    u = "16f235a0-e4a3-529c-9b83-bd15fe722110"
    ways = [u, u.upper(), f" {u}\t", f"{{{u}}}", f"urn:uuid:{u}", u.replace("-", ""), f"URN:UUID:{u.upper()}"]
    assert column(spark, ways, uuid_text) == [u] * len(ways)
    assert column(spark, [" x ", "", "  ", None], uuid_text) == ["x", None, None, None]
    assert column(spark, [u[:-1], "g" * 32, None], bare_uuid) == [None] * 3
    assert column(spark, ["​ a　", "", None], clean_id) == ["a", None, None]


def test_codes(spark):
    given = ["ZOOLOGICAL", "botanical", "Bacterial", "VIRUS", "UNKNOWN", "", None]
    assert column(spark, given, codes.code_number) == [1, 2, 3, 4, 0, 0, 0]


def test_ranks_by_suffix(spark):
    given = {
        "Rosaceae": "family", "Rosoideae": "subfamily", "Roseae": "tribe", "Rosales": "order", "Salicineae": "tribe", "Rhodophyceae": "tribe", "Felidae": "family", "Canini": "tribe",
        "Hominoidea": "superfamily", "Magnoliopsida": "class", "Ascomycota": "phylum", "Felinae": "subfamily", "Hominina": "", "Rosa": "",
    }
    assert column(spark, list(given), lambda c: codes.rank_by_suffix(c, F.lit(0))) == list(given.values())
    assert column(spark, ["Felinae", "Hominina"], lambda c: codes.rank_by_suffix(c, F.lit(2))) == ["subtribe", ""]
    assert column(spark, ["Felinae", "Hominina"], lambda c: codes.rank_by_suffix(c, F.lit(1))) == ["subfamily", "subtribe"]


def test_votes(spark):
    assert column(spark, ["Felidae|Rosaceae", "Felidae|Canini|Rosaceae", "Rosaceae", "", None], codes.code_vote) == [0, 1, 2, 0, 0]


def test_slugs(spark):
    given = {"Catalogue of Life": "catalogue-of-life", "  leading/trailing  ": "leadingtrailing", "double--hyphens": "double-hyphens", "Special @#$ chars": "special-chars", "": ""}
    assert column(spark, list(given), text.slug) == list(given.values())


def test_file_names(spark):
    given = {
        "1000_ruhoff_2023-08-22_v1.0.0.sqlite.zip": ("v1.0.0", "2023-08-22"), "0147-vascan-2025-08-25.sqlite.zip": ("", "2025-08-25"), "1000.sql": ("", ""),
        "0001_test_2024-01-01_v2.3.sqlite": ("v2.3", "2024-01-01"), "0001_test_2024-01-01_1.5.2.sqlite": ("1.5.2", "2024-01-01"), "0001_col_2025-10-03_v2024.1.sqlite.zip": ("v2024.1", "2025-10-03"),
        "0002_gbif_2024-12-15_2024-12-15.sql.zip": ("2024-12-15", "2024-12-15"),
    }
    assert column(spark, list(given), lambda c: F.struct(text.file_version(c), text.file_date(c))) == list(given.values())
    assert column(spark, ["a.sqlite.zip", "a.SQL.zip", "a.sqlite", "a.sql", "a.txt"], text.file_priority) == [4, 3, 2, 1, 0]


def test_outlinks(spark):
    alt = lambda c: text.outlink_value(F.lit("name.col__alternative_id"), c)
    assert column(spark, ["wikidata:Q123,gnoutlink:Homo_sapiens", "gnoutlink:url-encoded-name", "wikidata:Q123", "", None], alt) == ["Homo_sapiens", "url-encoded-name", "", "", None]
    assert column(spark, ["12345"], lambda c: text.outlink_value(F.lit("taxon.col__id"), c)) == ["12345"]


def test_bytes_years_urls(spark):
    assert column(spark, ["é" * 10, "é" * 3, None], lambda c: text.fit_bytes(c, 10)) == ["ééé…", "ééé", None]
    assert column(spark, ["1758?", " 1901", "x", "99999", "", None], text.leading_int) == [1758, 1901, None, None, None, None]
    assert column(spark, ["https://x", "http://x", "ftp://x", "", None], text.is_url) == [True, True, False, False, False]


def test_name_text(spark):
    rows = spark.createDataFrame([(" A b ", "x"), ("  ", " x "), (None, "y"), (None, None)], "gn string, plain string")
    assert [r.t for r in rows.select(text.name_text(F.col("gn"), F.col("plain")).alias("t")).collect()] == ["A b", " x ", "y", None]


@pytest.mark.parametrize(
    ("name", "simple", "stem", "cardinality", "year"),
    [
        ("Rosa", "Rosa", None, 1, None),
        ("Rosa alba L., 1753", "Rosa alba", "Rosa alb", 2, 1753),
        ("Bixitiites noensis (Brüskel, 1869)", "Bixitiites noensis", "Bixitiites noens", 2, 1869),
        ("Docotaaria gajomaifera f. juiana Wucoeff & Jipowald, 1962", "Docotaaria gajomaifera juiana", "Docotaaria gajomaifer juian", 3, 1962),
        ("Xucixeites niruensis var. daum Tazesen", "Xucixeites niruensis daum", "Xucixeites niruens da", 3, None),
        ("Mugufaites lavua foramiifera", "Mugufaites lavua foramiifera", "Mugufaites lavu foramiifer", 3, None),
        ("Dadaman fonezaum Sefes in Cobili 1790", "Dadaman fonezaum", "Dadaman foneza", 2, 1790),
        ("Badusua sp. G650", "Badusua", None, None, None),
        ("Tobacco mosaic virus", None, None, None, None),
        ("", None, None, None, None),
        (None, None, None, None, None),
    ],
)
def test_parsed_names(spark, name, simple, stem, cardinality, year):
    r = parse.parse(spark.createDataFrame([(name,)], "name string")).first()
    assert (r.parsed_simple, r.parsed_stem, r.parsed_cardinality, r.parsed_year) == (simple, stem, cardinality, year)


def test_words(spark):
    df = spark.createDataFrame([("1", "Rosa alba (Brüskel, 1869) Newueff"), ("2", "Rosa sp. X"), ("3", "Rosa × alba")], "id string, name string")
    assert {(r.id, r.normalized, r.modified, r.type_id) for r in parse.words(df).collect()} == {("1", "alba", "alb", 2), ("1", "Brüskel", "brüskel", 4), ("1", "Newueff", "newueff", 4)}


def test_words_behind_a_subgenus(spark):
    df = spark.createDataFrame([("1", "Aus (Bus) cus Smith, 1900"), ("2", "Aus (Bus) Smith"), ("3", "Aus sect. Bus Jones"), ("4", "Aus cus Smith var. dus (Lee) Kim")], "id string, name string")
    of = lambda code=None: {i: {r.normalized for r in parse.words(df, code=code).collect() if r.id == i} for i in "1234"}
    assert of() == {"1": {"cus", "Smith"}, "2": {"Smith"}, "3": {"Jones"}, "4": {"cus", "dus", "Smith", "Lee", "Kim"}}
    assert of(F.lit(2))["2"] == {"Bus", "Smith"}
    canonical = {r.canonical_id for r in parse.words(df).where("id = '1'").collect()}
    assert canonical == {parse.parse(df).where("id = '1'").first().parsed_simple_id}


def test_codes_in_parsing(spark):
    df = spark.createDataFrame([("Aus bus", c) for c in (None, 0, 1, 2, 3, 4, 9)], "name string, code int")
    got = [(r.parsed_simple, r.parsed_virus, r.parsed_bacteria) for r in parse.parse(df, code=F.col("code")).orderBy(F.col("code").asc_nulls_first()).collect()]
    assert got == [("Aus bus", False, False)] * 4 + [("Aus bus", False, True), (None, True, False), ("Aus bus", False, False)]


def test_changed(spark):
    from taxaloom.functions.ids import uuid5

    rows = [("same", "Aus bus", False, False, False, 1), ("nulls", "Aus bus", None, None, None, 1), ("bact", "Eus bus", False, False, False, 1), ("eus", "Eus cus", False, True, False, 1), ("unparsed", "??", False, False, False, 0),
            ("was", "??", False, False, False, 1), ("virus", "Xus virus", None, False, False, 0), ("known", "Xus virus", True, False, False, 0), ("sur", "Aus sp.", False, False, False, 1)]
    df = spark.createDataFrame(rows, "id string, name string, virus boolean, bacteria boolean, surrogate boolean, parse_quality int").withColumn("canonical_id", uuid5(F.col("name")))
    df = df.union(df.where("id = 'eus'").withColumn("id", F.lit("eus2"))).withColumn("canonical_id", F.when(F.col("id") == "sur", uuid5(F.lit("Aus"))).when(F.col("id") == "same", F.upper("canonical_id")).otherwise(F.col("canonical_id")))
    got = {r.id for r in parse.changed(parse.with_bacteria(parse.parse(df), parse.bacterial_genera(df))).collect()}
    assert got == {"bact", "virus", "sur"}  # null flags are false; an unparsed name only counts if its virus flag differs
    assert parse.changed(parse.with_bacteria(parse.parse(df.limit(0)), parse.bacterial_genera(df.limit(0)))).collect() == []


def test_every_author_is_a_word(spark):
    """However many authors a name has; a null name has none."""
    authors = [f"A{chr(97 + k // 26)}{chr(97 + k % 26)}son" for k in range(150)]
    df = spark.createDataFrame([("1", "Rosa alba " + ", ".join(authors)), ("2", None)], "id string, name string")
    assert {r.normalized for r in parse.words(df).collect()} == {"alba", *authors}


def test_not_in(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    of = lambda *v: sorted(map(str, (r.x for r in names.not_in(left, "x", spark.createDataFrame([(x,) for x in v], "y string"), "y").collect())))
    assert of("a") == ["b"] and of("a", None) == [] and of() == ["None", "a", "b"]


def test_absent(spark):
    new = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b")], "id string, name string")
    have = names.absent(new, new.limit(0), ["id"])
    assert have.count() == 2 and names.absent(new, have, ["id"]).count() == 0


def taxa(spark, rows):
    flat = "".join(f", col__{r} string, sf__{r}_id string" for r in codes.GIVEN_RANKS)
    df = spark.createDataFrame(rows, "data_source_id int, col__id string, col__parent_id string, col__scientific_name string, col__rank_id string, kingdom string, family string")
    for r in codes.GIVEN_RANKS:
        df = df.withColumns({f"col__{r}": F.col(r) if r in ("kingdom", "family") else F.lit(None).cast("string"), f"sf__{r}_id": F.lit("1" if r == "kingdom" else "2")})
    assert flat
    return df.drop("kingdom", "family").withColumn("loaded_at", F.lit(None).cast("timestamp_ntz"))


def test_breadcrumbs(spark):
    df = taxa(spark, [(1, "1", None, "Plantae", "KINGDOM", "Plantae", "Rosaceae"), (1, "2", "1", "Rosaceae", "family", "Plantae", "Rosaceae"), (1, " 3 ", "2", "Rosa", "genus", "Plantae", "Rosaceae"), (1, "x", "y", None, None, None, None), (1, "y", "x", "Y", "genus", None, None)])
    got = {r.id: (r.names, r.ranks, r.ids) for r in classification.breadcrumbs(df).collect()}
    assert got["3"] == ("Plantae|Rosaceae|Rosa", "kingdom|family|genus", "1|2|3")
    assert got["1"] == ("Plantae|Rosaceae|Plantae", "kingdom|family|kingdom", "1|2|1")
    assert got["x"] == ("", "", "")
    flat = {r.id: r.names for r in classification.breadcrumbs(df, prefer_flat=True).collect()}
    assert flat["3"] == "Plantae|Rosaceae"
    by_source = {r.id: r.names for r in classification.breadcrumbs(df, F.col("data_source_id") == 2).collect()}
    assert by_source["3"] == "Plantae|Rosaceae|Rosa"


RANKS = "data_source_id int, record_id string, code_id int, classification string, classification_ranks string, classification_ids string"


def test_unfolded(spark):
    rows = [
        (1, "a", 0, "P|R|R2", "kingdom|family|family", "1|2|3"), (1, "b", None, None, "", None), (1, "c", 0, "P", "kingdom", "1"), (1, "d", 0, "", "kingdom", "1|2|3"),
        (1, "e", 0, "A|B|C|D", "kingdom|SubClass|section|family", "1|2|3|4"), (1, "f", 0, "Animalia|Felidae|Felinae|Felis", "", "1|2"), (1, "g", 2, "Xinae|Yina|Zus", None, ""),
        (1, "h", 0, "Felidae|Xinae|Yina", "", None), (1, "i", 0, "A", "kingdom|phylum", "1|2"), (1, "j", 0, "A|B", "kingdom", "1|"),
    ]
    dictionary = spark.createDataFrame([("Animalia", "kingdom", "iczn"), ("Felis", "genus", "iczn"), ("Zus", "section", "icn")], "name string, rank string, code string")
    made = classification.unfolded(spark.createDataFrame(rows, RANKS), dictionary)
    assert len(made.columns) == 33 and "name_subclass" in made.columns and "name_section" not in made.columns
    got = {r.record_id: {k: v for k, v in r.asDict().items() if v is not None and k not in ("data_source_id", "record_id")} for r in made.collect()}
    assert got["a"] == {"name_kingdom": "P", "id_kingdom": "1", "name_family": "R2", "id_family": "3", "parent_id": "2"}
    assert got["b"] == got["d"] == {} and got["c"] == {"name_kingdom": "P", "id_kingdom": "1"}
    assert got["e"] == {"name_kingdom": "A", "id_kingdom": "1", "name_subclass": "B", "id_subclass": "2", "name_family": "D", "id_family": "4", "parent_id": "3"}
    assert got["f"] == {"name_kingdom": "Animalia", "id_kingdom": "1", "name_family": "Felidae", "id_family": "2", "name_subfamily": "Felinae", "name_genus": "Felis", "parent_id": "1"}
    assert got["g"] == {"name_subtribe": "Xinae"}  # botany; Zus has a rank that an export lacks
    assert got["h"] == {"name_family": "Felidae", "name_subfamily": "Xinae", "name_subtribe": "Yina"}  # zoology by vote
    assert got["i"] == {"name_kingdom": "A", "id_kingdom": "1", "parent_id": "1"} and got["j"] == {"name_kingdom": "A", "id_kingdom": "1", "parent_id": "1"}
    assert classification.unfolded(spark.createDataFrame(rows[:0], RANKS), dictionary).collect() == []
    without = classification.unfolded(spark.createDataFrame(rows, RANKS), dictionary.limit(0)).where("record_id = 'f'").first()
    assert (without.name_kingdom, without.name_family, without.name_subfamily, without.name_genus) == (None, "Felidae", "Felinae", None)


def test_votes_of_the_dictionary(spark):
    rows = spark.createDataFrame([("Animalia|Rosaceae",), ("Xus|Rosaceae",), ("Odd|Felidae",), ("Odd",), ("",), (None,), ("Odd",)], "classification string")
    dictionary = spark.createDataFrame([("Animalia", "kingdom", "iczn"), ("Xus", "genus", "iczn"), ("Odd", "genus", None)], "name string, rank string, code string")
    assert {r.classification: r.code for r in classification.votes(rows, dictionary).collect()} == {"Animalia|Rosaceae": 0, "Xus|Rosaceae": 0, "Odd|Felidae": 1, "Odd": 0}


def test_languages(spark):
    ref = spark.createDataFrame([("eng", "en", "English"), ("deu", "de", "German"), ("haw", None, "Hawaiian")], "lang_code string, lang_code2 string, language string")
    rows = [("en", ""), ("xx", ""), ("deu", None), ("German", ""), ("Klingon", "TLH"), (None, None), ("haw", "HAW")]
    df = spark.createDataFrame([(k, *r, "") for k, r in enumerate(rows)], "k int, language string, lang_code string, language_orig string")
    got = [(r.language_orig, r.language, r.lang_code) for r in vernacular.normalised(df, ref).orderBy("k").collect()]
    assert got == [("en", "English", "eng"), ("xx", "xx", ""), ("deu", "German", "deu"), ("German", "German", "deu"), ("Klingon", "Klingon", "tlh"), (None, None, None), ("haw", "Hawaiian", "haw")]


def test_verification_counts_null_flags_as_sql_does(spark):
    ns = [("1", True, None, False, False), ("2", True, False, None, False), ("3", False, True, None, None), ("4", True, False, False, True)]
    names_df = spark.createDataFrame([(i, i, None, None, "c" if c else None, v, b, s, 3) for i, c, v, s, b in ns], "id string, name string, year short, cardinality int, canonical_id string, virus boolean, bacteria boolean, surrogate boolean, parse_quality int")
    idx = spark.range(1, 5).select(F.lit(1).alias("data_source_id"), F.col("id").cast("string").alias("record_id"), F.col("id").cast("string").alias("name_string_id"), F.lit("1").alias("accepted_record_id"), *(F.lit(None).cast("string").alias(c) for c in ("outlink_id", "name_id", "local_id", "code_id", "taxonomic_status", "classification", "classification_ids", "classification_ranks")))
    got = verification.verification(idx, names_df)
    assert got.columns == verification.COLUMNS and {r.name_string_id: r.accepted_name for r in got.collect()} == {"1": "1", "3": "1"}


def test_updates_and_sources(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "z")], "data_source_id int, id string, v string")
    new = spark.createDataFrame([("b", "y"), ("a", None)], "id string, v string")
    assert sorted(map(tuple, maintain.updated(rows, new, "id", ["v"]).collect()), key=str) == [(1, "a", None), (2, "b", "y"), (3, None, "z")]
    assert [r.data_source_id for r in maintain.without_sources(rows, [1, 3]).collect()] == [2]
    assert maintain.without_sources(rows, []).count() == 3
    assert sorted(r.id for r in maintain.replaced(rows, rows.where("data_source_id = 1").withColumn("id", F.lit("new"))).where("id is not null").collect()) == ["b", "new"]
    assert [r.id for r in maintain.page(rows, ["data_source_id", "id"], [1, "a"], 1).collect()] == ["b"]


def test_schema_changes(spark):
    now = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    then = StructType([StructField("a", LongType()), StructField("c", StringType())])
    assert maintain.schema_changes(now, then) == ["add c string", "drop b", "change a int to bigint"]
    assert maintain.migrated(spark.createDataFrame([(1, "x")], now), then).collect() == [(1, None)]


def test_versions(spark, tmp_path):
    df = spark.range(5).withColumn("s", F.col("id") % 2)
    first = maintain.swap(df, str(tmp_path), ["s"])
    second = maintain.swap(df.where("s = 1"), str(tmp_path), ["s"])  # a source that is now empty is gone
    assert first != second and maintain.current(spark, str(tmp_path)).select("s").distinct().count() == 1


def test_export_names(spark):
    idx = spark.createDataFrame([(1, "r1", "n", None, None, 0, "SPECIES"), (1, "r2", "n", "o", None, 0, "genus"), (1, "r3", "n", "", None, 0, "x")], "data_source_id int, record_id string, name_string_id string, outlink_id string, accepted_record_id string, code_id int, rank string")
    ns = spark.createDataFrame([("n", "Rosa"), ("n", "Rosa")], "id string, name string")
    assert [(r.record_id, r.alternative_id) for r in export.export_names(idx, ns).collect()] == [("r3", None)]
    base = spark.range(1).select(export.base_name(F.lit(1), F.lit("CoL"), F.lit("2025-08-25"), F.lit(None).cast("timestamp")).alias("a"), export.base_name(F.lit(12345), F.lit(""), F.lit(""), F.lit("2024-02-03").cast("timestamp")).alias("b")).first()
    assert tuple(base) == ("0001-col-2025-08-25", "1234-source-2024-02-03") or tuple(base) == ("0001-col-2025-08-25", "12345-source-2024-02-03")


def test_compared(spark):
    a = spark.createDataFrame([(1, "s"), (1, "s"), (None, None)], "k int, t string")
    b = spark.createDataFrame([(1, "s"), (2, "u")], "k int, t string")
    assert {(r.k, r.t, r.n_a, r.n_b, r.same) for r in audit.compared_counts(a, b, ["k", "t"]).collect()} == {(1, "s", 2, 1, False), (None, None, 1, 0, False), (2, "u", 0, 1, False)}
    s = audit.compared_samples(a, b, "k", ["t"], [], 5)
    assert {(r.k, r.place, r.same) for r in s.collect()} == {(1, 1, True), (1, 2, False), (None, 1, False), (2, 1, False)}
    assert {(r.k, r.same) for r in audit.summary(s, "k").collect()} == {(1, False), (None, False), (2, False)}


def test_stored_lookup_table(spark):
    view = spark.range(100).select(F.col("id").cast("string").alias("canonical_id"), F.col("id").alias("n"))
    verification.write_verification(view, "stored_view", buckets=4)
    maintain.statistics(spark, "stored_view")
    stored = spark.table("stored_view")
    plan = stored.groupBy("canonical_id").count()._jdf.queryExecution().toString()
    assert stored.count() == 100 and "Exchange hashpartitioning(canonical_id" not in plan
    assert verification.lookup(stored, spark.createDataFrame([("7",), (None,), ("x",)], "canonical_id string"), "canonical_id").count() == 1
    spark.sql("drop table stored_view")
