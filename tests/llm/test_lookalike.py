import itertools
import unicodedata

from taxaloom.llm import lookalike
from taxaloom.llm.lookalike import mapping

SAME = [
    ("Rosa", ["Ｒｏｓａ", "R​osa", "Rоsa", " Rosa ", "Ro­sa", "Rosa️", "Rοsa"]),
    ("Lewiés", ["Lewiés", "Lewiés‎", "Lеwiés"]),
    ("ﬁnal oﬀ".replace("ﬁ", "fi").replace("ﬀ", "ff"), ["ﬁnal oﬀ"]),
    ("ガク", ["ｶﾞｸ", "ガク"]),
    ("ệ", ["ệ", "ệ"]),
    ("ニロ", ["二口"]),
    ("a-b", ["a‑b", "a‐b", "ａ－ｂ"]),
]
OTHER = ["rosa", "Rosá", "Ro sa", "Rosa.", "Rosa²", "Lewies", "ﬁ ﬀ", "カク", "a–b", "x", "×"]


def test_forms(spark):
    texts = [x for a, b in SAME for x in (a, *b)] + OTHER + [None, "", "  ", "é" * 5000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] * 2, "at int, name string").selectExpr("*", "'x' form", "'y' ch", "1 parts")
    rows = lookalike.same_look(df, "name").collect()
    got = {r["name"]: r.form for r in rows}
    assert len(rows) == 2 * len(texts)
    for a, b in SAME:
        assert {got[x] for x in b} == {got[a]}, (a, [got[x] for x in b])
    firsts = [got[a] for a, _ in SAME] + [got[x] for x in OTHER]
    assert len(set(firsts)) == len(firsts)
    assert (got[None], got[""], got["  "], got["é" * 5000]) == (None, "", "", "é" * 5000)
    assert lookalike.same_look(df.limit(0), "name").collect() == []


def test_forms_equal_a_plain_version(spark):
    """The joined and ordered form is what mapping each character and recomposing gives."""
    pool = ["a", "e", "о", "ẹ́", "̂", "Ａ", "ﬃ", "​", "ё", "й", "ﾊ", "ﾟ", " ", "　", "🙂", "각", "Ǆ", "ÅΩ"]
    texts = ["".join(p) for p in itertools.product(pool, repeat=3)]
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    plain = lambda t: unicodedata.normalize("NFC", "".join(mapping().get(c, c) for c in t)).strip(" ")
    assert all(r.form == plain(r["name"]) for r in lookalike.same_look(df, "name").collect())


def test_pairs(spark):
    rows = [("n", "1", "A"), ("n", "2", "A"), ("n", "2", "A"), ("n", "3", "A"), ("v", "4", "A"), ("n", "5", None), ("n", None, "A"), ("v", "6", "B")]
    df = spark.createDataFrame(rows, "tab string, id string, form string")
    assert {tuple(r) for r in lookalike.pairs(df).collect()} == {("n", "1", "2"), ("n", "1", "3"), ("n", "2", "3")}
    assert lookalike.pairs(df.limit(0)).collect() == []


def test_published_look_alikes(spark):
    """Letters of scripts that aren't listed come from the published table; cased ones keep their case, listed scripts stay as listed."""
    alike = {"ꓐ": "B", "Ꮤ": "W", "ᗅ": "A", "Ꮃ": "W", "ꮩ": "v", "ⲟ": "o"}
    apart = ["г", "З", "з", "κ", "б", "Ы", "ß", "ا", "ع"]
    df = spark.createDataFrame([(x,) for x in [*alike, *apart]], "name string")
    got = {r["name"]: r.form for r in lookalike.same_look(df, "name").collect()}
    assert {x: got[x] for x in alike} == alike
    assert {x: got[x] for x in apart[:7]} == {x: x for x in apart[:7]}
    table = lookalike.published(spark)
    assert all(len(v) == 1 and v.isascii() and (unicodedata.category(k) == "Lo" or k.islower() == v.islower()) for k, v in table.items())


def test_marks_in_any_order(spark):
    """Marks of different classes behind a base may come in any order, over a long text too."""
    marks = ["̣", "̂", "̧", "́"]
    texts = ["".join("a" + "".join(p) for p in itertools.permutations(marks)), *("o" + "".join(p) + "x" for p in itertools.permutations(marks, 3)), "̣́a", "ẹ́" * 20_000]
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    for r in lookalike.same_look(df, "name").collect():
        assert r.form == unicodedata.normalize("NFC", r["name"])


def test_classes(spark):
    rows = [("n", "1", "A"), ("n", "2", "A"), ("n", "2", "A"), ("n", "3", "A"), ("v", "4", "A"), ("n", "5", None), ("n", None, "A"), ("v", "6", "B")]
    df = spark.createDataFrame(rows, "tab string, id string, form string")
    assert {tuple(r) for r in lookalike.classes(df).collect()} == {("n", i, "1", 2) for i in "123"}
    assert lookalike.classes(df.limit(0)).collect() == []
