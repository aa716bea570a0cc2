import pytest

from taxaloom.operators import packed
from taxaloom.operators.packed import split_values

SCHEMA = "data_source_id int, record_id string, c string, r string, i string"
FIELDS = ["c", "r", "i"]


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("A|B|C", ["A", "B", "C"]),
        ("A | B |C ", ["A", "B", "C"]),
        ("A;B; C", ["A", "B", "C"]),
        ("A::tx:1::B", ["A", "tx:1", "B"]),
        ("A > B|C;D¦E", ["A", "B", "C", "D", "E"]),
        ("A\tB\t", ["A", "B"]),
        ("A|B|", ["A", "B"]),
        ("A||B", ["A", "", "B"]),
        ("A||", ["A", ""]),
        ('"A, x","B ""minor""",C', ["A, x", 'B "minor"', "C"]),
        ("'A';'B | s.l.'", ["A", "B | s.l."]),
        ('A|B "x"|C', ["A", 'B "x"', "C"]),
        ('"A|B', ['"A', "B"]),
        ("A|X, incertae sedis|B", ["A", "X, incertae sedis", "B"]),
        ("A|X/Y group|B", ["A", "X/Y group", "B"]),
        ("A / B", ["A", "B"]),
        ("A", ["A"]),
        (" ", []),
        ("", []),
        (None, []),
    ],
)
def test_values(text, values):
    assert split_values([text])[0] == values


def test_the_dictionary_protects_marks():
    assert split_values(["A, X, incertae sedis, B"])[0] == ["A", "X", "incertae sedis", "B"]
    assert split_values(["A, X, incertae sedis, B"], ["X, incertae sedis"])[0] == ["A", "X, incertae sedis", "B"]
    assert split_values(["A;X; unplaced;B"], ["X; unplaced"])[0] == ["A", "X; unplaced", "B"]


def test_the_other_fields_decide():
    assert split_values(["A, B, C/D group", "k;f;g"])[0] == ["A", "B", "C/D group"]
    assert split_values(["A|B, C", "k;f;g"])[0] == ["A", "B", "C"]


def test_rows(spark):
    rows = [
        (1, "a", "A|X; unplaced|B".replace("X; unplaced", '"X; unplaced"'), "k;f;g", "1|2|3"),
        (1, "a", "A|X, incertae sedis|B", "k|f|g", "1|2|3"),
        (1, "b", "A;X, incertae sedis;B", None, ""),
        (None, None, "A|B", "k|f", " "),
        (2, "long", "|".join(["v"] * 5000) + "|", None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' pos", "'y' field", "'z' value", "1 _row")
    keys = ["data_source_id", "record_id"]
    odd = {(r.data_source_id, r.record_id, r.field, r.pos, r.value) for r in packed.values(df, keys, FIELDS, only_untidy=True).collect()}
    assert odd == {
        (1, "a", "c", 1, "A"), (1, "a", "c", 2, "X; unplaced"), (1, "a", "c", 3, "B"), (1, "a", "r", 1, "k"), (1, "a", "r", 2, "f"), (1, "a", "r", 3, "g"),
        (1, "b", "c", 1, "A"), (1, "b", "c", 2, "X, incertae sedis"), (1, "b", "c", 3, "B"),
        *((2, "long", "c", k, "v") for k in range(1, 5001)),
    }
    every = packed.values(df, keys, FIELDS).collect()
    assert len(every) == 9 + 9 + 3 + 4 + 5000
    assert packed.values(df.limit(0), keys, FIELDS).collect() == []


def test_tidy_fields_are_never_odd(spark):
    """What the built-in path takes as it stands is what the segmentation gives."""
    texts = ["A|B", "A||B", "|A", "A, x|B", "A/B|C", "A:b|C", "a b|c d", "A|B|", "A |B", " A|B", '"A"|B', "A,B", "A", "A/B", "A|'B'", "x|y\t", "A |B"]
    df = spark.createDataFrame([(t,) for t in texts], "c string").withColumn("u", packed.untidy(__import__("pyspark.sql.functions", fromlist=["col"]).col("c")))
    for r in df.collect():
        if not r.u:
            assert "|".join(split_values([r.c])[0]) == r.c, r.c


def test_a_null_field_beside_unequal_counts(spark):
    """With one null field, no comma or slash, and unequal counts in the others, all values come out."""
    rows = [(1, "n", "A|B|C", "k|f", None), (1, "m", None, "k|f", "1"), (1, "e", "A|B|C", "k|f", ""), (1, "s", "A|B, x|C", "k|f", None), (1, "0", None, None, None)]
    got = sorted((r.record_id, r.field, r.pos, r.value) for r in packed.values(spark.createDataFrame(rows, SCHEMA), ["data_source_id", "record_id"], FIELDS).collect())
    three, two = [("c", 1, "A"), ("c", 2, "B"), ("c", 3, "C")], [("r", 1, "k"), ("r", 2, "f")]
    want = [("n", *v) for v in three + two] + [("e", *v) for v in three + two] + [("m", *v) for v in [*two, ("i", 1, "1")]]
    assert got == sorted([*want, ("s", "c", 1, "A"), ("s", "c", 2, "B, x"), ("s", "c", 3, "C"), *(("s", *v) for v in two)])


def test_blanks_of_every_kind_reach_the_segmentation(spark):
    """Whatever is trimmed around values and quotes makes a field untidy."""
    from taxaloom.functions.ids import BLANKS

    rows, want = [], set()
    for c in BLANKS:
        for k, (text, values) in enumerate(
            [(f"A{c}|B", "AB"), (f"A|{c}B", "AB"), (f"{c}A|B", "AB"), (f"A|B{c}", "AB"), (f'A|{c}"B, c"', ["A", "B, c"]), (f'{c}"A"|B', "AB"), (f"A|{c}'B'{c}|C", "ABC"), (f"A|B|{c}", ["A", "B", ""]), (c, [])]
        ):
            if c == "\t":
                continue  # a delimiter too
            rows.append((ord(c), str(k), text, None, None))
            want |= {(ord(c), str(k), p, v) for p, v in enumerate(values, 1)}
    got = packed.values(spark.createDataFrame(rows, SCHEMA), ["data_source_id", "record_id"], FIELDS, only_untidy=True).collect()
    assert {(r.data_source_id, r.record_id, r.pos, r.value) for r in got} == want
