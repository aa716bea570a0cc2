"""The queries on text over the smallest tables: columns, keys and what the tables themselves tell."""

import os

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import queries
from taxaloom.session import table

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p5_found": "data_source_id int, record_id string, vernacular_string_id string, lang_code string",
    "p5_unmatched": "language string, lang_code string, n_rows bigint",
    "p7_found": "tab string, id_a string, id_b string",
    "p7_forms": "tab string, id string, name string, form string",
    "p7_classes": "tab string, id string, class_id string, n_alike bigint",
    "p8_ids": "doc_id bigint, ids array<int>",
    "p9_mix": "doc_id bigint, source string, n_tokens bigint, uses bigint",
    "p9_shares": "source string, target_share double, weight double, n_docs bigint, n_uses bigint, most_uses bigint, n_tokens bigint, share double",
    "p9_tempered": "source string, target_share double, weight double, n_docs bigint, n_uses bigint, most_uses bigint, n_tokens bigint, share double",
    "p10_found": "doc_id bigint",
    "p10_scores": "doc_id bigint, source string, score double, offensive boolean",
    "p10_rates": "source string, n_docs bigint, n_offensive bigint, rate double",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    df.write.format("noop").mode("overwrite").save()


def test_every_document_comes_out(spark):
    n = table(spark, SF, "documents").count()
    assert queries.p8_ids(spark, SF).count() == n and queries.p10_scores(spark, SF).count() == n
    assert queries.p10_rates(spark, SF).agg(F.sum("n_docs")).first()[0] == n


def test_languages_of_exact_rows_stay_out(spark):
    typed = table(spark, SF, "vernacular_string_indices")
    exact = typed.join(table(spark, SF, "languages"), ["language", "lang_code"], "left_semi").count()
    blank = typed.where("coalesce(trim(language), '') = '' and coalesce(trim(lang_code), '') = ''").count()
    assert queries.p5_found(spark, SF).count() <= typed.count() - exact - blank
