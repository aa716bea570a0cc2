"""References to records that do not exist.

Parent keys are turned into integers within a key space (UUIDs by their leading 60 bits, record ids by the number at
their end, the text before it being part of the space). The sorted integers of a space are compressed into runs of
consecutive numbers. A reference is matched as of its number to the run that starts at or before it; beyond the run's
end its parent is missing. A run also knows from when on all its keys are valid; references that are older than that,
or whose remaining digits differ, are checked exactly against the parents.

Defined cases: null, blank and all-zero ids refer to nothing; parents that are deleted are no parents; of several valid
rows of a parent the earliest counts; a parent without ``loaded_at`` was always there, a reference without one is the
latest of all; references of deleted rows count; repeated references come out once; empty tables are fine on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.functions.ids import bare_uuid, clean_id, dashed

UUID_SHIFT, NUMBER_SHIFT = 44, 16
KEY = ["space", "num", "rest"]


def uuid_key(space: str, c: Column) -> list[Column]:
    """Space, leading 60 bits and remaining digits of a UUID; text that is no UUID is a space of its own."""
    plain = F.lower(F.btrim(c))
    digits = F.when(plain.rlike(r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"), F.translate(plain, "-", "")).otherwise(bare_uuid(c))
    number = F.conv(F.substring(digits, 1, 15), 16, 10).cast("long")
    return [
        F.when(digits.isNotNull(), F.lit(space)).otherwise(F.lit(f"{space}?")).alias("space"),
        F.coalesce(number, F.lit(0).cast("long")).alias("num"),
        F.when(digits.isNotNull(), F.substring(digits, 16, 17)).otherwise(F.coalesce(clean_id(c), F.lit(""))).alias("rest"),
    ]


def record_key(group: Column, c: Column) -> list[Column]:
    """Space (group, text before the number, number of digits), number; an id of which no number can be read is its own space."""
    whole = F.coalesce(clean_id(c), F.lit(""))
    digits = F.regexp_extract(whole, r"([0-9]{1,18})\z", 1)
    head = F.substring(whole, F.lit(1), F.length(whole) - F.length(digits))
    return [
        F.concat_ws("\x1f", group.cast("string"), head, F.length(digits).cast("string")).alias("space"),
        F.coalesce(F.nullif(digits, F.lit("")).cast("long"), F.lit(0).cast("long")).alias("num"),
        F.lit("").alias("rest"),
    ]


def key_text(space: Column, num: Column, rest: Column) -> Column:
    """The UUID that ``uuid_key`` took apart, or the text that was none."""
    return F.when(space.endswith("?"), rest).otherwise(dashed(F.concat(F.lower(F.lpad(F.hex(num), 15, "0")), rest)))


def refers(c: Column) -> Column:
    """Whether an id refers to anything."""
    return F.coalesce(~F.coalesce(clean_id(c), F.lit("")).rlike(r"\A(urn:uuid:)?[{}0-]*\z"), F.lit(False))


def valid_parents(rows: DataFrame) -> DataFrame:
    """From ``space, num, rest, shift, loaded_at, deleted_at``: each key that has a valid row, and since when."""
    since = F.coalesce("loaded_at", F.lit("0001-01-01").cast("timestamp_ntz"))
    return rows.where("deleted_at is null").groupBy(*KEY, "shift").agg(F.min(since).alias("since"))


def runs(parents: DataFrame) -> DataFrame:
    """Runs of consecutive numbers in each space: ``space, cell, start, stop, all_since, only`` (``only``: the digits all its keys share)."""
    cells = parents.select("*", F.expr("shiftright(num, shift)").alias("cell"))
    order = Window.partitionBy("space", "cell").orderBy("num")
    fresh = F.coalesce((F.col("num") - F.lag("num").over(order) > 1).cast("int"), F.lit(1))
    marked = cells.select("space", "cell", "num", "rest", "since", fresh.alias("fresh"))
    marked = marked.withColumn("run", F.sum("fresh").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    only = F.when(F.min("rest") == F.max("rest"), F.min("rest"))
    return marked.groupBy("space", "cell", "run").agg(F.min("num").alias("start"), F.max("num").alias("stop"), F.max("since").alias("all_since"), only.alias("only")).drop("run")


def dangling(refs: DataFrame, parent_rows: DataFrame) -> DataFrame:
    """The rows of ``refs`` (``space, num, rest, shift, at`` and others) of which no parent was valid at ``at``."""
    parents = valid_parents(parent_rows)
    first = refs.groupBy(*KEY, "shift").agg(F.min("at").alias("first_at"))
    first = first.select(*KEY, F.expr("shiftright(num, shift)").alias("cell"), "first_at")
    starts = runs(parents).select("space", "cell", F.col("start").alias("num"), F.lit(0).alias("kind"), F.struct("stop", "all_since", "only").alias("run"), F.lit(None).cast("string").alias("rest"), F.lit(None).cast("timestamp_ntz").alias("first_at"))
    asked = first.select("space", "cell", "num", F.lit(1).alias("kind"), F.lit(None).cast(starts.schema["run"].dataType).alias("run"), "rest", "first_at")
    as_of = Window.partitionBy("space", "cell").orderBy("num", "kind").rowsBetween(Window.unboundedPreceding, 0)
    matched = starts.unionByName(asked).withColumn("run", F.last("run", ignorenulls=True).over(as_of)).where("kind = 1")
    beyond = F.coalesce(F.col("run.stop") < F.col("num"), F.lit(True))
    covered = F.coalesce((F.col("run.only") == F.col("rest")) & (F.col("run.all_since") <= F.col("first_at")), F.lit(False))
    open_keys = matched.where(beyond | ~covered).select(*KEY, beyond.alias("beyond"))
    exact = open_keys.join(parents.select(*KEY, "since"), KEY, "left")  # missing and late keys only
    bad = exact.select(*KEY, F.when(F.col("beyond"), F.lit(None)).otherwise(F.col("since")).alias("since"))
    return refs.join(bad, KEY).where("since is null or at < since").drop("since")


def catalogue_orphans(indices: DataFrame, names: DataFrame, canonicals: DataFrame) -> DataFrame:
    """Dangling references of the catalogue: ``tab, field, row_key, ref_id, month`` (of the referring row's ``loaded_at``)."""
    late = F.coalesce("loaded_at", F.lit("9999-12-31").cast("timestamp_ntz")).alias("at")
    month = F.date_format("loaded_at", "yyyy-MM").alias("month")
    record = F.concat_ws("/", F.col("data_source_id").cast("string"), F.coalesce(clean_id(F.col("record_id")), F.lit(""))).alias("row_key")
    uuid_shift, number_shift = F.lit(UUID_SHIFT).alias("shift"), F.lit(NUMBER_SHIFT).alias("shift")
    tab, field = lambda x: F.lit(x).alias("tab"), lambda x: F.lit(x).alias("field")
    text = F.lit(None).cast("string").alias("ref_text")
    as_key = uuid_key("key", F.col("id"))
    own = F.when(as_key[0].endswith("?"), as_key[2]).otherwise(dashed(F.concat(F.lower(F.lpad(F.hex(as_key[1]), 15, "0")), as_key[2]))).alias("row_key")
    refs = (
        indices.where(refers(F.col("name_string_id"))).select(*uuid_key("name", F.col("name_string_id")), uuid_shift, late, month, tab("name_string_indices"), field("name_string_id"), record, text)
        .unionByName(indices.where(refers(F.col("accepted_record_id")) & ~clean_id(F.col("accepted_record_id")).eqNullSafe(clean_id(F.col("record_id")))).select(*record_key(F.col("data_source_id"), F.col("accepted_record_id")), number_shift, late, month, tab("name_string_indices"), field("accepted_record_id"), record, clean_id(F.col("accepted_record_id")).alias("ref_text")))
        .unionByName(names.where(refers(F.col("canonical_id"))).select(*uuid_key("canonical", F.col("canonical_id")), uuid_shift, late, month, tab("name_strings"), field("canonical_id"), own, text))
    )
    kept = ["loaded_at", "deleted_at"]
    parents = (
        names.where(F.col("id").isNotNull()).select(*uuid_key("name", F.col("id")), uuid_shift, *kept)
        .unionByName(canonicals.where(F.col("id").isNotNull()).select(*uuid_key("canonical", F.col("id")), uuid_shift, *kept))
        .unionByName(indices.where(F.col("record_id").isNotNull()).select(*record_key(F.col("data_source_id"), F.col("record_id")), number_shift, *kept))
    )
    found = dangling(refs, parents)
    ref = F.coalesce("ref_text", key_text(F.col("space"), F.col("num"), F.col("rest"))).alias("ref_id")
    return found.select("tab", "field", "row_key", ref, "month")
