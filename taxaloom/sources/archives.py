"""Archives of data sources: which files belong to a source, which one is the latest, what their names tell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.text import file_date, file_priority, file_version


def described(files: DataFrame, name: str = "file") -> DataFrame:
    """Files that are archives, with the source they belong to, date, version and priority of their ending.

    A name starts with the source's number, with or without leading zeros (four digits at most), and ``-``, ``_`` or ``.``.
    """
    f = F.col(name)
    source = F.regexp_extract(f, r"^0{0,3}([1-9]\d{0,3})[-_.]", 1)
    rows = files.withColumns({"source": source.try_cast("int"), "date": file_date(f), "version": file_version(f), "priority": file_priority(f)})
    return rows.where("priority > 0 and source is not null")


def latest(files: DataFrame, name: str = "file") -> DataFrame:
    """The file to take for each source: the latest date (undated ones lose), then the preferred ending; with the number of candidates."""
    rows = described(files, name).groupBy("source").agg(F.max(F.struct("date", "priority", F.col(name).alias("file"))).alias("best"), F.count(F.lit(1)).alias("n_files"))
    return rows.select("source", "best.file", "best.date", "n_files")
