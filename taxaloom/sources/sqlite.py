"""SQLite checklists as a Spark data source: ``spark.read.format("sqlite_table")`` with ``path`` and ``table``.

A table is split by ranges of row ids, so that its parts are read in parallel; the file must be in a folder all executors
see. Only the columns asked for are selected. Where ``spark.sql.python.filterPushdown.enabled`` is set, simple
comparisons are made by SQLite.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, In, InputPartition, IsNotNull, LessThan
from pyspark.sql.types import StructType


class _Range(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.columns, self.path, self.table = [f.name for f in schema], options["path"], options["table"]
        self.parts, self.where, self.values = int(options.get("parts", 4)), [], []

    def partitions(self) -> list[_Range]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            low, high = con.execute(f'select min(rowid), max(rowid) from "{self.table}"').fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = -(-(high - low + 1) // self.parts)
        return [_Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        names = ", ".join(f'"{c}"' for c in self.columns)
        where = " and ".join(["rowid >= ? and rowid < ?", *self.where])
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            yield from con.execute(f'select {names} from "{self.table}" where {where}', [partition.low, partition.high, *self.values])


class PushingReader(SqliteReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Takes comparisons of top-level columns; gives back the others."""
        signs = {EqualTo: "=", GreaterThan: ">", LessThan: "<"}
        for f in filters:
            column = f'"{f.attribute[0]}"' if len(getattr(f, "attribute", ())) == 1 else None
            if column and type(f) in signs:
                self.where.append(f"{column} {signs[type(f)]} ?")
                self.values.append(f.value)
            elif column and isinstance(f, IsNotNull):
                self.where.append(f"{column} is not null")
            elif column and isinstance(f, In) and f.value:
                self.where.append(f"{column} in ({', '.join('?' * len(f.value))})")
                self.values.extend(f.value)
            else:
                yield f


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as con:
            found = con.execute(f'pragma table_info("{self.options["table"]}")').fetchall()
        kinds = {"INTEGER": "bigint", "INT": "bigint", "REAL": "double", "BOOLEAN": "boolean"}
        wanted = self.options.get("columns")
        chosen = [c for c in found if wanted is None or c[1] in wanted.split(",")]
        return ", ".join(f"`{c[1]}` {kinds.get(c[2].upper(), 'string')}" for c in chosen)

    def reader(self, schema: StructType) -> SqliteReader:
        return (PushingReader if self.options.get("pushdown") == "true" else SqliteReader)(schema, dict(self.options))


def read(spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None, parts: int = 4) -> DataFrame:
    """One table of a checklist, or some of its columns; a missing file or table is an error."""
    spark.dataSource.register(SqliteTable)
    made = spark.read.format("sqlite_table").option("path", path).option("table", table).option("parts", parts)
    made = made.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    return (made.option("columns", ",".join(columns)) if columns else made).load()


def _statements(path: str) -> Iterator[str]:
    """The statements of an SQL dump one by one; the file isn't held whole."""
    lines: list[str] = []
    with open(path, encoding="utf-8") as f:
        for line in f:
            lines.append(line)
            if line.rstrip().endswith(";") and sqlite3.complete_statement(text := "".join(lines)):
                if text.strip().rstrip(";").strip().upper() not in ("BEGIN TRANSACTION", "BEGIN", "COMMIT"):
                    yield text
                lines = []
    if "".join(lines).strip():
        yield "".join(lines)


def opened(path: str, folder: str) -> str:
    """A plain SQLite file of an archive: as it is, unzipped, or made from an SQL dump, in ``folder``."""
    if path.endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            name = next(n for n in z.namelist() if n.endswith((".sqlite", ".sql")))
            path = z.extract(name, folder)
    if path.endswith(".sql"):
        made = Path(folder, Path(path).stem + ".sqlite")
        with sqlite3.connect(made) as con:
            for statement in _statements(path):
                con.execute(statement)
        path = str(made)
    return path


def write(df: DataFrame, path: str, table: str, batch: int = 10_000) -> int:
    """Writes a table of an export, row groups streaming through the driver; gives the number of rows."""
    names, n = ", ".join(f'"{c}"' for c in df.columns), 0
    with sqlite3.connect(path) as con:
        con.execute(f'create table "{table}" ({names})')
        rows: list[tuple] = []
        for r in df.toLocalIterator(prefetchPartitions=True):
            rows.append(tuple(r))
            if len(rows) == batch:
                n += con.executemany(f'insert into "{table}" values ({", ".join("?" * len(df.columns))})', rows).rowcount
                rows = []
        if rows:
            n += con.executemany(f'insert into "{table}" values ({", ".join("?" * len(df.columns))})', rows).rowcount
    return n


def write_each(df: DataFrame, folder: str, table: str, by: str = "data_source_id", batch: int = 10_000) -> DataFrame:
    """Writes one SQLite file ``<source>.sqlite`` for each source under a shared ``folder``, in tasks; gives ``by, n_rows``.

    A file has one writer, so a source is one task's work, but its rows stream through it in blocks. Each file is written
    under another name and renamed when it is whole, so that a task that is tried again replaces it.
    """
    columns = [c for c in df.columns if c != by]
    names, marks = ", ".join(f'"{c}"' for c in columns), ", ".join("?" * len(columns))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        now, con, part, n, done = None, None, None, 0, []

        def close() -> None:
            if con is not None:
                con.commit()
                con.close()
                os.replace(part, f"{folder}/{now}.sqlite")
                done.append((now, n))

        for pdf in batches:
            for source, rows in pdf.groupby(by, sort=True):
                if source != now:
                    close()
                    now, part, n = int(source), f"{folder}/.{int(source)}-{uuid.uuid4().hex}", 0
                    con = sqlite3.connect(part)
                    con.execute(f'create table "{table}" ({names})')
                values = rows[columns].astype(object).where(rows[columns].notna(), None)
                for at in range(0, len(values), batch):
                    n += con.executemany(f'insert into "{table}" values ({marks})', values.iloc[at : at + batch].values.tolist()).rowcount
        close()
        yield pd.DataFrame(done, columns=[by, "n_rows"])

    kind = dict(df.dtypes)[by]
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "string", "binary")
    df = df.select(by, *(F.col(c) if t in plain else F.col(c).cast("string").alias(c) for c, t in df.dtypes if c != by))
    return df.where(F.col(by).isNotNull()).repartition(by).sortWithinPartitions(by).mapInPandas(run, f"`{by}` {kind}, n_rows long")
