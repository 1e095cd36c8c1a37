"""SQLite files as a data source: ``spark.read.format("sqlite").option("path", ...).option("table", ...)``.

A table is read in ranges of its rowid, each by one task on a connection of its own, read only; a view or
a table without rowid is one range. Option columns (a JSON array) leaves the others unread; filters that
SQLite can decide just as Spark does go into its query (Spark asks for that with
spark.sql.python.filterPushdown.enabled). Option partitions: how many ranges.

``sqlite_catalog`` gives table, columns and rows of every table of a file, each table counted by a task.

SQLite columns have no fixed type. Declared INTEGER ones are long, REAL double, BLOB binary, others
string; a value of another kind is converted, or null where it can't be. The file must be in a folder
that all executors see."""

from __future__ import annotations

import contextlib
import json
import sqlite3
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)

_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@contextlib.contextmanager
def opened(path: str) -> Iterator[sqlite3.Connection]:
    own = unquote(urlsplit(path).path) if path.startswith("file:") else path
    connection = sqlite3.connect(f"file:{quote(own)}?mode=ro", uri=True)
    connection.text_factory = lambda b: b.decode("utf-8", "replace")
    try:
        yield connection
    finally:
        connection.close()


def named(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def tables_of(connection: sqlite3.Connection) -> list[str]:
    return [r[0] for r in connection.execute("SELECT name FROM sqlite_master WHERE type IN ('table', 'view') AND name NOT LIKE 'sqlite\\_%' ESCAPE '\\' ORDER BY name")]


def fields_of(connection: sqlite3.Connection, table: str) -> list[T.StructField]:
    """By the file format's rules of affinity, in their order."""

    def kind(declared: str) -> T.DataType:
        declared = (declared or "").upper()
        if "INT" in declared:
            return T.LongType()
        if any(x in declared for x in ("CHAR", "CLOB", "TEXT")):
            return T.StringType()
        if "BLOB" in declared:
            return T.BinaryType()
        return T.DoubleType() if any(x in declared for x in ("REAL", "FLOA", "DOUB")) else T.StringType()

    return [T.StructField(r[1], kind(r[2])) for r in connection.execute(f"PRAGMA table_info({named(table)})")]


def converted(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)
    if isinstance(kind, T.BinaryType):
        return value if isinstance(value, bytes) else str(value).encode()
    try:
        whole = float(value) if isinstance(kind, T.DoubleType) else int(value)
    except (TypeError, ValueError, OverflowError):
        return None
    return None if isinstance(value, bytes) or whole != value and isinstance(value, float) else whole


@dataclass
class Range(InputPartition):
    """Rows with a rowid from least to greatest, or all."""

    least: int | None = None
    greatest: int | None = None


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        with opened(self.options["path"]) as c:
            fields = fields_of(c, self.options["table"])
        if not fields:
            raise ValueError(f"no table {self.options['table']!r}")
        wanted = json.loads(self.options["columns"]) if "columns" in self.options else [f.name for f in fields]
        by_name = {f.name: f for f in fields}
        return T.StructType([by_name[n] for n in wanted])

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options["path"], self.options["table"], schema, int(self.options.get("partitions", "8")))


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: T.StructType, n: int):
        self.path, self.table, self.fields, self.n = path, table, list(schema.fields), n
        self.conditions: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes null tests, and comparisons of a number column with a number or of a text column with a
        text. Values of another kind than their column's are for Spark to judge once they are converted,
        so they pass, and Spark gets all filters back but the null tests of text columns."""
        kinds = {f.name: f.dataType for f in self.fields}
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kind, value = kinds.get(column), getattr(f, "value", None)
            text, number = isinstance(kind, T.StringType), isinstance(kind, (T.LongType, T.DoubleType))
            values = list(value) if isinstance(f, In) else [value]
            fit = text and all(isinstance(v, str) for v in values) or number and all(type(v) in (int, float) for v in values)
            own = named(column or "")
            if text and isinstance(f, (IsNull, IsNotNull)):
                self.conditions.append(f"{own} IS {'NOT ' if isinstance(f, IsNotNull) else ''}NULL")
                continue
            yield f
            if number and isinstance(f, IsNotNull):
                self.conditions.append(f"{own} IS NOT NULL")
            elif fit and type(f) in (*_COMPARED, In):
                test = f"IN ({', '.join('?' * len(values))})" if isinstance(f, In) else f"{_COMPARED[type(f)]} ?"
                other = f"typeof({own}) <> 'text'" if text else f"typeof({own}) NOT IN ('integer', 'real')"
                self.conditions.append(f"({own} COLLATE BINARY {test} OR {other})")
                self.values += values

    def partitions(self) -> list[InputPartition]:
        with opened(self.path) as c:
            try:
                least, greatest = c.execute(f"SELECT min(rowid), max(rowid) FROM {named(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a view, or a table without rowid
                return [Range()]
        if least is None or not isinstance(least, int):
            return [Range()]
        step = -(-(greatest - least + 1) // self.n)
        return [Range(a, min(a + step - 1, greatest)) for a in range(least, greatest + 1, step)]

    def read(self, partition: Range) -> Iterator[tuple]:
        conditions, values = list(self.conditions), list(self.values)
        if partition.least is not None:
            conditions.append("rowid BETWEEN ? AND ?")
            values += [partition.least, partition.greatest]
        where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
        columns = ", ".join(named(f.name) for f in self.fields) or "NULL"
        with opened(self.path) as c:
            for row in c.execute(f"SELECT {columns} FROM {named(self.table)}{where}", values):
                yield tuple(converted(v, f.dataType) for v, f in zip(row, self.fields, strict=False))


class CatalogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_catalog"

    def schema(self) -> str:
        return "table string, columns array<string>, rows long"

    def reader(self, schema) -> DataSourceReader:
        return CatalogReader(self.options["path"])


class CatalogReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        with opened(self.path) as c:
            return [InputPartition(t) for t in tables_of(c)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with opened(self.path) as c:
            columns = [f.name for f in fields_of(c, partition.value)]
            yield partition.value, columns, c.execute(f"SELECT count(*) FROM {named(partition.value)}").fetchone()[0]


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)
    spark.dataSource.register(CatalogSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """table, columns and rows of the file's tables."""
    register(spark)
    return spark.read.format("sqlite_catalog").option("path", path).load()


def table(spark: SparkSession, path: str, name: str, columns: list[str] | None = None, partitions: int = 8) -> DataFrame:
    register(spark)
    read = spark.read.format("sqlite").options(path=path, table=name, partitions=str(partitions))
    return (read if columns is None else read.option("columns", json.dumps(columns))).load()
