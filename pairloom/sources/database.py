"""Tables in SQLite database files, read and written by executors.

A table is read in ranges of its key, one task each, so a single file of any size is read in parallel. Only the columns
of the schema are selected, and conditions given with ``where`` are part of each range's query. The files have to be
in a folder that driver and executors see under one path, or shipped to all of them with ``SparkContext.addFile``.

With the option ``pushdown`` the reader also takes filters that Spark pushes down, in sessions that set
spark.sql.python.filterPushdown.enabled. The library leaves that off: Spark 4.1 keeps what was pushed for one query with
the DataFrame, so another query on the same DataFrame would lose rows. With it on, load the table anew for each query.
"""

from __future__ import annotations

import json
import os
import sqlite3
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import closing
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from pairloom.schema import INPUT_DDL
from pairloom.sources.tables import Tables

FORMAT = "database_files"
MANIFEST = "_files.json"  # the files of a written folder; others in it are left over from tasks that failed
KEYS_PER_RANGE = 1_000_000
SIGNS = ("=", "!=", "<", "<=", ">", ">=")
Condition = tuple  # (column, one of SIGNS, value), (column, "in", values), (column, "null") or (column, "not null")
BATCH_ROWS = 8192


def local_path(path: str) -> str:
    """A path without the scheme of local files; any other scheme is an error."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: database files need a folder that all nodes see as a local one, or addFile")
    return unquote(parts.path) if parts.scheme else path


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(os.path.abspath(path))}?mode=ro", uri=True)


def files_of(path: str, shipped: bool) -> list[str]:
    """The file at ``path``, or those that the manifest of a folder lists."""
    where = SparkFiles.get(path) if shipped else local_path(path)
    if not os.path.isdir(where):
        return [where]
    with open(f"{where}/{MANIFEST}") as listed:
        return [f"{where}/{name}" for name in json.load(listed)]


def spark_type(declared: str) -> DataType:
    """By the rules that SQLite itself takes the affinity of a declared type from; numeric ones are doubles."""
    kind = declared.upper()
    for words, found in (
        (("INT",), LongType()),
        (("CHAR", "CLOB", "TEXT", "DATE", "TIME"), StringType()),
        (("BLOB",), BinaryType()),
        (("BOOL",), BooleanType()),
    ):
        if any(w in kind for w in words):
            return found
    return DoubleType() if kind else StringType()


@dataclass
class KeyRange(ds.InputPartition):
    """Rows of a file whose key is at least ``low`` and below ``high``; without bounds, the whole table. ``rest`` takes
    the rows without a key as well."""

    file: str
    low: int | None = None
    high: int | None = None
    rest: bool = False


class DatabaseFiles(ds.DataSource):
    """Options: ``path``; ``dbtable``; ``key``, an integer column to cut ranges by (the row number unless given);
    ``keys_per_range``; ``shipped``, if ``path`` names a file sent with addFile; ``where``, conditions as JSON;
    ``pushdown``, whether Spark may push filters."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _option(self, name: str, default: str | None = None) -> str:
        value = self.options.get(name, default)
        if value is None:
            raise ValueError(f"database files need the option {name}")
        return value

    def _shipped(self) -> bool:
        return self._option("shipped", "false").lower() == "true"

    def schema(self) -> StructType:
        files = files_of(self._option("path"), self._shipped())
        if not files:
            raise ValueError("a folder without files has no schema of its own; give one")
        with closing(opened(files[0])) as db:
            columns = db.execute(f"PRAGMA table_info({quoted(self._option('dbtable'))})").fetchall()
        if not columns:
            raise ValueError(f"{files[0]} has no table {self._option('dbtable')}")
        return StructType([StructField(c[1], spark_type(c[2])) for c in columns])

    def reader(self, schema: StructType) -> DatabaseReader:
        kind = PushdownReader if self._option("pushdown", "false").lower() == "true" else DatabaseReader
        return kind(
            self._option("path"),
            self._shipped(),
            self._option("dbtable"),
            schema,
            self._option("key", "rowid"),
            int(self._option("keys_per_range", str(KEYS_PER_RANGE))),
            json.loads(self._option("where", "[]")),
        )

    def writer(self, schema: StructType, overwrite: bool) -> DatabaseWriter:
        return DatabaseWriter(local_path(self._option("path")), self._option("dbtable"), schema, overwrite)


class DatabaseReader(ds.DataSourceReader):
    def __init__(
        self, path: str, shipped: bool, table: str, schema: StructType, key: str, keys_per_range: int, where: Iterable[Condition] = ()
    ):
        self.path, self.shipped, self.table, self.schema = path, shipped, table, schema
        self.key, self.keys_per_range = key, keys_per_range
        self.conditions: list[str] = []
        self.values: list = []
        for condition in where:
            if not self._take(condition):
                raise ValueError(f"{table}: {condition} cannot be decided in the file")

    def _take(self, condition: Condition) -> bool:
        column, sign, *value = condition
        if column not in self.schema.names:
            return False
        kind, name = self.schema[column].dataType, quoted(column)
        if sign in ("null", "not null"):
            self.conditions.append(f"{name} IS {sign.upper()}")
            return True
        # Floats are rounded and dates are text: only these compare in the file as they do in Spark.
        if not isinstance(kind, (IntegralType, DoubleType, StringType)):
            return False
        fits = str if isinstance(kind, StringType) else (int, float)
        values = list(value[0]) if sign == "in" else value
        if any(not isinstance(v, fits) or isinstance(v, bool) or v != v for v in values):
            return False
        name += " COLLATE BINARY" if isinstance(kind, StringType) else ""
        if sign == "in":
            self.conditions.append(f"{name} IN ({', '.join('?' * len(values))})")
        elif sign in SIGNS:
            self.conditions.append(f"{name} {sign} ?")
        else:
            return False
        self.values += values
        return True

    def partitions(self) -> list[KeyRange]:
        out = []
        for file in files_of(self.path, self.shipped):
            with closing(opened(file)) as db:
                try:
                    low, high = db.execute(f"SELECT min({self._key()}), max({self._key()}) FROM {quoted(self.table)}").fetchone()
                except sqlite3.OperationalError as error:
                    if "no such column" not in str(error) or self.key != "rowid":
                        raise
                    out.append(KeyRange(self._sent(file)))  # a table without row numbers
                    continue
            if low is None:
                out.append(KeyRange(self._sent(file)))
                continue
            for at in range(low, high + 1, self.keys_per_range):
                out.append(KeyRange(self._sent(file), at, at + self.keys_per_range, at == low))
        return out

    def _sent(self, file: str) -> str:
        return self.path if self.shipped else file

    def _key(self) -> str:
        return self.key if self.key == "rowid" else quoted(self.key)

    def query(self, part: KeyRange) -> tuple[str, list]:
        conditions, values = list(self.conditions), list(self.values)
        if part.low is not None:
            key = self._key()
            within = f"{key} >= ? AND {key} < ?"
            conditions.append(f"({within} OR {key} IS NULL)" if part.rest and key != "rowid" else within)
            values += [part.low, part.high]
        columns = ", ".join(map(quoted, self.schema.names)) or "1"
        where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
        return f"SELECT {columns} FROM {quoted(self.table)}{where}", values

    def read(self, part: KeyRange) -> Iterator[pa.RecordBatch]:
        file = files_of(part.file, self.shipped)[0]
        sql, values = self.query(part)
        with closing(opened(file)) as db:
            cursor = db.execute(sql, values)
            while rows := cursor.fetchmany(BATCH_ROWS):
                columns = zip(*rows)
                yield pa.record_batch(
                    [self._column(f, list(c)) for f, c in zip(self.schema.fields, columns)], names=self.schema.names
                )

    def _column(self, field: StructField, values: list) -> pa.Array:
        """Values as the declared type; one that it does not hold is an error that names the column."""
        kind = field.dataType
        try:
            if isinstance(kind, StringType):
                texts = [v if v is None or isinstance(v, str) else v.decode() if isinstance(v, bytes) else str(v) for v in values]
                return pa.array(texts, pa.string())
            if isinstance(kind, BooleanType):
                if bad := [v for v in values if v not in (0, 1, None)]:
                    raise pa.ArrowInvalid(f"{bad[0]!r}")
                return pa.array([None if v is None else bool(v) for v in values], pa.bool_())
            if isinstance(kind, IntegralType):
                if bad := [v for v in values if v is not None and v != int(v)]:
                    raise pa.ArrowInvalid(f"{bad[0]!r}")
                whole = pa.array([None if v is None else int(v) for v in values], pa.int64())
                return whole.cast({"smallint": pa.int16(), "tinyint": pa.int8(), "int": pa.int32()}.get(kind.simpleString(), pa.int64()))
            if isinstance(kind, (DoubleType, FloatType)):
                if bad := [v for v in values if not isinstance(v, (int, float, type(None)))]:
                    raise pa.ArrowInvalid(f"{bad[0]!r}")
                return pa.array(values, pa.float64()).cast(pa.float64() if isinstance(kind, DoubleType) else pa.float32())
            if isinstance(kind, DateType):
                return pa.array(values, pa.string()).cast(pa.date32())
            if isinstance(kind, (TimestampType, TimestampNTZType)):
                moments = pa.array(values, pa.string()).cast(pa.timestamp("us"))
                return moments if isinstance(kind, TimestampNTZType) else moments.cast(pa.timestamp("us", "UTC"))
            if isinstance(kind, BinaryType):
                return pa.array(values, pa.binary())
        except (pa.ArrowInvalid, pa.ArrowTypeError, ValueError, TypeError) as error:
            raise ValueError(f"{self.table}.{field.name} holds a value that is no {kind.simpleString()}: {error}") from error
        raise ValueError(f"{self.table}.{field.name}: {kind.simpleString()} is not read from database files")


class PushdownReader(DatabaseReader):
    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Takes the filters that the file decides as Spark does; the others stay with Spark."""
        for f in filters:
            inner, negated = (f.child, True) if isinstance(f, ds.Not) else (f, False)
            column = getattr(inner, "attribute", ())
            sign = {
                ds.EqualTo: "!=" if negated else "=",
                ds.GreaterThan: "<=" if negated else ">",
                ds.GreaterThanOrEqual: "<" if negated else ">=",
                ds.LessThan: ">=" if negated else "<",
                ds.LessThanOrEqual: ">" if negated else "<=",
                ds.IsNull: "not null" if negated else "null",
                ds.IsNotNull: "null" if negated else "not null",
                ds.In: None if negated else "in",
            }.get(type(inner))
            value = [inner.value] if hasattr(inner, "value") else []
            if len(column) != 1 or sign is None or not self._take((column[0], sign, *value)):
                yield f


@dataclass
class Written(ds.WriterCommitMessage):
    file: str


class DatabaseWriter(ds.DataSourceArrowWriter):
    """One file per task. A file gets its name when it is complete, and counts when the manifest lists it."""

    def __init__(self, folder: str, table: str, schema: StructType, overwrite: bool):
        self.folder, self.table, self.schema, self.overwrite = folder, table, schema, overwrite
        for f in schema.fields:
            self._declared(f)

    @staticmethod
    def _declared(field: StructField) -> str:
        kind = field.dataType
        for kinds, declared in (
            (IntegralType, "INTEGER"),
            (BooleanType, "BOOLEAN"),
            ((DoubleType, FloatType), "REAL"),
            (DateType, "DATE"),
            ((TimestampType, TimestampNTZType), "TIMESTAMP"),
            (StringType, "TEXT"),
            (BinaryType, "BLOB"),
        ):
            if isinstance(kind, kinds):
                return declared
        raise ValueError(f"{field.name}: {kind.simpleString()} is not written to database files")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        os.makedirs(self.folder, exist_ok=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.db"
        columns = ", ".join(f"{quoted(f.name)} {self._declared(f)}" for f in self.schema.fields)
        places = ", ".join("?" * len(self.schema.fields))
        texts = [isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)) for f in self.schema.fields]
        unfinished = f"{self.folder}/.{name}"
        with closing(sqlite3.connect(unfinished, isolation_level=None)) as db:
            db.execute("PRAGMA journal_mode = OFF")
            db.execute(f"CREATE TABLE {quoted(self.table)} ({columns})")
            db.execute("BEGIN")
            for batch in iterator:
                parts = [self._stored(c, text) for c, text in zip(batch.columns, texts)]
                db.executemany(f"INSERT INTO {quoted(self.table)} VALUES ({places})", zip(*parts))
            db.execute("COMMIT")
        os.replace(unfinished, f"{self.folder}/{name}")
        return Written(name)

    @staticmethod
    def _stored(column: pa.Array, as_text: bool) -> list:
        if as_text and pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("us"))  # without its zone, in UTC
        return (column.cast(pa.string()) if as_text else column).to_pylist()

    def commit(self, messages: list[Written | None]) -> None:
        listed = f"{self.folder}/{MANIFEST}"
        kept: list[str] = []
        if os.path.exists(listed) and not self.overwrite:
            with open(listed) as before:
                kept = json.load(before)
        os.makedirs(self.folder, exist_ok=True)
        with open(f"{listed}.{uuid.uuid4().hex}", "w") as new:
            json.dump(kept + sorted(m.file for m in messages if m), new)
        os.replace(new.name, listed)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m and os.path.exists(f"{self.folder}/{m.file}"):
                os.remove(f"{self.folder}/{m.file}")


def registered(spark: SparkSession) -> SparkSession:
    """Makes the format known to the session."""
    spark.dataSource.register(DatabaseFiles)
    return spark


def read_database(
    spark: SparkSession,
    path: str,
    table: str,
    schema: StructType | str | None = None,
    where: Iterable[Condition] = (),
    **options: str,
) -> DataFrame:
    """One table of the file or folder at ``path``. ``schema`` says which columns are read, as which types; without it,
    all of them, by their declared types. Rows that miss a condition of ``where``, on columns that are read, do not
    leave the file. ``options`` as in ``DatabaseFiles``."""
    reader = registered(spark).read.format(FORMAT).options(dbtable=table, where=json.dumps(list(where)), **options)
    return (reader.schema(schema) if schema else reader).load(path)


def write_database(df: DataFrame, path: str, table: str, mode: str = "append") -> None:
    """``df`` as one file per partition in the folder ``path``."""
    registered(df.sparkSession)
    df.write.format(FORMAT).options(dbtable=table).mode(mode).save(path)


def read_tables_database(
    spark: SparkSession,
    path: str,
    rename: Mapping[str, str] | None = None,
    where: Mapping[str, Iterable[Condition]] | None = None,
    **options: str,
) -> Tables:
    """The input tables in one database file, each read as its declared columns only; ``rename`` as in ``Tables``,
    ``where`` gives conditions on the file's own columns by table, ``options`` as in ``DatabaseFiles``."""
    own = {declared: name for name, declared in (rename or {}).items()}

    def load(name: str) -> DataFrame:
        declared = StructType.fromDDL(INPUT_DDL[name])
        schema = StructType([StructField(own.get(f.name, f.name), f.dataType) for f in declared])
        return read_database(spark, path, name, schema, (where or {}).get(name, ()), **options)

    return Tables(load, rename)
