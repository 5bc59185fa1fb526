"""Rows whose values do not fit the declared types: dealt to accepted and rejected ones in one pass, with the reason."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from pairloom.schema import INPUT_DDL
from pairloom.sinks.staging import stage
from pairloom.sources.tables import Tables

CORRUPT = "_corrupt_record"
MALFORMED, NO_NUMBER, NOT_WHOLE, OUT_OF_RANGE = "malformed record", "no number", "not whole", "out of range"
REJECTED_DDL = "table STRING, column STRING, reason STRING, value STRING, row STRING"


@dataclass(frozen=True)
class Dealt:
    """``accepted`` rows have the declared columns; ``rejected`` has a row for each value at fault (REJECTED_DDL), with
    the whole source row as JSON. Each source row is in one of them."""

    accepted: DataFrame
    rejected: DataFrame


#: Texts that a cast to a floating number may take (fixed by Java's numbers and their special names). A cast that fails
#: costs an exception with its message, so texts that cannot be numbers are told apart before.
FLOATING = r"^[\x00-\x20\d+\-.a-fA-FxXpPnNiItTyY]+$"
#: Texts that a cast to BIGINT takes, and some beyond its range.
WHOLE = r"^[\x00-\x20\x7f]*[+-]?0*\d{1,19}[\x00-\x20\x7f]*$"


def floating(value: Column, own: DataType, kind: DataType) -> Column:
    return F.when(value.rlike(FLOATING), value.try_cast(kind)) if isinstance(own, StringType) else value.try_cast(kind)


def exactly(value: Column, own: DataType, kind: IntegralType) -> Column:
    """The whole number that ``value`` is without a way over floating numbers, or NULL."""
    if isinstance(own, (DoubleType, FloatType)):
        return F.lit(None).cast(kind)
    if not isinstance(own, StringType):
        return value.try_cast(kind)
    return F.when(value.rlike(WHOLE), value.try_cast("bigint"))


def in_range(number: Column, kind: IntegralType) -> Column:
    bits = {ByteType: 7, ShortType: 15, IntegerType: 31, LongType: 63}[type(kind)]
    # as a floating number, the largest BIGINT is 2 ** 63, which is none
    return (number >= -(2**bits)) & ((number < 2.0**63) if bits == 63 else (number <= 2**bits - 1))


def fitted(df: DataFrame, fields: list[StructField]) -> DataFrame:
    """``df`` with, for field ``i``, the value as the declared type in ``_typed{i}``, or NULL, and the reason why a value is
    lost in ``_reason{i}``, or NULL.

    Text and numbers become whole numbers if they are whole, as 7.0 is. Each step is a projection of its own, so that
    what several columns refer to is computed once.
    """
    steps: list[dict[str, Column]] = [{}, {}, {}, {}, {}]
    for i, field in enumerate(fields):
        value, own, kind = F.col(f"`{field.name}`"), df.schema[field.name].dataType, field.dataType
        exact, held, number, fits = (F.col(f"_{step}{i}") for step in ("exact", "held", "number", "typed"))
        if kind == own or isinstance(kind, StringType):
            typed, reason = value.cast(kind), F.lit(None).cast("string")
        elif isinstance(kind, IntegralType):
            steps[0][f"_exact{i}"] = exactly(value, own, kind)
            in_kind = exact.isNotNull() if isinstance(kind, LongType) else in_range(exact, kind)
            steps[1][f"_held{i}"] = F.when(in_kind, exact.try_cast(kind))
            steps[2][f"_number{i}"] = F.when(held.isNull(), floating(value, own, DoubleType()))
            whole = number % 1 == 0
            typed = F.coalesce(held, F.when(whole & in_range(number, kind), number.try_cast(kind)))
            lost = F.when(whole | (F.abs(number) == float("inf")), OUT_OF_RANGE).otherwise(NOT_WHOLE)
            reason = F.when(number.isNull(), NO_NUMBER).otherwise(lost)
        elif isinstance(kind, NumericType):
            typed = floating(value, own, kind) if isinstance(kind, (DoubleType, FloatType)) else value.try_cast(kind)
            reason = F.lit(NO_NUMBER)
        else:
            typed, reason = value.try_cast(kind), F.lit(f"no {kind.simpleString()}")
        steps[3][f"_typed{i}"] = typed
        steps[4][f"_reason{i}"] = F.when(value.isNotNull() & fits.isNull(), reason)
    return reduce(DataFrame.withColumns, filter(None, steps), df)


def deal(df: DataFrame, ddl: str, table: str) -> Dealt:
    """Rows of ``df`` by whether all their values fit the columns of ``ddl``. A column CORRUPT, as readers of text fill
    it, holds the text of records that could not be split into columns.

    The source is read once: rows are staged with what is wrong with them, and both results read that.
    """
    wanted = StructType.fromDDL(ddl)
    missing = sorted(set(wanted.names) - set(df.columns))
    if missing:
        raise ValueError(f"table {table} lacks the columns {missing}")
    corrupt = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    names = wanted.names
    reasons = [F.col(f"_reason{i}") for i in range(len(names))]
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns if c != CORRUPT)))
    at_fault = reduce(Column.__or__, (r.isNotNull() for r in reasons), corrupt.isNotNull())
    judged = fitted(df, wanted.fields).withColumn("_row", F.when(at_fault, row))
    fault = lambda column, reason, value: F.struct(
        F.lit(table).alias("table"), column.alias("column"), reason.alias("reason"), value.alias("value"), F.col("_row").alias("row")
    )
    each = [F.when(r.isNotNull(), fault(F.lit(c), r, F.col(f"`{c}`").cast("string"))) for c, r in zip(names, reasons)]
    malformed = F.array(fault(F.lit(None).cast("string"), F.lit(MALFORMED), corrupt))
    found = F.filter(F.array(*each), lambda x: x.isNotNull())
    faults = F.when(corrupt.isNotNull(), malformed).when(F.col("_row").isNotNull(), found).otherwise(F.array())
    typed = [F.col(f"_typed{i}").alias(c) for i, c in enumerate(names)]
    staged = stage(judged.select(*typed, faults.alias("_faults")), f"dealt-{table}").frame
    accepted = staged.filter(F.size("_faults") == 0).select(*(F.col(f"`{c}`") for c in wanted.names))
    rejected = staged.filter(F.size("_faults") > 0).select(F.explode("_faults").alias("f")).select("f.*")
    return Dealt(accepted, rejected)


class DealtTables(Tables):
    """Tables whose rows are dealt when they are first asked for: the accepted ones are the table."""

    def __init__(self, load: Callable[[str], DataFrame], rename: Mapping[str, str] | None = None):
        super().__init__(load, rename)
        self._rejected: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            dealt = deal(self._load(name).withColumnsRenamed(self._rename), INPUT_DDL[name], name)
            self._frames[name], self._rejected[name] = dealt.accepted, dealt.rejected
        return self._frames[name]

    def rejected(self, spark: SparkSession) -> DataFrame:
        """The values at fault in all tables that were asked for."""
        return reduce(DataFrame.unionByName, self._rejected.values(), spark.createDataFrame([], REJECTED_DDL))


def read_tables_dealt(
    spark: SparkSession, path: str, source: str = "parquet", rename: Mapping[str, str] | None = None, **options: str
) -> DealtTables:
    """As ``read_tables``, but rows with values that do not fit are left out of the tables and kept in ``rejected``.
    Text formats are read as text first; records that cannot be split into columns are rejected whole."""
    own = {declared: name for name, declared in (rename or {}).items()}

    def load(name: str) -> DataFrame:
        reader = spark.read.format(source).options(**options)
        if source in ("csv", "json"):
            columns = [own.get(c, c) for c in StructType.fromDDL(INPUT_DDL[name]).names] + [CORRUPT]
            reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
            reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        return reader.load(f"{path}/{name}")

    return DealtTables(load, rename)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """``table``, ``column``, ``reason`` and the number of values."""
    return rejected.groupBy("table", "column", "reason").agg(F.count(F.lit(1)).alias("n"))
