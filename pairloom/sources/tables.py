"""The 18 input tables as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from pairloom.schema import INPUT_DDL, columns_of


class Tables(Mapping):
    """Input tables by name; a table is loaded when first asked for, with its declared columns only."""

    def __init__(self, load: Callable[[str], DataFrame], rename: Mapping[str, str] | None = None):
        """``rename`` maps column names of the source to declared ones, for all tables."""
        self._load = load
        self._rename = dict(rename or {})
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            columns = columns_of(INPUT_DDL[name])
            frame = self._load(name).withColumnsRenamed(self._rename)
            missing = sorted(set(columns) - set(frame.columns))
            if missing:
                raise ValueError(f"table {name} lacks the columns {missing}")
            self._frames[name] = frame.select(*map(self._typed(frame, name), columns))
        return self._frames[name]

    @staticmethod
    def _typed(frame: DataFrame, name: str) -> Callable[[str], Column]:
        """A column cast to its declared type. Decimals may round to doubles; any other value that the type does not
        hold is an error when it is read (as a cast that fails), or here for kinds that never fit."""
        wanted = StructType.fromDDL(INPUT_DDL[name])

        def cast(column: str) -> Column:
            own, kind = frame.schema[column].dataType, wanted[column].dataType
            if own == kind:
                return F.col(column)
            if isinstance(own, (DoubleType, FloatType, DecimalType)) and isinstance(kind, IntegralType):
                whole = F.col(column).cast(kind)
                lossy = F.raise_error(F.concat(F.lit(f"{name}.{column} holds "), F.col(column).cast("string")))
                return F.when(F.col(column).isNull() | (whole == F.col(column)), whole).otherwise(lossy).alias(column)
            if isinstance(own, (NumericType, StringType)) or isinstance(kind, StringType):
                return F.col(column).cast(kind).alias(column)
            raise ValueError(f"{name}.{column} is {own.simpleString()}, not {kind.simpleString()}")

        return cast

    def __iter__(self) -> Iterator[str]:
        return iter(INPUT_DDL)

    def __len__(self) -> int:
        return len(INPUT_DDL)


def read_tables(
    spark: SparkSession, path: str, source: str = "parquet", rename: Mapping[str, str] | None = None, **options: str
) -> Tables:
    """Tables stored as ``<path>/<name>`` in any format of ``spark.read``; ``rename`` as in ``Tables``.

    Text formats are read with the declared types, so no pass over the data infers them.
    """
    source_names = {declared: own for own, declared in (rename or {}).items()}

    def load(name: str) -> DataFrame:
        reader = spark.read.format(source).options(**options)
        if source in ("csv", "json"):
            declared = StructType.fromDDL(INPUT_DDL[name])
            reader = reader.schema(StructType([StructField(source_names.get(f.name, f.name), f.dataType) for f in declared]))
        return reader.load(f"{path}/{name}")

    return Tables(load, rename)


def read_tables_jdbc(
    spark: SparkSession,
    url: str,
    driver: str,
    partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
    rename: Mapping[str, str] | None = None,
) -> Tables:
    """Tables of a relational database whose driver the cluster ships.

    ``partitioning`` gives (column, lower, upper, partitions) for the tables that are read in parallel;
    the others are read by one task. Column pruning and filters are pushed into the database.
    """

    def load(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, driver=driver, dbtable=name)
        if partitioning and name in partitioning:
            column, lower, upper, count = partitioning[name]
            reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=count)
        return reader.load()

    return Tables(load, rename)
