"""Final shape of the pair table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType

from pairloom.operators.measurements import PHASE

DECIMAL_PLACES = 4  # fixed value


def rounded(value: str, places: int = DECIMAL_PLACES) -> str:
    """Half to even on the binary value; the ``round`` functions work on the decimal text."""
    scale = f"{10.0**places}D"
    return f"rint({value} * {scale}) / {scale}"


def clean_expression(field: StructField, source: DataType) -> str:
    """Empty text and NaN become NULL, doubles but the phase are rounded, all get their declared type."""
    value = f"`{field.name}`"
    if source != field.dataType:
        value = f"CAST({value} AS {field.dataType.simpleString()})"
    if isinstance(field.dataType, StringType):
        value = f"nullif({value}, '')"
    elif isinstance(field.dataType, DoubleType):
        value = f"nullif({value}, double('NaN'))"
        if field.name != PHASE:
            value = rounded(value)
    return f"{value} AS `{field.name}`"


def clean(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of ``ddl`` in order, cleaned; any other or missing column is an error."""
    wanted, present = StructType.fromDDL(ddl), df.schema
    surplus, missing = sorted(set(present.names) - set(wanted.names)), sorted(set(wanted.names) - set(present.names))
    if surplus or missing:
        raise ValueError(f"columns not in the result: {surplus}; columns without a source: {missing}")
    return df.selectExpr(*[clean_expression(f, present[f.name].dataType) for f in wanted.fields])


def round_doubles(df: DataFrame) -> DataFrame:
    """Round all doubles but the phase."""
    return df.selectExpr(
        *[
            f"{rounded(f'`{f.name}`')} AS `{f.name}`"
            if isinstance(f.dataType, DoubleType) and f.name != PHASE
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )
