"""Column-level building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.NumericType,)


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def finite(value) -> Column:
    """NaN and infinities become NULL, so that missing has one spelling."""
    c = as_column(value).cast("double")
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def not_nan(expr: Column) -> Column:
    return F.when(~F.isnan(expr), expr)


def double_array(values) -> Column:
    """A constant array, parsed from one text instead of built element by element."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def hash32(*parts, seed=None) -> Column:
    """Uniform integer in [0, 2**32) from the md5 of the parts: portable across engines and
    independent of partitioning."""
    texts = [as_column(p).cast("string") for p in parts]
    if seed is not None:
        texts.insert(0, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("bigint")


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NUMERIC)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c in df.columns if c not in set(exclude) and is_numeric(df, c)]


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in set(exclude) and isinstance(f.dataType, T.StringType)]


def bin_index(value: Column, inner_edges) -> Column:
    """Right-closed bin number: how many distinct inner edges lie strictly below the value."""
    total = F.lit(0)
    for edge in inner_edges:
        total = total + (value > F.lit(float(edge))).cast("int")
    return total


def unpivot_structs(df: DataFrame, keep, entries) -> DataFrame:
    """One output row per (input row, entry); each entry is a struct column of one shared shape."""
    kept = [as_column(k) for k in keep]
    return df.select(*kept, F.inline(F.array(*entries)))
