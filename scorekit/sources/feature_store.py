"""Monthly feature-store scans restricted to the months a customer base needs."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorekit.operators.clean import parse_date

# Recognised year / month partition columns.
YEAR_MONTH_PAIRS = [("partition_0", "partition_1"), ("year", "month")]


def shift_months(months, by: int) -> list[date]:
    """Calendar-month arithmetic on first-of-month dates."""
    out = []
    for m in months:
        index = m.year * 12 + m.month - 1 + by
        out.append(date(index // 12, index % 12 + 1, 1))
    return sorted(out)


def cohort_months(df: DataFrame, month: str) -> DataFrame:
    """Distinct cohort months in ascending order."""
    return df.select(month).where(F.col(month).isNotNull()).distinct().orderBy(month)


def collect_months(df: DataFrame, month: str) -> list[date]:
    """The cohort months as driver metadata, one per calendar month; the column must hold dates."""
    if not isinstance(df.schema[month].dataType, T.DateType):
        raise ValueError(f"{month} holds {df.schema[month].dataType.simpleString()}, not dates")
    first = F.trunc(F.col(month), "month")
    return [r[0] for r in cohort_months(df.select(first.alias(month)), month).collect()]


def month_predicate(columns, months, month: str = "mes", month_format: str | None = None) -> Column:
    """Predicate on the *raw* partition or month column, so partitions and row groups are pruned."""
    months = list(months)
    if not months:
        return F.lit(False)
    for year_col, month_col in YEAR_MONTH_PAIRS:
        if {year_col, month_col} <= set(columns):
            by_year: dict[int, list[int]] = {}
            for m in months:
                by_year.setdefault(m.year, []).append(m.month)
            return reduce(or_, [(F.col(year_col).cast("int") == y) & F.col(month_col).cast("int").isin(ms)
                                for y, ms in sorted(by_year.items())])
    if month not in columns:
        raise ValueError(f"no month column among {list(columns)}")
    if month_format is None:
        return F.col(month).isin(months)
    # Text spellings of a month key.
    spelling = {"yyyyMM": "%Y%m", "yyyy-MM": "%Y-%m", "yyyy-MM-dd": "%Y-%m-%d", "yyyyMMdd": "%Y%m%d"}
    return F.col(month).cast("string").isin([m.strftime(spelling[month_format]) for m in months])


def read_feature_months(spark: SparkSession, path: str, months, month: str = "mes",
                        month_format: str | None = None) -> DataFrame:
    """Scan only the wanted months and return the month column as a date."""
    return feature_months(spark.read.parquet(path), months, month, month_format)


def feature_months(df: DataFrame, months, month: str = "mes", month_format: str | None = None) -> DataFrame:
    """The rows of the wanted months, with ``month`` as a date.

    A month that is no date needs its format (texts default to ISO days). A store that spells any of its months
    another way is refused, as those rows would otherwise be lost. That takes a look at the month column of
    the store, or at its folders where it is partitioned by month.
    """
    pair = next((p for p in YEAR_MONTH_PAIRS if set(p) <= set(df.columns)), None)
    if pair is not None:
        kept = df.where(month_predicate(df.columns, months, month))
        return kept if month in df.columns else kept.withColumn(
            month, F.make_date(F.col(pair[0]).cast("int"), F.col(pair[1]).cast("int"), F.lit(1)))
    kind = df.schema[month].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df.where(month_predicate(df.columns, months, month)).withColumn(month, F.col(month).cast("date"))
    month_format = month_format or "yyyy-MM-dd"
    spelled = F.date_format(parse_date(month, month_format), month_format).eqNullSafe(F.col(month).cast("string"))
    odd = df.select(month).where(F.col(month).isNotNull() & ~spelled).first()
    if odd is not None:
        raise ValueError(f"{month} holds {odd[0]!r}, which is not spelled {month_format}")
    kept = df.where(month_predicate(df.columns, months, month, month_format))
    return kept.withColumn(month, parse_date(month, month_format))
