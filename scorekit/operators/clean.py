"""Dates, identifiers, casts, column selection, missing values and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.functions.columns import as_column, categorical_columns, finite, numeric_columns
from scorekit.functions.feature_names import KEY_COLUMNS
from scorekit.functions.order_stats import exact_quantiles

# Fixed value: the number written for a missing value.
MISSING_NUMBER = -99999
EXPAND_CHUNK = 10_000


# dates -------------------------------------------------------------------------------------------

# Spellings of a date, each with what completes it to a day.
DATE_FORMATS = {"yyyyMM": "01", "yyyy-MM": "-01", "yyyyMMdd": "", "dd/MM/yyyy": "", "MM/dd/yyyy": "", "yyyy-MM-dd": ""}


def parse_date(value, date_format: str) -> Column:
    """Text or number to date; bad input gives NULL. Month-only formats mean the first day and ignore
    what follows the month. Any other format name leaves the parsing to a plain cast."""
    rest = DATE_FORMATS.get(date_format)
    if rest is None:
        return as_column(value).try_cast("date")
    text = as_column(value).cast("string")
    day = {"01": "dd", "-01": "-dd"}.get(rest, "")
    if day:
        text = F.concat(F.translate(F.left(text, F.lit(len(date_format))), "/.", "--"), F.lit(rest))
    return F.try_to_date(text, date_format + day)


def convert_date(df: DataFrame, column: str, date_format: str) -> DataFrame:
    """Replace ``column`` by its parsed date; it moves to the end."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, parse_date(column, date_format).alias(column))


def month_of(value) -> Column:
    return F.trunc(as_column(value).cast("date"), "month")


def add_month(df: DataFrame, date_column: str, date_format: str, month: str = "data_ref1") -> DataFrame:
    """Parse the reference date and add its cohort month."""
    parsed = convert_date(df, date_column, date_format)
    return parsed.withColumn(month, month_of(date_column))


def shift_month(value, by: int) -> Column:
    return F.add_months(as_column(value).cast("date"), by)


# identifiers -------------------------------------------------------------------------------------

def clean_id(value) -> Column:
    """Digits only, without leading zeros."""
    digits = F.regexp_replace(as_column(value).cast("string"), r"[^0-9]", "")
    return F.regexp_replace(digits, r"^0+", "")


def tag_id(df: DataFrame, id_column: str, entity_type: str) -> DataFrame:
    """Length of the identifier and its lower-cased type."""
    return df.withColumns({
        "num_digitos_cnpj": F.length(F.upper(F.col(id_column).cast("string"))),
        "tipo_cnpj": F.lit(entity_type.lower())})


def stratum_key(*columns) -> Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in columns])


def postcode_prefixes(df: DataFrame, column: str, lengths=(2, 3, 4, 5)) -> DataFrame:
    return df.withColumns({f"NEW__cep_{n}_digitos": F.substring(F.col(column), 1, n) for n in lengths})


# columns -----------------------------------------------------------------------------------------

def cast_columns(df: DataFrame, columns, to: str = "float") -> DataFrame:
    """Cast the named columns, keep the others, in one projection."""
    chosen = set(columns)
    return df.select([F.col(c).cast(to).alias(c) if c in chosen else F.col(c) for c in df.columns])


def cast_by_pattern(df: DataFrame, text_patterns, target: str, keep=()) -> DataFrame:
    """Columns whose name contains a pattern become strings, the target an int, the rest doubles."""
    def typed(name):
        if any(p in name for p in text_patterns):
            return F.col(name).cast("string")
        if name == target:
            return F.col(name).cast("int")
        return F.col(name) if name in keep else F.col(name).cast("double")
    return df.select([typed(c).alias(c) for c in df.columns])


def output_columns(df: DataFrame, features=None, keys=(), service=tuple(KEY_COLUMNS)) -> DataFrame:
    """Drop service columns; with ``features`` keep exactly keys + features."""
    slim = df.drop(*service)
    return slim.select(*keys, *features) if features is not None else slim


def drop_prefixed(df: DataFrame, prefix: str = "NEW__") -> tuple[DataFrame, list[str]]:
    """Remove derived columns by name; also return their names for the removal report."""
    names = [c for c in df.columns if prefix in c]
    return df.drop(*names), names


def align_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """Keep the columns that ``other`` has too."""
    return df.select([c for c in df.columns if c in set(other.columns)])


# missing values ----------------------------------------------------------------------------------

def replace_missing(df: DataFrame, number: float | None = None, text: str | None = None,
                    exclude=()) -> DataFrame:
    """NaN and infinities to NULL, textual "NaN" to NULL, then optional constants for NULL."""
    numeric = set(numeric_columns(df, exclude))
    texts = set(categorical_columns(df, exclude))

    def cleaned(name):
        if name in numeric:
            c = finite(name)
            return F.coalesce(c, F.lit(float(number))) if number is not None else c
        if name in texts:
            c = F.when(F.col(name) != "NaN", F.col(name))
            return F.coalesce(c, F.lit(text)) if text is not None else c
        return F.col(name)
    return df.select([cleaned(c).alias(c) for c in df.columns])


def fill_mean(df: DataFrame, columns) -> DataFrame:
    """Replace missing and infinite values by the mean of the finite ones."""
    means = df.agg(*[F.avg(finite(c)).alias(c) for c in columns]).first()
    return _fill(df, {c: means[c] for c in columns})


def fill_median(df: DataFrame, columns) -> DataFrame:
    """Replace missing and infinite values by the exact median."""
    medians = exact_quantiles(df, columns, [0.5])
    return _fill(df, {c: medians[c][0] for c in columns})


def _fill(df: DataFrame, values: dict) -> DataFrame:
    return df.select([F.coalesce(finite(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                      for c in df.columns])


# duplicates --------------------------------------------------------------------------------------

def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key: the arbitrary survivor, or the latest by ``order`` (ties by the whole row).

    The ordered form reduces map-side with ``max_by``, so a key that owns a third of all rows never
    travels as a group.
    """
    if not order:
        return df.dropDuplicates(list(keys))
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates()
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others if c not in order])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def count_copies(df: DataFrame, name: str = "n_copies") -> DataFrame:
    """Each distinct row with its multiplicity: a map-side combined aggregation."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(name))


def split_duplicates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deduplicated rows, every member of a duplicated group).

    Copies are identical, so they are re-created from their counts, in chunks spread over tasks
    instead of shuffling a hot group of copies to one task.
    """
    copies = count_copies(df, "_n")
    chunks = (copies.where("_n > 1")
              .withColumn("_start", F.explode(F.expr(f"sequence(0L, _n - 1, {EXPAND_CHUNK}L)")))
              .withColumn("_len", F.least(F.lit(EXPAND_CHUNK), F.col("_n") - F.col("_start")))
              .drop("_n"))
    spread = chunks.repartition(F.xxhash64(*chunks.columns))
    members = (spread.withColumn("_i", F.explode(F.expr("sequence(1L, _len)")))
               .drop("_i", "_len", "_start"))
    return copies.drop("_n"), members
