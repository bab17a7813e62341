"""Dataset readers: format fallback, extension dispatch, pruning and sampling."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.operators.sample import sample_rows, stratified_sample

UNREADABLE = (PySparkException, Py4JJavaError)
EXCEL = (".xls", ".xlsx")


def _reject_excel(path: str) -> None:
    if path.lower().endswith(EXCEL):
        raise ValueError(f"Excel files are not supported: {path}")


def _parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    df.schema  # resolves the files now, so that a wrong format fails here
    return df


def _is_foreign(error: Exception) -> bool:
    """Whether reading failed because the files are no Parquet files at all."""
    text = str(error)
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        text += str(cause.toString())
        cause = cause.getCause()
    return "is not a Parquet file" in text or "UNABLE_TO_INFER_SCHEMA" in text


def _delimited(spark: SparkSession, path: str, delimiter: str | None, infer: bool = False) -> DataFrame:
    reader = spark.read.option("header", True).option("inferSchema", infer)
    return (reader.option("sep", delimiter) if delimiter else reader).csv(path)


def read_table(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """Parquet if the files are Parquet, else delimited text with a header (all strings)."""
    _reject_excel(path)
    try:
        return _parquet(spark, path)
    except UNREADABLE as error:
        if not _is_foreign(error):  # a damaged Parquet file must not be parsed as text
            raise
        return _delimited(spark, path, delimiter)


def read_sampled(spark: SparkSession, path: str, fraction: float = 0.5, seed: int = 42,
                 columns=None, key=None, delimiter: str | None = None) -> DataFrame:
    """Column-pruned read of a row sample without replacement, by natural key if there is one."""
    df = read_table(spark, path, delimiter)
    return sample_rows(df, fraction, seed, key).select(*(columns or df.columns))


def read_by_extension(spark: SparkSession, path: str, delimiter: str = "\t", target: str | None = None,
                      keep_fraction: float | None = None, seed: int = 10, key=None) -> DataFrame:
    """``.csv`` / ``.txt`` / ``.parquet`` by suffix, anything else must be Parquet. With
    ``keep_fraction`` the rows are sampled stratified by ``target``; without a natural key a row of a
    Parquet file is identified by its file and number, and text files need a key."""
    _reject_excel(path)
    suffix = path.lower().rstrip("/").rsplit(".", 1)[-1]
    if suffix in ("csv", "txt"):
        df = _delimited(spark, path, delimiter, infer=True)
    else:
        try:
            df = _parquet(spark, path)
        except UNREADABLE as error:
            raise ValueError(f"Unsupported file format: {path}") from error
    if keep_fraction is None:
        return df
    if key:
        return stratified_sample(df, target, key, keep_fraction, seed)
    if suffix in ("csv", "txt"):
        raise ValueError("sampling text files needs a key")
    placed = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return stratified_sample(placed, target, ["_file", "_row"], keep_fraction, seed).drop("_file", "_row")


def read_with_volume(spark: SparkSession, path: str, fraction: float | None = None, seed: int = 42,
                     key=None, delimiter: str | None = ";") -> tuple[DataFrame, int, int]:
    """Read, optionally sample, and report (frame, number of columns, number of rows). No surrogate
    row number is added: later steps use natural keys."""
    df = read_table(spark, path, delimiter)
    if fraction is not None:
        df = sample_rows(df, fraction, seed, key)
    return df, len(df.columns), df.count()
