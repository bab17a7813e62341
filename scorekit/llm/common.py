"""What the operators of this package share: scratch tables, Arrow batch sizes and remote files."""

from __future__ import annotations

from pathlib import Path

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.session import shared_path, stage

__all__ = ["ascii_lower", "bucket_of", "filesystem", "hash_share", "load", "make_folder",
           "held_out", "python_workers", "shared_path", "stage"]

BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_workers(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes and rows, so that batches of long texts stay small, and let workers
    import this package from where the driver has it, if it is not installed there."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == F.lit(remainder), F.lit(False))


def bucket_of(n: int, *columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def hash_share(key) -> Column:
    """A number in [0, 1) from the hash of a key. The rows below 4 n / rows are about 4 n, whatever the
    size of the table, and hold the n smallest."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 40)) / F.lit(float(1 << 40))


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    system, inner = filesystem(path)
    system.create_dir(inner, recursive=True)
