"""Helpers that depend on the running session: shared storage and size-checked lookups."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.functions.skew import spread_join

LOOKUP_ROWS = 50_000  # most rows that the driver is asked for
LOOKUP_BYTES = 32 << 20  # most bytes that are broadcast
EVEN_ROWS = 500_000  # most rows of a file of an evenly dealt table, about


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, and where that is unset a folder in the
    warehouse, which executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", path: str | None = None, even: bool = False) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts the lineage with a table that outlives lost executors, so loops of model fits never
    recompute (or re-sample) their input. With ``even`` the rows are dealt evenly over as many files as the session has
    shuffle partitions (cores at least), or as their number asks for where a file would hold more than EVEN_ROWS, whatever the
    files they came from. They are counted for that, which reads no more columns than the rows depend on.
    """
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    if even:
        fewest = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        df = df.repartition(max(fewest, math.ceil(df.count() / EVEN_ROWS)))
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(df: DataFrame, max_rows: int = LOOKUP_ROWS, max_bytes: int = LOOKUP_BYTES) -> DataFrame | None:
    """``df`` as an in-memory relation when it has at most ``max_rows`` rows and ``max_bytes`` bytes, else
    None.

    The driver never receives more than ``max_rows + 1`` rows.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def lookup_join(big: DataFrame, lookup: DataFrame, on, how: str = "left",
                max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Join a lookup: broadcast once its size is checked, else a shuffled join that spreads hot keys."""
    local = small_table(lookup, max_rows)
    if local is not None:
        return big.join(F.broadcast(local), on, how)
    return spread_join(big, lookup, [on] if isinstance(on, str) else on, how)


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings that suit these jobs: run-time re-planning and skew handling, and no
    whole-stage method so large that the JVM refuses to compile it (wide derived features)."""
    for key, value in {"spark.sql.adaptive.enabled": "true",
                       "spark.sql.adaptive.skewJoin.enabled": "true",
                       "spark.sql.adaptive.coalescePartitions.enabled": "true",
                       "spark.sql.codegen.hugeMethodLimit": "8000"}.items():
        spark.conf.set(key, value)
    return spark
