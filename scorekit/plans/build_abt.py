"""Job 1: from a customer base and monthly feature tables to the analytical base table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from scorekit.functions.feature_names import AMOUNTS
from scorekit.operators import clean, derive, enrich, sample, target
from scorekit.session import stage
from scorekit.sources.writers import save_dataset


@dataclass(frozen=True)
class BaseSpec:
    """How to read a customer base."""

    id_column: str
    date_column: str
    target: str
    date_format: str = "yyyyMM"
    label_0: str | None = None
    label_1: str | None = None
    entity_type: str = "radical"
    month: str = "data_ref1"


def prepare_base(df: DataFrame, spec: BaseSpec, keep_fraction: float | None = None,
                 seed: int = 10) -> DataFrame:
    """One row per (id, date), binary target, clean text id, cohort month, optional stratified sample."""
    base = clean.dedup_by_key(df, [spec.id_column, spec.date_column])
    base = target.normalise_target(base, spec.target, spec.label_0, spec.label_1)
    base = clean.tag_id(base, spec.id_column, spec.entity_type)
    base = base.withColumn(f"{spec.entity_type}_cnpj", clean.clean_id(spec.id_column))
    base = clean.add_month(base, spec.date_column, spec.date_format, spec.month)
    if keep_fraction is not None:
        base = sample.sample_by_month_and_target(base, spec.month, spec.target,
                                                 [spec.id_column, spec.date_column], keep_fraction, seed)
    return base


def enrich_base(base: DataFrame, spec: BaseSpec, sources: Sequence[enrich.FeatureSource]) -> DataFrame:
    """All feature tables joined point-in-time, with coverage and card flags and float amounts."""
    joined = enrich.enrich(base, sources, f"{spec.entity_type}_cnpj", spec.month)
    if all(f"total_cartao_recebido_{n}M" in joined.columns for n in (3, 6, 12)):
        joined = enrich.card_flags(joined)
    return clean.cast_columns(joined, AMOUNTS)


def build_abt(df: DataFrame, spec: BaseSpec, sources: Sequence[enrich.FeatureSource],
              bases: Sequence[str] = (), n_recent: int = 3, keep_fraction: float | None = None,
              features: Sequence[str] | None = None, staged_path: str | None = None) -> DataFrame:
    """The whole job: one lazy plan per stage, a ``sample`` column instead of four frames.

    The prepared base is staged because the enrichment reads it twice (hot keys, join); the enriched
    table is staged so that derived features, the month scan of the split and later jobs start from
    storage.
    """
    base = stage(prepare_base(df, spec, keep_fraction), "base")
    enriched = stage(enrich_base(base, spec, sources), "enriched", staged_path)
    marked = sample.assign_sample(enriched, spec.id_column, spec.month, n_recent)
    wide = derive.derive_selected(marked, bases) if bases else marked
    keys = [spec.id_column, spec.date_column, spec.month, spec.target, "sample"]
    return clean.output_columns(wide, features, keys)


def write_samples(abt: DataFrame, path: str) -> None:
    """One pass over the table, one folder per sample."""
    save_dataset(abt, path, partition_by=["sample"])


__all__ = ["BaseSpec", "prepare_base", "enrich_base", "build_abt", "write_samples"]
