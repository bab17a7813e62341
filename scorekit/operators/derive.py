"""Derived features: unary, pairwise and row-wise family statistics.

Everything is one projection of codegen-friendly arithmetic over the unsplit table: no row key, no
explode, no join, no higher-order function, hence no exchange. Expressions are written as SQL text,
which keeps plans of a thousand columns quick to build.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from scorekit.functions import feature_names as names

# The column prefix that later steps filter on. The kind names below are part of the
# column names and fixed too.
PREFIX = "NEW__"

# Labels of the ratio trend.
TREND_SAME, TREND_UP, TREND_DOWN = "Manteve", "Aumentou", "Diminuiu"


def _named(made: dict[str, str], prefix: str, suffix: str = "") -> list[str]:
    return [f"{expr} AS `{prefix}{name}{suffix}`" for name, expr in made.items()]


def _nan_to_null(expr: str) -> str:
    return f"nullif({expr}, double('NaN'))"


def unary_features(column: str, prefix: str = PREFIX) -> list[str]:
    """The 20 single-column transforms; undefined results are NULL."""
    x = f"`{column}`"
    made = {
        "polynomial_dg2": f"CASE WHEN {x} <> 0 THEN power({x}, 2) END",
        "polynomial_dg3": f"CASE WHEN {x} <> 0 THEN power({x}, 3) END",
        "polynomial_dg4": f"CASE WHEN {x} <> 0 THEN power({x}, 4) END",
        "log_value": f"ln({x})",
        "ln_value": f"log1p({x})",
        "cosine_value": f"cos({x})",
        "sine_value": f"sin({x})",
        "multiple_of_10": f"CASE WHEN {x} % 10 = 0 THEN 1 ELSE 0 END",
        "exp": f"exp({x})",
        "inverse": f"try_divide(1D, double({x}))",
        "is_null": f"int({x} IS NULL)",
        "is_even": f"int({x} % 2 = 0)",
        "is_odd": f"int({x} % 2 <> 0)",
        "sqrt": _nan_to_null(f"sqrt(float({x}))"),
        "tan_value": f"tan({x})",
        "arc_sin_value": _nan_to_null(f"asin({x})"),
        "arc_cos_value": _nan_to_null(f"acos({x})"),
        "arc_tan_value": f"atan({x})",
        "hiperbolic_cos": f"cosh({x})",
        "hiperbolic_sin": f"sinh({x})",
    }
    return _named(made, prefix, f"_{column}")


def _trend(value: str) -> str:
    return (f"CASE WHEN {value} = 1 THEN '{TREND_SAME}' WHEN {value} > 1 THEN '{TREND_UP}' "
            f"WHEN {value} < 1 THEN '{TREND_DOWN}' END")


def pair_features(first: str, second: str, prefix: str = PREFIX) -> list[str]:
    """The 13 features of an ordered column pair, as inlined expressions without scratch columns."""
    a, b = f"double(`{first}`)", f"double(`{second}`)"
    mean = f"({b} + {a}) / 2"
    from_a, from_b = f"({a} - {mean})", f"({b} - {mean})"
    b_over_a, a_over_b = f"try_divide({b}, {a})", f"try_divide({a}, {b})"
    both, ba, ab = f"mean_{first}_and_{second}", f"{second}_vs_{first}", f"{first}_vs_{second}"
    return _named({
        f"sum_{ba}": f"{b} + {a}",
        f"mean_{ba}": mean,
        f"delta_{first}_vs_{both}": from_a,
        f"delta_{second}_vs_{both}": from_b,
        f"sqrt_of_delta_{first}_vs_{both}": f"power({from_a}, 2)",
        f"sqrt_of_delta_{second}_vs_{both}": f"power({from_b}, 2)",
        f"stddev_{ba}": f"sqrt(power({from_a}, 2) + power({from_b}, 2))",
        f"delta_{ab}": f"{a} - {b}",
        f"delta_{ba}": f"{b} - {a}",
        f"trend_ratio_{ba}": b_over_a,
        f"trend_ratio_{ab}": a_over_b,
        f"trend_cluster_{ba}": _trend(b_over_a),
        f"trend_cluster_{ab}": _trend(a_over_b),
    }, prefix)


def _family_moments(family: str, columns: Sequence[str]) -> list[str]:
    """First-stage helpers of a family: how many values, their mean and sum, the sorted values."""
    xs = [f"double(`{c}`)" for c in columns]
    count = " + ".join(f"int({x} IS NOT NULL)" for x in xs)
    total = " + ".join(f"coalesce({x}, 0D)" for x in xs)
    return [f"{count} AS `_n_{family}`", f"{total} AS `_s_{family}`",
            f"try_divide({total}, {count}) AS `_m_{family}`",
            f"sort_array(array({', '.join(xs)})) AS `_v_{family}`"]


def _family_statistics(family: str, columns: Sequence[str], prefix: str) -> list[str]:
    xs = [f"double(`{c}`)" for c in columns]
    n, s, mean, ordered = (f"`_{h}_{family}`" for h in "nsmv")
    m2, m3, m4 = ("(" + " + ".join(f"coalesce(power({x} - {mean}, {k}), 0D)" for x in xs) + ")"
                  for k in (2, 3, 4))
    # sort_array puts NULLs first: the values start at position len - n
    gap = f"{len(xs)} - {n}"
    low, high = f"get({ordered}, int({gap} + ({n} - 1) div 2))", f"get({ordered}, int({gap} + {n} div 2))"
    return _named({
        "skewness": f"try_divide(sqrt({n}) * {m3}, power({m2}, 1.5D))",
        "kurtosis": f"try_divide({n} * {m4}, {m2} * {m2}) - 3D",
        "sum": f"CASE WHEN {n} > 0 THEN {s} END",
        "median": f"CASE WHEN {n} > 0 THEN ({low} + {high}) / 2 END",
        "mean": mean,
        "max": f"greatest({', '.join(xs)})" if len(xs) > 1 else xs[0],
        "min": f"least({', '.join(xs)})" if len(xs) > 1 else xs[0],
        "stddev": f"CASE WHEN {n} > 1 THEN sqrt({m2} / ({n} - 1)) END",
    }, prefix, f"_{family}")


@dataclass(frozen=True)
class FamilySpec:
    """Which columns get unary features, which ordered pairs are compared, and which named groups of
    columns are summarised row-wise."""

    name: str
    unary: Sequence[str] = ()
    pairs: Sequence[tuple[str, str]] = ()
    families: dict[str, Sequence[str]] = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        used = [*self.unary, *[c for p in self.pairs for c in p],
                *[c for cs in self.families.values() for c in cs]]
        return list(dict.fromkeys(used))

    def new_columns(self) -> int:
        return 20 * len(self.unary) + 13 * len(self.pairs) + 8 * len(self.families)


def group_by_stem(columns: Sequence[str], stems: Sequence[str], sort: bool = True,
                  drop: Sequence[str] = ()) -> dict[str, list[str]]:
    """Columns containing each stem, in name order or in the given order."""
    left = [c for c in columns if c not in set(drop)]
    return {s: [c for c in (sorted(left) if sort else left) if s in c] for s in stems}


def adjacent_pairs(families: dict[str, Sequence[str]]) -> list[tuple[str, str]]:
    """Neighbouring horizons within each family."""
    return [pair for cols in families.values() for pair in zip(cols, cols[1:])]


def crossed_pairs(families: dict[str, Sequence[str]]) -> list[tuple[str, str]]:
    """Each horizon of one family against the next horizon of the other (two families)."""
    one, two = families.values()
    return [*zip(one, two[1:]), *zip(two, one[1:])]


def behaviour_spec() -> FamilySpec:
    groups = group_by_stem(names.BEHAVIOUR, ["count", "perc_good", "atraso_medio", "atraso_minimo",
                                             "pg_em_dia", "vl_total"])
    return FamilySpec("materialidade_90", sorted(names.BEHAVIOUR), adjacent_pairs(groups), groups)


def concentration_spec(crossed: bool = True) -> FamilySpec:
    """``crossed`` compares payer with beneficiary horizons, otherwise each side with itself."""
    groups = group_by_stem(names.CONCENTRATION, names.CONCENTRATION_STEMS, sort=False)
    pairs = crossed_pairs(groups) if crossed else adjacent_pairs(groups)
    return FamilySpec("hefindahl", sorted(names.CONCENTRATION), pairs, groups)


def liquidity_spec() -> FamilySpec:
    groups = group_by_stem(names.LIQUIDITY, names.LIQUIDITY_STEMS, sort=False)
    return FamilySpec("indice_liquidez", sorted(names.LIQUIDITY), adjacent_pairs(groups), groups)


def ranking_spec() -> FamilySpec:
    groups = group_by_stem(names.RANKING, names.RANKING_STEMS, sort=False)
    return FamilySpec("ranking_pcr", sorted(names.RANKING), adjacent_pairs(groups), groups)


def trend_spec() -> FamilySpec:
    return FamilySpec("trend", sorted(names.TREND))


FAMILY_SPECS = {"materialidade_90": behaviour_spec, "hefindahl": concentration_spec,
                "indice_liquidez": liquidity_spec, "ranking_pcr": ranking_spec, "trend": trend_spec}


def derive_family(df: DataFrame, spec: FamilySpec, keep: Sequence[str] | None = None,
                  prefix: str = PREFIX) -> DataFrame:
    """``keep`` columns (default: all) plus the derived columns of one family."""
    kept = [f"`{c}`" for c in (df.columns if keep is None else keep)]
    staged = df
    if spec.families:
        wanted = dict.fromkeys([*kept, *[f"`{c}`" for c in spec.inputs]])
        staged = df.selectExpr(*wanted, *[e for f, cs in spec.families.items()
                                          for e in _family_moments(f, cs)])
    return staged.selectExpr(
        *kept,
        *[e for c in spec.unary for e in unary_features(c, prefix)],
        *[e for a, b in spec.pairs for e in pair_features(a, b, prefix)],
        *[e for f, cs in spec.families.items() for e in _family_statistics(f, cs, prefix)])


def row_statistics(df: DataFrame, columns: Sequence[str], family: str, keep: Sequence[str],
                   prefix: str = PREFIX) -> DataFrame:
    """Eight row-wise statistics of one group of columns, NULL elements ignored."""
    return derive_family(df, FamilySpec(family, families={family: list(columns)}), keep, prefix)


def derive_selected(df: DataFrame, bases: Sequence[str]) -> DataFrame:
    """All derived columns of the selected families, next to the input columns."""
    unknown = set(bases) - set(FAMILY_SPECS)
    if unknown:
        raise ValueError(f"unknown feature families: {sorted(unknown)}")
    specs = [FAMILY_SPECS[b]() for b in bases]
    merged = FamilySpec("+".join(bases), [c for s in specs for c in s.unary],
                        [p for s in specs for p in s.pairs],
                        {f: cs for s in specs for f, cs in s.families.items()})
    return derive_family(df, merged)
