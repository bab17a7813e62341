"""Row-wise statistics and derived-feature families."""

from __future__ import annotations

from pyspark.sql import types as T

from catalog.tables import Query, rs, wide_features, wide_sql, with_
from scorekit.functions import feature_names as names
from scorekit.operators import derive

PLAIN = [f"x{i}" for i in range(1, 6)]


def _rounded_doubles(df):
    return df.selectExpr(*[f"rint(`{f.name}` * 1000000D) / 1000000D + 0D AS `{f.name}`"
                           if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`" for f in df.schema.fields])


# independent SQL formulations --------------------------------------------------------------------

def unary_sql(c: str) -> list[tuple[str, str]]:
    q = f'"{c}"'
    real = {
        "polynomial_dg2": f"CASE WHEN {q} <> 0 THEN {q} * {q} END",
        "polynomial_dg3": f"CASE WHEN {q} <> 0 THEN {q} ** 3 END",
        "polynomial_dg4": f"CASE WHEN {q} <> 0 THEN {q} ** 4 END",
        "log_value": f"CASE WHEN {q} > 0 THEN ln({q}) END",
        "ln_value": f"CASE WHEN {q} > -1 THEN ln(1 + {q}) END",
        "cosine_value": f"cos({q})", "sine_value": f"sin({q})",
        "exp": f"exp({q})", "inverse": f"1 / nullif({q}, 0)",
        "sqrt": f"CASE WHEN {q} >= 0 THEN sqrt(CAST({q} AS FLOAT)) END",
        "tan_value": f"tan({q})",
        "arc_sin_value": f"CASE WHEN {q} BETWEEN -1 AND 1 THEN asin({q}) END",
        "arc_cos_value": f"CASE WHEN {q} BETWEEN -1 AND 1 THEN acos({q}) END",
        "arc_tan_value": f"atan({q})",
        "hiperbolic_cos": f"(exp({q}) + exp(-{q})) / 2", "hiperbolic_sin": f"(exp({q}) - exp(-{q})) / 2"}
    whole = {
        "multiple_of_10": f"CASE WHEN {q} % 10 = 0 THEN 1 ELSE 0 END",
        "is_null": f"CASE WHEN {q} IS NULL THEN 1 ELSE 0 END",
        "is_even": f"CASE WHEN {q} IS NOT NULL THEN CASE WHEN {q} % 2 = 0 THEN 1 ELSE 0 END END",
        "is_odd": f"CASE WHEN {q} IS NOT NULL THEN CASE WHEN {q} % 2 <> 0 THEN 1 ELSE 0 END END"}
    return ([(f"NEW__{k}_{c}", rs(f"({e})")) for k, e in real.items()]
            + [(f"NEW__{k}_{c}", e) for k, e in whole.items()])


def pair_sql(a: str, b: str) -> list[tuple[str, str]]:
    x, y = f'"{a}"', f'"{b}"'
    half = f"({x} - {y}) / 2"
    ratio_ba, ratio_ab = f"{y} / nullif({x}, 0)", f"{x} / nullif({y}, 0)"

    def cluster(e):
        return f"CASE WHEN {e} = 1 THEN 'Manteve' WHEN {e} > 1 THEN 'Aumentou' WHEN {e} < 1 THEN 'Diminuiu' END"
    both = f"mean_{a}_and_{b}"
    real = {
        f"sum_{b}_vs_{a}": f"{x} + {y}", f"mean_{b}_vs_{a}": f"({x} + {y}) / 2",
        f"delta_{a}_vs_{both}": half, f"delta_{b}_vs_{both}": f"-({half})",
        f"sqrt_of_delta_{a}_vs_{both}": f"({half}) * ({half})",
        f"sqrt_of_delta_{b}_vs_{both}": f"({half}) * ({half})",
        f"stddev_{b}_vs_{a}": f"abs({x} - {y}) / sqrt(2.0)",
        f"delta_{a}_vs_{b}": f"{x} - {y}", f"delta_{b}_vs_{a}": f"{y} - {x}",
        f"trend_ratio_{b}_vs_{a}": ratio_ba, f"trend_ratio_{a}_vs_{b}": ratio_ab}
    text = {f"trend_cluster_{b}_vs_{a}": cluster(ratio_ba), f"trend_cluster_{a}_vs_{b}": cluster(ratio_ab)}
    return ([("NEW__" + k, rs(f"({e})")) for k, e in real.items()]
            + [("NEW__" + k, e) for k, e in text.items()])


def stats_sql(family: str, columns) -> list[tuple[str, str]]:
    items = "list_filter([" + ", ".join(f'"{c}"' for c in columns) + "], lambda v: v IS NOT NULL)"
    m = f"list_avg({items})"
    n = f"len({items})"

    def power(k):
        return f"list_sum(list_transform({items}, lambda v: (v - {m}) ** {k}))"
    made = {
        "skewness": f"sqrt({n}) * {power(3)} / nullif({power(2)} ** 1.5, 0)",
        "kurtosis": f"{n} * {power(4)} / nullif({power(2)} ** 2, 0) - 3",
        "sum": f"list_sum({items})", "median": f"list_median({items})", "mean": m,
        "max": f"list_max({items})", "min": f"list_min({items})", "stddev": f"list_stddev_samp({items})"}
    return [(f"NEW__{k}_{family}", rs(f"({e})")) for k, e in made.items()]


def _select(keep, outputs, columns):
    return (with_(wide_sql(columns)) + "SELECT " + ", ".join(keep) + ",\n"
            + ",\n".join(f'{e} AS "{n}"' for n, e in outputs) + "\nFROM wide")


def family_sql(spec, columns) -> str:
    outputs = [o for c in spec.unary for o in unary_sql(c)]
    outputs += [o for a, b in spec.pairs for o in pair_sql(a, b)]
    outputs += [o for f, cs in spec.families.items() for o in stats_sql(f, cs)]
    return _select(["id"], outputs, columns)


def _family(spec, columns):
    def run(spark, sf):
        return _rounded_doubles(derive.derive_family(wide_features(spark, sf, columns), spec, ["id"]))
    return run


SPECS = {"fg5_behaviour_family": (derive.behaviour_spec(), names.BEHAVIOUR),
         "fg5_concentration_family": (derive.concentration_spec(), names.CONCENTRATION),
         "fg5_concentration_within_sides": (
             derive.FamilySpec("within", pairs=derive.concentration_spec(crossed=False).pairs),
             names.CONCENTRATION),
         "fg5_liquidity_family": (derive.liquidity_spec(), names.LIQUIDITY),
         "fg5_ranking_family": (derive.ranking_spec(), names.RANKING),
         "fg5_trend_family": (derive.trend_spec(), names.TREND)}

UNARY_SPEC = derive.FamilySpec("unary", unary=PLAIN)
PAIR_SPEC = derive.FamilySpec("pairs", pairs=list(zip(PLAIN, PLAIN[1:])))
STATS_SPEC = derive.FamilySpec("stats", families={"first": PLAIN[:3], "all": PLAIN})


def selected_families(spark, sf):
    """Two families chosen by name, next to the input columns."""
    df = wide_features(spark, sf, names.LIQUIDITY + names.CONCENTRATION)
    return _rounded_doubles(derive.derive_selected(df, ["indice_liquidez", "hefindahl"]))


def _selected_sql():
    columns = names.LIQUIDITY + names.CONCENTRATION
    outputs = []
    for spec in (derive.liquidity_spec(), derive.concentration_spec()):
        outputs += [o for c in spec.unary for o in unary_sql(c)]
        outputs += [o for a, b in spec.pairs for o in pair_sql(a, b)]
        outputs += [o for f, cs in spec.families.items() for o in stats_sql(f, cs)]
    return _select(["id", *[f'{rs(chr(34) + c + chr(34))} AS "{c}"' for c in columns]], outputs, columns)


def row_statistics(spark, sf):
    return _rounded_doubles(derive.row_statistics(wide_features(spark, sf, PLAIN), PLAIN, "x", ["id"]))


QUERIES = [
    Query("ag4_row_statistics", row_statistics, _select(["id"], stats_sql("x", PLAIN), PLAIN)),
    Query("fg1_unary_features", _family(UNARY_SPEC, PLAIN), family_sql(UNARY_SPEC, PLAIN)),
    Query("fg2_pairwise_features", _family(PAIR_SPEC, PLAIN), family_sql(PAIR_SPEC, PLAIN)),
    Query("fg3_family_statistics", _family(STATS_SPEC, PLAIN), family_sql(STATS_SPEC, PLAIN)),
    *[Query(name, _family(spec, cols), family_sql(spec, cols)) for name, (spec, cols) in SPECS.items()],
    Query("fg6_selected_families", selected_families, _selected_sql()),
]
