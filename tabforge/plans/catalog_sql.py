"""SQL counterparts of the catalog queries, for the tables of the test data."""

from __future__ import annotations

from tabforge.config import STANDARD_RANGES
from tabforge.plans.tuning import RIDGE_ALPHAS, RIDGE_SPACE, sample_space
from tabforge.sources.views import FEATURES, KEYS, MIX_SQL, TARGET

ORACLES: dict[str, str] = {}

K = ", ".join(KEYS)
PREDICTORS = [*FEATURES, "W/C", "Sp/C_pct"]
NUMBERS = [*PREDICTORS, TARGET]
RATIO_FREE = [c for c in PREDICTORS if c != "W/C"]
PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
SP, FA = '"Sp/C_pct"', '"Fine Aggregate"'
ABNORMAL = f"({SP} >= 0.07 OR {FA} > 970)"
COMBINE = f"({SP} >= 0.07 OR {FA} >= 970)"

MIX = f"""WITH mix AS ({MIX_SQL}),
m AS (SELECT *, CASE WHEN "Cement" <> 0 THEN "Water" / "Cement" END AS "W/C",
             CASE WHEN "Cement" <> 0 THEN "Superplasticizer" / "Cement" END AS "Sp/C_pct" FROM mix)"""


def q(name: str) -> str:
    return '"' + name + '"'


def each(names, template: str, glue: str = " UNION ALL ") -> str:
    """Template repeated per name: {n} is the name as text, {c} the quoted column."""
    return glue.join(template.format(n=n, c=q(n)) for n in names)


def long(names, source: str = "m", extra: str = "") -> str:
    return each(names, "SELECT '{n}' AS feature, CAST({c} AS DOUBLE) AS x" + extra + f" FROM {source}")


# Column behind each configured range; the target is never tested by the outlier rules.
RANGE_COLUMNS = {
    "age": "Age", "cement": "Cement", "coarse_aggregate": "Coarse Aggregate",
    "fine_aggregate": "Fine Aggregate", "fly_ash": "Fly Ash", "sp_c_pct": "Sp/C_pct",
    "w_c": "W/C", "water": "Water",
}


def beyond(key: str) -> str:
    r, c = STANDARD_RANGES[key], q(RANGE_COLUMNS[key])
    return f"({c} < {r['min']} OR {c} > {r['max']})"


RANGE_HIT = "(" + " OR ".join(beyond(k) for k in RANGE_COLUMNS) + ")"
RANGE_FLAGS = ", ".join(
    f"CAST({beyond(k)} AS INTEGER) AS \"Outlier_{k}\"" for k in RANGE_COLUMNS)
HIGH_FLAGS = (f'CAST({SP} >= 0.025 AS INTEGER) AS "High_SP", '
              f'CAST({FA} >= 800 AS INTEGER) AS "High_FA"')

BOUNDS = f""", long AS ({long(NUMBERS)}),
qs AS (SELECT feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM long GROUP BY feature),
b AS (SELECT feature, q1, q3, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower,
             q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper FROM qs)"""


def fence(name: str) -> str:
    c = q(name)
    return (f"({c} < (SELECT lower FROM b WHERE feature = '{name}') "
            f"OR {c} > (SELECT upper FROM b WHERE feature = '{name}'))")


IQR_HIT = "(" + " OR ".join(fence(n) for n in PREDICTORS) + ")"

# ---- sources, projections, filters -------------------------------------------------------

ORACLES["scan_parquet"] = f"""SELECT {K}, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag
FROM lineitem"""
ORACLES["ratios"] = f"""SELECT {K}, l_quantity, l_extendedprice, l_discount, l_tax,
CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount END AS price_by_discount,
CASE WHEN l_quantity <> 0 THEN l_tax / l_quantity END AS tax_by_quantity FROM lineitem"""
ORACLES["drop_duplicates"] = "SELECT DISTINCT l_quantity, l_tax FROM lineitem"
ORACLES["clean"] = "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem"
ORACLES["outlier_abnormal"] = f"{MIX} SELECT {K}, {SP}, {FA} FROM m WHERE NOT {ABNORMAL}"
ORACLES["outlier_combine"] = f"{MIX} SELECT {K}, {HIGH_FLAGS} FROM m WHERE NOT {COMBINE}"
ORACLES["outlier_range_flags"] = f"{MIX} SELECT {K}, {RANGE_FLAGS} FROM m"
ORACLES["outlier_range_remove"] = f"""{MIX} SELECT {K}, "Age", "W/C" FROM m WHERE NOT {RANGE_HIT}"""
ORACLES["outlier_iqr_remove"] = f"""{MIX}{BOUNDS} SELECT {K}, "W/C", {SP} FROM m WHERE NOT {IQR_HIT}"""
ORACLES["iqr_bounds"] = f"""{MIX}{BOUNDS} SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3,
round(lower, 6) AS lower, round(upper, 6) AS upper FROM b"""
ORACLES["outlier_chain"] = f"{MIX} SELECT {K}, {RANGE_FLAGS}, {HIGH_FLAGS} FROM m WHERE NOT {COMBINE}"


def _summary() -> str:
    def line(step, strategy, kind, feature, threshold, hit):
        text = ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"
                         for v in (strategy, kind, feature, threshold))
        s, k, f, t = text.split(", ")
        return (f"SELECT CAST({step} AS INTEGER) AS step, {s} AS strategy, {k} AS kind, "
                f"{f} AS feature, {t} AS threshold, count(*) FILTER (WHERE {hit}) AS hits FROM m")
    lines = []
    for key in RANGE_COLUMNS:
        r = STANDARD_RANGES[key]
        lines.append(line(0, "gost_binar", "flag", key, f"{r['min']}-{r['max']}", beyond(key)))
    lines += [
        line(1, "combine", "flag", "High_SP", "0.025", f"{SP} >= 0.025"),
        line(1, "combine", "flag", "High_FA", "800", f"{FA} >= 800"),
        line(1, "combine", "removed_rows", None, None, COMBINE),
        line(2, "abnormal", "drop", "Sp/C_pct", "0.07", f"NOT {COMBINE} AND {SP} >= 0.07"),
        line(2, "abnormal", "drop", "Fine Aggregate", "970", f"NOT {COMBINE} AND {FA} > 970"),
        line(2, "abnormal", "removed_rows", None, None, f"NOT {COMBINE} AND {ABNORMAL}"),
        line(-1, None, "input_rows", None, None, "true"),
        line(-1, None, "final_rows", None, None, f"NOT {COMBINE} AND NOT {ABNORMAL}"),
    ]
    return MIX + " " + " UNION ALL ".join(lines)


ORACLES["outlier_summary"] = _summary()
ORACLES["outlier_union"] = f"""{MIX} SELECT {K} FROM m WHERE {ABNORMAL}
UNION ALL SELECT {K} FROM m WHERE {RANGE_HIT} AND NOT {ABNORMAL}"""
ORACLES["removed_rows_anti"] = f"""{MIX}, bad AS (SELECT {K} FROM m WHERE {ABNORMAL})
SELECT {K}, "Strength" FROM m WHERE NOT EXISTS (SELECT 1 FROM bad WHERE
{" AND ".join(f"bad.{k} = m.{k}" for k in KEYS)})"""


def _comparison() -> str:
    cases = [("abnormal", ABNORMAL, 0), ("combine", COMBINE, 2),
             ("gost_binar", "false", len(RANGE_COLUMNS)), ("gost_remove", RANGE_HIT, 0),
             ("iqr_remove", IQR_HIT, 0), ("gost_binar+combine", COMBINE, len(RANGE_COLUMNS) + 2)]
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS strategy, count(*) AS original_rows, count(*) FILTER (WHERE NOT {hit}) "
        f"AS final_rows, count(*) FILTER (WHERE {hit}) AS removed_rows, CAST({flags} AS INTEGER) "
        "AS created_features FROM m" for n, hit, flags in cases)
    return f"""{MIX}{BOUNDS}, c AS ({rows}) SELECT strategy, original_rows, final_rows, removed_rows,
round(removed_rows * CAST(100 AS DOUBLE) / original_rows, 4) AS removed_pct, created_features FROM c"""


ORACLES["strategy_comparison"] = _comparison()


def _count_outliers(source: str, alias: str) -> str:
    return f"""SELECT l.feature, count(*) FILTER (WHERE x < q1 - CAST(1.5 AS DOUBLE) * (q3 - q1)
 OR x > q3 + CAST(1.5 AS DOUBLE) * (q3 - q1)) AS {alias} FROM ({source}) l JOIN
 (SELECT feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM ({source})
  GROUP BY feature) USING (feature) GROUP BY l.feature"""


ORACLES["outliers_before_after"] = f"""{MIX},
kept AS (SELECT * FROM m WHERE NOT {ABNORMAL} AND NOT {RANGE_HIT})
SELECT * FROM ({_count_outliers(long(PREDICTORS), '"before"')}) JOIN
({_count_outliers(long(PREDICTORS, "kept"), '"after"')}) USING (feature)"""

# ---- derived features --------------------------------------------------------------------

POWDER = '("Cement" + "Blast Furnace Slag" + "Fly Ash")'
ORACLES["fe_base"] = f"""{MIX} SELECT {K}, {POWDER} AS "Total_powder",
CASE WHEN {FA} > 0 THEN "Coarse Aggregate" / {FA} ELSE 0 END AS "Aggregate_ratio",
CASE WHEN "Water" > 0 THEN {POWDER} / "Water" ELSE 0 END AS "Binder_water_ratio" FROM m"""
ORACLES["fe_trees"] = f"""{MIX}, t AS (SELECT quantile_cont("W/C", 0.25) AS lo,
quantile_cont("W/C", 0.75) AS hi FROM m)
SELECT {K}, {POWDER} AS "Total_powder", CAST("Blast Furnace Slag" > 0 AS INTEGER) AS "Has_Slag",
CAST("Fly Ash" > 0 AS INTEGER) AS "Has_FlyAsh",
CAST("Superplasticizer" > 0 AS INTEGER) AS "Has_Superplasticizer",
CAST("W/C" < lo AS INTEGER) AS "Low_WC_ratio", CAST("W/C" > hi AS INTEGER) AS "High_WC_ratio",
CAST("W/C" < CAST(0.4 AS DOUBLE) AS INTEGER) AS "Low_WC_tech",
CAST("W/C" > CAST(0.6 AS DOUBLE) AS INTEGER) AS "High_WC_tech" FROM m, t"""
ORACLES["fe_thresholds"] = f"""{MIX} SELECT round(quantile_cont("W/C", 0.25), 9) AS low_adaptive,
round(quantile_cont("W/C", 0.75), 9) AS high_adaptive FROM m"""
ORACLES["zero_flags"] = f"""{MIX} SELECT {K}, """ + each(
    ["Blast Furnace Slag", "Fly Ash", "Sp/C_pct"],
    'CAST({c} > 0 AS INTEGER) AS "{n}_binary"', ", ") + " FROM m"


def transform_sql(name: str, x: str) -> str:
    return {
        "Linear": x,
        "Log": f"CASE WHEN {x} IS NOT NULL THEN ln(greatest({x}, CAST(1e-8 AS DOUBLE))) END",
        "Sqrt": f"CASE WHEN {x} IS NOT NULL THEN sqrt(greatest({x}, CAST(0 AS DOUBLE))) END",
        "1/x": f"CAST(1 AS DOUBLE) / (CASE WHEN {x} = 0 THEN CAST(1e-8 AS DOUBLE) ELSE abs({x}) END)",
        "x²": f"({x}) * ({x})",
    }[name]


def curve_sql(name: str, x: str) -> str:
    e = "CAST(1e-10 AS DOUBLE)"
    return {
        "Linear": x,
        "Log": f"CASE WHEN {x} + {e} > 0 THEN ln({x} + {e}) END",
        "Sqrt": f"CASE WHEN {x} >= 0 THEN sqrt({x}) END",
        "1/x": f"CASE WHEN {x} + {e} <> 0 THEN CAST(1 AS DOUBLE) / ({x} + {e}) END",
        "x²": f"({x}) * ({x})",
    }[name]


AGE = 'CAST("Age" AS DOUBLE)'
_T = {"Linear": "t_linear", "Log": "t_log", "Sqrt": "t_sqrt", "1/x": "t_inverse", "x²": "t_square"}
_C = {"Linear": "c_linear", "Log": "c_log", "Sqrt": "c_sqrt", "1/x": "c_inverse", "x²": "c_square"}
ORACLES["scalar_transforms"] = f"{MIX} SELECT {K}, " + ", ".join(
    f"round({transform_sql(n, AGE)}, 6) AS {a}" for n, a in _T.items()) + " FROM m"
ORACLES["trend_curves"] = f"{MIX} SELECT {K}, " + ", ".join(
    f"round({curve_sql(n, AGE)}, 6) AS {a}" for n, a in _C.items()) + " FROM m"
ORACLES["apply_transforms"] = f"{MIX} SELECT {K}, " + ", ".join(
    f"round({transform_sql(t, 'CAST(' + q(c) + ' AS DOUBLE)')}, 6) AS {q(c)}" for c, t in
    {"Cement": "Sqrt", "Water": "1/x", "Fine Aggregate": "x²", "Age": "Log"}.items()
) + ', round("Strength", 6) AS "Strength" FROM m'
_SCALED = ["Cement", "Water", "Age", "W/C"]
ORACLES["standard_scale"] = f"{MIX}, s AS (SELECT " + ", ".join(
    f"avg({q(c)}) AS m{i}, stddev_pop({q(c)}) AS s{i}" for i, c in enumerate(_SCALED)
) + f" FROM m) SELECT {K}, " + ", ".join(
    f"round(({q(c)} - m{i}) / s{i}, 6) AS {q(c)}" for i, c in enumerate(_SCALED)) + " FROM m, s"

# ---- profiles ----------------------------------------------------------------------------

_LIMITS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({STANDARD_RANGES[k]['min']} AS DOUBLE) AS lo, "
    f"CAST({STANDARD_RANGES[k]['max']} AS DOUBLE) AS hi"
    for k, c in {**RANGE_COLUMNS, "strength": "Strength"}.items())
ORACLES["detect_outliers"] = f"""{MIX}{BOUNDS}, lim AS ({_LIMITS})
SELECT feature, round(any_value(q1), 3) AS "Q1", round(any_value(q3), 3) AS "Q3",
round(any_value(q3 - q1), 3) AS "IQR", round(any_value(lower), 3) AS "Lower_Bound",
round(any_value(upper), 3) AS "Upper_Bound",
count(*) FILTER (WHERE x < lower OR x > upper) AS "n_outliers_IQR",
any_value(lo) AS standard_min, any_value(hi) AS standard_max,
CASE WHEN any_value(lo) IS NOT NULL THEN count(*) FILTER (WHERE x < lo OR x > hi) END
AS n_outliers_standard
FROM long JOIN b USING (feature) LEFT JOIN lim USING (feature) GROUP BY feature"""
ORACLES["outlier_masks"] = f"{MIX}{BOUNDS} SELECT {K}, " + ", ".join(
    f"{fence(n)} AS {q(n)}" for n in NUMBERS) + " FROM m"
ORACLES["topk_outlier_features"] = f"""{MIX}{BOUNDS}
SELECT feature, count(*) FILTER (WHERE x < lower OR x > upper) AS "n_outliers_IQR"
FROM long JOIN b USING (feature) GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 3"""
ORACLES["quantiles"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS p, "
    f"round(quantile_cont({c}, {p}), 6) AS value FROM {t}"
    for t, c in (("events", "value"), ("lineitem", "l_extendedprice"), ("lineitem", "l_discount"))
    for p in PROBS)
ORACLES["missing_values"] = """SELECT * FROM (
SELECT 'tax' AS column_name, count(*) FILTER (WHERE l_linenumber = 7) AS n_missing FROM lineitem
UNION ALL SELECT 'quantity', count(*) FILTER (WHERE l_linenumber <= 2) FROM lineitem
UNION ALL SELECT 'status', count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem
UNION ALL SELECT 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem)
WHERE n_missing > 0"""
_QUARTS = ", ".join(f"round(quantile_cont(x, {p}), 4) AS {n}"
                    for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
ORACLES["describe"] = f"""{MIX}, long AS ({long(NUMBERS)})
SELECT feature, count(x) AS "count", round(avg(x), 4) AS mean, round(stddev(x), 4) AS std,
round(min(x), 4) AS "min", {_QUARTS}, round(max(x), 4) AS "max" FROM long GROUP BY feature"""
ORACLES["mode_share"] = """WITH v AS (
SELECT 'l_quantity' AS feature, l_quantity AS num, CAST(NULL AS VARCHAR) AS txt FROM lineitem
UNION ALL SELECT 'l_discount', l_discount, NULL FROM lineitem
UNION ALL SELECT 'l_tax', l_tax, NULL FROM lineitem
UNION ALL SELECT 'many', CAST(l_quantity > 1 AS DOUBLE), NULL FROM lineitem
UNION ALL SELECT 'l_returnflag', NULL, l_returnflag FROM lineitem
UNION ALL SELECT 'l_linestatus', NULL, l_linestatus FROM lineitem),
c AS (SELECT feature, num, txt, count(*) AS cnt FROM v GROUP BY ALL),
r AS (SELECT *, sum(cnt) OVER (PARTITION BY feature) AS total,
      row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, num, txt) AS pos FROM c)
SELECT feature, round(num, 6) AS mode_number, txt AS mode_text, cnt AS mode_count,
CAST(total AS BIGINT) AS n_values, round(cnt / CAST(total AS DOUBLE), 6) AS share
FROM r WHERE pos = 1"""
ORACLES["value_counts"] = 'SELECT l_returnflag, count(*) AS "count" FROM lineitem GROUP BY 1'
ORACLES["profile"] = f"""{MIX}, long AS ({long(NUMBERS)})
SELECT feature, count(*) AS n, count(*) FILTER (WHERE x IS NULL) AS n_missing,
count(DISTINCT x) AS n_distinct, count(*) FILTER (WHERE x = 0) AS n_zero,
round(min(x), 4) AS "min", {_QUARTS}, round(max(x), 4) AS "max", round(avg(x), 4) AS mean,
round(stddev(x), 4) AS std FROM long GROUP BY feature"""
_W = ["l_quantity", "l_discount", "l_extendedprice", "net", "tax"]
ORACLES["profile_warnings"] = f"""WITH m AS (SELECT l_quantity, l_discount, l_extendedprice,
l_extendedprice * (1 - l_discount) AS net, CASE WHEN l_linenumber <> 7 THEN l_tax END AS tax,
l_quantity * 0 AS zero FROM lineitem), long AS ({long([*_W, "zero"])}),
p AS (SELECT feature, count(*) AS n, count(*) FILTER (WHERE x IS NULL) AS gaps,
      count(DISTINCT x) AS d, count(*) FILTER (WHERE x = 0) AS z FROM long GROUP BY feature),
r AS ({" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM m"
                          for a in _W for b in _W if a < b)})
SELECT 'constant' AS warning, feature, CAST(NULL AS VARCHAR) AS other FROM p WHERE d <= 1
UNION ALL SELECT 'missing', feature, NULL FROM p WHERE gaps > n * CAST(0.05 AS DOUBLE)
UNION ALL SELECT 'zeros', feature, NULL FROM p WHERE z > n * CAST(0.05 AS DOUBLE)
UNION ALL SELECT 'high_correlation', a, b FROM r WHERE abs(r) > 0.9"""
ORACLES["boxplot_stats"] = f"""{MIX}, long AS ({long(NUMBERS)}),
qs AS (SELECT feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2,
       quantile_cont(x, 0.75) AS q3 FROM long GROUP BY feature),
b AS (SELECT *, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo,
      q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM qs)
SELECT feature, round(min(x), 6) AS "min", round(any_value(q1), 6) AS q1,
round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3, round(max(x), 6) AS "max",
round(min(x) FILTER (WHERE x >= lo), 6) AS whisker_low,
round(max(x) FILTER (WHERE x <= hi), 6) AS whisker_high,
count(*) FILTER (WHERE x < lo OR x > hi) AS n_outliers
FROM long JOIN b USING (feature) GROUP BY feature"""
_BIN = [*PREDICTORS, "High_Cement", "two_valued"]
ORACLES["binary_features"] = f"""{MIX}, w AS (SELECT *, CAST("Cement" > 400 AS INTEGER) AS "High_Cement",
CASE WHEN "Age" > 0 THEN 5 ELSE 9 END AS two_valued FROM m), long AS ({long(_BIN, "w")}),
d AS (SELECT feature, feature = 'High_Cement' AS by_name, count(DISTINCT x) <= 2 AS by_values
      FROM long GROUP BY feature)
SELECT feature, by_name, by_values, by_name OR by_values AS is_binary FROM d"""
ORACLES["drop_uninformative"] = f"""SELECT {K}, l_tax, l_returnflag,
CAST(l_quantity > 5 AS INTEGER) AS "some" FROM lineitem"""

# ---- association -------------------------------------------------------------------------

_XY = ', CAST("Strength" AS DOUBLE) AS y'
ORACLES["pearson"] = f"""{MIX}, long AS ({long(PREDICTORS, extra=_XY)})
SELECT feature, count(*) AS n, round(corr(x, y), 8) AS pearson_corr FROM long GROUP BY feature"""
ORACLES["skew_kurt"] = """WITH a AS (SELECT avg("value") AS mu FROM events),
s AS (SELECT avg(power("value" - mu, 2)) AS m2, avg(power("value" - mu, 3)) AS m3,
      avg(power("value" - mu, 4)) AS m4 FROM events, a)
SELECT 'value' AS feature, round(m3 / power(m2, 1.5), 6) AS skewness,
round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM s"""


def t_tail(t: str, v: str) -> str:
    """Two-sided p of Student's t with v degrees of freedom: its density by Simpson's rule."""
    step = f"(least(abs({t}), 40) / 800)"
    area = (f"list_sum(list_transform(range(0, 801), lambda z: (CASE WHEN z % 800 = 0 THEN 1 "
            f"WHEN z % 2 = 1 THEN 4 ELSE 2 END) * power(1 + z * {step} * z * {step} / {v}, "
            f"-({v} + 1) / CAST(2 AS DOUBLE)))) * {step} / 3")
    density = f"exp(lgamma(({v} + 1) / CAST(2 AS DOUBLE)) - lgamma({v} / CAST(2 AS DOUBLE))) / sqrt({v} * pi())"
    return f"greatest(CAST(0 AS DOUBLE), 1 - 2 * {density} * {area})"


def _ranks(names, source: str) -> str:
    """Distinct values with counts and average ranks."""
    return f"""SELECT feature, x AS "value", cnt, (upto - cnt + 1 + upto) / CAST(2 AS DOUBLE) AS avg_rank
FROM (SELECT feature, x, count(*) AS cnt, sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS upto
      FROM ({long(names, source)}) WHERE x IS NOT NULL GROUP BY feature, x)"""


ORACLES["avg_rank"] = _ranks(["l_quantity", "l_extendedprice"], "lineitem")


def _spearman(names) -> str:
    """Rank correlation with the target: average rank = rank + (ties - 1) / 2. Each feature is
    ranked, and the target with it, over the rows where both are present."""
    def ranked(c: str) -> str:
        return (f"rank() OVER (PARTITION BY feature ORDER BY {c}) "
                f"+ (count(*) OVER (PARTITION BY feature, {c}) - 1) / CAST(2 AS DOUBLE)")
    return f"""pairs AS ({long(names, extra=_XY)}),
ranks AS (SELECT feature, {ranked("x")} AS rx, {ranked("y")} AS ry FROM pairs
          WHERE x IS NOT NULL AND y IS NOT NULL),
sp AS (SELECT feature, count(*) AS n, corr(rx, ry) AS r FROM ranks GROUP BY feature)"""


def _analysis(view: str) -> str:
    return f"""{view}, {_spearman(PREDICTORS)},
mu AS (SELECT feature, avg(x) AS mu FROM pairs GROUP BY feature),
mo AS (SELECT feature, corr(x, y) AS p, avg(power(x - mu, 2)) AS m2, avg(power(x - mu, 3)) AS m3,
       avg(power(x - mu, 4)) AS m4 FROM pairs JOIN mu USING (feature) GROUP BY feature),
fa AS (SELECT *, n - 2 AS v, r * sqrt((n - 2) / (1 - r * r)) AS t FROM mo JOIN sp USING (feature))
SELECT feature, round(p, 6) AS pearson_corr, round(r, 6) AS spearman_corr,
round({t_tail("t", "v")}, 4) AS spearman_p_value,
round(m3 / power(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM fa"""


ORACLES["spearman"] = f"""{MIX}, {_spearman(PREDICTORS)}
SELECT feature, n, round(r, 8) AS spearman FROM sp"""
ORACLES["feature_analysis"] = _analysis(MIX)
_GAPS = ", ".join(f"CASE WHEN (l_partkey + {i}) % {7 + i} <> 0 THEN {q(c)} END AS {q(c)}"
                  for i, c in enumerate(PREDICTORS) if i % 2)
ORACLES["feature_analysis_gaps"] = _analysis(
    MIX.replace("m AS (", "full_m AS (") + f", m AS (SELECT * REPLACE ({_GAPS}) FROM full_m)")
ORACLES["corr_matrix"] = f"{MIX} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({q(a)}, {q(b)}), 8) AS r FROM m"
    for a in PREDICTORS for b in PREDICTORS)


ORACLES["corr_lower_triangle"] = f"{MIX} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({q(a)}, {q(b)}), 8) AS r FROM m"
    for i, a in enumerate(PREDICTORS) for b in PREDICTORS[:i])


def _vif(pair: str) -> str:
    """Diagonal of the inverse, by elimination; ``pair`` is the (co)relation of {a} and {b}."""
    n = len(PREDICTORS)
    cells = [[pair.format(a=q(PREDICTORS[min(i, j)]), b=q(PREDICTORS[max(i, j)])) if i != j
              else "CAST(1 AS DOUBLE)" for j in range(n)] for i in range(n)]
    rows = ", ".join(f"[{', '.join(row)}]" for row in cells)
    names = ", ".join(f"'{c}'" for c in PREDICTORS)
    return f"""{MIX.replace("WITH mix", "WITH RECURSIVE mix", 1)},
inv AS (SELECT 1 AS k, [{rows}] AS s FROM m UNION ALL
  SELECT k + 1, list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 1}),
    lambda j: CASE WHEN i = k AND j = k THEN 1 / s[k][k] WHEN i = k THEN s[k][j] / s[k][k]
      WHEN j = k THEN -s[i][k] / s[k][k] ELSE s[i][j] - s[i][k] * s[k][j] / s[k][k] END))
  FROM inv WHERE k <= {n}),
v AS (SELECT unnest([{names}]) AS "Feature", unnest(list_transform(range(1, {n + 1}),
  lambda i: s[i][i])) AS "VIF" FROM inv WHERE k = {n + 1})"""


_CORR = "corr({a}, {b})"
_COS = "sum({a} * {b}) / sqrt(sum({a} * {a}) * sum({b} * {b}))"
ORACLES["vif_centered"] = f'{_vif(_CORR)} SELECT "Feature", round("VIF", 6) AS "VIF" FROM v'
ORACLES["vif_uncentered"] = f'{_vif(_COS)} SELECT "Feature", round("VIF", 6) AS "VIF" FROM v'
ORACLES["vif_bands"] = f"""{_vif(_CORR)} SELECT "Feature", CASE WHEN "VIF" >= 3 THEN 'high'
WHEN "VIF" >= 1.4 THEN 'medium' ELSE 'none' END AS severity FROM v"""
_PRICED = f"""WITH m AS (SELECT {K}, l_extendedprice, l_extendedprice * (1 - l_discount) AS net,
l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross, l_quantity, l_discount, l_tax FROM lineitem)"""
_PN = ["l_extendedprice", "net", "gross", "l_quantity", "l_discount", "l_tax"]
ORACLES["extreme_corr_pairs"] = _PRICED + ", r AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM m"
    for i, a in enumerate(_PN) for b in _PN[i + 1:]
) + ") SELECT a, b, round(r, 6) AS r FROM r WHERE abs(r) > 0.9"
ORACLES["drop_collinear"] = f"""{_PRICED} SELECT {K}, l_extendedprice, l_quantity, l_discount, l_tax FROM m"""

# ---- zero-effect tests -------------------------------------------------------------------


def _zero_tests(features, level: str) -> str:
    """Levene's statistic and the t test of positive minus zero for each feature.

    ``level`` is the condition on Levene's p under which Student's test is taken; its F has
    one degree of freedom above, so it is the square of a t.
    """
    groups = each(features, "SELECT '{n}' AS feature, {c} > 0 AS pos, \"Strength\" AS y FROM m")
    return f"""{MIX}, g AS ({groups}),
md AS (SELECT feature, pos, median(y) AS md FROM g GROUP BY feature, pos),
s AS (SELECT feature, pos, count(*) AS n, avg(y) AS mean, var_samp(y) AS v,
      avg(abs(y - md)) AS zm, var_pop(abs(y - md)) * count(*) AS zs
      FROM g JOIN md USING (feature, pos) GROUP BY feature, pos),
w AS (SELECT a.feature, a.n AS n0, b.n AS n1, a.mean AS mean0, b.mean AS mean1, a.v AS v0, b.v AS v1,
      a.zm AS z0, b.zm AS z1, a.zs + b.zs AS inner_s,
      (a.n * a.zm + b.n * b.zm) / (a.n + b.n) AS zc
      FROM s a JOIN s b ON a.feature = b.feature AND NOT a.pos AND b.pos),
l AS (SELECT *, (n0 + n1 - 2) * (n0 * (z0 - zc) * (z0 - zc) + n1 * (z1 - zc) * (z1 - zc)) / inner_s
      AS levene FROM w),
t AS (SELECT *, {t_tail("sqrt(levene)", "(n0 + n1 - 2)")} {level} AS pooled, ((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) AS vp,
      v0 / n0 AS e0, v1 / n1 AS e1 FROM l),
d AS (SELECT *, (mean1 - mean0) / sqrt(CASE WHEN pooled THEN vp * (CAST(1 AS DOUBLE) / n0
        + CAST(1 AS DOUBLE) / n1) ELSE e0 + e1 END) AS t,
      CASE WHEN pooled THEN CAST(n0 + n1 - 2 AS DOUBLE) ELSE (e0 + e1) * (e0 + e1) /
        (e0 * e0 / (n0 - 1) + e1 * e1 / (n1 - 1)) END AS df FROM t)
SELECT feature, n0 AS n_zero, n1 AS n_positive, round(mean0, 5) AS mean_zero,
round(mean1, 5) AS mean_positive, round(levene, 5) AS levene, round(t, 5) AS t, round(df, 5) AS df,
round({t_tail("sqrt(levene)", "(n0 + n1 - 2)")}, 5) AS levene_p, round(p, 5) AS p,
CASE WHEN pooled THEN 'student' ELSE 'welch' END AS test, p < 0.05 AS significant
FROM (SELECT *, {t_tail("t", "df")} AS p FROM d)"""


ORACLES["zero_effect_test"] = _zero_tests(
    ["Blast Furnace Slag", "Fly Ash", "Superplasticizer"], ">= 0.05")
ORACLES["zero_encoder_fit"] = _zero_tests(["Blast Furnace Slag", "Fly Ash", "Sp/C_pct"], "> 0.05")

# ---- trends and transforms ---------------------------------------------------------------

_R2 = {"Linear": "linear_r2_score", "Log": "log_r2_score", "Sqrt": "sqrt_r2_score",
       "1/x": "reciprocal_r2_score", "x²": "square_r2_score"}


def _metrics(features, target: str) -> str:
    extra = f", CAST({q(target)} AS DOUBLE) AS y"
    parts = ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE ({curve_sql(n, 'x')}) IS NULL) = 0 THEN "
        f"coalesce(regr_r2(y, {curve_sql(n, 'x')}), 0) ELSE CAST('-infinity' AS DOUBLE) END AS {c}"
        for n, c in _R2.items())
    return f"tm AS (SELECT feature, {parts} FROM ({{src}}) GROUP BY feature)".replace(
        "{src}", long(features, extra=extra))


def _select(alpha: float) -> str:
    top = f"greatest({', '.join(_R2.values())})"
    first = "CASE " + " ".join(f"WHEN {c} = {top} THEN '{n}'" for n, c in _R2.items()) + " END"
    return f"""pick AS (SELECT *, {top} AS top, {first} AS best FROM tm),
sel AS (SELECT *, best <> 'Linear' AND linear_r2_score >= top * (1 - CAST({alpha} AS DOUBLE)) AS keep
        FROM pick)"""


_CHOSEN = "CASE WHEN keep THEN 'Linear' ELSE best END AS best_transformation"
ORACLES["trend_r2"] = f"{MIX}, {_metrics(PREDICTORS, TARGET)} SELECT feature, " + ", ".join(
    f"round({c}, 7) AS {c}" for c in _R2.values()) + " FROM tm"


ORACLES["best_transform"] = f"""{MIX}, {_metrics(RATIO_FREE, "W/C")}, {_select(0.2)}
SELECT feature, {_CHOSEN} FROM sel"""
ORACLES["trend_select"] = f"""{MIX}, {_metrics([*RATIO_FREE, TARGET], "W/C")}, {_select(0.05)}
SELECT feature, {_CHOSEN}, round(CASE WHEN keep THEN linear_r2_score ELSE top END, 6) AS best_r2_score
FROM sel"""
ORACLES["trend_coefficients"] = f"{MIX}, long AS ({long(PREDICTORS, extra=_XY)}), c AS (" + " UNION ALL ".join(
    f"SELECT feature, '{n}' AS curve, regr_slope(y, {curve_sql(n, 'x')}) AS slope, "
    f"regr_intercept(y, {curve_sql(n, 'x')}) AS intercept FROM long GROUP BY feature "
    f"HAVING count(*) FILTER (WHERE ({curve_sql(n, 'x')}) IS NULL) = 0" for n in _R2
) + ") SELECT feature, curve, round(slope, 6) AS slope, round(intercept, 4) AS intercept FROM c"

_TR2 = {"Linear": "r2_linear", "Log": "r2_log", "Sqrt": "r2_sqrt", "1/x": "r2_reciprocal",
        "x²": "r2_square"}
_TFIT = f"""{MIX}, tm AS (SELECT feature, {", ".join(
    f"CASE WHEN '{n}' <> 'Log' OR feature = 'Age' THEN regr_r2(y, {transform_sql(n, 'x')}) END AS {c}"
    for n, c in _TR2.items())} FROM ({long(RATIO_FREE, extra=', "W/C" AS y')}) GROUP BY feature),
pick AS (SELECT *, greatest({", ".join(_TR2.values())}) AS top FROM tm),
best AS (SELECT *, CASE {" ".join(f"WHEN {c} = top THEN '{n}'" for n, c in _TR2.items())} END AS best
         FROM pick),
sel AS (SELECT *, CASE WHEN best <> 'Linear' AND r2_linear >= top * (1 - CAST(0.05 AS DOUBLE))
        THEN 'Linear' ELSE best END AS best_transformation FROM best)"""
ORACLES["transformer_fit"] = f"{_TFIT} SELECT feature, best_transformation FROM sel"
ORACLES["transformer_report"] = f"{_TFIT} SELECT feature, best_transformation, false AS is_binary, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in _TR2.values()) + " FROM sel"

# ---- model selection rules ---------------------------------------------------------------


def _nepv(events: str, features: int, linear: str, ensemble: str, tree: str) -> str:
    return f"""WITH e AS ({events}) SELECT n_events, CAST({features} AS INTEGER) AS n_features,
round(n_events / CAST({features} AS DOUBLE), 4) AS nepv,
(CASE WHEN n_events / CAST({features} AS DOUBLE) >= 20 THEN '{linear},' ELSE '' END) ||
(CASE WHEN n_events / CAST({features} AS DOUBLE) >= 200 THEN '{ensemble},' ELSE '' END) || '{tree}' AS models
FROM e"""


ORACLES["nepv_regression"] = _nepv(
    "SELECT count(*) AS n_events FROM lineitem", 10, "LinearRegression,Ridge,Lasso",
    "RandomForestRegressor,GradientBoostingRegressor,XGBRegressor,LGBMRegressor",
    "DecisionTreeRegressor")
ORACLES["nepv_classif"] = _nepv(
    "SELECT min(c) AS n_events FROM (SELECT toxic, count(*) AS c FROM labels GROUP BY toxic)", 2,
    "LogisticRegression",
    "RandomForestClassifier,GradientBoostingClassifier,XGBClassifier,LGBMClassifier,SVC,MLPClassifier",
    "DecisionTreeClassifier")


def fold_sql(repeat: int, k: int = 6) -> str:
    total = "(l_orderkey * 7 + l_linenumber * 13 + l_partkey + l_suppkey * 3)"
    return (f"CAST(({total} % 2147483647 * {pow(48271, repeat + 5, 2147483647)} % 2147483647) "
            f"% {k} AS INTEGER)")


ORACLES["fold_assign"] = f"SELECT {K}, " + ", ".join(
    f"{fold_sql(r)} AS fold_{r}" for r in range(5)) + " FROM lineitem"

# ---- regression --------------------------------------------------------------------------


def _cv() -> str:
    """Least squares of W/C on one feature: training sums are totals minus the fold's sums."""
    feats = RATIO_FREE
    rows = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {r} AS rep, {fold_sql(r)} AS fold, "
        f"CAST({q(f)} AS DOUBLE) - (SELECT avg({q(f)}) FROM m) AS x, "
        f"\"W/C\" - (SELECT avg(\"W/C\") FROM m) AS y FROM m" for f in feats for r in range(5))
    return f"""{MIX}, rows_ AS ({rows}),
s AS (SELECT feature, rep, fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx,
      sum(x * y) AS sxy FROM rows_ GROUP BY feature, rep, fold),
tot AS (SELECT feature, rep, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx,
        sum(sxy) AS sxy FROM s GROUP BY feature, rep),
tr AS (SELECT s.feature, s.rep, s.fold, tot.n - s.n AS n, tot.sx - s.sx AS sx, tot.sy - s.sy AS sy,
       tot.sxx - s.sxx AS sxx, tot.sxy - s.sxy AS sxy FROM s JOIN tot USING (feature, rep)),
co AS (SELECT feature, rep, fold, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS slope, sx / n AS mx,
       sy / n AS my FROM tr),
er AS (SELECT feature, rep, fold, sqrt(avg(power(y - (my + slope * (x - mx)), 2))) AS rmse
       FROM rows_ JOIN co USING (feature, rep, fold) GROUP BY feature, rep, fold),
cv AS (SELECT feature, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse FROM er GROUP BY feature)"""


ORACLES["cv_rmse"] = f"""{_cv()} SELECT feature, round(mean_rmse, 8) AS mean_rmse,
round(std_rmse, 8) AS std_rmse FROM cv"""
ORACLES["best_row"] = f"""{_cv()} SELECT feature, round(mean_rmse, 8) AS mean_rmse,
round(std_rmse, 8) AS std_rmse FROM cv ORDER BY cv.mean_rmse, feature LIMIT 1"""


def _ridge(alphas) -> str:
    """Cross-validated error of ridge per penalty: each training set's normal equations are
    solved by elimination with the target as one more column."""
    names = [*PREDICTORS, TARGET]
    n, w = len(PREDICTORS), len(names) + 1
    cells = [(i, j) for i in range(w) for j in range(i, w)]
    x = ["CAST(1 AS DOUBLE)", *[f"(CAST({q(c)} AS DOUBLE) - (SELECT avg({q(c)}) FROM m))" for c in names]]
    rows = " UNION ALL ".join(
        f"SELECT {r} AS rep, {fold_sql(r)} AS fold, " + ", ".join(
            f"{e} AS x{i}" for i, e in enumerate(x)) + " FROM m" for r in range(5))
    flat = ", ".join(f"sum(x{i} * x{j}) AS c{i}_{j}" for i, j in cells)
    added = ", ".join(f"sum(c{i}_{j}) AS c{i}_{j}" for i, j in cells)
    less = ", ".join(f"tot.c{i}_{j} - s.c{i}_{j} AS c{i}_{j}" for i, j in cells)

    def cov(i, j):
        i, j = min(i, j), max(i, j)
        return f"(c{i}_{j} - c0_{i} * c0_{j} / c0_0)"

    def sd(i):
        return f"sqrt({cov(i, i)} / c0_0)" if i <= n else "CAST(1 AS DOUBLE)"

    square = "[" + ", ".join("[" + ", ".join(
        f"{cov(i, j)} / ({sd(i)} * {sd(j)})" + (" + alpha" if i == j <= n else "")
        for j in range(1, w)) + "]" for i in range(1, w)) + "]"
    beta = "[" + ", ".join(f"s[{i}][{n + 1}] / {sd(i)}" for i in range(1, n + 1)) + "]"
    means = "[" + ", ".join(f"c0_{i} / c0_0" for i in range(1, n + 1)) + "]"
    test = "[" + ", ".join("[" + ", ".join(
        f"c{min(i, j)}_{max(i, j)}" for j in range(w)) + "]" for i in range(w)) + "]"
    values = ", ".join(f"(CAST({a!r} AS DOUBLE))" for a in alphas)
    return f"""{MIX.replace("WITH mix", "WITH RECURSIVE mix", 1)}, rows_ AS ({rows}),
s AS MATERIALIZED (SELECT rep, fold, {flat} FROM rows_ GROUP BY rep, fold),
tot AS (SELECT rep, {added} FROM s GROUP BY rep),
tr AS MATERIALIZED (SELECT s.rep, s.fold, {less} FROM s JOIN tot USING (rep)),
a AS (SELECT * FROM (VALUES {values}) AS v(alpha)),
el AS (SELECT rep, fold, alpha, 1 AS k, {square} AS s FROM tr, a UNION ALL
  SELECT rep, fold, alpha, k + 1, list_transform(range(1, {n + 2}), lambda i: list_transform(
    range(1, {n + 2}), lambda j: CASE WHEN i = k THEN s[k][j] / s[k][k]
      ELSE s[i][j] - s[i][k] * s[k][j] / s[k][k] END)) FROM el WHERE k <= {n}),
co AS (SELECT el.rep, el.fold, el.alpha, c0_{n + 1} / c0_0 AS my, {means} AS mx, {beta} AS b
       FROM el JOIN tr USING (rep, fold) WHERE k = {n + 1}),
er AS (SELECT rep, fold, alpha, list_concat([-(my - list_dot_product(b, mx))],
         list_transform(b, lambda z: -z), [CAST(1 AS DOUBLE)]) AS v FROM co),
rm AS (SELECT alpha, sqrt(list_dot_product(v, list_transform({test},
         lambda z: list_dot_product(z, v))) / c0_0) AS rmse FROM er JOIN s USING (rep, fold)),
cv AS (SELECT alpha, CAST(count(*) AS DOUBLE) AS fits, avg(rmse) AS mean_rmse,
       stddev_pop(rmse) AS std_rmse FROM rm GROUP BY alpha)"""


ORACLES["linear_cv_gram"] = f"""{_ridge((0.0, 1.0))} SELECT alpha, fits,
round(mean_rmse, 7) AS mean_rmse, round(std_rmse, 7) AS std_rmse FROM cv"""
ORACLES["improvement_pct"] = f"""{_ridge((1.0, *RIDGE_ALPHAS))},
g AS (SELECT (SELECT mean_rmse FROM cv WHERE alpha = 1) AS b,
      (SELECT min(mean_rmse) FROM cv WHERE alpha <> 1) AS t)
SELECT round(b, 8) AS base_rmse, round(t, 8) AS tuned_rmse, round(b - t, 8) AS gain,
round((b - t) / b * 100, 8) AS gain_pct FROM g"""
ORACLES["fold_fences"] = MIX + ", f AS (" + " UNION ALL ".join(
    f"SELECT *, CAST({r} AS INTEGER) AS repeat, {fold_sql(r)} AS own FROM m" for r in range(5)) + "), q AS (" + each(
    PREDICTORS, """SELECT '{n}' AS feature, repeat, CAST(held.fold AS INTEGER) AS fold,
quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
FROM f, (SELECT unnest(range(6)) AS fold) held WHERE own <> held.fold GROUP BY repeat, held.fold""") + """)
SELECT feature, repeat, fold, round(q1, 6) AS q1, round(q3, 6) AS q3,
round(q1 - CAST(1.5 AS DOUBLE) * (q3 - q1), 6) AS lower,
round(q3 + CAST(1.5 AS DOUBLE) * (q3 - q1), 6) AS upper FROM q"""
ORACLES["fit_linear"] = f"""{MIX} SELECT round(regr_slope("W/C", "Cement"), 8) AS slope,
round(regr_intercept("W/C", "Cement"), 8) AS intercept FROM m"""
ORACLES["voting_combiner"] = f"""{MIX}, c AS (SELECT """ + ", ".join(
    f'regr_slope("W/C", {q(f)}) AS s{i}, regr_intercept("W/C", {q(f)}) AS i{i}'
    for i, f in enumerate(("Cement", "Water", "Age"))) + f""" FROM m)
SELECT {K}, round((CAST(0.45 AS DOUBLE) * (i0 + s0 * "Cement") + CAST(0.35 AS DOUBLE) * (i1 + s1 * "Water")
+ CAST(0.2 AS DOUBLE) * (i2 + s2 * "Age")), 6) AS prediction FROM m, c"""


def _ensembles() -> str:
    """Nested folds: bases per training set, products of their predictions, final models."""
    feats = ["Cement", "Water", "Age"]
    x = ["CAST(1 AS DOUBLE)", *[f"(CAST({q(f)} AS DOUBLE) - (SELECT avg({q(f)}) FROM m))" for f in feats],
         '("W/C" - (SELECT avg("W/C") FROM m))']
    w = len(x)
    cells = [(i, j) for i in range(w) for j in range(i, w)]
    add = ", ".join(f"sum(c{i}_{j}) AS c{i}_{j}" for i, j in cells)

    def base(b):
        slope = f"((c{b}_4 - c0_{b} * c0_4 / c0_0) / (c{b}_{b} - c0_{b} * c0_{b} / c0_0))"
        return f"{slope} AS s{b}, c0_4 / c0_0 - {slope} * c0_{b} / c0_0 AS l{b}"

    def product(a, b):
        if a == 0:
            return f"c0_{b}" if b in (0, 4) else f"(l{b} * c0_0 + s{b} * c0_{b})"
        if b == 4:
            return "c4_4" if a == 4 else f"(l{a} * c0_4 + s{a} * c{a}_4)"
        return f"(l{a} * l{b} * c0_0 + l{a} * s{b} * c0_{b} + l{b} * s{a} * c0_{a} + s{a} * s{b} * c{a}_{b})"

    def cov(i, j):
        i, j = min(i, j), max(i, j)
        return f"(p{i}_{j} - p0_{i} * p0_{j} / p0_0)"

    predicted = ", ".join(f"sum({product(i, j)}) AS p{i}_{j}" for i, j in cells)
    square = "[" + ", ".join("[" + ", ".join(
        cov(i, j) + (" + alpha" if i == j < 4 else "") for j in range(1, 5)) + "]"
        for i in range(1, 5)) + "]"
    test = "[" + ", ".join("[" + ", ".join(
        f"p{min(i, j)}_{max(i, j)}" for j in range(5)) + "]" for i in range(5)) + "]"
    votes = " UNION ALL ".join(
        f"SELECT '{n}' AS name, f, [CAST(0 AS DOUBLE), {', '.join(f'CAST({-v / sum(ws)!r} AS DOUBLE)' for v in ws)}, "
        f"CAST(1 AS DOUBLE)] AS v FROM tested"
        for n, ws in (("voting_equal", (1, 1, 1)), ("voting_weighted", (0.45, 0.35, 0.2)),
                      ("voting_weighted_2", (0.6, 0.25, 0.15))))
    return f"""{MIX.replace("WITH mix", "WITH RECURSIVE mix", 1)},
r AS (SELECT {fold_sql(0)} AS o, {fold_sql(1)} AS i, {", ".join(f"{e} AS x{n}" for n, e in enumerate(x))} FROM m),
c AS MATERIALIZED (SELECT o, i, {", ".join(f"sum(x{i} * x{j}) AS c{i}_{j}" for i, j in cells)} FROM r GROUP BY o, i),
g AS (SELECT unnest(range(6)) AS f), h AS (SELECT unnest(range(7)) AS j),
tr AS (SELECT f, j, {add} FROM c, g, h WHERE o <> f AND i <> j GROUP BY f, j),
fit AS MATERIALIZED (SELECT f, j, {", ".join(base(b) for b in (1, 2, 3))} FROM tr),
held AS MATERIALIZED (SELECT f, {predicted} FROM c JOIN fit ON o <> f AND i = j GROUP BY f),
tested AS MATERIALIZED (SELECT f, {predicted} FROM c JOIN fit ON o = f AND j = 6 GROUP BY f),
el AS (SELECT f, alpha, 1 AS k, {square} AS s FROM held,
    (VALUES (CAST(0 AS DOUBLE)), (CAST(1 AS DOUBLE))) AS v(alpha) UNION ALL
  SELECT f, alpha, k + 1, list_transform(range(1, 5), lambda i: list_transform(range(1, 5),
    lambda j: CASE WHEN i = k THEN s[k][j] / s[k][k] ELSE s[i][j] - s[i][k] * s[k][j] / s[k][k] END))
  FROM el WHERE k <= 3),
forms AS ({votes} UNION ALL
  SELECT CASE WHEN alpha = 0 THEN 'stacking_linear' ELSE 'stacking_ridge' END, f,
    [-(p0_4 / p0_0 - s[1][4] * p0_1 / p0_0 - s[2][4] * p0_2 / p0_0 - s[3][4] * p0_3 / p0_0),
     -s[1][4], -s[2][4], -s[3][4], CAST(1 AS DOUBLE)] FROM el JOIN held USING (f) WHERE k = 4),
e AS (SELECT name, sqrt(list_dot_product(v, list_transform({test}, lambda z: list_dot_product(z, v)))
      / p0_0) AS rmse FROM forms JOIN tested USING (f))
SELECT name, round(avg(rmse), 8) AS mean_rmse, round(stddev_pop(rmse), 8) AS std_rmse FROM e GROUP BY name"""


ORACLES["ensemble_ranking"] = _ensembles()


def _tuned() -> str:
    """Ridge search with the preparation decided in every training set.

    Products of all columns under every transform per repeat and fold; per training set the
    transform of each column by its R2, the zero flags by their tests, then elimination.
    """
    k, flags = 5, ["Blast Furnace Slag", "Fly Ash", "Sp/C_pct"]
    powder = '("Cement" + "Blast Furnace Slag" + "Fly Ash")'
    columns = {c: q(c) for c in PREDICTORS} | {
        "Total_powder": powder,
        "Aggregate_ratio": f'CASE WHEN {FA} > 0 THEN "Coarse Aggregate" / {FA} ELSE 0 END',
        "Binder_water_ratio": f'CASE WHEN "Water" > 0 THEN {powder} / "Water" ELSE 0 END'}
    # In the order in which ties between transforms are broken.
    exprs, places = ["1"], []
    for name, x in columns.items():
        x = f"CAST({x} AS DOUBLE)"
        own = [x] + ([f"ln(greatest({x}, 1e-8))"] if name == "Age" else []) + [f"sqrt(greatest({x}, 0))"]
        places.append(list(range(len(exprs) + 1, len(exprs) + 1 + len(own))))
        exprs += own
    flag_at = {f: len(exprs) + 1 + i for i, f in enumerate(flags)}
    exprs += [f"CAST({q(f)} > 0 AS INTEGER)" for f in flags] + [q(TARGET)]
    w = len(exprs)
    cells = [(i, j) for i in range(w) for j in range(i, w)]
    near = ["CAST(1 AS DOUBLE)", *[f"e{i} - avg(e{i}) OVER ()" for i in range(1, w)]]
    folds = " UNION ALL ".join(
        f"SELECT {r} AS rep, f{r} AS fold, * FROM near" for r in range(5))
    square = "[" + ", ".join("[" + ", ".join(
        f"c{min(i, j)}_{max(i, j)}" for j in range(w)) + "]" for i in range(w)) + "]"

    def cov(i, j):
        return f"(t[{i}][{j}] - t[1][{i}] * t[1][{j}] / t[1][1])"

    def r2(i):
        return f"({cov(i, w)} * {cov(i, w)} / ({cov(i, i)} * {cov(w, w)}))"

    def chosen(at):
        best = f"greatest({', '.join(r2(i) for i in at)})"
        return (f"CASE WHEN {r2(at[0])} >= {best} * CAST(0.8 AS DOUBLE) THEN {at[0]} "
                + " ".join(f"WHEN {r2(i)} = {best} THEN {i}" for i in at[1:]) + " END")

    pick = (f"list_concat([{', '.join(chosen(at) for at in places)}], "
            f"coalesce(list_sort(hits), []), [{w}])")
    held = " UNION ALL ".join(
        f"SELECT {r} AS rep, f{r} AS own, '{f}' AS feature, {q(f)} > 0 AS pos, {q(TARGET)} AS y FROM base"
        for r in range(5) for f in flags)
    number = "CASE feature " + " ".join(f"WHEN '{f}' THEN {i}" for f, i in flag_at.items()) + " END"
    trials = ", ".join(
        f"({i}, '{str(sorted(p.items())).replace(chr(39), chr(39) * 2)}', CAST({p['alpha']!r} AS DOUBLE))"
        for i, p in enumerate(sample_space(RIDGE_SPACE, 100)))
    levene_p = t_tail("sqrt(levene)", "(n0 + n1 - 2)")
    return f"""{MIX.replace("WITH mix", "WITH RECURSIVE mix", 1)},
base AS (SELECT *, {", ".join(f"{fold_sql(r, k)} AS f{r}" for r in range(5))},
  {", ".join(f"{e} AS e{i}" for i, e in enumerate(exprs))} FROM m),
near AS (SELECT f0, f1, f2, f3, f4, {", ".join(f"{e} AS x{i}" for i, e in enumerate(near))} FROM base),
rows_ AS ({folds}),
s AS MATERIALIZED (SELECT rep, fold, {", ".join(f"sum(x{i} * x{j}) AS c{i}_{j}" for i, j in cells)}
  FROM rows_ GROUP BY rep, fold),
tot AS (SELECT rep, {", ".join(f"sum(c{i}_{j}) AS c{i}_{j}" for i, j in cells)} FROM s GROUP BY rep),
own AS MATERIALIZED (SELECT rep, fold, {square} AS t FROM s),
tr AS MATERIALIZED (SELECT rep, fold, {square} AS t FROM (SELECT s.rep, s.fold,
  {", ".join(f"tot.c{i}_{j} - s.c{i}_{j} AS c{i}_{j}" for i, j in cells)} FROM s JOIN tot USING (rep)) z),
g AS (SELECT rep, h.fold AS fold, feature, pos, y FROM ({held}) z, (SELECT unnest(range({k})) AS fold) h
  WHERE own <> h.fold),
md AS (SELECT rep, fold, feature, pos, median(y) AS md FROM g GROUP BY rep, fold, feature, pos),
st AS (SELECT rep, fold, feature, pos, count(*) AS n, avg(y) AS mean, var_samp(y) AS v,
  avg(abs(y - md)) AS zm, var_pop(abs(y - md)) * count(*) AS zs
  FROM g JOIN md USING (rep, fold, feature, pos) GROUP BY rep, fold, feature, pos),
w AS (SELECT a.rep, a.fold, a.feature, a.n AS n0, b.n AS n1, a.mean AS mean0, b.mean AS mean1,
  a.v AS v0, b.v AS v1, a.zm AS z0, b.zm AS z1, a.zs + b.zs AS inner_s,
  (a.n * a.zm + b.n * b.zm) / (a.n + b.n) AS zc FROM st a JOIN st b
  ON a.rep = b.rep AND a.fold = b.fold AND a.feature = b.feature AND NOT a.pos AND b.pos),
l AS (SELECT *, (n0 + n1 - 2) * (n0 * (z0 - zc) * (z0 - zc) + n1 * (z1 - zc) * (z1 - zc)) / inner_s
  AS levene, v0 / n0 AS e0, v1 / n1 AS e1 FROM w),
d AS (SELECT *, {levene_p} > 0.05 AS pooled FROM l),
tt AS (SELECT rep, fold, feature, (mean1 - mean0) / sqrt(CASE WHEN pooled THEN
    ((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (CAST(1 AS DOUBLE) / n0 + CAST(1 AS DOUBLE) / n1)
    ELSE e0 + e1 END) AS t, CASE WHEN pooled THEN CAST(n0 + n1 - 2 AS DOUBLE) ELSE (e0 + e1) * (e0 + e1)
    / (e0 * e0 / (n0 - 1) + e1 * e1 / (n1 - 1)) END AS df FROM d),
sig AS (SELECT rep, fold, list({number}) AS hits FROM tt WHERE {t_tail("t", "df")} < 0.05 GROUP BY rep, fold),
ix AS MATERIALIZED (SELECT tr.rep, tr.fold, t, {pick} AS ix FROM tr LEFT JOIN sig USING (rep, fold)),
sc AS MATERIALIZED (SELECT *, len(ix) AS n, list_transform(ix, lambda i: CASE WHEN i = {w} THEN CAST(1 AS DOUBLE)
  ELSE sqrt((t[i][i] - t[1][i] * t[1][i] / t[1][1]) / t[1][1]) END) AS sd FROM ix),
a AS (SELECT * FROM (VALUES {trials}) AS v(trial, params, alpha)),
el AS (SELECT rep, fold, trial, n, 1 AS k, list_transform(range(1, n + 1), lambda i: list_transform(
    range(1, n + 1), lambda j: (t[ix[i]][ix[j]] - t[1][ix[i]] * t[1][ix[j]] / t[1][1]) / (sd[i] * sd[j])
    + CASE WHEN i = j AND i < n THEN alpha ELSE 0 END)) AS s FROM sc, a UNION ALL
  SELECT rep, fold, trial, n, k + 1, list_transform(range(1, n + 1), lambda i: list_transform(
    range(1, n + 1), lambda j: CASE WHEN i = k THEN s[k][j] / s[k][k]
      ELSE s[i][j] - s[i][k] * s[k][j] / s[k][k] END)) FROM el WHERE k < n),
co AS (SELECT el.rep, el.fold, trial, t[1][{w}] / t[1][1] AS my, ix,
  list_transform(range(1, el.n), lambda i: t[1][ix[i]] / t[1][1]) AS mx,
  list_transform(range(1, el.n), lambda i: s[i][el.n] / sd[i]) AS b
  FROM el JOIN sc USING (rep, fold) WHERE k = el.n),
fo AS (SELECT rep, fold, trial, list_concat([1], ix) AS jx, list_concat([-(my - list_dot_product(b, mx))],
  list_transform(b, lambda z: -z), [CAST(1 AS DOUBLE)]) AS v FROM co),
rm AS (SELECT trial, sqrt(list_dot_product(v, list_transform(jx, lambda i: list_dot_product(
  list_transform(jx, lambda j: t[i][j]), v))) / t[1][1]) AS rmse FROM fo JOIN own USING (rep, fold))
SELECT CAST(trial AS INTEGER) AS trial, params, round(avg(rmse), 6) AS mean_rmse,
round(stddev_pop(rmse), 6) AS std_rmse FROM rm JOIN a USING (trial) GROUP BY trial, params"""


ORACLES["tune"] = _tuned()
