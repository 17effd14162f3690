"""Every operator as a query over the test tables: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import default_config
from tabforge.functions.fold_quantiles import training_quantiles
from tabforge.functions.gram import gram
from tabforge.functions.ranks import ranked_values, spearman
from tabforge.functions.scalar import CURVES, TRANSFORMS, as_double, col
from tabforge.operators import association as assoc
from tabforge.operators import profile as prof
from tabforge.operators import transforms as tr
from tabforge.operators import trends, zeros
from tabforge.operators.clean import add_ratios, clean, drop_id
from tabforge.operators.engineering import FeatureEngineer
from tabforge.operators.outliers import OutlierHandler
from tabforge.operators.scaling import StandardScaler
from tabforge.operators.selection import (
    DOMAIN_PRIORITY, CollinearityReducer, UninformativeRemover,
)
from tabforge.plans import ensemble_sums as es
from tabforge.plans import ensembles as ens
from tabforge.plans import experiments as exp
from tabforge.plans import folds as fo
from tabforge.plans import linear_sweep as sweep
from tabforge.plans import models as mo
from tabforge.plans import preparation as prep
from tabforge.plans import staged
from tabforge.plans import tuning
from tabforge.session import materialize
from tabforge.sources.readers import read_facts, read_table
from tabforge.sources.writers import submission
from tabforge.sources.views import FEATURES, KEYS, TARGET, mix

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RATIOS = ["W/C", "Sp/C_pct"]
PREDICTORS = [*FEATURES, *RATIOS]
NUMBERS = [*PREDICTORS, TARGET]
RATIO_FREE = [c for c in PREDICTORS if c != "W/C"]
PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


# Names of the registry that would shadow a module member under their own name.
_NAMES = {"clean_rows": "clean", "spearman_corr": "spearman"}


def query(fn: Query) -> Query:
    QUERIES[_NAMES.get(fn.__name__, fn.__name__)] = fn
    return fn


def table(spark: SparkSession, sf: str, keys: bool = True) -> DataFrame:
    """Mixture view with its ratios."""
    return add_ratios(mix(spark, sf, keys=keys))


def stored(spark: SparkSession, sf: str, keys: bool = True) -> DataFrame:
    """The same view written once, for queries that read it in several passes."""
    return materialize(table(spark, sf, keys))


def rounded(df: DataFrame, digits: int, *skip: str) -> DataFrame:
    floats = {n for n, t in df.dtypes if t == "double"} - set(skip)
    return df.select(*[
        F.round(col(c), digits).alias(c) if c in floats else col(c) for c in df.columns])


def handler(*strategies: str) -> OutlierHandler:
    return OutlierHandler(strategies=list(strategies), config=default_config(), targetCol=TARGET,
                          keyCols=KEYS)


def plain(df: DataFrame) -> DataFrame:
    return df.drop(*KEYS)


# ---- sources, projections, filters -------------------------------------------------------


@query
def scan_parquet(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        *KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")


@query
def ratios(spark, sf):
    item = read_table(spark, sf, "lineitem").select(
        *KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return add_ratios(item, {"price_by_discount": ("l_extendedprice", "l_discount"),
                             "tax_by_quantity": ("l_tax", "l_quantity")})


def _short_items(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Id"), "l_quantity", "l_discount", "l_tax", "l_returnflag")


@query
def drop_duplicates(spark, sf):
    return drop_id(_short_items(spark, sf)).select("l_quantity", "l_tax").dropDuplicates()


@query
def clean_rows(spark, sf):
    return clean(_short_items(spark, sf))


@query
def outlier_abnormal(spark, sf):
    df = table(spark, sf)
    return handler("abnormal").fit(df).transform(df).select(*KEYS, "Sp/C_pct", "Fine Aggregate")


@query
def outlier_combine(spark, sf):
    df = table(spark, sf)
    return handler("combine").fit(df).transform(df).select(*KEYS, "High_SP", "High_FA")


@query
def outlier_range_flags(spark, sf):
    df = table(spark, sf)
    out = handler("gost_binar").fit(df).transform(df)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("Outlier_")])


@query
def outlier_range_remove(spark, sf):
    df = table(spark, sf)
    return handler("gost_remove").fit(df).transform(df).select(*KEYS, "Age", "W/C")


@query
def outlier_iqr_remove(spark, sf):
    df = stored(spark, sf)
    return handler("iqr_remove").fit(df).transform(df).select(*KEYS, "W/C", "Sp/C_pct")


@query
def iqr_bounds(spark, sf):
    return rounded(prof.iqr_bounds_table(stored(spark, sf), NUMBERS), 6)


@query
def outlier_chain(spark, sf):
    df = table(spark, sf)
    out = handler("gost_binar", "combine").fit(df).transform(df)
    flags = [c for c in out.columns if c.startswith(("Outlier_", "High_"))]
    return out.select(*KEYS, *flags)


@query
def outlier_summary(spark, sf):
    df = table(spark, sf)
    return handler("gost_binar", "combine", "abnormal").fit(df).summary_table(df)


@query
def outlier_union(spark, sf):
    df = table(spark, sf)
    return handler("abnormal", "gost_remove").fit(df).removed(df).select(*KEYS)


@query
def removed_rows_anti(spark, sf):
    df = stored(spark, sf)
    bad = handler("abnormal").fit(df).removed(df).select(*KEYS)
    return df.select(*KEYS, TARGET).join(bad, KEYS, "left_anti")


@query
def strategy_comparison(spark, sf):
    """All six strategies side by side from one aggregate over the shared rows."""
    df = stored(spark, sf)
    records = []
    for strategies in (["abnormal"], ["combine"], ["gost_binar"], ["gost_remove"],
                       ["iqr_remove"], ["gost_binar", "combine"]):
        model = handler(*strategies).fit(df)
        drops = [s.any_drop() for s in model.steps(df.columns) if s.any_drop() is not None]
        gone = F.lit(False)
        for d in drops:
            gone = gone | d
        n, removed = F.count("*"), F.count_if(gone)
        records.append({
            "strategy": "+".join(strategies), "original_rows": n, "final_rows": n - removed,
            "removed_rows": removed,
            "removed_pct": F.round(removed * F.lit(100.0) / n, 4),
            "created_features": F.lit(sum(len(s.flags) for s in model.steps(df.columns))),
        })
    return prof.rows_from_aggregate(df, records)


@query
def chain_comparison(spark, sf):
    """The strategies side by side after the whole feature chain."""
    return prep.compare_strategies(stored(spark, sf), default_config(), TARGET, KEYS)


@query
def outliers_before_after(spark, sf):
    df = stored(spark, sf)
    after = handler("abnormal", "gost_remove").fit(df).transform(df)
    before = prof.count_iqr_outliers(df, PREDICTORS).withColumnRenamed("n_outliers", "before")
    later = prof.count_iqr_outliers(after, PREDICTORS).withColumnRenamed("n_outliers", "after")
    return before.join(later, "feature")


# ---- derived features --------------------------------------------------------------------


@query
def fe_base(spark, sf):
    df = table(spark, sf)
    engineer = FeatureEngineer(modelType="linear_models", fitThresholds=False)
    out = engineer.fit(plain(df)).transform(df)
    return out.select(*KEYS, "Total_powder", "Aggregate_ratio", "Binder_water_ratio")


@query
def fe_trees(spark, sf):
    df = stored(spark, sf)
    out = FeatureEngineer(modelType="trees_models").fit(plain(df)).transform(df)
    return out.select(
        *KEYS, "Total_powder", "Has_Slag", "Has_FlyAsh", "Has_Superplasticizer", "Low_WC_ratio",
        "High_WC_ratio", "Low_WC_tech", "High_WC_tech")


@query
def fe_thresholds(spark, sf):
    s = FeatureEngineer().fit(table(spark, sf)).fitted
    return rounded(spark.createDataFrame(
        [(s["low"], s["high"])], "low_adaptive double, high_adaptive double"), 9)


@query
def zero_flags(spark, sf):
    out = zeros.zero_flags(table(spark, sf), ["Blast Furnace Slag", "Fly Ash", "Sp/C_pct"])
    return out.select(*KEYS, *[c for c in out.columns if c.endswith("_binary")])


@query
def scalar_transforms(spark, sf):
    x = as_double("Age")
    names = {"Linear": "t_linear", "Log": "t_log", "Sqrt": "t_sqrt", "1/x": "t_inverse",
             "x²": "t_square"}
    out = table(spark, sf).select(*KEYS, *[TRANSFORMS[n](x).alias(a) for n, a in names.items()])
    return rounded(out, 6)


@query
def trend_curves(spark, sf):
    x = as_double("Age")
    names = {"Linear": "c_linear", "Log": "c_log", "Sqrt": "c_sqrt", "1/x": "c_inverse",
             "x²": "c_square"}
    out = table(spark, sf).select(*KEYS, *[CURVES[n](x).alias(a) for n, a in names.items()])
    return rounded(out, 6)


@query
def apply_transforms(spark, sf):
    chosen = {"Cement": "Sqrt", "Water": "1/x", "Fine Aggregate": "x²", "Age": "Log"}
    model = tr.FeatureTransformerModel({
        "target": TARGET, "report": {c: {"best": t} for c, t in chosen.items()}})
    return rounded(model.transform(table(spark, sf)).select(*KEYS, *chosen, TARGET), 6)


@query
def standard_scale(spark, sf):
    df = stored(spark, sf)
    out = StandardScaler(passCols=[*KEYS, TARGET]).fit(df).transform(df)
    return rounded(out.select(*KEYS, "Cement", "Water", "Age", "W/C"), 6)


# ---- profiles ----------------------------------------------------------------------------


@query
def detect_outliers(spark, sf):
    return prof.detect_outliers(stored(spark, sf), default_config(), columns=NUMBERS)


@query
def outlier_masks(spark, sf):
    return prof.outlier_masks(stored(spark, sf), NUMBERS, KEYS)


@query
def topk_outlier_features(spark, sf):
    out = prof.detect_outliers(stored(spark, sf), default_config(), columns=NUMBERS)
    return out.select("feature", "n_outliers_IQR").limit(3)


@query
def quantiles(spark, sf):
    events = read_table(spark, sf, "events").select("value")
    a = prof.quantiles(events, ["value"], PROBS)
    b = prof.quantiles(read_facts(spark, sf, "lineitem"), ["l_extendedprice", "l_discount"], PROBS)
    return rounded(a.unionByName(b), 6)


def _with_gaps(spark, sf):
    item = read_table(spark, sf, "lineitem")
    return item.select(
        "l_orderkey",
        F.when(F.col("l_linenumber") != 7, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).otherwise(F.lit(float("nan")))
        .alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("status"))


@query
def missing_values(spark, sf):
    return prof.missing_values(_with_gaps(spark, sf))


@query
def describe(spark, sf):
    return rounded(prof.describe(stored(spark, sf), NUMBERS), 4)


@query
def mode_share(spark, sf):
    item = read_table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        (F.col("l_quantity") > 1).cast("int").alias("many"))
    return rounded(prof.mode_share(item), 6)


@query
def value_counts(spark, sf):
    return prof.value_counts(read_table(spark, sf, "lineitem"), "l_returnflag")


@query
def profile(spark, sf):
    df = stored(spark, sf)
    return rounded(prof.profile(df, NUMBERS, exact_distinct=True), 4)


@query
def profile_warnings(spark, sf):
    item = materialize(read_table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_extendedprice",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.when(F.col("l_linenumber") != 7, F.col("l_tax")).alias("tax"),
        (F.col("l_quantity") * 0).alias("zero")))
    names = ["l_quantity", "l_discount", "l_extendedprice", "net", "tax"]
    return prof.profile_warnings(
        prof.profile(item, exact_distinct=True), assoc.correlation_table(item, names),
        zero_share=0.05)


@query
def boxplot_stats(spark, sf):
    return rounded(prof.boxplot_stats(stored(spark, sf), NUMBERS), 6)


@query
def binary_features(spark, sf):
    df = table(spark, sf).withColumns({
        "High_Cement": (F.col("Cement") > 400).cast("int"),
        "two_valued": F.when(F.col("Age") > 0, 5).otherwise(9)})
    return tr.binary_features(df, [*PREDICTORS, "High_Cement", "two_valued"])


@query
def drop_uninformative(spark, sf):
    item = read_table(spark, sf, "lineitem").select(
        *KEYS, "l_tax", "l_returnflag", (F.col("l_quantity") > 1).cast("int").alias("many"),
        (F.col("l_quantity") > 5).cast("int").alias("some"))
    return UninformativeRemover(threshold=0.95, passCols=KEYS).fit(item).transform(item)


# ---- association -------------------------------------------------------------------------


@query
def pearson(spark, sf):
    out = assoc.pearson(table(spark, sf), PREDICTORS, TARGET)
    return rounded(out.select("feature", "n", "pearson_corr"), 8)


@query
def skew_kurt(spark, sf):
    events = read_table(spark, sf, "events").select("value", "user_id")
    out = assoc.pearson(events, ["value"], "user_id")
    return rounded(out.select("feature", "skewness", "kurtosis"), 6)


@query
def avg_rank(spark, sf):
    item = read_facts(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    return ranked_values(item, ["l_quantity", "l_extendedprice"])


@query
def spearman_corr(spark, sf):
    return rounded(spearman(stored(spark, sf), PREDICTORS, TARGET), 8)


@query
def feature_analysis(spark, sf):
    out = assoc.feature_analysis(stored(spark, sf), TARGET, PREDICTORS)
    return rounded(out, 6)


def _predictors_with_gaps(spark, sf):
    """The stored view with values missing by rule: other rows in every second predictor."""
    df = stored(spark, sf)
    return df.withColumns({c: F.when((col("l_partkey") + i) % (7 + i) != 0, col(c))
                           for i, c in enumerate(PREDICTORS) if i % 2})


@query
def feature_analysis_gaps(spark, sf):
    """As feature_analysis, each predictor over the rows where it is present."""
    return rounded(assoc.feature_analysis(_predictors_with_gaps(spark, sf), TARGET, PREDICTORS), 6)


@query
def corr_matrix(spark, sf):
    return rounded(assoc.correlation_table(stored(spark, sf), PREDICTORS), 8)


@query
def corr_lower_triangle(spark, sf):
    """The cells of the heat map."""
    out = assoc.correlation_table(stored(spark, sf), PREDICTORS)
    return rounded(assoc.lower_triangle(out, PREDICTORS), 8)


@query
def vif_centered(spark, sf):
    df = stored(spark, sf).select(*[col(c) for c in PREDICTORS], TARGET)
    return rounded(assoc.check_multicollinearity(df, TARGET), 6)


@query
def vif_uncentered(spark, sf):
    return rounded(assoc.vif_without_intercept(stored(spark, sf), PREDICTORS), 6)


@query
def vif_bands(spark, sf):
    df = stored(spark, sf).select(*[col(c) for c in PREDICTORS], TARGET)
    return assoc.vif_bands(assoc.check_multicollinearity(df, TARGET), high=3.0, medium=1.4).select(
        "Feature", "severity")


def _priced(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return read_facts(spark, sf, "lineitem").select(
        *KEYS, "l_extendedprice", net.alias("net"), (net * (1 + F.col("l_tax"))).alias("gross"),
        "l_quantity", "l_discount", "l_tax")


@query
def extreme_corr_pairs(spark, sf):
    names = ["l_extendedprice", "net", "gross", "l_quantity", "l_discount", "l_tax"]
    pairs = assoc.extreme_pairs(
        assoc.correlation_table(_priced(spark, sf), names), names, 0.9)
    return rounded(pairs, 6)


@query
def drop_collinear(spark, sf):
    df = _priced(spark, sf)
    reducer = CollinearityReducer(
        vifThreshold=15.0, correlationThreshold=0.9, priority=["l_extendedprice", "net"],
        protected=["l_quantity"], maxShare=0.5, passCols=KEYS)
    return reducer.fit(df).transform(df)


@query
def collinearity_fit(spark, sf):
    df = stored(spark, sf, keys=False)
    df = FeatureEngineer().fit(df).transform(df)
    model = CollinearityReducer(
        vifThreshold=15.0, correlationThreshold=0.9, priority=list(DOMAIN_PRIORITY),
        passCols=[TARGET]).fit(df)
    return model.report(spark).select(
        "feature", F.col("first_vif").alias("initial_vif"),
        F.col("removed_by").isNotNull().alias("removed"))


# ---- zero-effect tests -------------------------------------------------------------------

_TEST_SCHEMA = (
    "feature string, n_zero long, n_positive long, mean_zero double, mean_positive double, "
    "levene double, t double, df double, levene_p double, p double, test string, "
    "significant boolean")


@query
def zero_effect_test(spark, sf):
    tests = zeros.zero_effect_tests(stored(spark, sf), zeros.REPORT_FEATURES, TARGET)
    rows = [(f, s["zero_n"], s["positive_n"], s["zero_mean"], s["positive_mean"], s["levene"],
             s["t"], s["df"], s["levene_p"], s["p"], s["test"], s["significant"])
            for f, s in tests.items()]
    return rounded(spark.createDataFrame(rows, _TEST_SCHEMA), 5)


@query
def zero_encoder_fit(spark, sf):
    model = zeros.ZeroBinaryEncoder(targetCol=TARGET).fit(stored(spark, sf))
    rows = [(f, s["group_zero_size"], s["group_non_zero_size"], s["group_zero_mean"],
             s["group_non_zero_mean"], s["levene"], s["t"], s["df"], s["levene_p_value"],
             s["p_value"], s["test_type"], s["significant"])
            for f, s in model.fitted["tests"].items()]
    return rounded(spark.createDataFrame(rows, _TEST_SCHEMA), 5)


# ---- trends and transforms ---------------------------------------------------------------


@query
def trend_r2(spark, sf):
    return rounded(trends.trend_metrics(table(spark, sf), PREDICTORS, TARGET), 7)


@query
def best_transform(spark, sf):
    metrics = trends.trend_metrics(table(spark, sf), RATIO_FREE, "W/C")
    return trends.select_best(metrics, 0.2).select("feature", "best_transformation")


@query
def trend_select(spark, sf):
    out = trends.trend_select(plain(table(spark, sf)), "W/C", 0.05)
    return rounded(out.select("feature", "best_transformation", "best_r2_score"), 6)


@query
def trend_coefficients(spark, sf):
    out = trends.trend_coefficients(table(spark, sf), PREDICTORS, TARGET)
    return out.select("feature", "curve", F.round("slope", 6).alias("slope"),
                      F.round("intercept", 4).alias("intercept"))


def _fitted_transformer(spark, sf):
    df = stored(spark, sf, keys=False).select(*[col(c) for c in [*RATIO_FREE, "W/C"]])
    return tr.FeatureTransformer(targetCol="W/C", alpha=0.05).fit(df)


@query
def transformer_fit(spark, sf):
    best = _fitted_transformer(spark, sf).best
    return spark.createDataFrame(list(best.items()), "feature string, best_transformation string")


@query
def transformer_report(spark, sf):
    out = _fitted_transformer(spark, sf).report(spark)
    return rounded(out.drop("best_r2"), 6)


# ---- model selection rules ---------------------------------------------------------------


@query
def nepv_regression(spark, sf):
    out = mo.nepv_table(read_table(spark, sf, "lineitem"), 10, "regression")
    return rounded(out.withColumn("models", F.concat_ws(",", "models")), 4)


@query
def nepv_classif(spark, sf):
    out = mo.nepv_table(read_table(spark, sf, "labels"), 2, "classif", "toxic")
    return rounded(out.withColumn("models", F.concat_ws(",", "models")), 4)


@query
def fold_assign(spark, sf):
    item = read_table(spark, sf, "lineitem").select(*KEYS)
    return fo.with_folds(item, KEYS, k=6, repeats=5, arithmetic=True)


# ---- regression --------------------------------------------------------------------------

def _single_feature_cv(spark, sf):
    df = materialize(fo.with_folds(table(spark, sf), KEYS, k=6, repeats=5, arithmetic=True))
    rows = []
    for f in RATIO_FREE:
        rmse = fo.linear_cv(df, [f], "W/C", fo.fold_columns(5), 6)[0.0]
        s = fo.Scores(rmse)
        rows.append((f, s.mean, s.std))
    return spark.createDataFrame(rows, "feature string, mean_rmse double, std_rmse double")


@query
def cv_rmse(spark, sf):
    return rounded(_single_feature_cv(spark, sf), 8)


@query
def best_row(spark, sf):
    out = exp.best_row(_single_feature_cv(spark, sf), ties=("feature",))
    return rounded(out, 8)


def _ridge_cv(spark, sf, alphas):
    df = materialize(fo.with_folds(table(spark, sf), KEYS, k=6, repeats=5, arithmetic=True))
    return fo.linear_cv(df, PREDICTORS, TARGET, fo.fold_columns(5), 6, alphas=alphas)


@query
def improvement_pct(spark, sf):
    """Gain of the best of 100 ridge penalties over the untuned one, in cross-validated error."""
    found = _ridge_cv(spark, sf, (1.0, *tuning.RIDGE_ALPHAS))
    base = fo.Scores(found[1.0]).mean
    tuned = min(fo.Scores(found[a]).mean for a in tuning.RIDGE_ALPHAS)
    gain, pct = tuning.improvement(base, tuned)
    return rounded(spark.createDataFrame(
        [(base, tuned, gain, pct)],
        "base_rmse double, tuned_rmse double, gain double, gain_pct double"), 8)


@query
def linear_cv_gram(spark, sf):
    """30 least-squares and 30 ridge fits over all predictors from one pass."""
    found = _ridge_cv(spark, sf, (0.0, 1.0))
    rows = [(a, float(len(s)), fo.Scores(s).mean, fo.Scores(s).std) for a, s in found.items()]
    return rounded(spark.createDataFrame(
        rows, "alpha double, fits double, mean_rmse double, std_rmse double"), 7)


@query
def fold_fences(spark, sf):
    """Interquartile fences of every predictor in every training set of 5 x 6 folds."""
    df = materialize(fo.with_folds(table(spark, sf), KEYS, k=6, repeats=5, arithmetic=True))
    found = training_quantiles(df, {c: as_double(c) for c in PREDICTORS},
                               {c: [0.25, 0.75] for c in PREDICTORS}, fo.fold_columns(5), 6)
    rows = [(c, int(r.removeprefix("fold_")), f, q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
            for (c, r, f), (q1, q3) in found.items()]
    return rounded(spark.createDataFrame(
        rows, "feature string, repeat int, fold int, q1 double, q3 double, lower double, "
        "upper double"), 6)


@query
def fit_linear(spark, sf):
    """One-feature least squares by the ML library."""
    df = table(spark, sf).select(F.col("Cement"), F.col("`W/C`").alias("y"))
    ready = VectorAssembler(inputCols=["Cement"], outputCol="features").transform(df)
    model = LinearRegression(labelCol="y", solver="normal").fit(ready)
    return rounded(spark.createDataFrame(
        [(float(model.coefficients[0]), model.intercept)],
        "slope double, intercept double"), 8)


def _prepared(spark, sf, kind="linear_models"):
    df = materialize(plain(table(spark, sf)))
    return materialize(mo.preprocessing(kind, TARGET).fit(df).transform(df))


def _fit_report(spark, sf, *names, kind="linear_models", **opts):
    df = _prepared(spark, sf, kind)
    pool = mo.regressors(TARGET, **opts)
    rows = [(n, fo.rmse_of(pool[n].fit(df).transform(df), TARGET)) for n in names]
    return spark.createDataFrame(rows, "model string, train_rmse double")


@query
def fit_penalized(spark, sf):
    """Training errors of the four linear models, preparation included, from sums of products."""
    found = sweep.training_errors(plain(stored(spark, sf)), TARGET, "linear_models")
    return spark.createDataFrame(list(found.items()), "model string, train_rmse double")


@query
def fit_trees(spark, sf):
    """A tree and a forest of 100 trees. Their depth is limited: without a limit a tree keeps
    about one leaf a row on the driver, 100 times over."""
    return _fit_report(spark, sf, "DecisionTreeRegressor", "RandomForestRegressor",
                       kind="trees_models", depth=12)


@query
def fit_boosting(spark, sf):
    """All presets with 100 rounds."""
    return _fit_report(spark, sf, *mo.BOOSTING_PRESETS, kind="trees_models")


@query
def boosting_curve(spark, sf):
    """Training error after each of 100 rounds, from one fit and one scan."""
    df = _prepared(spark, sf, "trees_models")
    model = mo.regressors(TARGET)["gbt_d3_s01"].fit(df)
    return staged.staged_errors(model, df, TARGET)


@query
def preprocess_pipeline(spark, sf):
    df = stored(spark, sf)
    model = mo.preprocessing("linear_models", TARGET, vector=False, keep=KEYS).fit(df)
    return model.transform(df)


@query
def full_pipeline(spark, sf):
    df = stored(spark, sf)
    model = mo.full_pipeline(
        "linear_models", mo.regressors(TARGET)["Ridge"], TARGET, keep=KEYS).fit(df)
    return model.transform(df).select(*KEYS, TARGET, "prediction")


@query
def score_submission(spark, sf):
    df = stored(spark, sf).withColumn("Id", F.xxhash64(*KEYS)).drop(*KEYS)
    model = mo.full_pipeline(
        "linear_models", mo.regressors(TARGET)["LinearRegression"], TARGET, keep=["Id"]).fit(df)
    return submission(model.transform(df), "Id", TARGET)


def _sweep(spark, sf):
    return sweep.run_linear_experiments(
        stored(spark, sf), KEYS, TARGET, exp.SWEEP_STRATEGIES, ["linear_models", "trees_models"],
        default_config())


@query
def experiments(spark, sf):
    """All outlier policies and feature sets with the four linear models, 30 folds each."""
    return _sweep(spark, sf)


@query
def experiments_sorted(spark, sf):
    return _sweep(spark, sf).orderBy("mean_rmse").select(
        "outlier_strategy", "model_name", "model_type", "mean_rmse")


@query
def tune(spark, sf):
    """100 ridge trials on 5 x 5 folds, preparation included; one decomposition serves a fold."""
    df = fo.with_folds(table(spark, sf), KEYS, k=5, repeats=5, arithmetic=True)
    study = tuning.tune_ridge(materialize(plain(df)), TARGET, fo.fold_columns(5), 5)
    return rounded(study.table(spark), 6)


def _bases():
    pool = mo.regressors(TARGET)
    return {"linear": pool["LinearRegression"], "ridge": pool["Ridge"],
            "boosted": pool["gbt_d3_s01"]}


@query
def voting(spark, sf):
    df = _prepared(spark, sf)
    model = ens.voting(_bases(), ens.WEIGHTS_THREE).fit(df)
    return model.transform(df).select(TARGET, "prediction")


@query
def voting_combiner(spark, sf):
    """Weighted mean of three one-feature least-squares predictions."""
    df = stored(spark, sf)
    g = gram(df, ["Cement", "Water", "Age", "W/C"])
    parts = []
    for i, f in enumerate(("Cement", "Water", "Age")):
        slope = float(g.centred[i, 3] / g.centred[i, i])
        parts.append(F.lit(float(g.means[3])) + F.lit(slope) * (
            as_double(f) - F.lit(float(g.means[i]))))
    return rounded(df.select(
        *KEYS, ens.weighted_mean(parts, ens.WEIGHTS_THREE).alias("prediction")), 6)


@query
def stacking(spark, sf):
    df = _prepared(spark, sf)
    model = ens.Stacking(bases=_bases(), targetCol=TARGET,
                         final=mo.PenalizedRegression(alpha=1.0)).fit(df)
    return model.transform(df).select(TARGET, "prediction")


@query
def ensemble_ranking(spark, sf):
    """All five ensembles of three linear bases, nested 6 x 6 folds, from one pass."""
    df = fo.with_folds(table(spark, sf), KEYS, k=6, repeats=2, arithmetic=True)
    bases = {f: es.LinearBase((f,)) for f in ("Cement", "Water", "Age")}
    scores = es.linear_ensembles(df, "W/C", "fold_0", 6, "fold_1", 6, bases)
    return rounded(fo.scores_table(spark, scores), 8)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return detect_outliers(spark, sf)

