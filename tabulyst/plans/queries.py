"""Registered queries: each operator over the whole given tables."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import row_hash
from ..functions.text import clean_category, col, parse_money, parse_number
from ..operators import linear
from ..operators.encode import OneHotEncoder, TargetEncoder
from ..operators.features import RoleFeatures, clean, complete_columns
from ..operators.knn import PeerComparables
from ..operators.metrics import (
    band_code, band_edges, band_metrics, cv_summary, metric_aggregates, metric_summary,
    smearing_factor,
)
from ..operators.models import BLEND, PriceModel
from ..operators.ordering import with_row_index
from ..operators.profile import (
    category_counts, histogram, missing_profile, numeric_summary, pearson_matrix, spearman_target,
)
from ..operators.quantile import column_medians
from ..operators.select import assemble, null_thresholds, permuted, stable_features
from ..operators.split import kfold, split_rows
from ..roles import ORDER_LISTING as ROLES
from ..scratch import materialize, scratch_root
from ..sources.csv import drop_duplicates, invalid_id_counts, read_csv, training_rows
from ..sources.sinks import table_fingerprint, write_csv
from ..config import make_config
from .eda import profile
from .listing import listing, read
from .predict import predict
from .report import report_tables
from .train import cross_validate, pick_winner, rank_candidates, train

SEED = 42
FOLDS = 5
NULL_RUNS = 10
GUESS = "60000 + 60000 * quality"


def staged(spark: SparkSession, directory: str) -> DataFrame:
    """The listing, written once for operators that pass over it several times."""
    return materialize(listing(spark, directory))


def fresh(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tabulyst-run-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(col(n), digits) for n in names})


def with_folds(spark, directory) -> DataFrame:
    return materialize(kfold(staged(spark, directory), "id", FOLDS, SEED))


# --- sources and validation ----------------------------------------------------------------------


def dedup_rows(spark, directory):
    lines = read(spark, directory, "lineitem")
    return drop_duplicates(lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))


def dedup_first(spark, directory):
    lines = read(spark, directory, "lineitem")
    kept = lines.select("l_linenumber", "l_returnflag", "l_linestatus", F.col("l_orderkey").alias("position"))
    return drop_duplicates(kept, "position")


def validate_ids(spark, directory):
    return invalid_id_counts(read(spark, directory, "lineitem"), "l_orderkey")


def parse_money_text(spark, directory):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    whole = F.expr("c div 100")
    text = F.concat(
        F.lit("$"), F.expr("c div 100000"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"),
        F.lit("."), F.lpad((F.col("c") % 100).cast("string"), 2, "0"),
    )
    orders = read(spark, directory, "orders").select("o_orderkey", cents.alias("c"))
    return orders.select("o_orderkey", parse_money(text).alias("price"))


def clean_numeric(spark, directory):
    digits = F.substring_index("c_name", "#", -1)
    return read(spark, directory, "customer").select(
        "c_custkey",
        parse_number(F.concat(F.lit("\t"), digits, F.lit(" "))).alias("padded"),
        parse_number(F.concat(F.lit("-."), digits, F.lit("e2"))).alias("scientific"),
        parse_number(F.concat(digits, F.lit("d"))).alias("suffixed"),
        parse_number(F.col("c_mktsegment")).alias("word"),
    )


def clean_category_text(spark, directory):
    cleaned = clean_category(F.col("text"))
    return read(spark, directory, "documents").select(
        "doc_id", F.md5(cleaned).alias("text_md5"), F.length(cleaned).cast("bigint").alias("chars"),
        clean_category(F.concat(F.lit(" \t"), F.col("lang"), F.lit("\n"))).alias("lang"),
    )


def csv_source(spark, directory):
    """Write the listing as CSV, read it back as checked text, and type it."""
    path = fresh(spark) + ".csv"
    write_csv(listing(spark, directory), path)
    frame, _ = training_rows(read_csv(spark, path, position=True), ROLES)
    return clean(frame, ROLES).select("id", "label", *ROLES.features)


def fingerprint(spark, directory):
    return table_fingerprint(listing(spark, directory))


# --- profile -------------------------------------------------------------------------------------


def missing(spark, directory):
    return rounded(missing_profile(listing(spark, directory)), 6, "missing_percent")


def summary(spark, directory):
    found = numeric_summary(staged(spark, directory), [*ROLES.numeric, "label"])
    return rounded(found, 6, "mean", "std", "min", "q25", "q50", "q75", "max")


def pearson(spark, directory):
    return rounded(pearson_matrix(staged(spark, directory), ROLES.numeric), 8, "pearson")


def spearman(spark, directory):
    found = spearman_target(staged(spark, directory), ROLES.numeric, "label")
    return rounded(found, 8, "spearman").drop("p_value")


def categories(spark, directory):
    return category_counts(listing(spark, directory), ROLES.categorical)


def label_histogram(spark, directory):
    frame = staged(spark, directory).select("label", F.log1p("label").alias("log1p_label"))
    return rounded(histogram(frame, ["label", "log1p_label"]), 6, "lower", "upper")


# --- features ------------------------------------------------------------------------------------


def impute_median(spark, directory):
    frame = staged(spark, directory)
    features = RoleFeatures(ROLES, "original").fit(frame)
    return features.transform(frame).drop("label")


def drop_incomplete(spark, directory):
    kept = complete_columns(listing(spark, directory), ROLES.features)
    return spark.createDataFrame([(c,) for c in kept], "column string")


def derived_features(spark, directory):
    frame = staged(spark, directory)
    features = RoleFeatures(ROLES, "engineered").fit(frame)
    return features.transform(frame).select("id", "TotalSF", "TotalBath", "AgeAtSale")


def group_relative(spark, directory):
    frame = staged(spark, directory)
    features = RoleFeatures(ROLES, "extended").fit(frame)
    out = features.transform(frame).select("id", "SF_Rel_to_Nbhd", "Qual_SF_Interact")
    return rounded(out, 8, "SF_Rel_to_Nbhd")


def split_assign(spark, directory):
    ids = listing(spark, directory).select("id")
    return split_rows(materialize(ids), "id", SEED, 0.20, 0.16)


def kfold_assign(spark, directory):
    return kfold(materialize(listing(spark, directory).select("id")), "id", FOLDS, SEED)


def permute_labels(spark, directory):
    frame = listing(spark, directory).select("id", "label")
    return permuted(frame, "label", "id", f"null:{SEED}:0")


def hash_order_index(spark, directory):
    ids = listing(spark, directory).select("id")
    order = [row_hash(F.col("id"), f"order:{SEED}"), F.col("id")]
    return with_row_index(ids, order, "row_index")


def target_encode_full(spark, directory):
    frame = staged(spark, directory)
    encoder = TargetEncoder(FOLDS).fit(frame, [], ROLES.categorical, "label")
    out = encoder.transform(frame).select("id", *encoder.columns)
    return rounded(out, 6, *encoder.columns)


def target_encode_crossfit(spark, directory):
    frame = with_folds(spark, directory)
    encoder = TargetEncoder(FOLDS).fit(frame, [], ROLES.categorical, "label", "fold")
    out = encoder.transform(frame, train=True).select("id", "fold", *encoder.columns)
    return rounded(out, 6, *encoder.columns)


def onehot_encode(spark, directory):
    """Slots of the sparse vectors of all categories, one column each for the comparison."""
    frame = staged(spark, directory).select("id", *ROLES.categorical)
    encoder = OneHotEncoder().fit(frame, [], ROLES.categorical)
    slots = []
    for vector, c in zip(encoder.inputs, encoder.categorical):
        values = vector_to_array(vector)
        slots += [F.get(values, i).alias(f"{c}_{k}") for i, k in enumerate(encoder.vocabulary[c])]
    return encoder.transform(frame).select("id", *slots)


def crossfit_metrics(spark, directory):
    """Cross-fitted group encoding taken as the prediction, scored per fold."""
    frame = with_folds(spark, directory).select("id", "label", "grp", "fold")
    encoder = TargetEncoder(FOLDS).fit(frame, [], ["grp"], "label", "fold")
    scored = encoder.transform(frame, train=True)
    out = metric_summary(scored, "label", "grp_encoded", ["fold"])
    return rounded(out, 6, *[c for c in out.columns if c not in ("fold", "rows")])


def log_price(df: DataFrame, *keys: str) -> DataFrame:
    """Means of prices in cents often end in a 5; their logs round alike in every engine."""
    return df.select(*keys, F.round(F.log("Peer_Comp_Price"), 8).alias("log_peer_price"))


def knn_peer_price(spark, directory):
    frame = staged(spark, directory)
    peers = PeerComparables(ROLES).fit(frame, "label")
    return log_price(peers.transform(frame), "id")


def knn_peer_crossfit(spark, directory):
    frame = with_folds(spark, directory)
    peers = PeerComparables(ROLES).fit_folds(frame, "label", "fold", FOLDS)
    return log_price(peers.transform(frame, fold="fold"), "id", "fold")


# --- metrics -------------------------------------------------------------------------------------


def guessed(spark, directory) -> DataFrame:
    return staged(spark, directory).select("id", "label", F.expr(GUESS).alias("guess"))


def metrics(spark, directory):
    out = metric_summary(guessed(spark, directory), "label", "guess")
    return rounded(out, 6, *[c for c in out.columns if c != "rows"])


def quantile_bands(spark, directory):
    frame = guessed(spark, directory)
    edges = band_edges(frame, "label")
    return frame.select("id", band_code(F.col("label"), edges).alias("band"))


def bands(spark, directory):
    out = band_metrics(guessed(spark, directory), "label", "guess").drop("price_band")
    return rounded(out, 6, *[c for c in out.columns if c not in ("band", "rows")])


def fold_table(spark, directory) -> DataFrame:
    """(candidate, ordinal, fold, metric, value): the median and the group encoding per fold."""
    frame = with_folds(spark, directory).select("id", "label", "grp", "fold")
    medians = [
        column_medians(frame.where(F.col("fold") != f), ["label"])["label"] for f in range(FOLDS)
    ]
    encoder = TargetEncoder(FOLDS).fit(frame, [], ["grp"], "label", "fold")
    scored = encoder.transform(frame, train=True).withColumn(
        "median", F.get(F.array(*map(F.lit, medians)), F.col("fold"))
    )
    parts = []
    for ordinal, (name, guess) in enumerate([("median_baseline", "median"), ("group_mean", "grp_encoded")]):
        wide = scored.groupBy("fold").agg(*metric_aggregates(F.col("label"), F.col(guess)))
        parts.append(
            wide.unpivot("fold", ["mae", "rmse", "r2"], "metric", "value").select(
                F.lit(name).alias("candidate"), F.lit(ordinal).alias("ordinal"), "fold", "metric", "value"
            )
        )
    return materialize(parts[0].unionByName(parts[1]))


def median_baseline_cv(spark, directory):
    """The job's own cross-validation of its median model."""
    scores = cross_validate(PriceModel(ROLES, "dummy", "original", "raw"), with_folds(spark, directory), FOLDS)
    rows = [(f, m, float(s[m])) for f, s in enumerate(scores) for m in ("mae", "rmse", "r2")]
    return rounded(spark.createDataFrame(rows, "fold int, metric string, value double"), 6, "value")


def cv_table(spark, directory):
    out = cv_summary(fold_table(spark, directory), ["candidate", "ordinal"])
    return rounded(rank_candidates(out, "rmse").drop("ordinal"), 5, *out.columns[2:])


def winner(spark, directory):
    return pick_winner(cv_summary(fold_table(spark, directory), ["candidate", "ordinal"]), "rmse")


def univariate(spark, directory):
    frame = listing(spark, directory)
    out = linear.univariate_ols(frame, "acctbal", "label")
    return rounded(out, 6, "slope", "intercept")


def log_fit(spark, directory, x: str) -> DataFrame:
    """Listing rows with `x` and the log label's straight-line fit on it."""
    frame = staged(spark, directory).where(col(x).isNotNull()).withColumn("y", F.log1p("label"))
    fit = linear.univariate_ols(frame, x, "y").first()
    return frame.withColumn("log_guess", F.lit(fit["intercept"]) + F.lit(fit["slope"]) * col(x))


def smearing(spark, directory):
    frame = log_fit(spark, directory, "quality")
    factor = smearing_factor(frame, "label", "log_guess")
    return rounded(spark.createDataFrame([(factor,)], "factor double"), 8, "factor")


def weighted_vote(spark, directory):
    first = log_fit(spark, directory, "quality").withColumnRenamed("log_guess", "p1")
    fit = linear.univariate_ols(first, "acctbal", "y").first()
    second = F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("acctbal")
    out = first.select(
        "id",
        *[(F.col("p1") * BLEND[n][0] + second * BLEND[n][1]).alias(n) for n in ("voting", "weighted")],
    )
    return rounded(out, 8, "voting", "weighted")


def penalised_fits(spark, directory):
    """Ridge, lasso and elastic net of the label on the standardised balance."""
    frame = staged(spark, directory).select("acctbal", "label")
    s = frame.agg(F.avg("acctbal").alias("m"), F.stddev_pop("acctbal").alias("s")).first()
    scaled = frame.select(((F.col("acctbal") - s["m"]) / s["s"]).alias("x"), "label")
    design = materialize(assemble(scaled, ["x"]))
    rows = design.count()
    fits = {
        "ridge": linear.ridge(design, 1, rows, 1000.0),
        "lasso": linear.lasso(design, 1, 100.0),
        "elasticnet": linear.elasticnet(design, 1, 100.0, 0.5),
    }
    values = [(n, float(f.coefficients[0]), float(f.intercept)) for n, f in fits.items()]
    out = spark.createDataFrame(values, "model string, slope double, intercept double")
    return rounded(out, 3, "slope", "intercept")


# --- selection -----------------------------------------------------------------------------------


def null_gains(spark, directory) -> tuple[DataFrame, DataFrame]:
    """Per feature: squared correlation with the label, and with hash noise per run."""
    frame = staged(spark, directory)
    noise = [
        row_hash(F.col("id"), f"noise:{r}").cast("double").alias(f"n{r}") for r in range(NULL_RUNS)
    ]
    long = frame.select("label", *noise, *ROLES.numeric).unpivot(
        ["label", *[f"n{r}" for r in range(NULL_RUNS)]], list(ROLES.numeric), "feature", "x"
    ).where("x is not null")
    wide = long.groupBy("feature").agg(
        F.pow(F.corr("x", "label"), 2).alias("actual"),
        *[F.pow(F.corr("x", f"n{r}"), 2).alias(f"g{r}") for r in range(NULL_RUNS)],
    )
    wide = materialize(wide)
    runs = F.array(
        *[F.struct(F.lit(r).alias("run"), F.col(f"g{r}").alias("gain")) for r in range(NULL_RUNS)]
    )
    return wide.select("feature", "actual"), wide.select("feature", F.inline(runs))


def null_threshold(spark, directory):
    actual, nulls = null_gains(spark, directory)
    out = null_thresholds(nulls, 95).join(actual, "feature")
    out = out.withColumn("selected", F.col("actual") > F.col("threshold"))
    return rounded(out, 12, "threshold", "actual")


def stability_count(spark, directory):
    actual, nulls = null_gains(spark, directory)
    passed = nulls.join(actual, "feature").select(
        "feature", "run", (F.col("actual") > F.col("gain")).alias("passed")
    )
    return stable_features(passed.where("run < 5"))


# --- fits and jobs ----------------------------------------------------------


def fitted_prices(family: str, **options):
    """Fit with the family's own defaults and price every row: (id, price), rounded to hundreds."""

    def query(spark, directory):
        frame = staged(spark, directory)
        model = PriceModel(ROLES, family, **options).fit(frame)
        return model.predict(frame).select("id", F.round("prediction", -2).alias("price"))

    return query


#: A label of known splits, for families of trees: two columns, one cut each.
PLANTED = "100000.0D + CASE WHEN quality > 3 THEN 40000 ELSE 0 END + CASE WHEN year_sold >= 1995 THEN 10000 ELSE 0 END"


def planted_prices(family: str, **options):
    """Fit a label of known splits with the family's own defaults and price every row: (id, price)."""

    def query(spark, directory):
        frame = materialize(listing(spark, directory).withColumn("label", F.expr(PLANTED)))
        model = PriceModel(ROLES, family, **options).fit(frame)
        return model.predict(frame).select("id", F.round("prediction", 2).alias("price"))

    return query


def selected_by(method: str, **options):
    def query(spark, directory):
        model = PriceModel(ROLES, "ridge", selection=method, **options).fit(staged(spark, directory))
        return model.feature_records(spark)

    return query


def train_job(spark, directory):
    run = fresh(spark)
    train(spark, listing(spark, directory), run, make_config("default"), ROLES)
    return report_tables(spark, run)["evaluation"]


def predict_job(spark, directory):
    run, out = fresh(spark), fresh(spark)
    frame = staged(spark, directory)
    train(spark, frame, run, make_config("default"), ROLES)
    return predict(spark, f"{run}/model", frame.drop("label"), out, ROLES)


def eda_job(spark, directory):
    tables = profile(spark, listing(spark, directory), fresh(spark), ROLES)
    return rounded(tables["target_associations"], 8, "spearman").drop("p_value")


QUERIES = {
    "dedup_rows": dedup_rows,
    "dedup_first": dedup_first,
    "validate_ids": validate_ids,
    "parse_money": parse_money_text,
    "clean_numeric": clean_numeric,
    "clean_category": clean_category_text,
    "csv_source": csv_source,
    "table_fingerprint": fingerprint,
    "missing_profile": missing,
    "numeric_summary": summary,
    "pearson_matrix": pearson,
    "spearman_target": spearman,
    "category_counts": categories,
    "histogram": label_histogram,
    "impute_median": impute_median,
    "drop_incomplete": drop_incomplete,
    "derived_features": derived_features,
    "group_relative": group_relative,
    "split_assign": split_assign,
    "kfold_assign": kfold_assign,
    "permute_labels": permute_labels,
    "hash_order_index": hash_order_index,
    "target_encode_full": target_encode_full,
    "target_encode_crossfit": target_encode_crossfit,
    "onehot_encode": onehot_encode,
    "crossfit_metrics": crossfit_metrics,
    "knn_peer_price": knn_peer_price,
    "knn_peer_crossfit": knn_peer_crossfit,
    "metric_summary": metrics,
    "quantile_bands": quantile_bands,
    "band_metrics": bands,
    "median_baseline_cv": median_baseline_cv,
    "cv_summary": cv_table,
    "pick_winner": winner,
    "univariate_ols": univariate,
    "smearing_factor": smearing,
    "weighted_vote": weighted_vote,
    "penalised_fits": penalised_fits,
    "null_threshold": null_threshold,
    "stability_count": stability_count,
    "ridge_fit": fitted_prices("ridge"),
    "onehot_ols_fit": fitted_prices("linear", encoding="onehot", target_transform="raw"),
    "lasso_fit": fitted_prices("lasso"),
    "elasticnet_fit": fitted_prices("elasticnet"),
    "ridge_extended_fit": fitted_prices("ridge", feature_set="extended"),
    "forest_fit": planted_prices("random_forest"),
    "gbt_shallow_fit": planted_prices("gbt_shallow"),
    "gbt_mid_fit": planted_prices("gbt_mid"),
    "gbt_deep_fit": planted_prices("gbt_deep"),
    "gbt_symmetric_fit": planted_prices("gbt_deep", params={"grow": "symmetric"}),
    "voting_fit": planted_prices("voting"),
    "weighted_fit": planted_prices("weighted"),
    "stacking_fit": planted_prices("stacking"),
    "boruta_select": selected_by("boruta"),
    "null95_select": selected_by("null95"),
    "null80_select": selected_by("null80"),
    "stable_null_select": selected_by("stable_null"),
    "eda_job": eda_job,
    "train_job": train_job,
    "predict_job": predict_job,
}
