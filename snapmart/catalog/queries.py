"""Registered queries: every operator over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.catalog.fixtures import table, view
from snapmart.functions.dates import date_from_name, parse_date
from snapmart.functions.labels import map_binary_label
from snapmart.functions.numbers import parse_number
from snapmart.functions.text import strip_text
from snapmart.operators import boosting, clean, drift, features, formats, metrics, models, rows, schema, splits
from snapmart.operators import target_encoding as target_encodings
from snapmart.operators.fuzzy import DEMOGRAPHIC_SPECS, canonicalize, fuzzy_dictionary
from snapmart.plans.end_to_end import run_end_to_end, stage_counts
from snapmart.plans.gold import gold_snapshot
from snapmart.plans.layers import layer_row_counts, run_layers, run_ledgered_layers
from snapmart.plans.monitor import merge_months, monitor, monitor_state, stored_state
from snapmart.plans.training import REPORTED, drift_grade, evaluate, model_matrix, training_frame
from snapmart.operators.lookup import staged_lookup
from snapmart.operators.score_state import state_psi
from snapmart.session import workspace
from snapmart.sources import csv
from snapmart.sources.fits import Fits
from snapmart.sources.ledger import Ledger
from snapmart.sources.layers import read_named_files, read_snapshots, write_snapshots

TRAIN = ("1996-02-01", "1997-04-01")
OOT = ("1997-05-01", "1997-09-01")
MODEL_MONTH = ["model", "month"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Nine digits; exact halves are lifted, so that the order of a sum cannot decide them."""
    return df.withColumns({n: F.round(F.col(n) + 1e-12, 9) for n in names})


def labels(spark, sf_dir):
    return rows.parse_snapshot_date(view(spark, sf_dir, "fx_label"))


def coded(spark, sf_dir):
    df = rows.normalize_key(labels(spark, sf_dir), "customerID")
    return df.select("customerID", "snapdate", "ord_", map_binary_label(F.col("Churn")).alias("y"))


# --- gold ----------------------------------------------------------------------------------
def cleaned_features(spark, sf_dir):
    return {
        "contract": clean.clean_contract(view(spark, sf_dir, "fx_contract")),
        "service": clean.clean_service(view(spark, sf_dir, "fx_service")),
        "demographic": clean.clean_demographic(view(spark, sf_dir, "fx_demographic")),
        "financial": clean.clean_financial(view(spark, sf_dir, "fx_financial"), order="ord_"),
    }


@query
def gold_snapshot_query(spark, sf_dir):
    return gold_snapshot(labels(spark, sf_dir), cleaned_features(spark, sf_dir))


# --- bronze and months ---------------------------------------------------------------------
@query
def parse_snapdate(spark, sf_dir):
    return labels(spark, sf_dir)


@query
def bad_date_count(spark, sf_dir):
    df = view(spark, sf_dir, "fx_label")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(parse_date(F.col("snapdate")).isNull()).alias("n_bad"))


DATED = {"orders": "fx_order_dates", "lineitem": "fx_ship_dates"}


@query
def date_format_votes(spark, sf_dir):
    votes = [formats.format_votes(view(spark, sf_dir, v), ["snapdate"], "ord_").select(F.lit(name).alias("table"), "format", "n", "first") for name, v in DATED.items()]
    return rows.union_all(votes)


@query
def dates_in_two_formats(spark, sf_dir):
    """Rows by date of two tables, each read in its elected format; the rejected rows under no date."""
    counted = []
    for name, v in DATED.items():
        df = view(spark, sf_dir, v)
        date = parse_date(F.col("snapdate"), formats.elect_format(df, "snapdate", "ord_"))
        counted.append(df.groupBy(date.alias("snapdate")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "snapdate", "n"))
    return rows.union_all(counted)


@query
def bronze_partition_counts(spark, sf_dir):
    path = workspace(spark, "bronze-label")
    write_snapshots(labels(spark, sf_dir), path)
    return read_snapshots(spark, path).groupBy("snapdate").agg(F.count(F.lit(1)).alias("n"))


@query
def snapshot_from_filename(spark, sf_dir):
    date = F.when(F.col("ord_") % 50 == 0, F.concat(F.substring("snapdate", 1, 4), F.lit("-13-01"))).otherwise(F.col("snapdate"))
    name = F.concat(F.lit("gold_"), F.replace(date, F.lit("-"), F.lit("_")), F.lit(".csv"))
    names = view(spark, sf_dir, "fx_label").select(name.alias("file_name")).distinct()
    return names.withColumn("snapdate", date_from_name(F.col("file_name")))


def calendar(df):
    bounds = df.agg(F.add_months(F.min("snapdate"), -2).alias("start"), F.add_months(F.max("snapdate"), 4).alias("end"))
    return splits.month_calendar(bounds)


@query
def month_calendar(spark, sf_dir):
    return calendar(labels(spark, sf_dir))


@query
def missing_months(spark, sf_dir):
    df = labels(spark, sf_dir)
    return splits.missing_months(df, calendar(df))


@query
def latest_snapshot(spark, sf_dir):
    return splits.latest_snapshot(labels(spark, sf_dir))


@query
def snapshot_range(spark, sf_dir):
    return splits.snapshot_range(labels(spark, sf_dir), *TRAIN)


@query
def snapshot_month_columns(spark, sf_dir):
    return splits.with_month_columns(labels(spark, sf_dir))


@query
def month_range_split(spark, sf_dir):
    name = splits.month_range_label(F.col("snapdate"), {"train": TRAIN, "oot": OOT})
    return labels(spark, sf_dir).withColumn("dataset", name).filter(F.col("dataset").isNotNull())


@query
def time_split(spark, sf_dir):
    return splits.time_split(labels(spark, sf_dir))


@query
def split_summary(spark, sf_dir):
    return time_split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- rows ----------------------------------------------------------------------------------
@query
def normalize_key(spark, sf_dir):
    return rows.normalize_key(view(spark, sf_dir, "fx_label"), "customerID")


@query
def drop_unknown_rows(spark, sf_dir):
    return rows.drop_unknown_rows(view(spark, sf_dir, "fx_service"), skip=("customerID", "ord_"))


@query
def sanitize_tokens(spark, sf_dir):
    return rows.sanitize_tokens(view(spark, sf_dir, "fx_demographic"), protected=("customerID",))


@query
def null_profile(spark, sf_dir):
    return schema.null_profile(view(spark, sf_dir, "fx_demographic"))


@query
def keep_last_per_key(spark, sf_dir):
    return rows.keep_last(view(spark, sf_dir, "fx_demographic"), "customerID", "ord_")


@query
def unique_keys_only(spark, sf_dir):
    return rows.keep_unique(view(spark, sf_dir, "fx_service"), "customerID")


@query
def dedup_report(spark, sf_dir):
    return rows.dedup_report(rows.normalize_key(labels(spark, sf_dir), "customerID"), "snapdate", "customerID")


@query
def keep_last_per_key_month(spark, sf_dir):
    return rows.keep_last(rows.normalize_key(labels(spark, sf_dir), "customerID"), ["customerID", "snapdate"], "ord_")


@query
def union_snapshots(spark, sf_dir):
    df = labels(spark, sf_dir)
    half = F.lit("1998-05-01").cast("date")
    early, late = df.filter(F.col("snapdate") < half), df.filter(F.col("snapdate") >= half)
    return rows.union_all([early, late.withColumn("channel", F.lit("web"))])


# --- labels --------------------------------------------------------------------------------
@query
def training_frame_query(spark, sf_dir):
    return training_frame(labels(spark, sf_dir), *TRAIN)


@query
def map_binary_label_query(spark, sf_dir):
    return view(spark, sf_dir, "fx_label").select("ord_", "Churn", map_binary_label(F.col("Churn")).alias("y"))


@query
def label_distribution(spark, sf_dir):
    return rounded(splits.label_distribution(coded(spark, sf_dir), "y"), "rate")


@query
def class_weights(spark, sf_dir):
    return rounded(splits.class_weights(coded(spark, sf_dir), "y"), "w_balanced", "w_max")


# --- categories ----------------------------------------------------------------------------
def canonical(*columns):
    def run(spark, sf_dir):
        df = view(spark, sf_dir, "fx_demographic").select("customerID", "ord_", *columns)
        return canonicalize(df, {c: DEMOGRAPHIC_SPECS[c] for c in columns})
    return run


QUERIES |= {
    "clean_gender": canonical("gender"), "clean_yes_no": canonical("Partner", "Dependents"),
    "clean_education": canonical("EducationLevel"), "clean_employment": canonical("EmploymentStatus"),
    "clean_income_bracket": canonical("AnnualIncomeBracket"),
}


@query
def clean_demographic(spark, sf_dir):
    return clean.clean_demographic(view(spark, sf_dir, "fx_demographic"))


@query
def grown_dictionary(spark, sf_dir):
    """The demographic table cleaned by a stored dictionary that has grown twice, from a tenth of the customers first."""
    fits = Fits(spark, workspace(spark, "fits"))
    df = view(spark, sf_dir, "fx_demographic")
    for part in (df.filter("ord_ % 10 = 1"), df, df):
        fits.grow(rows.normalize_key(part, "customerID"), DEMOGRAPHIC_SPECS)
    return clean.clean_demographic(df, dictionary=fits.dictionary())


@query
def stored_fences(spark, sf_dir):
    """The financial table cleaned by fences that an earlier call has stored."""
    fits = Fits(spark, workspace(spark, "fits"))
    df = view(spark, sf_dir, "fx_financial")
    fits.fences(df, clean.FINANCIAL_SPECS, "first")
    return clean.clean_financial(df, fences=fits.fences(df.limit(0), clean.FINANCIAL_SPECS, "first"))


@query
def fuzzy_dictionary_query(spark, sf_dir):
    df = fuzzy_dictionary(view(spark, sf_dir, "fx_demographic"), DEMOGRAPHIC_SPECS)
    return df.withColumn("score", F.round("score", 4))


# --- numbers -------------------------------------------------------------------------------
NUMBERS = list(clean.FINANCIAL_SPECS)


@query
def parse_number_query(spark, sf_dir):
    df = view(spark, sf_dir, "fx_financial")
    return df.select("customerID", "ord_", *[parse_number(F.col(c)).alias(c) for c in NUMBERS])


@query
def iqr_fences(spark, sf_dir):
    fences = clean.iqr_fences(view(spark, sf_dir, "fx_financial"), clean.FINANCIAL_SPECS)
    table_rows = [(c, f["q1"], f["q3"], f["upper"]) for c, f in fences.items()]
    return rounded(spark.createDataFrame(table_rows, "column string, q1 double, q3 double, upper double"), "q1", "q3", "upper")


def numeric(column, spec):
    def run(spark, sf_dir):
        return clean.clean_numeric(view(spark, sf_dir, "fx_financial").select("customerID", column), {column: spec})
    return run


QUERIES |= {
    "clean_monthly_charges": numeric("MonthlyCharges", clean.MONTHLY_CHARGES),
    "clean_data_usage": numeric("AverageDataUsage", clean.DATA_USAGE),
    "clean_app_logins": numeric("AppLoginFrequency", clean.APP_LOGINS),
    "refund_split": numeric("MonthlyCharges", clean.REFUND_CHARGES),
}


@query
def clean_financial(spark, sf_dir):
    return clean.clean_financial(view(spark, sf_dir, "fx_financial"))


@query
def numeric_ratio(spark, sf_dir):
    return rounded(schema.numeric_ratio(view(spark, sf_dir, "fx_financial"), NUMBERS), "ratio")


@query
def clean_contract(spark, sf_dir):
    return clean.clean_contract(view(spark, sf_dir, "fx_contract"))


@query
def clean_service(spark, sf_dir):
    return clean.clean_service(view(spark, sf_dir, "fx_service"))


# --- schema and features -------------------------------------------------------------------
def financial(spark, sf_dir):
    return clean.clean_financial(view(spark, sf_dir, "fx_financial"), order="ord_")


@query
def binary_column_scan(spark, sf_dir):
    df = clean.clean_numeric(view(spark, sf_dir, "fx_financial"), clean.FINANCIAL_SPECS)
    return schema.binary_column_scan(df.select(
        F.col("MonthlyCharges_was_negative").cast("int").alias("negative"),
        F.col("MonthlyCharges_was_outlier").cast("int").alias("outlier"), "MonthlyCharges", "AppLoginFrequency"))


@query
def align_to_schema(spark, sf_dir):
    wanted = F.struct(F.lit(0).alias("y"), F.lit("").alias("customerID"), F.lit(0.0).alias("tenure"), F.lit("").alias("region"))
    target = spark.range(1).select(wanted.alias("s")).schema["s"].dataType
    return schema.align_to_schema(coded(spark, sf_dir), target, fill=0)


@query
def date_features(spark, sf_dir):
    return features.calendar_features(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))


@query
def fill_missing(spark, sf_dir):
    return features.fill_missing(financial(spark, sf_dir), exclude=("ord_",))


@query
def impute_median(spark, sf_dir):
    return features.impute_median(financial(spark, sf_dir).select("customerID", "ord_", *NUMBERS), NUMBERS)


@query
def impute_mode(spark, sf_dir):
    df = clean.clean_demographic(view(spark, sf_dir, "fx_demographic"))
    return features.impute_mode(df, list(DEMOGRAPHIC_SPECS))


@query
def scale_by_std(spark, sf_dir):
    return rounded(features.scale_by_std(impute_median(spark, sf_dir), NUMBERS), *NUMBERS)


@query
def rare_category_pooling(spark, sf_dir):
    df = view(spark, sf_dir, "fx_label").select("ord_", strip_text(F.col("customerID")).alias("customerID"))
    return features.pool_rare_categories(df, ["customerID"], min_frequency=10)


@query
def model_matrix_query(spark, sf_dir):
    demo = rows.keep_last(clean.clean_demographic(view(spark, sf_dir, "fx_demographic")), "customerID", "ord_")
    df = (training_frame(labels(spark, sf_dir), *TRAIN).drop("ord_")
          .join(demo.select("customerID", "gender", "EducationLevel"), "customerID")
          .join(financial(spark, sf_dir).select("customerID", *NUMBERS), "customerID"))
    return model_matrix(df, "Churn", keep=("customerID",))


# --- splits and models ---------------------------------------------------------------------
def documents(spark, sf_dir):
    """Labelled documents; the label table has one row per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@query
def stratified_split(spark, sf_dir):
    df = documents(spark, sf_dir).select("doc_id", "quality")
    return splits.stratified_split(df, "quality", "doc_id")


@query
def stratified_split_by_month(spark, sf_dir):
    return splits.stratified_split(coded(spark, sf_dir), "y", ["customerID", "snapdate", "ord_"])


@query
def csv_round_trip(spark, sf_dir):
    """A given table written as CSV files with dates in their names, in two encodings, and read back as one table."""
    df = view(spark, sf_dir, "fx_demographic").select("customerID", "EducationLevel", "AnnualIncomeBracket", "ord_")
    root = workspace(spark, "csv")
    for month, part, encoding in (("2024_01_01", 0, "utf-8"), ("2024_02_01", 1, "gb18030")):
        csv.write_csv(df.filter(F.col("ord_") % 2 == part), f"{root}/gold_{month}.csv", encoding=encoding)
    return read_named_files(spark, f"{root}/*.csv", order=None)


DOC_NUMERIC, DOC_CATEGORICAL = ["n_chars"], ["lang", "source"]


def document_parts(spark, sf_dir):
    parts = staged_lookup(splits.stratified_split(documents(spark, sf_dir), "quality", "doc_id"))
    return parts, parts.filter("part = 'train'"), parts.filter("part = 'test'")


def scored(model, df, key, label):
    return model.score(df).select(key, F.col(label).alias("y"), "p", "prediction")


@query
def logreg_train_predict(spark, sf_dir):
    parts, train, _ = document_parts(spark, sf_dir)
    model = models.fit_logistic(train, "quality", DOC_NUMERIC, DOC_CATEGORICAL)
    return scored(model, parts, "doc_id", "quality")


@query
def logreg_coefficients(spark, sf_dir):
    _, train, _ = document_parts(spark, sf_dir)
    return models.coefficients(models.fit_logistic(train, "quality", DOC_NUMERIC, DOC_CATEGORICAL), spark)


@query
def gbt_train_predict(spark, sf_dir):
    parts, train, test = document_parts(spark, sf_dir)
    model = models.fit_boosted_trees(train, test, "quality", DOC_NUMERIC, DOC_CATEGORICAL)
    return scored(model, parts, "doc_id", "quality")


@query
def boosting_rounds(spark, sf_dir):
    """AUC after every round of two ensembles whose margins are made of the orders."""
    return rounded(boosting.round_auc(view(spark, sf_dir, "fx_rounds"), ["model"]), "auc")


@query
def boosting_best_round(spark, sf_dir):
    """The round that patience of 3 leaves."""
    rounds = boosting.round_auc(view(spark, sf_dir, "fx_rounds"), ["model"])
    return rounded(boosting.best_rounds(rounds, ["model"], patience=3), "best_auc")


@query
def target_encoding(spark, sf_dir):
    """Languages and sources of labelled documents as label means: out of fold in train, of all of train elsewhere."""
    parts, train, test = document_parts(spark, sf_dir)
    fitted = target_encodings.fit_target_encoding(train, "quality", DOC_CATEGORICAL, ["doc_id"])
    known = fitted.transform(train, target_encodings.fold_of(["doc_id"]), "_mean").unionByName(fitted.transform(test, suffix="_mean"))
    return rounded(known.select("doc_id", "part", *[f"{c}_mean" for c in DOC_CATEGORICAL]), *[f"{c}_mean" for c in DOC_CATEGORICAL])


@query
def target_encoding_table(spark, sf_dir):
    """Encoding of a category that nearly every row has for itself: customers by order status."""
    orders = view(spark, sf_dir, "fx_label").withColumn("y", map_binary_label(F.col("Churn")))
    fitted = target_encodings.fit_target_encoding(orders, "y", ["customerID"], ["ord_"])
    return rounded(fitted.table.select("column", "value", F.posexplode("encoded").alias("place", "mean")), "mean")


@query
def feature_importance(spark, sf_dir):
    _, train, test = document_parts(spark, sf_dir)
    model = models.fit_boosted_trees(train, test, "quality", DOC_NUMERIC, DOC_CATEGORICAL)
    return models.feature_importance(model, spark)


@query
def logreg_optimality(spark, sf_dir):
    """The kept features, and whether the loss is stationary in each at the fitted coefficients."""
    _, train, _ = document_parts(spark, sf_dir)
    model = models.fit_logistic(train, "quality", DOC_NUMERIC, DOC_CATEGORICAL)
    return models.stationarity(model, train, "quality").drop("gradient")


def agreeing(scores, *columns):
    """Scores lie in 0 to 1 and predictions are what the scores say."""
    return scores.select(*columns, ((F.col("prediction") == (F.col("p") >= 0.5).cast("int")) & F.col("p").between(0, 1)).alias("agrees"))


@query
def gbt_agreement(spark, sf_dir):
    parts, train, test = document_parts(spark, sf_dir)
    model = models.fit_boosted_trees(train, test, "quality", DOC_NUMERIC, DOC_CATEGORICAL)
    return agreeing(model.score(parts), "doc_id", "quality", "part")


GOLD_NUMERIC = [*NUMBERS, "CustomerSatisfactionScore"]
GOLD_CATEGORICAL = ["Contract", "PaymentMethod", "InternetService", "StreamingTV", *DEMOGRAPHIC_SPECS]


def coded_gold(spark, sf_dir):
    df = gold_snapshot_query(spark, sf_dir)
    df = df.withColumn("CustomerSatisfactionScore", parse_number(F.col("CustomerSatisfactionScore")))
    return staged_lookup(df.withColumn("Churn", map_binary_label(F.col("Churn"))))


@query
def batch_score(spark, sf_dir):
    """Model of the training months, applied to the newest snapshot."""
    gold = coded_gold(spark, sf_dir)
    model = models.fit_logistic(splits.snapshot_range(gold, *TRAIN), "Churn", GOLD_NUMERIC, GOLD_CATEGORICAL)
    return scored(model, splits.latest_snapshot(gold), "customerID", "Churn")


@query
def monitor_models(spark, sf_dir):
    """Both models, trained on the training months and monitored over the months after them."""
    gold = coded_gold(spark, sf_dir)
    train = splits.snapshot_range(gold, *TRAIN)
    parts = splits.stratified_split(train, "Churn", ["customerID", "snapdate"])
    held_out = parts.filter("part = 'test'")
    fitted = {
        "logreg": models.fit_logistic(train, "Churn", GOLD_NUMERIC, GOLD_CATEGORICAL),
        "trees": models.fit_boosted_trees(parts.filter("part = 'train'"), held_out, "Churn", GOLD_NUMERIC, GOLD_CATEGORICAL),
    }
    return monitor(gold, fitted, "Churn", *OOT)


@query
def batch_score_agreement(spark, sf_dir):
    return agreeing(batch_score(spark, sf_dir), "customerID", "y")


@query
def monitor_counts(spark, sf_dir):
    """Rows and positives that each model is monitored on, by month."""
    return monitor_models(spark, sf_dir).select("model", "month", "n", "positives")


# --- evaluation ----------------------------------------------------------------------------
def scores(spark, sf_dir):
    return view(spark, sf_dir, "fx_scores")


def marked(spark, sf_dir):
    return scores(spark, sf_dir).withColumn("dataset", F.when(F.col("month") <= "1998-12", "validation").otherwise("oot"))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scores(spark, sf_dir), MODEL_MONTH)


@query
def threshold_metrics(spark, sf_dir):
    return rounded(metrics.threshold_metrics(scores(spark, sf_dir), MODEL_MONTH), "accuracy", "precision", "recall", "f1")


@query
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(scores(spark, sf_dir), ["model"]), "precision", "recall", "f1")


def one_ranking(metric):
    def run(spark, sf_dir):
        return rounded(metrics.ranking_metrics(scores(spark, sf_dir), MODEL_MONTH, [metric]), metric)
    return run


QUERIES |= {
    "auc_by_month": one_ranking("auc"), "average_precision_by_month": one_ranking("average_precision"),
    "ks_by_month": one_ranking("ks"),
}


@query
def calibration_metrics(spark, sf_dir):
    return rounded(metrics.calibration_metrics(scores(spark, sf_dir), MODEL_MONTH), "brier", "logloss", "pred_mean", "pred_std")


@query
def monthly_metrics(spark, sf_dir):
    df = metrics.monthly_metrics(scores(spark, sf_dir), MODEL_MONTH)
    return rounded(df, *metrics.RANKING, *metrics.THRESHOLDED, "accuracy", "brier", "logloss", "pred_mean", "pred_std")


@query
def evaluation_by_dataset(spark, sf_dir):
    df = evaluate(marked(spark, sf_dir), ["model", "dataset"])
    return rounded(df, "accuracy", "precision", "recall", "f1", "auc")


@query
def metrics_long(spark, sf_dir):
    df = evaluate(marked(spark, sf_dir), ["model", "dataset"]).withColumnRenamed("dataset", "Dataset")
    return rounded(metrics.metrics_long(df, ["model", "Dataset"], REPORTED), "Value")


@query
def prediction_summary(spark, sf_dir):
    return rounded(metrics.prediction_summary(scores(spark, sf_dir), ["model"]), "pred_mean")


@query
def score_histogram(spark, sf_dir):
    return drift.score_histogram(scores(spark, sf_dir), ["model"])


@query
def psi(spark, sf_dir):
    side = F.when(F.col("model") == "a", "expected").otherwise("actual")
    return rounded(drift.psi(scores(spark, sf_dir), side), "psi")


@query
def psi_grade(spark, sf_dir):
    side = F.when(F.col("month") <= "1998-12", "expected").otherwise("actual")
    return rounded(drift_grade(scores(spark, sf_dir), side, ["model"]), "psi")


def stored_scores(spark, sf_dir):
    """A stored score state: early months, then later ones in two batches, one of which brings more rows of the same months, and a month scored again."""
    root = workspace(spark, "scores")
    rows_of = scores(spark, sf_dir)
    merge_months(rows_of.filter("month <= '1996-06'"), root)
    merge_months(rows_of.filter("month > '1996-06' AND id % 3 = 0"), root)
    merge_months(rows_of.filter("month > '1996-06' AND id % 3 > 0"), root, add=True)
    merge_months(rows_of.filter("month = '1995-02'"), root)
    return root


@query
def score_state_metrics(spark, sf_dir):
    """Monthly metrics out of the stored counts."""
    got = monitor_state(spark, stored_scores(spark, sf_dir))
    return rounded(got, *metrics.RANKING, *metrics.THRESHOLDED, "accuracy", "brier", "logloss", "pred_mean", "pred_std")


@query
def score_state_psi(spark, sf_dir):
    """Drift between the months up to 1998 and those after, out of the stored counts."""
    side = F.when(F.col("month") <= "1998-12", "expected").otherwise("actual")
    index = state_psi(stored_state(spark, stored_scores(spark, sf_dir)), side, ["model"])
    return rounded(index.withColumn("grade", drift.psi_grade(F.col("psi"))), "psi")


# --- layers --------------------------------------------------------------------------------
@query
def layer_row_counts_query(spark, sf_dir):
    names = ("label", "contract", "service", "demographic", "financial")
    root = workspace(spark, "layers")
    run_layers(spark, {n: view(spark, sf_dir, f"fx_{n}") for n in names}, root)
    return layer_row_counts(spark, root, names)


@query
def run_ledger(spark, sf_dir):
    """What the ledger says of the layers after two runs, the second of which has nothing to do, and a third with other contracts."""
    names = ("label", "contract", "service", "demographic", "financial")
    root = workspace(spark, "ledger")
    tables = {n: view(spark, sf_dir, f"fx_{n}") for n in names}
    run_ledgered_layers(spark, tables, root)
    run_ledgered_layers(spark, tables, root)
    run_ledgered_layers(spark, tables | {"contract": tables["contract"].filter("ord_ % 2 = 0")}, root)
    entries = Ledger(spark, root).entries()
    run = F.row_number().over(Window.partitionBy("stage").orderBy("finished"))
    return entries.select("stage", run.alias("run"), "rows_in", "rows_out", "rejected")


@query
def end_to_end_counts(spark, sf_dir):
    """The noisy views written as CSV files and taken through every stage; rows of what the later stages write."""
    names = ("label", "contract", "service", "demographic", "financial")
    root = workspace(spark, "end-to-end")
    for n in names:
        csv.write_csv(view(spark, sf_dir, f"fx_{n}").orderBy("ord_").drop("ord_"), f"{root}/csv/{n}")
    run_end_to_end(spark, {n: f"{root}/csv/{n}" for n in names}, root, TRAIN, OOT)
    return stage_counts(spark, root)


def registered() -> dict[str, Query]:
    return {name.removesuffix("_query"): fn for name, fn in QUERIES.items()}
