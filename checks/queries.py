"""One query per operator, over the derived source tables of ``checks/fixtures.py``."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as X
from snapmart import schemas as S
from snapmart.operators import clean, dataset, features, intervals, loans, model, monitor, profile, quantiles, sketches
from snapmart.plans import etl, monitoring, training
from snapmart.plans.layout import Mart
from snapmart.session import materialize, new_path
from snapmart.sources import snapshots

# The given orders run from 1995 to 2001.
WINDOW = dataset.TrainingWindow(date(1999, 3, 1))
SPLIT_DAY = date(1998, 4, 1)
AVERAGES = [f"{c}_5m_avg" for c in S.CLICK_FEATURES]


def _rounded(df: DataFrame, columns, digits: int = 4) -> DataFrame:
    """Rounded to what does not depend on the order in which doubles are added."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def silver_loans(spark, sf) -> DataFrame:
    return loans.add_delinquency(X.raw_loans(spark, sf))


def labels(spark, sf) -> DataFrame:
    return loans.default_labels(silver_loans(spark, sf), dpd=90, mob=7)


def silver_attributes(spark, sf) -> DataFrame:
    return clean.clean_attributes(X.raw_attributes(spark, sf))


def silver_financials(spark, sf) -> DataFrame:
    """Kept as a table, as in the mart: later steps read it several times."""
    return materialize(clean.clean_financials(X.raw_financials(spark, sf)), "financials")


def feature_rows(spark, sf) -> DataFrame:
    return features.feature_store(
        silver_financials(spark, sf), silver_attributes(spark, sf), X.raw_clicks(spark, sf)
    )


def scored(spark, sf, name="gbt_a") -> DataFrame:
    return monitor.labelled_predictions(X.predictions(spark, sf), labels(spark, sf), name)


def label_split(spark, sf) -> DataFrame:
    return dataset.stratified_split(labels(spark, sf))


# Sources, filters, cleaning


def q_snapshot_list(spark, sf):
    return snapshots.snapshot_list(X.raw_loans(spark, sf))


def q_snapshot_filter(spark, sf):
    return snapshots.at_snapshot(silver_loans(spark, sf), date(1998, 6, 1))


def q_time_window(spark, sf):
    return snapshots.between_snapshots(labels(spark, sf), WINDOW.train_test_start, WINDOW.oot_end)


def q_completed_loans(spark, sf):
    rows = silver_loans(spark, sf)
    return rows.filter((F.col("installment_num") == 10) & (F.col("loan_start_date") < F.lit(date(1999, 1, 1))))


def q_bad_age(spark, sf):
    bad = profile.not_matching(X.raw_attributes(spark, sf), "Age", "^[0-9]+$")
    return bad.select(S.ENTITY, "Name", "Age")


def q_age_range(spark, sf):
    return profile.out_of_range(X.raw_attributes(spark, sf), "Age", 0, 100)


def q_cast_schema(spark, sf):
    """Text in every column, malformed in some rows, and three columns absent."""
    raw = X.raw_loans(spark, sf)
    text = raw.drop("paid_amt", "overdue_amt", "balance").selectExpr(
        *[f"cast({c} as string) as {c}" for c in raw.columns if c not in {"paid_amt", "overdue_amt", "balance"}]
    )
    dirty = text.withColumns(
        {
            "tenure": F.expr("case when cast(loan_id as bigint) % 7 = 0 then 'ten' else tenure end"),
            "due_amt": F.expr("case when cast(loan_id as bigint) % 5 = 0 then '' else due_amt end"),
        }
    )
    return clean.cast_columns(dirty, S.LOAN_TYPES)


def q_silver_attr(spark, sf):
    return silver_attributes(spark, sf)


def q_underscore_null(spark, sf):
    rows = clean.underscores_to_null(X.raw_financials(spark, sf))
    return rows.select(S.ENTITY, "Num_of_Loan", "Credit_Mix", "Monthly_Balance")


def q_silver_fin_cats(spark, sf):
    rows = clean.normalize_financial_texts(X.raw_financials(spark, sf))
    return rows.select(S.ENTITY, S.SNAPSHOT, *S.FINANCIAL_TEXTS)


def q_credit_age(spark, sf):
    return clean.normalize_financial_texts(X.raw_financials(spark, sf)).select(S.ENTITY, "Credit_History_Age")


def q_outlier_bounds(spark, sf):
    numbers = clean.numbers_from_text(X.raw_financials(spark, sf), S.FINANCIAL_NUMBERS)
    bounds = clean.outlier_bounds(numbers, S.FINANCIAL_NUMBERS, [S.SNAPSHOT])
    return _rounded(bounds, [c for c in bounds.columns if c != S.SNAPSHOT])


def q_iqr_clean(spark, sf):
    rows = clean.clean_numeric(X.raw_financials(spark, sf), S.FINANCIAL_NUMBERS)
    return rows.select(S.ENTITY, S.SNAPSHOT, *S.FINANCIAL_NUMBERS)


def q_iqr_approx(spark, sf):
    """Whether each approximate quartile is a value whose rank is off by at most 1 %, in whole ranks."""
    typed = clean.numbers_from_text(X.raw_financials(spark, sf), S.FINANCIAL_NUMBERS)
    numbers = materialize(typed.select(S.SNAPSHOT, *S.FINANCIAL_NUMBERS), "numbers")
    found = quantiles.approximate_quantiles(numbers, [S.SNAPSHOT], S.FINANCIAL_NUMBERS, [0.25, 0.75])
    doubles = numbers.select(S.SNAPSHOT, *[F.col(c).cast("double").alias(c) for c in S.FINANCIAL_NUMBERS])
    values = doubles.unpivot([S.SNAPSHOT], S.FINANCIAL_NUMBERS, "column", "v").filter("v is not null")
    ranked = values.join(found, [S.SNAPSHOT, "column"]).groupBy(S.SNAPSHOT, "column", "probability").agg(
        F.count("*").alias("n"), F.count_if(F.col("v") < F.col("value")).alias("below"),
        F.count_if(F.col("v") <= F.col("value")).alias("upto"),
    )
    rank, slack = F.ceil(F.col("probability") * F.col("n")), F.ceil(0.01 * F.col("n"))
    near = (F.col("below") + 1 <= rank + slack) & (F.col("upto") >= rank - slack) & (F.col("upto") > F.col("below"))
    return ranked.select(S.SNAPSHOT, "column", "probability", near.alias("near"))


def q_silver_fin(spark, sf):
    return clean.clean_financials(X.raw_financials(spark, sf))


def q_null_counts(spark, sf):
    return profile.null_counts(silver_financials(spark, sf))


def q_null_profile(spark, sf):
    return _rounded(profile.null_profile(silver_financials(spark, sf)), ["null_percent"])


def q_null_prune(spark, sf):
    return clean.drop_sparse_columns(silver_financials(spark, sf))


def q_complete_rows(spark, sf):
    dense = clean.drop_sparse_columns(silver_financials(spark, sf).drop("Type_of_Loan"))
    return dense.na.drop("any")


# Loans and labels


def q_silver_lms(spark, sf):
    return silver_loans(spark, sf)


def q_label_store(spark, sf):
    return labels(spark, sf)


def q_bad_rate_by_mob(spark, sf):
    return _rounded(loans.bad_rate_by_mob(silver_loans(spark, sf), 90, date(1999, 1, 1)), ["bad_rate"], 6)


def q_label_counts(spark, sf):
    return profile.count_by_snapshot(labels(spark, sf))


# Reports


def q_distinct_values(spark, sf):
    return profile.distinct_values(X.raw_attributes(spark, sf), "Occupation")


def q_key_coverage(spark, sf):
    return profile.key_coverage(labels(spark, sf), X.raw_clicks(spark, sf), [S.ENTITY, S.SNAPSHOT])


def q_entity_history(spark, sf):
    clicks = X.raw_clicks(spark, sf)
    first = clicks.agg(F.min(S.ENTITY)).first()[0]
    return profile.entity_history(clicks, first)


def q_first_rows(spark, sf):
    return silver_attributes(spark, sf).orderBy(S.ENTITY).limit(5)


# Features


def q_click_5m(spark, sf):
    return _rounded(features.rolling_month_average(X.raw_clicks(spark, sf)), AVERAGES)


def q_fin_attr(spark, sf):
    return features.customer_profiles(silver_financials(spark, sf), silver_attributes(spark, sf))


def q_feature_store(spark, sf):
    return _rounded(feature_rows(spark, sf), AVERAGES)


def q_feature_store_pit(spark, sf):
    """With the latest profile up to each click's date, instead of all."""
    rows = features.feature_store(
        silver_financials(spark, sf), silver_attributes(spark, sf), X.raw_clicks(spark, sf), point_in_time=True
    )
    return _rounded(rows, AVERAGES)


# Layered tables on disk


def _quoted_lines(df: DataFrame) -> DataFrame:
    """The rows as lines of CSV with every value quoted."""
    quoted = [
        F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
        for c in df.columns
    ]
    return df.select(F.concat_ws(",", *quoted).alias("line"))


def _raw_csv(df: DataFrame, name: str) -> str:
    """A raw file as plain lines of text, with every value quoted: one file, as sources deliver it."""
    path = new_path(df.sparkSession, name)
    _write_lines(_quoted_lines(df), ",".join(df.columns), path)
    return path


def _raw_files(df: DataFrame, name: str) -> str:
    """The same as large files, one for each task that makes rows, each with the header; the first holds nothing else."""
    path, header = new_path(df.sparkSession, name), F.lit(",".join(df.columns))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # within the task's rows
    lines = _quoted_lines(df).select(F.when(place == 0, F.concat_ws("\n", header, "line")).otherwise(F.col("line")).alias("line"))
    df.sparkSession.range(1, numPartitions=1).select(header.alias("line")).unionByName(lines).write.text(path)
    return path


def _raw_parts(df: DataFrame, name: str) -> str:
    """A large raw table as sources deliver it: compressed CSV files of a bounded number of rows, each with the header."""
    path = new_path(df.sparkSession, name)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    options = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "maxRecordsPerFile": 1_000_000}
    text.write.options(header=True, compression="gzip", **options).csv(path)
    return path


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    first = lines.sparkSession.range(1).select(F.lit(header).alias("line"), F.lit(0).alias("place"))
    both = first.unionByName(lines.withColumn("place", F.lit(1))).coalesce(1)
    both.sortWithinPartitions("place").select("line").write.text(path)


def q_bronze_text(spark, sf):
    """Spaces, quotes, commas, line breaks and near misses of tokens come back as they were."""
    mart = Mart(new_path(spark, "mart"))
    path = _raw_csv(X.odd_attributes(spark, sf), "attributes")
    etl.build_bronze(spark, {"attributes": path}, mart, multi_line=True)
    return etl.read_bronze(spark, mart, "attributes")


def q_quarantine(spark, sf):
    """Rows whose date is none, and lines with a field too many, counted."""
    mart = Mart(new_path(spark, "mart"))
    rows = X.raw_attributes(spark, sf)
    day = F.when(F.col("Customer_ID").cast("long") % 20 == 0, "soon").otherwise(F.col(S.SNAPSHOT).cast("string"))
    more = F.when(F.col("Customer_ID").cast("long") % 33 == 0, F.concat(day, F.lit(",more"))).otherwise(day)
    path = new_path(spark, "attributes")
    values = [F.coalesce(c, F.lit("")) for c in S.RAW_COLUMNS["attributes"][:-1]]
    lines = rows.select(F.concat_ws(",", *values, more).alias("line"))
    _write_lines(lines, ",".join(S.RAW_COLUMNS["attributes"]), path)
    etl.build_bronze(spark, {"attributes": path}, mart)
    return snapshots.quarantine_counts(spark.read.parquet(mart.quarantine("attributes")))


def q_bronze_drift(spark, sf):
    """One source file lacks a column and has another; both are read together."""
    mart, rows = Mart(new_path(spark, "mart")), X.raw_attributes(spark, sf)
    even = F.col("Customer_ID").cast("long") % 2 == 0
    first = rows.filter(even).drop("Occupation").withColumn("Note", F.concat(F.lit("n "), "Customer_ID"))
    etl.build_bronze(spark, {"attributes": [_raw_csv(first, "first"), _raw_csv(rows.filter(~even), "second")]}, mart)
    stored = snapshots.read_split(spark, mart.bronze("attributes"), S.RAW_COLUMNS["attributes"])
    return snapshots.extra_column(stored, "Note").drop(snapshots.EXTRA)


def q_dated_files(spark, sf):
    """Bronze from files dated by name; a file without a date is listed with its rows."""
    mart, folder = Mart(new_path(spark, "mart")), new_path(spark, "files")
    rows = X.raw_attributes(spark, sf).withColumn("file", F.date_format(S.SNAPSHOT, "'attributes_'yyyy_MM_dd")).drop(S.SNAPSHOT)
    X.named_csv_files(rows, "file", folder)
    X.named_csv_files(rows.filter("Age like '%_'").withColumn("file", F.lit("notes")), "file", folder)
    etl.build_bronze_from_dated_files(spark, "attributes", folder, mart)
    found = etl.read_bronze(spark, mart, "attributes").groupBy(F.col(S.SNAPSHOT).cast("string").alias("file")).agg(
        F.count("*").alias("rows"), F.max("Name").alias("last_name")
    )
    undated = spark.read.parquet(mart.quarantine("attributes_files"))
    return found.unionByName(undated.select(F.col("file_name").alias("file"), "rows", F.lit(None).cast("string").alias("last_name")))


def q_multiline_loans(spark, sf):
    """Large raw files of loans, each with a remark of several lines, each read by several tasks; counted per snapshot."""
    mart = Mart(new_path(spark, "mart"))
    etl.build_bronze(spark, {"lms": _raw_files(_remarked_loans(spark, sf), "lms")}, mart, multi_line=True)
    stored = snapshots.extra_column(snapshots.read_split(spark, mart.bronze("lms"), S.RAW_COLUMNS["lms"]), "Remark")
    return stored.groupBy(S.SNAPSHOT).agg(
        F.count("*").alias("rows"), F.sum(F.char_length("Remark")).alias("remark_chars"),
        F.max(F.md5(F.concat_ws("|", "loan_id", "installment_num", "Remark"))).alias("last_md5"),
        F.countDistinct("loan_id").alias("loans"),
    )


def _remarked_loans(spark, sf) -> DataFrame:
    """Raw loans with remarks that hold line breaks, quotes and commas."""
    kind = F.col("loan_id").cast("long") % 4
    paid, line = F.lit("paid\n\"late\", "), F.lit("\n")
    remark = (
        F.when(kind == 0, F.concat(paid, "loan_id")).when(kind == 1, F.concat(line, "loan_id", F.lit("\r\n")))
        .when(kind == 2, F.concat(F.lit('size 5" '), "loan_id"))
    )
    return X.raw_loans(spark, sf).withColumn("Remark", remark)


def q_new_files(spark, sf):
    """Bronze from a folder in two runs: the second takes only the files that came since, and a date delivered again."""
    mart, folder = Mart(new_path(spark, "mart")), new_path(spark, "files")
    rows = X.raw_attributes(spark, sf).withColumn("file", F.date_format(S.SNAPSHOT, "'attributes_'yyyy_MM_dd"))
    early = F.col(S.SNAPSHOT) < F.lit(date(1996, 1, 1))
    X.named_csv_files(rows.filter(early).drop(S.SNAPSHOT), "file", folder)
    etl.ingest_new_files(spark, "attributes", folder, mart)
    X.named_csv_files(rows.filter(~early).drop(S.SNAPSHOT), "file", folder)
    again = rows.filter(F.col(S.SNAPSHOT) == F.lit(date(1995, 3, 1))).withColumn("Name", F.concat(F.lit("new "), "Name"))
    X.named_csv_files(again.withColumn("file", F.concat(F.lit("again_"), "file")).drop(S.SNAPSHOT), "file", folder)
    etl.ingest_new_files(spark, "attributes", folder, mart)
    return etl.read_bronze(spark, mart, "attributes")


def q_bronze_tables(spark, sf):
    mart = Mart(new_path(spark, "mart"))
    etl.build_bronze(spark, {"attributes": _raw_csv(X.raw_attributes(spark, sf), "attributes")}, mart)
    return etl.read_bronze(spark, mart, "attributes")


def q_snapshot_rerun(spark, sf):
    """The label store after its first half was written again: the other partitions stay, none doubles."""
    path, rows = new_path(spark, "labels"), labels(spark, sf)
    snapshots.write_snapshots(rows, path)
    snapshots.write_snapshots(rows.filter(F.col(S.SNAPSHOT) < F.lit(SPLIT_DAY)), path)
    return snapshots.read_table(spark, path)


def q_snapshot_scan(spark, sf):
    """One snapshot of a stored table."""
    path = new_path(spark, "labels")
    snapshots.write_snapshots(labels(spark, sf), path)
    return snapshots.at_snapshot(snapshots.read_table(spark, path), date(1998, 6, 1))


def q_feature_rebuild(spark, sf):
    """The feature store written again with fewer dates and one more column pruned: nothing of the first remains."""
    path = new_path(spark, "features")
    rows = materialize(feature_rows(spark, sf), "features")
    snapshots.write_snapshots(rows, path, whole_table=True)
    fewer = rows.filter(F.col(S.SNAPSHOT) < F.lit(SPLIT_DAY)).drop("Occupation")
    snapshots.write_snapshots(fewer, path, whole_table=True)
    return _rounded(snapshots.read_table(spark, path), AVERAGES)


def q_feature_update(spark, sf):
    """A feature store with one snapshot missing and one wrong, brought up to date by the changes alone."""
    missing, wrong = date(1998, 3, 1), date(1998, 6, 1)
    mart, clicks = Mart(new_path(spark, "mart")), X.raw_clicks(spark, sf)
    snapshots.write_snapshots(silver_financials(spark, sf), mart.silver("financials"))
    snapshots.write_snapshots(silver_attributes(spark, sf), mart.silver("attributes"))
    day, odd = F.col(S.SNAPSHOT), F.col(S.ENTITY).cast("long") % 2 == 1
    others = clicks.filter(~day.isin(F.lit(missing), F.lit(wrong)))
    doubled = clicks.filter((day == F.lit(wrong)) & odd).withColumns({c: F.col(c) * 2 for c in S.CLICK_FEATURES})
    strangers = doubled.withColumn(S.ENTITY, F.concat(F.lit("no "), S.ENTITY))
    for rows in (others.unionByName(doubled).unionByName(strangers), clicks.filter(day.isin(F.lit(missing), F.lit(wrong)))):
        snapshots.split_into_snapshots(rows, mart.bronze("clickstream"), S.RAW_COLUMNS["clickstream"], mart.quarantine("clickstream"))
        if snapshots.folder_exists(spark, mart.gold("feature_store")):
            etl.update_features(spark, mart, [missing, wrong])
        else:
            etl.build_features(spark, mart)
    return _rounded(snapshots.read_table(spark, mart.gold("feature_store")), AVERAGES)


def q_etl_features(spark, sf):
    """Raw CSV text through bronze, silver and gold."""
    mart = Mart(new_path(spark, "mart"))
    raw = {
        "lms": _raw_parts(X.raw_loans(spark, sf), "lms"),
        "attributes": _raw_parts(X.raw_attributes(spark, sf), "attributes"),
        "financials": _raw_parts(X.raw_financials(spark, sf), "financials"),
        "clickstream": _raw_parts(X.raw_clicks(spark, sf), "clickstream"),
    }
    etl.run_etl(spark, raw, mart)
    return _rounded(snapshots.read_table(spark, mart.gold("feature_store")), AVERAGES)


def q_prediction_tables(spark, sf):
    path = new_path(spark, "predictions")
    rows = X.predictions(spark, sf)
    snapshots.write_snapshots(rows, path, partition_columns=("model_name", S.SNAPSHOT))
    return snapshots.read_table(spark, path)


# Data set


def q_training_frame(spark, sf):
    return _rounded(dataset.training_frame(labels(spark, sf), feature_rows(spark, sf), WINDOW), AVERAGES)


def q_temporal_split(spark, sf):
    return dataset.temporal_split(labels(spark, sf), WINDOW)


def q_strat_split(spark, sf):
    return label_split(spark, sf)


def q_split_stats(spark, sf):
    return dataset.split_statistics(label_split(spark, sf))


def q_one_hot(spark, sf):
    """Indicators and a flag, from the vector that the model's saved stages make."""
    profiles = materialize(q_fin_attr(spark, sf).withColumn("indebted", F.col("Outstanding_Debt") > 2500), "profiles")
    fitted = dataset.fit_preprocessor(profiles, numeric=[])
    made = fitted.input_columns(profiles)
    return made.select(S.ENTITY, *[F.col(c).cast("int").alias(c) for c in fitted.names])


def q_standardize(spark, sf):
    rows = materialize(feature_rows(spark, sf), "features").na.drop("any")
    fitted = dataset.fit_preprocessor(rows, categorical=[])
    return _rounded(fitted.input_columns(rows).select(S.ENTITY, S.SNAPSHOT, *S.NUMERIC_INPUTS), S.NUMERIC_INPUTS)


def q_fold_stats(spark, sf):
    """Rows per fold and label of the search's folds."""
    return dataset.stratified_folds(labels(spark, sf), 3).groupBy("fold", "label").agg(F.count("*").alias("rows"))


# Model


# One setting, with every parameter in use; checks/oracle.py states it too.
SETTING = {
    "maxIter": 25, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8, "columnShare": 0.6, "minGain": 0.01, "minHessian": 1,
    "l1": 0.1, "l2": 1.5,
}


def _split(spark, sf, features=None) -> DataFrame:
    rows = feature_rows(spark, sf) if features is None else features
    return materialize(training.split_frame(labels(spark, sf), rows, WINDOW), "split-frame")


def q_train_score(spark, sf):
    """A model fitted on the train split, saved and loaded, and its scores of all snapshots."""
    everything = materialize(feature_rows(spark, sf), "features")
    train = _split(spark, sf, everything).filter("split = 'train'")
    path = new_path(spark, "model")
    model.save_model(model.fit(train, dataset.fit_preprocessor(train), **SETTING), path)
    days, name = [r[0] for r in everything.select(S.SNAPSHOT).distinct().collect()], "gbt_credit_model_1999_03_01"
    return _rounded(model.score_snapshots(model.load_model(path), everything, days, name), ["model_predictions"], 6)


def _model_scores(spark, sf) -> DataFrame:
    rows = _split(spark, sf)
    train = rows.filter("split = 'train'")
    return model.with_probability(model.fit(train, dataset.fit_preprocessor(train), **SETTING), rows)


def q_model_scores(spark, sf):
    """The scores themselves: all rows of the three splits by a model of one setting."""
    scored = _model_scores(spark, sf).select("loan_id", S.ENTITY, S.SNAPSHOT, "split", "label", "model_predictions")
    return _rounded(scored, ["model_predictions"], 6)


def q_random_search(spark, sf, **search):
    """The whole search: its mean AUC, AUC and Gini of each split by the best model, and that model's settings."""
    _, record, _ = training.train(labels(spark, sf), feature_rows(spark, sf), WINDOW, **search)
    return record.select("model_name", "model_version", "results", "hp_params")


def q_registry(spark, sf):
    """A registry record, one row for each date, window length, size, rate, result and setting."""
    scored = materialize(_model_scores(spark, sf).select("split", "label", "model_predictions"), "scored")
    area = _rounded(monitor.auc_and_gini(scored, "model_predictions", "label", ["split"]), ["auc"], 8)
    record = model.registry_record(spark, "gbt", WINDOW, dataset.split_statistics(scored), area, SETTING)
    parts = [
        record.select("model_version", F.explode("data_dates").alias("field", "day")),
        record.select("model_version", F.explode(F.map_concat("data_config", "data_stats", "results")).alias("field", "value")),
        record.select("model_version", F.explode("hp_params").alias("field", "setting")),
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


# Monitoring


def q_pred_labels(spark, sf):
    return scored(spark, sf)


def q_monitor_frame(spark, sf):
    return _rounded(
        monitor.monitoring_frame(X.predictions(spark, sf), feature_rows(spark, sf), labels(spark, sf)), AVERAGES
    )


def q_monitor_stored(spark, sf):
    """The same frame from three stored tables that are dealt by its keys and joined without a shuffle."""
    keys, tables = [S.ENTITY, S.SNAPSHOT], {}
    sources = {"predictions": X.predictions(spark, sf), "features": feature_rows(spark, sf), "labels": labels(spark, sf)}
    for name, rows in sources.items():
        path = new_path(spark, name)
        tables[name] = f"{name}_{path[-32:]}"
        snapshots.save_bucketed(rows, tables[name], path, keys, buckets=8)
    stored = [spark.table(tables[n]).hint("merge") for n in sources]
    return _rounded(monitor.monitoring_frame(*stored), AVERAGES)


def q_quantile_sketches(spark, sf):
    """Quartiles of all snapshots from summaries per snapshot, one of which came late, against the exact ranks."""
    rows, path = silver_financials(spark, sf), new_path(spark, "sketches")
    late = F.col(S.SNAPSHOT) == F.lit(date(1995, 5, 1))
    for some in (rows.filter(~late), rows.filter(late)):
        snapshots.write_snapshots(sketches.quantile_sketches(some, S.FINANCIAL_NUMBERS), path)
    stored = snapshots.read_table(spark, path)
    found = materialize(sketches.merged_quantiles(stored, [0.25, 0.5, 0.75]), "merged-quantiles")
    p, error = F.col("probability"), sketches.RANK_ERROR
    near = (F.col("below") <= p + error) & (F.col("upto") >= p - error)
    return sketches.rank_shares(rows, found, S.FINANCIAL_NUMBERS).select("column", "n", "probability", near.alias("near"))


def q_coverage_sketches(spark, sf):
    """Keys of labels and clicks, and how they meet, from summaries per snapshot, against exact counts."""
    keys, sides = [S.ENTITY, S.SNAPSHOT], {"left": labels(spark, sf), "right": X.raw_clicks(spark, sf)}
    stored = []
    for name, rows in sides.items():
        path = new_path(spark, f"keys-{name}")
        snapshots.write_snapshots(sketches.key_sketches(rows, keys), path)
        stored.append(snapshots.read_table(spark, path))
    estimates = sketches.coverage_estimates(*stored)
    both = sides["left"].select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        sides["right"].select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    ).groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counts = both.agg(
        F.sum("l").alias("left_keys"), F.sum("r").alias("right_keys"), F.sum(F.col("l") * F.col("r")).alias("matched_keys"),
        F.sum(F.col("l") * (1 - F.col("r"))).alias("left_only_keys"), F.sum((1 - F.col("l")) * F.col("r")).alias("right_only_keys"),
        F.count("*").alias("all_keys"),
    )
    names = counts.columns
    exact = counts.withColumn("everything", F.col("all_keys")).unpivot("everything", names, "measure", "exact")
    near = F.abs(F.col("keys") - F.col("exact")) <= F.col("everything") * sketches.key_error() + 1
    return estimates.join(exact, "measure").select("measure", "exact", near.alias("near"))


def q_loan_clicks(spark, sf):
    """Each labelled loan with its customer's clicks of the four months up to its snapshot: a join of two tables by span."""
    since = labels(spark, sf).select("loan_id", S.ENTITY, "label", F.add_months(S.SNAPSHOT, -4).alias("since"), F.col(S.SNAPSHOT).alias("upto"))
    clicked = X.raw_clicks(spark, sf).select(S.ENTITY, F.col(S.SNAPSHOT).alias("clicked"), "fe_1")
    return intervals.interval_join(since, clicked, [S.ENTITY], ("since", "upto"), ("clicked", "clicked"), bin_days=92)


def q_auc(spark, sf):
    return _rounded(monitor.auc(scored(spark, sf, None), by=["model_name"]), ["auc"], 8)


def q_auc_by_split(spark, sf):
    rows = label_split(spark, sf).join(
        X.predictions(spark, sf).filter("model_name = 'gbt_a'"), [S.ENTITY, S.SNAPSHOT]
    )
    return _rounded(monitor.auc_and_gini(rows, "model_predictions", "label", ["split"]), ["auc"], 8)


def q_perf_metrics(spark, sf):
    return _rounded(monitor.metrics_table(scored(spark, sf)), ["Value"], 6)


def q_performance_report(spark, sf):
    """The metrics again, from stored predictions and labels."""
    mart = Mart(new_path(spark, "mart"))
    stored = X.predictions(spark, sf)
    snapshots.write_snapshots(stored, mart.gold("model_predictions"), partition_columns=("model_name", S.SNAPSHOT))
    snapshots.write_snapshots(labels(spark, sf), mart.gold("label_store"))
    return _rounded(monitoring.performance_report(spark, mart, "gbt_a"), ["Value"], 6)


def q_concept_drift(spark, sf):
    return _rounded(monitor.concept_drift(scored(spark, sf)), ["prediction_error"], 10)


def q_prediction_error(spark, sf):
    return _rounded(monitor.with_prediction_error(scored(spark, sf, None)), ["prediction_error"], 6)


def _before_and_after():
    return F.col(S.SNAPSHOT) < F.lit(SPLIT_DAY), F.col(S.SNAPSHOT) >= F.lit(SPLIT_DAY)


def q_ks(spark, sf):
    rows = feature_rows(spark, sf)
    return _rounded(monitor.ks_drift(rows, monitoring.WATCHED, *_before_and_after()), ["ks", "p_value"], 6)


def q_ks_snapshots(spark, sf):
    """Two snapshots of the monitoring frame against each other."""
    merged = monitor.monitoring_frame(X.predictions(spark, sf), feature_rows(spark, sf), labels(spark, sf))
    then, now = (F.col(S.SNAPSHOT) == F.lit(d) for d in (date(1998, 11, 1), date(1998, 12, 1)))
    return _rounded(monitor.ks_drift(merged, monitoring.WATCHED, then, now), ["ks", "p_value"], 6)


def q_psi_independent(spark, sf):
    return _rounded(monitor.population_stability(X.predictions(spark, sf), *_before_and_after()), ["psi"], 6)


def q_psi_shared(spark, sf):
    stability = monitor.population_stability(X.predictions(spark, sf), *_before_and_after(), edges="shared")
    return _rounded(stability, ["psi"], 6)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("q_")}
