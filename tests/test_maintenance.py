"""Tables kept up to date by their changes: feature store, new files, sketches, bucketed tables; and the interval join."""

import random
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapmart import schemas as S
from snapmart.operators import features, intervals, monitor, sketches
from snapmart.operators.dataset import months_before
from snapmart.plans import etl
from snapmart.plans.layout import Mart
from snapmart.sources import snapshots

from conftest import rows

MONTHS = [date(2023 + m // 12, m % 12 + 1, 1) for m in range(14)]


def _panel(spark, seed=1):
    rnd = random.Random(seed)
    clicks = [
        (f"c{i}", d, *[rnd.choice([None, float(rnd.randint(-5, 5))]) for _ in S.CLICK_FEATURES])
        for i in range(30) for d in MONTHS for _ in range(rnd.choice([0, 1, 1, 2]))
    ]
    names = ", ".join(f"{c} double" for c in S.CLICK_FEATURES)
    profiles = [(f"c{i}", d, float(i), rnd.choice(["Good", "Bad"])) for i in range(0, 30, 2) for d in MONTHS[: 1 + i % 3]]
    profiles = [(*p[:2], None if p[0] == "c4" else p[2], p[3]) for p in profiles]
    return (
        spark.createDataFrame(clicks, f"Customer_ID string, snapshot_date date, {names}"),
        spark.createDataFrame(profiles, "Customer_ID string, snapshot_date date, Annual_Income double, Credit_Mix string").withColumn(
            "Type_of_Loan", F.lit("x")
        ),
        spark.createDataFrame([(p[0], p[1], "n", 3, "s", "job") for p in profiles],
                              "Customer_ID string, snapshot_date date, Name string, Age int, SSN string, Occupation string"),
    )


@pytest.mark.parametrize("point_in_time", [False, True])
def test_updated_features_equal_a_rebuild(spark, tmp_path, point_in_time):
    clicks, financials, attributes = _panel(spark)
    changed = MONTHS[5]
    day = F.col("snapshot_date")
    # Before: some customers of the day are absent, one is extra, one has other values.
    before = clicks.where((day != F.lit(changed)) | F.col("Customer_ID").isin("c1", "c2")).unionByName(
        clicks.where(day == F.lit(changed)).limit(1).withColumns({"Customer_ID": F.lit("gone"), "fe_1": F.lit(9.0)})
    )
    before = before.withColumn("fe_2", F.when((day == F.lit(changed)) & (F.col("Customer_ID") == "c2"), 99.0).otherwise(F.col("fe_2")))
    build = lambda c: features.feature_store(financials, attributes, c, 50.0, point_in_time)
    path = str(tmp_path / "store")
    snapshots.write_snapshots(build(before), path, whole_table=True)
    store = snapshots.read_table(spark, path)
    made, touched = features.updated_features(store, clicks, financials, attributes, [changed], point_in_time)
    assert touched == MONTHS[5:10]
    # Of the stored features, the partitions of these five snapshots are read.
    plan = made._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and path in line]
    assert scans and all(set(re.findall(r"\d{4}-\d\d-\d\d", line.split("PartitionFilters: ")[1])) == set(map(str, touched)) for line in scans)
    wanted = build(clicks)
    assert made.columns == wanted.columns
    assert rows(made) == rows(wanted.where(day.between(F.lit(touched[0]), F.lit(touched[-1]))))


def test_update_reads_and_writes_the_touched_partitions_only(spark, tmp_path):
    clicks, financials, attributes = _panel(spark, 2)
    mart, day = Mart(str(tmp_path)), F.col("snapshot_date")
    financials = financials.where(F.col("Customer_ID") != "c4")
    snapshots.write_snapshots(financials, mart.silver("financials"))
    snapshots.write_snapshots(attributes, mart.silver("attributes"))
    bronze = lambda some: snapshots.split_into_snapshots(
        some, mart.bronze("clickstream"), S.RAW_COLUMNS["clickstream"], mart.quarantine("clickstream")
    )
    bronze(clicks.where(~day.isin(F.lit(MONTHS[3]))))
    etl.build_features(spark, mart)
    store = Path(mart.gold("feature_store"))
    old = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in store.glob("snapshot_date=*")}
    assert etl.update_features(spark, mart, [MONTHS[13]]) == [MONTHS[13]]
    bronze(clicks.where(day == F.lit(MONTHS[3])))
    assert etl.update_features(spark, mart, [MONTHS[3]]) == MONTHS[3:8]
    new = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in store.glob("snapshot_date=*")}
    touched = {f"snapshot_date={d}" for d in [*MONTHS[3:8], MONTHS[13]]}
    assert {n for n in new if new[n] != old.get(n)} == touched
    whole = rows(snapshots.read_table(spark, str(store)))
    # A snapshot that is taken away goes, and its customers' later windows with it.
    spark_path = Path(mart.bronze("clickstream")) / f"snapshot_date={MONTHS[3]}"
    for f in spark_path.glob("*"):
        f.unlink()
    for f in spark_path.glob(".*"):
        f.unlink()
    spark_path.rmdir()
    etl.update_features(spark, mart, [MONTHS[3]])
    taken = rows(snapshots.read_table(spark, str(store)))
    etl.build_features(spark, mart)
    assert taken == rows(snapshots.read_table(spark, str(store))) != whole
    bronze(clicks.where(day == F.lit(MONTHS[3])))
    etl.update_features(spark, mart, [MONTHS[3]])
    assert rows(snapshots.read_table(spark, str(store))) == whole


def test_touched_snapshots_reach_four_months_ahead():
    days = [date(2024, 1, 31), date(2024, 2, 29), date(2024, 5, 31), date(2024, 6, 1), date(2024, 6, 30)]
    assert features.touched_snapshots([date(2024, 1, 31)], days) == days[:3]
    assert months_before(date(2024, 6, 30), 4) == date(2024, 2, 29)
    assert features.touched_snapshots([date(2024, 2, 29), date(2023, 1, 1)], days) == [date(2023, 1, 1), *days[1:]]


def _deliver(folder, name, values):
    (folder / name).write_text("Customer_ID,Name,Age,SSN,Occupation\n" + "".join(f"{v},n,1,s,o\n" for v in values))


def test_new_files_are_taken_once(spark, tmp_path, monkeypatch):
    mart, folder = Mart(str(tmp_path / "mart")), tmp_path / "in"
    folder.mkdir()
    seen = []
    real = etl.split_into_snapshots

    def noted(raw, *more):
        seen.append(sorted(r.Customer_ID for r in raw.collect()))
        real(raw, *more)

    monkeypatch.setattr(etl, "split_into_snapshots", noted)
    stored = lambda: rows(etl.read_bronze(spark, mart, "attributes"), "Customer_ID", "snapshot_date")
    _deliver(folder, "a_2024_01_01.csv", ["c1", "c2"])
    _deliver(folder, "notes.csv", ["c9"])
    etl.ingest_new_files(spark, "attributes", str(folder), mart)
    first = [("c1", MONTHS[12]), ("c2", MONTHS[12])]
    assert stored() == first
    etl.ingest_new_files(spark, "attributes", str(folder), mart)
    assert len(seen) == 1 and stored() == first
    _deliver(folder, "a_2024_02_01.csv", ["c3"])

    def broken(raw, *more):
        noted(raw, *more)
        raise OSError("lost after writing")

    monkeypatch.setattr(etl, "split_into_snapshots", broken)
    with pytest.raises(Exception, match="lost after writing"):
        etl.ingest_new_files(spark, "attributes", str(folder), mart)
    monkeypatch.setattr(etl, "split_into_snapshots", noted)
    etl.ingest_new_files(spark, "attributes", str(folder), mart)
    assert seen[1:] == [["c3"]] * 2  # the rows of the new file only, twice
    assert stored() == [*first, ("c3", MONTHS[13])]
    undated = spark.read.parquet(mart.quarantine("attributes_files"))
    assert rows(undated, "file_name", "rows") == [("notes.csv", 1)]
    # A date delivered again replaces its rows.
    _deliver(folder, "b_2024_01_01.csv", ["c7"])
    etl.ingest_new_files(spark, "attributes", str(folder), mart)
    assert stored() == [("c3", MONTHS[13]), ("c7", MONTHS[12])]


def test_merged_quantiles_keep_their_rank_error(spark, tmp_path):
    rnd = random.Random(4)
    values = [(MONTHS[i % 14], rnd.lognormvariate(0, 2), float(i % 3), None if i % 5 else float("nan")) for i in range(60_000)]
    df = spark.createDataFrame(values, "snapshot_date date, a double, b double, c double").repartition(12)
    path = str(tmp_path / "sketches")
    for day in MONTHS[::-1]:
        snapshots.write_snapshots(sketches.quantile_sketches(df.where(F.col("snapshot_date") == F.lit(day)), ["a", "b", "c"]), path)
    stored = snapshots.read_table(spark, path)
    found = sketches.merged_quantiles(stored, [0.01, 0.25, 0.5, 0.99])
    shares = sketches.rank_shares(df, found, ["a", "b", "c"]).collect()
    assert {(r.column, r.n) for r in shares} == {("a", 60_000), ("b", 60_000)}
    assert all(r.below <= r.probability + sketches.RANK_ERROR and r.upto >= r.probability - sketches.RANK_ERROR for r in shares)
    # A late partition is merged without the others' rows.
    some = sketches.merged_quantiles(snapshots.at_snapshot(stored, MONTHS[3]), [0.5]).where("column = 'a'").first()
    assert some.n == sum(v[0] == MONTHS[3] for v in values)


def test_coverage_estimates(spark):
    left = spark.createDataFrame([(f"a{i}", MONTHS[i % 3]) for i in range(40_000)] + [(None, MONTHS[0])], "k string, snapshot_date date")
    right = spark.createDataFrame([(f"a{i}", MONTHS[i % 5]) for i in range(30_000, 55_000)] * 2, "k string, snapshot_date date")
    of = lambda df: sketches.key_sketches(df, ["k"], bits=12)
    found = dict(map(tuple, sketches.coverage_estimates(of(left), of(right), 12).collect()))
    exact = {"left_keys": 40_000, "right_keys": 25_000, "matched_keys": 10_000, "left_only_keys": 30_000, "right_only_keys": 15_000, "all_keys": 55_000}
    assert set(found) == set(exact) and found["matched_keys"] != 10_000
    assert all(abs(found[k] - exact[k]) <= sketches.key_error(12) * 55_000 for k in exact)
    few = dict(map(tuple, sketches.coverage_estimates(of(left.limit(50)), of(right.limit(0))).collect()))
    assert (few["left_keys"], few["right_keys"], few["matched_keys"], few["left_only_keys"]) == (50, 0, 0, 50)


def test_stored_tables_are_joined_without_a_shuffle(spark, tmp_path):
    keys = ["Customer_ID", "snapshot_date"]
    days = [(f"c{i % 50}", MONTHS[i % 14], i) for i in range(700)]
    sides = {
        "p": spark.createDataFrame(days, "Customer_ID string, snapshot_date date, model_predictions long"),
        "f": spark.createDataFrame([d[:2] for d in days[::2]], "Customer_ID string, snapshot_date date").distinct().withColumn("x", F.lit(1)),
        "l": spark.createDataFrame(days[::3], "Customer_ID string, snapshot_date date, label long"),
    }
    for name, df in sides.items():
        snapshots.save_bucketed(df, f"stored_{name}", str(tmp_path / name), keys, 4)
    try:
        joined = monitor.monitoring_frame(*[spark.table(f"stored_{n}").hint("merge") for n in sides])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined) == rows(monitor.monitoring_frame(*sides.values()))
    finally:
        for name in sides:
            spark.sql(f"DROP TABLE stored_{name}")


@pytest.mark.parametrize("bin_days", [1, 31, 1000])
def test_interval_join_equals_all_pairs(spark, bin_days):
    rnd = random.Random(bin_days)
    day = lambda: rnd.choice([None, *[date(1969, 12, 1).fromordinal(date(1969, 12, 1).toordinal() + d) for d in range(0, 90)]])
    left = [(rnd.choice(["hot", "a", "b", None]), i, day(), day()) for i in range(150)]
    right = [(rnd.choice(["hot", "hot", "a", "c", None]), i, day(), day()) for i in range(150)] + [("hot", 9, date(1970, 1, 1), date(1970, 1, 1))] * 2
    a = spark.createDataFrame(left, "k string, i int, since date, upto date")
    b = spark.createDataFrame(right, "k string, j int, first date, last date")
    found = intervals.interval_join(a, b, ["k"], ("since", "upto"), ("first", "last"), bin_days)
    wanted = [
        (k, i, s, u, j, f, t) for k, i, s, u in left for k2, j, f, t in right
        if k == k2 and None not in (k, s, u, f, t) and s <= u and f <= t and s <= t and f <= u
    ]
    assert rows(found) == sorted(wanted, key=repr) and found.columns == ["k", "i", "since", "upto", "j", "first", "last"]
    with pytest.raises(ValueError):
        intervals.interval_join(a, a, ["k"], ("since", "upto"), ("since", "upto"))


def test_a_hot_customer_is_spread_over_bins(spark):
    """No key of the join holds more than a bin's rows of the hot customer."""
    days = spark.range(2000).select(F.lit("hot").alias("k"), F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("day"))
    binned = intervals._in_bins(days, "a", ("day", "day"), 31)
    assert binned.groupBy("k", "_bin").count().agg(F.max("count")).first()[0] == 31
