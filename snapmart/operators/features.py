"""Feature store: rolling click averages joined with customer profiles."""

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from snapmart.operators.clean import drop_sparse_columns
from snapmart.operators.dataset import months_before
from snapmart.schemas import CLICK_FEATURES, ENTITY, SNAPSHOT
from snapmart.session import materialize

AVERAGES = [f"{c}_5m_avg" for c in CLICK_FEATURES]


def rolling_month_average(
    clicks: DataFrame, features: list[str] = CLICK_FEATURES, months: int = 5, entity: str = ENTITY
) -> DataFrame:
    """Mean of each feature over the current and ``months - 1`` preceding calendar months, one row per key.

    Missing months are simply absent; every raw row counts alike, also where a key has several. Rows are summed per
    key before they are shuffled, so that the window holds at most one row per date of an entity.
    """
    keyed = clicks.filter(F.col(entity).isNotNull() & F.col(SNAPSHOT).isNotNull())
    values = {c: F.col(c).cast("double") for c in features}
    sums = [F.sum(v).alias(f"{c}_sum") for c, v in values.items()]
    counts = [F.count(v).alias(f"{c}_count") for c, v in values.items()]
    span = (
        f"OVER (PARTITION BY `{entity}` ORDER BY `{SNAPSHOT}` "
        f"RANGE BETWEEN INTERVAL '{months - 1}' MONTH PRECEDING AND CURRENT ROW)"
    )
    means = [
        F.expr(f"try_divide(sum(`{c}_sum`) {span}, sum(`{c}_count`) {span}) AS `{c}_{months}m_avg`") for c in features
    ]
    return keyed.groupBy(entity, SNAPSHOT).agg(*sums, *counts).select(entity, SNAPSHOT, *means)


def customer_profiles(
    financials: DataFrame, attributes: DataFrame, max_null_percent: float = 5.0, keep: list[str] | None = None
) -> DataFrame:
    """Complete financial rows, without sparse columns, joined with the attributes of the same snapshot.

    With ``keep`` the columns to keep are known already, and no nulls are counted.
    """
    if keep is None:
        complete = drop_sparse_columns(financials.drop("Type_of_Loan"), max_null_percent).na.drop("any")
    else:
        complete = financials.select(*[c for c in financials.columns if c in {ENTITY, SNAPSHOT, *keep}]).na.drop("any")
    return complete.join(attributes.drop("Age", "Name", "SSN"), [ENTITY, SNAPSHOT], "inner")


def attach_profiles(profiles: DataFrame, clicks: DataFrame, point_in_time: bool = False) -> DataFrame:
    """Every click row with the profiles of its customer; none leaves nulls.

    By default that is each profile, whatever its date: k profiles and m click dates give k * m rows, some of which
    look ahead. With ``point_in_time`` it is the latest profile up to the click's date, of several with one date the
    last in the order of their values, and the result has the click rows.

    One outer join, so that the clicks' averages are reckoned once. They lie by customer already, and stay so; where they
    are shuffled for it, a hot customer's clicks are split as the join runs.
    """
    if point_in_time:
        return _latest_profiles(profiles, clicks)
    profiles = profiles.drop(SNAPSHOT)
    joined = clicks.join(profiles, [ENTITY], "left")
    return joined.select(*profiles.columns, *[c for c in clicks.columns if c != ENTITY])


def _latest_profiles(profiles: DataFrame, clicks: DataFrame) -> DataFrame:
    """An as-of join as one window over both sides, profiles first on each date."""
    values = [c for c in profiles.columns if c not in {ENTITY, SNAPSHOT}]
    dated = profiles.groupBy(ENTITY, SNAPSHOT).agg(F.max(F.struct(*values)).alias("_profile"))
    own = [c for c in clicks.columns if c not in {ENTITY, SNAPSHOT}]
    both = dated.withColumn("_click", F.lit(None).cast(clicks.select(F.struct(*own)).schema[0].dataType)).unionByName(
        clicks.select(ENTITY, SNAPSHOT, F.struct(*own).alias("_click")), allowMissingColumns=True
    )
    # The default range frame ends with the rows of the same date, profiles and clicks alike.
    so_far = Window.partitionBy(ENTITY).orderBy(SNAPSHOT)
    latest = both.withColumn("_profile", F.last("_profile", ignorenulls=True).over(so_far))
    found = latest.filter(F.col("_click").isNotNull())
    return found.select(
        ENTITY,
        *[F.col(f"_profile.{c}").alias(c) for c in values],
        SNAPSHOT,
        *[F.col(f"_click.{c}").alias(c) for c in own],
    )


def feature_store(
    financials: DataFrame,
    attributes: DataFrame,
    clicks: DataFrame,
    max_null_percent: float = 5.0,
    point_in_time: bool = False,
) -> DataFrame:
    """Profile columns and rolling click averages for every (customer, snapshot) of the clicks."""
    profiles = materialize(customer_profiles(financials, attributes, max_null_percent), "profiles")
    return _in_order(attach_profiles(profiles, rolling_month_average(clicks), point_in_time))


def _in_order(joined: DataFrame) -> DataFrame:
    profile_columns = [c for c in joined.columns if c not in {ENTITY, SNAPSHOT, *AVERAGES}]
    return joined.select(ENTITY, *profile_columns, *AVERAGES, SNAPSHOT)


def touched_snapshots(days: list[date], known: list[date], months: int = 5) -> list[date]:
    """Of the ``known`` snapshots, those whose window of ``months`` reaches back to a changed day, and the days themselves."""
    return sorted({s for s in known for d in days if months_before(s, months - 1) <= d <= s} | set(days))


def updated_features(
    store: DataFrame, clicks: DataFrame, financials: DataFrame, attributes: DataFrame, days: list[date], point_in_time: bool = False
) -> tuple[DataFrame, list[date]]:
    """The feature store's rows of all snapshots that changed ``clicks`` of some days touch, and those snapshots.

    ``clicks`` has the days as they are now, and ``store`` as they were. Customers of a changed day, before or after, are
    reckoned anew over the snapshots whose windows reach back to it; all other rows are taken over. So of the store only
    the touched partitions are read, and of the clicks those in their windows.
    """
    known = [r[0] for r in clicks.select(SNAPSHOT).distinct().collect()]  # one row per snapshot
    touched = touched_snapshots(days, known)
    of = lambda rows, dates: rows.where(F.col(SNAPSHOT).isin([F.lit(d) for d in dates]))
    before = of(store, touched)
    customers = of(before, days).select(ENTITY).unionByName(of(clicks, days).select(ENTITY))
    customers = materialize(customers.where(F.col(ENTITY).isNotNull()).distinct(), "touched-customers")
    seen = clicks.where(F.col(SNAPSHOT).between(F.lit(months_before(min(touched), 4)), F.lit(max(touched))))
    means = of(rolling_month_average(seen.join(customers, ENTITY, "left_semi")), touched)
    kept = [c for c in store.columns if c not in {ENTITY, SNAPSHOT, *AVERAGES}]
    profiles = customer_profiles(financials, attributes, keep=kept).join(customers, ENTITY, "left_semi")
    anew = _in_order(attach_profiles(materialize(profiles, "profiles"), means, point_in_time))
    return anew.unionByName(before.join(customers, ENTITY, "left_anti")), touched
