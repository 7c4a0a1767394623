"""The registered queries in DuckDB's SQL, over the same parquet tables."""

# Column names of the sources, stated here apart from the code under test.
TEXT_NUMBERS = ["Annual_Income", "Num_of_Loan", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Outstanding_Debt",
                "Amount_invested_monthly", "Monthly_Balance"]
NUMBERS = [*TEXT_NUMBERS, "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
           "Delay_from_due_date", "Num_Credit_Inquiries", "Credit_Utilization_Ratio", "Total_EMI_per_month"]
CLICKS = [f"fe_{i}" for i in range(1, 21)]
INPUT_NUMBERS = ["Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
                 "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
                 "Num_Credit_Inquiries", "Credit_Utilization_Ratio", "Credit_History_Age",
                 *[f"fe_{i}_5m_avg" for i in range(1, 21)]]
AVERAGES = [f"{c}_5m_avg" for c in CLICKS]
# Columns of the cleaned financials with at most 5 % nulls.
DENSE = [c for c in NUMBERS if c not in {"Amount_invested_monthly", "Monthly_Balance", "Total_EMI_per_month"}]
DENSE_TEXTS = ["Credit_Mix", "Payment_Behaviour", "Credit_History_Age"]

LMS = """
steps AS (
  SELECT o_orderkey, o_custkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, i,
         (o_totalprice / 10)::REAL::DOUBLE AS part, greatest(0, i - o_orderkey % 13) AS missed
  FROM orders, range(0, 11) AS t(i)),
lms AS (
  SELECT o_orderkey::VARCHAR AS loan_id, o_custkey::VARCHAR AS Customer_ID, month AS loan_start_date,
         10::INTEGER AS tenure, i::INTEGER AS installment_num, o_totalprice::REAL AS loan_amt,
         (CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE part END)::REAL AS due_amt,
         ((i - missed) * part)::REAL AS paid_amt, (missed * part)::REAL AS overdue_amt,
         (o_totalprice - (i - missed) * part)::REAL AS balance,
         CAST(month + to_months(i::INTEGER) AS DATE) AS snapshot_date
  FROM steps)"""

LOANS = LMS + """,
counted AS (
  SELECT *, installment_num AS mob,
         coalesce(ceil(CASE WHEN due_amt = 0 THEN NULL ELSE overdue_amt::DOUBLE / due_amt::DOUBLE END), 0)::INTEGER
           AS installments_missed
  FROM lms),
dated AS (
  SELECT *, CASE WHEN installments_missed > 0
            THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM counted),
loans AS (
  SELECT *, (CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END)::INTEGER
            AS dpd
  FROM dated)"""

LABELS = LOANS + """,
labels_90 AS (
  SELECT loan_id, Customer_ID, (CASE WHEN dpd >= 90 THEN 1 ELSE 0 END)::INTEGER AS label,
         '90dpd_7mob' AS label_def, snapshot_date
  FROM loans WHERE mob = 7)"""

CUSTOMERS = """
people AS (
  SELECT c_custkey AS k, c_name, c_acctbal AS a, c_mktsegment,
         CAST(DATE '1995-01-01' + to_months((c_custkey % 24)::INTEGER) AS DATE) AS snapshot_date
  FROM customer)"""

ATTRIBUTES = CUSTOMERS + """,
raw_attr AS (
  SELECT k::VARCHAR AS Customer_ID, c_name AS Name,
         ((k * 7) % 130 - 10)::VARCHAR || CASE WHEN k % 9 = 0 THEN '_' ELSE '' END AS Age,
         CASE WHEN k % 11 = 0 THEN '#F%$D@*&8' ELSE '123-45-' || lpad((k % 10000)::VARCHAR, 4, '0') END AS SSN,
         CASE WHEN k % 13 = 0 THEN '_______' ELSE c_mktsegment END AS Occupation, snapshot_date
  FROM people),
attr AS (
  SELECT Customer_ID, Name,
         CASE WHEN try_cast(replace(Age, '_', '') AS INTEGER) BETWEEN 0 AND 100
              THEN try_cast(replace(Age, '_', '') AS INTEGER) END AS Age,
         CASE WHEN SSN = '#F%$D@*&8' THEN '000-00-0000' ELSE SSN END AS SSN,
         CASE WHEN Occupation = '_______' THEN 'Unemployed' ELSE Occupation END AS Occupation, snapshot_date
  FROM raw_attr)"""

RAW_FINANCIALS = """
raw_fin AS (
  SELECT k::VARCHAR AS Customer_ID,
    floor(a * CASE WHEN k % 50 = 0 THEN 1000 ELSE 1 END)::BIGINT::VARCHAR
      || CASE WHEN k % 10 = 0 THEN '_' ELSE '' END AS Annual_Income,
    CASE WHEN k % 30 = 0 THEN '_' ELSE (k % 9)::VARCHAR END AS Num_of_Loan,
    (k % 25)::VARCHAR || CASE WHEN k % 7 = 0 THEN '_' ELSE '' END AS Num_of_Delayed_Payment,
    CASE WHEN k % 45 = 0 THEN '_' ELSE (k * 13 % 30)::VARCHAR || '.' || (k % 10)::VARCHAR END
      AS Changed_Credit_Limit,
    (k * 17 % 5000)::VARCHAR || '.' || lpad((k % 100)::VARCHAR, 2, '0')
      || CASE WHEN k % 12 = 0 THEN '_' ELSE '' END AS Outstanding_Debt,
    CASE WHEN k % 14 = 0 THEN '__10000__' ELSE (k % 500)::VARCHAR END AS Amount_invested_monthly,
    CASE WHEN k % 10 = 0 THEN '_' ELSE (k % 700)::VARCHAR END AS Monthly_Balance,
    a / 12 AS Monthly_Inhand_Salary,
    (k % 11 * CASE WHEN k % 60 = 1 THEN 100 ELSE 1 END)::INTEGER AS Num_Bank_Accounts,
    (k % 10 + CASE WHEN k % 75 = 0 THEN 1000 ELSE 0 END)::INTEGER AS Num_Credit_Card,
    (k % 34 + 1 + CASE WHEN k % 64 = 0 THEN 5000 ELSE 0 END)::INTEGER AS Interest_Rate,
    (k % 67 - 5)::INTEGER AS Delay_from_due_date,
    (k % 17)::INTEGER AS Num_Credit_Inquiries,
    20 + (k % 300) / 10 AS Credit_Utilization_Ratio,
    (k % 1800 + CASE WHEN k % 13 = 0 THEN 100000 ELSE 0 END)::DOUBLE AS Total_EMI_per_month,
    CASE k % 3 WHEN 0 THEN 'Auto Loan' WHEN 1 THEN 'Home Loan, Auto Loan' ELSE 'Not Specified' END AS Type_of_Loan,
    CASE k % 4 WHEN 0 THEN 'Good' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Bad' ELSE '_' END AS Credit_Mix,
    CASE WHEN k % 40 = 0 THEN 'NA' WHEN k % 25 = 0 THEN (k % 30)::VARCHAR || ' Years_'
         ELSE (k % 30)::VARCHAR || ' Years and ' || (k % 12)::VARCHAR || ' Months' END AS Credit_History_Age,
    CASE k % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NM' WHEN 3 THEN ' no ' ELSE 'y' END
      AS Payment_of_Min_Amount,
    CASE WHEN k % 17 = 0 THEN '!@9#%8' WHEN k % 2 = 0 THEN 'High_spent' ELSE 'Low_spent' END AS Payment_Behaviour,
    snapshot_date
  FROM people)"""

HISTORY = """CAST(try_cast(regexp_extract(replace(Credit_History_Age, '_', ''), '(\\d+)\\s+Years', 1) AS INTEGER) * 12
    + coalesce(try_cast(regexp_extract(replace(Credit_History_Age, '_', ''), '(\\d+)\\s+Months', 1) AS INTEGER), 0)
    AS INTEGER)"""

TEXT_FIXES = f"""Type_of_Loan, Credit_Mix, {HISTORY} AS Credit_History_Age,
    CASE WHEN lower(trim(Payment_of_Min_Amount)) IN ('yes', 'y') THEN 'Yes'
         WHEN lower(trim(Payment_of_Min_Amount)) IN ('no', 'n') THEN 'No'
         WHEN lower(trim(Payment_of_Min_Amount)) IN ('nm', 'not mentioned', 'na', 'none', '') THEN NULL
         ELSE lower(trim(Payment_of_Min_Amount)) END AS Payment_of_Min_Amount,
    CASE WHEN Payment_Behaviour = '!@9#%8' THEN 'Unknown' ELSE Payment_Behaviour END AS Payment_Behaviour"""


def _number(c: str) -> str:
    return f"try_cast(replace({c}, '_', '') AS REAL) AS {c}" if c in TEXT_NUMBERS else f"{c}::REAL AS {c}"


def _fence(c: str) -> str:
    return (
        f"q1_{c} - 1.5::DOUBLE * (q3_{c} - q1_{c}) AS {c}_low, q3_{c} + 1.5::DOUBLE * (q3_{c} - q1_{c}) AS {c}_high"
    )


FINANCIALS = (
    RAW_FINANCIALS
    + f""",
numbers AS (SELECT Customer_ID, snapshot_date, {', '.join(map(_number, NUMBERS))}, {TEXT_FIXES} FROM raw_fin),
quartiles AS (
  SELECT snapshot_date, {', '.join(
      f'quantile_disc({c}, 0.25)::DOUBLE AS q1_{c}, quantile_disc({c}, 0.75)::DOUBLE AS q3_{c}' for c in NUMBERS)}
  FROM numbers GROUP BY snapshot_date),
fences AS (SELECT snapshot_date, {', '.join(map(_fence, NUMBERS))} FROM quartiles),
fin AS (
  SELECT Customer_ID, {', '.join(
      f'CASE WHEN {c}::DOUBLE BETWEEN {c}_low AND {c}_high THEN {c} END AS {c}' for c in NUMBERS)},
    Type_of_Loan, Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour, snapshot_date, Credit_History_Age
  FROM numbers JOIN fences USING (snapshot_date))"""
)

_KEPT = [*DENSE, *DENSE_TEXTS]
PROFILES = (
    ATTRIBUTES
    + ","
    + FINANCIALS
    + f""",
complete AS (
  SELECT Customer_ID, snapshot_date, {', '.join(_KEPT)} FROM fin
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _KEPT)}),
profiles AS (
  SELECT Customer_ID, snapshot_date, {', '.join(_KEPT)}, Occupation
  FROM complete JOIN attr USING (Customer_ID, snapshot_date))"""
)

CLICKSTREAM = """
click_months AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderkey FROM orders),
clicks AS (
  SELECT o_custkey::VARCHAR AS Customer_ID, month AS snapshot_date, """ + ",\n    ".join(
    f"CASE WHEN (o_custkey + month(month) + {i}) % 41 = 0 THEN NULL"
    f" ELSE sum(o_orderkey * {i} % 97 - 40)::DOUBLE END AS {c}"
    for i, c in enumerate(CLICKS, 1)
) + """
  FROM click_months GROUP BY o_custkey, month)"""

# The rolling mean as a range self-join.
ROLLING = (
    CLICKSTREAM
    + f""",
rolling AS (
  SELECT c.Customer_ID, c.snapshot_date, {', '.join(f'avg(p.{c}) AS {c}_5m_avg' for c in CLICKS)}
  FROM clicks c JOIN clicks p ON c.Customer_ID = p.Customer_ID
   AND p.snapshot_date >= CAST(c.snapshot_date - to_months(4) AS DATE) AND p.snapshot_date <= c.snapshot_date
  GROUP BY c.Customer_ID, c.snapshot_date)"""
)

FEATURES = (
    PROFILES
    + ","
    + ROLLING
    + f""",
features AS (
  SELECT r.Customer_ID, {', '.join(f'p.{c}' for c in [*_KEPT, 'Occupation'])}, {', '.join(AVERAGES)}, r.snapshot_date
  FROM rolling r LEFT JOIN profiles p USING (Customer_ID))"""
)

PREDICTIONS = """
score_keys AS (
  SELECT o_custkey::VARCHAR AS Customer_ID,
         CAST(date_trunc('month', o_orderdate) + to_months(7) AS DATE) AS snapshot_date, sum(o_orderkey)::BIGINT AS s
  FROM orders GROUP BY 1, 2),
predictions AS (
  SELECT Customer_ID, snapshot_date, 'gbt_a' AS model_name, round((s * 37 % 1000) / 1000, 3) AS model_predictions
  FROM score_keys
  UNION ALL
  SELECT Customer_ID, snapshot_date, 'gbt_b', round((s * 91 % 777) / 777, 3) FROM score_keys)"""

SCORED = LABELS + "," + PREDICTIONS + """,
scored AS (SELECT * FROM predictions JOIN labels_90 USING (Customer_ID, snapshot_date))"""

_ALL_FEATURES = [*_KEPT, "Occupation", *AVERAGES]
FRAME = (
    LABELS
    + ","
    + FEATURES
    + f""",
frame AS (
  SELECT l.loan_id, l.Customer_ID, l.label, l.label_def, {', '.join(_ALL_FEATURES)}, l.snapshot_date
  FROM labels_90 l JOIN features f USING (Customer_ID, snapshot_date)
  WHERE l.snapshot_date BETWEEN DATE '1998-01-01' AND DATE '1999-02-28'
    AND {' AND '.join(f'{c} IS NOT NULL' for c in _ALL_FEATURES)})"""
)

# Share of each label in the train side by largest remainder; rows of a label in md5 order.
SPLIT = """
sizes AS (SELECT label, count(*) AS n FROM {rows} GROUP BY label),
shares AS (
  SELECT label, (SELECT sum(n) - ceil(sum(n) * 0.19999999999999996::DOUBLE) FROM sizes)::BIGINT AS wanted,
         n / (SELECT sum(n) FROM sizes) * (SELECT sum(n) - ceil(sum(n) * 0.19999999999999996::DOUBLE) FROM sizes)
           AS share
  FROM sizes),
quotas AS (
  SELECT label, floor(share)::BIGINT + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
           <= wanted - (SELECT sum(floor(share)) FROM shares) THEN 1 ELSE 0 END AS quota
  FROM shares),
split_rows AS (
  SELECT r.*, CASE WHEN row_number() OVER (PARTITION BY label
      ORDER BY md5(loan_id || '|' || Customer_ID || '|' || snapshot_date::VARCHAR || '|88')) <= quota
    THEN 'train' ELSE 'test' END AS split
  FROM {rows} r JOIN quotas USING (label))"""

LABEL_SPLIT = LABELS + "," + SPLIT.format(rows="labels_90")


def _rounded(c: str, digits: int = 4) -> str:
    """Rounded, with negative zero made zero as Spark has it."""
    return f"CASE WHEN round({c}, {digits}) = 0 THEN 0 ELSE round({c}, {digits}) END"


def _averages(digits: int = 4) -> str:
    return ", ".join(f"{_rounded(c, digits)} AS {c}" for c in AVERAGES)


def _auc(rows: str, by: str) -> str:
    """AUC from mid-ranks of the positive rows."""
    return f"""
ranked AS (
  SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY model_predictions)
    + (count(*) OVER (PARTITION BY {by}, model_predictions) - 1) / 2 AS mid FROM {rows}),
areas AS (
  SELECT {by}, (sum(mid) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2)
    / (sum(label) * (count(*) - sum(label))) AS auc FROM ranked GROUP BY {by})"""


DRIFT_DAY = "DATE '1998-04-01'"


def _ks(rows: str, features: list[str], base: str = f"snapshot_date < {DRIFT_DAY}", where: str = "true") -> str:
    """The limit law in its other form, a theta series in 1 / t."""
    terms = "list_sum(list_transform(range(1, 200), lambda k: exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * t * t))))"
    return f"""
side AS (SELECT {base} AS base, {', '.join(f'{c}::DOUBLE AS {c}' for c in features)} FROM {rows} WHERE {where}),
long AS (UNPIVOT side ON {', '.join(features)} INTO NAME feature VALUE value),
steps_ks AS (
  SELECT feature, count(*) FILTER (base) OVER (PARTITION BY feature ORDER BY value)
      / count(*) FILTER (base) OVER (PARTITION BY feature)
    - count(*) FILTER (NOT base) OVER (PARTITION BY feature ORDER BY value)
      / count(*) FILTER (NOT base) OVER (PARTITION BY feature) AS gap FROM long),
ks AS (SELECT feature, max(abs(gap)) AS ks FROM steps_ks GROUP BY feature),
n AS (SELECT feature, count(*) FILTER (base) AS n, count(*) FILTER (NOT base) AS m FROM long GROUP BY feature),
sized AS (SELECT *, round(n * m / (n + m)) AS size FROM ks JOIN n USING (feature)),
scaled AS (SELECT *, ks * sqrt(size) + 1 / (6 * sqrt(size)) + (ks * sqrt(size) - 1) / (4 * size) AS t FROM sized),
tested AS (
  SELECT feature, ks, n AS n_baseline, m AS n_current,
         CASE WHEN t <= 0 THEN 1.0 ELSE greatest(0.0, least(1.0, 1 - sqrt(2 * pi()) / t * {terms})) END::DOUBLE AS p_value
  FROM scaled)
SELECT f.feature, CASE WHEN n > 0 AND m > 0 THEN round(ks, 6) END AS ks, coalesce(n, 0) AS n_baseline,
  coalesce(m, 0) AS n_current, CASE WHEN n > 0 AND m > 0 THEN round(p_value, 6) END AS p_value,
  CASE WHEN n > 0 AND m > 0 THEN p_value < 0.05 END AS drifted
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in features)}]) AS feature) f
LEFT JOIN tested USING (feature) LEFT JOIN n USING (feature)"""


def _psi(rows: str, shared: bool) -> str:
    low, high = (
        ("(SELECT min(p) FROM psi_rows WHERE base)", "(SELECT max(p) FROM psi_rows WHERE base)")
        if shared
        else ("min(p) OVER (PARTITION BY base)", "max(p) OVER (PARTITION BY base)")
    )
    return f"""
psi_rows AS (SELECT snapshot_date < {DRIFT_DAY} AS base, model_predictions AS p FROM {rows}),
limits AS (SELECT base, p, {low} AS lo, {high} AS hi FROM psi_rows),
guessed AS (
  SELECT base, greatest(least(p, hi), lo) AS p, lo, hi, (hi - lo) / 10 AS step,
         least(9, floor((greatest(least(p, hi), lo) - lo) / (hi - lo) * 10))::INTEGER AS g FROM limits),
binned AS (
  SELECT base, g - (p < lo + g * step)::INTEGER + (g < 9 AND p >= lo + (g + 1) * step)::INTEGER AS bin FROM guessed),
shares_psi AS (
  SELECT bin, count(*) FILTER (base) / (SELECT count(*) FROM binned WHERE base) AS e,
         count(*) FILTER (NOT base) / (SELECT count(*) FROM binned WHERE NOT base) AS a FROM binned GROUP BY bin)
SELECT (SELECT count(*) FROM binned WHERE base) AS n_baseline,
       (SELECT count(*) FROM binned WHERE NOT base) AS n_current,
       round(sum(CASE WHEN e > 0 AND a > 0 THEN (e - a) * ln(e / a) ELSE 0 END), 6) AS psi
FROM shares_psi"""


_ONE_HOT = {
    "Credit_Mix": ["Bad", "Good", "Standard"],
    "Payment_Behaviour": ["High_spent", "Low_spent", "Unknown"],
    "Occupation": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unemployed"],
}
_COMPLETE_FEATURES = FEATURES + f""",
complete_features AS (SELECT * FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _ALL_FEATURES)})"""

_NULL_COLUMNS = ["Customer_ID", *NUMBERS, "Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount",
                 "Payment_Behaviour", "snapshot_date", "Credit_History_Age"]


def _null_profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,"
        f" round(count(*) FILTER ({c} IS NULL) / count(*) * 100, 4) AS null_percent FROM fin"
        for c in _NULL_COLUMNS
    )


def _standardized() -> str:
    return ", ".join(
        _rounded(
            f"(({c})::DOUBLE - avg({c}::DOUBLE) OVER ())"
            f" / CASE WHEN stddev_pop({c}::DOUBLE) OVER () = 0 THEN 1 ELSE stddev_pop({c}::DOUBLE) OVER () END"
        )
        + f" AS {c}"
        for c in INPUT_NUMBERS
    )


_FEATURE_COLUMNS = f"Customer_ID, {', '.join([*_KEPT, 'Occupation'])}, {_averages()}, snapshot_date"
_LOAN_SELECT = "SELECT * FROM loans"


_METRICS = "WITH " + SCORED + "," + _auc("scored", "model_name") + """,
marked AS (
  SELECT label, model_predictions AS p, model_predictions >= 0.5 AS yes FROM scored WHERE model_name = 'gbt_a'),
c AS (SELECT count(*) FILTER (yes AND label = 1) AS tp, count(*) FILTER (yes AND label = 0) AS fp,
     count(*) FILTER (NOT yes AND label = 1) AS fn, avg((p - label) * (p - label)) AS brier,
     avg(p) AS mean, avg(yes::INTEGER) AS rate FROM marked)
SELECT 'AUC' AS Metric, round(auc, 6) AS Value FROM areas WHERE model_name = 'gbt_a'
UNION ALL SELECT 'F1', round(2 * tp / (2 * tp + fp + fn), 6) FROM c
UNION ALL SELECT 'Precision', round(tp / (tp + fp), 6) FROM c
UNION ALL SELECT 'Recall', round(tp / (tp + fn), 6) FROM c
UNION ALL SELECT 'Brier', round(brier, 6) FROM c
UNION ALL SELECT 'Pred_Mean', round(mean, 6) FROM c
UNION ALL SELECT 'Positive_Rate', round(rate, 6) FROM c"""


WATCHED = ["Annual_Income", "Num_of_Loan", "Credit_History_Age", "fe_1_5m_avg", "fe_2_5m_avg", "fe_3_5m_avg"]

PIT = PROFILES + "," + ROLLING + f""",
features AS (
  SELECT r.Customer_ID, {', '.join(f'p.{c}' for c in [*_KEPT, 'Occupation'])}, {', '.join(AVERAGES)}, r.snapshot_date
  FROM rolling r ASOF LEFT JOIN profiles p ON r.Customer_ID = p.Customer_ID AND r.snapshot_date >= p.snapshot_date)"""


def _parted(name: str, sizes: str, share: str) -> str:
    """Rows per label that go to the first side of a split, by largest remainder, and those that are left."""
    return f"""
{name}_shares AS (
  SELECT label, n, (SELECT sum(n) - ceil(sum(n) * (1 - {share}) - 1e-9) FROM {sizes})::BIGINT AS wanted,
         n / (SELECT sum(n) FROM {sizes}) * (SELECT sum(n) - ceil(sum(n) * (1 - {share}) - 1e-9) FROM {sizes}) AS share
  FROM {sizes}),
{name} AS (
  SELECT label, floor(share)::BIGINT + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
           <= wanted - (SELECT sum(floor(share)) FROM {name}_shares) THEN 1 ELSE 0 END AS taken, n
  FROM {name}_shares),
{name}_rest AS (SELECT label, n - taken AS n FROM {name})"""


_FOLDS = LABELS + """,
all_sizes AS (SELECT label, count(*) AS n FROM labels_90 GROUP BY label),""" + _parted("f0", "all_sizes", "1 / 3::DOUBLE") + "," + _parted(
    "f1", "f0_rest", "0.5::DOUBLE"
)

_IN_TIME = FRAME + """,
in_time AS (SELECT * FROM frame WHERE snapshot_date < DATE '1999-01-01'),""" + SPLIT.format(rows="in_time") + """,
sides AS (
  SELECT split, label FROM split_rows
  UNION ALL SELECT 'oot', label FROM frame WHERE snapshot_date >= DATE '1999-01-01'),
side_stats AS (SELECT split, count(*)::DOUBLE AS n, round(avg(label), 2) AS rate FROM sides GROUP BY split)"""

# The setting of the registered models; rounds, depth, step and shares as in checks/queries.py.
ROUNDS, DEPTH, STEP, ROW_SHARE, COLUMN_SHARE, LEAST_GAIN, LEAST_HESSIAN, L1, L2 = 25, 3, 0.1, 0.8, 0.6, 0.01, 1, 0.1, 1.5
_MODEL_COLUMNS = ", ".join([*INPUT_NUMBERS, "Credit_Mix", "Payment_Behaviour", "Occupation"])


def _boosted(samples: str) -> str:
    """Boosting in SQL: CTEs after a ``samples`` CTE, the last of which, ``chances``, has ``id`` and ``model_predictions``.

    Samples have id, train, label, draw and the inputs. A step of the recursion is one level of one tree: the rows of a level
    are summed up by node, feature and bin, the best cut of each node is taken, and the rows move on; after the last level the
    weight of its leaf is added to each row. Nodes are numbered 1, then 2n and 2n + 1. Sums are in units of 2^-30.
    """
    from snapmart.operators.boosting import row_factors

    factors = ", ".join("({}, {}::BIGINT, {}::BIGINT)".format(t, *row_factors(88, t)) for t in range(ROUNDS))
    unit, steps = "1073741824::DOUBLE", ROUNDS * (DEPTH + 1)

    def pulled(g: str) -> str:
        return f"(sign({g} / {unit}) * greatest(abs({g} / {unit}) - {L1}::DOUBLE, 0))"

    def score(g: str, h: str) -> str:
        return f"{pulled(g)} * {pulled(g)} / ({h} / {unit} + {L2}::DOUBLE)"

    texts = " UNION ALL ".join(
        f"SELECT id, train, {i} AS place, nullif({c}, '_') AS level FROM samples"
        for i, c in enumerate(["Credit_Mix", "Payment_Behaviour", "Occupation"])
    )
    numbers = " UNION ALL ".join(f"SELECT id, train, {j} AS j, {c}::DOUBLE AS x FROM samples" for j, c in enumerate(INPUT_NUMBERS))
    return f"""
{samples},
texts AS ({texts}),
known_levels AS (
  SELECT place, level, {len(INPUT_NUMBERS)} - 1 + row_number() OVER (ORDER BY place, level) AS j
  FROM (SELECT DISTINCT place, level FROM texts WHERE train AND level IS NOT NULL)),
long_values AS (
  {numbers}
  UNION ALL SELECT id, train, j, (t.level IS NOT DISTINCT FROM k.level)::INTEGER::DOUBLE FROM texts t JOIN known_levels k USING (place)),
cut_lists AS (
  SELECT j, list_distinct(list_transform(range(1, 64), lambda i: list_sort(list(x))[ceil(i / 64::DOUBLE * count(*))::BIGINT])) AS cuts
  FROM long_values WHERE train GROUP BY j),
bins AS (
  SELECT id, j, len(list_filter(cuts, lambda c: c < x)) AS bin FROM long_values JOIN cut_lists USING (j)),
features_in AS (SELECT count(*) AS n FROM cut_lists),
allowed AS (
  SELECT t, j FROM (
    SELECT t, j, row_number() OVER (PARTITION BY t ORDER BY md5('88|' || t || '|' || j)) AS place FROM cut_lists, range({ROUNDS}) AS r(t)), features_in
  WHERE place <= greatest(1, floor({COLUMN_SHARE}::DOUBLE * n + 1e-9::DOUBLE))),
factors(t, a, b) AS (VALUES {factors}),
base AS (SELECT ln(share / (1 - share)) AS margin FROM (SELECT greatest(least(avg(label), 1 - 1e-6::DOUBLE), 1e-6::DOUBLE) AS share FROM samples WHERE train)),
states AS (
  SELECT 0 AS step, id, base.margin, 1::BIGINT AS node FROM samples, base
  UNION ALL
  SELECT * FROM (
    WITH here AS (
      SELECT *, step // {DEPTH + 1} AS t, step % {DEPTH + 1} AS level, 1 / (1 + exp(-margin)) AS p FROM states WHERE step < {steps}),
    grads AS (
      SELECT id, node, t, level, round_even((p - label) * {unit}, 0)::BIGINT AS g, round_even(p * (1 - p) * {unit}, 0)::BIGINT AS h
      FROM here JOIN samples USING (id) JOIN factors USING (t)
      WHERE train AND (draw * a + b) % 2147483647 < {ROW_SHARE}::DOUBLE * 2147483647),
    totals AS (SELECT node, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM grads GROUP BY node),
    cells AS (
      SELECT node, j, bin, sum(g) AS g, sum(h) AS h FROM grads JOIN allowed USING (t) JOIN bins USING (id, j)
      WHERE level < {DEPTH} AND node >= 1 << level GROUP BY node, j, bin),
    sides AS (
      SELECT node, j, bin, sum(g) OVER upto AS lg, sum(h) OVER upto AS lh FROM cells
      WINDOW upto AS (PARTITION BY node, j ORDER BY bin ROWS UNBOUNDED PRECEDING)),
    gains AS (
      SELECT node, j, bin, {score('lg', 'lh')} + {score('(g - lg)', '(h - lh)')} - {score('g', 'h')} AS gain
      FROM sides JOIN totals USING (node)
      WHERE lh >= {LEAST_HESSIAN} * {unit} AND h - lh >= {LEAST_HESSIAN} * {unit} AND lh > 0 AND h - lh > 0),
    best AS (
      SELECT node, j, bin AS cut FROM gains QUALIFY gain > {LEAST_GAIN}::DOUBLE AND row_number() OVER (PARTITION BY node ORDER BY gain DESC, j, bin) = 1),
    weights AS (
      SELECT node, -{pulled('g')} / (h / {unit} + {L2}::DOUBLE) * {STEP}::DOUBLE AS weight FROM totals)
    SELECT step + 1, h.id, CASE WHEN level = {DEPTH} THEN margin + coalesce(weight, 0) ELSE margin END,
      CASE WHEN level = {DEPTH} THEN 1 WHEN best.j IS NULL THEN h.node ELSE 2 * h.node + (bin > cut)::BIGINT END
    FROM here h LEFT JOIN weights USING (node) LEFT JOIN best USING (node) LEFT JOIN bins ON bins.id = h.id AND bins.j = best.j)),
chances AS (SELECT id, 1 / (1 + exp(-margin)) AS model_predictions FROM states WHERE step = {steps})"""


_DRAW = "('0x' || substr(md5(concat_ws('|', loan_id, Customer_ID, snapshot_date)), 1, 8))::BIGINT % 2147483647"
_SPLIT_FRAME = FRAME + """,
in_time AS (SELECT * FROM frame WHERE snapshot_date < DATE '1999-01-01'),""" + SPLIT.format(rows="in_time") + f""",
split_frame AS (
  SELECT split, loan_id, Customer_ID, snapshot_date, label, {_MODEL_COLUMNS} FROM split_rows
  UNION ALL SELECT 'oot', loan_id, Customer_ID, snapshot_date, label, {_MODEL_COLUMNS} FROM frame WHERE snapshot_date >= DATE '1999-01-01')"""
_SPLIT_SAMPLES = f"""
samples AS (SELECT row_number() OVER () AS id, split = 'train' AS train, {_DRAW} AS draw, * FROM split_frame)"""
# Every row of the feature store, scored by the model of the train split.
_ALL_SAMPLES = f"""
samples AS (
  SELECT row_number() OVER () AS id, * FROM (
    SELECT true AS train, {_DRAW} AS draw, Customer_ID, snapshot_date, label, {_MODEL_COLUMNS} FROM split_frame WHERE split = 'train'
    UNION ALL SELECT false, NULL, Customer_ID, snapshot_date, NULL, {_MODEL_COLUMNS} FROM features
    WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _ALL_FEATURES)}))"""

ODD = ATTRIBUTES + """,
odd AS (
  SELECT Customer_ID, CASE Customer_ID::BIGINT % 6 WHEN 0 THEN ' ' || Name WHEN 1 THEN Name || '  '
      WHEN 2 THEN 'say "hi", ' || Name WHEN 3 THEN Name || chr(10) || Name WHEN 4 THEN '\\n' || Name || '\\'
      ELSE Name END AS Name, Age, SSN,
    CASE WHEN Customer_ID::BIGINT % 4 = 0 THEN '_ ' ELSE Occupation END AS Occupation, snapshot_date
  FROM raw_attr)"""


def oracle_sql() -> dict[str, str]:
    w = "WITH "
    return {
        "q_bronze_text": w + ODD + " SELECT * FROM odd",
        "q_multiline_loans": w + LMS + """,
remarked AS (
  SELECT *, CASE loan_id::BIGINT % 4 WHEN 0 THEN 'paid' || chr(10) || '"late", ' || loan_id
    WHEN 1 THEN chr(10) || loan_id || chr(13) || chr(10) WHEN 2 THEN 'size 5" ' || loan_id END AS remark FROM lms)
SELECT snapshot_date, count(*) AS rows, sum(length(remark))::BIGINT AS remark_chars,
  max(md5(concat_ws('|', loan_id, installment_num, remark))) AS last_md5, count(DISTINCT loan_id) AS loans
FROM remarked GROUP BY snapshot_date""",
        "q_new_files": w + ATTRIBUTES + """
SELECT Customer_ID, CASE WHEN snapshot_date = DATE '1995-03-01' THEN 'new ' ELSE '' END || Name AS Name, Age, SSN, Occupation, snapshot_date
FROM raw_attr""",
        "q_feature_update": w + FEATURES + f" SELECT {_FEATURE_COLUMNS} FROM features",
        "q_monitor_stored": w + SCORED + "," + FEATURES + f"""
SELECT p.Customer_ID, snapshot_date, model_name, model_predictions, label, {', '.join([*_KEPT, 'Occupation'])},
       {_averages()}
FROM predictions p JOIN features USING (Customer_ID, snapshot_date)
JOIN labels_90 USING (Customer_ID, snapshot_date)""",
        "q_quantile_sketches": w + CUSTOMERS + "," + FINANCIALS + f""",
long_fin AS (UNPIVOT (SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in NUMBERS)} FROM fin) ON {', '.join(NUMBERS)} INTO NAME col VALUE x)
SELECT col AS "column", count(*) AS n, p AS probability, true AS near
FROM long_fin, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) AS t(p) GROUP BY col, p""",
        "q_coverage_sketches": w + LABELS + "," + CLICKSTREAM + """,
l AS (SELECT DISTINCT Customer_ID, snapshot_date FROM labels_90),
r AS (SELECT DISTINCT Customer_ID, snapshot_date FROM clicks)
SELECT measure, exact, true AS near FROM (
  SELECT 'left_keys' AS measure, count(*) AS exact FROM l UNION ALL SELECT 'right_keys', count(*) FROM r
  UNION ALL SELECT 'matched_keys', count(*) FROM l JOIN r USING (Customer_ID, snapshot_date)
  UNION ALL SELECT 'left_only_keys', count(*) FROM l ANTI JOIN r USING (Customer_ID, snapshot_date)
  UNION ALL SELECT 'right_only_keys', count(*) FROM r ANTI JOIN l USING (Customer_ID, snapshot_date)
  UNION ALL SELECT 'all_keys', count(*) FROM (SELECT * FROM l UNION SELECT * FROM r))""",
        "q_loan_clicks": w + LABELS + "," + CLICKSTREAM + """
SELECT Customer_ID, loan_id, label, CAST(l.snapshot_date - to_months(4) AS DATE) AS since, l.snapshot_date AS upto,
  c.snapshot_date AS clicked, fe_1
FROM labels_90 l JOIN clicks c USING (Customer_ID)
WHERE c.snapshot_date BETWEEN CAST(l.snapshot_date - to_months(4) AS DATE) AND l.snapshot_date""",
        "q_quarantine": w + ATTRIBUTES + """
SELECT CASE WHEN Customer_ID::BIGINT % 33 = 0 THEN 'fields' ELSE 'date' END AS reason,
  CASE WHEN Customer_ID::BIGINT % 20 = 0 THEN 'soon' ELSE snapshot_date::VARCHAR END AS snapshot_date, count(*) AS rows
FROM raw_attr WHERE Customer_ID::BIGINT % 33 = 0 OR Customer_ID::BIGINT % 20 = 0 GROUP BY 1, 2""",
        "q_bronze_drift": w + ATTRIBUTES + """
SELECT Customer_ID, Name, Age, SSN, CASE WHEN Customer_ID::BIGINT % 2 = 1 THEN Occupation END AS Occupation, snapshot_date,
  CASE WHEN Customer_ID::BIGINT % 2 = 0 THEN 'n ' || Customer_ID END AS Note FROM raw_attr""",
        "q_dated_files": w + ATTRIBUTES + """
SELECT snapshot_date::VARCHAR AS file, count(*) AS rows, max(Name) AS last_name FROM raw_attr GROUP BY 1
UNION ALL SELECT 'notes.csv', count(*), NULL FROM raw_attr WHERE Age LIKE '%_'""",
        "q_snapshot_scan": w + LABELS + " SELECT * FROM labels_90 WHERE snapshot_date = DATE '1998-06-01'",
        "q_feature_rebuild": w + FEATURES
        + f" SELECT Customer_ID, {', '.join(_KEPT)}, {_averages()}, snapshot_date FROM features"
        f" WHERE snapshot_date < {DRIFT_DAY}",
        "q_feature_store_pit": w + PIT + f" SELECT {_FEATURE_COLUMNS} FROM features",
        "q_fold_stats": w + _FOLDS + """
SELECT 0 AS fold, label, taken::BIGINT AS rows FROM f0 WHERE taken > 0
UNION ALL SELECT 1, label, taken::BIGINT FROM f1 WHERE taken > 0
UNION ALL SELECT 2, label, n::BIGINT FROM f1_rest WHERE n > 0""",
        "q_train_score": "WITH RECURSIVE " + _SPLIT_FRAME + "," + _boosted(_ALL_SAMPLES) + """
SELECT Customer_ID, snapshot_date, 'gbt_credit_model_1999_03_01' AS model_name, round(model_predictions, 6) AS model_predictions
FROM samples JOIN chances USING (id) WHERE NOT train""",
        "q_model_scores": "WITH RECURSIVE " + _SPLIT_FRAME + "," + _boosted(_SPLIT_SAMPLES) + """
SELECT loan_id, Customer_ID, snapshot_date, split, label, round(model_predictions, 6) AS model_predictions
FROM samples JOIN chances USING (id)""",
        "q_registry": "WITH RECURSIVE " + _SPLIT_FRAME + "," + _boosted(_SPLIT_SAMPLES) + """,
model_scores AS (SELECT split, label, model_predictions FROM samples JOIN chances USING (id)),""" + _auc("model_scores", "split") + f""",
side_stats AS (SELECT split, count(*)::DOUBLE AS n, round(avg(label), 2) AS rate FROM model_scores GROUP BY split),
entries(field, day, value, setting) AS (
  VALUES ('model_train_date', DATE '1999-03-01', NULL::DOUBLE, NULL), ('oot_start_date', DATE '1999-01-01', NULL, NULL),
    ('oot_end_date', DATE '1999-02-28', NULL, NULL), ('train_test_start_date', DATE '1998-01-01', NULL, NULL),
    ('train_test_end_date', DATE '1998-12-31', NULL, NULL), ('train_test_period_months', NULL, 12, NULL),
    ('oot_period_months', NULL, 2, NULL), ('train_test_ratio', NULL, 0.8, NULL),
    ('maxIter', NULL, NULL, '{ROUNDS}'), ('maxDepth', NULL, NULL, '{DEPTH}'), ('stepSize', NULL, NULL, '{STEP}'),
    ('subsamplingRate', NULL, NULL, '{ROW_SHARE}'), ('columnShare', NULL, NULL, '{COLUMN_SHARE}'),
    ('minGain', NULL, NULL, '{LEAST_GAIN}'), ('minHessian', NULL, NULL, '{LEAST_HESSIAN}'), ('l1', NULL, NULL, '{L1}'),
    ('l2', NULL, NULL, '{L2}')
  UNION ALL SELECT 'rows_' || split, NULL, n, NULL FROM side_stats
  UNION ALL SELECT 'positive_rate_' || split, NULL, rate, NULL FROM side_stats
  UNION ALL SELECT 'auc_' || split, NULL, round(auc, 8), NULL FROM areas
  UNION ALL SELECT 'gini_' || split, NULL, round(2 * auc - 1, 3), NULL FROM areas)
SELECT 'credit_model_1999_03_01' AS model_version, * FROM entries""",
        "q_iqr_approx": w + CUSTOMERS + "," + FINANCIALS + ",counted AS (SELECT snapshot_date, "
        + ", ".join(f"count({c}) AS {c}" for c in NUMBERS) + " FROM numbers GROUP BY 1),"
        + f" tall AS (UNPIVOT counted ON {', '.join(NUMBERS)} INTO NAME col VALUE n)"
        + " SELECT snapshot_date, col AS \"column\", p AS probability, true AS near FROM tall,"
        " (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) t(p) WHERE n > 0",
        "q_ks_snapshots": w + SCORED + "," + FEATURES + """,
monitored AS (
  SELECT f.* FROM predictions JOIN features f USING (Customer_ID, snapshot_date)
  JOIN labels_90 USING (Customer_ID, snapshot_date)),""" + _ks(
            "monitored", WATCHED, "snapshot_date = DATE '1998-11-01'",
            "snapshot_date IN (DATE '1998-11-01', DATE '1998-12-01')",
        ),
        "q_performance_report": _METRICS,
        "q_snapshot_list": w + LMS + " SELECT DISTINCT snapshot_date::VARCHAR AS snapshot_date FROM lms ORDER BY 1",
        "q_snapshot_filter": w + LOANS + " SELECT * FROM loans WHERE snapshot_date = DATE '1998-06-01'",
        "q_time_window": w + LABELS
        + " SELECT * FROM labels_90 WHERE snapshot_date BETWEEN DATE '1998-01-01' AND DATE '1999-02-28'",
        "q_completed_loans": w + LOANS
        + " SELECT * FROM loans WHERE installment_num = 10 AND loan_start_date < DATE '1999-01-01'",
        "q_bad_age": w + ATTRIBUTES
        + " SELECT Customer_ID, Name, Age FROM raw_attr WHERE NOT regexp_matches(Age, '^[0-9]+$')",
        "q_age_range": w + ATTRIBUTES
        + " SELECT DISTINCT try_cast(Age AS INTEGER) AS Age FROM raw_attr"
        " WHERE try_cast(Age AS INTEGER) < 0 OR try_cast(Age AS INTEGER) > 100",
        "q_cast_schema": w + LMS + """
SELECT loan_id, Customer_ID, loan_start_date, CASE WHEN o % 7 = 0 THEN NULL ELSE tenure END AS tenure,
       installment_num, loan_amt, CASE WHEN o % 5 = 0 THEN NULL ELSE due_amt END AS due_amt, snapshot_date
FROM (SELECT *, loan_id::BIGINT AS o FROM lms)""",
        "q_silver_attr": w + ATTRIBUTES + " SELECT * FROM attr",
        "q_underscore_null": w + CUSTOMERS + "," + RAW_FINANCIALS
        + " SELECT Customer_ID, nullif(Num_of_Loan, '_') AS Num_of_Loan,"
        " nullif(Credit_Mix, '_') AS Credit_Mix, nullif(Monthly_Balance, '_') AS Monthly_Balance FROM raw_fin",
        "q_silver_fin_cats": w + CUSTOMERS + "," + RAW_FINANCIALS
        + f" SELECT Customer_ID, snapshot_date, {TEXT_FIXES} FROM raw_fin",
        "q_credit_age": w + CUSTOMERS + "," + RAW_FINANCIALS
        + f" SELECT Customer_ID, {HISTORY} AS Credit_History_Age FROM raw_fin",
        "q_outlier_bounds": w + CUSTOMERS + "," + FINANCIALS
        + " SELECT snapshot_date, "
        + ", ".join(f"round({c}_{e}, 4) AS {c}_{e}" for c in NUMBERS for e in ("low", "high")) + " FROM fences",
        "q_iqr_clean": w + CUSTOMERS + "," + FINANCIALS
        + f" SELECT Customer_ID, snapshot_date, {', '.join(NUMBERS)} FROM fin",
        "q_silver_fin": w + CUSTOMERS + "," + FINANCIALS + " SELECT * FROM fin",
        "q_null_counts": w + CUSTOMERS + "," + FINANCIALS + " SELECT "
        + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _NULL_COLUMNS) + " FROM fin",
        "q_null_profile": w + CUSTOMERS + "," + FINANCIALS + " " + _null_profile(),
        "q_null_prune": w + CUSTOMERS + "," + FINANCIALS
        + f" SELECT Customer_ID, Type_of_Loan, {', '.join(_KEPT)}, snapshot_date FROM fin",
        "q_complete_rows": w + PROFILES + " SELECT * FROM complete",
        "q_silver_lms": w + LOANS + " " + _LOAN_SELECT,
        "q_label_store": w + LABELS + " SELECT * FROM labels_90",
        "q_bad_rate_by_mob": w + LOANS
        + " SELECT mob, round(avg(CASE WHEN dpd >= 90 THEN 1 ELSE 0 END), 6) AS bad_rate FROM loans"
        " WHERE loan_start_date < DATE '1999-01-01' GROUP BY mob",
        "q_label_counts": w + LABELS + " SELECT snapshot_date, count(*) AS count FROM labels_90 GROUP BY 1",
        "q_distinct_values": w + ATTRIBUTES + " SELECT DISTINCT Occupation FROM raw_attr",
        "q_key_coverage": w + LABELS + "," + CLICKSTREAM + """
SELECT (SELECT count(*) FROM labels_90) AS left_rows,
       (SELECT count(*) FROM (SELECT DISTINCT Customer_ID, snapshot_date FROM labels_90)) AS left_keys,
       (SELECT count(*) FROM clicks) AS right_rows,
       (SELECT count(*) FROM (SELECT DISTINCT Customer_ID, snapshot_date FROM clicks)) AS right_keys,
       (SELECT count(*) FROM labels_90 JOIN clicks USING (Customer_ID, snapshot_date)) AS matched_rows""",
        "q_entity_history": w + CLICKSTREAM
        + " SELECT * FROM clicks WHERE Customer_ID = (SELECT min(Customer_ID) FROM clicks)",
        "q_first_rows": w + ATTRIBUTES + " SELECT * FROM attr ORDER BY Customer_ID LIMIT 5",
        "q_click_5m": w + ROLLING + f" SELECT Customer_ID, snapshot_date, {_averages()} FROM rolling",
        "q_fin_attr": w + PROFILES + " SELECT * FROM profiles",
        "q_feature_store": w + FEATURES + f" SELECT {_FEATURE_COLUMNS} FROM features",
        "q_bronze_tables": w + ATTRIBUTES + " SELECT * FROM raw_attr",
        "q_snapshot_rerun": w + LABELS + " SELECT * FROM labels_90",
        "q_etl_features": w + FEATURES + f" SELECT {_FEATURE_COLUMNS} FROM features",
        "q_training_frame": w + FRAME
        + f" SELECT loan_id, Customer_ID, label, label_def, {', '.join([*_KEPT, 'Occupation'])}, {_averages()},"
        " snapshot_date FROM frame",
        "q_temporal_split": w + LABELS + """
SELECT *, CASE WHEN snapshot_date >= DATE '1999-01-01' THEN 'oot' ELSE 'train_test' END AS period
FROM labels_90 WHERE snapshot_date BETWEEN DATE '1998-01-01' AND DATE '1999-02-28'""",
        "q_strat_split": w + LABEL_SPLIT + " SELECT * FROM split_rows",
        "q_split_stats": w + LABEL_SPLIT
        + " SELECT split, count(*) AS rows, round(avg(label), 2) AS positive_rate FROM split_rows GROUP BY split",
        "q_one_hot": w + PROFILES + " SELECT Customer_ID, "
        + ", ".join(
            f"(coalesce({c}, '') = '{v}')::INTEGER AS {c}_{v}" for c, levels in _ONE_HOT.items() for v in levels
        )
        + ", (Outstanding_Debt > 2500)::INTEGER AS indebted FROM profiles",
        "q_standardize": w + _COMPLETE_FEATURES
        + f" SELECT Customer_ID, snapshot_date, {_standardized()} FROM complete_features",
        "q_pred_labels": w + SCORED + " SELECT * FROM scored WHERE model_name = 'gbt_a'",
        "q_monitor_frame": w + SCORED + "," + FEATURES + f"""
SELECT p.Customer_ID, snapshot_date, model_name, model_predictions, label, {', '.join([*_KEPT, 'Occupation'])},
       {_averages()}
FROM predictions p JOIN features USING (Customer_ID, snapshot_date)
JOIN labels_90 USING (Customer_ID, snapshot_date)""",
        "q_auc": w + SCORED + "," + _auc("scored", "model_name") + " SELECT model_name, round(auc, 8) AS auc FROM areas",
        "q_auc_by_split": w + LABEL_SPLIT + "," + PREDICTIONS + """,
scored_split AS (SELECT * FROM split_rows JOIN predictions USING (Customer_ID, snapshot_date)
                 WHERE model_name = 'gbt_a'),""" + _auc("scored_split", "split")
        + " SELECT split, round(auc, 8) AS auc, round(2 * auc - 1, 3) AS gini FROM areas",
        "q_perf_metrics": _METRICS,
        "q_concept_drift": w + SCORED + """
SELECT snapshot_date, round(avg(abs(label - model_predictions)), 10) AS prediction_error FROM scored
WHERE model_name = 'gbt_a' GROUP BY 1""",
        "q_prediction_error": w + SCORED
        + " SELECT *, round(abs(label - model_predictions), 6) AS prediction_error FROM scored",
        "q_ks": w + FEATURES + "," + _ks("features", WATCHED),
        "q_psi_independent": w + PREDICTIONS + "," + _psi("predictions", shared=False),
        "q_psi_shared": w + PREDICTIONS + "," + _psi("predictions", shared=True),
        "q_prediction_tables": w + PREDICTIONS + " SELECT * FROM predictions",
    }
