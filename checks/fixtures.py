"""Source tables of a credit mart, derived by Spark from the given ``orders`` and ``customer`` tables.

Every row of those tables is used, so the derived tables grow with them. ``checks/oracle.py`` states the same
derivations for DuckDB.
"""

from pyspark.sql import DataFrame, SparkSession

from snapmart import schemas as S
from snapmart.session import new_path


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice", "trunc(cast(o_orderdate as date), 'MM') as month"
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven instalment snapshots per order; the share of missed ones follows from the order key."""
    steps = _orders(spark, sf_dir).selectExpr("*", "explode(sequence(0, 10)) as i")
    steps = steps.selectExpr(
        "*",
        "cast(cast(o_totalprice / 10 as float) as double) as part",
        "greatest(0, i - o_orderkey % 13) as missed",
    )
    return steps.selectExpr(
        "cast(o_orderkey as string) as loan_id",
        "cast(o_custkey as string) as Customer_ID",
        "month as loan_start_date",
        "10 as tenure",
        "i as installment_num",
        "o_totalprice as loan_amt",
        "case when o_orderkey % 101 = 0 then 0.0D else part end as due_amt",
        "(i - missed) * part as paid_amt",
        "missed * part as overdue_amt",
        "o_totalprice - (i - missed) * part as balance",
        "add_months(month, i) as snapshot_date",
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "c_custkey as k",
        "c_name",
        "c_acctbal as a",
        "c_mktsegment",
        "add_months(date '1995-01-01', cast(c_custkey % 24 as int)) as snapshot_date",
    )


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).selectExpr(
        "cast(k as string) as Customer_ID",
        "c_name as Name",
        "cast((k * 7) % 130 - 10 as string) || case when k % 9 = 0 then '_' else '' end as Age",
        "case when k % 11 = 0 then '#F%$D@*&8' else '123-45-' || lpad(cast(k % 10000 as string), 4, '0') end as SSN",
        "case when k % 13 = 0 then '_______' else c_mktsegment end as Occupation",
        "snapshot_date",
    )


def odd_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attributes as text, with names and occupations that a careless reader or writer changes."""
    return raw_attributes(spark, sf_dir).selectExpr(
        "Customer_ID",
        "case cast(Customer_ID as bigint) % 6 when 0 then ' ' || Name when 1 then Name || '  '"
        " when 2 then 'say \"hi\", ' || Name when 3 then Name || '\\n' || Name when 4 then '\\\\n' || Name || '\\\\'"
        " else Name end as Name",
        "Age",
        "SSN",
        "case when cast(Customer_ID as bigint) % 4 = 0 then '_ ' else Occupation end as Occupation",
        "cast(snapshot_date as string) as snapshot_date",
    )


def named_csv_files(rows: DataFrame, file: str, folder: str) -> None:
    """One CSV file for each value of column ``file``, called by it, all in one folder."""
    spark = rows.sparkSession
    parts = new_path(spark, "parts")
    rows.repartition(file).write.partitionBy(file).csv(parts, header=True)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for found in system.globStatus(path(f"{parts}/{file}=*/part-*")):
        name = found.getPath().getParent().getName().removeprefix(f"{file}=")
        system.rename(found.getPath(), path(f"{folder}/{name}.csv"))


def raw_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).selectExpr(
        "cast(k as string) as Customer_ID",
        "cast(cast(floor(a * case when k % 50 = 0 then 1000 else 1 end) as bigint) as string)"
        " || case when k % 10 = 0 then '_' else '' end as Annual_Income",
        "case when k % 30 = 0 then '_' else cast(k % 9 as string) end as Num_of_Loan",
        "cast(k % 25 as string) || case when k % 7 = 0 then '_' else '' end as Num_of_Delayed_Payment",
        "case when k % 45 = 0 then '_' else cast(k * 13 % 30 as string) || '.' || cast(k % 10 as string) end"
        " as Changed_Credit_Limit",
        "cast(k * 17 % 5000 as string) || '.' || lpad(cast(k % 100 as string), 2, '0')"
        " || case when k % 12 = 0 then '_' else '' end as Outstanding_Debt",
        "case when k % 14 = 0 then '__10000__' else cast(k % 500 as string) end as Amount_invested_monthly",
        "case when k % 10 = 0 then '_' else cast(k % 700 as string) end as Monthly_Balance",
        "a / 12 as Monthly_Inhand_Salary",
        "cast(k % 11 * case when k % 60 = 1 then 100 else 1 end as int) as Num_Bank_Accounts",
        "cast(k % 10 + case when k % 75 = 0 then 1000 else 0 end as int) as Num_Credit_Card",
        "cast(k % 34 + 1 + case when k % 64 = 0 then 5000 else 0 end as int) as Interest_Rate",
        "cast(k % 67 - 5 as int) as Delay_from_due_date",
        "cast(k % 17 as int) as Num_Credit_Inquiries",
        "20 + (k % 300) / 10 as Credit_Utilization_Ratio",
        "cast(k % 1800 + case when k % 13 = 0 then 100000 else 0 end as double) as Total_EMI_per_month",
        "case k % 3 when 0 then 'Auto Loan' when 1 then 'Home Loan, Auto Loan' else 'Not Specified' end as Type_of_Loan",
        "case k % 4 when 0 then 'Good' when 1 then 'Standard' when 2 then 'Bad' else '_' end as Credit_Mix",
        "case when k % 40 = 0 then 'NA' when k % 25 = 0 then cast(k % 30 as string) || ' Years_'"
        " else cast(k % 30 as string) || ' Years and ' || cast(k % 12 as string) || ' Months' end"
        " as Credit_History_Age",
        "case k % 5 when 0 then 'Yes' when 1 then 'No' when 2 then 'NM' when 3 then ' no ' else 'y' end"
        " as Payment_of_Min_Amount",
        "case when k % 17 = 0 then '!@9#%8' when k % 2 = 0 then 'High_spent' else 'Low_spent' end as Payment_Behaviour",
        "snapshot_date",
    )


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty activity numbers per customer and order month, some of them missing."""
    sums = [
        f"case when (o_custkey + month(month) + {i}) % 41 = 0 then null"
        f" else cast(sum(o_orderkey * {i} % 97 - 40) as double) end as {c}"
        for i, c in enumerate(S.CLICK_FEATURES, 1)
    ]
    return spark.sql(
        f"select cast(o_custkey as string) as Customer_ID, month as snapshot_date, {', '.join(sums)}"
        " from {orders} group by o_custkey, month",
        orders=_orders(spark, sf_dir),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-form scores of two models for every customer with a loan at month seven."""
    orders = _orders(spark, sf_dir).selectExpr("o_custkey", "add_months(month, 7) as snapshot_date", "o_orderkey")
    keyed = orders.groupBy("o_custkey", "snapshot_date").sum("o_orderkey").toDF("c", "snapshot_date", "s")
    return keyed.selectExpr(
        "cast(c as string) as Customer_ID",
        "snapshot_date",
        "inline(array(struct('gbt_a' as model_name, round((s * 37 % 1000) / 1000, 3) as model_predictions),"
        " struct('gbt_b' as model_name, round((s * 91 % 777) / 777, 3) as model_predictions)))",
    )
