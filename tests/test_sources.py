import re
import time
from datetime import date
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from checks import queries

from snapmart.plans import etl
from snapmart.plans.layout import Mart
from snapmart.schemas import RAW_COLUMNS
from snapmart.session import materialize, work_folder, work_tables
from snapmart.sources import multiline, snapshots

from conftest import rows

DAYS = [date(2024, 1, 1), date(2024, 2, 1)]


def panel(spark, values):
    return spark.createDataFrame(values, "Customer_ID string, v int, snapshot_date date")


def test_rerun_replaces_its_partition_only(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshots(panel(spark, [("a", 1, DAYS[0]), ("b", 2, DAYS[1])]), path)
    snapshots.write_snapshots(panel(spark, [("c", 3, DAYS[1])]), path)
    table = snapshots.read_table(spark, path)
    assert dict(table.dtypes)["snapshot_date"] == "date"
    assert rows(table) == [("a", 1, DAYS[0]), ("c", 3, DAYS[1])]
    assert rows(snapshots.at_snapshot(table, DAYS[1])) == [("c", 3, DAYS[1])]
    assert [r[0] for r in snapshots.snapshot_list(table).collect()] == ["2024-01-01", "2024-02-01"]


def test_snapshot_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshots(panel(spark, [("a", 1, DAYS[0]), ("b", 2, DAYS[1])]), path)
    picked = snapshots.at_snapshot(snapshots.read_table(spark, path), DAYS[0])
    assert rows(picked) == [("a", 1, DAYS[0])]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_columns_added_later_are_merged(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshots(panel(spark, [("a", 1, DAYS[0])]), path)
    snapshots.write_snapshots(panel(spark, [("b", 2, DAYS[1])]).selectExpr("Customer_ID", "v", "v + 1 as w", "snapshot_date"), path)
    merged = snapshots.read_table(spark, path, merge_schema=True)
    assert rows(merged, "Customer_ID", "v", "w") == [("a", 1, None), ("b", 2, 3)]


def test_bronze_keeps_text_as_it_came(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text(
        "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n"
        'c1,"Doe, J",28_,#F%$D@*&8,_______,2024-01-01\n'
        "c2,,007,123,Lawyer,2024-02-01\n"
        "c3,x,1,1,y,\n"
    )
    assert rows(snapshots.undated_rows(snapshots.read_csv(spark, str(raw)))) == [(None, 1)]
    mart = Mart(str(tmp_path / "mart"))
    etl.build_bronze(spark, {"attributes": str(raw)}, mart)
    assert (Path(mart.bronze("attributes")) / "snapshot_date=2024-01-01").is_dir()
    assert rows(etl.read_bronze(spark, mart, "attributes")) == [
        ("c1", "Doe, J", "28_", "#F%$D@*&8", "_______", DAYS[0]),
        ("c2", None, "007", "123", "Lawyer", DAYS[1]),
    ]
    assert rows(etl.read_bronze(spark, mart, "attributes", DAYS[1], DAYS[1]), "Customer_ID") == [("c2",)]


def test_dated_files(spark, tmp_path):
    for name in ["bronze_2024_01_01.csv", "bronze_2024_02_01.csv", "notes.csv"]:
        (tmp_path / name).write_text(f"Customer_ID,v\n{name[:10]},1\n{name[:10]},2\n")
    (tmp_path / "readme.txt").write_text("x")
    schema = T.StructType().add("Customer_ID", "string").add("v", "string")
    dated, undated = snapshots.read_dated_files(spark, str(tmp_path), "csv", schema)
    assert rows(dated.select("file_snapshot").distinct()) == [(d,) for d in DAYS]
    assert dated.count() == 4
    assert rows(undated) == [("notes.csv", 2)]


class Session:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_work_folder_follows_the_session():
    assert work_folder(Session(spark_checkpoint_dir="s3://shared", spark_master="yarn")) == "s3://shared"
    local = Session(spark_master="local[4]")
    assert work_folder(local) == work_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session(spark_master="yarn"))


def test_materialize_gives_the_same_rows(spark):
    assert rows(materialize(spark.range(5), "numbers")) == [(i,) for i in range(5)]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("extra,Age,Customer_ID\nx,007,c1\n")
    df = snapshots.read_csv(spark, str(tmp_path / "one.csv"), ["Customer_ID", "Name", "Age"])
    assert df.columns == ["Customer_ID", "Age", "extra"]
    assert rows(df) == [("c1", "007", "x")]


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer_ID,Age\nc1,1\n")
    (tmp_path / "b.csv").write_text("Age,Customer_ID\n1,c1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        snapshots.read_csv(spark, str(tmp_path)).collect()


def test_bronze_text_survives_and_rejects_are_counted(spark, tmp_path):
    texts = [" no ", "_ ", 'say ""hi"", x', "a\nb", "tail\\n\\", "\\s", "", '""']
    lines = [f'c{i},"{t}",{i},s,o,2024-01-01' for i, t in enumerate(texts)]
    lines += ["c90,n,1,s,o,someday", "c91,n,1,s,o", "c92,n,1,s,o,2024-01-01,more", "c93,n,1,s,o,"]
    raw = tmp_path / "raw.csv"
    raw.write_text("Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n" + "\n".join(lines) + "\n")
    mart = Mart(str(tmp_path / "mart"))
    etl.build_bronze(spark, {"attributes": str(raw)}, mart, multi_line=True)
    found = {r.Customer_ID: r.Name for r in etl.read_bronze(spark, mart, "attributes").collect()}
    # A quoted empty text is null, as usual in CSV.
    assert found == {f"c{i}": t.replace('""', '"') or None for i, t in enumerate(texts)}
    rejected = spark.read.parquet(mart.quarantine("attributes"))
    assert rows(snapshots.quarantine_counts(rejected)) == [
        ("date", "someday", 1), ("date", None, 1), ("fields", "2024-01-01", 1), ("fields", None, 1)
    ]


def test_snapshots_of_differing_sources_are_read_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer_ID,Age,snapshot_date,Note\nc1,1,2024-01-01,seen\n")
    (tmp_path / "b.csv").write_text("Name,snapshot_date,Customer_ID\nDoe,2024-02-01,c2\n")
    mart = Mart(str(tmp_path / "mart"))
    etl.build_bronze(spark, {"attributes": [str(tmp_path / "a.csv")]}, mart)
    etl.build_bronze(spark, {"attributes": [str(tmp_path / "b.csv")]}, mart)
    assert rows(etl.read_bronze(spark, mart, "attributes")) == [
        ("c1", None, "1", None, None, DAYS[0]), ("c2", "Doe", None, None, None, DAYS[1])
    ]
    stored = snapshots.read_split(spark, mart.bronze("attributes"), RAW_COLUMNS["attributes"])
    assert rows(snapshots.extra_column(stored, "Note"), "Customer_ID", "Note") == [("c1", "seen"), ("c2", None)]


def test_work_tables_go_with_their_block(spark, tmp_path):
    with work_tables(spark):
        kept = materialize(spark.range(3), "inner")
        path = kept.inputFiles()[0].removeprefix("file:").replace("file://", "")
        assert Path(path).exists()
    assert not Path(path).parent.exists()


def test_whole_table_replaces_old_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshots(panel(spark, [("a", 1, DAYS[0]), ("b", 2, DAYS[1])]), path, whole_table=True)
    snapshots.write_snapshots(panel(spark, [("c", 3, DAYS[1])]).drop("v"), path, whole_table=True)
    assert rows(snapshots.read_table(spark, path)) == [("c", DAYS[1])]


ODD_CSV = [
    'a,b,c\n1,"x\ny",2\n"q ""in"" q","\n\n","z"\n',
    'a,b,c\r\n1,"x\r\ny",2\r\n3,,\r\n\r\n4,"",5\r\n',
    'a,b,c\n5" pipe,a"b,c\n1,"say ""hi"", then\n""bye""",2\n "spaced", x ,"y"\n',
    'a,b,c\n1,"stops"early,2\n1,"two\nlines"odd,3\n""\n"","",""\n',
    'a,b,c\n1,2\n1,2,3,4\n"1\n2","3\n4"\n',
    'a,b,c\n1,"never closed,2\n3,4,5\n',
    'a,b,c\n',
    'a,b,c\n1,é😀,"\u2028 \x0b"',
]


@pytest.mark.parametrize("split", ["1", "7", "64", "128m"])
def test_multi_line_files_are_read_as_by_one_task(spark, tmp_path, split):
    """Every split size gives the rows of Spark's own reader, which gives a file to one task."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for i, text in enumerate(ODD_CSV):
            path = tmp_path / f"{i}.csv"
            path.write_bytes(text.encode())
            schema = "a string, b string, c string, _corrupt string"
            options = {"header": True, "multiLine": True, "escape": '"', "columnNameOfCorruptRecord": "_corrupt"}
            wanted = rows(spark.read.schema(schema).options(**options).csv(str(path)), "a", "b", "c")
            found = rows(snapshots.read_csv(spark, str(path), ["a", "b", "c"], multi_line=True, keep_corrupt=True), "a", "b", "c")
            if "\r" in text:  # where lines end in CR LF, Spark's reader turns those inside quoted text into LF; here they stay
                assert any("\r\n" in (v or "") for r in found for v in r)
                found = [tuple(v and v.replace("\r\n", "\n") for v in r) for r in found]
            if "never closed" in text:  # the file's last line break is no part of any line
                wanted = [tuple(v and v.rstrip("\n") for v in r) for r in wanted]
            assert found == wanted, text
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_multi_line_records_cross_many_splits(spark, tmp_path):
    """Long records over many small splits, in several files of one folder."""
    import random

    rnd = random.Random(6)
    wanted = []
    for name in ("x.csv", "y.csv"):
        lines = ["a,b"]
        for i in range(300):
            text = "".join(rnd.choice(["a", ",", "\n", '"', " ", "b"]) for _ in range(rnd.choice([0, 3, 30, 500])))
            wanted.append((f"{name}{i}", text or None))
            lines.append(f'{name}{i},"{text.replace(chr(34), chr(34) * 2)}"')
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = snapshots.read_csv(spark, str(tmp_path), ["a", "b"], multi_line=True)
        assert sorted(rows(found), key=repr) == sorted(wanted, key=repr)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (tmp_path / "z.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        snapshots.read_csv(spark, str(tmp_path), multi_line=True).collect()


def test_written_tables_leave_no_shuffles_and_bronze_is_compressed(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n for n in re.findall(r"shuffle_\d+_", disk.getAllBlocks().mkString(" "))}
    before, mart = shuffled(), Mart(str(tmp_path))
    raw = spark.range(20_000).selectExpr(
        "cast(id as string) as Customer_ID", "'a name, with \"quotes\"' as Name", "cast(id % 90 as string) as Age", "'_' as SSN",
        "cast(null as string) as Occupation", "cast(date_add(date'2024-01-01', cast(id % 3 as int)) as string) as snapshot_date",
    )
    snapshots.split_into_snapshots(raw, mart.bronze("attributes"), RAW_COLUMNS["attributes"], mart.quarantine("attributes"))
    materialize(raw.groupBy("Age").count(), "counts")
    stored = sum(f.stat().st_size for f in Path(mart.bronze("attributes")).rglob("part-*"))
    assert stored < 20_000 * 10
    assert rows(etl.read_bronze(spark, mart, "attributes")) == rows(raw.withColumn("snapshot_date", F.col("snapshot_date").cast("date")))
    for _ in range(50):  # they are deleted in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before


def test_large_raw_files_are_written_by_all_tasks(spark):
    """No task writes the whole table; each file has the header, also that of a table without rows."""
    some = spark.range(0, 400, numPartitions=4).selectExpr("cast(id as string) as a", "if(id % 3 = 0, null, 'x\ny') as b")
    for df in (some, some.where("false")):
        path = queries._raw_files(df, "raw")
        held = sorted(r[0] for r in spark.read.text(path, wholetext=True).where("value != ''").collect())
        assert [t.count("a,b\n") for t in held] == [1] * len(held)
        assert len(held) == (5 if df is some else 1) and max(t.count('","') for t in held) < 100
        assert rows(snapshots.read_csv(spark, path, ["a", "b"], multi_line=True)) == rows(df)


def _after_one_by_one(found, inside):
    states = []
    for i in range(len(found.bounds) - 1):
        states.append(inside := found.after(i, inside))
    return states


def test_quotes_are_counted_as_the_patterns_count_them():
    """Also where quotes stand in the middle of a field, doubled or alone, or after a closing one."""
    import random

    rnd = random.Random(8)
    for i in range(3000):
        odd = rnd.choice([0, 0.05, 0.4])
        kinds = ['"a"', '"a""b"', '""', "a", "", '"x,', 'y"', '"', "\r"]
        lines = [
            ",".join(rnd.choice(['5" pipe', 'a"b"', '"s"t"', '"" "', '""""', '"""']) if rnd.random() < odd else rnd.choice(kinds) for _ in range(4))
            for _ in range(rnd.choice([1, 3, 12]))
        ]
        found = multiline._Lines(pa.array(["not looked at", *lines, "nor this"], pa.string())[1:-1])
        for inside in (False, True):
            assert list(found.all_after(inside)) == _after_one_by_one(found, inside), lines
            first = rnd.randrange(len(lines))
            rest = multiline._Lines(pa.array(lines[first:], pa.string()))
            assert list(found.all_after(inside, first)) == _after_one_by_one(rest, inside), lines


def test_regular_lines_are_not_matched_one_by_one(monkeypatch):
    lines = ['"1","paid', '""late"", ok","2"', "", "3,4,x", '"5","",""""'] * 2000
    found = multiline._Lines(pa.array(lines, pa.string()))
    wanted = _after_one_by_one(found, False)
    monkeypatch.setattr(multiline._Lines, "after", lambda *_: pytest.fail("matched by itself"))
    assert list(found.all_after(False)) == wanted == [True, False, False, False, False] * 2000


def test_bronze_is_shuffled_compressed(spark, tmp_path, monkeypatch):
    raw = spark.range(60_000).selectExpr(
        "cast(id as string) as Customer_ID", "concat('customer ', id % 977) as Name", "cast(id % 90 as string) as Age", "'_' as SSN",
        "cast(null as string) as Occupation", "cast(date_add(date'2024-01-01', cast(id % 7 as int)) as string) as snapshot_date",
    )
    mart, sizes, real = Mart(str(tmp_path)), [], snapshots._packed

    def noted(df):
        held = snapshots._pack(df)
        assert held.count() == 7 * df.rdd.getNumPartitions()  # a task's rows of a date go together
        sizes.append(held.agg(F.sum(F.octet_length("_rows"))).first()[0])
        return real(df)

    monkeypatch.setattr(snapshots, "_packed", noted)
    snapshots.split_into_snapshots(raw, mart.bronze("attributes"), RAW_COLUMNS["attributes"], mart.quarantine("attributes"))
    assert len(sizes) == 1 and sizes[0] < 60_000 * 8  # 22 characters a row
    assert rows(etl.read_bronze(spark, mart, "attributes")) == rows(raw.withColumn("snapshot_date", F.col("snapshot_date").cast("date")))


def test_rows_of_bronze_files_are_not_shuffled_again(spark, tmp_path, monkeypatch):
    raw = spark.range(500).selectExpr(
        "cast(id as string) as Customer_ID", "'n' as Name", "cast(id % 90 as string) as Age", "'_' as SSN", "'o' as Occupation",
        "cast(date_add(date'2024-01-01', cast(id % 3 as int)) as string) as snapshot_date",
    )
    mart, shuffled, now = Mart(str(tmp_path)), [], []
    for name in ("lms", "attributes", "financials"):
        columns = RAW_COLUMNS[name]
        some = raw.select(*[F.col(c) if c in raw.columns else F.lit("1").alias(c) for c in columns])
        snapshots.split_into_snapshots(some, mart.bronze(name), columns, mart.quarantine(name))
    write, hint = snapshots.write_snapshots, type(raw).hint

    def noted(df, path, *more, **others):
        now[:] = [Path(path).name]
        assert now[0] == "financials" or "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        write(df, path, *more, **others)

    monkeypatch.setattr(etl, "write_snapshots", noted)
    monkeypatch.setattr(type(raw), "hint", lambda df, *a, **b: (shuffled.append(now[0]) if now else None, hint(df, *a, **b))[1])
    etl.build_silver(spark, mart)
    assert set(shuffled) == {"financials"}
    files = lambda top: len([f for f in Path(top).rglob("part-*") if not f.name.endswith(".crc")])
    for table, source in (("loan_daily", "lms"), ("attributes", "attributes")):
        assert snapshots.read_table(spark, mart.silver(table)).count() == 500
        assert 3 <= files(mart.silver(table)) <= files(mart.bronze(source))


@pytest.mark.parametrize("pack_bytes", [1, 32 << 20])
def test_packed_rows_come_back_as_they_were(spark, tmp_path, monkeypatch, pack_bytes):
    """All kinds of values, nulls, columns of nulls only, rows that come twice, many dates and one with most rows, no rows."""
    monkeypatch.setattr(snapshots, "_PACK_BYTES", pack_bytes)
    days = "if(id % 5 = 0, cast(null as date), if(id % 2 = 0, date'2024-01-01', date_add(date'1969-12-01', cast(id % 40 as int))))"
    some = spark.range(0, 2000, numPartitions=3).selectExpr(
        "id % 900 as a", f"{days} as snapshot_date", "if(id % 3 = 0, null, concat('t\u00e9\\n', id % 11)) as b", "cast(id / 3 as float) as c",
        "if(id % 4 = 0, double('nan'), id / 7) as d", "cast(null as string) as e", "id % 2 = 0 as f", "cast(id as int) as g",
        "timestamp'2024-03-01 10:00:00' as h", "cast(id as decimal(12, 2)) as i", "if(id = 3, 'once', null) as j",
    )
    some = some.unionByName(some.limit(50))
    order = [c for c in some.columns if c != "snapshot_date"] + ["snapshot_date"]
    for i, df in enumerate((some, some.where("false"))):
        found = snapshots._packed(df)
        assert found.schema.simpleString() == df.select(*order).schema.simpleString()
        assert repr(rows(found)) == repr(rows(df, *order))
        if not i:
            path = str(tmp_path / "table")
            snapshots.write_snapshots(df, path, shuffle="packed")
            assert repr(rows(snapshots.read_table(spark, path))) == repr(rows(df, *order))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("64MB", "67108864b")
