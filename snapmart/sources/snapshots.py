"""Reading and writing snapshot tables.

A table is a folder with one ``snapshot_date=YYYY-MM-DD`` partition per snapshot. Writes overwrite only the
partitions present in the data, so rerunning one snapshot leaves the others alone.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from snapmart.functions.columns import date_in_file_name
from snapmart.schemas import SNAPSHOT
from snapmart.session import delete_folder, folder_exists, shuffles_freed, smaller_partitions
from snapmart.sources import multiline

# Columns beside the sources' own: unreadable lines, and columns that a table's schema does not name.
CORRUPT, EXTRA = "_corrupt", "_extra"
_DAY_TEXT, _NO_DAY = "_day_text", "__HIVE_DEFAULT_PARTITION__"
# Bytes of rows that a task compresses at once, and about how many times smaller than Spark's own shuffle files that makes them.
_PACK_BYTES, _PACK_TIMES = 32 << 20, 4


def read_csv(
    spark: SparkSession, path: str, columns: list[str] = (), multi_line: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """A CSV file or folder with headers, every column as text, the given columns first and in that order.

    Quotes inside quoted text are doubled, as usual. ``multi_line`` lets quoted text hold line breaks; the files are then
    read twice, see ``multiline``. Columns go by the header's names, and files whose headers differ are an error rather
    than shifted columns; read them one by one. With ``keep_corrupt`` the column ``CORRUPT`` holds the text of lines whose
    number of fields is wrong.
    """
    options = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    beside = [CORRUPT] if keep_corrupt else []
    if multi_line:
        rows = multiline.parsed(multiline.records(spark, path), names, CORRUPT if keep_corrupt else None)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *beside]])
        rows = spark.read.options(**options, columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(path)
    known = [c for c in columns if c in names]
    return rows.select(*known, *sorted(set(names) - set(known)), *beside)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A snapshot-partitioned parquet table; filters on ``snapshot_date`` prune its partitions."""
    return spark.read.option("basePath", path).option("mergeSchema", merge_schema).parquet(path)


def read_dated_files(
    spark: SparkSession, path: str, file_format: str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """A flat folder of ``*_YYYY_MM_DD.csv|parquet`` files, and the files without a date in their name.

    The first frame holds the rows of dated files with ``file_snapshot``. The second lists every other file
    with its row count, so that nothing is skipped unseen.
    """
    reader = spark.read.option("pathGlobFilter", f"*.{file_format}")
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        reader = reader.options(header=True, enforceSchema=False, escape='"')
    return by_file_date(reader.format(file_format).load(path).select("*", F.col("_metadata.file_name").alias("file_name")))


def by_file_date(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``file_name``: those of dated files with ``file_snapshot`` instead, and the other files with their rows."""
    named = rows.withColumn("file_snapshot", date_in_file_name(F.col("file_name")))
    undated = named.filter(F.col("file_snapshot").isNull()).groupBy("file_name").agg(F.count("*").alias("rows"))
    return named.filter(F.col("file_snapshot").isNotNull()).drop("file_name"), undated


def write_snapshots(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_columns=(SNAPSHOT,),
    whole_table: bool = False,
    shuffle: str = "rows",
) -> None:
    """Overwrite exactly the partitions that ``df`` holds, or the whole table, in a single pass over it.

    ``rebalance`` gathers each partition's rows into few files, and splits a snapshot that holds much of the
    data into several tasks, where a plain repartition on the date would give it to a single one. ``shuffle`` says how the rows get
    there: ``rows`` one by one, ``packed`` compressed, for large tables by snapshot, or ``none`` if they lie by partition already,
    as those of a table's files do: then each task writes what it reads. CSV is compressed, as its text is several times as large;
    its files are small enough to be read by one task each.
    """
    gather = {"rows": lambda: df.hint("rebalance", *[F.col(c) for c in partition_columns]), "packed": lambda: _packed(df), "none": lambda: df}
    writer = (
        gather[shuffle]()
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
        .partitionBy(*partition_columns)
    )
    if file_format == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"
        )
    elif file_format == "parquet":
        writer = writer.option("compression", "zstd")
    with shuffles_freed(df.sparkSession), smaller_partitions(df.sparkSession, _PACK_TIMES if shuffle == "packed" else 1):
        writer.format(file_format).save(path)


def _pack(rows: DataFrame) -> DataFrame:
    """``snapshot_date, _rows``: some rows of one snapshot as the bytes of a small Parquet file.

    Each task sorts so many rows by snapshot at once as make up ``_PACK_BYTES``.
    """
    names = [c for c in rows.columns if c != SNAPSHOT]

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        day = table[SNAPSHOT].combine_chunks()
        number = day.cast(pa.int32()).fill_null(np.iinfo(np.int32).min).to_numpy()
        order = np.argsort(number, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(number[order])) + 1), len(order)]
        table = table.select(names).take(pa.array(order))
        found = []
        for i, j in zip(cuts, cuts[1:]):
            part, sink = table.slice(i, j - i), pa.BufferOutputStream()
            part = part.select([c for c in names if part[c].null_count < len(part)] or names[:1])
            pq.write_table(part, sink, compression="zstd", use_dictionary=False, write_statistics=False, store_schema=False)
            found.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([day.take(pa.array(order[cuts[:-1]])), pa.array(found, pa.binary())], names=[SNAPSHOT, "_rows"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= _PACK_BYTES:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return rows.mapInArrow(packed, f"{SNAPSHOT} date, _rows binary")


def _packed(rows: DataFrame) -> DataFrame:
    """Rows gathered by snapshot, shuffled as compressed columns: a fraction of what they take row by row in Spark's shuffle files."""
    fields = [f for f in rows.schema if f.name != SNAPSHOT]
    names = [f.name for f in fields]
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for day, data in zip(*batch.columns):
                for part in pq.read_table(pa.BufferReader(data.as_buffer())).to_batches():
                    n, there = part.num_rows, part.schema.names
                    values = [part.column(c).cast(k) if c in there else pa.nulls(n, k) for c, k in zip(names, kinds)]
                    yield pa.RecordBatch.from_arrays([*values, pa.repeat(day, n)], names=[*names, SNAPSHOT])

    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], T.StructField(SNAPSHOT, T.DateType())])
    return _pack(rows).hint("rebalance", F.col(SNAPSHOT)).mapInArrow(unpacked, schema)


def save_bucketed(df: DataFrame, table: str, path: str, by: list[str], buckets: int = 64) -> None:
    """Store ``df`` as a catalog table whose files are dealt by a hash of ``by`` and sorted by it, one file per bucket.

    Tables with as many buckets by the same columns are joined on these without a shuffle or a sort. Deal by all columns of the
    join, so that a customer with very many rows is spread over its snapshots.
    """
    dealt = df.repartition(buckets, *by).sortWithinPartitions(*by)
    with shuffles_freed(df.sparkSession):
        dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)


# How bronze writes what would part a line: every backslash it writes is followed by one of these letters.
_CODES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def _one_line(c: Column) -> Column:
    for plain, code in _CODES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def _many_lines(c: Column) -> Column:
    plain = c
    for text, code in reversed(_CODES):
        plain = F.replace(plain, F.lit(code), F.lit(text))
    # Most texts have no code in them, which one search shows.
    return F.when(F.contains(c, F.lit("\\")), plain).otherwise(c)


def split_into_snapshots(raw: DataFrame, path: str, columns: list[str], quarantine: str) -> None:
    """Raw rows of text to a CSV table with one partition per snapshot date; other rows to the quarantine table.

    All files have the same header: ``columns``, null where the source lacks one, and ``EXTRA`` with the source's
    further columns as a JSON object. So snapshots of differing sources stay readable together, and every text comes
    back as it was, with its spaces, quotes and line breaks.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    day = F.when(corrupt.isNull(), F.col(SNAPSHOT).try_cast("date"))
    further = [c for c in raw.columns if c not in {*columns, CORRUPT, EXTRA}]
    extra = F.to_json(F.struct(*further)) if further else F.lit(None).cast("string")
    text = {c: F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string") for c in columns}
    fixed = raw.select(
        *[_one_line(v).alias(c) for c, v in text.items() if c != SNAPSHOT],
        _one_line(extra).alias(EXTRA),
        *[_one_line(F.when(day.isNull(), v)).alias(c) for c, v in ((_DAY_TEXT, text[SNAPSHOT]), (CORRUPT, corrupt))],
        day.alias(SNAPSHOT),
    )
    # One pass over the raw text: rows without a day are a partition of their own, which then moves to the quarantine.
    spark, no_day = raw.sparkSession, f"{path}/{SNAPSHOT}={_NO_DAY}"
    delete_folder(spark, no_day)  # of a run that broke off
    write_snapshots(fixed, path, "csv", shuffle="packed")
    found = folder_exists(spark, no_day)
    rejected = _stored(spark, path, columns, no_day if found else None).where(F.lit(found))
    reason = F.when(F.col(CORRUPT).isNotNull(), "fields").otherwise("date")
    rejected = rejected.withColumns({"reason": reason, SNAPSHOT: F.col(_DAY_TEXT)}).drop(_DAY_TEXT)
    rejected.write.mode("overwrite").parquet(quarantine)
    delete_folder(spark, no_day)


def _stored(spark: SparkSession, path: str, columns: list[str], folder: str | None = None) -> DataFrame:
    """All columns of a table written by ``split_into_snapshots``, or of one of its folders."""
    stored = [*[c for c in columns if c != SNAPSHOT], EXTRA, _DAY_TEXT, CORRUPT]
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in stored], T.StructField(SNAPSHOT, T.DateType())])
    # A record that was unreadable is text like any other here, so it must not be taken for the parser's own column.
    options = {"header": True, "enforceSchema": False, "escape": '"', "columnNameOfCorruptRecord": "_unreadable", "basePath": path}
    rows = spark.read.schema(schema).options(**options).csv(folder or path)
    return rows.select(*[_many_lines(F.col(c)).alias(c) for c in stored], SNAPSHOT)


def read_split(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A table written by ``split_into_snapshots``: ``columns``, and the sources' further columns if there are any."""
    return _stored(spark, path, columns).where(F.col(SNAPSHOT).isNotNull()).select(*columns, EXTRA)


def extra_column(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with one of the sources' further columns, null where a source lacks it."""
    return rows.withColumn(name, F.get_json_object(EXTRA, f"$['{name}']"))


def quarantine_counts(rejected: DataFrame) -> DataFrame:
    """What bronze left out: the reason, the snapshot's text and the number of rows."""
    return rejected.groupBy("reason", SNAPSHOT).agg(F.count("*").alias("rows"))


def undated_rows(raw: DataFrame) -> DataFrame:
    """The snapshot texts that are not dates, with their row counts."""
    bad = raw.filter(F.col(SNAPSHOT).try_cast("date").isNull())
    return bad.groupBy(SNAPSHOT).agg(F.count("*").alias("rows"))


def snapshot_list(df: DataFrame) -> DataFrame:
    """The distinct snapshot dates as sorted text."""
    return df.select(F.col(SNAPSHOT).cast("string").alias(SNAPSHOT)).distinct().orderBy(SNAPSHOT)


def at_snapshot(df: DataFrame, snapshot) -> DataFrame:
    return df.filter(F.col(SNAPSHOT) == F.lit(snapshot).cast("date"))


def between_snapshots(df: DataFrame, first, last) -> DataFrame:
    """Rows of the closed date range."""
    return df.filter(F.col(SNAPSHOT).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
