"""Helpers of several operators: keys of rows, bounded samples, Arrow batches in small slices.

Column names that start with ``_llm_`` are the operators' own.
"""

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Code points that a Python step holds at a time, one text at least.
SLICE_CHARS = 1_000_000


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Sets the session to hand Python batches of ``rows`` rows, unless it is set already: texts are long rows."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":  # the default
        spark.conf.set(setting, str(rows))
    return spark


def row_key(*columns: str) -> Column:
    """128 bits of the given columns: rows that agree in all of them share a key and are interchangeable.

    A key from the contents stays the same however often a lost executor makes Spark read a row again.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *reversed(parts)).alias("b"))


def crc_fold(key: str, folds: int) -> Column:
    """The row's fold: crc32 of its key as text, modulo ``folds``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def bounded_sample(rows: DataFrame, classes: str, per_class: int, key: str) -> DataFrame:
    """About ``per_class`` rows of each class, the same whenever it is drawn, and never over twice that in all.

    One pass counts the classes, another keeps rows whose hashed key lies below the class's share. ``classes`` must have
    few values: they come to the driver with their counts.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(classes).isNotNull()).groupBy(classes).count().collect()}
    span = 1 << 30
    share = F.lit(None).cast("long")
    for value, n in sorted(counts.items(), reverse=True):
        share = F.when(F.col(classes) == F.lit(value), int(span * min(1.0, per_class / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(span)) < share
    return rows.where(drawn).limit(2 * per_class * max(1, len(counts)))


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """``batch`` cut into runs of rows of about ``most`` characters, each with its texts; null texts are empty.

    Only the texts of one run are Python strings at a time.
    """
    column = batch.column(batch.schema.get_field_index(text))
    start, held, texts = 0, 0, []
    for at in range(0, len(column), 32):
        for i, value in enumerate(column.slice(at, 32).to_pylist(), at):
            texts.append(value or "")
            held += len(texts[-1]) + 1
            if held >= most:
                yield batch.slice(start, i + 1 - start), texts
                start, held, texts = i + 1, 0, []
    if texts:
        yield batch.slice(start), texts
    pa.default_memory_pool().release_unused()


def with_columns(batch: pa.RecordBatch, names: Sequence[str], columns: Sequence[pa.Array]) -> pa.RecordBatch:
    """``batch`` with further columns; those of the same name are replaced."""
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n not in names]
    return pa.RecordBatch.from_arrays(
        [c for _, c in kept] + list(columns), names=[n for n, _ in kept] + list(names)
    )


def schema_with(df: DataFrame, **added: str):
    """The schema of ``df`` with further columns, given as name=type; those of the same name are replaced."""
    from pyspark.sql import types as T

    kept = [f for f in df.schema.fields if f.name not in added]
    return T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in added.items()])


def salted_left_join(rows: DataFrame, table: DataFrame, on: str, salts: int = 64) -> DataFrame:
    """``rows`` left-joined to ``table``, which has one row per value of ``on``; no value meets its rows in one task.

    Each value's rows are dealt over ``salts`` tasks by all their columns but maps, which have no hash; ``table`` is
    repeated for each salt.
    """
    hashed = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind]
    copies = table.withColumn("_llm_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("_llm_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
    return dealt.join(copies, [on, "_llm_salt"], "left").drop("_llm_salt")
