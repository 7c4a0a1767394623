"""Exact deduplication: equal texts, found by length and content hash and proven byte by byte in Patricia tries.

Rows whose length and hash occur once own themselves. The others are dealt by length, hash and salt to tasks, which insert
the full byte strings of each such group into a trie with compressed edges; a terminal node stores the first, and so
smallest, row that reached it. Large groups are salted, so that a trie holds at most ``FAN`` rows; the owners of the salts
meet in the next level's tries, ``FAN`` salts at a time, until one trie is left.

Defined cases: texts are compared after each run of white space became one space; null texts are empty. Of equal texts
the row with the smallest key stays; null keys come last, and of rows that agree in key and text one stays. An empty table
gives an empty result.
"""

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.common import row_key
from snapmart.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
FAN = 2000
#: Bytes of edges that a trie holds before it spills a subtree to the task's own folder.
TRIE_BYTES = 64 << 20


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


class _Node:
    __slots__ = ("edge", "children", "owner", "file")

    def __init__(self, edge: bytes, owner: int | None = None):
        self.edge, self.owner, self.children, self.file = edge, owner, {}, None


class Trie:
    """A compressed radix trie over byte strings; ``owners[row]`` is the first row with the same string.

    When its edges exceed ``limit`` bytes, the subtree of the root's heaviest child moves to a file; strings that belong
    there follow it unread, and ``finish`` works through one such file at a time.
    """

    def __init__(self, limit: int = TRIE_BYTES):
        self.root, self.limit, self.held = _Node(b""), limit, 0
        self.weights: dict[int, int] = {}
        self.owners: dict[int, int] = {}

    def insert(self, data: bytes, row: int) -> None:
        node, at, lead = self.root, 0, data[0] if data else None
        while True:
            if node.file is not None:
                pickle.dump((data[at:], row), node.file)
                return
            if at == len(data):
                if node.owner is None:
                    node.owner = row
                self.owners[row] = node.owner
                return
            child = node.children.get(data[at])
            if child is None:
                node.children[data[at]] = _Node(data[at:], row)
                self.owners[row] = row
                self._grow(lead, len(data) - at)
                return
            same = _common(child.edge, data[at:]) if child.edge != data[at : at + len(child.edge)] else len(child.edge)
            if same < len(child.edge):
                middle = _Node(child.edge[:same])
                child.edge = child.edge[same:]
                middle.children[child.edge[0]] = child
                node.children[data[at]] = child = middle
            at += same
            node = child

    def _grow(self, lead: int, size: int) -> None:
        self.held += size
        self.weights[lead] = self.weights.get(lead, 0) + size
        # A subtree of one string cannot be parted; it stays.
        while self.held > self.limit and len(self.owners) > 1 and self.weights:
            heaviest = max(self.weights, key=self.weights.get)
            self._spill(self.root.children[heaviest])
            self.held -= self.weights.pop(heaviest)

    def _spill(self, top: _Node) -> None:
        """Only the first byte of the subtree's edge stays, so that no later string can part it."""
        top.file, rest = tempfile.TemporaryFile(), top.edge[1:]
        top.edge = top.edge[:1]
        open_nodes = [(top, rest)]
        while open_nodes:
            node, path = open_nodes.pop()
            if node.owner is not None:
                pickle.dump((path, node.owner), top.file)
            open_nodes.extend((child, path + child.edge) for child in node.children.values())
        top.children, top.owner = {}, None

    def finish(self) -> dict[int, int]:
        """Owners of all rows, once the spilled subtrees are read back one by one."""
        for top in self.root.children.values():
            if top.file is None:
                continue
            size = top.file.tell()
            top.file.seek(0)
            part = Trie(2 * self.limit)  # so that reading back ends even where all strings share a long prefix
            while top.file.tell() < size:
                part.insert(*pickle.load(top.file))
            top.file.close()
            # The subtree's own terminals were written first, and stay owners.
            self.owners.update(part.finish())
        for row, owner in list(self.owners.items()):
            while self.owners[owner] != owner:
                owner = self.owners[owner]
            self.owners[row] = owner
        return self.owners


def _tries(limit: int):
    """Reads rows sorted by (n, h, salt, key); gives each the number of its owner among its group's rows."""

    def settled(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
        trie = Trie(limit)
        for i, row in enumerate(rows):
            trie.insert(row["norm"].encode(), i)
        owners = trie.finish()
        return pa.RecordBatch.from_pylist(
            [
                {**row, "term": owners[i], "owner": owners[i] == i, "norm": row["norm"] if owners[i] == i else None}
                for i, row in enumerate(rows)
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = [], None
        for batch in batches:
            schema = pa.schema([*batch.schema, ("term", pa.int64()), ("owner", pa.bool_())])
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    this = (row["n"], row["h"], row["salt"])
                    if this != last and group:
                        yield settled(group, schema)
                        group = []
                    last = this
                    group.append(row)
        if group:
            yield settled(group, schema)

    return run


def _level(rows: DataFrame, order: list[Column], limit: int, name: str) -> DataFrame:
    """``rows`` (with ``n, h, salt, norm``) with ``term`` and ``owner``; only owners keep their text."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.repartition("n", "h", "salt").sortWithinPartitions("n", "h", "salt", *order, "norm")
    return materialize(dealt.mapInArrow(_tries(limit), f"{kinds}, term bigint, owner boolean"), name)


def owners(docs: DataFrame, key: str = "doc_id", text: str = "text", fan: int = FAN, limit: int = TRIE_BYTES) -> DataFrame:
    """Per row: ``key, keep_key, group_size, kept, text_sha256, row_a, row_b``; the last two are the row's content key."""
    made = docs.select(F.col(key).alias("key"), row_key(key, text).alias("_llm_id"), normalized(F.col(text)).alias("norm"))
    made = made.select(
        "key", F.col("_llm_id.a").alias("row_a"), F.col("_llm_id.b").alias("row_b"),
        F.octet_length("norm").alias("n"), F.xxhash64("norm").alias("h"), "norm",
    )
    narrow = materialize(made.withColumn("sha", F.sha2("norm", 256)).drop("norm"), "exact-keys")
    # Stored, so that both sides of the joins are plain and the partition of a frequent text is split.
    shared = materialize(narrow.groupBy("n", "h").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1"), "exact-shared")
    largest = shared.agg(F.max("cnt")).first()[0] or 1

    salt = F.pmod(F.xxhash64("key"), F.ceil(F.col("cnt") / fan)).cast("long")
    candidates = made.join(shared, ["n", "h"]).withColumn("salt", salt).drop("cnt")
    order = [F.col("key").asc_nulls_last()]
    members = level = _level(candidates, order, limit, "tries")

    # Each level maps the terminals below it to its own, until the salts of a group have met.
    final = members.select("n", "h", "salt", "term", "owner", "key").where("owner").drop("owner")
    final = final.withColumnsRenamed({"key": "keep_key"}).withColumns({"top": "term", "top_salt": "salt", "first": F.lit(True)})
    salts = -(-largest // fan)
    while salts > 1:
        salts = -(-salts // fan)
        above = level.where("owner").select(
            "n", "h", F.floor(F.col("salt") / fan).alias("salt"), F.col("salt").alias("below"),
            F.col("term").alias("below_term"), "key", "norm",
        )
        level = _level(above, [*order, F.col("below"), F.col("below_term")], limit, "tries-above")
        heads = level.where("owner").select("n", "h", "salt", "term", F.col("key").alias("keep_key"))
        up = level.select("n", "h", "salt", "term", F.col("below").alias("top_salt"), F.col("below_term").alias("top"), "owner")
        up = up.join(heads, ["n", "h", "salt", "term"]).select(
            "n", "h", "top_salt", "top", "owner", F.col("salt").alias("up_salt"), F.col("term").alias("up"), "keep_key"
        )
        final = final.drop("keep_key").join(up, ["n", "h", "top_salt", "top"]).select(
            "n", "h", "salt", "term", "keep_key", F.col("up").alias("top"), F.col("up_salt").alias("top_salt"),
            (F.col("first") & F.col("owner")).alias("first"),
        )
    slim = members.drop("norm")
    sizes = slim.groupBy("n", "h", "salt", "term").count().join(final, ["n", "h", "salt", "term"])
    sizes = sizes.groupBy("n", "h", "top").agg(F.sum("count").alias("group_size"))
    final = final.join(sizes, ["n", "h", "top"])
    found = slim.join(final, ["n", "h", "salt", "term"]).join(
        narrow.select("row_a", "row_b", "sha").distinct(), ["row_a", "row_b"]
    )
    found = found.select(
        "key", "keep_key", "group_size", (F.col("owner") & F.col("first")).alias("kept"), "sha", "row_a", "row_b"
    )
    alone = narrow.join(shared, ["n", "h"], "left_anti").select(
        "key", F.col("key").alias("keep_key"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        "sha", "row_a", "row_b",
    )
    return found.unionByName(alone).withColumnRenamed("sha", "text_sha256")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row with a smaller key has; all columns stay."""
    kept = owners(docs, key, text).where("kept").select(F.col("row_a").alias("_llm_row_a"), F.col("row_b").alias("_llm_row_b"))
    keyed = docs.withColumn("_llm_id", row_key(key, text)).withColumns({"_llm_row_a": "_llm_id.a", "_llm_row_b": "_llm_id.b"}).drop("_llm_id")
    # Rows that agree in key and text share a content key, of which one row is kept.
    return keyed.join(kept, ["_llm_row_a", "_llm_row_b"], "left_semi").dropDuplicates(["_llm_row_a", "_llm_row_b"]).drop("_llm_row_a", "_llm_row_b")
