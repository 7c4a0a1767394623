"""The trie of conversations that share their first turns, with subtree totals by time-forward processing.

A conversation is a path from the textless root, one node per turn. A node is known by 128 bits: the sum, over the path's
turns, of a hash of each turn's digest and depth, so that running sums over ranges of rows give it and no conversation has
to pass through one task to be numbered. Counts of a node's members are plain aggregates.

Totals of subtrees go upwards. Nodes are cut into levels by the rows below them (up to ``shard``, up to its square, ...),
and a level into shards: the topmost nodes of the level on each path, with what hangs below them in that level. So a shard
holds at most ``shard`` nodes of one depth, however many conversations share a beginning. Each shard's nodes are sorted by
reverse depth outside memory (Spark's sort); a scan takes from a priority queue what a node's children sent, and sends the
node's own totals to its parent in the same queue, which spills sorted runs to the task's disk. What shard roots send is
added up per parent and read by the next level.

Defined cases: a null role or text is empty; turns that share a number are ordered by role and by the digest of role and
text; repeated rows are repeated turns; rows without a key belong to no conversation and are left out; other columns are not
carried, whatever their names; texts of any length are only hashed and measured. An empty table has no node, not even a root.
"""

import heapq
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.operators.ranges import by_range, earlier_parts, within_part
from snapmart.session import materialize, work_tables

#: Member rows below the root of a shard, in the first level; the next levels take its powers.
SHARD = 50_000
#: Messages that a queue holds before it writes a run.
QUEUE = 200_000
_LEVELS = 4
_LANES = range(4)


def _before(sums: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """``groups, part`` and what earlier parts of the group add up to, for groups in several parts only.

    A cut between two neighbouring parts goes through one group at most, so there are fewer rows than parts.
    """
    earlier = [F.sum(c).over(earlier_parts(groups)).alias(f"before_{c}") for c in columns]
    return sums.select(*groups, "part", *earlier).where(F.col(f"before_{columns[0]}").isNotNull())


def placed_turns(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``c, part, p, digest, chars``: each turn's place in its conversation, from 1; a table of the work folder.

    ``part`` numbers ranges of rows in the order of (conversation, place). A conversation may span many.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.char_length(by).cast("string"), F.lit(":"), by, said), 256), 1, 32))
    narrow = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("c"),
        F.struct(F.col(turn).alias("turn"), by.alias("role"), digest.alias("digest")).alias("o"),
        F.char_length(said).cast("long").alias("chars"),
    )
    ranged = materialize(by_range(narrow, ["c"], "o"), "turns-ranged")
    counts = _before(ranged.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n")), ["c"], ["n"])
    numbered = ranged.withColumn("i", F.row_number().over(Window.partitionBy("c", "part").orderBy("o")))
    placed = numbered.join(F.broadcast(counts), ["c", "part"], "left").select(
        "c", "part", (F.col("i") + F.coalesce("before_n", F.lit(0))).alias("p"), F.col("o.digest").alias("digest"), "chars"
    )
    return materialize(placed, "turns-placed")


def own_paths(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) as they are; see ``with_shared_heads``."""
    ids = placed.groupBy("c").agg(F.max("p").alias("length"))
    return placed.join(ids, "c").withColumnRenamed("p", "d"), ids


def with_shared_heads(placed: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their block of ids.

    Conversation c takes the first h turns of conversation c - c % block, as far as there are any, in place of its own
    first h; h is crc32 of c's decimal digits modulo ``most``. Gives the turns (``c, part, d, digest, chars, length``)
    and the conversations (``c, length``), turnless ones included.
    """
    ids = placed.groupBy("c").agg(F.max("p").alias("n"), F.min("part").alias("first_part"))
    ids = ids.select(
        "*", (F.col("c") - F.col("c") % block).alias("head"),
        F.pmod(F.crc32(F.col("c").cast("string")), F.lit(most)).alias("h"),
    )
    lengths = ids.where(F.col("c") == F.col("head")).select("head", F.col("n").alias("head_n"))
    taken = F.least("h", F.coalesce("head_n", F.lit(0)))
    ids = ids.join(lengths, "head", "left").withColumn("taken", taken)
    ids = materialize(ids.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    heads = placed.where((F.col("c") % block == 0) & (F.col("p") < most)).select(
        F.col("c").alias("head"), F.col("p").alias("d"), "digest", "chars"
    )
    borrowed = ids.join(heads, "head").where(F.col("d") <= F.col("taken"))
    own = placed.join(ids.select("c", "h", "taken", "length"), "c").where(F.col("p") > F.col("h"))
    own = own.withColumn("d", F.col("taken") + F.col("p") - F.col("h"))
    names = ["c", "part", "d", "digest", "chars", "length"]
    borrowed = borrowed.withColumn("part", F.col("first_part"))
    return own.select(*names).unionByName(borrowed.select(*names)), ids.select("c", "length")


def _joined(lanes: list[Column]) -> list[Column]:
    return [F.shiftleft(lanes[i], 32).bitwiseOR(lanes[i + 1]) for i in (0, 2)]


def member_rows(paths: DataFrame, ids: DataFrame) -> DataFrame:
    """``c, d, a, b, pa, pb, chars, length``: each conversation at each node of its path, the root (0, 0) included."""
    code = F.sha2(F.concat(F.hex("digest"), F.lit(":"), F.col("d").cast("string")), 256)
    lane = {f"lane_{i}": F.conv(F.substring(code, 8 * i + 1, 8), 16, 10).cast("long") for i in _LANES}
    coded = materialize(paths.select("*", *[v.alias(k) for k, v in lane.items()]), "turns-coded")
    earlier = _before(coded.groupBy("c", "part").agg(*[F.sum(n).alias(n) for n in lane]), ["c"], list(lane))
    summed = coded.select("*", *[F.sum(n).over(within_part(["c"], "d")).alias(f"sum_{n}") for n in lane])
    summed = summed.join(F.broadcast(earlier), ["c", "part"], "left")
    here = [F.coalesce(f"before_{n}", F.lit(0)) + F.col(f"sum_{n}") for n in lane]
    above = [x - F.col(n) for x, n in zip(here, lane)]
    a, b = _joined([F.pmod(x, F.lit(1 << 32)) for x in here])
    pa_, pb = _joined([F.pmod(x, F.lit(1 << 32)) for x in above])
    rows = summed.select("c", "d", a.alias("a"), b.alias("b"), pa_.alias("pa"), pb.alias("pb"), "chars", "length")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = ids.select(
        "c", zero.alias("d"), zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("chars"), "length"
    )
    return materialize(rows.withColumn("d", F.col("d").cast("long")).unionByName(roots), "members")


class MessageQueue:
    """A priority queue of (reverse depth, a, b) with two numbers each; beyond ``limit`` it writes a sorted run to disk."""

    _RECORD = struct.Struct("<qqqqq")
    _BLOCK = 4096

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, key: tuple[int, int, int], leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (*key, leaves, saved))
        if len(self.heap) >= self.limit:
            run = tempfile.TemporaryFile()
            for record in sorted(self.heap):
                run.write(self._RECORD.pack(*record))
            run.seek(0)
            self.heap = []
            self.runs.append(self._records(run))
            self._advance(len(self.runs) - 1)

    def _records(self, run) -> Iterator[tuple]:
        with run:
            while block := run.read(self._RECORD.size * self._BLOCK):
                yield from self._RECORD.iter_unpack(block)

    def _advance(self, run: int) -> None:
        record = next(self.runs[run], None)
        if record is not None:
            heapq.heappush(self.heads, (record, run))

    def take(self, key: tuple[int, int, int]) -> tuple[int, int, int]:
        """(messages, leaves, saved) of all messages for ``key``, which must not lie behind any other in the queue."""
        count = leaves = saved = 0
        while self.heap and self.heap[0][:3] == key:
            *_, more, further = heapq.heappop(self.heap)
            count, leaves, saved = count + 1, leaves + more, saved + further
        while self.heads and self.heads[0][0][:3] == key:
            (*_, more, further), run = heapq.heappop(self.heads)
            self._advance(run)
            count, leaves, saved = count + 1, leaves + more, saved + further
        return count, leaves, saved

    def __len__(self) -> int:
        return len(self.heap) + len(self.heads)


_NODE = "rep long, d long, parent_rep long, n_convs long, a long, b long, pa long, pb long"
_SCANNED = f"{_NODE}, top boolean, n_children long, n_leaves long, saved long"


def _scan(nodes: DataFrame, limit: int) -> DataFrame:
    """Nodes of one level, with what lower levels sent (``n_children, n_leaves, saved``), to their totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = MessageQueue(limit)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            children, leaves, totals, tops = [], [], [], []
            for d, a, b, up_a, up_b, top_a, top_b, own, n, more, further in zip(*columns[1:2], *columns[4:]):
                count, below, saved = queue.take((-d, a, b))
                count, below, saved = count + n, below + more, saved + further + own
                top = a == top_a and b == top_b
                if not count:
                    below = 1
                if not top:
                    queue.push((1 - d, up_a, up_b), below, saved)
                children.append(count), leaves.append(below), totals.append(saved), tops.append(top)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:8], pa.array(tops, pa.bool_()), *[pa.array(x, pa.int64()) for x in (children, leaves, totals)]],
                names=[f.split()[0] for f in _SCANNED.split(", ")],
            )
        assert not len(queue), "a message found no parent"

    dealt = nodes.repartition("top_a", "top_b").sortWithinPartitions("top_a", "top_b", F.col("d").desc(), "a", "b")
    return dealt.select(
        "rep", "d", "parent_rep", "n_convs", "a", "b", "pa", "pb", "top_a", "top_b", "own", "n_children", "n_leaves", "saved"
    ).mapInArrow(run, _SCANNED)


def _end_digests(members: DataFrame) -> DataFrame:
    """``a, b, ends_sha256``: hashed id by id, so that no list of ids is ever held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            for a, b, c in zip(*[x.to_pylist() for x in batch.columns]):
                if (a, b) == last:
                    state.update(b",%d" % c)
                    continue
                if last:
                    done.append((*last, state.hexdigest()))
                last, state = (a, b), sha256(b"%d" % c)
            yield made(done)
        if last:
            yield made([(*last, state.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        kinds = zip(range(3), (pa.int64(), pa.int64(), pa.string()))
        batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in kinds], names=["a", "b", "ends_sha256"])
        done.clear()
        return batch

    ends = members.where(F.col("d") == F.col("length")).select("a", "b", "c")
    return ends.repartition("a", "b").sortWithinPartitions("a", "b", "c").mapInArrow(run, "a long, b long, ends_sha256 string")


def trie(paths: DataFrame, ids: DataFrame, shard: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conv_id`` is the node's smallest member. ``saved_tokens`` adds up, over the node's subtree, (members - 1) times the
    code points of the last text. ``ends_sha256`` is that of the comma-joined ids of conversations that end in the node.
    """
    spark = paths.sparkSession
    with work_tables(spark):
        members = member_rows(paths, ids)
        weight = F.sum(F.col("length") - F.col("d") + 1)
        nodes = members.groupBy("a", "b", "d").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("rep"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
            F.max("chars").alias("chars"), weight.alias("weight"),
        )
        level = F.lit(0)
        for j in range(1, _LEVELS):
            level = F.when(F.col("weight") > shard**j, j).otherwise(level)
        nodes = materialize(nodes.withColumn("level", level), "nodes")
        heavy = materialize(nodes.where("level > 0").select("a", "b", "level"), "nodes-heavy")
        # Per conversation and level, the topmost node: the root of the shard of the nodes that are named after it.
        on_path = members.join(heavy, ["a", "b"], "left").groupBy(F.col("c").alias("rep"), F.coalesce("level", F.lit(0)).alias("level"))
        tops = materialize(on_path.agg(F.min(F.struct("d", "a", "b")).alias("top")), "shard-roots")
        parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("rep").alias("parent_rep"))
        own = (F.col("n_convs") - 1) * F.col("chars")
        dealt = nodes.join(tops, ["rep", "level"]).join(parents, ["pa", "pb"], "left")
        dealt = dealt.select(
            "rep", "d", "parent_rep", "n_convs", "a", "b", "pa", "pb", "level",
            F.col("top.a").alias("top_a"), F.col("top.b").alias("top_b"), own.alias("own"),
        )
        dealt = materialize(dealt, "nodes-dealt")
        done: list[DataFrame] = []
        none = [F.lit(0).cast("long").alias(n) for n in ("n_children", "n_leaves", "saved")]
        for (j,) in dealt.select("level").distinct().orderBy("level").collect():
            here = dealt.where(F.col("level") == j)
            if not done:
                here = here.select("*", *none)
            else:
                sent = _union(done).where("top").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
                    F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
                )
                here = here.join(sent, ["a", "b"], "left").na.fill(0, ["n_children", "n_leaves", "saved"])
            done.append(materialize(_scan(here, queue), f"totals-{j}"))
        totals = _union(done) if done else dealt.select("*", F.lit(True).alias("top"), *none)
        result = totals.join(_end_digests(members), ["a", "b"], "left").select(
            F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("parent_rep").alias("parent_conv_id"), "n_convs",
            "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        )
        return materialize(result, "trie", keep=True)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
