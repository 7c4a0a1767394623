"""N-gram Jaccard join with Bayesian pruning of candidates, and the groups that its links form.

Texts become sets of hashed word 5-grams and MinHash signatures. Equal sets form one class and go on as one row. Classes
that share a band of their signatures are candidates; components of the graph of shared bands, found by exchanging
smallest labels, bring together all rows that can be linked. Within a component a task compares candidate pairs value by
value: once the posterior probability that the similarity reaches the threshold falls below a tolerance, the pair is
dropped; the rest is verified on the sets. Components with many shingles are dealt in blocks, each pair of blocks to one
task. Tasks return counts of links and a spanning forest of them, never all pairs.

Bands of 4 values, 32 of them, miss a pair at similarity 0.8 with a probability of 5e-8; the tolerance is 1e-6.

Defined cases: a text of fewer than five words has one shingle, all its words; a text without words (null, empty, white
space) has no links and is a class of its own row. Repeated rows are equal texts. Null keys stay null and never
represent others if there is a choice. An empty table gives an empty result.
"""

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import row_key, slices
from snapmart.session import materialize, work_tables

N = 5
THRESHOLD = 0.8
BANDS, BAND = 32, 4
VALUES = BANDS * BAND
STEP = 16  # signature values compared at a time
TOLERANCE = 1e-6
#: Shingles of one block of a component; a block holds one class at least.
BLOCK_SHINGLES = 1_500_000
#: Hashes of distinct words that a task keeps before it starts anew.
KEPT_WORDS = 200_000
_FACTORS = np.random.default_rng(77).integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(78).integers(0, 1 << 63, N + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word):
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[N]
    h = (h ^ (h >> np.uint64(29))) * _MIX[N + 1]
    return h ^ (h >> np.uint64(32))


def shingles(words: list[str], hashes: dict) -> np.ndarray:
    """The sorted set of hashed n-grams of words."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(hashes.__getitem__, words)), np.uint64)
    grams = max(1, len(h) - N + 1)
    total = np.zeros(grams, np.uint64)
    for i in range(min(N, len(h))):
        total += h[i : i + grams] * _MIX[i]
    return np.unique(_mixed(total + np.uint64(min(N, len(h)))))


def signature(grams: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions, as 32 bits."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 4096):
        least = np.minimum(least, (grams[at : at + 4096, None] * _FACTORS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For n = STEP, 2 STEP, ...: the fewest equal values of n that keep a pair in.

    With a uniform prior the similarity after m of n matches has a Beta(m + 1, n - m + 1) posterior; that it is at least
    the threshold has the probability that at most m of n + 1 draws at the threshold succeed.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                out.append(m)
                break
    return tuple(out)


def sketches(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` without its text, with ``set_a, set_b`` (a hash of the set), ``n_grams`` and ``signature``."""
    names = [c for c in docs.columns if c != text]
    kept = docs.select(*names, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part, texts in slices(batch, text):
                if len(hashes) > KEPT_WORDS:
                    hashes.clear()
                sets, sizes, signed = [], [], []
                for value in texts:
                    grams = shingles(value.split(), hashes)
                    sizes.append(len(grams))
                    sets.append(xxhash.xxh128_digest(grams.tobytes()))
                    signed.append(signature(grams).tobytes() if len(grams) else None)
                halves = np.frombuffer(b"".join(sets), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sizes, pa.int32()), pa.array(signed, pa.binary())],
                    names=[*names, "set_a", "set_b", "n_grams", "signature"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{kinds}, set_a bigint, set_b bigint, n_grams int, signature binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node, root`` for all nodes of ``edges`` (with ``a, b``): the smallest node that each is connected to.

    Large and small stars in turn: every node hands its smallest neighbour to its larger, then to its smaller ones. Edges
    never grow in number, and the rounds grow with the logarithm of the longest path. Each round is a stored table.
    """
    least = lambda a, b: F.struct(F.greatest(a, b).alias("big"), F.least(a, b).alias("small"))
    stars = edges.where("a <> b").select(least(F.col("a"), F.col("b")).alias("e")).select("e.big", "e.small").distinct()
    stars = materialize(stars, name)
    before = None
    while True:
        with work_tables(edges.sparkSession):
            # Large star: neighbours on both sides; larger ones are linked to the smallest of all.
            both = stars.select(F.col("big").alias("u"), F.col("small").alias("v")).unionByName(
                stars.select(F.col("small").alias("u"), F.col("big").alias("v"))
            )
            roots = both.groupBy("u").agg(F.min("v").alias("m"))
            roots = roots.select("u", F.least("u", "m").alias("m"))
            large = both.where("v > u").join(roots, "u").select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()
            large = materialize(large, name)
            # Small star: each node and its smaller neighbours are linked to the smallest of them.
            roots = large.groupBy("big").agg(F.min("small").alias("m"))
            linked = large.join(roots, "big").select(F.col("small").alias("big"), F.col("m").alias("small"))
            stars = linked.where("big <> small").unionByName(roots.withColumnRenamed("m", "small")).distinct()
            stars = materialize(stars, name, keep=True)
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = stars.select(F.col("big").alias("node"), F.col("small").alias("root"))
    return nodes.unionByName(stars.select("small", "small").distinct().toDF("node", "root"))


def _candidates(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that share a band; of a block with itself each pair once."""
    rows, columns = [], []
    shape = (-1, BANDS, BAND)
    a, b = left.reshape(shape), right.reshape(shape)
    for low in range(0, len(a), 512):
        shared = np.zeros((len(a[low : low + 512]), len(b)), bool)
        for band in range(BANDS):
            one, other = (np.ascontiguousarray(x[:, band]).view(f"V{4 * BAND}").ravel() for x in (a[low : low + 512], b))
            _, codes = np.unique(np.r_[one, other], return_inverse=True)
            shared |= codes[: len(one), None] == codes[None, len(one) :]
        if same:
            shared &= np.arange(len(b))[None, :] > (np.arange(low, low + shared.shape[0]))[:, None]
        x, y = np.nonzero(shared)
        rows.append(x + low)
        columns.append(y)
    return np.concatenate(rows), np.concatenate(columns)


def _pruned(left, right, x, y, threshold, tolerance) -> tuple[np.ndarray, np.ndarray]:
    """Pairs left after comparing signatures step by step."""
    equal = np.zeros(len(x), np.int32)
    for step, least in enumerate(least_matches(threshold, tolerance)):
        part = slice(step * STEP, (step + 1) * STEP)
        for low in range(0, len(x), 1 << 18):
            some = slice(low, low + (1 << 18))
            equal[some] += (left[x[some], part] == right[y[some], part]).sum(axis=1, dtype=np.int32)
        stay = equal >= least
        x, y, equal = x[stay], y[stay], equal[stay]
    return x, y


def _verified(left: list[np.ndarray], right: list[np.ndarray], x, y, threshold) -> np.ndarray:
    """Which pairs reach the threshold, by their sets.

    The first set's members are marked by a search once per row; all its partners are then looked up together.
    """
    passed = np.zeros(len(x), bool)
    sizes = np.array([len(s) for s in right])
    order = np.argsort(x, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(x[order])) + 1) if len(x) else []:
        own = left[x[group[0]]]
        for low in range(0, len(group), 256):
            some = group[low : low + 256]
            partners = y[some]
            flat = np.concatenate([right[j] for j in partners])
            hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            ends = np.cumsum(sizes[partners])
            common = np.add.reduceat(hit, ends - sizes[partners], dtype=np.int64)
            passed[some] = common >= threshold * (len(own) + sizes[partners] - common) - 1e-9
    return passed


def _forest(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for a, b in edges:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def _links(dealt: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``node, links, other``: per class and task its links counted with copies; and forest edges, with ``links`` 0.

    ``dealt`` has ``root, one, two, side, node, copies, signature, grams``; a task gets both blocks of a pair.
    """

    def block(rows):
        return (
            [r["node"] for r in rows],
            np.array([r["copies"] for r in rows], np.int64),
            np.frombuffer(b"".join(r["signature"] for r in rows), np.uint32).reshape(-1, VALUES),
            [np.frombuffer(r["grams"], np.uint64) for r in rows],
        )

    def linked(rows):
        first = [r for r in rows if r["side"] == 0]
        second = [r for r in rows if r["side"] == 1]
        # A block may be empty, so the pair's numbers say whether it is one block with itself, not its rows.
        same = rows[0]["one"] == rows[0]["two"]
        if len(first) < 2 if same else not first or not second:
            return
        a = block(first)
        b = a if same else block(second)
        x, y = _candidates(a[2], b[2], same)
        x, y = _pruned(a[2], b[2], x, y, threshold, tolerance)
        good = _verified(a[3], b[3], x, y, threshold)
        x, y = x[good], y[good]
        for nodes, own, others, weight in ((a[0], x, y, b[1]), (b[0], y, x, a[1])):
            sums = np.bincount(own, weight[others], len(nodes)).astype(np.int64)
            yield from ((nodes[i], int(sums[i]), None) for i in np.flatnonzero(sums))
        yield from ((p, 0, q) for p, q in _forest([(a[0][i], b[0][j]) for i, j in zip(x.tolist(), y.tolist())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last = [], None

        def batch(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["node", "links", "other"]
            )

        for some in batches:
            for at in range(0, some.num_rows, 256):
                for row in some.slice(at, 256).to_pylist():
                    this = (row["root"], row["one"], row["two"])
                    if this != last and rows:
                        yield batch(list(linked(rows)))
                        rows = []
                    last = this
                    rows.append(row)
        if rows:
            yield batch(list(linked(rows)))

    keys = ["root", "one", "two"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "side", "node").mapInArrow(
        run, "node bigint, links bigint, other bigint"
    )


def _grams(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``grams`` in place of the text."""
    names = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for part, texts in slices(batch, text):
                if len(hashes) > KEPT_WORDS:
                    hashes.clear()
                made = [shingles(value.split(), hashes).tobytes() for value in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made, pa.binary())], names=[*names, "grams"])

    kept = rows.select(*names, text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{kinds}, grams binary")


def _all_links(classes, keyed, text, threshold, tolerance, block_shingles) -> DataFrame:
    """What the tasks find for all components of candidates; see ``_links``."""
    # Each band's value links its classes to the smallest of them.
    cut = [F.xxhash64(F.lit(i), F.substring("signature", 1 + 4 * BAND * i, 4 * BAND)) for i in range(BANDS)]
    bands = classes.select("node", F.explode(F.array(*cut)).alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = bands.join(shared.select("band", "a"), "band").where("node <> a").select("a", F.col("node").alias("b"))
    roots = materialize(components(edges, "candidate-stars"), "candidates")

    # Shingles are made again for candidates only. A component's blocks hold about equally many of them.
    members = classes.join(roots, "node").select("node", "root", "copies", "signature", "n_grams", "first.row_a", "first.row_b")
    weights = members.groupBy("root").agg(F.sum("n_grams").alias("w"))
    weights = weights.select("root", F.ceil(F.col("w") / block_shingles).cast("int").alias("blocks"))
    members = members.join(weights, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = keyed.drop("key").join(members.drop("n_grams"), ["row_a", "row_b"])
    texts = materialize(_grams(texts, text).dropDuplicates(["node"]).drop("row_a", "row_b"), "candidate-grams")
    # A block meets each block from itself on: as the first of the pair, or as the second.
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.least("block", o).alias("one"), F.greatest("block", o).alias("two"), (F.col("block") > o).cast("int").alias("side")
        ),
    )
    dealt = texts.withColumn("_llm_p", F.explode(pair)).select("*", "_llm_p.one", "_llm_p.two", "_llm_p.side")
    return _links(dealt.drop("_llm_p", "block", "blocks"), threshold, tolerance)


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Per row: ``key, class_id, copy_id, n_links, is_first, row_a, row_b``.

    ``class_id`` is the smallest key of the documents reached over links, ``copy_id`` the smallest key with the same
    shingles, ``n_links`` the number of other rows with a similarity of at least the threshold. ``is_first`` marks rows
    whose content key is the class's first: those that agree in key and text share it.
    """
    keyed = docs.select(F.col(key).alias("key"), text, row_key(key, text).alias("_llm_id"))
    keyed = keyed.select("key", text, F.col("_llm_id.a").alias("row_a"), F.col("_llm_id.b").alias("row_b"))
    rows = materialize(sketches(keyed, text), "sketches")
    worded = rows.where("n_grams > 0")

    # Classes of equal sets; a class is known by a number made of its set's hash.
    first = F.struct(F.col("key").isNull().alias("null_key"), "key", "row_a", "row_b")
    classes = worded.groupBy("set_a", "set_b").agg(
        F.count(F.lit(1)).alias("copies"), F.min(first).alias("first"), F.min("signature").alias("signature"),
        F.min("n_grams").alias("n_grams"),
    )
    classes = materialize(classes.withColumn("node", F.xxhash64("set_a", "set_b")), "classes")

    with work_tables(docs.sparkSession):
        links = materialize(_all_links(classes, keyed, text, threshold, tolerance, block_shingles), "links", keep=True)

    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")), "stars")
    classes = classes.drop("signature").join(counts, "node", "left").join(groups, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    heads = classes.groupBy("root").agg(F.min("first").alias("head"))
    classes = classes.join(heads, "root").select(
        "set_a", "set_b", "first", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    # A class may hold many rows; an inner join's large partitions are split as it runs.
    joined = worded.drop("signature").join(classes, ["set_a", "set_b"]).select(
        "key",
        F.col("head.key").alias("class_id"),
        F.col("first.key").alias("copy_id"),
        "n_links",
        ((F.col("row_a") == F.col("head.row_a")) & (F.col("row_b") == F.col("head.row_b"))).alias("is_first"),
        "row_a",
        "row_b",
    )
    alone = rows.where("n_grams = 0").select(
        "key", F.col("key").alias("class_id"), F.col("key").alias("copy_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("is_first"), "row_a", "row_b",
    )
    return joined.unionByName(alone)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest key; all columns stay."""
    firsts = near_groups(docs, key, text, threshold).where("is_first").select(
        F.col("row_a").alias("_llm_row_a"), F.col("row_b").alias("_llm_row_b")
    )
    keyed = docs.withColumn("_llm_id", row_key(key, text)).withColumns({"_llm_row_a": "_llm_id.a", "_llm_row_b": "_llm_id.b"}).drop("_llm_id")
    # Rows that agree in key and text share a content key, of which one row is kept.
    kept = keyed.join(firsts, ["_llm_row_a", "_llm_row_b"], "left_semi").dropDuplicates(["_llm_row_a", "_llm_row_b"])
    return kept.drop("_llm_row_a", "_llm_row_b")
