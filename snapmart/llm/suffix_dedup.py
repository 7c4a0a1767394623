"""Repeated byte strings across documents, from the common-prefix interval tree of an enhanced suffix array.

Sorting every suffix of a corpus is not needed to find strings of ``length`` bytes that occur twice. Of the ``gram`` bytes
at each place of such a string, the ones with the smallest hash are its anchor; equal strings have the same anchor at the
same place. So the suffixes that start at anchors suffice, each with its context: all bytes that a string of ``length``
bytes around the anchor can reach. Equal contexts are counted before any text moves, and anchors that occur once go.

Spark sorts the remaining contexts by anchor and right-hand bytes: the suffix array. Per anchor, a stack scan over the
common prefixes of neighbours gives the interval tree. In each interval the contexts are ordered by their left-hand bytes;
those that agree to the left until they differ are a maximal repeat, with all its occurrences. A repeat counts if its two
sides add up to ``length``. An anchor with very many different contexts is parted by the place of the anchor in the
string: each half of the places shares more bytes, which tell more strings apart, until single places are left.

Defined cases: null texts are empty; texts below ``length`` bytes have no repeats; occurrences may overlap and lie in one
document; repeated rows repeat each other; a key may be null, as rows are told apart by a hash of key and text. An empty
table gives an empty result. Columns of the input stay, but for those named like a result column.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.common import row_key
from snapmart.session import materialize, work_tables

LENGTH = 400
#: Different contexts of one anchor that one task scans; an anchor with more is parted.
SCANNED = 50_000
#: Bytes of text hashed at a time, and of one text: places must fit into the low bits of a hash.
_BUFFER, _PLACE_BITS = 1 << 18, 24
_TABLE = np.random.default_rng(20240).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = np.random.default_rng(20241).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Reach:
    """How far contexts go: ``length`` bytes around anchors of ``gram`` bytes."""

    length: int = LENGTH

    @property
    def gram(self) -> int:
        """The largest power of two up to a third of the length."""
        return 1 << max(0, (self.length // 3).bit_length() - 1)

    @property
    def left(self) -> int:
        return self.length - self.gram


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place, by doubling."""
    h, width = _TABLE[data], 1
    while width < gram:
        h = h[:-width] * _FACTORS[width.bit_length()] + h[width:]
        width *= 2
    return (h ^ (h >> np.uint64(29))) * _FACTORS[0]


def anchor_places(data: np.ndarray, starts: list[int], ends: list[int], reach: Reach) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text in ``data``: the places of its anchors, from its start, and their hashes."""
    nothing = np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(data) < reach.length:
        return [nothing for _ in starts]
    hashes = _gram_hashes(data, reach.gram)
    bits = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~bits) | np.arange(len(hashes), dtype=np.uint64)
    span, width = reach.left + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    found = []
    for start, end in zip(starts, ends):
        if end - start < reach.length:
            found.append(nothing)
            continue
        place = (least[start : end - reach.length + 1] & bits).astype(np.int64)
        place = place[np.r_[True, place[1:] != place[:-1]]]
        found.append((place - start, hashes[place]))
    return found


def _anchors_of(texts: list[bytes], reach: Reach) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, places, hashes), many short texts at a time; long ones in overlapping parts."""
    group, held = [], 0

    def hashed():
        data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in group]).tolist()
        yield from zip(group, anchor_places(data, [0, *ends[:-1]], ends, reach))

    for i, text in enumerate(texts):
        if len(text) < reach.length:
            continue
        if len(text) > _BUFFER:
            places, hashes = [], []
            for at in range(0, len(text) - reach.length + 1, _BUFFER):
                part = np.frombuffer(text, np.uint8)[at : at + _BUFFER + reach.length - 1]
                (place, h), = anchor_places(part, [0], [len(part)], reach)
                places.append(place + at)
                hashes.append(h)
            place, first = np.unique(np.concatenate(places), return_index=True)
            yield i, place, np.concatenate(hashes)[first]
            continue
        group.append(i)
        held += len(text)
        if held >= _BUFFER:
            for j, (place, h) in hashed():
                yield j, place, h
            group, held = [], 0
    if group:
        for j, (place, h) in hashed():
            yield j, place, h


def anchors(keyed: DataFrame, text: str, reach: Reach) -> DataFrame:
    """``row_a, row_b, place, k, c``: each anchor, its hash and the hash of its context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [(t or "").encode() for t in part.column(2).to_pylist()]
                rows, places, hashes, contexts = [], [], [], []
                for i, place, h in _anchors_of(texts, reach):
                    rows.append(np.full(len(place), i))
                    places.append(place)
                    hashes.append(h)
                    data = texts[i]
                    for p in place.tolist():
                        low = max(0, p - reach.left)
                        contexts.append(xxhash.xxh64_intdigest(data[low : p + reach.length], p - low))
                if rows:
                    row = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(row),
                            part.column(1).take(row),
                            pa.array(np.concatenate(places).astype(np.int32)),
                            pa.array(np.concatenate(hashes).view(np.int64)),
                            pa.array(np.array(contexts, np.uint64).view(np.int64)),
                        ],
                        names=["row_a", "row_b", "place", "k", "c"],
                    )

    return keyed.select("row_a", "row_b", text).mapInArrow(
        run, "row_a bigint, row_b bigint, place int, k bigint, c bigint"
    )


def _contexts(firsts: DataFrame, keyed: DataFrame, text: str, reach: Reach) -> DataFrame:
    """``k, c, m, before, after``: the bytes of each different context, cut from one document that has it."""
    lists = firsts.groupBy("at.row_a", "at.row_b").agg(F.collect_list(F.struct("k", "c", "m", "at.place")).alias("_llm_list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_py().encode()
                wanted = batch.column(1)[i].as_py()
                for low in range(0, len(wanted), 2000):
                    some = wanted[low : low + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[pa.array([w[n] for w in some], pa.int64()) for n in ("k", "c", "m")],
                            pa.array([data[max(0, w["place"] - reach.left) : w["place"]] for w in some], pa.binary()),
                            pa.array([data[w["place"] : w["place"] + reach.length] for w in some], pa.binary()),
                        ],
                        names=["k", "c", "m", "before", "after"],
                    )

    return keyed.join(lists, ["row_a", "row_b"]).select(text, "_llm_list").mapInArrow(
        run, "k bigint, c bigint, m bigint, before binary, after binary"
    )


class Intervals:
    """The interval tree of the contexts of one anchor, which come in the order of ``after``."""

    def __init__(self, before: list[bytes], after: list[bytes], times: list[int], length: int):
        self.length, self.times = length, times
        self.wide = max((len(b) for b in (*before, *after)), default=0)
        self.right = [int.from_bytes(a.ljust(self.wide, b"\0")) for a in after]
        turned = [b[::-1] for b in before]
        self.left = [int.from_bytes(b.ljust(self.wide, b"\0")) for b in turned]
        self.right_size, self.left_size = [len(a) for a in after], [len(b) for b in before]
        self.rank = [0] * len(before)
        for rank, i in enumerate(sorted(range(len(before)), key=turned.__getitem__)):
            self.rank[i] = rank

    def _common(self, values: list[int], sizes: list[int], i: int, j: int) -> int:
        same = (self.wide * 8 - (values[i] ^ values[j]).bit_length()) // 8
        return min(same, sizes[i], sizes[j])

    def nodes(self) -> Iterator[tuple[int, list[int]]]:
        """(common prefix, members), each interval after those inside it."""
        stack: list[tuple[int, list[int]]] = []
        n = len(self.right)
        for i in range(n):
            members = [i]
            lcp = self._common(self.right, self.right_size, i, i + 1) if i + 1 < n else -1
            while stack and stack[-1][0] > lcp:
                depth = stack[-1][0]
                while stack and stack[-1][0] == depth:
                    other = stack.pop()[1]
                    if len(other) < len(members):
                        other, members = members, other
                    other.extend(members)
                    members = other
                yield depth, members
            stack.append((lcp, members))

    def repeats(self) -> Iterator[tuple[int, int, list[int]]]:
        """(bytes to the left, to the right, contexts): maximal repeats of at least ``length`` bytes.

        A context that occurs several times repeats as a whole. In an interval, contexts in the order of their left bytes
        form an interval tree again; its intervals are where left extensions begin to differ. One that lies inside a
        single smaller interval could be extended to the right, and was found there.
        """
        for i, times in enumerate(self.times):
            if times > 1 and self.left_size[i] + self.right_size[i] >= self.length:
                yield self.left_size[i], self.right_size[i], [i]
        inside = list(range(len(self.right)))  # the smaller interval that each context was last in
        for number, (right, members) in enumerate(self.nodes(), len(self.right)):
            ordered = sorted(members, key=self.rank.__getitem__)
            need, stack = self.length - right, []
            for at, i in enumerate(ordered):
                last = at + 1 == len(ordered)
                lcp = -1 if last else self._common(self.left, self.left_size, i, ordered[at + 1])
                start = at
                while stack and stack[-1][0] > lcp:
                    left, start = stack.pop()
                    if left >= need:
                        group = ordered[start : at + 1]
                        if any(inside[x] != inside[group[0]] for x in group):
                            yield left, right, group
                if not stack or stack[-1][0] < lcp:
                    stack.append((lcp, start))
            for i in members:
                inside[i] = number


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["k"] != last and rows:
                yield last, rows
                rows = []
            last = row["k"]
            rows.append(row)
    if rows:
        yield last, rows


def _scan(contexts: DataFrame, length: int) -> DataFrame:
    """``k, c, l, r``: how far the repeats that hold each context reach to both sides of its anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["k", "c", "l", "r"],
            )
            out.clear()
            return made

        for k, rows in _grouped(batches):
            tree = Intervals([x["before"] for x in rows], [x["after"] for x in rows], [x["m"] for x in rows], length)
            left, right = [-1] * len(rows), [0] * len(rows)
            for l, r, group in tree.repeats():
                for i in group:
                    left[i], right[i] = max(left[i], l), max(right[i], r)
            out.extend((k, rows[i]["c"], left[i], right[i]) for i in range(len(rows)) if left[i] >= 0)
            if len(out) >= 5000:
                yield batch()
        yield batch()

    dealt = contexts.repartition("k").sortWithinPartitions("k", "after", "c")
    return dealt.mapInArrow(run, "k bigint, c bigint, l int, r int")


def _last(column: str, n: int) -> Column:
    """The last ``n`` bytes, or all of fewer."""
    return F.substr(F.col(column), F.greatest(F.octet_length(column) - n + 1, F.lit(1)))


def _reaches(contexts: DataFrame, length: int, low: int, high: int, scanned: int) -> DataFrame:
    """``k, c, l, r`` for contexts in which the anchor lies ``low`` to ``high`` bytes behind the string's start."""
    counts = contexts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    if most <= scanned:
        return _scan(contexts, length)
    few = contexts.join(counts.where(F.col("n") <= scanned).select("k"), "k", "left_semi")
    many = contexts.join(counts.where(F.col("n") > scanned).select("k"), "k", "left_semi")
    found = _scan(few, length)
    if low == high:
        # One place: the string is the context.
        whole = F.octet_length("before") + F.octet_length("after") == length
        sums = many.where(whole).groupBy("k", "before", "after").agg(F.sum("m").alias("s")).where("s > 1")
        return found.unionByName(
            many.join(sums, ["k", "before", "after"]).select("k", "c", F.lit(low).alias("l"), F.lit(length - low).alias("r"))
        )
    middle = (low + high) // 2
    for a, b in ((low, middle), (middle + 1, high)):
        fits = (F.octet_length("before") >= a) & (F.octet_length("after") >= length - b)
        cut = many.where(fits).select(
            "k", "c", "m", _last("before", b).alias("before"), F.substring("after", 1, length - a).alias("after")
        )
        core = F.struct(_last("before", a).alias("x"), F.substring("after", 1, length - b).alias("y"))
        cut = cut.withColumns({"k2": F.xxhash64("k", core), "c2": F.xxhash64("before", F.lit(0), "after")})
        cut = materialize(cut, "contexts-cut")
        firsts = cut.groupBy("k2", "c2").agg(F.sum("m").alias("m"), F.min(F.struct("before", "after")).alias("x"))
        firsts = firsts.select(F.col("k2").alias("k"), F.col("c2").alias("c"), "m", "x.before", "x.after")
        shared = firsts.groupBy("k").agg(F.sum("m").alias("s")).where("s > 1").select("k")
        part = _reaches(
            materialize(firsts.join(shared, "k", "left_semi"), "contexts-parted"), length, a, b, scanned
        ).withColumnsRenamed({"k": "k2", "c": "c2"})
        found = found.unionByName(cut.select("k", "c", "k2", "c2").join(part, ["k2", "c2"]).select("k", "c", "l", "r"))
    return found.groupBy("k", "c").agg(F.max("l").alias("l"), F.max("r").alias("r"))


def spans(keyed: DataFrame, text: str = "text", length: int = LENGTH, scanned: int = SCANNED) -> DataFrame:
    """``row_a, row_b, spans``: per document with repeats, the covered byte ranges, unmerged, one per anchor."""
    reach = Reach(length)
    spark = keyed.sparkSession
    with work_tables(spark):
        found = materialize(anchors(keyed, text, reach), "anchors")
        # Stored, so that both sides of the join are plain and the partition of a frequent anchor is split.
        twice = found.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
        again = found.join(materialize(twice, "anchors-twice"), "k", "left_semi")
        again = materialize(again, "anchors-shared", keep=True)
    with work_tables(spark):
        firsts = again.groupBy("k", "c").agg(
            F.count(F.lit(1)).alias("m"), F.min(F.struct("row_a", "row_b", "place")).alias("at")
        )
        contexts = materialize(_contexts(firsts, keyed, text, reach).dropDuplicates(["k", "c"]), "contexts")
        reaches = materialize(_reaches(contexts, length, 0, reach.left, scanned), "reaches", keep=True)
    place = F.struct((F.col("place") - F.col("l")).alias("start"), (F.col("place") + F.col("r")).alias("stop"))
    return again.join(reaches, ["k", "c"]).groupBy("row_a", "row_b").agg(F.collect_set(place).alias("spans"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _whole_characters(data: bytes, start: int, stop: int) -> tuple[int, int]:
    """The characters of UTF-8 text that lie in the range wholly."""
    while start < len(data) and data[start] & 0xC0 == 0x80:
        start += 1
    while stop < len(data) and stop > start and data[stop] & 0xC0 == 0x80:
        stop -= 1
    return start, max(start, stop)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, whole_characters: bool = False,
    scanned: int = SCANNED, least_words: int = 0, spans_as: str = "spans", kept_as: str = "kept",
) -> DataFrame:
    """``docs`` with ``spans`` (merged byte ranges that repeat) and ``kept`` (the other bytes, as binary).

    With ``whole_characters``, characters that lie in a range only in part stay, so that ``kept`` is text again. Merged
    ranges that touch fewer than ``least_words`` words stay as well. ``spans_as`` and ``kept_as`` name the two results.
    """
    keyed = docs.drop(spans_as, kept_as).withColumn("_llm_id", row_key(key, text))
    ids = F.col("_llm_id.a").alias("row_a"), F.col("_llm_id.b").alias("row_b")
    ranges = spans(keyed.select(*ids, text), text, length, scanned)
    ranges = ranges.select(F.struct(F.col("row_a").alias("a"), F.col("row_b").alias("b")).alias("_llm_id"), F.col("spans").alias(spans_as))
    joined = keyed.join(ranges, "_llm_id", "left").drop("_llm_id")
    names = [c for c in joined.columns if c != spans_as]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                cut, kept = [], []
                for value, own in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist()):
                    data = (value or "").encode()
                    own = merged([(s["start"], s["stop"]) for s in own])
                    if whole_characters:
                        own = merged([r for r in (_whole_characters(data, *r) for r in own) if r[0] < r[1]])
                    if least_words:
                        own = [(a, b) for a, b in own if len(data[a:b].split()) >= least_words]
                    edges = [0, *[e for r in own for e in r], len(data)]
                    cut.append([{"start": a, "stop": b} for a, b in own])
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(cut, part.schema[-1].type), pa.array(kept, pa.binary())],
                    names=[*names, spans_as, kept_as],
                )

    repeated = joined.where(F.col(spans_as).isNotNull()).select(*names, spans_as)
    none = F.array().cast(joined.schema[spans_as].dataType)
    clean = joined.where(F.col(spans_as).isNull()).select(
        *names, none.alias(spans_as), F.coalesce(F.col(text), F.lit("")).cast("binary").alias(kept_as)
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in clean.schema.fields)
    return clean.unionByName(repeated.mapInArrow(run, kinds))
