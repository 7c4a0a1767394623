"""Best-fit packing of token pieces into sequences by bin completion.

Texts become token pieces; pieces of full length are sequences of their own. What is left is a multiset of lengths below
the capacity, so its histogram, at most ``capacity`` numbers, says all that packing needs. On the histogram the largest
remaining length is completed again and again by an undominated filling; whole runs of equal sequences are laid at once.
A branch-and-bound search looks for better completions, starting from the best-fit solution. Spark then deals the pieces
to the sequences by their rank among pieces of equal length; only the histogram and the plan, both bounded by the
capacity, pass through the driver.

Defined cases: a null text is empty and gives one piece, the end token. Repeated rows are packed each. Ties between
pieces of equal length are broken by key and piece number; equal ones are interchangeable. An empty table gives an empty
plan. Columns of the input besides key and text are not carried.
"""

import base64
import heapq
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import slices
from snapmart.session import materialize

CAPACITY = 1024
#: Steps of the search for a better plan; the best-fit solution stands when they run out.
SEARCH_STEPS = 20_000
#: Tasks that rank the pieces of one length.
SALTS = 64

Plan = list[tuple[dict[int, int], int]]  # what a sequence holds (length: how often), and how many such sequences


@lru_cache(maxsize=2)
def _encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(
    docs: DataFrame, ranks_path: str, pattern: str, end_id: int, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """``key, piece, start, length, ids``: each text's tokens and the end token, cut into pieces if over ``capacity``.

    All pieces but the first are full. ``ids`` is binary: little-endian unsigned 32-bit numbers.
    """

    def cut(ids: np.ndarray) -> Iterator[tuple[int, int]]:
        first = (len(ids) - 1) % capacity + 1
        yield 0, first
        for start in range(first, len(ids), capacity):
            yield start, capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_path, pattern)
        for batch in batches:
            for part, texts in slices(batch, text):
                row, number, start, length, ids = [], [], [], [], []
                for i, value in enumerate(texts):
                    tokens = np.array([*encoding.encode_ordinary(value), end_id], "<u4")
                    for n, (at, size) in enumerate(cut(tokens)):
                        row.append(i)
                        number.append(n)
                        start.append(at)
                        length.append(size)
                        ids.append(tokens[at : at + size].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index(key)).take(pa.array(row, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=[key, "piece", "start", "length", "ids"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids binary"
    )


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Largest first; each sequence takes the largest length that still fits until none does."""
    left, plan = dict(counts), []
    sizes = sorted((s for s, n in left.items() if n), reverse=True)
    while sizes:
        filling, room = Counter(), capacity
        for size in sizes:
            fits = min(room // size, left[size])
            if fits:
                filling[size] += fits
                room -= fits * size
        sizes = _lay(plan, left, sizes, filling)
    return plan


def _lay(plan: Plan, left: dict[int, int], sizes: list[int], filling: dict[int, int]) -> list[int]:
    """Lays as many equal sequences as what is left allows; the sizes that remain."""
    times = min(left[s] // n for s, n in filling.items())
    plan.append((dict(filling), times))
    for s, n in filling.items():
        left[s] -= n * times
    return [s for s in sizes if left[s]]


def _reachable(left: dict[int, int], sizes: list[int], most: int) -> np.ndarray:
    """Sums up to ``most`` that the remaining lengths can make: ``made[s]`` by lengths of at most ``s`` each.

    Row ``i`` is for ``sizes[i:]``. Multiples are added by doubling, as bits of one integer per row.
    """
    rows, bits, mask = [], 1, (1 << (most + 1)) - 1
    for size in reversed(sizes):
        n, step = min(left[size], most // size), 1
        while n > 0:
            take = min(step, n)
            bits |= (bits << (take * size)) & mask
            n, step = n - take, step * 2
        rows.append(bits)
    return rows[::-1]


def fillings(left: dict[int, int], sizes: list[int], capacity: int, most: int) -> Iterator[tuple[dict[int, int], int]]:
    """Undominated completions of the largest length, least waste first, ``most`` of them; with their waste.

    A filling dominates another if its parts are at least as large; so parts are taken as large as possible, and for one
    waste the filling with fewer and larger parts comes first. What no subset can fill is never entered.
    """
    largest = sizes[0]
    room = capacity - largest
    rest = dict(left)
    rest[largest] -= 1
    open_sizes = [s for s in sizes if rest[s] and s <= room]
    made = _reachable(rest, open_sizes, room) if open_sizes else []

    def search(i: int, target: int, held: tuple) -> Iterator[tuple]:
        if target == 0:
            yield held
            return
        if i == len(open_sizes) or not (made[i] >> target) & 1:
            return
        size = open_sizes[i]
        for n in range(min(rest[size], target // size), -1, -1):
            yield from search(i + 1, target - n * size, held + ((size, n),) if n else held)

    found = 0
    for waste in range(room + 1):
        if waste < room and not (made and (made[0] >> (room - waste)) & 1):
            continue
        for held in search(0, room - waste, ()):
            filling = Counter({largest: 1})
            for s, n in held:
                filling[s] += n
            if not _dominated(filling, rest, capacity):
                yield dict(filling), waste
                found += 1
                if found == most:
                    return


def _dominated(filling: dict[int, int], rest: dict[int, int], capacity: int) -> bool:
    """Whether a larger remaining length could take the place of one part without overfilling."""
    room = capacity - sum(s * n for s, n in filling.items())
    return room > 0 and any(
        rest.get(s + more, 0) > filling.get(s + more, 0) for s in list(filling)[1:] for more in range(1, room + 1)
    )


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that no plan can do without.

    Lengths over ``capacity - k`` fill a sequence alone as far as those of at least ``k`` go; those over one half need one
    each, and only their room is left for the rest.
    """
    n = np.zeros(capacity + 1, np.int64)
    for size, times in counts.items():
        n[size] = times
    count, total = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    half, best = capacity // 2, -(-int(total[capacity]) // capacity)
    for k in range(1, half + 1):
        alone, large = count[capacity] - count[capacity - k], count[capacity - k] - count[half]
        room = large * capacity - (total[capacity - k] - total[half])
        over = total[half] - total[k - 1] - room
        best = max(best, int(alone + large + max(0, -(-over // capacity))))
    return best


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> Plan:
    """The plan with the fewest sequences that the search finds; never more than the best-fit plan has.

    Nodes are tried in the order of how often their way departs from the first completion, so that whole plans are
    reached at once. A way ends when what it has wasted rules out fewer sequences than the best plan has; the search ends
    at the lower bound.
    """
    counts = {int(s): int(n) for s, n in counts.items() if n}
    total, bound = sum(s * n for s, n in counts.items()), lower_bound(counts, capacity)
    best = best_fit_plan(counts, capacity)
    fewest, spent, tick = sum(n for _, n in best), 0, 0
    # (departures, order, choice here, way: the last step and the way before it)
    waiting = [(0, 0, 0, None)]
    while waiting and fewest > bound and spent < steps:
        departures, _, choice, way = heapq.heappop(waiting)
        plan = []
        while way:
            step, way = way
            plan.append(step)
        plan.reverse()
        left, used, waste = dict(counts), 0, 0
        for filling, times in plan:
            for size, n in filling.items():
                left[size] -= n * times
            used += times
            waste += times * (capacity - sum(size * n for size, n in filling.items()))
        way = None
        for step in plan:
            way = (step, way)
        while spent < steps and -(-(total + waste) // capacity) < fewest:
            sizes = sorted((s for s, n in left.items() if n), reverse=True)
            if not sizes:
                best, fewest = plan, used
                break
            spent += 1
            found = list(fillings(left, sizes, capacity, choice + 2))
            if choice >= len(found):
                break
            if choice + 1 < len(found):
                tick += 1
                heapq.heappush(waiting, (departures + 1, tick, choice + 1, way))
            filling, lost = found[choice]
            times, choice = min(left[s] // n for s, n in filling.items()), 0
            for size, n in filling.items():
                left[size] -= n * times
            plan.append((filling, times))
            way = (plan[-1], way)
            used, waste = used + times, waste + lost * times
    return best


def slots(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, last rank, per sequence, first sequence, offset)."""
    given: Counter = Counter()
    out, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for size, n in sorted(filling.items(), reverse=True):
            out.append((size, given[size], given[size] + n * times - 1, n, sequence, offset))
            given[size] += n * times
            offset += n * size
        sequence += times
    return out


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> DataFrame:
    """``pieces`` (with ``key, piece, length``) with ``sequence_id, offset``; their number is as small as the plan's.

    ``pieces`` is read three times, so let it be a stored table.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    plan = plan_sequences(counts, capacity, steps)

    # Ranks within a length: by salt, as one length may hold much of the data, then offset by the salts before.
    salted = pieces.withColumn("_llm_salt", F.pmod(F.xxhash64(key, "piece"), F.lit(SALTS)).cast("int"))
    sums = {(r[0], r[1]): r[2] for r in salted.groupBy("length", "_llm_salt").count().collect()}  # capacity * SALTS at most
    before, base = Counter(), []
    for (size, salt), n in sorted(sums.items()):
        base.append((size, salt, before[size]))
        before[size] += n
    base = spark.createDataFrame(base, "length bigint, _llm_salt int, _llm_base bigint")
    ranks = "row_number() over (partition by length, _llm_salt order by `{0}`, piece) - 1".format(key)
    ranked = salted.withColumn("_llm_row", F.expr(ranks)).join(F.broadcast(base), ["length", "_llm_salt"])
    ranked = ranked.withColumn("_llm_rank", F.col("_llm_base") + F.col("_llm_row"))
    # A few ranges of ranks for each length: bounded by the capacity, not by the data.
    where = spark.createDataFrame(
        slots(plan), "length bigint, _llm_first bigint, _llm_last bigint, _llm_per bigint, _llm_sequence bigint, _llm_offset bigint"
    )
    at = F.col("_llm_rank") - F.col("_llm_first")
    joined = ranked.join(F.broadcast(where), "length").where(F.col("_llm_rank").between(F.col("_llm_first"), F.col("_llm_last")))
    return joined.select(
        *[c for c in pieces.columns if c not in ("sequence_id", "offset")],
        (F.col("_llm_sequence") + F.floor(at / F.col("_llm_per"))).cast("long").alias("sequence_id"),
        (F.col("_llm_offset") + (at % F.col("_llm_per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_texts(
    docs: DataFrame, ranks_path: str, pattern: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset``: the plan, with a checksum of each piece's tokens."""
    cut = pieces(docs, ranks_path, pattern, end_id, key, text)
    narrow = materialize(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return pack(narrow, key)
