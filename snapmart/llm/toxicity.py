"""Toxicity: a convolutional text classifier over hashed word embeddings, fitted by all tasks in numpy.

A word's embedding is the sum of rows of three hashed tables, two for the word, so that words that share one row still
differ, and one for its first letters, so that words not met before resemble their kin. Filters of one to three words slide over the text, the strongest answer of each is kept, and a logistic layer makes the score. The
convolution is linear until the maximum, so that scoring adds rows of precomputed tables, one per distinct word.

The model is fitted on every labelled text, whole. A broadcast bitmap of the labels' hashes keeps most other documents from
the shuffle, which deals texts and labels together by a hash of their key into chunks of about ``DOCS`` texts. In each pass every chunk goes on from the common parameters by itself, and Spark adds up what the chunks changed;
the mean, over the chunks that changed a row of a table, makes the next common parameters. Changes are added as whole
multiples of 2^-16, so that the sums do not depend on their order. The driver holds the parameters only. A fifth of the
texts are kept apart; counts of all their raw scores, in steps of 1/``GRID``, calibrate the score and find each
language's threshold with the best F1.
Language is no input of the score; it only chooses the threshold for ``flagged``.

Defined cases: null and empty texts have the score of a text without any word; without labels of both kinds every score
is the share of toxic labels, or 0. Of repeated labels of a document the highest counts. Rows are independent. Columns
stay, but for those named like a result. Every text is scored whole; memory is bounded by a slice or a chunk of texts, one
at least.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import schema_with, slices, with_columns
from snapmart.session import materialize, shuffles_freed

DOCS, WORDS = 2000, 1 << 20  # texts and words of a chunk, one text at least
EPOCHS, GRID = 8, 256
WIDTHS = (1, 2, 3)
FILTERS, SIZE = 8, 16
ROWS = 1 << 16
STEM = 4
TABLES = 3
BLOCK = 1 << 10  # rows of a table that are added up together
MOST_BITS = 1 << 26  # of the filter that keeps unlabelled documents from the shuffle; it is broadcast
UNIT = float(1 << 16)
PAD = max(WIDTHS) - 1  # empty words after each text, which filters may reach over
KEPT_WORDS = 100_000
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_hash(word: str) -> int:
    """32 bits of the word, above them 32 bits of its first letters; 0 is no word."""
    return zlib.crc32(word.encode()) | zlib.crc32(word[:STEM].encode()) << 32 or 1


def rows_of(hashes: np.ndarray) -> list[np.ndarray]:
    """The rows of the three tables; row 0 of each is for no word and stays zero."""
    word, stem = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    spread = word * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    return [((h % np.uint64(ROWS - 1) + np.uint64(1)) * (hashes > 0)).astype(np.int64) for h in (word, spread, stem)]


def padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each followed by ``PAD`` empty words and no shorter than one place; and where each begins."""
    gap = np.zeros(PAD + 1, np.uint64)
    parts = [x for t in texts for x in (t, gap[: PAD + (len(t) == 0)])]
    sizes = np.array([len(t) + PAD + (len(t) == 0) for t in texts])
    return np.concatenate(parts) if parts else gap[:0], np.cumsum(sizes) - sizes


@dataclass
class Network:
    tables: list[np.ndarray]  # TABLES of ROWS x SIZE
    filters: list[np.ndarray]  # per width: width x SIZE x FILTERS
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float]

    def embed(self, hashes: np.ndarray) -> np.ndarray:
        return sum(table[rows] for table, rows in zip(self.tables, rows_of(hashes)))


def _convolved(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    width = len(weights)
    places = len(x) - PAD
    total = x[:places] @ weights[0]
    for j in range(1, width):
        total += x[j : places + j] @ weights[j]
    return total + bias


def _pooled(network: Network, hashes: np.ndarray, starts: np.ndarray):
    """The strongest answers (text x filter of each width) and where they are."""
    x = network.embed(hashes)
    ends = np.r_[starts[1:], len(hashes)] - PAD
    best, where = [], []
    for weights, bias in zip(network.filters, network.biases):
        answers = _convolved(x, weights, bias)
        at = np.array([s + answers[s:e].argmax(axis=0) for s, e in zip(starts.tolist(), ends.tolist())])
        where.append(at)
        best.append(np.take_along_axis(answers, at, axis=0))
    return best, where


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adagrad:
    def __init__(self, rate: float):
        self.rate, self.sums = rate, {}

    def step(self, name, param, grad, rows=None) -> None:
        """With ``rows``, of a table: gradients of those rows only; equal rows are added up first."""
        sums = self.sums.setdefault(name, np.zeros_like(param))
        if rows is None:
            sums += grad * grad
            param -= self.rate * grad / (np.sqrt(sums) + 1e-6)
            return
        own, inverse = np.unique(rows, return_inverse=True)
        total = np.zeros((len(own), param.shape[1]), param.dtype)
        np.add.at(total, inverse, grad)
        sums[own] += total * total
        param[own] -= self.rate * total / (np.sqrt(sums[own]) + 1e-6)


def _fresh(rng: np.random.Generator) -> Network:
    new = lambda *shape: rng.normal(0, 0.25, shape).astype(np.float32)
    network = Network(
        [new(ROWS, SIZE) for _ in range(TABLES)], [new(w, SIZE, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS], new(len(WIDTHS) * FILTERS), 0.0, {},
    )
    for table in network.tables:
        table[0] = 0
    return network


def _learn(
    network: Network, texts: list[np.ndarray], toxic: np.ndarray, weights: np.ndarray, epochs: int, batch: int, rate: float,
    hidden: float, rng: np.random.Generator,
) -> _Adagrad:
    """Changes the parameters in place; the result knows which rows of the tables were changed."""
    total = np.array([network.bias], np.float32)
    adagrad = _Adagrad(rate)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(texts), batch):
            some = order[low : low + batch]
            hashes, starts = padded([texts[i][rng.random(len(texts[i])) >= hidden] for i in some])
            best, where = _pooled(network, hashes, starts)
            active = [np.maximum(b, 0) for b in best]
            features = np.concatenate(active, axis=1)
            score = _sigmoid(features @ network.out + total[0])
            back = ((score - toxic[some]) * weights[some] / weights[some].sum()).astype(np.float32)
            wide = back[:, None] * network.out
            adagrad.step("out", network.out, features.T @ back + 1e-4 * network.out)
            adagrad.step("bias", total, np.array([back.sum()], np.float32))
            rows = rows_of(hashes)
            touched, pushed = [], []
            for k, width in enumerate(WIDTHS):
                down = wide[:, k * FILTERS : (k + 1) * FILTERS] * (best[k] > 0)
                grad = np.zeros_like(network.filters[k])
                for j in range(width):
                    at = (where[k] + j).ravel()
                    x = network.embed(hashes[at]).reshape(*down.shape, SIZE)
                    grad[j] = np.einsum("dfs,df->sf", x, down)
                    touched.append(at)
                    pushed.append((down[:, :, None] * network.filters[k][j].T[None]).reshape(-1, SIZE))
                adagrad.step(f"filter{k}", network.filters[k], grad + 1e-4 * network.filters[k])
                adagrad.step(f"bias{k}", network.biases[k], down.sum(axis=0))
            at, push = np.concatenate(touched), np.concatenate(pushed)
            real = hashes[at] > 0
            for k, table in enumerate(network.tables):
                adagrad.step(f"table{k}", table, push[real], rows[k][at[real]])
    network.bias = float(total[0])
    return adagrad


def _forget_unused(network: Network, seen: list[np.ndarray]) -> None:
    """Rows of the tables that no text has used say nothing."""
    for table, rows in zip(network.tables, seen):
        unused = np.ones(ROWS, bool)
        unused[rows] = False
        table[unused] = 0


def fit(
    texts: list[np.ndarray], toxic: np.ndarray, weights: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.1,
    hidden: float = 0.2, seed: int = 3,
) -> Network:
    """Minimises the weighted log loss; ``hidden`` of the words are left out in each pass."""
    rng = np.random.default_rng(seed)
    network = _fresh(rng)
    _learn(network, texts, toxic, weights, epochs, batch, rate, hidden, rng)
    _forget_unused(network, rows_of(np.unique(np.concatenate(texts))) if texts else [[]] * TABLES)
    return network


def _dense(network: Network) -> np.ndarray:
    """The parameters beside the tables in a row."""
    parts = [*network.filters, *network.biases, network.out, np.array([network.bias])]
    return np.concatenate([np.asarray(p, np.float64).ravel() for p in parts])


def _set_dense(network: Network, values: np.ndarray) -> None:
    at = 0
    for part in (*network.filters, *network.biases, network.out):
        part[...] = values[at : at + part.size].reshape(part.shape)
        at += part.size
    network.bias = float(values[at])


def _copy(network: Network) -> Network:
    return Network(
        [t.copy() for t in network.tables], [f.copy() for f in network.filters], [b.copy() for b in network.biases],
        network.out.copy(), network.bias, {},
    )


def _perhaps_labelled(documents: DataFrame, known: DataFrame, key: str, labels: int) -> DataFrame:
    """``documents`` without most of those that have no label in ``known``; none that has one goes.

    A bit is set for each label's hash. Where labels outnumber the bits, fewer documents are recognised and more stay.
    """
    bits = min(MOST_BITS, 1 << max(15, (16 * labels).bit_length()))
    hashed = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    bucket, place = F.bitmap_bucket_number(hashed), F.bitmap_bit_position(hashed)
    table = known.select(bucket.alias("_llm_bucket"), place.alias("_llm_place")).groupBy("_llm_bucket").agg(
        F.bitmap_construct_agg("_llm_place").alias("_llm_bits")
    )
    byte = F.conv(F.hex(F.substring("_llm_bits", F.shiftright("_llm_place", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = documents.withColumns({"_llm_bucket": bucket, "_llm_place": place}).join(F.broadcast(table), "_llm_bucket")
    return marked.where(F.getbit(byte, (F.col("_llm_place") % 8).cast("int")) == 1).select(*documents.columns)


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """``part, key, toxic, lang, text``: one row for each key that has a label and a text, in the order of part and key.

    ``rows`` (key, toxic, own) are labels and documents beside each other, so that a text is shuffled once: to its part.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))).repartition("part")
    both = dealt.groupBy("part", "key").agg(F.max("toxic").alias("toxic"), F.min("own").alias("own"))
    both = both.where(F.col("toxic").isNotNull() & F.col("own").isNotNull())
    return both.select("part", "key", "toxic", "own.lang", "own.text").sortWithinPartitions("part", "key")


def _number_type(words: int) -> str:
    """Of the numbers of a chunk's distinct words, by which the chunk is stored."""
    return "<u2" if words <= 1 << 16 else "<u4"


def _chunks(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (key, toxic, own) as a table of chunks, the same however the rows were dealt before."""
    names = ["seed", "toxic", "held", "langs", "sizes", "words", "numbers"]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys, toxic, langs, words, held, size = None, [], [], [], [], [], 0
        known: dict[str, int] = {}

        def made() -> pa.RecordBatch:
            sizes = np.array([len(w) for w in words], "<i8")
            distinct, numbers = np.unique(np.concatenate(words), return_inverse=True)
            values = [
                zlib.crc32("\n".join(keys).encode()), np.array(toxic, "<f4").tobytes(), np.array(held, bool).tobytes(), list(langs),
                sizes.tobytes(), distinct.astype("<u8").tobytes(), numbers.astype(_number_type(len(distinct))).tobytes(),
            ]
            for some in (keys, toxic, langs, words, held):
                some.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for part, texts in slices(batch, "text"):
                for number, key, label, lang, value in zip(*[part.column(i).to_pylist() for i in range(4)], texts):
                    if keys and (number != last or size >= WORDS or len(keys) >= 2 * DOCS):
                        yield made()
                        size = 0
                    if len(known) > KEPT_WORDS:
                        known.clear()
                    own = words_of(value)
                    for w in own:
                        if w not in known:
                            known[w] = word_hash(w)
                    last = number
                    keys.append(key)
                    toxic.append(label)
                    langs.append(lang or "")
                    held.append(zlib.crc32(key.encode()) // 5 % 5 == 0)
                    words.append(np.array([known[w] for w in own], np.uint64))
                    size += len(own)
        if keys:
            yield made()

    kind = "seed long, toxic binary, held binary, langs array<string>, sizes binary, words binary, numbers binary"
    return materialize(_dealt(rows, parts).mapInArrow(run, kind), "toxicity-chunks")


def _read_chunks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row in range(batch.num_rows):
            seed, toxic, held, langs, sizes, words, numbers = (batch.column(i)[row].as_py() for i in range(7))
            ends, distinct = np.cumsum(np.frombuffer(sizes, "<i8")), np.frombuffer(words, "<u8")
            texts = np.split(distinct[np.frombuffer(numbers, _number_type(len(distinct)))], ends[:-1])
            yield seed, np.frombuffer(toxic, "<f4"), np.frombuffer(held, bool), langs, texts


def _epoch(chunks: DataFrame, network: Network, epoch: int, every: bool, rate: float = 0.1, batch: int = 64, hidden: float = 0.2):
    """One pass of all chunks over the texts to fit on: changes ``network`` to the mean; per table, the rows that texts use."""
    slower = rate / (1 + epoch / 2)
    width = SIZE + 2  # the changes, the chunks that made them, whether a text uses the row
    # Deleted after the pass; the parameters of all passes would lie on every executor's disk.
    shared = chunks.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        sums, dense, done = np.zeros((TABLES * ROWS, width), np.int32), None, 0
        before = _dense(network)
        for seed, toxic, held, _, texts in _read_chunks(batches):
            use = np.flatnonzero(~held | every)
            if not len(use):
                continue
            own, some = _copy(network), [texts[i] for i in use]
            rng = np.random.default_rng([3, epoch, seed])
            adagrad = _learn(own, some, toxic[use], np.ones(len(use)), 1, batch, slower, hidden, rng)
            done += 1
            change = np.rint((_dense(own) - before) * UNIT).astype(np.int64)
            dense = change if dense is None else dense + change
            used = rows_of(np.unique(np.concatenate(some)))
            for k in range(TABLES):
                at = np.flatnonzero(adagrad.sums[f"table{k}"].any(axis=1)) if f"table{k}" in adagrad.sums else np.empty(0, np.int64)
                moved = own.tables[k][at].astype(np.float64) - network.tables[k][at]
                sums[k * ROWS + at, :SIZE] += np.rint(moved * UNIT).astype(np.int32)
                sums[k * ROWS + at, SIZE] += 1
                sums[k * ROWS + used[k], SIZE + 1] = 1
        if dense is None:
            return
        blocks, ats, values = [-1], [b""], [np.r_[dense, done].astype("<i8").tobytes()]
        filled = sums[:, SIZE:].any(axis=1)
        for block in range(TABLES * ROWS // BLOCK):
            at = np.flatnonzero(filled[block * BLOCK : (block + 1) * BLOCK])
            if len(at):
                blocks.append(block)
                ats.append(at.astype("<i4").tobytes())
                values.append(sums[block * BLOCK + at].astype("<i4").tobytes())
        for i in range(len(blocks)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([blocks[i]], pa.int32()), pa.array([ats[i]], pa.binary()), pa.array([values[i]], pa.binary())],
                names=["block", "at", "sums"],
            )

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, whole = None, None

        def made() -> pa.RecordBatch:
            if last < 0:
                at, out = b"", (whole[:-1] / UNIT / whole[-1]).astype("<f8").tobytes()
            else:
                own = np.flatnonzero(whole[:, SIZE:].any(axis=1))
                at = own.astype("<i4").tobytes()
                moved = whole[own, :SIZE] / UNIT / np.maximum(whole[own, SIZE], 1)[:, None]
                out = np.c_[moved, whole[own, SIZE + 1] > 0].astype("<f4").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([last], pa.int32()), pa.array([at], pa.binary()), pa.array([out], pa.binary())], names=["block", "at", "sums"]
            )

        for batch in batches:
            for block, at, values in zip(*[c.to_pylist() for c in batch.columns]):
                if block != last:
                    if last is not None:
                        yield made()
                    last, whole = block, np.zeros((BLOCK, width) if block >= 0 else len(values) // 8, np.int64)
                if block < 0:
                    whole += np.frombuffer(values, "<i8")
                else:
                    whole[np.frombuffer(at, "<i4")] += np.frombuffer(values, "<i4").reshape(-1, width)
        if last is not None:
            yield made()

    kind = "block int, at binary, sums binary"
    with shuffles_freed(chunks.sparkSession):
        # One row per block of the tables' rows, and one for the other parameters, whatever the number of texts.
        found = chunks.mapInArrow(run, kind).repartition("block").sortWithinPartitions("block").mapInArrow(mean, kind).collect()
    shared.destroy()
    seen: list[list[np.ndarray]] = [[] for _ in range(TABLES)]
    for block, at, values in found:
        if block < 0:
            _set_dense(network, _dense(network) + np.frombuffer(values, "<f8"))
            continue
        rows = block * BLOCK % ROWS + np.frombuffer(at, "<i4")
        values = np.frombuffer(values, "<f4").reshape(len(rows), SIZE + 1)
        network.tables[block * BLOCK // ROWS][rows] += values[:, :SIZE]
        seen[block * BLOCK // ROWS].append(rows[values[:, SIZE] > 0])
    return [np.concatenate(s) if s else np.empty(0, np.int64) for s in seen]


def _score_counts(chunks: DataFrame, network: Network, every: bool) -> tuple[np.ndarray, ...]:
    """``langs, z, toxic, n``: the raw scores of the texts kept apart, in steps of 1/GRID, counted by language and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, toxic, held, langs, texts in _read_chunks(batches):
            use = np.flatnonzero(held | every)
            z = raw_scores(network, [texts[i] for i in use])
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in use], pa.string()), pa.array(np.rint(np.clip(z, -30, 30) * GRID).astype(np.int32), pa.int32()),
                 pa.array(toxic[use].astype(np.int32), pa.int32())],
                names=["lang", "z", "toxic"],
            )

    counts = chunks.mapInArrow(run, "lang string, z int, toxic int").groupBy("lang", "z", "toxic").agg(F.count("*").alias("n"))
    rows = sorted(map(tuple, counts.collect()))  # 61 * GRID steps for a language and label at most
    langs, z, toxic, n = zip(*rows)
    return np.array(langs, object), np.array(z) / GRID, np.array(toxic, np.float64), np.array(n, np.float64)


def raw_scores(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    out = []
    for low in range(0, len(texts), 256):
        hashes, starts = padded(texts[low : low + 256])
        best, _ = _pooled(network, hashes, starts)
        out.append(np.maximum(np.concatenate(best, axis=1), 0) @ network.out + network.bias)
    return np.concatenate(out) if out else np.empty(0)


def calibrate(z: np.ndarray, toxic: np.ndarray, weights: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and offset that make the sigmoid of the raw scores probabilities; by Newton steps, lightly held to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = _sigmoid(a * z + b)
        w = weights * np.maximum(p * (1 - p), 1e-9)
        g = np.array([(weights * (p - toxic) * z).sum() + (a - 1), (weights * (p - toxic)).sum() + b])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 0.05), b


def best_threshold(score: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> float:
    """Halfway between the scores that the best F1 parts; 0.5 if a label is absent."""
    if not (toxic == 1).any() or not (toxic == 0).any():
        return 0.5
    order = np.argsort(-score, kind="stable")
    hit, flagged = np.cumsum((weights * toxic)[order]), np.cumsum(weights[order])
    f1 = 2 * hit / (flagged + (weights * toxic).sum())
    last = np.r_[score[order][1:] < score[order][:-1], True]
    k = int(np.flatnonzero(last)[f1[last].argmax()])
    below = score[order][k + 1] if k + 1 < len(score) else 0.0
    return float((score[order][k] + below) / 2)


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """Fits on all labelled documents; ``labels`` has ``key`` and ``toxic``."""
    # Of the documents' type; a label whose key has no counterpart in it goes, as does one without a key.
    own_key = F.col(key).try_cast(documents.schema[key].dataType)
    known = labels.where(F.col("toxic").isNotNull() & (own_key == F.col(key))).select(own_key.alias(key), "toxic")
    known = materialize(known.groupBy(key).agg(F.max("toxic").cast("int").alias("toxic")), "toxicity-labels")
    count = known.count()
    # Of rows with one key the least by a hash is taken, so that a repeated key counts as much as another.
    own = F.struct(F.xxhash64(text, lang).alias("hash"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    as_key = F.col(key).cast("string").alias("key")
    texts = _perhaps_labelled(documents.select(key, text, lang), known, key, count).select(as_key, own.alias("own"))
    chunks = _chunks(known.select(as_key, "toxic").unionByName(texts, allowMissingColumns=True), max(1, -(-count // DOCS)))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), bool)
            toxic = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f4")
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(toxic.astype(np.int32))], names=["held", "toxic"])

    told = chunks.select("toxic", "held").mapInArrow(tell, "held boolean, toxic int").groupBy("held", "toxic").count().collect()
    labels_of = {held: {r["toxic"]: r["count"] for r in told if r["held"] == held} for held in (False, True)}
    total = {k: sum(part.get(k, 0) for part in labels_of.values()) for k in {r["toxic"] for r in told}}
    if len(total) < 2:
        share = float(next(iter(total))) if total else 0.0
        blank = Network(
            [np.zeros((ROWS, SIZE), np.float32)] * TABLES, [np.zeros((w, SIZE, FILTERS), np.float32) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32)] * len(WIDTHS), np.zeros(len(WIDTHS) * FILTERS, np.float32),
            float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), {"": 0.5},
        )
        return blank
    every = any(len(part) < 2 for part in labels_of.values())
    network = _fresh(np.random.default_rng(3))
    for epoch in range(EPOCHS):
        seen = _epoch(chunks, network, epoch, every)
    _forget_unused(network, seen)
    langs, z, toxic, n = _score_counts(chunks, network, every)
    a, b = calibrate(z, toxic, n)
    network.out, network.bias = network.out * np.float32(a), float(a * network.bias + b)
    score = _sigmoid(a * z + b)
    network.thresholds = {"": best_threshold(score, toxic, n)}
    for name in sorted(set(langs.tolist()) - {""}):
        own = langs == name
        if n[own & (toxic == 1)].sum() >= 5 and n[own & (toxic == 0)].sum() >= 5:
            network.thresholds[name] = best_threshold(score[own], toxic[own], n[own])
    return network


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Scorer:
    """Scores texts by adding up, per filter, rows made once for each distinct word."""

    def __init__(self, network: Network):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.known[""] = 0  # no word
        self.answers = [[np.zeros((1, FILTERS), np.float32) for _ in w] for w in self.network.filters]

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > KEPT_WORDS:
            self._forget()
        before, number = len(self.known), self.known.__getitem__
        places, sizes = [], []
        for text in texts:
            own = words_of(text)
            places.extend(map(number, own))
            extra = PAD + (not own)
            places.extend([0] * extra)
            sizes.append(len(own) + extra)
        new = list(self.known)[before:]
        if new:
            x = self.network.embed(np.array([word_hash(w) for w in new], np.uint64))
            self.answers = [
                [np.concatenate([old, x @ w[j]]) for j, old in enumerate(rows)]
                for rows, w in zip(self.answers, self.network.filters)
            ]
        at = np.array(places, np.int64)
        starts = np.cumsum(sizes) - sizes
        z = np.full(len(texts), self.network.bias, np.float64)
        inner = len(at) - PAD
        for k, (rows, bias) in enumerate(zip(self.answers, self.network.biases)):
            total = rows[0][at[:inner]]
            for j in range(1, len(rows)):
                total += rows[j][at[j : inner + j]]
            # Places that begin behind a text's end hold no word; as in fitting, they do not count.
            for j in range(PAD):
                total[starts[1:] - 1 - j] = -np.inf
            best = np.maximum.reduceat(total, starts, axis=0) + bias
            z += np.maximum(best, 0) @ self.network.out[k * FILTERS : (k + 1) * FILTERS]
        return _sigmoid(z)


def score(docs: DataFrame, network: Network, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network)
        for batch in batches:
            for part, texts in slices(batch, text):
                yield with_columns(part, [name], [pa.array(scorer.score(texts), pa.float64())])

    return docs.mapInArrow(run, schema_with(docs, **{name: "double"}))


def flag(scored: DataFrame, network: Network, lang: str = "lang") -> DataFrame:
    """``scored`` with ``flagged``: whether the score reaches the threshold of the document's language."""
    limit = F.lit(network.thresholds[""])
    for name, value in network.thresholds.items():
        if name:
            limit = F.when(F.col(lang) == name, F.lit(value)).otherwise(limit)
    return scored.withColumn("flagged", F.col("score") >= limit)
