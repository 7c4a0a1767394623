"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

Texts are cut into words where no piece of the vocabulary can reach across. All distinct words of a slice lie in flat
numpy arrays of symbols. In each round every word finds its smallest pair rank and merges the leftmost pairs of that rank
at once; merged symbols are compacted away, and words without a pair leave. A task keeps the words it has met.

Merging several equal-ranked pairs of a word in one round is the same as one after the other as long as no pair that
arises ranks as low; a word in which one does merges only its leftmost pair in that round.

Defined cases: null and empty texts have no ids; characters outside the vocabulary become byte pieces, or the unknown
piece if the model has none. Rows are independent, so repeated rows and keys do not matter. Columns stay; one named like
the result is replaced. Memory is bounded by a slice of texts, one text at least, and the kept words.
"""

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapmart.llm.common import schema_with, slices, with_columns

SPACE = "▁"
_NONE = np.iinfo(np.int32).max
#: Distinct words that a task keeps before it starts anew.
KEPT_WORDS = 200_000


class Vocabulary:
    """The model's pieces as tables: symbols of characters, merged symbols and ranks of pairs, bytes of ids."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("  ﬁ x\t ") != SPACE * 3 + "ﬁ" + SPACE + "x\t" + SPACE:
            raise ValueError("only models that leave texts as they are and put a space in front are supported")
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        symbol = {model.id_to_piece(i): i for i in plain}
        self.unknown = model.unk_id()
        self.byte_ids = np.full(256, self.unknown, np.int32)
        spelled = [b""] * size
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.byte_ids[value] = i
                spelled[i] = bytes([value])
        for piece, i in symbol.items():
            spelled[i] = piece.replace(SPACE, " ").encode()
        spelled[self.unknown] = " ⁇ ".encode()
        self.lead_space = np.array([s[:1] == b" " for s in spelled])
        self.lead_space[[i for i in range(size) if model.is_byte(i) or model.is_unknown(i)]] = False
        self.has_bytes = bool((self.byte_ids != self.unknown).any())
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.array([len(s) for s in spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length

        # Equal scores share a rank; the highest score has rank 0.
        scores = np.array([model.get_score(i) for i in plain])
        levels, place = np.unique(-scores, return_inverse=True)
        rank = dict(zip(plain, place.tolist()))
        inner = dict(symbol)  # characters that only occur inside pieces get symbols of their own
        for piece in symbol:
            for ch in piece:
                inner.setdefault(ch, size + len(inner))
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, s in inner.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = s
        self.size, self.base = size, size + len(inner) + 1
        pairs = {}
        for piece, s in symbol.items():
            for cut in range(1, len(piece)):
                left, right = inner.get(piece[:cut]), inner.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = s
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_symbol = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.pair_rank = np.array([rank[s] for s in self.pair_symbol.tolist()], np.int32)
        # A space can only follow a space inside a piece, and a line break never joins: cuts that no piece reaches across.
        if any(SPACE in p.lstrip(SPACE) for p in symbol) or any("\n" in p and len(p) > 1 for p in symbol):
            raise ValueError("the vocabulary has pieces across words")

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; pairs without a piece have the largest rank."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], _NONE), np.where(hit, self.pair_symbol[at], -1)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and how many each word has. Words are not empty."""
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    symbol, start = vocab.of_char[chars], np.arange(len(chars))
    rank, merged = np.full(len(chars), _NONE, np.int32), np.full(len(chars), -1, np.int32)
    inside = np.flatnonzero(word[1:] == word[:-1])
    rank[inside], merged[inside] = vocab.pairs(symbol[inside], symbol[inside + 1])
    done: list[tuple[np.ndarray, np.ndarray]] = []

    while len(symbol):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        length = np.diff(np.r_[first, len(word)])
        least = np.repeat(np.minimum.reduceat(rank, first), length)
        over = least == _NONE
        if 4 * over.sum() >= len(over) or not (~over).any():
            done.append((start[over], symbol[over]))
            on = ~over
            symbol, start, word, rank, merged, least = (a[on] for a in (symbol, start, word, rank, merged, least))
            if not len(symbol):
                break
        here = _leftmost(vocab, symbol, word, rank, merged, least)
        symbol[here] = merged[here]
        keep = np.ones(len(symbol), bool)
        keep[here + 1] = False
        place = np.cumsum(keep) - 1
        symbol, start, word, rank, merged = (a[keep] for a in (symbol, start, word, rank, merged))
        new = place[here]
        stale = np.unique(np.r_[new, new[new > 0] - 1])
        rank[stale], merged[stale] = _NONE, -1
        stale = stale[stale + 1 < len(word)]
        stale = stale[word[stale] == word[stale + 1]]
        rank[stale], merged[stale] = vocab.pairs(symbol[stale], symbol[stale + 1])

    start, symbol = (np.concatenate(parts) for parts in zip(*done))
    order = np.argsort(start, kind="stable")
    start, symbol = start[order], symbol[order]
    return _ids(vocab, chars, start, symbol, words)


def _leftmost(vocab, symbol, word, rank, merged, least) -> np.ndarray:
    """Places of the pairs to merge now: in each word those of its smallest rank, from the left, without overlap."""
    here = np.flatnonzero((rank == least) & (rank != _NONE))
    run = np.r_[True, np.diff(here) != 1]
    offset = np.arange(len(here)) - np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))
    here = here[offset % 2 == 0]
    leads = np.r_[True, word[here[1:]] != word[here[:-1]]]
    if leads.all():
        return here
    # Pairs that arise: with the symbol after, as it stands, and with the symbol before, after its own merge.
    last = len(symbol) - 1
    after = np.minimum(here + 2, last)
    late = np.where((here + 2 <= last) & (word[after] == word[here]), vocab.pairs(merged[here], symbol[after])[0], _NONE)
    chosen = np.zeros(len(symbol), bool)
    chosen[here] = True
    before = np.maximum(here - 1, 0)
    left = np.where((here >= 2) & chosen[here - 2], merged[here - 2], symbol[before])
    early = np.where((here >= 1) & (word[before] == word[here]), vocab.pairs(left, merged[here])[0], _NONE)
    unsafe = np.zeros(word[-1] + 1, bool)
    unsafe[word[here[np.minimum(late, early) <= rank[here]]]] = True
    return here[leads | ~unsafe[word[here]]]


def _ids(vocab, chars, start, symbol, words) -> tuple[np.ndarray, np.ndarray]:
    """Symbols to ids; characters without a piece become their bytes."""
    lengths = np.array([len(w) for w in words])
    word = np.searchsorted(np.cumsum(lengths), start, side="right")
    foreign = (symbol < 0) | (symbol >= vocab.size)
    if not foreign.any():
        return symbol, np.bincount(word, minlength=len(words))
    count = np.ones(len(symbol), np.int64)
    coded = [chr(c).encode() for c in chars[start[foreign]].tolist()]
    if vocab.has_bytes:
        count[foreign] = [len(b) for b in coded]
        filled = vocab.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
    else:
        filled = np.full(len(coded), vocab.unknown, np.int32)
    ids = np.repeat(symbol, count)
    ids[np.repeat(foreign, count)] = filled
    return ids, np.bincount(np.repeat(word, count), minlength=len(words))


class _Words(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes texts, keeping the ids of words met before."""

    _word = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._forget()

    def _forget(self) -> None:
        self.known, self.flat = _Words(), np.empty(0, np.int32)
        self.length, self.start = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if len(self.known) > KEPT_WORDS:
            self._forget()
        number, before = self.known.__getitem__, len(self.known)
        numbers, counts = [], []
        for text in texts:
            words = self._word.findall(SPACE + text.replace(" ", SPACE)) if text else []
            counts.append(len(words))
            numbers.extend(map(number, words))
        if len(self.known) > before:
            new = list(self.known)[before:]
            ids, length = merge_words(self.vocab, new)
            self.flat, self.length = np.r_[self.flat, ids], np.r_[self.length, length]
            self.start = np.cumsum(self.length) - self.length
        numbers = np.array(numbers, np.int64)
        ids = ragged(self.flat, self.start[numbers], self.length[numbers])
        ends = np.r_[0, np.cumsum(self.length[numbers])]
        return ids, np.diff(ends[np.r_[0, np.cumsum(counts)]])


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start:start + length]`` one after another."""
    total = int(length.sum())
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return flat[shift + np.arange(total)]


def _each_byte(error):
    return ("�", error.start + 1)


codecs.register_error("snapmart-each-byte", _each_byte)


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of one sequence of ids: the space in front goes, each invalid byte becomes a replacement character."""
    ids = ids[(ids >= 0) & (ids < vocab.size)]
    runs = []  # ids without text part runs of byte pieces
    for run in np.split(ids, np.flatnonzero(vocab.spelled_length[ids] == 0)):
        raw = b"".join(
            ragged(vocab.spelled, vocab.spelled_start[some], vocab.spelled_length[some]).tobytes()
            for some in (run[at : at + 500_000] for at in range(0, len(run), 500_000))
        )
        runs.append(raw.decode("utf-8", "snapmart-each-byte"))
    shown = ids[vocab.spelled_length[ids] > 0]
    text = "".join(runs)
    return text[1:] if len(shown) and vocab.lead_space[shown[0]] else text


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text; ``model`` is a path that executors can read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(model))
        for batch in batches:
            for part, texts in slices(batch, text):
                flat, counts = encoder.encode(texts)
                offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
                yield with_columns(part, [ids], [pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))])

    return df.mapInArrow(run, schema_with(df, **{ids: "array<int>"}))


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids; a null list gives empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            for at in range(0, len(lists), 256):
                some = lists.slice(at, 256)
                texts = [decode_ids(vocab, np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64)) if x.is_valid else "" for x in some]
                yield with_columns(batch.slice(at, 256), [text], [pa.array(texts, pa.string())])

    return df.mapInArrow(run, schema_with(df, **{text: "string"}))
