"""Language identification by a linear-chain conditional random field over words.

Each word's emission scores are sums of learned weights: hashed character n-grams with word boundaries, prefixes and
suffixes, and whether the word is in a language's learned lexicon. Learned transitions tie neighbouring words, so that
code-switched text is labelled word by word with forward-backward. A text's language has the largest share of the words'
posterior probability; that share is the score.

The model is fitted in numpy on a bounded sample, ``DOCS`` texts of each language with ``WORDS`` consecutive words each,
whose pieces are strung together across languages. Everything is predicted on whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if no labelled text exists.
Ties go to the language that comes first in the alphabet. Rows are independent. Columns stay, but for those named like
a result. Memory is bounded by a slice of texts, one text at least.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapmart.llm.common import bounded_sample, schema_with, slices, with_columns

UNKNOWN = "und"
DOCS, WORDS = 400, 150
BUCKETS = 1 << 17
KEPT_WORDS = 150_000
SLICE = 2_000_000
_WORD = re.compile(r"[^\W\d_]+")
_FACTORS = np.random.default_rng(61).integers(0, 1 << 63, (5, 5), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OPEN, _CLOSE = ord("^"), ord("$")  # no letters, so they mark the ends of words


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter."""
    found = _WORD.findall(text.lower())
    if found and not any(map(str.isalpha, found)) and not any(c.isalpha() for w in found for c in w):
        return []
    return found


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words in a row, and where each word's begin.

    All 2- and 3-grams of the word with its boundaries, and its first and last three letters.
    """
    chars = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners = [], []
    for n in (2, 3, 4):
        if len(chars) < n:
            continue
        h = sum((chars[i : len(chars) - n + 1 + i] * _FACTORS[n][i] for i in range(n)), np.uint64(n))
        inside = word[: len(chars) - n + 1] == word[n - 1 :]
        if n == 4:
            inside &= (chars[: len(chars) - 3] == _OPEN) | (chars[3:] == _CLOSE)
        h = (h ^ (h >> np.uint64(32))) * _FACTORS[0][n]
        buckets.append((h[inside] >> np.uint64(40)) % np.uint64(BUCKETS))
        owners.append(word[: len(chars) - n + 1][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(words)))
    return np.concatenate(buckets)[order].astype(np.int64), first


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Posterior of each word's label, for sequences that follow one another in ``scores``; by forward-backward.

    With ``pairs``, also the expected number of each transition. All sequences advance together, the longest first.
    """
    step = np.exp(transitions - transitions.max())
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    alpha = np.empty_like(emit)
    now = None
    for t in range(longest):
        at = start[: active[t]] + t
        now = emit[at] if t == 0 else (now[: active[t]] @ step) * emit[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    expected = np.zeros_like(step)
    beta = np.ones((len(lengths), scores.shape[1]), emit.dtype)
    out = alpha
    for t in range(longest - 1, 0, -1):
        m = active[t]
        at = start[:m] + t
        ahead = emit[at] * beta[:m]
        if pairs:
            before = alpha[at - 1]
            total = ((before @ step) * ahead).sum(axis=1, keepdims=True)
            expected += step * ((before / total).T @ ahead)
        out[at] *= beta[:m]
        back = ahead @ step.T
        beta[:m] = back / back.sum(axis=1, keepdims=True)
    if longest:
        out[start[: active[0]]] *= beta[: active[0]]
        out /= out.sum(axis=1, keepdims=True)
    return (out, expected) if pairs else out


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket by language
    lexicon: dict[str, int]
    lexicon_weights: np.ndarray  # language of the lexicon by language
    transitions: np.ndarray
    seen: np.ndarray  # buckets that the training texts have

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' scores, and the share of each word's features that the training texts have."""
        bucket, first = word_features(words)
        scores = np.add.reduceat(self.weights[bucket], first, axis=0)
        known = np.array([self.lexicon.get(w, -1) for w in words])
        scores[known >= 0] += self.lexicon_weights[known[known >= 0]]
        familiar = np.add.reduceat(self.seen[bucket].astype(np.float32), first) / np.diff(np.r_[first, len(bucket)])
        return scores, familiar


def learned_lexicon(segments: list[tuple[list[str], int]], least: int = 2, share: float = 0.8) -> dict[str, int]:
    """Words that occur ``least`` times, mostly in one language."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for words, label in segments:
        for word in words:
            counts[word][label] += 1
    out = {}
    for word, by in counts.items():
        (label, n), total = by.most_common(1)[0], sum(by.values())
        if total >= least and n >= share * total:
            out[word] = label
    return out


def code_switched(segments, labels: int, sequences: int, rng) -> tuple[list[list[str]], list[np.ndarray]]:
    """Training sequences of one to three pieces, 3 to 30 words each, every piece of a random language."""
    by = [[w for w, label in segments if label == k and w] for k in range(labels)]
    by = [(k, texts) for k, texts in enumerate(by) if texts]
    texts, truth = [], []
    for _ in range(sequences):
        words, marks = [], []
        for _ in range(rng.integers(1, 4)):
            label, own = by[rng.integers(len(by))]
            text = own[rng.integers(len(own))]
            size = int(rng.integers(3, 31))
            at = int(rng.integers(0, max(1, len(text) - size + 1)))
            words += text[at : at + size]
            marks += [label] * len(text[at : at + size])
        texts.append(words)
        truth.append(np.array(marks))
    return texts, truth


def fit(
    segments: list[tuple[list[str], str]], sequences: int = 4000, batch: int = 100, epochs: int = 4, rate: float = 0.05,
    seed: int = 7,
) -> Model:
    """Maximises the conditional likelihood of the labels by Adam over mini-batches."""
    rng = np.random.default_rng(seed)
    languages = sorted({label for _, label in segments})
    n = len(languages)
    marked = [(words, languages.index(label)) for words, label in segments]
    seen = np.zeros(BUCKETS, bool)
    if not any(words for words, _ in marked):
        return Model([], np.zeros((BUCKETS, 0), np.float32), {}, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32), seen)
    seen[word_features(sorted({w for words, _ in marked for w in words}))[0]] = True
    lexicon = learned_lexicon(marked)
    texts, truth = code_switched(marked, n, sequences, rng)
    params = [np.zeros((BUCKETS, n), np.float32), np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    tick = 0
    for _ in range(epochs):
        order = rng.permutation(sequences)
        for low in range(0, sequences, batch):
            some = order[low : low + batch]
            lengths = np.array([len(texts[i]) for i in some])
            words, word_at = np.unique(np.concatenate([np.array(texts[i], object) for i in some]), return_inverse=True)
            words = words.tolist()
            bucket, starts = word_features(words)
            known = np.array([lexicon.get(w, -1) for w in words])
            # The sample's own words fill the lexicon; half are hidden, as in texts to come.
            known[rng.random(len(known)) < 0.5] = -1
            scores = np.add.reduceat(params[0][bucket], starts, axis=0)
            scores[known >= 0] += params[1][known[known >= 0]]
            posterior, expected = marginals(scores[word_at], lengths, params[2], pairs=True)
            marks = np.concatenate([truth[i] for i in some])
            posterior[np.arange(len(marks)), marks] -= 1
            inner = np.ones(len(marks), bool)
            inner[np.cumsum(lengths) - lengths] = False
            at = np.flatnonzero(inner)
            np.subtract.at(expected, (marks[at - 1], marks[at]), 1)
            of_word = np.stack([np.bincount(word_at, posterior[:, k], len(words)) for k in range(n)], axis=1)
            owner = np.repeat(np.arange(len(words)), np.diff(np.r_[starts, len(bucket)]))
            grads = [
                np.stack([np.bincount(bucket, of_word[owner, k], BUCKETS) for k in range(n)], axis=1),
                np.stack([of_word[known == k].sum(axis=0) for k in range(n)]),
                expected,
            ]
            tick += 1
            for p, g, m, v in zip(params, grads, first, second):
                g = (g / len(some)).astype(np.float32)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**tick)) / (np.sqrt(v / (1 - 0.999**tick)) + 1e-6)
    return Model(languages, params[0], lexicon, params[1], params[2], seen)


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = DOCS, words: int = WORDS) -> Model:
    """Fits a model on a sample of ``labelled``: about ``docs`` texts of each language, ``words`` words from each."""
    sample = bounded_sample(labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()), lang, docs, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text):
                pieces = []
                for value in texts:
                    own = words_of(value)
                    at = len(value) * 7919 % max(1, len(own) - words + 1)
                    pieces.append(own[at : at + words])
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(lang)), pa.array(pieces, pa.list_(pa.string()))], names=["lang", "words"]
                )

    kind = labelled.schema[lang].dataType.simpleString()
    rows = sample.select(key, lang, text).mapInArrow(run, f"lang {kind}, words array<string>").collect()
    return fit(sorted([(list(r.words), r.lang) for r in rows], key=lambda x: (x[1], x[0])))


class _Scored(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Tagger:
    """Labels texts, keeping the scores of words met before."""

    def __init__(self, model: Model):
        self.model, self.known = model, _Scored()
        self.scores, self.familiar = np.empty((0, len(model.languages)), np.float32), np.empty(0, np.float32)

    def posteriors(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The posterior of each word's language, all texts in a row; how familiar each is; how many words each text has."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
            self.scores, self.familiar = self.scores[:0], self.familiar[:0]
        before, number = len(self.known), self.known.__getitem__
        lengths = np.array([len(t) for t in texts], np.int64)
        at = np.fromiter((number(w) for t in texts for w in t), np.int64, int(lengths.sum()))
        if len(self.known) > before:
            new = list(self.known)[before:]
            made = [self.model.emissions(new[i : i + 10_000]) for i in range(0, len(new), 10_000)]
            self.scores = np.concatenate([self.scores, *[scores for scores, _ in made]])
            self.familiar = np.concatenate([self.familiar, *[shares for _, shares in made]])
        return marginals(self.scores[at], lengths, self.model.transitions), self.familiar[at], lengths

    def label(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and familiarity of each text."""
        labels, scores, shares = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        if not self.model.languages:
            return labels, scores, shares
        posterior, familiar, lengths = self.posteriors([words_of(t) for t in texts])
        some = np.flatnonzero(lengths)
        if len(some):
            start = (np.cumsum(lengths) - lengths)[some]
            share = np.add.reduceat(posterior.astype(np.float64), start, axis=0) / lengths[some, None]
            best = share.argmax(axis=1)
            met = np.add.reduceat(familiar.astype(np.float64), start) / lengths[some]
            for i, k, s, m in zip(some.tolist(), best.tolist(), share[np.arange(len(some)), best].tolist(), met.tolist()):
                labels[i], scores[i], shares[i] = self.model.languages[k], min(1.0, s), m
        return labels, scores, shares


def identify(
    docs: DataFrame, model: Model, text: str = "text", label: str = "lang_pred", score: str = "score", familiar: str | None = None
) -> DataFrame:
    """``docs`` with the predicted language of each text and its share of the words.

    Shares of the learned languages say nothing of others. ``familiar`` names a further column: the mean, over the text's
    words, of the share of a word's features that the training texts have. It is near 1 for a learned language and low for
    another script, another language or no language at all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            for part, texts in slices(batch, text, SLICE):
                labels, *numbers = tagger.label(texts)
                columns = [pa.array(labels, pa.string()), *[pa.array(x, pa.float64()) for x in numbers]]
                yield with_columns(part, names, columns[: len(names)])

    names = [label, score, *([familiar] if familiar else [])]
    return docs.mapInArrow(run, schema_with(docs, **{label: "string"}, **{n: "double" for n in names[1:]}))
