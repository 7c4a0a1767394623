"""Operators that treat each row by itself: toxicity, language, SentencePiece, quality rules, URL filters, chat."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from snapmart.llm import chat, language, quality, queries, sentencepiece_bpe as pieces, toxicity, url_filter

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "word " * 60_000
MESSY = [
    (1, "Der Hund läuft", "de", 5), (1, "Der Hund läuft", "de", 5), (None, "the dog runs", None, None), (2, None, "en", 1),
    (3, "", None, 0), (4, " \n\t ", "en", 0), (5, LONG, "en", 2), (6, "123 !? €", "fr", 2), (7, "漢字 😀 ▁ <s>", None, 3),
]


@pytest.fixture(scope="module")
def messy(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns named like results."""
    df = spark.createDataFrame(MESSY, "doc_id long, text string, lang string, score int")
    return df.withColumns({"lang_pred": F.lit(9), "ids": F.lit("x"), "decoded": F.lit(1), "n_words": F.lit("n"), "source": F.lit(None).cast("string")})


# SentencePiece


def test_pieces_equal_the_library():
    rnd, library = random.Random(1), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocab = pieces.vocabulary(MODEL)
    letters = "aabbcde   \n\t▁éßñ語漢​😀,.'0123\x00 THthe"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", "a" * 3000, " " * 1500, "ab" * 2000, "=-" * 500, "漢字" * 500, LONG[:20000]]
    encoder = pieces.Encoder(vocab)
    for low in range(0, len(texts), 500):
        ids, counts = encoder.encode(texts[low : low + 500])
        for text, own in zip(texts[low:], np.split(ids, np.cumsum(counts)[:-1])):
            expected = library.encode(text)
            assert own.tolist() == expected
            assert pieces.decode_ids(vocab, own) == library.decode(expected)


def test_decoding_any_ids_equals_the_library():
    rnd, library = random.Random(2), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocab = pieces.vocabulary(MODEL)
    for _ in range(2000):
        ids = [rnd.choice([rnd.randint(0, 31999), rnd.randint(0, 260), 28705]) for _ in range(rnd.randint(0, 9))]
        assert pieces.decode_ids(vocab, np.array(ids, np.int64)) == library.decode(ids)


def test_pieces_of_messy_rows(messy):
    found = pieces.decode(pieces.encode(messy, MODEL), MODEL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert len(found) == len(MESSY)
    for row in found:
        assert row.ids == library.encode(row.text or "") and row.decoded == library.decode(row.ids)
    assert pieces.encode(messy.limit(0), MODEL).count() == 0


# Language


def _sentences(rnd, words, n):
    return [[rnd.choice(words) for _ in range(rnd.randint(8, 30))] for _ in range(n)]


@pytest.fixture(scope="module")
def tongues():
    rnd = random.Random(4)
    stems = {"aa": ["kor", "vik", "tan"], "bb": ["ulo", "eme", "ari"]}
    words = {k: [rnd.choice(s) + rnd.choice(s) for _ in range(60)] for k, s in stems.items()}
    data = [(text, k) for k, own in words.items() for text in _sentences(rnd, own, 60)]
    return words, language.fit(data, sequences=600, epochs=2)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    scores, transitions = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    lengths = np.array([4, 0, 1, 2])
    got, pairs = language.marginals(scores.copy(), lengths, transitions, pairs=True)
    expected, all_pairs, start = np.zeros((7, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n) if n else np.empty((0, 0), int)
        w = np.array([np.exp(sum(scores[start + i, p[i]] for i in range(n)) + sum(transitions[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        for p, x in zip(paths, w / w.sum() if n else w):
            for i in range(n):
                expected[start + i, p[i]] += x
            for a, b in zip(p, p[1:]):
                all_pairs[a, b] += x
        start += n
    assert np.allclose(got, expected) and np.allclose(pairs, all_pairs)


def test_code_switched_words_get_their_own_language(tongues):
    words, model = tongues
    rnd = random.Random(5)
    mixed = [rnd.choice(words["aa"]) for _ in range(12)] + [rnd.choice(words["bb"]) for _ in range(12)]
    posterior, _, _ = language.Tagger(model).posteriors([mixed])
    labels = posterior.argmax(axis=1)
    assert (labels == [0] * 12 + [1] * 12).mean() > 0.9


def test_language_of_messy_rows(messy, tongues):
    found = {(r.doc_id, r.text): r for r in language.identify(messy, tongues[1]).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in [(2, None), (3, ""), (4, " \n\t "), (6, "123 !? €")])
    assert found[(7, "漢字 😀 ▁ <s>")].lang_pred in ("aa", "bb") and 0 <= found[(5, LONG)].score <= 1
    assert language.identify(messy.limit(0), tongues[1]).count() == 0


def test_without_labels_all_is_unknown(spark, messy):
    model = language.train(messy.where("lang is null").drop("score"))
    assert {r.lang_pred for r in language.identify(messy, model).collect()} == {"und"}


def test_held_out_language_accuracy(spark):
    from snapmart.llm.queries import op6_language_id

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = op6_language_id(spark, sf).where("held_out").join(truth, "doc_id").where("lang is not null")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


# Toxicity


def test_held_out_toxicity(spark):
    from snapmart.llm.queries import op1_toxicity

    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = op1_toxicity(spark, sf).where("held_out").join(truth, "doc_id").toPandas()
    ranks, bad = held.score.rank(), held.toxic == 1
    auc = (ranks[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.95 and (held.predicted == held.toxic).mean() > 0.96


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(1)
    words = [toxicity.word_hash(f"word{i}") for i in range(300)]
    texts, toxic = [], []
    for i in range(400):
        text = list(rng.choice(words, 30))
        if i % 4 == 0:
            text[rng.integers(30)] = toxicity.word_hash("vile")
        texts.append(np.array(text, np.uint64))
        toxic.append(float(i % 4 == 0))
    found = toxicity.fit(texts, np.array(toxic, np.float32), np.ones(400), epochs=12)
    found.thresholds = {"": 0.5, "de": 0.9}
    return found


def test_scoring_by_tables_equals_the_network(network):
    texts = ["word1 word2 vile word3", "word5", "", "word7 " * 900, "!!", "vile"]
    direct = toxicity.raw_scores(network, [np.array([toxicity.word_hash(w) for w in toxicity.words_of(t)], np.uint64) for t in texts])
    scored = toxicity.Scorer(network).score(texts)
    assert np.allclose(scored, 1 / (1 + np.exp(-direct)), atol=1e-5)
    assert scored[0] > 0.5 and scored[5] > 0.5 and scored[1] < 0.5


def test_toxicity_of_messy_rows(messy, network):
    found = toxicity.flag(toxicity.score(messy, network), network).collect()
    assert len(found) == len(MESSY) and all(0 <= r.score <= 1 for r in found)
    blank = {r.score for r in found if r.text in (None, "", " \n\t ")}
    assert len(blank) == 1
    assert toxicity.score(messy.limit(0), network).count() == 0


def _plain_score(network, text):
    """One text through the network, word by word and filter by filter."""
    x = [network.embed(np.array([h], np.uint64))[0] for h in text] or [np.zeros(toxicity.SIZE)]
    x += [np.zeros(toxicity.SIZE)] * toxicity.PAD
    total, k = network.bias, 0
    for weights, bias in zip(network.filters, network.biases):
        for f in range(toxicity.FILTERS):
            answers = [
                sum(float(weights[j, :, f] @ x[i + j]) for j in range(len(weights))) + float(bias[f])
                for i in range(len(x) - toxicity.PAD)
            ]
            total += max(0.0, max(answers)) * float(network.out[k])
            k += 1
    return total


def _small_set():
    rng = np.random.default_rng(5)
    words = [toxicity.word_hash(f"word{i}") for i in range(40)]
    texts = [np.array([words[i] for i in rng.integers(0, 40, n)], np.uint64) for n in (0, 1, 2, 5, 9, 14)]
    return texts, np.array([1, 0, 1, 0, 1, 0], np.float32), np.array([1, 2, 1, 1, 3, 1], np.float32)


def test_network_equals_a_plain_convolution():
    texts, toxic, weights = _small_set()
    network = toxicity.fit(texts, toxic, weights, epochs=2)
    assert np.allclose(toxicity.raw_scores(network, texts), [_plain_score(network, t) for t in texts], atol=1e-4)


def test_training_steps_follow_the_numeric_gradient(monkeypatch):
    """The gradients of one pass without hidden words against differences of the loss."""
    steps = {}

    def note(self, name, param, grad, rows=None):
        steps[name] = (np.array(grad, float), None if rows is None else np.array(rows))

    monkeypatch.setattr(toxicity._Adagrad, "step", note)
    # Without the empty text, whose answers lie on the kink at 0 as long as the biases are 0.
    texts, toxic, weights = (x[1:] for x in _small_set())
    network = toxicity.fit(texts, toxic, weights, epochs=1, hidden=0.0)  # the parameters stay as they were drawn
    network.out = network.out.astype(float)
    for part in (network.tables, network.filters, network.biases):
        part[:] = [p.astype(float) for p in part]

    def loss():
        z = np.array([_plain_score(network, t) for t in texts])
        p = 1 / (1 + np.exp(-z))
        held = 0.5e-4 * ((network.out**2).sum() + sum((w**2).sum() for w in network.filters))
        return float((-(toxic * np.log(p) + (1 - toxic) * np.log(1 - p)) * weights).sum() / weights.sum() + held)

    def slope(array, at, h=1e-5):
        was = array[at]
        array[at] = was + h
        up = loss()
        array[at] = was - h
        down = loss()
        array[at] = was
        return (up - down) / (2 * h)

    rng = np.random.default_rng(6)
    for i in range(0, len(network.out), 5):
        assert slope(network.out, i) == pytest.approx(steps["out"][0][i], abs=1e-5)
    for k, weights_k in enumerate(network.filters):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in weights_k.shape)
            assert slope(weights_k, at) == pytest.approx(steps[f"filter{k}"][0][at], abs=1e-5)
        assert slope(network.biases[k], 3) == pytest.approx(steps[f"bias{k}"][0][3], abs=1e-5)
    for k, table in enumerate(network.tables):
        grad, rows = steps[f"table{k}"]
        for row in np.unique(rows)[::12]:
            assert slope(table, (row, 7)) == pytest.approx(grad[rows == row, 7].sum(), abs=1e-5)
    assert steps["bias"][0][0] == pytest.approx(sum(w * (1 / (1 + np.exp(-_plain_score(network, t))) - y) for w, t, y in zip(weights, texts, toxic)) / weights.sum(), abs=1e-4)


def test_training_takes_one_row_of_a_repeated_key_and_no_row_of_an_empty_table(spark):
    rows = [(i % 8, f"word{i % 8} vile" if i % 2 else f"word{i % 8} fine", "en") for i in range(400)] + [(None, "x", None), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(9, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    once = toxicity.train(docs.dropDuplicates(["doc_id"]), labels)
    many = toxicity.train(docs.unionByName(docs), labels)
    assert np.allclose(many.out, once.out) and many.bias == once.bias
    blank = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs, blank).select("score").distinct().count() == 1


def test_only_labelled_texts_are_shuffled_and_once(spark, monkeypatch):
    """A plain join of texts and labels would deal out all texts by their key, and the labelled ones by chunk again."""
    docs = spark.range(4000).select(
        F.when(F.col("id") != 3999, F.col("id")).alias("doc_id"),
        F.when(F.col("id") != 7, F.format_string("word%d fine", "id")).alias("text"), F.lit("en").alias("lang"),
    )
    docs = docs.unionByName(docs.where("doc_id < 20"))
    labels = spark.range(1, 8001, 40).select(F.col("id").cast("int").alias("doc_id"), (F.col("id") % 80 == 1).cast("int").alias("toxic"))
    labels = labels.unionByName(spark.createDataFrame([(1, 0), (7, 1), (8, None), (None, 1)], "doc_id int, toxic int"))
    made, store = {}, toxicity.materialize
    monkeypatch.setattr(toxicity, "materialize", lambda df, name: made.setdefault(name, (df, store(df, name)))[1])
    monkeypatch.setattr(toxicity, "DOCS", 10)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.train(docs, labels)
        plan = made["toxicity-chunks"][0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and plan.count("REPARTITION_BY_COL") == 1
    table = made["toxicity-chunks"][1]
    read = list(toxicity._read_chunks(iter([b for b in table.toArrow().to_batches()])))
    assert len(read) > 5
    found = sorted((float(t), tuple(w.tolist())) for _, toxic, _, _, texts in read for t, w in zip(toxic, texts))
    words = lambda i: tuple(toxicity.word_hash(w) for w in ((f"word{i}", "fine") if i != 7 else ()))
    assert found == sorted([(float(i % 80 == 1), words(i)) for i in range(1, 3999, 40)] + [(1.0, words(7))])
    known = made["toxicity-labels"][1]
    kept = toxicity._perhaps_labelled(docs, known, "doc_id", known.count())
    assert kept.join(known, "doc_id").count() == docs.join(known, "doc_id").count() and kept.count() < 600
    # With fewer bits than labels, more documents stay and none that has a label goes.
    monkeypatch.setattr(toxicity, "MOST_BITS", 64)
    few = toxicity._perhaps_labelled(docs, known, "doc_id", known.count())
    assert few.join(known, "doc_id").count() == docs.join(known, "doc_id").count() and few.count() > kept.count()


def test_toxicity_without_both_labels(spark, messy):
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    network = toxicity.train(messy, labels)
    assert {round(r.score, 6) for r in toxicity.score(messy, network).collect()} == {0.0}


def test_toxicity_learns_from_every_labelled_text_to_its_end(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "DOCS", 50)
    plain = "plain " * 3500
    texts = [(i, f"{plain}word{i % 40} {f'vile{i}' if i % 3 == 0 else ''}", "en") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    chunks = []
    made = toxicity._chunks
    monkeypatch.setattr(toxicity, "_chunks", lambda *given: chunks.append(made(*given)) or chunks[-1])
    network = toxicity.train(docs, labels)
    assert chunks[0].count() == 6 and toxicity.train(docs.repartition(7), labels).bias == network.bias
    # The rows of words that stand only once, at the end of long texts, are used; those of no text are not.
    for i in range(0, 300, 3):
        if toxicity.zlib.crc32(str(i).encode()) // 5 % 5:
            own = toxicity.rows_of(np.array([toxicity.word_hash(f"vile{i}")], np.uint64))
            assert all(network.tables[k][own[k]].any() for k in range(2))
    fresh = toxicity.rows_of(np.array([toxicity.word_hash(f"new{i}") for i in range(50)], np.uint64))
    assert sum(network.tables[0][r].any() for r in fresh[0]) < 5


def test_threshold_of_best_f1():
    score, toxic = np.array([0.9, 0.8, 0.4, 0.3, 0.1]), np.array([1, 1, 0, 1, 0])
    assert 0.1 < toxicity.best_threshold(score, toxic, np.ones(5)) < 0.3
    assert toxicity.best_threshold(score, np.zeros(5), np.ones(5)) == 0.5


# Quality rules


def _measured(text):
    import re

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    spans = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {i + k for i, s in enumerate(spans) if spans.count(s) > 1 for k in range(5)}
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice)


def test_measures_equal_brute_force(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    texts += ["\n".join(rnd.choice(["a b", "", " ", "c#|"]) for _ in range(8)) for _ in range(20)] + [None, "", " x\x0b\x0cy\r\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in quality.measure(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _measured(r.text), r.text


def test_quality_of_messy_rows(messy):
    judged = quality.judge(quality.measure(messy)).collect()
    assert len(judged) == len(MESSY) and all(r.base_failed and not r.kept for r in judged)
    assert quality.judge(quality.measure(messy.limit(0))).count() == 0


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(20))
    rows = [("bad", "x")] * 40 + [("bad", good)] + [("fine", good)] * 40 + [("fine", "x")] + [("small", "x"), ("small", good), (None, good)]
    df = spark.createDataFrame(rows, "source string, text string")
    kept = {(r.source, r.text): r.kept for r in quality.judge(quality.measure(df)).collect()}
    assert kept[("fine", good)] and kept[(None, good)] and kept[("small", good)]
    assert not kept[("bad", good)] and not kept[("fine", "x")]


# URL filters


def test_rules_and_reputation(spark):
    rules = [("allow", "a.com/"), ("block", "a.com/bad/"), ("block", "net/x")]
    rows = [(1, "http://A.com/bad/1?q"), (2, "http://w.a.com/badly#f"), (3, "://b.net/xyz"), (4, "ba.com/bad/"), (5, None), (6, "http://ba.com")]
    rows += [(10 + i, "http://spam.net/x") for i in range(30)] + [(50, "http://spam.net/other"), (51, "http://new.org/")]
    rows += [(60, "x://y://z?a"), (60, "x://y://z?a")] + [(100 + i, f"http://s{i}.a.com/") for i in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"rule": F.lit(1), "host": F.lit(2), "bound": F.lit(3)})
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    assert found[1] == ("a.com", "/bad/1", "a.com/bad/", "block") and found[2][2:] == ("a.com/", "allow")
    assert found[3] == ("b.net", "/xyz", "net/x", "block") and found[4] == ("", "", None, "allow")
    assert found[5] == ("", "", None, "allow") and found[6][:3] == ("ba.com", "", None)
    assert found[50] == ("spam.net", "/other", None, "block") and found[51][3] == "allow" and found[60][:2] == ("y:", "//z")
    assert url_filter.judge(df, rules).count() == len(rows) and url_filter.judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(df, []).collect()} == {"allow"}


def test_domains():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([("a.b.co.uk",), ("x.example.com",), ("com",), ("",)], "h string")
    got = df.select(url_filter.domain_of(F.col("h")), url_filter.suffix_of(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("b.co.uk", "co.uk"), ("example.com", "com"), ("com", "com"), ("", "")]


# Chat

RECORDS = [
    ({"role": "user", "text": None}, [("user", "")]),
    ({"text": "hi", "role": "assistant"}, [("assistant", "hi")]),
    ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "gpt"}]}, [("user", "a"), ("assistant", "b")]),
    ({"messages": []}, []),
    ({"conversations": [{"from": "human", "value": "<s>"}]}, [("user", "<s>")]),
    ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"system": "s", "prompt": "p", "completion": 3}, [("system", "s"), ("user", "p"), ("assistant", "3")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\nx"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o", "id": 5}, [("user", "i"), ("assistant", "o")]),
]


def test_layouts_become_turns(spark):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)], "n long, record string").withColumn("text", F.lit(0))
    turns = chat.to_turns(df, "record", extra=["id"]).orderBy("n", "position").collect()
    for n, (_, expected) in enumerate(RECORDS):
        assert [(t.role, t.text) for t in turns if t.n == n] == expected


def test_very_long_texts_stay(spark, tmp_path):
    row = spark.range(1).select(
        F.lit(1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"),
        F.repeat(F.lit("xyz"), F.lit(7_000_000)).alias("text"),
    )
    short = row.withColumns({"turn": F.lit(1).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    row.unionByName(short).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in queries.op3_chat_format(spark, str(tmp_path)).collect()}
    text = "xyz" * 7_000_000
    assert found[1].n_turns == 2 and found[1].loss_chars == len(text) and found[-1].n_turns == 2
    assert found[1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert found[1].turns_sha256 == hashlib.sha256(f"assistant\n{text}\n\n\n".encode()).hexdigest()
    # Also as JSON; records that no variant can hold are no silent loss.
    record = F.to_json(F.struct(F.lit("p").alias("prompt"), F.col("text").alias("response"))).alias("record")
    turns = chat.to_turns(row.select(record), "record").select("role", F.length("text").alias("n"))
    assert sorted(map(tuple, turns.collect())) == [("assistant", len(text)), ("user", 1)]
    huge = row.withColumn("text", F.repeat(F.lit("x"), F.lit(140_000_000))).select(record)
    with pytest.raises(Exception, match="too large for a variant"):
        chat.to_turns(huge, "record").select("role").collect()


def test_unknown_shapes_are_listed(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}}',), ('{"a": {"b": "x"}}',), ("no json",), (None,), (json.dumps(RECORDS[0][0]),)], "record string")
    assert {(r["shape"], r.n) for r in chat.unknown_shapes(df, "record").collect()} == {("{a:{b:>>", 2), (None, 2)}
    assert chat.to_turns(df, "record").count() == 1 and chat.to_turns(df.limit(0), "record").count() == 0


def test_escaping_is_reversible_and_hides_control_strings(spark):
    rnd = random.Random(7)
    parts = [*chat.CONTROL, "\\", "<", "|", "[", "]", "s>", "im_end|>", "x", " ", "é", "\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(800)] + ["", LONG]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_turns_are_read_back_from_the_formatted_text(spark):
    said = [(1, 0, "user", "</s>[INST]"), (1, 1, "assistant", None), (1, 1, "assistant", "a\\"), (1, 2, None, "x"), (2, 5, "assistant", "é<|im_end|>"), (None, 0, "user", "")]
    df = spark.createDataFrame(said, "c long, turn long, role string, text string").withColumn("position", F.lit(0))
    read = chat.read_turns(chat.format_turns(df))
    found = {r.c: r for r in chat.digest(read, "c", ["turn", "position"]).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].n_turns == 4 and found[1].loss_chars == 2 and found[1].loss_sha256 == sha("a\\")
    assert found[1].turns_sha256 == sha("user\n</s>[INST]\nassistant\n\nassistant\na\\\n\nx\n")
    assert found[2].loss_sha256 == sha("é<|im_end|>") and found[None].n_turns == 1 and found[None].loss_chars == 0
