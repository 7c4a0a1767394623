"""Operators that bring rows together: exact dedup, Jaccard join, suffix dedup, packing; and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snapmart.llm import common, exact_dedup, jaccard_join, packing, suffix_dedup

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _df(spark, rows):
    """Rows of (key, text), with columns named like results and helpers."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(7) for c in ("key", "kept", "spans", "row_a", "n", "h", "salt", "term", "piece", "length", "class_id")})


# Exact dedup


@pytest.mark.parametrize("limit", [1, 10, 60, 1 << 20])
def test_tries_find_first_owners_also_when_spilled(limit):
    rnd = random.Random(3)
    for _ in range(100):
        strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.choice([0, 1, 3, 8, 9]))) for _ in range(rnd.randint(0, 40))]
        trie = exact_dedup.Trie(limit)
        for i, s in enumerate(strings):
            trie.insert(s, i)
        owners = trie.finish()
        assert [owners[i] for i in range(len(strings))] == [strings.index(s) for s in strings]


def _exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for key, text in rows:
        groups.setdefault(norm(text), []).append(key)
    out = []
    for text, keys in groups.items():
        known = [k for k in keys if k is not None]
        first = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        free = True
        for k in sorted(keys, key=lambda k: (k is None, k)):
            out.append((k, first, len(keys), free, sha))
            free = False
    return sorted(out, key=repr)


@pytest.mark.parametrize("fan, limit", [(2000, 1 << 26), (2, 4), (3, 1 << 26)])
def test_exact_dedup_equals_brute_force(spark, fan, limit):
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["a b", "a  b", "a\nb", "", None, " ", "\x0b", "ab", "c" * 5000])) for i in range(40)]
    rows += [(3, "a b"), (3, "a b"), (None, "ab"), (None, "z"), (None, "z")] + [(100 + i, "hot text") for i in range(40)]
    found = exact_dedup.owners(_df(spark, rows), fan=fan, limit=limit).select("key", "keep_key", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == _exact(rows)


def test_keep_first(spark):
    rows = [(2, "x"), (1, "x "), (1, "x "), (3, "y"), (None, "x"), (4, None), (5, "")]
    kept = exact_dedup.keep_first(_df(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "x "), (2, "x"), (3, "y"), (4, None)]
    assert kept.columns == _df(spark, rows).columns
    assert exact_dedup.keep_first(_df(spark, rows).limit(0)).count() == 0


# Jaccard join


def _grams(text):
    words = (text or "").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _near(rows):
    """Per row: smallest key of its group, smallest key with the same shingles, links."""
    sets = [_grams(t) for _, t in rows]
    group = list(range(len(rows)))
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = lambda keys: min(((k is None, k) for k in keys), key=lambda x: (x[0], x[1] or 0))[1]
    return sorted(
        (
            (
                key,
                least([k for (k, _), g in zip(rows, group) if g == group[i]]),
                least([k for (k, _), s in zip(rows, sets) if s == sets[i]]) if sets[i] else key,
                links[i],
            )
            for i, (key, _) in enumerate(rows)
        ),
        key=repr,
    )


def _near_rows():
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randint(0, 5000)}"
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([3, 5, 12, 60, 200]))]
        for _ in range(rnd.randint(1, 6)):
            text = list(base)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    hot = [word() for _ in range(80)]
    for i in range(40):  # a group of near copies, all different
        rows.append((len(rows), " ".join(hot[:-1] + [f"end{i}"])))
    return rows + [(1, rows[1][1]), (None, rows[2][1]), (None, "a b c"), (900, "a  b\nc"), (901, None), (902, ""), (903, " "), (904, "long " * 30000)]


@pytest.mark.parametrize("block", [1_500_000, 500])
def test_jaccard_join_equals_brute_force(spark, block):
    rows = _near_rows()
    found = jaccard_join.near_groups(_df(spark, rows), block_shingles=block).select("key", "class_id", "copy_id", "n_links")
    assert sorted(map(tuple, found.collect()), key=repr) == _near(rows)


@pytest.mark.parametrize("block", [150, 75, 40])
def test_links_do_not_depend_on_empty_blocks(spark, block):
    rnd = random.Random(21)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(150)]
    rows = [(i, " ".join(base[:-1] + [f"end{i}"])) for i in range(12)]
    found = jaccard_join.near_groups(_df(spark, rows), block_shingles=block).select("key", "class_id", "copy_id", "n_links")
    assert sorted(map(tuple, found.collect()), key=repr) == _near(rows)


def test_one_document_of_each_group_stays(spark):
    rows = _near_rows()
    expected = {r[1] for r in _near(rows)}
    kept = jaccard_join.keep_one(_df(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    assert jaccard_join.keep_one(_df(spark, rows).limit(0)).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard_join.least_matches(0.8, 1e-6)
    rng = np.random.default_rng(5)
    matches = rng.random((20000, jaccard_join.VALUES)) < 0.8
    kept = np.ones(20000, bool)
    for step, m in enumerate(least):
        kept &= matches[:, : (step + 1) * jaccard_join.STEP].sum(axis=1) >= m
    assert kept.mean() > 0.999
    assert least[-1] > 0.5 * jaccard_join.VALUES


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (300, 200), (200, 300)]
    found = jaccard_join.components(spark.createDataFrame(edges, "a long, b long"), "test")
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}


# Suffix dedup


def _repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        marked = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                marked[i : i + length] = b"\1" * length
        out.append([m.span() for m in re.finditer(b"\1+", bytes(marked))])
    return out


@pytest.mark.parametrize("length, letters, scanned", [(12, "ab", 50000), (12, "abcé", 3), (7, "abc", 1), (400, "abcdefgh", 50000)])
def test_removed_bytes_equal_brute_force(spark, length, letters, scanned):
    rnd = random.Random(length)
    some = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    pool = [some(rnd.randint(1, 3 * length)) for _ in range(10)]
    texts = ["".join(rnd.choice(pool) if rnd.random() < 0.5 else some(rnd.randint(0, length)) for _ in range(rnd.randint(0, 4))) for _ in range(40)]
    rows = [(i if i != 4 else None, t) for i, t in enumerate(texts + [None, "", "ab" * 300])] + [(3, texts[3])]
    found = suffix_dedup.remove_repeats(_df(spark, rows), length=length, scanned=scanned).collect()
    got = sorted(((r.doc_id, r.text, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in found), key=repr)
    expected = []
    for (key, text), spans in zip(rows, _repeats([t for _, t in rows], length)):
        data = bytearray((text or "").encode())
        for a, b in reversed(spans):
            del data[a:b]
        expected.append((key, text, spans, bytes(data)))
    assert got == sorted(expected, key=repr)


def test_given_documents_lose_what_all_windows_say(spark):
    """Every 400-byte window of the whole table, compared as bytes."""
    from snapmart.llm.queries import op5_suffix_dedup

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    seen = Counter(t[i : i + 400] for t in texts.values() for i in range(len(t) - 399))
    wanted = {}
    for key, data in texts.items():
        spans: list[list[int]] = []
        for i in range(len(data) - 399):
            if seen[data[i : i + 400]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 400
                else:
                    spans.append([i, i + 400])
        kept = b"".join(data[a:b] for a, b in zip([0, *[s[1] for s in spans]], [*[s[0] for s in spans], len(data)]))
        wanted[key] = (len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
    found = op5_suffix_dedup(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == wanted
    assert sum(w[1] > 0 for w in wanted.values()) > 100


def test_long_texts_are_hashed_in_parts():
    rnd = np.random.default_rng(2)
    text = rnd.integers(97, 101, 3 * suffix_dedup._BUFFER // 2, dtype=np.uint8).tobytes()
    reach = suffix_dedup.Reach(400)
    whole = suffix_dedup.anchor_places(np.frombuffer(text, np.uint8), [0], [len(text)], reach)[0][0]
    (_, parted, _), = suffix_dedup._anchors_of([text], reach)
    assert whole.tolist() == parted.tolist()


def test_intervals_list_all_occurrences():
    before, after = [b"xa", b"ya", b"za", b"zq"], [b"bcd1", b"bcd2", b"bce", b"bcd3"]
    order = sorted(range(4), key=lambda i: after[i])
    tree = suffix_dedup.Intervals([before[i] for i in order], [after[i] for i in order], [1] * 4, 3)
    found = {(left, right, frozenset(order[i] for i in group)) for left, right, group in tree.repeats()}
    assert found == {(1, 3, frozenset({0, 1})), (0, 3, frozenset({0, 1, 3})), (1, 2, frozenset({0, 1, 2}))}


def test_whole_characters_stay(spark):
    rows = [(1, "é" * 3 + "abcdefgh" + "€"), (2, "xabcdefgh" + "₤")]
    found = suffix_dedup.remove_repeats(_df(spark, rows), length=9, whole_characters=True).collect()
    assert all(bytes(r.kept).decode() for r in found)
    assert suffix_dedup.remove_repeats(_df(spark, rows).limit(0)).count() == 0


# Packing


@pytest.mark.parametrize("n, capacity", [(0, 10), (1, 10), (9, 12), (30, 100), (400, 1024), (5000, 1024)])
def test_plans_are_complete_and_no_worse_than_best_fit(n, capacity):
    rnd = random.Random(n)
    for _ in range(4):
        counts = Counter(rnd.randint(1, capacity) for _ in range(n))
        plan, simple = packing.plan_sequences(counts, capacity, 2000), packing.best_fit_plan(counts, capacity)
        laid = Counter()
        for filling, times in plan:
            assert times > 0 and sum(s * k for s, k in filling.items()) <= capacity
            for s, k in filling.items():
                laid[s] += k * times
        used = sum(times for _, times in plan)
        assert laid == counts and packing.lower_bound(counts, capacity) <= used <= sum(t for _, t in simple)


def _fewest(sizes, capacity):
    """By trying all ways."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b + sizes[i] <= capacity:
                rest = list(bins)
                rest[rest.index(b)] += sizes[i]
                place(i + 1, rest)
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_small_plans_are_optimal():
    rnd = random.Random(11)
    for _ in range(60):
        sizes = sorted((rnd.randint(3, 20) for _ in range(rnd.randint(1, 9))), reverse=True)
        plan = packing.plan_sequences(Counter(sizes), 20)
        assert sum(t for _, t in plan) == _fewest(sizes, 20)


def test_the_search_has_the_steps_that_better_plans_need():
    rnd = random.Random(16)
    n, capacity = rnd.choice([60, 120, 300, 600]), rnd.choice([100, 200, 300])
    low = capacity // rnd.choice([4, 8, 20])
    counts = Counter(rnd.randint(max(2, low), capacity * rnd.choice([2, 3]) // 4) for _ in range(n))
    few = sum(t for _, t in packing.plan_sequences(counts, capacity, 4000))
    assert sum(t for _, t in packing.plan_sequences(counts, capacity)) == packing.lower_bound(counts, capacity) < few


def _check_packing(rows, docs, capacity=1024, end=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        first = (len(ids) - 1) % capacity + 1
        starts = [0, *range(first, len(ids), capacity)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected[(key, n, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(places), -(-total // capacity)


def test_packing_messy_rows(spark):
    docs = [(1, None), (1, None), (None, "a b"), (2, ""), (3, "word " * 5000), (4, "x"), (4, "y"), (5, "é漢😀 \n\t")]
    rows = packing.pack_texts(_df(spark, docs), RANKS, PATTERN, 2).collect()
    _check_packing(rows, docs)
    assert packing.pack_texts(_df(spark, docs).limit(0), RANKS, PATTERN, 2).count() == 0


def test_packing_documents(spark):
    from snapmart.llm.queries import op9_packing

    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    used, bound = _check_packing(op9_packing(spark, sf).collect(), docs)
    assert used <= bound * 1.01 + 1


# Helpers, pipeline


def test_bounded_sample_is_bounded_and_stable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 10 < 9, "often").alias("c"))
    first, again = (sorted(map(tuple, common.bounded_sample(df, "c", 100, "id").collect())) for _ in range(2))
    by = Counter(c for _, c in first)
    assert first == again and 60 < by["rare"] < 140 and 60 < by["often"] < 140 and set(by) == {"rare", "often"}


def test_salted_join_keeps_all_rows(spark):
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2)], "k string, v long")
    table = spark.createDataFrame([("a", 1), ("c", 2)], "k string, w long")
    found = common.salted_left_join(rows, table, "k", 4).collect()
    assert Counter((r.k, r.w) for r in found) == Counter({("a", 1): 50, ("b", None): 1, (None, None): 1})


def test_stages_against_brute_force(spark):
    rnd = random.Random(12)
    words = [f"{a}{b}" for a in ("lor", "em", "ip") for b in ("sum", "dol", "or", "sit", "amet")]
    text = lambda n: " ".join(rnd.choice(words) + rnd.choice(words) for _ in range(n))
    passage = text(70)
    rows = [(i, text(60)) for i in range(30)]
    rows += [(30 + i, f"{text(30)} {passage} {text(30)}") for i in range(3)]
    rows += [(40, rows[0][1]), (41, rows[1][1] + " more"), (42, None), (43, "12 34"), (44, ""), (0, rows[0][1])]
    docs = spark.createDataFrame([(k, t, "xx", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "suffix_dedup", "packing"]
    kept = stage["language_id"](spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, t in rows if re.search("[a-z]", t or ""))
    kept = stage["exact_dedup"](spark, kept, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [*range(33), 41]
    kept = stage["jaccard_join"](spark, kept, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [*range(33)]
    before = {r.doc_id: r.text for r in kept.collect()}
    kept = stage["suffix_dedup"](spark, kept, "")
    after = {r.doc_id: r for r in kept.collect()}
    expected = _repeats([before[k] for k in sorted(before)], 255)
    for key, spans in zip(sorted(before), expected):
        data = before[key].encode()
        spans = [(a, b) for a, b in spans if len(data[a:b].split()) > 50]
        assert after[key].text.encode() == b"".join(data[a:b] for a, b in zip([0, *[s[1] for s in spans]], [*[s[0] for s in spans], len(data)]))
        assert after[key].n_chars == len(after[key].text)
    assert all(passage not in after[30 + i].text for i in range(3))
    packed = stage["packing"](spark, kept, "").collect()
    _check_packing(packed, [(k, r.text) for k, r in after.items()])


@pytest.mark.parametrize(
    "words, letters, stays",
    [(50, 8, True), (51, 8, False), (51, 4, False), (60, 6, False), (200, 5, False), (30, 20, True), (51, 3, True)],
)
def test_stage_cuts_passages_of_over_fifty_words(spark, words, letters, stays):
    """Of words of four letters and more; 51 words of three letters are below the stage's bytes."""
    rnd = random.Random(30)
    word = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    passage = " ".join(word(letters) for _ in range(words))
    # Different words around the passage, so that no longer string repeats.
    around = lambda i: " ".join(word(7) for _ in range(40))
    rows = [(i, f"{around(i)} {2 * i}\n{passage}\n{2 * i + 1} {around(i)}") for i in range(3)]
    stage = dict(corpus_pipeline.STAGES)["suffix_dedup"]
    kept = {r.doc_id: r.text for r in stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert [passage in kept[i] for i in range(3)] == [stays] * 3
    if stays:
        assert kept == dict(rows)
    else:
        assert kept == {i: t.replace(f"\n{passage}\n", "") for i, t in rows}


def test_stages_leave_further_columns_alone(spark):
    """Columns named like results, very long texts, ties, repeated rows and nulls, through all stages but the last."""
    rnd = random.Random(31)
    text = lambda n: " ".join(rnd.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str.lower(chr(97 + rnd.randrange(26))) * 3 for _ in range(n))
    passage = text(80)
    rows = [(i, text(70), "xx") for i in range(12)] + [(20 + i, f"{text(40)} {passage} {text(40)}", None) for i in range(3)]
    rows += [(30, text(60_000), "xx"), (31, rows[0][1], "xx"), (0, rows[0][1], "xx"), (None, rows[1][1], None), (40, None, "xx"), (41, "", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    named = ("kept", "spans", "_lang", "_share", "lang_pred", "score", "key", "keep_key", "class_id", "n", "h", "sha", "row_a", "is_first", "u", "node")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("text", F.lit("none"))) for c in named})
    docs = docs.withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, columns = docs, docs.columns
        docs = stage(spark, docs, "")
        assert docs.columns == columns
        if name != "suffix_dedup":
            assert all(r[c] == f"{c} {r.text}" for r in docs.collect() for c in named)
    found = docs.collect()
    assert sorted(r.doc_id for r in found) == [*range(12), 20, 21, 22, 30]
    was = {r.doc_id: r for r in before.collect()}
    for r in found:
        assert all(r[c] == was[r.doc_id][c] for c in named) and r.tags == {"a": r.doc_id}
        assert passage not in r.text and (r.doc_id >= 20 or r.text == was[r.doc_id].text)


def test_language_stage_rejects_what_no_language_was_learned_from(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rnd = random.Random(32)
    junk = " ".join("".join(rnd.choice("bcdfgjkqvwxz") for _ in range(rnd.randint(3, 9))) for _ in range(80))
    strange = {
        -1: "这是一个没有学过的语言的文本。" * 20, -2: "Это текст на языке, которого модель не знает. " * 10, -3: junk, -4: "12 34 !!",
        -5: "Ez egy magyar nyelvű szöveg, amelyet a modell sohasem látott, így hát nem is ismerheti a szavait egyáltalán. " * 8,
    }
    added = spark.createDataFrame([(k, t, None, "s", len(t)) for k, t in strange.items()], docs.schema)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language_id"](spark, docs.unionByName(added), sf).select("doc_id").collect()}
    assert not kept & {-1, -2, -3, -4}
    lettered = {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert len(kept & lettered) >= 0.995 * len(lettered)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
