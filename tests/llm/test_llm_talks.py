"""Operators on conversations, and the mix: prefix trie, conversation repair, mixing to target weights."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from snapmart.llm import mixing, prefix_trie, repair

# Prefix trie


def _talks(spark, rows):
    """Rows of (conv_id, turn, role, text), with columns named like results and helpers."""
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    return df.withColumns({c: F.lit(7) for c in ("c", "part", "p", "d", "a", "b", "key", "depth", "n_convs", "present", "audit")})


def _ordered(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said[c].append((turn is not None, turn or 0, role, digest, text))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in said.items()}


def _trie(talks):
    """Nodes from all prefixes; totals by comparing every pair of nodes."""
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    own = {n: (len(m) - 1) * (len(n[-1][1]) if n else 0) for n, m in members.items()}
    children = {n: sum(len(x) == len(n) + 1 and x[: len(n)] == n for x in members) for n in members}
    out = []
    for n, m in members.items():
        below = [x for x in members if x[: len(n)] == n]
        ends = ",".join(str(c) for c in sorted(m) if len(talks[c]) == len(n))
        out.append(
            (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], sum(not children[x] for x in below),
             sum(own[x] for x in below), sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def _random_talks(seed):
    rnd = random.Random(seed)
    rows = []
    for c in (*range(-3, 9), *range(100, 125), *range(207, 212)):
        for turn in range(rnd.choice([0, 1, 1, 2, 3, 5, 8])):
            rows.append((c, rnd.choice([turn, turn, turn, None, 1]), rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "", None, "long " * 50])))
    rows += [(300, t, "user", "x") for t in range(60)] + [(301, t, "user", "x" if t < 50 else "y") for t in range(60)]
    rows += [(c, 0, "system", "hot") for c in range(400, 440)] + [(5, 2, "user", "same")] * 3 + [(None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("shard, queue", [(50_000, 200_000), (3, 200_000), (6, 2), (50_000, 1)])
def test_trie_equals_brute_force(spark, shard, queue):
    rows = _random_talks(shard)
    placed = prefix_trie.placed_turns(_talks(spark, rows))
    found = prefix_trie.trie(*prefix_trie.own_paths(placed), shard=shard, queue=queue)
    assert sorted(map(tuple, found.collect()), key=repr) == _trie(_ordered(rows))


def test_shared_heads_are_rebuilt_by_the_rule(spark):
    # Turn numbers are unique here, so that order needs no hash.
    rows = [(c, t, r, x) for i, (c, _, r, x) in enumerate(_random_talks(11)) for t in [i]]
    own = _ordered(rows)
    talks = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        talks[c] = own.get(head, [])[:h] + turns[h:]
    assert any(not t for t in talks.values())  # turnless ones
    placed = prefix_trie.placed_turns(_talks(spark, rows))
    found = prefix_trie.trie(*prefix_trie.with_shared_heads(placed), shard=20, queue=5)
    assert sorted(map(tuple, found.collect()), key=repr) == _trie(talks)


def test_trie_of_nothing(spark):
    placed = prefix_trie.placed_turns(_talks(spark, [(1, 0, "user", "x")]).limit(0))
    assert prefix_trie.trie(*prefix_trie.with_shared_heads(placed)).collect() == []


def test_queue_gives_what_was_sent_also_from_runs():
    rnd = random.Random(5)
    queue, sent = prefix_trie.MessageQueue(3), defaultdict(list)
    for _ in range(200):
        key = (-rnd.randint(0, 9), rnd.randint(-3, 3), 0)
        sent[key].append((rnd.randint(0, 9), rnd.randint(0, 9)))
        queue.push(key, *sent[key][-1])
    for key in sorted(sent):
        assert queue.take(key) == (len(sent[key]), sum(x for x, _ in sent[key]), sum(y for _, y in sent[key]))
        assert queue.take(key) == (0, 0, 0)
    assert not len(queue)


# Repair


def _least_edits(kinds, initials):
    """All repairs whose cost is the least, by widening a set of whole paths; the least text of them."""
    n = len(kinds)
    front = {(0, ""): {(0, "")}}
    done = []
    for _ in range(3 * n + 6):
        after = defaultdict(set)
        for (i, last), paths in front.items():
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
            for cost, text in paths:
                if cost > 3 * n:
                    continue
                if i == n and last in ("", "a"):
                    done.append((cost, text))
                steps = [("I", 2, i, x) for x in legal if x != "s"]
                if i < n:
                    steps.append(("D", 3, i + 1, last))
                    if kinds[i] != repair.GONE:
                        more = 1 if kinds[i] == repair.CUT else 0
                        steps += [("R", 2 + more, i + 1, x) for x in legal if x != "s"]
                        steps += [("K", more, i + 1, initials[i])] if initials[i] and initials[i] in legal else []
                for edit, price, j, x in steps:
                    after[j, x].add((cost + price, text + edit))
        # Of many paths to a state the cheapest ones are enough; their texts are compared whole.
        front = {}
        for state, paths in after.items():
            least = min(c for c, _ in paths)
            front[state] = set(sorted(p for p in paths if p[0] <= least + 4)[:60])
    return min(done)


def test_search_finds_the_least_of_the_cheapest_repairs():
    rnd = random.Random(7)
    for _ in range(400):
        n = rnd.randint(0, 6)
        kinds = bytes(rnd.choice([0, 0, 0, 1, 2]) for _ in range(n))
        initials = [rnd.choice(["s", "u", "a", "u", "a", "x", ""]) for _ in range(n)]
        assert repair.cheapest_edits(kinds, initials) == _least_edits(kinds, initials), (kinds, initials)


def test_bounds_never_exceed_what_the_rest_costs():
    rnd = random.Random(8)
    for _ in range(300):
        n = rnd.randint(0, 12)
        kinds = bytes(rnd.choice([0, 0, 1, 2]) for _ in range(n))
        initials = [rnd.choice("suax") for _ in range(n)]
        # Costs to the end, from the back.
        cost = [[10**9] * 4 for _ in range(n + 1)]
        for i in range(n, -1, -1):
            for q in range(4):
                cost[i][q] = 0 if i == n and q in (0, 3) else 10**9
            for _ in range(4):
                for q in range(4):
                    steps = repair._edits(i, q, kinds, initials)
                    cost[i][q] = min([cost[i][q], *[c + cost[to // 4][to % 4] for _, c, to in steps]])
        need = repair._lower_bounds(kinds, initials)
        assert all(need[4 * i + q] <= cost[i][q] for i in range(n + 1) for q in range(4))


def test_a_long_damaged_conversation_is_repaired_in_few_steps():
    rnd = random.Random(9)
    kinds = bytes(rnd.choices([0, 1, 2], [90, 5, 5])[0] for _ in range(20_000))
    initials = [rnd.choices("uas", [48, 48, 4])[0] if i % 20 == 0 else "ua"[i % 2] for i in range(20_000)]
    cost, audit = repair.cheapest_edits(kinds, initials)
    assert len(audit.replace("I", "")) == 20_000 and cost > 0


def _damaged(rows):
    out = {}
    for c, turn, role, text in rows:
        out.setdefault(c, [])
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
            out[c] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])) for c, turns in out.items()}


def _repaired(rows):
    found, talks = [], {}
    for c, turns in _damaged(rows).items():
        kinds, counts, seen = [], [0, 0, 0], set()
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            kinds.append({None: 0, 2: 1}.get(fault, 2))
        initials = [role[:1] for _, role, _ in turns]
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        cost, audit = repair.cheapest_edits(bytes(kinds), initials)
        out, at = [], 0
        for edit in audit:
            then = "assistant" if out and out[-1][0][0] == "u" else "user"
            if edit == "I":
                out.append((then, ""))
                continue
            _, role, text = turns[at]
            at += 1
            out += {"D": [], "K": [(role, text)], "R": [(then, text)]}[edit]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
        talks[c] = out
        digest = sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found.append((c, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=repr), talks


def _given_rows():
    rnd = random.Random(13)
    texts = ["Yes.", "No!", "cut", " ", "", None, "Yes. \x0b", "é?\n", "long " * 3000 + "."]
    rows = []
    for c in (*range(60), None):
        for turn in range(rnd.randint(1, 9)):
            text = rnd.choice(texts) if rnd.random() < 0.4 else f"Turn {c} {turn}."
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((c, rnd.choice([turn, turn, turn + 1, None]), role, text))
    return rows + [(7, 1, "user", "Yes.")] * 3


@pytest.mark.parametrize("limit", [0, 40, 1 << 24])
def test_repairs_of_messy_rows(spark, limit):
    rows = _given_rows()
    wanted, talks = _repaired(rows)
    damaged = repair.damage(_talks(spark, rows))
    found = repair.repairs(damaged, "key", present="present", limit=limit)
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
    turns = repair.repaired_turns(damaged, "key", present="present", limit=limit)
    kept = sorted(map(tuple, turns.collect()), key=repr)
    assert kept == sorted(((c, i, *t) for c, said in talks.items() for i, t in enumerate(said)), key=repr)


def test_repair_of_nothing(spark):
    rows = _talks(spark, [(1, 0, "user", "x")])
    assert repair.repairs(rows.limit(0)).collect() == []
    assert repair.repairs(repair.damage(rows).withColumn("present", F.lit(False)), "key", present="present").collect()[0][1:8] == (0,) * 6 + ("",)
    assert [tuple(r) for r in repair.repaired_turns(rows.withColumn("present", F.lit(None).cast("boolean")), present="present").collect()] == []


# Mixing


def _docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    df = df.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    return df.withColumns({c: F.lit(7) for c in ("size", "taken", "target", "rate", "words", "part", "open", "name")})


def _mix_rows(n, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = rnd.choice([0, 1, 2, 3, 7, 30, 400, int(1500 * rnd.random())])
        rows.append((i, rnd.choice([None, ""]) if not words else " w\n" * words, rnd.choices(["hot", "b", "", "zé", None], [12, 3, 2, 2, 1])[0]))
    return rows + [(5, "x y z", "b")] * 3 + [(None, "x y", "b"), (None, "x", None)] * 2 + [(10_000, "w " * 200_000, "b")]


def _targets(sizes, weights):
    """Filled up by weight again and again, until none is above twice its size."""
    wanted = 1.5 * sum(sizes.values())
    full = {}
    while True:
        rest = (wanted - sum(full.values())) / sum(weights[s] for s in sizes if s not in full)
        above = [s for s in sizes if s not in full and rest * weights[s] > 2 * sizes[s]]
        if not above:
            return {s: full.get(s, rest * weights[s]) for s in sizes}
        full |= {s: 2 * sizes[s] for s in above}


def test_mix_meets_its_targets(spark):
    rows = _mix_rows(700)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = _targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    docs = _docs(spark, rows)
    mixed = mixing.mix(docs)
    assert {"doc_id", "source", "extra", "name"} <= set(mixed.columns) and "text" not in mixed.columns
    found = mixed.collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.certain * r.size <= r.taken and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
    assert all(abs(taken[s] - targets[s]) <= 0.51 for s in sizes)
    # At most one document of a source is taken in part.
    part = [r.source for r in found if r.taken % max(r.size, 1)]
    assert len(part) == len(set(part))
    again = mixing.mix(docs.repartition(3)).collect()
    pick = lambda rs: sorted(((r.doc_id, r.source, r.size, r.taken) for r in rs), key=repr)
    assert pick(found) == pick(again)
    assert pick(found) != pick(mixing.mix(docs, seed=2).collect())


def test_inclusion_follows_the_odds(spark):
    """Among many documents, those of one length are taken about as often as expected."""
    lengths = (1, 3, 40, 200)
    rows = [(i, "w " * lengths[i % 4], "abc"[i % 3]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kinds = mixing.mix(docs).groupBy("source", "size").agg(
        F.avg(F.col("taken") / F.col("size")).alias("copies"), F.avg(F.col("certain") + F.col("inclusion")).alias("wanted")
    )
    found = kinds.collect()
    assert len({round(r.wanted, 3) for r in found}) > 4
    assert all(abs(r.copies - r.wanted) < 0.1 for r in found)


def test_mix_of_nothing(spark):
    assert mixing.mix(_docs(spark, [(1, "a", "s")]).limit(0)).collect() == []
    silent = mixing.mix(_docs(spark, [(1, None, "s"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in silent] == [(0, 0.0, 0)] * 2
