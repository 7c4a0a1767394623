"""Repair of damaged conversations: the cheapest edits that make the roles alternate, by iterative-deepening A*.

A sound conversation has the role initials ``(s?(ua)+)?``: an optional system turn, then user and assistant in turn. Turns
are deleted (3), kept (0), given the role user or assistant (2), or inserted empty (2); a blank turn and one that was said
before must be deleted, and a truncated one that stays costs 1 more. Of the cheapest repairs the one whose edits' initials
come first in ASCII is taken.

The search goes depth first, edits in ASCII order, under a cost bound that grows; a state is the number of turns read and
the last role written. Each state starts with a lower bound of its cost to the end: what its blank, repeated and
truncated turns cost anyhow, and one edit for each pair of turns that cannot follow one another, no turn being in two
pairs. A state that fails has the table hold what it would need at least, so it is entered again with more only; what the
first turn needs is the next bound. All repairs within the first bound that admits any cost the same, so the first one found
is the answer.

Conversations are dealt by key and sorted outside memory; a task reads one turn after another and holds a byte or two per
turn, a few numbers per state, and the digests of what was said; texts beyond ``SPILL`` code points wait in a file of the
task. A conversation of very many turns is searched in one task, since its answer is one string.

Defined cases: nulls in role and text are taken as one space, turns without a number come first, turns of one number are in
the order of role and text, repeated rows are repeated turns, and rows without a key are one conversation. Rows may be marked
as absent: they count for nothing but that their conversation exists. Other columns are not carried, whatever their names. An
empty table gives an empty result.
"""

import pickle
import re
import tempfile
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Code points of one conversation that a task holds in memory.
SPILL = 1 << 24
_SPACES = "\x20\t\n\x0b\x0c\r"
_MARKS = ".!?"
DELETE, KEEP, REROLE, INSERT, TRUNCATED = 3, 0, 2, 2, 1

# What was written last: nothing, a system turn, a user turn, an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEPT = {
    (_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
}
_WRITTEN = (_USER, _USER, _ASSISTANT, _USER)  # the role that a rewritten or new turn must have, behind each state
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_FOLLOW = {"su", "ua", "au"}

SOUND, CUT, GONE = range(3)  # a turn as it is, truncated, or to be deleted


def _lower_bounds(kinds: bytes, initials: list[str]) -> list[int]:
    """For each state, numbered ``4 * turns read + last role``: what the rest costs at least."""
    n = len(kinds)
    stays = [i for i in range(n) if kinds[i] != GONE]
    forced = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        forced[i] = forced[i + 1] + (0, TRUNCATED, DELETE)[kinds[i]]
    # pairs[k]: disjoint neighbours that cannot follow one another, from the k-th staying turn on; the end is one more.
    pairs = [0] * (len(stays) + 2)
    for k in range(len(stays) - 1, -1, -1):
        here = initials[stays[k]]
        fits = here == "a" if k + 1 == len(stays) else here + initials[stays[k + 1]] in _FOLLOW
        pairs[k] = max(pairs[k + 1], 0 if fits else 1 + pairs[k + 2])
    need = [0] * (4 * n + 4)
    k = len(stays)
    for i in range(n, -1, -1):
        if i < n and kinds[i] != GONE:
            k -= 1
        for q in range(4):
            if k == len(stays):
                more = 2 * INSERT if q == _SYSTEM else INSERT if q == _USER else 0
            elif (q, initials[stays[k]]) in _KEPT:
                more = 2 * pairs[k]
            else:
                more = 2 * max(pairs[k], 1 + pairs[k + 1])
            need[4 * i + q] = forced[i] + more
    return need


def _edits(i: int, q: int, kinds: bytes, initials: list[str]) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state), in ASCII order."""
    if i < len(kinds):
        yield "D", DELETE, 4 * (i + 1) + q
    yield "I", INSERT, 4 * i + _WRITTEN[q]
    if i < len(kinds) and kinds[i] != GONE:
        more = TRUNCATED if kinds[i] == CUT else 0
        kept = _KEPT.get((q, initials[i]))
        if kept is not None:
            yield "K", KEEP + more, 4 * (i + 1) + kept
        yield "R", REROLE + more, 4 * (i + 1) + _WRITTEN[q]


def cheapest_edits(kinds: bytes, initials: list[str]) -> tuple[int, str]:
    """(cost, edits) for turns of these kinds and role initials."""
    ends = (4 * len(kinds) + _START, 4 * len(kinds) + _ASSISTANT)
    need = _lower_bounds(kinds, initials)
    bound = need[_START]
    while True:
        # One frame per edit on the path: state, cost left, edits still to try, least need seen, the edit that led here.
        stack = [(_START, bound, _edits(0, _START, kinds, initials), [1 << 60], "")]
        while stack:
            state, left, edits, least, _ = stack[-1]
            if state in ends:
                return bound - left, "".join(frame[4] for frame in stack)
            for initial, cost, to in edits:
                if need[to] + cost <= left:
                    stack.append((to, left - cost, _edits(to // 4, to % 4, kinds, initials), [1 << 60], initial))
                    break
                least[0] = min(least[0], need[to] + cost)
            else:
                need[state] = max(need[state], left + 1, least[0])
                stack.pop()
                if stack:
                    above, came = stack[-1], need[state]
                    above[3][0] = min(above[3][0], came + above[1] - left)
        bound = need[_START]


def damage(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key, turn, role, text, present``: turns damaged by crc32 of "key:turn" modulo 20; nulls are one space.

    0 leaves the turn out (not present), 1 empties its text, 2 takes out its ``.!?``, 3 says it twice, 4 has the user say it.
    """
    space = F.lit(" ")
    fault = F.pmod(F.crc32(F.concat(*[F.coalesce(F.col(c).cast("string"), space) for c in (key,)], F.lit(":"),
                                    F.coalesce(F.col(turn).cast("string"), space))), F.lit(20))
    by, said = F.coalesce(F.col(role).cast("string"), space), F.coalesce(F.col(text), space)
    faulty = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"), fault.alias("fault"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    said = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", _MARKS, "")).otherwise(F.col("text"))
    gone = F.col("fault") == 0
    return faulty.select(
        "key", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(F.col("fault") == 4, "user").when(~gone, F.col("role")).alias("role"),
        F.when(~gone, said).alias("text"), (~gone).alias("present"), F.explode(copies).alias("copy"),
    ).drop("copy")


class _Texts:
    """(role, text) of a conversation's turns, in order, read back once or more; in a file beyond ``limit``."""

    def __init__(self, limit: int):
        self.limit, self.held, self.turns, self.file = limit, 0, [], None

    def append(self, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.held += len(role) + len(text)
        if self.held > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            for turn in self.turns:
                pickle.dump(turn, self.file)
            self.held, self.turns = 0, []

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield pickle.load(self.file)
        yield from self.turns


class Conversation:
    """Turns as they come; then the faults and the repair."""

    def __init__(self, limit: int = SPILL):
        self.kinds, self.initials, self.texts, self.said = bytearray(), [], _Texts(limit), set()
        self.first = self.last = None
        self.numbers = self.blank = self.duplicate = self.truncated = 0

    def append(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.numbers = turn, self.numbers + 1
        digest = blake2b(b"%d:" % len(role) + role.encode() + text.encode(), digest_size=16).digest()
        body, kind = text.rstrip(_SPACES), SOUND
        if not body:
            self.blank, kind = self.blank + 1, GONE
        elif digest in self.said:
            self.duplicate, kind = self.duplicate + 1, GONE
        elif body[-1] not in _MARKS:
            self.truncated, kind = self.truncated + 1, CUT
        self.said.add(digest)
        self.kinds.append(kind)
        self.initials.append(role[:1])
        self.texts.append(role, text)

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.numbers

    @property
    def illegal(self) -> int:
        return sum(a + b not in _FOLLOW for a, b in zip(self.initials, self.initials[1:]))

    def repaired(self, edits: str) -> Iterator[tuple[str, str]]:
        turns, last = iter(self.texts), _START
        initials = iter(self.initials)
        for edit in edits:
            if edit == "I":
                last = _WRITTEN[last]
                yield _ROLE[last], ""
                continue
            (role, text), initial = next(turns), next(initials)
            if edit == "K":
                last = _KEPT[last, initial]
                yield role, text
            elif edit == "R":
                last = _WRITTEN[last]
                yield _ROLE[last], text


def _conversations(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[object, Conversation]]:
    """Each conversation of batches with key, turn, role, text, present, sorted by them."""
    key, now = None, None
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            for k, turn, role, text, present in zip(*[c.slice(low, 64).to_pylist() for c in batch.columns]):
                if now is None or k != key:
                    if now is not None:
                        yield key, now
                    key, now = k, Conversation(limit)
                if present:
                    now.append(turn, role, text)
    if now is not None:
        yield key, now


def _dealt(turns: DataFrame, key: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    space = F.lit(" ")
    there: Column = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = turns.select(
        F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"), there.alias("present"),
    )
    return rows.repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text")


def _key_type(turns: DataFrame, key: str) -> str:
    return turns.schema[key].dataType.simpleString()


_FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repairs(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: str | None = None, limit: int = SPILL,
) -> DataFrame:
    """Per conversation: its faults, the cost and the edits of the repair, and the SHA-256 of the repaired turns.

    ``key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``; the digest is that of ``role:text``
    joined by line breaks, hashed turn by turn. ``gaps`` are the missing numbers between the first and the last turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for value, talk in _conversations(batches, limit):
            cost, audit = cheapest_edits(bytes(talk.kinds), talk.initials)
            state, between = sha256(), b""
            for by, said in talk.repaired(audit):
                state.update(between + f"{by}:{said}".encode())
                between = b"\n"
            done.append((value, talk.gaps, talk.blank, talk.duplicate, talk.truncated, talk.illegal, cost, audit, state.hexdigest()))
            if len(done) >= 1000:
                yield made(done)
        yield made(done)

    def made(done: list[tuple]) -> pa.RecordBatch:
        kinds = [None, *[pa.int64()] * len(_FAULTS), pa.string(), pa.string()]
        columns = [pa.array([x[i] for x in done], kind) for i, kind in enumerate(kinds)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=["key", *_FAULTS, "audit", "repaired_sha256"])

    kinds = ", ".join([f"key {_key_type(turns, key)}", *[f"{c} long" for c in _FAULTS], "audit string", "repaired_sha256 string"])
    return _dealt(turns, key, turn, role, text, present).mapInArrow(run, kinds)


def repaired_turns(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: str | None = None, limit: int = SPILL,
) -> DataFrame:
    """``key, position, role, text``: the turns of the repaired conversations, from position 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for value, talk in _conversations(batches, limit):
            _, audit = cheapest_edits(bytes(talk.kinds), talk.initials)
            for place, (by, said) in enumerate(talk.repaired(audit)):
                done.append((value, place, by, said))
                if len(done) >= 500:
                    yield made(done)
        yield made(done)

    def made(done: list[tuple]) -> pa.RecordBatch:
        kinds = [None, pa.int64(), pa.string(), pa.string()]
        columns = [pa.array([x[i] for x in done], kind) for i, kind in enumerate(kinds)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=["key", "position", "role", "text"])

    kinds = f"key {_key_type(turns, key)}, position long, role string, text string"
    return _dealt(turns, key, turn, role, text, present).mapInArrow(run, kinds)
