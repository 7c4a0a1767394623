"""Chat formatting: records of differing JSON layouts to canonical turns, to marked text with a loss mask, and back.

A record's nested field paths, without types and values, are its shape; a hash of the shape selects one of the declared
layouts, whose mapping yields the turns. Turns are formatted one by one, so no conversation is ever gathered to be
formatted; its text is its turns' pieces in order.

Defined cases: a null text or role is empty. A record that is null, no JSON, or of an undeclared shape gives no turns and
is listed by ``unknown_shapes``. Repeated rows are repeated turns. Turns that share a number are ordered by role and
text. Field names of a record that are declared as extra are left out of its shape. Everything is DataFrame functions.

Strings may have any length. A record is read as a variant, which holds 128 MiB; a larger record that is JSON stops
``to_turns`` with an error, so that no turn goes silently. Rows of a table need no record of that size: their text stays in
its column (``long_text``).
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame, functions as F

TURNS = "array<struct<role:string,text:string>>"

# The template's control strings, and those of other common templates. Fixed values.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (
    START, MIDDLE, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<start_of_turn>", "<end_of_turn>",
)
MASKED_ROLE = "assistant"

# As strict as try_parse_json, without its limit of 20 million characters a string.
JSON = {"maxStringLen": str((1 << 31) - 1), "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
#: Bytes below which any JSON text fits a variant: a value takes less than eight times its JSON text.
FITS_VARIANT = 1 << 24

# Names that layouts use for the three roles. Fixed values.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Fields:
    """One turn per named field, in this order: (role, field). ``optional`` ones may be absent."""

    turns: Sequence[tuple[str, str]]
    optional: Sequence[str] = ()

    def shapes(self) -> list[str]:
        names = [name for _, name in self.turns]
        free = [n for n in names if n in self.optional]
        absent = chain.from_iterable(combinations(free, k) for k in range(len(free) + 1))
        return [_object(n for n in names if n not in left_out) for left_out in absent]

    def mapping(self, record: Column) -> Column:
        return F.filter(
            F.array(
                *[
                    F.when(
                        F.try_variant_get(record, f"$.{name}", "variant").isNotNull(),
                        F.struct(F.lit(role).alias("role"), _text(record, f"$.{name}").alias("text")),
                    )
                    for role, name in self.turns
                ]
            ),
            lambda t: t.isNotNull(),
        )


@dataclass(frozen=True)
class Messages:
    """One turn per element of ``list_field``; with an empty ``list_field`` the record itself is the one turn."""

    list_field: str
    role: str
    text: str
    roles: Mapping[str, str] = field(default_factory=dict)

    def shapes(self) -> list[str]:
        one = _object([self.role, self.text])
        return [f"{{{self.list_field}:[{one}]}}", f"{{{self.list_field}:[]}}"] if self.list_field else [one]

    def _turn(self, record: Column) -> Column:
        role = _text(record, f"$.{self.role}")
        for known, canonical in self.roles.items():
            role = F.when(role == known, canonical).otherwise(role)
        return F.struct(role.alias("role"), _text(record, f"$.{self.text}").alias("text"))

    def mapping(self, record: Column) -> Column:
        if not self.list_field:
            return F.array(self._turn(record))
        return F.transform(F.try_variant_get(record, f"$.{self.list_field}", "array<variant>"), self._turn)


@dataclass(frozen=True)
class Exchanges:
    """An instruction with further input, answered: the input follows the instruction on a new line."""

    instruction: str
    extra: str
    answer: str

    def shapes(self) -> list[str]:
        return [_object([self.instruction, self.extra, self.answer])]

    def mapping(self, record: Column) -> Column:
        more = _text(record, f"$.{self.extra}")
        asked = F.concat(_text(record, f"$.{self.instruction}"), F.when(more == "", "").otherwise(F.concat(F.lit("\n"), more)))
        return F.array(
            F.struct(F.lit("user").alias("role"), asked.alias("text")),
            F.struct(F.lit("assistant").alias("role"), _text(record, f"$.{self.answer}").alias("text")),
        )


LAYOUTS = {
    "turn_rows": Messages("", "role", "text"),
    "messages": Messages("messages", "role", "content", ROLES),
    "shared": Messages("conversations", "from", "value", ROLES),
    "prompt_response": Fields([("system", "system"), ("user", "prompt"), ("assistant", "response")], ["system"]),
    "prompt_completion": Fields([("system", "system"), ("user", "prompt"), ("assistant", "completion")], ["system"]),
    "question_answer": Fields([("system", "system_prompt"), ("user", "question"), ("assistant", "response")], ["system_prompt"]),
    "instruction": Fields([("user", "instruction"), ("assistant", "output")]),
    "instruction_input": Exchanges("instruction", "input", "output"),
}


def _object(names) -> str:
    return "{" + ",".join(f"{n}:" for n in sorted(names)) + "}"


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def parsed(record: Column) -> Column:
    """JSON text as a variant; null if it is no JSON, or beyond a variant's size."""
    return F.from_json(record, "variant", JSON)


def _complete(record: Column, found: Column) -> Column:
    """``found``, what ``parsed`` makes of ``record``; an error if the record is a JSON object and no variant only by its size."""
    lost = (F.octet_length(record) > FITS_VARIANT) & F.from_json(record, "map<string,string>", JSON).isNotNull()
    return F.coalesce(found, F.when(lost, F.raise_error(F.lit("a record is too large for a variant")).cast("variant")))


def shape(record: Column, extra: Sequence[str] = ()) -> Column:
    """The nested field paths of a variant: its schema without types, and without the top fields in ``extra``.

    Field names stand in the schema in alphabetical order, so that the order within a record does not matter.
    """
    schema = F.regexp_replace(F.schema_of_variant(record), r"\b(?:STRING|VOID|BIGINT|DOUBLE|BOOLEAN|VARIANT|DECIMAL\(\d+,\d+\))", "")
    schema = F.regexp_replace(F.regexp_replace(schema, r"OBJECT<", "{"), r"ARRAY<", "[")
    # After this only '>' closes; it closes what was opened last, which the declared shapes write in the same way.
    bare = F.regexp_replace(F.regexp_replace(schema, r": ", ":"), r", ", ",")
    for name in extra:
        bare = F.regexp_replace(bare, rf"(?<=[{{,]){name}:(?:,|(?=>$))", "")
    return F.regexp_replace(bare, r",(?=>$)", "")


def fingerprint(of: Column) -> Column:
    return F.xxhash64(of)


def _declared(written: str) -> str:
    return written.replace("}", ">").replace("]", ">")


def to_turns(
    records: DataFrame, record: str, layouts: Mapping = LAYOUTS, extra: Sequence[str] = (), long_text: str | None = None
) -> DataFrame:
    """``records`` with ``layout`` (null if unknown) and one row per turn: ``position, role, text``.

    ``record`` names a column of JSON text. Records without a known layout give no rows here. ``long_text`` names a column
    with the text of records that are one turn themselves; where it is not null it stands for the record's own, which then
    may be empty, so that a text of any length needs no place in a record.
    """
    known = records.withColumn("_llm_v", _complete(F.col(record), parsed(F.col(record))))
    known = known.withColumn("_llm_f", fingerprint(shape(F.col("_llm_v"), extra)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, declared in layouts.items():
        fits = F.col("_llm_f").isin(*[fingerprint(F.lit(_declared(s))) for s in declared.shapes()])
        layout = F.when(fits, name).otherwise(layout)
        mapped = declared.mapping(F.col("_llm_v"))
        if long_text and isinstance(declared, Messages) and not declared.list_field:
            mapped = F.array(F.struct(mapped[0]["role"].alias("role"), F.coalesce(F.col(long_text), mapped[0]["text"]).alias("text")))
        turns = F.when(fits, mapped.cast(TURNS)).otherwise(turns)
    named = known.withColumns({"layout": layout, "_llm_turns": turns}).drop("_llm_v", "_llm_f", "position", "role", "text")
    return named.select(
        *[c for c in named.columns if c != "_llm_turns"], F.posexplode("_llm_turns").alias("position", "_llm_turn")
    ).select("*", F.col("_llm_turn.role").alias("role"), F.col("_llm_turn.text").alias("text")).drop("_llm_turn")


def unknown_shapes(records: DataFrame, record: str, layouts: Mapping = LAYOUTS, extra: Sequence[str] = ()) -> DataFrame:
    """``shape, n``: what no layout covers, counted; a null shape is no JSON, or no variant."""
    known = [_declared(s) for declared in layouts.values() for s in declared.shapes()]
    seen = records.select(shape(parsed(F.col(record)), extra).alias("shape"))
    return seen.where(F.col("shape").isNull() | ~F.col("shape").isin(*known)).groupBy("shape").agg(
        F.count(F.lit(1)).alias("n")
    )


def escape(text: Column) -> Column:
    r"""Doubles backslashes and puts one behind the first letter of each control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    """A single backslash can only stand inside a broken control string, as those of the text are doubled."""
    out = text
    for control in CONTROL:
        out = F.replace(out, F.lit(control[0] + "\\" + control[1:]), F.lit(control))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (with ``role, text``) with ``piece``, and ``mask_start, mask_length``: the loss mask in code points.

    The mask covers the escaped text of assistant turns and is empty for the others.
    """
    head = F.concat(F.lit(START), escape(F.coalesce("role", F.lit(""))), F.lit(MIDDLE))
    body = escape(F.coalesce("text", F.lit("")))
    shown = turns.withColumns({"_llm_head": head, "_llm_body": body})
    masked = F.col("role").eqNullSafe(F.lit(MASKED_ROLE))
    return shown.withColumns(
        {
            "piece": F.concat("_llm_head", "_llm_body", F.lit(END + "\n")),
            "mask_start": F.char_length("_llm_head"),
            "mask_length": F.when(masked, F.char_length("_llm_body")).otherwise(0),
        }
    ).drop("_llm_head", "_llm_body")


def read_turns(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``read_role, read_text, read_loss``, taken from the formatted text alone.

    No control string stands inside an escaped text, so the marks can be found by searching.
    """
    inner = F.substring_index(F.col("piece"), END, 1)
    head, body = F.substring_index(inner, MIDDLE, 1), F.substring_index(inner, MIDDLE, -1)
    loss = F.substr("piece", F.col("mask_start") + 1, F.col("mask_length"))
    return pieces.withColumns(
        {
            "read_role": unescape(F.replace(head, F.lit(START), F.lit(""))),
            "read_text": unescape(body),
            "read_loss": unescape(loss),
        }
    )


def digest(read: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Per conversation: counts, and digests of all turns and of all masked text, in order.

    A digest of a conversation is one hash over its whole text, so that its text meets in one value here, and only here.
    """
    ordered = F.sort_array(
        F.collect_list(F.struct(*order, F.col("read_role").alias("r"), F.col("read_text").alias("t"), F.col("read_loss").alias("l")))
    )
    loss = F.array_join(F.transform("_llm_turns", lambda x: x["l"]), "")
    said = F.array_join(F.transform("_llm_turns", lambda x: F.concat(x["r"], F.lit("\n"), x["t"], F.lit("\n"))), "")
    return (
        read.groupBy(key)
        .agg(ordered.alias("_llm_turns"), F.sum(F.char_length("piece")).alias("formatted_chars"))
        .select(
            key,
            F.size("_llm_turns").cast("long").alias("n_turns"),
            F.sha2(said, 256).alias("turns_sha256"),
            F.char_length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss, 256).alias("loss_sha256"),
            F.col("formatted_chars").cast("long").alias("formatted_chars"),
        )
    )
