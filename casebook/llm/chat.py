"""Chat formatting by schema fingerprints (native).

Records of any layout are variants.  The fingerprint of a record is a hash of its
nested field paths (its variant schema without scalar types); it selects a declared
mapping that turns the record into canonical turns (conversation, place, role,
text).  Turns are written in a template with control strings; control strings
inside roles and texts are escaped reversibly, and the loss mask is the list of
spans of the assistant texts in the formatted string.

Template, per turn: ``<|im_start|>`` role newline text ``<|im_end|>`` newline.
Escapes: a backslash is doubled, ``<|`` becomes ``<\\|``, and a newline in a role
becomes ``<\\n``.  So ``<|`` and a role's newline appear in the output only where the
template puts them.

Defined results: null roles and texts are empty; turns are ordered by place (null
first), ties by role, then text; repeated rows are turns of their own; records of
a null conversation id form one conversation; a record whose fingerprint no mapping
declares raises in ``canonical_turns`` unless ``unknown="keep"``, which returns it
with null turns; an empty table gives an empty result; extra columns are ignored.
A conversation is one string by contract, so its length is bounded by a string's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How the records of some layouts become turns.

    ``samples`` are JSON records, one per layout (their values do not matter).
    Either ``items`` is the path of an array whose elements hold ``role`` and
    ``text``, or ``fixed`` lists (role, paths whose texts are joined) turn by turn,
    or ``turn`` holds the paths (conversation, place, role, text) of a record that
    is one turn.
    """

    name: str
    samples: tuple[str, ...]
    items: str | None = None
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    turn: tuple[str, str, str, str] | None = None


MAPPINGS = (
    Mapping("turn rows", ('{"conv_id":1,"turn":0,"role":"user","text":"x"}',),
            turn=("$.conv_id", "$.turn", "$.role", "$.text")),
    Mapping("messages", ('{"messages":[{"role":"user","content":"x"}]}',
                         '{"id":"1","messages":[{"role":"user","content":"x"}]}'), items="$.messages"),
    Mapping("conversations", ('{"conversations":[{"from":"human","value":"x"}]}',
                              '{"id":"1","conversations":[{"from":"human","value":"x"}]}'),
            items="$.conversations", role="from", text="value",
            roles=(("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT))),
    Mapping("instruction", ('{"instruction":"x","output":"y"}', '{"instruction":"x","input":"z","output":"y"}'),
            fixed=(("user", ("$.instruction", "$.input")), (ASSISTANT, ("$.output",)))),
    Mapping("system prompt", ('{"system":"s","prompt":"x","response":"y"}',),
            fixed=(("system", ("$.system",)), ("user", ("$.prompt",)), (ASSISTANT, ("$.response",)))),
    Mapping("prompt", ('{"prompt":"x","completion":"y"}',),
            fixed=(("user", ("$.prompt",)), (ASSISTANT, ("$.completion",)))),
    Mapping("response", ('{"prompt":"x","response":"y"}',),
            fixed=(("user", ("$.prompt",)), (ASSISTANT, ("$.response",)))),
    Mapping("question", ('{"question":"x","answer":"y"}',),
            fixed=(("user", ("$.question",)), (ASSISTANT, ("$.answer",)))),
)

TURNS = "array<struct<conversation:string,place:bigint,role:string,text:string>>"


def fingerprint(record: Column) -> Column:
    """A hash of the nested field paths of a variant, whatever its scalar types."""
    paths = F.regexp_replace(F.schema_of_variant(record), r":\s*(?!OBJECT|ARRAY)[A-Z]+(?:\([0-9, ]*\))?(?=[,>])", "")
    return F.xxhash64(F.regexp_replace(paths, r"ARRAY<(?!OBJECT|ARRAY)[^<>]*>", "ARRAY<>"))


def _turns(mapping: Mapping, record: Column, key: Column) -> Column:
    def text(path: str) -> Column:
        return F.coalesce(F.variant_get(record, path, "string"), F.lit(""))

    def turn(conversation: Column, place: Column, role: Column, body: Column) -> Column:
        return F.struct(conversation.alias("conversation"), place.cast("bigint").alias("place"),
                        role.alias("role"), body.alias("text"))

    if mapping.turn:
        conversation, place, role, body = mapping.turn
        return F.array(turn(F.variant_get(record, conversation, "string"),
                            F.variant_get(record, place, "bigint"), text(role), text(body)))
    if mapping.items:
        kind = f"array<struct<`{mapping.role}`:string,`{mapping.text}`:string>>"
        names = F.create_map(*[F.lit(x) for pair in mapping.roles for x in pair]) if mapping.roles else None

        def one(item: Column, place: Column) -> Column:
            role = F.coalesce(item[mapping.role], F.lit(""))
            role = role if names is None else F.coalesce(names[role], role)
            return turn(key, place, role, F.coalesce(item[mapping.text], F.lit("")))

        return F.coalesce(F.transform(F.variant_get(record, mapping.items, kind), one), F.array().cast(TURNS))
    parts = [turn(key, F.lit(i), F.lit(role), F.array_join(F.filter(
        F.array(*[text(p) for p in paths]), lambda x: x != ""), "\n\n"))
        for i, (role, paths) in enumerate(mapping.fixed)]
    return F.array(*parts)


def canonical_turns(records: DataFrame, record: str, key: str | None = None,
                    mappings: tuple[Mapping, ...] = MAPPINGS, unknown: str = "raise") -> DataFrame:
    """(layout, conversation, place, role, text): the turns of variant records.

    ``key`` names the column that identifies a conversation in layouts that hold
    a whole one per record.
    """
    rows = records.select(F.col(record).alias("v"), (
        F.lit(None) if key is None else F.col(key)).cast("string").alias("key"))
    rows = rows.withColumn("print", fingerprint(F.col("v")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in mappings:  # hashes of the samples are constants of the plan
        known = F.col("print").isin(*[fingerprint(F.parse_json(F.lit(s))) for s in mapping.samples])
        layout = F.when(known, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(known, _turns(mapping, F.col("v"), F.col("key"))).otherwise(turns)
    if unknown == "raise":
        turns = F.coalesce(turns, F.raise_error(F.concat(
            F.lit("no mapping for the layout "), F.schema_of_variant(F.col("v")))).cast(TURNS))
    rows = rows.select(layout.alias("layout"), F.explode_outer(turns).alias("t"))
    return rows.select("layout", "t.conversation", "t.place", "t.role", "t.text")


def escape(text: Column, newline: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("<\\n")) if newline else out


def unescape(text: Column, newline: bool = False) -> Column:
    out = F.replace(text, F.lit("<\\n"), F.lit("\n")) if newline else text
    return F.replace(F.replace(out, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conversation, formatted, loss): the string, and its spans (start, length) under the loss mask.

    Spans count code points of the formatted string from 0, in order.
    """
    head = F.concat(F.lit(START), escape(F.col("role"), newline=True), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = turns.select("conversation", F.struct(
        "place", "role", "text", head.alias("head"), body.alias("body"),
        (F.col("role") == ASSISTANT).alias("learnt")).alias("t"))
    whole = pieces.groupBy("conversation").agg(F.sort_array(F.collect_list("t")).alias("t"))
    tail = F.lit(END + "\n")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        size = F.length(t["body"])
        spans = F.when(t["learnt"], F.concat(state["spans"], F.array(F.struct(
            start.alias("start"), size.alias("length"))))).otherwise(state["spans"])
        return F.struct((start + size + F.length(tail)).alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return whole.select(
        "conversation",
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], tail)), "").alias("formatted"),
        F.aggregate("t", empty, add, lambda s: s["spans"]).alias("loss"))


def read_back(text: Column) -> Column:
    """array<struct<role,text>>: the turns of a formatted string, unescaped."""
    parts = F.slice(F.split(text, r"<\|im_start\|>", -1), 2, 1 << 30)

    def turn(part: Column) -> Column:
        body = F.left(part, F.length(part) - len(END) - 1)
        cut = F.instr(body, "\n")
        return F.struct(unescape(F.left(body, cut - 1), newline=True).alias("role"),
                        unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    return F.transform(parts, turn)


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, s["start"] + 1, s["length"]))), "")
