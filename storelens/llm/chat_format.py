"""Chat formatting by schema fingerprints, with DataFrame functions only.

A record (a variant) has a fingerprint: the hash of its nested field paths, without
types. Declarative mappings are chosen by it and turn prompt, instruction and message
layouts into canonical turns (role, text) of a conversation. A template then writes the
turns with control strings; these strings inside roles and texts are escaped, so that
the output can be read back, and the loss mask covers the assistants' texts.

    <|im_start|>role<|im_sep|>text<|im_end|> ... for each turn

Escaping puts a backslash before each backslash and after the first character of each
control string: no control string is left in a text, and unescaping drops each
backslash that comes first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

#: Strings that mark turns here or in other common chat templates.
CONTROL_STRINGS = (START, SEPARATOR, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
                   "<<SYS>>", "<</SYS>>", "<|system|>", "<|user|>", "<|assistant|>", "<|begin_of_text|>",
                   "<|eot_id|>", "<start_of_turn>", "<end_of_turn>")

#: Role names of common layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """How records with exactly these field paths become turns.

    ``paths``: the nested field paths, as ``a``, ``a.b`` or, inside a list, ``a[].b``. Either ``list_at`` names a list
    of messages with ``role_at`` and ``text_at`` in each, or ``turns`` lists (role, path) of single fields; a path
    tuple is joined by blank lines, and a turn whose text is null or empty is left out unless it is ``required``.
    ``order_at``: where rows of one conversation carry their order.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...], bool], ...] = ()
    list_at: str = ""
    role_at: str = ""
    text_at: str = ""
    order_at: str = ""
    roles: dict[str, str] = field(default_factory=dict, hash=False)


LAYOUTS = (
    Layout("turn_row", ("turn", "role", "text"), role_at="role", text_at="text", order_at="turn"),
    Layout("messages", ("messages[].role", "messages[].content"), list_at="messages", role_at="role", text_at="content"),
    Layout("sharegpt", ("conversations[].from", "conversations[].value"), list_at="conversations", role_at="from",
           text_at="value", roles=ROLES),
    Layout("prompt_completion", ("prompt", "completion"),
           turns=(("user", ("prompt",), True), ("assistant", ("completion",), True))),
    Layout("prompt_response", ("prompt", "response"),
           turns=(("user", ("prompt",), True), ("assistant", ("response",), True))),
    Layout("instruction", ("instruction", "input", "output"),
           turns=(("user", ("instruction", "input"), True), ("assistant", ("output",), True))),
    Layout("instruction_system", ("system", "instruction", "output"),
           turns=(("system", ("system",), False), ("user", ("instruction",), True), ("assistant", ("output",), True))),
    Layout("question_answer", ("question", "answer"),
           turns=(("user", ("question",), True), ("assistant", ("answer",), True))),
)


def _canonical(paths: tuple[str, ...]) -> str:
    """The paths as one nested text with sorted fields: what a variant's schema looks like without its leaf types."""
    tree: dict = {}
    for path in paths:
        at = tree
        for part in path.split("."):
            at = at.setdefault(part, {})

    def text(node: dict) -> str:
        fields = []
        for name, inner in sorted((n.removesuffix("[]"), (n, v)) for n, v in node.items()):
            shown = text(inner[1]) if inner[1] else ""
            fields.append(name + (f": ARRAY<{shown}>" if inner[0].endswith("[]") else f": {shown}" if shown else ""))
        return f"OBJECT<{', '.join(fields)}>"

    return text(tree)


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant as one text, without leaf types (null fields count as fields)."""
    leaf = r": (?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9, ]+\))?(?=[,>])"
    return F.regexp_replace(F.schema_of_variant(record), leaf, "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit(""))


def _renamed(role: Column, names: dict[str, str]) -> Column:
    if not names:
        return role
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, role), role)


def _turns(record: Column, layout: Layout) -> Column:
    """Array of (order, role, text)."""
    def turn(order: Column, role: Column, text: Column) -> Column:
        return F.struct(order.cast("long").alias("at"), role.alias("role"), text.alias("text"))

    if layout.list_at:
        rows = F.try_variant_get(record, f"$.{layout.list_at}",
                                 f"array<struct<`{layout.role_at}`: string, `{layout.text_at}`: string>>")
        return F.transform(F.coalesce(rows, F.array().cast(f"array<struct<`{layout.role_at}`: string, `{layout.text_at}`: string>>")),
                           lambda m, i: turn(i, _renamed(F.coalesce(m[layout.role_at], F.lit("")), layout.roles),
                                             F.coalesce(m[layout.text_at], F.lit(""))))
    if layout.role_at:
        return F.array(turn(F.try_variant_get(record, f"$.{layout.order_at}", "long"),
                            _renamed(_text(record, layout.role_at), layout.roles), _text(record, layout.text_at)))
    made = []
    for k, (role, paths, required) in enumerate(layout.turns):
        filled = F.filter(F.array(*[_text(record, p) for p in paths]), lambda t: t != "")
        made.append(F.struct(F.lit(required).alias("required"),
                             turn(F.lit(k), F.lit(role), F.array_join(filled, "\n\n")).alias("turn")))
    return F.transform(F.filter(F.array(*made), lambda m: m["required"] | (m["turn"]["text"] != "")), lambda m: m["turn"])


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id, layout and ``turns`` (array of role, text) of ``records(conv_id, record)``; record is a variant.

    Records of one conv_id are one conversation, in the order of their turns, then role, then text (so repeated rows
    and ties stay, next to each other; null orders come first). A null field is an empty text or role. Records whose
    fingerprint no layout has, and null records, give a conversation without turns and with a null layout, never an
    error. Null conv_ids are one conversation. Other columns are not read.
    """
    print_of = fingerprint(F.col("record"))
    chosen, turns = F.lit(None).cast("string"), F.array().cast("array<struct<at: bigint, role: string, text: string>>")
    for layout in layouts:
        own = F.col("print") == F.xxhash64(F.lit(_canonical(layout.paths)))
        chosen = F.when(own, F.lit(layout.name)).otherwise(chosen)
        turns = F.when(own, _turns(F.col("record"), layout)).otherwise(turns)
    rows = records.select("conv_id", "record", print_of.alias("print")).select(
        "conv_id", chosen.alias("layout"), turns.alias("turns"))
    return rows.groupBy("conv_id").agg(F.max("layout").alias("layout"),
                                       F.sort_array(F.flatten(F.collect_list("turns"))).alias("turns")).select(
        "conv_id", "layout", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _pattern(strings: tuple[str, ...]) -> str:
    """A control string's first character, where the rest follows."""
    return "|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in strings).replace("/", "\\/")


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"({_pattern(CONTROL_STRINGS)})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turns)`` with ``formatted`` text and ``loss_spans`` (start, length in code points).

    The spans are the assistants' escaped texts, in order. A conversation without turns is an empty text.
    """
    parts = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit(START), escaped(t["role"]), F.lit(SEPARATOR)).alias("head"),
        escaped(t["text"]).alias("body")))
    sizes = F.transform("parts", lambda p: F.struct(
        (p["role"] == ASSISTANT).alias("loss"), F.length(p["head"]).cast("long").alias("head"),
        F.length(p["body"]).cast("long").alias("body")))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start: bigint, length: bigint>>").alias("spans"))
    spans = F.aggregate("sizes", start, lambda acc, p: F.struct(
        (acc["at"] + p["head"] + p["body"] + len(END)).alias("at"),
        F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + p["head"]).alias("start"),
                                                                   p["body"].alias("length")))))
        .otherwise(acc["spans"]).alias("spans")))
    return (conversations.select("*", parts.alias("parts")).select("*", sizes.alias("sizes"))
            .select(*conversations.columns,
                    F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
                    spans["spans"].alias("loss_spans")))


def read_back(formatted: DataFrame) -> DataFrame:
    """From ``formatted`` and ``loss_spans`` alone: conv_id, turns (role, text) and ``loss_texts``, unescaped."""
    literal = lambda s: re.escape(s).replace("\\<", "<").replace("\\>", ">")
    pieces = F.slice(F.split("formatted", literal(START)), 2, 1 << 30)
    turns = F.transform(pieces, lambda p: F.struct(
        unescaped(F.element_at(F.split(p, literal(SEPARATOR)), 1)).alias("role"),
        unescaped(F.regexp_replace(F.element_at(F.split(p, literal(SEPARATOR)), 2), literal(END) + "$", "")).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescaped(
        F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_texts"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of what ``read_back`` finds."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.array_join("loss_texts", "").alias("loss"), F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
