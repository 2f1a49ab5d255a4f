"""Chat formatting by schema fingerprints.

A record is JSON in any of several layouts.  The paths of its fields, hashed, choose the
mapping that turns it into an array of (role, text) turns; the template then writes the
turns with control strings between them and escapes in texts whatever could be read as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role: string, text: string>>"

# The control strings of the template.
TURN_BEGIN = "<|turn|>"
TEXT_BEGIN = "<|says|>"
TURN_END = "<|end|>"

# What may not appear in a text, and what stands for it.  The escape sign
# comes first when texts are escaped and last when they are read back.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))

# Strict JSON of any text length; what is not goes to ``_corrupt``.
PARSER = {"maxStringLen": str((1 << 31) - 1), "allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}
# Skeletons of this many characters fit a variant whatever they are made of.
MOST_BARE = 16 << 20


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths its records have, and SQL that makes turns of ``record``.

    ``record`` is a struct of the fields that the paths of all mappings name.
    """

    name: str
    paths: tuple[str, ...]
    turns: str


def _turn(role: str, path: str) -> str:
    return f"struct('{role}' as role, record.{path} as text)"


def _listed(path: str, role: str, text: str) -> str:
    return f"transform(record.{path}, m -> struct(m.`{role}` as role, m.`{text}` as text))"


MAPPINGS = (
    Mapping("messages", ("messages[].content", "messages[].role"), _listed("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), _listed("conversations", "from", "value")),
    Mapping("prompt", ("completion", "prompt"), f"array({_turn('user', 'prompt')}, {_turn('assistant', 'completion')})"),
    Mapping("instruction", ("instruction", "output"), f"array({_turn('user', 'instruction')}, {_turn('assistant', 'output')})"),
    Mapping(
        "instruction with system",
        ("instruction", "output", "system"),
        f"array({_turn('system', 'system')}, {_turn('user', 'instruction')}, {_turn('assistant', 'output')})",
    ),
)


def field_paths(record: Column) -> Column:
    """Sorted paths of a record's scalar fields, ``[]`` for the items of an array.

    Read from the record's own schema text: names between the brackets of objects become
    path steps.  Field types do not count.
    """
    shape = F.schema_of_variant(record)
    top = F.regexp_extract_all(shape, F.lit(r"(\w+): (?:ARRAY<OBJECT<[^<>]*>>|[A-Z]+(?:\([0-9, ]+\))?)"), F.lit(0))

    def steps(field: Column) -> Column:
        name = F.regexp_extract(field, r"^(\w+): ", 1)
        inner = F.regexp_extract_all(F.regexp_extract(field, r"ARRAY<OBJECT<([^<>]*)>>", 1), F.lit(r"(\w+): "), F.lit(1))
        return F.when(
            field.contains("ARRAY<OBJECT<"), F.transform(inner, lambda x: F.concat(name, F.lit("[]."), x))
        ).otherwise(F.array(name))

    return F.array_sort(F.flatten(F.transform(top, steps)))


def skeleton(record: Column) -> Column:
    """A JSON text with its string values empty, and of equal objects in a row only one.

    It has the paths of the record, and stays short however long texts and lists are: the
    JSON parser gives null above 20 million characters a string, a variant above 128 MB.
    Possessive quantifiers keep the matcher off the stack.
    """
    inside = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
    # A value leaves its quotes, a name all of it.
    bare = F.regexp_replace(record, rf'(?s)("){inside}(")(?!\s*+:)|("{inside}")', "$1$2$3")
    return F.regexp_replace(bare, r"(\{[^{}]*+\})(?:\s*+,\s*+\1)++", "$1")


def _fields(mappings: Sequence[Mapping]) -> str:
    """Schema of the fields that the mappings read; ``[]`` is a list of structs."""
    inside: dict[str, set[str]] = {}
    for path in {p for m in mappings for p in m.paths}:
        name, listed, inner = path.partition("[].")
        inside.setdefault(name, set()).update([inner] if listed else [])
    kinds = {
        name: f"array<struct<{', '.join(f'`{i}`: string' for i in sorted(inner))}>>" if inner else "string"
        for name, inner in inside.items()
    }
    return f"struct<{', '.join(f'`{name}`: {kinds[name]}' for name in sorted(kinds))}, _corrupt: string>"


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def canonical_turns(records: DataFrame, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` and ``turns`` in place of the JSON text ``record``.

    Records that are null, not JSON or of no known layout get a null layout and null turns.
    Null roles and texts are empty.  Texts may have any length that a Spark string holds
    (2 GB a record); beyond it the job fails, as it does for millions of unlike objects in
    one list.
    """
    parsed = (
        records.withColumn("bare", skeleton(F.col("record")))
        .withColumn(
            "bare",
            F.when(F.length("bare") > MOST_BARE, F.raise_error(F.lit("too many unlike objects in a record")))
            .otherwise(F.col("bare")),
        )
        .withColumn("print", fingerprint(field_paths(F.try_parse_json("bare"))))
        .withColumn("record", F.from_json("record", _fields(mappings), PARSER))
        # Broken inside a string, where the skeleton does not look.
        .withColumn("print", F.when(F.col("record._corrupt").isNull(), F.col("print")))
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in mappings:
        wanted = fingerprint(F.array(*(F.lit(p) for p in sorted(mapping.paths))))
        layout = F.when(F.col("print") == wanted, F.lit(mapping.name)).otherwise(layout)
        made = F.expr(mapping.turns).cast(TURNS)
        turns = F.when(F.col("print") == wanted, made).otherwise(turns)
    filled = F.transform(
        turns,
        lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")
        ),
    )
    return parsed.withColumn("layout", layout).withColumn("turns", filled).drop("record", "bare", "print")


def escaped(text: Column) -> Column:
    for sign, standing in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(standing))
    return text


def unescaped(text: Column) -> Column:
    for sign, standing in reversed(ESCAPES):
        text = F.replace(text, F.lit(standing), F.lit(sign))
    return text


def formatted(turns: Column) -> Column:
    """One text per conversation: no sign of a control string can come from a turn."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(
                F.lit(TURN_BEGIN), escaped(t["role"]), F.lit(TEXT_BEGIN), escaped(t["text"]), F.lit(TURN_END)
            ),
        ),
        "",
    )


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    def turn(piece: Column) -> Column:
        at = F.instr(piece, TEXT_BEGIN)
        return F.struct(
            unescaped(F.substring(piece, F.lit(len(TURN_BEGIN) + 1), at - len(TURN_BEGIN) - 1)).alias("role"),
            unescaped(F.substring(piece, at + len(TEXT_BEGIN), F.length(piece))).alias("text"),
        )

    pieces = F.split(text, TURN_END.replace("|", r"\|"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(turns: Column) -> Column:
    """All text a model is trained on: the assistant's, in order, nothing between."""
    said = F.filter(turns, lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(said, lambda t: t["text"]), "")


def conversation_records(rows: DataFrame) -> DataFrame:
    """``conv_id, record``: the turns of each conversation as JSON.

    A conversation of one user and one assistant turn becomes a prompt with completion, with
    a system turn before them an instruction with system; any other is a list of messages.
    Rows with equal turn numbers follow role and text; null role or text is empty; rows
    without ``conv_id`` are one conversation.  A conversation is one text, so its rows meet.
    """
    said = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("content"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("said"))
    roles = F.array_join(F.transform("said", lambda m: escaped(m["role"])), "[")
    text = [F.get("said", F.lit(k))["content"] for k in range(3)]
    messages = F.transform("said", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    record = (
        F.when(roles == "user[assistant", F.to_json(F.struct(text[0].alias("prompt"), text[1].alias("completion"))))
        .when(
            roles == "system[user[assistant",
            F.to_json(F.struct(text[0].alias("system"), text[1].alias("instruction"), text[2].alias("output"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return whole.select("conv_id", record.alias("record"))
