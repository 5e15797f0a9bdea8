"""Chat formatter: layouts are told by a fingerprint of their field paths.

A record is a VARIANT (nested data without a fixed schema).  Its fingerprint is a hash
of its nested field paths, which ``schema_of_variant`` gives; scalar types do not count.
``LAYOUTS`` maps fingerprints to declarative mappings: SQL expressions that give the canonical
turns, an array of (role, text).  The fingerprints are those of each layout's sample records.
Canonical turns are then written in one template:

    <|im_start|>ROLE LF TEXT<|im_end|> LF

Control strings inside texts and roles are escaped: a backslash is doubled, then ``<|`` becomes
``<\\|`` and a line end in a role ``<\\n>``.  A single backslash behind ``<`` cannot come from
doubling, so this can be undone exactly.  Everything is built-in expressions, row by row.

Defined results: a null text is empty, a null role is empty; a record of an unknown layout or without
turns has a null ``layout`` or no turns, and is returned with empty text.  Turns are formatted
whole, whatever their length; further fields of a record change its fingerprint, further columns do not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """Sample JSON records whose paths name the layout, and its turns as SQL over ``record``."""

    name: str
    samples: tuple[str, ...]
    turns: str


def _pair(prompt: str, answer: str) -> str:
    return (
        "array(named_struct('role', 'user', 'text', {}), named_struct('role', 'assistant', 'text', {}))"
    ).format(prompt, answer)


def _text(path: str) -> str:
    return f"variant_get(record, '$.{path}', 'string')"


def _list(path: str, role: str, text: str, role_expression: str = "t.role") -> str:
    kind = f"array<struct<{role}: string, {text}: string>>"
    expression = role_expression.replace("t.role", f"t.{role}")
    return (
        f"transform(variant_get(record, '$.{path}', '{kind}'),"
        f" t -> named_struct('role', {expression}, 'text', t.{text}))"
    )


LAYOUTS = [
    Layout(
        "messages",
        ('{"messages": [{"role": "a", "content": "b"}]}',),
        _list("messages", "role", "content"),
    ),
    Layout(
        "speakers",
        ('{"conversations": [{"from": "a", "value": "b"}]}',),
        _list(
            "conversations", "from", "value",
            "CASE t.role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE t.role END",
        ),
    ),
    Layout(
        "prompt", ('{"prompt": "a", "response": "b"}',), _pair(_text("prompt"), _text("response"))
    ),
    Layout(
        "instruction",
        ('{"instruction": "a", "output": "b"}',),
        _pair(_text("instruction"), _text("output")),
    ),
    Layout(
        "instruction_input",
        ('{"instruction": "a", "input": "b", "output": "c"}',),
        _pair(f"concat({_text('instruction')}, '\\n', {_text('input')})", _text("output")),
    ),
]


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a VARIANT."""
    paths = F.regexp_replace(
        F.schema_of_variant(record), r"\b(STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\([^)]*\))", "*"
    )
    return F.sha2(paths, 256)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n>"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def canonical(records: DataFrame, key: str, record: str, layouts=LAYOUTS) -> DataFrame:
    """key, layout and turns (array of role and text) of each record."""
    rows = records.select(F.col(key).alias("_key"), F.col(record).alias("record"))
    found = fingerprint(F.col("record"))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        known = [fingerprint(F.parse_json(F.lit(sample))) for sample in layout.samples]
        fits = F.col("fingerprint").isin(*known)
        name = F.when(fits, F.lit(layout.name)).otherwise(name)
        turns = F.when(fits, F.expr(layout.turns).cast(TURNS)).otherwise(turns)
    return rows.withColumn("fingerprint", found).select(
        F.col("_key").alias(key), name.alias("layout"), turns.alias("turns")
    )


def _empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def formatted(turns: DataFrame, key: str) -> DataFrame:
    """key, layout, text and loss_spans (start, length) of each record's canonical turns.

    Spans are 0-based code point positions in ``text`` of the assistant texts as written there.
    """
    pieces = F.transform(
        F.coalesce("turns", F.array().cast(TURNS)),
        lambda t: F.struct(
            F.concat(F.lit(START), escaped_role(_empty(t["role"])), F.lit("\n")).alias("head"),
            escaped(_empty(t["text"])).alias("body"),
            (_empty(t["role"]) == "assistant").alias("loss"),
        ),
    )
    tail = F.lit(END + "\n")
    rows = turns.select(F.col(key).alias("_key"), "layout", pieces.alias("pieces")).select(
        "_key",
        "layout",
        "pieces",
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["body"], tail)), ""
        ).alias("text"),
    )
    none = F.array().cast("array<struct<start: bigint, length: bigint>>")

    def place(state, p):
        start = state["at"] + F.length(p["head"])
        span = F.struct(start.alias("start"), F.length(p["body"]).cast("bigint").alias("length"))
        return F.struct(
            (start + F.length(p["body"]) + len(END) + 1).alias("at"),
            F.when(p["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            .alias("spans"),
        )

    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans")), place,
        lambda state: state["spans"],
    )
    return rows.select(F.col("_key").alias(key), "layout", "text", spans.alias("loss_spans"))


def read_back(texts: DataFrame, key: str, text: str = "text", spans: str = "loss_spans") -> DataFrame:
    """key, turns and loss_texts, all from the formatted text and its spans, escapes undone."""
    blocks = F.filter(F.split(F.col(text), r"<\|im_start\|>"), lambda b: b != "")
    cut = len(END) + 1

    def turn(block):
        head = F.instr(block, "\n")
        role = F.substring(block, F.lit(1), head - 1)
        body = F.substring(block, head + 1, F.length(block) - head - cut)
        return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    loss = F.transform(
        spans,
        lambda s: unescaped(
            F.substring(F.col(text), (s["start"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return texts.select(
        F.col(key), F.col(text), F.transform(blocks, turn).alias("turns"), loss.alias("loss_texts")
    )
