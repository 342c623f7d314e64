"""Chat formatting: conversations as one training text each, with a mask of what is learned.

A conversation's turns are collected as structs and sorted, neighbouring turns of one role become one
turn with several texts, and all is concatenated; every step is a Spark expression. A turn is

    <open> role \\n <text> \\n first text \\n <text> \\n next text \\n <close> \\n

An escape character goes before each control string (open, text, close) that a role or text holds, so
none of them is ever read as the template's own, and taking it away again restores them. The template
keeps a line break between what it holds and its control strings, so a text may end in escape
characters. The mask is a list of spans of the formatted text, in code points: the texts of the
learned roles, each on its own.

Turns are ordered by turn, then role, then text (null turns first), so repeated rows and ties have one
order. Null texts and roles count as empty. Rows without conversation id are one conversation. Other
columns are ignored. A conversation is one string, so it can have at most 2 GB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    open: str = "### "
    text: str = "<text>"
    close: str = "</turn>"
    escape: str = "\\"

    def __post_init__(self):
        controls = self.controls()
        for x in controls:
            for y in controls:
                if not x or (x != y and x in y) or any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)))):
                    raise ValueError(f"the control strings {x!r} and {y!r} overlap")
            if len(self.escape) != 1 or self.escape in x or x.startswith("\n"):
                raise ValueError("the escape character must be one that no control string holds")

    def controls(self) -> tuple[str, str, str]:
        return self.open, self.text, self.close

    def escaped(self, value: Column) -> Column:
        for control in self.controls():
            value = F.replace(value, F.lit(control), F.lit(self.escape + control))
        return value

    def unescaped(self, value: Column) -> Column:
        for control in self.controls():
            value = F.replace(value, F.lit(self.escape + control), F.lit(control))
        return value

    def before_text(self) -> str:
        return f"\n{self.text}\n"

    def after_turn(self) -> str:
        return f"\n{self.close}\n"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def indices(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)


def sums_before(numbers: Column, block: int = 128) -> Column:
    """Of an array of longs the sum before each element; by blocks, so long arrays need no long sums."""

    def within(values: Column) -> Column:
        blocks = F.ceil(F.size(values) / F.lit(block)).cast("int")
        sums = F.transform(indices(blocks), lambda k: total(F.slice(values, k * block + 1, F.lit(block))))

        def shifted(block_sums: Column) -> Column:
            starts = F.transform(block_sums, lambda _, k: total(F.slice(block_sums, F.lit(1), k)))
            return let(starts, lambda at: F.transform(
                values, lambda _, i: F.get(at, F.floor(i / F.lit(block)).cast("int")) + total(F.slice(values, i - i % block + 1, i % block))
            ))

        return let(sums, shifted)

    return let(numbers, within)


def merged_turns(turns: Column) -> Column:
    """Sorted turns (role, text) as array<struct<role, texts>>, neighbours of one role together."""

    def merge(all_: Column) -> Column:
        starts = F.filter(indices(F.size(all_)), lambda i: (i == 0) | (F.get(all_, i)["role"] != F.get(all_, i - 1)["role"]))

        def cut(firsts: Column) -> Column:
            def one(first: Column, k: Column) -> Column:
                end = F.coalesce(F.get(firsts, k + 1), F.size(all_))
                texts = F.transform(F.slice(all_, first + 1, end - first), lambda t: t["text"])
                return F.struct(F.get(all_, first)["role"].alias("role"), texts.alias("texts"))

            return F.transform(firsts, one)

        return let(starts, cut)

    return let(turns, merge)


def format_conversations(
    turns: DataFrame, template: Template = Template(), learned_roles: tuple[str, ...] = ("assistant",),
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The id, `formatted` and `loss_spans` (array of start and end, exclusive) of every conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text")))
    collected = turns.groupBy(F.col(id_col).alias("id")).agg(
        F.collect_list(F.struct(F.col(turn_col).alias("turn"), role, text)).alias("turns")
    )
    merged = collected.select("id", merged_turns(F.array_sort("turns")).alias("merged"))

    def shaped(turn: Column) -> Column:
        """A turn as text, and the spans of its texts relative to its start if it is learned."""
        texts = F.transform(turn["texts"], template.escaped)

        def body(escaped: Column) -> Column:
            head = F.concat(F.lit(template.open), template.escaped(turn["role"]))
            parts = F.transform(escaped, lambda t: F.concat(F.lit(template.before_text()), t))
            piece = F.concat(head, F.array_join(parts, ""), F.lit(template.after_turn()))
            gap = len(template.before_text())
            lengths = F.transform(escaped, lambda t: F.length(t).cast("long"))

            def spans(sizes: Column) -> Column:
                at = sums_before(F.transform(sizes, lambda n: n + gap))
                return F.zip_with(at, sizes, lambda a, n: F.struct((a + F.length(head) + gap).alias("start"), (a + F.length(head) + gap + n).alias("end")))

            none = F.array().cast("array<struct<start: bigint, end: bigint>>")
            return F.struct(piece.alias("piece"), F.when(turn["role"].isin(*learned_roles), let(lengths, spans)).otherwise(none).alias("spans"))

        return let(texts, body)

    pieces = merged.select("id", F.transform("merged", shaped).alias("pieces"))
    starts = sums_before(F.transform("pieces", lambda p: F.length(p["piece"]).cast("long")))
    shifted = F.zip_with(
        F.col("pieces"), starts,
        lambda p, at: F.transform(p["spans"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"))),
    )
    formatted = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return pieces.select(F.col("id").alias(id_col), formatted.alias("formatted"), F.flatten(shifted).alias("loss_spans"))


def _literal(pattern: str) -> str:
    return r"\Q" + pattern + r"\E"


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation, each as it was before turns were merged."""
    ended = F.split(formatted, _literal(template.after_turn()), -1)
    pieces = F.slice(ended, 1, F.size(ended) - 1)

    def turns(piece: Column) -> Column:
        fields = F.split(F.substring(piece, F.lit(len(template.open) + 1), F.lit(2**31 - 1)), _literal(template.before_text()), -1)

        def pairs(values: Column) -> Column:
            texts = F.slice(values, F.lit(2), F.size(values) - 1)
            return F.transform(texts, lambda t: F.struct(template.unescaped(values[0]).alias("role"), template.unescaped(t).alias("text")))

        return let(fields, pairs)

    return let(formatted, lambda _: F.flatten(F.transform(pieces, turns)))


def masked_texts(formatted: Column, spans: Column, template: Template = Template()) -> Column:
    """What lies under the mask, unescaped, span by span."""

    def cut(text: Column) -> Column:
        return F.transform(spans, lambda s: template.unescaped(
            F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ))

    return let(formatted, cut)
