"""Chat formatting with Spark expressions only.

Turn structs are collected and sorted, adjacent turns of one role merge into a block,
and the blocks are joined into one text:

    [INST]role[/INST]text<s>text</s>[INST]role[/INST]text</s>

``<s>`` stands between the texts of one block, so merging loses nothing. Control
strings inside roles and texts are escaped: backslashes double, then a backslash
goes behind the first character of every control string. No control string may be a
prefix of another, begin and end alike, or hold a backslash; then undoing the steps in
reverse order gives the text back.

Cases: a NULL text or role is an empty one; a NULL conversation is one more
conversation; NULL turns come first; equal turns are ordered by role, then text, and
repeated rows are all kept; no rows give no conversations; other columns are ignored.
A conversation becomes one row, as its formatted text is one value. Turns are gathered
in runs of ``RUN_TURNS`` first, so a long conversation is sorted and merged in parts
and only its merged runs meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.tables import bound

RUN_TURNS = 64
# Lengths added up in one go while offsets are computed.
OFFSET_RUN = 256


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings around roles and texts, and the role a model learns from."""

    open: str = "[INST]"
    body: str = "[/INST]"
    next: str = "<s>"
    close: str = "</s>"
    learned_role: str = "assistant"

    def __post_init__(self):
        for one in self.controls:
            if not one or "\\" in one:
                raise ValueError(f"control string {one!r} is empty or holds a backslash")
            if any(one[:n] == one[-n:] for n in range(1, len(one))):
                raise ValueError(f"control string {one!r} begins and ends alike")
            if sum(other.startswith(one) for other in self.controls) > 1:
                raise ValueError(f"control string {one!r} begins another one")

    @property
    def controls(self) -> list[str]:
        return [self.open, self.body, self.next, self.close]

    def escape(self, text: Column) -> Column:
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for one in self.controls:
            out = F.replace(out, F.lit(one), F.lit(f"{one[0]}\\{one[1:]}"))
        return out

    def unescape(self, text: Column) -> Column:
        out = text
        for one in reversed(self.controls):
            out = F.replace(out, F.lit(f"{one[0]}\\{one[1:]}"), F.lit(one))
        return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _merged(blocks: Column) -> Column:
    """Adjacent (role, texts) blocks of one role as one block; linear in the blocks."""
    n = F.size(blocks)
    opens = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(blocks, i)["role"] != F.get(blocks, i - 1)["role"]),
    )

    def texts(first: Column, at: Column, k: Column) -> Column:
        here = F.slice(blocks, at + 1, F.coalesce(F.get(first, k + 1), n) - at)
        return F.flatten(here["texts"])

    return bound(
        opens,
        lambda first: F.transform(
            first,
            lambda at, k: F.struct(
                F.get(blocks, at)["role"].alias("role"), texts(first, at, k).alias("texts")
            ),
        ),
    )


def _starts(lengths: Column) -> Column:
    """Sum of the lengths before each position, added up run by run."""
    zero = F.lit(0).cast("bigint")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, x: a + x)

    def before_runs(lengths: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / OFFSET_RUN).cast("int")),
            lambda r: total(F.slice(lengths, r * OFFSET_RUN + 1, F.lit(OFFSET_RUN))),
        )
        return bound(
            runs, lambda sums: F.transform(sums, lambda _, r: total(F.slice(sums, F.lit(1), r)))
        )

    def start(lengths: Column, before: Column, i: Column) -> Column:
        run = F.floor(i / OFFSET_RUN).cast("int")
        return F.get(before, run) + total(
            F.slice(lengths, run * OFFSET_RUN + 1, i - run * OFFSET_RUN)
        )

    return bound(
        lengths,
        lambda values: bound(
            before_runs(values),
            lambda before: F.transform(values, lambda _, i: start(values, before, i)),
        ),
    )


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """(conv_id, n_blocks, formatted, loss_spans) from rows (conv_id, turn, role, text).

    ``loss_spans`` are the (start, length) in UTF-8 bytes of every text of the learned
    role inside ``formatted``.
    """
    empty = F.lit("")
    rows = turns.select(
        "conv_id",
        F.floor(F.col("turn") / RUN_TURNS).alias("run"),
        "turn",
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    runs = (
        rows.groupBy("conv_id", "run")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .select(
            "conv_id",
            "run",
            F.transform(
                "turns",
                lambda t: F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts")),
            ).alias("blocks"),
        )
        .select("conv_id", "run", _merged(F.col("blocks")).alias("blocks"))
    )
    merged = (
        runs.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("run", "blocks"))).alias("runs"))
        .select("conv_id", F.flatten(F.col("runs")["blocks"]).alias("blocks"))
        .select("conv_id", _merged(F.col("blocks")).alias("blocks"))
    )

    def piece(text: Column, learned: Column) -> Column:
        return F.struct(text.alias("text"), learned.alias("learned"))

    def block_pieces(block: Column) -> Column:
        plain = F.lit(False)
        header = F.concat(
            F.lit(template.open), template.escape(block["role"]), F.lit(template.body)
        )
        texts = F.transform(
            block["texts"],
            lambda text, i: F.array(
                piece(F.when(i == 0, header).otherwise(F.lit(template.next)), plain),
                piece(template.escape(text), block["role"] == template.learned_role),
            ),
        )
        return F.concat(F.flatten(texts), F.array(piece(F.lit(template.close), plain)))

    pieces = merged.select(
        "conv_id",
        F.size("blocks").alias("n_blocks"),
        F.flatten(F.transform("blocks", block_pieces)).alias("pieces"),
    )
    lengths = F.transform("pieces", lambda p: F.octet_length(p["text"]).cast("bigint"))
    spans = F.transform(
        F.arrays_zip(
            F.col("pieces")["learned"].alias("learned"),
            _starts(lengths).alias("start"),
            lengths.alias("length"),
        ),
        lambda s: s,
    )
    return pieces.select(
        "conv_id",
        "n_blocks",
        F.array_join(F.col("pieces")["text"], "").alias("formatted"),
        F.transform(
            F.filter(spans, lambda s: s["learned"]),
            lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")),
        ).alias("loss_spans"),
    )


def parse_conversations(
    formatted: DataFrame, template: ChatTemplate = ChatTemplate()
) -> DataFrame:
    """Read ``formatted`` back: adds ``turns``, (role, text) of every turn in order."""

    def literal(text: str) -> str:
        return "\\Q" + text + "\\E"

    def turns(block: Column) -> Column:
        parts = F.split(block, literal(template.body), 2)
        header = F.substr(F.get(parts, F.lit(0)), F.lit(len(template.open) + 1))
        texts = F.split(F.get(parts, F.lit(1)), literal(template.next), -1)
        return bound(
            template.unescape(header),
            lambda role: F.transform(
                texts, lambda t: F.struct(role.alias("role"), template.unescape(t).alias("text"))
            ),
        )

    closed = F.split("formatted", literal(template.close), -1)
    blocks = F.slice(closed, F.lit(1), F.size(closed) - 1)
    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns)))


def learned_text(template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask of a formatted row, unescaped."""

    def text(encoded: Column, span: Column) -> Column:
        part = F.substr(encoded, span["start"].cast("int") + 1, span["length"].cast("int"))
        return template.unescape(F.decode(part, "UTF-8"))

    return bound(
        F.encode("formatted", "UTF-8"),
        lambda encoded: F.array_join(F.transform("loss_spans", lambda s: text(encoded, s)), ""),
    )
