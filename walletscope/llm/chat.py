"""Chat formatting with Spark expressions only.

A conversation becomes one string. Turns are sorted by (turn, role, text), adjacent
turns of one role share a block, and the block keeps their boundary, so nothing is
lost. Control strings inside a text get one more backslash after their first
character; reading back takes it away, which is exact for any text because no
control string contains the first character of another one.

Defined results
- NULL text or role: empty string. NULL turn: sorts first. NULL conv_id: one conversation.
- Ties on turn: ordered by role, then text; repeated rows stay, as turns of their own.
- Empty table: no conversation. Extra columns are ignored.

A conversation is one row of the result, so its turns meet in one task by definition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """A block is start role sep text [next text ...] end."""

    start: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    next: str = "<|im_next|>"
    end: str = "<|im_end|>"

    #: Control strings of common templates, escaped as well (head, rest as a pattern).
    #: All begin with < or [ and hold neither of them again.
    pattern: str = r"([<\[])(\\*)(\|im_(?:start|sep|next|end)\|>|/?s>|/?INST\]|\|endoftext\|>)"

    def __post_init__(self) -> None:
        if any(m[0] not in "<[" or "<" in m[1:] or "[" in m[1:] for m in (self.start, self.sep, self.next, self.end)):
            raise ValueError("a mark begins with < or [ and holds neither again")


DEFAULT = Template()


def escape(text: Column, t: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, t.pattern, r"$1\\$2$3")


def unescape(text: Column, t: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, t.pattern.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def _split(text: Column, mark: str) -> Column:
    return F.split(text, r"\Q" + mark + r"\E", -1)


def format_chat(turns: DataFrame, loss_role: str = "assistant", template: Template = DEFAULT) -> DataFrame:
    """conv_id, formatted string, loss array<struct<start, length>> in code points.

    ``loss`` covers the texts of ``loss_role`` and nothing between them.
    """
    t = template
    blank = F.lit("")
    sorted_turns = F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce(F.col("role"), blank).alias("role"), F.coalesce(F.col("text"), blank).alias("text"))))
    convs = turns.groupBy("conv_id").agg(sorted_turns.alias("turns"))

    def role_at(i: Column) -> Column:
        return F.get(F.col("turns"), i)["role"]

    # a block begins where the role changes
    last = F.size("turns") - 1
    begins = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    convs = convs.withColumn("begins", begins)
    blocks = F.transform("begins", lambda b, k: F.slice(
        F.col("turns"), b + 1, F.coalesce(F.get(F.col("begins"), k + 1), last + 1) - b))
    convs = convs.select("conv_id", blocks.alias("blocks"))

    # segments of the formatted string: (text, loss)
    def segment(text: Column, loss: Column | bool = False) -> Column:
        return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))

    def block_segments(block: Column) -> Column:
        texts = F.flatten(F.transform(block, lambda x, i: F.array(
            segment(F.when(i == 0, F.lit("")).otherwise(F.lit(t.next))),
            segment(escape(x["text"], t), x["role"] == loss_role))))
        head = F.concat(F.lit(t.start), escape(F.get(block, 0)["role"], t), F.lit(t.sep))
        return F.concat(F.array(segment(head)), texts, F.array(segment(F.lit(t.end))))

    segments = F.flatten(F.transform("blocks", block_segments))
    convs = convs.select("conv_id", segments.alias("segments"))
    spans_type = "array<struct<start:bigint,length:bigint>>"
    loss = F.aggregate(
        "segments", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(spans_type).alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + F.char_length(s["text"])).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct(
                acc["at"].alias("start"), F.char_length(s["text"]).cast("bigint").alias("length")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return convs.select("conv_id", text.alias("formatted"), loss.alias("loss"))


def read_chat(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, turns array<struct<role, text>> and the loss text, from the output alone."""
    t = template
    blocks = F.slice(_split(F.col("formatted"), t.start), 2, F.length("formatted") + 1)

    def turns(block: Column) -> Column:
        role, body = F.get(_split(block, t.sep), 0), F.get(_split(block, t.sep), 1)
        texts = _split(F.substring_index(body, t.end, 1), t.next)
        return F.transform(texts, lambda x: F.struct(unescape(role, t).alias("role"), unescape(x, t).alias("text")))

    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")), t)), "")
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"),
                            loss.alias("loss_text"))
