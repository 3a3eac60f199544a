"""Chat formatting: conversations of typed parts as one text with a loss mask.

A visitor goes over the parts of a turn in order.  Text is escaped, everything
else becomes a placeholder, and its reference, place and expanded token count are
recorded.  Control strings begin with ``<|``; in texts that becomes ``<\\|`` and a
backslash is doubled, so no text can end a turn and every text can be read back; a
text that begins with ``|`` after one that ends with ``<`` is parted from it alike.
Only built-in expressions and one shuffle by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.expressions import let

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"
# expanded tokens per unit: an image tile, a second of audio, a document page
TOKENS_PER_UNIT = {"image": 256.0, "audio": 25.0, "document": 512.0}
LEARNED_ROLE = "assistant"
PARTS = "array<struct<kind:string,text:string,ref:string,units:double>>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """The parts of a turn that is only text."""
    nothing = F.lit(None)
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), nothing.alias("ref"), nothing.alias("units"))
    return F.array(part).cast(PARTS)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def _visit(part: Column, last: Column) -> Column:
    """What stands for a part after text that ends with ``last``; an unknown kind is a document.

    Two texts side by side must not make a control string that neither of them has.
    """
    known = F.when(part["kind"].isin(*TOKENS_PER_UNIT), part["kind"]).otherwise("document")
    text = F.coalesce(part["text"], F.lit(""))
    parted = F.when((last == "<") & text.startswith("|"), "\\").otherwise("")
    return F.when(_is_text(part), F.concat(parted, escape(text))).otherwise(
        F.concat(F.lit("<|"), known, F.lit("|>"))
    )


def _last(part: Column, last: Column) -> Column:
    """The last character of the text so far; an attachment ends a text."""
    text = F.coalesce(part["text"], F.lit(""))
    return F.when(~_is_text(part), "").when(text == "", last).otherwise(F.right(text, F.lit(1)))


def _tokens(part: Column) -> Column:
    rate = F.lit(TOKENS_PER_UNIT["document"])
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(part["kind"] == kind, F.lit(tokens)).otherwise(rate)
    return F.ceil(F.coalesce(part["units"], F.lit(1.0)) * rate).cast("long")


def _turn(role: Column, parts: Column) -> Column:
    """One turn: its text, the spans of text parts and the attachments in it."""
    head = F.concat(F.lit(TURN), escape(role), F.lit(SAYS))

    def visit(state: Column, part: Column) -> Column:
        return let(
            _visit(part, state["last"]),
            lambda piece: F.struct(
                F.array_append(state["pieces"], piece).alias("pieces"),
                F.array_append(state["starts"], state["at"]).alias("starts"),
                (state["at"] + F.char_length(piece)).alias("at"),
                _last(part, state["last"]).alias("last"),
            ),
        )

    def laid_out(state: Column) -> Column:
        spans = F.transform(
            parts,
            lambda part, i: F.struct(
                F.get(state["starts"], i).alias("start"),
                F.char_length(F.get(state["pieces"], i)).cast("long").alias("length"),
                _is_text(part).alias("is_text"),
                part["kind"].alias("kind"),
                part["ref"].alias("ref"),
                _tokens(part).alias("tokens"),
            ),
        )
        text = F.concat(head, F.array_join(state["pieces"], ""), F.lit(END))
        return F.struct(text.alias("text"), spans.alias("spans"))

    begin = F.struct(
        F.array().cast("array<string>").alias("pieces"),
        F.array().cast("array<bigint>").alias("starts"),
        F.char_length(head).cast("long").alias("at"),
        F.lit("").alias("last"),
    )
    return let(F.aggregate(parts, begin, visit), laid_out)


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """One row per conversation.

    ``formatted``; ``n_turns``; ``turn_starts`` (where each turn begins);
    ``loss_spans`` (turn, start, length: the assistant's texts, in code points of
    ``formatted``); ``attachments`` (turn, start, kind, ref, tokens, in order) and
    ``attachment_tokens``, their sum.  ``parts`` is an array of kind, text, ref and
    units.  Turns stand in order of ``turn``, ties in order of role and text, null
    first; repeated rows are repeated turns.  Null roles, texts and parts are
    empty; a null kind is text; null units are one.  Rows without a conversation
    id are one conversation without an id.  Empty tables give empty ones; other
    columns are not read.  A conversation is one row, so its turns meet in a task.
    """
    speaker = F.coalesce(F.col(role), F.lit(""))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("_turn"),
        speaker.alias("_role"),
        _turn(speaker, F.coalesce(F.col(parts), F.array().cast(PARTS))).alias("_made"),
    )
    order = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_made.text")
    ahead = F.sum(F.char_length("_made.text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.select(
        "conv_id",
        F.struct(
            (F.row_number().over(order) - 1).alias("turn"),
            F.coalesce(ahead, F.lit(0)).cast("long").alias("start"),
            F.col("_made.text").alias("text"),
            (F.col("_role") == LEARNED_ROLE).alias("learned"),
            F.col("_made.spans").alias("spans"),
        ).alias("_turn"),
    )
    chats = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))

    def spans(chosen, build) -> Column:
        return F.flatten(
            F.transform(
                "_turns", lambda t: F.transform(F.filter(t["spans"], lambda s: chosen(t, s)), lambda s: build(t, s))
            )
        )

    learned = spans(
        lambda t, s: t["learned"] & s["is_text"],
        lambda t, s: F.struct(
            t["turn"].alias("turn"), (t["start"] + s["start"]).alias("start"), s["length"].alias("length")
        ),
    )
    attached = spans(
        lambda t, s: ~s["is_text"],
        lambda t, s: F.struct(
            t["turn"].alias("turn"),
            (t["start"] + s["start"]).alias("start"),
            s["kind"].alias("kind"),
            s["ref"].alias("ref"),
            s["tokens"].alias("tokens"),
        ),
    )
    return chats.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: t["text"]), "").alias("formatted"),
        F.transform("_turns", lambda t: t["start"]).alias("turn_starts"),
        learned.alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def _quoted(literal: str) -> str:
    return literal.replace("|", r"\|")


def read_back(formatted: Column, loss_spans: Column, turn_starts: Column) -> Column:
    """Turns (role, text) and the texts under the loss mask, out of the formatted text."""

    def turn(segment: Column) -> Column:
        halves = F.split(segment, _quoted(SAYS), 2)
        return let(
            halves,
            lambda h: F.struct(
                unescape(F.substring(h[0], len(TURN) + 1, 1 << 30)).alias("role"), unescape(h[1]).alias("text")
            ),
        )

    def read(segments: Column) -> Column:
        def learned(span: Column) -> Column:
            segment = segments[span["turn"]]
            begin = span["start"] - turn_starts[span["turn"]] + 1
            return unescape(F.substring(segment, begin.cast("int"), span["length"].cast("int")))

        whole = F.slice(segments, 1, F.size(segments) - 1)
        return F.struct(
            F.transform(whole, turn).alias("turns"), F.transform(loss_spans, learned).alias("learned")
        )

    return let(F.split(formatted, _quoted(END)), read)
