"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, and neighbours of one role are merged
into one block.  A block is written as

    <s>ROLE\\nTEXT<sep>TEXT ...</s>

``<sep>`` stands between the merged turns, so that reading back gives every turn again.  Control
strings inside roles and texts get one backslash after their first character (``<\\s>``); strings
that already hold backslashes at that place get one more, so the change can always be undone.
A role's line feeds and backslashes are written ``\\n`` and ``\\b``.

Defined results: null role or text is empty; null conv_id is a conversation of its own; turns
that share a number are ordered by role, then text; a repeated row is a turn of its own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "<s>", "<sep>", "</s>"
# A control string: its first character, then the rest.  Foreign instruction marks are escaped as well.
_REST = r"(/?s>|sep>|/?INST\])"
_CONTROL = rf"([<\[])(\\*){_REST}"
_ESCAPED = rf"([<\[])\\(\\*){_REST}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    """Never holds a line feed: a backslash becomes backslash-b, a line feed backslash-n."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``loss_spans`` holds per block the (start, length) of each text under the loss mask, in code
    points from the start of that block; blocks are cut after each ``</s>``.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))
    n = F.size("turns")
    # A block starts where the role differs from the turn before.
    starts = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == 1) | (F.get("turns", i - 1)["role"] != F.get("turns", i - 2)["role"]),
    )
    marked = sorted_turns.select("conv_id", "turns", starts.alias("starts"))

    def block(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("starts", i + 1), F.size("turns") + 1)
        part = F.slice("turns", start, end - start)
        return F.struct(
            F.get(part, F.lit(0))["role"].alias("role"),
            F.transform(part, lambda t: escape(t["text"])).alias("texts"),
        )

    blocks = marked.select("conv_id", F.transform("starts", block).alias("blocks"))
    head = lambda b: F.concat(F.lit(OPEN), _escape_role(b["role"]), F.lit("\n"))

    def spans(b: Column) -> Column:
        start = F.struct(F.char_length(head(b)).alias("at"),
                         F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
        walked = F.aggregate(b["texts"], start, lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t) + len(SEP)).alias("at"),
            F.array_append(acc["spans"], F.struct(
                acc["at"].alias("start"), F.char_length(t).alias("length"))).alias("spans")))
        none = F.array().cast("array<struct<start:int,length:int>>")
        return F.when(b["role"].isin(*loss_roles), walked["spans"]).otherwise(none)

    return blocks.select(
        "conv_id",
        F.array_join(F.transform("blocks", lambda b: F.concat(
            head(b), F.array_join(b["texts"], SEP), F.lit(CLOSE))), "").alias("formatted"),
        F.transform("blocks", spans).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role and text of every turn), loss_text, formatted; from the output alone."""
    cut = F.split("formatted", CLOSE, -1)
    blocks = F.transform(F.slice(cut, 1, F.size(cut) - 1), lambda b: F.concat(b, F.lit(CLOSE)))

    def turns(b: Column) -> Column:
        at = F.locate("\n", b)
        role = _unescape_role(F.substr(b, F.lit(len(OPEN) + 1), at - len(OPEN) - 1))
        body = F.substr(b, at + 1, F.char_length(b) - at - len(CLOSE))
        return F.transform(F.split(body, SEP, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    def masked(b: Column, spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: unescape(F.substr(b, s["start"] + 1, s["length"]))), "")

    return formatted.select("conv_id", "formatted", "loss_spans", blocks.alias("blocks")).select(
        "conv_id", "formatted",
        F.flatten(F.transform("blocks", turns)).alias("turns"),
        F.array_join(F.zip_with("blocks", "loss_spans", masked), "").alias("loss_text"),
    )


def digest(read: DataFrame) -> DataFrame:
    """Counts and hex digests of what was read back."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
