"""Operator 1, chat formatting: grammar round trip.

Conversations are rendered to one string each, reparsed with a deterministic
parser, and the recovered turns compared with the source.  A turn whose raw
rendering does not come back identical is escaped.

Grammar (control strings are the quoted parts)::

    conversation := turn*
    turn         := "[INST]" text "[/INST]"                          (user)
                  | text "</s>"                                      (assistant)
                  | "[INST]" "[ROLE]" role "[/ROLE]" text "[/INST]"  (any other role)

Escape: one backslash is put after the first character of each control string,
and of each control string that already carries backslashes there; the parser
takes one away.  After it no control string is left in a text, none can form
across a border (each starts with ``<`` or ``[`` and holds neither again), and
taking one backslash away from each gives the text back, so one escape is
always enough.

Only DataFrame functions are used.  A conversation is one output string, so
the turns of one conversation meet in one row; its length is bounded by the
string limit of Spark, not by the number of conversations.

Defined cases: null text and null role are empty strings; turns are ordered by
(turn, role, text) with null turns first, so ties and repeated rows keep a
fixed order; rows with null conv_id form one conversation; no rows, no output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
INST, END_INST, ROLE, END_ROLE, EOS = "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "</s>"
CONTROL_TAIL = r"(/?(?:s>|INST\]|ROLE\]))"
TURN_PATTERN = r"(?s)\[INST\].*?\[/INST\]|.*?</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL_TAIL}", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL_TAIL}", "$1$2$3")


def render(role: Column, text: Column) -> Column:
    """The rendering of one turn, contents taken as they are."""
    return (
        F.when(role == "user", F.concat(F.lit(INST), text, F.lit(END_INST)))
        .when(role == "assistant", F.concat(text, F.lit(EOS)))
        .otherwise(F.concat(F.lit(INST + ROLE), role, F.lit(END_ROLE), text, F.lit(END_INST)))
    )


def _turn(segment: Column) -> Column:
    """(role, text, loss_text) of one segment cut by TURN_PATTERN."""
    body = F.substring(segment, F.lit(len(INST) + 1), F.length(segment) - len(INST + END_INST))
    has_role = body.startswith(ROLE) & body.contains(END_ROLE)
    role = F.substring_index(F.substring(body, F.lit(len(ROLE) + 1), F.length(body)), END_ROLE, 1)
    skip = F.length(role) + len(ROLE + END_ROLE)
    rest = F.substring(body, skip + 1, F.length(body) - skip)
    said = F.substring(segment, F.lit(1), F.length(segment) - len(EOS))
    told = segment.startswith(INST)
    return F.struct(
        F.when(~told, F.lit("assistant")).when(has_role, unescape(role)).otherwise(F.lit("user")).alias("role"),
        unescape(F.when(~told, said).when(has_role, rest).otherwise(body)).alias("text"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted string, or null if it is not of the grammar."""
    segments = F.regexp_extract_all(formatted, F.lit(TURN_PATTERN), F.lit(0))
    return F.when(F.concat_ws("", segments) == formatted, F.transform(segments, _turn))


def loss_mask(formatted: Column) -> Column:
    """Runs (chars, loss) that cover the formatted string: loss is true on assistant texts."""
    segments = F.regexp_extract_all(formatted, F.lit(TURN_PATTERN), F.lit(0))

    def runs(s: Column) -> Column:
        told = s.startswith(INST)
        return F.array(
            F.struct(F.when(told, F.length(s)).otherwise(F.length(s) - len(EOS)).alias("chars"), (~told).alias("loss")),
            F.struct(F.when(told, 0).otherwise(len(EOS)).alias("chars"), F.lit(False).alias("loss")),
        )

    return F.filter(F.flatten(F.transform(segments, runs)), lambda r: r["chars"] > 0)


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_mask, n_escaped, identical), one row per conversation.

    ``identical`` compares the turns reparsed from the whole string with the
    source; the escape above makes it true for every input.
    """
    source = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    raw = render(F.col("role"), F.col("text"))
    same = parse(raw).eqNullSafe(F.array(F.struct("role", "text")))
    known = F.col("role").isin("user", "assistant")
    escaped = render(F.when(known, F.col("role")).otherwise(escape(F.col("role"))), escape(F.col("text")))
    pieces = source.withColumn("same", same).select(
        "conv_id",
        F.struct("turn", "role", "text", F.when(F.col("same"), raw).otherwise(escaped).alias("piece"),
                 (~F.col("same")).cast("long").alias("escaped")).alias("t"),
    )
    rows = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    out = rows.select(
        "conv_id",
        F.concat_ws("", F.transform("t", lambda x: x["piece"])).alias("formatted"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"),
        F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["escaped"]).alias("n_escaped"),
    )
    return out.select(
        "conv_id", "formatted", loss_mask(F.col("formatted")).alias("loss_mask"), "n_escaped",
        parse(F.col("formatted")).eqNullSafe(F.col("source")).alias("identical"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>, loss_text) read from the formatted strings alone."""
    parsed = formatted.withColumn("turns", parse(F.col("formatted")))
    said = F.filter("turns", lambda t: t["role"] == "assistant")
    return parsed.withColumn("loss_text", F.concat_ws("", F.transform(said, lambda t: t["text"])))


def digest(formatted: DataFrame) -> DataFrame:
    """The digest columns of the query, from the formatted strings alone."""
    back = read_back(formatted)
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_escaped", "identical",
    )
