"""Chat formatting: event-sourced reconstruction of conversations.

A conversation is a log of events; messages are what folding the log leaves:

* ``message`` sets a message's role and text;
* ``delta`` appends text to it, in sequence order;
* ``edit`` replaces its text;
* ``regenerate`` empties it and drops all later messages, as they stood then.

The template puts each message between markers.  In texts and roles the
characters that markers need are escaped, so that no text can close or open a
turn and the output can be read back exactly.  Only DataFrame functions run.

Defined results: null texts and roles are empty; events without a conversation
fold under a null conversation; equal sequence numbers are ordered by target,
operation, role and text; a delta or edit of a message that was never set
makes one without role; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the template.
TURN_OPEN = "<turn role="
TURN_NAMED = ">"
TURN_CLOSE = "</turn>\n"
LOSS_ROLE = "assistant"

TURN_PATTERN = "<turn role=([^<>]*)>([^<]*)</turn>\n"


def escape(text: Column) -> Column:
    """Free of ``<`` and ``>``: backslash, ``<`` and ``>`` become pairs that
    start with a backslash."""
    pairs = ((F.lit("\\"), F.lit("\\\\")), (F.lit("<"), F.lit("\\l")), (F.lit(">"), F.lit("\\g")))
    for plain, coded in pairs:
        text = F.replace(text, plain, coded)
    return text


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text starts a pair: split at the pairs
    that stand for a backslash, then the others are unambiguous."""
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(plain, "\\")


def as_events(conversations: DataFrame) -> DataFrame:
    """The log of plain turns: one ``message`` a row, ordered by turn (equal
    turns by role and text)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.withColumn("seq", F.row_number().over(w).cast("long")).select(
        "conv_id", "seq", F.col("seq").alias("target"), F.lit("message").alias("op"), "role", "text"
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, target, role, text.

    Grouping is by message: a conversation's events never meet in one cell.
    """
    e = events.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), F.col("target").cast("long").alias("target"), "op",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # the last regeneration that reaches a message: its own, or of an earlier one
    resets = (
        e.groupBy("conv_id", "target").agg(F.max(F.when(F.col("op") == "regenerate", F.col("seq"))).alias("own"))
        .withColumn("earlier", F.max("own").over(Window.partitionBy("conv_id").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)))
    )
    named = F.col("role") != ""
    live = e.join(resets, (e["conv_id"].eqNullSafe(resets["conv_id"])) & (e["target"].eqNullSafe(resets["target"]))).select(
        e["*"], F.greatest("own", "earlier").alias("reset"), "own", "earlier"
    )
    live = live.where("earlier is null or seq > earlier or (op = 'regenerate' and seq = own and own > earlier)")
    order = F.struct("seq", "op", "role", "text")
    sets = F.col("op").isin("message", "edit") & (F.col("own").isNull() | (F.col("seq") > F.col("own")))
    messages = live.groupBy("conv_id", "target").agg(
        F.max(F.when(sets, F.struct("seq", "op", "text"))).alias("base"),
        F.max_by("role", F.when(named, order)).alias("role"),
        F.max("own").alias("own"),
        F.array_sort(F.collect_list(F.when(F.col("op") == "delta", F.struct("seq", "text")))).alias("deltas"),
    )
    since = F.greatest(F.coalesce("base.seq", F.lit(None).cast("long")), F.col("own"))
    late = F.filter("deltas", lambda d: since.isNull() | (d["seq"] > since))
    return messages.select(
        "conv_id", "target", F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.coalesce("base.text", F.lit("")), F.array_join(F.transform(late, lambda d: d["text"]), "")).alias("text"),
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, formatted text, and loss spans (start and length in code
    points) that cover the escaped texts of the loss role."""
    escaped = messages.select("conv_id", "target", F.col("role") == loss_role, escape(F.col("role")), escape(F.col("text"))).toDF(
        "conv_id", "target", "loss", "role", "text"
    )
    turn = F.concat(F.lit(TURN_OPEN), "role", F.lit(TURN_NAMED), "text", F.lit(TURN_CLOSE))
    parts = escaped.select(
        "conv_id", "target", turn.alias("turn"), F.length(turn).cast("long").alias("size"),
        (F.length("role") + len(TURN_OPEN) + len(TURN_NAMED)).cast("long").alias("lead"),
        F.length("text").cast("long").alias("length"), "loss",
    )
    w = Window.partitionBy("conv_id").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("at", F.coalesce(F.sum("size").over(w), F.lit(0)))
    span = F.when(F.col("loss"), F.struct((F.col("at") + F.col("lead")).alias("start"), "length"))
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("target", "turn"))).alias("turns"), F.array_sort(F.collect_list(span)).alias("loss_spans")
    )
    return whole.select("conv_id", F.array_join(F.col("turns.turn"), "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and the text under the loss mask, as the output alone tells them:
    conv_id, roles, texts, loss_text."""
    roles = F.transform(F.regexp_extract_all("formatted", F.lit(TURN_PATTERN), F.lit(1)), unescape)
    texts = F.transform(F.regexp_extract_all("formatted", F.lit(TURN_PATTERN), F.lit(2)), unescape)
    under = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", roles.alias("roles"), texts.alias("texts"), F.array_join(under, "").alias("loss_text"))
