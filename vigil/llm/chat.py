"""Chat formatting from an event log, with DataFrame functions only.

Events of a conversation, ordered by ``seq``, are folded into final messages:

* ``message``     opens a message (``message_id``) with a role and a whole text,
* ``delta``       appends to its message, which it opens if need be,
* ``edit``        replaces the message's text and drops all later messages,
* ``regenerate``  empties the message for new deltas and drops all later ones.

The fold is declarative: a message's text is that of its last edit or
regeneration (or its opening) followed by the deltas after it, and a message is
dropped when a later edit or regeneration hits a message opened before it.
Both are windows over one shuffle by conversation, so that a stream of many
deltas costs a sort, not a rebuilt string for each event.

Template: ``<|turn|>role\\ntext<|end|>\\n`` for each turn.  ``&``, ``<`` and ``[``
inside texts (and line ends inside roles) become character references, so no
control string of this or of other templates can occur inside a text; ``parse``
reads turns and texts back.  The loss mask is a list of code point spans over
the formatted text: each assistant text once, in order.

A conversation becomes one row and is therefore the unit of a task, as its
output is one string; a common first turn or many conversations skew nothing.

Defined results: null text is empty, null role is an empty role, null sequence
numbers sort first; equal sequence numbers are ordered by message id, role and
text, and repeated ``message`` rows are separate turns when their message ids
differ (see ``events_of_turns``); a null conversation id is a conversation; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
#: Replaced in this order when escaping, in reverse order when reading back.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))


def escape(c, pairs=ESCAPES):
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape(c, pairs=ESCAPES):
    for a, b in reversed(pairs):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """Stored turns as an event log: each row opens one message."""
    w = Window.partitionBy("conv_id").orderBy(F.col("seq").asc_nulls_first(), "role", "text")
    return (conversations.selectExpr("conv_id", "turn seq", "coalesce(role, '') role", "coalesce(text, '') text")
            .select("conv_id", "seq", F.lit("message").alias("event"),
                    F.row_number().over(w).cast("long").alias("message_id"), "role", "text"))


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, position, role, text."""
    e = events.selectExpr("conv_id", "seq", "event", "message_id", "coalesce(role, '') role", "coalesce(text, '') text")
    order = [F.col("seq").asc_nulls_first(), "message_id", "role", "text"]
    conv = Window.partitionBy("conv_id").orderBy(*order)
    e = e.withColumn("at", F.row_number().over(conv))
    msg = Window.partitionBy("conv_id", "message_id")
    resets = F.col("event").isin("message", "edit", "regenerate")
    e = (e.withColumn("opened", F.min("at").over(msg))
         .withColumn("reset", F.max(F.when(resets, F.col("at"))).over(msg))
         .withColumn("cut", F.when(F.col("event").isin("edit", "regenerate"), F.col("opened"))))
    # from the last event on, so that each row adds one value to what lies behind it
    later = Window.partitionBy("conv_id").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("cut_later", F.min("cut").over(later))
    live = e.where((F.col("at") == F.col("opened")) | (F.col("at") >= F.coalesce("reset", F.lit(0))))
    part = F.when((F.col("at") >= F.coalesce("reset", F.lit(0))) & (F.col("event") != "regenerate"), F.col("text"))
    return (live.groupBy("conv_id", "message_id")
            .agg(F.min("opened").alias("position"),
                 F.min_by("role", F.when(F.col("role") != "", F.col("at"))).alias("role"),
                 F.min_by("cut_later", "at").alias("cut_later"),
                 F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct("at", part.alias("text"))))).alias("parts"))
            .where("cut_later is null or cut_later >= position")
            .select("conv_id", "position", F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.col("parts.text"), "").alias("text")))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans of each conversation: start and length in code points, and in bytes of UTF-8.

    The places of the spans are running sums over the turns, and spans are read back by their bytes: text functions
    look for a code point from the start of a text, which would take a whole conversation's length for each turn.
    """
    one = F.concat(F.lit(TURN), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"), escape(F.col("text")), F.lit(END))
    role, text = escape(F.col("role"), ROLE_ESCAPES), escape(F.col("text"))
    m = messages.select("conv_id", "position", one.alias("s"), (F.col("role") == loss_role).alias("loss"), *[
        c.cast("long").alias(f"{name}_{unit}") for unit, size in (("c", F.length), ("b", F.octet_length)) for name, c in (
            ("lead", size(role) + len(TURN) + 1), ("size", size(text)))])
    before = Window.partitionBy("conv_id").orderBy("position", "s").rowsBetween(Window.unboundedPreceding, -1)
    start = lambda u: (F.coalesce(F.sum(F.col(f"lead_{u}") + F.col(f"size_{u}") + len(END)).over(before), F.lit(0))
                       + F.col(f"lead_{u}"))
    m = m.withColumn("start_c", start("c")).withColumn("start_b", start("b"))
    span = F.struct(*[F.col(c).cast("int").alias(name) for c, name in (
        ("start_c", "start"), ("size_c", "length"), ("start_b", "byte_start"), ("size_b", "byte_length"))])
    g = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("position", "s"))).alias("ms"),
                                 F.array_sort(F.collect_list(F.when(F.col("loss"), span))).alias("loss_spans"))
    return g.select("conv_id", F.array_join(F.col("ms.s"), "").alias("formatted"), "loss_spans")


def parse(formatted):
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>", -1), F.lit(2), F.greatest(
        F.size(F.split(formatted, r"<\|turn\|>", -1)) - 1, F.lit(0)))
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1,
                          F.length(p) - F.instr(p, F.lit("\n")) - F.lit(len(END)))).alias("text")))


def loss_text(formatted, spans):
    """Unescaped text under the loss mask."""
    whole = F.array(F.encode(formatted, "UTF-8"))  # bound once for all spans
    read = F.transform(whole, lambda b: F.array_join(F.transform(spans, lambda s: unescape(
        F.decode(F.substr(b, s["byte_start"] + 1, s["byte_length"]), "UTF-8"))), ""))
    return F.element_at(read, 1)


def digest(formatted: DataFrame) -> DataFrame:
    """Figures read back from the formatted text."""
    d = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))
