"""Chat formatting from event logs, with DataFrame functions only.

A log has events of messages: ``message`` sets a text, ``delta`` appends to it, ``edit`` replaces it,
``regenerate`` empties it so that later deltas build it anew, ``delete`` removes the message. Events are folded
by (conversation, message), so that a conversation with very many events is dealt over many tasks; a
message's text is its last text-setting event followed by the later deltas in order of sequence. Messages are
then rendered one by one, and only rendered turns meet in their conversation.

The template writes ``### Role:``, a line feed, the text, ``</turn>`` and a line feed for each turn. Inside texts and
roles ``\\`` and ``#`` have a backslash before them and ``<`` becomes a backslash and an l, so neither control string can occur in
them; a role's line feed becomes a backslash and an n. Reading is exact, since a backslash always begins a pair.

A message, and a formatted conversation, is one value of a row, as the format asks: both must fit in a row (2 GB), and the task
that makes a row holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
SETS, KINDS = ("message", "edit", "regenerate", "delete"), ("message", "delta", "edit", "regenerate", "delete")


def escape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, r"([\\#])", r"\\$1"), F.lit("<"), F.lit("\\l"))


def _read_pair(text: Column, letter: str, meaning: str) -> Column:
    """A letter after an odd number of backslashes, with the last of them, becomes what it means."""
    return F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*)\\{letter}", f"$1{meaning}")


def unescape(text: Column) -> Column:
    return F.regexp_replace(_read_pair(text, "l", "<"), r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", r"\\n")


def unescape_role(role: Column) -> Column:
    return unescape(_read_pair(role, "n", "\n"))


def streamed_events(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A table of finished turns as the event log that a streaming client would have left, all kinds of events included.

    Turns go by turn number modulo 4: streamed in three deltas with one of them delivered twice; a draft that is edited into the
    text; a draft with a delta, regenerated and streamed anew; a message as it is. Each fold gives the turn's text back.
    """
    base = events_of_turns(turns, conv_col, turn_col, role_col, text_col)
    t, third = F.col("text"), F.ceil(F.length("text") / 3).cast("int")
    ev = lambda step, kind, text: F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("text"))
    piece = lambda i: F.substr(t, F.lit(1) + third * i, third)
    streamed = lambda first: [ev(first + i, "delta", piece(i)) for i in range(3)]
    kinds = [
        [ev(0, "message", F.lit("")), *streamed(1), ev(2, "delta", piece(1))],
        [ev(0, "message", F.lit("draft \\ ### <")), ev(1, "edit", t)],
        [ev(0, "message", F.lit("draft")), ev(1, "delta", F.lit(" more")), ev(2, "regenerate", F.lit(None).cast("string")), *streamed(3)],
        [ev(0, "message", t)],
    ]
    way = F.coalesce(F.pmod("seq.turn", F.lit(4)), F.lit(3))
    events = F.when(way == 0, F.array(*kinds[0])).when(way == 1, F.array(*kinds[1])).when(way == 2, F.array(*kinds[2])).otherwise(F.array(*kinds[3]))
    rows = base.select("conv", "message", "seq", "role", F.explode(events).alias("e"))
    return rows.select("conv", "message", F.struct("seq.unnumbered", "seq.turn", F.col("e.step").alias("step")).alias("seq"), F.col("e.kind").alias("kind"), F.when(F.col("e.step") == 0, F.col("role")).alias("role"), F.col("e.text").alias("text"))


def events_of_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A table of finished turns as an event log: one ``message`` event a row.

    Rows that repeat a turn stay turns of their own, ordered by role and text: the message key holds a number in the order. Rows
    without a turn come after all others, in that order too. A sequence is (unnumbered, turn, step).
    """
    from pyspark.sql import Window

    order = Window.partitionBy(conv_col, turn_col).orderBy(F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    turn = F.col(turn_col).cast("long")
    return turns.select(
        F.col(conv_col).cast("long").alias("conv"), F.struct(turn.isNull().alias("unnumbered"), turn.alias("turn"), F.row_number().over(order).alias("copy")).alias("message"),
        F.struct(turn.isNull().alias("unnumbered"), turn.alias("turn"), F.lit(0).alias("step")).alias("seq"), F.lit("message").alias("kind"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv, message, role, text) of each message that stands after all its events.

    events: conv, message and seq (any orderable types), kind, role, text. Null texts are empty; unknown kinds and
    null sequences are ignored; equal sequences follow by kind and text; an event delivered again counts once. A message without a text-setting event is built of its deltas. The role is the
    least one given by its events, null without any.
    """
    rows = events.where(F.col("kind").isin(*KINDS)).where("seq is not null").select("conv", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    setting = F.when(F.col("kind").isin(*SETS), F.struct("seq", "kind", "text"))
    deltas = F.when(F.col("kind") == "delta", F.struct("seq", "text"))
    grouped = rows.groupBy("conv", "message").agg(F.max(setting).alias("last"), F.collect_set(deltas).alias("deltas"), F.min("role").alias("role"))
    later = F.filter(F.array_sort("deltas"), lambda d: F.col("last").isNull() | (d["seq"] > F.col("last.seq")))
    start = F.when(F.col("last.kind").isin("message", "edit"), F.col("last.text")).otherwise(F.lit(""))
    text = F.concat(start, F.array_join(F.transform(later, lambda d: d["text"]), ""))
    gone = (F.col("last.kind") == "delete") & (F.size(later) == 0)
    return grouped.where(~F.coalesce(gone, F.lit(False))).select("conv", "message", "role", text.alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, segments) of each conversation; segments (text, loss) concatenate to formatted, and loss
    marks exactly the escaped texts of loss_roles. A null role is written as an empty one."""
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit("### "), escape_role(role), F.lit(":\n"))
    parts = F.struct("message", head.alias("head"), escape(F.col("text")).alias("body"), role.isin(*loss_roles).alias("loss"))
    turns = messages.select("conv", parts.alias("t")).groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(t["head"].alias("text"), F.lit(False).alias("loss")), F.struct(t["body"].alias("text"), t["loss"].alias("loss")), F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))))
    made = turns.select(F.col("conv").alias("conv_id"), segments.alias("segments"))
    return made.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    # a block is "### role:\ntext" and the role has no raw line feed
    def one(b: Column) -> Column:
        cut = F.instr(b, "\n")
        role = F.substr(b, F.lit(5), cut - F.lit(6))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(b, cut + F.lit(1))).alias("text"))

    return F.transform(blocks, one)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))


def format_chats(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Event log to (conv_id, formatted, segments): fold, then render. An empty log gives no rows; a null conversation is one of its own."""
    return render(fold(events), loss_roles)
