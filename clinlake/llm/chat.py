"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only its reply
is trainable. An example is a prefix of its conversation's formatted text, so the formatted turns are kept
once, with their place in that text, and an example names the length of its context. ``with_context`` writes
contexts out, whose total length grows with the square of a conversation's, for the examples that want it, and
``turns_with_examples`` those of every example beside the turns.

A turn is written ``[INST] role [/INST]text</s>``. A control string inside a role or text gets a backslash
after its first character (``<\\/s>``); where backslashes stand there already it gets one more, so the change
can be undone and no text can end or begin a turn.

Defined results: a null role or text is empty; turns are ordered by turn (null first), then role and text; a
null conv_id is a conversation; a conversation without assistant turns has no example; other columns of the
input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template and the role whose turns are learnt.
TURN_OPEN, TURN_HEAD_END, TURN_END = "[INST] ", " [/INST]", "</s>"
LEARNT_ROLE = "assistant"

_CONTROL = r"([<\[]\\*)(/?(?:s>|INST\]))"
_ESCAPED_CONTROL = r"([<\[]\\*)\\(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED_CONTROL, "$1$2")


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), piece, piece_start, loss_start, loss_end.

    The pieces of a conversation in order are its formatted text; piece_start counts the code points before a
    piece. The loss mask covers [loss_start, loss_end) of that text, null where nothing is learnt.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.select(
        "conv_id",
        F.col("turn").alias("_turn"),
        role.alias("_role"),
        F.concat(F.lit(TURN_OPEN), escape(role), F.lit(TURN_HEAD_END)).alias("_head"),
        escape(text).alias("_body"),
    )
    order = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    pieces = turns.select(
        "conv_id",
        "_role",
        (F.row_number().over(order) - 1).alias("turn_no"),
        F.concat("_head", "_body", F.lit(TURN_END)).alias("piece"),
        F.length("_head").alias("_head_chars"),
        F.length("_body").alias("_body_chars"),
        F.coalesce(F.sum(F.length("_head") + F.length("_body") + len(TURN_END)).over(before), F.lit(0)).alias("piece_start"),
    )
    learnt = F.col("_role") == LEARNT_ROLE
    start = F.col("piece_start") + F.col("_head_chars")
    return pieces.select(
        "conv_id",
        "turn_no",
        "piece",
        "piece_start",
        F.when(learnt, start).alias("loss_start"),
        F.when(learnt, start + F.col("_body_chars")).alias("loss_end"),
    )


def prefix_target_examples(turns: DataFrame) -> DataFrame:
    """One row per learnt turn of ``formatted_turns``: conv_id, turn_no, context_chars, target.

    The example is the first context_chars code points of the conversation's formatted text followed by the
    target, which is the whole of what its loss mask covers.
    """
    return turns.filter("loss_start is not null").select(
        "conv_id",
        "turn_no",
        F.col("loss_start").alias("context_chars"),
        under_mask().alias("target"),
    )


def with_context(examples: DataFrame, turns: DataFrame) -> DataFrame:
    """The examples with their context written out, as column context."""
    joined = examples.alias("e").join(_texts(turns).alias("t"), F.expr("e.conv_id <=> t.conv_id"))
    return joined.select("e.*", _context().alias("context"))


def turns_with_examples(turns: DataFrame) -> DataFrame:
    """The turns, each learnt one with its example: context_chars, target and context, null in the others.

    These are the rows of ``with_context`` over all examples, without its join: a conversation's rows come from its
    one group, so that the exchange of ``formatted_turns`` serves here too.
    """
    each = _texts(turns).select("conv_id", "_text", F.explode("_turns").alias("_turn")).select("conv_id", "_text", "_turn.*")
    examples = each.withColumn("context_chars", F.col("loss_start")).withColumn("target", under_mask()).withColumn("context", _context())
    return examples.drop("_text")


def _texts(turns: DataFrame) -> DataFrame:
    """conv_id, _turns (its formatted turns in order) and _text, their pieces as one text."""
    turn = F.struct("turn_no", "piece", "piece_start", "loss_start", "loss_end")
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    return grouped.withColumn("_text", F.array_join(F.transform("_turns", lambda t: t["piece"]), ""))


def _context() -> Column:
    return F.expr("substring(_text, 1, context_chars)")


def under_mask() -> Column:
    """The part of a formatted turn that its loss mask covers; null where it covers nothing."""
    return F.substring(F.col("piece"), F.col("loss_start") - F.col("piece_start") + 1, F.col("loss_end") - F.col("loss_start"))


def read_turn() -> tuple[Column, Column]:
    """Role and text of a formatted turn, read back from its piece."""
    inner = F.substring(F.col("piece"), F.lit(len(TURN_OPEN) + 1), F.length("piece") - len(TURN_OPEN) - len(TURN_END))
    return unescape(F.substring_index(inner, TURN_HEAD_END, 1)), unescape(
        F.substring(inner, F.locate(TURN_HEAD_END, inner) + len(TURN_HEAD_END), F.length("piece"))
    )
