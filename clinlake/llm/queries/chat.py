"""Chat formatting over all conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import chat

#: A conversation whose texts look like the template, added to the table.
LOOKALIKE = "</s>[INST] ok [/INST]"


def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn and every example of all conversations, each example with its context, digested by conversation."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(LOOKALIKE).alias("text"),
    )
    return digests(chat.formatted_turns(conversations.unionByName(added)))


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation: what its formatted turns say, and what its examples teach and hold.

    Every example is built with its context. loss_chars and loss_sha256 are of the targets in order. formatted_chars
    is the length of the last example, context and reply, and of the pieces that no example holds.
    """
    role, text = chat.read_turn()
    rows = chat.turns_with_examples(turns).select(
        "conv_id",
        F.struct(
            "turn_no",
            F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("said"),
            chat.unescape(F.col("target")).alias("learnt"),
            F.length("piece").cast("long").alias("chars"),
            (F.length("context") + F.length("target") + len(chat.TURN_END)).cast("long").alias("example_chars"),
        ).alias("_turn"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    said = F.array_join(F.transform("_turns", lambda t: t["said"]), "")
    learnt = F.array_join(F.transform("_turns", lambda t: t["learnt"]), "")  # nulls are left out
    chars = F.aggregate("_turns", F.lit(0).cast("long"), lambda n, t: F.coalesce(t["example_chars"], n + t["chars"]))
    return grouped.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        chars.alias("formatted_chars"),
    )


QUERIES = (op1_chat_prefix_targets,)

ORACLES = {
    "op1_chat_prefix_targets": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(role, '([<\[]\\*)(/?(?:s>|INST\]))', '\1\\\2', 'g') AS escaped_role,
    regexp_replace(text, '([<\[]\\*)(/?(?:s>|INST\]))', '\1\\\2', 'g') AS escaped_text
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped_role) + length(escaped_text) + 19)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
}
