"""Carry the last in-scope intent of a conversation to its follow-up turns, as turns arrive.

Turns may arrive in any order, so an earlier turn that comes late corrects the ones after it. The state store keeps
the turns of each conversation with the intent their own words give, as a streaming aggregation; a batch opens the
conversations it has turns of and answers those again. No batch reads what earlier ones wrote, so its work follows
the conversations it touches and not the length of the stream. The state lies with the checkpoint in the shared
folder; for more conversations than fit into memory choose Spark's RocksDB state store
(`spark.sql.streaming.stateStore.providerClass`). Classification and carrying are those of the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.operators.answers import ID_LISTS, classify, has_ids, in_scope
from stockloom.session import scratch_path
from stockloom.streaming.runs import each_batch, latest

TURN = ["conv_id", "turn"]


def turns_by_conversation(questions: DataFrame, strict: bool = False) -> DataFrame:
    """(conv_id, turns): what each turn says by itself, and whether it takes over an intent."""
    known = classify(questions, strict).where("conv_id IS NOT NULL")
    follows = (F.col("intent") == "out_of_scope") & (F.col("is_all") | has_ids(*ID_LISTS))
    turn = F.struct("turn", "intent", in_scope(F.col("intent")).alias("scoped"), follows.alias("follows"))
    return known.groupBy("conv_id").agg(F.collect_list(turn).alias("turns"))


def answered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, intent) of whole conversations: a follow-up takes the last in-scope intent before it."""
    turns = conversations.select("conv_id", F.inline("turns"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("scoped"), F.col("intent")), ignorenulls=True).over(before)
    return turns.select(*TURN, F.when(F.col("follows"), F.coalesce(last, F.col("intent"))).otherwise(F.col("intent")).alias("intent"))


def carried_intents(questions: DataFrame, path: str, strict: bool = False) -> StreamingQuery:
    """Read a stream of questions to its end. `path/intents` gets the intents of the touched conversations, by batch; a
    batch run again replaces its own folder."""
    return each_batch(
        turns_by_conversation(questions, strict),
        lambda b, n: answered(b).write.mode("overwrite").parquet(f"{path}/intents/batch_id={n}"), f"{path}/state", "update",
    )


def run_carried(questions: DataFrame, label: str = "carried") -> DataFrame:
    """(conv_id, turn, intent) of everything that has arrived: the newest row of each turn."""
    path = scratch_path(questions.sparkSession, label)
    carried_intents(questions, path)
    return latest(questions.sparkSession, f"{path}/intents", TURN)
