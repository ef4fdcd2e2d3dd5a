"""instruction/response text preparation as Spark jobs.

The reference feeds prompt/response pairs through a byte-pair tokenizer it
downloads. There is no vocabulary file here, so L2 is re-aimed: a corpus
vocabulary is built by a distributed word count, ranked (count desc, token
asc), and ids are joined back -- all DataFrame work, numbering included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.text import (
    DEFAULT_EOS, blank_message_reply, extract_response, inference_prompt, training_text,
)
from ledgerspark.session import ensure_checkpoint_dir

MAX_LENGTH = 128  # fixed value: the reference truncates to 128 tokens
HEAD_TOKENS = 1 << 16  # rows of the vocabulary that are broadcast
SPLIT_PATTERN = "[ \\t\\n\\r\\f\\x0B]+"


def pair_turns(conversations: DataFrame) -> DataFrame:
    """Instruction pairs: each user turn with the assistant turn right after it.

    An equi-join on (conv_id, turn) rather than a window over the conversation,
    so one very long conversation is spread over many tasks."""
    users = conversations.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prompt"))
    answers = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return users.join(answers, ["conv_id", "turn"], "inner")


def training_texts(pairs: DataFrame, eos: str = DEFAULT_EOS):
    """L1: ``(accepted, rejected)``; rows with a NULL prompt or response are
    rejected with a reason instead of producing NULL text."""
    bad = F.col("prompt").isNull() | F.col("response").isNull()
    accepted = pairs.filter(~bad).withColumn("text", training_text("prompt", "response", eos))
    rejected = pairs.filter(bad).withColumn(
        "reason", F.when(F.col("prompt").isNull(), "Missing prompt").otherwise("Missing response"))
    return accepted, rejected


def words(texts: DataFrame, id_col: str, text_col: str = "text", first: int | None = None) -> DataFrame:
    """(id, pos, token) for every whitespace-separated token of every text, or
    for the ``first`` tokens of each (cut before any row is generated)."""
    toks = F.filter(F.split(F.col(text_col), SPLIT_PATTERN), lambda t: t != "")
    if first is not None:
        toks = F.slice(toks, 1, first)
    return texts.select(F.col(id_col), F.posexplode(toks).alias("pos", "token"))


def build_vocabulary(texts: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Token ids by corpus frequency: rank 0 = most frequent, ties by token.

    The count is a partial aggregation. Numbering stays in the JVM: the
    vocabulary is range-partitioned and sorted by (count desc, token), each
    row's (partition, position) comes from ``monotonically_increasing_id``,
    and a running sum over the per-partition sizes (one row per partition,
    so a proven size bound: broadcast) turns them into global ranks. The
    placed rows are checkpointed: range bounds come from a sample, so sizes
    and rows must be read from one evaluation. No single-task window over
    the vocabulary, no Python per row."""
    spark = texts.sparkSession
    counts = words(texts, id_col, text_col).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("token").asc()]
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = counts.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    tagged = ordered.select("token", "n", F.shiftright(mid, 33).alias("_pid"),
                            mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"))
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return tagged.join(F.broadcast(offsets), "_pid").select(
        "token", "n", (F.col("_off") + F.col("_pos")).cast("bigint").alias("token_id"))


def dense_positions(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in the order of ``order`` (which should tell rows apart; ties take neighbouring places). Rows
    are range-partitioned and sorted, written once to the shared checkpoint folder, and numbered by their place in the partition
    plus the rows of earlier partitions (one row per partition)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.shiftright(mid, 33)).withColumn("_at", mid.bitwiseAND(F.lit((1 << 33) - 1))))
    ensure_checkpoint_dir(df.sparkSession)
    placed = placed.checkpoint(eager=True)
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return placed.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_at")).drop("_pid", "_at", "_off")


def tokenize(texts: DataFrame, vocab: DataFrame, id_col: str, text_col: str = "text",
             max_length: int = MAX_LENGTH, pad_id: int | None = None, batch_rows: int | None = None) -> DataFrame:
    """L2 + L3: ``input_ids`` truncated to ``max_length`` and right-padded to
    the longest row of the dataset, ``attention_mask`` 1 on tokens and 0 on
    padding, ``labels`` = a copy of ``input_ids`` (padding not masked).

    With ``batch_rows``, rows in the order of ``id_col`` are taken in batches of that many (the last may be shorter) and each
    batch is padded to its own longest row, as a batched map over a data set does; ``batch`` numbers them from 0.

    Only the first ``max_length`` positions are joined to the vocabulary
    (truncation is the operator's own rule), so no group holds more than
    ``max_length`` tokens. The ``HEAD_TOKENS`` lowest ids, the most frequent
    tokens, are joined by broadcast, so no frequent token gathers its
    occurrences in one task; all others meet in a shuffled join."""
    toks = words(texts, id_col, text_col, max_length)
    entries = vocab.select("token", "token_id")
    head = F.broadcast(entries.filter(F.col("token_id") < HEAD_TOKENS))
    rest = toks.join(head, "token", "left_anti")
    ided = toks.join(head, "token", "inner").unionByName(
        rest.join(entries.filter(F.col("token_id") >= HEAD_TOKENS), "token", "inner"))
    per_text = ided.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_p"))
    ids = texts.select(id_col).join(per_text, id_col, "left").select(
        id_col, F.coalesce(F.transform("_p", lambda s: s["token_id"]), F.array().cast("array<bigint>"))
        .alias("_ids"))
    more = []
    if batch_rows:
        ids = dense_positions(ids, id_col).withColumn("batch", F.floor(F.col("position") / batch_rows)).drop("position")
        longest = ids.groupBy("batch").agg(F.max(F.size("_ids")).alias("_L"))
        out, more = ids.join(longest, "batch"), ["batch"]
    else:
        ensure_checkpoint_dir(texts.sparkSession)
        ids = ids.checkpoint(eager=True)  # read twice: for the longest row and for the output
        # Dataset-wide scalars as uncorrelated scalar subqueries (evaluated once).
        out = ids.withColumn("_L", ids.select(F.max(F.size("_ids"))).scalar())
    # pad token = eos; with no vocabulary entry of its own it takes the id after the last token
    pad = F.lit(pad_id).cast("bigint") if pad_id is not None else vocab.select(F.count(F.lit(1))).scalar()
    n_pad = F.col("_L") - F.size("_ids")
    return out.select(
        id_col, *more,
        F.concat("_ids", F.array_repeat(pad, n_pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), n_pad)).alias("attention_mask"),
        F.concat("_ids", F.array_repeat(pad, n_pad)).alias("labels"),
    )


def chat_prompts(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """L4: the generation prompt, or the fixed warning for a blank message."""
    return messages.withColumn("prompt", inference_prompt(text_col)).withColumn(
        "reply", blank_message_reply(text_col))


def responses(generated: DataFrame, text_col: str = "text") -> DataFrame:
    """The answer part of generated text."""
    return generated.withColumn("response", extract_response(text_col))
