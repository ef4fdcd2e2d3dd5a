"""Instruction-text preparation queries over ``conversations``: L1-L5."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions.text import PY_WHITESPACE, RESPONSE_MARKER, inference_prompt, training_text
from ledgerspark.operators import textprep
from ledgerspark.plans.catalog import register
from ledgerspark.session import table

_WS = r"[ \t\n\r\f\x0B]"      # token separators (L2)
_STRIP = PY_WHITESPACE            # what Python's str.strip() removes (L4, L5)

_PAIRS_SQL = """
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'),
texts AS (
  SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS pair_id,
         '### Instruction: ' || prompt || chr(10) || '### Response: ' || response || '<|endoftext|>' AS text
  FROM pairs WHERE prompt IS NOT NULL AND response IS NOT NULL)
"""


def pair_texts(spark, sf):
    pairs = textprep.pair_turns(table(spark, sf, "conversations"))
    accepted, _rejected = textprep.training_texts(pairs)
    return accepted.withColumn("pair_id", F.concat_ws("-", F.col("conv_id").cast("string"),
                                                      F.col("turn").cast("string")))


@register("l1_training_text", ("L1",), oracle=f"""
WITH {_PAIRS_SQL}
SELECT conv_id, turn, text FROM texts
""")
def l1_training_text(spark, sf):
    return pair_texts(spark, sf).select("conv_id", "turn", "text")


_VOCAB_SQL = f"""
arrs AS (SELECT pair_id, list_filter(regexp_split_to_array(text, '{_WS}+'), lambda t: t <> '') AS arr FROM texts),
toks AS (SELECT pair_id, unnest(arr) AS token, unnest(range(1, len(arr) + 1)) AS pos FROM arrs),
counts AS (SELECT token, count(*) AS n FROM toks GROUP BY token),
vocab AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) - 1 AS token_id FROM counts)
"""


@register("l2_vocabulary", ("L2",), oracle=f"""
WITH {_PAIRS_SQL}, {_VOCAB_SQL}
SELECT token, n, token_id FROM vocab
""")
def l2_vocabulary(spark, sf):
    return textprep.build_vocabulary(pair_texts(spark, sf), "pair_id")


@register("l2_l3_tokenize", ("L2", "L3"), oracle=f"""
WITH {_PAIRS_SQL}, {_VOCAB_SQL},
ids AS (
  SELECT t.pair_id, list(v.token_id ORDER BY t.pos) AS ids
  FROM toks t JOIN vocab v ON t.token = v.token WHERE t.pos <= 128 GROUP BY t.pair_id),
L AS (SELECT max(len(ids)) AS L FROM ids),
V AS (SELECT count(*) AS V FROM vocab)
SELECT pair_id,
       array_to_string(list_resize(ids, L, V), ',') AS input_ids,
       array_to_string(list_resize(list_transform(ids, lambda x: 1), L, 0), ',') AS attention_mask,
       array_to_string(list_resize(ids, L, V), ',') AS labels
FROM ids, L, V
""")
def l2_l3_tokenize(spark, sf):
    texts = pair_texts(spark, sf)
    vocab = textprep.build_vocabulary(texts, "pair_id")
    tok = textprep.tokenize(texts, vocab, "pair_id")
    return tok.select("pair_id", *[F.array_join(c, ",").alias(c) for c in ("input_ids", "attention_mask", "labels")])


def chat_messages(spark, sf):
    """User turns as chat requests; every 7th conversation's messages are made
    absent, empty or blank."""
    c = table(spark, sf, "conversations").filter(F.col("role") == "user")
    k = F.col("conv_id")
    msg = (F.when((k % 7 == 0) & (F.col("turn") % 3 == 0), F.lit(None).cast("string"))
           .when((k % 7 == 0) & (F.col("turn") % 3 == 1), F.lit(""))
           .when(k % 7 == 0, F.lit(" \t \n"))
           .otherwise(F.col("text")))
    return c.select("conv_id", "turn", msg.alias("text"))


@register("l4_chat_prompts", ("L4",), oracle=f"""
WITH m AS (
  SELECT conv_id, turn,
         CASE WHEN conv_id % 7 = 0 AND turn % 3 = 0 THEN NULL
              WHEN conv_id % 7 = 0 AND turn % 3 = 1 THEN ''
              WHEN conv_id % 7 = 0 THEN ' ' || chr(9) || ' ' || chr(10)
              ELSE text END AS text
  FROM conversations WHERE role = 'user'),
b AS (SELECT *, regexp_replace(coalesce(text, ''), '^{_STRIP}+|{_STRIP}+$', '', 'g') = '' AS blank FROM m)
SELECT conv_id, turn, text,
       CASE WHEN blank THEN NULL ELSE '### Instruction: ' || text || chr(10) || '### Response:' END AS prompt,
       CASE WHEN blank THEN '⚠️ Please enter a valid question.' END AS reply
FROM b
""")
def l4_chat_prompts(spark, sf):
    return textprep.chat_prompts(chat_messages(spark, sf))


def generated_transcripts(spark, sf):
    """Generation-shaped text from the instruction pairs: with one response
    marker, without any, or with two."""
    pairs = textprep.pair_turns(table(spark, sf, "conversations"))
    kind = (F.col("conv_id") + F.col("turn")) % 3
    one = F.concat(inference_prompt("prompt"), F.lit(" "), F.col("response"))
    two = F.concat(training_text("prompt", "response"), F.lit("\n" + RESPONSE_MARKER + "  "), F.col("prompt"),
                   F.lit("  \n"))
    text = F.when(kind == 0, one).when(kind == 1, F.col("response")).otherwise(two)
    return pairs.select("conv_id", "turn", text.alias("text"))


@register("l5_extract_response", ("L5",), oracle=f"""
WITH {_PAIRS_SQL},
g AS (
  SELECT conv_id, turn,
         CASE WHEN (conv_id + turn) % 3 = 0
                THEN '### Instruction: ' || prompt || chr(10) || '### Response:' || ' ' || response
              WHEN (conv_id + turn) % 3 = 1 THEN response
              ELSE '### Instruction: ' || prompt || chr(10) || '### Response: ' || response || '<|endoftext|>'
                   || chr(10) || '### Response:  ' || prompt || '  ' || chr(10) END AS text
  FROM pairs)
SELECT conv_id, turn, text,
       CASE WHEN strpos(text, '### Response:') > 0
            THEN regexp_replace(string_split(text, '### Response:')[-1], '^{_STRIP}+|{_STRIP}+$', '', 'g')
            ELSE text END AS response
FROM g
""")
def l5_extract_response(spark, sf):
    return textprep.responses(generated_transcripts(spark, sf))
