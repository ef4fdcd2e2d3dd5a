r"""Chat formatting: reply trees, the best path of each, one string per conversation. DataFrame functions only.

A reply tree has a row per message: tree, node, parent (null for a root), score. Paths come from iterative
self-joins by pointer doubling: step k joins each node's 2**k-th ancestor with that ancestor's own, so a path
of any depth takes log2(depth) joins, and its score and length add up on the way. Leaves are ranked by mean score; the
path of a chosen leaf is unrolled with the same jump tables.

Template: ``<s>`` then each turn between the marks of its role, then ``</s>``. Marks (fixed values): user ``[INST]``
``[/INST]``, assistant ``[OUT]`` ``[/OUT]``, system ``[SYS]`` ``[/SYS]``, any other role ``[ROLE]`` name ``[/ROLE]`` before
``[TURN]`` ``[/TURN]``. Inside texts and names every backslash is doubled and a backslash is put behind the first
character of anything that reads like a mark, so that marks occur where the template puts them only; after
doubling, a single backslash there can come from escaping alone, which makes it reversible.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import NULL_ID, materialize

TAGS = {"user": "INST", "assistant": "OUT", "system": "SYS"}
_REST = r"/?(?:s>|(?:INST|OUT|SYS|TURN|ROLE)\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])({_REST})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, rf"([<\[])\\({_REST})", "$1$2"), F.lit("\\\\"), F.lit("\\"))


def _open(role: Column) -> Column:
    other = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE][TURN]"))
    return reduce(lambda c, t: F.when(role == t[0], F.lit(f"[{t[1]}]")).otherwise(c), TAGS.items(), other)


def _close(role: Column) -> Column:
    return reduce(lambda c, t: F.when(role == t[0], F.lit(f"[/{t[1]}]")).otherwise(c), TAGS.items(), F.lit("[/TURN]"))


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """tree, branch (1 is the best), node, step (from 0 at the root) for the ``branches`` best root-to-leaf paths of each tree.

    ``nodes``: tree, node (unique in its tree), parent, score. A parent that is not there makes its child a root. A null
    score counts as 0. Branches rank by mean score, ties by the smaller leaf. Nodes on a cycle, and those
    below one, hang from no root and are on no path.
    """
    n = nodes.select("tree", "node", F.col("parent").alias("anc"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    there = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    jump = (n.join(there, (n["tree"] == there["t"]) & (n["anc"] == there["p"]), "left")
            .select("tree", "node", F.col("p").alias("anc"), "total", F.lit(1).cast("long").alias("depth")))
    parents = jump.filter("anc IS NOT NULL").select("tree", F.col("anc").alias("node")).distinct()
    jumps = [materialize(jump, "jump-0")]
    most = jumps[0].count()
    while (1 << len(jumps)) <= 2 * most and not jumps[-1].filter("anc IS NOT NULL").isEmpty():
        a, b = jumps[-1], jumps[-1].select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("anc").alias("up"),
                                           F.col("total").alias("more"), F.col("depth").alias("further"))
        # paths that have reached their root are done and meet no join again
        going = a.filter("anc IS NOT NULL")
        step = (going.join(b, (going["tree"] == b["t"]) & (going["anc"] == b["n"]))
                .select("tree", "node", F.col("up").alias("anc"), (F.col("total") + F.col("more")).alias("total"),
                        (F.col("depth") + F.col("further")).alias("depth")))
        step = step.unionByName(a.filter("anc IS NULL"))
        jumps.append(materialize(step, f"jump-{len(jumps)}"))
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), "node")
    leaves = (jumps[-1].filter("anc IS NULL").join(parents, ["tree", "node"], "left_anti")
              .withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= branches))
    path = leaves.select("tree", "branch", "node", (F.col("depth") - 1).alias("step"))
    for k, j in reversed(list(enumerate(jumps[:-1]))):  # far ancestors first: the rows only grow to the path's length at the end
        up = j.filter("anc IS NOT NULL").select(F.col("tree").alias("t"), F.col("node").alias("n"), "anc")
        both = F.array(F.struct("node", "step"), F.struct(F.col("anc").alias("node"), (F.col("step") - (1 << k)).alias("step")))
        path = (path.join(up, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")), "left")
                .select("tree", "branch", F.inline(F.when(F.col("anc").isNull(), F.slice(both, 1, 1)).otherwise(both))))
    return path


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """tree, branch, formatted, loss (byte spans of the assistants' texts in it), one row per path.

    ``messages``: tree, node, role, text; null role or text: empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (paths.join(messages.select("tree", "node", role.alias("role"), escape(text).alias("body")), ["tree", "node"])
             .withColumn("open", _open(F.col("role")))
             .withColumn("piece", F.concat("open", "body", _close(F.col("role")))))
    before = Window.partitionBy("tree", "branch").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(3) + F.coalesce(F.sum(F.octet_length("piece")).over(before), F.lit(0)) + F.octet_length("open")
    span = F.when(F.col("role") == "assistant", F.struct(F.col("start"), F.octet_length("body").cast("long").alias("size")))
    return (turns.withColumn("start", start.cast("long"))
            .groupBy("tree", "branch")
            .agg(F.sort_array(F.collect_list(F.struct("step", "piece"))).alias("pieces"), F.sort_array(F.collect_list(span)).alias("loss"))
            .select("tree", "branch", F.concat(F.lit("<s>"), F.array_join("pieces.piece", ""), F.lit("</s>")).alias("formatted"), "loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    inner = F.substring(formatted.cast("binary"), 4, F.octet_length(formatted) - 7).cast("string")
    pieces = F.split(inner, r"\[/(?:INST|OUT|SYS|TURN)\]")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.lit(None).cast("string")
        for name, tag in TAGS.items():
            role = F.when(piece.startswith(f"[{tag}]"), F.lit(name)).otherwise(role)
        other = unescape(F.regexp_extract(piece, r"(?s)\A\[ROLE\](.*?)\[/ROLE\]\[TURN\]", 1))
        body = F.regexp_replace(piece, r"(?s)\A(?:\[(?:INST|OUT|SYS)\]|\[ROLE\].*?\[/ROLE\]\[TURN\])", "")
        return F.struct(F.coalesce(role, other).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    data = formatted.cast("binary")
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(data, (s["start"] + 1).cast("int"), s["size"].cast("int")).cast("string"))), "")


def conversation_tree(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees: each row answers the one before it by turn (nulls first; ties by
    role, then text digest). Rows without a conv_id form one conversation of their own."""
    r = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("tree"), "turn", "role", "text")
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), F.coalesce("role", F.lit("")), F.xxhash64(F.coalesce("text", F.lit(""))))
    node = F.row_number().over(order).cast("long")
    return (r.withColumn("node", node).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
            .withColumn("score", F.length(F.coalesce("text", F.lit(""))).cast("double")))


def format_conversations(rows: DataFrame, branches: int = 1) -> DataFrame:
    """tree, branch, formatted, loss for the best paths of each conversation in ``rows``; an empty table gives none."""
    tree = materialize(conversation_tree(rows), "messages")
    return format_paths(tree, best_paths(tree, branches))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:s>|(?:INST|OUT|SYS|TURN|ROLE)\]))', '\1\\\2', 'g') AS body,
      CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 11 WHEN 'system' THEN 11
           ELSE 26 + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?(?:s>|(?:INST|OUT|SYS|TURN|ROLE)\]))', '\1\\\2', 'g')) END AS marks FROM c),
l AS (SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role) FILTER (role = 'assistant'), '') AS loss,
      string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role) AS turns, count(*) AS n,
      sum(length(body) + marks) + 7 AS formatted FROM e GROUP BY conv_id)
SELECT conv_id, n AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted AS BIGINT) AS formatted_chars FROM l
"""
