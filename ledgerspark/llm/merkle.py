"""Merkle manifest of a dataset as postorder append logs.

Leaves are hashed where the rows are read, then numbered within their tree (a column such as lang) by a range partition:
position in the written partition plus the tree's rows in earlier partitions. A builder takes one aligned block of ``2**height``
leaves in order and appends nodes to its log in the order in which they are completed: each leaf, then every parent that
this leaf completes. That is postorder, so a node's place in the log follows from the sizes of the complete subtrees before it
(``place``) and no index is stored. Blocks' roots are the leaves of the next, ``2**height`` times smaller round of
builders, until each tree has one block; the trees' roots, in order of their names, are the leaves of one tree more.

Proofs are taken from the top down: a round joins each log with the path of its own root and reads every leaf's siblings at
their closed-form places. A task holds one block: its leaves, its log, and the paths of its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import materialize, ship_package

HEIGHT = 12  # a block has 4,096 leaves: a log of 262 kB
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left: boolean, hash: string>>"
LOG = "tree string, block long, total long, root string, log binary"


# --- one block -----------------------------------------------------------------------------------

def parent(children: str) -> str:
    return hashlib.sha256(children.encode()).hexdigest()


def levels_of(n: int, total: int, height: int) -> int:
    """Levels above the leaves of a block of ``n`` of its tree's ``total`` leaves: a tree's only block ends with one node,
    any other at the common height."""
    return height if total > 1 << height else (n - 1).bit_length()


def append_log(leaves: Iterable[str], n: int, levels: int) -> list[str]:
    """Nodes over ``n`` leaves in order of completion. A run of one node, at the right edge, is hashed alone."""
    log: list[str] = []
    waiting = [""] * (levels + 1)
    for i, node in enumerate(leaves):
        log.append(node)
        for level in range(levels):
            if i >> level & 1:
                node = parent(waiting[level] + node)
            elif i == n - 1:
                node = parent(node)
            else:
                waiting[level] = node
                break
            log.append(node)
    return log


def place(level: np.ndarray | int, index: np.ndarray, n: int) -> np.ndarray:
    """Where the log of ``n`` leaves has node ``index`` of ``level``: before its last leaf e stand 2 * e - popcount(e) nodes, since
    every subtree that ended there is complete, and it comes ``level`` nodes after that leaf."""
    last = np.minimum((index + 1) << level, n) - 1
    return 2 * last - np.bitwise_count(last).astype(np.int64) + level


def _append(block: pa.Table, height: int) -> pa.Table:
    order = block.sort_by("idx")
    n, total = order.num_rows, order["total"][0].as_py()
    log = append_log(order["hash"].to_pylist(), n, levels_of(n, total, height))
    return pa.table({"tree": order["tree"].slice(0, 1), "block": pa.array([order["idx"][0].as_py() >> height], pa.int64()), "total": pa.array([total], pa.int64()),
                     "root": pa.array([log[-1]], pa.string()), "log": pa.array([bytes.fromhex("".join(log))], pa.binary())})


_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint8).reshape(256, 2)


def block_paths(index: np.ndarray, log: bytes, n: int, levels: int, above: list[dict]) -> pa.Array:
    """For leaves ``index`` of a block: the siblings on the way to the tree's root, a step per level (a null hash
    where a node is hashed alone), then the steps ``above`` the block."""
    nodes = np.frombuffer(log, np.uint8).reshape(-1, 32)
    at = index[:, None] >> np.arange(levels)
    sibling = at ^ 1
    there = (sibling << np.arange(levels)) < n
    row = np.where(there, place(np.arange(levels), np.where(there, sibling, 0), n), 0)
    known = [s["hash"] is not None for s in above]
    text = np.concatenate([_HEX[nodes].reshape(-1, 64), np.frombuffer("".join(s["hash"] or "0" * 64 for s in above).encode(), np.uint8).reshape(-1, 64)])
    m, more = len(index), len(above)
    row = np.concatenate([row, np.broadcast_to(len(nodes) + np.arange(more), (m, more))], 1).ravel()
    there = np.concatenate([there, np.broadcast_to(np.array(known, bool), (m, more))], 1).ravel()
    left = np.concatenate([sibling < at, np.broadcast_to(np.array([s["left"] for s in above], bool), (m, more))], 1).ravel()
    hashes = pa.StringArray.from_buffers(len(row), pa.py_buffer(np.arange(0, 64 * len(row) + 1, 64, dtype=np.int32).tobytes()), pa.py_buffer(text[row].tobytes()))
    steps = pa.StructArray.from_arrays([pa.array(left), pc.if_else(pa.array(there), hashes, pa.scalar(None, pa.string()))], ["left", "hash"])
    return pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * (levels + more), pa.int32()), steps)


# --- Spark ---------------------------------------------------------------------------------------

@dataclass
class Forest:
    """Rounds of one set of trees: per round (leaves of the round, its logs)."""

    rounds: list[tuple[DataFrame, DataFrame]]
    height: int

    def roots(self) -> DataFrame:
        """(tree, hash), one row per tree."""
        ended = [logs.filter(F.col("total") <= 1 << self.height).select("tree", F.col("root").alias("hash")) for _, logs in self.rounds]
        out = ended[0]
        for more in ended[1:]:
            out = out.unionByName(more)
        return out


@dataclass
class Manifest:
    """``leaves`` of ``docs`` with their number; a log per aligned block; the trees' roots and the root of all."""

    trees: Forest
    top: Forest
    root: str | None


def field(c: str) -> Column:
    """UTF-8 byte count, colon, value; a dash if null."""
    value = F.col(c).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def tree_name(c: str) -> Column:
    """A tree's name: null before all strings, those by bytes."""
    return F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (tree, ...) plus idx, the place in the tree by ``order`` (nulls first), and total, the tree's rows. ``order`` must tell all
    rows apart, so that a tree with most rows spreads over as many tasks as its rows need."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = (rows.repartitionByRange(n, "tree", *order).sortWithinPartitions("tree", *order)
              .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))
    ranked = materialize(ranked, "merkle-order")  # positions are settled once
    # partitions + trees rows
    pieces = ranked.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (pieces.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
              .withColumn("total", F.sum("n").over(Window.partitionBy("tree"))).drop("first", "n"))
    return (ranked.join(pieces, ["part", "tree"]).withColumn("idx", F.col("at") + F.col("before")).drop("part", "at", "before"))


def grow(leaves: DataFrame, height: int = HEIGHT) -> Forest:
    """Builders over ``leaves`` (tree, idx, total, hash, ...), round by round until each tree has one block."""
    ship_package(leaves.sparkSession)
    rounds, nodes = [], leaves
    while True:
        block = F.shiftright("idx", height)
        logs = materialize(nodes.select("tree", "idx", "total", "hash").groupBy("tree", block.alias("block")).applyInArrow(lambda t: _append(t, height), LOG), "merkle-log")
        rounds.append((nodes.withColumn("block", block), logs))
        inner = logs.filter(F.col("total") > 1 << height)
        if inner.isEmpty():
            return Forest(rounds, height)
        nodes = inner.select("tree", F.col("block").alias("idx"), F.shiftright(F.col("total") + ((1 << height) - 1), height).alias("total"), F.col("root").alias("hash"))


def paths(forest: Forest, above: DataFrame, *keep: str) -> DataFrame:
    """tree, idx, hash, subroot, steps and the columns ``keep`` for the leaves of ``forest``; ``above`` (tree, steps) has the steps from
    each tree's root on."""
    height, roots = forest.height, forest.roots()
    ends = roots.select("tree", F.col("hash").alias("subroot")).join(above.select("tree", F.col("steps").alias("above")), "tree")
    found = None
    for i, (nodes, logs) in reversed(list(enumerate(forest.rounds))):
        last = i == 0
        outer = logs.filter(F.col("total") <= 1 << height).join(ends, "tree")
        if found is not None:
            inner = found.select("tree", F.col("idx").alias("block"), "subroot", F.col("steps").alias("above"))
            outer = outer.unionByName(logs.join(inner, ["tree", "block"]).select(*outer.columns))
        more = keep if last else ()
        kept = nodes.select("tree", "block", "idx", "hash", *more)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "block")

        def extract(left: pa.Table, right: pa.Table) -> pa.Table:
            row = right.slice(0, 1).to_pylist()[0]
            first, index = row["block"] << height, left["idx"].to_numpy()
            n = min(1 << height, row["total"] - first)
            steps = block_paths(index - first, row["log"], n, levels_of(n, row["total"], height), row["above"])
            out = left.drop_columns(["block"])
            return out.append_column("subroot", pa.array([row["subroot"]] * left.num_rows, pa.string())).append_column("steps", steps)

        found = (kept.groupBy("tree", "block").cogroup(outer.select("tree", "block", "total", "log", "subroot", "above").groupBy("tree", "block"))
                 .applyInArrow(extract, f"{schema}, subroot string, steps {STEPS}"))
    return found


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, tree: str = "lang", order: str = "doc_id", height: int = HEIGHT,
          **more: Column) -> Manifest:
    """The manifest of ``docs``: a leaf per row is the hash of ``columns``, a tree per value of ``tree``, leaves ascending by ``order`` (nulls
    first, ties by leaf). ``more`` are columns to keep beside the leaves. Texts are read once, hashed and left behind.

    A null value has a leaf like any other, a null tree is a tree before all others. Rows that are equal in all columns are
    leaves of their own. Without rows there is no root. Other columns are ignored."""
    leaf = sha(F.concat(*[field(c) for c in columns]))
    rows = materialize(docs.select(tree_name(tree).alias("tree"), F.col(order).alias("key"), leaf.alias("hash"), F.monotonically_increasing_id().alias("row"),
                                   *[c.alias(name) for name, c in more.items()]), "merkle-leaves")
    trees = grow(numbered(rows, "key", "hash", "row"), height)
    names = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    top = grow(numbered(names, "name"), height)
    root = top.roots().first()
    return Manifest(trees, top, root["hash"] if root else None)


def proofs(manifest: Manifest, *keep: str) -> DataFrame:
    """key (the ordering column), hash (the leaf), subroot, and steps, the siblings from leaf to root (left: stands before the node on the
    path; a null hash: the node is hashed alone), and the columns ``keep`` that the manifest was built with."""
    empty = manifest.top.roots().select("tree", F.array().cast(STEPS).alias("steps"))
    above = paths(manifest.top, empty, "name").select(F.col("name").alias("tree"), "steps")
    return paths(manifest.trees, above, "key", *keep).select("key", "hash", "subroot", "steps", *keep)


def siblings(steps: Column) -> Column:
    """All sibling hashes of a proof in one string."""
    return F.array_join(F.transform(steps, lambda s: s["hash"]), "")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` and the siblings of a proof give."""
    def up(node: Column, step: Column) -> Column:
        h = F.coalesce(step["hash"], F.lit(""))
        return sha(F.when(step["left"], F.concat(h, node)).otherwise(F.concat(node, h)))
    return F.aggregate(steps, leaf, up)


def tamper_proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every row's proof, held against rows some of which (crc32 of the
    decimal doc_id divisible by 7; not those without an id) have an n_chars one too high. See ``build`` for nulls and ties."""
    names = {"doc_id": F.col("doc_id").cast("long"), "source": "source", "lang": "lang", "n_chars": F.col("n_chars").cast("decimal(38,0)"), "text": "text"}
    docs = docs.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in names.items()])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    wrong = sha(F.concat(*[field(c) if c != "n_chars" else
                           F.coalesce(F.concat(F.octet_length((F.col(c) + 1).cast("string")).cast("string"), F.lit(":"), (F.col(c) + 1).cast("string")), F.lit("-")) for c in COLUMNS]))
    manifest = build(docs, height=height, told=F.when(hit, wrong))
    out = proofs(manifest, "told")
    root = F.lit(manifest.root).cast("string")
    folded = fold(F.coalesce("told", "hash"), F.col("steps"))
    out = out.select(F.col("key").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", root.alias("root"), sha(siblings(F.col("steps"))).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(n_chars: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


#: crc32 of the decimal doc_id, bit by bit: -1 stands for one shift
_SQL_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for x in string_split(doc_id::VARCHAR, '')])),
                  lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""

ORACLE = f"""
WITH RECURSIVE d0 AS (SELECT doc_id, coalesce('s' || lang, 'n') AS k, {_sql_leaf("n_chars")} AS leaf,
      CASE WHEN {_SQL_CRC} % 7 = 0 THEN {_sql_leaf("n_chars::HUGEINT + 1")} END AS told FROM documents),
d AS (SELECT *, row_number() OVER (ORDER BY k, doc_id NULLS FIRST, leaf) AS r, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d0),
t AS (SELECT k, 0 AS lvl, i, leaf AS h, count(*) OVER (PARTITION BY k) AS n FROM d
      UNION ALL
      SELECT k, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY k, lvl, i // 2),
s AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, i, h, n FROM s
      UNION ALL
      SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, i // 2),
p AS (SELECT d.r, l.lvl AS seq, o.i < (d.i >> l.lvl) AS lft, o.h
      FROM d JOIN (SELECT DISTINCT k, lvl FROM t WHERE n > 1) l ON l.k = d.k LEFT JOIN t o ON o.k = d.k AND o.lvl = l.lvl AND o.i = xor(d.i >> l.lvl, 1)
      UNION ALL
      SELECT d.r, 1000 + l.lvl, o.i < (s.i >> l.lvl), o.h
      FROM d JOIN s ON s.k = d.k JOIN (SELECT DISTINCT lvl FROM u WHERE n > 1) l ON true LEFT JOIN u o ON o.lvl = l.lvl AND o.i = xor(s.i >> l.lvl, 1)),
q AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY seq) AS pos FROM p),
f AS (SELECT r, 0 AS pos, coalesce(told, leaf) AS h FROM d
      UNION ALL
      SELECT f.r, f.pos + 1, sha256(CASE WHEN q.lft THEN q.h || f.h ELSE f.h || coalesce(q.h, '') END) FROM f JOIN q ON q.r = f.r AND q.pos = f.pos + 1),
w AS (SELECT r, arg_max(h, pos) AS folded_root FROM f GROUP BY r),
g AS (SELECT r, sha256(coalesce(string_agg(h, '' ORDER BY pos), '')) AS proof_sha256 FROM q GROUP BY r),
z AS (SELECT h AS root FROM u WHERE n = 1)
SELECT d.doc_id, d.leaf, s.h AS subroot, z.root, coalesce(g.proof_sha256, sha256('')) AS proof_sha256, w.folded_root, w.folded_root = z.root AS verified
FROM d JOIN s ON s.k = d.k JOIN w ON w.r = d.r CROSS JOIN z LEFT JOIN g ON g.r = d.r
"""
