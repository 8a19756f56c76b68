"""The trie of conversation prefixes, its subtree totals by parallel tree contraction.

Conversations that begin with the same turns share nodes.  A prefix is told by two 64-bit running
hashes of its turns (each hash takes the turn's depth in), so texts are read once and only narrow
rows are exchanged.  The running hashes come from an ordered scan over sampled ranges, so one very
long conversation is spread over many tasks.

Totals over subtrees need no walk from leaf to root: the tree is contracted in rounds of joins.

* *Compress*: every maximal chain of nodes with one child is folded by pointer doubling into its top;
  what it gathered goes to the top's parent, which becomes the parent of the node below the chain.
* *Rake*: all leaves give their totals to their parents and go.

After a compress every inner node has two children or more, so a rake removes more than half of
what is left: rounds grow with the logarithm of the nodes (doubling: of the longest chain), not with
the depth.  Then the contracted nodes are re-expanded, the last round first: a chain node's total is
what its chain gathered from it downwards and the total of the node below the chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.llm.common import tidy
from verity.operators.sequence import keyed_scan
from verity.session import checkpoint, ship_package

#: Every conversation begins with up to ``BEGINNINGS - 1`` turns of the first of its block of ids.
BLOCK = 100
BEGINNINGS = 6
#: Bytes of ids of one node that a task holds before it passes them on as a piece.
PIECE = 1 << 20

RESULT = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
          "saved_tokens bigint, ends_sha256 string")
_ENDS = "p1 bigint, p2 bigint, depth bigint, first bigint, ids binary, sha string"

ORACLE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt, row_number() OVER (PARTITION BY conv_id
         ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (
  SELECT conv_id, conv_id - conv_id % {BLOCK} AS b, xor(list_reduce(list_prepend(4294967295::UBIGINT,
         list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)), lambda crc, byte: list_reduce(
         [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))),
         4294967295::UBIGINT) % {BEGINNINGS} AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT i.conv_id, 0 AS own, t.pos, t.role, t.txt FROM i JOIN t ON t.conv_id = i.b AND t.pos <= i.h
  UNION ALL SELECT i.conv_id, 1, t.pos, t.role, t.txt FROM i JOIN t ON t.conv_id = i.conv_id AND t.pos > i.h),
n AS (
  SELECT conv_id, row_number() OVER w AS d, length(txt) AS chars,
         sha256(string_agg(sha256(length(role) || ':' || role || txt), ',') OVER w) AS k
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
m AS (SELECT conv_id, d, chars, k FROM n UNION ALL SELECT conv_id, 0, 0, '' FROM i),
l AS (SELECT *, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM m),
node AS (
  SELECT d, k, min(conv_id) AS c, count(*) AS n, max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS sha
  FROM l GROUP BY d, k),
up AS (
  SELECT node.d, node.k, parent.c AS pc, parent.k AS pk FROM node JOIN m ON m.conv_id = node.c AND m.d = node.d - 1
  JOIN node AS parent ON parent.d = m.d AND parent.k = m.k),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n FROM up GROUP BY d, pk),
total AS (
  SELECT m.d, m.k, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum((node.n - 1) * node.chars) AS saved
  FROM node LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k
  JOIN m ON m.conv_id = node.c AND m.d <= node.d GROUP BY m.d, m.k)
SELECT node.c AS conv_id, node.d::BIGINT AS depth, up.pc AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       total.leaves AS n_leaves, total.saved::BIGINT AS saved_tokens, node.sha AS ends_sha256
FROM node JOIN total ON total.d = node.d AND total.k = node.k LEFT JOIN up ON up.d = node.d AND up.k = node.k
LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k
"""


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), h1, h2 (hashes of role and text) and chars of each turn.

    Turns go by ``turn`` (null first), ties by role and the text's md5; a null role or text is empty.
    Rows with a null conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.md5(text).alias("md5"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit("second"), text, role).alias("h2"),
        F.length(text).cast("bigint").alias("chars"),
    )
    placed = keyed_scan(rows, ["conv_id"], ["turn", "role", "md5"])
    return placed.select("conv_id", F.col("_pos").alias("depth"), "h1", "h2", "chars")


def shared_beginnings(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``turns`` with the first h turns of conversation c - c % BLOCK before c's own turns after its
    first h, where h = crc32(decimal c) % BEGINNINGS."""
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(BEGINNINGS))
    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    first = turns.filter((F.col("conv_id") % BLOCK == 0) & (F.col("depth") < BEGINNINGS)).withColumnRenamed("conv_id", "block")
    begun = ids.select("conv_id", block.alias("block"), taken.alias("h")).join(first, "block").filter("depth <= h")
    there = first.groupBy("block").agg(F.max("depth").alias("there"))
    own = turns.withColumn("h", taken).withColumn("block", block).filter("depth > h").join(there, "block", "left")
    place = F.col("depth") - F.col("h") + F.least("h", F.coalesce("there", F.lit(0)))
    return begun.select(*turns.columns).unionByName(own.withColumn("depth", place).select(*turns.columns))


def prefix_nodes(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (conv_id, depth, p1, p2, parent_conv_id, n_convs, chars) of the trie over ``turns``,
    and one row (conv_id, depth, p1, p2) per conversation with the node at which it ends.

    A node is named by its smallest member and its depth; p1 and p2 tell its prefix.  ``ids`` has all
    conversations, also those without turns, which end at the root (p1 = p2 = 0).
    """
    mixed = turns.select("conv_id", "depth", "chars", F.xxhash64("depth", "h1", "h2").alias("x1"),
                         F.xxhash64("h2", "depth", "h1").alias("x2"))
    upto = lambda x: F.col(x).bitwiseXOR(F.col(f"_cxor_{x}"))
    scanned = keyed_scan(mixed, ["conv_id"], ["depth"], lead_cols=["depth"], cumxor=["x1", "x2"]).select(
        "conv_id", "depth", "chars", upto("x1").alias("p1"), upto("x2").alias("p2"), F.col("_cxor_x1").alias("q1"),
        F.col("_cxor_x2").alias("q2"), F.col("_next_depth").isNull().alias("last"))
    nodes = checkpoint(scanned.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")))
    least, many = ids.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                         F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "p1", "p2", "parent_conv_id", "n_convs", "chars"]
    deeper = nodes.filter("depth > 1").join(above, ["depth", "q1", "q2"]).select(*columns)
    top = nodes.filter("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("bigint")).select(*columns)
    root = ids.sparkSession.createDataFrame([(least, 0, 0, 0, None, many, 0)] if many else [],
                                            ", ".join(f"{c} bigint" for c in columns))
    ends = scanned.filter("last").select("conv_id", "depth", "p1", "p2")
    none = ids.join(ends.select("conv_id"), "conv_id", "left_anti")
    zero = F.lit(0).cast("bigint")
    ends = ends.unionByName(none.select("conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2")))
    return root.unionByName(top).unionByName(deeper), ends


# --- digests of the conversations that end at a node --------------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows: the digest of each node whose rows all lie here and are few; else its ids in pieces.
    The first and the last node of a partition may go on in another one."""
    key, first, held, size, whole = None, None, [], 0, False
    done: list[tuple] = []

    def piece():
        done.append((*key, first, b",".join(held), None))

    def batch_of(rows):
        p1, p2, depth, least, ids, sha = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((p1, p2, depth, least, ids, sha), kinds, strict=True)],
                                          names=["p1", "p2", "depth", "first", "ids", "sha"])

    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("p1", "p2", "depth")]
        conv = batch.column("conv_id").to_numpy()
        new = np.ones(len(conv), bool)
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1])
        edges = np.append(np.flatnonzero(new), len(conv))
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = tuple(int(c[x]) for c in columns)
            if own != key:
                if key is not None:
                    if whole:
                        done.append((*key, first, None, hashlib.sha256(b",".join(held)).hexdigest()))
                    elif held:
                        piece()
                whole, key, first, held, size = key is not None, own, None, [], 0
            for at in range(x, y, PIECE // 16):
                ids = conv[at:min(y, at + PIECE // 16)]
                if first is None:
                    first = int(ids[0])
                held.append(b",".join(b"%d" % v for v in ids.tolist()))
                size += len(held[-1])
                if size >= PIECE:
                    piece()
                    first, held, size, whole = None, [], 0, False
                    yield batch_of(done)
                    done = []
            if len(done) >= 10_000:
                yield batch_of(done)
                done = []
    if held:
        piece()
    if done:
        yield batch_of(done)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node from its pieces in order, one piece in memory at a time."""
    key, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in key], pa.array([state.hexdigest()])],
                                          names=["p1", "p2", "depth", "sha"])

    for batch in batches:
        ids = batch.column("ids")
        for i, own in enumerate(zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "depth")), strict=True)):
            if own != key:
                if key is not None:
                    yield row()
                key, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids[i].as_buffer())
    if key is not None:
        yield row()


def end_digests(ends: DataFrame) -> DataFrame:
    """p1, p2, depth, sha of each node at which conversations end: SHA-256 of their ids, ascending,
    with commas between.  A node's ids may span many partitions: they are gathered there into pieces of
    up to a megabyte, so the one task that such a digest needs (it is sequential) streams bytes, not rows.
    """
    by = ["p1", "p2", "depth", "conv_id"]
    packed = checkpoint(ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(tidy(_pieces), _ENDS))
    spread = packed.filter("sha IS NULL").repartition("p1", "p2", "depth").sortWithinPartitions("p1", "p2", "depth", "first")
    joined = spread.select("p1", "p2", "depth", "ids").mapInArrow(tidy(_digests), "p1 bigint, p2 bigint, depth bigint, sha string")
    return packed.filter("sha IS NOT NULL").select("p1", "p2", "depth", "sha").unionByName(joined)


# --- tree contraction ---------------------------------------------------------------------

def _fold_chains(unary: DataFrame) -> DataFrame:
    """``unary`` (c, d, pc, pd, nc, nd, l, s; nc, nd its only child) with nc, nd the node below its chain
    and l, s summed over the chain from the node downwards."""
    inside = unary.select(F.col("c").alias("nc"), F.col("d").alias("nd"), F.lit(False).alias("end"))
    chain = checkpoint(unary.join(inside, ["nc", "nd"], "left").withColumn("end", F.coalesce("end", F.lit(True))).select(*unary.columns, "end"))
    while chain.filter("NOT end").head(1):
        below = chain.select(F.col("c").alias("nc"), F.col("d").alias("nd"), F.col("nc").alias("tc"), F.col("nd").alias("td"),
                             F.col("l").alias("l2"), F.col("s").alias("s2"), F.col("end").alias("end2"))
        doubled = chain.filter("NOT end").join(below, ["nc", "nd"]).select(
            "c", "d", "pc", "pd", F.col("tc").alias("nc"), F.col("td").alias("nd"), (F.col("l") + F.col("l2")).alias("l"),
            (F.col("s") + F.col("s2")).alias("s"), F.col("end2").alias("end"))
        chain = checkpoint(chain.filter("end").unionByName(doubled))
    return chain.drop("end")


def subtree_totals(tree: DataFrame, weight: Column) -> DataFrame:
    """conv_id, depth, n_children, n_leaves and total (of ``weight``) per node of ``tree``, a table of nodes
    (conv_id, depth) with their parent's conv_id one level up (null: the root).  Rake and compress."""
    kids = lambda a: a.filter("pc IS NOT NULL").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
        F.count(F.lit(1)).alias("m"), F.min("c").alias("nc"), F.min("d").alias("nd"))
    active = tree.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"),
                         (F.col("depth") - 1).alias("pd"), weight.cast("bigint").alias("s"))
    state = checkpoint(active.join(kids(active), ["c", "d"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
                       .withColumn("l", F.when(F.col("m") == 0, 1).otherwise(0).cast("bigint")))
    counts = state.select("c", "d", "m")
    known: list[DataFrame] = []
    folded: list[DataFrame] = []
    while True:
        unary = state.filter("m = 1 AND pc IS NOT NULL").select("c", "d", "pc", "pd", "nc", "nd", "l", "s")
        left = state.filter("m <> 1 OR pc IS NULL").select("c", "d", "pc", "pd", "l", "s", "m")
        gifts = []
        if unary.head(1):
            chain = _fold_chains(unary)
            folded.append(chain.select("c", "d", "nc", "nd", "l", "s"))
            tops = chain.join(chain.select(F.col("c").alias("pc"), F.col("d").alias("pd")), ["pc", "pd"], "left_anti")
            gifts.append(tops.select(F.col("pc").alias("c"), F.col("pd").alias("d"), "l", "s"))
            hung = tops.select(F.col("nc").alias("c"), F.col("nd").alias("d"), F.col("pc").alias("hc"), F.col("pd").alias("hd"))
            left = left.join(hung, ["c", "d"], "left").select("c", "d", F.coalesce("hc", "pc").alias("pc"), F.coalesce("hd", "pd").alias("pd"), "l", "s", "m")
        else:
            folded.append(None)
        left = checkpoint(left)
        leaf = (F.col("m") == 0) & F.col("pc").isNotNull()
        raked = left.filter(leaf)
        known.append(raked.select("c", "d", "l", "s"))
        gifts.append(raked.select(F.col("pc").alias("c"), F.col("pd").alias("d"), "l", "s"))
        given = gifts[0]
        for more in gifts[1:]:
            given = given.unionByName(more)
        given = given.groupBy("c", "d").agg(F.sum("l").alias("gl"), F.sum("s").alias("gs"))
        stays = left.filter(~leaf).drop("m").join(given, ["c", "d"], "left")
        zero = F.lit(0).cast("bigint")
        stays = checkpoint(stays.select("c", "d", "pc", "pd", (F.col("l") + F.coalesce("gl", zero)).alias("l"), (F.col("s") + F.coalesce("gs", zero)).alias("s")))
        if not stays.filter("pc IS NOT NULL").head(1):
            known.append(stays.select("c", "d", "l", "s"))
            break
        state = checkpoint(stays.join(kids(stays), ["c", "d"], "left").withColumn("m", F.coalesce("m", F.lit(0))))
    totals = known[-1]
    for ends, chain in zip(reversed(known[:-1]), reversed(folded), strict=True):
        totals = totals.unionByName(ends)
        if chain is not None:
            below = totals.select(F.col("c").alias("nc"), F.col("d").alias("nd"), F.col("l").alias("l2"), F.col("s").alias("s2"))
            again = chain.join(below, ["nc", "nd"]).select("c", "d", (F.col("l") + F.col("l2")).alias("l"), (F.col("s") + F.col("s2")).alias("s"))
            totals = checkpoint(totals.unionByName(again))
    return totals.join(counts, ["c", "d"]).select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("m").cast("bigint").alias("n_children"),
        F.col("l").alias("n_leaves"), F.col("s").alias("total"))


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie over ``turns`` (conv_id, depth, h1, h2, chars) of the conversations ``ids``: one row per
    node with parent, members, children, leaves of its subtree, the code points that sharing saves in
    it, and the digest of the conversations that end at it.  No conversation: no node."""
    nodes, ends = prefix_nodes(turns, ids)
    nodes = checkpoint(nodes)
    totals = subtree_totals(nodes, (F.col("n_convs") - 1) * F.col("chars"))
    sha = F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest()))
    return nodes.join(totals, ["conv_id", "depth"]).join(end_digests(ends), ["p1", "p2", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("total").alias("saved_tokens"),
        sha.alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text; others ignored) with shared beginnings.

    Null roles and texts are empty, null turns come first, ties go by role and text digest; repeated
    rows are separate turns.  Rows with a null conv_id are left out.  An empty table gives no rows.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    turns = checkpoint(numbered_turns(conversations))
    ids = turns.select("conv_id").distinct()
    if not turns.head(1):
        return spark.createDataFrame([], RESULT)
    ids = checkpoint(ids)
    return prefix_trie(shared_beginnings(turns, ids), ids)
