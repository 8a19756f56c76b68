"""Reuse of stored answers: lookup join, misses, routing, time-to-live and recency.

* ``reuse_lookup`` / ``reuse_misses`` are one set join instead of a point
  lookup per message: inner / anti join of the requests with the usable
  stored answers (non-empty answer), pruned to the needed columns.  The join
  strategy is left to AQE (broadcast when the stored side is small at run
  time, otherwise sort-merge with skew-join splitting for hot question ids).
* ``ttl_anchors`` decides, per key, which requests refresh the entry (misses)
  under a time-to-live: the first request stores at t0, later ones within
  ``ttl`` are hits, the first one after ``t0 + ttl`` is a miss and restarts.
  Gaps longer than the ttl cut a key into independent segments; the chain
  inside a segment that outlasts the ttl is enumerated by pointer doubling,
  so no task ever holds a whole key.
* ``reuse_distance`` counts, for each repeat request, the distinct other keys
  requested since the previous request of the same key (LRU stack distance),
  as an exact 2D dominance count over blocks of positions; an LRU cache
  of capacity C hits exactly when the distance is below C.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verity.operators.sequence import keyed_scan
from verity.session import checkpoint

# Answer-cache defaults (policy LRU, 1024 entries, 3600 s).
CACHE_SIZE = 1024
CACHE_TTL_SECONDS = 3600
SOURCE_STORAGE = "storage"
SOURCE_CACHE = "cache"
ROUTE_LLM = "llm"
# Blocks of positions: of 2^BLOCK_BITS rows, or more so that there are at most 2^MOST_BLOCKS_BITS.
BLOCK_BITS = 16
MOST_BLOCKS_BITS = 10


def usable_answers(store: DataFrame, answer: str = "respuesta_llm") -> DataFrame:
    """Stored results whose answer is non-empty (an empty or NULL answer is a miss)."""
    return store.filter(F.coalesce(F.length(F.col(answer)), F.lit(0)) > 0)


def first_stored(store: DataFrame, key: str = "id_pregunta") -> DataFrame:
    """One row per key of a store that may repeat keys: the newest, else the least answer."""
    order = [F.try_to_timestamp(F.col("ultima_actualizacion")).desc_nulls_last()] \
        if "ultima_actualizacion" in store.columns else []
    w = Window.partitionBy(key).orderBy(*order, "respuesta_llm")
    return store.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def hit_projection(joined: DataFrame, source: Column | str = SOURCE_STORAGE,
                   decided_at: Column | str = "created_at") -> DataFrame:
    """Request + stored result -> validated record.  Stored values always win
    (absent text -> "", score -> 0.0, accepted -> false); attempts come from
    the request.  ``decided_at``: a column for replayable batch runs; streams
    pass the time of the decision."""
    src = F.lit(source) if isinstance(source, str) else source
    return joined.select(
        "message_id", "trace_id", "question_id",
        F.coalesce(F.col("pregunta"), F.lit("")).alias("title"),
        F.coalesce(F.col("contenido"), F.lit("")).alias("content"),
        F.coalesce(F.col("respuesta_llm"), F.lit("")).alias("llm_answer"),
        F.coalesce(F.col("respuesta_dataset"), F.lit("")).alias("best_answer"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("aceptado").cast("boolean"), F.lit(False)).alias("accepted"),
        src.alias("source"),
        F.col("attempts").cast("int").alias("attempts"),
        (F.col(decided_at) if isinstance(decided_at, str) else decided_at).alias("decided_at"),
    )


_STORE_COLS = ["id_pregunta", "pregunta", "contenido", "respuesta_dataset", "respuesta_llm",
               "score", "aceptado"]


def reuse_lookup(requests: DataFrame, store: DataFrame, source: str = SOURCE_STORAGE,
                 decided_at: Column | str = "created_at") -> DataFrame:
    """Requests that find a usable stored answer, as validated records.

    A store that repeats a question id gives its first match only (``first_stored``)."""
    extra = [c for c in ("ultima_actualizacion",) if c in store.columns]
    s = first_stored(usable_answers(store.select(*_STORE_COLS, *extra))).drop(*extra)
    joined = requests.join(s.withColumnRenamed("id_pregunta", "question_id"), "question_id", "inner")
    return hit_projection(joined, source, decided_at)


def reuse_misses(requests: DataFrame, store: DataFrame) -> DataFrame:
    """Requests with no usable stored answer (they go to the generator)."""
    keys = usable_answers(store.select("id_pregunta", "respuesta_llm")).select(
        F.col("id_pregunta").alias("question_id"))
    return requests.join(keys, "question_id", "left_anti")


# --- time-to-live ---------------------------------------------------------------

def _dense_chain(rows: DataFrame, width_us: int) -> DataFrame:
    """(k, pos) of the refreshing rows after the first in segments longer than the ttl.

    ``rows``: k, seg, pos, us, size, where a segment's rows have consecutive
    positions from ``seg`` on.  A row's successor is the first of its segment
    later than ``us + ttl``; its place is the number of rows up to then, a
    running count over rows and probes.  The chain from the segment's first
    row is enumerated by pointer doubling on positions.
    """
    rows = rows.withColumn("w", F.lit(1))
    targets = rows.select("k", "seg", F.col("us").alias("x"), F.lit(0).alias("kind"), "pos", "size", "w")
    probes = rows.select("k", "seg", (F.col("us") + F.lit(width_us)).alias("x"), F.lit(1).alias("kind"), "pos", "size",
                         F.lit(0).alias("w"))
    counted = keyed_scan(targets.unionByName(probes), ["k", "seg"], ["x", "kind", "pos"], prefix="_s_", cumsum="w")
    jump = checkpoint(counted.filter((F.col("kind") == 1) & (F.col("_s_csum") < F.col("size")))
                      .select("k", "pos", (F.col("seg") + F.col("_s_csum")).alias("nxt")))
    reached = checkpoint(rows.filter("pos = seg").select("k", "pos"))
    while jump.head(1):
        step = reached.join(jump, ["k", "pos"]).select("k", F.col("nxt").alias("pos"))
        reached = checkpoint(reached.unionByName(step).distinct())
        onward = jump.select("k", F.col("pos").alias("nxt"), F.col("nxt").alias("_to"))
        jump = checkpoint(jump.join(onward, ["k", "nxt"]).select("k", "pos", F.col("_to").alias("nxt")))
    return reached


def anchor_ids(df: DataFrame, key: str, ts: str, tiebreak: str, id_col: str,
               ttl_seconds: float = CACHE_TTL_SECONDS) -> DataFrame:
    """Ids (column ``id``) of the requests that (re)store the entry.

    ``id_col`` must be unique per row; order within a key is (ts, tiebreak).
    ``ttl_seconds <= 0`` never expires: only each key's first request refreshes.

    A request later than the ttl after the previous one of its key refreshes
    whatever came before, so gaps cut a key into segments, each led by an
    anchor.  Only segments that last longer than the ttl hold further ones;
    their rows alone go through the pointer doubling, whose rounds grow with the
    logarithm of a segment's refreshes.  A NULL time refreshes and leads
    nothing; a NULL key is a key.
    """
    name = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    rows = df.select(name.alias("k"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"),
                     F.col(tiebreak).alias("tb"), F.col(id_col).alias("id"))
    if ttl_seconds <= 0:
        return rows.groupBy("k").agg(F.min_by("id", F.struct("us", "tb")).alias("id")).select("id")
    width = int(round(ttl_seconds * 1_000_000))
    cut = keyed_scan(rows, ["k"], ["us", "tb"], gap=("us", width)).select(
        "k", "us", "id", F.col("_pos").alias("pos"), F.col("_leads").alias("leads"), F.col("_seg").alias("seg"))
    spans = cut.groupBy("k", "seg").agg((F.max("us") - F.min("us")).alias("span"), F.count(F.lit(1)).alias("size"))
    dense = checkpoint(cut.join(spans.filter(F.col("span") > width).select("k", "seg", "size"), ["k", "seg"]))
    anchors = cut.filter("leads").select("id")
    if not dense.head(1):
        return anchors
    chain = _dense_chain(dense.select("k", "seg", "pos", "us", "size"), width)
    return anchors.unionByName(dense.filter("NOT leads").join(chain, ["k", "pos"]).select("id"))


def ttl_anchors(df: DataFrame, key: str, ts: str, tiebreak: str, id_col: str,
                ttl_seconds: float = CACHE_TTL_SECONDS) -> DataFrame:
    """``df`` plus ``refresh``: true for requests that (re)store the entry."""
    flagged = anchor_ids(df, key, ts, tiebreak, id_col, ttl_seconds) \
        .select(F.col("id").alias(id_col), F.lit(True).alias("refresh"))
    return df.join(flagged, id_col, "left").withColumn("refresh", F.coalesce("refresh", F.lit(False)))


def ttl_hits(requests: DataFrame, ttl_seconds: float = CACHE_TTL_SECONDS, key: str = "question_id",
             ts: str = "ts", tiebreak: str = "event_id", id_col: str = "message_id") -> DataFrame:
    """Per request: ``hit`` = served from the entry stored by an earlier request."""
    a = ttl_anchors(requests, key, ts, tiebreak, id_col, ttl_seconds)
    return a.withColumn("hit", ~F.col("refresh")).drop("refresh")


def route_requests(requests: DataFrame, store: DataFrame, ttl_seconds: float = CACHE_TTL_SECONDS,
                   key: str = "question_id", ts: str = "ts", tiebreak: str = "event_id",
                   id_col: str = "message_id") -> DataFrame:
    """Three-way route: ``storage`` (store hit that (re)fills the cache),
    ``cache`` (served by the cached entry within ttl), ``llm`` (no usable answer)."""
    keys = usable_answers(store.select("id_pregunta", "respuesta_llm")).select(
        F.col("id_pregunta").alias(key), F.lit(True).alias("_stored")).distinct()
    marked = requests.join(keys, key, "left")
    stored = marked.filter(F.col("_stored").isNotNull())
    flagged = anchor_ids(stored.select(key, ts, tiebreak, id_col), key, ts, tiebreak, id_col, ttl_seconds) \
        .select(F.col("id").alias(id_col), F.lit(True).alias("refresh"))
    out = marked.join(flagged, id_col, "left")
    route = F.when(F.col("_stored").isNull(), F.lit(ROUTE_LLM)) \
        .when(F.col("refresh"), F.lit(SOURCE_STORAGE)).otherwise(F.lit(SOURCE_CACHE))
    return out.withColumn("route", route).drop("_stored", "refresh")


def hit_rate(routed: DataFrame) -> DataFrame:
    """Hit / miss totals and hit rate of a routed request set."""
    hit = F.col("route") != ROUTE_LLM
    return routed.agg(
        F.count_if(F.col("route") == SOURCE_CACHE).alias("cache_hits"),
        F.count_if(F.col("route") == SOURCE_STORAGE).alias("storage_hits"),
        F.count_if(~hit).alias("misses"),
        F.avg(hit.cast("double")).alias("hit_rate"),
    )


# --- recency (LRU stack distance) ---------------------------------------------------

def _dominated(x: np.ndarray, y: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Per point (x, y; x distinct): the number of points with x' > x and y' < below.

    The points in order of y that lie below form a prefix; it is split into
    dyadic blocks, and each level's blocks are sorted by x and searched at once.
    """
    n = len(x)
    order = np.argsort(y)
    rank = np.empty(n, np.int64)
    rank[np.argsort(x)] = np.arange(n)
    upto = np.searchsorted(y[order], below)
    out = np.zeros(n, np.int64)
    for level in range(n.bit_length()):
        odd = np.flatnonzero((upto >> level) & 1)
        if len(odd):
            block = (upto[odd] >> level) - 1
            tree = np.sort((np.arange(n) >> level) * n + rank[order])
            out[odd] += ((block + 1) << level) - np.searchsorted(tree, block * n + rank[odd], "right")
    return out


def _blockwise(shift: int, beyond=None) -> Callable[[pa.Table], pa.Table]:
    """Counts of the repeats of one block, of b (with the whole blocks' counts ``beyond``) or of a."""
    def run(rows: pa.Table) -> pa.Table:
        x, y = rows.column("x").to_numpy(), rows.column("y").to_numpy()
        if beyond is None:
            count = _dominated(x, y, (y >> shift) << shift)
        else:
            count = _dominated(x, y, y) + beyond.value[x >> shift, y >> shift]
        return pa.table({"_qpos": pa.array(y, pa.int64()), "_n": pa.array(count, pa.int64())})

    return run


def reuse_distance(requests: DataFrame, key: str = "question_id", ts: str = "ts",
                   tiebreak: str = "event_id", id_col: str = "message_id") -> DataFrame:
    """Per request: ``reuse_distance`` = distinct other keys requested since the
    previous request of this key (-1 for a key's first request).

    With global arrival positions (a range-partitioned scan, no single-partition
    window), a repeat request at position b whose key was last requested at
    a has distance (b - a - 1) - #{repeat requests m : prev(m) > a, m < b}:
    every position of the gap counts once, except those whose key recurs
    inside the gap.  That count is a 2D dominance count, done exactly by
    blocks of positions.  The m counted lie in b's block (counted within it);
    or in an earlier block with prev(m) in a's block (counted within that), or
    with prev(m) in a block behind a's: these are sums over whole blocks, told by
    a table of the repeats per pair of blocks, at most 2^20 numbers.  Positions
    are distinct, so blocks are of equal size and each repeat is shuffled twice, whatever
    the keys; within a block O(n log^2 n) work in numpy, and no pair is enumerated.
    """
    order = [ts, tiebreak]
    g = keyed_scan(requests, [], order).withColumnRenamed("_pos", "_gpos")
    pos = checkpoint(keyed_scan(g, [key], ["_gpos"], lag_cols=["_gpos"]).drop("_pos"))
    n = int(pos.agg(F.max("_gpos")).first()[0] or 0)
    shift = max(BLOCK_BITS, n.bit_length() - MOST_BLOCKS_BITS)
    rep = pos.filter(F.col("_prev__gpos").isNotNull()).select(
        F.col("_prev__gpos").alias("x"), F.col("_gpos").alias("y"),
        F.shiftright("_prev__gpos", shift).alias("xb"), F.shiftright("_gpos", shift).alias("yb"))

    cells = rep.groupBy("xb", "yb").agg(F.count(F.lit(1)).alias("n")).toArrow()
    blocks = (n >> shift) + 1
    beyond = np.zeros((blocks + 1, blocks + 1), np.int64)  # [i, j]: repeats with xb >= i and yb < j
    beyond[cells.column("xb").to_numpy(), cells.column("yb").to_numpy() + 1] = cells.column("n").to_numpy()
    beyond = beyond[::-1].cumsum(axis=0)[::-1].cumsum(axis=1)
    beyond = requests.sparkSession.sparkContext.broadcast(beyond[1:])  # xb > i

    schema = "_qpos bigint, _n bigint"
    within_b = rep.select("x", "y", "yb").groupBy("yb").applyInArrow(_blockwise(shift, beyond), schema)
    within_a = rep.select("x", "y", "xb").groupBy("xb").applyInArrow(_blockwise(shift), schema)
    nested = within_b.unionByName(within_a).groupBy("_qpos").agg(F.sum("_n").alias("_n"))
    out = pos.join(nested, pos["_gpos"] == nested["_qpos"], "left")
    dist = F.when(F.col("_prev__gpos").isNull(), F.lit(-1)) \
        .otherwise(F.col("_gpos") - F.col("_prev__gpos") - 1 - F.coalesce(F.col("_n"), F.lit(0)))
    return out.withColumn("reuse_distance", dist.cast("long")) \
        .drop("_qpos", "_n", "_gpos", "_prev__gpos")


def lru_hits(with_distance: DataFrame, capacity: int = CACHE_SIZE) -> Column:
    """An LRU cache of ``capacity`` entries serves a repeat request whose
    reuse distance is below the capacity."""
    d = with_distance["reuse_distance"]
    return (d >= 0) & (d < F.lit(capacity))
