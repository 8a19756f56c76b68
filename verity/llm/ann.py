"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

1. Vectors gain one coordinate, ``sqrt(M^2 - |x|^2)`` (M: the largest norm), so that the largest
   inner product with a query is the nearest vector to it.
2. A bounded hash sample (``SAMPLE``) is halved again and again at the median of its direction of
   greatest spread, which gives cells of equal size; their means are the centroids, at most
   ``CENTROIDS``.
3. The centroids form an in-memory graph (near neighbours and some far ones), searched best first
   with a beam.  Every vector goes to its nearest centroid's posting list; one near a boundary is
   replicated to the other lists within ``REPLICATE`` times that distance, ``COPIES`` at most.
4. A query searches the graph and probes the lists within a ratio of the distance of the nearest
   centroid, as far as they are among its ``width`` nearest, and at least as many as hold ``LEAST`` times k
   rows.  Ratio and width are fitted on the sample: the least ones whose lists hold ``TARGET`` of the near
   neighbours of ``FIT_QUERIES`` sampled vectors each.  Of the k nearest of all rows the sample holds its
   share, so that many neighbours are looked at.  In clustered data the ratio prunes; in data without any
   structure distances hardly differ, and the width does.
5. Lists are split into parts of about ``PART`` rows by a hash of vec_id, so an overfull list spreads
   over tasks.  Each part returns a query's best by exact products in double precision; the k
   best of those are the result.
6. A query's nearest lists, about half the square root of their number, are scanned first.  The others return
   only rows that score at least the last of the best found there: no other row can be in the result.

Equal vectors tie, and ties go to the smaller vec_id: of the rows of one vector only the k + 1 smallest ids can
be in a result, so those stand for it in the lists, and equal query vectors are searched once.  A vector
that a third of all rows share thus costs as much as any other.

The centroids and their graph are the only thing broadcast: at most ``CENTROIDS`` vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verity.session import checkpoint

SAMPLE = 65_536
CENTROIDS = 4_096
ROWS_PER_LIST = 128
DEGREE, FAR_LINKS, BEAM, QUERY_BEAM = 24, 8, 32, 96
COPIES, REPLICATE = 4, 1.12
TARGET, FIT_QUERIES, LEAST = 0.975, 256, 2 * COPIES
PART = 4_096


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array<double>): not null, of the most common length, finite and not zero; one row an id."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")).filter("vec_id IS NOT NULL AND x IS NOT NULL")
    fine = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("x", lambda v: v != 0)
    rows = rows.filter(fine).withColumn("dim", F.size("x"))
    most = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    rows = rows.filter(F.col("dim") == (most["dim"] if most else 0))
    return rows.groupBy("vec_id").agg(F.min("x").alias("x"))


def balanced_centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Means of up to ``count`` cells of equal size, halved at the median of the widest direction."""
    rng = np.random.default_rng(5)
    cells = [sample]
    while len(cells) * 2 <= count and min(len(c) for c in cells) >= 4:
        halves = []
        for cell in cells:
            centred = cell - cell.mean(axis=0)
            direction = rng.normal(size=cell.shape[1])
            for _ in range(6):
                direction = centred.T @ (centred @ direction)
                direction /= np.linalg.norm(direction) + 1e-300
            order = np.argsort(centred @ direction, kind="stable")
            halves += [cell[order[: len(cell) // 2]], cell[order[len(cell) // 2 :]]]
        cells = halves
    return np.array([c.mean(axis=0) for c in cells])


class Graph:
    """Centroids with links to near ones and to some far ones; beam search for many points at once."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n, rng = len(points), np.random.default_rng(9)
        near = np.empty((n, min(DEGREE, max(n - 1, 1))), np.int64)
        norms = (points**2).sum(axis=1)
        for x in range(0, n, 512):
            d = norms[None, :] - 2 * points[x : x + 512] @ points.T
            d[np.arange(len(d)), np.arange(x, x + len(d))] = np.inf if n > 1 else 0
            near[x : x + 512] = np.argpartition(d, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
        self.links = np.concatenate([near, rng.integers(0, n, (n, FAR_LINKS))], axis=1)
        self.entry = rng.permutation(n)[: min(n, 16)]

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.maximum(((self.points[at] - x[:, None, :]) ** 2).sum(axis=2), 0)

    def search(self, x: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, distance) of the ``want`` nearest found for each row of ``x``, nearest first."""
        n, rows = len(self.points), np.arange(len(x))
        want = min(want, n)
        beam = min(max(BEAM, want), n)
        seen = np.zeros((len(x), n), bool)
        at = np.broadcast_to(self.entry, (len(x), len(self.entry))).copy()
        seen[rows[:, None], at] = True
        dist = self._distance(x, at)
        done = np.zeros(at.shape, bool)
        while True:
            open_dist = np.where(done, np.inf, dist)
            steps = min(4, open_dist.shape[1])
            picks = np.argsort(open_dist, axis=1, kind="stable")[:, :steps]
            live = np.isfinite(np.take_along_axis(open_dist, picks, axis=1))
            if not live.any():
                break
            np.put_along_axis(done, picks, True, axis=1)
            new = self.links[np.take_along_axis(at, picks, axis=1)].reshape(len(x), -1)
            fresh = ~seen[rows[:, None], new] & np.repeat(live, self.links.shape[1], axis=1)
            order = np.argsort(new, axis=1, kind="stable")
            ordered = np.take_along_axis(new, order, axis=1)
            twice = np.zeros_like(fresh)
            np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], axis=1)
            # Of a centroid named twice in a step the first counts, if it was to be looked at.
            first = np.where(twice, False, True)
            fresh &= first | ~seen[rows[:, None], new]
            seen[rows[:, None], new] |= fresh
            added = np.where(fresh & first, self._distance(x, new), np.inf)
            at, dist = np.concatenate([at, new], axis=1), np.concatenate([dist, added], axis=1)
            done = np.concatenate([done, ~(fresh & first)], axis=1)
            best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            at, dist, done = (np.take_along_axis(v, best, axis=1) for v in (at, dist, done))
        best = np.argsort(dist, axis=1, kind="stable")[:, :want]
        return np.take_along_axis(at, best, axis=1), np.sqrt(np.take_along_axis(dist, best, axis=1))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _assigned(batches: Iterator[pa.RecordBatch], graph: Graph, norm: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for y in range(0, batch.num_rows, 512):
            part = batch.slice(y, 512)
            x = _matrix(part.column("x"))
            lifted = np.concatenate([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)
            at, dist = graph.search(lifted, COPIES)
            row, place = np.nonzero(dist <= REPLICATE * dist[:, :1] + 1e-12)
            taken = part.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(at[row, place].astype(np.int32)), taken.column("vec_id"), taken.column("x")], names=["list", "vec_id", "x"])


def _as_query(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows as points of the lifted space: of the largest norm, with no last coordinate."""
    return np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True) * norm, np.zeros((len(x), 1))], axis=1)


def fitted_ratio(graph: Graph, x: np.ndarray, lifted: np.ndarray, count: int, k: int, norm: float) -> tuple[float, int]:
    """(ratio, width): the least distance ratio, and the least number of nearest lists, that hold ``TARGET`` of the near
    neighbours of sampled queries.  ``x``: the sample, in random order; ``count``: all rows."""
    queries = x[:FIT_QUERIES]
    wanted = min(max(1, round(k * len(x) / count)), max(len(x) - 1, 1))
    apart = _distances(_as_query(queries, norm), graph.points)
    ratios = apart / np.maximum(apart.min(axis=1, keepdims=True), 1e-300)
    needed, places = [], []
    for i, of in enumerate(ratios):
        score = x @ queries[i]
        score[i] = -np.inf
        at, dist = graph.search(lifted[np.argpartition(-score, wanted - 1)[:wanted]], COPIES)
        least = np.where(dist <= REPLICATE * dist[:, :1] + 1e-12, of[at], np.inf).min(axis=1)
        needed.append(least)
        places.append(np.searchsorted(np.sort(of), least, side="right"))
    ratio, width = (np.quantile(np.concatenate(v), TARGET, method="higher") for v in (needed, places))
    return float(ratio), int(width)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0))


def probed(graph: Graph, x: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``x``, list) of all lists to look at."""
    rows, lists, todo, width = [], [], np.arange(len(x)), max(graph.width + 1, QUERY_BEAM)
    points = _as_query(x, graph.scale)
    while len(todo):
        at, dist = graph.search(points[todo], width)
        held = np.cumsum(sizes[at], axis=1) - sizes[at]
        near = (dist <= graph.ratio * dist[:, :1] + 1e-12) & (np.arange(at.shape[1]) < graph.width)
        inside = near | (held < LEAST * k)
        whole = ~inside[:, -1] | (at.shape[1] == len(graph.points))
        row, place = np.nonzero(inside & whole[:, None])
        rows.append(todo[row])
        lists.append(at[row, place])
        todo, width = todo[~whole], 2 * width
    return np.concatenate(rows), np.concatenate(lists)


def _probes(batches: Iterator[pa.RecordBatch], graph: Graph, sizes: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The queries with their lists, nearest first."""
    for batch in batches:
        for y in range(0, batch.num_rows, 128):
            part = batch.slice(y, 128)
            row, at = probed(graph, _matrix(part.column("x")), sizes, k)
            at = at[np.argsort(row, kind="stable")].astype(np.int32)
            ends = np.cumsum(np.bincount(row, minlength=part.num_rows))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(at))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("x"), lists], names=["query_id", "x", "lists"])


def _scan(key, members: pa.Table, queries: pa.Table, best_of: int) -> pa.Table:
    """A query's best in one part of a list, of those that score its ``floor`` at least.  A matrix product
    narrows them down; the scores are products row by row, so equal vectors score equally."""
    names, kinds = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]
    out: list[list] = [[], [], []]
    if members.num_rows and queries.num_rows:
        ids = members.column("vec_id").to_numpy()
        x = np.ascontiguousarray(_matrix(members.column("x").combine_chunks()))
        q = _matrix(queries.column("x").combine_chunks())
        query_ids = queries.column("query_id").to_numpy()
        slack = 1e-9 * np.linalg.norm(x, axis=1).max() * np.linalg.norm(q, axis=1)
        floor = queries.column("floor").to_numpy() - slack
        for lo in range(0, len(q), 256):
            rough = q[lo : lo + 256] @ x.T
            for i in np.flatnonzero(rough.max(axis=1) >= floor[lo : lo + 256]):
                row, vector = rough[i], q[lo + i]
                near = np.flatnonzero(row >= floor[lo + i])
                if len(near) > best_of:
                    near = np.flatnonzero(row >= max(np.partition(row, -best_of)[-best_of] - slack[lo + i], floor[lo + i]))
                score = (x[near] * vector).sum(axis=1)
                best = np.lexsort((ids[near], -score))[:best_of]
                out[0].append(np.full(len(best), query_ids[lo + i]))
                out[1].append(ids[near][best])
                out[2].append(score[best])
    return pa.table({n: pa.array(np.concatenate(v) if v else [], t) for n, v, t in zip(names, out, kinds, strict=True)})


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which ``is_query`` holds.

    ``vectors`` has vec_id and embedding; others are ignored.  Null, zero and non-finite vectors,
    null ids and vectors of another length than most take no part.  Rows that repeat a vec_id count
    as one (its least vector); ties go to the smaller vec_id.  The lists of a query hold k others at
    least, or all rows, so a query has all candidates if there are fewer than k.  An empty table gives none.
    """
    spark = vectors.sparkSession
    rows = checkpoint(usable(vectors))
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    count, largest = rows.agg(F.count(F.lit(1)), F.max(F.sqrt(square))).first()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not count:
        return spark.createDataFrame([], empty)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").toArrow()
    x = _matrix(sample.column("x").combine_chunks())
    lifted = np.concatenate([x, np.sqrt(np.maximum(largest**2 - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)
    graph = Graph(balanced_centroids(lifted, min(CENTROIDS, max(1, count // ROWS_PER_LIST), max(1, len(x) // 16))))
    graph.scale = largest
    kinds = np.sort(np.unique(x, axis=0, return_index=True)[1])
    graph.ratio, graph.width = fitted_ratio(graph, x[kinds], lifted[kinds], count, k, largest)
    shared = spark.sparkContext.broadcast(graph)

    place = Window.partitionBy("x").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1).select("vec_id", "x")
    lists = checkpoint(few.mapInArrow(lambda b: _assigned(b, shared.value, largest), "list int, vec_id bigint, x array<double>"))
    sizes = np.zeros(len(graph.points), np.int64)
    for r in lists.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    parts = np.maximum(1, -(-sizes // PART))
    shared_sizes = spark.sparkContext.broadcast(sizes)
    per_list = spark.createDataFrame([(i, int(p)) for i, p in enumerate(parts)], "list int, parts int")
    members = lists.join(F.broadcast(per_list), "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    asked = rows.filter(is_query)
    first = asked.groupBy("x").agg(F.min("vec_id").alias("vec_id"))
    queries = checkpoint(first.mapInArrow(lambda b: _probes(b, shared.value, shared_sizes.value, k), "query_id bigint, x array<double>, lists array<int>"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def scanned(queries: DataFrame, lists) -> DataFrame:
        """query_id, vec_id, score: the best of each part of these lists that score the query's floor at least."""
        probes = queries.select(F.explode(lists).alias("list"), "query_id", "x", "floor").join(F.broadcast(per_list), "list")
        probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return members.select("list", "part", "vec_id", "x").groupBy("list", "part").cogroup(
            probes.select("list", "part", "query_id", "x", "floor").groupBy("list", "part")
        ).applyInArrow(lambda key, a, b: _scan(key, a, b, k + 1), "query_id bigint, vec_id bigint, score double")

    def leading(found: DataFrame) -> DataFrame:
        one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return one.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)

    early = F.ceil(F.sqrt(F.size("lists")) / 2).cast("int")
    start = checkpoint(leading(scanned(queries.withColumn("floor", F.lit(float("-inf"))), F.slice("lists", F.lit(1), early))))
    last = start.filter(F.col("place") == k + 1).select("query_id", F.col("score").alias("floor"))
    floors = queries.join(last, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    rest = scanned(floors, F.slice("lists", early + 1, F.size("lists")))
    top = leading(start.drop("place").unionByName(rest)).select("query_id", "vec_id", "score")
    # Every query row has the results of its vector but for itself.
    same = asked.join(queries.select("x", F.col("query_id").alias("first_id")), "x").select(F.col("vec_id").alias("query_id"), "first_id")
    return (
        same.join(top.withColumnRenamed("query_id", "first_id"), "first_id").filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
