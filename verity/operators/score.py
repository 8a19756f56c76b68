"""Pairwise TF-IDF cosine scoring of (expected, actual) answers.

The vectorizer of the reference is fitted on the two texts of a pair only, so
the IDF has a closed form: 1 for a term in both texts, ln(1.5) + 1 for a term
in one.  No corpus model is needed.

``score_pairs`` / ``evaluate_pairs`` (the table operators) tokenise natively,
count each row's terms and fold them to the three sums of the cosine in Arrow
batches (``pair_norms``).  A pair lies in its row, so nothing is shuffled or
joined, a message may have several answers, and a task holds the tokens of a
few hundred rows at a time, however large its share of the input is.

``term_frequencies`` counts over all rows of a key: texts are hash-partitioned
and sorted on the key, then counted in the same way, the last key's counts
being carried from one slice of rows to the next.

``pair_score`` is the same score as a single native Column (row-local fold with
higher-order functions), for streams and places without Python workers; it is
slower per token since lambdas are interpreted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from verity.functions.text import SHARED_IDF, UNSHARED_IDF, tokenize
from verity.operators.sequence import _starts
from verity.session import ship_package

# Default acceptance thresholds.
STREAM_THRESHOLD = 0.65      # compose configuration of the streaming scorer
SERVICE_THRESHOLD = 0.5      # request/response score service default
SCORE_DIGITS = 4             # the score service rounds to 4 decimals
#: Rows and tokens (beyond one row) that are counted at a time.
SLICE_ROWS = 512
SLICE_TOKENS = 1 << 18


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _tagged(tokens: Column, side: int) -> Column:
    return F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(side).alias("s")))


def _weight(own: Column, other: Column) -> Column:
    return own.cast("double") * F.when((own > 0) & (other > 0), F.lit(SHARED_IDF)) \
        .otherwise(F.lit(UNSHARED_IDF))


def _flush(acc: Column) -> dict[str, Column]:
    wa = _weight(acc["ca"], acc["cb"])
    wb = _weight(acc["cb"], acc["ca"])
    return {"dot": acc["dot"] + wa * wb, "na": acc["na"] + wa * wa, "nb": acc["nb"] + wb * wb}


def pair_score(expected: Column | str, actual: Column | str) -> Column:
    """Cosine of the pair's TF-IDF vectors, clamped to [0, 1].

    0.0 when either text is empty/NULL or has no token (where the reference's
    vectorizer would raise on an empty vocabulary).
    """
    e, a = _c(expected), _c(actual)
    merged = F.array_sort(F.concat(_tagged(tokenize(e), 0), _tagged(tokenize(a), 1)))
    zero = F.lit(0.0)
    init = F.struct(
        F.lit(None).cast("string").alias("prev"), F.lit(0).alias("ca"), F.lit(0).alias("cb"),
        zero.alias("dot"), zero.alias("na"), zero.alias("nb"),
    )

    def step(acc: Column, x: Column) -> Column:
        same = F.coalesce(acc["prev"] == x["t"], F.lit(False))
        f = _flush(acc)
        is_a = (x["s"] == 0).cast("int")
        is_b = (x["s"] == 1).cast("int")
        return F.struct(
            x["t"].alias("prev"),
            F.when(same, acc["ca"] + is_a).otherwise(is_a).alias("ca"),
            F.when(same, acc["cb"] + is_b).otherwise(is_b).alias("cb"),
            F.when(same, acc["dot"]).otherwise(f["dot"]).alias("dot"),
            F.when(same, acc["na"]).otherwise(f["na"]).alias("na"),
            F.when(same, acc["nb"]).otherwise(f["nb"]).alias("nb"),
        )

    def finish(acc: Column) -> Column:
        f = _flush(acc)
        cos = f["dot"] / (F.sqrt(f["na"]) * F.sqrt(f["nb"]))
        return F.when((f["na"] > 0) & (f["nb"] > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), cos))) \
            .otherwise(F.lit(0.0))

    score = F.aggregate(merged, init, step, finish)
    empty = F.coalesce(F.length(e), F.lit(0)).__eq__(0) | F.coalesce(F.length(a), F.lit(0)).__eq__(0)
    return F.when(empty, F.lit(0.0)).otherwise(score)


def _slices(expected: pa.Array, actual: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, number) of consecutive slices of at most SLICE_ROWS rows and SLICE_TOKENS tokens, or one row."""
    size = lambda tokens: np.asarray(pc.fill_null(pc.list_value_length(tokens), 0))
    upto = np.cumsum(size(expected).astype(np.int64) + size(actual))
    at = 0
    while at < len(upto):
        before = upto[at - 1] if at else 0
        end = min(int(np.searchsorted(upto, before + SLICE_TOKENS, "right")), at + SLICE_ROWS)
        end = max(end, at + 1)
        yield at, end - at
        at = end


def _counted(group: np.ndarray, terms: pa.Array, ca: np.ndarray, cb: np.ndarray):
    """(group, term, ca, cb) arrays, one entry per group and term, by group: the counts summed."""
    named = terms.dictionary_encode()
    code = group.astype(np.int64) * max(len(named.dictionary), 1) + np.asarray(named.indices, np.int64)
    distinct, of = np.unique(code, return_inverse=True)
    total = lambda c: np.bincount(of, c, len(distinct)).astype(np.int64)
    group, term = np.divmod(distinct, max(len(named.dictionary), 1))
    return group, named.dictionary.take(pa.array(term)), total(ca), total(cb)


def _tokens(expected: pa.Array, actual: pa.Array):
    """(row, term, ca, cb) arrays, one entry per token of the two columns of token arrays."""
    sides = [(np.asarray(pc.list_parent_indices(c)), c.flatten()) for c in (expected, actual)]
    row = np.concatenate([r for r, _ in sides]).astype(np.int64)
    side = np.repeat([0, 1], [len(r) for r, _ in sides])
    return row, pa.concat_arrays([t for _, t in sides]), 1 - side, side


def _norms(expected: pa.Array, actual: pa.Array) -> pa.Array:
    parts = []
    for at, n in _slices(expected, actual):
        row, _, ca, cb = _counted(*_tokens(expected.slice(at, n), actual.slice(at, n)))
        idf = np.where((ca > 0) & (cb > 0), SHARED_IDF, UNSHARED_IDF)
        wa, wb = ca * idf, cb * idf
        parts.append(np.stack([np.bincount(row, w, n) for w in (wa * wb, wa * wa, wb * wb)]))
    sums = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0))
    return pa.StructArray.from_arrays([pa.array(x) for x in sums], names=["dot", "na2", "nb2"])


def pair_norms(expected: Column | str, actual: Column | str) -> Column:
    """Struct (dot, na2, nb2): the sums of products and squares of a row's pair TF-IDF vectors.

    Tokens are found natively; each slice of rows is counted per (row, term)
    and folded per row in Arrow batches.  All are 0 without a token.
    """
    norms = F.arrow_udf(_norms, "dot double, na2 double, nb2 double")
    return norms(tokenize(expected), tokenize(actual))


def _cosine(norms: Column) -> Column:
    """Cosine from a pair's sums; 0 when a side has no token (an empty or
    NULL text has none), where the reference's vectorizer would not fit."""
    cos = norms["dot"] / (F.sqrt(norms["na2"]) * F.sqrt(norms["nb2"]))
    ok = (norms["na2"] > 0) & (norms["nb2"] > 0)
    return F.when(ok, F.least(F.lit(1.0), F.greatest(F.lit(0.0), cos))).otherwise(F.lit(0.0))


def _scored(df: DataFrame, key: str | Sequence[str], expected: str, actual: str) -> DataFrame:
    """Input rows plus ``_raw`` score, row by row: no exchange.  Rows with a
    NULL key column are kept with a NULL score."""
    ship_package(df.sparkSession)
    known = F.lit(True)
    for k in [key] if isinstance(key, str) else key:
        known = known & F.col(k).isNotNull()
    normed = df.withColumn("_norms", pair_norms(expected, actual))
    raw = F.when(~known, F.lit(None).cast("double")).otherwise(_cosine(F.col("_norms")))
    return normed.select(*df.columns, raw.alias("_raw"))


def score_pairs(df: DataFrame, key: str | Sequence[str] = "message_id", expected: str = "best_answer",
                actual: str = "llm_answer", out: str = "score", digits: int | None = 6) -> DataFrame:
    """Add the pair score (rounded to ``digits`` when given).  ``key`` may name one column or
    several, and need not be unique: a message may have several answers."""
    s = _scored(df, key, expected, actual)
    val = F.round(F.col("_raw"), digits) if digits is not None else F.col("_raw")
    return s.withColumn(out, val).drop("_raw")


def evaluate_pairs(df: DataFrame, threshold: float = SERVICE_THRESHOLD, key: str | Sequence[str] = "message_id",
                   expected: str = "best_answer", actual: str = "llm_answer") -> DataFrame:
    """Score service as a table job: accepted on the unrounded score, score to 4 dp."""
    s = _scored(df, key, expected, actual)
    return s.withColumn("score", F.round(F.col("_raw"), SCORE_DIGITS)) \
        .withColumn("accepted", F.col("_raw") >= F.lit(threshold)).drop("_raw")


def _counter(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts per (key, term) of rows (key, _ta, _tb) that come sorted by key."""
    def batch(keys, terms, ca, cb):
        columns = (keys, terms, pa.array(ca), pa.array(cb))
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches):
        last, held = None, None  # the key of the row before; its counts so far
        for rows in batches:
            keys, expected, actual = rows.filter(pc.and_(rows.column("_ta").is_valid(), rows.column("_tb").is_valid())).columns
            for at, n in _slices(expected, actual):
                own = keys.slice(at, n)
                new = _starts([own], last)
                if new[0] and held is not None:
                    yield batch(*held)
                    held = None
                group = np.cumsum(new) - int(new[0])
                row, terms, ca, cb = _tokens(expected.slice(at, n), actual.slice(at, n))
                row = group[row]
                if held is not None:
                    _, t, a, b = held
                    row, terms = np.concatenate((np.zeros(len(t), np.int64), row)), pa.concat_arrays([t, terms])
                    ca, cb = np.concatenate((a, ca)), np.concatenate((b, cb))
                row, terms, ca, cb = _counted(row, terms, ca, cb)
                first = np.flatnonzero(np.diff(group, prepend=-1))  # a row of each group
                named = own.take(pa.array(first[row]))
                done = int(np.searchsorted(row, group[-1]))  # the last key may go on
                if done:
                    yield batch(named[:done], terms[:done], ca[:done], cb[:done])
                held = (named[done:], terms[done:], ca[done:], cb[done:])
                last = [own[n - 1].as_py()]
        if held is not None:
            yield batch(*held)

    return run


def term_frequencies(df: DataFrame, key: str = "message_id", expected: str = "best_answer",
                     actual: str = "llm_answer") -> DataFrame:
    """Raw term counts of both texts of each pair: (key, term, tf_expected, tf_actual).

    The input is hash-partitioned and sorted on the key once; a task then
    counts slice by slice, so it holds the tokens of one slice and the terms
    of one key.  No token is shuffled.  A row with a NULL text adds nothing.
    """
    ship_package(df.sparkSession)
    rows = df.select(key, expected, actual).repartition(key).sortWithinPartitions(key)
    tokens = rows.select(key, tokenize(expected).alias("_ta"), tokenize(actual).alias("_tb"))
    schema = T.StructType([df.select(key).schema[0], T.StructField("term", T.StringType()),
                           T.StructField("tf_expected", T.LongType()), T.StructField("tf_actual", T.LongType())])
    return tokens.mapInArrow(_counter(to_arrow_schema(schema)), schema)


def pair_tfidf(tf: DataFrame) -> DataFrame:
    """TF-IDF weights of a term-frequency table (pair-local smoothed IDF)."""
    idf = F.when((F.col("tf_expected") > 0) & (F.col("tf_actual") > 0), F.lit(SHARED_IDF)) \
        .otherwise(F.lit(UNSHARED_IDF))
    return tf.withColumn("idf", idf) \
        .withColumn("w_expected", F.col("tf_expected") * F.col("idf")) \
        .withColumn("w_actual", F.col("tf_actual") * F.col("idf"))
