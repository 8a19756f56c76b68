"""URL filters: longest matching host/path rule, else gradient-boosted trees on lexical features.

The trees (pyspark.ml) learn from labelled URLs: those whose host names an advert, tracker, spam or
betting service (``LISTED``, a stand-in for a public blocklist) are blocked; all others, of every suffix,
are allowed unless a rule blocks them.  At most ``TRAIN_ROWS`` of each are used, the smallest by hash.
Features come from the URL alone and from statistics of its suffix (the host's last two labels) over all
rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.session import checkpoint

#: (verdict, host, path); a rule fits its host and all subdomains, from its path on.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LISTED = r"(^|[.-])(ads?|adserver|banners?|track(er|ing)?|spam|casino|bets?|poker|lottery|xxx)([.-]|$)"
#: Bound of the labelled URLs of either kind that the trees learn from.
TRAIN_ROWS = 10_000
ROUNDS, DEPTH = 10, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "labels", "hyphens", "depth", "digit_ratio", "host_entropy", "path_entropy", "parameters", "suffix_urls", "suffix_length"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for a null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, written host and path together, and its verdict; else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, own + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _count(text: Column, kept: str) -> Column:
    """How many characters of ``text`` are in the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]", "")).cast("double")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text."""
    n = F.length(text).cast("double")
    parts = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c == "", 0.0).otherwise((n - F.length(F.replace(text, c, F.lit("")))) / n))
    bits = F.aggregate(parts, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def _lexical(parts: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    frame = parts.select(
        "page_id", "host", "path", "rule", "ruled",
        F.length(url).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.size(labels).cast("double").alias("labels"), _count(F.col("host"), "-").alias("hyphens"), _count(F.col("path"), "/").alias("depth"),
        (_count(url, "0-9") / n).alias("digit_ratio"), _entropy(F.col("host")).alias("host_entropy"), _entropy(F.col("path")).alias("path_entropy"),
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1).alias("parameters"),
        F.substring_index("host", ".", -2).alias("suffix"),
    )
    suffixes = frame.groupBy("suffix").agg(
        F.log1p(F.count(F.lit(1)).cast("double")).alias("suffix_urls"), F.avg("url_length").alias("suffix_length")
    )
    return frame.join(suffixes, "suffix")


def judge_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score per row of ``pages`` (columns page_id, url).

    A null or empty url, or one without ``://``, has an empty host and path, fits no rule and is judged
    by the trees.  score is their probability of block, null where they are not needed or could not
    learn (one kind of label is missing: the rest is allowed).  Rows that repeat a page_id are
    separate rows; an empty table gives none.
    """
    host, path = url_parts(F.col("url"))
    named = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("host"), path.alias("path"))
    rule, ruled = matched_rule(F.col("host"), F.col("path"), rules)
    rows = checkpoint(_lexical(named.withColumns({"rule": rule, "ruled": ruled})))

    listed = F.col("host").rlike(LISTED)
    order = [F.xxhash64("host", "path", "page_id"), F.col("page_id")]
    blocked = rows.filter(listed).orderBy(*order).limit(TRAIN_ROWS).select(*FEATURES, F.lit(1.0).alias("label"))
    allowed = rows.filter(~listed & (F.coalesce("ruled", F.lit("allow")) == "allow")).orderBy(*order).limit(TRAIN_ROWS).select(*FEATURES, F.lit(0.0).alias("label"))
    sample = checkpoint(blocked.unionByName(allowed))
    kinds = {r["label"] for r in sample.groupBy("label").count().collect()}
    result = ["page_id", "host", "path", "rule"]
    if len(kinds) < 2:
        return rows.select(*result, F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, seed=11)
    model = trees.fit(assembler.transform(sample.coalesce(1)))
    judged = model.transform(assembler.transform(rows)).withColumn("p", vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(F.col("p") > 0.5, "block").otherwise("allow"))
    return judged.select(*result, verdict.alias("verdict"), F.when(F.col("ruled").isNull(), F.col("p")).alias("score"))
