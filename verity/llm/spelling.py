"""Spelling variants: words one edit apart, found through a variable-length gram index.

Words are stored one byte per code point (all of ``[A-Za-z\\u00C0-\\u00FF]`` lie below 256), with a mark
before and after.  A *gram* starts at every place of a marked word and grows from ``LEAST`` to at most
``MOST`` code points as long as it is frequent: the dictionary of frequent grams, counted over all
words level by level, is what prunes it.  A gram's length depends on its own code points alone, so an
edit changes exactly the grams that lie over it; the most that one edit can touch is the word's
*affected-gram bound*.

Two near words share all grams that the edit does not touch.  Order the grams of a word rare before
frequent: the first shared one is among the first ``bound + 1`` of either word.  Only those are
listed, with their distance from the word's start and from its end (an untouched gram keeps one of
them), and words that meet in a list are verified.  A gram that is still frequent at its full length
comes last in the order; a word that must list one lists itself under its spellings with one code
point left out instead, and so do the members of a list that has grown long: two near words share
such a spelling.  No list is compared as a whole once it is long, and no list is cut.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import mix, string_parts, tidy
from verity.session import checkpoint, ship_package

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form has at least so many times the occurrences of its variant.
RATIO = 10
#: A run's hash divisible by this loses a code point.
DROP = 31
LEAST, MOST = 3, 6
#: A gram of more than so many occurrences among the words is frequent; or, if that is more, of more
#: than all occurrences divided by DICTIONARY, so that a level of the dictionary has at most as many.
FREQUENT = 64
DICTIONARY = 1 << 18
#: Lists up to this length are compared directly.
SHORT = 48
#: Words or keys that a task holds at a time.
CHUNK = 60_000

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, count) of the runs of whole texts; a word is latin-1 bytes, its A-Z lower-cased."""
    counts: dict[bytes, int] = {}

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"])

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        for i, doc in enumerate(ids):
            if not texts[i].is_valid:
                continue
            begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for found in _RUN.finditer(texts[i].as_py()):
                run = found.group()
                word = run.encode("latin-1").lower()
                h = zlib.crc32(word if run.isascii() else word.decode("latin-1").encode(), begun)
                if h % DROP == 0:
                    k = h % len(word)
                    word = word[:k] + word[k + 1 :]
                    if len(word) < LEAST_LENGTH:
                        continue
                counts[word] = counts.get(word, 0) + 1
            if len(counts) >= CHUNK:
                yield flush()
                counts.clear()
    if counts:
        yield flush()


class Grams:
    """The grams of some marked words laid end to end, as exact numbers (a byte per code point)."""

    def __init__(self, words: list[bytes]):
        self.lengths = np.array([len(w) + 2 for w in words], np.int64)
        data = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words), np.uint8)
        begin = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        at = np.arange(len(data)) - begin[self.word]
        starts = at + LEAST <= self.lengths[self.word]
        self.data = np.concatenate((data, np.zeros(MOST, np.uint8)))
        self.place = np.flatnonzero(starts)
        self.word, self.at = self.word[starts], at[starts]
        self.size = np.full(len(self.place), LEAST)
        self.code = np.zeros(len(self.place), np.uint64)
        for k in range(LEAST):
            self.code = self.code << np.uint64(8) | self.data[self.place + k].astype(np.uint64)
        self.room = self.lengths[self.word] - self.at

    def frequent(self, dictionary: np.ndarray) -> np.ndarray:
        if not len(dictionary):
            return np.zeros(len(self.code), bool)
        found = np.minimum(np.searchsorted(dictionary, self.code), len(dictionary) - 1)
        return dictionary[found] == self.code

    def grow(self, dictionary: np.ndarray, size: int) -> np.ndarray:
        """Grams of ``size - 1`` code points that are frequent take one more, where the word has one; which did."""
        more = (self.size == size - 1) & (self.room >= size) & self.frequent(dictionary)
        at = np.flatnonzero(more)
        self.code[at] = self.code[at] << np.uint64(8) | self.data[self.place[at] + size - 1].astype(np.uint64)
        self.size[at] = size
        return more

    def affected(self) -> np.ndarray:
        """Per word, the most grams that lie over one code point (an insertion touches no more)."""
        cover = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(cover, self.place, 1)
        np.add.at(cover, self.place + self.size, -1)
        cover = np.cumsum(cover)[: int(self.lengths.sum())]
        begin = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        cover[begin] = cover[begin + self.lengths - 1] = 0  # the marks are not edited
        return np.maximum.reduceat(cover, begin)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and counts, in pieces of at most CHUNK words or some megabytes."""
    for batch in batches:
        words, n = batch.column("w").to_pylist(), batch.column("n").to_numpy()
        lo = size = 0
        for i, w in enumerate(words):
            size += len(w)
            if i - lo >= CHUNK or size > 4 << 20:
                if i > lo:
                    yield words[lo:i], n[lo:i]
                lo, size = i, len(w)
        if lo < len(words):
            yield words[lo:], n[lo:]


def _gram_counts(batches: Iterator[pa.RecordBatch], levels: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(code, hits) of the grams that have grown to LEAST + len(levels) code points."""
    for words, _ in _chunks(batches):
        grams = Grams(words)
        chosen = np.ones(len(grams.code), bool)
        for k, dictionary in enumerate(levels):
            chosen = grams.grow(dictionary, LEAST + k + 1)
        code, hits = np.unique(grams.code[chosen], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(hits.astype(np.int64))], names=["code", "hits"])


def gram_dictionary(words: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length from LEAST to MOST the frequent grams (ascending) and their hits, counted over all ``words``.

    A level has at most ``DICTIONARY`` grams whatever the number of words.
    """
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    least = FREQUENT
    for _ in range(LEAST, MOST + 1):
        known = [codes for codes, _ in levels]
        counted = words.mapInArrow(tidy(lambda x, known=known: _gram_counts(x, known)), "code bigint, hits bigint") \
            .groupBy("code").agg(F.sum("hits").alias("hits"))
        if not levels:
            counted = checkpoint(counted)
            total = counted.agg(F.sum("hits")).first()[0] or 0
            least = max(FREQUENT, total // DICTIONARY)
        found = counted.filter(F.col("hits") > least).toArrow()
        code, hits = found.column("code").to_numpy().view(np.uint64), found.column("hits").to_numpy()
        order = np.argsort(code)
        levels.append((code[order], hits[order]))
    return levels


def _key(parts: np.ndarray, from_end: bool = False) -> np.ndarray:
    """List keys; the lowest bit tells lists by the distance from the end."""
    return ((mix(parts) & ~np.uint64(1)) | np.uint64(from_end)).view(np.int64)


def _left_out(word: bytes) -> list[bytes]:
    """The word and its spellings with one code point left out."""
    return [word, *{word[:k] + word[k + 1 :] for k in range(len(word))}]


def _spelling_keys(word: bytes) -> np.ndarray:
    """Hashes of the word and of it with one code point left out, without making them."""
    ends = np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)
    base = np.uint64(0x9E3779B97F4A7C15)
    up = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(word), base))))
    left = np.concatenate((np.zeros(1, np.uint64), np.cumsum(ends * up[:-1], dtype=np.uint64)))
    right = np.concatenate((np.cumsum((ends * up[:-1])[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)))
    # What stands behind the place moves one to the front.
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    without = left[:-1] + right[1:] * inverse
    top = up[-1:]
    keys = np.concatenate((without + top * np.uint64(len(word) - 1), left[-1:] + top * base * np.uint64(len(word))))
    return np.unique(_key(~keys))


def _postings(batches: Iterator[pa.RecordBatch], levels: list[np.ndarray], late: np.ndarray, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, w, n): a word under its first grams, or under its spellings with a code point left out."""
    def rows(key, index, words, n):
        for x in range(0, len(key), CHUNK):
            own = index[x : x + CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array(key[x : x + CHUNK]), pa.array(words, pa.binary()).take(pa.array(own)), pa.array(n[own])], names=["key", "w", "n"])

    for words, n in _chunks(batches):
        grams = Grams(words)
        for k, dictionary in enumerate(levels):
            grams.grow(dictionary, LEAST + k + 1)
        bound = grams.affected() + 1
        # Grams that are frequent at full length last, the least frequent of them first.
        order = np.zeros(len(grams.code), np.int64)
        full = np.flatnonzero((grams.size == MOST) & grams.frequent(late))
        order[full] = 1 + rank[np.searchsorted(late, grams.code[full])]
        by = np.lexsort((grams.at, grams.code, order, grams.word))
        word = grams.word[by]
        begin = np.searchsorted(word, np.arange(len(words)))
        first = np.arange(len(word)) - begin[word] < bound[word]
        chosen = by[first]
        late_one = np.zeros(len(words), bool)
        late_one[grams.word[chosen[order[chosen] > 0]]] = True
        chosen = chosen[order[chosen] == 0]
        code, own = mix(grams.code[chosen]), grams.word[chosen]
        yield from rows(_key(code + grams.at[chosen].astype(np.uint64)), own, words, n)
        yield from rows(_key(code + grams.room[chosen].astype(np.uint64), True), own, words, n)
        keys, index, held = [], [], 0
        for i in np.flatnonzero(late_one).tolist():
            keys.append(_spelling_keys(words[i]))
            index.append(np.full(len(keys[-1]), i))
            held += len(keys[-1])
            if held >= 4 * CHUNK:
                yield from rows(np.concatenate(keys), np.concatenate(index), words, n)
                keys, index, held = [], [], 0
        if keys:
            yield from rows(np.concatenate(keys), np.concatenate(index), words, n)


def near(a: bytes, b: bytes) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced between ``a`` and ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(a) == len(b):
        return int((x != y).sum()) == 1
    unequal = np.flatnonzero(x[:-1] != y)
    cut = int(unequal[0]) if len(unequal) else len(b)
    return bool((x[cut + 1 :] == y[cut:]).all())


def _padded(raw: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The words as rows of ``width`` bytes, cut or filled with zeros: made once a word, not once a pair."""
    grid, out = np.arange(width), np.zeros((len(at) - 1, width), np.uint8)
    for x in range(0, len(out), CHUNK):
        begin, end = at[:-1][x : x + CHUNK, None], at[1:][x : x + CHUNK, None]
        out[x : x + CHUNK] = np.where(grid < end - begin, raw[np.minimum(begin + grid, len(raw) - 1)], 0)
    return out


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of padded words of one length differ in exactly one code point; eight at a time."""
    bits = a.view(np.uint64) ^ b.view(np.uint64)
    for k in (4, 2, 1):
        bits |= bits >> np.uint64(k)
    return np.bitwise_count(bits & np.uint64(0x0101010101010101)).sum(axis=1, dtype=np.uint8) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of padded words ``a`` are those of ``b`` with one code point more, given they are one longer."""
    width = a.shape[1]
    differ, moved = a != b, a[:, 1:] != b[:, :-1]
    last = np.where(moved.any(axis=1), width - 1 - moved[:, ::-1].argmax(axis=1), 0)  # one behind the last that differs
    return last <= differ.argmax(axis=1)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of sorted lists: (a, b, an, bn), a the longer or, of equal length, the smaller; a pair
    may come more than once.  An untouched gram of two words of one length has the same distance from
    the start and from the end: lists by the latter need only pairs of different lengths."""
    def found(words, counts, left, right, from_end):
        raw, at = string_parts(words)
        size = np.diff(at)
        # The parity of each code point's number (in 64 classes): an edit changes two of them at most.
        odd = np.bitwise_xor.reduceat(np.uint64(1) << (raw & np.uint8(63)).astype(np.uint64), at[:-1])
        keep = np.flatnonzero(np.bitwise_count(odd[left] ^ odd[right]) <= 2)
        left, right, from_end = left[keep], right[keep], from_end[keep] if from_end.ndim else from_end
        swap = size[left] < size[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        keep = (size[left] - size[right] <= 1) & ((size[left] > size[right]) | ~from_end)
        left, right = left[keep], right[keep]
        hits = np.zeros(len(left), bool)
        small = size[left] <= 40
        if small.any():
            padded = _padded(raw, at, (int(size[left[small]].max()) // 8 + 1) * 8)
            level = size[left] == size[right]
            for chosen, told in ((np.flatnonzero(small & level), _replaced), (np.flatnonzero(small & ~level), _inserted)):
                for x in range(0, len(chosen), CHUNK):
                    own = chosen[x : x + CHUNK]
                    hits[own] = told(padded[left[own]], padded[right[own]])
        for k in np.flatnonzero(~small).tolist():
            hits[k] = near(words[int(left[k])].as_py(), words[int(right[k])].as_py())
        left, right = left[hits], right[hits]
        if not len(left):
            return
        a, b = words.take(pa.array(left)), words.take(pa.array(right))
        turned = (size[left] == size[right]) & np.asarray(pc.greater(a, b))
        left, right = np.where(turned, right, left), np.where(turned, left, right)
        yield pa.RecordBatch.from_arrays([words.take(pa.array(left)), words.take(pa.array(right)), pa.array(counts[left]), pa.array(counts[right])], names=["a", "b", "an", "bn"])

    def short_lists(key, words, counts):
        """Whole short lists of one batch."""
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(edge, len(key)))
        left, right = [], []
        for m in range(2, SHORT + 1):
            at = edge[size == m]
            if len(at):
                i, j = np.triu_indices(m, 1)
                left.append((at[:, None] + i).ravel())
                right.append((at[:, None] + j).ravel())
        if left:
            left, right = np.concatenate(left), np.concatenate(right)
            yield from found(words, counts, left, right, key[left] & 1 == 1)
        for x, m in zip(edge[size > SHORT].tolist(), size[size > SHORT].tolist(), strict=True):
            yield from long_list(words[x : x + m], counts[x : x + m], bool(key[x] & 1))

    def long_list(words, counts, from_end):
        """Words of a long list that share a spelling with one code point left out."""
        met: dict[bytes, list[int]] = {}
        for i, w in enumerate(words.to_pylist()):
            for s in _left_out(w):
                met.setdefault(s, []).append(i)
        left, right = [], []
        for own in met.values():
            if len(own) > 1:
                i, j = np.triu_indices(len(own), 1)
                own = np.array(own)
                left.append(own[i])
                right.append(own[j])
        if left:
            yield from found(words, counts, np.concatenate(left), np.concatenate(right), np.bool_(from_end))

    key, words, counts = np.zeros(0, np.int64), pa.array([], pa.binary()), np.zeros(0, np.int64)
    for batch in batches:
        key = np.concatenate((key, batch.column("key").to_numpy()))
        words = pa.concat_arrays([words, batch.column("w")])
        counts = np.concatenate((counts, batch.column("n").to_numpy()))
        last = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if last:
            yield from short_lists(key[:last], words[:last], counts[:last])
            key, words, counts = key[last:], words[last:], counts[last:]
    if len(key):
        yield from short_lists(key, words, counts)


def words_of(docs: DataFrame) -> DataFrame:
    """(w, n): the words (latin-1 bytes) of ``docs`` (doc_id, text) that occur often enough."""
    ship_package(docs.sparkSession)
    parts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(_counted_words), "w binary, n bigint")
    return parts.groupBy("w").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, bn): for each word of ``words`` (w, n) every word one edit away with its count, once."""
    spark = words.sparkSession
    levels = gram_dictionary(words)
    code, hits = levels[-1]
    rank = np.argsort(np.argsort(hits, kind="stable"), kind="stable")
    shared = spark.sparkContext.broadcast(([c for c, _ in levels[:-1]], code, rank))

    def postings(batches):
        return _postings(batches, *shared.value)

    lists = words.mapInArrow(tidy(postings), "key bigint, w binary, n bigint")
    pairs = lists.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_pairs), "a binary, b binary, an bigint, bn bigint")
    ends = F.array(F.struct("a", "b", "bn"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("an").alias("bn")))
    return pairs.distinct().select(F.inline(ends))


def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of ``docs`` (columns doc_id, text; others ignored).

    A null text has no words; a null doc_id hashes as an empty one; rows that repeat count each.
    Ties between forms go to the smallest in code-point order.  An empty table gives no rows.
    """
    words = checkpoint(words_of(docs))
    best = near_words(words).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("bn")).alias("minus"), F.col("b"))).alias("best"))
    joined = words.join(best.withColumnRenamed("a", "w"), "w", "left")
    form_n = -F.col("best.minus")
    formed = F.coalesce(form_n >= RATIO * F.col("n"), F.lit(False))
    told = checkpoint(joined.select("w", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.b")).alias("form"),
                                    F.when(formed, form_n).alias("form_n")))
    # A form has RATIO times the occurrences, so a chain has as many links as the largest count has digits.
    largest = told.agg(F.max("n")).first()[0] or 1
    links = told.filter("form IS NOT NULL").select("w", F.col("form").alias("root"))
    for _ in range(ceil(log2(max(log10(largest) + 1, 2)))):
        onward = links.select(F.col("w").alias("root"), F.col("root").alias("further"))
        links = checkpoint(links.join(onward, "root", "left").select("w", F.coalesce("further", "root").alias("root")))
    name = lambda c: F.decode(F.col(c), "ISO-8859-1")
    return told.join(links, "w", "left").select(
        name("w").alias("word"), name("form").alias("form"), F.decode(F.coalesce("root", "w"), "ISO-8859-1").alias("root"),
        "n", "n_near", "form_n")
