"""Operators 11 to 13 against brute force, on the small tables and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import as_rows
from llm_inputs import no_documents, odd_documents, odd_rows, shipped  # noqa: F401 (fixtures)
from test_llm_documents import shingles

from verity.llm import lsh_forest, queries, spelling
from verity.llm.lsh_forest import forest_components, signature
from verity.llm.prefix_trie import conversation_trie
from verity.llm.spelling import spelling_groups

SF = "/root/testdata/sf0.01"


# --- 11 -----------------------------------------------------------------------------------

def one_apart(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute_spelling(rows):
    counts, low = Counter(), str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    met, near = defaultdict(set), defaultdict(set)
    for w in words:
        for s in (w, *(w[:k] + w[k + 1 :] for k in range(len(w)))):
            met[s].add(w)
    for group in met.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def told(frame):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()], key=str)


def test_spelling_of_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert told(queries.QUERIES["op11_spelling"](spark, SF)) == brute_spelling(rows)


@pytest.mark.parametrize("frequent, short", [(1, 48), (2, 2), (64, 2)])
def test_spelling_with_frequent_grams_and_long_lists(spark, monkeypatch, frequent, short):
    rnd = random.Random(frequent)
    stems = ["abcdefg", "abcdefgh", "aaaaaaa", "àéîõüñç", "internation", "x" * 60]
    words = []
    for _ in range(900):
        w = rnd.choice(stems)
        for _ in range(rnd.randrange(4)):
            k, c = rnd.randrange(len(w) + 1), rnd.choice("abàü")
            w = rnd.choice([w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w[:k] + w[k + 1 :]])
        words += [w] * rnd.choice([1, 2, 3, 30])
    rnd.shuffle(words)
    rows = [(i, " ".join(words[i::50])) for i in range(50)] + [(None, "abcdefg ABCDEFG À×÷aaaaa"), (3, None), (4, "")]
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    short_lists = spelling._pairs
    monkeypatch.setattr(spelling, "SHORT", short)
    assert short_lists is spelling._pairs
    assert told(spelling_groups(docs)) == brute_spelling(rows)


def test_spelling_long_lists_in_one_task(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spelling, "SHORT", 2)
    words = [b"abcdefg", b"abcdefx", b"abcdef", b"zabcdefg", b"qqqqqqq", b"abcdegf"]
    batch = pa.RecordBatch.from_arrays([pa.array([8] * len(words)), pa.array(words, pa.binary()), pa.array([2] * len(words))], names=["key", "w", "n"])
    got = {frozenset((a, b)) for out in spelling._pairs(iter([batch])) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)}
    assert got == {frozenset((a, b)) for a in words for b in words if one_apart(a, b)}


def test_affected_bound_is_never_too_small():
    """The grams that an edit leaves alone are at least all but the bound of either word."""
    rnd = random.Random(5)
    dictionary = [np.sort(np.unique(spelling.Grams([b"abcabcabc", b"aabbcc"]).code))]
    for _ in range(300):
        w = bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(7, 14)))
        k = rnd.randrange(len(w) + 1)
        v = rnd.choice([w[:k] + b"b" + w[k:], w[:k] + b"z" + w[k + 1 :], w[:k] + w[k + 1 :]])
        grams = spelling.Grams([w, v])
        grams.grow(dictionary[0], 4)
        own = [Counter(grams.code[grams.word == i].tolist()) for i in (0, 1)]
        shared = sum((own[0] & own[1]).values())
        assert shared >= max(sum(own[i].values()) - int(grams.affected()[i]) for i in (0, 1))


def test_padded_words_compare_as_near_does():
    rnd = random.Random(4)
    words = [bytes(rnd.choice(b"abc\xff") for _ in range(rnd.randrange(1, 40))) for _ in range(200)]
    for w in words[:200]:
        k, z = rnd.randrange(len(w)), bytes([rnd.choice(b"ab\xff")])
        words += [w[:k] + z + w[k:], w[:k] + z + w[k + 1:], w[:k] + w[k + 1:] or b"a"]
    at = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    rows = spelling._padded(np.frombuffer(b"".join(words), np.uint8), at, 48)
    for i in range(200):
        for j in (*range(200 + 3 * i, 203 + 3 * i), *rnd.sample(range(len(words)), 5)):
            a, b = (i, j) if len(words[i]) >= len(words[j]) else (j, i)
            if len(words[a]) - len(words[b]) <= 1:
                told = spelling._replaced if len(words[a]) == len(words[b]) else spelling._inserted
                assert bool(told(rows[[a]], rows[[b]])[0]) == spelling.near(words[a], words[b])


def test_spelling_of_odd_rows(odd_documents, odd_rows, no_documents):  # noqa: F811
    assert told(spelling_groups(odd_documents)) == brute_spelling([r[:2] for r in odd_rows])
    assert spelling_groups(no_documents).count() == 0


# --- 12 -----------------------------------------------------------------------------------

def brute_trie(rows):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, ends)}"""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    original = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(original.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = {}
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(node)))
        out[min(convs), len(node)] = (min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
                                      hashlib.sha256(ends.encode()).hexdigest())
    return out


def trie_of(frame):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect()}


def test_trie_equals_its_sql(spark):
    got = queries.QUERIES["op12_prefix_trie"](spark, SF).toPandas()
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW conversations AS FROM '{SF}/conversations.parquet'")
    want = duckdb.sql(queries.ORACLES["op12_prefix_trie"]).df()
    assert as_rows(got.astype({"parent_conv_id": "float"})) == as_rows(want.astype({"parent_conv_id": "float"}))


def test_trie_of_odd_conversations(spark):
    """A long chain, a conversation that is another's beginning, equal ones, nulls, ties, repeated rows, turnless rebuilds."""
    rnd = random.Random(12)
    rows = [(c, t, rnd.choice(["user", "bot", None]), rnd.choice(["a", "bb", "", None])) for c in range(-130, 260) for t in range(rnd.randrange(1, 7))]
    rows += [(300, t, "user", f"turn {t % 3}") for t in range(150)] + [(c, t, "user", f"turn {t % 3}") for c in (310, 311, 312, 390) for t in range(90)]
    rows += [(5, None, "x", "null turn"), (5, 1, "x", "tie"), (5, 1, "x", "tie"), (None, 1, "user", "nobody"), (7_000_000_001, 0, "user", "far")]
    rnd.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, p1 int").repartition(4)
    got = trie_of(conversation_trie(frame))
    want = brute_trie(rows)
    assert got == want
    assert conversation_trie(frame.limit(0)).count() == 0


# --- 13 -----------------------------------------------------------------------------------

def brute_components(rows, percent):
    """component of each row (by index): smallest doc_id reachable by links."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        component = None if doc is None else least[find(i)]
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def grouped(frame):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()], key=str)


@pytest.mark.parametrize("window", [64, 2])
def test_forest_equals_brute_force(spark, monkeypatch, window):
    """Copies edited at random around the bound, a dense group; with a tiny window dense regions are settled exactly."""
    rnd = random.Random(window)
    base = [[rnd.choice("abcdefghijklmnop") + str(rnd.randrange(400)) for _ in range(200)] for _ in range(12)]
    rows = []
    for i in range(220):
        words = list(base[0] if i % 3 == 0 else rnd.choice(base))
        for _ in range(rnd.randrange(0, 6)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000, "one two"), (2001, "ONE two"), (2002, "")]
    monkeypatch.setattr(lsh_forest, "WINDOW", window)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert grouped(forest_components(docs)) == brute_components(rows, 85)


def test_forest_of_odd_rows(odd_documents, odd_rows, no_documents):  # noqa: F811
    assert grouped(forest_components(odd_documents)) == brute_components([r[:2] for r in odd_rows], 85)
    assert forest_components(no_documents).count() == 0


def test_signature_agreement_follows_similarity():
    rnd = np.random.default_rng(3)
    for share in (0.95, 0.85, 0.5):
        n = 400
        a = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
        keep = int(round(2 * share * n / (1 + share)))
        b = np.concatenate((a[:keep], rnd.integers(0, 1 << 63, n - keep, dtype=np.uint64)))
        x, y = (np.frombuffer(signature(s), np.uint8) for s in (a, b))
        assert abs((x == y).mean() - share) < 0.15
