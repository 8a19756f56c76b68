"""Operators over documents against brute force, on the small tables and on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from conftest import as_rows
from llm_inputs import no_documents, odd_documents, odd_rows, shipped  # noqa: F401 (fixtures)
from tokenizers import Tokenizer

from verity.llm import common, ngram_join, queries
from verity.llm.bpe import _DECODE, Codec, decode_documents, encode_documents, round_trip_digests
from verity.llm.exact_dedup import ORACLE as EXACT
from verity.llm.exact_dedup import exact_dedup
from verity.llm.line_dedup import line_dedup
from verity.llm.ngram_join import keep_one, ngram_components
from verity.llm.packing import encoder, pack_documents
from verity.llm.quality import score_quality

SF = "/root/testdata/sf0.01"
WORDS = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    """Per row (doc_id, text): set size and smallest doc_id reachable, by an inverted index over all rows."""
    sets = [shingles(t) for _, t in rows]
    lists, shared, root = defaultdict(list), Counter(), list(range(len(rows)))
    for i, (doc_id, _) in enumerate(rows):
        for x in sets[i] if doc_id is not None else ():
            lists[x].append(i)
    for own in lists.values():
        for y in range(len(own)):
            for x in range(y):
                shared[own[x], own[y]] += 1

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, j), c in shared.items():
        if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(rows))


def found_components(df):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in df.collect())


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(spark):
    return [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]


@pytest.mark.parametrize(("short", "frequent", "light"), [(16, 8, 24), (2, 4, 0), (2, 1 << 40, 24)])
def test_components_match_brute_force(spark, monkeypatch, short, frequent, light):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "LIGHT_BOUND", light)
    assert found_components(ngram_components(documents(spark))) == brute_components(texts(spark))


def test_components_of_short_and_edited_texts(spark):
    """Sizes where subsets are enumerated, pairs right at the bound, chains and a large group."""
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for size in range(5, 14):
        base = [f"w{int(x)}" for x in rng.integers(0, 40, size)]
        for cut in range(4):
            rows.append((n, " ".join(base[cut:])))
            rows.append((n + 1, " ".join([*base, *(f"z{n}{i}" for i in range(cut))])))
            n += 2
    body = [f"b{i}" for i in range(60)]
    for i in range(120):
        own = list(body)
        for at in rng.integers(0, 60, 1 + i % 3):
            own[at] = f"e{i}_{at}"
        rows.append((n, " ".join(own)))
        n += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_components(ngram_components(df)) == brute_components(rows)


def test_components_of_odd_rows(odd_documents, odd_rows, no_documents):
    assert found_components(ngram_components(odd_documents)) == brute_components([r[:2] for r in odd_rows])
    assert ngram_components(no_documents).count() == 0


def test_keep_one_keeps_columns_and_one_of_each_group(odd_documents, odd_rows):
    kept = keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    # 3 is a near copy of 1, 8 is 7, 12 is 11; of the two rows of 2 one is a copy of 1, the other leads a group.
    assert ids == sorted(["1", "2", "4", "5", "6", "7", "9", "10", "11", "13", "None", "None"])


def test_keep_one_loses_no_text(spark):
    """Unlike texts under one doc_id: the copy of another document goes, the other text stays."""
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b), (3, b + " more"), (4, ""), (4, "  "), (5, None)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.text) for r in keep_one(docs).filter("text <> '' AND trim(text) <> ''").collect()) == [(1, a), (2, b)]
    assert sorted(r.doc_id for r in keep_one(docs).filter("text IS NULL OR trim(text) = ''").collect()) == [4, 5]


def test_bpe_of_a_text_beyond_a_slice(spark):
    """A text of six million characters: encoded and decoded in pieces, ids as tiktoken's."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    text = " ".join(f"word{i % 7919} été{i % 13}\n" for i in range(400_000))
    ranks = {__import__("base64").b64decode(x): int(y) for x, y in map(bytes.split, open(path, "rb"))}
    ids = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in round_trip_digests(docs, path, public_tokenizers.PATTERN).collect()}
    assert got[1].n_tokens == len(ids) and got[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoded = encode_documents(docs, path, public_tokenizers.PATTERN)
    assert bytes(decode_documents(encoded.filter("doc_id = 1"), path, public_tokenizers.PATTERN).first().data) == text.encode()


def test_bitmap_bound_and_costs():
    rng = np.random.default_rng(1)
    for n in (1, 64, 65, 700):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert len(ngram_join.bitmap(a)) * 8 >= len(a)
    for a in range(1, 40):
        for b in ngram_join.partner_sizes(a, 75):
            c = ngram_join.least_overlap(a, b, 75)
            assert 100 * c >= 75 * (a + b - c) and 100 * (c - 1) < 75 * (a + b - (c - 1))
            assert a - ngram_join.prefix_length(a, 75) + 1 <= c


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    own = dict(common.shingle_sets(pa.array([text, None, "q r", text + "\nend"])))
    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    small = dict(common.shingle_sets(pa.array([text, None, "q r", text + "\nend"])))
    assert all((own[i] == small[i]).all() for i in range(4))


def duck(sql, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table)
    found = con.execute(sql).df().astype(object)
    return found.where(found.notna(), None)


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    tables = {t: pq.read_table(f"{SF}/{t}.parquet") for t in ("documents", "pages", "conversations")}
    got, want = queries.QUERIES[key](spark, SF).toPandas(), duck(queries.ORACLES[key], **tables)
    nullable = got.select_dtypes("float").columns  # integers with nulls, for pandas
    assert as_rows(got) == as_rows(want.astype(dict.fromkeys(nullable, float)))


def test_exact_dedup_of_odd_rows(spark, odd_documents, odd_rows, no_documents):
    rows = exact_dedup(odd_documents).collect()
    assert len(rows) == len(odd_rows)
    groups = defaultdict(list)
    for doc_id, text, *_ in odd_rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    for text, ids in groups.items():
        own = [r for r in rows if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        least = min((i for i in ids if i is not None), default=None)
        assert len(own) == len(ids) and {r.group_size for r in own} == {len(ids)} and {r.keep_id for r in own} == {least}
        assert sum(r.kept for r in own) == 1
    assert exact_dedup(no_documents).count() == 0
    assert EXACT


def test_line_dedup_of_odd_rows(spark, odd_documents, no_documents):
    added = ("lines_before", "lines_out", "full")
    rows = line_dedup(odd_documents, added=added).collect()
    assert len(rows) == odd_documents.count() and {r.lines_out for r in rows} == {0}
    assert line_dedup(no_documents, added=added).count() == 0


def test_line_dedup_counts_sites_near_and_far_from_the_bound(spark):
    rows = []
    for sites in (1, 8, 9, 10, 11, 12, 13, 400):
        rows += [(100 * sites + i, f"spread {sites}\nown {sites} {i}\n\n", f"s{i}") for i in range(sites)]
    rows += [(90_000 + i, "same site line\nspread 1", "s0") for i in range(50)] + [(None, "spread 400\nnull id", "s1"), (7, "spread 10", None), (8, None, "s1")]
    out = line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    sites = defaultdict(set)
    holder = {}
    for doc_id, text, site in rows:
        for line in (text or "").split("\n"):
            if site is not None:
                sites[line].add(site)
            if doc_id is not None:
                holder[line] = min(holder.get(line, doc_id), doc_id)
    want = []
    for doc_id, text, _ in rows:
        gone = [x for x in (text or "").split("\n") if x.strip() and len(sites[x]) >= 10 and holder[x] != doc_id]
        kept = None if text is None else "\n".join(x for x in text.split("\n") if x not in gone)
        want.append((str(doc_id), len(gone), kept, not gone or bool(kept.strip())))
    assert sorted((str(r.doc_id), r.n_removed, r.text, r.words_left) for r in out) == sorted(want)


def check_pieces(rows, wanted):
    """``wanted``: (doc_id, ids with the end) per document row; all ids in one piece each, gapless full sequences."""
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _ in wanted}
    for doc_id in by_doc:
        pieces = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id])
        own = [ids for d, ids in wanted if d == doc_id]
        assert sum(r.length for r in by_doc[doc_id]) == sum(map(len, own))
        for start, length, crc, total in pieces:
            assert any(len(ids) == total and zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc for ids in own)
        if len(own) == 1:
            at = 0
            for r in sorted(by_doc[doc_id], key=lambda r: r.start):
                assert r.start == at
                at += r.length
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0 and {r.tier for r in own} == {at}


def test_packing_round_trip(spark, odd_documents, odd_rows, no_documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    check_pieces(queries.QUERIES["op10_packing"](spark, SF).collect(), [(d, ids(t)) for d, t in texts(spark)])
    odd = [*[r[:2] for r in odd_rows], (50, "before <|endoftext|> after")]
    more = spark.createDataFrame([(50, "before <|endoftext|> after")], "doc_id bigint, text string")
    docs = odd_documents.select("doc_id", "text").unionByName(more)
    check_pieces(pack_documents(docs, path).collect(), [(d, ids(t)) for d, t in odd])
    assert pack_documents(no_documents, path).count() == 0


def test_packing_encoder_equals_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encode = Tokenizer.from_file(path), encoder(path)
    rng = np.random.default_rng(2)
    alphabet = list("abcdeéü中文 \n\t\r123'st!@#😀 ßﬁ٣²ª_-") + ["'ll", " the", "\u00a0", "\u3000", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 80))))
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranked():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = Codec(path, public_tokenizers.PATTERN)
    return path, codec, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_bpe_equals_tiktoken(ranked):
    _, codec, known = ranked
    rng = np.random.default_rng(3)
    alphabet = list("abcdeéü中文 \n\t123'st!@#😀 ßﬁ") + ["tion", "the"]
    samples = ["".join(rng.choice(alphabet, int(rng.integers(0, 300)))) for _ in range(200)]
    samples += ["x" * 3000, "thethethe" * 200, "é中" * 400, None, "", " ", "\n\n ", "a" * 256, "a" * 257]
    found = codec.encode(samples)
    assert found == [known.encode_ordinary(t or "") for t in samples]
    assert codec.decode(found) == [(t or "").encode() for t in samples]


def test_bpe_decodes_in_order_across_rows_and_pieces(ranked):
    """One sort of all ids of a query, not one per row's aggregate; rows keep their order and stay apart."""
    _, codec, known = ranked
    rows = [[i * 7919 % 50_000 for i in range(k, k + n)] for k, n in ((0, 900_000), (5, 0), (11, 3), (400, 70_000), (9, 399_999), (2, 1))]
    assert codec.decode(rows) == [known.decode_bytes(row) for row in rows]
    at = np.random.default_rng(1).permutation(60_000)
    codec.db.register("ids", pa.table({"row": at // 20_000, "pos": at, "id": at % 50_000}))  # told by pos, not by arrival
    found = dict(codec.db.execute(_DECODE).fetchall())
    codec.db.unregister("ids")
    assert [bytes.fromhex(found[r]) for r in range(3)] == [known.decode_bytes([i % 50_000 for i in range(r * 20_000, r * 20_000 + 20_000)]) for r in range(3)]


def test_bpe_over_documents_and_odd_rows(spark, ranked, odd_documents, odd_rows, no_documents):
    path, _, known = ranked
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = lambda rows: sorted((str(d), len(i := known.encode_ordinary(t or "")), sha(",".join(map(str, i)).encode()), sha((t or "").encode())) for d, t in rows)
    got = lambda df: sorted((str(r[0]), *r[1:]) for r in df.collect())
    assert got(queries.QUERIES["op7_byte_bpe"](spark, SF)) == want(texts(spark))
    assert got(round_trip_digests(odd_documents, path, public_tokenizers.PATTERN)) == want([r[:2] for r in odd_rows])
    encoded = encode_documents(odd_documents, path, public_tokenizers.PATTERN)
    decoded = decode_documents(encoded, path, public_tokenizers.PATTERN).collect()
    assert Counter(bytes(r.data) for r in decoded) == Counter((r[1] or "").encode() for r in odd_rows)
    assert round_trip_digests(no_documents, path, public_tokenizers.PATTERN).count() == 0


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = score_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()
    assert (scored.predicted == (scored.score >= 0.3)).all() and scored.score.between(0, 1).all()
    own = scored[scored.held_out]
    rank = own.score.rank()
    good, bad = (own.quality == 1).sum(), (own.quality == 0).sum()
    assert (rank[own.quality == 1].sum() - good * (good + 1) / 2) / (good * bad) > 0.97
    assert own[own.quality == 1].predicted.mean() > 0.98


def test_quality_of_odd_rows(spark, odd_documents, odd_rows, no_documents):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 14)] + [(None, 1, 0), (1, None, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = score_quality(odd_documents, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert score_quality(odd_documents, labels.limit(0)).count() == len(odd_rows)
    assert score_quality(no_documents, labels).count() == 0
