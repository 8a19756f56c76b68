"""The pipeline's stages against brute force, each on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
import pytest
from llm_inputs import no_documents, odd_documents, odd_rows, shipped  # noqa: F401 (fixtures)
from test_llm_documents import SF, brute_components, check_pieces, texts
from tokenizers import Tokenizer

import corpus_pipeline
from verity.llm import queries
from verity.llm.quality import score_quality


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    kept.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append(docs)
    return kept


def test_names_and_columns(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "packing"]
    assert all(df.columns == staged[0].columns for df in staged[:-1])


def test_quality_stage_keeps_what_the_classifier_predicts(spark, staged):
    scored = score_quality(staged[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert {r.doc_id for r in staged[1].collect()} == {r.doc_id for r in scored if r.predicted == 1}


def test_lines_stage(staged):
    before = {r.doc_id: r for r in staged[1].collect()}
    after = {r.doc_id: r for r in staged[2].collect()}
    sites, holder = {}, {}
    for r in before.values():
        for line in r.text.split("\n"):
            sites.setdefault(line, set()).add(r.source)
            holder[line] = min(holder.get(line, r.doc_id), r.doc_id)
    for doc_id, r in before.items():
        gone = {x for x in r.text.split("\n") if x.strip() and len(sites[x]) >= 10 and holder[x] != doc_id}
        text = "\n".join(x for x in r.text.split("\n") if x not in gone)
        if gone and not text.strip():
            assert doc_id not in after
        else:
            assert after[doc_id].text == text and after[doc_id].n_chars == (len(text) if gone else r.n_chars)


def test_near_duplicates_stage_keeps_one_of_each_group(staged):
    rows = [(r.doc_id, r.text) for r in staged[2].collect()]
    assert sorted(r.doc_id for r in staged[3].collect()) == sorted({c for _, _, c in brute_components(rows)})


def test_packing_stage_and_run(spark, staged):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = [(r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in staged[3].collect()]
    check_pieces(staged[4].collect(), wanted)
    check_pieces(corpus_pipeline.run(spark, SF).collect(), wanted)


def test_stages_take_odd_and_empty_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_one_query_of_each_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in queries.QUERIES) == list(range(1, 14))
    assert texts
