"""Stages against brute force on a small corpus, and registered queries against their SQL."""

import os
from collections import Counter

import cases
import pytest
from test_llm_minhash import brute, chains
from test_llm_other import labelled
from test_llm_pii import corpus, plain_spans

import corpus_pipeline
from checks.compare import difference, duckdb_views
from speechloom.llm.language_id import has_letter
from speechloom.llm.oracle import ORACLE
from speechloom.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark, tmp_path):
    docs = cases.awkward(spark, [*labelled(60), *chains(5), *((i + 5000, *r) for i, *r in corpus(20))])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names, after = [], [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, after[-1], str(tmp_path)).write.parquet(str(tmp_path / name))
        names.append(name)
        after.append(spark.read.parquet(str(tmp_path / name)))
    assert names == ["language_id", "minhash", "pii", "mixing", "packing"]
    for df in after[1:-1]:
        assert df.columns == docs.columns
    rows = [df.collect() for df in after]
    assert Counter(r.doc_id for r in rows[1]) == Counter(r.doc_id for r in rows[0] if has_letter(r.text))
    want = brute([(r.doc_id, r.text) for r in rows[1]], 5, 80)
    assert sorted(r.doc_id for r in rows[2] if r.doc_id is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert Counter(r.doc_id for r in rows[3]) == Counter(r.doc_id for r in rows[2])
    assert not any(plain_spans(r.text or "") for r in rows[3])
    before = {r.doc_id: r.text for r in rows[2]}
    assert all(r.text == before[r.doc_id] for r in rows[3] if not plain_spans(before[r.doc_id] or "") and "[at]" not in r.text)
    assert {r.doc_id for r in rows[4]} <= {r.doc_id for r in rows[3]}
    assert Counter(r.doc_id for r in rows[5] if r.piece == 0) == Counter(r.doc_id for r in rows[4])


def test_result_holds_the_sequences(spark):
    rows = corpus_pipeline.packed(spark, cases.awkward(spark), "").collect()
    assert rows and all(len(r.ids) == r.length for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("key", list(ORACLE))
def test_query(spark, key):
    assert difference(spark, duckdb_views(SF_DIR), QUERIES[key], ORACLE[key], SF_DIR) is None


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))
