"""Each stage on its own input against brute force, and the whole run."""

import brute
import duckdb
import pytest
from pyspark.sql import functions as F
from test_operators import check_pieces

import corpus_pipeline as P
from kestrel.llm import pii, quality
from kestrel.llm.common import materialize

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(ready):
    docs = ready.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(materialize(stage(ready, out[-1], SF), f"test-{name}"))
    return out


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(outputs):
    assert len(P.STAGES) == 5
    for df in outputs[1:5]:
        assert df.dtypes == outputs[0].dtypes


def test_quality_stage(ready, outputs):
    labels = ready.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in quality.classify(outputs[0], labels).filter("predicted = 1").collect()}
    assert {i for i, _ in rows_of(outputs[1])} == want
    known = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    good = [i for i, q in known.items() if q == 1]
    assert sum(i in want for i in good) / len(good) > 0.98


def test_exact_stage(outputs):
    want = {keep for keep, _, _ in brute.exact_groups(rows_of(outputs[1])).values()}
    assert sorted(i for i, _ in rows_of(outputs[2])) == sorted(want)


def test_near_stage(outputs):
    fps = {i: brute.simhash(t) for i, t in rows_of(outputs[2])}
    assert sorted(i for i, _ in rows_of(outputs[3])) == sorted(set(brute.classes(fps).values()))


def test_pii_stage(outputs):
    before, after = dict(rows_of(outputs[3])), dict(rows_of(outputs[4]))
    assert before.keys() == after.keys()
    spans = {r.doc.doc_id: r.spans for r in pii.find(outputs[3], ["doc_id"]).collect()}
    for i, text in before.items():
        assert (after[i] == text) == (not spans[i])
        assert not any(text[s:e] in after[i] for s, _, e, k in brute.personal(text) if k == "email")
    assert outputs[4].filter(F.length("text") != F.col("n_chars")).count() == 0


def test_packing_stage(outputs):
    check_pieces(outputs[5].collect(), rows_of(outputs[4]))


def test_run(ready, outputs):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, P.run(ready, SF).select(key).collect())) == sorted(map(tuple, outputs[5].select(key).collect()))


@pytest.mark.parametrize("k", range(5))
def test_odd_input(ready, odd, empty, k):
    _, stage = P.STAGES[k]
    out = stage(ready, odd, SF)
    assert out.count() > 0 and (k == 4 or out.columns == odd.columns)
    assert stage(ready, empty, SF).count() == 0
