"""What executors hold and write beside the rows: encoders' memos in Python workers, files of small rounds."""

import numpy as np
import pytest

from kestrel.llm import encoders, packing, simhash


def entries_held(enc):
    return sum(len(m) + len(m.old) for m in vars(enc).values() if isinstance(m, encoders._Memo))


@pytest.mark.parametrize("kind, name", [(encoders.WordEncoder, "word_bpe_49k.json"), (encoders.SpacedEncoder, "byte_bpe_50k.json")])
def test_encoder_holds_two_generations_and_no_more(monkeypatch, kind, name):
    monkeypatch.setattr(encoders, "MEMO_ENTRIES", 50)
    enc = kind(encoders.default_path(name))
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice([*"abcdeéß"], 6)) for _ in range(300)]
    text = " ".join(f"{w}, {w.title()}.\n{w} {w.upper()} {w}-1 ." for w in words)
    ids = enc.encode(text if kind is encoders.WordEncoder else text.encode())
    assert np.frombuffer(ids, "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert 0 < entries_held(enc) <= 100
    enc.forget()
    assert entries_held(enc) == 0


def test_packing_leaves_no_memo_in_a_worker(ready):
    import pyarrow as pa

    def held(batches):
        from kestrel.llm import encoders as own  # the worker's module, not a copy

        memos = [m for enc in own._ENCODERS.values() for m in vars(enc).values() if isinstance(m, own._Memo)]
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(m) + len(m.old) for m in memos)])], names=["n"])

    docs = ready.range(0, 400, 1, 8).selectExpr("id as doc_id", "concat('word', id, ' other ', uuid()) as text")
    assert packing.token_pieces(docs, encoders.default_path("word_bpe_49k.json")).count() == 400
    assert max(r.n for r in ready.range(0, 400, 1, 8).mapInArrow(held, "n long").collect()) == 0


def test_rounds_of_few_links_are_few_files(ready):
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: ready.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            ready.conf.set(k, v)
        found = simhash.components(ready.range(1000).selectExpr("id + 1000 as a", "id % 100 as b"))
        assert {(r.node, r.root) for r in found.collect()} == {(i + 1000, i % 100) for i in range(1000)}
        assert len(found.inputFiles()) <= simhash.ROUND_FILES
    finally:
        for k, v in before.items():
            ready.conf.set(k, v)
