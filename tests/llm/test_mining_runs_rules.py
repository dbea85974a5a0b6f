"""Hard negatives, periodic runs and quality rules against brute force, SQL, and on odd input."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from conftest import ODD_TEXTS
from pyspark.sql import functions as F

from kestrel.llm import hard_negatives, periodic, queries, rules
from kestrel.llm.words import Laid

SF = "/root/testdata/sf0.001"


# ---- hard negatives -------------------------------------------------------------------------------------------


def brute_negatives(rows, anchors, k=5):
    """Sorted result tuples of (id, label, whole-number vector) rows."""
    out = []
    for a_id, a_label, a_vec in {(i, lab, tuple(v)) for i, lab, v in rows if i in anchors}:
        scored = sorted((-sum(x * y for x, y in zip(a_vec, v)), i, lab) for i, lab, v in rows if i != a_id and len(v) == len(a_vec))
        for p_score, p_id, _ in [s for s in scored if s[2] == a_label][:k]:
            fitting = [(i, -s) for s, i, lab in scored if lab != a_label and -80 * p_score <= -100 * s <= -100 * p_score][:k]
            out += [(a_id, p_id, r + 1, i, -p_score, s) for r, (i, s) in enumerate(fitting)]
    return sorted(out)


def mined(spark, rows, anchors, **sizes):
    df = spark.createDataFrame(rows, "id long, label long, vec array<long>")
    found = hard_negatives.mine(hard_negatives.items(df, "id", F.col("label"), F.col("vec")), F.col("id").isin(*anchors), **sizes)
    return sorted(map(tuple, found.collect()))


def test_negatives_equal_sql(ready):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op11_hard_negatives(ready, SF)
    rel = con.sql(queries.OP11_SQL)
    assert sorted(map(tuple, got.select(*rel.columns).collect())) == sorted(rel.fetchall())


def test_negatives_ties_copies_dimensions(ready):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(3), [rnd.randint(-2, 3) for _ in range(4)]) for i in range(150)]
    rows += [(200 + i, rnd.randrange(3), [1, 1, 1, 1]) for i in range(200)]  # a hot vector, with ties
    rows += [(500 + i, i % 2, [rnd.randint(0, 3) for _ in range(2)]) for i in range(30)]  # vectors of another dimension
    rows += [(600, 0, []), (601, 0, []), (602, 1, []), (603, 0, [0, 0, 0, 0]), (604, 1, [0, 0, 0, 0])]
    rows += [rows[7], rows[7], rows[160]]
    anchors = {0, 7, 9, 33, 210, 510, 600, 603}
    want = brute_negatives(rows, anchors)
    for sizes in ({}, {"part": 2, "stripe_numbers": 100}):
        assert mined(ready, rows, anchors, **sizes) == want


def test_negatives_of_large_numbers(ready):
    big = 2**30
    rows = [(1, 0, [big, 3]), (2, 0, [big, 1]), (3, 1, [big - 1, 5]), (4, 1, [big, 0]), (5, 1, [2**31, 2**31])]
    assert mined(ready, rows, {1}) == brute_negatives(rows[:4], {1})


def test_walks_stop_early_and_hold(ready):
    """Tight groups of vectors: members stop long before the end of the list, and nothing is lost."""
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(8, 16))
    vec = np.floor(256 * (centers[np.arange(800) % 8] + 0.05 * rng.normal(size=(800, 16)))).astype(int)
    rows = [(i, int(rng.integers(4)), v.tolist()) for i, v in enumerate(vec)]
    anchors = set(range(0, 800, 20))
    assert mined(ready, rows, anchors) == brute_negatives(rows, anchors)
    own = vec[:1].astype(float)
    order = np.argsort(-(np.sqrt((vec.astype(float) ** 2).sum(1)) * (vec @ own[0]) / np.sqrt((vec.astype(float) ** 2).sum(1)) / np.linalg.norm(own)))
    bounds = (vec @ own[0] / np.linalg.norm(own))[order]
    walk = hard_negatives.Walk(np.array([0]), np.array([rows[0][1]]), vec[:1], np.linalg.norm(own, axis=1), np.array([-(2**62)]), np.array([2**62]), True, 5)
    walk.along(order, np.array([rows[i][1] for i in order]), vec[order], bounds, step=20)
    assert walk.looked_at < 200


def test_negatives_odd(ready):
    bad = [(1, 0, None), (2, None, [1.0, 0.0]), (3, 0, [1.0, None]), (4, 0, [float("nan"), 1.0]), (5, 0, [float("inf"), 1.0]), (None, 0, [1.0, 1.0]), (6, 1, [1e300, 0.0])]
    good = [(10, 0, [0.5, 0.25]), (11, 0, [0.5, 0.2]), (12, 1, [0.45, 0.2]), (13, 1, [-0.1, 0.001])]
    df = ready.createDataFrame(bad + good, "vec_id long, label int, embedding array<float>")
    clash = df.withColumns({c: F.lit("x") for c in ("id", "vec", "norm", "rid", "dim", "cluster", "part", "aid", "slot", "bound")})
    got = hard_negatives.mine(hard_negatives.items(clash, "vec_id", F.col("label"), hard_negatives.scaled(F.col("embedding"))), F.lit(True))
    whole = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in good]
    assert sorted(map(tuple, got.collect())) == brute_negatives(whole, {10, 11, 12, 13})
    none = df.limit(0)
    assert hard_negatives.mine(hard_negatives.items(none, "vec_id", F.col("label"), hard_negatives.scaled(F.col("embedding"))), F.lit(True)).count() == 0


# ---- periodic runs --------------------------------------------------------------------------------------------


def brute_runs(ws):
    n, out = len(ws), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(24, 3 * q) and not any(ws[s : e - d] == ws[s + d : e] for d in range(1, q)):
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating_text(rnd):
    ws = []
    for _ in range(rnd.randint(0, 5)):
        few = rnd.choice([2, 2, 3, 50])
        if rnd.random() < 0.5:
            root = [str(rnd.randrange(few)) for _ in range(rnd.choice([1, 2, 3, 7, 8, 9, 10, 11, 12, 13, 20, 33, 50, 81]))]
            m = rnd.randint(0, 5 * len(root) + 30)
            ws += (root * (m // len(root) + 1))[:m]
        else:
            ws += [str(rnd.randrange(few)) for _ in range(rnd.randint(0, 60))]
    return ws


def as_runs(texts):
    laid, found = periodic.find_runs(texts)
    got = [[] for _ in texts]
    for s, e, p in found.tolist():
        i = int(laid.text_of(np.array([s]))[0])
        got[laid.place[i]].append((s - int(laid.first[i]), e - s, p))
    return got


def test_runs_equal_brute_force():
    rnd = random.Random(5)
    seen = set()
    for _ in range(40):
        docs = [repeating_text(rnd) for _ in range(12)]
        want = [brute_runs(ws) for ws in docs]
        assert as_runs([" ".join(ws).encode() for ws in docs]) == want
        seen |= {r[2] for w in want for r in w}
    assert {1, 3, 8, 9, 13, 33} <= seen and max(seen) > 50


def test_runs_of_words_that_fool_rolling_hashes():
    """The Thue-Morse word and its complement collide under polynomial hashes modulo 2**64; it has no cubes, its third power is one run."""
    word = [0]
    while len(word) < 2048:
        word += [1 - x for x in word]
    text = lambda w: " ".join(map(str, w)).encode()
    assert as_runs([text(word), text(word * 3)]) == [[], [(0, 3 * 2048, 2048)]]


def changed(doc_id, text):
    """The words of a text as the query changes them."""
    ws = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(ws), h // 10
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def run_digests(ws):
    runs = brute_runs(ws)
    keep = [True] * len(ws)
    for s, m, q in runs:
        keep[s + q : s + m] = [False] * (m - q)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for w, k in zip(ws, keep) if k)))


def test_op12_equals_brute_force(ready, corpus):
    short = {i: t for i, t in corpus if len((t or "").split()) < 1500}
    assert len(short) > 150
    got = {r[0]: tuple(r)[1:] for r in queries.op12_periodic_runs(ready, SF).collect()}
    assert set(got) == {i for i, _ in corpus}
    assert {i: got[i] for i in short} == {i: run_digests(changed(i, t)) for i, t in short.items()}
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_runs_odd(ready, odd, empty):
    rows = periodic.periodic_runs(odd).collect()
    assert len(rows) == len(ODD_TEXTS) + 4
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert len(by_id[8]) == 3 and len(by_id[None]) == 2
    (long,) = by_id[11]
    assert [tuple(r) for r in long.runs] == [(0, 20_000, 1)] and long.collapsed == "Wort" and long.n_words == 20_000
    assert by_id[1][0].n_words == by_id[3][0].n_words == 0 and by_id[16][0].collapsed == "a b c d e f g h"
    strongest = periodic.periodic_runs(odd).select("doc_id", periodic.strongest(F.col("runs")).alias("best")).filter("doc_id = 2").first()
    assert strongest.best is None
    assert periodic.periodic_runs(empty).count() == 0
    assert queries.repeating(empty).count() == 0 and queries.repeating(odd).count() == len(rows)


def test_very_long_text(ready):
    root = [str(i % 70_001) for i in range(70_001)]
    text = " ".join(root * 3 + ["end"])
    df = ready.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.periodic_runs(df).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 210_003, 70_001)] and got[1].collapsed == " ".join([*root, "end"])


# ---- quality rules --------------------------------------------------------------------------------------------


def brute_repeats(ws):
    places = defaultdict(list)
    for i in range(len(ws) - 7):
        places[tuple(ws[i : i + 8])].append(i)
    return len({i + j for at in places.values() if len(at) > 1 for i in at for j in range(8)})


def test_figures_equal_brute_force():
    rnd = random.Random(2)
    texts = [" ".join(repeating_text(rnd)) for _ in range(60)] + [t or "" for _, t in ODD_TEXTS] + ["# a\nb\n\n# a\n b\nb\n# a", "é ß\x1c \x85 😀|"]
    figures = [f.tolist() for f in rules.batch_figures([t.encode() for t in texts])]
    for t, n, chars, symbols, equal, repeats in zip(texts, *figures):
        ws = t.encode().split()
        lines = [x for x in t.split("\n") if x.encode().strip()]
        assert (n, chars) == (len(ws), sum(len(w.decode()) for w in ws))
        assert symbols == sum(t.count(c) for c in "#*$%&|<>") and equal == len(lines) - len(set(lines)) and repeats == brute_repeats(ws)
    assert Laid([]).code.tolist() == [-1]


def test_op13_equals_sql(ready):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(queries.OP13_SQL)
    got = queries.op13_quality_rules(ready, SF).select(*rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


def test_rules_are_ordered_by_rejections_per_cost():
    # Rule 0 rejects most but is dear; rule 2 rejects only what rule 1 rejects.
    sets = {0b001: 50, 0b010: 20, 0b110: 10, 0b000: 20}
    assert rules.order_rules([10.0, 1.0, 0.9], sets) == [1, 0, 2]
    assert rules.order_rules([1.0, 1.0, 0.9], sets) == [0, 1, 2]
    assert sorted(rules.order_rules([0.0, 0.0], {})) == [0, 1]


def test_cascade_stops_at_the_first_rejection(ready, corpus):
    docs = ready.createDataFrame(corpus, "doc_id long, text string")
    judged = rules.judge(docs, sample_rows=50).collect()
    for r in judged:
        assert (r.failed_rule is None) == r.passed and (r.rules_tried == len(rules.RULES)) >= r.passed
    assert sum(r.rules_tried for r in judged if not r.passed) < len(rules.RULES) * sum(not r.passed for r in judged)
    # Any order keeps the same documents.
    again = rules.judge(docs, tuple(reversed(rules.RULES)), sample_rows=10).collect()
    assert {r.doc_id: r.passed for r in again} == {r.doc_id: r.passed for r in judged}


def test_clean_documents_are_kept(ready):
    label = {r.doc_id: r.quality for r in ready.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [r for r in queries.op13_quality_rules(ready, "/root/testdata/sf0.01").collect() if r.doc_id in label and r.n_words >= 20]
    good = [r.kept for r in judged if label[r.doc_id] == 1]
    poor = [r.kept for r in judged if label[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.97 and sum(poor) / len(poor) < 0.1


def test_rules_odd(ready, odd, empty):
    rows = rules.judge(odd).collect()
    assert len(rows) == len(ODD_TEXTS) + 4
    by_id = {r.doc_id: r for r in rows}
    assert tuple(by_id[1])[1:6] == (0, 0, 0, 0, 0) and by_id[11].n_repeat_words == 20_000 and by_id[11].failed_rule is not None
    assert rules.judge(empty).count() == 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_periodic_runs", "op13_quality_rules"])
def test_registered(name):
    assert name in queries.QUERIES
