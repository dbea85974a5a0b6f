"""Every operator against brute force, an exact round trip or held-out accuracy, and on odd input."""

import random

import brute
import duckdb
import numpy as np
import pytest
from conftest import ODD_TEXTS
from pyspark.sql import functions as F

import __spark_entry__ as E
from kestrel.llm import ann, bpe_chunks, chat, exact_dedup, packing, pii, quality, queries, simhash, suffix_tree, token_counts
from kestrel.llm.encoders import SpacedEncoder, WordEncoder, default_path, encoder

SF = "/root/testdata/sf0.001"
WORD, BYTE = default_path(queries.WORD_BPE), default_path(queries.BYTE_BPE)


def odd_strings(n=3000):
    rnd = random.Random(1)
    parts = ["a", "Bc", "É", "ß", " ", "  ", "\n", "\t", " \n", " ", "　", "\x1c", "\x85", "'s", "'LL", "1", "²", "½", "٣", "ﬁ", "İ", "Σ", "é", "́",
             "<|endoftext|>", "<|startoftext|>", "<|", "...", ".", ",", "!", "😀", "中文", "ไทย", "‍", "\x00", "ǅ", "ª", "_", "-", " the", " and"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + [t for _, t in ODD_TEXTS if t is not None]


def test_encoders_equal_the_library(corpus):
    word, spaced = encoder(WordEncoder, WORD), encoder(SpacedEncoder, BYTE)
    chunked = bpe_chunks.ChunkEncoder(spaced, np.uint64(15))
    for text in [*odd_strings(), *(t for _, t in corpus)]:
        ids = word.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(word.encode(text), "<u4").tolist() == ids
        ids = spaced.tokenizer.encode(text, add_special_tokens=False).ids
        for got in (spaced.encode(text.encode()), chunked.encode(text.encode())):
            assert np.frombuffer(got, "<u4").tolist() == ids
        assert spaced.decode(got) == spaced.tokenizer.decode(ids, skip_special_tokens=False)


def test_equal_chunks_are_encoded_once(corpus):
    chunked = bpe_chunks.ChunkEncoder(encoder(SpacedEncoder, BYTE), np.uint64(63))
    passage = max((t for _, t in corpus), key=len)
    chunked.encode(passage.encode())
    before = chunked.encoded
    chunked.encode(("Another start. " + passage).encode())
    assert chunked.encoded - before <= 3 < before


def test_windows_hold_and_balance():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 1025, 1000)
    window, k = packing.windows(lengths)
    sums = np.bincount(window, weights=lengths, minlength=k)
    assert sums.max() <= packing.CAPACITY and 1 - lengths.sum() / (k * packing.CAPACITY) < 0.03
    assert sums.max() - sums.min() < 200
    assert packing.windows(np.array([4096]))[1] == 1


def check_pieces(pieces, texts):
    word = encoder(WordEncoder, WORD)
    docs = {i: word.encode(t or "") + (2).to_bytes(4, "little") for i, t in texts}
    import zlib

    for i, ids in docs.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        at = 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids) // 4
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[4 * p.start : 4 * at])
        assert at == len(ids) // 4
    used = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == used.get(p.sequence_id, 0)
        used[p.sequence_id] = p.offset + p.length
    assert max(used.values()) <= 4096
    return used


def test_packing(ready, corpus):
    check_pieces(queries.op1_packing(ready, SF).collect(), corpus)


def test_packing_odd(ready, odd, empty):
    pieces = packing.token_pieces(odd, WORD)
    packed = packing.pack(pieces, ["doc_id", "start"])
    once = [r for r in packed.filter("doc_id is not null and doc_id != 8").withColumn("ids_crc32", F.crc32("ids")).collect()]
    assert {r.doc_id for r in once} == {i for i, _ in ODD_TEXTS} - {8}
    sequences = packing.assemble(packed).collect()
    assert sum(s.length for s in sequences) == sum(len(s.ids) for s in sequences) // 4 == packed.agg(F.sum("length")).first()[0]
    assert packed.filter("doc_id = 8").count() == 3
    assert packing.pack(packing.token_pieces(empty, WORD), ["doc_id", "start"]).count() == 0


def test_token_counts(ready, corpus, odd, empty):
    spaced = encoder(SpacedEncoder, BYTE)
    n = np.array([len(spaced.encode((t or "").encode())) // 4 for _, t in corpus])
    rows = queries.op2_token_counts(ready, SF).collect()
    assert [r.n_tokens for r in sorted(rows)] == sorted(set(n.tolist()))
    for r in rows:
        assert r.truncated_total == np.minimum(n, r.n_tokens).sum() and r.docs_over == (n > r.n_tokens).sum()
        assert r.total_tokens == n.sum() and r.quantile == pytest.approx((n <= r.n_tokens).mean())
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(ready.read.parquet(f"{SF}/documents.parquet"), BYTE)))
    for r in token_counts.at_limits(sums, [0, 1, 100, 10**6]).collect():
        assert r.truncated_total == np.minimum(n, r.limit).sum() and r.docs_over == (n > r.limit).sum()
    assert token_counts.token_lengths(odd, BYTE).filter("n_tokens = 0").count() == 3
    assert token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(empty, BYTE))).count() == 0


def test_exact_dedup(ready, corpus, odd, empty):
    want = brute.exact_groups(corpus)
    got = queries.op3_exact_dedup(ready, SF).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in got} == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    rows = [r for r in exact_dedup.dedup(odd, ["doc_id"]).collect() if r.doc.doc_id is not None]
    assert {r.doc.doc_id: r.keep_id for r in rows} == {i: {2: 1, 7: 5, 17: 16}.get(i, i) for i, _ in ODD_TEXTS}
    assert sum(r.kept for r in rows if r.doc.doc_id == 8) == 1 and {r.group_size for r in rows if r.doc.doc_id == 8} == {3}
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 8").count() == 1 and kept.filter("doc_id in (7, 17)").count() == 0
    assert exact_dedup.dedup(empty, ["doc_id"]).count() == 0


def test_only_shared_prefixes_are_hashed_in_full(ready, corpus, odd):
    docs = ready.read.parquet(f"{SF}/documents.parquet")
    alone = exact_dedup.refine(docs, ["doc_id"]).filter("full_hash is null").count()
    shared = sum(size > 1 for _, size, _ in brute.exact_groups(corpus).values())
    assert 0 < alone <= len(corpus) - shared
    assert exact_dedup.refine(docs, ["doc_id"], length_slots=1).filter("full_hash is null").count() == alone
    assert exact_dedup.refine(docs, ["doc_id"], prefix_chars=0, length_slots=1).filter("full_hash is null").count() < alone
    # Rows of one length and prefixes of their own: none is read in full, far beyond what any number of length slots tells apart.
    many = ready.range(300_000).select(F.col("id").alias("doc_id"), F.format_string("%07d and the same end of every text", "id").alias("text"))
    assert exact_dedup.refine(many, ["doc_id"]).filter("full_hash is not null").count() == 0
    twice = many.unionByName(many.filter("doc_id < 1000"))
    assert exact_dedup.refine(twice, ["doc_id"]).filter("full_hash is not null").count() == 2000


def test_exact_dedup_beyond_the_broadcast(ready, corpus, odd, monkeypatch):
    plain = exact_dedup.refine
    monkeypatch.setattr(exact_dedup, "refine", lambda docs, carry: plain(docs, carry, broadcast_keys=0))
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in queries.op3_exact_dedup(ready, SF).collect()}
    assert got == brute.exact_groups(corpus)
    few = exact_dedup.keep_first(odd)
    monkeypatch.undo()
    assert few.columns == odd.columns and sorted(map(repr, few.collect())) == sorted(map(repr, exact_dedup.keep_first(odd).collect()))


def check_spans(got, texts):
    for i, text in texts:
        base = brute.personal(text)
        r = got[i]
        assert r.base_sha256 == brute.sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in base)), text
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[3] == k for b in base) for k in brute.KINDS]
        assert {f"{k}:{s}:{e}" for s, _, e, k in base} <= set(r.spans.split(","))


def test_personal_data(ready, corpus, odd, empty, tmp_path):
    check_spans({r.doc_id: r for r in queries.op4_pii(ready, SF).collect()}, corpus)
    rnd = random.Random(3)
    parts = ["a", "1", "22", "333", "4111111111111111", "@", "x.y", ".", "-", " ", "+", "(", "é", "😀", "1.2.3.4", "300.1.1.1", "a@b.c", "+1 234 567 8901", "_", "0004.1.1.1", "\n"]
    texts = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))) for i in range(500)] + [(1000 + i, t) for i, t in ODD_TEXTS]
    ready.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check_spans({r.doc_id: r for r in queries.op4_pii(ready, str(tmp_path)).collect()}, texts)
    clean = pii.sanitise(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert clean.filter("doc_id = 9").first().text == "<EMAIL>; <PHONE>; <CARD>; <IP>"
    assert pii.sanitise(empty).count() == 0


def test_telling_terms(ready):
    told = [(i, f"The account of Zephyrine Quill uses mail zq{0}@mail.org today and {w}") for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    rest = [(10 + i, f"The account of nobody uses the mail today and tomorrow {i}") for i in range(60)]
    found = pii.find(ready.createDataFrame(told + rest, "doc_id long, text string"), ["doc_id"]).collect()
    texts = dict(told + rest)
    for r in found:
        terms = {texts[r.doc.doc_id][s.start : s.end] for s in r.spans if s.kind == "term"}
        assert terms == ({"Zephyrine", "Quill"} if r.doc.doc_id < 10 else set())
    clean = {r.doc_id: r.text for r in pii.sanitise(ready.createDataFrame(told + rest, "doc_id long, text string")).collect()}
    assert clean[0] == "The account of   uses mail <EMAIL> today and alpha" and clean[10] == texts[10]


def terms_found(df, texts):
    return {r.doc.doc_id: [texts[r.doc.doc_id][s.start : s.end] for s in r.spans if s.kind == "term"] for r in pii.find(df, ["doc_id"]).collect()}


def test_telling_terms_are_found_anywhere_in_the_document(ready):
    far = "the usual words of no one at all " * 10
    told = [(i, f"Quill, case AB12 of Ng\U0001f600, wrote zq@mail.org. {'the usual words ' * i}{far}Then QUILL said so; {far}ng agreed on ab12.") for i in range(3)]
    rest = [(10 + i, f"{far}Then one wrote of mail and said so; all agreed on case org.") for i in range(60)]
    texts = dict(told + rest)
    df = ready.createDataFrame(told + rest, "doc_id long, text string")
    assert terms_found(df, texts) == {i: ["Quill", "AB12", "Ng", "QUILL", "ng", "ab12"] if i < 10 else [] for i in texts}
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == f", case  of \U0001f600, wrote <EMAIL>. {far}Then  said so; {far} agreed on ." and clean[10] == texts[10]


def test_telling_terms_beyond_other_matches(ready):
    """Between the entity and the name stand an unchecked match of its kind, or other entities of its kind."""
    told = [f"{w} card 4111 1111 1111 1111 exp 12/27 for Zebulon" for w in ("alpha", "beta")]
    told += [f"{w} Quill: +1 234 567 8901, +1 234 567 890{i}" for i, w in enumerate(("gamma", "delta"), 2)]
    told += [f"{w} a@x.org, b{i}@x.org - Quark" for i, w in enumerate(("one", "two"))]
    rest = [f"card exp 27 for org {w} {i}" for i in range(60) for w in ("12 x", "234 567 b")]
    texts = dict(enumerate(told + rest))
    found = terms_found(ready.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)
    for i, name in enumerate(("Zebulon", "Zebulon", "Quill", "Quill", "Quark", "Quark")):
        assert name in found[i]
    assert not any(found[i] for i in range(len(told), len(texts)))


def test_copies_are_no_evidence(ready):
    """A document with an address, its exact copy, and a near copy that differs elsewhere: nothing is told but the address."""
    one = "contact Zephyrine Quill about the offer at zq@mail.org or write to the office in Sundry Lane " + "some other words of the text " * 5
    rows = [(0, one), (1, one), (2, one + "and a new end")] + [(10 + i, f"the usual words about an offer {i}") for i in range(100)]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    assert not any(terms_found(df, dict(rows)).values())
    assert {r.doc_id: r.text for r in pii.sanitise(df).collect()}[1] == one.replace("zq@mail.org", "<EMAIL>")


def test_a_directory_counts_as_one_entity(ready):
    """Many addresses in the same documents, in different contexts: one row per document and term, not one per address and term."""
    rnd = random.Random(7)
    people = [f"p{i}@mail.org" for i in range(300)]
    rows = []
    for i in range(2):
        rnd.shuffle(people)
        rows.append((i, " , ".join(f"{p} of Orchard, seat {rnd.randint(0, 10**9)}" for p in people)))
    rows += [(10 + i, f"nothing of note {i}") for i in range(60)]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    scanned = pii.scan(df, ["doc_id"])
    near = pii.together(scanned, pii.entities(scanned), pii.term_documents(df), len(rows))
    assert 0 < near.count() <= 2 * 700
    assert set(terms_found(df, dict(rows))[0]) == {"Orchard", "seat"}


def test_long_texts_with_many_spans_and_told_terms(ready):
    """Thousands of addresses, each between names that tell it, in texts of several blocks; marks at both ends and side by side."""
    import re

    n = 4000
    listing = [f"Name{i} p{i}@mail.org," for i in range(n)]
    rows = [(j, ("\U0001f600 " * j).join([f"q{j}@x.org " + " ".join(listing[j:] + listing[:j]), " 10.0.0.1<>a@b.c"])) for j in (0, 1, 300)]
    rows += [(1000 + i, f"nothing of note {i} " + "é" * (256 * i)) for i in range(40)]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    for i, text in rows:
        marked = re.sub(r"[A-Za-z0-9]+@[a-z]+\.[a-z]+", "<EMAIL>", re.sub(r"10\.0\.0\.1", "<IP>", text)) if i < 1000 else text
        assert clean[i] == re.sub(r"Name[0-9]+", "", marked), i


def test_overlapping_spans_are_replaced_once(ready):
    """A phone number over an address and a card: one mark, of the first kind."""
    rows = [(1, "x +1 10.0.0.1 2345 y"), (2, "+12.3.4.5678901"), (3, "call +4111 1111 1111 1111"), (4, "1.2.3.4@x.org"), (5, "a@b.c")]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    for i, text in rows:
        want, at = "", 0
        for s, e, k in merged(brute.personal(text)):
            want, at = want + text[at:s] + f"<{k.upper()}>", e
        assert clean[i] == want + text[at:], text


def merged(spans):
    out = []
    for s, _, e, k in sorted(spans):
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, k])
    return out


def test_pairs_pruned_by_df_are_below_the_threshold(ready, corpus):
    """Terms of every document against a count without pruning, on documents that share invented addresses."""
    import math
    import re
    from collections import Counter, defaultdict

    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = [f"user{rnd.randint(0, 12)}@x.org" for _ in range(rnd.choice([0, 1, 1, 2]))]
        names = [f"N{o[4:-6]}{rnd.choice('abc')}" for o in own if rnd.random() < 0.9]
        words = own + names + [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 25))]
        rnd.shuffle(words)
        rows.append((i, " ; ".join(words)))
    held, df, both = defaultdict(set), Counter(), Counter()
    terms = {i: Counter(w.lower() for w in re.findall(r"[^\W_]+", t)) for i, t in rows}
    for i, t in rows:
        df.update(terms[i].keys())
        for s, _, e, k in brute.personal(t):
            held[k, t[s:e]].add(i)
    for e, ids in held.items():
        both.update((e, w) for i in ids for w in terms[i])
    tells = {(e, w) for (e, w), n in both.items() if n >= 2 and math.log2(n * len(rows) / (len(held[e]) * df[w])) / math.log2(len(rows) / len(held[e])) >= pii.GENERALISE}
    want = {}
    for i, t in rows:
        bad, spans = {w for e, w in tells if i in held[e]}, brute.personal(t)
        want[i] = [m[0] for m in re.finditer(r"[^\W_]+", t) if m[0].lower() in bad and not any(s <= m.start() and m.end() <= e for s, _, e, _ in spans)]
    assert any(want.values()) and terms_found(ready.createDataFrame(rows, "doc_id long, text string"), dict(rows)) == want


def test_lm_scores(ready, corpus, odd, empty):
    held = lambda i: brute.crc(i) % 5 == 1
    want = brute.base_scores(corpus, held)
    got = queries.op5_lm_score(ready, SF).collect()
    assert len(got) == len(corpus)
    for r in got:
        n, known, train, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    rows = suffix_tree.score(odd, F.lit(False)).collect()
    assert len(rows) == odd.count() and all(np.isfinite([r.score, r.base_score]).all() for r in rows)
    assert suffix_tree.score(empty, F.lit(False)).count() == 0
    unseen = suffix_tree.score(odd, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in unseen)


def test_lm_scores_equal_a_plain_tree(ready, corpus):
    held = lambda i: brute.crc(i) % 5 == 1
    want, states = brute.tree_scores(corpus, held, suffix_tree)
    got = {r.doc_id: r.score for r in queries.op5_lm_score(ready, SF).collect()}
    assert states > 50 and got.keys() == want.keys()
    for i, score in want.items():
        assert got[i] == pytest.approx(score, rel=1e-9)


def test_the_tree_grows_with_the_corpus(ready, monkeypatch):
    sizes, grow = [], suffix_tree.grow

    def watched(*args, **kw):
        tree = grow(*args, **kw)
        sizes.append((len(tree.own), sum(len(level.keys) for level in tree.levels)))
        return tree

    monkeypatch.setattr(suffix_tree, "grow", watched)
    for sf in ("sf0.01", "sf0.1"):
        suffix_tree.score(ready.read.parquet(f"/root/testdata/{sf}/documents.parquet"), F.lit(False))
    print(sizes)
    assert 1.5 * sizes[0][0] < sizes[1][0] and 2 * sizes[0][1] < sizes[1][1]
    # At any size: thresholds rise more slowly than the corpus, so there is room for ever more words and contexts.
    counts = [suffix_tree.least_count(10**k, 5e-4) for k in range(1, 14)]
    assert counts == sorted(counts) and all(10 * a > 2 * b for a, b in zip(counts[6:], counts[7:]))


def test_few_long_documents_have_a_bucket_for_every_block(ready, empty, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK_CHARS", 1000)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(400))) for i in range(6)]
    df = ready.createDataFrame([*rows, (None, None)], "doc_id long, text string")
    used, cut = [], suffix_tree.blocks
    monkeypatch.setattr(suffix_tree, "blocks", lambda docs, held_out, buckets: used.append(buckets) or cut(docs, held_out, buckets))
    assert suffix_tree.score(df, F.lit(False)).filter("train_tokens = 2407").count() == 7
    assert used[0] >= sum(len(t) for _, t in rows) / 1000
    assert suffix_tree.score(empty, F.lit(False)).count() == 0 and used[1] == 1


def test_tree_is_a_distribution_and_uses_longest_contexts(ready):
    rows = [(i, ("a b " * 30 + "c d " * 30).strip()) for i in range(50)]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    staged = suffix_tree.blocks(df, F.lit(False))
    own = {w: 2 + suffix_tree.ENDINGS + i for i, w in enumerate([b"a", b"b", b"c", b"d"])}
    counts = np.zeros(2 + suffix_tree.ENDINGS + 4)
    counts[-4:], counts[1] = 1500, 50
    tree = suffix_tree.grow(staged, own, counts / counts.sum(), counts, 50 * 121)
    assert len(tree.levels[0].keys) >= 4
    every = np.flatnonzero(counts)
    for context in ([own[b"a"]], [own[b"b"], own[b"a"]], [own[b"d"]]):
        p = [tree.predict(np.array([*context, s]), np.array([len(context)]), np.array([len(context)]))[0] for s in every]
        assert sum(p) == pytest.approx(1)
    assert tree.predict(np.array([own[b"a"], own[b"b"]]), np.array([1]), np.array([1]))[0] > 0.99


def test_bpe(ready, corpus, odd, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in queries.op6_bpe(ready, SF).collect()}
    import hashlib

    for i, text in corpus:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == brute.sha(t.decode(ids, skip_special_tokens=False))
    assert {r.doc_id: r.decoded for r in bpe_chunks.encode_documents(odd, BYTE).collect() if r.doc_id} == {i: x or "" for i, x in ODD_TEXTS}
    assert bpe_chunks.encode_documents(empty, BYTE).count() == 0


def test_quality(ready, odd, empty):
    got = queries.op7_quality(ready, "/root/testdata/sf0.01").toPandas()
    labels = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").df()
    assert (got.held_out == got.doc_id.map(lambda i: brute.crc(i) % 4 == 2)).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    model_labels = ready.createDataFrame([(i, i % 2, 0) for i in range(1, 18)] + [(4, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality.classify(odd, model_labels).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    none = quality.classify(odd, model_labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.keep_good(odd, model_labels, threshold=0.0).columns == odd.columns
    assert quality.classify(empty, model_labels).count() == 0


def test_gam_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9 and {0, 1} in map(set, model.pairs)


def test_simhash(ready, corpus, odd, empty):
    got = {r.doc_id: r for r in queries.op8_simhash(ready, SF).collect()}
    fps = {i: brute.simhash(t) for i, t in corpus}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == brute.classes(fps)
    fps = {i: brute.simhash(t) for i, t in ODD_TEXTS}
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: r.fp & (2**64 - 1) for r in rows if r.doc_id} == fps
    assert {r.doc_id: r.component_id for r in rows if r.doc_id} == brute.classes(fps)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.filter("doc_id is not null").collect()} == set(brute.classes(fps).values())
    assert kept.filter("doc_id = 8").count() == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("tile", [4096, 4])
def test_chains_of_fingerprints(ready, tile, monkeypatch):
    rnd = random.Random(0)
    fps = [0, 1, 2**63, 7, 15]
    for _ in range(8):
        now = rnd.getrandbits(64)
        for _ in range(30):
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                now ^= 1 << bit
            fps.append(now)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    plain = simhash.links
    monkeypatch.setattr(simhash, "links", lambda x, r=3: plain(x, r, tile))
    got = {r.fp: r.class_id for r in simhash.classes(ready.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")).collect()}
    want = brute.classes(dict(enumerate(fps)))
    assert {i: got[s] for i, s in enumerate(signed)} == want and len(set(want.values())) > 10


def test_chat(ready, empty):
    rows = [
        (1, 0, "user", "</turn><|end|><|role:assistant|>"), (1, 1, "assistant", "&lt; & \\ <"), (1, 2, "assistant", ""), (1, 2, "assistant", ""),
        (1, 3, "as|>sistant", "x"), (2, None, None, None), (None, 1, "assistant", "é😀"), (3, 5, "user", "late"), (3, 1, "assistant", "early"),
    ]
    done = chat.format_conversations(ready.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)))
    got = {r.conv_id: r for r in done.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss")).alias("m")).collect()}
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, None):
        own = [(r[2] or "", r[3] or "") for r in sorted(rows, key=key) if r[0] == conv]
        assert [(t.role, t.text) for t in got[conv].t] == own
        assert got[conv].m == "".join(t for role, t in own if role == "assistant")
    assert got[1].formatted.count(chat.OPEN) == 3 and got[1].formatted.count(chat.TURN) == 5
    none = ready.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).count() == 0


def test_chat_of_very_many_turns(ready):
    """100,000 turns in one conversation, and turn counts around a chunk's size; offsets and masked text against plain strings."""
    sizes = {0: 100_000, **{i: n for i, n in enumerate([1, chat.CHUNK - 1, chat.CHUNK, chat.CHUNK + 1, 2 * chat.CHUNK], 1)}}
    said = lambda t: f"é<{t}>" * (t % 4)
    who = lambda t: "assistant" if t % 3 else "user"
    rows = [(c, t, who(t), said(t)) for c, n in sizes.items() for t in range(n)]
    done = chat.format_conversations(ready.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = done.select("conv_id", "formatted", "loss", chat.masked_text(F.col("formatted"), F.col("loss")).alias("m")).collect()
    assert len(got) == len(sizes)
    for r in got:
        learnt = [said(t) for t in range(sizes[r.conv_id]) if t % 3]
        assert r.m == "".join(learnt)
        cut = [r.formatted[s.start : s.end] for s in r.loss]
        assert cut == [x.replace("<", "&lt;").replace(">", "&gt;") for x in learnt]


def test_nearest(ready):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    got = {}
    for r in queries.op10_ann(ready, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute.nearest(dict(rows), [i for i, _ in rows if i % 50 == 0])
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    assert np.allclose([s for x in got.values() for _, s in x], [s for q in got for _, s in want[q]], atol=1e-14)


def test_nearest_of_an_id_with_two_vectors(ready):
    rows = [(50, [0.0, 1.0]), (50, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (3, [0.2, 1.0]), (3, [0.2, 1.0])]
    every = ann.vectors(ready.createDataFrame(rows, "i long, v array<double>"), "i", "v")
    got = [(r["rank"], r.vec_id) for r in ann.nearest(every.filter("id = 50"), every).orderBy("rank").collect()]
    assert got == [(1, 2), (2, 3), (3, 3), (4, 1)]


def test_nearest_odd(ready):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1e300]), (4, [-1e-300, 0.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]),
            (11, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 1.0]), (12, [1.0, 1.0])]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = ann.vectors(df, "vec_id", "embedding")
    for block in (1000, 2):
        got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.nearest(v.filter("id in (1, 11, 7)"), v, 4, block, block).orderBy("query_id", "rank").collect()]
        assert got == [(1, 1, 2, 1.0), (1, 2, 2, 1.0), (1, 3, 12, 0.707107), (1, 4, 3, 0.0)]
    assert ann.nearest(v.limit(0), v.limit(0)).count() == 0


def test_long_texts_reach_a_task_a_few_at_a_time(ready):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    long = ready.range(0, 20, 1, 1).selectExpr("repeat('x', 1000000 + cast(id as int)) as text")
    got = [r.n for r in long.mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 20_000_000 and max(got) < 6_000_000


def test_tree_of_blocks_that_are_looked_at_in_pieces(ready):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in (np.arange(n) + (rng.random(n) < 0.1)) % 40) for n in (70_000, 0, 3, 9_000, 66_000)]
    assert len(texts[0].split()) > suffix_tree.PIECE
    rows = list(enumerate(texts))
    want, states = brute.tree_scores(rows, lambda i: i == 3, suffix_tree)
    assert states
    df = ready.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.score for r in suffix_tree.score(df, F.col("doc_id") == 3).collect()}
    assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(ready, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = E.queries()[name](ready, SF).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()[list(got.columns)]
    key = got.columns[0]
    assert got.sort_values(key).astype(str).values.tolist() == want.sort_values(key).astype(str).values.tolist()


def test_one_query_per_operator():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in E.queries()
