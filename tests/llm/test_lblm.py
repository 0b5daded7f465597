import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from closeledger.llm import lblm


def _words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def _base(rows, learn):
    counts = Counter()
    for d, t in rows:
        if learn(d):
            counts.update(_words(t))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        words = _words(t)
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out[d, t] = (len(words), sum(counts[w] > 0 for w in words), n, score)
    return out


def test_base_matches_brute_force_and_model_beats_it(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: x for (d, _), x in _base(rows, lambda d: zlib.crc32(str(d).encode()) % 5 != 1).items()}
    got = lblm.op3_log_bilinear(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-9 * abs(base)
    assert np.isfinite([r.score for r in got]).all()


def test_rare_words_meet_their_counts(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(lblm, "HEAD", 2)
    want = _base([(r[0], r[1]) for r in odd_rows], lambda d: d != 0)
    learn = F.coalesce(F.col("doc_id") != 0, F.lit(True))
    got = lblm.scored(odd, learn, F.col("doc_id"), F.col("text").alias("t")).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        n, known, total, base = want[r.doc_id, r.t]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)


def test_empty_tables(odd, nothing):
    assert lblm.scored(nothing, F.lit(True), F.col("doc_id")).count() == 0
    rows = lblm.scored(odd, F.lit(False), F.col("doc_id")).collect()
    assert len(rows) == odd.count() and all(r.train_tokens == 0 and r.n_known == 0 for r in rows)


def test_probabilities_sum_to_one():
    model = lblm.LogBilinear(np.full(20, 0.05))
    one, two = np.full(20, 3), np.full(20, 7)
    assert abs((10 ** model.log10(one, two, np.arange(20))).sum() - 1) < 1e-4
    counts = lblm.Counts(100, 11, 10, {b"a": 0, b"b": 1}, np.array([40, 20]))
    shares = counts.other_share(np.array([0] + [4] * 5 + [3] * 3 + [1]))  # unseen, then nothing left over
    assert (10**shares).sum() > 0.9


def test_training_learns_an_order(spark):
    rows = spark.createDataFrame([(i, "a b c d " * 400) for i in range(8)], "doc_id long, text string")
    r = lblm.scored(rows, F.lit(True), F.col("doc_id")).first()
    assert r.score > r.base_score


def test_probabilities_of_classed_words_sum_to_one(monkeypatch):
    monkeypatch.setattr(lblm, "FLAT", 8)
    monkeypatch.setattr(lblm, "MEMBERS", 5)
    model = lblm.LogBilinear(np.full(20, 0.05))
    one, two = np.full(20, 3), np.full(20, 17)
    assert len(model.q) == 11 and len(model.m) == 12
    assert abs((10 ** model.log10(one, two, np.arange(20))).sum() - 1) < 1e-4


def test_rarer_words_are_modelled_and_gain_on_held_out_texts(spark):
    """2,000 words, nearly equally common, each followed by one of its own two:
    the order of words beyond the commonest 510 is learned."""
    rng = np.random.default_rng(4)
    follows = rng.permutation(2000)[:, None], rng.permutation(2000)[:, None]
    follows = np.concatenate(follows, axis=1)
    texts = []
    for i in range(120):
        at, words = int(rng.integers(2000)), []
        for _ in range(3000):
            words.append(f"w{at}")
            at = int(follows[at, rng.integers(2)])
        texts.append((i, " ".join(words)))
    rows = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    got = lblm.scored(rows, F.col("doc_id") < 100, F.col("doc_id")).where("doc_id >= 100").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.6 * got[1], got  # both negative; 512 tokens gave 0.94


def test_common_words_are_the_largest_counts_with_ties_by_word(spark, monkeypatch):
    """More words of one count than fit leave a vocabulary all the same."""
    from closeledger.llm import lblm

    monkeypatch.setattr(lblm, "HEAD", 3)
    table = [(w, 200_000) for w in ("e", "b", "é", "a", "d")] + [("rare", 1), ("twice", 2)]
    counts = lblm.counts_of(spark.createDataFrame(table, "word string, c long"), 7)
    assert counts.words == {b"a": 0, b"b": 1, b"d": 2} and counts.vocabulary == 3
    assert (counts.tokens, counts.distinct) == (1_000_010, 8)
    monkeypatch.setattr(lblm, "HEAD", 40)
    table = [(f"w{i:03d}", 300_000 + i % 50) for i in range(100)] + [(f"x{i}", 250_000) for i in range(5)]
    counts = lblm.counts_of(spark.createDataFrame(table, "word string, c long"), 0)
    want = sorted(table, key=lambda r: (-r[1], r[0]))[:40]
    assert list(counts.words) == [w.encode() for w, _ in want] and counts.c.tolist() == [c for _, c in want]
    assert lblm.counts_of(spark.createDataFrame([("one", 1)], "word string, c long"), 0).vocabulary == 0


def test_normaliser_is_the_sum_over_direct_tokens_and_classes(monkeypatch):
    """In blocks of any size, and where products of exponentials are too small."""
    monkeypatch.setattr(lblm, "PRODUCT", 11)
    rng = np.random.default_rng(2)
    model = lblm.LogBilinear(rng.random(700))
    model.r[:, :-1] *= 20
    model.q[:, :-1] *= 20
    model.r[5] = 0
    model.r[5, 0], model.r[6, 0] = 300, -300  # the largest of either are far apart
    model.q[:, 0] = rng.normal(size=len(model.q))
    one, two, target = rng.integers(0, 12, (3, 500))
    logits = (model.predicted(one, two) @ model.q.T).astype(np.float64)
    most = logits.max(axis=1)
    norm = most + np.log(np.exp(logits - most[:, None]).sum(axis=1))
    want = (logits[np.arange(500), lblm.top(target)] - norm) / np.log(10)
    assert np.allclose(model.log10(one, two, target), want, rtol=1e-4, atol=1e-3)
    pairs = np.unique(one * model.size + two)
    assert np.isinf(model.normaliser(pairs // model.size, pairs % model.size)).any()


def test_gradients_of_a_row_are_added_whatever_their_number():
    rng = np.random.default_rng(3)
    rows = np.concatenate([np.full(300, 4), np.full(9, 7), np.full(8, 2), rng.integers(0, 50, 200)])
    grads = rng.normal(size=(len(rows), 3))
    p, s, used = np.zeros((60, 3)), np.zeros((60, 3)), np.zeros(60, np.int64)
    lblm._add(p, s, used, rows, lambda i: grads.take(i, axis=0))
    sums = np.zeros((60, 3))
    np.add.at(sums, rows, grads)
    assert np.allclose(s, sums**2) and used.tolist() == np.bincount(rows, minlength=60).tolist()
    assert np.allclose(p, lblm.RATE * np.sign(sums), atol=1e-4)


def test_a_task_scores_several_slices_alike(spark):
    text = "abcdefghijkl mnopqrstuvwx " * 100_000  # 2.6 MB, a slice holds 4 MB
    rows = spark.createDataFrame([(0, "abcdefghijkl mnopqrstuvwx " * 50), (1, text), (2, text), (3, text)], "doc_id long, text string").coalesce(1)
    got = lblm.scored(rows, F.col("doc_id") == 0, F.col("doc_id")).where("doc_id > 0").collect()
    assert len(got) == 3 and {(r.n_tokens, r.n_known) for r in got} == {(200_001, 200_001)}
    assert len({r.score for r in got}) == 1


def test_words_and_contexts_of_a_slice():
    """As Python's own split of bytes, at every ASCII character; no context
    reaches into the text before."""
    odd = "".join(f"A{chr(i)}" for i in range(128)) + "É\x85é  　x"
    texts = [" \t\n", odd, "", "a  b\x0b\x0cC ", "d"]
    words, sizes = lblm.words_of(lblm.pa.array(texts, lblm.pa.string()))
    want = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode()).split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for t in want for w in t]
    assert sizes.tolist() == list(map(len, want))
    found, one, two = lblm.model_tokens(np.array([0, 5, 1, 2]), np.array([0, 3, 0, 1]), 3)
    assert found.tolist() == [0, 2, 1, 3, 0, 0, 4, 0]
    assert one.tolist() == [0, 0, 2, 1, 3, 0, 0, 4] and two.tolist() == [0, 0, 0, 2, 1, 0, 0, 0]


def test_scoring_holds_vectors_of_few_targets():
    """Memory of a slice grows by few bytes a target, not by its vectors."""
    import tracemalloc

    rng = np.random.default_rng(5)
    model = lblm.LogBilinear(rng.random(3000))
    n = 400_000
    one, two, target = rng.integers(0, 3000, (3, n))
    want = model.log10(one[:1000], two[:1000], target[:1000])  # makes the tables
    tracemalloc.start()
    got = model.log10(one, two, target)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got[:1000], want, atol=1e-4)
    assert most < 60 * n + (16 << 20), most  # a vector alone is 100 bytes
