"""The language model: base scores against brute force, gradients, normalisation, held-out gain."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daygrain.llm import lm

from corpus import odd_rows, prose


def vocab(words, outputs=9):
    counts = Counter(words)
    top = sorted(counts, key=lambda w: (-counts[w], w))[:outputs]
    if lm.END not in top:
        top[-1] = lm.END
    tails = np.zeros((lm.TAILS, 2))
    for w, c in counts.items():
        if w not in top:
            tails[lm.tail_class(w)] += c, 1
    starts = np.array([0, 1, 3, 6, len(top)])
    total = tails[:, 0] + 0.5 * (tails[:, 1] + 1)
    return lm.Vocabulary(dict(counts), {w: i for i, w in enumerate(top)}, len(top), starts, total, sum(counts.values()), len(counts))


@pytest.fixture
def model():
    v = vocab([f"w{i % 13}".encode() for i in range(200)] + [lm.END] * 9)
    m = lm.Model.fresh(v, state=5)
    rng = np.random.default_rng(1)
    for a in m.arrays():
        a += rng.normal(0, 0.2, a.shape).astype(np.float32)
    return v, m


def doubled(m):
    return lm.Model(*[a.astype(np.float64) for a in m.arrays()], m.starts)


def test_probabilities_add_up_to_one(model):
    v, m = model
    n = v.n_out + lm.TAILS
    states = np.tile(np.random.default_rng(2).normal(size=(1, 5)).astype(np.float32), (n, 1))
    assert abs(np.exp(m.output(states, np.arange(n))).sum() - 1) < 1e-5


def test_gradients_match_differences(model):
    v, m = model
    m = doubled(m)
    rng = np.random.default_rng(3)
    ids = rng.integers(0, v.n_out + lm.TAILS, (6, 4))
    targets = rng.integers(0, v.n_out + lm.TAILS, 24)
    h = rng.normal(size=(4, 5))

    def value():
        states, kept = m.forward(ids, h)
        return m.output(states.astype(np.float64).reshape(-1, 5), targets).sum()

    states, kept = m.forward(ids, h)
    grads = {"ww": np.zeros_like(m.ww), "bw": np.zeros_like(m.bw)}
    m.output(states.reshape(-1, 5).astype(np.float64), targets, grads)
    dinputs, du = m.backward(kept, grads["states"].reshape(6, 4, 5))
    dx = np.zeros_like(m.x)
    np.add.at(dx, ids.ravel(), dinputs.reshape(24, -1))
    for array, grad in ((m.x, dx), (m.u, du), (m.wc, grads["wc"]), (m.bc, grads["bc"]), (m.ww, grads["ww"]), (m.bw, grads["bw"])):
        for at in rng.choice(array.size, 12):
            flat, step = array.reshape(-1), 1e-2
            old = flat[at]
            flat[at] = old + step
            up = value()
            flat[at] = old - step
            down = value()
            flat[at] = old
            assert abs((up - down) / (2 * step) - grad.reshape(-1)[at]) < 2e-2


def test_state_is_carried_across_windows(model):
    v, m = model
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, v.n_out + lm.TAILS, n) for n in (1, 2, 33, 64, 65, 200)]
    end = v.ids[lm.END]
    whole = lm.score(m, docs, end, steps=1000)
    for steps in (1, 7, 64):
        assert np.allclose(lm.score(m, docs, end, steps=steps), whole, atol=1e-3)
    alone = [lm.score(m, [d], end)[0] for d in docs]
    assert np.allclose(alone, whole, atol=1e-3)


def base(rows, learnt):
    text = lambda t: [*(t or "").encode().lower().split(), lm.END]
    counts = Counter(w for i, t in rows if learnt(i) for w in text(t))
    total = sum(counts.values())
    of = total + 0.5 * (len(counts) + 1)
    return [(len(text(t)), sum(counts[w] > 0 for w in text(t)), total, sum(math.log10((counts[w] + 0.5) / of) for w in text(t))) for _, t in rows]


def fold(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 5


@pytest.mark.parametrize("dictionary,outputs", [(1 << 17, 4096), (40, 12)])
def test_base_matches_brute_force_and_model_gains(spark, documents, monkeypatch, dictionary, outputs):
    """Also with most words outside the dictionary."""
    real = lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda c: real(c, dictionary, outputs))
    rng = random.Random(15)
    rows = [(i, prose(rng, rng.randint(20, 200), rng.choice(["en", "fr", "de"]))) for i in range(120)]
    rows += odd_rows() + [(5000, prose(rng, 5000))]
    df = documents(rows)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    held, learnt = F.coalesce(crc == 1, F.lit(False)), F.coalesce(crc != 1, F.lit(False))
    out, model = lm.score_documents(df.coalesce(2), held_out=held, learnt=learnt)
    got = sorted(out.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_tokens))
    want = base(rows, lambda i: fold(i) not in (None, 1))
    paired = sorted(zip(rows, want), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1][0]))
    for r, ((i, _), (n, known, total, score)) in zip(got, paired):
        assert (r.doc_id, r.held_out) == (i, fold(i) == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    held_out = [r for r in got if r.held_out and r.n_tokens > 20]
    if outputs > 100:
        assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_training_lowers_the_loss():
    rng = random.Random(16)
    docs = [lm.tokens(prose(rng, 60, rng.choice(["en", "fr"])).encode()) for _ in range(60)]
    v = vocab([w for d in docs for w in d], outputs=60)
    v.starts = np.array([0, 2, 10, 30, v.n_out])
    ids = [np.array([v.ids.get(w, v.n_out + lm.tail_class(w)) for w in d]) for d in docs]
    fresh = lm.Model.fresh(v)
    trainer = lm.Trainer(fresh.copy(), v.ids[lm.END])
    for _ in range(15):
        trainer.learn(ids)
    end = v.ids[lm.END]
    assert lm.score(trainer.m, ids, end).sum() > lm.score(fresh, ids, end).sum() + 100


def test_a_word_of_middling_rank_has_a_probability_of_its_own(spark):
    counts = [(f"w{i}".encode(), 9000 - i) for i in range(5000)] + [(lm.END, 50)]
    df = spark.createDataFrame([(bytearray(w), c, lm.tail_class(w)) for w, c in counts], "word binary, c long, tail int")
    v = lm.vocabulary(df)
    assert (v.n_out, len(v.starts) - 1, len(v.tail_total)) == (4096, 64, 64)
    assert v.ids[b"w3000"] < v.n_out and len(v.counts) == 5001


def test_nothing_to_learn_from_and_empty_table(spark, documents):
    out, _ = lm.score_documents(documents([(1, "a b"), (2, None)]), learnt=F.lit(False))
    assert [(r.n_known, r.train_tokens) for r in out.collect()] == [(0, 0), (0, 0)]
    out, _ = lm.score_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert out.collect() == []


def test_lanes_stay_filled_though_one_document_is_long():
    """Documents follow one another in a lane, each from a state of zero; before, most windows held one document alone."""
    rng = np.random.default_rng(17)
    docs = [rng.integers(0, 9, n) for n in [700, *rng.integers(1, 60, 900)]]
    windows = list(lm._windows(docs, 8, 32, 16))
    total = sum(map(len, docs))
    assert len(windows) <= total // (32 * 16) + 3
    seen = [[] for _ in docs]
    for inputs, targets, fresh, document, valid in windows:
        for t, lane in zip(*np.nonzero(valid)):
            d = seen[document[t, lane]]
            assert fresh[t, lane] == (not d) and inputs[t, lane] == (d[-1] if d else 8)
            d.append(targets[t, lane])
    assert [list(map(int, d)) for d in docs] == [list(map(int, d)) for d in seen]


def test_documents_in_one_lane_do_not_see_one_another(model):
    v, m = model
    rng = np.random.default_rng(18)
    docs = [rng.integers(0, v.n_out + lm.TAILS, n) for n in (5, 90, 1, 33, 64)]
    end = v.ids[lm.END]
    alone = [lm.score(m, [d], end)[0] for d in docs]
    flat = np.concatenate(docs)
    first = np.isin(np.arange(len(flat)), np.cumsum([0, *map(len, docs[:-1])]))
    states, _ = m.forward(np.where(first, end, np.roll(flat, 1))[:, None], np.zeros((1, 5), np.float32), first[:, None])
    logs = m.output(states.reshape(-1, 5), flat)
    assert np.allclose(np.add.reduceat(logs, np.flatnonzero(first)), alone, atol=1e-3)


def test_gradients_stop_at_the_start_of_a_document(model):
    v, m = model
    rng = np.random.default_rng(19)
    ids, targets = rng.integers(0, v.n_out + lm.TAILS, (6, 2)), rng.integers(0, v.n_out + lm.TAILS, 12)
    fresh = np.zeros((6, 2), bool)
    fresh[3, 0] = True
    states, kept = m.forward(ids, np.zeros((2, 5), np.float32), fresh)
    dstates = np.zeros_like(states)
    dstates[3:] = 1
    dinputs, _ = m.backward(kept, dstates)
    assert not dinputs[:3, 0].any() and dinputs[:3, 1].any()


def test_words_of_a_batch_are_those_of_its_texts():
    """Also of a slice, with white space of all kinds, nulls, and characters that only Unicode takes for blanks."""
    rng = random.Random(20)
    odd = ["", None, "  A\tb\x0bC\x0c\r\n", "x\x1cy\x85z\u00a0\u2003\u00c9", " \n ", "\x00 \x1f"]
    for texts in ([prose(rng, rng.randint(0, 300)) for _ in range(3000)], [rng.choice([*odd, prose(rng, 9)]) for _ in range(3000)]):
        for part in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(1700, 1000)):
            words, rows = lm.batch_words(part)
            got = [[] for _ in part]
            for word, row in zip(words.to_pylist(), rows.tolist()):
                got[row].append(word.encode())
            assert got == [lm.tokens(t and t.encode())[:-1] for t in part.to_pylist()]
    words, rows = lm.batch_words(pa.array([], pa.string()))
    assert (len(words), len(rows)) == (0, 0)


def test_the_last_windows_hold_many_documents():
    """A model that ended on one long document alone would lean towards it."""
    docs = [np.zeros(n, int) for n in (3000, *[20] * 200)]
    counts = [valid.sum() for *_, valid in lm._windows(docs, 8, 32, 128)]
    assert sum(counts) == 7000 and counts[0] == 32 and counts[-1] > 1000
