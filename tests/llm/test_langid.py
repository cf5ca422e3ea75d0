"""Language identification: held-out accuracy, mixtures and odd rows."""

import math
import random

import numpy as np
import pytest

from daygrain.llm import langid

from corpus import odd_rows, prose


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(10)
    rows = [(prose(rng, rng.randint(20, 200), lang), lang) for lang in ("en", "fr", "de") for _ in range(40)]
    rows += [(None, "en"), ("x", None), (None, None), ("", "fr")]
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def test_held_out_accuracy(spark, documents, model):
    rng = random.Random(11)
    truth = [rng.choice(["en", "fr", "de"]) for _ in range(90)]
    rows = [(i, prose(rng, rng.randint(5, 120), lang)) for i, lang in enumerate(truth)]
    got = sorted(langid.identify(documents(rows), model).collect(), key=lambda r: r.row_key)
    assert sum(r.lang_pred == t for r, t in zip(got, truth)) >= 88
    assert all(0 <= r.score <= 1 and r.kept.startswith("own") for r in got)


def test_mixtures_are_found(spark, documents, model):
    rng = random.Random(12)
    rows = [(0, prose(rng, 300, "en")), (1, prose(rng, 200, "en") + " " + prose(rng, 100, "de")), (2, prose(rng, 100, "fr") * 40)]
    got = sorted(langid.identify(documents(rows), model).collect(), key=lambda r: r.doc_id)
    assert set(got[0].mixture) == {"en"}
    assert set(got[1].mixture) == {"en", "de"} and 0.55 < got[1].mixture["en"] < 0.8
    assert got[2].lang_pred == "fr" and got[2].score > 0.95


def test_odd_rows(spark, documents, model):
    rows = odd_rows()
    got = sorted(langid.identify(documents(rows), model).collect(), key=lambda r: r.row_key)
    for r, (_, text) in zip(got, rows):
        blank = not any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == blank and (r.score == 0) == blank and bool(r.mixture) != blank
    assert got[9].score == got[13].score


def test_no_labels_and_empty_table(spark, documents):
    nothing = langid.train(spark.createDataFrame([("a", None)], "text string, lang string"))
    assert [r.lang_pred for r in langid.identify(documents([(1, "word")]), nothing).collect()] == ["und"]
    assert langid.identify(spark.createDataFrame([], "doc_id long, text string"), nothing).collect() == []


def test_counts_equal_a_plain_count(spark, monkeypatch):
    """Cells of a plain loop over bytes, and texts longer than a block."""
    texts = [("Ab cé! x", "p"), ("z", "p"), ("ab " * 200, "q")]
    monkeypatch.setattr(langid, "BLOCK", 64)
    got = langid.train(spark.createDataFrame(texts, "text string, lang string"))
    for i, lang in enumerate(got.languages):
        for j, order in enumerate(langid.ORDERS):
            cells = np.full(1 << got.bits, langid.SMOOTHING)
            for text, of in texts:
                if of == lang:
                    low = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in text.encode())
                    unit = b" " + low + b"   "
                    parts = len(unit) - max(langid.ORDERS) + 1
                    for a in range(parts):
                        code = int.from_bytes(unit[a : a + order], "big")
                        cells[((code * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - got.bits)] += 1
            seen = np.exp(got.log_p[j][:, i])
            if len(texts) and lang == "p":
                # joined by blanks and padded once: the blanks at the seams differ, the words' cells don't
                assert np.corrcoef(seen, cells / cells.sum())[0, 1] > 0.9


def test_selection_keeps_languages_that_pay(model):
    rng = np.random.default_rng(13)
    likelihood = rng.normal(0, 1, (50, 3)).astype(np.float32)
    likelihood[:, 0] += 8
    shares, counts = model.mixtures(likelihood, np.array([30, 20]))
    assert (shares[:, 0] == 1).all() and counts.sum() == 50
    likelihood[:10, 1] += 30
    shares, _ = model.mixtures(likelihood, np.array([30, 20]))
    assert abs(shares[0, 1] - 1 / 3) < 0.05 and shares[1, 0] == 1


def plain_words(model, text):
    """Log-likelihoods of words, gram by gram."""
    low = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in b" " + text.encode() + b"   "]
    starts = [i for i in range(1, len(low)) if low[i] != 32 and low[i - 1] == 32]
    out = []
    for a, b in zip(starts, [*starts[1:], len(low) - max(langid.ORDERS) + 1]):
        sums = [0.0] * len(model.languages)
        for table, order in zip(model.log_p, langid.ORDERS):
            for at in range(a, b):
                code = int.from_bytes(bytes(low[at : at + order]), "big")
                cell = ((code * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - model.bits)
                sums = [s + float(p) for s, p in zip(sums, table[cell])]
        out.append([s / len(langid.ORDERS) for s in sums])
    return out


def plain_em(rows, active):
    """Shares, log-likelihood and words per language after the fixed number of steps."""
    shares = {k: 1 / len(active) for k in active}
    for _ in range(langid.STEPS):
        of = dict.fromkeys(active, 0.0)
        for row in rows:
            total = sum(shares[k] * math.exp(row[k]) for k in active)
            for k in active:
                of[k] += shares[k] * math.exp(row[k]) / total
        shares = {k: of[k] / sum(of.values()) for k in active}
    return shares, sum(math.log(sum(shares[k] * math.exp(row[k]) for k in active)) for row in rows), of


def plain_mixture(likelihood):
    """The set of languages of the greatest penalised likelihood among each alone and those met when the least is taken away."""
    rows = [[x - max(row) for x in row] for row in likelihood]
    languages = list(range(len(rows[0])))
    cost = langid.PENALTY * math.log(len(rows) + 1)
    alone = [sum(row[k] for row in rows) for k in languages]
    best = max(languages, key=lambda k: (alone[k], -k))
    found = (alone[best], {best: 1.0})
    active = languages
    while len(active) > 1:
        shares, value, _ = plain_em(rows, active)
        if value - (len(active) - 1) * cost > found[0]:
            found = (value - (len(active) - 1) * cost, shares)
        least = min(active, key=lambda k: (shares[k], k))
        active = [k for k in active if k != least]
    return found[1]


def test_words_match_a_plain_definition(model):
    rng = random.Random(14)
    for text in [prose(rng, 20, "de"), "é", "a b", "  Word, WORD!  ", "x9y Ü-ß", prose(rng, 3, "fr")]:
        got, want = model.words(text.encode()), plain_words(model, text)
        assert got.shape == (len(want), 3) and np.allclose(got, want, atol=1e-3)


@pytest.mark.parametrize("seed", range(4))
def test_mixtures_match_a_plain_definition(model, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        parts = [prose(rng, rng.choice([1, 5, 30, 90]), lang) for lang in rng.sample(["en", "fr", "de"], rng.randint(1, 3))]
        texts.append(" ".join(parts))
    words = [model.words(t.encode()) for t in texts]
    shares, counts = model.mixtures(np.concatenate(words), np.array([len(w) for w in words]))
    for row, of, w in zip(shares, counts, words):
        want = plain_mixture(w.astype(float).tolist())
        assert {k for k in range(3) if row[k] > 0} == set(want)
        assert all(abs(row[k] - share) < 2e-3 for k, share in want.items())
        assert abs(of.sum() - len(w)) < 1e-2
