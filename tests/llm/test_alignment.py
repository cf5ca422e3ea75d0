"""Alignment against a definition that tokenises whole texts and compares all pairs of tokens."""

import hashlib
import random
from collections import Counter

import pytest

from daygrain.llm import alignment as al

from corpus import odd_rows, prose

PATHS = al.tokenizer_paths()


@pytest.fixture(scope="module")
def tokenizers():
    return al.Spaced(PATHS[0]), al.Pieces(PATHS[1])


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def aligned(tokenizers, text):
    """(ids of A, ids of B, groups, links) of a whole text; None without tokens."""
    if not text:
        return None
    a, b = tokenizers[0].encode([text])[0], tokenizers[1].encode([text])[0]
    bytes_a, bytes_b = [tokenizers[0].bytes[i] for i in a], [tokenizers[1].bytes[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
        return None
    spans_a, spans_b = spans(bytes_a), spans(bytes_b)
    links = [(a[n], b[m]) for n, x in enumerate(spans_a) for m, y in enumerate(spans_b) if x[1] == y[1]]
    cuts = sorted({x[1] for x in spans_a} & {y[1] for y in spans_b})
    groups, low = [], 0
    for cut in cuts:
        inside = [[str(i) for i, s in zip(ids, of) if low < s[1] <= cut] for ids, of in ((a, spans_a), (b, spans_b))]
        groups.append("|".join(",".join(x) for x in inside))
        low = cut
    return a, b, ";".join(groups), links


def expected(found):
    if found is None:
        return "", b"", 0, 0
    a, b, groups, links = found
    return groups, b"".join((x << 32 | y).to_bytes(8, "little") for x, y in links), len(a), len(b)


def brute(tokenizers, rows):
    """Result rows of (key, text) rows."""
    found = [aligned(tokenizers, t) for _, t in rows]
    counts = Counter(link for f in found if f for link in f[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (key, _), f in zip(rows, found):
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        best, total = sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)
        sha = hashlib.sha256(groups.encode()).hexdigest()
        out.append((key, len(a), len(b), groups.count(";") + 1, len(links), best, total, sha))
    return out


ODD = [
    " ", "  a", "a  b", "a \n b", "a\nb c\r\nd", "it's we'll 'tis", "x... !? wow!!!", "1 22 333,4", "tab\there", "nbsp x   y",
    "sep\x1fa \x1f b \x85 c", "é è ü ß ñ", "<|endoftext|> a <|endoftext|>", "<s> </s> <unk> <0x41>", "　wide 　", "日本 語 です。",
    "emoji 😀 😀!! á b é", "a" * 3000, "a▁b ▁ c", "\x00 a\x00b", " lead", "trail ", "ﬁ ² Ⅷ", "many    spaces     here", "\n\n\n", "▁",
]


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("text", ODD)
def test_chunks_align_like_whole_texts(tokenizers, text):
    by_chunk, whole = al.Aligner(*tokenizers)([text])[0], al.Aligner(*tokenizers, whole=True)([text])[0]
    want = aligned(tokenizers, text)
    for m in (by_chunk, whole):
        assert m == expected(want)


def test_random_text(tokenizers, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 40)
    monkeypatch.setattr(al, "REMEMBERED", 50)
    rng = random.Random(3)
    one = al.Aligner(*tokenizers)
    for _ in range(100):
        alphabet = "ab é\n\t .,'s1²!日\x1f" + rng.choice(["", "▁"])
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(5)]
        assert one(texts) == [expected(aligned(tokenizers, t)) for t in texts], texts


@pytest.mark.parametrize("common,hot", [(1 / (1 << 18), 1 / 256), (0.01, 0.2), (2.0, 2.0), (0.0, 0.0)])
def test_measures_match_brute_force(spark, documents, tokenizers, monkeypatch, common, hot):
    monkeypatch.setattr(al, "COMMON", common)
    monkeypatch.setattr(al, "HOT_SHARE", hot)
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(1, 60), rng.choice(["en", "fr", "de"]))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(200 + i, t) for i, t in enumerate(ODD)] + odd_rows()
    rows += [(400 + i, "a▁b") for i in range(20)]  # many copies without tokens
    docs = documents(rows).repartition(5)
    same(al.measures_of(docs, al.align_corpus(docs, *PATHS)).collect(), brute(tokenizers, rows))


def test_columns_and_query(spark, documents, tokenizers, tmp_path):
    rows = [(1, "one two"), (2, None), (3, "one two"), (4, "")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = al.query(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in al.MEASURES], ("groups_sha256", "string")]
    same(got.collect(), brute(tokenizers, rows))


def test_long_and_empty_texts_keep_their_places(tokenizers, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 30)
    monkeypatch.setattr(al, "CHUNKS", 7)
    texts = ["a b", "", "word " * 50 + "end", "", "c", "x▁y", "one two three four five six seven eight", "z"]
    assert al.Aligner(*tokenizers)(texts) == [expected(aligned(tokenizers, t)) for t in texts]


def test_each_distinct_text_is_tokenised_once(spark, documents):
    text = "the same words"
    docs = documents([(i, text) for i in range(50)]).repartition(7)
    found = al.align_corpus(docs, *PATHS)
    assert [r.documents for r in found.texts.collect()] == [50]
    assert all(r.n % 50 == 0 for r in found.pairs.collect())


def test_every_id_has_bytes(tokenizers):
    assert all(all(t.bytes) for t in tokenizers)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert al.measures_of(docs, al.align_corpus(docs, *PATHS)).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert len(al.measures_of(docs, al.align_corpus(docs, *PATHS)).collect()) == 2
