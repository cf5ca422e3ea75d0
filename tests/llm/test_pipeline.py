"""The pipeline's stages on a small corpus, each against what its operator must do."""

import random
from collections import defaultdict

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from daygrain.llm import packing
from daygrain.llm.common import code_words

from corpus import odd_rows, prose


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(17)
    clean = [(i, prose(rng, 150, "en" if i % 2 else "fr"), "en" if i % 2 else "fr") for i in range(30)]
    item = prose(rng, 60)
    shared = prose(rng, 90)
    hit = " ".join(item.split(" ")[:14])
    rows = [*clean]
    rows += [(100, clean[0][1], "fr"), (101, clean[1][1] + " end", None)]
    rows += [(102, f"{prose(rng, 100)} {item}", "en"), (103, f"{prose(rng, 900)} {hit} {prose(rng, 30)}", "en")]
    rows += [(104, f"{prose(rng, 300)} {shared}", "en"), (105, f"{shared} {prose(rng, 300)}", "en")]
    rows += [(i, t, None) for i, t in odd_rows()]
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean"
    docs = spark.createDataFrame([(i, t, lang, "src", len(t or ""), None, False) for i, t, lang in rows], columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), [i for i, _, _ in clean], shared, hit


def test_stages(spark, tables, tmp_path):
    sf_dir, clean, shared, hit = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        out.write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert set(clean) <= set(kept[name])
        assert all(r.n_chars == len(r.text) and r.source == "src" and r.kept is False for r in kept[name].values())
    assert 1000 not in kept["language_id"] and 1003 not in kept["language_id"] and 1005 in kept["language_id"]
    assert 100 not in kept["near_duplicates"] and 101 not in kept["near_duplicates"]
    for i in (104, 105):
        assert shared in kept["near_duplicates"][i].text and shared not in kept["repeated_strings"][i].text
    assert 102 not in kept["decontamination"] and 103 in kept["decontamination"]
    after, before = (len(code_words(kept[s][103].text.encode())) for s in ("decontamination", "repeated_strings"))
    assert after == before - len(code_words(hit.encode()))

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    encoder = Tokenizer.from_file(packing.tokenizer_path())
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p.doc_id] += p.length
    for i, r in kept["decontamination"].items():
        assert lengths[i] == len(encoder.encode(r.text, add_special_tokens=False).ids) + 1
    assert set(lengths) == set(kept["decontamination"])


def test_passages_of_over_50_words_go(spark):
    """A passage of 51 words of usual length, shorter than 400 bytes, in documents that are otherwise unlike."""
    rng = random.Random(23)
    passage = " ".join(f"w{rng.randrange(1000):03d}" + "x" * (i % 3) for i in range(51))
    assert corpus_pipeline.PASSAGE < len(passage) < 400
    rows = [(i, f"{prose(rng, 200)} {passage} {prose(rng, 200)}") for i in range(3)]
    rows += [(10 + i, prose(rng, 300)) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    assert out.keys() == dict(rows).keys()
    for i, text in rows:
        assert passage not in out[i] and (text == out[i] or i < 3)


def test_run_gives_the_last_stage(spark, tables):
    sf_dir, clean, *_ = tables
    assert set(clean) <= {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
