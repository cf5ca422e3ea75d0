"""Substring dedup: Rabin-Karp hashes of every window of ``size`` words, counted in Spark.

A word goes if a window over it also starts earlier: in a document with a smaller
(doc_id, row) or before it in the same one. Windows are judged on the input.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm import repeats
from daygrain.llm.common import staged, table

SIZE, GRAM = 20, 8


def _without(text: bytes, gone: np.ndarray) -> bytes:
    return b" ".join(compress(text.split(), (~gone).tolist()))


WORDS = repeats.Unit(repeats.word_units, _without)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, with_text: bool = True
) -> DataFrame:
    """``docs`` with the words of repeated windows taken out of ``text``, and n_units (words),
    n_removed, n_spans, kept_sha256 and spans (maximal intervals of removed words).

    Kept words are joined by one space. Null texts stay null and count as empty; texts of
    fewer than ``size`` words lose nothing. Rows with equal or null keys are documents of
    their own, in the order of the input; null keys come first. Columns named as a result
    are replaced. Without ``with_text`` the text is left out.
    """
    units = repeats.word_units
    body = repeats.prepared(docs, key, text, "words")
    live = staged(repeats.live_runs(body, units, size, gram), "runs")
    kind = body.schema["doc_id"].dataType.simpleString()

    def windows(raw, contents, row_key, doc_id):
        words = units(raw)
        runs = repeats.runs_of(words, size, gram)
        places, of, _ = runs.windows(repeats.chosen(runs, contents))
        hashes = repeats.window_hashes(words, size, places)
        zeros = pa.array(np.zeros(len(places), np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(runs.anchor[of].view(np.int64)),
                pa.array(hashes.view(np.int64)),
                row_key.take(zeros),
                doc_id.take(zeros),
                pa.array(places),
            ],
            names=["anchor", "window", "row_key", "doc_id", "place"],
        )

    schema = f"anchor long, window long, row_key long, doc_id {kind}, place long"
    # of contents that share an anchor, the first document of each is enough
    rows = staged(repeats.picked(body, live.where("mixed AND is_first"), windows, schema), "windows")
    at = F.struct("doc_id", "row_key")
    first = rows.groupBy("anchor", "window").agg(F.min(at).alias("head"), F.max(at).alias("tail"))
    first = first.where("head.row_key <> tail.row_key")
    late = rows.join(first, ["anchor", "window"]).where("head.row_key <> row_key")
    marks = live.where("NOT is_first").selectExpr("row_key", "content", "CAST(NULL AS LONG) AS place")
    marks = marks.unionByName(late.selectExpr("row_key", "CAST(NULL AS LONG) AS content", "place"))
    return repeats.removed(body, marks, WORDS, size, gram, True, text, with_text)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document without the word windows that stand earlier in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs, with_text=False)
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")
