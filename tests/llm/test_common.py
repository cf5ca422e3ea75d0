"""The Arrow pass that operators share."""

import pyarrow as pa

from daygrain.llm.common import ROWS_AT_ONCE, with_columns


def test_with_columns_hands_on_stretches_of_a_batch(spark):
    """A batch of many rows is not held twice over: each stretch is computed and handed on before the next."""
    n = 2 * ROWS_AT_ONCE + 17
    docs = spark.range(n, numPartitions=1).selectExpr(
        "id AS doc_id", "IF(id % 7 = 0, NULL, repeat('x', int(id % 5))) AS text", "array(id, NULL) AS more", "'old' AS seen"
    )

    def lengths(texts):
        sizes = [None if t is None else len(t) for t in texts.to_pylist()]
        return [pa.array([len(texts)] * len(texts), pa.int64()), pa.array(sizes, pa.int64())]

    rows = with_columns(docs, ["text"], "seen long, size long", lengths).collect()
    assert [r.doc_id for r in rows] == list(range(n))
    assert {r.seen for r in rows} == {ROWS_AT_ONCE, 17}
    for r in rows:
        assert r.text == (None if r.doc_id % 7 == 0 else "x" * (r.doc_id % 5)) and r.more == [r.doc_id, None]
        assert r.size == (None if r.text is None else len(r.text))


def test_with_columns_of_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert with_columns(empty, ["text"], "size long", lambda texts: [pa.array([], pa.int64())]).collect() == []
