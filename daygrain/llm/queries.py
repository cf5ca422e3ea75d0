"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from daygrain.llm import (
    alignment,
    code_lloyd,
    decontaminate,
    embedding_dedup,
    html_extract,
    jaccard_join,
    langid,
    license_scan,
    lm,
    multi_index,
    oracles,
    packing,
    substring_dedup,
    suffix_dedup,
)

Query = Callable[[SparkSession, str], DataFrame]


def on_workers(query: Query) -> Query:
    """The query with this checkout on its workers' path, for sessions on this machine started elsewhere.

    On a cluster the library is shipped with the job (``--py-files``) and the path does no harm.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        root = str(Path(__file__).resolve().parents[2])
        if root not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_lm_score": on_workers(lm.query),
    "op2_decontaminate": on_workers(decontaminate.query),
    "op3_langid": on_workers(langid.query),
    "op4_suffix_dedup": on_workers(suffix_dedup.query),
    "op5_embedding_dedup": on_workers(embedding_dedup.query),
    "op6_license_scan": on_workers(license_scan.query),
    "op7_html_extract": on_workers(html_extract.query),
    "op8_substring_dedup": on_workers(substring_dedup.query),
    "op9_jaccard_join": on_workers(jaccard_join.query),
    "op10_packing": on_workers(packing.query),
    "op11_multi_index": on_workers(multi_index.query),
    "op12_code_lloyd": on_workers(code_lloyd.query),
    "op13_alignment": on_workers(alignment.query),
}

#: The others train a model, read a vocabulary file, or apply hundreds of patterns or rules.
ORACLES = {
    "op2_decontaminate": oracles.DECONTAMINATE,
    "op4_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op5_embedding_dedup": oracles.EMBEDDING_DEDUP,
    "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op9_jaccard_join": oracles.JACCARD_JOIN,
    "op12_code_lloyd": oracles.CODE_LLOYD,
}
