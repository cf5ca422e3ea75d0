"""License scan: ordered signature rules over normalised words.

Rules (see ``license_rules``) are tried in order of priority, and only those whose gate
word stands in the text. A detection that lies within the interval of a better one is
suppressed; detections that only overlap both stay. Base phrases are always reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import as_bytes, code_words, table, with_columns
from daygrain.llm.license_rules import BASE, RULES


@dataclass(frozen=True)
class Rule:
    rank: int
    gate: bytes
    weight: float
    label: str
    pattern: re.Pattern
    base: bool


def parse(base: str = BASE, rules: str = RULES) -> list[Rule]:
    """Rules in order. Patterns see words between single blanks and match whole words."""
    out = []
    for text, is_base in ((rules, False), (base, True)):
        for line in text.strip().splitlines():
            gate, weight, label, pattern = line.split(maxsplit=3)
            bounded = rf"(?<= )(?:{pattern.replace(chr(92) + 'w', '[^ ]')})(?= )"
            out.append(Rule(len(out), gate.encode(), float(weight), label, re.compile(bounded.encode()), is_base))
    return out


def detections(body: bytes, rules: list[Rule]) -> list[tuple[int, int, Rule]]:
    """Spans of the rules' matches in ``body`` that no span of a better rule contains; base spans all stay."""
    found: list[tuple[int, int, Rule]] = []
    base: list[tuple[int, int, Rule]] = []
    for rule in rules:
        spans = [m.span() for m in rule.pattern.finditer(body)]
        if rule.base:
            base += [(a, b, rule) for a, b in spans]
        else:
            found += [(a, b, rule) for a, b in spans]
    kept: list[tuple[int, int, Rule]] = []
    reach, best = -1, None
    # by start, longest first: a span lies in an earlier one if it ends no later than the farthest end so far
    found.sort(key=lambda d: (d[0], -d[1], d[2].rank))
    for a, b, rule in found:
        inside = [k for k in kept if k[1] >= b and k[2].rank <= rule.rank] if b <= reach else []
        if not inside:
            kept.append((a, b, rule))
            reach = max(reach, b)
    return kept + base


FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "places array<struct<word: long, words: long, label: string, weight: double>>"
)


def scan(docs: DataFrame, text: str = "text", rules: str = RULES, base: str = BASE) -> DataFrame:
    """``docs`` with the licenses that each text names, row by row.

    n_words, n_base (places of base phrases), first_word and last_word (least and greatest
    start of one; null without), base_labels and labels (distinct, sorted, joined by
    commas), score (the best weight of a place, 0 without) and places. A null or empty
    text has no words and no places. Columns named as a result are replaced.
    """
    place = pa.struct([("word", pa.int64()), ("words", pa.int64()), ("label", pa.string()), ("weight", pa.float64())])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(place))

    def run(texts: pa.Array) -> list[pa.Array]:
        ordered = parse(base, rules)
        gates = {r.gate for r in ordered}
        out = []
        for t in as_bytes(texts):
            words = code_words(t)
            hits = gates.intersection(words)
            found = []
            if hits:
                body = b" " + b" ".join(words) + b" "
                for a, b, rule in detections(body, [r for r in ordered if r.gate in hits]):
                    found.append((body.count(b" ", 0, a) - 1, body.count(b" ", a, b) + 1, rule))
                found.sort(key=lambda d: (d[0], d[2].rank))
            starts = [word for word, _, rule in found if rule.base]
            out.append(
                (
                    len(words),
                    len(starts),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted({r.label for _, _, r in found if r.base})),
                    ",".join(sorted({r.label for _, _, r in found})),
                    max((r.weight for _, _, r in found), default=0.0),
                    [{"word": w, "words": n, "label": r.label, "weight": r.weight} for w, n, r in found],
                )
            )
        return [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]

    return with_columns(docs, [text], FIELDS, run)


def query(spark, sf_dir: str) -> DataFrame:
    """Licenses named in every document."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.size("places").alias("n_places"),
    )
