"""The license scan: base phrases against brute force, rules, suppression and odd rows."""

import random

import pytest

from daygrain.llm import license_scan
from daygrain.llm.common import code_words

from corpus import odd_rows, prose

PHRASES = {b"gnu general public license": "gpl", b"apache license": "apache", b"cc by": "cc-by", b"mit license": "mit"}


def brute(text):
    words = code_words((text or "").encode())
    hits, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                hits.append(i)
                labels.add(label)
    return len(words), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force(spark, documents):
    rng = random.Random(14)
    rows = odd_rows()
    for i in range(40):
        text = prose(rng, rng.randint(0, 80))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(text) + 1)
            text = f"{text[:at]} {rng.choice(['MIT License', 'Apache-License, v2', 'CC BY-SA 4.0', 'CC-BY', 'GNU General Public License', 'mit'])} {text[at:]}"
        rows.append((i, text))
    rows += [(900, "CC BY CC BY cc by"), (901, "MIT License" * 3), (902, "mit license " * 20000)]
    got = sorted(license_scan.scan(documents(rows)).collect(), key=lambda r: r.row_key)
    for r, (_, text) in zip(got, rows):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) == bool(r.places)
        assert r.kept.startswith("own")


RULES = license_scan.parse()


def labels(text):
    body = b" " + b" ".join(code_words(text.encode())) + b" "
    return {rule.label for _, _, rule in license_scan.detections(body, RULES) if not rule.base}


@pytest.mark.parametrize("text,label", [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0-only"),
    ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
    ("GNU Affero General Public License version 3", "agpl-3.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the BSD 3-Clause", "bsd-3-clause"),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa"),
    ("http://creativecommons.org/licenses/by-nc/4.0", "cc-by-nc"),
    ("Mozilla Public License 2.0", "mpl-2.0"),
    ("All rights reserved.", "proprietary"),
])
def test_rules(text, label):
    assert label in labels(text)


def test_contained_detections_are_suppressed():
    assert labels("GNU General Public License version 3") == {"gpl-3.0"}
    assert labels("GNU Lesser General Public License version 2.1") == {"lgpl-2.1"}
    assert labels("CC BY-NC-SA 4.0") == {"cc-by-nc-sa"}
    assert labels("no license at all") == set()


def test_every_rule_is_gated_by_a_word_of_its_matches():
    assert len(RULES) > 200
    for rule in RULES:
        assert rule.gate.decode() in rule.pattern.pattern.decode() or rule.label == "openrail", rule


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
