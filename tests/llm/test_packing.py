"""Packing: an exact round trip of ids, and little padding."""

import json
import random
import struct
import unicodedata
import zlib
from collections import defaultdict
from pathlib import Path

import pytest
from tokenizers import Tokenizer

from daygrain.llm import packing
from daygrain.llm.byte_level import ByteLevel, _is_plain

from corpus import odd_rows, prose

PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def encoder():
    """The tokenizer as its library loads it."""
    return Tokenizer.from_file(PATH)


def plain(encoder, text):
    return encoder.encode(text, add_special_tokens=False).ids


ODD = [
    "", " ", "  a", "a  b", "a \n b", "a\nb c", "it's we'll 'tis ''s", "x... !? wow!!! ... (a) [b]!", "1 22 333,4", "tab\there",
    "nbsp x   y", "sep\x1fa \x1f b \x85 c", "é è ü ß ñ", "<|endoftext|> a <|endoftext|>", "　wide 　", "日本 語 です。",
    "emoji 😀 😀!! á b", "a" * 5000, " ".join("!" * i for i in range(40)), "A'S b'Ll", "don't. 'don't' 5's ½ ² x²! Ⅷ, ٣!",
]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("text", [*ODD, "a" * 30000, " " * 5000, "\n" * 5000 + "x", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n"])
def test_ids_equal_the_tokenizer(encoder, text):
    ours = packing.encoder(PATH)
    assert ours.ranked and ours.packed_ids(text) == packed(plain(encoder, text))


@pytest.mark.parametrize("special", [True, False])
def test_ids_of_random_text(special):
    theirs, ours = Tokenizer.from_file(PATH), ByteLevel(PATH, special)
    theirs.encode_special_tokens = not special
    rng = random.Random(8)
    pieces = [*"ab é\n\t .,'s1²!\x1f日😀́", "<|endoftext|>", "'ll", "  ", *map(chr, range(0x20, 0x3200, 7))]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 160)))
        assert ours.ids(text) == plain(theirs, text), repr(text)


def test_every_assigned_character_between_letters(encoder):
    ours = packing.encoder(PATH)
    signs = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    for at in range(0, len(signs), 500):
        text = "".join(f"a{c}b {c}1{c} " for c in signs[at : at + 500])
        assert ours.ids(text) == plain(encoder, text)


def test_other_files_are_left_to_their_library():
    path = str(Path(PATH).with_name("word_bpe_49k.json"))
    assert not _is_plain(json.loads(Path(path).read_text()))
    assert _is_plain(json.loads(Path(PATH).read_text()))


def check(rows, pieces, encoder, size):
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
        assert p.length > 0
    for key, text in rows:
        ids = [*plain(encoder, text or ""), 1]
        at = 0
        for p in sorted(by_doc[key], key=lambda p: p.start):
            part = ids[at : at + p.length]
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert p.ids is None or bytes(p.ids) == struct.pack(f"<{len(part)}I", *part)
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
        total += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / (padding + total)


@pytest.mark.parametrize("partitions,group", [(1, 64), (7, 3)])
def test_round_trip(spark, documents, encoder, partitions, group):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.choice([3, 40, 200, 900]))) for i in range(150)] + [(500 + i, t) for i, t in enumerate(ODD)]
    rows += [(700, None), (701, prose(rng, 6000))]
    df = documents(rows).repartition(partitions)
    pieces = packing.pack(df, PATH, size=512, merge_group=group, keep_ids=True).collect()
    assert check(rows, pieces, encoder, 512) < 0.02


def test_repeated_and_null_keys(spark, documents, encoder):
    rows = odd_rows()
    pieces = packing.pack(documents(rows), PATH, size=64).collect()
    assert sum(p.length for p in pieces) == sum(len(plain(encoder, t or "")) + 1 for _, t in rows)
    assert {p.doc_id for p in pieces} == {i for i, _ in rows}


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
