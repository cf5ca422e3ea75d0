"""Ids of byte-level vocabulary files, as the ``tokenizers`` library gives them.

A file with plain byte-pair merges, numbered in their order after the single bytes, means the same as ranks of
byte strings, and ``tiktoken`` applies those several times faster. Any other file is left to
``tokenizers``.
"""

from __future__ import annotations

import json
import os

import numpy as np

# Fixed value: the pretokens of a byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A vocabulary file. With ``special``, its special tokens' strings in a text become their ids, else they are ordinary text."""

    def __init__(self, path: str, special: bool = True):
        self.special = special
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs, added = byte_of_sign(), {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"] | added
        #: The bytes of each id.
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            self.bytes[i] = name.encode() if name in added else bytes(signs[c] for c in name)
        self.ranked = self.model = None
        if _is_plain(spec):
            import tiktoken

            ranks = {self.bytes[i]: i for name, i in vocabulary.items() if name not in added}
            self.ranked = tiktoken.Encoding("", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.encode_special_tokens = not special

    def ids(self, text: str) -> list[int]:
        if self.model:
            return self.model.encode(text, add_special_tokens=False).ids
        return self.ranked.encode(text, allowed_special="all") if self.special else self.ranked.encode_ordinary(text)

    def packed_ids(self, text: str) -> bytes:
        """The ids as little-endian uint32."""
        if self.model or not self.special:
            return np.array(self.ids(text), "<u4").tobytes()
        return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


def _is_plain(spec: dict) -> bool:
    """Whether the file holds nothing but merges in the order of their ids behind the pretokens of ``PATTERN``."""
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    names = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    return (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None
        and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and sorted(model["vocab"][s] for s in byte_of_sign()) == list(range(256))
        and [model["vocab"][n] for n in names] == list(range(256, 256 + len(names)))
    )
