"""Language identification: each document as a mixture of languages, fitted by EM.

Training counts, for every language, the byte n-grams of all labelled texts, hashed to a
fixed number of cells per order. A word's likelihood in a language is the product of its
n-grams' smoothed probabilities, geometrically averaged over the orders.
Expectation-maximisation gives the proportions of languages among a document's words; a
set of languages is selected by the likelihood less a penalty for each further language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, as_bytes, crc_fold, table, with_columns

ORDERS = (2, 3, 4)
#: Cells of an order: at most 2^15, fewer when many languages share 2^21.
CELL_BITS, ALL_BITS = 15, 21
STEPS, SMOOTHING, PENALTY = 10, 0.5, 1.0
#: Bytes of text handled at once.
BLOCK = 1 << 18
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(text: bytes, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the cell of the n-gram at each byte, and the places where words start.

    Words are runs of ASCII letters and bytes above 7F, A-Z in lower case; all else is blank.
    The n-grams from a word's first byte up to the next word's belong to the word.
    """
    units = _FOLD[np.frombuffer(b" " + text + b"   ", np.uint8)]
    letter = units != 32
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    n = len(units) - max(ORDERS) + 1
    code, cells = units.astype(np.uint32), []
    wide = code
    for order in range(2, max(ORDERS) + 1):
        code = (code[:-1] << np.uint32(8)) | wide[order - 1 :]
        if order in ORDERS:
            cells.append(((code[:n] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.intp))
    return cells, starts


@dataclass
class Model:
    """log_p: for each order, cells x languages; floor of unseen cells included by smoothing."""

    languages: list[str]
    bits: int
    log_p: list[np.ndarray]

    def words(self, text: bytes) -> np.ndarray:
        """Log-likelihood of each word in each language."""
        cells, starts = grams(text, self.bits)
        if not len(starts):
            return np.zeros((0, len(self.languages)), np.float32)
        total = np.take(self.log_p[0], cells[0], axis=0)
        for rows, cell in zip(self.log_p[1:], cells[1:]):
            total += np.take(rows, cell, axis=0)
        return np.add.reduceat(total, starts, axis=0) / len(self.log_p)

    def mixtures(self, likelihood: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the selected languages for each document: (documents x languages), and words of each language."""
        starts = np.cumsum(lengths) - lengths
        k = likelihood.shape[1]
        top = likelihood.max(axis=1, keepdims=True)
        scaled = np.exp(likelihood - top)
        alone = np.add.reduceat(likelihood - top, starts, axis=0)
        best = alone.argmax(axis=1)
        shares = np.zeros((len(lengths), k))
        shares[np.arange(len(lengths)), best] = 1
        counts = shares * lengths[:, None]
        if k > 1:
            cost = PENALTY * np.log(lengths + 1.0)
            full, value, of = _fit(scaled, lengths, np.ones((len(lengths), k), bool))
            # a language alone against the full mixture; then the least language goes while that gains
            mixed = np.flatnonzero(value - (k - 1) * cost > alone.max(axis=1))
            mixed = np.union1d(mixed, np.flatnonzero(value - cost > alone.max(axis=1)))
            for d in mixed.tolist():
                rows = scaled[starts[d] : starts[d] + lengths[d]]
                shares[d], counts[d] = self._select(rows, full[d], of[d], value[d], alone[d].max(), cost[d], shares[d])
        return shares, counts

    def _select(self, rows, share, of, value, alone, cost, single):
        n = np.array([len(rows)])
        active = np.ones(len(share), bool)
        best = (alone, single, single * len(rows))
        while True:
            gain = value - (active.sum() - 1) * cost
            if gain > best[0]:
                best = (gain, share, of)
            if active.sum() <= 2:
                return best[1], best[2]
            active[np.where(active, share, np.inf).argmin()] = False
            (share,), (value,), (of,) = _fit(rows, n, active[None, :])


def _fit(scaled: np.ndarray, lengths: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM for all documents at once: shares, log-likelihood and words of each language."""
    starts = np.cumsum(lengths) - lengths
    shares = active / active.sum(axis=1, keepdims=True)
    for _ in range(STEPS):
        joint = np.repeat(shares.astype(np.float32), lengths, axis=0) * scaled
        total = np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
        of = np.add.reduceat(joint / total, starts, axis=0)
        shares = of / of.sum(axis=1, keepdims=True)
    joint = (np.repeat(shares.astype(np.float32), lengths, axis=0) * scaled).sum(axis=1)
    return shares, np.add.reduceat(np.log(np.maximum(joint, 1e-30)), starts), of


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about BLOCK bytes that end at a blank."""
    at = 0
    while at < len(text):
        cut = text.find(b" ", at + BLOCK)
        end = len(text) if cut < 0 else cut
        yield text[at:end]
        at = end


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all rows whose text and language are not null.

    The driver receives one count for each language and cell. Languages are sorted; with no
    labelled row there is none, and every text is ``und``.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    languages = sorted(r[0] for r in rows.select("lang").distinct().toLocalIterator())
    bits = min(CELL_BITS, max(8, ALL_BITS - math.ceil(math.log2(max(1, len(languages))))))
    number = {name: i for i, name in enumerate(languages)}
    size = len(ORDERS) << bits

    def count(batches: Batches) -> Batches:
        seen: dict[int, np.ndarray] = {}

        def add(i: int, held: list[bytes]) -> None:
            cells = seen.setdefault(i, np.zeros(size, np.int64))
            for j, cell in enumerate(grams(b" ".join(held), bits)[0]):
                cells[j << bits : (j + 1) << bits] += np.bincount(cell, minlength=1 << bits)

        for batch in batches:
            held: dict[int, list[bytes]] = {}
            used: dict[int, int] = {}
            for body, name in zip(as_bytes(batch.column("text")), batch.column("lang").to_pylist()):
                i = number[name]
                for part in _parts(body):
                    held.setdefault(i, []).append(part)
                    used[i] = used.get(i, 0) + len(part)
                    if used[i] >= BLOCK:
                        add(i, held.pop(i))
                        used[i] = 0
            for i, parts in held.items():
                add(i, parts)
        for i, cells in seen.items():
            at = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(cells[at])],
                names=["lang", "cell", "n"],
            )

    counts = rows.mapInArrow(count, "lang int, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    cells = np.full((size, len(languages)), SMOOTHING, np.float64)
    for r in counts.toLocalIterator():
        cells[r["cell"], r["lang"]] += r["n"]
    tables = np.split(cells, len(ORDERS))
    return Model(languages, bits, [np.log(t / t.sum(axis=0)).astype(np.float32) for t in tables])


FIELDS = "lang_pred string, score double, mixture map<string, double>"


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and mixture (shares of the selected languages), row by row.

    score is the share of words in the predicted language, drawn to 1/languages as by one
    further word. A null text, or one without a letter, is ``und`` with score 0 and an empty
    mixture; ties go to the first language. Columns named as a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        out: list[tuple] = [(UNKNOWN, 0.0, [])] * len(texts)
        held: list[tuple[int, np.ndarray]] = []

        def settle() -> None:
            if not held:
                return
            lengths = np.array([len(x) for _, x in held])
            shares, counts = m.mixtures(np.concatenate([x for _, x in held]), lengths)
            k = len(m.languages)
            score = (counts.max(axis=1) + 1 / k) / (lengths + 1)
            for j, (i, _) in enumerate(held):
                mixture = [(m.languages[x], float(shares[j, x])) for x in np.flatnonzero(shares[j])]
                out[i] = (m.languages[shares[j].argmax()], min(1.0, float(score[j])), mixture)
            held.clear()

        used, strings = 0, texts.to_pylist()
        group: list[tuple[int, bytes]] = []

        def flush() -> None:
            """Likelihoods of a group of short texts in one pass, parted by blanks."""
            if group:
                words = m.words(b" ".join(body for _, body in group))
                lengths = [_count_words(body) for _, body in group]
                at = 0
                for (i, _), n in zip(group, lengths):
                    held.append((i, words[at : at + n]))
                    at += n
                group.clear()

        for i, t in enumerate(strings):
            if not m.languages or not has_letter(t):
                continue
            body = t.encode()
            if len(body) > BLOCK:
                held.append((i, np.concatenate([m.words(p) for p in _parts(body)])))
            else:
                group.append((i, body))
            used += len(body)
            if used >= BLOCK:
                flush()
                settle()
                used = 0
        flush()
        settle()
        langs, scores, mixtures = zip(*out) if out else ((), (), ())
        return [
            pa.array(langs, pa.string()),
            pa.array(scores, pa.float64()),
            pa.array(mixtures, pa.map_(pa.string(), pa.float64())),
        ]

    return with_columns(docs, [text], FIELDS, run)


def _count_words(body: bytes) -> int:
    letter = _FOLD[np.frombuffer(body, np.uint8)] != 32
    return int(np.count_nonzero(letter[1:] & ~letter[:-1]) + letter[0])


def query(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from four folds of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(crc_fold("doc_id") == 0, F.lit(False)))
    model = train(docs.where(crc_fold("doc_id") != 0))
    return identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "mixture")
