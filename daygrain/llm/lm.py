"""LM scoring: a gated recurrent language model with a class-factored output softmax.

Words are counted over the whole training corpus. The most frequent are *output words*, in
classes of like frequency mass; all others fall into tail classes by their last two bytes.

    P(word) = P(class | state) P(word | class, state)      for an output word
    P(word) = P(class | state) (c + 1/2) / (N + (V + 1)/2)  for a tail word

with c, N and V counted within its tail class, one unseen word included, so that the
probabilities of all words add up to one. The state is a gated recurrent unit's, over the
words (tail classes for tail words) since the document began; it is carried across windows,
so that whole documents are scored.

Training takes rounds. In each, every partition starts from the same weights, runs truncated
backpropagation over its documents of the round, and Spark averages what comes back,
weighted by tokens. A document is used once. Counts of words too rare for the broadcast
dictionary are joined, not broadcast.
"""

from __future__ import annotations

import heapq
import math
import zlib
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, crc_fold, staged, stretches, table

#: Words in the broadcast dictionary at most, and output words among them.
DICTIONARY, OUTPUTS = 1 << 17, 4096
CLASSES, TAILS = 64, 64
STATE, STEPS, LANES, RATE, SEED = 16, 32, 128, 0.1, 7
#: Output weights stay within this, so that with states below 1 no exponential overflows.
LARGEST = 3.0
#: Sixteenths of the training documents in each round.
ROUNDS = (1, 2, 4, 9)
#: Distinct words counted by a task before they are passed on, and floats of a block of weights.
COUNTED, CHUNK = 1 << 19, 1 << 14
END = b""


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def batch_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all ``tokens`` but the ends, and the row of each."""
    # taken, that is, copied: the functions below misread a long slice that starts within its buffers
    whole = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), pc.list_parent_indices(lists).filter(full).to_numpy()


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, tail) of all words and the end of ``docs`` (text)."""

    def count(batches: Batches) -> Batches:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            out = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return out.select(["word", "n_sum"]).rename_columns(["word", "n"])

        for rows in stretches(batches):
            if not rows.num_rows:
                continue
            seen = batch_words(rows.column("text"))[0].value_counts()
            words = pa.concat_arrays([seen.field("values").cast(pa.binary()), pa.array([END], pa.binary())])
            n = pa.concat_arrays([seen.field("counts"), pa.array([rows.num_rows], pa.int64())])
            held.append(pa.table({"word": words, "n": n}))
            if sum(t.num_rows for t in held) > 2 * COUNTED:
                held = [summed()]
                if held[0].num_rows > COUNTED:
                    yield from held.pop().to_batches()
        if held:
            yield from summed().to_batches()

    counts = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    last = F.expr("substring(word, greatest(1, octet_length(word) - 1), 2)")
    return counts.withColumn("tail", (F.crc32(last) % TAILS).cast("int"))


@dataclass
class Vocabulary:
    """words: id and count of the dictionary's; ids below n_out are output words in order of frequency."""

    counts: dict[bytes, int]
    ids: dict[bytes, int]
    n_out: int
    starts: np.ndarray  # of the classes, in output words, and their end
    tail_total: np.ndarray  # N + (V + 1) / 2 of each tail class
    total: int
    distinct: int

    @property
    def base_total(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def vocabulary(counts: DataFrame, dictionary: int = DICTIONARY, outputs: int = OUTPUTS) -> Vocabulary:
    """The words whose count reaches the least power of 2^(1/8) that at most ``dictionary`` words reach."""
    level = F.floor(F.log2("c") * 8)
    cells = counts.groupBy(level.alias("level"), "tail").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    levels: dict[int, int] = {}
    tails = np.zeros((TAILS, 2))
    for r in cells:
        levels[r["level"]] = levels.get(r["level"], 0) + r["v"]
        tails[r["tail"]] += r["c"], r["v"]
    held, least = 0, None
    for at in sorted(levels, reverse=True):
        if held + levels[at] > dictionary:
            break
        held, least = held + levels[at], at
    frequent = [] if least is None else counts.where(level >= F.lit(least)).select("word", "c").collect()
    known = sorted(((bytes(r["word"]), r["c"]) for r in frequent), key=lambda x: (-x[1], x[0]))
    top = [w for w, _ in known if w != END][: outputs - 1]
    by_count = dict(known)
    by_count.setdefault(END, 0)
    top = sorted([*top, END], key=lambda w: (-by_count[w], w))
    mass = np.cumsum(np.sqrt([by_count[w] + 0.5 for w in top]))
    classes = np.minimum((mass - 1e-9) / mass[-1] * CLASSES, CLASSES - 1).astype(int)
    starts = np.concatenate([np.flatnonzero(np.diff(classes, prepend=-1)), [len(top)]])
    ids = {w: i for i, w in enumerate(top)}
    total, distinct = int(tails[:, 0].sum()), int(tails[:, 1].sum())
    for w in top:
        if by_count[w]:
            tails[tail_class(w)] -= by_count[w], 1
    if not by_count[END]:
        del by_count[END]
    return Vocabulary(by_count, ids, len(top), starts, tails[:, 0] + 0.5 * (tails[:, 1] + 1), total, distinct)


@dataclass
class Model:
    """x: gate inputs of each id, u: state to gates, wc, bc: groups, then classes within their group, ww, bw: words within their class."""

    x: np.ndarray
    u: np.ndarray
    wc: np.ndarray
    bc: np.ndarray
    ww: np.ndarray
    bw: np.ndarray
    starts: np.ndarray

    @classmethod
    def fresh(cls, v: Vocabulary, state: int = STATE, seed: int = SEED) -> Model:
        """Small random weights; the biases make it a unigram model."""
        draw = np.random.default_rng(seed)
        word = np.zeros(v.n_out)
        for w, i in v.ids.items():
            word[i] = v.counts.get(w, 0) + 0.5
        mass = np.concatenate([np.add.reduceat(word, v.starts[:-1]), v.tail_total])
        grouped = np.add.reduceat(mass, np.arange(0, len(mass), math.ceil(math.sqrt(len(mass)))))
        mass = np.concatenate([grouped, mass])
        arrays = [
            draw.normal(0, 0.1, (v.n_out + TAILS, 3 * state)),
            draw.normal(0, 0.3 / np.sqrt(state), (state, 3 * state)),
            np.zeros((len(mass), state)),
            np.log(mass / grouped.sum()),
            np.zeros((v.n_out, state)),
            np.log(word),
        ]
        return cls(*[a.astype(np.float32) for a in arrays], v.starts)

    def arrays(self) -> list[np.ndarray]:
        return [self.x, self.u, self.wc, self.bc, self.ww, self.bw]

    def copy(self) -> Model:
        return Model(*[a.copy() for a in self.arrays()], self.starts)

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def filled(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Model(*out, self.starts)

    @property
    def classes(self) -> np.ndarray:
        """The class of each id."""
        heads = len(self.starts) - 1
        of = np.repeat(np.arange(heads), np.diff(self.starts))
        return np.concatenate([of, heads + np.arange(TAILS)]).astype(np.uint16)

    @property
    def groups(self) -> np.ndarray:
        """The classes at which groups start, and their end."""
        classes = len(self.starts) - 1 + TAILS
        groups = len(self.bc) - classes
        return np.minimum(np.arange(groups + 1) * math.ceil(classes / groups), classes)

    def forward(
        self, ids: np.ndarray, h: np.ndarray, fresh: np.ndarray | None = None, back: bool = True
    ) -> tuple[np.ndarray, tuple | None]:
        """States after each step of ids (steps x lanes) from h, and what the way back needs if ``back``.

        ``fresh`` marks the steps before which a lane's state is set to zero.
        """
        n = h.shape[1]
        shape = (*ids.shape, n)
        states = np.empty(shape, h.dtype)
        held = shape if back else (1, *shape[1:])
        gates_of, rh_of, new_of = np.empty((*held[:2], 2 * n), h.dtype), np.empty(held, h.dtype), np.empty(held, h.dtype)
        inputs = np.take(self.x, ids.ravel(), axis=0).reshape(*ids.shape, -1)
        u_gates, u_new = -self.u[:, : 2 * n], self.u[:, 2 * n :].copy()
        resets = np.zeros(len(ids), bool) if fresh is None else fresh.any(axis=1)
        first = h
        for t in range(len(ids)):
            at = t if back else 0
            gates, rh, new = gates_of[at], rh_of[at], new_of[at]
            if resets[t]:
                h = np.where(fresh[t, :, None], h.dtype.type(0), h)
            np.matmul(h, u_gates, out=gates)
            gates -= inputs[t, :, : 2 * n]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.multiply(gates[:, n:], h, out=rh)
            np.matmul(rh, u_new, out=new)
            new += inputs[t, :, 2 * n :]
            np.tanh(new, out=new)
            h = np.add(h, gates[:, :n] * (new - h), out=states[t])
        if not back:
            return states, None
        before = np.concatenate([first[None], states[:-1]])
        if fresh is not None:
            before[fresh] = 0
        return states, (before, gates_of, rh_of, new_of, fresh)

    def output(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> np.ndarray:
        """Log-probabilities of targets (rows); with ``grads``, also the gradients of their sum."""
        classes = np.take(self.classes, targets)
        order = np.argsort(classes, kind="stable")
        s, of, word = states[order], classes[order], targets[order]
        groups = self.groups
        heads = len(groups) - 1
        back = np.zeros_like(s) if grads is not None else None
        if grads is not None:
            grads["wc"], grads["bc"] = np.zeros_like(self.wc), np.zeros_like(self.bc)
        logs = np.zeros(len(of))
        ones = np.ones((len(s), 1), s.dtype)
        s = np.concatenate([s, ones], axis=1)

        def choose(of_w: str, of_b: str, sets: list[tuple], at: np.ndarray) -> None:
            """Adds the logs of the choices ``at``, for each of ``sets`` (a, b, c, d) among weights c:d for states a:b."""
            w = getattr(self, of_w)
            weights = np.concatenate([w, getattr(self, of_b)[:, None]], axis=1)
            a, b, c, d = np.array(sets).T
            widths = np.repeat(d - c, b - a)
            starts = np.cumsum(widths) - widths
            edges = np.cumsum((b - a) * (d - c)).tolist()
            rows = slice(a[0], b[-1])
            q = np.empty(edges[-1], s.dtype)
            blocks = [q[e - (b - a) * (d - c) : e].reshape(b - a, d - c) for e, (a, b, c, d) in zip(edges, sets)]
            for block, (a, b, c, d) in zip(blocks, sets):
                np.matmul(s[a:b], weights[c:d].T, out=block)
            cells = starts + at[rows]
            logs[rows] += q[cells]
            np.exp(q, out=q)
            total = np.add.reduceat(q, starts)
            logs[rows] -= np.log(total)
            if grads is not None:
                q *= np.repeat(-1 / total, widths)
                q[cells] += 1
                for block, (a, b, c, d) in zip(blocks, sets):
                    back[a:b] += block @ w[c:d]
                    g = block.T @ s[a:b]
                    grads[of_w][c:d], grads[of_b][c:d] = g[:, :-1], g[:, -1]

        edges = np.searchsorted(of, np.arange(groups[-1] + 1))
        group = np.repeat(np.arange(heads), np.diff(edges[groups]))
        choose("wc", "bc", [(0, len(s), 0, heads)], group)
        choose(
            "wc", "bc",
            [(*edges[groups[g : g + 2]].tolist(), *(heads + groups[g : g + 2]).tolist()) for g in np.flatnonzero(np.diff(edges[groups]))],
            of - groups[group],
        )
        full = np.flatnonzero(np.diff(edges[: len(self.starts)]))
        if len(full):
            sets = np.stack([edges[full], edges[full + 1], self.starts[full], self.starts[full + 1]], axis=1).tolist()
            words = slice(0, sets[-1][1])
            at = word[words] - self.starts[of[words]]
            choose("ww", "bw", [*map(tuple, sets)], at)
        out = np.empty_like(logs)
        out[order] = logs
        if grads is not None:
            grads["states"] = np.empty_like(back)
            grads["states"][order] = back
        return out

    def backward(self, kept: tuple, dstates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gate inputs (steps x lanes x 3n) and of u."""
        n = dstates.shape[2]
        before, gates, rh, new, fresh = kept
        resets = np.zeros(len(dstates), bool) if fresh is None else fresh.any(axis=1)
        z, r = gates[:, :, :n], gates[:, :, n:]
        by_z, by_new, by_r, stay = (new - before) * z * (1 - z), z * (1 - new * new), before * r * (1 - r), 1 - z
        u_gates, u_new = self.u[:, : 2 * n].T.copy(), self.u[:, 2 * n :].T.copy()
        dinputs = np.empty((*dstates.shape[:2], 3 * n), dstates.dtype)
        dh = np.zeros_like(dstates[0])
        for t in reversed(range(len(dstates))):
            dh += dstates[t]
            d = dinputs[t]
            dnew = np.multiply(dh, by_new[t], out=d[:, 2 * n :])
            drh = dnew @ u_new
            np.multiply(dh, by_z[t], out=d[:, :n])
            np.multiply(drh, by_r[t], out=d[:, n : 2 * n])
            dh *= stay[t]
            drh *= r[t]
            dh += drh
            dh += d[:, : 2 * n] @ u_gates
            if resets[t]:
                dh[fresh[t]] = 0
        flat = dinputs.reshape(-1, 3 * n)
        du = [before.reshape(-1, n).T @ flat[:, : 2 * n], rh.reshape(-1, n).T @ flat[:, 2 * n :]]
        return dinputs, np.concatenate(du, axis=1)


def _windows(docs: list[np.ndarray], end: int, steps: int, lanes: int):
    """Documents end to end in lanes of like length, in windows of (inputs, targets, fresh, documents, valid).

    Each word comes from the one before; ``fresh`` are the first words of documents. Lanes end together,
    so that a long lane is alone at first and the last steps of training are over many documents.
    """
    lengths = [len(d) for d in docs]
    least = [(0, lane) for lane in range(min(lanes, len(docs)))]
    held: list[list[int]] = [[] for _ in least]
    for i in sorted(range(len(docs)), key=lambda i: -lengths[i]):
        size, lane = least[0]
        heapq.heapreplace(least, (size + lengths[i], lane))
        held[lane].append(i)
    taken = sorted(least, reverse=True)
    sizes = np.array([size for size, _ in taken])
    order = np.array([i for _, lane in taken for i in sorted(held[lane])])
    flat = np.concatenate([docs[i] for i in order])
    counts = np.array(lengths)[order]
    starts = np.cumsum(counts) - counts
    before = np.concatenate([flat[:1], flat[:-1]])
    before[starts] = end
    first = np.zeros(len(flat), bool)
    first[starts] = True
    document = np.repeat(order.astype(np.int32), counts)
    lane_starts = np.cumsum(sizes) - sizes
    late = sizes[0] - sizes
    for at in range(0, int(sizes[0]), steps):
        upto = min(at + steps, int(sizes[0]))
        n = int((late < upto).sum())
        step = np.arange(at, upto)[:, None] - late[:n]
        valid = step >= 0
        place = np.where(valid, lane_starts[:n] + step, 0)
        yield before[place], flat[place], first[place], document[place], valid


class Trainer:
    """Adagrad over windows of truncated backpropagation."""

    def __init__(self, model: Model, end: int, rate: float = RATE, steps: int = STEPS):
        self.m, self.end, self.rate, self.steps = model, end, rate, steps
        self.seen = [np.full(a.shape if a.ndim == 1 else (len(a), 1), 1e-6, np.float32) for a in model.arrays()]
        self.tokens = 0

    def _step(self, which: int, grad: np.ndarray, rows=slice(None)) -> None:
        a, seen = self.m.arrays()[which], self.seen[which]
        square = grad * grad
        seen[rows] += square if a.ndim == 1 else square.mean(axis=1, keepdims=True)
        a[rows] += self.rate * grad / np.sqrt(seen[rows])
        if which > 1 and a.ndim > 1:
            a[rows] = np.clip(a[rows], -LARGEST, LARGEST)

    def learn(self, docs: list[np.ndarray]) -> None:
        h = np.zeros((min(LANES, len(docs)), self.m.u.shape[0]), np.float32)
        for inputs, targets, fresh, _, valid in _windows(docs, self.end, self.steps, LANES):
            m = self.m
            lanes = inputs.shape[1]
            states, kept = m.forward(inputs, h[:lanes], fresh)
            n = int(valid.sum())
            flat = slice(None) if n == valid.size else valid.ravel()
            grads = {"ww": np.zeros_like(m.ww), "bw": np.zeros_like(m.bw)}
            m.output(states.reshape(-1, h.shape[1])[flat], targets.ravel()[flat], grads)
            scale = np.float32(1 / max(256, n))
            dstates = np.zeros_like(states).reshape(-1, h.shape[1])
            dstates[flat] = grads["states"] * scale
            dinputs, du = m.backward(kept, dstates.reshape(states.shape))
            ids = inputs.ravel()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            new = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            self._step(0, np.add.reduceat(dinputs.reshape(len(ids), -1)[order], new, axis=0), ids[new])
            self._step(1, du)
            self._step(2, grads["wc"] * scale)
            self._step(3, grads["bc"] * scale)
            used = np.flatnonzero(grads["bw"])
            if 4 * len(used) > len(m.bw):
                used = slice(None)  # a row without a gradient stays as it is
            self._step(4, grads["ww"][used] * scale, used)
            self._step(5, grads["bw"][used] * scale, used)
            h[:lanes] = states[-1]
            self.tokens += n


def score(model: Model, docs: list[np.ndarray], end: int, steps: int = 64) -> np.ndarray:
    """Natural log-likelihood of each document up to the choice among a tail class's words."""
    out = np.zeros(len(docs))
    h = np.zeros((min(2 * LANES, len(docs)), model.u.shape[0]), np.float32)
    for inputs, targets, fresh, document, valid in _windows(docs, end, steps, 2 * LANES):
        lanes = inputs.shape[1]
        states, _ = model.forward(inputs, h[:lanes], fresh, back=False)
        flat = slice(None) if valid.all() else valid.ravel()
        logs = model.output(states.reshape(-1, h.shape[1])[flat], targets.ravel()[flat])
        out += np.bincount(document.ravel()[flat], logs, minlength=len(docs))
        h[:lanes] = states[-1]
    return out


def _batches(batches: Batches):
    """Of each batch with rows, the row keys and ids of its documents."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column("row_key").to_numpy(), [np.frombuffer(b, np.uint16) for b in batch.column("ids").to_pylist()]


def _encoded(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """docs (row_key, doc_id, text, held_out, learnt) as ids, with sums over the dictionary's words.

    n_known and base: of the dictionary's words; tail: log10 of c + 1/2 of those among them
    that are tail words, less all tail words' log10 totals; rare: the other words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(v)
    kept = ["row_key", "doc_id", "held_out", "learnt"]
    fields = "ids binary, n_tokens long, n_known long, base double, tail double, rare array<struct<word: binary, n: long>>"

    def run(batches: Batches) -> Batches:
        v = shared.value
        log_total = np.log10(v.tail_total)
        words_known = [*v.counts, *([] if END in v.counts else [END])]
        place = {w: i for i, w in enumerate(words_known)}
        # a word beyond the dictionary has the place of its tail class
        classes = np.array([*map(tail_class, words_known), *range(TAILS)])
        ids_of = (v.n_out + classes).astype(np.uint16)
        logs = np.zeros(len(ids_of))
        logs[: len(place)] = np.log10(np.array([v.counts.get(w, 0) for w in words_known]) + 0.5)
        tails = logs - log_total[classes]
        for w, i in v.ids.items():
            ids_of[place[w]], tails[place[w]] = i, 0
        unseen_end = END not in v.counts
        for batch in stretches(batches):
            if not batch.num_rows:
                continue
            words, row = batch_words(batch.column("text"))
            coded = words.dictionary_encode()
            distinct = coded.dictionary.cast(pa.binary())
            code = coded.indices.to_numpy()
            as_list = distinct.to_numpy(zero_copy_only=False).tolist()
            places = np.fromiter(map(place.get, as_list, repeat(-1)), np.int32, len(as_list))
            unknown = places < 0
            last = pc.binary_slice(distinct.filter(pa.array(unknown)), -2).dictionary_encode()
            of_last = np.array([tail_class(x) for x in last.dictionary.to_pylist()], np.int32)
            places[unknown] = len(place) + of_last[last.indices.to_numpy()]
            counts = np.bincount(row, minlength=batch.num_rows)
            ends = np.cumsum(counts + 1)
            at = np.full(ends[-1], place[END], np.int32)
            at[np.arange(len(row)) + row] = places[code]
            beyond = unknown[code]
            n_beyond = np.bincount(row[beyond], minlength=batch.num_rows)
            pair, n_rare = np.unique(row[beyond].astype(np.int64) * len(as_list) + code[beyond], return_counts=True)
            starts = np.searchsorted(pair, np.arange(batch.num_rows + 1) * len(as_list))
            rare = distinct.take(pa.array(pair % max(1, len(as_list))))
            cuts = np.split(at, ends[:-1])
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32) * ids_of.itemsize)
            pairs = pa.StructArray.from_arrays([rare, pa.array(n_rare, pa.int64())], ["word", "n"])
            made = {
                "ids": pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(ids_of[at])]),
                "n_tokens": pa.array(counts + 1, pa.int64()),
                "n_known": pa.array(counts + 1 - n_beyond - unseen_end, pa.int64()),
                "base": pa.array([logs[cut].sum() for cut in cuts], pa.float64()),
                "tail": pa.array([tails[cut].sum() for cut in cuts], pa.float64()),
                "rare": pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pairs),
            }
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *made.values()], names=[*kept, *made])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row_key long, doc_id {key}, held_out boolean, learnt boolean, {fields}")


def train(encoded: DataFrame, v: Vocabulary, rounds: tuple[int, ...] = ROUNDS) -> Model:
    """One pass over all documents that are learnt from, in rounds; see the module."""
    model = Model.fresh(v)
    sc = encoded.sparkSession.sparkContext
    end = v.ids[END]
    parts = encoded.rdd.getNumPartitions()
    at = 0
    cell = F.pmod(F.xxhash64("row_key"), F.lit(sum(rounds)))
    for share in rounds:
        shared = sc.broadcast(model)

        def learn(batches: Batches) -> Batches:
            trainer = Trainer(shared.value.copy(), end)
            for _, docs in _batches(batches):
                trainer.learn(docs)
            if trainer.tokens:
                flat = trainer.m.flat().astype(np.float64) * trainer.tokens
                parts = [flat[i : i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
                columns = [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([trainer.tokens] * len(parts)), pa.array(parts)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "n", "part"])

        def add(batches: Batches) -> Batches:
            sums: dict[int, list] = {}
            for batch in batches:
                for block, n, part in zip(*[c.to_pylist() for c in batch.columns]):
                    held = sums.setdefault(block, [0, 0.0])
                    held[0] += n
                    held[1] = held[1] + np.frombuffer(part)
            columns = [list(sums), [s[0] for s in sums.values()], [s[1].tobytes() for s in sums.values()]]
            kinds = (pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "n", "part"])

        schema = "block int, n long, part binary"
        rows = encoded.where("learnt").where((cell >= at) & (cell < at + share)).select("row_key", "ids")
        # as many documents a task as in the largest round: with few, the longest one leaves most lanes empty
        rows = rows.coalesce(max(1, parts * share // max(rounds)))
        blocks = rows.mapInArrow(learn, schema).repartition("block").mapInArrow(add, schema).collect()
        at += share
        if blocks:
            blocks.sort(key=lambda r: r["block"])
            model = model.filled(np.concatenate([np.frombuffer(bytes(r["part"])) / r["n"] for r in blocks]))
    return model


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", held_out=None, learnt=None
) -> tuple[DataFrame, Model]:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; and the model.

    ``held_out`` and ``learnt`` are columns (none and all by default). A null or empty text
    is its end alone. Equal rows are scored alike and learnt from as often as they stand;
    with nothing to learn from, every word is unseen. Other columns play no part.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_key"),
        F.col(key).alias("doc_id"),
        F.col(text).alias("text"),
        (F.lit(False) if held_out is None else held_out).alias("held_out"),
        (F.lit(True) if learnt is None else learnt).alias("learnt"),
    )
    counts = staged(word_counts(rows.where("learnt")), "words")
    v = vocabulary(counts)
    encoded = staged(_encoded(rows, v), "ids")
    model = train(encoded, v)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    end = v.ids[END]

    def run(batches: Batches) -> Batches:
        for keys, ids in _batches(batches):
            places: dict[bytes, int] = {}  # equal documents of a batch are scored once
            at = [places.setdefault(x.tobytes(), len(places)) for x in ids]
            logs = score(shared.value, [np.frombuffer(x, np.uint16) for x in places], end)[at] / np.log(10)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(logs)], names=["row_key", "model"])

    scored = encoded.select("row_key", "ids").mapInArrow(run, "row_key long, model double")
    rare = encoded.select("row_key", F.explode("rare").alias("rare")).select("row_key", "rare.word", "rare.n")
    log = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    rare = rare.join(counts.select("word", "c"), "word", "left").groupBy("row_key").agg(
        F.sum(log).alias("rare_log"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known")
    )
    out = encoded.drop("ids", "rare", "learnt").join(scored, "row_key").join(rare, "row_key", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return (
        out.select(
            F.col("doc_id").alias(key),
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(v.total).cast("long").alias("train_tokens"),
            (F.col("base") + rare_log - F.col("n_tokens") * float(np.log10(v.base_total))).alias("base_score"),
            (F.col("model") + F.col("tail") + rare_log).alias("score"),
        ),
        model,
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; the model learns from four folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_fold("doc_id")
    held, learnt = F.coalesce(fold == 1, F.lit(False)), F.coalesce(fold != 1, F.lit(False))
    return score_documents(docs, held_out=held, learnt=learnt)[0]
