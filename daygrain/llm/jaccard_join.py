"""N-gram Jaccard join: documents whose shingle sets are alike, by a count-vector R-tree.

Shingles are hashed into groups. A document's counts per group are a point, and the summed
coordinate minima of two points bound the overlap of the sets. R-trees over the points
give the pairs that may link, and these are verified exactly.

In so many dimensions a tree over all points prunes little above its leaves, so points are
first brought together by their groups: sets of a and b shingles with a Jaccard similarity
of 4/5 differ in at most (a + b) / 9, so of more groups than that one has the same
shingles in both. Each group's content is a key; documents without a common key cannot link.

Documents with equal sets are one class from the start. The least class of a key is its hub.
A first round verifies one pair a class, with the likeliest of its hubs; classes in one
component need no further pairs among themselves. A second round builds a tree over each
hub's documents. Those in a pair between components that the points leave get their texts,
meet once more, and are joined up to a forest: a pair whose documents a link has brought
together meanwhile is not verified. So a cluster of m near copies gives at most m rows at a
hub, whether its members are alike enough to the hub or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, as_bytes, components, staged, stretches, table
from daygrain.llm.repeats import mixed, prefix, prepared, ranges, rolled, word_units

U = np.uint64
WORDS = 5
#: Similarity, as a fraction; the keys below are exact for it.
NUMERATOR, DENOMINATOR = 4, 5
#: Coordinates of a point at least and, from as many shingles on, at most; points of a leaf, children of a node.
LEAST, MOST, LEAF, FAN = 64, 1 << 17, 32, 8
#: Counts of a coordinate that blocks of points are compared by with matrix products, and coordinates of one product.
LAYERS, STRETCH = 2, 1 << 12


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of a text's shingles. Fewer words than a shingle's are one shingle."""
    units = word_units((text or b"").lower())
    if not len(units):
        return np.empty(0, U)
    sums = prefix(units)
    if len(units) < words:
        return ranges(sums, np.array([0]), np.array([len(units)])) + mixed(np.array([len(units)], U))
    return np.unique(rolled(sums, words))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def _group(hashes: np.ndarray, n: int) -> np.ndarray:
    """Groups 0 to n - 1 by the leading bits, so that sorted hashes have sorted groups."""
    return ((hashes >> U(40)) * U(n) >> U(24)).astype(np.int64)


def counts(hashes: np.ndarray) -> np.ndarray:
    """The point of a set: a power of two of coordinates, no fewer than shingles, each in a byte."""
    groups = min(MOST, max(LEAST, 1 << len(hashes).bit_length()))
    while True:
        point = np.bincount(_group(mixed(hashes), groups), minlength=groups)
        if point.max() < 256:
            return point.astype(np.uint8)
        groups *= 2


def folded(points: list[bytes]) -> np.ndarray:
    """Points in one matrix: those of more coordinates give sums of neighbouring ones."""
    raw = [np.frombuffer(p, np.uint8) for p in points]
    least = min(map(len, raw))
    if all(len(p) == least for p in raw):
        return np.stack(raw)
    out = np.stack([p.reshape(least, -1).sum(axis=1, dtype=np.uint32) for p in raw])
    return out.astype(np.min_scalar_type(out.max()))


@lru_cache(None)
def _bounds(upto: int) -> list[int]:
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, -(-out[-1] * DENOMINATOR // NUMERATOR)))
    return out


def keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of which two sets that link have one in common.

    Sizes fall into classes that grow by 5/4, so linked sets are in one class or in
    neighbouring ones: a set has the keys of its class and of the next. At a class with
    sizes below s, linked sets differ in at most d = 2 (s - 1) / 9 shingles. Of d + 1 or
    more groups, one that no difference falls into has equal contents. It may be empty:
    a set with as many empty groups as could stay untouched gives keys of those, too.
    """
    size = len(hashes)
    if not size:
        return np.empty(0, np.int64)
    bounds = _bounds(1 << (size + 1).bit_length() + 1)
    at = int(np.searchsorted(bounds, size, "right")) - 1
    sums = np.zeros(size + 1, U)
    np.cumsum(mixed(hashes + U(1)), out=sums[1:])
    out = []
    for level in (at, at + 1):
        differ = 2 * (bounds[level + 1] - 1) // 9
        n = differ + 1 + differ // 16
        edges = np.searchsorted(_group(hashes, n), np.arange(n + 1))
        full = np.flatnonzero(np.diff(edges))
        which = full if n - len(full) < n - differ else np.arange(n)
        content = sums[edges[which + 1]] - sums[edges[which]]
        out.append(mixed(content + mixed(which.astype(U) + U(level << 32))))
    return np.concatenate(out).view(np.int64)


class CountTree:
    """An R-tree in memory: points in leaves by size, each node with the maxima and the least size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray):
        self.order = np.lexsort((points[:, 0], parts, sizes))
        self.points, self.sizes, self.parts = points[self.order], sizes[self.order], parts[self.order]
        self.levels = [self._node(self.points, self.sizes, self.sizes, self.parts, self.parts, LEAF)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._node(*self.levels[-1], FAN))

    @staticmethod
    def _node(most, low, high, first, last, width):
        at = np.arange(0, len(low), width)
        return (
            np.maximum.reduceat(most, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
            np.minimum.reduceat(first, at), np.maximum.reduceat(last, at),
        )

    @staticmethod
    def _may(most_a, most_b, low_a, low_b, high_a, high_b) -> np.ndarray:
        """Whether the summed minima, and the sizes, leave room for a link. Linked sets share 4/9 of their sizes' sum."""
        shared = np.minimum(most_a, most_b).sum(axis=1, dtype=np.int64)
        near = (DENOMINATOR * high_a >= NUMERATOR * low_b) & (DENOMINATOR * high_b >= NUMERATOR * low_a)
        return near & ((NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * (low_a + low_b))

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points that may link and lie in different parts, block by block; by their numbers in the input."""
        a = b = np.zeros(1, np.int64)
        last = min(1, len(self.levels) - 1)
        for depth in reversed(range(last, len(self.levels))):
            most, low, high, first, upto = self.levels[depth]
            apart = (first[a] != upto[a]) | (first[b] != upto[b]) | (first[a] != first[b])
            a, b = a[apart], b[apart]
            may = [
                self._may(most[i], most[j], low[i], low[j], high[i], high[j])
                for i, j in _slices(a, b, most.shape[1])
            ]
            may = np.concatenate(may) if may else np.empty(0, bool)
            a, b = a[may], b[may]
            if depth > last:
                a, b = self._below(a, b, FAN, len(self.levels[depth - 1][1]))
        width = LEAF * FAN**last
        for i, j in zip((a * width).tolist(), (b * width).tolist()):
            x, y = self._across(*self._between(i, j, width))
            if len(x):
                yield self.order[x], self.order[y]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of the blocks."""
        found = list(self.blocks())
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    def _between(self, i: int, j: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of two blocks of ``width`` points from i and j on that an upper bound of their shared counts leaves.

        The summed minima of two points are the coordinates in which both count 1, 2, ... or
        more: matrix products up to LAYERS, and of the counts beyond at most the fewer.
        """
        a, b = self.points[i : i + width], self.points[j : j + width]
        shared = np.zeros((len(a), len(b)), np.float32)
        rest_a, rest_b = a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64)
        for at in range(0, a.shape[1], STRETCH):
            for t in range(LAYERS):
                x, y = a[:, at : at + STRETCH] > t, b[:, at : at + STRETCH] > t
                rest_a -= x.sum(axis=1)
                rest_b -= y.sum(axis=1)
                shared += x.astype(np.float32) @ y.astype(np.float32).T
        shared = shared.astype(np.int64) + np.minimum(rest_a[:, None], rest_b)
        m, n = self.sizes[i : i + width, None], self.sizes[j : j + width]
        may = (NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * (m + n)
        may &= (DENOMINATOR * m >= NUMERATOR * n) & (DENOMINATOR * n >= NUMERATOR * m)
        may &= self.parts[i : i + width, None] != self.parts[j : j + width]
        x, y = np.nonzero(np.triu(may, 1) if i == j else may)
        return x + i, y + j

    def _across(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs of points that may link."""
        may = [
            self._may(self.points[i], self.points[j], *[self.sizes[x] for x in (i, j, i, j)])
            for i, j in _slices(a, b, self.points.shape[1])
        ]
        may = np.concatenate(may) if may else np.empty(0, bool)
        return a[may], b[may]

    @staticmethod
    def _below(a: np.ndarray, b: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children, each once."""
        x, y = np.divmod(np.arange(width * width), width)
        left = (a[:, None] * width + x).ravel()
        right = (b[:, None] * width + y).ravel()
        fine = (left < n) & (right < n) & (left <= right)
        return left[fine], right[fine]


def _slices(a: np.ndarray, b: np.ndarray, width: int):
    """Parts of the pairs whose points take about 8 MB."""
    step = max(1, (1 << 21) // width)
    return ((a[i : i + step], b[i : i + step]) for i in range(0, len(a), step))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """The columns of ``docs``, ``text`` only if asked for, and n_shingles, component_id and kept for every row.

    component_id: the smallest key among the rows reachable by links of similarity 4/5 or
    more; kept: whether the row is the first of its component by (key, position). Null and
    blank texts have no shingles, link with nothing and are kept; null keys are passed over
    when the smallest is sought and come first in the order. Rows with equal keys are rows
    of their own. Columns named as a result are replaced.
    """
    body = prepared(docs, key, text, "texts")

    def describe(batches: Batches) -> Batches:
        for batch in stretches(batches):
            rows = []
            for t in as_bytes(batch.column("text")):
                s = shingles(t)
                # two sums over the set tell sets apart
                sums = [int(mixed(s + U(i)).sum(dtype=U).view(np.int64)) for i in (3, 5)]
                rows.append((len(s), *sums, counts(s).tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            made = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), *made],
                names=["row_key", "doc_id", "n", "one", "two", "point"],
            )

    kind = body.schema["doc_id"].dataType.simpleString()
    sets = body.select("row_key", "doc_id", "text").mapInArrow(
        describe, f"row_key long, doc_id {kind}, n long, one long, two long, point binary"
    )
    sets = staged(sets, "sets")
    same = ["n", "one", "two"]
    classes = sets.where("n > 0").groupBy(*same).agg(F.min("row_key").alias("id"), F.first("point").alias("point"))
    classes = staged(classes, "classes")
    reps = classes.selectExpr("id AS row_key")

    def emit(batches: Batches) -> Batches:
        for batch in stretches(batches):
            made = [keys(shingles(t)) for t in as_bytes(batch.column("text"))]
            row = np.repeat(batch.column("row_key").to_numpy(), [len(k) for k in made])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made)), pa.array(row)], names=["key", "id"])

    of_reps = body.select("row_key", "text").join(reps, "row_key")
    by_key = of_reps.mapInArrow(emit, "key long, id long").repartition("key").sortWithinPartitions("key", "id")
    live = staged(by_key.mapInArrow(_shared_keys, "key long, id long, hub long"), "keys")

    # first round: each class against the hub whose point is the most like its own
    points = classes.select("id", "n", "point")
    hubs = points.withColumnsRenamed({"id": "hub", "n": "hub_n", "point": "hub_point"})
    stars = live.where("id <> hub").select("id", "hub").distinct()
    stars = stars.join(points, "id").join(hubs, "hub")
    stars = staged(stars.mapInArrow(_bounded, "id long, hub long, may boolean, near boolean, score double"), "stars")
    best = stars.where("may").groupBy("id").agg(F.max_by("hub", F.struct("score", -F.col("hub"))).alias("hub"))
    best = staged(best, "best")
    first = staged(_verified(body, best), "links")
    part = components(first, "id", "hub", "parts").withColumnsRenamed({"node": "id", "component": "part"})
    part = staged(classes.select("id").join(part, "id", "left").withColumn("part", F.coalesce("part", "id")), "parts")

    # second round: documents with a key in common have its hub in common, so each hub's documents get a tree
    around = _open_stars(stars, first, part)
    pointed = around.join(points, "id").repartition("hub").sortWithinPartitions("hub", "n")
    apart = pointed.select("hub", "id", "part", "n", "point").mapInArrow(_apart, "hub long, id long, part long")
    texts = body.select(F.col("row_key").alias("id"), "text")
    gathered = apart.join(texts, "id").repartition("hub").sortWithinPartitions("hub", "id")
    second = staged(gathered.select("hub", "id", "part", "text").mapInArrow(_joined, "id long, hub long"), "links")

    of = components(first.unionByName(second), "id", "hub", "parts")
    of = of.withColumnsRenamed({"node": "id", "component": "root"})
    members = sets.where("n > 0").join(classes.select(*same, "id"), same).select("row_key", "doc_id", "id")
    rooted = members.join(of, "id", "left").withColumn("root", F.coalesce("root", "id"))
    head = rooted.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct("doc_id", "row_key")).alias("head")
    )
    rooted = rooted.join(head, "root").select(
        "row_key", "component_id", (F.col("head.row_key") == F.col("row_key")).alias("kept")
    )
    out = body if with_text else body.drop("text")
    out = out.join(sets.select("row_key", "n"), "row_key").join(rooted, "row_key", "left").select(
        *[c for c in out.columns if c in ("rest", "text")],
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
    )
    new = ["n_shingles", "component_id", "kept"]
    rest = [F.col("rest")[c].alias(c) for c in docs.columns if c not in (text, *new)]
    return out.select(*rest, *new, *([F.col("text").alias(text)] if with_text else []))


def _open_stars(stars: DataFrame, first: DataFrame, part: DataFrame) -> DataFrame:
    """(hub, id, part): the documents around each hub that may still link across parts.

    1 - similarity is a distance. A document linked to the hub is within 1/5 of it, so one
    that is not near, with a similarity under 3/5, links with none of those. The linked
    ones are left out, then, unless a near document of another part is there.
    """
    direct = first.select("id", "hub", F.lit(True).alias("direct"))
    hub_part = part.selectExpr("id AS hub", "part AS hub_part")
    rows = stars.select("id", "hub", "near").join(direct, ["id", "hub"], "left").join(part, "id").join(hub_part, "hub")
    rows = rows.withColumn("direct", F.coalesce("direct", F.lit(False)))
    opened = F.max(F.col("near") & ~F.col("direct") & (F.col("part") != F.col("hub_part"))).alias("opened")
    open_hubs = rows.groupBy("hub", "hub_part").agg(opened).where("opened").drop("opened")
    kept = rows.join(open_hubs.select("hub", F.lit(True).alias("opened")), "hub", "left").where("NOT direct OR opened")
    kept = kept.select("hub", "id", "part").unionByName(open_hubs.selectExpr("hub", "hub AS id", "hub_part AS part"))
    several = kept.groupBy("hub").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("hub")
    return kept.join(several, "hub")


def _shared_keys(batches: Batches) -> Batches:
    """Rows whose key another id has, with the first id of the key. The rows come sorted by key and id."""
    last = None  # (key, hub, id, whether it is written)
    for batch in batches:
        key, ids = batch.column("key").to_numpy(), batch.column("id").to_numpy()
        if not len(key):
            continue
        new = np.concatenate([[last is None or key[0] != last[0]], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        hub = np.empty(len(key), np.int64)
        run = np.cumsum(new) - 1
        hub[run >= 0] = ids[starts][run[run >= 0]] if len(starts) else 0
        hub[run < 0] = last[1] if last else 0
        follows = np.concatenate([~new[1:], [False]])
        write = ~new | follows
        rows = [(key[write], ids[write], hub[write])]
        if last is not None and not new[0] and not last[3]:
            rows.insert(0, ([last[0]], [last[2]], [last[1]]))
        last = (key[-1], hub[-1], ids[-1], bool(write[-1]))
        k, i, h = (np.concatenate(c).astype(np.int64) for c in zip(*rows))
        distinct = np.concatenate([[True], (k[1:] != k[:-1]) | (i[1:] != i[:-1])]) if len(k) else np.empty(0, bool)
        yield pa.RecordBatch.from_arrays([pa.array(c[distinct]) for c in (k, i, h)], names=["key", "id", "hub"])


def _bounded(batches: Batches) -> Batches:
    """For each pair whether the points leave room for a link, or for 3/5, and the bound of the similarity."""
    for batch in batches:
        pairs = zip(batch.column("point").to_pylist(), batch.column("hub_point").to_pylist())
        n = batch.column("n").to_numpy() + batch.column("hub_n").to_numpy()
        shared = np.array([np.minimum(*folded(list(p))).sum() for p in pairs], np.int64)
        may = (NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * n
        near = 5 * shared >= 3 * (n - shared)
        score = shared / np.maximum(1, n - shared)
        columns = [batch.column("id"), batch.column("hub"), *map(pa.array, (may, near, score))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "hub", "may", "near", "score"])


def _by_hub(batches: Batches) -> Iterator[list[tuple]]:
    """The rows of each hub, the first column. They come sorted by hub."""
    held: list[tuple] = []
    for batch in stretches(batches):
        columns = [as_bytes(c) if pa.types.is_string(c.type) else c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if held and row[0] != held[0][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _apart(batches: Batches) -> Batches:
    """(hub, id, part) of the documents that, by their points, may link with one of another part around the hub."""
    for rows in _by_hub(batches):
        _, ids, parts, sizes, points = zip(*rows)
        flags = np.zeros(len(ids), bool)
        for a, b in CountTree(folded(points), np.array(sizes, np.int64), np.array(parts, np.int64)).blocks():
            flags[a] = flags[b] = True
        columns = [np.full(flags.sum(), rows[0][0]), np.array(ids)[flags], np.array(parts)[flags]]
        if flags.any():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["hub", "id", "part"])


def _joined(batches: Batches) -> Batches:
    """Links (id, hub) that join the parts of the documents around each hub."""
    for rows in _by_hub(batches):
        ids = np.array([row[1] for row in rows], np.int64)
        links = forest([shingles(row[3]) for row in rows], np.array([row[2] for row in rows], np.int64))
        if links:
            a, b = ids[np.array(links)].T
            columns = [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "hub"])


def forest(sets: list[np.ndarray], parts: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of sets that link, by their numbers: as few as join all parts that any linked pair joins."""
    sizes = np.array([len(s) for s in sets])
    tree = CountTree(folded([counts(s).tobytes() for s in sets]), sizes, parts)
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sets = np.split(flat, np.cumsum(sizes)[:-1])
    root = np.unique(parts, return_inverse=True)[1]
    held = np.zeros(len(names), bool)
    out = []
    for a, b in tree.blocks():
        for i in np.unique(a).tolist():
            others = b[a == i]
            others = others[root[others] != root[i]]
            if not len(others):
                continue
            held[sets[i]] = True
            starts = np.cumsum(sizes[others]) - sizes[others]
            both = np.add.reduceat(held[np.concatenate([sets[j] for j in others])], starts, dtype=np.int64)
            held[sets[i]] = False
            fine = (both > 0) & (DENOMINATOR * both >= NUMERATOR * (sizes[i] + sizes[others] - both))
            for j in others[fine].tolist():
                if root[j] != root[i]:
                    out.append((i, j))
                    root[root == root[j]] = root[i]
    return out


def _verified(body: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (id, hub) whose sets link. One text of each pair is moved."""
    texts = body.select("row_key", "text")
    hub = texts.selectExpr("row_key AS hub", "text AS hub_text")
    both = pairs.join(hub, "hub").join(texts.withColumnRenamed("row_key", "id"), "id")

    def verify(batches: Batches) -> Batches:
        known: tuple = (None, None)
        for batch in stretches(batches):
            fine = []
            hubs = batch.column("hub").to_pylist()
            for i, (t, o) in enumerate(zip(as_bytes(batch.column("text")), as_bytes(batch.column("hub_text")))):
                if known[0] != hubs[i]:
                    known = (hubs[i], shingles(o))
                fine.append(linked(shingles(t), known[1]))
            mask = pa.array(fine, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("id", "hub")], names=["id", "hub"])

    return both.select("id", "hub", "text", "hub_text").mapInArrow(verify, "id long, hub long")


def query(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
