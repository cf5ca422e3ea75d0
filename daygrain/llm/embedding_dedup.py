"""Embedding near-dedup: binary codes of randomly rotated vectors decide what is computed exactly.

A unit vector o is turned by a random orthogonal matrix and stored as the signs x of its
coordinates, scaled to a unit vector, with the correction factor c = <o, x>. For another
unit vector q and t = <q, x>, the quotient t / c is an unbiased estimate of <o, q>, and as
the parts of o and q beside x have lengths sqrt(1 - c^2) and sqrt(1 - t^2),

    |<o, q> - c t| <= sqrt(1 - c^2) sqrt(1 - t^2)

holds for certain: a confidence interval of level 1, so no link is missed. Only pairs whose
interval reaches the threshold are recomputed, in double precision.

Vectors are compared within their label. Equal vectors count as one with a weight. A
label's vectors are laid in the order of their nearest pivot and cut into blocks; two
blocks meet only if the angle of their centres, less both radii, leaves room for a link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, components, staged, table

THRESHOLD = 0.93
#: Vectors of a block, rows compared at once, pivots of a label, the rotation's seed.
BLOCK, ROWS, PIVOTS, SEED = 2048, 256, 16, 20
#: What rounding may take from a bound.
SLACK = 1e-6


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Sign codes of unit vectors and their correction factors."""

    def __init__(self, units: np.ndarray):
        dim = units.shape[1]
        self.turn = rotation(dim)
        turned = units @ self.turn
        self.signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(dim)
        self.factor = np.minimum(1.0, np.einsum("ij,ij->i", turned, self.signs))

    def products(self, queries: np.ndarray) -> np.ndarray:
        """t: the inner products of ``queries`` with the codes."""
        return (queries @ self.turn) @ self.signs.T

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unbiased estimates of all inner products with ``queries``, and their certain bounds."""
        t, c = self.products(queries), self.factor
        error = np.sqrt(np.maximum(0, 1 - c * c)) * np.sqrt(np.maximum(0, 1 - t * t)) + SLACK
        return t / c, c * t - error, c * t + error

    def least(self, threshold: float) -> np.ndarray:
        """For each code, the t below which the upper bound is under ``threshold``."""
        angle = np.arccos(self.factor) + math.acos(max(-1.0, threshold - SLACK))
        return np.where(angle >= math.pi, -2.0, np.cos(np.minimum(angle, math.pi)) - SLACK)


def links(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with a cosine of at least ``threshold``; of one block, each pair once."""
    a, codes = units(left), Codes(units(right))
    least = codes.least(threshold)
    found = []
    for at in range(0, len(a), ROWS):
        i, j = np.nonzero(codes.products(a[at : at + ROWS]) >= least)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        exact = cosine(left[i], right[j]) >= threshold
        found.append((i[exact], j[exact]))
    return tuple(np.concatenate(c) for c in zip(*found))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that their squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (scaled(x) if len(x) else x for x in (a, b))
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """Columns key, n_links, component_id and kept for every row of ``vectors``.

    n_links: other rows of the label with a cosine of at least ``threshold``; component_id:
    the smallest key reachable by links; kept: whether that is the row's own. A vector with
    a null label, or one that is null, empty, zero or holds a null or non-finite component,
    links with nothing; neither do vectors of different lengths. Rows with equal keys are
    rows of their own. Null keys are passed over when the smallest is sought, and such rows
    are never kept. An empty table gives no rows; other columns play no part.
    """
    keyed = vectors.select(F.col(key).alias("id"), F.col(embedding).alias("v"), F.col(label).alias("label"))
    keyed = staged(keyed.withColumn("row_key", F.monotonically_increasing_id()), "vectors")
    double = F.transform("v", lambda x: x.cast("double") + F.lit(0.0))  # one zero, one type
    usable = keyed.where("label IS NOT NULL AND v IS NOT NULL").withColumn("v", double)
    usable = usable.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usable = usable.where(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))
    same = ["label", "dim", "v"]
    classes = staged(usable.groupBy(*same).agg(F.count("*").alias("n"), F.min("row_key").alias("class")), "classes")
    members = staged(usable.join(classes, same).select("row_key", "id", "class", "n"), "members")

    blocks = staged(_blocks(classes, block), "blocks")
    found = staged(_compared(blocks, threshold), "links")
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("others"))
    of = components(found.where("b IS NOT NULL"), "a", "b", "links").withColumnsRenamed({"node": "class", "component": "root"})
    placed = members.join(linked, "class", "left").join(of, "class", "left")
    placed = placed.withColumn("root", F.coalesce("root", "class"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    links_of = (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    placed = placed.join(least, "root").select("row_key", links_of, "component_id")
    out = keyed.select("row_key", "id").join(placed, "row_key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _pivots(classes: DataFrame) -> DataFrame:
    """At most PIVOTS vectors of each label, drawn by hash. They only order the vectors."""
    drawn = classes.withColumn("h", F.xxhash64("class"))
    drawn = drawn.groupBy("label", "dim", F.pmod("h", F.lit(PIVOTS)).alias("cell")).agg(F.min_by("v", "h").alias("v"))
    return drawn.groupBy("label", "dim").agg(F.collect_list("v").alias("pivots"))


def _blocks(classes: DataFrame, block: int) -> DataFrame:
    """Rows of at most ``block`` vectors of one label: their numbers and weights, a matrix, centre and radius."""
    label = classes.schema["label"].dataType.simpleString()

    def nearest(batches: Batches) -> Batches:
        for batch in batches:
            cells, angles = [], []
            for v, p in zip(batch.column("v").to_pylist(), batch.column("pivots").to_pylist()):
                cos = (units(np.array(p)) @ units(np.array([v]))[0]).clip(-1, 1)
                cells.append(int(cos.argmax()))
                angles.append(float(np.arccos(cos.max())))
            kept = [c for c in batch.schema.names if c != "pivots"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(cells, pa.int32()), pa.array(angles, pa.float64())],
                names=[*kept, "cell", "angle"],
            )

    def cut(batches: Batches) -> Batches:
        held: list[tuple] = []
        number = TaskContext.get().partitionId() << 32

        def row():
            x = np.array([h[2] for h in held])
            u = units(x)
            centre = u.sum(axis=0)
            size = np.sqrt(centre @ centre)
            centre = centre / size if size > 0 else u[0]
            radius = float(np.arccos((u @ centre).clip(-1, 1)).max())
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "label": held[0][0], "dim": held[0][1], "block": number, "centre": centre.tolist(), "radius": radius,
                        "ids": [h[4] for h in held], "weights": [h[3] for h in held], "matrix": x.tobytes(),
                    }
                ],
                schema=kinds,
            )

        kinds = None
        for batch in batches:
            kinds = kinds or pa.schema(
                [
                    batch.schema.field("label"), ("dim", pa.int32()), ("block", pa.int64()),
                    ("centre", pa.list_(pa.float64())), ("radius", pa.float64()),
                    ("ids", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64())), ("matrix", pa.binary()),
                ]
            )
            for h in zip(*[batch.column(c).to_pylist() for c in ("label", "dim", "v", "n", "class")]):
                if held and (len(held) == block or h[:2] != held[0][:2]):
                    yield row()
                    number += 1
                    held = []
                held.append(h)
        if held:
            yield row()

    schema = f"label {label}, dim int, v array<double>, n long, class long, cell int, angle double"
    joined = classes.join(_pivots(classes), ["label", "dim"]).select("label", "dim", "v", "n", "class", "pivots")
    order = ["label", "dim", "cell", "angle"]
    placed = staged(joined.mapInArrow(nearest, schema), "placed")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(
        cut,
        f"label {label}, dim int, block long, centre array<double>, radius double, "
        "ids array<long>, weights array<long>, matrix binary",
    )


def forest(i: np.ndarray, j: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of ``n``) and columns (of ``m``) of links that join what the links (i, j) join, and no more than are needed.

    Breadth first from each row in turn; a link is looked at once from either end.
    """
    linked = np.zeros((n, m), bool)
    linked[i, j] = True
    new_row, new_column = linked.any(axis=1), linked.any(axis=0)
    rows, columns = [], []
    for start in np.flatnonzero(new_row):
        if not new_row[start]:
            continue
        new_row[start] = False
        front = np.array([start])
        while len(front):
            met = np.flatnonzero(new_column)
            seen = linked[np.ix_(front, met)]
            met, seen = met[hit := seen.any(axis=0)], seen[:, hit]
            rows.append(front[seen.argmax(axis=0)])
            columns.append(met)
            new_column[met] = False
            back = np.flatnonzero(new_row)
            seen = linked[np.ix_(back, met)]
            back, seen = back[hit := seen.any(axis=1)], seen[hit]
            rows.append(back)
            columns.append(met[seen.argmax(axis=1)] if len(back) else met[:0])
            new_row[back] = False
            front = back
    none = [np.zeros(0, np.int64)]
    return np.concatenate([*none, *rows]), np.concatenate([*none, *columns])


def _compared(blocks: DataFrame, threshold: float) -> DataFrame:
    """What the links between classes come to: ``a, b`` that join them, and ``a, n``, the linked rows of other classes.

    The rows of two blocks are at most two per class, however many links there are.
    """
    centres = blocks.select("label", "dim", "block", "centre", "radius")
    a = centres.withColumnsRenamed({"block": "a", "centre": "centre_a", "radius": "radius_a"})
    b = centres.withColumnsRenamed({"block": "b", "centre": "centre_b", "radius": "radius_b"})
    cos = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos))) - F.col("radius_a") - F.col("radius_b")
    near = (F.col("a") == F.col("b")) | (apart <= math.acos(threshold) + SLACK)
    pairs = a.join(b, ["label", "dim"]).where((F.col("a") <= F.col("b")) & near).select("a", "b")
    side = lambda s: blocks.select(
        F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("dim", "ids", "weights", "matrix")]
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def compare(batches: Batches) -> Batches:
        for batch in batches:
            for r in batch.to_pylist():
                x, y = (np.frombuffer(r[f"matrix_{s}"]).reshape(-1, r[f"dim_{s}"]) for s in "ab")
                same = r["a"] == r["b"]
                i, j = links(x, y, threshold, same)
                ids, weights = ([np.array(r[f"{c}_{s}"], np.int64) for s in "ab"] for c in ("ids", "weights"))
                others = [np.zeros(len(v), np.int64) for v in ids]
                np.add.at(others[0], i, weights[1][j])
                np.add.at(others[1], j, weights[0][i])
                ends = [np.r_[i, j], np.r_[j, i]] if same else [i, j]
                row, column = forest(*ends, len(ids[0]), len(ids[1]))
                counted = [(v[n > 0], n[n > 0]) for v, n in zip(ids, others)]
                first = np.concatenate([ids[0][row], *(v for v, _ in counted)])
                second = pa.concat_arrays([pa.array(ids[1][column], pa.int64()), pa.nulls(len(first) - len(row), pa.int64())])
                n = pa.concat_arrays([pa.nulls(len(row), pa.int64()), *(pa.array(n, pa.int64()) for _, n in counted)])
                yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), second, n], names=["a", "b", "n"])

    return both.mapInArrow(compare, "a long, b long, n long")


def query(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
