"""Embedding near-duplicates: cover trees and a dual traversal that yields exactly the pairs above a cosine.

For unit vectors a cosine of c is a distance of sqrt(2 - 2c), a metric. Equal vectors are one representative. The rows are
first dealt to the nearest of many pivots (a bounded sample, neighbours side by side); blocks of a bounded
number of values hold some pivots' rows each, a large pivot gives many blocks. Each block gets a cover tree: nested centres at halving
radii, every row below the first centre that covers it. Block pairs are the upper level of the traversal: a pair whose centres are
farther apart than both covering radii and the threshold is never formed. From a block pair the traversal goes
down level by level on both sides with the same bound, from the covering radii as measured, and compares the rows that
remain; levels that hardly merge anything are passed over. No bound is estimated, so the pairs are exact.

Most pairs fall to two screens in single precision, with margins for its rounding. The rows of a pivot lie within an angle
around their mean direction; a row farther from it than that angle and the threshold's is near none of them. What is left is
compared on the principal axes of the sample, where a distance is never larger than the whole one, and then on whole vectors, in
double precision wherever single precision does not settle it.

A stored block is one row. Neighbouring blocks are a strip, two strips are a task's cell, and cells are dealt out
in rounds that copy a bounded volume, so the disk holds a few copies of the vectors however many cells there are.

A task returns each vector's number of links and a spanning set of them, never all pairs.

NULL, empty, zero or non-finite vectors (or with such or NULL components) link with nothing; vectors of different length
never link; repeated rows are rows (rows of one id are counted each); other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.common import forget, give_back, stored
from stridelake.llm.graph import components

COSINE = 0.95
#: Values in a block; pivots that the others are sorted by, and rows of the sample at least; radii of the levels.
BLOCK_VALUES, PIVOTS, SAMPLE = 1 << 18, 64, 2048
RADII = (1.0, 0.5, 0.25, 0.125)
#: Rows in a block and blocks in a strip at most; strips that a smaller table is cut to; values that a round of cells copies,
#: or twice the table.
BLOCK_ROWS, STRIP_BLOCKS, STRIPS, ROUND_VALUES = 1 << 12, 32, 8, 1 << 26
#: Rows for each pivot, values of all pivots at most; rows in a run, what is screened by one direction; steps to find it, and
#: how fast far rows gain weight in them; rows up to which all are counted before they are dealt.
PIVOT_ROWS, PIVOT_VALUES, RUN_ROWS, CAP_STEPS, CAP_GAIN, COUNTED = 128, 1 << 20, 192, 5, 10.0, 1 << 18
#: Axes of the screen: the fewest that leave this share of the sample's far pairs; rows of the sample that they
#: are fitted on, and tried on.
AXES, LEFT_OVER, PAIRED = (16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512), 1e-5, 512
#: Margin of the screen for each of its terms, far above the rounding of their sum; rows and columns of one product; pairs handed on at a time.
MARGIN, AT_ONCE, PAIRS = 4e-6, (256, 1024), 1 << 18


def _matrix(vectors, dim: int) -> np.ndarray:
    """Vectors as stored, in single or double precision."""
    raw, n = b"".join(vectors), len(vectors)
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * n * dim else np.float64).reshape(n, dim)


def _units(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    return x + 0.0


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def _limit(cosine: float) -> float:
    return math.sqrt(2.0 - 2.0 * cosine) + 1e-7


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, digest, dim, vector``: the vector's values in the table's precision and the digest that vectors of equal direction
    share, made of the vector at length 1 as doubles; NULL if invalid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values, at = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size
            digest, vector, dims = [None] * len(size), [None] * len(size), np.zeros(len(size), np.int32)
            for dim in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == dim)
                v = values[at[rows][:, None] + np.arange(dim)]
                valid = np.isfinite(v).all(1) & v.any(1)
                rows, v = rows[valid], v[valid]
                dims[rows] = dim
                for row, own, unit in zip(rows, v, _units(v)):
                    digest[row], vector[row] = xxhash.xxh3_128_digest(unit.tobytes()), own.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(digest, pa.binary()), pa.array(dims), pa.array(vector, pa.binary())],
                                             ["vec_id", "digest", "dim", "vector"])

    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    slim = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    return slim.mapInArrow(run, "vec_id long, digest binary, dim int, vector binary")


def _pivots(x: np.ndarray, rows: int) -> np.ndarray:
    """A pivot of the sample for each ``PIVOT_ROWS`` rows, sorted by the nearest of ``PIVOTS`` farthest-first ones."""
    x = x[: min(-(-rows // PIVOT_ROWS), max(1, PIVOT_VALUES // x.shape[1]))]
    chosen, far = [0], _distances(x, x[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[chosen[-1:]])[:, 0])
    return x[np.argsort((x @ x[chosen].T).argmax(1), kind="stable")]


def _packed(many: np.ndarray, size: int, first: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each pivot its first block and the number of its blocks, of its rows; the end of the blocks."""
    start, parts = np.zeros(len(many), np.int64), np.maximum(1, -(-many // size))
    block, filled = first, 0
    for k, rows in enumerate(many):
        if filled and filled + rows > size:
            block, filled = block + 1, 0
        start[k] = block
        block, filled = (block + parts[k], 0) if parts[k] > 1 else (block, filled + rows)
    return start, parts, int(block) + 1


def _axes(x: np.ndarray, cosine: float) -> np.ndarray:
    """Principal axes of a sample, as columns: orthonormal, so a distance on them is at most the whole one."""
    fit, rest = x[: 2 * PAIRED : 2], x[1 : 2 * PAIRED : 2]
    axes = np.linalg.svd(fit - fit.mean(0), full_matrices=False)[2].T
    on, limit = rest @ axes, _limit(cosine)
    far = _distances(rest, rest) > limit
    for n in AXES:
        if n >= axes.shape[1] or not len(rest):
            break
        own = on[:, :n]
        half = (own * own).sum(1) / 2.0
        if ((half[:, None] + half - own @ own.T <= limit * limit / 2.0) & far).mean() <= LEFT_OVER:
            return axes[:, :n]
    return axes


def cover_tree(x: np.ndarray) -> np.ndarray:
    """For each row its centre (a row) at each level: nested, a centre covers rows within the level's radius."""
    n = len(x)
    single = x.astype(np.float32)
    product = single @ single.copy().T  # of one array and itself numpy makes a triangle and copies it value by value
    path = np.empty((len(RADII), n), np.int32)
    above, busy = np.zeros(n, np.int32), np.arange(n)
    np.fill_diagonal(product, -1.0)
    for level, radius in enumerate(RADII):
        path[level] = np.arange(n)  # a row that is near no other one is its own centre
        least = 1.0 - radius * radius / 2.0 + 1e-6  # never farther than the radius, for all the rounding
        busy = busy[product[busy].max(1) >= least] if level else np.flatnonzero(product.max(1) >= least)
        free = np.zeros(n, bool)
        free[busy] = True
        for i in busy:
            if free[i]:
                own = free & (product[i] >= least) & (above == above[i])
                path[level, own] = i
                free[own] = free[i] = False
        above = path[level]
    return path


def _farthest(x: np.ndarray, runs: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """For each run the smallest cosine of a row to its direction."""
    return np.minimum.reduceat(np.einsum("ij,ij->i", x, np.repeat(directions.astype(np.float64), np.diff([*runs, len(x)]), axis=0)), runs)


class _Tree:
    """A block's rows with the levels of its cover tree; the rows are the last level. A level is made when it is asked for.

    ``runs`` are the first rows of stretches of rows, with a direction each; ``least`` is the cosine to it that a row near one of
    a run's rows has at least.
    """

    def __init__(self, rows: np.ndarray, path: np.ndarray, axes: np.ndarray, limit: float,
                 runs: np.ndarray | None = None, directions: np.ndarray | None = None):
        x = _units(rows)
        self.rows, self.single, self.on, self.limit = rows, x.astype(np.float32), (x @ axes).astype(np.float32), limit
        self.path = [*path, np.arange(len(x))]
        self.sizes = [int((centres == self.path[-1]).sum()) for centres in self.path]
        self.made: dict[int, tuple] = {}
        self.runs = None
        if runs is not None:
            sizes = np.diff([*runs, len(x)])
            angle = np.arccos(np.clip(_farthest(x, runs, directions), -1.0, 1.0)) + 2.0 * math.asin(min(1.0, limit / 2.0))
            self.runs, self.directions = list(zip(runs.tolist(), (runs + sizes).tolist())), directions
            self.least = np.cos(np.minimum(angle, np.pi)) - MARGIN * (x.shape[1] + 3)

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return _units(self.rows[rows])

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The nodes' rows, each row's node, and the nodes as left and right side of the screen: their places on the axes and what
        makes a product of both sides non-negative if two nodes are within the limit and both covering radii, half of
        (limit + r + s) ** 2 less half of the squared distance."""
        if k not in self.made:
            nodes, at = np.unique(self.path[k], return_inverse=True) if self.sizes[k] < len(self.rows) else (self.path[-1], self.path[-1])
            radius = np.zeros(len(nodes))
            if len(nodes) < len(self.rows):
                x = _units(self.rows)
                cosines = np.einsum("ij,ij->i", x, x[self.path[k]])
                np.maximum.at(radius, at, np.sqrt(np.maximum(2.0 - 2.0 * cosines, 0.0)))
            on, one = self.on[nodes].astype(np.float64), np.ones(len(nodes))
            own = self.limit**2 / 4.0 + radius**2 / 2.0 + self.limit * radius - (on * on).sum(1) / 2.0 + MARGIN / 2.0 * (on.shape[1] + 3)
            self.made[k] = nodes, at, *(np.column_stack([on, radius, *ends]).astype(np.float32) for ends in ((own, one), (one, own)))
        return self.made[k]


def _descents(x: _Tree, y: _Tree) -> list[int]:
    """Levels worth a stop on the way to the rows: where the pairs of nodes are a quarter of the next stop's at most."""
    stops = [len(x.sizes) - 1]
    for level in reversed(range(stops[0])):
        if 4 * x.sizes[level] * y.sizes[level] <= x.sizes[stops[0]] * y.sizes[stops[0]]:
            stops.insert(0, level)
    return stops


def _screened(x: _Tree, y: _Tree, left: int, right: int, by_run: bool) -> Iterator[tuple[slice, slice | np.ndarray]]:
    """Stretches of the left and the right side to compare: everything, or what the directions of the left side's runs leave."""
    if not by_run:
        for r in range(0, left, AT_ONCE[0]):
            for c in range(0, right, AT_ONCE[1]):
                yield slice(r, min(left, r + AT_ONCE[0])), slice(c, min(right, c + AT_ONCE[1]))
        return
    for (r, end), near, least in zip(x.runs, x.directions @ y.single.T, x.least):
        some = np.flatnonzero(near >= least)
        for c in range(0, len(some), AT_ONCE[1]):
            yield slice(r, end), some[c : c + AT_ONCE[1]]


def _traverse(x: _Tree, y: _Tree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of x, rows of y) with at least this cosine, some at a time."""
    stops = _descents(x, y)
    i, j, alive = np.arange(x.sizes[stops[0]]), np.arange(y.sizes[stops[0]]), None
    space = np.empty(max(AT_ONCE[0], RUN_ROWS) * AT_ONCE[1], np.float32)
    for stop, below in zip(stops, [*stops[1:], None]):
        left, right = x.level(stop)[2].take(i, axis=0), y.level(stop)[3].take(j, axis=0)
        keep = None if below is None else np.zeros((len(i), len(j)), bool)
        found, n = [], 0
        for part in _screened(x, y, len(i), len(j), x.runs is not None and alive is None and below is None):
            some, others = left[part[0]], right[part[1]] if isinstance(part[1], slice) else right.take(part[1], axis=0)
            product = np.matmul(some, others.T, out=space[: len(some) * len(others)].reshape(len(some), len(others)))
            if product.max() < 0.0:
                continue
            hit = product >= 0.0
            if alive is not None:
                hit &= alive[part]
            if keep is not None:
                keep[part] = hit
                continue
            at = np.flatnonzero(hit)
            own, other = i[part[0]], j[part[1]]
            a, b = own[at // len(other)], other[at % len(other)]
            if 16 * len(at) > hit.size:
                value = (x.single[own] @ y.single[other].T).ravel()[at]
            else:
                value = np.einsum("ij,ij->i", x.single[a], y.single[b])
            near = value >= cosine
            unsure = np.flatnonzero(np.abs(value - cosine) <= MARGIN * (x.single.shape[1] + 3))
            near[unsure] = np.einsum("ij,ij->i", x.exact(a[unsure]), y.exact(b[unsure])) >= cosine
            found.append((a[near], b[near]))
            n += len(found[-1][0])
            if n >= PAIRS:
                yield tuple(map(np.concatenate, zip(*found)))
                found, n = [], 0
        if below is None:
            if n:
                yield tuple(map(np.concatenate, zip(*found)))
            return
        up, down = [], []
        for tree, at, some, own in ((x, i, keep.any(1), up), (y, j, keep.any(0), down)):
            place = np.full(tree.sizes[stop], -1)
            place[at[some]] = np.flatnonzero(some)
            place = place[tree.level(stop)[1][tree.level(below)[0]]]  # of each lower node's ancestor
            own += [np.flatnonzero(place >= 0), place[place >= 0]]
        (i, above), (j, beside) = up, down
        if not len(i):
            return
        alive = keep[above][:, beside]  # children of the node pairs that are left


def dual_traversal(x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (row of x, row of y) with at least this cosine."""
    axes, limit = _axes(x, cosine), _limit(cosine)
    found = list(_traverse(_Tree(x, px, axes, limit), _Tree(y, py, axes, limit), cosine))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def _connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _dealt(dim: int, pivots: np.ndarray, start: np.ndarray | None = None, parts: np.ndarray | None = None):
    """The pivot and, with each pivot's first block and number of blocks, the block of a vector."""
    single = pivots.astype(np.float32)

    def deal(vector: pd.Series, number: pd.Series) -> pd.DataFrame:
        pivot = (_units(_matrix(vector, dim)).astype(np.float32) @ single.T).argmax(1)
        block = pivot if start is None else start[pivot] + number.to_numpy() % parts[pivot]
        return pd.DataFrame({"pivot": pivot.astype(np.int32), "block": block.astype(np.int32)})

    return F.pandas_udf(deal, "pivot int, block int")("vector", F.xxhash64("rep"))


BLOCK = "dim int, strip int, block int, n_rows int, reps binary, counts binary, vectors binary, path binary, runs binary, centre binary, radius double, directions binary"


def _runs(x: np.ndarray, pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by pivot and angle to the pivot's mean direction, and the first rows of runs in it."""
    _, at, sizes = np.unique(pivot, return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    first = np.cumsum(sizes) - sizes
    middle = np.add.reduceat(x[order], first, axis=0)
    order = np.lexsort((-np.einsum("ij,ij->i", x, middle[at]), at))
    runs = -(-sizes // RUN_ROWS)
    return order, np.concatenate([f + np.arange(n) * size // n for f, n, size in zip(first, runs, sizes)])


def _directions(x: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """For each run a direction that its farthest row is near to: means in which the far rows gain weight, the best of a few."""
    sizes = np.diff([*runs, len(x)])
    weight, best, found = np.ones(len(x)), np.full(len(runs), -2.0), np.zeros((len(runs), x.shape[1]), np.float32)
    for _ in range(CAP_STEPS + 1):
        middle = np.add.reduceat(weight[:, None] * x, runs, axis=0)
        middle /= np.maximum(np.linalg.norm(middle, axis=1), 1e-9)[:, None]
        cosines = np.einsum("ij,ij->i", x, np.repeat(middle, sizes, axis=0))
        least = np.minimum.reduceat(cosines, runs)
        better = (least > best) & (np.abs(np.linalg.norm(middle, axis=1) - 1.0) < 1e-6)
        best[better], found[better] = least[better], middle[better]
        weight *= np.exp(-CAP_GAIN * (cosines - np.repeat(least, sizes)))
        weight /= np.repeat(np.maximum.reduceat(weight, runs), sizes)
    none = best < -1.5  # rows that cancel out
    found[none] = x[runs[none]]
    return found


def _tree(table: pa.Table) -> pa.Table:
    table = table.sort_by("rep")
    dim, strip, block = (table.column(c)[0].as_py() for c in ("dim", "strip", "block"))
    vectors = _matrix(table.column("vector").to_pylist(), dim)
    order, runs = _runs(_units(vectors), table.column("pivot").to_numpy())
    vectors = vectors[order]
    x = _units(vectors)
    path = cover_tree(x)
    middle = x.mean(0)
    norm = np.linalg.norm(middle)
    centre = middle / norm if norm > 0 else x[0]
    radius = float(_distances(x, centre[None]).max())
    numbers = [table.column(c).to_numpy().astype(np.int64)[order].tobytes() for c in ("rep", "n")]
    row = [dim, strip, block, len(x), *numbers, vectors.tobytes(), path.astype(np.int16).tobytes(), runs.astype(np.int32).tobytes(), centre.tobytes(), radius,
           _directions(x, runs).tobytes()]
    kinds = [pa.int32()] * 4 + [pa.binary()] * 6 + [pa.float64(), pa.binary()]
    return pa.table([pa.array([v], kind) for v, kind in zip(row, kinds)], names=[c.split()[0] for c in BLOCK.split(", ")])


def blocks(reps: DataFrame, cosine: float) -> tuple[DataFrame | None, dict[int, np.ndarray], int]:
    """Representatives dealt to blocks, each a row with a cover tree; the axes of the screen for each length; the number of values."""
    sizes = {r["dim"]: r["rows"] for r in reps.groupBy("dim").agg(F.count(F.lit(1)).alias("rows")).collect()}
    out, axes, first_block, first_strip = None, {}, 0, 0
    for dim, rows in sorted(sizes.items()):
        size = min(BLOCK_ROWS, max(1, BLOCK_VALUES // dim))
        own = reps.where(F.col("dim") == dim)
        sampled = max(SAMPLE, min(-(-rows // PIVOT_ROWS), PIVOT_VALUES // dim))
        # sorted are only about half as many rows again: every partition sends its smallest ones
        few = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < min(1 << 30, math.ceil(1.5 * sampled / rows * (1 << 30)))
        sample = _units(_matrix([r["vector"] for r in own.where(few).orderBy("digest").select("vector").limit(sampled).collect()], dim))
        pivots, axes[dim] = _pivots(sample, rows), _axes(sample, cosine)
        many, each = np.zeros(len(pivots), np.int64), 1 if rows <= COUNTED else 8  # to fill blocks, a part of the rows is enough
        counted = own.where(F.pmod(F.xxhash64("digest"), F.lit(each)) == 0)
        for r in counted.select(_dealt(dim, pivots).alias("to")).groupBy("to.pivot").agg(F.count(F.lit(1)).alias("n")).collect():
            many[r["pivot"]] = r["n"] * each
        start, parts, end = _packed(many, size, first_block)
        wide = min(STRIP_BLOCKS, -(-(end - first_block) // STRIPS))
        strip = (first_strip + F.floor((F.col("block") - first_block) / wide)).cast("int").alias("strip")
        own = own.withColumn("to", _dealt(dim, pivots, start, parts)).select("dim", "rep", "n", "vector", "to.pivot", "to.block")
        own = own.select("*", strip)
        part = own.groupBy("block").applyInArrow(_tree, BLOCK)
        out = part if out is None else out.unionByName(part)
        first_block, first_strip = end, first_strip + -(-(end - first_block) // wide)
    return out, axes, sum(dim * rows for dim, rows in sizes.items())


def _strip_pairs(treed: DataFrame, cosine: float) -> list[tuple[int, int, int, int]]:
    """``(i, j, values of i, values of j)`` for the strips that can have links. Those too far apart for their covering radii are left out."""

    def summary(table: pa.Table) -> pa.Table:
        own = [table.column(c) for c in ("dim", "strip", "n_rows")]
        centres = np.stack([np.frombuffer(c) for c in table.column("centre").to_pylist()])
        centre = centres.mean(0)
        radius = (np.linalg.norm(centres - centre, axis=1) + table.column("radius").to_numpy()).max()
        dim = own[0][0].as_py()
        return pa.table([pa.array([dim], pa.int32()), pa.array([own[1][0].as_py()], pa.int32()), pa.array([dim * pc.sum(own[2]).as_py()], pa.int64()),
                         pa.array([centre.tobytes()], pa.binary()), pa.array([float(radius)], pa.float64())], names=["dim", "strip", "amount", "centre", "radius"])

    nodes = treed.select("dim", "strip", "n_rows", "centre", "radius").groupBy("strip").applyInArrow(
        summary, "dim int, strip int, amount long, centre binary, radius double").collect()
    found = []
    for dim in sorted({r["dim"] for r in nodes}):
        own = sorted((r for r in nodes if r["dim"] == dim), key=lambda r: r["strip"])
        centres, radii = np.stack([np.frombuffer(r["centre"]) for r in own]), np.array([r["radius"] for r in own])
        for k, r in enumerate(own):
            near = np.linalg.norm(centres[k:] - centres[k], axis=1) <= _limit(cosine) + radii[k:] + radii[k]
            found += [(r["strip"], own[k + m]["strip"], r["amount"], own[k + m]["amount"]) for m in np.flatnonzero(near | (np.arange(len(near)) == 0))]
    return found


def _rounds(pairs: list[tuple[int, int, int, int]], most: int) -> Iterator[list[tuple[int, int]]]:
    """Strip pairs, the largest first, in rounds that copy so many values at most."""
    own, volume = [], 0
    for i, j, a, b in sorted(pairs, key=lambda p: -p[2] * p[3]):
        more = a if i == j else a + b
        if own and volume + more > most:
            yield own
            own, volume = [], 0
        own.append((i, j))
        volume += more
    if own:
        yield own


def _cell(rows: list[dict], axes: dict[int, np.ndarray], cosine: float) -> pa.RecordBatch:
    """``rep, links, other`` of the blocks of two strips: those with links, their number and a spanning set of them."""
    limit = _limit(cosine)
    rows.sort(key=lambda r: r["block"])
    reps, counts = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("reps", "counts"))
    first = np.cumsum([0] + [r["n_rows"] for r in rows])
    trees = [_Tree(_matrix([r["vectors"]], r["n_rows"] * r["dim"]).reshape(-1, r["dim"]), np.frombuffer(r["path"], np.int16).reshape(len(RADII), -1),
                   axes[r["dim"]], limit, np.frombuffer(r["runs"], np.int32), np.frombuffer(r["directions"], np.float32).reshape(-1, r["dim"])) for r in rows]
    centres, radii = np.stack([np.frombuffer(r["centre"]) for r in rows]), np.array([r["radius"] for r in rows])
    strips = np.array([r["strip"] for r in rows])
    lower, upper = np.flatnonzero(strips == strips.min()), np.flatnonzero(strips == strips.max())
    links, label = np.zeros(len(reps), np.int64), np.arange(len(reps))
    waiting, n = [], 0

    def joined() -> np.ndarray:
        a, b = (label[np.concatenate(side)] for side in zip(*waiting))
        apart = a != b
        return _connected(len(label), a[apart], b[apart])[label] if apart.any() else label

    for p in lower:
        near = np.linalg.norm(centres[upper] - centres[p], axis=1) <= limit + radii[upper] + radii[p]
        for q in upper[(near & (upper >= p)) | (upper == p)]:
            for a, b in _traverse(trees[p], trees[q], cosine):
                a, b = a + first[p], b + first[q]
                if p == q:
                    a, b = a[a != b], b[a != b]
                links += np.bincount(a, counts[b], len(links)).astype(np.int64)
                if p != q:
                    links += np.bincount(b, counts[a], len(links)).astype(np.int64)
                waiting.append((a, b))
                n += len(a)
                if n >= PAIRS:
                    label, waiting, n = joined(), [], 0
    if n:
        label = joined()
    hit = np.flatnonzero(links > 0)
    return pa.RecordBatch.from_arrays([pa.array(reps[hit]), pa.array(links[hit]), pa.array(reps[label[hit]])], ["rep", "links", "other"])


def _links(treed: DataFrame, axes: dict[int, np.ndarray], values: int, cosine: float) -> DataFrame:
    """``rep, links, other`` of every cell, round by round: a round's copies of the blocks are given up with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                cells.setdefault(row["cell"], []).append(row)
        while cells:
            yield _cell(cells.pop(next(iter(cells))), axes, cosine)
        give_back()

    out = None
    for pairs in _rounds(_strip_pairs(treed, cosine), max(2 * values, ROUND_VALUES)):
        sent = [(strip, cell) for cell, pair in enumerate(pairs) for strip in sorted(set(pair))]
        # an Arrow table's size is known to the planner, so the blocks are not shuffled for the join as well
        sent = pa.table([pa.array(column, pa.int32()) for column in zip(*sent)], names=["strip", "cell"])
        copies = treed.join(treed.sparkSession.createDataFrame(sent), "strip").repartitionById(len(pairs), "cell")
        found = stored(copies.mapInArrow(run, "rep long, links long, other long"), "links", arrow_rows=8)
        out = found if out is None else out.unionByName(found)
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``."""
    units = stored(unit_vectors(vectors), "units")
    reps = units.where("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim"), F.first("vector").alias("vector"))
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    slim = stored(units.select("vec_id", "digest"), "digests")  # vectors lie on disk for the next step only
    forget(units)
    grown, axes, values = blocks(reps.select("digest", "rep", "n", "dim", "vector"), cosine)
    if grown is None:
        return slim.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    treed = stored(grown, "trees")
    named = stored(reps.select("digest", "rep", "least", "n"), "names")
    forget(reps)
    found = _links(treed, axes, values, cosine)
    forget(treed)
    labels = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "rep")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = named.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").join(degree, "rep", "left").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = slim.join(named, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
