"""Near duplicates: MinHash signatures, multi-index Hamming join, links confirmed on full shingle sets.

A text's set holds its distinct word 5-shingles as 64-bit hashes. Its signature keeps ``b`` = 8 bits of each of
``components`` minima; the distance of two signatures is the number of components that differ. By pigeonhole, two
signatures within ``chunks * (errors + 1) - 1`` differ in at most ``errors`` components of some chunk, so each signature
is filed under every chunk with every choice of ``errors`` components left out: all pairs under the threshold meet.
``plan`` derives these numbers from the least similarity, so that a pair of just that similarity lies above the distance
with probability ``MISS`` at most, a more similar pair hardly ever. For 0.85 these are 9 chunks of 6 components with one
error, a distance of 17 of 54 (probability 0.00058); for 0.80 they are 19 chunks, 37 of 114 (0.00054).

Copies of one set are one representative throughout. Buckets and groups are dealt out in bounded blocks, each pair of
blocks is one unit of work, and a unit returns only links that connect, never all pairs. Links are confirmed within the
groups that candidate pairs connect, so every candidate pair is compared on its full sets.

Empty or NULL texts have an empty set and stay alone; fewer words than a shingle are one shingle. Rows are never merged:
rows that repeat an id each get the component of their own text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from stridelake.llm.common import steps, stored
from stridelake.llm.graph import components

#: Probability at most that a pair of just the least similarity lies above the signature distance.
MISS = 0.0006
#: Components that a key holds, and most chunks before one more error is allowed.
KEPT, MOST_CHUNKS = 5, 24


class Plan(NamedTuple):
    """Chunks of a signature, components of a chunk, components left out of each."""

    chunks: int
    width: int
    errors: int

    @property
    def components(self) -> int:
        return self.chunks * self.width

    @property
    def distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1

    def miss(self, percent: int) -> float:
        """Probability that signatures of sets of that similarity lie above the distance."""
        differ = (1 - percent / 100) * 255 / 256
        return sum(comb(self.components, k) * differ**k * (1 - differ) ** (self.components - k)
                   for k in range(self.distance + 1, self.components + 1))


def plan(percent: int) -> Plan:
    """The plan with the fewest errors, then chunks, that misses a pair of ``percent`` with probability ``MISS`` at most."""
    for errors in range(1, 9):
        for chunks in range(4, MOST_CHUNKS + 1):
            found = Plan(chunks, KEPT + errors, errors)
            if found.miss(percent) <= MISS:
                return found
    raise ValueError(f"similarity of {percent} percent is too low for signatures")


PLAN = plan(85)
COMPONENTS, DISTANCE = PLAN.components, PLAN.distance
#: Representatives in a block of a bucket, shingles in a block of a group.
BUCKET_BLOCK, GROUP_BLOCK = 1024, 400_000
#: Words remembered by a task before it starts afresh.
CACHE_WORDS = 1_000_000


def _permutations(components: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    xor = rng.integers(0, 2**63, components, dtype=np.uint64)
    return xor, rng.integers(0, 2**63, components, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, hashes: dict, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of ``text``; A-Z in lower case, words split at ASCII white space."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    n = len(words) - span + 1
    out = np.full(n, span, np.uint64)
    for i in range(span):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique(_mix(out))


def signature(shingled: np.ndarray, xor: np.ndarray, mul: np.ndarray) -> bytes:
    minima = np.full(len(xor), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingled), 4096):
        block = shingled[at : at + 4096]
        for k in range(len(xor)):
            least = ((block ^ xor[k]) * mul[k]).min()
            if least < minima[k]:
                minima[k] = least
    return (_mix(minima) >> np.uint64(56)).astype(np.uint8).tobytes()  # the minima themselves all begin with zeros


def sketches(docs: DataFrame, size: int = 5, plan: Plan = PLAN) -> DataFrame:
    """Per row: id, set size, 128-bit digest of the set and signature (NULL for an empty set), hash of the text."""

    xor, mul = _permutations(plan.components)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            rows = []
            for doc_id, text, text_hash in zip(batch["doc_id"], batch["text"], batch["text_hash"]):
                s = shingles(text, hashes, size)
                digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                rows.append((doc_id, len(s), digest, signature(s, xor, mul) if len(s) else None, text_hash))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "signature", "text_hash"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("text_hash"))
    return slim.mapInPandas(run, "doc_id long, n_shingles long, digest binary, signature binary, text_hash long")


def bucket_keys(reps: DataFrame, plan: Plan = PLAN) -> DataFrame:
    """``(key, rep)``: each chunk of the signature, once for every choice of components left out. Keys are exact."""
    chunks, width = plan.chunks, plan.width
    choices = list(combinations(range(width), KEPT))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(batch["signature"]), np.uint8).reshape(len(batch), chunks, width).astype(np.int64)
            for c in range(chunks):
                for at, places in enumerate(choices):
                    key = np.full(len(batch), c * len(choices) + at, np.int64)
                    for j in places:
                        key = (key << 8) | sig[:, c, j]
                    yield pd.DataFrame({"key": key, "rep": batch["rep"].to_numpy()})

    return reps.select("rep", "signature").mapInPandas(run, "key long, rep long")


def _in_cells(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Deal the rows of each key over its blocks and copy each row to every pair of blocks it takes part in."""
    own = F.pmod(F.xxhash64("rep", F.lit(7)), F.col(blocks))
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1),
        lambda x: F.struct(F.least(x, own).alias("i"), F.greatest(x, own).alias("j")),
    )
    return rows.withColumn("_own", own).select("*", F.explode(cells).alias("_cell")).select(
        *[c for c in rows.columns if c not in (key, blocks)], key, F.col("_cell.i").alias("i"), F.col("_cell.j").alias("j"))


def _spread(n: int, links_of) -> list[tuple[int, int]]:
    """Spanning links of the graph on 0..n-1; ``links_of(x, rest)`` gives the members of ``rest`` linked with x."""
    rest, found = np.arange(n), []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            hit = links_of(x, rest)
            if hit.any():
                new = rest[hit]
                found += [(int(x), int(y)) for y in new]
                front += list(new)
                rest = rest[~hit]
    return found


def _by_cell(rows: DataFrame, key: str, links_of_cells) -> DataFrame:
    """``(a, b)`` of ``links_of_cells(frame, starts)`` for runs of whole cells; a cell is bounded, so a task holds few rows.

    Cells are streamed in sorted order, many small ones at a time.
    """
    names = [key, "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            starts = _starts(batch)
            if len(starts) > 1:
                yield links(batch.iloc[: starts[-1]], starts[:-1])
                batch = batch.iloc[starts[-1] :].reset_index(drop=True)
            rest = batch
        if rest is not None and len(rest):
            yield links(rest, _starts(rest))

    def _starts(batch: pd.DataFrame) -> np.ndarray:
        new = np.ones(len(batch), bool)
        new[1:] = False
        for name in names:
            v = batch[name].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    def links(batch: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        pairs = links_of_cells(batch, starts)
        rep = batch["rep"].to_numpy()
        pairs = np.sort(rep[np.array(pairs, np.int64).reshape(-1, 2)], axis=1)
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return rows.repartition(*names).sortWithinPartitions(*names).mapInPandas(run, "a long, b long")


def _close_signatures(batch: pd.DataFrame, starts: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Pairs of different groups within the signature distance; in a larger cell one for each row and group it meets."""
    sig = np.frombuffer(b"".join(batch["signature"]), np.uint8).reshape(len(batch), -1)
    group, minor = batch["rep"].to_numpy(), batch["minor"].to_numpy()
    sizes = np.diff(np.append(starts, len(batch)))
    out = [np.empty((0, 2), np.int64)]
    for size in range(2, 9):
        members = starts[sizes == size][:, None] + np.arange(size)
        x, y = np.triu_indices(size, 1)
        x, y = members[:, x].ravel(), members[:, y].ravel()
        apart = group[x] != group[y]
        x, y = x[apart], y[apart]
        near = (sig[x] != sig[y]).sum(1) <= distance
        out.append(np.column_stack((x[near], y[near])))
    for at, size in zip(starts[sizes > 8], sizes[sizes > 8]):
        own = slice(at, at + size)
        for x in np.flatnonzero(minor[own]) + at:
            hit = np.flatnonzero(((sig[own] != sig[x]).sum(1) <= distance) & (group[own] != group[x])) + at
            hit = hit[np.unique(group[hit], return_index=True)[1]]
            out.append(np.column_stack((np.full(len(hit), x), hit)))
    return np.concatenate(out)


def _similar_sets(percent: int):
    def one(cell: pd.DataFrame) -> list[tuple[int, int]]:
        sizes = np.array([len(s) // 8 for s in cell["shingles"]])
        flat, ids = np.unique(np.frombuffer(b"".join(cell["shingles"]), np.uint64), return_inverse=True)
        ends = np.cumsum(sizes)
        order = np.argsort(ids, kind="stable")
        holder = np.repeat(np.arange(len(cell)), sizes)[order]  # documents by shingle
        first = np.searchsorted(ids[order], np.arange(len(flat) + 1))

        def links(x: int, rest: np.ndarray) -> np.ndarray:
            own = ids[ends[x] - sizes[x] : ends[x]]
            lo, n = first[own], first[own + 1] - first[own]
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            both = np.bincount(holder[at], minlength=len(cell))[rest]
            return 100 * both >= percent * (sizes[x] + sizes[rest] - both)

        return _spread(len(cell), links)

    def run(batch: pd.DataFrame, starts: np.ndarray) -> np.ndarray:
        out = [np.empty((0, 2), np.int64)]
        for at, end in zip(starts, np.append(starts[1:], len(batch))):
            if end - at > 1:
                out.append(np.array(one(batch.iloc[at:end]), np.int64).reshape(-1, 2) + at)
        return np.concatenate(out)

    return run


@F.pandas_udf(IntegerType())
def _distance(x: pd.Series, y: pd.Series) -> pd.Series:
    sig = [np.frombuffer(b"".join(v), np.uint8).reshape(len(v), -1) for v in (x, y)]
    return pd.Series((sig[0] != sig[1]).sum(1).astype(np.int32))


def candidate_groups(reps: DataFrame, plan: Plan = PLAN) -> DataFrame:
    """``(node, component)``: groups of representatives such that all pairs within the signature distance share a group.

    The distance is a metric. In a bucket, everybody within twice the threshold of its smallest member joins that one;
    a pair under the threshold then shares a group unless one of the two is farther than that, and the other is farther
    than the threshold. Only buckets with such far members are searched, far members against all but the nearest.
    """
    distance = plan.distance
    keys = bucket_keys(reps, plan).repartition("key")  # one exchange for the aggregate and the join
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = stored(keys.join(hubs, "key").where("rep <> hub"), "members")
    pairs = members.select("rep", "hub").distinct().join(reps, "rep")
    pairs = pairs.join(reps.select(F.col("rep").alias("hub"), F.col("signature").alias("other")), "hub")
    pairs = stored(pairs.select("rep", "hub", _distance("signature", "other").alias("d")), "pairs")
    near = pairs.where(F.col("d") <= 2 * distance).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    first = components(near).withColumnRenamed("node", "rep").withColumnRenamed("component", "label")
    outer = members.join(pairs.where(F.col("d") > distance), ["rep", "hub"])
    outer = outer.select("key", "rep", (F.col("d") > 2 * distance).alias("minor"))
    count = [F.greatest(F.ceil(F.sum(x.cast("long")) / BUCKET_BLOCK), F.lit(1)).cast("long") for x in (F.col("minor"), ~F.col("minor"))]
    blocks = outer.groupBy("key").agg(count[0].alias("minors"), count[1].alias("mains"), F.max("minor").alias("far"),
                                      F.count(F.lit(1)).alias("n")).where("far and n > 1").drop("far", "n")
    dealt = outer.join(blocks, "key").join(first, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    salt = F.xxhash64("rep", F.lit(7))
    own = F.when(F.col("minor"), F.pmod(salt, "minors")).otherwise(F.col("minors") + F.pmod(salt, "mains"))
    last = F.when(F.col("minor"), F.col("minors") + F.col("mains")).otherwise(F.col("minors")) - 1
    cells = F.transform(F.sequence(F.lit(0).cast("long"), last),
                        lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    dealt = dealt.join(reps, "rep").withColumn("own", own).select(
        "key", F.col("label").alias("rep"), "minor", "signature", F.explode(cells).alias("c"))
    across = _by_cell(dealt.select("key", "c.i", "c.j", "rep", "minor", "signature"), "key", partial(_close_signatures, distance=distance))
    second = components(across).withColumnRenamed("node", "label")
    grouped = first.join(second, "label", "left").select(F.col("rep").alias("node"), F.coalesce("component", "label").alias("component"))
    alone = second.withColumnRenamed("label", "node").join(first.select(F.col("rep").alias("node")), "node", "left_anti")
    return grouped.unionByName(alone)


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``, the text's hash ``text_hash`` and ``component``.

    Rows whose sets share at least ``percent`` of their union are linked; ``component_id`` is the smallest id reachable.
    Ids may be missing or repeated, so only ``component`` (NULL for an empty set) tells components apart.
    """
    with steps() as keep:
        chosen = plan(percent)
        sketch = stored(sketches(docs, size, chosen), "sketches")
        # copies meet by digest: one representative for each set
        reps = sketch.where("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("least"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
        reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
        groups = candidate_groups(reps.select("rep", "signature"), chosen)
        links = _confirmed(docs, reps.join(groups.withColumnRenamed("node", "rep"), "rep"), percent, size)
        labels = components(links).withColumnRenamed("node", "rep")
        named = reps.select("digest", "rep", "least").join(labels, "rep", "left")
        named = named.withColumn("component", F.coalesce("component", "rep"))
        smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
        found = named.join(smallest, "component").select("digest", "component", "component_id")
        out = sketch.join(found, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
        kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
        return keep(stored(out.select("doc_id", "n_shingles", "component_id", kept, "text_hash", "component"), "near-duplicates"))


def _confirmed(docs: DataFrame, grouped: DataFrame, percent: int, size: int) -> DataFrame:
    """Spanning links ``(a, b)`` of representatives whose full sets are similar enough, within groups of candidates."""
    blocks = F.ceil(F.sum("n_shingles") / GROUP_BLOCK).cast("long")
    parts = grouped.groupBy("component").agg(blocks.alias("blocks"))
    wanted = grouped.join(parts, "component").select("least", "rep", "digest", "component", "blocks")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            out = batch[["component", "blocks", "rep"]].copy()
            out["shingles"] = [shingles(t, hashes, size).tobytes() for t in batch["text"]]
            same = [xxhash.xxh3_128_digest(s) == bytes(d) for s, d in zip(out["shingles"], batch["digest"])]
            yield out[same]  # an id may stand for other texts too

    texts = docs.select(F.col("doc_id").cast("long").alias("least"), F.col("text").cast("binary").alias("text"))
    texts = texts.where("text is not null").alias("t")
    met = texts.join(wanted.alias("w"), F.col("t.least").eqNullSafe(F.col("w.least")))
    full = met.select("component", "blocks", "rep", "digest", "text").mapInPandas(
        sets, "component long, blocks long, rep long, shingles binary")
    return _by_cell(_in_cells(full, "component", "blocks"), "component", _similar_sets(percent))
