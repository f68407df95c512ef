"""Balanced label propagation: shards with equal numbers of rows and few equal texts apart, in native expressions.

Documents are linked if their texts are equal. Members of a group with the same shard are interchangeable, so the state
is one line for each group with its members by shard; hot groups are a line like any other. In each round a group's
members ask to move to the shard that holds most of them; ties are broken anew in each round. Requests are counted by
(from, to), a table whose size is fixed by the number of shards. Opposite requests, and such as close a longer circle of
shards, are granted against each other, so full shards take part; what is left goes into free room. Each pair of shards
grants its requests in the order of falling gain up to its number, the last one in part. Documents without a link cost nothing wherever they are and fill every shard up to its quota, so the law
``rows`` (counts at most one apart) holds after every round.

NULL texts have no link, one byte of size and no checksum; empty texts are equal to each other; repeated rows are rows;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import laid_out, running, stored

SHARDS, ROUNDS = 8, 5
LAW = "rows"


def _quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def _circle(left: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """A shortest circle of open requests between shards, if there is one."""
    best: list[tuple[int, int]] = []
    for start in sorted({a for a, _ in left}):
        paths, seen = [[(a, b)] for a, b in sorted(left) if a == start and left[a, b]], set()
        for path in paths:  # breadth first; the list grows
            end = path[-1][1]
            if end == start:
                if not best or len(path) < len(best):
                    best = path
                break
            if end not in seen:
                seen.add(end)
                paths += [[*path, (a, b)] for a, b in sorted(left) if a == end and left[a, b]]
    return best


def _grants(wanted: dict[tuple[int, int], int], linked: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """Members that may move between each two shards, all at once: circles first, then free room until none is left."""
    left, linked = dict(wanted), list(linked)
    granted = dict.fromkeys(wanted, 0)
    while circle := _circle(left):
        n = min(left[e] for e in circle)
        for e in circle:
            left[e] -= n
            granted[e] += n
    moved = True
    while moved:
        moved = False
        for a, b in sorted(left, key=lambda e: (-left[e], e)):
            n = min(left[a, b], quota[b] - linked[b])
            if n > 0:
                left[a, b] -= n
                granted[a, b] += n
                linked[a], linked[b], moved = linked[a] - n, linked[b] + n, True
    return {e: n for e, n in granted.items() if n}


def _round(state: DataFrame, shards: int, quota: list[int], turn_of: int) -> tuple[DataFrame, int]:
    """The state after a round, and how many requests there were."""
    linked = list(state.agg(*[F.coalesce(F.sum(F.col("c")[k]), F.lit(0)) for k in range(shards)]).first())
    turn = F.pmod(F.xxhash64("g", F.lit(turn_of)), F.lit(shards))
    order = [F.struct(F.col("c")[k].alias("n"), F.pmod(turn + k, F.lit(shards)).alias("t"), F.lit(k).alias("k")) for k in range(shards)]
    best = state.withColumn("to", F.array_max(F.array(*order))["k"])
    asks = best.select("g", "to", F.posexplode("c").alias("from", "n"), F.element_at("c", F.col("to") + 1).alias("there"))
    asks = asks.where((F.col("n") > 0) & (F.col("from") != F.col("to"))).withColumn("gain", F.col("n") - F.col("there"))
    asks = laid_out(asks.select("g", "from", "to", "n", "gain"), ["from", "to", "gain", "g"], "asks")
    # at most shards * shards lines
    wanted = {(r["from"], r["to"]): r["n"] for r in asks.groupBy("from", "to").agg(F.sum("n").alias("n")).collect()}
    grants = _grants(wanted, linked, quota)
    if not grants:
        return state, len(wanted)
    limit = F.lit(0)
    for (a, b), n in grants.items():
        limit = F.when((F.col("from") == a) & (F.col("to") == b), F.lit(n)).otherwise(limit)
    moved = running(asks, "n", "before", by=["from", "to"]).withColumn("m", F.least(F.col("n"), limit - F.col("before"))).where("m > 0")
    change = moved.groupBy("g").agg(*[
        (F.sum(F.when(F.col("to") == k, F.col("m")).otherwise(0)) - F.sum(F.when(F.col("from") == k, F.col("m")).otherwise(0))).alias(f"d{k}")
        for k in range(shards)])
    new = F.array(*[F.col("c")[k] + F.coalesce(F.col(f"d{k}"), F.lit(0)) for k in range(shards)])
    return stored(state.join(change, "g", "left").select("g", "first", new.alias("c")), "labels"), len(wanted)


def _pick(cumulative: list[Column], value: Column) -> Column:
    out = F
    for k, upper in enumerate(cumulative[:-1]):
        out = out.when(value < upper, F.lit(k))
    return out.otherwise(F.lit(len(cumulative) - 1))


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    slim = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.sha2("text", 256).alias("g"))
    placed = laid_out(slim.withColumn("h", F.xxhash64("doc_id")), ["g", "h", "doc_id"], "texts").drop("h")
    placed = stored(running(placed, None, "place"), "places")
    groups = placed.where("g is not null").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1")
    groups = running(laid_out(groups, ["g"], "groups"), "n", "start")
    dealt = [F.greatest(F.floor((F.col("n") - F.pmod(k - F.col("start"), F.lit(shards)) + shards - 1) / shards), F.lit(0)).cast("long") for k in range(shards)]
    state = stored(groups.select("g", "first", F.array(*dealt).alias("c")), "labels")
    quota = _quotas(placed.count(), shards)
    for i in range(rounds):
        state, asked = _round(state, shards, quota, i)
        if not asked:
            break
    linked = list(state.agg(*[F.coalesce(F.sum(F.col("c")[k]), F.lit(0)) for k in range(shards)]).first())
    own = placed.join(state.select("g", "first", "c"), "g", "left")
    rank, ends, total = F.col("place") - F.col("first"), [], F.lit(0)
    for k in range(shards):
        total = total + F.col("c")[k]
        ends.append(total)
    own = own.withColumn("shard", F.when(F.col("first").isNotNull(), _pick(ends, rank))).drop("first", "c", "g", "place")
    own = stored(own.withColumn("free", F.col("shard").isNull().cast("int")), "linked")
    free = running(own, "free", "before")
    fill, total = [], 0
    for k in range(shards):
        total += quota[k] - linked[k]
        fill.append(F.lit(total))
    full = stored(free.withColumn("shard", F.coalesce("shard", _pick(fill, F.col("before"))).cast("int")), "shards")
    return running(full, None, "slot", by=["shard"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
