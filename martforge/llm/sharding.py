"""Shards of nearly equal bytes: a minimax contiguous partition.

Equal texts form an atomic group, which never spans two shards. Groups are
gathered into at most ``UNITS`` atomic units by a hash of the text, the units are
put in one order, and the smallest capacity for which a greedy left-to-right cut
needs no more shards than there are is found by binary search. At that capacity the
units are cut, each shard as near to an even share of what is left as the capacity of
the later ones allows (plain greedy cuts would leave the last shard short).

A single group that alone exceeds an even share cannot share a shard with
anything under a near-equal law: it gets a shard of its own and the search runs
over the remaining groups and shards (the largest shard is then that group, which
no partition into whole groups can undercut).

What reaches the driver is bounded: one number per unit, and the oversized groups
(fewer than the shards). Slots count on over cells of each shard, to which rows are dealt
by a number given to each when written, so neither a shard, a group of copies nor the rows of
one id (or of none) are ever held in one task.

Defined cases: null text has 16 bytes of size and crc32 0 like empty text, and is in
one group with it; repeated rows each get a slot; null ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import rank_cells, staged, utf8_crc32, with_salted_rank

SHARDS = 40
OVERHEAD = 16
UNITS = 1 << 16


def feasible(ends: list[int], capacity: int, most: int) -> bool:
    """Whether greedy cuts over the running totals ``ends`` need at most ``most`` shards."""
    start, used, taken = 0, 0, 0
    while start < len(ends):
        nxt = bisect_right(ends, used + capacity)
        if nxt == start or taken == most:
            return False
        start, used, taken = nxt, ends[nxt - 1], taken + 1
    return True


def even_cuts(ends: list[int], capacity: int, shards: int) -> list[int]:
    """The end of each shard, none above ``capacity`` (feasible), as even as that allows."""
    n, cuts, start, used = len(ends), [], 0, 0
    need = [0] * (n + 1)  # shards that the units from here on need
    for i in range(n - 1, -1, -1):
        need[i] = 1 + need[bisect_right(ends, (ends[i - 1] if i else 0) + capacity)]
    while start < n:
        left = shards - len(cuts)
        even = used + (ends[-1] - used) / left
        end = max(start + 1, bisect_right(ends, even))
        if end < n and ends[end] - even < even - ends[end - 1]:
            end += 1
        end = min(end, bisect_right(ends, used + capacity))
        while need[end] > left - 1:
            end += 1
        cuts.append(end)
        start, used = end, ends[end - 1]
    return cuts


def minimax_cuts(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity for contiguous shards, and the end of each shard."""
    if not sizes:
        return 0, []
    ends = list(accumulate(sizes))
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if feasible(ends, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low, even_cuts(ends, low, shards)


def packing_order(sizes: dict[int, int], shards: int) -> list[int]:
    """An order of the units that cuts well: large units are spread over the
    shards (largest first, to the least filled), small ones level them."""
    even = sum(sizes.values()) / shards
    large = sorted((u for u in sizes if sizes[u] * 16 > even), key=lambda u: (-sizes[u], u))
    small = [u for u in sorted(sizes) if sizes[u] * 16 <= even]
    bins: list[list[int]] = [[] for _ in range(shards)]
    load = [0] * shards
    for u in large:
        b = min(range(shards), key=load.__getitem__)
        bins[b].append(u)
        load[b] += sizes[u]
    order, k, taken, wanted = [], 0, 0, 0.0
    level = _water_level(load, sum(sizes[u] for u in small))
    for b in range(shards):
        order += bins[b]
        wanted += max(0.0, level - load[b])
        while k < len(small) and taken + sizes[small[k]] / 2 <= wanted:
            order.append(small[k])
            taken += sizes[small[k]]
            k += 1
    return order + small[k:]


def _water_level(load: list[int], water: int) -> float:
    """The height that ``water`` reaches when poured over columns of height ``load``."""
    below = 0
    for n, h in enumerate(sorted(load) + [None], 1):
        if h is None or (n > 1 and h * (n - 1) - below >= water):
            return (below + water) / (n - 1)
        below += h
    raise AssertionError("the last turn returns")


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.col("text")
    group = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = staged(spark, docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        utf8_crc32(text).alias("text_crc32"),
        group.alias("_group"), F.monotonically_increasing_id().alias("_row")), "shard-rows").withColumn("_unit", F.pmod("_group", F.lit(UNITS)).cast("int"))

    found = rows.groupBy("_unit").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    sizes, n_of = {r["_unit"]: r["b"] for r in found}, {r["_unit"]: r["n"] for r in found}
    alone = _oversized(rows, sizes, shards)
    most = max((n for _, _, n in alone.values()), default=0)  # rows of the largest shard
    for u, b, n in alone.values():
        sizes[u] -= b
        n_of[u] -= n
    order = packing_order({u: b for u, b in sizes.items() if b}, shards - len(alone)) if sizes else []
    _, ends = minimax_cuts([sizes[u] for u in order], max(1, shards - len(alone)))
    shard_of, start = {}, 0
    for k, end in enumerate(ends):
        shard_of.update(dict.fromkeys(order[start:end], len(alone) + k))
        most = max(most, sum(n_of[u] for u in order[start:end]))
        start = end

    schema = "_unit int, shard int"
    unit_shard = spark.createDataFrame(list(shard_of.items()), schema)  # at most UNITS rows
    placed = rows.join(F.broadcast(unit_shard), "_unit", "left")
    shard = F.col("shard")
    for k, g in enumerate(alone):
        shard = F.when(F.col("_group") == F.lit(g), F.lit(k)).otherwise(shard)
    placed = placed.withColumn("shard", shard.cast("int"))
    ranked = with_salted_rank(placed, ["shard"], F.xxhash64("_row"), [F.col("_row")], rank_cells(most))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("_rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _oversized(rows: DataFrame, sizes: dict[int, int], shards: int) -> dict[int, tuple[int, int, int]]:
    """Groups above an even share of what the other groups leave, largest first:
    group -> (unit, bytes, rows). Fewer than ``shards``."""
    total = sum(sizes.values())
    units = [u for u, b in sizes.items() if b * shards > total / 2]  # at most 2 * shards units
    if not units:
        return {}
    groups = (rows.filter(F.col("_unit").isin(units)).groupBy("_unit", "_group").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("b") * shards * 2 > total).collect())
    alone = {}
    for r in sorted(groups, key=lambda r: (-r["b"], r["_group"])):
        left = shards - len(alone)
        if left > 1 and r["b"] * left > total and total > r["b"]:
            alone[r["_group"]] = (r["_unit"], r["b"], r["n"])
            total -= r["b"]
    return alone
