"""Sharding by a k-d tree over document metadata.

Equal texts are one point with their bytes as weight.  From the whole corpus
down, every node is split at the weighted median of its widest metadata
dimension until there are as many leaves as shards, so leaves have near equal
bytes.  Medians are exact up to one key: the keys of a dimension (value, then
a hash of the text) are narrowed by histograms of 4096 bins, which Spark sums
and the driver reads (at most 4096 bins a node).

Two kinds of points do not go through the tree.  A point over half a shard
cannot be cut off by medians; there are at most two of those per shard, placed
first, heaviest first on the lightest shard (one without room is parted by
rows, so a hot group neither unbalances the shards nor sits in one task), and
the tree splits the rest in proportion to the room that is left.  And as a cut
misses its median by up to half a point, the smallest points (at most 2048 of
them, and at most 2 % of the bytes) are put in last, where most room is left.
All other points, over 90 % of the bytes unless single texts outweigh half a
shard, have the shard of their leaf.  A shard differs from the mean by half
the largest point of a cut at most, less what the small points even out.

Only DataFrame functions are used.  Texts are read once for their size and
hashes; what is shuffled is a few numbers a document.

Defined results: a null text has no bytes (size 1) and checksum 0; null
metadata is a value of its own; repeated and null ids are separate rows; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerlake.llm.components import written

#: Points heavier than one in so many of a shard are placed before the tree.
GRAIN = 2
#: Number and share of the bytes of the smallest points, placed after the tree.
LAST, LAST_SHARE = 2048, 0.02
#: Part of a shard that rows of a parted group may fill.
_PARTED = 0.92
_BINS = 4096  # 12 bits of the key per round
_ROUNDS = 3
#: Rows that one task numbers.
_NUMBERED = 20_000


def _unit_hash(c: str) -> Column:
    """A value of [0, 1) for a category; null is a category too."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(c), F.lit("\x00"))), F.lit(1 << 20)) / float(1 << 20)


def _key(x: Column) -> Column:
    """36 bits: 12 of the dimension, 24 of the text's hash."""
    value = F.floor(F.least(x, F.lit(0.99999)) * (1 << 12)).cast("long")
    return F.shiftleft(value, 24) + F.pmod("g", F.lit(1 << 24))


def _by_node(values: dict[int, object]) -> Column:
    """The node's entry of a table with one entry per node (at most as many as shards)."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("node")]


def _medians(points: DataFrame, total: dict[int, int], want: dict[int, float]) -> dict[int, int]:
    """Per node: the key below which the weight is as near as possible to
    ``want`` times the node's weight."""
    low = dict.fromkeys(total, 0)
    below = dict.fromkeys(total, 0)
    for r in range(_ROUNDS):
        shift = 12 * (_ROUNDS - 1 - r)
        inside = points.where(F.shiftright(F.col("key") - _by_node(low), shift + 12) == 0) if r else points
        bins = inside.groupBy("node", F.pmod(F.shiftright("key", shift), F.lit(_BINS)).alias("b")).agg(F.sum("w").alias("w"))
        found: dict[int, list] = {n: [] for n in total}
        for row in bins.collect():  # at most 4096 bins a node
            found[row.node].append((row.b, row.w))
        for n in total:
            for b, w in sorted(found[n]):
                if below[n] + w >= want[n] * total[n]:
                    break
                below[n] += w
            else:
                b, w = _BINS - 1, 0
            low[n] += b << shift
            if r == _ROUNDS - 1 and below[n] + w - want[n] * total[n] < want[n] * total[n] - below[n]:
                low[n] += 1  # the key at the cut is nearer to the left side
    return low


def _rooms(heavy: list, target: float, shards: int) -> list[tuple[int, int, float, float]]:
    """Places (g, shard, from, to) of heavy groups, heaviest first on the
    lightest shard; a group without room is parted by shares of its rows."""
    load = [0.0] * shards
    out = []
    for g, w in sorted(heavy, key=lambda x: (-x[1], x[0])):
        at = 0.0
        while at < 1:
            i = min(range(shards), key=lambda k: load[k])
            share = 1 - at
            if w * share > target - load[i]:  # a hash parts the rows: some room stays for its unevenness
                share = min(share, max(_PARTED * target - load[i], target / 256) / w)
            to = 1.0 if share >= 1 - at - 1e-9 else at + share
            out.append((g, i, at, to))
            load[i] += w * (to - at)
            at = to
    return out


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every
    document, and how its shard was found: ``placed`` is tree, room (a point
    over half a shard) or last (one of the smallest points)."""
    spark = docs.sparkSession
    rows = written(spark, docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"), F.xxhash64("text").alias("g"),
        _unit_hash("lang").alias("lang"), _unit_hash("source").alias("source")), "shard-rows")
    whole = rows.agg(F.sum("size").alias("w"), F.count("*").alias("n")).first()
    if not whole.n:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.lit("tree").alias("placed"))
    target = whole.w / shards
    heavy = rows.groupBy("g").agg(F.sum("size").alias("w")).where(F.col("w") > target / GRAIN)
    heavy = [(r.g, r.w) for r in heavy.collect()]  # at most shards * GRAIN rows
    rooms = F.broadcast(spark.createDataFrame(_rooms(heavy, target, shards), "g long, shard int, lo double, hi double"))
    share = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / float(1 << 30)
    columns = ["doc_id", "size", "text_crc32", "row", "shard", "placed"]
    first = rows.join(rooms, "g").where((share >= F.col("lo")) & (share < F.col("hi"))).withColumn("placed", F.lit("room")).select(columns)
    rest = rows.join(F.broadcast(rooms.select("g").distinct()), "g", "left_anti")
    loads = {r.shard: r.w for r in first.groupBy("shard").agg(F.sum("size").alias("w")).collect()}  # a row per shard
    room = [max(target - loads.get(i, 0), 0.0) for i in range(shards)]

    points = rest.groupBy("g").agg(F.sum("size").alias("w"), F.max("size").alias("size"),
                                   F.min("lang").alias("lang"), F.min("source").alias("source"))
    top = F.log1p(F.lit(float(1 << 31)))
    points = points.select("g", "w", F.lit(0).alias("node"),
                           F.array(F.log1p(F.col("size").cast("double")) / top, "lang", "source").alias("x"))
    points = written(spark, points, "shard-points")
    small, held = [], 0
    for r in points.orderBy("w", "g").limit(LAST).select("g", "w").collect():
        held += r.w
        if held > LAST_SHARE * whole.w:
            break
        small.append((r.g, r.w))
    every = points.select("g", "w")
    points = points.join(F.broadcast(spark.createDataFrame(small, "g long, w long").select("g")), "g", "left_anti")
    spread = points.agg(*[F.min(F.col("x")[j]).alias(f"a{j}") for j in range(3)], *[F.max(F.col("x")[j]).alias(f"b{j}") for j in range(3)]).first()
    if spread.a0 is not None:
        scaled = [(F.col("x")[j] - spread[f"a{j}"]) / ((spread[f"b{j}"] - spread[f"a{j}"]) or 1.0) for j in range(3)]
        points = points.withColumn("x", F.array(*scaled))

    leaves, names = {0: range(shards)}, 1  # the shards that a node is to fill
    while any(len(k) > 1 for k in leaves.values()):
        stats = points.groupBy("node").agg(F.sum("w").alias("w"), *[
            (F.max(F.col("x")[j]) - F.min(F.col("x")[j])).alias(f"d{j}") for j in range(3)]).collect()  # a row per node
        stats = {r.node: r for r in stats if len(leaves[r.node]) > 1}
        if not stats:  # what is left to split holds no rows
            break
        widest = {n: max(range(3), key=lambda j, r=r: r[f"d{j}"]) for n, r in stats.items()}
        left = {n: leaves[n][:len(leaves[n]) // 2] for n in stats}
        want = {n: sum(room[i] for i in left[n]) / (sum(room[i] for i in leaves[n]) or 1.0) for n in stats}
        key = _key(F.element_at("x", F.coalesce(_by_node(widest), F.lit(0)) + 1))
        keyed = written(spark, points.withColumn("key", key), "shard-points")
        open_nodes = keyed.where(F.col("node").isin(list(stats)))
        cut = _medians(open_nodes, {n: r.w for n, r in stats.items()}, want)
        lower, upper = {}, {}
        for n in stats:
            lower[n], upper[n] = names, names + 1
            leaves[names], leaves[names + 1] = left[n], leaves.pop(n)[len(left[n]):]
            names += 2
        points = keyed.withColumn("node", F.when(F.col("node").isin(list(stats)), F.when(
            F.col("key") < _by_node(cut), _by_node(lower)).otherwise(_by_node(upper))).otherwise(F.col("node"))).drop("key")
    shard_of = written(spark, points.select("g", "w", _by_node({n: k[0] for n, k in leaves.items()}).cast("int").alias("shard")),
                       "shard-leaves")
    for r in shard_of.groupBy("shard").agg(F.sum("w").alias("w")).collect():  # a row per shard
        room[r.shard] -= r.w
    last = []
    for g, w in reversed(small):
        i = max(range(shards), key=lambda j: room[j])
        room[i] -= w
        last.append((g, i))
    last = F.broadcast(spark.createDataFrame(last, "g long, shard int"))
    shard_of = shard_of.select("g", "shard", F.lit("tree").alias("placed")).union(
        every.join(last, "g").select("g", "shard", F.lit("last").alias("placed")))
    placed = rest.join(shard_of, "g").select(columns).union(first)

    # slots: rows of a shard are numbered in buckets, after the rows of earlier buckets
    buckets = max(64, -(-whole.n // shards // _NUMBERED))
    placed = written(spark, placed.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))), "shard-placed")
    count = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = count.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "bucket").orderBy("row")
    return (placed.withColumn("nth", F.row_number().over(within) - 1).join(before, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "placed"))
