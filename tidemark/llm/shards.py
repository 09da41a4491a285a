"""Operator 3: sharding by fixed virtual slots.

Records hash into thousands of slots; bytes are summed per slot; a stored, versioned map says which shard
holds each slot. Rebalancing edits the map and never a record's slot: a new version differs only in the
slots that move. The law that holds is ``bytes``: shard sizes near equal. The query stores the map and, as version 2,
its edit for one more shard; ``rebalanced_shard`` is each row's shard under that.

A record's slot comes from its ``doc_id`` and the checksum of its text, so rows that share a ``doc_id`` spread
too. NULL texts have size 1 and the checksum of no bytes. Repeated rows are all placed. An empty table
gives no rows.
"""

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import ready, table
from tidemark.session import scratch_path, written

SLOTS = 4096
SHARDS = 16

MAP = "version int, vslot int, shard int, bytes long, n long, first long"


def vslot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(key, F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, vslot)`` of every document."""
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select("doc_id", (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))
    return slim.withColumn("vslot", vslot_of(F.xxhash64("doc_id", "text_crc32"), slots))


def slot_loads(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """``slot -> (bytes, rows)``: one entry per slot, however large the table."""
    loads = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return {r["vslot"]: (r["bytes"], r["n"]) for r in loads.collect()}


def assign(loads: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """Slots to shards: the heaviest slot first, always to the lightest shard; then single moves and swaps that even out."""
    total = [0] * shards
    placed: dict[int, int] = {}
    for slot in sorted(loads, key=lambda s: (-loads[s][0], s)):
        shard = min(range(shards), key=lambda k: (total[k], k))
        placed[slot] = shard
        total[shard] += loads[slot][0]
    for _ in range(4 * shards):
        high, low = max(range(shards), key=lambda k: total[k]), min(range(shards), key=lambda k: total[k])
        half = (total[high] - total[low]) / 2
        ours = [(loads[s][0], s) for s, k in placed.items() if k == high]
        theirs = [(0, None), *((loads[s][0], s) for s, k in placed.items() if k == low)]
        if not ours:
            break
        best = min(((abs(a - b - half), a, s, b, t) for a, s in ours for b, t in theirs if a > b), key=lambda x: x[0], default=None)
        if best is None or best[0] >= half:
            break
        _, a, s, b, t = best
        placed[s] = low
        if t is not None:
            placed[t] = high
        total[high] -= a - b
        total[low] += a - b
    return placed


def grow(placed: dict[int, int], loads: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """The map for one more shard: slots move only into it, from the heaviest shards, until it has its share."""
    placed, new = dict(placed), shards
    total = [0] * (shards + 1)
    for slot, shard in placed.items():
        total[shard] += loads[slot][0]
    share = sum(total) / (shards + 1)
    held = [sorted((loads[s][0], s) for s, k in placed.items() if k == shard) for shard in range(shards)]
    while True:
        shard = max(range(shards), key=lambda k: total[k])
        # The largest slot that does not overfill the new shard.
        room = min(share, total[shard]) - total[new]
        at = bisect_right(held[shard], (room, float("inf"))) - 1
        if at < 0:
            return placed
        size, slot = held[shard].pop(at)
        total[shard] -= size
        total[new] += size
        placed[slot] = new


def store(spark: SparkSession, path: str, version: int, placed: dict[int, int], loads: dict[int, tuple[int, int]]) -> DataFrame:
    """Add a version of the map: per slot its shard, its load, and the rows of its shard's earlier slots."""
    rows, filled = [], {}
    for slot in sorted(placed):
        shard, (size, n) = placed[slot], loads[slot]
        rows.append((version, slot, shard, size, n, filled.get(shard, 0)))
        filled[shard] = filled.get(shard, 0) + n
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)
    return version_of(spark, path, version)


def version_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(path).where(F.col("version") == version)


def sharded(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's place in its shard. The map has at most one short row per slot."""
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("at", F.row_number().over(within) - 1)
    joined = numbered.join(F.broadcast(slot_map.select("vslot", "shard", "first")), "vslot")
    return joined.select("doc_id", "size", "text_crc32", "vslot", "shard", (F.col("first") + F.col("at")).alias("slot"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ready(spark)
    rows = written(records(docs), "shard-records")
    loads = slot_loads(rows)
    path, placed = scratch_path(spark, "slot-map"), assign(loads, SHARDS)
    slot_map = store(spark, path, 1, placed, loads)
    grown = store(spark, path, 2, grow(placed, loads, SHARDS), loads).select("vslot", F.col("shard").alias("rebalanced_shard"))
    return sharded(rows, slot_map).join(F.broadcast(grown), "vslot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "rebalanced_shard",
    )
