"""Operator 3 places whole tables by the edited map too."""

from collections import Counter

from tidemark.llm import shards


def test_rows_move_only_into_the_new_shard(spark):
    rows = shards.op3_virtual_slots(spark, "/root/testdata/sf0.01").collect()
    moved = [r for r in rows if r["rebalanced_shard"] != r["shard"]]
    assert moved and {r["rebalanced_shard"] for r in moved} == {shards.SHARDS}
    assert all(r["shard"] < shards.SHARDS for r in rows)
    before, after = Counter(), Counter()
    for r in rows:
        before[r["shard"]] += r["size"]
        after[r["rebalanced_shard"]] += r["size"]
    assert len(after) == shards.SHARDS + 1 and all(after[k] <= before[k] for k in before)
    share, largest = sum(after.values()) / len(after), max(r["size"] for r in rows)
    assert share - largest * 8 < after[shards.SHARDS] <= share
