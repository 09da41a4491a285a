"""Operator 11: the trie of conversation prefixes, built as a burst trie whose containers are spread over tasks.

A turn is known by a 128-bit digest of its role and text, its id; texts go no further than the task that reads
them. Equal conversations become one row with their number, smallest id and the digest of their ids. Rows begin in one
container, that of the root. As long as a container holds more than its limit of different suffixes it bursts: its head becomes a
node, and its rows go on to containers one turn deeper, by the id of their next turn. What is
left is sorted by container and suffix and swept once, with the nodes of one path open at a time. Nodes of burst heads are added up
from their containers, the deepest level first.

Heads that burst are few (each holds more rows than the limit, and the limit grows with the table so that a level has at most
100,000), so every level's heads go to each task; the conversations of a popular head do not meet in one task
before it has burst. Conversations are put in order one by one: the ids of one conversation (not its texts) lie in one row.
Ids of members are grouped in runs of 4,096 numbers first; the runs of equal conversations pass through one task as a stream,
because their digest depends on their order.

NULL roles and texts are empty, a NULL turn comes first, equal turns are ordered by their ids. Rows with a NULL
``conv_id`` belong to no conversation and are left out; repeated rows are turns of their own. An empty table has no members and so
no root. Very long texts are counted and digested where they are read. Further columns aren't read. ``%`` is SQL's: -5 belongs with 0.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import ready, table
from tidemark.session import written

#: Different suffixes in a container that does not burst, at least, and heads that burst in a level, at most.
SUFFIXES, HEADS = 2048, 100_000
#: Bits of the numbers that a run of members' ids spans.
RUN = 12
#: Bytes of a turn's id.
ID = 16
#: Rows of one batch of nodes.
ROWS = 20_000

_NODE = (
    "head binary, parent_head binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_ROOT = hashlib.md5(b"").digest()
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value))


def in_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the ids and numbers of words of each conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        "turn",
        F.md5(F.concat(F.octet_length(role), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("turn"))
    in_order = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(F.transform(in_order, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first turns of the one before them that ``every`` divides, ``crc32 % most`` of them."""
    first = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("origin"), F.slice("turns", 1, most - 1).alias("first")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = turns.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("origin"))
    none = F.slice("turns", 1, 0)
    begun = F.slice(F.coalesce("first", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(first, "origin", "left").select("conv_id", F.concat(begun, rest).alias("turns"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of members in order to one row per conversation text, with the digest of all its members' ids."""
    own, state = None, None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if own is None or r["key"] != own["key"]:
                if own is not None:
                    out.append(own | {"digest": state.hexdigest()})
                own, state = {k: r[k] for k in ("key", "conv_id", "ids", "words")} | {"n": 0}, hashlib.sha256()
            elif own["n"]:
                state.update(b",")
            state.update(r["members"].encode())
            own["n"] += r["n"]
        if out:
            yield pa.RecordBatch.from_pylist(out, _SUFFIX)
    if own is not None:
        yield pa.RecordBatch.from_pylist([own | {"digest": state.hexdigest()}], _SUFFIX)


_SUFFIX = pa.schema(
    [("key", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("ids", pa.binary()), ("words", pa.list_(pa.int32()))]
)


def suffixes(conversations: DataFrame) -> DataFrame:
    """``(key, conv_id, n, digest, ids, words)`` of each different conversation ``(conv_id, turns)``, members counted."""
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    rows = conversations.select("conv_id", ids.alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"))
    runs = rows.groupBy(_digest(F.col("ids")).alias("key"), F.shiftright("conv_id", RUN).alias("run")).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("members"),
        F.any_value("ids").alias("ids"),
        F.any_value("words").alias("words"),
    )
    in_order = runs.repartition("key").sortWithinPartitions("key", "run").select("key", "conv_id", "n", "members", "ids", "words")
    return in_order.mapInArrow(_members, "key binary, conv_id long, n long, digest string, ids binary, words array<int>")


# -- bursting ----------------------------------------------------------------------------------


def burst(found: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows in containers of at most ``limit`` different suffixes, and of each level the heads that burst.

    Rows get ``head``, ``parent_head``, ``depth``, ``head_words`` (words of the head's last turn), and lose what the head has of
    ``ids`` and ``words``. Heads carry the row that ends there, if there is one.
    """
    going = found.select(
        F.lit(_ROOT).alias("head"), F.lit(None).cast("binary").alias("parent_head"), F.lit(0).alias("depth"), F.lit(0).alias("head_words"),
        "conv_id", "n", "digest", "ids", "words",
    )
    done, levels = None, []
    while True:
        large = going.groupBy("head").count().where(F.col("count") > limit).select("head")
        if not large.take(1):
            return going if done is None else done.unionByName(going), levels
        large = F.broadcast(written(large, "large"))
        stay = going.join(large, "head", "left_anti").select(*going.columns)
        done = stay if done is None else done.unionByName(stay)
        split = going.join(large, "head", "left_semi")
        ends = F.octet_length("ids") == 0
        end = F.max(F.when(ends, F.struct("conv_id", "n", "digest")))
        levels.append(written(split.groupBy("head", "parent_head", "depth", "head_words").agg(end.alias("end")), "heads"))
        following = F.expr(f"substring(ids, 1, {ID})")
        going = split.where(~ends).select(
            _digest(F.concat("head", following)).alias("head"), F.col("head").alias("parent_head"), (F.col("depth") + 1).alias("depth"),
            F.col("words")[0].alias("head_words"), "conv_id", "n", "digest", F.expr(f"substring(ids, {ID + 1})").alias("ids"),
            F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("words"),
        )
        going = written(going, "burst")


# -- sweeping ----------------------------------------------------------------------------------


class _Open:
    """A node whose members are still being read."""

    __slots__ = ("children", "conv_id", "digest", "id", "inner", "leaves", "n", "saved", "words")

    def __init__(self, id_: bytes, words: int):
        self.id, self.words, self.conv_id, self.n, self.digest = id_, words, None, 0, _NO_ENDS
        self.leaves = self.saved = self.children = 0
        self.inner: list[tuple] = []  # its children, as far as they are known

    def close(self) -> None:
        self.saved += (self.n - 1) * self.words
        self.leaves = self.leaves or 1

    def take(self, child: "_Open", depth: int, out: list[tuple]) -> None:
        """Add a closed child up; its children now know their parent's smallest member."""
        out.extend((*row[:2], child.conv_id, *row[2:]) for row in child.inner)
        self.inner.append((depth, child.conv_id, child.n, child.children, child.leaves, child.saved, child.digest))
        self.conv_id = child.conv_id if self.conv_id is None else min(self.conv_id, child.conv_id)
        self.n += child.n
        self.leaves += child.leaves
        self.saved += child.saved
        self.children += 1


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers one after the other, their suffixes in order, to the nodes below each head, and the heads' own sums."""
    path: list[_Open] = []
    place: dict = {}
    out: list[tuple] = []
    rows: list[tuple] = []

    def fold(to: int) -> None:
        while len(path) > to:
            child = path.pop()
            child.close()
            path[-1].take(child, place["depth"] + len(path), rows)
        out.extend((place["head"], None, *row) for row in rows)
        rows.clear()

    def finish() -> None:
        fold(1)
        top = path.pop()
        top.close()
        out.extend((place["head"], None, *row[:2], top.conv_id, *row[2:]) for row in top.inner)
        out.append((place["head"], place["parent_head"], place["depth"], top.conv_id, None, top.n, top.children, top.leaves, top.saved, top.digest))

    def batch_of(some: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _NODES.types, strict=True)], schema=_NODES)

    for batch in batches:
        for r in batch.to_pylist():
            if not path or r["head"] != place["head"]:
                if path:
                    finish()
                place = {k: r[k] for k in ("head", "parent_head", "depth")}
                path = [_Open(r["head"], r["head_words"])]
            ids, shared = r["ids"], 1
            turns = [ids[k : k + ID] for k in range(0, len(ids), ID)]
            while shared < len(path) and shared <= len(turns) and path[shared].id == turns[shared - 1]:
                shared += 1
            fold(shared)
            path += [_Open(turns[k], r["words"][k]) for k in range(shared - 1, len(turns))]
            last = path[-1]
            last.digest, last.conv_id, last.n = r["digest"], r["conv_id"], r["n"]
            if len(out) >= ROWS:
                yield batch_of(out)
                out.clear()
    if path:
        finish()
    if out:
        yield batch_of(out)


_NODES = pa.schema(
    [("head", pa.binary()), ("parent_head", pa.binary()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string())]
)


def trie(conversations: DataFrame, limit: int = SUFFIXES) -> DataFrame:
    """The nodes, as ``NODE`` names their columns, of conversations ``(conv_id, turns)``.

    Each container gives its nodes and, as a row of its own, its head, which the level above takes in.
    """
    found = written(suffixes(conversations), "suffixes")
    containers, levels = burst(found, max(limit, found.count() // HEADS))
    in_order = containers.repartition("head").sortWithinPartitions("head", "ids")
    swept = written(in_order.select("head", "parent_head", "depth", "head_words", "conv_id", "n", "digest", "ids", "words").mapInArrow(_nodes, _NODE), "nodes")
    # Nodes that know their parent's smallest member; heads of containers, and then of burst heads, wait for theirs.
    tops = swept.where("parent_conv_id IS NULL")
    out = [swept.where("parent_conv_id IS NOT NULL")]
    for heads in reversed(levels):
        depth = F.col("depth") == heads.first().depth + 1
        children = tops.where(depth & F.col("parent_head").isNotNull())
        sums = children.groupBy(F.col("parent_head").alias("head")).agg(
            F.min("conv_id").alias("least"), F.sum("n_convs").alias("n"), F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"),
        )
        n = F.col("n") + F.coalesce("end.n", F.lit(0))
        made = heads.join(sums, "head").select(
            "head", "parent_head", "depth", F.least("least", "end.conv_id").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
            n.alias("n_convs"), "n_children", "n_leaves", (F.col("saved") + (n - 1) * F.col("head_words")).alias("saved_tokens"),
            F.coalesce("end.digest", F.lit(_NO_ENDS)).alias("ends_sha256"),
        )
        made = written(made, "heads")
        parents = F.broadcast(made.select(F.col("head").alias("parent_head"), F.col("conv_id").alias("_least")))
        out.append(children.join(parents, "parent_head").withColumn("parent_conv_id", F.col("_least")).select(*swept.columns))
        tops = tops.where(~depth).unionByName(made)
    nodes = tops
    for part in out:
        nodes = nodes.unionByName(part)
    return nodes.select(*(F.col(c).cast("long").alias(c) if c == "depth" else c for c in NODE))


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return trie(rebuilt(in_turns(table(spark, sf_dir, "conversations"))))
