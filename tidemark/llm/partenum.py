"""Operator 2: Jaccard join of word n-gram sets by PartEnum signatures.

A document's set has the hashes of its n-grams. Sizes fall into bands, so that sets similar enough are in
one band or in neighbouring ones; a pair of bands bounds by how many elements two such sets can differ, ``k``.
The range of hashes is cut into ``n1`` equal parts, and each into ``n2`` smaller ones. Of ``k`` differences, some
part has at most ``k2``, so the two sets agree on all but ``k2`` of its smaller parts. A signature is the
hash of what a set has in a part without one choice of ``k2`` smaller parts; every choice is enumerated.
Similar sets therefore share a signature, and sharing sets are compared element by element.

An empty part would be shared by many sets, so signatures of nothing are left out. ``n1`` is larger by some spare
parts, so that similar sets agree on one more part than the spare ones; a set with more empty choices than
spare parts keeps its empty signatures, so no pair is lost.

Most texts are like no other. A set is no more similar to any other than the share of its elements that some other set
has, so sets whose share is below the threshold get no signatures. For that, packets of neighbouring texts send
their distinct elements to ranges of hashes and are told, in that order, which of them are not theirs alone.

Equal sets are one node. Sets are first compared with the least sets of some of their signatures, then with those in the
middle of them; after components are formed, only members of different components are paired. A set's own elements, which no other such
member has, bound how similar it can be to any: most members drop out by that, and most pairs. Where a signature's members
are in many components, each looks for partners by its rarest elements: of two similar sets,
the rarest ``size - ceil(threshold * size) + 1`` elements of each, in one common order, have one in common.

NULL and empty texts have empty sets and link with nothing; repeated rows are all returned; an empty table gives
no rows. Other columns are not read.
"""

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import GROUP, LOWER, PRINTED, freeing, groups_for, hashed, keyed, mixed, placed, ready, releasing, runs, sliced, table, texts_of, windows
from tidemark.llm.components import components
from tidemark.session import discard, noting_scratch, settings, written

#: Rows of a packet, and bytes of elements that it asks for at once: it asks in stretches of so many, or of one text.
PACKET, STRETCH = 2048, 4 << 20
#: Bytes of text whose signatures meet in one group. Each group is told the sets of every stretch that it has signatures of, so fewer
#: and larger groups take less disk; what a group takes in memory is some twenty times as much.
SIGNATURE_GROUP = 5 << 20
#: Signatures of a group that are put in order at once.
ORDERED = 1 << 18
#: Rows of signatures that a scan reads at once, where the default is thousands: each has tens of kilobytes. Their pages end by size.
BLOBS, BLOB_PAGES = 64, {"parquet.page.size.row.check.min": "4"}
#: Shuffles that the signatures are dealt over, one after the other.
PARTS = 4
#: Components that the members of a signature may be in and still be paired one by one.
PAIRED = 4
#: Sets that a set is compared with first, those that share most of its signatures.
FIRST = 4
#: Elements that a signature should have at least, of the smallest sets of its bands.
ELEMENTS = 6


def sets_of(column, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; with fewer words, of the whole sequence."""
    data, offsets = texts_of(column)
    data = LOWER[data]
    starts, ends, first = runs(PRINTED[data[: offsets[-1]]], offsets)
    words = hashed(data, starts, ends)
    grams = windows(words, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(mixed(windows(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def key_of(own: np.ndarray) -> bytes:
    """Sixteen bytes for a set."""
    return np.array([len(own) + mixed(own).sum(), mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], "<u8").tobytes()


class Bands:
    """Size bands for ``num / den`` similarity and the partitions of each."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.highs = [0]

    def band(self, size: int) -> int:
        while self.highs[-1] < size:
            self.highs.append((self.highs[-1] + 1) * self.den // self.num)
        return int(np.searchsorted(self.highs, size))

    @lru_cache(maxsize=None)  # noqa: B019  one object per task
    def shape(self, band: int) -> tuple[int, int, np.ndarray, int]:
        """``n1``, ``n2``, the enumerated choices of smaller parts, and the spare parts, for pairs whose larger set is in the band."""
        k = (self.den - self.num) * 2 * self.highs[band] // (self.den + self.num)
        least = self.highs[max(0, band - 2)] + 1
        if k <= 6:
            n2, k2 = (k + 2, k) if k else (1, 0)
            return 1, n2, np.array(list(combinations(range(n2), n2 - k2))), 0
        # More enumeration gives signatures of more elements, which fewer unlike sets share.
        for n2, k2 in ((3, 1), (5, 2), (7, 3)):
            n1, spare = k // (k2 + 1) + 1, 0
            choices = np.array(list(combinations(range(n2), n2 - k2)))
            if least * (n2 - k2) / n2 / n1 >= ELEMENTS:
                break
        for _ in range(2):
            empty = (n1 + spare) * len(choices) * exp(-least * (n2 - k2) / n2 / (n1 + spare))
            # Any number of spare parts is right; many would make each part too small.
            spare = 0 if empty < 0.05 or empty > n1 / 2 else ceil(empty + 2 * sqrt(empty))
        return n1 + spare, n2, choices, spare

    def signatures(self, own: np.ndarray) -> np.ndarray:
        """All signatures of a set of sorted hashes."""
        band, out = self.band(len(own)), []
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(own))])
        self.band(self.highs[band] + 1)
        for pair in (band, band + 1):
            n1, n2, choices, spare = self.shape(pair)
            parts = n1 * n2
            # Equal parts of the range of hashes; the elements of each are neighbours.
            cuts = np.searchsorted(own, (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64))
            cuts = np.concatenate([[0], cuts, [len(own)]])
            part_sums, part_sizes = np.diff(sums[cuts]).reshape(n1, n2), np.diff(cuts).reshape(n1, n2)
            total, sizes = part_sums[:, choices].sum(axis=2), part_sizes[:, choices].sum(axis=2)
            tags = (np.arange(n1 * len(choices), dtype=np.uint64) + np.uint64(pair << 40)).reshape(total.shape)
            found = mixed(mixed(total + sizes.astype(np.uint64)) ^ mixed(tags))
            out.append(found.reshape(-1) if (sizes == 0).any(axis=1).sum() > spare else found[sizes > 0])
        return np.concatenate(out)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, so that compression finds the runs of zeros."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _from_planes(x: bytes | pa.Buffer, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


ASKED = "bucket int, packet long, row_from long, row_to long, elements binary, twice binary"


def _elements_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct elements of some sets, and whether different ones of the sets have them. Equal sets count once."""
    distinct = list({key_of(x): x for x in sets if len(x)}.values())
    elements, counts = np.unique(np.concatenate(distinct), return_counts=True) if distinct else (np.zeros(0, np.uint64), np.zeros(0))
    return elements, counts > 1


def _cuts(elements: np.ndarray, buckets: int) -> np.ndarray:
    """Where equal ranges of hashes begin among sorted hashes, and the end."""
    inner = np.searchsorted(elements, (np.arange(1, buckets) * (2.0**64 / buckets)).astype(np.uint64))
    return np.concatenate([[0], inner, [len(elements)]])


def _asked(size: int, buckets: int):
    """The distinct elements of each packet, by range: sorted, as differences."""

    def flush(packet: int, rows: list[np.ndarray], sets: list[np.ndarray]) -> pa.RecordBatch:
        elements, twice = _elements_of(sets)
        cuts, out = _cuts(elements, buckets), []
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            own = elements[cuts[k] : cuts[k + 1]]
            out.append((k, packet, int(rows[0][0]), int(rows[-1][-1]), _planes(np.diff(own, prepend=np.uint64(0))), np.packbits(twice[cuts[k] : cuts[k + 1]]).tobytes()))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        names = ("bucket", "packet", "row_from", "row_to", "elements", "twice")
        columns = list(zip(*out, strict=True)) or [()] * 6
        return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet, rows, sets = None, [], []
        for batch in sliced(batches, "text"):
            packets, at = batch.column("packet").to_numpy(), batch.column("row_at").to_numpy()
            cuts = np.flatnonzero(np.diff(packets)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(packets)], strict=True):
                if rows and (packets[a] != packet or sum(x.nbytes for x in sets) >= STRETCH):
                    yield flush(packet, rows, sets)
                    rows, sets = [], []
                packet = int(packets[a])
                rows.append(at[a:b])
                sets += sets_of(batch.column("text").slice(a, b - a), size)
        if rows:
            yield flush(packet, rows, sets)

    return run


def _answered(group: pa.Table) -> pa.Table:
    """Of one range of hashes: per packet, which of its elements some other set has too."""
    asked = [np.cumsum(_from_planes(x, "<u8")) for x in group.column("elements").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)) for a, x in zip(asked, group.column("twice").to_pylist(), strict=True)]
    elements = np.concatenate(asked)
    order = np.argsort(elements)
    ordered, flags = elements[order], np.concatenate(twice)[order] > 0
    equal = ordered[1:] == ordered[:-1]
    flags[1:] |= equal
    flags[:-1] |= equal
    # The first of several carries its own flag to the others only by being equal, so all have one now.
    shared = np.empty(len(order), bool)
    shared[order] = flags
    ends = np.cumsum([len(x) for x in asked]).tolist()
    bits = [np.packbits(shared[e - len(x) : e]).tobytes() for e, x in zip(ends, asked, strict=True)]
    columns = {c: group.column(c) for c in ("bucket", "packet", "row_from", "row_to")}
    return pa.table({**columns, "elements": pa.array([len(x) for x in asked], pa.int64()), "shared": pa.array(bits, pa.binary())})


SIGNED = "row_file long, row_at long, doc_id long, n_shingles long, node binary, bucket int, nodes binary, signatures binary, owners binary"


def _signed(size: int, num: int, den: int, buckets: int):
    """Rows with their sets' keys; and signatures of the sets that may be similar to another, by range: sorted, as
    differences, with the number of the set."""
    types = {f.name: f.type for f in pa.schema([("row_file", pa.int64()), ("row_at", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bucket", pa.int32()), ("nodes", pa.binary()), ("signatures", pa.binary()), ("owners", pa.binary())])}

    def table_of(n: int, **given) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in types.items()})

    def flush(found: dict[bytes, np.ndarray]) -> Iterator[pa.RecordBatch]:
        nodes = np.frombuffer(b"".join(found), np.uint8).reshape(-1, 16)
        signatures = np.concatenate(list(found.values()))
        owner = np.repeat(np.arange(len(found), dtype="<u4"), [len(x) for x in found.values()])
        order = np.argsort(signatures)
        signatures, owner = signatures[order].astype("<u8"), owner[order]
        cuts, rows = _cuts(signatures, buckets).tolist(), []
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b > a:
                own, local = np.unique(owner[a:b], return_inverse=True)
                rows.append((k, nodes[own].tobytes(), _planes(np.diff(signatures[a:b], prepend=np.uint64(0))), _planes(local.astype("<u4"))))
        if rows:
            bucket, keys, deltas, owners = zip(*rows, strict=True)
            yield table_of(len(rows), bucket=bucket, nodes=keys, signatures=deltas, owners=owners)

    def packet_of(bands: Bands, batches: list[pa.RecordBatch], told: dict[int, tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        parts = [sets_of(b.column("text"), size) for b in batches]
        elements, _ = _elements_of([x for p in parts for x in p])
        shared = [np.unpackbits(np.frombuffer(told[k][1], np.uint8), count=told[k][0]) for k in sorted(told)]
        shared, found = np.concatenate(shared) if shared else np.zeros(0, np.uint8), {}
        for batch, own in zip(batches, parts, strict=True):
            keys = [key_of(x) if len(x) else None for x in own]
            columns = {c: batch.column(c) for c in ("row_file", "doc_id")}
            yield table_of(len(own), **columns, row_at=batch.column("row_from"), n_shingles=[len(x) for x in own], node=keys)
            for key, x in zip(keys, own, strict=True):
                if key is not None and key not in found:
                    have = int(shared[np.searchsorted(elements, x)].sum())
                    found[key] = bands.signatures(x) if den * have >= num * len(x) else np.zeros(0, np.uint64)
        yield from flush({k: v for k, v in found.items() if len(v)} or {bytes(16): np.zeros(0, np.uint64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by packet, and within it by stretch: what the rows that asked together are told, then their texts.
        bands, packet, told, held, upto = Bands(num, den), None, {}, [], -1
        for batch in sliced(batches, "text"):
            packets, rows = (batch.column(c).to_numpy() for c in ("packet", "row_from"))
            kinds = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(kinds) != 0) | (np.diff(packets) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)], strict=True):
                if packets[a] != packet:
                    if held:
                        yield from packet_of(bands, held, told.get(upto, {}))
                    packet, told, held, upto = packets[a], {}, [], -1
                if kinds[a] == 0:
                    if held:
                        yield from packet_of(bands, held, told.get(upto, {}))
                        told, held, upto = {}, [], -1
                    some = batch.slice(a, b - a)
                    for to, bucket, n, bits in zip(*(some.column(c).to_pylist() for c in ("row_to", "bucket", "elements", "shared")), strict=True):
                        told.setdefault(to, {})[bucket] = (n, bits)
                    continue
                while a < b:
                    if held and rows[a] > upto:
                        yield from packet_of(bands, held, told.get(upto, {}))
                        held = []
                    # Rows that asked together end with the first row_to that is not before them; texts without words asked nothing.
                    upto = min((to for to in told if to >= rows[a]), default=int(rows[b - 1]))
                    end = a + int(np.searchsorted(rows[a:b], upto, side="right"))
                    held.append(batch.slice(a, end - a))
                    a = end
        if held:
            yield from packet_of(bands, held, told.get(upto, {}))

    return run


def _met(signatures: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures that several sets have, and those sets, in order. Each array is sorted, so one narrow range after the other is put together."""
    low, high = min(int(x[0]) for x in signatures), max(int(x[-1]) for x in signatures)
    steps = -(-sum(map(len, signatures)) // ORDERED)
    edges = np.array([low + (high - low) * k // steps for k in range(1, steps)], np.uint64)
    cuts = [[0, *np.searchsorted(x, edges).tolist(), len(x)] for x in signatures]
    for k in range(steps):
        signature = np.concatenate([x[c[k] : c[k + 1]] for x, c in zip(signatures, cuts, strict=True)])
        owner = np.concatenate([x[c[k] : c[k + 1]] for x, c in zip(owners, cuts, strict=True)])
        order = np.lexsort((owner, signature))
        signature, owner = signature[order], owner[order]
        new = np.ones(len(order), bool)
        new[1:] = (signature[1:] != signature[:-1]) | (owner[1:] != owner[:-1])
        signature, owner = signature[new], owner[new]
        several = np.zeros(len(signature), bool)
        several[1:] = signature[1:] == signature[:-1]
        several[:-1] |= several[1:]
        yield signature[several], owner[several].astype(np.int64)


def _shared(group: pa.Table) -> pa.Table:
    """Of one range of signatures: those that several sets have, with their sets."""
    nodes, signatures, owners, base = [], [], [], 0
    for keys, deltas, local in zip(*(group.column(c) for c in ("nodes", "signatures", "owners")), strict=True):
        nodes.append(np.frombuffer(keys.as_buffer(), np.uint8).reshape(-1, 16))
        signatures.append(np.cumsum(_from_planes(deltas.as_buffer(), "<u8")))
        owners.append(_from_planes(local.as_buffer(), "<u4") + np.uint32(base))
        base += len(nodes[-1])
    # Equal sets from several stretches become one number, in the order of their keys.
    nodes, same = np.unique(np.concatenate(nodes).view(">u8").reshape(-1, 2), axis=0, return_inverse=True)
    same = same.reshape(-1).astype(np.uint32)
    for k, own in enumerate(owners):
        owners[k] = same[own]
    signatures, owners = map(np.concatenate, zip(*_met(signatures, owners), strict=True))
    _, first, size = np.unique(signatures, return_index=True, return_counts=True)
    # Many signatures have the same sets; one of them stands for all.
    alike = mixed(np.add.reduceat(mixed(owners.astype(np.uint64) + np.uint64(1)), first) + size.astype(np.uint64))
    one = np.zeros(len(size), bool)
    one[np.unique(alike, return_index=True)[1]] = True
    pivot = np.repeat(owners[first], size)
    keys = nodes.view(np.uint8).reshape(-1, 16)

    def column(which: np.ndarray) -> pa.Array:
        ends = np.arange(0, 16 * len(which) + 1, 16, dtype=np.int32)
        return pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(ends), pa.py_buffer(keys[which].tobytes())])

    kept = np.repeat(one, size)
    pairs, shares = np.unique(np.stack([pivot, owners], axis=1)[pivot != owners], axis=0, return_counts=True)
    n = len(pairs)
    return pa.table(
        {
            "signature": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(signatures[kept].view(np.int64))]),
            "u": pa.concat_arrays([column(pairs[:, 0]), pa.nulls(int(kept.sum()), pa.binary())]),
            "v": pa.concat_arrays([column(pairs[:, 1]), column(owners[kept])]),
            "shares": pa.concat_arrays([pa.array(shares), pa.nulls(int(kept.sum()), pa.int64())]),
        }
    )


def _set_blobs(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            own = sets_of(batch.column("text"), size)
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "own": pa.array([x.tobytes() for x in own], pa.binary())})

    return run


def _similar(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True)) if den * min(len(a), len(b)) >= num * max(len(a), len(b)) else 0
                linked.append(den * both >= num * (len(a) + len(b) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(keep) for c in ("u", "v")})

    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [np.frombuffer(x, np.int64) for x in batch.column("own").to_pylist()]
        sizes = np.array([len(x) for x in own], np.int64)
        which = pa.array(np.repeat(np.arange(len(own)), sizes))
        columns = {"element": pa.array(np.concatenate(own)), "size": pa.array(np.repeat(sizes, sizes))}
        yield pa.RecordBatch.from_pydict({**columns, **{c: batch.column(c).take(which) for c in ("node", "root")}})


def _across(members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(u, v)`` of one signature's members that are in different components and may have enough in common: at most
    the lesser of what either may share (``most``)."""
    columns = ("node", "root", "size", "most")
    left, right = (members.select("signature", *(F.col(c).alias(f"{side}_{c}") for c in columns)) for side in "uv")
    may = (num + den) * F.least("u_most", "v_most") >= num * (F.col("u_size") + F.col("v_size"))
    met = (left["signature"] == right["signature"]) & (F.col("u_node") < F.col("v_node")) & (F.col("u_root") != F.col("v_root"))
    return left.join(right, met & may).select(F.col("u_node").alias("u"), F.col("v_node").alias("v")).distinct()


class Join:
    """The steps of a similarity join over ``docs(doc_id, text)``; all tables are written."""

    def __init__(self, docs: DataFrame, size: int, num: int, den: int):
        spark = ready(docs.sparkSession)
        self.size, self.num, self.den = size, num, den
        self.docs = placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
        buckets, signature_buckets = groups_for(self.docs, GROUP, SIGNATURE_GROUP)
        packet = F.xxhash64("row_file", F.expr(f"row_at div {PACKET}")).alias("packet")
        rows = keyed(self.docs, "doc_id", "text").select("*", packet)
        asked = rows.select("row_at", "packet", "text").mapInArrow(releasing(_asked(size, buckets)), ASKED)
        with noting_scratch() as passed:
            answers = written(
                asked.groupBy("bucket").applyInArrow(freeing(_answered), "bucket int, packet long, row_from long, row_to long, elements long, shared binary"), "answers"
            )
        texts = rows.select("packet", F.lit(1).alias("kind"), F.col("row_at").alias("row_from"), "row_file", "doc_id", "text")
        both = answers.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
        both = both.repartition("packet").sortWithinPartitions("packet", "row_from", "kind")
        with noting_scratch() as used:
            signed = written(both.mapInArrow(releasing(_signed(size, num, den, signature_buckets)), SIGNED), "sets", **BLOB_PAGES)
        discard(spark, passed)
        rows = signed.where("bucket IS NULL").select("row_file", "row_at", "doc_id", "n_shingles", "node")
        self.rows = written(rows, "rows")
        # One part of the groups after the other: what is shuffled for the first is gone before the second.
        blobs = signed.where("bucket IS NOT NULL").select("bucket", "nodes", "signatures", "owners")
        with settings(spark, spark__sql__parquet__columnarReaderBatchSize=BLOBS):
            parts = [
                written(blobs.where(F.col("bucket") % PARTS == k).groupBy("bucket").applyInArrow(freeing(_shared), "signature long, u binary, v binary, shares long"), "shared")
                for k in range(PARTS)
            ]
        discard(spark, used)
        self.found = reduce(DataFrame.unionByName, parts)
        self.members = self.found.where("signature IS NOT NULL").select("signature", F.col("v").alias("node"))
        # The least set of each signature is met first, by each other set up to a few times; the rest waits for the components.
        pairs = self.found.where("signature IS NULL").groupBy("u", "v").agg(F.sum("shares").alias("shares"))
        most = Window.partitionBy("v").orderBy(F.desc("shares"), "u")
        self.candidates = written(pairs.withColumn("at", F.row_number().over(most)).where(F.col("at") <= FIRST).select("u", "v"), "first")

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """``(node, own)`` of the given nodes, each made anew from the text of one of its rows."""
        first = self.rows.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("row_file", "row_at")).alias("row"))
        wanted = first.join(nodes.distinct(), "node", "left_semi").select("node", "row.row_file", "row.row_at")
        texts = keyed(self.docs, "text").join(wanted, ["row_file", "row_at"]).select("node", "text")
        return texts.mapInArrow(releasing(_set_blobs(self.size)), "node binary, own binary")

    def _linked(self, pairs: DataFrame) -> DataFrame:
        a = self.sets.select(F.col("node").alias("u"), F.col("own").alias("a"))
        b = self.sets.select(F.col("node").alias("v"), F.col("own").alias("b"))
        return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(releasing(_similar(self.num, self.den)), "u binary, v binary")

    def roots(self) -> DataFrame:
        """``(node, root)`` of every set that links with another."""
        self.sets = written(self._sets(self.members.select("node")), "set-hashes")
        links = written(self._linked(self.candidates), "links")
        roots = components(links)
        labelled = self._labelled(roots)
        # Then with the member that most others share signatures with, in the middle of its group.
        sizes = labelled.groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
        weights = labelled.join(sizes, "signature").groupBy("node").agg(F.sum("n").alias("weight"))
        middles = labelled.join(weights, "node").groupBy("signature").agg(F.max_by(F.struct("node", "root"), F.struct("weight", "node")).alias("m"))
        met = labelled.join(middles, "signature").where("root != m.root").select(F.least("node", "m.node").alias("u"), F.greatest("node", "m.node").alias("v"), "node")
        most = Window.partitionBy("node").orderBy(F.desc("shares"), "u", "v")
        met = met.groupBy("u", "v", "node").agg(F.count(F.lit(1)).alias("shares")).withColumn("at", F.row_number().over(most))
        middle = written(met.where(F.col("at") <= FIRST).select("u", "v").distinct().join(self.candidates, ["u", "v"], "left_anti"), "middle")
        done = self.candidates.union(middle)
        links = written(links.union(self._linked(middle)), "links")
        roots = components(links)
        # Members of one signature that these comparisons left in different components.
        labelled = self._labelled(roots)
        open_ = self._parted(labelled).where("parts > 1").select("signature", "node", "root")
        open_ = written(open_, "open")
        elements = self._elements(open_.select("node", "root").distinct())
        held = elements.groupBy("element").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        shares = elements.join(held, "element").groupBy("node").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("most"))
        able = shares.where(F.col("most") * self.den >= F.col("size") * self.num)
        live = self._parted(open_.join(able, "node")).withColumn("many", F.col("parts") > PAIRED)
        live = written(live, "live")
        few = _across(live.where("NOT many"), self.num, self.den)
        many = live.where("many").select("node", "root").distinct()
        pairs = few.union(_across(self._rarest(many), self.num, self.den)).distinct().join(done, ["u", "v"], "left_anti")
        more = written(self._linked(pairs), "links")
        return components(links.union(more)) if not more.isEmpty() else roots

    def _labelled(self, roots: DataFrame) -> DataFrame:
        """``(signature, node, root)`` of all members of signatures."""
        labelled = self.members.join(roots, "node", "left").select("signature", "node", F.coalesce("root", "node").alias("root"))
        return written(labelled, "members")

    def _parted(self, members: DataFrame) -> DataFrame:
        """Add the number of components that the members of each signature are in."""
        roots = members.groupBy("signature", "root").agg(F.count(F.lit(1)).alias("n"))
        return members.join(roots.groupBy("signature").agg(F.count("n").alias("parts")), "signature")

    def _elements(self, nodes: DataFrame) -> DataFrame:
        """``(element, size, node, root)`` of the sets of some nodes."""
        rows = self.sets.join(nodes, "node").select("node", "root", "own")
        return written(rows.mapInArrow(releasing(_elements), "element long, size long, node binary, root binary"), "elements")

    def _rarest(self, nodes: DataFrame) -> DataFrame:
        """``(signature, node, root, size, most)``: of each node the rarest elements that another of them may share.

        If one of them is the first that two sets share, they share no more than it and what comes behind it.
        """
        rows = self._elements(nodes)
        held = rows.groupBy("element").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        # Elements that no other node has come first; only the places they leave need a look.
        by_node = Window.partitionBy("node")
        ranked = rows.join(held, "element").select(
            "*", F.row_number().over(by_node.orderBy("held", "element")).alias("at"), F.count(F.lit(1)).over(by_node).alias("common")
        )
        looked = F.expr(f"size - (size * {self.num} + {self.den - 1}) div {self.den} + 1 - (size - common)")
        most = (F.col("common") - F.col("at") + 1).alias("most")
        return ranked.where(F.col("at") <= looked).select(F.col("element").alias("signature"), "node", "root", "size", most)

    def linked(self) -> DataFrame:
        """Per row: ``row_file, row_at, doc_id, n_shingles, component_id``."""
        rows = self.rows.join(self.roots(), "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
        out = rows.join(least, "root", "left")
        component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        return out.select("row_file", "row_at", "doc_id", "n_shingles", "root", component.alias("component_id"))


def op2_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return Join(docs, size=4, num=85, den=100).linked().select("doc_id", "n_shingles", "component_id")
