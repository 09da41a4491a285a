"""Operator 4: removal of long repeated byte strings by a distributed merge sort of suffixes.

Sorting every suffix with 400 bytes of each would move the corpus hundreds of times over, so suffixes start at
anchors only: places whose 8 bytes have the least hash in some window of ``length - 7`` places. Equal strings of
``length`` bytes have their anchors at equal places, so every repeated string has an anchor in each occurrence.

1. Anchors whose half of ``length`` bytes before or behind occurs only once cannot lie in a repeated string; they
   are left out (the distinguishing prefix is found with fingerprints before any suffix travels).
2. Each task sorts its suffixes, up to ``length`` bytes long, into runs and sends them front-coded: the length of
   the prefix shared with the suffix before, and the rest. The bytes before the anchor go along.
3. Per range of anchors a loser tree merges the runs. It compares two suffixes only from the prefix on that
   both are known to share with the last one put out, and yields the common prefix of neighbours.
4. Neighbours are joined from the longest common prefix down. In each joined set, suffixes are kept in the order of the
   bytes before them, backwards; a suffix's best partner there is a neighbour in that order. A
   partner with ``r`` bytes in common behind and ``l`` before makes strings repeated that start up to ``l`` before and
   end up to ``r`` behind. The smaller set always goes into the larger one, so n suffixes take n log n steps.

The spans found cover exactly the bytes of strings that start anywhere else too. NULL and short texts have none;
repeated rows, and equal or NULL ``doc_id``, are distinct places; an empty table gives no rows.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import as_signed, hashed, keyed, mixed, placed, ready, sliced, table, texts_of
from tidemark.session import written

LENGTH = 400
GRAM = 8
FLUSH = 16 << 20


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Best value of each window, by doubling; entry i is the window that starts at i."""
    size, out = 1, x
    while 2 * size <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    return best(out[: len(x) - width + 1], out[width - size :][: len(x) - width + 1]) if width > size else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of texts of at least ``length`` bytes: places in ``data`` and the number of the text."""
    n, width = int(offsets[-1]), length - GRAM + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    eight = np.ndarray((n - GRAM + 1,), "<u8", data, strides=(1,))
    order = ((eight * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    order ^= order >> np.uint32(15)
    order *= np.uint32(0x2C1B3C6D)
    least = _sliding(order, width, np.minimum)
    # Windows that a place lies in start up to width - 1 before it; padding stands for windows beyond the ends.
    padded = np.concatenate([np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)])
    at = np.flatnonzero(_sliding(padded, width, np.maximum)[: len(order)] == order)
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = (at + GRAM <= offsets[text + 1]) & (offsets[text + 1] - offsets[text] >= length)
    return at[inside], text[inside]


def _fingerprints(length: int, buckets: int):
    """Per stretch of texts: fingerprints of the halves around anchors, one entry each, and what is already known to repeat."""
    half = length // 2
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = ("bucket", "prints", "row_file", "row_at", "places")

    def rows(bucket: int, prints: np.ndarray, file: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple:
        return bucket, prints.tobytes(), file.tobytes(), row.tobytes(), place.astype(np.int64).tobytes()

    def flush(parts: list) -> pa.RecordBatch:
        prints, file, row, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(prints, kind="stable")
        prints, file, row, place = prints[order], file[order], row[order], place[order]
        first = np.ones(len(prints), bool)
        first[1:] = prints[1:] != prints[:-1]
        # The first of several is sent with its fingerprint for others to meet; all others are known to repeat.
        out, rest = [], ~first
        if rest.any():
            several = np.flatnonzero(first)[np.diff(np.append(np.flatnonzero(first), len(prints))) > 1]
            known = np.concatenate([np.flatnonzero(rest), several])
            out.append(rows(int(prints[0] % np.uint64(buckets)), np.zeros(0, np.uint64), file[known], row[known], place[known]))
        prints, file, row, place = prints[first], file[first], row[first], place[first]
        cuts = np.searchsorted(prints, (np.arange(1, buckets) * (2.0**64 / buckets)).astype(np.uint64))
        for k, (a, b) in enumerate(zip([0, *cuts.tolist()], [*cuts.tolist(), len(prints)], strict=True)):
            if b > a:
                out.append(rows(k, prints[a:b], file[a:b], row[a:b], place[a:b]))
        return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, zip(*out, strict=True), kinds, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in sliced(batches, "text"):
            data, offsets = texts_of(batch.column("text"))
            at, text = anchors(data, offsets, length)
            file, row = (batch.column(c).to_numpy()[text] for c in ("row_file", "row_at"))
            for seed, a, b in ((1, at, at + half), (2, at - half, at)):
                whole = (a >= offsets[text]) & (b <= offsets[text + 1])
                prints = hashed(data, a[whole], b[whole], seed)
                parts.append((prints, file[whole], row[whole], (at - offsets[text])[whole]))
            held += batch.column("text").nbytes
            if held >= FLUSH and sum(len(p[0]) for p in parts):
                yield flush(parts)
                parts, held = [], 0
        if sum(len(p[0]) for p in parts):
            yield flush(parts)

    return run


def _repeating(group: pa.Table) -> pa.Table:
    """Anchors of one range of fingerprints that repeat, as rows."""
    known, prints, sent = [], [], []
    for p, *place in zip(*(group.column(c).to_pylist() for c in ("prints", "row_file", "row_at", "places")), strict=True):
        place = np.stack([np.frombuffer(x, np.int64) for x in place], axis=1)
        if p:
            prints.append(np.frombuffer(p, np.uint64))
            sent.append(place)
        else:
            known.append(place)
    if prints:
        values, inverse, counts = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
        known.append(np.concatenate(sent)[counts[inverse] > 1])
    found = np.unique(np.concatenate(known), axis=0)
    return pa.table({n: pa.array(found[:, k]) for k, n in enumerate(("row_file", "row_at", "place"))})


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """A sorted run as shared lengths, the rests one after the other, and their sizes."""
    shared, rests, last = [], [], b""
    for key in keys:
        n = common(last, key)
        shared.append(n)
        rests.append(key[n:])
        last = key
    return np.array(shared, np.int32), b"".join(rests), np.array([len(x) for x in rests], np.int32)


def decoded(shared: np.ndarray, rests: bytes, sizes: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """Keys of a front-coded run, each with the prefix it shares with the one before."""
    last, at = b"", 0
    for n, size in zip(shared.tolist(), sizes.tolist(), strict=True):
        last = last[:n] + rests[at : at + size]
        at += size
        yield last, n


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Loser tree over sorted runs: ``(run, key, prefix shared with the key before)`` in order.

    A waiting key's known prefix is what it shares with the last key put out. Of two, the one that shares more
    comes first, without a look at the keys; only equal lengths are compared, from that length on.
    """
    n = len(runs)
    keys: list[bytes | None] = [None] * n
    shared = [0] * n
    for k, run in enumerate(runs):
        keys[k] = next(run, (None, 0))[0]
    loser = [-1] * n

    def up(k: int) -> int:
        """Play the new key of a run against the losers on its way; the winner's number."""
        node = (k + n) // 2
        while node:
            other = loser[node]
            if other < 0:
                loser[node] = k
                return -1
            key, held = keys[k], keys[other]
            if held is not None and (key is None or shared[other] > shared[k]):
                loser[node], k = k, other
            elif held is not None and shared[other] == shared[k]:
                same = common(key, held, shared[k])
                if held[same : same + 1] < key[same : same + 1]:
                    loser[node], k = k, other
                shared[loser[node]] = same
            node //= 2
        return k

    winner = -1
    for k in range(n):
        winner = up(k)
    while n and keys[winner] is not None:
        yield winner, keys[winner], shared[winner]
        keys[winner], shared[winner] = next(runs[winner], (None, 0))
        winner = up(winner)


def resolved(keys: list[bytes], shared: list[int], lefts: list[bytes], length: int) -> dict[int, list[tuple[int, int]]]:
    """For sorted suffixes with the bytes before them (backwards): per suffix, ranges ``(a, b)`` of starts, that far before it, of repeated strings."""
    order = sorted(range(len(keys)), key=lefts.__getitem__)
    rank = [0] * len(keys)
    for r, k in enumerate(order):
        rank[k] = r
    found: dict[int, list[tuple[int, int]]] = {}
    owner = list(range(len(keys)))
    sets: list[list[int]] = [[r] for r in rank]

    def root(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    reach = max(map(len, lefts))
    for k in sorted(range(1, len(keys)), key=lambda k: -shared[k]):
        depth = shared[k]
        if depth + reach < length:
            break
        a, b = root(k - 1), root(k)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large = sets[a]
        for r in sets[b]:
            at = bisect_left(large, r)
            for other in large[max(0, at - 1) : at + 1]:
                before = common(lefts[order[r]], lefts[order[other]])
                if before + depth >= length:
                    span = (length - depth, before)
                    found.setdefault(order[r], []).append(span)
                    found.setdefault(order[other], []).append(span)
            large.insert(at, r)
        sets[b] = []
        owner[b] = a
    return found


def joined_spans(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Union of half-open spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _runs(length: int, buckets: int):
    """Sorted, front-coded runs of suffixes at the given places, by the hash of their first bytes."""
    names = ("bucket", "shared", "rests", "sizes", "lefts", "left_sizes", "members", "member_sizes")
    kinds = (pa.int32(), *[pa.binary()] * 7)

    def flush(records: dict[tuple[bytes, bytes], list[tuple[int, int, int]]]) -> Iterator[pa.RecordBatch]:
        dealt: dict[int, list[tuple[bytes, bytes]]] = {}
        grams = np.frombuffer(b"".join(k[0][:GRAM] for k in records), "<u8")
        for key, bucket in zip(records, (mixed(grams) % np.uint64(buckets)).tolist(), strict=True):
            dealt.setdefault(bucket, []).append(key)
        rows = []
        for bucket, keys in dealt.items():
            keys.sort()
            shared, rests, sizes = front_coded([k[0] for k in keys])
            own = [records[k] for k in keys]
            rows.append(
                (
                    bucket,
                    shared.tobytes(),
                    rests,
                    sizes.tobytes(),
                    b"".join(k[1] for k in keys),
                    np.array([len(k[1]) for k in keys], np.int32).tobytes(),
                    np.array([m for x in own for m in x], np.int64).tobytes(),
                    np.array([len(x) for x in own], np.int32).tobytes(),
                )
            )
        yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows, strict=True), kinds, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: dict[tuple[bytes, bytes], list[tuple[int, int, int]]] = {}
        held = 0
        for batch in sliced(batches, "text"):
            for file, row, text, places in zip(*(batch.column(c).to_pylist() for c in ("row_file", "row_at", "text", "places")), strict=True):
                data = text.encode()
                for at in places:
                    key = data[at : at + length], data[max(0, at - length + GRAM) : at][::-1]
                    records.setdefault(key, []).append((file, row, at))
                held += len(places) * 2 * length
                if held >= FLUSH:
                    yield from flush(records)
                    records, held = {}, 0
        if records:
            yield from flush(records)

    return run


def _merge(length: int):
    def spans_of(keys: list[bytes], shared: list[int], lefts: list[bytes], members: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        found = resolved(keys, shared, lefts, length) if len(keys) > 1 else {}
        for k, own in enumerate(members):
            ranges = found.get(k, [])
            # Several places with the same bytes all around: every string there is repeated.
            if len(own) > 1 and len(keys[k]) + len(lefts[k]) >= length:
                ranges = [*ranges, (max(0, length - len(keys[k])), len(lefts[k]))]
            # Starts a to b before the anchor cover the bytes from the first start to the end of the last string.
            for a, b in joined_spans([(length - y, 2 * length - x) for x, y in ranges]):
                for file, row, at in own.tolist():
                    yield file, row, at - length + a, at - length + b

    def run(group: pa.Table) -> pa.Table:
        runs, lefts_of, members_of = [], [], []
        columns = ("shared", "rests", "sizes", "lefts", "left_sizes", "members", "member_sizes")
        for shared, rests, sizes, lefts, left_sizes, members, member_sizes in zip(*(group.column(c).to_pylist() for c in columns), strict=True):
            runs.append(decoded(np.frombuffer(shared, np.int32), rests, np.frombuffer(sizes, np.int32)))
            ends = np.cumsum(np.frombuffer(left_sizes, np.int32)).tolist()
            lefts_of.append(iter([lefts[a:b] for a, b in zip([0, *ends], ends, strict=False)]))
            ends = np.cumsum(np.frombuffer(member_sizes, np.int32))
            members_of.append(iter(np.split(np.frombuffer(members, np.int64).reshape(-1, 3), ends[:-1])))
        out: list[tuple[int, int, int, int]] = []
        held: tuple[list, list, list, list] = ([], [], [], [])
        for which, key, shared in merged(runs):
            if shared < GRAM and held[0]:
                out += spans_of(*held)
                held = ([], [], [], [])
            for values, value in zip(held, (key, shared, next(lefts_of[which]), next(members_of[which])), strict=True):
                values.append(value)
        if held[0]:
            out += spans_of(*held)
        found = np.array(out, np.int64).reshape(-1, 4)
        return pa.table({n: pa.array(found[:, k]) for k, n in enumerate(("row_file", "row_at", "from", "to"))})

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(row_file, row_at, spans)`` of the rows of ``docs`` (``placed``) that have bytes to remove: ``[from, to]`` in bytes, not yet merged."""
    spark = ready(docs.sparkSession)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    prints = keyed(docs, "text").mapInArrow(_fingerprints(length, buckets), "bucket int, prints binary, row_file binary, row_at binary, places binary")
    repeating = written(prints.groupBy("bucket").applyInArrow(_repeating, "row_file long, row_at long, place long"), "anchors")
    places = repeating.groupBy("row_file", "row_at").agg(F.array_sort(F.collect_set("place")).alias("places"))
    runs = keyed(docs, "text").join(places, ["row_file", "row_at"]).mapInArrow(
        _runs(length, buckets),
        "bucket int, shared binary, rests binary, sizes binary, lefts binary, left_sizes binary, members binary, member_sizes binary",
    )
    spans = written(runs.groupBy("bucket").applyInArrow(_merge(length), "row_file long, row_at long, `from` long, `to` long"), "spans")
    return spans.groupBy("row_file", "row_at").agg(F.collect_set(F.array("from", "to")).alias("spans"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            data, spans = (text or "").encode(), joined_spans(spans or [])
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            rows.append((len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        names, kinds = ("n_bytes", "n_removed", "n_spans", "kept_sha256"), (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **{n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)}})


def without_spans(text: str, spans: list[list[int]]) -> str:
    """Take the spans out; a character goes only if all its bytes do."""
    data, out, at = text.encode(), [], 0
    for a, b in joined_spans(spans):
        while a < len(data) and data[a] & 0xC0 == 0x80:
            a += 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append(data[at:a])
            at = b
    return b"".join([*out, data[at:]]).decode()


def with_spans(docs: DataFrame, *columns: str, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` with its spans to remove, NULL where there are none."""
    docs = placed(docs.select(*dict.fromkeys([*columns, "text"])))
    spans = repeated_spans(docs, length)
    return keyed(docs, *columns).join(spans, ["row_file", "row_at"], "left").drop("row_file", "row_at")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
