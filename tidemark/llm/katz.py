"""Operator 8: a Katz backoff model over words, learned and applied where the data lies.

Documents come in packets of neighbouring rows. A packet sends its distinct words and bigrams, with their
training counts, to buckets by their hashes; there counts are added up and stored as tables, and every packet is
told the counts of what it asked for, in the order in which it asked. Words are told their backoff weight as well.
Nothing of the vocabulary goes through the driver or to all tasks: only how many n-grams have each small count.

Counts up to ``LARGE`` are discounted by Good-Turing, as Katz has it, from bigrams seen once on. The words seen and one unknown word share probability 1; so do they after any word:

    P(w | h) = d(c(hw)) c(hw) / c(h)          if hw is in the model
             = a(h) P(w)                      else,   a(h) = (1 - sum P(w | h)) / (1 - sum P(w)) over the w in the model
    P(w)     = d(c(w)) c(w) / N, and the rest of 1 for an unknown word

Where discounting would leave nothing for other words, a share of 1 / (c + 1) is left to them.

NULL and empty texts have the end token alone. Repeated rows are counted and scored each; a NULL ``doc_id`` is
training. Without training documents every token is unknown, with probability 1. An empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import LOWER, PRINTED, hashed, keyed, mixed, placed, ready, runs, sliced, table, texts_of
from tidemark.session import written

LARGE = 5
LEAST = 1
#: Rows of a packet, and ways that the bigrams of one word are dealt out, as a word can hold a third of them.
PACKET, SALTS = 4096, 8
#: Tokens that a packet asks for at once: it asks in stretches of so many, or of one text.
STRETCH = 2_000_000
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)

WORD, ASKED, BIGRAM, TOLD, SMALL = range(5)


def pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(h ^ mixed(w + np.uint64(0x9E3779B97F4A7C15)))


def bucket_of(word: np.ndarray, buckets: int) -> np.ndarray:
    return ((word >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def bucket_column(word: str, buckets: int) -> Column:
    return (F.shiftrightunsigned(word, 33) % buckets).cast("int")


def tokens_of(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by the end token; the token before each; the first token of each text."""
    data, offsets = texts_of(column)
    data = LOWER[data]
    starts, ends, first = runs(PRINTED[data[: offsets[-1]]], offsets)
    n = len(offsets) - 1
    at = first[:-1] + np.arange(n)
    tokens = np.full(len(starts) + n, END)
    words = np.ones(len(tokens), bool)
    words[first[1:] + np.arange(n)] = False
    tokens[words] = hashed(data, starts, ends)
    before = np.concatenate([[START], tokens[:-1]]).astype(np.uint64)
    before[at] = START
    return tokens, before, np.append(at, len(tokens))


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, so that compression finds the equal ones."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def numbers(x: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def rising(x: np.ndarray) -> bytes:
    return planes(np.diff(x, prepend=np.uint64(0)).astype("<u8"))


def risen(x: bytes) -> np.ndarray:
    return np.cumsum(numbers(x, "<u8"))


@dataclass
class Asked:
    """The distinct words and bigrams of a stretch of texts, in an order that their bytes alone decide."""

    words: np.ndarray
    codes: np.ndarray  # of the tokens, in words
    start: int  # the code of the start
    distinct: np.ndarray  # bigrams, as the codes of two words
    grams: np.ndarray  # of the tokens, in distinct
    word_deal: tuple[np.ndarray, np.ndarray]  # order by bucket, and where each bucket begins
    gram_deal: tuple[np.ndarray, np.ndarray]

    def pairs(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first and second words of bigrams."""
        own = self.distinct[which]
        return self.words[(own >> np.uint64(32)).astype(np.int64)], self.words[(own & np.uint64(0xFFFFFFFF)).astype(np.int64)]

    def before(self) -> np.ndarray:
        """The code of the word before each token."""
        return (self.distinct[self.grams] >> np.uint64(32)).astype(np.int64)


def asked_by(tokens: np.ndarray, before: np.ndarray, buckets: int) -> Asked:
    words, codes = np.unique(np.concatenate([tokens, [START]]), return_inverse=True)
    codes, start = codes[:-1], int(codes[-1])
    # The token before is the one before it in the stretch, or the start.
    codes_before = np.where(before == START, start, np.concatenate([[start], codes[:-1]]))
    grams = (codes_before.astype(np.uint64) << np.uint64(32)) | codes.astype(np.uint64)
    distinct, which = np.unique(grams, return_inverse=True)

    def dealt(deal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(deal, kind="stable")
        return order, np.searchsorted(deal[order], np.arange(buckets + 1))

    out = Asked(words, codes, start, distinct, which, dealt(bucket_of(words, buckets)), (codes, codes))
    h, w = out.pairs(np.arange(len(distinct)))
    out.gram_deal = dealt(bucket_of(mixed(h + (w % np.uint64(SALTS))), buckets))
    return out


SENT = "kind int, bucket int, packet long, row_from long, row_to long, a binary, b binary, c binary, d binary"


def _sent(buckets: int):
    """What each packet sends: its words, and its bigrams by the hash of the first word and a salt."""

    def flush(packet: int, rows_: list[np.ndarray], parts: list) -> pa.RecordBatch:
        tokens, before, training = (np.concatenate(x) for x in zip(*parts, strict=True))
        own = asked_by(tokens, before, buckets)
        counts = np.bincount(own.codes[training], minlength=len(own.words))
        counts[own.start] = int(((before == START) & training).sum())
        times = np.bincount(own.grams[training], minlength=len(own.distinct))
        head, rows = (packet, int(rows_[0][0]), int(rows_[-1][-1])), []
        order, cuts = own.word_deal
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            some = order[cuts[k] : cuts[k + 1]]
            rows.append((ASKED, k, *head, rising(own.words[some]), planes(counts[some].astype("<u4")), b"", b""))
        order, cuts = own.gram_deal
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            some = order[cuts[k] : cuts[k + 1]]
            h, w = own.pairs(some)
            heads, sizes = np.unique(h, return_counts=True)
            # Second words by their numbers in a list of the different ones, which come again and again.
            seconds, which = np.unique(w, return_inverse=True)
            told = np.concatenate([[len(seconds)], which]).astype("<u4")
            rows.append((TOLD, k, *head, rising(heads), planes(sizes.astype("<u4")), planes(told) + rising(seconds), planes(times[some].astype("<u4"))))
        kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 4)
        names = ("kind", "bucket", "packet", "row_from", "row_to", "a", "b", "c", "d")
        return pa.RecordBatch.from_pydict({n: pa.array(x, t) for n, x, t in zip(names, zip(*rows, strict=True), kinds, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet, rows, parts = None, [], []
        for batch in sliced(batches, "text"):
            packets, at = batch.column("packet").to_numpy(), batch.column("row_at").to_numpy()
            cuts = np.flatnonzero(np.diff(packets)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(packets)], strict=True):
                if parts and (packets[a] != packet or sum(len(p[0]) for p in parts) >= STRETCH):
                    yield flush(packet, rows, parts)
                    rows, parts = [], []
                packet = int(packets[a])
                tokens, before, first = tokens_of(batch.column("text").slice(a, b - a))
                training = ~batch.column("held_out").slice(a, b - a).to_numpy(zero_copy_only=False)
                rows.append(at[a:b])
                parts.append((tokens, before, np.repeat(training, np.diff(first))))
        if parts:
            yield flush(packet, rows, parts)

    return run


def second_words(x: bytes, n: int) -> np.ndarray:
    """The second words of ``n`` bigrams, from the number of different ones, a number for each bigram, and the different ones."""
    told = numbers(x[: 4 * (n + 1)], "<u4")
    return risen(x[4 * (n + 1) :])[told[1:]]


COUNTED = "kind int, bucket int, packet long, row_from long, row_to long, h long, w long, n long, a binary"


def _rows(kind: int, size: int, **columns) -> pa.Table:
    """Rows of the table of counts; columns that are not given are NULL."""
    types = {"kind": pa.int32(), "bucket": pa.int32(), **dict.fromkeys(("packet", "row_from", "row_to", "h", "w", "n"), pa.int64()), "a": pa.binary()}
    given = {"kind": np.full(size, kind, np.int32), **columns}
    return pa.table({c: pa.array(given[c], t) if c in given else pa.nulls(size, t) for c, t in types.items()})


def _counted(group: pa.Table) -> pa.Table:
    """Add up one bucket of one kind: counts as rows, and per packet what it asked for."""
    sent = {c: group.column(c).to_pylist() for c in ("packet", "row_from", "row_to", "a", "b", "c", "d")}
    kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
    asker = {"bucket": np.full(group.num_rows, bucket, np.int32), **{c: sent[c] for c in ("packet", "row_from", "row_to")}}
    if kind == ASKED:
        words = np.concatenate([risen(a) for a in sent["a"]])
        counts = np.concatenate([numbers(b, "<u4") for b in sent["b"]]).astype(np.int64)
        distinct, which = np.unique(words, return_inverse=True)
        total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
        return pa.concat_tables([_rows(WORD, len(distinct), h=distinct.view(np.int64), n=total), _rows(ASKED, group.num_rows, a=sent["a"], **asker)])
    heads = [np.repeat(risen(a), numbers(b, "<u4")) for a, b in zip(sent["a"], sent["b"], strict=True)]
    sizes = [len(x) for x in heads]
    h, w = np.concatenate(heads), np.concatenate([second_words(c, n) for c, n in zip(sent["c"], sizes, strict=True)])
    counts = np.concatenate([numbers(d, "<u4") for d in sent["d"]]).astype(np.int64)
    pairs = pair(h, w)
    order = np.argsort(pairs)
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    total = np.add.reduceat(counts, first)
    small = np.bincount(total[total <= LARGE + 1], minlength=LARGE + 2)
    kept, times = order[first][total >= LEAST], total[total >= LEAST]
    # Bigrams of one first word side by side take less room.
    by_head = np.lexsort((w[kept], h[kept]))
    kept, times = kept[by_head], times[by_head]
    out = [
        _rows(SMALL, LARGE + 1, h=np.arange(1, LARGE + 2), n=small[1:]),
        _rows(BIGRAM, len(kept), h=h[kept].view(np.int64), w=w[kept].view(np.int64), n=times),
    ]
    # Back to the order in which they came, to tell each packet about its own.
    every = np.empty(len(order), np.int64)
    every[order] = np.repeat(np.where(total >= LEAST, total, 0), np.diff(np.append(first, len(order))))
    ends = np.cumsum(sizes).tolist()
    told = [planes(every[e - n : e].astype("<u4")) for e, n in zip(ends, sizes, strict=True)]
    return pa.concat_tables([*out, _rows(TOLD, len(told), a=told, **asker)])


def discounts(small: dict[int, int], least: int = 1) -> list[float]:
    """Katz's discount of each count from 0 to LARGE, by Good-Turing.

    Copied documents can make some count more frequent than a smaller one, and the estimate improper; then the
    counts of counts are first put on a line of their logarithms (simple Good-Turing). Half a count goes where even that fails.
    """
    r = np.arange(1, LARGE + 2)
    n = np.array([small.get(int(k), 0) for k in r], np.float64)
    choices = []
    if n.all():
        slope, level = np.polyfit(np.log(r), np.log(n), 1)
        choices = [n, np.exp(level + slope * np.log(r))]
    for each in choices:
        cut = (LARGE + 1) * each[LARGE] / each[0]
        good = (r[1:] * each[1:] / (r[:-1] * each[:-1]) - cut) / (1 - cut) if cut < 1 else np.zeros(1)
        if ((good > 0) & (good < 1)).all():
            break
    else:
        good = (r[:-1] - 0.5) / r[:-1]
    return [0.0, *(float(d) if k >= least else 0.0 for k, d in enumerate(good, 1))]


def discounted(count: Column, by: list[float]) -> Column:
    """Discounted counts; beyond LARGE they stay as they are."""
    return F.when(count > LARGE, count.cast("double")).otherwise(F.element_at(F.array(*map(F.lit, by)), F.least(count, F.lit(LARGE)).cast("int") + 1) * count)


@dataclass
class Model:
    """``words(word, n, weight, scale)`` and ``bigrams(h, w, n)`` are stored tables; the rest are a few numbers."""

    words: DataFrame
    bigrams: DataFrame
    tokens: int
    types: int
    word_discounts: list[float]
    word_scale: float
    unknown: float
    bigram_discounts: list[float]


def _left_over(mass: Column, count: Column) -> Column:
    """What seen events leave to others, at least a share of ``1 / (count + 1)``."""
    return F.greatest(1 - mass, 1 / (count + 1))


def learned(counts: DataFrame) -> Model:
    """The model of the counts: backoff weights come from a join of bigrams with their second words."""
    words = counts.where(F.col("kind") == WORD).select(F.col("h").alias("word"), "n").where("n > 0")
    real = words.where(F.col("word") != int(START.view(np.int64)))
    whole = real.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = whole["tokens"], whole["types"]
    small = {r["n"]: r["count"] for r in real.where(F.col("n") <= LARGE + 1).groupBy("n").count().collect()}
    word_discounts = discounts(small)
    kept = sum(r * n * (1 - word_discounts[r]) for r, n in small.items() if r <= LARGE)
    unknown = max(kept / tokens, 1 / (tokens + 1)) if tokens else 1.0
    word_scale = (1 - unknown) / (1 - kept / tokens) if tokens else 1.0
    small = counts.where(F.col("kind") == SMALL).groupBy("h").agg(F.sum("n").alias("n"))
    bigram_discounts = discounts({r["h"]: r["n"] for r in small.collect()}, LEAST)
    bigrams = counts.where(F.col("kind") == BIGRAM).select("h", "w", "n")
    p = (discounted(F.col("m"), word_discounts) * F.lit(word_scale / max(1, tokens))).alias("p")
    seconds = bigrams.join(words.select(F.col("word").alias("w"), F.col("n").alias("m")), "w").select("h", "n", p)
    heads = seconds.groupBy("h").agg(F.sum(discounted(F.col("n"), bigram_discounts)).alias("seen"), F.sum("p").alias("lower"))
    joined = words.join(heads.withColumnRenamed("h", "word"), "word", "left")
    mass = F.col("seen") / F.col("n")
    left = _left_over(mass, F.col("n"))
    weights = joined.select(
        "word",
        "n",
        F.coalesce(left / (1 - F.col("lower")), F.lit(1.0)).alias("weight"),
        F.coalesce((1 - left) / mass, F.lit(1.0)).alias("scale"),
    )
    return Model(written(weights, "katz-words"), bigrams, tokens, types, word_discounts, word_scale, unknown, bigram_discounts)


def _answers(asked: pa.Table, words: pa.Table) -> pa.Table:
    """Per packet of one bucket: the training counts of its words, and which have a weight and a scale other than 1."""
    known = words.column("word").to_numpy().view(np.uint64) if words.num_rows else np.zeros(0, np.uint64)
    order = np.argsort(known)
    known = np.append(known[order], np.uint64(0))
    n, weight, scale = (np.append(words.column(c).to_numpy()[order], v) if words.num_rows else np.array([v]) for c, v in (("n", 0), ("weight", 1.0), ("scale", 1.0)))
    out = []
    for a in asked.column("a").to_pylist():
        own = risen(a)
        at = np.searchsorted(known[:-1], own)
        at = np.where(known[at] == own, at, len(known) - 1) if len(known) > 1 else np.zeros(len(own), np.int64)
        special = np.flatnonzero((weight[at] != 1) | (scale[at] != 1))
        out.append((planes(n[at].astype("<u8")), planes(special.astype("<u4")), planes(weight[at][special].astype("<f8")), planes(scale[at][special].astype("<f8"))))
    columns = list(zip(*out, strict=True)) or [()] * 4
    answers = {n: pa.array(c, pa.binary()) for n, c in zip("abcd", columns, strict=True)}
    return pa.table({**{c: asked.column(c) for c in ("bucket", "packet", "row_from", "row_to")}, **answers})


def _scores(buckets: int, tokens: int, types: int, by_word: list[float], word_scale: float, unknown: float, by_pair: list[float]):
    def discount(counts: np.ndarray, by: list[float]) -> np.ndarray:
        return np.where(counts > LARGE, counts, np.array(by)[np.minimum(counts, LARGE).astype(np.int64)] * counts)

    def score(batches: list[pa.RecordBatch], told: dict[tuple[int, int], tuple]) -> Iterator[pa.RecordBatch]:
        parts = [tokens_of(b.column("text")) for b in batches]
        own = asked_by(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), buckets)
        n, weight, scale = np.zeros(len(own.words), np.int64), np.ones(len(own.words)), np.ones(len(own.words))
        both = np.zeros(len(own.distinct), np.int64)
        for (kind, bucket), (a, b, c, d) in told.items():
            order, cuts = own.word_deal if kind == ASKED else own.gram_deal
            some = order[cuts[bucket] : cuts[bucket + 1]]
            if kind == TOLD:
                both[some] = numbers(a, "<u4")
            else:
                n[some] = numbers(a, "<u8")
                special = some[numbers(b, "<u4").astype(np.int64)]
                weight[special], scale[special] = numbers(c, "<f8"), numbers(d, "<f8")
        before = own.before()
        lower = np.where(n > 0, discount(n, by_word) * (word_scale / max(1, tokens)), unknown)[own.codes]
        seen = both[own.grams]
        higher = discount(seen, by_pair) * scale[before] / np.maximum(1, n[before])
        p = np.log10(np.where(seen >= LEAST, higher, weight[before] * lower))
        base = np.log10((n + 0.5) / (tokens + 0.5 * (types + 1)))[own.codes]
        known = (n > 0).astype(np.int64)[own.codes]
        at = 0
        for batch, (own_tokens, _, first) in zip(batches, parts, strict=True):
            starts, end = first[:-1] + at, at + len(own_tokens)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "n_tokens": pa.array(np.diff(first)),
                    "n_known": pa.array(np.add.reduceat(known[:end], starts)),
                    "train_tokens": pa.array(np.full(batch.num_rows, tokens)),
                    "base_score": pa.array(np.add.reduceat(base[:end], starts)),
                    "score": pa.array(np.add.reduceat(p[:end], starts)),
                }
            )
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by packet, and within it by stretch: what the rows that asked together are told, then their documents.
        packet, told, held, upto = None, {}, [], -1
        for batch in sliced(batches, "text"):
            kinds, packets, rows = (batch.column(c).to_numpy() for c in ("kind", "packet", "row_from"))
            cuts = np.flatnonzero((np.diff(kinds) != 0) | (np.diff(packets) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)], strict=True):
                if packets[a] != packet:
                    if held:
                        yield from score(held, told[upto])
                    packet, told, held, upto = packets[a], {}, [], -1
                if kinds[a] != SMALL:
                    if held:
                        yield from score(held, told[upto])
                        told, held, upto = {}, [], -1
                    some = batch.slice(a, b - a)
                    for to, kind, bucket, *blobs in zip(*(some.column(c).to_pylist() for c in ("row_to", "kind", "bucket", *"abcd")), strict=True):
                        told.setdefault(to, {})[kind, bucket] = blobs
                    continue
                while a < b:
                    # Rows that asked together end with the first row_to that is not before them.
                    if held and rows[a] > upto:
                        yield from score(held, told[upto])
                        held = []
                    upto = min(to for to in told if to >= rows[a])
                    end = a + int(np.searchsorted(rows[a:b], upto, side="right"))
                    held.append(batch.slice(a, end - a))
                    a = end
        if held:
            yield from score(held, told[upto])

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and score every one."""
    spark = ready(docs.sparkSession)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    packet = F.xxhash64("row_file", F.expr(f"row_at div {PACKET}")).alias("packet")
    rows = keyed(placed(docs.select("doc_id", "text")), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", "text", held_out.alias("held_out"), packet, "row_at")
    sent = rows.mapInArrow(_sent(buckets), SENT)
    counts = written(sent.groupBy("kind", "bucket").applyInArrow(_counted, COUNTED), "katz-counts")
    model = learned(counts)
    asker = ("bucket", "packet", "row_from", "row_to")
    asked = counts.where(F.col("kind") == ASKED).select(*asker, "a")
    words = model.words.withColumn("bucket", bucket_column("word", buckets))
    answers = asked.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(
        _answers, "bucket int, packet long, row_from long, row_to long, a binary, b binary, c binary, d binary"
    )
    told = counts.where(F.col("kind") == TOLD).select(*asker, "a", F.lit(TOLD).alias("kind"))
    told = answers.withColumn("kind", F.lit(ASKED)).unionByName(told, allowMissingColumns=True)
    texts = rows.select("packet", F.lit(SMALL).alias("kind"), F.col("row_at").alias("row_from"), "doc_id", "held_out", "text")
    both = told.unionByName(texts, allowMissingColumns=True).repartition("packet").sortWithinPartitions("packet", "row_from", "kind")
    parts = (model.tokens, model.types, model.word_discounts, model.word_scale, model.unknown, model.bigram_discounts)
    return both.mapInArrow(_scores(buckets, *parts), SCORED)


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
