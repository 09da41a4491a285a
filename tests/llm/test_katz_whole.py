"""Operator 8 against a model that keeps every bigram, also those seen once; no part of it comes from katz.py."""

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from tidemark.llm import katz

KIND = "doc_id long, text string"


def good_turing(times):
    """Discounts of the counts 1 to 5: Katz's, else with the counts of counts on a line of their logarithms, else half a count."""
    n = [times.get(r, 0) for r in range(1, 7)]
    lines = []
    if all(n):
        slope, level = np.polyfit(np.log(range(1, 7)), np.log(n), 1)
        lines = [n, [math.exp(level + slope * math.log(r)) for r in range(1, 7)]]
    for own in lines:
        cut = 6 * own[5] / own[0]
        if cut < 1:
            out = {r: ((r + 1) * own[r] / (r * own[r - 1]) - cut) / (1 - cut) for r in range(1, 6)}
            if all(0 < d < 1 for d in out.values()):
                return out
    return {r: (r - 0.5) / r for r in range(1, 6)}


def scores(rows):
    docs = [(d, [*brute.PRINTED.findall(brute.lower(t)), "</s>"]) for d, t in rows]
    training = [w for d, w in docs if zlib.crc32(str(d).encode()) % 5 != 1]
    words = Counter(w for own in training for w in own)
    pairs = Counter(p for own in training for p in zip(["<s>", *own], own, strict=False))
    heads = Counter(h for own in training for h in ["<s>", *own[:-1]])
    by_word, by_pair = good_turing(Counter(words.values())), good_turing(Counter(pairs.values()))
    n = sum(words.values())
    freed = sum(c * (1 - by_word.get(c, 1)) for c in words.values()) / n
    unknown = max(freed, 1 / (n + 1))

    def word(w):
        return words[w] * by_word.get(words[w], 1) / n * (1 - unknown) / (1 - freed) if words[w] else unknown

    mass, lower = Counter(), Counter()
    for (h, w), c in pairs.items():
        mass[h] += c * by_pair.get(c, 1) / heads[h]
        lower[h] += word(w)

    def p(h, w):
        left = max(1 - mass[h], 1 / (heads[h] + 1)) if h in mass else 1.0
        if pairs[h, w]:
            return pairs[h, w] * by_pair.get(pairs[h, w], 1) / heads[h] * (1 - left) / mass[h]
        return left / (1 - lower[h]) * word(w)

    return {d: sum(math.log10(p(h, w)) for h, w in zip(["<s>", *own], own, strict=False)) for d, own in docs}, pairs


def given_rows():
    import duckdb

    return duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()


def test_bigrams_seen_once_are_scored(spark):
    rows = given_rows()
    want, pairs = scores(rows)
    assert sum(c == 1 for c in pairs.values()) > len(pairs) / 2
    got = {r["doc_id"]: r["score"] for r in katz.op8_katz(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == want.keys()
    assert all(got[d] == pytest.approx(want[d], rel=1e-6, abs=1e-5) for d in want)


def test_bigrams_seen_once_are_stored(spark, monkeypatch):
    models, learned = [], katz.learned
    monkeypatch.setattr(katz, "learned", lambda counts: models.append(learned(counts)) or models[-1])
    katz.op8_katz(spark, "/root/testdata/sf0.001").collect()
    _, pairs = scores(given_rows())
    assert Counter(r["n"] for r in models[0].bigrams.collect()) == Counter(pairs.values())
    assert 0 < models[0].bigram_discounts[1] < 1
