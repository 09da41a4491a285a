"""The parts of the operators by themselves."""

import itertools
import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import decontaminate, katz, licenses, packing, partenum, shards, suffixes, token_blocks
from tidemark.llm.common import hashed, runs, texts_of
from tidemark.llm.tokens import encoder


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_encode_like_whole_texts(name, spaced):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", ".", "'s", "don't", "é", "\u00a0", "\u3000", "1", "\x01", " \n", "\u0301", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "İ", "Σ", "日本", "🙂", "\r\n", "\x85"]
    texts = [None, "", " ", "  "] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    ids, counts = encoder(public_tokenizers.path(name), spaced).encode(pa.array(texts))
    plain, at = brute.encoder(name), 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == plain(text)
        at += n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), max_size=1500))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    payload = token_blocks.pack(ids)
    assert token_blocks.unpack(payload).tolist() == values
    if len(values) > 600:
        assert token_blocks.unpack(payload, 1, 2).tolist() == values[256:512]


def test_blocks_reject_other_bytes():
    with pytest.raises(ValueError):
        token_blocks.unpack(b"nothing of the kind")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=40))
def test_bins_hold_every_piece_once(counts):
    (lengths, ranks, sequences, offsets), n = packing.plan_bins(counts, 64)
    filled = {}
    for length, count in counts.items():
        own = np.flatnonzero(lengths == length)
        for rank in range(count):
            row = own[np.searchsorted(ranks[own], rank, side="right") - 1]
            filled.setdefault(int(sequences[row] + rank - ranks[row]), []).append((int(offsets[row]), length))
    assert set(filled) == set(range(n))
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    room: list[int] = []
    for length in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
        at = next((k for k, r in enumerate(room) if r >= length), None)
        if at is None:
            room.append(64 - length)
        else:
            room[at] -= length
    assert n <= 1.05 * len(room) + 1


def test_two_pieces_replace_the_smallest():
    (lengths, ranks, sequences, offsets), n = packing.plan_bins({60: 1, 30: 1, 25: 1, 14: 1}, 100)
    # Greedy takes 60 and 30; 25 and 14 fill the gap of 40 better than 30 does.
    first = sorted(lengths[sequences == sequences[lengths == 60][0]].tolist())
    assert (first, n) == ([14, 25, 60], 2)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([(85, 100), (80, 100), (1, 2)]))
def test_similar_sets_share_a_signature(size, seed, threshold):
    """The guarantee behind the join: sets at the threshold or above it have a signature in common."""
    num, den = threshold
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**64, 3 * size + 10, np.uint64))
    rng.shuffle(pool)
    a, bands = pool[:size], partenum.Bands(num, den)
    for extra in {0, 1, size // 10, size // 5, size // 2, size}:
        for gone in {0, extra, extra // 2}:
            b = np.concatenate([a[gone:], pool[size : size + extra - gone]]) if extra >= gone else a
            both = len(np.intersect1d(a, b))
            if len(b) and den * both >= num * (len(a) + len(b) - both):
                assert np.intersect1d(bands.signatures(np.sort(a)), bands.signatures(np.sort(b))).size


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), max_size=30), max_size=9))
def test_loser_tree_merges_runs_with_their_common_prefixes(rows):
    runs_ = [sorted(r) for r in rows]
    got = list(suffixes.merged([suffixes.decoded(*suffixes.front_coded(r)) for r in runs_]))
    keys = sorted(itertools.chain.from_iterable(rows))
    assert [g[1] for g in got] == keys
    assert [g[2] for g in got[1:]] == [suffixes.common(a, b) for a, b in itertools.pairwise(keys)]


def test_the_loser_tree_never_looks_at_known_prefixes(monkeypatch):
    looked = []
    real = suffixes.common
    monkeypatch.setattr(suffixes, "common", lambda a, b, known=0: looked.append(known) or real(a, b, known))
    prefix = b"p" * 300
    runs_ = [[(prefix + bytes([k, r]), 0 if k == 0 else 300) for k in range(50)] for r in range(4)]
    assert len(list(suffixes.merged([iter(r) for r in runs_]))) == 200
    assert sum(k < 300 for k in looked) <= 4


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6), st.integers(9, 14))
def test_anchored_suffixes_find_exactly_the_repeats(texts, length):
    data, offsets = texts_of(pa.array(texts))
    at, text = suffixes.anchors(data, offsets, length)
    records = {}
    for a, t in zip(at.tolist(), text.tolist(), strict=True):
        body, p = texts[t].encode(), a - int(offsets[t])
        key = body[p : p + length], body[max(0, p - length + suffixes.GRAM) : p][::-1]
        records.setdefault(key, []).append((t, 0, p))
    group = [r for r in suffixes._runs(length, 1)(iter([_places(texts, at, text, offsets)]))] if len(at) else []
    masks = [np.zeros(len(t), bool) for t in texts]
    if group:
        spans = suffixes._merge(length)(pa.Table.from_batches(group))
        for t, _, a, b in zip(*(spans.column(c).to_pylist() for c in ("row_file", "row_at", "from", "to")), strict=True):
            masks[t][a:b] = True
    assert [m.tolist() for m in masks] == [m.tolist() for _, m in brute.repeats(texts, length)]


def _places(texts, at, text, offsets):
    places = [[int(a - offsets[t]) for a, t in zip(at, text, strict=True) if t == k] for k in range(len(texts))]
    return pa.RecordBatch.from_pydict({"row_file": list(range(len(texts))), "row_at": [0] * len(texts), "text": texts, "places": pa.array(places, pa.list_(pa.int64()))})


def test_cut_texts_stay_valid():
    text = "aéb日c"
    for a in range(len(text.encode()) + 1):
        for b in range(a, len(text.encode()) + 1):
            left = suffixes.without_spans(text, [[a, b]])
            assert set(left) <= set(text)
            whole = [c for k, c in enumerate(text) if len(text[:k].encode()) >= a and len(text[: k + 1].encode()) <= b]
            assert len(left) == len(text) - len(whole)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.lists(st.lists(st.integers(1, 6), min_size=3, max_size=3), min_size=1, max_size=5))
def test_fm_index_counts_and_locates(text, patterns):
    index = decontaminate.FmIndex(np.array(text, np.int64))
    low, high = index.search(np.array(patterns, np.int64))
    for pattern, a, b in zip(patterns, low.tolist(), high.tolist(), strict=True):
        places = [k for k in range(len(text) - 2) if text[k : k + 3] == pattern]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_benchmark_blocks_give_the_same_result(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    once = {r["doc_id"]: r for r in decontaminate.scanned(docs, benchmark, "doc_id").collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20_000)
    assert len(list(decontaminate._blocks(benchmark))) > 1
    assert {r["doc_id"]: r for r in decontaminate.scanned(docs, benchmark, "doc_id").collect()} == once
    assert any(r["spans"] for r in once.values())


def test_spans_of_words_are_cut():
    assert decontaminate.without_spans("One, two THREE-four five!", [[1, 3], [4, 5]]) == "One, -four !"


def test_katz_probabilities_sum_to_one():
    model = brute.Katz([(k, t) for k, t in enumerate(["a b a b a c", "a b c d", "b a b a", "e f a b", "", "a a a a a a a a"] * 3)])
    for h in ["<s>", *model.words, "never seen"]:
        rest = model.weights.get(h, (1.0, 1.0))[0] * model.unknown
        assert sum(model.p(h, w) for w in model.words) + rest == pytest.approx(1)


def test_good_turing_discounts():
    counts = {1: 1000, 2: 300, 3: 130, 4: 75, 5: 48, 6: 33}
    by = katz.discounts(counts)
    cut = 6 * 33 / 1000
    assert by[2] == pytest.approx((3 * 130 / (2 * 300) - cut) / (1 - cut))
    assert all(0 < d < 1 for d in by[1:])
    assert katz.discounts({}) == [0.0, 0.5, 0.75, pytest.approx(5 / 6), 0.875, 0.9]
    assert katz.discounts(counts, 2)[:2] == [0.0, 0.0]


def test_word_bytes_and_hashes():
    data, offsets = texts_of(pa.array(["ab cd", "", "cd", None, "cd " * 3]))
    starts, ends, first = runs(data[: offsets[-1]] != 32, offsets)
    assert first.tolist() == [0, 2, 2, 3, 3, 6]
    hashes = hashed(data, starts, ends)
    assert len(set(hashes.tolist())) == 2 and (hashes[1:] == hashes[1]).all()


def test_a_slot_map_grows_into_the_new_shard_only(spark, tmp_path):
    loads = {k: (1000 + 37 * k % 211, 3) for k in range(400)}
    placed = shards.assign(loads, 16)
    grown = shards.grow(placed, loads, 16)
    assert {grown[s] for s in placed if grown[s] != placed[s]} == {16}
    totals = [sum(loads[s][0] for s in grown if grown[s] == k) for k in range(17)]
    assert max(totals) - min(totals) < 0.1 * max(totals)
    path = str(tmp_path / "map")
    for version, each in ((1, placed), (2, grown)):
        shards.store(spark, path, version, each, loads)
    for version, each in ((1, placed), (2, grown)):
        assert {r["vslot"]: r["shard"] for r in shards.version_of(spark, path, version).collect()} == each


LICENSE = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software"
    " is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be"
    " included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY"
    " KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nfitness for a particular purpose"
    " and noninfringement.\n"
)


@pytest.mark.parametrize(
    "text, found, unmatched",
    [
        (LICENSE, ["MIT"], 0),
        ("Head\nReleased under the MIT License.\nTail", ["MIT"], 0),
        ("Licensed under the Apache License, Version 2.0. Released under the MIT license.", ["MIT", "Apache-2.0"], 0),
        ("Either version 3 of the license, or (at your option) any later version.", [], 1),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
         " published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.", ["GPL-3.0-or-later"], 0),
        ("A license, in general.", [], 0),
        (None, [], 0),
    ],
)
def test_license_rules(spark, text, found, unmatched):
    row = licenses.recognised(spark.createDataFrame([(text,)], "text string")).first()
    assert (row["licenses"], row["unmatched"]) == (found, unmatched)


def test_every_known_sentence_is_normal_and_anchored():
    for sentence in licenses.SENTENCES:
        assert sentence == " ".join(sentence.split()).lower()
        assert any(a in sentence for a in licenses.ANCHORS), sentence


def test_url_trees_learn_their_labels(spark):
    from tidemark.llm import url_filter

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = url_filter.judged(pages).collect()
    assert len(rows) == pages.count()
    assert {r["verdict"] for r in rows} == {"allow", "block"}
    again = {(r["page_id"], r["verdict"]) for r in url_filter.judged(pages.repartition(7)).collect()}
    assert again == {(r["page_id"], r["verdict"]) for r in rows}


def test_a_url_is_not_described_by_labels_of_its_host(spark):
    """Other labels on one host change the rates of other hosts' rows, and of unlabelled ones, but none of its own labelled rows."""
    from tidemark.llm import url_filter

    def rates(labels):
        urls = [(f"h{k % 5}.example", f"s{k % 2}", labels(k), k % 5 if k % 5 < 4 else 6) for k in range(40)]
        rows = spark.createDataFrame([(k, h, "example", s, "", label, f) for k, (h, s, label, f) in enumerate(urls)], "page_id long, host_two string, host_end string, segment string, ending string, label string, fold int")
        columns = ["page_id", *(f"{x}_rate" for x in url_filter.SUFFIXES)]
        return {r["page_id"]: tuple(r)[1:] for r in url_filter.with_rates(rows).select(*columns).collect()}

    def usual(k):
        return None if k >= 35 else ("block" if k % 2 else "allow")

    before, after = rates(usual), rates(lambda k: "block" if k % 5 == 2 and usual(k) else usual(k))
    assert len(before) == len(after) == 40
    for k in range(40):
        assert (before[k] == after[k]) == (k % 5 == 2 and k < 35)
    # By hand: h0 s0 has 4 labelled rows of its own; segment s0 elsewhere: all allowed, smoothed by the rate of other hosts.
    others = [k for k in range(35) if k % 5 != 0]
    rate = sum(k % 2 for k in others) / len(others)
    n = sum(k % 2 == 0 for k in others)
    assert before[0][url_filter.SUFFIXES.index("segment")] == pytest.approx(20 * rate / (n + 20))
    assert before[0][url_filter.SUFFIXES.index("host_two")] == pytest.approx(rate)


def test_held_out_error_counts_one_fold(spark):
    from tidemark.llm import url_filter

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    found = url_filter.held_out_error(pages)
    lexical = url_filter.lexical(pages).where("label IS NOT NULL")
    aside = lexical.where(lexical["fold"] == url_filter.FOLDS - 1)
    for counts in found.values():
        assert counts["urls"] == aside.count() > 0 and counts["to_block"] == aside.where("label = 'block'").count()
        assert 0 <= counts["errors"] <= counts["urls"]
