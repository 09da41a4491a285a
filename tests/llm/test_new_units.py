"""Parts of operators 11 to 13 by themselves."""

import random
from itertools import product
from math import comb, prod

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import token_counts, whitening


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def counts(texts):
    return token_counts.merges(public_tokenizers.path("byte_bpe_50k.json")).counts(texts).tolist()


def test_every_character_is_cut_like_the_library(tokenizer):
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1{chr(c)}" for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(texts), 100_000):
        some = texts[at : at + 100_000]
        assert counts(some) == [len(x.ids) for x in tokenizer.encode_batch_fast(some, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab \n\t's<|endoftext|>1é日　"), st.characters(exclude_categories=["Cs"])), max_size=80), max_size=20))
def test_counts_are_the_librarys(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert counts(texts) == [len(own.encode(t, add_special_tokens=False).ids) for t in texts]


def test_long_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECES", 50)
    own = random.Random(1)
    texts = ["x" * 30_000, "ab" * 5001, " " * 999 + "x", "<|endoftext|>a<|endoftext|><|endoftext|> b <|endoftext", "".join(own.choice("abcdefgh") for _ in range(50_000)), "the cat's " * 3000]
    assert counts(texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Merges(public_tokenizers.path("word_bpe_49k.json"))


def polynomial(matrix):
    d, trace = len(matrix), sum(matrix[k][k] for k in range(len(matrix)))
    primes = whitening.primes_beyond(max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1)))
    whole, out = prod(primes), [0] * (d + 1)
    for p in primes:
        unit = whole // p * pow(whole // p, -1, p)
        out = [have + unit * r for have, r in zip(out, whitening.polynomial_modulo(matrix, p), strict=True)]
    return [v % whole if k % 2 == 0 else -(-v % whole) for k, v in enumerate(out)]


def gram(rows):
    a = np.array(rows, object)
    return [[int(v) for v in row] for row in a.T @ a]


def test_polynomial_of_known_roots():
    blocks = [[2, 1, 0, 0, 0], [1, 2, 0, 0, 0], [0, 0, 3, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 1]]
    assert polynomial(blocks) == [1, -8, 22, -24, 9, 0]
    found = whitening.Roots(polynomial(blocks)).largest(9)
    assert [(round((low + high) / 2 / 2**bits, 9), n) for low, high, bits, n in found] == [(3, 2), (1, 2)]
    for low, high, bits, n in found:
        vectors = np.array(whitening.null_vectors(blocks, low + high, bits + 1, n))
        assert np.allclose(vectors @ vectors.T, np.eye(n), atol=1e-14)
        assert np.allclose(np.array(blocks) @ vectors.T, (low + high) / 2 / 2**bits * vectors.T, atol=1e-13)


def test_roots_that_doubles_cannot_tell_apart():
    big = 10**18
    found = whitening.Roots(polynomial([[big, 0, 0], [0, big + 1, 0], [0, 0, 5]])).largest(2)
    assert [((low + high + (1 << bits)) >> bits + 1) for low, high, bits, _ in found] == [big + 1, big]
    first = whitening.null_vectors([[big, 0, 0], [0, big + 1, 0], [0, 0, 5]], found[0][0] + found[0][1], found[0][2] + 1, 1)[0]
    assert abs(first[1]) == pytest.approx(1, abs=1e-15) and abs(first[0]) < 1e-15


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 7), st.integers(1, 9), st.integers(0, 10**6))
def test_roots_and_vectors_are_those_of_the_matrix(d, n, seed):
    own = random.Random(seed)
    matrix = gram([[own.randint(-9, 9) for _ in range(d)] for _ in range(n)])
    if not any(matrix[k][k] for k in range(d)):
        return
    values = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    found = whitening.Roots(polynomial(matrix)).largest(d)
    got = [(low + high) / 2 / 2**bits for low, high, bits, times in found for _ in range(times)]
    assert got == pytest.approx([v for v in values if v > 1e-9 * values[0]], rel=1e-8)
    for low, high, bits, times in found:
        vectors = np.array(whitening.null_vectors(matrix, low + high, bits + 1, times))
        assert np.allclose(np.array(matrix, float) @ vectors.T, (low + high) / 2 / 2**bits * vectors.T, atol=1e-9 * values[0])


@pytest.mark.parametrize("size", [3, 1 << 19, 1 << 21, (1 << 62) - 1])
def test_products_are_exact(size):
    own = random.Random(size)
    rows = [[own.randint(-size, size) for _ in range(4)] for _ in range(50)] + [[-size, size, 0, -1]]
    want = [[sum(r[i] * r[j] for r in rows) for j in range(4)] for i in range(4)]
    assert whitening._products(np.array(rows, np.int64)).tolist() == want


def test_sums_meet_across_tasks(spark):
    size = (1 << 61) - 1
    rows = [[a * size, b * 3, c] for a, b, c in product((-1, 0, 1), repeat=3)]
    n, sums, products = whitening.exact_sums(spark.createDataFrame([(r,) for r in rows], "y array<long>").repartition(4))
    assert (n, sums) == (27, [0, 0, 0])
    assert products == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]


def test_vectors_without_variance_or_of_different_lengths(spark):
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, None)], "vec_id long, embedding array<float>")
    assert whitening.whitened(same, "embedding", "vec_id").collect() == []
    assert whitening.whitened(same.selectExpr("vec_id", "slice(embedding, 1, 0) AS embedding"), "embedding", "vec_id").collect() == []
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whitened(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5])], "vec_id long, embedding array<double>"), "embedding", "vec_id")


def test_large_entries(spark):
    huge = float(1 << 55)
    rows = [(1, [huge, 1.0]), (2, [-huge, 2.0]), (3, [0.0, 4.0]), (4, [1e300, 0.0])]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding", "vec_id").collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and {r.component for r in found} == {1, 2}
    assert {r.deviation for r in found if r.vec_id != 3} == {None} and found[0].identity_error < 1e-4
