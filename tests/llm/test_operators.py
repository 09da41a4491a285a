"""Each operator's query against brute force: the given tables, awkward rows, and empty tables."""

import random
from collections import Counter, defaultdict

import brute
import duckdb
import pytest
from pyspark.sql import types as T

from tidemark.llm import prefix_trie
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row_at string, node int, spans string, packet long"
BENCHMARK = "item_id long, text string"
CONVERSATIONS = "conv_id long, turn long, role string, text string, head string, ids int, n long, words string"
EMBEDDINGS = "vec_id long, embedding array<float>, label int, y string, component int, deviation long"
PAGES = "page_id long, url string, html string, host string, label int"

random.seed(7)
VOCABULARY = ["".join(random.choice("abcdeé") for _ in range(random.randint(1, 6))) for _ in range(400)]


def prose(n, seed):
    own = random.Random(seed)
    return " ".join(own.choice(VOCABULARY) for _ in range(n)).capitalize() + "."


def awkward_texts():
    passage, near = prose(150, 1), prose(120, 2).split()
    texts = [None, None, "", " ", "\n\n", "word", "one two", "One  TWO", "three little words", "a\x00b \x01 c", "<|endoftext|> tail"]
    texts += [prose(90, k) for k in range(10, 30)]
    texts += [prose(90, 10), prose(90, 10), prose(90, 11).upper()]
    texts += [prose(30, k) + " " + passage + "\n" + prose(30, k + 1) for k in range(40, 46)]
    texts += [" ".join(w if i != k else "changed" for i, w in enumerate(near)) for k in range(10, 100, 11)]
    texts += ["spam " * 300, "x" * 5000, "é" * 900 + "z", prose(6000, 5), "日本語のテキスト。" * 80, "line\nline\nline two\nline", "tab\tand\r\nnew  line   end "]
    texts += [f"Shared header line of this host\n{prose(4, k)}" for k in range(200, 270)]
    return texts


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """A folder of tables with NULLs, repeated rows and keys, and columns whose names the operators use themselves."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    rows = [(k, t, "en", "host" if k > 60 else (None, "", "a")[k % 3], 1, "x", 1, "y", 2) for k, t in enumerate(awkward_texts())]
    rows += [rows[12], rows[12], (12, prose(40, 99), None, None, None, None, None, None, None), (None, prose(50, 98), "en", "a", 1, "x", 1, "y", 2)]
    rows += [(None, None, None, None, None, None, None, None, None), (None, prose(90, 10), "en", "a", 1, "x", 1, "y", 2)]
    words = prose(90, 12).split()
    items = [(1, " ".join(words[3:30])), (2, "three little words"), (3, None), (4, ""), (None, prose(90, 13)), (5, prose(40, 14)), (5, prose(40, 15)), (10, " ".join(words[5:25]))]
    pages = [(k, u, "", "h", 1) for k, u in enumerate(URLS)] + [(None, None, None, None, None), (0, URLS[0], "", "h", 1)]
    spark.createDataFrame(awkward_turns(), CONVERSATIONS).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame(awkward_vectors(), EMBEDDINGS).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame(rows, DOCUMENTS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, BENCHMARK).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(pages, PAGES).write.parquet(f"{folder}/pages.parquet")
    return folder


def awkward_turns():
    """Copies, shared beginnings, a missing origin, negative and NULL keys, NULL and equal turns, empty and long texts."""
    rows = []
    for c in (*range(-45, 130), 1000, 4097, 4103, 9000, None):
        kind = 0 if c is None else abs(c) % 6
        first = ["Be kind", "one two three"][: 1 + kind % 2]
        rest = [prose(5, 7), prose(6, kind)] if kind < 4 else [prose(3, 1000 + (c or 0)), "", None, "é " * 3000]
        rows += [(c, k, ("system", "user", None)[k % 3], t) for k, t in enumerate([*first, *rest])]
    rows += [(7, None, "user", "comes first"), (7, 1, "user", "an equal turn"), (8, 0, None, None), (8, 0, None, None), (None, None, None, None)]
    rows += [(c, 0, "user", "alone") for c in (5001, 5002, 5003, 5004, 5005)]
    return [(*r, "x", 1, 2, "y") for r in rows if r[0] is None or r[0] not in (20, 40)]


def awkward_vectors():
    own = random.Random(3)
    vectors = [[own.gauss(0, 1) * (k + 1) for k in range(20)] for _ in range(60)]
    for v in vectors:
        v[4] = 0.25  # no variance
    vectors += [vectors[0]] * 40 + [vectors[1]] * 3 + [None, [None, *vectors[2][1:]], [float("nan"), *vectors[2][1:]], [float("inf"), *vectors[2][1:]]]
    rows = [(k if k % 7 else None, v, 1, "x", 2, 3) for k, v in enumerate(vectors)]
    return [*rows, rows[3], rows[3], (3, vectors[9], None, None, None, None)]


URLS = [
    "https://a.ORG/x", "http://example.org/es/1?q=1", "http://www.example.org/en/15", "http://example.org/en/2", "https://notexample.org/es/",
    "http://shop.com/fr/1", "http://shop.com/de/1#a", "http://shop.com", "http://org", "http://org/", "no scheme", "", "x://y://z/fr/",
    "http://com/fr/?x", "http://a.com/FR/1", "http://b.net/de/1?a=1&b=2", "http://" + "l" * 3000 + ".net/" + "p" * 3000, "http://ü.org/é",
    *(f"http://s{k}.com/{'fr' if k % 2 else 'de'}/{k}" for k in range(30)),
]


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", DOCUMENTS), ("benchmark", BENCHMARK), ("pages", PAGES), ("conversations", CONVERSATIONS), ("embeddings", EMBEDDINGS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(params=["given", "awkward"])
def folder(request):
    return SF if request.param == "given" else request.getfixturevalue("awkward")


def table(folder, columns, name="documents"):
    path = f"{folder}/{name}.parquet" + ("" if folder.startswith("/root/testdata") else "/*.parquet")
    return duckdb.sql(f"SELECT {columns} FROM '{path}'").fetchall()


def result(spark, name, folder, *columns):
    return [tuple(r[c] for c in columns) for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_op1_ids_are_read_back_in_order(spark, folder):
    encode = brute.encoder("byte_bpe_50k.json")
    documents = table(folder, "doc_id, text")
    got = result(spark, "op1_token_blocks", folder, "doc_id", "n_tokens", "ids_crc32")
    expected = [(d, len(ids), brute.crc(ids)) for d, ids in ((d, [*encode(t), 2]) for d, t in documents)]
    assert Counter(got) == Counter(expected)
    rows = sorted(result(spark, "op1_token_blocks", folder, "start", "n_tokens", "doc_id"))
    at, keys = 0, []
    for start, n, doc_id in rows:
        assert start == at
        at += n
        keys.append((doc_id is not None, doc_id))
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))


def test_op2_components(spark, folder):
    got = result(spark, "op2_partenum", folder, "doc_id", "n_shingles", "component_id")
    assert Counter(got) == Counter(brute.components(table(folder, "doc_id, text")))


def test_op3_bytes_are_even_and_slots_gapless(spark, folder):
    documents = table(folder, "doc_id, text")
    got = result(spark, "op3_virtual_slots", folder, "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert Counter(g[:3] for g in got) == Counter((d, len((t or "").encode()) + 1, brute.zlib.crc32((t or "").encode())) for d, t in documents)
    assert {g[3] for g in got} == {"bytes"} and {g[6] for g in got} == {None}
    slots, sizes = defaultdict(list), Counter({k: 0 for k in range(16)})
    for _, size, _, _, shard, slot, _ in got:
        slots[shard].append(slot)
        sizes[shard] += size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(16))
    assert max(sizes.values()) - min(sizes.values()) <= max(g[1] for g in got)


def test_op4_removes_repeated_bytes(spark, folder):
    got = result(spark, "op4_suffix_dedup", folder, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(got) == Counter(brute.deduplicated(table(folder, "doc_id, text")))


def test_op5_counts_and_verdicts(spark, folder):
    rows = table(folder, "doc_id, text, source")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = result(spark, "op5_line_frequency", folder, *columns)
    expected = [(*b, k) for b, k in zip(brute.base_quality([r[:2] for r in rows]), brute.kept_by_lines(rows), strict=True)]
    assert Counter(got) == Counter(expected)


def test_op5_rejects_depleted_documents_only(spark, awkward):
    """Sixty-five documents of one host share a line and have little else."""
    got = dict(result(spark, "op5_line_frequency", awkward, "doc_id", "kept"))
    short = [k for k, t in enumerate(awkward_texts()) if k > 60 and t and t.startswith("Shared header")]
    assert len(short) > 50 and not any(got[k] for k in short)
    assert got[13] and got[14]


def test_op6_equals_sql(spark, folder):
    from tidemark.llm.queries import ORACLES

    database = duckdb.connect()
    path = f"{folder}/documents.parquet" + ("" if folder == SF else "/*.parquet")
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    theirs = database.sql(ORACLES["op6_license_sentences"])
    assert Counter(result(spark, "op6_license_sentences", folder, *theirs.columns)) == Counter(theirs.fetchall())


def test_op7_finds_benchmark_phrases(spark, folder):
    got = result(spark, "op7_fm_index", folder, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    expected = list(brute.leaks(table(folder, "doc_id, text"), table(folder, "item_id, text", "benchmark")))
    assert Counter(got) == Counter(expected)
    assert any(e[5] for e in expected)


def test_op8_scores(spark, folder):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted(result(spark, "op8_katz", folder, *columns), key=repr)
    expected = sorted(brute.Katz(table(folder, "doc_id, text")).rows(), key=repr)
    assert Counter(g[:5] for g in got) == Counter(e[:5] for e in expected)
    for k in (5, 6):
        pairs = zip(sorted((g[0] or -1, g[2], g[k]) for g in got), sorted((e[0] or -1, e[2], e[k]) for e in expected), strict=True)
        assert all(a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-6, abs=1e-5) for a, b in pairs)


def test_op8_packets_do_not_matter(spark, monkeypatch):
    from tidemark.llm import katz

    columns = ("doc_id", "n_known", "score")
    whole = {r[0]: r for r in result(spark, "op8_katz", SF, *columns)}
    monkeypatch.setattr(katz, "PACKET", 3)
    for doc_id, known, score in result(spark, "op8_katz", SF, *columns):
        assert (known, score) == (whole[doc_id][1], pytest.approx(whole[doc_id][2]))


def test_op8_model_beats_the_base_on_held_out_documents(spark):
    rows = result(spark, "op8_katz", SF, "held_out", "base_score", "score")
    assert sum(r[2] for r in rows if r[0]) > sum(r[1] for r in rows if r[0])


def test_op9_packs_everything(spark, folder):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    got = result(spark, "op9_best_two_fit", folder, *columns)
    assert Counter(g[:5] for g in got) == Counter(brute.pieces(table(folder, "doc_id, text")))
    sequences = defaultdict(list)
    for g in got:
        sequences[g[5]].append((g[6], g[3]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(g[3] for g in got) // 2048)
    assert len(sequences) <= 1.02 * least + 1


def test_op10_rules_and_verdicts(spark, folder):
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    got = {}
    for page, host, path, rule, verdict in result(spark, "op10_url_filter", folder, "page_id", "host", "path", "rule", "verdict"):
        got.setdefault(page, set()).add((host, path, rule, verdict))
    pages = table(folder, "page_id, url", "pages")
    assert len(got) == len({p for p, _ in pages})
    for page, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest.split("#")[0].split("?")[0].split("/")[0]
        path = rest[len(host) :].split("#")[0].split("?")[0]
        host = brute.lower(host)
        fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(fits, key=len, default=None)
        ((got_host, got_path, got_rule, verdict),) = got[page]
        assert (got_host, got_path, got_rule) == (host, path, rule)
        assert verdict == rules[rule] if rule else verdict in ("allow", "block")


def test_results_have_a_schema_without_rows(spark, empty):
    kinds = {f.name: f.dataType for f in QUERIES["op3_virtual_slots"](spark, empty).schema}
    assert kinds["grown_shard"] == T.IntegerType() and kinds["slot"] == T.LongType()


def test_op11_nodes(spark, folder):
    got = result(spark, "op11_burst_trie", folder, *prefix_trie.NODE)
    assert Counter(got) == Counter(brute.prefix_nodes(table(folder, "conv_id, turn, role, text", "conversations")))


@pytest.mark.parametrize("limit", [1, 4, 30])
def test_op11_bursting_does_not_matter(spark, awkward, limit):
    conversations = prefix_trie.rebuilt(prefix_trie.in_turns(prefix_trie.table(spark, awkward, "conversations")))
    got = [tuple(r) for r in prefix_trie.trie(conversations, limit).collect()]
    assert Counter(got) == Counter(brute.prefix_nodes(table(awkward, "conv_id, turn, role, text", "conversations")))


def test_op12_counts_tokens(spark, folder):
    got = result(spark, "op12_rank_merging", folder, "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert Counter(got) == Counter(brute.token_counts(table(folder, "doc_id, text")))


def test_op13_whitens(spark, folder):
    columns = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    got = result(spark, "op13_exact_polynomial", folder, *columns)
    ids, deviations, values, n, explained = brute.whitened(table(folder, "vec_id, embedding", "embeddings"))
    assert {g[2] for g in got} == {n} and all(g[5] == pytest.approx(explained[g[1] - 1], rel=1e-9) for g in got)
    (error,) = {g[6] for g in got}
    assert 0 <= error < 1e-9
    for k in range(values.shape[1]):
        own = sorted(((g[0] is not None, g[0] or 0, g[3]), g[4]) for g in got if g[1] == k + 1)
        want = sorted(((v is not None, v or 0, d), w) for v, d, w in zip(ids, deviations, values[:, k].tolist(), strict=True))
        assert [o[0] for o in own] == [w[0] for w in want]
        sign = 1 if sum(o[1] * w[1] for o, w in zip(own, want, strict=True)) > 0 else -1
        assert [sign * o[1] for o in own] == pytest.approx([w[1] for w in want], abs=1e-8) or sorted(sign * o[1] for o in own) == pytest.approx(sorted(w[1] for w in want), abs=1e-8)
    assert len(got) == len(ids) * values.shape[1]
