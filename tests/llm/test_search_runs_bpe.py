"""Byte BPE against its library, lexical search against its SQL and a plain search, periodic runs against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from creditloom.llm import byte_bpe, lexical, runs

DOCS = "doc_id long, text string, runs string, item_id long, score string, ids string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and blank texts, a long text, unbroken text, repeated rows and ids, null ids, clashing columns."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdéK") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    texts = [None, "", " \n\t ", "a", "a b", "it's 'still' they'LL we're''s 12 ' 're\n\n'd x", "x" * 3000, "word " * 500, "ab  ab\tab\x0bab " * 40, "日本語 " * 30, "\x1c a\x85b c d", " ".join(rng.choice(vocabulary) for _ in range(20_000))]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    for period in (1, 5, 8, 13, 16, 21):
        x = [rng.choice(vocabulary) for _ in range(period)]
        texts.append(" ".join(["before", *(x * 5)[: 4 * period + 3], "after", *x * 3, *x * 3]))
    rows = [(i, t, "r", 7, "s", "i") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *rows[20:23], (None, "a b c", None, None, None, None), (None, None, None, None, None, None), (3, "other a", None, 1, None, None)], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def library():
    model = byte_bpe.load()
    return model, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})


def test_byte_bpe_equals_its_library(odd_docs, library):
    model, plain = library
    rows = byte_bpe.decode(byte_bpe.encode(odd_docs, model), model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == plain.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_byte_bpe_at_every_code_point(library):
    model, plain = library
    texts = [f"a{c} {c}1  {c}'s{c}\n{c}" for c in (chr(x) for x in range(0, 0x110000, 7) if not 0xD800 <= x < 0xE000)]
    for i, j, ids, begin in byte_bpe.encode_column(model, pa.array(texts)):
        assert [ids[begin[k - i] : begin[k - i + 1]].tolist() for k in range(i, j)] == plain.encode_ordinary_batch(texts[i:j])


def test_byte_bpe_of_unbroken_text(library):
    model, plain = library
    rng = random.Random(3)
    for letters in ("a", "ab", "=-", "aeinrst", "äößé", "0123456789", " \n"):
        for n in (1, 7, 8, 9, 16, 17, 33, 1000, 20_000):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert model.encode(text) == plain.encode_ordinary(text)


def test_byte_bpe_join_of_any_halves(library):
    model, _ = library
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("aeinrsté ") for _ in range(rng.randint(0, 40))).encode()
        cut = rng.randint(0, len(text))
        assert model.join(model.merge(text[:cut]), model.merge(text[cut:])) == model.merge(text)


def test_byte_bpe_of_nothing_and_of_wrong_ids(spark, no_docs, library):
    model, _ = library
    assert byte_bpe.decode(byte_bpe.encode(no_docs, model), model).count() == 0
    some = spark.createDataFrame([(1, None), (2, []), (3, [5])], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(some, model).collect()} == {1: b"", 2: b"", 3: model.bytes_of[5]}
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([60000],)], "ids array<int>"), model).collect()


def test_byte_bpe_with_another_pattern(library):
    model = byte_bpe.ByteBpe(library[0].ranks, r"\S+|\s+")
    plain = tiktoken.Encoding("other", pat_str=r"\S+|\s+", mergeable_ranks=model.ranks, special_tokens={})
    assert model.encode("it's 12 a-b\n\n c") == plain.encode_ordinary("it's 12 a-b\n\n c")


def test_byte_bpe_query(spark, data, library):
    rows = {r.doc_id: r for r in byte_bpe.op11_byte_bpe(spark, data).collect()}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = library[1].encode_ordinary(r.text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        assert (rows[r.doc_id].n_tokens, rows[r.doc_id].ids_sha256, rows[r.doc_id].decoded_sha256) == want


def plain_search(docs, items, k):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, total = sum(1 for _, t in terms if t), sum(len(t) for _, t in terms)
    df = collections.Counter(x for _, t in terms for x in set(t))
    out = []
    for item in {i for i, _ in items}:
        asked = {x for i, t in items if i == item for x in TERM.findall((t or "").translate(LOWER))}
        scored = []
        for i, t in terms:
            tf = collections.Counter(t)
            m = 10 + 90 * len(t) * n_docs // total if t else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m)) for x in asked if tf[x])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 1 << 25])
def test_ranked_search_equals_a_plain_one(spark, odd_docs, block, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TEXT", block)  # tasks run in forked processes with the driver's module only here
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, "A ab x word"), (2, None), (3, ""), (4, "nowhere"), (5, docs[15][1]), (5, "word"), (None, "b a"), (6, docs[30][1]), (6, docs[30][1])]
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical.search(odd_docs, queries, 5).collect()), key=repr) == plain_search(docs, items, 5)


def test_ranked_search_in_chunks(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS_A_CHUNK", 20)
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(n, docs[20 + n][1]) for n in range(8)]
    found = lexical.search(odd_docs, spark.createDataFrame(items, "item_id long, text string"), 3)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(docs, items, 3)


def test_ranked_search_stops_creating_accumulators():
    """Blocks of many documents against all scores, with a common term whose documents get no accumulator."""
    rng = np.random.default_rng(6)
    n, vocabulary = 3000, 40
    share = np.linspace(0.001, 0.9, vocabulary)
    pairs = np.argwhere(rng.random((vocabulary, n)) < share[:, None])
    term, text = pairs[:, 0], pairs[:, 1]
    tf, length, ids = rng.integers(1, 4, len(term)), rng.integers(40, 200, n), rng.permutation(n)
    df = np.bincount(term, minlength=vocabulary)
    weight = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
    chunk = lexical.Chunk(pa.array([str(t) for t in range(vocabulary)]), [(np.arange(vocabulary), weight), (np.array([0, 39]), weight[[0, 39]])], n, int(length.sum()))
    top = [(np.zeros(0, np.int64),) * 2 for _ in chunk.items]
    lexical.search_block(chunk, ids, length, text, term, tf, top, 10)
    gain = 10**9 * tf // (1000 * tf + 8 * (10 + 90 * length * n // length.sum())[text])
    for (numbers, weights), (got, scores) in zip(chunk.items, top, strict=True):
        every = np.zeros(n, np.int64)
        for t, w in zip(numbers, weights, strict=True):
            every[text[term == t]] += w * gain[term == t]
        order = np.lexsort((ids, -every))[:10]
        order = order[every[order] > 0]
        assert got.tolist() == ids[order].tolist() and scores.tolist() == every[order].tolist()


def test_ranked_search_of_nothing(spark, odd_docs, no_docs):
    queries = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(no_docs, queries, 5).count() == 0
    assert lexical.search(odd_docs, queries.where("false"), 5).count() == 0


def test_ranked_search_equals_its_sql(spark, data):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    assert sorted(map(tuple, lexical.op12_ranked_search(spark, data).collect())) == sorted(con.execute(lexical.OP12_SQL).fetchall())


def brute_runs(words, least, times):
    out = []
    for p in range(1, len(words) // times + 1):
        i = p
        while i < len(words):
            s = i
            while i < len(words) and words[i] == words[i - p]:
                i += 1
            start, length = s - p, i - s + p
            inner = words[start : start + length]
            if length >= max(least, times * p) and not any(inner[q:] == inner[:-q] for q in range(1, p)):
                out.append((start, length, p))
            i += 1
    return sorted(out)


@pytest.mark.parametrize(("least", "times"), [(24, 3), (1, 3), (5, 3), (1, 4)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(150):
        docs = []
        for _ in range(3):
            words, size, letters = [], rng.randint(0, 150), rng.randint(1, 3)
            while len(words) < size:
                words += [rng.randrange(letters) for _ in range(rng.randint(1, 12))] * rng.randint(1, 6)
            docs.append(words + words[-rng.randint(1, 40) :] * rng.randint(0, 4))
        first = np.cumsum([0, *map(len, docs)])
        where, *found = runs.find_runs(np.array(sum(docs, []), np.int64), first, least, times)
        for k, words in enumerate(docs):
            assert list(zip(*(x[where == k].tolist() for x in found), strict=True)) == brute_runs(words, least, times)


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError, match="three periods"):
        runs.find_runs(np.zeros(3, np.int64), np.array([0, 3]), 1, 2)


def test_runs_and_collapsed_texts(odd_docs):
    seen = 0
    for r in runs.periodic_runs(odd_docs).collect():
        words = WORD.findall(r.text or "")
        if len(words) > 5000:  # brute force is quadratic
            continue
        want = brute_runs(words, 24, 3)
        assert [tuple(x) for x in r.runs] == want
        dropped = {i for s, n, p in want for i in range(s + p, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)
        seen += bool(want)
    assert seen > 5


def test_runs_of_one_word_are_not_quadratic():
    n = 300_000
    _, start, length, period = runs.find_runs(np.zeros(n, np.int64), np.array([0, n]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [1])


def test_runs_of_nothing(no_docs):
    assert runs.periodic_runs(no_docs).count() == 0


def test_runs_query(spark, data):
    rows = {r.doc_id: r for r in runs.op13_periodic_runs(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    assert len(rows) == len(docs)
    found = 0
    for r in docs:
        words, h = WORD.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 6000:
            continue
        want, got = brute_runs(words, 24, 3), rows[r.doc_id]
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (got.n_runs, got.start, got.length, got.period) == (len(want), *(best or (None,) * 3))
        assert got.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert got.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in want).encode()).hexdigest()
        dropped = {i for s, k, q in want for i in range(s + q, s + k)}
        assert got.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest()
        found += bool(want)
    assert found
