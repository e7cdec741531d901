"""Language identification and toxicity against plain Python models, and their odd tables."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import language_id, toxicity

M32 = (1 << 32) - 1


def plain_buckets(text):
    """The buckets of all n-grams, one after the other."""
    codes = [ord(c.lower()) if c.isalpha() else 0 for c in text]
    for order in language_id.ORDERS:
        for i in range(len(codes) - order + 1):
            h = sum((codes[i + k] + 1) * int(language_id._MUL[k]) for k in range(order)) & M32
            h = h * (order * 2 + 0x01000193 | 1) & M32
            h = (h ^ h >> 15) * 0x2C1B3C6D & M32
            yield h >> 16


def plain_bayes(train):
    counts, rows = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in train:
        counts[lang].update(plain_buckets(text))
        rows[lang] += 1
    base = language_id.SMOOTHING * language_id.BUCKETS

    def predict(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        logs = {}
        for lang in sorted(counts):
            total = math.log(sum(counts[lang].values()) + base)
            logs[lang] = math.log(rows[lang] / sum(rows.values())) + sum(math.log(counts[lang][b] + language_id.SMOOTHING) - total for b in plain_buckets(text))
        best = max(sorted(logs), key=logs.get)
        return best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())

    return predict


def test_language_equals_plain_bayes(spark):
    rng = random.Random(8)
    alphabets = {"aa": "abcdefé ", "bb": "abcxyzß ", "cc": "abcdxyü-, "}
    text = lambda lang, n: "".join(rng.choice(alphabets[lang]) for _ in range(n))
    train = [(text(lang, rng.randint(1, 30)), lang) for lang in alphabets for _ in range(20 if lang == "aa" else 9)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(train)] + [(900, None, "aa"), (901, "abc", None)], "doc_id long, text string, lang string").repartition(3)
    asked = [text(lang, rng.randint(1, 12)) for lang in alphabets for _ in range(15)] + ["", None, "12 !", "ABC", "É", "日本", text("bb", 20_000)]
    asked += asked[:2]
    got = language_id.identify(spark.createDataFrame([(i % 40, i, t) for i, t in enumerate(asked)], "doc_id long, place int, text string"), language_id.fit(docs)).collect()
    plain = plain_bayes(train)
    assert len(got) == len(asked)
    for r in got:
        lang, score = plain(asked[r.place])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4)


def test_language_of_no_documents_and_ties(spark):
    docs = spark.createDataFrame([(1, "abab", "q"), (2, "abab", "p")], "doc_id long, text string, lang string")
    m = language_id.fit(docs)
    assert m.languages == ("p", "q")
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs.limit(1), m).collect()] == [("p", 0.5)]
    assert language_id.identify(docs.where("false"), m).count() == 0


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


def plain_ratio(rows):
    """log P(word | toxic) - log P(word | ordinary) of any word, from (text, label)."""
    seen = [set(), set()]
    for text, y in rows:
        words = plain_words(text)
        seen[y].update(zip(words, [None, *words], strict=False))
    counts = [collections.Counter(w for w, _ in s) for s in seen]
    both = collections.Counter(w for w, _ in seen[0] | seen[1])
    d = toxicity.DISCOUNT
    size = [sum(c.values()) for c in counts]
    free = [sum(min(n, d) for n in c.values()) / z for c, z in zip(counts, size, strict=True)]

    def ratio(w):
        shared = both[w] / sum(both.values())
        if not shared:
            return math.log(free[1] / free[0])
        p = [max(counts[k][w] - d, 0) / size[k] + free[k] * shared for k in (0, 1)]
        return math.log(p[1] / p[0])

    return ratio


def plain_evidence(text, ratio):
    r = [ratio(w) for w in plain_words(text)]
    if not r:
        return [0.0, 0.0, 0.0]
    n = toxicity.WINDOW
    windows = [sum(r[i : i + n]) / n for i in range(len(r) - n + 1)] or [sum(r) / len(r)]
    return [max(windows), max(r), sum(r) / len(r)]


def test_toxicity_equals_plain_model(spark):
    rng = random.Random(3)
    calm, bad = [f"w{i}" for i in range(40)] + ["Über", "W1"], ["vile", "Rotten", "awful"]
    rows = []
    for i in range(160):
        words = [rng.choice(calm) for _ in range(rng.randint(0, 25))]
        if i % 3 == 0:
            words += rng.choices(bad, k=2)
            rng.shuffle(words)
        rows.append((i, ", ".join(words), int(i % 3 == 0 and i % 7 != 0)))
    rows += [(200, None, 0), (201, "", 1), (202, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = [(i, y) for i, _, y in rows] + [(i, 0) for i, _, _ in rows[:30]] + [(None, 1), (5, None)]  # repeated: toxic if any is
    m = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))

    pick = F.pmod(F.xxhash64(F.lit("calibrate"), F.col("doc_id")), F.lit(toxicity.CALIBRATION_SHARE)) == 0
    held = {r.doc_id for r in docs.where(pick).collect()}
    ratio = plain_ratio([(t, y) for i, t, y in rows if i not in held])
    x = np.array([[1.0, *plain_evidence(t, ratio)] for i, t, _ in rows if i in held])
    y = np.array([y for i, _, y in rows if i in held])
    slope = x.T @ (y - 1 / (1 + np.exp(-x @ m.weights))) - np.array([1e-6, 1, 1, 1]) * m.weights
    assert np.abs(slope).max() < 1e-5  # the penalised likelihood has one maximum, where its slope is zero

    odd = [(1, "VILE w3"), (1, "rotten"), (2, None), (3, "never seen words"), (4, " ".join(rng.choices(calm + bad, k=20_000)))]
    asked = spark.createDataFrame([(i, k, t, "clash") for k, (i, t) in enumerate(odd)], "doc_id long, place int, text string, score string")
    got = toxicity.score(asked, m).collect()
    assert len(got) == len(odd)
    for r in got:
        want = 1 / (1 + math.exp(-float(np.dot(m.weights, [1.0, *plain_evidence(r.text, ratio)]))))
        assert r.score == pytest.approx(want, abs=1e-9)


def test_toxicity_of_no_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels)
    assert m.prior == 1.0 and toxicity.score(docs, m).first().score == 1.0
    assert toxicity.score(docs.where("false"), m).count() == 0 and toxicity.fit(docs.where("false"), labels).prior == 0.0
