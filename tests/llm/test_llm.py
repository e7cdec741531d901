"""The corpus operators against brute force, exact round trips and held-out accuracy, on tables with odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import ann, exact_topk, language_id, line_dedup, lm_score, mixing, near_dup, pieces, pii, spark_util, toxicity, vec

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id long"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and blank texts, a long one, copies, near copies, one-word texts; and a clashing extra column."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(60)) + ".\n" + " ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(40)]
    texts = [None, "", "  \n\t ", "one", "one", "Two words", "two  WORDS", " ".join(rng.choice(vocabulary) for _ in range(20_000)), *base, *base[:10]]
    for t in base[:15]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    rows = [(i, t, "en" if i % 2 else None, None if i % 7 == 0 else f"s{i % 3}", None, -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(docs, size, num, den):
    def shingle(w):
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])

    sets = {i: shingle(words_of(t)) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("size", "num"), [(3, 85), (5, 80)])
def test_near_duplicates(odd_docs, size, num):
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dup.minhash_components(odd_docs, shingle=size, num=num).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in odd_docs.collect()], size, num, 100)


def test_near_duplicates_of_nothing_and_null_ids(spark, no_docs):
    assert near_dup.minhash_components(no_docs).count() == 0
    rows = near_dup.minhash_components(spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")).collect()
    assert sorted((r.id or 0, r.component_id or 0) for r in rows) == [(0, 0), (1, 1), (1, 1)]


def test_near_duplicates_equal_their_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    want = sorted(con.execute(near_dup.OP2_SQL).fetchall())
    assert sorted(map(tuple, near_dup.op2_minhash_dedup(spark, data).select("doc_id", "n_shingles", "component_id", "kept").collect())) == want


def test_near_duplicates_of_a_crowd_equal_brute_force(spark, monkeypatch):
    """Many variants of one text, most of whose pairs come near the similarity without reaching it; the pairs compared do not become rows."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    texts = []
    for i in range(300):  # over four windows
        w = list(base)
        for at in rng.sample(range(100), rng.randint(0, 12)):
            w[at] = f"x{i}-{at}"
        texts.append((i, " ".join(w)))
    returned = []
    one_walk = near_dup.walked

    def counted(*args):
        out = one_walk(*args)
        returned.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "walked", counted)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dup.minhash_components(docs, shingle=3, num=85).collect()}
    assert got == brute_components(texts, 3, 85, 100)
    assert len(set(c for _, c in got.values())) > 20
    assert len(returned) > 2 and max(returned) <= 3 * len(texts) * 2


def test_borders_end_where_partitions_are_more_than_asked_for(spark, monkeypatch):
    asked = []
    plain = type(spark.range(1)).repartitionByRange

    def many(df, parts, *by):
        asked.append(parts)
        assert len(asked) < 20
        return plain(df, 8, *(by if isinstance(parts, int) else (parts, *by)))

    monkeypatch.setattr(near_dup, "BORDER_ROWS", 300)
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", many)
    rng = random.Random(3)
    texts = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(60))) for i in range(400)] + [(400, "a b c d e f"), (401, "a b c d e f")]
    rows = spark.createDataFrame(texts, "id long, text string")
    signed = near_dup.cut(near_dup.arrow_map(rows, near_dup.signer(3), near_dup.SIGNED)).withColumn("component", F.col("id"))
    assert (400, 401) in set(map(tuple, near_dup.walked(signed, 1, (0, 3), near_dup.best_pairs(64, 2, 85, 100)).collect()))


def test_what_the_driver_gets_does_not_grow(spark, monkeypatch):
    """The keys that narrow a table are broadcast in a bounded number of rows, and ranges are cut by a bounded sample."""
    sent = []
    plain = F.broadcast
    monkeypatch.setattr(spark_util.F, "broadcast", lambda df: plain(sent.append(df) or df))
    rows = spark.range(400_000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    wanted = rows.where("k % 2 = 0").select("k")
    got = spark_util.narrowed(rows, "k", wanted)
    assert got.columns == ["k", "v"]
    assert got.where("k % 2 = 0").count() == 200_000 and got.distinct().count() == got.count() < 300_000
    assert sent[0].count() <= spark_util.BUCKETS // 64 <= 1 << 14

    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    asked = []
    one_cut = near_dup.cut
    monkeypatch.setattr(near_dup, "cut", lambda df: asked.append(int(spark.conf.get(name, "100"))) or one_cut(df))
    texts = spark.createDataFrame([(i, f"a b c d{i % 3}") for i in range(9)], "id long, text string")
    signed = near_dup.arrow_map(texts, near_dup.signer(3), near_dup.SIGNED).withColumn("component", F.col("id")).cache()
    before = spark.conf.get(name, None), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3000")
    near_dup.walked(signed, 1, (0, 1), near_dup.best_pairs(4, 2, 85, 100))
    spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert asked[0] * 3000 <= spark_util.SAMPLED_KEYS and spark.conf.get(name, None) == before[0]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in spark_util.components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_components_with_hubs(spark, monkeypatch):
    """Nodes with a large share of the links send theirs apart from the rest; the result stays the same."""
    monkeypatch.setattr(spark_util, "EDGES_A_TASK", 20)
    star = [(500, i) for i in range(1000, 1200)] + [(7, 1199), (900, 901)] + [(901, i) for i in range(2000, 2050)]
    chain = [(i, i + 1) for i in range(3000, 3010)]
    got = {r.node: r.component for r in spark_util.components(spark.createDataFrame(star + chain, "a long, b long")).collect()}
    want = {n: 7 for n in (7, 500, *range(1000, 1200))} | {n: 900 for n in (900, 901, *range(2000, 2050))} | {n: 3000 for n in range(3000, 3011)}
    assert got == want


def test_lookup_of_heavy_keys(spark):
    rows = spark.createDataFrame([(1, i) for i in range(2000)] + [(k, k) for k in range(2, 50)], "k long, v long")
    values = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("w", F.col("k") * 10)
    out = spark_util.lookup(rows, ["k"], values, "n", rows.count())
    assert out.count() == rows.count() and out.where("w <> k * 10 or w is null").count() == 0


def brute_schedule(shares, blocks):
    """One global earliest-deadline-first run, with exact fractions of the ideal mixture."""
    from fractions import Fraction

    done, out = [0] * len(shares), []
    given = lambda v: sum(min(Fraction(n), a * v) for a, n in zip(shares, blocks))  # noqa: E731, B905
    for slot in range(sum(blocks)):
        ready = [(math.ceil(given(Fraction(done[i] + 1, shares[i]))), i) for i in range(len(shares)) if done[i] < blocks[i] and math.floor(given(Fraction(done[i], shares[i]))) <= slot]
        due, i = min(ready)
        assert slot < due
        out.append((i, done[i]))
        done[i] += 1
    return out


@pytest.mark.parametrize("shares, blocks", [([5, 3, 2], [17, 4, 9]), ([7000, 2999, 1], [140, 60, 3]), ([1, 1, 1], [5, 5, 5]), ([9], [4]), ([3, 3, 1, 5], [1, 9, 2, 30])])
def test_schedule_equals_brute_force(shares, blocks):
    """The same order as a plain run with exact fractions; every source is within a block of its share until one runs out."""
    slots = {slot: (i, k) for i, places in enumerate(mixing.schedule(shares, blocks)) for k, slot in enumerate(places)}
    assert [slots[t] for t in range(sum(blocks))] == brute_schedule(shares, blocks)
    done = collections.Counter()
    for t in range(1, sum(blocks) + 1):
        done[slots[t - 1][0]] += 1
        if all(t * a <= n * sum(shares) for a, n in zip(shares, blocks, strict=True)):
            assert all(abs(done[i] - t * a / sum(shares)) < 1 for i, a in enumerate(shares))


def test_mixing_follows_the_schedule(spark):
    rows = [(i, f"s{min(2, i % 7)}", "x", 1, 2) for i in range(300)] + [(None, None, f"t{i}", 0, 0) for i in range(20)] + [(5, "s1", "again", 0, 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int, position int")
    target = {"s0": 5.0, "s1": 1.0, "s2": 3.0, None: 0.25}
    got = mixing.mix(docs, target, block_rows=4).orderBy("position").collect()
    counts = collections.Counter(r.source for r in got)
    sources = sorted(counts, key=lambda x: (-counts[x], x is not None, x or ""))
    want = brute_schedule([int(target[x] * 4) for x in sources], [-(-counts[x] // 4) for x in sources])
    seen = list(dict.fromkeys((r.slot, r.source, r.block) for r in got))
    assert [(sources[i], k) for i, k in want] == [x[1:] for x in seen] and [x[0] for x in seen] == list(range(len(want)))
    again = mixing.mix(docs.repartition(5, "text"), target, block_rows=4).orderBy("position").collect()
    assert [(r.doc_id, r.text) for r in again] == [(r.doc_id, r.text) for r in got]
    with pytest.MonkeyPatch.context() as m, pytest.raises(ValueError):
        m.setattr(mixing, "MAX_SOURCES", 2)
        mixing.mix(docs)


def test_mixing_keeps_every_row(odd_docs, no_docs):
    out = mixing.mix(odd_docs, block_rows=2)
    assert out.columns == [*odd_docs.columns, "block", "slot", "position"]
    got = out.select("doc_id", "position").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in odd_docs.select("doc_id").collect())
    assert len({r.position for r in got}) == len(got)
    assert mixing.mix(no_docs).count() == 0
    heavy = mixing.mix(odd_docs, {"s0": 3.0, "s1": 1.0}, block_rows=1).orderBy("position").limit(8).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in heavy}["s0"] >= 4


@pytest.fixture(scope="module")
def model():
    return pieces.load()


def test_pieces_equal_the_library(model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(3)
    alphabet = "abcdefghijklmnopqrstuvwxyz   éèñßü.,;-0123456789\n日本▁😀"
    texts = ["", " ", "  a  b ", "\n", "x" * 200, "▁▁a", None, *("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400))]
    for i, j, ids, begin in pieces.encode_column(model, pieces.pa.array(texts, pieces.pa.string())):
        for r in range(i, j):
            assert ids[begin[r - i] : begin[r - i + 1]].tolist() == lib.encode(texts[r] or "")


def test_pieces_round_trip(odd_docs, no_docs, model):
    coded = pieces.encode(odd_docs, model, check_out="same")
    back = pieces.decode(coded.select("doc_id", "ids"), model).join(odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("was")), "doc_id")
    assert back.where("text <> was").count() == 0 and coded.where("not same").count() == 0
    assert pieces.encode(no_docs, model).count() == 0


def test_unigram_viterbi_is_optimal():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, "▁a": -4.2, "ba": -4.4, "▁ab": -6.5, "bab": -6.0}
    texts = {i: p.replace("▁", " ").encode() for i, p in enumerate(scores)}
    m = pieces.build(list(scores.items()), list(range(len(scores))), False, {}, 99, texts)

    def best(word):
        out = [0.0] + [-math.inf] * len(word)
        for i in range(1, len(word) + 1):
            out[i] = max(out[j] + scores.get(word[j:i], -math.inf) for j in range(i))
        return out[-1]

    for w in ("ab", "abab", "babba", "aabbab"):
        ((_, _, ids, _),) = list(pieces.encode_column(m, pieces.pa.array([w])))
        names = list(scores)
        assert "".join(names[i] for i in ids) == "▁" + w
        assert sum(scores[names[i]] for i in ids) == pytest.approx(best("▁" + w))


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    luhn = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]


def test_pii_equals_brute_force(spark, odd_docs, tmp_path):
    texts = ["", None, "a@b.c_d@e.f.g x@y 1.2.3.4.5.6.7.8 300.1.1.1 001.002.3.255", "4111 1111 1111 1111-5 4111-1111-1111-1111  4111111111111111 +1 (456) 555-2186, +1.2", "é😀 a.b@c.de 12 34", "1" * 3000, "a" * 3000, "1.2." * 500, "a@" * 500]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in pii.op5_pii(spark, str(tmp_path)).collect():
        found = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, texts[r.doc_id] or "") if passes(kind, m.group()))
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
        assert hashlib.sha256(listed.encode()).hexdigest() == r.base_sha256


def test_pii_added_kinds_and_redaction(spark):
    docs = spark.createDataFrame([(1, "IBAN GB82 WEST 1234 5698 7654 32, call 555-123-4567 or 555-123-4568; not GB83 WEST 1234 5698 7654 32", 7)], "doc_id long, text string, pii int")
    kinds = [s["kind"] for s in pii.find_pii(docs).first().pii]
    assert kinds == ["iban", "local"]
    assert pii.redact(docs).first().text.startswith("IBAN [iban], call [local] or 555-123-4568; not GB83")


def brute_lines(docs):
    """Lines removed for an equal earlier one."""
    seen, removed = set(), collections.Counter()
    for i, t in sorted(docs, key=lambda x: x[0]):
        for line in (t or "").split("\n"):
            plain = line.lower().replace("\t", " ").replace("\r", " ").replace(".", "").replace(",", "")
            form = tuple(w for w in plain.split(" ") if w)
            if len(plain) >= line_dedup.MIN_CHARS and form:
                removed[i] += form in seen
                seen.add(form)
    return removed


def test_line_dedup(spark, odd_docs, no_docs):
    long_line = " ".join(f"word{i}" for i in range(120))
    extra = spark.createDataFrame([(1000, f"{long_line}\nshort one", None, None, None, 0), (1001, long_line.replace("word7 ", "word8x ") + "\nshort one", None, None, None, 0)], DOCS)
    docs = odd_docs.unionByName(extra)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    exact = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert all(got[i].n_removed >= n for i, n in exact.items())
    assert all(got[i].n_removed == exact[i] for i in range(8))
    assert got[1001].text == "short one"
    assert got[0].text is None and got[1].text == ""
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_line_votes(spark):
    """The packed sums give the majority of the words' hash bits."""
    text = " ".join(f"w{i}" for i in range(15))
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    classes = line_dedup.line_table(docs).select("h1", F.struct("id", "place").alias("first"))
    forms = line_dedup.line_forms(docs, classes, classes.select("h1"))
    row = line_dedup.sim_hashes(forms).first()
    hashes = [r.h & (1 << 64) - 1 for r in spark.createDataFrame([(w,) for w in forms.first().form], "w string").select(F.xxhash64("w").alias("h")).collect()]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert row.sim & (1 << 64) - 1 == want


def word_edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def brute_removed(lines):
    """The documents, of one line each, that are not the first of their group by the rule of a tenth of the words."""
    sets, root = {i: t.split() for i, t in lines}, {i: i for i, _ in lines}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            n = max(len(sets[a]), len(sets[b]))
            if a < b and abs(len(sets[a]) - len(sets[b])) <= n // 10 and word_edits(sets[a], sets[b]) <= n // 10:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) != i}


def test_similar_lines_equal_brute_force(spark):
    """Every edit of a tenth of the words is found, from ten words on, and nothing beyond it."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    lines = []
    for n in [*range(9, 41), 49, 50, 59, 60, 79, 80, 89, 90, 99, 100, 130]:
        for edits in {1, max(1, n // 10), n // 10 + 1}:
            line = [word() for _ in range(n)]
            changed = list(line)
            for at in sorted((round((k + 1) * n / (edits + 1)) for k in range(edits)), reverse=True):  # evenly, which leaves the shortest runs
                how = rng.randrange(3)
                changed[at : at + (how < 2)] = [word()] if how else []
            lines += [line, changed]
    rows = list(enumerate(" ".join(x) for x in lines))
    got = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_removed}
    assert got == brute_removed(rows)


@pytest.mark.parametrize("slice_rows", [None, 8])
def test_crowded_blocks_equal_brute_force(spark, monkeypatch, slice_rows):
    """Lines that quote one passage, more than a block compares by itself, with near copies among them; and the same with
    blocks dealt to many tasks."""
    if slice_rows:
        monkeypatch.setattr(line_dedup, "SLICE", slice_rows)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage, lines = [word() for _ in range(30)], []
    for i in range(line_dedup.CROWD + 26):
        line = passage + [word() for _ in range(20)]
        lines.append(line)
        if i % 6 == 0:
            changed = list(line)
            for at in rng.sample(range(50), 2):
                changed[at] = word()
            lines.append(changed)
    rows = list(enumerate(" ".join(x) for x in lines))
    asked = []
    crowded = line_dedup.sim_hashes
    monkeypatch.setattr(line_dedup, "sim_hashes", lambda forms: asked.append(1) or crowded(forms))
    got = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_removed}
    assert asked and got == brute_removed(rows)


@pytest.mark.parametrize("carried", [64, 0])
def test_crowded_blocks_lose_no_link(spark, monkeypatch, carried):
    """Lines at the very limit of edits whose only common runs are those of a passage that a crowd quotes, and which are less
    than half of their runs; in other lengths too, where words are left out or put in."""
    monkeypatch.setattr(line_dedup, "CARRIED_BAGS", carried)
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(25)]
    lines = [passage + [word() for _ in range(25)] for _ in range(line_dedup.CROWD + 40)]
    for i in range(24):
        line = passage + [word() for _ in range(25)]
        changed = list(line)
        for at in (45, 40, 35, 30, 25):  # every run with a word of the line's own
            how = i % 4
            changed[at : at + (how != 1)] = [] if how == 2 and at > 30 else [word()]
        lines += [line, changed]
    rows = list(enumerate(" ".join(x) for x in lines))
    want = brute_removed(rows)
    got = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_removed}
    assert len(want) >= 18 and got == want


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, None), (303, [float("nan")] * 16), (304, [None] * 16), (305, [0.0] * 16), (306, []), (307, [1.0, 2.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_exact_topk(spark, vectors):
    rows = {r.vec_id: [math.floor(256 * x) for x in r.embedding] for r in vectors.where("vec_id < 302 or vec_id in (305, 307)").collect()}
    got = collections.defaultdict(list)
    for r in exact_topk.exact_topk(vectors, vectors.where("vec_id % 50 = 0 or vec_id = 305"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in got:
        want = sorted(((v, sum(a * b for a, b in zip(x, rows[q], strict=True))) for v, x in rows.items() if v != q and len(x) == len(rows[q])), key=lambda t: (-t[1], t[0]))[:5]
        assert got[q] == want
    assert exact_topk.exact_topk(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_nearest_recall_and_scores(spark, vectors):
    rows = {r.vec_id: np.array(r.embedding) for r in vectors.where("vec_id < 302").collect()}
    hit = total = 0
    for q, group in __import__("itertools").groupby(ann.nearest(vectors, vectors.where("vec_id % 10 = 0"), 5).orderBy("query_id", "rank").collect(), lambda r: r.query_id):
        cos = {v: float(x @ rows[q] / np.linalg.norm(x) / np.linalg.norm(rows[q])) for v, x in rows.items() if v != q}
        got = list(group)
        assert all(r.score == pytest.approx(cos[r.vec_id], abs=1e-12) for r in got) and [r.rank for r in got] == [1, 2, 3, 4, 5]
        hit += len({r.vec_id for r in got} & set(sorted(cos, key=lambda v: (-cos[v], v))[:5]))
        total += 5
    assert hit / total >= 0.9
    assert ann.chi2_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_language_accuracy_and_odd_rows(spark, data, no_docs):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held = language_id.op9_language_id(spark, data).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()
    m = language_id.fit(docs)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (4, "É", "x")], "doc_id long, text string, score string")
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(odd, m).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0.0) and out[4][0] in m.languages
    assert language_id.identify(odd, language_id.fit(no_docs)).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark, odd_docs):
    rng = random.Random(1)
    calm = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(calm) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(40)] = rng.choice(["vile", "rotten", "awful"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")
    m = toxicity.fit(docs, truth.where("doc_id < 400 or doc_id is null"))
    out = toxicity.score(docs, m).where("doc_id >= 400").join(truth.where("toxic is not null"), "doc_id")
    assert out.where("(score >= 0.7) = (toxic = 1)").count() >= 0.97 * out.count()
    assert toxicity.score(odd_docs, m).where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.fit(docs, truth.limit(0)).prior == 0.0


def test_lm_base_score_and_bounds(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    docs = odd_docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text").where("doc_id = 9"))
    train = [r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 10]
    tokens = {i: [*words_of(t), "\n"] for i, t in rows}
    c = collections.Counter(w for i in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    found = lm_score.score(docs.withColumn("score", F.lit("x")), spark_util.fold("doc_id", 10) != 0).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(want, abs=1e-6) and r.n_tokens == len(tokens[r.doc_id]) and r.train_tokens == n
        assert r.n_known == sum(c[w] > 0 for w in tokens[r.doc_id]) and r.score < 0


def test_bit_chances_add_up():
    code = lm_score.huffman(np.arange(1, 257))
    assert sum(2.0 ** -int(x) for x in code.length) == pytest.approx(1)
    rng = np.random.default_rng(0)
    sizes = [1 << w for _, w in lm_score.FAMILIES]
    m = lm_score.BitModel(code, 0, [rng.normal(size=n).astype(np.float32) for n in sizes], [rng.integers(0, 5, size=n).astype(np.int8) for n in sizes], rng.normal(size=(36, 5)))
    words = [bytes([a]) for a in range(256) if a not in (32, 10)]
    low = np.frombuffer(b"".join(words), np.uint8)
    total = (10 ** lm_score.word_costs(m, low, np.arange(len(words)), np.arange(len(words)) + 1)).sum()
    assert 0 < total <= 1 + 1e-9


def training_words(spark, counts):
    return spark.createDataFrame([(i, w.encode(), c) for i, (w, c) in enumerate(counts.items())], "h long, word binary, c long").coalesce(1)


def test_mixer_learns_from_occurrences(spark, monkeypatch):
    """Where tables and code are the same, how often words occur changes what is learnt."""
    code = lm_score.huffman(np.arange(1, 257))
    monkeypatch.setattr(lm_score, "TYPE_POWER", 0.0)
    monkeypatch.setattr(lm_score, "byte_code", lambda words: code)
    rng = random.Random(21)
    plain = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))): 1 for _ in range(80)}
    often = {w: 1 if i % 2 else 40 for i, w in enumerate(plain)}
    one, other = (lm_score.fit(training_words(spark, c), len(c)) for c in (plain, often))
    assert all((a == b).all() for a, b in zip(one.logit, other.logit, strict=True))
    assert abs(one.weights - other.weights).max() > 1e-3


def test_mixer_learns_like_a_plain_model(spark, monkeypatch):
    """One word's bit after the other, each occurrence by the spelling model's part of its chance."""
    monkeypatch.setattr(lm_score, "LANES", 1)
    rng = random.Random(22)
    counts = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): rng.choice([1, 2, 2, 3]) for _ in range(25)}
    words, kinds, total = training_words(spark, counts), 2000, sum(counts.values())  # so many kinds that words are spelled often
    code = lm_score.byte_code(words)
    tables = lm_score.count_bits(words, code, 0)
    got = lm_score.learn_weights(words, code, 0, tables, kinds, total)
    weights, seen = np.full((36, 5), 0.3), np.zeros(36)
    weights[:, -1] = 0
    fresh, bits_of, turns = lm_score.DISCOUNT * kinds / total, [], []
    for i, (w, c) in enumerate(counts.items()):
        bit, slots, _ = lm_score.bit_stream(code, 0, np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))
        rows, spell = [], 1.0
        for k, b in enumerate(bit):
            own = [[max(float(t[side][s[k]]) - c**lm_score.TYPE_POWER * (b == side), 0) for side in (0, 1)] for t, s in zip(tables, slots, strict=True)]
            x = np.array([*(np.float32(math.log((n1 + lm_score.PRIOR) / (n0 + lm_score.PRIOR))) for n0, n1 in own), 1])
            gate = sum(sum(sum(own[f]) > bound for bound in lm_score._SEEN) * by for f, by in ((2, 6), (3, 1)))
            spell /= 1 + math.exp((1 - 2 * b) * (weights[gate] @ x))
            rows.append((x, gate, b))
        bits_of.append(rows)
        rest = max(c - 1 - lm_score.DISCOUNT, 0) / (total - 1)
        due = c * fresh * spell / (rest + fresh * spell)
        n = max(1, math.ceil(due))
        turns += [((j + i * 0.6180339887 % 1) / n, i, due / n) for j in range(n)]
    assert len(turns) > len(counts)
    turns.sort(key=lambda t: t[:1])
    for _, i, part in turns:
        for _, gate, _ in bits_of[i]:
            seen[gate] += part
    for _, i, part in turns:
        for x, gate, b in bits_of[i]:
            error = b - 1 / (1 + math.exp(-(weights[gate] @ x)))
            weights[gate] += lm_score.RATE / math.sqrt(1 + seen[gate] / 1e4) * part * error * x
    assert np.allclose(got, weights, atol=1e-4)


def test_lm_scores_equal_a_plain_model(spark, monkeypatch):
    """Against counts, bits and mixing written out word by word and bit by bit."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) for _ in range(40)] + ["new wörds here here"]
    docs = spark.createDataFrame([(i, t, i < 40) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    words = lm_score.word_table(docs.select("text", "train")).cache()
    counts = {bytes(r.word): r.c for r in words.collect()}
    plain = collections.Counter(w.encode() for t in texts[:40] for w in [*t.split(), ""])
    assert {w: c for w, c in counts.items() if c} == dict(plain)
    kinds, total = len(plain), sum(plain.values())
    model = lm_score.fit(words, kinds)

    def spell(word):
        cost, before = 0.0, []
        symbols = [*word, 32] if word else [10]
        for at, symbol in enumerate(symbols):
            for depth in range(int(model.code.length[symbol])):
                bit = int(model.code.path[symbol]) >> (int(model.code.length[symbol]) - 1 - depth) & 1
                low = np.frombuffer(word, np.uint8)
                _, slots, _ = lm_score.bit_stream(model.code, model.wider, low, np.array([0]), np.array([len(word)]))
                here = [int(s[len(before)]) for s in slots]
                gate = int(model.seen[2][here[2]]) * (len(lm_score._SEEN) + 1) + int(model.seen[3][here[3]])
                x = model.weights[gate][-1] + sum(model.weights[gate][k] * model.logit[k][s] for k, s in enumerate(here))
                cost += math.log10(1 / (1 + math.exp(-x if bit else x)))
                before.append(bit)
        return cost

    chance = {w: max(c - lm_score.DISCOUNT, 0) / total + lm_score.DISCOUNT * kinds / total * 10 ** spell(w) for w, c in counts.items()}
    monkeypatch.setattr(lm_score, "fit", lambda *_: model)  # what is learnt depends on the order of the words
    got = {r.doc_id: r for r in lm_score.score(docs, F.col("train")).collect()}
    for i, t in enumerate(texts):
        want, seen = 0.0, []
        for w in [*t.split(), ""]:
            hits = len(seen) - len(set(seen))
            share = lm_score.OWN_SHARE * (hits + 0.5) / (len(seen) + 2) if seen else 0.0
            own = share * seen.count(w) / len(seen) if seen and w else 0.0
            want += math.log10(own + (1 - share) * chance[w.encode()])
            seen.append(w)
        assert got[i].score == pytest.approx(want, rel=2e-3)


def test_empty_tables(spark, no_docs):
    assert lm_score.score(no_docs.select("doc_id", "text"), F.lit(True)).count() == 0


def test_hash_index():
    keys = vec.mix(np.arange(1000, dtype=np.uint64))
    index = vec.HashIndex(keys)
    assert (index.find(keys) == np.arange(1000)).all() and (index.find(vec.mix(np.arange(5000, 5100, dtype=np.uint64))) == -1).all()


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, n = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, data).cache()
        n[name] = after.count()
        assert ids(after) <= ids(before) and set(docs.columns) <= set(after.columns)
        if name == "near_dedup":
            groups = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80, 100)
            assert ids(after) == {i for i, (_, root) in groups.items() if i == root}
        if name != "sentencepiece":
            assert after.columns == docs.columns
        before = after
    assert n["mix_sources"] == n["near_dedup"] == n["sentencepiece"] and before.where("not round_trip").count() == 0
    assert corpus_pipeline.run(spark, data).count() == n["sentencepiece"]
