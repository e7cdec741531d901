"""Ranked lexical search, term at a time with a limited set of accumulators.

Texts meet a stated set of queries where they lie: each task reads its documents block by block, keeps a block's
postings of the queries' terms, and takes each query's terms rarest first. Each term adds to the accumulators of its
documents. The terms still to come can give a document at most the sum of their bounds, a bound being the highest
score that the term gives any document of the block; once that sum cannot reach the k-th partial score (of the block,
or of the blocks that the task has searched before), a document without an accumulator cannot be among the best k, and
no more are created. Those that are there are updated to the end, so their scores are exact. A task hands on the best k
of each query, and a window takes the best of all tasks.

Terms are maximal stretches of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased. The weight of a
term and the scores are whole numbers, as the docstring of :func:`search` states them.

Queries are broadcast in chunks of at most TERMS_A_CHUNK pairs of query and term (more only if one query alone has
more), one search a chunk. A first pass over the documents counts N, L and, for terms that share a hash bucket with a
query's, the documents holding them; the buckets are a broadcast of fixed size.

Texts that are null, empty or without a term count nowhere. Repeated documents are documents of their own, with equal
scores; a null id comes after others at equal scores. Queries that share an id are one query with the terms of all;
null texts have no terms; a query without terms, or whose terms no document holds, returns nothing, as do empty tables.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm import vec
from creditloom.llm.spark_util import arrow_map, table
from creditloom.llm.vector_grid import best

BUCKETS = 1 << 20
TERMS_A_CHUNK = 1 << 20
BLOCK_TEXT = 1 << 25  # bytes of text whose postings are searched together
NO_ID = np.iinfo(np.int64).max
_TERM = np.zeros(256, bool)
for _lo, _hi in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _TERM[_lo : _hi + 1] = True


@dataclass
class Terms:
    """The terms of texts one after the other: distinct ones with their buckets, and for each occurrence its number."""

    first: np.ndarray  # where each text's occurrences begin
    number: np.ndarray
    distinct: pa.Array
    bucket: np.ndarray


def _terms(buf: np.ndarray, offs: np.ndarray) -> Terms:
    starts, ends, first = vec.word_bounds(buf, offs, _TERM)
    low = vec.LOWER[buf]
    ends_at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=ends_at[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_at), pa.py_buffer(low[_TERM[buf]])).dictionary_encode()
    number = words.indices.to_numpy().astype(np.int64)
    one = np.zeros(len(words.dictionary), np.int64)
    one[number] = np.arange(len(number))
    bucket = vec.span_hashes(low, starts[one], ends[one]) % vec.U64(BUCKETS)
    return Terms(first, number, words.dictionary, bucket.astype(np.int64))


def _per_text(terms: Terms, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) for the terms that ``number`` renumbers; -1 leaves one out."""
    texts = len(terms.first) - 1
    occ = number[terms.number]
    text = np.repeat(np.arange(texts), np.diff(terms.first))
    pairs, tf = np.unique(occ[occ >= 0] * texts + text[occ >= 0], return_counts=True)
    return pairs % max(texts, 1), pairs // max(texts, 1), tf


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term, bucket), each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in vec.slices(batch.column(1)):
                terms = _terms(buf, offs)
                text, term, _ = _per_text(terms, np.arange(len(terms.distinct)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).take(pa.array(text)), terms.distinct.take(pa.array(term)).cast(pa.string()), pa.array(terms.bucket[term])], names=["item_id", "term", "bucket"])

    rows = queries.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return arrow_map(rows, run, f"item_id {kind}, term string, bucket long").distinct()


def term_counts(docs: DataFrame, text_col: str, wanted: np.ndarray) -> DataFrame:
    """(term, docs, occurrences): the documents that hold each term whose bucket is ``wanted``; in the row of the null
    term, those that hold any term, and all occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for _, _, buf, offs in vec.slices(batch.column(0)):
                terms = _terms(buf, offs)
                fine = np.flatnonzero(flags[terms.bucket])
                number = np.full(len(terms.distinct), -1, np.int64)
                number[fine] = np.arange(len(fine))
                df = np.bincount(_per_text(terms, number)[1], minlength=len(fine))
                names = pa.concat_arrays([terms.distinct.take(pa.array(fine)).cast(pa.string()), pa.nulls(1, pa.string())])
                yield pa.RecordBatch.from_arrays([names, pa.array(np.append(df, np.count_nonzero(np.diff(terms.first)))), pa.array(np.append(df * 0, len(terms.number)))], names=["term", "docs", "occurrences"])

    counted = arrow_map(docs.select(text_col), run, "term string, docs long, occurrences long")
    return counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("occurrences"))


@dataclass
class Chunk:
    """Queries with their terms, rarest first, and their weights."""

    vocabulary: pa.Array
    items: list[tuple[np.ndarray, np.ndarray]]  # term numbers and weights of each query
    documents: int
    occurrences: int


def search_block(chunk: Chunk, ids: np.ndarray, length: np.ndarray, text: np.ndarray, term: np.ndarray, tf: np.ndarray, top: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
    """Bring the best ``k`` of each query (ids, scores) up to date with one block of documents.

    ``text``, ``term`` and ``tf`` are its postings in order of their terms."""
    m = 100 - 90 + 90 * length * chunk.documents // max(chunk.occurrences, 1)
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[text])
    at = np.searchsorted(term, np.arange(len(chunk.vocabulary) + 1))
    most = np.zeros(len(chunk.vocabulary), np.int64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        most[some] = np.maximum.reduceat(impact, at[some])
    score = np.zeros(len(ids), np.int64)
    held = np.zeros(len(ids), bool)
    for n, (numbers, weights) in enumerate(chunk.items):
        present = at[numbers + 1] > at[numbers]
        numbers, weights = numbers[present], weights[present]
        if not len(numbers):
            continue
        bounds = weights * most[numbers]
        ahead = bounds[::-1].cumsum()[::-1]  # what the terms from here on can give at most
        best_ids, best_scores = top[n]
        floor = best_scores[-1] if len(best_scores) == k else -1
        if ahead[0] < floor:
            continue
        score[:] = 0
        held[:] = False
        creating = True
        for r, (number, weight) in enumerate(zip(numbers, weights, strict=True)):
            docs, gain = text[at[number] : at[number + 1]], weight * impact[at[number] : at[number + 1]]
            if creating and r:
                if ahead[r] < floor:
                    creating = False
                else:
                    partial = score[held]
                    creating = len(partial) < k or ahead[r] >= np.partition(partial, len(partial) - k)[len(partial) - k]
            if creating:
                held[docs] = True
            else:
                old = held[docs]
                docs, gain = docs[old], gain[old]
            score[docs] += gain
        found = np.flatnonzero(held & (score > 0) & (score >= floor))
        both_ids, both_scores = np.concatenate([best_ids, ids[found]]), np.concatenate([best_scores, score[found]])
        keep = best(both_ids, both_scores, k)
        top[n] = both_ids[keep], both_scores[keep]


def _search(docs: DataFrame, chunk: Chunk, names: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score): the best ``k`` of each task for each query of a chunk; ``item`` counts the queries."""
    shared = docs.sparkSession.sparkContext.broadcast(chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = shared.value
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in chunk.items]
        block: list[tuple[np.ndarray, ...]] = []
        size = rows = 0

        def flush() -> None:
            ids, length, text, term, tf = (np.concatenate(x) for x in zip(*block, strict=True))
            order = np.argsort(term, kind="stable")
            search_block(chunk, ids, length, text[order], term[order], tf[order], top, k)
            block.clear()

        for batch in batches:
            for i, j, buf, offs in vec.slices(batch.column(1)):
                terms = _terms(buf, offs)
                number = pc.index_in(terms.distinct, chunk.vocabulary).fill_null(-1).to_numpy().astype(np.int64)
                text, term, tf = _per_text(terms, number)
                ids = batch.column(0).slice(i, j - i).fill_null(NO_ID).to_numpy()
                block.append((ids, np.diff(terms.first), text + rows, term, tf))
                size, rows = size + len(buf), rows + j - i
                if size >= BLOCK_TEXT:
                    flush()
                    size = rows = 0
        if block:
            flush()
        item = np.repeat(np.arange(len(top)), [len(x) for x, _ in top])
        ids, scores = (np.concatenate([pair[c] for pair in top]) if top else np.zeros(0, np.int64) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], names=["item", "doc_id", "score"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "item long, doc_id long, score long")


def _chunks(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the number of their query's chunk, chunks being doubled until none is too large."""
    sizes = pairs.groupBy("item_id").agg(F.count("*").alias("n")).persist()
    count = 1
    while True:
        chunk = F.pmod(F.xxhash64("item_id"), F.lit(count))
        largest = sizes.groupBy(chunk).agg(F.sum("n").alias("n"), F.count("*").alias("items")).where("items > 1").agg(F.max("n")).first()[0]
        if largest is None or largest <= TERMS_A_CHUNK:
            sizes.unpersist()
            return pairs.withColumn("chunk", chunk)
        count *= 2


def search(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0, for each query.

    N documents hold terms, L terms with repeats, one of them n; a term has the weight floor(1000 ln((2N+2)/(2df+1))),
    and with m = 10 + 90nN div L a document scores the sum of weight * (10^9 tf div (1000 tf + 8m)). Equal scores are
    ranked by id."""
    pairs = query_terms(queries, item_col, item_text).persist()
    out = None
    try:
        buckets = [r.bucket for r in pairs.select("bucket").distinct().collect()]  # BUCKETS at most
        wanted = np.zeros(BUCKETS, bool)
        wanted[buckets] = True
        counts = term_counts(docs, text_col, wanted).persist()
        whole = counts.where("term IS NULL").first()
        n, total = (whole.docs, whole.occurrences) if whole else (0, 0)
        weight = F.floor(1000 * F.log((2.0 * F.lit(n) + 2) / (2.0 * F.col("docs") + 1)))
        weighed = _chunks(pairs.join(counts.where("docs > 0"), "term").select("item_id", "term", "docs", weight.alias("weight"))).persist()
        for number in sorted(r.chunk for r in weighed.select("chunk").distinct().collect()):
            rows = weighed.where(F.col("chunk") == number).orderBy("item_id", "docs", "term").toArrow()
            vocabulary = rows["term"].combine_chunks().unique()
            terms = pc.index_in(rows["term"].combine_chunks(), vocabulary).to_numpy().astype(np.int64)
            items = rows["item_id"].combine_chunks().dictionary_encode("encode")
            head = np.flatnonzero(np.diff(items.indices.to_numpy(), prepend=-1))
            lists = list(zip(np.split(terms, head[1:]), np.split(rows["weight"].combine_chunks().to_numpy(), head[1:]), strict=True))
            names = items.dictionary.to_pylist()
            kind = pairs.schema["item_id"].dataType.simpleString()
            found = _search(docs, Chunk(vocabulary.cast(pa.large_string()), lists, n, total), names, k, id_col, text_col)
            named = docs.sparkSession.createDataFrame(list(enumerate(names)), f"item long, item_id {kind}")
            found = found.join(F.broadcast(named), "item")
            out = found if out is None else out.unionByName(found)
        if out is None:
            out = pairs.select("item_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    finally:
        pairs.unpersist()
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), s AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS occurrences FROM d WHERE len(terms) > 0),
t AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), w AS (SELECT item_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM q JOIN df USING (term) CROSS JOIN s),
x AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // occurrences))))::BIGINT AS score
  FROM w JOIN t USING (term) CROSS JOIN s GROUP BY item_id, r, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 10
"""
