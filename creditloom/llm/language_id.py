"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased code points; everything that is not a letter counts as one blank. N-grams of 1 to 3
characters are hashed into a fixed number of buckets. Training counts buckets by language; the matrix of log
probabilities, whose size is buckets x languages, is broadcast, and documents are scored in batches of numpy.

The classifier is fitted on a bounded sample of labelled rows: about ``per_language`` documents of each language at
most, chosen by a hash of their ids. Every document is scored over its whole text.

A null text, an empty one, or one without a letter gets the language ``und`` and the score 0. With nothing to learn
from, every document does. Ties go to the first language in alphabetical order. Rows are scored one by one, so
repeated rows and ids are fine; other columns are ignored by the query and kept by :func:`identify`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm import vec
from creditloom.llm.spark_util import arrow_map, fold, table

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
PER_LANGUAGE = 4000
UNKNOWN = "und"
_MUL = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


@cache
def _code_tables() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        if 0xAC00 <= cp < 0xD7A4 or 0x4E00 <= cp < 0xA000:  # large blocks of caseless letters
            out[cp] = cp
        elif (ch := chr(cp)).isalpha():
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def _letters(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0 for anything else) of a slice, and where each document's characters begin."""
    text = buf.tobytes().decode("utf-8", errors="replace")
    codes = np.frombuffer(text.encode("utf-32-le", errors="surrogatepass"), np.uint32)
    heads = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=heads[1:])
    return _code_tables()[codes], np.minimum(heads[offs], len(codes))


def _grams(letters: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of all n-grams, and where each document's begin. BUCKETS marks one that would cross."""
    acc = np.zeros(len(letters), np.uint32)
    for order in ORDERS:
        k = order - 1
        acc[: len(letters) - k] += (letters[k:] + np.uint32(1)) * _MUL[k]
        h = acc * np.uint32(order * 2 + 0x01000193 | 1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        bucket = (h >> np.uint32(16)).astype(np.int32)
        for back in range(1, order):
            ends = begin[1:] - back
            bucket[ends[(ends >= begin[:-1])]] = BUCKETS
        yield bucket, begin


def _features(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray, np.ndarray]]:
    for i, j, buf, offs in vec.slices(column):
        letters, begin = _letters(buf, offs)
        has = np.zeros(j - i, bool)
        some = np.flatnonzero(np.diff(begin))
        if len(some):
            has[some] = np.add.reduceat((letters > 0).astype(np.int64), begin[:-1][some]) > 0
        yield i, j, [b for b, _ in _grams(letters, begin)], begin, has


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # (BUCKETS + 1, languages); the last row is 0
    log_prior: np.ndarray


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on rows of ``docs`` with a language: about ``per_language`` of each at most, by a hash of the id."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(sizes))
    if not names:
        return LanguageModel((), np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0))
    rate = F.create_map(*(x for name in names for x in (F.lit(name), F.lit(min(1.0, per_language / sizes[name])))))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("sample"), F.col("id")), F.lit(1 << 20)) < F.element_at(rate, F.col("lang")) * (1 << 20))
    number = {name: k for k, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(names), BUCKETS + 1), np.int64)
        for batch in batches:
            langs = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for i, j, grams, begin, _ in _features(batch.column(0)):
                mine = np.repeat(langs[i:j], np.diff(begin)) * (BUCKETS + 1)
                for bucket in grams:
                    totals += np.bincount(mine + bucket, minlength=totals.size).reshape(totals.shape)
        lang, bucket = np.nonzero(totals[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[lang, bucket])], names=["lang", "bucket", "n"])

    rows = arrow_map(drawn.select("text", "lang"), count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((BUCKETS, len(names)))
    counts[rows["bucket"].to_numpy(), rows["lang"].to_numpy()] = rows["n"].to_numpy()
    log_prob = np.zeros((BUCKETS + 1, len(names)), np.float32)
    log_prob[:BUCKETS] = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))
    weight = np.array([sizes[x] for x in names], float)
    return LanguageModel(names, log_prob, np.log(weight / weight.sum()))


def score_batch(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text of a column."""
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    best = np.full(len(column), len(names) - 1)
    score = np.zeros(len(column))
    if model.languages:
        for i, j, grams, begin, has in _features(column):
            rows = np.flatnonzero(has)
            if not len(rows):
                continue
            heads = begin[:-1][np.flatnonzero(np.diff(begin))]
            some = np.flatnonzero(np.diff(begin))
            logp = np.tile(model.log_prior, (j - i, 1))
            for bucket in grams:
                for k in range(len(model.languages)):
                    logp[some, k] += np.add.reduceat(model.log_prob[:, k][bucket], heads, dtype=np.float64)
            top = logp[rows].argmax(axis=1)
            best[i + rows] = top
            score[i + rows] = 1 / np.exp(logp[rows] - logp[rows].max(axis=1, keepdims=True)).sum(axis=1)
    return list(names[best]), score


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior probability as two columns, in place of any of the same names."""
    # column-major, so that a language's probabilities lie together
    shared = docs.sparkSession.sparkContext.broadcast(LanguageModel(model.languages, np.asfortranarray(model.log_prob), model.log_prior))
    docs = docs.drop(lang_out, score_out)
    names = docs.columns
    at = names.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = score_batch(shared.value, batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*names, lang_out, score_out])

    return arrow_map(docs, predict, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 5) != 0))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
