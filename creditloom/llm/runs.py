"""Periodic runs of words: an online sparse diagonal DP over the lags at which a text repeats itself.

A run is a stretch of words with smallest period p and a length of at least max(least, times * p) that neither
neighbour extends. On the diagonal of lag p a word meets the one p before it; a run is a diagonal whose match length
reaches its length less p.

Pairs of all equal words would be quadratic in the frequent ones, so a diagonal is entered by windows: for each power
of two W every word looks up the nearest earlier occurrence of the W words ending in it, and only a lag in (W/2, W]
counts. In a run of period p, W being the power with W/2 < p <= W, each window whose copy lies in the run has its
nearest earlier occurrence at lag p exactly: one at a smaller lag q would make p consecutive words equal to their own
rotation by q, and the run would have a smaller period. So every word has at most one active lag for each W, whose
match length it increments, and a diagonal that ends with enough length is a run, with its smallest period; nothing
need be compared again. Windows are named by pairs of names of half their length, exactly, and a word drops out as soon
as its window occurs once in its text, which most do after a few words. The work is n log n at worst, for a text of one
repeated word as for any other.

A null text, an empty one or one of blanks has no runs and the collapsed text "". Texts are whole whatever their
length. Rows are independent: repeated rows and ids, and null ids, each give a row. Columns named like the outputs are
replaced; others are kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm import vec
from creditloom.llm.spark_util import arrow_map, fold, table

LEAST = 24
TIMES = 3
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def word_numbers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    inside = vec.NOT_SPACE[buf]
    offs = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offs[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(buf[inside])])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period.

    ``words`` are the numbers of the words of documents one after the other, ``first`` where each document's begin.
    ``times`` is 3 at least: a diagonal then matches for two periods, so that its window of W < 2p words fits in."""
    if times < 3:
        raise ValueError("runs of fewer than three periods have no window that tells their period")
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    begin, room = first[:-1][doc], size[doc]
    name = np.array(words, np.int64)
    at = np.flatnonzero(room >= max(least, times))  # words whose window may lie in a run
    found: list[np.ndarray] = []
    width = 1
    while len(at):
        order = at[np.argsort(name[at], kind="stable")]
        again = (name[order[1:]] == name[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        here, lag = order[1:][again], (order[1:] - order[:-1])[again]
        active = (lag > width // 2) & (lag <= width) & (room[here] >= times * lag)
        here, lag = here[active], lag[active]
        by_word = np.argsort(here)
        here, lag = here[by_word], lag[by_word]
        if len(here):
            # a match length grows while the next word has the same lag; where it does not, the diagonal ends
            fresh = np.ones(len(here), bool)
            fresh[1:] = (np.diff(here) != 1) | (np.diff(lag) != 0) | (doc[here[1:]] != doc[here[:-1]])
            head = np.flatnonzero(fresh)
            tail = np.append(head[1:], len(here)) - 1
            period = lag[head]
            length = here[tail] - here[head] + width + period
            enough = length >= np.maximum(least, times * period)
            found.append(np.stack([here[head] - width + 1 - period, length, period])[:, enough])
        # windows of twice the width, of words whose two halves both occur again in their text
        repeated = np.zeros(len(name), bool)
        repeated[order[1:][again]] = True
        repeated[order[:-1][again]] = True
        at = np.flatnonzero(repeated)
        at = at[(at - 2 * width + 1 >= begin[at]) & (room[at] >= max(least, times * (width + 1)))]
        at = at[repeated[at - width]]
        if len(at):
            wide = name[at - width] * (name.max() + 1) + name[at]
            name[at] = np.unique(wide, return_inverse=True)[1]
        width *= 2
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    where = doc[start]
    return where, start - first[:-1][where], length, period


def kept_words(first: np.ndarray, runs: tuple[np.ndarray, ...]) -> np.ndarray:
    """A flag for each word: False where a run contains it after the run's first period."""
    where, start, length, period = runs
    change = np.zeros(first[-1] + 1, np.int64)
    np.add.at(change, first[where] + start + period, 1)
    np.add.at(change, first[where] + start + length, -1)
    return np.cumsum(change[:-1]) == 0


def _joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """For each document its kept words joined by one blank."""
    count = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=count[1:])
    heads = count[first]
    starts, size = starts[keep], (ends - starts)[keep] + 1
    last = heads[1:][np.diff(heads) > 0] - 1
    size[last] -= 1  # no blank after a document's last word
    offs = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    blank = np.ones(len(size), bool)
    blank[last] = False
    out = buf[np.minimum(np.repeat(starts - offs[:-1], size) + np.arange(offs[-1]), max(len(buf) - 1, 0))]
    out[offs[1:][blank] - 1] = 32
    return pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(offs[heads].astype(np.int32)), pa.py_buffer(out))


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, text_col: str = "text", runs_out: str = "runs", collapsed_out: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of each text (start, length, period in words; by start, then period), and the text with each
    run cut down to its first period."""
    docs = docs.drop(runs_out, collapsed_out)
    names = [*docs.columns, runs_out, collapsed_out]
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(runs_out, T.ArrayType(RUN)), T.StructField(collapsed_out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offs in vec.slices(batch.column(at)):
                starts, ends, first = vec.word_bounds(buf, offs)
                runs = find_runs(word_numbers(buf, starts, ends), first, least, times)
                structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in runs[1:]], fields=[pa.field(f.name, pa.int64()) for f in RUN])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[0], np.arange(j - i + 1)), pa.int32()), structs)
                text = _joined(buf, starts, ends, first, kept_words(first, runs))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), lists, text], names=names)

    return arrow_map(docs, run, schema)


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which one document in ten, by the crc32 of its id, repeats a stretch of its words to the end."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.floor(mark / 10).alias("g"), F.when(fold("doc_id", 10) == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    sized = chosen.withColumn("n", F.size("words"))
    begun = sized.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    begun = begun.withColumn("p", period)
    word = lambda i: F.element_at("words", 1 + F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    return begun.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(looped(table(spark, sf_dir, "documents")))
    more = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]  # noqa: E731  exact, and 0 for equal exponents
    best = F.aggregate("runs", F.element_at("runs", 1), lambda a, r: F.when(more(r, a) > 0, r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = F.when(F.size("runs") > 0, best)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
