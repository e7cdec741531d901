"""Byte-level BPE as a monoid: texts are encoded by halves that are joined, and decoded by concatenation up a tree.

The pattern cuts a text into matches that never share a token. Of all matches of some megabytes the distinct ones are
encoded, by their halves; leaves are merged all at once. Within a match, merging the adjacent pair of best rank again
and again has this property: a sequence of tokens is the encoding of its bytes if, and only if, every two neighbours
are the encoding of their own bytes, because merges inside two tokens go on unhindered until the first that crosses
their border, and that one depends on these two alone. So encodings can be joined: where the last token of the left and
the first of the right half are such neighbours, they are put side by side; else the tokens around the border are
encoded anew, in windows that grow on the side where the token just outside does not fit yet. Once both fit, all
others are proved to stay.

A null text, and an empty one, has no tokens. Texts are whole; a match of any length is halved down to LEAF bytes, so
that one long unbroken match costs n log n. Rows are independent: repeated rows and ids give a row each. Columns named
like the outputs are replaced, others are kept; an empty table gives no rows. Decoding a null list gives no bytes; an
id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm import vec
from creditloom.llm.spark_util import arrow_map, table

MODEL = "byte_bpe_multi_50k.tiktoken"
LEAF = 8  # bytes that are merged without halving
TOKENS_A_LEAF = 4096
REMEMBERED = 1 << 18  # matches, and windows of two tokens, that a process remembers
BATCH_BYTES = 1 << 22
NONE = 1 << 40


def fold_tree(parts: list, join: Callable):
    """The parts joined two by two, level by level."""
    while len(parts) > 1:
        pairs = [join(parts[k], parts[k + 1]) for k in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(pairs) * 2 :]
    return parts[0]


class ByteBpe:
    """Ranks of a vocabulary, which are its ids, with what a process remembers of matches, leaves and windows."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kinds: np.ndarray | None = None):
        self.ranks, self.pattern = ranks, pattern
        self.kinds = code_point_kinds() if kinds is None else kinds
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.windows: dict[tuple[int, int], list[int]] = {}
        self.known: dict[bytes, list[int]] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self._pairs = None

    def __reduce__(self):
        return ByteBpe, (self.ranks, self.pattern, self.kinds)

    def merge(self, text: bytes) -> list[int]:
        """The encoding of ``text`` by merging the best-ranked adjacent pair, the leftmost of equals, until none is left."""
        ranks, n = self.ranks, len(text)
        end = list(range(1, n + 1))  # where the symbol that begins here ends; 0 once it is swallowed
        begin = list(range(-1, n))  # where the symbol that ends here begins
        heap = []

        def offer(i: int) -> None:
            if end[i] < n and (rank := ranks.get(text[i : end[end[i]]])) is not None:
                heapq.heappush(heap, (rank, i, end[end[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, to = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != to:
                continue
            end[i], end[mid], begin[to] = to, 0, i
            if i:
                offer(begin[i])
            offer(i)
        return [ranks[text[i : end[i]]] for i in range(n) if end[i]]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the token that each two tokens make, NONE where there is none."""
        if self._pairs is None:
            cuts = [(x, y, rank) for token, rank in self.ranks.items() for k in range(1, len(token)) if (x := self.ranks.get(token[:k])) is not None and (y := self.ranks.get(token[k:])) is not None]
            x, y, rank = np.array(cuts, np.uint64).reshape(-1, 3).T
            self._pairs = vec.HashIndex(vec.mix(x << vec.U64(32) | y)), np.append(rank.astype(np.int64), NONE)
        index, rank = self._pairs
        return rank[index.find(vec.mix(a.astype(np.uint64) << vec.U64(32) | b.astype(np.uint64)))]

    def merge_leaves(self, texts: list[bytes]) -> list[list[int]]:
        """The encodings of short byte strings, all merging at once: one merge of each string a turn."""
        size = np.array([len(t) for t in texts])
        byte = np.array([self.ranks.get(bytes([k]), 0) for k in range(256)])
        flat = byte[np.frombuffer(b"".join(texts), np.uint8)]
        column = np.arange(LEAF)
        tokens = np.zeros((len(texts), LEAF + 1), np.int64)
        tokens[:, :LEAF][column < size[:, None]] = flat
        rank = np.full((len(texts), LEAF + 1), NONE)
        paired = column < size[:, None] - 1
        rank[:, :LEAF][paired] = self.pair_ranks(tokens[:, :LEAF][paired], tokens[:, 1:][paired])
        rows = np.arange(len(texts))
        while len(rows):
            at = rank[rows].argmin(axis=1)
            best = rank[rows, at]
            open_ = best < NONE
            rows, at, best = rows[open_], at[open_], best[open_]
            after = np.minimum(column + (column > at[:, None]), LEAF)  # all behind the merged pair move up
            rest = tokens[rows]
            rest[np.arange(len(rows)), at] = best
            tokens[rows, :LEAF] = np.take_along_axis(rest, after, axis=1)
            rank[rows, :LEAF] = np.take_along_axis(rank[rows], after, axis=1)
            size[rows] -= 1
            for near, there in ((at - 1, at > 0), (at, at < size[rows] - 1)):
                rank[rows[~there], np.maximum(near[~there], 0)] = NONE if near is at else rank[rows[~there], 0]
                rank[rows[there], near[there]] = self.pair_ranks(tokens[rows[there], near[there]], tokens[rows[there], near[there] + 1])
        return [row[:n] for row, n in zip(tokens.tolist(), size.tolist(), strict=True)]

    def window(self, a: int, b: int) -> list[int]:
        """The encoding of the bytes of two tokens: these two, if they can be neighbours."""
        found = self.windows.get((a, b))
        if found is None:
            if len(self.windows) >= REMEMBERED:
                self.windows.clear()
            found = self.windows[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b])
        return found

    def neighbours(self, a: int, b: int) -> bool:
        return self.window(a, b) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of two encoded byte strings."""
        if not left or not right:
            return left + right
        inner = self.window(left[-1], right[0])
        if inner == [left[-1], right[0]]:
            return left + right
        i = j = 1
        while True:
            stays = i == len(left) or self.neighbours(left[-i - 1], inner[0])
            follows = j == len(right) or self.neighbours(inner[-1], right[j])
            if stays and follows:
                return left[: len(left) - i] + inner + right[j:]
            i = i if stays else min(2 * i, len(left))
            j = j if follows else min(2 * j, len(right))
            inner = self.merge(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j])))

    def halves(self, text: bytes) -> list[int]:
        """The encoding of one match, whatever its length."""
        if len(text) <= LEAF:
            return self.leaves[text] if text in self.leaves else self.merge(text)
        middle = len(text) // 2
        return self.join(self.halves(text[:middle]), self.halves(text[middle:]))

    def matches(self, texts: list[bytes]) -> list[list[int]]:
        """The encodings of distinct matches of the pattern; a match that the vocabulary holds whole is one token."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
            self.leaves.clear()
        fresh = [text for text in texts if text not in known]
        known.update((text, [rank]) for text in fresh if (rank := self.ranks.get(text)) is not None)
        fresh = [text for text in fresh if text not in known]
        leaves = list({leaf for text in fresh for leaf in _leaves(text) if leaf not in self.leaves})
        self.leaves.update(zip(leaves, self.merge_leaves(leaves), strict=True))
        known.update((text, self.halves(text)) for text in fresh)
        return [known[text] for text in texts]

    def encode(self, text: str | None) -> list[int]:
        """The tokens of a whole text."""
        return next(encode_column(self, pa.array([text or ""])))[2].tolist()

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that ids stand for."""
        if not len(ids):
            return b""
        leaves = (ids[k : k + TOKENS_A_LEAF] for k in range(0, len(ids), TOKENS_A_LEAF))
        return fold_tree([b"".join(map(self.bytes_of.__getitem__, leaf)) for leaf in leaves], lambda a, b: a + b)


def _leaves(text: bytes) -> list[bytes]:
    """The leaves of a match that is halved down to LEAF bytes."""
    if len(text) <= LEAF:
        return [text]
    middle = len(text) // 2
    return _leaves(text[:middle]) + _leaves(text[middle:])


LETTER, NUMBER, BLANK, OTHER = range(4)


@cache
def code_point_kinds() -> np.ndarray:
    """For each code point whether the pattern takes it for a letter, a number, white space or something else.

    Regular expressions differ in their version of Unicode, so it is the library's own that are asked: an encoding of
    single bytes whose pattern finds one kind gives the bytes of just these characters."""
    kind = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([k]): k for k in range(256)}
    for number, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        found = bytes(tiktoken.Encoding("kind", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        kind[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = number
    return kind


def match_starts(codes: np.ndarray, begin: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the matches of public_tokenizers.PATTERN begin in texts one after the other, which begin at ``begin``.

    Stretches of one kind are matches. Of white space before something else the last character is a match of its own, or
    the head of what follows if it is a blank; an apostrophe alone takes certain endings from the letters after it."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds[codes]
    first = np.zeros(n + 1, bool)
    first[begin] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    head = np.flatnonzero(start)
    end = np.append(head[1:], n)
    space = kind[head] == BLANK
    leads = space & ~first[end]  # something else follows in the same text
    last = end[leads] - 1
    start[last] = True
    ahead = last[codes[last] == 32]
    start[ahead + 1] = False  # the blank heads the next match
    quote = head[(kind[head] == OTHER) & (end - head == 1) & ~first[end]]
    quote = quote[(codes[quote] == 39) & start[quote]]
    text_end = begin[np.searchsorted(begin, quote, side="right")]
    for ending in ("re", "ve", "ll", "s", "t", "m", "d"):
        k = len(ending)
        fits = quote + k < text_end
        for step, letter in enumerate(ending, 1):
            fits &= codes[np.minimum(quote + step, n - 1)] == ord(letter)
        taken = quote[fits]
        start[taken + 1] = False
        rest = taken + k + 1
        rest = rest[rest < n]
        start[rest[kind[rest] == LETTER]] = True
        quote, text_end = quote[~fits], text_end[~fits]
    return np.flatnonzero(start | first[:n])


def encode_column(model: ByteBpe, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, end row, ids, and where each row's ids begin."""
    for i, j, buf, offs in vec.slices(column, BATCH_BYTES):
        text = buf.tobytes().decode()
        lead = np.flatnonzero((buf & 0xC0) != 0x80)  # the byte at which each character begins
        chars = np.searchsorted(lead, offs)
        if model.pattern == public_tokenizers.PATTERN:
            starts = match_starts(np.frombuffer(text.encode("utf-32-le"), np.uint32), chars, model.kinds)
        else:
            starts = np.array([a + m.start() for a, b in zip(chars[:-1], chars[1:], strict=True) for m in regex.finditer(model.pattern, text[a:b])], np.int64)
        cuts = np.append(lead[starts], len(buf))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(buf)]).dictionary_encode()
        coded = model.matches(words.dictionary.to_pylist())
        which = words.indices.to_numpy()
        size = np.array([len(x) for x in coded], np.int64)
        flat = np.fromiter(chain.from_iterable(coded), np.int32, size.sum())
        head, per = np.cumsum(size) - size, size[which]
        end = np.concatenate([[0], np.cumsum(per)])
        ids = flat[np.repeat(head[which] - end[:-1], per) + np.arange(end[-1])]
        yield i, j, ids, end[np.searchsorted(starts, chars)]


def load(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """The vocabulary of a file of lines "base64 of the bytes, rank"."""
    with open(path or public_tokenizers.path(MODEL)) as lines:
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in map(str.split, lines)}, pattern)


def encode(docs: DataFrame, model: ByteBpe, text_col: str = "text", ids_out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as an array."""
    docs = docs.drop(ids_out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*docs.columns, ids_out]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, ids, begin in encode_column(shared.value, batch.column(at)):
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), lists], names=names)

    return arrow_map(docs, run, T.StructType([*docs.schema.fields, T.StructField(ids_out, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, model: ByteBpe, ids_col: str = "ids", bytes_out: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that their ids stand for."""
    rows = rows.drop(bytes_out)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [*rows.columns, bytes_out]
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and not 0 <= flat.min() <= flat.max() < len(shared.value.bytes_of):
                raise ValueError(f"ids outside the vocabulary of {len(shared.value.bytes_of)}")
            end = np.cumsum([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()])
            back = [shared.value.decode(flat[a:b].tolist()) for a, b in zip([0, *end[:-1]], end, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], names=names)

    return arrow_map(rows, run, T.StructType([*rows.schema.fields, T.StructField(bytes_out, T.BinaryType())]))


def op11_byte_bpe(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    model = load(model_path)
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text"), model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
