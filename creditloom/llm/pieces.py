"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut into words that no piece crosses: at blanks, which belong to the word that follows, and around
characters that occur in no longer piece. Equal words are encoded once a batch. Words of equal length advance
together, one character at a time: the hash of each substring that ends there probes the sorted hashes of all pieces,
and the best piece's number is stored as the backpointer.

For a unigram model the best is the one with the highest sum of scores. For a BPE model the search must give what
merging by priority gives. There a prefix has one last piece only: the one that is compatible with the last piece of
the prefix before it, where two adjacent pieces are compatible if undoing their merges, latest first, shows no earlier
merge across their border. The test is vectorised too, so the maximum is over the lengths of compatible pieces.

Words of over LONGEST characters, and words after several blanks, are merged one by one with a priority queue.
Characters without a piece become pieces of their bytes, or the unknown piece in a model without those. Decoding
gives the text back, except that the blank's own symbol U+2581 comes back as a blank. A null or empty text has no
pieces. Rows are independent; other columns are kept by :func:`encode`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditloom.llm import vec
from creditloom.llm.spark_util import arrow_map, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = 0x2581
LONGEST = 48
BATCH_BYTES = 1 << 20
CACHED = 300_000
MEMO = 1 << 20


@dataclass
class PieceModel:
    """Pieces in inner order (single characters first, then by priority), and the tables that the search probes."""

    bpe: bool
    text: list[str]
    outer: np.ndarray  # inner number -> the model's id, -1 for a character that is no piece
    score: np.ndarray
    keys: np.ndarray  # hash of each piece
    size: np.ndarray  # characters of each piece
    left: np.ndarray  # BPE: the two parts of the last merge; a single character is its own part
    right: np.ndarray
    byte_ids: np.ndarray  # id of each byte, -1 without byte pieces
    unknown: int
    joined: np.ndarray  # code points that occur in longer pieces
    bytes_of: list[bytes]  # for each id of the model, the bytes it stands for
    _ready: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_ready": {}}

    def tables(self) -> dict:
        """What a process builds once from the plain tables."""
        if not self._ready:
            number = {t: i for i, t in enumerate(self.text)}
            pair = np.flatnonzero(self.left != np.arange(len(self.left)))
            joins = np.zeros(0x110000, bool)
            joins[self.joined] = True
            lengths = np.array([len(b) for b in self.bytes_of])
            at = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
            single = np.full(0x110000, -1, np.int64)
            for i in np.flatnonzero(self.size == 1):
                single[ord(self.text[i])] = i
            self._ready |= {
                "number": number, "endings": _endings(self), "memo": (np.full(MEMO, -1, np.int64), np.zeros(MEMO, bool)), "pairs": vec.HashIndex(_pair_key(self.left[pair], self.right[pair])), "merged": pair,
                "joins": joins, "lengths": lengths, "at": at, "flat": flat, "single": single, "longest": int(self.size.max()), "slow": {},
            }
        return self._ready


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return vec.mix(a.astype(vec.U64) << vec.U64(32) | b.astype(vec.U64))


def _hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Hash of each span of code points, given the running sums of the text."""
    h = (run[ends] - run[starts]) * vec._powers(len(codes))[1][starts]
    h ^= (ends - starts).astype(vec.U64) * vec.U64(0xD6E8FEB86659FD93)
    return vec.mix(h)


def _running(codes: np.ndarray) -> np.ndarray:
    run = np.zeros(len(codes) + 1, vec.U64)
    np.cumsum((codes.astype(vec.U64) + vec.U64(1)) * vec._powers(len(codes))[0][: len(codes)], out=run[1:])
    return run


def merge(symbols: list[str], priority: dict[str, int], stop: str | None = None) -> list[str]:
    """Byte-pair merging: the adjacent pair whose join has the best priority (the leftmost of equals), again and again.

    ``stop`` leaves out the merge that would give it."""
    n = len(symbols)
    text = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (p := priority.get(text[i] + text[j])) is not None and text[i] + text[j] != stop:
            heapq.heappush(heap, (p, i, text[i], text[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if text[i] != a or j >= n or text[j] != b or not a:
            continue
        text[i], text[j] = a + b, ""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [t for t in text if t]


def build(pieces: list[tuple[str, float]], ids: list[int], bpe: bool, byte_ids: dict[int, int], unknown: int, texts: dict[int, bytes]) -> PieceModel:
    """A model from its ordinary pieces (text, score) and their ids; ``texts`` gives the bytes of every id."""
    if any("▁" in p[1:] and p.strip("▁") for p, _ in pieces):
        raise ValueError("a piece holds a blank after another character")
    known = {p: (s, i) for (p, s), i in zip(pieces, ids, strict=True)}
    chars = sorted({c for p in known for c in p})
    several = sorted((p for p in known if len(p) > 1), key=lambda p: (-known[p][0], known[p][1]))
    text = chars + several
    number = {t: i for i, t in enumerate(text)}
    left = np.arange(len(text))
    right = np.arange(len(text))
    usable = np.ones(len(text), bool)
    if bpe:
        rank = {p: (k if known[p][0] > -1e8 else len(several)) for k, p in enumerate(several)}
        for p in several:
            parts = merge(list(p), rank, stop=p)
            if len(parts) == 2 and parts[0] in number and parts[1] in number and merge(list(p), rank) == [p]:
                left[number[p]], right[number[p]] = number[parts[0]], number[parts[1]]
            else:
                usable[number[p]] = False
    codes = np.array([ord(c) for t in text for c in t], np.int64)
    size = np.array([len(t) for t in text])
    ends = np.cumsum(size)
    keys = np.concatenate([_hashes(c, np.zeros(1, np.int64), np.array([len(c)]), _running(c)) for c in np.split(codes, ends[:-1])])
    keys[~usable] = vec.mix(np.arange(len(text), dtype=vec.U64) + vec.U64(1 << 60))[~usable]  # never found
    by_byte = np.full(256, -1, np.int64)
    for b, i in byte_ids.items():
        by_byte[b] = i
    outer = np.array([known[t][1] if t in known else -1 for t in text])
    score = np.array([known[t][0] if t in known else -np.inf for t in text])
    joined = np.array(sorted({ord(c) for p in several for c in p}), np.int64)
    return PieceModel(bpe, text, outer, score, keys, size, left, right, by_byte, unknown, joined, [texts[i] for i in range(len(texts))])


def load(path: str = MODEL) -> PieceModel:
    """Read a SentencePiece model file with the sentencepiece library."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    n = lib.get_piece_size()
    plain, ids, byte_ids, texts = [], [], {}, {}
    for i in range(n):
        piece = lib.id_to_piece(i)
        texts[i] = piece.replace("▁", " ").encode()
        if lib.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            texts[i] = bytes([int(piece[3:5], 16)])
        elif lib.is_control(i) or lib.is_unknown(i):
            texts[i] = b""
        elif not lib.is_unused(i):
            plain.append((piece, lib.get_score(i)))
            ids.append(i)
    # of the two kinds, only a BPE model numbers its scores by rank: whole and falling by one
    scores = sorted((s for _, s in plain if s > -1e8), reverse=True)
    bpe = all(s == int(s) for s in scores) and len(set(scores)) == len(scores)
    return build(plain, ids, bpe, byte_ids, lib.unk_id(), texts)


def compatible(model: PieceModel, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For adjacent pieces (a, b), whether merging by priority could leave a border between them.

    The process remembers the answers for MEMO pairs; a later pair takes the place of an earlier one."""
    t = model.tables()
    known, answer = t["memo"]
    pair = a << 32 | b
    slot = ((pair.view(vec.U64) * vec.U64(0x9E3779B97F4A7C15)) >> vec.U64(64 - MEMO.bit_length() + 1)).astype(np.int64)
    ok = answer[slot]
    miss = np.flatnonzero(known[slot] != pair)
    if len(miss):
        ok[miss] = _compatible(model, a[miss], b[miss])
        known[slot[miss]] = pair[miss]  # of two pairs with one slot the last stays, in both arrays
        answer[slot[miss]] = ok[miss]
    return ok


def _compatible(model: PieceModel, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    t = model.tables()
    ok = np.ones(len(a), bool)
    a, b, limit = a.copy(), b.copy(), np.full(len(a), len(model.text) + 1)
    todo = np.arange(len(a))
    while len(todo):
        x, y, lim = a[todo], b[todo], limit[todo]
        found = t["pairs"].find(_pair_key(x, y))
        earlier = np.where(found >= 0, t["merged"][found], len(model.text) + 2) < lim
        ok[todo[earlier]] = False
        todo, x, y = todo[~earlier], x[~earlier], y[~earlier]
        if not len(todo):
            break
        # undo the later of the two pieces' merges; a single character has none, then the other's
        undo_a = (x > y) & (model.right[x] != x) | (model.left[y] == y)
        done = undo_a & (model.right[x] == x)
        limit[todo] = np.where(undo_a, x, y + 1)
        a[todo] = np.where(undo_a, model.right[x], x)
        b[todo] = np.where(undo_a, y, model.left[y])
        todo = todo[~done]
    return ok


def _endings(model: PieceModel) -> tuple[vec.HashIndex, np.ndarray]:
    """All endings of pieces by hash, and the piece that each is, -1 where it is only the end of longer ones."""
    size = model.size
    end = np.repeat(np.cumsum(size), size)
    length = np.concatenate([np.arange(1, n + 1) for n in size])
    codes = np.array([ord(c) for text in model.text for c in text], np.int64)
    keys = np.unique(np.concatenate([_hashes(codes, end - length, end, _running(codes)), model.keys]))
    return vec.HashIndex(keys), vec.HashIndex(model.keys).find(keys)


def viterbi(model: PieceModel, codes: np.ndarray, run: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (inner numbers) of the words of ``n`` characters at ``starts``: flat, and how many each has."""
    t = model.tables()
    endings, piece_of = t["endings"]
    words = len(starts)
    last = np.full((n + 1, words), -1, np.int64)
    best = np.full((n + 1, words), -np.inf)
    best[0] = 0
    for i in range(1, n + 1):
        found = []  # by size: the words that have a piece of that size here, and the piece
        live = np.arange(words)
        for size in range(1, min(i, t["longest"]) + 1):
            ending = endings.find(_hashes(codes, starts[live] + (i - size), starts[live] + i, run))
            live, ending = live[ending >= 0], ending[ending >= 0]  # no piece ends in more than this
            if not len(live):
                break
            piece = piece_of[ending]
            found.append((size, live[piece >= 0], piece[piece >= 0]))
        for size, at, piece in reversed(found):
            if model.bpe:
                fit = last[i, at] < 0
                if i > size:
                    fit &= last[i - size, at] >= 0
                at, piece = at[fit], piece[fit]
                if i > size:
                    fit = compatible(model, last[i - size, at], piece)
                    at, piece = at[fit], piece[fit]
                last[i, at] = piece
            else:
                total = best[i - size, at] + model.score[piece]
                better = total > best[i, at]
                best[i, at[better]] = total[better]
                last[i, at[better]] = piece[better]
    out = np.full((n, words), -1, np.int64)
    place = np.full(words, n)
    steps = 0
    while place.any():
        live = np.flatnonzero(place)
        piece = last[place[live], live]
        out[steps, live] = piece
        place[live] -= model.size[piece]
        steps += 1
    flat = out[:steps][::-1].T.ravel()
    count = (out[:steps] >= 0).sum(axis=0)
    return flat[flat >= 0], count


def _slow(model: PieceModel, word: str) -> np.ndarray:
    """Ids of one long word, or one after several blanks."""
    t = model.tables()
    if word not in t["slow"]:
        if model.bpe:
            if "rank" not in t:
                n = len(model.text)
                t["rank"] = {p: (i if model.score[i] > -1e8 else n) for p, i in t["number"].items() if len(p) > 1 and model.outer[i] >= 0}
            parts = [t["number"].get(p, -1) for p in merge(list(word), t["rank"])]
            found = np.array(parts)
        else:
            codes = np.array([ord(c) for c in word], np.int64)
            found, _ = viterbi(model, codes, _running(codes), np.zeros(1, np.int64), len(codes))
        if len(t["slow"]) > 50_000:
            t["slow"].clear()
        t["slow"][word] = _outer(model, found, word)
    return t["slow"][word]


def _outer(model: PieceModel, inner: np.ndarray, word: str) -> np.ndarray:
    """The model's ids of pieces; characters without a piece become bytes."""
    out, at = [], 0
    for p in inner:
        if p >= 0 and model.outer[p] >= 0:
            out.append(np.array([model.outer[p]]))
        else:
            out.append(_fallback(model, word[at]))
        at += model.size[p] if p >= 0 else 1
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _fallback(model: PieceModel, char: str) -> np.ndarray:
    return model.byte_ids[np.frombuffer(char.encode("utf-8", "replace"), np.uint8)] if model.byte_ids[0] >= 0 else np.array([model.unknown])


def _ragged(heads: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of all members of runs, one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(heads - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _encode_words(model: PieceModel, codes: np.ndarray, run: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words at ``first``, one word after the other, and how many each has."""
    t = model.tables()
    blank = codes == BLANK
    slow = blank[first] & (size > 1) & blank[np.minimum(first + 1, len(codes) - 1)] | (size > LONGEST)
    ids_of: list[np.ndarray] = [np.zeros(0, np.int64)]
    owner: list[np.ndarray] = [np.zeros(0, np.int64)]
    for length in np.unique(size[~slow]):
        at = np.flatnonzero((size == length) & ~slow)
        if length == 1:
            flat, count = t["single"][codes[first[at]]], np.ones(len(at), np.int64)
        else:
            flat, count = viterbi(model, codes, run, first[at], int(length))
        outer = np.where(flat >= 0, model.outer[flat], -1)
        mine = np.repeat(at, count)
        if (outer < 0).any():  # characters without a piece, each of which is a word or part of one
            width = np.where(flat >= 0, model.size[flat], 1)
            offset = np.cumsum(width) - width
            word_at = np.repeat(np.cumsum(count) - count, count)
            parts = [np.array([o]) if o >= 0 else _fallback(model, chr(codes[first[m] + offset[k] - offset[word_at[k]]])) for k, (o, m) in enumerate(zip(outer, mine, strict=True))]
            mine = np.repeat(mine, [len(p) for p in parts])
            outer = np.concatenate(parts)
        ids_of.append(outer)
        owner.append(mine)
    for u in np.flatnonzero(slow):
        ids = _slow(model, "".join(map(chr, codes[first[u] : first[u] + size[u]])))
        ids_of.append(ids)
        owner.append(np.full(len(ids), u))
    ids, owner = np.concatenate(ids_of), np.concatenate(owner)
    return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(first))


def _cached_words(model: PieceModel, codes: np.ndarray, run: np.ndarray, unique: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_encode_words`, with the process's first CACHED words kept for the next runs; ``unique`` are their hashes."""
    t = model.tables()
    cache = t.setdefault("cache", {"index": vec.HashIndex(np.zeros(0, vec.U64)), "keys": np.zeros(0, vec.U64), "counts": np.zeros(0, np.int64), "heads": np.zeros(0, np.int64), "ids": np.zeros(0, np.int32)})
    hit = cache["index"].find(unique)
    miss = np.flatnonzero(hit < 0)
    new_ids, new_counts = _encode_words(model, codes, run, first[miss], size[miss])
    counts = np.zeros(len(unique), np.int64)
    known = np.flatnonzero(hit >= 0)
    counts[known] = cache["counts"][hit[known]]
    counts[miss] = new_counts
    heads = np.cumsum(counts) - counts
    ids = np.empty(counts.sum(), np.int64)
    ids[_ragged(heads[known], counts[known])] = cache["ids"][_ragged(cache["heads"][hit[known]], counts[known])]
    ids[_ragged(heads[miss], new_counts)] = new_ids
    if len(miss) and len(cache["keys"]) < CACHED:
        keys = np.concatenate([cache["keys"], unique[miss]])
        all_counts = np.concatenate([cache["counts"], new_counts])
        cache |= {"index": vec.HashIndex(keys), "keys": keys, "counts": all_counts, "heads": np.cumsum(all_counts) - all_counts, "ids": np.concatenate([cache["ids"], new_ids.astype(np.int32)])}
        t["cache"] = cache
    return ids, counts


def encode_column(model: PieceModel, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, end row, ids, and where each row's ids begin."""
    t = model.tables()
    for i, j, buf, offs in vec.slices(column, BATCH_BYTES):
        codes = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offs]
        filled = np.flatnonzero(np.diff(heads))
        codes = np.insert(np.where(codes == 32, BLANK, codes), heads[:-1][filled], BLANK).astype(np.int64)
        begin = heads + np.concatenate([[0], np.cumsum(np.diff(heads) > 0)])
        n = len(codes)
        if not n:
            yield i, j, np.zeros(0, np.int64), np.zeros(j - i + 1, np.int64)
            continue
        blank = codes == BLANK
        alone = ~t["joins"][codes] & ~blank
        new = np.ones(n, bool)
        new[1:] = (blank[1:] & ~blank[:-1]) | alone[1:] | alone[:-1]
        new[begin[:-1][filled]] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        run = _running(codes)
        unique, where, which = np.unique(_hashes(codes, starts, ends, run), return_index=True, return_inverse=True)
        first, size = starts[where], (ends - starts)[where]
        ids, counts = _cached_words(model, codes, run, unique, first, size)
        head = np.concatenate([[0], np.cumsum(counts)])
        per_word = counts[which]
        word_head = np.concatenate([[0], np.cumsum(per_word)])
        gather = _ragged(head[which], per_word)
        yield i, j, ids[gather], word_head[np.searchsorted(starts, begin)]


def decode_rows(model: PieceModel, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each row's text, without the first blank, and where each row's begin."""
    t = model.tables()
    size = t["lengths"][ids].copy()
    skip = np.zeros(len(ids), np.int64)
    heads = begin[:-1][np.diff(begin) > 0]
    lead = heads[(size[heads] > 0) & (t["flat"][np.minimum(t["at"][ids[heads]], len(t["flat"]) - 1)] == 32)]
    skip[lead] = 1
    size[lead] -= 1
    end = np.concatenate([[0], np.cumsum(size)])
    gather = np.repeat(t["at"][ids] + skip - end[:-1], size) + np.arange(end[-1])
    return t["flat"][gather], end[begin]


def encode(docs: DataFrame, model: PieceModel, text_col: str = "text", ids_out: str = "ids", check_out: str | None = None) -> DataFrame:
    """``docs`` with the pieces of each text; ``check_out`` names a flag telling whether decoding gives the text back."""
    docs = docs.drop(ids_out, *([check_out] if check_out else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)
    extra = [T.StructField(ids_out, T.ArrayType(T.IntegerType()))] + ([T.StructField(check_out, T.BooleanType())] if check_out else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            for i, j, ids, begin in encode_column(shared.value, column):
                cols = [c.slice(i, j - i) for c in batch.columns] + [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()))]
                if check_out:
                    ((_, _, raw, offs),) = list(vec.slices(column.slice(i, j - i), 1 << 62))
                    back, ends = decode_rows(shared.value, ids, begin)
                    same = np.diff(ends) == np.diff(offs)
                    if same.all():
                        wrong = np.flatnonzero(back != raw)
                        same[np.searchsorted(offs, wrong, side="right") - 1] = False
                    else:
                        same = np.array([back[ends[r] : ends[r + 1]].tobytes() == raw[offs[r] : offs[r + 1]].tobytes() for r in range(j - i)])
                    cols.append(pa.array(same))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *(f.name for f in extra)])

    return arrow_map(docs, run, T.StructType([*docs.schema.fields, *extra]))


def decode(rows: DataFrame, model: PieceModel, ids_col: str = "ids", text_out: str = "text") -> DataFrame:
    """``rows`` with the text that its pieces stand for, in place of any column of that name."""
    rows = rows.drop(text_out)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = rows.columns
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            size = np.array([0 if x is None else len(x) for x in lists])
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            back, ends = decode_rows(shared.value, ids, np.concatenate([[0], np.cumsum(size)]))
            text = [back[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*names, text_out])

    return arrow_map(rows, run, T.StructType([*rows.schema.fields, T.StructField(text_out, T.StringType())]))


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = MODEL) -> DataFrame:
    from pyspark.sql import functions as F

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, load(model_path), check_out="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")
