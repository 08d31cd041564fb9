"""Texts as sets of words: hashing, canonical texts and their 2-grams, bounds; shared by the problems on near-duplicates.

Words are runs of letters and digits, lower-cased, accents removed; each is a 64-bit number. A set's canonical text has its
words in one order for all sets, rarest first, between a begin and an end sign. Sets A and B of c common and d differing
words have at least c + 1 - d 2-grams of their canonical texts in common: of the c + 1 steps from one common word (or
sign) to the next, each differing word breaks one at most. So a similarity asks for a number of common 2-grams, of which a
part must be among each set's rarest ones (its head), whatever the order.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.plans.ship import ship
from clipfold.plans.small import join_small

#: Sizes of the tables of frequency levels: about an entry a document, within these bounds. A table that is too small for a
#: vocabulary makes heads less rare; it loses nothing.
LEAST_LEVELS, MOST_LEVELS = 1 << 20, 1 << 22
CACHE_WORDS, CACHE_CHARS = 500_000, 40
WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile("[" + "".join(chr(c) for c in range(0x300, 0x20000) if unicodedata.combining(chr(c))) + "]+")


_LATIN_MARKS = re.compile("[\u0300-\u036f]+")
#: UTF-8 bytes of marks that stand apart in Latin text, and of other scripts and their marks.
_LATIN_APART, _OTHER = re.compile(rb"[\xcc\xcd]"), re.compile(rb"[\xd2\xd6-\xe1\xe3-\xff]|\xe2[\x83\xb3\xb5\xb7]")


def fold(text: str) -> str:
    text = text.lower()
    if text.isascii():
        return text
    marks = _MARKS if _OTHER.search(text.encode("utf-8", "surrogatepass")) else _LATIN_MARKS
    return marks.sub("", unicodedata.normalize("NFD", text))


def plain_words(text: str) -> list[str]:
    """Words of ``text``, lower-cased but with their accents unless those stand apart from their letters."""
    text = text.lower()
    if not text.isascii():
        raw = text.encode("utf-8", "surrogatepass")
        if _LATIN_APART.search(raw) or _OTHER.search(raw):
            text = fold(text)
    return WORD.findall(text)


class Hasher:
    """Sorted numbers of distinct words; accents are removed once per word, not per text."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        seen, out = self.seen, set()
        for w in set(words):
            h = seen.get(w)
            if h is None:
                h = number(fold(w))
                if len(seen) > CACHE_WORDS:
                    seen.clear()
                seen[w] = h
            out.add(h)
        return sorted(out)


class Tokens:
    """Numbers of the words of many texts at once: what stands between ASCII white space is looked at once a batch, not once a text."""

    def __init__(self):
        self.seen: dict[str, tuple[int, ...]] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sorted numbers of the distinct words of each text, one text after the other, and how many each has."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        tokens, n = pc.dictionary_encode(split.flatten()), np.diff(split.offsets.to_numpy())
        of = [self.words(t) for t in tokens.dictionary.to_pylist()]
        size = np.fromiter(map(len, of), np.int64, len(of))
        known, rank = np.unique(np.fromiter(chain.from_iterable(of), np.int64, int(size.sum())), return_inverse=True)
        end, at = np.cumsum(size), tokens.indices.to_numpy()
        which, pos = expand((end - size)[at], end[at])
        key = np.sort((np.repeat(np.arange(len(n)), n)[which] << 32) | rank[pos])
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        return known[key & 0xFFFFFFFF], np.bincount(key >> 32, minlength=len(n))

    def words(self, token: str) -> tuple[int, ...]:
        got = self.seen.get(token)
        if got is None:
            got = tuple(number(fold(w)) for w in plain_words(token))
            if len(token) <= CACHE_CHARS:
                if len(self.seen) > CACHE_WORDS:
                    self.seen.clear()
                self.seen[token] = got
        return got


def number(word: str) -> int:
    """The number of a folded word."""
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def word_sets(df: DataFrame, keep: list[str], text_col: str, clean=None) -> DataFrame:
    """The columns ``keep``, ``k1, k2`` (128 bits of the set) and ``words ARRAY<BIGINT>``, sorted and distinct; rows without a word are left out.

    ``clean`` may change the folded text first, such as to take a publication's name off a title.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tokens = Hasher(), Tokens()
        for b in batches:
            texts = b.column(len(keep))
            if clean:
                sets = [hasher(WORD.findall(clean(fold(t)))) if t else [] for t in texts.to_pylist()]
                flat, lens = np.fromiter(chain.from_iterable(sets), np.int64), np.fromiter(map(len, sets), np.int64, len(sets))
            else:
                flat, lens = tokens(texts)
            rows, offsets = np.flatnonzero(lens), np.concatenate([[0], np.cumsum(lens[lens > 0])])
            data, ends = memoryview(flat), offsets.tolist()
            k = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[i:j]) for i, j in zip(ends, ends[1:])]), np.int64).reshape(-1, 2)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            kept = pa.array(rows)
            yield pa.RecordBatch.from_arrays([*(b.column(j).take(kept) for j in range(len(keep))), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), lists], names=[*keep, "k1", "k2", "words"])

    ship(df.sparkSession)
    src = df.select(*keep, F.col(text_col).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1])
    return src.mapInArrow(run, f"{fields}, k1 bigint, k2 bigint, words array<bigint>")


def flat_lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(), np.diff(col.offsets.to_numpy())


def _levels(df: DataFrame, things, size: int) -> np.ndarray:
    """How often ``things(words, lens)`` occur in the sets of ``df`` (``words``), by hash bucket: a table of ``size`` frequency
    levels, eight to a doubling; 0 for what is in a single document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.int64)
        for b in batches:
            table += np.bincount(bucket(things(*flat_lists(b.column(0))), size), minlength=size)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["b", "n"])

    ship(df.sparkSession)
    counts = df.select("words").mapInArrow(run, "b bigint, n bigint").groupBy("b").agg(F.sum("n").alias("n")).where("n > 1")
    level = F.least(F.ceil(8 * F.log2("n")), F.lit(255)) - 128  # five bytes an entry on its way to the driver
    rows = counts.select(F.col("b").cast("int").alias("b"), level.cast("tinyint").alias("level")).toArrow()
    out = np.zeros(size, np.uint8)
    out[rows["b"].to_numpy()] = (rows["level"].to_numpy().astype(np.int16) + 128).astype(np.uint8)
    return out


def bucket(things: np.ndarray, size: int) -> np.ndarray:
    return (things & (size - 1)).astype(np.int64)


def short(words: np.ndarray) -> np.ndarray:
    """Words as 32-bit numbers, for finding candidates; exact checks use the 64-bit ones."""
    return ((words >> 7) ^ (words >> 39)).astype(np.int32)


#: Signs before and after a canonical text.
BEGIN, END = 1 << 40, 1 << 41


class Order:
    """The order of words in canonical texts, and of 2-grams in heads: rarest first by tables of levels."""

    def __init__(self, words: np.ndarray, grams: np.ndarray, unseen: bool = False):
        self.words, self.grams, self.unseen = words, grams, unseen

    @staticmethod
    def fit(sets: DataFrame, unseen: bool = False) -> Order:
        """From the frequencies in ``sets``; ``unseen``: other sets will be ordered too, so what is in one set here may meet others."""
        size = 1 << int(np.clip(np.ceil(np.log2(max(sets.count(), 1))), np.log2(LEAST_LEVELS), np.log2(MOST_LEVELS)))
        words = _levels(sets, lambda w, lens: w, size)
        half = Order(words, words, unseen)
        return Order(words, _levels(sets, lambda w, lens: half.two_grams(w, lens), size), unseen)

    def canonical(self, words: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The canonical texts, one after the other: words as 32-bit numbers between the signs ``BEGIN`` and ``END``."""
        doc = np.repeat(np.arange(len(lens)), lens)
        w = short(words).astype(np.int64) & 0xFFFFFFFF
        level = self.words[bucket(words, len(self.words))].astype(np.int64)
        if len(lens) < 1 << 23:
            w = np.sort((doc << 40) | (level << 32) | w) & 0xFFFFFFFF
        else:
            w = w[np.lexsort((w, level, doc))]
        total = len(w) + 2 * len(lens)
        text, starts = np.full(total, BEGIN, np.int64), np.cumsum(lens + 2) - (lens + 2)
        text[np.arange(len(w)) + 2 * doc + 1] = w
        text[starts + lens + 1] = END
        return text

    def two_grams(self, words: np.ndarray, lens: np.ndarray, text: np.ndarray | None = None) -> np.ndarray:
        """2-grams of the canonical texts (``text``, if known), with the signs one more than words, set by set."""
        text = self.canonical(words, lens) if text is None else text
        inner = np.ones(len(text), bool)
        inner[np.cumsum(lens + 2) - 1] = False
        at = np.flatnonzero(inner)
        return mix(text[at].view(np.uint64), text[at + 1].view(np.uint64)).view(np.int64)

    def heads(self, words: np.ndarray, lens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """2-grams of the heads, the set of each, and its level; those that no other set has are left out."""
        return self.places(words, lens, threshold)[:3]

    def places(self, words: np.ndarray, lens: np.ndarray, threshold: float, text: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """As ``heads``, and where among all 2-grams of the texts each stands."""
        grams = self.two_grams(words, lens, text)
        n = lens + 1
        doc = np.repeat(np.arange(len(lens)), n)
        lv = self.grams[bucket(grams, len(self.grams))]
        if len(lens) < 1 << 20:
            key = (doc.astype(np.uint64) << np.uint64(44)) | (lv.astype(np.uint64) << np.uint64(36)) | (grams.view(np.uint64) >> np.uint64(28))
            order = np.argsort(key)
            key = key[order]
            tied = bool((key[1:] == key[:-1]).any())
        if len(lens) >= 1 << 20 or tied:  # by the whole 2-gram
            order = np.lexsort((grams.view(np.uint64), lv, doc))
        starts = np.cumsum(n) - n
        _, pos = expand(starts, starts + n - common_grams(lens, threshold) + 1)
        pos = order[pos]
        if not self.unseen:
            pos = pos[lv[pos] > 0]
        return grams[pos], doc[pos], lv[pos], pos


def common_grams(n: np.ndarray, threshold: float) -> np.ndarray:
    """2-grams that a set of ``n`` words shares at least with any set of the similarity: with c words in common, the
    differing ones are at most c / threshold - c, which is worst for the smallest c."""
    c = np.ceil(threshold * n - 1e-9).astype(np.int64)
    return 2 * c - np.floor(c / threshold + 1e-9).astype(np.int64) + 1


def least_shared(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """2-grams of both heads that sets of ``a`` and ``b`` words share at least: what their sizes demand, less the more of the
    2-grams that one head leaves out."""
    c = np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9).astype(np.int64)
    return 3 * c + 1 - (a + b) - np.maximum(common_grams(a, threshold), common_grams(b, threshold)) + 1


def signatures(words: np.ndarray, lens: np.ndarray, lanes: int) -> np.ndarray:
    """Bit signatures of ``lanes`` times 64 bits. Sets that differ in d words have signatures that differ in at most d bits."""
    out = np.zeros((len(lens), lanes), np.uint64)
    if len(words):
        place = (words >> 20).astype(np.uint64) % np.uint64(64 * lanes)
        starts = np.cumsum(lens) - lens
        bit = np.uint64(1) << (place % np.uint64(64))
        for k in range(lanes):
            out[:, k] = np.bitwise_or.reduceat(np.where(place // np.uint64(64) == k, bit, np.uint64(0)), starts)
    return out


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each range and all positions of it, for ranges [lo, hi)."""
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) ^ (b.astype(np.uint64) << np.uint64(32)) ^ (b.astype(np.uint64) >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(31))


#: Rows of a 2-gram above which its pairs are made in several tasks.
HOT = 20_000
ROW_SCHEMA = "col bigint, rec binary"


def record(lanes: int) -> np.dtype:
    """A row but for its column, packed, so that rows cost little to move: ``size`` is four times the set's words, plus its side."""
    return np.dtype([("id", "<i8"), ("sig", "<u8", (lanes,)), ("run", "<i4"), ("size", "<i4")])


def incidence(sets: DataFrame, order: Order, threshold: float, lanes: int, hot: int = HOT) -> DataFrame:
    """Rows of the incidence matrix of sets (``id, run, words``) and the 2-grams of their heads, as ``ROW_SCHEMA``.

    A 2-gram of more than ``hot`` sets is split: its rows fall into g parts, and each pair of parts is a column of its own,
    to which the rows of both go; ``side`` tells them apart (0 where a column is not such a pair), so that a pair of sets
    meets in one column only.
    """
    dtype = record(lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, lens = flat_lists(b.column(2))
            col, doc, lv = order.heads(words, lens, threshold)
            ids = b.column(0).to_numpy()
            cols, which, side = split_columns(col, lv, ids[doc], hot)
            rows = packed_sets(ids, b.column(1).to_numpy(), words, lens, lanes, dtype)[doc[which]]
            rows["size"] += side
            yield pa.RecordBatch.from_arrays([pa.array(cols), binary(rows.tobytes(), np.full(len(rows), dtype.itemsize))], names=["col", "rec"])

    ship(sets.sparkSession)
    return sets.select("id", "run", "words").mapInArrow(run, ROW_SCHEMA)


def split_columns(col: np.ndarray, lv: np.ndarray, ids: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The columns that entries of ``col`` (with their levels and the ids of their sets) go to, if more than ``hot`` sets of a
    column are split; the entry of each, and its side."""
    hot_level = int(np.ceil(8 * np.log2(hot)))
    parts = np.where(lv > hot_level, np.ceil(2.0 ** ((lv.astype(float) - hot_level) / 8)), 1).astype(np.int64)
    which, other = expand(np.zeros(len(col), np.int64), parts)
    mine = mix(ids.view(np.uint64), np.full(len(ids), 3, np.uint64)).astype(np.int64)[which] % parts[which]
    low, high = np.minimum(mine, other), np.maximum(mine, other)
    side = np.where(low == high, 0, np.where(mine == low, 1, 2)).astype(np.int32)
    return np.where(parts[which] > 1, mix(col[which].view(np.uint64), (low * 65_536 + high + 1).view(np.uint64)).view(np.int64), col[which]), which, side


def packed_sets(ids: np.ndarray, runs: np.ndarray, words: np.ndarray, lens: np.ndarray, lanes: int, dtype: np.dtype) -> np.ndarray:
    """What a row tells of its set."""
    out = np.zeros(len(lens), dtype)
    out["id"], out["sig"], out["run"], out["size"] = ids, signatures(words, lens, lanes), runs, 4 * lens
    return out


def binary(data: bytes, lens: np.ndarray) -> pa.Array:
    """A binary column from its bytes and the length of each value."""
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def by_column(rows: DataFrame) -> DataFrame:
    """Each column whole in one partition, and its rows together; in the order of their suffixes, if they have them."""
    return rows.repartition("col").sortWithinPartitions(*(c for c in ("col", "suffix") if c in rows.columns))


def column_blocks(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[pa.Table]:
    """Blocks of whole columns, of about ``rows`` rows (a column larger than that is a block of its own)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not len(b):
            continue
        if size >= rows and b.column(0)[0] != held[-1].column(0)[-1]:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        elif size >= rows:
            col = b.column(0).to_numpy()
            end = int(np.searchsorted(col, col[0], "right"))
            if end < len(b):
                yield pa.Table.from_batches([*held, b.slice(0, end)])
                held, size, b = [], 0, b.slice(end)
        held.append(b)
        size += len(b)
    if held:
        yield pa.Table.from_batches(held)


def packed_bytes(col: pa.ChunkedArray) -> np.ndarray:
    """All bytes of a binary column."""
    return flat_bytes(col)[0]


def flat_bytes(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where its values begin and end."""
    a = col.combine_chunks()
    a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
    offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if a.buffers()[2] is not None else np.empty(0, np.uint8)
    return np.ascontiguousarray(data), offsets - offsets[0]


class Block:
    """Rows of whole columns as arrays, sorted by column and size: ``col, id, run, n, side, sigs`` (a row a lane), all of a row
    (``rec``), and ``order``, where each row was in the table."""

    def __init__(self, t: pa.Table, lanes: int, dtype: np.dtype | None = None):
        col, rec = t["col"].to_numpy(), packed_bytes(t["rec"]).view(dtype or record(lanes))
        n = rec["size"] >> 2
        group = np.cumsum(np.concatenate([[True], col[1:] != col[:-1]])) << 32
        self.order = np.argsort(group + n, kind="stable")
        rec = self.rec = rec[self.order]
        self.col, self.group, self.id, self.run = col[self.order], group[self.order], np.ascontiguousarray(rec["id"]), np.ascontiguousarray(rec["run"])
        self.n, self.side = (rec["size"] >> 2).astype(np.int64), rec["size"] & 3
        self.sigs = np.ascontiguousarray(rec["sig"].T)
        self.keys = self.group + self.n

    def __len__(self) -> int:
        return len(self.col)

    def find(self, rows: np.ndarray | slice, size: np.ndarray, end: str) -> np.ndarray:
        """Where sets of ``size`` words begin (``left``) or end (``right``) in the columns of ``rows``."""
        return np.searchsorted(self.keys, self.group[rows] + size.astype(np.int64), end)


#: Rows that a row meets up to which they are looked at by index, for many rows at once; above, in tiles of a column, whose
#: near pairs are held until there are as many.
FEW, TILE, ACROSS = 24, 128, 1024
PAIRS_AT_ONCE, HELD = 4_000_000, 200_000


def meetings(ask: np.ndarray, lo: np.ndarray, hi: np.ndarray, block: Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row of ``ask`` with a row of its range [lo, hi) in the block that the bounds of sizes and
    signatures allow; in parts, so that memory doesn't follow the frequency of a column."""
    side, ns, sigs = block.side, block.n, block.sigs
    few = hi - lo <= FEW
    at, first, last = ask[few], lo[few], hi[few]
    total, s = np.cumsum(last - first), 0
    while s < len(at):
        e = max(s + 1, int(np.searchsorted(total, (total[s - 1] if s else 0) + PAIRS_AT_ONCE, "right")))
        x, y = expand(first[s:e], last[s:e])
        yield _allowed(at[s:e][x], y, side, ns, sigs, threshold)
        s = e
    at, first, last = ask[~few], lo[~few], hi[~few]
    for x, y in _near(at, first, last, block, threshold) if len(at) else ():
        ok = (first[x] <= y) & (y < last[x])
        yield _allowed(at[x[ok]], y[ok], side, ns, sigs, threshold)


def _near(at: np.ndarray, first: np.ndarray, last: np.ndarray, block: Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a place in ``at`` and a row in or about its range whose signatures differ in no more bits than their sizes
    allow, or in one more; those of many tiles at a time."""
    col, sigs = block.col, block.sigs
    assert len(sigs) <= 2  # at most 128 bits differ: bytes hold the counts, and a size at the bound of 127 allows any
    half = block.n * ((1 - threshold) / (1 + threshold)) + 1e-6
    allow, more = np.minimum(half, 127).astype(np.uint8)[at, None], np.minimum(half + 1, 127).astype(np.uint8)
    asked = [lane[at, None] for lane in sigs]
    xor, differ, part, near = (np.empty(TILE * ACROSS, t) for t in (np.uint64, np.uint8, np.uint8, bool))
    edges = np.concatenate([[0], np.flatnonzero(col[at[1:]] != col[at[:-1]]) + 1, [len(at)]])
    n = -(-np.diff(edges) // TILE)
    which, tile = expand(np.zeros(len(n), np.int64), n)
    starts = edges[which] + tile * TILE
    stops = np.minimum(starts + TILE, edges[which + 1])
    held, places, size = [], [], 0
    for i, k, begin, end in zip(starts.tolist(), stops.tolist(), np.minimum.reduceat(first, starts).tolist(), np.maximum.reduceat(last, starts).tolist()):
        for j in range(begin, end, ACROSS):
            j_end = min(end, j + ACROSS)
            shape, cells = (k - i, j_end - j), (k - i) * (j_end - j)
            x, d, e, ok = (a[:cells].reshape(shape) for a in (xor, differ, part, near))
            np.bitwise_count(np.bitwise_xor(asked[0][i:k], sigs[0][j:j_end], out=x), out=d)
            for mine, lane in zip(asked[1:], sigs[1:]):
                np.add(d, np.bitwise_count(np.bitwise_xor(mine[i:k], lane[j:j_end], out=x), out=e), out=d)
            np.less_equal(d, np.add(allow[i:k], more[j:j_end], out=e), out=ok)
            held.append(near[:cells].nonzero()[0])
            places.append((i, j, j_end - j))
            size += len(held[-1])
            if size >= HELD:
                yield _unfolded(held, places)
                held, places, size = [], [], 0
    if held:
        yield _unfolded(held, places)


def _unfolded(held: list[np.ndarray], places: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of cells of tiles that begin at ``places`` and have so many cells in a row."""
    i, j, width = np.repeat(np.array(places, np.int64), [len(h) for h in held], axis=0).T
    x, y = np.divmod(np.concatenate(held), width)
    return x + i, y + j


def _allowed(x: np.ndarray, y: np.ndarray, side: np.ndarray, ns: np.ndarray, sigs: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    ok = similar_enough(x, y, ns, sigs, threshold)
    x, y = x[ok], y[ok]
    ok = (side[x] == 0) | (side[x] != side[y])
    return x[ok], y[ok]


PAIR_SCHEMA = "a bigint, b bigint, na int, nb int, earlier boolean, shared int"


def accumulated(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs with the 2-grams shared in all columns, those below what their sizes demand left out."""

    @F.pandas_udf("boolean")
    def enough(na: pd.Series, nb: pd.Series, shared: pd.Series) -> pd.Series:
        return pd.Series(shared.to_numpy() >= least_shared(na.to_numpy().astype(np.int64), nb.to_numpy().astype(np.int64), threshold))

    summed = pairs.groupBy("a", "b", "na", "nb", "earlier").agg(F.sum("shared").alias("shared"))
    return summed.where(enough("na", "nb", "shared")).select("a", "b", "earlier")


def similar_enough(a: np.ndarray, b: np.ndarray, ns: np.ndarray, sigs: np.ndarray, threshold: float) -> np.ndarray:
    """Whether pairs pass the bounds of their sizes and signatures; most fail in the first lane already."""
    na, nb = ns[a], ns[b]
    most = (na + nb) * ((1 - threshold) / (1 + threshold)) + 1e-6
    d = np.bitwise_count(sigs[0][a] ^ sigs[0][b])
    at = np.flatnonzero(d <= most)
    na, nb, most, d = na[at], nb[at], most[at], d[at].astype(np.int64)
    for lane in sigs[1:]:
        d += np.bitwise_count(lane[a[at]] ^ lane[b[at]])
    out = np.zeros(len(a), bool)
    out[at[(d <= most) & (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9)]] = True
    return out


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` (ids ``a``, ``b``) whose word sets really have the similarity, with ``shared`` and ``total`` words."""
    ids = pairs.select(F.explode(F.array(a, b)).alias("id")).distinct()
    w = join_small(sets.select("id", "words"), ids, "id", "left_semi")
    joined = pairs.join(w.select(F.col("id").alias(a), F.col("words").alias("wa")), a).join(w.select(F.col("id").alias(b), F.col("words").alias("wb")), b)
    shared = F.size(F.array_intersect("wa", "wb"))
    out = joined.withColumn("shared", shared).withColumn("total", F.size("wa") + F.size("wb") - F.col("shared"))
    return out.where(F.col("shared") >= F.col("total") * threshold - 1e-9).drop("wa", "wb")


assert sys.byteorder == "little"  # packed words and signatures are read as they lie in memory
