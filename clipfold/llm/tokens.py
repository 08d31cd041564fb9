"""Problem 7: byte-pair encoding of whole corpora with a public tokenizer, and its inverse.

Merging is done by a priority queue of merge ranks over a doubly linked list of symbols; queue entries whose symbols
were merged meanwhile are stale and skipped, so a piece of n bytes costs O(n log n) however long it is. Decoding
concatenates the vocabulary's byte strings.

Null and empty texts have the empty list of ids; every text has defined ids because every byte is a symbol.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.plans.ship import ship

#: Fixed value: the published splitting pattern of this tokenizer.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words kept per worker; the cache is emptied when it is full, so memory is bounded whatever the corpus holds.
CACHE_WORDS = 200_000


class BytePairEncoder:
    """Encoder and decoder over a file of ``base64-token rank`` lines."""

    def __init__(self, path: str = DEFAULT):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.vocab = {r: t for t, r in self.ranks.items()}
        self.split = regex.compile(SPLIT)
        self.cache: dict[str, array] = {}

    def merge(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        end = list(range(1, n + 1))  # a symbol is [i, end[i]); its right neighbour starts at end[i]; 0: merged away
        left = list(range(-1, n - 1))
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, e = heapq.heappop(queue)
            if not (mid := end[i]) or mid >= e or end[mid] != e:
                continue  # stale: one of the two symbols has changed since
            end[i], end[mid] = e, 0
            if e < n:
                left[e] = i
                if (r := ranks.get(piece[i : end[e]])) is not None:
                    heapq.heappush(queue, (r, i, end[e]))
            if (p := left[i]) >= 0 and (r := ranks.get(piece[p:e])) is not None:
                heapq.heappush(queue, (r, p, e))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def _pieces(self, chunk: str) -> array:
        return array("i", [i for p in self.split.findall(chunk) for i in self.merge(p.encode("utf-8", "replace"))])

    def encode_into(self, text: str | None, out: array) -> None:
        """Append the ids of ``text``. A split never crosses a lone space between two visible characters, so the parts
        between such spaces are encoded apart and kept; a text with any other use of spaces is split as a whole."""
        if not text:
            return
        chunks, cache = text.split(" "), self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        start = len(out)
        for k, c in enumerate(chunks):
            key = " " + c if k else c
            ids = cache.get(key)
            if ids is None:
                if (not c or c[0].isspace() or c[-1].isspace()) and len(chunks) > 1:
                    del out[start:]
                    out.extend(self._pieces(text))
                    return
                ids = self._pieces(key)
                if len(c) < 64:
                    cache[key] = ids
            out.extend(ids)

    def encode(self, text: str | None) -> list[int]:
        self.encode_into(text, out := array("i"))
        return out.tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.vocab[i] for i in ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> BytePairEncoder:
    """The encoder of a file, read once per worker."""
    return BytePairEncoder(path)


def _lists(columns: list, out: array, offsets: array, names: list[str]) -> pa.RecordBatch:
    ids = pa.ListArray.from_arrays(pa.array(np.frombuffer(offsets, np.int32)), pa.array(np.frombuffer(out, np.int32)) if out else pa.array([], pa.int32()))
    return pa.RecordBatch.from_arrays([*columns, ids], names=names)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT) -> DataFrame:
    """``id_col, ids``: the ids of each row's text, without special tokens. Other columns are left out, whatever their
    names; rows are kept as they are, repeated ones too; an empty table gives an empty table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            texts, done = b.column(1), 0
            while done < len(b):  # in pieces, so that long texts don't make one huge list
                out, offsets, first = array("i"), array("i", [0]), done
                while done < len(b) and len(out) < 4_000_000:
                    enc.encode_into(texts[done].as_py(), out)
                    offsets.append(len(out))
                    done += 1
                yield _lists([b.column(0).slice(first, done - first)], out, offsets, [id_col, "ids"])

    ship(df.sparkSession)
    src = df.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, ids array<int>")


def token_counts(df: DataFrame, keep: list[str], text_col: str = "text", path: str = DEFAULT) -> DataFrame:
    """The columns ``keep`` and ``tokens BIGINT``, the number of ids of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = np.empty(len(b), np.int64)
            for k, t in enumerate(b.column(len(keep))):
                out = array("i")
                enc.encode_into(t.as_py(), out)
                n[k] = len(out)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array(n)], names=[*keep, "tokens"])

    ship(df.sparkSession)
    src = df.select(*keep, F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1])
    return src.mapInArrow(run, f"{fields}, tokens bigint")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = DEFAULT) -> DataFrame:
    """``id_col, texto``: the text of each list of ids; a null list gives a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = encoder(path).vocab
        for b in batches:
            texts = [None if x is None else b"".join(map(vocab.__getitem__, x)).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "texto"])

    ship(df.sparkSession)
    src = df.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("__ids"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, texto string")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT) -> DataFrame:
    """``id_col, tokens, exact``: whether decoding the ids gives the text back (null counts as the empty text), in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        vocab = enc.vocab
        for b in batches:
            sizes, exact = [], []
            for t in b.column(1):
                text = t.as_py() or ""
                enc.encode_into(text, out := array("i"))
                sizes.append(len(out))
                exact.append(b"".join(map(vocab.__getitem__, out)) == text.encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(exact, pa.bool_())], names=[id_col, "tokens", "exact"])

    ship(df.sparkSession)
    src = df.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, tokens bigint, exact boolean")
