"""Problem 1: blocks of lines repeated across one source's documents, found with suffix arrays over line identifiers.

Each document becomes the sequence of its lines' identifiers (64-bit hashes of the normalised lines). The documents of a
source are spread over shards of bounded size, and every shard builds one suffix array over the concatenation of its
sequences. Neighbouring suffixes with a common prefix hold the same block of one or more lines; the blocks of a shard are
the intervals of its common prefixes. A block frequent in the whole source is frequent in at least one of its shards
(otherwise its shares could not add up), and a line is frequent if and only if it is in a frequent block (the one that its
own suffixes have in common), so the shards' blocks hold all candidates whatever the skew. The documents of their lines,
or of the blocks themselves, are then counted exactly over all shards, and the blocks deleted.

Cases: null and empty texts and null or empty sources take no part; empty lines keep their number but are never a case;
a line repeated within one document counts once for it; a source with fewer than ``min_docs`` documents has no case;
very long documents are sequences like others; an empty table gives an empty table; extra columns are ignored by
``repeated_lines`` and kept by ``strip_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipfold.plans.cut import cut
from clipfold.plans.ship import ship
from clipfold.plans.small import join_small

SHARD_DOCS = 20_000
#: Identifier of an empty line: it ends blocks and is never part of one.
EMPTY = 0


def source_key(c: Column | str) -> Column:
    """Trimmed and lower-cased; null if nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit(""))


def line_key(line: Column) -> Column:
    """Lower-cased, each run of digits read as 0, each run of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"(?U)\d+", "0"), r"(?U)[\s\x1c-\x1f]+", " "))


def line_ids(text: Column) -> Column:
    """The identifiers of the lines of ``text``; empty lines are ``EMPTY``."""
    return F.transform(F.split(line_key_lines(text), "\n", -1), line_id)


def line_id(key: Column) -> Column:
    """The identifier of a normalised line."""
    return F.when(F.trim(key) == "", F.lit(EMPTY)).otherwise(F.xxhash64(F.trim(key))).cast("bigint")


#: White space, as it is taken off the end of a text.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def end_trimmed(text: Column | str) -> Column:
    return F.rtrim(F.col(text) if isinstance(text, str) else text, F.lit(WHITE))


def line_key_lines(text: Column) -> Column:
    """All lines of a text normalised at once: as ``line_key``, but ``\\n`` stays."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)\d+", "0"), r"(?U)[\s\x1c-\x1f&&[^\n]]+", " ")


def suffix_array(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of an integer sequence by prefix doubling, and the longest common prefix of each suffix with the one before.

    Separators between documents must be pairwise distinct, so that no common prefix runs over them; doubling then ends
    after log2 of the longest repeated block.
    """
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    ranks, k = [rank], 1
    while True:
        if len(np.unique(rank)) == n or k >= n:
            break
        after = np.full(n, -1, np.int64)
        after[: n - k] = rank[k:]
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank)
        k *= 2
    order = np.argsort(rank, kind="stable")
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        same &= a != b
        lcp[1:][same] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
    return order, lcp


def prefix_intervals(lcp: np.ndarray, need: int) -> Iterator[tuple[int, int, int]]:
    """``left, right, depth`` of each run of at least ``need`` suffixes with a common prefix of ``depth``, the longest that
    all of them have; ``lcp[k]`` is the common prefix of suffixes k - 1 and k."""
    some = np.flatnonzero(lcp > 0)
    if not len(some):
        return
    breaks = np.flatnonzero(np.diff(some) > 1)
    starts, ends = some[np.concatenate([[0], breaks + 1])] - 1, some[np.concatenate([breaks, [len(some) - 1]])] + 1
    for lo, hi in zip(starts.tolist(), ends.tolist()):
        if hi - lo < need:
            continue
        stack: list[tuple[int, int]] = []
        for k, v in enumerate([*lcp[lo + 1 : hi].tolist(), 0]):
            start = k
            while stack and stack[-1][1] > v:
                start, depth = stack.pop()
                if k - start + 1 >= need:
                    yield lo + start, lo + k + 1, depth
            if v and (not stack or stack[-1][1] < v):
                stack.append((start, v))


def frequent_blocks(docs: list[np.ndarray], need: float) -> list[tuple[list[int], int]]:
    """Blocks of lines (each with its number of documents) that occur in at least ``need`` of ``docs``: the longest common
    prefixes of their occurrences."""
    lens = np.array([len(d) for d in docs], np.int64)
    seq = np.concatenate(docs) if docs else np.empty(0, np.int64)
    if not len(seq):
        return []
    ids = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    total, m = len(seq) + len(docs), len(docs)
    text, owner = np.empty(total, np.int64), np.repeat(np.arange(m), lens + 1)
    ends = np.cumsum(lens + 1) - 1
    inner = np.ones(total, bool)
    inner[ends] = False
    empty = seq == EMPTY
    text[inner] = np.where(empty, 0, ids + m + len(seq) + 1)
    at_empty = np.flatnonzero(inner)[empty]
    text[at_empty] = m + np.arange(len(at_empty))  # each a separator of its own
    text[ends] = np.arange(m)
    order, lcp = suffix_array(text)
    raw = np.zeros(total, np.int64)
    raw[inner] = seq
    who, found = owner[order], []
    if need <= 1:  # a single document is enough, and has nothing in common with another
        found = [([x], 1) for x in np.unique(seq[~empty]).tolist()]
    for lo, hi, depth in prefix_intervals(lcp, max(2, int(np.ceil(need - 1e-9)))):
        n_docs = len(np.unique(who[lo:hi]))
        if n_docs >= need:
            p = order[lo]
            found.append((raw[p : p + depth].tolist(), n_docs))
    return found


def _documents(df: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """Documents as sequences of line identifiers, written once because each step goes over them."""
    docs = (
        df.select(F.col(id_col).alias("id"), source_key(source_col).alias("src"), F.col(text_col).alias("text"))
        .where("src is not null and text <> ''")
        .select("id", "src", line_ids(F.col("text")).alias("ids"))
    )
    return cut(docs, "lines")


def _candidates(docs: DataFrame, min_docs: int, min_share: float, shard_docs: int) -> DataFrame:
    """``src, block, n_src``: blocks frequent in some shard; ``n_src`` documents of the source."""
    ship(docs.sparkSession)
    sizes = docs.groupBy("src").agg(F.count("*").alias("n_src"))
    sharded = join_small(docs, sizes.where(F.col("n_src") >= min_docs), "src").withColumn(
        "shard", F.pmod(F.xxhash64("id"), F.ceil(F.col("n_src") / shard_docs))
    )

    def shard_blocks(shard: pa.Table) -> pa.Table:
        n = shard["n_src"][0].as_py()
        need = max(min_docs, min_share * n - 1e-9) * len(shard) / n  # the share of this shard of what the source needs
        ids = shard["ids"].combine_chunks()
        flat, at = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
        blocks = frequent_blocks([flat[at[k] : at[k + 1]] for k in range(len(shard))], need)
        return pa.table(
            {"src": pa.array([shard["src"][0].as_py()] * len(blocks), pa.string()), "block": pa.array([b for b, _ in blocks], pa.list_(pa.int64())), "n_src": pa.array([n] * len(blocks), pa.int64())}
        )

    return sharded.groupBy("src", "shard").applyInArrow(shard_blocks, "src string, block array<bigint>, n_src bigint").distinct()


def _enough(min_docs: int, min_share: float) -> Column:
    return (F.col("n_docs") >= min_docs) & (F.col("n_docs") >= F.col("n_src") * min_share - 1e-9)


def repeated_lines(
    df: DataFrame, id_col: str = "item_id", source_col: str = "fonte", text_col: str = "resumo", min_docs: int = 5, min_share: float = 0.05, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """``src, line, n_docs``: the identifiers of lines found in ``min_docs`` documents and ``min_share`` of their source."""
    return _repeated(_documents(df, id_col, source_col, text_col), min_docs, min_share, shard_docs)


def _repeated(docs: DataFrame, min_docs: int = 5, min_share: float = 0.05, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Lines of the blocks found that are frequent over all shards."""
    inside = _candidates(docs, min_docs, min_share, shard_docs).select("src", F.explode("block").alias("line"), "n_src").distinct()
    seen = join_small(docs.select("src", F.explode(F.array_distinct("ids")).alias("line")), inside, ["src", "line"])
    return seen.groupBy("src", "line", "n_src").agg(F.count("*").alias("n_docs")).where(_enough(min_docs, min_share)).select("src", "line", "n_docs")


def repeated_blocks(
    df: DataFrame, id_col: str = "item_id", source_col: str = "fonte", text_col: str = "resumo", min_docs: int = 5, min_share: float = 0.05, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """``src, block, n_lines, n_docs``: blocks of consecutive lines spanning enough documents of their source."""
    docs = _documents(df, id_col, source_col, text_col)
    blocks = cut(_candidates(docs, min_docs, min_share, shard_docs), "blocks")
    per_source = blocks.groupBy("src").agg(F.collect_set("block").alias("blocks"), F.max("n_src").alias("n_src"))  # each in a share of its documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin: dict[str, dict[int, list[list[int]]]] = {}
        for b in batches:
            at, out = [], []
            for i, (src, ids, known) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))):
                first = begin.get(src)
                if first is None:
                    first = begin[src] = {}
                    for block in known.as_py():
                        first.setdefault(block[0], []).append(block)
                hits = {tuple(k) for p, line in enumerate(ids) if line in first for k in first[line] if ids[p : p + len(k)] == k}
                at += [i] * len(hits)
                out += hits
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), pa.array(list(map(list, out)), pa.list_(pa.int64())), b.column(3).take(rows)], names=["src", "block", "n_src"])

    hits = join_small(docs, per_source, "src").select("src", "ids", "blocks", "n_src").mapInArrow(run, "src string, block array<bigint>, n_src bigint")
    counts = hits.groupBy("src", "block", "n_src").agg(F.count("*").alias("n_docs")).where(_enough(min_docs, min_share))
    return counts.select("src", "block", F.size("block").cast("bigint").alias("n_lines"), "n_docs")


def line_occurrences(df: DataFrame, id_col: str = "item_id", source_col: str = "fonte", text_col: str = "resumo", **limits) -> DataFrame:
    """``id_col, linha_no``: each occurrence of a repeated line, counted from 1."""
    docs = _documents(df, id_col, source_col, text_col)
    places = docs.select("id", "src", F.posexplode("ids").alias("pos", "line"))
    lines = _repeated(docs, **limits)
    return join_small(places, lines.select("src", "line"), ["src", "line"]).select(F.col("id").alias(id_col), (F.col("pos") + 1).cast("int").alias("linha_no"))


def strip_lines(df: DataFrame, source_col: str = "fonte", text_col: str = "resumo", out_col: str = "resumo", lines: DataFrame | None = None, id_col: str = "item_id", **limits) -> DataFrame:
    """``df`` with ``out_col`` holding the text without its source's repeated lines; rows of no source keep their text.

    The lines of a source are few (each is in a share of its documents), so they come as one array per source.
    """
    lines = repeated_lines(df, id_col, source_col, text_col, **limits) if lines is None else lines
    per_source = lines.groupBy("src").agg(F.collect_set("line").alias("__bad")).withColumnRenamed("src", "__src")
    kept = F.filter(
        F.arrays_zip(F.split(F.col(text_col), "\n", -1).alias("t"), line_ids(F.col(text_col)).alias("i")),
        lambda z: ~F.array_contains(F.col("__bad"), z["i"]),
    )
    clean = F.array_join(F.transform(kept, lambda z: z["t"]), "\n")
    joined = join_small(df.withColumn("__src", source_key(source_col)), per_source, "__src", "left")
    return joined.withColumn(out_col, F.when(F.col("__bad").isNull(), F.col(text_col)).otherwise(clean)).drop("__src", "__bad")
