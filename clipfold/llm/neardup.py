"""Problem 5: near-duplicate records by a blocked sparse product of the document-by-2-gram incidence matrix.

A document is its set of words; its n-grams are the 2-grams of its canonical text (see ``sets``), of which two documents
at the threshold must share a number that follows from their sizes. Only the rarest 2-grams of each document are columns
(its head), as many as the threshold demands, so no pair is lost. A block holds whole columns. In it, the documents of a
column meet that the bounds of sizes and bit signatures allow; the product adds up how many columns each pair shares, first
in its block, then over all blocks, and discards the pairs below what their sizes demand. The pairs left are checked
exactly on their whole word sets.

Exact copies are one class: only its first document enters the product, and the class is unfolded at the end.

Cases: documents without words are left out (two of them are no pair); rows repeated under one id are one document;
columns of very many documents are split over tasks; an empty table gives empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.llm import sets
from clipfold.plans.cut import cut
from clipfold.plans.small import join_small

LANES = 2


def product(threshold: float):
    """For ``mapInArrow`` over ``sets.by_column``: pairs ``a < b`` of a block with the number of columns they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sets.column_blocks(batches):
            block = sets.Block(t, LANES)
            ids, ns, ask = block.id, block.n, np.arange(len(block))
            ends = block.find(ask, np.floor(ns / threshold + 1e-9), "right")
            doc = np.unique(ids, return_inverse=True)
            found = [np.empty(0, np.int64)]
            for x, y in sets.meetings(ask, ask + 1, ends, block, threshold):
                x, y = doc[1][x], doc[1][y]
                found.append(np.minimum(x, y) * len(doc[0]) + np.maximum(x, y))
            pairs, shared = np.unique(np.concatenate(found), return_counts=True)
            x, y = np.divmod(pairs, len(doc[0]))
            size = np.zeros(len(doc[0]), np.int32)
            size[doc[1]] = ns
            apart = x != y
            x, y, shared = x[apart], y[apart], shared[apart]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[0][x]), pa.array(doc[0][y]), pa.array(size[x]), pa.array(size[y]), pa.array(np.ones(len(x), bool)), pa.array(shared.astype(np.int32))], names=["a", "b", "na", "nb", "earlier", "shared"]
            )

    return run


def classes(df: DataFrame, text_col: str, id_col: str = "item_id", threshold: float = 0.65, hot: int = sets.HOT) -> tuple[DataFrame, DataFrame]:
    """Members (``rep, id``) of the classes of equal word sets, and pairs of classes (``a, b``, their first ids)."""
    src = df.select(F.col(id_col).cast("bigint").alias("id"), text_col).where("id is not null")
    words = cut(sets.word_sets(src, ["id"], text_col), "words")
    firsts = cut(words.groupBy("k1", "k2").agg(F.min("id").alias("rep")), "classes")
    members = words.select("id", "k1", "k2").join(firsts, ["k1", "k2"]).select("rep", "id").distinct()
    order = sets.Order.fit(words)
    reps = join_small(words, firsts.select(F.col("rep").alias("id")), "id", "left_semi").withColumn("run", F.lit(0))
    pairs = sets.by_column(sets.incidence(reps, order, threshold, LANES, hot)).mapInArrow(product(threshold), sets.PAIR_SCHEMA)
    return members, sets.verified(cut(sets.accumulated(pairs, threshold), "candidates"), words, threshold).select("a", "b").distinct()


def pairs(df: DataFrame, text_col: str, id_col: str = "item_id", threshold: float = 0.65, hot: int = sets.HOT) -> DataFrame:
    """``id_a < id_b``: all pairs of documents at the threshold, exact copies among them."""
    members, links = classes(df, text_col, id_col, threshold, hot)
    members = cut(members, "members")
    copies = members.select("rep", F.col("id").alias("x")).join(members.select("rep", F.col("id").alias("y")), "rep").where("x < y").select("x", "y")
    across = links.join(members.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a").join(members.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b").select("x", "y")
    return copies.union(across).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def groups(df: DataFrame, text_col: str, id_col: str = "item_id", threshold: float = 0.65, hot: int = sets.HOT) -> DataFrame:
    """``id_col, class_id, n_links``: each document's class of equal word sets, and its links to other classes."""
    members, links = classes(df, text_col, id_col, threshold, hot)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    return members.join(degree, "rep", "left").select(F.col("id").alias(id_col), F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def links(df: DataFrame, text_col: str, id_col: str = "item_id", threshold: float = 0.65, hot: int = sets.HOT) -> DataFrame:
    """``class_a < class_b``: the links between classes, which with ``groups`` tell all groups at the threshold."""
    return classes(df, text_col, id_col, threshold, hot)[1].select(F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b"))
