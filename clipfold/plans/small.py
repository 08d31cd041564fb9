"""Joins with a side that is usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.plans.cut import cut_at, file_system

#: Bytes up to which a side is broadcast: of its files, and of its values written out as text.
MOST_FILES, MOST_VALUES = 16 << 20, 64 << 20


def join_small(df: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner", most: int = MOST_VALUES) -> DataFrame:
    """``df`` joined with ``small``, which is written first and measured.

    Up to ``most`` bytes it is broadcast, so that ``df`` isn't shuffled and a hot key stays spread over its tasks; beyond
    that it is an ordinary join, in which adaptive execution splits hot keys.
    """
    written, path = cut_at(small, "small")
    return df.join(F.broadcast(written) if measured(written, path, most) else written, on, how)


def measured(written: DataFrame, path: str, most: int) -> bool:
    """Whether a written table has at most ``most`` bytes of values; its values are only read where its files are small."""
    p, fs = file_system(written.sparkSession, path)
    if fs.getContentSummary(p).getLength() > min(MOST_FILES, most):
        return False
    size = written.agg(F.sum(F.length(F.to_json(F.struct("*"))).cast("bigint")).alias("n")).first().n
    return (size or 0) <= most
