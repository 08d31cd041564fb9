"""Keyed stores of items: first-wins, unions, fill-missing merges, appends and upserts.

First-wins never depends on the order of rows in a table: ordinals decide. All merges are one shuffle on the key, with
partial aggregation before it, so copies of one key are reduced where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipfold.functions.text import filled
from clipfold.operators.items import ORDER


def _order(order: tuple[str, ...]) -> Column:
    return F.struct(*order)


def first_wins(df: DataFrame, key: list[Column], order: tuple[str, ...] = ORDER) -> DataFrame:
    """The first row of each key by ``order``."""
    names = [f"__k{i}" for i in range(len(key))]
    keyed = df.withColumns(dict(zip(names, key)))
    return keyed.groupBy(*names).agg(F.min_by(F.struct(*df.columns), _order(order)).alias("r")).select("r.*")


def _spread(df: DataFrame, key: list[Column], keywords: str | None, pos: Column) -> tuple[DataFrame, list[str], Column]:
    """``df`` with its keys and order, one row a keyword; all but the first of these have a null order.

    So the fields of a row are looked at once, and of the keywords only distinct ones are ever held, however many rows
    share a key.
    """
    names = [f"__k{i}" for i in range(len(key))]
    keyed = df.withColumns(dict(zip(names, key)) | {"__o": pos})
    if keywords is None:
        return keyed, names, F.col("__o")
    spread = keyed.select(*[c for c in keyed.columns if c != keywords], F.posexplode_outer(keywords).alias("__pos", "__word"))
    return spread, names, F.when(F.coalesce("__pos", F.lit(0)) == 0, F.col("__o"))


def _union() -> Column:
    return F.array_sort(F.collect_set("__word"))


def first_with_keywords(df: DataFrame, key: list[Column], keywords: str = "palavras", order: tuple[str, ...] = ORDER) -> DataFrame:
    """The first row of each key, with the sorted union of all its keywords."""
    rest = [c for c in df.columns if c != keywords]
    spread, names, at = _spread(df, key, keywords, _order(order))
    got = spread.groupBy(*names).agg(F.min_by(F.when(at.isNotNull(), F.struct(*rest)), at).alias("r"), _union().alias(keywords))
    return got.select(*[F.col(f"r.{c}").alias(c) if c != keywords else F.col(c) for c in df.columns])


def fill_missing(df: DataFrame, key: list[Column], fill: list[str], order: tuple[str, ...] = ORDER, newest_first: bool = False, keywords: str | None = None) -> DataFrame:
    """The first row of each key, each field of ``fill`` being the first that isn't empty.

    ``newest_first`` turns the order by its first column round (the corpus), else older runs come first (the archive).
    """
    pos = F.struct(-F.col(order[0]), *order[1:]) if newest_first else _order(order)
    spread, names, at = _spread(df, key, keywords, pos)
    base = [c for c in df.columns if c not in fill and c != keywords]
    aggs = [F.min_by(F.when(at.isNotNull(), F.struct(*base)), at).alias("r")]
    aggs += [F.coalesce(F.min_by(filled(c), F.when(F.col(c) != "", at)), F.lit("")).alias(c) for c in fill]
    if keywords:
        aggs.append(_union().alias(keywords))
    got = spread.groupBy(*names).agg(*aggs)
    return got.select(*[F.col(c) if c in fill or c == keywords else F.col(f"r.{c}").alias(c) for c in df.columns])


def append_new(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key isn't in ``old``; nothing is merged within ``new``."""
    return new.join(old.select(*key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def union_states(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def merge_parts(parts: DataFrame, key: str, value: list[str], order: str, stamp: str) -> DataFrame:
    """Partial results by key, the last part winning; ``stamp`` is the latest of all parts."""
    last = parts.groupBy(key).agg(F.max_by(F.struct(*value), order).alias("v"))
    return last.select(key, "v.*").crossJoin(F.broadcast(parts.agg(F.max(stamp).alias(stamp))))  # one row


def resolve_links(df: DataFrame, link: str, resolver, salts: int = 32) -> DataFrame:
    """``df`` with ``link`` resolved; each distinct address is resolved once.

    Front pages are the link of very many rows. The distinct addresses are repeated ``salts`` times for the join, so such
    a link's rows meet in as many tasks.
    """
    known = df.select(F.col(link).alias("__link")).where("__link <> ''").distinct().withColumn("__to", resolver(F.col("__link")))
    known = known.where("__to <> __link").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))  # others stay
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")]), F.lit(salts)).cast("int"))
    joined = salted.join(known.withColumnRenamed("__salt", "__s"), (F.col(link) == F.col("__link")) & (F.col("__salt") == F.col("__s")), "left")
    return joined.withColumn(link, F.coalesce("__to", link)).drop("__link", "__to", "__salt", "__s")
