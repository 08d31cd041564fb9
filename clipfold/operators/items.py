"""Dated text items: normalisation, and the dimensions looked up for them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipfold.functions.dates import at, parse_minute
from clipfold.functions.text import blank, filled, fold
from clipfold.operators.dims import DEFAULT, Dimensions, country, on_platform, origin, writes_portuguese  # noqa: F401

ORDER = ("run_ord", "feed_ord", "item_id")
TEXTS = ("area", "grupo", "fonte", "dominio", "titulo", "resumo", "ligacao", "imagem")


def normalise(df: DataFrame) -> DataFrame:
    """Null texts become empty, ``data`` becomes ``ts`` (null where it can't be read), null keyword lists become empty."""
    out = df.withColumn("ts", parse_minute("data")).withColumn("palavras", F.coalesce("palavras", F.array().cast("array<string>")))
    return out.withColumns({c: blank(c) for c in TEXTS if c in df.columns})


def with_registry(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """Items without a source or domain take those of their feed."""
    reg = feeds.select("feed_ord", F.col("source").alias("__source"), F.col("domain").alias("__domain"))
    joined = items.join(reg, "feed_ord", "left")
    return joined.withColumn("fonte", F.coalesce(filled("fonte"), "__source", F.lit(""))).withColumn("dominio", F.coalesce(filled("dominio"), "__domain", F.lit(""))).drop("__source", "__domain")


def within_hours(as_of: datetime, hours: int, undated: bool) -> Column:
    """Items of the last ``hours``; undated ones pass (reports, collection) or not (syntheses)."""
    return F.coalesce(F.col("ts") >= at(as_of) - F.expr(f"INTERVAL {hours} HOURS"), F.lit(undated))


def retained(as_of: datetime, days: int) -> Column:
    """Calendar-day retention; undated items go."""
    return F.coalesce(F.to_date("ts") >= F.date_sub(F.lit(as_of.date()), days), F.lit(False))


def report_rows(items: DataFrame, as_of: datetime, hours: int = 24, area: str | None = None, origins: tuple[str, ...] | None = None, undated: bool = True, dims: Dimensions = DEFAULT) -> DataFrame:
    """Rows of a report (or, with ``undated=False``, of a synthesis)."""
    out = items.where(within_hours(as_of, hours, undated) & ~on_platform("dominio", dims))
    if area is not None:
        out = out.where(F.col("area") == area)
    return out if not origins else out.where(origin("dominio", dims).isin(*origins))


def newest_first(undated_first: bool = False) -> list[Column]:
    ts = F.desc_nulls_first("ts") if undated_first else F.desc_nulls_last("ts")
    return [ts, *[F.asc(c) for c in ORDER]]


def resolve_terms(areas: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, area``: the area named exactly, else the first one (by ``ord``) whose folded name holds the term."""
    a = areas.select("area", "ord", fold("area").alias("__f"))
    t = terms.select("term", fold("term").alias("__t"))
    hit = t.join(a, F.contains(F.col("__f"), F.col("__t")) & (F.col("__t") != ""))  # two small dimensions
    return hit.groupBy("term").agg(F.min_by("area", F.struct(F.col("__f") != F.col("__t"), "ord")).alias("area"))


def select_areas(areas: DataFrame, terms: DataFrame) -> DataFrame:
    """All areas whose folded name holds any of the terms."""
    t = terms.select(fold("term").alias("__t"))
    return areas.join(t, F.contains(fold("area"), F.col("__t")) & (F.col("__t") != ""), "left_semi")


