"""The engine's jobs as functions; their arguments are what a command line would take."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipfold.operators import items as it
from clipfold.operators import merge, report, rules, series, subs
from clipfold.operators.dims import DEFAULT, Dimensions
from clipfold.plans.cut import scope
from clipfold.sources import feeds as feed_source
from clipfold.sources import state

HOURS = {"24h": 24, "48h": 48, "72h": 72, "7d": 168, "30d": 720}


def hours(window: str, as_of: datetime) -> int:
    return (72 if as_of.weekday() == 0 else 24) if window == "auto" else HOURS[window]


def tag(raw: DataFrame, areas: DataFrame, groups: DataFrame, rule_table: DataFrame, key: str = "item_id", all_languages: bool = False, dims: Dimensions = DEFAULT) -> DataFrame:
    """Items by area with their keywords; by default only of publications that write in Portuguese."""
    gated = raw if all_languages else raw.where(it.writes_portuguese("dominio", dims))
    texts = gated.select(key, F.concat("titulo", F.lit(" "), "resumo").alias("texto"))
    found = rules.classified(texts, rule_table, key)
    named = F.broadcast(areas.join(groups, "group_id").select("area_id", "area", "grupo"))  # the rules' own dimension, at most rules.MAX_RULES
    return found.join(named, "area_id").drop("area_id").join(gated.drop("area", "grupo", "palavras"), key)


def collect(payloads: DataFrame, feeds: DataFrame, areas: DataFrame, groups: DataFrame, rule_table: DataFrame, as_of: datetime, days: int = 7, area: str | None = None, run_ord: int = 1, dims: Dimensions = DEFAULT) -> dict[str, DataFrame]:
    """One run: ``raw`` (first of each title), ``tagged`` (first of each area and title, keywords united) and ``errors``."""
    parsed, errors = feed_source.items(payloads, feeds, as_of, run_ord)
    raw = parsed.where(it.within_hours(as_of, days * 24, True)).withColumn("item_id", F.xxhash64("run_ord", "feed_ord", "item_ord"))
    order = ("run_ord", "feed_ord", "item_ord")
    tagged = merge.first_with_keywords(tag(raw, areas, groups, rule_table, dims=dims), [F.col("area"), F.lower("titulo")], order=order)
    short = raw.where("titulo <> ''").withColumn("resumo", F.substring("resumo", 1, 240))
    return {"raw": merge.first_wins(short, [F.lower("titulo")], order), "tagged": tagged if area is None else tagged.where(F.col("area") == area), "errors": errors}


def roll(old: DataFrame, new: DataFrame, as_of: datetime, days: int = 7, corpus: bool = False) -> DataFrame:
    """The rolling archive (older runs first) or corpus (newer runs first) after a run; damaged old rows go."""
    sound = old.where(~_damaged())
    kept = merge.union_states(sound, new).where(it.retained(as_of, days))
    key = [F.lower("titulo")] if corpus else [F.col("area"), F.lower("titulo"), F.lower("fonte")]
    fill = ["resumo", "imagem", "ligacao", "dominio"] + ([] if corpus else ["grupo"])
    order = tuple(c for c in ("run_ord", "feed_ord", "item_id") if c in kept.columns)
    return merge.fill_missing(kept, key, fill, order, newest_first=corpus, keywords=None if corpus else "palavras")


def _damaged():
    from clipfold.functions.text import damaged

    return damaged("titulo", "resumo", "fonte", "ligacao")


def day_series(old: DataFrame, tagged: DataFrame, as_of: datetime, dims: Dimensions = DEFAULT) -> DataFrame:
    """The daily series with the day of ``as_of`` counted anew."""
    today = tagged.where(F.to_date("ts") == F.lit(as_of.date()))
    return merge.upsert(old, series.daily_by_area(today, dims), ["data"])


def reports(
    archive: DataFrame, subscribers: DataFrame, as_of: datetime, window: str = "24h", areas: list[str] | None = None, origins: tuple[str, ...] | None = None, per_area: int = 200,
    written: DataFrame | None = None, panel: str = "", colours: dict[str, str] | None = None, title: str | None = None, dims: Dimensions = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """Report documents and manifest of the areas to be sent; ``written`` are syntheses."""
    rows = it.report_rows(archive, as_of, hours(window, as_of), origins=origins, dims=dims)
    rows = rows.where(F.col("area").isin(areas)) if areas else rows
    wanted = subs.gate(rows.where("area <> ''").select("area").distinct(), subscribers)
    rows = rows.join(wanted, "area", "left_semi")
    order = tuple(c for c in it.ORDER if c in rows.columns) or ("titulo",)
    if written is not None and origins:
        written = written.where(F.col("origem").isNull() | F.col("origem").isin(*origins))
    return report.documents(rows, as_of, per_area, written, window, panel, colours, order=order, dims=dims), report.manifest(rows, as_of, title)


def syntheses(
    archive: DataFrame, as_of: datetime, window: str = "24h", areas: list[str] | None = None, origins: tuple[str, ...] | None = None, least: int = 3, most: int = 35, write=report.listing, dims: Dimensions = DEFAULT
) -> DataFrame:
    """A paragraph for each area and origin with enough items, by ``write``."""
    rows = it.report_rows(archive, as_of, hours(window, as_of), origins=origins, undated=False, dims=dims)
    rows = rows.where(F.col("area").isin(areas)) if areas else rows
    return report.summarise(rows, write, most, least, dims=dims).withColumns({"janela": F.lit(window), "gerado": F.lit(as_of).cast("timestamp_ntz")})


def save(made, path: str) -> None:
    """Write the table that ``made()`` gives, then delete the tables cut on the way to it."""
    spark = SparkSession.active()
    with scope(spark):
        made().write.mode("overwrite").parquet(path)


def longitudinal(spark: SparkSession, path: str, by: str = "day", keywords: bool = False) -> DataFrame:
    """The persisted daily series by calendar period."""
    nested = state.read_series(spark, path)
    if keywords:
        return series.resample(series.long_by_keyword(nested), ["area", "palavra"], ["noticias"], by)
    return series.resample(series.long_by_area(nested), ["area"], ["noticias", "fontes", *series.ORIGINS], by)


def since(as_of: datetime, window: str) -> datetime:
    return as_of - timedelta(hours=hours(window, as_of))
