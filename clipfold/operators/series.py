"""Daily series by area and keyword, their nested form, and re-aggregation over calendar periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipfold.functions.dates import STEPS, period_end, period_start
from clipfold.functions.text import filled
from clipfold.operators.dims import DEFAULT, Dimensions, origin

ORIGINS = ("nacionais", "lusofonas", "internacionais")


def daily_by_area(items: DataFrame, dims: Dimensions = DEFAULT) -> DataFrame:
    """Counts of dated items by day and area: items, distinct sources, and items of each origin."""
    o = origin("dominio", dims)
    return items.where("ts is not null and area <> ''").groupBy(F.to_date("ts").alias("data"), "area").agg(
        F.count("*").alias("noticias"), F.count_distinct(filled("fonte")).alias("fontes"), *[F.count_if(o == name).alias(name) for name in ORIGINS]
    )


def daily_keywords(items: DataFrame) -> DataFrame:
    """Items by day, area and keyword; an item counts once for each of its keywords."""
    dated = items.where("ts is not null and area <> ''").select(F.to_date("ts").alias("data"), "area", F.explode(F.array_distinct("palavras")).alias("palavra"))
    return dated.groupBy("data", "area", "palavra").agg(F.count("*").alias("noticias"))


def nest(by_area: DataFrame, by_keyword: DataFrame) -> DataFrame:
    """``data, areas``: one row a day, areas as a map of counts with maps of origins and keywords."""
    words = by_keyword.groupBy("data", "area").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("palavra", "noticias")))).alias("palavras"))
    origins = F.create_map(*[x for name in ORIGINS for x in (F.lit(name), F.col(name))])
    value = F.struct("noticias", F.col("noticias").alias("novas"), "fontes", origins.alias("origens"), F.coalesce("palavras", F.create_map().cast("map<string,bigint>")).alias("palavras"))
    rows = by_area.join(words, ["data", "area"], "left").select("data", F.struct("area", value.alias("v")).alias("e"))
    return rows.groupBy("data").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("e.area"), F.to_json("e.v").alias("j"))))).alias("areas")).select(
        "data", F.transform_values("areas", lambda k, j: F.from_json(j, "noticias bigint, novas bigint, fontes bigint, origens map<string,bigint>, palavras map<string,bigint>")).alias("areas")
    )


def long_by_area(nested: DataFrame) -> DataFrame:
    rows = nested.select("data", F.explode("areas").alias("area", "v"))
    return rows.select("data", "area", "v.noticias", "v.fontes", *[F.coalesce(F.try_element_at("v.origens", F.lit(name)), F.lit(0)).alias(name) for name in ORIGINS])


def long_by_keyword(nested: DataFrame) -> DataFrame:
    rows = nested.select("data", F.explode("areas").alias("area", "v"))
    return rows.select("data", "area", F.explode("v.palavras").alias("palavra", "noticias"))


def resample(series: DataFrame, keys: list[str], values: list[str], by: str) -> DataFrame:
    """Sums by calendar period, labelled by its last day; periods without rows between a group's first and last are 0.

    The grid comes from each group's own first and last period, so it is no larger than the result.
    """
    sums = series.withColumn("__p", period_start("data", by)).groupBy(*keys, "__p").agg(*[F.sum(v).alias(v) for v in values])
    grid = sums.groupBy(*keys).agg(F.min("__p").alias("a"), F.max("__p").alias("z")).select(*keys, F.explode(F.sequence("a", "z", F.expr(STEPS[by]))).alias("__p"))
    out = grid.join(sums, [*keys, "__p"], "left")
    return out.select(period_end("__p", by).alias("periodo"), *keys, *[F.coalesce(v, F.lit(0)).cast("bigint").alias(v) for v in values])


def totals(series: DataFrame) -> DataFrame:
    """One row: rows, areas, first and last day, items, and the share of each origin in percent."""
    n = F.greatest(F.sum("noticias"), F.lit(1))
    return series.agg(
        F.count("*").alias("linhas"), F.count_distinct("area").alias("areas"), F.min("data").alias("de"), F.max("data").alias("ate"), F.sum("noticias").alias("noticias"),
        *[F.round(100.0 * F.sum(name) / n, 4).alias(f"pct_{name}") for name in ORIGINS],
    )


def area_totals(series: DataFrame) -> DataFrame:
    """``area, noticias``: items of each area over all days, most first."""
    return series.groupBy("area").agg(F.sum("noticias").alias("noticias")).orderBy(F.desc("noticias"), "area")


def run_counters(items: DataFrame) -> DataFrame:
    """Items read, different titles, items with an area and without a link, of each run and feed."""
    return items.groupBy("run_ord", "feed_ord").agg(
        F.count("*").alias("lidas"), F.count_distinct(F.lower("titulo")).alias("distintas"), F.count_if(F.col("area") != "").alias("marcadas"), F.count_if(F.col("ligacao") == "").alias("sem_ligacao")
    )


def value_counts(df: DataFrame, c: Column, order: str, top: int | None = None, empty: str = "sem indicação") -> DataFrame:
    """``valor, n``: most frequent first, ties by first appearance; empty values are counted together."""
    out = df.groupBy(F.coalesce(filled(c), F.lit(empty)).alias("valor")).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    out = out.orderBy(F.desc("n"), "__first")
    return (out.limit(top) if top else out).select("valor", "n")


def evolution(series: DataFrame) -> DataFrame:
    """Each day's items against the mean of the area's earlier days."""
    before = Window.partitionBy("area").orderBy("data").rowsBetween(Window.unboundedPreceding, -1)
    mean = F.avg("noticias").over(before)
    return series.select("data", "area", "noticias", F.round(mean, 4).alias("media"), F.round(100.0 * (F.col("noticias") - mean) / mean, 4).alias("variacao"))


def pivot_origins(items: DataFrame, by: str, dims: Dimensions = DEFAULT) -> DataFrame:
    return items.where("ts is not null").groupBy(period_start(F.to_date("ts"), by).alias("periodo")).agg(*[F.count_if(origin("dominio", dims) == name).alias(name) for name in ORIGINS])


def top_areas(series: DataFrame, k: int = 8) -> DataFrame:
    """The daily rows of the ``k`` areas with most items (ties by name)."""
    top = series.groupBy("area").agg(F.sum("noticias").alias("n")).orderBy(F.desc("n"), "area").limit(k)
    return series.join(F.broadcast(top.select("area")), "area", "left_semi")  # k rows


def concentration(items: DataFrame) -> DataFrame:
    """Sum of squared source shares by half-year, and its change on the half-year before."""
    half = F.concat(F.year("ts"), F.lit("-"), F.when(F.month("ts") <= 6, "1").otherwise("2"))
    n = items.where("ts is not null and fonte <> ''").groupBy(half.alias("semestre"), F.lower(F.trim("fonte")).alias("f")).agg(F.count("*").alias("n"))
    hhi = n.groupBy("semestre").agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("hhi"), F.sum("n").alias("noticias"))
    return hhi.select("semestre", "noticias", F.round("hhi", 6).alias("hhi"), F.round(F.col("hhi") - F.lag("hhi").over(Window.orderBy("semestre")), 6).alias("mudanca"))  # two rows a year


def zero_filled(dim: DataFrame, key: str, counts: DataFrame, n: str) -> DataFrame:
    return dim.join(counts, key, "left").withColumn(n, F.coalesce(n, F.lit(0)))
