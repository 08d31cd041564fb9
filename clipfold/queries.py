"""Queries of the engine's operators over the test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipfold import api
from clipfold.functions import dates, text
from clipfold.operators import dims, merge, report, rules, series, subs
from clipfold.operators import items as it
from clipfold.operators.items import ORDER, newest_first
from clipfold.plans.cut import fresh_path
from clipfold.plans.ranked import ranked
from clipfold.sources import exports, feeds, state
from clipfold.streaming import archive

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = datetime(2018, 3, 20, 12, 0)
QUERIES: dict[str, Query] = {}
#: The defaults, and the publications of the test tables whose domain doesn't tell their country or language.
DIMS = dims.DEFAULT.plus(portuguese=("pt.kelbrandtwelle.de",), national=("folhadozambril.com", "minutomarvento.com"), platforms=("camporegadioxisto.pt",), countries={"folhadozambril.com": "Portugal", "minutomarvento.com": "Portugal", "dunhallowpost.com": "Reino Unido", "diariovaldemorca.com": "Espanha"})


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return it.normalise(_t(spark, sf_dir, "arquivo"))


def query(f: Query) -> Query:
    """Register ``f``; dates come out as text, the form in which all tools compare alike."""

    @functools.wraps(f)
    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*[F.col(c).cast("string").alias(c) if kind == "date" else F.col(c) for c, kind in df.dtypes])

    QUERIES[f.__name__] = plain
    return f


def _ids(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    return _items(spark, sf_dir).select("item_id", *columns)


# scalar functions


@query
def fold_text(spark, d):
    return _ids(spark, d, text.fold("titulo").alias("dobrado"))


#: Markup and entities put after each text, named and numeric, known and unknown.
MARKUP = "<p class='x'>Educa&ccedil;&atilde;o &#233; &#xE9;&nbsp;&hellip; &amp;lt; R&D &desconhecida; &euro;5</p>"


@query
def clean_html(spark, d):
    return _ids(spark, d, text.clean_html("resumo").alias("limpo"), text.clean_html(F.concat("titulo", F.lit(MARKUP))).alias("com_marcas"))


@query
def split_source_suffix(spark, d):
    title, source = text.split_title("titulo", "fonte")
    return _ids(spark, d, title.alias("titulo"), source.alias("fonte"))


@query
def summary_is_title(spark, d):
    repeated = F.concat(F.lit("— "), F.col("titulo"), F.lit(". "), F.col("fonte"))
    return _ids(spark, d, text.summary_unless_title("resumo", "titulo").alias("resumo"), text.summary_unless_title(repeated, "titulo").alias("repetido"))


@query
def rfc_date(spark, d):
    zoned = lambda zone: F.concat(F.lit("Thu, "), F.date_format("ts", "d MMM yyyy HH:mm:ss"), F.lit(zone))
    return _ids(spark, d, dates.parse_rfc(zoned(" +0200"), AS_OF).alias("lisboa"), dates.parse_rfc(zoned(" -0530"), AS_OF).alias("oeste"), dates.parse_rfc(zoned(" GMT"), AS_OF).alias("gmt"), dates.parse_rfc(F.date_format("ts", "d MMM yyyy HH:mm:ss"), AS_OF).alias("sem_zona"))


@query
def url_checks(spark, d):
    other = F.concat(F.lit("HTTPS://lh3.googleusercontent.com/"), F.col("item_id").cast("string"))
    path = F.concat(F.lit("https://jornal.example/a-google.-"), F.col("item_id").cast("string"))
    return _ids(
        spark, d, text.plausible_url("ligacao").alias("plausivel"), text.plausible_url(other).alias("alheia"), text.plausible_url(path).alias("no_caminho"), text.plausible_url(F.upper("ligacao")).alias("maiuscula"),
        text.safe_url("ligacao").alias("segura"), text.host("ligacao").alias("anfitriao"), text.domain_key("dominio").alias("dominio"),
    )


def _payload(*parts: Column) -> Column:
    return F.translate(F.regexp_replace(F.base64(F.encode(F.concat(*parts), "UTF-8")), "[=\r\n]", ""), "+/", "-_")


@query
def redirect_target(spark, d):
    head, tail = F.lit("\x08\x13\""), F.lit('"\x01')
    image = F.lit("https://lh3.googleusercontent.com/imagem-de-todos ")
    one, two = (F.concat(F.lit(f"https://{h}/rss/articles/"), _payload(head, image, F.col("ligacao"), tail), F.lit("?oc=5")) for h in ("news.google.com", "jornal.example"))
    return _ids(spark, d, F.coalesce(text.redirect_target(one) == one, F.lit(False)).alias("fica"), F.when(text.redirect_target(one) != one, text.redirect_target(one)).alias("destino"), (text.redirect_target(two) == two).alias("outra_fica"))


@query
def escaped_html(spark, d):
    return _ids(spark, d, text.escape_html("resumo").alias("html"))


@query
def truncation(spark, d):
    return _ids(spark, d, text.shorten("resumo").alias("curto"), F.substring("resumo", 1, 240).alias("fixo"))


@query
def date_labels(spark, d):
    return _ids(spark, d, dates.day_label("ts", AS_OF).alias("rotulo"), dates.long_date("ts").alias("longa"))


@query
def report_calendar(spark, d):
    return _ids(spark, d, dates.auto_window_hours(F.to_date("ts")).alias("horas"), dates.next_report_day("ts").alias("recebe")).where("horas is not null")


@query
def masked_addresses(spark, d):
    return subs.cleaned(_t(spark, d, "subs")).select("area", text.mask_email("email").alias("mascara"))


@query
def slug_and_tier(spark, d):
    n = _items(spark, d).groupBy("area").agg(F.count("*").alias("n"))
    return _t(spark, d, "areas").join(n, "area", "left").select("area", text.slug("area").alias("nome"), text.length_tier(F.coalesce("n", F.lit(0))).alias("escalao"))


@query
def resolve_area(spark, d):
    areas = _t(spark, d, "areas").select("area", "area_id", F.row_number().over(Window.orderBy("area_id")).alias("ord"))  # a fixed dimension
    terms = areas.select(F.explode(F.array(F.split_part("area", F.lit(" "), F.lit(1)), F.upper("area"))).alias("term")).distinct()
    return it.resolve_terms(areas, terms)


@query
def select_areas(spark, d):
    terms = spark.createDataFrame([("lotas",), ("Águas",), ("",)], "term string")
    return it.select_areas(_t(spark, d, "areas"), terms).select("area")


@query
def damaged_rows(spark, d):
    return _ids(spark, d, text.damaged("titulo", "resumo", "fonte", "ligacao").alias("estragado"))


@query
def registry_fallback(spark, d):
    return it.with_registry(_items(spark, d), _t(spark, d, "feeds")).select("item_id", "fonte", "dominio")


@query
def title_line(spark, d):
    return _ids(spark, d, text.title_line("titulo", "fonte", dims.country("dominio", DIMS)).alias("linha"))


# filters and classification


def _texts(spark, d):
    return _items(spark, d).select("item_id", "dominio", F.concat("titulo", F.lit(" "), "resumo").alias("texto"))


@query
def classify_keywords(spark, d):
    return rules.hits(_texts(spark, d), _t(spark, d, "rules")).select("item_id", "area_id", "phrase", "kind")


@query
def classify_areas(spark, d):
    gated = _texts(spark, d).where(dims.writes_portuguese("dominio", DIMS))
    found = rules.classified(gated, _t(spark, d, "rules"))
    return found.join(_t(spark, d, "areas"), "area_id").join(_t(spark, d, "grupos"), "group_id").select("item_id", "area", "grupo", "palavras")


@query
def classify_documents(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return rules.classified(docs, _t(spark, d, "rules"), "doc_id", "text")


@query
def classify_by_hits(spark, d):
    """Classification as exclusions (an anti-join) and keywords (a grouping) of the matches."""
    return rules.classify(rules.hits(_texts(spark, d), _t(spark, d, "rules")))


@query
def keyword_search(spark, d):
    """Free-term search: one phrase, by the same rules as classification."""
    one = spark.createDataFrame([("pesquisa", "ponte velha", "keyword", 1)], "area_id string, phrase string, kind string, ord int")
    return rules.hits(_texts(spark, d), one).select("item_id")


@query
def language_gate(spark, d):
    return _ids(spark, d, dims.writes_portuguese("dominio", DIMS).alias("portugues"))


@query
def origin_class(spark, d):
    return _ids(spark, d, dims.origin("dominio", DIMS).alias("origem"))


@query
def source_country(spark, d):
    return _ids(spark, d, dims.country("dominio", DIMS).alias("pais"))


@query
def dimension_defaults(spark, d):
    """The dimensions' own names, looked up with one label more before them."""
    named = sorted({*dims.PORTUGUESE_DOMAINS, *dims.NATIONAL_DOMAINS, *dims.PLATFORMS, *dims.COUNTRY_BY_DOMAIN})
    df = spark.createDataFrame([(n, x) for n in named for x in (n, f"www.{n}", f"sub.{n}", f"x{n}")], "nome string, dominio string")
    return df.select("dominio", dims.origin("dominio").alias("origem"), dims.writes_portuguese("dominio").alias("portugues"), dims.country("dominio").alias("pais"), dims.on_platform("dominio").alias("plataforma"))


@query
def platform_excluded(spark, d):
    return _ids(spark, d, "dominio").where(~dims.on_platform("dominio", DIMS)).select("item_id")


@query
def report_filter(spark, d):
    return it.report_rows(_items(spark, d), AS_OF, 72, origins=("nacionais", "lusofonas"), dims=DIMS).select("item_id")


@query
def synthesis_filter(spark, d):
    return it.report_rows(_items(spark, d), AS_OF, 72, undated=False, dims=DIMS).select("item_id")


@query
def collection_window(spark, d):
    return _items(spark, d).where(it.within_hours(AS_OF, 7 * 24, True)).select("item_id")


@query
def retention_window(spark, d):
    return _items(spark, d).where(it.retained(AS_OF, 7)).select("item_id")


@query
def published_on_day(spark, d):
    return _items(spark, d).where(F.to_date("ts") == F.lit(AS_OF.date())).select("item_id")


@query
def synthesis_fresh(spark, d):
    return _ids(spark, d, report.fresh(F.col("ts"), F.lit("24h"), "24h", AS_OF).alias("fresca"))


@query
def minimum_support(spark, d):
    return report.supported(_items(spark, d), 3, DIMS)


@query
def once_per_day(spark, d):
    return _ids(spark, d, report.due(F.col("ts"), F.lit(AS_OF.date())).alias("devido"))


@query
def subscription_gate(spark, d):
    areas = _items(spark, d).where("area <> ''").select("area").distinct()
    return subs.gate(areas, _t(spark, d, "subs"))


# joins


@query
def area_groups(spark, d):
    return _t(spark, d, "areas").join(_t(spark, d, "grupos"), "group_id").select("area_id", "area", "grupo")


@query
def resolve_links(spark, d):
    return merge.resolve_links(_items(spark, d), "ligacao", lambda u: F.regexp_replace(u, r"[?#].*$", "")).select("item_id", "ligacao")


@query
def area_subscribers(spark, d):
    n = subs.cleaned(_t(spark, d, "subs")).groupBy("area").agg(F.count("*").alias("enderecos"))
    return series.zero_filled(_t(spark, d, "areas").select("area"), "area", n, "enderecos")


@query
def zero_fill_counts(spark, d):
    n = _items(spark, d).groupBy("area").agg(F.count("*").alias("noticias"))
    return series.zero_filled(_t(spark, d, "areas").select("area"), "area", n, "noticias")


@query
def new_since_last(spark, d):
    items = _items(spark, d).where("ligacao <> ''")
    last = items.agg(F.max("run_ord").alias("r"))
    marked = items.crossJoin(F.broadcast(last))  # one row
    return merge.append_new(marked.where("run_ord < r"), marked.where("run_ord = r"), ["area", "ligacao"]).select("item_id")


# aggregation and de-duplication


def _lower(c: str) -> Column:
    return F.lower(F.col(c))


@query
def first_wins_title(spark, d):
    return merge.first_wins(_items(spark, d).where("titulo <> ''"), [_lower("titulo")]).select("item_id")


@query
def first_wins_link(spark, d):
    return merge.first_wins(_items(spark, d), [F.col("area"), F.col("ligacao")]).select("item_id")


@query
def union_keywords(spark, d):
    return merge.first_with_keywords(_items(spark, d), [F.col("area"), _lower("titulo")]).select("item_id", "palavras")


@query
def union_keywords_source(spark, d):
    return merge.first_with_keywords(_items(spark, d), [F.col("area"), _lower("titulo"), _lower("fonte")]).select("item_id", "palavras")


@query
def fill_missing_archive(spark, d):
    got = merge.fill_missing(_items(spark, d), [F.col("area"), _lower("titulo"), _lower("fonte")], ["resumo", "imagem", "ligacao", "dominio", "grupo"], keywords="palavras")
    return got.select("item_id", "titulo", "fonte", "resumo", "imagem", "ligacao", "dominio", "grupo", "palavras")


@query
def fill_missing_corpus(spark, d):
    got = merge.fill_missing(_items(spark, d), [_lower("titulo")], ["resumo", "imagem", "ligacao", "dominio"], newest_first=True)
    return got.select("item_id", "titulo", "resumo", "imagem", "ligacao", "dominio")


@query
def append_new_only(spark, d):
    items = _items(spark, d).where("ts is not null").withColumns({"mes": F.date_format("ts", "yyyy-MM"), "chave": _lower("titulo")})
    return merge.append_new(items.where("run_ord <= 5"), items.where("run_ord > 5"), ["mes", "area", "chave"]).select("item_id", "mes")


@query
def retained_merge(spark, d):
    kept = _items(spark, d).where(it.retained(AS_OF, 7) & ~text.damaged("titulo", "resumo", "fonte", "ligacao"))
    return merge.fill_missing(kept, [F.col("area"), _lower("titulo"), _lower("fonte")], ["resumo", "imagem", "ligacao", "dominio", "grupo"], keywords="palavras").select("item_id", "resumo", "palavras")


def _series(spark, d):
    return series.daily_by_area(_items(spark, d), DIMS)


@query
def daily_by_area(spark, d):
    return _series(spark, d)


@query
def keyword_counts(spark, d):
    return series.daily_keywords(_items(spark, d))


@query
def upsert_day(spark, d):
    s = _series(spark, d)
    new = s.where(F.col("data") == F.lit(AS_OF.date())).withColumn("noticias", F.lit(0).cast("bigint"))
    return merge.upsert(s, new, ["data"]).select("data", "area", "noticias")


def _nested(spark, d):
    items = _items(spark, d)
    return series.nest(series.daily_by_area(items, DIMS), series.daily_keywords(items))


@query
def series_long_area(spark, d):
    return series.long_by_area(_nested(spark, d))


@query
def series_long_keyword(spark, d):
    return series.long_by_keyword(_nested(spark, d))


def _resample(by: str) -> None:
    def f(spark, d):
        return series.resample(_series(spark, d), ["area"], ["noticias", "fontes"], by)

    f.__name__ = f"resample_{by}"
    query(f)


for _by in ("day", "week", "month", "quarter", "year"):
    _resample(_by)


@query
def resample_orders(spark, d):
    o = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("data"), "o_orderstatus", F.lit(1).alias("pedidos"))
    return series.resample(o, ["o_orderstatus"], ["pedidos"], "quarter")


@query
def origin_share(spark, d):
    return series.totals(_series(spark, d))


@query
def top_sources(spark, d):
    return series.value_counts(_items(spark, d), F.col("fonte"), "item_id", 15)


@query
def group_by_day(spark, d):
    return report.by_day(_items(spark, d))


@query
def addresses(spark, d):
    return subs.cleaned(_t(spark, d, "subs")).groupBy("email").agg(F.count("*").alias("areas"))


@query
def merge_partials(spark, d):
    parts = _items(spark, d).groupBy("area", "run_ord").agg(F.count("*").alias("noticias"), F.max("ts").alias("gerado"))
    return merge.merge_parts(parts, "area", ["run_ord", "noticias"], "run_ord", "gerado")


@query
def run_counters(spark, d):
    return series.run_counters(_items(spark, d))


@query
def area_totals(spark, d):
    return series.area_totals(_series(spark, d))


@query
def month_frame(spark, d):
    return _ids(spark, d, "ts", F.to_date("ts").alias("dia"), F.date_format("ts", "yyyy-MM").alias("mes"))


@query
def area_first_group(spark, d):
    return _items(spark, d).where("area <> ''").groupBy("area").agg(F.min_by("grupo", F.struct(*ORDER)).alias("grupo"))


# sorting, limits, sets


@query
def newest_first_undated_last(spark, d):
    return ranked(_items(spark, d).select("item_id", "area", "ts", "run_ord", "feed_ord"), ["area"], newest_first()).select("item_id", "posto")


@query
def newest_first_undated_first(spark, d):
    return ranked(_items(spark, d).select("item_id", "area", "ts", "run_ord", "feed_ord"), ["area"], newest_first(True)).select("item_id", "posto")


@query
def topk_per_group(spark, d):
    dated = _items(spark, d).where("area <> '' and ts is not null").withColumn("origem", dims.origin("dominio", DIMS))
    return report.top_k(dated, [F.col("area"), F.col("origem")], newest_first(), 35).select("item_id", "area", "origem")


@query
def topk_per_keyword(spark, d):
    words = _items(spark, d).select("*", F.explode(F.array_distinct("palavras")).alias("palavra"))
    return report.top_k(words, [F.col("area"), F.col("palavra")], [F.asc(c) for c in ORDER], 60).select("item_id", "area", "palavra")


@query
def preview(spark, d):
    return _items(spark, d).where("ts is not null").orderBy(*newest_first()).limit(20).select("item_id", "ts")


@query
def union_runs(spark, d):
    items = _items(spark, d)
    return merge.union_states(items.where("run_ord <= 5").drop("imagem"), items.where("run_ord > 5")).groupBy("run_ord").agg(F.count("*").alias("linhas"), F.count_if(F.coalesce("imagem", F.lit("")) != "").alias("imagens"))


@query
def subscribe(spark, d):
    s = _t(spark, d, "subs")
    new = s.groupBy("email").agg(F.lit("Tesouraria").alias("area")).select("area", "email")
    return subs.subscribe(s, new)[1]


@query
def cancel(spark, d):
    s = _t(spark, d, "subs")
    return subs.cancel(s, s.where("area like 'Lotas%'"))[0]


@query
def masked_list(spark, d):
    return subs.masked(_t(spark, d, "subs"))


@query
def recipients(spark, d):
    return subs.recipients(_t(spark, d, "subs"))


@query
def hidden_addresses(spark, d):
    return subs.hidden(_t(spark, d, "subs"))


@query
def area_list(spark, d):
    return _items(spark, d).where("area <> ''").select("area").distinct()


# reports


@query
def area_texts(spark, d):
    return report.area_texts(_items(spark, d), AS_OF, 10)


@query
def manifest(spark, d):
    return report.manifest(_items(spark, d), AS_OF)


@query
def summarise_listing(spark, d):
    return report.summarise(_items(spark, d).where("titulo <> ''"), report.listing, 5, dims=DIMS)


def _written(spark, d):
    """Syntheses of two windows, and a single text an area as older files have it."""
    made = report.summarise(_items(spark, d).where("titulo <> ''"), report.listing, 3, dims=DIMS)
    window = F.when(F.col("area") < "J", "24h").otherwise("48h")
    old = made.select("area").distinct().select("area", F.lit(None).cast("string").alias("origem"), F.lit(0).cast("bigint").alias("noticias"), F.lit("Um só texto <antigo>").alias("texto"), F.lit("24h").alias("janela"))
    return made.withColumn("janela", window).unionByName(old).withColumn("gerado", dates.at(datetime(2018, 3, 20, 7, 30)))


@query
def report_documents(spark, d):
    colours = {"Redes e território": "#0e7433", "Casa comum": "#be9c54"}
    return report.documents(_items(spark, d), AS_OF, 12, _written(spark, d), "24h", "https://painel.example/?a=1&b=2", colours, dims=DIMS)


@query
def area_syntheses(spark, d):
    n = _items(spark, d).where("area <> ''").groupBy("area").agg(F.count("*").alias("noticias"))
    return exports.with_syntheses(n, _written(spark, d), AS_OF, "24h")


@query
def daily_reports(spark, d):
    """The job of a day: areas with subscribers, window, origins, documents' counts and manifest."""
    docs, listed = api.reports(_items(spark, d), _t(spark, d, "subs"), AS_OF, "7d", origins=("nacionais", "lusofonas"), dims=DIMS)
    return docs.select("area", "fontes").join(listed, "area")


def _fails(area: str, origem: str, lines: list[str]) -> str:
    if origem == "lusofonas":
        raise RuntimeError("sem resposta")
    return "; ".join(lines) if len(lines) > 3 else "curto"


@query
def syntheses_each(spark, d):
    return report.summarise_each(_items(spark, d).where("titulo <> ''"), _fails, 5, 20, dims=DIMS)


@query
def synthesis_counters(spark, d):
    return report.synthesis_counters(report.summarise_each(_items(spark, d).where("titulo <> ''"), _fails, 5, 20, dims=DIMS))


@query
def confirmations(spark, d):
    s = _t(spark, d, "subs")
    added = subs.subscribe(s, s.groupBy("email").agg(F.lit("Tesouraria & Cofres").alias("area")).select("area", "email"))[1]
    return exports.confirmations(added, AS_OF, panel="https://painel.example/")


@query
def cancellations(spark, d):
    s = _t(spark, d, "subs")
    return exports.confirmations(subs.cancel(s, s.where("area like 'Lotas%' or area like 'A%'"))[1], AS_OF, cancelled=True)


# dashboards


@query
def ranked_areas(spark, d):
    n = it.report_rows(_items(spark, d), AS_OF, 30 * 24, origins=("nacionais",), undated=False, dims=DIMS).where("area <> ''").groupBy("area").agg(F.count("*").alias("noticias"))
    return n.select("area", "noticias", F.rank().over(Window.orderBy(F.desc("noticias"))).cast("bigint").alias("posto"))  # one row an area


@query
def keyword_selection(spark, d):
    return _items(spark, d).where(F.arrays_overlap("palavras", F.array(F.lit("estrada"), F.lit("quota"), F.lit("museu")))).select("item_id")


@query
def excluded_breakdown(spark, d):
    return report.excluded(_items(spark, d), F.array_contains("palavras", "estrada"), dims.origin("dominio", DIMS) == "nacionais", it.within_hours(AS_OF, 7 * 24, False))


@query
def keyword_coverage(spark, d):
    w = _items(spark, d).select("fonte", F.explode(F.array_distinct("palavras")).alias("palavra"))
    return w.groupBy("palavra").agg(F.count("*").alias("noticias"), F.count_distinct(text.filled("fonte")).alias("fontes"))


@query
def evolution_vs_mean(spark, d):
    return series.evolution(_series(spark, d))


@query
def pivot_origin(spark, d):
    return series.pivot_origins(_items(spark, d), "week", DIMS)


@query
def top_areas_trend(spark, d):
    return series.top_areas(_series(spark, d)).select("data", "area", "noticias")


@query
def zero_yield_keywords(spark, d):
    have = series.daily_keywords(_items(spark, d)).where(F.col("data") >= F.date_sub(F.lit(AS_OF.date()), 1)).where(F.col("data") <= F.lit(AS_OF.date()))
    words = _t(spark, d, "rules").where("kind = 'keyword'").join(_t(spark, d, "areas"), "area_id").select("area", F.col("phrase").alias("palavra"))
    return words.join(have, ["area", "palavra"], "left_anti")


@query
def window_selector(spark, d):
    s = _series(spark, d)
    return s.groupBy("area").agg(*[F.sum(F.when(F.col("data") > F.date_sub(F.lit(AS_OF.date()), n), F.col("noticias")).otherwise(0)).alias(f"ultimos_{n}") for n in (7, 30, 90, 365)], F.sum("noticias").alias("tudo"))


@query
def source_concentration(spark, d):
    return series.concentration(_items(spark, d))


# sources, sinks and streams

ATOM, DC, MEDIA = "http://www.w3.org/2005/Atom", "http://purl.org/dc/elements/1.1/", "http://search.yahoo.com/mrss/"


@query
def ingest_feeds(spark, d):
    """Items of each run and feed as a payload, by turns RSS in UTF-8, RDF in declared ISO-8859-1 and Atom in undeclared; read back."""
    items = _items(spark, d).withColumn("forma", F.pmod("run_ord", F.lit(3)))
    held = F.when(F.col("forma") == 0, "[\x00]").when(F.col("forma") == 1, "[^\x09-\xff]|[\x7f-\x9f]").otherwise("[^\x09-\x7e]")  # what the encoding can't say
    items = items.withColumns({c: F.regexp_replace(c, held, "") for c in ("titulo", "resumo", "fonte")})
    tag = lambda name, c, more="": F.concat(F.lit(f"<{name}{more}>"), text.escape_html(c), F.lit(f"</{name.split(' ')[0]}>"))
    moment = F.date_format("ts", "d MMM yyyy HH:mm:ss")
    stamp = F.when(F.col("ts").isNull(), "").otherwise(F.concat(F.lit("<pubDate>Tue, "), moment, F.lit(" +0300</pubDate>")))
    source = F.when(F.col("dominio") != "", F.concat(F.lit('<source url="https://'), text.escape_html("dominio"), F.lit('/x">'), text.escape_html("fonte"), F.lit("</source>"))).otherwise("")
    titled = F.concat(F.col("titulo"), F.when(F.col("fonte") != "", F.concat(F.lit(" - "), F.col("fonte"))).otherwise(""))
    rss = F.concat(F.lit("<item>"), tag("title", titled), tag("link", "ligacao"), tag("description", "resumo"), tag("dc:creator", F.lit("Ana Repórter")), stamp, source, F.lit('<media:content url="'), text.escape_html("imagem"), F.lit('"/></item>'))
    rdf = F.concat(F.lit("<r:item>"), tag("r:title", "titulo"), tag("r:guid", "ligacao"), tag("r:description", F.concat(F.lit("<img alt='x' src='"), F.col("imagem"), F.lit("'> "), F.col("resumo"))), F.lit("</r:item>"))
    iso = F.when(F.col("ts").isNull(), "").otherwise(F.concat(F.lit("<published>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</published>")))
    atom = F.concat(F.lit("<entry>"), tag("title", F.concat("titulo", F.lit(" ção"))), F.lit('<link rel="self" href="https://feed.example/"/><link href="'), text.escape_html("ligacao"), F.lit('"/>'), tag("summary", "resumo"), iso, F.lit("</entry>"))
    part = F.when(F.col("forma") == 0, rss).when(F.col("forma") == 1, rdf).otherwise(atom)
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", part.alias("p")))), lambda x: x["p"]), "")
    body = (
        F.when(F.col("forma") == 0, F.encode(F.concat(F.lit(f'<rss xmlns:dc="{DC}" xmlns:media="{MEDIA}"><channel>'), ordered, F.lit("</channel></rss>")), "UTF-8"))
        .when(F.col("forma") == 1, F.encode(F.concat(F.lit('<?xml version="1.0" encoding="ISO-8859-1"?><RDF xmlns:r="urn:r">'), ordered, F.lit("</RDF>")), "ISO-8859-1"))
        .otherwise(F.encode(F.concat(F.lit(f'<feed xmlns="{ATOM}">'), ordered, F.lit("</feed>")), "ISO-8859-1"))
    )
    key = (F.col("run_ord") * 1000 + F.col("feed_ord")).cast("int")  # a payload a run and feed
    payloads = items.groupBy(key.alias("feed_ord"), "forma").agg(body.alias("body"))
    known = items.select(key.alias("k"), F.col("feed_ord").alias("f")).distinct().join(_t(spark, d, "feeds"), F.col("f") == F.col("feed_ord")).select(F.col("k").alias("feed_ord"), "source", "domain")
    return feeds.items(payloads, known, AS_OF)[0].drop("run_ord")


@query
def registry_lists(spark, d):
    f = _t(spark, d, "feeds")
    part = lambda name: f.where(F.col("registry") == name)
    return feeds.registry(part("nacional"), part("lusofona").drop("url")).select("feed_ord", "source", "domain", "url")


@query
def search_queries(spark, d):
    r = _t(spark, d, "rules").groupBy("area_id").agg(
        *[F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("ord", "phrase")))), lambda x: x["phrase"]).alias(kind) for kind in ("keyword", "exclude")]
    )
    q = feeds.search_query(F.col("keyword"), F.col("exclude"), F.array(F.lit(".br"), F.lit("globo.com")), 7)
    return r.select("area_id", q.alias("consulta"), feeds.search_url(q, "https://noticias.example/rss/search").alias("endereco"))


@query
def keyword_source(spark, d):
    """Each area's keywords searched one by one: a loose search gives all items of the area."""
    words = _t(spark, d, "rules").where("kind = 'keyword'").join(_t(spark, d, "areas"), "area_id").select("area", F.col("phrase").alias("palavra")).distinct()
    fetched = _items(spark, d).drop("palavras").join(words, "area")
    return feeds.by_keyword(fetched).select("item_id", "area", "palavras")


@query
def run_document(spark, d):
    """The document of a run, written and read."""
    path = fresh_path(spark, "documento") + ".json"
    rows = it.report_rows(_items(spark, d), AS_OF, 48, undated=False, dims=DIMS)
    state.write_snapshot(rows, path, AS_OF, "48h", "publicações")
    head = state.read_header(spark, path, "gerado string, origem string, periodo string")
    return state.read_items(spark, path).crossJoin(F.broadcast(head))  # one row


@query
def archive_document(spark, d):
    """The rolling archive after a run, as one document, written and read."""
    path = fresh_path(spark, "arquivo") + ".json"
    items = _items(spark, d)
    rolled = api.roll(items.where("run_ord <= 5"), items.where("run_ord > 5"), AS_OF)
    state.write_document(rolled, path, AS_OF, {"dias": 7})
    return state.read_items(spark, path)


@query
def archive_corpus(spark, d):
    items = _items(spark, d).where("titulo <> ''")
    return api.roll(items.where("run_ord <= 5"), items.where("run_ord > 5"), AS_OF, corpus=True).select("item_id", "titulo", "resumo", "imagem", "ligacao", "dominio")


@query
def months_archive(spark, d):
    """The permanent archive after two runs, one of them repeated, and its files read."""
    path = fresh_path(spark, "meses")
    items = _items(spark, d)
    for run in (items.where("run_ord <= 5"), items.where("run_ord > 5"), items.where("run_ord > 5")):
        state.append_months(run, path)
    return state.read_month(spark, path + "/mes=*/*.json.gz").withColumn("mes", F.substring("data", 1, 7)).select("mes", "area", "data", "titulo", "fonte", "palavras")


@query
def missing_state(spark, d):
    """State that isn't there, and state that can't be read, both as empty; and damaged lines of a month left out."""
    path = fresh_path(spark, "estado")
    state.put(spark, path + "/mau.parquet", b"isto nao e um quadro")
    state.put(spark, path + "/mes.jsonl", b'{"area": "A", "titulo": "um"}\n{"area": \n\n{"area": "B", "titulo": "dois"}\n')
    none = state.read_or_empty(spark, path + "/nada", state.ITEM)
    bad = state.read_or_empty(spark, path + "/mau.parquet", state.ITEM, on_corrupt="empty")
    return none.unionByName(bad).unionByName(state.read_month(spark, path + "/mes.jsonl", strict=False)).select("area", "titulo")


@query
def series_document(spark, d):
    """The daily series as one document, written and read."""
    path = fresh_path(spark, "serie") + ".json"
    state.put(spark, path, state.series_document(_nested(spark, d), AS_OF).encode())
    return series.long_by_area(state.read_series(spark, path))


@query
def longitudinal_months(spark, d):
    path = fresh_path(spark, "serie") + ".json"
    state.put(spark, path, state.series_document(_nested(spark, d), AS_OF).encode())
    return api.longitudinal(spark, path, "month", keywords=True)


@query
def csv_table(spark, d):
    path = fresh_path(spark, "tabela")
    exports.write_csv(_ids(spark, d, "titulo", "fonte"), path)
    return exports.read_csv(spark, path, "item_id bigint, titulo string, fonte string")


@query
def spreadsheet(spark, d):
    path = fresh_path(spark, "folha") + ".xlsx"
    exports.write_xlsx(series.value_counts(_items(spark, d), F.col("fonte"), "item_id", 15), path)
    return exports.read_sheet(spark, path)


@query
def workbook_counts(spark, d):
    """The workbook's sheet of counts by area, with its formulas."""
    path = fresh_path(spark, "livro") + ".xlsx"
    items = it.report_rows(_items(spark, d), AS_OF, 48, undated=False, dims=DIMS)
    exports.write_workbook(items, _t(spark, d, "areas"), spark.createDataFrame([("a", "erro")], "area string, erro string"), path)
    return exports.read_sheet(spark, path, 2)


def _in_turn(spark, d) -> str:
    """The archive's table in three parts, in the order of its runs."""
    path, items = fresh_path(spark, "entradas"), _t(spark, d, "arquivo")
    for part in ("run_ord <= 3", "run_ord between 4 and 7", "run_ord > 7"):
        items.where(part).coalesce(1).write.mode("append").parquet(path)
    return path


@query
def stream_archive(spark, d):
    """The rolling archive kept by a stream in three batches, all of which come again after the checkpoint was lost."""
    source, path, schema = _in_turn(spark, d), fresh_path(spark, "versoes"), _t(spark, d, "arquivo").schema
    for k in range(2):
        archive.run_archive(archive.read_items(spark, source, schema), f"{path}/v", f"{path}/checkpoint-{k}", AS_OF).awaitTermination()
    return archive.latest(spark, f"{path}/v").select("item_id", "resumo", "palavras")


@query
def stream_first_seen(spark, d):
    path = fresh_path(spark, "vistos")
    seen = archive.first_seen(archive.read_items(spark, f"{d}/arquivo.parque[t]", _t(spark, d, "arquivo").schema, 100)).select("ligacao")
    seen.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def stream_daily(spark, d):
    """Daily counts kept by a stream over the archive's files."""
    schema = _t(spark, d, "arquivo").schema
    counts = archive.daily_counts(archive.read_items(spark, f"{d}/arquivo.parque[t]", schema, 100), dims=DIMS)
    path = fresh_path(spark, "contagens")
    upsert = lambda df, n: archive.upsert_counts(df, n, f"{path}/out")
    counts.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return archive.current_counts(spark, f"{path}/out")


def queries() -> dict[str, Query]:
    return dict(QUERIES)
