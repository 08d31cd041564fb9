"""Reports by area: day groups, text and HTML documents, manifest, syntheses."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipfold.functions.dates import MONTHS, at, day_label
from clipfold.functions.text import escape_html, filled, safe_url, shorten, slug
from clipfold.operators.dims import DEFAULT, Dimensions, origin
from clipfold.operators.items import ORDER, newest_first

#: Origins in the order in which reports show them, with their labels; what unnamed sources are called.
LABELS = {"nacionais": "Portugal", "lusofonas": "Lusofonia", "internacionais": "Internacional"}
UNNAMED = "sem indicação"


def top_k(df: DataFrame, by: list[Column], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts groups before the shuffle already. ``rank`` names a column for the place."""
    out = df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= k)
    return out.withColumnRenamed("__n", rank) if rank else out.drop("__n")


def by_day(items: DataFrame) -> DataFrame:
    """Items and distinct sources by area and day; undated ones on a null day, unnamed sources as one."""
    return items.where("area <> ''").groupBy("area", F.to_date("ts").alias("dia")).agg(F.count("*").alias("noticias"), F.count_distinct(F.coalesce(filled("fonte"), F.lit(UNNAMED))).alias("fontes"))


def plural(n: Column, one: str, many: str) -> Column:
    return F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, one).otherwise(many))


def _joined(parts: str, sep: str, f: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(parts, f), sep)


def _tag(name: str, *inside: Column, attributes: Column | None = None) -> Column:
    return F.concat(F.lit(f"<{name}"), *([attributes] if attributes is not None else []), F.lit(">"), *inside, F.lit(f"</{name}>"))


def _item_html(label: Column) -> Column:
    link, image = safe_url("ligacao"), safe_url("imagem")
    summary = shorten("resumo")
    return _tag(
        "tr",
        _tag("td", F.coalesce(F.date_format("ts", "HH:mm"), F.lit("—"))),
        F.when(image != "", _tag("td", F.concat(F.lit('<img src="'), escape_html(image), F.lit('">')))).otherwise(""),
        _tag(
            "td",
            _tag("a", escape_html("titulo"), attributes=F.concat(F.lit(' href="'), escape_html(F.when(link != "", link).otherwise("#")), F.lit('"'))),
            F.when(summary != "", _tag("p", escape_html(summary))).otherwise(""),
            _tag("small", escape_html("fonte"), F.lit(" · "), label),
        ),
    )


def _item_text(label: Column) -> Column:
    indent = F.lit("\n        ")
    return F.concat(
        F.lit("["), F.coalesce(F.date_format("ts", "HH:mm"), F.lit("--:--")), F.lit("] "), F.col("titulo"),
        F.when(F.col("resumo") != "", F.concat(indent, F.substring("resumo", 1, 150))).otherwise(""),
        indent, F.col("fonte"), F.lit(" · "), label,
        F.when(safe_url("ligacao") != "", F.concat(indent, F.col("ligacao"))).otherwise(""), F.lit("\n"),
    )


def syntheses_by_area(syntheses: DataFrame, as_of: datetime, window: str) -> DataFrame:
    """``area, sintese_html, sintese_texto`` of the syntheses (``area, janela, gerado, origem, noticias, texto``) that are fresh.

    Paragraphs stand in the fixed order of origins, with the hour they were written; a row of no origin is the single text
    that older files have, shown where the area has no other.
    """
    ok = syntheses.where(fresh(F.col("gerado"), F.col("janela"), window, as_of))
    place = F.coalesce(F.array_position(F.array(*map(F.lit, LABELS)), F.col("origem")), F.lit(0))
    known = ok.where(F.col("origem").isNull() | F.col("origem").isin(*LABELS)).select("area", "gerado", F.struct(place.alias("k"), "origem", "noticias", "texto").alias("p"))
    g = known.groupBy("area").agg(F.array_sort(F.collect_list("p")).alias("all"), F.max("gerado").alias("gerado"))  # a paragraph an origin
    parts = F.filter("all", lambda p: p["origem"].isNotNull())
    g = g.withColumn("parts", F.when(F.size(parts) > 0, parts).otherwise(F.slice("all", 1, 1)))
    label = lambda p: _label(p["origem"])
    head = F.concat(F.lit("Síntese · escrita às "), F.date_format("gerado", "HH:mm"))
    html = _joined("parts", "", lambda p: F.concat(F.when(p["origem"].isNull(), "").otherwise(_tag("h4", label(p), F.lit(" · "), plural(p["noticias"], "notícia", "notícias"))), _tag("p", escape_html(p["texto"]))))
    text = _joined("parts", "\n", lambda p: F.concat(F.when(p["origem"].isNull(), "").otherwise(F.concat(F.lit("["), F.upper(label(p)), F.lit("] "), plural(p["noticias"], "notícia", "notícias"), F.lit("\n"))), p["texto"], F.lit("\n")))
    return g.select("area", F.concat(_tag("h3", head), html).alias("sintese_html"), F.concat(head, F.lit("\n"), text).alias("sintese_texto"))


def _label(o: Column) -> Column:
    out = F.lit("")
    for name, label in LABELS.items():
        out = F.when(o == name, label).otherwise(out)
    return out


def documents(
    items: DataFrame, as_of: datetime, per_area: int = 200, syntheses: DataFrame | None = None, window: str = "24h", panel: str = "", colours: dict[str, str] | None = None,
    colour: str = "#1f3a5f", order: tuple[str, ...] = ORDER, dims: Dimensions = DEFAULT,
) -> DataFrame:
    """``area, noticias, fontes, html, texto``: a report for each area with items.

    Items stand under their day, the newest first and undated ones before; the counts of the area and of each day are over all
    items, while the ``per_area`` newest are printed, which bounds a document. The section has the colour of the area's
    first group (``colours``), its syntheses, and a link to the panel.
    """
    named = items.where("area <> ''")
    counts = named.groupBy("area").agg(
        F.count("*").alias("noticias"), F.count_distinct(F.coalesce(filled("fonte"), F.lit(UNNAMED))).alias("fontes"), F.min_by("grupo", F.struct(*order)).alias("grupo")
    )
    days = named.groupBy("area", F.to_date("ts").alias("dia")).agg(F.count("*").alias("do_dia"))
    newest = [F.desc_nulls_first("ts"), *[F.asc(c) for c in order]]
    label = _label(origin("dominio", dims))
    top = top_k(named, [F.col("area")], newest, per_area, "__n").select("area", F.to_date("ts").alias("dia"), "__n", _item_html(label).alias("h"), _item_text(label).alias("t"))
    grouped = top.groupBy("area", "dia").agg(F.array_sort(F.collect_list(F.struct("__n", "h", "t"))).alias("i"))  # at most per_area
    grouped = grouped.join(days, grouped["area"].eqNullSafe(days["area"]) & grouped["dia"].eqNullSafe(days["dia"])).select(grouped["area"], grouped["dia"], "i", "do_dia")
    head = _tag("tr", _tag("th", day_label("dia", as_of), F.lit(" · "), F.col("do_dia").cast("string"), attributes=F.lit(' colspan="3"')))
    parts = grouped.select("area", F.struct(F.col("i")[0]["__n"].alias("n"), F.concat(head, _joined("i", "", lambda x: x["h"])).alias("h"), _joined("i", "\n", lambda x: x["t"]).alias("t")).alias("d"))
    made = parts.groupBy("area").agg(F.array_sort(F.collect_list("d")).alias("d"))
    out = counts.join(made, "area")
    if syntheses is not None:
        out = out.join(syntheses_by_area(syntheses, as_of, window), "area", "left")
    else:
        out = out.withColumns({"sintese_html": F.lit(""), "sintese_texto": F.lit("")})
    tone = F.lit(colour)
    for group, value in (colours or {}).items():
        tone = F.when(F.col("grupo") == group, value).otherwise(tone)
    n = plural(F.col("noticias"), "notícia", "notícias")
    html = _tag(
        "section", _tag("h2", escape_html("area")), _tag("p", n, F.lit(" · "), plural(F.col("fontes"), "publicação", "publicações")), F.coalesce("sintese_html", F.lit("")),
        _tag("table", _joined("d", "", lambda x: x["h"])), _tag("p", _tag("a", F.lit("Abrir o painel"), attributes=F.concat(F.lit(' href="'), escape_html(F.lit(panel)), F.lit('"')))) if panel else F.lit(""),
        attributes=F.concat(F.lit(' style="border-color:'), tone, F.lit('"')),
    )
    text = F.concat_ws("\n", F.upper("area"), n, F.lit(""), filled(F.coalesce("sintese_texto", F.lit(""))), _joined("d", "\n", lambda x: x["t"]), F.lit(f"Abrir o painel: {panel}") if panel else F.lit(None).cast("string"))
    return out.select("area", "noticias", "fontes", html.alias("html"), text.alias("texto"))


def area_texts(items: DataFrame, as_of: datetime, per_area: int = 40) -> DataFrame:
    """``area, noticias, texto, html``: plain lists of the newest ``per_area`` items of each area, undated ones last."""
    count = items.where("area <> ''").groupBy("area").agg(F.count("*").alias("noticias"))
    line = F.concat(day_label("ts", as_of), F.lit(": "), shorten("titulo"), F.lit(" — "), F.coalesce(filled("fonte"), F.lit(UNNAMED)))
    link, title = safe_url("ligacao"), escape_html(shorten("titulo"))
    html = F.concat(F.lit("<li>"), F.when(link != "", F.concat(F.lit('<a href="'), escape_html(link), F.lit('">'), title, F.lit("</a>"))).otherwise(title), F.lit("</li>"))
    rows = top_k(items.where("area <> ''"), [F.col("area")], newest_first(), per_area, "__n").select("area", F.struct("__n", line.alias("t"), html.alias("h")).alias("r"))
    made = rows.groupBy("area").agg(F.array_sort(F.collect_list("r")).alias("r"))
    return count.join(made.select("area", _joined("r", "\n", lambda x: x["t"]).alias("texto"), _joined("r", "", lambda x: x["h"]).alias("html")), "area")


def manifest(items: DataFrame, as_of: datetime, title: str | None = None) -> DataFrame:
    """``area, ficheiro, texto, assunto, noticias``: one report an area with items; ``title`` begins the subjects."""
    n = items.where("area <> ''").groupBy("area").agg(F.count("*").alias("noticias"))
    name = slug("area")
    subject = F.concat_ws(" · ", F.lit(title), F.col("area"), F.lit(f"{as_of.day} de {MONTHS[as_of.month - 1]}"), plural(F.col("noticias"), "notícia", "notícias"))
    return n.select("area", F.concat(name, F.lit(".html")).alias("ficheiro"), F.concat(name, F.lit(".txt")).alias("texto"), subject.alias("assunto"), "noticias")


def supported(items: DataFrame, least: int = 3, dims: Dimensions = DEFAULT) -> DataFrame:
    """``area, origem, noticias``: groups with at least ``least`` items."""
    return items.where("area <> ''").groupBy("area", origin("dominio", dims).alias("origem")).agg(F.count("*").alias("noticias")).where(F.col("noticias") >= least)


def fresh(made: Column, window: Column, wanted: str, as_of: datetime, hours: float = 8.0) -> Column:
    """Whether a synthesis may be shown: of the same window, its time readable, and not older than ``hours``."""
    age = F.timestamp_diff("SECOND", made, at(as_of))
    return F.coalesce((window == wanted) & (age <= hours * 3600), F.lit(False))


def due(moment: Column, marker: Column, first_hour: int = 8, last_hour: int = 12) -> Column:
    """Once a day: on weekdays, within hours, if the marker isn't of that day."""
    return F.coalesce((F.weekday(moment) < 5) & F.hour(moment).between(first_hour, last_hour) & (marker != moment.cast("date")), F.lit(False))


def excluded(items: DataFrame, keyword: Column, wanted: Column, window: Column) -> DataFrame:
    """One row: kept rows, and how many fail each condition and only it."""
    k, o, w = (F.coalesce(x, F.lit(False)) for x in (keyword, wanted, window))
    return items.agg(
        F.count("*").alias("todas"), F.count_if(k & o & w).alias("ficam"), F.count_if(~k).alias("sem_palavra"), F.count_if(~o).alias("outra_origem"), F.count_if(~w).alias("fora_do_periodo"),
        F.count_if(~k & o & w).alias("so_palavra"), F.count_if(k & ~o & w).alias("so_origem"), F.count_if(k & o & ~w).alias("so_periodo"),
    )


def groups_of_lines(items: DataFrame, per_group: int = 35, dims: Dimensions = DEFAULT) -> DataFrame:
    """``area, origem, noticias, linhas``: the titles of each group's ``per_group`` newest items, and how many it has."""
    groups = items.where("area <> ''").withColumn("origem", origin("dominio", dims))
    count = groups.groupBy("area", "origem").agg(F.count("*").alias("noticias"))
    top = top_k(groups, [F.col("area"), F.col("origem")], newest_first(), per_group, "n")
    lines = top.groupBy("area", "origem").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "titulo"))), lambda x: x["titulo"]).alias("linhas"))
    return count.join(lines, ["area", "origem"])


def summarise(items: DataFrame, write, per_group: int = 35, least: int = 3, shortest: int = 40, dims: Dimensions = DEFAULT) -> DataFrame:
    """``area, origem, noticias, texto``: a paragraph for each group by ``write(area, origin, lines)``, Columns.

    Groups below ``least`` and paragraphs below ``shortest`` characters are left out.
    """
    texts = groups_of_lines(items, per_group, dims).where(F.col("noticias") >= least)
    return texts.withColumn("texto", F.trim(write(F.col("area"), F.col("origem"), F.col("linhas")))).where(F.length("texto") >= shortest).drop("linhas")


def summarise_each(items: DataFrame, write: Callable[[str, str, list[str]], str], per_group: int = 35, least: int = 3, shortest: int = 40, dims: Dimensions = DEFAULT) -> DataFrame:
    """``area, origem, noticias, texto, estado, erro`` of every group, by a Python writer such as a model's client.

    A group whose writer fails has its error and ``falhou``, the others go on; ``poucas`` and ``curta`` are groups below
    ``least`` and paragraphs below ``shortest``; ``escrita`` are good. Groups are spread over tasks.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in frames:
            out = []
            for area, o, n, lines in zip(g["area"], g["origem"], g["noticias"], g["linhas"]):
                text, state, error = None, "poucas", None
                if n >= least:
                    try:
                        text = (write(area, o, list(lines)) or "").strip()
                        state = "escrita" if len(text) >= shortest else "curta"
                    except Exception as e:  # the fault of one group is its own
                        state, error = "falhou", f"{type(e).__name__}: {e}"
                out.append((area, o, n, text if state == "escrita" else None, state, error))
            yield pd.DataFrame(out, columns=["area", "origem", "noticias", "texto", "estado", "erro"])

    spread = groups_of_lines(items, per_group, dims).repartition("area", "origem")
    return spread.mapInPandas(run, "area string, origem string, noticias bigint, texto string, estado string, erro string")


def loaded(load: Callable[[int], object], context: int = 4096) -> object:
    """A model by ``load(context)``; with half the context where memory doesn't suffice."""
    try:
        return load(context)
    except Exception:
        return load(context // 2)


def synthesis_counters(written: DataFrame) -> DataFrame:
    """One row: groups written, with too few items, failed, and too short, of ``summarise_each``'s."""
    return written.agg(*[F.count_if(F.col("estado") == state).alias(name) for state, name in (("escrita", "escritas"), ("poucas", "poucas"), ("falhou", "falhadas"), ("curta", "curtas"))])


def listing(area: Column, origem: Column, lines: Column) -> Column:
    """A paragraph made of the titles themselves, where no model is given."""
    return F.concat(area, F.lit(" ("), origem, F.lit("): "), F.array_join(lines, "; "), F.lit("."))
