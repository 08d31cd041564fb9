from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clipfold.functions import dates, text
from clipfold.operators import items as it
from clipfold.operators import dims, merge, report, series, subs
from clipfold.plans.ranked import ranked

AS_OF = datetime(2026, 8, 8, 12, 0)
ITEM = "run_ord int, feed_ord int, item_id bigint, area string, grupo string, data string, fonte string, dominio string, titulo string, resumo string, ligacao string, palavras array<string>, imagem string"


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


def item(k, run=1, area="A", data="2026-08-08 10:00", fonte="F", titulo="T", resumo="", ligacao="", palavras=(), imagem="", dominio="a.pt"):
    return (run, 1, k, area, "G", data, fonte, dominio, titulo, resumo, ligacao, list(palavras), imagem)


def items(spark, *rows):
    return it.normalise(spark.createDataFrame(list(rows), ITEM))


@pytest.mark.parametrize("domain, want", [("", "nacionais"), ("www.a.pt", "nacionais"), ("x.co.ao", "lusofonas"), ("b.com", "internacionais"), (None, "nacionais")])
def test_origin(spark, domain, want):
    df = spark.createDataFrame([(domain,)], "d string")
    assert df.select(it.origin("d").alias("o")).first().o == want


def test_mail_dates(spark):
    f = lambda s: one(spark, dates.parse_rfc(F.col("s"), AS_OF), s=s)
    assert f("Fri, 07 Aug 2026 16:40:00 +0200") == datetime(2026, 8, 7, 15, 40)
    assert f("Sat, 08 Aug 2026 23:00:00 GMT") == AS_OF
    assert f("nonsense") is None


def test_titles(spark):
    df = spark.createDataFrame([("A - B - Fonte", ""), ("A - B", "b"), ("A - B", "Z"), ("A", "")], "t string, s string")
    t, s = text.split_title("t", "s")
    assert [tuple(r) for r in df.select(t, s).collect()] == [("A - B", "Fonte"), ("A", "b"), ("A - B", "Z"), ("A", "")]
    assert one(spark, text.summary_unless_title("r", "t"), r="Uma casa nova, diz", t="Uma casa nova") == ""
    assert one(spark, text.summary_unless_title("r", "t"), r="— Governo aprova lei. Jornal", t="Governo aprova lei") == ""


def test_entities_and_addresses(spark):
    assert one(spark, text.clean_html("x"), x="Educa&ccedil;&atilde;o <b>&#233;</b>&amp;lt;") == "Educação é &lt;"
    link = lambda u: one(spark, text.plausible_url("u"), u=u)
    assert link("HTTPS://jornal.example/artigo-google.-novo") and link("https://www.youtube.com/watch?v=1") and not link("https://lh3.googleusercontent.com/a")
    other = "https://jornal.example/articles/aHR0cHM6Ly9qb3JuYWwuZXhhbXBsZS9hcnRpZ28tdW0"
    assert one(spark, text.redirect_target("u"), u=other) == other
    assert one(spark, text.redirect_target("u"), u=other.replace("jornal.example", "news.google.com/rss")) == "https://jornal.example/artigo-um"
    assert one(spark, text.redirect_target("u"), u="https://news.google.com/rss/articles/%%%a") == "https://news.google.com/rss/articles/%%%a"


def test_dimensions_from_a_table(spark):
    rows = [("WWW.blog.com", "national", None), ("k.de", "portuguese", None), ("rede.pt", "platform", None), ("z.com", "country", "Chile"), (None, "national", None)]
    d = dims.from_table(spark.createDataFrame(rows, "domain string, kind string, value string"))
    at = lambda f, x: one(spark, f("x", d), x=x)
    assert at(dims.origin, "sub.blog.com") == "nacionais" and at(dims.origin, "xblog.com") == "internacionais" and at(dims.writes_portuguese, "k.de") and at(dims.writes_portuguese, "blog.com")
    assert at(dims.on_platform, "m.rede.pt") and at(dims.country, "z.com") == "Chile" and at(dims.country, "a.it") == "Itália" and at(dims.origin, "noticiasaominuto.com") == "nacionais"


def test_ranks_are_those_of_a_window(spark):
    df = spark.range(500).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 'a' else 'b' end g", "cast(id * 7919 % 101 as int) v").repartition(7)
    got = {r.id: r.posto for r in ranked(df, ["g"], [F.desc("v"), F.asc("id")]).collect()}
    want = {r.id: r.n for r in df.selectExpr("id", "row_number() over (partition by g order by v desc, id) n").collect()}
    assert got == want
    assert sorted(r.posto for r in ranked(df, [], [F.asc("id")]).collect()) == list(range(1, 501))
    assert ranked(df.limit(0), ["g"], [F.asc("id")]).count() == 0


def test_failing_groups_leave_the_others(spark):
    def write(area, origem, lines):
        if area == "B":
            raise ValueError("x")
        return "palavra " * 10

    df = items(spark, *[item(k, area=a) for a in "ABC" for k in range(3)], item(9, area="D"))
    got = {r.area: (r.estado, r.erro) for r in report.summarise_each(df, write).collect()}
    assert got == {"A": ("escrita", None), "B": ("falhou", "ValueError: x"), "C": ("escrita", None), "D": ("poucas", None)}


@pytest.mark.parametrize("email, want", [("ana@x.pt", "a***@x.pt"), ("abcdef@x.pt", "abc***@x.pt"), ("abcdefghi@x.pt", "abc******@x.pt")])
def test_masks(spark, email, want):
    assert one(spark, text.mask_email("e"), e=email) == want


def test_calendar(spark):
    friday = datetime(2026, 8, 7, 11, 0)
    assert one(spark, dates.next_report_day("d"), d=friday) == date(2026, 8, 10)
    assert one(spark, dates.next_report_day("d"), d=datetime(2026, 8, 7, 9, 0)) == date(2026, 8, 7)
    assert one(spark, dates.auto_window_hours("d"), d=date(2026, 8, 10)) == 72
    assert one(spark, dates.auto_window_hours("d"), d=date(2026, 8, 11)) == 24


def test_retention_is_by_calendar_day(spark):
    df = items(spark, item(1, data="2026-08-01 00:00"), item(2, data="2026-07-31 23:59"), item(3, data=None), item(4, data="?"))
    assert [r.item_id for r in df.where(it.retained(AS_OF, 7)).collect()] == [1]


def test_undated_rows_pass_reports_but_not_syntheses(spark):
    df = items(spark, item(1, data=None), item(2, data="2026-08-08 11:00"), item(3, data="2026-08-01 11:00"))
    ids = lambda x: sorted(r.item_id for r in x.collect())
    assert ids(it.report_rows(df, AS_OF)) == [1, 2]
    assert ids(it.report_rows(df, AS_OF, undated=False)) == [2]


def test_archive_keeps_old_text_and_takes_new_image(spark):
    df = items(spark, item(1, run=1, resumo="velho"), item(2, run=2, titulo="t", fonte="f", resumo="novo", imagem="i", palavras=["k"]))
    key = [F.col("area"), F.lower("titulo"), F.lower("fonte")]
    got = merge.fill_missing(df, key, ["resumo", "imagem"], keywords="palavras").collect()
    assert [(r.item_id, r.resumo, r.imagem, r.palavras) for r in got] == [(1, "velho", "i", ["k"])]
    got = merge.fill_missing(df, [F.lower("titulo")], ["resumo"], newest_first=True).collect()
    assert [(r.item_id, r.resumo) for r in got] == [(2, "novo")]


def test_merges_are_idempotent_whatever_the_partitions(spark):
    df = it.normalise(spark.read.parquet("/root/testdata/sf0.001/arquivo.parquet"))
    key = [F.col("area"), F.lower("titulo"), F.lower("fonte")]
    once = merge.fill_missing(df, key, ["resumo", "imagem"], keywords="palavras")
    for n in (1, 7):
        again = merge.fill_missing(once.unionByName(df).repartition(n), key, ["resumo", "imagem"], keywords="palavras")
        assert again.exceptAll(once).count() == 0 and once.exceptAll(again).count() == 0
    first = merge.first_wins(df.repartition(5), [F.lower("titulo")])
    assert first.exceptAll(merge.first_wins(df.coalesce(1), [F.lower("titulo")])).count() == 0


def test_upsert_replaces(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "d int, v string")
    new = spark.createDataFrame([(2, "c")], "d int, v string")
    assert sorted(map(tuple, merge.upsert(merge.upsert(old, new, ["d"]), new, ["d"]).collect())) == [(1, "a"), (2, "c")]


def test_resample_fills_gaps(spark):
    s = spark.createDataFrame([(date(2026, 1, 5), "A", 2), (date(2026, 3, 1), "A", 3)], "data date, area string, noticias int")
    got = sorted(map(tuple, series.resample(s, ["area"], ["noticias"], "month").collect()))
    assert got == [(date(2026, 1, 31), "A", 2), (date(2026, 2, 28), "A", 0), (date(2026, 3, 31), "A", 3)]
    s = spark.createDataFrame([(date(2026, 8, 9), "A", 1), (date(2026, 8, 10), "A", 1)], "data date, area string, noticias int")
    assert sorted(r.periodo for r in series.resample(s, ["area"], ["noticias"], "week").collect()) == [date(2026, 8, 9), date(2026, 8, 16)]


def test_nested_series_round_trip(spark):
    df = items(spark, item(1, palavras=["x", "y"]), item(2, palavras=["x"], dominio="b.com"), item(3, area="B"))
    by_area, by_word = series.daily_by_area(df), series.daily_keywords(df)
    nested = series.nest(by_area, by_word)
    assert nested.count() == 1
    assert sorted(map(tuple, series.long_by_keyword(nested).collect())) == sorted(map(tuple, by_word.collect()))
    back = series.long_by_area(nested).select(by_area.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, by_area.collect()))


def test_subscribers(spark):
    s = spark.createDataFrame([("A", " Ana@X.pt "), ("A", "ana@x.pt"), ("B", "bad"), (None, "b@x.pt")], "area string, email string")
    new = spark.createDataFrame([("A", "ANA@x.pt"), ("B", "b@x.pt")], "area string, email string")
    have, added = subs.subscribe(s, new)
    assert sorted(map(tuple, added.collect())) == [("B", "b@x.pt")]
    assert subs.subscribe(have, new)[1].count() == 0
    left, gone = subs.cancel(have, spark.createDataFrame([("A", "ana@x.pt"), ("Z", "z@x.pt")], "area string, email string"))
    assert [tuple(r) for r in left.collect()] == [("B", "b@x.pt")] and gone.count() == 1
    none = spark.createDataFrame([], "area string, email string")
    areas = spark.createDataFrame([("A",), ("B",)], "area string")
    assert subs.gate(areas, none).count() == 2 and [r.area for r in subs.gate(areas, left).collect()] == ["B"]


def test_fresh(spark):
    at = lambda h, m, w="24h": one(spark, report.fresh(F.col("t").cast("timestamp_ntz"), F.lit(w), "24h", AS_OF), t=datetime(2026, 8, 8, h, m))
    assert at(4, 0) is True and at(3, 54) is False and at(11, 0, "48h") is False


def test_summaries(spark):
    df = items(spark, *[item(k, titulo=f"um título bastante longo {k}") for k in range(3)], item(9, area="B"))
    got = report.summarise(df, report.listing, 2).collect()
    assert [(r.area, r.noticias, r.texto.count(";")) for r in got] == [("A", 3, 1)]


def test_a_model_that_needs_less_memory():
    def load(n):
        if n > 3000:
            raise MemoryError
        return n

    assert report.loaded(load) == 2048
