import json
from datetime import datetime

import pytest

from clipfold import api
from clipfold.operators import items as it
from clipfold.plans import cut
from clipfold.sources import exports, feeds
from tests.test_operators import item, items

AS_OF = datetime(2026, 8, 8, 12, 0)
RSS = "<rss><channel><item><title>{}</title><link>https://a.pt/{}</link><pubDate>Sat, 08 Aug 2026 08:00:00 +0100</pubDate></item><item><title>Outra</title></item></channel></rss>"


def dims(spark):
    return (
        spark.createDataFrame([(1, "Gazeta", "a.pt"), (2, "Diário", "b.pt"), (3, "Faro", "c.es")], "feed_ord int, source string, domain string"),
        spark.createDataFrame([("p", "Pontes", "g"), ("m", "Museus", "g")], "area_id string, area string, group_id string"),
        spark.createDataFrame([("g", "Grupo")], "group_id string, grupo string"),
        spark.createDataFrame([("p", "ponte", "keyword", 1), ("m", "museu", "keyword", 1)], "area_id string, phrase string, kind string, ord int"),
    )


def test_a_run_from_payload_to_archive(spark):
    reg, areas, groups, rules = dims(spark)
    bodies = [(1, "u", bytearray(RSS.format("A ponte nova", 1).encode())), (2, "u", bytearray(RSS.format("A PONTE NOVA", 2).encode())), (3, "u", bytearray(RSS.format("La ponte", 3).encode()))]
    got = api.collect(spark.createDataFrame(bodies, feeds.PAYLOAD), reg, areas, groups, rules, AS_OF)
    tagged = got["tagged"].collect()
    assert [(r.area, r.fonte, r.palavras, r.ligacao) for r in tagged] == [("Pontes", "Gazeta", ["ponte"], "https://a.pt/1")]
    assert sorted(r.titulo for r in got["raw"].collect()) == ["A ponte nova", "La ponte", "Outra"]
    archive = api.roll(got["tagged"].limit(0), got["tagged"], AS_OF)
    again = api.roll(archive, got["tagged"], AS_OF)
    assert archive.count() == again.count() == 1


def test_reports_and_syntheses(spark):
    archive = items(spark, *[item(k, titulo=f"um título bastante longo {k}", area="A") for k in range(4)], item(9, area="B", data=None))
    none = spark.createDataFrame([], "area string, email string")
    texts, man = api.reports(archive, none, AS_OF)
    assert {r.area: r.noticias for r in man.collect()} == {"A": 4, "B": 1}
    some = spark.createDataFrame([("A", "x@y.pt")], "area string, email string")
    texts, man = api.reports(archive, some, AS_OF)
    assert [r.area for r in texts.collect()] == ["A"]
    made = api.syntheses(archive, AS_OF)
    assert [(r.area, r.noticias) for r in made.collect()] == [("A", 4)]
    whole = exports.with_syntheses(texts, made, AS_OF, "24h").first()
    assert "<h4>Portugal · 4 notícias</h4>" in whole.sintese and whole.html.count("<tr><td>") == 4
    assert "Portugal" in api.reports(archive, some, AS_OF, written=made)[0].first().texto
    assert exports.with_syntheses(texts, made, datetime(2026, 8, 8, 21, 0), "24h").first().sintese == ""
    note = exports.confirmations(some, datetime(2026, 8, 7, 11, 0)).first()
    assert "a partir de segunda-feira, às 10h00" in note.texto and note.para == "x***@y.pt" and "<li>A</li>" in note.html
    assert "ainda esta manhã" in exports.confirmations(some, datetime(2026, 8, 7, 9, 0)).first().texto
    assert "chega" not in exports.confirmations(some, AS_OF, cancelled=True).first().texto


def test_workbook_and_csv(spark):
    _, areas, _, _ = dims(spark)
    book = exports.workbook(items(spark, item(1, area="Pontes"), item(2, area="Pontes", data=None)), areas, spark.createDataFrame([], "feed_ord int, erro string"))
    assert {r.area: r.noticias for r in book["resumo"].collect()} == {"Pontes": 2, "Museus": 0}
    assert book["noticias"].first().ts is None
    assert exports.csv_text(book["resumo"]).startswith("﻿area,noticias")
    with pytest.raises(ValueError):
        exports.csv_text(book["resumo"], 1)


def test_workbook_of_more_items_than_a_sheet_holds(spark, tmp_path):
    _, areas, _, _ = dims(spark)
    rows = items(spark, *[item(k, area="Pontes", titulo=f"<{k}> & \x01", data=f"2026-08-0{1 + k % 7} 10:{k:02d}") for k in range(24)]).repartition(5)
    none = spark.createDataFrame([], "feed_ord int, erro string")
    for name, most, sizes in (("um", 1000, [24]), ("tres", 10, [10, 10, 4])):
        path = str(tmp_path / f"{name}.xlsx")
        exports.write_workbook(rows, areas, none, path, most)
        order = [r.titulo.replace("\x01", " ") for r in exports.workbook(rows, areas, none)["noticias"].collect()]
        cells = [{(r.linha, r.coluna): r.valor for r in exports.read_sheet(spark, path, k).collect()} for k in (1, 2, *range(3, 2 + len(sizes)))]
        sheets = [cells[0], *cells[2:]]
        assert [max(i for i, _ in c) - 1 for c in sheets] == sizes and all(c[1, "A"] == "area" and c[1, "H"] == "ligacao" for c in sheets)
        assert [c[i, "F"] for c, n in zip(sheets, sizes) for i in range(2, n + 2)] == order
    assert cells[1][2, "C"] == "COUNTIF(noticias!$A$2:$A$11,A2)+COUNTIF('noticias 2'!$A$2:$A$11,A2)+COUNTIF('noticias 3'!$A$2:$A$5,A2)"
    exports.write_workbook(rows.limit(0), areas, none, str(tmp_path / "nada.xlsx"))
    assert exports.read_sheet(spark, str(tmp_path / "nada.xlsx"), 2).where("coluna = 'C' and linha = 2").first().valor == "COUNTIF(noticias!$A$2:$A$2,A2)"


def test_saving_clears_what_was_cut(spark, tmp_path):
    made = []

    def job():
        made.append(cut.cut(spark.range(3), "t"))
        return made[0]

    api.save(job, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    with pytest.raises(Exception, match="."):
        made[0].collect()


def test_longitudinal(spark, tmp_path):
    v = {"noticias": 2, "novas": 2, "fontes": 1, "origens": {"nacionais": 2}, "palavras": {"ponte": 2}}
    doc = {"dias": [{"data": "2026-07-30", "areas": {"A": v}}, {"data": "2026-08-08", "areas": {"A": v}}]}
    (tmp_path / "h.json").write_text(json.dumps(doc))
    got = sorted((str(r.periodo), r.noticias, r.internacionais) for r in api.longitudinal(spark, str(tmp_path / "h.json"), "month").collect())
    assert got == [("2026-07-31", 2, 0), ("2026-08-31", 2, 0)]
    assert api.longitudinal(spark, str(tmp_path / "h.json"), "year", keywords=True).first().noticias == 4


def test_windows():
    assert api.hours("auto", datetime(2026, 8, 10)) == 72 and api.hours("auto", AS_OF) == 24 and api.since(AS_OF, "48h") == datetime(2026, 8, 6, 12)
    assert it.ORDER == ("run_ord", "feed_ord", "item_id")
