import http.server
import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clipfold.operators import items as it
from clipfold.operators import series
from clipfold.sources import feeds, state
from clipfold.streaming import archive
from tests.test_operators import item, items

AS_OF = datetime(2026, 8, 8, 12, 0)
RSS = """<?xml version="1.0" encoding="iso-8859-1"?><rss xmlns:media="m"><channel><item><title>Ação &ccedil; - Diário</title><link>https://a.pt/1</link>
<description>&lt;p&gt;Resumo &amp;amp; mais&lt;/p&gt; &lt;img src="https://a.pt/i.jpg"&gt;</description><pubDate>Fri, 07 Aug 2026 16:40:00 +0200</pubDate></item>
<item><title>Sem data &</title><guid>https://a.pt/2</guid><media:thumbnail url="https://a.pt/t.jpg"/></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Um</title><link rel="alternate" href="https://b.pt/1"/><updated>2026-08-07T10:00:00Z</updated></entry></feed>"""


def test_feeds(spark):
    rows = [(1, "u", bytearray(RSS.encode("iso-8859-1"))), (2, "u", bytearray(ATOM.encode())), (3, "u", bytearray(b"<rss><item>")), (4, "u", None)]
    payloads = spark.createDataFrame(rows, feeds.PAYLOAD)
    reg = spark.createDataFrame([(1, "Diário", "a.pt"), (2, "Blog", "b.pt")], "feed_ord int, source string, domain string")
    items, errors = feeds.items(payloads, reg, AS_OF)
    got = {(r.feed_ord, r.item_ord): r for r in items.collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1)} and sorted(r.feed_ord for r in errors.collect()) == [3, 4]
    a, b, c = got[1, 1], got[1, 2], got[2, 1]
    assert (a.titulo, a.fonte, a.ts, a.imagem, a.resumo) == ("Ação ç", "Diário", datetime(2026, 8, 7, 15, 40), "https://a.pt/i.jpg", "Resumo & mais")
    assert (b.titulo, b.ligacao, b.ts, b.imagem) == ("Sem data &", "https://a.pt/2", None, "https://a.pt/t.jpg")
    assert (c.titulo, c.ligacao, c.ts, c.fonte) == ("Um", "https://b.pt/1", datetime(2026, 8, 7, 11, 0), "Blog")
    assert feeds.items(payloads.where("feed_ord < 0"), reg, AS_OF)[0].count() == 0


def test_fetching(spark):
    class Page(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200 if self.path == "/rss" else 404)
            self.end_headers()
            self.wfile.write(RSS.encode("iso-8859-1"))

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    rows = [(1, f"{at}/rss"), (2, f"{at}/nada"), (3, "file:///etc/hostname"), (4, None)]
    got = {r.feed_ord: r for r in feeds.fetch(spark.createDataFrame(rows, "feed_ord int, url string"), 5).collect()}
    server.shutdown()
    assert bytes(got[1].body) == RSS.encode("iso-8859-1") and got[1].erro is None
    assert "404" in got[2].erro and "no http" in got[3].erro and "no http" in got[4].erro and got[3].body is None


def test_decoding():
    assert feeds.decode("é".encode("cp1252")) == "é" and feeds.decode("é".encode()) == "é"
    assert feeds.decode(b"a\x81\xe9") == "a\x81é"  # no byte is lost
    assert feeds.decode(b"<?xml encoding='nope'?>\xc3\xa9")[-1] == "é" and feeds.decode("\ufeffa".encode()) == "a"
    assert feeds.repair("a & b &nope; &amp; &#233;") == "a &amp; b   &amp; &#233;"


def test_source_domain_and_image_of_items(spark):
    item = '<item><title>T</title><dc:creator>Ana</dc:creator>{}</item>'
    rss = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:media="m"><channel>' + "".join(map(item.format, (
        "", '<source url="https://jornal.ao:80/x">Jornal</source>', '<enclosure url="nada"/><media:content medium="video" url="https://a.pt/v"/>', '<enclosure type="audio/x" url="https://a.pt/s"/><media:thumbnail url="/rel"/>',
    ))) + "</channel></rss>"
    reg = spark.createDataFrame([(1, "Agregador", "agregador.pt")], "feed_ord int, source string, domain string")
    got = sorted(feeds.items(spark.createDataFrame([(1, "u", bytearray(rss.encode()))], feeds.PAYLOAD), reg, AS_OF)[0].collect(), key=lambda r: r.item_ord)
    assert [(r.fonte, r.dominio, r.imagem) for r in got] == [("Agregador", "agregador.pt", ""), ("Jornal", "jornal.ao:80", ""), ("Agregador", "agregador.pt", "https://a.pt/v"), ("Agregador", "agregador.pt", "")]


def test_versions_survive_a_lost_checkpoint_and_refuse_gaps(spark, tmp_path):
    one = lambda k: items(spark, item(k, run=k, titulo=f"T{k}"))
    root, when = f"file://{tmp_path}/v", datetime(2026, 8, 8, 12, 0)
    archive.merge_batch(one(1), "aa", 0, root, when)
    archive.merge_batch(one(2), "aa", 1, root, when)
    archive.merge_batch(one(3), "bb", 0, root, when)  # batch 0 of a new checkpoint
    archive.merge_batch(one(9), "bb", 0, root, when)  # a retried batch is already there
    assert sorted(r.titulo for r in archive.latest(spark, root).collect()) == ["T1", "T2", "T3"]
    with pytest.raises(ValueError):
        archive.merge_batch(one(5), "bb", 2, root, when)
    (tmp_path / "v" / "v=000000000009-cc-0").mkdir()  # a version left incomplete by a failure
    archive.merge_batch(one(4), "bb", 1, root, when)
    assert archive.latest(spark, root).count() == 4 and len(archive.versions(spark, root)) == 3


def test_search_query(spark):
    df = spark.createDataFrame([(["a", "b c"], ["x"], ["h.pt"])], "p array<string>, e array<string>, h array<string>")
    q = df.select(feeds.search_query(F.col("p"), F.col("e"), F.col("h"), 7).alias("q")).first().q
    assert q == '("a" OR "b c") -"x" -site:h.pt when:7d'


def _archive(spark):
    return it.normalise(spark.read.parquet("/root/testdata/sf0.001/arquivo.parquet"))


def test_documents_and_lines(spark, tmp_path):
    items = _archive(spark)
    doc = tmp_path / "a.json"
    doc.write_text(state.document(items, AS_OF, {"dias": 7}))
    assert json.loads(doc.read_text())["atualizado"] == "2026-08-08 12:00"
    back = state.parse_items(state.read_items(spark, str(doc)))
    assert back.count() == items.count()
    state.write_items(items, str(tmp_path / "lines"))
    assert state.read_month(spark, str(tmp_path / "lines")).count() == items.count()
    (tmp_path / "old.json").write_text('{"noticias": [{"titulo": "x"}]}')
    assert state.read_items(spark, str(tmp_path / "old.json")).first().imagem is None


def test_documents_of_any_size(spark, tmp_path, monkeypatch):
    items = _archive(spark)
    more = spark.range(1_001).crossJoin(items.drop("palavras")).withColumn("palavras", F.array(F.lit('a", [\n{b')))
    path = str(tmp_path / "m.json")
    state.write_snapshot(more, path, AS_OF, "48h", "publicações")
    n = more.count()
    assert n > 200_000 and state.read_items(spark, path).count() == n and state.read_items(spark, path).rdd.getNumPartitions() > 1
    assert state.read_header(spark, path, "gerado string, periodo string").first() == ("8 de agosto de 2026, 12h00", "48h")
    monkeypatch.setattr(state, "document", None)
    few, doc = items.limit(20), tmp_path / "few" / "a[1] b.json"
    state.write_document(few, str(doc), AS_OF, {"dias": 7})
    read = json.loads(doc.read_text())
    assert read["dias"] == 7 and len(read["noticias"]) == 20 and sorted((x.get("data", "") for x in read["noticias"]), reverse=True) == [x.get("data", "") for x in read["noticias"]]
    (tmp_path / "few" / "b.json").write_text(json.dumps(read, indent=1))
    (tmp_path / "few" / "c.json").write_text('{"noticias": [\n{\n"titulo": "x"\n}\n]}')
    (tmp_path / "few" / "d.json").write_text('{"noticias": [\r\n{"titulo": 7, "palavras": "x"},\r\n{"titulo": "y"}\r\n]}\r\n')
    back = state.read_items(spark, str(tmp_path / "few")).groupBy(*[c for c in few.columns if c in ("titulo", "area", "palavras")]).count().collect()
    assert sum(r["count"] for r in back) == 43 and all(r["count"] % 2 == 0 for r in back if r.titulo not in ("x", "y", "7"))
    (tmp_path / "bad.json").write_text('{"noticias": [\n{"titulo": "x"}\n,{"titulo": \n]}')
    with pytest.raises(Exception, match="no item"):
        state.read_items(spark, str(tmp_path / "bad.json")).collect()
    state.write_document(items.limit(0), path, AS_OF, {})
    assert state.read_items(spark, path).count() == 0 and json.loads((tmp_path / "m.json").read_text())["noticias"] == []


def test_series_document_round_trip(spark, tmp_path):
    items = _archive(spark)
    by_area = series.daily_by_area(items)
    (tmp_path / "h.json").write_text(state.series_document(series.nest(by_area, series.daily_keywords(items)), AS_OF))
    back = series.long_by_area(state.read_series(spark, str(tmp_path / "h.json"))).select(by_area.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, by_area.collect()))


def test_missing_and_broken_state(spark, tmp_path):
    assert state.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "bad.parquet").write_text("no parquet")
    assert state.read_or_empty(spark, str(tmp_path / "bad.parquet"), "a int", on_corrupt="empty").count() == 0
    try:
        state.read_or_empty(spark, str(tmp_path / "bad.parquet"), "a int")
        raise AssertionError
    except AssertionError:
        raise
    except Exception:
        pass


def test_months(spark, tmp_path):
    items, path = _archive(spark), str(tmp_path / "meses")
    dated = items.where("ts is not null")
    first = state.append_months(items.where("run_ord <= 3"), path)
    n = first.count()
    assert n == dated.where("run_ord <= 3").count()
    again = state.append_months(items.where("run_ord <= 3"), path)
    assert again.count() == 0
    more = state.append_months(items.where("run_ord > 3"), path).count()
    assert spark.read.json(path).count() == n + more


def test_streams(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/arquivo.parquet")
    folder = tmp_path / "in"
    for r in (1, 2, 3):
        src.where(f"run_ord = {r}").coalesce(1).write.mode("append").parquet(str(folder))
    stream = archive.read_items(spark, str(folder), src.schema)
    when = datetime(2018, 3, 2)
    archive.run_archive(stream, str(tmp_path / "state"), str(tmp_path / "ck"), when).awaitTermination()
    got = archive.latest(spark, str(tmp_path / "state")).collect()
    kept = it.normalise(src.where("run_ord <= 3")).where(it.retained(when, 7))
    assert len(got) == kept.select("area", F.lower("titulo"), F.lower("fonte")).distinct().count()
    archive.run_archive(stream, str(tmp_path / "state"), str(tmp_path / "ck2"), when).awaitTermination()  # all again
    assert archive.latest(spark, str(tmp_path / "state")).count() == len(got)
    q = archive.daily_counts(stream).writeStream.format("memory").queryName("dias").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(noticias) from (select data, area, origem, max(noticias) noticias from dias group by 1, 2, 3)").first()[0] > 0
    q = archive.first_seen(stream).writeStream.format("memory").queryName("uma").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("uma").groupBy("ligacao").count().where("count > 1").count() == 0
