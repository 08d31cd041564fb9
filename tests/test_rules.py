import re

import pytest

from clipfold.operators import rules


@pytest.mark.parametrize(
    "phrase, text, hit",
    [
        ("IRS", "sobe o IRS", True), ("IRS", "o meu irmão", False), ("IRS", "irs", False), ("NATO", "líder nato", False), ("pensões", "uma pensão", True), ("pensões", "pensou", False),
        ("medicamentos", "o medicamento", True), ("escolas", "ano escolar", True), ("seca", "o secador", False), ("ponte velha", "a ponte  velha caiu", True), ("ponte velha", "a ponte muito velha", False),
        ("PSP", "PSP–GNR", False), ("água-forte", "uma água-forte antiga", True),
    ],
)
def test_phrases(spark, phrase, text, hit):
    r = spark.createDataFrame([("a", phrase, "keyword", 1)], "area_id string, phrase string, kind string, ord int")
    t = spark.createDataFrame([(1, text)], "item_id bigint, texto string")
    assert (rules.hits(t, r).count() == 1) is hit
    assert (rules.hits_literal(t, r).count() == 1) is hit


def test_forms():
    assert rules.forms("pensoes") == ["pensao", "pensoes"]
    assert rules.forms("mar") == ["mar", "mares"]
    assert rules.forms("mares") == ["mar", "mares"]
    assert rules.forms("jornal") == ["jornais", "jornal"]
    assert re.match(rules.compile_phrase("mar").pattern, "mares")
    assert rules.compile_phrase("—") is None


def test_candidates_same_as_every_rule_on_every_text(spark):
    d = "/root/testdata/sf0.001"
    r = spark.read.parquet(f"{d}/rules.parquet")
    t = spark.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id as item_id", "text as texto")
    a, b = rules.hits(t, r), rules.hits_literal(t, r)
    assert a.count() > 50
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_exclusion_drops_only_its_area(spark):
    r = spark.createDataFrame([("a", "museu", "keyword", 1), ("a", "peça de museu", "exclude", 2), ("b", "museu", "keyword", 1)], "area_id string, phrase string, kind string, ord int")
    t = spark.createDataFrame([(1, "uma peça de museu"), (2, "um museu"), (3, None), (4, "")], "item_id bigint, texto string")
    for made in (rules.classify(rules.hits(t, r)), rules.classified(t, r)):
        got = {(x.item_id, x.area_id, *x.palavras) for x in made.collect()}
        assert got == {(1, "b", "museu"), (2, "a", "museu"), (2, "b", "museu")}
    assert "Exchange" not in rules.classified(t, r)._jdf.queryExecution().toString()


def test_phrases_confirmed_row_by_row(spark):
    df = spark.createDataFrame([("museu", "um museu"), ("museu", "uma ponte"), ("IRS", "irs"), (None, "x"), ("x", None), ("—", "— a")], "p string, t string")
    assert [tuple(r) for r in rules.confirmed(df, "p", "t").collect()] == [("museu", "um museu")]
