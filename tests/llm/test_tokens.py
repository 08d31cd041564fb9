import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clipfold.llm import mixing, tokens

ODD = ["", " ", "  ", "\n\n x", "a  b", " a ", "a\n b\t c", "x" * 3000 + " y", "it'll 's ’s", "½ ² Ⅷ 漢字 🙂", " a  b", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_same_as_the_library(library, t):
    e = tokens.encoder(tokens.DEFAULT)
    ids = e.encode(t)
    assert ids == library.encode(t, add_special_tokens=False).ids and e.decode(ids) == t


def test_odd_texts(spark, library):
    data = [(k, t, 1) for k, t in enumerate(ODD)] + [(99, None, 1), (99, None, 1)]
    got = tokens.encode(spark.createDataFrame(data, "doc_id bigint, text string, ids int")).collect()
    by = {r.doc_id: r.ids for r in got}
    assert len(got) == len(data) and by[99] == []
    assert all(by[k] == library.encode(t, add_special_tokens=False).ids for k, t in enumerate(ODD))
    assert tokens.encode(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_a_long_piece_is_merged_in_good_time():
    e = tokens.BytePairEncoder()
    t = "ab" * 100_000
    assert e.decode(e.encode(t)) == t


def _mix(spark, docs, weights, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint, copy string")
    w = spark.createDataFrame(weights, "source string, target_share double, max_repeats int, weight string")
    mix, report = mixing.fair_mix(d, w, **more)
    return mix.collect(), {r.source: r for r in report.collect()}


def test_shares_and_repeats(spark):
    docs = [(k, "a", 10, "x") for k in range(3000)] + [(10_000 + k, "b", 7, "x") for k in range(100)] + [(20_000, "c", 5, "x"), (20_001, None, 5, "x"), (20_002, "d", 0, "x")]
    for cells in (4096, 3):
        mix, report = _mix(spark, docs, [("a", 0.6, 1, "x"), ("b", 0.3, 3, "x"), ("z", 0.1, 2, "x")], cells=cells)
        total = sum(r.tokens for r in mix)
        copies = {}
        for r in mix:
            copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert max(copies.values()) <= 3 and len({(r.doc_id, r.copy) for r in mix}) == len(mix)
        assert abs(report["a"].actual_share - 2 / 3) < 10 / total * 2 and report["z"].actual_share == 0
        assert sum(r.tokens for r in mix if r.source == "b") >= 100 * 7 * 3 - 20
        order = sorted(mix, key=lambda r: r.finish)[: len(mix) // 3]  # every prefix is balanced too
        a = sum(r.tokens for r in order if r.source == "a") / sum(r.tokens for r in order)
        assert abs(a - 2 / 3) < 0.05


@pytest.mark.parametrize("cells", [4096, 3])
def test_capped_sources_leave_their_part_to_the_others(spark, cells):
    docs = [(k, "a", 10, "x") for k in range(10)] + [(1000 + k, "b", 10, "x") for k in range(990)] + [(5000 + k, "c", 10, "x") for k in range(300)]
    mix, report = _mix(spark, docs, [("a", 0.5, 1, "x"), ("b", 0.3, 1, "x"), ("c", 0.2, 2, "x")], total_tokens=5000, cells=cells)
    assert sum(r.tokens for r in mix) == 5000 and report["a"].capped and not report["b"].capped
    assert report["a"].mix_tokens == 100 and abs(report["b"].mix_tokens - 2940) <= 10 and abs(report["c"].mix_tokens - 1960) <= 10
    assert sorted(r.position for r in mix) == list(range(1, len(mix) + 1))
    by_place = sorted(mix, key=lambda r: r.position)
    assert [r.finish for r in by_place] == sorted(r.finish for r in mix)
    mix, report = _mix(spark, docs, [("a", 0.5, 1, "x"), ("b", 0.3, 1, "x"), ("c", 0.2, 2, "x")], total_tokens=10**9, cells=cells)
    assert sum(r.tokens for r in mix) == 100 + 9900 + 6000 and all(r.capped for r in report.values())
    mix, report = _mix(spark, docs, [("a", 0.5, 1, "x"), ("b", 0.3, 1, "x"), ("c", 0.2, 2, "x")], total_tokens="available", cells=cells)
    assert sum(r.tokens for r in mix) == 13_000 and report["c"].capped is False


def test_round_trip(spark):
    got = tokens.round_trip(spark.createDataFrame([(k, t, 1) for k, t in enumerate([*ODD, None, None])], "doc_id bigint, text string, tokens int")).collect()
    assert len(got) == len(ODD) + 2 and all(r.exact for r in got) and got[-1].tokens == 0


def test_budget_and_empty(spark):
    docs = [(k, "a", 10, "x") for k in range(100)]
    mix, _ = _mix(spark, docs, [("a", 1.0, 2, "x")], total_tokens=155)
    assert sum(r.tokens for r in mix) == 150
    mix, report = _mix(spark, [], [("a", 1.0, 2, "x")])
    assert mix == [] and report["a"].actual_share == 0
