import random
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfold.llm import lines

SCHEMA = "item_id bigint, fonte string, resumo string, src string"


def norm(line):
    return re.sub(r"\s+", " ", re.sub(r"\d+", "0", line.lower())).strip()


def brute(rows, min_docs=5, share=0.05):
    texts, count = defaultdict(int), defaultdict(set)
    for i, f, t, *_ in rows:
        s = (f or "").strip().lower()
        if s and t:
            texts[s] += 1
            for line in t.split("\n"):
                count[s, norm(line)].add(i)
    bad = {k for k, v in count.items() if k[1] and len(v) >= min_docs and len(v) >= share * texts[k[0]]}
    return {(i, n) for i, f, t, *_ in rows if f and t for n, line in enumerate(t.split("\n"), 1) if (f.strip().lower(), norm(line)) in bad}


def rows(n=400, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        f = r.choice(["A"] * 6 + [" a ", "B", "C", None, ""])
        parts = [f"texto {i} único {chr(97 + i % 26)}{i // 26 * 'z'}"] + r.sample(["© Casa 12", "LEIA  MAIS", "Leia mais", "raro", ""], r.randint(0, 4))
        r.shuffle(parts)
        out.append((i, f, r.choice([None, ""]) if i % 17 == 0 else "\n".join(parts), "x"))
    return out


def test_against_brute_force_in_any_shards(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    for shard in (20_000, 40, 3):
        got = {tuple(r) for r in lines.line_occurrences(df, shard_docs=shard).collect()}
        assert got == brute(data)


def test_stripping_keeps_the_rest(spark):
    data = [(k, "A", f"um {chr(97 + k)}\n© Casa {k}\n\nfim {chr(97 + k)}", "x") for k in range(8)] + [(99, None, "© Casa 1", "x")]
    got = {r.item_id: r for r in lines.strip_lines(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got[0].resumo == "um a\n\nfim a" and got[99].resumo == "© Casa 1" and got[0].src == "x"


def test_blocks_span_lines(spark):
    data = [(k, "A", f"só {chr(97 + k)}\nprimeira\nsegunda\núltima {chr(97 + k)}", "x") for k in range(10)]
    got = {(r.n_lines, r.n_docs) for r in lines.repeated_blocks(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {(1, 10), (2, 10)}


def test_rows_come_through_the_common_prefixes(spark, monkeypatch):
    seqs = [np.array(x) for x in ([1, 2, 3], [4, 1, 2], [2, 5, 6])]
    assert sorted(b for b, _ in lines.frequent_blocks(seqs, 2)) == [[1, 2], [2]]
    whole = lines.suffix_array
    monkeypatch.setattr(lines, "suffix_array", lambda seq: (whole(seq)[0], np.zeros(len(seq), np.int64)))
    assert lines.frequent_blocks(seqs, 2) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=8), min_size=1, max_size=12), st.integers(2, 4))
def test_frequent_lines_are_those_of_frequent_blocks(docs, need):
    seqs = [np.array(d, np.int64) for d in docs]
    count = defaultdict(int)
    for d in docs:
        for x in set(d) - {lines.EMPTY}:
            count[x] += 1
    assert {x for b, _ in lines.frequent_blocks(seqs, need) for x in b} == {x for x, n in count.items() if n >= need}


def test_empty_and_long(spark):
    assert lines.line_occurrences(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "\n".join(["repetida"] * 3000)
    data = [(k, "A", long, "x") for k in range(5)] + [(9, "A", None, "x")]
    assert lines.line_occurrences(spark.createDataFrame(data, SCHEMA)).count() == 15_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40))
def test_suffix_array(seq):
    order, lcp = lines.suffix_array(np.array(seq))
    suffixes = sorted(range(len(seq)), key=lambda i: seq[i:])
    assert [seq[i:] for i in order] == [seq[i:] for i in suffixes]
    for k in range(1, len(seq)):
        a, b = seq[order[k - 1] :], seq[order[k] :]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == n
