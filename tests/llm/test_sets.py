"""Batch history and near-duplicates against brute force."""

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfold.llm import history, neardup, sets

ITEM = "item_id bigint, run_ord int, titulo string, ligacao string, run int"
DOC = "item_id bigint, texto string, id string, words int"
WORDS = [f"p{k}" for k in range(40)]


def words(t):
    t = "".join(c for c in unicodedata.normalize("NFD", (t or "").lower()) if not unicodedata.combining(c))
    return frozenset(re.findall(r"[^\W_]+", t))


def texts(n, seed, least, most):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        if out and r.random() < 0.5:
            t = list(r.choice(out))
            for _ in range(r.randint(0, 3)):
                if r.random() < 0.5 and len(t) > 1:
                    t.pop(r.randrange(len(t)))
                else:
                    t.insert(r.randrange(len(t) + 1), r.choice(WORDS))
            r.shuffle(t)
        else:
            t = [r.choice(WORDS) for _ in range(r.randint(least, most))]
        out.append(t)
    return [" ".join(t) for t in out]


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("hot", [20_000, 4])
def test_near_duplicates_are_exact(spark, hot):
    data = [(k, t, "x", 1) for k, t in enumerate(texts(250, 3, 1, 14) + ["", None, "p1 P1", "p1"])]
    w = {k: words(t) for k, t, *_ in data}
    want = {(a, b) for a in w for b in w if a < b and w[a] and w[b] and jaccard(w[a], w[b]) >= 0.65}
    assert len(want) > 100
    got = [tuple(r) for r in neardup.pairs(spark.createDataFrame(data, DOC), "texto", hot=hot).collect()]
    assert set(got) == want and len(got) == len(want)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1), st.sets(st.integers(0, 40), max_size=12), st.sampled_from([0.5, 0.65, 0.8]))
def test_bounds_hold_for_any_two_sets(a, change, t):
    b = a ^ change
    if not b or len(a & b) < t * len(a | b):
        return
    order = sets.Order(np.arange(sets.LEAST_LEVELS) % 7, np.arange(sets.LEAST_LEVELS) % 5 + 1)
    hashed = [np.sort(np.array([x * 2_654_435_761_987 + 17 for x in s], np.int64)) for s in (a, b)]
    lens = np.array([len(a), len(b)])
    gram, doc, _ = order.heads(np.concatenate(hashed), lens, t)
    shared = len(set(gram[doc == 0].tolist()) & set(gram[doc == 1].tolist()))
    assert shared >= sets.least_shared(lens[:1], lens[1:], t)[0] >= 1


def test_pairs_whose_rarest_words_differ_are_found(spark):
    common, odd = [f"c{k}" for k in range(50)], [f"a{k}" for k in range(10)]
    data = [(1, " ".join(common + odd), "x", 1), (2, " ".join([*common, "b0", "b1"]), "x", 1), (3, " ".join([*odd, "b0", "b1"]), "x", 1)]
    data += [(10 + k, " ".join([*common[k : k + 30], *(f"f{k}w{j}" for j in range(30))]), "x", 1) for k in range(0, 20)]
    assert [tuple(r) for r in neardup.pairs(spark.createDataFrame(data, DOC), "texto").collect() if r.id_b < 10] == [(1, 2)]


def test_nothing_is_lost_at_any_size(spark):
    r = random.Random(9)
    data, k = [], 0
    for _ in range(60):
        t = r.sample(WORDS + [f"q{j}" for j in range(200)], r.randint(2, 60))
        for _ in range(5):
            drop = r.randint(0, max(0, len(t) // 3))
            data.append((k, " ".join(r.sample(t, len(t) - drop) + [f"q{r.randrange(200)}" for _ in range(r.randint(0, len(t) // 6))]), "x", 1))
            k += 1
    w = {i: words(t) for i, t, *_ in data}
    want = {(a, b) for a in w for b in w if a < b and jaccard(w[a], w[b]) >= 0.65}
    assert len(want) > 150 and {tuple(p) for p in neardup.pairs(spark.createDataFrame(data, DOC), "texto").collect()} == want


def test_groups_of_copies(spark):
    data = [(k, "um dois três quatro cinco seis sete oito", "x", 1) for k in range(30)] + [(50, "um dois três quatro cinco seis sete nove", "x", 1), (60, "outra coisa", "x", 1)]
    got = {r.item_id: (r.class_id, r.n_links) for r in neardup.groups(spark.createDataFrame(data, DOC), "texto").collect()}
    assert got[29] == (0, 1) and got[50] == (50, 1) and got[60] == (60, 0)
    none = spark.createDataFrame([], DOC)
    assert neardup.pairs(none, "texto").count() == 0 and neardup.groups(none, "texto").count() == 0


def brute_repeats(data, names=("Jornal X",)):
    strip = history.WithoutName(list(names))
    key = lambda t: words(strip(sets.fold(t))) if t else frozenset()
    out = {}
    for i, r, t, u, *_ in data:
        for j, q, t2, u2, *_ in data:
            if q < r and ((key(t) and key(t2) and jaccard(key(t), key(t2)) >= 0.8) or (u and u == u2)):
                out[i] = min(out.get(i, j), j)
    return {(f, i) for i, f in out.items()}


def test_rows_come_through_the_product(spark, monkeypatch):
    data = [(k, f"a b c d e f g h {WORDS[k % 40]}", "x", 1) for k in range(60)]
    df = spark.createDataFrame(data, DOC)
    assert neardup.links(df, "texto").count() == 40 * 39 // 2
    monkeypatch.setattr(sets, "least_shared", lambda a, b, t: np.full(len(a), 100))  # no pair adds up enough
    assert neardup.links(df, "texto").count() == 0


def test_history_against_brute_force(spark):
    t = texts(260, 5, 3, 12)
    r = random.Random(2)
    data = [(k, 1 + k // 20, r.choice([x, x + " - Jornal X", x.upper() + " | jornal x"]), f"https://a.pt/{r.randrange(150)}", 1) for k, x in enumerate(t)]
    data += [(900, 20, None, None, 1), (901, 21, "", "", 1), (902, 22, "—", "https://a.pt/", 1), (903, 23, None, "https://b.pt", 1)]
    want = {p for p in brute_repeats([d if d[3] not in ("https://a.pt/", "https://b.pt") else (*d[:3], None) for d in data])}
    got = [tuple(x) for x in history.repeats(spark.createDataFrame(data, ITEM), ["Jornal X", "Jornal X · Extra"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


@pytest.mark.parametrize("sizes", [[1] * 7, [3, 1, 1, 2]])
def test_batch_by_batch_is_as_all_at_once(spark, tmp_path, sizes):
    t, r = texts(160, 8, 2, 10), random.Random(4)
    data = [(k, 1 + k * 7 // 160, x, f"https://a.pt/{r.randrange(90)}", 1) for k, x in enumerate(t)]
    df = spark.createDataFrame(data, ITEM)
    index = history.create(spark, f"file://{tmp_path}/i", ["Jornal X"])
    got, at, read = set(), 0, []
    for n in sizes:
        found, index = history.check(df.where(f"run_ord > {at} and run_ord <= {at + n}"), index)
        got |= {tuple(x) for x in found.collect()}
        at += n
        assert index == history.load(spark, index.path)
        read.append(len(index.segments))
    assert got == brute_repeats(data) and len(got) > 60 and max(read) <= 1 + np.log2(len(data))


def test_a_batch_reads_the_index_and_itself_only(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(k, 1 + k // 10, f"título {k % 7} de sempre sobre {WORDS[k % 7]} e {WORDS[k % 5]}", None, 1) for k in range(40)], ITEM)
    df.where("run_ord <= 3").write.parquet(f"{tmp_path}/old")
    df.where("run_ord = 4").write.parquet(f"{tmp_path}/new")
    _, index = history.check(spark.read.parquet(f"{tmp_path}/old"), history.create(spark, f"file://{tmp_path}/i", []))
    (tmp_path / "old").rename(tmp_path / "gone")  # history itself isn't there any more
    found, index = history.check(spark.read.parquet(f"{tmp_path}/new"), index)
    want = {p for p in brute_repeats([tuple(x) for x in df.collect()], ()) if p[1] >= 30}
    assert {tuple(x) for x in found.collect()} == want and len(want) > 5


def test_rows_come_through_the_arrays(spark, monkeypatch):
    data = [(k, 1 + k, f"a b c d e f g h i {WORDS[k % 3]}", None, 1) for k in range(3)]
    df = spark.createDataFrame(data, ITEM)
    assert history.repeats(df, []).count() == 2
    monkeypatch.setattr(sets, "by_column", lambda rows: rows.where("col is null"))
    assert history.repeats(df, []).count() == 0


def suffix_rows(spark, texts_, threshold=0.8):
    """The order of words and the sorted suffix array of texts, as ``history`` keeps it."""
    df = spark.createDataFrame([(k, 1, " ".join(t)) for k, t in enumerate(texts_)], "id bigint, run int, t string")
    words = sets.word_sets(df, ["id", "run"], "t")
    order = sets.Order.fit(words, unseen=True)
    rows = history.suffixes(words, order, threshold, history.LANES).coalesce(1).sortWithinPartitions("col", "suffix").toArrow()
    full = {r.id: order.canonical(np.array(r.words, np.int64), np.array([len(r.words)])).tolist() for r in words.collect()}
    return full, rows


@pytest.mark.parametrize("size", [12, 180])
def test_longest_matches_are_those_of_the_texts(spark, size):
    r = random.Random(size)
    base = [f"v{k}" for k in range(size)]
    full, rows = suffix_rows(spark, [[w for w in base if r.random() > 0.04] + [f"n{k}"] for k in range(12)])
    rec = sets.packed_bytes(rows["rec"]).view(history.record(history.LANES))
    col, suffix = rows["col"].to_numpy(), rows["suffix"].to_pylist()
    place = (rec["place"] >> 1).tolist()
    texts_ = [full[i][p:] for i, p in zip(rec["id"].tolist(), place)]
    short = [b"".join((((w ^ (w >> 16)) & 0xFFFF)).to_bytes(2, "big") for w in t[2 : history.PIECE + 1]) for t in texts_]
    assert suffix == short and all(a <= b for a, b, c, d in zip(short, short[1:], col, col[1:]) if c == d)
    x, y = np.array([(i, j) for i in range(len(col)) for j in range(len(col)) if i != j and col[i] == col[j]]).T
    got = history.Matches(col, rows["suffix"])(x, y)
    for i, j, n in zip(x.tolist(), y.tolist(), got.tolist()):
        same = next((k for k, (v, w) in enumerate(zip(texts_[i], texts_[j])) if v != w), min(len(texts_[i]), len(texts_[j])))
        assert n == min(same - 1, history.PIECE)
    assert got.max() >= min(10, size // 2)


@pytest.mark.parametrize("size", [12, 180, 2000])
def test_each_longest_match_counts_once_and_covers_the_shared_places(spark, size):
    r = random.Random(size)
    base = [f"v{k}" for k in range(size)]
    full, rows = suffix_rows(spark, [[w for w in base if r.random() > 0.03] + [f"n{k}"] for k in range(6)])
    rec = sets.packed_bytes(rows["rec"]).view(history.record(history.LANES)).copy()
    rec["run"] = rec["id"]
    packed = sets.binary(rec.tobytes(), np.full(len(rec), rec.dtype.itemsize))
    t = pa.table({"col": rows["col"], "suffix": rows["suffix"], "rec": packed, "new": np.ones(len(rec), bool)})
    found, cover = list(history.lookup(0.8)(iter(t.to_batches()))), {}
    for a, b, *_, till, shared in (v for f in found for v in zip(*(c.to_pylist() for c in f.columns))):
        cover.setdefault((a, b), {}).setdefault(till, []).append(shared)
    heads = {i: set(rows["col"].to_numpy()[rec["id"] == i].tolist()) for i in full}
    assert len(cover) >= 5
    for (a, b), runs in cover.items():
        assert sum(max(v) for v in runs.values()) == len(heads[a] & heads[b])
    assert sum(map(len, cover.values())) < sum(len(heads[a] & heads[b]) for a, b in cover)  # matches, not places


def test_rows_come_through_longest_matches(spark, monkeypatch):
    often = "h i j k l m n o p q r s"
    data = [(1, 1, f"a b c d e f g {often}", None, 1), (2, 2, f"a b c d e f g x {often}", None, 1)]
    data += [(10 + k, 1, f"{often} " + " ".join(f"f{k}n{j}" for j in range(10)), None, 1) for k in range(40)]  # heads are the other words
    df = spark.createDataFrame(data, ITEM)
    assert [tuple(x) for x in history.repeats(df, []).collect()] == [(1, 2)]
    monkeypatch.setattr(history, "Matches", lambda col, suffix: lambda x, y: np.ones(len(x), np.int64))  # no suffix goes on alike
    assert history.repeats(df, []).count() == 0


def test_long_titles_are_found_through_pieces(spark):
    base = [f"v{k}" for k in range(3000)]
    data = [(k, 1 + k, " ".join([w for j, w in enumerate(base) if j % 50 != 7 * k] + [f"n{k}m{j}" for j in range(20)]), None, 1) for k in range(4)]
    assert {tuple(x) for x in history.repeats(spark.createDataFrame(data, ITEM), []).collect()} == brute_repeats(data, ())


def test_segments_hold_sorted_suffixes(spark, tmp_path):
    t = texts(120, 4, 6, 14)
    df = spark.createDataFrame([(k, 1 + k // 60, x, None, 1) for k, x in enumerate(t)], ITEM)
    _, index = history.check(df, history.create(spark, f"file://{tmp_path}/i", []))
    files = sorted((tmp_path / "i" / index.segments[0][0] / "suffixes").glob("*.parquet"))
    at = [list(zip(*(pq.read_table(f).column(c).to_pylist() for c in ("col", "suffix")))) for f in files]
    assert all(a == sorted(a) for a in at) and sum(map(len, at)) == index.segments[0][1] > 300


def test_one_run_repeats_nothing(spark):
    data = [(k, 1, "o mesmo título de sempre", "https://a.pt/x", 1) for k in range(10)]
    assert history.repeats(spark.createDataFrame(data, ITEM), []).count() == 0
    assert history.repeats(spark.createDataFrame([], ITEM), []).count() == 0


def test_page_keys(spark):
    same = ["http://WWW.a.pt/x/", "https://a.pt/x", "https://a.pt/x?utm_source=f&fbclid=1#topo", "  https://www.A.pt/x  "]
    other = ["https://a.pt/X", "https://a.pt/x?id=1", "https://a.pt/x?id=2&ref=z", "https://b.pt/x"]
    nothing = ["https://a.pt", "https://www.a.pt/", "https://a.pt/?utm_source=x", "", None, "sem endereço"]
    df = spark.createDataFrame([(u,) for u in same + other + nothing], "u string")
    from pyspark.sql import functions as F

    got = [r.k for r in df.select(history.page_key(F.col("u")).alias("k")).collect()]
    assert len(set(got[:4])) == 1 and len(set(got[:8])) == 5 and got[8:] == [None] * 6


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_of_a_text_are_the_same_either_way(t):
    a = {sets.fold(w) for w in sets.plain_words(t)}
    assert a == set(sets.WORD.findall(sets.fold(t))) or not unicodedata.is_normalized("NFC", t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(max_size=30).map(lambda t: unicodedata.normalize("NFC", t)), max_size=6))
def test_words_of_many_texts_at_once(ts):
    flat, lens = sets.Tokens()(pa.array(ts, pa.string()))
    ends = np.cumsum(lens)
    assert [flat[e - n : e].tolist() for e, n in zip(ends, lens)] == [sorted(map(sets.number, words(t))) for t in ts]


def test_a_word_is_looked_at_once_and_alone(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Te҃st Één", "x", 1), (2, "een te҃st, \U0001f600", "x", 1), (3, None, "x", 1)], DOC)
    a, b = sets.word_sets(df, ["item_id"], "texto").collect()
    assert a.words == b.words == sorted(map(sets.number, ("test", "een"))) and (a.k1, a.k2) == (b.k1, b.k2)
    seen, plain = [], sets.plain_words
    monkeypatch.setattr(sets, "plain_words", lambda t: seen.append(t) or plain(t))
    assert sets.Tokens()(pa.array(["um dois", "dois um três"] * 500))[1].tolist() == [2, 3] * 500 and sorted(seen) == ["dois", "três", "um"]


def test_near_pairs_of_many_columns_are_judged_together(monkeypatch):
    r, n, columns, t = np.random.default_rng(5), 60, 100, 0.65
    rec = np.zeros(n * columns, sets.record(2))
    rec["id"], rec["size"] = np.arange(len(rec)), 4 * r.integers(40, 70, len(rec))
    rec["sig"] = np.bitwise_and.reduce(r.integers(0, 1 << 63, (3, len(rec), 2), np.uint64))
    block = sets.Block(pa.table({"col": np.repeat(np.arange(columns), n), "rec": sets.binary(rec.tobytes(), np.full(len(rec), rec.dtype.itemsize))}), 2)
    calls, allowed = [], sets._allowed
    monkeypatch.setattr(sets, "_allowed", lambda *a: calls.append(a) or allowed(*a))
    ask = np.arange(len(block))
    got = [p for x, y in sets.meetings(ask, ask + 1, block.find(ask, np.floor(block.n / t + 1e-9), "right"), block, t) for p in zip(x.tolist(), y.tolist())]
    bits = lambda x, y: sum(int(np.bitwise_count(s[x] ^ s[y])) for s in block.sigs)
    fits = lambda x, y: block.n[x] >= t * block.n[y] - 1e-9 and bits(x, y) <= (block.n[x] + block.n[y]) * (1 - t) / (1 + t) + 1e-6
    assert sorted(got) == [(x, y) for x in range(len(block)) for y in range(x + 1, x - x % n + n) if fits(x, y)] and len(got) > 100
    assert len(calls) < 5
