"""Problem 2: new batches checked against all history, with immutable suffix arrays on disk.

A title's words in one fixed order are its canonical text (see ``sets``). The suffix array of a batch is a table of suffixes of
its canonical texts, sorted by the words that they begin with; each ends with its text, so no match runs over two records.
Suffixes begin at the places of a record that the threshold needs (its head: the rarest 2-grams), so no pair at it is
missed. The table is written once, as a segment of the index, and never changed.

A new batch's suffixes are looked up in the arrays of the segments and in its own. Binary search finds the suffixes of records of
an allowed size that begin with the same 2-gram; how far each goes on alike is the least that neighbours between the
two in the sorted array have in common. A match that the place before belongs to as well is found from there, so each
longest match counts once, with all the places of both heads that it covers. For each pair of records the coverage of the
matches is added up, pairs below what their sizes demand are dropped, and the rest is checked exactly on the words. ``check`` reads
the batch and the index only: of the segments the columns that the batch has, and the words of the records met. It adds
the batch as a new segment; segments of about the same size are merged, so there are logarithmically many.

Words are 32-bit numbers in the 2-gram that a suffix begins with and 16-bit numbers after it: what they mistake for equal makes a
match longer, never shorter, which only sends more pairs to the exact check. Texts of more than ``PIECE`` 2-grams are
taken in pieces, so that a suffix takes bounded room: a match is followed to the end of the piece, and goes on from the next.

The order of words is fixed when an index is made, from its first batch (at most ``SAMPLE_ROWS`` titles); words that come
later count as rare. The order decides how many candidates there are, not what is found. Only the first record of each
distinct word set enters an array, so a third of all rows being copies costs nothing. Addresses are keys: after
normalisation each is looked up whole.

Cases: null and empty titles, titles without words, null, empty, malformed and front-page addresses identify nothing;
titles of fewer than four words repeat only the same words; the first item of several equal ones is the one of the
smallest id (ids rise with the runs); items of one run never repeat each other; rows repeated under one id are one
item; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipfold.llm import sets
from clipfold.plans.cut import cut, delete, fresh_path
from clipfold.plans.ship import ship
from clipfold.sources.state import put

#: Parameters that only track a visit.
TRACKING = r"^(?:utm_.*|ref|referrer|fbclid|gclid|dclid|msclkid|yclid|igshid|mc_cid|mc_eid|_ga|cmpid|ns_.*|xtor|at_medium|at_campaign)(?:=|$)"
LANES = 2
#: Titles of the first batch from which the order of words is taken: those of the smallest hash.
SAMPLE_ROWS = 200_000
#: 2-grams of a piece of a text, and of the part of a suffix that is kept.
PIECE = 64
WORDS_AT_ONCE, MATCHES_AT_ONCE = 500_000, 500_000
#: A segment is merged with the one before if that is at most so many times as large.
MERGE = 1.5


def page_key(address: Column) -> Column:
    """The page an address leads to; null for addresses that identify nothing."""
    u = F.trim(address)
    start = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    host = F.regexp_replace(F.lower(F.regexp_extract(u, start + r"([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, start + r"[^/?#]*([^?#]*)", 1), r"/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    query = F.array_join(params, "&")
    return F.when((host != "") & ((path != "") | (query != "")), F.concat(host, path, F.lit("?"), query))


class WithoutName:
    """Takes a trailing publication's name off a folded title."""

    def __init__(self, names: list[str]):
        words = sorted({tuple(sets.WORD.findall(sets.fold(n))) for n in names if n} - {()}, key=lambda w: (-len(w), w))
        self.longest = max((sum(map(len, w)) + 4 * len(w) for w in words), default=0) + 20
        self.tail = re.compile(r"[^\w]*[-|–—·:/][^\w]*(?:" + "|".join(r"[^\w]+".join(map(re.escape, w)) for w in words) + r")[^\w]*$") if words else None

    def __call__(self, title: str) -> str:
        while self.tail is not None:
            at = max(0, len(title) - self.longest)
            m = self.tail.search(title, at)
            if not m or not sets.WORD.search(title, 0, m.start()):
                break
            title = title[: m.start()]
        return title


@dataclass(frozen=True)
class Index:
    """History as it stands: segments, each a folder with the tables ``suffixes``, ``texts``, ``classes`` and ``pages``."""

    path: str
    names: tuple[str, ...]
    segments: tuple[tuple[str, int], ...] = ()  # folder and rows of its array

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        out = spark.createDataFrame([], SCHEMAS[name])
        parts = [f"{self.path}/{s}/{name}" for s, _ in self.segments]
        return spark.read.schema(SCHEMAS[name]).parquet(*parts) if parts else out

    def order(self, spark: SparkSession) -> sets.Order:
        rows = spark.read.parquet(f"{self.path}/order").toArrow()  # two tables of a bounded size
        at = {k: np.frombuffer(v, np.uint8) for k, v in zip(rows["kind"].to_pylist(), rows["levels"].to_pylist())}
        return sets.Order(at["words"], at["grams"], True)


SUFFIX_SCHEMA = "col bigint, suffix binary, rec binary"
MATCH_SCHEMA = "a bigint, b bigint, na int, nb int, earlier boolean, till bigint, shared int"
SCHEMAS = {
    "suffixes": SUFFIX_SCHEMA,
    "texts": "id bigint, run int, k1 bigint, k2 bigint, words array<bigint>",
    "classes": "k1 bigint, k2 bigint, id bigint, run int, before bigint, upto bigint",
    "pages": "p1 bigint, p2 bigint, id bigint, run int",
}


def create(spark: SparkSession, path: str, names: list[str]) -> Index:
    """An empty index at ``path``. ``names``: publications whose name may end a title (a registry of bounded size)."""
    return _committed(spark, Index(path, tuple(sorted({n for n in names if n}))), 0)


def _committed(spark: SparkSession, index: Index, number: int) -> Index:
    put(spark, f"{index.path}/state-{number:09d}.json", json.dumps({"names": index.names, "segments": index.segments}).encode())
    return index


def load(spark: SparkSession, path: str) -> Index:
    """The index at ``path`` as of its last batch."""
    states = spark.read.format("binaryFile").option("pathGlobFilter", "state-*.json").load(path)
    last = json.loads(states.orderBy(F.desc("path")).select("content").first().content)
    return Index(path, tuple(last["names"]), tuple((s, n) for s, n in last["segments"]))


def _prepare(index: Index, titles: DataFrame) -> sets.Order:
    """The index's order of words; fitted on its first batch."""
    spark = titles.sparkSession
    if not index.segments:
        sample = titles.where(F.pmod(F.xxhash64("id"), F.lit(max(1, -(-titles.count() // SAMPLE_ROWS)))) == 0)
        order = sets.Order.fit(sample, unseen=True)
        rows = [("words", bytearray(order.words.tobytes())), ("grams", bytearray(order.grams.tobytes()))]
        spark.createDataFrame(rows, "kind string, levels binary").coalesce(1).write.mode("overwrite").parquet(f"{index.path}/order")
    return index.order(spark)


def record(lanes: int) -> np.dtype:
    """A row but for its column and suffix: that of a set, the 2-grams of the head from the row's place on (``heads``, a bit
    each, as many as ``PIECE``), the place (``place``, twice that, and one if the place before is of the head too), and the word before it."""
    return np.dtype([*sets.record(lanes).descr, ("heads", "<u8"), ("place", "<i4"), ("before", "<u4")])


def suffixes(new: DataFrame, order: sets.Order, threshold: float, lanes: int, hot: int = sets.HOT) -> DataFrame:
    """Rows of the suffix array of sets (``id, run, words``): the suffixes of the canonical texts that begin at the places of
    the heads. ``col`` is the 2-gram that a suffix begins with (split as in ``sets.incidence``), ``suffix`` the words after
    it, two bytes a word; in the order of both, suffixes that begin alike stand together."""
    dtype = record(lanes)

    def rows(ids: np.ndarray, runs: np.ndarray, words: np.ndarray, lens: np.ndarray) -> pa.RecordBatch:
        text = order.canonical(words, lens)
        col, doc, lv, pos = order.places(words, lens, threshold, text)
        starts = np.cumsum(lens + 1) - (lens + 1)
        place, left = pos - starts[doc], lens[doc] + 1 - (pos - starts[doc])
        head = np.zeros(len(text) + PIECE, np.uint64)
        head[pos + doc] = 1  # where the 2-gram begins in the text
        bits, k = head.copy(), 1
        while k < PIECE:
            bits[:-k] |= bits[k:] << np.uint64(k)
            k *= 2
        of_set = sets.packed_sets(ids, runs, words, lens, lanes, dtype)
        cols, which, side = sets.split_columns(col, lv, ids[doc], hot)
        rec = of_set[doc]
        rec["heads"] = bits[pos + doc] & (np.uint64(2**64 - 1) >> (PIECE - np.minimum(left, PIECE)).astype(np.uint64))
        follows = (place > 0) & (head[pos + doc - 1] > 0)
        rec["place"], rec["before"] = 2 * place + follows, np.where(place > 1, text[pos + doc - 1], 0).astype(np.uint32)
        rec = rec[which]
        rec["size"] += side
        short = ((text ^ (text >> 16)) & 0xFFFF).astype(">u2")
        n = np.minimum(left[which] - 1, PIECE - 1)
        at = (pos + doc)[which] + 2
        return pa.RecordBatch.from_arrays(
            [pa.array(cols), sets.binary(short[sets.expand(at, at + n)[1]].tobytes(), 2 * n), sets.binary(rec.tobytes(), np.full(len(rec), dtype.itemsize))], names=["col", "suffix", "rec"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, lens = sets.flat_lists(b.column(2))
            ids, runs, ends = b.column(0).to_numpy(), b.column(1).to_numpy(), np.cumsum(lens)
            parts = np.flatnonzero(np.diff(ends // WORDS_AT_ONCE, prepend=0)).tolist()  # memory doesn't follow the length of texts
            for s, e in zip([0, *parts], [*parts, len(lens)]):
                if e > s:
                    yield rows(ids[s:e], runs[s:e], words[ends[s] - lens[s] : ends[e - 1]], lens[s:e])

    ship(new.sparkSession)
    return new.select("id", "run", "words").mapInArrow(run, SUFFIX_SCHEMA)


def neighbours(col: np.ndarray, suffix: pa.ChunkedArray) -> np.ndarray:
    """How many words each suffix of a sorted array has in common with the one before, after the 2-gram of their column."""
    data, ends = sets.flat_bytes(suffix)
    text, ends = data.view(">u2"), ends // 2
    start, n = ends[:-1], np.diff(ends)
    out = np.zeros(len(col), np.uint8)
    at, k = np.flatnonzero(col[1:] == col[:-1]) + 1, 0
    while len(at):
        at = at[(n[at] > k) & (n[at - 1] > k)]
        at = at[text[start[at] + k] == text[start[at - 1] + k]]
        k += 1
        out[at] = k
    return out


class Matches:
    """Longest matches of the suffixes of a sorted array, from its neighbours: of two suffixes, the least between them."""

    def __init__(self, col: np.ndarray, suffix: pa.ChunkedArray):
        self.least = [neighbours(col, suffix)]
        longest = int(np.diff(np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1], [True]]))).max(initial=1))
        while 2 << len(self.least) - 1 < longest:
            last, k = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(last, np.concatenate([last[k:], np.zeros(k, np.uint8)])))

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """2-grams that the suffixes at ``x`` and ``y``, of one column, have in common from their beginning."""
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(x), np.int64)
        for k, least in enumerate(self.least):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(least[lo[at]], least[hi[at] - (1 << k)])
        return out + 1


def lookup(threshold: float):
    """For ``mapInArrow`` over ``sets.by_column`` with a column ``new``: longest matches of a new record ``a`` with a record ``b`` of an
    earlier batch (``earlier``), or a smaller one of its own, which counts for later copies of ``a``; where they end in the
    texts (``till``), and the places of both heads that they cover (``shared``). A match over several pieces of the
    text of ``a`` counts piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sets.column_blocks(batches):
            block = sets.Block(t, LANES, record(LANES))
            ids, runs, ns, heads, before = block.id, block.run, block.n, block.rec["heads"], block.rec["before"]
            place, follows = block.rec["place"].astype(np.int64) >> 1, (block.rec["place"] & 1) > 0
            longest = Matches(t["col"].to_numpy(), t["suffix"])
            ask = np.flatnonzero(t["new"].to_numpy()[block.order])
            lo = block.find(ask, np.ceil(ns[ask] * threshold - 1e-9), "left")
            hi = block.find(ask, np.floor(ns[ask] / threshold + 1e-9), "right")
            found, size = [], 0
            for x, y in sets.meetings(ask, lo, hi, block, threshold):
                ok = (runs[y] < runs[x]) | ((runs[y] == runs[x]) & (ids[y] < ids[x]))
                # a match that the place before in the piece is part of is found from there
                ok &= ~(follows[x] & follows[y] & (before[x] == before[y]) & ((place[x] == 1) == (place[y] == 1)) & (place[x] % PIECE > 0))
                x, y = x[ok], y[ok]
                n = np.minimum(longest(block.order[x], block.order[y]), PIECE - place[x] % PIECE)
                cover = np.bitwise_count(heads[x] & heads[y] & (np.uint64(2**64 - 1) >> (PIECE - n).astype(np.uint64)))
                found.append(
                    pa.RecordBatch.from_arrays(
                        [
                            *(pa.array(v) for v in (ids[x], ids[y], ns[x].astype(np.int32), ns[y].astype(np.int32), runs[y] < runs[x])),
                            pa.array(((place[x] + n) << 32) | (place[y] + n)),
                            pa.array(cover.astype(np.int32)),
                        ],
                        names=["a", "b", "na", "nb", "earlier", "till", "shared"],
                    )
                )
                size += len(x)
                if size >= MATCHES_AT_ONCE:
                    yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
                    found, size = [], 0
            if size:
                yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]

    return run


def covered(matches: DataFrame, threshold: float) -> DataFrame:
    """Pairs with the coverage of all their matches added up, those below what their sizes demand left out. Of matches that end at the
    same words, one is part of the other, and the longest counts."""
    pair = ["a", "b", "na", "nb", "earlier"]
    return sets.accumulated(matches.repartition("a", "b").groupBy(*pair, "till").agg(F.max("shared").alias("shared")), threshold)


def check(
    batch: DataFrame, index: Index, id_col: str = "item_id", run_col: str = "run_ord", title_col: str = "titulo", link_col: str = "ligacao", threshold: float = 0.8, merge: bool = True
) -> tuple[DataFrame, Index]:
    """``first_id, id_col`` of each item of the batch that repeats an item of an earlier run, in the index or in the batch
    itself (which may hold several runs, none earlier than those in the index), and the index with the batch added."""
    spark = batch.sparkSession
    base = batch.select(F.col(id_col).cast("bigint").alias("id"), F.col(run_col).cast("int").alias("run"), title_col, F.col(link_col).alias("link")).where("id is not null and run is not null")
    titles = cut(sets.word_sets(base, ["id", "run"], title_col, WithoutName(list(index.names))), "titles")
    known, pages = index.table(spark, "classes"), index.table(spark, "pages")
    order = _prepare(index, titles)
    firsts = titles.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.min("run").alias("run"))  # ids rise with the runs
    firsts = firsts.join(known.select("k1", "k2"), ["k1", "k2"], "left_anti") if index.segments else firsts

    segment = fresh_path(spark, "segment").rsplit("-", 1)[-1]
    at = f"{index.path}/{segment}"
    titles.select("id", "words").join(firsts, "id").select("id", "run", "k1", "k2", "words").write.option("compression", "zstd").parquet(f"{at}/texts")
    new = spark.read.schema(SCHEMAS["texts"]).parquet(f"{at}/texts")
    suffixes(new, order, threshold, LANES).sortWithinPartitions("col", "suffix").write.option("compression", "zstd").parquet(f"{at}/suffixes")
    mine = spark.read.schema(SCHEMAS["suffixes"]).parquet(f"{at}/suffixes")
    rows = mine.withColumn("new", F.lit(True))
    if index.segments:
        met = index.table(spark, "suffixes").join(mine.select("col").distinct(), "col", "left_semi")
        rows = rows.unionByName(met.withColumn("new", F.lit(False)))
    pairs = cut(covered(sets.by_column(rows).mapInArrow(lookup(threshold), MATCH_SCHEMA), threshold), "title-pairs")
    words = new.select("id", "words").unionByName(index.table(spark, "texts").select("id", "words")) if index.segments else new
    near = sets.verified(pairs, words, threshold).groupBy("a").agg(F.min(F.when(F.col("earlier"), F.col("b"))).alias("before"), F.min("b").alias("upto"))
    classes = new.drop("words").join(near.withColumnRenamed("a", "id"), "id", "left").select("k1", "k2", "id", "run", "before", "upto")
    classes.write.option("compression", "zstd").parquet(f"{at}/classes")
    mine = spark.read.schema(SCHEMAS["classes"]).parquet(f"{at}/classes")

    every = mine.unionByName(known.join(titles.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")) if index.segments else mine
    first = every.select("k1", "k2", F.col("id").alias("first"), F.col("run").alias("first_run"), "before", "upto")
    by_title = titles.select("id", "run", "k1", "k2").join(first, ["k1", "k2"]).select(
        "id", F.when(F.col("first_run") < F.col("run"), F.least("first", "upto")).otherwise(F.col("before")).alias("first_id")
    )
    page = page_key(F.col("link"))
    linked = base.select("id", "run", F.xxhash64(page).alias("p1"), F.xxhash64(F.reverse(page)).alias("p2"), page.isNotNull().alias("ok")).where("ok").drop("ok")  # 128 bits of the page
    seen = linked.groupBy("p1", "p2").agg(F.min("id").alias("id"), F.min("run").alias("run"))
    if index.segments:
        old = pages.select("p1", "p2", F.col("id").alias("old_id"), F.col("run").alias("old_run"))
        seen = cut(seen.join(old, ["p1", "p2"], "left"), "pages")
        fresh = seen.where("old_id is null").select("p1", "p2", "id", "run")
        seen = seen.select("p1", "p2", F.coalesce("old_id", "id").alias("id"), F.coalesce("old_run", "run").alias("run"))
    else:
        fresh = seen = cut(seen, "pages")
    fresh.write.option("compression", "zstd").parquet(f"{at}/pages")
    by_link = linked.join(seen.select("p1", "p2", F.col("id").alias("first_id"), F.col("run").alias("first_run")), ["p1", "p2"]).where("first_run < run").select("id", "first_id")
    found = by_title.where("first_id is not null").union(by_link).groupBy("id").agg(F.min("first_id").alias("first_id"))
    result = cut(found.select("first_id", F.col("id").alias(id_col)), "repeats")  # before segments are merged away
    size = spark.read.parquet(f"{at}/suffixes").count()
    return result, _merged(spark, replace(index, segments=(*index.segments, (segment, size))), MERGE if merge else 0.0)


def _merged(spark: SparkSession, index: Index, most: float) -> Index:
    """The index with its last segments merged as long as the one before is at most ``most`` times as large."""
    gone: list[str] = []
    while len(index.segments) > 1 and index.segments[-2][1] <= most * index.segments[-1][1]:
        *rest, (a, n), (b, m) = index.segments
        pair, name = replace(index, segments=((a, n), (b, m))), fresh_path(spark, "segment").rsplit("-", 1)[-1]
        for table in SCHEMAS:
            df = pair.table(spark, table)
            (df.sortWithinPartitions("col", "suffix") if table == "suffixes" else df).write.option("compression", "zstd").parquet(f"{index.path}/{name}/{table}")
        gone += [a, b]
        index = replace(index, segments=(*rest, (name, n + m)))
    _committed(spark, index, _next(spark, index))
    for name in gone:
        delete(spark, f"{index.path}/{name}")
    return index


def _next(spark: SparkSession, index: Index) -> int:
    states = spark.read.format("binaryFile").option("pathGlobFilter", "state-*.json").load(index.path)
    return int(re.search(r"state-(\d+)", states.agg(F.max("path").alias("p")).first().p).group(1)) + 1


def repeats(df: DataFrame, names: list[str], run_col: str = "run_ord", batches: int = 2, path: str | None = None, **columns) -> DataFrame:
    """``first_id, id_col``: each item that repeats an item of an earlier run, with the smallest such item: a new index filled
    with ``df`` in ``batches`` parts of about the same number of runs, each checked against the parts before."""
    spark = df.sparkSession
    index = create(spark, path or fresh_path(spark, "history"), names)
    low, high = df.agg(F.min(run_col), F.max(run_col)).first()
    out = []
    if low is None:
        return check(df, index, run_col=run_col, **columns)[0]
    bounds = np.unique(np.linspace(low - 1, high, batches + 1).astype(int)).tolist()
    for a, b in zip(bounds, bounds[1:]):
        found, index = check(df.where((F.col(run_col) > a) & (F.col(run_col) <= b)), index, run_col=run_col, merge=b < bounds[-1], **columns)
        out.append(found)
    result = out[0]
    for more in out[1:]:
        result = result.union(more)
    return result
