"""Problem 6: texts cut off by field limits or in transfer.

Lengths of each source's texts, in characters and in bytes, are fitted by maximum likelihood with a log-normal law
censored on the right at a candidate limit: texts longer than the limit are all seen at the limit. The posterior that a
value at the limit is censored is then combined with evidence of its ending: marks of a cut, broken mark-up, and how
often the corpus ends a sentence after the same last words. The counts behind that evidence cover all texts and fill
tables of fixed size.

Cases: null and empty texts are none; texts that end in a stop, a quotation, a credit, one of their source's repeated
lines or a line that is whole wherever it is begun are complete unless their length says otherwise; rows of no source are one source without limits; very long texts
and repeated rows are judged like others; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import erf, exp, log, pi, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.llm import lines
from clipfold.plans.ship import ship
from clipfold.plans.small import join_small

#: Counts of a table, by the number of texts within these bounds: half for runs of words, a quarter each for words and for
#: their endings. A table that is too small for a vocabulary makes the evidence weaker, not wrong for frequent words.
LEAST_BUCKETS, MOST_BUCKETS = 1 << 20, 1 << 22
#: A cut is marked by dots or by a short sign in brackets.
MARK = re.compile(r"(?:\.\.\.|…|[\[(]\s*(?:\.{2,}|…|\+|>+|»)\s*[\])]|>>|\.\.)\s*$")
BROKEN = re.compile(r"<[a-zA-Z/!][^<>]{0,200}$|<$|<br\s*/?>\s*$|&#?\w{1,7}$")
STOP = re.compile(r"[.!?][\"'”»’)\]]*\s*$|[\"”»]\s*$|[^\s(]\)\s*$")
#: A cut seldom falls just between a word and its comma.
BEFORE_SIGN = 0.15
#: A credit at the end, as publications set it.
CREDIT = re.compile(r"(?:^|[.!?…»”\n]\s*|[([]\s*)(?i:fotos?|photos?|textos?|textes?|texts?|fontes?|fuentes?|quelles?|source|bild|imagem|imagen|image|words|cr[ée]ditos?|credit|edi[cç][aã]o|foto/texto)\s*[:/©][^.!?\n]{2,80}$")
_EDGE = "\"'«»“”„‘’‚()[]{},;:.!?…-–—"
_K = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """Words as numbers: the word itself, and a class for names; 2 if a sentence ends after it, 1 if a part of it."""

    def __init__(self):
        self.seen: dict[str, tuple[int, int, int, int]] = {}

    def of(self, raw: str) -> tuple[int, int, int, int]:
        got = self.seen.get(raw)
        if got is None:
            bare = raw.strip(_EDGE)
            low = re.sub(r"\d+", "0", bare.lower())
            name = len(bare) > 2 and bare[0].isupper() and not bare.isupper()
            tail = raw.rstrip("\"'”»’)]")
            end = bool(tail) and tail[-1] in ".!?" and not raw.endswith("...")
            pause = bool(tail) and tail[-1] in ",;:–—"
            got = (crc32(low.encode()) + 1, 7 if name else crc32(low.encode()) + 1, 2 * end + pause, crc32(b"~" + low[-4:].encode()) + 1)
            if len(self.seen) > 500_000:
                self.seen.clear()
            self.seen[raw] = got
        return got


def _mix(*ids: np.ndarray, part: int = 0, buckets: int) -> np.ndarray:
    """Buckets: of the first half for ``part`` 0, else of the third or fourth quarter."""
    h = np.zeros_like(ids[0], np.uint64)
    for x in ids:
        h = (h ^ x.astype(np.uint64)) * _K
        h ^= h >> np.uint64(29)
    size = buckets // (4 if part else 2)
    return (h % np.uint64(size)).astype(np.int64) + (buckets // 4) * (part + 1 if part else 0)


def _features(texts: list[str], tokens: Tokens, buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """For all words of ``texts``: the buckets of their last 1 to 4 words, whether a sentence or a part of it ends there, the buckets of
    the word itself and of its ending, and the index of each text's last word (-1 without words)."""
    ids, caps, ends, tails, last, breaks = [], [], [], [], [], []
    for t in texts:
        begin = len(ids)
        for line in t.split("\n"):
            breaks.append(len(ids))
            for raw in line.split():
                a, b, e, f = tokens.of(raw)
                ids.append(a), caps.append(b), ends.append(e), tails.append(f)
        last.append(len(ids) - 1 if len(ids) > begin else -1)
    word, cap, end, tail = (np.array(x) for x in (ids, caps, ends, tails))
    n = len(word)
    if not n:
        return [np.empty(0, np.int64)] * 6, np.empty(0, bool), np.array(last), np.empty(0, bool)
    first = np.zeros(n + 1, bool)
    first[np.array(breaks, np.int64)] = True
    first = first[:n].copy()
    first[1:] |= end[:-1] == 2
    cls = np.where(first, word, cap).astype(np.uint64)
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    grams = []
    ctx = [cls]
    for k in range(1, 4):
        prev = np.zeros(n, np.uint64)
        prev[k:] = cls[:-k]
        prev[np.arange(n) - k < start] = 3  # before the sentence
        ctx.append(prev)
        grams.append(_mix(np.full(n, k, np.uint64), *ctx, buckets=buckets))
    grams.insert(0, _mix(np.full(n, 0, np.uint64), cls, buckets=buckets))
    is_name = (cap == 7) & ~first
    grams += [_mix(word.astype(np.uint64), part=1, buckets=buckets), _mix(tail.astype(np.uint64) + is_name, part=2, buckets=buckets)]
    return grams, end, np.array(last), is_name


def ending_counts(texts: DataFrame) -> np.ndarray:
    """Three rows of counts by bucket: words that go on, ends of parts, ends of sentences. Of a bounded size, whatever the corpus;
    counted in 64 bits, kept as floats, of which only ratios are used."""
    buckets = 1 << int(np.clip(np.ceil(np.log2(max(texts.count(), 1))), np.log2(LEAST_BUCKETS), np.log2(MOST_BUCKETS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, table = Tokens(), np.zeros((3, buckets), np.int64)
        for b in batches:
            grams, end, last, _ = _features([t for t in b.column(0).to_pylist() if t], tokens, buckets)
            use = np.ones(len(end), bool)
            use[last[last >= 0]] = False  # how the last word ends is the question
            for g in grams:
                for k in range(3):
                    table[k] += np.bincount(g[use & (end == k)], minlength=buckets)
        at = np.flatnonzero(table.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(row[at]) for row in table)], names=["b", "c0", "c1", "c2"])

    ship(texts.sparkSession)
    sums = texts.mapInArrow(run, "b bigint, c0 bigint, c1 bigint, c2 bigint").groupBy("b").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(3)])
    rows = sums.select(F.col("b").cast("int").alias("b"), *[F.col(f"c{k}").cast("float").alias(f"c{k}") for k in range(3)]).toArrow()
    out = np.zeros((3, buckets), np.float32)
    at = rows["b"].to_numpy()
    for k in range(3):
        out[k, at] = rows[f"c{k}"].to_numpy()
    return out


def _tobit(x: np.ndarray, n: np.ndarray, limit: float, held: float, rounds: int = 30) -> tuple[float, float]:
    """Mean and deviation of log lengths by maximum likelihood, ``held`` values being known only to be above ``limit``."""
    total = n.sum() + held
    mu, sd = float((x * n).sum() / max(n.sum(), 1)), 0.5
    for _ in range(rounds):
        z = (limit - mu) / sd
        upper = max(0.5 * (1 - erf(z / sqrt(2))), 1e-9)
        hazard = exp(-z * z / 2) / sqrt(2 * pi) / upper
        m1 = mu + sd * hazard
        m2 = mu * mu + sd * sd + sd * hazard * (limit + mu)
        mean = ((x * n).sum() + held * m1) / total
        sd = sqrt(max(((x * x * n).sum() + held * m2) / total - mean * mean, 1e-4))
        mu = mean
    return mu, sd


def limit_posteriors(length: np.ndarray, count: np.ndarray, least: int = 5) -> list[tuple[int, float]]:
    """Limits of a source with the posterior that a value of that length is censored, from its histogram of lengths."""
    order = np.argsort(length)
    length, count = length[order], count[order].astype(float)
    total, found = count.sum(), []
    for k in np.flatnonzero(count >= least):
        limit, here = int(length[k]), count[k]
        near = count[(length >= limit - 20) & (length < limit)].sum() / 20
        if here < 5 * (near + 0.4):
            continue
        above = count[length > limit].sum()
        held = max(here - near, 0.0)
        rest = np.where(length == limit, near, count)
        mu, sd = _tobit(np.log(np.maximum(length, 1)), rest, log(limit + 1), held)
        z = (log(limit) - mu) / sd
        density = exp(-z * z / 2) / (sqrt(2 * pi) * sd * limit)
        upper = 0.5 * (1 - erf(z / sqrt(2)))
        share = held / (held + above) if held + above else 0.0  # the part of longer texts that the limit caught
        whole = max(density * total, near)
        posterior = share * upper * total / (share * upper * total + whole)
        posterior = min(posterior, 1 - whole / here)
        if posterior > 0.5:
            found.append((limit, float(posterior)))
    return found


def source_limits(df: DataFrame, source_col: str = "fonte", text_col: str = "resumo") -> DataFrame:
    """``src, unit, lim, posterior``: the limits of each source, in characters or bytes."""
    src = df.select(lines.source_key(source_col).alias("src"), F.col(text_col).alias("t")).where("src is not null and t <> ''")
    sizes = src.select("src", F.explode(F.array(F.struct(F.lit("char").alias("unit"), F.length("t").alias("len")), F.struct(F.lit("byte").alias("unit"), F.octet_length("t").alias("len")))).alias("s"))
    counts = sizes.select("src", "s.unit", "s.len").groupBy("src", "unit", "len").agg(F.count("*").alias("n"))

    def fit(g: pa.Table) -> pa.Table:
        got = limit_posteriors(g["len"].to_numpy(), g["n"].to_numpy())
        k = len(got)
        return pa.table({"src": pa.array([g["src"][0].as_py()] * k, pa.string()), "unit": pa.array([g["unit"][0].as_py()] * k, pa.string()), "lim": pa.array([a for a, _ in got], pa.int32()), "posterior": pa.array([p for _, p in got], pa.float64())})

    ship(df.sparkSession)
    return counts.groupBy("src", "unit").applyInArrow(fit, "src string, unit string, lim int, posterior double")


def _ending(text: str, words: int = 12) -> str:
    """The last words of the last line that has any; the evidence looks at no more than four."""
    line = text.rstrip()
    return " ".join(line[line.rfind("\n") + 1 :].split()[-words:])


def _ending_scores(texts: list[str], table: np.ndarray, tokens: Tokens) -> np.ndarray:
    """Log likelihood ratios, cut against complete, of the texts' last words."""
    grams, _, last, is_name = _features([_ending(t) for t in texts], tokens, table.shape[1])
    out = np.zeros(len(texts))
    ok = last >= 0
    at = last[ok]
    if len(at):
        p = np.full(len(at), 0.1)
        for g in grams[:4]:
            end, on = table[2][g[at]], table[0][g[at]] + BEFORE_SIGN * table[1][g[at]]
            p = (end + 2 * p) / (end + on + 2)
        known = (table[:, grams[4][at]].sum(0) >= 2) | (is_name[at] & (table[:, grams[5][at]].sum(0) >= 4))
        p = np.clip(p, 0.002, 0.998)
        out[ok] = np.where(known, np.log((1 - p) / p) + 1.0, 6.5)
    return out


#: Characters by which lines meet the last lines that may begin them.
_KEY = 8


def whole_lines(texts: DataFrame, min_rests: int, least_whole: float) -> DataFrame:
    """``tail``: identifiers of last lines of ``texts`` (``t``) that follow ``min_rests`` different texts and are added ones.

    Of the different texts with a line that begins with the same characters, ``least_whole`` have it as a whole line. What a cut
    left of a line is begun by many longer ones, however often it is found.
    """
    whole = lines.end_trimmed("t")
    many = texts.where(F.contains(whole, F.lit("\n")))
    end = F.substring_index(whole, "\n", -1)
    last = many.select(lines.line_key(end).alias("line"), F.xxhash64(F.substring(whole, F.lit(1), F.length(whole) - F.length(end))).alias("rest")).where("line <> ''")
    may = last.groupBy("line").agg(F.approx_count_distinct("rest").alias("n")).where(F.col("n") >= min_rests).select("line", F.substring("line", 1, _KEY).alias("key"))
    parts = F.transform(F.split(lines.line_key_lines(whole), "\n", -1), F.trim)
    begun = many.select(F.xxhash64("t").alias("text"), F.explode(F.slice(parts, 2, 1 << 30)).alias("found")).where("found <> ''")
    keyed = begun.select("text", "found", F.explode(F.array_distinct(F.array(*[F.substring("found", 1, k) for k in range(1, _KEY + 1)]))).alias("key"))
    met = join_small(keyed, may, "key").where(F.col("found").startswith(F.col("line")))
    counts = met.groupBy("line").agg(F.approx_count_distinct("text").alias("n"), F.approx_count_distinct(F.when(F.col("found") == F.col("line"), F.col("text"))).alias("n_whole"))
    return counts.where(F.col("n_whole") >= least_whole * F.col("n")).select(F.xxhash64("line").alias("tail"))


def judge(
    df: DataFrame, id_col: str = "item_id", source_col: str = "fonte", text_col: str = "resumo", prior: float = 0.03, min_rests: int = 5, least_whole: float = 0.5
) -> DataFrame:
    """``id_col, src, posterior``: of each text, that it was cut off."""
    base = df.select(F.col(id_col).alias("id"), lines.source_key(source_col).alias("src"), F.col(text_col).alias("t")).where("t <> ''")
    limits = source_limits(df, source_col, text_col)
    packed = limits.groupBy("src").agg(F.collect_list(F.struct("unit", "lim", "posterior")).alias("limits"))
    repeated = lines.repeated_lines(df, id_col, source_col, text_col).groupBy("src").agg(F.collect_set("line").alias("bad"))
    per_source = packed.join(repeated, "src", "full_outer")
    table = ending_counts(base.select("t"))
    kind = base.schema["id"].dataType.simpleString()
    end = lines.end_trimmed("t")
    ends = base.select("id", "src", "t", lines.line_id(lines.line_key(F.substring_index(end, "\n", -1))).alias("tail"), F.contains(end, F.lit("\n")).alias("lined"))
    common = whole_lines(base, min_rests, least_whole).select("tail", F.lit(True).alias("common"))
    src = join_small(join_small(ends, per_source, "src", "left"), common, "tail", "left").select(
        "id", "src", "t", F.coalesce(F.array_contains("bad", F.col("tail")), F.lit(False)).alias("added"),
        F.coalesce(
            F.array_max(F.transform(F.filter("limits", lambda x: F.when(x["unit"] == "char", F.length("t")).otherwise(F.octet_length("t")) == x["lim"]), lambda x: x["posterior"])), F.lit(0.0)
        ).alias("at_limit"),
        (F.coalesce("common", F.lit(False)) & F.col("lined")).alias("common"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for b in batches:
            texts = b.column(2).to_pylist()
            added, at_limit = b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy()
            common = b.column(5).to_numpy(zero_copy_only=False)
            score = _ending_scores(texts, table, tokens)
            for k, t in enumerate(texts):
                if added[k]:
                    score[k] = -9.0
                elif BROKEN.search(t):
                    score[k] = 9.0
                elif MARK.search(t):
                    score[k] = 9.0
                elif common[k]:
                    score[k] = -9.0
                elif t.rstrip()[-1:] in (",", ";", "-") and t.rstrip()[-1:]:
                    score[k] = 6.5
                elif CREDIT.search(t[-120:]):
                    score[k] = -6.0
                elif STOP.search(t):
                    score[k] = -3.8
            p = np.clip(np.maximum(at_limit, prior), 1e-6, 1 - 1e-6)
            post = 1 / (1 + np.exp(-(score + np.log(p / (1 - p)))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(post), pa.array(score), b.column(4)], names=["id", "src", "posterior", "score", "at_limit"])

    return src.mapInArrow(run, f"id {kind}, src string, posterior double, score double, at_limit double").withColumnRenamed("id", id_col)


def truncated(df: DataFrame, id_col: str = "item_id", least: float = 0.5, **names) -> DataFrame:
    """``id_col``: the texts that were probably cut off."""
    return judge(df, id_col, **names).where(F.col("posterior") >= least).select(id_col)


def rates(df: DataFrame, id_col: str = "item_id", least: float = 0.5, **names) -> DataFrame:
    """``src, n_texts, n_cut, cut_share`` by source."""
    hit = F.count(F.when(F.col("posterior") >= least, 1))
    return judge(df, id_col, **names).groupBy("src").agg(F.count("*").alias("n_texts"), hit.alias("n_cut"), (hit / F.count("*")).alias("cut_share"))
