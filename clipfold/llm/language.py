"""Problem 3: language of documents and of their segments, with a confidence.

A segment (a title, or a sentence) is a normalised TF-IDF vector of its words and their character n-grams. It gets the
language of the nearest of several centroids per language by cosine; it is rejected if all are far or two languages are
about as near. The centroids are clustered from a bounded sample of labelled rows whose labels are cleaned by the
centroids themselves in rounds.

Cases: null and empty texts have no segment and no language; segments of fewer than ``MIN_WORDS`` words, lines that a
publication adds to many different texts (segments without a language) and rejected segments don't speak for a language; capitals, missing accents and
garbled letters only weaken a vector; very long texts are cut into sentences like others; rows repeated under several
ids are judged alike; an empty table or one without labels gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipfold.llm import lines
from clipfold.plans.cut import cut
from clipfold.plans.ship import ship
from clipfold.plans.small import join_small

LANGS = ("pt", "es", "fr", "en", "de")
DIMS, CENTROIDS, ROUNDS = 512, 3, 3
#: Labelled rows the model is fitted on.
SAMPLE_ROWS = 5_000
MIN_WORDS, CACHE_WORDS = 5, 60_000
#: Capitalised words are mostly names, which tell little of the language.
NAME_WEIGHT = 0.2
#: Confidence that a segment in another language than most of its item needs.
ODD_CONFIDENCE = 0.9
SENTENCE = re.compile(r"(?<=[.!?…])[\"'”»’)]*\s+(?=[\"'“«„‘(¿¡]?\w)")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def base_label(c: Column | str) -> Column:
    """The first subtag of a label, lower-cased; null for missing and undetermined ones."""
    c = F.col(c) if isinstance(c, str) else c
    tag = F.lower(F.trim(F.element_at(F.split(F.trim(c), "[-_]"), 1)))
    return F.when(~tag.isin("", "und"), tag)


def segments(title: str | None, text: str | None, skip: list[bool] | None = None) -> list[tuple[str, str, bool]]:
    """``(field, segment, added)``: the title and the sentences of each line, and whether ``skip`` tells the line to be an added one."""
    out = [("titulo", title, False)] if title else []
    if text:
        for k, line in enumerate(text.split("\n")):
            if not line.strip():
                continue
            added = bool(skip and k < len(skip) and skip[k])
            out += [("resumo", s, added) for s in SENTENCE.split(line) if s]
    return out


def grams(word: str) -> list[str]:
    w = f"_{word}_"
    return [w] + [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if w[i : i + n] != "_"]


class Model:
    def __init__(self, idf: dict[str, float], unseen: float, centroids: np.ndarray, langs: list[str], far: float = 0.18, close: float = 0.03):
        self.idf, self.unseen, self.centroids, self.langs, self.far, self.close = idf, unseen, centroids, langs, far, close
        self.table = {g: (h % DIMS, w if h & 0x10000 else -w) for g, w in idf.items() for h in [crc32(g.encode())]}
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((0, DIMS), np.float32)

    def __reduce__(self):
        return Model, (self.idf, self.unseen, self.centroids, self.langs, self.far, self.close)

    def word_vector(self, word: str, weight: float) -> np.ndarray:
        at, value = [], []
        for g in grams(word):
            got = self.table.get(g)
            if got is None:
                h = crc32(g.encode())
                got = h % DIMS, self.unseen if h & 0x10000 else -self.unseen
            at.append(got[0])
            value.append(got[1])
        return (np.bincount(at, value, DIMS) * weight).astype(np.float32)

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Normalised vectors, and the number of words of each text."""
        if len(self.rows) > CACHE_WORDS:
            self.rows, self.matrix = {}, np.zeros((0, DIMS), np.float32)
        ids, lens, new = [], [], []
        rows = self.rows
        for t in texts:
            caps = t.isupper()
            ws = WORD.findall(t)
            lens.append(len(ws))
            for w in ws:
                k = rows.get(w)
                if k is None or caps:
                    low = w.lower()
                    name = len(w) > 2 and w[0].isupper() and not caps
                    key = w if name else low
                    k = rows.get(key)
                    if k is None:
                        k = rows[key] = len(self.matrix) + len(new)
                        new.append(self.word_vector(low, NAME_WEIGHT if name else 1.0))
                    if not caps:
                        rows[w] = k
                ids.append(k)
        if new:
            self.matrix = np.vstack([self.matrix, *new]) if len(self.matrix) else np.vstack(new)
        n = np.array(lens)
        out = np.zeros((len(texts), DIMS), np.float32)
        flat, starts = np.array(ids, np.int64), np.cumsum(n) - n
        for size in np.unique(n[n > 0]):  # texts of one length at once
            same = np.flatnonzero(n == size)
            for part in np.array_split(same, -(-len(same) * int(size) // 8192)):
                out[part] = self.matrix[flat[starts[part][:, None] + np.arange(size)]].sum(1)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.maximum(norm, 1e-9), n

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of each text's language (-1: rejected) and the confidence."""
        if not texts:
            return np.empty(0, np.int64), np.empty(0)
        v, n = self.vectors(texts)
        cos = (v @ self.centroids.T).reshape(len(texts), len(self.langs), -1).max(2)
        best = cos.argmax(1)
        first = cos[np.arange(len(texts)), best]
        second = np.partition(cos, -2, axis=1)[:, -2] if cos.shape[1] > 1 else np.zeros(len(texts))
        confidence = 1 / (1 + np.exp(-40 * (first - second)))
        ok = (n >= MIN_WORDS) & (first >= self.far) & (first - second >= self.close)
        return np.where(ok, best, -1), np.where(ok, confidence, 0.0)


def _cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from spread-out rows."""
    k = max(1, min(k, len(v)))
    centers = v[:1]
    for _ in range(k - 1):
        centers = np.vstack([centers, v[(v @ centers.T).max(1).argmin()][None]])
    for _ in range(rounds):
        at = (v @ centers.T).argmax(1)
        sums = np.stack([v[at == j].sum(0) if (at == j).any() else centers[j] for j in range(k)])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centers


def fit(sample: list[tuple[str, str | None, str | None]], langs: tuple[str, ...] = LANGS) -> Model | None:
    """Fit on ``(label, title, text)`` rows; null if no language has a row."""
    texts, labels = [], []
    for label, title, text in sample:
        if label in langs:
            for _, s, _ in segments(title, text):
                if len(WORD.findall(s)) >= MIN_WORDS:
                    texts.append(s)
                    labels.append(label)
    have = [x for x in langs if x in set(labels)]
    if not have:
        return None
    df: Counter = Counter()
    for t in texts:
        df.update({g for w in set(WORD.findall(t.lower())) for g in grams(w)})
    unseen = 2.0  # as a frequent one: what was never seen should only lengthen the vector a little
    idf = {g: float(np.log((len(texts) + 1) / (n + 1))) + 1 for g, n in df.items() if n > 2}
    model = Model(idf, unseen, np.zeros((len(have) * CENTROIDS, DIMS), np.float32), have)
    v, _ = model.vectors(texts)
    y = np.array([have.index(x) for x in labels])
    keep = np.ones(len(y), bool)
    for _ in range(ROUNDS):  # a wrongly labelled row is nearer to another language's mean
        means = np.stack([v[keep & (y == k)].sum(0) for k in range(len(have))])
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
        keep = (v @ means.T).argmax(1) == y
    centers = []
    for k in range(len(have)):
        rows = v[keep & (y == k)]
        c = _cluster(rows, CENTROIDS) if len(rows) else means[k : k + 1]
        centers.append(np.vstack([c] + [c[:1]] * (CENTROIDS - len(c))))
    model.centroids = np.vstack(centers).astype(np.float32)
    return model


def train(df: DataFrame, id_col: str, title_col: str, text_col: str, label_col: str, rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on the ``rows`` labelled rows of the smallest hash of their id.

    Only about twice as many come into question by the share of the hash range that holds them, so what the tasks send
    to the driver doesn't grow with the table.
    """
    labelled = df.select(base_label(label_col).alias("label"), F.col(title_col).alias("t"), F.col(text_col).alias("x"), F.xxhash64(id_col).alias("h")).where(F.col("label").isin(*LANGS))
    share = min(1.0, 2 * rows / max(1, labelled.count()))
    near = labelled.where((F.shiftrightunsigned("h", 1) / float(1 << 63)) <= share).withColumn("h", F.shiftrightunsigned("h", 1))
    return fit([(r.label, r.t, r.x) for r in near.orderBy("h").limit(rows).collect()])


def _source(df: DataFrame, source_col: str) -> Column:
    return F.coalesce(lines.source_key(source_col), F.lit("")) if source_col in df.columns else F.lit("")


def added_lines(df: DataFrame, source_col: str, text_col: str, min_texts: int = 5, min_share: float = 0.05) -> DataFrame:
    """``src, bad``: identifiers of the lines that a source adds to ``min_texts`` and ``min_share`` of its different texts.

    Texts count as different for a line by the smallest and the largest identifier of their other lines, so that a story
    archived many times counts once for its lines, whatever its titles.
    """
    texts = df.select(_source(df, source_col).alias("src"), F.col(text_col).alias("t")).where("t <> ''")
    sizes = texts.groupBy("src").agg(F.approx_count_distinct(F.xxhash64("t")).alias("n_src"))
    need = F.greatest(F.lit(float(min_texts)), F.col("n_src") * min_share - 1e-9)
    ids = F.array_sort(F.array_distinct(F.filter(lines.line_ids(F.col("t")), lambda k: k != lines.EMPTY)))
    many = cut(texts.where(F.col("t").contains("\n")).select("src", ids.alias("ids")).where(F.size("ids") > 1), "text-lines")
    often = many.select("src", F.explode("ids").alias("line")).groupBy("src", "line").agg(F.count("*").alias("n"))
    may = join_small(often, sizes, "src").where(F.col("n") >= need).select("src", "line", "n_src")
    low = F.when(F.col("line") == F.col("ids")[0], F.col("ids")[1]).otherwise(F.col("ids")[0])
    high = F.when(F.col("line") == F.element_at("ids", -1), F.element_at("ids", -2)).otherwise(F.element_at("ids", -1))
    met = join_small(many.select("src", "ids", F.explode("ids").alias("line")), may, ["src", "line"])
    counts = met.groupBy("src", "line", "n_src").agg(F.approx_count_distinct(low).alias("low"), F.approx_count_distinct(high).alias("high"))
    return counts.where(F.greatest("low", "high") >= need).groupBy("src").agg(F.collect_set("line").alias("bad"))


def judge(df: DataFrame, id_col: str = "item_id", title_col: str = "titulo", text_col: str = "resumo", label_col: str = "idioma", source_col: str = "fonte") -> DataFrame:
    """``id_col, label, segs``: each item's segments with ``campo, no, lang, confidence``; rejected segments and added lines have no language."""
    model = train(df, id_col, title_col, text_col, label_col)
    items = df.select(F.col(id_col), base_label(label_col).alias("label"), F.col(title_col).alias("title"), F.col(text_col).alias("text"), _source(df, source_col).alias("src"))
    skip = F.when(F.col("bad").isNotNull() & F.col("text").contains("\n"), F.transform(lines.line_ids(F.col("text")), lambda k: F.array_contains("bad", k)))
    src = join_small(items, added_lines(df, source_col, text_col), "src", "left").select(id_col, "label", "title", "text", skip.alias("skip"))
    kind = src.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, label string, segs array<struct<campo:string,no:int,lang:string,confidence:double,chars:int>>"
    out_type = pa.list_(pa.struct([("campo", pa.string()), ("no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("chars", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            titles, texts, skips = (b.column(k).to_pylist() for k in (2, 3, 4))
            found = [segments(t, x, skip) for t, x, skip in zip(titles, texts, skips)]
            speaks = np.array([not added for f in found for *_, added in f], bool)
            lang, conf = np.full(len(speaks), -1), np.zeros(len(speaks))
            if model is not None:
                lang[speaks], conf[speaks] = model.judge([s for f in found for _, s, added in f if not added])
            segs, k = [], 0
            for f in found:
                row, chars = [], Counter()
                for j, (_, s, _) in enumerate(f, k):
                    chars[lang[j]] += len(s) * (lang[j] >= 0)
                main = max(chars, key=chars.get, default=-1)
                for j in range(k, k + len(f)):  # another language than the rest's needs more evidence
                    if lang[j] != main and conf[j] < ODD_CONFIDENCE:
                        lang[j], conf[j] = -1, 0.0
                for no, (campo, s, _) in enumerate(f):
                    row.append({"campo": campo, "no": no, "lang": model.langs[lang[k]] if lang[k] >= 0 else None, "confidence": float(conf[k]), "chars": len(s)})
                    k += 1
                segs.append(row)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(segs, out_type)], names=[id_col, "label", "segs"])

    ship(df.sparkSession)
    return src.mapInArrow(run, schema)


def wrong_labels(df: DataFrame, id_col: str = "item_id", **names) -> DataFrame:
    """``id_col, lang``: the languages of items whose label is missing or wrong, or that mix languages."""
    langs = F.array_distinct(F.transform(F.filter("segs", lambda s: s["lang"].isNotNull()), lambda s: s["lang"]))
    items = judge(df, id_col, **names).select(F.col(id_col), "label", langs.alias("langs"))
    case = F.col("label").isNull() | (F.size("langs") > 1) | ~F.array_contains("langs", F.col("label"))
    return items.where((F.size("langs") > 0) & case).select(id_col, F.explode("langs").alias("lang"))


def labels(df: DataFrame, id_col: str = "item_id", **names) -> DataFrame:
    """``id_col, campo, no, lang, confidence`` of each segment, rejected ones with a null language."""
    return judge(df, id_col, **names).select(id_col, F.explode("segs").alias("s")).select(id_col, "s.campo", "s.no", "s.lang", "s.confidence")
