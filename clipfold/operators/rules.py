"""Phrase rules compiled on the driver into patterns, and the classification of texts by them.

Rules are user configuration of a checked size. A phrase matches the folded text at word boundaries, in singular or
plural, long words also with a short ending; acronyms must moreover stand in capitals in the text as written. An area
is dropped where an exclusion of it matches, else it has all its keywords that match.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from clipfold.functions.text import blank, fold
from clipfold.plans.ship import ship

MAX_RULES = 20_000
#: Endings that go together; the first pair side that fits a word decides.
PLURALS = (("oes", "ao"), ("ao", "oes"), ("ais", "al"), ("al", "ais"), ("eis", "el"), ("el", "eis"), ("res", "r"), ("r", "res"), ("s", ""), ("", "s"))
LONG, EXTRA = 6, 3
_WORD = re.compile(r"\w+", re.A)


def folded(text: str) -> str:
    return unicodedata.normalize("NFD", text.lower()).encode("ascii", "ignore").decode()


def acronym(word: str) -> bool:
    return word.isupper() and len(word) <= 8


def forms(word: str) -> list[str]:
    """A word with its plural or singular."""
    mine, other = next((a, b) for a, b in PLURALS if word.endswith(a))
    return sorted({word, word[: len(word) - len(mine)] + other})


@dataclass(frozen=True)
class Phrase:
    pattern: str
    acronyms: str
    capitals: tuple[str, ...]
    #: (first word piece, whether letters may follow it)
    keys: tuple[tuple[str, bool], ...]


def compile_phrase(phrase: str) -> Phrase | None:
    raw, plain = phrase.split(), folded(phrase).split()
    if not plain:
        return None
    parts, keys = [], []
    for k, word in enumerate(plain):
        short = acronym(raw[k] if k < len(raw) else word)
        options = [word] if short else forms(word)
        ending = f"\\w{{0,{EXTRA}}}" if len(word) >= LONG and not short else ""
        parts.append("(?:" + "|".join(re.escape(f) + ending for f in options) + ")")
        if k == 0:
            keys = [(piece := re.split(r"\W+", f)[0], bool(ending) and piece == f) for f in options]
    capitals = "".join(rf"(?=(?s:.*)(?:^|[^\p{{L}}\p{{N}}_]){re.escape(a)}(?:[^\p{{L}}\p{{N}}_]|$))" for a in raw if acronym(a))
    return Phrase(r"(^|\W)" + r"\s+".join(parts) + r"(\W|$)", "^" + capitals if capitals else "", tuple(a for a in raw if acronym(a)), tuple(keys))


def _rows(rules: DataFrame) -> list[tuple]:
    """``area_id, phrase, kind, ord`` and the compiled phrase of each rule; at most ``MAX_RULES``."""
    rows = rules.select("area_id", "phrase", "kind", "ord").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return [(r.area_id, r.phrase, r.kind, r.ord, p) for r in rows if r.phrase and (p := compile_phrase(r.phrase))]


def compiled(rules: DataFrame) -> DataFrame:
    """``area_id, phrase, kind, ord, pattern, acronyms``: the rules' patterns for SQL."""
    out = [(a, ph, k, o, p.pattern, p.acronyms) for a, ph, k, o, p in _rows(rules)]
    return rules.sparkSession.createDataFrame(out, "area_id string, phrase string, kind string, ord int, pattern string, acronyms string")


class Matcher:
    """Which of the rules match a text. A word of the text leads to the rules that begin with it, and only those are tried."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        self.patterns = [(re.compile(p.pattern, re.A), [re.compile(rf"(?:^|\W){re.escape(a)}(?:\W|$)") for a in p.capitals]) for *_, p in rows]
        self.whole: dict[str, list[int]] = {}
        self.begun: dict[str, list[int]] = {}
        self.always: list[int] = []
        for k, (*_, p) in enumerate(rows):
            for key, opened in p.keys:
                if not key:  # a phrase that begins with a sign
                    self.always.append(k)
                    continue
                self.whole.setdefault(key, []).append(k)
                if opened:
                    self.begun.setdefault(key, []).append(k)
        self.seen: dict[str, tuple[int, ...]] = {}

    def _led(self, word: str) -> tuple[int, ...]:
        got = self.seen.get(word)
        if got is None:
            led = set(self.whole.get(word, ()))
            for n in range(1, EXTRA + 1):
                led.update(self.begun.get(word[:-n], ()) if len(word) > n else ())
            if len(self.seen) > 200_000:
                self.seen.clear()
            got = self.seen[word] = tuple(led)
        return got

    def __call__(self, raw: str) -> list[int]:
        text = folded(raw)
        led = set(self.always)
        for word in set(_WORD.findall(text)):
            led.update(self._led(word))
        return sorted(k for k in led if self.patterns[k][0].search(text) and all(c.search(raw) for c in self.patterns[k][1]))


def _matched(texts: DataFrame, rules: DataFrame, id_col: str, text_col: str, schema: str, rows_of) -> DataFrame:
    """The rows that ``rows_of(matcher, indexes)`` makes of each text's matches, in the pass that reads the text."""
    rows = _rows(rules)
    ship(texts.sparkSession)
    src = texts.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    names, types = zip(*[(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(rows)
        for b in batches:
            at, out = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if t:
                    made = rows_of(rows, match(t))
                    at += [i] * len(made)
                    out += made
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(list(c), t) for c, t in zip(columns, types))], names=[id_col, *names])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, {schema}")


def hits(texts: DataFrame, rules: DataFrame, id_col: str = "item_id", text_col: str = "texto") -> DataFrame:
    """``id_col, area_id, phrase, kind, ord`` of each rule that matches; one pass over the texts, without a shuffle."""

    def rows_of(rows, found):
        return list(dict.fromkeys(rows[k][:4] for k in found))

    return _matched(texts, rules, id_col, text_col, "area_id string, phrase string, kind string, ord int", rows_of)


def classified(texts: DataFrame, rules: DataFrame, id_col: str = "item_id", text_col: str = "texto") -> DataFrame:
    """``id_col, area_id, palavras`` of each text: as ``classify(hits(...))``, in the same pass."""

    def rows_of(rows, found):
        areas: dict[str, set[str]] = {}
        barred = set()
        for k in found:
            area, phrase, kind = rows[k][:3]
            if kind == "exclude":
                barred.add(area)
            elif kind == "keyword":
                areas.setdefault(area, set()).add(phrase)
        return [(area, sorted(words)) for area, words in areas.items() if area not in barred]

    return _matched(texts, rules, id_col, text_col, "area_id string, palavras array<string>", rows_of)


def confirmed(df: DataFrame, phrase_col: str, text_col: str) -> DataFrame:
    """Rows of ``df`` whose text really holds their own phrase; each phrase is compiled once a task."""
    ship(df.sparkSession)

    @F.pandas_udf("boolean")
    def holds(phrases: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([bool(p) and bool(t) and _holds(p, t) for p, t in zip(phrases, texts)], dtype=bool)

    return df.where(holds(F.col(phrase_col), F.col(text_col)))


@functools.lru_cache(maxsize=MAX_RULES)
def _single(phrase: str) -> Matcher:
    p = compile_phrase(phrase)
    return Matcher([("", phrase, "keyword", 0, p)] if p else [])


def _holds(phrase: str, text: str) -> bool:
    return bool(_single(phrase)(text))


def hits_literal(texts: DataFrame, rules: DataFrame, id_col: str = "item_id", text_col: str = "texto") -> DataFrame:
    """As ``hits``, by matching every rule on every text; for small inputs and as a check."""
    t = texts.select(F.col(id_col), blank(text_col).alias("__raw"), fold(blank(text_col)).alias("__text"))
    r = F.broadcast(compiled(rules).distinct())  # at most MAX_RULES rules
    match = F.rlike("__text", "pattern") & ((F.col("acronyms") == "") | F.rlike("__raw", "acronyms"))
    return t.join(r, match).select(id_col, "area_id", "phrase", "kind", "ord")


def classify(found: DataFrame, id_col: str = "item_id") -> DataFrame:
    """``id_col, area_id, palavras``: areas by their matching keywords, less those with a matching exclusion."""
    g = found.groupBy(id_col, "area_id").agg(
        F.max((F.col("kind") == "exclude").cast("int")).alias("__x"), F.array_sort(F.collect_set(F.when(F.col("kind") == "keyword", F.col("phrase")))).alias("palavras")
    )
    return g.where((F.col("__x") == 0) & (F.size("palavras") > 0)).drop("__x")
