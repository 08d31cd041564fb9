"""Problem 4: text read with the wrong character encoding, found and restored.

A field may have gone through one of several chains (the encoding it was written in, and the one it was read with). The
chain is latent. A record's evidence for a chain is how much likelier its non-ASCII characters become, in their places
between letters, spaces and signs, when the chain is undone. One record may show a single odd letter only; the share of
each chain per source and field, estimated by expectation-maximization, pools such weak evidence across records. Each
field is then judged, and restored where its chain loses nothing, by its posterior.

Cases: null and empty fields have no case; rows of no source are pooled as one source; characters in composed or
decomposed form, capitals, fractions or signs of the text itself are no case by themselves; a very long text costs one
pass; rows repeated under several ids are judged alike; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.plans.cut import cut
from clipfold.plans.ship import ship
from clipfold.plans.small import join_small

#: (written in, read with, times). The last two lose characters: U+FFFD or a question mark stand for them.
CHAINS = [
    ("utf-8", "cp1252", 1), ("utf-8", "cp1252", 2), ("utf-8", "cp850", 1), ("utf-8", "cp437", 1), ("utf-8", "mac_roman", 1), ("utf-8", "cp1251", 1), ("utf-8", "cp1250", 1),
    ("utf-8", "koi8-r", 1), ("cp1252", "cp1250", 1), ("cp1252", "cp1251", 1), ("cp1252", "mac_roman", 1), ("cp1252", "cp850", 1), ("cp1252", "iso8859-7", 1),
    ("cp850", "cp1252", 1), ("mac_roman", "cp1252", 1), ("any", "U+FFFD", 1), ("any", "?", 1),
]
LOST = len(CHAINS) - 2
RUN = re.compile(r"[^\x00-\x7f]+|\?+(?=[^\W\d_])")
UTF8 = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
CACHE_RUNS = 100_000
#: Evidence, as a logarithm, below which a chain isn't kept for a field: on the first counts, which hold the garbled text too,
#: and later. Weaker evidence than none is kept, as many fields of one source add up.
FIRST_LEAST, LEAST = -4.0, -2.0
#: Evidence is counted in steps of this size, so that fields of like evidence are one row.
STEP = 0.5
#: The archive's shares are settled when a round changes none by more.
SETTLED = 5e-5
#: Share of runs that stay as they were within a field of a chain: high where whole passages may be sound, low where
#: reading a single-byte encoding wrongly changes every character.
SOUND = {"utf-8": 0.02, "single": 1e-3}


def _byte_table(codec: str) -> dict[str, int]:
    table = {}
    for b in range(128, 256):
        try:
            table[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            table.setdefault(chr(b), b)  # undefined positions are commonly passed through
    return table


_TABLES = {codec: _byte_table(codec) for codec in {c[1] for c in CHAINS[:LOST]}}


def undo(run: str, chain: int) -> str | None:
    """``run`` with the chain undone; null if the chain can't have made any of it."""
    written, read, times = CHAINS[chain]
    table = _TABLES[read]
    if written != "utf-8":
        out = []
        for ch in run:
            b = table.get(ch)
            if b is None:
                return None
            try:
                out.append(bytes([b]).decode(written))
            except UnicodeDecodeError:
                return None
        return "".join(out)
    for _ in range(times):
        pieces, changed, i = [], False, 0
        while i < len(run):
            j = i
            while j < len(run) and run[j] in table:
                j += 1
            if j > i:
                raw, at = bytes(table[c] for c in run[i:j]), 0
                for m in UTF8.finditer(raw):
                    try:
                        ch = m.group().decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    pieces += [run[i + at : i + m.start()], ch]
                    at, changed = m.end(), True
                pieces.append(run[i + at : j])
            if j < len(run):
                pieces.append(run[j])
                j += 1
            i = j
        if not changed:
            return None
        run = "".join(pieces)
    return run


def _kind(ch: str) -> str:
    return "l" if ch.islower() else "u" if ch.isalpha() else "s" if not ch or ch.isspace() else "o"


def _places(left: str, run: str, right: str) -> Iterator[str]:
    """Each character of a run with the kinds of its neighbours, as one key."""
    for k, ch in enumerate(run):
        yield ch + _kind(run[k - 1] if k else left) + _kind(run[k + 1] if k + 1 < len(run) else right)


def count_places(df: DataFrame, fields: list[str]) -> dict[str, int]:
    """Characters outside ASCII by neighbours, over the whole table. There are at most 16 rows a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            runs: Counter = Counter()
            for k in range(len(fields)):
                for t in b.column(k).to_pylist():
                    if t and not t.isascii():
                        for m in RUN.finditer(t):
                            s, e = m.span()
                            runs[t[s - 1 : s], m.group(), t[e : e + 1]] += 1
            for (left, r, right), n in runs.items():
                for p in _places(left, r, right):
                    seen[p] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["place", "n"])

    ship(df.sparkSession)
    rows = df.select(*fields).mapInArrow(run, "place string, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
    return {r.place: r.n for r in rows}


class Evidence:
    """Evidence of runs for each chain, given how often characters occur in their places."""

    def __init__(self, places: dict[str, int]):
        self.places, self.cache = places, {}
        self.total = sum(places.values()) + 1.0
        by_char: Counter = Counter()
        for p, n in places.items():
            by_char[p[0]] += n
        self.by_char = by_char

    def logp(self, left: str, run: str, right: str) -> float:
        out = 0.0
        for k, p in enumerate(_places(left, run, right)):
            if run[k] < "\x80":
                out += log(0.05)
            else:  # the place's share, backed off to the character's
                n = self.places.get(p, 0) + 2.0 * (self.by_char.get(p[0], 0) + 0.02) / self.total
                out += log(n / (self.total + 2.0))
        return out

    def of(self, left: str, run: str, right: str) -> list[tuple[int, float]]:
        key = (_kind(left), run, _kind(right))
        got = self.cache.get(key)
        if got is None:
            got = []
            if "�" in run:
                got.append((LOST, 20.0))
            elif run[0] == "?":
                got.append((LOST + 1, 7.0 if _kind(left) in "lu" else 3.5))
            else:
                base = self.logp(left, run, right)
                for z in range(LOST):
                    fixed = undo(run, z)
                    if fixed is not None and fixed != run:
                        llr = self.logp(left, fixed, right) - base
                        sound = SOUND["utf-8" if CHAINS[z][0] == "utf-8" else "single"]
                        got.append((z, log((1 - sound) * exp(min(llr, 50.0)) + sound)))
                    elif fixed is None and CHAINS[z][0] != "utf-8":
                        got.append((z, log(SOUND["single"])))
            if len(self.cache) > CACHE_RUNS:
                self.cache.clear()
            self.cache[key] = got
        return got

    def field(self, runs: list[tuple[str, str, str]], least: float = LEAST) -> dict[int, float]:
        """Log likelihood ratios of the chains that could have made some of the runs, where above ``least``."""
        total: dict[int, float] = {}
        for left, run, right in runs:
            for z, v in self.of(left, run, right):
                total[z] = total.get(z, 0.0) + v
        return {z: v for z, v in total.items() if v > least}


def _runs(text: str) -> list[tuple[str, str, str]]:
    return [(text[s - 1 : s], m.group(), text[e : e + 1]) for m in RUN.finditer(text) for s, e in [m.span()]]


def _posteriors(ev: np.ndarray, share: np.ndarray) -> np.ndarray:
    joint = np.exp(np.clip(ev, -30, 30)) * share
    return joint / (joint.sum(1, keepdims=True) + 1 - share.sum())


def _em(ev: np.ndarray, weight: np.ndarray, n: float, mean: np.ndarray, strength: float, rounds: int) -> np.ndarray:
    """Shares of the chains among ``n`` fields, of which those in ``ev`` (log ratios) have evidence; drawn to ``mean`` as
    by ``strength`` further fields."""
    share = mean.copy()
    for _ in range(rounds):
        share = ((_posteriors(ev, share) * weight[:, None]).sum(0) + strength * mean) / (n + strength)
    return share


def _shares(kinds: DataFrame, n: float, mean: np.ndarray, strength: float, rounds: int, start: np.ndarray | None = None) -> np.ndarray:
    """The same over the whole archive: a round adds up the posteriors of all kinds of evidence where they are. It begins
    from ``start``, and ends when the shares hardly change."""
    share = mean.copy() if start is None else start
    for _ in range(rounds):
        now = share

        def add(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(CHAINS))
            for b in batches:
                ev = b.column(0).flatten().to_numpy().reshape(-1, len(CHAINS))
                total += (_posteriors(ev, now) * b.column(1).to_numpy()[:, None]).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(CHAINS))), pa.array(total)], names=["z", "p"])

        sums = {r.z: r.p for r in kinds.select("ev", "k").mapInArrow(add, "z bigint, p double").groupBy("z").agg(F.sum("p").alias("p")).collect()}  # a row a chain
        share = (np.array([sums.get(z, 0.0) for z in range(len(CHAINS))]) + strength * mean) / (n + strength)
        if np.abs(share - now).max() < SETTLED:
            break
    return share


def judge(df: DataFrame, id_col: str = "item_id", source_col: str = "fonte", fields: tuple[str, ...] = ("titulo", "resumo"), **limits) -> DataFrame:
    """``id_col, campo, chain, posterior``: fields judged garbled, with the likeliest chain (an index of ``CHAINS``)."""
    return _judge(df, id_col, source_col, fields, **limits)[0]


def _judge(
    df: DataFrame, id_col: str, source_col: str, fields: tuple[str, ...], prior: float = 0.02, strength: float = 300.0, rounds: int = 12, least: float = 0.5, passes: int = 3
) -> tuple[DataFrame, dict[str, int]]:
    """As ``judge``, and the counts of places without what is garbled."""
    cols = list(fields)
    places = count_places(df, cols)  # bounded by the characters there are, not by the rows
    ship(df.sparkSession)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(places)
        for b in batches:
            at, campos, runs = [], [], []
            for k, campo in enumerate(cols):
                for i, t in enumerate(b.column(2 + k).to_pylist()):
                    if t and (not t.isascii() or "?" in t) and evidence.field(got := _runs(t), FIRST_LEAST):
                        at.append(i)
                        campos.append(campo)
                        runs.append(["\t".join(r) for r in got])
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(campos, pa.string()), pa.array(runs, pa.list_(pa.string()))], names=["id", "src", "campo", "runs"])

    key = F.coalesce(F.lower(F.trim(F.col(source_col))), F.lit("")).alias("src")
    src = df.select(F.col(id_col).alias("id"), key, *cols)
    kind = src.schema["id"].dataType.simpleString()
    suspects = cut(src.mapInArrow(screen, f"id {kind}, src string, campo string, runs array<string>"), "suspects")
    sizes = src.groupBy("src").agg(*[F.count(F.when(F.col(c) != "", 1)).alias(c) for c in cols])
    sizes = sizes.select("src", F.explode(F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c))])).alias("campo", "n"))
    sizes = cut(sizes, "field-sizes")
    mean = None
    for k in range(passes):
        judged, mean = _posterior(suspects, sizes, places, prior, strength, rounds, mean)
        if k + 1 < passes:  # what is probably garbled no longer counts as text of the archive
            places = _without(judged, places)
    return judged.select(F.col("id").alias(id_col), "campo", "chain", "posterior").where(F.col("posterior") >= least), places


def _posterior(suspects: DataFrame, sizes: DataFrame, places: dict[str, int], prior: float, strength: float, rounds: int, start: np.ndarray | None) -> tuple[DataFrame, np.ndarray]:
    """``suspects`` with their likeliest chain and the posterior of any chain; and the archive's shares, from which the next
    pass begins."""
    kind = suspects.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(places)
        for b in batches:
            rows = [evidence.field([tuple(r.split("\t")) for r in runs]) for runs in b.column(3).to_pylist()]
            ev = [[round(min(30.0, got[z]) / STEP) * STEP if z in got else -30.0 for z in range(len(CHAINS))] for got in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ev, pa.list_(pa.float64()))], names=[*b.schema.names, "ev"])

    weighed = cut(suspects.mapInArrow(weigh, f"id {kind}, src string, campo string, runs array<string>, ev array<double>").where(F.array_max("ev") > -30.0), "weighed")
    kinds = cut(weighed.groupBy("src", "campo", "ev").agg(F.count("*").alias("k")).join(sizes, ["src", "campo"]), "evidence")  # fields of like evidence are one row
    n = sizes.agg(F.sum("n").alias("n")).first().n or 0
    mean = _shares(kinds, float(n), np.full(len(CHAINS), prior / len(CHAINS)), 10.0, rounds, start)

    def shares(group: pa.Table) -> pa.Table:
        ev = np.array(group["ev"].to_pylist(), float)
        share = _em(ev, group["k"].to_numpy(), float(group["n"][0].as_py()), mean, strength, rounds)
        return pa.table({"src": group["src"].slice(0, 1), "campo": group["campo"].slice(0, 1), "share": pa.array([share.tolist()], pa.list_(pa.float64()))})

    prior_by_source = kinds.groupBy("src", "campo").applyInArrow(shares, "src string, campo string, share array<double>")
    joint = F.zip_with("ev", "share", lambda e, s: F.exp(e) * s)
    total = F.aggregate("joint", F.lit(0.0), lambda a, x: a + x)
    clean = F.lit(1.0) - F.aggregate("share", F.lit(0.0), lambda a, x: a + x)
    judged = join_small(weighed, prior_by_source, ["src", "campo"]).withColumn("joint", joint)
    best = (F.array_position("joint", F.array_max("joint")) - 1).cast("int")
    return judged.select("id", "campo", "runs", best.alias("chain"), (total / (total + clean)).alias("posterior")), mean


def _without(judged: DataFrame, places: dict[str, int]) -> dict[str, int]:
    """``places`` less what the judged fields hold in runs that their chain explains, by posterior."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence, seen = Evidence(places), Counter()
        for b in batches:
            for runs, z, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for left, run, right in (r.split("\t") for r in runs):
                    if any(y == z and v > 0 for y, v in evidence.of(left, run, right)):
                        for place in _places(left, run, right):
                            seen[place] += p
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([float(v) for v in seen.values()], pa.float64())], names=["place", "n"])

    gone = judged.select("runs", "chain", "posterior").mapInArrow(count, "place string, n double").groupBy("place").agg(F.sum("n").alias("n")).collect()
    return places | {r.place: max(0.0, places.get(r.place, 0) - r.n) for r in gone}


def restore(text: str, chain: int, evidence: Evidence) -> str:
    """``text`` with the chain undone in each run that becomes likelier by it."""

    def fix(m: re.Match) -> str:
        run, (s, e) = m.group(), m.span()
        if run[0] == "?" or (fixed := undo(run, chain)) is None:
            return run
        left, right = text[s - 1 : s], text[e : e + 1]
        return fixed if evidence.logp(left, fixed, right) > evidence.logp(left, run, right) else run

    return RUN.sub(fix, text)


def repair(df: DataFrame, id_col: str = "item_id", source_col: str = "fonte", fields: tuple[str, ...] = ("titulo", "resumo"), **limits) -> DataFrame:
    """``id_col, campo, cadeia, posterior, texto, inteiro``: garbled fields with their restored text.

    ``inteiro`` is false where the chain lost characters; the text is then as it was.
    """
    cols = list(fields)
    found, places = _judge(df, id_col, source_col, fields, **limits)
    texts = df.select(F.col(id_col), F.explode(F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c))])).alias("campo", "texto"))
    src = found.join(texts, [id_col, "campo"]).select(id_col, "campo", "chain", "posterior", "texto")
    kind = src.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(places)
        for b in batches:
            chains, texts = b.column(2).to_pylist(), b.column(4).to_pylist()
            fixed = [t if z >= LOST else restore(t, z, evidence) for z, t in zip(chains, texts)]
            for k, z in enumerate(chains):
                if z == 0 and (again := restore(fixed[k], z, evidence)) != fixed[k]:  # read wrongly twice
                    chains[k], fixed[k] = 1, again
            names = [f"{CHAINS[z][0]} > {CHAINS[z][1]}" + (" x2" if CHAINS[z][2] > 1 else "") for z in chains]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), b.column(3), pa.array(fixed, pa.string()), pa.array([z < LOST for z in chains], pa.bool_())],
                names=[id_col, "campo", "cadeia", "posterior", "texto", "inteiro"],
            )

    return src.mapInArrow(run, f"`{id_col}` {kind}, campo string, cadeia string, posterior double, texto string, inteiro boolean")
