"""Feeds: from addresses to raw payloads, and from payloads to dated items.

Each address is fetched and each payload decoded, repaired and parsed apart, so that a malformed feed gives an error row of its own and no feed
loses the items of another.
"""

from __future__ import annotations

import html
import re
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipfold.functions.dates import parse_minute, parse_rfc
from clipfold.functions.text import blank, clean_html, split_title, summary_unless_title
from clipfold.operators.items import ORDER, with_registry
from clipfold.operators.merge import first_with_keywords
from clipfold.operators.report import top_k
from clipfold.operators.rules import confirmed
from clipfold.plans.ship import ship

PAYLOAD = "feed_ord int, url string, body binary"
PARSED = "feed_ord int, item_ord int, titulo string, resumo string, ligacao string, imagem string, data string, fonte string, dominio string, erro string"
_FIELDS = ["titulo", "resumo", "ligacao", "imagem", "data", "fonte", "dominio"]
_XML_OWN = {"amp", "lt", "gt", "quot", "apos"}
_DECLARED = re.compile(rb"encoding\s*=\s*[\"']([A-Za-z0-9._-]+)[\"']", re.I)
_ENTITY = re.compile(r"&([A-Za-z][A-Za-z0-9]*);")
#: Encodings tried after the declared one; the last reads any byte.
ENCODINGS = ("utf-8", "cp1252", "iso-8859-1")


def fetch(feeds: DataFrame, timeout: float = 30.0, agent: str = "clipfold", most_bytes: int = 64 << 20, parts: int = 8) -> DataFrame:
    """Payloads of ``feed_ord, url`` (rows of ``PAYLOAD`` and ``erro``), fetched by ``parts`` tasks; an address that fails, or whose
    body is longer than ``most_bytes``, has its error and no body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for feed, url in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                body, error = None, None
                try:
                    if not (url or "").startswith(("http://", "https://")):
                        raise ValueError("no http address")
                    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as got:
                        body = got.read(most_bytes + 1)
                    if len(body) > most_bytes:
                        raise ValueError(f"more than {most_bytes} bytes")
                except Exception as e:  # the fault of one feed is its own
                    body, error = None, f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([feed], pa.int32()), pa.array([url], pa.string()), pa.array([body], pa.binary()), pa.array([error], pa.string())], names=["feed_ord", "url", "body", "erro"])

    return feeds.select(F.col("feed_ord").cast("int").alias("feed_ord"), "url").repartition(parts).mapInArrow(run, PAYLOAD + ", erro string")


def decode(body: bytes) -> str:
    """By the encoding declared at the start, else the first of ``ENCODINGS`` that reads all of it."""
    declared = _DECLARED.search(body[:200])
    for name in ([declared.group(1).decode().lower()] if declared else []) + list(ENCODINGS):
        try:
            return body.decode(name).removeprefix("\ufeff")
        except (UnicodeDecodeError, LookupError):
            continue
    raise AssertionError("the last encoding reads any byte")


def repair(text: str) -> str:
    """Named entities that XML doesn't know become their characters, unknown ones a space; stray ampersands are escaped."""
    text = _ENTITY.sub(lambda m: m.group() if m.group(1) in _XML_OWN else html.entities.html5.get(m.group(1) + ";", " "), text)
    text = re.sub(r"&(?![A-Za-z]+;|#\d+;|#x[0-9A-Fa-f]+;)", "&amp;", text)
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", text)


def _local(tag) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def _first(item: ET.Element, *names: str) -> str:
    for name in names:
        for child in item:
            if _local(child.tag) == name and (child.text or "").strip():
                return child.text.strip()
    return ""


def _address(text: str | None) -> str:
    text = (text or "").strip()
    return text if text.startswith("http") else ""


def item_link(item: ET.Element) -> str:
    """The text of ``link``, else the href of an alternate one, else guid, original link or id, if it is an address."""
    options = [_first(item, "link")]
    options += [c.get("href") for c in item.iter() if _local(c.tag) == "link" and c.get("rel", "alternate") == "alternate"]
    options += [_first(item, "guid"), _first(item, "origLink"), _first(item, "id")]
    return next(filter(None, map(_address, options)), "")


#: The source of the first picture in a piece of HTML.
_PICTURE = re.compile(r"<img\b(?:[^>]*?\s)?src\s*=\s*(?P<q>[\"'])(?P<at>.*?)(?P=q)", re.I | re.S)


def item_image(item: ET.Element) -> str:
    """Media content, else thumbnail, else an enclosure that is an image or untyped, else the first picture of the text; only addresses."""
    options = [c.get("url") for name in ("content", "thumbnail") for c in item.iter() if _local(c.tag) == name]
    options += [c.get("url") for c in item if _local(c.tag) == "enclosure" and c.get("type", "image").startswith("image")]
    options += [m.group("at") for name in ("description", "encoded") if (m := _PICTURE.search(_first(item, name)))]
    return next(filter(None, map(_address, options)), "")


def _source(item: ET.Element) -> tuple[str, str]:
    """Name and domain of the publication that the item itself names."""
    for c in item:
        if _local(c.tag) == "source":
            at = (c.get("url") or "").partition("://")[2]
            return (c.text or "").strip(), re.split("[/?#]", at)[0]
    return "", ""


def parse(text: str) -> list[dict[str, str]]:
    """Items of a feed by their local name (``item``, else ``entry``), whatever the namespace."""
    root = ET.fromstring(text)
    found = [e for e in root.iter() if _local(e.tag) == "item"] or [e for e in root.iter() if _local(e.tag) == "entry"]
    out = []
    for e in found:
        fonte, dominio = _source(e)
        out.append({
            "titulo": _first(e, "title"), "resumo": _first(e, "description", "summary", "content"), "ligacao": item_link(e), "imagem": item_image(e),
            "data": _first(e, "pubDate", "date", "published", "updated"), "fonte": fonte, "dominio": dominio,
        })
    return out


def explode_items(payloads: DataFrame) -> DataFrame:
    """Rows of ``PARSED``: the items of each payload, or one row with ``erro`` for a payload that can't be parsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for feed, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    got = parse(repair(decode(body or b"")))
                except ET.ParseError as e:
                    rows.append({"feed_ord": feed, "erro": str(e)})
                    continue
                rows += [{"feed_ord": feed, "item_ord": k, **item} for k, item in enumerate(got, 1)]
            types = {"feed_ord": pa.int32(), "item_ord": pa.int32()} | dict.fromkeys([*_FIELDS, "erro"], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in types.items()], names=list(types))

    ship(payloads.sparkSession)
    return payloads.select("feed_ord", "body").mapInArrow(run, PARSED)


def parse_date(c: Column, as_of: datetime) -> Column:
    """Mail dates, and ISO dates as newer feeds have them."""
    iso = F.try_to_timestamp(c).cast("timestamp_ntz")
    local = F.when(c.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.convert_timezone(F.current_timezone(), F.lit("Europe/Lisbon"), iso)).otherwise(iso)
    return F.coalesce(parse_rfc(c, as_of), F.when(c.rlike(r"^\d{4}-\d\d-\d\d"), F.least(local, F.lit(as_of).cast("timestamp_ntz"))), parse_minute(c))


def items(payloads: DataFrame, feeds: DataFrame, as_of: datetime, run_ord: int = 1) -> tuple[DataFrame, DataFrame]:
    """Normalised items (``run_ord, feed_ord, item_ord, ts, fonte, dominio, titulo, resumo, ligacao, imagem``), and errors.

    Source and domain are the item's own, else those of its feed.
    """
    parsed = explode_items(payloads)
    good = parsed.where("erro is null").withColumn("ts", F.date_trunc("minute", parse_date(F.col("data"), as_of)).cast("timestamp_ntz"))
    cleaned = good.withColumns({"titulo": clean_html("titulo"), "fonte": clean_html(blank("fonte")), "resumo": clean_html("resumo")})
    title, source = split_title("titulo", "fonte")
    out = with_registry(cleaned.withColumns({"titulo": title, "fonte": source}), feeds)
    out = out.select(F.lit(run_ord).alias("run_ord"), "feed_ord", "item_ord", "ts", "fonte", "dominio", "titulo", summary_unless_title("resumo", "titulo").alias("resumo"), "ligacao", "imagem")
    return out, parsed.where("erro is not null").select("feed_ord", "erro")


def registry(*lists: DataFrame) -> DataFrame:
    """The lists of feeds one after the other; leave a list out to switch it off."""
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def search_query(phrases: Column, exclusions: Column, hosts: Column, days: int) -> Column:
    """``("a" OR "b") -"x" -site:h when:7d`` from lists of phrases, exclusions and hosts."""
    quoted = F.array_join(F.transform(phrases, lambda p: F.concat(F.lit('"'), p, F.lit('"'))), " OR ")
    minus = F.transform(exclusions, lambda p: F.concat(F.lit('-"'), p, F.lit('"')))
    sites = F.transform(hosts, lambda h: F.concat(F.lit("-site:"), h))
    parts = [F.concat(F.lit("("), quoted, F.lit(")")), *(F.when(F.size(x) > 0, F.array_join(x, " ")) for x in (minus, sites)), F.lit(f"when:{days}d")]
    return F.concat_ws(" ", *parts)


def search_url(query: Column, base: str, language: str = "pt-PT", country: str = "PT", edition: str = "PT:pt-150") -> Column:
    """The address of a search's feed at ``base``, in an edition."""
    q = F.url_encode(query)
    for was, now in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        q = F.replace(q, F.lit(was), F.lit(now))
    return F.concat(F.lit(f"{base}?q="), q, F.lit(f"&hl={language}&gl={country}&ceid={edition}"))


def by_keyword(fetched: DataFrame, limit: int = 60, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Items fetched keyword by keyword (``area, palavra`` with the item's fields) as one row an item with all its keywords.

    The first ``limit`` rows of a search count; as searches match loosely, each row's keyword must really be in its text;
    rows of one area, title and source are one item.
    """
    first = top_k(fetched, [F.col("area"), F.col("palavra")], [F.asc(c) for c in order], limit)
    true = confirmed(first.withColumn("__text", F.concat_ws(" ", "titulo", "resumo")), "palavra", "__text").drop("__text")
    listed = true.withColumn("palavras", F.array("palavra")).drop("palavra")
    return first_with_keywords(listed, [F.col("area"), F.lower("titulo"), F.lower("fonte")], order=order)
