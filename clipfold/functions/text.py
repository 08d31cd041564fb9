"""Scalar text functions: Column in, Column out, all built-in expressions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(col(c), F.lit(""))


def filled(c: Column | str) -> Column:
    """The empty string as null."""
    return F.nullif(col(c), F.lit(""))


def _decomposed() -> tuple[str, str]:
    """Letters that decompose into one ASCII character and marks, and those characters."""
    src, dst = [], []
    for code in range(0x80, 0x10000):
        ch = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", ch) if x < "\x80")
        if len(base) == 1 and unicodedata.normalize("NFD", ch) != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_ACCENTED, _PLAIN = _decomposed()


def fold(c: Column | str) -> Column:
    """Lower case without accents; whatever isn't ASCII then is dropped, so that joined dashes fuse words."""
    return F.regexp_replace(F.translate(F.lower(col(c)), _ACCENTED, _PLAIN), r"[^\x00-\x7F]", "")


def slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def unescape(c: Column | str) -> Column:
    """Named and numeric entities as their characters, by the full table of HTML. Only texts with an ampersand go to Python."""

    @F.pandas_udf("string")
    def resolved(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.coalesce(resolved(F.when(F.contains(col(c), F.lit("&")), col(c))), col(c))


def squeeze(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def clean_html(c: Column | str) -> Column:
    """Tags become spaces first, then entities are resolved (escaped tags so survive), then white space is squeezed."""
    return squeeze(unescape(F.regexp_replace(col(c), "<[^>]+>", " ")))


def title_without_source(title: Column | str) -> Column:
    """The title up to its last `` - ``."""
    t = col(title)
    return F.when(t.contains(" - "), F.regexp_extract(t, r"(?s)^(.*) - (.*)$", 1)).otherwise(t)


def source_in_title(title: Column | str) -> Column:
    """What follows the last `` - `` of a title; empty without one."""
    return F.regexp_extract(col(title), r"(?s)^(.*) - (.*)$", 2)


def split_title(title: Column | str, source: Column | str) -> tuple[Column, Column]:
    """Title and source: the tail names the source if there is none, and is only taken off if it is the source."""
    t, s, tail = col(title), blank(source), source_in_title(title)
    has = t.contains(" - ") & (tail != "")
    known = has & (F.lower(tail) == F.lower(s))
    return F.when(has & ((s == "") | known), title_without_source(t)).otherwise(t), F.when(has & (s == ""), tail).otherwise(s)


#: Fixed value: what stays of a text when it is compared with its title.
COMPARED = "[^a-z0-9áàâãéêíóôõúç ]"


def _bare(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), COMPARED, ""))


def summary_unless_title(summary: Column | str, title: Column | str, first: int = 45) -> Column:
    """Empty where the summary only repeats the beginning of the title (an empty title is repeated by any)."""
    return F.when(F.startswith(_bare(blank(summary)), F.substring(_bare(blank(title)), 1, first)), "").otherwise(blank(summary))


def shorten(c: Column | str, limit: int = 190) -> Column:
    """Longer texts are cut before the word that crosses ``limit`` characters and end in an ellipsis."""
    return F.when(F.length(col(c)) > limit, F.concat(F.regexp_replace(F.substring(col(c), 1, limit), " [^ ]*$", ""), F.lit("…"))).otherwise(col(c))


def escape_html(c: Column | str) -> Column:
    out = col(c)
    for ch, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(ch), F.lit(name))
    return out


def safe_url(c: Column | str) -> Column:
    return F.when(col(c).rlike("(?i)^https?://"), col(c)).otherwise("")


def domain_key(c: Column | str) -> Column:
    """Lower case, every ``www.`` removed."""
    return F.replace(F.lower(blank(c)), F.lit("www."), F.lit(""))


def host(url: Column | str) -> Column:
    """The authority of an address, port and user included; empty without one."""
    return F.regexp_extract(blank(url), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


# Addresses that belong to the aggregator and not to a publication, endings of images, characters of an
# address in a link's payload.
FOREIGN = ("google.com", "google.pt", "gstatic.com", "googleusercontent.com", "googleapis.com", "policies.google", "accounts.google", "consent.google")
IMAGE = r"(?i)\.(png|jpe?g|gif|webp|svg|ico|bmp)(\?|#|$)"
ADDRESS = r"https?://[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]{20,}"
AGGREGATOR = "news.google.com"


def plausible_url(url: Column | str, foreign: tuple[str, ...] = FOREIGN, least: int = 24) -> Column:
    """An http address of some length that is neither of a foreign service nor an image."""
    u = blank(url)
    ok = u.rlike("(?i)^https?://") & (F.length(u) >= least) & ~u.rlike(IMAGE)
    for name in foreign:
        ok = ok & ~F.contains(u, F.lit(name))
    return ok


def redirect_target(url: Column | str, aggregator: str = AGGREGATOR) -> Column:
    """The first plausible address inside the base64url payload of an ``aggregator``'s link; else the link itself."""
    link = col(url)
    payload = F.substring_index(F.substring_index(link, "/articles/", -1), "?", 1)
    body = F.translate(F.regexp_replace(payload, "[^A-Za-z0-9_-]", ""), "-_", "+/")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), "=")
    inner = F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1")
    found = F.filter(F.regexp_extract_all(inner, F.lit(ADDRESS), F.lit(0)), lambda u: plausible_url(u))
    return F.when(F.contains(link, F.lit(aggregator)), F.coalesce(F.try_element_at(found, F.lit(1)), link)).otherwise(link)


def damaged(title: Column | str, summary: Column | str, source: Column | str, link: Column | str) -> Column:
    """Replacement characters in a text, or a link that isn't an address."""
    bad = F.contains(F.concat(blank(title), blank(summary), blank(source)), F.lit("�"))
    return bad | ((blank(link) != "") & ~F.startswith(blank(link), F.lit("http")))


EMAIL = r"^[^@\s,;<>]+@[^@\s,;<>]+\.[A-Za-z]{2,}$"


def email_key(c: Column | str) -> Column:
    """Trimmed and lower-cased; null for what isn't an address."""
    e = F.lower(F.trim(col(c)))
    return F.when(e.rlike(EMAIL), e)


def mask_email(c: Column | str) -> Column:
    """The first letter of short local parts or three of longer ones, then at least three stars."""
    local, at = F.split_part(col(c), F.lit("@"), F.lit(1)), F.split_part(col(c), F.lit("@"), F.lit(2))
    shown = F.when(F.length(local) > 4, 3).otherwise(1)
    return F.concat(F.substring(local, F.lit(1), shown), F.repeat(F.lit("*"), F.greatest(F.lit(3), F.length(local) - shown)), F.lit("@"), at)


def length_tier(n: Column | str, medium: int = 15, long: int = 40) -> Column:
    return F.when(col(n) >= long, "long").when(col(n) >= medium, "medium").otherwise("short")


def title_line(title: Column | str, source: Column | str, country: Column | str, unknown: str = "fonte desconhecida") -> Column:
    """``title (source · country)``, the country only where it is known."""
    return F.concat(blank(title), F.lit(" ("), F.concat_ws(" · ", F.coalesce(filled(source), F.lit(unknown)), filled(country)), F.lit(")"))
