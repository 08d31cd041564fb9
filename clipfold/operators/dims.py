"""Dimensions of publications by their domain: language, origin, country, platforms.

They are the user's configuration. The defaults below serve where none is given; a table of the user's own is read with
``from_table``, which refuses more names than a plan can hold.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipfold.functions.text import domain_key

#: Names a dimension may hold; they become literals of the plan.
MOST_NAMES = 20_000

# What domains of the Portuguese-speaking press look like, whole domains outside those suffixes, countries
# by suffix (the first that fits) and by whole domain, and platforms that aren't publications.
PORTUGUESE_SUFFIXES = (".pt", ".ao", ".mz", ".cv", ".st", ".gw", ".tl", ".br")
LUSOPHONE_SUFFIXES = (".ao", ".mz", ".cv", ".st", ".gw", ".tl", ".br")
PORTUGUESE_DOMAINS = (
    "noticiasaominuto.com", "cnnportugal.iol.pt", "eco.sapo.pt", "sapo.pt", "impresa.pt", "medialivre.pt", "lusa.pt", "novojornal.co.ao",
    "cartamz.com", "agenciabrasil.ebc.com.br", "folha.uol.com.br", "pt.euronews.com", "dw.com", "france24.com", "rfi.fr",
)
NATIONAL_DOMAINS = (
    "noticiasaominuto.com", "theportugalnews.com", "lusa.pt", "cnnportugal.iol.pt", "iol.pt", "eco.sapo.pt", "sapo.pt", "impresa.pt", "medialivre.pt",
)
COUNTRIES = {
    ".pt": "Portugal", ".ao": "Angola", ".mz": "Moçambique", ".cv": "Cabo Verde", ".st": "São Tomé e Príncipe", ".gw": "Guiné-Bissau",
    ".tl": "Timor-Leste", ".br": "Brasil", ".es": "Espanha", ".fr": "França", ".it": "Itália", ".de": "Alemanha", ".uk": "Reino Unido",
    ".co.uk": "Reino Unido", ".eu": "União Europeia",
}
COUNTRY_BY_DOMAIN = {
    "agenciabrasil.ebc.com.br": "Brasil", "folha.uol.com.br": "Brasil", "novojornal.co.ao": "Angola", "cartamz.com": "Moçambique",
    "elpais.com": "Espanha", "elmundo.es": "Espanha", "abc.es": "Espanha", "lavanguardia.com": "Espanha", "lemonde.fr": "França",
    "lefigaro.fr": "França", "francetvinfo.fr": "França", "france24.com": "França", "rfi.fr": "França", "ansa.it": "Itália",
    "corriere.it": "Itália", "repubblica.it": "Itália", "spiegel.de": "Alemanha", "dw.com": "Alemanha", "bbc.com": "Reino Unido",
    "bbc.co.uk": "Reino Unido", "theguardian.com": "Reino Unido", "nytimes.com": "Estados Unidos da América",
    "washingtonpost.com": "Estados Unidos da América", "apnews.com": "Estados Unidos da América", "politico.com": "Estados Unidos da América",
    "politico.eu": "União Europeia", "euractiv.com": "União Europeia", "pt.euronews.com": "União Europeia",
}
PLATFORMS = (
    "instagram.com", "facebook.com", "fb.com", "x.com", "twitter.com", "tiktok.com", "youtube.com", "youtu.be", "linkedin.com", "reddit.com",
    "threads.net", "threads.com", "bsky.app", "t.me", "telegram.me", "whatsapp.com", "pinterest.com", "tumblr.com", "flipboard.com",
    "medium.com", "substack.com", "blogspot.com", "wordpress.com",
)


@dataclass(frozen=True)
class Dimensions:
    portuguese: tuple[str, ...] = PORTUGUESE_DOMAINS
    national: tuple[str, ...] = NATIONAL_DOMAINS
    platforms: tuple[str, ...] = PLATFORMS
    countries: dict[str, str] = field(default_factory=lambda: dict(COUNTRY_BY_DOMAIN))
    suffix_countries: dict[str, str] = field(default_factory=lambda: dict(COUNTRIES))
    portuguese_suffixes: tuple[str, ...] = PORTUGUESE_SUFFIXES
    lusophone_suffixes: tuple[str, ...] = LUSOPHONE_SUFFIXES

    def plus(self, portuguese: tuple[str, ...] = (), national: tuple[str, ...] = (), platforms: tuple[str, ...] = (), countries: dict[str, str] | None = None) -> Dimensions:
        """With further names. National publications write in Portuguese."""
        return replace(
            self, portuguese=(*self.portuguese, *national, *portuguese), national=(*self.national, *national), platforms=(*self.platforms, *platforms), countries=self.countries | (countries or {})
        )


DEFAULT = Dimensions()


def from_table(table: DataFrame, base: Dimensions = DEFAULT) -> Dimensions:
    """``base`` with the rows of ``domain, kind, value``; ``kind`` is ``portuguese``, ``national``, ``platform`` or ``country`` (named by ``value``)."""
    rows = table.select(domain_key("domain").alias("domain"), "kind", "value").where("domain <> ''").distinct().limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names of domains")
    of = lambda kind: tuple(sorted(r.domain for r in rows if r.kind == kind))
    return base.plus(of("portuguese"), of("national"), of("platform"), {r.domain: r.value for r in rows if r.kind == "country"})


def under(domain: Column, names: tuple[str, ...]) -> Column:
    """Whether a domain is one of ``names`` or below one: one set lookup for each of its endings."""
    if not names:
        return F.lit(False)
    labels = F.split(domain, r"\.")
    n = F.size(labels)
    tails = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, k, n), "."))
    return F.exists(tails, lambda t: t.isin(*sorted(set(names))))


def ends(domain: Column, suffixes: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for s in suffixes:
        hit = hit | F.endswith(domain, F.lit(s))
    return hit


def writes_portuguese(domain: Column | str, dims: Dimensions = DEFAULT) -> Column:
    """Unknown domains pass."""
    d = domain_key(domain)
    return (d == "") | ends(d, dims.portuguese_suffixes) | under(d, dims.portuguese)


def origin(domain: Column | str, dims: Dimensions = DEFAULT) -> Column:
    """``nacionais``, ``lusofonas`` or ``internacionais``; unknown domains are national."""
    d = domain_key(domain)
    return F.when((d == "") | F.endswith(d, F.lit(".pt")) | under(d, dims.national), "nacionais").when(ends(d, dims.lusophone_suffixes), "lusofonas").otherwise("internacionais")


def country(domain: Column | str, dims: Dimensions = DEFAULT) -> Column:
    """The country of the whole domain, else of the first suffix that fits, else empty."""
    d = domain_key(domain)
    out = F.lit("")
    for suffix, name in reversed(list(dims.suffix_countries.items())):
        out = F.when(F.endswith(d, F.lit(suffix)), name).otherwise(out)
    by_name: dict[str, list[str]] = {}
    for name, place in sorted(dims.countries.items()):
        by_name.setdefault(place, []).append(name)
    for place, names in sorted(by_name.items()):
        out = F.when(d.isin(*names), place).otherwise(out)
    return out


def on_platform(domain: Column | str, dims: Dimensions = DEFAULT) -> Column:
    return under(domain_key(domain), dims.platforms)
