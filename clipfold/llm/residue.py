"""Problem 9: template residue, filler, error messages and script notices in documents.

Messages are mined with a fixed-depth prefix tree over the sentences of all documents: sentences of one length and the
same leading words meet in a leaf, where similar ones share a template (numbers, names and differing words become
gaps). Each batch of documents grows a partial tree of its own, whose templates stand for their sentences from then on; the
partial templates of a leaf are then merged over all batches into the corpus's templates.

A template is judged once, by two signals. What it says and where: the message patterns, over its sentences as they were
worded, so that a rare wording gets the verdict of the template it belongs to, if it stands alone on most of its lines and not
among sentences with names, which tell of something. And how it stands, whatever it says: a sentence of some words that several
sources have, almost only in texts that tell of nothing at all, is a page in place of an article.
The verdict goes to every document that holds the template.
Unresolved slots inside ordinary text are found apart, by their syntax, unless the text quotes or explains them.

Cases: null and empty texts, stray symbols, tables and other scripts are no case; a very long text is read line by
line; a sentence of more than ``MAX_WORDS`` words is a template of its own, judged on its whole text; a sentence with a
name in it tells of something and is never a message; rows repeated under several ids are judged alike; documents of no
source count as one source; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.plans.cut import cut
from clipfold.plans.ship import ship
from clipfold.plans.small import join_small

DEPTH, SIMILAR, MAX_WORDS = 3, 0.7, 40
#: Templates of a leaf, above which the tree is deeper at this place.
LEAF_MOST = 300
#: A text tells of nothing if only so many of its lines have a name, each a single sentence, such as a headline and a signature.
MOST_TOLD = 2
SENTENCE = re.compile(r"(?<=[.!?…])\s+")
NAME = r"[A-Za-zÀ-ÿ_][\wÀ-ÿ .-]{0,40}?"
_FILL = r"(?:inser\w*|insér\w*|insert\w*|preench\w*|complet\w*|complét\w*|rellen\w*|rempl\w*|fill|einf[uü]g\w*|erg[aä]nz\w*|eintrag\w*|tk|tbd|todo|replace|substitu\w*|ersetz\w*)"
_HERE = r"(?:aqui|aquí|here|ici|hier|your|seu|sua|su|votre|ihr|ihre)"
#: Slots that a publishing system fills in; the syntax of common template languages and of notes to the editor.
SLOTS = re.compile(
    rf"\{{\{{\s*[#/^>&]?\s*{NAME}\s*\}}\}}|\{{%-?\s*\w+[^%\n]{{0,60}}%\}}|<%[=-]?\s*{NAME}\s*%>|\$\{{\s*{NAME}\s*\}}|%%{NAME}%%|@@{NAME}@@|##{NAME}##|__[A-Z][A-Z_]+__"
    rf"|#[A-ZÀ-Þ][A-ZÀ-Þ_]{{2,40}}#|\[\[\s*{NAME}\s*\]\]|(?<![\w{{$])\{{[A-Za-zÀ-ÿ_]{{2,40}}\}}(?!\}})"
    rf"|\[(?:\w+ )?(?i:{_FILL})\b[^\]\n]{{0,60}}\]|\[[^\]\n]{{1,60}}\b(?i:{_FILL}|{_HERE})\]"
    rf"|\((?:[àa] |hier |bitte |por |to )?(?i:{_FILL})\b[^)\n]{{0,60}}\)|\((?i:hier|bitte) [^)\n]{{1,60}} (?i:{_FILL})\)"
    rf"|<(?:[^<>\n]{{1,60}} )?(?i:{_HERE})>|<(?i:{_HERE}|{_FILL}) [^<>\n]{{1,60}}>",
)
OPEN_QUOTES = "«“„\"'‘‚`"
#: Words of a sentence that explains a slot instead of leaving it open.
EXPLAINS = re.compile(r"\b(?:variave\w*|variables?|platzhalter\w*|placeholders?|sintaxe|syntax\w*|sintaxis|codigo|code)\b")


def fold(s: str) -> str:
    s = s.lower()
    return s if s.isascii() else "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))


_STATUS = r"(?:not found|bad gateway|gateway time[- ]?out|internal server error|bad request|forbidden|gone|service (?:temporarily )?unavailable|unauthorized|method not allowed|too many requests|request time[- ]?out)"
#: What messages of each class say, on folded text with gaps for numbers.
CLASSES = [
    ("script", re.compile(
        r"\b(?:javascript|scripts?|skripte?)\b.*\b(?:ativ\w*|activ\w*|enabled?|turn|switch|ligu?\w*|habilit\w*|einschalten|schalten|aktivier\w*|needs?|requires?|required|load|continuar|desativ\w*|disabled|blocked)\b"
        r"|\b(?:ativ\w*|activ\w*|activez|enable|turn on|switch on|ligu?\w*|habilit\w*|schalten|aktivier\w*|needs?|requires?|requiert|precisa|necesita|requiere|benotigt|erfordert|nao executa|does not run|no ejecuta|execute pas|fuhrt keine|necessite)\b.*\b(?:javascript|scripts?|skripte?)\b"
        r"|\b(?:ligue|active|ative|habilite|activez|aktivieren|switch)\b.{0,5}(?:os|los|les|las|them)\b.*\b(?:recarregue|reload|rechargez|recargar?|laden)\b|\bbitte aktivieren und neu laden\b")),
    ("error", re.compile(
        rf"^(?:http )?(?:error |erro |erreur |fehler )?(?:<\*> )?(?:- )?{_STATUS}$|^(?:http |error |erro |erreur |fehler |http error )<\*>$|^(?:error|erro|erreur|fehler) <\*> ?(?::|-|–|—)|^http <\*> [-–:] \S+(?: \S+){{0,3}}$"
        r"|\b(?:pagina que procura nao existe|pagina nao (?:foi )?encontrada|pagina no encontrada|page introuvable|page not found|seite (?:wurde )?nicht gefunden)\b"
        r"|\b(?:falha interna do servidor|temporariamente indisponivel|temporalmente no disponible|service (?:temporairement )?indisponible|servicio no disponible|servico indisponivel|dienst (?:ist )?(?:derzeit )?nicht verfugbar|service is (?:temporarily )?unavailable|serverfehler|erreur interne du serveur|error interno del servidor)\b"
        r"|\b(?:sessao expirou|session (?:has )?(?:timed out|expired)|session a expire|sesion ha (?:caducado|expirado)|sitzung ist abgelaufen)\b"
        r"|^(?:acesso negado|access denied|acces refuse|acceso denegado|zugriff verweigert)\b"
        r"|\b(?:algo correu mal|something went wrong|algo (?:salio|ha salido|fue) mal|(?:une|un) (?:erreur|probleme) est survenue?|etwas ist schief ?gelaufen|ocorreu um erro|se ha producido un error|an error (?:has )?occurred|ein fehler ist aufgetreten)\b"
        r"|\b(?:traceback|stack trace)\b.*:|\b\w*(?:error|exception): \S|\brender\(\) line\b")),
    ("filler", re.compile(
        r"^lorem ipsum\b|\b(?:lorem|ipsum)\b(?:.*\b(?:lorem|ipsum)\b){2}|^(?:\W*\b(?:bla|blah)\b\W*){3,}|^(?:x{3,}|asdf\w*|qwer\w*|todo|tbd)(?: (?:x{3,}|asdf\w*|qwer\w*|todo|tbd))+\b|^x{3,}$"
        r"|\b(?:paragrafo de teste|test paragraph|parrafo (?:provisional|de prueba)|paragraphe (?:provisoire|d.essai|de test)|testabsatz)\b"
        r"|\b(?:apagar antes de publicar|delete before publi\w+|borrar antes de publicar|effacer avant parution|vor veroffentlichung loschen)\b"
        r"|\b(?:texto de (?:exemplo|ejemplo|prueba|teste|relleno)|texte (?:d.exemple|de test|factice|de remplissage)|dummy (?:copy|text)|sample text|filler text|blindtext|beispieltext|fulltext)\b.*\b(?:coluna|columna|colonne|column|spalte|preencher|llenar|remplir|fill|fullen)\b"
        r"|\b(?:aqui (?:entra|vai) o (?:corpo|texto)|aqui va el (?:cuerpo|texto)|ici (?:viendra|vient) le (?:corps|texte)|(?:body )?text goes here|hier steht (?:spater )?der (?:artikel|text))\b")),
]


def leaf_of(words: tuple[str, ...] | list[str], depth: int = DEPTH) -> tuple:
    return (len(words), *words[:depth])


class TemplateTree:
    """Prefix tree of fixed depth: number of words, then the leading words; a leaf holds templates of similar sentences."""

    def __init__(self, depth: int = DEPTH, similar: float = SIMILAR):
        self.depth, self.similar = depth, similar
        self.leaves: dict[tuple, list[list[str]]] = {}

    def add(self, words: tuple[str, ...], depth: int | None = None) -> list[str]:
        depth = depth or self.depth
        leaf = self.leaves.setdefault(leaf_of(words, depth), [])
        for template in leaf:
            same = sum(a == b for a, b in zip(template, words))
            if same >= self.similar * len(words):
                if same < len(words):
                    for k, w in enumerate(words):
                        if template[k] != w:
                            template[k] = "<*>"
                return template
        if len(leaf) >= LEAF_MOST and depth < len(words):  # a full leaf stays as it is, and the tree is deeper there
            return self.add(words, depth + 2)
        leaf.append(list(words))
        return leaf[-1]


#: Capitalised words of messages that aren't names, German nouns among them.
_KNOWN = re.compile(
    r"javascript|http\w*|todo|tbd|x{3,}|lorem|ipsum|nonetype|traceback|\w+error:?|\w+exception:?|id|browser|skripte?|inhalte?|seiten?|sitzung|ressourcen?|spalten?|artikel|beitrags?|texte?s?|blindtext"
    r"|testabsatz|beispieltext|platzhalter|veroffentlichung|dienst\w*|server\w*|fehler\w*|zugriff|anfrage|verbindung|einstellungen|anmeldung|berechtigung|sie|ihre?n?|bitte"
)


#: Words that fill a line before the message.
_STUFFING = {"bla", "asdf", "qwer", "todo", "tbd", "xxx", "xxxx", "xxxxx", "xxxxxx", "xxxxxxx", "...", "...,", "…"}


def masked(sentence: str) -> tuple[str, ...]:
    """Folded words of a sentence; numbers become ``<*>``, names after the first word ``<N>``."""
    caps = sentence.isupper()
    out: list[str] = []
    for w in sentence.split():
        if any(c.isdigit() for c in w):
            out.append("<*>" + (":" if w.endswith(":") else ""))
            continue
        f = fold(w)
        bare = w.strip("«»“”„\"'‘’‚(),.;:!?")
        if any(f not in _STUFFING for f in out) and not caps and len(bare) > 2 and bare[0].isupper() and not _KNOWN.fullmatch(fold(bare)):
            out.append("<N>")
        else:
            out.append(f)
    return tuple(out)


_CAPITAL = re.compile(r"(?<=\s)[«“„\"'‘(]*([A-ZÀ-Þ][^\W\d_]{2,})")


def has_name(sentence: str) -> bool:
    """Whether ``masked`` would see a name, found without taking the sentence apart."""
    for m in _CAPITAL.finditer(sentence):
        if not _KNOWN.fullmatch(fold(m.group(1))):
            return not sentence.isupper() and any(f not in _STUFFING for f in fold(sentence[: m.start()]).split())
    return False


def classify(template: str) -> str | None:
    """What a template says, if it says it as a message: no name in it but in status lines, no quotation around it."""
    plain = template.strip(" .!?…()")
    loose = re.sub(r"<N>", lambda m: "", plain)
    status = re.search(rf"^(?:http )?(?:error |erro |erreur |fehler )?(?:<\*> )?(?:- )?{_STATUS}$", fold(plain).replace("<n>", "").strip())
    if status:
        return "error"
    if "<N>" in plain or any(q in plain for q in "«»“”„"):
        return None
    for name, pattern in CLASSES:
        if pattern.search(loose):
            return name
    return None


def _status_words(sentence: str) -> tuple[str, ...] | None:
    """Status lines are short and set in title case, so their words aren't taken for names."""
    if len(sentence) <= 60 and re.search(_STATUS, low := fold(sentence)):
        return tuple("<*>" if any(c.isdigit() for c in w) else w for w in low.replace("time-out", "time out").split())
    return None


def open_slots(text: str) -> list[str]:
    """Slots left open in ``text``: not quoted, and not in a sentence that explains them."""
    found = []
    for m in SLOTS.finditer(text):
        before = text[m.start() - 1 : m.start()]
        after = text[m.end() : m.end() + 1]
        if before and before in OPEN_QUOTES and after and after in "»”“\"'’‘`":
            continue
        s = max(text.rfind(c, 0, m.start()) for c in ".!?\n") + 1
        e = min((i for i in (text.find(c, m.end()) for c in ".!?\n") if i >= 0), default=len(text))
        if EXPLAINS.search(fold(text[s : m.start()] + " " + text[m.end() : e])):
            continue
        found.append(m.group())
    return found


_SCAN = "slot string, template string, leaf bigint, kind string, own boolean, bare boolean, src string"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, slot, template, leaf, kind, own, bare, src``: a row for each slot left open, and for each sentence without a name
    its template in the partial tree of its batch, that one's leaf, what the sentence's own wording says as a message, and
    whether the line has no sentence with a name (``own``) and the whole text tells of nothing (``bare``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tree = TemplateTree()
            says: dict[tuple[str, ...], str | None] = {}
            at: list[int] = []
            rows: list[tuple[str | None, list[str] | str | None, str | None, bool]] = []
            bare = np.ones(len(b), bool)
            for i, text in enumerate(b.column(1).to_pylist()):
                if not text:
                    continue
                if any(c in text for c in "{<$%@#[(_"):
                    for slot in dict.fromkeys(open_slots(text)):
                        at.append(i)
                        rows.append((slot, None, None, True))
                told = 0
                for line in text.split("\n"):
                    found, names = [], False
                    sentences = SENTENCE.split(line)
                    for s in sentences:
                        s = s.strip()
                        if not s:
                            continue
                        words = _status_words(s)
                        if words is None:
                            if has_name(s):  # it tells of something: no message, and no need of a template
                                names = True
                                continue
                            words = masked(s)
                        if words not in says:
                            says[words] = classify(" ".join(words))
                        found.append((tree.add(words) if len(words) <= MAX_WORDS else " ".join(words), says[words]))
                    told += names * (1 if len(sentences) == 1 else MOST_TOLD + 1)
                    for template, kind in {(id(t), kind): (t, kind) for t, kind in found}.values():
                        at.append(i)
                        rows.append((None, template, kind, not names))
                bare[i] = told <= MOST_TOLD
            texts = [t if isinstance(t, str) or t is None else " ".join(t) for _, t, *_ in rows]  # as the tree has them in the end
            keys = {t: xxhash.xxh3_64_intdigest("\t".join(map(str, leaf_of(t.split(" ")))).encode("utf-8", "replace")) - (1 << 63) for t in set(texts) if t is not None}
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(where), pa.array([r[0] for r in rows], pa.string()), pa.array(texts, pa.string()), pa.array([keys.get(t) for t in texts], pa.int64()),
                    pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.bool_()), pa.array(bare).take(where),
                    b.column(2).take(where),
                ],
                names=["id", "slot", "template", "leaf", "kind", "own", "bare", "src"],
            )

    ship(df.sparkSession)
    src = F.lower(F.trim(F.col(source_col))) if source_col in df.columns else F.lit(None)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(src, F.lit("")).alias("src"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {_SCAN}")


_STATS = {"kind": pa.string(), "n": pa.int64(), "saying": pa.int64(), "own": pa.int64(), "bare": pa.int64(), "low": pa.string(), "high": pa.string()}
_MERGED = "part string, template string, kind string, n bigint, saying bigint, own bigint, bare bigint, low string, high string"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial templates, the most frequent of a leaf first, with the template of the corpus they belong to."""
    leaf, tree, held = None, TemplateTree(), []

    def out() -> pa.RecordBatch:
        final = [" ".join(t) if isinstance(t, list) else t for _, t, _ in held]
        stats = [pa.array([r[c] for *_, r in held], t) for c, t in _STATS.items()]
        return pa.RecordBatch.from_arrays([pa.array([p for p, *_ in held], pa.string()), pa.array(final, pa.string()), *stats], names=["part", "template", *_STATS])

    for b in batches:
        for r in b.to_pylist():
            if r["leaf"] != leaf:
                leaf, tree = r["leaf"], TemplateTree()
                if len(held) >= 20_000:
                    yield out()
                    held = []
            words = r["template"].split(" ")
            held.append((r["template"], tree.add(tuple(words)) if len(words) <= MAX_WORDS else r["template"], r))
    if held:
        yield out()


def judged(hits: DataFrame, least_own: float = 0.5, least_said: float = 0.5, least_bare: float = 0.9, least_docs: int = 3, least_words: int = 3) -> DataFrame:
    """``part, template, kind, n_docs, own_share, bare_share, sources, residue``: partial templates with the corpus's template and its verdict."""
    parts = hits.where("template is not null").groupBy("leaf", "template").agg(
        F.count("*").alias("n"), F.count("kind").alias("saying"), F.max("kind").alias("kind"), F.count_if("own").alias("own"), F.count_if("bare").alias("bare"), F.min("src").alias("low"), F.max("src").alias("high")
    )
    ordered = parts.repartition("leaf").sortWithinPartitions("leaf", F.desc("n"), "template")
    merged = cut(ordered.select("leaf", "template", *_STATS).mapInArrow(_merge, _MERGED), "templates")
    whole = merged.groupBy("template").agg(
        F.sum("n").alias("n_docs"), F.sum("own").alias("own"), F.sum("bare").alias("bare"), F.sum("saying").alias("saying"), F.max("kind").alias("kind"),
        F.when(F.min("low") < F.max("high"), 2).otherwise(1).alias("sources"),
    )
    own, bare = F.col("own") / F.col("n_docs"), F.col("bare") / F.col("n_docs")
    says = (F.col("saying") >= least_said * F.col("n_docs")) & (own >= least_own)
    words = F.regexp_count("template", F.lit("(^| )[a-z]{2,}"))
    stands = (F.col("n_docs") >= least_docs) & (F.col("sources") > 1) & (bare >= least_bare) & (words >= least_words)
    kind = F.when(stands & ~says, F.lit("page")).otherwise(F.col("kind"))
    return merged.select("part", "template").join(whole.select("template", kind.alias("kind"), "n_docs", own.alias("own_share"), bare.alias("bare_share"), "sources", (says | stands).alias("residue")), "template")


def templates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_own: float = 0.5, **limits) -> DataFrame:
    """``kind, template, n_docs, own_share, bare_share, sources, residue``: each template of the corpus that says what messages say, or
    stands as they do, and its verdict (``sources``: 2 for several)."""
    return judged(scan(df, id_col, text_col), least_own, **limits).where("kind is not null").drop("part").distinct()


def residue(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_own: float = 0.5, **limits) -> DataFrame:
    """``id_col, kinds``: documents with residue, and the kinds of it (sorted)."""
    hits = cut(scan(df, id_col, text_col), "residue")
    bad = judged(hits, least_own, **limits).where("residue").select(F.col("part").alias("template"), "kind")
    held = join_small(hits.where("template is not null").select("id", "template"), bad, "template").select("id", "kind")
    slots = hits.where("slot is not null").select("id", F.lit("slot").alias("kind"))
    return held.union(slots).groupBy("id").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).withColumnRenamed("id", id_col)
