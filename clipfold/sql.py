"""The queries in SQL, for checking. It uses nothing of the code it checks; its values are its own."""

from __future__ import annotations

# Suffixes and domains of the press, countries, platforms, names of characters; at the end of each list of
# domains those of the test tables.
LUSOPHONE = (".ao", ".mz", ".cv", ".st", ".gw", ".tl", ".br")
WRITES_PT = (
    "noticiasaominuto.com", "cnnportugal.iol.pt", "eco.sapo.pt", "sapo.pt", "impresa.pt", "medialivre.pt", "lusa.pt", "novojornal.co.ao",
    "cartamz.com", "agenciabrasil.ebc.com.br", "folha.uol.com.br", "pt.euronews.com", "dw.com", "france24.com", "rfi.fr",
)
NATIONAL = ("noticiasaominuto.com", "theportugalnews.com", "lusa.pt", "cnnportugal.iol.pt", "iol.pt", "eco.sapo.pt", "sapo.pt", "impresa.pt", "medialivre.pt")
PLATFORM_NAMES = (
    "instagram.com", "facebook.com", "fb.com", "x.com", "twitter.com", "tiktok.com", "youtube.com", "youtu.be", "linkedin.com", "reddit.com",
    "threads.net", "threads.com", "bsky.app", "t.me", "telegram.me", "whatsapp.com", "pinterest.com", "tumblr.com", "flipboard.com",
    "medium.com", "substack.com", "blogspot.com", "wordpress.com",
)
PLACES = (
    (".pt", "Portugal"), (".ao", "Angola"), (".mz", "Moçambique"), (".cv", "Cabo Verde"), (".st", "São Tomé e Príncipe"), (".gw", "Guiné-Bissau"),
    (".tl", "Timor-Leste"), (".br", "Brasil"), (".es", "Espanha"), (".fr", "França"), (".it", "Itália"), (".de", "Alemanha"), (".uk", "Reino Unido"),
    (".eu", "União Europeia"),
)
PLACE_OF = {
    "Brasil": ("agenciabrasil.ebc.com.br", "folha.uol.com.br"), "Angola": ("novojornal.co.ao",), "Moçambique": ("cartamz.com",),
    "Espanha": ("elpais.com", "elmundo.es", "abc.es", "lavanguardia.com"), "França": ("lemonde.fr", "lefigaro.fr", "francetvinfo.fr", "france24.com", "rfi.fr"),
    "Itália": ("ansa.it", "corriere.it", "repubblica.it"), "Alemanha": ("spiegel.de", "dw.com"), "Reino Unido": ("bbc.com", "bbc.co.uk", "theguardian.com"),
    "Estados Unidos da América": ("nytimes.com", "washingtonpost.com", "apnews.com", "politico.com"), "União Europeia": ("politico.eu", "euractiv.com", "pt.euronews.com"),
}
TEST_NATIONAL = ("folhadozambril.com", "minutomarvento.com")
TEST_PT = ("pt.kelbrandtwelle.de",)
TEST_PLATFORMS = ("camporegadioxisto.pt",)
TEST_PLACES = {"Portugal": TEST_NATIONAL, "Reino Unido": ("dunhallowpost.com",), "Espanha": ("diariovaldemorca.com",)}
#: Names of the characters from U+00A0 on, and of some others.
LATIN = (
    "nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr deg plusmn sup2 sup3 acute micro para middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest "
    "Agrave Aacute Acirc Atilde Auml Aring AElig Ccedil Egrave Eacute Ecirc Euml Igrave Iacute Icirc Iuml ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash Ugrave Uacute Ucirc Uuml Yacute THORN szlig "
    "agrave aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml igrave iacute icirc iuml eth ntilde ograve oacute ocirc otilde ouml divide oslash ugrave uacute ucirc uuml yacute thorn yuml"
).split()
OTHERS = {"quot": 34, "amp": 38, "apos": 39, "lt": 60, "gt": 62, "ndash": 8211, "mdash": 8212, "lsquo": 8216, "rsquo": 8217, "ldquo": 8220, "rdquo": 8221, "hellip": 8230, "euro": 8364}

AS_OF = "TIMESTAMP '2018-03-20 12:00:00'"
ITEMS = """it AS (
  SELECT item_id, run_ord, feed_ord, coalesce(area, '') AS area, coalesce(grupo, '') AS grupo,
    CASE WHEN regexp_full_match(data, '\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d') THEN try_strptime(data, '%Y-%m-%d %H:%M') END AS ts,
    coalesce(fonte, '') AS fonte, coalesce(dominio, '') AS dominio, coalesce(titulo, '') AS titulo, coalesce(resumo, '') AS resumo,
    coalesce(ligacao, '') AS ligacao, coalesce(palavras, []) AS palavras, coalesce(imagem, '') AS imagem
  FROM arquivo)"""
ORD = "{'r': run_ord, 'f': feed_ord, 'i': item_id}"


def fold(x: str) -> str:
    return f"regexp_replace(strip_accents(lower({x})), '[^\\x00-\\x7F]', '', 'g')"


def dom(x: str = "dominio") -> str:
    return f"replace(lower({x}), 'www.', '')"


def ends(d: str, suffixes) -> str:
    return "(" + " OR ".join(f"ends_with({d}, '{s}')" for s in suffixes) + ")"


def under(d: str, names) -> str:
    return "(" + " OR ".join(f"{d} = '{n}' OR ends_with({d}, '.{n}')" for n in names) + ")"


def origin(x: str = "dominio", more=TEST_NATIONAL) -> str:
    d = dom(x)
    return f"CASE WHEN {d} = '' OR ends_with({d}, '.pt') OR {under(d, NATIONAL + more)} THEN 'nacionais' WHEN {ends(d, LUSOPHONE)} THEN 'lusofonas' ELSE 'internacionais' END"


def portuguese(x: str = "dominio", more=TEST_NATIONAL + TEST_PT) -> str:
    d = dom(x)
    return f"({d} = '' OR ends_with({d}, '.pt') OR {ends(d, LUSOPHONE)} OR {under(d, WRITES_PT + more)})"


def country(x: str = "dominio", more=tuple(TEST_PLACES.items())) -> str:
    d = dom(x)
    whole = " ".join(f"WHEN {d} IN ({', '.join(map(repr, names))}) THEN '{c}'" for c, names in (*PLACE_OF.items(), *more))
    cases = " ".join(f"WHEN ends_with({d}, '{s}') THEN '{c}'" for s, c in PLACES)
    return f"CASE {whole} {cases} ELSE '' END"


SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def unescape(x: str) -> str:
    """Each piece after an ampersand: a number, a known name, or as it is."""
    number = "regexp_extract(p, '^#([0-9]+);?', 1)"
    hexed = "regexp_extract(p, '^#[xX]([0-9a-fA-F]+);?', 1)"
    name = "regexp_extract(p, '^([A-Za-z0-9]+);', 1)"
    names = "[" + ", ".join(f"'{n}'" for n in [*LATIN, *OTHERS]) + "]"
    codes = "[" + ", ".join(map(str, [*range(160, 160 + len(LATIN)), *OTHERS.values()])) + "]"
    piece = f"""CASE WHEN {number} <> '' THEN chr({number}::INTEGER) || regexp_replace(p, '^#[0-9]+;?', '') WHEN {hexed} <> '' THEN chr(('0x' || {hexed})::INTEGER) || regexp_replace(p, '^#[xX][0-9a-fA-F]+;?', '')
        WHEN list_contains({names}, {name}) THEN chr({codes}[list_position({names}, {name})]) || substr(p, length({name}) + 2) ELSE '&' || p END"""
    return f"(string_split({x}, '&')[1] || list_aggregate(list_concat([''], list_transform(string_split({x}, '&')[2:], lambda p: {piece})), 'string_agg', ''))"


def clean(x: str) -> str:
    tagless = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    return f"trim(regexp_replace({unescape(tagless)}, '{SPACE}', ' ', 'g'))"


def plausible(u: str) -> str:
    foreign = ("google.com", "google.pt", "gstatic.com", "googleusercontent.com", "googleapis.com", "policies.google", "accounts.google", "consent.google")
    return f"(regexp_matches({u}, '(?i)^https?://') AND length({u}) >= 24 AND NOT regexp_matches({u}, '(?i)\\.(png|jpe?g|gif|webp|svg|ico|bmp)(\\?|#|$)') AND NOT (" + " OR ".join(f"contains({u}, '{n}')" for n in foreign) + "))"


def shorten(x: str) -> str:
    return f"CASE WHEN length({x}) > 190 THEN regexp_replace(left({x}, 190), ' [^ ]*$', '') || '…' ELSE {x} END"


def escape(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


MONTHS = "['janeiro','fevereiro','março','abril','maio','junho','julho','agosto','setembro','outubro','novembro','dezembro']"
LONG = f"concat_ws(' de ', day(ts), {MONTHS}[month(ts)], year(ts))"
LABEL = f"CASE WHEN ts IS NULL THEN 'Sem data' WHEN ts::DATE = DATE '2018-03-20' THEN 'Hoje' ELSE concat_ws(' de ', day(ts), {MONTHS}[month(ts)]) END"
BARE = "trim(regexp_replace(lower({}), '[^a-z0-9áàâãéêíóôõúç ]', '', 'g'))"
SUBS = """s AS (SELECT DISTINCT area, lower(trim(email)) AS email FROM subs
  WHERE coalesce(area, '') <> '' AND regexp_full_match(lower(trim(email)), '[^@\\s,;<>]+@[^@\\s,;<>]+\\.[A-Za-z]{2,}'))"""
LOCAL = "split_part(email, '@', 1)"
SHOWN = f"(CASE WHEN length({LOCAL}) > 4 THEN 3 ELSE 1 END)"
MASK = f"left({LOCAL}, {SHOWN}) || repeat('*', greatest(3, length({LOCAL}) - {SHOWN})::BIGINT) || '@' || split_part(email, '@', 2)"
HIGH = "coalesce(ts >= {} - INTERVAL {} HOUR, {})"
PLATFORM = under(dom(), PLATFORM_NAMES + TEST_PLATFORMS)
ACR = "(upper(o) = o AND lower(o) <> o AND length(o) <= 8)"
FORMS = """CASE WHEN w LIKE '%oes' THEN left(w, length(w) - 3) || 'ao' WHEN w LIKE '%ao' THEN left(w, length(w) - 2) || 'oes'
  WHEN w LIKE '%ais' THEN left(w, length(w) - 3) || 'al' WHEN w LIKE '%al' THEN left(w, length(w) - 2) || 'ais'
  WHEN w LIKE '%eis' THEN left(w, length(w) - 3) || 'el' WHEN w LIKE '%el' THEN left(w, length(w) - 2) || 'eis'
  WHEN w LIKE '%res' THEN left(w, length(w) - 2) WHEN w LIKE '%r' THEN w || 'es' WHEN w LIKE '%s' THEN left(w, length(w) - 1) ELSE w || 's' END"""
RULES = f"""words AS (
  SELECT area_id, phrase, kind, ord, unnest(string_split(phrase, ' ')) AS o, unnest(range(len(string_split(phrase, ' ')))) AS k FROM {{rules}}),
parts AS (
  SELECT area_id, phrase, kind, ord, k, CASE WHEN {ACR} THEN o END AS acr,
    CASE WHEN {ACR} THEN '(?:' || w || ')' ELSE '(?:' || w || e || '|' || {FORMS} || e || ')' END AS p
  FROM (SELECT *, {fold("o")} AS w, CASE WHEN length({fold("o")}) >= 6 THEN '\\w{{{{0,3}}}}' ELSE '' END AS e FROM words)),
pats AS (
  SELECT area_id, phrase, kind, ord, '(^|\\W)' || string_agg(p, '\\s+' ORDER BY k) || '(\\W|$)' AS pat,
    coalesce(max('(^|[^\\p{{{{L}}}}\\p{{{{N}}}}_])' || acr || '([^\\p{{{{L}}}}\\p{{{{N}}}}_]|$)'), '') AS acr
  FROM parts GROUP BY ALL)"""


def hits(texts: str, id_col: str, rules: str = "rules") -> str:
    return f"""{RULES.format(rules=rules)}, tx AS ({texts}),
ft AS (SELECT {id_col}, t, {fold("t")} AS f FROM tx),
hit AS (SELECT {id_col}, area_id, phrase, kind FROM ft JOIN pats ON regexp_matches(f, pat) AND (acr = '' OR regexp_matches(t, acr)))"""


def classified(id_col: str) -> str:
    return f"cl AS (SELECT {id_col}, area_id, list_sort(list(DISTINCT phrase) FILTER (kind = 'keyword')) AS palavras FROM hit GROUP BY {id_col}, area_id HAVING count(*) FILTER (kind = 'exclude') = 0 AND count(*) FILTER (kind = 'keyword') > 0)"


TEXT = f"SELECT item_id, dominio, titulo || ' ' || resumo AS t FROM it"
DAILY = f"""daily AS (SELECT ts::DATE AS data, area, count(*) AS noticias, count(DISTINCT nullif(fonte, '')) AS fontes,
  count(*) FILTER ({origin()} = 'nacionais') AS nacionais, count(*) FILTER ({origin()} = 'lusofonas') AS lusofonas, count(*) FILTER ({origin()} = 'internacionais') AS internacionais
  FROM it WHERE ts IS NOT NULL AND area <> '' GROUP BY 1, 2)"""
KEYWORDS = "kw AS (SELECT ts::DATE AS data, area, unnest(list_distinct(palavras)) AS palavra FROM it WHERE ts IS NOT NULL AND area <> ''), dk AS (SELECT data, area, palavra, count(*) AS noticias FROM kw GROUP BY ALL)"
PERIODS = {
    "day": ("data", "INTERVAL 1 DAY", "p"),
    "week": ("date_trunc('week', data)::DATE", "INTERVAL 7 DAY", "(p + INTERVAL 6 DAY)::DATE"),
    "month": ("date_trunc('month', data)::DATE", "INTERVAL 1 MONTH", "last_day(p)"),
    "quarter": ("date_trunc('quarter', data)::DATE", "INTERVAL 3 MONTH", "last_day((p + INTERVAL 2 MONTH)::DATE)"),
    "year": ("date_trunc('year', data)::DATE", "INTERVAL 1 YEAR", "make_date(year(p), 12, 31)"),
}


def resampled(src: str, key: str, values: list[str], by: str) -> str:
    start, step, end = PERIODS[by]
    sums = ", ".join(f"sum({v})::BIGINT AS {v}" for v in values)
    out = ", ".join(f"coalesce({v}, 0)::BIGINT AS {v}" for v in values)
    return f"""sums AS (SELECT {key}, {start} AS p, {sums} FROM {src} GROUP BY ALL),
grid AS (SELECT {key}, unnest(generate_series(min(p)::TIMESTAMP, max(p)::TIMESTAMP, {step}))::DATE AS p FROM sums GROUP BY {key})
SELECT {end} AS periodo, {key}, {out} FROM grid LEFT JOIN sums USING ({key}, p)"""


def filled_in(key: str, fields: list[str], o: str, keep: list[str], where: str = "TRUE", keywords: bool = False) -> str:
    parts = [f"arg_min({c}, {o}) AS {c}" for c in keep] + [f"coalesce(arg_min({f}, {o}) FILTER ({f} <> ''), '') AS {f}" for f in fields]
    if keywords:
        parts.append("list_sort(list_distinct(flatten(list(palavras)))) AS palavras")
    return f"WITH {ITEMS}, g AS (SELECT {', '.join(parts)} FROM it WHERE {where} GROUP BY {key}) SELECT * FROM g"


DAMAGED = "(contains(titulo || resumo || fonte, chr(65533)) OR (ligacao <> '' AND NOT starts_with(ligacao, 'http')))"
RETAINED = "coalesce(ts::DATE >= DATE '2018-03-13', FALSE)"
NEW_ORD = "{'r': -run_ord, 'f': feed_ord, 'i': item_id}"
ROWS = f"ROW_NUMBER() OVER (PARTITION BY {{}} ORDER BY ts DESC NULLS {{}}, run_ord, feed_ord, item_id)"
TAIL = r"regexp_extract(titulo, '(?s)^(.*) - (.*)$', 2)"
HEAD = r"regexp_extract(titulo, '(?s)^(.*) - (.*)$', 1)"
HAS = f"(contains(titulo, ' - ') AND {TAIL} <> '')"


def items(select: str) -> str:
    return f"WITH {ITEMS} SELECT {select} FROM it"


def plural(n: str, one: str, many: str) -> str:
    return f"({n} || CASE WHEN {n} = 1 THEN ' {one}' ELSE ' {many}' END)"


def unless_title(x: str, title: str = "titulo") -> str:
    return f"CASE WHEN starts_with({BARE.format(x)}, left({BARE.format(title)}, 45)) THEN '' ELSE {x} END"


def mail_time(shift: str) -> str:
    return f"CASE WHEN ts IS NOT NULL THEN least(timezone('Europe/Lisbon', timezone('UTC', ts {shift})), {AS_OF}) END"


def safe(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '(?i)^https?://') THEN {x} ELSE '' END"


LABEL_OF = f"CASE {origin()} WHEN 'nacionais' THEN 'Portugal' WHEN 'lusofonas' THEN 'Lusofonia' ELSE 'Internacional' END"
ITEM_HTML = f"""'<tr><td>' || coalesce(strftime(ts, '%H:%M'), '—') || '</td>' || CASE WHEN {safe('imagem')} <> '' THEN '<td><img src="' || {escape('imagem')} || '"></td>' ELSE '' END
  || '<td><a href="' || CASE WHEN {safe('ligacao')} <> '' THEN {escape('ligacao')} ELSE '#' END || '">' || {escape('titulo')} || '</a>'
  || CASE WHEN resumo <> '' THEN '<p>' || {escape(shorten('resumo'))} || '</p>' ELSE '' END || '<small>' || {escape('fonte')} || ' · ' || {LABEL_OF} || '</small></td></tr>'"""
NL = "chr(10)"
ITEM_TEXT = f"""'[' || coalesce(strftime(ts, '%H:%M'), '--:--') || '] ' || titulo || CASE WHEN resumo <> '' THEN {NL} || '        ' || left(resumo, 150) ELSE '' END
  || {NL} || '        ' || fonte || ' · ' || {LABEL_OF} || CASE WHEN {safe('ligacao')} <> '' THEN {NL} || '        ' || ligacao ELSE '' END || {NL}"""
#: Groups with their paragraphs, made of the titles of the newest five items; and as rows of syntheses.
GROUPS = f"""o AS (SELECT *, {origin()} AS origem FROM it WHERE area <> '' AND titulo <> ''), c AS (SELECT area, origem, count(*) AS noticias FROM o GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY area, origem ORDER BY ts DESC NULLS LAST, run_ord, feed_ord, item_id) AS n FROM o)"""
PARAGRAPHS = f"""{GROUPS}, t AS (SELECT area, origem, trim(area || ' (' || origem || '): ' || string_agg(titulo, '; ' ORDER BY n) || '.') AS texto FROM r WHERE n <= {{k}} GROUP BY 1, 2),
  p AS (SELECT area, origem, noticias, texto FROM t JOIN c USING (area, origem) WHERE noticias >= 3 AND length(texto) >= 40)"""
WRITTEN = f"""{PARAGRAPHS.format(k=3)},
  old AS (SELECT DISTINCT area FROM p),
  block AS (SELECT old.area,
      '<h3>Síntese · escrita às 07:30</h3>' || coalesce(string_agg('<h4>' || l || ' · ' || {plural('noticias', 'notícia', 'notícias')} || '</h4><p>' || {escape('texto')} || '</p>', '' ORDER BY k), '<p>Um só texto &lt;antigo&gt;</p>') AS sh,
      'Síntese · escrita às 07:30' || {NL} || coalesce(string_agg('[' || upper(l) || '] ' || {plural('noticias', 'notícia', 'notícias')} || {NL} || texto || {NL}, {NL} ORDER BY k), 'Um só texto <antigo>' || {NL}) AS st
    FROM old LEFT JOIN (SELECT *, CASE origem WHEN 'nacionais' THEN 1 WHEN 'lusofonas' THEN 2 ELSE 3 END AS k, CASE origem WHEN 'nacionais' THEN 'Portugal' WHEN 'lusofonas' THEN 'Lusofonia' ELSE 'Internacional' END AS l FROM p WHERE area < 'J') q ON q.area = old.area
    GROUP BY old.area)"""
DOCUMENTS = f"""WITH {ITEMS}, {WRITTEN},
  s AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY ts DESC NULLS FIRST, run_ord, feed_ord, item_id) AS pos FROM it WHERE area <> ''),
  counts AS (SELECT area, count(*) AS noticias, count(DISTINCT coalesce(nullif(fonte, ''), 'sem indicação')) AS fontes, arg_min(grupo, {ORD}) AS grupo FROM s GROUP BY area),
  days AS (SELECT area, ts::DATE AS dia, count(*) AS do_dia, any_value({LABEL}) AS rotulo FROM s GROUP BY 1, 2),
  g AS (SELECT area, ts::DATE AS dia, min(pos) AS pos, string_agg({ITEM_HTML}, '' ORDER BY pos) AS h, string_agg({ITEM_TEXT}, {NL} ORDER BY pos) AS t FROM s WHERE pos <= 12 GROUP BY 1, 2),
  body AS (SELECT g.area, string_agg('<tr><th colspan="3">' || rotulo || ' · ' || do_dia || '</th></tr>' || h, '' ORDER BY pos) AS h, string_agg(t, {NL} ORDER BY pos) AS t
    FROM g JOIN days ON g.area = days.area AND g.dia IS NOT DISTINCT FROM days.dia GROUP BY g.area)
  SELECT area, noticias, fontes,
    '<section style="border-color:' || CASE grupo WHEN 'Redes e território' THEN '#0e7433' WHEN 'Casa comum' THEN '#be9c54' ELSE '#1f3a5f' END || '"><h2>' || {escape('area')} || '</h2><p>' || {plural('noticias', 'notícia', 'notícias')} || ' · ' || {plural('fontes', 'publicação', 'publicações')} || '</p>'
      || coalesce(sh, '') || '<table>' || h || '</table><p><a href="https://painel.example/?a=1&amp;b=2">Abrir o painel</a></p></section>' AS html,
    concat_ws({NL}, upper(area), {plural('noticias', 'notícia', 'notícias')}, '', st, t, 'Abrir o painel: https://painel.example/?a=1&b=2') AS texto
  FROM counts JOIN body USING (area) LEFT JOIN block USING (area)"""
EACH = f"""WITH {ITEMS}, {GROUPS}, t AS (SELECT area, origem, string_agg(titulo, '; ' ORDER BY n) AS x, count(*) AS k FROM r WHERE n <= 5 GROUP BY 1, 2),
  e AS (SELECT area, origem, noticias, CASE WHEN k > 3 THEN trim(x) ELSE 'curto' END AS x, CASE WHEN noticias < 20 THEN 'poucas' WHEN origem = 'lusofonas' THEN 'falhou' WHEN length(CASE WHEN k > 3 THEN trim(x) ELSE 'curto' END) < 40 THEN 'curta' ELSE 'escrita' END AS estado
    FROM t JOIN c USING (area, origem))"""


def confirmation(rows: str, subject: str, body: str, panel: str = "") -> str:
    made = "Registado em 20/03/2018 às 12:00."
    n = plural("len(a)", "área", "áreas")
    line = f", 'Painel: {panel}'" if panel else ""
    link = f'<p><a href="{panel}">Abrir o painel</a></p>' if panel else ""
    item = escape("x")
    return f"""WITH {SUBS}, ch AS ({rows}), g AS (SELECT email, list_sort(list(DISTINCT area)) AS a FROM ch GROUP BY email)
      SELECT email, {MASK} AS para, '{subject}' AS assunto,
        concat_ws({NL}, '{subject.upper()}', '', '{body}', '', {n} || ':', array_to_string(list_transform(a, lambda x: '  - ' || x), {NL}){line}, '{made}') AS texto,
        '<h1>{subject}</h1><p>{body}</p><h2>' || {n} || '</h2><ul>' || array_to_string(list_transform(a, lambda x: '<li>' || {item} || '</li>'), '') || '</ul>{link}<p><small>{made}</small></p>' AS html FROM g"""


ADDED = "SELECT DISTINCT '{}' AS area, lower(trim(email)) AS email FROM subs WHERE regexp_full_match(lower(trim(email)), '[^@\\s,;<>]+@[^@\\s,;<>]+\\.[A-Za-z]{{2,}}')"
#: The query string of each area's search.
SEARCH = """q AS (SELECT area_id, '(' || string_agg('"' || phrase || '"', ' OR ' ORDER BY ord, phrase) FILTER (kind = 'keyword') || ')'
  || coalesce(' ' || string_agg('-"' || phrase || '"', ' ' ORDER BY ord, phrase) FILTER (kind = 'exclude'), '') || ' -site:.br -site:globo.com when:7d' AS consulta FROM rules GROUP BY area_id)"""
PARSED_TITLE = clean("CASE f WHEN 0 THEN t || CASE WHEN s <> '' THEN ' - ' || s ELSE '' END WHEN 1 THEN t ELSE t || ' ção' END")
_REST = r"regexp_extract(pt, '(?s)^(.*) - (.*)$', {})"
_HAS = f"(contains(pt, ' - ') AND {_REST.format(2)} <> '')"
_KNOWN = f"(ps = '' OR lower({_REST.format(2)}) = lower(ps))"
HELD = "CASE run_ord % 3 WHEN 0 THEN regexp_replace({x}, '[\\x{{00}}]', '', 'g') WHEN 1 THEN regexp_replace({x}, '[^\\x{{09}}-\\x{{ff}}]|[\\x{{7f}}-\\x{{9f}}]', '', 'g') ELSE regexp_replace({x}, '[^\\x{{09}}-\\x{{7e}}]', '', 'g') END"
INGESTED = f"""WITH {ITEMS}, h AS (SELECT item_id, run_ord * 1000 + feed_ord AS k, feed_ord AS fo, run_ord % 3 AS f, ts, dominio, ligacao, imagem, {HELD.format(x='titulo')} AS t, {HELD.format(x='resumo')} AS r, {HELD.format(x='fonte')} AS s FROM it),
  p AS (SELECT *, {PARSED_TITLE} AS pt, CASE WHEN f = 0 AND dominio <> '' THEN {clean('s')} ELSE '' END AS ps, CASE WHEN f = 0 THEN dominio ELSE '' END AS pd, {clean("CASE f WHEN 1 THEN '<img> ' || r ELSE r END")} AS pr,
      row_number() OVER (PARTITION BY k ORDER BY item_id) AS ord FROM h),
  u AS (SELECT *, CASE WHEN {_HAS} AND {_KNOWN} THEN {_REST.format(1)} ELSE pt END AS ft, CASE WHEN {_HAS} AND ps = '' THEN {_REST.format(2)} ELSE ps END AS fs FROM p)
  SELECT k AS feed_ord, ord AS item_ord, CASE f WHEN 0 THEN {mail_time('- INTERVAL 3 HOUR')} WHEN 2 THEN {mail_time('')} END AS ts, coalesce(nullif(fs, ''), source, '') AS fonte, coalesce(nullif(pd, ''), domain, '') AS dominio, ft AS titulo, {unless_title('pr', 'ft')} AS resumo,
    CASE WHEN starts_with(trim(ligacao), 'http') THEN trim(ligacao) ELSE '' END AS ligacao, CASE WHEN f <= 1 AND starts_with(trim(imagem), 'http') THEN trim(imagem) ELSE '' END AS imagem
  FROM u LEFT JOIN feeds ON fo = feeds.feed_ord"""
PLAIN = "area, grupo, coalesce(strftime(ts, '%Y-%m-%d %H:%M'), NULL) AS data, fonte, dominio, titulo, resumo, ligacao, palavras, imagem"


MARKED = "titulo || '<p class=''x''>Educa&ccedil;&atilde;o &#233; &#xE9;&nbsp;&hellip; &amp;lt; R&D &desconhecida; &euro;5</p>'"
REPEATED = "('— ' || titulo || '. ' || fonte)"
MANIFEST = f"""WITH {ITEMS}@CTES@, n AS (SELECT area, count(*) AS noticias, regexp_replace(regexp_replace({fold('area')}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS f FROM @SOURCE@ GROUP BY area)
  SELECT area, f || '.html' AS ficheiro, f || '.txt' AS texto, area || ' · 20 de março · ' || {plural('noticias', 'notícia', 'notícias')} AS assunto, noticias FROM n"""
NAMED = sorted({*WRITES_PT, *NATIONAL, *PLATFORM_NAMES, *(n for names in PLACE_OF.values() for n in names)})
IN_WINDOW = f"ts >= {AS_OF} - INTERVAL 48 HOUR AND NOT {PLATFORM}"
SUBSCRIBED = f"it WHERE area <> '' AND coalesce(ts >= {AS_OF} - INTERVAL 168 HOUR, TRUE) AND NOT {PLATFORM} AND {origin()} IN ('nacionais', 'lusofonas') AND ((SELECT count(*) FROM s) = 0 OR area IN (SELECT area FROM s))"
SHEET_CELLS = "SELECT {} AS linha, {} AS coluna, {} AS valor"

SQL = {
    "fold_text": items(f"item_id, {fold('titulo')} AS dobrado"),
    "clean_html": items(f"item_id, {clean('resumo')} AS limpo, {clean(MARKED)} AS com_marcas"),
    "split_source_suffix": items(f"item_id, CASE WHEN {HAS} AND (fonte = '' OR lower({TAIL}) = lower(fonte)) THEN {HEAD} ELSE titulo END AS titulo, CASE WHEN {HAS} AND fonte = '' THEN {TAIL} ELSE fonte END AS fonte"),
    "summary_is_title": items(f"item_id, {unless_title('resumo')} AS resumo, {unless_title(REPEATED)} AS repetido"),
    "rfc_date": items(f"item_id, {mail_time('- INTERVAL 2 HOUR')} AS lisboa, {mail_time('+ INTERVAL 330 MINUTE')} AS oeste, {mail_time('')} AS gmt, CASE WHEN ts IS NOT NULL THEN least(ts, {AS_OF}) END AS sem_zona"),
    "url_checks": items(f"item_id, {plausible('ligacao')} AS plausivel, FALSE AS alheia, TRUE AS no_caminho, {plausible('upper(ligacao)')} AS maiuscula, {safe('ligacao')} AS segura, regexp_extract(ligacao, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS anfitriao, {dom()} AS dominio"),
    "redirect_target": f"WITH {ITEMS}, x AS (SELECT item_id, list_filter(regexp_extract_all('https://lh3.googleusercontent.com/imagem-de-todos ' || ligacao || chr(34), 'https?://[A-Za-z0-9\\-._~:/?#\\[\\]@!$&''()*+,;=%]{{20,}}'), lambda u: {plausible('u')})[1] AS destino FROM it) SELECT item_id, destino IS NULL AS fica, destino, TRUE AS outra_fica FROM x",
    "escaped_html": items(f"item_id, {escape('resumo')} AS html"),
    "truncation": items(f"item_id, {shorten('resumo')} AS curto, left(resumo, 240) AS fixo"),
    "date_labels": items(f"item_id, {LABEL} AS rotulo, CASE WHEN ts IS NULL THEN '' ELSE {LONG} END AS longa"),
    "report_calendar": items("item_id, CASE WHEN isodow(ts) = 1 THEN 72 ELSE 24 END AS horas, (ts::DATE + CASE WHEN ts IS NULL THEN NULL WHEN isodow(ts) <= 5 AND hour(ts) < 10 THEN 0 WHEN isodow(ts) < 5 THEN 1 ELSE 8 - isodow(ts) END::INTEGER)::DATE AS recebe"),
    "masked_addresses": f"WITH {SUBS} SELECT area, {MASK} AS mascara FROM s",
    "slug_and_tier": f"WITH {ITEMS}, n AS (SELECT area, count(*) AS n FROM it GROUP BY area) SELECT area, regexp_replace(regexp_replace({fold('area')}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS nome, CASE WHEN coalesce(n, 0) >= 40 THEN 'long' WHEN coalesce(n, 0) >= 15 THEN 'medium' ELSE 'short' END AS escalao FROM areas LEFT JOIN n USING (area)",
    "resolve_area": f"WITH a AS (SELECT area, row_number() OVER (ORDER BY area_id) AS ord FROM areas), t AS (SELECT DISTINCT unnest([split_part(area, ' ', 1), upper(area)]) AS term FROM a) SELECT term, arg_min(area, {{'x': {fold('area')} <> {fold('term')}, 'o': ord}}) AS area FROM t JOIN a ON contains({fold('area')}, {fold('term')}) GROUP BY term",
    "select_areas": f"SELECT area FROM areas WHERE contains({fold('area')}, 'lotas') OR contains({fold('area')}, 'aguas')",
    "damaged_rows": items(f"item_id, {DAMAGED} AS estragado"),
    "registry_fallback": f"WITH {ITEMS} SELECT item_id, coalesce(nullif(fonte, ''), source, '') AS fonte, coalesce(nullif(dominio, ''), domain, '') AS dominio FROM it LEFT JOIN feeds USING (feed_ord)",
    "title_line": items(f"item_id, titulo || ' (' || concat_ws(' · ', coalesce(nullif(fonte, ''), 'fonte desconhecida'), nullif({country()}, '')) || ')' AS linha"),
    "classify_keywords": f"WITH {ITEMS}, {hits(TEXT, 'item_id')} SELECT * FROM hit",
    "classify_areas": f"WITH {ITEMS}, {hits(TEXT + ' WHERE ' + portuguese(), 'item_id')}, {classified('item_id')} SELECT item_id, area, grupo, palavras FROM cl JOIN areas USING (area_id) JOIN grupos USING (group_id)",
    "keyword_search": f"WITH {ITEMS}, one AS (SELECT 'pesquisa' AS area_id, 'ponte velha' AS phrase, 'keyword' AS kind, 1 AS ord), {hits(TEXT, 'item_id', 'one')} SELECT item_id FROM hit",
    "classify_documents": f"WITH {hits('SELECT doc_id, coalesce(text, chr(32)) AS t FROM documents', 'doc_id')}, {classified('doc_id')} SELECT * FROM cl",
    "classify_by_hits": f"WITH {ITEMS}, {hits(TEXT, 'item_id')}, {classified('item_id')} SELECT * FROM cl",
    "language_gate": items(f"item_id, {portuguese()} AS portugues"),
    "origin_class": items(f"item_id, {origin()} AS origem"),
    "source_country": items(f"item_id, {country()} AS pais"),
    "platform_excluded": items("item_id") + f" WHERE NOT {PLATFORM}",
    "report_filter": items("item_id") + f" WHERE {HIGH.format(AS_OF, 72, 'TRUE')} AND NOT {PLATFORM} AND {origin()} IN ('nacionais', 'lusofonas')",
    "synthesis_filter": items("item_id") + f" WHERE {HIGH.format(AS_OF, 72, 'FALSE')} AND NOT {PLATFORM}",
    "collection_window": items("item_id") + f" WHERE {HIGH.format(AS_OF, 168, 'TRUE')}",
    "retention_window": items("item_id") + f" WHERE {RETAINED}",
    "published_on_day": items("item_id") + " WHERE ts::DATE = DATE '2018-03-20'",
    "synthesis_fresh": items(f"item_id, coalesce(date_diff('second', ts, {AS_OF}) <= 28800, FALSE) AS fresca"),
    "minimum_support": f"WITH {ITEMS} SELECT area, {origin()} AS origem, count(*) AS noticias FROM it WHERE area <> '' GROUP BY 1, 2 HAVING count(*) >= 3",
    "once_per_day": items("item_id, coalesce(isodow(ts) <= 5 AND hour(ts) BETWEEN 8 AND 12 AND ts::DATE <> DATE '2018-03-20', FALSE) AS devido"),
    "subscription_gate": f"WITH {ITEMS}, {SUBS} SELECT DISTINCT area FROM it WHERE area <> '' AND ((SELECT count(*) FROM s) = 0 OR area IN (SELECT area FROM s))",
    "area_groups": "SELECT area_id, area, grupo FROM areas JOIN grupos USING (group_id)",
    "resolve_links": items("item_id, regexp_replace(ligacao, '[?#].*$', '') AS ligacao"),
    "area_subscribers": f"WITH {SUBS} SELECT areas.area, count(email) AS enderecos FROM areas LEFT JOIN s USING (area) GROUP BY 1",
    "zero_fill_counts": f"WITH {ITEMS} SELECT areas.area, count(item_id) AS noticias FROM areas LEFT JOIN it USING (area) GROUP BY 1",
    "new_since_last": f"WITH {ITEMS}, m AS (SELECT max(run_ord) AS r FROM it WHERE ligacao <> '') SELECT item_id FROM it n, m WHERE ligacao <> '' AND run_ord = r AND NOT EXISTS (SELECT 1 FROM it o WHERE o.run_ord < r AND o.ligacao = n.ligacao AND o.area = n.area)",
    "first_wins_title": f"WITH {ITEMS} SELECT arg_min(item_id, {ORD}) AS item_id FROM it WHERE titulo <> '' GROUP BY lower(titulo)",
    "first_wins_link": f"WITH {ITEMS} SELECT arg_min(item_id, {ORD}) AS item_id FROM it GROUP BY area, ligacao",
    "union_keywords": f"WITH {ITEMS} SELECT arg_min(item_id, {ORD}) AS item_id, list_sort(list_distinct(flatten(list(palavras)))) AS palavras FROM it GROUP BY area, lower(titulo)",
    "union_keywords_source": f"WITH {ITEMS} SELECT arg_min(item_id, {ORD}) AS item_id, list_sort(list_distinct(flatten(list(palavras)))) AS palavras FROM it GROUP BY area, lower(titulo), lower(fonte)",
    "fill_missing_archive": filled_in("area, lower(titulo), lower(fonte)", ["resumo", "imagem", "ligacao", "dominio", "grupo"], ORD, ["item_id", "titulo", "fonte"], keywords=True),
    "fill_missing_corpus": filled_in("lower(titulo)", ["resumo", "imagem", "ligacao", "dominio"], NEW_ORD, ["item_id", "titulo"]),
    "append_new_only": f"WITH {ITEMS}, m AS (SELECT *, strftime(ts, '%Y-%m') AS mes FROM it WHERE ts IS NOT NULL) SELECT item_id, mes FROM m n WHERE run_ord > 5 AND NOT EXISTS (SELECT 1 FROM m o WHERE o.run_ord <= 5 AND o.mes = n.mes AND o.area = n.area AND lower(o.titulo) = lower(n.titulo))",
    "retained_merge": filled_in("area, lower(titulo), lower(fonte)", ["resumo"], ORD, ["item_id"], f"{RETAINED} AND NOT {DAMAGED}", True),
    "daily_by_area": f"WITH {ITEMS}, {DAILY} SELECT * FROM daily",
    "keyword_counts": f"WITH {ITEMS}, {KEYWORDS} SELECT * FROM dk",
    "upsert_day": f"WITH {ITEMS}, {DAILY} SELECT data, area, CASE WHEN data = DATE '2018-03-20' THEN 0 ELSE noticias END AS noticias FROM daily",
    "series_long_area": f"WITH {ITEMS}, {DAILY} SELECT * FROM daily",
    "series_long_keyword": f"WITH {ITEMS}, {KEYWORDS} SELECT * FROM dk",
    **{f"resample_{by}": f"WITH {ITEMS}, {DAILY}, {resampled('daily', 'area', ['noticias', 'fontes'], by)}" for by in PERIODS},
    "resample_orders": f"WITH o AS (SELECT o_orderdate::DATE AS data, o_orderstatus, 1 AS pedidos FROM orders), {resampled('o', 'o_orderstatus', ['pedidos'], 'quarter')}",
    "origin_share": f"WITH {ITEMS}, {DAILY} SELECT count(*) AS linhas, count(DISTINCT area) AS areas, min(data) AS de, max(data) AS ate, sum(noticias)::BIGINT AS noticias, " + ", ".join(f"round(100.0 * sum({o})::DOUBLE / greatest(sum(noticias), 1)::DOUBLE, 4) AS pct_{o}" for o in ("nacionais", "lusofonas", "internacionais")) + " FROM daily",
    "top_sources": f"WITH {ITEMS} SELECT coalesce(nullif(fonte, ''), 'sem indicação') AS valor, count(*) AS n FROM it GROUP BY 1 ORDER BY n DESC, min(item_id) LIMIT 15",
    "group_by_day": f"WITH {ITEMS} SELECT area, ts::DATE AS dia, count(*) AS noticias, count(DISTINCT coalesce(nullif(fonte, ''), 'sem indicação')) AS fontes FROM it WHERE area <> '' GROUP BY 1, 2",
    "addresses": f"WITH {SUBS} SELECT email, count(*) AS areas FROM s GROUP BY 1",
    "merge_partials": f"WITH {ITEMS}, p AS (SELECT area, run_ord, count(*) AS noticias, max(ts) AS gerado FROM it GROUP BY 1, 2) SELECT area, max(run_ord) AS run_ord, arg_max(noticias, run_ord) AS noticias, (SELECT max(gerado) FROM p) AS gerado FROM p GROUP BY area",
    "run_counters": f"WITH {ITEMS} SELECT run_ord, feed_ord, count(*) AS lidas, count(DISTINCT lower(titulo)) AS distintas, count(*) FILTER (area <> '') AS marcadas, count(*) FILTER (ligacao = '') AS sem_ligacao FROM it GROUP BY 1, 2",
    "month_frame": items("item_id, ts, ts::DATE AS dia, strftime(ts, '%Y-%m') AS mes"),
    "area_first_group": f"WITH {ITEMS} SELECT area, arg_min(grupo, {ORD}) AS grupo FROM it WHERE area <> '' GROUP BY area",
    "newest_first_undated_last": items(f"item_id, {ROWS.format('area', 'LAST')} AS posto"),
    "newest_first_undated_first": items(f"item_id, {ROWS.format('area', 'FIRST')} AS posto"),
    "topk_per_group": f"WITH {ITEMS}, o AS (SELECT *, {origin()} AS origem FROM it WHERE area <> '' AND ts IS NOT NULL) SELECT item_id, area, origem FROM o QUALIFY {ROWS.format('area, origem', 'LAST')} <= 35",
    "topk_per_keyword": f"WITH {ITEMS}, w AS (SELECT item_id, run_ord, feed_ord, area, unnest(list_distinct(palavras)) AS palavra FROM it) SELECT item_id, area, palavra FROM w QUALIFY row_number() OVER (PARTITION BY area, palavra ORDER BY run_ord, feed_ord, item_id) <= 60",
    "preview": items("item_id, ts") + " WHERE ts IS NOT NULL ORDER BY ts DESC, run_ord, feed_ord, item_id LIMIT 20",
    "union_runs": f"WITH {ITEMS} SELECT run_ord, count(*) AS linhas, count(*) FILTER (run_ord > 5 AND imagem <> '') AS imagens FROM it GROUP BY 1",
    "subscribe": f"WITH {SUBS} SELECT DISTINCT 'Tesouraria' AS area, lower(trim(email)) AS email FROM subs WHERE regexp_full_match(lower(trim(email)), '[^@\\s,;<>]+@[^@\\s,;<>]+\\.[A-Za-z]{{2,}}') AND lower(trim(email)) NOT IN (SELECT email FROM s WHERE area = 'Tesouraria')",
    "cancel": f"WITH {SUBS} SELECT * FROM s WHERE area NOT LIKE 'Lotas%'",
    "masked_list": f"WITH {SUBS}, n AS (SELECT email, count(*) AS areas FROM s GROUP BY 1) SELECT {MASK} AS email, areas FROM n",
    "recipients": f"WITH {SUBS} SELECT area, string_agg(email, ',' ORDER BY email) AS para, count(*) AS n FROM s GROUP BY area",
    "hidden_addresses": f"WITH {SUBS} SELECT DISTINCT '::add-mask::' || email AS linha FROM s",
    "area_list": f"WITH {ITEMS} SELECT DISTINCT area FROM it WHERE area <> ''",
    "area_texts": f"""WITH {ITEMS}, r AS (SELECT *, {ROWS.format('area', 'LAST')} AS n, count(*) OVER (PARTITION BY area) AS noticias,
        {LABEL} || ': ' || {shorten('titulo')} || ' — ' || coalesce(nullif(fonte, ''), 'sem indicação') AS t,
        '<li>' || CASE WHEN regexp_matches(ligacao, '(?i)^https?://') THEN '<a href="' || {escape('ligacao')} || '">' || {escape(shorten('titulo'))} || '</a>' ELSE {escape(shorten('titulo'))} END || '</li>' AS h
      FROM it WHERE area <> '') SELECT area, max(noticias) AS noticias, string_agg(t, chr(10) ORDER BY n) AS texto, string_agg(h, '' ORDER BY n) AS html FROM r WHERE n <= 10 GROUP BY area""",
    "manifest": MANIFEST.replace("@SOURCE@", "it WHERE area <> ''").replace("@CTES@", ""),
    "summarise_listing": f"WITH {ITEMS}, {PARAGRAPHS.format(k=5)} SELECT * FROM p",
    "ingest_feeds": INGESTED,
    "stream_daily": f"WITH {ITEMS} SELECT ts::DATE AS data, area, {origin()} AS origem, count(*) AS noticias FROM it WHERE ts IS NOT NULL AND area <> '' GROUP BY 1, 2, 3",
    "ranked_areas": f"WITH {ITEMS}, n AS (SELECT area, count(*) AS noticias FROM it WHERE {HIGH.format(AS_OF, 720, 'FALSE')} AND NOT {PLATFORM} AND {origin()} = 'nacionais' AND area <> '' GROUP BY area) SELECT area, noticias, rank() OVER (ORDER BY noticias DESC) AS posto FROM n",
    "keyword_selection": items("item_id") + " WHERE list_has_any(palavras, ['estrada', 'quota', 'museu'])",
    "excluded_breakdown": f"""WITH {ITEMS}, b AS (SELECT list_contains(palavras, 'estrada') AS k, {origin()} = 'nacionais' AS o, {HIGH.format(AS_OF, 168, 'FALSE')} AS w FROM it)
      SELECT count(*) AS todas, count(*) FILTER (k AND o AND w) AS ficam, count(*) FILTER (NOT k) AS sem_palavra, count(*) FILTER (NOT o) AS outra_origem, count(*) FILTER (NOT w) AS fora_do_periodo,
        count(*) FILTER (NOT k AND o AND w) AS so_palavra, count(*) FILTER (k AND NOT o AND w) AS so_origem, count(*) FILTER (k AND o AND NOT w) AS so_periodo FROM b""",
    "keyword_coverage": f"WITH {ITEMS}, w AS (SELECT fonte, unnest(list_distinct(palavras)) AS palavra FROM it) SELECT palavra, count(*) AS noticias, count(DISTINCT nullif(fonte, '')) AS fontes FROM w GROUP BY 1",
    "evolution_vs_mean": f"WITH {ITEMS}, {DAILY}, m AS (SELECT data, area, noticias, avg(noticias) OVER (PARTITION BY area ORDER BY data ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a FROM daily) SELECT data, area, noticias, round(a, 4) AS media, round(100.0 * (noticias - a) / a, 4) AS variacao FROM m",
    "pivot_origin": f"WITH {ITEMS} SELECT date_trunc('week', ts)::DATE AS periodo, " + ", ".join(f"count(*) FILTER ({origin()} = '{o}') AS {o}" for o in ("nacionais", "lusofonas", "internacionais")) + " FROM it WHERE ts IS NOT NULL GROUP BY 1",
    "top_areas_trend": f"WITH {ITEMS}, {DAILY}, t AS (SELECT area FROM daily GROUP BY area ORDER BY sum(noticias) DESC, area LIMIT 8) SELECT data, area, noticias FROM daily WHERE area IN (SELECT area FROM t)",
    "zero_yield_keywords": f"WITH {ITEMS}, {KEYWORDS} SELECT area, phrase AS palavra FROM rules JOIN areas USING (area_id) WHERE kind = 'keyword' AND NOT EXISTS (SELECT 1 FROM dk WHERE dk.area = areas.area AND dk.palavra = phrase AND data BETWEEN DATE '2018-03-19' AND DATE '2018-03-20')",
    "window_selector": f"WITH {ITEMS}, {DAILY} SELECT area, " + ", ".join(f"coalesce(sum(noticias) FILTER (data > DATE '2018-03-20' - {n}), 0)::BIGINT AS ultimos_{n}" for n in (7, 30, 90, 365)) + ", sum(noticias)::BIGINT AS tudo FROM daily GROUP BY area",
    "source_concentration": f"""WITH {ITEMS}, n AS (SELECT year(ts) || '-' || CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS semestre, lower(trim(fonte)) AS f, count(*) AS n FROM it WHERE ts IS NOT NULL AND fonte <> '' GROUP BY 1, 2),
      h AS (SELECT semestre, sum(n)::BIGINT AS noticias, sum(n * n)::DOUBLE / (sum(n) * sum(n))::DOUBLE AS hhi FROM n GROUP BY 1) SELECT semestre, noticias, round(hhi, 6) AS hhi, round(hhi - lag(hhi) OVER (ORDER BY semestre), 6) AS mudanca FROM h""",
    "dimension_defaults": f"WITH v AS (SELECT unnest([{', '.join(map(repr, NAMED))}]) AS n), it AS (SELECT unnest([n, 'www.' || n, 'sub.' || n, 'x' || n]) AS dominio FROM v) SELECT dominio, {origin(more=())} AS origem, {portuguese(more=())} AS portugues, {country(more=())} AS pais, {under(dom(), PLATFORM_NAMES)} AS plataforma FROM it",
    "area_totals": f"WITH {ITEMS} SELECT area, count(*) AS noticias FROM it WHERE ts IS NOT NULL AND area <> '' GROUP BY area",
    "report_documents": DOCUMENTS,
    "area_syntheses": f"WITH {ITEMS}, {WRITTEN}, n AS (SELECT area, count(*) AS noticias FROM it WHERE area <> '' GROUP BY area) SELECT area, noticias, coalesce(sh, '') AS sintese FROM n LEFT JOIN block USING (area)",
    "daily_reports": MANIFEST.replace("@SOURCE@", SUBSCRIBED).replace("@CTES@", f", {SUBS}").replace("count(*) AS noticias, regexp", "count(*) AS noticias, count(DISTINCT coalesce(nullif(fonte, ''), 'sem indicação')) AS fontes, regexp", 1).replace("SELECT area, f ||", "SELECT area, fontes, f ||", 1),
    "syntheses_each": f"{EACH} SELECT area, origem, noticias, CASE WHEN estado = 'escrita' THEN x END AS texto, estado, CASE WHEN estado = 'falhou' THEN 'RuntimeError: sem resposta' END AS erro FROM e",
    "synthesis_counters": f"{EACH} SELECT " + ", ".join(f"count(*) FILTER (estado = '{a}') AS {b}" for a, b in (("escrita", "escritas"), ("poucas", "poucas"), ("falhou", "falhadas"), ("curta", "curtas"))) + " FROM e",
    "confirmations": confirmation(ADDED.format("Tesouraria & Cofres"), "Subscrição confirmada", "Passa a receber um relatório de cada uma destas áreas. O primeiro relatório chega a partir de amanhã, às 10h00.", "https://painel.example/"),
    "cancellations": confirmation("SELECT * FROM s WHERE area LIKE 'Lotas%' OR area LIKE 'A%'", "Subscrição cancelada", "Deixa de receber os relatórios destas áreas."),
    "registry_lists": "SELECT feed_ord, source, domain, CASE WHEN registry = 'nacional' THEN url END AS url FROM feeds WHERE registry IN ('nacional', 'lusofona')",
    "search_queries": f"WITH {SEARCH} SELECT area_id, consulta, 'https://noticias.example/rss/search?q=' || url_encode(consulta) || '&hl=pt-PT&gl=PT&ceid=PT:pt-150' AS endereco FROM q",
    "keyword_source": f"""WITH {ITEMS}, w AS (SELECT DISTINCT area, phrase FROM rules JOIN areas USING (area_id) WHERE kind = 'keyword'),
      kr AS (SELECT area_id, phrase, 'keyword' AS kind, min(ord) AS ord FROM rules WHERE kind = 'keyword' GROUP BY 1, 2), {RULES.format(rules='kr')},
      f AS (SELECT it.*, w.phrase FROM it JOIN w USING (area) QUALIFY row_number() OVER (PARTITION BY area, w.phrase ORDER BY run_ord, feed_ord, item_id) <= 60),
      ok AS (SELECT f.* FROM f JOIN areas USING (area) JOIN pats ON pats.area_id = areas.area_id AND pats.phrase = f.phrase WHERE regexp_matches({fold("concat_ws(' ', titulo, resumo)")}, pat) AND (acr = '' OR regexp_matches(concat_ws(' ', titulo, resumo), acr)))
      SELECT arg_min(item_id, {ORD}) AS item_id, area, list_sort(list(DISTINCT phrase)) AS palavras FROM ok GROUP BY area, lower(titulo), lower(fonte)""",
    "run_document": f"WITH {ITEMS} SELECT {PLAIN}, '20 de março de 2018, 12h00' AS gerado, 'publicações' AS origem, '48h' AS periodo FROM it WHERE {IN_WINDOW}",
    "archive_document": f"""WITH {ITEMS}, k AS (SELECT * FROM it WHERE {RETAINED} AND NOT (run_ord <= 5 AND {DAMAGED})) SELECT arg_min(area, {ORD}) AS area, coalesce(arg_min(grupo, {ORD}) FILTER (grupo <> ''), '') AS grupo, arg_min(strftime(ts, '%Y-%m-%d %H:%M'), {ORD}) AS data,
      arg_min(fonte, {ORD}) AS fonte, arg_min(titulo, {ORD}) AS titulo, {', '.join(f"coalesce(arg_min({c}, {ORD}) FILTER ({c} <> ''), '') AS {c}" for c in ('dominio', 'resumo', 'ligacao', 'imagem'))},
      list_sort(list_distinct(flatten(list(palavras)))) AS palavras FROM k GROUP BY k.area, lower(k.titulo), lower(k.fonte)""",
    "archive_corpus": filled_in("lower(titulo)", ["resumo", "imagem", "ligacao", "dominio"], NEW_ORD, ["item_id", "titulo"], f"titulo <> '' AND {RETAINED} AND NOT (run_ord <= 5 AND {DAMAGED})"),
    "months_archive": f"""WITH {ITEMS}, m AS (SELECT *, strftime(ts, '%Y-%m') AS mes FROM it WHERE ts IS NOT NULL), k AS (SELECT * FROM m WHERE run_ord <= 5
      UNION ALL SELECT * FROM m n WHERE run_ord > 5 AND NOT EXISTS (SELECT 1 FROM m o WHERE o.run_ord <= 5 AND o.mes = n.mes AND o.area = n.area AND lower(o.titulo) = lower(n.titulo)))
      SELECT mes, area, strftime(ts, '%Y-%m-%d %H:%M') AS data, titulo, fonte, palavras FROM k""",
    "missing_state": "SELECT * FROM (VALUES ('A', 'um'), ('B', 'dois')) t(area, titulo)",
    "series_document": f"WITH {ITEMS}, {DAILY} SELECT * FROM daily",
    "longitudinal_months": f"WITH {ITEMS}, {KEYWORDS}, {resampled('dk', 'area, palavra', ['noticias'], 'month')}",
    "csv_table": items("item_id, titulo, fonte"),
    "spreadsheet": f"""WITH {ITEMS}, v AS (SELECT coalesce(nullif(fonte, ''), 'sem indicação') AS valor, count(*) AS n, min(item_id) AS f FROM it GROUP BY 1 ORDER BY n DESC, f LIMIT 15), o AS (SELECT *, row_number() OVER (ORDER BY n DESC, f) + 1 AS i FROM v)
      {SHEET_CELLS.format(1, "'A'", "'valor'")} UNION ALL {SHEET_CELLS.format(1, "'B'", "'n'")} UNION ALL {SHEET_CELLS.format("i", "'A'", "valor")} FROM o UNION ALL {SHEET_CELLS.format("i", "'B'", "n::VARCHAR")} FROM o""",
    "workbook_counts": f"""WITH {ITEMS}, v AS (SELECT areas.area, count(item_id) AS n FROM areas LEFT JOIN (SELECT * FROM it WHERE {IN_WINDOW}) x USING (area) GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY area) + 1 AS i, (SELECT greatest(2, count(*) + 1) FROM it WHERE {IN_WINDOW}) AS last FROM v)
      {SHEET_CELLS.format(1, "'A'", "'area'")} UNION ALL {SHEET_CELLS.format(1, "'B'", "'noticias'")} UNION ALL {SHEET_CELLS.format(1, "'C'", "'actual'")} UNION ALL {SHEET_CELLS.format("i", "'A'", "area")} FROM o UNION ALL {SHEET_CELLS.format("i", "'B'", "n::VARCHAR")} FROM o
      UNION ALL {SHEET_CELLS.format("i", "'C'", "'COUNTIF(noticias!$A$2:$A$' || last || ',A' || i || ')'")} FROM o""",
    "stream_archive": filled_in("area, lower(titulo), lower(fonte)", ["resumo"], ORD, ["item_id"], RETAINED, True),
    "stream_first_seen": f"WITH {ITEMS} SELECT DISTINCT ligacao FROM it WHERE ts IS NOT NULL AND ligacao <> ''",
}


#: Columns that are dates, given as text.
DATES = {
    "data": ("daily_by_area", "keyword_counts", "upsert_day", "series_long_area", "series_long_keyword", "series_document", "evolution_vs_mean", "top_areas_trend", "stream_daily"),
    "periodo": (*(f"resample_{by}" for by in PERIODS), "resample_orders", "pivot_origin", "longitudinal_months"),
    "dia": ("group_by_day", "month_frame"), "recebe": ("report_calendar",), "de": ("origin_share",), "ate": ("origin_share",),
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in SQL.items():
        dates = [c for c, names in DATES.items() if name in names]
        out[name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in dates)}) FROM ({sql})" if dates else sql
    return out
