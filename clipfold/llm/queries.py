"""Queries of the nine training-data problems; ``oracle`` has SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipfold.llm import encoding, history, language, lines, mixing, neardup, residue, tokens, truncation

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_occurrences(_t(spark, sf_dir, "arquivo"))


def p1_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_blocks(_t(spark, sf_dir, "arquivo"))


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.strip_lines(_t(spark, sf_dir, "arquivo"), out_col="limpo").select("item_id", "limpo")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [r.source for r in _t(spark, sf_dir, "feeds").select("source").collect()]  # a registry of 44 publications
    return history.repeats(_t(spark, sf_dir, "arquivo"), names)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.wrong_labels(_t(spark, sf_dir, "arquivo"))


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.labels(_t(spark, sf_dir, "arquivo"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.judge(_t(spark, sf_dir, "arquivo")).select("item_id", "campo")


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.repair(_t(spark, sf_dir, "arquivo")).select("item_id", "campo", "cadeia", "texto", "inteiro")


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _t(spark, sf_dir, "arquivo").select("item_id", "fonte", "titulo", "resumo").where("resumo <> ''")
    return lines.strip_lines(items).select("item_id", F.concat_ws("\n", "titulo", "resumo").alias("texto"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.pairs(_stories(spark, sf_dir), "texto")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(_stories(spark, sf_dir), "texto")


def p5_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.links(_stories(spark, sf_dir), "texto")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(_t(spark, sf_dir, "arquivo"))


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(_t(spark, sf_dir, "arquivo"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_t(spark, sf_dir, "documents"))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(_t(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str, total: str | None = None) -> tuple[DataFrame, DataFrame]:
    weights = _t(spark, sf_dir, "pesos")
    docs = _t(spark, sf_dir, "documents").join(weights.select("source"), "source", "left_semi")
    return mixing.fair_mix(tokens.token_counts(docs, ["doc_id", "source"]), weights, total)


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p8_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of as many tokens as the listed sources have: small ones reach their cap, the others fill the rest."""
    return _mix(spark, sf_dir, "available")[0]


def p8_filled_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir, "available")[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(_t(spark, sf_dir, "documents")).select("doc_id")


def p9_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.templates(_t(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return ORACLE


_LINES = r"""
    docs AS (
      SELECT item_id, nullif(lower(regexp_replace(fonte, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g')), '') AS src, resumo
      FROM arquivo WHERE resumo <> ''),
    parts AS (SELECT item_id, src, unnest(string_split(resumo, chr(10))) AS line, unnest(range(1, len(string_split(resumo, chr(10))) + 1)) AS linha_no
      FROM docs WHERE src IS NOT NULL),
    keyed AS (
      SELECT item_id, src, linha_no, line,
        trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}+', '0', 'g'), '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS k
      FROM parts),
    sizes AS (SELECT src, count(*) AS n_src FROM docs WHERE src IS NOT NULL GROUP BY src),
    bad AS (
      SELECT src, k FROM keyed JOIN sizes USING (src) WHERE k <> ''
      GROUP BY src, k, n_src HAVING count(DISTINCT item_id) >= 5 AND count(DISTINCT item_id) >= 0.05 * n_src)
"""

#: Distinct words of a text, lower-cased and without accents.
_WORDS = r"list_distinct(regexp_extract_all(strip_accents(lower({})), '[\p{{L}}\p{{N}}]+'))"
_KEPT = """kept AS (SELECT item_id, string_agg(line, chr(10) ORDER BY linha_no) AS t FROM keyed ANTI JOIN bad USING (src, k) GROUP BY item_id)"""
#: Word sets of items with their summaries cleaned, classes of equal sets, and pairs of classes at the threshold.
_STORIES = f"""{_LINES}, {_KEPT},
    sets AS (
      SELECT item_id, list_sort({_WORDS.format("coalesce(a.titulo, '') || chr(10) || CASE WHEN d.src IN (SELECT src FROM bad) THEN coalesce(t, '') ELSE a.resumo END")}) AS w
      FROM arquivo a JOIN docs d USING (item_id) LEFT JOIN kept USING (item_id)),
    class AS (SELECT min(item_id) AS rep, w, len(w) AS n FROM sets WHERE len(w) > 0 GROUP BY w),
    member AS (SELECT item_id, rep FROM sets JOIN class USING (w)),
    word AS (SELECT rep, n, unnest(w) AS x FROM class),
    link AS (
      SELECT a.rep AS ra, b.rep AS rb FROM word a JOIN word b ON a.x = b.x AND a.rep < b.rep AND a.n >= 0.65 * b.n AND b.n >= 0.65 * a.n
      GROUP BY a.rep, b.rep, a.n, b.n HAVING count(*) >= 0.65 * (a.n + b.n - count(*)) - 1e-9)
"""
_PAGE = r"""
    addr AS (
      SELECT item_id, run_ord, trim(ligacao) AS u FROM arquivo),
    parts2 AS (
      SELECT item_id, run_ord, regexp_replace(lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\.', '') AS host,
        regexp_replace(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p),
          '^(utm_.*|ref|referrer|fbclid|gclid|dclid|msclkid|yclid|igshid|mc_cid|mc_eid|_ga|cmpid|ns_.*|xtor|at_medium|at_campaign)(=|$)'))), '&') AS q
      FROM addr),
    page AS (SELECT item_id, run_ord, host || path || '?' || q AS k FROM parts2 WHERE host <> '' AND (path <> '' OR q <> '')),
    same_page AS (SELECT n.item_id, min(o.item_id) AS first_id FROM page n JOIN page o ON n.k = o.k AND o.run_ord < n.run_ord GROUP BY n.item_id)
"""
#: Takes a publication's name off the end of a title; a broken bar stands for a gap with a sign before names.
_BARE = """
    {to} AS (
      SELECT item_id, run_ord, CASE WHEN max(length(nm)) IS NULL THEN s ELSE rtrim(left(s, length(s) - max(length(nm)) - 1), ' ¦') END AS s
      FROM {of} LEFT JOIN nm ON ends_with(replace(s, '¦', ' '), nm) AND length(s) > length(nm) + 1 AND substr(s, length(s) - length(nm), 1) = '¦' GROUP BY item_id, run_ord, s)"""
_TITLES = r"""
    nm AS (SELECT DISTINCT array_to_string(regexp_extract_all(strip_accents(lower(source)), '[\p{L}\p{N}]+'), ' ') AS nm FROM feeds WHERE source <> ''),
    t0 AS (
      SELECT item_id, run_ord, rtrim(regexp_replace(regexp_replace(strip_accents(lower(titulo)), '[^\p{L}\p{N}]*[-|–—·:/][^\p{L}\p{N}]*', '¦', 'g'), '[^\p{L}\p{N}¦]+', ' ', 'g'), ' ¦') AS s
      FROM arquivo WHERE titulo <> ''),""" + _BARE.format(to="t1", of="t0") + "," + _BARE.format(to="t2", of="t1") + r""",
    tset AS (
      SELECT item_id, run_ord, list_sort(list_distinct(regexp_extract_all(s, '[\p{L}\p{N}]+'))) AS w FROM t2),
    tword AS (SELECT item_id, run_ord, len(w) AS n, unnest(w) AS x FROM tset),
    same_title AS (
      SELECT item_id, min(o_id) AS first_id FROM (
        SELECT n.item_id, o.item_id AS o_id FROM tword n JOIN tword o ON n.x = o.x AND o.run_ord < n.run_ord AND n.n >= 0.8 * o.n AND o.n >= 0.8 * n.n
        GROUP BY n.item_id, o.item_id, n.n, o.n HAVING count(*) >= 0.8 * (n.n + o.n - count(*)) - 1e-9) GROUP BY item_id)
"""

ORACLE: dict[str, str] = {
    "p2_found": f"WITH {_PAGE}, {_TITLES} SELECT min(first_id) AS first_id, item_id FROM (FROM same_page UNION ALL FROM same_title) GROUP BY item_id",
    "p5_found": f"""WITH {_STORIES} SELECT least(a.item_id, b.item_id) AS id_a, greatest(a.item_id, b.item_id) AS id_b FROM link JOIN member a ON a.rep = ra JOIN member b ON b.rep = rb
      UNION ALL SELECT a.item_id, b.item_id FROM member a JOIN member b ON a.rep = b.rep AND a.item_id < b.item_id""",
    "p5_groups": f"""WITH {_STORIES}, deg AS (SELECT rep, count(*) AS n FROM (SELECT ra AS rep FROM link UNION ALL SELECT rb FROM link) GROUP BY rep)
      SELECT item_id, rep AS class_id, coalesce(n, 0) AS n_links FROM member LEFT JOIN deg USING (rep)""",
    "p5_links": f"WITH {_STORIES} SELECT ra AS class_a, rb AS class_b FROM link",
    "p1_found": f"WITH {_LINES} SELECT item_id, CAST(linha_no AS INTEGER) AS linha_no FROM keyed JOIN bad USING (src, k)",
    "p1_clean": f"""WITH {_LINES},
      kept AS (SELECT item_id, string_agg(line, chr(10) ORDER BY linha_no) AS t FROM keyed ANTI JOIN bad USING (src, k) GROUP BY item_id),
      touched AS (SELECT DISTINCT src FROM bad)
      SELECT a.item_id, CASE WHEN d.src IN (SELECT src FROM touched) THEN coalesce(t, '') ELSE a.resumo END AS limpo
      FROM arquivo a LEFT JOIN docs d USING (item_id) LEFT JOIN kept USING (item_id)""",
}
