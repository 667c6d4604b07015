"""The queries of this subpackage and what a plain SQL engine says to them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, labels
from .fingerprints import edit_likeness
from .license_scan import scan_licenses
from .line_dedup import dedup_lines
from .minhash import near_duplicates
from .mixing import mix
from .packing import pack
from .quality import quality_rules
from .secret_scan import secret_digests
from .tokens import token_counts
from .toxicity import toxicity


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir)).drop("spans")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(documents(spark, sf_dir))


# -- parts of results that SQL can say, and results that it can say whole --

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def text_mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of ``op3``; which words are taken depends on its random keys."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


SQL_MIXING = f"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM d GROUP BY source),
r AS (SELECT *, 3.0 * source_size AS most, sum(3.0 * source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) - 3.0 * source_size AS capped,
      sum(w) OVER (ORDER BY 3.0 * source_size / w DESC, source DESC NULLS FIRST) AS free, sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, (total - capped) / free AS level FROM r),
v AS (SELECT *, min(CASE WHEN level * w < most THEN 3.0 * source_size / w END) OVER () AS first_free FROM f),
x AS (SELECT *, max(CASE WHEN most / w = first_free THEN level END) OVER () AS common FROM v)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, round(CASE WHEN first_free IS NULL OR most / w < first_free THEN most ELSE least(most, common * w) END, 3) AS target
FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""


def text_secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base patterns of ``op4``."""
    return secret_digests(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")
SQL_SECRETS = rf"""
SELECT doc_id,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 12)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS BIGINT) AS n_access,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16)) AS BIGINT) AS n_hex
FROM documents
"""


def text_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and base rule of ``op5``; the verdict is learned."""
    rows = quality_rules(documents(spark, sf_dir), labels(spark, sf_dir))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


SQL_QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
words AS (SELECT doc_id, i, w[i:i + 4] AS five FROM d, unnest(range(1, len(w) - 3)) u(i) WHERE len(w) >= 5),
again AS (SELECT doc_id, i FROM words QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM d)
SELECT c.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, n_words < 10 OR 100 * coalesce(repeats.n, 0) > 20 * n_words AS base_failed
FROM c LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)
"""


def text_license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases of ``op7``; its other labels come from votes."""
    return scan_licenses(documents(spark, sf_dir)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


SQL_LICENSES = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT * FROM (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')) p(phrase, label)),
f AS (SELECT doc_id, i - 1 AS place, label FROM d, unnest(range(1, len(w) + 1)) u(i), p WHERE w[i] = phrase[1] AND w[i:i + len(phrase) - 1] = phrase),
g AS (SELECT doc_id, count(*) AS n, min(place) AS a, max(place) AS b, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(b AS BIGINT) AS last_word, coalesce(labels, '') AS base_labels
FROM d LEFT JOIN g USING (doc_id)
"""


def text_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and edited texts' digests of ``op10``; fingerprints aren't SQL."""
    return edit_likeness(documents(spark, sf_dir)).select("doc_id", "n_chars", "edited_sha256")


SQL_EDITS = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next FROM documents)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(substring(t, 1, length(t) - length(t) // 4) || substring(next, 1, length(t) // 4)) AS edited_sha256 FROM d
"""

#: Every shortest run of 50 words that starts or ends at a line; those that stand earlier too go.
SQL_LINE_DEDUP = f"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS place FROM raw),
l AS (SELECT doc_id, place, line, len({WORDS.replace("coalesce(text, '')", "line")}) AS words FROM u),
s AS (SELECT doc_id, place, line, row_number() OVER o AS i, sum(words) OVER o AS upto, sum(words) OVER o - words AS before FROM l WHERE words > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
runs AS (
  SELECT a.doc_id, a.i AS first, min(b.i) AS last FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.before >= 50 GROUP BY 1, 2
  UNION SELECT b.doc_id, max(a.i), b.i FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.before >= 50 GROUP BY 1, 3),
texts AS (SELECT r.doc_id, r.first, r.last, string_agg(s.line, chr(10) ORDER BY s.i) AS run FROM runs r JOIN s ON s.doc_id = r.doc_id AND s.i BETWEEN r.first AND r.last GROUP BY 1, 2, 3),
later AS (SELECT doc_id, first, last FROM texts QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT s.doc_id, s.place FROM later x JOIN s ON s.doc_id = x.doc_id AND s.i BETWEEN x.first AND x.last),
kept AS (SELECT u.doc_id, string_agg(line, chr(10) ORDER BY u.place) FILTER (g.place IS NULL) AS text, count(*) AS n_lines, count(g.place) AS n_deleted FROM u LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.place = u.place GROUP BY u.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

SQL_NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", LOWER)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 3, 2))) u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
ends AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach(doc_id, other) AS (SELECT x, y FROM ends UNION SELECT r.doc_id, e.y FROM reach r JOIN ends e ON e.x = r.other),
c AS (SELECT d.doc_id, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id FROM d LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

ORACLES = {
    "op6_line_dedup": SQL_LINE_DEDUP,
    "op8_minhash_near_dedup": SQL_NEAR_DEDUP,
    "text_mixing_targets": SQL_MIXING,
    "text_secret_counts": SQL_SECRETS,
    "text_quality_counts": SQL_QUALITY,
    "text_license_phrases": SQL_LICENSES,
    "text_edits": SQL_EDITS,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (op1_best_fit_packing, op2_toxicity, op3_mixing, op4_secret_scan, op5_quality_rules, op6_line_dedup, op7_license_scan, op8_minhash_near_dedup, op9_token_counts, op10_fingerprints)
    parts = (text_mixing_targets, text_secret_counts, text_quality_counts, text_license_phrases, text_edits)
    return {f.__name__: f for f in operators + parts}


def oracle_sql() -> dict[str, str]:
    return ORACLES
