"""Registered queries opN_<name> of the training-data operators, and their DuckDB twins where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.llm import collocations, decontaminate, divergence, html_density, jaccard_join, multiset_hash, pii, poisson_mix, quality_net, quote_links, suffix_dedup, token_counts, url_logit
from threadsmith.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return keep


@query("op1_html_density")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract_main_text(read(spark, sf_dir, "pages"))


@query("op2_quality_net")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op3_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_join(read(spark, sf_dir, "documents"))


@query("op4_url_logit")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_logit.judge_urls(read(spark, sf_dir, "pages"))


@query("op5_pii_checksums")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


MIX_SQL = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS all_n, sum(sqrt(n)) AS all_w FROM n),
r AS (SELECT source, all_n * sqrt(n) / all_w / n AS rate FROM n, t),
k AS (SELECT source, i, sum(exp(-rate + i * ln(rate) - lgamma(i + 1))) OVER (PARTITION BY source ORDER BY i) AS cdf
      FROM (SELECT *, unnest(range(0, 200)) AS i FROM r)),
c AS (SELECT source, list(cdf ORDER BY i) AS cdf FROM k GROUP BY source),
u AS (SELECT d.*, CAST(('0x' || substr(md5('mix|' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
      FROM documents d),
m AS (SELECT u.*, len(list_filter(cdf, lambda x: x <= u)) AS mix_n FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, text, lang, source, n_chars, CAST(mix_copy AS INTEGER) AS mix_copy,
       md5('mix|order|' || doc_id || '|' || mix_copy) AS mix_key
FROM (SELECT *, unnest(range(1, mix_n + 1)) AS mix_copy FROM m)
"""


@query("op6_poisson_mix", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.mix_sources(read(spark, sf_dir, "documents"))


@query("op10_edit_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query("op7_quote_links")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link_quotations(read(spark, sf_dir, "conversations"))


def _words_sql(text: str) -> str:
    """DuckDB list of a text's fingerprint words and its number of pieces."""
    m = multiset_hash
    lines = f"list_filter(string_split({text}, chr(10)), lambda p: p <> '')"
    pieces = f"regexp_extract_all({text}, '{m.PIECES}')"

    def number(digest: str, start: int) -> str:
        return f"CAST(('0x' || substr({digest}, {start}, 15)) AS BIGINT)"

    def total(items: str) -> str:
        return f"CAST(coalesce(list_sum({items}), 0) % {m.MODULUS} AS BIGINT)"
    words = [total(f"list_transform({lines}, lambda p: {number(d, start)})")
             for d in ("md5(p)", "md5('#' || p)") for start in (1, 17)]
    words += [total(f"list_transform({pieces}, lambda p: ({number('md5(p)', 1)} >> {j}) & {m.SPREAD})")
              for j in range(m.COUNTERS)]
    return f"[{', '.join(words)}, CAST(len({pieces}) AS BIGINT)]"


def _counters_sql(words: str) -> str:
    m = multiset_hash
    lanes = ", ".join(f"CAST(2 * ((q >> {m.LANE_BITS * k}) & {(1 << m.LANE_BITS) - 1}) - {words}[-1] AS DOUBLE)"
                      for k in range(m.LANES))
    return f"flatten(list_transform({words}[{m.EXACT + 1}:{m.EXACT + m.COUNTERS}], lambda q: [{lanes}]))"


def _likeness_sql(a: str, b: str) -> str:
    size = f"sqrt(list_dot_product(c_{a}, c_{a}) * list_dot_product(c_{b}, c_{b}))"
    return (f"CASE WHEN {a} = {b} THEN 1.0 WHEN {size} > 0 THEN "
            f"round(greatest(0.0, least(1.0, list_dot_product(c_{a}, c_{b}) / {size})), 6) ELSE 0.0 END")


def _hex_sql(words: str) -> str:
    return f"list_aggregate(list_transform({words}, lambda w: lpad(lower(to_hex(w)), 16, '0')), 'string_agg', '')"


FINGERPRINT_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lag(text) OVER (ORDER BY doc_id), last_value(text) OVER (
        ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next FROM d),
e AS (SELECT doc_id, n, text, next, substr(text, 1, n - n // 3) || substr(next, 1, n // 3) AS edited FROM o),
v AS (SELECT doc_id, n, sha256(edited) AS edited_sha256, {_words_sql('text')} AS w, {_words_sql('edited')} AS x,
      {_words_sql('next')} AS y FROM e),
c AS (SELECT *, {_counters_sql('w')} AS c_w, {_counters_sql('x')} AS c_x, {_counters_sql('y')} AS c_y FROM v)
SELECT doc_id, n AS n_chars, edited_sha256, {_hex_sql('w')} AS fingerprint, {_hex_sql('x')} AS edited_fingerprint,
       {_likeness_sql('w', 'x')} AS near_edited, {_likeness_sql('w', 'y')} AS near_next
FROM c
"""


@query("op9_multiset_hash", FINGERPRINT_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_fingerprints(read(spark, sf_dir, "documents"))


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
s AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS count,
             1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (s.n + v.v) AS p,
             1 + (1000000000 * (k.total + 1)::HUGEINT) // (v.n + v.v) AS q
      FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
all_pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE count > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (
        PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM all_pairs
      UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (
        PARTITION BY lang, source ORDER BY value DESC, encode(item)) FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read(spark, sf_dir, "documents"))


PHRASES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT row, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM d),
q AS (SELECT row, lang, i, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
w AS (SELECT row, lang, i, unnest(words) AS x, generate_subscripts(words, 1) AS j FROM q),
t AS (SELECT lang, x, lead(x, 1) OVER here AS y, lead(x, 2) OVER here AS z FROM w WINDOW here AS (PARTITION BY row, i ORDER BY j)),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
f1 AS (SELECT lang, x, count(*)::HUGEINT AS f FROM t GROUP BY lang, x),
f2 AS (SELECT lang, x, y, count(*)::HUGEINT AS f FROM t WHERE y IS NOT NULL GROUP BY lang, x, y HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*)::HUGEINT AS f FROM t WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10),
c2 AS (SELECT a.lang, a.x || ' ' || a.y AS phrase, a.f AS a, l.f AS l, r.f AS r, (1000000 * a.f * a.f) // (l.f * r.f) AS score
       FROM f2 a JOIN f1 l ON l.lang = a.lang AND l.x = a.x JOIN f1 r ON r.lang = a.lang AND r.x = a.y
       WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = a.lang AND 100 * t.f >= 50 * a.f
                         AND (t.x = a.x AND t.y = a.y OR t.y = a.x AND t.z = a.y))),
c3 AS (SELECT a.lang, a.x || ' ' || a.y || ' ' || a.z AS phrase, a.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
              (1000000 * a.f * a.f) // (x.f * yz.f) AS s1, (1000000 * a.f * a.f) // (xy.f * z.f) AS s2
       FROM f3 a JOIN f1 x ON x.lang = a.lang AND x.x = a.x JOIN f1 z ON z.lang = a.lang AND z.x = a.z
       JOIN f2 xy ON xy.lang = a.lang AND xy.x = a.x AND xy.y = a.y JOIN f2 yz ON yz.lang = a.lang AND yz.x = a.y AND yz.y = a.z),
c AS (SELECT * FROM c2 UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
      CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM c3),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM c)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n, CAST(score AS BIGINT) AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_collocations", PHRASES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(read(spark, sf_dir, "documents"))
