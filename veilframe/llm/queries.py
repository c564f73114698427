"""The queries of the operators, over the given tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import (
    chat, divergence, exact_dedup, main_text, mixing, personal, pieces, quality_classifier, quality_rules, simhash, turns, url_filter, warc,
)
from veilframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Shares of tokens by language and by form; sources are tempered, so that large ones give way a little.
MIX = mixing.Targets(
    sources=0.9, languages={"en": 0.64, "de": 0.14, "fr": 0.14, "es": 0.08},
    topics={"brief": 0.04, "article": 0.60, "long": 0.36})

# The piece model: a file of a public tokenizer.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op10_exact_dedup", r"""
    WITH bare AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents),
    best AS (
        SELECT t, count(*) AS group_size, first(doc_id ORDER BY points DESC, doc_id) AS keep_id FROM bare GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM bare JOIN best USING (t)""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"))


@query("op9_quality_rules", r"""
    WITH w AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS t,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM w WHERE len(w) >= 3),
    again AS (
        SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM windows),
    repeats AS (
        SELECT doc_id, count(DISTINCT p + o) AS n FROM again, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY doc_id),
    counts AS (
        SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
               length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals, len(l) AS n_lines
        FROM w LEFT JOIN repeats USING (doc_id)),
    based AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
    long AS (
        SELECT doc_id, lang, source, base_failed, unnest([
            {'measure': 'symbols', 'event': 1000, 'size': n_words, 'value': 1000 * n_symbols // greatest(n_words, 1)},
            {'measure': 'capitals', 'event': 1000, 'size': word_chars, 'value': 1000 * n_capitals // greatest(word_chars, 1)},
            {'measure': 'repeats', 'event': 6000, 'size': n_words, 'value': 1000 * n_repeat_words // greatest(n_words, 1)},
            {'measure': 'dup_lines', 'event': 1000, 'size': n_lines, 'value': 1000 * n_dup_lines // greatest(n_lines, 1)},
            {'measure': 'length', 'event': 0, 'size': n_words, 'value': 100 * word_chars // greatest(n_words, 1)}], recursive := true)
        FROM based),
    binned AS (
        SELECT lang, source, measure, event, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS bin,
               (size >> greatest(length(bin(size)) - 6, 0)) << greatest(length(bin(size)) - 6, 0) AS size_bin
        FROM long WHERE NOT base_failed),
    levels AS (
        SELECT 1 AS level, * FROM binned UNION ALL
        SELECT 2, * REPLACE (NULL AS source) FROM binned UNION ALL
        SELECT 3, * REPLACE (NULL AS lang, NULL AS source) FROM binned),
    quartiles AS (
        SELECT level, lang, source, measure, count(*) AS n, quantile_disc(bin, 0.25) AS q1,
               quantile_disc(bin, 0.5) AS q2, quantile_disc(bin, 0.75) AS q3, event // greatest(quantile_disc(size_bin, 0.5), 1) AS one
        FROM levels GROUP BY level, lang, source, measure, event),
    cutoffs AS (
        SELECT level, lang, source, measure, n, q2 + 8 * greatest(q3 - q1, one) AS most,
               CASE WHEN measure = 'length' THEN q2 - 8 * greatest(q3 - q1, one) END AS low FROM quartiles),
    weighed AS (
        SELECT a.lang, a.source, a.measure, (a.n * a.most + 10.0::double * (b.n * b.most + 10.0::double * c.most) / (b.n + 10.0::double)) / (a.n + 10.0::double) AS most,
               (a.n * a.low + 10.0::double * (b.n * b.low + 10.0::double * c.low) / (b.n + 10.0::double)) / (a.n + 10.0::double) AS low
        FROM cutoffs a JOIN cutoffs b ON a.level = 1 AND b.level = 2 AND a.measure = b.measure AND a.lang IS NOT DISTINCT FROM b.lang
            JOIN cutoffs c ON c.level = 3 AND c.measure = a.measure),
    verdicts AS (
        SELECT doc_id, bool_and(value <= most AND coalesce(value >= low, true)) AS inside
        FROM long LEFT JOIN weighed w ON w.measure = long.measure
            AND w.lang IS NOT DISTINCT FROM long.lang AND w.source IS NOT DISTINCT FROM long.source
        GROUP BY doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, n_lines, base_failed,
           NOT base_failed AND coalesce(inside, false) AS kept
    FROM based JOIN verdicts USING (doc_id)""")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"), MIX)


@query("op4_pieces")
def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_report(table(spark, sf_dir, "documents"), pieces.read_model(PIECE_MODEL))


URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


@query("op2_url_filter", r"""
    WITH parts AS (
        SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
               list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\?([^#]*)', 1), '&'),
                   lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS asked
        FROM pages),
    named AS (
        SELECT *, CASE WHEN host = '' THEN '' ELSE
                   regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
                   || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS canonical
        FROM parts),
    listed AS (
        SELECT DISTINCT canonical FROM named JOIN labels
            ON try_cast(regexp_extract(path, '/([0-9]+)(\.html)?/?$', 1) AS bigint) = labels.doc_id
        WHERE toxic = 1 AND canonical <> ''),
    ruled AS (
        SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                       WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                       WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                       WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
               canonical IN (SELECT canonical FROM listed) AS listed
        FROM named)
    SELECT page_id, host, path, rule, canonical, listed,
           CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN listed THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled""")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: URLs of pages whose document, by the number that ends the path, is labelled toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.expr(r"try_cast(regexp_extract(path, '/([0-9]+)(\\.html)?/?$', 1) AS bigint)")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    listed = pages.select("url", url_filter.path_of(F.col("url")).alias("path")).select("url", number.alias("doc_id")).join(
        toxic, "doc_id").select("url")
    return url_filter.filtered(pages, listed, URL_RULES)


@query("op7_warc", r"""
    WITH payloads AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    marked AS (
        SELECT *, max(page_id) OVER (PARTITION BY hex) AS largest FROM payloads)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS integer), 5))::bigint >> CAST(15 - 5 * (i % 4) AS integer)) & 31), 1)), '') AS payload_digest,
           CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> largest THEN largest END AS refers_to
    FROM marked""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_report(table(spark, sf_dir, "documents"))


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and first directory of the page that holds a document, by the number that ends the page's path (of several
    pages the first); a document without a page has its source as host, and its language as the path there."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    number = F.expr(r"try_cast(regexp_extract(path, '/([0-9]+)(\\.html)?/?$', 1) AS bigint)")
    place = F.struct("page_id", "host", F.regexp_extract("path", "^(/[^/]*)/", 1).alias("path"))
    sites = pages.where("host <> ''").withColumn("id", number).where("id IS NOT NULL").groupBy("id").agg(
        F.min(place).alias("p")).select("id", "p.host", "p.path")
    return quality_classifier.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), sites=sites)


@query("op6_chat_format")
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


@query("op12_source_divergence", r"""
    WITH d AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
        FROM documents),
    tokens AS (
        SELECT id, lang, source, unnest(regexp_extract_all(
            translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT id) >= 3),
    held AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM d),
    counts AS (
        SELECT g.lang, g.source, term, coalesce(n, 0) AS n
        FROM groups g JOIN kept USING (lang) LEFT JOIN held USING (lang, source, term)),
    shares AS (
        SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // CAST(sum(n) OVER w + count(*) OVER w AS bigint) AS p
        FROM counts WINDOW w AS (PARTITION BY lang, source)),
    whole AS (SELECT lang, term, sum(n)::bigint AS n FROM counts GROUP BY ALL),
    of_lang AS (
        SELECT lang, term, 1 + (1000000000 * (n + 1)) // CAST(sum(n) OVER w + count(*) OVER w AS bigint) AS q
        FROM whole WINDOW w AS (PARTITION BY lang)),
    apart AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    found AS (
        SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
        FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
            LEFT JOIN apart ON apart.lang = g.lang AND apart.source = g.source AND apart.item = h.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::integer AS rank FROM found)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


@query("op13_html_extraction", r"""
    WITH inner_html AS (
        SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS h FROM pages),
    bare AS (
        SELECT page_id, url, regexp_replace(regexp_replace(h, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM inner_html),
    decoded AS (
        SELECT page_id, url, regexp_replace(replace(replace(replace(replace(regexp_replace(t, '&quot;?', '"', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''), '&#39;', ''''), '&amp;?', '&', 'g') AS t FROM bare),
    trimmed AS (SELECT page_id, url, trim(regexp_replace(t, '[\x20\x09-\x0D]+', ' ', 'g')) AS text FROM decoded)
    SELECT page_id, url, text, length(text) AS n_chars FROM trimmed""")
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extraction_report(table(spark, sf_dir, "pages"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damage_and_repair(table(spark, sf_dir, "conversations"))
