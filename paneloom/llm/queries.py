"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm import (
    collocations,
    cover_tree,
    exact_dedup,
    line_dedup,
    mixing,
    near_dedup,
    piece_merge,
    posting_lists,
    secret_scan,
    toxicity,
    url_rules,
    warc,
    zone_maps,
)
from paneloom.llm.common import text_of
from paneloom.session import scratch_path

CRAWL_FILE_RECORDS = 50_000  # about a gigabyte of usual pages; a file is read in order by one task


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path() -> str:
    """Default place of the tokenizer; the operators take a path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def near_duplicates(spark, sf):
    return near_dedup.classes(_table(spark, sf, "documents"))


def pieces(spark, sf, model_path: str | None = None):
    model = piece_merge.load_model(model_path or tokenizer_path())
    docs = _table(spark, sf, "documents").select("doc_id", text_of().alias("text"))
    return piece_merge.transcode(docs, "text", model).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def secrets(spark, sf):
    return secret_scan.digest(secret_scan.scan(_table(spark, sf, "documents")))


def lines(spark, sf):
    return line_dedup.digest(line_dedup.deduplicate(_table(spark, sf, "documents")))


def nearest(spark, sf):
    vectors = _table(spark, sf, "embeddings")
    return cover_tree.top_k(vectors, F.col("vec_id") % 50 == 0)


def toxic(spark, sf):
    return toxicity.score_documents(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def _captures(pages: DataFrame) -> DataFrame:
    """Record texts of a crawl: each page as a response, a second of page_id after another, and
    40,000 seconds later a 304 answer to the URL with a tracking key. By the bytes of the page the
    answer carries an ETag, a Last-Modified, a payload digest or no validator."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id"))
    later = F.timestamp_seconds(F.lit(1_704_107_200) + F.col("page_id"))
    html = F.coalesce("html", F.lit(""))
    size = F.octet_length(html)
    tag = F.concat(F.lit("ETag: \""), F.md5(html), F.lit("\"\r\n"))
    second = F.timestamp_add("SECOND", size, F.lit("2020-09-13 12:26:40").cast("timestamp_ntz"))
    changed = F.concat(
        F.lit("Last-Modified: "), F.date_format(second, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.lit("\r\n")
    )
    digest = F.concat(F.lit("sha256:"), F.sha2(html.cast("binary"), 256))
    full = F.concat(
        F.lit("Content-Type: text/html\r\nCache-Control: max-age=60\r\nContent-Length: "),
        size.cast("string"),
        F.lit("\r\n"),
        tag,
        changed,
    )
    short = F.concat(
        F.lit("Cache-Control: max-age=600\r\nContent-Length: 0\r\nServer: x\r\n"),
        F.when(size % 4 == 0, tag).when(size % 4 == 1, changed).otherwise(F.lit("")),
    )
    again = F.concat(
        F.regexp_replace("url", "(?s)#.*$", ""),
        F.when(F.col("url").contains("?"), F.lit("&")).otherwise(F.lit("?")),
        F.lit("utm_source=again"),
    )
    name = F.col("page_id").cast("string")
    response = warc.record_text(
        "response", F.concat(F.lit("r"), name), F.col("url"), at, "200 OK", full, F.col("html"), digest
    )
    revisit = warc.record_text(
        "revisit", F.concat(F.lit("v"), name), again, later, "304 Not Modified", short, F.lit(""),
        F.when(size % 4 == 2, digest),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("record"))


def revisits(spark, sf):
    """The pages as a crawl, written as WARC files and read back."""
    crawl = scratch_path(spark, "crawl")
    captures = _captures(_table(spark, sf, "pages")).write.option("lineSep", "\r\n\r\n")
    captures.option("maxRecordsPerFile", CRAWL_FILE_RECORDS).text(crawl)
    found = warc.resolve(warc.parse(warc.read(spark, crawl, payloads=False)).drop("body"))

    def number(name):
        return F.substring(name, 2, 30).cast("long")

    return found.select(
        number(F.col("record_id")).alias("page_id"),
        "canonical_url",
        "outcome",
        number(F.col("response_id")).alias("response_page_id"),
        F.unix_seconds("response_date").alias("response_at"),
        F.array_join(
            F.transform("headers", lambda h: F.concat_ws("=", h["name"], h["value"])), "; "
        ).alias("headers"),
    )


# Built like the query: canonical URLs, an as-of join by windows, validators, merged headers.
REVISITS_SQL = """
WITH base AS (
  SELECT page_id, coalesce(html, '') AS html, url, regexp_replace(url, '#.*$', '', 's') AS plain
  FROM pages),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(plain, '^[^:/?#]+://([^/?#]*)', 1, 's')),
              '^www\\.', ''), ':(80|443)$', '') AS name,
    regexp_replace(regexp_extract(plain, '^[^:/?#]+://[^/?#]*([^?]*)', 1, 's'), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(plain, '^[^?]*\\?(.*)$', 1, 's'), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS kept
  FROM base),
named AS (
  SELECT page_id, md5(html) AS tag, sha256(html) AS digest, strlen(html) AS bytes,
    strftime(make_timestamp((1600000000 + strlen(html)) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS changed,
    CASE WHEN regexp_matches(plain, '^[^:/?#]+://') THEN concat(name, place,
      CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END)
      ELSE url END AS canonical_url,
    CASE WHEN NOT regexp_matches(plain, '^[^:/?#]+://') THEN
      plain || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_source=again' END AS other
  FROM parts),
events AS (
  SELECT *, 1704067200 + page_id AS sec, true AS stored FROM named
  UNION ALL
  SELECT * REPLACE (coalesce(other, canonical_url) AS canonical_url), 1704107200 + page_id, false FROM named),
seen AS (
  SELECT *, max(CASE WHEN stored AND sec IS NOT NULL THEN {'sec': sec, 'id': 'r' || page_id,
      'page_id': page_id, 'tag': tag, 'digest': digest, 'bytes': bytes, 'changed': changed} END)
    OVER (PARTITION BY canonical_url ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
  FROM events),
met AS (
  SELECT *, CASE WHEN canonical_url IS NOT NULL AND sec IS NOT NULL THEN last END AS b
  FROM seen WHERE NOT stored),
judged AS (
  SELECT *, CASE WHEN b IS NULL THEN 'no_response' WHEN bytes % 4 = 3 THEN 'unchecked'
    WHEN CASE bytes % 4 WHEN 0 THEN b.tag = tag WHEN 1 THEN b.changed = changed ELSE b.digest = digest END
    THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM met)
SELECT page_id, canonical_url, outcome,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN b.page_id END AS response_page_id,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN b.sec END AS response_at,
  CASE WHEN outcome IN ('resolved', 'unchecked')
    THEN concat('cache-control=max-age=600; content-length=', b.bytes, '; content-type=text/html; etag="', b.tag,
      '"; last-modified=', b.changed)
    ELSE concat('cache-control=max-age=600; content-length=0',
      CASE bytes % 4 WHEN 0 THEN concat('; etag="', tag, '"') WHEN 1 THEN concat('; last-modified=', changed)
        ELSE '' END, '; server=x') END AS headers
FROM judged
"""


def url_verdicts(spark, sf):
    pages = _table(spark, sf, "pages")
    return url_rules.judge(pages, url_rules.mine(pages, _table(spark, sf, "labels")))


def exact_duplicates(spark, sf):
    return exact_dedup.deduplicate(_table(spark, sf, "documents"))


# Rows repeated with the same id are told apart by their order, which is arbitrary in either engine.
EXACT_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS plain
  FROM documents),
r AS (
  SELECT doc_id, plain,
    first_value(doc_id) OVER g AS keep_id, row_number() OVER g = 1 AS kept,
    count(*) OVER (PARTITION BY plain) AS group_size
  FROM d WINDOW g AS (PARTITION BY plain ORDER BY length(text) DESC, doc_id NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, kept, sha256(plain) AS text_sha256 FROM r
"""


def mixture(spark, sf):
    return mixing.drawn(*mixing.mix(_table(spark, sf, "documents"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies"
    )


def neighbours(spark, sf):
    return posting_lists.search(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def phrases(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"))


PHRASES_SQL = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang HAVING sum(len(w)) > 0),
f AS (
  SELECT lang, k AS words, phrase, count(*) AS a FROM (
    SELECT lang, k, unnest(list_transform(range(1, (len(w) - k + 2)::BIGINT),
      lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
c AS (
  SELECT lang, words, phrase, a, string_split(phrase, ' ') AS p, unnest(range(1, words)) AS k
  FROM f WHERE words > 1),
s AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
    ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.p[1 : c.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.p[c.k + 1 : c.words], ' ')),
lowest AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(p[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, words, a, string_split(phrase, ' ') AS p, unnest(range(2, words)) AS m
        FROM f WHERE words > 2), (VALUES (1), (2), (3)) AS places(i)
  WHERE i + m - 1 <= words GROUP BY ALL),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inner_phrases i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * lowest.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INTEGER AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


def hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf, "embeddings")
    return zone_maps.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


QUERIES = {
    "op1_near_duplicates": near_duplicates,
    "op2_pieces": pieces,
    "op3_secrets": secrets,
    "op4_line_dedup": lines,
    "op5_top_inner_products": nearest,
    "op6_toxicity": toxic,
    "op7_revisits": revisits,
    "op8_url_verdicts": url_verdicts,
    "op9_exact_duplicates": exact_duplicates,
    "op10_mixture": mixture,
    "op11_neighbours": neighbours,
    "op12_collocations": phrases,
    "op13_hard_negatives": hard_negatives,
}

ORACLE_SQL = {
    "op7_revisits": REVISITS_SQL,
    "op9_exact_duplicates": EXACT_SQL,
    "op12_collocations": PHRASES_SQL,
}
