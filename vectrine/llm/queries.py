"""The registered queries of the training-data operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .oracles import OP1, OP2, OP6, OP11, OP13

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_pii", OP1)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from .pii import pii_report

    return pii_report(table(spark, folder, "documents"))


@query("op2_quality_rules", OP2)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from .quality_rules import judge_quality

    return judge_quality(table(spark, folder, "documents"))


@query("op3_simhash_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"), shingle=3, radius=2)


# Pages have no fetch time and the tables no list, so both are derived from them: a
# page is fetched at a second of 2024 that follows from its id, and every labelled page
# makes two entries at that time. A toxic page puts its domain on the list "toxic", any
# other takes it off; a bad page puts its host's first directory on "quality".
FETCHED = "timestamp_seconds(1704067200 + pmod(page_id * 7919, 31536000))"


def url_entries(pages: DataFrame, labels: DataFrame) -> DataFrame:
    from .url_filters import host_of, path_of

    host = host_of(F.col("url"))
    directory = F.concat(host, F.lit("/"), F.split_part(path_of(F.col("url")), F.lit("/"), F.lit(2)))
    known = pages.select("page_id", "url", "fetched").join(labels, F.col("page_id") == F.col("doc_id")).filter(host != "")
    toxic = known.select(F.lit("toxic").alias("list"), F.regexp_replace(host, r"^(www|m|blog)\.", "").alias("pattern"), F.col("fetched").alias("since"), (F.col("toxic") == 1).alias("added"))
    bad = known.select(F.lit("quality").alias("list"), directory.alias("pattern"), F.col("fetched").alias("since"), (F.col("quality") == 0).alias("added"))
    return toxic.unionByName(bad)


OP4_SQL = r"""
WITH captures AS (
  SELECT page_id, url, make_timestamp((1704067200 + (page_id * 7919) % 31536000) * 1000000) AS fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
entries AS (
  SELECT list, pattern, since, bool_or(added) AS added FROM (
    SELECT 'toxic' AS list, regexp_replace(host, '^(www|m|blog)\.', '') AS pattern, fetched AS since, toxic = 1 AS added
    FROM captures JOIN labels ON page_id = doc_id WHERE host <> ''
    UNION ALL
    SELECT 'quality', host || '/' || split_part(path, '/', 2), fetched, quality = 0
    FROM captures JOIN labels ON page_id = doc_id WHERE host <> '')
  GROUP BY ALL),
intervals AS (
  SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM entries),
asked AS (
  SELECT DISTINCT page_id, url, fetched, pattern FROM (
    SELECT page_id, url, fetched, unnest(list_concat(
      list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(1, len(list_filter(string_split(path, '/'), lambda s: s <> '')) + 1),
        lambda i: host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda s: s <> '')[1:i], '/')))) AS pattern
    FROM captures WHERE host <> '')),
found AS (
  SELECT page_id, url, fetched, list(DISTINCT list || ':' || pattern ORDER BY list || ':' || pattern) AS names, min(since) AS listed_since
  FROM asked JOIN intervals USING (pattern)
  WHERE added AND fetched >= since AND (until IS NULL OR fetched < until)
  GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched, coalesce(len(names), 0)::BIGINT AS n_active, coalesce(array_to_string(names, ','), '') AS active,
  listed_since, names IS NOT NULL AS blocked
FROM captures c LEFT JOIN found f ON f.page_id = c.page_id AND f.url = c.url
"""


@query("op4_url_filters", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from .url_filters import filter_urls

    pages = table(spark, folder, "pages").select("page_id", "url", F.expr(FETCHED).alias("fetched"))
    return filter_urls(pages, url_entries(pages, table(spark, folder, "labels")))


@query("op5_quality_classifier")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from .classifier import score_quality

    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_decontamination", OP6)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from .decontaminate import contamination_report

    return contamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def vocabulary() -> str:
    """Path of the vocabulary file that the queries use."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, folder, "documents"), vocabulary())


@query("op8_token_files")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from vectrine.session import shared_dir

    from .token_files import read_token_files, write_token_files

    files = shared_dir(spark)
    write_token_files(table(spark, folder, "documents"), files, vocabulary())
    return read_token_files(spark, files)


@query("op9_html_extraction")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from .html_extract import main_text

    return main_text(table(spark, folder, "pages"))


@query("op10_sharding")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from .sharding import assign_shards

    return assign_shards(table(spark, folder, "documents"))


@query("op11_substring_dedup", OP11)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from .substrings import repeat_report

    return repeat_report(table(spark, folder, "documents"))


@query("op12_feast_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, folder, "embeddings"))


@query("op13_prefix_trie", OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from .prefix_trie import trie

    return trie(table(spark, folder, "conversations"))
