"""Queries over text: tokens, BM25, hybrid search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..indexes.postings import TextIndex
from ..indexes.vectors import VectorIndex
from ..operators.bm25 import bm25_search, match_against, with_bm25
from ..operators.hybrid import Body, hybrid_search, search_hybrid
from ..session import shared_dir, spread
from ..sources.schema import DataType, field, table_schema
from ..store import Store
from .registry import DIGITS, SQL_VECTOR, query, query_vector, read

SEARCH_TEXT = "the history of the people"
SQL_TOKENS = (
    "regexp_extract_all(regexp_replace(lower(coalesce({0}, '')), '([\\x{{4E00}}-\\x{{9FFF}}])', ' \\1 ', 'g'), "
    "'[\\p{{L}}\\p{{N}}]+')"
)


def bm25_ctes(name: str, column: str, text: str, table: str = "documents") -> str:
    """CTE ``<name>`` (doc_id, score): unrounded BM25 of a SQL text expression."""
    return f"""
    {name}_t AS (SELECT doc_id, {SQL_TOKENS.format(column)} AS t FROM {table}),
    {name}_n AS (SELECT count(*)::DOUBLE AS n, avg(len(t)) AS mean_length FROM {name}_t),
    {name}_q AS (SELECT DISTINCT unnest({SQL_TOKENS.format(text)}) AS term),
    {name}_f AS (SELECT doc_id, term, count(*)::DOUBLE AS tf, any_value(length)::DOUBLE AS length
                 FROM (SELECT doc_id, len(t) AS length, unnest(t) AS term FROM {name}_t)
                 WHERE term IN (SELECT term FROM {name}_q) GROUP BY doc_id, term),
    {name}_d AS (SELECT term, count(*)::DOUBLE AS df FROM {name}_f GROUP BY term),
    {name} AS (SELECT doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                                  / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))) AS score
               FROM {name}_f JOIN {name}_d USING (term), {name}_n GROUP BY doc_id)"""


TEXT_LITERAL = f"'{SEARCH_TEXT}'"
BENCHMARK_TEXT = "(SELECT text FROM benchmark WHERE item_id = 0)"
SCORES = "WITH " + bm25_ctes("s", "text", TEXT_LITERAL)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents")


def benchmark_text(spark: SparkSession, folder: str) -> str:
    return read(spark, folder, "benchmark").filter("item_id = 0").first()["text"]


@query("tokens", f"SELECT doc_id, array_to_string({SQL_TOKENS.format('text')}, ' ') AS tokens FROM documents")
def all_tokens(spark, folder):
    docs = spread(documents(spark, folder).select("doc_id", "text"))
    return docs.select("doc_id", F.array_join(tokens("text"), " ").alias("tokens"))


@query("bm25_top", SCORES + " SELECT doc_id FROM s ORDER BY round(score, 6) DESC, doc_id LIMIT 10")
def bm25_top(spark, folder):
    return bm25_search(documents(spark, folder), SEARCH_TEXT, "text", key="doc_id", names=["doc_id"])


@query(
    "bm25_score",
    "WITH " + bm25_ctes("s", "text", BENCHMARK_TEXT)
    + " SELECT doc_id, round(score, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 10",
)
def bm25_score(spark, folder):
    return bm25_search(
        documents(spark, folder), benchmark_text(spark, folder), "text", key="doc_id", names=["doc_id"], with_score=True
    )


@query(
    "bm25_threshold",
    SCORES
    + """ SELECT doc_id, lang, round(score, 6) AS score FROM s JOIN documents USING (doc_id)
          WHERE lang = 'en' AND round(score, 6) >= 0.9 ORDER BY score DESC, doc_id LIMIT 100""",
)
def bm25_threshold(spark, folder):
    return bm25_search(
        documents(spark, folder),
        SEARCH_TEXT,
        "text",
        100,
        key="doc_id",
        where="lang = 'en'",
        threshold=0.9,
        names=["doc_id", "lang"],
        with_score=True,
    )


def blocked(spark: SparkSession, folder: str) -> TextIndex:
    return TextIndex.build(documents(spark, folder), shared_dir(spark), "doc_id", "text", block_documents=16)


@query("bm25_blocks", SCORES + " SELECT doc_id, round(score, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 10")
def bm25_blocks(spark, folder):
    """Blocks of documents whose bound lies below the tenth score are passed over."""
    return blocked(spark, folder).search(documents(spark, folder), SEARCH_TEXT, 10, names=["doc_id"], with_score=True)


@query(
    "bm25_blocks_filtered",
    SCORES
    + """ SELECT doc_id, lang, round(score, 6) AS score FROM s JOIN documents USING (doc_id)
          WHERE lang = 'fr' AND round(score, 6) >= 0.5 ORDER BY score DESC, doc_id LIMIT 30""",
)
def bm25_blocks_filtered(spark, folder):
    return blocked(spark, folder).search(
        documents(spark, folder), SEARCH_TEXT, 30, where="lang = 'fr'", threshold=0.5, names=["doc_id", "lang"], with_score=True
    )


@query(
    "bm25_all_rows",
    SCORES + " SELECT doc_id, round(coalesce(score, 0), 6) AS score FROM documents LEFT JOIN s USING (doc_id)",
)
def bm25_all_rows(spark, folder):
    """The score of every row, 0.0 where no term occurs."""
    scored = with_bm25(documents(spark, folder), [("text", SEARCH_TEXT)], score="score")
    return scored.select("doc_id", "score")


@query(
    "bm25_multi",
    "WITH " + bm25_ctes("a", "text", TEXT_LITERAL) + "," + bm25_ctes("b", "source", "'src3 src7'")
    + """ SELECT doc_id, round(coalesce(a.score, 0) + coalesce(b.score, 0), 6) AS score
          FROM a FULL JOIN b USING (doc_id) ORDER BY score DESC, doc_id LIMIT 20""",
)
def bm25_multi(spark, folder):
    scored = with_bm25(documents(spark, folder), [("text", SEARCH_TEXT), ("source", "src3 src7")], score="score", matched="hit")
    best = scored.select("doc_id", "score", "hit").orderBy(F.desc("score"), F.desc("hit"), "doc_id").limit(20)
    return best.filter("hit").select("doc_id", "score")


@query(
    "bm25_columns",
    "WITH " + bm25_ctes("s", "concat_ws(' ', lang, source, text)", "'fr src3 history'")
    + " SELECT doc_id, round(score, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 10",
)
def bm25_columns(spark, folder):
    return match_against(
        documents(spark, folder), "fr src3 history", ["lang", "source", "text"], key="doc_id", names=["doc_id"], with_score=True
    )


# --- the index ---------------------------------------------------------------------

SQL_POSTINGS = f"""
    WITH cut AS (SELECT doc_id, {SQL_TOKENS.format('text')} AS t FROM documents),
    words AS (SELECT doc_id, len(t) AS length, unnest(t) AS term FROM cut)"""


def text_index(spark: SparkSession, df: DataFrame) -> TextIndex:
    return TextIndex.build(df, shared_dir(spark), "doc_id", "text")


@query(
    "bm25_index",
    SQL_POSTINGS + " SELECT doc_id, term, count(*) AS tf, any_value(length)::INT AS length FROM words GROUP BY doc_id, term",
)
def bm25_index(spark, folder):
    return text_index(spark, documents(spark, folder)).postings().select("doc_id", "term", "tf", "length")


@query(
    "bm25_index_search",
    SCORES
    + """ SELECT doc_id, source, round(score, 6) AS score FROM s JOIN documents USING (doc_id)
          WHERE lang <> 'fr' ORDER BY score DESC, doc_id LIMIT 25""",
)
def bm25_index_search(spark, folder):
    docs = documents(spark, folder)
    return text_index(spark, docs).search(
        docs, SEARCH_TEXT, 25, where="lang <> 'fr'", names=["doc_id", "source"], with_score=True
    )


@query(
    "bm25_refresh",
    SQL_POSTINGS
    + " SELECT term, count(DISTINCT doc_id) AS df, count(*)::BIGINT AS cf FROM words GROUP BY term",
)
def bm25_refresh(spark, folder):
    """An index over part of the texts, some of them older versions, brought up to date."""
    docs = documents(spark, folder)
    old = docs.filter("lang <> 'de'").withColumn("text", F.when(F.col("lang") == "fr", F.upper("source")).otherwise(F.col("text")))
    return text_index(spark, old).refresh(docs).terms().select("term", "df", "cf")


# --- hybrid --------------------------------------------------------------------------


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, with the vector of the same number if there is one."""
    vectors = read(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return spread(documents(spark, folder).select("doc_id", "lang", "source", "text")).join(vectors, "doc_id", "left")


def search_body(spark: SparkSession, folder: str) -> dict:
    return {
        "query": {
            "bool": {
                "must": [{"match": {"text": SEARCH_TEXT}}],
                "should": [{"match_phrase": {"source": "src3"}}, {"term": {"lang": "en"}}],
                "must_not": [{"term": {"lang": "fr"}}],
            }
        },
        "knn": {
            "field": "embedding",
            "query_vector": query_vector(spark, folder),
            "filter": {"terms": {"lang": ["en", "de", "fr"]}},
            "k": 3,
        },
        "hybrid_weights": {"knn": 0.4, "bm25": 0.6},
        "size": 15,
    }


SQL_CORPUS = f"""
    WITH base AS (SELECT doc_id, lang, source, text,
                         round(list_distance(embedding::DOUBLE[], {SQL_VECTOR}), 6) AS dist
                  FROM documents LEFT JOIN embeddings ON doc_id = vec_id),"""
SQL_BRANCHES = (
    SQL_CORPUS
    + bm25_ctes("a", "text", TEXT_LITERAL, "base")
    + ","
    + bm25_ctes("b", "source", "'src3'", "base")
    + """,
    scores AS (SELECT doc_id, round(coalesce(a.score, 0) + coalesce(b.score, 0), 6) AS score
               FROM a FULL JOIN b USING (doc_id)),
    allowed AS (SELECT * FROM base WHERE lang <> 'fr' AND lang IN ('en', 'de', 'fr')),
    near AS (SELECT doc_id, dist AS _distance, 0.0::DOUBLE AS _score FROM allowed ORDER BY dist NULLS LAST, doc_id LIMIT 15),
    matching AS (SELECT doc_id, 0.0::DOUBLE AS _distance, score AS _score FROM allowed JOIN scores USING (doc_id)
                 ORDER BY score DESC, doc_id LIMIT 15),
    merged AS (SELECT doc_id, min(_distance) AS _distance, max(_score) AS _score
               FROM (SELECT * FROM near UNION ALL SELECT * FROM matching) GROUP BY doc_id)"""
)


@query(
    "hybrid_written",
    SQL_BRANCHES
    + """ SELECT doc_id, lang, _distance, _score, round(_score * 0.6 - _distance * 0.4, 6) AS hybrid_score
          FROM merged JOIN base USING (doc_id) ORDER BY hybrid_score DESC NULLS LAST, doc_id LIMIT 15""",
)
def hybrid_written(spark, folder):
    found = hybrid_search(corpus(spark, folder), search_body(spark, folder), key="doc_id", digits=DIGITS)
    return found.select("doc_id", "lang", "_distance", "_score", "hybrid_score")


@query(
    "hybrid_true",
    SQL_BRANCHES
    + """ SELECT doc_id, lang, dist AS _distance, coalesce(score, 0) AS _score,
                 round(coalesce(score, 0) * 0.6 - dist * 0.4, 6) AS hybrid_score
          FROM merged JOIN base USING (doc_id) LEFT JOIN scores USING (doc_id)
          ORDER BY hybrid_score DESC NULLS LAST, doc_id LIMIT 15""",
)
def hybrid_true(spark, folder):
    body = search_body(spark, folder)
    found = hybrid_search(corpus(spark, folder), body, key="doc_id", merge="true_values", digits=DIGITS)
    return found.select("doc_id", "lang", "_distance", "_score", "hybrid_score")


@query(
    "hybrid_index",
    SQL_BRANCHES
    + """ SELECT doc_id, lang, _distance, _score, round(_score * 0.6 - _distance * 0.4, 6) AS hybrid_score
          FROM merged JOIN base USING (doc_id) ORDER BY hybrid_score DESC NULLS LAST, doc_id LIMIT 15""",
)
def hybrid_index(spark, folder):
    """The text branch answered by stored postings."""
    rows = corpus(spark, folder)
    indexes = {c: TextIndex.build(rows, shared_dir(spark), "doc_id", c) for c in ("text", "source")}
    found = hybrid_search(rows, search_body(spark, folder), key="doc_id", digits=DIGITS, text_indexes=indexes)
    return found.select("doc_id", "lang", "_distance", "_score", "hybrid_score")


@query(
    "hybrid_vector_index",
    SQL_BRANCHES
    + """ SELECT doc_id, lang, _distance, _score, round(_score * 0.6 - _distance * 0.4, 6) AS hybrid_score
          FROM merged JOIN base USING (doc_id) ORDER BY hybrid_score DESC NULLS LAST, doc_id LIMIT 15""",
)
def hybrid_vector_index(spark, folder):
    """Both branches answered by indexes; all cells are read, so the result is exact."""
    rows = corpus(spark, folder)
    near = VectorIndex.build(rows, shared_dir(spark), "doc_id", "embedding", nlist=8)
    words = {c: TextIndex.build(rows, shared_dir(spark), "doc_id", c) for c in ("text", "source")}
    body = search_body(spark, folder)
    found = hybrid_search(rows, body, key="doc_id", digits=DIGITS, text_indexes=words, vector_index=near, nprobe=near.nlist)
    return found.select("doc_id", "lang", "_distance", "_score", "hybrid_score")


@query(
    "hybrid_body",
    f"""WITH near AS (SELECT vec_id AS doc_id, round(list_distance(embedding::DOUBLE[], {SQL_VECTOR}), 6) AS _distance FROM embeddings)
        SELECT doc_id, _distance, 0.0::DOUBLE AS _score, round(0.0 * 0.5 - _distance * 0.5, 6) AS hybrid_score
        FROM near JOIN documents USING (doc_id) ORDER BY _distance, doc_id LIMIT 10""",
)
def hybrid_body(spark, folder):
    """A search by a body without weights, size and query: the defaults rank; bad bodies are refused."""
    near = {"field": "embedding", "query_vector": query_vector(spark, folder)}
    for bad in ({}, {"knn": {**near, "query_vector": "x"}}, {"knn": near, "size": True}, {"knn": near, "hybrid_weights": {"bm25": -1}}):
        try:
            Body.read(bad, (0.5, 0.5))
        except ValueError:
            continue
        raise AssertionError(f"accepted {bad}")
    return hybrid_search(corpus(spark, folder), {"knn": near}, key="doc_id", digits=DIGITS).select("doc_id", "_distance", "_score", "hybrid_score")


def sql_linear(sign: str) -> str:
    return (
        SQL_CORPUS
        + bm25_ctes("s", "text", TEXT_LITERAL, "base")
        + f""",
        rows AS (SELECT doc_id, dist AS vec_distance, round(coalesce(score, 0), 6) AS bm25_score
                 FROM base LEFT JOIN s USING (doc_id) WHERE lang <> 'es'),
        ranked AS (SELECT *, round(0.3 * vec_distance {sign} 0.7 * bm25_score, 6) AS blend FROM rows
                   WHERE vec_distance <= 1.5 AND bm25_score >= 0.1)
        SELECT doc_id, vec_distance, bm25_score FROM ranked ORDER BY blend, doc_id LIMIT 10"""
    )


def linear(spark: SparkSession, folder: str, as_written: bool, **options) -> DataFrame:
    return search_hybrid(
        corpus(spark, folder),
        query_vector(spark, folder),
        "embedding",
        SEARCH_TEXT,
        "text",
        key="doc_id",
        alpha=0.3,
        where="lang <> 'es'",
        distance_threshold=1.5,
        bm25_score_threshold=0.1,
        names=["doc_id"],
        with_dist=True,
        with_bm25_score=True,
        as_written=as_written,
        digits=DIGITS,
        **options,
    )


@query("hybrid_linear", sql_linear("-"))
def hybrid_linear(spark, folder):
    return linear(spark, folder, False)


@query("hybrid_linear_plus", sql_linear("+"))
def hybrid_linear_plus(spark, folder):
    return linear(spark, folder, True)


@query("hybrid_linear_index", sql_linear("-"))
def hybrid_linear_index(spark, folder):
    """The text score from postings."""
    rows = corpus(spark, folder)
    index = TextIndex.build(rows, shared_dir(spark), "doc_id", "text")
    return linear(spark, folder, False, text_index=index)


# --- indexes that live with their table ------------------------------------------------


def text_store(spark: SparkSession) -> Store:
    store = Store(spark, shared_dir(spark))
    fields = [field("doc_id", DataType.INT64, primary=True)]
    fields += [field(c, DataType.STRING, nullable=True) for c in ("lang", "source", "text")]
    indexes = [{"name": "words", "column": "text", "kind": "text"}, {"name": "all", "column": ["lang", "source", "text"], "kind": "text"}]
    store.create_collection("docs", schema=table_schema(fields), index_params=indexes)
    return store


SQL_LATEST = f"""
    WITH latest AS (SELECT doc_id, lang, source, text FROM documents WHERE lang <> 'de' AND doc_id % 7 <> 0),
    {bm25_ctes("s", "text", TEXT_LITERAL, "latest")}
    SELECT doc_id, round(score, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 20"""


def changed(spark: SparkSession, folder: str) -> Store:
    """Rows indexed, then changed, deleted and added."""
    store, docs = text_store(spark), documents(spark, folder).select("doc_id", "lang", "source", "text")
    early = docs.filter("doc_id % 5 <> 1").withColumn("text", F.when(F.col("lang") == "fr", F.upper("source")).otherwise(F.col("text")))
    store.insert("docs", early)
    store.rebuild_index("docs", "words")
    store.upsert("docs", docs.filter("lang = 'fr' AND doc_id % 5 <> 1"))
    store.delete("docs", where="lang = 'de'")
    store.insert("docs", docs.filter("doc_id % 5 = 1 AND lang <> 'de'"))
    store.delete("docs", where="doc_id % 7 = 0")
    return store


@query("bm25_after_delete", SQL_LATEST)
def bm25_after_delete(spark, folder):
    """Search through an index that is behind its table."""
    return changed(spark, folder).bm25_search("docs", SEARCH_TEXT, "text", 20, index="words", names=["doc_id"], with_score=True)


@query("bm25_refreshed", SQL_LATEST)
def bm25_refreshed(spark, folder):
    """The same after an incremental refresh."""
    store = changed(spark, folder)
    store.rebuild_index("docs", "words", full=False)
    return store.bm25_search("docs", SEARCH_TEXT, "text", 20, index="words", names=["doc_id"], with_score=True)


@query(
    "bm25_columns_index",
    "WITH " + bm25_ctes("s", "concat_ws(' ', lang, source, text)", "'fr src3 history'")
    + " SELECT doc_id, round(score, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 10",
)
def bm25_columns_index(spark, folder):
    """Several columns as one text, through an index made with the table."""
    store = text_store(spark)
    store.insert("docs", documents(spark, folder).select("doc_id", "lang", "source", "text"))
    store.rebuild_index("docs", "all", full=False)
    return store.match_against("docs", "fr src3 history", ["lang", "source", "text"], names=["doc_id"], with_score=True, index="all")
