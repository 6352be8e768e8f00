"""Queries over vectors: distances, top-k, joins, indexes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_vectors, sparse_from_text, sparse_to_text, split_valid, vector_to_text
from ..functions.sqlfuncs import run_sql
from ..functions.text import query_terms, term_counts
from ..functions.vectors import binarise, metric
from ..indexes.sparse import SparseIndex
from ..indexes.vectors import CELL, GROUP, VectorIndex
from ..operators.filters import vector_equals
from ..operators.knn import knn, search
from ..operators.knn_join import knn_join
from ..session import shared_dir, spread
from ..sources.schema import DataType, field, table_schema
from ..store import Store
from ..sources.partitioning import MAXVALUE, RangePartition
from .registry import DIGITS, ORACLES, SQL_VECTOR, query, query_vector, read
from .text_queries import SEARCH_TEXT, SQL_TOKENS

TOP = dict(key="vec_id", names=["vec_id"], with_score=True, digits=DIGITS)
L2 = f"round(list_distance(embedding::DOUBLE[], {SQL_VECTOR}), 6)"
COSINE = f"round(list_cosine_distance(embedding::DOUBLE[], {SQL_VECTOR}), 6)"
IP = f"round(list_inner_product(embedding::DOUBLE[], {SQL_VECTOR}), 6)"


def top_sql(score: str, k: int = 10, where: str = "TRUE", order: str = "ASC", out: str = "vec_id, score") -> str:
    return f"""
        SELECT {out} FROM (
            SELECT *, CASE WHEN isnan(d) THEN NULL ELSE d END AS score
            FROM (SELECT *, {score} AS d FROM embeddings)
        ) WHERE {where} ORDER BY score {order} NULLS LAST, vec_id LIMIT {k}"""


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "embeddings")


@query("knn_l2", top_sql(L2))
def knn_l2(spark, folder):
    return knn(embeddings(spark, folder), query_vector(spark, folder), "embedding", "l2", **TOP)


@query("knn_cosine", top_sql(COSINE))
def knn_cosine(spark, folder):
    return knn(embeddings(spark, folder), query_vector(spark, folder), "embedding", "cosine", **TOP)


@query("knn_ip", top_sql(IP, order="DESC"))
def knn_ip(spark, folder):
    return knn(embeddings(spark, folder), query_vector(spark, folder), "embedding", "ip", **TOP)


SQL_BITS = "list_transform({0}, lambda x: CASE WHEN x > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END)"


@query(
    "knn_hamming",
    top_sql(
        f"round(list_sum(list_transform(list_zip({SQL_BITS.format('embedding')}, {SQL_BITS.format(SQL_VECTOR)}), "
        "lambda p: abs(p[1] - p[2]))), 6)"
    ),
)
def knn_hamming(spark, folder):
    bits = embeddings(spark, folder).withColumn("bits", binarise("embedding"))
    wanted = [v > 0 for v in query_vector(spark, folder)]
    return knn(bits, wanted, "bits", "hamming", **TOP)


@query("knn_threshold", top_sql(L2, k=50, where="score <= 1.2"))
def knn_threshold(spark, folder):
    return knn(embeddings(spark, folder), query_vector(spark, folder), "embedding", k=50, threshold=1.2, **TOP)


@query("knn_prefilter", top_sql(L2, where="label = 3"))
def knn_prefilter(spark, folder):
    return knn(embeddings(spark, folder), query_vector(spark, folder), "embedding", where="label = 3", **TOP)


@query("knn_postfilter", f"SELECT vec_id, score FROM ({top_sql(L2, k=40, out='*')}) WHERE label <> 3 ORDER BY score, vec_id LIMIT 10")
def knn_postfilter(spark, folder):
    """A single pass over the best 40 candidates."""
    return knn(
        embeddings(spark, folder), query_vector(spark, folder), "embedding", where="label <> 3", post_filter=True, expand=4, **TOP
    )


@query("knn_postfilter_all", top_sql(L2, where="label = 3 AND vec_id % 5 = 2"))
def knn_postfilter_all(spark, folder):
    """As many rows as asked for, though few of the nearest pass."""
    return knn(
        embeddings(spark, folder), query_vector(spark, folder), "embedding", where="label = 3 AND vec_id % 5 = 2", post_filter=True, **TOP
    )


BY_LABEL = RangePartition([("low", 3), ("mid", 6), ("high", MAXVALUE)], expr="label")


@query("knn_partition", top_sql(L2, where="label >= 3"))
def knn_partition(spark, folder):
    labelled = BY_LABEL.assign(embeddings(spark, folder))
    return knn(labelled, query_vector(spark, folder), "embedding", partitions=["mid", "high"], **TOP)


@query("knn_post_ann", top_sql(COSINE, k=5, out="vec_id, label, score"))
def knn_post_ann(spark, folder):
    return knn(
        embeddings(spark, folder),
        query_vector(spark, folder),
        "embedding",
        "cosine",
        5,
        key="vec_id",
        names=["vec_id", "label"],
        with_score=True,
        digits=DIGITS,
    )


@query("knn_search_metric", top_sql(COSINE, k=7))
def knn_search_metric(spark, folder):
    return search(
        embeddings(spark, folder),
        query_vector(spark, folder),
        "embedding",
        search_params={"metric_type": "COSINE"},
        limit=7,
        **TOP,
    )


def sql_batch(score: str, order: str = "ASC") -> str:
    return f"""
        WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings
                   WHERE vec_id IN (SELECT item_id FROM benchmark)),
        c AS (SELECT query_id, vec_id, round({score}, 6) AS x FROM q, embeddings),
        d AS (SELECT query_id, vec_id, CASE WHEN isnan(x) THEN NULL ELSE x END AS score FROM c),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order} NULLS LAST, vec_id) AS rank FROM d)
        SELECT query_id, vec_id, score, rank FROM r WHERE rank <= 10"""


def batch(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    """Every benchmark item's vector against all vectors."""
    points = embeddings(spark, folder)
    items = read(spark, folder, "benchmark").select(F.col("item_id").alias("vec_id"))
    wanted = points.join(items, "vec_id", "left_semi")
    return knn_join(
        wanted,
        points,
        query_key="vec_id",
        query_vector="embedding",
        key="vec_id",
        vector="embedding",
        metric=metric,
        digits=DIGITS,
    )


@query("knn_batch", sql_batch("list_distance(embedding::DOUBLE[], qv)"))
def knn_batch(spark, folder):
    return batch(spark, folder, "l2")


@query("knn_batch_cosine", sql_batch("list_cosine_distance(embedding::DOUBLE[], qv)"))
def knn_batch_cosine(spark, folder):
    return batch(spark, folder, "cosine")


@query("knn_batch_ip", sql_batch("list_inner_product(embedding::DOUBLE[], qv)", "DESC"))
def knn_batch_ip(spark, folder):
    return batch(spark, folder, "ip")


# Vectors that lack their last number, are NULL, or begin with NaN, beside the whole ones.
SQL_MIXED = """
    mixed AS (SELECT vec_id, label, label AS cell, embedding::DOUBLE[] AS v FROM embeddings
              UNION ALL SELECT vec_id + 1000000, label, label, (embedding::DOUBLE[])[1:63] FROM embeddings WHERE vec_id % 10 = 0
              UNION ALL SELECT vec_id + 2000000, label, label, NULL FROM embeddings WHERE vec_id % 10 = 1
              UNION ALL SELECT vec_id + 3000000, label, label, list_prepend('nan'::DOUBLE, (embedding::DOUBLE[])[2:]) FROM embeddings
                        WHERE vec_id % 10 = 2)"""


def mixed_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    whole = embeddings(spark, folder).select("vec_id", "label", F.col("label").alias("cell"), "embedding")
    nan = F.array(F.lit(float("nan")).cast("float"))
    changes = [
        (1_000_000, 0, F.slice("embedding", 1, 63)),
        (2_000_000, 1, F.lit(None).cast("array<float>")),
        (3_000_000, 2, F.concat(nan, F.slice("embedding", 2, 63))),
    ]
    odd = [whole.filter(F.col("vec_id") % 10 == d).withColumns({"embedding": v, "vec_id": F.col("vec_id") + n}) for n, d, v in changes]
    return reduce(DataFrame.unionByName, odd, whole)


@query(
    "knn_batch_mixed",
    f"""WITH {SQL_MIXED},
        q AS (SELECT vec_id AS query_id, v AS qv FROM mixed
              WHERE vec_id % 1000000 IN (SELECT item_id FROM benchmark) AND vec_id % 1000000 < 40),
        d AS (SELECT query_id, vec_id, CASE WHEN len(v) = len(qv) THEN round(list_distance(v, qv), 6) END AS x FROM q, mixed),
        s AS (SELECT query_id, vec_id, CASE WHEN isnan(x) THEN NULL ELSE x END AS score FROM d),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score NULLS LAST, vec_id) AS rank FROM s)
        SELECT query_id, vec_id, score, rank FROM r WHERE rank <= 10""",
)
def knn_batch_mixed(spark, folder):
    """Malformed vectors on both sides: a query is scored by its own length."""
    points = mixed_embeddings(spark, folder)
    items = read(spark, folder, "benchmark").select((F.col("item_id")).alias("m"))
    base = F.col("vec_id") % 1_000_000
    wanted = points.join(items, (base == F.col("m")) & (base < 40), "left_semi")
    return knn_join(wanted, points, query_key="vec_id", query_vector="embedding", key="vec_id", vector="embedding", digits=DIGITS)


@query("knn_batch_blocks", sql_batch("list_distance(embedding::DOUBLE[], qv)"))
def knn_batch_blocks(spark, folder):
    """More queries than a broadcast may hold: blocks of them meet groups of the corpus."""
    points = embeddings(spark, folder)
    items = read(spark, folder, "benchmark").select(F.col("item_id").alias("vec_id"))
    wanted = points.join(items, "vec_id", "left_semi")
    return knn_join(
        wanted, points, query_key="vec_id", query_vector="embedding", key="vec_id", vector="embedding", digits=DIGITS, block_bytes=8 * 64 * 150
    )


# --- output columns ----------------------------------------------------------------


@query("proj_names", top_sql(L2, out="label, vec_id"))
def proj_names(spark, folder):
    return knn(embeddings(spark, folder), query_vector(spark, folder), "embedding", key="vec_id", names=["label", "vec_id"], digits=DIGITS)


@query("proj_exprs", top_sql(L2, out="vec_id + 1000 AS shifted, concat('label_', label) AS tag"))
def proj_exprs(spark, folder):
    return knn(
        embeddings(spark, folder),
        query_vector(spark, folder),
        "embedding",
        key="vec_id",
        names=["vec_id"],
        columns=[(F.col("vec_id") + 1000).alias("shifted"), "concat('label_', label) as tag"],
        digits=DIGITS,
    )


@query("proj_extra", top_sql(L2, out="vec_id, label * 10 AS tens, score"))
def proj_extra(spark, folder):
    return knn(
        embeddings(spark, folder),
        query_vector(spark, folder),
        "embedding",
        key="vec_id",
        names=["vec_id"],
        extra=[(F.col("label") * 10).alias("tens")],
        with_score=True,
        digits=DIGITS,
    )


@query(
    "proj_score",
    f"SELECT vec_id, {L2} AS l2, CASE WHEN isnan({COSINE}) THEN NULL ELSE {COSINE} END AS cosine, {IP} AS ip FROM embeddings",
)
def proj_score(spark, folder):
    from ..functions.vectors import cosine_distance, inner_product, l2_distance

    q = query_vector(spark, folder)
    return embeddings(spark, folder).select(
        "vec_id",
        F.round(l2_distance("embedding", q), DIGITS).alias("l2"),
        F.round(cosine_distance("embedding", q), DIGITS).alias("cosine"),
        F.round(inner_product("embedding", q), DIGITS).alias("ip"),
    )


@query(
    "raw_sql",
    f"SELECT label, count(*) AS n, min({L2}) AS nearest, "
    f"max(CASE WHEN isnan({COSINE}) THEN NULL ELSE {COSINE} END) AS farthest FROM embeddings GROUP BY label",
)
def raw_sql(spark, folder):
    text = """
        SELECT label, count(*) AS n,
               min(round(l2_distance(embedding, :q), 6)) AS nearest,
               max(round(cosine_distance(embedding, :q), 6)) AS farthest
        FROM points GROUP BY label"""
    return run_sql(spark, text, {"points": embeddings(spark, folder)}, {"q": query_vector(spark, folder)})


# --- sparse vectors ------------------------------------------------------------------


def place_of(term: Column) -> Column:
    """A term's place in a sparse vector: 64 bits, so a billion terms hardly ever share one."""
    return F.xxhash64(term)


def sparse_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, v): token counts of each document as a sparse vector, made inside the row."""
    docs = spread(read(spark, folder, "documents").select("doc_id", "text"))
    pairs = F.transform(term_counts("text")["terms"], lambda t: F.struct(place_of(t["term"]).alias("i"), t["tf"].cast("float").alias("x")))
    return docs.select("doc_id", F.map_from_entries(pairs).alias("v"))


def sparse_query(spark: SparkSession) -> dict[int, float]:
    terms = query_terms(spark, SEARCH_TEXT)
    places = spark.range(1).select(F.array(*[place_of(F.lit(t)) for t in terms])).first()[0]
    return {p: 0.5 + i for i, p in enumerate(places)}


SQL_SPARSE = f"""
    WITH words AS (SELECT doc_id, unnest({SQL_TOKENS.format('text')}) AS token FROM documents),
    a AS (SELECT doc_id, token, count(*)::DOUBLE AS x FROM words GROUP BY ALL),
    terms AS (SELECT unnest({SQL_TOKENS.format("'" + SEARCH_TEXT + "'")}) AS token),
    places AS (SELECT token, row_number() OVER () AS p FROM terms),
    q AS (SELECT token, 0.5 + (row_number() OVER (ORDER BY min(p)) - 1) AS y FROM places GROUP BY token),
    qn AS (SELECT sum(y * y)::DOUBLE AS qq FROM q),
    s AS (SELECT doc_id, coalesce(sum(x * y), 0)::DOUBLE AS ip, coalesce(sum(x * x), 0) AS aa
          FROM documents LEFT JOIN a USING (doc_id) LEFT JOIN q USING (token) GROUP BY doc_id)"""


def sparse_top(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    return knn(sparse_documents(spark, folder), sparse_query(spark), "v", metric, key="doc_id", names=["doc_id"], with_score=True, digits=DIGITS)


@query("sparse_dot", SQL_SPARSE + " SELECT doc_id, round(ip, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 10")
def sparse_dot(spark, folder):
    return sparse_top(spark, folder, "ip")


@query(
    "sparse_l2",
    SQL_SPARSE + " SELECT doc_id, round(sqrt(aa + qq - 2 * ip), 6) AS score FROM s, qn ORDER BY score, doc_id LIMIT 10",
)
def sparse_l2(spark, folder):
    return sparse_top(spark, folder, "l2")


@query(
    "sparse_cosine",
    SQL_SPARSE
    + """ SELECT doc_id, CASE WHEN aa > 0 THEN round(1 - ip / (sqrt(aa) * sqrt(qq)), 6) END AS score FROM s, qn
          ORDER BY score NULLS LAST, doc_id LIMIT 10""",
)
def sparse_cosine(spark, folder):
    return sparse_top(spark, folder, "cosine")


def sparse_listed(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    rows = sparse_documents(spark, folder)
    index = SparseIndex.build(rows, shared_dir(spark), "doc_id", "v")
    return index.search(rows, sparse_query(spark), metric, names=["doc_id"], with_score=True, digits=DIGITS)


@query("sparse_dot_lists", ORACLES["sparse_dot"])
def sparse_dot_lists(spark, folder):
    """The lists of the query's numbers; the long ones only for rows of the others."""
    return sparse_listed(spark, folder, "ip")


@query("sparse_l2_lists", ORACLES["sparse_l2"])
def sparse_l2_lists(spark, folder):
    return sparse_listed(spark, folder, "l2")


@query("sparse_cosine_lists", ORACLES["sparse_cosine"])
def sparse_cosine_lists(spark, folder):
    return sparse_listed(spark, folder, "cosine")


# --- text forms and checks -------------------------------------------------------------


@query("vec_round_trip", "SELECT vec_id, embedding::DOUBLE[] AS embedding, len(embedding) AS n FROM embeddings")
def vec_round_trip(spark, folder):
    """Every vector to its text, its bytes, and back."""
    rows = embeddings(spark, folder).select("vec_id", vector_to_text("embedding").alias("text"))
    texts, _ = decode_vectors(rows.filter("vec_id % 2 = 0"), "text", "embedding", 64)
    raw, _ = decode_vectors(rows.filter("vec_id % 2 <> 0").withColumn("text", F.col("text").cast("binary")), "text", "embedding", 64)
    both = texts.select("vec_id", "embedding").unionByName(raw.select("vec_id", "embedding"))
    return both.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").cast("long").alias("n"))


@query(
    "sparse_round_trip",
    "SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 4) AS total, len(list_filter(embedding, lambda x: x <> 0)) AS n FROM embeddings",
)
def sparse_round_trip(spark, folder):
    """Every vector as sparse text and back."""
    places = F.transform("embedding", lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    entries = F.filter(places, lambda e: e["x"] != 0)
    text = embeddings(spark, folder).select("vec_id", sparse_to_text(F.map_from_entries(entries)).alias("text"))
    back = text.select("vec_id", sparse_from_text("text").alias("v"))
    total = F.aggregate(F.map_values("v"), F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return back.select("vec_id", F.round(total, 4).alias("total"), F.size("v").cast("long").alias("n"))


@query(
    "split_valid",
    f"""WITH {SQL_MIXED} SELECT vec_id, v IS NULL OR len(v) = 64 AS usable FROM mixed""",
)
def split_usable(spark, folder):
    usable, rest = split_valid(mixed_embeddings(spark, folder), "embedding", 64)
    return usable.select("vec_id", F.lit(True).alias("usable")).unionByName(rest.select("vec_id", F.lit(False).alias("usable")))


@query("vec_equals", f"SELECT vec_id FROM embeddings WHERE embedding::DOUBLE[] = {SQL_VECTOR}")
def vec_equals(spark, folder):
    return embeddings(spark, folder).filter(vector_equals("embedding", query_vector(spark, folder))).select("vec_id")


@query(
    "sql_distances",
    f"""SELECT vec_id, {IP} AS ip, list_sum(list_transform(list_zip({SQL_BITS.format('embedding')}, {SQL_BITS.format(SQL_VECTOR)}),
        lambda p: abs(p[1] - p[2]))) AS bits FROM embeddings""",
)
def sql_distances(spark, folder):
    text = """
        SELECT vec_id, round(inner_product(embedding, :q), 6) AS ip,
               hamming_bool_distance(transform(embedding, x -> x > 0), transform(:q, x -> x > 0)) AS bits FROM vectors_sql"""
    return run_sql(spark, text, {"vectors_sql": embeddings(spark, folder)}, {"q": query_vector(spark, folder)})


@query("metric_names", f"SELECT vec_id, {L2} AS l2, {IP} AS ip FROM embeddings")
def metric_names(spark, folder):
    """Metrics by name, in any case."""
    q = query_vector(spark, folder)
    scores = [F.round(metric(n).score("embedding", q), DIGITS).alias(a) for n, a in (("L2", "l2"), ("Ip", "ip"))]
    return embeddings(spark, folder).select("vec_id", *scores)


# --- vector indexes --------------------------------------------------------------------


def ivf(spark: SparkSession, folder: str, **options) -> VectorIndex:
    return VectorIndex.build(embeddings(spark, folder), shared_dir(spark), "vec_id", "embedding", nlist=16, **options)


def index_search(index: VectorIndex, spark, folder, **options) -> DataFrame:
    q = query_vector(spark, folder)
    return index.search(q, names=["vec_id"], with_score=True, digits=DIGITS, **options)


@query("ivf_full", top_sql(L2))
def ivf_full(spark, folder):
    index = ivf(spark, folder)
    return index_search(index, spark, folder, nprobe=index.nlist)


@query("ivf_cells", "SELECT vec_id, 1::BIGINT AS cells FROM embeddings")
def ivf_cells(spark, folder):
    """Every row sits in exactly one cell."""
    return ivf(spark, folder).rows().groupBy("vec_id").agg(F.count(CELL).alias("cells"))


# Given centroids: the vectors of the first 16 benchmark items.
SQL_CENTRES = """
    centres AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, embedding::DOUBLE[] AS m FROM embeddings
                WHERE vec_id IN (SELECT item_id FROM benchmark) AND vec_id < 16),
    e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)"""


def given_centres(spark: SparkSession, folder: str) -> list[list[float]]:
    items = read(spark, folder, "benchmark").select(F.col("item_id").alias("vec_id"))
    rows = embeddings(spark, folder).filter("vec_id < 16").join(items, "vec_id", "left_semi")
    return [list(r["embedding"]) for r in rows.orderBy("vec_id").collect()]


def given(spark: SparkSession, folder: str, df: DataFrame | None = None, **options) -> VectorIndex:
    df = embeddings(spark, folder) if df is None else df
    return VectorIndex.build(df, shared_dir(spark), "vec_id", "embedding", centroids=given_centres(spark, folder), **options)


SQL_PROBED = f"""
    {SQL_CENTRES},
    cells AS (SELECT vec_id, arg_min(c, list_distance(v, m)) AS cell FROM e, centres GROUP BY vec_id),
    near AS (SELECT c FROM centres ORDER BY list_distance(m, {SQL_VECTOR}), c LIMIT 4),
    probed AS (SELECT vec_id, v FROM e JOIN cells USING (vec_id) WHERE cell IN (SELECT c FROM near))"""


@query(
    "ivf_probe",
    f"""WITH {SQL_PROBED}
        SELECT vec_id, round(list_distance(v, {SQL_VECTOR}), 6) AS score FROM probed ORDER BY score, vec_id LIMIT 10""",
)
def ivf_probe(spark, folder):
    """Four of sixteen given cells."""
    return index_search(given(spark, folder), spark, folder, nprobe=4)


PQ_SEGMENTS = 8
SQL_CODED = ", ".join(
    f"(SELECT arg_min(m[{8 * s + 1}:{8 * s + 8}], list_distance(m[{8 * s + 1}:{8 * s + 8}], p.v[{8 * s + 1}:{8 * s + 8}])) FROM centres)"
    for s in range(PQ_SEGMENTS)
)


@query(
    "pq_rerank",
    f"""WITH {SQL_PROBED},
        coded AS (SELECT vec_id, v, flatten([{SQL_CODED}]) AS w FROM probed p),
        picked AS (SELECT vec_id, v FROM coded
                   ORDER BY round(list_inner_product(list_transform(list_zip(w, {SQL_VECTOR}), lambda x: x[1] - x[2]),
                                                     list_transform(list_zip(w, {SQL_VECTOR}), lambda x: x[1] - x[2])), 6), vec_id
                   LIMIT 30)
        SELECT vec_id, round(list_distance(v, {SQL_VECTOR}), 6) AS score FROM picked ORDER BY score, vec_id LIMIT 10""",
)
def pq_rerank(spark, folder):
    """Codes pick thirty rows of four cells; the exact distance ranks them."""
    centres = given_centres(spark, folder)
    books = [[c[8 * s : 8 * s + 8] for c in centres] for s in range(PQ_SEGMENTS)]
    return index_search(given(spark, folder, codebooks=books), spark, folder, nprobe=4, refine=3)


@query(
    "ivf_mixed",
    f"""WITH {SQL_MIXED},
        d AS (SELECT vec_id, cell, CASE WHEN len(v) = 64 THEN round(list_distance(v, {SQL_VECTOR}), 6) END AS x FROM mixed)
        SELECT vec_id, cell, CASE WHEN isnan(x) THEN NULL ELSE x END AS score FROM d""",
)
def ivf_mixed(spark, folder):
    """An index over malformed vectors too, and a column named ``cell`` of the user's own."""
    rows = mixed_embeddings(spark, folder)
    index = VectorIndex.build(rows, shared_dir(spark), "vec_id", "embedding", nlist=8)
    return index.search(query_vector(spark, folder), 1_000_000, index.nlist, names=["vec_id", "cell"], with_score=True, digits=DIGITS)


@query("ivf_exact", top_sql(L2))
def ivf_exact(spark, folder):
    """Only cells that can hold one of the ten nearest are read."""
    return index_search(ivf(spark, folder), spark, folder, nprobe=2, exact=True)


@query("ivf_exact_cosine", top_sql(COSINE, k=25))
def ivf_exact_cosine(spark, folder):
    return index_search(ivf(spark, folder, metric="cosine"), spark, folder, k=25, nprobe=1, exact=True)


@query("ivf_exact_threshold", top_sql(L2, k=50, where="score <= 1.2"))
def ivf_exact_threshold(spark, folder):
    return index_search(ivf(spark, folder), spark, folder, k=50, nprobe=2, exact=True, threshold=1.2)


RARE = "label = 3 AND vec_id % 5 = 2"


@query("ivf_filtered", top_sql(L2, where=RARE))
def ivf_filtered(spark, folder):
    """A filter that few rows pass: cells are read until the ten nearest of these are certain."""
    return index_search(ivf(spark, folder), spark, folder, nprobe=2, exact=True, where=RARE)


def ivf_own(spark, folder) -> VectorIndex:
    """Four partitions, each with centroids of its own."""
    rows = embeddings(spark, folder).withColumn("part", F.concat(F.lit("p"), (F.col("vec_id") % 4).cast("string")))
    return VectorIndex.build(rows, shared_dir(spark), "vec_id", "embedding", nlist=8, local=["part"], own_centroids=True)


@query("ivf_own_centroids", top_sql(L2))
def ivf_own_centroids(spark, folder):
    """The ten nearest rows of all partitions, from the cells that may hold one."""
    return index_search(ivf_own(spark, folder), spark, folder, nprobe=2, exact=True)


@query("ivf_own_partition", top_sql(L2, where="vec_id % 4 = 1"))
def ivf_own_partition(spark, folder):
    """The ten nearest rows of one partition; only its own cells are looked at."""
    return index_search(ivf_own(spark, folder), spark, folder, nprobe=2, exact=True, partitions=["p1"])


@query("ivf_own_cells", "SELECT 'p' || (vec_id % 4) AS part, count(*) AS n, 0::BIGINT AS strangers FROM embeddings GROUP BY 1")
def ivf_own_cells(spark, folder):
    """Rows per partition, and those whose cell was trained on another one."""
    index = ivf_own(spark, folder)
    trained = index.groups().select(CELL, F.get_json_object(GROUP, "$.part").alias("own"))
    rows = index.rows().join(trained, CELL)
    return rows.groupBy("part").agg(F.count("*").alias("n"), F.sum((F.col("own") != F.col("part")).cast("long")).alias("strangers"))


@query("ivf_widened", f"WITH t AS ({top_sql(L2, where=RARE)}) SELECT count(*) AS n, 0::BIGINT AS others FROM t")
def ivf_widened(spark, folder):
    """The same filter on the nearest cells: as many rows as the filter leaves, and none that it does not."""
    found = index_search(ivf(spark, folder), spark, folder, nprobe=1, where=RARE)
    passing = embeddings(spark, folder).filter(RARE).select("vec_id", F.lit(0).alias("other"))
    return found.join(passing, "vec_id", "left").agg(F.count("*").alias("n"), F.sum(F.coalesce("other", F.lit(1))).alias("others"))


def batch_by_cell(index: VectorIndex, spark: SparkSession, folder: str, **options) -> DataFrame:
    items = read(spark, folder, "benchmark").select(F.col("item_id").alias("vec_id"))
    wanted = embeddings(spark, folder).join(items, "vec_id", "left_semi")
    return index.search_many(wanted, "vec_id", "embedding", 10, digits=DIGITS, **options)


@query("knn_batch_cells", sql_batch("list_distance(embedding::DOUBLE[], qv)"))
def knn_batch_cells(spark, folder):
    """Queries and rows dealt by cell, in pieces and blocks; all cells are probed, so the result is exact."""
    return batch_by_cell(ivf(spark, folder), spark, folder, nprobe=16, block_bytes=8 * 64 * 20)


@query("knn_batch_cells_cosine", sql_batch("list_cosine_distance(embedding::DOUBLE[], qv)"))
def knn_batch_cells_cosine(spark, folder):
    return batch_by_cell(ivf(spark, folder, metric="cosine"), spark, folder, nprobe=16)


@query(
    "knn_batch_probe",
    f"""WITH {SQL_CENTRES},
        cells AS (SELECT vec_id, arg_min(c, list_distance(v, m)) AS cell FROM e, centres GROUP BY vec_id),
        q AS (SELECT vec_id AS query_id, v AS qv FROM e WHERE vec_id IN (SELECT item_id FROM benchmark)),
        near AS (SELECT query_id, qv, c, row_number() OVER (PARTITION BY query_id ORDER BY list_distance(qv, m), c) AS p FROM q, centres),
        d AS (SELECT query_id, e.vec_id, round(list_distance(v, qv), 6) AS score
              FROM near JOIN cells ON cell = c JOIN e ON e.vec_id = cells.vec_id WHERE p <= 4),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
        SELECT query_id, vec_id, score, rank FROM r WHERE rank <= 10""",
)
def knn_batch_probe(spark, folder):
    """Four of sixteen given cells for every query."""
    return batch_by_cell(given(spark, folder), spark, folder, nprobe=4)


# --- indexes that live with their table ------------------------------------------------


def vector_store(spark: SparkSession) -> Store:
    store = Store(spark, shared_dir(spark))
    fields = [
        field("vec_id", DataType.INT64, primary=True),
        field("embedding", DataType.FLOAT_VECTOR, dim=64, nullable=True),
        field("label", DataType.INT32, nullable=True),
    ]
    store.create_collection("points", schema=table_schema(fields), index_params=[{"name": "near", "column": "embedding", "nlist": 8}])
    return store


def store_search(store: Store, spark, folder) -> DataFrame:
    q = query_vector(spark, folder)
    return store.ann_search("points", q, "embedding", "l2", 10, names=["vec_id"], index="near", nprobe=8, with_score=True, digits=DIGITS)


@query("index_then_insert", top_sql(L2))
def index_then_insert(spark, folder):
    """The index exists before the rows; one half is indexed, the other is not yet."""
    store, rows = vector_store(spark), embeddings(spark, folder)
    store.insert("points", rows.filter("vec_id % 2 = 0"))
    store.rebuild_index("points", "near", full=False)
    store.insert("points", rows.filter("vec_id % 2 = 1"))
    return store_search(store, spark, folder)


@query("ivf_after_delete", top_sql(L2, where="label <> 3 AND vec_id <> 0"))
def ivf_after_delete(spark, folder):
    """Rows deleted and changed since the index was built."""
    store, rows = vector_store(spark), embeddings(spark, folder)
    store.insert("points", rows.withColumn("embedding", F.when(F.col("vec_id") % 3 == 0, F.reverse("embedding")).otherwise(F.col("embedding"))))
    store.rebuild_index("points", "near")
    store.delete("points", where="label = 3")
    store.upsert("points", rows.filter("vec_id % 3 = 0 AND label <> 3"))
    store.delete("points", ids=[0])
    return store_search(store, spark, folder)


@query("ivf_refreshed", top_sql(L2, where="label <> 3"))
def ivf_refreshed(spark, folder):
    """The same after an incremental refresh."""
    store, rows = vector_store(spark), embeddings(spark, folder)
    store.insert("points", rows.filter("vec_id % 2 = 0"))
    store.rebuild_index("points", "near")
    store.insert("points", rows.filter("vec_id % 2 = 1"))
    store.delete("points", where="label = 3")
    store.rebuild_index("points", "near", full=False)
    return store_search(store, spark, folder)


@query("quick_collection", top_sql(L2, k=10, where="vec_id % 2 = 0"))
def quick_collection(spark, folder):
    """A collection declared by its dimension alone, searched by its usual metric."""
    store = Store(spark, shared_dir(spark))
    store.create_collection("quick", dimension=64, primary_field_name="vec_id", vector_field_name="embedding")
    store.insert("quick", embeddings(spark, folder).filter("vec_id % 2 = 0").select("vec_id", "embedding"))
    return store.ann_search("quick", query_vector(spark, folder), "embedding", k=10, names=["vec_id"], with_score=True, digits=DIGITS)
