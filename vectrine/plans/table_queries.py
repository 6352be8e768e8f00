"""Queries over rows: filters, search dictionaries, partitions, table changes."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokens
from ..indexes.postings import TextIndex
from ..operators import filters
from ..operators.search_dict import find, scoring_clauses, where
from ..session import shared_dir
from ..sources.partitioning import (
    DEFAULT,
    MAXVALUE,
    HashPartition,
    KeyPartition,
    ListPartition,
    Partition,
    RangePartition,
)
from ..sources.schema import field, table_schema
from ..sources.table import Table
from ..store import Store
from .registry import query, read
from .text_queries import SQL_TOKENS

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
SQL_ORDERS = ", ".join(ORDER_COLUMNS)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(*ORDER_COLUMNS)


# --- filters ---------------------------------------------------------------------------


@query("flt_query", f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000")
def flt_query(spark, folder):
    rows = read(spark, folder, "orders")
    return filters.query(rows, ["o_orderstatus = 'F'", F.col("o_totalprice") > 250000], ORDER_COLUMNS)


@query("flt_get_ids", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (0, 7, 42, 1001, -5)")
def flt_get_ids(spark, folder):
    return filters.get(read(spark, folder, "orders"), "o_orderkey", [0, 7, 42, 1001, -5], names=["o_orderkey", "o_totalprice"])


@query(
    "flt_get_where",
    "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND lang = 'en'",
)
def flt_get_where(spark, folder):
    """Ids given as a DataFrame, AND a condition."""
    wanted = read(spark, folder, "labels").filter("quality = 1")
    return filters.get(read(spark, folder, "documents"), "doc_id", wanted, where="lang = 'en'", names=["doc_id", "lang"])


@query(
    "flt_arith",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity % 2 = 0 AND l_extendedprice * (1 - l_discount) > 40000 AND l_quantity - l_linenumber < 30""",
)
def flt_arith(spark, folder):
    return filters.query(
        read(spark, folder, "lineitem"),
        [
            "l_quantity % 2 = 0",
            F.col("l_extendedprice") * (1 - F.col("l_discount")) > 40000,
            F.col("l_quantity") - F.col("l_linenumber") < 30,
        ],
        ["l_orderkey", "l_linenumber", "l_quantity"],
    )


@query(
    "flt_json",
    "SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events WHERE json_extract_string(props, '$.k')::INT > 60",
)
def flt_json(spark, folder):
    k = filters.json_field("props", "$.k", "int")
    return filters.query(read(spark, folder, "events"), k > 60, columns=["event_id", k.alias("k")])


@query(
    "flt_array",
    f"""SELECT doc_id, lang FROM documents
        WHERE list_has_all({SQL_TOKENS.format('text')}, ['the', 'of'])""",
)
def flt_array(spark, folder):
    both = filters.contains_all(tokens("text"), ["the", "of"])
    return filters.query(read(spark, folder, "documents"), both, ["doc_id", "lang"])


@query("get_limit", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 20")
def get_limit(spark, folder):
    ordered = read(spark, folder, "orders").orderBy("o_orderkey")
    return filters.get(ordered, "o_orderkey", names=["o_orderkey", "o_custkey"], limit=20)


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, folder):
    return filters.row_count(read(spark, folder, "lineitem"))


# --- search dictionaries ---------------------------------------------------------------


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, NULL where there are none."""
    return (
        read(spark, folder, "documents")
        .select("doc_id", "lang", "source", "n_chars", "text")
        .join(read(spark, folder, "labels"), "doc_id", "left")
    )


SQL_LABELLED = "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE "
FOUND = ["doc_id", "lang", "quality", "toxic"]
SQL_FOUND_ORDERS = "SELECT o_orderkey, o_totalprice FROM orders WHERE "


def find_orders(spark, folder, body) -> DataFrame:
    rows = read(spark, folder, "orders")
    return rows.filter(where(body, rows.schema)).select("o_orderkey", "o_totalprice")


def find_documents(spark, folder, body, **options) -> DataFrame:
    rows = labelled_documents(spark, folder)
    return rows.filter(where(body, rows.schema, **options)).select(*FOUND)


@query("dsl_must", SQL_FOUND_ORDERS + "o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_orderpriority = '1-URGENT'")
def dsl_must(spark, folder):
    return find_orders(
        spark,
        folder,
        {
            "bool": {
                "must": [{"term": {"o_orderstatus": "F"}}, {"range": {"o_totalprice": {"gte": 100000}}}],
                "filter": {"term": {"o_orderpriority": "1-URGENT"}},
            }
        },
    )


@query(
    "dsl_should",
    SQL_FOUND_ORDERS + "o_orderstatus = 'F' AND (o_totalprice < 20000 OR o_orderpriority = '2-HIGH')",
)
def dsl_should(spark, folder):
    """``should`` is required, also beside ``must``."""
    return find_orders(
        spark,
        folder,
        {
            "bool": {
                "must": {"term": {"o_orderstatus": "F"}},
                "should": [{"range": {"o_totalprice": {"lt": 20000}}}, {"term": {"o_orderpriority": "2-HIGH"}}],
            }
        },
    )


@query("dsl_must_not", SQL_LABELLED + "NOT (toxic = 1) AND NOT (lang = 'en')")
def dsl_must_not(spark, folder):
    """A NULL field fails ``must_not``."""
    return find_documents(spark, folder, {"bool": {"must_not": [{"term": {"toxic": True}}, {"term": {"lang": "en"}}]}})


@query(
    "dsl_nested",
    SQL_LABELLED + "(lang = 'de' OR (quality = 1 AND NOT (toxic = 1))) AND n_chars > 500 AND source IN ('src1', 'src2', 'src3')",
)
def dsl_nested(spark, folder):
    return find_documents(
        spark,
        folder,
        [
            {
                "bool": {
                    "should": [
                        {"term": {"lang": "de"}},
                        {"bool": {"must": [{"term": {"quality": 1}}], "must_not": {"term": {"toxic": 1}}}},
                    ],
                    "filter": [{"range": {"n_chars": {"gt": 500}}}],
                }
            },
            {"terms": {"source": ["src1", "src2", "src3"]}},
        ],
    )


@query("dsl_term", SQL_FOUND_ORDERS + "o_orderpriority = '3-MEDIUM'")
def dsl_term(spark, folder):
    return find_orders(spark, folder, {"term": {"o_orderpriority": "3-MEDIUM"}})


@query("dsl_terms", SQL_FOUND_ORDERS + "o_orderpriority IN ('1-URGENT', '5-LOW') OR 1 = 0")
def dsl_terms(spark, folder):
    some = {"terms": {"o_orderpriority": ["1-URGENT", "5-LOW"]}}
    return find_orders(spark, folder, {"bool": {"should": [some, {"terms": {"o_orderstatus": []}}]}})


@query(
    "dsl_range",
    SQL_FOUND_ORDERS
    + "o_totalprice > 1000 AND o_totalprice <= 90000 AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1998-03-01'",
)
def dsl_range(spark, folder):
    return find_orders(
        spark,
        folder,
        [
            {"range": {"o_totalprice": {"gt": 1000, "lte": 90000}}},
            {"range": {"o_orderdate": {"gte": "1996-03-01", "lt": "1998-03-01"}}},
            {"range": {"o_custkey": {}}},
        ],
    )


@query("dsl_exists", SQL_LABELLED + "quality IS NOT NULL")
def dsl_exists(spark, folder):
    return find_documents(spark, folder, {"exists": {"field": "quality"}})


@query("dsl_missing", SQL_LABELLED + "quality IS NULL")
def dsl_missing(spark, folder):
    return find_documents(spark, folder, {"missing": {"field": "quality"}})


@query("dsl_match_true", SQL_LABELLED + "(1 = 1 OR lang = 'xx') AND lang = 'es'")
def dsl_match_true(spark, folder):
    """Text clauses score, they do not filter."""
    text = {"query_string": {"query": "history", "fields": ["text^2"]}}
    body = {"bool": {"should": [{"match": {"text": "people"}}, {"term": {"lang": "xx"}}], "must": [text, {"term": {"lang": "es"}}]}}
    return find_documents(spark, folder, body)


PHRASES = [
    {"match": {"text": "history der the"}},
    {"bool": {"should": [{"match_phrase": {"text": "and the"}}, {"match_phrase": {"text": {"query": "ist der"}}}]}},
]
SPACED = f"concat(' ', array_to_string({SQL_TOKENS.format('text')}, ' '), ' ')"


@query(
    "dsl_match_filter",
    SQL_LABELLED
    + f"len(list_intersect({SQL_TOKENS.format('text')}, ['history', 'der', 'the'])) > 0 AND "
    + f"(contains({SPACED}, ' and the ') OR contains({SPACED}, ' ist der '))",
)
def dsl_match_filter(spark, folder):
    """With ``text_filters``, text clauses are predicates too."""
    return find_documents(spark, folder, PHRASES, text_filters=True)


@query(
    "dsl_match_index",
    SQL_LABELLED
    + f"len(list_intersect({SQL_TOKENS.format('text')}, ['history', 'der', 'the'])) > 0 AND "
    + f"(contains({SPACED}, ' and the ') OR contains({SPACED}, ' ist der ')) AND NOT contains({SPACED}, ' of the ')",
)
def dsl_match_index(spark, folder):
    """The same predicates, and a phrase that must not occur, from the postings' places."""
    rows = labelled_documents(spark, folder)
    index = TextIndex.build(rows, shared_dir(spark), "doc_id", "text", positions=True)
    body = [*PHRASES, {"bool": {"must_not": [{"match_phrase": {"text": "of the"}}]}}]
    return find(rows, body, key="doc_id", text_indexes={"text": index}).select(*FOUND)


@query(
    "dsl_scoring",
    "SELECT field, count(*) AS n FROM (VALUES ('lang'), ('text'), ('source')) v(field), documents GROUP BY field",
)
def dsl_scoring(spark, folder):
    """The fields that a dictionary scores, read from all its branches, over every document."""
    body = {
        "bool": {
            "must": [{"query_string": {"query": "history", "fields": ["text^3"]}}, {"term": {"doc_id": 1}}],
            "should": [{"match_phrase": {"lang": {"query": "fr src3"}}}, {"match": {"text": "   "}}],
            "must_not": [{"bool": {"filter": [{"match": {"source": " src3 "}}]}}],
        }
    }
    fields = F.array(*[F.lit(name) for name, _ in scoring_clauses(body)])
    return read(spark, folder, "documents").select(F.explode(fields).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query(
    "dsl_checked",
    SQL_LABELLED + "lang = 'en' AND quality = 1",
)
def dsl_checked(spark, folder):
    """Bad dictionaries are refused; the good one among them filters."""
    columns = labelled_documents(spark, folder).schema
    good = {"bool": {"must": [{"term": {"lang": "en"}}, {"term": {"quality": True}}]}}
    refused = [{"term": {"no such": 1}}, {"term": {"lang": "a\nb"}}, {"wildcard": {"lang": "e*"}}, {"term": {"absent": 1}}, {"term": {"lang": None}}]
    accepted = []
    for body in (*refused, good):
        try:
            where(body, columns)
            accepted.append(body)
        except (ValueError, TypeError, NotImplementedError):
            continue
    return find_documents(spark, folder, accepted)


# --- partition rules ---------------------------------------------------------------------

BY_PRICE = RangePartition([("cheap", 100000), ("middle", 300000), ("rest", MAXVALUE)], expr="o_totalprice")
SQL_BY_PRICE = "CASE WHEN o_totalprice < 100000 THEN 'cheap' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'rest' END"


def sql_bucket(text: str, n: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {n})"


def labels_of(spark, folder, name: str, rule: Partition, *columns: str) -> DataFrame:
    return rule.assign(read(spark, folder, name)).select(*columns, *rule.levels())


@query("part_range", f"SELECT o_orderkey, {SQL_BY_PRICE} AS part FROM orders")
def part_range(spark, folder):
    return labels_of(spark, folder, "orders", BY_PRICE, "o_orderkey")


@query(
    "part_range_cols",
    """SELECT o_orderkey, CASE
           WHEN (o_orderdate, o_totalprice) < (TIMESTAMP '1997-01-01', 50000) THEN 'p0'
           WHEN (o_orderdate, o_totalprice) < (TIMESTAMP '1999-06-15', 200000) THEN 'p1'
           WHEN o_orderdate <= TIMESTAMP '2000-06-01' THEN 'p2' ELSE 'p3' END AS part FROM orders""",
)
def part_range_cols(spark, folder):
    rule = RangePartition(
        [
            ("p0", ("1997-01-01", 50000)),
            ("p1", ("1999-06-15", 200000)),
            ("p2", ("2000-06-01", MAXVALUE)),
            ("p3", (MAXVALUE, MAXVALUE)),
        ],
        columns=["o_orderdate", "o_totalprice"],
    )
    return labels_of(spark, folder, "orders", rule, "o_orderkey")


@query(
    "part_list",
    """SELECT event_id, CASE WHEN upper(event_type) IN ('CLICK', 'VIEW') THEN 'reading'
                             WHEN upper(event_type) IN ('PURCHASE') THEN 'buying' ELSE 'other' END AS part FROM events""",
)
def part_list(spark, folder):
    rule = ListPartition(
        [("other", DEFAULT), ("reading", ["CLICK", "VIEW"]), ("buying", ["PURCHASE"])], expr="upper(event_type)"
    )
    return labels_of(spark, folder, "events", rule, "event_id")


@query(
    "part_list_cols",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN (l_returnflag, l_linestatus) IN (('A', 'F'), ('R', 'F')) THEN 'closed'
                   WHEN (l_returnflag, l_linestatus) IN (('N', 'O')) THEN 'open' ELSE 'mixed' END AS part
       FROM lineitem""",
)
def part_list_cols(spark, folder):
    rule = ListPartition(
        [("closed", [("A", "F"), ("R", "F")]), ("open", [("N", "O")]), ("mixed", DEFAULT)],
        columns=["l_returnflag", "l_linestatus"],
    )
    return labels_of(spark, folder, "lineitem", rule, "l_orderkey", "l_linenumber", "l_partkey")


@query("part_hash", f"SELECT c_custkey, concat('p', {sql_bucket('c_custkey::VARCHAR', 60)}) AS part FROM customer")
def part_hash(spark, folder):
    return labels_of(spark, folder, "customer", HashPartition("c_custkey", count=60), "c_custkey")


@query(
    "part_key",
    f"""SELECT c_custkey, concat('p', {sql_bucket("concat_ws(chr(1), c_custkey::VARCHAR, c_mktsegment)", 10)}) AS part
        FROM customer""",
)
def part_key(spark, folder):
    return labels_of(spark, folder, "customer", KeyPartition(["c_custkey", "c_mktsegment"], count=10), "c_custkey")


@query(
    "part_sub",
    f"""SELECT o_orderkey, {SQL_BY_PRICE} AS part, ['a', 'b', 'c'][{sql_bucket('o_custkey::VARCHAR', 3)} + 1] AS subpart
        FROM orders""",
)
def part_sub(spark, folder):
    rule = RangePartition(BY_PRICE.parts, expr="o_totalprice").by(HashPartition("o_custkey", names=["a", "b", "c"]))
    return labels_of(spark, folder, "orders", rule, "o_orderkey")


# --- tables ----------------------------------------------------------------------------


def stored(spark: SparkSession, rows: DataFrame, key: str, partition: Partition | None = None) -> Table:
    """A new table holding ``rows``, whose key is known to be unique."""
    fields = [field(f.name, f.dataType, primary=f.name == key, nullable=f.name != key) for f in rows.schema]
    table = Table.create(spark, shared_dir(spark), table_schema(fields), partition)
    return table.insert(rows, check_keys=False)


@query("scan_table", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_table(spark, folder):
    return stored(spark, orders(spark, folder), "o_orderkey").df().select("o_orderkey", "o_totalprice")


@query("part_select", f"SELECT {SQL_ORDERS} FROM orders WHERE {SQL_BY_PRICE} IN ('middle', 'rest')")
def part_select(spark, folder):
    return stored(spark, orders(spark, folder), "o_orderkey", BY_PRICE).df(["middle", "rest"])


@query("ins_append", f"SELECT {SQL_ORDERS} FROM orders")
def ins_append(spark, folder):
    """Two appends; the second is checked against the keys of the first."""
    rows = orders(spark, folder)
    table = stored(spark, rows.filter("o_orderstatus <> 'P'"), "o_orderkey", BY_PRICE)
    return table.insert(rows.filter("o_orderstatus = 'P'")).df()


@query(
    "ups_replace",
    """WITH last AS (SELECT o_custkey, last(o_totalprice ORDER BY o_orderkey) AS balance FROM orders GROUP BY o_custkey)
       SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM last)
       UNION ALL SELECT o_custkey, NULL, NULL, balance, NULL FROM last""",
)
def ups_replace(spark, folder):
    """Each customer with orders becomes a row of key and last price, the rest NULL."""
    table = stored(spark, read(spark, folder, "customer"), "c_custkey")
    batch = read(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), F.col("o_orderkey").alias("place")
    )
    return table.upsert(batch, order_by="place").df()


@query(
    "upd_where",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
              CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
              CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN '0-DONE' ELSE o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def upd_where(spark, folder):
    table = stored(spark, orders(spark, folder), "o_orderkey", BY_PRICE)
    values = {"o_totalprice": F.col("o_totalprice") * 2, "o_orderpriority": "0-DONE"}
    return table.update(values, where=["o_orderstatus = 'F'", F.col("o_totalprice") > 200000]).df()


SQL_BUILDERS = "(SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')"


def builder_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the orders placed by one market segment."""
    builders = read(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return orders(spark, folder).join(builders, "o_custkey", "left_semi").select("o_orderkey")


@query("del_ids", f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderkey NOT IN {SQL_BUILDERS}")
def del_ids(spark, folder):
    return stored(spark, orders(spark, folder), "o_orderkey").delete(ids=builder_orders(spark, folder)).df()


@query(
    "del_where",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders
       WHERE NOT coalesce(nullif(o_orderpriority, '5-LOW') <> '1-URGENT', FALSE)""",
)
def del_where(spark, folder):
    """Rows where the condition is NULL stay."""
    rows = orders(spark, folder).select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return stored(spark, rows, "o_orderkey").delete(where="o_orderpriority <> '1-URGENT'").df()


@query(
    "del_both",
    f"SELECT {SQL_ORDERS} FROM orders WHERE NOT coalesce(o_orderkey IN {SQL_BUILDERS} AND o_totalprice > 150000, FALSE)",
)
def del_both(spark, folder):
    table = stored(spark, orders(spark, folder), "o_orderkey", BY_PRICE)
    return table.delete(ids=builder_orders(spark, folder), where="o_totalprice > 150000").df()


@query("del_partition", f"SELECT {SQL_ORDERS} FROM orders WHERE {SQL_BY_PRICE} <> 'cheap'")
def del_partition(spark, folder):
    return stored(spark, orders(spark, folder), "o_orderkey", BY_PRICE).delete(partition="cheap").df()


@query("del_escaped", f"SELECT {SQL_ORDERS} FROM orders WHERE o_totalprice >= 100000 AND o_custkey % 3 <> 0")
def del_escaped(spark, folder):
    """Partitions whose names need escaping in paths: replace, change and delete rows in them."""
    rule = RangePartition([("a:1 b%c", 100000), ("p=2%", MAXVALUE)], expr="o_totalprice")
    rows = orders(spark, folder)
    table = stored(spark, rows.withColumn("o_orderstatus", F.lit("?")), "o_orderkey", rule)
    table.upsert(rows)
    table.update({"o_custkey": F.col("o_custkey") - 3}, where="o_totalprice >= 0")
    table.update({"o_custkey": F.col("o_custkey") + 3}, where="o_totalprice >= 0")
    return table.delete(where="o_custkey % 3 = 0").delete(partition="a:1 b%c").df()


@query(
    "ins_partition",
    f"SELECT {SQL_ORDERS}, {SQL_BY_PRICE} AS part FROM orders",
)
def ins_partition(spark, folder):
    """Rows inserted into the partition they belong to."""
    rows = orders(spark, folder)
    table = stored(spark, rows.filter("o_totalprice < 100000"), "o_orderkey", BY_PRICE)
    table.insert(rows.filter("o_totalprice between 100000 and 299999.999999"), partition="middle")
    return table.insert(rows.filter("o_totalprice >= 300000"), partition="rest").df(labels=True)


@query("col_add", "SELECT c_custkey, c_name, NULL::VARCHAR AS note, NULL::INT AS age FROM customer")
def col_add(spark, folder):
    rows = read(spark, folder, "customer").select("c_custkey", "c_name")
    new = [field("note", T.StringType(), nullable=True), field("age", T.IntegerType(), nullable=True)]
    return stored(spark, rows, "c_custkey").add_columns(new).df()


@query("col_drop", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def col_drop(spark, folder):
    return stored(spark, read(spark, folder, "customer"), "c_custkey").drop_columns(["c_acctbal", "c_nationkey"]).df()


@query("auto_id", "SELECT row_number() OVER (ORDER BY event_id) AS id FROM events")
def auto_id(spark, folder):
    """The consecutive ids given to events; which event gets which is free."""
    fields = [
        field("id", T.LongType(), primary=True, auto_id=True),
        field("event_id", T.LongType()),
        field("event_type", T.StringType(), nullable=True),
    ]
    table = Table.create(spark, shared_dir(spark), table_schema(fields))
    return table.insert(read(spark, folder, "events").select("event_id", "event_type")).df().select("id")


def partitioned_orders(spark: SparkSession, folder: str) -> Store:
    store = Store(spark, shared_dir(spark))
    rows = orders(spark, folder)
    bounds = [("early", datetime.date(1994, 1, 1)), ("middle", datetime.date(1997, 1, 1)), ("late", MAXVALUE)]
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema]
    store.create_collection("orders", schema=T.StructType(fields), partitions=RangePartition(bounds, expr="o_orderdate"))
    store.insert("orders", rows)
    return store


@query("flt_pruned", f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderdate >= '1994-03-01' AND o_orderdate < '1996-06-01' AND o_orderstatus = 'F'")
def flt_pruned(spark, folder):
    """A predicate on the partition column reads the partitions that it can touch."""
    found = partitioned_orders(spark, folder).query("orders", "o_orderdate >= '1994-03-01' AND o_orderdate < '1996-06-01' AND o_orderstatus = 'F'")
    parts = {f.split("/part=")[1].split("/")[0] for f in found.inputFiles()}
    assert parts <= {"middle"}, parts
    return found


@query("flt_get_bucket", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 2, 7, 32)")
def flt_get_bucket(spark, folder):
    """Keys open the buckets that hold them, four of sixteen at most."""
    store = Store(spark, shared_dir(spark))
    rows = orders(spark, folder).select("o_orderkey", "o_totalprice")
    key = field("o_orderkey", rows.schema["o_orderkey"].dataType, primary=True)
    store.create_collection("keyed", schema=table_schema([key, field("o_totalprice", rows.schema["o_totalprice"].dataType, nullable=True)]))
    store.insert("keyed", rows)
    found = store.get("keyed", [1, 2, 7, 32])
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 4
    return found
