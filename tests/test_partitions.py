"""Partition labels at their boundaries (fixture F18), and two-level tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from vectrine.sources import DEFAULT, MAXVALUE, DataType, HashPartition, KeyPartition, ListPartition, RangePartition, Table
from vectrine.sources import field, table_schema
from vectrine.sources.partitioning import from_dict


def labels(df, rule):
    again = from_dict(rule.to_dict())
    assert again.to_dict() == rule.to_dict()
    names = rule.levels()
    got = [tuple(r) if len(names) > 1 else r[0] for r in rule.assign(df).select(*names).collect()]
    assert got == [tuple(r) if len(names) > 1 else r[0] for r in again.assign(df).select(*names).collect()]
    return got


def test_range_bounds_are_exclusive(spark):
    df = spark.createDataFrame([(99,), (100,), (None,)], "id int")
    assert labels(df, RangePartition([("p0", 100), ("p1", MAXVALUE)], expr="id")) == ["p0", "p1", "p1"]
    assert labels(df, RangePartition([("p0", 100)], expr="id")) == ["p0", None, None]
    assert labels(df, RangePartition([("p0", 10), ("p1", "maxvalue")], expr="id / 10")) == ["p0", "p1", "p1"]


def test_range_over_date_texts_and_tuples(spark):
    df = spark.createDataFrame([("2019-12-31", 1), ("2020-01-01", 4), ("2020-01-01", 5), ("2021-01-01", 0)], "d string, n int")
    rule = RangePartition([("a", ("2020-01-01", 5)), ("b", ("2021-01-01", MAXVALUE)), ("c", MAXVALUE)], columns=["d", "n"])
    assert labels(df, rule) == ["a", "a", "b", "b"]
    dates = df.select(F.to_date("d").alias("d"))
    assert labels(dates, RangePartition([("old", "2020-01-01"), ("new", MAXVALUE)], columns=["d"])) == ["old", "new", "new", "new"]


def test_list(spark):
    df = spark.createDataFrame([(1, "00"), (6, "03"), (7, "zz"), (None, None)], "n int, s string")
    rule = ListPartition([("rest", DEFAULT), ("p0", [1, 2, 3]), ("p1", [5, 6])], expr="n")
    assert labels(df, rule) == ["p0", "p1", "rest", "rest"]
    by_text = ListPartition([("p0", ["00", "01"]), ("p1", ["02", "03"])], columns=["s"])
    assert labels(df, by_text) == ["p0", "p1", None, None]
    pairs = ListPartition([("p0", [(1, "00"), (6, "xx")]), ("p1", DEFAULT)], columns=["n", "s"])
    assert labels(df, pairs) == ["p0", "p1", "p1", "p1"]


def test_hash_and_key(spark):
    df = spark.createDataFrame([(i, f"d{i}") for i in range(50)] + [(None, None)], "id int, s string")
    got = labels(df, HashPartition("id", count=60))
    assert got[:50] == [f"p{int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 60}" for i in range(50)]
    assert got[50] is not None
    assert set(labels(df, HashPartition("id", names=["x", "y"]))) == {"x", "y"}
    assert HashPartition("id", names=["x"], count=3).names == ["p0", "p1", "p2"]
    assert set(labels(df, KeyPartition(["id", "s"], count=10))) <= {f"p{i}" for i in range(10)}


def test_rules_need_their_parts():
    for wrong in (
        lambda: RangePartition([("p0", 1)]),
        lambda: HashPartition("id"),
        lambda: KeyPartition(["id"]),
        lambda: RangePartition([("p0", 1)], expr="id").by(HashPartition("id", count=2).by(HashPartition("id", count=2))),
    ):
        with pytest.raises(ValueError):
            wrong()


FIRST_LEVEL = {
    "range": lambda: RangePartition([("p0", 100), ("p1", MAXVALUE)], expr="id"),
    "list": lambda: ListPartition([("p0", [1, 2]), ("p1", DEFAULT)], expr="id % 5"),
    "hash": lambda: HashPartition("id", count=3),
    "key": lambda: KeyPartition(["id", "s"], count=3),
}


@pytest.mark.parametrize("top", FIRST_LEVEL)
@pytest.mark.parametrize("below", FIRST_LEVEL)
def test_any_rule_under_any_other(spark, top, below):
    df = spark.range(200).selectExpr("id", "string(id) as s")
    rule = FIRST_LEVEL[top]().by(FIRST_LEVEL[below]())
    got = labels(df, rule)
    assert [g[0] for g in got] == labels(df, FIRST_LEVEL[top]())
    assert [g[1] for g in got] == labels(df, FIRST_LEVEL[below]())


def test_two_level_table(spark, folder):
    rule = RangePartition([("p0", 100), ("p1", MAXVALUE)], expr="id").by(ListPartition([("a", [0]), ("b", DEFAULT)], expr="id % 2"))
    table = Table.create(spark, folder, table_schema([field("id", DataType.INT64, primary=True), field("v", DataType.INT64)]), rule)
    table.insert(spark.range(200).selectExpr("id", "id as v"))
    assert table.df(["p0"]).count() == 100 and table.df(["p0/a"]).count() == 50
    assert table.df(["p0/a", "p1"]).count() == 150
    counts = table.df(labels=True).groupBy("part", "subpart").count().collect()
    assert sum(r["count"] for r in counts) == 200 and len(counts) == 4
    table.delete(partition="p1/b")
    assert table.df().count() == 150 and table.df(["p1"]).count() == 50
    table.update({"v": -1}, partition="p0/b")
    assert table.df().filter("v = -1").count() == 50
    with pytest.raises(Exception, match="does not belong"):
        table.insert(spark.createDataFrame([(301, 1)], "id long, v long"), partition="p1/a")


def test_a_hot_partition_is_written_by_several_tasks(spark, folder):
    rule = ListPartition([("hot", [0]), ("rest", DEFAULT)], expr="k")
    table = Table.create(spark, folder, table_schema([field("id", DataType.INT64, primary=True), field("k", DataType.INT64)]), rule)
    rows = spark.range(0, 300000, 1, 8).selectExpr("id", "if(id % 3 = 0, 0, id % 7 + 1) as k")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200KB")
    try:
        table.insert(rows, check_keys=False)
    finally:
        spark.conf.unset(size)
    files = table.df(["hot"]).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and table.df(["hot"]).count() == 100000 and table.df().count() == 300000


@pytest.mark.parametrize(
    "parts", [[("a", 2), ("b", 2)], [("a", 3), ("b", 2)], [("a", MAXVALUE), ("b", 9)], [("a", (1, 5)), ("b", (1, 5))], [("a", "2024"), ("b", "2023")]]
)
def test_range_bounds_ascend(parts):
    with pytest.raises(ValueError, match="not above"):
        RangePartition(parts, expr="x") if not isinstance(parts[0][1], tuple) else RangePartition(parts, columns=["x", "y"])
