from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkrank.operators import graph as g
from linkrank.operators import skew


@pytest.fixture(scope="module")
def pairs(spark):
    """3000 pairs, a third of them to one target and some to a missing one."""
    return spark.range(3000).select(
        F.concat(F.lit("s"), "id").alias("src"),
        F.when(F.col("id") % 3 == 0, "hub")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("t"), F.col("id") % 500))
        .otherwise("gone")
        .alias("dst"),
    )


@pytest.fixture(scope="module")
def nodes(spark):
    titles = [("hub",)] + [(f"t{i}",) for i in range(0, 500, 2)]
    return spark.createDataFrame(titles, "page string")


def test_limit():
    assert skew.hot_limit(10, 8, 100) == 100
    assert skew.hot_limit(8000, 8, 100) == 1000
    assert skew.hot_limit(0, 8, 0) == 1


def test_hot_keys_are_bounded(pairs):
    hot = skew.counted_hot_keys(pairs, "dst", 3000, 100)
    found = {row.dst: row.shares for row in hot.collect()}
    assert found == {"hub": 80, "gone": 80}
    assert skew.counted_hot_keys(pairs, "dst", 3000, 5000) is None
    assert skew.counted_hot_keys(pairs, "dst", 3000, 2999) is None


def test_hot_rows_spread(pairs):
    hot = skew.counted_hot_keys(pairs, "dst", 3000, 100)
    sizes = skew.salted(pairs, hot, "dst", F.col("src")).groupBy("dst", "salt").count()
    assert sizes.agg(F.max("count")).first()[0] < 50
    cold = sizes.where("dst not in ('hub', 'gone')").agg(F.max("salt")).first()[0]
    assert cold == 0


@pytest.mark.parametrize("limit", [1, 100, 5000])
def test_salting_keeps_the_join(pairs, nodes, limit):
    links = g.single_copies(pairs)
    hot = skew.counted_hot_keys(pairs, "dst", 3000, limit)
    found = g.existing_links(links, nodes, hot)
    expected = links.join(nodes.withColumnRenamed("page", "dst"), "dst", "left_semi")
    assert found.columns == ["src", "dst", "copies"]
    assert sorted(found.collect()) == sorted(expected.select(*found.columns).collect())


def test_wrong_hot_keys_cannot_change_the_join(spark, pairs, nodes):
    links = g.single_copies(pairs)
    hot = spark.createDataFrame([("t2", 7), ("nowhere", 3)], "dst string, shares int")
    found = g.existing_links(links, nodes, hot)
    assert sorted(found.collect()) == sorted(g.existing_links(links, nodes).collect())
