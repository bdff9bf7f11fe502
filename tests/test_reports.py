"""Distinct counts by bitmaps, and the size of the stand-in fact."""

import pytest

from playmart.plans.reports import count_distinct_ids, plays_by_level
from playmart.registry import QUERIES, _plays


def test_repeated_and_null_ids(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("b", None), (None, 5), (None, 32_768), (None, 40_000), ("c", 0), ("c", 10**15)]
    df = spark.createDataFrame(rows, "level string, songplay_id bigint")
    found = {r.level: r.song_plays for r in plays_by_level(df).collect()}
    assert found == {"a": 1, "b": 0, None: 3, "c": 2}
    assert count_distinct_ids(df.limit(0), "level", "songplay_id", "n").count() == 0


def test_buckets_are_shuffled_rather_than_ids(spark):
    df = spark.range(0, 2_000_000, 1, 8).selectExpr("id AS songplay_id", "cast(id % 3 AS string) AS level")
    result = plays_by_level(df)
    assert {r.level: r.song_plays for r in result.collect()} == {"0": 666_667, "1": 666_667, "2": 666_666}
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "songplay_id" not in plan.split("hashpartitioning", 1)[1].split("Aggregate", 1)[0]
    nodes, found = [result._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        nodes += [node.children().apply(i) for i in range(node.children().length())]
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
    assert found and max(found) < 2000


@pytest.mark.parametrize("name", ["songplays"])
def test_the_fact_grows_with_the_plays(spark, name):
    shares = []
    for sf_dir in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        shares.append(QUERIES["join_artist_title"](spark, sf_dir).count() / QUERIES["staging_events"](spark, sf_dir).count())
        assert _plays(spark, sf_dir).count() > 0
    assert abs(shares[0] / shares[1] - 1) <= 0.1
