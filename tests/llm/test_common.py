import pyarrow as pa
from pyspark.sql import functions as F

from wattline.llm import common


def test_filter_loses_no_partner_and_drops_most_others(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 7).alias("_k"), F.lit("x").alias("text"))
    wanted = rows.where("id % 50 = 3").select("id", "_k")
    passed = common.likely(rows, wanted, ["id", "_k"])
    assert passed.columns == rows.columns
    ids = {r.id for r in passed.collect()}
    assert {i for i in range(20_000) if i % 50 == 3} <= ids and len(ids) < 420
    assert common.likely(rows, wanted.limit(0), ["id", "_k"]).count() == 0


def test_groups_join_whole_whatever_their_size(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = common.join_groups(rows, common.stored(groups, "groups"), ["k"], ["id"])
    assert sorted((r.id, r.n) for r in joined.collect()) == [(i, 1000 if i % 3 == 0 else 1) for i in range(3_000)]


def test_workers_get_no_more_rows_at_once(spark):
    def run(batches):
        for batch in batches:
            yield pa.record_batch([[batch.num_rows]], names=["n"])

    sizes = spark.range(0, 100, 1, 1).mapInArrow(run, "n long")
    before = spark.conf.get(common.BATCH)
    assert sorted(r.n for r in common.stored(sizes, "few-rows", 30).collect()) == [10, 30, 30, 30]
    assert [r.n for r in common.stored(sizes, "all-rows").collect()] == [100] and spark.conf.get(common.BATCH) == before
