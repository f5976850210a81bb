"""Plan shape at scale: with Spark's size-based broadcast switched off (as when
every driver table is large), lookups and link-grain dimensions must still be
broadcast by their checked hint, the fact side must not be shuffled for them,
and filters/columns must reach the scan."""

import re

import pytest
from pyspark.sql import functions as F

from arrivals.operators.star import star_link, to_link_grain
from arrivals.plans.queries import QUERIES
from tests.conftest import plan_text

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_auto_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k in keys:
        spark.conf.unset(k)


def test_fact_build_decodes_broadcast_at_scale(no_auto_broadcast):
    plan = plan_text(QUERIES["build_fact"](no_auto_broadcast, SF))
    # four decodes by hint; the only sort-merge join is orders x customer inside the raw derivation
    assert plan.count("BroadcastHashJoin") == 4
    assert plan.count("SortMergeJoin") == 1


def test_role_playing_shuffles_lineitem_twice_at_scale(no_auto_broadcast):
    plan = plan_text(QUERIES["decode_role_playing"](no_auto_broadcast, SF))
    assert plan.count("BroadcastHashJoin") == 2
    assert len(re.findall(r"Exchange hashpartitioning\(l_", plan)) == 2


def test_star_links_broadcast_dimension_at_scale(no_auto_broadcast):
    for name in ("star_by_state", "star_by_state_count", "star_by_country", "arrivals_by_nation_month"):
        plan = plan_text(QUERIES[name](no_auto_broadcast, SF))
        assert "BroadcastHashJoin" in plan, name


def test_star_link_checks_the_dimension(spark):
    fact = spark.createDataFrame([(1, "CA"), (2, "NY"), (3, "TX")], "id int, st string")
    dim_src = spark.createDataFrame([("CA", 5), ("CA", 7), ("NY", 1)], "st string, n int")
    dim = to_link_grain(dim_src, "st", {"total": F.sum("n")})
    out = star_link(fact, "st", dim)
    assert sorted((r.id, r.total) for r in out.collect()) == [(1, 12), (2, 1), (3, None)]
    assert "BroadcastHashJoin" in plan_text(out)


def test_scans_prune_columns_and_push_filters(spark):
    plan = plan_text(QUERIES["drop_null_single"](spark, SF))
    assert "PushedFilters: [IsNotNull(quality), IsNotNull(doc_id)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan
    plan = plan_text(QUERIES["filter_equals"](spark, SF))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan


def test_aggregations_are_partial(spark):
    for name in ("quality_duplicate_keys", "arrivals_by_nation_month", "aggregate_by_state"):
        plan = plan_text(QUERIES[name](spark, SF))
        assert "partial_" in plan, name


def test_hot_code_over_bound_lookup_is_split_by_aqe(spark):
    """A third of the fact rows share one code and the code book is over the
    broadcast bound, so the decode is a sort-merge join. AQE's skew join must
    split the hot partition, and the result must stay exact."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from arrivals.operators.decode import decode

        n = 30_000
        fact = spark.range(n).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 1000).cast("string")).alias("code"),
        )
        book = spark.range(1000).select(F.col("id").cast("string").alias("code"), F.concat(F.lit("L"), F.col("id").cast("string")).alias("label"))
        out = decode(fact, "code", book, "label", max_broadcast_rows=10)
        agg = out.groupBy("label").count()
        counts = {r.label: r["count"] for r in agg.collect()}
        final = agg._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "skew=true" in final
        assert sum(counts.values()) == n
        assert counts["L7"] == n // 3 + sum(1 for i in range(n) if i % 3 != 0 and i % 1000 == 7)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_in_row_level_join_is_split_by_aqe(spark):
    """Row-level big join (lineitem-like fact x supplier-like table, neither
    broadcastable): a third of the fact rows on one key must be split by AQE,
    with every fact row kept."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        # The payload is used after the join (as real fact columns are), so it
        # is shuffled and the hot partition is large in bytes, not only in rows.
        fact = spark.range(n).select(
            F.col("id").alias("l_id"),
            F.rand(7).alias("payload"),
            F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id") % 500).alias("l_suppkey"),
        )
        supplier = spark.range(500).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).alias("s_nationkey"))
        joined = fact.join(supplier, fact.l_suppkey == supplier.s_suppkey, "left")
        out = joined.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("count"), F.sum("payload").alias("p"))
        total = sum(r["count"] for r in out.collect())
        final = out._jdf.queryExecution().executedPlan().toString()
        assert total == n
        assert "skew=true" in final
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_size_check_sends_one_row_per_task(spark):
    from arrivals.operators.decode import size_aggregate

    plan = plan_text(size_aggregate(spark.range(1000, numPartitions=8).withColumn("label", F.lit("abc"))))
    assert "Limit" not in plan
    assert plan.index("partial_count") > plan.index("Exchange SinglePartition")


def test_broadcast_is_bounded_by_bytes_too(spark):
    from arrivals.operators.decode import fits_broadcast

    wide = spark.range(100).withColumn("label", F.repeat(F.lit("x"), 1000))
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_bytes=50_000) and not fits_broadcast(wide, max_rows=99)


def test_decode_beyond_the_bounds_needs_no_checkpoint(spark, monkeypatch):
    from arrivals import session
    from arrivals.operators import decode as module

    monkeypatch.setattr(session, "scratch_root", lambda s: (_ for _ in ()).throw(RuntimeError("no folder")))
    book = spark.range(50).select(F.col("id").cast("string").alias("code"), F.col("id").cast("string").alias("label"))
    out = module.decode(spark.range(60).withColumn("c", F.col("id").cast("string")), "c", book, "l", max_broadcast_rows=10)
    assert out.where("l IS NOT NULL").count() == 50


def test_null_profile_never_shuffles_texts(no_auto_broadcast):
    plan = plan_text(QUERIES["null_profile"](no_auto_broadcast, SF))
    join = plan[plan.index("SortMergeJoin"):]
    flags = [line for line in join.splitlines() if "Project" in line and "isnotnull(text" in line]
    assert flags  # reduced to a flag below the exchange


def test_flagship_shuffles_the_fact_once(no_auto_broadcast):
    plan = plan_text(QUERIES["arrivals_by_nation_month"](no_auto_broadcast, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(o_custkey", plan)) == 1


def test_labels_of_one_book_share_scan_and_join(no_auto_broadcast):
    plan = plan_text(QUERIES["decode_left"](no_auto_broadcast, SF))
    assert len(re.findall(r"\bBroadcastHashJoin|SortMergeJoin", plan)) == 1


def test_normalised_star_link_never_multiplies_the_fact(spark):
    fact = spark.createDataFrame([(1, "mexico")], "id int, c string")
    dim = spark.createDataFrame([("MEXICO", 2), ("Mexico", 1)], "link_key string, t int")
    assert [(r.id, r.t) for r in star_link(fact, "c", dim, normalise="upper").collect()] == [(1, 1)]
