"""The chunked trailing-window operator equals a plain Spark window."""

from conftest import rows_of
import pytest
from pyspark.sql import Window, functions as F

from fleetframe.functions.exact import rounded_mean_of, unit_aggs
from fleetframe.operators.history import (
    MAX_KEY_ROWS_CONF, chunked_trailing_aggregates, plain_trailing_aggregates, trailing_aggregates,
)


def data(spark, n=3000):
    # key 0 holds a third of all rows; NULL key; many small keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 17 == 1, F.lit(None))
         .otherwise(F.col("id") % 40).alias("k"),
        ((F.col("id") * 7919) % n).alias("o"),
        (((F.col("id") * 31) % 1000) / 100.0).alias("x"))


def aggs():
    return {"c": F.count("x"), "s": F.sum("x"), "mn": F.min("x"), "mx": F.max("x"),
            "f": F.first("o")}


@pytest.mark.parametrize("chunks,frame", [(1, 3), (3, 1), (7, 3), (16, 30), (64, 30), (5, 200)])
def test_chunked_equals_plain(spark, chunks, frame):
    df = data(spark)
    plain = plain_trailing_aggregates(df, ["k"], ["o"], frame, aggs())
    chunked = chunked_trailing_aggregates(df, ["k"], ["o"], frame, aggs(), chunks=chunks)
    assert chunked.columns == plain.columns
    a, b = rows_of(plain), rows_of(chunked)
    assert len(a) == len(b) == 3000
    assert a == b


def test_multi_column_key_and_order(spark):
    df = data(spark).withColumn("k2", F.col("k") % 2).withColumn("o2", F.col("o") % 5)
    plain = plain_trailing_aggregates(df, ["k", "k2"], ["o2", "o"], 10, aggs())
    chunked = chunked_trailing_aggregates(df, ["k", "k2"], ["o2", "o"], 10, aggs(), chunks=9)
    assert rows_of(plain) == rows_of(chunked)


def test_frame_cap_and_current_row_excluded(spark):
    energies = [float(i) for i in range(1, 35)] + [1e9]
    df = spark.createDataFrame([(1, i, e) for i, e in enumerate(energies)], "v long, t long, e double")
    p = unit_aggs("e", 2)
    out = chunked_trailing_aggregates(df, ["v"], ["t"], 30, {"n": F.count("e"), **p}, chunks=4)
    rows = {r["t"]: r for r in out.select(
        "t", "n", rounded_mean_of(F.col("s"), F.col("n"), 2, 2).alias("m")).collect()}
    assert rows[0]["n"] == 0 and rows[0]["m"] is None
    assert rows[1]["n"] == 1 and rows[1]["m"] == 1.0
    last = rows[34]
    assert last["n"] == 30 and last["m"] == sum(range(5, 35)) / 30   # own 1e9 not included


def test_halo_bounded(spark):
    """Copied rows never exceed chunks * frame."""
    from fleetframe.operators import history as h
    from fleetframe.session import materialize
    df = data(spark)
    keyed = materialize(df.repartitionByRange(8, "k", "o").sortWithinPartitions("k", "o")
                        .withColumns({h._CHUNK: F.spark_partition_id(),
                                      h._ROW: F.monotonically_increasing_id()}), "t")
    counts = keyed.groupBy("k", h._CHUNK).agg(F.count(F.lit(1)).alias(h._N), F.max(h._ROW).alias(h._LAST))
    plan = h.halo_plan(counts, ["k"], 30)
    assert plan.agg(F.sum("take")).first()[0] <= 8 * 30


def test_split_only_when_a_key_is_hot(spark):
    from fleetframe.plans.inspect import plan_text
    df = data(spark)
    plain_plan = plan_text(trailing_aggregates(df, ["k"], ["o"], 5, aggs()))
    assert "_tw_target" not in plain_plan            # largest key (1000 rows) is small
    spark.conf.set(MAX_KEY_ROWS_CONF, "500")
    try:
        split = trailing_aggregates(df, ["k"], ["o"], 5, aggs(), chunks=6)
        assert "_tw_target" in plan_text(split)
        assert rows_of(split) == rows_of(plain_trailing_aggregates(df, ["k"], ["o"], 5, aggs()))
    finally:
        spark.conf.unset(MAX_KEY_ROWS_CONF)


def test_hot_key_threshold_is_relative_to_partition_size(spark):
    from fleetframe.operators.history import hot_key_rows
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        # 1e9 rows over 1000 partitions: a key above 4M rows (4x average) is hot
        assert hot_key_rows(spark, 10**9) == 4_000_000
        # small tables: never below the floor
        assert hot_key_rows(spark, 10_000) == 100_000
        # huge tables: never above the absolute cap
        assert hot_key_rows(spark, 10**12) == 5_000_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_halo_join_without_broadcast_matches(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")   # bound exceeds budget
    try:
        df = data(spark)
        chunked = chunked_trailing_aggregates(df, ["k"], ["o"], 7, aggs(), chunks=11)
        assert rows_of(chunked) == rows_of(plain_trailing_aggregates(df, ["k"], ["o"], 7, aggs()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_chunk_count_grows_with_input(spark):
    from fleetframe.operators.history import _default_chunks
    df = data(spark)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _default_chunks(df, 10) == base
    assert _default_chunks(df, 3_500_000_000) == 3500


@pytest.mark.parametrize("frame,force_split", [(1, False), (3, False), (30, False), (3, True), (30, True)])
def test_trailing_sums_equal_sliding_frames(spark, frame, force_split):
    from fleetframe.operators.history import trailing_sums
    df = data(spark).withColumn("u", (F.col("x") * 100).cast("long"))
    values = {"s": F.col("u"), "n": F.when(F.col("u").isNotNull(), 1).otherwise(0),
              "q": F.col("u").cast("decimal(38,0)") * F.col("u").cast("decimal(38,0)")}
    profile = (10**9, 10**9) if force_split else None
    got = trailing_sums(df, ["k"], ["o"], frame, values, wide={"q"}, chunks=7, profile=profile)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(-frame, -1)
    want = df.withColumns({
        "s": F.coalesce(F.sum("u").over(w), F.lit(0)).cast("long"),
        "n": F.count("u").over(w),
        "q": F.coalesce(F.sum(F.col("u") * F.col("u")).over(w), F.lit(0)).cast("long")})
    cols = ["k", "o", "s", "n", "q"]
    assert rows_of(got.select(*cols)) == rows_of(want.select(*cols))
    if force_split:
        from fleetframe.plans.inspect import plan_text
        assert "_tw_target" in plan_text(got)
