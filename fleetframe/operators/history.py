"""Trailing-row aggregates ("the previous N rows of the same key"), skew-safe.

Two entry points: ``trailing_sums`` for sums and counts of integers (what the
history features use: one pass per row via running totals, see below) and
``trailing_aggregates`` for any aggregate over a sliding frame.

``Window.partitionBy(key).orderBy(...).rowsBetween(-N, -1)`` sends every row
of a key to one task.  When one vehicle, route or priority class holds a large
share of all rows, that task does a large share of the whole job.
``trailing_aggregates`` computes exactly the same values while bounding the
work per task:

1. range-partition on (key, order) into ``chunks`` partitions: a hot key is
   split into contiguous runs, one per chunk; rows get (chunk, row id) and the
   result is written once to the shared checkpoint folder (fixes the ids);
2. count rows per (key, chunk) (map-side combined);
3. for a chunk where a key continues from earlier chunks, list which of the
   key's earlier rows fall inside its first frame: the last ``N`` rows of the
   key before the chunk ("halo").  Only the first key of a chunk can continue,
   so this list has at most ``chunks * N`` entries: a proven bound, broadcast;
4. copy those halo rows into the chunk, evaluate the window per (key, chunk)
   and drop the copies.

Work per task is bounded by the chunk size plus ``N`` rows.  Frames use a
total order: ``order_by`` must be unique within ``partition_by``.

``trailing_aggregates`` first measures the largest key and the total (one
aggregate pass, combined map-side).  A key is hot when it holds more than
``skewFactor`` times the rows of an average shuffle partition (but at least
``minSplitRows``), or more than ``maxKeyRows`` in any case (session confs
``fleetframe.history.*``).  Without a hot key the plain window is already
balanced and runs as is (one shuffle); otherwise the chunked plan runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetframe.operators.joins import broadcast_budget_bytes
from fleetframe.session import materialize

# When a key is split (see module doc).
MAX_KEY_ROWS_CONF = "fleetframe.history.maxKeyRows"
DEFAULT_MAX_KEY_ROWS = 5_000_000
SKEW_FACTOR_CONF = "fleetframe.history.skewFactor"
DEFAULT_SKEW_FACTOR = 4.0
MIN_SPLIT_ROWS_CONF = "fleetframe.history.minSplitRows"
DEFAULT_MIN_SPLIT_ROWS = 100_000
# Target rows per chunk of the split plan (more chunks for larger inputs).
CHUNK_ROWS_CONF = "fleetframe.history.chunkRows"
DEFAULT_CHUNK_ROWS = 1_000_000
# Bytes per row of the halo plan (key columns, chunk ids, counts).
_HALO_ROW_BYTES = 96

_CHUNK, _ROW, _N, _LAST = "_tw_chunk", "_tw_row", "_tw_n", "_tw_last"
_TARGET, _HALO = "_tw_target", "_tw_halo"


def plain_trailing_aggregates(df: DataFrame, partition_by, order_by, frame: int,
                              aggregates: dict[str, Column]) -> DataFrame:
    """Reference form: one Spark window per key (all rows of a key in one task)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(-frame, -1)
    return df.withColumns({name: agg.over(w) for name, agg in aggregates.items()})


def _default_chunks(df: DataFrame, total_rows: int | None = None) -> int:
    """At least the shuffle partitions; more when the input is large."""
    conf = df.sparkSession.conf
    base = int(conf.get("spark.sql.shuffle.partitions", "200"))
    if not total_rows:
        return base
    per_chunk = int(conf.get(CHUNK_ROWS_CONF, str(DEFAULT_CHUNK_ROWS)))
    return max(base, -(-total_rows // per_chunk))


def _same_key(left: DataFrame, right: DataFrame, keys) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def halo_plan(counts: DataFrame, partition_by, frame: int) -> DataFrame:
    """Per (key, target chunk): which earlier chunk to copy how many tail rows from.

    ``counts`` has one row per (key, chunk) with the row count and last row id.
    """
    w_prev = Window.partitionBy(*partition_by).orderBy(_CHUNK).rowsBetween(-frame, -1)
    prev = F.collect_list(F.struct(F.col(_CHUNK).alias("c"), F.col(_N).alias("n"),
                                   F.col(_LAST).alias("last"))).over(w_prev)
    with_prev = counts.select(*partition_by, F.col(_CHUNK).alias(_TARGET), prev.alias("prev"))
    size = F.size("prev")

    def entry(x, i):
        # rows of the key strictly between source chunk x and the target chunk
        between = F.aggregate(F.slice("prev", i + 2, size - i - 1), F.lit(0).cast("long"),
                               lambda acc, y: acc + y["n"])
        take = F.least(x["n"], F.greatest(F.lit(0).cast("long"), F.lit(frame).cast("long") - between))
        return F.struct(x["c"].alias("src"), x["last"].alias("last"), take.alias("take"))

    return (with_prev.filter(size > 0)
            .select(*partition_by, _TARGET, F.explode(F.transform("prev", entry)).alias("e"))
            .select(*partition_by, _TARGET, F.col("e.src").alias("src"),
                    F.col("e.last").alias("last"), F.col("e.take").alias("take"))
            .filter(F.col("take") > 0))


def hot_key_rows(spark, total_rows: int) -> float:
    """Rows above which one key is split into chunks."""
    conf = spark.conf
    cap = int(conf.get(MAX_KEY_ROWS_CONF, str(DEFAULT_MAX_KEY_ROWS)))
    factor = float(conf.get(SKEW_FACTOR_CONF, str(DEFAULT_SKEW_FACTOR)))
    floor = int(conf.get(MIN_SPLIT_ROWS_CONF, str(DEFAULT_MIN_SPLIT_ROWS)))
    partitions = max(1, int(conf.get("spark.sql.shuffle.partitions", "200")))
    return min(cap, max(floor, factor * total_rows / partitions))


def key_profile(df: DataFrame, partition_by) -> tuple[int, int]:
    """(rows of the most frequent key, all rows); NULL keys count as one key."""
    counts = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows"))
    row = counts.agg(F.max("_rows"), F.sum("_rows")).first()
    return int(row[0] or 0), int(row[1] or 0)


def key_profiles(df: DataFrame, key_sets: dict[str, list]) -> dict[str, tuple[int, int]]:
    """``key_profile`` for several key sets of one table, measured in one job."""
    parts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
             .agg(F.max("_rows").alias("largest"), F.sum("_rows").alias("total"))
             .select(F.lit(name).alias("name"), "largest", "total")
             for name, keys in key_sets.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return {r["name"]: (int(r["largest"] or 0), int(r["total"] or 0)) for r in union.collect()}


def is_hot(df: DataFrame, profile: tuple[int, int]) -> bool:
    largest, total = profile
    return largest > hot_key_rows(df.sparkSession, total)


def trailing_aggregates(df: DataFrame, partition_by, order_by, frame: int,
                        aggregates: dict[str, Column], chunks: int | None = None,
                        profile: tuple[int, int] | None = None) -> DataFrame:
    """Add ``aggregates`` evaluated over the previous ``frame`` rows of each key.

    ``aggregates`` maps output names to aggregate expressions (``F.avg(...)``,
    ``F.count(...)``, ...) that are applied ``.over`` the trailing frame.
    ``profile``: ``key_profile`` of the input, if the caller measured it.
    """
    if profile is None:
        profile = key_profile(df, partition_by)
    if not is_hot(df, profile):
        return plain_trailing_aggregates(df, partition_by, order_by, frame, aggregates)
    chunks = chunks or _default_chunks(df, profile[1])
    return chunked_trailing_aggregates(df, partition_by, order_by, frame, aggregates, chunks)


def with_halo(df: DataFrame, partition_by, order_by, frame: int, chunks: int) -> DataFrame:
    """Steps 1-3 of the split plan: every row tagged with its chunk (``_tw_target``)
    plus copies of the rows each chunk needs from before it (``_tw_halo`` true)."""
    partition_by, order_by = list(partition_by), list(order_by)
    cols = df.columns
    # The range exchange samples its input before shuffling it; keep the input
    # for those two passes only (a lost block is recomputed from lineage).
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        keyed = (source.repartitionByRange(chunks, *partition_by, *order_by)
                 .sortWithinPartitions(*partition_by, *order_by)
                 .withColumns({_CHUNK: F.spark_partition_id(), _ROW: F.monotonically_increasing_id()}))
        keyed = materialize(keyed, "trailing")
    finally:
        source.unpersist()

    counts = keyed.groupBy(*partition_by, _CHUNK).agg(
        F.count(F.lit(1)).alias(_N), F.max(_ROW).alias(_LAST))
    plan = halo_plan(counts, partition_by, frame)  # <= chunks * frame rows

    # the plan has at most chunks * frame rows: broadcast it while that bound
    # fits the session's budget, else join it by shuffle
    small = chunks * frame * _HALO_ROW_BYTES <= broadcast_budget_bytes(df.sparkSession)
    k, p = keyed.alias("k"), plan.alias("p")
    cond = (_same_key(k, p, partition_by) & (k[_CHUNK] == p["src"])
            & (k[_ROW] > p["last"] - p["take"]))
    halo = (k.join(F.broadcast(p) if small else p, cond, "inner")
            .select(*[k[c] for c in cols], p[_TARGET].alias(_TARGET), F.lit(True).alias(_HALO)))
    own = keyed.select(*cols, F.col(_CHUNK).alias(_TARGET), F.lit(False).alias(_HALO))
    return own.unionByName(halo)


def chunked_trailing_aggregates(df: DataFrame, partition_by, order_by, frame: int,
                                aggregates: dict[str, Column], chunks: int | None = None) -> DataFrame:
    """The split-key plan (module doc, steps 1-4), whatever the key sizes."""
    chunks = chunks or _default_chunks(df)
    tagged = with_halo(df, partition_by, order_by, frame, chunks)
    w = Window.partitionBy(*partition_by, _TARGET).orderBy(*order_by).rowsBetween(-frame, -1)
    return (tagged.withColumns({name: agg.over(w) for name, agg in aggregates.items()})
            .filter(~F.col(_HALO))
            .drop(_TARGET, _HALO))


# --- trailing sums in one pass ------------------------------------------------------
#
# A sliding ROWS frame is evaluated by re-aggregating the frame for every row
# (work ~ rows x frame).  Sums and counts of integers can instead be read off a
# running total: sum(rows i-N .. i-1) = total(i-1) - total(i-N-1), two lags of
# one running sum (work ~ rows, exact because the values are integers).

def _trailing_sums_over(df: DataFrame, partition_by, order_by, frame: int,
                        values: dict[str, Column], wide: set[str]) -> DataFrame:
    running = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ordered = Window.partitionBy(*partition_by).orderBy(*order_by)
    kind = {n: ("decimal(38,0)" if n in wide else "long") for n in values}
    totals = {f"_run_{n}": F.sum(F.coalesce(v.cast(kind[n]), F.lit(0).cast(kind[n]))).over(running)
              for n, v in values.items()}
    with_totals = df.withColumns(totals)

    def trailing(n: str) -> Column:
        zero = F.lit(0).cast(kind[n])
        total = F.col(f"_run_{n}")
        before = F.coalesce(F.lag(total, 1).over(ordered), zero)
        dropped = F.coalesce(F.lag(total, frame + 1).over(ordered), zero)
        return before - dropped

    return with_totals.withColumns({n: trailing(n) for n in values}).drop(*totals)


def trailing_sums(df: DataFrame, partition_by, order_by, frame: int, values: dict[str, Column],
                  wide=(), chunks: int | None = None,
                  profile: tuple[int, int] | None = None) -> DataFrame:
    """Add, per row, the sums of integer ``values`` over the previous ``frame``
    rows of its key (0 for none).  A count is the sum of a 0/1 value.  ``wide``
    names values whose running totals may exceed a long (sums of squares, units of
    an efficiency over a near-zero sum): those totals and their results are
    decimal(38,0), all others long.  Hot keys are split as in ``trailing_aggregates``."""
    partition_by, order_by, wide = list(partition_by), list(order_by), set(wide)
    if profile is None:
        profile = key_profile(df, partition_by)
    if not is_hot(df, profile):
        return _trailing_sums_over(df, partition_by, order_by, frame, values, wide)
    chunks = chunks or _default_chunks(df, profile[1])
    tagged = with_halo(df, partition_by, order_by, frame, chunks)
    out = _trailing_sums_over(tagged, partition_by + [_TARGET], order_by, frame, values, wide)
    return out.filter(~F.col(_HALO)).drop(_TARGET, _HALO)
