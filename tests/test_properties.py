"""Property tests against pure-Python brute force (each example checks many groups in one job)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fleetframe.functions.exact import rounded_mean_of, stddev_of, sum_of, unit_aggs, unit_values
from fleetframe.operators.history import trailing_sums

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

cents = st.integers(min_value=-10**7, max_value=10**7)
groups = st.lists(st.lists(cents, min_size=1, max_size=40), min_size=1, max_size=60)


def _half_up(values_cents, digits):
    mean = Decimal(sum(values_cents)) / Decimal(100) / Decimal(len(values_cents))
    return float(mean.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@SETTINGS
@given(groups, st.sampled_from([0, 1, 2, 3]))
def test_exact_means_equal_decimal_arithmetic(spark, data, digits):
    rows = [(g, v / 100) for g, vals in enumerate(data) for v in vals]
    df = spark.createDataFrame(rows, "g int, x double")
    parts = unit_aggs("x", 2, squares=True)
    got = df.groupBy("g").agg(*[v.alias(k) for k, v in parts.items()]).select(
        "g", rounded_mean_of(F.col("s"), F.col("n"), 2, digits).alias("m"),
        sum_of(F.col("s"), 2).alias("t"),
        stddev_of(F.col("s"), F.col("q"), F.col("n"), 2).alias("sd"))
    for r in got.collect():
        vals = data[r["g"]]
        assert r["m"] == _half_up(vals, digits)
        assert r["t"] == float(Decimal(sum(vals)) / 100)
        if len(vals) > 1:
            mean = sum(vals) / len(vals)
            var = sum((v - mean) ** 2 for v in vals) / (len(vals) - 1)
            assert abs(r["sd"] - (var ** 0.5) / 100) <= 1e-9 * max(1.0, r["sd"])
        else:
            assert r["sd"] is None


series = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), cents)), min_size=1, max_size=150)


@SETTINGS
@given(series, st.integers(1, 12), st.booleans())
def test_trailing_sums_equal_brute_force(spark, data, frame, split):
    rows = [(k, i, v) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "k int, o int, v long")
    values = {"s": F.col("v"), "n": F.when(F.col("v").isNotNull(), 1).otherwise(0),
              "q": F.col("v").cast("decimal(38,0)") * F.col("v").cast("decimal(38,0)")}
    profile = (10**9, 10**6) if split else None
    got = {(r["k"], r["o"]): (r["s"], r["n"], r["q"]) for r in trailing_sums(
        df, ["k"], ["o"], frame, values, wide={"q"}, chunks=5, profile=profile).collect()}
    by_key: dict[int, list] = {}
    for k, o, v in rows:
        by_key.setdefault(k, []).append((o, v))
    for k, seq in by_key.items():
        seq.sort()
        for i, (o, _) in enumerate(seq):
            prev = [v for _, v in seq[max(0, i - frame):i] if v is not None]
            assert got[(k, o)] == (sum(prev), len(prev), sum(v * v for v in prev)), (k, o)


coords = st.tuples(st.floats(-90, 90), st.floats(-180, 180), st.floats(-90, 90), st.floats(-180, 180))


@SETTINGS
@given(st.lists(coords, min_size=1, max_size=200))
def test_haversine_matches_python(spark, points):
    import math
    from fleetframe.functions.geo import haversine_km
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d", scale=6)).collect()]
    for (la1, lo1, la2, lo2), km in zip(points, got):
        p1, p2 = math.radians(la1), math.radians(la2)
        a = (math.sin(math.radians(la2 - la1) / 2) ** 2
             + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lo2 - lo1) / 2) ** 2)
        want = 2 * math.atan2(math.sqrt(min(a, 1.0)), math.sqrt(max(0.0, 1 - min(a, 1.0)))) * 6371.0
        assert abs(km - want) <= 1e-5, (la1, lo1, la2, lo2)
        assert 0 <= km <= 20015.09


numeric_text = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
    st.sampled_from(["NaN", "nan", "NAN", "", "  ", "abc", "1,5", "--1", " 7 ", "\\t3.5"]))


@SETTINGS
@given(st.lists(numeric_text, min_size=1, max_size=200))
def test_clean_numeric_matches_python(spark, texts):
    from fleetframe.functions.numeric import clean_numeric
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(clean_numeric("x")).collect()]
    for text, value in zip(texts, got):
        try:
            want = float(text.strip())
            want = None if want != want else want
        except ValueError:
            want = None
        assert value == want, repr(text)
