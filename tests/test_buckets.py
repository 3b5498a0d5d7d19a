import datetime as dt

from pyspark.sql import functions as F

from punctuo.functions import buckets as B


def _one(spark, col_fn, values, typ="smallint"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_delay_bucket_edges(spark):
    vals = []
    for c in B.DELAY_CUTS:
        vals += [c - 1, c, c + 1]
    vals += [None, -32767, 32767]
    got = _one(spark, B.delay_bucket, vals)
    for v, lab in zip(vals, got):
        if v is None:
            assert lab is None
            continue
        lo, hi = B.parse_range(lab)
        assert (lo is None or v >= lo) and (hi is None or v < hi), (v, lab)
    assert len(B.DELAY_LABELS) == 39 and B.DELAY_LABELS[0] == "(,-90)" and B.DELAY_LABELS[-1] == "[91,)"


def test_ttl_bucket_edges(spark):
    vals = [c + d for c in B.TTL_CUTS for d in (-1, 0, 1)] + [None, -32767, 32767]
    got = _one(spark, B.ttl_bucket, vals)
    for v, lab in zip(vals, got):
        if v is None:
            assert lab is None
        else:
            lo, hi = B.parse_range(lab)
            assert (lo is None or v >= lo) and (hi is None or v < hi)
    assert len(B.TTL_LABELS) == 22


def test_reduced_containment(spark):
    labels = ["[-20,-15)", "[-15,-10)", "[10,15)", "[15,20)", "(,-20)", "[360,)", None]
    got = _one(spark, B.reduced_ttl_bucket, labels, "string")
    assert got == ["(,-15)", "[-15,0)", "[0,15)", "[15,)", "(,-15)", "[15,)", None]
    assert B.canonical("(-10,10]") == "[-9,11)"


def test_js_rounding(spark):
    got = _one(spark, B.minutes_from_seconds, [-150, -90, 30, 90, 150, None], "int")
    assert got == [-2, -1, 1, 2, 3, None]


def test_response_type_name(spark):
    got = _one(spark, B.response_type_name, [0, 1, 2, 3, 4, 5, 10, None], "smallint")
    assert got == ["journeys", "departures", "arrivals", "trip", "refreshJourney", None, None, None]
