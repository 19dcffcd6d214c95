"""Skew-safe window rewrites against brute force on small fixtures (H3, H4, offsets)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventmill.operators.windows import contiguous_index, latest_per_key, sessionize


def brute_sessions(rows, gap_s=1800):
    out = {}
    by_user = {}
    for u, t in rows:
        by_user.setdefault(u, []).append(t)
    for u, ts in by_user.items():
        ts.sort()
        n, prev = 0, None
        for t in ts:
            if prev is None or (t - prev).total_seconds() >= gap_s:
                n += 1
                out[(u, n)] = [t, t, 0]
            s = out[(u, n)]
            s[1] = t
            s[2] += 1
            prev = t
    return {k: tuple(v) for k, v in out.items()}


def test_sessions_cross_midnight_and_hot_user(spark):
    base = dt.datetime(2024, 1, 10, 23, 40)
    rows = [(1, base), (1, base + dt.timedelta(minutes=25)), (1, base + dt.timedelta(minutes=50)),   # spans midnight
            (1, base + dt.timedelta(hours=3)),                                                        # new session
            (2, base + dt.timedelta(minutes=31)), (2, base + dt.timedelta(minutes=62))]               # exactly-gap edge
    rnd = random.Random(7)
    t = dt.datetime(2024, 1, 1)
    for _ in range(3000):                                   # one hot user over many days
        t += dt.timedelta(seconds=rnd.choice([30, 60, 600, 1799, 1800, 1801, 7200, 86400]))
        rows.append((9, t))
    df = spark.createDataFrame(rows, "user_id long, timestamp timestamp_ntz")
    got = {(r["user_id"], r["session_no"]): (r["session_start"], r["session_end"], r["event_count"])
           for r in sessionize(df).collect()}
    assert got == brute_sessions(rows)


def test_contiguous_index_matches_rank(spark):
    rnd = random.Random(3)
    ids = rnd.sample(range(0, 1_000_000), 5000)
    df = spark.createDataFrame([(i % 3, i) for i in ids], "part int, id long")
    got = {(r["part"], r["id"]): r["offset"] for r in contiguous_index(df, "part", "id", bucket_width=50_000).collect()}
    want = {}
    for p in range(3):
        for k, i in enumerate(sorted(i for i in ids if i % 3 == p)):
            want[(p, i)] = k
    assert got == want


def test_latest_per_key_picks_greatest_version(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")],
                               "event_type string, version int, category string")
    got = {r["event_type"]: (r["version"], r["category"]) for r in latest_per_key(df, ["event_type"], "version").collect()}
    assert got == {"a": (3, "z"), "b": (1, "q")}


def test_flat_sink_splits_a_hot_date(spark):
    from core_helpers import raw_df, sample
    from eventmill.operators.transform import transform_events
    from eventmill.session import scratch_dir
    from eventmill.sinks.files import read_flat, write_flat
    rows = [sample(event_id=f"h-{i}", user_id=str(i)) for i in range(400)]   # all on one date
    ev = transform_events(raw_df(spark, rows))
    path = scratch_dir(spark, "hotdate")
    write_flat(ev, path, files=4)
    import glob
    files = glob.glob(f"{path}/event_date=2024-01-15/*.parquet")
    assert len(files) >= 2 and read_flat(spark, path).count() == 400
    assert F is not None


def test_catalog_views_run_source_style_sql(spark):
    from core_helpers import SF_SMALL
    from eventmill.plans.catalog import register_views
    from eventmill.sources.tables import events
    ev = events(spark, SF_SMALL)
    register_views(spark, ev)
    q = spark.sql("SELECT event_type, count(*) AS total_events FROM events_distributed "
                  "GROUP BY event_type ORDER BY total_events DESC LIMIT 10").collect()
    assert sum(r["total_events"] for r in q) == ev.count()
    assert spark.sql("SELECT count(*) AS n FROM performance_summary").first()["n"] == 4
    assert spark.sql("SELECT sum(event_count) AS n FROM events_hourly_distributed").first()["n"] == ev.count()


def test_exact_quantiles_match_numpy_with_narrowing(spark):
    import numpy as np
    from eventmill.operators.analytics import exact_quantiles
    rnd = np.random.default_rng(5)
    vals = np.concatenate([rnd.exponential(2.0, 20000), np.full(5000, 1.5), rnd.normal(50, 1, 300)])
    df = spark.createDataFrame([(float(x),) for x in vals], "x double")
    probs = [0.0, 0.5, 0.95, 0.99, 1.0]
    row = exact_quantiles(df, "x", probs, accuracy=200).first()          # wide brackets, none of them all values
    got, want = row["q"], np.quantile(vals, probs)                       # linear interpolation
    assert row["n"] == len(vals)
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_exact_quantiles_inside_a_large_tie(spark):
    import numpy as np
    from eventmill.operators.analytics import exact_quantiles
    vals = np.concatenate([np.full(3000, 7.25), np.arange(100, dtype=float)])
    df = spark.createDataFrame([(float(x),) for x in vals], "x double")
    got = exact_quantiles(df, "x", [0.5, 0.9], accuracy=100).first()["q"]
    assert np.allclose(got, np.quantile(vals, [0.5, 0.9]))


def test_approx_users_within_three_sigma(spark):
    from eventmill.operators.analytics import approx_users
    rsd, misses = 0.01, 0
    for seed in range(5):
        df = spark.range(40_000).select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3000)).alias("user_id"),
                                        F.lit(dt.datetime(2024, 1, 2, 3)).cast("timestamp_ntz").alias("timestamp"))
        df = df.withColumn("event_date", F.to_date("timestamp"))
        exact = df.select("user_id").distinct().count()
        misses += abs(approx_users(df, as_of="2024-01-02 10:00:00", rsd=rsd).first()[0] - exact) > 3 * rsd * exact
    assert misses == 0


def test_plans_without_expand_and_enrichment_after_the_shuffle(spark):
    from core_helpers import SF_SMALL
    from eventmill.plans.registry import queries
    for name in ("daily_users", "transform_stats", "latest_daily_user", "latency_percentiles"):
        assert "Expand" not in queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString(), name
    plan = queries()["transform_events"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "md5" in plan and "md5" not in plan[plan.index("Exchange"):]
    assert "md5" not in queries()["dedup_events"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_exact_quantiles_of_few_rows_with_the_default_accuracy(spark):
    import numpy as np
    from eventmill.operators.analytics import exact_quantiles
    probs = [0.0, 0.5, 0.95, 0.99, 1.0]
    for n in (1, 2, 3, 10, 21, 101, 1001):
        vals = np.random.default_rng(n).exponential(2.0, n)
        got = exact_quantiles(spark.createDataFrame([(float(x),) for x in vals], "x double"), "x", probs).first()["q"]
        assert None not in got and np.allclose(got, np.quantile(vals, probs), rtol=0, atol=1e-12), (n, got)


def test_exact_quantiles_rank_only_the_cells_they_need(spark):
    import numpy as np
    from eventmill.operators.analytics import exact_quantiles
    rnd = np.random.default_rng(11)
    vals = np.concatenate([rnd.lognormal(0, 4, 30000), np.full(9000, 2.5), -rnd.exponential(1e6, 500), [np.inf, -np.inf, 0.0, -0.0]])
    probs = [0.0, 0.25, 0.2501, 0.5, 0.95, 1.0]                              # two brackets overlap
    df = spark.createDataFrame([(float(x),) for x in vals], "x double")
    row = exact_quantiles(df, "x", probs, accuracy=100, cells=8)
    got = row.first()["q"]
    assert np.allclose(got[1:-1], np.quantile(vals, probs[1:-1]), rtol=0, atol=1e-12)
    assert got[0] != got[0] or got[0] == -np.inf
    empty = exact_quantiles(df.limit(0), "x", probs).first()
    assert empty["n"] == 0 and all(x is None for x in empty["q"])
