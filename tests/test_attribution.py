"""Edge rules of the window join and the credit rules on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adweave.operators import attribution as att
from adweave.operators import credit_flow, joins, segments

T0 = dt.datetime(2024, 1, 10)
HOUR = dt.timedelta(hours=1)
MICRO = dt.timedelta(microseconds=1)


def exposures(spark, rows):
    return spark.createDataFrame(rows, "exposure_id long, user_id long, ts_exposure timestamp, channel string")


def conversions(spark, rows):
    return spark.createDataFrame(rows, "conversion_id long, user_id long, ts_conversion timestamp, conversion_value double")


def credit(spark, rows, method, value=1.0, **kwargs):
    joined = joins.measurement_table(exposures(spark, rows), conversions(spark, [(1, 1, T0, value)]), 30)
    return {r["channel"]: r["credit"] for r in att.attribute(joined, [method], **kwargs).collect() if r["credit"]}


@pytest.mark.parametrize("join", [joins.window_join, joins.bucketed_window_join])
def test_window_bounds(spark, join):
    ages = [dt.timedelta(0), 168 * HOUR, 168 * HOUR + MICRO, -MICRO, 6 * HOUR, 6 * HOUR - MICRO]
    exp = exposures(spark, [(i, 1, T0 - a, "a") for i, a in enumerate(ages)])
    conv = conversions(spark, [(1, 1, T0, 1.0)])
    kept = lambda lag: sorted(r["exposure_id"] for r in join(exp, conv, 7, lag).collect())
    assert kept(0) == [0, 1, 4, 5]
    assert kept(6) == [1, 4]
    assert join(exp.limit(0), conv, 7).columns[:5] == joins.JOINED[:5]


def test_equal_times_choose_lower_id(spark):
    rows = [(7, 1, T0 - HOUR, "late_id"), (3, 1, T0 - HOUR, "early_id")]
    assert credit(spark, rows, "last_touch") == {"early_id": 1.0}
    assert credit(spark, rows, "first_touch") == {"early_id": 1.0}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_position_rules(spark, n):
    rows = [(i, 1, T0 - (n - i) * HOUR, f"c{i}") for i in range(n)]
    u, w = credit(spark, rows, "u_shape"), credit(spark, rows, "w_shape")
    assert sum(u.values()) == pytest.approx(1.0)
    assert sum(w.values()) == pytest.approx(0.9 if n == 3 else 1.0)
    if n >= 3:
        assert u["c0"] == u[f"c{n - 1}"] == pytest.approx(0.4)
        assert w[f"c{n // 2}"] == pytest.approx(0.3)
    assert sum(credit(spark, rows, "w_shape", renormalize_w=True).values()) == pytest.approx(1.0)


def test_null_channel_counts_for_size_only(spark):
    rows = [(1, 1, T0 - HOUR, "a"), (2, 1, T0 - 2 * HOUR, None)]
    assert credit(spark, rows, "linear") == {"a": 0.5}
    assert credit(spark, rows, "shapley_proxy") == {"a": 1.0}
    assert credit(spark, rows, "markov_proxy", value=3.0) == {"a": 3.0}


def test_empty_cell_is_absent(spark):
    exp = exposures(spark, [(1, 1, T0 - 50 * HOUR, "a")])
    conv = conversions(spark, [(1, 1, T0, 1.0)])
    grid = att.robustness_grid(joins.measurement_table(exp, conv, 30), 1)
    cells = {(r["window_days"], r["min_lag_hours"]) for r in grid.collect()}
    assert cells == {(w, lag) for w in (3, 7, 14, 30) for lag in (0, 6, 24)}


def test_heavy_user_is_spread_without_loss(spark):
    rows = [(i, 1 if i % 3 else i, T0 - dt.timedelta(minutes=i), f"c{i % 4}") for i in range(600)]
    exp = exposures(spark, rows)
    conv = conversions(spark, [(i, 1, T0 - i * 7 * HOUR, 1.0 + i) for i in range(20)])
    key = lambda df: sorted((r["conversion_id"], r["exposure_id"]) for r in df.collect())
    plain, spread = joins.window_join(exp, conv, 3), joins.bucketed_window_join(exp, conv, 3, hot_rows=10)
    assert key(plain) == key(spread) and len(key(plain)) > 500
    whole = joins.measurement_table(exp, conv, 3, bucketed=False)
    parts = joins.measurement_table(exp, conv, 3, hot_rows=10)
    table = lambda j: {(r["method"], r["channel"]): round(r["credit"], 9) for r in att.attribute(j).collect()}
    assert table(whole) == table(parts)


def test_equal_touch_counts_are_medium(spark):
    exp = exposures(spark, [(i, i, T0, "a") for i in range(8)])
    assert {r["touch_cohort"] for r in segments.touch_cohort(exp).collect()} == {"medium"}


def test_credit_does_not_depend_on_partitions(spark):
    rows = [(i, i % 5, T0 - i * HOUR, f"c{i % 3}") for i in range(60)]
    conv = conversions(spark, [(i, i, T0, 2.0) for i in range(5)])
    results = []
    for parts in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        exp = exposures(spark, rows).repartition(int(parts)).orderBy(F.rand(3))
        table = att.attribute(joins.measurement_table(exp, conv, 7)).collect()
        results.append(sorted((r["method"], r["channel"], round(r["credit"], 9)) for r in table))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_touch_log_shape(spark):
    raw = spark.createDataFrame(
        [("10", "u", "a", "0", "-1", "-1"), ("20", "u", "a", "1", "30", "5"), ("25", "u", "b", "1", "30", "5"), ("40", "u", "b", "1", "30", "5"), ("x", "u", "b", "1", "30", "5")],
        "timestamp string, uid string, campaign string, conversion string, conversion_timestamp string, conversion_id string",
    )
    exp, conv = joins.shape_touch_log(raw)
    assert exp.count() == 4 and conv.count() == 1
    assert exp.select("exposure_id").distinct().count() == 4


@pytest.mark.parametrize("days, lag", [(3, 0), (7, 6), (1, 0)])
def test_timelines_equal_pairs(spark, days, lag):
    """Ties in time, null channels and a user with most of the data."""
    rows = [(i, 1 if i % 3 else i % 11, T0 - dt.timedelta(minutes=(i * 37 % 900) * 10), None if i % 17 == 0 else f"c{i % 4}") for i in range(700)]
    exp = exposures(spark, rows)
    conv = conversions(spark, [(i, 1 if i % 2 else i % 11, T0 - i * 5 * HOUR, 1.0 + i) for i in range(40)])
    pairs = att.attribute(joins.measurement_table(exp, conv, days, lag))
    flow = credit_flow.attribute_timelines(exp, conv, days, lag)
    table = lambda df: {(r["method"], r["channel"]): r["credit"] for r in df.collect() if abs(r["credit"]) > 1e-9}
    want, got = table(pairs), table(flow)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-7) for k in want)


def test_twenty_years_and_one_day_with_most_rows(spark):
    rows = [(i, 1, T0 - i * 90 * 24 * HOUR - dt.timedelta(minutes=i), f"c{i % 3}") for i in range(80)]
    rows += [(100 + i, 1, T0 - 4_000 * 24 * HOUR + dt.timedelta(seconds=i // 3), f"c{i % 4}") for i in range(900)]
    exp = exposures(spark, rows)
    conv = conversions(spark, [(i, 1, T0 - i * 90 * 24 * HOUR, 1.0 + i) for i in range(80)] + [(200 + i, 1, T0 - 4_000 * 24 * HOUR + i * HOUR, 5.0 + i) for i in range(30)])
    pairs = att.attribute(joins.measurement_table(exp, conv, 7, 0))
    table = lambda df: {(r["method"], r["channel"]): r["credit"] for r in df.collect() if abs(r["credit"]) > 1e-9}
    want, got = table(pairs), table(credit_flow.attribute_timelines(exp, conv, 7))
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-7) for k in want)


def test_grid_without_pairs(spark):
    exp = exposures(spark, [(i, i % 4, T0 - dt.timedelta(minutes=i * 97), f"c{i % 3}") for i in range(80)])
    conv = conversions(spark, [(i, i % 4, T0 - i * 9 * HOUR, 1.0 + i) for i in range(12)])
    rounded = lambda grid: {
        (r["window_days"], r["min_lag_hours"], r["method"]): (round(r["total_credit"], 7), r["coverage_pct"], r["top_channel"]) for r in grid.collect()
    }
    pairs = att.robustness_grid(joins.measurement_table(exp, conv, 3), conv.count(), (1, 3), (0, 6))
    assert rounded(credit_flow.robustness(exp, conv, (1, 3), (0, 6))) == rounded(pairs)


def test_grid_in_groups_of_cells(spark, monkeypatch):
    """A few cells go through the passes at a time where all would make too many rows; the grid is the same."""
    exp = exposures(spark, [(i, i % 4, T0 - dt.timedelta(minutes=i * 97), f"c{i % 3}") for i in range(80)])
    conv = conversions(spark, [(i, i % 4, T0 - i * 9 * HOUR, 1.0 + i) for i in range(12)])
    rounded = lambda grid: sorted((r["window_days"], r["min_lag_hours"], r["method"], round(r["total_credit"], 7), r["coverage_pct"], r["top_channel"]) for r in grid.collect())
    want = rounded(credit_flow.robustness(exp, conv, (1, 3, 7), (0,)))
    sizes, rows = [], credit_flow._credit_rows
    monkeypatch.setattr(credit_flow, "PASS_ROWS", 2 * 92)
    monkeypatch.setattr(credit_flow, "_credit_rows", lambda placed, cells, half_life: sizes.append(len(cells)) or rows(placed, cells, half_life))
    assert rounded(credit_flow.robustness(exp, conv, (1, 3, 7), (0,))) == want and len(want) == 3 * 8
    assert sizes == [2, 1]


def test_small_credit_stays_and_no_dust_appears(spark):
    """A channel with tiny credit beside large totals has its row, one without touches in the window has none."""
    rows = [(i, 1, T0 - i * HOUR, "big") for i in range(50)] + [(90, 2, T0 - HOUR, "tiny"), (91, 1, T0 - 2_000 * HOUR, "old")]
    conv = conversions(spark, [(i, 1, T0 - i * HOUR, 1e15) for i in range(40)] + [(99, 2, T0, 1e-15)])
    got = {(r["method"], r["channel"]): r["credit"] for r in credit_flow.attribute_timelines(exposures(spark, rows), conv, 7).collect()}
    assert got["linear", "tiny"] == pytest.approx(1e-15) and not [k for k in got if k[1] == "old"]


@pytest.mark.parametrize("exposed, bought", [(5, 1200), (1200, 5), (300, 300)])
def test_one_user_is_cut_into_blocks_on_both_sides(spark, exposed, bought):
    exp = exposures(spark, [(i, 1, T0 - dt.timedelta(minutes=i % 50), f"c{i % 3}") for i in range(exposed)])
    conv = conversions(spark, [(i, 1, T0 + dt.timedelta(minutes=i % 70), 1.0) for i in range(bought)] + [(9_999, 2, T0, 1.0)])
    plain = exp.join(conv, "user_id").where("ts_conversion >= ts_exposure and ts_conversion <= ts_exposure + interval 1 day").count()
    for join in (joins.window_join, joins.bucketed_window_join):
        got = join(exp, conv, 1, hot_rows=100)
        assert got.count() == got.select("exposure_id", "conversion_id").distinct().count() == plain
    cut = joins._in_blocks(exp, conv.select("user_id", "conversion_id"), ["user_id"], "exposure_id", "conversion_id", 100)
    assert cut.count() == exposed * bought


def journey_events(spark, rows):
    return spark.createDataFrame(rows, "resolved_id long, record_id long, event_order long, channel string, conversion_event int")


def test_top_paths_of_one_long_and_many_short_identities(spark):
    rows = [(0, i % 3, i, f"c{i * i % 7}", int(i == 5)) for i in range(3_000)]
    for k in range(1, 60):
        rows += [(k, 0, i, "abc"[(i + k % 4) % 3], int(i == 0 and k % 5 > 0)) for i in range(1 + k % 4)]
    rows += [(100, 0, 1, None, 1), (101, 0, 1, None, 0), (102, 0, 2, "a", 1), (102, 0, 1, None, 0)]
    want = {}
    for k in {r[0] for r in rows}:
        held = sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1]))
        if any(r[4] for r in held):
            path = " > ".join(r[3] for r in held if r[3] is not None)
            want[path] = want.get(path, 0) + 1
    top = sorted(want.items(), key=lambda x: (-x[1], x[0]))
    df = journey_events(spark, rows)
    for k in (1, 3, 50):
        assert [(r["path"], r["n_converted_users"]) for r in segments.top_paths(df, k).collect()] == top[:k]
    steps = segments.journey_steps(df).where("resolved_id = 0").collect()
    assert sorted((r["step"], r["channel"]) for r in steps) == [(i + 1, f"c{i * i % 7}") for i in range(3_000)]
    assert segments.top_paths(df.limit(0)).count() == 0
