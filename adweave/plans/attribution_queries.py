"""Registered queries: joins, attribution, segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from adweave.functions import scalar as fn
from adweave.operators import attribution as att
from adweave.operators import credit_flow, joins, segments
from adweave.plans import fixtures as fx
from adweave.plans.fixtures import with_ctes

BASE = ["exposures", "conversions", "joined"]
QUERIES, ORACLE = {}, {}


def _register(name, sql=None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


_PAIRS = """SELECT conversion_id, user_id, exposure_id, channel, round(conversion_value, 6) AS conversion_value,
  epoch_us(ts_exposure) AS exposure_us, epoch_us(ts_conversion) AS conversion_us, round(hours, 6) AS hours_before_conversion FROM joined"""


def _present(df):
    return df.select(
        "conversion_id", "user_id", "exposure_id", "channel", F.round("conversion_value", 6).alias("conversion_value"),
        fn.epoch_micros("ts_exposure").alias("exposure_us"), fn.epoch_micros("ts_conversion").alias("conversion_us"),
        F.round("hours_before_conversion", 6).alias("hours_before_conversion"),
    )


@_register("jn1_window_join", with_ctes(BASE, _PAIRS))
def _(spark, d):
    return _present(joins.window_join(fx.exposures(spark, d), fx.conversions(spark, d), 7))


@_register("jn2_bucketed_window_join", with_ctes(BASE, _PAIRS))
def _(spark, d):
    return _present(joins.bucketed_window_join(fx.exposures(spark, d), fx.conversions(spark, d), 7, hot_rows=20))


_TOUCHES = """SELECT event_id, user_id, CAST(event_type = 'purchase' AS INT) AS conversion FROM events"""


@_register(
    "jn3_restrict_to_converters",
    f"WITH t AS ({_TOUCHES}) SELECT event_id, user_id, conversion FROM t WHERE user_id IN (SELECT user_id FROM t WHERE conversion = 1)",
)
def _(spark, d):
    touches = fx.table(spark, d, "events").select("event_id", "user_id", (F.col("event_type") == "purchase").cast("int").alias("conversion"))
    return joins.restrict_to_converters(touches)


_RANK1 = "row_number() OVER (PARTITION BY conversion_id ORDER BY ts_exposure {d}, exposure_id) AS rn"
_POS = """SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY ts_exposure, exposure_id) - 1 AS pos,
  count(*) OVER (PARTITION BY {k}) AS n FROM {src}"""
_W = """CASE WHEN n <= 2 THEN 1.0::DOUBLE / n ELSE (CASE WHEN pos = 0 OR pos = n - 1 OR pos = n // 2 THEN 0.3::DOUBLE
  WHEN n > 3 THEN 0.1::DOUBLE / (n - 3) ELSE 0 END) END"""
_U = "CASE WHEN n = 1 THEN 1 WHEN n = 2 THEN 0.5::DOUBLE WHEN pos IN (0, n - 1) THEN 0.4::DOUBLE ELSE 0.2::DOUBLE / (n - 2) END"


def credit_sql(method: str, src: str = "joined", by: tuple[str, ...] = ()) -> str:
    """Independent SQL of one rule: (by…, channel, credit) over ``src``."""
    b = "".join(f"{c}, " for c in by)
    k = b + "conversion_id"
    g = f"GROUP BY {b}channel"
    decay = "exp(-ln(2) * hours / 48.0)"
    if method in ("last_touch", "first_touch"):
        d = "DESC" if method == "last_touch" else "ASC"
        return f"""SELECT {b}channel, sum(conversion_value) AS credit FROM (SELECT *, row_number() OVER
          (PARTITION BY {k} ORDER BY ts_exposure {d}, exposure_id) AS rn FROM {src}) WHERE rn = 1 {g}"""
    if method == "linear":
        return f"SELECT {b}channel, sum(conversion_value / n) AS credit FROM ({_POS.format(k=k, src=src)}) {g}"
    if method == "time_decay":
        return f"""SELECT {b}channel, sum(conversion_value * w / t) AS credit FROM (SELECT *, {decay} AS w,
          sum({decay}) OVER (PARTITION BY {k}) AS t FROM {src}) {g}"""
    if method in ("u_shape", "w_shape"):
        w = _U if method == "u_shape" else _W
        return f"SELECT {b}channel, sum(conversion_value * ({w})) AS credit FROM ({_POS.format(k=k, src=src)}) {g}"
    if method == "shapley_proxy":
        return f"""SELECT {b}channel, sum(v / c) AS credit FROM (SELECT {k}, channel, any_value(conversion_value) AS v,
          count(*) OVER (PARTITION BY {k}) AS c FROM {src} GROUP BY {k}, channel) {g}"""
    eq = " AND ".join(f"s.{c} = t.{c}" for c in by) or "TRUE"
    sel = "".join(f"s.{c}, " for c in by)
    tot = f"(SELECT {b}sum(v) AS v FROM (SELECT DISTINCT {k}, conversion_value AS v FROM {src}) {('GROUP BY ' + b[:-2]) if by else ''}) t"
    over = f"PARTITION BY {b[:-2]}" if by else ""
    return f"""SELECT {sel}s.channel, s.n / s.a * t.v AS credit FROM (SELECT {b}channel, count(DISTINCT conversion_id)::DOUBLE AS n,
      sum(count(DISTINCT conversion_id)) OVER ({over}) AS a FROM {src} {g}) s JOIN {tot} ON {eq}"""


def all_credit_sql(src: str = "joined", by: tuple[str, ...] = ()) -> str:
    b = "".join(f"{c}, " for c in by)
    return " UNION ALL ".join(f"SELECT {b}'{m}' AS method, channel, credit FROM ({credit_sql(m, src, by)})" for m in att.METHODS)


def _single(number: int, method: str) -> None:
    body = f"SELECT channel, round(credit, 6) AS credit FROM ({credit_sql(method)})"

    @_register(f"att{number}_{method}", with_ctes(BASE, body))
    def _(spark, d):
        table = credit_flow.credit_by_channel(fx.exposures(spark, d), fx.conversions(spark, d), 7, methods=[method])
        return table.where("credit <> 0").select("channel", F.round("credit", 6).alias("credit"))


for _number, _method in enumerate(att.METHODS, start=1):
    _single(_number, _method)


@_register("att9_all_methods", with_ctes(BASE, f"SELECT method, channel, round(credit, 6) AS credit FROM ({all_credit_sql()})"))
def _(spark, d):
    table = credit_flow.credit_by_channel(fx.exposures(spark, d), fx.conversions(spark, d), 7)
    return table.select("method", "channel", F.round("credit", 6).alias("credit"))


_PIVOT = ", ".join(f"round(coalesce(sum(credit) FILTER (method = '{m}'), 0), 6) AS {m}" for m in att.METHODS)


@_register("att10_method_pivot", with_ctes(BASE, f"SELECT channel, {_PIVOT} FROM ({all_credit_sql()}) GROUP BY channel"))
def _(spark, d):
    pivot = att.method_pivot(credit_flow.credit_by_channel(fx.exposures(spark, d), fx.conversions(spark, d), 7))
    return pivot.select("channel", *[F.round(m, 6).alias(m) for m in att.METHODS])


_CELLS = f"""SELECT j.*, w.w AS window_days, l.l AS min_lag_hours FROM joined j, (VALUES {', '.join(f'({w})' for w in att.WINDOWS)}) w(w),
  (VALUES {', '.join(f'({x})' for x in att.LAGS)}) l(l) WHERE hours >= l.l AND hours <= w.w * 24"""
_CELL = ("window_days", "min_lag_hours")
_GRID = """SELECT c.window_days, c.min_lag_hours, c.method, sum(credit) AS total_credit,
  round(100.0::DOUBLE * any_value(v.n) / (SELECT count(DISTINCT conversion_id) FROM conversions), 2) AS coverage_pct,
  arg_min(channel, (-round(credit, 9), channel)) AS top_channel
  FROM credits c JOIN (SELECT window_days, min_lag_hours, count(DISTINCT conversion_id) AS n FROM cells GROUP BY 1, 2) v
  ON v.window_days = c.window_days AND v.min_lag_hours = c.min_lag_hours GROUP BY 1, 2, 3"""


def _grid_sql(body: str) -> str:
    ctes = [f"{n} AS ({fx.SQL[n]})" for n in BASE[:2]]
    ctes += [f"joined AS ({fx.joined_sql(30)})", f"cells AS ({_CELLS})", f"credits AS ({all_credit_sql('cells', _CELL)})", f"grid AS ({_GRID})"]
    return "WITH " + ", ".join(ctes) + body


def _grid(spark, d):
    return credit_flow.robustness(fx.exposures(spark, d), fx.conversions(spark, d))


@_register(
    "att11_robustness_grid",
    _grid_sql(" SELECT window_days, min_lag_hours, method, round(total_credit, 5) AS total_credit, coverage_pct, top_channel FROM grid"),
)
def _(spark, d):
    return _grid(spark, d).withColumn("total_credit", F.round("total_credit", 5))


@_register(
    "att12_stability",
    _grid_sql(
        """ SELECT method, round(avg(coverage_pct), 6) AS avg_coverage_pct, count(DISTINCT top_channel) AS top_channel_nunique,
        round(stddev_samp(total_credit), 5) AS total_credit_std FROM grid GROUP BY method"""
    ),
)
def _(spark, d):
    return att.stability(_grid(spark, d)).select(
        "method", F.round("avg_coverage_pct", 6).alias("avg_coverage_pct"), "top_channel_nunique", F.round("total_credit_std", 5).alias("total_credit_std")
    )


SEGMENT_SQL = {
    "touch": "SELECT user_id, count(*) AS touch_count FROM exposures GROUP BY 1",
    "pct": """SELECT *, ((SELECT count(*) FROM touch b WHERE b.touch_count < a.touch_count)
      + ((SELECT count(*) FROM touch b WHERE b.touch_count = a.touch_count) + 1) / 2.0::DOUBLE) / (SELECT count(*) FROM touch) AS p FROM touch a""",
    "cohort": """SELECT user_id, touch_count, CASE WHEN p <= 1.0::DOUBLE/3 THEN 'low' WHEN p <= 2.0::DOUBLE/3 THEN 'medium' ELSE 'high' END AS touch_cohort FROM pct""",
    "dom": """SELECT user_id, channel AS dominant_channel FROM (SELECT user_id, channel, row_number() OVER (PARTITION BY user_id
      ORDER BY count(*) DESC, channel) AS rn FROM exposures GROUP BY 1, 2) WHERE rn = 1""",
    "camp": """SELECT user_id, k AS campaign_cohort FROM (SELECT user_id, right(channel, 1) AS k, row_number() OVER (PARTITION BY user_id
      ORDER BY count(*) DESC, right(channel, 1)) AS rn FROM exposures GROUP BY 1, 2) WHERE rn = 1""",
    "segments": "SELECT c.*, dominant_channel, campaign_cohort FROM cohort c LEFT JOIN dom USING (user_id) LEFT JOIN camp USING (user_id)",
}
_SEG_COLS = ["touch_cohort", "dominant_channel", "campaign_cohort"]
_SLICED = " UNION ALL ".join(
    f"SELECT j.*, '{c}' AS segment_col, coalesce(s.{c}, 'nan') AS segment_value FROM joined j LEFT JOIN segments s USING (user_id)" for c in _SEG_COLS
)
_SLICE_BY = ("segment_col", "segment_value")
_SLICES = dict(SEGMENT_SQL, sliced=_SLICED, slices=all_credit_sql("sliced", _SLICE_BY))


def _slices(spark, d):
    exp = fx.exposures(spark, d)
    return credit_flow.credit_by_segment(exp, fx.conversions(spark, d), segments.user_segments(exp), _SEG_COLS, 7)


@_register("jn4_attach_segments", with_ctes(BASE, "SELECT exposure_id, conversion_id, touch_count, touch_cohort, dominant_channel, campaign_cohort FROM joined LEFT JOIN segments USING (user_id)", **SEGMENT_SQL))
def _(spark, d):
    exp = fx.exposures(spark, d)
    joined = joins.window_join(exp, fx.conversions(spark, d), 7)
    return joins.attach_labels(joined, segments.user_segments(exp), "user_id").select("exposure_id", "conversion_id", "touch_count", *_SEG_COLS)


@_register("att13_segment_slices", with_ctes(BASE, "SELECT segment_col, segment_value, method, channel, round(credit, 6) AS credit FROM slices", **_SLICES))
def _(spark, d):
    return _slices(spark, d).withColumn("credit", F.round("credit", 6)).where("credit <> 0")


ORACLE["att13_segment_slices"] += " WHERE round(credit, 6) <> 0"


@_register(
    "att14_top_channel_per_slice",
    with_ctes(BASE, """SELECT segment_col, segment_value, method, channel, round(credit, 6) AS credit FROM (SELECT *, row_number() OVER
      (PARTITION BY segment_col, segment_value, method ORDER BY round(credit, 9) DESC, channel) AS rn FROM slices) WHERE rn = 1""", **_SLICES),
)
def _(spark, d):
    return att.top_channel_per_slice(_slices(spark, d)).withColumn("credit", F.round("credit", 6))


@_register(
    "att15_coverage_summary",
    with_ctes(BASE, """SELECT 7 AS lookback_days, (SELECT count(DISTINCT conversion_id) FROM conversions) AS total_conversions,
      count(DISTINCT conversion_id) AS matched_conversions, round(100.0::DOUBLE * count(DISTINCT conversion_id)
      / (SELECT count(DISTINCT conversion_id) FROM conversions), 2) AS coverage_pct FROM joined"""),
)
def _(spark, d):
    return att.coverage_summary(credit_flow.window_counts(fx.exposures(spark, d), fx.conversions(spark, d), 7)[0], 7)


@_register(
    "att16_coverage_operations",
    with_ctes(
        BASE,
        """SELECT unnest(['conversions_total','conversions_attributed_7d','conversions_unattributed_7d','users_total_union','users_matched_7d',
        'users_unmatched_7d','exposure_events_total','exposure_events_matched_7d','exposure_events_unmatched_7d']) AS metric,
        unnest([c, ca, c - ca, u, um, u - um, e, em, e - em]) AS value FROM (SELECT (SELECT count(*) FROM conversions) AS c,
        (SELECT count(DISTINCT conversion_id) FROM joined) AS ca, (SELECT count(*) FROM (SELECT user_id FROM exposures UNION
        SELECT user_id FROM conversions)) AS u, (SELECT count(DISTINCT user_id) FROM joined) AS um, (SELECT count(*) FROM exposures) AS e,
        (SELECT count(DISTINCT exposure_id) FROM joined) AS em)""",
    ),
)
def _(spark, d):
    return att.coverage_operations(*credit_flow.window_counts(fx.exposures(spark, d), fx.conversions(spark, d), 7), 7)


@_register("seg1_touch_cohort", with_ctes(BASE[:1], "SELECT * FROM cohort", **{k: SEGMENT_SQL[k] for k in ("touch", "pct", "cohort")}))
def _(spark, d):
    return segments.touch_cohort(fx.exposures(spark, d))


@_register("seg2_dominant_channel", with_ctes(BASE[:1], "SELECT * FROM dom", dom=SEGMENT_SQL["dom"]))
def _(spark, d):
    return segments.dominant(fx.exposures(spark, d), "channel", "dominant_channel")


@_register("seg3_campaign_cohort", with_ctes(BASE[:1], "SELECT * FROM camp", camp=SEGMENT_SQL["camp"]))
def _(spark, d):
    return segments.dominant(fx.exposures(spark, d).withColumn("k", fn.last_char_key("channel")), "k", "campaign_cohort")


@_register("seg4_user_segments", with_ctes(BASE[:1], "SELECT * FROM segments", **SEGMENT_SQL))
def _(spark, d):
    return segments.user_segments(fx.exposures(spark, d))
