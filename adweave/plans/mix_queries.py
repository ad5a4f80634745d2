"""Registered queries: marketing mix, features, splits, data quality."""

from __future__ import annotations


from pyspark.sql import functions as F

from adweave.functions import scalar as fn
from adweave.operators import features as fea
from adweave.operators import joins, mix, models
from adweave.operators import quality as dq
from adweave.plans import fixtures as fx
from adweave.plans.fixtures import with_ctes
from adweave.plans.metric_queries import rounded

QUERIES, ORACLE = {}, {}
COEFFICIENTS = {"ad_search": 2.0, "ad_social": 1.2, "ad_display": 0.4, "ad_email": -0.3}


def _register(name, sql=None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


SPENDS = [f"spend_{c}" for c in mix.CHANNELS]
_MIX_OUT = "CAST(date AS VARCHAR) AS date, " + ", ".join(f"round({c}, 3) AS {c}" for c in ["revenue", *SPENDS])


def _shown(df, columns, digits=3):
    return df.select(F.col("date").cast("string").alias("date"), *[F.round(c, digits).alias(c) for c in columns])


def _rows(spark, d):
    """Order rows in the wide input layout, with odd letter case in two headings."""
    spend = lambda p: F.when(F.col("o_orderpriority") == p, F.col("o_totalprice") * 0.1).otherwise(0.0)
    return fx.table(spark, d, "orders").select(
        F.col("o_orderdate").alias("Date"), F.col("o_totalprice").alias("REVENUE"),
        spend("1-URGENT").alias("spend_search"), spend("2-HIGH").alias("spend_social"),
        spend("3-MEDIUM").alias("spend_display"), spend("5-LOW").alias("spend_email"),
    )


@_register("mix1_load_wide", with_ctes(["mix"], f"SELECT {_MIX_OUT} FROM mix"))
def _(spark, d):
    return _shown(mix.load_mix_wide(_rows(spark, d)), ["revenue", *SPENDS])


@_register("mix2_load_long", with_ctes(["mix"], f"SELECT {_MIX_OUT} FROM mix"))
def _(spark, d):
    return _shown(mix.load_mix_long(fx.mix_long(spark, d)), ["revenue", *SPENDS])


@_register("mix2_load_long_conversions", """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, count(*) * 120.0::DOUBLE AS revenue FROM orders GROUP BY 1""")
def _(spark, d):
    rows = fx.mix_long(spark, d).drop("revenue").withColumn("conversions", F.lit(1))
    return _shown(mix.load_mix_long(rows), ["revenue"])


_AD_CTES = {
    "numbered": "SELECT *, row_number() OVER (ORDER BY date) AS rn FROM mix",
    "ad": """SELECT rn, date, spend_search AS ad_search, spend_social AS ad_social, spend_display AS ad_display, spend_email AS ad_email FROM numbered WHERE rn = 1
      UNION ALL SELECT n.rn, n.date, n.spend_search + 0.65::DOUBLE * ad.ad_search, n.spend_social + 0.55::DOUBLE * ad.ad_social,
      n.spend_display + 0.45::DOUBLE * ad.ad_display, n.spend_email + 0.30::DOUBLE * ad.ad_email FROM ad JOIN numbered n ON n.rn = ad.rn + 1""",
}
ADS = [f"ad_{c}" for c in mix.CHANNELS]


def _recursive(body, **extra):
    return with_ctes(["mix"], body, **_AD_CTES, **extra).replace("WITH ", "WITH RECURSIVE ", 1)


@_register("mix3_adstock", _recursive("SELECT CAST(date AS VARCHAR) AS date, " + ", ".join(f"round({c}, 3) AS {c}" for c in ADS) + " FROM ad"))
def _(spark, d):
    return _shown(mix.prepare(fx.mix_daily(spark, d)), ADS)


@_register(
    "mix4_chronological_split",
    with_ctes(["mix"], "SELECT CAST(date AS VARCHAR) AS date, row_number() OVER (ORDER BY date) <= floor(0.8::DOUBLE * (SELECT count(*) FROM mix)) AS is_train FROM mix"),
)
def _(spark, d):
    split = mix.chronological_split(fx.mix_daily(spark, d))
    return split.select(F.col("date").cast("string").alias("date"), "is_train")


@_register("mix5_regression")
def _(spark, d):
    coefficients, quality = mix.fit_regression(mix.prepare(fx.mix_daily(spark, d)))
    long_quality = quality.select(F.expr("stack(2, 'r2', r2, 'mae', mae) as (feature, coefficient)"))
    return coefficients.unionByName(long_quality)


_CONTRIB = " UNION ALL ".join(
    f"SELECT '{c}' AS channel, sum({COEFFICIENTS[f'ad_{c}']}::DOUBLE * ad_{c}) AS k, (SELECT sum(spend_{c}) FROM mix) AS s FROM ad" for c in mix.CHANNELS
)
_ROI = {"parts": _CONTRIB, "roi": "SELECT channel, k, s, CASE WHEN s > 0 THEN k / s END AS r FROM parts"}


def _contribution(spark, d):
    return mix.channel_contribution(mix.prepare(fx.mix_daily(spark, d)), COEFFICIENTS)


@_register(
    "mix6_channel_contribution",
    _recursive("SELECT channel, round(k, 2) AS estimated_contribution, round(s, 2) AS total_spend, round(r, 6) AS estimated_roi FROM roi", **_ROI),
)
def _(spark, d):
    return _contribution(spark, d).withColumns(
        {"estimated_contribution": F.round("estimated_contribution", 2), "total_spend": F.round("total_spend", 2), "estimated_roi": F.round("estimated_roi", 6)}
    )


@_register("mix7_roi_ranking", _recursive("SELECT channel, round(r, 6) AS estimated_roi, dense_rank() OVER (ORDER BY r DESC) AS rank FROM roi", **_ROI))
def _(spark, d):
    return rounded(mix.roi_ranking(_contribution(spark, d)), "estimated_roi")


UPLIFTS = {"search": 1.1, "email": 0.8}
_ALLOC = dict(
    _ROI,
    eff="SELECT *, CASE channel WHEN 'search' THEN 1.1::DOUBLE WHEN 'email' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS u FROM roi",
    score="SELECT *, r * u AS e, greatest(r * u, 0) AS ps FROM eff",
    alloc="""SELECT *, 0.05::DOUBLE * s + greatest(0.9::DOUBLE * (SELECT sum(s) FROM score) - 0.05::DOUBLE * (SELECT sum(s) FROM score), 0)
      * ps / (SELECT sum(ps) FROM score) AS rec FROM score""",
)


@_register(
    "mix8_budget_allocation",
    _recursive(
        """SELECT channel, round(s, 2) AS total_spend, round(rec, 2) AS recommended_spend, round(rec - s, 2) AS budget_shift, round(r, 6) AS estimated_roi,
        u AS uplift_multiplier, round(e, 6) AS effective_roi, round(rec * e, 2) AS expected_incremental_return FROM alloc""",
        **_ALLOC,
    ),
)
def _(spark, d):
    table = mix.allocate_budget(_contribution(spark, d), UPLIFTS)
    two = {c: F.round(c, 2) for c in ("total_spend", "recommended_spend", "budget_shift", "expected_incremental_return")}
    return rounded(table.withColumns(two), "estimated_roi", "effective_roi")


@_register(
    "mix9_kpi_table",
    _recursive(
        """SELECT channel, round(k, 2) AS attributed_revenue_proxy, round(s, 2) AS total_spend, round(r, 6) AS estimated_roi, round(k / s, 6) AS roas, round((k - s) / s, 6) AS roi,
        round(k / 120, 4) AS estimated_conversions_proxy, round(s / nullif(k / 120, 0), 6) AS cpa_proxy, round(rec, 2) AS recommended_spend,
        round(rec - s, 2) AS budget_shift, round(rec * e, 2) AS expected_incremental_return FROM alloc""",
        **_ALLOC,
    ),
)
def _(spark, d):
    contribution = _contribution(spark, d)
    table = mix.kpi_table(contribution, mix.allocate_budget(contribution, UPLIFTS))
    two = {c: F.round(c, 2) for c in ("attributed_revenue_proxy", "total_spend", "recommended_spend", "budget_shift", "expected_incremental_return")}
    table = table.withColumns(two).withColumn("estimated_conversions_proxy", F.round("estimated_conversions_proxy", 4))
    return rounded(table, "estimated_roi", "roas", "roi", "cpa_proxy")


@_register("mix10_seasonal_forecast")
def _(spark, d):
    return mix.seasonal_forecast(mix.prepare(fx.mix_daily(spark, d)))[1]


@_register("mix11_date_summary", with_ctes(["mix"], "SELECT count(*) AS rows, CAST(min(date) AS VARCHAR) AS date_min, CAST(max(date) AS VARCHAR) AS date_max FROM mix"))
def _(spark, d):
    return mix.date_summary(fx.mix_daily(spark, d))


@_register(
    "prj11_calendar_features",
    with_ctes(["mix"], "SELECT CAST(date AS VARCHAR) AS date, CAST(row_number() OVER (ORDER BY date) - 1 AS INT) AS day_idx, CAST(isodow(date) - 1 AS INT) AS dow FROM mix"),
)
def _(spark, d):
    return mix.calendar_features(fx.mix_daily(spark, d)).select(F.col("date").cast("string").alias("date"), "day_idx", "dow")


_DAYS = "SELECT CAST(date AS VARCHAR) AS date, round(revenue, 3) AS revenue, round(coalesce(spend, 0), 3) AS spend FROM revenue LEFT JOIN spend USING (date)"


@_register(
    "jn5_spend_with_revenue",
    """WITH revenue AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS revenue FROM orders GROUP BY 1),
      spend AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS spend FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1) """ + _DAYS,
)
def _(spark, d):
    orders = fx.table(spark, d, "orders").withColumn("date", F.to_date("o_orderdate"))
    revenue = orders.groupBy("date").agg(F.sum("o_totalprice").alias("revenue"))
    spend = orders.where("o_orderpriority = '2-HIGH'").groupBy("date").agg(F.sum("o_totalprice").alias("spend"))
    joined = joins.attach_labels(revenue, spend, "date")
    return _shown(joined.withColumn("spend", F.coalesce("spend", F.lit(0.0))), ["revenue", "spend"])


@_register(
    "jn6_lookup_default",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 2.5::DOUBLE WHEN '2-HIGH' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS factor FROM orders""",
)
def _(spark, d):
    return fx.table(spark, d, "orders").select("o_orderkey", fn.lookup("o_orderpriority", {"1-URGENT": 2.5, "2-HIGH": 1.5}, 1.0).alias("factor"))


@_register(
    "jn7_attach_recommendation",
    _recursive("SELECT channel, round(s, 2) AS total_spend, round(rec, 2) AS recommended_spend FROM alloc", **_ALLOC),
)
def _(spark, d):
    contribution = _contribution(spark, d)
    joined = joins.attach_labels(contribution, mix.allocate_budget(contribution, UPLIFTS).select("channel", "recommended_spend"), "channel")
    return joined.select("channel", F.round("total_spend", 2).alias("total_spend"), F.round("recommended_spend", 2).alias("recommended_spend"))


# ---- features and splits -----------------------------------------------------------------------

NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "balance"]
CATEGORICAL = ["Contract", "segment"]


@_register(
    "prj10_churn_features",
    with_ctes(
        ["churn"],
        """SELECT "customerID", round(ln(1 + tenure::DOUBLE), 6) AS tenure_log1p, round("MonthlyCharges" * "MonthlyCharges", 0) AS monthlycharges_sq,
        round(tenure * "MonthlyCharges", 3) AS tenure_x_monthlycharges, round("TotalCharges" / CASE WHEN tenure = 0 THEN 1 ELSE tenure END, 6) AS avg_charge_per_tenure FROM churn""",
    ),
)
def _(spark, d):
    return fea.churn_features(fx.churn(spark, d)).select(
        "customerID", F.round("tenure_log1p", 6).alias("tenure_log1p"), F.round("monthlycharges_sq", 0).alias("monthlycharges_sq"),
        F.round("tenure_x_monthlycharges", 3).alias("tenure_x_monthlycharges"), F.round("avg_charge_per_tenure", 6).alias("avg_charge_per_tenure"),
    )


_STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", any_value(m) AS median, avg(coalesce("{c}", m)::DOUBLE) AS mean, stddev_pop(coalesce("{c}", m)::DOUBLE) AS deviation
    FROM churn, (SELECT quantile_cont("{c}"::DOUBLE, 0.5) AS m FROM churn)""" for c in NUMERIC
)


@_register("fea1_numeric_statistics", with_ctes(["churn"], f'SELECT "column", round(median, 4) AS median, round(mean, 4) AS mean, round(deviation, 4) AS deviation FROM ({_STATS})'))
def _(spark, d):
    stats = fea.fit_numeric(fx.churn(spark, d), NUMERIC)
    return stats.select("column", *[F.round(c, 4).alias(c) for c in ("median", "mean", "deviation")])


@_register(
    "fea1_standardised",
    with_ctes(["churn"], 'SELECT "customerID", ' + ", ".join(f"""round((coalesce("{c}"::DOUBLE, s_{c}.median) - s_{c}.mean) / s_{c}.deviation, 6) AS "{c}" """ for c in NUMERIC)
      + " FROM churn" + "".join(f""" JOIN stats s_{c} ON s_{c}."column" = '{c}'""" for c in NUMERIC), stats=_STATS),
)
def _(spark, d):
    table = fx.churn(spark, d)
    return rounded(fea.apply_numeric(table, fea.fit_numeric(table, NUMERIC)), *NUMERIC).select("customerID", *NUMERIC)


_VALUES = " UNION ALL ".join(f"""SELECT '{c}' AS "column", "{c}" AS value, count(*) AS n FROM churn WHERE "{c}" IS NOT NULL GROUP BY 2""" for c in CATEGORICAL)


@_register(
    "fea2_category_vocabulary",
    with_ctes(["churn"], f"""SELECT "column", string_agg(value, '|' ORDER BY value) AS categories, arg_min(value, (-n, value)) AS most_frequent FROM ({_VALUES}) GROUP BY 1"""),
)
def _(spark, d):
    return fea.fit_categories(fx.churn(spark, d), CATEGORICAL).withColumn("categories", F.array_join("categories", "|"))


# The category levels of the given tables, first level dropped.
_PRIORITY = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummy_sql(fill: str) -> str:
    cells = ", ".join(f"""CASE WHEN coalesce("Contract", {fill}) = '{p}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Contract_{p}" """ for p in _PRIORITY)
    return f'SELECT "customerID", {cells} FROM churn'


@_register(
    "fea2_one_hot",
    with_ctes(["churn"], _dummy_sql("""(SELECT "Contract" FROM churn WHERE "Contract" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""")),
)
def _(spark, d):
    table = fx.churn(spark, d)
    encoded, names = fea.apply_categories(table, fea.fit_categories(table, ["Contract"]))
    return encoded.select("customerID", *names)


@_register("fea3_dummies", with_ctes(["churn"], _dummy_sql("NULL")))
def _(spark, d):
    table = fx.churn(spark, d)
    train = table.where(~models.holdout_flag("customerID", 0.2))
    encoded, names = fea.apply_categories(table, fea.fit_categories(train, ["Contract"]), impute=False)
    return encoded.select("customerID", *names)


@_register(
    "fea4_column_kinds",
    with_ctes(["churn"], " UNION ALL ".join(f"""SELECT '{c}' AS "column", '{k}' AS kind, count("{c}") AS present FROM churn""" for k, cs in (("numeric", NUMERIC), ("categorical", CATEGORICAL)) for c in cs)),
)
def _(spark, d):
    numeric, categorical = fea.column_kinds(fx.churn(spark, d), ["customerID", "Churn"])
    counts = fx.churn(spark, d).agg(*[F.count(c).alias(c) for c in numeric + categorical])
    pairs = ", ".join(f"'{c}', '{'numeric' if c in numeric else 'categorical'}', `{c}`" for c in counts.columns)
    return counts.select(F.expr(f"stack({len(counts.columns)}, {pairs}) as (column, kind, present)"))


_HASH = "((key % 2147483648) * {m}) % 4294967296"


@_register(
    "smp1_stratified_holdout",
    with_ctes(["scored"], f"SELECT key, model, {_HASH.format(m=models.MULTIPLIERS['holdout'])} < {int(0.2 * models.HASH_SPACE)} AS is_test FROM scored"),
)
def _(spark, d):
    return models.stratified_holdout(fx.scored(spark, d), "key", "label", 0.20).select("key", "model", "is_test")


@_register(
    "smp2_calibration_split",
    with_ctes(
        ["scored"],
        f"""SELECT key, CASE WHEN {_HASH.format(m=models.MULTIPLIERS['holdout'])} < {int(0.2 * models.HASH_SPACE)} THEN 'test'
        WHEN {_HASH.format(m=models.MULTIPLIERS['calibration'])} < {int(0.25 * models.HASH_SPACE)} THEN 'calibration' ELSE 'train' END AS part FROM scored WHERE model = 'a'""",
    ),
)
def _(spark, d):
    rows = fx.scored(spark, d).where("model = 'a'")
    part = F.when(models.holdout_flag("key", 0.2), "test").when(models.holdout_flag("key", 0.25, "calibration"), "calibration").otherwise("train")
    return rows.select("key", part.alias("part"))


@_register("mdl5_class_weight", with_ctes(["uplift"], "SELECT key, outcome, round(CASE WHEN outcome = 1 THEN (SELECT count(*) FILTER (outcome = 0) / count(*) FILTER (outcome = 1)::DOUBLE FROM uplift) ELSE 1 END, 6) AS weight FROM uplift"))
def _(spark, d):
    table = fx.uplift(spark, d)
    ratio = models.class_weight(table, "outcome")
    return table.select("key", "outcome", F.round(F.when(F.col("outcome") == 1, F.lit(ratio)).otherwise(1.0), 6).alias("weight"))


# ---- data quality ------------------------------------------------------------------------------

_LOG = "SELECT event_id AS key, ts, value AS churn_probability FROM events"


@_register(
    "dq1_split_log",
    f"WITH log AS ({_LOG}) SELECT key, CASE WHEN row_number() OVER (ORDER BY ts, key) <= (SELECT count(*) // 2 FROM log) THEN 'reference' ELSE 'current' END AS part FROM log",
)
def _(spark, d):
    log = fx.table(spark, d, "events").select(F.col("event_id").alias("key"), F.col("ts").alias("timestamp_utc"), F.col("value").alias("churn_probability"))
    return dq.split_log(log).select("key", "part")


def _halves(spark, d):
    cut = F.lit("1998-04-15").cast("timestamp_ntz")
    return fx.table(spark, d, "orders").withColumn("part", F.when(F.col("o_orderdate") < cut, "reference").otherwise("current")).withColumn(
        "size_class", F.floor(F.col("o_totalprice") / 1000).cast("long")
    )


_HALVES = "SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1998-04-15' THEN 'reference' ELSE 'current' END AS part, CAST(floor(o_totalprice / 1000) AS BIGINT) AS size_class FROM orders"
_DIV = """SELECT "column", sum((pf - qf) * ln(pf / qf)) AS psi, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) AS js FROM (SELECT *, greatest(p, 1e-6::DOUBLE) AS pf, greatest(q, 1e-6::DOUBLE) AS qf FROM
  (SELECT "column", r / sum(r) OVER (PARTITION BY "column")::DOUBLE AS p, c / sum(c) OVER (PARTITION BY "column")::DOUBLE AS q FROM {cells})) GROUP BY 1"""
_NUM = ["o_totalprice", "size_class"]
_CDF = """SELECT "column", value, sum(r) OVER w / sum(r) OVER (PARTITION BY "column")::DOUBLE AS fr, sum(c) OVER w / sum(c) OVER (PARTITION BY "column")::DOUBLE AS fc,
  lead(value) OVER w AS nxt FROM vals WINDOW w AS (PARTITION BY "column" ORDER BY value)"""
_NUM_CTES = {
    "halves": _HALVES,
    "vals": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c}::DOUBLE AS value, count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c FROM halves GROUP BY 2""" for c in _NUM
    ),
    "cdf": _CDF,
    "edges": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", quantile_cont({c}::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e, stddev_pop({c}::DOUBLE) AS sd FROM halves WHERE part = 'reference'""" for c in _NUM
    ),
    "bins": """SELECT "column", b, sum(r) AS r, sum(c) AS c FROM (SELECT v."column", r, c, len(list_filter(e, lambda x: x < v.value)) AS b FROM vals v JOIN edges USING ("column")) GROUP BY 1, 2""",
    "divs": _DIV.format(cells="bins"),
    "dist": """SELECT "column", max(abs(fr - fc)) AS ks, sum(abs(fr - fc) * (coalesce(nxt, value) - value)) AS w1 FROM cdf GROUP BY 1""",
}


@_register(
    "dq2_numeric_drift",
    with_ctes([], """SELECT d."column", round(ks, 6) AS ks, round(w1 / sd, 6) AS wasserstein_norm, round(psi, 6) AS psi, round(js, 6) AS js_distance FROM dist d
      JOIN edges USING ("column") JOIN divs USING ("column")""", **_NUM_CTES),
)
def _(spark, d):
    table = dq.numeric_drift(_halves(spark, d), _NUM)
    return rounded(table, "ks", "wasserstein_norm", "psi", "js_distance")


_CAT = ["o_orderpriority", "o_orderstatus"]
_CAT_CTES = {
    "halves": _HALVES,
    "cells": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c FROM halves GROUP BY 2""" for c in _CAT
    ),
    "tot": """SELECT *, sum(r) OVER (PARTITION BY "column")::DOUBLE AS nr, sum(c) OVER (PARTITION BY "column")::DOUBLE AS nc FROM cells""",
    "exp": "SELECT *, (r + c) * nr / (nr + nc) AS er, (r + c) * nc / (nr + nc) AS ec FROM tot",
    "chi": """SELECT "column", sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec) AS x, count(*) - 1 AS k FROM exp GROUP BY 1""",
    "divs": _DIV.format(cells="cells"),
}


@_register(
    "dq2_categorical_drift",
    with_ctes([], """SELECT "column", round(x, 6) AS chi_square, k AS degrees, round(psi, 6) AS psi, round(js, 6) AS js_distance FROM chi JOIN divs USING ("column")""", **_CAT_CTES),
)
def _(spark, d):
    return rounded(dq.categorical_drift(_halves(spark, d), _CAT), "chi_square", "psi", "js_distance")


_SCORES = f"""SELECT "column", 'numeric' AS kind, wasserstein_norm AS score FROM ({ORACLE['dq2_numeric_drift']})
  UNION ALL SELECT "column", 'categorical', js_distance FROM ({ORACLE['dq2_categorical_drift']})"""


@_register(
    "dq2_drift_report",
    f"""SELECT *, score >= {dq.DRIFT_LIMIT} AS drifted, round(avg(CAST(score >= {dq.DRIFT_LIMIT} AS DOUBLE)) OVER (), 6) AS drifted_share FROM ({_SCORES})""",
)
def _(spark, d):
    return rounded(dq.drift_report(_halves(spark, d), _NUM, _CAT), "score", "drifted_share")


_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@_register(
    "dq3_profile_exact",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS count, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS nulls, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem""" for c in _PROFILED
    ),
)
def _(spark, d):
    table = dq.profile_exact(fx.table(spark, d, "lineitem"), _PROFILED)
    return rounded(table, "min", "max", "q25", "q50", "q75").withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@_register("dq3_profile_sketch")
def _(spark, d):
    return dq.profile_sketch(fx.table(spark, d, "lineitem"))


