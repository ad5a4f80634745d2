"""Registered queries: ordered primitives, metrics, decisions, uplift evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from adweave.operators import metrics as met
from adweave.operators import ordered, uplift
from adweave.plans import fixtures as fx
from adweave.plans.fixtures import with_ctes

QUERIES, ORACLE = {}, {}


def _register(name, sql=None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_RANKED = "SELECT *, row_number() OVER (PARTITION BY model ORDER BY p DESC, key) AS rank FROM scored"


@_register("rnk1_global_rank", with_ctes(["scored"], f"SELECT model, key, rank FROM ({_RANKED})"))
def _(spark, d):
    # a low single-range limit runs the range-split path at every scale
    return ordered.positional_rank(fx.scored(spark, d), "p", "key", ["model"]).select("model", "key", "rank")


@_register(
    "rnk2_global_running_totals",
    with_ctes(["scored"], """SELECT model, key, CAST(sum(label) OVER w AS BIGINT) AS positives, CAST(sum(1 - label) OVER w AS BIGINT) AS negatives
      FROM scored WINDOW w AS (PARTITION BY model ORDER BY p DESC, key ROWS UNBOUNDED PRECEDING)"""),
)
def _(spark, d):
    label = F.col("label").cast("long")
    sums = {"positives": label, "negatives": 1 - label}
    return ordered.running_totals(fx.scored(spark, d), "p", "key", sums, ["model"]).select("model", "key", *sums)


@_register(
    "agg3_exact_quantiles",
    """SELECT l_returnflag, p AS prob, round(quantile, 6) AS quantile FROM (SELECT l_returnflag,
      unnest([0.025::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.975::DOUBLE]) AS p,
      unnest(quantile_cont(l_extendedprice, [0.025, 0.25, 0.5, 0.75, 0.975])) AS quantile FROM lineitem GROUP BY 1)""",
)
def _(spark, d):
    rows = ordered.exact_quantiles(fx.table(spark, d, "lineitem"), "l_extendedprice", [0.025, 0.25, 0.5, 0.75, 0.975], ["l_returnflag"])
    return rounded(rows, "quantile")


_AUC = """SELECT model, sum(pos * (f - fp + neg / 2.0::DOUBLE)) / (any_value(t)::DOUBLE * any_value(f)) AS roc_auc,
  sum(pos / t::DOUBLE * (tp / (tp + fp)::DOUBLE)) AS pr_auc FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER (PARTITION BY model) AS t, sum(neg) OVER (PARTITION BY model) AS f FROM
  (SELECT model, p, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2) WINDOW w AS (PARTITION BY model ORDER BY p DESC)) GROUP BY model"""
_PAIRWISE = """SELECT model, round(sum(pos * (less + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc FROM (SELECT *,
  coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS less FROM
  (SELECT model, p, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2)) GROUP BY model"""


@_register("met1_roc_auc", with_ctes(["scored"], _PAIRWISE))
def _(spark, d):
    return rounded(met.ranking_metrics(fx.scored(spark, d)), "roc_auc").select("model", "roc_auc")


@_register("met2_average_precision", with_ctes(["scored"], f"SELECT model, round(pr_auc, 6) AS pr_auc FROM ({_AUC})"))
def _(spark, d):
    return rounded(met.ranking_metrics(fx.scored(spark, d)), "pr_auc").select("model", "pr_auc")


_EPS = "2.220446049250313e-16::DOUBLE"
_LOSS = f"""SELECT model, avg(-(label * ln(q) + (1 - label) * ln(1 - q))) AS log_loss, avg((p - label) * (p - label)) AS brier FROM
  (SELECT *, least(greatest(p, {_EPS}), 1 - {_EPS}) AS q FROM scored) GROUP BY model"""


@_register("met3_log_loss", with_ctes(["scored"], f"SELECT model, round(log_loss, 6) AS log_loss FROM ({_LOSS})"))
def _(spark, d):
    return rounded(met.loss_metrics(fx.scored(spark, d)), "log_loss").select("model", "log_loss")


@_register("met4_brier", with_ctes(["scored"], f"SELECT model, round(brier, 6) AS brier FROM ({_LOSS})"))
def _(spark, d):
    return rounded(met.loss_metrics(fx.scored(spark, d)), "brier").select("model", "brier")


_EDGE = [i * (1 / 15) for i in range(16)]
_ECE = """SELECT model, sum(n * gap) / any_value(total) AS ece FROM (SELECT model, count(*) AS n, abs(avg(label) - avg(p)) AS gap,
  any_value(total) AS total, b FROM (SELECT *, count(*) OVER (PARTITION BY model) AS total,
  CASE WHEN p < 1 THEN CAST(floor(p * 15 + 1e-12) AS INT) END AS b FROM scored) GROUP BY model, b) WHERE b IS NOT NULL GROUP BY model"""


@_register("met5_expected_calibration_error", with_ctes(["scored"], f"SELECT model, round(ece, 6) AS ece FROM ({_ECE})"))
def _(spark, d):
    return rounded(met.expected_calibration_error(fx.scored(spark, d)), "ece")


@_register(
    "met6_comparison_table",
    with_ctes(
        ["scored"],
        f"""SELECT l.model, round(log_loss, 6) AS log_loss, round(brier, 6) AS brier, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
        round(ece, 6) AS ece, row_number() OVER (ORDER BY log_loss, l.model) = 1 AS selected
        FROM ({_LOSS}) l JOIN ({_AUC}) a USING (model) JOIN ({_ECE}) e USING (model)""",
    ),
)
def _(spark, d):
    return rounded(met.comparison_table(fx.scored(spark, d)), "log_loss", "brier", "roc_auc", "pr_auc", "ece")


_QS = "[" + ", ".join(f"{i}/12.0::DOUBLE" for i in range(1, 12)) + "]"


@_register(
    "met7_reliability_curve",
    with_ctes(
        ["scored"],
        """SELECT model, CAST(bin AS INT) AS bin, round(avg(p), 6) AS mean_predicted, round(avg(label), 6) AS fraction_positive, count(*) AS n FROM
        (SELECT s.*, len(list_filter(e.q, lambda x: x < s.p)) AS bin FROM scored s JOIN edges e USING (model)) GROUP BY 1, 2""",
        edges=f"SELECT model, quantile_cont(p, {_QS}) AS q FROM scored GROUP BY model",
    ),
)
def _(spark, d):
    return rounded(met.reliability_curve(fx.scored(spark, d)), "mean_predicted", "fraction_positive")


_CONF = """SELECT model, count(*) FILTER (p {op} {t} AND label = 1) AS tp, count(*) FILTER (p {op} {t} AND label = 0) AS fp,
  count(*) FILTER (NOT p {op} {t} AND label = 1) AS fn, count(*) FILTER (NOT p {op} {t} AND label = 0) AS tn FROM scored GROUP BY model"""


@_register("met8_confusion", with_ctes(["scored"], _CONF.format(op=">", t="0.3::DOUBLE")))
def _(spark, d):
    return met.confusion(fx.scored(spark, d), 0.3)


_CLASSES = """SELECT model, '1' AS class, tp AS hit, fp AS wrong, fn AS missed FROM conf UNION ALL SELECT model, '0', tn, fn, fp FROM conf"""
_PRF = """SELECT model, class, coalesce(hit / nullif(hit + wrong, 0), 0)::DOUBLE AS precision, coalesce(hit / nullif(hit + missed, 0), 0)::DOUBLE AS recall,
  coalesce(2.0::DOUBLE * hit / nullif(2 * hit + wrong + missed, 0), 0) AS f1, hit + missed AS support, hit FROM classes"""


@_register(
    "met9_classification_report",
    with_ctes(
        ["scored"],
        """SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
        SELECT model, class, precision, recall, f1, support FROM prf
        UNION ALL SELECT model, 'accuracy', sum(hit)::DOUBLE / sum(support), sum(hit)::DOUBLE / sum(support), sum(hit)::DOUBLE / sum(support), sum(support) FROM prf GROUP BY model
        UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM prf GROUP BY model
        UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support) FROM prf GROUP BY model)""",
        conf=_CONF.format(op=">=", t="0.5::DOUBLE"),
        classes=_CLASSES,
        prf=_PRF,
    ),
)
def _(spark, d):
    report = met.classification_report(met.confusion(fx.scored(spark, d), 0.5, strict=False))
    return rounded(report, "precision", "recall", "f1")


@_register(
    "met10_profit",
    with_ctes(["scored"], f"SELECT model, CAST(100 * tp - 10 * fp - 100 * fn AS BIGINT) AS profit FROM ({_CONF.format(op='>', t='0.3::DOUBLE')})"),
)
def _(spark, d):
    counts = met.confusion(fx.scored(spark, d), 0.3)
    return counts.select("model", met.profit_expr().cast("long").alias("profit"))


_GRID = ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(met.SCAN))


@_register(
    "met11_threshold_scan",
    with_ctes(
        ["scored"],
        f"""SELECT *, row_number() OVER (PARTITION BY model ORDER BY profit DESC, threshold) = 1 AS best FROM (
        SELECT model, threshold, tp, fp, fn, tn, CAST(100 * tp - 10 * fp - 100 * fn AS BIGINT) AS profit FROM (
        SELECT model, round(t, 2) AS threshold, count(*) FILTER (p > t AND label = 1) AS tp, count(*) FILTER (p > t AND label = 0) AS fp,
        count(*) FILTER (p <= t AND label = 1) AS fn, count(*) FILTER (p <= t AND label = 0) AS tn
        FROM scored, (VALUES {_GRID}) g(i, t) GROUP BY model, t))""",
    ),
)
def _(spark, d):
    return met.threshold_scan(fx.scored(spark, d)).withColumn("profit", F.col("profit").cast("long"))


_TOP = "greatest(1, CAST(floor(0.2::DOUBLE * count(*)) AS BIGINT))"


@_register(
    "met12_top_fraction_capture",
    with_ctes(
        ["scored"],
        f"""SELECT model, {_TOP} AS top_segment_size, CAST(sum(label) AS BIGINT) AS total_positives,
        CAST(sum(label) FILTER (rank <= k) AS BIGINT) AS captured_positives, round(sum(label) FILTER (rank <= k) / sum(label)::DOUBLE, 6) AS capture_rate
        FROM (SELECT *, greatest(1, floor(0.2::DOUBLE * count(*) OVER (PARTITION BY model))) AS k FROM ({_RANKED})) GROUP BY model""",
    ),
)
def _(spark, d):
    return rounded(met.top_fraction_capture(fx.scored(spark, d), "key"), "capture_rate")


@_register(
    "met13_bidding_report",
    with_ctes(
        ["scored"],
        """SELECT model, n AS impressions_bought, round(n / total::DOUBLE, 6) AS buy_rate, round(coalesce(clicks / nullif(n, 0)::DOUBLE, 0), 6) AS realized_ctr,
        round(clicks * 2.0::DOUBLE, 6) AS revenue, round(n * 0.01::DOUBLE, 6) AS cost, round(clicks * 2.0::DOUBLE - n * 0.01::DOUBLE, 6) AS profit FROM (
        SELECT model, count(*) AS total, count(*) FILTER (p * 2 > 0.01::DOUBLE) AS n, coalesce(sum(label) FILTER (p * 2 > 0.01::DOUBLE), 0)::BIGINT AS clicks FROM scored GROUP BY model)""",
    ),
)
def _(spark, d):
    return rounded(met.bidding_report(fx.scored(spark, d)), "buy_rate", "realized_ctr", "revenue", "cost", "profit")


def _steps_sql(x: str) -> str:
    return " + ".join(f"CAST({x} >= {t} AS INT)" for t in met.POISSON_STEPS)


def _bootstrap_ctes(pairs: int = 1000, seed: int = 42) -> dict[str, str]:
    """2 * ``pairs`` replicates; every step of the finaliser is a column of its own."""
    mix = lambda src, x, keep: (
        f"SELECT {keep}, xor(c, c >> 16) AS m FROM (SELECT {keep}, xor(b, b >> 13) * {met.MIX[1]}::UBIGINT & 4294967295::UBIGINT AS c FROM "
        f"(SELECT {keep}, xor(a, a >> 16) * {met.MIX[0]}::UBIGINT & 4294967295::UBIGINT AS b FROM (SELECT {keep}, {x} AS a FROM {src})))"
    )
    q = lambda x: f"least(greatest({x}, {met.EPS_DOUBLE!r}::DOUBLE), 1 - {met.EPS_DOUBLE!r}::DOUBLE)"
    loss = lambda x: f"-(label * ln({q(x)}) + (1 - label) * ln(1 - {q(x)}))"
    return {
        "wide": "SELECT key, max(label)::DOUBLE AS label, max(p) FILTER (model = 'a') AS pa, max(p) FILTER (model = 'b') AS pb FROM scored GROUP BY key",
        "delta": f"SELECT key::UBIGINT AS key, {loss('pa')} - ({loss('pb')}) AS ll, (pa - label) * (pa - label) - (pb - label) * (pb - label) AS br FROM wide",
        "salts": mix(f"range(0, {pairs}) t(r)", f"(r + {seed})::UBIGINT", "r"),
        "first": mix("(SELECT r, s.m AS s, key, ll, br FROM salts s, delta)", "xor(key & 4294967295::UBIGINT, s)", "r, key, ll, br"),
        "bits": mix("(SELECT r, key, ll, br, m AS f FROM first)", "xor(f, key >> 32)", "r, ll, br"),
        "weights": f"SELECT r, {_steps_sql('(m & 65535::UBIGINT)')} AS w, ll, br FROM bits UNION ALL SELECT r + {pairs}, {_steps_sql('(m >> 16)')}, ll, br FROM bits",
        "reps": "SELECT r, sum(w * ll) / sum(w) AS ll, sum(w * br) / sum(w) AS br FROM weights GROUP BY r",
        "tall": "SELECT 'log_loss' AS metric, ll AS v FROM reps UNION ALL SELECT 'brier', br FROM reps",
    }


_BOOTSTRAP = """SELECT metric, round(quantile_cont(v, 0.5), 9) AS median_delta, round(quantile_cont(v, 0.025), 9) AS ci95_low, round(quantile_cont(v, 0.975), 9) AS ci95_high,
  quantile_cont(v, 0.025) > 0 AS significant_improvement FROM tall GROUP BY metric"""


@_register("met14_paired_bootstrap", with_ctes(["scored"], _BOOTSTRAP, **_bootstrap_ctes()))
def _(spark, d):
    wide = fx.scored(spark, d).groupBy("key").agg(
        F.max("label").alias("label"),
        F.max(F.when(F.col("model") == "a", F.col("p"))).alias("p_base"),
        F.max(F.when(F.col("model") == "b", F.col("p"))).alias("p_new"),
    )
    return rounded(met.paired_bootstrap(wide, replicates=2000), "median_delta", "ci95_low", "ci95_high", digits=9)


@_register(
    "met15_scoring_checks",
    with_ctes(
        ["scored"],
        """SELECT unnest(['probability_out_of_range','label_not_binary','unknown_model']) AS check, unnest([a, b, c]) AS violations FROM (
        SELECT count(*) FILTER (p IS NULL OR p < 0 OR p > 1) AS a, count(*) FILTER (label IS NULL OR label NOT IN (0, 1)) AS b,
        count(*) FILTER (model NOT IN ('a')) AS c FROM scored)""",
    ),
)
def _(spark, d):
    return met.scoring_checks(fx.scored(spark, d), labels=["a"])


@_register(
    "mdl8_auc_gap",
    with_ctes(
        ["scored"],
        f"""SELECT m.base AS model, round(max(roc_auc) FILTER (part = 'train'), 6) AS train_auc, round(max(roc_auc) FILTER (part = 'test'), 6) AS test_auc,
        round(max(roc_auc) FILTER (part = 'train') - max(roc_auc) FILTER (part = 'test'), 6) AS gap FROM (
        SELECT split_part(model, '/', 1) AS base, split_part(model, '/', 2) AS part, roc_auc FROM ({_AUC.replace('FROM scored', 'FROM parts')})) m GROUP BY 1""",
        parts="SELECT key, label, p, model || '/' || CASE WHEN (key * 2654435761) % 4294967296 < 858993459 THEN 'test' ELSE 'train' END AS model FROM scored",
    ),
)
def _(spark, d):
    from adweave.operators.models import auc_gap, holdout_flag

    rows = fx.scored(spark, d).withColumn("split", F.when(holdout_flag("key", 0.2), "test").otherwise("train"))
    return rounded(auc_gap(rows), "train_auc", "test_auc", "gap")


@_register("eda1_value_share", "SELECT o_orderpriority, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS share FROM orders GROUP BY 1")
def _(spark, d):
    return rounded(met.value_share(fx.table(spark, d, "orders"), "o_orderpriority"), "share")


@_register("eda1_group_mean", "SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1")
def _(spark, d):
    return fx.table(spark, d, "orders").groupBy("o_orderstatus").agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@_register(
    "eda1_row_crosstab",
    """SELECT o_orderpriority, """
    + ", ".join(f"""round(count(*) FILTER (o_orderstatus = '{s}') / count(*)::DOUBLE, 6) AS "{s}" """ for s in "FOP")
    + " FROM orders GROUP BY 1",
)
def _(spark, d):
    return rounded(met.row_crosstab(fx.table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"]), "F", "O", "P")


@_register(
    "eda1_box_quartiles",
    """SELECT o_orderstatus, round(min(o_totalprice), 6) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS q1, round(quantile_cont(o_totalprice, 0.5), 6) AS median,
      round(quantile_cont(o_totalprice, 0.75), 6) AS q3, round(max(o_totalprice), 6) AS max FROM orders GROUP BY 1""",
)
def _(spark, d):
    return rounded(met.box_quartiles(fx.table(spark, d, "orders"), "o_orderstatus", "o_totalprice"), "min", "q1", "median", "q3", "max")


# ---- uplift evaluation -------------------------------------------------------------------------


@_register(
    "upl1_treatment_audit",
    with_ctes(
        ["uplift"],
        """SELECT CASE WHEN treatment = 1 THEN 'treated' ELSE 'control' END AS group_label, treatment, count(*) AS group_size,
        round(avg(outcome), 6) AS outcome_rate, round(count(*) / (SELECT count(*) FROM uplift)::DOUBLE, 6) AS share FROM uplift GROUP BY treatment""",
    ),
)
def _(spark, d):
    return rounded(uplift.treatment_audit(fx.uplift(spark, d)), "outcome_rate", "share")


_ULIFT = ", ".join(f"({i + 1}, {f!r}::DOUBLE)" for i, f in enumerate(uplift.FRACTIONS))
_LIFT_CTES = {
    "ranked": "SELECT *, row_number() OVER (ORDER BY score DESC, key) AS rank, count(*) OVER () AS n FROM uplift",
    "cuts": f"""SELECT i AS decile, round(f, 2) AS top_fraction, any_value(greatest(1, CAST(floor(n * f) AS BIGINT))) AS segment_size,
      avg(outcome) FILTER (treatment = 1 AND rank <= greatest(1, floor(n * f))) AS treated_rate,
      avg(outcome) FILTER (treatment = 0 AND rank <= greatest(1, floor(n * f))) AS control_rate
      FROM ranked, (VALUES {_ULIFT}) g(i, f) GROUP BY i, f""",
    "lifts": "SELECT *, (treated_rate - control_rate) * segment_size AS incremental_lift FROM cuts",
    "gains": """SELECT *, top_fraction * (SELECT incremental_lift FROM lifts WHERE decile = 10) AS random_incremental_lift,
      incremental_lift - top_fraction * (SELECT incremental_lift FROM lifts WHERE decile = 10) AS qini_gain FROM lifts""",
    "steps": """SELECT *, (qini_gain + lag(qini_gain) OVER (ORDER BY decile)) / 2 * (top_fraction - lag(top_fraction) OVER (ORDER BY decile)) AS s FROM gains""",
}


@_register(
    "upl6_lift_table",
    with_ctes(
        ["uplift"],
        """SELECT decile, top_fraction, segment_size, round(treated_rate, 6) AS treated_rate, round(control_rate, 6) AS control_rate,
        round(incremental_lift, 6) AS incremental_lift, round(random_incremental_lift, 6) AS random_incremental_lift, round(qini_gain, 6) AS qini_gain,
        round((SELECT sum(s) FROM steps), 6) AS qini_coefficient FROM steps""",
        **_LIFT_CTES,
    ),
)
def _(spark, d):
    return rounded(
        uplift.lift_table(fx.uplift(spark, d)),
        "treated_rate", "control_rate", "incremental_lift", "random_incremental_lift", "qini_gain", "qini_coefficient",
    )


@_register(
    "upl7_lift_summary",
    with_ctes(
        ["uplift"],
        """SELECT 'hash' AS model, max(segment_size) FILTER (decile = 2) AS top20_segment_size, round(max(treated_rate) FILTER (decile = 2), 6) AS top20_treated_rate,
        round(max(control_rate) FILTER (decile = 2), 6) AS top20_control_rate, round(max(incremental_lift) FILTER (decile = 2), 6) AS top20_incremental_lift,
        round(max(incremental_lift) FILTER (decile = 2) / max(incremental_lift) FILTER (decile = 10), 6) AS top20_capture_share,
        round(max(incremental_lift) FILTER (decile = 1), 6) AS top_decile_incremental_lift, round(sum(s), 6) AS qini_coefficient FROM steps""",
        **_LIFT_CTES,
    ),
)
def _(spark, d):
    return rounded(
        uplift.lift_summary(fx.uplift(spark, d), model="hash"),
        "top20_treated_rate", "top20_control_rate", "top20_incremental_lift", "top20_capture_share", "top_decile_incremental_lift", "qini_coefficient",
    )


_CURVE = {
    "run": """SELECT *, row_number() OVER w AS rank, count(*) OVER () AS n, sum(treatment) OVER w AS n1, sum(1 - treatment) OVER w AS n0,
      sum(treatment * outcome) OVER w AS y1, sum((1 - treatment) * outcome) OVER w AS y0 FROM uplift WINDOW w AS (ORDER BY score DESC, key ROWS UNBOUNDED PRECEDING)""",
    "rates": "SELECT *, rank / n::DOUBLE AS top_fraction, y1 / nullif(n1, 0)::DOUBLE AS treated_rate, y0 / nullif(n0, 0)::DOUBLE AS control_rate FROM run",
    "curve": """SELECT *, (treated_rate - control_rate) * rank AS incremental_lift, top_fraction * (SELECT (treated_rate - control_rate) * rank FROM rates ORDER BY rank DESC LIMIT 1)
      AS random_incremental_lift FROM rates""",
    "gain": "SELECT *, incremental_lift - random_incremental_lift AS qini_gain FROM curve",
}


@_register(
    "upl8_qini_curve",
    with_ctes(
        ["uplift"],
        """SELECT key, rank, round(top_fraction, 6) AS top_fraction, round(treated_rate, 6) AS treated_rate, round(control_rate, 6) AS control_rate,
        round(incremental_lift, 6) AS incremental_lift, round(random_incremental_lift, 6) AS random_incremental_lift, round(qini_gain, 6) AS qini_gain FROM gain""",
        **_CURVE,
    ),
)
def _(spark, d):
    curve = uplift.qini_curve(fx.uplift(spark, d))
    names = ["top_fraction", "treated_rate", "control_rate", "incremental_lift", "random_incremental_lift", "qini_gain"]
    return rounded(curve, *names).select("key", "rank", *names)


@_register(
    "upl8_qini_summary",
    with_ctes(
        ["uplift"],
        """SELECT round((SELECT sum(t) FROM (SELECT (coalesce(qini_gain, 0) + lag(coalesce(qini_gain, 0)) OVER (ORDER BY rank)) / 2 *
        (top_fraction - lag(top_fraction) OVER (ORDER BY rank)) AS t FROM gain)), 6) AS qini_coefficient, round(a, 6) AS top20_treated_rate,
        round(b, 6) AS top20_control_rate, round((a - b) * k, 6) AS top20_incremental_lift FROM (SELECT avg(outcome) FILTER (treatment = 1) AS a,
        avg(outcome) FILTER (treatment = 0) AS b, count(*) AS k FROM gain WHERE top_fraction <= 0.20::DOUBLE)""",
        **_CURVE,
    ),
)
def _(spark, d):
    table = uplift.qini_summary(uplift.qini_curve(fx.uplift(spark, d)))
    return rounded(table, *table.columns)


@_register(
    "upl8_qini_deciles",
    with_ctes(
        ["uplift"],
        """SELECT CAST(ceil(top_fraction * 10) AS INT) AS decile, count(*) AS n, round(avg(treatment), 6) AS treated_rate, round(avg(outcome), 6) AS outcome_rate,
        round(avg(score), 6) AS avg_uplift_score FROM gain GROUP BY 1""",
        **_CURVE,
    ),
)
def _(spark, d):
    return rounded(uplift.qini_deciles(uplift.qini_curve(fx.uplift(spark, d))), "treated_rate", "outcome_rate", "avg_uplift_score")


def _summaries(spark, d):
    base = fx.uplift(spark, d)
    other = base.withColumn("score", 1 - F.col("score"))
    return uplift.lift_summary(base, model="hash").unionByName(uplift.lift_summary(other, model="reverse"))


def _summary_sql(label: str, order: str) -> str:
    ctes = dict(_LIFT_CTES, ranked=_LIFT_CTES["ranked"].replace("score DESC", order))
    body = f"SELECT '{label}' AS model, max(incremental_lift) FILTER (decile = 2) AS lift, sum(s) AS q FROM steps"
    return f"SELECT * FROM ({with_ctes(['uplift'], body, **ctes)})"


@_register(
    "upl9_compare_learners",
    f"""SELECT model, round(q, 6) AS qini_coefficient, round(lift, 6) AS top20_incremental_lift, CAST(row_number() OVER (ORDER BY q DESC NULLS LAST, lift DESC NULLS LAST, model) AS INT) AS position,
      row_number() OVER (ORDER BY q DESC NULLS LAST, lift DESC NULLS LAST, model) = 1 AS recommended FROM ({_summary_sql('hash', 'score DESC')} UNION ALL {_summary_sql('reverse', '1 - score DESC')})""",
)
def _(spark, d):
    table = uplift.compare_learners(_summaries(spark, d))
    return rounded(table, "qini_coefficient", "top20_incremental_lift").select("model", "qini_coefficient", "top20_incremental_lift", "position", "recommended")
