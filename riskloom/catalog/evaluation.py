"""Splits, class balance, metrics and fairness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.registry import query, rounded
from riskloom.operators import evaluate, fairness, split
from riskloom.sources.tables import table

# ------------------------------------------------------------------ splits and balance

# a one-to-one scrambling of the key that both engines can compute
_ORDER = "(o_orderkey * 2654435761) % 4294967296"
_STATUS = "o_orderstatus"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", _STATUS)


_RANKED = f"""ranked AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_ORDER}) AS r,
    count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)"""


@query(
    "stratified_split",
    f"""WITH {_RANKED} SELECT o_orderkey, o_orderstatus, CASE WHEN r <= floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS split
        FROM ranked""",
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split manifest: key, class and side."""
    return split.stratified_split(_orders(spark, sf_dir), _STATUS, "o_orderkey", order=F.expr(_ORDER))


@query(
    "stratified_split_counts",
    """SELECT o_orderstatus, 'test' AS split, CAST(floor(0.2 * count(*) + 0.5) AS BIGINT) AS n FROM orders GROUP BY o_orderstatus
       UNION ALL SELECT o_orderstatus, 'train', count(*) - CAST(floor(0.2 * count(*) + 0.5) AS BIGINT) FROM orders
       GROUP BY o_orderstatus""",
)
def stratified_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the hash order: the sizes are exact whatever the hash."""
    s = split.stratified_split(_orders(spark, sf_dir), _STATUS, "o_orderkey")
    return s.groupBy(_STATUS, "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stratified_folds",
    f"""SELECT o_orderkey, o_orderstatus, CAST(ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {_ORDER}) AS INT) AS fold
        FROM orders""",
)
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_folds(_orders(spark, sf_dir), _STATUS, "o_orderkey", order=F.expr(_ORDER))


@query(
    "class_weights",
    """SELECT o_orderpriority, count(*) AS n, round((SELECT count(*) FROM orders) / (5.0 * count(*)), 6) AS weight
       FROM orders GROUP BY o_orderpriority""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = split.with_weights(table(spark, sf_dir, "orders").select("o_orderpriority"), "o_orderpriority")
    return rounded(o.groupBy("o_orderpriority", "weight").agg(F.count(F.lit(1)).alias("n")))


def _imbalance_sql(label: str, source: str) -> str:
    texts = {k: v.replace("'", "''").replace("%.2f", "' || printf('%.2f', ratio) || '") for k, v in evaluate.ADVICE.items()}
    advice = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items())
    return f"""c AS (SELECT {label} AS k, count(*) AS n FROM {source} WHERE {label} IS NOT NULL GROUP BY 1),
      r AS (SELECT (SELECT k FROM c ORDER BY n DESC, k LIMIT 1) AS max_class, (SELECT max(n) FROM c) AS max_class_count,
        (SELECT k FROM c ORDER BY n, k LIMIT 1) AS min_class, (SELECT min(n) FROM c) AS min_class_count,
        (SELECT max(n) / min(n) FROM c) AS ratio),
      s AS (SELECT *, CASE WHEN ratio < 3 THEN 'Light' WHEN ratio < 10 THEN 'Moderate' ELSE 'Severe' END AS severity,
        CASE WHEN ratio < 3 THEN 'class_weight_only' WHEN ratio < 10 THEN 'class_weight_required' ELSE 'advanced_methods_needed' END AS strategy,
        CASE WHEN ratio < 1.5 THEN 'Minimal Imbalance' WHEN ratio < 3 THEN 'Light Imbalance' WHEN ratio < 5 THEN 'Moderate Imbalance'
          ELSE 'Severe Imbalance' END AS report_level FROM r)
      SELECT max_class, max_class_count, min_class, min_class_count, round(ratio, 6) AS ratio, severity, strategy, report_level,
        CASE severity {advice} END AS recommendation FROM s"""


@query("class_imbalance", "WITH " + _imbalance_sql("lang", "documents"))
def class_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.class_imbalance(table(spark, sf_dir, "documents").select("lang"), "lang"))


# ------------------------------------------------------------------ metrics

FLAGS = ("A", "N", "R")
PROBS = {k: f"p_{k}" for k in FLAGS}
_WEIGHTS = {
    "by_quantity": ("l_quantity / 50", "l_discount * 10 + 0.1e0", "l_tax * 12.5e0 + 0.05e0"),
    "by_price": ("l_discount * 10 + 0.2e0", "l_extendedprice / 100000", "l_tax * 12.5e0 + 0.1e0"),
}


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the probabilities and predictions of two fixed scoring rules."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "truth")
    rules = F.array(
        *[
            F.struct(F.lit(m).alias("model"), *[F.expr(w).alias(f"w_{k}") for k, w in zip(FLAGS, ws)])
            for m, ws in _WEIGHTS.items()
        ]
    )
    rows = lines.select("l_orderkey", "l_linenumber", "truth", "l_linestatus", F.inline(rules))
    total = F.col("w_A") + F.col("w_N") + F.col("w_R")
    pred = (
        F.when((F.col("w_A") >= F.col("w_N")) & (F.col("w_A") >= F.col("w_R")), "A")
        .when(F.col("w_N") >= F.col("w_R"), "N")
        .otherwise("R")
    )
    return rows.select(
        "model",
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        "truth",
        pred.alias("pred"),
        *[(F.col(f"w_{k}") / total).alias(p) for k, p in PROBS.items()],
    )


SCORED = (
    "weights AS ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS model, l_orderkey, l_linenumber, l_linestatus, l_returnflag AS truth, "
        + ", ".join(f"{w} AS w_{k}" for k, w in zip(FLAGS, ws))
        + " FROM lineitem"
        for m, ws in _WEIGHTS.items()
    )
    + """), scored AS (SELECT model, l_orderkey, l_linenumber, l_linestatus, truth,
      CASE WHEN w_A >= w_N AND w_A >= w_R THEN 'A' WHEN w_N >= w_R THEN 'N' ELSE 'R' END AS pred,
      w_A / (w_A + w_N + w_R) AS p_A, w_N / (w_A + w_N + w_R) AS p_N, w_R / (w_A + w_N + w_R) AS p_R FROM weights)"""
)


@query(
    "confusion_matrix",
    f"WITH {SCORED} SELECT model, truth, "
    + ", ".join(f"count(*) FILTER (WHERE pred = '{k}') AS \"pred_{k}\"" for k in FLAGS)
    + " FROM scored GROUP BY model, truth",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(scored_lines(spark, sf_dir), "truth", "pred", FLAGS, ["model"])


def report_sql(by: str) -> str:
    """CTE ``report``: classification report of ``scored`` per ``by``."""
    return f"""cls AS (SELECT DISTINCT {by}, truth AS label FROM scored UNION SELECT DISTINCT {by}, pred FROM scored),
      m AS (SELECT c.{by}, c.label, count(*) FILTER (WHERE truth = label) AS support, count(*) FILTER (WHERE pred = label) AS said,
        count(*) FILTER (WHERE truth = label AND pred = label) AS hit
        FROM cls c JOIN scored s ON s.{by} = c.{by} GROUP BY c.{by}, c.label),
      f AS (SELECT {by}, label, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS precision,
        CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall,
        CASE WHEN said + support > 0 THEN 2.0 * hit / (said + support) ELSE 0 END AS f1, support, hit FROM m),
      report AS (SELECT {by}, label, precision, recall, f1, support FROM f
        UNION ALL SELECT {by}, 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support),
          CAST(sum(support) AS BIGINT) FROM f GROUP BY {by}
        UNION ALL SELECT {by}, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f GROUP BY {by}
        UNION ALL SELECT {by}, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f GROUP BY {by})"""


@query(
    "classification_report",
    f"""WITH {SCORED}, {report_sql("model")} SELECT model, label, round(CAST(precision AS DOUBLE), 6) AS precision,
        round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1 AS DOUBLE), 6) AS f1, support FROM report""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.classification_report(scored_lines(spark, sf_dir), "truth", "pred", ["model"]))


AUC_SQL = (
    "curves AS ("
    + " UNION ALL ".join(
        f"SELECT model, '{k}' AS label, p_{k} AS score, count(*) FILTER (WHERE truth = '{k}') AS p, "
        f"count(*) FILTER (WHERE truth <> '{k}') AS n FROM scored GROUP BY model, p_{k}"
        for k in FLAGS
    )
    + """), below AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY model, label ORDER BY score
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM curves),
      auc AS (SELECT model, label, CAST(sum(p * (b + n / 2.0)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(n)) AS auc
        FROM below GROUP BY model, label)"""
)


@query(
    "roc_auc",
    f"""WITH {SCORED}, {AUC_SQL} SELECT model, label, round(auc, 6) AS auc FROM auc
        UNION ALL SELECT model, 'macro', round(avg(auc), 6) FROM auc GROUP BY model""",
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_auc_ovr(scored_lines(spark, sf_dir), "truth", PROBS, ["model"]))


_COMPARED = f"""{SCORED}, {report_sql("model")}, {AUC_SQL}, macro AS (SELECT model, avg(auc) AS auc FROM auc GROUP BY model),
  compared AS (SELECT model, CAST(precision AS DOUBLE) AS precision, CAST(recall AS DOUBLE) AS recall, CAST(f1 AS DOUBLE) AS f1, auc
    FROM report JOIN macro USING (model) WHERE label = 'macro avg')"""


@query(
    "comparison_table",
    f"""WITH {_COMPARED} SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        round(auc, 6) AS auc FROM compared""",
)
def comparison_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.comparison_table(scored_lines(spark, sf_dir), "truth", "pred", PROBS, "model"))


@query(
    "best_model",
    f"""WITH {_COMPARED} SELECT model, round(auc, 6) AS auc, round(f1, 6) AS f1 FROM compared
        ORDER BY compared.auc DESC, compared.f1 DESC, model LIMIT 1""",
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = evaluate.comparison_table(scored_lines(spark, sf_dir), "truth", "pred", PROBS, "model")
    return rounded(evaluate.best_model(compared))



@query(
    "cross_validation_score",
    f"""WITH {SCORED.replace("scored AS (", "all_scored AS (")}, scored AS (SELECT model || '#' ||
          CAST(1 + (l_orderkey * 7 + l_linenumber) % 5 AS INT) AS part, truth, pred FROM all_scored), {report_sql("part")}
        SELECT split_part(part, '#', 1) AS model, count(*) AS folds, round(avg(CAST(f1 AS DOUBLE)), 6) AS cv_score_mean,
          round(stddev_pop(CAST(f1 AS DOUBLE)), 6) AS cv_score_std FROM report WHERE label = 'macro avg' GROUP BY 1""",
)
def cross_validation_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_lines(spark, sf_dir)
    s = s.withColumn("fold", F.expr("CAST(1 + (l_orderkey * 7 + l_linenumber) % 5 AS INT)"))
    return rounded(evaluate.cross_validation_score(s, "truth", "pred", "fold", ["model"]))


@query(
    "top_features",
    """WITH f AS (SELECT l_returnflag AS model, unnest(['l_quantity', 'l_discount', 'l_tax', 'price']) AS feature,
         unnest([avg(abs(l_quantity - 25) / 50), avg(l_discount), avg(l_tax), avg(l_extendedprice / 100000)]) AS importance
         FROM lineitem GROUP BY l_returnflag),
       r AS (SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS INT) AS rank FROM f)
       SELECT model, rank, feature, round(importance, 6) AS importance FROM r WHERE rank <= 3""",
)
def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    parts = {
        "l_quantity": F.avg(F.abs(F.col("l_quantity") - 25) / 50),
        "l_discount": F.avg("l_discount"),
        "l_tax": F.avg("l_tax"),
        "price": F.avg(F.col("l_extendedprice") / 100000),
    }
    wide = l.groupBy(F.col("l_returnflag").alias("model")).agg(*[a.alias(n) for n, a in parts.items()])
    long = wide.unpivot(["model"], list(parts), "feature", "importance")
    return rounded(evaluate.top_features(long, "model", "feature", "importance", 3))


# ------------------------------------------------------------------ fairness

ATTRIBUTES = ("o_orderpriority", "c_mktsegment", "c_nationkey")


def judged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a price rule as prediction, harsher on one priority."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    harsh = F.when(F.col("o_orderpriority") == "1-URGENT", 90000.0).otherwise(0.0)
    level = F.col("o_totalprice") - harsh
    pred = F.when(level < 170000, "F").when(level < 340000, "O").otherwise("P")
    joined = o.join(c, o.o_custkey == c.c_custkey)
    return joined.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("truth"),
        pred.alias("pred"),
        "o_orderpriority",
        "c_mktsegment",
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey")).alias("c_nationkey"),
    )


_JUDGED = """judged AS (SELECT o_orderkey, o_orderstatus AS truth, CASE
      WHEN o_totalprice - CASE WHEN o_orderpriority = '1-URGENT' THEN 90000 ELSE 0 END < 170000 THEN 'F'
      WHEN o_totalprice - CASE WHEN o_orderpriority = '1-URGENT' THEN 90000 ELSE 0 END < 340000 THEN 'O' ELSE 'P' END AS pred,
      o_orderpriority, c_mktsegment, CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS c_nationkey
      FROM orders JOIN customer ON o_custkey = c_custkey),
  rates AS (""" + " UNION ALL ".join(
    f"""SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS "group", count(*) AS sample_size,
        avg(CASE WHEN pred = 'F' THEN 1 ELSE 0 END) AS positive_rate,
        coalesce(count(*) FILTER (WHERE truth = 'F' AND pred = 'F') / nullif(count(*) FILTER (WHERE truth = 'F'), 0), 0) AS tpr,
        coalesce(count(*) FILTER (WHERE truth <> 'F' AND pred = 'F') / nullif(count(*) FILTER (WHERE truth <> 'F'), 0), 0) AS fpr
        FROM judged WHERE {a} IS NOT NULL GROUP BY {a}"""
    for a in ATTRIBUTES
) + ")"
_AUDIT = (
    _JUDGED
    + """, audit AS (SELECT attribute, count(*) AS n_groups,
      CASE WHEN max(positive_rate) > 0 THEN min(positive_rate) / max(positive_rate) ELSE 1 END AS disparate_impact,
      max(tpr) - min(tpr) AS tpr_difference, max(fpr) - min(fpr) AS fpr_difference FROM rates GROUP BY attribute),
    levels AS (SELECT *, CASE WHEN disparate_impact >= 0.8 THEN 'Fair' ELSE 'Potential Bias' END AS di_level,
      CASE WHEN tpr_difference < 0.1 AND fpr_difference < 0.1 THEN 'Fair' ELSE 'Potential Bias' END AS eo_level FROM audit)"""
)


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fairness.group_rates(judged_orders(spark, sf_dir), ATTRIBUTES, "truth", "pred", "F")


@query(
    "group_rates",
    f"""WITH {_JUDGED} SELECT attribute, "group", sample_size, round(positive_rate, 6) AS positive_rate, round(tpr, 6) AS tpr,
        round(fpr, 6) AS fpr FROM rates""",
)
def group_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rates(spark, sf_dir))


@query(
    "disparate_impact",
    f"""WITH {_AUDIT} SELECT attribute, n_groups, round(disparate_impact, 6) AS disparate_impact, di_level AS fairness_level
        FROM levels""",
)
def disparate_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fairness.disparate_impact(_rates(spark, sf_dir)))


@query(
    "equalized_odds",
    f"""WITH {_AUDIT} SELECT attribute, round(tpr_difference, 6) AS tpr_difference, round(fpr_difference, 6) AS fpr_difference,
        eo_level AS fairness_level FROM levels""",
)
def equalized_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fairness.equalized_odds(_rates(spark, sf_dir)))


@query(
    "fairness_overall",
    f"""WITH {_AUDIT}, t AS (SELECT count(*) AS total_features_audited, count(*) FILTER (WHERE di_level = 'Fair') AS fair_on_disparate_impact,
          count(*) FILTER (WHERE eo_level = 'Fair') AS fair_on_equalized_odds FROM levels)
        SELECT *, round(fair_on_disparate_impact / total_features_audited, 6) AS di_fairness_rate,
          round(fair_on_equalized_odds / total_features_audited, 6) AS eo_fairness_rate,
          CASE WHEN fair_on_disparate_impact = total_features_audited AND fair_on_equalized_odds = total_features_audited
            THEN 'Pass' ELSE 'Needs Review' END AS overall_fairness FROM t""",
)
def fairness_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fairness.overall_fairness(fairness.full_audit(_rates(spark, sf_dir))))
