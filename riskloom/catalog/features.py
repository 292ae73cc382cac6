"""Trajectory and text features, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.catalog.fixtures import PATHS, WEEKLY_EVENTS, student_records, weekly_events
from riskloom.catalog.registry import ORACLES, query, rounded
from riskloom.functions.expr import col, mapped
from riskloom.functions.text import has_any, tokens
from riskloom.operators import correlation, signals, trajectory
from riskloom.operators.trajectory import TRAJECTORY_FEATURES
from riskloom.plans import student
from riskloom.plans.features import feature_reports, feature_table, page_rows
from riskloom.session import stage
from riskloom.sources.tables import table

ALL_PATHS = [f for fs in TRAJECTORY_FEATURES.values() for f in fs]


def student_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.trajectory_features(student_records(spark, sf_dir), student.FIRST, student.SECOND)


_RATE_FEATURES = [f for f in ALL_PATHS if f.startswith(("Delta", "CR", "Eval", "GhostRate"))]


@query(
    "trajectory_features",
    f"WITH {PATHS} SELECT student_id, "
    + ", ".join(f'round("{f}", 6) AS "{f}"' if f in _RATE_FEATURES else f'"{f}"' for f in ALL_PATHS)
    + " FROM paths",
)
def trajectory_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(student_paths(spark, sf_dir).select("student_id", *ALL_PATHS))


@query(
    "trajectory_summary",
    f"WITH {PATHS} "
    + " UNION ALL ".join(
        f"SELECT '{g}' AS category, '{f}' AS feature, CASE WHEN count(DISTINCT \"{f}\") <= 2 THEN 'Binary' "
        f"ELSE 'Continuous' END AS type, count(\"{f}\") AS non_null, printf('%.3f', avg(\"{f}\")) AS mean FROM paths"
        for g, fs in TRAJECTORY_FEATURES.items()
        for f in fs
    ),
)
def trajectory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.feature_summary(stage(student_paths(spark, sf_dir).select(*ALL_PATHS)))


# ------------------------------------------------------------------ measures to signals

_STRESS = """(least(greatest(-coalesce("Delta_Grade", 0) / 10, 0), 1)
    + least(greatest(1 - coalesce("CR_Sem2", 0.5), 0), 1)) / 2"""
_HOME = """CASE WHEN "Debtor" IS NOT NULL THEN least(greatest(least(greatest(("Age at enrollment" - 20) / 30, 0), 1)
    + "International" * 0.3 + "Debtor" * 0.4, 0), 1) END"""


@query(
    "base_stress",
    f"""WITH {PATHS} SELECT student_id, round({_STRESS}, 6) AS stress FROM paths""",
)
def base_stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_paths(spark, sf_dir)
    return rounded(s.select("student_id", signals.base_stress(col("Delta_Grade"), col("CR_Sem2")).alias("stress")))


@query(
    "home_support_risk",
    f"""WITH {PATHS}, r AS (SELECT student_id, {_HOME} AS risk FROM paths)
        SELECT student_id, round(risk, 6) AS home_risk,
          CASE WHEN risk IS NULL THEN 'N/A' WHEN risk > 0.5 THEN 'High' WHEN risk > 0.25 THEN 'Medium' ELSE 'Low' END AS display
        FROM r""",
)
def home_support_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_records(spark, sf_dir)
    risk = signals.home_risk(col("Age at enrollment"), col("International"), col("Debtor"))
    out = s.select("student_id", risk.alias("home_risk"))
    return rounded(out.withColumn("display", signals.display_levels(F.lit(None).cast("double"), F.col("home_risk"))[1]))


@query(
    "display_levels",
    f"""WITH {PATHS}, r AS (SELECT student_id, {_STRESS} AS stress, {_HOME} AS risk FROM paths)
        SELECT student_id,
          CASE WHEN stress IS NULL THEN 'N/A' WHEN stress > 0.67 THEN 'High' WHEN stress > 0.33 THEN 'Medium' ELSE 'Low' END AS stress_display,
          CASE WHEN risk IS NULL THEN 'N/A' WHEN risk > 0.5 THEN 'High' WHEN risk > 0.25 THEN 'Medium' ELSE 'Low' END AS home_display
        FROM r""",
)
def display_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_paths(spark, sf_dir)
    stress, home = signals.display_levels(
        signals.base_stress(col("Delta_Grade"), col("CR_Sem2")),
        signals.home_risk(col("Age at enrollment"), col("International"), col("Debtor")),
    )
    return s.select("student_id", stress.alias("stress_display"), home.alias("home_display"))


@query(
    "stress_levels",
    f"""WITH {PATHS}, l AS (SELECT {_STRESS} AS s FROM paths),
        b AS (SELECT CASE WHEN s >= 0 AND s <= 0.33 THEN 'Low' WHEN s <= 0.67 THEN 'Medium' WHEN s <= 1 THEN 'High' END AS level FROM l)
        SELECT level, CASE level WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS ordinal, count(*) AS n
        FROM b WHERE level IS NOT NULL GROUP BY level""",
)
def stress_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_paths(spark, sf_dir)
    level = signals.stress_level(signals.base_stress(col("Delta_Grade"), col("CR_Sem2")))
    return signals.level_distribution(s.select(level.alias("level")), "level")


# ------------------------------------------------------------------ text to signals
# The texts are invented syllables, so the lexicons are frequent ones.

STRAIN = ("to", "is", "re", "es", "ed", "er")
RELIEF = ("the", "of", "and", "la", "die", "en")
TOPICS = {
    "Math": ("thth", "thha", "onan"),
    "Language": ("thre", "que", "der"),
    "Other": ("ing", "tion", "ble"),
}

_WORDS = "list_filter(regexp_split_to_array(lower({t}), '[^\\p{{L}}]+'), lambda w: w <> '')"


def _in(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TOPIC_CASE = (
    "CASE "
    + " ".join(f"WHEN list_has_any(w, {_in(words)}) THEN '{t}'" for t, words in TOPICS.items())
    + " ELSE 'None' END"
)


@query(
    "lexicon_score",
    f"""WITH d AS (SELECT doc_id, {_WORDS.format(t="text")} AS w FROM documents),
        h AS (SELECT doc_id, CAST(len(w) AS INT) AS n_tokens, CAST(len(list_filter(w, lambda x: list_contains({_in(STRAIN)}, x))) AS INT) AS hits FROM d),
        s AS (SELECT *, CASE WHEN n_tokens > 0 THEN least(hits / n_tokens * 5.0, 1.0) END AS score FROM h)
        SELECT doc_id, n_tokens, hits, round(CAST(score AS DOUBLE), 6) AS score, CASE WHEN score <= 0.33 THEN 'Low' WHEN score <= 0.67 THEN 'Medium'
          WHEN score <= 1 THEN 'High' END AS level FROM s""",
)
def lexicon_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rounded(signals.lexicon_scores(d, "text", STRAIN, 5.0).drop("text"))


@query(
    "topic_tags",
    f"""WITH d AS (SELECT doc_id, {_WORDS.format(t="text")} AS w FROM documents),
        t AS (SELECT doc_id, {_TOPIC_CASE} AS topic FROM d)
        SELECT doc_id, topic, CASE WHEN topic = 'None' THEN 0 ELSE 1 END AS risk_flag,
          CASE topic WHEN 'None' THEN 0.0::DOUBLE WHEN 'Math' THEN 1.0 WHEN 'Language' THEN 0.5 ELSE 0.3 END AS difficulty FROM t""",
)
def topic_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text").select("doc_id", tokens(F.col("text")).alias("w"))
    tagged = d.select("doc_id", signals.topic_tag(F.col("w"), TOPICS).alias("topic"))
    return tagged.withColumns(
        {
            "risk_flag": signals.subject_flag(F.col("topic")),
            "difficulty": signals.subject_difficulty(F.col("topic")),
        }
    )


# Terms of one, two and three words, more of them than are compared one by one.
PHRASES = (
    "the the", "of the", "the of", "and the", "to the", "la la", "la de", "de la", "die der", "der die", "en la", "is the",
    "the and the", "of the the", "ing", "tion", "que",
)


@query(
    "phrase_hits",
    f"""WITH d AS (SELECT doc_id, {_WORDS.format(t="text")} AS w FROM documents),
        r AS (SELECT doc_id, len(w) AS n, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
        g AS (SELECT doc_id, n, a, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM r WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
        h AS (SELECT doc_id, count(*) FILTER (WHERE a IN {PHRASES}) AS n1, count(*) FILTER (WHERE a || ' ' || b IN {PHRASES}) AS n2,
          count(*) FILTER (WHERE a || ' ' || b || ' ' || c IN {PHRASES}) AS n3 FROM g GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS INT) AS n_tokens, CAST(coalesce(n1 + n2 + n3, 0) AS INT) AS hits,
          CASE WHEN len(w) > 0 THEN round(least((n1 + n2 + n3) / len(w), 1.0)::DOUBLE, 6) END AS score
        FROM d LEFT JOIN h ON d.doc_id = h.doc_id""",
)
def phrase_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon that holds phrases beside words."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rounded(signals.lexicon_scores(d, "text", PHRASES).drop("text", "level"))


_BALANCE = f"""CASE WHEN len(list_filter(w, lambda x: list_contains({_in(STRAIN + RELIEF)}, x))) > 0 THEN
    (len(list_filter(w, lambda x: list_contains({_in(RELIEF)}, x))) - len(list_filter(w, lambda x: list_contains({_in(STRAIN)}, x))))::DOUBLE
    / len(list_filter(w, lambda x: list_contains({_in(STRAIN + RELIEF)}, x))) ELSE 0.0 END"""


def _balance(words):
    """Sentiment in [-1, 1]: relief words against strain words, 0 without either."""
    from riskloom.functions.text import word_hits

    good, bad = word_hits(words, RELIEF), word_hits(words, STRAIN)
    return F.coalesce(F.try_divide((good - bad).cast("double"), good + bad), F.lit(0.0))


QUADRANT_TOPICS = {
    "Articles": ("the", "die", "la", "el"),
    "Math": TOPICS["Math"],
    "Language": TOPICS["Language"],
    "Other": TOPICS["Other"],
}


@query(
    "topic_quadrants",
    f"""WITH d AS (SELECT {_WORDS.format(t="text")} AS w FROM documents), s AS (SELECT w, {_BALANCE} AS s FROM d),
        t AS ("""
    + " UNION ALL ".join(
        f"SELECT '{t}' AS topic, count(*) FILTER (WHERE list_has_any(w, {_in(words)})) / count(*) AS prevalence, "
        f"avg(s) FILTER (WHERE list_has_any(w, {_in(words)})) AS sentiment FROM s"
        for t, words in QUADRANT_TOPICS.items()
    )
    + """) SELECT topic, round(prevalence, 6) AS prevalence, round(sentiment, 6) AS sentiment,
        CASE WHEN prevalence > 0.5 AND sentiment > 0 THEN 'Success case' WHEN prevalence > 0.5 AND sentiment < 0 THEN 'Critical issue'
          WHEN prevalence <= 0.5 AND sentiment > 0 THEN 'Niche strength' ELSE 'Minor frustration' END AS quadrant FROM t""",
)
def topic_quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("text").select(tokens(F.col("text")).alias("w"))
    # the tokens are found once, as a projection below the aggregate
    s = d.select(_balance(F.col("w")).alias("s"), *[has_any(F.col("w"), x).alias(t) for t, x in QUADRANT_TOPICS.items()])
    return rounded(signals.topic_quadrants(s, {t: col(t) for t in QUADRANT_TOPICS}, "s"))


@query(
    "pulse_alerts",
    f"""WITH {WEEKLY_EVENTS}, m AS (SELECT week, count(*) AS n, avg(value) AS score FROM weekly GROUP BY week),
        e AS (SELECT week, event_type, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, event_type) AS r
          FROM weekly WHERE event_type IS NOT NULL GROUP BY week, event_type)
        SELECT m.week, n, round(score, 6) AS score, round(score - lag(score) OVER (ORDER BY m.week), 6) AS change,
          CASE WHEN score < 50 THEN 1 ELSE 0 END AS alert, CASE WHEN score < 50 THEN event_type END AS alert_entity
        FROM m JOIN e ON m.week = e.week AND r = 1""",
)
def pulse_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(signals.pulse_alerts(weekly_events(spark, sf_dir), "week", "value", "event_type", 50.0))


_ROLES = "SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS turns FROM conversations GROUP BY conv_id"


@query(
    "text_coverage",
    """SELECT lang, count(*) AS n, round(avg(CASE WHEN toxic IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS coverage,
         count(toxic) AS covered FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
)
def text_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    j = d.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return rounded(
        j.groupBy("lang").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("toxic").isNotNull().cast("int")).alias("coverage"),
            F.count("toxic").alias("covered"),
        )
    )


# ------------------------------------------------------------------ students with feedback texts

_FEEDBACK = f"""feedback AS (SELECT conv_id, bool_or(list_has_any(w, {_in(TOPICS["Math"])})) AS m,
    bool_or(list_has_any(w, {_in(TOPICS["Language"])})) AS l, bool_or(list_has_any(w, {_in(TOPICS["Other"])})) AS o
    FROM (SELECT conv_id, {_WORDS.format(t="text")} AS w FROM conversations WHERE role = 'user') GROUP BY conv_id)"""
SIGNALS_SQL = f"""{PATHS}, {_FEEDBACK}, heard AS (SELECT *, conv_id IS NOT NULL AS has_text,
      CASE WHEN m THEN 'Math' WHEN l THEN 'Language' WHEN o THEN 'Other' ELSE 'None' END AS subject
      FROM paths LEFT JOIN feedback ON student_id = conv_id),
    scored AS (SELECT *, CASE WHEN has_text THEN {_STRESS} END AS "Academic_Stress",
      CASE WHEN has_text THEN {_HOME} END AS "Home_Support_Risk",
      CASE WHEN has_text THEN subject ELSE 'No_Feedback' END AS "Subject_Specific" FROM heard),
    signals AS (SELECT *, CASE WHEN "Academic_Stress" <= 0.33 THEN 'Low' WHEN "Academic_Stress" <= 0.67 THEN 'Medium'
        WHEN "Academic_Stress" <= 1 THEN 'High' END AS "Academic_Stress_Level",
      CASE WHEN "Subject_Specific" IN ('None', 'No_Feedback') THEN 0 ELSE 1 END AS "Subject_Risk_Flag",
      CASE "Subject_Specific" WHEN 'None' THEN 0.0::DOUBLE WHEN 'Math' THEN 1.0 WHEN 'Language' THEN 0.5 WHEN 'Other' THEN 0.3 END
        AS "Subject_Difficulty_Score" FROM scored)"""


def student_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Students with trajectory and signal columns; a conversation is a student's feedback."""
    talk = table(spark, sf_dir, "conversations").where(F.col("role") == "user").select("conv_id", "text")
    return feature_table(
        student_records(spark, sf_dir), "student_id", student.FIRST, student.SECOND,
        "Age at enrollment", "International", "Debtor", talk, "conv_id", "text", TOPICS,
    )


SIGNAL_COLUMNS = [f for fs in signals.SIGNAL_FEATURES.values() for f in fs]


@query(
    "signal_features",
    f"""WITH {SIGNALS_SQL} SELECT student_id, round("Academic_Stress", 6) AS "Academic_Stress", "Academic_Stress_Level",
        round("Home_Support_Risk", 6) AS "Home_Support_Risk", "Subject_Specific", "Subject_Risk_Flag",
        "Subject_Difficulty_Score" FROM signals""",
)
def signal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(student_signals(spark, sf_dir).select("student_id", *SIGNAL_COLUMNS))


_NUMERIC_SIGNALS = ("Academic_Stress", "Home_Support_Risk", "Subject_Risk_Flag", "Subject_Difficulty_Score")


@query(
    "signal_summary",
    f"WITH {SIGNALS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{g}' AS category, '{f}' AS feature, printf('%.1f%%', count(\"{f}\") * 100.0 / count(*)) AS coverage, "
        + (
            f"printf('%.3f', avg(\"{f}\")) AS mean, printf('%.3f', stddev_samp(\"{f}\")) AS std FROM signals"
            if f in _NUMERIC_SIGNALS
            else "'N/A' AS mean, 'N/A' AS std FROM signals"
        )
        for g, fs in signals.SIGNAL_FEATURES.items()
        for f in fs
    ),
)
def signal_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signal_summary(student_signals(spark, sf_dir))


# ------------------------------------------------------------------ correlations

def _corr(a: str, b: str) -> str:
    both = f'FILTER (WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL)'
    flat = f'coalesce(stddev_pop("{a}") {both} * stddev_pop("{b}") {both}, 0) = 0'
    return f'CASE WHEN {flat} THEN NULL ELSE round(corr("{a}", "{b}"), 6) END'


def _matrix_sql(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {_corr(a, b)} AS r FROM {source}" for a in columns for b in columns
    )


_LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "one")


@query(
    "correlation_matrix",
    "WITH t AS (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS d, 1 AS one FROM "
    "(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber FROM lineitem)), "
    "u AS (SELECT l_quantity, l_extendedprice, d AS l_discount, l_tax, one FROM t) " + _matrix_sql(_LINE_COLUMNS, "u"),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a column that has gaps and a constant one."""
    l = table(spark, sf_dir, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.lit(1).alias("one"),
    )
    return rounded(correlation.correlation_matrix(l, _LINE_COLUMNS))


@query("correlation_static", f"WITH {PATHS} {_matrix_sql(student.STATIC_CORRELATION, 'students')}")
def correlation_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(student_records(spark, sf_dir).select(*[col(c) for c in student.STATIC_CORRELATION]))
    return rounded(correlation.correlation_matrix(s, student.STATIC_CORRELATION))


@query("correlation_trajectory", f"WITH {PATHS} {_matrix_sql(student.TRAJECTORY_CORRELATION, 'paths')}")
def correlation_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(student_paths(spark, sf_dir).select(*[col(c) for c in student.TRAJECTORY_CORRELATION]))
    return rounded(correlation.correlation_matrix(s, student.TRAJECTORY_CORRELATION))


@query("correlation_signals", f"WITH {SIGNALS_SQL} {_matrix_sql(student.SIGNAL_CORRELATION, 'signals')}")
def correlation_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stage(student_signals(spark, sf_dir).select(*[col(c) for c in student.SIGNAL_CORRELATION]))
    return rounded(correlation.correlation_matrix(s, student.SIGNAL_CORRELATION))


CORRELATION_FEATURES = [*dict.fromkeys(student.STATIC_CORRELATION + student.TRAJECTORY_CORRELATION)]
WITH_TARGET = " UNION ALL ".join(
    f"SELECT '{c.replace(chr(39), chr(39) * 2)}' AS feature, corr(\"{c}\", y) AS r FROM coded "
    f"HAVING coalesce(stddev_pop(\"{c}\") FILTER (WHERE \"{c}\" IS NOT NULL AND y IS NOT NULL), 0) > 0"
    for c in CORRELATION_FEATURES
)


@query(
    "correlation_with_target",
    f"""WITH {PATHS}, coded AS (SELECT *, CASE "Target" WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 WHEN 'Graduate' THEN 2 END AS y
        FROM paths), c AS ({WITH_TARGET})
        SELECT feature, round(r, 6) AS correlation FROM c WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 20""",
)
def correlation_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = student_paths(spark, sf_dir)
    coded = s.select(
        *[col(c) for c in CORRELATION_FEATURES], mapped(col("Target"), student.TARGET_ORDINAL).alias("_y")
    )
    return rounded(correlation.correlation_with(stage(coded), CORRELATION_FEATURES, "_y"))


# ------------------------------------------------------------------ the page of the feature strategy

PAGE_MATRICES = {"static": student.STATIC_CORRELATION, "signals": student.SIGNAL_CORRELATION}
PAGE_FEATURES = [*dict.fromkeys([*CORRELATION_FEATURES, *ALL_PATHS, *_NUMERIC_SIGNALS])]


def _page_part(report: str, item: str, numbers: tuple[str, ...], texts: tuple[str, ...], sql: str) -> str:
    cells = [f"('{m}', {m}::DOUBLE, NULL)" for m in numbers] + [f"('{m}', NULL, {m})" for m in texts]
    return (
        f"SELECT '{report}' AS report, {item} AS item, metric, round(number, 6) AS number, text "
        f"FROM ({sql}) AS t, LATERAL (VALUES {', '.join(cells)}) AS v(metric, number, text)"
    )


_PAGE_TARGET = " UNION ALL ".join(
    f"SELECT '{c.replace(chr(39), chr(39) * 2)}' AS feature, corr(\"{c}\", y) AS correlation FROM coded "
    f"HAVING coalesce(stddev_pop(\"{c}\") FILTER (WHERE \"{c}\" IS NOT NULL AND y IS NOT NULL), 0) > 0"
    for c in PAGE_FEATURES
)
_PAGE = [
    _page_part("trajectory_summary", "feature", ("non_null",), ("category", "type", "mean"), ORACLES["trajectory_summary"]),
    _page_part("signal_summary", "feature", (), ("category", "coverage", "mean", "std"), ORACLES["signal_summary"]),
    _page_part(
        "stress_levels", "level", ("ordinal", "n"), (),
        """SELECT "Academic_Stress_Level" AS level, count(*) AS n,
           CASE "Academic_Stress_Level" WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS ordinal FROM signals
           WHERE "Academic_Stress_Level" IS NOT NULL GROUP BY "Academic_Stress_Level\"""",
    ),
    *[
        _page_part(f"correlation_{n}", "a || ' | ' || b", ("r",), (), _matrix_sql(columns, "signals"))
        for n, columns in PAGE_MATRICES.items()
    ],
    _page_part(
        "correlation_with_target", "feature", ("correlation",), (),
        f"SELECT * FROM ({_PAGE_TARGET}) AS c WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC, feature LIMIT 20",
    ),
]


@query(
    "report_features",
    f"""WITH {SIGNALS_SQL}, coded AS (SELECT *, CASE "Target" WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 WHEN 'Graduate' THEN 2 END AS y
        FROM signals) """
    + " UNION ALL ".join(_PAGE),
)
def report_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries, levels and correlations of the feature table, as the page lists them."""
    columns = [*dict.fromkeys(["Target", *PAGE_FEATURES, *SIGNAL_COLUMNS, *student.SIGNAL_CORRELATION])]
    s = stage(student_signals(spark, sf_dir).select(*[col(c) for c in columns]), "features")
    return rounded(page_rows(feature_reports(s, "Target", student.TARGET_ORDINAL, PAGE_MATRICES)))
