"""Stress, support and subject signals, from measures and from text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.expr import binned, clip, col, fixed, flag, graded, mapped, number
from riskloom.functions.text import has_any, tokens, word_hits
from riskloom.operators.schema import is_number

# Level edges and difficulty weights.
STRESS_EDGES = (0.0, 0.33, 0.67, 1.0)
STRESS_LEVELS = ("Low", "Medium", "High")
DIFFICULTY = {"None": 0.0, "Math": 1.0, "Language": 0.5, "Other": 0.3}
NO_SUBJECT = ("None", "No_Feedback")
SIGNAL_FEATURES = {
    "Academic Stress": ["Academic_Stress", "Academic_Stress_Level"],
    "Home Support": ["Home_Support_Risk"],
    "Subject Difficulty": ["Subject_Specific", "Subject_Risk_Flag", "Subject_Difficulty_Score"],
}


def base_stress(grade_change: Column, completion: Column) -> Column:
    """Mean of falling grades and missing completion, each in [0, 1]."""
    falling = clip(-F.coalesce(grade_change, F.lit(0.0)) / 10, 0.0, 1.0)
    missing = clip(1 - F.coalesce(completion, F.lit(0.5)), 0.0, 1.0)
    return (falling + missing) / 2


def home_risk(age: Column, international: Column, debtor: Column) -> Column:
    """Age over 20, origin and debt added up, in [0, 1]; unknown if any part is."""
    return clip(clip((age - 20) / 30, 0.0, 1.0) + international * 0.3 + debtor * 0.4, 0.0, 1.0)


def stress_level(score: Column) -> Column:
    return binned(score, STRESS_EDGES, STRESS_LEVELS)


def subject_flag(subject: Column) -> Column:
    return flag(~subject.isin(*NO_SUBJECT))


def subject_difficulty(subject: Column) -> Column:
    """Difficulty of the named subject; no feedback has none."""
    return mapped(subject, DIFFICULTY)


def display_levels(stress: Column, risk: Column) -> tuple[Column, Column]:
    """Coarse labels for a stress and a home-risk score."""
    return (
        graded(stress, [(0.67, "High"), (0.33, "Medium")], "Low", "N/A"),
        graded(risk, [(0.5, "High"), (0.25, "Medium")], "Low", "N/A"),
    )


def signal_features(
    df: DataFrame, age: str, international: str, debtor: str, subject: Column, has_text: Column
) -> DataFrame:
    """Add the six signal columns; rows without text carry none of the scores."""

    def measure(name: str, default: float) -> Column:
        return number(col(name)) if name in df.columns else F.lit(default)

    stress = F.when(has_text, base_stress(col("Delta_Grade"), col("CR_Sem2")))
    home = F.when(
        has_text, home_risk(measure(age, 20.0), measure(international, 0.0), measure(debtor, 0.0))
    )
    out = df.withColumns(
        {
            "Academic_Stress": stress,
            "Home_Support_Risk": home,
            "Subject_Specific": F.when(has_text, F.coalesce(subject, F.lit("None"))).otherwise("No_Feedback"),
        }
    )
    return out.withColumns(
        {
            "Academic_Stress_Level": stress_level(col("Academic_Stress")),
            "Subject_Risk_Flag": subject_flag(col("Subject_Specific")),
            "Subject_Difficulty_Score": subject_difficulty(col("Subject_Specific")),
        }
    )


def signal_summary(df: DataFrame, features: Mapping[str, Sequence[str]] = SIGNAL_FEATURES) -> DataFrame:
    """(category, feature, coverage, mean, std), numbers as report text."""
    listed = [(g, f) for g, fs in features.items() for f in fs if f in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, f) in enumerate(listed):
        aggs.append(F.count(col(f)).alias(f"n{i}"))
        if is_number(df.schema[f].dataType):
            aggs += [F.avg(col(f)).alias(f"a{i}"), F.stddev_samp(col(f)).alias(f"s{i}")]

    def text(f: str, c: str) -> Column:
        return fixed(F.col(c), 3) if is_number(df.schema[f].dataType) else F.lit("N/A")

    rows = F.array(
        *[
            F.struct(
                F.lit(g).alias("category"),
                F.lit(f).alias("feature"),
                F.concat(fixed(F.try_divide(F.col(f"n{i}") * 100.0, F.col("_rows")), 1), F.lit("%")).alias("coverage"),
                text(f, f"a{i}").alias("mean"),
                text(f, f"s{i}").alias("std"),
            )
            for i, (g, f) in enumerate(listed)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def level_distribution(df: DataFrame, level: str, order: Sequence[str] = STRESS_LEVELS) -> DataFrame:
    """(level, ordinal, n) in the order of the levels; rows without a level are left out."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), col(level)).cast("int")
    return (
        df.where(col(level).isNotNull())
        .groupBy(col(level).alias("level"), place.alias("ordinal"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("ordinal")
    )


def lexicon_scores(df: DataFrame, text: str, lexicon: Sequence[str], scale: float = 1.0) -> DataFrame:
    """Add (n_tokens, hits, score, level): share of lexicon words, scaled into [0, 1]."""
    out = df.withColumn("_w", tokens(col(text)))
    out = out.withColumns({"n_tokens": F.size("_w"), "hits": word_hits(F.col("_w"), lexicon)}).drop("_w")
    score = F.when(F.col("n_tokens") > 0, F.least(F.col("hits") / F.col("n_tokens") * scale, F.lit(1.0)))
    return out.withColumn("score", score).withColumn("level", stress_level(F.col("score")))


def topic_tag(words: Column, topics: Mapping[str, Sequence[str]], default: str = "None") -> Column:
    """First topic one of whose words occurs."""
    out = None
    for name, lexicon in topics.items():
        hit = has_any(words, lexicon)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(default))


def topic_quadrants(df: DataFrame, topics: Mapping[str, Column], sentiment: str) -> DataFrame:
    """(topic, prevalence, sentiment, quadrant): share of rows with the topic and their mean sentiment.

    A row may have several topics.  All topics share one pass.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, hit in enumerate(topics.values()):
        aggs += [F.count_if(hit).alias(f"n{i}"), F.avg(F.when(hit, col(sentiment))).alias(f"s{i}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("topic"),
                F.try_divide(F.col(f"n{i}"), F.col("_rows")).alias("prevalence"),
                F.col(f"s{i}").alias("sentiment"),
            )
            for i, t in enumerate(topics)
        ]
    )
    often = F.col("prevalence") > 0.5
    quadrant = (
        F.when(often & (F.col("sentiment") > 0), "Success case")
        .when(often & (F.col("sentiment") < 0), "Critical issue")
        .when((F.col("prevalence") <= 0.5) & (F.col("sentiment") > 0), "Niche strength")
        .otherwise("Minor frustration")
    )
    return df.agg(*aggs).select(F.inline(rows)).withColumn("quadrant", quadrant)


def pulse_alerts(
    df: DataFrame, period: str, value: str, entity: str, floor: float, consecutive: int = 1
) -> DataFrame:
    """(period, n, score, change, alert, alert_entity): mean per period and, on alert, its most named entity."""
    counts = df.groupBy(col(period), col(entity)).agg(
        F.count(F.lit(1)).alias("k"), F.sum(col(value)).alias("s"), F.count(col(value)).alias("v")
    )
    best = F.struct((-F.col("k")).alias("k"), col(entity).alias("e"))
    periods = counts.groupBy(col(period)).agg(
        F.sum("k").alias("n"),
        F.try_divide(F.sum("s"), F.sum("v")).alias("score"),
        F.min(F.when(col(entity).isNotNull(), best)).getField("e").alias("top"),
    )
    # one row per period
    order = Window.partitionBy(F.lit(1)).orderBy(col(period))
    low = (F.col("score") < floor).cast("int")
    run = F.sum(low).over(order.rowsBetween(1 - consecutive, 0))
    out = periods.select(
        col(period),
        "n",
        "score",
        (F.col("score") - F.lag("score").over(order)).alias("change"),
        F.coalesce((run == consecutive).cast("int"), F.lit(0)).alias("alert"),
        "top",
    )
    return out.withColumn("alert_entity", F.when(F.col("alert") == 1, F.col("top"))).drop("top")
