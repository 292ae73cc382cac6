"""Personal data by candidate spans and boosted trees, built-in functions and Spark ML only.

Strict patterns with their checks (address form, part limits, Luhn, number of digits) give the base spans.  Loose
generators propose more, overlapping ones: anything around an @, runs of seven digits or more, long runs of letters and
digits, groups of hexadecimal digits between colons, account numbers that begin with a country, and addresses with "at"
and "dot" written out.  Gradient-boosted trees score these on format and context, never on the checks themselves.

The tables hold no labels for personal data, so the trees learn from labels by construction: generated examples of each
form (positive) and of what looks alike, such as dates, prices, counts, times, codes and long words (negative), and
strict spans of the table in their own context, corrupted so that the strict patterns no longer see them (the + gone, the
@ spelt out), which stay positive; at most ``CORRUPTED_ROWS`` of each kind, those of least hash.  A quarter of the examples, by hash, is left out of the fit: on it each kind's threshold is calibrated, as the
middle of the first gap below the least score from which on ``PRECISION`` of the kind's examples or more are positive.  Candidates above it that overlap no
base span are added; of overlapping ones the best, and then each that overlaps none taken before.

Places are code points, ends exclusive.  Defined results: a null text is an empty text and has no spans; repeated rows
have the same spans each; of a kind whose threshold does not reach ``PRECISION`` no span is added; an empty table gives
an empty result; columns other than the id and the text are not read, and ``redact`` leaves them as they are.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm.exprs import fresh, let, quoted, total
from riskloom.session import stage

BASE = ("email", "ip", "card", "phone")
LOOSE = ("address", "number", "secret", "hexgroups", "account", "spelled")
KINDS = BASE + LOOSE
EXAMPLES = 120  # generated for each form
CORRUPTED_ROWS = 2_000
PRECISION = 0.95
BEFORE, AFTER = 24, 12  # code points of context

#: Leftmost non-overlapping matches, as the plain patterns give; look-behinds and possessive loops only spare retries
#: inside a run that has failed.  \G lets a match begin where the last one ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "address": r"(?<!\S)[^\s@]++@\S++",
    "number": r"(?<![0-9])[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+",
    "hexgroups": r"(?<![0-9A-Za-z:-])(?:[0-9A-Fa-f]{1,4}::?+|::){2,7}[0-9A-Fa-f]{0,4}+|"
    r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}(?:-[0-9A-Fa-f]{2}){5}(?![0-9A-Za-z-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,5}){3,8}+(?![A-Za-z0-9])",
    "spelled": r"(?i)(?<![\w.+-])[\w.+-]++\s?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)\s?[\w-]++"
    r"(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\s?[\w-]++)++",
}
#: A text without the trigger has no match.
TRIGGERS = {
    "email": lambda t: t.contains("@"),
    "address": lambda t: t.contains("@"),
    "phone": lambda t: t.contains("+"),
    "secret": lambda t: t.rlike(r"[A-Za-z0-9_+/=-]{16}"),
    "hexgroups": lambda t: t.rlike(r"[0-9A-Fa-f][:-][0-9A-Fa-f]|::"),
    "account": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "spelled": lambda t: t.rlike(r"(?i)\bdot\b"),
}

CONTEXT = {
    "ctx_phone": r"(?i)(tel|phone|call|mobile|fax|whatsapp|sms)\W*\w*\W*$",
    "ctx_card": r"(?i)(card|visa|amex|account|iban|konto|tarjeta|carte)\W*\w*\W*$",
    "ctx_net": r"(?i)(ip|host|server|address|adresse)\W*\w*\W*$",
    "ctx_mail": r"(?i)(mail|contact|write|kontakt|correo)\W*\w*\W*$",
    "ctx_amount": r"(?i)([$€£#]|no\.?|nr\.?|page|year|id|part|on|at|since|isbn)\s*$",
    "ctx_secret": r"(?i)(token|key|secret|passw(or)?d|pwd|auth\w*|bearer|credential\w*)\W*$",
    "ctx_assigned": r"[=:]\s*[\"'`]?$",
}


#: Forms of generated examples; see ``examples`` for what stands in braces.
ALPHABETS = {
    "d": "0123456789",
    "h": "0123456789abcdef",
    "w": "abcdefghijklmnopqrstuvwxyz",
    "W": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "m": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
_CARDS = ["{4|5|3|9}{d3}{ |-}{d4}{ |-}{d4}{ |-}{d4}", "{3|4|5|9}{d15}"]
_NATION = "{DE|FR|ES|GB|NL|IT|PL|AT|CH|BE}"
LIKELY = {
    "number": ["{d3}-{d3}-{d4}", "{d3}) {d3}-{d4}", "0{d3}{ |/|-}{d4}{ |-|}{d3}", "{d3}{ |.}{d3}{ |.}{d4}", *["!" + c for c in _CARDS]],
    "address": ["{w6}{|.|_}{w4}@{w7}.{w3}", "{w3}ö{w3}@ü{w6}.{com|de|fr|w2}"],
    "secret": ["{h40}", "{h32}", "{h64}", "{h24}", "{m40}", "{m27}", "{m32}", "{sk_|pk_|ghp_|api-|AKIA}{m24}"],
    "hexgroups": [
        "{h4}:{h4}:{h4}:{h4}:{h4}:{h4}:{h4}:{h4}", "2{h3}:{h4}::{h4}", "fe80::{h4}:{h4}:{h4}:{h4}",
        "{h2}:{h2}:{h2}:{h2}:{h2}:{h2}", "{h2}-{h2}-{h2}-{h2}-{h2}-{h2}",
    ],
    "account": [_NATION + "{d2} {d4} {d4} {d4} {d4} {d2}", _NATION + "{d20}", "GB{d2} {W4} {d4} {d4} {d4} {d2}"],
    "spelled": [
        "{w3|w4|w6}{|.|_}{w4} at {w7} dot {com|org|net|de|fr|es|io|example}",
        "{w3}{ (at) |(at)| [at] |[at]}{w6}{ (dot) |(dot)| [dot] |[dot]}{com|org|de|w3}",
        "{w5}.{w4}{ (at) |(at)| [at] |[at]}{w7}{ (dot) |(dot)| [dot] |[dot]}{com|org|net|fr}",
    ],
}
UNLIKELY = {
    "number": [
        "20{d2}-{d2}-{d2}", "20{d2}-{d2}-{d2} {d2}", "{d2}/{d2}/20{d2}", "{d7}/{d2}", "{d1} 000 000{| 000}", "{d1}.{d3}.{d3}{|.000}",
        "978-{d1}-{d4}-{d4}-{d1}", "3.{d9}", "{d4}-{d4}", "20{d6}", "{d7}", "{d8}", "{d9}", "{d16} {d16}", *_CARDS,
    ],
    "address": ["{w2}@{w4}", "{w5}@{d1}", "{w3}@/{w3}"],
    "secret": [
        "{w9}{w8}{d1}", "{w7}-{w6}-{w5}-{d2}", "{w6}/{w7}/20{d2}/{w4}", "===={d1}============", "{W9}_{W9}_{d2}", "{W4}_{W6}_{W4}_{W4}_{d2}",
        "{d17}", "{d4}-{d4}/{d4}-{d4}", "{w8}{d2}{w9}", "----------------{d2}", _NATION + "{d20}", "{d3}-{d1}-{d2}-{d6}-{d1}",
    ],
    "hexgroups": ["{0|1}{d1}:{0|1|2|3|4|5}{d1}:{0|1|2|3|4|5}{d1}", "{d1}:{d1}:{d1}", "{d2}:{d2}:{d2}:{d2}", "{d1}:{d2}:{d1}"],
    "account": ["{W2}{d2} {W3} {W5} {W5} {W3}", "{W2}{d2}{W12}", "{W2}{d2} {W4} {W3} {W4}"],
    "spelled": [
        "{w5} at the {w4} dot {end|of|in|and|to}", "{look|met|stop|point|looked} at {a|the|this|that|noon|home|once} dot {end|of|in|and|is}",
    ],
}
HINTS = {
    "number": ["call ", "phone: ", "card ", "tel. ", "mobile ", "visa "],
    "address": ["mail ", "contact: "],
    "secret": ['token = "', "key: ", 'secret="', "password ", "Bearer "],
    "hexgroups": ["ip ", "host ", "address "],
    "account": ["account ", "IBAN: ", "Konto "],
    "spelled": ["mail ", "write to "],
}
PLAIN = ["no. ", "page ", "on ", "id ", "since ", "part "]
BEHIND = ['" the', " and so", ", it", ". It", "\nnew"]


def _matches(text: Column, kind: str) -> Column:
    """The matches of a pattern with the length of the text before each (from the last match) and its context."""
    found = let(
        F.split(text, PATTERNS[kind], -1),
        lambda gaps: F.transform(
            F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0),
            lambda said, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("i"),
                F.length(F.get(gaps, i)).alias("gap"),
                said.alias("said"),
                F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after"),
            ),
        ),
    )
    none = F.array().cast(
        "array<struct<kind:string,i:int,gap:int,said:string,before:string,after:string>>"
    )
    gate = TRIGGERS[kind](text) if kind in TRIGGERS else text.rlike("[0-9]")
    return F.when(gate, found).otherwise(none)


def _luhn(digits: Column) -> Column:
    values = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    doubled = F.transform(
        values,
        lambda d, i: let(
            d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda x: (F.when(x > 9, x - 9).otherwise(x)).cast("bigint")
        ),
    )
    return total(doubled) % 10 == 0


def _valid(kind: Column, said: Column) -> Column:
    digits = F.regexp_replace(said, "[^0-9]", "")
    parts = F.split(said, r"\.", -1)
    small = F.forall(
        parts,
        lambda p: let(
            F.regexp_replace(p, "^0+(?=[0-9])", ""),
            lambda n: F.when(F.length(n) <= 3, n.cast("int") <= 255).otherwise(F.lit(False)),
        ),
    )
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(False))
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """A 96-bit key of a row's id and text: equal rows have equal spans, so they may share one."""
    parts = [quoted(id_col).cast("string"), F.coalesce(quoted(text_col).cast("string"), F.lit(""))]
    return F.xxhash64(*parts), F.hash(*parts)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: (k1, k2, doc_id, found), the matches of all patterns."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    k1, k2 = _keyed(docs, id_col, text_col)
    return docs.select(
        k1.alias("k1"), k2.alias("k2"), quoted(id_col).cast("bigint").alias("doc_id"), text.alias("text")
    ).select("k1", "k2", "doc_id", F.concat(*[_matches(F.col("text"), k) for k in KINDS]).alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """(k1, k2, kind, start, end, valid, said, before, after) of every candidate of distinct rows."""
    some = found.filter(F.size("found") > 0).select("k1", "k2", "found").dropDuplicates(["k1", "k2"])
    each = some.select("k1", "k2", F.explode("found").alias("m")).select("k1", "k2", "m.*")
    order = Window.partitionBy("k1", "k2", "kind").orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("said")).over(upto).cast("int")
    return each.withColumn("end", end).select(
        "k1",
        "k2",
        "kind",
        (F.col("end") - F.length("said")).alias("start"),
        "end",
        _valid(F.col("kind"), F.col("said")).alias("valid"),
        "said",
        "before",
        "after",
    )


def features() -> dict[str, Column]:
    """Format and context of a candidate."""
    return {
        "length": F.length("said"),
        "digits": F.regexp_count("said", F.lit("[0-9]")),
        "letters": F.regexp_count("said", F.lit(r"\p{L}")),
        "groups": F.regexp_count("said", F.lit("[0-9]+")),
        "longest": F.array_max(F.transform(F.split("said", "[^0-9]+", -1), lambda x: F.length(x))),
        "first_group": F.length(F.regexp_extract("said", "^[^0-9]*([0-9]+)", 1)),
        "spaces": F.regexp_count("said", F.lit(" ")),
        "dashes": F.regexp_count("said", F.lit("-")),
        "dots": F.regexp_count("said", F.lit(r"\.")),
        "parens": F.regexp_count("said", F.lit("[()]")),
        "slashes": F.regexp_count("said", F.lit("/")),
        "colons": F.regexp_count("said", F.lit(":")),
        "hex": F.regexp_count("said", F.lit("[0-9a-fA-F]")),
        "capitals": F.regexp_count("said", F.lit("[A-Z]")),
        "marks": F.regexp_count("said", F.lit("[_=/+-]")),
        "turns": F.regexp_count("said", F.lit("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")),
        "distinct": F.size(F.array_distinct(F.split("said", ""))),
        "longest_word": F.array_max(F.transform(F.split("said", "[^A-Za-z]+", -1), lambda x: F.length(x))),
        "two_digit_groups": F.regexp_count("said", F.lit("(?<![0-9A-Fa-f])[0-9A-Fa-f]{2}(?![0-9A-Fa-f])")),
        "common_words": F.regexp_count("said", F.lit(r"(?i)\b(the|a|an|of|to|and|in|is|it|that|this|noon|once|home)\b")),
        "bracketed": F.regexp_count("said", F.lit(r"[\[({](at|dot)[\])}]")),
        **{f"is_{k}": (F.col("kind") == k).cast("int") for k in LOOSE},
        "tail_dot": F.col("said").rlike(r"@[^@\s]*\.[A-Za-z0-9-]+").cast("int"),
        "paren_before": F.col("before").rlike(r"\($").cast("int"),
        "joined_before": F.col("before").rlike(r"[\p{L}\p{N}._/-]$").cast("int"),
        "joined_after": F.col("after").rlike(r"^[\p{L}\p{N}_/-]").cast("int"),
        "line_start": F.col("before").rlike(r"(^|\n)\s*$").cast("int"),
    } | {name: F.col("before").rlike(pattern).cast("int") for name, pattern in CONTEXT.items()}


@dataclass
class Scorer:
    model: PipelineModel
    thresholds: dict[str, float]  # kinds without one are never selected

    def selected(self, rows: DataFrame) -> DataFrame:
        scored = self.model.transform(rows.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in features().items()]))
        least = F.lit(2.0)
        for kind, t in self.thresholds.items():
            least = F.when(F.col("kind") == kind, F.lit(t)).otherwise(least)
        return scored.withColumn("score", vector_to_array("probability")[1]).filter(F.col("score") >= least)


def examples(spark: SparkSession, each: int = EXAMPLES, seed: int = 11) -> DataFrame:
    """(kind, said, before, after, label): ``each`` generated examples of every form and of what looks like it.

    A fixed table, made on the driver from a seed: it does not depend on any input.
    """
    rng = random.Random(seed)

    def of(alphabet: str, n: int) -> str:
        return "".join(rng.choices(alphabet, k=n))

    def fill(form: str) -> str:
        """``dN``, ``hN``, ``wN``, ``WN``, ``mN`` in braces: N digits, hexadecimal digits, letters, capitals, any of
        them; other words in braces, divided by bars: one of them."""

        def one(match: re.Match) -> str:
            said = match.group(1)
            if re.fullmatch(r"[dhwWm][0-9]+", said):
                return of(ALPHABETS[said[0]], int(said[1:]))
            word = rng.choice(said.split("|"))
            return one(re.fullmatch("(.*)", word)) if re.fullmatch(r"[dhwWm][0-9]+", word) else word

        return re.sub(r"\{([^}]*)\}", one, form)

    rows = []
    for label, forms in ((1, LIKELY), (0, UNLIKELY)):
        for kind, own in forms.items():
            for form in own:
                named = form.startswith("!")  # personal data only behind a word for it
                for _ in range(each):
                    before = of(ALPHABETS["w"], rng.randint(2, 7))
                    before += " " + of(ALPHABETS["w"], rng.randint(3, 8)) + rng.choice([" ", ", ", ". ", " ("])
                    if named or rng.random() < 0.5:
                        before += rng.choice(HINTS[kind] if label else PLAIN)
                    rows.append((kind, fill(form.lstrip("!")), before[-BEFORE:], rng.choice(BEHIND), label))
    return spark.createDataFrame(rows, "kind string, said string, before string, after string, label int")


def corrupted(every: DataFrame, max_rows: int = CORRUPTED_ROWS) -> DataFrame:
    """Strict spans in their context, changed so that no strict pattern finds them: still personal data."""
    changed = {
        "email": [("spelled", F.replace(F.replace("said", F.lit("@"), F.lit(" at ")), F.lit("."), F.lit(" dot ")))],
        "phone": [("number", F.substring(F.regexp_replace("said", r"^\+", ""), 1, 40))],
    }
    parts = []
    for strict, own in changed.items():
        for kind, said in own:
            rows = every.filter(F.col("valid") & (F.col("kind") == strict))
            rows = rows.orderBy(F.xxhash64("k1", "start"), "start").limit(max_rows)
            parts.append(rows.select(F.lit(kind).alias("kind"), said.alias("said"), "before", "after", F.lit(1).alias("label")))
    return reduce(DataFrame.unionByName, parts)


def _overlaps_base(rows: DataFrame) -> DataFrame:
    """Loose candidates with ``label`` 1 where they overlap a valid base span of their row.

    In order of start, a span overlaps an earlier one if the greatest end so far lies behind its start, and a later one
    if the least start from there on lies before its end.
    """
    line = Window.partitionBy("k1", "k2").orderBy("start", "end")
    base_end, base_start = (F.when(F.col("valid"), F.col(c)) for c in ("end", "start"))
    marked = rows.withColumn("far", F.max(base_end).over(line.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "near", F.min(base_start).over(line.rowsBetween(1, Window.unboundedFollowing))
    )
    hit = F.coalesce(F.col("far") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("near") < F.col("end"), F.lit(False)
    )
    return marked.filter(F.col("kind").isin(*LOOSE)).withColumn("label", hit.cast("int"))


def fit(every: DataFrame) -> Scorer:
    """The trees and the thresholds, from generated examples and corrupted strict spans of ``every``."""
    known = examples(every.sparkSession).unionByName(corrupted(every))
    rows = known.select(
        "kind",
        "label",
        (F.pmod(F.xxhash64("said", "before"), F.lit(4)) == 0).alias("out"),
        *[c.cast("double").alias(f"f_{n}") for n, c in features().items()],
    )
    rows = stage(rows, "candidates").coalesce(4)
    assembler = VectorAssembler(inputCols=[f"f_{n}" for n in features()], outputCol="features")
    trees = GBTClassifier(labelCol="label", maxIter=10, maxDepth=4, stepSize=0.3, seed=5, cacheNodeIds=False)
    model = PipelineModel([assembler, trees.fit(assembler.transform(rows.filter(~F.col("out"))))])
    scored = model.transform(rows.filter("out")).select("kind", "label", F.round(vector_to_array("probability")[1], 2).alias("p"))
    bins = scored.groupBy("kind", "p").agg(F.count("*").alias("n"), F.sum("label").alias("right")).collect()  # 101 a kind
    thresholds = {}
    for kind in LOOSE:
        n = right = 0
        own = sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["p"])
        for r, below in zip(own, [*(r["p"] for r in own[1:]), 0.0]):
            n, right = n + r["n"], right + r["right"]
            if right >= PRECISION * n and r["p"] >= 0.5:
                thresholds[kind] = max((r["p"] + below) / 2, 0.5)
    return Scorer(model, thresholds)


def _added(loose: DataFrame, scorer: Scorer) -> DataFrame:
    """The selected candidates without base overlap, by score those that overlap none taken before."""
    free = loose.filter("label = 0")
    chosen = scorer.selected(free).select("k1", "k2", "kind", "start", "end", "score")
    line = Window.partitionBy("k1", "k2").orderBy("start", "end", "kind")
    # only spans of one cluster can overlap
    before = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.coalesce(before, F.lit(-1)) > F.col("start"), 0).otherwise(1)
    cluster = chosen.withColumn("new", new).withColumn("cluster", F.sum("new").over(line))
    span = F.struct((-F.col("score")).alias("order"), "start", "kind", "end")
    ranked = cluster.groupBy("k1", "k2", "cluster").agg(F.sort_array(F.collect_list(span)).alias("ranked"))
    taken = F.aggregate(
        "ranked",
        F.slice("ranked", 1, 1),
        lambda kept, s: F.when(
            F.exists(kept, lambda k: (k["start"] < s["end"]) & (k["end"] > s["start"])), kept
        ).otherwise(F.concat(kept, F.array(s))),
    )
    return ranked.select("k1", "k2", F.explode(taken).alias("s")).select("k1", "k2", "s.kind", "s.start", "s.end")


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


@dataclass
class Found:
    rows: DataFrame  # (k1, k2, doc_id) of every row of the table
    spans: DataFrame  # (k1, k2, kind, start, end, base)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Found:
    """Base and added spans of every row."""
    found = stage(candidates(docs, id_col, text_col), "matches")
    every = stage(spans(found), "spans")
    loose = stage(_overlaps_base(every.filter(F.col("valid") | F.col("kind").isin(*LOOSE))), "loose")
    added = _added(loose, fit(every)).withColumn("base", F.lit(False))
    base = every.filter("valid").select("k1", "k2", "kind", "start", "end", F.lit(True).alias("base"))
    return Found(found.select("k1", "k2", "doc_id"), base.unionByName(added))


def report(found: Found) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    item = F.struct("start", _rank(F.col("kind")).alias("rank"), "kind", "end", "base")
    per_row = found.spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(item)).alias("all"))

    def text(items: Column) -> Column:
        return F.array_join(
            F.transform(
                items,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    listed = found.rows.join(per_row, ["k1", "k2"], "left").withColumn(
        "all",
        F.coalesce("all", F.array().cast("array<struct<start:int,rank:bigint,kind:string,end:int,base:boolean>>")),
    )
    base = F.filter("all", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")

    return listed.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in BASE],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("all")).alias("spans"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span's text replaced by its kind in brackets; all other columns as they were.

    Where spans overlap, the first one's mark stands and a later one marks only what lies behind it.
    """
    found = find(docs, id_col, text_col)
    line = Window.partitionBy("k1", "k2").orderBy("start", F.desc("base"), _rank(F.col("kind")))
    before = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    cuts = (
        found.spans.withColumn("start", F.greatest("start", F.coalesce(before, F.lit(0))))
        .filter("start < end")
        .groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    )
    c1, c2, m1, m2, listed = fresh(docs, "__c1", "__c2", "__m1", "__m2", "__cuts")
    cuts = cuts.withColumnsRenamed({"k1": c1, "k2": c2, "cuts": listed})
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    k1, k2 = _keyed(docs, id_col, text_col)
    joined = docs.select("*", k1.alias(m1), k2.alias(m2)).join(
        cuts, (F.col(m1) == F.col(c1)) & (F.col(m2) == F.col(c2)), "left"
    )
    kept = F.transform(
        listed,
        lambda c, i: F.concat(
            let(
                F.coalesce(F.get(F.col(listed), i - 1)["end"], F.lit(0)),
                lambda last: F.substring(text, last + 1, c["start"] - last),
            ),
            F.lit("["),
            F.upper(c["kind"]),
            F.lit("]"),
        ),
    )
    tail = let(F.element_at(listed, -1)["end"], lambda last: F.substring(text, last + 1, F.length(text)))
    clean = F.when(F.col(listed).isNull(), quoted(text_col)).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.select(*[clean.alias(c) if c == text_col else quoted(c) for c in docs.columns])
