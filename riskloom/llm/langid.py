"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  One binary classifier per bit, linear in the square roots of a text's byte
n-gram frequencies, predicts the bit; decoding takes the codeword with the least loss, each bit's logistic loss
weighted by how far the bit's accuracy on left-out rows is above chance.  The score is the softmax share of the chosen
codeword; a text is ambiguous if the second one loses by less than ``AMBIGUOUS`` per unit of weight.

The classifiers are fitted on the driver from at most ``per_language`` labelled texts of each language (those of least
key hash) and ``max_rows`` in all: the documented bound.  Prediction uses whole texts in the tasks that read them.

Defined results: a null text and one without letters is ``und`` with score 0; repeated rows are judged each for itself;
with one known language all texts with letters get it; without any all get ``und``; an empty table gives an empty
result; columns other than the key and the text are not read when predicting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm import bytesops

SIZES = (1, 2, 3)
BITS = 12
PER_LANGUAGE = 800
MAX_ROWS = 20_000
AMBIGUOUS = 0.1
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def vectors(texts: list[bytes | None], sizes=SIZES, bits: int = BITS) -> np.ndarray:
    """Square roots of n-gram frequencies, n-grams of one size adding up to the same for every text."""
    out = np.zeros((len(texts), 1 << bits), np.float32)
    for row, grams in zip(out, bytesops.text_ngrams(texts, sizes, bits)):
        for g in grams:
            if len(g):
                row += np.bincount(g, minlength=1 << bits) / np.float32(len(g) * len(sizes))
    return np.sqrt(out, out=out)


def codewords(k: int) -> np.ndarray:
    """A row of +1 and -1 per language: all splits of few languages, otherwise random ones far from each other."""
    if k <= 5:
        bits = [[1 if (b >> i) & 1 else -1 for i in range(k)] for b in range(1, 1 << (k - 1))]
        return np.array(bits or [[1]], float).T
    rng = np.random.default_rng(11)
    best, width = None, 6 * int(np.ceil(np.log2(k))) + 5
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (k, width))
        apart = ((code[:, None] != code[None]).sum(2) + width * np.eye(k, dtype=int)).min()
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        ambiguous = np.zeros(len(texts), bool)
        some = [i for i, t in enumerate(texts) if t and LETTER.search(t.decode())]
        if not some or not self.languages:
            return names, scores, ambiguous
        for lo in range(0, len(some), 256):
            rows = some[lo : lo + 256]
            margins = vectors([texts[i] for i in rows]) @ self.weights + self.bias
            loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
            share = np.exp(loss.min(1, keepdims=True) - loss)
            share /= share.sum(1, keepdims=True)
            order = np.sort(loss, 1)
            for i, k, s, l in zip(rows, loss.argmin(1).tolist(), share.max(1).tolist(), order):
                names[i], scores[i] = self.languages[k], s
                ambiguous[i] = len(l) > 1 and l[1] - l[0] < AMBIGUOUS * self.trust.sum()
        return names, scores, ambiguous


def _fit_bits(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.3, decay: float = 1e-5) -> tuple:
    """Logistic classifiers of all bits at once, by full-batch gradient steps with adaptive rates."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        pull = -y / (1 + np.exp(np.clip((x @ w + b) * y, -30, 30))) / len(x)
        gradient = (x.T @ pull + decay * w).astype(np.float32)
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        w -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        b -= (rate * pull.sum(0)).astype(np.float32)
    return w, b


def training_rows(docs: DataFrame, chosen: Column, per_language: int, max_rows: int) -> list[tuple]:
    """(text, language) of the bounded sample; only keys and languages travel until it is known.

    Of each language only keys of small hash are ranked, about twice as many as are taken, so no task gets a language
    as a whole.  Of several texts of one key and language the least counts.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    known = texts.filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").isNotNull() & chosen
    ).select("doc_id", "lang", F.xxhash64("doc_id").alias("hash"))
    rows_of = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    share = F.col("hash") / 2.0**64 + 0.5
    few = known.join(rows_of, "lang").filter(share * F.col("rows") <= 2 * per_language + 100).select("doc_id", "lang", "hash")
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    ranked = few.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    taken = ranked.orderBy("n", "lang").limit(max_rows).select("doc_id", "lang")
    # at most max_rows keys: small whatever the input
    rows = texts.join(F.broadcast(taken), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    table = rows.select("doc_id", "lang", "text").toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    return list(zip(bytesops.texts_of(table.column("text").combine_chunks()), table.column("lang").to_pylist()))


def fit(rows: list[tuple]) -> Model:
    rows = [r for r in rows if LETTER.search(r[0].decode())]
    languages = sorted({lang for _, lang in rows})
    code = codewords(max(len(languages), 1))
    if not languages:
        return Model([], code, np.zeros((1 << BITS, 1), np.float32), np.zeros(1, np.float32), np.ones(1))
    x = np.concatenate([vectors([t for t, _ in rows[i : i + 256]]) for i in range(0, len(rows), 256)])
    y = code[[languages.index(lang) for _, lang in rows]].astype(np.float32)
    out = np.arange(len(rows)) % 5 == 4
    if out.any():
        w, b = _fit_bits(x[~out], y[~out])
        right = ((x[out] @ w + b) * y[out] > 0).mean(0)
    else:
        right = np.ones(code.shape[1])
    w, b = _fit_bits(x, y)
    return Model(languages, code, w, b, np.maximum(2 * right - 1, 0.01))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row; the model's size is bounded by its languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in bytesops.blocks(batch, "text"):
                names, scores, ambiguous = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(ambiguous),
                    ],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")
