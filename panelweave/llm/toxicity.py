"""Toxicity by class-conditional Kneser-Ney models of spelling with shared backoff counts."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import fold, written

ORDER = 6
DISCOUNT = 0.75
SHARED_START = 1  # a word's first letters come from one distribution: they tell the language, not the tone
PAD, END = "\x02", "\x03"
LETTERS = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 400_000


class KneserNey:
    """log P(word | toxic) - log P(word | ordinary), letter by letter.

    The longest context has counts of its own in each class; every shorter one is a single Kneser-Ney
    distribution of continuation counts over both classes, so an expression that is rare in both is
    judged alike and only what a class has really seen tells them apart.
    """

    def __init__(self, grams: list[tuple[str, int, int]]):
        self.known: dict[str, float] = {}  # evidence of sequences met before, a cache
        self.seen: dict[str, tuple[int, int]] = {}
        self.context: dict[str, list[int]] = {}
        pooled = set()
        for gram, toxic, ordinary in grams:
            self.seen[gram] = (toxic, ordinary)
            c = self.context.setdefault(gram[:-1], [0, 0, 0, 0])  # tokens and types of each class
            for k, n in enumerate((toxic, ordinary)):
                c[k] += n
                c[2 + k] += n > 0
            pooled.add(gram)
        self.shared: list[tuple[dict[str, int], dict[str, list[int]]]] = []
        longer = pooled
        for _ in range(ORDER - 1):  # continuation counts of length ORDER - 1 down to 1
            left: dict[str, int] = {}
            for gram in longer:
                left[gram[1:]] = left.get(gram[1:], 0) + 1
            totals: dict[str, list[int]] = {}
            for gram, n in left.items():
                t = totals.setdefault(gram[:-1], [0, 0])
                t[0] += n
                t[1] += 1
            self.shared.append((left, totals))
            longer = set(left)
        self.letters = len(self.shared[-1][0]) + 1 if grams else 1

    def backoff(self, gram: str) -> float:
        p = 1.0 / self.letters
        for left, totals in reversed(self.shared):
            k = len(next(iter(left), gram))
            part = gram[-k:]
            if total := totals.get(part[:-1]):
                p = (max(left.get(part, 0) - DISCOUNT, 0) + DISCOUNT * total[1] * p) / total[0]
        return p

    def evidence(self, gram: str) -> float:
        """log P(last letter | the others, toxic) - log P(... | ordinary); nothing where neither class has the context."""
        c = self.context.get(gram[:-1])
        if c is None:
            return 0.0
        shared, logs = self.backoff(gram), []
        for cls, n in enumerate(self.seen.get(gram, (0, 0))):
            logs.append(math.log((max(n - DISCOUNT, 0) + DISCOUNT * c[2 + cls] * shared) / c[cls]) if c[cls] else math.log(shared))
        return logs[0] - logs[1]

    def ratio(self, word: str) -> tuple[float, int]:
        """The word's log-likelihood ratio, and its letters with the end."""
        padded, total, known = PAD * (ORDER - 1) + word + END, 0.0, self.known
        for k in range(SHARED_START, len(word) + 1):
            gram = padded[k : k + ORDER]
            if (found := known.get(gram)) is None:
                found = known[gram] = self.evidence(gram)
            total += found
        return total, len(word) + 1


class Scorer:
    """Length-normalised log-likelihood differences of texts, word by word through a cache."""

    def __init__(self, state: dict):
        self.model = KneserNey([])
        self.model.__dict__ = state  # caches stay with a worker's copy of the model, from task to task
        self.known = state.setdefault("words", {})

    def word(self, raw: str) -> tuple[float, int]:
        if (found := self.known.get(raw)) is None:
            parts = [self.model.ratio(w) for w in LETTERS.findall(raw)]
            found = self.known[raw] = (sum(p[0] for p in parts), sum(p[1] for p in parts))
        return found

    def difference(self, text: str | None) -> tuple[float, int]:
        """(difference of the log-likelihoods per letter, letters); (0, 0) without letters."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        if len(self.model.known) > 2 * CACHE_WORDS:
            self.model.known.clear()
        pairs = list(map(self.word, (text or "").lower().split()))
        letters = sum(p[1] for p in pairs)
        return (math.fsum(p[0] for p in pairs) / letters, letters) if letters else (0.0, 0)


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression of y on the rows of x, classes weighted alike, by Newton's method."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return w
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-2 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def inputs(difference: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What the calibration sees: the normalised difference, alone and as sure as the text is long."""
    return np.stack([np.ones(len(difference)), 10 * difference, difference * np.sqrt(letters)], 1)


def training_rows(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, rows: dict[int, int]) -> DataFrame:
    """(doc_id, text, toxic, part) of about rows[label] documents of each label at most, chosen by hash of the id.

    Only ids with one agreed label outside the held-out fold take part. part is 1 for the fifth of
    them that calibrates the score and 0 for those that are counted.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("low")).where("toxic = low").drop("low")
    sizes = dict(known.groupBy("toxic").agg(F.count("*").alias("n")).collect())  # two rows
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for toxic, n in sizes.items():
        share = F.when(F.col("toxic") == toxic, F.lit(min(1.0, rows.get(toxic, 0) / n))).otherwise(share)
    chosen = known.where(place < share).withColumn("part", (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(5)) == 0).cast("int"))
    chosen = written(chosen, "toxic-sample")  # bounded by `rows`: small enough for Spark to broadcast by its size
    return written(docs.select("doc_id", "text").join(chosen, "doc_id"), "toxic-texts")


def gram_counts(sample: DataFrame) -> list[tuple[str, int, int]]:
    """(letters, toxic, ordinary): counts of each longest sequence of letters, added up on Spark.

    What comes to the driver is bounded by the sample and pools whatever it repeats.
    """
    words = sample.select("toxic", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("w"))
    words = words.groupBy("w").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("o"))
    padded = F.concat(F.lit(PAD * (ORDER - 1)), F.col("w"), F.lit(END))
    grams = words.select(padded.alias("p"), "t", "o", F.explode(F.sequence(F.lit(1), F.char_length("w") + 1)).alias("k"))
    grams = grams.groupBy(F.substring("p", F.col("k"), F.lit(ORDER)).alias("gram")).agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    table = grams.toArrow()
    return list(zip(*(table.column(c).to_pylist() for c in ("gram", "t", "o")), strict=True))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, toxic_rows: int = 3000, ordinary_rows: int = 9000, threshold: float = 0.7) -> DataFrame:
    """Per document its fold, a score from 0 to 1 and the prediction.

    The models are fitted on at most about toxic_rows and ordinary_rows labelled documents
    outside the held-out fold; all documents are scored whole, from their text alone. Null and empty texts and
    texts without letters get the score of no difference; without labels of both classes every score
    is 0.5. Rows are scored one by one, so repeated rows and hot sources change nothing.
    """
    spark = docs.sparkSession
    sample = training_rows(docs, labels, folds, held_out, {1: toxic_rows, 0: ordinary_rows})
    model = KneserNey(gram_counts(sample.where("part = 0")))
    shared = spark.sparkContext.broadcast(vars(model))  # bounded by `rows` labelled documents

    def differences(texts: list[str | None], scorer: Scorer) -> tuple[np.ndarray, np.ndarray]:
        found = [scorer.difference(t) for t in texts]
        return np.array([f[0] for f in found]), np.array([float(f[1]) for f in found])

    def calibration(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            d, n = differences(batch.column("text").to_pylist(), scorer)
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(d), pa.array(n)], ["toxic", "d", "n"])

    fitted = sample.where("part = 1").select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(calibration, "toxic int, d double, n double").toPandas()
    weights = calibrate(inputs(fitted["d"].to_numpy(), fitted["n"].to_numpy()), fitted["toxic"].to_numpy())

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            d, n = differences(batch.column("text").to_pylist(), scorer)
            score = 1 / (1 + np.exp(-np.clip(inputs(d, n) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
