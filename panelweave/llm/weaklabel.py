"""Quality classifier from weak labels: overlapping heuristics, their accuracies by EM, a hashed linear scorer."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import small, without_rows, written

SHAPES = 1 << 12  # hashed features of word shapes, after the plain ones
LEXICAL = 1 << 13  # hashed features of words and word pairs, after those
PLAIN = 6  # features that are not hashed
WIDTH = SHAPES + LEXICAL
CACHE_WORDS = 300_000
ROWS = 256  # texts whose features are in memory at a time
SYMBOLS = frozenset("#*$%&|<>{}[]\\^~=_")
ABSTAIN, BAD, GOOD = 0, 1, 2

# Heuristic labellers: measure, bad from, good up to (None: never votes good); else they abstain. Fixed values.
LABELLERS = {
    "symbols": ("symbols per word", 0.30, None),
    "marked": ("share of words that end in symbols", 0.20, None),
    "capitals": ("share of words in capitals", 0.30, None),
    "shouts": ("share of words with two exclamation marks", 0.10, None),
    "stutter": ("share of words equal to the word before", 0.15, None),
    "variety": ("one less distinct words by expected distinct words", 0.60, None),
    "tables": ("pipes per word", 0.15, None),
    "copies": ("share of lines equal to an earlier line", 0.60, None),
    "lengths": ("how far the mean word length is from 3 to 11 letters", 2.0, None),
    "plain": ("share of words that are not letters with one mark after them at most", 0.40, None),
    "pairs": ("one less distinct word pairs by word pairs", 0.50, None),
    "prose": ("the largest of the measures by what prose shows of them at most", np.inf, 1.0),
}


# What ordinary prose shows of each measure at most, in their order.
PROSE = np.array([0.05, 0.02, 0.08, 0.005, 0.05, 0.30, 0.02, 0.10, 0.01, 0.10, 0.20])


class WordFacts(dict):
    """What is known of a word: (shape, word, capitals, symbols, ends in symbols, shouts, pipes, odd); kept for words met before."""

    def __missing__(self, word: str) -> tuple:
        lower = zlib.crc32(word.lower().encode())
        mark = word[-1] if word[-1] in ".," else ""
        body = word[:-1] if mark else word
        if body.isalpha() and body[1:].islower() and (body[0].islower() or body[0].isupper()):  # most words: what is below, sooner
            found = (self.feature(("Aa" if body[0].isupper() else "a") + mark), lower, 0, 0, 0, 0, 0, 0)
        else:
            letters = [c for c in word if c.isalpha()]
            found = (
                self.feature("".join(dict.fromkeys("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))),
                lower,
                len(letters) > 1 and word.isupper(),
                sum(c in SYMBOLS for c in word),
                len(word) > 1 and word[-1] in SYMBOLS,
                "!!" in word,
                word.count("|"),
                not (word.isalpha() or word[:-1].isalpha()),
            )
        self[word] = found
        return found

    @staticmethod
    def feature(shape: str) -> int:
        return zlib.crc32(shape.encode()) % (SHAPES - PLAIN) + PLAIN


def measures(text: str, facts: WordFacts) -> tuple[np.ndarray, list[float], list[int], list[int]]:
    """(the labellers' measures, plain features, hashed features, their counts) of a text.

    Hashed are the shapes of its words, the words in small letters and each two words in a row.
    """
    if len(facts) > CACHE_WORDS:
        facts.clear()
    words = text.split()
    n = len(words)
    if not n:
        return np.full(len(LABELLERS), np.nan), [1.0] + [0.0] * (PLAIN - 1), [], []
    place = {w: k for k, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(place.__getitem__, words), np.int64, n)
    table = np.array([facts[w] for w in place], np.int64)
    shape, word, times = table[at, 0], table[at, 1], np.bincount(at)
    same = float((at[1:] == at[:-1]).sum()) / n
    pairs = 1 - len(np.unique(at[:-1] * n + at[1:])) / (n - 1) if n > 1 else 0.0
    variety = 1 - min(1.0, len(place) / min(n, 30 + 0.45 * n))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    copies = 1 - len(set(lines)) / max(len(lines), 1) if len(lines) > 3 else 0.0
    mean = sum(map(len, words)) / n
    capitals, symbols, marked, shouts, pipes, odd = (times @ table[:, 2:] / n).tolist()
    each = np.array([symbols, marked, capitals, shouts, same, variety, pipes, copies, max(3 - mean, mean - 11, 0.0), odd, pairs])
    found = np.append(each, (each / PROSE).max())
    sure = n / (n + 10)  # a few words say little
    plain = [1.0, *(sure * x for x in (same, variety, copies, min(mean / 20, 1.0), pairs))]
    both = word[:-1] * 2_654_435_761 + word[1:]  # wraps around, as hashes may
    counts = np.bincount(np.concatenate([shape, SHAPES + word % LEXICAL, SHAPES + (both >> 13) % LEXICAL]), minlength=WIDTH)
    columns = np.flatnonzero(counts)
    return found, plain, columns.tolist(), counts[columns].tolist()


def votes(found: np.ndarray) -> int:
    """The labellers' votes as one number in base 3; a text without words gets none."""
    code = 0
    for value, (_, bad, good) in zip(found, LABELLERS.values(), strict=True):
        code = 3 * code + (ABSTAIN if np.isnan(value) else BAD if value >= bad else GOOD if good is not None and value <= good else ABSTAIN)
    return code


def digits(codes: np.ndarray) -> np.ndarray:
    """Votes of each labeller, from their numbers."""
    k = len(LABELLERS)
    return codes[:, None] // 3 ** np.arange(k - 1, -1, -1) % 3


def fit_labellers(codes: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, each labeller's accuracy, P(good | pattern)) by expectation-maximisation.

    Runs on the counts of vote patterns, 3^labellers at most however many documents there are. An
    abstention is no evidence. It starts from the majority of votes; a labeller is taken to be better
    than chance and never perfect, so overlapping ones outvote each other by what they have earned. At
    least half of a corpus is taken to be good: without a bad vote nothing is likelier bad.
    """
    vote = digits(codes)
    sign = np.where(vote == GOOD, 1, np.where(vote == BAD, -1, 0))
    good = 1 / (1 + np.exp(-2.0 * sign.sum(1)))
    prior, accuracy = 0.5, np.full(vote.shape[1], 0.8)
    for _ in range(rounds):
        prior = np.clip((n @ good + 1) / (n.sum() + 2), 0.5, 0.95)
        right = n[:, None] * np.where(sign > 0, good[:, None], np.where(sign < 0, 1 - good[:, None], 0))
        accuracy = np.clip((right.sum(0) + 8) / ((n[:, None] * (sign != 0)).sum(0) + 10), 0.6, 0.995)
        new = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + sign @ np.log(accuracy / (1 - accuracy)))))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return float(prior), accuracy, good


def slices(batches):
    """The rows in smaller batches: the features of a few hundred texts are in memory at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def spread(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of all features: plain ones as they are, hashed ones as shares, surer with more words."""
    if isinstance(rows, pa.Table):
        rows = rows.combine_chunks()
    plain, columns, counts = (rows.column(c) for c in ("plain", "columns", "counts"))
    n = rows.num_rows
    row = np.repeat(np.arange(n), pa.compute.list_value_length(columns).to_numpy())
    count = pa.compute.list_flatten(counts).to_numpy().astype(float)
    words = np.bincount(row, count, n) / 3  # a shape, a word and a pair for each
    column = np.concatenate([np.tile(np.arange(PLAIN), n), pa.compute.list_flatten(columns).to_numpy()])
    value = np.concatenate([pa.compute.list_flatten(plain).to_numpy(), count / (words + 10)[row]])
    return np.concatenate([np.repeat(np.arange(n), PLAIN), row]), column, value


def fit_linear(features: tuple[np.ndarray, np.ndarray, np.ndarray], target: np.ndarray, rounds: int = 150, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression of the posterior labels on hashed features, classes weighted alike, by accelerated gradient steps."""
    w, n = np.zeros(WIDTH), len(target)
    if not n:
        return w
    row, column, value = features
    share = np.clip([1 - target.mean(), target.mean()], 0.02, 1)
    weight = (target / share[1] + (1 - target) / share[0]) / (2 * n)
    ahead, last = w.copy(), w
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * ahead[column], n), -30, 30)))
        w = ahead - rate * (np.bincount(column, value * (weight * (p - target))[row], WIDTH) + decay * ahead)
        ahead = w + (k - 1) / (k + 2) * (w - last)
        last = w
    return w


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 10_000, threshold: float = 0.3) -> DataFrame:
    """Per document: its text hash, the weak label's posterior, the scorer's probability of good, and `kept`.

    Every document's votes count towards the labellers' accuracies; the linear scorer is fitted on about
    fit_rows documents at most, chosen by hash of id and text, half of them likely bad where there are
    as many, on shapes of words, words and pairs of words. A text without words has no votes: posterior
    and score are the scorer's for an empty text and it is rejected. Very long texts are read whole; what
    is stored of one is its counts per feature. Ids may be null or repeated; each row is scored by itself.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    names = ["code", "empty", "plain", "columns", "counts"]

    def packed(parts: list, kind) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, kind), *parts]).astype(kind)))

    def look(batches):
        facts = WordFacts()
        for part in slices(batches):
            out = []
            for text in part.column(text_col).to_pylist():
                found, *features = measures(text or "", facts)
                out.append((votes(found), bool(np.isnan(found[0])), *features))
            code, empty, *features = zip(*out, strict=True)
            arrays = [pa.array(code, pa.int32()), pa.array(empty), *map(packed, features, (np.float32, np.int16, np.int32))]
            yield pa.RecordBatch.from_arrays([part.column(id_col), part.column("text_hash"), *arrays], [id_col, "text_hash", *names])

    rows = docs.select(id_col, F.xxhash64(text_col).alias("text_hash"), text_col)
    rows = written(rows.mapInArrow(look, f"`{id_col}` {kind}, text_hash long, code int, empty boolean, plain array<float>, columns array<short>, counts array<int>"), "votes")
    patterns = rows.where("NOT empty").groupBy("code").agg(F.count("*").alias("n")).collect()  # 3^labellers at most
    codes, n = np.array([r["code"] for r in patterns], np.int64), np.array([r["n"] for r in patterns], float)
    good = fit_labellers(codes, n)[2] if len(codes) else np.zeros(0)
    posterior = dict(zip(codes.tolist(), good.tolist(), strict=True))

    expected = {c: max(sum(k for k, g in zip(n, good, strict=True) if (g >= 0.5) == c), 1.0) for c in (False, True)}
    place = F.pmod(F.xxhash64(id_col, "text_hash"), F.lit(1 << 40)) / float(1 << 40)
    likely = F.col("code").isin([c for c, g in posterior.items() if g >= 0.5])
    share = F.when(likely, F.lit(min(1.0, fit_rows / 2 / expected[True]))).otherwise(F.lit(min(1.0, fit_rows / 2 / expected[False])))
    sample = rows.where(~F.col("empty") & (place < share)).select("code", *names[2:]).toArrow()  # bounded by fit_rows
    target = np.array([posterior[c] for c in sample.column("code").to_pylist()])
    weights = fit_linear(spread(sample), target)
    shared = spark.sparkContext.broadcast((weights, posterior))  # a few thousand numbers

    def score(batches):
        w, known = shared.value
        for batch in slices(batches):
            row, column, value = spread(batch)
            total = np.bincount(row, value * w[column], batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            empty = batch.column("empty").to_numpy(zero_copy_only=False)
            weak = [known.get(c) for c in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("text_hash"), pa.array(weak, pa.float64()), pa.array(p), pa.array((p >= threshold) & ~empty)], [id_col, "text_hash", "posterior", "score", "kept"])

    return rows.mapInArrow(score, f"`{id_col}` {kind}, text_hash long, posterior double, score double, kept boolean")


def without_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 10_000, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier keeps, all columns as they were."""
    found = quality_scores(docs, id_col, text_col, fit_rows, threshold).where("NOT kept").select(F.col(id_col).alias("_id"), "text_hash").distinct()
    rejected = small(written(found, "rejected"))
    return without_rows(docs, rejected, id_col, text_col)
