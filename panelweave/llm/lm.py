"""Language-model scores by deleted interpolation of n-gram estimates counted over the whole corpus.

Every training token is counted; nothing about the corpus is broadcast or collected but its totals and
a bounded histogram. Documents are coded in shards; a shard asks for the counts of its distinct words
and word pairs in packed blobs dealt over buckets of the hash space, and gets packed answers back. Where
there are more buckets than a shard should write to, blobs go there in hops: each hop cuts keys into a
bounded number of ranges and merges a bounded number of askers of one range into one. So the number of
blobs is in proportion to the number of shards, however many buckets there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import written

SHARD_TOKENS = 1 << 20  # tokens coded together: bounds the memory of a task
BUCKET_TOKENS = 1 << 22  # corpus tokens for each bucket of the hash space: bounds the memory of a count
FAN = 256  # ranges that a hop cuts keys into at most, and askers that it merges on average
SEED = 17
START = np.uint64(0x9E3779B97F4A7C15)  # stands for the place before the first word
FINE = 8  # bins for a factor of ten in the histogram that the weights are fitted on
FLOOR = 20 * FINE  # the bin of estimates that are zero


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * w)
    import zstandard

    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    import zstandard

    width = blob[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:], max_output_size=0), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel()


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def held_out_fold(value, folds: int) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode()) % folds


# --- coding ---------------------------------------------------------------------------------------

CODED = "shard long, train binary, lengths binary, vocab binary, tokens binary, n long, n_train long"


def coded(docs: DataFrame, id_col: str, text_col: str, folds: int, held_out: int) -> DataFrame:
    """One row per shard: the documents' ids, folds and lengths, distinct word hashes, and words as places in them."""
    import xxhash

    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        digest = xxhash.xxh64_intdigest
        ids, train, lengths, vocab, tokens, held, shard = [], [], [], {}, [], 0, TaskContext.get().partitionId() << 32

        def row():
            words = np.fromiter((digest(w, SEED) for w in vocab), np.uint64, len(vocab))
            fold, length = np.array(train, bool), np.array(lengths, np.uint32)
            blobs = [packed(fold.astype(np.uint8)), packed(length), packed(words), packed(np.concatenate(tokens))]
            totals = [int(length.sum()), int(length[fold].sum())]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(id_type)), pa.array([shard]), *(pa.array([b], pa.binary()) for b in blobs), *(pa.array([n], pa.int64()) for n in totals)],
                ["ids", "shard", "train", "lengths", "vocab", "tokens", "n", "n_train"],
            )

        for batch in batches:
            id_type = batch.schema.field(id_col).type
            for value, text in zip(batch.column(id_col).to_pylist(), batch.column(text_col).to_pylist(), strict=True):
                words = (text or "").encode("utf-8").lower().split()
                words.append(b"")  # the end: no word is empty
                tokens.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in words), np.uint32, len(words)))
                ids.append(value)
                train.append(held_out_fold(value, folds) != held_out)
                lengths.append(len(words))
                held += len(words)
                if held >= SHARD_TOKENS:
                    yield row()
                    ids, train, lengths, vocab, tokens, held, shard = [], [], [], {}, [], 0, shard + 1
        if ids:
            yield row()

    return written(docs.select(id_col, text_col).mapInArrow(run, f"ids array<{kind}>, {CODED}"), "coded")


class Shard:
    """A coded shard with its distinct words and pairs, in a fixed order."""

    def __init__(self, train: bytes, lengths: bytes, vocab: bytes, tokens: bytes):
        self.train, self.lengths = unpacked(train).astype(bool), unpacked(lengths).astype(np.int64)
        self.vocab, self.tokens = unpacked(vocab).astype(np.uint64), unpacked(tokens).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.in_train = np.repeat(self.train, self.lengths)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.first] = len(self.vocab)
        self.before = before
        pair = before * (len(self.vocab) + 1) + self.tokens
        distinct, self.pair_of = np.unique(pair, return_inverse=True)
        histories = np.append(self.vocab, START)
        self.pair_keys = mixed(histories[distinct // (len(self.vocab) + 1)], self.vocab[distinct % (len(self.vocab) + 1)])
        self.word_order = np.argsort(self.vocab, kind="stable")
        self.pair_order = np.argsort(self.pair_keys, kind="stable")

    def asked(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, sorted keys, their counts in the training documents): 0 words, 1 pairs."""
        words = np.bincount(self.tokens[self.in_train], minlength=len(self.vocab))
        pairs = np.bincount(self.pair_of[self.in_train], minlength=len(self.pair_keys))
        yield 0, self.vocab[self.word_order], words[self.word_order]
        yield 1, self.pair_keys[self.pair_order], pairs[self.pair_order]


# --- counting -------------------------------------------------------------------------------------


def bucket_edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of the top bits starts in sorted keys."""
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, starts), len(keys))


def questions(shards: DataFrame, bits: int) -> DataFrame:
    """(bucket, kind, shard, keys, counts): what each shard asks of each bucket, keys as packed differences."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for kind, keys, counts in Shard(row["train"], row["lengths"], row["vocab"], row["tokens"]).asked():
                    edges = bucket_edges(keys, bits)
                    for b in np.flatnonzero(np.diff(edges)):
                        part = slice(edges[b], edges[b + 1])
                        out.append((int(b), kind, row["shard"], packed(np.diff(keys[part], prepend=np.uint64(0))), packed(counts[part])))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "kind", "shard", "keys", "counts"])

    return shards.select("shard", "train", "lengths", "vocab", "tokens").mapInArrow(run, PARTS)


def hops(bits: int) -> list[int]:
    """The bits of each hop: as few hops as FAN allows, as even as they can be."""
    n = max(1, -(-bits // (FAN.bit_length() - 1)))
    return [bits // n + (k < bits % n) for k in range(n)]


PARTS = "bucket long, kind int, shard long, keys binary, counts binary"
ANSWERS = "kind int, bucket long, shard long, counts binary, known long"


def absolute(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob).astype(np.uint64), dtype=np.uint64)


def counted(parts: DataFrame, askers: int, further: list[int], used: int) -> DataFrame:
    """Answers to parts (bucket, kind, shard, keys, counts) whose bucket is the first `used` bits of their keys.

    With further hops to go, the parts of a bucket are merged, some FAN askers at a time, and cut by the
    next bits; the merged ones ask in the same way, and what they learn is dealt back to those they merged.
    """
    if not further:
        return answers(parts)
    bits, groups = further[0], max(1, -(-askers // FAN))
    parts = written(parts, "questions")
    grouped = parts.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)))
    key = ["bucket", "kind", "group"]

    def merge(table: pa.Table) -> pa.Table:
        keys = [absolute(b) for b in table.column("keys").to_pylist()]
        counts = np.concatenate([unpacked(b).astype(np.int64) for b in table.column("counts").to_pylist()])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, counts, len(distinct)).astype(np.int64)
        bucket, kind, group = (table.column(c)[0].as_py() for c in key)
        edges = bucket_edges(distinct << np.uint64(used), bits)
        out = []
        for r in np.flatnonzero(np.diff(edges)):
            part = slice(edges[r], edges[r + 1])
            out.append(((bucket << bits) + int(r), kind, group, packed(np.diff(distinct[part], prepend=np.uint64(0))), packed(total[part])))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["bucket", "kind", "shard", "keys", "counts"])

    asked = grouped.groupBy(*key).applyInArrow(merge, PARTS)
    found = counted(asked, groups, further[1:], used + bits)

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = [absolute(b) for b in left.column("keys").to_pylist()]
        distinct = np.unique(np.concatenate(keys))
        learned = sorted(zip(right.column("low").to_pylist(), right.column("counts").to_pylist(), strict=True))
        total = np.concatenate([unpacked(b).astype(np.int64) for _, b in learned])
        n, bucket, kind = len(keys), left.column("bucket")[0].as_py(), left.column("kind")[0].as_py()
        blobs = [packed(total[np.searchsorted(distinct, k)]) for k in keys]
        columns = [pa.array([kind] * n, pa.int32()), pa.array([bucket] * n, pa.int64()), left.column("shard"), pa.array(blobs, pa.binary()), pa.nulls(n, pa.int64())]
        return pa.table(columns, names=["kind", "bucket", "shard", "counts", "known"])

    learned = found.where("shard >= 0").select(F.shiftright("bucket", bits).alias("bucket"), "kind", F.col("shard").alias("group"), F.col("bucket").alias("low"), "counts")
    dealt = grouped.select(*key, "shard", "keys").groupBy(*key).cogroup(learned.groupBy(*key)).applyInArrow(deal, ANSWERS)
    return written(dealt.unionAll(found.where("shard < 0")), "answers")


def answers(asked: DataFrame) -> DataFrame:
    """(kind, bucket, shard, counts): corpus counts of what was asked, in the order asked.

    A row with shard -1 has the bucket's totals: distinct keys that were counted, in `known`.
    """

    def run(table: pa.Table) -> pa.Table:
        shards = table.column("shard").to_pylist()
        keys = [absolute(b) for b in table.column("keys").to_pylist()]
        counts = np.concatenate([unpacked(b).astype(np.int64) for b in table.column("counts").to_pylist()])
        ends = np.cumsum([0, *map(len, keys)])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, counts, len(distinct)).astype(np.int64)
        each = total[place]
        blobs = [packed(each[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        n = len(shards) + 1
        return pa.table(
            {
                "kind": pa.array([kind] * n, pa.int32()),
                "bucket": pa.array([bucket] * n, pa.int64()),
                "shard": pa.array([*shards, -1], pa.int64()),
                "counts": pa.array([*blobs, None], pa.binary()),
                "known": pa.array([None] * (n - 1) + [int((total > 0).sum())], pa.int64()),
            }
        )

    return written(asked.groupBy("bucket", "kind").applyInArrow(run, ANSWERS), "answers")


# --- the model --------------------------------------------------------------------------------------


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole part of the logarithm to base 2."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


def bins(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(ratio > 0, np.minimum(np.rint(-np.log10(ratio) * FINE), FLOOR - 1), FLOOR).astype(np.int64)


RESOLVED = "shard long, train binary, lengths binary, tokens binary, words binary, pairs binary, cells array<struct<cell:bigint,n:bigint>>"


def resolved(shards: DataFrame, found: DataFrame, n_train: int, train_docs: int) -> DataFrame:
    """Shards with the corpus counts of their words and pairs, and the histogram that the weights are fitted on.

    The histogram deletes each training token's own occurrence from its counts, so what is counted is
    also held out: cells of context bucket and of both estimates' logarithms, a bounded number.
    """
    kind = dict(shards.dtypes)["ids"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        shard = Shard(row["train"], row["lengths"], row["vocab"], row["tokens"])
        parts: dict[int, list[tuple[int, bytes]]] = {0: [], 1: []}
        for k, bucket, blob in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "counts")), strict=True):
            parts[k].append((bucket, blob))
        both = []
        for k, order in ((0, shard.word_order), (1, shard.pair_order)):
            counts = np.empty(len(order), np.int64)
            counts[order] = np.concatenate([unpacked(b).astype(np.int64) for _, b in sorted(parts[k])])
            both.append(counts)
        words, pairs = both
        t = shard.in_train
        c2, c12 = words[shard.tokens][t] - 1, pairs[shard.pair_of][t] - 1
        c1 = np.append(words, train_docs)[shard.before][t] - 1
        r2 = bins(c12 / np.maximum(c1, 1)) * FLOOR * 2 + bins(c2 / max(n_train - 1, 1))
        cells, n = np.unique(context_bucket(c1) * FLOOR * FLOOR * 4 + r2, return_counts=True)
        made = {
            "ids": left.column("ids").combine_chunks(),
            "shard": pa.array([row["shard"]]),
            "train": pa.array([row["train"]], pa.binary()),
            "lengths": pa.array([row["lengths"]], pa.binary()),
            "tokens": pa.array([row["tokens"]], pa.binary()),
            "words": pa.array([packed(words)], pa.binary()),
            "pairs": pa.array([packed(pairs[shard.pair_of])], pa.binary()),
            "cells": pa.array([[{"cell": int(c), "n": int(k)} for c, k in zip(cells, n, strict=True)]], pa.list_(pa.struct([("cell", pa.int64()), ("n", pa.int64())]))),
        }
        return pa.table(made)

    asked = found.where("shard >= 0").select("shard", "kind", "bucket", "counts")
    joined = shards.select("ids", "shard", "train", "lengths", "vocab", "tokens").groupBy("shard").cogroup(asked.groupBy("shard"))
    return written(joined.applyInArrow(run, f"ids {kind}, {RESOLVED}"), "resolved")


def fit_weights(cells: list[tuple[int, int]], n_distinct: int, rounds: int = 100) -> np.ndarray:
    """Mixture weights (pair, word, uniform) per context bucket, by expectation-maximisation.

    Buckets with no held-out count take the weights of the nearest bucket below with some; a context
    never seen has no pair estimate.
    """
    weights = np.tile([0.0, 0.9, 0.1], (65, 1))
    if not cells:
        return weights
    cell, n = np.array([c for c, _ in cells]), np.array([k for _, k in cells], float)
    bucket, rest = cell // (4 * FLOOR * FLOOR), cell % (4 * FLOOR * FLOOR)
    value = lambda b: np.where(b < FLOOR, 10.0 ** (-b / FINE), 0.0)
    p = np.stack([value(rest // (2 * FLOOR)), value(rest % (2 * FLOOR)), np.full(len(cell), 1.0 / (n_distinct + 1))], 1)
    last = None
    for b in range(65):
        own = bucket == b
        if not own.any():
            if last is not None:
                weights[b] = last
            continue
        q, k = p[own], n[own]
        w = np.array([0.0, 0.5, 0.5]) if b == 0 else np.full(3, 1 / 3)
        for _ in range(rounds):
            share = q * w
            w = (share / share.sum(1, keepdims=True) * k[:, None]).sum(0) / k.sum()
        w = np.maximum(w, [0.0 if b == 0 else 1e-9, 1e-9, 1e-6])
        weights[b] = last = w / w.sum()
    return weights


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1) -> DataFrame:
    """Per document: its fold, token counts, the base score and the interpolated score, log10 of the whole text.

    P(w | h) = a c(h,w)/c(h) + b c(w)/N + c/(V+1), weights by how often h occurs. Learns from the rows whose
    crc32(id as text) mod folds is not held_out (a null id: the empty text). A null text is its end
    alone; repeated rows count each time; an empty table gives no rows. Without any training row every
    token is unknown. Shards are cut by tokens and buckets by hash, so no source, word or passage
    makes a large group, however common.
    """
    spark = docs.sparkSession
    shards = coded(docs, id_col, text_col, folds, held_out)
    total = shards.agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")).first()
    n_all, n_train = int(total["n"] or 0), int(total["n_train"] or 0)
    bits = max(n_all // BUCKET_TOKENS, 1).bit_length() + 2
    first, *further = hops(bits)
    found = counted(questions(shards, first), shards.count(), further, first)
    n_distinct = int(found.where("shard < 0 AND kind = 0").agg(F.sum("known")).first()[0] or 0)
    train_docs = train_documents(shards)
    rows = resolved(shards, found, n_train, train_docs)
    cells = rows.select(F.explode("cells").alias("c")).groupBy("c.cell").agg(F.sum("c.n").alias("n")).collect()
    weights = spark.sparkContext.broadcast(fit_weights([(r["cell"], r["n"]) for r in cells], n_distinct))  # 65 rows
    names = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for batch in batches:
            for row, ids in zip(batch.drop_columns(["ids"]).to_pylist(), batch.column("ids"), strict=True):
                train, lengths = unpacked(row["train"]).astype(bool), unpacked(row["lengths"]).astype(np.int64)
                tokens, words = unpacked(row["tokens"]).astype(np.int64), unpacked(row["words"]).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                c2, c12 = words[tokens], unpacked(row["pairs"]).astype(np.int64)
                c1 = np.empty_like(c2)
                c1[1:] = c2[:-1]
                c1[first] = train_docs
                base = np.log10((c2 + 0.5) / (n_train + 0.5 * (n_distinct + 1)))
                w = weights.value[context_bucket(c1)]
                p = w[:, 0] * c12 / np.maximum(c1, 1) + w[:, 1] * c2 / max(n_train, 1) + w[:, 2] / (n_distinct + 1)
                sums = [np.add.reduceat(x, first) for x in ((c2 > 0).astype(np.int64), base, np.log10(p))]
                columns = [~train, lengths, sums[0], np.full(len(lengths), n_train), sums[1], sums[2]]
                yield pa.RecordBatch.from_arrays([ids.values, *(pa.array(c) for c in columns)], [id_col, *names])

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.select("ids", "train", "lengths", "tokens", "words", "pairs").mapInArrow(run, schema)


def train_documents(shards: DataFrame) -> int:
    """How many documents the counts are of."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(unpacked(b).sum()) for b in batch.column("train").to_pylist()], pa.int64())], ["n"])

    return int(shards.select("train").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0)
