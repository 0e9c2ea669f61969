"""Best-fit packing of tokenised documents: length patterns fitted by non-negative least squares."""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweave.llm.common import written

CACHE_WORDS = 500_000  # words whose ids a task keeps; a cache only, the ids don't depend on it
PUNCTUATION = ".,;:!?"
ODD_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


# The rules of a tokenizer file that the shortcut below relies on; fixed values.
BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "ignore_merges": False}


class WordEncoder(dict):
    """Ids of whole texts by a word-level tokenizer file, word by word; the dict holds words met before.

    The tokenizer of `word_bpe_49k.json` folds case, drops white space and never merges across it, so a
    text's ids are its words' ids in order. That shortcut is taken with files of just these rules, for texts of Latin-1 characters
    (where normalisation is lower-casing alone) without special tokens or odd spaces; every other
    text goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.by_words = {k: rules[k] for k in BY_WORDS} == BY_WORDS and all(rules["model"].get(k) == v for k, v in MODEL.items())
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.marks = dict(zip(PUNCTUATION, map(self.whole, PUNCTUATION), strict=True))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            raw = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.merge(raw)])
        elif len(word) > 1 and word[-1] in PUNCTUATION and word[:-1].isalpha():
            ids = self[word[:-1]] + self.marks[word[-1]]
        else:
            ids = self.whole(word)
        self[word] = ids
        return ids

    def plain(self, text: str) -> bool:
        if not self.by_words or "<|" in text or any(c in text for c in ODD_SPACE):
            return False
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if not self.plain(text):
            return self.whole(text)
        if len(self) > CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.lower().split()))


def pieces(docs: DataFrame, path: str, sequence_length: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenise and cut: one row per piece, written to the shared folder.

    Only documents longer than sequence_length are cut. `chunk` is the task that made the piece and
    `place` numbers the pieces of one length within it; both are stored, so they stay as they are.
    A null or empty text is the end id alone. With with_ids, the ids themselves as `ids`.
    """
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, piece int, start long, length int, ids_crc32 long, chunk int, place long" + ", ids binary" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encoder, seen, chunk = WordEncoder(path), defaultdict(int), TaskContext.get().partitionId()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                owner, out = [], []
                for row, text in enumerate(part.column(text_col).to_pylist()):
                    raw = encoder.encode(text or "") + end
                    for k, at in enumerate(range(0, len(raw), 4 * sequence_length)):
                        ids = raw[at : at + 4 * sequence_length]
                        n = len(ids) // 4
                        owner.append(row)
                        out.append((k, at // 4, n, zlib.crc32(ids), chunk, seen[n], *([ids] if with_ids else [])))
                        seen[n] += 1
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)]
                names = ["piece", "start", "length", "ids_crc32", "chunk", "place", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays([part.column(id_col).take(pa.array(owner)), *columns], [id_col, *names])

    return written(docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(cut, schema), "pieces")


# --- the plan: on the histogram of lengths, so its cost is bounded by the sequence length ---------


def patterns(lengths: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """All patterns of one to three documents of the given lengths that fill `total` exactly.

    Returns (patterns x 3 lengths with 0 for none, largest first).
    """
    have = np.zeros(total + 1, bool)
    have[lengths] = True
    out = [np.array([[total, 0, 0]])] if have[total] else []
    low = np.arange(1, total // 2 + 1)
    two = low[have[low] & have[total - low]]
    out.append(np.stack([total - two, two, 0 * two], 1))
    for c in lengths[lengths <= total // 3]:
        b = np.arange(c, (total - c) // 2 + 1)
        b = b[have[b] & have[total - c - b]]
        out.append(np.stack([total - c - b, b, 0 * b + c], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit_counts(pattern: np.ndarray, counts: np.ndarray, rounds: int = 24, added: int = 512, steps: int = 60) -> np.ndarray:
    """Repeat counts x >= 0 with the least squared difference between patterns' lengths and `counts`.

    Columns join the active set by their gradient, `added` at a time; the active problem is solved by
    projected steps scaled by each column's share of the rows (never overshooting).
    """
    x, active = np.zeros(len(pattern)), np.zeros(len(pattern), bool)
    real = pattern > 0
    size = real.sum(1)
    target = counts.astype(float)
    target[0] = 0

    def left(rows: np.ndarray) -> np.ndarray:
        p = pattern[rows]
        used = np.bincount(p.ravel(), np.repeat(x[rows], 3), len(target))
        used[0] = 0
        return target - used

    for _ in range(rounds):
        r = left(np.flatnonzero(active))
        gain = r[pattern].sum(1) / size
        gain[active] = 0
        best = np.argsort(-gain, kind="stable")[:added]
        best = best[gain[best] > 0.5]
        if not len(best):
            break
        active[best] = True
        rows = np.flatnonzero(active)
        p = pattern[rows]
        share = np.bincount(p.ravel(), minlength=len(target)).astype(float)
        share[0] = 0
        step = np.maximum(share[p].sum(1), 1)
        for _ in range(steps):
            x[rows] = np.maximum(0, x[rows] + left(rows)[p].sum(1) / step)
        idle = rows[x[rows] < 0.5]
        active[idle], x[idle] = False, 0
    return x


def best_fit(counts: np.ndarray, total: int) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing over a histogram: sequences of equal content are one entry with a count."""
    open_at: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    gaps: list[int] = []
    done: dict[tuple[int, ...], int] = defaultdict(int)

    def put(content: tuple[int, ...], gap: int, n: int) -> None:
        if gap == 0:
            done[content] += n
            return
        if not open_at[gap]:
            insort(gaps, gap)
        open_at[gap][content] = open_at[gap].get(content, 0) + n

    for length in range(total, 0, -1):
        n = int(counts[length])
        while n:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                each = total // length
                if n >= each:
                    put((length,) * each, total - each * length, n // each)
                if n % each:
                    put((length,) * (n % each), total - n % each * length, 1)
                break
            gap = gaps[k]
            content, have = open_at[gap].popitem()
            if not open_at[gap]:
                del gaps[k]
            each = gap // length
            use = min(have, n // each)
            if use:
                put(content + (length,) * each, gap - each * length, use)
                n -= use * each
            if use < have:
                if n < each and n:  # the last, partly filled
                    put(content + (length,) * n, gap - n * length, 1)
                    n, use = 0, use + 1
                if use < have:
                    put(content, gap, have - use)
    for group in open_at.values():
        for content, n in group.items():
            done[content] += n
    return done


def plan(counts: np.ndarray, total: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, how many sequences) for a histogram of lengths 0..total.

    Few-document patterns that fill a sequence exactly, repeated as least squares says, rounded
    down; what rounding leaves is packed best-fit. If best-fit alone needs fewer sequences, that.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    chosen = []
    p = patterns(np.flatnonzero(left), total)
    if len(p):
        x = np.floor(fit_counts(p, left) + 1e-9).astype(np.int64)
        for j in np.argsort(-x, kind="stable"):
            if x[j] <= 0:
                break
            lengths = tuple(int(v) for v in p[j] if v)
            n = min(int(x[j]), *(int(left[v]) // lengths.count(v) for v in lengths))
            if n > 0:
                chosen.append((lengths, n))
                for v in lengths:
                    left[v] -= n
    fitted = chosen + list(best_fit(left, total).items())
    plain = list(best_fit(counts, total).items())
    return min(fitted, plain, key=lambda x: sum(n for _, n in x))


def pack(pieces: DataFrame, sequence_length: int = 2048) -> DataFrame:
    """Add sequence_id and offset to written pieces (length, chunk, place).

    Only the histogram of lengths reaches the driver. A piece's rank among all pieces of its length is
    its place in its chunk plus what earlier chunks have; the plan says which sequence and offset that
    rank takes. No pieces of one length ever meet in one task, however common the length is.
    """
    spark = pieces.sparkSession
    per_chunk = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    per_chunk = written(per_chunk, "chunk-lengths")
    counts = np.zeros(sequence_length + 1, np.int64)
    for row in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    slots, sequences = [], 0
    used = np.zeros(sequence_length + 1, np.int64)
    for lengths, n in plan(counts, sequence_length):
        offset = 0
        for length in lengths:
            slots.append((length, int(used[length]), sequences, offset))
            used[length] += n
            offset += length
        sequences += n
    slots = np.array(sorted(slots), np.int64).reshape(-1, 4)
    keys = slots[:, 0] << 48 | slots[:, 1]
    shared = spark.sparkContext.broadcast((keys, slots))  # bounded by the patterns of one histogram

    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = per_chunk.select("length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "chunk"]).withColumn("rank", F.col("place") + F.col("before")).drop("place", "before", "chunk")
    names = [c for c in ranked.columns if c != "rank"]

    def place(batches):
        keys, slots = shared.value
        for batch in batches:
            rank, length = batch.column("rank").to_numpy(), batch.column("length").to_numpy().astype(np.int64)
            at = np.searchsorted(keys, length << 48 | rank, "right") - 1
            sequence, offset = slots[at, 2] + rank - slots[at, 1], slots[at, 3]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in ranked.dtypes if c != "rank") + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, sequence_length: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack documents; one row per piece.

    Null and empty texts are one token long; repeated rows are packed each; an empty table gives no rows;
    other columns are not read.
    """
    return pack(pieces(docs, path, sequence_length, id_col, text_col, with_ids=with_ids), sequence_length)
