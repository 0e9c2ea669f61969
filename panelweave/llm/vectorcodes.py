"""Vectors as short codes: one codebook per part of a vector, its nearest entries found by a GNAT.

A geometric near-neighbour access tree over the entries of a codebook: every node takes a few split points,
gives each other entry to its nearest split point, and stores for every (split point, child) the range
of distances from the point to the child's entries. A query measures its distance to the split points;
by the triangle inequality a range it cannot meet rules out the child whole. Ranges are rounded outwards
and a child goes only if it is strictly farther than the best entry so far, so entries at an equal distance
are all seen; distances are compared as whole numbers, ties to the lower index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import null_safe, small, written

SLACK = 1e-12  # more than the relative error of a correctly rounded square root of a rounded number
EXACT = 1 << 24  # whole numbers below this have distances that 64 bits hold; others are Python's
LARGEST = 3.4028234663852886e38  # of a 32-bit float
LIMBS = 5  # of 32 bits: 256 * LARGEST needs 137 bits


# --- the tree over one codebook ----------------------------------------------------------------


@dataclass
class Gnat:
    """A node: `splits` are indexes of entries, `low` and `high` the ranges from split (row) to child (column)."""

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[Gnat | None] = field(default_factory=list)


def squares(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of q to all rows of p, in whole numbers."""
    out = (q[:, None, 0] - p[None, :, 0]) ** 2
    for k in range(1, q.shape[1]):
        out = out + (q[:, None, k] - p[None, :, k]) ** 2
    return out


def roots(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(float))


def gnat(entries: np.ndarray, members: np.ndarray, degree: int = 8) -> Gnat | None:
    """The tree over entries[members]; None for no members.

    Split points are far from each other: each next one is the entry farthest from those chosen. A split
    point stands in its node alone, so a child without other entries is None.
    """
    if not len(members):
        return None
    own = squares(entries[members], entries[members])
    chosen = [0]
    gap = own[0]
    while len(chosen) < min(degree, len(members)):
        free = np.where(np.isin(np.arange(len(members)), chosen), -1, gap)
        chosen.append(int(np.argmax(free)))
        gap = np.minimum(gap, own[chosen[-1]])
    owner = np.argmin(own[chosen].astype(float), axis=0)
    rest = np.ones(len(members), bool)
    rest[chosen] = False
    far = roots(own[chosen])
    low, high, children = np.zeros((len(chosen),) * 2), np.zeros((len(chosen),) * 2), []
    for j in range(len(chosen)):
        inside = np.flatnonzero(rest & (owner == j))
        if len(inside):
            low[:, j] = far[:, inside].min(1) * (1 - SLACK)
            high[:, j] = far[:, inside].max(1) * (1 + SLACK)
        children.append(gnat(entries, members[inside], degree))
    return Gnat(members[chosen], low, high, children)


def nearest(tree: Gnat, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance) of each query, and how many distances were measured."""
    best = np.full(len(queries), -1)
    least = np.zeros(len(queries), queries.dtype)
    measured = 0

    def visit(node: Gnat, rows: np.ndarray) -> None:
        nonlocal measured
        d = squares(queries[rows], entries[node.splits])
        measured += d.size
        for k, index in enumerate(node.splits):
            better = (best[rows] < 0) | (d[:, k] < least[rows]) | ((d[:, k] == least[rows]) & (index < best[rows]))
            at = rows[better.astype(bool)]
            best[at], least[at] = index, d[better.astype(bool), k]
        measure = roots(d)
        lower, upper = measure * (1 - SLACK), measure * (1 + SLACK)
        for j, child in enumerate(node.children):
            if child is not None:
                reach = roots(least[rows]) * (1 + SLACK)
                outside = np.maximum(lower - node.high[:, j], node.low[:, j] - upper).max(1)
                left = rows[outside <= reach]  # strictly farther ones go
                if len(left):
                    visit(child, left)

    visit(tree, np.arange(len(queries)))
    return best, least, measured


# --- numbers -----------------------------------------------------------------------------------


def whole(values: np.ndarray) -> np.ndarray:
    """floor(256 * x), as 64-bit numbers where all are small and as Python's numbers elsewhere."""
    scaled = np.floor(values.astype(float) * 256)
    if not scaled.size or np.abs(scaled).max() < EXACT:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def limbs(value: int) -> list[int]:
    """A whole number in pieces of 32 bits, the last one signed, whose sums fit 64 bits."""
    return [value >> 32 * k & 0xFFFFFFFF for k in range(LIMBS - 1)] + [value >> 32 * (LIMBS - 1)]


# --- the operator ------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """No null and only finite components, none beyond a 32-bit float."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))


class Books:
    """The codebooks with their trees, made once in a task."""

    def __init__(self, books: np.ndarray):
        self.entries = [b if any(abs(x) >= EXACT for x in b.ravel()) else b.astype(np.int64) for b in books]
        self.trees = [gnat(e, np.arange(len(e))) for e in self.entries]

    def assigned(self, column: pa.Array, dims: int):
        """For each part of a batch: its vectors, the indexes of their nearest entries and the squared distances."""
        vectors = _vectors(column, dims).reshape(len(column), len(self.entries), -1)
        for part, (entries, tree) in enumerate(zip(self.entries, self.trees, strict=True)):
            queries = vectors[:, part]
            if object in (queries.dtype, entries.dtype):
                queries, entries = queries.astype(object), entries.astype(object)
            index, error, _ = nearest(tree, entries, queries)
            yield part, queries, index, error


def _next_books(kept: DataFrame, dims: int, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; unused entries stay.

    A task sums its parts by entry, so it sends as many rows as the codebooks have entries; so
    does the aggregate to the driver.
    """
    parts, size, width = books.shape
    names = [f"s{k}_{l}" for k in range(width) for l in range(LIMBS)]

    def sums(batches):
        made = Books(books)
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), object)
        for batch in batches:
            for part, queries, index, _ in made.assigned(batch.column(0), dims):
                count[part] += np.bincount(index, minlength=size)
                if queries.dtype == object:
                    np.add.at(total[part], index, queries)
                else:
                    each = np.zeros((size, width), np.int64)
                    np.add.at(each, index, queries)
                    total[part] += each
        rows = [(p, e, int(count[p, e]), *(x for v in total[p, e] for x in limbs(int(v)))) for p, e in zip(*np.nonzero(count), strict=True)]
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), pa.int32(), *[pa.int64()] * (1 + len(names))], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *names])

    schema = "part int, entry int, n long, " + ", ".join(f"{n} long" for n in names)
    summed = kept.select("_vector").mapInArrow(sums, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
    out = books.copy()
    for row in summed.collect():  # parts * entries rows at most
        for k in range(width):
            total = sum(row[f"s{k}_{l}"] << 32 * l for l in range(LIMBS))
            out[row["part"], row["entry"], k] = total // row["n"]
    return out


def fit(kept: DataFrame, dims: int, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """The codebooks (part, entry, position) of vectors `_vector` with ids `_id`, in whole numbers.

    They start as the vectors of the smallest ids. Each round reads the vectors once.
    """
    start = kept.where("_id IS NOT NULL").orderBy("_id", "_vector").limit(entries).select("_vector").collect()
    books = np.array([[int(x) for x in whole(np.array(row[0], float))] for row in start], object)
    books = books.reshape(len(start), parts, dims // parts).swapaxes(0, 1)
    for _ in range(rounds if len(start) else 0):
        books = _next_books(kept, dims, books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every usable vector.

    Unusable vectors are left out: null, empty, or with null or non-finite components (or components beyond a
    32-bit float); so are those of another length than the vector with the smallest id. A length that is
    no multiple of `parts` fails. Null ids are coded but start no entry; with fewer ids than entries, the
    codebooks are smaller; without any id, and for an empty table, there are no rows. Repeated rows are coded each;
    equal ids start entries in the order of their vectors. Errors and sums beyond a 64-bit number are null.
    Codebooks are the only thing that is broadcast or reaches the driver: parts * entries entries. Sums by label are made
    before the shuffle and joined back, broadcast where they are counted few.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    spark = vectors.sparkSession
    vector = F.col(f"`{vector_col}`")
    if dict(vectors.dtypes)[vector_col] != "array<float>":
        vector = vector.cast("array<double>")
    kept = vectors.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label"), vector.alias("_vector")).where(usable(F.col("_vector")))
    first = kept.where("_id IS NOT NULL").orderBy("_id", "_vector").limit(1).select(F.size("_vector")).first()
    dims = first[0] if first else parts
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("_vector") == dims) if first else kept.where("false")
    books = fit(kept, dims, parts, entries, rounds)

    def coded(batches):
        made = Books(books)
        for batch in batches:
            code, error = np.zeros((batch.num_rows, parts), np.int64), np.zeros(batch.num_rows, object)
            for part, _, index, square in made.assigned(batch.column("_vector"), dims):
                code[:, part] = index
                error = error + square.astype(object)
            texts = [bytes(row).hex() for row in code.astype(np.uint8)]
            errors = [int(e) if e < 1 << 63 else None for e in error]
            arrays = [batch.column("_id"), batch.column("_label"), pa.array(texts, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["_id", "_label", "code", "error"])

    types = dict(kept.dtypes)
    codes = written(kept.mapInArrow(coded, f"_id {types['_id']}, _label {types['_label']}, code string, error long"), "codes")
    total = F.expr("CASE WHEN count(error) = count(*) THEN try_cast(sum(CAST(error AS DECIMAL(38,0))) AS BIGINT) END")
    labels = small(written(codes.groupBy("_label").agg(total.alias("label_error")), "label-errors"))
    joined = codes.join(labels, null_safe(codes, labels, ["_label"]), "left")
    return joined.select(codes["_id"].alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
