"""SimHash near-duplicates by generalised pigeonhole: correlated bits together, unequal thresholds."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions.names import fresh
from panelweave.llm.common import components, small, without_rows, written

BITS = 64
SEED = 42
BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; fewer words than `size` are one shingle."""
    import xxhash

    words = text.encode("utf-8").lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(b" ".join(x), SEED) for x in zip(*(words[k:] for k in range(size)), strict=False)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes; no hashes give zero."""
    n, out = len(hashes), 0
    parts = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    for k in range(8):
        ones = np.bincount(parts[:, k], minlength=256) @ BYTE_BITS
        out |= int(((2 * ones > n) << np.arange(8)).sum()) << 8 * k
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, text_hash, fp) per row: the fingerprint of the whole text as a signed 64-bit integer; null is empty."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t or "", shingle)) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("text_hash"), pa.array(np.array(fps, np.uint64).view(np.int64))], [id_col, "text_hash", "fp"])

    thin = docs.select(id_col, text_col, F.xxhash64(text_col).alias("text_hash"))
    return thin.mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, text_hash long, fp long")


# --- the partitioning, from counts over all fingerprints -----------------------------------------


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many of them each pair of bits is set (64 x 64)."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fp), 1 << 16):
                bits = ((fp[k : k + (1 << 16), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += bits.T @ bits
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j].astype(np.int64))], ["i", "j", "n"])

    matrix = np.zeros((BITS, BITS))
    for i, j, n in fps.mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n")).collect():  # 4096 rows at most
        matrix[i, j] = n
    return fps.count(), matrix


def group_bits(n: int, matrix: np.ndarray, groups: int) -> list[list[int]]:
    """Bits in `groups` parts of nearly equal size, each part of bits that correlate."""
    share = np.diag(matrix) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    strength = np.abs((matrix / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    free, out = set(range(BITS)), []
    for g in range(groups):
        size = len(free) // (groups - g)
        rest = sorted(free)
        part = [max(rest, key=lambda b: (strength[b, rest].sum(), -b))]
        free.discard(part[0])
        while len(part) < size:
            best = max(sorted(free), key=lambda b: strength[b, part].sum())
            part.append(best)
            free.discard(best)
        out.append(sorted(part))
    return out


def differing(share: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in 0..most of the bits with these shares of ones, bits taken as independent."""
    chance = np.zeros(most + 1)
    chance[0] = 1
    for q in 2 * share * (1 - share):
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return chance


def allocate(n: int, share: np.ndarray, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Thresholds >= -1 with sum(t + 1) = distance + 1 of least cost, by dynamic programming.

    A part at threshold t costs its probe rows, one per fingerprint and choice of t free bits, plus
    the candidate pairs estimated from the shares of ones. -1 leaves a part out.
    """
    budget = distance + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        within = np.cumsum(differing(share[part], distance))
        cost = {-1: 0.0} | {t: n * 8.0 * comb(len(part), t) + n * n / 2 * within[t] for t in range(distance + 1)}
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (so_far, chosen) in best.items():
            for t, c in cost.items():
                total = spent + t + 1
                if total <= budget and (total not in step or so_far + c < step[total][0]):
                    step[total] = (so_far + c, [*chosen, t])
        best = step
    return best[budget]


def choose_parts(n: int, matrix: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the cheapest of several numbers of parts."""
    share = np.diag(matrix) / max(n, 1)
    options = []
    for groups in range(2, distance + 3):
        parts = group_bits(n, matrix, groups)
        cost, thresholds = allocate(n, share, parts, distance)
        options.append((cost, [(p, t) for p, t in zip(parts, thresholds, strict=True) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def probe_masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """For each part with threshold t, its bits without each choice of t of them.

    Two values that differ in at most t bits of the part are equal under one of these masks.
    """
    masks = []
    for bits, t in parts:
        whole = sum(1 << b for b in bits)
        masks += [whole & ~sum(1 << b for b in free) for free in combinations(bits, t)]
    return masks


# --- probing, verifying, linking ------------------------------------------------------------------


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect what links at <= distance connect, no more than there are values."""
    edges, open_ = [], np.arange(len(fps))
    while len(open_):
        todo, open_ = [open_[0]], open_[1:]
        while todo and len(open_):
            at = todo.pop()
            near = np.bitwise_count(fps[open_] ^ fps[at]) <= distance
            if near.any():
                found = open_[near]
                edges += [(int(at), int(x)) for x in found]
                todo += list(found)
                open_ = open_[~near]
    return edges


def crowded(keys: DataFrame, limit: int) -> DataFrame:
    """(key, n) of the buckets above the limit, counted before anything is collected."""
    return written(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit), "crowded")


def dealt(keys: DataFrame, large: DataFrame, finer: Column) -> DataFrame:
    """The rows of large buckets under each of their finer keys, which may use the bucket's count n."""
    joined = keys.join(large, "key", "left")
    return joined.select("fp", F.explode(F.when(F.col("n").isNull(), F.array("key")).otherwise(finer)).alias("key"))


def buckets(fps: DataFrame, distance: int = 3, bucket_limit: int = 8192) -> DataFrame:
    """(fp, key): two fingerprints within `distance` share a key at least once.

    Buckets are the rows equal under one probe mask. A bucket above bucket_limit is dealt on by
    blocks of all 64 bits, of which a linked pair has one equal, so no link is lost. What is still
    above it is cut into salted blocks, every two of which are one bucket of about half the limit.
    """
    n, matrix = bit_counts(fps)
    masks = probe_masks(choose_parts(n, matrix, distance))
    keys = fps.select("fp", F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(signed(m)))) for k, m in enumerate(masks)])).alias("key"))
    large = crowded(keys, bucket_limit)
    if large.isEmpty():
        return keys
    width = -(-BITS // (distance + 1))
    blocks = [sum(1 << b for b in range(k, min(k + width, BITS))) for k in range(0, BITS, width)]
    keys = dealt(keys, large, F.array(*[F.xxhash64("key", F.lit(k), F.col("fp").bitwiseAND(F.lit(signed(m)))) for k, m in enumerate(blocks)]))
    large = crowded(keys, bucket_limit)
    if large.isEmpty():
        return keys
    salts = F.ceil(F.col("n") * 4 / bucket_limit).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("salt")), salts).cast("int")
    return dealt(keys, large, F.transform(F.sequence(F.lit(0), salts - 1), lambda x: F.xxhash64("key", F.least(own, x), F.greatest(own, x))))


def links(fps: DataFrame, distance: int = 3, bucket_limit: int = 8192) -> DataFrame:
    """Edges (u, v) over distinct fingerprints `fp`: connected exactly as all pairs within `distance`.

    Each bucket gives a spanning forest of its verified links, never its pairs.
    """
    lists = buckets(fps, distance, bucket_limit).groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches):
        for batch in batches:
            lists = batch.column("fps")
            values = lists.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum([0, *pa.compute.list_value_length(lists).to_pylist()])
            sizes = np.diff(ends)
            u, v = [], []
            two = np.flatnonzero(sizes == 2)  # most buckets: one pair each
            a, b = values[ends[two]], values[ends[two] + 1]
            near = np.bitwise_count(a ^ b) <= distance
            u += a[near].tolist()
            v += b[near].tolist()
            for k in np.flatnonzero(sizes > 2):
                own = values[ends[k] : ends[k + 1]]
                for i, j in forest(own, distance):
                    u.append(int(own[i]))
                    v.append(int(own[j]))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (u, v)], ["u", "v"])

    return lists.mapInArrow(run, "u long, v long")


def membership(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, salts: int = 32, bucket_limit: int = 8192) -> DataFrame:
    """(id, text_hash, fp, component, component_id) per row: component is its smallest fingerprint, component_id its smallest id."""
    own = written(fingerprints(docs, id_col, text_col, shingle).withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")), "fingerprints")
    nodes = own.groupBy("fp", "salt").agg(F.min(id_col).alias("low")).groupBy("fp").agg(F.min("low").alias("low"), F.collect_list("salt").alias("salts"))
    nodes = written(nodes, "nodes")
    member = components(links(nodes.select("fp"), distance, bucket_limit))
    named = nodes.join(member, nodes["fp"] == member["node"], "left")
    named = written(named.select("fp", "low", "salts", F.coalesce("component", "fp").alias("component")), "members")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    roots = named.join(lowest, "component").select("fp", "component", "component_id", F.explode("salts").alias("salt"))
    return own.join(roots, ["fp", "salt"], "left").select(id_col, "text_hash", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, salts: int = 32, bucket_limit: int = 8192) -> DataFrame:
    """(id, fp, component_id) per row: component_id is the smallest id reachable over links of <= distance bits.

    Equal fingerprints are one node, so copies never multiply the work. Null and empty texts have
    fingerprint zero and link like any other; rows with a null id join components but never name one
    (the component of null ids alone is null); an empty table gives no rows.
    """
    return membership(docs, id_col, text_col, shingle, distance, salts, bucket_limit).select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The documents with the smallest id of their component, all columns as they were.

    Rows are told apart by id and text. Of the rows of a component that share its smallest id one stays;
    those that share it in another component are no copies and are dealt with there. Rows with a null id stay.
    """
    found = written(membership(docs, id_col, text_col, shingle, distance).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_out"), "text_hash", "component", "component_id"), "membership")
    key = ["_out", "text_hash"]
    repeated = written(found.groupBy("_out").agg(F.count("*").alias("n")).where("n > 1").select("_out"), "repeated")
    gone = found.where("component_id < _out").select(key)
    several = not repeated.isEmpty()
    if several:
        shared = found.where("component_id = _out").join(repeated, "_out", "left_semi")
        first = shared.groupBy("_out", "component").agg(F.min("text_hash").alias("first"))
        gone = gone.unionAll(shared.join(first, ["_out", "component"]).where("text_hash <> first").select(key))
    out = small(written(gone.select(F.col("_out").alias("_id"), "text_hash").distinct(), "duplicates"))
    kept = without_rows(docs, out, id_col, text_col)
    if several:
        own = kept[f"`{id_col}`"] == repeated["_out"]
        text_hash = fresh("_hash", docs.columns)
        once = kept.join(repeated, own, "left_semi").withColumn(text_hash, F.xxhash64(f"`{text_col}`")).dropDuplicates([id_col, text_hash])
        kept = kept.join(repeated, own, "left_anti").unionByName(once.drop(text_hash))
    return kept
