"""Periodic runs of words: seeds of repeated k-grams, extended along the diagonals of a document against itself.

A run of period q matches itself at lag q on a diagonal of at least max(shortest - q, (times - 1) * q) places. Lags
are taken in classes, each with grams of as many words as its lags guarantee and no fewer than its largest lag: then the
next occurrence of a gram inside a run is exactly one smallest period on, so next occurrences are
all the pairs that are needed, however often a gram occurs. Grams are named exactly, by doubling: two
names of k words make one of 2k, and only places whose halves are both repeated go on.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20  # of text whose words are indexed together; a longer text is indexed alone


def names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Equal pairs get equal names from 0 on, pairs that occur once get -1."""
    key = first.astype(np.int64) << 32 | second.astype(np.int64)
    _, name, count = np.unique(key, return_inverse=True, return_counts=True)
    return np.where(count[name] > 1, name, -1)


def seeds(words: np.ndarray, owner: np.ndarray, ends: np.ndarray, shortest: int, times: int):
    """Yield (lags, places) of gram occurrences and their next ones in the same text, class of lags by class.

    words: numbers of the words of many texts; owner: the text of each; ends: where each text ends.
    """
    smallest = min(max(shortest - q, (times - 1) * q) for q in range(1, shortest + 1))  # guaranteed overlap of any run
    k, low = 1, 1
    name = names(owner, words)
    place = np.flatnonzero(name >= 0)
    at = np.full(len(words), -1)
    while len(place):
        if 2 * k > smallest:
            order = np.argsort(name[place], kind="stable")  # by name, then place
            sorted_place, sorted_name = place[order], name[place][order]
            lag = np.diff(sorted_place)
            seed = (np.diff(sorted_name) == 0) & (lag >= low) & (lag <= k)
            if seed.any():
                yield lag[seed], sorted_place[:-1][seed]
            low = k + 1
        at[:] = -1
        at[place] = name[place]
        place = place[place + 2 * k <= ends[owner[place]]]
        place = place[at[place + k] >= 0]
        made = names(at[place], at[place + k])
        name = np.full(len(words), -1)
        name[place] = made
        place = place[made >= 0]
        k *= 2


def matching(words: np.ndarray, place: int, lag: int, step: int, bound: int) -> int:
    """How many places from `place` on, in direction `step` and below `bound` of them, match the word a lag later."""
    done, chunk = 0, 64
    while done < bound:
        n = min(chunk, bound - done)
        a = place + step * done
        here = words[a : a + n] if step > 0 else words[a - n + 1 : a + 1][::-1]
        there = words[a + lag : a + lag + n] if step > 0 else words[a + lag - n + 1 : a + lag + 1][::-1]
        differ = np.flatnonzero(here != there)
        if len(differ):
            return done + int(differ[0])
        done, chunk = done + n, chunk * 2
    return done


def runs(words: np.ndarray, owner: np.ndarray, starts: np.ndarray, ends: np.ndarray, shortest: int = 24, times: int = 3) -> dict[int, list[tuple[int, int, int]]]:
    """For each text that has any: its runs (start, length, period), by start and then period.

    A seed extends both ways to the first mismatch. `covered` holds, for each text and lag, how far the
    diagonal is known, so a repeated seed costs nothing.
    """
    found: dict[int, list[tuple[int, int, int]]] = {}
    covered: dict[tuple[int, int], int] = {}
    for lags, places in seeds(words, owner, ends, shortest, times):
        order = np.lexsort((places, lags))
        lags, places = lags[order], places[order]
        head = np.ones(len(lags), bool)
        head[1:] = (np.diff(lags) != 0) | (np.diff(places) != 1)
        for lag, place in zip(lags[head].tolist(), places[head].tolist(), strict=True):
            text = int(owner[place])
            if place < covered.get((text, lag), 0):
                continue
            first = place - matching(words, place - 1, lag, -1, place - int(starts[text]))
            after = place + matching(words, place, lag, 1, int(ends[text]) - lag - place)
            covered[text, lag] = after
            length = after + lag - first
            if length >= max(shortest, times * lag):
                found.setdefault(text, []).append((first - int(starts[text]), length, lag))
    return {text: sorted(x, key=lambda r: (r[0], r[2])) for text, x in found.items()}


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is collapsed to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def planted(n: int, key: str) -> np.ndarray | None:
    """The contract's rewriting of one text in ten: the place each word is taken from, or None."""
    h = zlib.crc32(key.encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _scanned(rows: list[tuple[str, bytes]], shortest: int, times: int, rewrite: bool):
    """For each (id as text, text): its words, and its runs; words beyond ASCII white space only."""
    number: dict[bytes, int] = {}
    texts, ids = [], []
    for key, text in rows:
        split = text.split()
        source = planted(len(split), key) if rewrite else None
        code = np.fromiter((number.setdefault(w, len(number)) for w in split), np.int32, len(split))
        if source is not None:
            split, code = [split[k] for k in source.tolist()], code[source]
        texts.append(split)
        ids.append(code)
    sizes = np.array([len(c) for c in ids], np.int64)
    ends = np.cumsum(sizes)
    found = runs(np.concatenate(ids), np.repeat(np.arange(len(rows)), sizes), ends - sizes, ends, shortest, times)
    return [(split, found.get(k, [])) for k, split in enumerate(texts)]


def periodic_runs(docs: DataFrame, shortest: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False, with_text: bool = False) -> DataFrame:
    """Per document its runs, the greatest of them, and digests of all runs and of the collapsed text.

    A run is a maximal stretch of words with smallest period `period` and a length of at least `shortest` and
    `times` periods. (n_runs, start, length, period, exponent_milli) describe the run of the greatest exact
    length / period, ties by the smallest start, then period; null where there is none. With with_text also
    `runs` (array of start, length, period) and `collapsed`, the text with every run cut to its first
    period and its words joined by blanks. rewrite: first turn one document in ten into a periodic one, by
    its id alone, as tests and the registered query do. A null or empty text has no words and no runs; a null id counts as
    an empty one; repeated rows are treated each; an empty table gives no rows; other columns are not read. A text
    is held whole by the task that reads it; no task holds more than one text and a few MB of others.
    """
    if times < 3 or shortest < times:
        raise ValueError("grams of a class hold its largest lag only where a run has at least three periods")

    def scanned(batches):
        for batch in batches:
            keys, texts = batch.column("_key").to_pylist(), batch.column("_text")
            first = 0
            while first < batch.num_rows:
                part, size, last = [], 0, first
                while last < batch.num_rows and (not part or size < BATCH_BYTES):
                    part.append((keys[last] or "", (texts[last].as_py() or "").encode()))
                    size += len(part[-1][1])
                    last += 1
                rows = []
                for split, found in _scanned(part, shortest, times, rewrite):
                    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
                    kept = split
                    if found:
                        kept = [split[k] for k in np.flatnonzero(kept_words(len(split), found)).tolist()]
                    text = b" ".join(kept)
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
                    digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
                    great = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                    more = ([{"start": s, "length": n, "period": p} for s, n, p in found], text.decode()) if with_text else ()
                    rows.append((len(found), *great, *digests, *more))
                kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(first, last - first), *columns], ["_id", *COLUMNS, "runs", "collapsed"][: 1 + len(columns)])
                first = last

    kept = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{id_col}`").cast("string").alias("_key"), F.col(f"`{text_col}`").alias("_text"))
    schema = f"_id {dict(kept.dtypes)['_id']}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    schema += ", runs array<struct<start:long,length:long,period:long>>, collapsed string" * with_text
    return kept.mapInArrow(scanned, schema).withColumnRenamed("_id", id_col)


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
