"""Benchmark decontamination: a prefix-filtered join of item windows with documents, checked word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelweave.llm.common import NOT_WORD, lower_az, null_safe, small, without_rows, words, written

KEY = ["_id", "_hash"]  # a document: its id and the hash of its text, as ids may be null or repeated


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, win): the windows of `window` words of every item; shorter items are one window."""
    arr = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
        F.inline(F.array(F.struct(words(lower_az(F.col(text_col)), NOT_WORD).alias("w")))),
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return arr.select("item", "w", F.explode(starts).alias("k")).select("item", F.slice("w", F.col("k"), window).alias("win")).distinct()


def shingle_hash(size: int, arr: str, at: Column) -> Column:
    return F.xxhash64(F.lit(size), F.slice(arr, at, size))


def document_shingles(docs: DataFrame, sizes: list[int], reach: int, id_col: str, text_col: str) -> DataFrame:
    """One row per word of a document: the hashes of the shingles that start there, and the words around.

    `near` holds at most `reach` words before position i and `reach` from it on, so a row stays small
    wherever it is sent. Inside one stage it is only built for rows that a join keeps.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("_hash"),
        F.inline(F.array(F.struct(words(lower_az(F.col(text_col)), NOT_WORD).alias("w")))),
    )
    rows = rows.where(F.size("w") >= min(sizes)).select(*KEY, "w", F.explode(F.sequence(F.lit(1), F.size("w") - min(sizes) + 1)).alias("i"))
    if len(sizes) == 1:
        h = shingle_hash(sizes[0], "w", F.col("i"))
    else:
        fits = [F.when(F.col("i") <= F.size("w") - s + 1, shingle_hash(s, "w", F.col("i"))) for s in sizes]
        h = F.explode(F.array_compact(F.array(*fits)))
    first = F.greatest(F.col("i") - reach, F.lit(1))
    return rows.select(*KEY, "i", h.alias("h"), (F.col("i") - first).alias("before"), F.slice("w", first, 2 * reach).alias("near"))


def occurrences(docs: DataFrame, wins: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, _hash, start, win): every place where a window's words stand in a document, start from 1.

    Shingles of a window are ordered by how often they occur in the documents. Containment of the
    whole window leaves a prefix of one: its rarest shingle. Only that one is joined; a window with
    a shingle that no document has is out before. The join gives where the window would have to
    start; bounds and then the words themselves decide. The shingle tables are broadcast
    while their counted rows are few, and joined by shuffle beyond that.
    """
    only = wins.select("win").distinct()
    size = F.least(F.size("win"), F.lit(shingle))
    sizes = sorted(r[0] for r in only.select(size.alias("s")).distinct().collect())  # `shingle` values at most
    if not sizes:
        return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.lit(1).alias("start"), F.array(F.lit("")).alias("win")).where("false")
    places = only.select("win", size.alias("s"), F.explode(F.sequence(F.lit(1), F.size("win") - size + 1)).alias("place"))
    hashed = F.lit(None).cast("long")
    for s in sizes:
        hashed = F.when(F.col("s") == s, shingle_hash(s, "win", F.col("place"))).otherwise(hashed)
    tokens = written(places.select("win", "place", hashed.alias("h")), "window-shingles")

    shingles = document_shingles(docs, sizes, window, id_col, text_col)
    counts = shingles.join(small(written(tokens.select("h").distinct(), "shingles")), "h", "left_semi").groupBy("h").agg(F.count("*").alias("n"))
    counts = written(counts, "shingle-counts")
    rarest = (
        tokens.join(counts, "h", "left")
        .groupBy("win")
        .agg(F.min_by(F.struct("h", "place"), F.struct("n", "place")).alias("t"), F.count_if(F.col("n").isNull()).alias("absent"))
        .where("absent = 0")
        .select("win", "t.h", "t.place")
    )
    rarest = written(rarest, "rarest-shingles")
    found = shingles.join(small(rarest), "h").withColumn("back", F.col("place") - 1)
    fits = (F.col("before") >= F.col("back")) & (F.size("near") - F.col("before") + F.col("back") >= F.size("win"))
    same = F.slice("near", F.greatest(F.col("before") - F.col("back") + 1, F.lit(1)), F.size("win")) == F.col("win")
    return found.where(fits & same).select(*KEY, (F.col("i") - F.col("back")).alias("start"), "win")


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurrence of any item window), the items that occur.

    A null or empty text has no words and no hits; an item without words is ignored and a null item id is
    the text "null". Rows with one id are told apart by their texts, so repeated rows each get their
    own full result. Empty documents give no rows, an empty benchmark gives zeros.
    """
    wins = written(item_windows(items, window, item_id, item_text), "windows")
    hits = written(occurrences(docs, wins, window, shingle, id_col, text_col).distinct(), "hits")
    end = F.col("start") + F.size("win")
    earlier = Window.partitionBy(*KEY).orderBy("start", F.size("win")).rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(earlier), F.col("start"))), F.lit(0))
    covered = hits.withColumn("fresh", fresh).groupBy(*KEY).agg(F.sum("fresh").alias("n_hit"))
    named = hits.select(*KEY, "win").distinct().join(wins, "win").select(*KEY, "item").distinct()
    named = named.groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items"))
    per_doc = covered.join(named, null_safe(covered, named, KEY)).select(*[covered[k] for k in KEY], "n_hit", "items")
    thin = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.size(words(lower_az(F.col(text_col)), NOT_WORD)).cast("long").alias("n_words"))
    joined = thin.join(per_doc, null_safe(thin, per_doc, KEY), "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(thin["_id"].alias(id_col), thin["_hash"].alias("text_hash"), "n_words", hit.alias("n_hit"), items_.alias("items"), (hit > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which no item window occurs, all columns as they were."""
    wins = written(item_windows(items, window, "item_id", "text"), "windows")
    hits = occurrences(docs, wins, window, shingle, id_col, text_col).select("_id", F.col("_hash").alias("text_hash"))
    return without_rows(docs, small(written(hits.distinct(), "contaminated")), id_col, text_col)
