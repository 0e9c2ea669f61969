"""Secret scan: strong patterns always, weak ones only where the parts of a credential stand together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.llm.common import let, null_safe, small, written

SEPARATOR = r"""["']?\x20*[:=]\x20*["']?"""
# Fixed patterns of the strong kinds, in their order.
STRONG = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)" + SEPARATOR + r"([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
}
# Weak kinds count only beside complementary parts.
WEAK = {
    "ident": r"(?i)(user_?name|user_?id|user|login|client_?id|account_?id|access_?key_?id|key_?id)" + SEPARATOR + r"([A-Za-z0-9@_.-]{3,})",
    "blob": r"[A-Za-z0-9+/]{30,}={0,2}",
    "short": STRONG["assign"],
    "endpoint": r"""(?i)(?:(?:https?|ftp|jdbc|postgres|mysql|mongodb|redis|amqp|s3)[a-z+]*://[^\x00-\x20"'<>]{4,}|(?:endpoint|host|server|base_?url)"""
    + SEPARATOR
    + r"[A-Za-z0-9:/_.-]{4,})",
}
KINDS = [*STRONG, *WEAK]
PART = {"assign": "secret", "access": "id", "hex": "secret", "ident": "id", "blob": "secret", "short": "secret", "endpoint": "endpoint"}
KEY = ["_id", "_hash"]


def valid(kind: str, text: Column, pattern: str) -> Column:
    """Which matches of the pattern count, in order."""
    if kind in ("assign", "short"):
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        return F.transform(value, lambda v: (F.char_length(v) >= 12) if kind == "assign" else F.char_length(v).between(6, 11))
    if kind == "blob":
        match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.transform(match, lambda v: v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]"))
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: F.lit(True))


def matches(text: Column, kind: str) -> Column:
    """Array of (kind, k, gap, length, ok) of the leftmost non-overlapping matches: gap is what stands before.

    Lengths of what lies between matches and of the matches themselves give positions without a
    function that reports them.
    """
    pattern = (STRONG | WEAK)[kind]
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
    lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p: F.char_length(p))
    made = F.transform(
        F.arrays_zip(lengths.alias("length"), F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gap"), valid(kind, text, pattern).alias("ok")),
        lambda x, k: F.struct(F.lit(kind).alias("kind"), k.alias("k"), x["gap"].alias("gap"), x["length"].alias("length"), x["ok"].alias("ok")),
    )
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast("array<struct<kind:string,k:int,gap:int,length:int,ok:boolean>>"))


def spans(docs: DataFrame, reach: int = 240, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _hash, kind, rank, start, end, strong): all spans of all documents that have any.

    Code points, end exclusive. A weak span stands if the parts it lacks lie within `reach` code
    points: an identifier needs a secret, a secret an identifier, an endpoint both. This is the
    interval join of parts with their neighbourhoods in as-of form: of each part kind only the
    nearest end before and the nearest start after can decide, which two ordered passes over a
    document's parts give. No pairs are made, however dense the parts. A blob may have any length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), text.alias("_t"))
    found = found.select(*KEY, F.explode(F.concat(*[matches(F.col("_t"), k) for k in KINDS])).alias("m")).select(*KEY, "m.*").distinct()
    so_far = Window.partitionBy(*KEY, "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    rank = F.element_at(F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)]), F.col("kind"))
    part = F.element_at(F.create_map(*[F.lit(x) for kv in PART.items() for x in kv]), F.col("kind"))
    rows = found.withColumn("end", end).where("ok").select(*KEY, "kind", rank.alias("rank"), part.alias("part"), (F.col("end") - F.col("length")).alias("start"), "end")
    strong = F.col("rank") < len(STRONG)

    # both as what came before in one of two orders: frames that reach to the end would be gone through for every row
    place = [F.col(c) for c in ("start", "end", "rank")]
    before, after = (
        Window.partitionBy(*KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1) for order in (place, [c.desc() for c in place])
    )

    def beside(kind: str) -> Column:
        last = F.max(F.when(F.col("part") == kind, F.col("end"))).over(before)
        following = F.min(F.when(F.col("part") == kind, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= reach, F.lit(False)) | F.coalesce(following - F.col("end") <= reach, F.lit(False))

    has_id, has_secret = beside("id"), beside("secret")
    linked = F.when(F.col("part") == "id", has_secret).when(F.col("part") == "secret", has_id).otherwise(has_id & has_secret)
    return rows.withColumn("linked", linked).where(strong | F.col("linked")).select(*KEY, "kind", "rank", F.col("start").cast("long"), F.col("end").cast("long"), strong.alias("strong"))


def secret_spans(docs: DataFrame, reach: int = 240, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its spans as an array of (start, rank, end, kind), in order; empty where there are none.

    A null text is empty. Rows with one id are told apart by their texts. An empty table gives no rows.
    """
    rows = spans(docs, reach, id_col, text_col).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans"))
    thin = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"))
    joined = thin.join(rows, null_safe(thin, rows, KEY), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return joined.select(thin["_id"].alias(id_col), thin["_hash"].alias("text_hash"), F.coalesce("spans", none).alias("spans"))


def joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def merged_spans(found: DataFrame) -> DataFrame:
    """(_id, _hash, cuts): per document the stretches that spans cover, in order; spans that overlap are one stretch."""
    order = Window.partitionBy(*KEY).orderBy("start", "end")
    so_far = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = found.withColumn("opens", F.when(F.coalesce(F.col("start") >= so_far, F.lit(True)), 1).otherwise(0))
    numbered = opens.withColumn("stretch", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = numbered.groupBy(*KEY, "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return stretches.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))


def cut_out(text: Column, cuts: Column, mark: str) -> Column:
    """The text with every stretch replaced by the mark.

    Four bytes a code point make a place a byte offset, so each piece is copied once and nothing else is
    walked: the work is in proportion to the text, however many stretches it has.
    """

    def piece(raw: Column, start: Column, end: Column) -> Column:
        return F.decode(F.substring(raw, (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")), "UTF-32")

    def rebuilt(raw: Column) -> Column:
        last = F.element_at(cuts, -1)["end"]
        before = F.transform(cuts, lambda x, i: piece(raw, F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0).cast("long")), x["start"]))
        return F.concat(F.array_join(F.concat(before, F.array(F.lit(""))), mark), piece(raw, last, F.octet_length(raw) / 4))

    return let(F.encode(text, "UTF-32"), rebuilt)


def redacted(docs: DataFrame, reach: int = 240, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by `mark`, overlapping spans as one; other columns as they were.

    A null text stays null. Texts may be long and full of spans: the work grows with the text alone.
    """
    rows = small(written(merged_spans(spans(docs, reach, id_col, text_col)), "spans"), weight=F.size("cuts"))
    text = docs[f"`{text_col}`"]
    joined = docs.join(rows, docs[f"`{id_col}`"].eqNullSafe(rows["_id"]) & (F.xxhash64(text) == rows["_hash"]), "left")
    new = F.when(rows["cuts"].isNull(), text).otherwise(cut_out(text, rows["cuts"], mark))
    return joined.select(*[new.alias(c) if c == text_col else docs[f"`{c}`"] for c in docs.columns])
