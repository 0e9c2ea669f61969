"""Host-level quality rules: failures by host, rates shrunk by an empirical beta prior, verdicts joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import SPACE, let, words, written

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def repeated_words(hashes: Column) -> Column:
    """How many words lie in windows that occur twice, from the hashes of the windows in order.

    Windows are sorted by hash with their places; neighbours with one hash are repeats; their places in
    order then cover min(window, gap) new words each. All of it is n log n within the row, and only
    texts that have a repeat come here.
    """

    def places(p: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            return F.get(p, k - 1)["h"].eqNullSafe(x["h"]) | F.get(p, k + 1)["h"].eqNullSafe(x["h"])

        return F.sort_array(F.transform(F.filter(p, again), lambda x: x["i"]))

    sorted_ = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        let(sorted_, places),
        state,
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )


def features(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *keep,
        F.inline(
            F.array(
                F.struct(
                    words(text, SPACE).alias("_w"),
                    F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
                )
            )
        ),
    )
    starts = F.sequence(F.lit(1), F.size("_w") - WINDOW + 1)
    hashes = F.when(F.size("_w") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("_w", i, WINDOW)))).otherwise(F.array().cast("array<long>"))
    rows = rows.select(
        *keep,
        "n_symbols",
        F.inline(
            F.array(
                F.struct(
                    F.size("_w").cast("long").alias("n_words"),
                    F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                    F.size("_lines").cast("long").alias("n_lines"),
                    (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                    hashes.alias("_h"),
                )
            )
        ),
    )
    repeats = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), repeated_words(F.col("_h"))).otherwise(F.lit(0).cast("long"))
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", repeats.alias("n_repeat_words"))


def rule_failures() -> dict[str, Column]:
    """The rules of a document; the first two are the base."""
    n = F.col("n_words")
    return {
        "short": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": F.col("n_symbols") > 0.1 * n,
        "dup_lines": F.col("n_dup_lines") > 0.3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n),
    }


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(a, b) of the beta distribution of host rates, by moments over all hosts.

    What binomial noise explains is taken off the spread; without any spread the prior is as strong
    as a million documents, without any host it is uniform.
    """
    p = F.col("failed") / F.col("n")
    row = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count("*").alias("k"), F.sum(F.col("n") * p * p).alias("square")).first()
    if not row["n"]:
        return 1.0, 1.0
    mean = (row["failed"] + 0.5) / (row["n"] + 1)
    noise = mean * (1 - mean) * row["k"] / row["n"]
    spread = row["square"] / row["n"] - (row["failed"] / row["n"]) ** 2 - noise
    strength = min(max(mean * (1 - mean) / spread - 1, 2.0), 1e6) if spread > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def host_quality(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", limit: float = 0.5, salts: int = 64) -> DataFrame:
    """Per document the counts, each rule's failure, its host's shrunk failure rate, and `kept`.

    A host is rejected if its shrunk rate of documents that fail any rule exceeds `limit`; kept is
    false for documents that fail a base rule or stand on a rejected host. A null host is a host of
    its own; a null text has no words and fails; repeated rows count each. Failures are added up by
    host and salt before the shuffle, and verdicts are joined back by host and salt, so one host
    with a third of all documents is spread over many tasks.
    """
    rows = features(docs.select(F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("_host"), text_col), ["_id", "_host"], text_col)
    rules = rule_failures()
    rows = rows.withColumns({f"fails_{k}": v for k, v in rules.items()})
    any_rule = F.greatest(*[F.col(f"fails_{k}").cast("int") for k in rules])
    rows = rows.withColumns({"_failed": any_rule, "_salt": F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"), "_host": F.coalesce(F.concat(F.lit("="), F.col("_host")), F.lit(""))})
    rows = written(rows, "quality")
    partial = rows.groupBy("_host", "_salt").agg(F.count("*").alias("n"), F.sum("_failed").alias("failed"))
    hosts = written(partial.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.collect_list("_salt").alias("salts")), "hosts")
    a, b = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    verdicts = hosts.select("_host", rate.alias("host_rate"), F.explode("salts").alias("_salt"))
    base = F.col("fails_short") | F.col("fails_repeats")
    out = rows.join(verdicts, ["_host", "_salt"], "left")
    return out.select(
        F.col("_id").alias(id_col),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        base.alias("base_failed"),
        (~base & (F.col("host_rate") <= limit)).alias("kept"),
        "host_rate",
        *[f"fails_{k}" for k in rules],
    )
