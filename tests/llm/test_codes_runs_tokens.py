"""Vector codes, periodic runs and token counts against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import periodic, tokencounts, vectorcodes
from panelweave.llm.queries import tokenizer_path

CLASH = ["_id", "_key", "_text", "_label", "_vector", "code", "error", "n_tokens", "runs", "start", "k"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH}).repartition(3)


# --- vector codes ------------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(id, code, error, label_error, digest) by trying every entry."""
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    cut = []
    for i, v, label in kept:
        whole = [math.floor(Fraction(x) * 256) for x in v]
        width = len(v) // parts
        cut.append((i, [tuple(whole[p * width : (p + 1) * width]) for p in range(parts)], label))
    first = sorted((x for x in cut if x[0] is not None), key=lambda x: (x[0], x[1]))[:entries]
    books = [[x[1][p] for x in first] for p in range(parts)]

    def nearest(part, vector):
        return min((sum((a - b) ** 2 for a, b in zip(vector, e, strict=True)), k) for k, e in enumerate(books[part]))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for x in cut:
                own[nearest(p, x[1][p])[1]].append(x[1][p])
            books[p] = [tuple(sum(c) // len(own[k]) for c in zip(*own[k], strict=True)) if k in own else e for k, e in enumerate(books[p])]
    digest = sha(",".join(str(c) for book in books for e in book for c in e))
    out = []
    for i, v, label in cut:
        found = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label, digest))
    total = defaultdict(int)
    for x in out:
        total[x[3]] += x[2]
    fits = lambda n: n if n < 1 << 63 else None
    return sorted(((i, c, fits(e), fits(total[label]), h) for i, c, e, label, h in out), key=str)


def codes_of(df, **settings):
    got = vectorcodes.vector_codes(df, **settings)
    return sorted((tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def vectors(spark, rows, kind="float"):
    return clashing(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int"))


def some_vectors(n, dims, seed, spread=4):
    rnd = random.Random(seed)
    return [(k, [rnd.randint(-spread, spread) / 8 for _ in range(dims)], k % 3 if k % 5 else None) for k in range(n)]


def test_vector_codes_equal_plain_version(spark):
    """Coarse components make many ties; bad vectors go, repeated rows and null ids stay."""
    rows = some_vectors(150, 8, 1)
    bad = [(900, None, 1), (901, [0.5] * 7 + [None], 1), (902, [math.nan] * 8, 1), (903, [math.inf] + [0.0] * 7, None), (904, [], 0)]
    rows += [*bad, rows[3], rows[3], (7, [0.25] * 8, 2), (None, [0.125] * 8, None)]
    assert codes_of(vectors(spark, rows), parts=4, entries=16) == plain_codes(rows, 4, 16)


def test_vector_codes_of_huge_components(spark):
    """Beyond 64 bits numbers stay exact; an error that no 64-bit number holds is null."""
    big = [float(np.float32(x)) for x in (3e38, -3e38, 1e20, -7e15, 2.0**23, 0.1)]
    rnd = random.Random(2)
    rows = [(k, [rnd.choice(big) for _ in range(4)], k % 2) for k in range(40)] + [(50 + k, [0.5, k / 256, 0.25, -k / 256], 5) for k in range(20)]
    got = codes_of(vectors(spark, rows), parts=2, entries=8)
    assert got == plain_codes(rows, 2, 8)
    assert any(r[2] is None for r in got) and any(r[2] is not None for r in got)


def test_vector_codes_of_few_and_no_vectors(spark):
    rows = some_vectors(5, 16, 3)
    assert codes_of(vectors(spark, rows)) == plain_codes(rows)
    assert codes_of(vectors(spark, rows, "double")) == plain_codes(rows)
    assert codes_of(vectors(spark, rows).where("false")) == []
    assert codes_of(vectors(spark, [(1, None, 1)])) == []
    with pytest.raises(ValueError, match="equal parts"):
        codes_of(vectors(spark, some_vectors(3, 15, 4)))


def test_vectors_of_another_length_are_left_out(spark):
    rows = some_vectors(20, 16, 5)
    assert codes_of(vectors(spark, [*rows, (99, [0.5] * 32, 1)])) == plain_codes(rows)


@pytest.mark.parametrize("spread", [1, 3, 300, 1 << 40])
def test_tree_finds_the_lowest_of_the_nearest_entries(spread):
    rng = np.random.default_rng(spread)
    entries, queries = rng.integers(-spread, spread + 1, (64, 3)), rng.integers(-spread, spread + 1, (400, 3))
    if spread > vectorcodes.EXACT:
        entries, queries = entries.astype(object), queries.astype(object)
    tree = vectorcodes.gnat(entries, np.arange(64), degree=4)
    index, square, measured = vectorcodes.nearest(tree, entries, queries)
    every = vectorcodes.squares(queries, entries)
    assert index.tolist() == [min(range(64), key=lambda k: (row[k], k)) for row in every.tolist()]
    assert square.tolist() == [min(row) for row in every.tolist()]
    assert measured < every.size


def test_tree_leaves_whole_subtrees_unmeasured():
    """Far groups of entries: a query measures little more than its own group."""
    rng = np.random.default_rng(8)
    entries = np.concatenate([rng.integers(0, 9, (8, 4)) + 10_000 * k for k in range(8)])
    queries = rng.integers(0, 9, (500, 4)) + 10_000 * rng.integers(0, 8, (500, 1))
    _, _, measured = vectorcodes.nearest(vectorcodes.gnat(entries, np.arange(64)), entries, queries)
    assert measured <= 500 * 16


def test_limbs_give_the_number_back():
    for x in (0, 1, -1, 1 << 40, -(1 << 40), int(256 * vectorcodes.LARGEST), -int(256 * vectorcodes.LARGEST)):
        parts = vectorcodes.limbs(x)
        assert sum(v << 32 * k for k, v in enumerate(parts)) == x and all(abs(v) < 1 << 33 for v in parts)


# --- periodic runs -----------------------------------------------------------------------------


def plain_runs(w, shortest, times):
    """Every diagonal of the text against itself, every smaller period tried."""
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            x = w[i : j + q]
            if j > i and len(x) >= max(shortest, times * q) and not any(x[d:] == x[:-d] for d in range(1, q)):
                out.append((i, len(x), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_scan(key, text, shortest=24, times=3, rewrite=True):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(("" if key is None else str(key)).encode())
    if rewrite and h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w, shortest, times)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    kept = " ".join(x.decode() for k, x in enumerate(w) if k not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (key, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed), sha(kept))


def wordy(rnd, length):
    w = []
    while len(w) < length:
        a = rnd.choice([1, 2, 3, 40])
        unit = [str(rnd.randrange(a)) for _ in range(rnd.randint(1, 30))]
        if rnd.random() < 0.3:
            unit = unit * 2 + ["x"]
        w += unit * rnd.choice([1, 1, 2, 3, 5]) + unit[: rnd.randint(0, len(unit))]
    return w


@pytest.mark.parametrize(("shortest", "times"), [(24, 3), (3, 3), (10, 4), (40, 3)])
def test_runs_equal_plain_version(shortest, times):
    rnd = random.Random(shortest * times)
    for _ in range(60):
        texts = [wordy(rnd, rnd.choice([0, 1, 30, 150])) for _ in range(3)]
        size = np.array([len(t) for t in texts])
        ends = np.cumsum(size)
        number = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
        words = np.array([number[w] for t in texts for w in t], np.int32)
        got = periodic.runs(words, np.repeat(np.arange(3), size), ends - size, ends, shortest, times)
        assert [got.get(k, []) for k in range(3)] == [plain_runs(t, shortest, times) for t in texts]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(11)
    rows = [(k, " ".join(wordy(rnd, 120))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "a " * 23), (105, "a " * 24), (106, "a b c " * 9), (107, "\xa0 b\x85 " * 30)]
    rows += [rows[0], rows[0], (0, "another text of the same id"), (None, "a b " * 20), (None, None)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string")).cache()


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("rewrite", [True, False])
def test_periodic_runs_equal_plain_version(texts, rewrite):
    got = sorted((tuple(r) for r in periodic.periodic_runs(texts, rewrite=rewrite).select(*COLUMNS).collect()), key=str)
    assert got == sorted((plain_scan(r.doc_id, r.text, rewrite=rewrite) for r in texts.collect()), key=str)
    assert any(r[1] > 1 for r in got) and periodic.periodic_runs(texts.where("false")).count() == 0


def test_collapsed_texts_and_batches_of_one_text(texts, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_BYTES", 1)
    rows = periodic.periodic_runs(texts, with_text=True).collect()
    assert all(sha(r.collapsed) == r.collapsed_sha256 and len(r.runs) == r.n_runs for r in rows)
    (r,) = [r for r in rows if r.doc_id == 105]
    assert (r.collapsed, [tuple(x) for x in r.runs]) == ("a", [(0, 24, 1)])


def test_one_word_a_million_times_and_a_long_period(spark):
    """A seed is extended once, so the work stays near the length of the text."""
    unit = [f"w{k}" for k in range(100_000)]
    rows = [(1, "spam " * 1_000_000), (2, " ".join(unit * 4)), (3, " ".join(x for k in range(20_000) for x in [f"s{k}"] * 25))]
    got = {r.doc_id: r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 1_000_000, 1)] and got[1].collapsed == "spam"
    assert [tuple(x) for x in got[2].runs] == [(0, 400_000, 100_000)] and got[2].collapsed == " ".join(unit)
    assert got[3].n_runs == 20_000 and got[3].exponent_milli == 25_000 and got[3].start == 0


def test_runs_need_three_periods(texts):
    with pytest.raises(ValueError, match="three periods"):
        periodic.periodic_runs(texts, times=2)


# --- token counts ------------------------------------------------------------------------------

PIECES = ["a", "the", " the", "Th", " ", "  ", "\n", "\n\n", "\t", "'", "'s", "'re", "'r", "'LL", "don't", "12", "3", ".", "..", "=====", "é", "ß", "²", "½", "\xa0", "\x85"]
PIECES += ["\x1c", " ", "　", "中文", "Ж", "😀", "“", "١", "́", "<|endoftext|>", "<|endof", "|>", "tokenization", "aaaaaaaa", "‍"]


@pytest.fixture(scope="module")
def counter():
    return tokencounts.PrefixCounter(tokenizer_path("byte_bpe_50k.json"))


def library_counts(counter, texts):
    return [len(e.ids) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_counts_as_the_library_does(counter):
    rnd = random.Random(4)
    for _ in range(400):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 20)))
        wanted = library_counts(counter, [text[: k + 1] for k in range(len(text))])
        assert counter.counts(text).tolist() == wanted, text


def test_every_character_has_the_class_the_library_gives(counter):
    """Each character of the basic plane and some beyond, before and after letters, digits, marks and blanks."""
    chars = [chr(c) for c in [*range(1, 0x3400), *range(0xA000, 0xA100), *range(0xF900, 0x10000, 7), *range(0x1F600, 0x1F620)]]
    texts = [f"ab{c}c1{c}2 {c}{c}. {c}" for c in chars]
    assert [int(counter.counts(t)[-1]) for t in texts] == library_counts(counter, texts)


def test_long_pieces_without_blanks(counter):
    rnd = random.Random(6)
    for text in ("=" * 3000, " " * 3000 + "x", "".join(rnd.choice("abcdefABC") for _ in range(20_000)), "ab1" * 5000):
        got = counter.counts(text)
        at = [0, 1, 63, 64, 500, len(text) - 1]
        assert [int(got[k]) for k in at] == library_counts(counter, [text[: k + 1] for k in at])


def test_token_counts_of_a_table(spark, counter):
    rnd = random.Random(9)
    rows = [(k, "".join(rnd.choice(PIECES) for _ in range(40))) for k in range(50)]
    rows += [(60, None), (61, ""), (62, "word " * 3000), (63, "é" * 200_000), rows[0], (0, "other"), (None, "null id"), (None, None)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    path = tokenizer_path("byte_bpe_50k.json")
    got = tokencounts.token_counts(docs, path, limit=20, with_prefixes=True)
    total = dict(zip([t for _, t in rows], library_counts(counter, [t or "" for _, t in rows]), strict=True))
    wanted = sorted(((d, len((t or "").encode()), total[t], total[t] > 20) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str) == wanted
    asked = got.select(
        "prefix_tokens", "n_tokens", "limit_chars", tokencounts.chars_within(F.col("prefix_tokens"), F.lit(20)).alias("cut"),
        *[tokencounts.tokens_before(F.col("prefix_tokens"), F.lit(n)).alias(f"b{n}") for n in (0, 3, 1 << 30)],
    )
    for r in asked.collect():
        table = r.prefix_tokens
        assert r.limit_chars == r.cut == max([k + 1 for k, n in enumerate(table) if n <= 20], default=0)
        assert (r.b0, r.b3, r[-1]) == (0, (table[min(3, len(table)) - 1] if table else 0), r.n_tokens)
    assert tokencounts.token_counts(docs.where("false"), path).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokencounts.PrefixCounter(tokenizer_path("word_bpe_49k.json"))
