"""Plain versions of the operators' contracts, one document at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CHUNK = re.compile(r"[^\x20\x09-\x0D]+")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def contamination(docs, items, size=10):
    wins = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1)) if w else []:
            wins[tuple(w[k : k + size])].add(str(item))
    lengths = {len(x) for x in wins}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[x]
        out.append((doc, len(w), len(hit), len(found), sha256(",".join(sorted(found))), bool(hit)))
    return out


def quality(text):
    text = text or ""
    w = CHUNK.findall(text)
    n_symbols = len(re.findall(r"[#*$%&|<>]", text))
    lines = [x for x in text.split("\n") if CHUNK.search(x)]
    at = defaultdict(list)
    for k in range(len(w) - 4):
        at[tuple(w[k : k + 5])].append(k)
    inside = {p for x in at.values() if len(x) > 1 for k in x for p in range(k, k + 5)}
    n = len(w)
    failed = n < 10 or 100 * len(inside) > 20 * n
    return n, sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(inside), failed


def secrets(text):
    text = text or ""
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    found.sort()
    kinds = Counter(x[3] for x in found)
    return kinds["assign"], kinds["access"], kinds["hex"], sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in found))


def licenses(text):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    w = words(text)
    starts, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        starts += here
        if here:
            labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def linked_secrets(text, patterns, part, reach):
    """All spans: strong ones, and weak ones with their complement within reach, every pair of spans tried."""
    kinds = list(patterns)
    found = []
    for rank, kind in enumerate(kinds):
        for m in re.finditer(patterns[kind], text, re.ASCII):
            if kind == "assign" and len(m[2]) < 12 or kind == "short" and not 6 <= len(m[2]) <= 11:
                continue
            if kind == "blob" and not all(re.search(c, m[0]) for c in ("[A-Z]", "[a-z]", "[0-9]")):
                continue
            found.append((m.start(), m.end(), rank, kind))
    found.sort()

    def beside(i, wanted):
        start, end = found[i][:2]
        before = any(part[x[3]] == wanted and start - x[1] <= reach for x in found[:i])
        return before or any(part[x[3]] == wanted and x[0] - end <= reach for x in found[i + 1 :])

    needs = {"id": ["secret"], "secret": ["id"], "endpoint": ["id", "secret"]}
    kept = [x for i, x in enumerate(found) if x[2] < 3 or all(beside(i, w) for w in needs[part[x[3]]])]
    return [(k, s, e) for s, _, e, k in sorted((s, rank, e, k) for s, e, rank, k in kept)]


def cut_out(text, spans, mark):
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def lm_scores(docs, folds, held_out, fine, floor):
    """(id, tokens, known tokens, score): words, pairs and a uniform share, mixed by buckets of the context's count."""
    texts = [(d, [w.decode() for w in (t or "").encode().lower().split()] + [""]) for d, t in docs]
    learn = [zlib.crc32(("" if d is None else str(d)).encode()) % folds != held_out for d, _ in texts]
    word, pair = Counter(), Counter()
    for (_, w), own in zip(texts, learn, strict=True):
        if own:
            word.update(w)
            pair.update(zip([None, *w], w, strict=False))
    word[None] = sum(learn)
    n, v = sum(k for w, k in word.items() if w is not None), sum(k > 0 for w, k in word.items() if w is not None)

    def bucket(c):
        return c.bit_length() if c > 0 else 0

    def coarse(p):
        """The estimate on the histogram's grid."""
        return 10.0 ** -(min(round(-math.log10(p) * fine), floor - 1) / fine) if p > 0 else 0.0

    cells = defaultdict(Counter)
    for (_, w), own in zip(texts, learn, strict=True):
        for h, x in zip([None, *w], w, strict=False) if own else []:
            c = word[h] - 1
            cells[bucket(c)][coarse((pair[h, x] - 1) / max(c, 1)), coarse((word[x] - 1) / max(n - 1, 1))] += 1
    weights, last = {}, None
    for b in range(65):
        if cells.get(b):
            m = [0.0, 0.5, 0.5] if b == 0 else [1 / 3] * 3
            for _ in range(100):
                sums = [0.0] * 3
                for (p2, p1), k in cells[b].items():
                    share = [a * q for a, q in zip(m, (p2, p1, 1 / (v + 1)), strict=True)]
                    sums = [a + k * s / sum(share) for a, s in zip(sums, share, strict=True)]
                m = [s / sum(cells[b].values()) for s in sums]
            m = [max(x, low) for x, low in zip(m, (0.0 if b == 0 else 1e-9, 1e-9, 1e-6), strict=True)]
            last = [x / sum(m) for x in m]
        weights[b] = last or [0.0, 0.9, 0.1]
    out = []
    for d, w in texts:
        score = 0.0
        for h, x in zip([None, *w], w, strict=False):
            a, b, c = weights[bucket(word[h])]
            score += math.log10(a * pair[h, x] / max(word[h], 1) + b * word[x] / max(n, 1) + c / (v + 1))
        out.append((d, len(w), sum(word[x] > 0 for x in w), score))
    return out


def weak_labels(votes, bad, good):
    """(share of good, accuracies, posterior of every row): expectation-maximisation, row by row."""
    k = len(votes[0])
    sign = [[1 if v == good else -1 if v == bad else 0 for v in row] for row in votes]
    p = [1 / (1 + math.exp(-2 * sum(row))) for row in sign]
    for _ in range(200):
        prior = min(max((sum(p) + 1) / (len(p) + 2), 0.5), 0.95)
        accuracy = []
        for j in range(k):
            right = sum(q if row[j] > 0 else 1 - q for row, q in zip(sign, p, strict=True) if row[j])
            accuracy.append(min(max((right + 8) / (sum(row[j] != 0 for row in sign) + 10), 0.6), 0.995))
        log = [math.log(a / (1 - a)) for a in accuracy]
        new = [1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(s * x for s, x in zip(row, log, strict=True))))) for row in sign]
        done = max(abs(a - c) for a, c in zip(new, p, strict=True)) < 1e-9
        if done:
            break
        p = new
    return prior, accuracy, p
