"""Exact token counts of every prefix of a text, by dynamic programming over its characters.

A merge encoding is valid exactly when each of its tokens and each pair of neighbours is. So the encoding of a
prefix is that of a shorter prefix and one last token, and there is only one such token: the table of last
tokens grows by one character at a time and never goes back. The splitting rule of the tokenizer cuts a text
into stretches whose counts do not depend on what stands around them; their tables are kept by
stretch and joined. The table of a text then answers how many tokens any of its prefixes has, and how
long a prefix a budget of tokens allows, without encoding again.
"""

from __future__ import annotations

import json
import re
from array import array
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CACHE_STRETCHES = 600_000  # stretches whose tables a task keeps; a cache only, the counts don't depend on it
CACHE_LENGTH = 64  # longer stretches are not kept

# The classes of the splitting rule for the first 256 characters; fixed values.
SPACE = r"\x09-\x0D\x20\x85\xA0"
LETTER = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\xFF"
DIGIT = r"0-9\xB2\xB3\xB9\xBC-\xBE"
OTHER = rf"[^{SPACE}{LETTER}{DIGIT}]"
ENDING = "'(?:s|t|re|ve|m|ll|d)"
TWO_LETTER_ENDINGS = {"'re", "'ve", "'ll"}
# White space and what follows it. A word takes one blank before it, so an ending stands only where none does.
STRETCH = re.compile(
    rf"[{SPACE}]*\x20(?:[{LETTER}]+|[{DIGIT}]+|{OTHER}+)|[{SPACE}]*(?:{ENDING}|[{LETTER}]+|[{DIGIT}]+|{OTHER}+)|[{SPACE}]+"
)
RUN = re.compile(rf"[{SPACE}]*")
STAND_IN = {"letter": "\xff", "digit": "\xb2", "other": "\xa1", "space": "\x85"}


def byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable, else the next from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class PrefixCounter(dict):
    """Tables of prefix counts by one byte-level tokenizer file; the dict holds those of stretches met before.

    A table is the differences of the counts from one character to the next, as 32-bit numbers. A file
    whose rules differ from those this relies on (normaliser, splitting, added tokens, merges) is refused.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import ahocorasick
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        split, model, added = rules["pre_tokenizer"] or {}, rules["model"], rules["added_tokens"]
        plain = [not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        same = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
        bare = all(not t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if rules["normalizer"] or model["type"] != "BPE" or not (all(plain) and same and bare):
            raise ValueError(f"{path} is no plain byte-level tokenizer: its prefixes cannot be counted this way")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.machine = ahocorasick.Automaton()
        for token in self.vocabulary:
            self.machine.add_word(token, token)
        self.machine.make_automaton()
        self.runs: dict[str, list[int]] = {}
        self.merge = self.tokenizer.model.tokenize
        self.pairs: dict[tuple[str, str], bool] = {}  # whether a token stays as it is after another
        self.letters = byte_letters()
        self.classes: dict[int, str] = {}
        contents = [t["content"] for t in added]
        self.special = re.compile("|".join(map(re.escape, sorted(contents, key=len, reverse=True)))) if contents else None

    # --- the table of one piece ---

    def piece(self, text: str) -> list[int]:
        """Tokens of every prefix of a piece that the splitting rule leaves whole, from its first character on.

        One pass of an automaton names the tokens that end at each place; the one that stays as it is after
        the last token of what stands before it is the last token there.
        """
        pairs, merge = self.pairs, self.merge
        if len(pairs) > CACHE_STRETCHES:
            pairs.clear()
        raw = text.encode()
        letters = "".join(map(self.letters.__getitem__, raw))
        last, count = [""] * (len(raw) + 1), [0] * (len(raw) + 1)
        for end, token in self.machine.iter(letters):
            end += 1
            if count[end]:
                continue
            start = end - len(token)
            before = last[start]
            fits = pairs.get((before, token))
            if fits is None:
                parts = [t.value for t in merge(before + token)]
                fits = pairs[before, token] = parts == ([before, token] if before else [token])
            if fits:
                last[end], count[end] = token, count[start] + 1
        if not all(count[1:]):
            raise ValueError(f"no last token for {text!r}")
        if len(raw) == len(text):
            return count[1:]
        ends = [k for k in range(1, len(raw) + 1) if k == len(raw) or raw[k] & 0xC0 != 0x80]
        return [count[k] for k in ends]

    def run(self, blanks: str) -> list[int]:
        """The same for white space, which is often the same."""
        found = self.runs.get(blanks)
        if found is None:
            found = self.piece(blanks)
            if len(blanks) <= CACHE_LENGTH:
                self.runs[blanks] = found
        return found

    # --- the table of one stretch ---

    def __missing__(self, stretch: str) -> bytes:
        blank = RUN.match(self.classed(stretch)).end()
        blanks, rest = stretch[:blank], stretch[blank:]
        counts = list(self.run(blanks)) if blanks else []  # white space at the end of a prefix is one piece
        if rest:
            if blanks[-1:] == " ":
                own, base = self.piece(" " + rest)[1:], self.run(blanks[:-1])[-1] if blank > 1 else 0
            else:
                base = self.run(blanks[:-1])[-1] if blank > 1 else 0
                base += self.run(blanks[-1])[-1] if blanks else 0
                own = self.piece(rest)
                if len(rest) == 3 and rest in TWO_LETTER_ENDINGS:  # its first two characters are no ending yet
                    own[1] = self.piece(rest[0])[-1] + self.piece(rest[1])[-1]
            counts += [base + c for c in own] if base else own
        table = array("i", map(sub, counts, [0, *counts])).tobytes()
        if len(stretch) <= CACHE_LENGTH:
            self[stretch] = table
        return table

    # --- classes of characters beyond the first 256, as the tokenizer itself sees them ---

    def class_of(self, char: str) -> str:
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for kind, mate in (("letter", "a"), ("digit", "1"), ("other", ".")):
            if len(split(mate + char)) == 1:
                return kind
        return "space"

    def classed(self, text: str) -> str:
        """The text with a stand-in of the same class for every character beyond the first 256."""
        if text.isascii():
            return text
        for char in set(text):
            if ord(char) > 255 and ord(char) not in self.classes:
                self.classes[ord(char)] = STAND_IN[self.class_of(char)]
        return text.translate(self.classes)

    # --- whole texts ---

    def stretches(self, text: str) -> list[str]:
        if text.isascii():
            return STRETCH.findall(text)
        classed = self.classed(text)
        if classed == text:
            return STRETCH.findall(text)
        return [text[m.start() : m.end()] for m in STRETCH.finditer(classed)]

    def plain(self, text: str) -> np.ndarray:
        """Counts of all prefixes of a text without added tokens."""
        if len(self) > CACHE_STRETCHES:
            self.clear()
            self.runs.clear()
        return np.cumsum(np.frombuffer(b"".join(map(self.__getitem__, self.stretches(text))), "<i4"), dtype=np.int32)

    def counts(self, text: str) -> np.ndarray:
        """Counts of all prefixes of a text, from its first character to its last.

        An added token counts as one where it stands whole; cut short, it is text like any other.
        """
        found = list(self.special.finditer(text)) if self.special else []
        if not found:
            return self.plain(text)
        out, at, base = [], 0, 0
        for m in found:
            before = m.start() - at
            part = self.plain(text[at : m.end() - 1]) + base
            base = (int(part[before - 1]) if before else base) + 1
            out += [part, np.array([base], np.int32)]
            at = m.end()
        return np.concatenate([*out, self.plain(text[at:]) + base])


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_prefixes: bool = False) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, limit_chars) of every document, read off its table of prefix counts.

    limit_chars: characters of the longest prefix of at most `limit` tokens, where the text may be cut. With
    with_prefixes also the table itself, `prefix_tokens`: an entry for every character. A null text is
    empty; an empty one has no tokens and an empty table. Repeated rows are counted each; other columns are not
    read; an empty table gives no rows. Texts are counted whole, one at a time, in memory that
    grows with the longest text and not with the number of texts. Ties cannot occur: a text has one encoding.
    """

    kept_by_worker = docs.sparkSession.sparkContext.broadcast({})  # empty here: a worker keeps its tables from task to task

    def counted(batches):
        counter = kept_by_worker.value.get(path)
        if counter is None:
            counter = kept_by_worker.value[path] = PrefixCounter(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                size, total, cut, tables = [], [], [], []
                for text in part.column("_text").to_pylist():
                    text = text or ""
                    table = counter.counts(text)
                    size.append(len(text) if text.isascii() else len(text.encode()))
                    total.append(int(table[-1]) if len(table) else 0)
                    within = np.flatnonzero(table <= limit) if len(table) and table.max() > limit else None
                    cut.append(len(table) if within is None else int(within[-1]) + 1 if len(within) else 0)
                    tables.append(table)
                columns = [part.column("_id"), *(pa.array(x, pa.int64()) for x in (size, total)), pa.array([n > limit for n in total]), pa.array(cut, pa.int64())]
                names = ["_id", "n_bytes", "n_tokens", "over_limit", "limit_chars"]
                if with_prefixes:
                    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tables])])
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *tables]))))
                    names.append("prefix_tokens")
                yield pa.RecordBatch.from_arrays(columns, names)

    kept = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    schema = f"_id {dict(kept.dtypes)['_id']}, n_bytes long, n_tokens long, over_limit boolean, limit_chars long" + ", prefix_tokens array<int>" * with_prefixes
    return kept.mapInArrow(counted, schema).withColumnRenamed("_id", id_col)


def tokens_before(table: Column, chars: Column) -> Column:
    """Tokens of the first `chars` characters, from a stored table; the whole text's beyond its end."""
    return F.when(chars <= 0, 0).otherwise(F.coalesce(F.get(table, F.least(chars, F.size(table)).cast("int") - 1), F.lit(0)))


def chars_within(table: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most `budget` tokens, from a stored table."""
    return F.coalesce(F.array_max(F.filter(F.transform(table, lambda n, k: F.when(n <= budget, k + 1)), lambda x: x.isNotNull())), F.lit(0))
