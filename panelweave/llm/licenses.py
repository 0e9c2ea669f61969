"""License scan: ordered signature rules behind a keyword filter, contained detections suppressed."""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from panelweave.llm.signatures import signatures

# Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# What stands before a version's number, with or without the word; without it, not the next point of a numbered list.
V = r"(?:[\s,(-]*(?:version|v\.?)[\s-]*|(?![^\S\n]*\n\s*\d+[.)](?!\d))[\s,(-]*)"
GNU = r"(?:gnu\s+)?"

# label; words without white space, one of which stands in every match of its name; its name; its address.
# {label} is the public short identifier in lower case. Versioned families are written once per version by family().
NAMES: list[tuple[str, str, str, str]] = []


def family(label: str, words: str, name: str, address: str, versions: dict[str, str]) -> None:
    """One entry per version: # in the templates stands for the version's pattern."""
    for version, pattern in versions.items():
        NAMES.append((label.replace("#", version), words, name.replace("#", pattern), address.replace("#", re.escape(version.removesuffix(".0")) + r"(?:\.0)?")))


NUMBER = {v: re.escape(v).removesuffix(r"\.0") + r"(?:\.0)?(?![\d.]*\d)" for v in ("1.0", "2.0", "3.0", "4.0")}
family("agpl-#", "affero", GNU + r"affero\s+general\s+public\s+licen[cs]e" + V + "#", r"gnu\.org/licenses/agpl-#", {v: NUMBER[v] for v in ("1.0", "3.0")})
family("lgpl-#", "lesser library", GNU + r"(?:lesser|library)\s+general\s+public\s+licen[cs]e" + V + "#", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-#", {"2.0": NUMBER["2.0"], "2.1": r"2\.1", "3.0": NUMBER["3.0"]})
family("gpl-#", "gnu", r"gnu\s+general\s+public\s+licen[cs]e" + V + "#", r"gnu\.org/licenses/(?:old-licenses/)?gpl-#", {v: NUMBER[v] for v in ("1.0", "2.0", "3.0")})
family("gfdl-#", "documentation", GNU + r"free\s+documentation\s+licen[cs]e" + V + "#", r"gnu\.org/licenses/(?:old-licenses/)?fdl-#", {"1.1": r"1\.1", "1.2": r"1\.2", "1.3": r"1\.3"})
family("apache-#", "apache", r"apache\s+(?:software\s+)?licen[cs]e" + V + "#", r"apache\.org/licenses/license-#", {"1.0": r"1\.0", "1.1": r"1\.1", "2.0": NUMBER["2.0"]})
family("mpl-#", "mozilla", r"mozilla\s+public\s+licen[cs]e" + V + "#", r"mozilla\.org/mpl/#", {"1.0": r"1\.0", "1.1": r"1\.1", "2.0": NUMBER["2.0"]})
family("epl-#", "eclipse", r"eclipse\s+public\s+licen[cs]e" + V + "(?:-\\s*v\\s*)?#", r"eclipse\.org/legal/epl-v?#", {v: NUMBER[v] for v in ("1.0", "2.0")})
family("eupl-#", "european", r"european\s+union\s+public\s+licen[cs]e" + V + "#", r"joinup\.ec\.europa\.eu/\S*eupl\S*#", {"1.0": r"1\.0", "1.1": r"1\.1", "1.2": r"1\.2"})
family("osl-#", "licen", r"open\s+software\s+licen[cs]e" + V + "#", r"opensource\.org/licenses/osl-#", {"1.0": r"1\.0", "2.0": r"2\.0", "2.1": r"2\.1", "3.0": NUMBER["3.0"]})
family("afl-#", "academic", r"academic\s+free\s+licen[cs]e" + V + "#", r"opensource\.org/licenses/afl-#", {"1.2": r"1\.2", "2.0": r"2\.0", "2.1": r"2\.1", "3.0": NUMBER["3.0"]})
family("artistic-#", "artistic", r"artistic\s+licen[cs]e" + V + "#", r"opensource\.org/licenses/artistic-(?:license-)?#", {v: NUMBER[v] for v in ("1.0", "2.0")})
family("lppl-#", "latex", r"latex\s+project\s+public\s+licen[cs]e" + V + "#", r"latex-project\.org/lppl/lppl-#", {"1.0": r"1\.0", "1.1": r"1\.1", "1.2": r"1\.2", "1.3c": r"1\.3c"})
family("cddl-#", "licen", r"common\s+development\s+and\s+distribution\s+licen[cs]e" + V + "#", r"opensource\.org/licenses/cddl-?#", {"1.0": r"1\.0", "1.1": r"1\.1"})
family("cecill-#", "cecill", r"cecill(?:\s+free\s+software\s+licen[cs]e(?:\s+agreement)?)?" + V + "#", r"cecill\.info/licences/licence_cecill_v#", {"1.0": r"1\.0", "2.0": r"2\.0", "2.1": r"2\.1"})
family("ofl-#", "font", r"(?:sil\s+)?open\s+font\s+licen[cs]e" + V + "#", r"scripts\.sil\.org/ofl", {"1.0": r"1\.0", "1.1": r"1\.1"})
family("zpl-#", "zope", r"zope\s+public\s+licen[cs]e" + V + "#", r"zope\.org/resources/zpl-?#", {"1.1": r"1\.1", "2.0": r"2\.0", "2.1": r"2\.1"})
family("php-#", "php", r"php\s+licen[cs]e" + V + "#", r"php\.net/license/#", {"3.0": r"3\.0(?!1)", "3.01": r"3\.01"})
family("odbl-#", "database", r"open\s+(?:data\s+commons\s+open\s+)?database\s+licen[cs]e" + V + "#", r"opendatacommons\.org/licenses/odbl/#", {"1.0": r"1\.0"})
for terms, spoken in {
    "by": "attribution",
    "by-sa": r"attribution[\s-]+share[\s-]?alike",
    "by-nd": r"attribution[\s-]+no[\s-]?deriv(?:ative)?s?",
    "by-nc": r"attribution[\s-]+non[\s-]?commercial",
    "by-nc-sa": r"attribution[\s-]+non[\s-]?commercial[\s-]+share[\s-]?alike",
    "by-nc-nd": r"attribution[\s-]+non[\s-]?commercial[\s-]+no[\s-]?deriv(?:ative)?s?",
}.items():
    for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        short = terms.replace("-", r"[\s-]")
        number = re.escape(version)
        NAMES.append((f"cc-{terms}-{version}", "cc creative", rf"(?:\bcc[\s-]{short}|creative\s+commons\s+{spoken})(?:\s+(?:\d\.\d\s+)?international|\s+licen[cs]e)?{V}{number}", rf"creativecommons\.org/licenses/{terms}/{number}"))
NAMES += [
    ("cc0-1.0", "cc0", r"\bcc0(?:\s+1\.0)?(?:\s+universal)?", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("mit", "licen", r"\bmit\s+licen[cs]e", r"opensource\.org/licenses/mit"),
    ("mit-0", "attribution", r"\bmit\s+no\s+attribution", r"opensource\.org/licenses/mit-0"),
    ("x11", "x11", r"\bx11\s+licen[cs]e", r"xfree86\.org/\S*license"),
    ("isc", "licen", r"\bisc\s+licen[cs]e", r"opensource\.org/licenses/isc"),
    ("0bsd", "bsd", r"zero[\s-]clause\s+bsd|\b0bsd", r"opensource\.org/licenses/0bsd"),
    ("bsd-2-clause", "licen bsd", r"(?:simplified|freebsd|2[\s-]clause|two[\s-]clause)\s+(?:bsd\s+)?licen[cs]e|bsd[\s-]2[\s-]clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3[\s-]clause|three[\s-]clause)\s+bsd|bsd[\s-]3[\s-]clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:original|4[\s-]clause|four[\s-]clause)\s+bsd|bsd[\s-]4[\s-]clause", r"opensource\.org/licenses/bsd-4-clause"),
    ("bsl-1.0", "boost", r"boost\s+software\s+licen[cs]e", r"boost\.org/license_1_0"),
    ("zlib", "zlib", r"\bzlib(?:/libpng)?\s+licen[cs]e", r"zlib\.net/zlib_license|opensource\.org/licenses/zlib"),
    ("unlicense", "unlicense", r"\bthe\s+unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"\bwtfpl", r"wtfpl\.net"),
    ("ncsa", "illinois", r"university\s+of\s+illinois(?:/ncsa)?\s+open\s+source\s+licen[cs]e", r"opensource\.org/licenses/ncsa"),
    ("postgresql", "postgresql", r"postgresql\s+licen[cs]e", r"postgresql\.org/about/licence"),
    ("python-2.0", "python", r"python\s+(?:software\s+foundation\s+)?licen[cs]e", r"python\.org/psf/license|docs\.python\.org/\S*license"),
    ("openssl", "openssl", r"openssl\s+licen[cs]e", r"openssl\.org/source/license"),
    ("ms-pl", "microsoft", r"microsoft\s+public\s+licen[cs]e", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", "microsoft", r"microsoft\s+reciprocal\s+licen[cs]e", r"opensource\.org/licenses/ms-rl"),
    ("cpl-1.0", "licen", r"common\s+public\s+licen[cs]e", r"opensource\.org/licenses/cpl1\.0"),
    ("ipl-1.0", "ibm", r"ibm\s+public\s+licen[cs]e", r"opensource\.org/licenses/ibmpl"),
    ("upl-1.0", "permissive", r"universal\s+permissive\s+licen[cs]e", r"opensource\.org/licenses/upl"),
    ("ecl-2.0", "educational", r"educational\s+community\s+licen[cs]e", r"opensource\.org/licenses/ecl-2\.0"),
    ("qpl-1.0", "licen", r"\bq\s+public\s+licen[cs]e", r"opensource\.org/licenses/qtpl"),
    ("sspl-1.0", "licen", r"server\s+side\s+public\s+licen[cs]e", r"mongodb\.com/licensing/server-side-public-license"),
    ("busl-1.1", "licen", r"business\s+source\s+licen[cs]e", r"mariadb\.com/bsl11"),
    ("elastic-2.0", "elastic", r"elastic\s+licen[cs]e", r"elastic\.co/licensing/elastic-license"),
    ("odc-by-1.0", "commons", r"open\s+data\s+commons\s+attribution\s+licen[cs]e", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", "dedication", r"public\s+domain\s+dedication\s+and\s+licen[cs]e", r"opendatacommons\.org/licenses/pddl"),
    ("public-domain", "domain", r"(?:dedicated\s+to|released\s+into|(?:is|are)\s+in)\s+the\s+public\s+domain", r"creativecommons\.org/(?:licenses/publicdomain|publicdomain/mark)"),
    ("gpl", "gnu gpl", r"gnu\s+general\s+public\s+licen[cs]e|\bgnu\s+gpl\b|\bgplv?[123]\b", r"gnu\.org/licenses/gpl(?:\.|\b(?!-))"),
    ("lgpl", "lesser library lgpl", r"(?:lesser|library)\s+general\s+public\s+licen[cs]e|\blgplv?[23]", r"gnu\.org/licenses/lgpl(?:\.|\b(?!-))"),
    ("apache", "apache", r"apache\s+licen[cs]e", r"apache\.org/licenses/?(?!license)"),
    ("bsd", "bsd", r"\bbsd[\s-]+(?:style\s+)?licen[cs]e", r"freebsd\.org/copyright"),
    ("mpl", "mozilla", r"mozilla\s+public\s+licen[cs]e", r"mozilla\.org/mpl/?(?!\d)"),
    ("cc", "creative", r"creative\s+commons\s+licen[cs]e", r"creativecommons\.org/licenses/?(?![a-z])"),
]

GRANT = r"(?:licen[cs]ed|released|distributed|published|available|provided|dual[\s-]licen[cs]ed)\s+under\s+(?:the\s+|an?\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+(?:the\s+|an?\s+)?)?"
# Forms of a rule in order of priority: (weight of a detection, what its pattern is made of).
FORMS = {"tag": 1.0, "grant": 0.9, "text": 0.85, "address": 0.8, "name": 0.6}
GENERAL = {"gpl", "lgpl", "apache", "bsd", "mpl", "cc"}


class Rule(NamedTuple):
    label: str
    form: str
    priority: int
    needs: tuple[frozenset[str], ...]
    pattern: re.Pattern


def hosts(address: str) -> frozenset[str]:
    """The host of every alternative of an address; alternatives inside one address share its host."""
    return frozenset(a.split("/")[0].replace("\\", "") for a in re.split(r"\|(?=[a-z.\\-]+\\\.[a-z]+/)", address))


def rules() -> list[Rule]:
    """The signatures in order: tags, grants, words of license texts, addresses, names; exact versions before families.

    Every match of a rule holds a word of each set it needs. No such word has white space, which may be of any kind.
    """
    out = []
    for level, form in enumerate(FORMS):
        if form == "text":
            out += [Rule(label, form, 2 * level + (label in GENERAL), (words,), re.compile(pattern)) for label, words, pattern in signatures()]
            continue
        for label, words, name, address in NAMES:
            general, named = label in GENERAL, frozenset(words.split())
            if form == "tag":
                pattern, needs = rf"spdx[\s-]*licen[cs]e[\s-]*identifier\s*[:=]?\s*\(?{re.escape(label)}(?:-only|-or-later|\+)?(?![\w.-])", (frozenset({"spdx"}),)
            elif form == "grant":
                pattern, needs = rf"{GRANT}(?:{name})", (frozenset({"under"}), named)
            elif form == "address":
                pattern, needs = address, (hosts(address),)
            else:
                pattern, needs = name, (named,)
            out.append(Rule(label, form, 2 * level + general, needs, re.compile(pattern)))
    return sorted(out, key=lambda r: r.priority)


class Scanner:
    """One pass of an automaton over the words that rules need says which may match; only those run."""

    def __init__(self):
        import ahocorasick

        self.groups: dict[tuple[frozenset[str], ...], list[Rule]] = {}
        for rule in rules():
            self.groups.setdefault(rule.needs, []).append(rule)
        self.machine = ahocorasick.Automaton()
        for word in frozenset().union(*(words for needs in self.groups for words in needs)):
            self.machine.add_word(word, word)
        self.machine.make_automaton()

    def detections(self, text: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) in the lower-cased text, contained detections suppressed."""
        here = {word for _, word in self.machine.iter(text)}
        found = []
        for needs, group in self.groups.items():
            if not any(here.isdisjoint(words) for words in needs):
                for rule in group:
                    found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(text)]
        return suppress(found)


def suppress(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Leave out what lies within a detection of higher priority, or of the same and longer or earlier.

    One sweep in order of start: per priority the furthest end so far is all that can contain what
    comes next. Of equal intervals with one priority the first label stays.
    """
    reach, out = {}, []
    for start, end, rule in sorted(found, key=lambda x: (x[0], -x[1], x[2].priority, x[2].label)):
        if not any(p <= rule.priority and far >= end for p, far in reach.items()):
            out.append((start, end, rule))
        reach[rule.priority] = max(end, reach.get(rule.priority, -1))
    return out


SEPARATORS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def phrase_places(words: list[bytes]) -> tuple[list[int], set[str]]:
    """Where the base phrases start, in words, and their labels."""
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        parts, at = phrase.encode().split(), -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                starts.append(at)
                labels.add(label)
    return starts, labels


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, spans array<string>"


def scan(text: str | None, scanner: Scanner) -> tuple:
    raw = (text or "").encode("utf-8").lower()
    words = raw.translate(SEPARATORS).split()
    starts, base = phrase_places(words) if b"licen" in raw or b"cc" in raw else ([], set())
    kept = scanner.detections(raw.decode("utf-8"))
    labels = base | {r.label for _, _, r in kept}
    score = max([FORMS[r.form] for _, _, r in kept], default=0.5 if base else 0.0)
    return (
        *(len(words), len(starts), min(starts, default=None), max(starts, default=None)),
        *(sorted(base), sorted(labels), score, [f"{r.label}:{r.form}:{s}:{e}" for s, e, r in kept]),
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the base phrases, the labels of all kept detections, their spans (code points) and a score.

    The score is the weight of the surest form found. Row by row, no shuffle: hot sources and repeated rows
    change nothing, a null text is empty, an empty table gives no rows.
    """
    kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64(), pa.list_(pa.string())]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            rows = [scan(t, scanner) for t in batch.column(text_col).to_pylist()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *columns], [id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, {SCHEMA}")
