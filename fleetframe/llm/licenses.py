"""Licence texts and notices by canonical digest.

A text is brought to a canonical form (case, punctuation, copyright lines and
equivalent spellings removed as differences) and its digest is joined with the
digests of known licences.  Whole texts are compared: the document, each of its
paragraphs and each of its lines are looked up as entire texts.  A known text of
PASSAGE_WORDS words or more is also found as a passage, wherever all of its words
stand in a document in their order, with code or prose around them.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import read_table

#: Canonical words from which a known text is also looked for inside a document; a
#: shorter one (a name, a one-sentence notice) says little there.
PASSAGE_WORDS = 20

# Public short licences and notices, by SPDX identifier.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
KNOWN_TEXTS = [
    ("MIT", "MIT License\n\n" + _MIT_GRANT), ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT), ("MIT", _MIT_GRANT),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + "\n\n" + _ISC_REST), ("ISC", _ISC_GRANT + "\n\n" + _ISC_REST),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted.\n\n" + _ISC_REST),
    ("Apache-2.0", _APACHE_NOTICE),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
#: Names in one-sentence notices, expanded by rule below.
_NAMES = {
    "MIT": ["MIT"], "ISC": ["ISC"], "0BSD": ["0BSD", "Zero-Clause BSD"], "Unlicense": ["Unlicense"],
    "BSD-2-Clause": ["BSD 2-Clause", "2-Clause BSD", "Simplified BSD", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD", "BSD-3-Clause"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0", "Apache"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0-1.0", "Creative Commons Zero 1.0"],
}
_NOTICES = ["Licensed under {the}{n}", "Released under {the}{n}", "Distributed under {the}{n}",
            "This work is licensed under {the}{n}", "This software is licensed under {the}{n}",
            "This project is licensed under {the}{n}", "This file is licensed under {the}{n}", "License: {n}", "{n}"]


def full_texts() -> list[tuple[str, str]]:
    """(licence id, text) of the files in ``license_texts`` (id, then "_" and a variant),
    whole and without the parts that copies often leave out or change: titles and
    addresses before the terms, appendices after them, numbers of short lists."""
    out = []
    for file in sorted(files("fleetframe.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        license_id, text = file.name.removesuffix(".txt").split("_")[0], file.read_text("utf-8")
        forms = [text]
        if "END OF TERMS AND CONDITIONS" in text:
            ended = text[:text.index("END OF TERMS AND CONDITIONS")]
            forms += [ended, ended[ended.index("TERMS AND CONDITIONS"):], text[text.index("TERMS AND CONDITIONS"):]]
        for start in ("Statement of Purpose", "Permission is hereby granted", "1. Definitions"):
            forms += [f[f.index(start):] for f in list(forms) if start in f]
        for end in ("Exhibit A - ", "EXHIBIT A -", "For more information, please refer"):
            forms += [f[:f.index(end)] for f in list(forms) if end in f]
        if license_id.startswith("BSD"):
            items = re.compile(r"(?m)^ *(?:\d\.|\*) (?=Redistributions|Neither)")
            numbers = iter("123")
            forms = [items.sub("", text), items.sub(lambda _: next(numbers) + ". ", text)]
            forms += [f"{title} License\n\n{f}" for title in _NAMES[license_id] for f in list(forms[:2])]
        out += [(license_id, f) for f in forms]
    return out


def known_licenses() -> list[tuple[str, str]]:
    """(licence id, text) of the built-in catalogue: short licences and notices of this
    module, full texts from files, one-sentence notices built by rule."""
    names = {k: list(v) for k, v in _NAMES.items()}
    for family, label in (("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"),
                          ("AGPL", "GNU Affero General Public License")):
        for version in ("2.0", "2.1", "3.0"):
            short = version.removesuffix(".0")
            names[f"{family}-{version}"] = [f"{label}, version {v}" for v in {version, short}] + [
                f"{label} {v}" for v in {version, short}] + [f"{family}v{short}", f"{family}-{version}", f"{family} {short}"]
    for terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("3.0", "4.0"):
            names[f"CC-{terms}-{version}"] = [f"CC {terms} {version}", f"CC-{terms}-{version}",
                                              f"Creative Commons {terms} {version}"]
    out = KNOWN_TEXTS + full_texts()
    for license_id, labels in names.items():
        for label in labels:
            for notice in _NOTICES:
                for the in ("", "the "):
                    for ending in ("", " License"):
                        out.append((license_id, notice.format(the=the, n=label + ending)))
        out.append((license_id, f"SPDX-License-Identifier: {license_id}"))
    return sorted(set(out))


# Spellings that count as equal, words and phrases.
_EQUAL_WORDS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "behaviour": "behavior", "calibre": "caliber",
    "cancelled": "canceled", "catalogue": "catalog", "categorise": "categorize", "centre": "center", "colour": "color",
    "defence": "defense", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "honour": "honor", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "recognised": "recognized", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "https": "http", "v2": "2", "v3": "3",
}
_MARKS = [("(c)", " "), ("&", " and ")]
#: Lines that open with a copyright mark: with a year or a sign, or short.  A wrapped sentence may open with "copyright
#: holders", a list item with "(c)".
_COPYRIGHT = re.compile(
    r"[^\w©(]*(?:copyright\b(?:\W*(?:\(c\)|©|\d{4}\b|by\b|[<\[{])|"
    r"(?!\W*(?:holders?|owners?|notices?|licen[sc]es?|laws?|statements?|interests?|treat(?:y|ies)|disclaimers?|permissions?|"
    r"protection|status|rights?|infringement|like|also|under|and|or|in|on|of|to|for|is|are|as|that|this|which|you|shall|may)\b)"
    r"(?:.*\b(?:19|20)\d\d\b|\W*(?:\w+\W+){0,5}\w*\W*$))"
    r"|\(c\)(?=\W*copyright\b|.*\b(?:19|20)\d\d\b|\W*(?:\w+\W+){1,2}\w+\W*$)|©|all rights reserved\b)")
_NOT_WORD = re.compile(r"[\W_]+")
#: What goes from the blank-separated words, over line ends too: the word before a version number, and the blank or the
#: letters by which two spellings differ (sub license, non commercial, non infringement, per cent, copyright owner).
_JOINED = re.compile(r"v(?<!\wv)(?:ersion)? ?(?=\d)|(?<=\bsub) (?=licens)|(?<=\bnon) (?=commercial|infringement)"
                     r"|(?<=\bper) (?=cent\b)|(?<=\bcopyright )owner")
_KEPT = {"owner": "holder"}
# faster than _JOINED, which can match only where one of them does
_VERSION = re.compile(r"v(?:ersion)? ?\d")
_SPLIT = ("sub licens", "non commercial", "non infringement", "per cent", "copyright owner")


def _without_copyright(lowered: str) -> str:
    if "copyright" not in lowered and "(c)" not in lowered and "©" not in lowered and "all rights" not in lowered:
        return lowered
    return "\n".join(x if not _COPYRIGHT.match(x) else "" for x in lowered.split("\n"))


def _words(lowered: str) -> list[str]:
    for mark, same in _MARKS:
        if mark in lowered:
            lowered = lowered.replace(mark, same)
    return [_EQUAL_WORDS.get(w, w) for w in _NOT_WORD.sub(" ", lowered).split()]


def canonical(text: str) -> str:
    """Canonical form: lower case, no lines that open with a copyright mark, one
    spelling of equivalent words, no punctuation, single blanks, "version 2" as "2"."""
    form = " ".join(_words(_without_copyright(text.lower())))
    if _VERSION.search(form) or any(x in form for x in _SPLIT):
        form = _JOINED.sub(lambda m: _KEPT.get(m[0], ""), form)
    return form


def word_lines(text: str) -> list[int]:
    """Line number (from 1) of every word of the canonical form."""
    words, lines = [], []
    for i, line in enumerate(_without_copyright(text.lower()).split("\n"), 1):
        own = _words(line)
        words += own
        lines += [i] * len(own)
    ends, at = [], -1
    for w in words:  # end of every word among the blank-separated words
        at += len(w) + 1
        ends.append(at)
    plain = " ".join(words)
    out, last = [], 0
    for m in _JOINED.finditer(plain):
        first = bisect_right(ends, m.start() - 1)  # the word of the match, or before its blank
        if m[0] == " ":
            gone = bisect_left(ends, m.start()) + 1  # joined to the word before
        elif m[0].endswith(" "):
            gone = first  # a word of its own goes
        else:
            continue
        out += lines[last:gone]
        last = gone + 1
    return out + lines[last:]


def _digest(form: str) -> bytes:
    return hashlib.sha256(form.encode("utf-8", "replace")).digest()


def digest(text: str) -> bytes | None:
    """SHA-256 of the canonical form; None where nothing is left of the text."""
    form = canonical(text)
    return _digest(form) if form else None


def signature(text: str) -> tuple | None:
    """What finds a known text inside others: its first two words, number of words, a
    few words of it, digest.  None for texts under PASSAGE_WORDS words."""
    form = canonical(text)
    words = form.split(" ")
    n = len(words)
    if n < PASSAGE_WORDS:
        return None
    return words[0], words[1], n, [words[k] for k in _probes(n)], _digest(form)


def _probes(n: int) -> tuple[int, ...]:
    return n - 1, n // 2, n // 4, 3 * n // 4, 2


def signature_index(signatures: Iterable[tuple]) -> dict:
    """Signatures by their first two words."""
    out: dict = {}
    for one, two, n, probes, known in signatures:
        out.setdefault((one, two), {})[bytes(known)] = (n, list(zip(_probes(n), probes)))
    return out


def passages(form: str, index: dict) -> list[tuple[int, int, bytes]]:
    """(first word, words, digest) of the known texts inside a canonical form, without
    those that lie inside a longer one."""
    words = form.split(" ")
    found = []
    for i in [i for i, pair in enumerate(zip(words, words[1:])) if pair in index]:
        for known, (n, probes) in index[words[i], words[i + 1]].items():
            if i + n <= len(words) and all(words[i + k] == w for k, w in probes) \
                    and _digest(" ".join(words[i:i + n])) == known:
                found.append((i, n, known))
    out, reach = [], 0
    for i, n, known in sorted(found, key=lambda x: (x[0], -x[1])):
        if i + n > reach:
            out.append((i, n, known))
            reach = i + n
    return out


_PARAGRAPH_END = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")


def units(text: str) -> Iterator[tuple[str, int, str]]:
    """(kind, number from 1, text) of the document, its paragraphs and its lines; a
    paragraph or line that is the whole document, or the whole paragraph, comes once."""
    yield "document", 1, text
    paragraphs = [p for p in _PARAGRAPH_END.split(text) if p.strip()] if "\n" in text else []
    if len(paragraphs) > 1:
        for i, paragraph in enumerate(paragraphs, 1):
            if "\n" in paragraph:
                yield "paragraph", i, paragraph
    if "\n" in text:
        for i, line in enumerate(text.split("\n"), 1):
            if line.strip():
                yield "line", i, line


def _passage_rows(text: str, form: str, index: dict) -> Iterator[tuple[int, bytes]]:
    """(line, digest) of the passages that are no entire document, paragraph or line."""
    found = passages(form, index)
    if not found or (len(found) == 1 and found[0][1] == form.count(" ") + 1):
        return
    lines = word_lines(text)
    known = {d for _, _, d in found}
    entire, at, start = set(), 1, 0
    for end, after in [*(m.span() for m in _PARAGRAPH_END.finditer(text)), (len(text), len(text))]:
        if (d := digest(text[start:end])) in known:
            entire.add((bisect_left(lines, at), d))
        at += text.count("\n", start, after)
        start = after
    for i, line in enumerate(text.split("\n"), 1):
        if (d := digest(line)) in known:
            entire.add((bisect_left(lines, i), d))
    for i, _, d in found:
        if (i, d) not in entire:
            yield lines[i], d


def license_digests(spark: SparkSession, licenses: DataFrame | None = None) -> DataFrame:
    """Rows (digest, license_id) of a table (license_id, text) or of the built-in catalogue."""
    if licenses is None:
        rows = {(digest(t), i) for i, t in known_licenses()}
        return spark.createDataFrame([(bytearray(d), i) for d, i in sorted(rows)], "digest binary, license_id string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(t) if t is not None else None for t in batch.column(1).to_pylist()], pa.binary()),
                 batch.column(0)], ["digest", "license_id"])

    texts = licenses.select(F.col("license_id").cast("string"), F.col("text"))
    return texts.mapInArrow(run, "digest binary, license_id string").where("digest IS NOT NULL").distinct()


def license_signatures(licenses: DataFrame | None = None) -> dict:
    """Index of the signatures of a table (license_id, text) or of the built-in
    catalogue: some 300 bytes for each longer text, held by the driver and every task."""
    if licenses is None:
        return signature_index(s for _, t in known_licenses() if (s := signature(t)))
    schema = "one string, two string, n int, probes array<string>, digest binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [s for t in batch.column(0).to_pylist() if t is not None and (s := signature(t))]
            if rows:
                columns = zip([pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.binary()], zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in columns],
                                                 ["one", "two", "n", "probes", "digest"])

    return signature_index(map(tuple, licenses.select("text").mapInArrow(run, schema).distinct().collect()))


def scan_licenses(docs: DataFrame, licenses: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Rows (doc_id, unit, unit_no, license_id): documents, paragraphs and lines whose
    canonical digest is that of a known licence, and passages (unit_no: line of the
    first word) in which all words of a longer known text stand together.

    A passage that is an entire document, paragraph or line, or lies inside a longer
    passage, gives no row of its own.  Null, empty and punctuation-only texts match
    nothing; every match of every row counts, so repeated rows give repeated results,
    and a null id a null doc_id.  A text known under two ids gives a row for each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(license_signatures(licenses))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows, kinds, numbers, digests = [], [], [], []

            def put(*row):
                for column, value in zip((rows, kinds, numbers, digests), row):
                    column.append(value)

            for i, text in enumerate(batch.column(1).to_pylist()):
                for kind, number, unit in units(text) if text else ():
                    form = canonical(unit)
                    if form:
                        put(i, kind, number, _digest(form))
                        if kind == "document":
                            for line, d in _passage_rows(text, form, index):
                                put(i, "passage", line, d)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()),
                 pa.array(numbers, pa.int32()), pa.array(digests, pa.binary())],
                ["doc_id", "unit", "unit_no", "digest"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.mapInArrow(run, "doc_id long, unit string, unit_no int, digest binary")
    # the catalogue's rows are few; Spark broadcasts them only under its own size threshold
    return found.join(license_digests(docs.sparkSession, licenses), "digest") \
        .select("doc_id", "unit", "unit_no", "license_id")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, unit, unit_no, license_id of every known licence text in ``documents``."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))
