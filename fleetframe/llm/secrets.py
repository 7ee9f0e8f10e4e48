"""Secret scans through a trigram inverted index.

Each rule's regular expression yields a Boolean query over the trigrams that
every match must hold.  Inside a task, a block of texts is indexed (lower-case
byte trigram -> texts), the rule's postings are intersected and united, and only
the candidates are verified with the expression itself.  A rule without
mandatory trigrams scans every text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import append_to_table, blocks, read_table, utf8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: expression, the group whose length counts, least length."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The base kinds.  Runs of hex digits are maximal, so asking for 16
# in the expression finds the same spans as dropping shorter matches afterwards.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Public token formats that the method adds.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}", 0, 1, True),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@"),
)

# --- Boolean trigram queries -------------------------------------------------
# A query is True (nothing is known), a trigram, or ("and" | "or", parts).

_MOST_EXACT = 24


def _both(a, b):
    if a is True:
        return b
    return a if b is True else ("and", (a, b))


def _of_strings(strings):
    """Query for: the text holds one of these strings."""
    options = []
    for s in sorted(strings):
        grams = sorted({s[i:i + 3] for i in range(len(s) - 2)})
        if not grams:
            return True
        options.append(grams[0] if len(grams) == 1 else ("and", tuple(grams)))
    return options[0] if len(options) == 1 else ("or", tuple(options))


def _walk(items):
    """(all strings of the expression or None, query that every match satisfies)."""
    query, exact, whole = True, {""}, True
    for op, arg in items:
        name = str(op)
        found, own = None, True
        if name == "LITERAL":
            found = {chr(arg).lower()}
        elif name == "IN":
            found = _small_class(arg)
        elif name == "SUBPATTERN":
            found, own = _walk(arg[-1])
        elif name == "BRANCH":
            parts = [_walk(p) for p in arg[1]]
            if all(p[0] is not None for p in parts):
                found = set().union(*(p[0] for p in parts))
            else:
                queries = [q if e is None else _both(q, _of_strings(e)) for e, q in parts]
                own = True if any(q is True for q in queries) else ("or", tuple(queries))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            strings, inner_query = _walk(inner)
            if (low, int(high)) == (1, 1):
                found, own = strings, inner_query
            elif (low, int(high)) == (0, 1) and strings is not None:
                found = strings | {""}
            elif low >= 1:
                own = inner_query if strings is None else _both(inner_query, _of_strings(strings))
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            found = {""}
        query = _both(query, own)
        if found is None:  # what stood before is complete; nothing is known of the next characters
            query, exact, whole = _both(query, _of_strings(exact)), {""}, False
            continue
        joined = {a + b for a in exact for b in found}
        if len(joined) > _MOST_EXACT:
            query, whole = _both(query, _of_strings(exact)), False
            joined = {a[-2:] + b for a in exact for b in found}
            if len(joined) > _MOST_EXACT:
                joined = set(found)
        exact = joined
    return (exact, query) if whole else (None, _both(query, _of_strings(exact)))


def _small_class(parts):
    out = set()
    for op, arg in parts:
        if str(op) == "LITERAL":
            out.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
        if len(out) > 8:
            return None
    return out


def trigram_query(pattern: str):
    """Boolean query of lower-case trigrams that every text with a match satisfies.
    A trigram with a character outside ASCII counts as nothing known."""
    strings, query = _walk(re._parser.parse(pattern, re.ASCII))
    return _ascii(query if strings is None else _both(query, _of_strings(strings)))


def _ascii(query):
    if query is True:
        return True
    if isinstance(query, str):
        return query if query.isascii() else True
    kind, parts = query
    parts = tuple(_ascii(p) for p in parts)
    if kind == "or":
        return True if True in parts else (kind, parts)
    parts = tuple(p for p in parts if p is not True)
    return True if not parts else parts[0] if len(parts) == 1 else (kind, parts)


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*(trigrams_of(p) for p in query[1]))


class TrigramIndex:
    """Postings of the rules' trigrams, for a block of texts at a time."""

    def __init__(self, grams):
        self.names = sorted(grams)
        self.table = np.zeros(1 << 24, np.uint16)
        for k, g in enumerate(self.names, 1):
            a, b, c = g.encode()
            self.table[a << 16 | b << 8 | c] = k
        self.postings: dict[str, np.ndarray] = {}

    def build(self, data: np.ndarray, offsets: np.ndarray) -> None:
        """Index the texts ``data[offsets[i]:offsets[i + 1]]``."""
        chunk = data[offsets[0]:offsets[-1]]
        lower = np.where((chunk >= 65) & (chunk <= 90), chunk + 32, chunk).astype(np.uint32)
        self.postings = {}
        if len(lower) < 3:
            return
        marks = self.table[lower[:-2] << 16 | lower[1:-1] << 8 | lower[2:]]
        at = np.flatnonzero(marks)
        bounds = offsets - offsets[0]
        text = np.searchsorted(bounds, at, side="right") - 1
        inside = at + 3 <= bounds[text + 1]
        pairs = np.unique(marks[at[inside]].astype(np.int64) << 32 | text[inside])
        cuts = np.searchsorted(pairs >> 32, np.arange(1, len(self.names) + 2))
        for k, name in enumerate(self.names):
            self.postings[name] = pairs[cuts[k]:cuts[k + 1]] & 0xFFFFFFFF

    def find(self, query) -> np.ndarray:
        """Sorted text numbers that satisfy the query."""
        if isinstance(query, str):
            return self.postings.get(query, np.zeros(0, np.int64))
        kind, parts = query
        found = [self.find(p) for p in parts]
        out = found[0]
        for other in found[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if kind == "and" else np.union1d(out, other)
        return out


def spans_of(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches that are long enough, in code points."""
    return [m.span() for m in compiled.finditer(text) if len(m.group(rule.group)) >= rule.least]


def scan_secrets(docs: DataFrame, text_col: str = "text", base=BASE_RULES, more=MORE_RULES) -> DataFrame:
    """Add n_<kind> (long) of every base rule, ``base_spans`` and ``spans``.

    Spans read ``kind:start:end`` in code points, end exclusive, ordered by start
    and then by the rules' order, comma-joined.  ``base_spans`` holds those of the
    base rules alone; the other rules only add spans, also where they overlap.
    Null and empty texts have none.  All other columns are kept; columns named
    like the results are replaced.
    """
    rules = [*base, *more]
    queries = [trigram_query(r.pattern) for r in rules]
    state: dict = {}

    def scan(column: pa.Array) -> list[pa.Array]:
        if not state:
            state["index"] = TrigramIndex(set().union(*map(trigrams_of, queries)))
            state["compiled"] = [r.compiled() for r in rules]
        index, compiled = state["index"], state["compiled"]
        data, offsets = utf8(column)
        n = len(column)
        counts = np.zeros((len(base), n), np.int64)
        own, every = [""] * n, [""] * n
        for lo, hi in blocks(offsets):
            index.build(data, offsets[lo:hi + 1])
            texts: dict[int, str] = {}
            found: dict[int, list] = {}
            for k, rule in enumerate(rules):
                for i in range(hi - lo) if queries[k] is True else index.find(queries[k]).tolist():
                    if i not in texts:
                        texts[i] = data[offsets[lo + i]:offsets[lo + i + 1]].tobytes().decode("utf-8", "replace")
                    for start, end in spans_of(rule, compiled[k], texts[i]):
                        found.setdefault(i, []).append((start, k, end))
            for i, spans in found.items():
                spans.sort()
                row = lo + i
                every[row] = ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans)
                own[row] = ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans if k < len(base))
                for _, k, _ in spans:
                    if k < len(base):
                        counts[k, row] += 1
        return [*[pa.array(c) for c in counts], pa.array(own), pa.array(every)]

    schema = ", ".join(f"n_{r.kind} long" for r in base) + ", base_spans string, spans string"
    return append_to_table(docs, lambda t: F.col(t.of(text_col)), scan, schema)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``documents``."""
    found = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


def brute_force(texts) -> list[tuple]:
    """The query's columns by plain expressions over every text, for the tests."""
    out = []
    for text in texts:
        spans = sorted((s, k, e, r.kind) for k, r in enumerate([*BASE_RULES, *MORE_RULES])
                       for s, e in spans_of(r, r.compiled(), text or ""))
        own = [x for x in spans if x[1] < len(BASE_RULES)]
        out.append((*[sum(x[1] == k for x in own) for k in range(len(BASE_RULES))],
                    hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in own).encode()).hexdigest(),
                    ",".join(f"{n}:{s}:{e}" for s, _, e, n in spans)))
    return out
