"""Benchmark passages in documents, found by pigeonhole edit matching.

An item with an error budget of k is cut into k + 1 pieces; a passage within k
edits holds at least one of them unchanged.  Exact piece hits come from one
Aho-Corasick pass over a document.  The pieces form a binary tree whose nodes over
c pieces may hold c - 1 errors, so a hit climbs from its piece to the whole item,
each step verified by Myers' bit-parallel distance on the node's surroundings.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import KEY, Plain, materialize, read_table, text_blocks, with_row_key

#: Errors allowed as a share of the item's length.
ERROR_RATE = 0.1
#: Characters of items that one pass over the documents looks for (bounds what is broadcast).
PASS_CHARS = 4_000_000


def normal(text: str) -> str:
    """Lower case, white space runs as one blank."""
    return " ".join(text.lower().split())


class Pattern:
    """Bit masks of a string for Myers' search."""

    def __init__(self, text: str):
        self.size, self.masks = len(text), {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str, stop: int = -1) -> int:
        """Least edit distance to any substring; ends early at ``stop`` or less."""
        full, top, masks = (1 << self.size) - 1, 1 << (self.size - 1), self.masks
        up, down, score, best = full, 0, self.size, self.size
        for c in text:
            eq = masks.get(c, 0)
            diagonal = (((eq & up) + up) ^ up) | eq | down
            more, less = down | (full & ~(diagonal | up)), up & diagonal
            if more & top:
                score += 1
            elif less & top:
                score -= 1
                if score < best:
                    best = score
                    if best <= stop:
                        return best
            more, less = more << 1 & full, less << 1 & full
            up = less | (full & ~(eq | down | more))
            down = more & (eq | down)
        return best


class Item:
    """An item's pieces and the tree above them."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.id, self.text = item_id, text
        self.budget = int(rate * len(text))
        n = self.budget + 1
        self.cuts = [len(text) * i // n for i in range(n + 1)]
        self.patterns: dict[tuple[int, int], Pattern] = {}

    def pieces(self) -> Iterator[tuple[int, str]]:
        for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            yield i, self.text[a:b]

    def climb(self, piece: int) -> list[tuple[int, int]]:
        """Nodes (first piece, end) above a piece, the smallest first, without the root."""
        path, lo, hi = [], 0, self.budget + 1
        while hi - lo > 1:
            path.append((lo, hi))
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if piece < mid else (mid, hi)
        return path[:0:-1]

    def pattern(self, lo: int, hi: int) -> Pattern:
        found = self.patterns.get((lo, hi))
        if found is None:
            found = self.patterns[lo, hi] = Pattern(self.text[self.cuts[lo]:self.cuts[hi]])
        return found


class Matcher:
    """Finds the items of one pass in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [Item(i, t, rate) for i, t in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(self.items):
            for i, piece in item.pieces():
                owners.setdefault(piece, []).append((k, i))
        self.paths = [[item.climb(i) for i in range(item.budget + 1)] for item in self.items]
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item number, least distance) of every item within its budget."""
        if not self.items or not text:
            return []
        hits: dict[int, set[int]] = {}
        tried: set[tuple[int, int, int, int]] = set()
        passed: set[tuple[int, int, int, int]] = set()
        for end, (size, places) in self.automaton.iter(text):
            start = end + 1 - size
            for k, piece in places:
                item = self.items[k]
                diagonal = start - item.cuts[piece]
                if diagonal in hits.get(k, ()):
                    continue
                for lo, hi in self.paths[k][piece]:
                    key = (k, lo, hi, diagonal)
                    if key in passed:
                        continue
                    if key in tried:
                        break
                    tried.add(key)
                    errors = hi - lo - 1
                    around = text[max(0, diagonal + item.cuts[lo] - errors):diagonal + item.cuts[hi] + errors]
                    if item.pattern(lo, hi).best(around, errors) > errors:
                        break
                    passed.add(key)
                else:
                    hits.setdefault(k, set()).add(diagonal)
        found = []
        for k, diagonals in hits.items():
            item, spans = self.items[k], []
            reach = len(item.text) + item.budget
            for d in sorted(diagonals):
                lo, hi = max(0, d - item.budget), d + reach
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = hi
                else:
                    spans.append([lo, hi])
            best = min(item.pattern(0, item.budget + 1).best(text[a:b], 0) for a, b in spans)
            if best <= item.budget:
                found.append((k, best))
        return found


def _passes(items: list[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    group, size = [], 0
    for item in items:
        if group and size + len(item[1]) > PASS_CHARS:
            yield group
            group, size = [], 0
        group.append(item)
        size += len(item[1])
    if group:
        yield group


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rate: float = ERROR_RATE) -> DataFrame:
    """Rows (row key, doc_id, item_id, distance, budget): every document that holds a
    passage within ``rate`` x length edits of a benchmark item, after ``normal``.

    ``distance`` is the least one.  The benchmark is the given test set; it is read
    in passes of at most ``PASS_CHARS`` characters, one scan of the documents each.
    Null and empty items match nothing, null and empty texts hold nothing; repeated
    documents and items give a row each, an item with a null id has a null item_id.
    """
    spark = docs.sparkSession
    items = ((r.item_id, normal(r.text)) for r in
             benchmark.where(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator())
    keyed = with_row_key(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__id", "__text") \
        .select(*KEY, F.col("__id").cast("long").alias("doc_id"), "__text")
    schema = f"{KEY[0]} long, {KEY[1]} long, doc_id long, item_id long, distance int, budget int"
    out = spark.createDataFrame([], schema)
    for group in _passes(x for x in items if x[1]):
        shared = spark.sparkContext.broadcast(group)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows, found = [], []
                for lo, _, texts in text_blocks(batch.column(3)):
                    for i, text in enumerate(texts):
                        for k, distance in matcher.find(normal(text)):
                            rows.append(lo + i)
                            found.append((matcher.items[k].id, distance, matcher.items[k].budget))
                if rows:
                    at = pa.array(rows, pa.int64())
                    ids, distances, budgets = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(at) for c in range(3)), pa.array(ids, pa.int64()),
                         pa.array(distances, pa.int32()), pa.array(budgets, pa.int32())],
                        [*KEY, "doc_id", "item_id", "distance", "budget"])

        out = out.unionAll(keyed.mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all their columns."""
    plain = Plain(docs)
    id_col, text_col = plain.of(id_col), plain.of(text_col)
    hits = materialize(benchmark_hits(plain.df, benchmark, id_col, text_col, rate).select(*KEY).distinct(), "leaks")
    return with_row_key(plain.df, id_col, text_col).join(hits, KEY, "left_anti").drop(*KEY).toDF(*plain.names)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, distance, budget of every benchmark passage found in ``documents``."""
    return benchmark_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "distance", "budget")
