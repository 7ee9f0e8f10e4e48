"""Ranked lexical search by pruned inner products over documents ordered by length.

A document is a vector of term impacts, an item a vector of term multiplicities; with
the root of a term's weight in either, their inner product is the score.  The terms that
occur in no item can add nothing, so a document keeps only those of the items.

1. One pass over the texts writes each document's term count and its frequencies of the
   items' terms; corpus statistics are aggregated from all of these rows.
2. The impact vectors of a file are ordered by length and taken in buckets.  By
   Cauchy-Schwarz an item passes over a bucket if its length times the bucket's greatest
   one falls short of the item's tenth best score; a task may read several files, so a
   longer bucket can follow.  Inside a bucket the item's heaviest coordinates are summed from inverted lists; the others
   add at most the product of the lengths that remain on both sides.  What survives this
   bound is scored exactly, in integers.
3. The longest documents of all are searched first.  Their tenth best scores are lower
   bounds of the final ones, so the tasks of the second search start with them and
   return few rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetframe.llm.common import materialize, ranges, read_table

TOP = 10
#: Bytes of items searched for together (what is broadcast; twice as many at most, or one item).
ITEM_BYTES = 2_000_000
#: Documents of a bucket, coordinates summed before the bound, documents of the first search.
BUCKET, FOCUS, SEED_ROWS = 2048, 8, 20_000

#: Fixed value: bytes that are part of a term, A-Z in lower case; all others separate terms.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer impact of terms that occur ``tf`` times in documents of ``n`` terms."""
    m = 100 - 75 + (75 * n.astype(np.int64) * n_docs) // n_terms
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """The items of one block: term numbers, multiplicities and, once known, weights."""

    def __init__(self, texts: list[str]):
        self.numbers: dict[bytes, int] = {}
        self.terms, self.times = [], []
        for text in texts:
            counts = Counter(terms(text.encode()))
            self.terms.append(np.array([self.numbers.setdefault(t, len(self.numbers)) for t in counts], np.int64))
            self.times.append(np.array(list(counts.values()), np.int64))

    def weigh(self, n_docs: int, df: dict[int, int]) -> None:
        self.weight = np.array([term_weight(n_docs, df.get(k, 0)) for k in range(len(self.numbers))], np.int64)
        self.root = np.sqrt(self.weight.astype(float))
        self.vectors = []
        for t, times in zip(self.terms, self.times):
            heavy = np.argsort(-self.root[t] * times, kind="stable")
            self.vectors.append((t[heavy], (self.root[t] * times)[heavy], (self.weight[t] * times)[heavy]))
        self.length = np.array([math.sqrt(float(v[1] @ v[1])) for v in self.vectors])


class Bucket:
    """Impact vectors of similar length, the longest first, with inverted lists."""

    def __init__(self, items: Items, ids: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, term: np.ndarray,
                 impact: np.ndarray):
        self.ids, self.lengths, self.offsets, self.term, self.impact = ids, lengths, offsets, term, impact
        self.root = items.root

    @cached_property
    def inverted(self) -> tuple[np.ndarray, ...]:
        """Terms, edges of their lists, and the documents and values in these; made for the first item that looks."""
        by_term = np.argsort(self.term, kind="stable")
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))[by_term]
        value = self.root[self.term[by_term]] * self.impact[by_term]
        lists, first = np.unique(self.term[by_term], return_index=True)
        return lists, np.concatenate([first, [len(self.term)]]), doc, value

    def candidates(self, vector, length: float, least: float) -> np.ndarray:
        """Documents whose inner product may reach ``least``."""
        term, value, _ = vector
        near = int(np.searchsorted(-self.lengths, -least / length * (1 - 1e-9), side="right")) if length else 0
        partial, seen = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        lists, edges, docs, values = self.inverted
        for t, q in zip(term[:FOCUS].tolist(), value[:FOCUS].tolist()):
            k = int(np.searchsorted(lists, t))
            if k < len(lists) and lists[k] == t:
                own = slice(edges[k], edges[k + 1])
                doc, x = docs[own], values[own]
                partial[doc] += q * x
                seen[doc] += x * x
        rest = math.sqrt(float(value[FOCUS:] @ value[FOCUS:]))
        bound = partial[:near] + rest * np.sqrt(np.maximum(self.lengths[:near] ** 2 * (1 + 1e-9) - seen[:near], 0))
        return np.flatnonzero(bound * (1 + 1e-9) + 1e-3 >= least)

    def scores(self, vector, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores; ``weights`` is a scratch array of zeros, one for each term."""
        term, _, whole = vector
        weights[term] = whole
        counts = self.offsets[docs + 1] - self.offsets[docs]
        at = ranges(self.offsets[docs], counts)
        sums = np.concatenate([[0], np.cumsum(weights[self.term[at]] * self.impact[at])])
        ends = np.cumsum(counts)
        weights[term] = 0
        return sums[ends] - sums[ends - counts]


def search(items: Items, buckets: Iterable[Bucket], least: np.ndarray, top: int):
    """The ``top`` best documents of each item among the buckets (in any order; the fewest
    are looked into with the longest first): (item, id, score) arrays.  ``least``: scores
    below which nothing is wanted, 1 or more."""
    no = np.zeros(0, np.int64)
    best = [(no, no) for _ in items.vectors]  # scores and ids, best first
    floor = least.astype(np.int64).copy()
    weights = np.zeros(len(items.numbers), np.int64)
    for bucket in buckets:
        within = items.length * bucket.lengths[0] * (1 + 1e-9) + 1e-3 >= floor
        for i in np.flatnonzero(within & (items.length > 0)).tolist():
            docs = bucket.candidates(items.vectors[i], items.length[i], float(floor[i]))
            if not len(docs):
                continue
            score = bucket.scores(items.vectors[i], weights, docs)
            keep = score >= floor[i]
            score, ids = np.concatenate([best[i][0], score[keep]]), np.concatenate([best[i][1], bucket.ids[docs[keep]]])
            order = np.lexsort((ids, -score))[:top]
            best[i] = score[order], ids[order]
            if len(order) == top:
                floor[i] = max(floor[i], best[i][0][-1])
    item = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
    return item, np.concatenate([no, *(b[1] for b in best)]), np.concatenate([no, *(b[0] for b in best)])


_LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others
_FOUND = "item int, doc_id long, score long"


def frequency_rows(docs: DataFrame, id_col: str, text_col: str, shared) -> DataFrame:
    """Rows (doc_id, n, term, tf) of every document with a term: its number of terms, and
    the frequencies of those that the items have."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value.numbers
        for batch in batches:
            rows, n, found, times = [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms(text) if text else ()
                if words:
                    counts = Counter(words)
                    mine = counts.keys() & numbers.keys()
                    rows.append(i)
                    n.append(len(words))
                    found.append([numbers[t] for t in mine])
                    times.append([counts[t] for t in mine])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                     pa.array(times, pa.list_(pa.int32()))], ["doc_id", "n", "term", "tf"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>")


def impact_rows(rows: DataFrame, shared, n_docs: int, n_terms: int) -> DataFrame:
    """Rows (doc_id, length, term, impact), the longest vector first in every partition (so in every file, once written)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value.weight.astype(float)
        for batch in batches:
            if not batch.num_rows:
                continue
            term, tf = (batch.column(c).flatten().to_numpy() for c in (2, 3))
            counts = np.diff(batch.column(2).offsets.to_numpy())
            impact = impacts(tf, np.repeat(batch.column(1).to_numpy(), counts), n_docs, n_terms)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            # each row on its own (none is empty): differences of a running total would lose digits
            length = np.sqrt(np.add.reduceat(weight[term] * impact.astype(float) ** 2, offsets[:-1]))
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(length), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(impact, pa.int64()))], ["doc_id", "length", "term", "impact"])

    return rows.where(F.size("term") > 0).mapInArrow(
        run, "doc_id long, length double, term array<int>, impact array<long>").sortWithinPartitions(F.desc("length"))


def _search_rows(vectors: DataFrame, shared, least: np.ndarray, top: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value

        def buckets() -> Iterator[Bucket]:
            for batch in batches:
                ids = batch.column(0).fill_null(_LAST).to_numpy()
                for lo in range(0, batch.num_rows, BUCKET):
                    b = batch.slice(lo, BUCKET)
                    length = b.column(1).to_numpy()
                    order = np.argsort(-length, kind="stable")  # where one file ends and another begins
                    b = b.take(pa.array(order))
                    offsets = b.column(2).offsets.to_numpy().astype(np.int64)
                    yield Bucket(items, ids[lo:lo + BUCKET][order], length[order], offsets - offsets[0],
                                 b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy())

        item, ids, score = search(items, buckets(), least, top)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=ids == _LAST), pa.array(score, pa.int64())],
            ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, _FOUND)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The different rows (id, text) of the items, in parts of at most twice ITEM_BYTES (or one row)."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")) \
        .where(F.col("text").isNotNull()).distinct()
    size = F.octet_length("text")
    parts = max(1, -(-(rows.agg(F.sum(size.cast("long"))).first()[0] or 0) // ITEM_BYTES))
    while True:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
        large = dealt.groupBy("part").agg(F.sum(size.cast("long")).alias("size"), F.count(F.lit(1)).alias("n")) \
            .where((F.col("size") > 2 * ITEM_BYTES) & (F.col("n") > 1)).limit(1).count()
        if not large:
            break
        parts *= 2
    for part in range(parts):
        block = dealt.where(F.col("part") == part).orderBy("item_id", "text").select("item_id", "text").collect()
        if block:
            yield block


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_col: str = "doc_id", item_col: str = "item_id",
                  text_col: str = "text", seed_rows: int = SEED_ROWS) -> DataFrame:
    """The ``top`` documents of highest score above 0 for every item: item_id, rank from 1,
    doc_id, score; equal scores by ascending doc_id (a null id after all others).

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
    lower case.  Null and empty texts have none and count in no statistic.  Every row of
    ``docs`` is a document, also where ids repeat (equal rows of one id then take a rank
    each); rows of ``items`` that are equal in id and text are one item, those of one id
    with different texts are ranked each.  Other columns of either table are not read.
    """
    spark = docs.sparkSession
    found = None
    for block in item_blocks(items, item_col, text_col):
        known = Items([r.text for r in block])
        if not known.numbers:
            continue
        shared = spark.sparkContext.broadcast(known)
        rows = materialize(frequency_rows(docs, doc_col, text_col, shared), "term-frequencies")
        n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        # one row for each term of the block
        df = dict(rows.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())
        shared.unpersist()
        known.weigh(n_docs, df)
        shared = spark.sparkContext.broadcast(known)
        vectors = materialize(impact_rows(rows, shared, n_docs, n_terms), "impact-vectors")
        least = np.ones(len(block), np.int64)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))

        def best(least: np.ndarray, vectors: DataFrame) -> DataFrame:
            ranked = _search_rows(vectors, shared, least, top).withColumn("rank", F.row_number().over(order))
            return ranked.where(F.col("rank") <= top)

        share = max(0.0, 1 - seed_rows / n_docs)
        if share:
            cut = vectors.agg(F.percentile_approx("length", share, 1000)).first()[0]
            for r in best(least, vectors.where(F.col("length") >= F.lit(cut))).where(F.col("rank") == top).collect():
                least[r["item"]] = r["score"]  # one row for each item of the block at most
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(block)], "item int, item_id long")
        part = materialize(best(least, vectors).join(F.broadcast(names), "item")
                           .select("item_id", "rank", "doc_id", "score"), "ranked")
        shared.unpersist()
        found = part if found is None else found.unionAll(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 10 best of all ``documents`` for every item of ``benchmark``."""
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH tok AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
item AS (SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT iid, item_id, term, count(*) AS times FROM item GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM tok WHERE len(ts) > 0),
freq AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM tok)
         GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM freq GROUP BY term), total),
scored AS (SELECT iid, item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS score
           FROM asked JOIN weight USING (term) JOIN freq USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
