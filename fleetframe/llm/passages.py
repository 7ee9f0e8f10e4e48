"""Repeated word windows removed by relative Lempel-Ziv parsing.

A window is WIDTH consecutive words of a document; it is repeated if the same words
also start earlier (in a smaller id, or before it in the same document).

1. Every window belongs to the least-hashed GRAM-word string in it, its anchor.  A run
   of windows with one anchor is a segment (about 27 words); equal windows lie in
   segments of the same anchor.  One digest per segment is counted, no text.
2. Documents whose segments have an anchor that occurs elsewhere send those segments,
   as text, to the reference block of the anchor.
3. A task indexes a reference block (suffix array over its words) and parses every
   segment greedily against what comes earlier: from each place the longest earlier
   string is a factor, and the next one starts behind it.  A window cannot hold a whole
   factor and the word behind it, so it lies in one factor of WIDTH words or more, or
   across the boundary of two neighbours that have as many together; only there single
   places are looked up.
4. The word ranges of a document are collected and cut out.

An anchor with more than GROUP_ROWS segments would make a block too large for one task.
Its segments are first grouped by the digest of all their words: a later one is one
factor of the first.  The different ones are parsed like all others if they are few
enough, else their windows are dealt out by digest, a factor of WIDTH words each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import (KEY, append_columns, blocks, materialize, other_columns, ranges, read_table, utf8,
                                   with_row_key)

WIDTH, GRAM = 20, 6
#: Segments of one anchor that a task holds at once.
GROUP_ROWS = 2_000
#: Words of a reference block.
BLOCK_WORDS = 200_000
#: Words of a text looked at together; neighbours overlap by WIDTH - 1.
CHUNK_WORDS = 1 << 17

#: Fixed value: the bytes between words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


# --- words and segments ----------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """64-bit digests of any range of a sequence of numbers."""

    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd: invertible modulo 2^64
    _powers: dict = {}

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values) + 1
        if len(self._powers.get(which, ((),))[0]) < n:
            size = max(n, 1 << 20)
            self._powers[which] = [
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.BASES[which], pow(self.BASES[which], -1, 1 << 64))]
        up, self.down = self._powers[which]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return _mix(raw + (end - start).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of the texts at ``offsets`` (from 0) of ``data``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[data]
    begins, stops = np.concatenate([[True], space[:-1]]), np.concatenate([space[1:], [True]])
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # no word goes on into the next text
    begins[edges] = stops[edges - 1] = True
    return np.flatnonzero(~space & begins), np.flatnonzero(~space & stops) + 1


class Segments:
    """Runs of windows with one anchor in some words: anchor digest, first and last
    window (numbers of their first words) and two digests of all words of a run."""

    def __init__(self, hashes: np.ndarray, owner: np.ndarray):
        grams = Rolling(hashes)
        at = np.arange(len(hashes) - GRAM + 1)
        gram = grams.of(at, at + GRAM)
        low = np.uint64((1 << 20) - 1)
        least = (gram & ~low) | at.astype(np.uint64)  # leftmost of equals
        span, covered = WIDTH - GRAM + 1, 1
        while covered * 2 <= span:
            least = np.minimum(least[:-covered], least[covered:])
            covered *= 2
        if span > covered:
            least = np.minimum(least[:covered - span], least[span - covered:])
        anchor = (least & low).astype(np.int64)
        whole = np.flatnonzero(owner[:len(anchor)] == owner[WIDTH - 1:])  # windows within one text
        anchor = anchor[whole]
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(whole) else whole
        self.first = whole[new]
        self.last = whole[np.concatenate([new[1:] - 1, [len(whole) - 1]])] if len(whole) else whole
        self.gram = gram[anchor[new]].view(np.int64)
        self.digest = [Rolling(hashes, k).of(self.first, self.last + WIDTH).view(np.int64) for k in (0, 1)]


def segments(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, Segments]]:
    """(bytes, word starts, word ends, row of each word, number of each word in its row,
    segments) of every part of a text column."""
    data, offsets = utf8(column)
    for lo, hi in blocks(offsets):
        own = offsets[lo:hi + 1] - offsets[lo]
        part = data[offsets[lo]:offsets[hi]]
        starts, ends = word_bounds(part, own)
        row = np.searchsorted(own, starts, side="right") - 1 + lo
        number = np.arange(len(starts)) - np.searchsorted(row, row)
        for a in range(0, len(starts) - WIDTH + 1, CHUNK_WORDS):
            b = min(a + CHUNK_WORDS + WIDTH - 1, len(starts))
            first, s, e = starts[a], starts[a:b], ends[a:b]
            hashes = Rolling(part[first:e[-1]]).of(s - first, e - first)
            yield part, s, e, row[a:b], number[a:b], Segments(hashes, row[a:b])


def anchor_rows(keyed: DataFrame) -> DataFrame:
    """Rows (row key, gram, times): the different anchors of every document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, row, _, found in segments(batch.column(2)):
                if not len(found.first):
                    continue
                owner = row[found.first]
                order = np.lexsort((found.gram, owner))
                owner, gram = owner[order], found.gram[order]
                new = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])]))
                times = np.diff(np.concatenate([new, [len(gram)]]))
                at = pa.array(owner[new])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(gram[new]), pa.array(times)],
                    [*KEY, "gram", "times"])

    return keyed.mapInArrow(run, f"{KEY[0]} long, {KEY[1]} long, gram long, times long")


_PLACE = f"known boolean, {KEY[0]} long, {KEY[1]} long, at long"
_SEGMENT = f"gram long, hot boolean, one long, two long, {_PLACE}, size int, words binary"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the wanted anchors, from rows (known, row key, text, grams, hots)."""
    for batch in batches:
        wanted = batch.column(4)
        counts = np.diff(wanted.offsets.to_numpy())
        begins = wanted.offsets.to_numpy()[:-1] - wanted.offsets.to_numpy()[0]
        grams = wanted.flatten().to_numpy(zero_copy_only=False)
        hots = batch.column(5).flatten().to_numpy(zero_copy_only=False)
        for part, s, e, row, number, found in segments(batch.column(3)):
            hot = np.zeros(len(found.first), np.int8)
            owner = row[found.first]
            edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else []
            for a, b in zip(edges[:-1], edges[1:]):
                r = owner[a]
                have = slice(begins[r], begins[r] + counts[r])
                order = np.argsort(grams[have], kind="stable")
                sorted_grams = grams[have][order]
                at = np.minimum(np.searchsorted(sorted_grams, found.gram[a:b]), len(order) - 1)
                hit = sorted_grams[at] == found.gram[a:b]
                hot[a:b] = np.where(hit, 1 + hots[have][order][at], 0)
            picked = np.flatnonzero(hot)
            if not len(picked):
                continue
            first, last = found.first[picked], found.last[picked]
            raw = part.tobytes()
            rows = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.gram[picked]), pa.array(hot[picked] == 2), pa.array(found.digest[0][picked]),
                 pa.array(found.digest[1][picked]), *(batch.column(c).take(rows) for c in range(3)),
                 pa.array(number[first]), pa.array((last - first + WIDTH).astype(np.int32)),
                 pa.array([raw[x:y] for x, y in zip(s[first].tolist(), e[last + WIDTH - 1].tolist())], pa.binary())],
                ["gram", "hot", "one", "two", "known", *KEY, "at", "size", "words"])


# --- reference blocks --------------------------------------------------------------

class ReferenceBlock:
    """Index of some strings of words, in which every place finds the longest string
    that also starts at an earlier place.

    ``strings`` are lists of words shorter than 64; ``place`` gives the order number of
    each one's first word, the next words follow (equal numbers: neither is earlier).
    """

    LEVELS = 6

    def __init__(self, strings: list[list[bytes]], place: np.ndarray):
        numbers: dict[bytes, int] = {}
        sizes = np.array([len(s) for s in strings], np.int64)
        total = int(sizes.sum()) + len(strings)
        self.end = np.cumsum(sizes + 1) - 1  # place of the separator of each string
        self.begin = self.end - sizes
        text = np.full(total, -1, np.int64)
        inside = np.ones(total, bool)
        inside[self.end] = False
        text[inside] = [numbers.setdefault(w, len(numbers)) for s in strings for w in s]
        text[self.end] = len(numbers) + np.arange(len(strings))  # each separator is a word of its own
        owner = np.repeat(np.arange(len(strings)), sizes + 1)
        self.order = place[owner] + np.arange(total) - self.begin[owner]
        self.order[self.end] = np.iinfo(np.int64).max  # never an earlier place
        self._sort(text)

    def _sort(self, text: np.ndarray) -> None:
        """Suffix array by doubling; the ranks at 1, 2, 4 ... words are kept for ``common``."""
        n = len(text)
        self.ranks = [text]
        for level in range(self.LEVELS):
            step, rank = 1 << level, self.ranks[-1]
            key = rank * np.int64(n + 1)
            key[:max(n - step, 0)] += rank[step:] + 1
            suffixes = np.argsort(key)
            key = key[suffixes]
            rank = np.empty(n, np.int64)
            rank[suffixes] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            self.ranks.append(rank)
        self.suffixes, self.rank = suffixes, self.ranks.pop()
        self.least = [self.order[suffixes]]  # minima of 1, 2, 4 ... neighbours of the suffix array
        while len(self.least[-1]) > 1 << (len(self.least) - 1):
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` have in common (a separator ends all)."""
        length = np.zeros(len(a), np.int64)
        for level in range(self.LEVELS - 1, -1, -1):
            rank = self.ranks[level]
            length += (rank[a + length] == rank[b + length]).astype(np.int64) << level
        return length

    def longest(self, at: np.ndarray) -> np.ndarray:
        """Words of the longest string at ``at`` that also starts earlier: the nearest
        suffixes on either side that start earlier have the most in common."""
        own, rank = self.order[at], self.rank[at]
        left, right = rank.copy(), rank + 1
        for level in range(len(self.least) - 1, -1, -1):
            least, step = self.least[level], 1 << level
            room = left >= step
            left -= step * (room & (least[np.where(room, left - step, 0)] >= own))
            room = right + step <= len(self.order)
            right += step * (room & (least[np.where(room, right, 0)] >= own))
        best = np.zeros(len(at), np.int64)
        for there, near in ((left > 0, left - 1), (right < len(self.order), right)):
            k = np.flatnonzero(there)
            best[k] = np.maximum(best[k], self.common(at[k], self.suffixes[near[k]]))
        return best

    def repeated(self) -> np.ndarray:
        """Which places start a window that also starts earlier."""
        at, active = self.begin.copy(), np.arange(len(self.begin))
        marks = np.zeros(len(self.order) + 1, np.int64)
        before = np.zeros(len(at), np.int64)  # length of the factor that ends here
        while len(active):
            here = at[active]
            length = self.longest(here)
            full = here[length >= WIDTH]
            np.add.at(marks, full, 1)
            np.add.at(marks, full + length[length >= WIDTH] - WIDTH + 1, -1)
            # windows across the boundary with the factor before
            low = here - np.minimum(before[active], WIDTH - 1)
            high = np.minimum(here - 1, here + length - WIDTH)
            some = np.flatnonzero(high >= low)
            across = ranges(low[some], high[some] - low[some] + 1)
            across = across[self.longest(across) >= WIDTH]
            np.add.at(marks, across, 1)
            np.add.at(marks, across + 1, -1)
            before[active] = length
            at[active] = here + np.maximum(length, 1)
            active = active[at[active] < self.end[active]]
        return np.cumsum(marks[:-1]) > 0


_RANGE = "hot boolean, tag1 long, tag2 long, at long, size int"
_CANDIDATE = ["gram", "known", "id", "at", "tag1", "tag2", "size", "words", "hot"]


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated word ranges, with their tags, of candidate segments ordered by gram."""
    found: list[tuple[np.ndarray, ...]] = []
    waiting: list[tuple] = []  # different strings of a block: (known, id, at, tag1, tag2, size, words, hot)
    words = 0
    group: list[tuple] = []
    gram = None

    def emit() -> pa.RecordBatch:
        hot, *columns, size = [np.concatenate(x) for x in zip(*found)]
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(hot.astype(bool)), *(pa.array(c, pa.int64()) for c in columns),
                                           pa.array(size, pa.int32())], ["hot", "tag1", "tag2", "at", "size"])

    def parse_block() -> None:
        nonlocal words
        docs = {doc: number for number, doc in enumerate(sorted({w[:2] for w in waiting}))}
        place = np.array([(docs[w[:2]] << 36) + w[2] for w in waiting], np.int64)
        block = ReferenceBlock([w[6].split() for w in waiting], place)
        marks = np.diff(np.concatenate([[0], block.repeated().view(np.int8), [0]]))
        lo, hi = np.flatnonzero(marks == 1), np.flatnonzero(marks == -1)
        if len(lo):
            owner = np.searchsorted(block.end, lo)
            hot, tag1, tag2, at = (np.array([waiting[k][c] for k in owner.tolist()], np.int64) for c in (7, 3, 4, 2))
            found.append((hot, tag1, tag2, at + lo - block.begin[owner], hi - lo + WIDTH - 1))
        waiting.clear()
        words = 0

    def end_group() -> None:
        nonlocal words
        if len(group) > 1:
            group.sort()
            first: dict[bytes, tuple] = {}
            whole, rest = [], []
            for row in group:
                held = first.setdefault(row[6], row)
                if held[:3] < row[:3]:  # one factor: the earlier equal string
                    whole.append((row[7], row[3], row[4], row[2], row[5]))
                else:  # the first, or a row of the same id with the same words at the same place
                    rest.append(row)
            if whole:
                found.append(tuple(np.array(x, np.int64) for x in zip(*whole)))
            if len(first) > 1:
                waiting.extend(rest)
                words += sum(r[5] + 1 for r in rest)
        group.clear()

    for batch in batches:
        for g, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if g != gram:
                end_group()
                gram = g
                if words > BLOCK_WORDS:
                    parse_block()
            group.append(tuple(row))
        if sum(len(f[0]) for f in found) > 20_000:
            yield emit()
    end_group()
    if waiting:
        parse_block()
    if found:
        yield emit()


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each window of candidate segments: its two digests, place and tags."""
    for batch in batches:
        data, offsets = utf8(batch.column(7))
        for lo, hi in blocks(offsets, 1 << 17):
            part = data[offsets[lo]:offsets[hi]]
            s, e = word_bounds(part, offsets[lo:hi + 1] - offsets[lo])
            hashes = Rolling(part).of(s, e)
            sizes = batch.column(6).slice(lo, hi - lo).to_numpy().astype(np.int64)
            counts = sizes - WIDTH + 1
            first = ranges(np.cumsum(sizes) - sizes, counts)
            rows = np.repeat(np.arange(lo, hi), counts)
            at = batch.column(3).to_numpy()[rows] + ranges(np.zeros(len(counts), np.int64), counts)
            known, own, tag1, tag2 = (batch.column(c).take(pa.array(rows)) for c in (1, 2, 4, 5))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(Rolling(hashes, k).of(first, first + WIDTH).view(np.int64)) for k in (0, 1)),
                 known, own, pa.array(at), tag1, tag2], ["one", "two", "known", "id", "at", "tag1", "tag2"])


# --- the operator ------------------------------------------------------------------

def repeated_word_ranges(docs: DataFrame, id_col: str, text_col: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rows (row key, at, size): word ranges that cover exactly the repeated windows."""
    keyed = with_row_key(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text")
    rows = materialize(anchor_rows(keyed.select(*KEY, "text")), "anchor-rows")
    # what joins look up is written first: a join of two plain shuffles can split a hot anchor, document or segment
    anchors = materialize(rows.groupBy("gram").agg(F.sum("times").alias("n")).where("n > 1")
                          .select("gram", (F.col("n") > group_rows).alias("hot")), "anchors")
    wanted = materialize(rows.join(anchors, "gram").groupBy(*KEY).agg(F.collect_set(F.struct("gram", "hot")).alias("g"))
                         .select(*KEY, F.col("g.gram").alias("grams"), F.col("g.hot").alias("hots")), "wanted-anchors")
    cut = materialize(keyed.join(wanted, KEY).select(F.col("id").isNotNull().alias("known"), *KEY, "text", "grams", "hots")
                      .mapInArrow(_cut, _SEGMENT), "segments")
    same, place = ["one", "two"], ["known", "id", "at"]
    cut = cut.withColumn("id", F.col(KEY[0]))
    plain, hot = cut.where("NOT hot").withColumns({"tag1": F.col(KEY[0]), "tag2": F.col(KEY[1])}), cut.where("hot")
    first = materialize(hot.groupBy("gram", *same).agg(F.min(F.struct(*place, "size", "words")).alias("f"))
                        .select("gram", *same, "f.*"), "hot-segments")
    many = first.groupBy("gram").agg((F.count(F.lit(1)) > group_rows).alias("many"))
    few = materialize(first.join(many, "gram").select(
        "gram", *place, F.col("one").alias("tag1"), F.col("two").alias("tag2"), "size", "words",
        F.lit(True).alias("hot"), "many"), "hot-candidates")
    candidates = plain.select(*_CANDIDATE).unionAll(few.where("NOT many").select(*_CANDIDATE))
    parsed = materialize(candidates.repartition("gram").sortWithinPartitions("gram").mapInArrow(_parse, _RANGE), "factors")
    windows = materialize(few.where("many").select(*_CANDIDATE).mapInArrow(
        _windows, "one long, two long, known boolean, id long, at long, tag1 long, tag2 long"), "hot-windows")
    starts = materialize(windows.groupBy(*same).agg(F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select(*same, "first"), "first-windows")
    dealt = windows.join(starts, same).where(F.struct(*place) > F.col("first")).select(
        F.col("tag1").alias("one"), F.col("tag2").alias("two"), "at", F.lit(WIDTH).alias("size"))
    # rows of a hot segment: those at its first place (one, or more that share an id) lose what its
    # factors cover, all later ones are one factor of the first
    held = hot.join(first.select(*same, F.struct(*place).alias("first")), same).withColumn("own", F.struct(*place))
    later = held.where("own > first").select(*KEY, "at", "size")
    covered = materialize(parsed.where("hot").select(F.col("tag1").alias("one"), F.col("tag2").alias("two"), "at", "size")
                          .unionAll(dealt), "hot-factors")
    tied = held.where("own = first").select(*KEY, *same).join(covered, same).select(*KEY, "at", "size")
    return parsed.where("NOT hot").select(F.col("tag1").alias(KEY[0]), F.col("tag2").alias(KEY[1]), "at", "size") \
        .unionAll(later).unionAll(tied)


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every row of ``docs`` with n_words, n_removed and ``kept`` (its other words, joined
    by one blank).

    A word goes if a window of WIDTH words that covers it also starts earlier: in a
    smaller id, or at an earlier word of the same id.  Null ids are below all others.
    Rows that share an id count as one document: they lose to an earlier start, not to
    each other's equal places, so fully repeated rows keep the same words.  Null and
    empty texts have no words, a null or empty ``kept`` text is empty, and texts of
    fewer than WIDTH words lose nothing.  Input columns named like the results (in the
    session's way of comparing names) are replaced; all others stay, whatever their name.
    """
    names = ["n_words", "n_removed", "kept"]
    stay = other_columns(docs, names)
    found = materialize(repeated_word_ranges(docs, id_col, text_col, group_rows).groupBy(*KEY).agg(
        F.collect_set(F.struct("at", "size")).alias("cut")), "word-ranges")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        *[c.alias(f"c{i}") for i, c in enumerate(stay.values())])
    packed = with_row_key(plain, "id", "text").join(found, KEY, "left").select(
        *[f"c{i}" for i in range(len(stay))], F.struct("text", F.col("cut.at"), F.col("cut.size")).alias("cut"))

    def run(column: pa.Array) -> list[pa.Array]:
        texts = column.field(0).cast(pa.binary()).to_pylist()
        n_words, n_removed = [], []
        for i, text in enumerate(texts):
            words = text.split() if text else []
            n_words.append(len(words))
            at = column.field(1)[i]
            if at.is_valid and len(at.values):
                edges = np.zeros(len(words) + 1, np.int64)
                at, size = at.values.to_numpy(), column.field(2)[i].values.to_numpy()
                np.add.at(edges, at, 1)
                np.add.at(edges, at + size, -1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
            n_removed.append(n_words[-1] - len(words))
            texts[i] = b" ".join(words)
        return [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]

    out = append_columns(packed, run, "n_words long, n_removed long, kept string")
    return out.toDF(*stay, *names)


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``documents``."""
    out = drop_repeated_windows(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id,
                    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
word AS (SELECT rid, doc_id, unnest(generate_series(1, len(ws))) AS pos, unnest(ws) AS w, len(ws) AS n FROM doc WHERE len(ws) > 0),
win AS (SELECT w.rid, w.pos, w.doc_id, array_to_string(d.ws[w.pos:w.pos + 19], ' ') AS s
        FROM word w JOIN doc d ON w.rid = d.rid WHERE w.pos <= w.n - 19),
ranked AS (SELECT rid, pos, rank() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, pos) AS r FROM win),
marked AS (SELECT w.*, coalesce(r.r > 1, false) AS starts FROM word w LEFT JOIN ranked r ON w.rid = r.rid AND w.pos = r.pos),
gone AS (SELECT *, bool_or(starts) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS cut FROM marked),
kept AS (SELECT rid, count(*) FILTER (cut) AS n_removed, string_agg(w, ' ' ORDER BY pos) FILTER (NOT cut) AS t FROM gone GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept ON doc.rid = kept.rid
"""


def brute_force(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(n_words, n_removed, kept_sha256) by comparing every window, for the tests."""
    split = [((i is not None, i or 0), (t or "").encode().split()) for i, t in rows]
    first: dict[tuple, tuple] = {}
    for doc, words in split:
        for k in range(len(words) - WIDTH + 1):
            w = tuple(words[k:k + WIDTH])
            first[w] = min(first.get(w, (doc, k)), (doc, k))
    out = []
    for doc, words in split:
        gone = bytearray(len(words))
        for k in range(len(words) - WIDTH + 1):
            if first[tuple(words[k:k + WIDTH])] < (doc, k):
                gone[k:k + WIDTH] = b"\x01" * WIDTH
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out
