"""Repeated byte strings removed by suffix arrays, at any number of documents.

A position is repeated if the LENGTH bytes from it also start elsewhere.  Four
steps find all of them exactly, each one moving less text than the one before:

1. Every window of LENGTH bytes belongs to the least-hashed GRAM-byte string in
   it, its anchor; neighbouring windows share one, and equal windows have equal
   anchors at equal offsets.  A run of windows with one anchor is a context, and
   a context that occurs twice makes all its windows repeated.  One row of digests
   per context is shuffled, no text.
2. Only where an anchor has several different contexts, one document of each
   context cuts it into cells of CELL windows.  What a cell's windows share (the
   core) becomes one symbol, with the few bytes around it kept.
3. Cells are shuffled by core.  The strings of each core are concatenated and
   their suffixes sorted by grouping (``suffix_array``); a window is repeated if
   the suffix before or after it shares its CELL symbols, which stand for LENGTH
   bytes.
4. The byte ranges of a document are collected and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import KEY, Plain, append_columns, materialize, ranges, read_table, utf8, with_row_key

LENGTH, GRAM, CELL = 400, 64, 16
#: Bytes of a document looked at together; neighbours overlap by LENGTH - 1.
CHUNK = 1 << 19
#: Cells of one core that a task sorts on its own; the suffixes of a larger core
#: are dealt out by the digest of their LENGTH bytes.
CORE_ROWS = 5_000
#: Symbols sorted in one suffix array.
SORTED_SYMBOLS = 200_000

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd: invertible modulo 2^64


# --- suffix sorting by grouping ----------------------------------------------

def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of ``text`` (symbols above 0) with a least symbol 0 at its end.

    First the suffixes are grouped by their Lyndon prefix: groups are taken from
    the greatest to the least, each suffix of a group finds the nearest suffix on
    its left in a lower group (previous-smaller pointers jump over all others), and
    that one's prefix grows by the group's, once for each suffix that points at it.
    Then the order inside all groups follows in one sweep: a suffix in its final
    place tells the places of the suffix before it and of those its pointers reach.
    """
    text = [*text, 0]
    n = len(text)
    symbols = sorted(set(text))
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    below, above = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))  # neighbouring groups
    previous = [-1] * n
    done = bytearray(n)
    descending = []
    current = len(symbols) - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        if own:
            own.sort()
            descending.append((current, len(own)))
            for i in own:
                done[i] = 1
            pointed: dict[int, int] = {}
            for i in own:
                p = i - 1
                while p >= 0 and done[p]:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            by_group: dict[int, dict[int, int]] = {}
            for p, k in pointed.items():
                grown = by_group.setdefault(group[p], {})
                new = grown.get(k)
                if new is None:
                    new = grown[k] = len(members)
                    members.append([])
                    below.append(-1)
                    above.append(-1)
                group[p] = new
                members[new].append(p)
            for old, grown in by_group.items():  # between the old group and the one above, most pointed-at on top
                upper = above[old]
                for k in sorted(grown, reverse=True) if len(grown) > 1 else grown:
                    below[upper], above[grown[k]] = grown[k], upper
                    upper = grown[k]
                below[upper], above[old] = old, upper
        current = below[current]
    place, at = [0] * len(members), 0
    for g, size in reversed(descending):
        place[g] = at
        at += size
    out = [n - 1] * n
    placed = bytearray(n)
    placed[n - 1] = 1
    place[group[n - 1]] += 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[place[g]] = s
            place[g] += 1
            placed[s] = 1
            s = previous[s]
    return out


def repeated_starts(strings: list[list[int]], width: int) -> list[list[bool]]:
    """For each string (of symbols above 1), which of its ``width``-long substrings
    occurs elsewhere among all strings."""
    text: list[int] = []
    begins = []
    for s in strings:
        begins.append(len(text))
        text += s
        text.append(1)
    order = suffix_array(text)
    window = bytearray(len(text) + 1)
    for b, s in zip(begins, strings):
        for i in range(b, b + len(s) - width + 1):
            window[i] = 1
    repeated = bytearray(len(text) + 1)
    before = -1
    for i in order:  # a suffix too short for a window cannot stand between two equal ones
        if window[i]:
            if before >= 0 and text[i:i + width] == text[before:before + width]:
                repeated[i] = repeated[before] = 1
            before = i
    return [[repeated[i] == 1 for i in range(b, b + len(s) - width + 1)] for b, s in zip(begins, strings)]


# --- contexts ------------------------------------------------------------------

_TABLES: dict = {}


def _tables(n: int):
    if _TABLES.get("n", 0) < n:
        n = max(n, CHUNK + LENGTH)
        for k, base in enumerate(_BASES):
            for name, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
                out = np.ones(n, np.uint64)
                out[1:] = np.uint64(b)
                _TABLES[name, k] = np.multiply.accumulate(out)
        _TABLES["n"] = n
    return _TABLES


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Digests:
    """Two rolling digests of any byte range of a chunk."""

    def __init__(self, data: np.ndarray):
        t = _tables(len(data) + 1)
        wide = data.astype(np.uint64) + np.uint64(1)
        self.down = [t["down", k] for k in range(2)]
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(wide * t["up", k][:len(data)])]) for k in range(2)]

    def of(self, k: int, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        raw = (self.sums[k][end] - self.sums[k][start]) * self.down[k][start]
        return _mix(raw + np.asarray(salt).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))


class Contexts:
    """Runs of windows with one anchor: anchor hash, anchor place, first and last
    window, and two digests of the bytes and offsets."""

    def __init__(self, data: np.ndarray):
        self.digests = Digests(data)
        grams = len(data) - GRAM + 1
        places = np.arange(grams)
        gram = _mix((self.digests.sums[0][GRAM:] - self.digests.sums[0][:grams]) * self.digests.down[0][:grams])
        bits = np.uint64((1 << 20) - 1)
        least = (gram & ~bits) | places.astype(np.uint64)  # leftmost of equals
        span, covered = LENGTH - GRAM + 1, 1
        while covered * 2 <= span:
            least = np.minimum(least[:-covered], least[covered:])
            covered *= 2
        rest = span - covered
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & bits).astype(np.int64)
        change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        self.first = np.concatenate([[0], change])
        self.last = np.concatenate([change - 1, [len(anchor) - 1]])
        self.anchor = anchor[self.first]
        self.gram = gram[self.anchor]
        salt = (self.anchor - self.first) * 1024 + (self.last - self.first)
        self.one = self.digests.of(0, self.first, self.last + LENGTH, salt)
        self.two = self.digests.of(1, self.first, self.last + LENGTH, salt)


def chunks(text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping parts of a text such that each window is in exactly one."""
    for at in range(0, max(len(text) - LENGTH + 1, 0), CHUNK):
        yield at, text[at:at + CHUNK + LENGTH - 1]


def context_rows(keyed: DataFrame) -> DataFrame:
    """Rows (row key, gram, one, two, times): the different contexts of every document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            parts: list[tuple] = []
            for i in np.flatnonzero(np.diff(offsets) >= LENGTH).tolist():
                for _, chunk in chunks(data[offsets[i]:offsets[i + 1]]):
                    c = Contexts(chunk)
                    _, first, times = np.unique(c.one, return_index=True, return_counts=True)
                    parts.append((np.full(len(first), i), c.gram[first], c.one[first], c.two[first], times))
            if parts:
                row, gram, one, two, times = (np.concatenate(x) for x in zip(*parts))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(x.view(np.int64)) for x in
                                                                           (gram, one, two)],
                     pa.array(np.minimum(times, 2).astype(np.int32))], [*KEY, "gram", "one", "two", "times"])

    return keyed.mapInArrow(run, f"{KEY[0]} long, {KEY[1]} long, gram long, one long, two long, times int")


def context_states(rows: DataFrame) -> DataFrame:
    """Per document: the contexts that are repeated (state 1), that it must cut into
    cells (2), or both (3).  Documents without any have no row."""
    context = ["gram", "one", "two"]
    # what the joins below look up is written first: a join of two plain shuffles can split a hot anchor or context
    anchors = materialize(rows.groupBy("gram").agg(
        F.sum("times").alias("all"), (F.min("one") != F.max("one")).alias("several"))
        .where("all > 1").select("gram", "several"), "anchors")
    shared = rows.join(anchors, "gram")
    known = materialize(shared.groupBy(*context).agg(
        (F.sum("times") > 1).cast("int").alias("dup"), F.min(F.struct(*KEY)).alias("holder"))
        .join(anchors, "gram").where("dup = 1 OR several"), "shared-contexts")
    state = F.col("dup") + F.when(F.col("several") & (F.col("holder") == F.struct(*[F.col(k) for k in KEY])), 2).otherwise(0)
    # a set: any number of repeated rows (one key, the same contexts) collapses already before the shuffle
    return rows.join(known, context).select(*KEY, "one", state.alias("state")).where("state > 0") \
        .groupBy(*KEY).agg(F.collect_set(F.struct("one", "state")).alias("found")) \
        .select(*KEY, F.col("found.one").alias("ones"), F.col("found.state").alias("states"))


# --- cells ---------------------------------------------------------------------

_CELLS = "core1 long, core2 long, {} long, {} long, at long, size int, left binary, right binary".format(*KEY)


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the contexts in state 2 or 3, and ready byte ranges (size over 0)."""
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        out: list[tuple] = []
        for i in range(batch.num_rows):
            ones = np.array(batch.column(3)[i].values.to_numpy(), np.int64)
            states = np.array(batch.column(4)[i].values.to_numpy(), np.int64)
            order = np.argsort(ones, kind="stable")
            ones, states = ones[order], states[order]
            for base, chunk in chunks(data[offsets[i]:offsets[i + 1]]):
                c = Contexts(chunk)
                mine = c.one.view(np.int64)
                at = np.minimum(np.searchsorted(ones, mine), len(ones) - 1)
                state = np.where(ones[at] == mine, states[at], 0)
                full = np.flatnonzero(state & 1)
                if len(full):
                    lo, hi = _merge(c.first[full] + base, c.last[full] + LENGTH + base)
                    out += [(i, 0, 0, a, b - a, b"", b"") for a, b in zip(lo.tolist(), hi.tolist())]
                cut = np.flatnonzero(state & 2)
                if not len(cut):
                    continue
                low = (c.first[cut] - c.anchor[cut]) // CELL
                counts = (c.last[cut] - c.anchor[cut]) // CELL - low + 1
                owner = np.repeat(cut, counts)
                origin = c.anchor[owner] + (np.repeat(low, counts) + ranges(np.zeros(len(cut), np.int64), counts)) * CELL
                begin = np.maximum(c.first[owner], origin)
                end = np.minimum(c.last[owner], origin + CELL - 1)
                core, after = origin + CELL - 1, origin + LENGTH
                one, two = c.digests.of(0, core, after), c.digests.of(1, core, after)
                raw = chunk.tobytes()
                out += [(i, x, y, b + base, 0, raw[b:s], raw[t:e + LENGTH]) for x, y, b, s, t, e in zip(
                    one.view(np.int64).tolist(), two.view(np.int64).tolist(), begin.tolist(), core.tolist(),
                    after.tolist(), end.tolist())]
            if len(out) > 20_000:
                yield _cell_batch(batch, out)
                out = []
        if out:
            yield _cell_batch(batch, out)


def _cell_batch(batch: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
    row, one, two, at, size, left, right = zip(*out)
    rows = pa.array(row, pa.int64())
    keys = [batch.column(0).take(rows), batch.column(1).take(rows)]
    # ready ranges travel along, dealt out by their document
    spread = pa.array([o if not s else k for o, s, k in zip(one, size, keys[1].to_pylist())], pa.int64())
    return pa.RecordBatch.from_arrays(
        [spread, pa.array(two, pa.int64()), *keys, pa.array(at, pa.int64()), pa.array(size, pa.int32()),
         pa.array(left, pa.binary()), pa.array(right, pa.binary())],
        ["core1", "core2", *KEY, "at", "size", "left", "right"])


def _merge(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges sorted by start; touching ranges are one."""
    reach = np.maximum.accumulate(hi)
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return lo[at], np.concatenate([reach[at[1:] - 1], reach[-1:]])


_FOUND = f"kind int, {KEY[0]} long, {KEY[1]} long, at long, size int, digest binary"


def _sort_cells(core_rows: int):
    """mapInArrow function over partitions sorted by core: byte ranges (kind 0), and
    for over-full cores one row for each window with its digest (kind 1)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        waiting: list[list[tuple]] = []
        symbols = 0
        group: list[tuple] = []
        core = None
        spilling = False

        def flush_found():
            kind, k1, k2, at, size, digest = zip(*found)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(at, pa.int64()), pa.array(size, pa.int32()), pa.array(digest, pa.binary())],
                ["kind", *KEY, "at", "size", "digest"])
            found.clear()
            return batch

        def ranges_of(rows, flags):
            for k1, k2, at, _, _ in rows:
                i = 0
                while i < len(flags):
                    if flags[i]:
                        j = i
                        while j + 1 < len(flags) and flags[j + 1]:
                            j += 1
                        found.append((0, k1, k2, at + i, j - i + LENGTH, None))
                        i = j
                    i += 1

        def sort_waiting():
            nonlocal symbols
            strings, owners = [], []
            for number, rows in enumerate(waiting):
                alike: dict[tuple, list] = {}
                for row in rows:
                    alike.setdefault((row[3], row[4]), []).append(row)
                if len(alike) == 1:  # one string only: all its windows are repeated, by number
                    ranges_of(rows, [True] * _windows(rows[0][3], rows[0][4]))
                    continue
                for (left, right), same in alike.items():
                    strings.append([*[b + 2 for b in left], 300 + number, *[b + 2 for b in right]])
                    owners.append(same)
            if strings:
                for same, flags in zip(owners, repeated_starts(strings, CELL)):
                    ranges_of(same, flags if len(same) == 1 else [True] * len(flags))
            waiting.clear()
            symbols = 0

        def end_group():
            nonlocal symbols
            if spilling:
                deal(group)
            elif len(group) > 1:
                waiting.append(list(group))
                symbols += sum(2 + len(r[3]) + len(r[4]) for r in group)
                if symbols > SORTED_SYMBOLS:
                    sort_waiting()
            group.clear()

        def deal(rows):
            head = b"%d:%d:" % core
            for k1, k2, at, left, right in rows:
                for i in range(_windows(left, right)):
                    side = left[i:] + b"|" + right[:CELL - 1 - len(left[i:])]
                    found.append((1, k1, k2, at + i, LENGTH, hashlib.blake2b(
                        head + b"%d|" % len(left[i:]) + side, digest_size=16).digest()))

        for batch in batches:
            for c1, c2, k1, k2, at, size, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                if size:
                    found.append((0, k1, k2, at, size, None))
                    continue
                if (c1, c2) != core:
                    end_group()
                    core, spilling = (c1, c2), False
                group.append((k1, k2, at, left, right))
                if len(group) > core_rows:
                    spilling = True
                    deal(group)
                    group.clear()
                if len(found) > 20_000:
                    yield flush_found()
        end_group()
        sort_waiting()
        if found:
            yield flush_found()

    return run


def _windows(left: bytes, right: bytes) -> int:
    """Windows of a cell: each takes CELL - 1 bytes around the core."""
    return len(left) + len(right) - CELL + 2


def repeated_ranges(docs: DataFrame, id_col: str, text_col: str, core_rows: int = CORE_ROWS) -> DataFrame:
    """Rows (row key, at, size): byte ranges that cover exactly the repeated windows."""
    keyed = with_row_key(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__id", "__text")
    texts = keyed.select(*KEY, "__text")
    rows = materialize(context_rows(texts), "contexts")
    # rows with the same key have the same text and the same contexts: one of them cuts
    cells = texts.dropDuplicates(KEY).join(context_states(rows), KEY).select(*KEY, "__text", "ones", "states").mapInArrow(_cells, _CELLS)
    found = materialize(cells.repartition("core1", "core2").sortWithinPartitions("core1", "core2")
                        .mapInArrow(_sort_cells(core_rows), _FOUND), "repeats")
    dealt = found.where("kind = 1")
    twice = dealt.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    return found.where("kind = 0").select(*KEY, "at", "size").unionAll(
        dealt.join(twice, "digest").select(*KEY, "at", "size"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 core_rows: int = CORE_ROWS) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans and ``kept`` (binary: the
    remaining bytes, which need not be whole characters).

    A byte goes if a LENGTH-byte string that covers it also starts anywhere else,
    in the same or another document; all copies lose it.  Null and empty texts, and
    those shorter than LENGTH, lose nothing (a null text has 0 bytes).  Fully
    repeated rows are copies of each other.  Input columns named like the results
    are replaced.
    """
    plain, names = Plain(docs), ["n_bytes", "n_removed", "n_spans", "kept"]
    id_col, text_col = plain.of(id_col), plain.of(text_col)
    stay = plain.kept(names)
    found = repeated_ranges(plain.df, id_col, text_col, core_rows).groupBy(*KEY).agg(
        F.collect_list("at").alias("__at"), F.collect_list("size").alias("__size"))
    joined = with_row_key(plain.df, id_col, text_col).join(found, KEY, "left")
    packed = joined.select(*stay, F.struct(F.col(text_col).alias("t"), "__at", "__size").alias("cut"))

    def run(column: pa.Array) -> list[pa.Array]:
        data, offsets = utf8(column.field(0))
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i in range(len(column)):
            text = data[offsets[i]:offsets[i + 1]]
            at = column.field(1)[i]
            removed = spans = 0
            if at.is_valid and len(at.values):
                at = at.values.to_numpy()
                order = np.argsort(at, kind="stable")
                at, size = at[order], column.field(2)[i].values.to_numpy()[order]
                lo, hi = _merge(at, at + size)
                spans, removed = len(lo), int((hi - lo).sum())
                edges = np.zeros(len(text) + 1, np.int8)
                edges[lo] += 1
                edges[hi] -= 1
                text_kept = text[np.cumsum(edges[:-1], dtype=np.int8) == 0].tobytes()
            else:
                text_kept = text.tobytes()
            n_bytes.append(len(text))
            n_removed.append(removed)
            n_spans.append(spans)
            kept.append(text_kept)
        return [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)] + [pa.array(kept, pa.binary())]

    out = append_columns(packed, run, "n_bytes long, n_removed long, n_spans long, kept binary")
    return out.toDF(*stay.values(), *names)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``documents``."""
    out = drop_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[str | None]) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) by counting every window, for the tests."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - LENGTH + 1):
            w = r[i:i + LENGTH]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - LENGTH + 1):
            if seen[r[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = b"\x01" * LENGTH
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
