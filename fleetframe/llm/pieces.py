"""SentencePiece encoding and decoding with suffix-array matching.

The new words of a block of texts are concatenated and their suffixes sorted;
a binary search for every piece of the vocabulary gives the range of its
occurrences.  The occurrences are edges between character positions; sorted by
the position where they end, they are relaxed in that order: an edge extends
the encoding that ends where it starts if the model would leave its last piece
and the edge's piece side by side.  For a merge (BPE) model every position has
exactly one such encoding, and the one at a word's end is the model's own.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import Plain, append_columns, append_to_table, ranges, read_table, text_blocks

#: Default model file (a parameter of every function here).
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words whose encodings a task remembers (bounds its memory).
WORDS_HELD = 500_000

_WORDS = re.compile(r"\n| *[^ \n]+| +")
_NONE, _START = -1, -2


class PieceTokenizer:
    """A SentencePiece merge model with byte fallback and blank-prefixed words."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.scores = [sp.get_score(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        usable = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.rank = {self.pieces[i]: (-self.scores[i], i) for i in usable}
        if any("▁" in p.lstrip("▁") or "\n" in p for p in self.rank) or len(self.bytes) not in (0, 256) \
                or any(s != int(s) for s in self.scores):
            raise ValueError("not a merge model with blank-prefixed pieces")
        self.usable = np.array(usable, np.int64)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.longest = int(self.lengths[self.usable].max())
        self.chars = np.frombuffer("".join(self.pieces[i] for i in usable).encode("utf-32-le"), np.uint32)
        self.char_starts = np.concatenate([[0], np.cumsum(self.lengths[self.usable])])
        self.known = np.unique(self.chars)
        raw = [b"" if sp.is_control(i) else bytes([int(self.pieces[i][3:5], 16)]) if sp.is_byte(i)
               else " ⁇ ".encode() if i == self.unknown else self.pieces[i].replace("▁", " ").encode()
               for i in range(n)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_sizes = np.array([len(r) for r in raw], np.int64)
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.alone: dict[int, bool] = {}
        self.pair_keys = np.full(1 << 22, -1, np.int64)  # direct-mapped: the last pair tested in a slot
        self.pair_fits = np.zeros(1 << 22, bool)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    # --- which pieces may stand side by side ---------------------------------

    def merged(self, text: str) -> list[str]:
        """The model's merges on a short string: best piece first, the leftmost if tied."""
        parts, rank = list(text), self.rank
        best = [rank.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            at, least = -1, None
            for i, r in enumerate(best):
                if r is not None and (least is None or r[0] < least):
                    at, least = i, r[0]
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del best[at]
            if at < len(best):
                best[at] = rank.get(parts[at] + parts[at + 1])
            if at:
                best[at - 1] = rank.get(parts[at - 1] + parts[at])

    def stands_alone(self, ids: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids), bool)
        kinds, where = np.unique(ids, return_inverse=True)
        for k, i in enumerate(kinds.tolist()):
            if i not in self.alone:
                self.alone[i] = i == self.unknown or self.merged(self.pieces[i]) == [self.pieces[i]]
            out[where == k] = self.alone[i]
        return out

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges of left + right leave exactly these two pieces."""
        keys = left << 32 | right
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)
        new = np.flatnonzero(self.pair_keys[slots] != keys)
        out = self.pair_fits[slots]
        if len(new):
            kinds, where = np.unique(keys[new], return_inverse=True)
            fit = np.empty(len(kinds), bool)
            for k, key in enumerate(kinds.tolist()):
                a, b = self.pieces[key >> 32], self.pieces[key & 0xFFFFFFFF]
                fit[k] = self.merged(a + b) == [a, b]
            out[new] = fit[where]
            self.pair_keys[slots[new]] = keys[new]
            self.pair_fits[slots[new]] = fit[where]
        return out

    # --- matching and relaxing ------------------------------------------------

    def edges(self, codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, piece) of every occurrence of every piece in ``codes``, the
        characters' numbers in ``known`` from 1 (0: between words, len + 1: others)."""
        bits = int(len(known) + 1).bit_length()
        per = 64 // bits
        levels = -(-self.longest // per)
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(per * levels + 1, codes.dtype)]).astype(np.uint64)
        first = np.zeros(n + per * (levels - 1), np.uint64)
        for j in range(per):
            first = first << np.uint64(bits) | padded[j:j + len(first)]
        keys = [first[per * j:per * j + n] for j in range(levels)]
        order = np.lexsort(keys[::-1])
        numbers = np.zeros(int(self.known[-1]) + 1, np.int64)
        numbers[known[known <= self.known[-1]]] = np.flatnonzero(known <= self.known[-1]) + 1
        piece_codes = numbers[self.chars]
        present = np.minimum.reduceat(piece_codes, self.char_starts[:-1]) > 0
        ids = self.usable[present]
        sizes, begin = self.lengths[ids], self.char_starts[:-1][present]
        low, high = np.zeros(len(ids), np.int64), np.full(len(ids), n, np.int64)
        for j in range(levels):
            active = np.flatnonzero(sizes > per * j)
            if not len(active):
                break
            least = np.zeros(len(active), np.uint64)
            most = np.zeros(len(active), np.uint64)
            for i in range(per):
                at = per * j + i
                inside = at < sizes[active]
                c = np.where(inside, piece_codes[np.minimum(begin[active] + at, len(piece_codes) - 1)], 0)
                least = least << np.uint64(bits) | c.astype(np.uint64)
                most = most << np.uint64(bits) | np.where(inside, c, (1 << bits) - 1).astype(np.uint64)
            column = keys[j][order]
            if j == 0:
                low[active] = np.searchsorted(column, least, "left")
                high[active] = np.searchsorted(column, most, "right")
            else:
                lo, hi = low[active], high[active]
                low[active] = _bisect(column, lo, hi, least, False)
                high[active] = _bisect(column, lo, hi, most, True)
        found = np.maximum(high - low, 0)
        return order[ranges(low, found)], np.repeat(ids, found)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, concatenated, and the number of ids of each word."""
        joined = "\n" + "\n".join(words) + "\n"
        points = np.frombuffer(joined.replace(" ", "▁").encode("utf-32-le", "surrogatepass"), np.uint32)
        gap = points == 10
        kinds, where = np.unique(points, return_inverse=True)
        in_model = np.isin(kinds, self.known)
        known = kinds[in_model]
        numbers = np.full(len(kinds), len(known) + 1, np.int64)
        numbers[in_model] = np.arange(1, len(known) + 1)
        numbers[kinds == 10] = 0
        codes = numbers[where]
        position, piece = self.edges(codes, known) if len(known) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        size = self.lengths[piece]
        other = np.flatnonzero(codes == len(known) + 1)  # characters outside the vocabulary: an edge each
        position = np.concatenate([position, other])
        piece = np.concatenate([piece, np.full(len(other), self.unknown, np.int64)])
        end = position + np.concatenate([size, np.ones(len(other), np.int64)])
        gaps = np.flatnonzero(gap)
        word_start = gaps[:-1] + 1
        local = end - word_start[np.cumsum(gap)[position] - 1]
        if len(local) and local.max() < 1 << 16:
            local = local.astype(np.uint16)
        order = np.argsort(local, kind="stable")
        position, piece, end, local = position[order], piece[order], end[order], local[order]
        last = np.full(len(points) + 1, _NONE, np.int64)
        last[word_start] = _START
        cuts = np.flatnonzero(np.concatenate([[True], local[1:] != local[:-1], [True]])) if len(local) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            before = last[position[lo:hi]]
            open_ = np.flatnonzero(before != _NONE)
            if not len(open_):
                continue
            left, right = before[open_], piece[lo:hi][open_]
            fit = (left == self.unknown) | (right == self.unknown)
            paired = np.flatnonzero(~fit & (left >= 0))
            fit[paired] = self.fits(left[paired], right[paired])
            single = np.flatnonzero(((left == _START) | (left == self.unknown)) & (right != self.unknown))
            fit[single] = self.stands_alone(right[single])
            fit[(left == _START) & (right == self.unknown)] = True
            good = open_[fit]
            last[end[lo:hi][good]] = piece[lo:hi][good]
        tokens = np.full(len(points) + 1, _NONE, np.int64)
        at = gaps[1:][gaps[1:] > word_start]
        while len(at):
            t = last[at]
            if (t == _NONE).any():
                raise RuntimeError("a word has no encoding")  # cannot happen for a merge model
            going = t >= 0
            at, t = at[going], t[going]
            tokens[at] = t
            at = at - np.where(t == self.unknown, 1, self.lengths[t])
        used = np.flatnonzero(tokens >= 0)
        ids, word = tokens[used], np.searchsorted(word_start, used - 1, side="right") - 1
        if len(other) and self.bytes:
            raw = [[self.bytes[b] for b in chr(int(points[p - 1])).encode("utf-8", "replace")] if t == self.unknown
                   else None for p, t in zip(used.tolist(), ids.tolist())]
            width = np.array([len(r) if r else 1 for r in raw])
            place = np.cumsum(width) - width
            wide = np.repeat(ids, width)
            for r, p in zip(raw, place.tolist()):
                if r:
                    wide[p:p + len(r)] = r
            ids, word = wide, np.repeat(word, width)
        return ids.astype(np.int32), np.bincount(word, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the number of ids of each text."""
        if len(self.index) > WORDS_HELD:
            self.forget()
        split = [_WORDS.findall((" " + t).replace("▁", " ")) if t else [] for t in texts]
        new = list(set().union(*split).difference(self.index)) if split else []
        plain = [w for w in new if w != "\n"]
        if new:
            ids, counts = self.encode_words(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            if len(plain) < len(new):
                line = [self.bytes[10]] if self.bytes else [self.unknown]
                ids, counts = np.concatenate([ids, np.array(line, np.int32)]), np.append(counts, 1)
                plain.append("\n")
            base = len(self.index)
            self.index.update(zip(plain, range(base, base + len(plain))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, ids])
        sizes = np.array([len(s) for s in split], np.int64)
        words = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        counts = self.counts[words]
        owner = np.repeat(np.arange(len(texts)), sizes)
        return self.flat[ranges(self.starts[words], counts)], \
            np.bincount(owner, counts, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids; the blank that encoding put in front is removed."""
        ids = np.asarray(ids, np.int64)
        raw = self.raw[ranges(self.raw_starts[ids], self.raw_sizes[ids])].tobytes()
        return raw.decode("utf-8", "replace")[1 if raw[:1] == b" " else 0:]


_LOADED: dict[bytes, PieceTokenizer] = {}


def tokenizer(model: bytes) -> PieceTokenizer:
    """The process's tokenizer for a model, kept from task to task."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PieceTokenizer(model)
    return _LOADED[key]


def _bisect(column, low, high, wanted, right: bool) -> np.ndarray:
    """Bisection of many values, each within its own sorted range of ``column``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        up = column[mid] <= wanted[open_] if right else column[mid] < wanted[open_]
        low[open_[up]] = mid[up] + 1
        high[open_[~up]] = mid[~up]


def _shared_model(spark: SparkSession, model: str):
    with open(model, "rb") as f:  # a driver-side file of fixed size; tasks get its bytes
        return spark.sparkContext.broadcast(f.read())


def encode_pieces(docs: DataFrame, text_col: str = "text", model: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """Add the ids (array<int>) of every whole text, as the model itself encodes it.

    Null and empty texts have no ids.  Other columns are kept; one named like the
    result is replaced.
    """
    shared = _shared_model(docs.sparkSession, model)

    def run(column: pa.Array) -> list[pa.Array]:
        tok, parts, counts = tokenizer(shared.value), [], []
        for _, _, texts in text_blocks(column):
            ids, n = tok.encode(texts)
            parts.append(ids)
            counts.append(n)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))]

    return append_to_table(docs, lambda t: F.col(t.of(text_col)), run, f"`{ids_col}` array<int>")


def decode_pieces(tokens: DataFrame, ids_col: str = "ids", model: str = MODEL, text_col: str = "text") -> DataFrame:
    """Add the text of every id sequence; null and empty sequences give an empty text."""
    shared = _shared_model(tokens.sparkSession, model)

    def run(column: pa.Array) -> list[pa.Array]:
        tok = tokenizer(shared.value)
        return [pa.array([tok.decode(x) if x else "" for x in column.to_pylist()], pa.string())]

    return append_to_table(tokens, lambda t: F.col(t.of(ids_col)), run, f"`{text_col}` string")


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """The id column of every row with ids (array<int>), decoded (the text that the ids give)
    and round_trip (whether it is the text again).  Both ways in one pass, block by block, so
    that a task holds one tokenizer and the text of one batch.  Null reads as empty."""
    shared = _shared_model(docs.sparkSession, model)

    def run(column: pa.Array) -> list[pa.Array]:
        tok = tokenizer(shared.value)
        parts: list[list[pa.Array]] = [[], [], []]
        for _, _, texts in text_blocks(column, 1 << 18):
            ids, counts = tok.encode(texts)
            ends = np.concatenate([[0], np.cumsum(counts)])
            decoded = [tok.decode(ids[a:b]) if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            parts[0].append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
            parts[1].append(pa.array(decoded, pa.string()))
            parts[2].append(pa.array([d == t for d, t in zip(decoded, texts)], pa.bool_()))
        return [pa.concat_arrays(p) for p in parts]

    plain = Plain(docs)
    source = plain.df.select(plain.of(id_col), plain.of(text_col))
    out = append_columns(source, run, "ids array<int>, decoded string, round_trip boolean")
    return out.withColumnRenamed(plain.of(id_col), id_col)


def round_trips(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Add n_tokens, ids_sha256 (of the ids as little-endian 32-bit numbers) and
    round_trip: whether decoding the ids gives the text again (a text that holds the
    blank mark U+2581 itself does not).  Null reads as empty."""
    shared = _shared_model(docs.sparkSession, model)

    def run(column: pa.Array) -> list[pa.Array]:
        tok, sizes, digests, same = tokenizer(shared.value), [], [], []
        for _, _, texts in text_blocks(column):
            ids, counts = tok.encode(texts)
            at = 0
            for text, n in zip(texts, counts.tolist()):
                own = ids[at:at + n]
                at += n
                sizes.append(n)
                digests.append(hashlib.sha256(own.astype("<i4").tobytes()).hexdigest())
                same.append(tok.decode(own) == text)
        return [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(same, pa.bool_())]

    return append_to_table(docs, lambda t: F.col(t.of(text_col)), run,
                           "n_tokens long, ids_sha256 string, round_trip boolean")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, round_trip of every row of ``documents``."""
    return round_trips(read_table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "n_tokens", "ids_sha256", "round_trip")
