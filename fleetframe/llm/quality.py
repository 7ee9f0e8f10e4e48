"""Text quality from a factorisation machine.

Inputs are hashed words (shares of the text), statistics of the text's
structure and metadata numbers.  The machine adds a weight for each input and
low-rank interactions of all pairs, scored in linear time by
``sum_f ((sum v x)^2 - sum (v x)^2) / 2``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import Plain, append_to_table, crc32_fold, first_labelled, read_table, utf8, blocks

BITS, RANK = 14, 8
#: Documented bounds of the training sample: rows of each class, and characters of their texts together; longer
#: texts than PLAIN_CHARS are taken only for a class with few others (``first_labelled``).
ROWS_PER_CLASS, CHARS_PER_CLASS = 2000, 10_000_000
PLAIN_CHARS = 20_000
BLOCK = 1 << 18

STATS = ["log_bytes", "log_words", "word_length", "upper", "digit", "symbol", "exclaim", "pipe", "stop_mark",
         "high_byte", "space", "line_rate", "distinct_words", "repeat_next", "top_word", "decorated", "upper_words",
         "log_line", "letters_per_word_var", "log_n_chars"]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.array([33 <= i < 127 and not chr(i).isalnum() and chr(i) not in ".,;:'\"-()?" for i in range(256)])
_STOP = np.array([chr(i) in ".,;:?" for i in range(256)])
_HIGH = np.arange(256) >= 128
_LETTER = np.array([(i < 128 and chr(i).isalnum()) or i >= 128 for i in range(256)])

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    if _POWERS["n"] < n:
        n = max(n, 1 << 19)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            out = np.ones(n, np.uint64)
            out[1:] = np.uint64(base)
            _POWERS[name] = np.multiply.accumulate(out)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def _by_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


@dataclass
class Inputs:
    """Sparse word inputs (text, bucket, share) and the dense statistics."""
    text: np.ndarray
    bucket: np.ndarray
    share: np.ndarray
    stats: np.ndarray


def inputs_of(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> Inputs:
    """Inputs of the texts in ``data[offsets[i]:offsets[i + 1]]``; a word is a run
    of bytes between ASCII white space, hashed in lower case."""
    base = int(offsets[0])
    chunk = data[base:int(offsets[-1])]
    bounds = offsets - base
    n, size = len(bounds) - 1, np.diff(bounds).astype(float)
    if len(chunk) == 0:
        chunk = np.full(1, 32, np.uint8)
        bounds = np.concatenate([bounds[:-1], [0]])
    space = _SPACE[chunk]
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    cut = bounds[:-1][bounds[:-1] < len(chunk)]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    follows = np.concatenate([starts[1:], [len(chunk)]])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    word_no = np.cumsum(first) - 1
    length = np.bincount(word_no[inside], minlength=len(starts))[:len(starts)] if len(starts) else np.zeros(0, np.int64)
    ends = starts + length
    lower = np.where(_UPPER[chunk], chunk + 32, chunk)
    up, down = _powers(len(chunk) + 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lower.astype(np.uint64) * up[:len(chunk)])])
    hashes = (prefix[ends] - prefix[starts]) * down[starts]
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    hashes ^= hashes >> np.uint64(29)
    words = np.bincount(owner, minlength=n).astype(float)
    at_least = np.maximum(words, 1)
    order = np.lexsort((hashes, owner))
    ow, ha = owner[order], hashes[order]
    new = np.ones(len(ow), bool)
    new[1:] = (ow[1:] != ow[:-1]) | (ha[1:] != ha[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.concatenate([at, [len(ow)]]))
    text, share = ow[at], times / at_least[ow[at]]
    top = np.zeros(n)
    np.maximum.at(top, text, share)
    repeated = np.zeros(len(starts), bool)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    last = chunk[np.maximum(ends - 1, 0)] if len(ends) else np.zeros(0, np.uint8)
    upper_at = np.concatenate([[0], np.cumsum(_UPPER[chunk])])
    shouted = (upper_at[ends] - upper_at[starts] >= 2)
    bytes_ = np.maximum(size, 1)
    mean_length = np.bincount(owner, length, minlength=n) / at_least
    lines = _by_text(chunk == 10, bounds) + 1
    stats = np.stack([
        np.log1p(size), np.log1p(words), mean_length,
        _by_text(_UPPER[chunk], bounds) / bytes_, _by_text(_DIGIT[chunk], bounds) / bytes_,
        _by_text(_SYMBOL[chunk], bounds) / bytes_, _by_text(chunk == 33, bounds) / bytes_,
        _by_text(chunk == 124, bounds) / bytes_, _by_text(_STOP[chunk], bounds) / bytes_,
        _by_text(_HIGH[chunk], bounds) / bytes_, _by_text(space, bounds) / bytes_,
        lines / bytes_, np.bincount(text, minlength=n) / at_least,
        np.bincount(owner, repeated, minlength=n) / at_least, top,
        np.bincount(owner, _SYMBOL[last], minlength=n) / at_least,
        np.bincount(owner, shouted, minlength=n) / at_least, np.log1p(size / lines),
        np.sqrt(np.maximum(0, np.bincount(owner, length.astype(float) ** 2, minlength=n) / at_least - mean_length ** 2)),
        np.log1p(np.maximum(n_chars, 0)),
    ], 1)
    return Inputs(text.astype(np.int64), (ha[at] >> np.uint64(64 - BITS)).astype(np.int64), share, stats)


@dataclass
class QualityModel:
    """Weights of the machine; the statistics' slots follow the word buckets."""
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


def _dense(model: QualityModel, stats: np.ndarray) -> np.ndarray:
    return np.clip((stats - model.mean) / model.spread, -4, 4) / 2.0


def logits(model: QualityModel, x: Inputs):
    """Machine output of every text, with the factor sums that training needs."""
    n = len(x.stats)
    dense = _dense(model, x.stats)
    words = 1 << BITS
    value = np.sqrt(x.share)  # damps the few words that fill a text
    out = model.bias + np.bincount(x.text, value * model.linear[x.bucket], minlength=n) + dense @ model.linear[words:]
    sums = dense @ model.factors[words:]
    squares = (dense ** 2) @ (model.factors[words:] ** 2)
    for f in range(model.factors.shape[1]):
        part = value * model.factors[x.bucket, f]
        sums[:, f] += np.bincount(x.text, part, minlength=n)
        squares[:, f] += np.bincount(x.text, part * part, minlength=n)
    return out + 0.5 * (sums ** 2 - squares).sum(1), sums, dense, value


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _pack(texts: list[str], n_chars):
    raw = [t.encode("utf-8", "replace") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return inputs_of(np.frombuffer(b"".join(raw), np.uint8), offsets, np.asarray(n_chars, float))


def train(texts: list[str], n_chars, labels, epochs: int = 40, rate: float = 0.05, ridge: float = 2e-4,
          seed: int = 11) -> QualityModel:
    """Mini-batch Adagrad on the logistic loss; one class only gives a constant model."""
    rng = np.random.default_rng(seed)
    labels, n_chars = np.asarray(labels, float), np.asarray(n_chars, float)
    words, width = 1 << BITS, (1 << BITS) + len(STATS)
    model = QualityModel(0.0, np.zeros(width), rng.normal(0, 0.05, (width, RANK)),
                         np.zeros(len(STATS)), np.ones(len(STATS)))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model.bias = float(np.log(share / (1 - share)))
    if len(labels) == 0 or labels.min() == labels.max():
        model.factors[:] = 0
        return model
    order = rng.permutation(len(texts))
    groups = [order[i:i + 64] for i in range(0, len(order), 64)]
    packed = [_pack([texts[i] for i in g], n_chars[g]) for g in groups]
    stats = np.concatenate([p.stats for p in packed])
    model.mean, model.spread = stats.mean(0), np.maximum(stats.std(0), 1e-6)
    seen_linear, seen_factors, seen_bias = np.full(width, 1e-2), np.full((width, RANK), 1e-2), 1e-2
    epochs = max(epochs, -(-400 // len(groups)))
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            x, y = packed[k], labels[groups[k]]
            out, sums, dense, value = logits(model, x)
            error = (_sigmoid(out) - y) / len(y) * np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
            ids = np.concatenate([np.unique(x.bucket), np.arange(words, width)])
            each = error[x.text] * value
            grad = np.concatenate([np.bincount(x.bucket, each, minlength=words), error @ dense])[ids]
            grad += ridge * model.linear[ids]
            own = np.concatenate([np.bincount(x.bucket, each * value, minlength=words), error @ dense ** 2])[ids]
            cross = np.empty((len(ids), RANK))
            for f in range(RANK):
                cross[:, f] = np.concatenate([np.bincount(x.bucket, each * sums[x.text, f], minlength=words),
                                              (error * sums[:, f]) @ dense])[ids]
            cross += ridge * model.factors[ids] - own[:, None] * model.factors[ids]
            seen_linear[ids] += grad ** 2
            seen_factors[ids] += cross ** 2
            seen_bias += error.sum() ** 2
            model.linear[ids] -= rate * grad / np.sqrt(seen_linear[ids])
            model.factors[ids] -= rate * cross / np.sqrt(seen_factors[ids])
            model.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fold=None,
                rows_per_class: int = ROWS_PER_CLASS, chars_per_class: int = CHARS_PER_CLASS) -> QualityModel:
    """Train on a bounded sample (``first_labelled``) of the rows where ``fold`` holds."""
    fold = F.lit(True) if fold is None else fold
    meta = docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.length("text"))
    rows = first_labelled(meta, labels, label_col, fold, rows_per_class, chars_per_class, ["text", "n_chars"], PLAIN_CHARS) \
        .select("doc_id", "text", "n_chars", "label").toPandas().sort_values("doc_id")
    return train(rows["text"].tolist(), rows["n_chars"].fillna(0).to_numpy(), rows["label"].to_numpy())


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text",
                  score: str = "score", predicted: str = "predicted", chars_col: str = "n_chars") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on).

    Every whole text is scored; null and empty texts have no words and zero
    statistics.  The metadata input is ``chars_col``: null or missing, it is the
    text's length.  All other columns are kept; columns named like the results
    are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # (2^14 + 20) x 9 numbers

    def source(t: Plain):
        text, chars = t.of(text_col), t.find(chars_col)
        length = F.coalesce(F.length(text), F.lit(0))
        meta = F.coalesce(F.col(chars).cast("long"), length) if chars else length
        return F.struct(F.col(text).alias("t"), meta.cast("long").alias("n"))

    def run(column: pa.Array) -> list[pa.Array]:
        m = shared.value
        data, offsets = utf8(column.field(0))
        chars = column.field(1).to_numpy(zero_copy_only=False).astype(float)
        out = np.empty(len(column))
        for lo, hi in blocks(offsets, BLOCK):
            out[lo:hi] = _sigmoid(logits(m, inputs_of(data, offsets[lo:hi + 1], chars[lo:hi]))[0])
        return [pa.array(out), pa.array((out >= 0.5).astype(np.int32))]

    return append_to_table(docs, source, run, f"`{score}` double, `{predicted}` int")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``documents``; labels
    with crc32(doc_id) mod 3 = 1 are held out of the training (null id: held_out NULL)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"), fold=crc32_fold("doc_id", 3) != 1)
    held = docs.withColumn("held_out", crc32_fold("doc_id", 3) == 1)
    return score_quality(held, model).select("doc_id", "held_out", "score", "predicted")
