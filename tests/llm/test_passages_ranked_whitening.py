"""Substring dedup, ranked search and whitening against brute force and SQL, and in odd cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetframe.llm import common, passages, ranked, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_chars long, score string, `a.b` int, __text string, __row_id int, N_Words int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ids and places, clashing column names."""
    long = " ".join(f"word{i % 977} und{i % 31}" for i in range(160_000))
    line = " ".join(f"many{i}" for i in range(24))
    texts = [(None, None), (None, line), (None, line + " and more"), (1, ""), (1, ""), (2, None), (3, f"{line}\n\tmore"),
             (4, f"  {line} \n{line}"), (5, long), (6, long), (6, long), (7, " \n\t "), (8, f"own\n{line}"),
             (8, f"{line}\nown"), (9, "x"), (9, "x\x0by\x1fz"), (10, "é" * 100_000)]
    return spark.createDataFrame([(i, t, k, "s", k, "t", 5, 6) for k, (i, t) in enumerate(texts)], SCHEMA)


def _sql(spark, query, sql, tables):
    from oracle.compare import compare, duck_connection
    out = compare(spark, "q", query, sql, SF, con=duck_connection(SF, tables))
    assert out["match"], out


# --- 11: repeated windows ----------------------------------------------------------

def test_reference_block():
    rng = random.Random(3)
    for _ in range(200):
        letters = rng.choice([0, 1, 2, 3])
        strings = [[b"%d" % rng.randint(0, letters) for _ in range(rng.randint(20, 39))] for _ in range(rng.randint(1, 10))]
        place = np.array([rng.randint(0, 3) * 1000 + rng.randint(0, 60) for _ in strings], np.int64)
        block = passages.ReferenceBlock(strings, place)
        got = block.repeated()
        for i, s in enumerate(strings):
            for j in range(len(s) - passages.WIDTH + 1):
                window = s[j:j + passages.WIDTH]
                earlier = any(t[m:m + passages.WIDTH] == window and place[k] + m < place[i] + j
                              for k, t in enumerate(strings) for m in range(len(t) - passages.WIDTH + 1))
                assert got[block.begin[i] + j] == earlier


def test_longest_factors():
    rng = random.Random(4)
    strings = [[b"%d" % rng.randint(0, 1) for _ in range(30)] for _ in range(6)]
    place = np.arange(6) * 100
    block = passages.ReferenceBlock(strings, place)
    for i, s in enumerate(strings):
        for j in range(30):
            best = max((n for k, t in enumerate(strings) for m in range(30) if place[k] + m < place[i] + j
                        for n in range(1, min(30 - j, 30 - m) + 1) if t[m:m + n] == s[j:j + n]), default=0)
            assert block.longest(np.array([block.begin[i] + j]))[0] == best


@pytest.mark.parametrize("group_rows", [passages.GROUP_ROWS, 3])
def test_windows(spark, group_rows, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK_WORDS", 64)  # in the driver only: chunks are tested below
    rng = random.Random(9)
    base = [f"w{i % 97}" for i in range(300)]
    rows = [(None, None), (None, " ".join(base)), (1, ""), (2, " ".join(base[:50])), (2, " ".join(base[:50])),
            (2, " ".join(base[10:80])), (3, " ".join(base)), (4, "a b " * 100), (-5, "a b " * 30)]
    for i in range(5, 45):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 3)}"
        rows.append((i % 40, " \n".join(words[rng.randint(0, 100):])))
    df = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "no int, doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in passages.drop_repeated_windows(df, group_rows=group_rows)
           .select("no", "n_words", "n_removed", F.sha2("kept", 256)).collect()}
    assert got == dict(enumerate(passages.brute_force(rows)))


def test_window_chunks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(passages, "CHUNK_WORDS", 64)
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefgh", k=n)) for n in (500, 3, 20, 0, 19, 64 + 19, 200)]
    windows: dict = {}
    for _, _, _, row, number, found in passages.segments(pa.array([*texts, None])):
        for a, b in zip(found.first.tolist(), found.last.tolist()):
            windows.setdefault(int(row[a]), []).extend(number[a:b + 1].tolist())
    assert windows == {i: list(range(len(t.split()) - 19)) for i, t in enumerate(texts) if len(t.split()) >= 20}


def test_hot_rows(spark):
    """Repeated rows, and one id or none with many texts, in groups beyond what a task holds."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(7, base)] * 40 + [(None, f"{base} {k}") for k in range(30)] + [(k, f"{k} {base}") for k in range(30)]
    df = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "no int, doc_id long, text string")
    found = passages.repeated_word_ranges(df, "doc_id", "text", 5)
    assert found.count() < 1000
    got = {r[0]: tuple(r)[1:] for r in passages.drop_repeated_windows(df, group_rows=5)
           .select("no", "n_words", "n_removed", F.sha2("kept", 256)).collect()}
    assert got == dict(enumerate(passages.brute_force(rows)))


def test_windows_odd(spark, odd):
    out = passages.drop_repeated_windows(odd)
    assert out.columns == [*[c for c in odd.columns if c != "N_Words"], "n_words", "n_removed", "kept"]
    rows = odd.select("n_chars", "doc_id", "text").collect()
    want = passages.brute_force([(r.doc_id, r.text) for r in rows])
    got = {r.n_chars: (r.n_words, r.n_removed, r.h) for r in out.withColumn("h", F.sha2("kept", 256)).collect()}
    assert got == {r.n_chars: w for r, w in zip(rows, want)}
    assert passages.drop_repeated_windows(odd.limit(0)).count() == 0
    assert {tuple(r) for r in out.select("`a.b`", "__row_id", "__text").collect()} == {
        tuple(r) for r in odd.select("`a.b`", "__row_id", "__text").collect()}


def test_windows_sql(spark):
    _sql(spark, passages.op11_passages, passages.OP11_SQL, ("documents",))


# --- 12: ranked search ---------------------------------------------------------------

def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranking(docs, items):
    counts = [Counter(_terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in counts]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), c, k in zip(docs, counts, n):
            m = 100 - 75 + (75 * k * n_docs) // n_terms if n_terms else 0
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, times in Counter(_terms(text)).items() if c[t])
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=str)


def test_ranked_sql(spark):
    _sql(spark, ranked.op12_ranked, ranked.OP12_SQL, ("documents", "benchmark"))


@pytest.mark.parametrize("seed_rows,item_bytes", [(ranked.SEED_ROWS, ranked.ITEM_BYTES), (30, 300)])
def test_ranked(spark, seed_rows, item_bytes, monkeypatch):
    monkeypatch.setattr(ranked, "ITEM_BYTES", item_bytes)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)] + ["É", "über", "A1", "日本"]
    draw = lambda n: rng.choice([" ", "_", "\x00", ", "]).join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=n))
    docs = [(i, draw(rng.choice([1, 5, 30, 400]))) for i in range(300)]
    docs += [(None, draw(20)), (None, None), (301, ""), (302, " _ "), (5, docs[5][1]), (5, docs[9][1]), (303, " ".join(words) * 3000)]
    docs += [(400 + i, docs[17][1]) for i in range(25)]  # ties
    items = [(i, draw(rng.choice([1, 4, 12]))) for i in range(12)] + [(50, docs[17][1]), (51, ""), (52, None), (None, "w1 w1 W2"),
                                                                   (1, "w3 nothing"), (53, "absent")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items + items[:1], "item_id long, text string")
    got = ranked.ranked_search(df.withColumn("rank", F.lit("x")).withColumn("TERM", F.lit(1)), asked.withColumn("doc_id", F.lit(1)),
                               seed_rows=seed_rows)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == _ranking(docs, items)
    assert ranked.ranked_search(df.limit(0), asked).count() == 0 and ranked.ranked_search(df, asked.limit(0)).count() == 0


@pytest.mark.parametrize("seed_rows", [ranked.SEED_ROWS, 500])
def test_ranked_several_files(spark, seed_rows, monkeypatch):
    """A task that reads several files, each with its longest vectors first and then thousands of short ones."""
    packed = lambda df, tag: common.materialize(df, tag).coalesce(1 if tag == "impact-vectors" else 4)
    monkeypatch.setattr(ranked, "materialize", packed)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(2, 40))) if rng.random() < 0.05 else "z " * 20 + "common") for i in range(24_000)]
    items = [(i, " ".join(rng.choices(words, k=3)) + " common") for i in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = ranked.ranked_search(df, spark.createDataFrame(items, "item_id long, text string"), seed_rows=seed_rows)
    assert sorted(map(tuple, got.collect()), key=str) == _ranking(docs, items)


def test_search_any_order():
    """Buckets of a task in any order find the same documents."""
    items = ranked.Items(["rare common"])
    rare, common_id = items.numbers[b"rare"], items.numbers[b"common"]
    items.weigh(200, {rare: 20, common_id: 180})

    def bucket(first, term, impact):
        n = len(impact)
        length = np.sqrt(float(items.weight[term])) * np.array(impact, float)
        return ranked.Bucket(items, np.arange(first, first + n), length, np.arange(n + 1), np.full(n, term), np.array(impact, np.int64))

    parts = [bucket(0, rare, [900_000 - 10 * k for k in range(10)]), bucket(10, common_id, [500_000] * 180),
             bucket(190, rare, [900_005 - 10 * k for k in range(10)])]
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        _, ids, _ = ranked.search(items, (parts[k] for k in order), np.ones(1, np.int64), 10)
        assert ids.tolist() == [190, 0, 191, 1, 192, 2, 193, 3, 194, 4]


def test_lengths_of_short_vectors(spark):
    """A short vector after many long ones keeps all digits of its length."""
    known = ranked.Items(["heavy light"])
    known.weight, known.root = np.array([10_000, 1]), np.sqrt([10_000.0, 1.0])
    rows = [(k, 100 + k % 7, [0], [50]) for k in range(5000)] + [(9000 + k, 100, [1], [1]) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, n long, term array<int>, tf array<int>").coalesce(1)
    got = ranked.impact_rows(df, spark.sparkContext.broadcast(known), 5000, 500_000).collect()
    for r in got:
        assert r.length == pytest.approx(math.sqrt(known.weight[r.term[0]]) * r.impact[0], rel=1e-14)


def test_bounds_prune():
    """Few documents of a long list are scored exactly, and none that counts is lost."""
    rng = np.random.default_rng(3)
    items = ranked.Items(["rare1 rare2 common"])
    n_docs, common_id = 20_000, items.numbers[b"common"]
    items.weigh(n_docs, {common_id: n_docs, items.numbers[b"rare1"]: 60, items.numbers[b"rare2"]: 40})
    term = [[common_id] + [items.numbers[r] for r, p in ((b"rare1", 0.003), (b"rare2", 0.002)) if rng.random() < p] for _ in range(n_docs)]
    impact = [[int(rng.integers(10 ** 5, 9 * 10 ** 5)) for _ in t] for t in term]
    length = np.array([math.sqrt(sum(int(items.weight[a]) * b * b for a, b in zip(t, x))) for t, x in zip(term, impact)])
    order = np.argsort(-length)
    scored, buckets = [], []
    for lo in range(0, n_docs, ranked.BUCKET):
        part = order[lo:lo + ranked.BUCKET]
        offsets = np.concatenate([[0], np.cumsum([len(term[k]) for k in part])])
        bucket = ranked.Bucket(items, part, length[part], offsets, np.array([a for k in part for a in term[k]]),
                               np.array([a for k in part for a in impact[k]]))
        bucket.scores = lambda v, w, docs, fn=bucket.scores: scored.append(len(docs)) or fn(v, w, docs)
        buckets.append(bucket)
    _, ids, score = ranked.search(items, iter(buckets), np.ones(1, np.int64), 10)
    exact = [sum(int(items.weight[a]) * b for a, b in zip(t, x)) for t, x in zip(term, impact)]
    best = sorted(range(n_docs), key=lambda k: (-exact[k], k))[:10]
    assert ids.tolist() == best and score.tolist() == [exact[k] for k in best]
    assert sum(scored) < 0.3 * n_docs


# --- 13: whitening ----------------------------------------------------------------------

def _gram(x):
    x = x - x.mean(0)

    def gram(z):
        u = x @ z
        return x.T @ u, float(u @ u)

    return gram, np.linalg.norm(x)


def _axes(values):
    return np.vstack([np.diag(values), -np.diag(values)])


@pytest.mark.parametrize("name", ["random", "low rank", "few", "constant", "wide", "equal", "equal greatest", "one"])
def test_bidiagonalisation(name):
    rng = np.random.default_rng(1)
    x = {"random": lambda: rng.integers(-60, 60, (300, 40)).astype(float),
         "low rank": lambda: (rng.integers(-5, 5, (300, 3)) @ rng.integers(-3, 3, (3, 40))).astype(float),
         "few": lambda: rng.integers(-60, 60, (3, 40)).astype(float), "constant": lambda: np.ones((5, 8)),
         "wide": lambda: rng.normal(size=(300, 150)) * np.linspace(3, 0.1, 150),
         "equal": lambda: _axes([50.0] * 90), "equal greatest": lambda: _axes([9.0] * 5 + list(np.linspace(5, 0.1, 100))),
         "one": lambda: rng.normal(size=(50, 1))}[name]()
    gram, size = _gram(x)
    s, v = whitening.components(gram, x.shape[1], size, 4)
    centred = x - x.mean(0)
    e = np.maximum(np.linalg.eigvalsh(centred.T @ centred)[::-1][:4], 0)
    real = np.sqrt(e) > 1e-6 * max(size, 1)
    assert len(s) == real.sum()
    assert s == pytest.approx(np.sqrt(e[real]), rel=1e-12)
    if len(s):
        assert np.abs(v.T @ v - np.eye(len(s))).max() < 1e-13
        assert np.abs(centred.T @ (centred @ v) - v * s ** 2).max() < 1e-12 * size ** 2


def _whitened(rows):
    """(n, deviations, eigenvalues, vectors, centred) of the usable rows by numpy."""
    x = np.array([[math.floor(256 * float(c)) for c in v] for _, v in rows], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    mean = np.array([s / n for s in sums])
    centred = fit.astype(float) - mean
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, e[::-1], vectors[:, ::-1], x.astype(float) - mean


def _check_whitened(got, rows):
    n, deviation, e, vectors, centred = _whitened(rows)
    by = {}
    for r in got:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    assert sorted(by) == [1, 2, 3, 4]
    for c, found in by.items():
        want = centred @ vectors[:, c - 1] / math.sqrt(e[c - 1])
        rows_of = {i: (w, d) for (i, _), w, d in zip(rows, want, deviation)}
        assert sum(map(len, found.values())) == len(rows) and set(found) == set(rows_of)
        top = max(rows_of, key=lambda i: abs(rows_of[i][0]))
        sign = math.copysign(1, found[top][0].whitened * rows_of[top][0])
        for i, own in found.items():
            for r in own:
                assert r.n == n and int(r.deviation) == rows_of[i][1]
                assert r.whitened == pytest.approx(sign * rows_of[i][0], rel=1e-8, abs=1e-8)
                assert r.explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-9) and 0 <= r.identity_error < 1e-8


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in common.read_table(spark, SF, "embeddings").collect() if r.embedding]
    _check_whitened(whitening.op13_whitening(spark, SF).collect(), rows)


def test_whitening_odd(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 5)) * np.array([9, 5, 3, 2, 1e3])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(70, x[3].tolist()), (70, x[3].tolist()), (71, [0.0] * 5), (72, [-0.0] * 5)]
    bad = [(80, None), (81, []), (82, [float("nan")] * 5), (83, [1.0, None, 2.0, 3.0, 4.0]), (84, [float("inf")] * 5),
           (85, [1.0]), (86, [1e300] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id long, embedding array<double>, n string, X int")
    _check_whitened(whitening.whiten(df).collect(), rows)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    two = spark.createDataFrame([(None, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.component, abs(r.whitened)) for r in whitening.whiten(two).collect())
    assert got == [(0, 1, pytest.approx(1)), (2, 1, pytest.approx(1))]


@pytest.mark.parametrize("scale,n", [(100, 1000), (10 ** 6, 10 ** 7), (10 ** 12, 10 ** 9), (10 ** 17, 10 ** 12)])
def test_exact_deviations(scale, n):
    rng = np.random.default_rng(2)
    x = rng.integers(-scale, scale, (20, 7))
    sums = [int(s) * n // 20 for s in x.sum(0)]
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    got = whitening.squared_deviations(x, n, sums)
    assert [None if g is None else int(g) for g in got] == [w if w < 10 ** 38 else None for w in want]
