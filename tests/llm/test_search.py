"""Operators 11 to 13 against brute force, over odd rows and over nothing."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import lexical, nearest, queries, runs
from tests.conftest import SF_DIR
from tests.llm.conftest import lower, odd_rows, words

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANK = r"[^\x20\x09-\x0D]+"
LAST = 2**63


# --- ranked search ----------------------------------------------------------------------------


def plain_ranks(docs, items, k=10):
    """``docs``: id and text; ``items``: id and text; rows of the result, unordered."""
    terms = [re.findall(TERM, lower(t)) for _, t in docs]
    held = [Counter(t) for t in terms]
    n_docs, n_terms = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(t for h in held for t in h)
    out = []
    for item, text in items:
        asked = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in {*re.findall(TERM, lower(text))} if df[t]}
        scores = []
        for (doc, _), h, all_ in zip(docs, held, terms, strict=True):
            m = 10 + (90 * len(all_) * n_docs) // n_terms if n_terms else 0
            score = sum(w * ((1_000_000_000 * h[t]) // (1000 * h[t] + 8 * m)) for t, w in asked.items() if h[t])
            scores += [(-score, LAST if doc is None else doc)] * (score > 0)
        out += [(item, r + 1, None if d == LAST else d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def ranked(found):
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def small_trees(monkeypatch):
    for name, value in (("TREE_ROWS", 40), ("LEAF_ROWS", 4), ("GROUP_TREES", 2), ("BLOCK_QUERIES", 3)):
        monkeypatch.setattr(lexical, name, value)


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search(spark, monkeypatch, small):
    rng = random.Random(4)
    docs = [(k, " ".join(words(rng.choice([0, 1, 5, 40, 300]), k % 90, rng.choice([3, 60, 900])))) for k in range(300)]
    docs += [(1000 + k, docs[7 * k][1]) for k in range(30)] + [(2000, None), (2001, "A1-b2_c3 É w1 W1"), (None, docs[5][1])]
    items = [(k, " ".join(words(rng.choice([1, 6, 30]), 500 + k, 900))) for k in range(12)] + [(12, None), (13, ""), (13, "nowhere"), (None, "w1 w2"), (3, "w1 c3 É")]
    if small:
        small_trees(monkeypatch)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    assert ranked(lexical.ranked(d, i)) == plain_ranks(docs, items)


def test_ranked_search_over_odd_rows(spark, odd, benchmark, nothing):
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = lexical.ranked(odd, benchmark)
    assert ranked(found) == plain_ranks([r[:2] for r in odd_rows()], items)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    for d, i in ((nothing, benchmark), (odd, benchmark.limit(0)), (nothing, benchmark.limit(0))):
        empty = lexical.ranked(d, i)
        assert empty.columns == found.columns and empty.count() == 0
    clash = odd.select("*", *(F.lit(1).alias(c) for c in ("terms", "tf", "n", "row", "block")))
    assert ranked(lexical.ranked(clash, benchmark.withColumn("ask", F.lit(2)))) == ranked(found)


def test_bounds_hold_for_every_document_below_a_node():
    rng = np.random.default_rng(2)
    corpus = lexical.Corpus(500, 500 * 60, rng.uniform(0, 9000, lexical.CELLS))
    rows = []
    for k in range(500):
        t = np.unique(rng.integers(0, 400, rng.integers(1, 60))) * 977
        rows.append({"row": k, "doc_id": k, "n": 60, "terms": t.astype(np.int64).tobytes(), "tf": rng.integers(1, 9, len(t)).astype(np.int32).tobytes()})
    terms = np.arange(0, 400, 3) * 977
    tree = lexical.Tree(lexical._tree(rows, corpus), terms)
    weights = rng.integers(0, 9000, len(terms))
    query = weights / corpus.stretched(terms)
    leaves = [n for n in range(len(tree.spans)) if not tree.child[n]]
    assert len(leaves) > 1 and sorted(tree.rows.tolist()) == list(range(500))
    for node, (low, high) in enumerate(tree.spans):
        below = [s for leaf in leaves if low <= tree.spans[leaf][0] < high for s in tree.scores(leaf, weights)]
        assert len(below) == high - low and max(below) <= tree.bound(node, query, float(np.sqrt(query @ query)))


# --- inner products ---------------------------------------------------------------------------


def plain_products(rows, k=10, every=100):
    """``rows``: id and vector."""
    part = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            part.append((n, i, [math.floor(1024.0 * x) for x in v]))
    out = []
    for n, i, q in part:
        if i is not None and i % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, v, strict=False)), LAST if j is None else j, m) for m, j, v in part if m != n]
            out += [(i, r + 1, None if j == LAST else j, -s) for r, (s, j, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<double>, score string, row int"


def products(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], VECTORS).repartition(3)
    found = nearest.top_products(df, F.col("vec_id") % 100 == 0, **more)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_top_products(spark, monkeypatch, small):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(k, (centres[k % 6] * rng.uniform(0.5, 2) + rng.normal(size=8) * 0.2).tolist()) for k in range(1500)]
    rows += [(5000 + k, rows[100][1]) for k in range(40)]  # a third of a block alike
    if small:
        monkeypatch.setattr(nearest, "BLOCK_ROWS", 256)
        monkeypatch.setattr(nearest, "GROUP_BLOCKS", 2)
        monkeypatch.setattr(nearest, "GROUP_QUERIES", 1)
        monkeypatch.setattr(nearest, "_QUERIES_AT_ONCE", 2)
    assert products(spark, rows) == plain_products(rows)


def test_top_products_over_odd_rows(spark):
    rows = [
        (0, [0.5, -0.25, 0.001]),
        (0, [0.5, -0.25, 0.001]),
        (100, [0.5]),
        (200, []),
        (300, None),
        (400, [None, 1.0]),
        (500, [float("nan"), 1.0]),
        (600, [float("inf")]),
        (None, [1.0, 1.0, 1.0]),
        (None, [1.0, 1.0, 1.0]),
        (7, [-1.0, -1.0, -1.0, 5.0]),
        (-100, [1e-9, -1e-9]),
        (8, [0.0]),
    ]
    assert products(spark, rows) == plain_products(rows)
    assert products(spark, [(100, [1.0])]) == [] and products(spark, [(1, [1.0])]) == []
    assert products(spark, []) == [] and products(spark, [(100, None)]) == []


def test_top_products_of_great_components(spark):
    """Past 2**53 products are summed as 64-bit integers; past 64 bits as doubles, held to the range of a long."""
    rows = [(k, [float(2**k), 1.0, -(2.0**k)]) for k in range(14, 18)] + [(100, [2.0**17 + 1, 3.0, 1.0])]
    assert products(spark, rows) == plain_products(rows)
    huge = [(100, [1e30]), (1, [1e30]), (2, [-1e30]), (3, [1e300])]
    assert [r[2:] for r in products(spark, huge)] == [(1, 2**63 - 1024), (3, 2**63 - 1024), (2, -(2**63))]


def test_fewer_annuli_are_visited_than_there_are():
    rng = np.random.default_rng(5)
    v = np.floor(1024 * np.concatenate([rng.normal(c, 0.05, (200, 4)) for c in rng.normal(size=(8, 4)) * 3]))
    space = nearest.Space(v, float((v**2).sum(axis=1).max()), 1600 * 512)
    d = space.of_rows(v)
    best = np.sort(v @ v.T, axis=1)[:, -11]
    radius, apart = space.radius(v, best), space.of_queries(v)
    within = np.abs(apart[:, d.argmin(axis=1)] - d.min(axis=1)[None, :]) <= radius[:, None] + space.slack
    assert ((v @ v.T >= best[:, None]) <= within).all() and within.mean() < 0.6


# --- periodic runs ----------------------------------------------------------------------------


def plain_runs(w, least=12):
    n, seen = len(w), {}
    for q in range(1, n // 2 + 1):
        j = 0
        while j < n - q:
            s = j
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > s and j + q - s >= max(least, 2 * q):
                seen.setdefault((s, j + q), q)
            j += j == s
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def plain_collapsed(w, found):
    gone = {p for s, n, q in found for p in range(s + q, s + n)}
    return [x for p, x in enumerate(w) if p not in gone]


def test_runs_of_many_sequences():
    rng = random.Random(6)
    for _ in range(300):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            k, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 5, 12, 13, 30, 60, 150])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randrange(3, 11)
                w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
            docs.append(w)
        least = rng.choice([9, 12])
        assert runs.runs_of(docs + docs[:1], least) == [plain_runs(w, least) for w in docs + docs[:1]]


def test_runs_of_long_regular_sequences():
    assert runs.runs_of([["x"] * 5000, list("ab" * 3000)]) == [[(0, 5000, 1)], [(0, 6000, 2)]]
    thue_morse = [bin(i).count("1") % 2 for i in range(1 << 12)]
    assert runs.runs_of([thue_morse[:600]]) == [plain_runs(thue_morse[:600])]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert runs.runs_of([list(fibonacci[-1])]) == [plain_runs(list(fibonacci[-1]))]
    with pytest.raises(ValueError):
        runs.runs_of([[1, 2]], 4)


def test_periodic_runs_over_odd_rows(spark, odd, nothing):
    found = runs.periodic_runs(odd)
    assert found.columns == [*odd.columns, "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.text, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    want = []
    for r in odd_rows():
        w = re.findall(BLANK, r[1] or "")
        rs = plain_runs(w) if len(w) < 2000 else []
        want.append((r[0], r[1], len(w), rs, " ".join(plain_collapsed(w, rs))))
    assert got == sorted(want, key=repr)
    assert runs.periodic_runs(nothing).count() == 0
    again = runs.periodic_runs(found.withColumn("n_words", F.lit("old")))
    assert again.columns == [*odd.columns, "n_words", "runs", "collapsed"] and again.agg(F.max("score")).first()[0] == 1.5


def test_op12_against_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    changed = 0
    for doc_id, text in docs:
        w, h = re.findall(BLANK, text or ""), zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w, changed = [w[i if i < a else a + (i - a) % p] for i in range(n)], changed + 1
        found = plain_runs(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[doc_id] == (
            len(found),
            *best,
            1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(plain_collapsed(w, found))),
        )
    assert changed
