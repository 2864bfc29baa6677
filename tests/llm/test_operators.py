"""Every operator against a plain version, over odd rows and over nothing."""

from __future__ import annotations

import json
import math
import os
import re
import subprocess
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlake.llm import (
    components,
    decontaminate,
    language_model,
    licenses,
    lines,
    mixing,
    quality,
    rules,
    simhash,
    substrings,
    urls,
)
from tests.llm.conftest import lower, odd_rows, row, words

BLANK = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def by_row(rows):
    return sorted(rows, key=repr)


# --- licenses ---------------------------------------------------------------------------------


def test_licenses(spark, odd, nothing):
    texts = ["Released under the MIT License.", "the mit mit license, MIT  license", "work licensed under the Apache", "x\nLicensed under the Apache License, Version 2.0.\ny", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [p.start for p in found[1].places] == [2, 4]
    assert found[0].template_labels == ["mit"] and found[0].containment == 1.0
    assert found[2].template_labels is None and found[3].template_labels == ["apache"]
    assert (found[4].n_words, found[4].places) == (0, [])
    assert licenses.scan(odd).count() == odd.count()
    assert licenses.scan(nothing).count() == 0


def test_license_join_finds_every_pair(spark):
    vocabulary = sorted({w for t, _ in licenses.TEMPLATES for w in t.split()})
    blocks = []
    for k in range(300):
        template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)][0].split()
        kept = [w for j, w in enumerate(template) if (k * 7 + j * 3) % 5]
        blocks.append(" ".join(kept + [vocabulary[(k * 13 + j) % len(vocabulary)] for j in range(k % 4)]))
    docs = spark.createDataFrame(list(enumerate(blocks)), "doc_id long, text string")
    found = sorted((r.doc_id, r.label, round(r.containment, 9)) for r in licenses.matches(docs, threshold=0.6).collect())
    wanted = []
    for k, block in enumerate(blocks):
        for t, label in licenses.TEMPLATES:
            whole = set(t.split())
            share = len(whole & set(block.split())) / len(whole)
            if share >= 0.6:
                wanted.append((k, label, round(share, 9)))
    assert found == sorted(wanted)


def test_license_blocks_cross_lines_and_are_short(spark):
    wrapped = "Copyright\n# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
    narrow = "\n".join(licenses.TEMPLATES[1][0].split())
    apart = " ".join(["all", *words(40, 1), "rights", *words(40, 2), "reserved"])
    long_line = " ".join([*words(3000, 3), "released under", "the", "mit license", *words(3000, 4)])
    texts = [wrapped, narrow, apart, long_line, apart + " all rights reserved " + apart]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r.doc_id, r.label, r.containment) for r in licenses.matches(docs).collect())
    assert found == [(0, "bsd", 1.0), (1, "mit", 1.0), (3, "mit", 1.0), (4, "all-rights-reserved", 1.0)]


# --- URLs -------------------------------------------------------------------------------------


def test_urls(spark):
    rows = [(1, "http://A.Example.NET/en/1"), (2, "https://example.net/EN/"), (3, "http://x.org/fr/?q"), (4, "net"), (5, None), (6, "http://net"), (7, "ftp://example.com/de/x#y"), (7, "http://notexample.com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("old"))
    weights = urls.train(urls.labelled(spark))
    found = [(r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, weights).orderBy("page_id", "url").collect()]
    assert found[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert found[1][2:] == ("net/", "block")
    assert found[2] == ("x.org", "/fr/", "org/fr/", "allow")
    assert found[3][:3] == ("", "", None) and found[4][:3] == ("", "", None)
    assert found[5][:3] == ("net", "", None)
    assert found[6][2:] == ("example.com/de/", "block") and found[7][2] is None
    table = urls.labelled(spark).withColumn("page_id", F.lit(1))
    right = urls.judge(table, weights, rules=[("block", "none.invalid", "/")]).where((F.col("verdict") == "block") == (F.col("label") == 1))
    assert right.count() >= 0.95 * table.count()
    assert set(urls.train(table.limit(0))) == {0.0}
    with pytest.raises(ValueError):
        urls.train(spark.range(urls.MAX_LABELLED + 1).select(F.lit("http://a/").alias("url"), F.lit(1).alias("label")))


# --- substrings -------------------------------------------------------------------------------


def plain_removal(texts, window):
    words_of = [re.findall(BLANK, t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words_of for i in range(len(w) - window + 1))
    out = []
    for w in words_of:
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def test_substrings(odd, nothing):
    texts = [r[1] for r in odd_rows()]
    found = substrings.without_repeats(odd)
    assert set(found.columns) == set(odd.columns) | {"n_words", "n_removed"}
    got = [(r.n_words, r.n_removed, r.kept) for r in found.collect()]
    assert by_row(got) == by_row(plain_removal(texts, 35))
    assert substrings.without_repeats(nothing).count() == 0


def test_substrings_with_small_windows_and_buckets(spark):
    texts = [" ".join(words(120, s % 7, 6)) for s in range(30)] + ["a b\tc\nd e f g h"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted((r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(docs, window=6, run=2).collect())
    assert got == sorted(plain_removal(texts, 6))


def test_windows_of_a_hot_minimiser_are_spread(spark, monkeypatch):
    runs = [words(5, 9_000 + s, 5000) for s in range(3000)]
    t = substrings.Tokens([" ".join(r).encode() for r in runs], substrings._WORDS)
    at = np.arange(0, 15_000, 5)
    common = runs[int(np.argmin(substrings.range_sums(t.hashes(), at, at + 5)))]  # the minimiser of every window that holds it
    texts = [" ".join(words(40, s, 5000) + common + words(40, 500 + s, 5000)) for s in range(60)]
    texts += [texts[7], "x " + texts[8] + " y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substrings, "HOT_WINDOWS", 200)
    hot = substrings.hot_cells(docs, 64)
    assert len(hot)
    t = substrings.Tokens([x.encode() for x in texts], substrings._WORDS)
    most = lambda hot: max(np.bincount(*substrings._dealt(t, 64, hot, 35, 5)[:0:-1]))
    assert most(np.zeros(0, np.int64)) > 31 * 60 and most(hot) < 200
    got = sorted((r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(docs).collect())
    assert got == sorted(plain_removal(texts, 35))


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "span_hashes", lambda raw, a, z: np.zeros(len(a), np.uint64))
    bucket = substrings.Bucket(2)
    strings = [b"a b c", b"x b c", b"q r"]
    bucket.add(b"\n".join(strings), np.arange(3).tobytes(), np.zeros(3, np.int32).tobytes(), np.zeros(3, np.uint8).tobytes())
    assert bucket.spans().tolist() == [[0, 1, 3], [1, 1, 3]]


# --- SimHash ----------------------------------------------------------------------------------


def plain_fingerprint(text):
    w = lower(text).encode().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, radius):
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(len(prints)):
                if (prints[a] ^ prints[b]).bit_count() <= radius and root[a] > root[b]:
                    root[a], changed = root[b], True
    return root


def test_fingerprints_and_components(odd, nothing):
    got = simhash.near_duplicates(odd).collect()
    rows = odd_rows()
    prints = [plain_fingerprint(r[1]) for r in rows]
    root = plain_roots(prints, 3)
    least = {}
    for r, c in zip(rows, root, strict=True):
        least[c] = min(x for x in (least.get(c), r[0]) if x is not None) if (least.get(c), r[0]) != (None, None) else None
    wanted = [(r[0], p, least[c]) for r, p, c in zip(rows, prints, root, strict=True)]
    assert by_row((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == by_row(wanted)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(root))
    assert {r._key for r in kept.collect()} == {"k"}


@pytest.mark.parametrize("at_once", [1, 4, 97])
def test_fingerprints_of_texts_longer_than_a_chunk(monkeypatch, at_once):
    monkeypatch.setattr(simhash, "_SHINGLES_AT_ONCE", at_once)
    for n in (1, 3, 6, 7, 99, 100, 500):
        text = " ".join(words(n, n, 5000))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("tile_rows", [4, 65_536])
def test_links_are_exact(spark, tile_rows):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 60, dtype=np.uint64).tolist()
    prints += [p ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for p in prints for a, b, c in [rng.integers(0, 64, 3)]]
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = components.components(simhash.links(spark.createDataFrame(signed, "fp long"), 3, tile_rows)).collect()
    root = plain_roots(prints, 3)
    groups = {}
    for p, r in zip(prints, root, strict=True):
        groups.setdefault(r, set()).add(p)
    got = {}
    for r in found:
        got.setdefault(r.root, set()).add(r.node % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert components.components(links).where("root <> 0").count() == 0


def test_near_pairs_by_lanes():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64))
    found = {(int(i), int(j)) for x, y in simhash.near_pairs(a, b, 3) for i, j in zip(x, y, strict=True)}
    wanted = np.argwhere(np.bitwise_count(a[:, None] ^ b[None, :]) <= 3)
    assert found == {tuple(x) for x in wanted.tolist()}


# --- language model ---------------------------------------------------------------------------


def test_language_model_base_and_gain(spark, odd, nothing):
    rows = odd_rows() + [row(100 + k, " ".join(["the", "cat", "sat"] * 40)) for k in range(40)]
    docs = spark.createDataFrame(rows, odd.schema).repartition(3)
    got = language_model.language_scores(docs).collect()
    tokens = [lower(r[1]).encode().split() + [b"\n"] for r in rows]
    held = [r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    total, distinct = sum(c.values()), len(c)
    wanted = [
        (r[0], h, len(t), sum(c[w] > 0 for w in t), total, round(sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t), 5))
        for r, t, h in zip(rows, tokens, held, strict=True)
    ]
    assert by_row((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == by_row(wanted)
    assert all(r.score < 0 for r in got)
    cats = [r for r in got if r.doc_id and r.doc_id >= 100 and r.held_out]
    assert cats and all(r.score > 0.5 * r.base_score for r in cats)
    assert language_model.language_scores(nothing).count() == 0


def test_language_model_tail(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 4)
    docs = spark.createDataFrame([(k, f"a a b c{k}") for k in range(20)], "doc_id long, text string")
    counts = language_model.word_counts(docs)
    v = language_model.Vocabulary.of(counts)
    assert set(v.number) == {b"a", b"b", b"\n"} and v.total == 100 and v.distinct == 23
    scored = language_model.score(docs, v, np.zeros((1 << language_model.BITS, language_model.CLASSES), np.float32), counts).collect()
    c = Counter(w for k in range(20) for w in ["a", "a", "b", f"c{k}", "\n"])
    for r in scored:
        t = ["a", "a", "b", f"c{r.doc_id}", "\n"]
        assert r.n_known == 5
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (100 + 0.5 * 24)) for w in t))


def test_language_model_finds_head_words(monkeypatch):
    long = [b"a" * k for k in (7, 8, 9, 16, 17, 40)] + [b"b" * 20 + x + b"c" * 20 for x in (b"x", b"y")]
    number = {w: k for k, w in enumerate([language_model.END, *(f"w{k}".encode() for k in range(5000)), *long])}
    texts = [b" ".join([*number, *(f"W{k}".encode() for k in range(4000, 6000)), b"b" * 20 + b"z" + b"c" * 20]), b"", b"\x00 w1\x00"]
    v = language_model.Vocabulary(number, np.zeros(len(number) + 1, int), *[np.zeros(len(number))] * 3, 1, 1, 1.0)
    wanted = [number.get(w, -1) for t in texts for w in [*t.lower().split(), language_model.END]]
    tails = [(d, w) for d, t in enumerate(texts) for w in t.lower().split() if w not in number]
    for hashes in (language_model.Tokens.hashes, lambda tokens: tokens.raw[tokens.start] * np.uint64(1 << 40)):  # the second: many words share one
        monkeypatch.setattr(language_model.Tokens, "hashes", hashes)
        found = language_model.histories(texts, v)
        of, words = found.tails()
        assert found.number.tolist() == wanted and list(zip(of.tolist(), words.to_pylist(), strict=True)) == tails
        v.__dict__.pop("heads")
    v = language_model.Vocabulary({}, np.zeros(1, int), *[np.zeros(0)] * 3, 0, 0, 0.5)
    assert language_model.histories([b"a b", b""], v).tails()[1].to_pylist() == [b"a", b"b", b"\n", b"\n"]


def test_language_model_sums_rows_in_less_time():
    rng = np.random.default_rng(5)
    rows = 1 << language_model.BITS
    buckets = rng.zipf(1.25, language_model.MINI_BATCH) * 7919 % rows  # most have one row, some hundreds
    off = rng.random((len(buckets), language_model.CLASSES), np.float32)

    def plain():
        order = np.argsort(buckets.astype(np.uint16), kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], np.diff(buckets[order]) > 0]))
        counts = np.diff(begin, append=len(order))
        g = np.take(off, order[begin], axis=0)
        several = np.take(off, order[np.repeat(counts > 1, counts)], axis=0)
        g[counts > 1] = np.add.reduceat(several, (np.cumsum(counts[counts > 1]) - counts[counts > 1]), axis=0)
        return buckets[order][begin], g

    def least(sums):
        spent = []
        for _ in range(15):
            began = time.process_time()
            there, g = sums()
            spent.append(time.process_time() - began)
        by_bucket = np.argsort(there)
        return min(spent), there[by_bucket], g[by_bucket]

    slow, there, wanted = least(plain)
    fast, found, g = least(lambda: language_model._summed(buckets, off))
    assert (found == there).all() and np.allclose(g, wanted, rtol=1e-4)
    assert fast < 0.75 * slow


# --- mixing -----------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets([100, 100, 100], (3, 1, 2), 450, 2) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([], (), 0, 2) == []
    assert sum(mixing.targets([0, 10, 1000], (3, 1, 2), 1515, 2)) == pytest.approx(1515)


def test_fit_is_exact_where_it_can_be():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 60, 12))
        counts = rng.integers(1, 9, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        taken = mixing.fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        reach = 1
        for length, n in zip(lengths.tolist(), counts.tolist(), strict=True):
            for _ in range(n):
                reach |= reach << length
        best = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
        assert (lengths * taken).sum() <= budget
        assert budget - (lengths * taken).sum() <= max(0, budget - best) + 60


def test_knapsack_is_optimal():
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = np.unique(rng.integers(3, 90, 6))
        counts = rng.integers(0, 5, len(lengths))
        budget = int(rng.integers(0, 300))
        reach = 1
        for length, n in zip(lengths.tolist(), counts.tolist(), strict=True):
            for _ in range(n):
                reach |= reach << length
        best = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
        taken = mixing._knapsack(lengths, counts, budget)
        assert (taken <= counts).all() and (lengths * taken).sum() == best


def test_mix(spark, odd, nothing):
    rows = odd_rows() + [row(1000 + k, " ".join(words(3 + k % 17, k)), source="abc"[k % 3]) for k in range(300)] + [row(2000, "tie tie", source="c")] * 9
    docs = spark.createDataFrame(rows, odd.schema)
    got = mixing.mix(docs).collect()
    sizes = [len(re.findall(BLANK, r[1] or "")) for r in rows]
    assert by_row((r.doc_id, r.size) for r in got) == by_row((r[0], s) for r, s in zip(rows, sizes, strict=True))
    totals = Counter()
    for r in got:
        totals[r.target, r.source_size] += r.copies * r.size
        assert 0 <= r.copies <= 2 and (r.size or not r.copies)
    assert sum(t for t, _ in totals) == pytest.approx(1.5 * sum(sizes))
    assert all(0 <= t - taken <= 20 or s > 10_000 for (t, s), taken in totals.items())
    again = mixing.mix(docs.repartition(5)).collect()
    assert by_row(map(tuple, got)) == by_row(map(tuple, again))
    taken = mixing.mixed_documents(docs)
    assert taken.columns == [c for c in odd.columns if c != "copies"] + ["copies"]
    assert taken.agg(F.sum("copies")).first()[0] == sum(r.copies for r in got)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


# --- rules ------------------------------------------------------------------------------------


def plain_counts(text):
    w = re.findall(BLANK, text or "")
    split = [x for x in (text or "").split("\n") if re.search(BLANK, x)]
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(split) - len(set(split)), len(covered)


def test_rules(spark, odd, nothing):
    rows = odd_rows() + [row(300 + k, " ".join(words(60, k)) + ".\n" * 2) for k in range(120)]
    rows += [row(500 + k, " ".join(f"{w}%%$" for w in words(60, k))) for k in range(3)]
    rows += [row(600, "\n".join(["one two three four five"] * 30))]
    got = rules.judged(spark.createDataFrame(rows, odd.schema)).collect()
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert by_row((r.doc_id, *(r[c] for c in shown)) for r in got) == by_row((r[0], *plain_counts(r[1])) for r in rows)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[300 + k] for k in range(120)) and not any(kept[500 + k] for k in range(3)) and not kept[600]
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert rules.judged(nothing).count() == 0


# --- classifier -------------------------------------------------------------------------------


def test_quality_classifier(spark, odd, nothing, labels):
    good = [row(1000 + k, " ".join(words(50, k)).capitalize() + ".") for k in range(150)]
    bad = [row(2000 + k, " ".join(f"{w}%%" for w in words(50, k))) for k in range(75)] + [row(3000 + k, f"spam{k} " * 40) for k in range(75)]
    docs = spark.createDataFrame(good + bad + odd_rows(), odd.schema)
    marks = spark.createDataFrame([(r[0], int(r[0] < 2000)) for r in good + bad], "doc_id long, quality int")
    scored = quality.score(docs, quality.train(docs, marks.where(quality.fold() != 0))).select("row.doc_id", "score")
    assert scored.count() == docs.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    held = scored.join(marks.where(quality.fold() == 0), "doc_id").collect()
    assert len(held) > 30 and sum((r.score >= 0.3) == r.quality for r in held) >= 0.95 * len(held)
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns and {r.score for r in kept.collect()} <= {1.5}
    assert quality.accepted(nothing, labels).count() == 0
    assert quality.accepted(odd, labels.limit(0)).count() == odd.count()


def test_quality_sample_is_bounded(spark, odd):
    marks = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert quality.train(odd, marks, sample=5).shape == ((1 << quality.BITS) + 1,)


# --- decontamination --------------------------------------------------------------------------


def plain_hits(texts, items, window):
    tests = [(i, re.findall(WORD, lower(t))) for i, t in items]
    out = []
    for text in texts:
        w = re.findall(WORD, lower(text))
        hit, found = set(), set()
        for item, t in tests:
            k = min(window, len(t))
            phrases = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)} if k else ()
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in phrases:
                    hit.update(range(i, i + k))
                    found |= {str(item)} if item is not None else set()
        out.append((len(w), sorted(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_words", [500_000, 15])
def test_decontamination(odd, nothing, benchmark, block_words):
    got = decontaminate.find(odd, benchmark, block_words=block_words).collect()
    items = [tuple(r) for r in benchmark.collect()]
    wanted = plain_hits([r[1] for r in odd_rows()], items, 10)
    assert by_row((r.n_words, r.hits, r["items"]) for r in got) == by_row(wanted)
    assert all(set(r["items"]) <= set(r.near_items) for r in got)
    kept = decontaminate.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == sum(not h for _, h, _ in wanted)
    assert decontaminate.find(nothing, benchmark).count() == 0
    assert decontaminate.drop_contaminated(odd, benchmark.limit(0)).count() == odd.count()


def test_proximity(spark):
    item = "alpha beta gamma delta"
    docs = spark.createDataFrame([(1, "alpha x beta y gamma delta"), (2, "delta gamma beta alpha"), (3, "alpha beta " + "z " * 30 + "gamma delta"), (4, item)], "doc_id long, text string")
    tests = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in decontaminate.find(docs, tests, slop=3).collect()}
    assert got == {1: ([], ["9"]), 2: ([], ["9"]), 3: ([], []), 4: (["9"], ["9"])}


# --- lines ------------------------------------------------------------------------------------


def test_line_templates(spark, odd, nothing):
    plain = lambda n, seed: " ".join(words(n, seed)).translate(str.maketrans("0123456789", "ghijklmnop"))
    users = [f"user{chr(97 + k)}" for k in range(20)]
    texts = [
        "\n".join([plain(12, 1050 + k), f"Page viewed by user {users[k]} from host{k} today ok", "Share this page now", plain(12, 1090 + k), f"seen {k} times"])
        for k in range(20)
    ]
    copy = "\n".join(plain(9, s) for s in (700, 701, 702))
    texts += [copy + f"\nend {'abcdefgh'[k]} x y" for k in range(8)] + [copy] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r for r in lines.drop_recurring(docs).collect()}
    for k in range(20):
        assert left[k].text == "\n".join([plain(12, 1050 + k), plain(12, 1090 + k)])
        assert (left[k].n_lines, left[k].n_dropped) == (5, 3)
    assert all(left[k].text == texts[k] for k in range(20, len(texts)))
    got = lines.drop_recurring(odd)
    assert got.count() == odd.count() and set(got.columns) == set(odd.columns) | {"n_lines", "n_dropped"}
    assert {r.dropped for r in got.collect()} == {3}
    assert got.where("text is null").count() == 2
    assert lines.without_recurring(nothing).count() == 0




def test_line_templates_of_large_leaves(spark, monkeypatch):
    names = lambda k: f"{'abcdefgh'[k % 8]}{'klmnop'[k % 6]}"
    texts = [
        f"{names(k)} {k % 7 * 'x'} own words here now {names(k + 1)} {names(k * 3)}\nseen by the user {names(k)} on host today at {names(k // 8)} again\n"
        f"{'zy'[k % 2]} b {names(k // 3)} end"
        for k in range(60)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = sorted(lines.drop_recurring(docs).collect())
    assert sum(r.n_dropped for r in wanted) >= 60 and all("seen by" not in r.text for r in wanted)
    monkeypatch.setattr(lines, "WHOLE", 10)
    assert sorted(lines.drop_recurring(docs).collect()) == wanted


def test_lines_move_little(tmp_path):
    """What op10's search for recurring lines moves between tasks, in a session of its own with an event log."""
    (tmp_path / "events").mkdir()
    code = f"""
from pyspark.sql import SparkSession, functions as F
from fleetlake.llm import lines
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", 8)
spark = spark.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}/events")
spark = spark.config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
spark = spark.config("spark.sql.autoBroadcastJoinThreshold", -1).config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
line = lambda *parts: F.concat_ws(" ", *(F.translate(F.sha2(F.concat_ws("-", F.lit(p), *on), 256), "0123456789", "ghijklmnop") for p, *on in parts))
k, j = F.col("doc_id").cast("string"), F.col("j").cast("string")
docs = spark.range(3000).withColumnRenamed("id", "doc_id").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("j"))
own = F.concat_ws(" ", line(("a", k, j)), F.lit("c d e f"), line(("b", k, j)))
docs = docs.groupBy("doc_id").agg(F.array_join(F.collect_list(own), chr(10)).alias("text"))
docs.write.parquet("{tmp_path}/docs")
lines.recurring_lines(spark.read.parquet("{tmp_path}/docs")).write.parquet("{tmp_path}/out")
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=200, capture_output=True, env=os.environ | {"PYTHONPATH": str(Path(__file__).parents[2])})
    events = [json.loads(x) for f in (tmp_path / "events").iterdir() for x in f.read_text().splitlines()]
    moved = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd")
    assert moved < 120 * 30_000  # 30,000 lines, of which none recurs


def test_quality_scores_do_not_depend_on_the_layout(spark):
    texts = [" ".join(words(30 + k % 50, k, 40 if k % 3 else 900)) for k in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(5, texts[5])], "doc_id long, text string")
    marked = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(0, 200, 2)], "doc_id long, quality int")
    found = []
    for n in (1, 4, 9):
        weights = quality.train(docs.repartition(n), marked.repartition(n))
        found.append(sorted((r.row.doc_id, r.score) for r in quality.score(docs, weights).collect()))
    assert found[0] == found[1] == found[2]


def test_quality_shards_are_averaged_in_tasks(spark, monkeypatch):
    texts = [" ".join(words(30 + k % 7, k, 300 if k % 3 else 60)) for k in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(0, 200, 2)], "doc_id long, quality int")
    key = F.xxhash64("doc_id", "text")
    rows = docs.join(marks, "doc_id").select(F.pmod(key, F.lit(quality.SHARDS)).alias("shard"), key.alias("key"), "text", "quality").collect()
    sent, collect = [], type(docs).collect

    def counted(df):
        out = collect(df)
        sent.append(sum(len(v) for r in out for v in r if isinstance(v, (bytes, bytearray))))
        return out

    monkeypatch.setattr(type(docs), "collect", counted)
    weights = quality.train(docs, marks)
    assert len(sent) == quality.ROUNDS and set(sent) == {8 * len(weights)}  # one model of two floats a weight

    plain, squares = np.zeros_like(weights), np.zeros_like(weights)
    for _ in range(quality.ROUNDS):
        means = [0, 0]
        for shard in range(quality.SHARDS):
            own, leader = sorted((r.key, r.text, r.quality) for r in rows if r.shard == shard), quality.Leader(plain, squares)
            for at in range(0, len(own), quality.MINI_BATCH):
                some = own[at : at + quality.MINI_BATCH]
                leader.update([t.encode() for _, t, _ in some], np.array([q for _, _, q in some], float))
            share = np.float64(len(own) / len(rows))
            means = [m + share * x.astype(np.float32) for m, x in zip(means, (leader.w, leader.n), strict=True)]
        plain, squares = (m.astype(np.float32) for m in means)
    assert np.array_equal(weights, plain) and weights.any()


def test_line_flags_are_short_in_a_plan(spark):
    given = spark.range(0, 3000).select(F.xxhash64("id").alias("leaf"))
    leaves = given.where(F.abs(F.col("leaf")) % 4 == 0)
    place = lambda leaf: leaf % lines.FLAGS
    there = {place(r.leaf) for r in leaves.collect()}
    sifted = lines._perhaps_in(given, leaves)
    assert by_row(r.leaf for r in sifted.collect()) == by_row(r.leaf for r in given.collect() if place(r.leaf) in there)
    assert lines._perhaps_in(given, leaves.limit(0)).count() == 0
    assert len(sifted._jdf.queryExecution().executedPlan().toString()) < lines.FLAGS
