"""The stages, each against a plain version over what the one before left; the contract's queries."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from fleetlake.llm import mixing, quality
from fleetlake.llm.common import staged
from fleetlake.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_DIR
from tests.llm.test_operators import plain_fingerprint, plain_hits, plain_roots


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        left = staged(stage(spark, docs, SF_DIR), "test-stage")
        out[name] = rows_of(docs), rows_of(left), docs, left
        docs = left
    return out


def test_stages_are_those_asked_for(stages):
    assert list(stages) == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "source_mixing"]
    assert all(left.columns == docs.columns for _, _, docs, left in list(stages.values())[:-1])


def test_quality_stage(spark, stages):
    given, left, docs, _ = stages["quality_classifier"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    weights = quality.train(docs, labels.where(quality.fold() != 0))
    margins = quality.margins([(r[1] or "").encode() for r in given], weights)
    kept = 1 / (1 + np.exp(-margins)) >= quality.THRESHOLD
    assert left == [r for r, k in zip(given, kept, strict=True) if k]
    quality_of = dict(zip(*(c.to_pylist() for c in pq.read_table(f"{SF_DIR}/labels.parquet", columns=["doc_id", "quality"]).columns), strict=True))
    gone = [r[0] for r in given if r not in left]
    assert gone and all(quality_of.get(d, 0) == 0 for d in gone)


def test_line_stage(stages):
    given, left, _, _ = stages["line_dedup"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in given])
    wanted = {d: (n, t) for d, n, t in con.execute(f"SELECT doc_id, n_dropped, text FROM ({ORACLE['op10_line_templates']})").fetchall()}
    assert {r[0]: r[1] for r in left} == {d: t for d, (n, t) in wanted.items() if not n or t.strip()}
    assert any(n for n, _ in wanted.values())


def test_near_duplicate_stage(stages):
    given, left, _, _ = stages["near_dedup"]
    root = plain_roots([plain_fingerprint(r[1]) for r in given], 3)
    first = {}
    for r, c in zip(given, root, strict=True):
        first[c] = min(first.get(c, r), r)
    assert left == sorted(first.values(), key=repr) and len(left) < len(given)


def test_decontamination_stage(stages):
    given, left, _, _ = stages["decontamination"]
    benchmark = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    hits = plain_hits([r[1] for r in given], [(b["item_id"], b["text"]) for b in benchmark], 10)
    assert left == [r for r, (_, hit, _) in zip(given, hits, strict=True) if not hit]
    assert len(left) < len(given)


def test_mixing_stage(stages):
    given, left, docs, out = stages["source_mixing"]
    size = {r[0]: len((r[1] or "").encode().split()) for r in given}
    taken = {r.doc_id: r.copies for r in out.collect()}
    assert set(taken) <= set(size) and set(taken.values()) <= {1, 2} and len(left) == len(taken)
    targets = {r.source: r.target for r in mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()}
    for source, target in targets.items():
        sizes = [size[r[0]] for r in given if r[3] == source]
        passes, reach = int(target // sum(sizes)), 1
        for n in sizes:
            reach |= reach << n
        rest = int(target - passes * sum(sizes))
        best = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
        assert sum(size[r[0]] * taken.get(r[0], 0) for r in given if r[3] == source) == passes * sum(sizes) + best


def test_stages_over_nothing(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_DIR).count() == 0


def test_stages_over_odd_rows(spark, odd):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, odd, SF_DIR)
        assert left.columns == odd.columns
        assert left.select(F.min("score"), F.max("score"), F.max("copies")).first() in ((1.5, 1.5, 7), (None, None, None))


def test_contract_has_every_operator(spark):
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    answer = con.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert ours == sorted((tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()), key=repr)
