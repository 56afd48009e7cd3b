"""The registered queries over the given tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changefold.llm.oracles import ORACLES
from changefold.llm.queries import QUERIES
from checks.compare import difference, duck

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_held_out_toxicity(spark):
    """Toxic texts that were not learnt from are found, others are left alone, and scores
    order them: the share of pairs of both kinds in which the toxic one scores higher."""
    found = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert len(toxic) >= 50
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean]
    assert sum(pairs) >= 0.95 * len(pairs)


def test_near_copies_of_the_given_texts(spark):
    """Components equal those of all pairs, which exact prefix filtering finds: two sets of
    this likeness share one of the rarest quarter of their shingles."""
    sf, plain = "/root/testdata/sf0.01", re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = plain.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    often, index, up = Counter(x for s in sets.values() for x in s), defaultdict(list), {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = 0
    for i, own in sets.items():
        rarest = sorted(own, key=lambda x: (often[x], x))[:len(own) - math.ceil(0.75 * len(own)) + 1]
        for j in {j for x in rarest for j in index[x]}:
            if 100 * len(own & sets[j]) >= 75 * len(own | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b], links = a, links + 1
        for x in rarest:
            index[x].append(i)
    assert links > 100
    found = QUERIES["op6_minhash"](spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), top(i)) for i, s in sets.items()}


def test_the_pipeline_keeps_columns_and_order_of_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "byte_bpe"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        assert (now := docs.count()) <= left
        left = now
    assert corpus_pipeline.run(spark, SMALL).count() == left


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_a_row_for_each_row(spark, name):
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
