"""The pipeline against a brute-force version of its stages."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from livetables.llm import bpe, near_dup, toxicity
from livetables.llm.queries import SOURCE_WEIGHTS, TOXIC_AT
from tests.llm.test_native import water_level
from tests.llm.test_near_and_toxic import brute_classes

SF = "/root/testdata/sf0.001"


def test_stages_are_named_and_keep_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    docs = spark.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_the_toxicity_stage_drops_toxic_rows(spark):
    table, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = corpus_pipeline.drop_toxic(spark, table, SF)
    gone = table.join(kept, "doc_id", "left_anti").join(labels, "doc_id")
    toxic = labels.where("toxic = 1").join(table, "doc_id").count()
    assert kept.count() < table.count()
    assert gone.where("toxic = 1").count() >= 0.9 * toxic > 0


def test_run_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(table, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r in table.collect() if model.score(r.text or "")[0] < TOXIC_AT]
    last = {}
    for r in rows:
        t = r.text or ""
        last[t] = max(last.get(t, r), r, key=lambda x: x.doc_id)
    rows = list(last.values())
    p = near_dup.Params()
    texts = spark.createDataFrame([(r.text or "",) for r in rows], "t string")
    classes = brute_classes([(r.doc_id, r.text) for r in rows], near_dup.common_shingles(texts, p), p)
    rows = [r for r in rows if classes[r.doc_id] == r.doc_id]

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    weights = {s: SOURCE_WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    targets, want = water_level(sizes, weights, 3), {}
    for s in sizes:
        own = sorted((r for r in rows if r.source == s), key=lambda r: hashlib.md5(f"mix{r.doc_id}".encode()).hexdigest())
        served = 0
        for r in own * 3:
            served += words(r.text)
            if words(r.text) and served - words(r.text) / 2 <= targets[s]:
                want[r.doc_id] = want.get(r.doc_id, 0) + 1
    got = corpus_pipeline.run(spark, SF).collect()
    count = {}
    for r in got:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == want
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                               mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))})
    text = {r.doc_id: r.text for r in rows}
    for r in got:
        ids = encode.encode_ordinary(text[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("n", range(1, 11))
def test_each_operator_is_registered_once(n):
    assert len([q for q in __spark_entry__.queries() if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in __spark_entry__.queries()


def test_oracles_at_the_smallest_size(spark, duck_small):
    for name in ("op7_threshold_topk", "op8_fair_queue_mix", "op9_exact_dedup"):
        got = __spark_entry__.queries()[name](spark, SF)
        want = duck_small.execute(__spark_entry__.oracle_sql()[name])
        cols = [d[0] for d in want.description]
        assert sorted(cols) == sorted(got.columns)
        assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want.fetchall())), name
    assert got.select(F.count("*")).first()[0] > 0
