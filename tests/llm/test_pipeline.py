"""The stages one by one against what they must do, and the whole on odd tables."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from granary.llm import simhash
from granary.llm.common import table, written
from test_operators import plain_components, plain_fingerprint, plain_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["start"] = docs
    for name, stage in pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, SF), "test-stage")
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(kept):
    for name, _ in pipeline.STAGES[:-1]:
        assert kept[name].dtypes == kept["start"].dtypes


def test_language_keeps_clean_documents(kept):
    assert len(ids(kept["language"])) >= 0.99 * len(ids(kept["start"]))


def test_toxic_documents_go(spark, kept):
    labels = dict(table(spark, SF, "labels").select("doc_id", "toxic").collect())
    gone = ids(kept["language"]) - ids(kept["toxicity"])
    clean = {i for i in ids(kept["language"]) if labels.get(i) == 0}
    assert len(clean & gone) <= 0.05 * len(clean)


def test_one_of_each_group_stays(kept):
    rows = kept["toxicity"].select("doc_id", "text").collect()
    names = [r.doc_id for r in rows]
    assert ids(kept["near duplicates"]) == set(plain_components(names, [plain_fingerprint(r.text) for r in rows]))


def test_no_passage_is_left_and_clean_texts_are_untouched(spark, kept):
    items = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    before = dict(kept["near duplicates"].select("doc_id", "text").collect())
    after = dict(kept["decontamination"].select("doc_id", "text").collect())
    hit = dict(zip(before, plain_hits(before.values(), items, 10)))
    for i, (words, n, _) in hit.items():
        if not n:
            assert after[i] == before[i]
        else:
            assert (i in after) == (n < words)
    assert not any(n for _, n, _ in plain_hits([after[i] for i in after if hit[i][1]], items, 10))


def test_encoding(kept):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(kept["decontamination"].select("doc_id", "text").collect())
    rows = kept["encoding"].collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_run_equals_the_stages(spark, kept):
    assert {tuple(r) for r in pipeline.run(spark, SF).collect()} == {tuple(r) for r in kept["encoding"].collect()}


def test_odd_and_empty_documents(spark):
    text = "the and of to in that was for with this is on at by from they house"
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, None, None, None), (None, "other words here with the and of to", "en", None, 1),
            (None, "other words here with the and of to", "en", None, 1), (2, None, None, None, None), (3, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema).withColumn("key", F.lit(1)).withColumn("id", F.lit("x"))
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == pipeline.COLUMNS
    assert docs.count() == 2  # one of the equal texts, and the one without an id
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        empty = written(stage(spark, empty, SF), "test-stage")
    assert empty.count() == 0
    assert simhash.near_duplicates(table(spark, SF, "documents").limit(0)).count() == 0
