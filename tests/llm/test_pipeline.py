import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

import __spark_entry__
from sluice.llm import line_dedup, toxicity
from tests.llm.test_text_operators import brute_groups, brute_lines, brute_secrets

DATA = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = start = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == start.columns, name
        counts.append(docs.count())
    assert counts[0] <= 200 and counts[1] == counts[0] > counts[2] == counts[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.select("doc_id").distinct().count() == counts[3]


def by_hand(rows, model):
    """The stages one after the other in plain Python: (id, source, text) rows to the ids and lengths of what is packed."""
    features = [toxicity.summary(np.array([s for w in toxicity.words_of(t or "") if (f := toxicity.fold(w)) for s in model.machine.scores([f])])) for _, _, t in rows]
    rows = [r for r, p in zip(rows, model.probability(np.array(features))) if p < toxicity.THRESHOLD]
    cleaned = brute_lines([(k, s, t) for k, (_, s, t) in enumerate(rows)], line_dedup.RATIO, line_dedup.MIN_PAGES, line_dedup.MIN_COUNT)
    rows = [(i, s, t if t is None or not cleaned[k].replace("\n", "").strip(" ") else cleaned[k]) for k, (i, s, t) in enumerate(rows)]
    groups = brute_groups([(i, t) for i, _, t in rows], corpus_pipeline.WORDS, corpus_pipeline.PERCENT)
    rows = [r for r, (_, first) in zip(rows, groups) if r[0] == first]
    tokenizer, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    for i, _, t in rows:
        masked, at = "", 0
        for start, end, kind in brute_secrets(t or ""):
            if start >= at:
                masked += t[at:start] + f"[{kind}]"
            at = max(at, end)
        ids = [*tokenizer.encode(masked + (t or "")[at:], add_special_tokens=False).ids, 1]
        out[i] = (len(ids), sorted(zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes()) for k in range(0, len(ids), 2048)))
    return out


def test_run_does_what_its_stages_do_by_hand(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source", "text").collect()]
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels.where(~toxicity.held_out())))
    expected = by_hand(rows, model)
    got = {}
    for r in corpus_pipeline.run(spark, DATA).collect():
        got.setdefault(r["doc_id"], (r["doc_tokens"], []))[1].append(r["ids_crc32"])
    assert {i: (n, sorted(c)) for i, (n, c) in got.items()} == expected


def test_odd_rows_pass_through_all_stages(spark):
    """Nulls in any column, empty and long texts, repeated rows, further columns named like the operators' own."""
    said = "The quick brown fox jumps over the lazy dog and runs away from here"
    long = " ".join(f"word{k * k % 9973}" for k in range(60_000))
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, " \n ", "en", "a", 3), (4, long, "en", "b", len(long)), (5, said, "en", "b", 9), (5, said, "en", "b", 9), (6, said + ".", None, "c", None), (None, "No id here at all, my friend", "de", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("score", "id", "_hashes", "component_id", "length", "rank", "site", "label"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    start, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == start, name
        counts.append(docs.count())
    assert counts == [8, 8, 7, 7]  # 6 repeats what 5 says; rows of one id are one document
    assert docs.where("score = 'own score' and label = 'own label'").count() == 7
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert sum(r["doc_id"] == 5 for r in packed) == 2 and sum(r["doc_id"] is None for r in packed) == 1
    assert {r["doc_id"]: r["doc_tokens"] for r in packed if r["doc_id"] in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    assert sum(r["length"] for r in packed if r["doc_id"] == 4) == next(r["doc_tokens"] for r in packed if r["doc_id"] == 4) > 60_000


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


@pytest.mark.parametrize("name", ["queries", "oracle_sql"])
def test_every_operator_is_registered_once(name):
    names = [n for n in getattr(__spark_entry__, name)() if n.startswith("op")]
    numbers = sorted(int(n[2:].split("_")[0]) for n in names)
    assert numbers == sorted(set(numbers)) and (name == "oracle_sql" or numbers == list(range(1, 14)))
    assert "pipeline" in __spark_entry__.queries()
