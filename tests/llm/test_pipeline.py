"""The pipeline over the smallest table, each stage held against its operator's plain version."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import decontaminate, secrets
from millrace.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_columns_stay(stages):
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_stages_keep_clean_documents(stages):
    for name, before, after in stages:
        assert after.count() >= 0.8 * before.count(), name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) == after.count()


def test_one_of_equal_texts_stays(stages):
    name, before, after = stages[1]
    first = {}
    for r in before.orderBy("doc_id").collect():
        first.setdefault(r.text, r.doc_id)
    assert {r.doc_id for r in after.collect()} <= set(first.values())
    assert len(first) - after.count() <= 0.1 * len(first)


def test_no_item_is_left(spark, stages):
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    block = decontaminate.Items(items)  # every n-gram is a seed
    kept = {r.doc_id for r in stages[2][2].collect()}
    for r in stages[2][1].collect():
        held = any(True for _ in block.matches(r.text.encode(), {}))
        assert held == (r.doc_id not in kept)


def test_secrets_are_gone(stages):
    before = {r.doc_id: r for r in stages[3][1].collect()}
    for r in stages[3][2].collect():
        assert r.n_chars == len(r.text)
        assert 'token = "' not in r.text or secrets.REDACTED in r.text
        if r.text != before[r.doc_id].text:
            assert secrets.REDACTED in r.text


def test_encoding(stages):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages[4][1].collect()}
    for r in stages[4][2].collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_all_queries_run(spark):
    assert sorted(QUERIES) == sorted(QUERIES, key=str) and len(QUERIES) == 10
    for name, query in QUERIES.items():
        df = query(spark, SF)
        assert df.count() > 0 and all(t != "void" for _, t in df.dtypes), name


def test_all_stages_take_nulls_empty_texts_and_clashing_columns(spark, tmp_path):
    draw = random.Random(9)
    body = lambda n: " ".join(f"w{draw.randrange(4000)}" for _ in range(n))
    item, copied = body(60), body(120)
    rows = [
        (1, None), (2, ""), (None, body(50)), (None, None), (3, " \n"), (4, copied), (5, copied + " end"), (6, copied), (6, copied),
        (7, body(40) + " " + item + " " + body(40)), (8, "api_key = 'ghp_" + "aB3" * 12 + "' and " + body(30)), (9, "long " * 30_000),
        *[(100 + i, body(60) + (" venomous insultword" if i % 4 == 0 else "")) for i in range(60)],
    ]
    folder = str(tmp_path)
    docs = spark.createDataFrame([(i, t, None, "s", len(t or ""), "x", "x", "x") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, node string, score string, key string")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(100 + i, int(i % 4 == 0)) for i in range(60)] + [(None, 1), (1, None)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, folder).checkpoint()
        seen[name] = sorted(str(r.doc_id) for r in frame.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or frame.columns == docs.columns
    kept = seen["simhash_near_dedup"]
    # empty and blank texts are one group of their first id; rows without an id are in no group
    assert {"2", "3", "5", "6"}.isdisjoint(kept) and "4" in kept and "1" in kept and kept.count("None") == 2
    assert "7" in kept and "7" not in seen["benchmark_decontamination"]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(str(i) for i in out) == sorted(set(seen["bpe_encoding"])) and out[9].n_tokens == 30_000


def test_all_stages_take_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                         ("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
