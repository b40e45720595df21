"""Toxicity, language, neighbours and quotes."""

import functools
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ann, language, queries, quotes, toxicity

from .conftest import ODD


def test_nonnegative_pu_separates():
    draw = np.random.default_rng(1)

    def rows(n, toxic):
        return [np.flatnonzero(draw.random(20) < np.where(np.arange(20) < 3, 0.5 if toxic else 0.01, 0.3)) for _ in range(n)]

    weights, bias = toxicity.nonnegative_pu(rows(200, True), rows(180, False) + rows(20, True), 20, 0.1)
    assert weights[:3].min() > weights[3:].max() and bias < 0


def test_toxicity(spark, docs):
    draw = random.Random(2)
    plain = ["w" + str(k) for k in range(50)]
    rows = [(k, " ".join(draw.choices(plain, k=30) + (["horrid", "nasty"] if k % 10 == 0 else []))) for k in range(600)]
    table = docs([*rows, *[(i if i is None else i + 10_000, t) for i, t in ODD]])
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(0, 600, 2)] + [(None, 1), (3, None), (5, 0), (5, 0)], "doc_id long, toxic int")
    model = toxicity.train(table, labels)
    scores = toxicity.toxicity(table, model)
    assert scores.count() == 600 + len(ODD)
    found = {r.doc_id: r.score for r in scores.collect() if r.doc_id is not None}
    assert all((found[k] >= toxicity.THRESHOLD) == (k % 10 == 0) for k in range(600))
    assert found[10_001] == found[10_002] == model.score(b"") and 0 <= min(found.values())
    kept = toxicity.keep_clean(table, model)
    assert kept.schema == table.schema and kept.count() == 540 + len(ODD)


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs(ODD), labels)
    assert {r.score for r in toxicity.toxicity(docs(ODD), model).collect()} == {0.0}
    assert toxicity.toxicity(docs(ODD).limit(0), model).collect() == []


def test_language(spark, docs):
    draw = random.Random(3)
    words = {"en": "the of and this is that with from have not", "de": "der die und nicht mit ein das ist auf für", "fr": "le la les et dans est pour pas des une"}
    rows = [(k, " ".join(draw.choices(words[lang].split(), k=15)), lang) for k, lang in enumerate(["en", "de", "fr"] * 60)]
    table = spark.createDataFrame([*rows, (500, None, "en"), (501, "12 34", "de"), (None, "the", "xx"), (502, "the", None)], "doc_id long, text string, lang string")
    model = language.train(table)
    assert model.languages == ["de", "en", "fr"]
    found = {r.doc_id: r for r in language.languages(table, model).collect()}
    assert all(found[k].lang_pred == lang for k, _, lang in rows)
    assert [(found[k].lang_pred, found[k].score) for k in (500, 501)] == [("und", 0.0)] * 2
    odd = language.languages(docs(ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert language.train(table.limit(0)) is None
    assert {r.lang_pred for r in language.languages(table, None).collect()} == {"und"}


def test_presence_is_the_same_in_parts(monkeypatch):
    text = ("der die das und nicht " * 50).encode()
    whole = language.presence(text)
    monkeypatch.setattr(language, "_PART", 64)
    assert (language.presence(text) == whole).all()


@pytest.fixture()
def few(monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 8)
    monkeypatch.setattr(ann, "BLOCK", 16)


def test_neighbours(spark, few):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(400, 8)).round(3)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(1000 + k, vectors[0].tolist()) for k in range(150)]  # a third are copies
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [None] * 8), (2004, [float("inf")] * 8), (None, vectors[1].tolist()), (2050, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = ann.search(table, table.where("vec_id % 50 = 0")).collect()
    good = [(i, np.array(v)) for i, v in rows if i is not None and i < 2000]
    hits = total = 0
    for query, own in good:
        if query % 50:
            continue
        near = sorted((-(own @ v) / np.sqrt((own @ own) * (v @ v)), i) for i, v in good if i != query)
        want = [i for _, i in sorted((round(c, 12), i) for c, i in near)[:5]]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
        assert [k for k, _, _ in mine] == [1, 2, 3, 4, 5]
        exact = {i: -c for c, i in near}
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & set(want))
        total += 5
    assert hits / total >= 0.9
    assert {r.query_id for r in found} == {i for i, _ in good if i % 50 == 0}
    first = [r.vec_id for r in sorted((r for r in found if r.query_id == 0), key=lambda r: r["rank"])]
    assert first == [1000, 1001, 1002, 1003, 1004]  # ties by the smaller id


def test_parallel_vectors_are_ranked_by_the_exact_score(spark):
    draw = np.random.default_rng(11)
    base = draw.normal(size=3)
    rows = [(i, (base * (i + 1) * draw.uniform(0.5, 2)).tolist(), "x", "x") for i in range(40)] + [(40, [1e200, 1.0, 0.0], "x", "x"), (41, [1e-200, 1e-201, 0.0], "x", "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, leaf string, ids string")
    found = ann.search(table, table.where("vec_id IN (0, 5, 40)")).collect()
    for query in (0, 5, 40):
        near = []
        for i, v, *_ in rows:
            if i != query:
                q, w = (np.array(x) for x in (rows[query][1], v))
                q, w = (np.ldexp(x, -np.frexp(np.abs(x).max())[1]) for x in (q, w))
                dot = lambda a, b: functools.reduce(lambda t, p: t + p, (a * b).tolist(), 0.0)
                near.append((-dot(q, w) / (math.sqrt(dot(q, q)) * math.sqrt(dot(w, w))), i))
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
        assert [(i, -s) for _, i, s in got] == [(i, s) for s, i in sorted(near)[:5]]


def test_leaves_grow_with_the_vectors_and_few_are_visited(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 500)
    monkeypatch.setattr(ann, "BUNDLE", 700)
    monkeypatch.setattr(ann, "BLOCK", 60)
    monkeypatch.setattr(ann, "QUERIES", 40)
    draw = np.random.default_rng(12)
    centres = draw.normal(size=(60, 16))
    vectors = (centres[draw.integers(0, 60, 4000)] + draw.normal(scale=0.15, size=(4000, 16)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    stored = ann.folded(ann.usable(table, "vec_id", "embedding"), 6).checkpoint()
    upper = ann.grow(ann._drawn(stored, ann.SAMPLE, 4000), ann.LEAF)
    tree = ann._split(stored, upper, 4000)
    assert tree.leaves >= 4000 / ann.LEAF and tree.leaves > 2 * upper.leaves
    assert sorted(-c for cs in tree.children for c in cs if c < 0) == list(range(1, tree.leaves + 1))
    visits = ann._visits(stored, 4000, tree, 5)
    found = ann.search(table, table.where("vec_id % 50 = 0")).collect()
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for query in range(0, 4000, 50):
        near = units @ units[query]
        near[query] = -2
        hits += len({r.vec_id for r in found if r.query_id == query} & set(np.argsort(-near)[:5].tolist()))
    print("visited", visits, "of", tree.leaves, "recall", hits / 400)
    assert hits / 400 >= 0.95 and visits <= 0.2 * tree.leaves


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.search(table, table.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.0)]
    assert ann.search(table.limit(0), table.limit(0)).collect() == []
    assert ann.search(table, table.where("vec_id = 7")).collect() == []


def test_quotes(spark, tmp_path):
    draw = random.Random(5)
    rows = []
    for conv in range(25):
        texts = []
        for turn in range(draw.randint(1, 8)):
            own = "\n".join(draw.choice(["Alpha  beta", "gamma Delta.", "one two\n\nthree", "x", "", "  lead", "Yes"]) + draw.choice(["", f" {draw.randint(0, 3)}"])
                            for _ in range(draw.randint(0, 3)))
            text = own
            if texts and draw.random() < 0.7:
                text = "\n".join(draw.choice(["> ", ">", " > "]) + line for line in draw.choice(texts).split("\n")) + "\n" + own
            texts.append(text)
            rows.append((conv, turn, draw.choice(["user", "assistant", None]), text if draw.random() < 0.97 else None))
    rows += [*rows[:5], (None, 1, "user", "a"), (None, 2, None, "> a"), (3, None, "user", "zz"), (1, 0, "user", "> > deep\n>> deep\nx"), (1, 9, "user", "> \n>\n>")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = quotes.conversations(table.withColumn("thread", table.role).withColumn("position", table.role))
    db = duckdb.connect()
    conversations = pa.table({c: [r[k] for r in rows] for k, c in enumerate(table.columns)})
    db.register("conversations", conversations)
    want = db.execute(queries.CHECKS["op3_quotation_links"])
    columns = [d[0] for d in want.description]
    assert sorted(map(str, [tuple(r[c] for c in columns) for r in found.collect()])) == sorted(map(str, want.fetchall()))
    assert sum(r.reply_to is not None for r in found.collect()) > 10
    assert quotes.conversations(table.limit(0)).collect() == []


def test_an_answer_in_a_thread(spark):
    rows = [(1, 0, "user", "How tall is it?"), (1, 1, "user", "And how old?"), (1, 2, "assistant", "> How tall is it?\nNine feet."),
            (1, 3, "user", ">> how  tall IS it?\n> Nine feet.\nThanks!")]
    found = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("position").collect()
    assert [(r.turn, r.reply_to, r.thread, r.text) for r in found] == [
        (0, None, 0, "How tall is it?"), (2, 0, 0, "Nine feet."), (3, 2, 0, "Thanks!"), (1, None, 1, "And how old?")]


def test_equal_messages_quote_alike(spark):
    quote = "one two\nthree four\nfive six"
    again = (1, 2, "user", "> one\n> two three four\n> five six\nYes.")  # wrapped anew: only the whole passage is held
    rows = [(1, 0, "user", quote.replace("\n", " ")), (1, 1, "assistant", "ok"), again, again]
    found = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [r.reply_to for r in found if r.turn == 2] == [0, 0]
