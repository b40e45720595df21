"""Learned operators beside plain versions of their parts, and what must not grow by the square."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, licenses, secrets, simhash, toxicity


def plain_risk(margins, n, prior):
    soft = lambda x: math.log1p(math.exp(-abs(x))) + max(x, 0.0)
    toxic = prior * sum(soft(-m) for m in margins[:n]) / n
    clean = sum(soft(m) for m in margins[n:]) / (len(margins) - n) - prior * sum(soft(m) for m in margins[:n]) / n
    return toxic, clean


def test_risk_and_slope_beside_plain_loops_and_differences():
    draw, signs = random.Random(1), Counter()
    for _ in range(60):
        n, prior = draw.randint(1, 6), draw.uniform(0.05, 0.6)
        margins = [draw.uniform(-6, 6) for _ in range(n + draw.randint(1, 8))]
        toxic, clean, slope = toxicity.risk(np.array(margins), n, prior)
        assert np.allclose((toxic, clean), plain_risk(margins, n, prior), atol=1e-12)
        signs[clean >= 0] += 1

        def value(m):
            a, b = plain_risk(m, n, prior)
            return a + b if clean >= 0 else -b

        for k in range(len(margins)):
            up, down = ([m + (d if i == k else 0) for i, m in enumerate(margins)] for d in (1e-6, -1e-6))
            assert abs((value(up) - value(down)) / 2e-6 - slope[k]) < 1e-6
    assert min(signs.values()) > 5


def sequences(text):
    found = set()
    data = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in text)
    for size in range(1, language.LONGEST + 1):
        for i in range(len(data) - size + 1):
            code = 0
            for b in data[i:i + size]:
                code = (code * 257 + b) % 2**32
            found.add(((code * 2654435761 + size) % 2**32) >> 20)
    return found


def test_kernel_and_ridge_beside_explicit_sets():
    draw = random.Random(2)
    pools = {"a": "und der die das nicht ein".split(), "b": "the and of not a in".split(), "c": "le la et pas un dans".split()}
    texts = [(lang, " ".join(draw.choices(pool, k=draw.randint(3, 12))).encode()) for lang, pool in pools.items() for _ in range(12)]
    rows = np.stack([language.presence(t) for _, t in texts])
    sets = [sequences(t) for _, t in texts]
    assert [set(np.flatnonzero(r)) for r in rows] == sets
    kernel = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    # every text a landmark: the dual solution of kernel ridge regression, weighed alike
    model = language.fit(rows, [lang for lang, _ in texts], landmarks=36, ridge=1e-2)
    target = np.array([[1.0 if lang == name else -1.0 for name in "abc"] for lang, _ in texts])
    alpha = np.linalg.solve(kernel + 1e-2 * 36 * np.eye(36), target)
    assert np.allclose(model.score(rows), kernel @ alpha, atol=2e-3)


def test_candidates_beside_plain_patterns():
    draw = random.Random(3)
    pool = ["word", "key=", "token: ", "abc123def456gh", "x9" * 8, "a.b-c", "'", '"', "name = ", "value12345678", "sk-9aZ!$", " ", "\n", "...", "pass:abcdefgh", "longwordwithoutdigit", "http://a.b/c12345"]
    for _ in range(400):
        text = "".join(draw.choices(pool, k=draw.randint(1, 12)))
        found = secrets.candidates(text)
        spans = set()
        for m in re.finditer(r"\S+", text):
            if len(m.group()) >= secrets.LONG_RUN and re.search("[0-9]", m.group()):
                for run in re.finditer(r"[A-Za-z0-9+/_=.~%@-]+", m.group()):
                    start, value = m.start() + run.start(), run.group()
                    if named := re.match(r"[A-Za-z_][\w-]*=(?=.{8})", value):
                        start, value = start + named.end(), value[named.end():]
                    value = value.rstrip(".-")
                    if len(value) >= secrets.LONG_RUN and re.search("[0-9]", value):
                        spans.add((start, start + len(value)))
        for m in re.finditer(r"""[=:]\s*["'`]?([A-Za-z0-9+/_.~%@!$&*^#-]{8,}=*)""", text):
            value = m.group(1).rstrip(".-:")
            if len(value) >= secrets.LONG_VALUE:
                spans.add((m.start(1), m.start(1) + len(value)))
        kept = []
        for span in sorted(spans, key=lambda s: (s[0], -s[1])):
            if not kept or span[0] >= kept[-1][1]:
                kept.append(span)
        assert found == kept, text


def test_a_tree_splits_where_all_splits_are_tried():
    draw = np.random.default_rng(4)
    rows, target = draw.integers(0, 6, (60, 1)).astype(float), draw.integers(0, 2, 60).astype(float)
    forest = secrets.Forest.__new__(secrets.Forest)
    nodes = []
    forest._grow(rows, target, 1, np.random.default_rng(5), nodes)
    impurity = {}
    for cut in sorted(set(rows[:, 0]))[:-1]:
        parts = [target[rows[:, 0] <= cut], target[rows[:, 0] > cut]]
        if min(map(len, parts)) >= secrets.LEAST_LEAF:
            impurity[cut] = sum(len(p) * p.mean() * (1 - p.mean()) for p in parts)
    assert nodes[0][0] == 0 and impurity[nodes[0][1]] <= min(impurity.values()) + 1e-9
    assert nodes[1][4] == target[rows[:, 0] <= nodes[0][1]].mean()


def test_the_dictionary_holds_all_words_of_its_share(spark, docs):
    rows = [(i, f"common shared{i % 2} text words") for i in range(50)] + [(99, "only here once " + "abcd " * 30)]
    corpus = secrets.corpus_of(docs(rows))
    assert corpus.dictionary == {"common", "text", "words", "only", "here", "once", "abcd"}


def test_very_long_items_are_aligned_in_the_memory_of_two_rows():
    import tracemalloc

    item = np.random.default_rng(6).integers(1, 10**6, 4000)
    passage = np.concatenate([np.zeros(500, dtype=np.int64), item[:1500], [0, 0], item[1500:], np.zeros(500, dtype=np.int64)])
    tracemalloc.start()
    score, first, stop = decontaminate.align(item, passage)
    assert tracemalloc.get_traced_memory()[1] < 3_000_000
    tracemalloc.stop()
    assert (first, stop) == (500, 4502) and score == 4000 * decontaminate.MATCH + 2 * decontaminate.GAP


def test_pages_of_one_template_never_meet(spark, docs):
    draw = random.Random(7)
    line = "this page is made by our small web server"
    rows = [(i, f"{line} w{draw.randrange(10**9)}") for i in range(600)]
    texts = docs(rows).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    marked = simhash.shingled(texts).checkpoint()
    met = simhash.meetings(simhash.prefixes(texts, simhash.sketch(marked)))
    assert met.count() == 0
    began = time.time()
    assert simhash.keep_one(docs(rows)).count() == len(rows)
    assert time.time() - began < 60


def plain_chain(text, template, most_gap):
    """The most words matched by runs in order on both sides, none closer than allowed: every choice is tried."""
    runs = []
    for i in range(len(text)):
        for p in range(len(template)):
            n = 0
            while i + n < len(text) and p + n < len(template) and text[i + n] == template[p + n]:
                n += 1
            if n >= 4 and (i == 0 or p == 0 or text[i - 1] != template[p - 1]):
                runs.append((i, i + n, p + n))
    runs.sort(key=lambda r: r[1])
    best = []
    for start, end, place in runs:
        most = end - start
        for k, (_, stop, before) in enumerate(runs[:len(best)]):
            new = end - max(start, stop)
            if stop >= start - most_gap and stop < end and place - before >= new:
                most = max(most, best[k] + new)
        best.append(most)
    return max(best, default=0)


def test_chains_find_the_most_words_whatever_repeats():
    draw = random.Random(8)
    for _ in range(150):
        template = draw.choices("abc", k=20)
        text = list(template)
        for _ in range(draw.randint(0, 3)):
            text.insert(draw.randrange(len(text)), draw.choice("abcx"))
        own = licenses.Automaton({"t": " ".join(template)}, {})
        matches, _ = own.stream([w.encode() for w in text])
        spans = own.spans(matches)
        most = plain_chain(text, template, licenses.MOST_GAP)
        # runs that lie within a longer one at another place of the template are not streamed
        assert max([s[3] for s in spans], default=0) <= most
        if len(text) == len(template):
            assert spans == [("t", 0, 20, 20)]


def test_a_run_that_stands_twice_in_a_notice_and_notices_that_share_words():
    bsd = licenses.TEMPLATES["bsd"].split()
    spans = licenses.scan(" ".join([*bsd[:30], "two", "inserted", *bsd[30:]]).encode())["spans"]
    assert [(s["label"], s["start"], s["stop"], s["matched"]) for s in spans] == [("bsd", 0, 70, 68)]
    for label in ("gpl", "lgpl", "agpl"):
        found = licenses.scan(("foo " * 20 + licenses.TEMPLATES[label] + " bar" * 20).encode())
        assert [s["label"] for s in found["spans"]] == [label]


def test_templates_of_the_callers_own(spark, docs):
    rows = [(1, "you may use this for tea only"), (2, "nothing here"), (3, None)]
    found = licenses.license_spans(docs(rows), templates={"tea": "may use this for tea only"}).collect()
    assert {r.doc_id: r.labels for r in found} == {1: "tea", 2: "", 3: ""}
