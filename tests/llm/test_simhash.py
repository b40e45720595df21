import random

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import components

from .conftest import ODD


def plain_fingerprint(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c.lower() if c.isascii() else c for c in text or "").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                group[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(top(i), []).append(doc)
    return sorted(((str(doc), format(prints[i], "016x"), str(min((d for d in least[top(i)] if d is not None), default=None)))
                   for i, (doc, _) in enumerate(rows)))


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_odd_rows_match_brute_force(spark, docs):
    assert got(simhash.simhash_groups(docs(ODD))) == plain_groups(ODD)


def test_links_of_two_bits_match_brute_force(spark, docs):
    draw = random.Random(1)
    rows = []
    for i in range(40):
        words = [draw.choice("abcdefghij") * draw.randint(1, 3) for _ in range(draw.randint(1, 6))]
        rows += [(i, " ".join(words)), (100 + i, " ".join(words[:-1]))]
    assert got(simhash.simhash_groups(docs(rows))) == plain_groups(rows)


def test_near_links_join_all_within_two_bits(spark):
    draw = random.Random(2)
    values = set()
    for _ in range(30):
        base = draw.getrandbits(64)
        for _ in range(6):
            values.add(base)
            base ^= 1 << draw.randrange(64)
    signed = [v - (1 << 64 if v >> 63 else 0) for v in values]
    roots = {r.node: r.root for r in components(simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect()}
    for a in signed:
        for b in signed:
            if a != b and ((a ^ b) % (1 << 64)).bit_count() <= 2:
                assert roots[a] == roots[b]
    for row in simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect():
        assert ((row.a ^ row.b) % (1 << 64)).bit_count() <= 2


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, None)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(300)],
    [(0, i) for i in range(1, 200)], [(1, 2), (3, 4), (4, 5), (9, 8)],
])
def test_components(spark, links):
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    group = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            merged = group.get(a, {a}) | group.get(b, {b})
            for x in merged:
                group[x] = merged
    assert sorted(r.node for r in found) == sorted(group)
    roots = {r.node: r.root for r in found}
    assert all((roots[a] == roots[b]) == (b in group[a]) for a in group for b in group)


def test_few_links_are_contracted_without_shuffling_parents(spark, monkeypatch):
    """Same components from fewer jobs."""
    from millrace.llm import components as module

    links = spark.range(500).selectExpr("id as a", "id + 1 as b").where("a % 7 <> 3").checkpoint()
    jobs, found = [], []
    for most in (module.PARENTS, 0):
        monkeypatch.setattr(module, "PARENTS", most)
        start = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        found.append(sorted(components(links).collect()))
        jobs.append(spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - start)
    assert found[0] == found[1] and len(found[0]) == 501 and jobs[0] < jobs[1]


def test_few_links_take_few_jobs_however_many_rounds_they_need(spark):
    """What the driver holds grows with jobs and broadcasts, so the last links are not contracted round by round."""
    jobs = []
    for n in (4, 4000):
        links = spark.range(n).selectExpr("id as a", "id + 1 as b").checkpoint()
        start = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(n + 1)}
        jobs.append(spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - start)
    assert jobs[0] == jobs[1] <= 8


def test_links_are_contracted_until_they_are_few(spark, monkeypatch):
    from millrace.llm import components as module

    monkeypatch.setattr(module, "PARENTS", 300)
    links = spark.range(900).where("id % 9 <> 4").selectExpr("id as a", "id + 1 as b")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {i: next(s for s in range(i, -1, -1) if s == 0 or s % 9 == 5) for i in range(901)}


def test_keep_one(spark, docs):
    draw = random.Random(3)
    base = [draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 4) + str(draw.randint(0, 9)) for _ in range(300)]
    other = [draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 4) + str(draw.randint(0, 9)) for _ in range(300)]
    edited = [*base[:100], "changed", *base[101:200], "this", "too", *base[202:]]  # similarity 0.91
    half = base[:150] + other[:150]
    rows = [(7, " ".join(base)), (3, " ".join(edited)), (9, " ".join(other)), (5, " ".join(half)), (9, " ".join(other)),
            (None, " ".join(base)), (4, " ".join(base))]
    table = docs(rows)
    kept = simhash.keep_one(table)
    assert kept.schema == table.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "9", "None"]


def test_empty_tables(spark, docs):
    empty = docs([(1, "x")]).limit(0)
    assert simhash.simhash_groups(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def plain_shingles(text):
    words = text.lower().split()
    size = min(simhash.SHINGLE, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain_kept(rows):
    """The ids that stay when every pair of texts is compared."""
    sets, group = [plain_shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if top(i) != top(j) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    return sorted(min(d for k, (d, _) in enumerate(rows) if top(k) == top(i)) for i in range(len(rows)) if top(i) == i)


def kept_ids(df):
    return sorted(r.doc_id for r in simhash.keep_one(df).collect())


def test_drifting_groups_match_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 3)
    draw = random.Random(4)
    rows = []
    for _ in range(6):  # chains of edits: neighbours are near copies, ends are not
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.choice((60, 120, 240)))]
        for _ in range(25):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(draw.randint(1, len(words) // 40)):
                words[draw.randrange(len(words))] = f"w{draw.randrange(5000)}"
    draw.shuffle(rows)
    assert kept_ids(docs(rows)) == plain_kept(rows)


def body(draw, n):
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


def test_a_line_repeated_in_the_copy(spark, docs):
    draw, rows = random.Random(5), []
    for _ in range(10):
        text, line = body(draw, 300), body(draw, 10)
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(text + line * 15))]
    assert kept_ids(docs(rows)) == plain_kept(rows) == list(range(0, 20, 2))


def test_blocks_appended_cut_off_or_replaced(spark, docs):
    draw, rows = random.Random(7), []
    for n in range(30):  # similarity 0.80 to 0.82
        text = body(draw, 240)
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join([text + body(draw, 56), text[:196], text[:214] + body(draw, 26)][n % 3]))]
    assert kept_ids(docs(rows)) == plain_kept(rows)


def test_one_line_makes_most_of_two_texts(spark, docs):
    draw = random.Random(8)
    line = body(draw, 11)
    rows = [(n, " ".join(body(draw, 60) + line * 40)) for n in range(10)]
    assert kept_ids(docs(rows)) == plain_kept(rows) == list(range(10))


def test_texts_of_one_id_are_told_apart(spark, docs):
    draw = random.Random(6)
    texts = [" ".join(f"w{draw.randrange(5000)}" for _ in range(80)) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1]), (3, texts[2]), (3, texts[2])]
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs(rows)).collect())
    assert kept == sorted([(1, texts[0]), (1, texts[1]), (3, texts[2])])


def test_fingerprints_link_before_shingles_do(spark, docs, monkeypatch):
    """Copies whose fingerprints are linked need no shingle in common bucket; far ones and unlike ones do not pass."""
    draw, rows = random.Random(12), []
    for n in range(12):
        text = body(draw, 400)
        edited = [*text[:200], "changed", *text[201:]]
        rows += [(3 * n, " ".join(text)), (3 * n + 1, " ".join(edited)), (3 * n + 2, " ".join(text).upper())]
    texts = docs(rows).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    marked = simhash.shingled(texts).where("block IS NULL").checkpoint()
    prints = {r.doc_id: r.fp for r in marked.collect()}
    near = [n for n in range(12) if ((prints[3 * n] ^ prints[3 * n + 1]) % (1 << 64)).bit_count() <= 2]
    assert near
    compared = []
    pairs = simhash.print_pairs
    monkeypatch.setattr(simhash, "print_pairs", lambda p: compared.append(pairs(p).checkpoint()) or compared[-1])
    assert kept_ids(docs(rows)) == plain_kept(rows)
    nodes = {r.doc_id: r.node for r in marked.collect()}
    met = {(r.a, r.b) for r in compared[0].collect()}
    assert all(tuple(sorted((nodes[3 * n], nodes[3 * n + 1]), reverse=True)) in met for n in near)


def test_a_set_goes_to_many_partners_in_bounded_batches(spark, docs, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words + [f"x{i}"])) for i in range(60)] + [(100 + i, f"other text of its own {i} " * 3) for i in range(5)]
    whole = sorted(r.doc_id for r in simhash.keep_one(docs(rows)).collect())
    monkeypatch.setattr(simhash, "SENT", 700)  # two sets at a time
    assert sorted(r.doc_id for r in simhash.keep_one(docs(rows)).collect()) == whole and 0 in whole
