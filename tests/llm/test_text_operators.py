"""License scans, encodings, token files, secrets and test items against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, decontaminate, licenses, secrets, tokenfile

from .conftest import ODD

WORD_FILE, BYTE_FILE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
POOL = list("aAbBzZ09'’\"!?.,<|>\x1c\x1f\x85\x0b\x0c\t\n  ​﻿ 　éÉßñİΣσǅ가각ㄱ日本🎉é́½Ⅷ٣ŉẞﬁ") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'re", "n't", " the", " don't", "\nab"]


def odd_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(POOL, k=draw.randint(0, 40))) for _ in range(n)]


# licenses

def plain_scan(text):
    words = WORDS.findall((text or "").translate(LOWER))
    found = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def test_license_phrases_match_brute_force(spark, docs):
    draw = random.Random(1)
    some = "mit license apache general public the of License, MIT version licensed under é gnu permission is hereby granted".split()
    rows = [*ODD, *[(100 + i, " ".join(draw.choices(some, k=draw.randint(0, 50)))) for i in range(300)], (50, "mit\x00license MIT_License")]
    found = licenses.license_spans(docs(rows)).collect()
    assert sorted(map(str, [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found])) == sorted(
        map(str, [(i, *plain_scan(t)) for i, t in rows]))
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found)


def test_matching_statistics_are_the_longest_matches():
    draw = random.Random(2)
    templates = {str(k): " ".join(draw.choices("abc", k=12)) for k in range(4)}
    automaton = licenses.Automaton(templates, {"a b": "ab"})
    held = [t.split() for t in [*templates.values(), "a b"]]
    for _ in range(200):
        text = draw.choices("abcd", k=25)
        matches, found = automaton.stream([w.encode() for w in text])

        def stands(i, j):
            return any(h[k:k + j - i] == text[i:j] for h in held for k in range(len(h)))

        grown = [(i, j) for i in range(25) for j in range(i + licenses.LEAST_MATCH, 26) if stands(i, j)
                 and not (i and stands(i - 1, j)) and not (j < 25 and stands(i, j + 1))]
        assert sorted((i, j) for i, j, _ in matches) == sorted(grown)
        assert [i for i, _ in found] == [i for i in range(24) if text[i:i + 2] == ["a", "b"]]


@pytest.mark.parametrize("label", list(licenses.TEMPLATES))
def test_templates_are_found_whole_and_edited(label):
    words = licenses.TEMPLATES[label].split()
    scan = licenses.scan(("foo " * 50 + " ".join(words) + " bar" * 50).encode())
    assert label in scan["labels"].split(",") and scan["score"] < 1
    if len(words) > 30:
        words[20] = "changed"
        assert label in licenses.scan(" ".join(words).encode())["labels"].split(",")
    assert label not in licenses.scan(" ".join(words[:2]).encode())["labels"].split(",")


# encodings

def test_trie_encodes_as_the_library_does(spark, docs):
    library = Tokenizer.from_file(WORD_FILE)
    rows = [*ODD, *enumerate(odd_texts(400, 3), 1000), (2000, "a" * 5000), (2001, "ab%" * 2000)]
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    found = bpe.digests(docs(rows), WORD_FILE).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)


def test_ids_decode_to_the_same_text(spark, docs):
    encoded = bpe.encode(docs(ODD), WORD_FILE)
    again = bpe.decode(encoded.withColumnRenamed("decoded", "before"), WORD_FILE).collect()
    assert len(again) == len(ODD) and all(r.before == r.decoded for r in again)
    assert bpe.decode(spark.createDataFrame([(None,), ([10**6],)], "ids array<int>"), WORD_FILE).collect()[0].decoded is None


def test_bounded_memo_changes_nothing(monkeypatch):
    texts = odd_texts(300, 4)
    whole = bpe.Coder(WORD_FILE).encode(texts)
    monkeypatch.setattr(bpe, "CACHED", 50)
    small = bpe.Coder(WORD_FILE)
    assert [small.encode([t])[0] for t in texts] == whole


# token files

@pytest.mark.parametrize("n,most", [(0, 0), (1, 0), (1, 9), (10, 0), (1000, 3), (1000, 10**6), (200, 2**62), (65, 64)])
def test_elias_fano(n, most):
    values = np.sort(np.random.default_rng(n).integers(0, most + 1, n))
    data = tokenfile.EliasFano.of(values).tobytes()
    read, at = tokenfile.EliasFano.read(b"xy" + data, 2)
    assert at == len(data) + 2 and read.all().tolist() == values.tolist()
    assert [read.select(i) for i in range(n)] == values.tolist()
    with pytest.raises(IndexError):
        read.select(n)


def test_token_file_round_trip(spark, docs, monkeypatch):
    library = Tokenizer.from_file(BYTE_FILE)
    rows = [*ODD, *enumerate(odd_texts(300, 5), 1000)]
    path = tokenfile.token_file(docs(rows), BYTE_FILE)
    found = tokenfile.document_digests(spark, path).orderBy("start").collect()
    ordered = [r.doc_id for r in found]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    want, start = {}, 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = {}
    for r in found:
        assert r.start == start
        start += r.n_tokens
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    whole = {(r.doc_id, r.start): r.ids for r in tokenfile.document_ids(spark, path).collect()}
    assert all(len(whole[r.doc_id, r.start]) == r.n_tokens and whole[r.doc_id, r.start][-1] == 0 for r in found)


def test_empty_tables(spark, docs):
    empty = docs([(1, "x")]).limit(0)
    assert tokenfile.document_digests(spark, tokenfile.token_file(empty, BYTE_FILE)).collect() == []
    assert bpe.digests(empty, WORD_FILE).collect() == []
    assert licenses.license_spans(empty).collect() == []
    scanner = secrets.train(empty)
    assert secrets.findings(empty, scanner).collect() == [] and secrets.redacted(empty, scanner).collect() == []
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(empty, items).collect() == []
    assert decontaminate.contaminated(docs(ODD), items.limit(0)).collect() == []
    assert decontaminate.keep_clean(docs(ODD), items.limit(0)).count() == len(ODD)


# secrets

def test_secrets(spark, docs):
    key, digest = "04dbebab91ab85687d33eeaaf9ac699e1188f962", "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    rows = [*ODD, (20, f'he said token = "{key}" and went'), (21, f"see commit {digest} of then"),
            (22, "write to some.34@mail7.example.com or 9807915762804490 now"), (23, f"password: {key}, TOKEN = '{key.upper()}'")]
    table = docs(rows)
    scanner = secrets.train(table)
    found = {r.doc_id: r for r in secrets.findings(table, scanner).collect() if r.doc_id and r.doc_id >= 20}
    assert [found[i].n_secrets for i in (20, 21, 22, 23)] == [1, 0, 0, 2]
    clean = secrets.redacted(table, scanner)
    assert clean.schema == table.schema and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[20] == f'he said token = "{secrets.REDACTED}" and went'
    assert texts[21] == rows[-3][1] and texts[1] is None and key not in texts[23].lower()


def test_forest_on_unseen_findings():
    corpus = secrets.Corpus(frozenset(["mail", "example"]))
    scanner = secrets.Forest(*_rows(secrets.labelled_findings(), corpus))
    rows, target = _rows(secrets.labelled_findings(seed=77), corpus)
    assert ((scanner.score(rows) >= secrets.THRESHOLD) == target).mean() > 0.97


def _rows(findings, corpus):
    return np.array([secrets.features(*f[:3], corpus) for f in findings]), np.array([float(f[3]) for f in findings])


# test items

def plain_alignment(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = decontaminate.MATCH if a[i - 1] == b[j - 1] > 0 else decontaminate.MISMATCH
            rows[i][j] = max(0, rows[i - 1][j - 1] + same, rows[i - 1][j] + decontaminate.GAP, rows[i][j - 1] + decontaminate.GAP)
    return max(map(max, rows))


def test_alignment_matches_brute_force():
    draw = np.random.default_rng(6)
    for _ in range(300):
        a, b = draw.integers(0, 4, draw.integers(1, 12)), draw.integers(0, 4, draw.integers(1, 20))
        score, first, stop = decontaminate.align(a, b)
        assert score == plain_alignment(a, b) and (score == 0 or plain_alignment(a, b[first:stop]) == score)


def test_contamination(spark, docs):
    draw = random.Random(7)
    some = [draw.choice("abcdefgh") * draw.randint(1, 3) + draw.choice("xyz") for _ in range(3000)]
    items = [(k, " ".join(some[60 * k:60 * k + 40])) for k in range(12)] + [(12, "tiny item"), (13, None), (14, ""), (None, "another tiny thing")]
    edited = items[3][1].split()
    for k in range(3, 40, 9):
        edited[k] = "edited"
    rows = [*ODD, (30, "q " * 50 + items[2][1].upper() + " q" * 50), (31, "r " * 20 + " ".join(edited)), (32, " ".join(some[1000:1500])),
            (33, items[4][1] + " zz " + items[5][1]), (34, "a tiny item here"), (35, "and another tiny thing"), (36, " ".join(items[6][1].split()[:10]))]
    table, bench = docs(rows), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(table, bench).collect()}
    assert set(found) == {(30, 2), (31, 3), (33, 4), (33, 5), (34, 12), (35, None)}
    assert found[30, 2].score == 1 and (found[30, 2].first_word, found[30, 2].stop_word) == (50, 90)
    assert 0.5 <= found[31, 3].score < 1
    kept = decontaminate.keep_clean(table, bench)
    assert kept.schema == table.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in {30, 31, 33, 34, 35})


def test_blocks_of_items_find_the_same(spark, docs, monkeypatch):
    items = spark.createDataFrame([(k, f"item {k} has quite some words of its own number {k}") for k in range(20)], "item_id long, text string")
    table = docs([(k, f"before item {k} has quite some words of its own number {k} after") for k in range(0, 40, 3)])
    whole = sorted(map(tuple, decontaminate.contaminated(table, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, decontaminate.contaminated(table, items).collect())) == whole and len(whole) >= 7


def test_a_long_passage_of_a_longer_item(spark, docs):
    draw = random.Random(8)
    item, short = ([f"w{draw.randrange(5000)}" for _ in range(n)] for n in (700, 59))
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id long, text string")
    rows = [(1, "a b " + " ".join(item[200:500]) + " c"), (2, "d " + " ".join(short[:29]) + " e f"), (3, "g " + " ".join(item[:10]) + " h")]
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(rows), items).collect()} == {(1, 1), (2, 2)}
    assert [r.doc_id for r in decontaminate.keep_clean(docs(rows), items).collect()] == [3]


def test_encodings_are_kept_within_their_bound_and_given_back(spark, docs, monkeypatch):
    import pyarrow as pa

    from millrace.llm.text import id_and_text, in_batches

    whole = bpe.Coder(WORD_FILE).encode(odd_texts(400, 3))
    monkeypatch.setattr(bpe, "CACHED", 60)
    small, got = bpe.Coder(WORD_FILE), []
    for text in odd_texts(400, 3):
        got += small.encode([text])
        assert len(small.memo) + len(small.older) <= 60 + 2 * 40  # a text has no more than 40 pieces and their words
    assert got == whole
    # a worker that goes on to another operator holds nothing of the texts
    table = docs([(i, f"word{i} and others{i}") for i in range(300)])
    assert bpe.digests(table, WORD_FILE).count() == 300
    bpe.digests(table, WORD_FILE).collect()

    def start():
        def step(batch):
            return pa.RecordBatch.from_arrays([pa.array([len(bpe.coder(WORD_FILE).memo)] * batch.num_rows, pa.int64())], ["held"])
        return step

    held = in_batches(id_and_text(table, "doc_id", "text"), "held long", start).collect()
    assert len(held) == 300 and {r.held for r in held} == {0}
