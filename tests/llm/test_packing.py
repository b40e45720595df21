"""Packing: every id once, the rule beside a plain one, whole sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.bytebpe import encoder

from .conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def packed(sizes, window, most_open=1000):
    out = []
    packer = packing.Packer(out.append, window, most_open)
    for doc, size in enumerate(sizes):
        packer.add(doc, np.arange(size, dtype="<u4"))
        yield_open = packer.open
        assert yield_open == packer.levels.sum() <= most_open
    packer.finish()
    return out


def test_every_id_stands_in_one_piece_and_nothing_is_padded():
    draw = random.Random(1)
    for window, most_open in ((16, 1000), (64, 5), (2048, 50), (7, 3)):
        sizes = [draw.randint(1, 3 * window) for _ in range(400)]
        out = packed(sizes, window, most_open)
        found = sorted((doc, start, len(ids), total) for pieces in out for doc, start, ids, total in pieces)
        at = 0
        for doc, start, size, total in found:
            assert total == sizes[doc] and size > 0 and start == (at if start else 0)
            at = start + size
            if at == total:
                at = 0
        assert sum(f[2] for f in found) == sum(sizes)
        assert all(ids.tolist() == list(range(start, start + len(ids))) for pieces in out for _, start, ids, _ in pieces)
        filled = [sum(len(p[2]) for p in pieces) for pieces in out]
        assert all(f == window or f & (f - 1) == 0 for f in filled)
        assert sum(f != window for f in filled) <= window.bit_length()


def test_the_level_is_that_of_the_least_sum_of_squares():
    draw, window = random.Random(2), 12
    for _ in range(500):
        packer = packing.Packer(lambda p: None, window)
        packer.levels[1:window] = [draw.choice([0, 0, 1, 2, 5]) for _ in range(window - 1)]
        size = draw.randint(1, window - 1)

        def cost(level):
            after = packer.levels.copy()
            if level:
                after[level] -= 1
            if level + size < window:
                after[level + size] += 1
            return (after**2).sum()

        fit = [h for h in range(window - size + 1) if not h or packer.levels[h]]
        assert packer.level(size) == max(fit, key=lambda h: (-cost(h), h))


def test_pieces_of_odd_texts_put_together_are_the_librarys_ids(spark, docs):
    rows = [*ODD, *[(100 + i, "some more words of text " * i) for i in range(60)], (70, "a <|endoftext|> b"), (71, "ſ  ​ x")]
    found = packing.pieces(docs(rows), PATH, window=256, most_open=4)
    got = {}
    for r in found.collect():
        got.setdefault(r.sequence_id, []).append((r.offset, r.length, r.doc_id, r.start, r.doc_tokens, r.ids))
    for parts in got.values():
        at = 0
        for offset, length, *_, ids in sorted(parts, key=lambda p: p[0]):
            assert offset == at and length == len(ids)
            at += length
        assert at == 256 or at & (at - 1) == 0
    library = Tokenizer.from_file(PATH)
    texts = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows if i != 6 and i is not None}
    whole = {}
    for parts in got.values():
        for _, _, doc, start, total, ids in parts:
            whole.setdefault(doc, []).append((start, ids, total))
    for doc, ids in texts.items():
        assert sum((p[1] for p in sorted(whole[doc])), []) == ids and all(p[2] == len(ids) for p in whole[doc])
    digests = packing.piece_digests(docs(rows), PATH, window=256, most_open=4)
    assert sorted((r.sequence_id, r.offset, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found.collect()) == sorted(
        (r.sequence_id, r.offset, r.ids_crc32) for r in digests.collect())
    rows = packing.sequences(found, 256, pad_id=9).collect()
    assert all(len(r.ids) == r.n_tokens for r in rows) and len(rows) == len(got)
    cut = packing.sequences(found.where("offset < 100 AND length < 90"), 256, pad_id=9).collect()
    assert all(len(r.ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 256) for r in cut)
    assert packing.pieces(docs(rows[:0]), PATH).collect() == []


def test_both_encoders_agree():
    coder, draw = encoder(PATH), random.Random(5)
    assert coder.fast
    pool = list("aAzZ09'’\"!?.<|>\t\n\r \x0b\x0c\x1c\x85éÉßñİſ¡²½×÷Ɏɏɐªº日🎉​ ") + ["<|endoftext|>", "'s", " the", "  ", "\n\n"]
    for _ in range(6000):
        text = "".join(draw.choices(pool, k=draw.randint(0, 40)))
        assert coder.ids(text).tolist() == coder.whole(text).tolist(), text
    for code in range(1, 0x260):
        for text in (f"a{chr(code)}b {chr(code)}1", f"{chr(code)}{chr(code)} \n{chr(code)}'{chr(code)}s"):
            assert coder.ids(text).tolist() == coder.whole(text).tolist(), text
    for text in (" " * 1_000_000, "abcdefghij" * 30_000):
        assert coder.ids(text).tolist() == coder.whole(text).tolist()
