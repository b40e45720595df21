"""BPE encoding and decoding by a trie of distinct words and last-token states.

The BPE encoding of a prefix of a word ends in one token, and what stands before that
token is the encoding of the shorter prefix. So a prefix needs one state only: its last
token. Words are put into a trie; a walk in depth first order gives each node its state
from the states above it, and words that share a prefix share that work. A token may
follow another if the two, written together, encode to just these two; then, and only
then, a chain of such pairs is an encoding (merges act the same inside any context that
does not cross them).

Words come from whole texts, normalised and split the way the vocabulary's file says (NFC,
white space as separator, lower case, contractions, letters, single digits, the rest).
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .text import id_and_text, in_batches, keeps

#: How the vocabulary's file splits normalised text into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: What the file's pattern for white space, ``\s``, matches.
SPACES = regex.compile(r"\s+")
#: Controls that str.split() takes for white space and the pattern does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Beyond Latin letters the two sides may know different editions of Unicode: there the
#: library that the results must equal normalises and splits.
FOREIGN = regex.compile(r"[^\x00-\u024f\u2010-\u2027\u20ac]")
END = "</w>"

#: A worker keeps the encodings of so many pieces, those used last, and so many pairs of tokens; a slice of
#: texts with more new pieces is kept while it lasts. A bound on memory only.
CACHED = 300_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = itertools.count(256)
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merge ranks and the memo of which tokens may stand side by side."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model["end_of_word_suffix"] != END or data["pre_tokenizer"] is None or model["continuing_subword_prefix"]:
            raise ValueError("a vocabulary with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.texts = {i: t for t, i in (self.ids | self.special).items()}
        #: finds every token that ends at each letter of a word, longest first
        self.endings = ahocorasick.Automaton()
        for token in self.ids:
            self.endings.add_word(token, (token, len(symbols(token)), token.endswith(END)))
        self.endings.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}

    def merged(self, parts: list[str]) -> list[str]:
        """Plain BPE on a few symbols: the best-ranked neighbours merge, leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            ranked = [(self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == len(self.ranks):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stands(self, token: str) -> bool:
        """Whether a token's own text encodes to it alone."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merged(symbols(token)) == [token]
        return known

    def follows(self, left: str, right: str) -> bool:
        """Whether the two tokens, written together, encode to just these two."""
        known = self.stands(right) and self.merged(symbols(left) + symbols(right)) == [left, right]
        if len(self.pairs) >= CACHED:
            self.pairs.clear()
        self.pairs[left, right] = known
        return known


def symbols(token: str) -> list[str]:
    """A token's characters, the last one with the word end if the token has it."""
    if token.endswith(END) and len(token) > len(END):
        stem = token[:-len(END)]
        return [*stem[:-1], stem[-1] + END]
    return list(token)


def encode_words(words: Iterable[str], vocabulary: Vocabulary) -> dict[str, list[str]]:
    """The tokens of each distinct word (given in byte letters), shared prefixes once.

    Sorted words are the leaves of their trie in depth-first order: where a word parts from
    the one before, the path forks, and the states up to there serve both. So only the path
    to the current leaf is held, and unforked stretches cost nothing.
    """
    found: dict[str, list[str]] = {}
    last: list[tuple[str, int]] = []  # the state of each prefix of the path, a token and its size
    above = ""
    for word in sorted(set(words)):
        fork, most = 0, min(len(word), len(above)) - 1  # a last letter with the word end is one of its own
        while fork < most and word[fork] == above[fork]:
            fork += 1
        del last[fork:]
        _propagate(word, last, vocabulary)
        tokens, end = [], len(word)
        while end:
            token, size = last[end - 1]
            tokens.append(token)
            end -= size
        tokens.reverse()
        found[word] = tokens
        above = word
    return found


def _propagate(word: str, last: list[tuple[str, int]], vocabulary: Vocabulary) -> None:
    """Add the states of a word's prefixes that ``last`` lacks, the whole word's at the end."""
    known, inner = len(last), len(word) - 1
    final = inner + len(END)
    pairs = vocabulary.pairs
    for place, (token, size, ends) in vocabulary.endings.iter(word + END):
        if place != known or place >= inner:
            if place != final or not ends or known != inner:
                continue  # known from the words before or from a longer token, or inside the word end
            place = inner
        before = place + 1 - size
        if before:
            left = last[before - 1][0]
            follows = pairs.get((left, token))
            if follows is None:
                follows = vocabulary.follows(left, token)
        else:
            follows = vocabulary.stands(token)
        if follows:
            last.append((token, size))
            known += 1
    if known != len(word):
        raise ValueError(f"no token ends {word[:known + 1]!r}")


class Coder:
    """Encodes texts piece by piece (a piece: what white space parts), with a bounded memo."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        #: piece -> its ids in decimal and its tokens, both space-joined
        self.memo: dict[str, tuple[str, str]] = {}
        #: what the memo held before it was full: pieces met again go back into the memo
        self.older: dict[str, tuple[str, str]] = {}
        self.letters = str.maketrans({b: c for b, c in enumerate(byte_letters())})
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.special = regex.compile("(" + "|".join(
            map(regex.escape, sorted(self.vocabulary.special, key=len, reverse=True))) + ")")

    def pieces(self, text: str) -> list[str]:
        """Normalised pieces of a text; special tokens are found before that and stay whole."""
        special = self.vocabulary.special
        if not any(s in text for s in special):
            return self.normalised(text)
        parts = self.special.split(text)
        return [p for part in parts for p in ([part] if part in special else self.normalised(part))]

    def normalised(self, text: str) -> list[str]:
        """The pieces of a text in NFC and lower case, letter by letter, parted by white space."""
        if not text.isascii():
            if FOREIGN.search(text):
                return [p for p in self.normalizer.normalize_str(text).split(" ") if p]
            text = unicodedata.normalize("NFC", text)
        text = text.lower()
        if any(c in text for c in SEPARATORS):
            return [p for p in SPACES.split(text) if p]
        return text.split()

    def learn(self, pieces: set[str]) -> None:
        """Add the encodings of new pieces to the memo: their distinct words go into one trie.

        A word is a piece too, so a word with a mark behind it uses what is known of the word.
        """
        new = pieces.difference(self.memo)
        if len(self.memo) + len(new) > CACHED // 2:
            self.older, self.memo = self.memo, {}
            new = pieces
        again = [p for p in new if p in self.older]
        self.memo.update((p, self.older[p]) for p in again)
        new = new.difference(again)
        special, letters = self.vocabulary.special, self.letters
        split: dict[str, list[str]] = {}
        unknown: dict[str, str] = {}  # a new word in byte letters -> the word
        foreign: dict[str, list[str]] = {}  # pieces that the library splits, in byte letters
        for piece in new:
            if piece in special:
                self.memo[piece] = (str(special[piece]), piece)
                continue
            if FOREIGN.search(piece):
                foreign[piece] = [w for w, _ in self.splitter.pre_tokenize_str(piece)]
                continue
            words = split[piece] = WORD.findall(piece)
            for word in words:
                if word not in self.memo and word in self.older:
                    self.memo[word] = self.older[word]
                elif word not in self.memo:
                    plain = word.isascii() and word.isprintable()
                    unknown[word if plain else word.encode().decode("latin-1").translate(letters)] = word
        found = encode_words(unknown.keys() | {w for words in foreign.values() for w in words}, self.vocabulary)
        ids = self.vocabulary.ids
        written = {w: (" ".join([str(ids[t]) for t in tokens]), " ".join(tokens)) for w, tokens in found.items()}
        self.memo.update((word, written[lettered]) for lettered, word in unknown.items())
        for piece, words in split.items():
            if len(words) > 1:
                self.memo[piece] = _joined([self.memo[w] for w in words])
            elif not words:
                self.memo[piece] = ("", "")
        for piece, words in foreign.items():
            self.memo[piece] = _joined([written[w] for w in words])

    def forget(self) -> None:
        """Give back what was learned from texts; the vocabulary stays."""
        for known in (self.memo, self.older, self.vocabulary.pairs):
            known.clear()

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids in decimal, decoded text) of each text. The vocabulary's file names no
        decoder, so decoding an id gives its token and tokens are joined by spaces."""
        cut = [self.pieces(text) for text in texts]
        self.learn(set().union(*cut))
        out = []
        for pieces in cut:
            out.append(_joined([self.memo[p] for p in pieces]))
        return out


def _joined(parts: list[tuple[str, str]]) -> tuple[str, str]:
    return " ".join([i for i, _ in parts]), " ".join([t for _, t in parts])


def portions(texts: list[str], size: int = 4_000_000) -> Iterator[list[str]]:
    """Texts in order, so many characters at once that the memory of a task stays bounded."""
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


@functools.cache
def coder(path: str) -> Coder:
    """One coder for a Python worker: its memo of bounded size serves task after task."""
    return Coder(path)


def _run(path: str, row: Callable[[str, str], tuple], names: list[str], types: list[pa.DataType]):
    def start():
        encoder = coder(path)
        keeps(encoder.forget)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            rows = [row(ids, text) for part in portions(texts) for ids, text in encoder.encode(part)]
            made = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            return pa.RecordBatch.from_arrays([batch.column(0), *made], names)

        return step

    return start


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>, decoded)`` of every whole text (null: empty).

    A text without a word has no ids and decodes to an empty text. Rows with equal or null
    ids stay separate rows; columns beside the two named ones are not read.
    """
    def row(ids: str, decoded: str) -> tuple:
        return [int(i) for i in ids.split()], decoded

    start = _run(path, row, ["doc_id", "ids", "decoded"], [pa.list_(pa.int32()), pa.string()])
    return in_batches(id_and_text(docs, id_col, text_col), "doc_id long, ids array<int>, decoded string", start)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with the number of ids and SHA-256 of ids and decoded text in their place."""
    def row(ids: str, decoded: str) -> tuple:
        n = ids.count(" ") + 1 if ids else 0
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    start = _run(path, row, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()])
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return in_batches(id_and_text(docs, id_col, text_col), schema, start)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the tokens of the ids, joined by spaces (null ids: null).

    An id that the vocabulary lacks gives nothing.
    """
    texts = Vocabulary(path).texts

    @F.pandas_udf("string")
    def join(ids: pd.Series) -> pd.Series:
        return ids.map(lambda row: None if row is None else " ".join([texts[i] for i in row if i in texts]))

    return encoded.withColumn("decoded", join(ids_col))
