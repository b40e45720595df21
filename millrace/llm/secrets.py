"""Secret scans: candidates by rule, false positives removed by a random forest.

Candidates are what any scanner reports: long runs with a digit in them, and values that
are assigned to something. Most are harmless (paths, addresses, numbers, digests), so a
random forest judges each by its length, the transitions between its characters, how much of
it dictionary words cover, whether it looks like a path, and the words around it.

The forest is trained from labelled findings, ``(before, value, after, secret)``. Pass those
of your reviewers; ``labelled_findings`` makes a set of the common kinds. The dictionary and
the letter transitions are counted over all documents.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log2
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bytes_of, id_and_text, in_batches, slices, words, written

#: Characters of the shortest run with a digit, and of the shortest assigned value.
LONG_RUN, LONG_VALUE = 12, 8
#: Characters on either side of a value in which its neighbours are looked for.
AROUND = 60
#: A word of four letters or more is of the dictionary if it makes this share of all words at least, so
#: there can't be more than its reciprocal of them.
DICTIONARY = 1 / 100_000
TREES, DEPTH, LEAST_LEAF = 40, 8, 4
THRESHOLD = 0.5
REDACTED = "[secret]"
SEED = 10

# Words that tend to stand by secrets and by their look-alikes.
SECRET_WORDS = {
    "token", "key", "apikey", "secret", "password", "passwd", "pwd", "auth", "authorization", "bearer", "credential",
    "credentials", "access", "private", "signature", "client",
}
HARMLESS_WORDS = {
    "commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "etag", "uuid", "version", "release", "file",
    "path", "image", "phone", "call", "fax", "mail", "card", "isbn", "order", "invoice", "page", "http", "https", "url",
}

_RUN = re.compile(r"[A-Za-z0-9+/_=.~%@-]+")
_ASSIGNED = re.compile(r"""[=:]\s*["'`]?([A-Za-z0-9+/_.~%@!$&*^#-]{8,}=*)""")
_DIGIT = re.compile("[0-9]")
_NEAR = re.compile(r"[a-z0-9]+")
_LETTERS = re.compile(r"[a-z]{4,}")
_NAMED = re.compile(r"[A-Za-z_][\w-]*=(?=.{8})")

FEATURES = (
    "length", "digits", "upper", "lower", "other", "changes", "entropy", "transitions", "dictionary", "hexadecimal",
    "path", "secret words", "harmless words", "assigned", "quoted",
)


def candidates(text: str) -> list[tuple[int, int]]:
    """Where values that may be secrets stand, in order and apart from each other."""
    found: set[tuple[int, int]] = set()
    at = 0
    for piece in text.split():
        if len(piece) < LONG_RUN or not _DIGIT.search(piece):
            continue
        at = text.index(piece, at)
        for run in _RUN.finditer(piece):
            start, value = run.start(), run.group()
            if named := _NAMED.match(value):
                start, value = start + named.end(), value[named.end():]
            value = value.rstrip(".-")
            if len(value) >= LONG_RUN and _DIGIT.search(value):
                found.add((at + start, at + start + len(value)))
        at += len(piece)
    if "=" in text or ":" in text:
        for match in _ASSIGNED.finditer(text):
            start, stop = match.span(1)
            value = text[start:stop].rstrip(".-:")
            if len(value) >= LONG_VALUE:
                found.add((start, start + len(value)))
    out: list[tuple[int, int]] = []
    for start, stop in sorted(found, key=lambda s: (s[0], -s[1])):
        if not out or start >= out[-1][1]:
            out.append((start, stop))
    return out


@dataclass
class Corpus:
    """What is counted over all documents: a dictionary and the chance of letter pairs."""

    dictionary: frozenset[str] = frozenset()
    pairs: np.ndarray = field(default_factory=lambda: np.full((26, 26), -np.log(26)))


def corpus_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Corpus:
    """Count words and letter pairs of every whole text. Only ASCII letters make pairs."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def emitted() -> pa.RecordBatch:
            some = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return some

        for batch in slices(batches):
            for text in bytes_of(batch.column(1)):
                held.update(words(text))
            if len(held) > 200_000:  # partial counts go on, so memory stays bounded
                yield emitted()
        yield emitted()

    counts = id_and_text(docs, id_col, text_col).mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    word = F.decode("word", "UTF-8")
    counts = counts.select(word.alias("word"), "n").where(F.col("word").rlike("^[a-z]{2,}$"))
    counts = written(counts, "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where((F.length("word") >= 4) & (F.col("n") >= total * DICTIONARY)).collect()
    # letter pairs inside words, weighted by how often the words occur
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr(F.col("word"), i, F.lit(2))))
    pairs = np.ones((26, 26))
    for row in counts.select(pair.alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 676 at most
        pairs[ord(row.pair[0]) - 97, ord(row.pair[1]) - 97] += row.n
    return Corpus(frozenset(r.word for r in common), np.log(pairs / pairs.sum(axis=1, keepdims=True)))


def features(before: str, value: str, after: str, corpus: Corpus) -> list[float]:
    """What the forest sees of a candidate, in the order of ``FEATURES``."""
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
    low = value.lower()
    codes = np.frombuffer(low.encode("ascii", "replace"), dtype=np.uint8).astype(np.int64) - 97
    letters = (codes >= 0) & (codes < 26)
    both = letters[:-1] & letters[1:]
    likely = corpus.pairs[codes[:-1][both], codes[1:][both]].mean() if both.any() else -np.log(26.0)
    covered = sum(len(w) for w in _LETTERS.findall(low) if w in corpus.dictionary)
    led = _NEAR.findall(before.lower())[-3:]  # a word behind may introduce the next value
    near = led + _NEAR.findall(after.lower())[:2]
    lead = before.rstrip()
    return [
        float(n), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, kinds.count("o") / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        -sum(k / n * log2(k / n) for k in Counter(value).values()), float(likely), covered / n,
        float(all(c in "0123456789abcdef" for c in low)), float(sum(map(value.count, "/.@"))),
        float(sum(w in SECRET_WORDS for w in led)), float(sum(w in HARMLESS_WORDS for w in near)),
        float(lead.rstrip("\"'`").rstrip()[-1:] in ("=", ":") and lead != ""), float(before[-1:] in ("'", '"', "`") and before != ""),
    ]


class Forest:
    """A random forest of small trees: each over a bootstrap, splits over drawn features."""

    def __init__(self, rows: np.ndarray, target: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> None:
        draw = np.random.default_rng(SEED)
        self.trees = []
        for _ in range(trees):
            own = draw.integers(0, len(rows), len(rows))
            nodes: list[list[float]] = []
            self._grow(rows[own], target[own], depth, draw, nodes)
            self.trees.append(np.array(nodes))

    def _grow(self, rows: np.ndarray, target: np.ndarray, depth: int, draw: np.random.Generator, nodes: list) -> int:
        """Nodes are (feature or -1, cut, left, right, share of positives)."""
        place = len(nodes)
        nodes.append([-1.0, 0.0, 0.0, 0.0, float(target.mean())])
        if depth == 0 or len(rows) < 2 * LEAST_LEAF or target.min() == target.max():
            return place
        best = (np.inf, -1, 0.0)
        for f in draw.permutation(rows.shape[1])[:max(1, round(rows.shape[1] ** 0.5))]:
            order = np.argsort(rows[:, f], kind="stable")
            values, positives = rows[order, f], np.cumsum(target[order])
            left = np.arange(1, len(rows))
            cut = (values[1:] > values[:-1]) & (left >= LEAST_LEAF) & (len(rows) - left >= LEAST_LEAF)
            if not cut.any():
                continue
            p, q = positives[:-1] / left, (positives[-1] - positives[:-1]) / (len(rows) - left)
            impurity = np.where(cut, left * p * (1 - p) + (len(rows) - left) * q * (1 - q), np.inf)
            k = int(impurity.argmin())
            best = min(best, (float(impurity[k]), int(f), float(values[k])))
        if best[1] < 0:
            return place
        goes = rows[:, best[1]] <= best[2]
        nodes[place][:2] = best[1], best[2]
        nodes[place][2] = self._grow(rows[goes], target[goes], depth - 1, draw, nodes)
        nodes[place][3] = self._grow(rows[~goes], target[~goes], depth - 1, draw, nodes)
        return place

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The mean share of positives in the leaves that each row falls into."""
        total = np.zeros(len(rows))
        for nodes in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                feature = nodes[at, 0].astype(np.int64)
                inner = np.flatnonzero(feature >= 0)
                if not len(inner):
                    break
                goes = rows[inner, feature[inner]] <= nodes[at[inner], 1]
                at[inner] = np.where(goes, nodes[at[inner], 2], nodes[at[inner], 3]).astype(np.int64)
            total += nodes[at, 4]
        return total / len(self.trees)


def labelled_findings(each: int = 120, seed: int = SEED) -> list[tuple[str, str, str, int]]:
    """Findings of common kinds with their labels, the same for a seed.

    Secrets are digests, keys and signed tokens that a word like ``token`` introduces, or
    keys of well-known shapes anywhere. The rest are digests of commits and files, ids,
    versions, paths, addresses, numbers of cards and phones, and long names.
    """
    draw = Random(seed)
    plain = "the with and for from this that into over more than when where while about there these".split()
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def some(letters: str, n: int) -> str:
        return "".join(draw.choice(letters) for _ in range(n))

    def name() -> str:
        return "".join(draw.choice((draw.choice(plain), some(alphabet[26:52], draw.randint(1, 9)))) for _ in range(3))

    def hexes() -> str:
        return some("0123456789abcdef", draw.choice((32, 40, 64)))

    secrets = [
        hexes, lambda: some(alphabet, draw.randint(20, 48)), lambda: "AKIA" + some(alphabet[:26] + "234567", 16),
        lambda: "ghp_" + some(alphabet, 36), lambda: "sk-" + some(alphabet, 48),
        lambda: base64.b64encode(draw.randbytes(draw.randint(18, 40))).decode(),
        lambda: ".".join(base64.urlsafe_b64encode(draw.randbytes(n)).decode().rstrip("=") for n in (24, 60, 32)),
        lambda: some(alphabet + "!$&*^#", draw.randint(10, 18)),
    ]
    shaped = secrets[2:5]
    harmless = [
        (lambda: hexes(), ("commit ", "sha256 ", "md5 checksum ", "digest: ", "etag: ")),
        (lambda: str(uuid.UUID(bytes=draw.randbytes(16))), ("uuid ", "order ", "id: ")),
        (lambda: f"{name()}-{draw.randint(1, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 20)}", ("version ", "release ", "")),
        (lambda: f"/{name()}/{name()}{draw.randint(1, 99)}/{name()}.txt", ("file ", "path = ", "")),
        (lambda: f"{name()[:draw.randint(1, 12)]}.{draw.randint(1, 99)}@mail{draw.randint(1, 9)}.example.com", ("mail ", "", "")),
        (lambda: some("0123456789", 16), ("card ", "", "number ")),
        (lambda: f"555-{some('0123456789', 4)}-{some('0123456789', 4)}", ("phone ", "call ", "")),
        (lambda: f"www.{name()}{draw.randint(1, 99)}.example.org/{name()}", ("url: ", "http ", "")),
        (lambda: f"{name()}_{name()}{draw.randint(1, 9)}", ("", "name = ", "image: ")),
        (lambda: name() + name(), ("note: ", "name = ", "thus: ")),
        (lambda: f"20{some('0123456789', 2)}-0{draw.randint(1, 9)}-1{draw.randint(0, 9)}T0{draw.randint(1, 9)}:15", ("at ", "")),
    ]
    out = []
    for make in secrets:
        for _ in range(each):
            key = draw.choice(("token", "api_key", "secret", "password", "auth token", "access key", "client secret"))
            sign, quote = draw.choice((" = ", ": ", "=", " ")), draw.choice(('"', "'", ""))
            lead = "" if make in shaped and draw.random() < 0.3 else key + sign
            out.append((f"{draw.choice(plain)} {draw.choice(plain)} {lead}{quote}", make(), f"{quote} {draw.choice(plain)}", 1))
    for make, leads in harmless:
        for _ in range(each):
            quote = draw.choice(('"', "", "", ""))
            out.append((f"{draw.choice(plain)} {draw.choice(plain)} {draw.choice(leads)}{quote}", make(), f"{quote} {draw.choice(plain)}", 0))
    return out


@dataclass
class Scanner:
    forest: Forest
    corpus: Corpus

    def scan(self, text: str) -> list[tuple[int, int, float]]:
        """(start, stop, score) of all candidates of a text."""
        found = candidates(text)
        if not found:
            return []
        rows = [features(text[max(0, a - AROUND):a], text[a:b], text[b:b + AROUND], self.corpus) for a, b in found]
        return [(a, b, s) for (a, b), s in zip(found, self.forest.score(np.array(rows)).tolist())]

    def redact(self, text: str, threshold: float) -> str:
        parts, at = [], 0
        for start, stop, score in self.scan(text):
            if score >= threshold:
                parts += [text[at:start], REDACTED]
                at = stop
        return "".join(parts) + text[at:] if parts else text


def train(docs: DataFrame, labelled: list[tuple[str, str, str, int]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> Scanner:
    """A scanner for these documents. ``labelled`` must hold findings of both labels."""
    corpus = corpus_of(docs, id_col, text_col)
    known = labelled_findings() if labelled is None else labelled
    rows = np.array([features(before, value, after, corpus) for before, value, after, _ in known])
    return Scanner(Forest(rows, np.array([float(secret) for *_, secret in known])), corpus)


def findings(
    docs: DataFrame, scanner: Scanner, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_candidates, n_secrets, secrets, score)`` of every whole text.

    ``secrets`` are places in characters with their scores, ``score`` the highest of any
    candidate (0 without one). Null and empty texts have none. A row a row, rows with equal
    or null ids too; other columns are not read.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scans = [scanner.scan(t or "") for t in batch.column(1).to_pylist()]
            kept = [[{"start": a, "stop": b, "score": s} for a, b, s in scan if s >= threshold] for scan in scans]
            return pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in scans], pa.int64()), pa.array([len(k) for k in kept], pa.int64()),
                pa.array(kept, kind), pa.array([max([s for _, _, s in scan], default=0.0) for scan in scans], pa.float64()),
            ], ["doc_id", "n_candidates", "n_secrets", "secrets", "score"])

        return step

    schema = "doc_id long, n_candidates long, n_secrets long, secrets array<struct<start: long, stop: long, score: double>>, score double"
    return in_batches(id_and_text(docs, id_col, text_col), schema, start)


def redacted(docs: DataFrame, scanner: Scanner, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` with ``REDACTED`` in the place of each secret; null texts and other columns as they are."""
    place = docs.columns.index(text_col)

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if t is None else scanner.redact(t, threshold) for t in batch.column(place).to_pylist()]
            return batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

        return step

    return in_batches(docs, docs.schema, start)
