"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte sequences of one to ``LONGEST`` letters (hashed to ``SLOTS``
places), and the kernel of two texts is the number of sequences both hold over the root of
the product of their numbers. Ridge regression, one language against the rest, is solved on
the Nyström features of a few landmark texts. As the kernel is an inner product, landmarks
and coefficients fold into one matrix, and texts are scored by a matrix product per batch.

The model is fitted on a bounded sample (``TRAIN`` texts of each language, ``LANDMARKS`` of
all); scoring reads every whole text and shuffles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bytes_of, id_and_text, in_batches

SLOTS, LONGEST = 4096, 3
#: Bounds of the sample the model is fitted on: texts a language, landmarks in all.
TRAIN, LANDMARKS = 2_000, 240
RIDGE = 1e-3
SEED = 9
UNKNOWN = "und"
_DRAWS = 1 << 30

#: Letters in lower case and the bytes of non-ASCII characters; all else parts words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_PART = 1 << 20


def presence(text: bytes) -> np.ndarray:
    """Which places a text's byte sequences fill, as 0 and 1."""
    filled = np.zeros(SLOTS, dtype=np.uint8)
    data = text.translate(_LETTERS)
    for start in range(0, len(data), _PART):  # a very long text in overlapping parts
        letters = np.frombuffer(data[start:start + _PART + LONGEST - 1], dtype=np.uint8).astype(np.uint32)
        code = np.zeros(len(letters), dtype=np.uint32)
        for size in range(1, LONGEST + 1):
            code = code[:len(letters) - size + 1] * np.uint32(257) + letters[size - 1:]
            # multiplicative hashing: the high bits of the product
            filled[(code * np.uint32(2654435761) + np.uint32(size)) >> np.uint32(20)] = 1
    return filled


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # SLOTS x languages

    def score(self, rows: np.ndarray) -> np.ndarray:
        """One-versus-rest scores of rows of ``presence``."""
        sizes = np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.float32), 1))
        return rows.astype(np.float32) @ self.matrix / sizes[:, None]


def fit(rows: np.ndarray, languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on Nyström landmarks, drawn evenly from the languages."""
    names = sorted(set(languages))
    target = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    draw = np.random.default_rng(SEED)
    each = -(-landmarks // len(names))
    chosen = np.concatenate([draw.permutation(np.flatnonzero(target[:, k] > 0))[:each] for k in range(len(names))])
    unit = rows.astype(np.float32)
    unit /= np.sqrt(np.maximum(unit.sum(axis=1), 1))[:, None]
    cross = (unit @ unit[chosen].T).astype(np.float64)
    own = cross[chosen]
    # every language weighs the same, however many texts it has
    weight = 1 / (target > 0).sum(axis=0)[(target > 0).argmax(axis=1)]
    weight /= weight.sum()
    left = cross.T @ (cross * weight[:, None]) + ridge * own + 1e-9 * np.eye(len(chosen))
    alpha = np.linalg.solve(left, cross.T @ (target * weight[:, None]))
    return Model(names, (unit[chosen].T @ alpha).astype(np.float32))


def train(docs: DataFrame) -> Model | None:
    """Fit on ``docs(doc_id, text, lang)``: rows with a language, an id and a letter.

    Up to ``TRAIN`` texts of each language (in expectation; a hash of the id draws them).
    None if no such row is there.
    """
    usable = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not counts:
        return None
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, TRAIN / n) * _DRAWS))])
    drawn = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(_DRAWS)) < limits[F.col("lang")])

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1)
            some = pa.array([has_letter(t) for t in texts.to_pylist()], pa.bool_())
            rows = [np.packbits(presence(t)).tobytes() for t in bytes_of(texts.filter(some))]
            return pa.RecordBatch.from_arrays([batch.column(0).filter(some), pa.array(rows, pa.binary())], ["lang", "bits"])

        return step

    found = in_batches(drawn.select("lang", "text"), "lang string, bits binary", start).toArrow().to_pydict()
    if not found["lang"]:
        return None
    bits = np.frombuffer(b"".join(found["bits"]), dtype=np.uint8).reshape(-1, SLOTS // 8)
    return fit(np.unpackbits(bits, axis=1), found["lang"])


def languages(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every whole text.

    A null text, one without a letter, and any text without a model are ``und`` with the
    score 0; else the score is the best language's regression value, put from [-1, 1] to
    [0, 1]. Ties go to the language first by name. A row a row, rows with equal or null ids
    too; other columns are not read.
    """
    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1)
            names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            some = [i for i, t in enumerate(texts.to_pylist()) if model is not None and has_letter(t)]
            if some:
                found = model.score(np.stack([presence(t) for t in bytes_of(texts.take(pa.array(some)))]))
                best = found.argmax(axis=1)
                top = np.clip((found.max(axis=1).astype(np.float64) + 1) / 2, 0, 1)
                for i, k, s in zip(some, best.tolist(), top.tolist()):
                    names[i], scores[i] = model.languages[k], s
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                              ["doc_id", "lang_pred", "score"])

        return step

    return in_batches(id_and_text(docs, id_col, text_col), "doc_id long, lang_pred string, score double", start)
