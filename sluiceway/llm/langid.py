"""Language of a text by a string kernel: presence of character n-grams, Nyström landmarks, kernel ridge regression.

The blended-spectrum presence kernel of two texts is the number of distinct n-grams (n from 1 to ``longest``) that
both hold, over the geometric mean of how many each holds. N-grams are told apart by a hash of ``BITS`` bits. A
bounded sample of labelled rows is fitted on the driver: some of them are landmarks, one ridge regression for each
language maps the kernel values to its label. A batch of texts is scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, stored, texts_of

BITS = 18
UNKNOWN = "und"
_PIECE = 1_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Presence:
    """Marks the hashed n-grams of one text at a time; very long texts go through in pieces."""

    def __init__(self, longest: int):
        self.longest = longest
        self.marks = np.zeros(1 << BITS, bool)

    def buckets(self, text: str) -> list[np.ndarray]:
        found, low = [], text.lower()
        for start in range(0, len(low), _PIECE):
            piece = low[start : start + _PIECE + self.longest - 1]
            points = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
            gram = np.zeros(len(points), np.uint64)
            for n in range(self.longest):
                if len(points) <= n:
                    break
                gram = (gram[: len(points) - n] * np.uint64(0x100000001B3)) ^ points[n:]
                found.append(((gram * _FACTOR) >> np.uint64(64 - BITS)).astype(np.int64))
        return found

    def row(self, text: str, columns: np.ndarray) -> tuple[np.ndarray, int]:
        """Which of ``columns`` the text holds, and how many n-grams it holds in all."""
        found = self.buckets(text)
        for part in found:
            self.marks[part] = True
        held, size = self.marks[columns], int(np.count_nonzero(self.marks))
        for part in found:
            self.marks[part] = False
        return held, size

    def held(self, text: str) -> np.ndarray:
        found = self.buckets(text)
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Landmarks as columns of a presence matrix over the n-grams that any of them holds."""

    languages: list[str]
    columns: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    longest: int

    def decisions(self, texts: list[str], presence: Presence) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The decisions on each text, the share of its n-grams that any landmark holds, and how many it has."""
        rows = np.zeros((len(texts), len(self.columns)), np.float32)
        sizes = np.zeros(len(texts), np.float32)
        for i, text in enumerate(texts):
            rows[i], sizes[i] = presence.row(text, self.columns)
        return self._decided(rows, sizes)

    def _decided(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kernel = (rows @ self.landmarks) / np.sqrt(np.maximum(sizes, 1))[:, None]
        return kernel @ self.weights, rows.sum(1) / np.maximum(sizes, 1), sizes


def _marked(held: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Which of ``columns`` each of some sorted arrays of n-grams holds."""
    rows = np.zeros((len(held), len(columns)), np.float32)
    for i, own in enumerate(held):
        at = np.searchsorted(columns, own)
        hit = at < len(columns)
        hit[hit] = columns[at[hit]] == own[hit]
        rows[i, at[hit]] = 1
    return rows


def fit(held: list[np.ndarray], labels: list[str], landmarks_each: int, landmarks_most: int, ridge: float, longest: int) -> Model | None:
    """Ridge regression on kernel values to landmarks, one against the rest; None without labelled texts.

    A language gives ``landmarks_each`` landmarks, or fewer, so that there are ``landmarks_most`` at most: the model then holds
    at most that many numbers for each of the ``2 ** BITS`` n-grams, 400 MB with 400.
    """
    languages = sorted(set(labels))
    if not languages:
        return None
    labels_at = np.array([languages.index(x) for x in labels])
    each = max(1, min(landmarks_each, landmarks_most // len(languages)))
    chosen = np.concatenate([np.flatnonzero(labels_at == c)[:each] for c in range(len(languages))])[:landmarks_most]
    columns = np.unique(np.concatenate([held[i] for i in chosen]))
    if not len(columns):
        return None
    size = np.sqrt(np.maximum([len(h) for h in held], 1)).astype(np.float32)
    landmarks = (_marked([held[i] for i in chosen], columns) / size[chosen, None]).T
    kernel = np.concatenate([_marked(held[i : i + 256], columns) @ landmarks for i in range(0, len(held), 256)])
    kernel = (kernel / size[:, None]).astype(np.float64)
    among = kernel[chosen]
    target = np.where(labels_at[:, None] == np.arange(len(languages)), 1.0, -1.0)
    system = kernel.T @ kernel + ridge * len(held) * (among + among.T) / 2 + 1e-6 * np.eye(len(chosen))
    weights = np.linalg.lstsq(system, kernel.T @ target, rcond=None)[0].astype(np.float32)
    return Model(languages, columns, np.ascontiguousarray(landmarks), weights, longest)


def _presence(longest: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(longest)
        for batch in batches:
            held = [presence.held(t).astype(np.uint32).tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["place"], pa.array(held, pa.binary())], names=["lang", "place", "held"])

    return find


def _sample(docs: DataFrame, rows_each: int, rows_most: int, longest: int) -> tuple[list[np.ndarray], list[str]]:
    """N-grams and labels of ``rows_each`` rows of each label, ``rows_most`` in all: those with the smallest hash of doc_id.

    Rows are thinned out by a bound on the hash first, from the count of their label, so that the one task that ranks a label gets
    some ``2 * rows_each`` rows whatever the table's size.
    """
    draw = F.xxhash64("doc_id")
    labelled = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stored(labelled.groupBy("lang").agg(F.count("*").alias("n")))
    low = labelled.select("doc_id", "lang").join(counts, "lang").filter((draw.cast("double") / 2.0**64 + 0.5) * F.col("n") <= 2 * rows_each + 100)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "doc_id"))
    picked = low.select("doc_id", "lang", place.alias("place")).filter(F.col("place") <= rows_each)
    picked = stored(picked.orderBy("place", draw, "doc_id").limit(rows_most))
    texts = labelled.join(F.broadcast(picked), ["doc_id", "lang"]).select("lang", "place", "text")
    found = texts.mapInArrow(_presence(longest), "lang string, place int, held binary").orderBy("place", "lang", "held").limit(rows_most)
    sample = found.toPandas()
    return [np.frombuffer(h, np.uint32).astype(np.int64) for h in sample["held"]], list(sample["lang"])


def train(docs: DataFrame, rows_each: int, rows_most: int, landmarks_each: int, landmarks_most: int, ridge: float, longest: int) -> Model | None:
    """Fit on a sample of the labelled rows."""
    return fit(*_sample(docs, rows_each, rows_most, longest), landmarks_each, landmarks_most, ridge, longest)


def judged(texts: list[str], model: Model | None, presence: Presence | None) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language and score of each text, the share of its n-grams that the model knows, and how many it has."""
    names, scores, shares, sizes = [UNKNOWN] * len(texts), *np.zeros((3, len(texts)))
    lettered = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if model else []
    for start in range(0, len(lettered), 128):
        at = lettered[start : start + 128]
        found, shares[at], sizes[at] = model.decisions([texts[i] for i in at], presence)
        best = found.argmax(1)
        scores[at] = np.clip((1 + found[np.arange(len(at)), best]) / 2, 0, 1)
        for i, b in zip(at, best.tolist(), strict=True):
            names[i] = model.languages[b]
    return names, scores, shares, sizes


def _parts(batches: Iterator[pa.RecordBatch], shared) -> Iterator[tuple]:
    model = shared.value
    presence = Presence(model.longest) if model else None
    for batch in batches:
        for part in chunks(batch, "text"):
            yield part, *judged(texts_of(part), model, presence)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs`` (doc_id, held_out, text) by a fitted model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, scores, _, _ in _parts(batches, shared):
            columns = [part["doc_id"], part["held_out"], pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(score, "doc_id bigint, held_out boolean, lang_pred string, score double")


def _learnable(docs: DataFrame) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return docs.select("doc_id", "text", "lang", held_out.alias("held_out"))


def identified(
    docs: DataFrame,
    rows_each: int = 200,
    rows_most: int = 4000,
    landmarks_each: int = 40,
    landmarks_most: int = 400,
    ridge: float = 1e-4,
    longest: int = 3,
) -> DataFrame:
    """The predicted language of every row of ``docs`` (doc_id, text, lang): ``doc_id, held_out, lang_pred, score``.

    Rows whose crc32 of doc_id, as text, is 2 modulo 4 are held out: they are predicted, never learnt from. Nor are rows
    without doc_id, lang or text; a null doc_id counts as not held out. A prediction sees the text alone. Text that is null or
    has no letter gets ``und`` and score 0, as do all texts if there is nothing to learn from. Equal decisions go to
    the first language in alphabetical order. Repeated rows are predicted each; other columns are not read; an empty table gives
    no rows. The sample is bounded by ``rows_each`` rows a label and ``rows_most`` in all, the landmarks by ``landmarks_each`` and
    ``landmarks_most``.
    """
    known = _learnable(docs)
    model = train(known.filter("NOT held_out"), rows_each, rows_most, landmarks_each, landmarks_most, ridge, longest)
    return predict(known, model)


def with_language(
    docs: DataFrame,
    least: float,
    rows_each: int = 200,
    rows_most: int = 4000,
    landmarks_each: int = 40,
    landmarks_most: int = 400,
    ridge: float = 1e-4,
    longest: int = 3,
    known: float = 0.0,
    short: int = 0,
    clear: float = 0.85,
    enough: int = 50,
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang) whose text gets a language with a score of at least ``least``, all columns as they are.

    Of its n-grams, at least the share ``known`` must be such that a landmark holds. A text of fewer than ``short`` n-grams gives
    the regressions too little to judge by: it stays below ``least`` too if the share is at least ``clear``. These limits are as given
    whatever the table holds. Learnt from the same rows as in ``identified``. Texts that are null or have no letter go; if there are
    fewer than ``enough`` rows to learn from, too few to reject a text by, all others stay.
    """
    held, labels = _sample(_learnable(docs).filter("NOT held_out"), rows_each, rows_most, longest)
    model = fit(held, labels, landmarks_each, landmarks_most, ridge, longest) if len(held) >= enough else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, scores, shares, sizes in _parts(batches, shared):
            if shared.value is None:
                good = [any(map(str.isalpha, t)) for t in texts_of(part)]
            else:
                accepted = (scores >= least) | ((sizes < short) & (shares >= clear))
                good = (np.array(names) != UNKNOWN) & accepted & (shares >= known)
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
