"""Quality score from two zstandard dictionaries (operator 7).

One dictionary is trained on good and one on bad labelled texts. A text is compressed
with each; the normalised difference of the two sizes says which it resembles. A
logistic curve fitted on labelled texts that trained no dictionary turns the difference
into a probability.

Texts are cut into pieces of ``piece`` bytes for the size comparison, each compressed on
its own, so that a text cannot explain itself by its own earlier parts and long texts
are judged like short ones. All pieces of a text count, weighted by their bytes.

Training uses a bounded sample: at most ``per_label`` texts a label (documented
parameter), the lowest by a hash of doc_id, so it is the same on every run, of at most
``longest_text`` bytes each. Inputs of a score are the text alone.

Defined results: null and empty texts score as a text without evidence (difference 0);
without labels of both kinds every text scores ``prior``; null doc_ids are not held out;
equal rows give equal rows; several labels of a doc_id all count; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, size_difference double"


@dataclass(frozen=True)
class Settings:
    per_label: int = 2000
    dictionary_bytes: int = 112_640
    sample_bytes: int = 12_000_000  # of training pieces a label, so that training stays in memory
    piece: int = 128
    longest_text: int = 32_768  # bytes of a training text; scoring has no such bound
    level: int = 3
    threshold: float = 0.3
    folds: int = 5
    held_fold: int = 0
    prior: float = 0.5


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    shift: float
    settings: Settings


def held_out(doc_id: int | None, settings: Settings) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % settings.folds == settings.held_fold


def _pieces(text: str | None, settings: Settings) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[at : at + settings.piece] for at in range(0, len(raw), settings.piece)]


class Comparer:
    def __init__(self, good: bytes, bad: bytes, settings: Settings):
        self.settings = settings
        self.good, self.bad = (self._compressor(d) for d in (good, bad))

    def _compressor(self, raw: bytes) -> zstandard.ZstdCompressor:
        shared = zstandard.ZstdCompressionDict(raw)
        shared.precompute_compress(level=self.settings.level)
        return zstandard.ZstdCompressor(
            level=self.settings.level, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def difference(self, text: str | None) -> float:
        """(size with the bad - size with the good dictionary) / (larger of the two); 0 for no text."""
        good = bad = 0
        for piece in _pieces(text, self.settings):
            good += len(self.good.compress(piece))
            bad += len(self.bad.compress(piece))
        return (bad - good) / max(good, bad) if good else 0.0


def _train_dictionary(texts: list[str], settings: Settings) -> bytes:
    pieces: list[bytes] = []
    total = 0
    for text in texts:
        for piece in _pieces(text, settings):
            pieces.append(piece)
            total += len(piece)
        if total > settings.sample_bytes:
            break
    size = min(settings.dictionary_bytes, max(1024, total // 8))
    try:
        return zstandard.train_dictionary(size, pieces, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too few texts for statistics: their bytes are the dictionary
        return b"".join(pieces)[-settings.dictionary_bytes :] or b"\n"


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps with a slight ridge."""
    scale = max(float(np.std(x)), 1e-9)
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(rows: list[tuple[int, str]], settings: Settings = Settings()) -> Model | None:
    """Model from (label, text) pairs; two thirds train dictionaries, the rest the curve."""
    kinds = {label: [text for found, text in rows if found == label] for label in (0, 1)}
    if not kinds[0] or not kinds[1]:
        return None
    parts = {label: ([t for i, t in enumerate(texts) if i % 3], texts[::3]) for label, texts in kinds.items()}
    trained = {label: _train_dictionary(train or texts, settings) for label, (train, texts) in parts.items()}
    comparer = Comparer(trained[1], trained[0], settings)
    x = np.array([comparer.difference(t) for label in (0, 1) for t in parts[label][1]])
    y = np.array([label for label in (0, 1) for _ in parts[label][1]], dtype=float)
    slope, shift = _fit_logistic(x, y)
    return Model(trained[1], trained[0], slope, shift, settings)


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[tuple[int, str]]:
    """At most ``per_label`` (label, text) pairs a label, none of them held out."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("quality in (0, 1) and doc_id is not null")
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % settings.folds != settings.held_fold)
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    # the lowest ranks of each label, found without texts; a bounded number of rows by the parameter
    chosen = known.where("quality = 0").orderBy(rank, "doc_id").limit(settings.per_label)
    chosen = chosen.unionByName(known.where("quality = 1").orderBy(rank, "doc_id").limit(settings.per_label))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.octet_length("text").between(1, settings.longest_text))
    found = texts.join(F.broadcast(chosen), "doc_id").select("quality", "doc_id", "text")
    # repeated documents of one doc_id must not grow the sample beyond its bound
    rows = found.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "text").limit(2 * settings.per_label)
    return [(r.quality, r.text) for r in rows.collect()]


_comparers: dict[bytes, Comparer] = {}


def _scorer(model: Model | None, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer = None
        if model is not None:
            key = model.good[-64:] + model.bad[-64:]
            if key not in _comparers:
                _comparers.clear()
                _comparers[key] = Comparer(model.good, model.bad, settings)
            comparer = _comparers[key]
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                ids = part.column(0).to_pylist()
                found = [comparer.difference(t) if comparer else 0.0 for t in part.column(1).to_pylist()]
                if model is None:
                    scores = [settings.prior] * len(found)
                else:
                    scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * x + model.shift)))) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([held_out(i, settings) for i in ids], pa.bool_()),
                        pa.array(scores, pa.float64()),
                        pa.array([int(s >= settings.threshold) for s in scores], pa.int32()),
                        pa.array(found, pa.float64()),
                    ],
                    names=["doc_id", "held_out", "score", "predicted", "size_difference"],
                )

    return run


def score(docs: DataFrame, model: Model | None, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, size_difference."""
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_scorer(model, settings), SCHEMA)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return score(docs, fit(training_rows(docs, labels, settings), settings), settings)
