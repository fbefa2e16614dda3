"""Quality from how well a text compresses with dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame

from stratalake.llm.common import id_and_text, texts_of
from stratalake.llm.labelled import sample, share_of_ones

#: Labelled rows per class that the dictionaries and the calibration are fitted on, and characters of each: all.
PER_CLASS = 3000
MAX_CHARS = None
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Texts are compressed in pieces of this many bytes, so that the dictionary matters all the way through.
PIECE_BYTES = 1024


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries as bytes, and the calibration: centre, scale and weight per feature, last weight the offset."""

    good: bytes
    bad: bytes
    trained: bool
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    constant: float | None = None

    def features(self) -> "Features":
        return Features(self)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        return _sigmoid(((rows - np.array(self.centre)) / np.array(self.scale)) @ np.array(self.weights[:-1]) + self.weights[-1])


class Features:
    def __init__(self, model: QualityModel) -> None:
        kind = zstandard.DICT_TYPE_AUTO if model.trained else zstandard.DICT_TYPE_RAWCONTENT
        self.with_dictionary = []
        for data in (model.good, model.bad):
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
            dictionary.precompute_compress(level=LEVEL)
            self.with_dictionary.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
        self.plain = zstandard.ZstdCompressor(level=LEVEL)

    def of(self, text: bytes) -> tuple[float, float, float, float]:
        """Normalised size difference over the whole text, its least value in a piece, plain ratio, log size."""
        pieces = [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)] or [b""]
        good, bad = ([len(c.compress(p)) for p in pieces] for c in self.with_dictionary)
        whole = (sum(bad) - sum(good)) / max(sum(bad), sum(good))
        least = min((b - g) / max(b, g) for g, b in zip(good, bad))
        return whole, least, self._plain_size(text) / (len(text) + 16), float(np.log1p(len(text)))

    def _plain_size(self, text: bytes) -> int:
        return len(self.plain.compress(text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logistic(x: np.ndarray, y: np.ndarray, prior: float, penalty: float = 1e-2) -> np.ndarray:
    """Newton steps for a logistic model with both classes of weight by ``prior``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    each = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum())) * len(y)
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    for _ in range(40):
        p = _sigmoid(x @ w)
        slope = x.T @ (each * (p - y)) / len(y) + ridge @ w
        curve = (x * (each * p * (1 - p))[:, None]).T @ x / len(y) + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return w


def _dictionary(texts: list[bytes]) -> tuple[bytes, bool]:
    """Trained dictionary, or the plain text where there is too little to train one."""
    samples = [t[i : i + PIECE_BYTES] for t in texts for i in range(0, len(t), PIECE_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(texts)[-DICTIONARY_BYTES:], False


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> QualityModel:
    """Fit on a sample of at most ``per_class`` labelled rows of each class.

    Half of the rows make the dictionaries, the other half the calibration. Without rows of both classes the
    score is the share of label 1 among them, 0.5 if there are none.
    """
    return fit_texts(sample(docs, labels, label_col, allowed, per_class, MAX_CHARS, id_col, text_col))


def fit_texts(texts: dict[int, list[str]]) -> QualityModel:
    if min(len(texts[0]), len(texts[1])) < 4:
        return QualityModel(b"", b"", False, constant=share_of_ones(texts))
    raw = {c: [t.encode() for t in texts[c]] for c in texts}
    good, bad = _dictionary(raw[1][::2]), _dictionary(raw[0][::2])
    if not (good[1] and bad[1]):
        good, bad = ((b"".join(raw[c][::2])[-DICTIONARY_BYTES:], False) for c in (1, 0))
    model = QualityModel(good[0], bad[0], good[1])
    features = model.features()
    x = np.array([features.of(t) for c in (0, 1) for t in raw[c][1::2]])
    y = np.array([c for c in (0, 1) for _ in raw[c][1::2]])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    weights = _logistic((x - centre) / scale, y, prior=0.5)
    return QualityModel(good[0], bad[0], good[1], tuple(centre), tuple(scale), tuple(weights))


def score(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row: 0 to 1, higher where label 1 is likelier.

    Whole texts are scored, whatever their length; a null text counts as empty, and an empty text has a score of
    its own from the calibration. Null ids stay null, repeated rows are repeated.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = model.features() if model.constant is None else None
        for b in batches:
            rows = np.array([features.of(t) if features else (0.0,) for t in texts_of(b.column(1))]).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(rows), pa.float64())], schema=schema)

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")
