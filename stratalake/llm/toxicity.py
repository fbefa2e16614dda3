"""Toxicity by a bidirectional gated recurrent network with attention, in numpy.

A word enters as two parts: an embedding of the whole word and the pooled embeddings of its character n-grams.
Both are hashed, so there is no vocabulary to grow. Documents are read in overlapping windows of words; every
window is scored, and the highest score, calibrated, is the document's.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from stratalake.llm.common import id_and_text, texts_of
from stratalake.llm.labelled import sample, share_of_ones

#: Labelled rows per class that the network is fitted on, and characters of each: all.
PER_CLASS = 1500
MAX_CHARS = None
WINDOW, STRIDE = 48, 32
HIDDEN, WIDTH = 12, 12
WORD_ROWS, GRAM_ROWS = 1 << 13, 1 << 15
GRAMS = (4, 5)
LONGEST_WORD = 40
EDGE = b".,;:!?\"'()[]{}<>*_-"
STEPS, BATCH, RATE = 420, 64, 0.01
#: Share of a batch that is clean, and share of its clean windows that are the highest of their document.
CLEAN_SHARE, HARD_SHARE = 0.6, 0.34
#: Share of each class that is taken for mislabelled once the network has a first opinion, and no longer fitted on.
DOUBTED = {0: 0.02, 1: 0.06}
REMEMBERED = 300_000


@dataclass
class Network:
    """Weights by name. ``constant`` replaces the network where there was nothing to learn from."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def _initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {"word": rng.normal(0, 0.1, (WORD_ROWS, WIDTH)), "gram": rng.normal(0, 0.1, (GRAM_ROWS, WIDTH))}
    for side in ("f", "b"):
        w[f"in_{side}"] = rng.normal(0, 0.3, (2 * WIDTH, 3 * HIDDEN))
        w[f"bias_{side}"] = np.zeros(3 * HIDDEN)
        w[f"rec_{side}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
    w["attend"] = rng.normal(0, 0.3, 2 * HIDDEN)
    w["out"] = rng.normal(0, 0.3, 2 * HIDDEN)
    w["out_bias"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in w.items()}


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words between white space; longer ones are cut, so a text without blanks is read as well."""
    words = text.decode().lower().encode().split()
    if words and max(map(len, words)) > LONGEST_WORD:
        words = [x[i : i + LONGEST_WORD] for x in words for i in range(0, len(x), LONGEST_WORD)]
    return words


def hashed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word, rows of all character n-grams, and the word each n-gram belongs to."""
    marked = [b"\x02" + w.strip(EDGE) + b"\x03" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    starts = np.cumsum(sizes) - sizes
    codes = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - starts[owner]
    powers = np.cumprod(np.full(LONGEST_WORD + 3, 0x100000001B3, np.uint64))
    whole = np.add.reduceat(codes * powers[place], starts)
    rows, owners = [], []
    for n in GRAMS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + codes[k : len(codes) - n + 1 + k]
        inside = place[: len(h)] + n <= sizes[owner[: len(h)]]
        rows.append(_row(h[inside], GRAM_ROWS))
        owners.append(owner[: len(h)][inside])
    none = np.zeros(0, np.int64)
    return _row(whole, WORD_ROWS), np.concatenate([none, *rows]), np.concatenate([none, *owners])


def _row(h: np.ndarray, rows: int) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - rows.bit_length() + 1)).astype(np.int64)


def _inputs(w: dict[str, np.ndarray], words: list[bytes]) -> tuple[np.ndarray, tuple]:
    """Word part and character part of each word, and what the way back needs."""
    whole, grams, owner = hashed(words)
    count = np.bincount(owner, minlength=len(words)).astype(np.float32)
    weight = 1 / np.sqrt(np.maximum(count, 1))
    pooled = np.zeros((len(words), WIDTH), np.float32)
    if len(grams):
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        pooled[owner[first]] = np.add.reduceat(w["gram"][grams], first, axis=0)
    x = np.hstack([w["word"][whole], pooled * weight[:, None]])
    return x, (whole, grams, owner, weight)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _read(table: np.ndarray, rec: np.ndarray, at: np.ndarray, there: np.ndarray, keep: list | None) -> np.ndarray:
    """States (time, window, hidden) of one direction; ``at`` has rows of ``table`` by time and window."""
    steps, n = at.shape
    state = np.zeros((n, HIDDEN), np.float32)
    states = np.empty((steps, n, HIDDEN), np.float32)
    for t in range(steps):
        x, u = table[at[t]], state @ rec
        gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
        after = new + z * (state - new)
        after = np.where(there[t][:, None], after, state)
        if keep is not None:
            keep.append((state, r, z, new, u[:, 2 * HIDDEN :]))
        states[t] = state = after
    return states


def _states(table: np.ndarray, rec: np.ndarray, at: np.ndarray, back: bool) -> np.ndarray:
    """As :func:`_read`, for windows without gaps and without a way back: works in place."""
    steps, n = at.shape
    states, rec = np.empty((steps, HIDDEN, n), np.float32), np.ascontiguousarray(rec.T)
    x, u, state = np.empty((n, 3 * HIDDEN), np.float32), np.empty((3 * HIDDEN, n), np.float32), np.zeros((HIDDEN, n), np.float32)
    gates, new = u[: 2 * HIDDEN], u[2 * HIDDEN :]
    for t in range(steps - 1, -1, -1) if back else range(steps):
        np.take(table, at[t], axis=0, out=x, mode="clip")
        np.matmul(rec, state, out=u)
        gates += x.T[: 2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        new *= gates[:HIDDEN]
        new += x.T[2 * HIDDEN :]
        np.tanh(new, out=new)
        after = states[t]
        np.subtract(state, new, out=after)
        after *= gates[HIDDEN:]
        after += new
        state = after
    return states


def _logits(w: dict[str, np.ndarray], tables: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """Logits of windows without gaps."""
    ahead, back = _states(tables[0], w["rec_f"], at, False), _states(tables[1], w["rec_b"], at, True)
    share = w["attend"][:HIDDEN] @ ahead + w["attend"][HIDDEN:] @ back
    share -= share.max(axis=0)
    np.exp(share, out=share)
    share /= share.sum(axis=0)
    told = w["out"][:HIDDEN] @ ahead + w["out"][HIDDEN:] @ back
    return (share * told).sum(axis=0) + w["out_bias"][0]


def _forward(w: dict[str, np.ndarray], tables: list[np.ndarray], at: np.ndarray, there: np.ndarray, keep: tuple | None = None) -> tuple[np.ndarray, tuple]:
    ahead = _read(tables[0], w["rec_f"], at, there, keep[0] if keep else None)
    back = _read(tables[1], w["rec_b"], at[::-1], there[::-1], keep[1] if keep else None)[::-1]
    both = np.concatenate([ahead, back], axis=2)
    energy = np.where(there, both @ w["attend"], -1e9)
    share = np.exp(energy - energy.max(axis=0))
    share /= share.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", share, both)
    return pooled @ w["out"] + w["out_bias"][0], (both, share, pooled)


def _tables(w: dict[str, np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    return [x @ w[f"in_{s}"] + w[f"bias_{s}"] for s in ("f", "b")]


def _slopes(w: dict[str, np.ndarray], x: np.ndarray, at: np.ndarray, there: np.ndarray, y: np.ndarray, each: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Slopes of the weighted log loss for all weights but the embeddings, and for the words' inputs ``x``."""
    tables, keep = _tables(w, x), ([], [])
    logit, (both, share, pooled) = _forward(w, tables, at, there, keep)
    d_logit = ((_sigmoid(logit) - y) * each / len(y)).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "out_bias": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * w["out"]
    d_share = np.einsum("tnh,nh->tn", both, d_pooled)
    d_energy = share * (d_share - (share * d_share).sum(axis=0))
    g["attend"] = np.einsum("tn,tnh->h", d_energy, both)
    d_both = share[:, :, None] * d_pooled + d_energy[:, :, None] * w["attend"]
    d_x = np.zeros_like(x)
    for k, side in enumerate(("f", "b")):
        rows, here = (at, there) if side == "f" else (at[::-1], there[::-1])
        d_states = d_both[:, :, :HIDDEN] if side == "f" else d_both[::-1, :, HIDDEN:]
        d_table, d_rec, d_state = np.zeros_like(tables[k]), np.zeros_like(w[f"rec_{side}"]), np.zeros((at.shape[1], HIDDEN), np.float32)
        for t in range(len(rows) - 1, -1, -1):
            state, r, z, new, u = keep[k][t]
            d_after = d_state + d_states[t]
            live = d_after * here[t][:, None]
            d_new = live * (1 - z) * (1 - new * new)
            d_z = live * (state - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            d_in = np.hstack([d_r, d_z, d_new])
            d_u = np.hstack([d_r, d_z, d_new * r])
            np.add.at(d_table, rows[t], d_in)
            d_rec += state.T @ d_u
            d_state = (d_after - live) + live * z + d_u @ w[f"rec_{side}"].T
        g[f"rec_{side}"], g[f"in_{side}"], g[f"bias_{side}"] = d_rec, x.T @ d_table, d_table.sum(axis=0)
        d_x += d_table @ w[f"in_{side}"].T
    return g, d_x


def _grid(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows by time and window, and where there is a word."""
    steps = max(len(x) for x in windows)
    at, there = np.zeros((steps, len(windows)), np.int64), np.zeros((steps, len(windows)), bool)
    for n, x in enumerate(windows):
        at[: len(x), n], there[: len(x), n] = x, True
    return at, there


def cut(words: list) -> list:
    """Overlapping windows that together hold every word; the last one ends with the text."""
    if len(words) <= WINDOW:
        return [words]
    return [words[i : i + WINDOW] for i in [*range(0, len(words) - WINDOW, STRIDE), len(words) - WINDOW]]


def train(texts: dict[int, list[str]], steps: int = STEPS, seed: int = 11) -> Network:
    """Fit on documents with label 0 and 1; a window takes its document's label.

    After a third of the steps, toxic documents are represented by their highest window only, since most windows
    of a long toxic document need not be toxic, and clean ones by their highest window now and then, since that one
    decides their score. From then on the documents that contradict their label most, toxic ones whose highest
    window is among the lowest and clean ones whose highest is among the highest, are left out as mislabelled.
    Without rows of both classes the score is their share of 1.
    """
    if min(len(texts[0]), len(texts[1])) < 4:
        return Network(constant=share_of_ones(texts))
    rng = np.random.default_rng(seed)
    known: dict[bytes, int] = {}
    docs: dict[int, list[list[np.ndarray]]] = {0: [], 1: []}
    for label, found in texts.items():
        for t in found:
            rows = np.array([known.setdefault(x, len(known)) for x in words_of(t.encode())], np.int64)
            if len(rows):
                docs[label].append(cut(rows))
    if min(len(docs[0]), len(docs[1])) < 4:
        return Network(constant=share_of_ones(texts))
    vocabulary = list(known)
    w = _initial()
    held_back = {c: max(1, len(docs[c]) // 5) for c in docs}
    fit = {c: docs[c][held_back[c] :] for c in docs}
    one, two = ({k: np.zeros_like(v) for k, v in w.items() if k not in ("word", "gram")} for _ in range(2))
    sums = {"word": np.full(WORD_ROWS, 1e-4, np.float32), "gram": np.full(GRAM_ROWS, 1e-4, np.float32)}
    highest: dict[int, list[int]] | None = None
    trusted = {c: np.arange(len(fit[c])) for c in fit}
    for step in range(1, steps + 1):
        if step in (steps // 3, 2 * steps // 3):
            found = {c: _score_known(w, vocabulary, fit[c]) for c in fit}
            highest = {c: [int(np.argmax(s)) for s in found[c]] for c in fit}
            trusted = {c: _trusted(np.array([s.max() for s in found[c]]), c) for c in fit}
        windows, y = [], np.zeros(BATCH)
        for n in range(BATCH):
            label = int(n >= BATCH * CLEAN_SHARE)
            k = int(trusted[label][rng.integers(len(trusted[label]))])
            of = fit[label][k]
            at_highest = highest is not None and (label or rng.random() < HARD_SHARE)
            windows.append(of[highest[label][k]] if at_highest else of[int(rng.integers(len(of)))])
            y[n] = label
        used, at = np.unique(np.concatenate(windows), return_inverse=True)
        ends = np.cumsum([len(x) for x in windows])
        at, there = _grid(np.split(at, ends[:-1]))
        x, (whole, grams, owner, weight) = _inputs(w, [vocabulary[i] for i in used])
        g, d_x = _slopes(w, x, at, there, y, np.ones(BATCH))
        for k, slope in g.items():
            one[k] = 0.9 * one[k] + 0.1 * slope
            two[k] = 0.999 * two[k] + 0.001 * slope * slope
            w[k] -= RATE * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
        for name, rows, slope in (("word", whole, d_x[:, :WIDTH]), ("gram", grams, (d_x[:, WIDTH:] * weight[:, None])[owner])):
            touched, back = np.unique(rows, return_inverse=True)
            total = np.zeros((len(touched), WIDTH), np.float32)
            np.add.at(total, back, slope)
            sums[name][touched] += (total * total).mean(axis=1)
            w[name][touched] -= 0.1 * total / np.sqrt(sums[name][touched])[:, None]
    # Calibration on documents that the network has not seen, by their highest window.
    tops = {c: np.array([s.max() for s in _score_known(w, vocabulary, docs[c][: held_back[c]])]) for c in docs}
    slope, offset = _calibrate(tops[0], tops[1])
    return Network(w, slope, offset)


def _trusted(tops: np.ndarray, label: int) -> np.ndarray:
    """Places of the documents whose highest logits do not contradict their label the most."""
    if label:
        return np.flatnonzero(tops >= np.quantile(tops, DOUBTED[1]))
    return np.flatnonzero(tops <= np.quantile(tops, 1 - DOUBTED[0]))


def _score_known(w: dict[str, np.ndarray], vocabulary: list[bytes], docs: list[list[np.ndarray]]) -> list[np.ndarray]:
    tables = _tables(w, _inputs(w, vocabulary)[0])
    flat = [x for d in docs for x in d]
    logits = np.concatenate([_forward(w, tables, *_grid(flat[i : i + 2048]))[0] for i in range(0, len(flat), 2048)])
    return np.split(logits, np.cumsum([len(d) for d in docs])[:-1])


def _calibrate(clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over highest logits, both classes of equal weight; slope above zero.

    The middle is that of the thresholds with about the fewest errors, clean documents counting four times: the
    very best one alone would hang on a few documents.
    """
    both = np.sort(np.concatenate([clean, toxic]))
    borders = (both[1:] + both[:-1]) / 2
    wrong = [4 * (clean >= b).mean() + (toxic < b).mean() for b in borders]
    least = min(wrong)
    fine = borders[[i for i, x in enumerate(wrong) if x <= least + 0.02]]
    middle = float((fine.min() + fine.max()) / 2)
    spread = float(np.std(both)) or 1.0
    return 4 / spread, -4 / spread * middle


class Scorer:
    """Scores documents with one network; words met before keep their inputs, up to a bound."""

    CHUNK = 1024

    def __init__(self, network: Network) -> None:
        self.net, self.w = network, network.weights
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.tables = [np.zeros((REMEMBERED, 3 * HIDDEN), np.float32) for _ in range(2)]

    def _look_up(self, words: list[list[bytes]]) -> list[np.ndarray]:
        every = set().union(*words)
        new = [x for x in every if x not in self.rows]
        if len(self.rows) + len(new) > REMEMBERED:
            self._forget()
            new = list(every)
        at = len(self.rows)
        if at + len(new) > len(self.tables[0]):
            self.tables = [np.zeros((at + len(new), 3 * HIDDEN), np.float32) for _ in range(2)]
        for i in range(0, len(new), 1 << 14):
            part = new[i : i + (1 << 14)]
            for table, values in zip(self.tables, _tables(self.w, _inputs(self.w, part)[0])):
                table[at + i : at + i + len(part)] = values
        self.rows.update(zip(new, range(at, at + len(new))))
        return [np.fromiter(map(self.rows.__getitem__, text), np.int32, len(text)) for text in words]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        top = np.full(len(texts), -np.inf)
        short, long = [], []
        for n, words in enumerate(self._look_up([words_of(t) for t in texts])):
            if len(words) > WINDOW:
                starts = np.append(np.arange(0, len(words) - WINDOW, STRIDE), len(words) - WINDOW)
                long.append((np.full(len(starts), n), words[starts[:, None] + np.arange(WINDOW)]))
            elif len(words):
                short.append((n, words))
        if long:
            owner, grid = np.concatenate([o for o, _ in long]), np.concatenate([g for _, g in long])
            for i in range(0, len(owner), self.CHUNK):
                at = np.ascontiguousarray(grid[i : i + self.CHUNK].T)
                np.maximum.at(top, owner[i : i + self.CHUNK], _logits(self.w, self.tables, at))
        short.sort(key=lambda s: len(s[1]))
        for i in range(0, len(short), 512):
            part = short[i : i + 512]
            top[[n for n, _ in part]] = _forward(self.w, self.tables, *_grid([x for _, x in part]))[0]
        calibrated = _sigmoid(np.clip(self.net.slope * top + self.net.offset, -500, 500))
        return np.where(np.isfinite(top), calibrated, 0.0)  # a text without words is not toxic


_at_hand: dict[str, Scorer] = {}


def _scorer(network: Network) -> Scorer:
    """The scorer of the worker process, which meets the same words in its next task."""
    if network.name not in _at_hand:
        _at_hand.clear()
        _at_hand[network.name] = Scorer(network)
    return _at_hand[network.name]


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS, steps: int = STEPS) -> Network:
    """Train on at most ``per_class`` labelled rows of each class, whole texts."""
    return train(sample(docs, labels, label_col, allowed, per_class, MAX_CHARS, id_col, text_col), steps)


def _run(network: Network, batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    scorer = _scorer(network)
    for b in batches:
        for at in range(0, b.num_rows, rows):
            part = b.slice(at, rows)
            yield part, scorer.scores(list(texts_of(part.column(part.num_columns - 1))))


def score(df: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row: 0 to 1, higher where label 1 is likelier.

    All overlapping windows of the whole text are scored. Texts that are null or without words score 0. Null ids
    stay null, repeated rows are repeated, an empty table gives an empty one.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _run(network, batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], schema=schema)

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def drop_toxic(df: DataFrame, network: Network, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that score below ``threshold``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(network)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield part.filter(pa.array(scorer.scores(list(texts_of(part.column(text_col)))) < threshold))

    return df.mapInArrow(run, df.schema)
