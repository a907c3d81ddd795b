"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good or bad. A line's evidence is a weighted sum of
its own features and those of the line before and the line after it; neighbouring
labels are tied by transition weights. Forward-backward gives the probability
that a line is good, and the mean over lines, weighted by their lengths, is the
quality of the document.

The field is fitted on a bounded sample of labelled documents, in which each line
bears the label of its document, by maximum conditional likelihood with an L2
penalty. Features are shares of character classes, repetition and sizes; no
feature depends on a label, language, source or id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.llm.common import held_out

SAMPLE_DOCS = 6000  # labelled documents a fit may use, by least hash of their id
SAMPLE_LINES = 128  # lines of a document that a fit may use, so at most 43 MB of features reach the driver
SAMPLE_BLOCK = 16  # a longer document gives blocks of so many neighbouring lines, evenly spread
STEPS = 250
PENALTY = 1e-3

# Character classes by UTF-8 byte. The first five are features by their share.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[[ord(c) for c in "#*$%&<>@^~_=+\\/{}[]"]] = 0
_CLASS[ord("|")] = 1
_CLASS[ord("!")] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[ord("A"):ord("Z") + 1] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 6
_ONE_HOT = np.eye(7, dtype=np.float32)
WIDTH = 14


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, line lengths in bytes); at least one line."""
    lines = (text or "").encode("utf-8", "replace").split(b"\n")
    out = np.zeros((len(lines), WIDTH), np.float32)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    seen: set[bytes] = set()
    for k, line in enumerate(lines):
        if not line:
            out[k, 12] = 1.0
            continue
        classes = np.bincount(_CLASS[np.frombuffer(line, np.uint8)], minlength=7)
        words = line.split()
        n = max(len(words), 1)
        distinct = set(words)
        solid = max(len(line) - int(classes[6]), 1)
        row = out[k]
        row[:5] = classes[:5] / solid
        row[5] = len(distinct) / n
        row[6] = math.log1p(n)
        row[7] = solid / n / 10.0
        row[8] = line in seen
        row[9] = sum(map(words[0].__eq__, words)) / n if words else 0.0
        row[10] = sum(a == b for a, b in zip(words, words[1:])) / n
        row[11] = len(words[-1]) > 0 and words[-1][-1:] in b".!?" if words else 0.0
        row[13] = max(0.0, n - len(distinct)) / math.sqrt(n) / 5.0
        seen.add(line)
    return out, sizes


def _window(x: np.ndarray) -> np.ndarray:
    """Own features, the neighbours' and a constant; the ends have zeros for neighbours."""
    zero = np.zeros((1, x.shape[1]), x.dtype)
    return np.hstack([x, np.vstack([zero, x[:-1]]), np.vstack([x[1:], zero]), np.ones((len(x), 1), x.dtype)])


def _forward_backward(u: np.ndarray, starts: np.ndarray, sizes: np.ndarray, trans: np.ndarray):
    """Log odds of good per line and summed pair probabilities, over many chains at once.

    ``u``: evidence for good against bad. Chains are rows ``starts[k]`` to
    ``starts[k] + sizes[k]``, longest first, so those still alive are a prefix.
    """
    step = lambda x: np.logaddexp(trans[1, 1] + x, trans[0, 1]) - np.logaddexp(trans[1, 0] + x, trans[0, 0])
    rstep = lambda x: np.logaddexp(trans[1, 1] + x, trans[1, 0]) - np.logaddexp(trans[0, 1] + x, trans[0, 0])
    into, back = np.zeros_like(u), np.zeros_like(u)  # messages from before and from after
    alive = [int(np.searchsorted(-sizes, -t, "left")) for t in range(int(sizes[0]) if len(sizes) else 0)]
    for t in range(1, len(alive)):
        at = starts[:alive[t]] + t
        into[at] = step(u[at - 1] + into[at - 1])
    for t in range(len(alive) - 1, 0, -1):
        at = starts[:alive[t]] + t
        back[at - 1] = rstep(u[at] + back[at])
    pairs = np.zeros((2, 2))
    second = np.ones(len(u), bool)
    second[starts] = False
    at = np.flatnonzero(second)
    if len(at):
        a, b = u[at - 1] + into[at - 1], u[at] + back[at]
        logs = np.array([[np.full(len(at), trans[0, 0]), trans[0, 1] + b], [trans[1, 0] + a, trans[1, 1] + a + b]])
        logs -= logs.max((0, 1))
        p = np.exp(logs)
        pairs = (p / p.sum((0, 1))).sum(2)
    return u + into + back, pairs


@dataclass(frozen=True)
class LineField:
    """A fitted field: standardised feature weights and transitions."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray

    def line_odds(self, features: np.ndarray) -> np.ndarray:
        """Log odds that each line of one document is good."""
        u = _window((features - self.mean) / self.scale).astype(np.float64) @ self.weights
        return _forward_backward(u, np.array([0]), np.array([len(u)]), self.trans)[0]

    def score(self, text: str | None) -> float:
        features, sizes = line_features(text)
        if len(features) == 1:
            u = float(_window((features - self.mean) / self.scale)[0].astype(np.float64) @ self.weights)
            return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, u))))
        good = 1.0 / (1.0 + np.exp(-np.clip(self.line_odds(features), -30, 30)))
        weight = np.maximum(sizes, 1).astype(np.float64)
        return float(good @ weight / weight.sum())


def fit_field(samples: list[tuple[np.ndarray, int]], steps: int = STEPS, penalty: float = PENALTY) -> LineField:
    """Maximum conditional likelihood of (line features, document label) samples.

    Without samples the field has no evidence and scores 0.5 everywhere. Adam on
    the full gradient; the order of the samples does not matter.
    """
    samples = sorted(samples, key=lambda s: (-len(s[0]), s[1], s[0].tobytes()))
    if not samples:
        return LineField(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), np.zeros(3 * WIDTH + 1), np.zeros((2, 2)))
    flat = np.vstack([x for x, _ in samples])
    mean, scale = flat.mean(0), flat.std(0) + 1e-3
    x = np.vstack([_window((f - mean) / scale) for f, _ in samples]).astype(np.float64)
    sizes = np.array([len(f) for f, _ in samples])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    y = np.repeat([float(label) for _, label in samples], sizes)
    seen = np.zeros((2, 2))
    for (f, label) in samples:
        seen[label, label] += len(f) - 1
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for k in range(1, steps + 1):
        odds, pairs = _forward_backward(x @ w, starts, sizes, trans)
        p = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
        grad = np.concatenate([x.T @ (y - p), (seen - pairs).ravel()]) / len(samples)
        grad -= penalty * np.concatenate([w, trans.ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        move = 0.05 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
        w, trans = w + move[:-4], trans + move[-4:].reshape(2, 2)
    return LineField(mean, scale, w, trans)


def fit_blocks(features: np.ndarray) -> list[np.ndarray]:
    """Chains of lines to fit on: the whole document, or evenly spread blocks of a long one."""
    n, blocks = len(features), SAMPLE_LINES // SAMPLE_BLOCK
    if n <= SAMPLE_LINES:
        return [features]
    starts = [k * (n - SAMPLE_BLOCK) // (blocks - 1) for k in range(blocks)]
    return [features[at:at + SAMPLE_BLOCK] for at in starts]


def fit_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> LineField:
    """Fit on the labelled, not held-out documents with the least id hashes.

    At most ``sample_docs`` labels reach the join (a bounded, so broadcast, side).
    Features are those of whole texts; of a document with more than
    ``SAMPLE_LINES`` lines, blocks from its first to its last line reach the
    driver. Labels other than 0 and 1 and null ids do not count; of several labels
    of an id the least holds. Rows of one id are fitted on as often as they stand.
    """
    chosen = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))) \
        .groupBy(F.col(id_col).alias("__of")).agg(F.min(label_col).cast("int").alias("label")) \
        .orderBy(F.xxhash64("__of"), "__of").limit(sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(block.tobytes(), label.as_py()) for text, label in zip(batch.column(0), batch.column(1))
                    for block in fit_blocks(line_features(text.as_py())[0])]
            yield pa.RecordBatch.from_arrays([
                pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.int32())], ["features", "label"])

    rows = docs.select(F.col(id_col).alias("__of"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__of") \
        .select("text", "label").mapInArrow(run, "features binary, label int").collect()
    return fit_field([(np.frombuffer(r.features, np.float32).reshape(-1, WIDTH), r.label) for r in rows])


def quality_score(text: Column, field: LineField) -> Column:
    """Quality of each text between 0 and 1; null and empty texts are one empty line."""

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([field.score(t.as_py()) for t in batch], pa.float64())

    return run(text)


def good_lines(text: Column, field: LineField) -> Column:
    """Probability of being good for each line of a text."""

    @F.arrow_udf("array<double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([(1 / (1 + np.exp(-np.clip(field.line_odds(line_features(t.as_py())[0]), -30, 30)))).tolist()
                            for t in batch], pa.list_(pa.float64()))

    return run(text)
