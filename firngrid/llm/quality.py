"""Quality scores: random Fourier features, ridge regression and isotonic calibration.

Every whole text becomes a short vector of document statistics. Random cosine
features of the standardised statistics approximate a Gaussian kernel. The ridge fit
needs only the sums Z'Z and Z'y, which each partition makes for itself and Spark adds
up. Its scores are calibrated by isotonic regression on rows that the fit has not
seen, from counts in fixed score bins, so that a score is a share of label 1.

Defined results: null and empty texts have all statistics 0 and are scored as any
other; rows with a null label or null text are not learned from; a document with
several labels counts once for each; with no labelled row, or labels of one value
only, every score is that value's share (0.5 with none); ties get equal scores;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.llm.texts import map_batches

#: Random features, kernel width in standard deviations, ridge weight, score bins.
FEATURES = 384
WIDTH = 6.0
RIDGE = 1e-2
BINS = 200
STATISTICS = (
    "log_chars", "log_words", "log_lines", "mean_word", "var_word", "upper", "lower", "digit",
    "space", "stop_marks", "bangs", "odd_marks", "bars", "beyond_ascii", "distinct_words",
    "top_word", "top_three", "distinct_lines", "mean_line", "run_share", "short_words",
    "marked_words", "pair_repeats", "sentence_words",
)

_CLASS = np.zeros(256, np.int64)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("a") : ord("z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:'\"-"]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6
_CLASS[[ord(c) for c in "#$%&*@^~+=<>_\\/"]] = 7
_CLASS[[ord(c) for c in "|{}[]()"]] = 8
_CLASS[128:] = 9


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS for a whole text."""
    data = (text or "").encode()
    n = len(data)
    words = data.split()
    w = len(words)
    if not w:
        return [0.0] * len(STATISTICS)
    classes = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=10) / n
    lengths = np.fromiter(map(len, words), np.int64, w)
    counts = Counter(words)
    top = counts.most_common(3)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ids = {word: k for k, word in enumerate(counts)}
    order = np.fromiter(map(ids.__getitem__, words), np.int64, w)
    runs = float(np.mean(order[1:] == order[:-1])) if w > 1 else 0.0
    pairs = order[1:] * len(ids) + order[:-1]
    marked = sum(c for word, c in counts.items() if not word[-1:].isalnum() and word[-1] < 128)
    sentences = max(1, len(re.findall(rb"[.!?](?=\s|$)", data)))
    return [
        math.log1p(n), math.log1p(w), math.log1p(len(lines)), float(lengths.mean()),
        float(lengths.std()), float(classes[1]), float(classes[2]), float(classes[3]),
        float(classes[4]), float(classes[5]), float(classes[6]), float(classes[7]),
        float(classes[8]), float(classes[9]), len(counts) / w ** 0.8, top[0][1] / w,
        sum(c for _, c in top) / w, len(set(lines)) / len(lines), math.log1p(n / len(lines)),
        runs, float(np.mean(lengths <= 2)), marked / w,
        1.0 - len(np.unique(pairs)) / len(pairs) if w > 1 else 0.0, math.log1p(w / sentences),
    ]


def profile(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the long columns of ``keep``, ``stats``: the statistics of every whole text."""
    names = ("doc_id", *keep)

    def batch(rows):
        return {**{n: rows[n] for n in names}, "stats": [statistics(t) for t in rows["text"]]}

    schema = "".join(f"{n} long, " for n in names) + "stats array<double>"
    return map_batches(docs.select(*names, "text"), batch, schema)


@dataclass
class QualityModel:
    """Standardisation, random directions, ridge weights and the calibration steps."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    step_at: list[float]
    step_value: list[float]
    seed: int

    def features(self, stats: list[list[float]]) -> np.ndarray:
        """Random cosine features, and a constant."""
        x = (np.array(stats).reshape(-1, len(self.mean)) - self.mean) / self.scale
        x = np.clip(x, -8, 8)
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(size=(len(self.mean), FEATURES)) / WIDTH
        phases = rng.uniform(0, 2 * math.pi, FEATURES)
        z = np.cos(x @ directions + phases) * math.sqrt(2.0 / FEATURES)
        return np.hstack([np.ones((len(z), 1)), z])

    def raw(self, stats: list[list[float]]) -> np.ndarray:
        """Ridge scores."""
        return self.features(stats) @ np.array(self.weights)

    def score(self, stats: list[list[float]]) -> np.ndarray:
        """Calibrated scores, linear between the steps."""
        if not self.weights:
            return np.full(len(stats), self.step_value[0])
        return np.interp(self.raw(stats), self.step_at, self.step_value)


def _sums(labelled: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over ``labelled (stats, label)``; each task sends only its sums on."""
    size = FEATURES + 1

    def part(batches):
        import pyarrow as pa

        total = np.zeros((size, size + 1))
        for b in batches:
            if b.num_rows:
                rows = b.to_pydict()
                z = model.features(rows["stats"])
                total[:, :size] += z.T @ z
                total[:, size] += z.T @ np.array(rows["label"], float)
        yield pa.RecordBatch.from_pydict(
            {"row": list(range(size)), "sums": [r.tolist() for r in total]},
            schema=pa.schema([("row", pa.int64()), ("sums", pa.list_(pa.float64()))]),
        )

    def added(key, frame):
        import pandas as pd

        return pd.DataFrame({"row": [key[0]], "sums": [np.sum(np.stack(frame["sums"]), 0)]})

    parts = labelled.select("stats", "label").mapInArrow(part, "row long, sums array<double>")
    rows = parts.groupBy("row").applyInPandas(added, "row long, sums array<double>").collect()
    if not rows:
        return np.eye(size), np.zeros(size)
    total = np.stack([np.array(r.sums) for r in sorted(rows, key=lambda r: r.row)])
    return total[:, :size], total[:, size]


def isotonic(ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-decreasing shares by pooling neighbours; every entry of ``counts`` is positive."""
    blocks: list[list[float]] = []
    for y, n in zip(ones, counts, strict=True):
        blocks.append([y, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), y / n) for y, n, k in blocks])


def train(labelled: DataFrame, seed: int = 17) -> QualityModel:
    """Fit on ``labelled (stats array<double>, label int, calibrate boolean)``.

    The rows with ``calibrate`` are left out of the ridge fit and set the calibration.
    Without labels of both kinds, or without a row to calibrate by, all texts get the share
    of label 1 (0.5 without any label).
    """
    rows = labelled.where("label is not null and stats is not null")
    width = len(STATISTICS)
    moments = [f(F.col("stats")[k]) for k in range(width) for f in (F.avg, F.stddev_pop)]
    label = F.col("label").cast("double")
    n, share, *found = rows.agg(F.count("*"), F.avg(label), *moments).first()
    mean, scale = [x or 0.0 for x in found[0::2]], [x or 1.0 for x in found[1::2]]
    model = QualityModel(mean, scale, [], [0.0], [0.5 if share is None else share], seed)
    if not n or share in (0.0, 1.0):
        return model
    gram, right = _sums(rows.where("not calibrate"), model)
    weight = RIDGE * max(1.0, gram[0, 0])
    ridge = weight / FEATURES * np.diag([0.0] + [1.0] * FEATURES) + 1e-9 * np.eye(FEATURES + 1)
    fitted = QualityModel(mean, scale, np.linalg.solve(gram + ridge, right).tolist(), [], [], seed)

    def binned(batch):
        raw = np.clip((fitted.raw(batch["stats"]) + 0.5) / 2.0, 0, 1 - 1e-9)
        return {"bin": (raw * BINS).astype(int).tolist(), "label": batch["label"]}

    scored = map_batches(
        rows.where("calibrate").select("stats", F.col("label").cast("long").alias("label")),
        binned,
        "bin long, label long",
    )
    counted = scored.groupBy("bin").agg(F.sum("label").alias("ones"), F.count("*").alias("n"))
    bins = sorted((r.bin, r.ones, r.n) for r in counted.collect())
    if not bins:
        return model
    at = [(b + 0.5) / BINS * 2.0 - 0.5 for b, _, _ in bins]
    values = isotonic(np.array([b[1] for b in bins], float), np.array([b[2] for b in bins], float))
    return QualityModel(mean, scale, fitted.weights, at, values.tolist(), seed)


def score(profiled: DataFrame, model: QualityModel, *keep: str) -> DataFrame:
    """``doc_id``, the long columns of ``keep``, ``score`` for every row of ``profiled``."""
    names = ("doc_id", *keep)

    def batch(rows):
        return {**{n: rows[n] for n in names}, "score": model.score(rows["stats"]).tolist()}

    schema = "".join(f"{n} long, " for n in names) + "score double"
    return map_batches(profiled.select(*names, "stats"), batch, schema)
