"""Quality rules: text figures, fixed base rules and a calibrated hashed n-gram classifier.

The classifier is a logistic regression over hashed word 1- and 2-grams and
character 4-grams. It is fitted on at most ``sample`` labelled rows (a
documented bound, taken in hash order of doc_id by kind of row), probability-calibrated on
the part held out of the fit, and scored in Arrow batches.

Toxic documents are rejected here, and so in the pipeline by its first stage:
a second logistic regression on the same labelled rows is fitted to
``toxic``. A few words tell those, so it sees which of the hashed words and
character 4-grams occur in a text, and only those whose shares of toxic and
other texts differ by ``_TELLING`` standard errors. ``probability`` is that of a text of
good quality times that of one that isn't toxic. Labels without a ``toxic`` column,
or with a null in it, count as not toxic; with too few toxic rows nothing is
rejected as toxic.

Defined results: a null or empty text has zero figures and fails the base
rules (fewer than 50 words); without labels of both kinds the classifier
keeps everything that passes the base rules; repeated rows get one row each, and rows that
share a doc_id are scored each by its own text (labelled ones are all fitted with its label);
texts of any length are taken whole; doc_ids of any type; an empty table gives no
rows; further columns of the input are carried through, and those that clash
with an output name are replaced (a ``prefix`` to those names avoids it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.llm.words import Words, covered, mix64, multipliers, segment_hashes, slices, window_hashes, windows_in_rows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
SAMPLE = 2400
_BITS = 17
_CHARS = 4
_SCALE = 8.0
_TELLING = 5.0
_ROWS = 128
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(mask: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[rows])


def _keyed(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix64(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _dup_lines(w: Words) -> np.ndarray:
    newline = np.flatnonzero(w.raw == 10)
    n_rows = len(w.rows) - 1
    starts = np.sort(np.concatenate([w.rows[:-1], newline + 1]))
    ends = np.sort(np.concatenate([newline, w.rows[1:]]))
    row = np.sort(np.concatenate([np.arange(n_rows), np.searchsorted(w.rows, newline, "right") - 1]))
    worded = np.searchsorted(w.starts, starts) < np.searchsorted(w.starts, ends)
    starts, ends, row = starts[worded], ends[worded], row[worded]
    _, first = np.unique(_keyed(segment_hashes(w.raw, starts, ends, 2), row), return_index=True)
    return np.bincount(row, minlength=n_rows) - np.bincount(row[first], minlength=n_rows)


def figures(w: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The five figures of each row."""
    row = w.row_of_word()
    starts = windows_in_rows(w.at, 3)
    keys = _keyed(window_hashes(hashes, 3, 3)[starts], row[starts])
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = covered(starts[times[which] > 1], 3, len(row))
    inside = np.zeros(len(w.raw) + 1, np.int64)
    np.add.at(inside, w.starts, 1)
    np.add.at(inside, w.ends, -1)
    in_word = np.cumsum(inside[:-1]) > 0
    return {
        "n_words": w.counts,
        "word_chars": _per_row(in_word & ((w.raw & 0xC0) != 0x80), w.rows),
        "n_symbols": _per_row(_SYMBOL[w.raw], w.rows),
        "n_dup_lines": _dup_lines(w),
        "n_repeat_words": np.bincount(row[repeated], minlength=len(w.at) - 1),
    }


def base_failed(fig: dict[str, np.ndarray]) -> np.ndarray:
    return (fig["n_words"] < MIN_WORDS) | (100 * fig["n_repeat_words"] > MAX_REPEAT_PERCENT * fig["n_words"])


def _features(w: Words, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Blocks of hashed features: the index of each occurrence, its row, and where the block's weights begin."""
    shift = np.uint64(64 - _BITS)
    row = w.row_of_word()
    yield (hashes >> shift).astype(np.int64), row, 0
    pairs = windows_in_rows(w.at, 2)
    yield (window_hashes(hashes, 2, 4)[pairs] >> shift).astype(np.int64), row[pairs], 1 << _BITS
    points = np.frombuffer(w.raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((w.raw & 0xC0) != 0x80)])
    at = lead[w.rows]
    n = len(points) - _CHARS + 1
    if n <= 0:
        return
    mixed = np.zeros(n, np.uint64)
    for k, factor in enumerate(multipliers(_CHARS, 5)):
        mixed += (points[k : k + n].astype(np.uint64) + np.uint64(1)) * factor
    char_row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = char_row[:n] == char_row[_CHARS - 1 :]
    index = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD) >> shift).astype(np.int64)
    yield index[whole], char_row[:n][whole], 2 << _BITS


@dataclass
class Classifier:
    """Weights of three hashed blocks; ``slope`` and ``offset`` calibrate the score into a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    presence: Classifier | None = None

    def probability(self, w: Words, hashes: np.ndarray) -> np.ndarray:
        n_rows = len(w.at) - 1
        score = np.full(n_rows, self.bias)
        for index, row, begin in _features(w, hashes):
            total = np.bincount(row, self.weights[begin : begin + (1 << _BITS)][index], n_rows)
            score += _SCALE * total / np.maximum(np.bincount(row, minlength=n_rows), 1)
        p = 1 / (1 + np.exp(-(self.slope * score + self.offset)))
        return p if self.presence is None else p * self.presence.probability_of_presence(w, hashes)

    def probability_of_presence(self, w: Words, hashes: np.ndarray) -> np.ndarray:
        """As ``probability``, of a classifier to which a feature counts once a text; few features have weights."""
        n_rows = len(w.at) - 1
        score = np.full(n_rows, self.bias)
        for index, row, begin in _features(w, hashes):
            has = self.weights[begin + index] != 0
            cell = np.unique(row[has] * (1 << _BITS) + index[has])
            score += np.bincount(cell >> _BITS, self.weights[begin + (cell & ((1 << _BITS) - 1))], n_rows)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -700, 700)))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text", 1 << 20):
        w = Words.of(piece.column("text"))
        parts = []
        for index, row, begin in _features(w, w.hashes()):
            n = np.maximum(np.bincount(row, minlength=piece.num_rows), 1)
            cell, times = np.unique(row * (4 << _BITS) + begin + index, return_counts=True)
            parts.append((cell, _SCALE * times / n[cell // (4 << _BITS)]))
        cells, values = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.argsort(cells, kind="stable")
        ends = np.searchsorted(cells[order] // (4 << _BITS), np.arange(piece.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                piece.column("label"),
                pa.ListArray.from_arrays(pa.array(ends), pa.array((cells[order] % (4 << _BITS)).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order].astype(np.float32))),
            ],
            names=["doc_id", "label", "cells", "weights"],
        )


def _blocks(ends: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Blocks of rows, their cells, and how many each row has: what is worked out at once stays small."""
    for a in range(0, len(ends) - 1, _ROWS):
        b = min(a + _ROWS, len(ends) - 1)
        yield slice(a, b), slice(int(ends[a]), int(ends[b])), np.diff(ends[a : b + 1])


def _scores(cells: np.ndarray, values: np.ndarray, ends: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The sum of each row's values times their cells' weights."""
    out = np.zeros(len(ends) - 1)
    for rows, own, n in _blocks(ends):
        total = np.concatenate([[0.0], np.cumsum(values[own] * w[cells[own]], dtype=float)])
        out[rows] = np.diff(total[np.concatenate([[0], np.cumsum(n)])])
    return out


def _totals(cells: np.ndarray, values: np.ndarray, ends: np.ndarray, by_row: np.ndarray, size: int) -> np.ndarray:
    """The sum over each cell of its values times what their rows have."""
    out = np.zeros(size)
    for rows, own, n in _blocks(ends):
        out += np.bincount(cells[own], values[own] * np.repeat(by_row[rows], n), size)
    return out


def _descend(cells: np.ndarray, values: np.ndarray, ends: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """Adam on the regularised logistic loss of all rows."""
    seen = np.zeros(3 << _BITS, bool)
    seen[cells] = True
    used, number = np.flatnonzero(seen), np.cumsum(seen, dtype=np.int32) - 1
    at = number[cells]
    w, m, v = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    b = mb = vb = 0.0
    for step in range(1, epochs + 1):
        p = 1 / (1 + np.exp(-(_scores(at, values, ends, w) + b)))
        error = (p - y) * weight / weight.sum()
        g, gb = _totals(at, values, ends, error, len(used)) + 1e-5 * w, error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.1 / (1 - 0.9**step)
        w -= rate * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b -= rate * mb / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    full = np.zeros(3 << _BITS, np.float32)
    full[used] = w
    return full, b


def _calibrate(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid by Newton steps with smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([score, np.ones_like(score)])
    a = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ x, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (weight * (p - target)))
        a = a - np.clip(step, -2, 2)
    return float(a[0]), float(a[1])


def _fit_presence(cells: np.ndarray, ends: np.ndarray, toxic: np.ndarray, weight: np.ndarray, cut: int, epochs: int) -> Classifier | None:
    """The classifier of texts that aren't toxic, fitted on the rows before ``cut`` and calibrated on the others."""
    parts = toxic[:cut], toxic[cut:]
    if min(n for y in parts for n in (y.sum(), len(y) - y.sum())) < 2:
        return None
    ones = np.ones(len(cells), np.float32)
    bad = _totals(cells, ones, ends[: cut + 1], parts[0], 3 << _BITS) / parts[0].sum()
    good = _totals(cells, ones, ends[: cut + 1], 1 - parts[0], 3 << _BITS) / (cut - parts[0].sum())
    share = (bad * parts[0].sum() + good * (cut - parts[0].sum())) / cut
    error = np.sqrt(share * (1 - share) * (1 / parts[0].sum() + 1 / (cut - parts[0].sum())))
    telling = np.abs(bad - good) > _TELLING * error
    telling[1 << _BITS : 2 << _BITS] = False  # pairs of words are too rare
    own = telling[cells]
    if not own[: ends[cut]].any():
        return None
    ends = np.concatenate([[0], np.cumsum(own, dtype=np.int64)])[ends]
    cells = cells[own]
    ones = np.ones(len(cells), np.float32)
    weights, bias = _descend(cells[: ends[cut]], ones[: ends[cut]], ends[: cut + 1], 1 - parts[0], weight[:cut], epochs)
    score = _scores(cells, ones, ends, weights) + bias
    slope, offset = _calibrate(score[cut:], 1 - parts[1], weight[cut:])
    return Classifier(weights, bias, slope, offset)


def _fitted(rows: pa.Table, several: dict[int, int], epochs: int) -> Classifier | None:
    """The classifier of labelled sparse rows in the order of ``at``, weighted by their kind's share of ``several``."""
    rows = rows.take(np.argsort(rows.column("at").to_numpy(), kind="stable"))
    labelled = rows.column("label").to_numpy()
    y, toxic = ((labelled >> k & 1).astype(float) for k in (0, 1))
    weight = np.array([several[k] for k in labelled.tolist()], float) / np.maximum(np.bincount(labelled, minlength=4)[labelled], 1)
    weight /= max(weight.mean(), 1e-9) if len(weight) else 1
    cut = len(y) * 2 // 3
    if len(y) < 30 or min(y[:cut].sum(), cut - y[:cut].sum(), y[cut:].sum(), len(y) - cut - y[cut:].sum()) < 2:
        return None
    ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(rows.column("cells")).to_numpy())]).astype(np.int64)
    cells, values = (np.concatenate([x.flatten().to_numpy() for x in rows.column(c).chunks]) for c in ("cells", "weights"))
    weights, bias = _descend(cells[: ends[cut]], values[: ends[cut]], ends[: cut + 1], y[:cut], weight[:cut], epochs)
    score = _scores(cells, values, ends, weights) + bias
    slope, offset = _calibrate(score[cut:], y[cut:], weight[cut:])
    return Classifier(weights, bias, slope, offset, _fit_presence(cells, ends, toxic, weight, cut, epochs))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = 60) -> Classifier | None:
    """Fit on at most ``sample`` labelled rows, in one task; the driver gets the weights alone.

    A quarter of the sample is kept for each kind of row (of good or bad quality,
    toxic or not) that has so many, and rows are weighted by their kind's share of all
    labels. None if the sample hasn't 30 rows, or fewer than 2 of good or of bad
    quality in the two thirds that are fitted on or in the rest.
    """
    toxic = F.coalesce(F.max("toxic").cast("int"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality").cast("int") + 2 * toxic).alias("label"))
    order = F.xxhash64("doc_id", F.lit("quality")), F.col("doc_id")
    several = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}  # four kinds
    share = sample // 4
    spare = sample - sum(min(n, share) for n in several.values())
    chosen = None
    for label in sorted(several, key=several.get):  # rare kinds first; the commonest takes what they leave
        most = share + (spare if label == max(several, key=several.get) else 0)
        part = marked.where(F.col("label") == label).orderBy(*order).limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return None
    kind = docs.schema["doc_id"].dataType.simpleString()
    at = F.xxhash64("doc_id", F.lit("order"))
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` ids
        .mapInArrow(_sparse, f"doc_id {kind}, label int, cells array<int>, weights array<float>")
        .orderBy(at, "doc_id").limit(sample).select(at.alias("at"), "label", "cells", "weights")
    )

    def go(table: pa.Table) -> pa.Table:
        model = _fitted(table, several, epochs)
        parts = [m for m in (model, model and model.presence) if m]
        return pa.table(
            {
                "part": pa.array(range(len(parts)), pa.int32()),
                "weights": pa.array([m.weights for m in parts], pa.list_(pa.float32())),
                **{c: pa.array([getattr(m, c) for m in parts], pa.float64()) for c in ("bias", "slope", "offset")},
            }
        )

    # a group of at most `sample` rows
    found = rows.groupBy().applyInArrow(go, "part int, weights array<float>, bias double, slope double, offset double").toArrow().sort_by("part")
    model = None
    for k in reversed(range(found.num_rows)):
        weights = found.column("weights")[k].values.to_numpy()
        model = Classifier(weights, *(found.column(c)[k].as_py() for c in ("bias", "slope", "offset")), model)
    return model


def apply_rules(docs: DataFrame, model: Classifier | None, keep_from: float = KEEP_FROM, prefix: str = "") -> DataFrame:
    """Each row with its figures, ``base_failed``, ``probability`` and ``kept``; ``prefix`` goes before these names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 3 * 2**17 floats
    names = [prefix + name for name in (*FIGURES, "base_failed", "probability", "kept")]
    rest = [c for c in docs.columns if c.lower() not in names]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            w = Words.of(piece.column("text"))
            hashes = w.hashes()
            fig = figures(w, hashes)
            failed = base_failed(fig)
            p = sent.value.probability(w, hashes) if sent.value else np.ones(piece.num_rows)
            new = [*(pa.array(fig[k].astype(np.int64)) for k in FIGURES), pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep_from))]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), *new], names=[*rest, *names])

    docs = docs.select(*rest)
    kinds = ["long"] * len(FIGURES) + ["boolean", "double", "boolean"]
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in zip(names, kinds, strict=True):
        schema.add(name, kind)
    return docs.mapInArrow(score, schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return apply_rules(docs, fit(docs, labels)).select("doc_id", *FIGURES, "base_failed", "kept", "probability")
