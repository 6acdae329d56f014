"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Items and documents are compared as lower-cased words without ASCII marks.
The n-grams of the items are counted over all documents; an item's rarer
half (and every n-gram in at most ``rare`` documents) are its seeds, so an
item that has leaked into very many documents still has seeds. Where a seed
occurs in a document, the passage around it is aligned with the item. The
score is the alignment's value over that of a verbatim copy, in 0 to 1; a
document is contaminated by an item from ``threshold`` on.

The benchmark is taken in blocks of at most ``block_words`` words, each
broadcast and compared with all documents, so any size works.

Defined results: null or empty texts, and items of fewer than ``n`` words,
match nothing; items with equal texts all match; repeated rows are rows of
their own; texts of any length are aligned whole; doc_ids of any type, item_ids of
strings or whole numbers, nulls included; an empty table of either kind contaminates
nothing; other columns, of any name, are carried through by ``decontaminate``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.llm.words import Words, slices, window_hashes

N = 3
RARE = 8
THRESHOLD = 0.5
BLOCK_WORDS = 1_000_000
_MATCH, _MISS, _GAP = 2, -1, -1


class Items:
    """A block of items: their words, and the n-grams that occur in them, as sorted hashes."""

    def __init__(self, ids: list, texts: list[str], n: int) -> None:
        w = Words.of(pa.array(texts, pa.string()), lower=True, plain=True)
        hashes = w.hashes()
        self.ids, self.n = ids, n
        self.words = [hashes[a:b] for a, b in zip(w.at[:-1], w.at[1:], strict=True)]
        self.vocabulary = np.unique(hashes)
        grams = [window_hashes(x, n, 6) for x in self.words]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        where = [(g, item, k) for item, x in enumerate(grams) for k, g in enumerate(np.searchsorted(self.grams, x))]
        where.sort()
        self.places = np.array(where, np.int64).reshape(-1, 3)
        self.seed = np.ones(len(self.grams), bool)

    def choose(self, counts: np.ndarray, rare: int) -> None:
        """Keep as seeds each item's rarer half and what is rare in itself."""
        self.seed = counts <= rare
        pairs = np.unique(self.places[:, 1::-1], axis=0)  # (item, n-gram)
        for own in np.split(pairs[:, 1], np.flatnonzero(np.diff(pairs[:, 0])) + 1):
            if len(own):
                self.seed[own[counts[own] <= np.median(counts[own])]] = True

    def found(self, w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position, n-gram) of the block's n-grams in the rows' words."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == hashes
        start = np.ones(max(len(hashes) - self.n + 1, 0), bool)
        for k in range(self.n):
            start &= known[k : k + len(start)]
        start = np.flatnonzero(start)
        row = w.row_of_word()
        start = start[row[start] == row[start + self.n - 1]]
        near = hashes[start[:, None] + np.arange(self.n)].ravel()
        keys = window_hashes(near, self.n, 6)[:: self.n]
        gram = np.searchsorted(self.grams, keys)
        gram[gram == len(self.grams)] = 0
        same = self.grams[gram] == keys
        return start[same], gram[same]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Smith-Waterman's best local score over that of a verbatim copy, and where in the passage it ends."""
    steps = np.arange(len(passage) + 1)
    above = np.zeros(len(passage) + 1)
    best, end = 0.0, 0
    for word in item:
        here = np.zeros(len(passage) + 1)
        here[1:] = np.maximum(above[:-1] + np.where(passage == word, _MATCH, _MISS), above[1:] + _GAP)
        here = np.maximum(np.maximum.accumulate(here - _GAP * steps) + _GAP * steps, 0)
        if (top := here.max()) > best:
            best, end = float(top), int(here.argmax())
        above = here
    return best / (_MATCH * len(item)), end


def _matches(items: Items, w: Words, hashes: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, begin, end): the best passage of each row and item; word positions within the row."""
    start, gram = items.found(w, hashes)
    start, gram = start[items.seed[gram]], gram[items.seed[gram]]
    if not len(start):
        return
    first = np.searchsorted(items.places[:, 0], gram, "left")
    times = np.searchsorted(items.places[:, 0], gram, "right") - first
    hit = np.repeat(np.arange(len(start)), times)
    place = items.places[np.repeat(first, times) + np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)]
    lengths = np.array([len(x) for x in items.words])
    row = np.searchsorted(w.at, start[hit], "right") - 1
    item = place[:, 1]
    slack = lengths[item] // 2 + 2
    low = np.maximum(start[hit] - place[:, 2] - slack, w.at[row])
    high = np.minimum(start[hit] - place[:, 2] + lengths[item] + slack, w.at[row + 1])
    order = np.lexsort((low, item, row))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    k = 0
    while k < len(order):
        r, i = int(row[order[k]]), int(item[order[k]])
        a, b = int(low[order[k]]), int(high[order[k]])
        k += 1
        while k < len(order) and row[order[k]] == r and item[order[k]] == i and low[order[k]] <= b:
            b = max(b, int(high[order[k]]))
            k += 1
        score, end = align(items.words[i], hashes[a:b])
        if score >= threshold and score > best.get((r, i), (0.0,))[0]:
            stop = a + end - int(w.at[r])
            best[r, i] = (score, max(0, stop - len(items.words[i])), stop)
    for (r, i), found in sorted(best.items()):
        yield (r, i, *found)


def _blocks(benchmark: DataFrame, n: int, block_words: int) -> Iterator[Items]:
    """The items in blocks of bounded size, one after another."""
    sized = benchmark.where("text is not null").withColumn("_n", F.size(F.split("text", r"\s+")).cast("long"))
    total = sized.agg(F.sum("_n")).first()[0] or 0
    count = max(1, math.ceil(total / block_words))
    for k in range(count):
        part = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).select("item_id", "text").orderBy("item_id", "text").toArrow()
        items = Items(part.column("item_id").to_pylist(), part.column("text").to_pylist(), n)
        if len(items.grams):
            yield items


def _counted(docs: DataFrame, items: Items, rare: int) -> Items:
    """Count each n-gram's documents over all documents, and choose the seeds."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(sent.value.grams), np.int64)  # one row per n-gram and task at most
        for piece in slices(batches, "text"):
            w = Words.of(piece.column("text"), lower=True, plain=True)
            start, gram = sent.value.found(w, w.hashes())
            row = np.searchsorted(w.at, start, "right") - 1
            counts += np.bincount(np.unique(row * len(counts) + gram) % len(counts), minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(go, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(items.grams), np.int64)
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    items.choose(counts, rare)
    sent.unpersist()
    return items


def _scan(docs: DataFrame, items: Items, threshold: float, schema: T.StructType | str, out: Callable) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            w = Words.of(piece.column("text"), lower=True, plain=True)
            yield out(piece, sent.value, list(_matches(sent.value, w, w.hashes(), threshold)))

    return docs.mapInArrow(go, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N, rare: int = RARE, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, begin, end): one row per document and item that it contains; begin and end count words."""
    kind = dict(docs.dtypes)["doc_id"]
    item = benchmark.schema["item_id"].dataType
    schema = f"doc_id {kind}, item_id {item.simpleString()}, score double, begin long, end long"
    item = pa.string() if isinstance(item, T.StringType) else pa.int64() if isinstance(item, T.LongType) else pa.int32()

    def out(piece: pa.RecordBatch, items: Items, found: list[tuple]) -> pa.RecordBatch:
        rows = [f[0] for f in found]
        new = [[items.ids[f[1]] for f in found], *([f[k] for f in found] for k in (2, 3, 4))]
        kinds = [item, pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([piece.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(new, kinds, strict=True))], names=["doc_id", "item_id", "score", "begin", "end"])

    result = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, n, block_words):
        items = _counted(docs, items, rare)
        result = result.unionByName(_scan(docs.select("doc_id", "text"), items, threshold, schema, out))
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = N, rare: int = RARE, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that contain no item."""

    def out(piece: pa.RecordBatch, items: Items, found: list[tuple]) -> pa.RecordBatch:
        keep = np.ones(piece.num_rows, bool)
        keep[[f[0] for f in found]] = False
        return piece.filter(pa.array(keep))

    result = docs
    for items in _blocks(benchmark, n, block_words):
        items = _counted(docs, items, rare)
        result = _scan(result, items, threshold, docs.schema, out)
    return result


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
