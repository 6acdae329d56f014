"""Substring dedup: words covered by a window of words that occurs more than once anywhere.

Every window of ``size`` words is led by its minimizer, the least hash among
its runs of ``anchor`` words; consecutive windows with the same one form a
region. Equal windows have equal minimizers, so a region whose minimizer occurs
nowhere else has no repeated window. The others are dealt
by minimizer to shards. Each shard builds an FM-index of its regions and streams
all of them through it; backward search gives their matching statistics, and the
maximal runs of ``size`` words or more that occur at least twice are reported. Equal
regions are one sequence of the index with their number as its multiplicity, so that the
range of suffixes that a search ends in tells how often its words occur.

Equal windows agree in all their runs. Regions whose minimizer has more than ``shard_words`` words
are cut where the windows' two least runs change, and the parts are dealt by both;
what is still too much for a shard is cut and dealt by the four least, by eight, and so on. However many
texts share a passage, a shard gets about as much, and the result is the same for any ``shard_words``.

Words are compared by 64-bit hashes, and so are regions and windows. Texts are
shuffled twice, to where their regions are asked for and to their spans.

Defined results: a null, empty or short text loses nothing and keeps its
words joined by one space; texts of any length are taken whole; windows are judged
on the input; repeated rows are documents of their own and repeat each other; a
null doc_id is a document; doc_ids of any type; an empty table gives no rows. Other
columns, of any name, are carried by ``remove_repeats``, but for ``n_words``
and ``n_removed``, which it replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.llm.fm_index import FmIndex, matching_intervals
from acreage.llm.scratch import released, written
from acreage.llm.words import Words, covered, mix64, multipliers, slices, window_hashes, windows_in_rows

SIZE = 35
ANCHOR = 8
SHARD_WORDS = 100_000
_CHUNK = 1 << 14


def _hash_at(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows at ``starts``."""
    out = np.zeros(len(starts), np.uint64)
    for k, factor in enumerate(multipliers(size, 10)):
        out += hashes[starts + k] * factor
    return mix64(out)


def _runs(w: Words, starts: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, words) of each run of consecutive windows of a row with one value."""
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    head = np.concatenate([[True], (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = np.flatnonzero(head)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    row = np.searchsorted(w.at, starts[first], "right") - 1
    return row, starts[first], starts[last] - starts[first] + size


def _content(hashes: np.ndarray, first: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """A hash of runs of n words: the first and the last window together are the whole."""
    return mix64(_hash_at(hashes, first, size) * np.uint64(3) + _hash_at(hashes, first + n - size, size) + (n - size).astype(np.uint64))


def _regions(w: Words, hashes: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(row, start within the row, words, minimizer, content hash) of each region."""
    starts = windows_in_rows(w.at, size)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    anchors = window_hashes(hashes, anchor, 9)
    width = size - anchor + 1
    views = np.lib.stride_tricks.sliding_window_view(anchors, width)
    parts = [views[k : k + _CHUNK].argmin(axis=1) for k in range(0, len(views), _CHUNK)]  # argmin copies its rows
    least = np.concatenate(parts)[starts] + starts
    row, first, n = _runs(w, starts, least, size)
    return row, first - w.at[row], n, anchors[least[np.searchsorted(starts, first)]], _content(hashes, first, n, size)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_t", F.xxhash64("text"))


def _all_regions(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1 << 20):
            w = Words.of(piece.column("text"))
            row, start, n, least, content = _regions(w, w.hashes(), size, anchor)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id").take(at), piece.column("_t").take(at), pa.array(least.view(np.int64)), pa.array(content.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], names=["doc_id", "_t", "least", "content", "start", "n"])

    return _keyed(docs).select("doc_id", "_t", "text").mapInArrow(go, f"doc_id {kind}, _t long, least long, content long, start int, n int")


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """The rows joined with a list of structs by (doc_id, _t)."""
    lists = lists.withColumnsRenamed({"doc_id": "_d", "_t": "_u"})
    same = docs["doc_id"].eqNullSafe(lists["_d"]) & (docs["_t"] == lists["_u"])
    return docs.join(lists, same, how).drop("_d", "_u")


def _parts(w: Words, first: np.ndarray, n: np.ndarray) -> pa.Array:
    """The texts of runs of n words."""
    begin, end = w.starts[first], w.ends[first + n - 1]
    ends = np.concatenate([[0], np.cumsum(end - begin)])
    inside = np.arange(ends[-1]) - np.repeat(ends[:-1] - begin, end - begin)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(w.raw[inside])))


def _contents(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """The regions with ``text``, that of their words."""
    rest = [c for c in regions.columns if c not in ("doc_id", "_t", "start")]
    lists = regions.groupBy("doc_id", "_t").agg(F.collect_list(F.struct("start", *rest)).alias("_list"))  # regions of one document
    kinds = dict(regions.dtypes)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1 << 20):
            w = Words.of(piece.column("text"))
            owner = np.repeat(np.arange(piece.num_rows), pa.compute.list_value_length(piece.column("_list")).to_numpy())
            flat = piece.column("_list").flatten()
            columns = {c: flat.field(k) for k, c in enumerate(["start", *rest])}
            texts = _parts(w, w.at[owner] + columns.pop("start").to_numpy(), columns["n"].to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([*columns.values(), texts.cast(pa.string())], names=[*columns, "text"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in rest)
    lists = written(lists, "substring-asked")
    return _with_lists(_keyed(docs), lists, "inner").drop("doc_id", "_t").mapInArrow(go, f"{schema}, text string")


def _cut(nodes: DataFrame, most: int, size: int, anchor: int) -> DataFrame:
    """(node, begin, key, content, times, n, text): each node's stretches of windows that agree in their ``most`` least runs of words, which the key tells."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1 << 18):
            w = Words.of(piece.column("text"))
            hashes = w.hashes()
            starts = windows_in_rows(w.at, size)
            views = np.lib.stride_tricks.sliding_window_view(window_hashes(hashes, anchor, 9), size - anchor + 1)
            parts = [mix64(np.partition(views[starts[k : k + _CHUNK]], most - 1, axis=1)[:, :most]).sum(axis=1) for k in range(0, len(starts), _CHUNK)]
            value = mix64(np.concatenate([*parts, np.zeros(0, np.uint64)]))
            row, first, n = _runs(w, starts, value, size)
            key = value[np.searchsorted(starts, first)]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [piece.column("content").take(at), pa.array(first - w.at[row]), pa.array(key.view(np.int64)), pa.array(_content(hashes, first, n, size).view(np.int64)), piece.column("times").take(at), pa.array(n), _parts(w, first, n).cast(pa.string())],
                names=["node", "begin", "key", "content", "times", "n", "text"],
            )

    return nodes.select("content", "times", "text").mapInArrow(go, "node long, begin long, key long, content long, times long, n long, text string")


def _search(sequences: DataFrame, size: int) -> DataFrame:
    """(content, begin, end) of the runs of words of (shard, content, times, text) that occur at least twice, by one FM-index per shard."""

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        w = Words.of(pa.array(pdf["text"], pa.large_string()))
        words = np.split(w.hashes().view(np.int64), w.at[1:-1])
        which, begin, end = matching_intervals(FmIndex(words, 2 * size, pdf["times"].to_numpy()), words, size)
        return pd.DataFrame({"content": pdf["content"].to_numpy()[which], "begin": begin, "end": end})

    # a shard is a hash range of keys with bounded words each
    return sequences.groupBy("shard").applyInPandas(go, "content long, begin long, end long")


def _dealt(contents: DataFrame, size: int, anchor: int, shard_words: int) -> tuple[DataFrame, DataFrame]:
    """The sequences that fit into shards by their keys (key, content, times, n, text), and where each lies in a region: (root, offset, content)."""
    nodes = contents.select(F.col("least").alias("key"), "content", "times", F.col("n").cast("long").alias("n"), "text")
    places = contents.select(F.col("content").alias("root"), F.lit(0).cast("long").alias("offset"), "content")
    fitting, where, most = [], [], 1
    while True:
        sums = nodes.groupBy("key").agg(F.sum("n").alias("_n"), F.count("*").alias("_m"))
        hot = written(sums.where((F.col("_n") > shard_words) & (F.col("_m") > 1)).select("key"), "substring-hot")
        if most > size - anchor or not hot.limit(1).count():  # windows that agree in all runs are equal
            break
        most = min(2 * most, size - anchor + 1)
        fitting.append(nodes.join(hot, "key", "left_anti"))
        cut = written(_cut(nodes.join(hot, "key"), most, size, anchor), "substring-cut")
        # what was not cut keeps its places
        where.append(places.join(cut.select(F.col("node").alias("content")).distinct(), "content", "left_anti").select("root", "offset", "content"))
        places = written(places.withColumnRenamed("content", "node").join(cut.select("node", "begin", "content"), "node").select("root", (F.col("offset") + F.col("begin")).alias("offset"), "content"), "substring-places")
        nodes = cut.groupBy("content").agg(F.min("key").alias("key"), F.sum("times").alias("times"), F.min("n").alias("n"), F.min("text").alias("text"))
        nodes = written(nodes.select("key", "content", "times", "n", "text"), "substring-nodes")
    for more, at in zip(fitting, where, strict=True):
        nodes, places = nodes.unionByName(more), places.unionByName(at)
    return nodes, places


def repeated_spans(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, _t, begin, end): spans of ``size`` words or more whose windows all occur more than once; _t is the text's hash."""
    docs = docs.select("doc_id", "text")
    regions = written(_all_regions(docs, size, anchor), "substring-regions")
    shared = written(regions.groupBy("least").agg(F.count("*").alias("_n")).where("_n > 1").select("least"), "substring-minimizers")
    met = written(regions.join(shared, "least"), "substring-met")
    released(regions, shared)
    # a content hash also tells the minimizer; equal regions are counted in each task first
    distinct = met.groupBy("least", "content").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "_t", "start", "n")).alias("_first"))
    distinct = written(distinct.select("least", "content", "times", "_first.*"), "substring-distinct")
    contents = written(_contents(docs, distinct), "substring-contents")
    sequences, places = _dealt(contents, size, anchor, shard_words)
    shards = max(1, -(-sequences.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // shard_words))
    found = written(_search(sequences.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))), size), "substring-found")
    by_content = places.join(found, "content").select(F.col("root").alias("content"), (F.col("offset") + F.col("begin")).alias("begin"), (F.col("offset") + F.col("end")).alias("end"))
    by_content = written(by_content, "substring-by-content")
    released(contents, distinct, found)
    return met.join(by_content, "content").select("doc_id", "_t", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end"))


def _apply(docs: DataFrame, spans: DataFrame, name: str, kind: str, out: Callable) -> DataFrame:
    """``name`` of each row, and what ``out`` makes of the words that remain; docs has doc_id, text and ``name``."""
    # spans of one document; repeated rows have the same ones
    lists = written(spans.groupBy("doc_id", "_t").agg(F.collect_set(F.struct("begin", "end")).alias("_spans")), "substring-spans")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1 << 20):
            w = Words.of(piece.column("text"))
            column = piece.column("_spans")
            owner = np.repeat(np.arange(piece.num_rows), pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy())
            flat = column.flatten()
            begin = w.at[owner] + (flat.field(0).to_numpy() if len(flat) else np.zeros(0, np.int64))
            end = w.at[owner] + (flat.field(1).to_numpy() if len(flat) else np.zeros(0, np.int64))
            gone = covered(begin, end - begin, len(w.starts))
            kept = [b" ".join(x for x, g in zip(w.bytes_of(k), gone[a:b], strict=True) if not g) if b > a else b"" for k, (a, b) in enumerate(zip(w.at[:-1], w.at[1:], strict=True))]
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.at])
            yield pa.RecordBatch.from_arrays([piece.column(name), pa.array(out(kept), pa.string()), pa.array(w.counts.astype(np.int64)), pa.array(removed.astype(np.int64))], names=[name, "kept", "n_words", "n_removed"])

    return _with_lists(_keyed(docs), lists, "left").select(name, "text", "_spans").mapInArrow(go, f"{name} {kind}, kept string, n_words long, n_removed long")


def remove_repeats(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts, ``n_words`` and ``n_removed``."""
    rest = [c for c in docs.columns if c.lower() not in ("text", "n_words", "n_removed")]
    packed = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_rest"))
    done = _apply(packed, repeated_spans(docs, size, anchor, shard_words), "_rest", packed.schema["_rest"].dataType.simpleString(), lambda kept: [x.decode() for x in kept])
    return done.select("_rest.*", F.col("kept").alias("text"), "n_words", "n_removed")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = _apply(docs, repeated_spans(docs), "doc_id", "long", lambda kept: [hashlib.sha256(x).hexdigest() for x in kept])
    return done.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


OP6_SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
starts as (select r, ws, unnest(range(1, len(ws) - 33)) as i from d),
windows as materialized (select r, i, md5(array_to_string(ws[i:i + 34], ' ')) as w from starts),
again as (select r, i from windows where w in (select w from windows group by w having count(*) > 1)),
words as (select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from d),
marked as (
  select words.r, words.i, word, max(again.i) over (partition by words.r order by words.i rows between unbounded preceding and current row) as latest
  from words left join again on again.r = words.r and again.i = words.i),
kept as (select r, count(*) as n, count(*) filter (latest > i - 35) as gone, string_agg(word, ' ' order by i) filter (latest is null or latest <= i - 35) as rest from marked group by r)
select doc_id, coalesce(n, 0)::bigint as n_words, coalesce(gone, 0)::bigint as n_removed, sha256(coalesce(rest, '')) as kept_sha256 from d left join kept on kept.r = d.r
"""
