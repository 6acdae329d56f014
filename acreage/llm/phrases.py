"""Phrase collocation mining by SON partitioning.

The documents are dealt to a fixed number of shards by the hash of their text. Each
shard is mined completely, in three levels: words, pairs, and longer phrases. A phrase is frequent in a
shard if its count there reaches the global support lowered in proportion to the shard's share of
its language's words; a pair is looked at only where both words are frequent in the shard, and a
longer phrase where all its pairs are. A phrase with enough support overall reaches the lowered one in some
shard, so the union of the locally frequent ones misses none. One more pass counts that union
in all documents, exactly and by its text.

A shard is a share of the rows, not a task: its counts are sums over a shuffle, after
each slice of a task has added up its own. Which phrases are frequent is
handed to the next pass as a Bloom filter of fixed size: what it lets through by
mistake, or because it is full, costs time and is counted away by the last pass.

Defined results: a null text is empty, a null lang is ``und``; phrases don't cross
pieces; overlapping occurrences all count; repeated rows are documents of their own; ties
go by count and then by the phrase's UTF-8; texts of any length are taken whole; an empty table
gives no rows; other columns are not looked at. Local counts go by 58-bit hashes, whose collisions can
only add candidates; in one slice of some MB the last pass tells phrases apart by 64-bit hashes too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acreage.llm.scratch import released, written
from acreage.llm.words import Words, mix64, multipliers, slices, texts_of

LEAST = 30
LONGEST = 4
TOP = 2000
#: A longer phrase with this share of a phrase's occurrences stands for it, in percent.
COVERED = 80
SHARDS = 3
#: The Bloom filter has 2 ** FILTER_BITS bits in blocks of 64 KB, and three probes within a block.
FILTER_BITS = 27
_BLOCK_BITS = 19
_GROUP_BITS = 6
_SALTS = 64
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True


def _keys(group: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    return mix64(phrase + group * np.uint64(0x9E3779B97F4A7C15))


def _group(lang: np.ndarray, shard: np.ndarray | int) -> np.ndarray:
    shards = np.full(len(lang), shard, np.uint64) + np.uint64(1)
    return mix64(lang.view(np.uint64) + shards * np.uint64(0xD1B54A32D192ED03))


def _probes(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A key's block, and its three bits there."""
    bit = mix64(key ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    places = [(bit >> np.uint64(_BLOCK_BITS * k)) & np.uint64((1 << _BLOCK_BITS) - 1) for k in range(3)]
    return (key >> np.uint64(64 - bits + _BLOCK_BITS)).astype(np.int64), np.stack(places, axis=1).astype(np.int64)


def bloom_filter(phrases: DataFrame, bits: int = FILTER_BITS) -> Broadcast:
    """A filter of (lang_hash, shard, phrase), built a block at a time in tasks; the driver gets its 2 ** bits bits."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, shard, phrase = (c.to_numpy() for c in batch.columns)
            key = _keys(_group(lang, shard), phrase.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(_probes(key, bits)[0]), pa.array(key.view(np.int64))], names=["block", "key"])

    def filled(pdf: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros(1 << _BLOCK_BITS, bool)
        block[_probes(pdf["key"].to_numpy().view(np.uint64), bits)[1].ravel()] = True
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "held": [np.packbits(block, bitorder="little").tobytes()]})

    keys = phrases.select("lang_hash", "shard", "phrase").mapInArrow(keyed, "block long, key long")
    found = np.zeros(1 << (bits - 3), np.uint8)
    for row in keys.groupBy("block").applyInPandas(filled, "block long, held binary").toLocalIterator():
        found[row["block"] << (_BLOCK_BITS - 3) :][: 1 << (_BLOCK_BITS - 3)] = np.frombuffer(row["held"], np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(found)


def _held(found: np.ndarray, key: np.ndarray) -> np.ndarray:
    block, places = _probes(key, (len(found) - 1).bit_length() + 3)
    out = np.ones(len(key), bool)
    for k in range(3):
        out &= (found[(block << (_BLOCK_BITS - 3)) + (places[:, k] >> 3)] >> (places[:, k] & 7).astype(np.uint8)) & 1 == 1
    return out


class _Scan:
    """Words of a slice, and the phrases that lie within its pieces."""

    def __init__(self, piece: pa.RecordBatch) -> None:
        self.words = w = Words.of(piece.column("text"), lower=True, apart=_APART)
        self.row = w.row_of_word()
        self.hashes = w.hashes()
        self.run = np.cumsum(_BREAK[w.raw])[w.starts] + self.row if len(w.starts) else self.row

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each phrase of so many words."""
        last = len(self.run) - size + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.run[:last] == self.run[size - 1 :])
        out = np.full(len(at), size, np.uint64)
        for k, factor in enumerate(multipliers(size, 12)):
            out += self.hashes[at + k] * factor
        return at, mix64(out) >> np.uint64(_GROUP_BITS)


def _edges(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each sorted key begins, and how often it occurs."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    return first, np.diff(np.concatenate([first, [len(key)]]))


def _docs(docs: DataFrame, shards: int) -> DataFrame:
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), "text")


def _local_counts(docs: DataFrame, sizes: tuple[int, ...], known: int = 0, frequent: Broadcast | None = None) -> DataFrame:
    """(lang_hash, shard, size, phrase, n) of phrases of so many words, all of whose parts of ``known`` words are in the filter."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 3 << 20):
            scan = _Scan(piece)
            langs, shards = piece.column("lang_hash").to_numpy(), piece.column("shard").to_numpy()
            groups, group = np.unique(_group(langs, shards), return_inverse=True)
            some = np.zeros(len(groups), np.int64)
            some[group] = np.arange(len(group))  # a row of each group
            group = group[scan.row]
            held = None
            if frequent is not None:
                at, phrase = scan.phrases(known)
                held = np.zeros(len(scan.row) + 1, bool)
                held[at] = _held(frequent.value, _keys(groups[group[at]], phrase))
            for size in sizes:
                at, phrase = scan.phrases(size)
                for k in range(size - known + 1 if held is not None and len(at) else 0):
                    kept = held[at + k]
                    at, phrase = at[kept], phrase[kept]
                for low in range(0, len(groups), 1 << _GROUP_BITS):  # so many groups fit beside a phrase in one number, which sorts fast
                    within = group[at] - low
                    mine = slice(None) if len(groups) <= 1 << _GROUP_BITS else (within >= 0) & (within < 1 << _GROUP_BITS)
                    key = np.sort((phrase[mine] << np.uint64(_GROUP_BITS)) | within[mine].astype(np.uint64))
                    first, n = _edges(key)
                    key = key[first]
                    row = some[low + (key & np.uint64((1 << _GROUP_BITS) - 1)).astype(np.int64)]
                    columns = [langs[row], shards[row], np.full(len(key), size, np.int32), (key >> np.uint64(_GROUP_BITS)).astype(np.int64), n]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lang_hash", "shard", "size", "phrase", "n"])

    parts = docs.mapInArrow(go, "lang_hash long, shard int, size int, phrase long, n long")
    return parts.groupBy("lang_hash", "shard", "size", "phrase").agg(F.sum("n").alias("n"))


def _global_counts(docs: DataFrame, longest: int, shards: int, candidates: Broadcast) -> DataFrame:
    """(lang, size, phrase, f): occurrences of the phrases in the filter."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 3 << 20):
            scan = _Scan(piece)
            group = _group(piece.column("lang_hash").to_numpy(), shards)[scan.row]
            for size in range(1, longest + 1):
                at, phrase = scan.phrases(size)
                key = _keys(group[at], phrase)
                held = _held(candidates.value, key)
                at, key = at[held], key[held]
                order = np.argsort(key)
                first, n = _edges(key[order])
                if len(first):
                    at = at[order[first]]
                    yield pa.RecordBatch.from_arrays([piece.column("lang").take(pa.array(scan.row[at])), pa.array(np.full(len(n), size, np.int32)), texts_of(scan.words, at, size), pa.array(n)], names=["lang", "size", "phrase", "n"])

    return docs.mapInArrow(go, "lang string, size int, phrase string, n long").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times in their language, and (lang, n), its words."""
    docs = _docs(docs, shards)
    words = written(_local_counts(docs, (1,)), "phrases-words")
    shares = words.groupBy("lang_hash", "shard").agg(F.sum("n").alias("shard_n"))
    totals = shares.groupBy("lang_hash").agg(F.sum("shard_n").alias("lang_n")).join(docs.select("lang", "lang_hash").distinct(), "lang_hash")
    totals = written(totals, "phrases-totals")
    shares = written(shares.join(totals.drop("lang"), "lang_hash"), "phrases-shares")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    enough = wide("n") * wide("lang_n") >= wide("shard_n") * F.lit(least)
    locally = lambda counts, label: written(counts.join(shares, ["lang_hash", "shard"]).where(enough).select("lang_hash", "shard", "phrase"), f"phrases-frequent-{label}")
    levels = [locally(words, "words")]
    for sizes in [(2,), tuple(range(3, longest + 1))] if longest > 2 else [(2,)]:
        frequent = bloom_filter(levels[-1], bits)
        levels.append(locally(_local_counts(docs, sizes, sizes[0] - 1, frequent), "pairs" if sizes == (2,) else "longer"))
        frequent.destroy()
    union = levels[0]
    for level in levels[1:]:
        union = union.unionByName(level)
    candidates = bloom_filter(union.withColumn("shard", F.lit(shards)).distinct(), bits)
    found = written(_global_counts(docs, longest, shards, candidates).where(F.col("f") >= least), "phrases-found")
    candidates.destroy()
    released(words, shares, *levels)
    return found, totals.select("lang", F.col("lang_n").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by their weakest cut."""
    found, totals = frequent_phrases(docs, least, longest, shards)
    phrases = found.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda first, size: F.array_join(F.slice("words", first, size), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("score", F.expr("(cast(2000000 as decimal(38,0)) * a) div (l + r)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")).select("lang", "phrase", "a", "cut.*")
    longer = phrases.where("size > 2").withColumn("sub", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("sub") + 1))).select("lang", part(F.col("at"), F.col("sub")).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    stays = F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * covered)
    kept = scored.join(longer, ["lang", "phrase"], "left").where(stays).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # the first of each salt's phrases, then of at most _SALTS * top
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
n as (select lang, sum(len(ws))::hugeint as n from w group by lang),
places as (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, (values (1), (2), (3), (4)) sizes(k) where len(ws) >= k),
f as materialized (
  select lang, k, phrase, count(*)::hugeint as f from (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase from places) group by all having count(*) >= 30),
c as (select lang, k as size, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1),
cuts as (select *, unnest(range(1, size)) as k from c),
scored as (
  select cuts.lang, cuts.phrase, cuts.a, cuts.k, x.f as l, y.f as r, (2000000::hugeint * cuts.a) // (x.f + y.f) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = array_to_string(ws[1:cuts.k], ' ') join f y on y.lang = cuts.lang and y.phrase = array_to_string(ws[cuts.k + 1:size], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
subs as (
  select lang, array_to_string(ws[i:i + s - 1], ' ') as phrase, max(a) as longer
  from (select lang, ws, a, s, unnest(range(1, size - s + 2)) as i from c, (values (2), (3)) sizes(s) where s < size) group by all),
kept as (select best.* from best left join subs using (lang, phrase) where longer is null or 100 * longer < 80 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join n using (lang) where rank <= 2000
"""
