"""Source divergence audit: how the words of each source differ from its language's and from other sources', by a dominance skyband.

A group is a (lang, source). Its smoothed share of a kept term is
p = 1 + floor(10^9 (count + 5) / (N + 5 V)). Part ``term`` ranks a group's
terms by p less the language's share q. p grows with the group's count and q
with the language's, so a term with a count in the group as high, one in the
language as low and an earlier name always ranks before: a term with ``top``
such terms can't be among the first ``top``. Each partition keeps its terms that fewer
dominate, the partitions' skybands are merged per group in two steps, and the
rest is ranked exactly.

Part ``pair`` sums |p - q| over all kept terms for every two sources of a
language. Terms are dealt to blocks by hash; a block's sums of all pairs of
sources are one row each, so no term's pairs are listed.

Defined results: null text, lang and source are ''; a group without kept
terms has pairs (value 0 where the language keeps none) and no terms; repeated rows
are documents of their own; ties go by the UTF-8 of the item; texts of any
length are counted whole; an empty table gives no rows; other columns are not looked at.
Within one slice of some MB terms are told apart by 64-bit hashes, and by their text beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acreage.llm.scratch import written
from acreage.llm.words import Words, mix64, slices, texts_of

LEAST_DOCS = 30
TOP = 50
SMOOTHING = 5
SCALE = 1_000_000_000
#: Rows of a block of terms, and cells of a matrix within it.
BLOCK_ROWS = 500_000
_CELLS = 1 << 20
_MERGES = 16
_APART = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def _groups(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")), "text")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 4 << 20):
            w = Words.of(piece.column("text"), lower=True, apart=_APART)
            if not len(w.starts):
                continue
            langs, sources = piece.column("lang").dictionary_encode(), piece.column("source").dictionary_encode()
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            row = w.row_of_word()
            key = mix64(w.hashes() + (group[row] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(key, kind="stable")
            key, row = key[order], row[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.flatnonzero(new)
            other = new | np.concatenate([[True], row[1:] != row[:-1]])
            at = pa.array(row[first])
            n = np.diff(np.concatenate([first, [len(key)]]))
            yield pa.RecordBatch.from_arrays([piece.column("lang").take(at), piece.column("source").take(at), texts_of(w, order[first]), pa.array(n), pa.array(np.add.reduceat(other.astype(np.int64), first))], names=["lang", "source", "term", "n", "docs"])

    parts = _groups(docs).mapInArrow(go, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> F.Column:
    return F.expr(f"cast(1 + (cast({SCALE} as decimal(38,0)) * ({count} + {SMOOTHING})) div ({total} + cast({SMOOTHING} as bigint) * {terms}) as bigint)")


def skyband(high: np.ndarray, low: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Rows that fewer than k others dominate with a ``high`` as great, a ``low`` as small and a lesser ``name``.

    In this order a row's dominators come before it, and k of them are kept if there are so many.
    """
    order = np.lexsort((name, low, -high))
    kept = np.empty(0, np.int64)
    for begin in range(0, len(order), 256):
        block = order[begin : begin + 256]
        before = ((low[kept] <= low[block, None]) & (name[kept] < name[block, None])).sum(axis=1)
        block, before = block[before < k], before[before < k]
        inside = np.tril((low[block] <= low[block, None]) & (name[block] < name[block, None]), -1)
        stays = np.ones(len(block), bool)
        for i in np.flatnonzero(before + inside.sum(axis=1) >= k):
            stays[i] = before[i] + (inside[i] & stays).sum() < k
        kept = np.concatenate([kept, block[stays]])
    return kept


def _codes(batch: pa.RecordBatch | pa.Table, *columns: str) -> np.ndarray:
    code = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        column = batch.column(c)
        encoded = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
        code = code * (len(encoded.dictionary) + 1) + encoded.indices.to_numpy()
    return code


def _skybands(table: pa.Table, k: int) -> pa.Table:
    """The skyband of each (lang, source) of the table."""
    table = table.combine_chunks()
    name = np.empty(table.num_rows, np.int64)
    name[pc.sort_indices(table.column("term")).to_numpy()] = np.arange(table.num_rows)
    group, high, low = _codes(table, "lang", "source"), table.column("n").to_numpy(), table.column("all_n").to_numpy()
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0, [True]]))
    kept = [rows[skyband(high[rows], low[rows], name[rows], k)] for rows in (order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True))]
    return table.take(pa.array(np.concatenate([np.empty(0, np.int64), *kept])))


def _thinned(terms: DataFrame, k: int) -> DataFrame:
    """The skybands of each partition."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = _skybands(table if held is None else pa.concat_tables([held, table]), k)
        if held is not None:
            yield from held.to_batches()

    return terms.mapInArrow(go, terms.schema)


def divergent_terms(counts: DataFrame, k: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank) of (lang, source, term, n, all_n, p, q): the first k terms of each group by p - q."""
    terms = _thinned(counts.where("n > 0 and p > q").select("lang", "source", "term", "n", "all_n", "p", "q"), k)
    merged = _thinned(terms.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(_MERGES))), k)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # skybands of _MERGES parts of a group
    ranked = merged.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def divergent_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): for every two sources of a language the sum of |p - q| over its kept terms. ``groups`` has ``p0``, a term's share where it doesn't occur."""
    blocks = counts.count() // BLOCK_ROWS + 64
    terms = counts.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "source", "term", "p")
    all_groups = groups.select("lang", "source", "p0", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def go(held: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("source", ignore_index=True)
        names, p0 = sources["source"].to_numpy(object), sources["p0"].to_numpy(np.int64)
        sums = np.zeros((len(names), len(names)), np.int64)
        of = pd.Index(names).get_indexer(held["source"])
        term = pd.factorize(held["term"])[0]
        order = np.argsort(term, kind="stable")
        term, of, p = term[order], of[order], held["p"].to_numpy(np.int64)[order]
        step, last = max(1, _CELLS // max(1, len(names))), int(term[-1]) + 1 if len(term) else 0
        for first in range(0, last, step):
            a, b = np.searchsorted(term, [first, first + step])
            shares = np.tile(p0, (min(step, last - first), 1))
            shares[term[a:b] - first, of[a:b]] = p[a:b]
            for k in range(len(names)):
                sums[k] += np.abs(shares - shares[:, k : k + 1]).sum(axis=0)
        lang = sources["lang"].iloc[0] if len(sources) else ""
        one, two = np.nonzero(~np.eye(len(names), dtype=bool))
        return pd.DataFrame({"lang": np.full(len(one), lang, object), "source": names[one], "item": names[two], "value": sums[one, two]})

    found = terms.groupBy("lang", "block").cogroup(all_groups.groupBy("lang", "block")).applyInPandas(go, "lang string, source string, item string, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # a row per other source
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): both parts for every (lang, source) of the documents."""
    counts = written(term_counts(docs), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= least_docs).drop("_docs")
    kept = written(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")
    langs = kept.groupBy("lang", "term").agg(F.first("all_n").alias("all_n")).groupBy("lang").agg(F.sum("all_n").alias("all_total"), F.count("*").alias("terms"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = _groups(docs).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "all_total", "terms"])
    groups = written(groups.withColumn("p0", F.when(F.col("terms") > 0, _share("0", "total", "terms")).otherwise(0)), "divergence-groups")
    shares = kept.join(groups, ["lang", "source"]).withColumns({"p": _share("n", "total", "terms"), "q": _share("all_n", "all_total", "terms")})
    shares = written(shares.select("lang", "source", "term", "n", "all_n", "p", "q"), "divergence-shares")
    out = ["lang", "source", "part", "item", "value", "rank"]
    pairs = divergent_pairs(shares, groups).withColumn("part", F.lit("pair"))
    return pairs.select(*out).unionByName(divergent_terms(shares, top).withColumn("part", F.lit("term")).select(*out))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
w as materialized (select id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*)::hugeint as c from w group by lang, term having count(distinct id) >= 30),
lt as (select lang, sum(c)::hugeint as n, count(*)::hugeint as v from kept group by lang),
g as (select distinct lang, source from d),
cnt as (select w.lang, w.source, w.term, count(*)::hugeint as n from w join kept using (lang, term) group by 1, 2, 3),
gt as (select lang, source, sum(n)::hugeint as n from cnt group by 1, 2),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (coalesce(gt.n, 0) + 5 * lt.v) as p,
         1 + (1000000000::hugeint * (k.c + 5)) // (lt.n + 5 * lt.v) as q
  from g join kept k using (lang) join lt using (lang) left join gt on gt.lang = g.lang and gt.source = g.source
  left join cnt c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sums as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, 'term' as part, term as item, p - q as value from p where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as r from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, r::int as rank from ranked where part = 'pair' or r <= 50
"""
