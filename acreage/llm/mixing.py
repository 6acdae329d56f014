"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by the MD5 of the doc_id), gone through
up to ``repeats`` times, and every taken copy gets its virtual finish time:
the source's cumulative words divided by the source's target. All copies are
range-sorted by that time (less half of their own service) and the order is cut where the total budget is
reached. All arithmetic is native and reruns agree.

Defined results: a text without words (null, empty or blank) is never taken; a null source
is a source of its own, last in order; an empty table gives an empty mix;
repeated rows are documents of their own; other columns, of any name, are carried
through; doc_ids of any type; texts of any length are counted whole.
Whole documents are taken, rounded to the nearest: a source's words differ from
its target by about half of the document at the cut at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acreage.llm.running import running_total
from acreage.llm.scratch import written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2
_BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target): the budget shared by weight, no target above ``repeats`` times its source.

    With sources in order of cap / weight, those below the common level are at
    their cap and the rest share what remains by weight. One row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(repeats))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    level = (F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum(
        "_w"
    ).over(order.rowsBetween(0, Window.unboundedFollowing))
    # each is the level at which this source and those after it share what the earlier ones leave; the common level is the largest
    common = F.max("_level").over(Window.partitionBy())
    return capped.withColumn("_level", level).select("source", "source_size", "_rank", F.least("_cap", common * F.col("_w")).alias("target"))


def schedule(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Every copy that could be taken, with ``size``, ``source_size``, ``target``, ``copy``, ``finish``, ``served`` and ``taken``.

    Texts are not carried: ``_row`` tells rows of the same doc_id apart, in order of size and MD5 of the text.
    """
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_h"), F.xxhash64("text").alias("_t")
    )
    sized = written(sized.withColumn("_bucket", F.substring("_h", 1, 3)), "mix-sizes")
    order = ["_h", "doc_id", "size", "_t"]
    placed = running_total(sized, ["source"], "_bucket", order, F.col("size"), "_end").withColumn(
        "_row", F.row_number().over(Window.partitionBy("source", "_bucket").orderBy(*order, "_end"))
    )
    targets = source_targets(sized, weights, share, repeats).withColumnRenamed("source", "_s")
    placed = placed.join(targets, placed["source"].eqNullSafe(targets["_s"]), "left").drop("_s")
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = F.when(F.col("target") > 0, (F.col("copy") * F.col("source_size") + F.col("_end")) / F.col("target")).otherwise(F.lit(0.0))
    copies = copies.withColumn("finish", finish)
    # rounding to the nearest whole document: one takes its turn when half of it would be served
    copies = copies.withColumn("turn", F.when(F.col("target") > 0, F.col("finish") - F.col("size") / (F.col("target") * 2)).otherwise(F.lit(0.0)))
    # words are spread evenly over virtual time, so equal steps of it are ranges of equal size; beyond 2 the steps double
    late = 2 * _BINS + F.floor(F.log2(F.greatest("turn", F.lit(2.0))) * 64)
    copies = copies.withColumn("_bin", F.when(F.col("turn") < 2, F.floor(F.col("turn") * _BINS)).otherwise(late))
    served = running_total(copies.withColumn("_all", F.lit(0)), ["_all"], "_bin", ["turn", "_rank", "copy", "_h", "doc_id", "size", "_t", "_row"], F.col("size"), "served")
    budget = targets.agg((F.sum("source_size") * share).alias("_budget"))
    return served.crossJoin(F.broadcast(budget)).withColumn("taken", (F.col("size") > 0) & (F.col("served") - F.col("size") / 2 <= F.col("_budget"))).drop("_all", "_budget", "_bin", "_end", "_rank")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, in the columns of ``docs``."""
    same = ["doc_id", "source", "size", "_t"]
    row = schedule(docs, weights, share, repeats).where("taken").groupBy(*same, "_bucket", "_row").agg(F.count("*").cast("int").alias("_times"))
    # rows that agree in all of these are interchangeable: they are numbered on both sides
    number = Window.partitionBy(*same)
    row = row.withColumn("_k", F.row_number().over(number.orderBy(F.desc("_times"), "_row"))).drop("_bucket", "_row")
    row = row.withColumnsRenamed({c: f"_r_{c}" for c in same})
    packed = docs.select("doc_id", "source", word_count(F.col("text")).alias("_size"), F.xxhash64("text").alias("_text"), F.struct("*").alias("_doc"))
    keyed = packed.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", "source", "_size", "_text").orderBy(F.lit(1))))
    met = keyed["_n"] == row["_k"]
    for left, right in zip(("doc_id", "source", "_size", "_text"), same, strict=True):
        met &= keyed[left].eqNullSafe(row[f"_r_{right}"])
    return keyed.join(row, met).select("_doc", F.explode(F.sequence(F.lit(1), "_times"))).select("_doc.*")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (
        schedule(docs)
        .groupBy("source", "_bucket", "_row", "doc_id", "size", "source_size", "target")
        .agg(F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


OP1_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as h
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select *, row_number() over (order by source nulls last) - 1 as rk,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as w
  from sources),
levels as (
  select *, 2.0::double * source_size as cap,
         (1.5::double * sum(source_size) over () - coalesce(sum(2.0::double * source_size) over (o rows between unbounded preceding and 1 preceding), 0))
           / sum(w) over (o rows between current row and unbounded following) as lvl
  from ranked window o as (order by 2.0::double * source_size / w, rk)),
targets as (
  select source, source_size, rk,
         least(cap, w * (max(lvl) over ()))::double as target
  from levels),
placed as (
  select s.doc_id, s.source, s.size, s.h, t.source_size, t.rk, t.target,
         sum(s.size) over (partition by s.source order by s.h, s.doc_id, s.size rows between unbounded preceding and current row) as e
  from sized s join targets t on s.source is not distinct from t.source),
copies as (
  select *, case when target > 0 then (copy * source_size + e)::double / target - size / (target * 2) else 0 end as turn
  from placed, (values (0), (1)) c(copy)),
served as (
  select *, sum(size) over (order by turn, rk, copy, h, doc_id, size rows between unbounded preceding and current row) as served
  from copies)
select doc_id, size, source_size, target,
       sum(case when served - size / 2 <= (select 1.5::double * sum(source_size) from targets) then size else 0 end)::bigint as taken
from served group by doc_id, size, source_size, target
"""
