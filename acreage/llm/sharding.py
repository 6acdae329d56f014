"""Sharding by a k-d tree over document metadata.

Documents with equal texts form one unit. The tree splits the units at the
weighted median of the widest metadata dimension, where the weight is bytes,
until each leaf is one shard (or holds at most the target bytes). Medians are
found by counting bytes in ranges of the dimension and looking closer into
the range that holds the median; the driver sees one row per tree node.

Law ``bytes``: the shards' sizes are near equal. Equal texts stay together
unless they hold more than half a shard; such a unit is cut into pieces by
the hash of doc_id.

Defined results: a null text has 0 bytes, size 1 and the CRC of no bytes, and
all null texts are equal; texts are told apart by 64-bit hashes, so two that collide would be one unit (no row is lost); null metadata are the least value; repeated rows
are rows of their own; texts of any length have their own size; an empty table gives
no rows; doc_ids of any type; other columns, of any name, are carried by ``shard``,
which replaces those with the names it adds.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acreage.llm.running import running_total
from acreage.llm.scratch import written

SHARDS = 8
DIMENSIONS = ("n_chars", "source", "lang")
_TIE_BITS = 40
_RANGES = 1024
_SLOT_BUCKETS = 1024
_CLOSE = 0.0005


def _coordinate(docs: DataFrame, name: str) -> Column:
    """A double that follows the order of the column; strings by their first six bytes."""
    if dict(docs.dtypes)[name] in ("string", "binary"):
        head = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0")
        return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(0.0))
    return F.log2(F.greatest(F.coalesce(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0)) + 1)


def _units(rows: DataFrame, n_dims: int, n_shards: int) -> tuple[DataFrame, int]:
    """(_unit, _piece, _w, _k0...): pieces with one integer key per dimension, whose low bits break ties by hash."""
    units = rows.groupBy("_unit").agg(F.sum("size").alias("_w"), *(F.min(f"_c{d}").alias(f"_c{d}") for d in range(n_dims)))
    ends = units.agg(F.sum("_w"), *(f(f"_c{d}") for d in range(n_dims) for f in (F.min, F.max))).first()
    total = ends[0] or 0
    most = max(total / n_shards / 2, 1.0)
    pieces = F.when(F.col("_w") > most, F.ceil(F.col("_w") / F.lit(most / 4))).otherwise(F.lit(1)).cast("int")
    cut = units.withColumn("_pieces", pieces).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    tie = F.xxhash64("_unit", "_piece").bitwiseAND(F.lit((1 << _TIE_BITS) - 1))
    keys = []
    for d in range(n_dims):
        low, high = ends[1 + 2 * d] or 0.0, ends[2 + 2 * d] or 0.0
        spread = (F.col(f"_c{d}") - F.lit(low)) / F.lit(high - low) if high > low else F.lit(0.0)
        keys.append((F.floor(spread * ((1 << 20) - 1)) * (1 << _TIE_BITS) + tie).alias(f"_k{d}"))
    return cut.select("_unit", "_piece", (F.col("_w") / F.col("_pieces")).alias("_w"), *keys), total


def _of_node(rows: list[dict | None], schema: str) -> Column:
    """What the list has for a row's ``_node``. It enters the plan as one JSON text, which is parsed once, so that trees of many nodes are no burden."""
    return F.get(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>"), F.col("_node"))


def _key(n_dims: int) -> Column:
    return F.element_at(F.array(*(F.col(f"_k{d}") for d in range(n_dims))), F.col("dim") + 1)


def _medians(nodes: DataFrame, n_dims: int, shares: dict[int, float]) -> dict[int, tuple[int, int]]:
    """For each node its widest dimension and the key to cut at, so that about the share of its weight lies below."""
    spread = [((F.max(f"_k{d}") - F.min(f"_k{d}")) / (1 << _TIE_BITS)).alias(f"s{d}") for d in range(n_dims)]
    ends = [f(f"_k{d}").alias(f"{f.__name__}{d}") for d in range(n_dims) for f in (F.min, F.max)]
    found = {r["_node"]: r for r in nodes.groupBy("_node").agg(F.sum("_w").alias("w"), *spread, *ends).collect() if r["_node"] in shares}
    state = {}
    for node, r in found.items():
        d = max(range(n_dims), key=lambda d: (r[f"s{d}"], -d))
        state[node] = {"dim": d, "low": r[f"min{d}"], "high": r[f"max{d}"] + 1, "before": 0.0, "goal": r["w"] * shares[node], "close": r["w"] * _CLOSE, "cut": None}
    while open_ := {n: s for n, s in state.items() if s["cut"] is None}:
        for s in open_.values():
            s["step"] = max(1, -(-(s["high"] - s["low"]) // _RANGES))
        rows = [{k: open_[n][k] for k in ("dim", "low", "high", "before", "goal", "step")} if n in open_ else None for n in range(max(open_) + 1)]
        wanted = _of_node(rows, "dim: int, low: bigint, high: bigint, before: double, goal: double, step: bigint")
        inside = nodes.withColumn("_at", wanted).where("_at is not null").select("*", "_at.*").withColumn("_key", _key(n_dims)).where("_key >= low and _key < high")
        bins = inside.groupBy("_node", "before", "goal", F.floor((F.col("_key") - F.col("low")) / F.col("step")).alias("_bin")).agg(F.sum("_w").alias("_w"))
        upto = F.sum("_w").over(Window.partitionBy("_node").orderBy("_bin")) + F.col("before")
        reached = bins.withColumn("_upto", upto).where(F.col("_upto") >= F.col("goal") - 1e-6).groupBy("_node").agg(F.min_by(F.struct("_bin", "_w", "_upto"), "_bin").alias("b"))
        for r in reached.collect():  # one row per node
            s, b = open_[r["_node"]], r["b"]
            low = s["low"] + b["_bin"] * s["step"]
            high, before = low + s["step"], b["_upto"] - b["_w"]
            if b["_w"] <= s["close"] or high - low == 1:
                s["cut"] = high if abs(b["_upto"] - s["goal"]) < abs(before - s["goal"]) else low
            s |= {"low": low, "high": high, "before": before}
    return {n: (s["dim"], s["cut"]) for n, s in state.items()}


def _measured(docs: DataFrame, dimensions: tuple[str, ...], *more: Column) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, _unit, _c0..., more) of each row, and the number of coordinates."""
    coordinates = [_coordinate(docs, d) for d in dimensions if d in docs.columns] or [F.lit(0.0)]
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_unit"),
        *(c.alias(f"_c{d}") for d, c in enumerate(coordinates)),
        *more,
    ), len(coordinates)


def _placed(rows: DataFrame, n_dims: int, n_shards: int, target_bytes: int | None) -> DataFrame:
    """Written rows with ``law``, ``shard``, ``slot`` and ``grown_shard``."""
    rest = [c for c in rows.columns if c not in {f"_c{d}" for d in range(n_dims)}]
    if target_bytes:
        n_shards = max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    units, total = _units(rows, n_dims, n_shards)
    nodes = written(units.withColumn("_node", F.lit(0)), "shard-units")
    tree = [(0, n_shards)]
    while total and any(n > 1 for _, n in tree):
        cuts = _medians(nodes, n_dims, {i: (n // 2) / n for i, (_, n) in enumerate(tree) if n > 1})
        children, base = [], []
        for i, (first, n) in enumerate(tree):
            base.append(len(children))
            children += [(first, n // 2), (first + n // 2, n - n // 2)] if i in cuts else [(first, n)] if n == 1 else [(first, 1)]
        each = [{"dim": cuts.get(i, (0, 0))[0], "cut": cuts.get(i, (0, 1 << 62))[1], "base": base[i]} for i in range(len(tree))]
        pieces = [c for c in nodes.columns if c != "_node"]
        steps = nodes.withColumn("_at", _of_node(each, "dim: int, cut: bigint, base: int")).select("*", "_at.*")
        nodes = steps.select(*pieces, (F.col("base") + (_key(n_dims) >= F.col("cut")).cast("int")).alias("_node"))
        tree = children
    leaf = _of_node([{"shard": first} for first, _ in tree], "shard: int")["shard"]
    homes = nodes.withColumn("_s", leaf).groupBy("_unit").agg(F.transform(F.array_sort(F.collect_list(F.struct("_piece", "_s"))), lambda x: x["_s"]).alias("_homes"))  # at most 8 pieces a shard
    homes = written(homes, "shard-homes")  # so that a hot text's rows can be split in the join
    placed = rows.join(homes, "_unit").withColumn(
        "shard", F.element_at("_homes", (F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.size("_homes").cast("long")) + 1).cast("int"))
    )
    placed = placed.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(_SLOT_BUCKETS))).select(*rest, "shard", "_bucket")
    placed = written(placed, "shard-placed")
    slots = running_total(placed, ["shard"], "_bucket", ["doc_id", "size", "text_crc32", "_unit"], F.lit(1).cast("long"), "slot")
    return slots.withColumns({"slot": F.col("slot") - 1, "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


_NEW = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def assign(docs: DataFrame, n_shards: int = SHARDS, target_bytes: int | None = None, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row; texts aren't moved."""
    rows, n_dims = _measured(docs, dimensions)
    placed = _placed(written(rows, "shard-rows"), n_dims, n_shards, target_bytes)
    return placed.select("doc_id", *_NEW)


def shard(docs: DataFrame, n_shards: int = SHARDS, target_bytes: int | None = None, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """The rows of ``docs``, texts included, with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``; texts are shuffled once."""
    rest = [c for c in docs.columns if c.lower() not in _NEW]
    doc = F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_doc")
    rows, n_dims = _measured(docs, dimensions, doc, F.monotonically_increasing_id().alias("_row"))
    rows = written(rows, "shard-rows")  # a row's number holds from here on
    placed = _placed(rows.drop("_doc"), n_dims, n_shards, target_bytes).select("_row", *_NEW)
    return rows.select("_row", "_doc").join(written(placed, "shard-slots"), "_row").select("_doc.*", *_NEW)


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
