"""Spatial joins on latitude and longitude by grid cells and by a quadtree."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.maths import DEGREE_METERS, EARTH_METERS, geodesic, haversine
from acreage.sources.scratch import settled

#: Sphere and spheroid differ by less than this share of a distance.
_SPHEROID_SLACK = 1.01
#: A quadtree cell with so many places isn't split; none is split deeper.
LEAF_PLACES = 32
#: A cell of left places with so many isn't split.
_LEFT_LEAF = 2_048
#: Rows of each side that a task takes at once.
_LEFT_BLOCK, _RIGHT_BLOCK = 5_000, 20_000
#: Left rows of a block whose pairs Spark joins: every pair may be a row.
_LEFT_PAIRED = 1_000
#: Right rows that are weighed at once, for 128 left ones: half a megabyte of distances.
_AT_ONCE = 512
_DEPTH = 24


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}{c}") for c in df.columns))


class _Bands:
    """Bands of latitude a little higher than a radius, each cut into columns as wide as the radius is at its most poleward edge.

    A circle reaches one band up and down, and the columns there that its own
    longitudes cover; around a pole that is all of them, and there are few.
    No band's columns depend on where other rows lie.
    """

    def __init__(self, meters: float) -> None:
        self.height = min(180.0, meters / DEGREE_METERS * 1.01)
        self.reach = math.radians(self.height)

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.height)

    def width(self, lat: Column) -> Column:
        """Degrees of longitude within the radius on each side of a place; 180 if that goes around a pole."""
        beyond = F.abs(lat) + self.height >= 90
        share = F.lit(math.sin(self.reach)) / F.cos(F.radians(F.when(beyond, 0.0).otherwise(lat)))
        return F.when(beyond, 180.0).otherwise(F.degrees(F.asin(F.least(share, F.lit(1.0)))) * 1.001)

    def columns(self, band: Column) -> Column:
        edge = F.greatest(F.abs(band * self.height - 90), F.abs((band + 1) * self.height - 90))
        return F.greatest(F.floor(F.lit(360.0) / self.width(edge)), F.lit(1))

    def placed(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """The rows, all of which have a place, with their cell; it is never null, so a join on it doesn't make Spark test that for each row before others drop out."""
        banded = df.withColumn("_band", F.coalesce(self.band(F.col(lat)), F.lit(0)))
        return banded.withColumn("_column", F.coalesce(self._column(F.col(lon), self.columns(F.col("_band"))), F.lit(0)))

    def spread(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """The rows with every cell that may hold a place within the radius."""
        own = self.band(F.col(lat))
        rows = df.withColumn("_width", self.width(F.col(lat))).withColumn("_band", F.explode(F.array(own - 1, own, own + 1)))
        rows = rows.withColumn("_columns", self.columns(F.col("_band")))
        first, last = (F.floor((F.col(lon) + sign * F.col("_width") + 180) * F.col("_columns") / 360) for sign in (-1, 1))
        covered = F.when(last - first + 1 >= F.col("_columns"), F.sequence(F.lit(0).cast("long"), F.col("_columns") - 1)).otherwise(F.sequence(first, last))
        return rows.withColumn("_column", F.explode(covered)).withColumn("_column", F.pmod("_column", "_columns")).drop("_width", "_columns")

    def _column(self, lon: Column, columns: Column) -> Column:
        return F.pmod(F.floor((lon + 180) * columns / 360), columns)


def _dealt(left: DataFrame, right: DataFrame, meters: float, by: list[str], most: tuple[int, int], prefix: str = "") -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides in blocks that together hold each pair within ``meters`` once, and the names of a block's keys; the right side's rows are kept apart ``by``.

    A block is a part of a cell's left rows and a part of the rows around the cell; both have a
    bounded size (about ``most``), however full the cell is.
    """
    bands, cell = _Bands(meters), ["_band", "_column"]
    a = bands.placed(left.dropna(subset=["lat", "lon"]), "lat", "lon")
    b = bands.spread(right.dropna(subset=[f"{prefix}lat", f"{prefix}lon"]), f"{prefix}lat", f"{prefix}lon")
    lots = lambda df, keys, name, rows: df.groupBy(*keys).agg(F.ceil(F.count("*") / rows).cast("int").alias(name))
    dealt = settled(lots(a, cell, "_lots", most[0]).join(lots(b, [*cell, *by], "_r_lots", most[1]), cell), "blocks")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda df, n: F.pmod(F.xxhash64(*(c for c, kind in df.dtypes if "map<" not in kind)), F.col(n)).cast("int")
    keys = [*cell, *by, "_lot", "_r_lot"]
    a = a.join(dealt, cell).withColumns({"_lot": own(left, "_lots"), "_r_lot": each("_r_lots")}).select(*keys, *left.columns)
    b = b.join(dealt, [*cell, *by]).withColumns({"_r_lot": own(right, "_r_lots"), "_lot": each("_lots")}).select(*keys, *(c for c in right.columns if c not in by))
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: Spark isn't to merge them
    return a.repartition(n, *keys), b.repartition(n, *keys), keys


def candidate_pairs(left: DataFrame, right: DataFrame, meters: float, prefix: str = "r_") -> DataFrame:
    """All pairs that share a cell: those within ``meters`` and some others. Tasks get them in blocks of bounded size."""
    a, b, keys = _dealt(left, _prefixed(right, prefix), meters, [], (_LEFT_PAIRED, _RIGHT_BLOCK), prefix)
    return a.join(b.hint("merge"), keys).drop(*keys)  # a broadcast would leave all pairs to the tasks that read the left side


def _chord(meters: float) -> float:
    """The straight line between places ``meters`` apart, on the sphere of radius 1."""
    return 2 * math.sin(min(meters / EARTH_METERS, math.pi) / 2)


def _with_vector(df: DataFrame) -> DataFrame:
    """The rows with their place's vector on the sphere of radius 1, as _u0 to _u2."""
    y, x = F.radians("lat"), F.radians("lon")
    return df.withColumns({"_u0": F.cos(y) * F.cos(x), "_u1": F.cos(y) * F.sin(x), "_u2": F.sin(y)})


def radius_join(left: DataFrame, right: DataFrame, meters: float, prefix: str = "r_", degree_circle: float | None = None, spheroid: bool = False) -> DataFrame:
    """All pairs within ``meters``, with ``distance``, also across longitude 180 and around the poles. Both sides have lat and lon; the right side's columns get the prefix.

    Right rows are copied to the cells around them, so the smaller side should
    be the right one. Chords tell most pairs from others; distances are measured for pairs, and
    for what lies at the radius. ``degree_circle`` also asks that
    the pair lies in a circle of so many degrees, as a planar index would.
    ``spheroid``: distances on the spheroid instead of the sphere.
    """
    reach, slack = meters * (_SPHEROID_SLACK if spheroid else 1), 1e-14  # of chords, for rounding
    inner, outer = _chord(meters) * (1 - 1e-9) - slack, _chord(reach) * (1 + 1e-9) + slack
    distance = (geodesic if spheroid else haversine)(F.col("lat"), F.col("lon"), F.col(f"{prefix}lat"), F.col(f"{prefix}lon"))
    apart = [F.col(f"_u{k}") - F.col(f"{prefix}_u{k}") for k in range(3)]
    square = apart[0] * apart[0] + apart[1] * apart[1] + apart[2] * apart[2]
    held = (square <= outer * outer) & (distance <= meters)
    if not spheroid and inner > 0:
        held = (square <= inner * inner) | held
    pairs = candidate_pairs(_with_vector(left), _with_vector(right), reach, prefix).where(held).withColumn("distance", distance)
    pairs = pairs.drop(*(f"{p}_u{k}" for p in ("", prefix) for k in range(3)))
    if degree_circle is not None:
        planar = F.sqrt(F.pow(F.col("lat") - F.col(f"{prefix}lat"), 2) + F.pow(F.col("lon") - F.col(f"{prefix}lon"), 2))
        pairs = pairs.where(planar <= degree_circle)
    return pairs


def _in_blocks(left: DataFrame, right: DataFrame, meters: float, by: list[str], body, schema: str) -> DataFrame:
    """``body(left rows, right rows)``, as pandas, for blocks that together hold each pair within ``meters`` once; the right side's rows are kept apart ``by``."""
    a, b, keys = _dealt(left, right, meters, by, (_LEFT_BLOCK, _RIGHT_BLOCK))
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(body, schema)


def _decayed(square: np.ndarray, held: np.ndarray, scale: float, power: int) -> np.ndarray:
    """exp(-scale * d ^ power) of squares of chords on the sphere of radius 1, 0 where ``held`` is. It uses up ``square``.

    No temporary array is larger than the given ones, which fit a processor's cache. For chords of up to
    0.02 (127 km) the arc is a series that ends below a double's last digit.
    """
    if square.size and square.max() <= 4e-4:
        arc = square * (15 / 336 / 64)
        for term in (3 / 40 / 16, 1 / 6 / 4, 1.0):
            arc += term
            if term != 1.0:
                arc *= square
        arc *= np.sqrt(square, out=square)
    else:
        arc = np.sqrt(square, out=square)
        arc /= 2
        arc = 2 * np.arcsin(np.minimum(arc, 1.0, out=arc), out=arc)
    arc *= EARTH_METERS
    if power != 1:
        np.power(arc, power, out=arc)
    arc *= -scale
    np.exp(arc, out=arc)
    arc *= held
    return arc


def _chunks(meters: float, most: int | None = None):
    """A generator function over two blocks: (indexes of some left rows near each other, indexes of right rows around them, ``most`` at once, squares of their chords, on the sphere of radius 1)."""
    reach = _chord(meters)

    def chunks(a: pd.DataFrame, b: pd.DataFrame):
        def vectors(df):
            y, x = np.radians(df["lat"].to_numpy()), np.radians(df["lon"].to_numpy())
            return np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)])

        u, v = vectors(a), vectors(b)
        strips = np.floor(a["lat"].to_numpy() / (meters / 111000 / 4))
        order = np.lexsort((a["lon"].to_numpy(), strips))
        for first in range(0, len(order), 128):
            rows = order[first : first + 128]
            middle = u[:, rows].mean(axis=1, keepdims=True)
            far = np.sqrt(((u[:, rows] - middle) ** 2).sum(axis=0).max()) + reach * (1 + 1e-6) + 1e-9
            near = np.flatnonzero(((v - middle) ** 2).sum(axis=0) <= far * far)
            for begin in range(0, len(near), most or max(len(near), 1)):
                some = near[begin : begin + (most or len(near))]
                square = np.zeros((len(rows), len(some)))
                for k in range(3):
                    apart = u[k, rows][:, None] - v[k, some][None, :]
                    apart *= apart
                    square += apart
                yield rows, some, square

    return chunks, reach


def sums_around(left: DataFrame, sets: dict[str, tuple[DataFrame, list[str]]], meters: float, scale: float, power: int = 1) -> DataFrame:
    """For each place (lat, lon) of the left side and each set with rows within ``meters``: ``_set``, their number ``n``, and for each of the set's columns, in order, the weighted sum of its values (``sums``) and their weight (``weights``).

    A row at ``d`` meters weighs exp(-scale * d ^ power). Rows at one place are summed
    before, on both sides, so copies of a place cost nothing; pairs of places are never written.
    A column's nulls weigh nothing. Rows may be given for one place and set more than once: add them.
    """
    rows = None
    for name, (df, columns) in sets.items():
        values = [F.col(c).cast("double") for c in columns]
        totals = [F.sum(F.coalesce(v, F.lit(0.0))).alias(f"_s{i}") for i, v in enumerate(values)] + [F.count(v).cast("double").alias(f"_n{i}") for i, v in enumerate(values)]
        listed = F.array(*(F.col(f"_{kind}{i}") for kind in "sn" for i in range(len(columns)))).cast("array<double>")
        placed = df.dropna(subset=["lat", "lon"]).groupBy("lat", "lon").agg(F.count("*").cast("double").alias("_c"), *totals).select("lat", "lon", "_c", listed.alias("_v"), F.lit(name).alias("_set"))
        rows = placed if rows is None else rows.unionByName(placed)
    chunks, reach = _chunks(meters, _AT_ONCE)

    def body(key, a, b):
        if not len(a) or not len(b):
            return pd.DataFrame(columns=["lat", "lon", "_set", "n", "sums", "weights"], dtype=object)
        values = np.stack(b["_v"].to_numpy()).astype(float)
        wide = values.shape[1] // 2
        wild = ~np.isfinite(values)
        values, wild = np.where(wild, 0.0, values), wild.astype(float) if wild.any() else None
        count, n, sums = b["_c"].to_numpy(), np.zeros(len(a)), np.zeros((len(a), 2 * wide))
        for rows, near, square in chunks(a, b):
            held = (square <= reach * reach).astype(float)
            weights = _decayed(square, held, scale, power)
            n[rows] += held @ count[near]
            sums[rows] += weights @ values[near]
            if wild is not None:  # what isn't finite counts for the places around it only
                sums[rows] = np.where(held @ wild[near] > 0, np.nan, sums[rows])
        kept = np.flatnonzero(n)
        return pd.DataFrame({"lat": a["lat"].to_numpy()[kept], "lon": a["lon"].to_numpy()[kept], "_set": key[2], "n": n[kept].astype("int64"), "sums": pd.Series(list(sums[kept, :wide]), dtype=object), "weights": pd.Series(list(sums[kept, wide:]), dtype=object)})

    return _in_blocks(left.select("lat", "lon").distinct(), settled(rows, "places"), meters, ["_set"], body, "lat double, lon double, _set string, n long, sums array<double>, weights array<double>")


def nearest_around(left: DataFrame, right: DataFrame, tie: str, meters: float, k: int = 10) -> DataFrame:
    """For each place (lat, lon) of the left side its ``k`` nearest right rows within ``meters``: ``tie``, ``distance`` and ``place`` from 1. Equal distances go to the least ``tie``.

    Places of the left side are looked at once. Tasks find k of each block and all that
    may be as near; Spark measures these again and ranks them.
    """
    rank = F.row_number().over(Window.partitionBy("lat", "lon").orderBy(tie))  # Spark keeps k of each task's rows before the shuffle
    places = right.select("lat", "lon", tie).dropna(subset=["lat", "lon"]).withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
    chunks, reach = _chunks(meters)
    most = (reach * (1 + 1e-9)) ** 2 + 1e-24

    def body(key, a, b):
        found = []
        for rows, near, square in chunks(a, b) if len(a) and len(b) else ():
            bound = np.full((len(rows), 1), most)
            if len(near) > k:
                bound = np.minimum(bound, np.partition(square, k - 1, axis=1)[:, k - 1 : k] * (1 + 1e-9) + 1e-24)
            i, j = np.nonzero(square <= bound)
            found.append((rows[i], near[j]))
        i, j = (np.concatenate([f[side] for f in found] or [np.zeros(0, int)]) for side in (0, 1))
        return pd.DataFrame({"lat": a["lat"].to_numpy()[i], "lon": a["lon"].to_numpy()[i], "_y": b["lat"].to_numpy()[j], "_x": b["lon"].to_numpy()[j], tie: b[tie].to_numpy()[j]})

    kind = dict(right.dtypes)[tie]
    pairs = _in_blocks(left.select("lat", "lon").distinct(), settled(places, "places"), meters, [], body, f"lat double, lon double, _y double, _x double, `{tie}` {kind}")
    near = pairs.withColumn("distance", haversine(F.col("lat"), F.col("lon"), F.col("_y"), F.col("_x"))).where(F.col("distance") <= meters)
    place = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("distance", tie))
    return near.withColumn("place", place).where(F.col("place") <= k).drop("_y", "_x")


def radius_join_by_place(left: DataFrame, right: DataFrame, meters: float, columns: list[Column], prefix: str = "r_") -> DataFrame:
    """Each left row with ``columns`` of all its pairs within ``meters``, as ``radius_join``, but made once for each place of the left side.

    The rows of a place are dealt into shares of bounded size, however many lie there.
    """
    rows, hashed = left.dropna(subset=["lat", "lon"]), [c for c, kind in left.dtypes if "map<" not in kind]
    counts = rows.groupBy("lat", "lon").agg(F.ceil(F.count("*") / _LEFT_PAIRED).cast("int").alias("_shares"))
    places = settled(counts.withColumn("_place", F.monotonically_increasing_id()), "places")
    found = radius_join(places, right, meters, prefix).select("_place", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share"), *columns)
    dealt = rows.join(places, ["lat", "lon"]).withColumn("_share", F.pmod(F.xxhash64(*hashed), F.col("_shares")).cast("int")).drop("_shares")
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # as above: few bytes, many pairs
    keys = ["_place", "_share"]
    return dealt.repartition(n, *keys).join(found.repartition(n, *keys).hint("merge"), keys).drop(*keys)


def planar_degrees(prefix: str) -> Column:
    """Degrees on the plane, the shorter way around."""
    apart = F.abs(F.col("lon") - F.col(f"{prefix}lon"))
    return F.sqrt(F.pow(F.col("lat") - F.col(f"{prefix}lat"), F.lit(2.0)) + F.pow(F.least(apart, F.abs(360 - apart)), F.lit(2.0)))


class _Quadtree:
    """Square cells over the places' bounding box, split into 16 while they hold more than ``leaf`` places."""

    def __init__(self, places: DataFrame, lat: str, lon: str, leaf: int) -> None:
        self.lat, self.lon = lat, lon
        low_y, low_x, high_y, high_x = places.agg(F.min(lat), F.min(lon), F.max(lat), F.max(lon)).first()
        self.y, self.x = low_y or 0.0, low_x or 0.0
        self.size = max((high_y or 0.0) - self.y, (high_x or 0.0) - self.x, 1e-9)
        rows = places.withColumns({"_y": self._place(F.col(lat), self.y), "_x": self._place(F.col(lon), self.x), "_level": F.explode(F.sequence(F.lit(0), F.lit(_DEPTH), F.lit(2)))})
        at = rows.withColumns({"_y": self._up(F.col("_y")), "_x": self._up(F.col("_x"))})
        # a row per cell and level: the levels are counted in one pass, whatever their number
        counts = settled(at.groupBy("_level", "_y", "_x").agg(F.count("*").alias("_n")), "quadtree-counts")
        whole = (F.col("_n") <= leaf) | (F.col("_level") == _DEPTH)
        parents = counts.where(~whole).select(F.col("_level").alias("_p"), F.col("_y").alias("_py"), F.col("_x").alias("_px"))
        cells = counts.withColumns({"_p": F.col("_level") - 2, "_py": F.shiftright("_y", 2), "_px": F.shiftright("_x", 2)})
        kept = cells.join(parents, ["_p", "_py", "_px"], "left_semi").unionByName(cells.where("_level = 0"))
        self.cells = settled(kept.withColumn("_whole", whole), "quadtree-cells")
        self.places = settled(at.join(self.cells.where("_whole").select("_level", "_y", "_x"), ["_level", "_y", "_x"]), "quadtree-places")

    def _place(self, value: Column, low: float) -> Column:
        return F.least(F.floor((value - low) / self.size * (1 << _DEPTH)), F.lit((1 << _DEPTH) - 1))

    def _up(self, at: Column) -> Column:
        """The cell at the row's level."""
        return F.floor(at / F.pow(F.lit(2.0), _DEPTH - F.col("_level")))

    def gaps(self) -> tuple[Column, Column]:
        """The least and the greatest distance of a row's lat and lon from its cell, in degrees, the shorter way around. Slack covers rounding."""
        side = F.lit(self.size) / F.pow(F.lit(2.0), F.col("_level"))
        bottom, left = self.y + F.col("_y") * side, self.x + F.col("_x") * side
        beyond = lambda v, low: F.greatest(low - v, v - low - side, F.lit(0.0))
        within = lambda v, low: F.greatest(F.abs(v - low), F.abs(v - low - side))
        turned = [F.col("lon") + k for k in (-360, 0, 360)]
        near = F.hypot(beyond(F.col("lat"), bottom), F.least(*(beyond(v, left) for v in turned)))
        far = F.hypot(within(F.col("lat"), bottom), F.least(*(within(v, left) for v in turned)))
        return near - 1e-9, far + 1e-9


def _near_cells(tree: _Quadtree, spots: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, lat, lon, _r, cell, its _n): for each spot (keys, lat, lon, _r) the undivided cells that may hold one of the ``k`` nearest rows of a place within ``_r`` degrees of it.

    All spots go down the quadtree in step: of the cells that each still looks at, those count that begin within the
    distance in which the cells surely hold k rows. Each step is written.
    """
    open_ = spots.join(tree.cells.where("_level = 0").drop("_p", "_py", "_px"))  # one row on the right
    near, far = tree.gaps()
    by_spot = Window.partitionBy(*keys)
    upto = by_spot.orderBy("_far").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        going = open_.where("not _whole").select(*spots.columns, *(F.col(c).alias(p) for c, p in (("_level", "_p"), ("_y", "_py"), ("_x", "_px"))))
        reached = going.join(tree.cells, ["_p", "_py", "_px"]).drop("_p", "_py", "_px").unionByName(open_.where("_whole"))
        measured = reached.withColumns({"_near": near - F.col("_r"), "_far": far + F.col("_r")}).withColumn("_held", F.sum("_n").over(upto))
        bounded = measured.withColumn("_bound", F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(by_spot))
        kept = bounded.where(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound")))
        open_ = settled(kept.drop("_near", "_far", "_held", "_bound"), "nearest-open")
        if not open_.where("not _whole").limit(1).count():
            return open_


def _nearest_of_blocks(a: DataFrame, b: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(lat, lon, _row): for each place of ``a`` the k nearest rows (_row, _y, _x) that ``b`` has under the same keys, and all that may be as near."""

    def body(a, b):
        found = []
        y, x = (b[c].to_numpy() for c in ("_y", "_x"))
        lat, lon = (a[c].to_numpy() for c in ("lat", "lon"))
        for first in range(0, len(a) if len(b) else 0, 128):
            apart = np.abs(lon[first : first + 128, None] - x)
            square = (lat[first : first + 128, None] - y) ** 2 + np.minimum(apart, np.abs(360 - apart)) ** 2
            bound = np.partition(square, min(k, len(b)) - 1, axis=1)[:, min(k, len(b)) - 1 : min(k, len(b))]
            i, j = np.nonzero(square <= bound * (1 + 1e-9) + 1e-24)
            found.append((i + first, j))
        i, j = (np.concatenate([f[side] for f in found] or [np.zeros(0, int)]) for side in (0, 1))
        return pd.DataFrame({"lat": lat[i], "lon": lon[i], "_row": b["_row"].to_numpy()[j]})

    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(body, "lat double, lon double, _row long")


def nearest_k(left: DataFrame, right: DataFrame, key: str, tie: str, k: int = 1, prefix: str = "r_", leaf: int = LEAF_PLACES) -> DataFrame:
    """Each left row with its ``k`` nearest right rows in planar degrees, the shorter way around: ``place`` from 1, ``distance`` = degrees * 111000. Ties go to the least ``tie``.

    ``key`` is unique on the left; rows without a coordinate have no place on either
    side. Right rows at one place count up to k times. The left side's places, each once, are put into cells of
    a quadtree of their own; these go down the right side's and tasks compare a cell's places with the rows of the cells around it.
    Where those are too many for a task, places go down one by one. Spark measures what may be nearest again and ranks it.
    """
    rank = F.row_number().over(Window.partitionBy("lat", "lon").orderBy(tie))  # Spark keeps k of each task's rows before the shuffle
    places = right.dropna(subset=["lat", "lon"]).withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
    other = settled(_prefixed(places, prefix).withColumn("_row", F.monotonically_increasing_id()), "nearest-places")
    tree = _Quadtree(other, f"{prefix}lat", f"{prefix}lon", leaf)
    points = left.dropna(subset=["lat", "lon"])
    own = _Quadtree(settled(points.select("lat", "lon").distinct(), "nearest-spots"), "lat", "lon", _LEFT_LEAF)
    cell = ["_l", "_ly", "_lx"]
    named = [F.col(c).alias(n) for c, n in zip(("_level", "_y", "_x"), cell, strict=True)]
    side = F.lit(own.size) / F.pow(F.lit(2.0), F.col("_level"))
    middle = [(low + (F.col(c) + 0.5) * side).alias(n) for low, c, n in ((own.y, "_y", "lat"), (own.x, "_x", "lon"))]
    near = _near_cells(tree, own.cells.where("_whole").select(*named, *middle, (side * 0.7072 + 1e-9).alias("_r")), cell, k)
    near = settled(near.drop("lat", "lon").withColumn("_all", F.sum("_n").over(Window.partitionBy(*cell))), "nearest-cells")
    spots = own.places.select("lat", "lon", *named)
    few = near.where(F.col("_all") <= _RIGHT_BLOCK)
    rows = few.join(tree.places.select("_level", "_y", "_x", F.col(f"{prefix}lat").alias("_py"), F.col(f"{prefix}lon").alias("_px"), "_row"), ["_level", "_y", "_x"])
    blocks = _nearest_of_blocks(spots.join(few.select(*cell).distinct(), cell), rows.select(*cell, "_row", F.col("_py").alias("_y"), F.col("_px").alias("_x")), cell, k)
    pairs = blocks.join(other, "_row")
    many = near.where(F.col("_all") > _RIGHT_BLOCK).select(*cell).distinct()
    if many.limit(1).count():
        alone = _near_cells(tree, spots.join(many, cell).select("lat", "lon", F.lit(0.0).alias("_r")), ["lat", "lon"], k)
        pairs = pairs.unionByName(alone.select("lat", "lon", "_level", "_y", "_x").join(tree.places, ["_level", "_y", "_x"]).select(*pairs.columns))
    place = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("_degrees", f"{prefix}{tie}"))
    ranked = pairs.withColumn("_degrees", planar_degrees(prefix)).withColumn("place", place).where(F.col("place") <= k)
    found = ranked.select("lat", "lon", *(c for c in other.columns if c != "_row"), "place", (F.col("_degrees") * DEGREE_METERS).alias("distance"))
    return points.join(found, ["lat", "lon"]).select(*points.columns, *(c for c in found.columns if c not in ("lat", "lon")))


def nearest(left: DataFrame, right: DataFrame, key: str, tie: str, prefix: str = "r_") -> DataFrame:
    """Each left row with its nearest right row, as ``nearest_k``."""
    return nearest_k(left, right, key, tie, 1, prefix).drop("place")


def top_k(pairs: DataFrame, keys: list[str], item: str, k: int = 10) -> DataFrame:
    """The k nearest items per key as a list of structs (distance, item), in order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("distance", item))
    near = pairs.select(*keys, "distance", item).withColumn("_rank", rank).where(F.col("_rank") <= k)
    return near.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("distance", item))).alias("nearest"))


def within(left: DataFrame, right: DataFrame, key: str, meters: float) -> DataFrame:
    """Left rows with a right row within the radius."""
    spots = nearest_around(left, right.select("lat", "lon", F.lit(0).alias("_any")), "_any", meters, 1).select("lat", "lon")
    return left.join(spots, ["lat", "lon"], "left_semi").select(*left.columns)


def resolve_sources(first: DataFrame, second: DataFrame, key: str, texts: list[str], meters: float = 45.72) -> DataFrame:
    """Rows of ``second`` without a twin in ``first``: none within the radius on the spheroid, none that agrees in all texts in any case."""
    spots = radius_join(second.select("lat", "lon").distinct(), first.select("lat", "lon").distinct(), meters, spheroid=True).select("lat", "lon").distinct()
    near = second.select(key, "lat", "lon").join(spots, ["lat", "lon"]).select(key)
    same = second.select(key, *(F.lower(t).alias(t) for t in texts)).join(first.select(*(F.lower(t).alias(t) for t in texts)).distinct(), texts).select(key)
    return second.join(near.unionByName(same).distinct(), key, "left_anti")
