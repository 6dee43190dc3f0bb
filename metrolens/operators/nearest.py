"""Nearest site per point by great-circle distance, without a cross join.

The reference pairs every point with every site and keeps the closest with a
window. Here the sites are indexed once and the points walk down the index:

1. Points and sites are reduced to distinct coordinates (partial aggregation,
   so a hot coordinate costs one row per task). Of sites on one coordinate only
   the least key can be nearest.
2. Coordinates become unit vectors. The straight-line distance of two of them
   grows with the great-circle distance, and boxes in space bound it without
   any case for poles, the antimeridian or longitudes beyond 180 degrees.
3. The sites are sorted along a space-filling curve and every ``FAN`` neighbours
   make a node, every ``FAN`` nodes a node above, up to one root. A node holds
   its children as arrays with their boxes. However crowded the sites are, no
   node holds more than ``FAN`` of them.
4. The points are sorted along the same curve, dealt to tasks by ranges of it
   and walked in blocks of neighbours: one row holds a block's points as arrays.
   A block first follows the child nearest to its middle to one leaf, which gives
   each of its points the distance to a real site. With those bounds it walks
   down again into every child whose box some of its points may need, taking
   those points along, and meets the sites of the leaves they reach. The least
   (km, key) a point has met is the exact answer.

Every step of a walk is an equi-join of blocks with one level of the index on
the node's number, and one comparison of all points of a block with all
children of a node in arrays. There is one algorithm for every size; the planner
picks the join of each level. A point that met no site fails the query instead
of being left out.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.functions.geo import haversine_km
from metrolens.operators.joins import MAX_BROADCAST_ROWS, BroadcastRefused, check_strategy
from metrolens.session import materialize_observed

UNITS = ("location", "event")

FAN = 64  # children of a node, and sites of a leaf
BLOCK = 256  # points that walk together
PIECE = 1 << 16  # points that a step hands on at a time

# Steps that spread 21 bits to every third bit (shift, mask).
SPREAD = (
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
)

# Squared straight-line distances below count as equal: rounding of unit vectors.
MARGIN = 1e-13


def usable(lat: str, lon: str) -> Column:
    """Coordinates on the globe: neither NULL, NaN nor infinite, and no latitude beyond a pole."""
    infinite = F.abs(F.col(lon)) == float("inf")
    return F.col(lat).between(-90.0, 90.0) & ~F.isnan(lat) & F.col(lon).isNotNull() & ~F.isnan(lon) & ~infinite


def distinct_points(points: DataFrame, lat: str, lon: str, weight: str = "n") -> DataFrame:
    """Distinct usable coordinates with their number of rows."""
    return (
        points.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        .filter(usable("lat", "lon"))
        .groupBy("lat", "lon")
        .agg(F.count(F.lit(1)).alias(weight))
    )


def distinct_sites(sites: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """One site per usable coordinate: the least key (NULL first), as distance ties go to it."""
    named = sites.select(
        F.col(key).alias("site"), F.col(lat).cast("double").alias("slat"), F.col(lon).cast("double").alias("slon")
    )
    return (
        named.filter(usable("slat", "slon")).groupBy("slat", "slon").agg(F.min(F.struct("site"))["site"].alias("site"))
    )


def unit_vector(lat: str, lon: str) -> list[Column]:
    """``x``, ``y``, ``z`` of a coordinate on the unit sphere."""
    phi, lam = F.radians(lat), F.radians(lon)
    return [(F.cos(phi) * F.cos(lam)).alias("x"), (F.cos(phi) * F.sin(lam)).alias("y"), F.sin(phi).alias("z")]


def curve(*axes: str) -> Column:
    """Place on a Z-order curve: neighbours in space are mostly neighbours on it."""
    out = F.lit(0).cast("long")
    for i, axis in enumerate(axes):
        bits = F.floor((F.col(axis) + 1.0) * float((1 << 20) - 1)).cast("long")
        for shift, mask in SPREAD:
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
        out = out.bitwiseOR(F.shiftleft(bits, i))
    return out


AXES = ("x", "y", "z")
BOX = tuple(f"{side}_{axis}" for side in ("lo", "hi") for axis in AXES)
BLOCK_COLUMNS = ("lat", "lon", "n", *AXES, "reach")
BLOCK_SCHEMA = "lat array<double>, lon array<double>, n array<bigint>, " + ", ".join(
    f"{c} array<double>" for c in (*AXES, "reach")
) + ", " + ", ".join(f"m_{axis} double" for axis in AXES) + ", node bigint"


def _lists(values: pa.Array, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)


def pack_nodes(rows: DataFrame, order: list[Column], columns: list[str], level: str) -> tuple[DataFrame, int, int | None]:
    """Every ``FAN`` rows in ``order`` as one node with the ``columns`` as
    arrays, written: ``node`` rises with the order. Rows have a box (``BOX``);
    the node's own box bounds them. Also the number of nodes and the least."""
    kinds = [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in columns]
    box = [T.StructField(f"own_{c}", T.DoubleType()) for c in BOX]
    schema = T.StructType([T.StructField("node", T.LongType()), *kinds, *box])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        node = TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            edges = np.append(np.arange(0, batch.num_rows, FAN), batch.num_rows)
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            bounds = []
            for c in BOX:
                pick = np.minimum if c.startswith("lo") else np.maximum
                bounds.append(pa.array(pick.reduceat(get(c).to_numpy(), edges[:-1])))
            numbers = pa.array(node + np.arange(len(edges) - 1), pa.int64())
            node += len(edges) - 1
            yield pa.RecordBatch.from_arrays(
                [numbers, *[_lists(get(c), edges) for c in columns], *bounds], names=schema.names
            )

    packed = rows.orderBy(*order).mapInArrow(run, schema)
    done, seen = materialize_observed(packed, level, {"nodes": F.count(F.lit(1)), "first": F.min("node")})
    return done, seen["nodes"], seen["first"]


def site_index(sites: DataFrame) -> list[tuple[DataFrame, int, int | None]]:
    """The levels of the index, leaves first, each ``(nodes, their number, the least)``.

    A leaf's arrays are the coordinates and keys of its sites; above, they are
    the children's numbers and boxes. Every level is written, a small part of
    the one below; the last has one node, or none without sites.
    """
    placed = sites.select("site", "slat", "slon", *unit_vector("slat", "slon"))
    boxed = placed.select("*", *[F.col(c[3:]).alias(c) for c in BOX], curve(*AXES).alias("along"))
    order = [F.col(c) for c in ("along", *AXES, "slat", "slon")]
    levels = [pack_nodes(boxed, order, ["slat", "slon", "site", *AXES], "nearest-leaves")]
    while levels[-1][1] > 1:
        below = levels[-1][0].select(F.col("node").alias("child"), *[F.col(f"own_{c}").alias(c) for c in BOX])
        levels.append(pack_nodes(below, [F.col("child")], ["child", *BOX], "nearest-nodes"))
    return levels


def _get(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _get(batch, name).values.to_numpy(zero_copy_only=False)


def _block_rows(batch: pa.RecordBatch, taken: list[np.ndarray], nodes: list[int | None]) -> pa.RecordBatch:
    """Rows of the given points (as places in the batch's flat arrays) at the given nodes."""
    edges = np.cumsum([0, *map(len, taken)])
    at = pa.array(np.concatenate(taken) if taken else np.zeros(0, np.int64))
    lists = [_lists(_get(batch, c).values.take(at), edges) for c in BLOCK_COLUMNS]
    middle = [pa.nulls(len(nodes), pa.float64())] * 3
    return pa.RecordBatch.from_arrays(
        [*lists, *middle, pa.array(nodes, pa.int64())], names=[*BLOCK_COLUMNS, *[f"m_{a}" for a in AXES], "node"]
    )


def make_blocks(points: DataFrame, root: int) -> DataFrame:
    """Every ``BLOCK`` neighbouring rows as one, at the root, without a bound yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            edges = np.append(np.arange(0, batch.num_rows, BLOCK), batch.num_rows)
            size = np.diff(edges)
            lists = [_lists(_get(batch, c), edges) for c in BLOCK_COLUMNS[:-1]]
            reach = _lists(pa.array(np.full(batch.num_rows, np.inf)), edges)
            middle = [pa.array(np.add.reduceat(_get(batch, a).to_numpy(), edges[:-1]) / size) for a in AXES]
            yield pa.RecordBatch.from_arrays(
                [*lists, reach, *middle, pa.array(np.full(len(size), root))],
                names=[*BLOCK_COLUMNS, *[f"m_{a}" for a in AXES], "node"],
            )

    return points.select(*BLOCK_COLUMNS[:-1]).mapInArrow(run, BLOCK_SCHEMA)


def _edges(batch: pa.RecordBatch, name: str) -> list[int]:
    return _get(batch, name).offsets.to_numpy().tolist()


def _to_sites(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int, np.ndarray | None]]:
    """Per row, the ranges of its points and sites and their squared distances (None without sites)."""
    points, sites = _edges(batch, "lat"), _edges(batch, "slat")
    own, theirs = [_flat(batch, a) for a in AXES], [_flat(batch, f"s_{a}") for a in AXES]
    for i in range(batch.num_rows):
        a, b, c, d = points[i], points[i + 1], sites[i], sites[i + 1]
        if c == d:
            yield a, b, c, d, None
            continue
        far = np.zeros((b - a, d - c))
        for p, q in zip(own, theirs):
            gap = p[a:b, None] - q[None, c:d]
            far += gap * gap
        yield a, b, c, d, far


def bound(met: DataFrame, root: int) -> DataFrame:
    """Blocks at the leaf of their first walk: back to the root with a bound for each point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reach = _flat(batch, "reach").copy()
            for a, b, _, _, far in _to_sites(batch):
                if far is not None:
                    reach[a:b] = far.min(axis=1) + MARGIN
            columns = [_get(batch, c) for c in BLOCK_COLUMNS[:-1]]
            columns.append(_lists(pa.array(reach), _get(batch, "reach").offsets.to_numpy()))
            columns += [_get(batch, f"m_{a}") for a in AXES] + [pa.array(np.full(batch.num_rows, root))]
            yield pa.RecordBatch.from_arrays(columns, names=[*BLOCK_COLUMNS, *[f"m_{a}" for a in AXES], "node"])

    return met.mapInArrow(run, BLOCK_SCHEMA)


def descend(met: DataFrame, marked: bool) -> DataFrame:
    """Blocks met with a node's children: one row per child that some of the
    points need, with those points. With ``marked`` also a row of all points
    without a node, which no later join matches: it stands for them at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, children = _edges(batch, "lat"), _edges(batch, "child")
            own, reach, child = [_flat(batch, a) for a in AXES], _flat(batch, "reach"), _flat(batch, "child")
            boxes = [(_flat(batch, f"lo_{a}"), _flat(batch, f"hi_{a}")) for a in AXES]
            taken: list[np.ndarray] = []
            nodes: list[int | None] = []
            held = 0
            for i in range(batch.num_rows):
                a, b, c, d = points[i], points[i + 1], children[i], children[i + 1]
                if marked or c == d:
                    taken.append(np.arange(a, b))
                    nodes.append(None)
                gaps = np.zeros((b - a, d - c))
                for p, (lo, hi) in zip(own, boxes):
                    gap = np.maximum(lo[None, c:d] - p[a:b, None], p[a:b, None] - hi[None, c:d])
                    np.maximum(gap, 0.0, out=gap)
                    gaps += gap * gap
                need = gaps <= reach[a:b, None]
                for j in np.flatnonzero(need.any(axis=0)).tolist():
                    taken.append(a + np.flatnonzero(need[:, j]))
                    nodes.append(int(child[c + j]))
                    held += len(taken[-1])
                if held > PIECE:
                    yield _block_rows(batch, taken, nodes)
                    taken, nodes, held = [], [], 0
            yield _block_rows(batch, taken, nodes)

    return met.mapInArrow(run, BLOCK_SCHEMA)


def meet_sites(met: DataFrame, site: T.DataType) -> DataFrame:
    """``(lat, lon, n, slat, slon, site)``: each point with the sites of its leaf
    that may be its nearest, or with nulls for a row without sites."""
    names = ["lat", "lon", "n", "slat", "slon", "site"]
    kinds = [T.DoubleType(), T.DoubleType(), T.LongType(), T.DoubleType(), T.DoubleType(), site]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def met_rows(batch: pa.RecordBatch, points: list[np.ndarray], sites: list[np.ndarray]) -> pa.RecordBatch:
            at, of = np.concatenate(points), np.concatenate(sites)
            of = pa.array(of, mask=of < 0)
            return pa.RecordBatch.from_arrays(
                [_get(batch, c).values.take(pa.array(at)) for c in names[:3]]
                + [_get(batch, c).values.take(of) for c in names[3:]],
                names=names,
            )

        for batch in batches:
            reach = _flat(batch, "reach")
            points, sites, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
            for a, b, c, _, far in _to_sites(batch):
                if far is None:
                    points.append(np.arange(a, b))
                    sites.append(np.full(b - a, -1))
                else:
                    least = np.minimum(far.min(axis=1) + MARGIN, reach[a:b])
                    p, q = np.nonzero(far <= least[:, None])
                    points.append(a + p)
                    sites.append(c + q)
                held += len(points[-1])
                if held > PIECE:
                    yield met_rows(batch, points, sites)
                    points, sites, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
            yield met_rows(batch, points, sites)

    return met.mapInArrow(run, schema)


def assign_nearest(
    points: DataFrame,
    sites: DataFrame,
    point_lat: str,
    point_lon: str,
    site_key: str,
    site_lat: str,
    site_lon: str,
    strategy: str = "DEFAULT",
) -> DataFrame:
    """Distinct point -> (lat, lon, n, site, km) with the exact nearest site.

    Ties in distance go to the smallest site key. Coordinates that are NULL,
    NaN, infinite or beyond a pole take no part; without any site the result is
    empty. ``strategy`` is a hint for the joins with the index levels. Building
    the index runs a few jobs over the sites alone; the points' part is lazy.
    """
    check_strategy(strategy)
    pts = distinct_points(points, point_lat, point_lon).select("lat", "lon", "n", *unit_vector("lat", "lon"))
    key = sites.schema[site_key].dataType
    levels = site_index(distinct_sites(sites, site_key, site_lat, site_lon))
    *_, (_, nodes, root) = levels
    if not nodes:
        nothing = [F.lit(None).cast(key).alias("site"), F.lit(None).cast("double").alias("km")]
        return pts.limit(0).select("lat", "lon", "n", *nothing)
    leaves, *upper = [_hinted(level, count, strategy) for level, count, _ in levels]
    leaves = leaves.select("node", "slat", "slon", "site", *[F.col(a).alias(f"s_{a}") for a in AXES])
    upper = [level.select("node", "child", *BOX) for level in reversed(upper)]

    if upper:
        # A stated number of ranges: adaptive execution does not fold them into one task.
        spark = pts.sparkSession
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        pts = pts.withColumn("along", curve(*AXES)).repartitionByRange(tasks, "along").sortWithinPartitions("along")
        # A stage for every step in Python: steps of one stage run side by side, each with workers of its own.
        dealt = lambda df: df.repartition(tasks)
        walk = dealt(make_blocks(pts, root))
        # Down to one leaf: the child nearest to the block's middle each time.
        away = lambda c: sum(
            (F.greatest(c[f"lo_{a}"] - F.col(f"m_{a}"), F.col(f"m_{a}") - c[f"hi_{a}"], F.lit(0.0)) ** 2 for a in AXES),
            F.lit(0.0),
        )
        for level in upper:
            near = F.array_min(
                F.transform(F.arrays_zip("child", *BOX), lambda c: F.struct(away(c).alias("d"), c["child"].alias("child")))
            )
            walk = walk.join(level, "node", "left").withColumn("node", near["child"]).drop("child", *BOX)
        walk = dealt(bound(walk.join(leaves, "node", "left"), root))
        # Down again, into every child that could hold a site as near for any point.
        for i, level in enumerate(upper):
            walk = dealt(descend(walk.join(level, "node", "left"), marked=i == 0))
    else:
        walk = make_blocks(pts, root)
    scored = meet_sites(walk.join(leaves, "node", "left"), key)
    km = haversine_km("lat", "lon", "slat", "slon").alias("km")
    met = F.when(F.col("slat").isNotNull(), F.struct(km, F.col("site")))
    best = scored.groupBy("lat", "lon", "n").agg(F.min(met).alias("b"))
    kept = F.coalesce("b", F.raise_error(F.lit("a point met no site")).cast(best.schema["b"].dataType))
    return best.withColumn("b", kept).select("lat", "lon", "n", F.col("b.site").alias("site"), F.col("b.km").alias("km"))


def _hinted(level: DataFrame, nodes: int, strategy: str) -> DataFrame:
    """An index level with the strategy's hint; a broadcast is checked by the nodes counted while writing."""
    if strategy == "DEFAULT":
        return level
    if strategy == "broadcast" and nodes * FAN > MAX_BROADCAST_ROWS:
        warnings.warn(f"no broadcast: a level has {nodes} nodes", BroadcastRefused, stacklevel=3)
        return level
    return level.hint(strategy)


def nearest_summary(
    assigned: DataFrame,
    unit: str = "location",
    key_name: str = "division",
    count_name: str = "crime_count",
    avg_name: str = "average_distance",
    decimals: int = 3,
) -> DataFrame:
    """Per site: how many points it is nearest to, and their mean distance.

    ``unit="location"`` counts distinct coordinates (what the reference's
    window over (lat, lon) computes); ``unit="event"`` counts every input row.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    if unit == "location":
        aggs = [F.count(F.lit(1)).alias(count_name), F.round(F.avg("km"), decimals).alias(avg_name)]
    else:
        aggs = [
            F.sum("n").alias(count_name),
            F.round(F.try_divide(F.sum(F.col("km") * F.col("n")), F.sum("n").cast("double")), decimals).alias(avg_name),
        ]
    return assigned.groupBy(F.col("site").alias(key_name)).agg(*aggs)


def nearest_join(
    points: DataFrame,
    sites: DataFrame,
    point_lat: str,
    point_lon: str,
    site_key: str,
    site_lat: str,
    site_lon: str,
    unit: str = "location",
    **kwargs,
) -> DataFrame:
    """Points -> nearest site -> per-site count and mean km (query C4)."""
    assigned = assign_nearest(points, sites, point_lat, point_lon, site_key, site_lat, site_lon, **kwargs)
    return nearest_summary(assigned, unit)
