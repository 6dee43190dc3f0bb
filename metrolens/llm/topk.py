"""Exact top-k search by inner product: best-first search of paged M-trees.

Components become integers, so scores are exact. With M the largest norm, the
point ``(x, sqrt(M^2 - |x|^2))`` lies at the Euclidean distance
``sqrt(|q|^2 + M^2 - 2 q.x)`` from ``(q, 0)``: the highest scores are the
nearest points of a metric space, whose triangle inequality prunes.

Equal vectors are one point with its k + 1 smallest ids, the only ones that can
be among a query's k best beside its own row, and equal queries are searched
once. Points go to the nearest of some sampled pivots; the points of a pivot
are dealt to trees of bounded size. A tree is a set of pages: each entry has
its vector, a covering radius (inner pages) and its distance to the page's
routing vector, which rules entries out before their distance is computed. A
query searches the tree that holds it, which gives it a bound, then the roots
of all trees in blocks, and then only the trees whose root's bound is not worse.

Vectors that are null or hold a null, NaN or infinite component take no part,
nor do those without an id. Rows that repeat an id and a vector count once.
Vectors of different lengths are not compared. Scores beyond 64 bits saturate.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metrolens.llm.common import lean, materialize, materialize_observed, table

SCALE = 256
K = 5
EVERY = 50
TREE_ROWS = 2048  # points of a tree, about
MOST_PIVOTS = 256  # sampled pivots that points are dealt by
PAGE = 64  # entries of a page
QUERY_BLOCK = 4096  # queries that a task searches a tree for
ROOT_BLOCK = 4096  # roots that a task compares its queries with
SLACK = 1e-5  # rounding of distances, relative to the norms


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, v, norm)``: floored multiples of the components as packed doubles; unusable rows are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.columns
            usable = ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
            size = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            for dim in np.unique(size[usable]):  # one length in all but odd tables
                at = np.flatnonzero(usable & (size == dim))
                given = vectors.take(pa.array(at))
                values = given.flatten().cast(pa.float64())
                missing = values.is_null().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                x = np.floor(scale * values.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(at), dim)) + 0.0
                sound = np.flatnonzero(np.isfinite(x).all(axis=1) & ~missing.any(axis=1))
                x = np.ascontiguousarray(x[sound])  # adding 0.0 above leaves no negative zero
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at[sound])),
                        pa.array([row.tobytes() for row in x], pa.binary()),
                        pa.array(np.einsum("ij,ij->i", x, x)),
                    ],
                    names=["id", "v", "norm"],
                )

    narrow = rows.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{vector_col}`"))
    return narrow.mapInArrow(lean(run), "id long, v binary, norm double")


def unpack(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Points with the added component that brings all to the norm of ``top`` = M^2."""
    rest = np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products (queries by points) of integer-valued doubles."""
    if not queries.size or not points.size:
        return np.zeros((len(queries), len(points)))
    most = float(np.abs(points).max()) * float(np.abs(queries).max()) * queries.shape[1]
    if most < 2.0**53:
        return queries @ points.T
    if most < 2.0**63:
        return queries.astype(np.int64) @ points.astype(np.int64).T
    exact = [[sum(int(a) * int(b) for a, b in zip(q, p)) for p in points] for q in queries]
    return np.array([[min(max(s, -(2**63)), 2**63 - 1) for s in row] for row in exact], np.int64)


def distances(score: np.ndarray | float, norm: float, top: float) -> np.ndarray:
    """Metric distances of the points with these scores from a query of squared length ``norm``."""
    return np.sqrt(np.maximum(0.0, norm + top - 2.0 * np.asarray(score, np.float64)))


def slack_of(norm: float, top: float) -> float:
    """More than rounding can add to a distance."""
    return SLACK * (np.sqrt(top) + np.sqrt(norm) + 1.0)


class Page:
    """A node of an M-tree: entries with covering radii and distances to the page's routing vector."""

    __slots__ = ("leaf", "x", "radius", "away", "child", "ids")

    def __init__(self, leaf, x, radius, away, child, ids):
        self.leaf, self.x, self.radius, self.away, self.child, self.ids = leaf, x, radius, away, child, ids


def build_pages(x: np.ndarray, ids: list[list[int]], top: float, page: int = PAGE) -> tuple[list[Page], float]:
    """Pages of a tree over ``x`` (root first) and the radius around its routing vector, ``x[0]``."""
    points = lifted(x, top)
    pages: list[Page] = []

    def away_from(rows: np.ndarray, pivot: int) -> np.ndarray:
        return np.sqrt(((points[rows] - points[pivot]) ** 2).sum(axis=1))

    todo = [(np.arange(len(x)), 0, None, 0)]  # rows, routing row, parent page, its entry
    while todo:
        rows, pivot, parent, entry = todo.pop()
        at = len(pages)
        if parent is not None:
            pages[parent].child[entry] = at
        if len(rows) <= page:
            pages.append(Page(True, x[rows], None, away_from(rows, pivot), None, [ids[r] for r in rows]))
            continue
        fan = min(page, -(-len(rows) // page))
        # Routing vectors far from each other, each point to its nearest, as long as that has room.
        chosen = [pivot]
        near = away_from(rows, pivot)
        owner = np.zeros(len(rows), np.int64)
        while len(chosen) < max(2, fan):
            chosen.append(int(rows[near.argmax()]))
            d = away_from(rows, chosen[-1])
            owner[d < near] = len(chosen) - 1
            near = np.minimum(near, d)
        parts = [rows[owner == i] for i in range(len(chosen))]
        kept = [(c, p) for c, p in zip(chosen, parts) if len(p)]
        radius = np.array([away_from(p, c).max() for c, p in kept])
        routing = np.array([c for c, _ in kept])
        pages.append(
            Page(False, x[routing], radius, away_from(routing, pivot), np.zeros(len(kept), np.int64), None)
        )
        todo.extend((p, c, at, i) for i, (c, p) in enumerate(kept))
    radius = float(away_from(np.arange(len(x)), 0).max())
    return pages, radius


NOTHING = -(2**63)  # below every score that counts


class Best:
    """The ``k`` best (score, id) of every query, best first; ids of free places are the largest."""

    def __init__(self, queries: int, k: int, known: np.ndarray):
        self.score = np.full((queries, k), NOTHING, np.int64)
        self.id = np.full((queries, k), np.iinfo(np.int64).max, np.int64)
        self.known = known  # a score that the caller's k-th already has, or NOTHING

    def least(self) -> np.ndarray:
        """What a candidate must reach to count."""
        return np.maximum(self.score[:, -1], self.known)

    def offer(self, rows: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        """Merge candidates (rows by points, ``NOTHING`` where ruled out), ties to smaller ids."""
        every = np.hstack([self.score[rows], found])
        named = np.hstack([self.id[rows], np.broadcast_to(ids, found.shape)])
        named[every == NOTHING] = np.iinfo(np.int64).max
        order = np.lexsort((named, -np.maximum(every, NOTHING + 1)), axis=1)[:, : self.score.shape[1]]
        self.score[rows] = np.take_along_axis(every, order, axis=1)
        self.id[rows] = np.take_along_axis(named, order, axis=1)


def search(
    pages: list[Page], radius: float, root: np.ndarray, queries: np.ndarray, k: int, top: float, known: np.ndarray
) -> Best:
    """Best-first search of one tree for a block of queries.

    The page whose nearest waiting query has the least lower bound comes next,
    for the queries it can still improve. An entry's distance is computed only
    if its stored distance to the page's routing vector does not rule it out.
    """
    norm = np.einsum("ij,ij->i", queries, queries)[:, None]
    slack = slack_of(norm, top)
    best = Best(len(queries), k, known)

    def reach(rows: np.ndarray) -> np.ndarray:
        least = best.least()[rows][:, None]
        return np.where(least == NOTHING, np.inf, distances(least, norm[rows], top) + slack[rows])

    rows = np.arange(len(queries))
    dist = distances(scores(queries, root[None, :]), norm, top)
    low = np.maximum(0.0, dist - radius)
    heap = [(float(low.min(initial=np.inf)), 0, 0, rows, low[:, 0], dist[:, 0])]
    pushed = 0
    while heap:
        _, _, at, rows, low, dist = heapq.heappop(heap)
        page = pages[at]
        limit = reach(rows)
        gap = np.abs(dist[:, None] - page.away[None, :])
        wanted = ((gap if page.leaf else gap - page.radius[None, :]) <= limit) & (low[:, None] <= limit)
        keep, cols = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        if not keep.size:
            continue
        rows, low, wanted, limit = rows[keep], low[keep], wanted[np.ix_(keep, cols)], limit[keep]
        s = scores(queries[rows], page.x[cols])
        if page.leaf:
            s = s.astype(np.int64)
            hit = wanted & (s >= best.least()[rows][:, None])
            some = np.flatnonzero(hit.any(axis=1))
            if some.size:
                held = [page.ids[c] for c in cols]
                ids = np.array([i for named in held for i in named], np.int64)
                times = [len(named) for named in held]
                offered = np.where(hit, s, NOTHING)[some]
                best.offer(rows[some], np.repeat(offered, times, axis=1), ids)
            continue
        d = distances(s, norm[rows], top)
        bound = np.maximum(low[:, None], d - page.radius[cols][None, :])
        wanted &= bound <= limit
        for c in np.flatnonzero(wanted.any(axis=0)):
            to = np.flatnonzero(wanted[:, c])
            pushed += 1
            heapq.heappush(
                heap, (float(bound[to, c].min()), pushed, int(page.child[cols[c]]), rows[to], bound[to, c], d[to, c])
            )
    return best


PAGES = (
    "tree long, page int, leaf boolean, x binary, radius binary, away binary, child binary, "
    "ids array<array<long>>, dim int, root binary, cover double"
)
PAGES_ARROW = pa.schema(
    [
        ("tree", pa.int64()),
        ("page", pa.int32()),
        ("leaf", pa.bool_()),
        ("x", pa.binary()),
        ("radius", pa.binary()),
        ("away", pa.binary()),
        ("child", pa.binary()),
        ("ids", pa.list_(pa.list_(pa.int64()))),
        ("dim", pa.int32()),
        ("root", pa.binary()),
        ("cover", pa.float64()),
    ]
)


def _page_table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PAGES_ARROW)], schema=PAGES_ARROW)


def _load(pages: pa.Table) -> list[Page]:
    cols = {n: pages.column(n).to_pylist() for n in pages.column_names}
    out: list[Page] = [None] * len(cols["page"])
    for i, at in enumerate(cols["page"]):
        leaf, dim = cols["leaf"][i], cols["dim"][i]
        number = lambda n: np.frombuffer(cols[n][i], np.float64)  # noqa: E731, B023
        away = number("away")
        out[at] = Page(
            leaf,
            number("x").reshape(len(away), dim),
            None if leaf else number("radius"),
            away,
            None if leaf else np.frombuffer(cols["child"][i], np.int64),
            cols["ids"][i],
        )
    return out


def _trees(points: DataFrame, n: int, top: float) -> DataFrame:
    """``points`` (``v``, ``ids``) with the tree of each."""
    count = min(MOST_PIVOTS, max(1, -(-n // TREE_ROWS)))
    # A bounded sample, dealt by hash.
    sample = [r.v for r in points.select("v").orderBy(F.xxhash64("v"), "v").limit(count).collect()]
    by_dim: dict[int, list[tuple[int, bytes]]] = {}
    for i, v in enumerate(sample):
        by_dim.setdefault(len(v) // 8, []).append((i, bytes(v)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {d: (np.array([i for i, _ in p]), lifted(unpack([v for _, v in p]), top)) for d, p in by_dim.items()}
        for batch in batches:
            vectors = batch.column(0).to_pylist()
            pivot = np.zeros(len(vectors), np.int64)
            dims = np.array([len(v) // 8 for v in vectors])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if d not in held or d == 0:
                    pivot[at] = MOST_PIVOTS + d  # lengths that the sample missed
                    continue
                names, p = held[int(d)]
                x = lifted(unpack([vectors[i] for i in at]), top)
                away = (p * p).sum(axis=1)[None, :] - 2.0 * (x @ p.T)
                pivot[at] = names[away.argmin(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot, pa.int64())], names=[*batch.schema.names, "pivot"]
            )

    dealt = materialize(points.select("v", "ids").mapInArrow(lean(run), "v binary, ids array<long>, pivot long"), "topk-pivots")
    parts = dealt.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(TREE_ROWS)).alias("parts"))
    tree = F.shiftleft(F.col("pivot"), 32).bitwiseOR(F.pmod(F.xxhash64("v", F.lit(1)), F.col("parts")))
    return materialize(dealt.join(parts, "pivot").select("v", "ids", tree.alias("tree")), "topk-points")


def _build(top: float):
    def build(group: pa.Table) -> pa.Table:
        x = unpack(group.column("v").to_pylist())
        pages, radius = build_pages(x, group.column("ids").to_pylist(), top)
        tree = group.column("tree")[0].as_py()
        raw = lambda a, t=np.float64: None if a is None else np.asarray(a, t).tobytes()
        rows = []
        for i, p in enumerate(pages):
            root, cover = (raw(x[0]), radius) if i == 0 else (None, None)
            packed = (raw(p.x), raw(p.radius), raw(p.away), raw(p.child, np.int64))
            rows.append((tree, i, p.leaf, *packed, p.ids, x.shape[1], root, cover))
        return _page_table(rows)

    return build


FOUND = "v binary, id long, score long, want long"
FOUND_NAMES = ["v", "id", "score", "want"]


def _search_trees(queries: DataFrame, pages: DataFrame, top: float) -> DataFrame:
    """The ``want`` best of every ``(v, tree, best, want)`` within that tree. A tree with
    many queries is sent to several tasks, with a block of them each."""
    blocks = queries.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_BLOCK)).cast("int").alias("blocks"))
    left = queries.join(blocks, "tree").withColumn("block", F.pmod(F.xxhash64("v", F.lit(2)), "blocks").cast("int"))
    left = left.select("v", "best", "want", F.col("tree").alias("of_tree"), F.col("block").alias("of_block"))
    right = pages.join(blocks, "tree").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = right.select(*[F.col(c).alias(c) for c in (*PAGES_ARROW.names, "block")])

    def run(wanted: pa.Table, tree: pa.Table) -> pa.Table:
        if not wanted.num_rows or not tree.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.binary(), *[pa.int64()] * 3)], names=FOUND_NAMES)
        first = tree.column("page").to_pylist().index(0)
        root = np.frombuffer(tree.column("root")[first].as_py(), np.float64)
        loaded, cover = _load(tree), tree.column("cover")[first].as_py()
        parts = []
        for want in np.unique(wanted.column("want").to_numpy()).tolist():  # one number in all but odd tables
            part = wanted.filter(pc.equal(wanted.column("want"), want))
            asked = part.column("v").to_pylist()
            known = part.column("best").fill_null(NOTHING).to_numpy()
            best = search(loaded, cover, root, unpack(asked), want, top, known)
            row, place = np.nonzero(best.score > NOTHING)
            vs = pa.array(asked, pa.binary()).take(pa.array(row))
            columns = [vs, best.id[row, place], best.score[row, place], np.full(len(row), want, np.int64)]
            parts.append(pa.Table.from_arrays([pa.array(c) for c in columns], names=FOUND_NAMES))
        return pa.concat_tables(parts)

    return left.groupBy("of_tree", "of_block").cogroup(right.groupBy("tree", "block")).applyInArrow(run, FOUND)


def _other_trees(queries: DataFrame, roots: DataFrame, n_roots: int, n_queries: int, top: float) -> DataFrame:
    """``(v, tree, best, want)`` for the trees, beside a query's own, that may hold one
    of its best. Blocks of queries meet blocks of roots."""
    root_blocks, query_blocks = max(1, -(-n_roots // ROOT_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n, *key: F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")
    left = queries.withColumn("qb", part(query_blocks, "v", F.lit(3))).withColumn("rb", every(root_blocks))
    right = roots.withColumn("of_rb", part(root_blocks, "tree")).withColumn("for_qb", every(query_blocks))

    def run(wanted: pa.Table, trees: pa.Table) -> pa.Table:
        vs, names, bests, wants = [], [], [], []
        by_dim: dict[int, list[int]] = {}
        for i, dim in enumerate(trees.column("dim").to_pylist()):
            by_dim.setdefault(dim, []).append(i)
        roots = trees.column("root").to_pylist()
        held = {d: (np.array(at), unpack([roots[i] for i in at])) for d, at in by_dim.items()}
        cover = trees.column("cover").to_numpy()
        tree = trees.column("tree").to_numpy()
        homes, asked = wanted.column("tree").to_numpy(), wanted.column("v").to_pylist()
        known = wanted.column("best").fill_null(NOTHING).to_numpy()
        want = wanted.column("want").to_numpy()
        size = np.array([len(v) // 8 for v in asked])
        for dim, (at, x) in held.items():
            rows = np.flatnonzero(size == dim)
            if not rows.size:
                continue
            queries = unpack([asked[i] for i in rows])
            norm = np.einsum("ij,ij->i", queries, queries)[:, None]
            best = known[rows][:, None]
            limit = np.where(best == NOTHING, np.inf, distances(best, norm, top) + slack_of(norm, top))
            near = distances(scores(queries, x), norm, top) - cover[at][None, :] <= limit
            row, col = np.nonzero(near & (tree[at][None, :] != homes[rows][:, None]))
            vs += [asked[rows[i]] for i in row]
            names += tree[at][col].tolist()
            bests += [None if known[rows[i]] == NOTHING else int(known[rows[i]]) for i in row]
            wants += want[rows[row]].tolist()
        return pa.table(
            {
                "v": pa.array(vs, pa.binary()),
                "tree": pa.array(names, pa.int64()),
                "best": pa.array(bests, pa.int64()),
                "want": pa.array(wants, pa.int64()),
            }
        )

    met = left.groupBy("qb", "rb").cogroup(right.groupBy("for_qb", "of_rb"))
    return met.applyInArrow(run, "v binary, tree long, best long, want long")


def top_k(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` highest scores of every query
    row (``is_query``, over its ``id``) among all other rows."""
    vectors = materialize(integer_vectors(rows, id_col, vector_col, scale).distinct(), "topk-vectors")
    same = Window.partitionBy("v").orderBy("id")
    points, seen = materialize_observed(
        vectors.withColumn("nth", F.row_number().over(same))
        .filter(F.col("nth") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"), F.max("norm").alias("norm")),
        "topk-distinct",
        {"n": F.count(F.lit(1)), "top": F.max("norm")},
    )
    top = float(seen["top"] or 0.0)
    points = _trees(points, seen["n"], top)
    pages = materialize(points.groupBy("tree").applyInArrow(_build(top), PAGES), "topk-pages")
    roots = pages.filter("page = 0").select("tree", "dim", "root", "cover")

    # An id may stand on several vectors: so many of a query's best may be its own rows, which go afterwards.
    asked = vectors.filter(is_query).select("id", "v")
    own = vectors.filter(is_query).groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    wanted = asked.join(own, "id").groupBy("v").agg((F.max("own") + k).alias("want"))
    home, counted = materialize_observed(
        wanted.join(points.select("v", "tree"), "v"), "topk-home", {"n": F.count(F.lit(1))}
    )
    near = materialize(_search_trees(home.withColumn("best", F.lit(None).cast("long")), pages, top), "topk-near")
    bounds = near.groupBy("v").agg(F.when(F.count(F.lit(1)) >= F.max("want"), F.min("score")).alias("best"))
    known = home.join(bounds, "v", "left")
    others = materialize(_other_trees(known, roots, roots.count(), counted["n"], top), "topk-trees")
    found = near.unionByName(_search_trees(others, pages, top))

    order = [F.col("score").desc(), F.col("id")]
    best = found.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy(*order)))
    best = best.filter("nth <= want").drop("nth", "want")
    answers = asked.withColumnRenamed("id", "query_id").join(best, "v").filter("id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id", "v").orderBy(*order))
    return answers.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the 5 best of every vec_id divisible by 50."""
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)
    return found.withColumnRenamed("id", "vec_id")


ORACLE_SQL = f"""
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= {K}
"""
