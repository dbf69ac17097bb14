"""Exact top-k inner products by dual-tree search over cover trees.

Method.  A cover tree over a bounded sample gives the cells: its top nodes' centres,
each row belongs to the nearest.  A cell knows its true covering radius and is cut
into blocks of bounded size.  Each query is first compared with one block of the
cell whose centre scores best; the k-th score found there is its threshold.  With c0
a cell's centre and rc its radius, no row of it scores more than q.c0 + rc |q|, so a
query goes on only to the cells whose bound reaches its threshold, and a cell's rows
travel only if a query is left for them.  Every (candidate block, block of its
queries) is a task of its own.  In a task both sides
get a cover tree: a node's children are centres chosen farthest first, so they
are further apart than the radius that covers the node's points, which go to
their nearest centre; radii shrink by a constant factor down the tree or the
centres reach a fixed number, and splitting stops at small leaves.  With q0, c0 the points of two
nodes and rq, rc their covering radii, no pair below them scores more than
q0.c0 + rc |q0| + rq |c0| + rq rc.  The search goes through node pairs, best bound
first, and drops a pair whose bound is under the worst k-th score of the query
node's queries, or under the worst of their thresholds.  Each task returns its k best
per query; a window keeps k over all tasks.  Vectors that are equal are indexed once
with their k + 1 smallest ids, as no others of them can be among the k best.

Scores are integers: components are floor(scale * x).
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import stored

#: Rows of a candidate block and of a query block; points of a leaf; radius factor of a level; most children of a node.
BLOCK, QUERY_BLOCK, LEAF, SHRINK, FAN = 8192, 2048, 128, 0.7, 16
#: Rows sampled for the cells' centres, most cells, and cells a block's worth of rows.
SAMPLE, MOST_CELLS, CELLS_A_BLOCK = 4096, 1024, 8


def quantised(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x), x as double; null if the vector or a
    component is null or not finite, or a result is no long."""
    x = F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) * scale < F.lit(9.2e18)))
    return F.when(vector.isNotNull() & fine, x)


class CoverTree:
    """Nodes of a point set, parents before children.  ``order`` lists the points
    so that each node's are neighbours: node i holds order[lo[i]:hi[i]]."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        n = len(points)
        self.center, self.lo, self.hi, self.children, self.radius = [0], [0], [n], [[]], [0.0]
        self.order = np.arange(n)
        if n:
            self.radius = [float(np.sqrt(self._far(self.order, 0).max()))]
        todo = [0]
        while todo:
            node = todo.pop()
            lo, hi = self.lo[node], self.hi[node]
            if hi - lo <= leaf or self.radius[node] < 1e-9:
                continue
            at = lo
            for center, own, radius in self._net(self.order[lo:hi], self.center[node], self.radius[node] * SHRINK):
                self.order[at:at + len(own)] = own
                child = len(self.center)
                self.center.append(center)
                self.lo.append(at)
                self.hi.append(at + len(own))
                self.radius.append(radius)
                self.children.append([])
                self.children[node].append(child)
                todo.append(child)
                at += len(own)

    def _far(self, mine: np.ndarray, center: int) -> np.ndarray:
        """Squared distances to a centre."""
        return ((self.points[mine] - self.points[center]) ** 2).sum(axis=1)

    def _net(self, mine: np.ndarray, center: int, radius: float) -> list[tuple[int, np.ndarray, float]]:
        """(centre, points, covering radius) of the children: centres farthest
        first until all points are within ``radius`` of one, or there are FAN."""
        centers, near = [center], self._far(mine, center)
        owner = np.zeros(len(mine), np.int64)
        while len(centers) < FAN and near.max() > radius * radius or len(centers) < 2:
            nxt = int(mine[near.argmax()])
            d = self._far(mine, nxt)
            closer = d < near
            owner[closer], near[closer] = len(centers), d[closer]
            centers.append(nxt)
        return [(c, mine[owner == k], float(np.sqrt(near[owner == k].max()))) for k, c in enumerate(centers) if (owner == k).any()]


def _search(queries: np.ndarray, q_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, exact: np.ndarray | None,
            least: np.ndarray):
    """k best (score, id) of each query among the points, by smaller id on ties;
    scores under a query's ``least`` may be left out.
    ``exact``: None if float64 products are exact, else the integer matrices."""
    qt, ct = CoverTree(queries), CoverTree(points)
    q_norm = np.sqrt((queries ** 2).sum(axis=1))
    c_norm = np.sqrt((points ** 2).sum(axis=1))
    best = np.full((len(queries), k), -np.inf)
    scores = np.zeros((len(queries), k), object if exact is not None and exact[0].dtype == object else np.int64)
    who = np.full((len(queries), k), -1, np.int64)
    found = np.zeros(len(queries), np.int64)
    several = len(np.unique(ids)) < len(ids)
    fast = exact is None and not several
    q_center, q_radius = queries[qt.center], np.array(qt.radius)
    c_center, c_radius = points[ct.center], np.array(ct.radius)
    q_len, c_len = q_norm[qt.center], c_norm[ct.center]

    def bounds(qs, cs):
        v = q_center[qs] @ c_center[cs].T + c_radius[cs][None, :] * q_len[qs][:, None] + q_radius[qs][:, None] * (c_len[cs] + c_radius[cs])[None, :]
        size = (q_len + q_radius)[qs][:, None] * (c_len + c_radius)[cs][None, :]
        return v + size * 1e-9 + 1e-6

    def base(q, c):
        a, b = qt.order[qt.lo[q]:qt.hi[q]], ct.order[ct.lo[c]:ct.hi[c]]
        s = queries[a] @ points[b].T if exact is None else exact[0][a] @ exact[1][b].T
        own = ids[b][None, :] != q_ids[a][:, None]
        live = np.flatnonzero(((s >= np.maximum(best[a, -1:], least[a][:, None])) & own).any(axis=1) if fast else own.any(axis=1))
        if fast and len(live):
            a, s = a[live], np.where(own[live], s[live], -np.inf)
            val = np.concatenate([best[a], s], axis=1)
            idv = np.concatenate([who[a], np.broadcast_to(ids[b], s.shape)], axis=1)
            o = np.lexsort((idv, -val))[:, :k]
            best[a], who[a] = np.take_along_axis(val, o, 1), np.take_along_axis(idv, o, 1)
            return
        for row in live:
            qi, n = a[row], found[a[row]]
            val = np.concatenate([scores[qi, :n], s[row][own[row]]])
            idv = np.concatenate([who[qi, :n], ids[b][own[row]]])
            o = np.array(sorted(range(len(val)), key=lambda i: (-val[i], idv[i])), int)
            if several:  # of an id's vectors the best counts
                o = o[np.sort(np.unique(idv[o], return_index=True)[1])]
            o = o[:k]
            m = len(o)
            scores[qi, :m], who[qi, :m], found[qi], best[qi, :m] = val[o], idv[o], m, val[o].astype(float)

    stack = [(np.inf, 0, 0)]
    while stack:
        top, q, c = stack.pop()
        mine = qt.order[qt.lo[q]:qt.hi[q]]
        worst = np.maximum(best[mine, -1], least[mine]).min()  # -inf until all of them have k or a threshold
        if top < worst - abs(worst) * 1e-9:
            continue
        qs, cs = np.array(qt.children[q] or [q]), np.array(ct.children[c] or [c])
        if not qt.children[q] and not ct.children[c]:
            base(q, c)
            continue
        v = bounds(qs, cs)
        o = np.argsort(v, axis=None)  # the best bound is taken next
        stack.extend(zip(v.ravel()[o].tolist(), qs[o // len(cs)].tolist(), cs[o % len(cs)].tolist(), strict=True))
    if fast:
        found = np.isfinite(best).sum(axis=1)
        scores = np.where(np.isfinite(best), best, 0).astype(np.int64)
    return scores, who, found


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _pair(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        qs, cs = pdf[pdf.is_query], pdf[~pdf.is_query]
        if not len(qs) or not len(cs):
            return out
        width = max(1, max(map(len, pdf.v)))
        cs = cs.sort_values("vec_id", kind="stable")
        c, ids = _matrix(cs.v, width), cs.vec_id.to_numpy()
        # equal vectors: the k + 1 smallest ids are enough
        _, group = np.unique(c, axis=0, return_inverse=True)
        rank = pd.Series(group.ravel()).groupby(group.ravel()).cumcount().to_numpy()
        c, ids = c[rank <= k], ids[rank <= k]
        q, q_ids = _matrix(qs.v, width), qs.vec_id.to_numpy()
        most = max(1.0, float(np.abs(q.astype(float)).max())) * max(1.0, float(np.abs(c.astype(float)).max())) * width
        exact = None
        if most >= 2 ** 52:
            exact = (q, c) if most < 2 ** 62 else (q.astype(object), c.astype(object))
        least = qs.least.fillna(-np.inf).to_numpy(float)
        scores, who, found = _search(q.astype(float), q_ids, c.astype(float), ids, k, exact, least)
        keep = np.arange(k)[None, :] < found[:, None]
        if exact is None:  # scores are exact as floats; k others reach the threshold already
            keep &= scores >= least[:, None]
        flat = [max(min(int(x), 2 ** 63 - 1), -2 ** 63) for x in scores[keep]] if scores.dtype == object else scores[keep]
        return pd.DataFrame({"query_id": np.repeat(q_ids, keep.sum(axis=1)), "vec_id": who[keep], "score": np.array(flat, np.int64)})

    return run


class Cells(NamedTuple):
    """Centres, covering radii and rows of at most MOST_CELLS cells; no rows: radius 0."""

    center: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def blocks(self, block: int) -> np.ndarray:
        return -(-self.rows // block)


def centers(sample: np.ndarray, m: int) -> np.ndarray:
    """The centres of about ``m`` top nodes of a cover tree over the sample: the
    widest node is opened first."""
    tree = CoverTree(sample, max(1, len(sample) // (2 * m)))
    top = [(-tree.radius[0], 0)]
    while len(top) < m and tree.children[top[0][1]]:
        _, node = heapq.heappop(top)
        for child in tree.children[node]:
            # a leaf stays as it is, so it goes behind all nodes that can be opened
            heapq.heappush(top, (-tree.radius[child] if tree.children[child] else 1.0, child))
    return sample[sorted({tree.center[node] for _, node in top})][:MOST_CELLS]


def _wide(lists: pd.Series, center: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and centres as float matrices of one width, filled with zeros."""
    width = max([center.shape[1], *map(len, lists)])
    return _matrix(lists, width).astype(float), np.pad(center, ((0, 0), (0, width - center.shape[1])))


def _assign(center: np.ndarray):
    def run(frames):
        for pdf in frames:
            x, c = _wide(pdf.v, center)
            cell = ((c ** 2).sum(axis=1)[None, :] - 2 * (x @ c.T)).argmin(axis=1)
            yield pdf.assign(cell=cell.astype(np.int32), far=np.sqrt(((x - c[cell]) ** 2).sum(axis=1)))

    return run


def _home(cells: Cells, k: int):
    """The cell whose centre has the largest product with a query, among those that
    hold over ``k`` rows and so give a threshold; among all with rows if none does."""
    held = np.flatnonzero(cells.rows > k) if (cells.rows > k).any() else np.flatnonzero(cells.rows)

    @F.pandas_udf("int")
    def home(v: pd.Series) -> pd.Series:
        x, c = _wide(v, cells.center)
        return pd.Series(held[(x @ c[held].T).argmax(axis=1)].astype(np.int32))

    return home


def _reached(cells: Cells, block: int):
    """The cells whose bound reaches a query's threshold (null: all cells with
    rows), without its home if that is one block."""
    held, single = np.flatnonzero(cells.rows), cells.blocks(block) == 1

    @F.pandas_udf("array<int>")
    def reached(v: pd.Series, least: pd.Series, home: pd.Series) -> pd.Series:
        x, c = _wide(v, cells.center)
        size = np.sqrt((x ** 2).sum(axis=1))[:, None]
        far = cells.radius[None, :]
        bound = x @ c.T + size * far + 1e-9 * size * (np.sqrt((c ** 2).sum(axis=1))[None, :] + far) + 1e-6
        live = bound >= least.fillna(-np.inf).to_numpy(float)[:, None]
        return pd.Series([[int(i) for i in held[row[held]] if i != h or not single[h]] for row, h in zip(live, home, strict=True)])

    return reached


def _dealt(spark, cands: DataFrame, queries: DataFrame, cells: Cells, block: int, query_block: int, seed: bool, k: int) -> DataFrame:
    """query_id, vec_id, score of ``queries`` (vec_id, v, cell, home, least) against
    the blocks of their cells: the first block of the home (``seed``), or all but that."""
    n_queries = {r.cell: r.n for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MOST_CELLS rows
    table = [(int(c), 1 if seed else int(cells.blocks(block)[c]), int(-(-n // query_block))) for c, n in sorted(n_queries.items())]
    plan = F.broadcast(spark.createDataFrame(table, "cell int, cbs int, qbs int"))
    h = F.xxhash64("vec_id", "v")
    upto = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    sent = cands.where("cb = 0") if seed else cands
    c = sent.join(plan, "cell").select("vec_id", "v", F.lit(False).alias("is_query"), F.lit(None).cast("double").alias("least"), "cell", "cb", upto("qbs").alias("qb"))
    q = queries.join(plan, "cell").select("vec_id", "v", F.lit(True).alias("is_query"), "least", "cell", "home", F.pmod(h, F.col("qbs")).cast("int").alias("qb"), upto("cbs").alias("cb"))
    q = q if seed else q.where("cell != home or cb != 0")
    return c.unionByName(q.drop("home")).groupBy("cell", "cb", "qb").applyInPandas(_pair(k), "query_id long, vec_id long, score long")


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v")).where("vec_id is not null and v is not null")
    return stored(rows.distinct(), "vectors")


def celled(rows: DataFrame, block: int) -> tuple[DataFrame, Cells]:
    """``rows`` (vec_id, v) with their cell and block (cb), and the cells.  The
    sample is the SAMPLE rows of the smallest hashes; it only decides the centres."""
    n = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE).collect()
    sample = _matrix(pd.Series([r.v for r in picked]), max([1, *(len(r.v) for r in picked)])).astype(float)
    m = min(MOST_CELLS, -(-n * CELLS_A_BLOCK // block))
    center = centers(sample, m) if len(sample) else np.zeros((1, 1))
    assigned = stored(rows.mapInPandas(_assign(center), "vec_id long, v array<bigint>, cell int, far double"), "cells")
    radius, count = np.zeros(len(center)), np.zeros(len(center), np.int64)
    for r in assigned.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():  # at most MOST_CELLS rows
        radius[r.cell], count[r.cell] = r.far, r.n
    cells = Cells(center, radius * (1 + 1e-9), count)
    blocks = F.array(*[F.lit(int(max(1, b))) for b in cells.blocks(block)])
    return assigned.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id", "v"), F.element_at(blocks, F.col("cell") + 1)).cast("int").alias("cb")), cells


def search_plan(rows: DataFrame, k: int, every: int, block: int, query_block: int) -> tuple[DataFrame, DataFrame, DataFrame, Cells]:
    """Celled candidates; the pairs of the queries' first blocks; the queries with
    their threshold and the cells left to them (``reached``); the cells."""
    cands, cells = celled(rows, block)
    queries = rows.where(F.col("vec_id") % every == 0)
    if not cells.rows.any():
        return cands, queries.selectExpr("vec_id query_id", "vec_id", "vec_id score"), queries.selectExpr("*", "0 home", "0D least", "array(0) reached"), cells
    queries = stored(queries.withColumn("home", _home(cells, k)(F.col("v"))), "queries")
    seeds = queries.selectExpr("vec_id", "v", "home cell", "home", "cast(null as double) least")
    first = stored(_dealt(rows.sparkSession, cands, seeds, cells, block, query_block, True, k), "first-blocks")
    least = _ranked(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    known = queries.join(least, "vec_id", "left")
    return cands, first, stored(known.withColumn("reached", _reached(cells, block)(F.col("v"), F.col("least"), F.col("home"))), "reached"), cells


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k candidates of the highest
    inner product for each row whose id is divisible by ``every``, against every
    row but those of its own id; all of them if they are fewer; ties to the
    smaller id.

    Null ids and vectors, and vectors with null or non-finite components, take no
    part.  Shorter vectors count as filled with zeros.  Rows repeated whole are
    one; of an id with several vectors each is a candidate, and each query vector
    competes for the query's k (the best score of an id counts).  Scores outside
    a long are set to its ends.  Other columns are not read.
    """
    rows = _vectors(vectors, scale, id_col, vector_col)
    cands, first, queries, cells = search_plan(rows, k, every, block, query_block)
    left = queries.select("vec_id", "v", "home", "least", F.explode("reached").alias("cell"))
    return _ranked(first.unionByName(_dealt(rows.sparkSession, cands, left, cells, block, query_block, False, k)), k)
