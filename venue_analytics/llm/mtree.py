"""Exact top-k inner-product search by M-tree best-first search.

Candidates are dealt into blocks of bounded size; each block is bulk-loaded into an M-tree of paged
nodes: every node holds at most PAGE entries, each with its routing object (a data vector), covering
radius (largest distance to anything below) and distance to its parent's routing object. Distances are
Euclidean on the integer vectors, a true metric.

The ranking is by inner product, which no metric orders; the tree bounds it instead. For any x below a
routing object o with covering radius r, q.x = q.o + q.(x - o) <= q.o + |q| r (Cauchy-Schwarz), so a
node whose bound is below the current k-th score holds nothing better. Best-first search pops the node
of the highest bound. The stored parent distances save work before any product is taken: a child c of
p has q.o_c <= q.o_p + |q| d(o_c, o_p), so a child (or a leaf entry) whose bound from the parent alone
is too low is dropped without computing q.o_c. Bounds are floats with a margin; scores are exact
integers.

Spark deals the work: a query block meets each candidate block in one task (a stated query set
against all rows, in blocks), every task returns its local top k of each query, and a window with a
group limit (partial, before the shuffle) merges them.

Defined cases: rows with a null id, a null vector, or a null or non-finite component take no part;
a query meets candidates of its own length only; candidates of the query's own id are skipped;
repeated rows are candidates each, and a repeated query row gets its own list; ties in score go to
the smaller id; fewer than k candidates give all of them; an empty table gives no rows. Other input
columns are not read.
"""

from __future__ import annotations

import heapq
import math
import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored, table

# Fixed values of the contract.
SCALE = 1024
K = 10
QUERY_EVERY = 100

PAGE = 256  # entries of one node page: 128 KB of a leaf at 64 dimensions
CANDIDATE_ROWS = 4096  # candidates of one block: one tree, about 2 MB at 64 dimensions
QUERY_ROWS = 2048  # queries that meet one block in one task

HIT = T.StructType([T.StructField(n, T.LongType()) for n in ("query_id", "query_row", "vec_id", "score")])


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the rows that take part: v = floor(scale * x) per component as long."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(math.inf)))
    return df.where(F.col(f"`{key}`").isNotNull() & x.isNotNull() & finite).select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")
    )


# ---- the tree --------------------------------------------------------------------------------------
class Node:
    """A page: routing object ``center`` (row of the block), ``radius``, and up to PAGE children or entries."""

    __slots__ = ("center", "radius", "children", "child_centers", "child_radii", "child_parent", "entries", "entry_parent")

    def __init__(self, center: int):
        self.center, self.radius = center, 0.0
        self.children: list[Node] | None = None
        self.entries: np.ndarray | None = None


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    d = points - to
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def build(vectors: np.ndarray, page: int = PAGE) -> Node | None:
    """Bulk-load an M-tree over the rows of ``vectors`` (float64), pages of at most ``page`` entries."""
    if len(vectors) == 0:
        return None
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * len(vectors) // page + 1000))

    def load(rows: np.ndarray, center: int) -> Node:
        node = Node(center)
        dist = _distances(vectors[rows], vectors[center])
        node.radius = float(dist.max())
        if len(rows) <= page:
            node.entries, node.entry_parent = rows, dist
            return node
        # Routing objects by farthest-first traversal from the node's own object, then nearest assignment.
        chosen = [int(np.argmax(dist))]
        nearest = _distances(vectors[rows], vectors[rows[chosen[0]]])
        owner = np.zeros(len(rows), dtype=np.int64)
        while len(chosen) < page:
            far = int(np.argmax(nearest))
            if nearest[far] == 0:
                break
            chosen.append(far)
            d = _distances(vectors[rows], vectors[rows[far]])
            closer = d < nearest
            owner[closer], nearest[closer] = len(chosen) - 1, d[closer]
        if len(chosen) == 1:  # all rows equal: up to page equal subtrees, each its first row as routing object
            size = -(-len(rows) // page)
            subsets = [(rows[i : i + size], int(rows[i])) for i in range(0, len(rows), size)]
        else:
            subsets = [(rows[owner == j], int(rows[chosen[j]])) for j in range(len(chosen))]
        node.children = [load(sub, c) for sub, c in subsets]
        node.child_centers = vectors[[c.center for c in node.children]]
        node.child_radii = np.array([c.radius for c in node.children])
        node.child_parent = _distances(node.child_centers, vectors[center])
        return node

    first = int(np.argmin(_distances(vectors, vectors.mean(axis=0))))
    return load(np.arange(len(vectors)), first)


def _exact(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products: by float64 where every partial sum is below 2^53 (the caller's choice of
    dtype), int64 where it can't overflow, else Python integers."""
    if rows.dtype == object or q.dtype == object:
        return np.array([sum(int(a) * int(b) for a, b in zip(r, q)) for r in rows], dtype=object)
    return np.rint(rows @ q).astype(np.int64) if rows.dtype == np.float64 else rows @ q


def search(tree: Node | None, ints: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int = K) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, vec_id) of the block for query q, best first, and the number of products taken."""
    if tree is None:
        return [], 0
    qf = np.asarray(q, dtype=np.float64)
    norm = float(np.sqrt(qf @ qf))
    best: list[tuple[int, int]] = []  # min-heap of (score, -vec_id): the worst kept on top
    products = 1

    def worst() -> float:
        return best[0][0] if len(best) == k else -math.inf

    def below(bound: np.ndarray | float, scale: np.ndarray | float) -> np.ndarray | bool:
        return bound + 1e-9 * scale + 1.0 < worst()

    root_dot = int(_exact(ints[[tree.center]], q)[0])
    frontier = [(-(root_dot + norm * tree.radius), 0, root_dot, tree)]
    tick = 1
    while frontier:
        neg, _, dot, node = heapq.heappop(frontier)
        if below(-neg, abs(dot) + norm * node.radius):
            break
        if node.children is not None:
            reach = norm * (node.child_parent + node.child_radii)
            keep = np.flatnonzero(~below(dot + reach, abs(dot) + reach))
            if len(keep) == 0:
                continue
            dots = _exact(ints[[node.children[i].center for i in keep]], q)
            products += len(keep)
            for i, d in zip(keep, dots):
                child, d = node.children[i], int(d)
                bound = d + norm * child.radius
                if not below(bound, abs(d) + norm * child.radius):
                    heapq.heappush(frontier, (-bound, tick, d, child))
                    tick += 1
        else:
            reach = norm * node.entry_parent
            keep = node.entries[~below(dot + reach, abs(dot) + reach)]
            keep = keep[ids[keep] != own]
            if len(keep) == 0:
                continue
            products += len(keep)
            for s, v in zip(_exact(ints[keep], q), ids[keep]):
                item = (int(s), -int(v))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
    return sorted(((s, -v) for s, v in best), key=lambda t: (-t[0], t[1])), products


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column]) if len(column) else np.zeros((0, 0), dtype=np.int64)


def _exact_dtype(*blocks: np.ndarray) -> type:
    """float64 when every product sum stays below 2^52 (exact, and by BLAS), int64 below 2^62, else object."""
    top = max((int(np.abs(b).max()) for b in blocks if b.size), default=0)
    width = max((b.shape[1] for b in blocks if b.ndim == 2), default=1)
    reach = top * top * max(width, 1)
    return np.float64 if reach < 2**52 else np.int64 if reach < 2**62 else object


class Pages:
    """The tree flattened for many queries at once: inner routing objects, leaf pages, entries padded to PAGE."""

    def __init__(self, tree: Node, vectors: np.ndarray, ids: np.ndarray, page: int = PAGE):
        inner, leaves, parent, parent_distance = [], [], [], []

        def walk(node: Node, at: int, dist: float) -> None:
            if node.children is None:
                leaves.append(node), parent.append(at), parent_distance.append(dist)
                return
            inner.append(node)
            here = len(inner) - 1
            for child, d in zip(node.children, node.child_parent):
                walk(child, here, float(d))

        walk(tree, -1, 0.0)
        if not inner:  # a single page: its own routing object stands above it at distance 0
            inner.append(tree)
            parent = [0]
        d = vectors.shape[1]
        self.inner_centers = vectors[[n.center for n in inner]]
        self.leaf_centers = vectors[[n.center for n in leaves]]
        self.leaf_radii = np.array([n.radius for n in leaves])
        self.leaf_parent, self.leaf_parent_distance = np.array(parent), np.array(parent_distance)
        self.entries = np.zeros((len(leaves), page, d), dtype=vectors.dtype)
        self.entry_ids = np.full((len(leaves), page), np.iinfo(np.int64).max, dtype=np.int64)
        self.entry_parent = np.full((len(leaves), page), np.inf)
        for i, n in enumerate(leaves):
            m = len(n.entries)
            self.entries[i, :m], self.entry_ids[i, :m], self.entry_parent[i, :m] = vectors[n.entries], ids[n.entries], n.entry_parent


def search_many(pages: Pages, qs: np.ndarray, own: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-first search of many queries at once over float64 pages (exact integer sums below 2^52).

    The queries go through the leaf pages together, a page's priority being the highest bound any query
    gives it, and each query takes a page only while the page's bound can beat its k-th score: all
    stop at the first page that no query can use. A leaf's bound is first taken from its parent's
    product and the stored parent distance, and its own routing product is computed only where that
    bound can still win; entries are skipped likewise by their distance to the leaf's routing object.
    Returns scores and ids (queries x k; -inf and int64 max where fewer) and the products taken.
    """
    with np.errstate(invalid="ignore"):
        return _search_many(pages, qs, own, k)


def _search_many(pages: Pages, qs: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    nq, top = len(qs), np.iinfo(np.int64).max
    norm = np.sqrt(np.einsum("ij,ij->i", qs, qs))
    best_s, best_i = np.full((nq, k), -np.inf), np.full((nq, k), top, dtype=np.int64)

    def slack(bound: np.ndarray) -> np.ndarray:  # float bounds of integer scores, with a margin
        return bound + 1e-9 * np.abs(bound) + 1.0

    def visit(rows: np.ndarray, leaf: int, centre: np.ndarray) -> int:
        """Score the entries of one leaf for the query rows that the parent-distance bound lets through."""
        ids = pages.entry_ids[leaf]
        live = (slack(centre[:, None] + norm[rows, None] * pages.entry_parent[leaf]) >= best_s[rows, -1:])
        live &= (ids != own[rows, None]) & (ids != top)
        cols = np.flatnonzero(live.any(axis=0))
        if len(cols) == 0:
            return 0
        part = np.where(live[:, cols], np.rint(qs[rows] @ pages.entries[leaf, cols].T), -np.inf)
        s = np.concatenate([best_s[rows], part], axis=1)
        i = np.concatenate([best_i[rows], np.broadcast_to(ids[cols], part.shape)], axis=1)
        order = np.lexsort((i, -s), axis=-1)[:, :k]
        best_s[rows], best_i[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        return part.size

    inner = np.rint(qs @ pages.inner_centers.T)
    products = inner.size
    from_parent = inner[:, pages.leaf_parent] + norm[:, None] * (pages.leaf_parent_distance + pages.leaf_radii)[None, :]
    leaf_dot = np.full(from_parent.shape, np.nan)  # routing products, taken when first needed
    priority = from_parent.max(axis=0)
    for leaf in np.argsort(-priority, kind="stable"):
        if slack(priority[leaf]) < best_s[:, -1].min():
            break  # no query can use this page or any after it
        rows = np.flatnonzero(slack(from_parent[:, leaf]) >= best_s[:, -1])
        if len(rows) == 0:
            continue
        leaf_dot[rows, leaf] = np.rint(qs[rows] @ pages.leaf_centers[leaf])
        products += len(rows)
        rows = rows[slack(leaf_dot[rows, leaf] + norm[rows] * pages.leaf_radii[leaf]) >= best_s[rows, -1]]
        if len(rows):
            products += visit(rows, leaf, leaf_dot[rows, leaf])
    return best_s, best_i, products


def _block(candidates: pd.DataFrame, queries: pd.DataFrame, k: int = K) -> pd.DataFrame:
    """Each query's k best of one candidate block."""
    if candidates.empty or queries.empty:
        return pd.DataFrame({n: pd.Series(dtype="int64") for n in HIT.names})
    ints, ids, qs = _matrix(candidates["v"]), candidates["vec_id"].to_numpy(dtype=np.int64), _matrix(queries["v"])
    qids, qrows = queries["vec_id"].to_numpy(dtype=np.int64), queries["query_row"].to_numpy(dtype=np.int64)
    tree = build(ints.astype(np.float64))
    kind = _exact_dtype(ints, qs)
    if kind is np.float64:
        scores, found, _ = search_many(Pages(tree, ints.astype(np.float64), ids), qs.astype(np.float64), qids, k)
        real = np.isfinite(scores)
        return pd.DataFrame({
            "query_id": np.repeat(qids, k)[real.ravel()], "query_row": np.repeat(qrows, k)[real.ravel()],
            "vec_id": found[real], "score": scores[real].astype(np.int64),
        })
    out = {n: [] for n in HIT.names}
    ints, qs = ints.astype(kind), qs.astype(kind)
    for q, qid, qrow in zip(qs, qids, qrows):  # magnitudes beyond float64's exact sums: one query at a time
        for score, vid in search(tree, ints, ids, q, int(qid), k)[0]:
            out["query_id"].append(int(qid)), out["query_row"].append(int(qrow)), out["vec_id"].append(vid), out["score"].append(score)
    return pd.DataFrame(out, columns=HIT.names).astype("int64")


def top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score (long) of the k best candidates of each query row."""
    valid = stored(integer_vectors(df, key, vector).withColumn("dim", F.size("v").cast("long")), "mtree-vectors")
    valid = valid.withColumn("row", F.monotonically_increasing_id())
    n_rows = valid.count()
    queries = valid.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    n_queries = queries.count()
    blocks, query_blocks = max(1, -(-n_rows // CANDIDATE_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    # Both sides' keys are long: cogroup meets groups by the hash of equal types only.
    spread = lambda n: F.pmod(F.xxhash64("vec_id", "row"), F.lit(n)).cast("long")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    candidates = valid.select("dim", spread(blocks).alias("cblock"), every_block(query_blocks).alias("qblock"), "vec_id", "v")
    asked = queries.select("dim", every_block(blocks).alias("cblock"), spread(query_blocks).alias("qblock"), "vec_id", F.col("row").alias("query_row"), "v")
    keys = ["dim", "qblock", "cblock"]
    hits = candidates.groupby(*keys).cogroup(asked.groupby(*keys)).applyInPandas(lambda c, q: _block(c, q, k), HIT)
    hits = stored(hits, "mtree-hits")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best inner products of every query vector (vec_id divisible by 100) among all vectors."""
    return top_k(table(spark, folder, "embeddings"))


SQL = {
    "op12_exact_top_k": f"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        q AS (SELECT row_number() OVER () AS query_row, vec_id, v FROM v WHERE vec_id % {QUERY_EVERY} = 0),
        scored AS (
            SELECT q.query_row, q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: CAST(q.v[i] AS HUGEINT) * c.v[i])) AS BIGINT) AS score
            FROM q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}""",
}

QUERIES = {"op12_exact_top_k": op12_exact_top_k}
