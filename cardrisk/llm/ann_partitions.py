"""Approximate nearest neighbours by learned partitions.

Learning, on the driver and from at most ``SAMPLE`` vectors (those with the
smallest hashes of the id): a neighbour graph of the sample is cut into
balanced parts -- median splits along main directions, then moves of single
vertices that keep more neighbours together within a capacity -- and a small
two-layer classifier learns each vertex's part.

Indexing: every vector of the table goes to its most probable part. Searching:
a query goes to its most probable parts until they hold ``MASS`` of the
probability (``MIN_PROBES`` at least), and is held against every vector there
by exact distances in double precision; the best of all parts are ranked.
Parts and their queries are dealt into blocks of bounded size by row counts,
so a part with a third of all vectors is many tasks.

Defined results: vectors that are null, zero, hold null or non-finite
components, or differ in length from most of the sample take no part, and
neither do rows with a null id; rows with equal ids are one vector's copies:
never neighbours of each other, and an id is named once per query; ties go to
the smaller id; fewer candidates than ``k`` are all returned; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize

SAMPLE = 6144
NEIGHBOURS = 16
PART_ROWS = 2000        # vectors a part is meant to hold
SAMPLE_PER_PART = 64    # so SAMPLE / SAMPLE_PER_PART parts at most
BLOCK = 8192            # candidates of a task
QUERY_BLOCK = 1024      # queries of a task
MASS = 0.985
MIN_PROBES = 3


# ---- the graph and its parts ----------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest other rows."""
    n = len(x)
    k = min(k, n - 1)
    norm = (x * x).sum(1)
    out = np.empty((n, k), np.int64)
    for i in range(0, n, 512):
        d = norm[None, :] - 2 * x[i:i + 512] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out[i:i + 512] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.empty((len(d), 0), np.int64)
    return out


def _halve(x: np.ndarray, at: np.ndarray, parts: int, label: np.ndarray, first: int) -> None:
    """Give ``parts`` labels from ``first`` on to the rows ``at``, by splits along the main direction."""
    if parts == 1:
        label[at] = first
        return
    y = x[at] - x[at].mean(0)
    v = np.ones(y.shape[1])
    for _ in range(20):
        v = y.T @ (y @ v)
        v /= np.linalg.norm(v) + 1e-30
    left = parts // 2
    order = np.argsort(y @ v, kind="stable")
    cut = len(at) * left // parts
    _halve(x, at[order[:cut]], left, label, first)
    _halve(x, at[order[cut:]], parts - left, label, first + left)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 8) -> np.ndarray:
    """Part of each vertex; moves raise the neighbours inside a part, none outgrows its capacity."""
    n = len(x)
    label = np.zeros(n, np.int64)
    _halve(x, np.arange(n), parts, label, 0)
    size = np.bincount(label, minlength=parts)
    capacity = int(np.ceil(n / parts * (1 + slack)))
    floor = int(n / parts * (1 - slack))
    source = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    target = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (source, label[target]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < capacity and size[label[i]] > floor:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if moved < n // 500:
            break
    return label


# ---- the classifier -------------------------------------------------------


@dataclass
class Router:
    """Two layers: relu(x w1 + b1) w2 + b2, softmax over the parts."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(1, keepdims=True)


def fit_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, batch: int = 128,
               rate: float = 2e-3, seed: int = 11) -> Router:
    """Adam on the cross entropy between ``target`` (rows of part shares) and the softmax."""
    rng = np.random.default_rng(seed)
    n, dim = x.shape
    parts = target.shape[1]
    mean, scale = x.mean(0), 1.0 / (x.std() + 1e-12)
    y = (x - mean) * scale
    p = [rng.normal(0, (2 / dim) ** 0.5, (dim, hidden)), np.zeros(hidden),
         rng.normal(0, hidden ** -0.5, (hidden, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            i = order[at:at + batch]
            h = np.maximum(y[i] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            e = (z / z.sum(1, keepdims=True) - target[i]) / len(i)
            back = (e @ p[2].T) * (h > 0)
            step += 1
            lr = rate * (1 - epoch / epochs) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for j, g in enumerate((y[i].T @ back, back.sum(0), h.T @ e, e.sum(0))):
                m[j] += 0.1 * (g - m[j])
                v[j] += 0.001 * (g * g - v[j])
                p[j] -= lr * m[j] / (np.sqrt(v[j]) + 1e-8)
    return Router(mean, scale, *p)


def learn(x: np.ndarray, n_rows: int) -> Router | None:
    """Graph, parts and classifier of a sample; None where one part is enough."""
    parts = min(-(-n_rows // PART_ROWS), len(x) // SAMPLE_PER_PART)
    if parts < 2:
        return None
    graph = neighbour_graph(x, NEIGHBOURS)
    label = balanced_parts(x, graph, parts)
    share = np.eye(parts)[label] + np.eye(parts)[label[graph]].mean(1)   # a vertex and where its neighbours are
    return fit_router(x, share / 2)


# ---- the table ------------------------------------------------------------


def usable(embedding: str = "embedding", dim: int | None = None) -> Column:
    e = F.col(embedding)
    ok = e.isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    return F.coalesce(ok if dim is None else ok & (F.size(e) == dim), F.lit(False))


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """(query id, row id, distance) of each query's k nearest rows with another id, ties to the smaller id."""
    order = np.argsort(row_ids, kind="stable")      # the copies of an id stand together
    rows, row_ids = rows[order], row_ids[order]
    starts = np.flatnonzero(np.append(True, row_ids[1:] != row_ids[:-1])) if len(row_ids) else np.zeros(0, np.int64)
    norm = (rows * rows).sum(1)
    out_q, out_r, out_d = [], [], []
    for i in range(0, len(queries), 128):
        q = queries[i:i + 128]
        d = norm[None, :] - 2 * q @ rows.T + (q * q).sum(1)[:, None]
        d[query_ids[i:i + 128, None] == row_ids[None, :]] = np.inf
        for j in range(len(q)):
            dj = d[j]
            if len(starts) > k:     # room for rounding in the expanded form: exact distances decide
                limit = np.partition(np.minimum.reduceat(dj, starts), k - 1)[k - 1]      # of k ids, not of k rows
                at = np.flatnonzero(dj <= limit + 1e-9 * (1 + abs(limit) + float((q[j] * q[j]).sum())))
            else:
                at = np.arange(len(dj))
            at = at[np.isfinite(dj[at])]
            exact = np.sqrt(((rows[at] - q[j]) ** 2).sum(1))
            best = np.lexsort((row_ids[at], exact))
            # copies of an id are equal or not: the nearest counts
            _, first = np.unique(row_ids[at][best], return_index=True)
            best = best[np.sort(first)][:k]
            out_q.append(np.full(len(best), query_ids[i + j]))
            out_r.append(row_ids[at][best])
            out_d.append(exact[best])
    cat = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
    return cat(out_q, np.int64), cat(out_r, np.int64), cat(out_d, np.float64)


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def search(spark: SparkSession, table: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for every row that ``is_query`` selects."""
    good = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("q")).filter(
        F.col("vec_id").isNotNull() & usable())
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    dim = int(sample["embedding"].map(len).mode().iloc[0]) if len(sample) else 0
    good = good.filter(F.size("embedding") == dim)
    sample = sample[sample["embedding"].map(len) == dim]
    router = learn(stacked(sample["embedding"]), good.count()) if len(sample) else None

    def route(frames):
        for f in frames:
            if not len(f):
                continue
            if router is None:
                f["parts"] = [[0]] * len(f)
            else:
                p = router.probabilities(stacked(f["embedding"]))
                order = np.argsort(-p, axis=1, kind="stable")
                reached = np.cumsum(np.take_along_axis(p, order, 1), 1)
                probes = np.maximum((reached < MASS).sum(1) + 1, MIN_PROBES)
                f["parts"] = [o[:n].tolist() for o, n in zip(order, probes)]
            yield f

    kind = good.schema["embedding"].dataType.simpleString()      # float or double: distances are taken on the vectors as given
    placed = good.mapInPandas(route, f"vec_id long, embedding {kind}, q boolean, parts array<int>")
    placed = materialize(spark, placed, "vectors")
    rows = placed.select(F.element_at("parts", 1).alias("part"), "vec_id", "embedding", F.lit(False).alias("q"))
    asked = placed.filter("q").select(F.explode("parts").alias("part"), "vec_id", "embedding", "q")
    sizes = (rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
                 .join(asked.groupBy("part").agg(F.count(F.lit(1)).alias("nq")), "part"))
    # one row per part, so at most SAMPLE / SAMPLE_PER_PART of them
    sizes = F.broadcast(sizes.select("part", F.ceil(F.col("n") / BLOCK).cast("int").alias("b"),
                                     F.ceil(F.col("nq") / QUERY_BLOCK).cast("int").alias("bq")))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rows = rows.join(sizes, "part").withColumn("i", deal(F.col("b"))).withColumn("j", every(F.col("bq")))
    asked = asked.join(sizes, "part").withColumn("j", deal(F.col("bq"))).withColumn("i", every(F.col("b")))

    def held_against(f: pd.DataFrame) -> pd.DataFrame:
        q = f["q"].to_numpy()
        if not q.any() or q.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, ids = stacked(f["embedding"]), f["vec_id"].to_numpy()
        a, b, d = nearest(x[q], ids[q], x[~q], ids[~q], k)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": d})

    names = ["part", "i", "j", "vec_id", "embedding", "q"]
    found = (rows.select(names).unionByName(asked.select(names)).groupBy("part", "i", "j")
                 .applyInPandas(held_against, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
