"""Nearest vectors by inner product, through learned partitions.

On a sample, the graph of each vector's nearest neighbours is cut into equal parts with few edges
between them, by bisections that are improved by swaps. A small network learns the part of a vector
from the vector and places every row; a second one learns in which parts the neighbours of a vector
are, and routes each query to the likeliest parts. How many parts a query visits is measured: on
held-back vectors of the sample, the fewest that find ``RECALL`` of their neighbours. All rows of
the parts visited are compared exactly.

A part is stored in blocks of at most ``BLOCK`` rows, so that a part that holds a third of all rows
(copies of one vector, say) is many tasks' work. Best rows are kept per query and block, then merged.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part. Rows with the query's own id are no candidates; other repeated rows are. Of queries with a
repeated id one is answered. Ties go to the smaller id. Fewer candidates than asked for: all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.batches import sampled
from tillstream.session import settle

# Vectors, about, that the graph and the networks are fitted on.
SAMPLE = 16_000
# Rows that a part should hold, the parts that there are at any size, and the most that a sample of
# that size can teach.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 4_096, 4, 128
NEIGHBOURS, HIDDEN, EPOCHS = 20, 96, 30
RECALL = 0.97
BLOCK, QUERY_BLOCK = 8_192, 512


def usable(df: DataFrame, vector: str) -> DataFrame:
    """vec_id and v (array of doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
                      F.lit(False)) & F.exists(v, lambda x: x != 0)
    rows = df.filter("vec_id is not null").select("vec_id", v.alias("v")).filter(
        F.coalesce(fine, F.lit(False)))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (most["n"] if most else 0))


@dataclass(frozen=True)
class Network:
    """One hidden layer, then a probability for each part."""
    layers: list[np.ndarray]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        z = np.maximum(x @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    scale: float
    place: Network
    route: Network
    parts: int
    visits: int


def fit_network(x: np.ndarray, target: np.ndarray, seed: int) -> Network:
    """Cross-entropy with the target probabilities, by Adam on shuffled batches."""
    rng = np.random.default_rng(seed)
    sizes = [x.shape[1], HIDDEN, target.shape[1]]
    layers = [rng.normal(0, (2 / sizes[0]) ** 0.5, (sizes[0], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, (2 / HIDDEN) ** 0.5, (HIDDEN, sizes[2])), np.zeros(sizes[2])]
    net = Network(layers)
    first, second, step = [0 * a for a in layers], [0 * a for a in layers], 0
    for epoch in range(EPOCHS):
        rate = 5e-3 * (1 - epoch / EPOCHS) + 1e-4
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            step += 1
            w1, b1, w2, b2 = layers
            hidden = np.maximum(x[part] @ w1 + b1, 0)
            z = hidden @ w2 + b2
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = (z / z.sum(axis=1, keepdims=True) - target[part]) / len(part)
            back = (d @ w2.T) * (hidden > 0)
            for k, g in enumerate((x[part].T @ back, back.sum(0), hidden.T @ d, d.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] -= rate * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def neighbours(rows: DataFrame, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each sampled row its place in ``ids`` and those of its nearest others; in Spark tasks."""
    shared = rows.sparkSession.sparkContext.broadcast((ids, x))

    def work(batches):
        all_ids, all_x = shared.value
        for batch in batches:
            own = np.searchsorted(all_ids, batch.column("vec_id").to_numpy())
            for part in np.array_split(own, max(1, len(own) // 512)):
                near = all_x[part] @ all_x.T
                near[np.arange(len(part)), part] = -np.inf
                k = min(NEIGHBOURS, len(all_ids) - 1)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)),
                     pa.ListArray.from_arrays(np.arange(0, len(part) * k + 1, k, dtype=np.int32),
                                              pa.array(top.ravel()))], ["node", "near"])

    found = rows.select("vec_id").mapInArrow(work, "node int, near array<int>").toPandas()
    found = found.drop_duplicates("node").sort_values("node")
    return found["node"].to_numpy(), np.array(found["near"].tolist(), int)


def cut(near: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """A part for each node: equal sizes, few edges between parts."""
    n = len(near)
    u = np.repeat(np.arange(n), near.shape[1])
    u, v = np.concatenate([u, near.ravel()]), np.concatenate([near.ravel(), u])
    rng = np.random.default_rng(seed)
    part = np.zeros(n, int)
    for _ in range(int(np.log2(parts))):
        # Smooth random values along the edges within each part, then halve by their order.
        inside = part[u] == part[v]
        a, b = u[inside], v[inside]
        degree = np.bincount(a, minlength=n) + 1e-9
        value = rng.normal(size=n)
        for _ in range(40):
            value = 0.5 * value + 0.5 * np.bincount(a, value[b], n) / degree
            mean = np.bincount(part, value) / np.maximum(np.bincount(part), 1)
            value -= mean[part]
            value /= (np.sqrt(np.bincount(part, value**2) / np.maximum(np.bincount(part), 1)) + 1e-12)[part]
        order = np.lexsort((value, part))
        size = np.bincount(part)
        rank = np.empty(n, int)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        side = (rank >= (size[part] + 1) // 2).astype(int)
        for _ in range(12):
            # Nodes with more edges to the other side than to their own, swapped in equal numbers.
            other = np.bincount(a, side[a] != side[b], n)
            gain = 2 * other - np.bincount(a, minlength=n)
            gain = gain + rng.random(n) * 0.1
            moved = 0
            group = part * 2 + side
            order = np.lexsort((-gain, group))
            size = np.bincount(group, minlength=2 * (part.max() + 1))
            start = np.cumsum(size) - size
            for p in range(part.max() + 1):
                x = order[start[2 * p]:start[2 * p] + size[2 * p]]
                y = order[start[2 * p + 1]:start[2 * p + 1] + size[2 * p + 1]]
                m = min(len(x), len(y))
                good = gain[x[:m]] + gain[y[:m]] > 1
                # Half of them at once: neighbours that swap together would undo each other's gain.
                m = (int(good.sum()) + 1) // 2
                side[x[:m]], side[y[:m]] = 1, 0
                moved += m
            if not moved:
                break
        part = part * 2 + side
    return part


def build(rows: DataFrame, n: int) -> Index:
    """Fit an index for ``n`` rows on about ``SAMPLE`` of them."""
    share = min(1.0, SAMPLE / max(n, 1))
    chosen = rows.filter(sampled(share, "vec_id"))
    # A vector that is there very often counts once: copies say nothing about the space.
    chosen = settle(chosen.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
                    .groupBy("vec_id").agg(F.min("v").alias("v")), "sample")
    data = chosen.toPandas().sort_values("vec_id")
    ids, x = data["vec_id"].to_numpy(), np.array(data["v"].tolist())
    parts = 1
    while parts < MOST_PARTS and (parts < LEAST_PARTS or parts * PART_ROWS < n) and parts * 64 < len(ids):
        parts *= 2
    if parts == 1:
        none = Network([np.zeros((x.shape[1] if len(x) else 1, 1)), np.zeros(1),
                        np.zeros((1, 1)), np.zeros(1)])
        return Index(1.0, none, none, 1, 1)
    _, near = neighbours(chosen, ids, x)
    scale = float(np.sqrt((x**2).mean())) or 1.0
    x = x / scale
    own = np.eye(parts)[cut(near, parts)]
    place = fit_network(x, own, 1)
    placed = place(x).argmax(axis=1)
    target = np.stack([np.bincount(placed[k], minlength=parts) for k in near]) / near.shape[1]
    held = np.arange(len(x)) % 10 == 0
    route = fit_network(x[~held], target[~held], 2)
    order = np.argsort(-route(x[held]), axis=1)
    found = np.take_along_axis(target[held], order, 1).cumsum(axis=1).mean(axis=0)
    return Index(scale, place, route, parts, int(np.searchsorted(found, RECALL)) + 1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def search(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score; both tables with vec_id and v."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4096)
    index = build(rows, rows.count())
    shared = spark.sparkContext.broadcast(index)

    def placed(batches):
        own = shared.value
        for batch in batches:
            part = own.place(_matrix(batch.column("v")) / own.scale).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(part.astype(np.int32))],
                ["vec_id", "v", "part"])

    stored = settle(rows.mapInArrow(placed, "vec_id long, v array<double>, part int"), "placed")
    # One number per part.
    size = np.zeros(index.parts, np.int64)
    for part, count in stored.groupBy("part").count().collect():
        size[part] = count
    blocks = np.maximum(1, -(-size // BLOCK))
    counts = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("part") + 1)
    block = stored.withColumn("block", F.pmod(F.xxhash64("vec_id"), counts)).groupBy("part", "block").agg(
        F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    block = block.select("part", F.col("rows.vec_id").alias("ids"), F.flatten("rows.v").alias("values"))

    def routed(batches):
        own = shared.value
        for batch in batches:
            likely = own.route(_matrix(batch.column("v")) / own.scale)
            order = np.argsort(-np.where(size > 0, likely, -1), axis=1, kind="stable")
            # At least so many parts, and as many as hold enough rows besides the query itself.
            enough = size[order].cumsum(axis=1) - size[order] <= k
            visit = (np.arange(len(size)) < own.visits) | enough
            at, nth = np.nonzero(visit & (size[order] > 0))
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(take), batch.column("v").take(take),
                 pa.array(order[at, nth].astype(np.int32))], ["vec_id", "v", "part"])

    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    groups = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = settle(asked.mapInArrow(routed, "vec_id long, v array<double>, part int"), "routed")
    asked = (asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
             .groupBy("part", "group").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")))
    asked = asked.select("part", F.col("rows.vec_id").alias("query_ids"),
                         F.flatten("rows.v").alias("query_values"))

    def best(batches):
        for batch in batches:
            for ids, values, query_ids, query_values in zip(
                    *(batch.column(c) for c in ("ids", "values", "query_ids", "query_values")),
                    strict=True):
                yield _top(*(np.asarray(s.values) for s in (ids, values, query_ids, query_values)), k)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    # A part with many blocks is a skewed join, which adaptive execution splits.
    found = asked.join(block, "part").select("ids", "values", "query_ids", "query_values").mapInArrow(
        best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = settle(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k),
                    "nearest")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _top(ids, values, query_ids, query_values, k: int) -> pa.RecordBatch:
    """The best rows of one block for each query of one group, ties in the order of ids."""
    x, q = values.reshape(len(ids), -1), query_values.reshape(len(query_ids), -1)
    near = q @ x.T
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    n = min(k, len(ids))
    least = -np.partition(-near, n - 1, axis=1)[:, n - 1]
    # The products' rounding depends on their place in a block; what might tie is worked out anew,
    # in the order of the components.
    slack = 1e-12 * (np.abs(q).sum(axis=1) * np.abs(x).max() + 1)
    at, row = np.nonzero((near >= (least - slack)[:, None]) & (near > -np.inf))
    score = np.zeros(len(at))
    for c in range(x.shape[1]):
        score += q[at, c] * x[row, c]
    order = np.lexsort((ids[row], -score, at))
    at, row, score = at[order], row[order], score[order]
    first = np.searchsorted(at, at)
    keep = np.arange(len(at)) - first < k
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[at[keep]]), pa.array(ids[row[keep]]), pa.array(score[keep])],
        ["query_id", "vec_id", "score"])


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    rows = usable(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "embedding")
    return search(rows, rows.filter(F.col("vec_id") % every == 0), k)
