"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are spread by hash over shards of about SHARD_ROWS; every shard builds one graph. Points enter in
batches: a greedy beam search over the graph so far proposes neighbours, and relaxed distance pruning
keeps diverse edges (a candidate goes if a kept edge is closer to it by the factor ALPHA), at most
DEGREE a point; reverse edges are added and pruned likewise. A query is answered by a beam search in
every shard, and the shards' best are merged; final scores are computed in double precision.

Nearness is the largest inner product; for building, a further component makes all vectors equally long,
so the nearest in distance is the largest in product. Equal vectors are one point of a graph: groups of
copies of any size cost one point, and the k+1 smallest ids of a group answer for all of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.llm.common import small_batches, whole_batches
from snapmill.runtime import materialize

SHARD_ROWS = 8_192
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.15
QUERY_BLOCK = 1_024


def beam_search(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int,
                offset: np.ndarray | None = None, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Ids (queries x beam) and their keys, ascending; -1 and inf where fewer were reached.

    The key is offset - 2 x.q, the squared distance up to a constant, or without offset -2 x.q. All
    queries advance together, each expanding its `expand` best points that are not expanded yet.
    """
    b, n = len(queries), len(x)
    width = graph.shape[1]
    seen = np.zeros((b, n + 1), bool)
    ids = np.full((b, beam + expand * width), n, np.int32)
    keys = np.full(ids.shape, np.inf, np.float32)
    done = np.ones(ids.shape, bool)
    first = np.repeat(entry[None, :], b, axis=0)
    rows = np.arange(b)[:, None]
    m = first.shape[1]
    ids[:, :m] = first
    keys[:, :m] = -2 * queries @ x[entry].T + (offset[entry] if offset is not None else 0)
    done[:, :m] = False
    seen[rows, first] = True
    seen[:, n] = True
    active = np.arange(b)
    while len(active):
        k = np.where(done[active, :beam], np.inf, keys[active, :beam])
        pick = np.argpartition(k, expand - 1, axis=1)[:, :expand] if beam > expand else np.argsort(k, axis=1)[:, :expand]
        fresh = np.isfinite(np.take_along_axis(k, pick, axis=1))
        going = fresh.any(axis=1)
        active, pick, fresh = active[going], pick[going], fresh[going]
        if not len(active):
            break
        at = active[:, None]
        done[at, pick] = True
        chosen = np.where(fresh, ids[at, pick], n)
        near = np.where(chosen[:, :, None] < n, graph[np.minimum(chosen, n - 1)], n).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        near = np.where(seen[at, near], n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        seen[at, near] = True
        some = near < n
        r, c = np.nonzero(some)
        value = np.full(near.shape, np.inf, np.float32)
        v = near[r, c]
        value[r, c] = -2 * np.einsum("ij,ij->i", queries[active[r]], x[v]) + (offset[v] if offset is not None else 0)
        wide = near.shape[1]
        all_keys = np.concatenate((keys[active, :beam], value), axis=1)
        all_ids = np.concatenate((ids[active, :beam], near), axis=1)
        all_done = np.concatenate((done[active, :beam], ~some), axis=1)
        best = np.argpartition(all_keys, beam - 1, axis=1)[:, :beam] if wide else np.arange(beam)[None, :]
        keys[at, np.arange(beam)] = np.take_along_axis(all_keys, best, axis=1)
        ids[at, np.arange(beam)] = np.take_along_axis(all_ids, best, axis=1)
        done[at, np.arange(beam)] = np.take_along_axis(all_done, best, axis=1)
    o = np.argsort(keys[:, :beam], axis=1, kind="stable")
    ids = np.take_along_axis(ids[:, :beam], o, axis=1)
    return np.where(ids == n, -1, ids), np.take_along_axis(keys[:, :beam], o, axis=1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Kept neighbours of each point, nearest first, -1 where there are fewer; candidates hold -1 for none."""
    valid = (candidates >= 0) & (candidates != points[:, None])
    c = x[np.where(valid, candidates, 0)]
    own = x[points]
    distance = np.where(valid, np.square(c - own[:, None, :]).sum(axis=2), np.inf)
    o = np.argsort(distance, axis=1, kind="stable")
    distance, c = np.take_along_axis(distance, o, axis=1), np.take_along_axis(c, o[:, :, None], axis=1)
    names = np.take_along_axis(candidates, o, axis=1)
    square = np.square(c).sum(axis=2)
    between = square[:, :, None] + square[:, None, :] - 2 * (c @ c.transpose(0, 2, 1))
    alive = np.isfinite(distance)
    # the same candidate twice has distance zero to itself and is pruned by the first
    out = np.full((len(points), degree), -1, np.int32)
    rows = np.arange(len(points))
    for k in range(degree):
        j = np.argmax(alive, axis=1)
        some = alive[rows, j]
        if not some.any():
            break
        out[some, k] = names[rows[some], j[some]]
        alive &= ~(some[:, None] & (alpha * alpha * between[rows, j] <= distance))
        alive[rows, j] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Neighbours (n x degree, -1 where there are fewer) and the entry point, the one nearest to the mean."""
    n = len(x)
    x = np.ascontiguousarray(x, np.float32)
    square = np.square(x).sum(axis=1)
    graph = np.full((n, degree), -1, np.int32)
    middle = x.mean(axis=0)
    entry = int(np.argmin(square - 2 * x @ middle))
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    start = order[:min(n, 256)]
    d = square[start][None, :] - 2 * x[start] @ x[start].T
    near = start[np.argsort(d, axis=1)[:, :beam + 1]]
    graph[start] = robust_prune(x, start, near, degree, alpha)
    at = len(start)
    while at < n:
        batch = order[at:at + min(max(at // 2, 128), 1024)]
        found, _ = beam_search(x, graph, np.array([entry]), x[batch], beam, square)
        graph[batch] = robust_prune(x, batch, found, degree, alpha)
        at += len(batch)
        # reverse edges
        r, c = np.nonzero(graph[batch] >= 0)
        to, source = graph[batch][r, c], batch[r]
        o = np.argsort(to, kind="stable")
        to, source = to[o], source[o]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        have = (graph[nodes] >= 0).sum(axis=1)
        place = np.arange(len(to)) - np.repeat(first, count)
        row = np.repeat(np.arange(len(nodes)), count)
        fits = have + count <= degree
        ok = fits[row]
        graph[to[ok], have[row[ok]] + place[ok]] = source[ok]
        full = np.flatnonzero(~fits)
        if len(full):
            wide = np.full((len(nodes), degree + int(min(count[full].max(), 2 * degree))), -1, np.int32)
            wide[:, :degree] = graph[nodes]
            ok = ~fits[row] & (place < wide.shape[1] - degree)
            wide[row[ok], degree + place[ok]] = source[ok]
            for part in np.array_split(full, max(1, len(full) // 512)):
                graph[nodes[part]] = robust_prune(x, nodes[part], wide[part], degree, alpha)
    return graph, entry


def _array(blob: bytes, kind: str, width: int) -> np.ndarray:
    out = np.frombuffer(blob, kind)
    return out.reshape(-1, width) if width else out


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20, shard_rows: int = SHARD_ROWS, degree: int = DEGREE,
            build_beam: int = BUILD_BEAM, beam: int = SEARCH_BEAM, alpha: float = ALPHA) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose vec_id is divisible by `every`.

    Candidates are all rows but those with the query's own vec_id; ties go to the smaller vec_id. Rows whose
    vec_id is null, and vectors that are null, empty, zero, hold a null or non-finite component or have
    another length than most, take no part; rows repeated with vec_id and vector count once.
    """
    spark = embeddings.sparkSession
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where("vec_id is not null and embedding is not null and forall(embedding, x -> coalesce(abs(x) < double('infinity'), false)) "
                   "and exists(embedding, x -> x <> 0)"))
    rows = rows.where("forall(embedding, x -> not isnan(x))")
    rows = materialize(rows.select("vec_id", "embedding", F.xxhash64("embedding").alias("a"), F.xxhash64(F.lit(1), "embedding").alias("b")))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    width = sizes["n"]
    rows = rows.where(F.size("embedding") == width)

    # one point for each distinct vector, with the k+1 smallest ids that have it
    order = F.row_number().over(Window.partitionBy("a", "b").orderBy("vec_id"))
    ids = rows.select("vec_id", "a", "b").distinct()
    members = materialize(ids.withColumn("n", order).where(F.col("n") <= k + 1).groupBy("a", "b")
                          .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("least")))
    points = materialize(rows.groupBy("a", "b").agg(F.min("vec_id").alias("least"), F.any_value("embedding").alias("embedding")))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)
    total = points.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("square")).first()
    shards = max(1, -(-total["n"] // shard_rows))
    longest = float(total["square"])

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        v = np.array(shard["embedding"].tolist(), np.float64)
        extra = np.sqrt(np.maximum(longest - np.square(v).sum(axis=1), 0.0))
        graph, entry = build_graph(np.column_stack((v, extra)), degree, build_beam, alpha)
        keys = shard[["a", "b", "least"]].to_numpy(np.int64)
        return pd.DataFrame({"shard": [int(shard["shard"].iloc[0])], "entry": [entry], "keys": [keys.tobytes()],
                             "vectors": [v.tobytes()], "edges": [graph.tobytes()]})

    graphs = materialize(points.withColumn("shard", F.pmod(F.col("a"), F.lit(shards)).cast("int")).groupBy("shard")
                         .applyInPandas(build, "shard int, entry int, keys binary, vectors binary, edges binary"))

    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    asking = asked.groupBy("a", "b").agg(F.any_value("embedding").alias("embedding"))
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))

    def block_of(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [int(part["block"].iloc[0])], "asked": [part[["a", "b"]].to_numpy(np.int64).tobytes()],
                             "targets": [np.array(part["embedding"].tolist(), np.float64).tobytes()]})

    packed = (asking.withColumn("block", F.pmod(F.xxhash64("b"), F.lit(blocks)).cast("int")).groupBy("block")
              .applyInPandas(block_of, "block int, asked binary, targets binary"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                keys, exact = _array(r.keys, "<i8", 3), _array(r.vectors, "<f8", width)
                graph, v = _array(r.edges, "<i4", degree), exact.astype(np.float32)
                who, q = _array(r.asked, "<i8", 2), _array(r.targets, "<f8", width)
                for at in range(0, len(q), 256):
                    part = q[at:at + 256]
                    # the beam also holds what ties with the last
                    found, _ = beam_search(v, graph, np.array([r.entry]), part.astype(np.float32), max(beam, 2 * k))
                    i, j = np.nonzero(found >= 0)
                    hit = found[i, j]
                    score = (part[i] * exact[hit]).sum(axis=1)
                    o = np.lexsort((keys[hit, 2], -score, i))
                    i, hit, score = i[o], hit[o], score[o]
                    place = np.arange(len(i)) - np.searchsorted(i, i)
                    top = place <= k
                    i, hit, score = i[top], hit[top], score[top]
                    yield pd.DataFrame({"qa": who[at + i, 0], "qb": who[at + i, 1], "a": keys[hit, 0], "b": keys[hit, 1],
                                        "least": keys[hit, 2], "score": score})

    small_batches(spark, 1)
    spread = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    hits = materialize(spread.join(graphs, "shard").select("entry", "keys", "vectors", "edges", "asked", "targets")
                       .mapInPandas(search, "qa long, qb long, a long, b long, least long, score double"))
    whole_batches(spark)
    best = F.row_number().over(Window.partitionBy("qa", "qb").orderBy(F.desc("score"), "least"))
    classes = hits.withColumn("n", best).where(F.col("n") <= k + 1)
    one = F.row_number().over(Window.partitionBy("qa", "qb").orderBy(F.desc("score"), "vec_id"))
    near = (classes.join(members, ["a", "b"]).select("qa", "qb", "score", F.explode("ids").alias("vec_id"))
            .withColumn("n", one).where(F.col("n") <= k + 1).select("qa", "qb", "score", "vec_id"))
    who = asked.select(F.col("vec_id").alias("query_id"), F.col("a").alias("qa"), F.col("b").alias("qb")).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (who.join(near, ["qa", "qb"]).where("vec_id != query_id").withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
