"""Centroid clustering of integer vectors with exact results, spared most distances by ns-bounds.

Each vector keeps, for every centroid, the squared distance at the round it was last evaluated, and that round. The
history of all centroids is kept too, a few rows a round. In a later round the old distance, loosened by the norm of the
centroid's total displacement since then (not by the sum of its steps), bounds the present one. Only centroids whose
bound does not settle that they are farther than the vector's own are evaluated again, in exact integers.

A round is one pass over a written table of vectors and bounds; each task adds the sums of its clusters as a row for
each, so the next centroids come from those rows alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, new_path, removed, stored, table, trimmed

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Integer components lie within this, so that sums of squares fit 64 bits; larger ones count as it.
MOST = 1 << 27
#: Relative slack of the bounds, above the rounding of double arithmetic on exact squares.
SLACK = 1e-9
_STATE = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("cluster", pa.int32()), ("seen", pa.binary()), ("at", pa.binary()), ("distance", pa.int64()), ("sums", pa.binary()), ("n", pa.int64())])
_DDL = "vec_id long,v binary,cluster int,seen binary,at binary,distance long,sums binary,n long"


def quantized(df: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of ``dims`` finite components as floor(scale * x), little-endian 32-bit; all others are left out."""
    bounded(df.sparkSession)
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))  # a NaN is greater than all
    kept = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dims) & fine)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy().reshape(-1, dims)
                whole = np.clip(np.floor(flat * scale), -MOST, MOST).astype("<i4")
                yield pa.RecordBatch.from_arrays([batch.column(0), _rows_of(whole)], names=["vec_id", "v"])

    return kept.mapInArrow(trimmed(run), "vec_id long,v binary")


def _rows_of(a: np.ndarray) -> pa.Array:
    """Each row of a two-dimensional array as bytes."""
    a = np.ascontiguousarray(a)
    width = a.shape[1] * a.itemsize
    ends = np.arange(len(a) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends), pa.py_buffer(a.tobytes())])


def _array_of(column: pa.Array, kind: str, width: int) -> np.ndarray:
    _, _, data = column.buffers()
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind).reshape(-1, width) if len(column) else np.zeros((0, width), kind)


def _squares(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


def assigned(v: np.ndarray, history: np.ndarray, cluster: np.ndarray | None, seen: np.ndarray | None, at: np.ndarray | None, last: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, seen, at, distance, evaluations) of vectors v in the round that history (rounds, centroids, dims) ends with.

    seen holds squared distances to the centroids as of round at. distance is exact where the vector was evaluated
    against its own centroid in this round, as it always is with ``last``; else -1.
    """
    now, centroids = len(history) - 1, history[-1]
    rows, k = len(v), len(centroids)
    every = np.arange(rows)
    if cluster is None:
        seen = np.stack([_squares(v, c) for c in centroids], axis=1)
        cluster = seen.argmin(axis=1)
        return cluster, seen, np.full((rows, k), now, np.uint8), seen[every, cluster], rows * k
    seen, at = seen.copy(), at.copy()
    moved = np.sqrt(((history - centroids).astype(float) ** 2).sum(axis=2))  # by round of evaluation and centroid
    away = moved[at, np.arange(k)]
    old = np.sqrt(seen.astype(float))
    low = (old - away) * (1 - SLACK) - SLACK
    own = old[every, cluster] + away[every, cluster]
    open_ = low <= (own * (1 + SLACK) + SLACK)[:, None]
    open_[every, cluster] = False
    again = np.flatnonzero(open_.any(axis=1) | last)
    count = 0
    distance = np.full(rows, -1, np.int64)
    if len(again):
        seen[again, cluster[again]] = _squares(v[again], centroids[cluster[again]])  # the own distance first: it may settle more
        at[again, cluster[again]] = now
        count = len(again)
        exact = np.sqrt(seen[again, cluster[again]].astype(float))
        test = low[again] <= (exact * (1 + SLACK) + SLACK)[:, None]
        test[np.arange(len(again)), cluster[again]] = False
        value = np.full((len(again), k), np.iinfo(np.int64).max)
        value[np.arange(len(again)), cluster[again]] = seen[again, cluster[again]]
        for j in range(k):
            some = np.flatnonzero(test[:, j])
            if len(some):
                r = again[some]
                seen[r, j] = value[some, j] = _squares(v[r], centroids[j])
                at[r, j] = now
                count += len(some)
        cluster = cluster.copy()
        cluster[again] = value.argmin(axis=1)
        distance[again] = value.min(axis=1)
    return cluster, seen, at, distance, count


def _pass(state: DataFrame, history: np.ndarray, dims: int, first: bool, last: bool) -> DataFrame:
    """The state after one more assignment, and for each task and cluster a row of the sums of its vectors (distances, with ``last``)."""
    k = history.shape[1]

    def run(batches):
        sums, n, total = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _array_of(batch.column(1), "<i4", dims)
            held = (None, None, None) if first else (batch.column(2).to_numpy().astype(np.int64), _array_of(batch.column(3), "<i8", k), _array_of(batch.column(4), "u1", k))
            cluster, seen, at, distance, _ = assigned(v, history, *held, last=last)
            for j in np.unique(cluster):
                own = cluster == j
                sums[j] += v[own].sum(axis=0, dtype=np.int64)
                n[j] += own.sum()
                total[j] += distance[own].sum() if last else 0
            none = pa.nulls(len(v), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), none if last else batch.column(1), pa.array(cluster, pa.int32()), none if last else _rows_of(seen.astype("<i8")), none if last else _rows_of(at), pa.array(distance), none, pa.nulls(len(v), pa.int64())], schema=_STATE)
        some = np.flatnonzero(n)
        if len(some):
            gone = pa.nulls(len(some), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), gone, pa.array(some, pa.int32()), gone, gone, pa.array(total[some]), _rows_of(sums[some].astype("<i8")), pa.array(n[some])], schema=_STATE)

    return state.mapInArrow(trimmed(run), _DDL)


def _totals(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(sums, counts, distances) by cluster, added up over the tasks' rows in one more step of tasks; k rows come here."""
    rows = state.where("n IS NOT NULL").select("cluster", "sums", "n", "distance")

    def run(batches):
        sums, n, total = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            c = batch.column(0).to_numpy()
            np.add.at(sums, c, _array_of(batch.column(1), "<i8", dims))
            np.add.at(n, c, batch.column(2).to_numpy())
            np.add.at(total, c, batch.column(3).to_numpy())
        for j in np.flatnonzero(n):
            yield pa.RecordBatch.from_arrays([pa.array([j]), pa.array([sums[j].tolist()], pa.list_(pa.int64())), pa.array([n[j]]), pa.array([total[j]])], names=["cluster", "sums", "n", "distance"])

    parts = rows.mapInArrow(trimmed(run), "cluster long,sums array<long>,n long,distance long")
    each = parts.groupBy("cluster").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dims)]).alias("sums"), F.sum("n").alias("n"), F.sum("distance").alias("distance")).collect()
    sums, n, total = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), [0] * k
    for r in each:
        sums[r.cluster], n[r.cluster], total[r.cluster] = r.sums, r.n, r.distance
    return sums, n, total


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of '<seed>:<vec_id>', in that order; equal ids by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(name, 256), "v").limit(k).select("v").collect()
    return np.array([np.frombuffer(r.v, "<i4") for r in rows], np.int64).reshape(-1, dims)


def cluster(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable row, and the final centroids.

    Vectors with other than ``dims`` components, or with null or non-finite ones, are left out. Ties go to the smaller
    number; a cluster without vectors keeps its centroid. Fewer vectors than k give as many clusters. Repeated rows each
    get a row; a null id is hashed as an empty one; components beyond MOST count as MOST. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = df.sparkSession
    state = stored(quantized(df, dims, scale, id_col, vector_col), "vectors")
    history = first_centroids(state, k, seed, dims)[None]
    if not history.shape[1]:
        return state.selectExpr("vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256").limit(0), history[0]
    k, before = history.shape[1], state.inputFiles()
    state, old = state.selectExpr("vec_id", "v", "cast(null as int) cluster", "cast(null as binary) seen", "cast(null as binary) at", "0L distance", "cast(null as binary) sums", "0L n"), None
    for r in range(rounds + 1):
        path = new_path(spark, "clusters")
        _pass(state, history, dims, r == 0, r == rounds).write.parquet(path)
        removed(spark, old or before[0].rsplit("/", 1)[0])
        whole = spark.read.schema(_DDL).parquet(path)
        state, old = whole.where("n IS NULL"), path
        sums, n, total = _totals(whole, k, dims)
        if r < rounds:
            history = np.concatenate([history, np.where(n[:, None] > 0, sums // np.maximum(n, 1)[:, None], history[-1])[None]])
    own = F.create_map(*[x for j in range(k) for x in (F.lit(j), F.lit(total[j]).cast("long"))])  # k entries
    sha = F.create_map(*[x for j in range(k) for x in (F.lit(j), F.lit(hashlib.sha256(",".join(map(str, history[-1, j].tolist())).encode()).hexdigest()))])
    out = state.select("vec_id", "cluster", "distance", own[F.col("cluster")].alias("cluster_inertia"), F.lit(sum(total)).cast("long").alias("inertia"), sha[F.col("cluster")].alias("centroid_sha256"))
    return out, history[-1]


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))[0]


def _sql() -> str:
    near = "select v.vec_id, v.x, min({{'d': list_sum(list_transform(generate_series(1, 64), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::bigint, 'k': c.k}}) as m from v cross join {c} c group by v.rid, v.vec_id, v.x"
    steps = [
        "v as materialized (select vec_id, rid, list_transform(e, lambda y: floor(1024 * y::double)::bigint) as x from (select vec_id, embedding as e, row_number() over () as rid from embeddings) q where len(e) = 64 and len(list_filter(e, lambda y: y is not null and isfinite(y))) = 64)",
        "c0 as materialized (select x, row_number() over (order by sha256('3:' || vec_id::varchar)) - 1 as k from v order by sha256('3:' || vec_id::varchar) limit 8)",
    ]
    for r in range(10):
        steps.append(f"a{r} as materialized ({near.format(c=f'c{r}')})")
        steps.append(f"s{r} as materialized (select m.k as k, i, sum(x[i])::hugeint as s, count(*)::hugeint as n from a{r}, generate_series(1, 64) g(i) group by m.k, i)")
        steps.append(f"c{r + 1} as materialized (select k, coalesce(u.x, c.x) as x from c{r} c left join (select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as x from s{r} group by k) u using (k))")
    steps.append(f"f as materialized ({near.format(c='c10')})")
    return "with " + ", ".join(steps) + " select f.vec_id, m.k::int as cluster, m.d as distance, (sum(m.d) over (partition by m.k))::bigint as cluster_inertia, (sum(m.d) over ())::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256 from f join c10 c on c.k = f.m.k"


OP13_SQL = _sql()
