"""Exact top-k inner products with a pivot table.

Distances of all vectors to a set of pivots are computed once. For a query and a candidate
the largest difference of their pivot distances bounds their distance from below, hence
the inner product (|q|^2 + |x|^2 - d^2) / 2 from above. Candidates are sorted by nearest pivot
and distance to it and cut into blocks, which keep the range of their distances to every
pivot. Each query first meets the block around its own nearest pivot, which sets its k-th
score. A block of queries then goes to a block of candidates only if the bound of some
query reaches its k-th score; there the parts of the block are scored in the order of
their bounds, each by one matrix product, until no bound reaches the k-th score. Candidates
are moved once, to where the queries come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.session import written_table

PIVOTS = 32
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
_PART, _PAGE = 512, 1024
#: Whole numbers up to here are exact, and so are inner products of vectors of such a square.
_EXACT = float(2**53)
_BLOCK = "rid binary, vec_id binary, x binary, near binary, low binary, high binary, norm double"


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the usable vectors, components floor(64 * x).

    Null ids, null vectors and vectors with a null or non-finite component are left out. A
    vector whose square is over 2^53, for which scores may not be exact, fails the job.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)

    def whole(x: Column) -> Column:
        big = x.cast("double") * 64
        return F.when(F.abs(big) >= _EXACT, big).otherwise(F.floor(big).cast("double"))

    v = F.transform("embedding", whole)
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    checked = F.when(square <= _EXACT, F.col("v")).otherwise(F.raise_error(F.lit("a vector is too large for exact scores")).cast("array<double>"))
    return usable.select(F.col("vec_id").cast("long"), v.alias("v")).select("vec_id", checked.alias("v"), F.size("v").alias("dim"))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64).reshape(len(vectors), dim)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in four bytes each where they fit."""
    small = x.size == 0 or np.abs(x).max() < 1 << 24
    return x.astype(np.float32 if small else np.float64).tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.float32 if len(data) == 4 * rows * dim else np.float64
    return np.frombuffer(data, kind).reshape(rows, dim).astype(np.float64)


def _homes(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(rid, vec_id, v, home, far): nearest pivot and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = _distances(_matrix(batch["v"], pivots.shape[1]), pivots)
            yield batch.assign(home=near.argmin(1).astype(np.int32), far=near.min(1))

    return rows.select("rid", "vec_id", "v").mapInPandas(assign, "rid long, vec_id long, v array<double>, home int, far double")


def _blocks(rows: DataFrame, size: int, pivots: np.ndarray) -> DataFrame:
    """Blocks of at most ``size`` vectors of one home, nearest first, with pivot distances.

    A home with many vectors is dealt to many tasks, as ranges are cut by distance too.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def drain(rest: pd.DataFrame) -> pd.DataFrame:
            x = _matrix(rest["v"], pivots.shape[1])
            near = _distances(x, pivots)
            cells = [rest["rid"].to_numpy(np.int64), rest["vec_id"].to_numpy(np.int64)]
            packed = [c.tobytes() for c in cells] + [_packed(x)] + [c.tobytes() for c in (near, near.min(0), near.max(0))]
            row = [int(rest["home"].iloc[0]), float(rest["far"].iloc[0]), *packed, float((x**2).sum(1).max())]
            return pd.DataFrame([row], columns=["home", "far", *_NAMES])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < size and held[0]["home"].iloc[0] == batch["home"].iloc[-1]:
                continue
            rest = pd.concat(held)
            for home, same in rest.groupby("home", sort=True):
                last = home == rest["home"].iloc[-1]
                while len(same) >= size or (len(same) and not last):
                    yield drain(same.iloc[:size])
                    same = same.iloc[size:]
                held = [same] if len(same) else []
        for rest in held:
            yield drain(rest)

    ranges = rows.repartitionByRange("home", "far", "rid").sortWithinPartitions("home", "far", "rid")
    return ranges.mapInPandas(build, f"home int, far double, {_BLOCK}")


_NAMES = [part.split()[0] for part in _BLOCK.split(", ")]


def _gap(near: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance between each row of ``near`` and vectors with pivot distances in each
    range: the most that any pivot proves."""
    out = np.zeros((len(near), len(low)))
    for p in range(near.shape[1]):
        own = near[:, p, None]
        np.maximum(out, np.maximum(own - high[:, p], low[:, p] - own), out=out)
    return out


def _bound(q_norm: np.ndarray, x_norm: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """At least every inner product; the last terms outweigh rounding of the distances."""
    both = q_norm[:, None] + x_norm
    return (both - gap**2) / 2 + 0.5 + 1e-6 * both


def best_of(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each of n queries, and the k-th scores (-inf below k entries)."""
    order = np.lexsort((ids, -scores, at))
    at, scores, ids = at[order], scores[order], ids[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    kth = np.full(n, -np.inf)
    kth[at[rank == k - 1]] = scores[rank == k - 1]
    kept = rank < k
    return at[kept], scores[kept], ids[kept], kth


def search_block(q, q_near, q_rid, reached, x, near, rid, ids, k: int):
    """(query positions, scores, candidate ids): the block's best k of each query, without
    those under the k-th score already ``reached``."""
    q_norm, x_norm = (q**2).sum(1), (x**2).sum(1)
    cuts = np.arange(0, len(x), _PART)
    low, high = np.minimum.reduceat(near, cuts), np.maximum.reduceat(near, cuts)
    bound = _bound(q_norm, np.maximum.reduceat(x_norm, cuts), _gap(q_near, low, high))
    at, scores, found = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    least = reached.copy()
    left = list(np.argsort(-bound.max(0), kind="stable"))
    while left and (bound[:, left] >= least[:, None]).any():
        part = left.pop(0)
        open_ = np.flatnonzero(bound[:, part] >= least)
        if not len(open_):
            continue
        rows = slice(cuts[part], cuts[part] + _PART)
        s = q[open_] @ x[rows].T
        hit = (s >= least[open_, None]) & (q_rid[open_, None] != rid[None, rows])
        a, b = np.nonzero(hit)
        if len(a):
            joined = np.concatenate([at, open_[a]]), np.concatenate([scores, s[a, b]]), np.concatenate([found, ids[rows][b]])
            at, scores, found, kth = best_of(*joined, k, len(q))
            least = np.maximum(least, kth)
    return at, scores, found


def _opened(r, prefix: str, dim: int):
    rid, ids = (np.frombuffer(getattr(r, f"{prefix}_{c}"), np.int64) for c in ("rid", "vec_id"))
    near = np.frombuffer(getattr(r, f"{prefix}_near"), np.float64).reshape(len(rid), -1)
    return _unpacked(getattr(r, f"{prefix}_x"), len(rid), dim), near, rid, ids


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows other than the query's own.

    Ties go to the smaller vec_id. Vectors of different lengths are never compared.
    Repeated rows are rows of their own: each copy of a query is one and meets its copies.
    No usable query, as in an empty table, gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    placed = written_table(scaled(vectors), "vectors")
    rows = written_table(placed.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    dims = [r["dim"] for r in rows.groupBy("dim").agg(F.count_if(is_query).alias("queries")).where("queries > 0").collect()]
    parts = [_found(rows.where(F.col("dim") == dim), is_query, dim, k) for dim in dims]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part)
    order = Window.partitionBy("query_rid", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, is_query: Column, dim: int, k: int) -> DataFrame:
    """(query_rid, query_id, vec_id, score) of one vector length, the k best of each block."""
    picked = rows.orderBy(F.xxhash64("rid"), "rid").limit(PIVOTS).collect()
    pivots = np.array([r["v"] for r in picked], np.float64).reshape(len(picked), dim)
    blocks = written_table(_blocks(_homes(rows, pivots), CANDIDATE_BLOCK, pivots).withColumn("no", F.monotonically_increasing_id()), "blocks")
    candidates = blocks.select("home", "far", "no", *[F.col(c).alias(f"c_{c}") for c in _NAMES])
    queries = _blocks(_homes(rows.where(is_query), pivots), QUERY_BLOCK, pivots)
    names = [f"q_{c}" for c in _NAMES]
    queries = queries.select("home", *[F.col(c).alias(n) for c, n in zip(_NAMES, names)])

    # The first block of each home, at most PIVOTS rows, sets the scores to reach.
    first = candidates.groupBy("home").agg(F.min(F.struct("far", "no")).alias("first")).select(F.col("first.no").alias("no"))
    around = candidates.join(F.broadcast(first), "no", "left_semi").drop("no", "far")

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, r in enumerate(batch.itertuples()):
                (q, q_near, q_rid, _), (x, near, rid, ids) = _opened(r, "q", dim), _opened(r, "c", dim)
                at, scores, found = search_block(q, q_near, q_rid, np.full(len(q), -np.inf), x, near, rid, ids, k)
                yield batch.iloc[[i]][names].assign(q_reached=best_of(at, scores, found, k, len(q))[3].tobytes())

    kinds = ", ".join(f"q_{part}" for part in _BLOCK.split(", "))
    asked = queries.join(around, "home").mapInPandas(reach, f"{kinds}, q_reached binary")
    asked = written_table(asked.withColumn("q_no", F.monotonically_increasing_id()), "queries")

    # Each block of queries meets the pages that tell about blocks of candidates; a pair of
    # blocks goes on only if its bound reaches some query's score.
    def page(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), _PAGE):
                part = batch.iloc[i : i + _PAGE]
                cells = [part["no"].to_numpy(np.int64).tobytes(), b"".join(part["low"]), b"".join(part["high"]), part["norm"].to_numpy(np.float64).tobytes()]
                yield pd.DataFrame([cells], columns=["no", "low", "high", "norm"])

    pages = blocks.select("no", "low", "high", "norm").mapInPandas(page, "no binary, low binary, high binary, norm binary")
    pages = written_table(pages.withColumn("page", F.monotonically_increasing_id()), "pages")
    wanted = asked.select("q_no", *names, "q_reached", F.explode(pages.agg(F.collect_list("page")).scalar()).alias("page"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                q, q_near, _, _ = _opened(r, "q", dim)
                no, norm = np.frombuffer(r.no, np.int64), np.frombuffer(r.norm, np.float64)
                low, high = (np.frombuffer(b, np.float64).reshape(len(no), -1) for b in (r.low, r.high))
                bound = _bound((q**2).sum(1), norm, _gap(q_near, low, high))
                open_ = (bound >= np.frombuffer(r.q_reached, np.float64)[:, None]).any(0)
                yield pd.DataFrame({"q_no": r.q_no, "no": no[open_]})

    pairs = wanted.join(pages, "page").mapInPandas(choose, "q_no long, no long")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                (q, q_near, q_rid, q_ids), (x, near, rid, ids) = _opened(r, "q", dim), _opened(r, "c", dim)
                at, scores, found = search_block(q, q_near, q_rid, np.frombuffer(r.q_reached, np.float64), x, near, rid, ids, k)
                yield pd.DataFrame({"query_rid": q_rid[at], "query_id": q_ids[at], "vec_id": found, "score": scores.astype(np.int64)})

    sent = pairs.join(asked, "q_no").select("no", *names, "q_reached").join(candidates, "no")
    return sent.mapInPandas(search, "query_rid long, query_id long, vec_id long, score long")


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


OP8_SQL = """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
