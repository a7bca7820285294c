"""Exact top-k by inner product with columnar branch-and-bound.

Vectors are packed in blocks, a matrix each with a row a dimension (vertical layout), candidates in descending order of their norms. A query
adds up its scores a few dimensions at a time. What the dimensions left can still add is at most the product of the two vectors' remaining
norms, so each partial score has a lower and an upper bound; candidates whose upper bound is below the k-th lower bound are dropped and the
block is compacted before the next dimensions. Scores are exact integers: float64 while no sum can reach 2**53, whole Python
numbers beyond.

First every query searches the block of the largest norms of its length: its k-th score there is a floor that bounds all its other
searches, and a block of candidates whose largest norm cannot reach the floor of any query of a query block is not paired with it at
all. Numbering both kinds of blocks by these bounds makes the pairs of a block a prefix, so neither side is sent to a pair that is dropped. Of
the bounds of blocks at most STEPS are kept on the driver (rounded so that no pair is lost).

Queries are a stated part of the rows, so work is queries times rows at worst, but no row is sent for a pair of rows and nothing is
broadcast. Each meeting gives k rows a query; Spark's window limit cuts them to k before the shuffle.

Defined results: vectors that are null or hold a component that is null or not finite (also: not finite when scaled) take no part, nor
do null ids; empty vectors score 0 with each other; vectors of another length than the query's are no candidates; rows with the query's id are
its own; ties go to the smaller id; scores beyond 64 bits stop at its ends; other columns do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stash

CANDIDATES = 4096
QUERIES = 1024
DIMENSIONS = 16
#: The most bytes of a matrix; wide vectors make smaller blocks.
MATRIX_BYTES = 32 << 20
STEPS = 4096

_PACKED = "block int, width int, n int, ids binary, parts binary, top double"


def _packer(limit: int):
    def pack(batches):
        """Matrices of a task's vectors, one for each length and limit, as little-endian doubles of whole numbers, and their largest norms."""
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId(), [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        widths = pc.list_value_length(table["vector"]).to_numpy()
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            for k in range(0, len(at), limit):
                some = table.take(pa.array(at[k : k + limit]))
                flat = pc.list_flatten(some["vector"]).to_numpy().reshape(len(some), int(width))
                row = {"block": [block], "width": [int(width)], "n": [len(some)], "ids": [some["id"].to_numpy().astype("<i8").tobytes()], "parts": [np.ascontiguousarray(flat.T, "<f8").tobytes()], "top": [some["norm"].to_numpy().max()]}
                yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("block", pa.int32()), ("width", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("parts", pa.binary()), ("top", pa.float64())]))

    return pack


def search_block(ids: np.ndarray, matrix: np.ndarray, rests: np.ndarray, query_id: int, query: np.ndarray, k: int, step: int = DIMENSIONS, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best of a block that reach the floor. matrix: dimensions x vectors; rests: a vector's norm from each step on."""
    width = len(query)
    rest = np.sqrt(np.append(np.cumsum((query**2)[::-1])[::-1], 0.0)[::step] if width else np.zeros(1))
    alive = np.flatnonzero(ids != query_id)
    whole = len(alive) == len(ids)
    score = np.zeros(len(alive))
    for b in range(0, width, step):
        part = matrix[b : b + step] if whole else matrix[b : b + step, alive]
        score = score + query[b : b + step] @ part
        after = b // step + 1
        if b + step < width and (len(alive) > k or floor > -np.inf) and len(alive):
            slack = (rests[after][alive] * (rest[after] if after < len(rest) else 0.0)) * (1 + 1e-9) + 1e-6
            least = max(floor, np.partition(score - slack, len(alive) - k)[len(alive) - k]) if len(alive) > k else floor
            keep = score + slack >= least
            if keep.sum() < 0.8 * len(alive):
                alive, score, whole = alive[keep], score[keep], False
    if len(alive) > k:
        least = np.partition(score, len(alive) - k)[len(alive) - k]
        keep = score >= least
        alive, score = alive[keep], score[keep]
    order = np.lexsort([ids[alive], -score])[:k]
    return ids[alive[order]], score[order]


def _exact(ids: np.ndarray, matrix: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[list, list]:
    """As search_block, in whole Python numbers, for scores that float64 cannot hold; beyond 64 bits they stop at its ends."""
    q = [int(x) for x in query]
    found = sorted((-sum(a * int(b) for a, b in zip(q, matrix[:, i], strict=True)), int(ids[i])) for i in range(len(ids)) if ids[i] != query_id)[:k]
    return [i for _, i in found], [max(-(2**63), min(2**63 - 1, -s)) for s, _ in found]


class _Block:
    """A candidate block's matrix with the vectors' norms from each step on."""

    def __init__(self, width: int, n: int, ids: bytes, parts: bytes):
        self.ids, self.matrix = np.frombuffer(ids, "<i8"), np.frombuffer(parts, "<f8").reshape(width, n)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(self.matrix**2, np.arange(0, width, DIMENSIONS), axis=0) if width else np.zeros((0, n))
            self.rests = np.sqrt(np.concatenate([np.cumsum(sums[::-1], axis=0)[::-1], np.zeros((1, n))]))
        self.longest = self.rests[0].max() if n else 0.0

    def search(self, query_id: int, query: np.ndarray, k: int, floor: float) -> tuple[list, list]:
        with np.errstate(over="ignore"):
            safe = self.longest * np.sqrt((query**2).sum()) < 2.0**52
        if not safe:
            return _exact(self.ids, self.matrix, query_id, query, k)
        found, scores = search_block(self.ids, self.matrix, self.rests, query_id, query, k, floor=floor)
        return found.tolist(), scores.astype(np.int64).tolist()


def _queries(row: dict, ids: str, parts: str, n: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row[ids], "<i8"), np.ascontiguousarray(np.frombuffer(row[parts], "<f8").reshape(row["width"], row[n]).T)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows with the highest inner product with each query; components are floor(scale * x).

    Runs jobs when it is called."""
    pairs = block_pairs(rows, queries, k, id, vector, scale)

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["width"], row["n"], row["ids"], row["parts"])
                ids, vectors = _queries(row, "q_ids", "q_parts", "m")
                floors = np.frombuffer(row["floors"], "<f8")
                a, b, c = [], [], []
                for i in range(len(ids)):
                    found, scores = block.search(int(ids[i]), vectors[i], k, floors[i])
                    a += [int(ids[i])] * len(found)
                    b += found
                    c += scores
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.int64())})

    found = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def block_pairs(rows: DataFrame, queries: DataFrame, k: int, id: str, vector: str, scale: float) -> DataFrame:
    """The pairs of candidate blocks (c, ids, parts) and query blocks (r, q_ids, q_parts, floors) that may hold answers."""

    def usable(df: DataFrame) -> DataFrame:
        scaled = F.transform(F.col(vector), lambda x: F.when(F.abs(x.cast("double")) < 2.0**52, F.floor(x.cast("double") * F.lit(float(scale))).cast("double")).otherwise(x.cast("double") * F.lit(float(scale))))
        sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
        return df.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).select(F.col(id).cast("long").alias("id"), scaled.alias("vector")).where(sound).withColumn("norm", norm)

    def packed(df: DataFrame, most: int, *order) -> tuple[DataFrame, int]:
        n, width = df.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
        limit = max(16, min(most, MATRIX_BYTES // (8 * max(width, 1))))
        blocks = max(1, -(-n // limit))
        dealt = df.repartitionByRange(blocks, *order, F.xxhash64("id")).sortWithinPartitions(*order, F.xxhash64("id")) if order else df.repartition(blocks, "id")
        return stash(dealt.mapInArrow(_packer(2 * limit), _PACKED)), blocks

    candidates, n_candidates = packed(usable(rows), CANDIDATES, F.col("norm").desc())
    asked, n_asked = packed(usable(queries), QUERIES)
    # of each length the block of the largest norms that has more than k vectors
    seed = F.max_by(F.struct("n", "ids", "parts"), F.struct(F.col("n") > k, F.col("top")))
    seeds = candidates.groupBy("width").agg(seed.alias("seed")).select("width", F.col("seed.n").alias("s_n"), F.col("seed.ids").alias("s_ids"), F.col("seed.parts").alias("s_parts"))

    def first(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, vectors = _queries(row, "ids", "parts", "n")
                block = _Block(row["width"], row["s_n"], row["s_ids"], row["s_parts"])
                floors, needs = np.full(len(ids), -np.inf), np.zeros(len(ids))
                for i in range(len(ids)):
                    scores = block.search(int(ids[i]), vectors[i], k, -np.inf)[1]
                    with np.errstate(over="ignore"):
                        norm = np.sqrt((vectors[i] ** 2).sum())
                    if len(scores) == k and norm * block.longest < 2.0**52:
                        floors[i] = scores[-1]
                        needs[i] = floors[i] / norm * (1 - 1e-9) - 1e-6 if floors[i] > 0 else 0.0
                yield pa.RecordBatch.from_pydict({"q": [row["block"]], "width": [row["width"]], "m": [row["n"]], "q_ids": [row["ids"]], "q_parts": [row["parts"]], "floors": [floors.astype("<f8").tobytes()], "need": [float(needs.min())]}, schema=pa.schema([("q", pa.int32()), ("width", pa.int32()), ("m", pa.int32()), ("q_ids", pa.binary()), ("q_parts", pa.binary()), ("floors", pa.binary()), ("need", pa.float64())]))

    floored = stash(asked.join(seeds, "width").mapInArrow(first, "q int, width int, m int, q_ids binary, q_parts binary, floors binary, need double"))
    # query blocks in ascending order of what norm they need: a row a block
    ranks = stash(floored.groupBy("q").agg(F.min("need").alias("least")).select("q", "least", (F.row_number().over(Window.orderBy("least", "q")) - 1).alias("r")))
    tops = candidates.groupBy("block").agg(F.max("top").alias("top"))
    step, stride = -(-n_asked // STEPS), -(-n_candidates // STEPS)
    needs = sorted(x[0] for x in ranks.where(F.col("r") % step == 0).select("least").collect())  # at most STEPS numbers
    best = tops.groupBy(F.floor(F.col("block") / stride).alias("part")).agg(F.max("top")).collect()  # at most STEPS numbers
    best = dict(best)
    known = float("inf")
    best = [known := best.get(part, known) for part in range(-(-n_candidates // stride))]  # of a part without blocks that of the one before

    def reached(value, bounds: list[float], width: int, every: int, test) -> Column:
        """How many numbered blocks, from 0, may pass the test."""
        counted = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda x: test(x, value))) if bounds else F.lit(0)
        return F.least(counted * width, F.lit(every))

    upto = lambda n: F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))
    left = candidates.select(F.col("block").alias("c"), upto(reached(F.col("top"), needs, step, n_asked, lambda x, v: x <= v).cast("int")).alias("r"), "width", "n", "ids", "parts")
    wanted = floored.join(ranks, "q")
    right = wanted.select(upto(reached(F.col("least"), best, stride, n_candidates, lambda x, v: x >= v).cast("int")).alias("c"), "r", "width", "m", "q_ids", "q_parts", "floors")
    return left.join(right.hint("shuffle_merge"), ["c", "r", "width"])


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
