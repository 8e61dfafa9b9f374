"""Exact top-k by inner product over norm-sorted blocks.

Vectors are sorted by descending length and packed into blocks. A rotation
(right singular vectors, from the d x d sum of outer products that Spark adds
up over all rows) moves most of the length to the first coordinates. For a
query q and a candidate x, the partial sum over the first m rotated
coordinates plus the product of the two remaining lengths bounds the inner
product (Cauchy-Schwarz).

Each block of queries first meets the block of longest vectors; the k-th best
score there is a floor. Then it meets every block, unless the block's greatest
length shows that no score can reach a floor: as lengths fall, those blocks are
a prefix, found from bare numbers before any vector is sent; inside a pair of blocks,
candidates and queries without a chance leave after a quarter and a half of
the coordinates, and what is left gets exact integer scores. Bounds have a
margin for rounding, so a candidate at the floor stays. Every pair of blocks
gives at most k rows a query.

A query set is a share of the table, so pairs of blocks are what the question
asks for; a block of queries is sent to each block of candidates, nothing is
broadcast but one block of ``BLOCK`` vectors.

Defined results: vectors that are null, or hold null, NaN or infinity, take no
part, nor do those with a component beyond double when scaled; scores beyond
the range of long count as its ends; an empty vector has the score 0 with every other, and shorter vectors
count as filled up with zeros; a query never meets its own row, but meets
other rows with its vec_id; rows with a null vec_id are candidates with the
lowest preference in a tie and no queries; ties go to the smaller vec_id;
fewer candidates than k give as many rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, read_table, staged
from .vectors import NO_ID, scaled_rows, whole_scores

BLOCK = 2048
QUERIES = 1024


def best(scores, ids, query_rows, rows, k: int, floors=None):
    """For each query (position, candidate position) of its k best scores, ties to the smaller id."""
    import numpy as np

    out = []
    for i in range(len(scores)):
        s = scores[i]
        ok = rows != query_rows[i]
        if floors is not None:
            ok &= s >= floors[i]
        at = np.flatnonzero(ok)
        if len(at) > k:
            at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
        out.append(at[np.lexsort((rows[at], ids[at], -s[at]))][:k])
    return out


def chances(q, x, floors, levels):
    """Positions of queries and of candidates that the bounds leave; q and x are rotated."""
    import numpy as np

    qs, xs = np.arange(len(q)), np.arange(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        return _chances(q, x, floors, levels, qs, xs)


def _chances(q, x, floors, levels, qs, xs):
    import numpy as np

    margin = 1e-9 * (np.linalg.norm(q, axis=1).max(initial=0) * np.linalg.norm(x, axis=1).max(initial=0) + 1) * q.shape[1] + 1e-6
    for m in levels:
        a, b = q[qs], x[xs]
        bound = a[:, :m] @ b[:, :m].T
        bound += np.linalg.norm(a[:, m:], axis=1)[:, None] * np.linalg.norm(b[:, m:], axis=1)[None, :]
        may = ~(bound + margin < floors[qs][:, None])  # what leaves the range of double may
        qs, xs = qs[may.any(axis=1)], xs[may.any(axis=0)]
        if not len(qs) or not len(xs):
            break
    return qs, xs


def _outer_sums(width: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((width, width))
        for batch in batches:
            _, x = scaled_rows(batch.column("embedding"), width)
            with np.errstate(over="ignore", invalid="ignore"):
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(width * width), pa.int64()), pa.array(total.ravel())], ["at", "value"])

    return run


def rotation(vectors: DataFrame, width: int):
    """Columns: right singular vectors of the whole table, strongest first."""
    import numpy as np

    total = np.zeros(width * width)
    sums = vectors.select("embedding").mapInArrow(_outer_sums(width), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    for at, value in sums.collect():  # width * width numbers
        total[at] = value
    total = total.reshape(width, width)
    if not np.isfinite(total).all():
        return np.eye(width)  # any rotation is right
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1].copy()


def _norms(width: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            kept, x = scaled_rows(batch.column("embedding"), width)
            ids = batch.column("vec_id").take(pa.array(kept, pa.int64()))
            with np.errstate(over="ignore"):
                length = np.linalg.norm(x, axis=1)
            yield pa.RecordBatch.from_arrays([ids, pa.array(length), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "norm", "x"])

    return run


def _blocks(size: int, per_task: int = 1 << 20):
    """Packs rows into blocks: number, greatest norm, ids, row numbers and matrix as bytes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() * per_task
        waiting: list[tuple] = []
        made = 0

        def pack(rows, no):
            ids = np.array([r[0] for r in rows], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([no], pa.int64()), pa.array([max(r[1] for r in rows)], pa.float64()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([np.array([r[3] for r in rows], np.int64).tobytes()], pa.binary()), pa.array([b"".join(r[2] for r in rows)], pa.binary())],
                ["no", "norm", "ids", "rows", "x"])

        for batch in batches:
            for vec_id, norm, x, row in zip(*(batch.column(n).to_pylist() for n in ("vec_id", "norm", "x", "row"))):
                waiting.append((NO_ID if vec_id is None else vec_id, norm, x, row))
                if len(waiting) == size:
                    yield pack(waiting, first + made)
                    waiting, made = [], made + 1
        if waiting:
            yield pack(waiting, first + made)

    return run


def _open(batch, prefix: str, i: int, width: int):
    import numpy as np

    ids, rows, x = (np.frombuffer(batch.column(prefix + n)[i].as_buffer(), kind) for n, kind in (("ids", np.int64), ("rows", np.int64), ("x", np.float64)))
    return ids, rows, x.reshape(len(ids), width)


def search(vectors: DataFrame, k: int, every: int, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row whose vec_id is a multiple of ``every``."""
    spark = vectors.sparkSession
    bound_batches(spark)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    width, n = vectors.agg(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or width is None or width < 0:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    turn = rotation(vectors, width)
    # Longest first; each task packs one range of lengths.
    tasks = -(-n // block)
    ranged = (vectors.mapInArrow(_norms(width), "vec_id long, norm double, x binary")
              .repartitionByRange(tasks, F.desc("norm"), "vec_id", F.xxhash64("x")).sortWithinPartitions(F.desc("norm"), "vec_id"))
    numbered = staged(ranged.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    packed = "no long, norm double, ids binary, rows binary, x binary"
    # The row number rises with falling length, as it starts with the task's.
    sorted_again = numbered.repartitionByRange(tasks, "row").sortWithinPartitions("row")
    blocks = staged(sorted_again.mapInArrow(_blocks(block), packed), "topk-blocks")
    asked = numbered.where(F.col("vec_id") % every == 0)
    asked = staged(asked.repartitionByRange(max(1, -(-n // (every * queries))), "row").mapInArrow(_blocks(queries), packed), "topk-queries")

    levels = sorted({max(1, width // 4), max(1, width // 2)})
    longest = blocks.orderBy(F.desc("norm"), "no").limit(1).select(*(F.col(c).alias(f"c_{c}") for c in ("ids", "rows", "x")), F.lit(0).alias("one"))

    def floor_pass(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            floors, needs = [], []
            for i in range(batch.num_rows):
                ids, rows, q = _open(batch, "", i, width)
                c_ids, c_rows, c = _open(batch, "c_", i, width)
                scores = whole_scores(q, c)
                top = best(scores, c_ids, rows, c_rows, k)
                floor = np.array([scores[j, t[-1]] if len(t) == k else -np.inf for j, t in enumerate(top)], np.float64)
                norms = np.linalg.norm(q, axis=1)
                with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                    need = np.where(floor <= 0, 0.0, np.where(norms > 0, floor / norms, 0.0))
                floors.append(floor.tobytes())
                needs.append(float(need.min()) * (1 - 1e-9))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("no", "ids", "rows", "x")), pa.array(floors, pa.binary()), pa.array(needs)],
                                             ["q_no", "q_ids", "q_rows", "q_x", "floor", "need"])

    floored = staged(asked.withColumn("one", F.lit(0)).join(F.broadcast(longest), "one").drop("one", "norm").mapInArrow(
        floor_pass, "q_no long, q_ids binary, q_rows binary, q_x binary, floor binary, need double"), "topk-floors")
    # A block number stands for the block's place by falling norm, without gaps. Blocks that can reach a floor of a block
    # of queries are the first so many: counted over bare numbers, a row a block, before any vector is sent.
    places = staged(blocks.select("no", "norm").withColumn("place", F.row_number().over(Window.orderBy(F.desc("norm"), "no")) - 1), "topk-places")
    marks = places.select(F.col("norm").alias("v"), F.lit(0).alias("ask"), F.lit(None).cast("long").alias("q_no")).unionByName(
        floored.select(F.col("need").alias("v"), F.lit(1).alias("ask"), "q_no"))
    reach = F.sum(1 - F.col("ask")).over(Window.orderBy(F.desc("v"), "ask").rowsBetween(Window.unboundedPreceding, 0))
    asks = marks.withColumn("reach", reach).where("ask = 1 AND reach > 0")
    pairs = staged(asks.select("q_no", F.explode(F.sequence(F.lit(0), (F.col("reach") - 1).cast("int"))).alias("place")), "topk-pairs")
    pairs = pairs.join(floored, "q_no")
    placed = blocks.drop("norm").join(places.select("no", "place"), "no")

    def meet(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                ids, rows, x = _open(batch, "", i, width)
                q_ids, q_rows, q = _open(batch, "q_", i, width)
                floor = np.frombuffer(batch.column("floor")[i].as_buffer(), np.float64)
                qs, xs = chances(q @ turn, x @ turn, floor, levels)
                if not len(qs) or not len(xs):
                    continue
                scores = whole_scores(q[qs], x[xs])
                top = best(scores, ids[xs], q_rows[qs], rows[xs], k, floor[qs])
                at = np.repeat(np.arange(len(qs)), [len(t) for t in top])
                to = np.concatenate(top).astype(np.int64)
                found = ids[xs][to]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_rows[qs][at]), pa.array(q_ids[qs][at]), pa.array(found, pa.int64(), mask=found == NO_ID),
                     pa.array(rows[xs][to]), pa.array(scores[at, to])], ["row", "query_id", "vec_id", "vec_row", "score"])

    met = pairs.join(placed, "place").select(
        "ids", "rows", "x", "q_ids", "q_rows", "q_x", "floor").mapInArrow(meet, "row long, query_id long, vec_id long, vec_row long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"), k=5, every=50)


#: The same search in DuckDB.
SQL = """
WITH raw AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x,
                    len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) AS bad
             FROM (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL)),
     v AS (SELECT row_number() OVER () AS rn, vec_id, x FROM raw WHERE bad = 0),
     s AS (SELECT q.rn, q.vec_id AS query_id, c.vec_id, c.rn AS crn, list_dot_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
           FROM v q JOIN v c ON q.rn <> c.rn WHERE q.vec_id % 50 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id, crn)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
