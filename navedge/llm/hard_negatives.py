"""Hard-negative mining in STR-packed R-trees.

Rows are range-partitioned by label and by the coordinate of greatest
variance, and every ``TREE_ROWS`` of them are packed by Sort-Tile-Recursive
into a tree: runs of one label, cut in slabs along one coordinate after the
other, down to leaves of ``LEAF_ROWS``. A node holds the minimum bounding box
of its rows and their range of labels. A box gives an interval of each
coordinate's product with a query, and the sums of the interval ends bound
every inner product below the node from both sides.

Anchors come in blocks. Each block meets each group of trees in one task,
which holds the group and takes block after block from its sorted input, so
memory is one group and one batch, and a payload is sent once a group. Groups
out of a block's reach by labels or by the boxes' bounds get no payload. In a
task every anchor has a best-first queue over the trees of the group, greatest
upper bound first. Boxes outside of all score windows of the anchor, or
strictly below the k-th best score found, leave the queue unopened; the search
ends when the best box left is strictly below. A first search, among rows of
the anchor's label, gives its positives; a second, among the others, the best
rows in the score window of each positive. Each meeting returns at most k rows
a window, which Spark ranks.

Anchors are a stated share of the table that meets all rows in blocks; no join
pairs rows by label, and a label that holds most rows spreads over as many
trees as it fills.

Defined results: rows with a null label, a null vector, a null or non-finite
component (or one beyond double when scaled) take no part; short vectors count
as filled up with zeros; scores beyond the range of long count as its ends;
an anchor never meets its own row but meets other rows with its vec_id, also
as its positives; rows with a null vec_id are no anchors, and come last among
equal scores, which go to the smaller vec_id, then to either of equal rows;
positives with negative scores have an empty window; fewer candidates give as
many rows; empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navedge.session import default_parallelism

from .common import bound_batches, read_table, staged
from .vectors import MOST, NO_ID, scaled_rows, whole_scores

TREE_ROWS = 2048
LEAF_ROWS = 128
FANOUT = 8
ANCHORS = 256
#: Rows that a task holds at most, as trees of one group.
GROUP_ROWS = 1 << 16


# Packing -----------------------------------------------------------------------
def tiles(x, labels, leaf: int, order) -> tuple:
    """(row order, leaf sizes) by Sort-Tile-Recursive: runs of one label, then slabs coordinate by coordinate."""
    import numpy as np

    sizes: list[int] = []
    placed: list = []

    def cut(rows, depth):
        pages = -(-len(rows) // leaf)
        if pages <= 1 or depth == len(order):
            for a in range(0, len(rows), leaf):
                placed.append(rows[a:a + leaf])
                sizes.append(len(placed[-1]))
            return
        slabs = min(pages, max(2, int(np.ceil(pages ** (1 / (len(order) - depth))))))
        rows = rows[np.argsort(x[rows, order[depth]], kind="stable")]
        step = -(-pages // slabs) * leaf
        for a in range(0, len(rows), step):
            cut(rows[a:a + step], depth + 1)

    by_label = np.argsort(labels, kind="stable")
    runs = np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1) if len(labels) else []
    small: list = []
    for run in runs:
        if len(run) >= leaf:
            cut(run, 0)
        else:  # labels of few rows share leaves
            small.append(run)
    if small:
        cut(np.concatenate(small), len(order))
    return np.concatenate(placed) if placed else np.zeros(0, np.int64), sizes


class Trees:
    """R-trees of one group: rows in leaf order, and per level the boxes, label ranges and children of its nodes."""

    def __init__(self, parts):
        import numpy as np

        self.ids, self.rows, self.labels = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
        self.x = np.concatenate([p[3] for p in parts])
        sizes = [np.asarray(p[4], np.int64) for p in parts]
        self.most = float(abs(self.x).max(initial=0))
        # Level 0 are the leaves; ``first`` is where a node's rows or children begin.
        self.levels: list[dict] = []
        self.roots: list[tuple[int, int]] = []
        ends = np.cumsum(np.concatenate(sizes))
        starts = np.concatenate(([0], ends[:-1]))
        levels = [dict(first=starts, last=ends, lo=np.minimum.reduceat(self.x, starts), hi=np.maximum.reduceat(self.x, starts),
                       least=np.minimum.reduceat(self.labels, starts), greatest=np.maximum.reduceat(self.labels, starts))]
        width = [len(s) for s in sizes]  # nodes of each tree on the level
        done = [False] * len(width)
        while True:
            offsets = np.concatenate(([0], np.cumsum(width)))
            for t, w in enumerate(width):
                if w == 1 and not done[t]:
                    self.roots.append((len(levels) - 1, int(offsets[t])))
                    done[t] = True
            if all(done):
                break
            below = levels[-1]
            first = np.concatenate([np.arange(offsets[t], offsets[t + 1], FANOUT) for t in range(len(width)) if not done[t]])
            last = np.concatenate([np.minimum(np.arange(offsets[t], offsets[t + 1], FANOUT) + FANOUT, offsets[t + 1]) for t in range(len(width)) if not done[t]])
            reduce = lambda f, a: np.array([f(a[i:j], axis=0) for i, j in zip(first, last)])
            levels.append(dict(first=first, last=last, lo=reduce(np.min, below["lo"]), hi=reduce(np.max, below["hi"]),
                               least=reduce(np.min, below["least"]), greatest=reduce(np.max, below["greatest"])))
            width = [0 if done[t] else -(-width[t] // FANOUT) for t in range(len(width))]
        self.levels = levels


def interval(q, lo, hi):
    """(lower, upper) bounds of the inner products of each row of ``q`` with any point of each box, widened for rounding."""
    import numpy as np

    up, down = np.maximum(q, 0), np.minimum(q, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        lower, upper = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
        size = abs(q).max(axis=1, initial=0)[:, None] * np.maximum(abs(lo), abs(hi)).max(axis=1, initial=0)[None, :] * q.shape[1]
        margin = np.where(size < 2.0 ** 53, 0.0, size * 1e-12)  # sums of whole numbers below 2^53 are exact
        lower, upper = np.nan_to_num(lower - margin, nan=-np.inf), np.nan_to_num(upper + margin, nan=np.inf)
    return np.clip(lower, -(2.0 ** 63), 2.0 ** 63), np.clip(upper, -(2.0 ** 63), 2.0 ** 63)


# Search ------------------------------------------------------------------------
class Meeting:
    """A block of anchors with the trees of a group: bounds of all nodes, and leaf scores when first asked for."""

    def __init__(self, trees: Trees, q, q_rows, q_labels):
        self.trees, self.q, self.q_rows, self.q_labels = trees, q, q_rows, q_labels
        self.bounds = [interval(q, level["lo"], level["hi"]) for level in trees.levels]
        self.leaf_scores: dict[int, object] = {}
        self.opened = 0

    def scores(self, leaf: int, i: int):
        if leaf not in self.leaf_scores:
            level = self.trees.levels[0]
            self.leaf_scores[leaf] = whole_scores(self.q, self.trees.x[level["first"][leaf]:level["last"][leaf]])
        return self.leaf_scores[leaf][i]

    def search(self, i: int, k: int, same: bool, lows, highs):
        """For each window, the k best rows (positions in the group) of anchor ``i``: greatest score, smallest id, first row."""
        import heapq

        import numpy as np

        trees, label = self.trees, self.q_labels[i]
        lows, highs = np.array(lows, np.int64), np.array(highs, np.int64)
        floors = lows.copy()  # nothing strictly below can enter
        best: list[list] = [[] for _ in lows]
        queue: list[tuple] = []

        def push(at, nodes):
            level = trees.levels[at]
            lower, upper = self.bounds[at][0][i, nodes], self.bounds[at][1][i, nodes]
            least, greatest = level["least"][nodes], level["greatest"][nodes]
            ok = (least <= label) & (label <= greatest) if same else (least != label) | (greatest != label)
            ok &= ((upper[:, None] >= floors) & (lower[:, None] <= highs)).any(axis=1)
            for node, bound in zip(nodes[ok].tolist(), upper[ok].tolist()):
                heapq.heappush(queue, (-bound, at, node))

        for at, node in trees.roots:
            push(at, np.array([node]))
        while queue:
            bound, at, node = heapq.heappop(queue)
            if -bound < floors.min():
                break
            level = trees.levels[at]
            first, last = int(level["first"][node]), int(level["last"][node])
            if at:
                push(at - 1, np.arange(first, last))
                continue
            self.opened += 1
            s = self.scores(node, i)
            may = (trees.labels[first:last] == label) == same
            may &= trees.rows[first:last] != self.q_rows[i]
            inside = may & (s >= floors[:, None]) & (s <= highs[:, None])
            for w in np.flatnonzero(inside.any(axis=1)).tolist():
                found = np.flatnonzero(inside[w])
                best[w] += zip((-s[found]).tolist(), trees.ids[first + found].tolist(), trees.rows[first + found].tolist(), (first + found).tolist())
                best[w] = heapq.nsmallest(k, best[w])
                if len(best[w]) == k:
                    floors[w] = -best[w][-1][0]
        return best


# Spark -------------------------------------------------------------------------
_ROW = "vec_id long, label long, key double, x binary"
_TREE = "no long, n int, ids binary, rows binary, labels binary, x binary, sizes binary, lo binary, hi binary, least long, greatest long"
_BLOCK = ("no long, n int, ids binary, rows binary, labels binary, x binary, lows binary, highs binary, lo binary, hi binary, "
          "least long, greatest long, low long, high long")


def _spread(width: int):
    """Per coordinate: count, sum and sum of squares of a task's rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((3, width))
        for batch in batches:
            _, x = scaled_rows(batch.column("embedding"), width)
            with np.errstate(over="ignore"):
                total += np.stack([np.full(width, len(x), np.float64), x.sum(axis=0), (x * x).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), *(pa.array(t) for t in total)], ["at", "n", "s", "ss"])

    return run


def coordinate_order(vectors: DataFrame, width: int) -> list[int]:
    """Coordinates by falling variance over the whole table (``width`` rows reach the driver)."""
    sums = vectors.select("embedding").mapInArrow(_spread(width), "at long, n double, s double, ss double").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()
    spread = {r.at: r.ss / r.n - (r.s / r.n) * (r.s / r.n) if r.n else 0.0 for r in sums}
    # Sums beyond double leave no number; such a coordinate comes last.
    return sorted(range(width), key=lambda c: (-spread[c] if spread.get(c) == spread.get(c) and c in spread else 0.0, c))


def _scaled(width: int, key: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            kept, x = scaled_rows(batch.column("embedding"), width)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(x[:, key]),
                                              pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "label", "key", "x"])

    return run


def _packed(size: int, width: int, make, per_task: int = 1 << 20):
    """Rows of a task, in order, as blocks of ``size`` rows made by ``make(no, rows)``."""

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        made, waiting = TaskContext.get().partitionId() * per_task, []
        for batch in batches:
            waiting += zip(*(batch.column(c).to_pylist() for c in batch.schema.names))
            while len(waiting) >= size:
                yield make(made, waiting[:size], np, width)
                waiting, made = waiting[size:], made + 1
        if waiting:
            yield make(made, waiting, np, width)

    return run


def _columns(rows, np, width):
    ids = np.array([NO_ID if r[0] is None else r[0] for r in rows], np.int64)
    return ids, np.array([r[3] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(len(rows), width)


def _tree(leaf: int, order):
    def make(no, rows, np, width):
        import pyarrow as pa

        ids, numbers, labels, x = _columns(rows, np, width)
        at, sizes = tiles(x, labels, leaf, order)
        values = [no, len(rows), *(a[at].tobytes() for a in (ids, numbers, labels, x)), np.array(sizes, np.int64).tobytes(),
                  x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), int(labels.min()), int(labels.max())]
        return pa.RecordBatch.from_pylist([dict(zip(_names(_TREE), values))], schema=_arrow(_TREE))

    return make


def _anchor_block(windows: int):
    def make(no, rows, np, width):
        import pyarrow as pa

        ids, numbers, labels, x = _columns(rows, np, width)
        # A missing window is empty: its low end is above its high end.
        lows, highs = (np.array([([*r[c]] + [gap] * windows)[:windows] for r in rows], np.int64) for c, gap in ((4, MOST), (5, -MOST)))
        real = lows <= highs
        values = [no, len(rows), *(a.tobytes() for a in (ids, numbers, labels, x, lows, highs)), x.min(axis=0).tobytes(), x.max(axis=0).tobytes(),
                  int(labels.min()), int(labels.max()), int(lows[real].min(initial=MOST)), int(highs[real].max(initial=-MOST))]
        return pa.RecordBatch.from_pylist([dict(zip(_names(_BLOCK), values))], schema=_arrow(_BLOCK))

    return make


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _arrow(schema: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in schema.split(", "))])


_BOX = "grp int, lo binary, hi binary, least long, greatest long"


def _box(table):
    """The box and label range of all trees of a group."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lo, hi = (np.array([np.frombuffer(b, np.float64) for b in table.column(c).to_pylist()]) for c in ("lo", "hi"))
    values = [table.column("grp")[0].as_py(), lo.min(axis=0).tobytes(), hi.max(axis=0).tobytes(), pc.min(table.column("least")).as_py(), pc.max(table.column("greatest")).as_py()]
    return pa.Table.from_pylist([dict(zip(_names(_BOX), values))], schema=_arrow(_BOX))


def _reach(same: bool):
    """Keeps the pairs of a block and a group whose labels and boxes allow a score in reach."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        box = lambda batch, c, i: np.frombuffer(batch.column(c)[i].as_buffer(), np.float64)
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                least, greatest, q_least, q_greatest, low, high = (batch.column(c)[i].as_py() for c in ("least", "greatest", "q_least", "q_greatest", "low", "high"))
                ok = (least <= q_greatest and q_least <= greatest) if same else not least == greatest == q_least == q_greatest
                if ok:
                    with np.errstate(over="ignore", invalid="ignore"):
                        corners = np.stack([box(batch, a, i) * box(batch, b, i) for a in ("lo", "hi") for b in ("q_lo", "q_hi")])
                        lower, upper = corners.min(axis=0).sum(), corners.max(axis=0).sum()
                        margin = abs(corners).max(axis=0).sum() * 1e-12
                    ok = not (upper + margin < low or lower - margin > high)
                keep.append(bool(ok))
            yield batch.select(["q_no", "grp"]).filter(pa.array(keep, pa.bool_()))

    return run


def _meet(k: int, same: bool, windows: int, width: int):
    """Tasks hold the trees of a group, which sort first, and take blocks of anchors one by one."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        parts: list = []
        trees, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, kind=np.int64: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                group, is_tree, n = (batch.column(c)[i].as_py() for c in ("grp", "is_tree", "n"))
                if group != held:
                    parts, trees, held = [], None, group
                block = [get("ids"), get("rows"), get("labels"), get("x", np.float64).reshape(n, width)]
                if is_tree:
                    parts.append([*block, get("sizes")])
                    continue
                if trees is None:
                    trees = Trees(parts)
                    parts = []
                ids, rows, labels, q = block
                lows, highs = get("lows").reshape(n, windows), get("highs").reshape(n, windows)
                meeting = Meeting(trees, q, rows, labels)
                out = [(rows[a], ids[a], w, place, -s) for a in range(n) for w, best in enumerate(meeting.search(a, k, same, lows[a], highs[a]))
                       for s, _, _, place in best]
                if out:
                    row, anchor, window, place, score = (np.array(c, np.int64) for c in zip(*out))
                    found = trees.ids[place]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row), pa.array(anchor), pa.array(window.astype(np.int32)), pa.array(found, mask=found == NO_ID), pa.array(trees.rows[place]),
                         pa.array(score)], ["row", "anchor_id", "win", "vec_id", "vec_row", "score"])

    return run


_FOUND = "row long, anchor_id long, win int, vec_id long, vec_row long, score long"


def _search(trees: DataFrame, boxes: DataFrame, blocks: DataFrame, k: int, same: bool, windows: int, width: int) -> DataFrame:
    """The k best rows of each window of each anchor, ranked: row, anchor_id, win, vec_id, score, rank."""
    groups = boxes.count()
    heads = blocks.select(F.col("no").alias("q_no"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"), F.col("least").alias("q_least"),
                          F.col("greatest").alias("q_greatest"), "low", "high", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    pairs = staged(heads.join(boxes, "grp").mapInArrow(_reach(same), "q_no long, grp int"), "negatives-pairs")
    payload = pairs.join(blocks.withColumnRenamed("no", "q_no"), "q_no")
    shared = ["n", "ids", "rows", "labels", "x"]
    none = F.lit(None).cast("binary")
    both = trees.select("grp", F.lit(True).alias("is_tree"), "no", *shared, "sizes", none.alias("lows"), none.alias("highs")).unionByName(
        payload.select("grp", F.lit(False).alias("is_tree"), F.col("q_no").alias("no"), *shared, none.alias("sizes"), "lows", "highs"))
    met = both.repartitionById(groups, F.col("grp")).sortWithinPartitions("grp", F.desc("is_tree"), "no").mapInArrow(_meet(k, same, windows, width), _FOUND)
    order = Window.partitionBy("row", "win").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         tree_rows: int = TREE_ROWS, leaf_rows: int = LEAF_ROWS, anchors: int = ANCHORS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Hard negatives of every anchor, a row whose vec_id is a multiple of ``every``.

    Its positives are its ``positives`` best rows of the same label; for each,
    the first ``negatives`` rows of other labels with a score of ``low`` to
    ``high`` hundredths of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label")).where("label IS NOT NULL")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width, n = vectors.agg(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    if not n or width is None or width < 0:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    order = coordinate_order(vectors, width)
    tasks = -(-n // (4 * tree_rows))
    scaled = vectors.mapInArrow(_scaled(width, order[0]), _ROW)
    ordered = scaled.repartitionByRange(tasks, "label", "key", F.xxhash64("x", "vec_id")).sortWithinPartitions("label", "key", "vec_id")
    rows = staged(ordered.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    placed = rows.select("vec_id", "label", "x", "row").repartitionByRange(tasks, "row").sortWithinPartitions("row")
    packed = staged(placed.mapInArrow(_packed(tree_rows, width, _tree(leaf_rows, order)), _TREE), "negatives-trees")
    count = packed.count()
    if not count:
        return spark.createDataFrame([], schema)
    # Trees in order fill groups of about so many rows, however many tasks packed them.
    share = max(tree_rows, min(group_rows - tree_rows, n // (2 * default_parallelism(spark))))
    before = F.sum("n").over(Window.orderBy("no")) - F.col("n")  # of a number a tree
    numbers = packed.select("no", F.floor(before / share).alias("at"))
    numbers = numbers.select("no", (F.dense_rank().over(Window.orderBy("at")) - 1).cast("int").alias("grp"))
    trees = staged(packed.join(numbers, "no"), "negatives-groups")
    boxes = staged(trees.select("grp", "lo", "hi", "least", "greatest").groupBy("grp").applyInArrow(_box, _BOX), "negatives-boxes")

    def blocks(asked: DataFrame, windows: int, name: str) -> DataFrame:
        shape = asked.select("vec_id", "label", "x", "row", "lows", "highs")
        parts = max(1, -(-n // (every * 16 * anchors)))
        return staged(shape.repartitionByRange(parts, "row").sortWithinPartitions("row").mapInArrow(
            _packed(anchors, width, _anchor_block(windows)), _BLOCK), name)

    asked = rows.where(F.col("vec_id") % every == 0)
    whole = asked.withColumns({"lows": F.array(F.lit(-MOST)), "highs": F.array(F.lit(MOST))})
    found = staged(_search(trees, boxes, blocks(whole, 1, "negatives-anchors"), positives, True, 1, width)
                   .select("row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # 100 * negative within low and high times positive, in whole numbers.
    ends = F.struct(F.col("place"), F.ceil(F.col("positive_score").cast("decimal(20,0)") * low / 100).cast("long").alias("low"),
                    F.floor(F.col("positive_score").cast("decimal(20,0)") * high / 100).cast("long").alias("high"))
    of_anchor = found.groupBy("row").agg(F.sort_array(F.collect_list(ends)).alias("w"))  # ``positives`` at most
    windowed = asked.join(of_anchor, "row").withColumns({"lows": F.col("w.low"), "highs": F.col("w.high")})
    negative = _search(trees, boxes, blocks(windowed, positives, "negatives-windows"), negatives, False, positives, width)
    return negative.withColumn("place", F.col("win") + 1).join(found, ["row", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved))


#: The same in DuckDB.
SQL = """
WITH raw AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                    [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x, len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) AS bad
             FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
     v AS (SELECT row_number() OVER () AS rn, vec_id, label, x FROM raw WHERE bad = 0),
     s AS (SELECT q.rn, q.vec_id AS anchor_id, c.vec_id, c.rn AS crn, q.label = c.label AS same, list_dot_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
           FROM v q JOIN v c ON q.rn <> c.rn WHERE q.vec_id % 50 = 0),
     p AS (SELECT rn, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id, crn) AS place
           FROM s WHERE same),
     g AS (SELECT p.rn, p.place, p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                  row_number() OVER (PARTITION BY p.rn, p.place ORDER BY s.score DESC, s.vec_id, s.crn)::INTEGER AS rank
           FROM p JOIN s ON s.rn = p.rn AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM g WHERE rank <= 3
"""
