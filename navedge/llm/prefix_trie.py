"""Conversation prefix trie from padded matrices of turn ids.

Conversations become sequences of turn digests (128 bits of role and text).
Each distinct prefix is a node. Sequences are cut into slabs of ``SLAB`` turns;
all but very long ones have one. Rows of a slab are range-partitioned by the
whole sequence, and every task packs the sorted rows into shards of at most
``SHARD_CELLS`` padded cells. Inside a shard digests become numbers, numpy's
lexsort orders the padded matrix, changes between neighbouring rows, OR-ed along
the columns, mark where nodes start, and reduceat aggregates each depth.

Only nodes on the paths of a shard's first and last row can have rows in
another shard. These boundary nodes leave the task as partial sums under a
digest of their prefix and are recombined: counts and inner parts of subtrees
add up, each boundary node is owned by one path, and running sums along the
paths carry owned nodes to the boundary nodes above them, so the work is linear
in the boundary. All other nodes are final where they are made.

A slab deeper than the first holds the rows of each group that shares all
turns before it. Groups of one row are plain chains and are written out
directly; slabs with larger groups are done from the deepest up, each passing
totals of its groups to the rows above. The number of passes so depends on the
longest prefix that two conversations share, not on the longest conversation.

Positions in a conversation come from a range sort over (conversation, turn),
with counts per task and conversation added up, and turns are gathered by
conversation and slab, so a conversation that holds most rows is never in one
task. The texts themselves stop at the first step. A node's list of ended
conversations is hashed in one stream, as SHA-256 has no parts: nodes inside a
shard at once, boundary nodes from sorted pieces of bounded size.

Defined results: null role or text counts as empty; rows with a null conv_id
take no part; null turns come first, and equal turns of a conversation go by
the digest of role and text, all kept; c - c % 100 takes the remainder's sign
from c, as SQL does; conversations left without turns are members of the root;
an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, broadcast_if_small, read_table, staged

#: Turns of a slab, also the longest sort key.
SLAB = 256
#: Cells of a shard's padded matrix, and its rows.
SHARD_CELLS = 2_000_000
SHARD_ROWS = 100_000
#: Conversation ids of one piece of a boundary node's list.
ENDS_PIECE = 2000
#: Conversations of one block share the beginning of its first, of at most HEAD - 1 turns.
BLOCK, HEAD = 100, 6

_ENDS_NONE = hashlib.sha256(b"").hexdigest()


# Sequences -----------------------------------------------------------------------
def _number(batches):
    """Position of each row among the rows of its conversation in this task."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    task, held, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(ids)) + 1))
        before = np.zeros(len(starts), np.int64)
        before[0] = seen if ids[0] == held else 0
        place = np.arange(len(ids)) - np.repeat(starts - before, np.diff(np.concatenate((starts, [len(ids)])))) + 1
        held, seen = ids[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), task, np.int64)), batch.column("conv_id"), pa.array(place),
                                          batch.column("digest"), batch.column("points")], ["task", "conv_id", "place", "digest", "points"])


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, points) of every turn, and (conv_id, turns) of every conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"), F.length(text).alias("points"))
    ordered = turns.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "digest").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
    rows = staged(ordered.mapInArrow(_number, "task long, conv_id long, place long, digest string, points int"), "trie-turns")
    counts = staged(rows.groupBy("task", "conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-counts")
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("task")) - F.col("n")
    split = staged(counts.withColumn("before", before).where("before > 0").select("task", "conv_id", "before"), "trie-split")
    placed = rows.join(broadcast_if_small(split), ["task", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "points")
    return placed, counts.groupBy("conv_id").agg(F.sum("n").alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, slab, ids, points, total): per slab the digests and text lengths of the rebuilt turns.

    The first turns come from the first conversation of the block, the rest
    are the conversation's own. Every conversation has a row for slab 0.
    """
    turns, sizes = numbered_turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    item = F.struct("pos", "digest", "points")
    heads = turns.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < HEAD)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(item)).alias("head"))
    convs = sizes.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % BLOCK}).join(heads, "base", "left").select(
        "conv_id", "h", "turns", F.when(F.col("h") > 0, F.slice(F.coalesce("head", F.array().cast("array<struct<pos: long, digest: string, points: int>>")), 1, F.greatest(F.lit(1), F.col("h").cast("int")))).otherwise(
            F.array().cast("array<struct<pos: long, digest: string, points: int>>")).alias("head"))
    convs = staged(convs.withColumns({"m": F.size("head").cast("long"),
                                      "total": F.size("head") + F.greatest(F.lit(0), F.col("turns") - F.col("h"))}), "trie-conversations")
    text = lambda c: F.array_join(F.transform(c, lambda x: x["digest"]), "")
    # Own turns in runs of SLAB, then cut where the slabs are: m turns stand before them.
    own = turns.withColumn("h", h).where("pos > h").groupBy("conv_id", F.floor((F.col("pos") - F.col("h") - 1) / SLAB).alias("run")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    placed = own.join(convs.select("conv_id", "m", "total"), "conv_id")
    room = (SLAB - F.col("m")).cast("int")
    parts = placed.select("conv_id", "total", F.inline(F.array(
        F.struct(F.col("run").alias("slab"), F.col("m").alias("at"), F.slice("items", 1, room).alias("items")),
        F.struct((F.col("run") + 1).alias("slab"), F.lit(0).cast("long").alias("at"), F.slice("items", room + 1, F.lit(SLAB)).alias("items")))))
    first = convs.select("conv_id", "total", F.lit(0).cast("long").alias("slab"), F.lit(-1).cast("long").alias("at"), F.col("head").alias("items"))
    pieces = first.unionByName(parts.where("size(items) > 0"))
    piece = F.struct("at", text("items").alias("ids"), F.transform("items", lambda x: x["points"]).alias("points"))
    rows = pieces.groupBy("conv_id", "slab").agg(F.sort_array(F.collect_list(piece)).alias("p"), F.max("total").alias("total"))
    return rows.select("conv_id", "slab", F.unhex(F.array_join(F.col("p.ids"), "")).alias("ids"), F.flatten("p.points").alias("points"), "total")


def _chain(batches):
    """Digest of all turns before each slab, from the digests of the slabs."""
    import pyarrow as pa

    for batch in batches:
        conv, slab, key = [], [], []
        for conv_id, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
            k = b""
            for p in parts:
                k = hashlib.md5(k + p["md5"]).digest()
                conv.append(conv_id)
                slab.append(p["slab"] + 1)
                key.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(slab, pa.int64()), pa.array(key, pa.binary())], ["conv_id", "slab", "grp"])


def with_groups(rows: DataFrame) -> DataFrame:
    """``rows`` with ``grp``, the digest of all turns before the slab, ``shared``, whether another row has the same, and
    ``alone``, the conversation's first slab that isn't shared."""
    deep = rows.where(F.col("total") > SLAB)
    one = {"grp": F.lit(b""), "shared": F.lit(True), "alone": F.lit(None).cast("long")}
    if deep.isEmpty():
        return rows.withColumns(one)
    last = F.floor((F.col("total") - 1) / SLAB)
    parts = deep.where(F.col("slab") < last).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("slab", F.unhex(F.md5("ids")).alias("md5")))).alias("parts"))
    keys = staged(parts.mapInArrow(_chain, "conv_id long, slab long, grp binary"), "trie-keys")
    several = keys.groupBy("grp").agg((F.count(F.lit(1)) > 1).alias("shared"))
    keys = keys.join(several, "grp").withColumn("alone", F.min(F.when(~F.col("shared"), F.col("slab"))).over(Window.partitionBy("conv_id")))
    first = rows.where("slab = 0").withColumns(one)
    return first.unionByName(rows.where("slab > 0").join(keys, ["conv_id", "slab"]).select(*first.columns))


# One shard -----------------------------------------------------------------------
def _ended(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def shard_nodes(shard: int, base: int, grp: list, conv, lengths, ids: bytes, points, ends, extra):
    """Nodes of one shard: (final nodes, boundary nodes on both edge paths, lists of ended conversations of boundary nodes).

    ``grp`` names the group of each row, ``ids`` joins all digests, ``points``
    all text lengths; ``ends`` says whether a conversation ends with its row,
    and ``extra`` holds (children, leaves, saved) that hang below a row's end.
    Rows come in Spark's order, whose first and last row are the shard's edges.
    """
    import numpy as np

    conv, lengths, points, ends, extra = (np.asarray(a) for a in (conv, lengths, points, ends, extra))
    n, width = len(conv), int(lengths.max(initial=0))
    inside = np.arange(width) < lengths[:, None]
    # Numbers of the digests, in their order.
    pair = np.frombuffer(ids, ">u8").reshape(-1, 2).astype(np.uint64)
    by = np.lexsort((pair[:, 1], pair[:, 0]))
    change = np.ones(len(by), bool)
    change[1:] = (pair[by][1:] != pair[by][:-1]).any(axis=1)
    number = np.empty(len(by), np.int32)
    number[by] = np.cumsum(change) - 1
    turn, size = np.full((n, width), -1, np.int32), np.zeros((n, width), np.int64)
    turn[inside], size[inside] = number, points
    names = sorted(set(grp))
    code = np.array([{g: i for i, g in enumerate(names)}[g] for g in grp], np.int64) if len(names) > 1 else np.zeros(n, np.int64)
    begin = np.concatenate(([0], np.cumsum(lengths)))

    order = np.lexsort((conv, *(turn[:, d] for d in range(width - 1, -1, -1)), code))
    source = order
    turn, size, conv, lengths, code, ends, extra = turn[order], size[order], conv[order], lengths[order], code[order], ends[order], extra[order]
    new_group = np.ones(n, bool)
    new_group[1:] = code[1:] != code[:-1]
    starts = np.ones((n, width), bool)
    starts[1:] = turn[1:] != turn[:-1]
    if width:
        starts[:, 0] |= new_group
        starts = np.logical_or.accumulate(starts, axis=1)

    # Per depth: rows below its nodes, first row of each node, the node of each row.
    depths = []
    for d in range(width + 1):
        rows = np.arange(n) if d == 0 else np.flatnonzero(lengths >= d)
        at = np.flatnonzero(new_group if d == 0 else starts[rows, d - 1])
        of = np.full(n, -1, np.int64)
        of[rows] = np.cumsum(new_group if d == 0 else starts[rows, d - 1]) - 1
        first = rows[at]
        edge = np.zeros(len(first), bool)
        edge[[k for k in (of[0], of[n - 1]) if k >= 0]] = True
        ended = rows[lengths[rows] == d]
        level = {"of": of, "first": first, "edge": edge, "n": np.diff(np.concatenate((at, [len(rows)]))), "conv": np.minimum.reduceat(conv[rows], at),
                 "points": size[first, d - 1] if d else np.zeros(len(first), np.int64), "ended": ended,
                 "below": np.zeros((len(first), 3), np.int64)}  # children, leaves and saved that are final below
        np.add.at(level["below"], of[ended], extra[ended])
        depths.append(level)
    for d in range(width, -1, -1):
        level = depths[d]
        children, leaves, saved = level["below"].T
        level["children"] = children
        own = ~level["edge"]
        level["leaves"] = leaves + (own & (children == 0))
        level["saved"] = saved + np.where(own & (d > 0), (level["n"] - 1) * level["points"], 0)
        if d:
            up = depths[d - 1]["of"][level["first"]]
            np.add.at(depths[d - 1]["below"], up, np.stack([own.astype(np.int64), level["leaves"], level["saved"]], axis=1))

    final, border, lists = [], [], []
    group_of = [grp[source[r]] for r in (0, n - 1)]
    keys = {}
    for side, r in enumerate((0, n - 1)):
        mine = ids[16 * begin[source[r]]:16 * begin[source[r] + 1]]
        for d in range(int(lengths[r]) + 1):
            keys[d, int(depths[d]["of"][r])] = group_of[side] if d == 0 else hashlib.md5(group_of[side] + hashlib.md5(mine[:16 * d]).digest()).digest()
    for d, level in enumerate(depths):
        by_node = level["of"][level["ended"]]
        with_end = level["ended"][ends[level["ended"]]]
        which = level["of"][with_end]
        cuts = np.flatnonzero(np.diff(which)) + 1
        done = {int(which[part[0]]): conv[with_end[part]] for part in np.split(np.arange(len(which)), cuts) if len(part)}
        up = depths[d - 1]["of"][level["first"]] if d else None
        for k in range(len(level["first"])):
            row = int(level["first"][k])
            group = grp[source[row]]
            values = (int(level["n"][k]), int(level["children"][k]), int(level["leaves"][k]), int(level["saved"][k]))
            parent_edge = d > 0 and bool(depths[d - 1]["edge"][up[k]])
            parent_key = keys[d - 1, int(up[k])] if parent_edge else group if d == 1 and base else None
            if level["edge"][k]:
                key = keys[d, k]
                both = [side for side, r in enumerate((0, n - 1)) if level["of"][r] == k]
                for i, side in enumerate(both):  # values once, the path twice
                    border.append((2 * shard + side, base + d, key, parent_key, int(level["conv"][k]), int(level["points"][k]), d,
                                   *(values if i == 0 else (0, 0, 0, 0))))
                ids_ended = done.get(k, ())
                for a in range(0, len(ids_ended), ENDS_PIECE):
                    part = ids_ended[a:a + ENDS_PIECE]
                    lists.append((key, int(part[0]), ",".join(map(str, part.tolist()))))
                continue
            if d == 0 and base:  # a group's root is a node of the slab above
                final.append((base, int(level["conv"][k]), None, None, group, 0, *values, None))
                continue
            # Turns may go on below the last column of a slab: those nodes are looked up by key.
            key = None
            if d == SLAB and (lengths[by_row := row] == SLAB):
                a = begin[source[by_row]]
                key = hashlib.md5(group + hashlib.md5(ids[16 * a:16 * (a + SLAB)]).digest()).digest()
            known = int(depths[d - 1]["conv"][up[k]]) if d and parent_key is None else None
            final.append((base + d, int(level["conv"][k]), known, parent_key, key, d, *values, _ended(done[k].tolist()) if k in done else _ENDS_NONE))
    return final, border, lists


# Spark -----------------------------------------------------------------------------
_MADE = ("kind int, path long, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, points long, d int, "
         "n_convs long, n_children long, n_leaves long, saved long, ends string")
_FINAL, _BORDER, _LIST = 0, 1, 2


def _shards(base: int, per_task: int = 1 << 24):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        names = [c.split()[0] for c in _MADE.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in _MADE.split(", "))])
        shard = TaskContext.get().partitionId() * per_task
        waiting: list[tuple] = []
        width = 0

        def made():
            grp, conv, ids, points, ends, extra = zip(*waiting)
            flat = np.concatenate([np.asarray(p, np.int64) for p in points]) if points else np.zeros(0, np.int64)
            final, border, lists = shard_nodes(shard, base, list(grp), np.array(conv, np.int64), np.array([len(i) // 16 for i in ids], np.int64),
                                               b"".join(ids), flat, np.array(ends, bool), np.array(extra, np.int64).reshape(len(ids), 3))
            rows = [(_FINAL, None, depth, key, parent_key, conv_id, parent, None, d, *values, ended)
                    for depth, conv_id, parent, parent_key, key, d, *values, ended in final]
            rows += [(_BORDER, path, depth, key, parent_key, conv_id, None, points_, d, *values, None)
                     for path, depth, key, parent_key, conv_id, points_, d, *values in border]
            rows += [(_LIST, None, None, key, None, first, None, None, None, None, None, None, None, text) for key, first, text in lists]
            columns = list(zip(*rows))
            for a in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 50_000], f.type) for c, f in zip(columns, schema)], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "conv_id", "ids", "points", "ends", "extra"))):
                longer = max(width, len(row[2]) // 16)
                if waiting and ((len(waiting) + 1) * longer > SHARD_CELLS or len(waiting) >= SHARD_ROWS):
                    yield from made()
                    waiting, longer, shard = [], len(row[2]) // 16, shard + 1
                waiting.append(row)
                width = longer
        if waiting:
            yield from made()

    return run


def _hash_lists(batches):
    """SHA-256 of each key's pieces, which come sorted, joined by commas."""
    import pyarrow as pa

    held, running = None, None
    for batch in batches:
        keys, hashes = [], []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if key == held:
                running.update(b"," + text.encode())
                continue
            if running is not None:
                keys.append(held)
                hashes.append(running.hexdigest())
            held, running = key, hashlib.sha256(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], ["key", "ends_sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([running.hexdigest()], pa.string())], ["key", "ends_sha256"])


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "parent_key", "d"]


def _recombined(made: DataFrame) -> DataFrame:
    """Boundary nodes of all shards of a slab, whole."""
    border = made.where(F.col("kind") == _BORDER)
    nodes = border.groupBy("key").agg(
        F.min("path").alias("owner"), F.max("depth").alias("depth"), F.max("d").alias("d"), F.max("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"), F.max("points").alias("points"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")))
    nodes = staged(nodes, "trie-border")
    inner = nodes.where("d > 0").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("edge_children"))
    nodes = nodes.join(inner, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("edge_children", F.lit(0)))
    # A group's root has its own part in the slab above.
    own = nodes.withColumns({"own_leaves": (F.col("n_children") == 0).cast("long"),
                             "own_saved": F.when(F.col("d") > 0, (F.col("n_convs") - 1) * F.col("points")).otherwise(F.lit(0))})
    own = staged(own, "trie-owned")
    paths = border.select("path", "d", "key").join(own.select("key", "owner", "own_leaves", "own_saved"), "key")
    mine = F.col("path") == F.col("owner")
    deeper = Window.partitionBy("path").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)  # SLAB rows at most
    carried = paths.select("key", *(F.coalesce(F.sum(F.when(mine, F.col(c)).otherwise(0)).over(deeper), F.lit(0)).alias(c) for c in ("own_leaves", "own_saved")))
    sums = carried.groupBy("key").agg(F.sum("own_leaves").alias("path_leaves"), F.sum("own_saved").alias("path_saved"))
    lists = made.where(F.col("kind") == _LIST).select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    hashes = lists.select("key", "ends").mapInArrow(_hash_lists, "key binary, ends_sha256 string")
    return own.join(sums, "key").join(hashes, "key", "left").select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("own_leaves") + F.col("path_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("own_saved") + F.col("path_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_ENDS_NONE)).alias("ends_sha256"), "key", "parent_key", "d")


def _slab(rows: DataFrame, slab: int, extra: DataFrame | None) -> DataFrame:
    """Nodes of one slab (and the roots of its groups, d = 0), with the totals of the slab below at the rows they hang on."""
    here = rows.where((F.col("slab") == slab) & F.col("shared"))
    none = F.array(*[F.lit(0).cast("long")] * 3)
    here = here.withColumn("extra", none) if extra is None else here.join(broadcast_if_small(extra), "conv_id", "left").withColumn("extra", F.coalesce("extra", none))
    shape = here.select("grp", "conv_id", "ids", "points", (F.col("total") <= (slab + 1) * SLAB).alias("ends"), "extra")
    ordered = shape.repartitionByRange("grp", "ids", "conv_id").sortWithinPartitions("grp", "ids", "conv_id")
    made = staged(ordered.mapInArrow(_shards(slab * SLAB), _MADE), "trie-shards")
    final = made.where(F.col("kind") == _FINAL).withColumns({"saved_tokens": F.col("saved"), "ends_sha256": F.col("ends")}).select(*_NODE)
    return staged(final.unionByName(_recombined(made)), "trie-nodes")


def _lonely(rows: DataFrame) -> DataFrame:
    """Nodes of rows that share no turn before their slab: a chain each."""
    n = F.size("points")
    more = F.col("total") > (F.col("slab") + 1) * SLAB
    last = (F.col("j") == n) & ~more
    top = (F.col("j") == 1) & (F.col("slab") == F.col("alone"))
    at = rows.where(~F.col("shared")).select("*", F.explode(F.sequence(F.lit(1), n)).alias("j"))
    return at.select(
        "conv_id", (F.col("slab") * SLAB + F.col("j")).alias("depth"), F.when(~top, F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_ENDS_NONE)).alias("ends_sha256"),
        F.lit(None).cast("binary").alias("key"), F.when(top, F.col("grp")).alias("parent_key"), F.col("j").cast("int").alias("d"))


def nodes(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    bound_batches(conversations.sparkSession)
    rows = staged(with_groups(staged(rebuilt(conversations), "trie-rows")), "trie-sequences")
    deepest = rows.where("shared").agg(F.max("slab")).first()[0]
    if deepest is None:
        return rows.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                                     "saved_tokens long, ends_sha256 string")
    # Rows that go on alone hang one leaf below the slab before.
    alone = rows.where(~F.col("shared")).select("conv_id", (F.col("slab") - 1).alias("slab"), F.array(*[F.lit(x).cast("long") for x in (1, 1, 0)]).alias("extra"))
    parts, below = [], None
    for slab in range(int(deepest), -1, -1):
        hang = alone.where(F.col("slab") == slab).select("conv_id", "extra")
        if below is not None:  # totals of a group hang on its first conversation's row
            totals = below.where("d = 0").select("conv_id", F.array("n_children", "n_leaves", "saved_tokens").alias("extra"))
            hang = hang.unionByName(totals)
        below = _slab(rows, slab, staged(hang, "trie-hanging") if deepest or rows.where(~F.col("shared")).count() else None)
        parts.append(below if slab == 0 else below.where("d > 0"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = staged(out.unionByName(_lonely(rows)), "trie-all")
    # Parents by key: the root's children by its one number, the others by a join.
    root = out.where("depth = 0").first()["conv_id"]
    keyed = staged(out.where("key IS NOT NULL AND depth > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found")).groupBy("parent_key").agg(F.min("found").alias("found")), "trie-parents")
    asks = out.where("parent_key IS NOT NULL AND depth > 1").join(broadcast_if_small(keyed), "parent_key", "left").withColumn("parent_conv_id", F.col("found"))
    rest = out.where("parent_key IS NULL OR depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent_conv_id")))
    wanted = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return asks.select(*wanted).unionByName(rest.select(*wanted))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(read_table(spark, sf_dir, "conversations"))


_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(conv_id::VARCHAR, '')])),
                      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"""

#: The same in DuckDB: prefixes as digests of text, subtrees by each node's list of ancestors.
SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
                  length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS turn, length(coalesce(text, '')) AS points
           FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, xor({_CRC}, 4294967295) % 6 AS h FROM conversations WHERE conv_id IS NOT NULL),
     parts AS (SELECT c.conv_id, 0 AS part, t.pos, t.turn, t.points FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
               UNION ALL SELECT c.conv_id, 1, t.pos, t.turn, t.points FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
     s AS (SELECT c.conv_id, coalesce(list(md5(p.turn) ORDER BY part, pos) FILTER (p.turn IS NOT NULL), []) AS turns,
                  coalesce(list(p.points ORDER BY part, pos) FILTER (p.turn IS NOT NULL), []) AS points
           FROM c LEFT JOIN parts p ON p.conv_id = c.conv_id GROUP BY c.conv_id),
     m AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns, points FROM s),
     k AS (SELECT conv_id, depth, md5(array_to_string(turns[1:depth], ',')) AS key, md5(array_to_string(turns[1:depth - 1], ',')) AS parent, len(turns) = depth AS ends,
                  CASE WHEN depth > 0 THEN points[depth] ELSE 0 END AS points, [md5(array_to_string(turns[1:i], ',')) FOR i IN range(0, depth + 1)] AS above FROM m),
     n AS (SELECT depth, key, min(CASE WHEN depth > 0 THEN parent END) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(points) AS points, min(above) AS above,
                  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ended FROM k GROUP BY depth, key),
     kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1, 2),
     w AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids USING (depth, key)),
     up AS (SELECT unnest(above) AS key, unnest(range(0, depth + 1)) AS depth, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf,
                   CASE WHEN depth > 0 THEN (n_convs - 1) * points ELSE 0 END AS saved FROM w),
     sums AS (SELECT depth, key, sum(leaf) AS n_leaves, sum(saved) AS saved FROM up GROUP BY depth, key)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
       sums.n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(w.ended) AS ends_sha256
FROM w JOIN sums ON sums.depth = w.depth AND sums.key = w.key LEFT JOIN n p ON w.depth > 0 AND p.depth = w.depth - 1 AND p.key = w.parent
"""
