"""Exact range join of vectors by angle: pivots partition, the triangle inequality replicates.

Vectors link when their cosine is at least a limit, that is when their angle, a metric, is at most
``reach``. Only vectors of one group (a label and a width) are compared. Copies are one vector with a weight.

Rounds split what is left of every group that has more than ``CELL`` vectors. Each vector goes to its nearest
pivot, and there into a ring of distances: ring 0 reaches to half of ``reach``, each further one is ``reach``
wide. A vector y is a guest of the cell (pivot p, ring from lo to hi) where the triangle inequality leaves a
partner possible: lo - reach <= d(y, p) <= hi + reach, and d(y, p) - d(y, nearest pivot) <= 2 reach. A
cell is closed if its guests are few beside its own vectors; the others stay for the next round, and rounds end
when they close less than a tenth of what is left. What no pivot can divide (vectors all far from each
other, as in many dimensions) ends in one cell for each group. Every pair is met once, in the cell that comes
first of those its two vectors live in, and counts for both.

Cells join independently, in blocks of vectors, so a large cell is many tasks. All of ring 0 link with each
other, as each is within half the reach of the pivot, and are not compared. Tasks return a number
for each vector and a spanning forest of the links, never the pairs. Work inside a cell of n vectors beyond
ring 0 is quadratic; its rows are dealt n / ``MOST_BLOCK`` times at most, 16 times while n is below a million.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.components import components
from tabulon.llm.shared import broadcast_if_small, scratch_table

#: Vectors of a group from which on pivots are drawn; pivots of a group and round, and numbers in all pivots of a
#: round, which are sent to all executors (at most 32 MB).
CELL, PIVOTS, PIVOT_NUMBERS = 512, 32, 1 << 22
#: Groups of a round that may have pivots, the largest ones; the others wait or are compared whole.
PIVOT_GROUPS = 1 << 14
#: Guests that a closed cell may have for each vector of its own, and the share that a round has to close.
GUESTS, WORTH = 2.0, 0.1
#: Vectors of a block, from and to.
BLOCK, MOST_BLOCK, TILE = 4096, 1 << 16, 512
#: Angles are sure to within this; cosines this near to the limit are taken again, term by term.
SLACK, CLOSE = 1e-6, 1e-9
VECTOR = "g string, node bigint, weight bigint, v array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one width as rows of unit length."""
    if not len(column):
        return np.zeros((0, 0))
    raw = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _rings(angle: np.ndarray, reach: float) -> np.ndarray:
    """0 to half of the reach, less what rounding may hide; then one for each reach."""
    return np.where(angle <= reach / 2 - SLACK, 0, np.floor(angle / reach + 0.5).astype(np.int64).clip(1))


def _edges(ring: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Angles between which a ring lies for sure."""
    low = np.where(ring <= 1, np.where(ring == 0, 0.0, reach / 2), (ring - 0.5) * reach)
    return low - 2 * SLACK, np.where(ring == 0, reach / 2, (ring + 0.5) * reach) + 2 * SLACK


def _possible(angle: np.ndarray, nearest: np.ndarray, ring: int, reach: float) -> np.ndarray:
    low, high = _edges(np.array(ring), reach)
    fits = (angle >= low - reach) & (angle <= high + reach)
    return fits & (angle - nearest[:, None] <= 2 * reach + 4 * SLACK)


def _by_group(batch: pa.RecordBatch):
    """Indices of the rows of each group in a batch."""
    groups = np.array(batch.column("g").to_pylist(), dtype=object)
    names, where = np.unique(groups.astype(str), return_inverse=True)
    order = np.argsort(where, kind="stable")
    bounds = np.searchsorted(where[order], np.arange(len(names) + 1))
    for name, a, b in zip(names.tolist(), bounds, bounds[1:]):
        yield name, order[a:b]


def _placed(batch: pa.RecordBatch, pivots: dict, reach: float):
    """For each group with pivots: its rows, their angles to the pivots, nearest pivot and ring."""
    for name, at in _by_group(batch):
        if name in pivots:
            angle = _angles(_matrix(batch.column("v").take(pa.array(at))), pivots[name][1])
            nearest = angle.argmin(axis=1)
            lowest = angle[np.arange(len(at)), nearest]
            yield at, pivots[name][0], angle, nearest, lowest, _rings(lowest, reach)


def _pivots(left: DataFrame, sizes: list, seed: int, reach: float) -> dict:
    """Pivots by group: vectors drawn by hash, none within reach of another; numbered over all groups."""
    if not sizes:
        return {}
    widest = max(int(name.rsplit(":", 1)[1]) for name, _ in sizes)
    room = max(2, PIVOT_NUMBERS // widest)
    sizes = sizes[: max(1, room // 2)]
    each = max(2, min(PIVOTS, room // len(sizes)))
    share = left.sparkSession.createDataFrame([(g, min(1.0, 2 * each / n)) for g, n in sizes], "g string, share double")
    drawn = F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(1 << 30)) < F.col("share") * float(1 << 30)
    # About twice as many as used; bounded by the room above.
    rows = left.join(F.broadcast(share), "g").where(drawn).select("g", "node", "v").collect()
    out, number = {}, 0
    for name in sorted({r["g"] for r in rows}):
        vectors = _matrix(pa.array([r["v"] for r in sorted((r for r in rows if r["g"] == name), key=lambda r: r["node"])]))
        chosen = []
        for i in range(len(vectors)):
            if len(chosen) < each and (not chosen or _angles(vectors[i : i + 1], vectors[chosen]).min() > reach):
                chosen.append(i)
        out[name] = (number, vectors[chosen])
        number += len(chosen)
    return out


def _round(left: DataFrame, pivots: dict, number: int, reach: float) -> DataFrame:
    """Vectors with the cells they live in or visit; ``cell`` is null for those that stay open."""
    rings = int(math.pi / reach + 0.5) + 1
    shared = left.sparkSession.sparkContext.broadcast(pivots)

    def count(batches):
        own, guests = {}, {}
        for batch in batches:
            for _, first, angle, nearest, lowest, ring in _placed(batch, shared.value, reach):
                for cell, n in zip(*np.unique((first + nearest) * rings + ring, return_counts=True)):
                    own[int(cell)] = own.get(int(cell), 0) + int(n)
                for r in range(rings):
                    here = _possible(angle, lowest, r, reach)
                    here[np.arange(len(nearest)), nearest] &= ring != r
                    for p, n in enumerate(here.sum(axis=0).tolist()):
                        if n:
                            cell = (first + p) * rings + r
                            guests[cell] = guests.get(cell, 0) + n
        cells = sorted(own.keys() | guests.keys())
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(cells, pa.int64()), "own": pa.array([own.get(c, 0) for c in cells], pa.int64()),
             "guests": pa.array([guests.get(c, 0) for c in cells], pa.int64())}
        )

    counts = left.mapInArrow(count, "cell bigint, own bigint, guests bigint").groupBy("cell").agg(F.sum("own").alias("own"), F.sum("guests").alias("guests"))
    # At most as many rows as pivots times rings.
    kept = np.array(sorted(r["cell"] for r in counts.where((F.col("own") > 0) & (F.col("guests") <= GUESTS * F.col("own"))).collect()), np.int64)
    closed = left.sparkSession.sparkContext.broadcast(kept)

    def deal(batches):
        for batch in batches:
            cells = np.full(batch.num_rows, -1, np.int64)
            visits = []
            for at, first, angle, nearest, lowest, ring in _placed(batch, shared.value, reach):
                mine = (first + nearest) * rings + ring
                cells[at] = mine = np.where(np.isin(mine, closed.value), mine, -1)
                inside = closed.value[(closed.value >= first * rings) & (closed.value < (first + angle.shape[1]) * rings)]
                for cell in inside.tolist():
                    p, r = cell // rings - first, cell % rings
                    there = _possible(angle[:, p : p + 1], lowest, r, reach)[:, 0]
                    # A pair is met in the first of its cells.
                    visits.append((cell, at[there & ((mine < 0) | (mine > cell))]))
            rows = np.concatenate([np.arange(batch.num_rows), *[a for _, a in visits]])
            cell = np.concatenate([cells, *[np.full(len(a), c, np.int64) for c, a in visits]])
            own = np.arange(len(rows)) < batch.num_rows
            part = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(cell, pa.int64(), mask=cell < 0), pa.array(own), pa.array((cell >= 0) & (cell % rings == 0))],
                names=[*part.schema.names, "cell", "own", "dense"],
            )

    dealt = left.mapInArrow(deal, f"{VECTOR}, cell bigint, own boolean, dense boolean")
    return dealt.withColumn("cell", F.concat_ws(":", F.when(F.col("cell").isNotNull(), F.concat_ws(":", F.lit(number), "cell"))))


def _cells(vectors: DataFrame, reach: float) -> DataFrame:
    """Every vector with its cell, and as a guest with those it visits."""
    left, parts, number = vectors, [], 0
    sizes = sorted(((r["g"], r["n"]) for r in _large(left)), key=lambda x: (-x[1], x[0]))
    while sizes:
        before = sum(n for _, n in sizes)
        dealt = scratch_table(_round(left, _pivots(left, sizes, number, reach), number, reach), "cells")
        parts.append(dealt.where("cell <> ''"))
        left = dealt.where("cell = ''").select("g", "node", "weight", "v")
        closed = parts[-1].where("own").count()
        number += 1
        if closed < WORTH * before:
            break
        sizes = sorted(((r["g"], r["n"]) for r in _large(left)), key=lambda x: (-x[1], x[0]))
    rest = left.select("*", F.concat(F.lit("rest:"), "g").alias("cell"), F.lit(True).alias("own"), F.lit(False).alias("dense"))
    for part in parts:
        rest = rest.unionByName(part)
    return rest


def _large(left: DataFrame) -> list:
    """The groups that are worth pivots, largest first, as many as may have any."""
    sizes = left.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL)
    return sizes.orderBy(F.desc("n"), "g").limit(PIVOT_GROUPS).collect()


class Forest:
    """Labels of the rows of a task: the lowest row that links have connected each with."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low, high = self.label[a], self.label[b]
            apart = low != high
            if not apart.any():
                return
            a, b, low, high = a[apart], b[apart], low[apart], high[apart]
            np.minimum.at(self.label, np.maximum(low, high), np.minimum(low, high))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


def _joined(table: pa.Table, limit: float) -> pa.Table:
    """Links between the two sides of a task, or inside its only block: sums of weights, and a forest."""
    left, right = table.filter(table["side"]), table.filter(pa.compute.invert(table["side"]))
    inner = right.num_rows == 0
    a = _matrix(left["v"].combine_chunks())
    b = a if inner else _matrix(right["v"].combine_chunks())
    n, m = len(a), 0 if inner else len(b)
    weights = [x["weight"].to_numpy() for x in ((left, left) if inner else (left, right))]
    sums = np.zeros(n + m, np.int64)
    forest = Forest(n + m)
    if n and (inner or m):
        for start in range(0, n, TILE):
            dots = a[start : start + TILE] @ b.T
            for i, j in zip(*np.nonzero(np.abs(dots - limit) <= CLOSE)):
                dots[i, j] = math.fsum(a[start + i] * b[j])
            linked = dots >= limit
            if inner:
                linked[np.arange(len(linked)), start + np.arange(len(linked))] = False
            sums[start : start + len(linked)] += linked @ weights[1]
            if not inner:
                sums[n:] += weights[0][start : start + len(linked)] @ linked
            i, j = np.nonzero(linked)
            forest.join(i + start, j if inner else j + n)
    nodes = np.concatenate([left["node"].to_numpy(), right["node"].to_numpy()])
    return pa.table({"node": nodes, "links": sums, "root": nodes[forest.label]})


def linked(
    table: DataFrame, limit: float, key: str = "vec_id", vector: str = "embedding", group: str = "label"
) -> DataFrame:
    """One row for each row: the key, ``n_links``, ``component_id`` (smallest key reachable by links) and ``kept``.

    ``n_links`` counts the other rows of the same group whose vectors have a cosine of at least ``limit`` (more
    than 0) in double precision. A vector that is null, empty, zero, or holds null or
    non-finite numbers links with nothing, nor does one whose group or key is null, or one of another
    width; its component is its own key. Equal vectors and rows that share a key are rows like others, and
    link. Of a component the row with the smallest key is kept; rows that share that key all are. Other
    columns are not read, so their names cannot clash. An empty table gives no rows.
    """
    if not 0 < limit <= 1:
        raise ValueError("the limit must be above 0 and at most 1")
    reach = math.acos(limit) + SLACK
    v = F.col(f"`{vector}`").cast("array<double>")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.forall("v", number) & F.exists("v", lambda x: x != 0) & F.col("group").isNotNull() & F.col("key").isNotNull()
    rows = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").cast("string").alias("group"), v.alias("v"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # Copies are told by 128 bits of hash.
    same = [F.xxhash64(F.lit(seed), "group", "v").alias(name) for seed, name in ((1, "h1"), (2, "h2"))]
    members = rows.select("key", F.when(F.col("sound"), F.struct(*same)).alias("copy"))
    distinct = rows.where("sound").groupBy(F.struct(*same).alias("copy")).agg(
        F.first(F.struct(F.concat_ws(":", "group", F.size("v")).alias("g"), "v")).alias("x"),
        F.min("key").alias("least"), F.count(F.lit(1)).alias("weight"),
    )
    nodes = scratch_table(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    vectors = nodes.select("x.g", "node", "weight", "x.v")
    found, edges = _links(scratch_table(_cells(vectors, reach), "dealt"), limit)
    parts = components(edges).withColumnRenamed("id", "node")
    known = nodes.select("copy", "node", "least", "weight").join(parts, "node", "left")
    known = known.select("copy", "node", "least", "weight", F.coalesce("component", "node").alias("component"))
    lowest = known.groupBy("component").agg(F.min("least").alias("lowest"))
    known = known.join(lowest, "component").join(found, "node", "left")
    known = known.select("copy", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "lowest")
    out = members.join(known, "copy", "left")
    component = F.coalesce("lowest", "key")
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _links(dealt: DataFrame, limit: float) -> tuple[DataFrame, DataFrame]:
    """Weight of the vectors linked with each node, and edges that connect what the links connect."""
    sizes = dealt.groupBy("cell").agg(
        F.count_if("own").alias("own_rows"), F.count_if(~F.col("own")).alias("guest_rows"),
        F.sum(F.when(F.col("own"), F.col("weight"))).alias("mass"), F.min(F.when(F.col("own"), F.col("node"))).alias("root"),
    )
    block = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(BLOCK), F.ceil(F.col("own_rows") / 16)))
    blocks = lambda rows: F.greatest(F.lit(1), F.ceil(F.col(rows) / block)).cast("int")
    sizes = sizes.where("own_rows > 0").select("*", blocks("own_rows").alias("own_blocks"), blocks("guest_rows").alias("guest_blocks"))
    sizes = scratch_table(sizes, "sizes")
    rows = dealt.join(broadcast_if_small(sizes, sizes.count()), "cell")
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("own"), F.col("own_blocks")).otherwise(F.col("guest_blocks"))).cast("int")
    task = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = F.col("block")
    inside = F.transform(upto("own_blocks"), lambda o: task("own", F.least(block, o), F.greatest(block, o)))
    with_guests = F.transform(upto("guest_blocks"), lambda o: task("guest", block, o))
    none = F.filter(inside, lambda _: F.lit(False))
    tasks = F.when(
        F.col("own"),
        F.concat(F.when(F.col("dense"), none).otherwise(inside), F.when(F.col("guest_rows") > 0, with_guests).otherwise(none)),
    ).otherwise(F.transform(upto("own_blocks"), lambda o: task("guest", o, block)))
    spread = rows.withColumn("block", mine).select("cell", "own", "block", "node", "weight", "v", F.explode(tasks).alias("task"))
    # The side of a row: guests, and the second block of two, stand on the right.
    side = F.when(F.col("task.kind") == "guest", F.col("own")).otherwise(F.col("task.a") == F.col("block"))
    spread = spread.select("cell", "task", side.alias("side"), "node", "weight", "v")
    compared = spread.groupBy("cell", "task").applyInArrow(lambda t: _joined(t, limit), "node bigint, links bigint, root bigint")
    compared = scratch_table(compared, "links")
    dense = rows.where("dense and own").select("node", (F.col("mass") - F.col("weight")).alias("links"), "root")
    both = compared.unionByName(dense)
    found = both.groupBy("node").agg(F.sum("links").alias("links"))
    return found, both.select(F.col("root").alias("a"), F.col("node").alias("b")).where("a <> b")
