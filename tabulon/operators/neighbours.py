"""Distances between rows without a join that emits pairs.

Rows are cut into small blocks. A task receives two blocks, compares them in
NumPy and returns a few numbers per row (sums, counts, nearest ids), never the
pairs themselves. Only rows of the same cell meet; a hot cell is only more
blocks, so no comparison holds more than two of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.vectors import distance_tiles, distances, matrix, measured_pairs, tiles, within_tiles  # noqa: F401
from tabulon.operators.ordered import positions, with_group_values
from tabulon.operators.pivots import CELL_ROWS, PivotIndex
from tabulon.session import scratch_path, settle, shuffles_removed, spread_groups, written

#: Rounded distances this near, relative to the lengths they are made of, are measured again, so that rounding cannot hide a tie.
NEAR = 1e-6
BLOCK_ROWS = 10_000
#: Where all rows meet all, blocks grow to this, so that rows are sent less often.
MOST_BLOCK_ROWS, BLOCKS = 40_000, 16
TASK_ROWS = 40_000
MOST_CLUSTERS = 10_000
#: Rows, counted with their copies, that one pass of comparisons sends; their shuffle files go with the pass.
PASS_ROWS = 2_000_000


def compare_blocks(
    targets: DataFrame,
    references: DataFrame,
    key: str,
    payload: Sequence[str],
    compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    block_rows: int = BLOCK_ROWS,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    sliced: bool = False,
) -> DataFrame:
    """Run ``compare(targets, references)`` within each ``cell``, block by block.

    Both tables carry a ``cell``; a row may stand in several. A cell with many
    rows is cut into blocks by hash, and every target block meets every
    reference block. The tables are read twice, so pass settled ones. Where more than ``PASS_ROWS`` would be sent, slices
    of the targets meet the references one after the other, so that the disk holds the copies of one slice; ``fold`` then
    shortens what a slice found, which holds all that there is for its keys.
    """
    def blocks(df: DataFrame, name: str) -> DataFrame:
        sizes = df.groupBy("cell").agg(F.count(F.lit(1)).alias(f"n_{name}"))
        return sizes.withColumn(f"blocks_{name}", F.ceil(F.col(f"n_{name}") / F.lit(block_rows)).cast("int"))

    cells = settle(blocks(targets, "t").join(blocks(references, "r"), "cell"))
    volume = cells.agg(F.sum(F.col("n_t") * F.col("blocks_r") + F.col("n_r") * F.col("blocks_t"))).first()[0]
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if (passes := math.ceil((volume or 0) / PASS_ROWS)) > 1 and not sliced:
        slices = [targets.where(F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(passes)) == i) for i in range(passes)]
        fold = fold or (lambda found: found)
        with shuffles_removed(targets.sparkSession):
            parts = [written(fold(compare_blocks(x, references, key, payload, compare, schema, block_rows, sliced=True))) for x in slices]
        return reduce(DataFrame.unionByName, parts)
    tasks = max(1, math.ceil((volume or 0) / TASK_ROWS))
    columns = [key, *[p for p in payload if p != key]]

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64(key), F.col(f"blocks_{mine}")).cast("string")
        against = F.col("_other").cast("string")
        order = [block, against] if mine == "t" else [against, block]
        return (
            df.join(cells, "cell")
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(f"blocks_{other}") - 1)))
            .select(F.lit(mine == "t").alias("_target"), F.concat_ws("~", "cell", *order).alias("_pair"), large.alias("_large"), *columns)
        )

    # Small pairs of blocks share a task; a large one has its own, so that no worker holds several by chance.
    large = F.col("n_t") / F.col("blocks_t") + F.col("n_r") / F.col("blocks_r") >= TASK_ROWS / 8

    both = side(targets, "t", "r").unionByName(side(references, "r", "t"))
    names = schema.names

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in pdf.groupby("_pair", sort=False):
            left = rows[rows["_target"]].reset_index(drop=True)
            right = rows[~rows["_target"]].reset_index(drop=True)
            if len(left) and len(right):
                out.append(compare(left, right))
        return pd.concat(out, ignore_index=True)[names] if out else pd.DataFrame(columns=names)

    pair = F.xxhash64("_pair")
    numbered = both.withColumn("_task", F.when(F.col("_large"), pair).otherwise(F.pmod(pair, F.lit(tasks)))).drop("_large")
    return spread_groups(numbered, "_task", tasks).groupBy("_task").applyInPandas(run, schema)


def in_one_cell(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row against every row."""
    marked = points.withColumn("cell", F.lit("all"))
    return marked, marked


def silhouettes(
    df: DataFrame, key: str, vector: str, labelings: Sequence[str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Silhouette of every row under each labeling: ``(key, labeling, cluster, silhouette)``.

    By Euclidean distance to all rows; a row alone in its cluster scores 0. Exact. Means and mean squares of
    the clusters bound the mean distance of a row to each of them, ‖x − mean‖ from below and the root of the mean
    square from above; only the own cluster and those that can be the nearest are measured. Where clusters
    lie so close that this saves nothing, all labelings share one round of all distances. See
    :func:`squared_silhouette` for the linear measure on squared distances.
    """
    slots = [f"c{i}" for i in range(len(labelings))]
    points = settle(
        df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"),
                  *[F.col(c).cast("bigint").alias(s) for c, s in zip(labelings, slots)])
    )

    def sums(t: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        left, right, out = matrix(t["v"]), matrix(r["v"]), []
        groups = []
        for slot in slots:
            found, where = np.unique(r[slot].to_numpy(), return_inverse=True)
            order = np.argsort(where, kind="stable")
            groups.append((slot, found, order, np.searchsorted(where[order], np.arange(len(found)))))
        for part, d in distance_tiles(left, right):
            for i, (slot, found, order, starts) in enumerate(groups):
                totals = np.add.reduceat(d[:, order], starts, axis=1)
                out.append(
                    pd.DataFrame(
                        {
                            "key": np.repeat(t["key"].to_numpy()[part], len(found)),
                            "which": np.int32(i),
                            "c": np.repeat(t[slot].to_numpy()[part], len(found)),
                            "other": np.tile(found, len(d)),
                            "s": totals.ravel(),
                        }
                    )
                )
        return pd.concat(out)

    schema = T.StructType(
        [points.schema["key"], T.StructField("which", T.IntegerType()), T.StructField("c", T.LongType()),
         T.StructField("other", T.LongType()), T.StructField("s", T.DoubleType())]
    )
    named = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(s).alias("other")) for i, s in enumerate(slots)]))
    sizes = points.select(named.alias("x")).select("x.*").groupBy("which", "other").agg(F.count(F.lit(1)).alias("n"))
    visits = _possible_clusters(points, slots)
    if visits is None and sizes.limit(MOST_CLUSTERS + 1).count() <= MOST_CLUSTERS:
        partial = _all_distances(points, slots, sizes.where("other is not null"), block_rows)
    elif visits is None:
        partial = compare_blocks(*in_one_cell(points), "key", ["v", *slots], sums, schema, block_rows)
    else:
        cell = F.concat_ws("|", "which", F.coalesce("other", F.lit("")))
        rows = points.select("key", "v", named.alias("x")).select("key", "v", "x.*")
        targets = settle(visits.withColumn("cell", cell))

        def to_cluster(t: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            left, right = matrix(t["v"]), matrix(r["v"])
            found = [d.sum(axis=1) for _, d in distance_tiles(left, right)]
            return t[["key", "which", "c", "other"]].assign(s=np.concatenate(found))

        payload = ["v", "which", "c", "other"]
        references = settle(rows.withColumn("c", F.lit(None).cast("bigint")).withColumn("cell", cell))
        partial = compare_blocks(targets, references, "key", payload, to_cluster, schema, block_rows)
    own = F.col("c") == F.col("other")
    per_cluster = partial.groupBy("key", "which", "c", "other").agg(F.sum("s").alias("s")).join(sizes, ["which", "other"])
    ab = per_cluster.groupBy("key", "which", "c").agg(
        F.max(F.when(own, F.try_divide(F.col("s"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    value = F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))
    labeling = F.element_at(F.array(*[F.lit(c) for c in labelings]), F.col("which") + 1)
    return ab.select(
        F.col("key").alias(key), labeling.alias("labeling"), F.col("c").alias("cluster"), value.alias("silhouette")
    )


def _all_distances(points: DataFrame, slots: Sequence[str], sizes: DataFrame, block_rows: int) -> DataFrame:
    """Sums of the distances of every row to each cluster: key, which, c, other, s.

    Rows equal in vector and clusters are one weighted point. A pair of blocks gives one list of sums for each point, from
    one product of the distances and the clusters of all labelings.
    """
    same = ["v", *slots]
    alike = settle(points.groupBy(*same).agg(F.count(F.lit(1)).cast("double").alias("w")))
    alike = settle(alike.withColumn("rep", F.monotonically_increasing_id()))
    clusters = sizes.select("which", "other").orderBy("which", "other").collect()  # at most MOST_CLUSTERS
    places = [{r["other"]: at for at, r in enumerate(clusters) if r["which"] == i} for i in range(len(slots))]

    def sums(t: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        left, right, w = matrix(t["v"]), matrix(r["v"]), r["w"].to_numpy(dtype=float)
        share = np.zeros((len(right), len(clusters)))
        for slot, place in zip(slots, places):
            at = r[slot].map(place).to_numpy(dtype=float)
            has = np.flatnonzero(~np.isnan(at))
            share[has, at[has].astype(int)] = w[has]
        totals = [d @ share for _, d in distance_tiles(left, right)]
        return pd.DataFrame({"rep": t["rep"], "s": list(np.concatenate(totals))})

    rows = max(block_rows, min(MOST_BLOCK_ROWS, -(-alike.count() // BLOCKS)))
    added = lambda found: found.groupBy("rep").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"))
    totals = added(compare_blocks(*in_one_cell(alike), "rep", ["v", "w", *slots], sums, "rep bigint, s array<double>", rows, added))
    numbered = points.sparkSession.createDataFrame(
        [(at, r["which"], r["other"]) for at, r in enumerate(clusters)], "at int, which int, other bigint"
    )
    p, a = points.alias("p"), alike.alias("a")
    match = reduce(lambda x, y: x & y, [F.col(f"p.{c}").eqNullSafe(F.col(f"a.{c}")) for c in same])
    keyed = p.join(a, match).select("p.key", "a.rep", *[f"p.{c}" for c in slots])
    long = keyed.join(totals, "rep").select("key", *slots, F.posexplode("s").alias("at", "s")).join(F.broadcast(numbered), "at")
    return long.select("key", "which", F.get(F.array(*slots), F.col("which")).alias("c"), "other", "s")


def _possible_clusters(points: DataFrame, slots: Sequence[str]) -> DataFrame | None:
    """Each row with its own cluster and those that may be the nearest other one: key, v, which, c, other.

    None where that would be as many comparisons as all pairs, or the clusters are more than can be sent around.
    """
    power = F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0), lambda s, x: s + x)
    stats = []
    for i, slot in enumerate(slots):
        mean = vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("m")
        own = points.groupBy(F.col(slot).alias("c")).agg(mean, F.avg(power).alias("p"), F.count(F.lit(1)).alias("n"))
        # One more than may be sent tells that there are too many.
        stats.append(own.limit(MOST_CLUSTERS + 1).toPandas())
        if sum(map(len, stats)) > MOST_CLUSTERS or any(t["c"].isna().any() for t in stats):
            return None
    if any(len(t) == 0 for t in stats):
        return None
    sent = [(t["c"].to_numpy(dtype="int64"), matrix(t["m"]), t["p"].to_numpy(dtype=float)) for t in stats]

    def reachable(parts):
        """For each part and labeling: the rows' own clusters, and which clusters a row has to be measured against."""
        for part in parts:
            if not len(part):
                continue
            v = matrix(part["v"])
            square = (v * v).sum(axis=1)
            for i, (names, means, powers) in enumerate(sent):
                own = np.searchsorted(order_of[i], part[slots[i]].to_numpy(dtype="int64"))
                own = rank_of[i][own]
                low = distances(v, means)
                high = np.sqrt(np.maximum(square[:, None] - 2.0 * (v @ means.T) + powers[None, :], 0.0))
                give = 1e-6 * (1.0 + np.sqrt(square) + np.sqrt(powers.max()))
                at = np.arange(len(v))
                high[at, own] = np.inf
                keep = low <= (high.min(axis=1) + give)[:, None]
                keep[at, own] = True
                yield part, i, own, keep

    def bounded(parts):
        for part, i, own, keep in reachable(parts):
            row, cluster = np.nonzero(keep)
            names = sent[i][0]
            yield pd.DataFrame(
                {"key": part["key"].to_numpy()[row], "v": part["v"].to_numpy()[row], "which": np.int32(i),
                 "c": names[own[row]], "other": names[cluster]}
            )

    def counted(parts):
        for _, i, _, keep in reachable(parts):
            yield pd.DataFrame({"which": np.int32(i), "other": sent[i][0], "rows": keep.sum(axis=0)})

    rank_of = [np.argsort(names, kind="stable") for names, _, _ in sent]
    order_of = [names[order] for (names, _, _), order in zip(sent, rank_of)]
    kind = points.schema["key"].dataType.simpleString()
    visits = points.mapInPandas(bounded, f"key {kind}, v array<double>, which int, c bigint, other bigint")
    counts = points.mapInPandas(counted, "which int, other bigint, rows bigint").groupBy("which", "other")
    counts = counts.agg(F.sum("rows").alias("rows")).collect()  # as many rows as clusters
    size = {(i, int(c)): int(n) for i, t in enumerate(stats) for c, n in zip(t["c"], t["n"])}
    pairs = sum(r["rows"] * size[r["which"], r["other"]] for r in counts)
    whole = max(sum(int(n) for n in t["n"]) for t in stats) ** 2
    return visits if pairs < whole else None


def silhouette(df: DataFrame, key: str, vector: str, cluster: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Silhouette of every row under one labeling."""
    out = silhouettes(df, key, vector, [cluster], block_rows)
    return out.select(key, F.col("cluster").alias(cluster), "silhouette")


def mean_silhouettes(df: DataFrame, key: str, vector: str, labelings: Sequence[str]) -> DataFrame:
    """Mean silhouette and number of clusters of each labeling."""
    rows = silhouettes(df, key, vector, labelings)
    return rows.groupBy("labeling").agg(
        F.countDistinct("cluster").alias("clusters"), F.avg("silhouette").alias("silhouette")
    )


def squared_silhouette(df: DataFrame, key: str, vector: str, cluster: str, at_once: int = MOST_CLUSTERS) -> DataFrame:
    """Silhouette by squared distance, from cluster sums alone: one aggregate and one pass.

    The mean squared distance of x to a cluster is |x|² − 2·x·mean + mean|y|². Rows meet ``at_once`` clusters in a
    pass; with more clusters there are more passes, which carry the least distance so far.
    """
    base = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"),
                     F.col(cluster).cast("bigint").alias("c"))
    power = F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0), lambda s, x: s + x)
    sums = base.groupBy("c").agg(
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("m"),
        F.avg(power).alias("p"),
        F.count(F.lit(1)).alias("n"),
    )
    clusters = settle(positions(settle(sums), [], ["c"], "place"))
    passes = -(-clusters.count() // at_once)
    none = F.lit(None).cast("double")
    measured = base.withColumns({"xx": power, "a": none, "b": none})

    def mean_distance(s):
        dot = F.aggregate(F.zip_with("v", s["m"], lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
        return F.struct(s["c"].alias("c"), s["n"].alias("n"), (F.col("xx") - 2 * dot + s["p"]).alias("d"))

    for k in range(passes):
        some = clusters.where((F.col("place") >= k * at_once) & (F.col("place") < (k + 1) * at_once))
        summary = some.agg(F.collect_list(F.struct("c", "m", "p", "n")).alias("clusters"))
        wide = with_group_values(measured, summary, []).withColumn("ds", F.transform("clusters", mean_distance))
        own = F.get(F.filter("ds", lambda s: s["c"] == F.col("c")), F.lit(0))
        other = F.array_min(F.transform(F.filter("ds", lambda s: s["c"] != F.col("c")), lambda s: s["d"]))
        a = F.try_divide(own["d"] * own["n"], own["n"] - 1)
        measured = wide.select("key", "c", "v", "xx", F.coalesce("a", a).alias("a"), F.least("b", other).alias("b"))
        if passes > 1:
            measured = settle(measured)
    value = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return measured.select(F.col("key").alias(key), F.col("c").alias(cluster), value.alias("silhouette"))


def nearest(
    df: DataFrame, key: str, vector: str, k: int, among: str | None = None, include_self: bool = False,
    block_rows: int = BLOCK_ROWS, cell_rows: int | None = None,
) -> DataFrame:
    """The k nearest rows of every row: ``(key, neighbour, distance)``; ties go to the smaller key.

    ``among`` names a boolean column; only rows where it is true can be neighbours. Exact: a row is compared
    with its own cell of a pivot index, and then with the cells that the bounds of the index cannot leave out.
    """
    allowed = F.col(among) if among else F.lit(True)
    points = settle(
        df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"), allowed.alias("ok"))
    )

    def best(t: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        r = r[r["ok"]].sort_values("key")
        if not len(r):
            return pd.DataFrame({"key": t["key"].iloc[:0], "neighbour": t["key"].iloc[:0], "distance": np.zeros(0)})
        ids, keys, left, right, out = r["key"].to_numpy(), t["key"].to_numpy(), matrix(t["v"]), matrix(r["v"]), []
        lengths = np.sqrt((left * left).sum(axis=1)) + np.sqrt((right * right).sum(axis=1).max())
        for part, d in distance_tiles(left, right):
            if not include_self:
                d[keys[part][:, None] == ids[None, :]] = np.inf
            # The block's distances are rounded; those of the candidates are measured again, term by term.
            limit = np.partition(d, k - 1, axis=1)[:, k - 1] if k < len(ids) else np.full(len(d), np.inf)
            i, j = np.nonzero((d <= (limit + NEAR * lengths[part])[:, None]) & (d < np.inf))
            exact = measured_pairs(left[part], right, i, j)
            order = np.lexsort((j, exact, i))
            i, j, exact = i[order], j[order], exact[order]
            first = np.flatnonzero(np.diff(i, prepend=-1))
            place = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
            best = place < k
            out.append(pd.DataFrame({"key": keys[part][i[best]], "neighbour": ids[j[best]], "distance": exact[best]}))
        return pd.concat(out)

    key_type = points.schema["key"].dataType
    schema = T.StructType([T.StructField("key", key_type), T.StructField("neighbour", key_type),
                           T.StructField("distance", T.DoubleType())])
    order = Window.partitionBy("key").orderBy("distance", "neighbour")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    index = PivotIndex(points.where("ok"), cell_rows or CELL_ROWS)
    references, targets = settle(index.placed), settle(index.place(points))
    # The own cell first: its k-th distance bounds the search in the others.
    shortest = lambda rows: ranked(rows).drop("rank")
    near = settle(ranked(compare_blocks(targets, references, "key", ["v", "ok"], best, schema, block_rows, shortest)))
    reach = near.where(F.col("rank") == k).select("key", F.col("distance").alias("reach"))
    aimed = targets.join(reach, "key", "left")
    # Where no bound helps every row visits every cell: then some rows after the other, each time into the same files.
    most = targets.count() * max(0, len(index.pivots) - 1)
    passes = max(1, math.ceil((index.visits(aimed, "reach", ["cell"]).count() if most > PASS_ROWS else most) / PASS_ROWS))
    path, parts = scratch_path(df.sparkSession, "visits"), [near.drop("rank")]
    with shuffles_removed(df.sparkSession):
        for i in range(passes):
            some = aimed.where(F.pmod(F.xxhash64(F.lit("visit"), "key"), F.lit(passes)) == i)
            index.visits(some, "reach", targets.columns).write.mode("overwrite").parquet(path)
            visits = df.sparkSession.read.schema(targets.schema).parquet(path)
            far = compare_blocks(visits, references, "key", ["v", "ok"], best, schema, block_rows, sliced=True)
            parts.append(written(shortest(far)))
    found = ranked(reduce(DataFrame.unionByName, parts))
    return found.select(F.col("key").alias(key), "neighbour", "distance", "rank")
