"""Jaccard self-join of five-word shingle sets by chosen paths.

Copies (equal shingle sets) are one set with a weight. Every set is embedded as 64 min-hashes. A path
is a chain of tokens of the embedding; a set follows those tokens whose hash, drawn anew for each
path, falls below a limit, so similar sets follow the same ones. Sets with one path share a bucket.
Small buckets are compared by brute force, large ones are split by one more token, and runs repeat
the whole until the recall aimed at. What is alike by its embedding in a bucket becomes an edge, no
more of them than members; sets connected by edges are then compared exactly, text by text, block by
block, so links are counted without ever being listed.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.components import components
from tabulon.llm.hashing import U64, gram_hashes, inside, mix, rows_of, span_hashes, word_bounds
from tabulon.llm.shared import BROADCAST_ROWS, broadcast_if_small, checkpoint, scratch_table, text_blocks, without

SHINGLE, SIMILARITY = 5, 0.8
EMBEDDED, DEPTH = 64, 3
#: Tokens that two sets at the threshold are expected to follow together at each step.
SHARED_STEPS = 1.25
RECALL = 0.999
#: Sets of a bucket that is compared as it is, and of a block of a larger one that cannot be split.
BUCKET, BLOCK = 64, 256
#: Text of a block of an exact comparison, on average.
BLOCK_TEXT = 4 << 20
#: Text whose shingles are hashed at a time: a worker holds about 60 bytes of arrays for each of them.
EMBED_TEXT = 1 << 19
#: Four standard errors of the embedded similarity below the threshold.
NEAR = SIMILARITY - 4 * math.sqrt(SIMILARITY * (1 - SIMILARITY) / EMBEDDED)


def runs_needed(recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met, even if every run takes all steps."""
    meet = 1.0
    for _ in range(DEPTH):
        meet = 1 - math.exp(-SHARED_STEPS * meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, sorted.

    Shingles are five words; a text of one to four words is one shingle. Hashes have 64 bits.
    """
    starts, ends, row_words = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends)
    at = inside(row_words, SHINGLE)
    rows = rows_of(row_words)[at]
    grams = gram_hashes(words, SHINGLE)[at] if len(at) else np.zeros(0, U64)
    counts = np.diff(row_words)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), U64)
        for k in range(SHINGLE - 1):
            has = counts[short] > k
            whole[has] = mix(whole[has] + words[row_words[short[has]] + k] + U64(k + 1))
        rows, grams = np.concatenate([rows, short]), np.concatenate([grams, whole])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows[first], grams[first]


def _embed(batches):
    """For each text: two sums over its set that name it, and the min-hashes."""
    factors = mix(np.arange(1, EMBEDDED + 1, dtype=U64)).astype(np.uint32) | np.uint32(1)
    for batch in batches:
        for part, data, offsets in text_blocks(batch, limit=EMBED_TEXT):
            rows, grams = shingle_sets(data, offsets)
            present, first = np.unique(rows, return_index=True)
            name1, name2 = np.zeros(len(part), U64), np.zeros(len(part), U64)
            sign = np.zeros((len(part), EMBEDDED), np.uint32)
            if len(present):
                name1[present] = np.add.reduceat(mix(grams + U64(17)), first)
                name2[present] = np.add.reduceat(mix(grams ^ U64(0x9E3779B97F4A7C15)), first)
                short = (grams >> U64(32)).astype(np.uint32)
                for k, factor in enumerate(factors):
                    sign[present, k] = np.minimum.reduceat(short * factor, first)
            empty = np.ones(len(part), bool)
            empty[present] = False
            raw = sign.tobytes()
            width = EMBEDDED * 4
            yield pa.RecordBatch.from_pydict(
                {
                    "id": part.column(0),
                    "k1": pa.array(name1.view(np.int64), mask=empty),
                    "k2": pa.array(name2.view(np.int64), mask=empty),
                    "sign": [raw[i * width : (i + 1) * width] for i in range(len(part))],
                    "size": np.diff(offsets),
                }
            )


def _chosen(seeds: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and new path of every token that is followed, for one path and 64 tokens in each row."""
    limit = U64(int(min(1.0, SHARED_STEPS / SIMILARITY / EMBEDDED) * float(1 << 63)) * 2)
    drawn = mix(tokens ^ seeds[:, None])
    rows, columns = np.nonzero(drawn < limit)
    return rows, mix(seeds[rows] + mix(tokens[rows, columns]))


def _tokens(signs) -> np.ndarray:
    """Embedded tokens: the place and its min-hash."""
    sign = np.frombuffer(b"".join(signs), np.uint32).reshape(-1, EMBEDDED).astype(U64)
    return mix(sign | (np.arange(EMBEDDED, dtype=U64) << U64(32)))


def _first_step(runs: int):
    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, tokens = batch.column(0).to_numpy(), _tokens(batch.column(1).to_pylist())
            for run in range(runs):
                rows, paths = _chosen(np.full(len(ids), mix(np.array([run + 1], U64))[0]), tokens)
                yield pa.RecordBatch.from_pydict({"id": ids[rows], "path": paths.view(np.int64)})

    return work


def _next_step(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, tokens = batch.column(0).to_numpy(), _tokens(batch.column(2).to_pylist())
        rows, paths = _chosen(batch.column(1).to_numpy().view(U64), tokens)
        yield pa.RecordBatch.from_pydict({"id": ids[rows], "path": paths.view(np.int64)})


def _groups(batches, keys: int):
    """Tables whose rows are whole groups; rows come sorted by the first ``keys`` columns."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        last = [held.column(k)[-1].as_py() for k in range(keys)]
        same = np.ones(held.num_rows, bool)
        for k in range(keys):
            same &= held.column(k).to_numpy() == last[k]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None:
        yield held


def _least_label(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the lowest node it is connected to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _bucket_edges(batches):
    """Brute force over buckets: members that look alike, as edges to the lowest of their kind."""
    for table in _groups(batches, 3):
        keys = np.stack([table.column(k).to_numpy() for k in range(3)])
        ids = table.column(3).to_numpy()
        sign = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint32).reshape(-1, EMBEDDED)
        left, right, shift = [], [], 1
        at = np.arange(len(ids) - 1)
        while len(at):
            at = at[at + shift < len(ids)]
            at = at[(keys[:, at] == keys[:, at + shift]).all(0)]
            for part in np.array_split(at, len(at) // 65536 + 1):
                alike = (sign[part] == sign[part + shift]).sum(1) >= NEAR * EMBEDDED
                left.append(part[alike])
                right.append(part[alike] + shift)
            shift += 1
        a, b = np.concatenate(left or [at]), np.concatenate(right or [at])
        label = _least_label(len(ids), a, b)
        moved = np.flatnonzero(label != np.arange(len(ids)))
        if len(moved):
            yield pa.RecordBatch.from_pydict({"a": ids[label[moved]], "b": ids[moved]})


def _blocked(rows: DataFrame, blocks, *keep) -> DataFrame:
    """Deal the members of a group to blocks by hash and repeat each for every pair its block is in."""
    rows = rows.withColumns({"_blocks": blocks.cast("int")}).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    return rows.select(*keep, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), F.col("_own").alias("own"))


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys)


def _compared(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges of the groups (path, i, j)."""
    rows = rows.select("path", "i", "j", "id").join(sets.select("id", "sign"), "id").select("path", "i", "j", "id", "sign")
    return _dealt(rows, "path", "i", "j").mapInArrow(_bucket_edges, "a bigint, b bigint")


def _blocks(count: Column) -> Column:
    return F.when(count <= 2 * BLOCK, 1).otherwise(F.ceil(count / BLOCK)).cast("int")


def _across_blocks(large: DataFrame, edges: DataFrame, sets: DataFrame) -> DataFrame:
    """What the blocks of large buckets left unseen: whoever is not yet connected to most of its bucket.

    Those few are compared with the whole bucket; a bucket that is one component by now needs nothing.
    """
    found = components(edges).select("id", F.col("component").alias("c"))
    marked = checkpoint(large.join(found, "id", "left").select("path", "id", "n", F.coalesce("c", "id").alias("c")))
    main = marked.groupBy("path", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("path").agg(F.max(F.struct("k", "c")).alias("main"))
    rest = marked.join(main, "path").where(F.col("n") > F.col("main.k"))
    rest = rest.withColumns({"whole": _blocks(F.col("n")), "few": _blocks(F.col("n") - F.col("main.k"))})
    dealt = lambda parts: F.pmod(F.xxhash64("id", "path"), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    sides = rest.select("path", "id", dealt("whole").alias("j"), each("few").alias("i")).unionByName(
        rest.where(F.col("c") != F.col("main.c")).select("path", "id", dealt("few").alias("i"), each("whole").alias("j"))
    )
    return _compared(sides, sets)


def _candidates(sets: DataFrame, recall: float) -> DataFrame:
    """Edges (a, b) between sets that look alike in a bucket."""
    paths = checkpoint(sets.select("id", "sign").mapInArrow(_first_step(runs_needed(recall)), "id bigint, path bigint"))
    ready = []
    for step in range(1, DEPTH + 1):
        counts = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = checkpoint(paths.join(counts, "path"))
        large = sized.where(F.col("n") > BUCKET)
        if step == DEPTH or large.isEmpty():
            ready.append(sized)
            break
        ready.append(sized.where(F.col("n") <= BUCKET))
        paths = checkpoint(large.join(sets.select("id", "sign"), "id").select("id", "path", "sign").mapInArrow(_next_step, "id bigint, path bigint").distinct())
    rows = reduce(DataFrame.unionByName, ready)
    # One block of a bucket at first, so that no row is repeated.
    dealt = F.pmod(F.xxhash64("id", "path"), _blocks(F.col("n"))).cast("int")
    edges = checkpoint(_compared(rows.withColumns({"i": dealt, "j": F.lit(0)}), sets))
    large = ready[-1].where(F.col("n") > 2 * BLOCK)
    return edges if large.isEmpty() else edges.unionByName(_across_blocks(large, edges, sets))


def _common(rows: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
    """Shingles that each two of n sets have in common."""
    order = np.argsort(grams, kind="stable")
    rows, grams = rows[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    rows, column = rows[often], column[often]
    common = np.zeros((n, n), np.float32)
    width = max(64, (1 << 22) // max(n, 1))  # columns held as a dense block at a time
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + width))
        block = np.zeros((n, int(column[end - 1] - column[at]) + 1), np.float32)
        block[rows[at:end], column[at:end] - column[at]] = 1
        common += block @ block.T
        at = end
    return common.astype(np.int64)


def _exact(similarity: float):
    """For the members of each pair of blocks: the weight of their links, and the lowest they reach."""
    parts, whole = round(similarity * 10_000), 10_000

    def work(batches):
        for table in _groups(batches, 3):
            keys = np.stack([table.column(k).to_numpy() for k in range(3)])
            edge = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), table.num_rows]):
                group = table.slice(a, b - a).combine_chunks()
                once = np.unique(group.column(3).to_numpy(), return_index=True)[1]
                if len(once) < b - a:  # rows that repeat a key
                    group = group.take(pa.array(once)).combine_chunks()
                ids, own = group.column(3).to_numpy(), group.column(4).to_numpy()
                weight = group.column(5).to_numpy()
                rows, grams, base = [], [], 0
                for part, data, offsets in text_blocks(group.to_batches()[0], limit=EMBED_TEXT):
                    r, g = shingle_sets(data, offsets)
                    rows.append(r + base)
                    grams.append(g)
                    base += len(part)
                rows, grams = np.concatenate(rows), np.concatenate(grams)
                n = len(ids)
                sizes = np.bincount(rows, minlength=n)
                common = _common(rows, grams, n)
                linked = common * whole >= parts * (sizes[:, None] + sizes[None, :] - common)
                np.fill_diagonal(linked, False)
                if keys[1, a] != keys[2, a]:
                    linked &= own[:, None] != own[None, :]
                links = linked @ weight
                low = _least_label(n, *np.nonzero(np.triu(linked)))
                hit = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_pydict({"id": ids[hit], "links": links[hit], "low": ids[low[hit]]})

    return work


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row for each row of the input: the key, class_id and n_links.

    ``n_links`` counts the other rows whose shingle set has at least the similarity, equal sets
    included; ``class_id`` is the smallest key among all rows connected by links. Texts without a
    word and rows without a key have no links; the class of the former is their own key, of the
    latter null. Rows that repeat a key with one text count as copies of each other; rows with one key
    and different texts are told apart but share what is found for the key. Keys are integers; other
    columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    named = rows.where("id is not null")
    sets = scratch_table(named.mapInArrow(_embed, "id bigint, k1 bigint, k2 bigint, sign binary, size bigint"), "sets")
    copies = checkpoint(sets.where("k1 is not null").groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    heads = copies.select(F.col("first").alias("id"), "copies", "k1", "k2")
    # One row for each different set.
    single = checkpoint(sets.join(heads, ["id", "k1", "k2"]).groupBy("id").agg(F.first("sign").alias("sign"), F.max("size").alias("size"), F.max("copies").alias("copies")))
    near = components(_candidates(single, recall))
    near = checkpoint(near.join(single.drop("sign"), "id"))
    sizes = near.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    members = checkpoint(near.select("id", "component", "copies").join(sizes, "component"))
    blocks = F.greatest(F.when(F.col("n") > 2 * BLOCK, F.ceil(F.col("n") / BLOCK)).otherwise(1), F.ceil(F.col("bytes") / (2 * BLOCK_TEXT)))
    members = broadcast_if_small(members, members.count(), BROADCAST_ROWS)
    dealt = _blocked(named.join(members, "id"), blocks, "component", "id", "copies", "text")
    dealt = _dealt(dealt.select("component", "i", "j", "id", "own", "copies", "text"), "component", "i", "j")
    found = checkpoint(dealt.mapInArrow(_exact(similarity), "id bigint, links bigint, low bigint"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("low").alias("a"), F.col("id").alias("b")))
    result = copies.join(links, F.col("first") == links["id"], "left").drop("id")
    result = result.join(classes, F.col("first") == classes["id"], "left").select(
        "k1",
        "k2",
        F.coalesce("component", "first").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = sets.select("id", "k1", "k2").join(result, ["k1", "k2"], "left")
    out = out.select(F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    nameless = rows.where("id is null").select(F.col("id").alias(key), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(nameless)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose key is the smallest of its class, with the columns of the input.

    Rows without a key stay, and so do rows that repeat the key that stays.
    """
    return without(docs, key, linked(docs, key, text).where(F.col("class_id") < F.col(key)).select(key))
