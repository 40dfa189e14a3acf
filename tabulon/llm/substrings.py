"""Removal of passages that repeat across documents: a count-min prefilter, then exact grouping.

The unit is a window of 50 words. Its anchor is the lowest hash among its runs of 25 words, so equal
windows have equal anchors, and neighbouring windows mostly share one. Pass one counts, for every
anchor, the stretches that have it: each task adds up a sketch, and the sketches are merged slice by
slice. As a window is counted where its anchor is, the sketch never counts it too low. Pass two keeps
only windows whose anchor is counted twice or more in every row of the sketch, so no repeated window
is lost, and groups them exactly by 128 bits of hash, 64 of the anchor and 64 of the window.

Windows travel as segments (neighbours with one anchor). Equal segments are settled as a whole:
outside the document with the smallest id every window of them goes. Only that document's windows are
then compared one by one, and only where an anchor has segments of different kinds. Every step aggregates before it shuffles, so
a passage in a third of all documents is a few rows for each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.hashing import U64, before, gram_hashes, inside, inverse, mix, powers, span_hashes, word_bounds
from tabulon.llm.shared import scratch_table, text_blocks

WINDOW, ANCHOR = 50, 25
#: Rows of the sketch, counters in a slice of a row, and bits of the largest row (both rows of
#: one bit each are sent to the executors: at most 32 MB). With more windows than that holds apart, more of
#: them pass the filter; none is lost.
DEPTH, SLICE_BITS, MOST_BITS = 2, 20, 27
#: Counters for each anchor expected, and bytes of text for each such anchor.
COUNTERS_PER_ANCHOR, BYTES_PER_ANCHOR = 4, 75
#: Slots a task gathers before it passes its sketch on, and windows of a segment.
GATHERED, SEGMENT = 1 << 22, 256
SEEDS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)


def _windows(data: np.ndarray, offsets: np.ndarray):
    """Word hashes, words before each row, window starts inside rows, and the anchor of each."""
    starts, ends, row_words = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends)
    at = inside(row_words, WINDOW)
    if not len(at):
        return words, row_words, at, np.zeros(0, U64)
    low = gram_hashes(words, ANCHOR)
    for step in (1, 2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    rest = WINDOW - ANCHOR + 1 - 16
    low = np.minimum(low[:-rest], low[rest:])
    return words, row_words, at, low[at]


def _runs(at: np.ndarray, anchors: np.ndarray, row_words: np.ndarray) -> np.ndarray:
    """Indices into ``at``, which may leave windows out, where a stretch of neighbours with one anchor begins."""
    row = np.searchsorted(row_words, at, "right")
    new = np.ones(len(at), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    return np.flatnonzero(new)


def _slots(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(anchors ^ U64(seed)) >> U64(64 - bits)).astype(np.int64) for seed in SEEDS[:DEPTH]]


def _sketch_rows(gathered: list[list[np.ndarray]]):
    """A task's sketch by slice: slots met once, and slots met more often."""
    for row, parts in enumerate(gathered):
        slots, counts = np.unique(np.concatenate(parts), return_counts=True)
        pieces = slots >> SLICE_BITS
        names, first = np.unique(pieces, return_index=True)
        bounds = [*first.tolist(), len(slots)]
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array(np.full(len(names), row), pa.int32()),
                "slice": pa.array(names, pa.int32()),
                "once": [
                    (slots[a:b][counts[a:b] == 1] & ((1 << SLICE_BITS) - 1)).astype("<u4").tobytes()
                    for a, b in zip(bounds, bounds[1:])
                ],
                "more": [
                    (slots[a:b][counts[a:b] > 1] & ((1 << SLICE_BITS) - 1)).astype("<u4").tobytes()
                    for a, b in zip(bounds, bounds[1:])
                ],
            }
        )


def sketch(docs: DataFrame, bits: int) -> np.ndarray:
    """Packed bits by row and slot: whether the merged count is two or more."""

    def count(batches):
        gathered, size = [[] for _ in range(DEPTH)], 0
        for batch in batches:
            for _, data, offsets in text_blocks(batch):
                _, row_words, at, anchors = _windows(data, offsets)
                if not len(at):
                    continue
                for parts, slots in zip(gathered, _slots(anchors[_runs(at, anchors, row_words)], bits)):
                    parts.append(slots)
                size += len(slots)
                if size > GATHERED:
                    yield from _sketch_rows(gathered)
                    gathered, size = [[] for _ in range(DEPTH)], 0
        if size:
            yield from _sketch_rows(gathered)

    def merge(batches):
        counters: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, piece, once, more in zip(*[c.to_pylist() for c in batch.columns]):
                counts = counters.setdefault((row, piece), np.zeros(1 << SLICE_BITS, np.uint8))
                slots = np.frombuffer(once, "<u4")
                counts[slots] = np.minimum(counts[slots] + 1, 2)
                counts[np.frombuffer(more, "<u4")] = 2
        for (row, piece), counts in counters.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array([row], pa.int32()),
                    "slice": pa.array([piece], pa.int32()),
                    "often": [np.packbits(counts > 1, bitorder="little").tobytes()],
                }
            )

    slices = 1 << max(0, bits - SLICE_BITS)
    parts = docs.select("text").mapInArrow(count, "row int, slice int, once binary, more binary")
    parts = parts.repartition(DEPTH * slices, "row", "slice")
    often = np.zeros((DEPTH, 1 << max(0, bits - 3)), np.uint8)
    size = (1 << SLICE_BITS) // 8
    for row in parts.mapInArrow(merge, "row int, slice int, often binary").toLocalIterator():  # at most 32 MB, slice by slice
        piece = np.frombuffer(row["often"], np.uint8)
        room = often[row["row"], row["slice"] * size : (row["slice"] + 1) * size]
        room[:] = piece[: len(room)]
    return often


def _segments(docs: DataFrame, often, bits: int) -> DataFrame:
    """Segments of windows estimated repeated: key, owner, place, and the hashes of their windows.

    The hashes are left out where the same task batch holds the segment in a smaller document.
    """

    def work(batches):
        bitmap = often.value
        for batch in batches:
            for part, data, offsets in text_blocks(batch):
                words, row_words, at, anchors = _windows(data, offsets)
                if not len(at):
                    continue
                passed = np.ones(len(at), bool)
                for row, slots in zip(bitmap, _slots(anchors, bits)):
                    passed &= (row[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
                if not passed.any():
                    continue
                at, anchors = at[passed], anchors[passed]
                windows = gram_hashes(words, WINDOW)[at]
                first = _runs(at, anchors, row_words)
                # Long stretches are cut at fixed distances from their beginning.
                length = np.diff([*first, len(at)])
                cuts = -(-length // SEGMENT)
                inner = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                first = np.repeat(first, cuts) + inner * SEGMENT
                length = np.minimum(SEGMENT, np.repeat(length, cuts) - inner * SEGMENT)
                row = np.searchsorted(row_words, at[first], "right") - 1
                place = at[first] - row_words[row]
                keys = []
                for hashes, base in ((windows, 0x9E6C63D0676A9A99), (mix(windows), 0xCA5A826395121157)):
                    sums = before(hashes * powers(base, len(hashes)))
                    keys.append(mix((sums[first + length] - sums[first]) * powers(inverse(base), len(hashes) + 1)[first]))
                ids = np.asarray(part.column(0).to_numpy(zero_copy_only=False), np.int64)[row]
                # The smallest id of each key in this block.
                order = np.lexsort((ids, keys[1], keys[0]))
                k0, k1 = keys[0][order], keys[1][order]
                lead = np.ones(len(order), bool)
                lead[1:] = (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])
                least = np.empty(len(order), np.int64)
                least[order] = np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))
                full = ids == ids[order][least]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": anchors[first].view(np.int64),
                        "k1": keys[0].view(np.int64),
                        "k2": keys[1].view(np.int64),
                        "n": length.astype(np.int32),
                        "id": ids,
                        "version": part.column(2).take(pa.array(row)),
                        "place": place.astype(np.int32),
                        "hashes": pa.array(
                            [windows[a : a + b].tobytes() if f else None for a, b, f in zip(first.tolist(), length.tolist(), full.tolist())],
                            pa.binary(),
                        ),
                    }
                )

    return docs.mapInArrow(work, "anchor bigint, k1 bigint, k2 bigint, n int, id bigint, version bigint, place int, hashes binary")


def _single(batches):
    """The windows of segments, one row each."""
    for batch in batches:
        anchors, ids, versions, places, hashes = batch.columns
        raw = hashes.to_pylist()
        if not raw:
            continue
        counts = np.array([len(h) // 8 for h in raw])
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        yield pa.RecordBatch.from_pydict(
            {
                "anchor": np.repeat(anchors.to_numpy(), counts),
                "window": np.frombuffer(b"".join(raw), "<i8"),
                "id": np.repeat(ids.to_numpy(), counts),
                "version": np.repeat(versions.to_numpy(), counts),
                "place": (np.repeat(places.to_numpy(), counts) + inner).astype(np.int32),
            }
        )


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stretches of windows that also start in a document with a smaller key: id, version, place, n.

    ``place`` is the first word of the first window, ``n`` the number of neighbouring windows, and
    ``version`` a hash of the text, which tells apart texts that share a key.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("version"))
    rows = rows.where("id is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(16, (COUNTERS_PER_ANCHOR * size // BYTES_PER_ANCHOR).bit_length()))
    often = docs.sparkSession.sparkContext.broadcast(sketch(rows, bits))
    segments = scratch_table(_segments(rows, often, bits), "segments")
    same = ["anchor", "k1", "k2", "n"]
    least = scratch_table(segments.groupBy(*same).agg(F.min("id").alias("least")), "least")
    whole = segments.drop("hashes").join(least, same).where("id > least").select("id", "version", "place", "n")
    # Windows of different segments can only be equal where an anchor has more than one kind of segment.
    varied = least.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor")
    kept = segments.where("hashes is not null").join(varied, "anchor").join(least, same).where("id = least")
    kept = kept.select("anchor", "id", "version", "place", "hashes")
    windows = scratch_table(kept.mapInArrow(_single, "anchor bigint, window bigint, id bigint, version bigint, place int"), "windows")
    window = ["anchor", "window"]
    first = windows.groupBy(*window).agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    single = windows.join(first, window).where("id > least").select("id", "version", "place", F.lit(1).alias("n"))
    return whole.unionByName(single)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_words, n_removed and ``kept``, the words left, joined by one space, for each row.

    Null text has no words. A row with a null key keeps all its words and takes none from others.
    Rows that share a key take nothing from each other, whether equal or not. Other columns are not
    read. An empty table gives no rows.
    """
    spans = repeated_windows(docs, key, text).groupBy("id", "version").agg(F.collect_list(F.struct("place", "n")).alias("spans"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumns({"id": F.col("key").cast("long"), "version": F.xxhash64("text")})
    rows = rows.join(spans, ["id", "version"], "left").select(
        "key", "text", F.col("spans.place").alias("places"), F.col("spans.n").alias("counts")
    )

    def cut(batches):
        for batch in batches:
            for part, _, _ in text_blocks(batch):
                totals, removed, kept = [], [], []
                for body, places, counts in zip(part.column(1).to_pylist(), part.column(2), part.column(3)):
                    words = (body or "").encode().split()
                    totals.append(len(words))
                    if places.is_valid:
                        edge = np.zeros(len(words) + 1, np.int64)
                        at = places.values.to_numpy()
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + counts.values.to_numpy() + WINDOW - 1, -1)
                        left = np.cumsum(edge[:-1]) == 0
                        words = [words[i] for i in np.flatnonzero(left).tolist()]
                    removed.append(totals[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "n_removed", "kept"],
                )

    return rows.mapInArrow(cut, f"key {rows.dtypes[0][1]}, n_words bigint, n_removed bigint, kept string").withColumnRenamed("key", key)
