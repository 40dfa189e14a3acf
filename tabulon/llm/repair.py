"""Repair of conversations: the cheapest edits that give a legal order of roles, by parallel Viterbi.

The rows of a conversation are symbols (first letter of the role, and whether the row has to go or is cut
off). Legal role initials are ``(s?(ua)+)?``, an automaton of four states. A vector holds the least cost
to the end from each state; going backward over a row is a min-plus product with the vector behind it.

A conversation may hold a large share of all rows, so rows are ordered by range partitions and each
partition's share of a conversation is a chunk of its own. Rank convergence makes chunks independent:
every chunk starts at its end from a speculative vector. Then fix-up passes hand each chunk the vector at
the beginning of the chunk behind it; a chunk whose vector differs from the one it used, by more than a
constant, runs again until its vector differs from that of the run before by a constant only, from where
all that lies before stays as it is. Passes end when no vector changes. The costs are then stitched, and
tracing forward takes, among the edits that keep to the least cost, the first letter in ASCII order. An edit
and a state give the next state, so this is the least audit. As a chunk's state at its beginning depends on
the chunks before it, chunks first tell their last state for each of the four, and these are chained.

Texts take no part in this: rows carry a digest of theirs, and meet the text again where it is asked for.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.shared import scratch_table

#: Rows of a range partition, about; a conversation with more is cut.
CHUNK_ROWS = 50_000
SPACES = " \t\n\x0b\x0c\r"
#: Costs by letter, and of keeping a row that is cut off.
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: States: nothing yet, behind the system row, behind a user row, behind an assistant row.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state behind an inserted or rewritten row, and the role that takes.
WRITTEN, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
FAR = 1 << 40
SPECULATIVE = (0, 0, 0, 0)
INITIALS, KINDS = "suax", ("clean", "cut", "gone")
ROWS = "array<struct<at:bigint,symbol:int,n:bigint>>"


def _closed(costs):
    """Costs when rows may be inserted first; a third one would only lead back."""
    return tuple(
        min(costs[q], INSERT + costs[WRITTEN[q]], 2 * INSERT + costs[WRITTEN[WRITTEN[q]]]) for q in range(4)
    )


#: Behind the last row: nothing at all, or an assistant row.
TERMINAL = _closed((0, FAR, FAR, 0))


@lru_cache(1 << 16)
def _costs(behind, symbol):
    """Least cost to the end from each state before a row, as far above ``behind`` as it is."""
    initial, kind = INITIALS[symbol // 3], symbol % 3
    cut, out = CUT if kind == 1 else 0, []
    for q in range(4):
        best = DELETE + behind[q]
        if kind != 2:
            best = min(best, REROLE + cut + behind[WRITTEN[q]])
            if initial in STEP[q]:
                best = min(best, cut + behind[STEP[q][initial]])
        out.append(best)
    return _closed(out)


@lru_cache(1 << 16)
def _before(behind, symbol):
    """The vector before a row, less its smallest entry: vectors that differ by a constant are equal."""
    costs = _costs(behind, symbol)
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(1 << 18)
def _edits(state, symbol, behind):
    """Letters of the least audit for a row and what is inserted before it, cost, state after it, role."""
    costs, letters, paid, inserted = _costs(behind, symbol), "", 0, []
    initial, kind = INITIALS[symbol // 3], symbol % 3
    cut = CUT if kind == 1 else 0
    while True:
        if DELETE + behind[state] == costs[state]:
            return letters + "D", paid + DELETE, state, tuple(inserted), None
        if INSERT + costs[WRITTEN[state]] == costs[state]:
            letters, paid = letters + "I", paid + INSERT
            inserted.append(ROLE[state])
            state = WRITTEN[state]
        elif kind != 2 and initial in STEP[state] and cut + behind[STEP[state][initial]] == costs[state]:
            return letters + "K", paid + cut, STEP[state][initial], tuple(inserted), ""
        else:
            return letters + "R", paid + REROLE + cut, WRITTEN[state], tuple(inserted), ROLE[state]


def _symbols(symbols, counts) -> list[int]:
    """A symbol for every row; copies of a row are duplicates, or blank as it is, and have to go."""
    out = []
    for symbol, n in zip(symbols, counts):
        out.append(symbol)
        if n > 1:
            out.extend([symbol // 3 * 3 + 2] * (n - 1))
    return out


def _vectors(symbols, end):
    """The vector behind every row, last row first, and the one before all."""
    out, vector = [], end
    for symbol in reversed(symbols):
        out.append(vector)
        vector = _before(vector, symbol)
    return out, vector


def _fixed(symbols, old_end, end, old_start):
    """The vector before all rows, for another end than in the run before."""
    old, new = old_end, end
    for symbol in reversed(symbols):
        old, new = _before(old, symbol), _before(new, symbol)
        if old == new:
            return old_start
    return new


def _least(vector):
    return tuple(x - min(vector) for x in vector)


def _chunks(batch):
    """Rows of a batch of chunks as Python numbers: the places ``at`` and a symbol for every row."""
    rows = batch.column("rows")
    offsets, rows = rows.offsets.to_pylist(), rows.values
    at, symbol, n = (rows.field(i).to_pylist() for i in range(3))
    for a, b in zip(offsets, offsets[1:]):
        yield at[a:b], symbol[a:b], n[a:b]


def _text(vector) -> str:
    return ",".join(map(str, vector))


def _vector(text):
    return tuple(map(int, text.split(",")))


def _runs(batches):
    """One pass: chunks that are given another vector run, or run again."""
    for batch in batches:
        starts = []
        names = ("used", "start", "given")
        for (_, symbol, n), used, start, given in zip(_chunks(batch), *(batch.column(c).to_pylist() for c in names)):
            if used is None:
                starts.append(_text(_vectors(_symbols(symbol, n), _vector(given))[1]))
            elif used == given:
                starts.append(start)
            else:
                starts.append(_text(_fixed(_symbols(symbol, n), _vector(used), _vector(given), _vector(start))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("k"), batch.column("chunk"), batch.column("given"), pa.array(starts, pa.string())],
            names=["k", "chunk", "used", "start"],
        )


def _last_states(batches):
    for batch in batches:
        out = []
        for (_, symbol, n), given in zip(_chunks(batch), batch.column("used").to_pylist()):
            symbols = _symbols(symbol, n)
            vectors, states = _vectors(symbols, _vector(given))[0], [0, 1, 2, 3]
            for symbol, behind in zip(symbols, reversed(vectors)):
                states = [_edits(q, symbol, behind)[2] for q in states]
            out.append(states)
        yield pa.RecordBatch.from_arrays(
            [batch.column("k"), batch.column("chunk"), pa.array(out, pa.list_(pa.int32()))], names=["k", "chunk", "states"]
        )


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The first state of each chunk of one conversation: as many rows as range partitions at most."""
    pdf, state, out = pdf.sort_values("chunk"), 0, []
    for states in pdf["states"]:
        out.append(state)
        state = int(states[state])
    return pd.DataFrame({"k": pdf["k"], "chunk": pdf["chunk"], "state": out})


def _traced(batches):
    kind = pa.list_(pa.struct([("place", pa.int64()), ("at", pa.int64()), ("role", pa.string())]))
    for batch in batches:
        audits, costs, rows = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("given", "state", "is_last"))
        for (at, symbol, n), given, state, is_last in zip(_chunks(batch), *columns):
            symbols = _symbols(symbol, n)
            vectors, letters, cost, out = _vectors(symbols, _vector(given))[0], [], 0, []
            owners = (a for a, copies in zip(at, n) for _ in range(copies))
            for a, symbol, behind in zip(owners, symbols, reversed(vectors)):
                edit, paid, state, inserted, role = _edits(state, symbol, behind)
                letters.append(edit)
                cost += paid
                for written in inserted:
                    out.append({"place": len(out), "at": None, "role": written})
                if role is not None:
                    out.append({"place": len(out), "at": a, "role": role or None})
            while is_last and state not in (0, 3):
                letters.append("I")
                cost += INSERT
                out.append({"place": len(out), "at": None, "role": ROLE[state]})
                state = WRITTEN[state]
            audits.append("".join(letters))
            costs.append(cost)
            rows.append(out)
        yield pa.RecordBatch.from_arrays(
            [batch.column("k"), batch.column("chunk"), pa.array(audits, pa.string()), pa.array(costs, pa.int64()), pa.array(rows, kind)],
            names=["k", "chunk", "audit", "cost", "rows"],
        )


def _stitched(many: DataFrame) -> DataFrame:
    """Given vector and first state of every chunk of the conversations that are cut."""
    kind = many.schema["k"].dataType.simpleString()
    order = Window.partitionBy("k").orderBy("chunk")
    own = F.when(F.col("is_last"), F.lit(_text(TERMINAL))).otherwise(F.lit(_text(SPECULATIVE)))
    none = F.lit(None).cast("string")
    passes = many.select("k", "chunk", "rows", none.alias("used"), none.alias("start"), own.alias("given"))
    while True:
        done = scratch_table(passes.mapInArrow(_runs, f"k {kind}, chunk bigint, used string, start string"), "vectors")
        given = F.coalesce(F.lead("start").over(order), F.lit(_text(TERMINAL)))
        state = scratch_table(done.select("*", given.alias("given")), "vectors")
        if state.where("used <> given").isEmpty():
            break
        passes = many.select("k", "chunk", "rows").join(state, ["k", "chunk"])
    last = many.select("k", "chunk", "rows").join(state.select("k", "chunk", "used"), ["k", "chunk"])
    last = last.mapInArrow(_last_states, f"k {kind}, chunk bigint, states array<int>")
    first = last.groupBy("k").applyInPandas(_chained, f"k {kind}, chunk bigint, state int")
    return scratch_table(first.join(state.select("k", "chunk", "given"), ["k", "chunk"]), "stitched")


def _ordered(rows: DataFrame, total: int) -> DataFrame:
    """Distinct rows with their copies counted, in order: ``at`` rises along a conversation."""
    counted = rows.groupBy("k", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(total / CHUNK_ROWS))
    order = [F.col("k").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    placed = counted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return scratch_table(placed.withColumn("at", F.monotonically_increasing_id()), "ordered")


def repair(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Findings and edits of each conversation, and the repaired rows.

    The first table has one row for each key: the key, ``gaps`` (turns missing between the first and the last),
    ``blank``, ``duplicate`` and ``truncated`` rows, ``illegal`` neighbours, ``cost`` and ``audit`` (the edits'
    initials). The second has the rows left: key, ``place`` (chunk, number; rises along the conversation),
    ``edit`` (Keep, Rerole, Insert), role and text.

    Rows go by turn, null turns first; rows of one turn by role, then by a digest of the text. A null
    role or text counts as empty. Rows with a null key are one conversation. Equal rows are duplicates
    whether their turns are equal or not. Texts may be of any length, and conversations too: only the audit of
    one, a letter for each row, is put together in one place. Other columns are not read, so their names
    cannot clash. An empty table gives two empty tables.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    given = turns.select(
        F.struct(F.col(f"`{key}`").alias("key")).alias("k"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.unhex(F.md5(body)).alias("digest"),
        body.alias("text"),
    )
    solid = F.rtrim("text", F.lit(SPACES))
    blank, cut = solid == "", ~F.right(solid, F.lit(1)).isin(".", "!", "?")
    rows = _ordered(given.select("k", "turn", "role", "digest", blank.alias("blank"), (~blank & cut).alias("cut")), turns.count())
    same = ["k", "role", "digest"]
    firsts = rows.groupBy(*same).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1").drop("kinds")
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    initial = F.left("role", F.lit(1))
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = rows.join(firsts, same, "left").withColumn("again", again)
    marked = marked.withColumn("symbol", number * 3 + F.when(F.col("blank") | F.col("again"), 2).when(F.col("cut"), 1).otherwise(0))
    chunk = F.shiftright("at", 33).alias("chunk")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    chunks = marked.groupBy("k", chunk).agg(
        F.sort_array(F.collect_list(F.struct("at", "symbol", "n"))).alias("rows"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - F.when(F.col("again"), 0).otherwise(1)).otherwise(0)).alias("duplicate"),
        one(F.col("symbol") % 3 == 1).alias("truncated"),
    )
    chunks = scratch_table(chunks, "chunks")
    sizes = chunks.groupBy("k").agg(F.count(F.lit(1)).alias("chunks"), F.max("chunk").alias("end")).where("chunks > 1")
    many = chunks.join(sizes, "k").select("k", "chunk", "rows", (F.col("chunk") == F.col("end")).alias("is_last"))
    many = scratch_table(many, "many")
    plan = chunks.select("k", "chunk", "rows")
    if many.isEmpty():
        plan = plan.select("*", F.lit(True).alias("is_last"), F.lit(_text(TERMINAL)).alias("given"), F.lit(0).alias("state"))
    else:
        found = _stitched(many).join(many.select("k", "chunk", "is_last"), ["k", "chunk"])
        plan = plan.join(found, ["k", "chunk"], "left")
        plan = plan.fillna({"is_last": True, "given": _text(TERMINAL), "state": 0})
    kind = chunks.schema["k"].dataType.simpleString()
    edits = "array<struct<place:bigint,at:bigint,role:string>>"
    traced = plan.mapInArrow(_traced, f"k {kind}, chunk bigint, audit string, cost bigint, rows {edits}")
    traced = scratch_table(traced, "traced")
    return _findings(rows, chunks, traced, key), _left(given, rows, traced, key)


def _findings(rows: DataFrame, chunks: DataFrame, traced: DataFrame, key: str) -> DataFrame:
    turns = rows.select("k", "turn").distinct().groupBy("k").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    letter = lambda r: F.substring(F.lit(INITIALS), F.floor(r["symbol"] / 3).cast("int") + 1, F.lit(1))
    wrong = lambda a, b: ~F.concat(a, b).isin("su", "ua", "au")
    rest = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    ends = lambda c: F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))
    bad = lambda a, b: F.size(F.filter(F.zip_with(a, b, wrong), lambda x: x)).cast("long")
    copies = F.aggregate("rows", F.lit(0).cast("long"), lambda t, r: t + r["n"] - 1)
    shape = chunks.withColumn("letters", F.transform("rows", letter)).select(
        "k", "chunk", "blank", "duplicate", "truncated", F.element_at("letters", 1).alias("head"),
        F.element_at("letters", -1).alias("tail"), (copies + bad(ends(F.col("letters")), rest(F.col("letters")))).alias("illegal"),
    )
    parts = F.sort_array(F.collect_list(F.struct("chunk", "head", "tail", "audit")))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    whole = shape.join(traced.drop("rows"), ["k", "chunk"]).groupBy("k").agg(*sums, parts.alias("parts"))
    seams = bad(ends(F.col("parts.tail")), rest(F.col("parts.head")))
    return whole.join(turns, "k").select(
        F.col("k.key").alias(key), "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + seams).alias("illegal"),
        "cost", F.array_join("parts.audit", "").alias("audit"),
    )


def _left(given: DataFrame, rows: DataFrame, traced: DataFrame, key: str) -> DataFrame:
    edits = traced.select("k", "chunk", F.inline("rows"))
    place = F.struct("chunk", "place").alias("place")
    added = edits.where("at is null").select("k", place, F.lit("Insert").alias("edit"), "role", F.lit("").alias("text"))
    # Equal rows are one row here, so each meets its text once.
    line = F.struct("k", "turn", "role", "digest").alias("line")
    texts = given.groupBy(line).agg(F.first("text").alias("text"))
    kept = edits.where("at is not null").withColumnRenamed("role", "written").drop("k")
    kept = kept.join(rows.select("at", line, "k", "role"), "at").join(texts, "line")
    edit = F.when(F.col("written").isNull(), "Keep").otherwise("Rerole").alias("edit")
    kept = kept.select("k", place, edit, F.coalesce("written", "role").alias("role"), "text")
    return added.unionByName(kept).select(F.col("k.key").alias(key), "place", "edit", "role", "text")


def joined_digests(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """sha256 of each conversation's ``role:text`` lines in order, joined by line feeds: key, ``digest``.

    The digest of a conversation is one sequence, so one task goes over it, row by row in sorted order.
    """
    lines = rows.select(F.struct(F.col(key).alias("key")).alias("k"), "place", F.concat("role", F.lit(":"), "text").alias("line"))
    kind = lines.schema["k"].dataType.simpleString()

    def digest(batches):
        now, sha, started = None, None, False
        for batch in batches:
            ends, done = [], []
            for k, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if not started or k != now:
                    if started:
                        ends.append(now)
                        done.append(sha.hexdigest())
                    now, sha, started = k, hashlib.sha256(line.encode()), True
                else:
                    sha.update(b"\n")
                    sha.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ends, batch.schema.field(0).type), pa.array(done, pa.string())], names=["k", "digest"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([sha.hexdigest()])], names=["k", "digest"])

    out = lines.repartition("k").sortWithinPartitions("k", "place").mapInArrow(digest, f"k {kind}, digest string")
    return out.select(F.col("k.key").alias(key), "digest")
