"""Benchmark decontamination by template windows, with DataFrame functions only.

A text becomes a row of typed tokens: numbers, units after a number and capitalised words
turn into placeholders, every other word is lowered and stripped of punctuation. A word's type hangs on
the word alone, so the same words have the same tokens wherever they stand; the first word of a
sentence of an item is read both ways, as a name and as the lowered word. Windows of
eight tokens of all items, as templates and as lowered words, are hash-joined with all windows of the documents.
So any run of eight equal words is found, in upper or lower case, and any of eight equal template
tokens with four words or more. Slots are read only in documents that hold such a hash. A hit carries the words in
its placeholders; an item
counts as re-parameterised only where each word in its slots is replaced by one word throughout. That is
judged for each occurrence, a stretch no longer than the item on both sides, and the best of them counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.shared import broadcast_if_small, checkpoint, once, without

WINDOW = 8
#: Windows of the benchmark up to which they are sent to all executors (24 bytes each and slots).
BROADCAST_WINDOWS = 500_000
#: Share of an item's template tokens that must be found in a document.
COVERED = 0.5
#: Tokens of a template window that must be words, not placeholders.
LITERALS = 4
NUMBER, NAME, UNIT, START = "", "", "", ""

#: Units of measure and currency that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml l s ms min h hr hrs sec secs second seconds minute minutes hour hours "
    "day days week weeks month months year years percent % k c f j kj w kw v a hz khz mhz ghz kb mb gb tb "
    "usd eur gbp dollar dollars euro euros cent cents meter meters metre metres mile miles gram grams litre litres"
).split()


def _bare(text: Column, starts: bool) -> Column:
    """The text without punctuation at the ends of words; with ``starts`` the first word of each sentence carries a mark."""
    marked = F.regexp_replace(text, "(^|[.!?:][\\s\"')]+|\\n)", f"$1{START}") if starts else text
    front = F.regexp_replace(marked, f"(^|[\\s{START}])[^\\p{{L}}\\p{{N}}%\\s{START}]+", "$1")
    return F.regexp_replace(front, "[^\\p{L}\\p{N}%\\s]+(\\s|$)", "$1")


def _split(text: Column) -> Column:
    return F.array_remove(F.array_remove(F.split(text, "\\s+"), ""), START)


def _token(word: Column, low: Column, before: Column, starts: bool) -> Column:
    """The template token of a word, given it in lower case and the word before it (null for the first)."""
    first, second = F.substring(word, 1, 1), F.substring(word, 2, 1)
    digit = lambda c: (c >= "0") & (c < ":")  # noqa: E731  # of what begins with one
    number, unmarked = digit(word), lambda c: c
    if starts:
        number, unmarked = number | ((first == START) & digit(second)), lambda c: F.ltrim(c, F.lit(START))
    kind = F.when(number, NUMBER).when(low.isin(UNITS) & digit(unmarked(before)), UNIT)
    if starts:
        kind = kind.when(first == START, F.substring(low, 2, 1 << 30))
    # Most words are in lower case: comparing them whole leaves the rest of the test out.
    return kind.when((word != low) & (first != F.substring(low, 1, 1)) & (second != "") & (second != F.upper(second)), NAME).otherwise(low)


def _tokens(table: DataFrame, key: str, text: str, starts: bool) -> DataFrame:
    """``key``, ``version``, and the lowered words and template tokens of each text."""
    name = ["key", "version"]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    step = once(table, [F.col(f"`{key}`").alias("key"), F.xxhash64(f"`{text}`").alias("version")], bare=_bare(body, starts))
    step = once(step, name, words=_split(F.col("bare")), low=_split(F.lower("bare")))
    tokens = F.transform("words", lambda w, i: _token(w, F.get("low", i), F.get("words", i - 1), starts))
    low = F.transform("low", lambda w: F.ltrim(w, F.lit(START))) if starts else F.col("low")
    return once(step, name, tokens=tokens, low=low)


def _window_hash(values: str, place: Column, width: int | Column, exact: bool) -> Column:
    part = F.slice(values, place + 1, width)
    return F.xxhash64(F.lit("words"), part) if exact else F.xxhash64(part)


def window_hashes(table: DataFrame, key: str, widths: dict[bool, Sequence[int]], text: str = "text") -> DataFrame:
    """``key`` and the hash of every window of the given widths: of words (True), and of template tokens (False)."""
    step = _tokens(table, key, text, False)
    step = once(step, ["key"], words=F.transform("low", lambda w: F.xxhash64(w)), hashes=F.transform("tokens", lambda t: F.xxhash64(t)))
    sought = [(exact, values, w) for exact, values in ((True, "words"), (False, "hashes")) for w in widths[exact]]
    least, p = min(w for _, _, w in sought), F.col("p")
    places = F.when(F.size("words") >= least, F.sequence(F.lit(0), F.size("words") - least))
    step = step.select("key", "words", "hashes", F.explode(places).alias("p"))

    def window(exact: bool, values: str, width: int) -> Column:
        # The hash of a slice, written out: so it runs as generated code, which a lambda does not.
        h = F.xxhash64(*[F.lit("words")] * exact, *[F.get(values, p + k) for k in range(width)])
        return h if width == least else F.when(p + width <= F.size(values), h)

    return step.select("key", F.explode(F.array(*[window(*w) for w in sought])).alias("h")).where("h is not null")


def template_windows(
    table: DataFrame, key: str, text: str = "text", widths: dict[bool, Sequence[int]] | None = None, starts: bool = False
) -> DataFrame:
    """Windows of every text: ``key``, ``version``, ``place``, ``width``, ``exact``, ``n_tokens``, their hash, and the filled slots.

    ``version`` is a hash of the text, which tells apart texts that share a key.

    A text shorter than a window is one window; null text has none. Every window is there twice: as template
    and, ``exact``, as its lowered words. With ``widths`` there are exact windows (True) and template windows
    (False) of each width given, where the text is long enough. With ``starts`` the first word of a sentence is no name.
    Windows are built inside the row, so the words of a text are not copied for each of them.
    """
    name = ["key", "version"]
    step = _tokens(table, key, text, starts)
    slot = lambda t: t.isin(NUMBER, NAME, UNIT)
    filled = F.transform("tokens", lambda t, i: F.when(slot(t), F.struct(t.alias("kind"), F.get("low", i).alias("word"))))
    step = once(
        step, name, n_tokens=F.size("tokens"), words=F.transform("low", lambda w: F.xxhash64(w)), hashes=F.transform("tokens", lambda t: F.xxhash64(t)),
        filled=F.when(F.exists("tokens", slot), filled),
    )
    inside = lambda p, width: F.when(F.col("filled").isNotNull(), F.filter(F.slice("filled", p + 1, width), lambda z: z.isNotNull()))

    def of_width(width: Column, exact: bool) -> Column:
        last = F.greatest(F.col("n_tokens") - width, F.lit(0))
        h = lambda p: _window_hash("words" if exact else "hashes", p, width, exact).alias("h")
        window = lambda p: F.struct(p.alias("place"), width.alias("width"), F.lit(exact).alias("exact"), h(p), inside(p, width).alias("slots"))
        return F.when((F.col("n_tokens") >= width) & (width > 0), F.transform(F.sequence(F.lit(0), last), window))

    if widths is None:
        width = F.least("n_tokens", F.lit(WINDOW))
        of_each = [of_width(width, False), of_width(width, True)]
    else:
        of_each = [of_width(F.lit(w), exact) for exact in (False, True) for w in widths[exact]]
    windows = of_each[0] if len(of_each) == 1 else F.flatten(F.array_compact(F.array(*of_each)))
    step = step.select(*name, "n_tokens", F.inline_outer(windows)).where("place is not null")
    return step.select(*name, "place", "width", "exact", "n_tokens", "h", F.when(F.size("slots") > 0, F.col("slots")).alias("slots"))


def _occurrences(hits: DataFrame) -> DataFrame:
    """Places of an item found, for each of its occurrences: doc, item, n_tokens, places, and those with equal words.

    Windows of one document text with one ``shift`` (place in the document less place in the item) are an
    occurrence, unless a word of the item stands for two words in it. Words left out or put in move the rest of
    an item to another shift, so each occurrence also takes the windows less than an item away that agree
    with it. Where two of those disagree, equal words go first, then the nearest window. Windows of equal words
    agree with all.
    """
    pair, one = ["doc", "item", "n_tokens"], ["doc", "item", "n_tokens", "version", "shift"]
    filled = hits.select(*one, F.explode("slots").alias("s")).select(*one, "s.*").distinct()
    torn = filled.groupBy(*one).agg((F.count(F.lit(1)) > F.count_distinct("given")).alias("torn")).where("torn")
    alone = checkpoint(hits.select(*one).distinct().join(torn, one, "left_anti"))
    # Shifts less than an item apart lie in the same or in neighbouring stretches of that length.
    stretch = F.floor(F.col("shift") / F.col("n_tokens"))
    reach = F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch")
    starts = alone.select(*pair, "version", F.col("shift").alias("start"), reach)
    sound = hits.join(alone, one, "left_semi").withColumn("stretch", stretch)
    near = sound.join(starts, [*pair, "version", "stretch"]).where(F.abs(F.col("shift") - F.col("start")) < F.col("n_tokens"))
    window = [*pair, "version", "start", "shift", "item_place", "width", "exact"]
    near = near.select(*window, F.explode_outer("slots").alias("s")).select(*window, "s.*")
    rank = F.when(F.col("shift") == F.col("start"), 0).when(F.col("given") == F.col("put"), 1).otherwise(2)
    first = F.struct(rank.alias("rank"), F.abs(F.col("shift") - F.col("start")).alias("gap"), "shift", "put")
    chosen = F.min(F.when(F.col("given").isNotNull(), first)).over(Window.partitionBy(*pair, "version", "start", "given"))
    near = near.withColumn("chosen", chosen["put"]).groupBy(*window).agg(
        F.every(F.coalesce(F.col("put") == F.col("chosen"), F.lit(True))).alias("agrees"),
        F.every(F.coalesce(F.col("put") == F.col("given"), F.lit(True))).alias("same"),
    )
    spread = F.explode(F.sequence(F.col("item_place"), F.col("item_place") + F.col("width") - 1))
    near = near.where("agrees").select(*pair, "version", "start", "same", spread.alias("p"))
    same = F.collect_set(F.when(F.col("same"), F.col("p")))
    return near.groupBy(*pair, "version", "start").agg(F.size(F.collect_set("p")).alias("places"), F.size(same).alias("same"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", covered: float = COVERED
) -> DataFrame:
    """One row for each document and item it holds: keys, covered, exact.

    ``covered`` is the share of the item's tokens inside matching windows of one occurrence, at least the
    parameter; ``exact`` says that an occurrence holds the whole item word for word, in upper or lower case. Windows
    with slots count only if, within an occurrence, each word of the item always stands for the same word; of
    several occurrences the best counts. An item under eight words is found where just these words (or, with four
    words besides its placeholders, this template) follow each other. Null texts, texts without words and rows with
    a null key match nothing; texts of any length are read whole;
    repeated rows count once; equal items are each reported; empty tables give no rows. Other columns are not
    read, so their names cannot clash.
    """
    items = template_windows(benchmark, item_key).unionByName(template_windows(benchmark, item_key, starts=True)).where("key is not null")
    # A template without slots is its words, and one of placeholders says too little: both are looked for by their words.
    slots = F.coalesce(F.size("slots"), F.lit(0))
    items = items.where(F.col("exact") | ((slots > 0) & (F.col("width") - slots >= LITERALS)))
    given = F.when(~F.col("exact"), F.col("slots")).alias("item_slots")
    items = checkpoint(items.select("h", "width", "exact", F.col("key").alias("item"), F.col("place").alias("item_place"), "n_tokens", given).distinct())
    widths = items.select("exact", "width").distinct().collect()  # sixteen rows at most
    widths = {exact: sorted(r["width"] for r in widths if r["exact"] == exact) for exact in (False, True)}
    if not any(widths.values()):
        widths[True] = [WINDOW]
    total, window = items.count(), ["h", "width", "exact"]
    rows = docs.select(F.col(f"`{doc_key}`").alias("key"), "text").where("key is not null")
    # Hashes alone first: slots are worked out for the documents that hold one of them.
    sought = broadcast_if_small(items.select("h").distinct(), total, BROADCAST_WINDOWS)
    holding = checkpoint(window_hashes(rows, "key", widths).join(sought, "h", "left_semi").select("key").distinct())
    rows = rows.join(broadcast_if_small(holding, holding.count()), "key", "left_semi")
    found = template_windows(rows, "key", widths=widths)
    found = found.select("h", "width", "exact", F.col("key").alias("doc"), "version", F.col("place").alias("doc_place"), "slots")
    hits = found.join(broadcast_if_small(items, total, BROADCAST_WINDOWS), window)
    filled = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("given"), b.alias("put")))
    hits = hits.select(
        "doc", "item", "n_tokens", "version", (F.col("doc_place") - F.col("item_place")).alias("shift"), "item_place", "width", "exact",
        F.when(~F.col("exact"), filled).alias("slots"),
    )
    found = _occurrences(checkpoint(hits.distinct()))
    found = found.select("doc", "item", (F.col("places") / F.col("n_tokens")).alias("covered"), (F.col("same") == F.col("n_tokens")).alias("same"))
    best = found.where(F.col("covered") >= covered).groupBy("doc", "item").agg(F.max("covered").alias("covered"), F.some("same").alias("exact"))
    return best.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), F.round("covered", 6).alias("covered"), "exact")


def clean(docs: DataFrame, benchmark: DataFrame, doc_key: str = "doc_id") -> DataFrame:
    """The documents without any item, with the columns of the input; rows without a key stay."""
    return without(docs, doc_key, contaminated(docs, benchmark, doc_key).select(doc_key))
