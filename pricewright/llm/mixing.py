"""Mixing sources to target weights, block by block.

The words of each source are packed, document after document in a hashed order,
into blocks of a fixed length. Every source gets a number of slots that meets
its target, and deals them to the output shards at random: its counts over the
shards are multinomial, and so are a shard's over the sources, given the totals.
A shard's slots of a source follow those of the shards before it, run through
the source's blocks in a pseudorandom permutation of block numbers (swap-or-not,
computed per number), and are joined with the blocks by number. Only DataFrame
functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, attach, shielded, stored, text_or_empty

BLOCK_WORDS = 128
SLOTS_PER_SHARD = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
SEED = 20240
_ROUNDS = 24
_RUN = 4096


def permuted(x: Column, n: Column, key: Column, inverse: bool = False) -> Column:
    """Place of ``x`` in a pseudorandom permutation of 0 .. n-1 that depends on ``key``."""
    order = range(_ROUNDS - 1, -1, -1) if inverse else range(_ROUNDS)

    def swap(at, r):
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), key, r), n) - at, n)
        coin = F.xxhash64(F.lit(SEED + 1), key, r, F.greatest(at, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(coin, partner).otherwise(at)

    return F.aggregate(F.array(*[F.lit(r) for r in order]), x.cast("long"), swap)


@dataclass
class Mix:
    """``docs``: rid, doc_id, sid, size, start (first word's place in its source);
    ``sources``: sid, source, source_size, target, n_blocks, n_slots, words;
    ``draw``: shard, sid, n (slots drawn), begin (slots of the shards before);
    ``slots``: shard, sid, slot, block, length (words taken from the block's start)."""

    docs: DataFrame
    sources: DataFrame
    draw: DataFrame
    slots: DataFrame

    def pieces(self) -> DataFrame:
        """rid, block, lo, hi, first: the part [lo, hi) of a block that is the
        document's words from number ``first`` on."""
        rows = self.docs.where("size > 0")
        last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS)
        rows = rows.select("rid", "sid", "start", "size", F.explode(
            F.sequence(F.floor(F.col("start") / BLOCK_WORDS), last)).alias("block"))
        base = F.col("block") * BLOCK_WORDS
        begin = F.greatest("start", base)
        end = F.least(F.col("start") + F.col("size"), base + BLOCK_WORDS)
        return rows.select(
            "rid", "sid", "block", (begin - base).alias("lo"), (end - base).alias("hi"), (begin - F.col("start")).alias("first"))

    def taken(self) -> DataFrame:
        """rid, first, length, times, cut: how often a document's stretch is
        taken whole, and how many of its first words once more."""
        whole = F.col("length") == BLOCK_WORDS
        blocks = self.slots.groupBy("sid", "block").agg(
            F.sum(whole.cast("long")).alias("times"),
            F.coalesce(F.max(F.when(~whole, F.col("length"))), F.lit(0)).alias("part"))
        # both sides grow with the corpus; the size of exploded slots is not known to the optimizer
        rows = self.pieces().join(blocks.hint("merge"), ["sid", "block"])
        length = F.col("hi") - F.col("lo")
        cut = F.greatest(F.lit(0), F.least("hi", "part") - F.col("lo"))
        return rows.select("rid", "first", length.alias("length"), "times", cut.alias("cut"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_REPEATS) -> DataFrame:
    """Add sid, weight and target to rows of source, source_size.

    Sources in order of their code points, null last, get the weights in turn.
    Targets share ``share`` of all words by weight, at most ``most`` times a
    source's size; what is above is shared again until nothing is. Each round
    brings three numbers to the driver.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("sid", rank.cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    rows = stored(rows.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * float(most)
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = cap <= level * F.col("weight")
        used, open_weight, n = rows.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight"))), F.sum(full.cast("long"))).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - (used or 0.0)) / open_weight
    target = F.least(cap, F.lit(level) * F.col("weight")) if open_weight else cap
    return rows.withColumn("target", target)


def plan_mix(docs: DataFrame, slots_per_shard: int = SLOTS_PER_SHARD) -> Mix:
    """Lay out all documents and slots; ``docs`` has rid (unique), doc_id, source, text."""
    text = text_or_empty()
    rows = docs.select(
        "rid", "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text, F.lit(SEED)).alias("th"))
    # documents in an order that does not depend on how the table is cut
    order = [F.xxhash64("doc_id", F.lit(SEED)).alias("o"), "doc_id", "th", "rid"]
    rows = rows.select("source", "size", *order)
    rows = rows.repartitionByRange("source", "o", "doc_id", "th", "rid").withColumn("part", F.spark_partition_id())
    rows = stored(rows, "mix-documents")
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    sources = source_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")))
    parts = stored(parts.join(
        sources.select(F.col("source").alias("_s"), "sid"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-parts")
    inside = Window.partitionBy("part", "source").orderBy("o", "doc_id", "th", "rid")
    local = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.withColumn("local", local).join(
        parts.select(F.col("source").alias("_s"), F.col("part").alias("_p"), "before", "sid"),
        (F.col("part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
    placed = stored(placed.select("rid", "doc_id", "sid", "size", (F.col("local") + F.col("before")).alias("start")), "mix-places")

    # slots per source: whole rounds through its blocks, then a part of one
    s = sources.withColumns({
        "n_blocks": F.ceil(F.col("source_size") / BLOCK_WORDS), "words": F.round("target").cast("long")})
    size = F.greatest("source_size", F.lit(1))
    s = s.withColumn("rounds", F.floor(F.col("words") / size)).withColumn("rest", F.col("words") - F.col("rounds") * size)
    short = F.col("source_size") - (F.col("n_blocks") - 1) * BLOCK_WORDS       # length of the last block
    s = s.withColumn("short", short).withColumn("short_at", F.when(F.col("n_blocks") > 0, permuted(
        F.col("n_blocks") - 1, F.greatest("n_blocks", F.lit(1)), F.col("sid"), inverse=True)))
    early = F.col("rest") <= F.col("short_at") * BLOCK_WORDS
    more = F.when(early, F.ceil(F.col("rest") / BLOCK_WORDS)).otherwise(
        F.ceil((F.col("rest") + BLOCK_WORDS - F.col("short")) / BLOCK_WORDS))
    s = s.withColumn("more", more).withColumn("n_slots", F.col("rounds") * F.col("n_blocks") + F.col("more"))
    s = stored(s, "mix-sources")
    n_slots = s.agg(F.sum("n_slots")).first()[0] or 0
    shards = max(1, -(-n_slots // slots_per_shard))

    # the draw: one shard per slot, counted per source and shard
    runs = s.where("n_slots > 0").select("sid", "n_slots", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / _RUN))).alias("run"))
    # a stated number of partitions, as small rows here become many slots
    n_parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_slots >> 16)
    tries = runs.repartition(n_parts, "sid", "run").select("sid", F.explode(F.sequence(
        F.col("run") * _RUN, F.least((F.col("run") + 1) * _RUN, F.col("n_slots")) - 1)).alias("nth"))
    shard = F.pmod(F.xxhash64(F.lit(SEED + 2), "sid", "nth"), F.lit(shards))
    draw = tries.groupBy("sid", shard.alias("shard")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    draw = stored(draw.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "mix-draw")

    held = s.withColumn("held", F.least("n_slots", F.lit(shards)))
    drawn = attach(draw, held, ["sid"], "held", held.agg(F.sum("held")).first()[0] or 0)
    slots = drawn.repartition(n_parts, "sid", "shard").withColumn(
        "slot", F.explode(F.sequence("begin", F.col("begin") + F.col("n") - 1)))
    at = F.col("slot") % F.col("n_blocks")
    slots = slots.withColumn("at", at).withColumn("block", permuted(F.col("at"), F.col("n_blocks"), F.col("sid")))
    full = F.when(F.col("block") == F.col("n_blocks") - 1, F.col("short")).otherwise(F.lit(BLOCK_WORDS))
    # the last slot is cut to what the target still needs
    done = F.col("at") * BLOCK_WORDS - F.when(F.col("at") > F.col("short_at"), BLOCK_WORDS - F.col("short")).otherwise(0)
    last = (F.col("slot") == F.col("n_slots") - 1) & (F.col("more") > 0)
    taken = F.when(last, F.least(F.col("rest") - done, full)).otherwise(full)
    # a whole block counts as one of full length, also where it is the short last one
    taken = F.when(taken == full, F.lit(BLOCK_WORDS)).otherwise(taken)
    slots = slots.select("shard", "sid", "slot", "block", taken.cast("long").alias("length"))
    return Mix(placed, s.select("sid", "source", "source_size", "target", "n_blocks", "n_slots", "words"), draw, slots)


def mix_counts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Null sources are one source, after all others; null texts have no words.
    Null and repeated ids are rows of their own. Other columns are ignored.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    mix = plan_mix(rows)
    taken = mix.taken().groupBy("rid").agg(
        F.sum(F.col("length") * F.col("times") + F.col("cut")).alias("taken"))
    out = mix.docs.join(taken, "rid", "left")
    out = stored(out, "mix-taken")
    held = out.groupBy("sid").agg(F.count("*").alias("held"))
    sources = stored(mix.sources.join(held, "sid"), "mix-sources")
    return attach(out, sources, ["sid"], "held", out.count()).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_blocks(docs: DataFrame, slots_per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The mix as it is dealt: one row per slot with shard, source, slot, n_words, text.

    ``text`` holds the words of the slot's block joined by one space: 128, fewer
    where a source ends or meets its target. Nulls and repeated ids are treated
    as in ``mix_counts``.
    """
    base = stored(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        "source", F.col("text").cast("string").alias("text")), "mix-input")
    mix = plan_mix(base, slots_per_shard)
    places = mix.docs.where("size > 0").select("rid", "sid", "start", "size")
    words = F.regexp_extract_all(text_or_empty(), F.lit(WORD), F.lit(0))
    rows = base.join(places, "rid").select("sid", "start", "size", words.alias("w"))

    def piece(block):
        lo = F.greatest(F.col("start"), block * BLOCK_WORDS)
        hi = F.least(F.col("start") + F.col("size"), (block + 1) * BLOCK_WORDS)
        part = F.slice("w", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int"))
        return F.struct(block.alias("block"), lo.alias("lo"), part.alias("words"))

    numbers = F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS))
    pieces = rows.select("sid", F.explode(F.transform(numbers, piece)).alias("p"))
    blocks = pieces.groupBy("sid", F.col("p.block").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("p.lo", "p.words"))).alias("parts"))
    blocks = blocks.select("sid", "block", F.flatten("parts.words").alias("words"))
    # both sides grow with the corpus
    out = mix.slots.join(blocks.hint("merge"), ["sid", "block"])
    out = out.withColumn("words", F.slice("words", F.lit(1), F.col("length").cast("int")))
    sources = mix.sources.select("sid", "source", "n_slots")
    out = stored(out.select("shard", "sid", "slot", F.size("words").alias("n_words"), F.array_join("words", " ").alias("text")), "mix-blocks")
    return attach(out, sources, ["sid"], "n_slots", out.count()).select("shard", "source", "slot", "n_words", "text")


@shielded("_rid", "_turn", "_pieces", "_words", "first", "times", "cut", "length", "p")
def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    A row per document and pass: the first holds the stretches taken at least
    once, the second those taken twice, each in the document's order with its
    own white space. Documents of which nothing is taken are absent. n_chars,
    where there is one, is that of the new text.
    """
    names = docs.columns
    base = stored(docs.withColumn("_rid", F.monotonically_increasing_id()), "mix-input")
    mix = plan_mix(base.select(F.col("_rid").alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "source", "text"))
    # a stretch taken t times whole and its first words once more: one interval per pass
    rows = mix.taken().where("times > 0 OR cut > 0")
    passes = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("times") + F.when(F.col("cut") > 0, 1).otherwise(0)),
        lambda c: F.struct(c.alias("turn"), F.when(c <= F.col("times"), F.col("length")).otherwise(F.col("cut")).alias("n")))
    rows = rows.select(F.col("rid").alias("_rid"), "first", F.explode(passes).alias("p"))
    rows = rows.groupBy("_rid", F.col("p.turn").alias("_turn")).agg(
        F.array_sort(F.collect_list(F.struct("first", F.col("p.n").alias("n")))).alias("_pieces"))
    out = base.join(rows, "_rid")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    out = out.withColumn("_words", words)
    total = F.aggregate("_pieces", F.lit(0).cast("long"), lambda a, p: a + p["n"])
    parts = F.transform("_pieces", lambda p: F.array_join(
        F.slice("_words", (p["first"] + 1).cast("int"), p["n"].cast("int")), ""))
    text = F.when(total == F.size("_words"), F.col("text")).otherwise(F.array_join(parts, ""))
    out = out.withColumn("text", text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
