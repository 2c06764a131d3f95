"""Mixing sources to target weights with a low-discrepancy source schedule.

Every source's documents are laid end to end in a shuffled order and cut into blocks of equal
token counts. The mix is a sequence of slots: slot ``t`` is the ``t``-th golden-ratio point, mapped
through the cumulative slot shares to a source, and the ``k``-th slot of a source takes its
``k``-th block, starting over after the last. A source ends once its target is reached, in the
middle of a block if need be; the few slots that the schedule still owes a source follow at its end.

All windows and joins run by (source, shuffle bucket), (source, chunk of slots) or
(source, block), so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .flat import free_name

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 4096

# Golden-ratio points are multiples of GOLDEN modulo 2**31, so that they stay exact integers.
POINTS = 1 << 31
GOLDEN = 1327217885
# The unit interval is cut into cells to find a point's source by an equi-join.
CELLS = 4096
# Slots that one ranking window holds at most.
CHUNK_SLOTS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_sizes(documents: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, source, size, place, bucket)``; ``place`` is the shuffled order."""
    return documents.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "source",
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
    ).withColumn("bucket", F.substring("place", 1, 3))


def source_targets(totals: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``source_no``, ``weight`` and ``target`` to ``(source, source_size)``.

    Targets share the words of all sources by weight. A target above ``max_repeats`` times its
    source is held there and the excess is shared by the others: ordered by cap per weight, the
    capped sources come first, and the level of the rest follows from running sums. One row per
    source, so its windows are small: one task holds all sources, which is meant for thousands of them.
    """
    everything = Window.partitionBy(F.lit(0))
    numbered = totals.withColumn(
        "source_no", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), "source_no")
    levels = (
        numbered.withColumn("cap", max_repeats * F.col("source_size"))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("before")) / F.col("rest"))
    )
    open_level = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    return levels.withColumn("final", F.max(open_level).over(everything)).select(
        "source",
        "source_no",
        "source_size",
        "weight",
        F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("final") * F.col("weight"))
        .otherwise(F.col("cap"))
        .cast("double")
        .alias("target"),
    )


def _with_blocks(targets: DataFrame, block_words: int) -> DataFrame:
    """Words to take, blocks and slots of every source."""
    size, words = F.col("source_size"), F.col("words")
    some = size > 0
    return (
        targets.withColumn("words", F.floor(F.col("target") + 0.5))
        .withColumn("blocks", F.ceil(size / block_words).cast("long"))
        .withColumn("passes", F.when(some, F.expr("words div source_size")).otherwise(F.lit(0)))
        .withColumn("rest_words", words - F.col("passes") * size)
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest_words") / block_words).cast("long"))
    )


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(source_no, turn, block, words, whole)``: the ``turn``-th slot of the source, the block
    it takes, the words it takes of that block and whether that is all of the block. ``at`` gives
    the order of the mix. ``targets`` has one row per source and should be stored; one task holds these rows."""
    spark = targets.sparkSession
    blocked = _with_blocks(targets, block_words)
    total = blocked.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    running = Window.partitionBy(F.lit(0)).orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    bound = lambda c: F.floor(c.cast("decimal(38,0)") * POINTS / max(total, 1)).cast("long")
    shares = (
        blocked.withColumn("until", F.sum("slots").over(running))
        .withColumn("high", bound(F.col("until")))
        .withColumn("low", bound(F.col("until") - F.col("slots")))
        .where("high > low")
    )
    width = POINTS // CELLS
    cells = shares.select(
        "source_no", "low", "high", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")).alias("cell")
    )
    points = spark.range(total).select(
        F.col("id").alias("at"), ((F.col("id") % POINTS) * GOLDEN % POINTS).alias("point")
    )
    drawn = (
        points.withColumn("cell", F.expr(f"point div {width}"))
        .join(cells, "cell")
        .where("point >= low AND point < high")
        .select("source_no", "at", F.expr(f"at div {CHUNK_SLOTS}").alias("chunk"))
    )
    # A source's turn: its slots in earlier chunks, then its place within the chunk.
    per_chunk = drawn.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    within = Window.partitionBy("source_no", "chunk").orderBy("at")
    ranked = drawn.join(offsets, ["source_no", "chunk"]).select(
        "source_no", "at", (F.col("offset") + F.row_number().over(within) - 1).alias("turn")
    )
    met = per_chunk.groupBy("source_no").agg(F.sum("n").alias("met"))
    owed = (
        blocked.join(met, "source_no", "left")
        .withColumn("met", F.coalesce("met", F.lit(0)))
        .where("met < slots")
        .select("source_no", F.explode(F.expr("sequence(met, slots - 1)")).alias("turn"))
        .select("source_no", (F.lit(total) + F.col("turn")).alias("at"), "turn")
    )
    taking = ranked.unionByName(owed).join(
        blocked.select("source_no", "source_size", "blocks", "slots", "words"), "source_no"
    )
    begin = F.expr(f"(turn div blocks) * source_size + block * {block_words}")
    return (
        taking.where("turn < slots")
        .withColumn("block", F.col("turn") % F.col("blocks"))
        .withColumn("length", F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words))
        .withColumn("taken_words", F.least("length", F.col("words") - begin))
        .select("source_no", "at", "turn", "block", F.col("taken_words").alias("words"), (F.col("taken_words") == F.col("length")).alias("whole"))
    )


def mix_documents(
    documents: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``(doc_id, text_hash, size, source_size, target, taken)``, a row for each row of ``documents``.

    A null text has no words and is never taken; a null source is a source, ordered last. Repeated
    rows are separate documents at neighbouring places. Runs jobs: word counts and slot shares are
    stored, for several steps read them.
    """
    sizes = cut_lineage(document_sizes(documents))
    cells = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    totals = cells.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = cut_lineage(source_targets(totals, weights, max_repeats))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    offsets = offsets.alias("c").join(targets.alias("s"), F.expr("c.source <=> s.source")).select(
        "c.source", "c.bucket", "c.offset", "s.source_no", "s.source_size", "s.target"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size", "text_hash")
    placed = (
        sizes.alias("d")
        .join(offsets.alias("o"), F.expr("d.source <=> o.source AND d.bucket = o.bucket"))
        .select("d.*", "o.offset", "o.source_no", "o.source_size", "o.target")
        .withColumn("before", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("start", F.col("offset") + F.col("before"))
        .select("doc_id", "text_hash", "size", "source_no", "source_size", "target", "start")
    )
    use = schedule(targets, block_words).groupBy("source_no", "block").agg(
        F.count_if("whole").alias("wholes"), F.coalesce(F.max(F.when(~F.col("whole"), F.col("words"))), F.lit(0)).alias("part")
    )
    pieces = placed.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})"))
    )
    begin = F.col("block") * block_words
    low, high = F.greatest(F.col("start"), begin), F.least(F.col("start") + F.col("size"), begin + block_words)
    from_block = (high - low) * F.col("wholes") + F.greatest(F.lit(0), F.least(high, begin + F.col("part")) - low)
    taken = (
        pieces.join(use, ["source_no", "block"], "left")
        .groupBy("source_no", "start", "doc_id", "text_hash", "size", "source_size", "target")
        .agg(F.sum(F.coalesce(from_block, F.lit(0))).cast("long").alias("taken"))
    )
    columns = ("doc_id", "text_hash", "size", "source_size", "target", "taken")
    wordless = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return taken.select(*columns).unionByName(wordless.select(*columns))


def apply_mix(documents: DataFrame, mix: DataFrame) -> DataFrame:
    """``documents`` as the mix takes them: a row for every whole pass over a document. Only the
    document in which a source's last pass ends is taken in part; it is given if at least half is. A null id
    is an id like any other; rows of equal id and text share their passes evenly. Null texts, and others without
    words, are not in the mix."""
    counted = mix.groupBy("doc_id", "text_hash").agg(
        F.sum(F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)) + 0.5)).alias("passes"), F.count("*").alias("rows")
    )
    name = free_name(documents.columns, "pass")
    copies = F.expr("CAST(m.passes div m.rows AS INT)")
    return (
        documents.alias("d")
        .join(counted.where("passes >= rows").alias("m"), F.expr("d.doc_id <=> m.doc_id AND xxhash64(d.text) = m.text_hash"))
        .select("d.*", F.explode(F.array_repeat(F.lit(0), copies)).alias(name))
        .drop(name)
    )
