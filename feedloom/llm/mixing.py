"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Every source gets a target number of words. Within a source, documents are put into at most 64
classes by the length of their size in binary digits, and a class is wanted ``q`` times, where ``q``
rises with the class (longer documents are a little likelier) and never exceeds ``most``. A document
has ``floor(q)`` certain copies; what is left of ``q`` is the inclusion probability ``p`` of one more.
For these a document draws ``u`` from a hash of its id and is ranked by ``(u / (1 - u)) / (p / (1 - p))``:
the documents with the smallest ranks are taken until the words of the source come nearest its target.

The rank that separates taken from left documents is one number per source. It is found from sums
per range block; only the block in which the target is reached is looked at row by row, so a source
with most of the rows is spread over many tasks. Rows that draw alike, by null or repeated ids, are in the
order of their sizes, then of their texts' hash; of those at the border as many are taken as bring the
source nearest its target, numbered over range blocks of their own.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, the
last one; a null id draws like the empty text; of rows that repeat id and text any may be the ones
taken; an empty table gives an empty result; other columns of the input have no influence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import SPACED_WORD, block_starts, ordered_blocks, small_batches, whole_row, within_block
from feedloom.session import staged

DIGITS = 13  # Fixed value: hexadecimal digits of the hash that make the drawn number, 52 bits.


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Text that sorts like the source by code point, null last, and is never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def drawn(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    text = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long")
    return (digits + F.lit(0.5)) / F.lit(float(2 ** (4 * DIGITS)))


def size_class(size: Column) -> Column:
    """Binary digits of the size, 0 for nothing: at most 64 classes."""
    return F.when(size == 0, F.lit(0)).otherwise(F.length(F.bin(size)))


def source_targets(
    sized: DataFrame, weights: Sequence[int], share: float, most: float, label: str
) -> DataFrame:
    """Per source its size and target. Sources above ``most`` times their size stop there and the
    excess is shared anew by weight, until none is above; a round is one small aggregate."""
    sums = sized.groupBy("_src").agg(F.sum("size").alias("source_size"))
    blocks = ordered_blocks(sums.withColumn("_one", F.lit(1)), ["_src"], f"{label}-sources")
    place = F.col("_start") + F.coalesce(F.sum("_one").over(within_block([], ["_src"])), F.lit(0))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = blocks.join(block_starts(blocks, [], "_one"), "_block").select(
        "_src",
        "source_size",
        F.element_at(cycle, (place % len(weights) + 1).cast("int")).alias("_weight"),
        (F.col("source_size") * F.lit(most)).alias("_most"),
    )
    sources = staged(ranked, f"{label}-ranked")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        open_ = F.col("_most") > F.lit(level) * F.col("_weight")
        found = sources.agg(
            F.sum(F.when(open_, 0.0).otherwise(F.col("_most"))).alias("given"),
            F.sum(F.when(open_, F.col("_weight"))).alias("weight"),
            F.count(F.when(~open_, 1)).alias("stopped"),
        ).first()
        if not found["weight"] or found["stopped"] == stopped:
            break
        level, stopped = (total - found["given"]) / found["weight"], found["stopped"]
    return sources.withColumn("target", F.least("_most", F.lit(level) * F.col("_weight")))


def class_rates(sized: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """Per source and class the wanted copies ``_q``: the class number times a level that makes the
    words of the source add up to its target, never above ``most``."""
    classes = sized.where("size > 0").groupBy("_src", "_class").agg(F.sum("size").alias("_words"))
    rows = classes.join(targets, "_src").withColumn("_pull", F.col("_words") * F.col("_class"))
    likeliest = W.partitionBy("_src").orderBy(F.col("_class").desc())
    earlier = likeliest.rowsBetween(W.unboundedPreceding, -1)
    full = W.partitionBy("_src")
    left = F.col("target") - F.lit(most) * F.coalesce(F.sum("_words").over(earlier), F.lit(0))
    pull = F.sum("_pull").over(full) - F.coalesce(F.sum("_pull").over(earlier), F.lit(0))
    # Classes stop at ``most`` from the likeliest down; the first that does not sets the level.
    levels = rows.withColumn("_level", left / pull)
    below = F.when(F.col("_level") * F.col("_class") < F.lit(most), F.struct(-F.col("_class"), F.col("_level")))
    levels = levels.withColumn("_first", F.min(below).over(full)["_level"])
    q = F.coalesce(F.least(F.col("_first") * F.col("_class"), F.lit(most)), F.lit(most))
    rated = levels.withColumn("_q", q).withColumn("_base", F.floor("_q").cast("int"))
    return rated.select(
        "_src", "_class", "_q", "_base", (F.col("_q") - F.col("_base")).alias("_p"),
        (F.col("target") - F.sum(F.col("_base") * F.col("_words")).over(full)).alias("_left"),
    )


def rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds."""
    return (u / (1 - u)) / (p / (1 - p))


def cuts(sized: DataFrame, rates: DataFrame, seed: str, label: str) -> DataFrame:
    """Per source the rank and size at which taking ends, and how many rows of just these are taken.
    Sources of which all is taken have no row."""
    drawing = (
        sized.join(rates.where("_p > 0"), ["_src", "_class"])
        .select("_src", "size", "_left", rank(drawn(F.col("doc_id"), seed), F.col("_p")).alias("_rank"))
        # Rows that tie, by null or repeated ids, are one row with their words: no block holds them all.
        .groupBy("_src", "_rank", "size").agg(F.max("_left").alias("_left"), F.sum("size").alias("_tied"))
    )
    order = ["_rank", "size"]
    blocks = ordered_blocks(drawing, ["_src", *order], f"{label}-ranks")
    starts = block_starts(blocks, ["_src"], "_tied")
    # A document is taken if that brings the source nearer its target: 2 * before + size <= 2 * left.
    # Of documents that tie, the last one has the others before it; if it is refused, some may be.
    # Where a block ends below its source's target, all of it is taken; only the first block that
    # ends above is judged by row. If all of that is taken, its last rank is the border.
    aims = blocks.groupBy("_src").agg(F.max("_left").alias("_aim"))
    crossing = starts.join(aims, "_src").where(F.col("_start") + F.col("_held") > F.col("_aim"))
    first = crossing.groupBy("_src").agg(F.min(F.struct("_block", "_start")).alias("c")).select(
        "_src", F.col("c._block").alias("_block"), F.col("c._start").alias("_start")
    )
    inside = blocks.join(first, ["_src", "_block"])
    before = F.col("_start") + F.coalesce(F.sum("_tied").over(within_block(["_src"], order)), F.lit(0))
    judged = inside.withColumn("_before", before)
    refused = 2 * (F.col("_before") + F.col("_tied")) - F.col("size") > 2 * F.col("_left")
    nearest = F.floor((2 * F.col("_left") - 2 * F.col("_before") + F.col("size")) / (2 * F.col("size"))).cast("long")
    border = lambda take: F.struct(F.col("_rank").alias("r"), F.col("size").alias("s"), take.alias("take"))
    ends = judged.groupBy("_src").agg(
        F.min(F.when(refused, border(F.greatest(nearest, F.lit(0))))).alias("first"),
        F.max(border((F.col("_tied") / F.col("size")).cast("long"))).alias("last"),
    )
    end = F.coalesce("first", "last")
    return ends.select("_src", end["r"].alias("_cut"), end["s"].alias("_cut_size"), end["take"].alias("_take"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    keep: bool = False,
    label: str = "mix",
) -> DataFrame:
    """Decision per row: ``doc_id, size, source_size, target, copies, taken``; with ``keep`` also the
    row itself as the struct ``row``.

    ``weights`` go round over the sources in code point order; ``share`` times all words is dealt
    out; no document is taken more than ``most`` (a whole number) times.
    """
    measured = docs.select(
        F.col(doc_id).alias("doc_id"),
        source_key(F.col(source)).alias("_src"),
        n_words(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_text"),
        *[whole_row(docs)] * keep,
    )
    small_batches(docs.sparkSession)
    rows = measured.withColumn("_class", size_class(F.col("size")))
    sized = staged(rows.drop("row"), f"{label}-sized")
    targets = staged(source_targets(sized, weights, share, most, label), f"{label}-targets")
    rates = staged(class_rates(sized, targets, most), f"{label}-rates")
    cut = staged(cuts(sized, rates, seed, label), f"{label}-cuts")
    known = (rows if keep else sized).join(targets.select("_src", "source_size", "target"), "_src", "left")
    known = known.join(rates, ["_src", "_class"], "left").join(cut, "_src", "left")
    known = known.withColumn("_rank", F.when(F.col("_p") > 0, rank(drawn(F.col("doc_id"), seed), F.col("_p"))))
    at, end = F.struct("_rank", "size"), F.struct("_cut", "_cut_size")
    on_border = F.coalesce((F.col("_rank") == F.col("_cut")) & (F.col("size") == F.col("_cut_size")), F.lit(False))
    more = F.col("_rank").isNotNull() & (F.col("_cut").isNull() | (at < end))
    decided = known.where(~on_border).withColumn("_more", more)
    # Mostly one row per source; however many they are, they are numbered in blocks.
    order = ["_text", "_row"]
    tied = ordered_blocks(known.where(on_border).withColumns({"_row": F.monotonically_increasing_id(), "_one": F.lit(1)}),
                          ["_src", *order], f"{label}-border")
    starts = block_starts(tied, ["_src"], "_one").select("_src", "_block", "_start")
    ended = tied.withColumn("_earlier", F.coalesce(F.sum("_one").over(within_block(["_src"], order)), F.lit(0)))
    ended = ended.join(starts, ["_src", "_block"]).withColumn("_more", F.col("_start") + F.col("_earlier") < F.col("_take"))
    all_ = decided.unionByName(ended.select(*decided.columns))
    copies = F.coalesce(F.col("_base") + F.when(F.col("_more"), 1).otherwise(0), F.lit(0))
    return all_.select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
        *["row"] * keep,
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, columns as they were."""
    decided = mix(docs, keep=True, **options)
    return decided.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
