"""Mix sources to target weights by Pareto order sampling.

Sources get shares of the total size by weight, at most ``MAX_COPIES`` times what they have;
the excess is shared out again by weight. Within a source every document gets an expected
number of copies that grows with the number of binary digits of its size (long documents are
drawn with better odds) and is scaled so that the source's expected words are its target.
The whole part of that number is taken for certain. The rest is drawn: documents are ranked by
their random odds divided by their inclusion odds, and the ranking is followed until the words
still missing are taken, to the nearest document. The sample size, in words, is thus fixed.

Where the ranking of a source is cut is found by histograms: words per rank cell, the cell in
which the missing words run out, the same again within that cell, and an order of the few rows
left. No task orders a source, however large. The random number is a hash of identifier
and size, so reruns agree.

Rows: a null text has size 0. Documents of size 0 are returned and take nothing. A null source
is a source of its own, the last one. Rows equal in identifier, source and size are drawn
together. An empty table gives no rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import shield, without, word_count
from colloquy.operators.keyed_join import attach_by_key
from colloquy.staging import stage

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
# Relative expected copies of a document whose size has b binary digits: b + BASE_ODDS.
BASE_ODDS = 8
CELLS = 256


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``docs`` without its text, with ``size``, ``source_size``, ``target`` (of its source),
    ``copies`` and ``taken`` = copies x size. Columns of ``docs`` called so are replaced."""
    docs, restore = shield(docs, [key, source, text], ["size", "source_size", "target", "copies", "taken"])
    own = without(docs, [text])
    # A name for each source that is never null, for joins.
    name = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    sized = stage(docs.select(*own, word_count(F.col(text)).alias("size"), name.alias("_source")), "sizes")

    plan = stage(source_plan(sized, weights), "mix-plan")
    known = attach_by_key(sized, plan, "_source", "_rows", spread_by=(key, "size"))
    whole = F.floor(_expected("_scale", _digits("size")))
    chance = _expected("_scale", _digits("size")) - whole
    ranked = known.select(
        *own, "size", "source_size", "target", "_source", "_rows", "_missing",
        F.when(F.col("size") > 0, whole).otherwise(0).alias("_whole"),
        F.when((F.col("size") > 0) & (chance > 0), _rank(_random(key, "size"), chance)).alias("_rank"),
    )
    ranked = stage(ranked, "mix-ranks")

    cuts = stage(_cuts(ranked, plan.select("_source", "_rows", "_missing"), key), "mix-cuts")
    cell, fine = _cell("_rank"), _fine("_rank")
    place = F.struct("_rank", F.col(key).alias("_key"), F.col("size").alias("_size"))
    drawn = (
        F.col("_cell").isNull()
        | (cell < F.col("_cell"))
        | ((cell == F.col("_cell")) & (fine < F.col("_fine")))
        | ((cell == F.col("_cell")) & (fine == F.col("_fine")) & (place <= F.col("_last")))
    )
    drawn = F.col("_rank").isNotNull() & F.coalesce(drawn, F.lit(False))
    copies = (F.col("_whole") + drawn.cast("long")).cast("long")
    cut = attach_by_key(ranked.drop("_rows", "_missing"), cuts, "_source", "_rows", spread_by=(key, "size"))
    return restore(cut.select(*own, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")))


def source_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """One row per source: ``source_size``, ``target``, the scale of its expected copies and the
    words its draw must yield. The windows run over one row per source, and one per source
    and number of digits: configuration-sized, whatever the documents."""
    bands = sized.groupBy("_source", _digits("size").alias("_digits")).agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_n"))
    totals = bands.groupBy("_source").agg(F.sum("_words").alias("source_size"), F.sum("_n").alias("_rows"))

    # Code points in order, the source without a name last.
    by_name = Window.orderBy(F.col("_source") == "", "_source")
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn)
    cap = F.col("source_size") * MAX_COPIES
    # Sources reach their cap in the order of cap / weight; what the ones before leave is shared by the rest.
    rising = Window.orderBy(F.col("_cap") / F.col("_weight"), "_source").rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    shares = (
        totals.withColumn("_weight", weight)
        .withColumn("_cap", cap)
        .withColumn("_words_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(rising), F.lit(0)))
        .withColumn("_weight_left", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(rising), F.lit(0)))
        .withColumn("_full", F.col("_cap").cast("decimal(19,0)") * F.col("_weight_left").cast("decimal(19,0)") <= F.col("_weight").cast("decimal(19,0)") * F.col("_words_left").cast("decimal(19,0)"))
        .withColumn("_free_words", F.sum("source_size").over(everything) - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0)))
        .withColumn("_free_weight", F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything))
    )
    shared = (F.col("_weight") * F.col("_free_words")).cast("double") / F.col("_free_weight").cast("double")
    targets = shares.select("_source", "_rows", "source_size", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(shared).alias("target"))

    # The same within a source: the largest expected numbers of copies reach the cap first.
    falling = Window.partitionBy("_source").orderBy(F.desc("_digits"))
    before = falling.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("_source").orderBy("_digits").rowsBetween(Window.unboundedPreceding, 0)
    odds = F.col("_words") * (F.col("_digits") + BASE_ODDS)
    scaled = (
        bands.filter(F.col("_words") > 0)
        .join(targets, "_source")
        .withColumn("_left", F.col("target") - MAX_COPIES * F.coalesce(F.sum("_words").over(before), F.lit(0)))
        .withColumn("_try", F.col("_left") / F.sum(odds).over(rest).cast("double"))
        .withColumn("_open", F.col("_try") * (F.col("_digits") + BASE_ODDS) < MAX_COPIES)
        .withColumn("_first_open", F.max(F.when(F.col("_open"), F.col("_digits"))).over(Window.partitionBy("_source")))
    )
    scale = F.max(F.when(F.col("_digits") == F.col("_first_open"), F.col("_try")))
    scales = scaled.groupBy("_source").agg(F.coalesce(scale, F.lit(float(MAX_COPIES))).alias("_scale"))
    certain = (
        bands.join(scales, "_source")
        .groupBy("_source")
        .agg(F.max("_scale").alias("_scale"), F.sum(F.col("_words") * F.floor(_expected("_scale", F.col("_digits")))).alias("_certain"))
    )
    return (
        targets.join(certain, "_source", "left")
        .withColumn("_missing", F.col("target") - F.coalesce(F.col("_certain"), F.lit(0)))
        .select("_source", "_rows", "source_size", "target", F.coalesce("_scale", F.lit(0.0)).alias("_scale"), "_missing")
    )


def _digits(size: str) -> Column:
    """Binary digits of the size; 0 for size 0."""
    return F.when(F.col(size) > 0, F.length(F.bin(size))).otherwise(0)


def _expected(scale: str, digits: Column) -> Column:
    return F.least(F.lit(float(MAX_COPIES)), F.col(scale) * (digits + BASE_ODDS))


def _random(key: str, size: str) -> Column:
    """52 random bits in (0, 1), from a hash of identifier and size."""
    seed = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("/"), F.col(size).cast("string")))
    return (F.conv(F.substring(seed, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(2**52)


def _rank(random: Column, chance: Column) -> Column:
    """Random odds over inclusion odds, q, as q / (1 + q): the same order within (0, 1)."""
    odds = (random / (1 - random)) / (chance / (1 - chance))
    return odds / (1 + odds)


def _cell(rank: str) -> Column:
    return F.floor(F.col(rank) * CELLS)


def _fine(rank: str) -> Column:
    return F.floor(F.col(rank) * (CELLS * CELLS))


def _cuts(ranked: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """One row per source: the cell, the fine cell and the last place that are still drawn.
    A source without a cell is drawn whole."""
    ranked = ranked.filter(F.col("_rank").isNotNull())
    line = Window.partitionBy("_source")

    def crossing(sums: DataFrame, by: str, start: Column) -> DataFrame:
        """Of each source the entry of ``by`` in which the running words pass the missing ones."""
        total = F.sum("_words").over(line.orderBy(by))
        return (
            sums.withColumn("_until", total + start)
            .withColumn("_from", F.col("_until") - F.col("_words"))
            .filter((F.col("_from") <= F.col("_missing")) & (F.col("_missing") < F.col("_until")))
        )

    words = F.sum("size").alias("_words")
    coarse = ranked.groupBy("_source", _cell("_rank").alias("_cell")).agg(words)
    coarse = crossing(coarse.join(plan, "_source"), "_cell", F.lit(0)).select("_source", "_rows", "_missing", "_cell", F.col("_from").alias("_start"))
    inside = attach_by_key(ranked.drop("_rows", "_missing"), stage(coarse, "mix-cells"), "_source", "_rows", spread_by=(key, "size"))
    inside = inside.filter(_cell("_rank") == F.col("_cell"))
    fine = inside.groupBy("_source", "_rows", "_missing", "_cell", "_start", _fine("_rank").alias("_fine")).agg(words)
    fine = crossing(fine, "_fine", F.col("_start")).select("_source", "_rows", "_missing", "_cell", "_fine", F.col("_from").alias("_start"))
    fine = stage(fine, "mix-fine-cells")

    # About one row in CELLS x CELLS of the largest source meets in a task here.
    near = attach_by_key(ranked.drop("_rows", "_missing"), fine, "_source", "_rows", spread_by=(key, "size"))
    near = near.filter((_cell("_rank") == F.col("_cell")) & (_fine("_rank") == F.col("_fine")))
    ties = near.groupBy("_source", "_missing", "_start", "_rank", F.col(key).alias("_key"), F.col("size").alias("_size")).agg(F.sum("size").alias("_words"))
    until = F.sum("_words").over(line.orderBy("_rank", "_key", "_size")) + F.col("_start")
    last = (
        ties.withColumn("_until", until)
        .filter(F.col("_until") + F.col("_until") - F.col("_words") <= 2 * F.col("_missing"))
        .groupBy("_source")
        .agg(F.max(F.struct("_rank", "_key", "_size")).alias("_last"))
    )
    return plan.join(fine.select("_source", "_cell", "_fine"), "_source", "left").join(last, "_source", "left").drop("_missing")
