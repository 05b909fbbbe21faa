"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Targets: each source's share of all tokens by weight, filled like water up
   to ``max_repeats`` times the source's size.
2. Blocks of ``block_tokens`` tokens are the seats: sources get them by highest
   quotients target / (2k - 1); a source's blocks go to its cells the same way,
   by the cells' tokens.  A source has a cell for each shard, or fewer that hold
   ``CELL_BLOCKS`` blocks each, so a small source is not dealt out into cells
   smaller than a block.  What a quota has over ``max_repeats`` times its cell's
   tokens goes to the source's other cells.
3. Within a cell, documents stand in a seeded hash order and form one token
   stream; the quota is a run of its blocks from a seeded start block, around
   the end and up to ``max_repeats`` times through.

A cell holds about ``docs_per_shard`` documents at most, or so many as have
``2 * CELL_BLOCKS`` blocks, however large its source is, so no task ever sees a
whole large source.  Documents without a word stay out of the streams.  Tables of
one row per source or per (source, shard) are the only others.  Native: no Python on executors.

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; rows of one doc_id are separate documents;
rows equal in every column are interchangeable; if there are no tokens at all
every target is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACED_WORD, cut_lineage, groups_for, read_table

#: So many blocks a cell of a source holds on average at least, if the source has them.
CELL_BLOCKS = 32


def sainte_lague(parties: DataFrame, group: Sequence[str], votes: str, seats: str, order: Sequence[str]) -> DataFrame:
    """Adds ``quota``: how many of its group's ``seats`` each party gets.

    The seats go to the highest quotients votes / (2k - 1), ties by ``order``.
    Quotients are not listed one by one: with S parties and N seats, divisors
    total / (N - S/2) and total / (N + S/2) give too few and enough seats, so
    only the about 2 S quotients between them compete.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    v, total = F.col(votes).cast("double"), F.sum(F.col(votes).cast("double")).over(g)
    half = F.count("*").over(g) / 2
    seats_at = lambda n: F.when(total > 0, F.floor(v * F.greatest(n, F.lit(0.0)) / total + 0.5)).otherwise(0).cast("long")
    sure = (
        parties.withColumn("_sure", seats_at(F.col(seats) - half))
        .withColumn("_most", seats_at(F.col(seats) + half))
        .withColumn("_left", F.col(seats) - F.sum("_sure").over(g))
    )
    open_seats = (
        sure.where("_most > _sure")
        .select(*group, *order, "_left", F.col(votes).alias("_v"), F.explode(F.expr("sequence(_sure + 1, _most)")).alias("_k"))
        .withColumn("_quotient", F.col("_v") / (2 * F.col("_k") - 1))
        .withColumn("_nth", F.row_number().over(g.orderBy(F.desc("_quotient"), *[F.col(c).asc_nulls_last() for c in order])))
        .where("_nth <= _left")
        .groupBy(*group, *order)
        .agg(F.count("*").alias("_more"))
    )
    keys = [*group, *order]
    more = open_seats.select(*[F.col(c).alias(f"_of_{c}") for c in keys], "_more")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return (
        sure.join(more, cond, "left")
        .withColumn("quota", F.col("_sure") + F.coalesce("_more", F.lit(0)))
        .drop("_sure", "_most", "_left", "_more", *[f"_of_{c}" for c in keys])
    )


def source_targets(sources: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """``(_src, _size)`` with ``_rank``, ``target`` and ``_total`` added.

    Sources by code point, null last, weigh ``weights`` in turn.  In ascending
    order of cap / weight a source is capped if the level that the rest would
    get is above its cap; after the first that is not, none is.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("_src").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    before = everything.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    cap = max_repeats * F.col("_size").cast("double")
    spent = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    level = (F.col("_total") - spent(F.col("_cap"))) / F.greatest(F.sum("_w").over(everything) - spent(F.col("_w")), F.lit(1e-12))
    capped = F.col("_ratio") <= F.col("_level")
    free = lambda c: F.sum(F.when(F.col("_capped"), F.lit(0.0)).otherwise(c)).over(everything)
    rest = F.col("_total") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0.0)).over(everything)
    return (
        sources.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("_w", w)
        .withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum("_size").over(everything))
        .withColumn("_level", level)
        .withColumn("_capped", capped)
        .withColumn("target", F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least("_cap", rest * F.col("_w") / free(F.col("_w")))))
        .select("_src", "_size", "_rank", "_total", "target")
    )


def _whole_takes(quotas: DataFrame, block_tokens: int, max_repeats: int) -> DataFrame:
    """Adds ``_take``: the tokens of each cell's quota, ``max_repeats`` times the
    cell's at most.  What that leaves over goes to the source's other cells by
    the room they have, so the takes add up to the source's blocks, or to
    ``max_repeats`` times the source if that is less."""
    source = Window.partitionBy("_src")
    upto = source.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = lambda c: c.cast("decimal(19,0)")
    share = lambda n: F.floor(wide(F.col("_over")) * wide(n) / wide(F.greatest(F.sum("_room").over(source), F.lit(1)))).cast("long")
    first = F.least(F.col("quota") * block_tokens, F.col("_tokens") * max_repeats)
    whole = F.least(F.col("_blocks") * block_tokens, F.col("source_size") * max_repeats)
    return (
        quotas.withColumn("_first", first)
        .withColumn("_room", F.col("_tokens") * max_repeats - F.col("_first"))
        .withColumn("_over", whole - F.sum("_first").over(source))
        .withColumn("_upto", F.sum("_room").over(upto))
        .withColumn("_take", F.col("_first") + share(F.col("_upto")) - share(F.col("_upto") - F.col("_room")))
        .drop("_first", "_room", "_over", "_upto")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_repeats: int = 3,
    block_tokens: int = 64,
    docs_per_shard: int = 4000,
    seed: int = 17,
    keep_rows: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken
    (tokens the mix takes) and copies (how often it takes the first token: the
    count of copies of a mix of whole documents); with ``keep_rows`` also
    ``row``, the whole row of ``docs`` as a struct."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(source_col).alias("_src"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(SPACED_WORD)), F.lit(0)).cast("long").alias("_size"),
        *([F.struct(*docs.columns).alias("row")] if keep_rows else []),
    )
    narrow = rows if keep_rows else cut_lineage(rows)
    shards = groups_for(docs.select(F.count("*")).first()[0], docs_per_shard)
    placed = narrow.withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(shards)).cast("int"))

    parts = cut_lineage(placed.groupBy("_src", "_shard").agg(F.sum("_size").alias("_in_part")))
    sources = source_targets(parts.groupBy("_src").agg(F.sum("_in_part").alias("_size")), weights, max_repeats)
    blocks = F.round(F.col("_total") / block_tokens).cast("long")
    won = sainte_lague(sources.withColumn("_seats", blocks), [], "target", "_seats", ["_rank"]).withColumnRenamed("quota", "_blocks")
    won = won.select(F.col("_src").alias("_of"), F.col("_size").alias("source_size"), "target", "_blocks")
    n_cells = F.greatest(F.least(F.lit(shards), F.floor(F.col("source_size") / (CELL_BLOCKS * block_tokens))), F.lit(1))
    parts = cut_lineage(
        parts.join(won, F.col("_src").eqNullSafe(F.col("_of"))).drop("_of").withColumn("_cell", F.pmod("_shard", n_cells).cast("int"))
    )
    cells = parts.groupBy("_src", "_cell").agg(
        F.sum("_in_part").alias("_tokens"), *[F.first(c).alias(c) for c in ("source_size", "target", "_blocks")]
    )
    quotas = _whole_takes(sainte_lague(cells, ["_src"], "_tokens", "_blocks", ["_cell"]), block_tokens, max_repeats)
    take = F.col("_take")
    start_block = F.pmod(F.xxhash64("_src", "_cell", F.lit(seed)), F.greatest(F.floor(F.col("_tokens") / block_tokens), F.lit(1)))
    quotas = (
        quotas.withColumn("_rounds", F.when(F.col("_tokens") > 0, F.floor(take / F.col("_tokens"))).otherwise(0).cast("long"))
        .withColumn("_run", (take - F.col("_rounds") * F.col("_tokens")).cast("long"))
        .withColumn("_start", (start_block * block_tokens).cast("long"))
        .select(F.col("_src").alias("_of"), F.col("_cell").alias("_in"), "source_size", "target", "_tokens", "_rounds", "_run", "_start")
    )
    of_part = parts.select(F.col("_src").alias("_part_of"), F.col("_shard").alias("_part"), "_cell").join(
        quotas, F.col("_part_of").eqNullSafe(F.col("_of")) & (F.col("_cell") == F.col("_in"))
    )
    of_part = of_part.drop("_of", "_in")
    dealt = placed.join(of_part, F.col("_src").eqNullSafe(F.col("_part_of")) & (F.col("_shard") == F.col("_part")))
    dealt = dealt.withColumn("_stream", F.when(F.col("_size") > 0, F.col("_cell")).otherwise(-1 - F.col("_shard")))
    seeded = Window.partitionBy("_src", "_stream").orderBy(F.xxhash64("_id", F.lit(seed + 1)), "_id", "_size")
    both = dealt.withColumn("_at", F.coalesce(F.sum("_size").over(seeded.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    end, stop = F.col("_at") + F.col("_size"), F.col("_start") + F.col("_run")

    def within(lo: Column, hi: Column) -> Column:
        return F.greatest(F.least(end, hi) - F.greatest(F.col("_at"), lo), F.lit(0))

    wrapped = F.greatest(stop - F.col("_tokens"), F.lit(0))
    partly = within(F.col("_start"), F.least(stop, F.col("_tokens"))) + within(F.lit(0), wrapped)
    first_taken = ((F.col("_at") >= F.col("_start")) & (F.col("_at") < stop)) | (F.col("_at") < wrapped)
    copies = F.when(F.col("_size") > 0, F.col("_rounds") + first_taken.cast("long")).otherwise(0)
    return both.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target"),
        (F.col("_rounds") * F.col("_size") + partly).cast("long").alias("taken"),
        copies.cast("long").alias("copies"),
        *(["row"] if keep_rows else []),
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
