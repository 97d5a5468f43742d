"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Each document expects the same number of copies as any other of its source: target over size of
the source. The documents of a source stand in one order; a document gets a copy for each integer
that the running sum of expected copies, plus one random offset of the source, crosses in it. The
order goes by size (in steps of an eighth of an octave), so large and small documents are drawn
evenly, and by a hash of the id within a step.

No task orders a whole source: a source is cut into blocks of size step and hash range, rows are
numbered within their block, and the blocks' counts are summed up on a table of blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
LIMIT = 3  # no source, and so no document, is taken more often than this


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, take the weights in turn. Targets follow from the level
    at which shares cut off at ``limit`` sizes add up to all sizes; with sources ordered by the
    level at which they are cut off, it is the highest of the levels that hold if just those
    before are cut off.
    """
    turn = F.array(*[F.lit(w) for w in weights])
    rows = per_source.withColumn("_n", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    rows = rows.withColumn("_w", F.element_at(turn, (F.col("_n") % len(weights) + 1).cast("int")).cast("long"))
    rows = rows.withColumn("_cap", F.lit(limit) * F.col("source_size"))
    before = Window.orderBy(F.col("_cap") / F.col("_w"), "_n").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    rows = rows.withColumn("_level", left.cast("double") / weight.cast("double"))
    level = F.max("_level").over(everything)
    target = F.least(F.col("_cap").cast("double"), level * F.col("_w"))
    return rows.withColumn("target", target).drop("_n", "_w", "_cap", "_level")


def allot(
    scratch: Scratch, docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size",
    seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT,
) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to every row of ``docs``.

    Null sources are one source. Null keys come first within their size step. Rows that agree in
    key and size are interchangeable: which of them gets an odd copy is left open. Empty documents
    count and may get copies, which hold no word. An empty table gives an empty result. Columns
    named ``source_size``, ``target`` or ``copies`` are replaced; names beginning with ``_mix``
    are reserved.
    """
    docs = docs.drop("source_size", "target", "copies")
    name = F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))
    per = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"), F.count("*").alias("_mix_n"))
    per = targets(per, weights, limit)
    number = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    per = per.select(
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias("_mix_s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_mix_e"),
        (number.cast("double") / F.lit(4294967296.0)).alias("_mix_u"),
        F.ceil(F.sqrt(F.sum("_mix_n").over(Window.partitionBy())) / 8).cast("long").alias("_mix_parts"),
    )
    per = scratch.keep(per, "sources")

    # Exact below 16 words, then sixteen steps of equal width per power of two.
    shift = F.greatest(F.length(F.bin(F.col(size))) - 5, F.lit(0))
    step = shift * 32 + F.call_function("shiftright", F.col(size), shift).cast("int")
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    part = F.floor(F.conv(F.substring("_mix_h", 1, 4), 16, 10).cast("long") * F.col("_mix_parts") / 65536)
    rows = docs.withColumns({"_mix_s": name, "_mix_step": step, "_mix_h": digest}).join(per, "_mix_s")
    rows = rows.withColumn("_mix_part", part)
    block = ["_mix_s", "_mix_step", "_mix_part"]
    rows = rows.withColumn("_mix_r", F.row_number().over(Window.partitionBy(*block).orderBy("_mix_h", key, size)))

    slim = docs.select(F.col(key), F.col(size), name.alias("_mix_s"), step.alias("_mix_step"), digest.alias("_mix_h"))
    counts = slim.join(per, "_mix_s").withColumn("_mix_part", part).groupBy(*block).agg(F.count("*").alias("_mix_c"))
    before = Window.partitionBy("_mix_s").orderBy("_mix_step", "_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*block, F.coalesce(F.sum("_mix_c").over(before), F.lit(0)).alias("_mix_b"))

    rows = rows.join(counts, block)
    upto = F.col("_mix_b") + F.col("_mix_r")
    crossed = lambda n: F.floor(F.col("_mix_e") * n + F.col("_mix_u"))
    rows = rows.withColumn("copies", (crossed(upto) - crossed(upto - 1)).cast("long"))
    return rows.select(*docs.columns, "source_size", "target", "copies")


def emit(allotted: DataFrame) -> DataFrame:
    """Every row as often as ``copies`` says."""
    return allotted.where("copies > 0").withColumn("_mix_i", F.explode(F.expr("sequence(1L, copies)"))).drop("_mix_i")
