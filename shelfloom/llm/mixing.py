"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts.

Every document gets a random-looking key that depends on its id alone. Inside a source the
documents stand in the order of their keys; a source gives whole epochs of its documents
and, of the last one, the documents up to the place where its budget is used up. The prefix
sums are distributed: sums per range of keys, offsets from those, and running sums inside
one range, so a source that holds most rows is spread like any other.

Only DataFrame functions run here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import BLANK_WORDS, free_name
from shelfloom.sources.scratch import materialize

#: Hex digits of the key that name its range: 16 ** 3 ranges a source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORDS)), F.lit(0)).cast("bigint")


def mix_key(id_column: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(id_column.cast("string"), F.lit(""))))


def _place(id_column: Column, text: Column, seed: int) -> list[Column]:
    """Range, key and tie of a row: its place in its source.

    Rows without an id have one key; their texts deal them over ranges of their own.
    """
    key = mix_key(id_column, seed)
    tie = F.lpad(F.hex(F.xxhash64(F.lit(seed), text)), 16, "0")
    more = F.when(id_column.isNull(), F.substring(tie, 1, RANGE_DIGITS)).otherwise(F.lit(""))
    return [F.concat(F.substring(key, 1, RANGE_DIGITS), more).alias("_range"), key.alias("_key"), tie.alias("_tie")]


def fill_to_caps(sources: DataFrame, weights: Sequence[int], share: float, epochs: float) -> DataFrame:
    """Target of each source: its weight's part of ``share`` of everything, at most ``epochs`` of itself.

    What a cap cuts off goes to the others by weight, until none is above its cap. Sorted by
    cap over weight the capped sources come first, so one pass of running sums finds the
    level at which the rest is filled. ``sources`` has one row per source; the two windows
    without a partition see these rows only.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    everything = Window.partitionBy()
    ranked = sources.select(
        "*",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("_weight"),
        (F.col("source_size") * F.lit(float(epochs))).alias("_cap"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_total"),
    )
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    leveled = ranked.withColumns({"_level": level, "_turn": F.row_number().over(order)})
    full = F.col("_cap") <= F.col("_level") * F.col("_weight")
    last = F.min_by("_level", F.when(~full, F.col("_turn"))).over(everything)
    return leveled.withColumn("_last", last).select(
        *sources.columns,
        F.when(full, F.col("_cap")).otherwise(F.col("_weight") * F.col("_last")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 17,
    size: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(documents with what the mix takes of each, sources with their budgets and cuts).

    The first has doc_id, source, size, source_size, target and taken: words taken, repeats
    counted. A source takes ``floor(target)`` words exactly; the document at the cut gives
    the part before it. The second has source, source_size, target, epochs (whole passes)
    and cut (range, key and tie of a row): in the pass after those, rows up to it belong to the mix.

    NULL and empty texts have size 0 and give nothing; a source of such texts has target 0.
    A NULL source is a source of its own, last in order; its weight follows from that place.
    Rows that repeat a doc_id have the same key and stand next to each other, in the order of
    a hash of their texts, each with its own size; rows with a NULL doc_id are dealt by their
    texts. Empty tables give empty results. Other
    columns are not read.
    """
    sized = docs.select(
        "doc_id", F.col("source").alias("_source"), (word_count(F.col("text")) if size is None else size).alias("size"),
        *_place(F.col("doc_id"), F.col("text"), seed),
    )
    sized = materialize(sized, "mix")
    ranges = sized.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sources = ranges.groupBy("_source").agg(F.sum("_sum").alias("source_size"))
    sources = fill_to_caps(sources, weights, share, epochs)
    budget = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    sources = sources.withColumns({"epochs": passes, "_rest": budget - passes * F.col("source_size")})
    placed = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    placed = (
        placed.alias("r")
        .join(sources.alias("s"), F.col("r._source").eqNullSafe(F.col("s._source")))
        .select(
            F.col("r._source").alias("_source2"), F.col("_range").alias("_range2"), "_before",
            "source_size", "target", "epochs", "_rest",
        )
    )
    inside = (
        Window.partitionBy("_source", "_range")
        .orderBy("_key", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = sized.withColumn("_to", F.sum("size").over(inside))
    start = F.col("_before") + F.col("_to") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - start))
    taken = running.join(
        placed,
        F.col("_source").eqNullSafe(F.col("_source2")) & (F.col("_range") == F.col("_range2")),
    ).select(
        "doc_id", F.col("_source").alias("source"), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).alias("taken"), "epochs",
        F.struct("_range", "_key", "_tie").alias("_at"), (part > 0).alias("_in"),
    )
    cuts = taken.groupBy("source").agg(
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.first("epochs").alias("epochs"),
        F.max(F.when(F.col("_in"), F.col("_at"))).alias("cut"),
    )
    return taken.drop("epochs", "_at", "_in"), cuts


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole.

    A document in the last, partial pass counts once more, also the one at the cut: its
    source may exceed its budget by less than that document, and by the copies of its row
    where rows repeat an id (or have none) and the text. Documents without words are
    part of no mix and go. All columns of ``docs`` are kept, whatever their names.
    """
    seed = settings.get("seed", 17)
    _, cuts = mix_sources(docs, **settings)
    # One row per source, written down so that Spark knows its size when it picks the join.
    source, cut, again = (free_name(docs, n) for n in ("_mix_source", "_mix_cut", "_mix_pass"))
    cuts = materialize(cuts.select(F.col("source").alias(source), F.struct("epochs", "cut").alias(cut)), "cuts")
    place = F.struct(*_place(F.col("doc_id"), F.col("text"), seed))
    more = F.coalesce(place <= F.col(cut)["cut"], F.lit(False)).cast("int")
    times = F.when(word_count(F.col("text")) > 0, F.col(cut)["epochs"].cast("int") + more).otherwise(0)
    return (
        docs.join(cuts, F.col("source").eqNullSafe(F.col(source)))
        .withColumn(again, F.explode(F.array_repeat(F.lit(0), times)))
        .select(*docs.columns)
    )
