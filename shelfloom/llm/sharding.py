"""Sharding: a k-d tree over document metadata, split at weighted medians.

The unit is a group of equal texts, weighted by the bytes of all its documents, so copies
share a shard. Each unit has a position in every metadata dimension: source, language, size
and id, as the number of its value followed by bits of its text's hash. So values that tie,
such as a source with most rows, can still be cut at any weight. A node is split along the
dimension in which it is widest, at the median weighted by bytes, or where a node's shards
are odd in number, at the part that belongs to the left ones, until each leaf is one shard.
A unit heavier than an even leaf is a leaf of its own; the tree divides the others evenly.

Medians are distributed: bytes are summed per bin of the node's range, then per bin of the
bin in which the median lies, and so on. Each round gives at most ``BINS`` sums a node,
whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import free_name
from shelfloom.operators.keys import number_rows
from shelfloom.sources.scratch import materialize

BINS = 4096
#: A position is this many bits of the value and that many of the text's hash.
VALUE_BITS, HASH_BITS = 24, 24


@dataclass(frozen=True)
class Node:
    """Part of the tree: ``shards`` leaves, numbered from ``first``."""

    number: int
    first: int
    shards: int


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _hash_part(value: Column, bits: int) -> Column:
    return F.xxhash64(value).bitwiseAND(F.lit((1 << bits) - 1))


def _position(value: Column, unit: Column) -> Column:
    """Value part (0 .. 2**VALUE_BITS - 1) and hash part of one dimension."""
    top = F.least(F.greatest(value.cast("bigint"), F.lit(0)), F.lit((1 << VALUE_BITS) - 1))
    return F.shiftleft(top, HASH_BITS) + _hash_part(unit, HASH_BITS)


def _units(docs: DataFrame) -> DataFrame:
    """(unit_a, unit_b, bytes, d0 .. d3): one row per distinct text, with the metadata of its first document."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang"))
    units = docs.groupBy("unit_a", "unit_b").agg(F.sum("size").alias("bytes"), first.alias("first"), F.max("size").alias("one"))
    unit = F.concat_ws("-", "unit_a", "unit_b")
    return units.select(
        "unit_a", "unit_b", "bytes",
        _position(_hash_part(F.col("first.source"), VALUE_BITS), unit).alias("d0"),
        _position(_hash_part(F.col("first.lang"), VALUE_BITS), unit).alias("d1"),
        # The logarithm of the size, from 0 to 2 GB, over the whole range.
        _position(F.log2(F.col("one")) / 31 * ((1 << VALUE_BITS) - 1), unit).alias("d2"),
        _position(_hash_part(F.col("first.doc_id"), VALUE_BITS), unit).alias("d3"),
    )


def _rows(spark, values: Sequence[tuple], schema: str) -> DataFrame:
    """A table of a few values as SQL literals."""
    names = [part.split()[0] for part in schema.split(",")]
    kinds = [part.split()[1] for part in schema.split(",")]
    made = F.array(*[F.struct(*[F.lit(v).cast(k).alias(n) for v, n, k in zip(row, names, kinds, strict=True)]) for row in values])
    return spark.range(1).select(F.inline(made))


def _heavy_units(units: DataFrame, shards: int) -> list[tuple[int, int]]:
    """Units above the even share of what the lighter ones leave, heaviest first: fewer than there are shards."""
    left = units.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    found = []
    for row in units.orderBy(F.desc("bytes"), "unit_a", "unit_b").select("unit_a", "unit_b", "bytes").limit(shards - 1).collect():
        if row["bytes"] * (shards - len(found)) <= left:
            break
        found.append((row["unit_a"], row["unit_b"]))
        left -= row["bytes"]
    return found


def _split_points(units: DataFrame, nodes: Sequence[Node], dimensions: int) -> dict[int, tuple[int, int]]:
    """Dimension and highest position of the left part for each node with more than one shard."""
    spark = units.sparkSession
    ends = [f(f"d{d}").alias(f"{name}{d}") for d in range(dimensions) for f, name in ((F.min, "low"), (F.max, "high"))]
    found = {r["node"]: r for r in units.groupBy("node").agg(F.sum("bytes").alias("bytes"), *ends).collect()}
    state = {}
    for node in nodes:
        row = found.get(node.number)
        if row is None:
            continue
        width = {d: row[f"high{d}"] - row[f"low{d}"] for d in range(dimensions)}
        widest = max(width, key=lambda d: (width[d], -d))
        share = row["bytes"] * (node.shards // 2) / node.shards
        # The cut is in [low, high]; bytes below low; bytes that belong to the left; bytes of the last bin.
        state[node.number] = [widest, row[f"low{widest}"], row[f"high{widest}"], 0, share, row["bytes"]]
    while wide := {n: s for n, s in state.items() if s[1] < s[2]}:
        step = {n: -(-(s[2] - s[1] + 1) // BINS) for n, s in wide.items()}
        table = _rows(
            spark, [(n, s[0], s[1], s[2], step[n]) for n, s in wide.items()], "node int,d int,low bigint,high bigint,step bigint"
        )
        here = F.element_at(F.array(*[F.col(f"d{d}") for d in range(dimensions)]), F.col("d") + 1)
        sums = (
            units.join(F.broadcast(table), "node")
            .withColumn("at", here)
            .filter("at BETWEEN low AND high")
            .groupBy("node", F.expr("(at - low) DIV step").alias("bin"))
            .agg(F.sum("bytes").alias("bytes"))
            .collect()
        )
        done = set()
        for row in sorted(sums, key=lambda r: (r["node"], r["bin"])):
            s, size = state[row["node"]], step[row["node"]]
            if row["node"] in done:
                continue
            if s[3] + row["bytes"] < s[4]:
                s[3] += row["bytes"]
                continue
            low = s[1] + row["bin"] * size
            s[1], s[2], s[5] = low, low + size - 1, row["bytes"]
            done.add(row["node"])
        for n in wide.keys() - done:
            # Only rounding can leave the share above all bins: everything is left of the cut.
            state[n][1] = state[n][2]
    # The last position goes to the side that brings the bytes nearer to the share.
    return {n: (s[0], s[1] if abs(s[3] + s[5] - s[4]) < abs(s[3] - s[4]) else s[1] - 1) for n, s in state.items()}


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows of ``docs`` with shard (int), slot (long) and size (long) added.

    Give the number of shards, or the bytes that a leaf should have: then there are as many
    shards as the bytes need. ``columns`` are those to keep, all by default; without the text
    among them no text is shuffled. ``size`` is the UTF-8 bytes of the text plus 1. Slots number
    the rows of a shard from 0 without gaps, by doc_id and size.

    Rows with equal texts share a shard, also rows with a NULL text or empty ones. So a group
    of copies larger than an even leaf is a shard of its own; all others share the rest evenly.
    NULL sources, languages and ids are values like others. Repeated rows are all kept, each
    with its own slot. With fewer texts than shards some shards are empty; an empty table
    gives an empty result. Columns named as the added ones are replaced; all others are kept.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    own = [c for c in (columns or docs.columns) if c.lower() not in ("shard", "slot", "size")]
    has = {c.lower() for c in docs.columns}
    missing = [c for c in ("source", "lang") if c not in has]
    ua, ub, number, lowest = (free_name(docs, n) for n in ("_unit_a", "_unit_b", "_number", "_first"))
    placed = docs.withColumns(
        {
            "size": text_bytes(F.col("text")),
            ua: F.xxhash64(F.lit(1), "text"),
            ub: F.xxhash64(F.lit(2), F.reverse("text"), F.col("text").isNull()),
        }
    )
    narrow = placed.withColumns({c: F.lit(None).cast("string") for c in missing}).select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "size",
        F.col(ua).alias("unit_a"), F.col(ub).alias("unit_b"),
    )
    units = materialize(_units(narrow), "units")
    dimensions = 4
    if shards is None:
        total = units.agg(F.sum("bytes")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    heavy = _heavy_units(units, shards)
    # Node 0 and the negative ones are no part of the tree: each has one heavy unit.
    current, leaves = units.withColumn("node", F.lit(1)), [Node(-i, i, 1) for i in range(len(heavy))]
    if heavy:
        table = _rows(units.sparkSession, [(a, b, -i) for i, (a, b) in enumerate(heavy)], "ha bigint,hb bigint,own int")
        at = (F.col("unit_a") == F.col("ha")) & (F.col("unit_b") == F.col("hb"))
        current = units.join(F.broadcast(table), at, "left").withColumn("node", F.coalesce("own", F.lit(1))).drop("ha", "hb", "own")
    open_nodes = [Node(1, len(heavy), shards - len(heavy))]
    while any(n.shards > 1 for n in open_nodes):
        leaves += [n for n in open_nodes if n.shards == 1]
        open_nodes = [n for n in open_nodes if n.shards > 1]
        cuts = _split_points(current.filter(F.col("node").isin([n.number for n in open_nodes])) if leaves else current, open_nodes, dimensions)
        if not cuts:
            break
        table = _rows(units.sparkSession, [(n, c[0], c[1]) for n, c in cuts.items()], "node int,d int,cut bigint")
        here = F.element_at(F.array(*[F.col(f"d{d}") for d in range(dimensions)]), F.col("d") + 1)
        # One row per node of a level, fewer than there are shards.
        current = (
            current.join(F.broadcast(table), "node", "left")
            .withColumn("node", F.when(F.col("d").isNull(), F.col("node")).otherwise(F.col("node") * 2 + (here > F.col("cut")).cast("int")))
            .drop("d", "cut")
        )
        below = []
        for n in open_nodes:
            if n.number in cuts:
                left = n.shards // 2
                below += [Node(n.number * 2, n.first, left), Node(n.number * 2 + 1, n.first + left, n.shards - left)]
        open_nodes = below
    leaves += open_nodes
    names = _rows(units.sparkSession, [(n.number, n.first) for n in leaves], "node int,shard int")
    where = current.join(F.broadcast(names), "node").select(F.col("unit_a").alias(ua), F.col("unit_b").alias(ub), "shard")
    where = materialize(where, "unit_shards")
    sharded = placed.select(*own, "size", ua, ub).join(where, [ua, ub])
    # Number all rows by shard; a shard's slots start after the rows of the shards before it.
    order = ["shard", *(["doc_id"] if "doc_id" in own else []), "size", ua]
    numbered = number_rows(sharded, order, 0, number)
    starts = numbered.groupBy("shard").agg(F.min(number).alias(lowest))
    return numbered.join(F.broadcast(starts), "shard").select(*own, "size", "shard", (F.col(number) - F.col(lowest)).alias("slot"))
