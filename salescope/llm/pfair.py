"""Mixing sources to target weights by proportionate-fair scheduling.

Each source's documents are cut into blocks. Block i (from 1) of a source with
weight w is released at floor((i - 1) / w) and due at ceil(i / w); the slots are
dealt earliest deadline first among the released blocks. Ties go to the block that
leaves its successor the least room (a deadline that overlaps the next release),
then to the smaller remaining interval, then to the source in name order. At every
slot the number of blocks a source has had differs from w times the slot number by
less than one block.

Target weights that name every source are taken exactly, as whole parts of a cycle, so the
bound holds against them over any number of cycles. Weights made from row counts are
defined as whole parts of a cycle, and the bound holds against these. Either way the
schedule repeats: one cycle is computed
once, by a fold over its slots on one row (work and size are set by the parameter
``cycle`` alone), and a block finds its slot by arithmetic. Ranking the documents of a
source is a sum over hash ranges plus a window inside each range, so a source that
holds a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescope.llm.common import numbered
from salescope.session import materialize

RANGE_ROWS = 256


def order_hash(id_col: Column, seed: int) -> Column:
    """The md5 that puts documents in an order which does not depend on their place."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def source_parts(counts: DataFrame, cycle: int, weights: dict[str, float] | None, exponent: float) -> DataFrame:
    """(source, n, parts): whole slots of a cycle for each source, at least one each.

    ``weights`` gives the targets of the sources it names, in any unit; sources it
    does not name share weight as their row count to the power ``exponent`` does, as
    all sources do when it is None. Parts are cumulative sums rounded down, so they
    fill the cycle; the cycle is ``cycle`` slots plus one for each source.
    """
    size = F.pow(F.col("n").cast("double"), F.lit(float(exponent)))
    if weights:
        named = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, float(v))])
        size = F.coalesce(F.try_element_at(named, F.col("source")), size)
    w = counts.withColumn("w", size)
    everything = Window.partitionBy(F.lit(0))
    running = everything.orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    share = F.round(F.sum("w").over(running) / F.sum("w").over(everything) * cycle, 6)
    w = w.withColumn("upto", F.floor(share).cast("long"))
    before = F.lag("upto", 1, 0).over(everything.orderBy(F.col("source").asc_nulls_first()))
    return w.select("source", "n", (F.col("upto") - before + 1).alias("parts"))


def exact_parts(weights: dict[str, float | int | str | Fraction], most: int) -> dict[str, int] | None:
    """The weights as the smallest whole numbers in the same ratio, None if these add up to over ``most``.

    Floats are read as they are written, so 0.1 is one tenth.
    """
    ratios = {k: Fraction(str(w)) for k, w in weights.items()}
    if any(r <= 0 for r in ratios.values()):
        raise ValueError("weights must be above 0")
    unit = lcm(*(r.denominator for r in ratios.values()))
    parts = {k: int(r * unit) for k, r in ratios.items()}
    shared = gcd(*parts.values())
    parts = {k: n // shared for k, n in parts.items()}
    return parts if sum(parts.values()) <= most else None


def target_parts(counts: DataFrame, cycle: int, weights: dict[str, float] | None, exponent: float) -> DataFrame:
    """(source, n, parts): the exact weights where they name every source and fit ten cycles, else :func:`source_parts`."""
    whole = exact_parts(weights, 10 * cycle) if weights else None
    if whole is None or counts.filter(F.col("source").isNull() | ~F.col("source").isin(list(whole))).limit(1).count():
        return source_parts(counts, cycle, weights, exponent)
    named = F.create_map(*[F.lit(x) for k, v in sorted(whole.items()) for x in (k, v)])
    return counts.select("source", "n", F.element_at(named, F.col("source")).cast("long").alias("parts"))


def cycle_schedule(parts: DataFrame) -> DataFrame:
    """(source, turn, slot): which slot of the cycle each block of a source takes.

    One fold over the slots. Its state is the number of blocks each source has had;
    at slot t a source with ``a`` of ``p`` slots whose next block is k (from 0) is
    released from slot floor(k * p / a) on, and due at ceil((k + 1) * p / a).
    """
    one = parts.agg(F.array_sort(F.collect_list(F.struct("source", "parts"))).alias("s"), F.sum("parts").alias("p"))
    pick = """
      transform(
        aggregate(
          sequence(0, cast(p as int) - 1),
          named_struct('done', transform(s, x -> 0L), 'out', cast(array() as array<int>)),
          (acc, t) -> transform(array(
            array_min(filter(transform(s, (x, i) -> named_struct(
              'due', (acc.done[i] + 1) * p div x.parts + if((acc.done[i] + 1) * p % x.parts = 0, 0L, 1L),
              'tight', if((acc.done[i] + 1) * p % x.parts = 0, 1L, 0L),
              'gap', p div x.parts,
              'i', i,
              'free', acc.done[i] * p < x.parts * (t + 1) and acc.done[i] < x.parts)), y -> y.free))),
            m -> named_struct(
              'done', transform(acc.done, (d, i) -> if(i = m.i, d + 1, d)),
              'out', concat(acc.out, array(m.i))))[0],
          acc -> acc.out),
        (i, t) -> named_struct('source', s[i].source, 'slot', cast(t as long)))
    """
    slots = one.select("p", F.explode(F.expr(pick)).alias("x")).select("p", "x.source", "x.slot")
    turn = F.row_number().over(Window.partitionBy("source").orderBy("slot")).cast("long") - 1
    return slots.select("source", turn.alias("turn"), "slot", "p")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source: str = "source", cycle: int = 1000, block_docs: int = 16,
    weights: dict[str, float] | None = None, exponent: float = 0.5, seed: int = 0,
) -> DataFrame:
    """Every row and column of ``docs``, plus ``block``, ``slot`` and ``place``.

    Reading the rows by (slot, place) gives the mix. ``weights`` that name every source of
    the table are kept exactly if their whole-number ratio fits ten times ``cycle``; a
    named source without rows leaves no gap, as the cycle is made of the sources there are. ``block`` counts the blocks of
    the row's source from 1; ``place`` is the row's place in its block. A source that
    has run out leaves its slots unused and the others keep theirs, so the bound of one
    block holds for as long as every source lasts. Nothing is dropped or repeated.
    A null source is a source of its own, a null id is ordered as the empty string,
    ties in the order hash are broken by id and rows that tie in both are equal in
    that order and may swap places. An empty table gives no rows. Columns of ``docs``
    named like the three added ones are replaced.
    """
    added = ("block", "slot", "place")
    own = [c for c in docs.columns if c not in added]
    plain, named = numbered(docs)
    origin, key = F.col(named[source]), F.col(named[id_col])
    base = plain.select(*[named[c] for c in own], origin.alias("_s"), key.alias("_i"), order_hash(key, seed).alias("_o"))
    keys = plain.select(origin.alias("source"), order_hash(key, seed).alias("o"))
    counts = materialize(keys.groupBy("source").agg(F.count("*").alias("n")), "sources")
    parts = target_parts(counts, cycle, weights, exponent)
    plan = materialize(cycle_schedule(parts), "cycle")

    def hash_range(h: Column, n: Column) -> Column:
        first = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
        return F.floor(first * F.ceil(n / RANGE_ROWS) / F.lit(1 << 32)).cast("long")

    sized = keys.join(counts.withColumnRenamed("source", "_cs"), F.col("source").eqNullSafe(F.col("_cs")))
    ranges = sized.groupBy("source", hash_range(F.col("o"), F.col("n")).alias("r")).agg(F.count("*").alias("rows"))
    upto = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(ranges.select("source", "r", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("start")), "ranges")

    placed = base.join(counts.select(F.col("source").alias("_cs"), F.col("n").alias("_n")), F.col("_s").eqNullSafe(F.col("_cs")))
    placed = placed.withColumn("_r", hash_range(F.col("_o"), F.col("_n")))
    inside = F.row_number().over(Window.partitionBy("_s", "_r").orderBy("_o", "_i")).cast("long") - 1
    placed = placed.withColumn("_w", inside).join(
        starts.select(F.col("source").alias("_ss"), F.col("r").alias("_rr"), F.col("start").alias("_start")),
        F.col("_s").eqNullSafe(F.col("_ss")) & (F.col("_r") == F.col("_rr")))
    rank = F.col("_start") + F.col("_w")
    placed = placed.withColumn("_b", F.expr(f"(_start + _w) div {block_docs}")).withColumn("place", rank % block_docs)
    sizes = materialize(parts.select(F.col("source").alias("_ps"), F.col("parts").alias("_parts")), "parts")
    placed = placed.join(sizes, F.col("_s").eqNullSafe(F.col("_ps")))
    placed = placed.withColumn("_turn", F.col("_b") % F.col("_parts"))
    plan = plan.select(F.col("source").alias("_qs"), F.col("turn").alias("_qt"), F.col("slot").alias("_slot"), F.col("p").alias("_p"))
    placed = placed.join(plan, F.col("_s").eqNullSafe(F.col("_qs")) & (F.col("_turn") == F.col("_qt")))
    slot = F.expr("(_b div _parts) * _p + _slot")
    return placed.select(*[F.col(named[c]).alias(c) for c in own], (F.col("_b") + 1).alias("block"), slot.alias("slot"), "place")
