"""Mix sources to target weights by pivotal dependent rounding; built-in expressions only.

A source's ratio is its target over its size.  Every unit gets the whole part of it as copies and
has the fraction left as the probability of one more.  Units meet in pairs: words move from one to
the other, in a random direction with the odds that keep both expectations, until one of them is
at 0 or 1.  The words of a pair do not change, so those of a source do not.  Groups of about 64
units are folded so, each leaving one undecided unit; those form the groups of the next level, up
to one group per source.  That last group is folded with TRIALS series of random numbers, the one
that leaves least to round is taken, and its undecided unit goes to the nearer end.  So a source
differs from its target by less than half of one unit, mostly by far less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialise
from .support import WORD, text_of

FAN_IN = 64
TRIALS = 256
SURE = 1e-9
_STATE = "struct<k:struct<a:bigint,b:bigint>,s:double,p:double>"
_UNIT = ("source", "doc_id", "size")


def sizes_of(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """``doc_id``, ``source`` and ``size``, the number of words, of every row."""
    words = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), words.alias("size"))


def targets(per_source: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), most: float = 3.0) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in code-point order, null last, take ``weights`` in turn and share the sum of all sizes;
    what exceeds ``most`` times a source's size is shared again by weight among the others.  The
    common level of the uncapped sources follows from sums over the sources in the order in which
    they reach their cap.  One task sees one row per source; a source is a name given to many rows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    named = per_source.withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1))
    named = named.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    # The level if exactly the sources before this one are capped; it is right at the first source that stays below.
    level = named.withColumn("_level", left / weight_left)
    below = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = level.withColumn("_found", F.first(below, ignorenulls=True).over(whole))
    return found.select(
        "source", "source_size", F.least(F.coalesce(F.col("_found") * F.col("_w"), F.col("_cap")), F.col("_cap")).alias("target")
    )


def _chance(seed: Column, level: int, a: Column, b: Column) -> Column:
    """A number in [0, 1) that depends on seed, level and the pair only."""
    return F.shiftrightunsigned(F.xxhash64(seed, F.lit(level), a, b), 11) / F.lit(float(1 << 53))


def _fold(units: Column, seed: Column, level: int) -> Column:
    """Meet the units of one array in order: the undecided one and the ends of all others."""

    def meet(state: Column, unit: Column) -> Column:
        held = state["held"]
        # Words that can move up (held gains) or down until one of the two is decided.
        up = F.least((1 - held["p"]) * held["s"], unit["p"] * unit["s"])
        down = F.least(held["p"] * held["s"], (1 - unit["p"]) * unit["s"])
        moved = F.when(_chance(seed, level, held["k"], unit["k"]) * (up + down) < down, up).otherwise(-down)

        def ended(p: Column) -> Column:
            return F.when(p < SURE, 0.0).when(p > 1 - SURE, 1.0).otherwise(p)

        def with_p(u: Column, p: Column) -> Column:
            return F.struct(u["k"].alias("k"), u["s"].alias("s"), p.alias("p"))

        met = F.struct(
            with_p(held, ended(held["p"] + moved / held["s"])).alias("x"),
            with_p(unit, ended(unit["p"] - moved / unit["s"])).alias("y"),
        )
        # Bound once through a one-element array, so that the expression is not repeated.
        return F.element_at(
            F.transform(
                F.array(met),
                lambda m: F.when(
                    held.isNull(),
                    F.struct(unit.alias("held"), state["done"].alias("done")),
                ).otherwise(
                    F.struct(
                        F.when(m["x"]["p"].isin(0.0, 1.0), m["y"]).otherwise(m["x"]).alias("held"),
                        F.concat(
                            state["done"], F.array(F.when(m["x"]["p"].isin(0.0, 1.0), m["x"]).otherwise(m["y"]))
                        ).alias("done"),
                    )
                ),
            ),
            1,
        )

    start = F.struct(F.lit(None).cast(_STATE).alias("held"), F.array().cast(f"array<{_STATE}>").alias("done"))
    return F.aggregate(units, start, meet)


def _best_fold(units: Column, seed: int, level: int) -> Column:
    """The fold, of TRIALS random ones, whose undecided unit is nearest to an end, in words."""
    trials = F.transform(F.sequence(F.lit(1), F.lit(TRIALS)), lambda t: _fold(units, t + F.lit(seed * TRIALS), level))
    open_words = F.transform(
        trials,
        lambda f: F.struct(
            (F.least(f["held"]["p"], 1 - f["held"]["p"]) * f["held"]["s"]).alias("open"),
            f["held"].alias("held"),
            f["done"].alias("done"),
        ),
    )
    return F.array_min(open_words)


def copies(units: DataFrame, seed: int = 1) -> DataFrame:
    """``source``, ``k`` and ``p`` (0.0 or 1.0) of units with ``source``, ``k``, ``s`` > 0, 0 < ``p`` < 1.

    ``k``, two hashes, names a unit within its source.  Each level deals the units of a source over groups by a
    hash of ``k``, about FAN_IN to a group, so a hot source has as many groups as it needs.  The
    number of levels is the logarithm of the largest source.
    """
    decided = []
    level, most = 0, units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    left = units
    while most > 1:  # the smaller sources are done earlier, with one unit left
        groups = -(-most // FAN_IN)
        dealt = left.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "k"), F.lit(groups)))
        folded = dealt.groupBy("source", "g").agg(F.sort_array(F.collect_list(F.struct("k", "s", "p"))).alias("units"))
        units = F.col("units")
        fold = _fold(units, F.lit(seed), level) if groups > 1 else _best_fold(units, seed, level)
        folded = materialise(folded.select("source", fold.alias("f")), f"mix-level{level}")
        decided.append(folded.select("source", F.explode("f.done").alias("u")).select("source", "u.k", "u.p"))
        rest = folded.select("source", "f.held.*")
        decided.append(rest.where(F.col("p").isin(0.0, 1.0)).select("source", "k", "p"))
        left = rest.where(~F.col("p").isin(0.0, 1.0))
        most = left.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        level += 1
    decided.append(left.select("source", "k", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0).alias("p")))
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    most: float = 3.0,
    seed: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies`` of every distinct unit.

    Rows equal in id, source and size are one unit: they get the same number of copies, and
    ``repeats`` says how many rows it has.  A document without words (null, empty or blank text)
    has size 0 and no copies.  A null source is a source of its own, the last one.  No unit gets
    more than ``most`` copies, and reruns agree: chance comes from hashes of ids.
    """
    read = sizes_of(docs, id_col, text, source)
    units = materialise(read.groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("repeats")), "mix-units")
    per_source = targets(
        units.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size")), weights, most
    )
    # One row per source, so small that it is read anew by every stage that needs it.
    per_source = materialise(per_source, "mix-targets").withColumnRenamed("source", "_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + SURE)
    planned = (
        units.join(per_source, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_base", F.when(F.col("size") > 0, whole).otherwise(0).cast("long"))
        .withColumn("_p", F.greatest(ratio - whole, F.lit(0.0)))
        .withColumn("k", F.struct(F.xxhash64("doc_id", "size").alias("a"), F.xxhash64(F.lit(1), "size", "doc_id").alias("b")))
    )
    open_units = planned.where((F.col("size") > 0) & (F.col("_p") > SURE)).select(
        F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_n"),
        "k", (F.col("size") * F.col("repeats")).cast("double").alias("s"), F.col("_p").alias("p"),
    )
    open_units = open_units.select(F.struct("_n", "_s").alias("source"), "k", "s", "p")
    chosen = copies(open_units, seed).select(F.col("source").alias("_key"), F.col("k").alias("_k"), F.col("p").alias("_more"))
    key = F.struct(F.col("source").isNull().alias("_n"), F.coalesce("source", F.lit("")).alias("_s"))
    return planned.join(chosen, (F.col("_k") == F.col("k")) & (F.col("_key") == key), "left").select(
        "doc_id", "source", "size", "repeats", "source_size", "target",
        (F.col("_base") + F.coalesce("_more", F.lit(0.0)).cast("long")).alias("copies"),
    )


def repeated(
    docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` as often as ``mixed``, what ``mix`` gave for them, says; none for 0 copies.

    Joined on the id, and on source and size, which tell apart rows that repeat an id.  What is
    taken grows with the corpus, so it is merged and not broadcast.
    """
    taken = mixed.where("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("copies").alias("_copies")
    )
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    same = docs[id_col].eqNullSafe(F.col("_id")) & docs[source].eqNullSafe(F.col("_source")) & (size == F.col("_size"))
    found = docs.join(taken.hint("merge"), same)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return found.withColumn("_time", times).select(*[docs[c] for c in docs.columns])
