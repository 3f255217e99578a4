"""Mixing sources to target weights by capped water-filling (native).

All sources share ``share`` times all words by weight, but none may be
repeated more than ``epochs`` times.  Sources whose share is above that cap
are clamped and what they cannot take goes to the others by weight, until
none is above: each round is one sum over the source table.  (The level that
this raises is Newton's method on a concave piecewise linear function, so
the rounds grow with the logarithm of the words, not with the sources.)

A source's target is then met exactly, but for the fraction of a word:
every document is repeated whole ``target div size`` times, and the rest of
the target is filled by the documents in the order of a seeded hash; the
document on the border gives its first words.  The border is found by sums
over hash prefixes, 4,096 at a time, so no rows are sorted or moved; a
source with a third of all rows costs no task more than another.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null
source is a source, the last one; documents alike in doc_id and text are
interchangeable, the first ones by place are filled first, so the rows as a
set do not depend on the partitioning; null ids take part as any other; an
empty table gives an empty result; other input columns pass through, and a
computed column replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import global_positions, row_places
from .text import broadcast_if_small, cut, with_columns

# --- fixed values: the contract's weights, cap and word pattern --------------
WEIGHTS = (5, 2, 1)
EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
# --- end of fixed values ------------------------------------------------------

SEED = "mix-1"
# Hash prefixes (hex digits) at which the border document is looked for; the
# last is the whole hash.
PREFIXES = (3, 6, 32)


def sample_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Place of a document in its source's seeded order (128 bits as hex)."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text))


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(_row, _src, _size, _key) of every document; ``_src`` sorts by code point, null last."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source")).alias("_src"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        sample_key(F.col("doc_id"), text, seed).alias("_key"))


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(_src, _source_size, _target, _words) of each source; ``sizes`` is (_src, _source_size).

    ``_words`` is the target in whole words.
    """
    ranked = row_places(sizes.orderBy("_src"), "_place")
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = cut(ranked.select(
        "_src", "_source_size", (F.col("_source_size") * epochs).alias("_cap"),
        F.get(cycle, F.pmod("_place", F.lit(len(weights))).cast("int")).cast("long").alias("_w")))
    total = sources.agg(F.coalesce(F.sum("_source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
    free, weight = total
    while True:
        above = _wide("_cap") * F.lit(weight).cast("decimal(19,0)") < F.lit(free).cast("decimal(19,0)") * _wide("_w")
        words, clamped = sources.where(above).agg(
            F.coalesce(F.sum("_cap"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
        if total[1] - clamped == weight:
            break
        free, weight = total[0] - words, total[1] - clamped
    shared = F.lit(free) * F.col("_w")
    return sources.select(
        "_src", "_source_size",
        F.when(above, F.col("_cap").cast("double")).otherwise(
            shared.cast("double") / F.lit(float(max(weight, 1)))).alias("_target"),
        F.when(above, F.col("_cap")).otherwise(F.floor(
            shared.cast("decimal(38,0)") / F.lit(max(weight, 1)).cast("decimal(19,0)")).cast("long")).alias("_words"))


def _border(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The group of ``by`` in which each source's ``_left`` words end; ``_left`` is cut down to it."""
    before = Window.partitionBy("_src").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("_src", *by).agg(F.sum("_size").alias("_sum"), F.count(F.lit(1)).alias("_rows"),
                                      F.first("_left").alias("_left"))
        .withColumn("_left", F.col("_left") - F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .where((F.col("_left") >= 0) & (F.col("_left") < F.col("_sum"))).drop("_sum")
    )


def mix_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row a source: target, whole repetitions, and the documents on the border of the rest.

    ``sized`` is (_src, _size, _key), read several times.
    """
    sizes = sized.groupBy("_src").agg(F.sum("_size").alias("_source_size"))
    goal = targets(sizes, weights, epochs)
    whole = F.when(F.col("_source_size") > 0, F.expr("_words div _source_size")).otherwise(F.lit(0))
    goal = cut(goal.select("_src", "_source_size", "_target", whole.alias("_whole"),
                           (F.col("_words") - whole * F.col("_source_size")).alias("_left")))
    rows = sized.join(broadcast_if_small(goal.select("_src", "_left")), "_src")
    border, known = None, 0
    for digits in PREFIXES:
        if border is not None:  # only the rows that share the border's prefix
            rows = sized.withColumn("_prefix", F.substring("_key", 1, known)).join(
                broadcast_if_small(border.drop("_rows")), ["_src", "_prefix"])
        known = digits
        by = ["_prefix"] if digits < PREFIXES[-1] else ["_prefix", "_size"]
        border = cut(_border(rows.withColumn("_prefix", F.substring("_key", 1, digits)), by))
    border = border.select("_src", F.col("_prefix").alias("_end"), F.col("_size").alias("_end_size"),
                           F.col("_rows").alias("_ends"), "_left")
    return cut(goal.drop("_left").join(border, "_src", "left"))


def repeated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their source's plan and ``_extra``, the words taken beyond the whole repetitions."""
    named = plan.withColumnRenamed("_src", "_of")
    joined = rows.join(broadcast_if_small(named), F.col("_src") == F.col("_of")).drop("_of")
    end = (F.col("_key") == F.col("_end")) & (F.col("_size") == F.col("_end_size"))
    inside = (F.col("_key") < F.col("_end")) | ((F.col("_key") == F.col("_end")) & (F.col("_size") < F.col("_end_size")))
    extra = F.when(end, F.col("_left")).when(inside, F.col("_size")).otherwise(F.lit(0)).cast("long")
    alike = plan.where((F.col("_ends") > 1) & (F.col("_left") > 0)).count()
    if alike == 0:
        return joined.withColumn("_extra", extra)
    # several rows on one border: numbered, and filled one after the other
    several = F.coalesce(end & (F.col("_ends") > 1), F.lit(False))
    ends = global_positions(joined.where(several).withColumn("_n", F.monotonically_increasing_id()),
                            "_src", ["_n"], alike, "_pos")
    left = F.col("_left") - F.col("_pos") * F.col("_size")
    filled = ends.withColumn("_extra", F.greatest(F.lit(0), F.least(left, F.col("_size"))).cast("long"))
    return joined.where(~several).withColumn("_extra", extra).unionByName(filled.drop("_n", "_pos"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, taken, repeats and part_words.

    A document is taken ``repeats`` times whole and then its first
    ``part_words`` words; ``taken`` counts the words of both.
    """
    rows = measured(docs, seed)
    plan = mix_plan(cut(rows.select("_src", "_size", "_key")), weights, epochs)
    return _named(repeated(rows, plan), docs.columns)


def _named(done: DataFrame, columns: Sequence[str]) -> DataFrame:
    taken = F.col("_whole") * F.col("_size") + F.col("_extra")
    full = (F.col("_extra") == F.col("_size")) & (F.col("_size") > 0)
    return with_columns("_row", columns, done, {
        "size": F.col("_size"),
        "source_size": F.col("_source_size"),
        "target": F.col("_target"),
        "taken": taken,
        "repeats": F.when(F.col("_size") > 0, F.col("_whole") + full.cast("long")).otherwise(F.lit(0)).cast("int"),
        "part_words": F.when(full, F.lit(0)).otherwise(F.col("_extra")).cast("long"),
    })


def mixed_texts(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row a repetition (``copy`` from 0); a part is its words with single blanks."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), "")
    part = F.array_join(F.slice(words, F.lit(1), F.col("part_words").cast("int")), " ")
    copies = F.col("repeats") + (F.col("part_words") > 0).cast("int")
    each = mixed.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return each.withColumn("text", F.when(F.col("copy") < F.col("repeats"), F.col("text")).otherwise(part))


def mix_digest(docs: DataFrame, **params) -> DataFrame:
    """The contract's columns: doc_id, size, source_size, target, taken; the texts are read once."""
    rows = cut(measured(docs.select("doc_id", "source", "text")).select(
        F.struct(F.col("_row.doc_id").alias("doc_id")).alias("_row"), "_src", "_size", "_key"))
    done = _named(repeated(rows, mix_plan(rows.drop("_row"), **params)), ["doc_id"])
    return done.select("doc_id", "size", "source_size", "target", "taken")
