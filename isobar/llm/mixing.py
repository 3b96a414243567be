"""Mix sources to target weights: random order within a source, running sums, an exact cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import block_of, blocks_for, running_before, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3.0


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """Targets of sources (source, source_size): shares by weight of all sizes, at most ``most_epochs`` times a source.

    Sources take the weights in turn, in code-point order, NULL last. What a source cannot take goes to the others by
    weight: every target is min(limit, level * weight), with the one level at which targets add up to all sizes. A source
    below the level is at its limit, so the level follows from sums over sources ordered by limit / weight. The table has a row per
    source; its windows need no more.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(table, (place % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", F.col("source_size") * float(most_epochs))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_weight", F.sum("weight").over(everything))
    # The level if just the sources before this one were at their limits.
    level = (F.col("total") - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    s = s.withColumn("level", level).withColumn("at_limit", F.col("limit") / F.col("weight") < F.col("level"))
    s = s.withColumn("final", F.min(F.when(~F.col("at_limit"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)["level"])
    return s.select(
        "source", "source_size", F.least(F.col("limit"), F.coalesce(F.col("weight") * F.col("final"), F.col("limit"))).alias("target")
    )


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", F.crc32(F.encode("text", "UTF-8")))


def mix(docs: DataFrame, seed: int = 42, weights: tuple[float, ...] = WEIGHTS, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """Words taken of each document: doc_id, source, size, source_size, target, taken, copies.

    Documents of a source are ordered by a random key, made by hashing the seed, doc_id and text; an epoch goes through all in that order. The mix takes
    whole epochs and then the start of one more, until the words taken are the target rounded to a whole
    number; the document at the cut gives only its first words. ``copies`` is the number of epochs that take any of
    the document (an empty one: as its place in the order has it). Running it again gives the same.

    NULL texts have size 0, a NULL source is a source, NULL and repeated doc_ids are documents like others (equal rows are
    in no particular order, which changes nothing). An empty table gives no rows.
    """
    return _mixed(docs, seed, weights, most_epochs).drop("key")


def _mixed(docs: DataFrame, seed: int, weights: tuple[float, ...], most_epochs: float) -> DataFrame:
    """The rows of ``mix`` with the random key."""
    compact = written(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            _key(seed).alias("key"),
        ),
        "mix",
    )
    sizes = compact.groupBy("source").agg(F.sum("size").alias("source_size"))
    blocks = blocks_for(compact.count())
    ordered = running_before(
        compact.withColumn("block", block_of(F.col("key"), blocks)), ["source"], ["key", "doc_id", "size"], "block", "size", "before"
    )
    targets = source_targets(sizes, weights, most_epochs).withColumnRenamed("source", "_source")
    rows = ordered.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    words = F.round("target").cast("long")
    per_epoch = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    rest = words - per_epoch * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    in_last = (F.col("before") < rest).cast("int")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "key",
        (per_epoch * F.col("size") + last).cast("long").alias("taken"),
        (per_epoch + in_last).cast("int").alias("copies"),
    )


def mixed_documents(
    docs: DataFrame, seed: int = 42, weights: tuple[float, ...] = WEIGHTS, most_epochs: float = MOST_EPOCHS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as ``mix`` takes them; the one at a source's cut is taken whole.

    Rows get their copies by id, source and key, so that rows that share an id, or have none, each take their own. Rows equal in all three
    follow each other in the mix; only where a source's cut lies among such rows do their copies differ. All of them then
    take the lesser number, and one of them what remains.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", _key(seed).alias("key")
    )
    groups = _mixed(docs, seed, weights, most_epochs).groupBy(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("key").alias("_key")
    ).agg(F.min("copies").alias("least"), (F.sum("copies") - F.count("*") * F.min("copies")).cast("int").alias("more"))
    groups = written(groups, "copies")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("key") == F.col("_key"))

    def repeated(table: DataFrame, times: str) -> DataFrame:
        return table.select("row", F.explode(F.sequence(F.lit(1), times)).alias("_copy")).select("row.*")

    each = repeated(rows.join(groups.where("least > 0").hint("merge"), same), "least")
    # At most one group of a source.
    cut = rows.join(groups.where("more > 0"), same).groupBy("_id", "_source", "_key").agg(F.first("row").alias("row"), F.first("more").alias("more"))
    return each.unionByName(repeated(cut, "more"))
