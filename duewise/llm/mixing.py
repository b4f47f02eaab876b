"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Each source's documents are put in the order of a hash of their id, sizes are added up along that
order (range partitions add up their own rows, only the few partition totals are added up across),
and the order is cut where the source's budget ends, to the word. A budget beyond the source's size
takes it whole, as often as it fits, and cuts the next round.

Targets: sources by code point, null last, weigh 5, 2, 1, 5, 2, 1, ...; together they get 150 % of
all words, none above twice its own, the excess shared among the others by weight.

Defined results: a null or empty text has size 0 and nothing is taken of it; an empty table gives an
empty result. Repeated rows follow one another in the order and each counts. A null doc_id comes
first. Other columns are neither read nor changed, except that the pipeline's stage returns them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise.operators.ordering import running
from duewise.session import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2


def word_count(text: Column) -> Column:
    """Number of words parted by \\x20 and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_key(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit("mix-"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """Per source: source_size and target. ``sizes`` has source and size.

    The excess of full sources is shared again until none is above its limit; each look adds up one
    row per source, so the driver holds sums only.
    """
    totals = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running(totals, [F.col("source").asc_nulls_last()], position="rank")
    kind = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = staged(ranked.select("source", "source_size", kind.cast("long").alias("weight")), "weights")
    wanted = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    per_weight = 0.0
    while True:
        full = epochs * F.col("source_size") < F.col("weight") * F.lit(per_weight)
        sums = ranked.agg(
            F.sum(F.when(full, epochs * F.col("source_size")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not sums.open:
            break
        now = (wanted - sums.full) / sums.open
        if now <= per_weight:
            break
        per_weight = now
    target = F.least((epochs * F.col("source_size")).cast("double"), F.col("weight") * F.lit(per_weight))
    return ranked.select("source", "source_size", target.alias("target"))


def _placed(documents: DataFrame) -> DataFrame:
    """doc_id, source, mark of the text, size, and the words up to each in its source's order.

    Documents are dealt out by ranges of (source, random key) and add up their own words; the totals
    of the parts, a row per part and source, are added up and set before. Copies follow one another.
    """
    spark = documents.sparkSession
    sized = documents.select("doc_id", "source", F.xxhash64("text").alias("mark"), word_count(F.col("text")).alias("size"))
    # Range bounds and rows are two reads, so a row's number has to be the same in both.
    keyed = staged(sized, "sizes").withColumns({"_key": random_key(F.col("doc_id")), "_copy": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("_key", "doc_id", "size", "mark", "_copy")]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = keyed.repartitionByRange(parts, F.col("source").asc_nulls_first(), *order).withColumn("_part", F.spark_partition_id())
    so_far = Window.partitionBy("_part", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = staged(dealt.withColumn("_inside", F.sum("size").over(so_far)).drop("_key", "_copy"), "placed")
    totals = inside.groupBy(F.col("_part").alias("_in"), F.col("source").alias("_of")).agg(F.sum("size").alias("_total"))
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    ahead = staged(totals.select("_in", "_of", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_ahead")), "ahead")
    joined = inside.join(ahead, (F.col("_part") == F.col("_in")) & F.col("source").eqNullSafe(F.col("_of")))
    return joined.withColumn("up_to", F.col("_ahead") + F.col("_inside")).drop("_part", "_inside", "_in", "_of", "_ahead")


def _taken(placed: DataFrame, weights, share: float, epochs: int) -> DataFrame:
    """``placed`` with source_size, target and taken."""
    targets = staged(source_targets(placed, weights, share, epochs), "targets")
    # One row per source; Spark broadcasts it where its written size is small, else shuffles.
    joined = placed.join(targets.withColumnRenamed("source", "_source"), F.expr("source <=> _source")).drop("_source")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.floor(F.col("target")) - rounds * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - (F.col("up_to") - F.col("size"))))
    return joined.withColumn("taken", (rounds * F.col("size") + part).cast("long"))


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target and taken, one row per row of ``documents``."""
    return _taken(_placed(documents), weights, share, epochs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """The documents that the mix takes, all columns, each row as often as that row is taken.

    A document that the cut goes through stays whole, one a source at most. Rows that agree in doc_id,
    source and text follow one another in the order, so all of them are taken alike, unless the cut
    goes through them: then as many of them, whichever, are taken once more as the cut leaves before it.
    """
    key = ["doc_id", "source", "mark"]
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = _taken(_placed(documents), weights, share, epochs).where("size > 0").groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(
        F.min(times).alias("_least"), F.max(times).alias("_most"), F.count_if(times == F.lit(1) + F.floor(F.col("target") / F.col("source_size"))).alias("_above")
    ).where("_most > 0")
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), "doc_id", "source", F.xxhash64("text").alias("mark"))
    met = rows.join(taken, (F.col("doc_id").eqNullSafe(F.col("_doc_id"))) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("mark") == F.col("_mark")))
    alike = met.where("_least = _most").withColumn("_times", F.col("_most"))
    # One set of equal rows a source at most.
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    parted = met.where("_least < _most").withColumn("_times", F.when(place <= F.col("_above"), F.col("_most")).otherwise(F.col("_least")))
    return alike.unionByName(parted).where("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_time")).select("_row.*")
