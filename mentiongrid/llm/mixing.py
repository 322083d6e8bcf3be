r"""Mixing sources to target weights, in DataFrame functions only.

1. *Targets.* Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and share all words. A
   target stops at `repeats` times its source's size; the excess is shared again by weight. Sorted
   by cap over weight the capped sources come first, so running sums give the final level at once.
2. *Blocks.* The documents of a source, in a pseudorandom order, make one stream of words that is cut
   into blocks of at most `block_words`, at least `MIN_BLOCKS` for a source of so many words; the blocks of a source
   differ by one word at most, so a quota of blocks is a share of words. Positions come from sums per bucket of documents, then within it.
3. *Draws.* Each output shard of `shard_slots` slots draws a source per slot by a hash, that is, one
   multinomial sample of source counts per shard. Free draws would wander from the targets and
   break the bound of `repeats`, so draws of a source beyond its quota are handed, in order,
   to the sources that stayed below theirs.
4. *Slots to blocks.* The j-th draw of a source takes epoch j div n and block
   permutation(source, epoch)(j mod n) of its n blocks. The permutation is a swap-or-not shuffle: in each
   round x and key - x modulo n change places or not, by a hash of the larger one, so any n
   works without a table. Hence every block is taken floor or ceil of quota / n times.
5. *Join by index.* Slots meet blocks on (source, block).

A hot source is no hot key: streams are summed per bucket, and joins use (source, block).

Defined results: null and empty texts have size 0 and are never taken. Null sources are one source,
last in order. A source without words has target 0; an empty table gives no rows. Documents that
agree in doc_id and size follow each other in an arbitrary order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentiongrid.llm.common import WORD, table
from mentiongrid.session import materialise

ROUNDS = 24
_PER_BUCKET = 2000
#: Blocks of a source that has that many words, so that small sources meet their targets too.
MIN_BLOCKS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, repeats: int = 3, cycle: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, weight, target).

    One small row per source, so its windows need no partitioning.
    """
    everything = Window.partitionBy()
    in_order = everything.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.select("*", ((F.row_number().over(in_order) - 1) % cycle + 1).cast("double").alias("weight"))
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    capped = weighed.withColumn("cap", repeats * F.col("source_size").cast("double"))
    levels = capped.select(
        "*",
        (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("rest"),
        F.sum("weight").over(onward).alias("open"),
    ).withColumn("stops", F.col("cap") * F.col("open") <= F.col("weight") * F.col("rest"))
    # Beyond the first source that does not stop none does; its level holds for the rest.
    level = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "rest", "open"))).over(everything)
    return levels.select(
        "source", "source_size", "weight",
        F.when(F.col("stops"), F.col("cap")).otherwise(F.col("weight") * level["rest"] / level["open"]).alias("target"),
    )


def streams(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size) with `first`, the place of the first word in the source's stream."""
    n_buckets = F.greatest(F.lit(1), F.ceil(documents.select(F.count("*") / _PER_BUCKET).scalar()))
    placed = documents.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), n_buckets))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.withColumn("offset", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("d")
    s = starts.alias("s")
    same = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bucket") == F.col("s.bucket"))
    return offset.join(s, same).select("d.doc_id", "d.row_id", "d.source", "d.size", (F.col("offset") + F.col("start")).alias("first"))


def _hash_unit(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def permuted(x: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 chosen by `key`, applied to x."""

    def turn(x: Column, k: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, k), n) - x, n)
        swap = F.xxhash64(F.greatest(x, partner), key, k) % 2 != 0
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, turn)


def draws(quotas: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(rank, n_blocks, quota) of each source to slots (shard, rank, j): the j-th draw of the source."""
    spark = quotas.sparkSession
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]  # one number
    # The sources are few; their cumulative shares travel as one sorted array.
    upto = Window.partitionBy().orderBy("rank")
    whole = F.nullif(F.sum("quota").over(Window.partitionBy()), F.lit(0))
    shares = quotas.select((F.sum("quota").over(upto) / whole).alias("upto"), "rank")
    steps = shares.select(F.array_sort(F.collect_list(F.struct("upto", "rank")))).scalar()
    # Few rows that become many: spread by number, which adaptive execution leaves alone.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = spark.range(-(-total // shard_slots), numPartitions=spread).withColumnRenamed("id", "shard")
    slots = shards.select("shard", F.explode(F.sequence(F.lit(0), F.least(F.lit(shard_slots), F.lit(total) - F.col("shard") * shard_slots) - 1)).alias("slot"))
    chance = slots.select("shard", _hash_unit(F.lit(seed), "shard", "slot").alias("u"), steps.alias("steps"))
    drawn = chance.select("shard", F.get(F.filter("steps", lambda s: s["upto"] > F.col("u")), F.lit(0))["rank"].alias("rank"))
    counts = drawn.groupBy("shard", "rank").count()
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("from", F.coalesce(F.sum("count").over(earlier), F.lit(0))).join(quotas, "rank")
    upper = F.least(F.col("from") + F.col("count"), F.col("quota"))
    kept = runs.where(F.col("from") < F.col("quota")).repartition(spread, "shard", "rank").select("shard", "rank", F.explode(F.sequence("from", upper - 1)).alias("j"))
    # Draws beyond a quota, numbered through, go to the open places of the other sources.
    over = runs.withColumn("spare", F.col("from") + F.col("count") - F.greatest("from", "quota")).where("spare > 0")
    reached = counts.groupBy("rank").agg(F.sum("count").alias("drawn"))
    short = quotas.join(reached, "rank", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).where(F.col("drawn") < F.col("quota"))
    free = _numbered(over.select("shard", F.explode(F.sequence(F.lit(1), "spare"))), "shard")
    needed = _numbered(short.select("rank", F.explode(F.sequence("drawn", F.col("quota") - 1)).alias("j")), "rank", "j")
    return kept.unionByName(needed.join(free, "n").select("shard", "rank", "j"))


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Numbers what the draws missed by: about the square root of the number of slots."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy().orderBy(*order)))


def mix(documents: DataFrame, block_words: int = 64, shard_slots: int = 4096, repeats: int = 3, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix of rows (doc_id, text, source).

    Gives its slots (shard, source, block, epoch) and, per document, how many words they take.
    """
    sized = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row_id"))
    sized = materialise(sized, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())).cast("long")
    size = F.col("source_size")
    blocked = targets(sizes, repeats).select(
        "*", rank.alias("rank"), F.greatest(F.ceil(size / block_words), F.least(size, F.lit(MIN_BLOCKS).cast("long"))).alias("n_blocks")
    )
    # No source with a target leaves the mix by rounding.
    wanted = F.greatest(F.round(F.col("target") * F.col("n_blocks") / size).cast("long"), F.lit(1).cast("long"))
    quota = F.when((size > 0) & (F.col("target") > 0), F.least(wanted, repeats * F.col("n_blocks"))).otherwise(F.lit(0).cast("long"))
    sources = materialise(blocked.withColumn("quota", quota), "mix-sources")
    quotas = sources.select("rank", "n_blocks", "quota")
    n, j = F.col("n_blocks"), F.col("j")
    slots = draws(quotas, shard_slots, seed).join(quotas, "rank").withColumn("epoch", F.floor(j / n))
    slots = slots.select("shard", "rank", "epoch", permuted(F.pmod(j, n), n, F.xxhash64(F.lit(seed), "rank", "epoch")).alias("block"))
    used = slots.groupBy("rank", "block").count()
    known = sources.withColumnRenamed("source", "src")
    placed = streams(sized).join(F.broadcast(known) if _few(known) else known, F.col("source").eqNullSafe(F.col("src")))
    # The first `larger` blocks of a source have one word more than the others.
    least = F.expr("source_size div greatest(n_blocks, 1)")
    larger = F.expr("source_size % greatest(n_blocks, 1)")
    placed = placed.where("size > 0").withColumn("least", least).withColumn("larger", larger)

    def block_of(word: str) -> Column:
        return F.expr(
            f"if({word} < larger * (least + 1), ({word}) div (least + 1), larger + ({word} - larger * (least + 1)) div greatest(least, 1))"
        )

    def start_of(block: Column) -> Column:
        return block * F.col("least") + F.least(block, F.col("larger"))

    pieces = placed.select(
        "row_id", "rank", "first", "size", "least", "larger", F.explode(F.sequence(block_of("first"), block_of("first + size - 1"))).alias("block")
    )
    words = F.least(F.col("first") + F.col("size"), start_of(F.col("block") + 1)) - F.greatest(F.col("first"), start_of(F.col("block")))
    taken = pieces.join(used, ["rank", "block"]).groupBy("row_id").agg(F.sum(words * F.col("count")).alias("taken"))
    per_document = (
        sized.join(taken, "row_id", "left")
        .join(F.broadcast(known) if _few(known) else known, F.col("source").eqNullSafe(F.col("src")))
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    )
    return slots.join(sources, "rank").select("shard", "source", "block", "epoch"), per_document


def _few(sources: DataFrame, most: int = 20_000) -> bool:
    """Whether the table of sources, one short row each, is proven small enough to broadcast."""
    return sources.limit(most + 1).count() <= most


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))[1].drop("source")


QUERIES = {"op6_source_mix": op6_source_mix}
SQL: dict[str, str] = {}
