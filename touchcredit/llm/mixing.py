"""Mixing sources to target weights: a low-discrepancy schedule over equal-token blocks (DataFrame functions only).

Each source's documents are shuffled by the MD5 of their id into one stream of
words, cut into blocks of ``block_words``. A golden-ratio sequence assigns each
slot of the mix to a source by cumulative target share; the r-th slot of a
source takes that source's r-th block, starting over when the stream ends. So
any stretch of the schedule is close to the target weights.

Hot sources: prefix sums and ranks run per (source, range of the shuffle key)
and per (source, range of slots), with one small table of range totals on top,
so no window holds a whole source.

Defined cases: null text has size 0, a null source is the last source, null or
repeated ids are ordinary rows (rows equal in id, size and source are
interchangeable), an empty table gives an empty result, columns other than the
id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchcredit.llm.common import WORD_PATTERN, Workspace

GOLDEN = 0.6180339887498949
BLOCK_WORDS = 4096
MAX_EPOCHS = 3
#: Rows per range of the shuffle key, and slots per range of the schedule.
RANGE_ROWS = 20_000
RANGE_SLOTS = 50_000


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def shuffle_key(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, shuffle key) of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(text_col).alias("size"),
        shuffle_key(id_col).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn. A target is
    its weight's share of all words but at most ``max_epochs`` times its
    source; what is cut off goes to the others by weight. The result is a water
    level: with sources in rising order of cap / weight, the first one whose
    level (words left / weight left) does not pass its cap fixes the level of
    the rest. The windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    w = sizes.select("source", "source_size", (F.lit(max_epochs) * F.col("source_size")).alias("cap"),
                     pick.cast("long").alias("weight"))
    rising = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"))
    w = w.select("source", "source_size", "cap", "weight", level.alias("level"))
    reached = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # levels rise while sources are capped and never rise after, so the first reached level is the highest
    w = w.withColumn("water", F.max(reached).over(every))
    return w.select("source", "source_size",
                    F.least(F.col("water") * F.col("weight"), F.col("cap").cast("double")).alias("target"))


def stream(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Documents with ``start``, their place in their source's shuffled stream of words."""
    total = docs.count()
    ranges = max(1, min(1 << 24, -(-total // RANGE_ROWS)))
    # ranges of the key in key order, so that the order over all ranges is that of the key
    docs = docs.withColumn("range", F.floor(
        F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(1 << 32)).cast("long"))
    sums = docs.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of_source"), F.col("range").alias("of_range"),
                       F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    placed = docs.select("doc_id", "source", "size", "range", F.row_number().over(inside).alias("place"),
                         (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("inner"))
    joined = placed.join(sums, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("range") == F.col("of_range")))
    return joined.select("doc_id", "source", "size", "range", "place", (F.col("offset") + F.col("inner")).alias("start"))


def schedule(quota: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix's slots: (slot, source, rank, epoch, block, words).

    ``quota``: (source, source_size, target). A source needs as many slots as
    its target fills blocks; its last block of a pass and of the mix may be
    short. Golden-ratio points through the cumulative slot shares place the
    slots; the few slots by which a source's count misses its quota at the end
    of the sequence (the sequence's discrepancy, logarithmic in its length) are
    appended, so every source takes exactly floor(target) words.
    """
    q = quota.filter("target >= 1").select(
        "source", "source_size", F.floor("target").alias("want"), F.ceil(F.col("source_size") / block_words).alias("blocks"))
    q = q.withColumn("passes", F.floor(F.col("want") / F.col("source_size")))
    q = q.withColumn("slots", F.col("passes") * F.col("blocks")
                     + F.ceil((F.col("want") - F.col("passes") * F.col("source_size")) / block_words))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    q = (q.withColumn("hi", F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("lo", F.col("hi") - F.col("slots")).withColumn("all", F.sum("slots").over(every)))
    # a point x in [0, all) belongs to the source with lo <= x < hi: one sorted lookup per slot,
    # in an array of one entry per source (bounded like the weights table itself)
    table = q.agg(F.max("all").alias("all"), F.sort_array(F.collect_list(F.struct("hi", "source"))).alias("steps"))
    n = table.select(F.coalesce(F.col("all"), F.lit(0)).cast("long")).first()[0]
    spark = quota.sparkSession
    slots = spark.range(0, n, 1, max(1, -(-n // RANGE_SLOTS))).withColumnRenamed("id", "slot")
    x = (F.col("slot") + 1) * F.lit(GOLDEN)
    point = (x - F.floor(x)) * F.lit(float(n))
    slots = (slots.crossJoin(F.broadcast(table.select("steps")))       # one row: the steps of all sources
             .select("slot", F.floor(F.col("slot") / RANGE_SLOTS).alias("part"),
                     F.filter("steps", lambda s: point < s["hi"])[0]["source"].alias("source")))
    counts = slots.groupBy("source", "part").count()
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("of"), F.col("part").alias("of_part"),
                           F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    ranked = (slots.withColumn("here", F.row_number().over(Window.partitionBy("source", "part").orderBy("slot")))
              .join(counts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
              .select("slot", "source", (F.col("ahead") + F.col("here") - 1).alias("rank")))
    got = ranked.groupBy(F.col("source").alias("of")).count()
    more = (q.join(got, F.col("source").eqNullSafe(F.col("of")), "left")
            .filter(F.coalesce(F.col("count"), F.lit(0)) < F.col("slots"))
            .select("source", F.explode(F.sequence(F.coalesce(F.col("count"), F.lit(0)), F.col("slots") - 1)).alias("rank"))
            .select((F.lit(n) + F.col("rank")).alias("slot"), "source", "rank"))
    ranked = ranked.unionByName(more)
    facts = q.select(F.col("source").alias("of"), "source_size", "want", "blocks", "slots")
    slot = (ranked.join(facts, F.col("source").eqNullSafe(F.col("of"))).filter(F.col("rank") < F.col("slots"))
            .withColumn("epoch", F.floor(F.col("rank") / F.col("blocks")))
            .withColumn("block", F.col("rank") % F.col("blocks")))
    left = F.col("want") - F.col("epoch") * F.col("source_size") - F.col("block") * block_words
    return slot.select("slot", "source", "rank", "epoch", "block",
                       F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words, left).alias("words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs``."""
    ws = Workspace(docs.sparkSession, "mixing")
    base = ws.keep(sized(docs, id_col, text_col, source_col), "sized")
    quota = ws.keep(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "targets")
    slots = schedule(quota, block_words)
    placed = ws.keep(stream(base, ws), "stream")
    # the parts of each document that lie in one block; documents without words have none
    part = (placed.filter("size > 0")
            .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words),
                                                      F.floor((F.col("start") + F.col("size") - 1) / block_words))))
            .withColumn("lo", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
            .withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words))))
    used = slots.select(F.col("source").alias("of"), F.col("block").alias("of_block"), "words")
    got = (part.join(used, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")), "left")
           .withColumn("taken", F.greatest(F.least(F.col("hi"), F.coalesce(F.col("words"), F.lit(0))) - F.col("lo"), F.lit(0))))
    taken = (got.select("doc_id", "source", "size", "range", "place", "taken")
             .unionByName(placed.filter("size = 0").select("doc_id", "source", "size", "range", "place", F.lit(0).cast("long").alias("taken")))
             .groupBy("doc_id", "source", "size", "range", "place").agg(F.sum("taken").cast("long").alias("taken")))
    facts = quota.withColumnRenamed("source", "of")
    return (taken.join(facts, F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))
