"""Mixing sources to target weights by a low-discrepancy source schedule.

Every source's documents are shuffled and laid end to end on a line of words, pass after pass, which is cut into
blocks of equally many words. A schedule of slots gives each slot a golden-ratio point; the cumulative weights map the
point to a source, and the slot's rank within its source names the block that it takes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.llm.common import cut, n_words, read_table

#: Golden-ratio points as integers: slot i lies at i * STEP mod PERIOD, STEP / PERIOD being 0.618034.
PERIOD, STEP = 1 << 31, 1327217885
#: Cells by which points meet the sources' shares of the unit interval.
CELL_BITS = 19
#: Slots that one task ranks; documents of a source are laid out by so many hash buckets.
CHUNK, BUCKETS_HEX = 1 << 16, 3


def source_key(source: str) -> Column:
    """A join key that holds null apart from every text."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("-"))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(_src, source, source_size, target): ``share`` of all sizes divided by weight, none above ``most`` times its
    source's size, the excess reshared by weight until none is above.

    Sources in code-point order, null last, take the weights in turn. The reshared fixed point is found in one pass:
    by rising size / weight the capped sources come first, and the level of the others follows from running sums.
    """
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("_ratio", "_src")
    per = (sizes.groupBy("_src", "source").agg(F.sum("size").alias("source_size"))
           .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
           .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
           .withColumn("_ratio", F.col("_cap") / F.col("_w")))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    level = ((total - (F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap")))
             / (F.sum("_w").over(Window.partitionBy())
                - F.sum("_w").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_w")))
    free = F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_src", "_level"))
    return (per.withColumn("_level", level)
            .withColumn("_free", F.min(free).over(Window.partitionBy()))
            .select("_src", "source", "source_size", F.least(
                F.col("_cap"), F.coalesce(F.col("_w") * F.col("_free._level"), F.col("_cap"))).alias("target")))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """(slot, _src, block): slots by golden-ratio points, then a few closing slots of sources that the points left
    short, so that every source has slots for just the blocks up to its last word.

    Slots are ranked within their source in chunks: each chunk is counted first, so that no task ranks a whole source.
    """
    words = F.sum("limit").over(Window.partitionBy())
    upto = F.sum("limit").over(Window.orderBy("_src").rowsBetween(Window.unboundedPreceding, 0))
    shares = cut(targets.where("limit > 0")
                 .withColumn("needed", F.ceil(F.col("limit") / F.lit(block_words)).cast("long"))
                 .withColumn("_rank", F.row_number().over(Window.orderBy("_src")))
                 .withColumn("_hi", F.floor(upto / words * F.lit(PERIOD)).cast("long"))
                 .withColumn("_lo", F.floor((upto - F.col("limit")) / words * F.lit(PERIOD)).cast("long")))
    n = shares.agg(F.ceil(F.sum("limit") / F.lit(block_words))).first()[0] or 0
    spark = targets.sparkSession
    points = (spark.range(0, int(n), numPartitions=max(1, math.ceil(n / (16 * CHUNK)))).withColumnRenamed("id", "slot")
              .withColumn("_u", (F.col("slot") % PERIOD) * F.lit(STEP) % F.lit(PERIOD))
              .withColumn("_cell", F.shiftright("_u", CELL_BITS)))
    cells = shares.where("_hi > _lo").select("_src", "_lo", "_hi", F.explode(F.sequence(
        F.shiftright("_lo", CELL_BITS), F.shiftright(F.col("_hi") - 1, CELL_BITS))).alias("_cell"))
    drawn = (points.join(cells, "_cell").where("_u >= _lo and _u < _hi")
             .select("slot", "_src", F.floor(F.col("slot") / F.lit(CHUNK)).alias("_chunk")))
    before = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = drawn.groupBy("_src", "_chunk").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = (drawn.join(chunks.drop("_n"), ["_src", "_chunk"])
              .withColumn("block", F.col("_before") + F.row_number().over(
                  Window.partitionBy("_src", "_chunk").orderBy("slot")) - 1)
              .join(shares.select("_src", "needed"), "_src").where("block < needed").select("slot", "_src", "block"))
    got = chunks.groupBy("_src").agg(F.sum("_n").alias("_got"))
    closing = (shares.join(got, "_src", "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
               .where("_got < needed")
               .select("_src", "_rank", "_got", F.explode(F.expr("sequence(_got, needed - 1)")).alias("block"))
               .select((F.lit(int(n)) + (F.col("block") - F.col("_got")) * F.lit(1 << 20) + F.col("_rank")).alias(
                   "slot"), "_src", "block"))
    return ranked.unionByName(closing)


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=(5, 2, 1),
        share: float = 1.5, most: float = 2.0, block_words: int = 256, seed: str = "mix") -> DataFrame:
    """The mix: a row for each piece of a document in a slot, and one without slot for a document that isn't drawn.

    Columns: _row (bucket and number of the document within it, unique with _src), doc_id, text_hash, source, size, source_size,
    target, slot, block, pass (0: first time through its source), first_word and n_words (0 without slot) of the piece.

    Null texts have size 0, a null source is a source of its own (last); repeated rows count one by one; other columns
    of ``df`` are not used. An empty table gives no rows. A target's words are drawn up to the next whole word. The
    order depends on ``seed``, ids and sizes alone, so reruns and retried tasks agree.
    """
    base = cut(df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        F.col(source).alias("source"), n_words(text).alias("size"))
               .withColumn("_src", source_key("source")))
    targets = cut(source_targets(base, weights, share, most).withColumn("limit", F.least(
        F.ceil(F.col("target") - F.lit(0.001)), F.floor(F.col("source_size") * F.lit(float(most)))).cast("long")))
    line = (base.withColumn("_key", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
        .withColumn("_bucket", F.substring("_key", 1, BUCKETS_HEX)))
    ahead = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (line.groupBy("_src", "_bucket").agg(F.sum("size").alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n"))
    order = Window.partitionBy("_src", "_bucket").orderBy("_key", "doc_id", "size", "text_hash")
    # a document of each source meets its source's figures; one row a source, joined by hash or as AQE sees its size
    placed = (line.join(offsets, ["_src", "_bucket"])
              .withColumn("_start", F.col("_offset") + F.sum("size").over(
                  order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
              .withColumn("_row", F.struct("_bucket", F.row_number().over(order).alias("n")))
              .join(targets.drop("source"), "_src"))
    passes = F.array(*[F.lit(i) for i in range(math.ceil(most))])
    at = F.col("_start") + F.col("pass") * F.col("source_size")
    pieces = (placed.withColumn("pass", F.explode(passes))
              .withColumn("_from", at).withColumn("_to", F.least(at + F.col("size"), F.col("limit")))
              .withColumn("_drawn", F.col("_to") > F.col("_from")).where("_drawn or pass = 0")
              .withColumn("block", F.explode(F.when(F.col("_drawn"), F.sequence(
                  F.floor(F.col("_from") / F.lit(block_words)), F.floor((F.col("_to") - 1) / F.lit(block_words)))
              ).otherwise(F.array(-1 - F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))))))
              .withColumn("_first", F.greatest("_from", F.col("block") * block_words))
              .withColumn("n_words", F.when(F.col("_drawn"), F.least(
                  F.col("_to"), (F.col("block") + 1) * block_words) - F.col("_first")).otherwise(F.lit(0)))
              .withColumn("first_word", F.col("_first") - F.col("_from")))
    slots = schedule(targets, block_words)
    return pieces.join(slots, ["_src", "block"], "left").select(
        "_src", "_row", "doc_id", "text_hash", "source", "size", "source_size", "target", "slot", "block", "pass",
        F.when(F.col("slot").isNotNull(), F.col("first_word")).alias("first_word"),
        F.when(F.col("slot").isNotNull(), F.col("n_words")).otherwise(F.lit(0)).alias("n_words"))


def mixed_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    **options) -> DataFrame:
    """``df``'s rows as often as the mix takes them, all columns, texts whole: a source ends at the boundary of documents
    nearest to its target, so of the document that the target falls into all is taken or, if less than half of its words
    lie before the target, nothing.

    Null and empty texts have no words and are left out, as are rows of which the mix takes none; a null id or source is
    as good as any; repeated rows each have their share. An empty table gives no rows.
    """
    drawn = (mix(df, doc_id, text, source, **options).groupBy("_src", "_row", "doc_id", "text_hash", "pass", "size")
             .agg(F.sum("n_words").alias("_taken")).where("_taken > 0 AND 2 * _taken >= size"))
    one = ["doc_id", "text_hash"]
    # rows equal in id and text are numbered on both sides, so that each meets its own share
    copies = (drawn.groupBy("_src", "_row", *one).agg(F.count("*").alias("_times"))
              .withColumn("_n", F.row_number().over(Window.partitionBy(*one).orderBy("_row"))))
    mine = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"), F.col(doc_id).alias("_id"),
                     F.xxhash64(text).alias("_hash")).withColumn(
        "_m", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(0))))
    met = mine.join(copies, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")) & (
        F.col("_m") == F.col("_n")))
    return met.select("_all", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_all.*")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix(read_table(spark, sf_dir, "documents"))
            .groupBy("_src", "_row", "doc_id", "size", "source_size", "target")
            .agg(F.sum("n_words").cast("long").alias("taken"), F.coalesce(F.min("slot"), F.lit(-1)).alias("first_slot"),
                 F.count("slot").alias("n_slots"))
            .select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
      2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY cap / w, source) AS k FROM w),
l AS (SELECT a.source, a.k, a.cap, a.w, a.source_size,
      ((SELECT sum(source_size) * 1.5::DOUBLE FROM r) - coalesce((SELECT sum(cap) FROM r b WHERE b.k < a.k), 0))
      / (SELECT sum(w) FROM r b WHERE b.k >= a.k) AS level FROM r a),
t AS (SELECT source, source_size,
      least(cap, w * (SELECT level FROM l x WHERE x.cap / x.w > x.level ORDER BY k LIMIT 1)) AS target FROM l),
u AS (SELECT *, least(ceil(target - 0.001)::BIGINT, 2 * source_size)::BIGINT AS lim,
      CASE WHEN source IS NULL THEN '-' ELSE 's' || source END AS src FROM t),
h AS (SELECT src, ceil(lim / 256.0)::BIGINT AS needed, row_number() OVER (ORDER BY src) AS rk,
      floor(sum(lim) OVER (ORDER BY src)::DOUBLE / (SELECT sum(lim) FROM u)::DOUBLE * 2147483648)::BIGINT AS hi,
      floor((sum(lim) OVER (ORDER BY src) - lim)::DOUBLE / (SELECT sum(lim) FROM u)::DOUBLE * 2147483648)::BIGINT AS lo
      FROM u WHERE lim > 0),
n AS (SELECT ceil(sum(lim) / 256.0)::BIGINT AS n FROM u),
g AS (SELECT i AS slot, (i % 2147483648) * 1327217885 % 2147483648 AS spot FROM (SELECT unnest(range(n)) AS i FROM n)),
k AS (SELECT slot, src, needed, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS block
      FROM g JOIN h ON spot >= lo AND spot < hi),
c AS (SELECT src, rk, needed, (SELECT count(*) FROM k WHERE k.src = h.src) AS got FROM h),
e AS (SELECT slot, src, block FROM k WHERE block < needed
      UNION ALL SELECT (SELECT n FROM n) + (block - got) * 1048576 + rk, src, block
      FROM (SELECT *, unnest(range(got, needed)) AS block FROM c WHERE got < needed)),
p AS (SELECT row_number() OVER () AS i, d.doc_id, d.size, t.source_size, t.target, t.src, lim,
      sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id::VARCHAR), d.doc_id
                        ROWS UNBOUNDED PRECEDING) - d.size AS a
      FROM d JOIN u t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT i, src, a + z * source_size AS x, least(a + z * source_size + size, lim) AS y FROM p, range(2) r(z)),
v AS (SELECT i, src, unnest(range((x // 256)::BIGINT, ((y - 1) // 256 + 1)::BIGINT)) AS block FROM q WHERE y > x),
o AS (SELECT i, min(slot) AS first_slot, count(*) AS n_slots FROM v JOIN e USING (src, block) GROUP BY i)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(lim, a + size) - a)
        + greatest(0, least(lim, a + source_size + size) - a - source_size))::BIGINT AS taken,
       coalesce(first_slot, -1) AS first_slot, coalesce(n_slots, 0) AS n_slots FROM p LEFT JOIN o USING (i)
"""
