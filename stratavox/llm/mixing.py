"""Mixing sources to target weights by a low-discrepancy schedule.

A mix is a row of slots of ``BLOCK`` words each. Slot i has the van der Corput point of i (its bits reversed), and
the point falls into a source's share of the cumulative weights; so every stretch of the schedule holds the sources
nearly in proportion, and the whole of it exactly. The slots of a source are ranked, and the k-th one takes the
k-th block of its source: documents in an order shuffled by digest, their words laid end to end and cut into
blocks of equal length, begun anew when the source is used up. A source's last slot stops at its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_unique, read, spill

#: Weights of the sources in order of code points, repeating.
WEIGHTS = (3, 1, 2)
#: Words of a slot.
BLOCK = 1024
#: What the mix holds, and what a source gives at most, in parts of all words and of its own.
SHARE, MOST = 1.5, 2
#: A range of the cumulative weights that slots and sources meet in; so many for each source, and at least so many.
RANGES, LEAST_RANGES = 4, 4096

WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, doc_id, none, source, size, key): a written row for each document; key is its place in the shuffle."""
    doc, size = docs[id_col].cast("long"), F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(doc.alias("doc_id"), docs[source_col].isNull().alias("none"), F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("source"), size.alias("size"))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    return spill(rows.withColumn("key", key).withColumn("row", F.monotonically_increasing_id()))


def before(rows: DataFrame, order: list[str], **sums: str) -> DataFrame:
    """rows with the sums of columns over all rows before them in the given order (name=column).

    Rows are dealt into ranges of the order; a range adds the totals of those before it, so no task holds more
    than its range.
    """
    parts = spill(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])  # a row for each range
    ranges = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = total.select("_part", *[F.coalesce(F.sum(f"_{n}").over(ranges), F.lit(0)).alias(f"_{n}") for n in sums])
    out = parts.join(F.broadcast(starts), "_part")
    return out.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{n}") for n, c in sums.items()}).drop("_part", *[f"_{n}" for n in sums])


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(none, source, n, source_size, words_before, weight, target) of every source, by the sizes of rows.

    Targets share ``share`` times all words by weight. A source stops at MOST times its own words; the ones that stop
    are those of least size for their weight, and what they leave goes to the others by weight.
    """
    one = rows.groupBy("none", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).withColumn("_one", F.lit(1).cast("long"))
    ranked = before(one, ["none", "source"], n="_one", words_before="source_size").drop("_one")
    by_weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    dealt = before(ranked.withColumn("weight", by_weight).withColumn("cap", F.col("source_size") / F.col("weight")), ["cap", "n"], _size="source_size", _weight="weight")
    dealt = spill(dealt)
    all_words, all_weight = dealt.agg(F.sum("source_size"), F.sum("weight")).first()
    stops = (F.lit(share * (all_words or 0)).cast("double") - MOST * F.col("_size")) * F.col("weight") > (MOST * F.col("source_size")) * (F.lit(all_weight or 0) - F.col("_weight")).cast("double")
    full, gone = dealt.filter(stops).agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    rest = F.lit(share * (all_words or 0) - MOST * full) * F.col("weight") / F.lit(float((all_weight or 0) - gone) or 1.0)
    target = F.when(stops, MOST * F.col("source_size").cast("double")).otherwise(F.least(rest, MOST * F.col("source_size").cast("double")))
    return dealt.select("none", "source", "n", "rows", "source_size", "words_before", "weight", target.alias("target"))


def quotas(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """sources with words (the target in whole words), blocks, slots (how many it fills) and first (its first point)."""
    words = F.floor(F.col("target") + 0.5)
    size = F.greatest("source_size", F.lit(1))
    full = sources.withColumn("words", words).withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn("rounds", F.floor(F.col("words") / size)).withColumn("over", F.col("words") % size)
    return spill(before(full.withColumn("slots", F.col("rounds") * F.col("blocks") + F.ceil(F.col("over") / block)), ["n"], first="slots"))


def reversed_bits(i: Column, bits: int) -> Column:
    """The van der Corput point of i in base 2, in units of 2 ** -bits."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")


def schedule(spark: SparkSession, plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, n, k, block, upto): which source's block each slot takes, and how many words of it at most.

    plan: the sources with their quotas. Points and shares of the cumulative weights meet in an equi-join on ranges of
    equal width, so a source of a large share is spread over many.
    """
    total, many = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    bits = max(total - 1, 0).bit_length()
    shift = max(0, bits - max(RANGES * many, LEAST_RANGES).bit_length())
    points = spark.range(1 << bits).select(F.col("id").alias("slot"), reversed_bits(F.col("id"), bits).alias("p")).filter(F.col("p") < total)
    last = F.col("first") + F.col("slots") - 1
    shares = plan.filter("slots > 0").select("n", "first", "slots", "blocks", "rounds", "over", F.explode(F.sequence(F.shiftright("first", shift), F.shiftright(last, shift))).alias("range"))
    met = points.withColumn("range", F.shiftright("p", shift)).join(shares, "range").filter("p >= first AND p < first + slots")
    ranked = before(met.withColumn("_one", F.lit(1).cast("long")), ["n", "slot"], _rank="_one")
    k = ranked.withColumn("k", F.col("_rank") - F.col("first"))  # those of the sources before it are exactly ``first``
    over = F.when((F.col("k") == F.col("slots") - 1) & (F.col("over") > 0), F.col("over") - (F.ceil(F.col("over") / block) - 1) * block).otherwise(block)
    return k.select("slot", "n", "k", (F.col("k") % F.col("blocks")).alias("block"), over.alias("upto"))


def mixed(rows: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, offset, n, k, row, doc_id, start, length): the mix's pieces, each a stretch of a document's words.

    rows: sized documents; sources: their targets. slot and offset order the mix.
    """
    spark = rows.sparkSession
    plan = quotas(sources, block)
    total = sources.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = sources.filter(F.col("rows") * 1000 > total)
    placed = join_unique(rows.filter("size > 0"), sources.select("none", "source", "n", "words_before"), hot, ["none", "source"])
    laid = before(placed, ["n", "key", "size", "row"], _before="size").withColumn("at", F.col("_before") - F.col("words_before"))
    end = F.col("at") + F.col("size")
    cut = laid.select("row", "doc_id", "n", "at", end.alias("end"), F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((end - 1) / block))).alias("block"))
    low = F.greatest(F.col("at"), F.col("block") * block)
    high = F.least(F.col("end"), (F.col("block") + 1) * block)
    pieces = cut.select("n", "block", "row", "doc_id", (low - F.col("block") * block).alias("offset"), (low - F.col("at")).alias("start"), (high - low).alias("length"))
    met = pieces.join(schedule(spark, plan, block), ["n", "block"])
    length = F.least(F.col("length"), F.col("upto") - F.col("offset"))
    return met.withColumn("length", length).filter("length > 0").select("slot", "offset", "n", "k", "row", "doc_id", "start", "length")


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of docs.

    A null text has no words; without words nothing is taken. Null sources are one source, after all others; null ids
    stay null. Rows that repeat each get their row; of rows equal in id, source and size it makes no difference which
    is first. An empty table gives no rows. Other columns are ignored.
    """
    rows = sized(docs)
    sources = spill(targets(rows, weights, share))
    got = mixed(rows, sources, block).groupBy("row").agg(F.sum("length").alias("taken"))
    total = sources.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = sources.filter(F.col("rows") * 1000 > total)
    named = join_unique(rows, sources.select("none", "source", "source_size", "target"), hot, ["none", "source"])
    return named.join(got, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(read(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source IS NULL AS none, coalesce(source, '') AS source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
w AS (SELECT none, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1, 2),
s AS (SELECT *, ([{", ".join(map(str, WEIGHTS))}])[CAST((row_number() OVER (ORDER BY none, source) - 1) % {len(WEIGHTS)} + 1 AS INT)] AS weight FROM w),
t AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE} AS whole, sum(weight) OVER () AS weights, coalesce(sum(source_size) OVER p, 0) AS sizes, coalesce(sum(weight) OVER p, 0) AS heavy
  FROM s WINDOW p AS (ORDER BY CAST(source_size AS DOUBLE) / weight, none, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT *, (whole - {MOST} * CAST(sizes AS DOUBLE)) * weight > {MOST} * CAST(source_size AS DOUBLE) * CAST(weights - heavy AS DOUBLE) AS stops FROM t),
v AS (SELECT none, source, source_size, CASE WHEN stops THEN {MOST} * CAST(source_size AS DOUBLE) ELSE
  (whole - {MOST} * CAST(coalesce(sum(source_size) FILTER (stops) OVER (), 0) AS DOUBLE)) * weight / CAST(weights - coalesce(sum(weight) FILTER (stops) OVER (), 0) AS DOUBLE) END AS target FROM u),
x AS (SELECT doc_id, size, source_size, least(target, {MOST} * CAST(source_size AS DOUBLE)) AS target, CAST(floor(least(target, {MOST} * CAST(source_size AS DOUBLE)) + 0.5) AS BIGINT) AS words,
  CAST(sum(size) OVER (PARTITION BY none, source ORDER BY md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), size)), size, r) - size AS BIGINT) AS low FROM d JOIN v USING (none, source))
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE words // source_size * size + greatest(0, least(low + size, words % source_size) - low) END AS taken FROM x
"""
