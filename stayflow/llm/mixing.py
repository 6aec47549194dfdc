"""Mixing sources to target weights: hash-random order, prefix sums, exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.running import total_before

#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """Targets of the sources in ``totals`` (source, source_size): adds ``target``.

    Weights go round by code point order of the source, NULL last. All sizes together are
    shared by weight; no target exceeds ``max_repeats`` times its source, and what is cut off
    there is shared among the others by weight, until none is above. That is one level for all
    open sources: with sources in order of cap per weight, those are full whose ratio the level
    of the remaining ones reaches. One row per source, so one small window.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    ranked = (
        totals.withColumn("weight", weight)
        .withColumn("cap", F.lit(max_repeats) * F.col("source_size"))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("all_sizes", F.sum("source_size").over(everything))
    )
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levelled = ranked.withColumn(
        "level", (F.col("all_sizes") - full).cast("double") / open_weight
    ).withColumn("is_full", F.col("ratio") <= F.col("level"))
    level = F.max(F.when(~F.col("is_full"), F.col("level"))).over(everything)
    target = F.when(F.col("is_full"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return levelled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    max_repeats: int = 3,
    seed: int = 0,
    bucket_digits: int = 3,
    keep_rows: bool = False,
) -> DataFrame:
    """How often each document goes into a mix whose sources meet their target sizes.

    Returns one row per document: ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target``, ``times``, ``taken`` = times * size, and with ``keep_rows`` the document's
    columns as the struct ``row``. A source is taken whole as often as its target allows; of
    one more round it gives the documents in hash-random order up to the budget that is left,
    the document at the cut if at least half of it fits. The order depends on the id and
    ``seed`` alone, so reruns agree.

    Every source, also a hot one, is divided by the first ``bucket_digits`` hexadecimal digits
    of the random key (4096 parts for 3), and the parts' totals give the prefix sums. NULL
    sources are a source of their own, last in order. NULL and blank texts have size 0 and are
    taken like others but add nothing. Rows that repeat an id follow each other by size. An
    empty table gives an empty table. Other columns are not looked at, whatever their names.
    """
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{seed}")))
    rows = docs.select(
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if keep_rows else []),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        key.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, bucket_digits))
    placed = total_before(
        rows, F.col("size"), ["source"], "bucket", ["key", "doc_id", "size"], "before"
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, max_repeats).withColumnRenamed("source", "of_source")
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0)).cast("long")
    # Where all repeats are used up, not even a document without words is taken once more.
    fits = (F.col("whole") < max_repeats) & (
        F.col("before") + F.col("size") / 2.0 <= target - F.col("whole") * size
    )
    return (
        placed.join(targets, placed["source"].eqNullSafe(targets["of_source"]))
        .withColumn("whole", whole)
        .withColumn("times", F.col("whole") + fits.cast("long"))
        .select(
            *(["row"] if keep_rows else []),
            "doc_id", "source", "size", "source_size", "target", "times",
            (F.col("times") * F.col("size")).alias("taken"),
        )
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    times = F.array_repeat(F.lit(1), F.col("times").cast("int"))
    taken = mix(docs, keep_rows=True, **options).select("row", F.explode(times))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|0') AS key
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS ratio, sum(source_size) OVER () AS all_sizes
  FROM totals),
levelled AS (
  SELECT *, (all_sizes - coalesce(sum(3 * source_size) OVER (
               ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (
               ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (
  SELECT source, source_size,
         CASE WHEN ratio <= level THEN (3 * source_size)::DOUBLE
              ELSE weight * max(CASE WHEN ratio > level THEN level END) OVER () END AS target
  FROM levelled),
placed AS (
  SELECT *, coalesce(sum(size) OVER (
              PARTITION BY source ORDER BY key, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized),
counted AS (
  SELECT p.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) * size)::BIGINT
         AS taken
FROM counted
"""
