"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document draws one exponential key, ``-ln(u) / w``: u comes from a hash of
its identifier, its text and the seed (reruns agree), w is its quality weight.  Within a
source, documents in order of their keys are a weighted sample without
replacement of every length, so the words before a document's place - a prefix
sum - say whether it falls within the budget.

A source's budget is its target.  Whole epochs come first: ``floor(target /
source size)`` copies of every document.  What remains of the target is filled
in key order; a document is taken if at least half of it lies within the
remainder, which keeps the error below half of one document.

Prefix sums need no task that holds a source: rows are range-partitioned by
(source, key), each part is summed, and the sums of the parts before it are
added to the running sum within the part (``prefix_sums``).  A source with a
third of all rows is simply spread over a third of the parts.

Targets.  Sources in code-point order, null last, weigh 1, 2, 3, 1, ... and
share the size of all sources.  A target stops at ``max_epochs`` times its
source's size, and the excess goes to the others by weight: with r = cap /
weight in ascending order, the capped sources are a prefix of that order, and
the share of a unit of weight is (total - their caps) / (weight of the rest).

Defined cases.  Null text has size 0, a source of size 0 target 0, a document
of size 0 takes 0.  Null sources form one source.  Rows that share an
identifier, null or not, draw by their texts; rows that share both draw one key
and are told apart by their places in the input, each taken or not for itself.
An empty table gives an empty result.  Extra columns are never looked at and
come through ``mixed_rows`` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, meet, quoted, staged, table, tagged, words_of

WEIGHT_CYCLE = 3
MAX_EPOCHS = 3
SEED = 7
#: Quality weights: whole-number classes over the share of letters, see quality_weight.
LOW_WEIGHT, MID_WEIGHT, HIGH_WEIGHT = 0.25, 0.5, 1.0
MARKS = "0123456789#*$%&|<>!@=+_~^/\\{}[]\"()-.,:;?'"


def quality_weight(text: Column) -> Column:
    """A document's weight in the sample, from its share of digits and marks: up to 5 % 1, up to 15 % a half, else a quarter."""
    n = F.length(F.coalesce(text, F.lit("")))
    marks = n - F.length(F.translate(F.coalesce(text, F.lit("")), MARKS, ""))
    return F.when(100 * marks <= 5 * n, F.lit(HIGH_WEIGHT)).when(100 * marks <= 15 * n, F.lit(MID_WEIGHT)).otherwise(F.lit(LOW_WEIGHT))


def uniform(key: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of MD5 of key, seed and text."""
    of = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed)), F.coalesce(text, F.lit("")))
    bits = F.conv(F.substring(F.md5(of.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def prefix_sums(df: DataFrame, group: list[str], order: list[Column], value: str, out: str, parts: int | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group that come before, by ``order``.

    No task gathers a group: rows are dealt by ranges of (group, order), and
    only sums of (group, part) meet, one row for each part of a group.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = fresh("ps_part", df.columns)
    keys = [quoted(g) for g in group]
    dealt = staged(df.repartitionByRange(n, *[k.asc_nulls_last() for k in keys], *order).withColumn(part, F.spark_partition_id()), "prefix-parts")
    sums = dealt.groupBy(*keys, quoted(part)).agg(F.sum(quoted(value)).alias("ps_sum"))
    before = Window.partitionBy(*keys).orderBy(quoted(part)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("ps_before", F.coalesce(F.sum("ps_sum").over(before), F.lit(0)))
    offsets = offsets.select(*[k.alias(f"ps_g{i}") for i, k in enumerate(keys)], quoted(part).alias("ps_p"), "ps_before")
    within = Window.partitionBy(quoted(part), *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = dealt.withColumn("ps_run", F.coalesce(F.sum(quoted(value)).over(within), F.lit(0)))
    same = quoted(part) == F.col("ps_p")
    for i, k in enumerate(keys):
        same &= k.eqNullSafe(F.col(f"ps_g{i}"))
    joined = running.join(offsets, same)
    return joined.withColumn(out, F.col("ps_before") + F.col("ps_run")).select([quoted(c) for c in df.columns] + [F.col(out)])


def source_targets(sizes: DataFrame, weight_cycle: int = WEIGHT_CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: source, source_size.  Adds weight and target."""
    sized = sizes.withColumn("all_of_it", F.lit(1)).withColumn("one", F.lit(1).cast("long"))
    # rank by code point, null last: UTF-8 order is code-point order
    ranked = prefix_sums(sized, ["all_of_it"], [F.col("source").asc_nulls_last()], "one", "rank")
    weighed = ranked.withColumn("weight", (F.col("rank") % weight_cycle + 1).cast("long")).withColumn("cap", (F.col("source_size") * max_epochs).cast("long"))
    weighed = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = [F.col("ratio").asc(), F.col("source").asc_nulls_last()]
    steps = prefix_sums(weighed, ["all_of_it"], order, "cap", "caps_before")
    steps = prefix_sums(steps, ["all_of_it"], order, "weight", "weights_before")
    total = steps.agg(F.sum("source_size"), F.sum("weight")).first()
    # the share of a unit of weight if exactly the sources before this one are capped; it falls from the first source on that it does not cap
    unit = (F.lit(total[0] or 0) - F.col("caps_before")).cast("double") / (F.lit(total[1] or 0) - F.col("weights_before")).cast("double")
    level = steps.where(F.col("ratio") > unit).agg(F.max(unit)).first()[0]
    cap = F.col("cap").cast("double")
    target = cap if level is None else F.when(F.col("ratio") <= level, cap).otherwise(F.col("weight") * F.lit(level))
    return steps.select("source", "source_size", "weight", target.alias("target"))


def _mix(
    rows: DataFrame, tag: str, id_col: str, text_col: str, source_col: str,
    weight: Column | None = None, seed: int = SEED, weight_cycle: int = WEIGHT_CYCLE, max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    size = F.coalesce(F.size(words_of(F.coalesce(quoted(text_col), F.lit("")))), F.lit(0)).cast("long")
    key = -F.log(uniform(quoted(id_col), quoted(text_col), seed)) / (quality_weight(quoted(text_col)) if weight is None else weight)
    drawn = staged(rows.select(quoted(tag).alias("tag"), quoted(id_col).alias("id"), quoted(source_col).alias("source"), size.alias("size"), key.alias("key")), "mix-keys")
    sizes = drawn.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weight_cycle, max_epochs), "mix-targets")
    order = [F.col("key").asc(), F.col("id").asc_nulls_last(), F.col("size").asc(), F.col("tag").asc()]
    placed = prefix_sums(drawn, ["source"], order, "size", "before")
    out = placed.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
    out = out.select("p.tag", "p.id", "p.source", "p.size", "p.before", "t.source_size", "t.target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    once_more = (F.col("before") + F.col("size") / F.lit(2.0) <= rest).cast("long")
    copies = F.least(epochs + once_more, F.lit(max_epochs)).cast("long")
    return out.select("tag", "id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """One row per input row: tag, id, source, size, source_size, target, copies, taken.  ``weight``: an expression over ``docs``, above 0; ``seed``, ``weight_cycle``, ``max_epochs``."""
    tag = fresh("mx_tag", docs.columns)
    return _mix(tagged(docs, tag), tag, id_col, text_col, source_col, **kw)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the input's columns."""
    tag, copies, no = (fresh(f"mx_{k}", docs.columns) for k in ("tag", "copies", "no"))
    rows = tagged(docs, tag)
    plan = _mix(rows, tag, id_col, text_col, source_col, **kw).where("copies > 0")
    plan = staged(plan.select("tag", F.col("copies").cast("int").alias("copies")), "mix-plan").toDF(tag, copies)
    out = meet(rows, plan, tag).withColumn(no, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select([quoted(c) for c in docs.columns])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP2_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, length(coalesce(text, '')) AS n,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{MARKS.replace("'", "''")}', '')) AS marks,
         (('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), '{SEED}', coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / {float(2**52)} AS u
  FROM documents
), k AS (
  SELECT doc_id, source, size, -ln(u) / (CASE WHEN 100 * marks <= 5 * n THEN {HIGH_WEIGHT} WHEN 100 * marks <= 15 * n THEN {MID_WEIGHT} ELSE {LOW_WEIGHT} END)::DOUBLE AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {WEIGHT_CYCLE} + 1 AS weight, source_size * {MAX_EPOCHS} AS cap FROM s
), r AS (
  SELECT *, cap / weight AS ratio, coalesce(sum(cap) OVER o, 0) AS caps_before, coalesce(sum(weight) OVER o, 0) AS weights_before,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), u AS (
  SELECT *, (total - caps_before)::DOUBLE / (weights - weights_before)::DOUBLE AS unit FROM r
), t AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR ratio <= level THEN cap::DOUBLE ELSE weight * level END AS target
  FROM u, (SELECT max(unit) AS level FROM u WHERE ratio > unit)
), p AS (
  SELECT k.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k
), e AS (
  SELECT doc_id, size, source_size, target, before, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END, {MAX_EPOCHS}) * size)::BIGINT AS taken
FROM e
"""
