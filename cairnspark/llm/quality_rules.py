"""Quality rules with cross-document line frequency (DataFrame functions only).

One pass over the texts makes a *profile* of each row: counts of the base rules
and the row's normalised lines as (hash, words).  All
that follows works on the profile, which holds no text:

* a line's frequency is the number of distinct documents of its host that have
  it; copies of one text (same host, same normalised text) are one document,
  so that a much-copied document is not taken for boilerplate;
* a line is above the limit if more than ``max(min_docs, max_share x documents
  of the host)`` documents have it; such lines are removed
  (``filter_quality`` gives the texts without them, ``quality_verdicts`` counts
  their words);
* a document is depleted, and rejected, if removing lines leaves fewer than
  ``min_words`` words and takes at least ``depleted_share`` of its words.

Frequencies are counted in two steps that both pre-aggregate: distinct
(host, line, document), which spreads even one line that every document has,
then documents per (host, line).

Defined cases.  Null text counts as empty and fails the base rules; null hosts
form a host of their own.  Repeated rows get equal verdicts, each its own row.
An empty table gives an empty result.  Extra columns are never looked at.
A very long line or text is handled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, SPACE_CLASS, fresh, meet, normalised, quoted, staged, table, tagged, words_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SYMBOL_CLASS = f"[{SYMBOLS}]"
MIN_DOCS = 25
MAX_SHARE = 0.02
DEPLETED_SHARE = 0.5


def _has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(SPACE_CHARS)) != ""


def _repeat_words(df: DataFrame, words: str, n_words: str) -> DataFrame:
    """Adds n_repeat_words: words in ``WINDOW``-word windows that the text has twice or more.

    Hashes tell the texts that may have such windows (no two hashes alike: no
    two windows alike).  Only for those, windows are sorted by two independent
    64-bit hashes with their places, and the union of the repeated windows'
    places is measured from one place to the next.
    """
    at = lambda i: [F.get(F.col(words), i + F.lit(k)) for k in range(WINDOW)]
    starts = F.sequence(F.lit(0), F.col(n_words).cast("int") - F.lit(WINDOW))
    df = df.withColumn("rw_hash", F.when(F.col(n_words) > WINDOW, F.transform(starts, lambda i: F.xxhash64(*at(i)))))
    df = df.withColumn("rw_any", F.coalesce(F.size(F.array_distinct("rw_hash")) < F.size("rw_hash"), F.lit(False))).drop("rw_hash")
    sorted_windows = F.sort_array(F.transform(starts, lambda i: F.struct(F.xxhash64(*at(i)).alias("a"), F.xxhash64(F.lit(1), *at(i)).alias("b"), i.alias("i"))))
    df = df.withColumn("rw_sorted", F.when(F.col("rw_any"), sorted_windows))

    def alike(x: Column, j: Column) -> Column:
        y = F.get(F.col("rw_sorted"), j)
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    repeated = F.filter(F.col("rw_sorted"), lambda x, j: alike(x, j - 1) | alike(x, j + 1))
    df = df.withColumn("rw_at", F.when(F.col("rw_any"), F.sort_array(F.transform(repeated, lambda x: x["i"])))).drop("rw_sorted")
    gaps = F.transform(F.col("rw_at"), lambda p, j: F.coalesce(F.least(F.lit(WINDOW), F.get(F.col("rw_at"), j + 1) - p), F.lit(WINDOW)))
    covered = F.aggregate(F.coalesce(gaps, F.array().cast("array<int>")), F.lit(0).cast("long"), lambda acc, g: acc + g)
    return df.withColumn("n_repeat_words", covered).drop("rw_any", "rw_at")


def two_hashes(*of: Column) -> Column:
    """128 bits that stand for a string: with 64, two of 10^11 lines would be alike by chance."""
    return F.struct(F.xxhash64(*of).alias("a"), F.xxhash64(F.lit(1), *of).alias("b"))


def profile(rows: DataFrame, tag: str, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row for each of ``rows``: its tag, id, host, digest, counts of the base rules, normalised lines with their places."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    df = rows.select(quoted(tag).alias("tag"), quoted(id_col).alias("id"), quoted(host_col).alias("host"), text.alias("text"))
    df = df.select(
        "tag", "id", "host", two_hashes(normalised(F.col("text"))).alias("digest"), "text",
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOL_CLASS, ""))).cast("long").alias("n_symbols"),
        words_of(F.col("text")).alias("words"),
        F.split("text", "\n", -1).alias("all_lines"),
    )
    places = F.filter(F.transform(F.col("all_lines"), lambda x, i: F.when(_has_word(x), i)), lambda i: i.isNotNull())
    df = df.withColumns({"raw_lines": F.filter("all_lines", _has_word), "places": places}).drop("all_lines")
    df = df.withColumns({"n_words": F.size("words").cast("long"), "word_chars": F.length(F.array_join("words", "")).cast("long")})
    df = _repeat_words(df, "words", "n_words")
    tidy = F.transform(F.col("raw_lines"), lambda x: F.lower(F.trim(F.regexp_replace(x, SPACE_CLASS + "+", " "))))
    df = df.select(
        "tag", "id", "host", "digest", "word_chars", "n_symbols", "n_words", "n_repeat_words", "places",
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"), tidy.alias("tidy"),
    )
    # a normalised line has one space between words: words = spaces + 1
    lines = F.sort_array(F.transform(F.col("tidy"), lambda x, k: F.struct(two_hashes(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long").alias("words"), F.get("places", k).alias("place"))))
    df = df.withColumn("lines", lines).drop("tidy", "places")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select("*", base_failed.alias("base_failed"))


def frequent_lines(lines: DataFrame, profiles: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, line) above the limit.  lines: host, digest, line."""
    per_line = lines.select("host", "line", "digest").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    per_host = profiles.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    many = per_line.where(F.col("docs") > min_docs)
    limit = F.greatest(F.lit(float(min_docs)), F.lit(max_share) * F.col("h.host_docs"))
    return many.alias("l").join(per_host.alias("h"), F.col("l.host").eqNullSafe(F.col("h.host"))).where(F.col("l.docs") > limit).select("l.host", "l.line")


def _verdicts(
    rows: DataFrame, tag: str, id_col: str, text_col: str, host_col: str,
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, depleted_share: float = DEPLETED_SHARE,
) -> DataFrame:
    profiles = staged(profile(rows, tag, id_col, text_col, host_col), "quality-profile")
    lines = profiles.select("tag", "host", "digest", F.explode("lines").alias("l")).select("tag", "host", "digest", "l.line", "l.words", "l.place")
    frequent = staged(frequent_lines(lines, profiles, min_docs, max_share), "quality-frequent")
    hits = lines.alias("a").join(frequent.alias("f"), F.col("a.host").eqNullSafe(F.col("f.host")) & (F.col("a.line") == F.col("f.line")))
    removed = hits.groupBy("a.tag").agg(F.sum("a.words").alias("removed_words"), F.sort_array(F.collect_list("a.place")).alias("removed_lines"))
    df = profiles.drop("lines").join(removed, "tag", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    depleted = (F.col("n_words") - F.col("removed_words") < MIN_WORDS) & (F.col("removed_words") >= depleted_share * F.col("n_words"))
    return df.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The profile of each row with removed_words, removed_lines (their places in the text split at line ends; null if none) and kept.  ``limits``: min_docs, max_share, depleted_share."""
    tag = fresh("qr_tag", docs.columns)
    return _verdicts(tagged(docs, tag), tag, id_col, text_col, host_col, **limits)


def without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at ``places`` (ascending, from 0), each with one line end; what lies between two of them is taken whole."""
    all_lines = F.split(text, "\n", -1)
    edges = F.concat(F.array(F.lit(-1)), places, F.array(F.size(all_lines)))
    between = F.transform(places, lambda p, k: F.slice(all_lines, F.get(edges, k) + 2, p - F.get(edges, k) - 1))
    last = F.element_at(places, -1)
    return F.array_join(F.concat(F.flatten(between), F.slice(all_lines, last + 2, F.size(all_lines) - last - 1)), "\n")


def filter_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", chars_col: str | None = "n_chars", **limits,
) -> DataFrame:
    """The rows that pass, without the lines above the limit; the input's columns.

    Of a text that loses lines, ``chars_col`` (if there is one) is counted
    anew; other rows stay as they are.  Verdicts find their rows by the rows'
    tags, whatever the rows hold.
    """
    tag, kept, gone = (fresh(f"qr_{k}", docs.columns) for k in ("tag", "kept", "gone"))
    rows = tagged(docs, tag)
    marks = _verdicts(rows, tag, id_col, text_col, host_col, **limits).where(~F.col("kept") | F.col("removed_lines").isNotNull())
    marks = staged(marks.select("tag", "kept", F.when(F.col("kept"), F.col("removed_lines")).alias("gone")), "quality-marks").toDF(tag, kept, gone)
    rows = meet(rows, marks, tag, "left").where(F.coalesce(F.col(kept), F.lit(True)))
    loses = F.col(gone).isNotNull()
    rows = rows.withColumn(text_col, F.when(loses, without_lines(quoted(text_col), F.col(gone))).otherwise(quoted(text_col)))
    if chars_col in docs.columns:
        rows = rows.withColumn(chars_col, F.when(loses, F.length(quoted(text_col)).cast(docs.schema[chars_col].dataType)).otherwise(quoted(chars_col)))
    return rows.select([quoted(c) for c in docs.columns])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_verdicts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS tag, doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS raw
  FROM documents
), w AS (
  SELECT tag, i, list_aggregate(words[i:i+{WINDOW - 1}], 'string_agg', ' ') AS g
  FROM (SELECT tag, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM d WHERE len(words) > {WINDOW - 1})
), rep AS (
  SELECT tag, count(DISTINCT i + k) AS n FROM (SELECT tag, i FROM w QUALIFY count(*) OVER (PARTITION BY tag, g) > 1), range(0, {WINDOW}) r(k) GROUP BY tag
), b AS (
  SELECT tag, doc_id, host, hash(regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g')) AS digest, raw,
         len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
         len(raw) - len(list_distinct(raw)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (tag)
), l AS (
  SELECT tag, host, digest, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line
  FROM (SELECT tag, host, digest, unnest(raw) AS x FROM b)
), f AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT digest) AS docs FROM l GROUP BY host, line)
  JOIN (SELECT host, count(DISTINCT digest) AS host_docs FROM b GROUP BY host) h USING (host)
  WHERE docs > greatest({MIN_DOCS}, {MAX_SHARE} * host_docs)
), r AS (
  SELECT tag, sum(length(line) - length(replace(line, ' ', '')) + 1)::BIGINT AS removed_words FROM l JOIN f USING (host, line) GROUP BY tag
), v AS (
  SELECT b.*, coalesce(removed_words, 0) AS removed_words,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM b LEFT JOIN r USING (tag)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words - removed_words < {MIN_WORDS} AND removed_words >= {DEPLETED_SHARE} * n_words) AS kept, removed_words
FROM v
"""
