"""Line-first cleaning in built-in functions only.

Every line with a word is held against five rules: it must end in closing punctuation; it must not be mostly
symbols or separators; it must not shout; it must not be a navigation entry; it must not hold boilerplate. Lines
that fail are taken out. A document is rejected if it fails the base rules on its whole text (fewer than
``MIN_WORDS`` words, or more than half of them in repeated three-word windows), or if the removed lines hold
more than ``MAX_LOSS`` percent of the characters in words.

Words are runs of characters other than 0x20 and 0x09 to 0x0D. NULL has no words and fails the base rules, as
does an empty text; blank lines neither fail nor count; rows with equal ids are judged apart; texts are never cut.
Nothing is shuffled, and no array is compared with itself in more than n log n steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
CLOSING = "[.!?…:;\"'”»)\\]][\\x20\\x09-\\x0D]*$"
NAVIGATION = "(?i)^[\\x20\\x09-\\x0D]*(home|about us|contact us|log ?in|sign (in|up)|menu|next|previous|read more|share this|skip to content)[.!:»]*[\\x20\\x09-\\x0D]*$"
BOILERPLATE = "(?i)(cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|lorem ipsum|subscribe to our newsletter|powered by)"
MIN_WORDS = 50
MAX_LOSS = 30


def failed_line(line: Column) -> Column:
    """Whether a line that has a word breaks one of the line rules."""
    spaces = F.size(F.split(line, SPACES))
    symbols = F.size(F.split(line, SYMBOLS)) - 1
    shouts = F.size(F.split(line, "!")) - 1
    return (
        ~line.rlike(CLOSING) | (symbols * 5 > spaces) | ((shouts * 2 > spaces) & (spaces > 3))
        | line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)
    )


def _repeat_words(windows: Column) -> Column:
    """Words in windows found twice or more, from the sorted (window, position) pairs."""
    last = F.size(windows) - 1

    def twin(j: Column) -> Column:
        here = F.get(windows, j)["win"]
        return here.eqNullSafe(F.get(windows, j - 1)["win"]) | here.eqNullSafe(F.get(windows, j + 1)["win"])

    at = lambda j: F.get(windows, j)["pos"]
    found = F.filter(F.sequence(F.lit(0), last), twin)
    return F.size(F.array_distinct(F.flatten(F.transform(found, lambda j: F.array(at(j), at(j) + 1, at(j) + 2)))))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The cleaned text of each document, what the rules found, and the verdict."""
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), SPACES), "").alias("words"),
        F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    word = lambda i: F.get("words", i)
    last = F.size("words") - 3
    base = base.select(
        "*", F.size("words").alias("n_words"),
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), last),
                                      lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))).alias("hashes"),
        F.filter("lines", lambda x: ~failed_line(x)).alias("good_lines"),
    )
    # Equal windows have equal hashes: where all hashes differ, nothing repeats and the windows aren't built.
    base = base.select(
        "doc_id", "text", "n_words", "lines", "good_lines", F.array_join("words", "").alias("joined"),
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.array_sort(F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("win"), i.alias("pos")),
        ))).alias("windows"),
    )
    base = base.select(
        "doc_id", "n_words",
        F.length("joined").alias("word_chars"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", SYMBOLS)) - 1).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.col("windows").isNull(), 0).otherwise(_repeat_words(F.col("windows"))).alias("n_repeat_words"),
        (F.size("lines") - F.size("good_lines")).alias("n_failed_lines"),
        F.array_join("good_lines", "\n").alias("clean_text"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines"]
    left = F.length(F.regexp_replace("clean_text", SPACES, ""))
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return base.select(
        "doc_id", *(F.col(c).cast("long").alias(c) for c in counts), "clean_text",
        base_failed.alias("base_failed"), left.cast("long").alias("clean_chars"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("clean_chars") * 100 >= F.col("word_chars") * (100 - MAX_LOSS)))


def op8_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rules and base rules over all documents."""
    from roompulse.llm.storage import table

    return cleaned(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_failed_lines", "clean_chars")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS k FROM d WHERE len(w) >= 3)
), twice AS (SELECT doc_id, win FROM win GROUP BY ALL HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM win JOIN twice USING (doc_id, win)) GROUP BY doc_id
), line AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '[\x20\x09-\x0D]+')) + 1 AS spaces,
         len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(l, '!')) AS shouts
  FROM (SELECT doc_id, unnest(lines) AS l FROM d)
), good AS (
  SELECT doc_id, count(*) AS n, sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) AS chars FROM line
  WHERE regexp_matches(l, '[.!?…:;"''”»)\]][\x20\x09-\x0D]*$') AND symbols * 5 <= spaces
    AND NOT (shouts * 2 > spaces AND spaces > 3)
    AND NOT regexp_matches(l, '(?i)^[\x20\x09-\x0D]*(home|about us|contact us|log ?in|sign (in|up)|menu|next|previous|read more|share this|skip to content)[.!:»]*[\x20\x09-\x0D]*$')
    AND NOT regexp_matches(l, '(?i)(cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|lorem ipsum|subscribe to our newsletter|powered by)')
  GROUP BY doc_id
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(length(list_aggregate(w, 'string_agg', '')), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) - coalesce(good.n, 0) AS BIGINT) AS n_failed_lines,
         CAST(coalesce(good.chars, 0) AS BIGINT) AS clean_chars
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN good USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND clean_chars * 100 >= word_chars * 70 AS kept
FROM m
"""
