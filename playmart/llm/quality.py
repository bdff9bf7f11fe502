"""Line-first cleaning: rules per line, then rejection of documents that lose too much.

Column expressions only; every document is judged where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm.common import documents, fresh_name

# The prescribed white space and symbols.
WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: A line fails from this many symbols, navigation marks or shouted words per word on.
MAX_SYMBOLS_PER_WORD = 0.5
MAX_MARKS_PER_WORD = 0.3
MAX_SHOUTS_PER_WORD = 0.5
#: A line of so many words without any punctuation fails.
MIN_WORDS_WITHOUT_STOP = 40
NAVIGATION = r"[|»›•·→]"
SHOUT = r"[!?]{2,}"
PUNCTUATION = r"[.!?…,;:。！？]"
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|accept (?:all )?cookies|cookie policy|privacy policy|terms of (?:use|service)"
    r"|enable javascript|sign up for our newsletter|click here to|skip to (?:main )?content|lorem ipsum)\b"
)
#: A document that keeps fewer of its words than this share is rejected.
MIN_KEPT_SHARE = 0.5
#: Up to so many different repeated windows are looked up one by one; beyond, by a sort.
LOOKED_UP = 32


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_CLASS + "+"))


def _count(text: Column, pattern: str) -> Column:
    """Matches of a pattern that matches single characters."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def line_fails(line: Column, n_words: Column) -> Column:
    """Whether a line that holds ``n_words`` words is not prose."""
    plain = n_words.cast("double")
    letters = F.regexp_replace(line, r"[^\p{L}]", "")
    shouted = (F.length(letters) >= 20) & (letters == F.upper(letters)) & (letters != F.lower(letters))
    return (
        (_count(line, SYMBOLS) >= MAX_SYMBOLS_PER_WORD * plain)
        | (_count(line, NAVIGATION) >= MAX_MARKS_PER_WORD * plain)
        | (F.size(F.split(line, SHOUT)) - 1 >= MAX_SHOUTS_PER_WORD * plain)
        | shouted
        | ((n_words >= MIN_WORDS_WITHOUT_STOP) & ~line.rlike(PUNCTUATION))
        | line.rlike(BOILERPLATE)
    )


#: Columns that judge() makes on its way.
HELPERS = ("q_text", "q_words", "q_lines", "q_hashes", "q_sorted", "q_again", "q_grouped", "q_kept")


def _repeat_words(docs: DataFrame) -> DataFrame:
    """From ``q_words``: ``n_repeat_words``, the words in three-word windows that
    occur at least twice in their text.

    Windows are compared by 64-bit hashes. A sort of the hashes shows which occur
    again; the places of those, in order, give the words that they cover.
    """
    window = F.transform(
        F.sequence(F.lit(0), F.size("q_words") - 3),
        lambda i: F.xxhash64(F.get("q_words", i), F.get("q_words", i + 1), F.get("q_words", i + 2)),
    )
    none = F.array().cast("array<bigint>")
    hashed = docs.withColumn("q_hashes", F.when(F.size("q_words") >= 3, window).otherwise(none))
    ordered = hashed.withColumn("q_sorted", F.sort_array("q_hashes"))
    # Equal hashes are neighbours now; a value that repeats shows up in front of its like.
    repeated = ordered.withColumn(
        "q_again",
        F.array_distinct(F.filter("q_sorted", lambda h, i: F.coalesce(h == F.get("q_sorted", i + 1), F.lit(False)))),
    )
    with_place = F.transform("q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    grouped = repeated.withColumn(
        "q_grouped",
        F.when(F.size("q_again") > LOOKED_UP, F.array_sort(with_place)).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        ),
    )
    alike = F.transform(
        "q_grouped",
        lambda g, k: F.when(
            ((k > 0) & (g["h"] == F.get("q_grouped", F.greatest(k - 1, F.lit(0)))["h"]))
            | F.coalesce(g["h"] == F.get("q_grouped", k + 1)["h"], F.lit(False)),
            g["i"],
        ).otherwise(F.lit(-1)),
    )
    by_lookup = F.filter(
        F.transform("q_hashes", lambda h, i: F.when(F.array_contains("q_again", h), i).otherwise(F.lit(-1))),
        lambda i: i >= 0,
    )
    by_sort = F.sort_array(F.filter(alike, lambda i: i >= 0))
    places = (
        F.when(F.size("q_again") == 0, F.array().cast("array<int>"))
        .when(F.size("q_again") <= LOOKED_UP, by_lookup)
        .otherwise(by_sort)
    )
    first = F.struct(F.lit(-3).alias("before"), F.lit(0).alias("covered"))
    covered = F.aggregate(
        places,
        first,
        lambda acc, p: F.struct(
            p.alias("before"), (acc["covered"] + F.least(F.lit(3), p - acc["before"])).alias("covered")
        ),
        lambda acc: acc["covered"].cast("bigint"),
    )
    return grouped.withColumn("n_repeat_words", covered)


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measure and clean every whole text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    ``clean_text`` (the lines that pass, in order), n_kept_words and ``kept``: false if
    base_failed or if the lines that pass hold less than MIN_KEPT_SHARE of the words.
    A null text counts as an empty one: no words, not kept, an empty clean_text.
    Repeated rows are judged alike; an empty table gives an empty one. Other columns stay;
    those that are called like an added one are replaced.
    """
    own = {c: fresh_name([*docs.columns, *HELPERS], f"own_{c}") for c in docs.columns if c.lower() in HELPERS}
    docs, text = docs.withColumnsRenamed(own), own.get(text, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumn("q_text", whole).withColumn("q_words", words_of(F.col("q_text")))
    lines = F.transform(
        F.split("q_text", "\n"),
        lambda line: F.struct(line.alias("line"), F.size(words_of(line)).alias("n")),
    )
    full = F.filter(lines, lambda x: x["n"] > 0)
    counted = _repeat_words(split.withColumn("q_lines", full))
    kept = F.filter("q_lines", lambda x: ~line_fails(x["line"], x["n"]))
    n_words, repeats = F.size("q_words").cast("bigint"), F.col("n_repeat_words")
    measured = counted.withColumn("q_kept", kept).withColumns(
        {
            "n_words": n_words,
            "word_chars": F.length(F.array_join("q_words", "")).cast("bigint"),
            "n_symbols": _count(F.col("q_text"), SYMBOLS).cast("bigint"),
            "n_dup_lines": (
                F.size("q_lines") - F.size(F.array_distinct(F.transform("q_lines", lambda x: x["line"])))
            ).cast("bigint"),
            "base_failed": (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words),
            "n_kept_words": F.aggregate(
                "q_kept", F.lit(0).cast("bigint"), lambda total, x: total + x["n"].cast("bigint")
            ),
            "clean_text": F.array_join(F.transform("q_kept", lambda x: x["line"]), "\n"),
        }
    )
    enough = F.col("n_kept_words") >= MIN_KEPT_SHARE * F.col("n_words")
    judged = measured.withColumn("kept", ~F.col("base_failed") & enough)
    return judged.drop(*HELPERS).withColumnsRenamed({made: c for c, made in own.items()})


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict for all documents."""
    judged = judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_kept_words",
    )


# Windows as rows with their count, words covered as a distinct count, lines as rows.
OP5_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS times
  FROM (
    SELECT doc_id, i, word || ' ' || lead(word) OVER following || ' ' || lead(word, 2) OVER following AS three
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM texts)
    WINDOW following AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE three IS NOT NULL
),
repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE times > 1) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
    regexp_replace(line, '[^\\p{{L}}]', '', 'g') AS letters
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM texts)
),
judged AS (
  SELECT doc_id, line, n,
    len(regexp_extract_all(line, '{SYMBOLS}')) >= {MAX_SYMBOLS_PER_WORD}::DOUBLE * n
    OR len(regexp_extract_all(line, '{NAVIGATION}')) >= {MAX_MARKS_PER_WORD}::DOUBLE * n
    OR len(regexp_extract_all(line, '{SHOUT}')) >= {MAX_SHOUTS_PER_WORD}::DOUBLE * n
    OR (length(letters) >= 20 AND letters = upper(letters) AND letters <> lower(letters))
    OR (n >= {MIN_WORDS_WITHOUT_STOP} AND NOT regexp_matches(line, '{PUNCTUATION}'))
    OR regexp_matches(line, '{BOILERPLATE}') AS fails
  FROM lines WHERE n > 0
),
by_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (NOT fails), 0) AS n_kept_words
  FROM judged GROUP BY doc_id
),
measured AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(body, '{SYMBOLS}')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_kept_words, 0) AS n_kept_words
  FROM texts LEFT JOIN by_lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
),
based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND n_kept_words >= {MIN_KEPT_SHARE}::DOUBLE * n_words AS kept, n_kept_words::BIGINT AS n_kept_words
FROM based
"""
