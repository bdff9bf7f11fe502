"""Quality rules against a plain reading of the prescribed measures."""

import random
import re
from collections import Counter

import duckdb

from playmart.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def judged(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, kept string")
    return {r.doc_id: r for r in quality.judge(docs).collect()}


def measures(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


def test_measures_on_random_texts(spark):
    draw = random.Random(4)
    parts = ["a", "b", "c", "dé", "#x", "\x1c", " "]
    gaps = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\n\n"]
    texts = ["".join(draw.choice(parts) + draw.choice(gaps) for _ in range(draw.randrange(90))) for _ in range(300)]
    # Many different repeated windows take the other way to their places.
    many = " ".join(str(i) for i in range(500))
    texts += [None, "", " \n ", "one", many + " x " + many, " ".join(["w"] * 5000), "\n".join(["same line"] * 100)]
    got = judged(spark, texts)
    for i, text in enumerate(texts):
        assert measures(got[i]) == plain(text), text


def test_line_rules(spark):
    prose = "The quick brown fox jumps over the lazy dog, and then it sleeps for a while. " * 5
    prose = " ".join(f"{w[:-1]}x{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}{w[-1]}" for i, w in enumerate(prose.split()))
    texts = [
        prose,
        " | ".join(prose.split()),
        " ".join(w + "%%%" for w in prose.split()),
        "\n".join(["ALL OF THIS IS SHOUTED LOUDLY INDEED"] * 3 + [prose]),
        "Accept all cookies to go on.\n" + prose,
    ]
    got = judged(spark, texts)
    assert [got[i].kept for i in range(5)] == [True, False, False, True, True]
    assert got[3].clean_text == prose and got[4].clean_text == prose
    assert got[0].clean_text == prose and got[1].clean_text == ""


def test_clean_documents_stay_and_junk_goes(spark):
    rows = {r.doc_id: r for r in quality.op5_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert all(measures(rows[d.doc_id]) == plain(d.text) for d in docs)
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    good = [rows[i].kept for i, q in labels if q == 1 and not rows[i].base_failed]
    bad = [rows[i].kept for i, q in labels if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_helper_columns_leave_own_ones(spark):
    docs = spark.createDataFrame([("Some words. " * 30, "a", "b")], "q_text string, q_words string, q_kept string")
    row = quality.judge(docs, "q_text").first()
    assert (row.q_text, row.q_words, row.q_kept, row.n_words) == ("Some words. " * 30, "a", "b", 60)
