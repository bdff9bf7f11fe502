"""Line dedup against explicit comparison of all windows."""

import random
import re
from hashlib import sha256

import numpy as np

from playmart.llm import lines
from playmart.operators import Scratch


def passages(texts, least):
    """The words left of texts in order, without those in windows that occurred before."""
    seen, left = set(), []
    for text in texts:
        words = text.split()
        gone = [False] * len(words)
        for i in range(len(words) - least + 1):
            window = tuple(words[i : i + least])
            if window in seen:
                gone[i : i + least] = [True] * least
            seen.add(window)
        left.append([w for w, g in zip(words, gone, strict=True) if not g])
    return left


def test_passages_within_lines_go_but_the_first(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"own before{i} {passage} after{i} it\nline {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in lines.remove_passages(docs, Scratch(spark, "t")).collect()}
    assert got[0].text == rows[0][1]
    assert all(got[i].text == f"own before{i} after{i} it\nline {i}" for i in range(1, 40))
    assert all(r.removed_lines == 0 for r in got.values())


def test_passages_of_random_texts(spark):
    draw = random.Random(5)
    pool = [[f"w{draw.randrange(40)}" for _ in range(30)] for _ in range(6)]
    texts = []
    for _ in range(300):
        words = []
        for _ in range(draw.randrange(6)):
            a, part = draw.randrange(20), draw.choice(pool)
            words += part[a : a + draw.randrange(25)] + [f"w{draw.randrange(40)}"] * draw.randrange(3)
        texts.append("".join(w + draw.choice([" ", " ", "\n", "  "]) for w in words))
    rows = [(None, texts[0]), (None, texts[0]), *enumerate(texts[1:]), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("before", lines.F.col("text"))
    for least in (6, 9):
        got = lines.remove_passages(docs, Scratch(spark, "t"), min_words=least).collect()
        assert len(got) == len(rows)
        expected = dict(zip([None, *range(len(texts) - 1)], passages(texts, least), strict=True))
        for r in got:
            assert (r.text or "").split() == expected.get(r.doc_id, [])
            assert (r.text is None) == (r.before is None)


def test_marks_and_windows_of_texts_hashed_together():
    """Texts side by side have the marks and windows that each has by itself."""
    draw = random.Random(7)
    texts = ["", *(" ".join(f"w{draw.randrange(9)}" for _ in range(draw.randrange(30))) for _ in range(50)), "", "x"]
    hashes, cuts = lines.word_hashes(texts)
    assert np.diff(cuts).tolist() == [len(t.split()) for t in texts]
    for least in (1, 2, 7, 12):
        alone = {}
        for row, text in enumerate(texts):
            own, ends = lines.word_hashes([text])
            found = lines.word_marks(own, ends, least)
            if found is None:
                continue
            windows = lines.windows_of_marks(own, ends, least, found[3])
            assert windows[3].tolist() == list(range(len(own) - least + 1))
            alone[row] = [np.stack(x[1:]).tolist() for x in (found, windows)]
        found = lines.word_marks(hashes, cuts, least)
        windows = lines.windows_of_marks(hashes, cuts, least, found[3] + cuts[found[0]])
        rows = np.unique(found[0]).tolist()
        assert {r: [np.stack([c[x[0] == r] for c in x[1:]]).tolist() for x in (found, windows)] for r in rows} == alone


def test_texts_are_not_sorted_where_joined(spark):
    """The sides that hold a key once are hashed: no sort of rows with whole texts."""
    docs = spark.createDataFrame([(i, f"one two three four {i % 2}") for i in range(20)], "doc_id bigint, text string")
    cleaned = lines.remove_passages(docs, Scratch(spark, "t"), min_words=4)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert cleaned.filter("removed_lines > 0").count() == 18


def test_cut_runs_leaves_other_characters():
    text = "  a b\n\nc d  e\n f g\n"
    assert lines.cut_runs(text, [(0, 2)]) == ("\nc d  e\n f g\n", 1)
    assert lines.cut_runs(text, [(1, 3)]) == ("  a d  e\n f g\n", 2)
    assert lines.cut_runs(text, [(2, 4), (3, 5)]) == ("  a b\n\n f g\n", 1)
    assert lines.cut_runs(text, [(3, 4)]) == ("  a b\n\nc e\n f g\n", 0)
    assert lines.cut_runs("a b\nc d", [(2, 4)]) == ("a b", 1)
    assert lines.cut_runs("a b\nc d", [(0, 4)]) == ("", 2)


def plainly_cut(text, gone):
    """(text, ends of lines lost) without the words of the given places, character by
    character: a run goes with the white space after it, or with whole lines."""
    words = [m.span() for m in re.finditer(r"[^ \t-\r]+", text)]
    drop, lost, i = set(), 0, 0
    while i < len(words):
        if not gone[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(words) and gone[j + 1]:
            j += 1
        start, end = words[i][0], words[j][1]
        left, right = text[words[i - 1][1] if i else 0 : start], text[end : words[j + 1][0] if j + 1 < len(words) else len(text)]
        opens, closes = i == 0 or "\n" in left, j + 1 == len(words) or "\n" in right
        line_start = start - len(left) + left.rfind("\n") + 1
        line_end = end + right.index("\n") if "\n" in right else len(text)
        if opens and closes:
            span = range(line_start, line_end + 1) if line_end < len(text) else range(max(line_start - 1, 0), line_end)
        elif opens:
            span = range(line_start, end + len(right))
        elif closes:
            span = range(start - len(left), line_end)
        else:
            span = range(start, end + len(right))
        drop.update(span)
        lost += sum(text[k] == "\n" for k in span if k < len(text))
        i = j + 1
    rest = "".join(c for k, c in enumerate(text) if k not in drop)
    return rest, lost + (not rest and bool(text))


def test_query_against_windows(spark):
    """Whole texts with their white space, and the lines that went."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    seen, expected = set(), {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        words = re.findall(r"[^ \t-\r]+", d.text)
        gone = [False] * len(words)
        for i in range(len(words) - 49):
            window = tuple(words[i : i + 50])
            if window in seen:
                gone[i : i + 50] = [True] * 50
            seen.add(window)
        expected[d.doc_id] = plainly_cut(d.text, gone)
    rows = lines.op9_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs) and any(r.removed_lines for r in rows)
    for r in rows:
        text, lost = expected[r.doc_id]
        assert (r.text_sha256, r.n_chars_left, r.removed_lines) == (sha256(text.encode()).hexdigest(), len(text), lost)


def test_odd_rows(spark):
    run = "one two three\nfour five six"
    long = " ".join(f"word{i % 977} of {i // 977}" for i in range(20_000))
    rows = [(None, run), (None, run), (1, run + "\nseven"), (2, None), (3, ""), (4, long), (5, "x\n" + run + "\n\ny"), (6, long)]
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id bigint, text string, removed_lines string")
    found = lines.remove_passages(docs, Scratch(spark, "t"), min_words=6, name="gone").collect()
    assert {r.removed_lines for r in found} == {"own"} and len(found) == len(rows)
    left = {r.doc_id: (r.text, r.gone) for r in found}
    assert left == {None: (run, 0), 1: ("seven", 2), 2: (None, 0), 3: ("", 0), 4: (long, 0), 5: ("x\n\ny", 2), 6: ("", 1)}
    assert lines.remove_passages(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_query_leaves_no_repeated_window(spark):
    docs = sorted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect(), key=lambda d: d.doc_id)
    expected = passages([d.text for d in docs], 50)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in lines.remove_passages(table, Scratch(spark, "t")).collect()}
    assert [rows[d.doc_id].text.split() for d in docs] == expected
