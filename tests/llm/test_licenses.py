"""Licence notices: windows lose nothing against all runs of words, variants are found."""

import random

import pytest

from playmart.llm import licenses

TEXT_OF = {name: [t for n, t in licenses.TEMPLATES if n == name] for name, _ in licenses.TEMPLATES}


def found(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, licenses int")
    rows = licenses.scan(docs, **options).collect()
    return {r.doc_id: [(x.line, x.license, round(x.dice, 4)) for x in r.licenses] for r in rows}


def test_notices_and_variants(spark):
    long = "\n".join(["some words that are no licence at all"] * 3000)
    texts = [
        "Text before.\nReleased under the MIT License.\nText after.",
        "RELEASED  under the, M.I.T. license",
        "released under the mit license",
        "Code is released under the MIT License.",
        "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.",
        None,
        "",
        "one",
        long + "\nReleased under the BSD 3-Clause License.",
        "Released under the MIT License.\n",
        "Released under the\nMIT License.",
        "\n \nReleased under the MIT License. Released under the MIT License.",
    ]
    got = found(spark, texts)
    assert got[0] == [(1, "MIT", 1.0)] and got[2] == [(0, "MIT", 1.0)] and got[3] == [(0, "MIT", 1.0)]
    assert got[4] == [(0, "Apache-2.0", 1.0), (1, "CC-BY-NC-4.0", 1.0)]
    assert got[1] == got[5] == got[6] == got[7] == []
    assert got[8] == [(3000, "BSD-3-Clause", 1.0)]
    assert got[9] == got[10] == [(0, "MIT", 1.0)]
    assert got[11] == [(2, "MIT", 1.0)] * 2


def test_bodies_and_headers(spark):
    """Over several lines, between other text on the same line, and with words changed."""
    notices = [(n, t) for n, texts in TEXT_OF.items() for t in texts]
    texts = []
    for _, notice in notices:
        words = notice.split()
        texts.append("int main;\n" + "\n".join(" * " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9)) + "\nint x;")
        texts.append(f"Much is said here about songs {notice} and then the same line goes on with others")
    got = found(spark, texts)
    for i, (name, _) in enumerate(notices):
        assert [x[:2] for x in got[2 * i]] == [(1, name)], name
        assert [x[:2] for x in got[2 * i + 1]] == [(0, name)], name
    changed = TEXT_OF["MIT"][1].replace("THE AUTHORS OR COPYRIGHT HOLDERS", "MY GOOD COMPANY").replace("sublicense, ", "")
    half = " ".join(TEXT_OF["MIT"][1].split()[:80])
    got = found(spark, [changed, half])
    assert [x[1] for x in got[0]] == ["MIT"] and got[0][0][2] < 1 and got[1] == []


def plain(text):
    return "".join(c if c.isalnum() else " " for c in text).lower().split()


def brute(text, templates, threshold, whole_runs):
    """The same choice from all runs of words that hold few enough other bigrams."""
    words = plain(text)
    grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
    windows = []
    for name, notice in templates:
        own = plain(notice)
        known = {f"{a} {b}" for a, b in zip(own, own[1:])}
        room = licenses.size_bounds(len(known), threshold)[1] - len(known)
        hit = [False, *(g in known for g in grams), False]
        for a in range(len(grams)):
            for b in range(a, len(grams)):
                part = grams[a : b + 1]
                if sum(g not in known for g in part) > room:
                    break
                at_edges = hit[a + 1] and not hit[a] and hit[b + 1] and not hit[b + 2]
                dice = 2.0 * len(known & set(part)) / (len(set(part)) + len(known))
                if dice >= threshold and (at_edges or not whole_runs):
                    windows.append((-dice, a - b, a, b + 1, name))
    chosen = []
    for w in sorted(windows):
        if all(w[3] < c[2] or c[3] < w[2] for c in chosen):
            chosen.append(w)
    return sorted((c[2], c[3], c[4], round(-c[0], 9)) for c in chosen)


def test_windows_lose_nothing(spark):
    templates = [("A", "a b c d e a c"), ("B", "b c a d e"), ("C", "e d c b a b d"), ("D", "a b")]
    draw = random.Random(5)
    texts = [" ".join(draw.choice("aabcdexy") for _ in range(draw.randrange(40))) for _ in range(150)]
    for name, notice in templates:
        texts += [f"x y {notice} x {notice} y", f"{notice}\n{notice}", notice.replace("d", "y")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for threshold in (0.6, 0.8):
        several = 0
        for r in licenses.scan(docs, templates, threshold).collect():
            got = sorted((x.first_word, x.last_word, x.license, round(x.dice, 9)) for x in r.licenses)
            assert got == brute(texts[r.doc_id], templates, threshold, whole_runs=True)
            # No other run of words is more like a template than the best reported one.
            every = brute(texts[r.doc_id], templates, threshold, whole_runs=False)
            assert max((g[3] for g in got), default=0) == max((w[3] for w in every), default=0)
            several += len(got) > 1
        assert several > 10


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([("Released under the MIT License.", "a", "b")] * 2, "text string, words string, runs string")
    rows = licenses.scan(docs).collect()
    assert [(r.words, r.runs, r.licenses[0].license) for r in rows] == [("a", "b", "MIT")] * 2


def test_bounds_are_exact():
    for size in range(1, 40):
        low, high = licenses.size_bounds(size, 0.8)
        for other in range(1, 80):
            reachable = 2 * min(size, other) / (size + other) >= 0.8 - 1e-12
            assert reachable == (low <= other <= high)


def test_no_rows_and_bad_templates(spark):
    assert licenses.scan(spark.createDataFrame([], "text string")).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([], "text string"), templates=[("X", "one")])
