"""Licence notices: runs of words compared with templates by the Dice coefficient of word bigrams.

Column expressions only; every document is scanned where it is read.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm.common import documents, fresh_name

THRESHOLD = 0.8

# Common short notices, standard headers and licence bodies, by SPDX identifier.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Affero General Public License for more details.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]


def normalised(text: Column) -> Column:
    """Lower case, every run of other characters than letters and digits one blank."""
    return F.btrim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")))


def words_of(text: Column) -> Column:
    return F.filter(F.split(normalised(text), " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """The pairs of neighbouring words in order; none for fewer than two words."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)),
    )


def _plain_bigrams(text: str) -> list[str]:
    words = "".join(c if c.isalnum() else " " for c in text).lower().split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The numbers of bigrams with which a text can reach ``threshold`` against a
    template of ``size``: 2 min(a, b) / (a + b) is at least that."""
    return ceil(size * threshold / (2 - threshold) - 1e-9), floor(size * (2 - threshold) / threshold + 1e-9)


def _sized(templates: list[tuple[str, str]], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """(license, bigrams, least common bigrams, most others) of each template.

    What a window shares with the template is a part of both, so the lower size bound
    holds for the common bigrams; the upper one leaves room for the others.
    """
    out = []
    for name, notice in templates:
        grams = _plain_bigrams(notice)
        if not grams:
            raise ValueError("a template needs two words at least")
        least, most = size_bounds(len(grams), threshold)
        out.append((name, grams, least, most - len(grams)))
    return out


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
) -> DataFrame:
    """Add ``licenses``: array of (line, license, dice, first_word, last_word), by place.

    A window is a run of words of the whole text, over any number of lines or inside one.
    It is like a template by 2 |common| / (|window| + |template|) over distinct word bigrams,
    and is found when that reaches the threshold. A template is compared only if the
    text holds as many of its bigrams as its size asks for. Windows begin and end where a
    run of the template's bigrams does, as one more of them never lowers the likeness, and
    hold no more other bigrams, repeats counted, than the size bounds leave room for.

    Of windows that share a word the most like one is reported, then the longer, the
    earlier, the first by name; what shares a word with a reported one is not. Places are
    word numbers from 0; line is that of the first word, from 0.

    A null or empty text has none, as has one of fewer than two words. Rows are
    judged each by itself; an empty table gives an empty one. Other columns stay; one called
    licenses is replaced. Templates of fewer than two words raise ValueError.
    """
    sized = _sized(templates, threshold)
    known = F.array(
        *(
            F.struct(
                F.lit(name).alias("license"),
                F.array(*map(F.lit, grams)).alias("grams"),
                F.lit(least).alias("least"),
                F.lit(others).alias("others"),
            )
            for name, grams, least, others in sized
        )
    )
    vocabulary = F.array(*map(F.lit, sorted({g for _, grams, _, _ in sized for g in grams})))
    fewest = min(least for _, _, least, _ in sized)
    whole = F.coalesce(F.col(text), F.lit(""))
    names = ("words", "grams", "hits", "asked", "places", "runs", "windows", "chosen")
    words, grams, hits, asked, places, runs, windows, chosen = (fresh_name(docs.columns, n) for n in names)

    # Most documents end here: without enough bigrams of any template nothing is asked.
    out = docs.withColumn(words, words_of(whole)).withColumn(grams, bigrams(F.col(words)))
    out = out.withColumn(hits, F.array_intersect(F.col(grams), vocabulary))
    enough = F.filter(
        known,
        lambda t: (F.size(hits) >= t["least"]) & (F.size(F.array_intersect(F.col(hits), t["grams"])) >= t["least"]),
    )
    out = out.withColumn(asked, F.when(F.size(hits) >= fewest, enough))

    def place(t: Column) -> Column:
        at = F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i))
        return F.struct(t.alias("template"), F.filter(at, lambda i: i.isNotNull()).alias("at"))

    out = out.withColumn(places, F.transform(asked, place))

    def edges(at: Column, step: int) -> Column:
        """Hits without a hit beside them on one side: their place and their number."""
        edge = F.transform(
            at,
            lambda p, n: F.when(
                F.coalesce(F.get(at, n + step), F.lit(-2)) != p + step, F.struct(p.alias("place"), n.alias("number"))
            ),
        )
        return F.filter(edge, lambda e: e.isNotNull())

    out = out.withColumn(
        runs,
        F.transform(
            places, lambda x: F.struct(x["template"].alias("template"), edges(x["at"], -1).alias("first"), edges(x["at"], 1).alias("last"))
        ),
    )

    def fits(t: Column, a: Column, b: Column) -> Column:
        hit = b["number"] - a["number"] + 1
        return (hit >= t["least"]) & (b["place"] - a["place"] + 1 - hit <= t["others"])

    def window(t: Column, a: Column, b: Column) -> Column:
        part = F.slice(grams, a["place"] + 1, b["place"] - a["place"] + 1)
        common = F.size(F.array_intersect(part, t["grams"]))
        dice = 2.0 * common / (F.size(F.array_distinct(part)) + F.size(t["grams"]))
        return F.struct(
            (-dice).alias("unlike"),
            (a["place"] - b["place"]).alias("short"),
            a["place"].alias("first"),
            (b["place"] + 1).alias("last"),
            t["license"].alias("license"),
        )

    def of_template(x: Column) -> Column:
        t = x["template"]

        def from_run(a: Column, n: Column) -> Column:
            # Other bigrams lie between two runs, so a window has few runs.
            ends = F.filter(F.slice(x["last"], n + 1, t["others"] + 1), lambda b: fits(t, a, b))
            return F.transform(ends, lambda b: window(t, a, b))

        return F.flatten(F.transform(x["first"], from_run))

    out = out.withColumn(windows, F.flatten(F.transform(runs, of_template)))
    ranked = F.array_sort(F.filter(windows, lambda w: w["unlike"] <= -threshold))

    def apart(taken: Column, w: Column) -> Column:
        shared = F.exists(taken, lambda y: (y["first"] <= w["last"]) & (w["first"] <= y["last"]))
        return F.when(shared, taken).otherwise(F.concat(taken, F.array(w)))

    shape = "array<struct<unlike:double,short:int,first:int,last:int,license:string>>"
    out = out.withColumn(chosen, F.aggregate(ranked, F.array().cast(shape), apart))
    # The line of every word, looked at for texts with a notice only.
    line_of = F.flatten(F.transform(F.split(whole, "\n"), lambda part, i: F.transform(words_of(part), lambda _: i)))
    lines = fresh_name(docs.columns, "line_of")
    out = out.withColumn(lines, F.when(F.size(chosen) > 0, line_of))
    reported = F.transform(
        chosen,
        lambda w: F.struct(
            F.get(lines, w["first"]).alias("line"),
            w["license"].alias("license"),
            (-w["unlike"]).alias("dice"),
            w["first"].alias("first_word"),
            w["last"].alias("last_word"),
        ),
    )
    by_place = F.array_sort(reported, lambda a, b: a["first_word"] - b["first_word"])
    out = out.withColumn("licenses", F.coalesce(by_place, F.array().cast("array<struct<line:int,license:string,dice:double,first_word:int,last_word:int>>")))
    return out.drop(words, grams, hits, asked, places, runs, windows, chosen, lines)


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For all documents: how many notices, the first of them and its likeness."""
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))
    first = F.get("licenses", F.lit(0))
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_notices"),
        F.array_join(F.transform("licenses", lambda x: x["license"]), ",").alias("notices"),
        first["line"].cast("bigint").alias("first_line"),
        F.round(first["dice"], 6).alias("first_dice"),
    )


_TEMPLATE_ROWS = ", ".join(
    "({}, '{}', {}, {}, {})".format(n, name, "[" + ", ".join(f"'{g}'" for g in grams) + "]", least, others)
    for n, (name, grams, least, others) in enumerate(_sized(TEMPLATES, THRESHOLD))
)
# Rows of positions, runs by their distance from a row number, and windows by a join of runs.
OP8_SQL = f"""
WITH RECURSIVE templates(template, license, grams, least, others) AS (VALUES {_TEMPLATE_ROWS}),
template_grams AS (SELECT template, unnest(grams) AS gram FROM templates),
line_words AS (
  SELECT doc_id, line, list_filter(
    string_split(trim(lower(regexp_replace(part, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))), ' '), lambda w: w <> '') AS words
  FROM (
    SELECT doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS part
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  )
),
words AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY line, nth) - 1 AS place, word
  FROM (SELECT doc_id, line, unnest(range(len(words))) AS nth, unnest(words) AS word FROM line_words)
),
grams AS (
  SELECT doc_id, line, place, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY place) AS gram FROM words
),
hits AS (
  SELECT doc_id, template, place, gram, row_number() OVER (PARTITION BY doc_id, template ORDER BY place) AS nth
  FROM grams JOIN template_grams USING (gram)
),
asked AS (
  SELECT doc_id, template FROM hits JOIN templates USING (template)
  GROUP BY doc_id, template HAVING count(DISTINCT gram) >= any_value(least)
),
runs AS (
  SELECT doc_id, template, min(place) AS a, max(place) AS b, min(nth) AS n, max(nth) AS m
  FROM hits JOIN asked USING (doc_id, template) GROUP BY doc_id, template, place - nth
),
spans AS (
  SELECT x.doc_id, template, x.a, y.b
  FROM runs x JOIN runs y USING (doc_id, template) JOIN templates t USING (template)
  WHERE y.a >= x.a AND y.m - x.n + 1 >= t.least AND (y.b - x.a) - (y.m - x.n) <= t.others
),
scored AS (
  SELECT s.doc_id, s.a, s.b, t.license,
    2.0::DOUBLE * count(DISTINCT g.gram) FILTER (list_contains(t.grams, g.gram))
      / (count(DISTINCT g.gram) + any_value(len(t.grams))) AS dice
  FROM spans s JOIN templates t USING (template)
    JOIN grams g ON g.doc_id = s.doc_id AND g.place BETWEEN s.a AND s.b
  GROUP BY s.doc_id, s.a, s.b, s.template, t.license
),
ranked AS (
  SELECT doc_id, list({{'a': a, 'b': b + 1, 'license': license, 'dice': dice}}
    ORDER BY dice DESC, b - a DESC, a, license) AS all_of
  FROM scored WHERE dice >= {THRESHOLD} GROUP BY doc_id
),
chosen AS (
  SELECT doc_id, all_of[1] AS w, list_filter(all_of, lambda x: x.a > all_of[1].b OR x.b < all_of[1].a) AS rest
  FROM ranked
  UNION ALL
  SELECT doc_id, rest[1], list_filter(rest, lambda x: x.a > rest[1].b OR x.b < rest[1].a) FROM chosen WHERE len(rest) > 0
),
found AS (
  SELECT c.doc_id, count(*) AS n, string_agg(w.license, ',' ORDER BY w.a) AS notices,
    min(g.line) AS first_line, arg_min(w.dice, w.a) AS first_dice
  FROM chosen c JOIN words g ON g.doc_id = c.doc_id AND g.place = c.w.a GROUP BY c.doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_notices, coalesce(notices, '') AS notices,
  first_line::BIGINT AS first_line, round(first_dice, 6) AS first_dice
FROM documents d LEFT JOIN found USING (doc_id)
"""
