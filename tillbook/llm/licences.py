"""License scans (5), native: Dice coefficient over word bigrams against licence templates.

A segment of a text is one of its lines, one of its paragraphs (parted by empty lines) or the whole
text; equal segments of a text count once. Segments and templates are normalised alike: lower-cased,
every run of characters other than letters and digits made one blank. The Dice coefficient of two
texts is twice the number of word bigrams they share, with their multiplicities, over the sum of
their numbers of bigrams; a text of one word has that word for its only bigram.

Size bounds: with a bigrams in the template and b in the segment, Dice >= t needs
a * t / (2 - t) <= b <= a * (2 - t) / t. Segments of a length that fits no template are dropped
before they are cut into words; the rest meet only the templates they fit. All of this is
narrow; only the few scores that reach the threshold are grouped by document.

Templates are a parameter, a list of (name, text) in the plan, at most ``MAX_TEMPLATES`` of them.

Result: one row per document row and template that some segment reaches: doc_id, licence, dice (of
the best segment) and n_segments (how many reach it). Null and empty texts match nothing. Rows
that repeat a doc_id give rows of their own; an empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import table
from tillbook.session import configure

THRESHOLD = 0.8
MAX_TEMPLATES = 1000
DIGITS = 9
# Short notices as their licences recommend them: fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("All-rights-reserved", "All rights reserved."),
)


def template_bigrams(text: str) -> Counter:
    """The bigrams of a template with their multiplicities."""
    words = re.findall(r"[^\W_]+", text.lower())
    return Counter(words if len(words) == 1 else [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)])


def _bounds(a: int, threshold: float) -> tuple[float, float]:
    return a * threshold / (2 - threshold) - 1e-9, a * (2 - threshold) / threshold + 1e-9


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """The licences of ``docs`` (doc_id, text)."""
    configure(docs.sparkSession)
    known = [(name, template_bigrams(text)) for name, text in templates]
    known = [(name, b, b.total()) for name, b in known if b]
    if not 0 < len(known) <= MAX_TEMPLATES:
        raise ValueError(f"{len(known)} templates with words; from 1 to {MAX_TEMPLATES} are accepted")
    ends = [_bounds(a, threshold) for _, _, a in known]
    lowest, highest = min(e[0] for e in ends), max(e[1] for e in ends)

    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\n]+", " ")
    docs = docs.where(F.col("text").isNotNull()).select("doc_id", F.monotonically_increasing_id().alias("row"), plain.alias("plain"))
    joined = F.transform(F.concat(F.split("plain", r"\n(?: ?\n)+"), F.array("plain")), lambda s: F.regexp_replace(s, r"[ \n]+", " "))
    segments = F.transform(F.concat(F.split("plain", "\n"), joined), lambda s: F.trim(s))
    size = lambda s: F.greatest(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))), F.lit(1))  # noqa: E731  bigrams
    fitting = F.filter(segments, lambda s: (s != "") & (size(s) >= lowest) & (size(s) <= highest))
    rows = docs.select("doc_id", "row", F.explode(F.array_distinct(fitting)).alias("segment"))

    words = F.col("words")
    pairs = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat(w, F.lit(" "), F.element_at(words, i + 2)))
    rows = rows.select("doc_id", "row", F.split("segment", " ").alias("words"))
    rows = rows.select("doc_id", "row", F.when(F.size("words") == 1, words).otherwise(pairs).alias("grams"))
    every = sorted({g for _, b, _ in known for g in b})
    rows = rows.where(F.arrays_overlap("grams", F.array(*map(F.lit, every))))

    listed = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, b)).alias("has"),
                                F.array(*map(F.lit, b.values())).alias("times"), F.lit(a).alias("a"),
                                F.lit(low).alias("low"), F.lit(high).alias("high"))
                       for (name, b, a), (low, high) in zip(known, ends, strict=True)])
    b = F.size("grams")
    met = rows.select("doc_id", "row", "grams", F.explode(F.filter(listed, lambda t: (b >= t.low) & (b <= t.high))).alias("t"))
    each = F.zip_with("t.has", "t.times", lambda g, n: F.least(n, F.size(F.filter("grams", lambda x: x == g))))
    shared = F.aggregate(each, F.lit(0), lambda x, y: x + y)
    scored = met.select("doc_id", "row", "t.licence", F.round(2 * shared / (b + F.col("t.a")), DIGITS).alias("dice"))
    return (scored.where(F.col("dice") >= threshold).groupBy("row", "doc_id", "licence")
            .agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_segments")).drop("row"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the whole documents table against TEMPLATES."""
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def oracle() -> str:
    """The same in DuckDB, without the size bounds."""
    known = [(name, template_bigrams(text)) for name, text in TEMPLATES]
    grams = ", ".join(f"('{name}', '{g}', {n}, {b.total()})" for name, b in known for g, n in b.items())
    return f"""
WITH t(licence, gram, times, a) AS (VALUES {grams}),
p AS (SELECT doc_id, row_number() OVER () AS line, regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS plain
      FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, line, unnest(string_split(plain, chr(10))) AS piece FROM p
      UNION ALL SELECT doc_id, line, unnest(regexp_split_to_array(plain, '\\n(?: ?\\n)+')) FROM p
      UNION ALL SELECT doc_id, line, plain FROM p),
u AS (SELECT DISTINCT doc_id, line, trim(regexp_replace(piece, '[ \\n]+', ' ', 'g')) AS segment FROM s),
w AS (SELECT doc_id, line, segment, string_split(segment, ' ') AS words FROM u WHERE segment <> ''),
g AS (SELECT doc_id, line, segment, CASE WHEN len(words) = 1 THEN words
             ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END AS grams FROM w),
e AS (SELECT doc_id, line, segment, len(grams) AS b, unnest(grams) AS gram FROM g),
n AS (SELECT doc_id, line, segment, b, gram, count(*) AS k FROM e GROUP BY ALL),
d AS (SELECT doc_id, line, licence, segment, round(2 * CAST(sum(least(k, times)) AS BIGINT) / CAST(any_value(a + b) AS DOUBLE), {DIGITS}) AS dice
      FROM n JOIN t USING (gram) GROUP BY doc_id, line, licence, segment)
SELECT doc_id, licence, max(dice) AS dice, count(*) AS n_segments FROM d WHERE dice >= {THRESHOLD} GROUP BY doc_id, line, licence
"""
