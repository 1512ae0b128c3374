"""License scans with DataFrame operations only: Dice coefficient over word bigrams against templates.

Texts are normalised: lower case, everything but letters and digits a space. Two things are held against the
templates. Units of a text (each line with words, each paragraph of several lines, and the whole text): a unit
and a template of a and b different bigrams can only reach Dice t if t / (2 - t) * b <= a <= (2 - t) / t * b, so
a unit meets the templates of fitting size alone, and units that fit none are dropped before their bigrams are
made. And windows as long as the template anywhere in the text, for notices inside longer lines: a window that
reaches t holds t / (2 - t) of the template's bigrams at least, so only templates of which the text has that
many are looked for.

Templates are a parameter (rows of name and text, whole licences or notices); those below are notices and the
texts of short licences.

Defined results: null or empty text has no licence; a unit of one word has no bigrams and never matches;
ties go to the template first by name; equal rows give equal results; very long texts are scanned whole; an
empty table gives no rows; other columns are not read, whatever their names. Bigrams are compared by 64-bit
hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.llm.common import LOWER, UPPER, lower_ascii, table
from landweave.llm.op4_quality import bound, steps

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT = _GRANT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD_OPEN = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THREE = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."

#: Templates by name: notices and short licences as they are published (fixed values).
TEMPLATES = {
    "0BSD": _ISC_GRANT + "." + _ISC_END,
    "AGPL-3.0-notice": _GNU.format(name="Affero", version=3),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-2-Clause": _BSD_OPEN + _BSD_TWO + _BSD_END,
    "BSD-3-Clause": _BSD_OPEN + _BSD_TWO + _BSD_THREE + _BSD_END,
    "BSD-opening": _BSD_OPEN,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0-notice": _GNU.format(name="", version=2),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": _GNU.format(name="", version=3),
    "ISC": _ISC_GRANT + _ISC_KEEP + _ISC_END,
    "ISC-notice": _ISC_GRANT + _ISC_KEEP,
    "LGPL-3.0-notice": _GNU.format(name="Lesser", version=3),
    "MIT": "Released under the MIT License.",
    "MIT-full": _MIT,
    "MIT-notice": _GRANT,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


WORDS = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Template:
    name: str
    text: str

    @property
    def pairs(self) -> list[tuple[str, str]]:
        """Different word bigrams, in order."""
        return list(dict.fromkeys(zip(self.words, self.words[1:], strict=False)))

    @property
    def words(self) -> list[str]:
        """As words_of: runs of letters and digits of any script, A-Z in lower case."""
        return regex.findall(WORDS, self.text.translate(str.maketrans(UPPER, LOWER)))


def words_of(unit: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(unit), F.lit(WORDS), 0)


def bigrams(words: Column) -> Column:
    return F.array_distinct(steps(words, lambda a, b: F.xxhash64(a, b)))


def units_of(text: Column) -> Column:
    """Different lines with words, paragraphs of several lines, and the whole text if it has several lines."""
    lines = F.split(text, "\n", -1)
    paragraphs = F.filter(F.split(text, r"\n[\x20\t\r]*\n", -1), lambda p: F.contains(p, F.lit("\n")))
    whole = F.when(F.contains(text, F.lit("\n")), F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(lines, paragraphs, whole))


def hashed(spark: SparkSession, templates: tuple[Template, ...]) -> dict[str, list[int]]:
    """The hashes of each template's bigrams."""
    # words are letters and digits alone, so they stand in the text as they are
    rows = ", ".join(f"({i}, '{a}', '{b}')" for i, t in enumerate(templates) for a, b in t.pairs)
    found = spark.sql(f"SELECT i, collect_set(xxhash64(a, b)) AS h FROM VALUES {rows} AS t(i, a, b) GROUP BY i").collect()
    return {templates[r["i"]].name: r["h"] for r in found}


def longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in sorted(values))})")


def best_of(found: list[Column], threshold: float) -> Column:
    """(less, name) of the greatest Dice (less is its negative), null if none reaches threshold."""
    return bound(F.array_min(F.array_compact(F.array(*found))), lambda b: F.when(-b["less"] >= threshold, b))


def hit(dice: Column, t: Template) -> Column:
    return F.struct((-dice).alias("less"), F.lit(t.name).alias("name"))


def best_template(grams: Column, templates: tuple[Template, ...], own: dict[str, list[int]], threshold: float) -> Column:
    """The best template for a unit's bigrams."""
    found = []
    for t in templates:
        n = len(t.pairs)
        low, high = threshold / (2 - threshold) * n, (2 - threshold) / threshold * n
        dice = F.size(F.array_intersect(grams, longs(own[t.name]))) * 2.0 / (F.size(grams) + n)
        found.append(F.when(F.size(grams).between(low - 1e-9, high + 1e-9), hit(dice, t)))
    return best_of(found, threshold)


def best_window(grams: Column, own: Column, n: int, long: int) -> Column:
    """The greatest Dice of own (n bigrams) with long bigrams of grams in a row."""
    dice = lambda i: bound(F.array_distinct(F.slice(grams, i, long)), lambda g: F.size(F.array_intersect(g, own)) * 2.0 / (F.size(g) + n))
    return F.array_max(F.transform(F.sequence(F.lit(1), F.size(grams) - long + 1), dice))


def reached(dice: Column, t: Template, threshold: float) -> Column:
    return bound(dice, lambda d: F.when(d >= threshold, hit(d, t)))


def windows_of(grams: Column, templates: tuple[Template, ...], own: dict[str, list[int]], threshold: float) -> Column:
    """The templates that some window of their own length reaches, each with its best Dice; grams: the text's bigrams in order."""
    every = longs(sorted({h for t in templates for h in own[t.name]}))

    def looked_for(common: Column) -> Column:
        found = []
        for t in templates:
            n, long = len(t.pairs), len(t.words) - 1
            best = best_window(grams, longs(own[t.name]), n, long)
            enough = F.size(F.array_intersect(common, longs(own[t.name]))) >= threshold / (2 - threshold) * n - 1e-9
            found.append(F.when(enough & (F.size(grams) >= long), reached(best, t, threshold)))
        return F.array_compact(F.array(*found))

    none = F.array().cast("array<struct<less:double,name:string>>")
    return bound(F.array_intersect(F.array_distinct(grams), every), lambda common: F.when(F.size(common) > 0, looked_for(common)).otherwise(none))


def find_licenses(docs: DataFrame, templates: tuple[Template, ...] | DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license (best template or null), dice, n_matches (units that match, and templates found by a window) and licenses (all names, ascending).

    templates: as a tuple, or a table of name and text, which people keep and the driver reads.
    """
    if isinstance(templates, DataFrame):
        templates = tuple(Template(r["name"], r["text"]) for r in templates.select("name", "text").collect())
    templates = tuple(t for t in sorted(templates, key=lambda t: t.name) if t.pairs)
    own, sizes = hashed(docs.sparkSession, templates), [len(t.pairs) for t in templates]
    low, high = threshold / (2 - threshold) * min(sizes), (2 - threshold) / threshold * max(sizes)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a unit has a bigram less than words at most, and a word two characters with the gap behind it
    fits = lambda u: F.char_length(u) >= 2 * low
    judged = F.transform(F.filter(units_of(text), fits), lambda u: bound(words_of(u), lambda w: F.when(F.size(w) > low, bound(bigrams(w), lambda g: F.when(F.size(g) <= high + 1e-9, best_template(g, templates, own, threshold))))))
    inside = bound(words_of(text), lambda w: bound(steps(w, lambda a, b: F.xxhash64(a, b)), lambda g: windows_of(g, templates, own, threshold)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.concat(F.array_compact(judged), inside).alias("m"))
    best = F.array_min("m")
    return rows.select("doc_id", best["name"].alias("license"), (-best["less"]).alias("dice"), F.size("m").cast("long").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda x: x["name"]))), ",").alias("licenses"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"), tuple(Template(k, v) for k, v in TEMPLATES.items()))


def _sql() -> str:
    rows = ", ".join("('{}', '{}', '{}')".format(k, a, b) for k, v in TEMPLATES.items() for a, b in Template(k, v).pairs)
    long = ", ".join(f"('{k}', {len(Template(k, v).words) - 1})" for k, v in TEMPLATES.items())
    return rf"""
WITH t(name, a, b) AS (VALUES {rows}),
tl(name, l) AS (VALUES {long}),
tn AS (SELECT name, count(*) AS n FROM t GROUP BY name),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT DISTINCT doc_id, unit FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM d
    UNION ALL SELECT doc_id, p FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '
[ 	
]*
')) AS p FROM d) WHERE contains(p, chr(10))
    UNION ALL SELECT doc_id, text FROM d WHERE contains(text, chr(10)))),
w AS (SELECT doc_id, unit, regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{{L}}\p{{N}}]+') AS words FROM u),
g AS (SELECT DISTINCT doc_id, unit, words[i] AS a, words[i + 1] AS b FROM (SELECT *, unnest(range(1, len(words))) AS i FROM w)),
gn AS (SELECT doc_id, unit, count(*) AS n FROM g GROUP BY doc_id, unit),
x AS (SELECT doc_id, unit, name, count(*) AS both_have FROM g JOIN t ON g.a = t.a AND g.b = t.b GROUP BY ALL),
s AS (SELECT x.doc_id, x.unit, x.name, both_have * 2.0::DOUBLE / (gn.n + tn.n) AS dice FROM x JOIN gn ON gn.doc_id = x.doc_id AND gn.unit = x.unit JOIN tn ON tn.name = x.name),
m0 AS (SELECT doc_id, name, dice FROM s WHERE dice >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, name) = 1),
wd AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{{L}}\p{{N}}]+') AS words FROM d),
p AS MATERIALIZED (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, len(words) - 1 AS k FROM (SELECT *, unnest(range(1, len(words))) AS i FROM wd)),
cm AS (SELECT doc_id, t.name, any_value(k) AS k FROM p JOIN t ON t.a = p.a AND t.b = p.b JOIN tn ON tn.name = t.name GROUP BY doc_id, t.name, tn.n HAVING count(DISTINCT (p.a, p.b)) >= 0.8::DOUBLE / 1.2 * tn.n - 1e-9),
st AS (SELECT doc_id, cm.name, l, unnest(range(1, CAST(k - l + 2 AS BIGINT))) AS s FROM cm JOIN tl ON tl.name = cm.name WHERE k >= l),
wg AS (SELECT DISTINCT st.doc_id, st.name, s, a, b FROM st JOIN p ON p.doc_id = st.doc_id AND p.i >= s AND p.i < s + l),
wn AS (SELECT wg.doc_id, wg.name, s, count(*) AS n, count(t.a) AS c FROM wg LEFT JOIN t ON t.name = wg.name AND t.a = wg.a AND t.b = wg.b GROUP BY ALL),
wm AS (SELECT doc_id, wn.name, max(c * 2.0::DOUBLE / (wn.n + tn.n)) AS dice FROM wn JOIN tn ON tn.name = wn.name GROUP BY ALL),
m AS (SELECT * FROM m0 UNION ALL SELECT * FROM wm WHERE dice >= 0.8),
r AS (SELECT doc_id, count(*) AS n, max(dice) AS dice, array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses FROM m GROUP BY doc_id),
b AS (SELECT doc_id, min(name) AS license FROM (SELECT m.* FROM m JOIN r ON r.doc_id = m.doc_id AND r.dice = m.dice) GROUP BY doc_id)
SELECT d.doc_id, b.license, r.dice, coalesce(r.n, 0) AS n_matches, coalesce(r.licenses, '') AS licenses
FROM d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id
"""


SQL = _sql()
