"""Licence scan: normalised text compared to licence templates by the Dice
coefficient over word bigrams, in DataFrame functions only.

A text is compared whole, by paragraph (cut at blank lines), by line, by
sentence (also over a line break), and by runs of consecutive blocks (cut at
lines without a word), so that a licence of several paragraphs is found inside
a longer text. Normalising keeps lower-case ASCII letters and digits in words. A
Dice coefficient of at least ``t`` bounds the sizes: a unit's number of
distinct bigrams lies between t / (2 - t) and (2 - t) / t times the
template's, so other pairs are never compared. It also bounds what a unit can
miss of a template, so a text that has none of a few chosen bigrams of each
template cannot match and is passed over whole. Everything happens within the
row; nothing is shuffled.
"""

from __future__ import annotations

import math
import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.licenses import MORE

THRESHOLD = 0.9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where a text is cut: paragraphs, lines, sentences.
CUTS = (r"\n[ \t\r]*\n", r"\n", r"\n|(?<=[.!?;:])[ \t\r]+")
#: Blocks, whose runs are units, and their sentences, wrapped or not.
BLOCK_CUT = r"\n[^a-z0-9\n]*\n"
WRAPPED_CUT = BLOCK_CUT + r"|(?<=[.!?;:])[ \t\r\n]+"

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

#: Up to so many bigrams of a unit its templates are looked up by this number.
INDEXED = 400

#: Licences and the usual notices of them; ``licenses.MORE`` has the others.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. """
    + _WARRANTY,
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the
License.""",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
}


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams, in order."""
    words = _words(text)
    return list(dict.fromkeys(map(" ".join, zip(words, words[1:]))))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Least and largest number of bigrams of a unit that can reach
    ``threshold`` with a template of ``size``."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def run_bounds(grams: int, words: int, threshold: float) -> tuple[int, int]:
    """Least and largest number of words of a run of blocks that is compared
    with a template of so many bigrams and words: it may repeat its own words
    as much as the template does."""
    return bounds(grams, threshold)[0] + 1, math.floor(words * (2 - threshold) / threshold + 1e-9)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _grams(text: Column) -> Column:
    """Word bigrams of a normalised text, repeats included."""
    of = lambda w: F.when(
        F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat(w[i - 1], F.lit(" "), w[i]))
    ).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(F.split(text, " ")), of)[0]


def _runs(blocks: Column, ranges: list[tuple[int, int]], known: list[str], share: float) -> Column:
    """The runs of (normalised, not empty) blocks that may match a template:
    the number of words lies in one of the ranges, and of the bigrams, those into
    each block too, at least ``share`` a word are ``known`` ones of the templates.

    A run is tried only between two blocks that have a known bigram: one that
    matches still does without a block at its end that has none. So blocks of
    other text cost nothing but their own bigrams, however many they are."""
    most = max(b for _, b in ranges)
    # Each block behind the last word of the one before it.
    joined = lambda x: F.transform(
        x, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.substring_index(F.get(x, i - 1), " ", -1), F.lit(" "), p))
    )
    sums = lambda counts: F.aggregate(counts, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    count = lambda p, h: F.when(F.size(h) == 0, 0).otherwise(F.size(F.filter(_grams(p), lambda g: F.array_contains(h, g))))

    def counted(x: Column) -> Column:
        """The blocks that have a known bigram, and sums of words and known bigrams in front of each."""
        here = F.array_intersect(_grams(F.array_join(x, " ")), F.split(F.lit("|".join(known)), "[|]"))
        hits = F.transform(F.array(here), lambda h: F.transform(joined(x), lambda p: count(p, h)))[0]
        at = lambda y: F.filter(F.sequence(F.lit(0), F.size(y["hits"]) - 1), lambda i: F.get(y["hits"], i) > 0)
        words = lambda y: sums(F.transform(y["blocks"], lambda p: F.size(F.split(p, " "))))
        whole = lambda y: F.struct(y["blocks"].alias("blocks"), at(y).alias("at"), words(y).alias("words"), sums(y["hits"]).alias("hits"))
        return F.transform(
            F.array(F.struct(x.alias("blocks"), hits.alias("hits"))), lambda y: F.when(F.exists(y["hits"], lambda n: n > 0), whole(y))
        )[0]

    def of_start(x: Column, k: Column) -> Column:
        i = x["at"][k]
        words = lambda j: x["words"][j + 1] - x["words"][i]
        near = lambda j: x["hits"][j + 1] - x["hits"][i] >= share * words(j)
        ends = F.filter(
            F.slice(x["at"], k + 1, F.lit(most)), lambda j: reduce(operator.or_, [words(j).between(a, b) for a, b in ranges]) & near(j)
        )
        return F.transform(ends, lambda j: F.array_join(F.slice(x["blocks"], i + 1, j - i + 1), " "))

    # one struct in an array, so that the sums are made once
    each = F.transform(
        F.filter(F.transform(F.array(blocks), lambda x: F.when(F.size(x) > 0, counted(x))), lambda x: x.isNotNull()),
        lambda x: F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["at"]) - 1), lambda k: of_start(x, k))),
    )
    return F.flatten(each)


def needles(grams: list[str], threshold: float) -> set[str]:
    """Words of a template of which every unit that reaches ``threshold`` has
    one: such a unit shares at least ``size * threshold / (2 - threshold)``
    bigrams, so it cannot miss all bigrams of words that together stand in more
    than the rest. Long words come first, being rare."""
    need = len(grams) - bounds(len(grams), threshold)[0] + 1
    words = sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w))
    chosen: set[str] = set()
    for w in words:
        if sum(any(x in chosen for x in g.split()) for g in grams) >= need:
            break
        chosen.add(w)
    return chosen


def any_word(words: set[str]) -> str:
    """A pattern for any of the words, tried only where a word begins, letter
    by letter."""

    def rest(ends: set[str]) -> str:
        heads = sorted({x[0] for x in ends if x})
        branches = [h + rest({x[1:] for x in ends if x[:1] == h}) for h in heads]
        if not branches:
            return ""
        joined = branches[0] if len(branches) == 1 and "" not in ends else f"(?:{'|'.join(branches)})"
        return joined + ("?" if "" in ends else "")

    return f"(?i)(?<![a-z0-9]){rest(words)}(?![a-z0-9])"


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, license, dice, n_units``: for each document and each template
    that some unit of it reaches ``threshold`` with, the best coefficient and
    how many different units reach it.

    A run of blocks is compared if its number of words is one that ``run_bounds``
    gives for some template, its first and last block have a bigram of some
    template, and enough of its bigrams are of templates. Units that normalise to the same words count once. Null and empty texts,
    texts of one word, and templates of one word match nothing. Rows that
    repeat are scanned each on its own. Of the templates that a unit reaches
    only those of its best coefficient count (versions of a licence are much
    alike); those that tie all come out.
    """
    texts = [(k, v) for k, v in TEMPLATES.items()] + [(k, v) for k, vs in MORE.items() for v in vs] if templates is None else list(templates.items())
    named = [(k, b, v) for k, v in texts if (b := bigrams(v))]
    if not named:
        named = [("", ["no such"], "no such")]
        docs = docs.limit(0)
    sizes = [bounds(len(b), threshold) for _, b, _ in named]
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    short = [b for (_, b, _), (_, most) in zip(named, sizes, strict=True) if most <= INDEXED]
    long = [(b, least) for (_, b, _), (least, most) in zip(named, sizes, strict=True) if most > INDEXED]
    pattern = lambda grams: any_word({w for b in grams for w in needles(b, threshold)})
    of_short, of_long = pattern(short), pattern([b for b, _ in long])
    at_least = 2 * min((n for _, n in long), default=0)  # characters, as a bigram begins with a word and a space

    def may(text: Column) -> Column:
        """Whether a text, or a unit, may match at all."""
        found = text.rlike(of_short) if short else F.lit(False)
        return found | ((F.length(text) >= at_least) & text.rlike(of_long)) if long else found

    some = some.where(may(F.col("text")))
    normal = lambda u: F.btrim(F.regexp_replace(u, "[^a-z0-9]+", " "))
    of_runs = [run_bounds(len(b), len(_words(v)), threshold) for _, b, v in named]
    known = sorted({g for _, b, _ in named for g in b})
    # a run that a template allows shares at least its least number of bigrams
    share = min((low - 1) / high for low, high in of_runs)
    blocks = F.filter(F.transform(F.split("t", BLOCK_CUT, -1), normal), lambda u: u != "")
    pieces = F.concat(F.array("t"), *[F.split("t", cut, -1) for cut in (*CUTS, WRAPPED_CUT)])
    units = some.select("doc_id", F.translate("text", _UPPER, _LOWER).alias("t")).select(
        "doc_id", F.filter(F.array_distinct(F.concat(F.transform(pieces, normal), _runs(blocks, _merged(of_runs), known, share))), may).alias("units")
    )
    grams = units.select(
        "doc_id",
        F.expr(
            "transform(filter(transform(units, u -> split(u, ' ')), w -> size(w) > 1), "
            "w -> array_distinct(transform(sequence(1, size(w) - 1), i -> concat(w[i - 1], ' ', w[i]))))"
        ).alias("grams"),
    )
    quoted = lambda x: "'" + x.replace("'", "\\'") + "'"
    entries = [
        f"named_struct('license', {quoted(k)}, 't', split({quoted('|'.join(b))}, '[|]'), 'least', {least}, 'most', {most})"
        for (k, b, _), (least, most) in zip(named, sizes, strict=True)
    ]
    table = F.expr(f"array({', '.join(entries)})")
    of_size: list[list[int]] = [[] for _ in range(INDEXED + 1)]
    for i, (least, most) in enumerate(sizes):
        for n in range(least, min(most, INDEXED) + 1):
            of_size[n].append(i + 1)
    index = F.expr("array(" + ", ".join(f"cast(array({', '.join(map(str, x))}) as array<int>)" for x in of_size) + ")")
    over = [i for i, (_, most) in enumerate(sizes) if most > INDEXED]
    longs = F.expr(f"array({', '.join(entries[i] for i in over)})" if over else f"filter(array({entries[0]}), x -> false)")

    def compared(b: Column) -> Column:
        """The templates that a unit reaches and is most like."""
        by_size = F.transform(F.element_at(index, F.size(b) + 1), lambda i: F.element_at(table, i))
        fit = F.when(F.size(b) <= INDEXED, by_size).otherwise(F.filter(longs, lambda t: F.size(b).between(t["least"], t["most"])))
        dice = F.transform(
            fit,
            lambda t: F.struct(
                t["license"].alias("license"),
                (2.0 * F.size(F.array_intersect(b, t["t"])) / (F.size(b) + F.size(t["t"]))).alias("dice"),
            ),
        )
        # one struct in an array, so that the coefficients are counted once
        each = F.transform(
            F.array(F.filter(dice, lambda m: m["dice"] >= threshold)),
            lambda x: F.array_distinct(F.filter(x, lambda m: m["dice"] == F.array_max(F.transform(x, lambda y: y["dice"])))),
        )
        return F.flatten(each)

    found = grams.select("doc_id", F.flatten(F.transform("grams", compared)).alias("found")).where(F.size("found") > 0)
    names = F.array_distinct(F.transform("found", lambda m: m["license"]))

    def best(name: Column) -> Column:
        own = F.filter("found", lambda m: m["license"] == name)
        return F.struct(
            name.alias("license"),
            F.array_max(F.transform(own, lambda m: m["dice"])).alias("dice"),
            F.size(own).cast("long").alias("n_units"),
        )

    return found.select("doc_id", F.explode(F.transform(names, best)).alias("m")).select("doc_id", "m.*")


def digest(docs: DataFrame) -> DataFrame:
    """``scan`` with the coefficient rounded to six places."""
    return scan(docs).withColumn("dice", F.round("dice", 6))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


#: DuckDB SQL for ``digest`` over ``documents``, without any pruning, and
#: without the runs of blocks, the wrapped sentences and ``licenses.MORE``.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, translate(text, '{_UPPER}', '{_LOWER}') AS t FROM documents),
u AS (
  SELECT doc_id, list_distinct(list_transform(
    list_concat([t], list_concat({"string_split_regex(t, '" + CUTS[0] + "')"}, list_concat(
      {"string_split_regex(t, '" + CUTS[1] + "')"}, string_split_regex(regexp_replace(t, '([.!?;:])[ \t\r]+', '\1' || chr(10), 'g'), '\n')))),
    lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g')))) AS units FROM d),
w AS (SELECT doc_id, string_split(unnest(units), ' ') AS w FROM u),
b AS (SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM w WHERE len(w) > 1),
t AS (SELECT unnest([{", ".join("{'license': '" + k + "', 't': " + _sql_list(bigrams(v)) + "}" for k, v in TEMPLATES.items())}], recursive := true)),
m AS (SELECT doc_id, license, 2.0 * len(list_intersect(b, t.t)) / (len(b) + len(t.t)) AS dice FROM b, t)
SELECT doc_id, license, round(max(dice), 6) AS dice, count(*) AS n_units
FROM m WHERE dice >= {THRESHOLD} GROUP BY doc_id, license
"""
