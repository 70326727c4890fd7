"""License scans (native: DataFrame functions only).

Units of a text, its lines and its paragraphs of several lines, are normalised (lower case, every
run of other characters than letters and digits as one space) and compared with license templates
by the Dice coefficient of their sets of word bigrams. Shared bigrams are counted by a join with
the templates' bigrams, a table of fixed size, so a unit is never compared with a template it
shares nothing with; of the rest, the size bounds of the coefficient prune the pairs that cannot
reach the threshold before anything is counted.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8

# The wording of common license notices and permission texts.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0/notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0/warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License "
    "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
    "License for the specific language governing permissions and limitations under the License.",
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "bsd/redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl/notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version.",
    "gpl/warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
    "details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit/permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
    "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit/warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
    "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_bigrams(templates: dict[str, str] = TEMPLATES) -> list[tuple[str, int, str]]:
    """license, size of its bigram set, bigram: one row for each bigram of each template."""
    rows = []
    for name, text in templates.items():
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        bigrams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        rows += [(name, len(bigrams), b) for b in bigrams]
    return rows


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def template_values(templates: dict[str, str] = TEMPLATES) -> str:
    return ", ".join(f"({', '.join(map(_literal, row))})" for row in template_bigrams(templates))


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {template_values(templates)} AS t(license, n_template, bigram)")


def _units(text: Column) -> Column:
    """kind, number and words of the lines and of the paragraphs that have several lines."""

    def numbered(kind: str, parts: Column, worth) -> Column:
        words = F.transform(
            parts,
            lambda unit, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("number"),
                F.when(worth(unit), F.filter(F.split(unit, r"[\x20\n]+"), lambda w: w != "")).alias("words"),
            ),
        )
        return F.filter(words, lambda x: x["words"].isNotNull())

    # Line feeds stay, so that lines and paragraphs can still be told apart.
    normal = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    return F.concat(
        numbered("line", F.split(normal, "\n"), lambda unit: F.lit(True)),
        numbered("paragraph", F.split(normal, r"\n(?:\x20?\n)+"), lambda unit: F.contains(unit, F.lit("\n"))),
    )


def licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, kind (line or paragraph), number (from 0), license, n_shared, n_unit, n_template, dice.

    One row for every unit and template whose coefficient is at least ``threshold``, several where
    several templates fit. Texts without a match, null and empty ones give no rows; rows that repeat
    an id and a text are reported once; units and templates of fewer than two words have no bigrams.
    """
    shortest = min((n for _, n, _ in template_bigrams(templates)), default=0)
    longest = max((n for _, n, _ in template_bigrams(templates)), default=0)
    # dice <= 2 * min / (a + b): sizes further apart than this cannot reach the threshold.
    reach = threshold / (2 - threshold)
    # The explode puts the words into a row each, so nothing below splits a text again.
    units = docs.select(
        F.col(doc_id).alias("doc_id"), F.explode(_units(F.coalesce(F.col(text), F.lit("")))).alias("u")
    ).select("doc_id", "u.*")
    bigrams = F.array_distinct(
        F.zip_with(
            F.slice("words", 1, F.size("words") - 1),
            F.slice("words", 2, F.size("words") - 1),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
    )
    sized = (
        units.filter(F.size("words") > max(1, math.floor(shortest * reach)))
        .select("doc_id", "kind", "number", F.xxhash64("words").alias("unit_key"), F.explode(F.array(bigrams)).alias("bigrams"))
        .withColumn("n_unit", F.size("bigrams"))
        .filter(F.col("n_unit").between(math.floor(shortest * reach), math.ceil(longest / reach)))
    )
    shared = (
        sized.select("doc_id", "kind", "number", "unit_key", "n_unit", F.explode("bigrams").alias("bigram"))
        .join(_templates(docs.sparkSession, templates), "bigram")
        .filter(2 * F.least("n_unit", "n_template") >= threshold * (F.col("n_unit") + F.col("n_template")))
        .groupBy("doc_id", "kind", "number", "unit_key", "license", "n_unit", "n_template")
        # Distinct: a repeated row counts once.
        .agg(F.size(F.collect_set("bigram")).alias("n_shared"))
    )
    return (
        shared.withColumn("dice", 2.0 * F.col("n_shared") / (F.col("n_unit") + F.col("n_template")))
        .filter(F.col("dice") >= threshold)
        .select("doc_id", "kind", "number", "license", "n_shared", "n_unit", "n_template", "dice")
    )
