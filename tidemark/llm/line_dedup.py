"""Substring dedup by lines and the sentences in them: of equal units only the earliest ranked one stays.

A passage that several documents share rarely begins and ends with a line, so a unit ends with a line and
with a sentence within it; line feeds that follow each other end one unit. A unit's digest is taken over it
in lower case with every run of blanks as one space. Occurrences rank by (doc_id, text digest, number of the
unit). The digests are grouped with a map-side minimum, so a unit that a third of the corpus shares costs
one row per map task; no join runs on the digest. Each document is then told which of its units it owns.
The others repeat an earlier occurrence. Neighbours that repeat are one run, and a run of ``min_words``
words or more, or of ``min_chars`` characters for scripts without blanks, is taken out whole, however short
its units are. A shorter run (a heading, a list mark, a common short sentence by itself) stays.
"""

from __future__ import annotations

import re
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK_RUN, BLANKS, fresh

MIN_WORDS = 5
MIN_CHARS = 30
# Where a unit ends: alike for the split of the JVM and the one of the tasks.
ENDS = r"(?<=\n)(?!\n)|(?<=[.!?][\x20\t])|(?<=[\u3002\uFF01\uFF1F])"
END = re.compile(ENDS)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _normal(unit: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(unit, BLANK_RUN, " ")))


def _own_units(docs: DataFrame) -> DataFrame:
    """key_id, key_text, owned: the numbers of the units whose earliest occurrence a document holds."""
    units = docs.select("key_id", "key_text", F.posexplode(F.split("body", ENDS, -1)).alias("number", "unit"))
    places = units.select("key_id", "key_text", "number", _normal(F.col("unit")).alias("unit")).filter("unit <> ''").select(
        F.unhex(F.md5("unit")).alias("digest"),
        # Nulls rank last.
        F.struct(F.col("key_id").isNull().alias("none"), "key_id", "key_text", "number").alias("place"),
    )
    first = places.groupBy("digest").agg(F.min("place").alias("place"))
    return first.groupBy(F.col("place.key_id").alias("key_id"), F.col("place.key_text").alias("key_text")).agg(
        F.collect_list("place.number").alias("owned")
    )


def _cut(min_words: int, min_chars: int):
    def runs(units: list[str], own: set[int]):
        """First and last number, the last exclusive, of the runs to take out."""
        first = None
        for number in range(len(units) + 1):
            again = number < len(units) and number not in own and bool(units[number].strip(BLANKS))
            if again and first is None:
                first = number
            elif not again and first is not None:
                words = [WORD.findall(unit) for unit in units[first:number]]
                if sum(map(len, words)) >= min_words or sum(len(" ".join(w).lower()) for w in words) >= min_chars:
                    yield first, number
                first = None

    @F.pandas_udf("kept string, spans array<struct<start:long,end:long>>")
    def cut(texts: pd.Series, owned: pd.Series) -> pd.DataFrame:
        kept_texts, all_spans = [], []
        for text, own in zip(texts, owned):
            units = END.split(text)
            starts = list(accumulate(map(len, units), initial=0))
            spans = [{"start": starts[a], "end": starts[b]} for a, b in runs(units, set() if own is None else set(own))]
            edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
            kept_texts.append("".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            all_spans.append(spans)
        return pd.DataFrame({"kept": kept_texts, "spans": all_spans})

    return cut


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    spans: str = "spans",
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with ``text`` cut down to what it owns, and ``spans``: what was taken out of the input
    text, as code points, end exclusive, each unit with the blank or line feed after it. Very long texts are
    cut whole; an empty table gives no rows.

    A null text is as an empty one here and comes back empty with no spans. Rows that repeat an id
    and a text are one occurrence: each of them keeps it. Rows without an id rank last. A column
    called as ``spans`` says is replaced; other extra columns pass through.
    """
    docs = docs.drop(spans)
    key_id, key_text, body, owned, cut = fresh(docs, "key_id", "key_text", "body", "owned", "cut")
    keyed = docs.withColumns({body: F.coalesce(F.col(text), F.lit(""))}).withColumns(
        {key_id: F.col(doc_id), key_text: F.xxhash64(body)}
    )
    own = _own_units(
        keyed.select(F.col(key_id).alias("key_id"), F.col(key_text).alias("key_text"), F.col(body).alias("body"))
    ).select(F.col("key_id").alias("own_id"), F.col("key_text").alias("own_text"), F.col("owned").alias(owned))
    told = keyed.join(own, keyed[key_id].eqNullSafe(own["own_id"]) & (keyed[key_text] == own["own_text"]), "left")
    # Once cut, both fields come from one call.
    result = told.withColumn(cut, _cut(min_words, min_chars)(F.col(body), F.col(owned)))
    return result.select(
        *[F.col(cut)["kept"].alias(c) if c == text else F.col(c) for c in docs.columns], F.col(cut)["spans"].alias(spans)
    )
