"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
# White space in the sense of Unicode, for use within a character class.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``df``, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words_of(text: Column) -> Column:
    """Words between blanks; none for null and for blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), lambda w: w != "")


class Growing:
    """A numpy array that can be added to."""

    def __init__(self, kind) -> None:
        self.values, self.size = np.zeros(1024, kind), 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at):
        return self.values[: self.size][at]

    def add(self, new: np.ndarray) -> None:
        end = self.size + len(new)
        if end > len(self.values):
            more = np.zeros(max(end - len(self.values), len(self.values)), self.values.dtype)
            self.values = np.concatenate([self.values, more])
        self.values[self.size : end] = new
        self.size = end


def steps(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    lot = (np.cumsum(sizes, dtype="int64") - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... n times each, one after the other."""
    before = np.cumsum(n) - n
    return np.repeat(first - before, n) + np.arange(int(n.sum()))
