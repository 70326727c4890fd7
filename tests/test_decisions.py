"""Decision queries look at every model."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
NAMES = "roc_points_by_model roc_points_of_class_zero_by_model best_cutoff_by_model comparison_of_all_models halving_cutoff".split()


@pytest.mark.parametrize("name", NAMES)
def test_has_rows_of_every_model(spark, name):
    found = entry.queries()[name](spark, FOLDER).select("model").distinct().collect()
    assert {r.model for r in found} == {"price", "discount"}
