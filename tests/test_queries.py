"""Queries against their SQL twins on the smallest tables.

All of them run with CHROMALOOM_ALL=1; by default one per area.
"""

import os

import pytest
from compare import compare, database

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SOME = ("classify_reads", "read_types", "assign_homologs", "assign_fragments", "site_distance", "dedup_pairs", "contact_statistics",
        "map_resolution", "phase_pairs", "restriction_sites", "contact_matrix", "normalised_matrix", "chunk_index", "collision_duplicates")
NAMES = sorted(entry.oracle_sql()) if os.environ.get("CHROMALOOM_ALL") else SOME


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_twin(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["res", "c1", "c2", "b1", "b2", "n"]
    assert not df.isEmpty()


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
