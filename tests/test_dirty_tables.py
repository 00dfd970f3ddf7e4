"""Registered queries on empty tables, and against their SQL on tables with nulls."""

import random

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from compare import compare, connect
from retailflow.plans import catalogue
from retailflow.sources.sample_tables import TABLES
from tests.conftest import SF_DIR

ORACLES = contract.oracle_sql()
#: Queries whose input may be empty where a plan reads files that a load would have made.
ON_NOTHING = [
    "lakehouse_orders", "lakehouse_payments", "lakehouse_payments_by_month", "lakehouse_reviews", "warehouse_orders",
    "headerless_csv_scan", "text_stack_scan", "refreshed_dimension", "dimension_pipeline", "merge_moved_partition",
    "merge_null_partition", "merge_by_key_index", "profile_merged", "profile_approximate", "stream_state_updates",
    "landing_rejects", "review_sample", "order_events_wide", "stream_snapshot_then_tail", "stream_batch_counts",
    "state_as_of_snapshots",
]
NULLS = {
    "orders": ["o_orderdate", "o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_shipdate", "l_orderkey"],
    "documents": ["text", "source"],
    "events": ["ts", "user_id", "event_type"],
}
WITH_NULLS = [
    "lifecycle_events", "event_ttl", "stage_counts", "items_at_purchase", "first_order_per_customer", "lakehouse_payments",
    "lakehouse_payments_by_month", "lakehouse_reviews", "merge_by_key_index", "merge_moved_partition", "profile_merged",
    "stream_state_updates", "landing_rejects", "review_sample", "order_events_wide", "order_events_wide_split",
    "stream_snapshot_then_tail", "stream_batch_counts",
]


def dirty(folder, change):
    for name in TABLES:
        pq.write_table(change(name, pq.read_table(f"{SF_DIR}/{name}.parquet")), f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    return dirty(tmp_path_factory.mktemp("empty"), lambda name, t: t.slice(0, 0))


@pytest.fixture(scope="module")
def holes(tmp_path_factory):
    rng = random.Random(1)

    def change(name, t):
        for c in NULLS.get(name, []):
            field = t.schema.field(c)
            mask = pa.array([rng.random() < 0.08 for _ in range(t.num_rows)])
            t = t.set_column(t.column_names.index(c), field, pc.if_else(mask, pa.scalar(None, field.type), t[c]))
        return t

    return dirty(tmp_path_factory.mktemp("holes"), change)


@pytest.mark.parametrize("name", ON_NOTHING)
def test_query_on_empty_tables(spark, nothing, name):
    assert compare(spark, connect(nothing), contract.queries()[name], ORACLES[name], nothing) == ""


@pytest.mark.parametrize("name", WITH_NULLS)
def test_query_on_tables_with_nulls(spark, holes, name):
    assert compare(spark, connect(holes), contract.queries()[name], ORACLES[name], holes) == ""


def test_snapshots_on_tables_with_nulls(spark, holes):
    """Equal to the fold of the whole log; a null final status stays null, which the SQL of both takes as created."""
    got, want = (contract.queries()[name](spark, holes) for name in ("state_as_of_snapshots", "state_as_of"))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_lists_name_queries():
    catalogue.load()
    assert set(ON_NOTHING + WITH_NULLS) <= set(catalogue.QUERIES)
