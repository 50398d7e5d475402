"""Every registered query against its SQL, with wide and with very narrow slices."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_module
from compare import assert_same, oracle_connection

QUERIES, ORACLES = entry_module.QUERIES, entry_module.ORACLES


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_default_slices(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert_same(df, duck, ORACLES[name])
    else:
        assert df.count() > 0


#: Queries whose plans cut groups into slices or blocks.
SLICED = """
at_most_once_gaps auto_ack_commits commit_by_size commit_by_size_stream commit_each commit_size_or_interval consumer_blocks
correlate_results e2e_latency e2e_latency_by_type exactly_once_abort fire_and_forget flatten_batches latency_percentiles
partition_order_check poll_batches process_by_partition producer_window_stats_anchored read_committed scan_topic send_append
send_append_existing send_chain send_results send_stop_on_error send_transactional transfer_commits txn_anchored_stream
txn_anchored_window txn_count_window txn_offsets txn_visible
""".split()


@pytest.mark.parametrize("name", SLICED)
def test_narrow_slices(narrow, duck, name):
    assert_same(QUERIES[name](narrow, SF_DIR), duck, ORACLES[name])
