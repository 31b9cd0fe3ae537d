"""A third of the rows on one key must not land in one task (runs last: it restarts the session)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.mark.slow
def test_hot_key_is_spread_over_tasks(tmp_path):
    import skew_check

    res = skew_check.run("/root/testdata/sf0.1", str(tmp_path / "events"))
    assert res["hot_key_share_of_rows"] > 0.3
    shares = res["largest_task_share_of_shuffled_records"]
    assert set(shares) == {"dq_report", "key_uniqueness", "duplicate_profile", "dedup_latest", "exact_quantile",
                           "enrich_shuffle_join"}
    assert all(v < 0.15 for v in shares.values()), shares
