"""Invariants of the reports on the driver's sf0.01 tables."""

from __future__ import annotations

from collections import Counter

import pytest
import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    return lambda key: E.queries()[key](spark, SF)


def test_cumulative_share_rises_to_100(q):
    rows = sorted(q("product_pareto").collect(), key=lambda r: (r.revenue_rank, -r.total_revenue))
    shares = [r.cumulative_revenue_pct for r in rows]
    assert shares == sorted(shares)
    assert shares[-1] == 100.0
    ranks = [r.revenue_rank for r in rows]
    assert ranks[0] == 1 and ranks == sorted(ranks)


def test_month_zero_is_full_retention(q):
    rows = q("cohort_retention").where("month_number = 0").collect()
    assert rows and all(r.retention_rate_pct == 100.0 and r.retained_customers == r.cohort_customers
                        for r in rows)


def test_segment_shares_sum_to_100(q):
    pct = [r.pct_of_customers for r in q("rfm_segments").collect()]
    assert abs(sum(pct) - 100.0) <= 0.05 * len(pct)


def test_tiles_are_balanced(q):
    s = q("customer_rfm_scores")
    n = s.count()
    for col in ("r_score", "f_score", "m_score"):
        sizes = Counter(r[0] for r in s.select(col).collect())
        assert set(sizes) == {1, 2, 3, 4, 5}
        assert max(sizes.values()) - min(sizes.values()) <= 1
        assert sum(sizes.values()) == n


def test_label_counts_match_customers(q):
    total = sum(r.customer_count for r in q("rfm_segments").collect())
    assert total == q("customer_rfm_metrics").count()
    flipped = sum(r.customer_count for r in q("rfm_segments_five_is_best").collect())
    assert flipped == total


def test_channel_counts_add_up(q):
    for r in q("channel_quality").collect():
        assert r.completed + r.returned <= r.total_orders
        assert r.revenue_rank >= 1 and r.aov_rank >= 1


def test_roi_rank_puts_missing_spend_last(q):
    rows = q("marketing_roi").collect()
    with_roas = [r.roi_rank for r in rows if r.revenue_per_rand_spent is not None]
    without = [r.roi_rank for r in rows if r.revenue_per_rand_spent is None]
    assert not without or min(without) > max(with_roas, default=0)
