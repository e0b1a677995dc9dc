import pytest

from conftest import same_rows
from quaywatch import oracles, queries

EMPTY = set()


def test_each_query_has_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert same_rows(queries.queries()[name](spark, sf_dir), duck, oracles.oracle_sql()[name]) > 0


def test_alerts_of_the_burst(spark, sf_dir):
    rows = {(r.cdn, r.state, r.tier) for r in queries.cdn_alert_transitions(spark, sf_dir).collect()}
    assert rows == {("cdn-b", "FIRING", "page"), ("cdn-b", "RESOLVED", "ticket")}


def test_one_shuffle_by_session_for_the_mart(spark, sf_dir):
    plan = queries.session_window_qoe(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(session_id") == 1
    assert plan.count("hashpartitioning(event_id") == 1
    assert "Python" not in plan
