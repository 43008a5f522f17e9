"""Late rows over more batches than a query keeps reports of."""

from collections import deque

import pytest

from tracelens.streaming import sinks


class Query:
    def __init__(self, run, keep):
        self.runId, self.reports = run, deque(maxlen=keep)

    @property
    def recentProgress(self):
        return list(self.reports)

    def batch(self, i, late, idle=False):
        self.reports.append({"batchId": i, "durationMs": {} if idle else {"addBatch": 1},
                             "stateOperators": [{"numRowsDroppedByWatermark": 0 if idle else late}]})


def test_count_is_carried_over_lost_reports(monkeypatch):
    monkeypatch.setattr(sinks, "_retained", lambda: 2)
    q = Query("carried", 2)
    for i in range(10):
        q.batch(i, 3)
        assert sinks.late_rows(q) == 3 * (i + 1) == sinks.late_rows(q)
        q.batch(i + 1, 0, idle=True)
        assert sinks.late_rows(q) == 3 * (i + 1)


def test_lost_reports_fail(monkeypatch):
    monkeypatch.setattr(sinks, "_retained", lambda: 2)
    q = Query("lost", 2)
    for i in range(5):
        q.batch(i, 3)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.late_rows(q)


def test_reports_lost_between_calls_fail(monkeypatch):
    monkeypatch.setattr(sinks, "_retained", lambda: 2)
    q = Query("between", 2)
    q.batch(0, 1)
    assert sinks.late_rows(q) == 1
    for i in range(1, 6):
        q.batch(i, 1)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.late_rows(q)


def test_restarted_run_begins_at_a_later_batch(monkeypatch):
    monkeypatch.setattr(sinks, "_retained", lambda: 100)
    q = Query("restarted", 100)
    q.batch(40, 2)
    assert sinks.late_rows(q) == 2
