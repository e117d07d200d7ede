"""Windows over large tables stand on an exchange of their own number of parts."""

from __future__ import annotations

from tallywind.operators import cross
from tallywind.storage import store


def test_parts_grow_with_the_rows(spark, monkeypatch):
    rows = [(i, None if i % 13 == 0 else i % 50, i % 7, i % 3) for i in range(600)]
    log = store(spark.createDataFrame(rows, "instance_id bigint, user_id bigint, item_id bigint, level int")).df
    block = [cross.Cross("user_id", ("item_id", "level"), "user")]
    want = sorted(map(tuple, cross.cross_counts(log, block).collect()))
    monkeypatch.setattr(cross, "TASK_BYTES", 8 * 1024)
    dealt = cross.cross_counts(log, block)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == want
    monkeypatch.setattr(cross, "KEY_BYTES", 1)  # every user of more than one row is aggregated and joined
    assert sorted(map(tuple, cross.cross_counts(log, block).collect())) == want
