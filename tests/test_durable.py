"""Intermediate tables: what stays and what goes."""

import threading

from ontoloom import durable


def test_scratch_keeps_what_is_named(spark):
    with durable.scratch() as outer:
        a = durable.materialize(spark.range(3), "a")
        with durable.scratch() as kept:
            b, c = durable.materialize(spark.range(4), "b"), durable.materialize(spark.range(5), "c")
            kept.append(c)
            other = []
            t = threading.Thread(target=lambda: other.append(durable.materialize(spark.range(6), "other")))
            t.start()
            t.join()
        assert b._ontoloom_path not in durable._written
        assert (a.count(), c.count(), other[0].count()) == (3, 5, 6)
        outer.append(a)
    assert c._ontoloom_path not in durable._written and other[0].count() == 6 and a.count() == 3
    durable.discard(a, *other)
    assert not {a._ontoloom_path, other[0]._ontoloom_path} & set(durable._written)
    durable.discard(a)
