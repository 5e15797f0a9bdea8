"""What one task is given is bounded, and others get the session's own settings back."""

from stackroom import session


def test_tasks_are_bounded_and_let_go(spark, sf_dir):
    from stackroom.queries import QUERIES

    session.unbound_tasks(spark)
    keys = [*session.TASK_CONF, session._INITIAL]

    def values():
        return [*[spark.conf.get(k) for k in session.TASK_CONF], spark.conf.get(session._INITIAL, None)]

    before = values()
    own = {**session.TASK_CONF, session._INITIAL: session.INITIAL_PARTITIONS}
    try:
        QUERIES["tag_counts"](spark, sf_dir)
        QUERIES["tag_counts"](spark, sf_dir)
        assert [int(v) for v in values()] == list(own.values())
        session.unbound_tasks(spark)
        assert values() == before
        # Smaller shares stay.
        spark.conf.set(keys[0], "1m")
        session.bound_tasks(spark)
        assert spark.conf.get(keys[0]) == "1m"
    finally:
        session.unbound_tasks(spark)
        spark.conf.set(keys[0], before[0])


def test_sizes_as_spark_takes_them():
    assert [session._bytes(t) for t in ("134217728b", "16m", "2 GB", "7", "64K")] == [1 << 27, 1 << 24, 1 << 31, 7, 1 << 16]
