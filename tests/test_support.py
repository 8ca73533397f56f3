"""Blocks of intermediate tables."""

from chromaloom.operators.support import WRITTEN, cut, own_tables


def test_own_tables_deletes_its_own(spark):
    before = cut(spark.range(3))
    with own_tables(spark) as keep:
        inner = cut(spark.range(5))
        with own_tables(spark) as keep_inner:
            lost, kept = cut(spark.range(2)), keep_inner(spark.range(4))
        result = keep(inner.join(kept, "id").join(before, "id"))
    assert result.count() == 3 and before.count() == 3
    for gone in (inner, lost, kept):
        try:
            assert gone.count() is None
        except Exception as e:  # noqa: BLE001
            assert "exist" in str(e).lower() or "not found" in str(e).lower()
    with own_tables(spark) as keep:
        try:
            with own_tables(spark):
                cut(spark.range(1))
                raise ValueError
        except ValueError:
            pass
        keep(spark.range(1))
    assert len(WRITTEN) >= 3
