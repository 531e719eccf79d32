"""Session defaults: sizes that bound a task's input."""

import pytest

from registrar.session import SESSION_SIZES, _bytes, apply_defaults


def test_sizes_of_a_session_are_lowered_and_smaller_ones_kept(spark):
    before = {k: spark.conf.get(k) for k in SESSION_SIZES}
    try:
        for k in SESSION_SIZES:
            spark.conf.set(k, "512MB")
        apply_defaults(spark)
        assert {k: _bytes(spark.conf.get(k)) for k in SESSION_SIZES} == SESSION_SIZES
        for k in SESSION_SIZES:
            spark.conf.set(k, "1m")
        apply_defaults(spark)
        assert all(spark.conf.get(k) == "1m" for k in SESSION_SIZES)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("text, n", [("64MB", 64 << 20), ("16m", 16 << 20), ("1024", 1024), ("8b", 8), ("2GiB", 2 << 30), ("256k", 256 << 10)])
def test_size_texts(text, n):
    assert _bytes(text) == n
