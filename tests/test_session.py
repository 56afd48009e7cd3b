"""Interim tables in the shared folder."""

from __future__ import annotations

from pathlib import Path

import pytest

from changefold.session import interim, materialize, shared_dir


def tables(spark, purpose):
    return sorted(p.name for p in Path(shared_dir(spark)).glob(f"{purpose}-*"))


def test_tables_of_a_block_go_when_it_ends(spark, tmp_path):
    before = materialize(spark.range(5), "stays")
    with interim(spark):
        twice = materialize(materialize(before, "goes"), "goes")
        assert len(tables(spark, "goes")) == 2
        twice.write.parquet(str(tmp_path / "out"))
    assert tables(spark, "goes") == []
    assert spark.read.parquet(str(tmp_path / "out")).count() == before.count() == 5


def test_an_inner_block_leaves_the_tables_of_the_outer_one(spark):
    with interim(spark):
        outer = materialize(spark.range(3), "outer")
        with interim(spark):
            assert materialize(outer, "inner").count() == 3
        assert tables(spark, "inner") == [] and outer.count() == 3
    assert tables(spark, "outer") == []


def test_tables_of_a_failed_block_go_too(spark):
    failing = spark.range(3).selectExpr("raise_error('no') AS x")
    with pytest.raises(ZeroDivisionError), interim(spark):
        materialize(spark.range(3), "failed")
        raise ZeroDivisionError
    with pytest.raises(Exception, match="no"), interim(spark):
        materialize(failing, "failed")
    assert tables(spark, "failed") == []
