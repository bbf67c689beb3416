"""Session defaults and the release of intermediates."""

import os

from canopus.session import build_session, cut_lineage, ensure_checkpoint_dir, intermediates, write_bucketed


def test_build_session_leaves_presets_alone(spark):
    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.driver.memory"))
    again = build_session()
    assert (again.sparkContext.master, again.conf.get("spark.sql.shuffle.partitions"), again.conf.get("spark.driver.memory")) == before


def test_intermediates_are_deleted(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    tables = {t.name for t in spark.catalog.listTables()}
    with intermediates(spark):
        a = cut_lineage(spark.range(10))
        b = write_bucketed(spark.range(10), "id", 2)
        assert a.count() + b.count() == 20
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before
    assert {t.name for t in spark.catalog.listTables()} == tables
