import os

import pytest

from pepweave.operators import shared
from pepweave.operators.traverse import traverse
from pepweave.plans import catalog


def below(spark):
    top = shared.shared_dir(spark).removeprefix("file://") + "/pepweave"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_a_scope_removes_what_was_written_in_it(spark, tmp_path):
    kept = shared.cut(spark.range(3), "kept")
    before = below(spark)
    with shared.temporary(spark):
        with shared.temporary(spark):
            found = traverse(catalog.toy(spark), spark.createDataFrame([(0, 10, 30, 1)], "query_id long, lower long, upper long, max_vars int")).paths
            found.write.parquet(str(tmp_path / "out"))
            assert below(spark) > before
        assert below(spark) == before
    assert kept.count() == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_a_failure_clears_up_too(spark):
    before = below(spark)
    with pytest.raises(ZeroDivisionError), shared.temporary(spark):
        shared.cut(spark.range(3), "gone")
        1 / 0
    assert below(spark) == before and shared._scopes == []
