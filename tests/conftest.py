from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tijara.session import local_session

    s = local_session("local[4]", shuffle_partitions=8)
    # a cluster names a shared checkpoint folder; only where none is named do tests set one
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_tables(spark):
    from tijara.registry import tables_for

    return tables_for(spark, SMALL)


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), sorted for comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
