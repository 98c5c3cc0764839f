"""A submitted job keeps the settings of its submit."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
from tijara.session import job_session
s = job_session()
print("GOT", s.conf.get("spark.sql.shuffle.partitions"), s.conf.get("spark.driver.memory"),
      s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"), s.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin"))
s.stop()
"""


def test_submit_settings_survive():
    env = os.environ | {"PYTHONPATH": f"{ROOT}:{os.environ.get('PYTHONPATH', '')}", "PYSPARK_SUBMIT_ARGS": (
        "--master local[2] --driver-memory 700m --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2000 "
        "--conf spark.sql.adaptive.advisoryPartitionSizeInBytes=64m pyspark-shell")}
    out = subprocess.run([sys.executable, "-c", JOB], env=env, capture_output=True, text=True, timeout=240)
    got = next((x.split()[1:] for x in out.stdout.splitlines() if x.startswith("GOT")), out.stderr[-2000:])
    assert got == ["2000", "700m", "64m", "true"]


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from tijara import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
