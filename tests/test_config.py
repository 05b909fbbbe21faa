"""Scratch storage comes from the session's shared checkpoint folder."""

from __future__ import annotations

import pytest

from strata.config import LayerConfig, fresh_dir, shared_dir


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured
    root = configured.rstrip("/")
    assert shared_dir(spark) == root
    assert shared_dir(spark, "a", "b") == f"{root}/a/b"
    one, two = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert one != two and one.startswith(f"{root}/strata/x-")


def test_layer_config_paths(spark):
    cfg = LayerConfig(root="hdfs:///lake/traffic", environment="uat")
    assert cfg.bronze("raw_roads") == "hdfs:///lake/traffic/medallion/bronze/raw_roads"
    assert cfg.quarantine() == "hdfs:///lake/traffic/quality/data_quality_quarantine"
    assert cfg.checkpoint("bronze_raw_roads") == "hdfs:///lake/traffic/checkpoints/bronze_raw_roads"
    assert cfg.table("silver_roads") == "traffic_db.silver_roads"
    with pytest.raises(ValueError):
        LayerConfig(root="/x", environment="test")
    scratch = LayerConfig.scratch(spark, "odd-label.1")
    assert scratch.database.replace("_", "").isalnum()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_submitted_settings_win(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "from strata.session import get_session\n"
        "s = get_session()\n"
        "print('SEEN', s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.enabled'),"
        " s.conf.get('spark.sql.adaptive.skewJoin.enabled'), s.sparkContext.master)\n"
    )
    args = "--master local[1] --conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.sql.adaptive.enabled=false pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert "SEEN Asia/Tokyo false true local[1]" in out.stdout, out.stderr[-500:]
