"""Staged tables live as long as their scope."""

import os
import tempfile

import pytest

from fleetscope import fixtures as fx
from fleetscope.config import checkpoint_dir
from fleetscope.plans import job
from fleetscope.plans.stage import stage, staging
from tests.conftest import SF001


def folder(path):
    return path.removeprefix("file://")


def staged_now(spark):
    return {n for n in os.listdir(folder(checkpoint_dir(spark))) if n.startswith("stage-")}


def test_scopes_remove_their_own_tables(spark):
    with staging(spark) as outer:
        a = stage(spark.range(5), "a")
        with staging(spark) as inner:
            stage(spark.range(3), "b")
            assert len(inner) == 1 and os.path.exists(folder(inner[0]))
        assert not os.path.exists(folder(inner[0]))
        assert a.count() == 5
    assert len(outer) == 1 and not os.path.exists(folder(outer[0]))
    with pytest.raises(RuntimeError), staging(spark) as failed:
        stage(spark.range(2), "c")
        raise RuntimeError
    assert not os.path.exists(folder(failed[0]))
    assert stage(spark.range(4), "d").count() == 4            # outside a scope the table stays


def test_the_job_leaves_its_outputs_only(spark):
    before = staged_now(spark)
    out = tempfile.mkdtemp(prefix="fs-job-")
    paths = job.run(fx.calls(spark, SF001), fx.app_config_raw(spark, SF001), out)
    assert staged_now(spark) == before
    assert spark.read.parquet(paths["events"]).count() > 0
