"""The shared folder of a session."""

from types import SimpleNamespace

import pytest

from claimsift.session import TASK_CONF, bound_tasks, shared_folder


def test_shared_folder():
    def folder(**conf):
        return shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.split(".")[1], d))), "x")

    assert folder(checkpoint="hdfs:///c/", master="yarn").startswith("hdfs:///c/claimsift/x-")
    assert folder(master="local[8]") != folder(master="local[8]")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        folder(master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        folder()


def test_tasks_are_bounded_unless_the_caller_has_set_sizes(spark, conf):
    sizes = "spark.sql.files.maxPartitionBytes"
    conf(**{key.replace(".", "__"): "1000" for key in TASK_CONF})
    bound_tasks(spark)
    assert {spark.conf.get(key) for key in TASK_CONF} == {"1000"}
    spark.conf.unset(sizes)
    bound_tasks(spark)
    assert spark.conf.get(sizes) == TASK_CONF[sizes]
