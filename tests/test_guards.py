"""Repository-level guards: driver actions in the library and scratch locations."""

import os
import re

from reelframe import registry
from reelframe.session import checkpoint_root

LIBRARY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "reelframe")
ACTION = re.compile(r"\.(collect|toPandas|first|take|count|head|show)\(\)")

def test_library_runs_no_driver_action_while_building_plans():
    found = set()
    for folder, _, files in os.walk(LIBRARY):
        if os.path.relpath(folder, LIBRARY).split(os.sep)[0] == "llm":
            continue  # the training-data operators have tests of their own
        for name in files:
            if not name.endswith(".py"):
                continue
            path = os.path.join(folder, name)
            rel = os.path.relpath(path, LIBRARY)
            with open(path, encoding="utf-8") as fh:
                for line in fh:
                    code = line.split("#", 1)[0]
                    for m in ACTION.finditer(code):
                        start = code.rfind(" ", 0, m.start()) + 1
                        found.add((rel, code[start:m.end()].strip()))
    assert not found, found


def test_scratch_output_goes_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert registry.scratch(spark, "x").startswith(root.rstrip("/") + "/x-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError):
        checkpoint_root(SimpleNamespace(sparkContext=sc))
