"""Flags and seeds before models, and workers that have to agree with the driver."""

import json
import os
import sys
import types

import pytest

from strandline import cli
from strandline.operators import environment


def test_flags_are_kept_and_switches_thrown(monkeypatch):
    thrown = []
    runtime = types.ModuleType("tensorflow")
    runtime.config = types.SimpleNamespace(experimental=types.SimpleNamespace(enable_tensor_float_32_execution=thrown.append, tensor_float_32_execution_enabled=lambda: bool(thrown and thrown[-1])))
    runtime.random = types.SimpleNamespace(set_seed=lambda s: thrown.append(("seed", s)) or thrown.pop())
    monkeypatch.setitem(sys.modules, "tensorflow", runtime)
    monkeypatch.setenv("TF_USE_CUDNN_AUTOTUNE", "7")
    monkeypatch.delenv("TF_DETERMINISTIC_OPS", raising=False)
    told = environment.facts(("numpy", "no-such-package"))
    assert thrown == [False] and told["tensor float 32"] == "False"
    assert (told["flag TF_USE_CUDNN_AUTOTUNE"], told["flag TF_DETERMINISTIC_OPS"], told["package no-such-package"]) == ("7", "1", "none")
    assert environment.facts()["random draw"] == told["random draw"]
    runtime.config = None  # a runtime without the switch
    assert environment.facts()["tensor float 32"] == "unknown"


def test_all_workers_agree(spark):
    found = environment.agree(spark)
    assert found["processes"] >= 1 and found["facts"]["engine"] and found["hosts"] == 1


def test_a_worker_that_differs_is_refused(spark):
    driver = os.getpid()
    with pytest.raises(RuntimeError, match="package x is 2, 1 on the driver"):
        environment.agree(spark, lambda: {"package x": "1" if os.getpid() == driver else "2", "same": "s"})
    assert environment.differences({"a": "1"}, {("h", 3): {"a": "1"}, ("h", 4): {"b": "2"}}) == ["h/4: a is not told, 1 on the driver", "h/4: b is 2, not told on the driver"]


def test_runtime_command(spark, tmp_path, capsys):
    (tmp_path / "m1").write_bytes(b"one")
    (tmp_path / "m2").write_bytes(b"two")
    assert cli.main(["runtime", "--output", str(tmp_path / "r.json"), "--resources", str(tmp_path / "m*"), "--workers"], spark) == 0
    told = json.loads((tmp_path / "r.json").read_text())
    assert [r["bytes"] for r in told["resources"]] == [3, 3] and len({r["sha256"] for r in told["resources"]}) == 2
    assert told["processes"] >= 1 and told["facts"]["package numpy"]
    assert cli.main(["runtime"], spark) == 0 and json.loads(capsys.readouterr().out)["resources"] == []
