"""What models need to predict alike wherever they run, and whether all workers have it.

``prepare`` is called once in every task before models are loaded. ``agree`` puts
the same questions to the driver and to a task on every executor and refuses a
cluster whose answers differ.
"""

from __future__ import annotations

import importlib
import importlib.util
import json
import os
import platform
import random
import socket
import sys
import time
from collections.abc import Callable, Iterator
from importlib.metadata import PackageNotFoundError, version

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from strandline import __version__
from strandline.sources import files

#: Flags of the usual model runtime for repeatable results, each kept if it is set already.
FLAGS = {"TF_DETERMINISTIC_OPS": "1", "TF_CUDNN_DETERMINISTIC": "1", "TF_USE_CUDNN_AUTOTUNE": "0"}
SEED = 1
RUNTIME = "tensorflow"
PACKAGES = ("numpy", "pandas", "pyarrow", "pyspark", RUNTIME)


def _runtime() -> object | None:
    return importlib.import_module(RUNTIME) if RUNTIME in sys.modules or importlib.util.find_spec(RUNTIME) else None


def _experimental(runtime: object, name: str) -> Callable | None:
    found = getattr(getattr(getattr(runtime, "config", None), "experimental", None), name, None)
    return found if callable(found) else None


def prepare(seed: int = SEED) -> None:
    """Flags before the runtime is imported, single precision as it stands, and seeds."""
    for name, value in FLAGS.items():
        os.environ.setdefault(name, value)
    random.seed(seed)
    np.random.seed(seed)
    runtime = _runtime()
    if runtime is not None:
        if (switch := _experimental(runtime, "enable_tensor_float_32_execution")) is not None:
            switch(False)
        if (seeds := getattr(getattr(runtime, "random", None), "set_seed", None)) is not None:
            seeds(seed)


def version_of(package: str) -> str:
    try:
        return version(package)
    except PackageNotFoundError:
        return "none"


def facts(packages: tuple[str, ...] = PACKAGES) -> dict[str, str]:
    """Versions, flags and switches of this process after ``prepare``; what has to be the same everywhere."""
    prepare()
    runtime = _runtime()
    switch = None if runtime is None else _experimental(runtime, "tensor_float_32_execution_enabled")
    told = {"python": platform.python_version(), "machine": platform.machine(), "engine": __version__, "byte order": sys.byteorder}
    told |= {f"package {p}": version_of(p) for p in packages} | {f"flag {k}": os.environ[k] for k in FLAGS}
    return told | {"tensor float 32": "unknown" if switch is None else str(bool(switch())), "random draw": repr(float(np.random.random()))}


def workers(spark: SparkSession, ask: Callable[[], dict[str, str]] = facts, pause: float = 0.2) -> DataFrame:
    """host, process, name, value: what tasks on all slots answer. A task waits a little, so that no slot gets two of a round."""
    files.ship(spark)

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                time.sleep(pause)
                told = ask()
                yield pd.DataFrame({"host": socket.gethostname(), "process": os.getppid(), "name": list(told), "value": [str(v) for v in told.values()]})

    slots = spark.sparkContext.defaultParallelism
    return spark.range(0, 2 * slots, 1, numPartitions=2 * slots).mapInPandas(answer, "host string, process long, name string, value string").distinct()


def executors(spark: SparkSession) -> int:
    """Executors that are there now, the driver's own threads being one where there are no others."""
    told = len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos())
    return max(1, told - 1)


def agree(spark: SparkSession, ask: Callable[[], dict[str, str]] = facts, rounds: int = 5) -> dict[str, object]:
    """The driver's facts and the number of worker hosts and processes that share them; an error that names each fact in which one differs.

    Executors that no task of a round reached are asked again; those that none of
    ``rounds`` reaches are an error too.
    """
    own = {k: str(v) for k, v in ask().items()}
    seen: dict[tuple[str, int], dict[str, str]] = {}
    for _ in range(rounds):
        for r in workers(spark, ask).collect():  # a few dozen rows a process
            seen.setdefault((r["host"], r["process"]), {})[r["name"]] = r["value"]
        if len(seen) >= executors(spark):
            break
    else:
        raise RuntimeError(f"only {len(seen)} of {executors(spark)} executors answered")
    wrong = differences(own, seen)
    if wrong:
        raise RuntimeError("workers differ from the driver: " + "; ".join(wrong))
    return {"facts": own, "processes": len(seen), "hosts": len({h for h, _ in seen})}


def differences(own: dict[str, str], seen: dict[tuple[str, int], dict[str, str]]) -> list[str]:
    """One line for every fact of a worker that isn't the driver's."""
    out = []
    for (host, process), told in sorted(seen.items()):
        out += [f"{host}/{process}: {name} is {told.get(name, 'not told')}, {own.get(name, 'not told')} on the driver" for name in sorted({*own, *told}) if own.get(name) != told.get(name)]
    return out


def manifest(spark: SparkSession, resources: list[dict[str, object]], with_workers: bool = False) -> dict[str, object]:
    """Environment and resource digests as one record; with ``with_workers``, only if all of them agree."""
    told: dict[str, object] = {"spark": spark.version, "platform": platform.platform(), "engine": __version__, "git_commit": os.environ.get("STRANDLINE_GIT_COMMIT", "unknown"), "devices": os.environ.get("CUDA_VISIBLE_DEVICES"), "resources": resources}
    told |= {"facts": facts()} if not with_workers else agree(spark)
    return json.loads(json.dumps(told))
