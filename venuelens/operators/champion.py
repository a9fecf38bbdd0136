"""Keep the best model and its metrics (MD-17, SNK-4)."""

from __future__ import annotations

import json
import math
import time
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


#: Seconds to wait for a version file that is not whole.
PATIENCE = 30


def champion_metrics(spark: SparkSession, path: str) -> dict | None:
    """The metrics of the current version, or None when there is none.

    Every champion is a file ``versions/<number>.json`` with its metrics and the path of its model. The one with the largest number
    that is whole is current: a file that its writer has not finished is passed over.
    """
    return _current(spark, path, _names(spark, f"{path}/versions"))


def _current(spark: SparkSession, path: str, names: list[str]) -> dict | None:
    for name in sorted(names, reverse=True):
        found = _read(spark, f"{path}/versions/{name}")
        if found is not None:
            return found
    return None


def load_champion(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(champion_metrics(spark, path)["model_path"])


def _usable(error: float | None) -> bool:
    return error is not None and not math.isnan(error)


def save_if_better(model: PipelineModel, metrics: DataFrame, path: str) -> bool:
    """Replace the stored model when the new RMSE is strictly lower or nothing usable is stored.

    ``metrics`` has one row with at least ``model_name`` and ``rmse``; a missing or NaN error never wins. The model is written first, to a place of its own. The
    version file that points to it is then created, which fails where there is one of that number: no rename is
    needed, so this holds on object stores whose create without overwriting is atomic. Of two runs at once one loses that race; it looks again at what is
    stored, and takes the next number only if it is still better. A run that breaks anywhere leaves a whole champion.
    """
    spark = metrics.sparkSession
    new = metrics.first().asDict()
    model_path, waited = None, 0
    while True:
        # One look at the folder: what is compared with, and the number to take, belong together.
        names = _names(spark, f"{path}/versions")
        old, last = _current(spark, path, names), max(map(_number, names), default=0)
        if last > (old["version"] if old else 0) and waited < PATIENCE:
            time.sleep(1)  # another run is just writing; after a while it is taken for dead
            waited += 1
            continue
        if not _usable(new["rmse"]) or (old and _usable(old.get("rmse")) and new["rmse"] >= old["rmse"]):
            if model_path:
                _delete(spark, model_path)
            return False
        if model_path is None:
            model_path = f"{path}/models/{uuid.uuid4().hex}"
            model.write().save(model_path)
        version = last + 1
        row = new | {"version": version, "model_path": model_path, "trained_at": datetime.now(timezone.utc).isoformat()}
        if _create(spark, f"{path}/versions/{version:010d}.json", json.dumps(row, default=str)):
            break
    if old:
        _delete(spark, f"{path}/versions/{old['version']:010d}.json")
        _delete(spark, old["model_path"])
    return True


def remove_orphans(spark: SparkSession, path: str, seconds: float = 86_400) -> int:
    """Delete models that no version points to and that were written over ``seconds`` ago, so that no run still works on them; how many."""
    used = {(_read(spark, f"{path}/versions/{n}") or {}).get("model_path") for n in _names(spark, f"{path}/versions")}
    gone = 0
    for name in _names(spark, f"{path}/models"):
        target, fs = _files(spark, f"{path}/models/{name}")
        if f"{path}/models/{name}" not in used and fs.getFileStatus(target).getModificationTime() / 1000 <= time.time() - seconds:
            gone += bool(fs.delete(target, True))
    return gone


def _number(name: str) -> int:
    return int(name.removesuffix(".json"))


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """What stands in a folder; nothing if there is none. Any other failure is the caller's."""
    target, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _read(spark: SparkSession, path: str) -> dict | None:
    target, fs = _files(spark, path)
    try:
        stream = fs.open(target)
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):  # a later champion has replaced it just now
            return None
        raise
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist; False where it does."""
    target, fs = _files(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            return False
        raise
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True


def _delete(spark: SparkSession, path: str) -> None:
    target, fs = _files(spark, path)
    fs.delete(target, True)
