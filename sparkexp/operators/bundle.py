"""Saving and loading of models that are more than one ``pyspark.ml`` model.

A ``Bundle`` names its parts: plain values, models (``pyspark.ml`` ones or bundles
again) and tables. ``write()`` and ``read()`` work as for any ``pyspark.ml`` model:
plain values go into one JSON line, models into folders of their own and tables into
Parquet, all through Spark's file systems. A reader only makes classes of
``pyspark.ml`` and of this library.
"""

from __future__ import annotations

import importlib
import json
from typing import Any

import numpy as np
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

#: Packages whose classes a stored name may mean.
TRUSTED = ("pyspark.ml.", "sparkexp.")


def _plain(v: Any) -> Any:
    if isinstance(v, np.ndarray):
        return {"array": v.tolist(), "shape": list(v.shape)}
    if isinstance(v, dict) and any(not isinstance(k, str) for k in v):
        return {"items": [[k, _plain(x)] for k, x in v.items()]}
    if isinstance(v, dict):
        return {"dict": {k: _plain(x) for k, x in v.items()}}
    if isinstance(v, (list, tuple)):
        return {"tuple" if isinstance(v, tuple) else "list": [_plain(x) for x in v]}
    if isinstance(v, np.generic):
        return v.item()
    if v is None or isinstance(v, (bool, int, float, str)):
        return v
    raise TypeError(f"cannot store a {type(v).__name__}")


def _back(v: Any) -> Any:
    if not isinstance(v, dict):
        return v
    (kind, x), *more = v.items()
    if kind == "array":
        return np.array(x, float).reshape(dict(more)["shape"])
    if kind == "items":
        return {k: _back(y) for k, y in x}
    if kind == "dict":
        return {k: _back(y) for k, y in x.items()}
    made = [_back(y) for y in x]
    return tuple(made) if kind == "tuple" else made


class BundleWriter(MLWriter):
    def __init__(self, bundle: Bundle):
        super().__init__()
        self.bundle = bundle

    def saveImpl(self, path: str) -> None:
        values: dict[str, Any] = {}
        kinds: dict[str, Any] = {}
        for name, part in self.bundle.parts().items():
            if isinstance(part, DataFrame):
                part.write.parquet(f"{path}/{name}")
                kinds[name] = "table"
            elif isinstance(part, list) and part and all(isinstance(m, MLWritable) for m in part):
                for k, m in enumerate(part):
                    m.write().save(f"{path}/{name}/{k}")
                kinds[name] = [_class_name(m) for m in part]
            elif isinstance(part, MLWritable):
                part.write().save(f"{path}/{name}")
                kinds[name] = _class_name(part)
            else:
                values[name] = _plain(part)
        line = json.dumps({"class": _class_name(self.bundle), "values": values, "kinds": kinds})
        SparkSession.active().createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{path}/bundle")


class BundleReader(MLReader):
    def __init__(self, cls: type[Bundle]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Bundle:
        model = load_any(SparkSession.active(), path)
        if not isinstance(model, self.cls):
            raise TypeError(f"{path} holds a {type(model).__name__}, not a {self.cls.__name__}")
        return model


class Bundle(MLWritable, MLReadable):
    """A model made of parts. Dataclasses need nothing more; others override
    ``parts`` and ``from_parts``."""

    def parts(self) -> dict[str, Any]:
        return dict(vars(self))

    @classmethod
    def from_parts(cls, parts: dict[str, Any]) -> Bundle:
        return cls(**parts)

    def write(self) -> BundleWriter:
        return BundleWriter(self)

    @classmethod
    def read(cls) -> BundleReader:
        return BundleReader(cls)


def _class_name(model: Any) -> str:
    return f"{type(model).__module__}.{type(model).__qualname__}"


def _class(name: str) -> type:
    if not name.startswith(TRUSTED):
        raise ValueError(f"{name} is not a model class")
    module, _, cls = name.rpartition(".")
    return getattr(importlib.import_module(module), cls)


def _load_as(spark: SparkSession, name: str, path: str) -> Any:
    cls = _class(name)
    return load_any(spark, path) if issubclass(cls, Bundle) else cls.load(path)


def is_bundle(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/bundle")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_any(spark: SparkSession, path: str) -> Bundle:
    """The bundle at ``path``, of whatever class."""
    meta = json.loads(spark.read.text(f"{path}/bundle").first()["value"])
    parts = {k: _back(v) for k, v in meta["values"].items()}
    for name, kind in meta["kinds"].items():
        if kind == "table":
            parts[name] = spark.read.parquet(f"{path}/{name}")
        elif isinstance(kind, list):
            parts[name] = [_load_as(spark, c, f"{path}/{name}/{k}") for k, c in enumerate(kind)]
        else:
            parts[name] = _load_as(spark, kind, f"{path}/{name}")
    return _class(meta["class"]).from_parts(parts)
