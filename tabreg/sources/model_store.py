"""Fitted-model folders: save, load, load-or-train.

Models are written under a path the caller gives (by default inside the
shared checkpoint folder), never to a machine-local folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel

from ..session import active_session
from . import fs


def model_path(root: str, model: str, label: str, time_mode: str) -> str:
    """``<root>/<model>-<label>-<mode>``: one folder per combination."""
    return f"{root.rstrip('/')}/{model}-{label}-{time_mode}"


def save_model(model, path: str, overwrite: bool = True) -> str:
    writer = model.write()
    if overwrite:
        writer = writer.overwrite()
    writer.save(path)
    return path


def load_model(model_cls, path: str):
    return model_cls.load(path)


def load_or_train(path: str, model_cls, train: Callable[[], object]):
    """Load the model at ``path``; if nothing is there, train, save, return it.

    Returns ``(model, loaded)``. Only an absent folder triggers training. A
    folder that can't be loaded (damaged, of another class) raises and is left
    as it is. A model is saved beside ``path`` and renamed when complete.
    """
    spark, path = active_session(), path.rstrip("/")
    if fs.exists(spark, path):
        return load_model(model_cls, path), True
    model = train()
    fs.publish(spark, save_model(model, f"{path}.saving-{uuid.uuid4().hex[:12]}"), path)
    return model, False


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
