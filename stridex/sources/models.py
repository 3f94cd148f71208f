"""Model files (IO5-IO8). Paths are arguments: the reference saved under one path and loaded from another.

A saved model is a numbered version under its path, published atomically (``commits``): a save that dies half-way leaves the
version before it as the one that is loaded, and a reader never meets a half-written or half-deleted model. ``KEEP`` versions
stay, so a process that is loading an older one can finish. A path without versions is loaded as a plain Spark ML model."""
from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.sql import SparkSession

from .commits import CommitLog, Entry

KEEP = 3


def _versions(log: CommitLog) -> list[str]:
    return [k for k in log.keys() if k.startswith("version=")]


def publish_model(model, path: str) -> int:
    """Save a model as the next version under ``path``; its number. Of two writers that race each gets a version."""
    log = CommitLog(SparkSession.active(), path)
    while True:
        have = _versions(log)
        n = int(have[-1].split("=")[1]) + 1 if have else 1
        mine: list[str] = []

        def write(folder: str) -> None:
            mine.append(folder)
            model.write().save(folder)
        if log.publish(f"version={n:09d}", write).folder in mine:
            break
    for key in _versions(log)[:-KEEP]:
        log.retract(log.entry(key))
    return n


def save_model(model, path: str) -> str:
    publish_model(model, path)
    return path


def latest(path: str) -> Entry | None:
    """The newest published version under ``path``."""
    log = CommitLog(SparkSession.active(), path)
    have = _versions(log)
    return log.entry(have[-1]) if have else None


def _load(kind, path: str):
    newest = latest(path)
    return kind.load(newest.folder if newest else path)


def load_tree(path: str) -> DecisionTreeClassificationModel:
    return _load(DecisionTreeClassificationModel, path)


def load_forest(path: str) -> RandomForestClassificationModel:
    return _load(RandomForestClassificationModel, path)


class PublishedModel:
    """The newest version of a model under a path; a stream asks for it before each batch (``current``)."""

    def __init__(self, path: str, load=load_forest):
        self.path, self.load = path, load
        self._key, self._model = "", None

    def current(self):
        newest = latest(self.path)
        key = newest.key if newest else None
        if key != self._key:
            self._key, self._model = key, self.load(self.path)
        return self._model
