"""Atomic publication of written folders (IO4-IO6, ST2, ST4): write aside, then publish by one small file.

A publication has a key. Its data go to a folder of their own under ``<path>/data``, which no reader looks at; then one
entry ``<path>/_commits/<key>.json``, naming that folder, is moved into place by a rename that fails if the entry is there
already. So a key is published once, however often its writer is re-run or raced, a half-written folder is never seen, and
a writer that dies before the rename leaves nothing but a folder that ``vacuum`` removes. Readers list the entries; an entry
never changes, so each is read once per process.

Everything goes through Hadoop's file system API, so ``path`` can be in any store that Spark reads and writes.
"""
from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    key: str
    folder: str                       # of the data, whole path
    facts: dict = field(default_factory=dict, hash=False)


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._seen: dict[str, Entry] = {}

    # -- the file system

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list:
        p, fs = self._at(path)
        return list(fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def _read(self, path: str) -> str:
        p, fs = self._at(path)
        f = fs.open(p)
        try:
            return str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8"))
        finally:
            f.close()

    def _put_new(self, path: str, text: str) -> bool:
        """A new file with ``text``, whole or not at all; False if ``path`` exists."""
        jvm = self.spark._jvm
        aside, fs = self._at(f"{self.path}/_commits/.{uuid.uuid4().hex}.tmp")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        to, _ = self._at(path)
        never = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(to), never)
            return True
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if fs.exists(to):
                return False
            raise e

    # -- entries

    def exists(self) -> bool:
        p, fs = self._at(f"{self.path}/_commits")
        return fs.exists(p)

    def holds_files(self) -> bool:
        """Whether the path holds anything but this log's folders, such as a table written without it."""
        return any(f.getPath().getName() not in ("data", "_commits") for f in self._list(self.path))

    def keys(self) -> list[str]:
        """Keys of all publications, in order: one listing."""
        names = [f.getPath().getName() for f in self._list(f"{self.path}/_commits")]
        return sorted(n[:-5] for n in names if n.endswith(".json") and not n.startswith("."))

    def entry(self, key: str) -> Entry | None:
        if key not in self._seen:
            p, fs = self._at(f"{self.path}/_commits/{key}.json")
            if not fs.exists(p):
                return None
            d = json.loads(self._read(f"{self.path}/_commits/{key}.json"))
            self._seen[key] = Entry(key, f"{self.path}/data/{d['folder']}", d["facts"])
        return self._seen[key]

    def entries(self) -> list[Entry]:
        return [e for e in map(self.entry, self.keys()) if e is not None]

    def publish(self, key: str, write: Callable[[str], dict | None], place: str = "") -> Entry:
        """Have ``write`` fill a new folder (under ``place``) and publish it; what ``write`` returns goes along as facts. A
        key that is published already keeps its entry and nothing is written."""
        done = self.entry(key)
        if done is not None:
            return done
        folder = "/".join(x for x in (place, f"attempt={uuid.uuid4().hex[:12]}") if x)
        facts = write(f"{self.path}/data/{folder}") or {}
        if not self._put_new(f"{self.path}/_commits/{key}.json", json.dumps({"folder": folder, "facts": facts})):
            self._delete(f"{self.path}/data/{folder}")            # another attempt was first
        return self.entry(key)

    def retract(self, entry: Entry) -> None:
        """Remove a publication that another one stands in for: first the entry, then the data."""
        self._delete(f"{self.path}/_commits/{entry.key}.json")
        self._seen.pop(entry.key, None)
        self._delete(entry.folder)

    def vacuum(self, older_than: float = 24 * 3600.0) -> list[str]:
        """Remove what attempts older than ``older_than`` seconds left unpublished; the folders removed. (Choose a time that
        no running attempt exceeds.)"""
        held = {e.folder for e in self.entries()}
        before = (time.time() - older_than) * 1000
        gone, todo = [], [f"{self.path}/data"]
        while todo:
            for f in self._list(todo.pop()):
                path = str(f.getPath().toString())
                if not f.isDirectory():
                    continue
                if not f.getPath().getName().startswith("attempt="):
                    todo.append(path)
                elif not any(path.endswith(h[len(self.path):]) for h in held) and f.getModificationTime() <= before:
                    self._delete(path)
                    gone.append(path)
        return gone
