"""A log of numbered commits (I3): `00000000000000000001.json`, ..., each put only if its number is still free.

A commit is one small JSON file, whole or not there at all: it is written under another name and then linked to its own,
which the file system refuses if that name exists. So of several writers that put the same number exactly one succeeds,
and a writer that dies leaves a hidden file that no reader takes for a commit. Local and mounted folders are built in; for
an object store pass `put_if_absent`, which has to be the store's conditional put (S3 `If-None-Match`, GCS
`ifGenerationMatch`): a check before a plain write would let two writers win.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from scorebook import schemas


def link_if_absent(path: str, content: bytes) -> bool:
    """Puts a whole file on a local or mounted folder unless one of its name is there; tells whether it did."""
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    own = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(own, "xb") as f:
        f.write(content)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(own, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(own)


class CommitLog:
    """The commits under `root`, read by Spark and put by `put_if_absent(path, content)`."""

    def __init__(self, root: str, put_if_absent: Callable[[str, bytes], bool] | None = None):
        self.root = root.rstrip("/")
        if put_if_absent is None:
            if "://" in self.root:
                raise ValueError(f"{root}: pass the store's own conditional put as put_if_absent")
            put_if_absent, self.root = link_if_absent, self.root.removeprefix("file:")
        self._put = put_if_absent

    def entries(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """number, run, mark, drops, keys, upto of each commit (numbers up to `upto`); none if there is no log."""
        try:
            found = spark.read.schema(schemas.COMMITS).json(f"{self.root}/*.json")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return spark.createDataFrame([], schemas.COMMITS)
        return found if upto is None else found.where(found["number"] <= upto)

    def head(self, spark: SparkSession) -> dict | None:
        """The last commit; None if there is none."""
        last = self.entries(spark).orderBy("number", ascending=False).first()
        return None if last is None else last.asDict()

    def put(self, number: int, **entry) -> bool:
        """Commits `entry` under `number`; False if another writer was first."""
        body = json.dumps({"number": number, **entry}).encode()
        return self._put(f"{self.root}/{number:020d}.json", body)
