"""Tables that cut a lineage, in the folder that all executors share."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame


@functools.cache
def _own_folder() -> str:
    """Where no shared folder is set and all runs in one process, as in tests: one below the working folder, gone at the end."""
    folder = Path(".checkpoints", uuid.uuid4().hex).absolute()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder.as_uri()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table below spark.checkpoint.dir, read again; what it was made of isn't computed again."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own_folder()
    path = f"{root.rstrip('/')}/quirewise-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
