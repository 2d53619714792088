"""

Each file is written under a name of its own and then moved to its place, so a reader never sees half a file, and a task
that is run again after a lost executor writes the same file once more. `folder` is a path or URI that all executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..operators import corrections


def publish(files: DataFrame, folder: str) -> None:
    """Writes files(name, bytes) below folder; rows are written where they are, none goes to the driver."""

    def write(rows: Iterator[Row]) -> None:
        system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        for row in rows:
            place = f"{root.rstrip('/')}/{row.name}"
            system.create_dir(place.rpartition("/")[0], recursive=True)
            early = f"{place}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(early) as out:
                out.write(bytes(row.bytes))
            system.move(early, place)

    files.select("name", "bytes").foreachPartition(write)


def _named(df: DataFrame, ending: str, content: Column) -> DataFrame:
    return df.select(F.concat(F.col("book_id").cast("string"), F.lit(ending)).alias("name"), content.alias("bytes"))


def write_packages(packages: DataFrame, folder: str) -> None:
    """packages(book_id, epub) as book_id.epub."""
    publish(_named(packages, ".epub", F.col("epub")), folder)


def write_texts(texts: DataFrame, folder: str) -> None:
    """texts(book_id, text) as book_id.txt."""
    publish(_named(texts, ".txt", F.encode("text", "UTF-8")), folder)


def write_fixes(fixes: DataFrame, folder: str) -> None:
    """fixes(book_id, ord, page, before, after, why) as book_id.json, an array in order, as read_fixes reads it."""
    fix = F.struct("ord", F.struct("page", "before", "after", "why").alias("fix"))
    books = fixes.groupBy("book_id").agg(F.transform(F.array_sort(F.collect_list(fix)), lambda f: f["fix"]).alias("fixes"))
    publish(_named(books, ".json", F.encode(F.to_json("fixes", {"ignoreNullFields": "false"}), "UTF-8")), folder)


def write_log(log: DataFrame, folder: str) -> None:
    """log(book_id, line_no, before, after, ok, why, reason) as book_id.md: what was applied, then what was not."""
    rows = corrections.log_rows(log)
    part = lambda ok: F.transform(F.array_sort(F.collect_list(F.when(F.col("ok") == ok, F.struct("line_no", "log_row")))), lambda r: r["log_row"])
    head = lambda name, rows, last: F.concat(F.array(F.concat(F.lit(f"## {name} ("), F.size(rows), F.lit(")")), F.lit(""), F.lit(f"| line | before | after | {last} |"), F.lit("|---|---|---|---|")), rows, F.array(F.lit("")))
    books = rows.groupBy("book_id").agg(part(True).alias("yes"), part(False).alias("no"))
    text = F.array_join(F.concat(head("applied", F.col("yes"), "why"), head("rejected", F.col("no"), "reason")), "\n")
    publish(_named(books, ".md", F.encode(text, "UTF-8")), folder)
