"""ZIP archives, unpacked to text files Spark can split."""

from __future__ import annotations

import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_LINES_PER_BATCH = 20_000
_LINE_SCHEMA = "archive string, member string, line_no bigint, value string"


def read_archive_lines(spark: SparkSession, path: str | Sequence[str],
                       members: Sequence[str] = ("*",)) -> DataFrame:
    """(archive, member, line_no, value): the text lines of the matching archive members.

    One archive is one task; members are decompressed as a stream, a batch of lines at a
    time.  An archive is one binary cell, so those beyond 2 GB must be unpacked upstream.
    """
    patterns, size = tuple(members), _LINES_PER_BATCH

    # Complete in itself: workers need not have this package.
    def line_batches(path: str, name: str, text: io.TextIOWrapper) -> Iterator[pd.DataFrame]:
        start, held = 0, []
        for line in text:
            held.append(line.removesuffix("\n"))
            if len(held) == size:
                yield pd.DataFrame({"archive": path, "member": name, "line_no": range(start, start + size), "value": held})
                start, held = start + size, []
        if held:
            yield pd.DataFrame({"archive": path, "member": name, "line_no": range(start, start + len(held)), "value": held})

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        if name.endswith("/") or not any(fnmatch.fnmatch(name, p) for p in patterns):
                            continue
                        with archive.open(name) as raw:
                            text = io.TextIOWrapper(raw, encoding="utf-8", newline="\n")
                            yield from line_batches(path, name, text)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(lines, _LINE_SCHEMA)


def stage_members(spark: SparkSession, path: str | Sequence[str], folder: str,
                  members: Sequence[str]) -> set[str]:
    """Write the matching members below ``folder``, a new one; returns the names found.

    A member becomes one text file, its lines in order, in ``member=<name>/archive=<path>``.
    """
    rows = read_archive_lines(spark, path, members)
    (
        rows.sortWithinPartitions("member", "archive", "line_no")
        .select("member", "archive", "value")
        .write.partitionBy("member", "archive").text(folder)
    )
    staged = spark.read.text(folder)
    if "member" not in staged.columns:
        return set()
    return _parts(staged, "member")


def _parts(staged: DataFrame, name: str) -> set[str]:
    # Once for the folder's own escapes, once for those of the file's address.
    return {unquote(unquote(m)) for f in staged.inputFiles() for m in re.findall(f"/{name}=([^/]+)/", f)}


def staged_archives(spark: SparkSession, folder: str) -> set[str]:
    """The archives whose members are below ``folder``."""
    return _parts(spark.read.text(folder), "archive")


def member_path(folder: str, member: str) -> str:
    """Where ``stage_members`` put one member of every archive."""
    return f"{folder.rstrip('/')}/member={quote(member, safe=' ().-_@,')}"
