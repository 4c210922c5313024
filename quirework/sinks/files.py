"""Writing files, with guards before any job runs."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from collections.abc import Iterable
from pathlib import Path

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import OverwriteError

MODES = ("never", "always", "if_same_run")


def inside(path: Path, root: Path | None) -> bool:
    return root is not None and path.resolve().is_relative_to(root.resolve())


def guard(path: str | Path, overwrite: str, run_root: str | Path | None = None) -> None:
    """Raise unless path may be written: it does not exist, or overwrite is `always`, or `if_same_run` and it lies under the run's folder."""
    p = Path(path)
    if not p.exists() or overwrite == "always" or (overwrite == "if_same_run" and inside(p, Path(run_root) if run_root else None)):
        return
    raise OverwriteError(f"exists: {path}")


def tell(path: str | Path) -> None:
    """What a dry run says of a file it would write."""
    kind = {".png": "image", ".json": "json", ".jsonl": "jsonl"}.get(Path(path).suffix, "text")
    print(f"[dry-run] write {kind}: {path}")


def corpus_mode(overwrite: str) -> str:
    """Corpora and book exports are replaced only by `always`."""
    return "always" if overwrite == "always" else "never"


def _replace(path: Path, data: bytes) -> None:
    """A file put in place whole: written beside its target, then moved over it."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{os.getpid()}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}")
    part.write_bytes(data)
    os.replace(part, path)


def write_files(rows: DataFrame, overwrite: str = "never", run_root: str | Path | None = None, dry_run: bool = False, targets: DataFrame | None = None) -> list[str]:
    """Write each (path, content) row to its file in a shared folder; content is string or binary. All targets are checked first; returns the paths.

    A dry run checks the targets and tells what would be written. targets: the paths, where those of rows are costly to make.
    """
    paths = [r.path for r in (rows if targets is None else targets).select("path").toLocalIterator()]
    for p in paths:
        guard(p, overwrite, run_root)
    if dry_run:
        for p in paths:
            tell(p)
    else:

        def put(part: Iterable) -> None:
            for r in part:
                _replace(Path(r.path), bytes(r.content) if isinstance(r.content, (bytes, bytearray)) else r.content.encode("utf-8"))

        rows.select("path", "content").foreachPartition(put)
    return paths


@F.pandas_udf(T.StringType())
def indented(texts: pd.Series) -> pd.Series:
    """JSON text laid out with an indent of two; other letters than ASCII stay."""
    return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2))


def pretty(value: Column) -> Column:
    """A struct as indented JSON text with nulls kept."""
    return indented(F.to_json(value, {"ignoreNullFields": "false"}))


def write_ordered(parts: DataFrame, order: list[str], column: str, path: str | Path, between: str, overwrite: str = "never", dry_run: bool = False, end: str = "\n") -> None:
    """Write the texts of a column in order into one file, `between` them, the whole stripped and followed by `end`.

    Tasks write ranges of the order to files of their own; the driver appends these as bytes, so that no text has to fit a task or the driver.
    """
    target = Path(path)
    guard(target, overwrite)
    if dry_run:
        tell(target)
        return
    target.parent.mkdir(parents=True, exist_ok=True)
    work = Path(tempfile.mkdtemp(prefix=f".{target.name}.", dir=target.parent))
    try:

        def put(part: Iterable) -> None:
            at = work / f"{TaskContext.get().partitionId():08d}.{TaskContext.get().taskAttemptId()}"
            with at.open("wb") as f:
                for r in part:
                    f.write(r[0].encode("utf-8") + between.encode())
            os.replace(at, work / f"{TaskContext.get().partitionId():08d}")

        keys = [F.col(c).asc_nulls_first() for c in order]
        parts.repartitionByRange(*keys).sortWithinPartitions(*keys).select(column).foreachPartition(put)
        whole = work / "whole"
        with whole.open("wb") as out:
            for p in sorted(p for p in work.iterdir() if p.name.isdigit()):
                with p.open("rb") as f:
                    shutil.copyfileobj(f, out)
        with whole.open("rb+") as f:
            size = f.seek(0, os.SEEK_END)
            while size and (f.seek(size - 1), f.read(1))[1].isspace():
                size -= 1
            f.truncate(size)
            f.seek(size)
            f.write(end.encode())
        os.replace(whole, target)
    finally:
        shutil.rmtree(work, ignore_errors=True)


def write_corpus(pages: DataFrame, path: str | Path, overwrite: str = "never", dry_run: bool = False) -> None:
    """A canonical corpus: one JSON object per page and line, in page order, nulls kept."""
    rows = pages.select("page_num", F.to_json(F.struct(*pages.columns), {"ignoreNullFields": "false"}).alias("row"))
    write_ordered(rows, ["page_num"], "row", path, "\n", corpus_mode(overwrite), dry_run)
