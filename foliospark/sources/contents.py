"""Contents of chosen files: a table of paths, dealt out by length, each file opened in the task
that holds its row. Files that are not in the table are never opened."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators.skew import salts_for, with_running
from foliospark.session import ship_code

#: Bytes of contents that are handed on at once; a longer file is handed on alone.
BATCH_BYTES = 16 << 20
#: What opening a file costs, in bytes of reading.
OPEN_COST = 4 << 20
#: Bytes that a task reads in one go before the next task gets its share.
SHARE_BYTES = 64 << 20


def open_uri(path: str) -> bytes:
    """The contents of a file: a local path, or an address that Arrow's file systems know."""
    if "://" not in path:
        with open(path.removeprefix("file:"), "rb") as f:
            return f.read()
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_stream(inner) as f:
        return f.read()


def dealt_by_length(files: DataFrame, path: str = "path", length: str = "length", share: int = SHARE_BYTES) -> DataFrame:
    """Rows of unique paths in partitions of about equal numbers of bytes: neighbours in path order
    are packed into shares, and shares are dealt to partitions in turn. Which partition a row goes
    to depends on the table alone."""
    cost = F.coalesce(F.col(length), F.lit(0)) + OPEN_COST
    n = salts_for(files)
    packed = with_running(files, [path], cost, "_upto")
    dealt = F.pmod(F.floor((F.col("_upto") - 1) / F.lit(share)), F.lit(n)).cast("int")
    return packed.repartitionById(n, dealt).drop("_upto")


def read_contents(
    files: DataFrame,
    path: str = "path",
    length: str = "length",
    source: str | None = None,
    opener: Callable[[str], bytes] = open_uri,
    opened: Accumulator | None = None,
) -> DataFrame:
    """`files` with `content` (bytes) and `read_error` (text): one of them is there, the other NULL.

    `path` is unique, `source` names the column that says which file to open for the row (default
    `path`; a NULL leaves both NULL), `length` is used to deal rows out. A task holds one file at a
    time, or small ones up to `BATCH_BYTES`. A file that cannot be read is data, not a failure of
    the job. `opener` runs in the tasks; `opened`, if given, counts its calls.
    """
    rows = dealt_by_length(files, path, length)
    at = rows.columns.index(source or path)
    names = [*rows.columns, "content", "read_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch: pa.RecordBatch, contents: list, errors: list) -> pa.RecordBatch:
            part = batch.slice(start, len(contents))
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())], names)

        for batch in batches:
            start, contents, errors, size = 0, [], [], 0
            for address in batch.column(at):
                content, error = None, None
                if address.is_valid:
                    try:
                        if opened is not None:
                            opened.add(1)
                        content = opener(address.as_py())
                    except Exception as e:  # of any store
                        error = f"{type(e).__name__}: {e}"
                # not beyond what a batch holds in all
                if contents and size + len(content or b"") > BATCH_BYTES:
                    yield made(batch, contents, errors)
                    start, contents, errors, size = start + len(contents), [], [], 0
                contents.append(content)
                errors.append(error)
                size += len(content or b"")
            if contents:
                yield made(batch, contents, errors)

    ship_code(rows)
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, content binary, read_error string")
