"""Pages as a file each, under their key.

Tasks write the files themselves. Spark's own writer would make a folder for each key, move each of them in the
driver, and leave a folder for each page to be listed again. Files lie in folders of bounded length, which are
listed side by side; a folder is put in place as a whole once it is full, so a task that is run again or killed
leaves no half of a file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import count
from urllib.parse import quote_plus

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# No key is written with a leading underscore, see below.
NO_KEY = "_null=.html"
PER_FOLDER = 1000


def file_name(key: str | None) -> str:
    """Escaped, as the reader expects it; a leading ``_`` or ``.`` would hide the file from Spark."""
    if not key:
        return NO_KEY
    name = quote_plus(key, safe="=&,;@!$()~")
    return (f"%{ord(name[0]):02X}{name[1:]}" if name[0] in "_." else name) + ".html"


def located(folder: str) -> tuple[fs.FileSystem, str]:
    at, path = fs.FileSystem.from_uri(f"file://{folder[5:]}" if folder.startswith("file:/") and folder[6:7] != "/" else folder)
    return at, path.rstrip("/")


def writer(folder: str):
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = located(folder)
        task = TaskContext.get()
        names = (f"shard=s{task.partitionId():05d}-{i:04d}" for i in count())
        own = f"{root}/_writing/{task.taskAttemptId()}"

        def put(shard: str, key: str | None, lines: list[str | None]) -> None:
            with store.open_output_stream(f"{own}/{shard}/{file_name(key)}", compression=None) as f:
                f.write("".join(f"{x or ''}\n" for x in lines).encode())

        def in_place(shard: str) -> None:
            """The first attempt counts; another one has written the same."""
            if store.get_file_info(f"{root}/{shard}").type == fs.FileType.NotFound:
                store.move(f"{own}/{shard}", f"{root}/{shard}")

        shard, held = "", 0
        for key, lines in pages_of(batches):
            if not held:
                shard = next(names)
                store.create_dir(f"{own}/{shard}")
            put(shard, key, lines)
            held += 1
            if held == PER_FOLDER:
                in_place(shard)
                held = 0
        if held:
            in_place(shard)
        yield from ()

    return written


def pages_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, list[str | None]]]:
    """Rows sorted by key; those that share a task and a key share a file, as lines."""
    key, lines = None, []
    for batch in batches:
        for k, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
            k = k or None
            if lines and k != key:
                yield key, lines
                lines = []
            key = k
            lines.append(text)
    if lines:
        yield key, lines


def write_pages(pages: DataFrame, folder: str, key: str = "page_key", html: str = "html") -> None:
    """Save each page under its key in a new folder; ``read_saved_pages`` reads them again.

    A file ends with a line feed that is not the page's: Spark passes over files without any byte.
    The folder has to be one that driver and executors share, of a file system that pyarrow knows. Equal keys
    give a file in each task that has them. A row has to come to the same task if that is run again.
    """
    store, root = located(folder)
    if store.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(folder)
    store.create_dir(root, recursive=True)
    rows = pages.select(F.col(key), F.col(html)).sortWithinPartitions(F.nullif(key, F.lit("")))
    rows.mapInArrow(writer(folder), "none int").write.format("noop").mode("overwrite").save()
    if store.get_file_info(f"{root}/_writing").type != fs.FileType.NotFound:
        store.delete_dir(f"{root}/_writing")
