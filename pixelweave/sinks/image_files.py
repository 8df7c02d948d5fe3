"""Loose image files, for programs that read a folder of images."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from pixelweave.functions.storage import locate


def write_image_files(df: DataFrame, root: str) -> DataFrame:
    """Write ``content`` to ``<root>/<split>/<name>`` from the executors.

    Returns the rows with column ``bytes`` in place of the content; nothing happens until
    that table is used. A file is moved into place when complete and its bytes depend only
    on its row, so a repeated task does no harm. ``root`` must be reachable by all
    executors.
    """
    kept = [c for c in df.columns if c != "content"]

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = locate(root)
        made = set()
        for batch in batches:
            sizes = []
            for split, name, content in zip(*(batch.column(c) for c in ("split", "name", "content"))):
                folder = f"{base}/{split}"
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                data = content.as_buffer()
                # A leading underscore hides the unfinished file from readers.
                partial = f"{folder}/_{name}.{uuid.uuid4().hex}"
                with filesystem.open_output_stream(partial) as out:
                    out.write(data)
                _replace(filesystem, partial, f"{folder}/{name}")
                sizes.append(data.size)
            columns = [*batch.select(kept).columns, pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "bytes"])

    return df.mapInArrow(save, df.select(*kept).schema.add("bytes", "long"))


def _replace(filesystem: pafs.FileSystem, partial: str, final: str) -> None:
    try:
        filesystem.move(partial, final)
    except OSError:
        # Some file systems do not move onto a file that exists. Another attempt of this
        # task has then put the same bytes there; the complete file is left alone.
        if filesystem.get_file_info(final).type != pafs.FileType.File:
            raise
        filesystem.delete_file(partial)
