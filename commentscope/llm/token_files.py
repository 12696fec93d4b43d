"""Token ids of a corpus as flat binary files with 64-bit document offsets.

Layout, in a folder that the driver and all executors see:

* ``part-NNNNN.ids``: unsigned 16-bit little-endian ids of the part's documents, end id included,
  one document after another;
* ``part-NNNNN.idx``: little-endian signed 64-bit values: number of documents n, n + 1 offsets into
  the part's ids (in ids, from 0), n document ids, n flags (1: the document id is null).

Parts follow ascending document id. A part's base, the number of ids in all parts before it, comes
from the prefix sum over one row per part; ``base + offset`` is a document's place in the corpus.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commentscope.llm.common import quoted, shared_folder, slices, text_or_empty, written
from commentscope.llm.tokens import encode_all

PARTS = "part int, path string, n_docs long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """One pair of files from the rows of a task, written under a name of the attempt and then renamed."""
    task = TaskContext.get()
    fs, root = _place(folder)
    name, own = f"{root}/part-{task.partitionId():05d}", f"{root}/.attempt-{task.taskAttemptId()}"
    end = np.array([end_id], "<u2").tobytes()
    lengths, ids, nulls, out = [], [], [], None
    for batch in (s for whole in batches for s in slices(whole, 1)):
        if out is None:
            fs.create_dir(root, recursive=True)
            out = fs.open_output_stream(own + ".ids")
        encoded = encode_all(batch.column("text").to_pylist(), vocabulary)
        out.write(b"".join(x for e in encoded for x in (e.tobytes(), end)))
        lengths += [len(e) + 1 for e in encoded]
        ids += batch.column("doc_id").fill_null(0).to_pylist()
        nulls += batch.column("doc_id").is_null().to_pylist()
    if out is None:
        return
    out.close()
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    with fs.open_output_stream(own + ".idx") as f:
        f.write(np.concatenate([[len(ids)], offsets, ids, nulls]).astype("<i8").tobytes())
    for kind in (".idx", ".ids"):
        fs.move(own + kind, name + kind)
    yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "path": [name], "n_docs": [len(ids)], "n_ids": [int(offsets[-1])]})


def write_ids(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts and write them in ascending document id; one row per written part, with its base.

    Null texts are empty (their end id alone is written); null ids come last. Rows with the same id
    are ordered by a hash of their text; equal rows are all written. Other columns are ignored.
    An empty table writes no part. A worker holds one Arrow batch of texts at a time.
    """
    folder = shared_folder(docs.sparkSession, "token-ids")
    scheme_kept = folder.split("://")[0] if "://" in folder and not folder.startswith("file:") else None
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = (rows.repartitionByRange(F.col("doc_id").asc_nulls_last(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), tie))
    parts = written(ordered.mapInArrow(partial(_write_part, folder=folder, vocabulary=vocabulary, end_id=end_id), PARTS), "token-parts")
    if scheme_kept:
        parts = parts.withColumn("path", F.concat(F.lit(folder + "/"), F.element_at(F.split("path", "/"), -1)))
    # one row per part: the prefix sum is over the number of parts, not of documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def _mapped(path: str, kind: str) -> np.ndarray:
    fs, place = _place(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(place, kind, "r") if os.path.getsize(place) else np.zeros(0, kind)
    with fs.open_input_file(place) as f:
        return np.frombuffer(f.read(), kind)


def _read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            index, ids = _mapped(path + ".idx", "<i8"), _mapped(path + ".ids", "<u2")
            n = int(index[0])
            offsets, doc_ids, nulls = index[1:n + 2], index[n + 2:2 * n + 2], index[2 * n + 2:3 * n + 2] != 0
            for i in range(0, n, 4096):
                j = min(n, i + 4096)
                crc = [zlib.crc32(ids[offsets[k]:offsets[k + 1]].astype("<u4").tobytes()) for k in range(i, j)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[i:j], pa.int64(), mask=np.array(nulls[i:j])), pa.array(base + offsets[i:j], pa.int64()),
                     pa.array(np.diff(offsets[i:j + 1]), pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """Read the files back by memory map: each document's place, length and CRC-32 of its ids as 32-bit values."""
    return parts.select("path", "base").repartition("path").mapInArrow(_read_parts, READ)


def token_files(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return read_ids(docs.sparkSession, write_ids(docs, vocabulary, end_id, id_col, text_col))
