"""Token ids in flat binary files, readable by memory mapping.

Each partition of documents, in ascending order of doc_id, is one pair of files:

``*.bin``  the ids of its documents, one after the other: unsigned 16-bit
           numbers if the vocabulary fits, else 32-bit, little-endian;
``*.idx``  64-bit numbers: count n, n + 1 document offsets into the ``.bin``
           file, n document ids, n flags (1: the id is null).

The manifest holds one row per pair; its bases, the ids and documents of all
files before, are prefix sums over the partitions.  A task writes under a name
of its own attempt, and only the names of attempts that succeeded are in the
manifest, so a repeated task leaves nothing half written in it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.shared import new_folder, save
from basketry.llm.tokens import encoded_rows

MANIFEST = "part int, path string, width int, documents long, ids long"


def _system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def mapped(uri: str, kind: str) -> np.ndarray:
    """A file as numbers: memory-mapped where the file system is mounted."""
    system, path = _system(uri)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if system.get_file_info(path).size else np.zeros(0, kind)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, vocabulary: int = 1 << 16) -> DataFrame:
    """Encode ``docs``, write the files to ``folder``, and return the manifest
    ``(part, path, width, documents, ids, first_id, first_document)``.

    A null or empty text is the end id alone.  Rows without doc_id come first;
    rows that repeat one are ordered by their text.
    """
    width = 2 if vocabulary <= 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}"
        system, path = _system(name)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        offsets, names, nulls, total = [np.zeros(1, np.int64)], [], [], 0
        with system.open_output_stream(f"{path}.bin") as out:
            for batch in batches:
                if not batch.num_rows:
                    continue
                lengths = np.zeros(batch.num_rows, np.int64)
                for row, ids in encoded_rows(batch.column(1), tokenizer, end_id):
                    lengths[row] = len(ids) // 4
                    out.write(np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes())
                offsets.append(total + np.cumsum(lengths))
                total = int(offsets[-1][-1])
                names.append(batch.column(0).fill_null(0).to_numpy())
                nulls.append(batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        n = sum(map(len, names))
        if not n:
            return
        with system.open_output_stream(f"{path}.idx") as out:
            out.write(np.concatenate([[n], *offsets, *names, *nulls]).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([name]), pa.array([width], pa.int32()), pa.array([n]), pa.array([total])],
            ["part", "path", "width", "documents", "ids"],
        )

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows = save(ordered.mapInArrow(write, MANIFEST), "manifest").orderBy("part").collect()  # one row per file
    done, first_id, first_document = [], 0, 0
    for r in rows:
        done.append((*r, first_id, first_document))
        first_id, first_document = first_id + r.ids, first_document + r.documents
    return docs.sparkSession.createDataFrame(done, f"{MANIFEST}, first_id long, first_document long")


def read_documents(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, from the files;
    ``ids`` are little-endian unsigned 32-bit numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                index = mapped(f"{r['path']}.idx", "<i8")
                ids = mapped(f"{r['path']}.bin", f"<u{r['width']}")
                n = int(index[0])
                offsets, names, nulls = index[1 : n + 2], index[n + 2 : 2 * n + 2], index[2 * n + 2 : 3 * n + 2]
                low = 0
                while low < n:
                    high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + (2 << 20), "right")) - 1)
                    high = min(high, n)
                    part = np.array(ids[offsets[low] : offsets[high]], "<u4")
                    cuts = np.array(offsets[low : high + 1]) - offsets[low]
                    values = [part[cuts[i] : cuts[i + 1]].tobytes() for i in range(high - low)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(names[low:high]), pa.int64(), mask=np.array(nulls[low:high]) == 1),
                            pa.array(np.array(offsets[low:high]) + r["first_id"]),
                            pa.array(np.diff(cuts)),
                            pa.array(values, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    low = high

    files = max(1, manifest.count())
    spread = manifest.select("path", "width", "first_id").repartition(files)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` as read back from the files."""
    spark: SparkSession = docs.sparkSession
    manifest = write_token_files(docs, tokenizer, end_id, folder or new_folder(spark, "tokens"))
    return read_documents(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32_of(ids: np.ndarray) -> int:
    """The digest of ids, for checks outside Spark."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
