"""Token ids in Arrow files of fixed-size lists: sequences of equal length with masks, read without copying.

Documents are dealt by doc_id into ranges; each task encodes its range in order, appends the end id to each document
and writes two Arrow IPC files: ``part-N.arrow`` (ids: fixed_size_list<uint16>, or uint32 for a
vocabulary over 65,536; mask: fixed_size_list<bool>, one bit an id; the last sequence of a file is padded, mask false) and ``part-N.docs.arrow`` (doc_id, start in the part, n_tokens). A file is
written under a name of the attempt and then renamed, so a repeated task replaces its own equal file. Batches have
SEQUENCES_PER_BATCH sequences: the place of a sequence follows from its number, and a reader maps the file and slices.

A null text counts as empty: its document is the end id alone. Rows with null doc_id come first; repeated rows are all
written, equal ids in order of their text. An empty table writes no file. Columns other than the two read are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.common import small_batches, texts
from ledgerloom.llm.tokens import encoder

SEQUENCES_PER_BATCH = 64
MANIFEST = "part long, n_ids long, n_docs long"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _opened(folder: str):
    """The file system that a folder's URI names, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _names(root: str, part: int) -> tuple[str, str]:
    return f"{root}/part-{part:06d}.arrow", f"{root}/part-{part:06d}.docs.arrow"


class _SequenceWriter:
    """Cuts a stream of ids into sequences and writes full batches as they come."""

    def __init__(self, sink, length: int, vocabulary: int):
        self.length = length
        kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
        self.dtype = kind.to_pandas_dtype()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.held: list[bytes] = []
        self.n_held = self.n_ids = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n_held += len(ids) // 4
        self.n_ids += len(ids) // 4
        batch = SEQUENCES_PER_BATCH * self.length
        if self.n_held >= batch:
            data = np.frombuffer(b"".join(self.held), "<u4")
            full = len(data) // batch * batch
            for at in range(0, full, batch):
                self._write(data[at : at + batch], batch)
            self.held, self.n_held = [data[full:].tobytes()], len(data) - full

    def _write(self, ids: np.ndarray, n: int) -> None:
        mask = np.arange(n) < len(ids)
        padded = np.zeros(n, self.dtype)
        padded[: len(ids)] = ids
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
            for values, field in zip((padded, mask), self.schema, strict=True)
        ]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.held), "<u4")
        if len(rest):
            self._write(rest, -(-len(rest) // self.length) * self.length)
        self.out.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, length: int = 2048
) -> list[tuple[int, int, int]]:
    """Write all documents; returns (part, ids, documents) of each file, as many rows as tasks."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, int(end_id).to_bytes(4, "little")
        vocabulary = max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        store, root = _opened(folder)
        paths = _names(root, part)
        held = [f"{root}/.{attempt}.{i}" for i in range(2)]
        sinks, writer, index, n_docs = [], None, None, 0
        for batch in small_batches(batches, 2048):
            if writer is None:
                store.create_dir(root, recursive=True)
                sinks = [store.open_output_stream(path) for path in held]
                writer, index = _SequenceWriter(sinks[0], length, vocabulary), pa.ipc.new_file(sinks[1], DOCS)
            starts, counts = [], []
            for text in batch.column("text").to_pylist():
                ids = encode(text) + end
                starts.append(writer.n_ids)
                counts.append(len(ids) // 4)
                writer.add(ids)
            index.write_batch(
                pa.record_batch([batch.column("doc_id"), pa.array(starts), pa.array(counts)], schema=DOCS)
            )
            n_docs += batch.num_rows
        if writer is None:
            return
        writer.close()
        index.close()
        for sink, path, final in zip(sinks, held, paths, strict=True):
            sink.close()
            store.move(path, final)
        yield pa.RecordBatch.from_pylist([{"part": part, "n_ids": writer.n_ids, "n_docs": n_docs}])

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(write, MANIFEST).collect()
    return sorted((row.part, row.n_ids, row.n_docs) for row in rows)


class TokenFile:
    """One part, mapped where its store is local: sequences by number and documents by row are views of its bytes."""

    def __init__(self, folder: str, part: int):
        from pyarrow import fs

        store, root = _opened(folder)
        path, docs = _names(root, part)
        local = isinstance(store, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))
        self.length = self.file.schema.field("ids").type.list_size
        self.docs = pa.ipc.open_file(pa.memory_map(docs) if local else store.open_input_file(docs))
        self._batch: tuple[int, pa.RecordBatch | None] = (-1, None)

    def batch(self, k: int) -> pa.RecordBatch:
        if self._batch[0] != k:
            self._batch = (k, self.file.get_batch(k))
        return self._batch[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file's bytes) and mask of sequence i."""
        batch, row = self.batch(i // SEQUENCES_PER_BATCH), i % SEQUENCES_PER_BATCH
        place = slice(row * self.length, (row + 1) * self.length)
        mask = batch.column("mask").values[place]
        return batch.column("ids").values.to_numpy()[place], mask.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from start on, as one view for each batch they lie in."""
        size = SEQUENCES_PER_BATCH * self.length
        while n > 0:
            k, at = divmod(start, size)
            view = self.batch(k).column("ids").values.to_numpy()[at : at + n]
            yield view
            start, n = start + len(view), n - len(view)


def read_documents(spark: SparkSession, folder: str, manifest: list[tuple[int, int, int]]) -> DataFrame:
    """Place, length and checksum of each document, from the files. The list of files is as long as the writer had tasks."""
    places, base = [], 0
    for part, n_ids, _ in manifest:
        places.append((part, base))
        base += n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = TokenFile(folder, row["part"])
                for k in range(part.docs.num_record_batches):
                    found = part.docs.get_batch(k)
                    starts, counts = (found.column(name).to_numpy() for name in ("start", "n_tokens"))
                    sums = []
                    for start, n in zip(starts.tolist(), counts.tolist(), strict=True):
                        crc = 0
                        for view in part.ids(start, n):
                            crc = zlib.crc32(view.astype("<u4"), crc)
                        sums.append(crc)
                    columns = [found.column("doc_id"), pa.array(starts + row["base"]), found.column("n_tokens")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    tasks = max(1, min(len(places), 4096))
    files = spark.createDataFrame(places, "part long, base long").repartition(tasks)
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
