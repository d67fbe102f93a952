"""Token ids in binary files: Simple-8b blocks behind an index, one file per range of ids.

File: ``MAGIC``; the words of all blocks, little-endian; the block table (first word,
words, escaped numbers, numbers; four 64-bit numbers each); the document table (doc_id,
whether it is null, ids); and the three counts (words, blocks, documents). Any block is
found through the table, and documents are runs of the numbers in table order.

A task writes its file under a name of its own attempt and then moves it to its final
name, so a repeated or speculative task replaces it by the same bytes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import simple8b
from tidemark.llm.common import (
    column,
    text_column,
    file_system,
    materialise,
    new_run_dir,
    record_batches,
    running_total,
    short_batches,
    to_batch,
)
from tidemark.llm.tokenizing import library_encoder

MAGIC = b"TIDS8B01"
#: Ids that are coded or decoded at once.
CHUNK = 256 * simple8b.BLOCK

MANIFEST = pa.schema(
    [("shard", pa.int64()), ("name", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]
)
READ = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


class _Writer:
    """One file, written as the documents come; holds at most a chunk of ids."""

    def __init__(self, stream):
        self.stream = stream
        self.stream.write(MAGIC)
        self.tables: list[np.ndarray] = []
        self.docs: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []
        self.n_held = self.n_words = self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id or 0, doc_id is None, n))
        self.held.append(ids)
        self.n_held += n
        self.n_ids += n
        if self.n_held >= CHUNK:
            self._code(self.n_held // simple8b.BLOCK * simple8b.BLOCK)

    def _code(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.held), dtype="<u4")
        self.held, self.n_held = [ids[n:].tobytes()], len(ids) - n
        words, table = simple8b.encode(ids[:n])
        first = self.n_words + np.cumsum(table[:, 0] + table[:, 1]) - table[:, 0] - table[:, 1]
        self.tables.append(np.column_stack([first, table]).astype("<i8"))
        self.n_words += len(words)
        self.stream.write(words.tobytes())

    def close(self) -> None:
        if self.n_held:
            self._code(self.n_held)
        blocks = np.concatenate(self.tables) if self.tables else np.zeros((0, 4), "<i8")
        docs = np.array(self.docs, dtype="<i8").reshape(-1, 3)
        for part in (blocks, docs, np.array([self.n_words, len(blocks), len(docs)], "<i8")):
            self.stream.write(part.tobytes())
        self.stream.close()


def read_file(source, chunk_blocks: int = CHUNK // simple8b.BLOCK) -> Iterator[tuple]:
    """``(doc_id, n_ids, pieces)`` of every document of an open file, in order.

    ``pieces`` are arrays of ids; take them before the next document.
    """
    size = source.size()
    n_words, n_blocks, n_docs = np.frombuffer(source.read_at(24, size - 24), "<i8").tolist()
    at = size - 24 - 24 * n_docs
    docs = np.frombuffer(source.read_at(24 * n_docs, at), "<i8").reshape(-1, 3)
    table_at = at - 32 * n_blocks
    table = np.frombuffer(source.read_at(32 * n_blocks, table_at), "<i8").reshape(-1, 4)
    if source.read_at(len(MAGIC), 0) != MAGIC or len(MAGIC) + 8 * n_words != table_at:
        raise ValueError("not a token file, or one that is cut off")

    def decoded() -> Iterator[np.ndarray]:
        for i in range(0, n_blocks, chunk_blocks):
            part = table[i : i + chunk_blocks]
            first = int(part[0, 0])
            n = int(part[-1, 0] + part[-1, 1] + part[-1, 2]) - first
            words = np.frombuffer(source.read_at(8 * n, len(MAGIC) + 8 * first), "<u8")
            yield simple8b.decode(words, part[:, 1:])

    chunks = decoded()
    chunk, used = np.zeros(0, np.uint64), 0
    for doc_id, null, n in docs.tolist():
        pieces, missing = [], n
        while missing:
            if used == len(chunk):
                chunk, used = next(chunks), 0
            take = min(missing, len(chunk) - used)
            pieces.append(chunk[used : used + take])
            used += take
            missing -= take
        yield None if null else doc_id, n, pieces


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int | None, shards: int | None = None
) -> DataFrame:
    """Encode whole texts in ascending ``doc_id`` order into files below ``path``.

    Returns the manifest (shard, name, docs, ids), one row per file, written beside the
    files. A null text is empty, a null ``doc_id`` comes first, rows of one ``doc_id``
    come in the order of their texts' hash. An empty table gives no file.
    """
    spark = docs.sparkSession
    short_batches(spark)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = ["doc_id", F.xxhash64("text")]
    ranged = narrow.repartitionByRange(shards, *order) if shards else narrow.repartitionByRange(*order)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def write(batches):
        encoder = library_encoder(vocabulary, True)
        writer = None
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}.ids"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs, folder = file_system(path)
                fs.create_dir(folder, recursive=True)
                own = f"{folder}/_writing-{name}-{uuid.uuid4().hex}"
                writer = _Writer(fs.open_output_stream(own))
            found = encoder.encode(text_column(batch))
            for doc_id, ids in zip(column(batch, "doc_id"), found, strict=True):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            fs.move(own, f"{folder}/{name}")
            yield to_batch([(shard, name, len(writer.docs), writer.n_ids)], MANIFEST)

    written = ranged.sortWithinPartitions(*order).mapInArrow(
        write, "shard long, name string, docs long, ids long"
    )
    return materialise(written, "token-manifest")


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, decoded from the files."""
    placed = running_total(manifest, "shard", "ids", "base").select("name", "base")

    def read(batches):
        fs, folder = file_system(path)
        for batch in batches:
            for name, base in zip(column(batch, "name"), column(batch, "base"), strict=True):
                yield from record_batches(_digests(fs, f"{folder}/{name}", base), READ)

    spread = placed.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 2)
    return spread.mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _digests(fs, name: str, start: int) -> Iterator[tuple]:
    with fs.open_input_file(name) as source:
        for doc_id, n, pieces in read_file(source):
            crc = 0
            for piece in pieces:
                crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
            yield doc_id, start, n, crc
            start += n


def token_files(docs: DataFrame, vocabulary: str, end_id: int | None = None) -> DataFrame:
    """Write the token files of ``docs`` in a fresh shared folder and read them back."""
    path = new_run_dir(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, path, vocabulary, end_id), path)
