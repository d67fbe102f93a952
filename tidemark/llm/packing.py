"""Best-fit packing planned over a histogram of lengths.

The plan never sees documents: it places counts of equal lengths into counts of equally
filled sequences, longest first, each into the fullest sequences that still have room. It
has a few thousand rows at most, whatever the number of documents, so it may be
broadcast. Documents then take the planned slots by their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, materialise, record_batches, short_batches, text_column
from tidemark.llm.tokenizing import library_encoder

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
#: Rows of a rank bucket, about.
BUCKET_ROWS = 50_000


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, pieces, first sequence, offset)``.

    Pieces of rank ``first .. first + pieces - 1`` of that length go to as many consecutive
    sequences, at the same offset of each. Longest first; each count goes to the sequences
    with the least room that is enough, and to new ones when there are none.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    open_by_room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if room:
            if not open_by_room.get(room):
                open_by_room[room] = []
                insort(rooms, room)
            open_by_room[room].append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1 to {capacity}")
        left, rank = counts[length], 0
        while left:
            room = next((r for r in rooms if r >= length), None)
            if room is None:
                each = capacity // length
                full, rest = divmod(left, each)
                for n, held in ((full, each), (1 if rest else 0, rest)):
                    if n:
                        for k in range(held):
                            slots.append((length, rank, n, sequences, k * length))
                            rank += n
                        put(capacity - held * length, sequences, n)
                        sequences += n
                break
            first, n = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms.remove(room)
            take = min(left, n)
            if take < n:
                put(room, first + take, n - take)
            slots.append((length, rank, take, first, capacity - room))
            put(room - length, first, take)
            rank += take
            left -= take
    return slots


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Per piece of a document: doc_id, piece, start, length, ids_crc32; ids stay in the task."""
    short_batches(docs.sparkSession)

    def cut(batches):
        encoder = library_encoder(vocabulary, False)
        end = end_id.to_bytes(4, "little")
        step = 4 * capacity
        for batch in batches:
            found = encoder.encode(text_column(batch))
            rows = (
                (doc_id, k, k * capacity, len(part) // 4, zlib.crc32(part))
                for doc_id, ids in zip(column(batch, "doc_id"), found, strict=True)
                for data in (ids + end,)
                for k, part in enumerate(data[i : i + step] for i in range(0, len(data), step))
            )
            yield from record_batches(rows, PIECES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``.

    A null text is an empty one and still has its end id. Rows that repeat, also with the
    same ``doc_id``, are packed each. An empty table gives an empty result.
    """
    pieces = materialise(token_pieces(docs, vocabulary, end_id, capacity), "pieces")
    total = pieces.count()
    buckets = max(1, total // BUCKET_ROWS)
    bucketed = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    )
    per_bucket = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = per_bucket.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # <= capacity
    slots = plan_best_fit({r["length"]: r["n"] for r in counts}, capacity)
    plan = docs.sparkSession.createDataFrame(
        slots,
        "plan_length long, first_rank long, pieces long, first_sequence long, offset long",
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = bucketed.withColumn("inside", F.row_number().over(inside) - 1).join(
        bases.select("length", "bucket", "base"), ["length", "bucket"]
    ).withColumn("rank", F.col("base") + F.col("inside"))
    # The plan depends on the capacity, not on the number of documents: it fits a broadcast.
    slot = (
        (F.col("length") == F.col("plan_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("pieces"))
    )
    return ranked.join(F.broadcast(plan), slot).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )
