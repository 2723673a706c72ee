"""Best-fit packing of token sequences, certified by lower bounds from dual feasible functions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import give_back, in_slices, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", bin long, offset long, residual long, bins long, bound long"

#: Rows of a partition that is packed in one task.
PART_ROWS = 40_000
#: Exchanges at most; each must save a sequence to be kept.
ROUNDS = 4


def cutter(tokenizer: str, capacity: int, end: int):
    """Documents to pieces: ids and the end id, cut only where longer than a sequence."""
    import zlib

    import pyarrow as pa

    from quotelens.llm.tokenizing import word_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer, end)
        for batch in in_slices(batches, "text"):
            rows = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, found in zip(batch.column("doc_id").to_pylist(), ids_of(texts)):
                ids = memoryview(found).cast("B")
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )
        give_back()

    return run


def lower_bound(counts, capacity: int) -> int:
    """Least number of bins for `counts[length]` pieces, by two families of dual feasible functions.

    A function f on [0, 1] is dual feasible if sums of lengths of at most 1 keep sums
    of f of at most 1; then the sum of f over all pieces is a lower bound. First
    family, for each t up to one half: 1 above 1 - t, the length itself from t to
    1 - t, 0 below t. Second, for k = 1, 2, ...: a length at a multiple of 1 / (k + 1)
    stays, others go down to a multiple of 1 / k after scaling by k + 1.
    """
    import numpy as np

    counts = np.asarray(counts, dtype=np.int64)
    length = np.arange(capacity + 1, dtype=np.int64)
    n, mass = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * length)))
    t = np.arange(0, capacity // 2 + 1)
    first = (n[-1] - n[capacity - t + 1]) * capacity + mass[capacity - t + 1] - mass[t]
    best = -(-int(first.max()) // capacity)
    for k in range(1, 40):
        scaled = length * (k + 1)
        exact = scaled % capacity == 0
        # In units of 1 / (capacity * k), so that the sum is exact.
        value = np.where(exact, length * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths, capacity: int):
    """Bin and offset of each piece, longest first into the fullest bin that holds it; and the bins' free room."""
    import numpy as np

    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    at_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    mask = 0  # bit r: a bin with room r exists
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = at_room[room].pop()
            if not at_room[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(rooms)
            rooms.append(0)
        bins[i], offsets[i] = b, capacity - room
        rooms[b] = room = room - size
        if room:
            if not at_room[room]:
                mask |= 1 << room
            at_room[room].append(b)
    return bins, offsets, np.array(rooms, np.int64)


def packer(capacity: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        # A fixed order, so that a task that runs again packs alike.
        table = table.sort_by([(c, "ascending") for c in ("length", "ids_crc32", "doc_id", "piece")])
        lengths = table.column("length").to_numpy()
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        n = len(lengths)
        found = {
            "bin": bins, "offset": offsets, "residual": rooms[bins], "bins": np.full(n, len(rooms)),
            "bound": np.full(n, bound),
        }
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, values in found.items():
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out.append_column("part", table.column("part"))

    return run


def packed_parts(items: DataFrame, n: int, capacity: int, name: str) -> DataFrame:
    """Items dealt at random into parts of bounded size, each packed by itself."""
    parts = max(1, -(-n // PART_ROWS))
    dealt = items.select("*", (F.rand(17) * parts).cast("long").alias("part"))
    return stored(dealt.groupBy("part").applyInArrow(packer(capacity), PACKED + ", part long"), name)


def number_of_bins(packed: DataFrame) -> int:
    """Bins of all parts; every part has a bin 0."""
    return packed.where("bin = 0 and offset = 0").agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]


def pack(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """Pieces of all documents with sequence_id and offset, in as few sequences as it can.

    Pieces that fill a sequence are sequences. The others are dealt into parts, each
    packed by best-fit decreasing. A part whose number of bins equals its lower bound
    is proven optimal and final, as is every full bin of the others. What stands in
    the remaining bins is exchanged: dealt anew into as few parts as may be, and
    packed again, as long as that saves sequences.

    A null or empty text is its end id alone. Rows that repeat a document are packed
    each for itself; a null key stays null. No rows give no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(rows.mapInArrow(cutter(tokenizer, capacity, end), PIECES), "pieces")
    full = pieces.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    items = pieces.where(F.col("length") < capacity)
    current = packed_parts(items, items.count(), capacity, "packed")
    done = full
    for level in range(ROUNDS + 1):
        sequence = (
            F.lit(level).cast("long") * F.lit(1 << 58) + F.col("part") * F.lit(1 << 24) + F.col("bin")
        ).alias("sequence_id")
        columns = [*full.columns[:5], sequence, "offset"]
        movable = current.where("bins > bound and residual > 0")
        left = movable.select(*full.columns[:5])
        n = left.count()
        # Bins of which some documents would move; each has one document at offset 0.
        before = movable.where("offset = 0").count()
        again = packed_parts(left, n, capacity, "packed") if before > 1 and level < ROUNDS else None
        if again is None or number_of_bins(again) >= before:
            return done.unionByName(current.select(*columns))
        done = done.unionByName(current.where("bins <= bound or residual = 0").select(*columns))
        current = again
    raise AssertionError("the last round returns")


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
