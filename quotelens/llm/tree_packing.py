"""First-fit decreasing with a tournament tree, in randomised groups of documents, and no padding left.

Sequences that end at a power of two need no padding, and documents may be cut. So after
first-fit decreasing, the emptiest sequences of a group are taken apart, their documents
fill the room of the others, and the few tokens that remain make sequences of powers of two.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import stored

RESTS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin long, offset long"

#: Documents of a group on average; one task packs a group, with the ids of its documents (2 bytes each).
GROUP_ROWS = 10_000


def cutter(tokenizer: str, capacity: int, end: int):
    """Documents to full sequences and a shorter rest, which carries its ids in 16 bits where they fit."""
    import zlib

    import numpy as np
    import pyarrow as pa

    from quotelens.llm.tokenizing import word_ids

    kinds = [pa.int64()] * 5 + [pa.binary()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer, end)
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of(texts)):
                for at in range(0, len(ids), capacity):
                    part = ids[at : at + capacity]
                    kept = None
                    if len(part) < capacity:
                        small = part.max() < 1 << 16
                        kept = (b"s" + part.astype("<u2").tobytes()) if small else (b"l" + part.tobytes())
                    rows.append((doc, at, len(part), zlib.crc32(part.data), len(ids), kept))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        # The worker waits for its next task with what it holds.
        pa.default_memory_pool().release_unused()

    return run


def first_fit_decreasing(lengths, capacity: int):
    """Bin and offset of each piece, longest first into the first bin that holds it; and the bins' free room.

    The tournament tree has a leaf a bin with its free room, and each inner node the
    larger room of its two children: going down from the root to the left wherever the
    room suffices finds the first bin in as many steps as the tree is high.
    """
    import numpy as np

    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    used = 0
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        used = max(used, node - leaves + 1)
        tree[node] -= size
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
    return bins, offsets, np.array(tree[leaves : leaves + used], np.int64)


def powers_of_two(n: int) -> list[int]:
    """The powers of two that add up to `n`, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def fill(lengths, bins, offsets, rooms, capacity: int):
    """Pieces (row, from, length, bin, offset) without padding.

    As many bins stay as the tokens fill, the fullest ones. The rows of the others are
    cut into the free rooms, and what is left into bins of powers of two.
    """
    import numpy as np

    total = int(lengths.sum())
    keep = total // capacity
    fullest = np.argsort(rooms, kind="stable")
    stays = np.zeros(len(rooms), bool)
    stays[fullest[:keep]] = True
    whole = stays[bins]
    found = [(int(r), 0, int(lengths[r]), int(bins[r]), int(offsets[r])) for r in np.flatnonzero(whole)]
    # Free stretches: bin, where it begins, its length.
    free = [(int(b), capacity - int(rooms[b]), int(rooms[b])) for b in np.flatnonzero(stays) if rooms[b]]
    free += [(len(rooms) + k, 0, size) for k, size in enumerate(powers_of_two(total - keep * capacity))]
    stretches = iter(free)
    b, at, room = next(stretches, (0, 0, 0))
    for r in np.flatnonzero(~whole).tolist():
        begin = 0
        while begin < lengths[r]:
            if not room:
                b, at, room = next(stretches)
            size = min(room, int(lengths[r]) - begin)
            found.append((r, begin, size, b, at))
            begin, at, room = begin + size, at + size, room - size
    return found


def packer(capacity: int):
    def run(table):
        import zlib

        import numpy as np
        import pyarrow as pa

        # A fixed order, so that a task that runs again packs alike.
        table = table.sort_by([(c, "ascending") for c in ("length", "ids_crc32", "doc_id", "start")])
        lengths = table.column("length").to_numpy()
        found = fill(lengths, *first_fit_decreasing(lengths, capacity), capacity)
        rows, begins, sizes, bins, offsets = (np.array(c, np.int64) for c in zip(*found))
        out = table.select(["doc_id", "start", "ids_crc32", "doc_tokens"]).take(pa.array(rows))
        crc, ids = out.column("ids_crc32").to_numpy().copy(), table.column("ids")
        for k in np.flatnonzero(sizes < lengths[rows]).tolist():
            held = ids[int(rows[k])].as_py()
            values = np.frombuffer(held, "<u2" if held[:1] == b"s" else "<u4", offset=1)
            crc[k] = zlib.crc32(values[begins[k] : begins[k] + sizes[k]].astype("<u4").data)
        return pa.table({
            "doc_id": out.column("doc_id"), "start": out.column("start").to_numpy() + begins, "length": sizes,
            "ids_crc32": crc, "doc_tokens": out.column("doc_tokens"), "bin": bins, "offset": offsets,
            "part": pa.array(np.full(len(rows), table.column("part")[0].as_py()), pa.int64()),
        })

    return run


def pack(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int = 4096, end: int = 2) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; every sequence is full or as long as a power of two.

    Full sequences are cut from the front of a longer document. The rests are dealt at
    random into groups, and each group is packed by itself, so a group of copies or a
    key with many rows is spread like any others. `capacity` is a power of two.

    A null or empty text is its end id alone. Rows that repeat a document are packed
    each for itself; a null key stays null. No rows give no rows.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two, got {capacity}")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(rows.mapInArrow(cutter(tokenizer, capacity, end), RESTS), "rests")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = pieces.where(F.col("ids").isNull()).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rests = pieces.where(F.col("ids").isNotNull())
    groups = max(1, -(-rests.count() // GROUP_ROWS))
    # Dealt by the row's place in a stored table, so that a lost task deals alike.
    dealt = rests.withColumn("part", (F.rand(29) * groups).cast("long"))
    packed = dealt.groupBy("part").applyInArrow(packer(capacity), PLACED + ", part long")
    sequence = (F.col("part") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id")
    return full.unionByName(packed.select(*columns, sequence, "offset"))


def op13_tree_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens without padding."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
