"""Brown class-based bigram model: exchange clustering, class transitions and word emissions.

Texts are cut into words once. A task turns its texts into blocks: a word list and the
places there of all words, text after text, training texts first, with the place behind
the list as the end of each text. Words are dealt into buckets by their crc32, and a block
lists its words by bucket; so a bucket and a block tell each other about their words by
bytes in that order, and no list of all words ever reaches one task.

Words that make up at least 1 / CLUSTERED of all tokens, a list whose bound does not
depend on the corpus, are clustered first, beside classes of the other words' forms
(length and last character). Then all words that are met again in training, however
rare, are offered every class, those of the forms too, by the buckets in turn. A word
met once would be unknown without the one text it is in: like the words that are not
met at all it has the class of its form, whose counts are those of such words.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import shared_folder, stored

#: Words of at least this share (one in ...) of the tokens are clustered before all others join them.
CLUSTERED = 10_000
CLASSES = 48
FORMS = 12
#: All classes: the words', that of the end, those that begin as the forms'.
SIZE = CLASSES + 1 + FORMS
#: Cells of a word's contexts: the classes that follow, those that precede, the word after itself.
CELLS = 2 * SIZE + 1
#: Parts of the frequent words that move in turn, and of the buckets of all words.
PARTS = 6
BUCKET_PARTS = 3
#: Words that occur less often in training have the class of their form.
MET_AGAIN = 2
#: A turn gains if the objective grows by more than this part of itself; smaller changes are rounding.
GAIN = 1e-9
#: The clustering of all words has converged if a turn of every part makes the objective grow by no more than this part of itself.
CONVERGED = 1e-3
BLOCK_TOKENS = 1_500_000
#: Weight, in tokens, of the overall class distribution in each class's transitions; and added to each emission count.
TRANSITION_PRIOR = 20.0
EMISSION_PRIOR = 1.0

BLOCKS = (
    "block long, doc_id array<long>, held_out array<boolean>, trained long, places binary, words binary,"
    " n_train binary, buckets array<int>, sizes array<int>"
)
LISTS = "bucket int, block long, words binary, n_train binary"
MEMBERS = "bucket int, words binary, n_train binary, blocks array<long>, sizes array<int>, at binary"
STATE = "bucket int, own binary, to binary, gain binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def packed(data: bytes, width: int = 1) -> bytes:
    """Bytes compressed plane by plane (all first bytes of `width`-byte numbers, then all second ones), after their number."""
    import numpy as np
    import pyarrow as pa

    planes = np.frombuffer(data, np.uint8).reshape(-1, width).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, width: int = 1) -> bytes:
    import numpy as np
    import pyarrow as pa

    size = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, -1).T.tobytes()


def numbers_of(data: bytes):
    import numpy as np

    return np.frombuffer(unpacked(data, 4), "<i4")


def words_of(data: bytes) -> list[bytes]:
    joined = unpacked(data)
    return joined.split(b" ") if joined else []


def is_held_out(key) -> F.Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def form_class(word: bytes) -> int:
    """0 to FORMS - 1, by length and last character."""
    last = word[-1:]
    kind = 0 if last.isalpha() or last >= b"\x80" else 1 if last.isdigit() else 2
    size = len(word)
    return 4 * kind + (0 if size <= 5 else 1 if size <= 9 else 2 if size <= 14 else 3)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """`df` as a table in the shared folder, in files by `key`: joins on it read the table without a shuffle."""
    name = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def block_maker(buckets: int):
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    def row(number, docs, held, texts):
        order = sorted(range(len(docs)), key=held.__getitem__)
        docs, held, texts = ([x[i] for i in order] for x in (docs, held, texts))
        flat = [w for t in texts for w in t]
        place = dict.fromkeys(flat)
        listed = list(place)
        bucket = np.fromiter(map(zlib.crc32, listed), np.int64, len(listed)) % buckets
        listed = [listed[i] for i in np.argsort(bucket, kind="stable").tolist()]
        for i, w in enumerate(listed):
            place[w] = i
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1
        places = np.full(len(flat) + len(texts), len(place), "<i4")
        inner = np.ones(len(places), bool)
        inner[ends] = False
        places[inner] = np.fromiter(map(place.__getitem__, flat), np.int32, len(flat))
        known = len(held) - sum(held)
        trained = int(ends[known - 1]) + 1 if known else 0
        n_train = np.bincount(places[:trained], minlength=len(place) + 1)[:-1].astype("<i4")
        found, sizes = np.unique(bucket, return_counts=True)
        block = (TaskContext.get().partitionId() << 32) + number
        values = [block, docs, held, trained, packed(places.tobytes(), 4), packed(b" ".join(listed)),
                  packed(n_train.tobytes(), 4), found, sizes]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int64(), *[pa.binary()] * 3, *[pa.list_(pa.int32())] * 2]
        names = ["block", "doc_id", "held_out", "trained", "places", "words", "n_train", "buckets", "sizes"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, docs, held, texts = 0, 0, [], [], []
        for batch in batches:
            columns = batch.column("doc_id"), batch.column("held_out"), batch.column("text").cast(pa.binary())
            for doc, out, text in zip(*(c.to_pylist() for c in columns)):
                docs.append(doc), held.append(out), texts.append((text or b"").lower().split())
                size += len(texts[-1])
                if size >= BLOCK_TOKENS:
                    yield row(number, docs, held, texts)
                    number, size, docs, held, texts = number + 1, 0, [], [], []
        if docs:
            yield row(number, docs, held, texts)

    return run


def word_lists(batches):
    """One row per block and bucket: the block's words there and how often each occurs in training."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        columns = ("block", "words", "n_train", "buckets", "sizes")
        for block, words, n_train, buckets, sizes in zip(*(batch.column(c).to_pylist() for c in columns)):
            words, n_train, ends = words_of(words), numbers_of(n_train), np.cumsum(sizes, dtype=np.int64).tolist()
            parts = [slice(end - size, end) for size, end in zip(sizes, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), pa.array([block] * len(buckets), pa.int64()),
                 pa.array([packed(b" ".join(words[p])) for p in parts], pa.binary()),
                 pa.array([packed(n_train[p].tobytes(), 4) for p in parts], pa.binary())],
                names=["bucket", "block", "words", "n_train"],
            )


def member_maker(table):
    """A bucket's words and their counts, and for each block the places there of its words."""
    import numpy as np
    import pyarrow as pa

    lists = [words_of(w) for w in table.column("words").to_pylist()]
    flat = [w for listed in lists for w in listed]
    place = {w: i for i, w in enumerate(sorted(set(flat)))}
    at = np.fromiter(map(place.__getitem__, flat), np.int32, len(flat))
    n_train = np.zeros(len(place), "<i8")
    np.add.at(n_train, at, np.concatenate([numbers_of(n) for n in table.column("n_train").to_pylist()]))
    values = [packed(b" ".join(place)), packed(n_train.tobytes(), 8), table.column("block").to_pylist(), list(map(len, lists)), packed(at.astype("<i4").tobytes(), 4)]
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    return pa.table([table.column("bucket").slice(0, 1), *(pa.array([v], k) for v, k in zip(values, kinds))],
                    names=["bucket", "words", "n_train", "blocks", "sizes", "at"])


def counts_of(data: bytes):
    import numpy as np

    return np.frombuffer(unpacked(data, 8), "<i8")


def frequent_words(least: float):
    """(word, n) of the words that occur `least` times in training or more; and the number of training words, without a word."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        types = 0
        for batch in batches:
            for words, n in zip(batch.column("words").to_pylist(), map(counts_of, batch.column("n_train").to_pylist())):
                types += int((n > 0).sum())
                if (kept := np.flatnonzero((n > 0) & (n >= least))).size:
                    words = words_of(words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[i] for i in kept.tolist()], pa.binary()), pa.array(n[kept], pa.int64())], names=["word", "n"]
                    )
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([types], pa.int64())], names=["word", "n"])

    return run


def preceding(line, end):
    """What stands before each unit; a text begins after an end."""
    import numpy as np

    return np.concatenate((np.array([end], line.dtype), line[:-1]))


def pair_counter(unit_of: dict[bytes, int], end: int):
    """(prev, next, n) of neighbouring units in the training texts."""
    import numpy as np
    import pyarrow as pa

    width = end + 1 + FORMS

    def run(batches):
        for batch in batches:
            for trained, places, words in zip(*(batch.column(c).to_pylist() for c in ("trained", "places", "words"))):
                listed = words_of(words)
                units = np.array([unit_of.get(w, -1) for w in listed] + [end], np.int64)
                rare = np.flatnonzero(units < 0)
                units[rare] = [end + 1 + form_class(listed[i]) for i in rare.tolist()]
                line = units[numbers_of(places)[:trained]]
                code, n = np.unique(preceding(line, end) * width + line, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code // width, pa.int32()), pa.array(code % width, pa.int32()), pa.array(n, pa.int64())],
                    names=["prev", "next", "n"],
                )

    return run


def contexts(pairs: DataFrame) -> DataFrame:
    """One row per unit: what follows it and what stands before it. At most the units squared in all."""
    right = pairs.select(F.col("prev").alias("unit"), F.lit(True).alias("right"), F.col("next").alias("other"), "n")
    left = pairs.select(F.col("next").alias("unit"), F.lit(False).alias("right"), F.col("prev").alias("other"), "n")
    packed = right.union(left).groupBy("unit").agg(F.collect_list(F.struct("right", "other", "n")).alias("near"))
    return packed.select("unit", "near.right", "near.other", "near.n")


def context_arrays(batch):
    """Units and the number of neighbours of each, then right, other and n of all neighbours."""
    flat = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("right", "other", "n"))
    return batch.column("unit").to_numpy(), batch.column("right").value_lengths().to_numpy(), *flat


def class_matrix(near: DataFrame, classes):
    """Transitions between classes, by summing each task's matrix."""
    import numpy as np

    size = int(classes.max()) + 1

    def run(batches):
        import pyarrow as pa

        sums = np.zeros((size, size), np.int64)
        for batch in batches:
            unit, sizes, right, other, n = context_arrays(batch)
            np.add.at(sums, (np.repeat(classes[unit], sizes)[right], classes[other[right]]), n[right])
        a, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sums[a, b])], names=["a", "b", "n"])

    matrix = np.zeros((size, size), np.int64)
    for a, b, n in near.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n")).collect():
        matrix[a, b] = n
    return matrix


def plogp(x):
    import numpy as np

    return x * np.log(np.maximum(x, 1))


def objective(matrix) -> float:
    """Log likelihood of the training classes, up to a constant."""
    return float(plogp(matrix).sum() - plogp(matrix.sum(axis=1)).sum() - plogp(matrix.sum(axis=0)).sum())


def best_class(matrix, own: int, right, left, loop: int, targets: int) -> tuple[int, float]:
    """The class that a word best moves to, and the gain over its own class.

    `right` and `left` count the classes after and before the word, without `loop`, the
    word after itself.
    """
    import numpy as np

    rest = matrix.astype(np.float64)
    rest[own] -= right
    rest[:, own] -= left
    rest[own, own] -= loop
    # The word's neighbours come back to their rows and columns whatever class it moves to.
    rows, columns = rest.sum(axis=1) + left, rest.sum(axis=0) + right
    t = np.arange(targets)
    gain_row = plogp(rest[t] + right) - plogp(rest[t])
    gain_column = plogp(rest[:, t].T + left) - plogp(rest[:, t].T)
    gain = gain_row.sum(axis=1) - gain_row[t, t] + gain_column.sum(axis=1) - gain_column[t, t]
    gain += plogp(rest[t, t] + right[t] + left[t] + loop) - plogp(rest[t, t])
    out, into = right.sum() + loop, left.sum() + loop
    gain -= plogp(rows[t] + out) - plogp(rows[t]) + plogp(columns[t] + into) - plogp(columns[t])
    best = int(gain.argmax())
    return best, float(gain[best] - gain[own])


def proposed_moves(near: DataFrame, classes, matrix, words: int, sweep: int) -> list[tuple[int, int, float]]:
    """Best moves of one of PARTS parts of the words, each as if it moved alone, with the highest gain first."""
    import numpy as np

    size = len(matrix)

    def run(batches):
        import pyarrow as pa

        units, to, gains = [], [], []
        for batch in batches:
            named, sizes, *flat = context_arrays(batch)
            ends = sizes.cumsum()
            for unit, a, b in zip(named.tolist(), (ends - sizes).tolist(), ends.tolist()):
                right, other, n = (x[a:b] for x in flat)
                same = other == unit
                loop = int(n[same & right].sum())
                sides = [
                    np.bincount(classes[other[side]], weights=n[side], minlength=size) for side in (right & ~same, ~right & ~same)
                ]
                best, gain = best_class(matrix, int(classes[unit]), *sides, loop, CLASSES)
                if best != classes[unit] and gain > 1e-6:
                    units.append(unit), to.append(best), gains.append(gain)
        yield pa.RecordBatch.from_arrays(
            [pa.array(units, pa.int32()), pa.array(to, pa.int32()), pa.array(gains, pa.float64())], names=["unit", "to", "gain"]
        )

    part = F.shiftright(F.col("unit").cast("long") * 40503, 4) % PARTS
    turn = near.where((F.col("unit") < words) & (part == sweep % PARTS))
    moves = turn.mapInArrow(run, "unit int, to int, gain double").collect()  # at most the clustered words
    return sorted((tuple(r) for r in moves), key=lambda m: (-m[2], m[0]))


def exchange(near: DataFrame, words: int):
    """Class of every unit and the transitions: words by rank first, then turns of the parts until none gains.

    The end has a class of its own after the words' CLASSES, then come the forms'.
    """
    import numpy as np

    classes = np.concatenate((np.arange(words) % CLASSES, CLASSES + np.arange(1 + FORMS)))
    matrix = class_matrix(near, classes)
    best = objective(matrix)
    idle = sweep = 0
    while idle < PARTS:
        moves, gained = proposed_moves(near, classes, matrix, words, sweep), False
        # Words that move at once may get in each other's way: then only the better half of them moves.
        while moves and not gained:
            moved = classes.copy()
            for unit, to, _ in moves:
                moved[unit] = to
            after = class_matrix(near, moved)
            gained = objective(after) > best + GAIN * abs(best)
            if gained:
                classes, matrix, best = moved, after, objective(after)
            moves = moves[: len(moves) // 2]
        idle = 0 if gained else idle + 1
        sweep += 1
    return classes, matrix


def first_classes(class_of: dict[bytes, int]):
    """The state that the clustering of all words begins with: classes of the frequent words, forms of the others."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for bucket, words in zip(batch.column("bucket").to_pylist(), map(words_of, batch.column("words").to_pylist())):
                own = np.array([class_of[w] if w in class_of else CLASSES + 1 + form_class(w) for w in words], np.uint8)
                yield state_row(bucket, own, own, np.zeros(len(own)))

    return run


def state_row(bucket: int, own, to, gain):
    """Classes of a bucket's words, the classes they best move to and what each gains alone."""
    import pyarrow as pa

    values = [packed(own.tobytes()), packed(to.astype("u1").tobytes()), packed(gain.astype("<f4").tobytes(), 4)]
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], names=["bucket", "own", "to", "gain"]
    )


def classes_after(bucket: int, own: bytes, to: bytes, gain: bytes, limit: float, share: float):
    """Classes of a bucket's words when those that gain `limit` or more, or an even `share` of them, have moved."""
    import numpy as np

    own, to, gain = np.frombuffer(unpacked(own), "u1"), np.frombuffer(unpacked(to), "u1"), np.frombuffer(unpacked(gain, 4), "<f4")
    # Multiples of the golden ratio fall evenly.
    spread = ((np.arange(len(own)) + 1) * 0.6180339887498949 + bucket * 0.7548776662466927) % 1
    return np.where((gain >= limit) & (spread < share), to, own)


def label_lists(moved: tuple[float, float], counted: bool):
    """(block, bucket, classes, counts) of the words that a block has in a bucket; counts only if asked for."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            columns = ("bucket", "blocks", "sizes", "at", "n_train", "own", "to", "gain")
            for bucket, blocks, sizes, at, n_train, *state in zip(*(batch.column(c).to_pylist() for c in columns)):
                at, ends = numbers_of(at), np.cumsum(sizes, dtype=np.int64).tolist()
                classes, n = classes_after(bucket, *state, *moved)[at], counts_of(n_train)[at] if counted else None
                parts = [slice(end - size, end) for size, end in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks, pa.int64()), pa.array([bucket] * len(blocks), pa.int32()),
                     pa.array([classes[p].tobytes() for p in parts], pa.binary()),
                     pa.array([packed(n[p].tobytes(), 8) if counted else None for p in parts], pa.binary())],
                    names=["block", "bucket", "classes", "counts"],
                )

    return run


def labelled(blocks: DataFrame, members: DataFrame, state: DataFrame, moved: tuple[float, float], parts: int, counted: bool = False) -> DataFrame:
    """Blocks with the classes of their words, one item a bucket; `moved` is the limit and share of the state's moves that are made."""
    known = members.select("bucket", "blocks", "sizes", "at", "n_train").join(state.hint("shuffle_hash"), "bucket")
    lists = known.mapInArrow(label_lists(moved, counted), "block long, bucket int, classes binary, counts binary")
    by_block = lists.repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("bucket", "classes", "counts")).alias("labels"))
    return blocks.join(by_block.hint("shuffle_hash"), "block", "left")


def label_arrays(labels, kind: str, end: int):
    """Classes or counts of a block's words in the order of its list, then that of the end."""
    import numpy as np

    found = [x[kind] for x in sorted(labels or (), key=lambda x: x["bucket"])]
    if kind == "classes":
        return np.frombuffer(b"".join(found) + bytes([end]), "u1").astype(np.int32)
    return np.concatenate([*map(counts_of, found), np.array([end], np.int64)])


def transition_sums(batches):
    """(a, b, n) of neighbouring classes in the training texts."""
    import numpy as np
    import pyarrow as pa

    sums = np.zeros(SIZE * SIZE, np.int64)
    for batch in batches:
        for trained, places, labels in zip(*(batch.column(c).to_pylist() for c in ("trained", "places", "labels"))):
            line = label_arrays(labels, "classes", CLASSES)[numbers_of(places)[:trained]]
            sums += np.bincount(preceding(line, CLASSES) * np.int32(SIZE) + line, minlength=SIZE * SIZE)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at // SIZE), pa.array(at % SIZE), pa.array(sums[at])], names=["a", "b", "n"])


def transitions(texts: DataFrame):
    """Transitions between the classes of labelled blocks."""
    import numpy as np

    matrix = np.zeros((SIZE, SIZE), np.int64)
    near = texts.select("trained", "places", "labels").mapInArrow(transition_sums, "a long, b long, n long")
    for a, b, n in near.groupBy("a", "b").agg(F.sum("n")).collect():
        matrix[a, b] = n
    return matrix


def word_contexts(part: int):
    """One row per block and bucket of the part: how often each class follows and precedes each of the words.

    A code is the word's place among the block's in the bucket times CELLS, plus the cell: the class
    that follows, SIZE and the class before, or the last for the word after itself. Codes are sorted
    and given by their steps.
    """
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            columns = ("block", "trained", "places", "buckets", "sizes", "labels")
            for block, trained, places, buckets, sizes, labels in zip(*(batch.column(c).to_pylist() for c in columns)):
                words = numbers_of(places)[:trained]
                line = label_arrays(labels, "classes", CLASSES)[words]
                buckets, sizes = np.array(buckets, np.int64), np.array(sizes, np.int64)
                turn = buckets % BUCKET_PARTS == part
                # Ends do not move.
                at = np.flatnonzero(np.append(np.repeat(turn, sizes), False)[words])
                width = np.int32 if (len(turn) and sizes.sum() * CELLS < 2**31) else np.int64
                base = words[at].astype(width) * width(CELLS)
                # An end follows every text, so no word is last.
                follows = np.where(words[at + 1] == words[at], 2 * SIZE, line[at + 1]).astype(width)
                precedes, other = preceding(line, CLASSES)[at].astype(width) + width(SIZE), preceding(words, -1)[at] != words[at]
                code, n = np.unique(np.concatenate((base + follows, (base + precedes)[other])), return_counts=True)
                ends = np.cumsum(sizes)
                for bucket, size, end in zip(buckets[turn].tolist(), sizes[turn].tolist(), ends[turn].tolist()):
                    first = (end - size) * CELLS
                    a, b = np.searchsorted(code, [first, end * CELLS])
                    if a < b:
                        steps = np.diff(code[a:b].astype(np.int64), prepend=first).astype("<i4")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([bucket], pa.int32()), pa.array([block], pa.int64()),
                             pa.array([packed(steps.tobytes(), 4)], pa.binary()), pa.array([packed(n[a:b].astype("<i4").tobytes(), 4)], pa.binary())],
                            names=["bucket", "block", "steps", "n"],
                        )

    return run


def best_classes(word, cell, n, own, count, matrix):
    """`best_class` for many words: the classes that they best move to and the gains, each as if it moved alone.

    Rows count the `cell`s of the words' contexts and are sorted by word. `own` and `count`
    have an item for each of the words.
    """
    import numpy as np

    # A word after itself adds to the cell of the class that it moves to, see below.
    base, cells = np.concatenate((matrix.T, matrix, np.zeros((1, SIZE)))).astype(np.float64), matrix.astype(np.float64)
    diagonal = cells.diagonal()
    logs = plogp(base)
    few = np.stack([plogp(base + k) - logs for k in range(1, 9)])
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    # Rows in slices of whole words.
    cuts = np.unique(np.append(starts[np.searchsorted(starts, np.arange(0, len(word), 50_000), "right") - 1], len(word))) if len(word) else []
    to, gains = own.astype(np.int64), np.zeros(len(own))
    for a, b in zip(cuts[:-1], cuts[1:]):
        first = starts[np.searchsorted(starts, a):np.searchsorted(starts, b)]
        named = word[first]
        w, c, k, mine = word[a:b], cell[a:b], n[a:b], own[word[a:b]].astype(np.int64)
        gain = few[np.minimum(k, 8) - 1, c]
        if len(many := np.flatnonzero(k > 8)):
            gain[many] = plogp(base[c[many]] + k[many, None]) - logs[c[many]]
        gain[np.arange(len(w)), mine] = logs[c, mine] - plogp(np.maximum(base[c, mine] - k, 0))
        gain[c == 2 * SIZE] = 0
        total = np.add.reduceat(gain, first - a, axis=0)
        sides = np.zeros((len(named), CELLS))
        sides[np.repeat(np.arange(len(named)), np.diff(np.append(first, b))), c] = k
        right, left, loop = sides[:, :SIZE], sides[:, SIZE:-1], sides[:, -1:]
        at, mine, times = np.arange(len(named)), own[named].astype(np.int64), count[named].astype(np.float64)
        for sums in (matrix.sum(axis=1).astype(np.float64), matrix.sum(axis=0).astype(np.float64)):
            loss = plogp(sums + times[:, None]) - plogp(sums)
            loss[at, mine] = plogp(sums[mine]) - plogp(np.maximum(sums[mine] - times, 0))
            total -= loss
        # A class before and after itself is one cell, not two.
        both = plogp(diagonal + right + left + loop) + plogp(diagonal) - plogp(diagonal + right) - plogp(diagonal + left)
        r, l, d = right[at, mine], left[at, mine], diagonal[mine]
        both[at, mine] = plogp(np.maximum(d - r, 0)) + plogp(np.maximum(d - l, 0)) - plogp(d) - plogp(np.maximum(d - r - l - loop[:, 0], 0))
        # Where the word leaves its own class, the cells of that class with others lose what it took there.
        for near, far, between in ((r, left, cells[:, mine].T), (l, right, cells[mine])):
            some = np.flatnonzero(near)
            m, x, f = between[some], near[some, None], np.maximum(between[some] - far[some], 0)
            change = plogp(f + x) - plogp(f) - plogp(m + x) + plogp(m)
            change[np.arange(len(some)), mine[some]] = 0
            both[some] += change
        total += both
        total[:, CLASSES] = -np.inf
        to[named] = total.argmax(axis=1)
        gains[named] = total.max(axis=1) - total[at, mine]
    moves = (to != own) & (gains > 1e-6) & (count >= MET_AGAIN)
    return np.where(moves, to, own), np.where(moves, gains, 0.0)


def mover(moved: tuple[float, float], matrix):
    """The state of a bucket after the last moves, with the best next moves where there are contexts."""
    import numpy as np
    import pyarrow as pa

    def run(near: pa.Table, known: pa.Table) -> pa.Table:
        row = known.to_pylist()[0]
        own = classes_after(row["bucket"], row["own"], row["to"], row["gain"], *moved)
        starts = dict(zip(row["blocks"], (np.cumsum(row["sizes"], dtype=np.int64) - row["sizes"]).tolist()))
        at, codes, counts = numbers_of(row["at"]).astype(np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for block, steps, n in zip(*(near.column(c).to_pylist() for c in ("block", "steps", "n"))):
            code = np.cumsum(numbers_of(steps), dtype=np.int64)
            codes.append(at[starts[block] + code // CELLS] * CELLS + code % CELLS)
            counts.append(numbers_of(n).astype(np.int64))
        code, n = np.concatenate(codes), np.concatenate(counts)
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        code, n = code[first], np.add.reduceat(n, first) if len(first) else n
        to, gain = best_classes(code // CELLS, code % CELLS, n, own, counts_of(row["n_train"]), matrix)
        return pa.Table.from_batches([state_row(row["bucket"], own, to, gain)])

    return run


#: Bins of gains a doubling.
BINS = 16


def gain_bins(batches):
    """(bin, n): how many words gain 2 ** (bin / BINS) or more, but less than the next bin's."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for gain in batch.column("gain").to_pylist():
            gain = np.frombuffer(unpacked(gain, 4), "<f4")
            at, n = np.unique(np.floor(np.log2(gain[gain > 0].astype(np.float64)) * BINS).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["bin", "n"])


def better_half(bins: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The highest bins that hold at most half of the words; the highest alone if it holds more."""
    half, kept = sum(n for _, n in bins) / 2, []
    for b, n in sorted(bins, reverse=True):
        if kept and n > half:
            break
        half -= n
        kept.append((b, n))
    return kept if len(kept) < len(bins) else kept[:-1]


def exchange_all(blocks: DataFrame, members: DataFrame, state: DataFrame, buckets: int, parts: int):
    """State and moves that name the class of every word, and the transitions: turns of the parts of all buckets until converged."""
    moved, turn = (math.inf, 1.0), 0
    matrix = transitions(labelled(blocks, members, state, moved, parts))
    best = begun = objective(matrix)
    while True:
        part = turn % BUCKET_PARTS
        near = labelled(blocks, members, state, moved, parts).mapInArrow(word_contexts(part), "bucket int, block long, steps binary, n binary")
        known = members.select("bucket", "blocks", "sizes", "at", "n_train").join(state.hint("shuffle_hash"), "bucket")
        moves = near.repartition(buckets, "bucket").groupBy("bucket").cogroup(known.groupBy("bucket"))
        after_moves = stored(moves.applyInArrow(mover(moved, matrix), STATE), "state")
        found = after_moves.select("gain").mapInArrow(gain_bins, "bin long, n long").groupBy("bin").agg(F.sum("n"))
        bins, share, gained = [tuple(r) for r in found.collect()], 1.0, False  # at most some hundreds
        # As in `exchange`, the better half of the words moves if all of them get in each other's way; of equal ones any half.
        while share * sum(n for _, n in bins) >= 1 and not gained:
            trial = (2.0 ** (min(bins)[0] / BINS) * (1 - 1e-9), share)
            after = transitions(labelled(blocks, members, after_moves, trial, parts))
            gained = objective(after) > best + GAIN * abs(best)
            if gained:
                state, moved, matrix, best = after_moves, trial, after, objective(after)
            bins, share = (better_half(bins), share) if len(bins) > 1 else (bins, share / 2)
        turn += 1
        if turn % BUCKET_PARTS == 0:
            if best - begun <= CONVERGED * abs(best):
                return state, moved, matrix
            begun = best


def class_sums(moved: tuple[float, float]):
    """(class, tokens, words) of the training words."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for n, *state in zip(*(batch.column(c).to_pylist() for c in ("n_train", "bucket", "own", "to", "gain"))):
                n, classes = counts_of(n), classes_after(*state, *moved)
                tokens = np.zeros(SIZE, np.int64)
                np.add.at(tokens, classes, n)
                words = np.bincount(classes[n > 0], minlength=SIZE)
                yield pa.RecordBatch.from_arrays([pa.array(range(SIZE)), pa.array(tokens), pa.array(words)], names=["class", "tokens", "words"])

    return run


def scorer(sums, matrix, ends: int, tokens: int, types: int):
    """Scores of a block's texts. `sums` has (tokens, words) of each class, `ends` the training texts."""
    import numpy as np
    import pyarrow as pa

    by_class = matrix.sum(axis=0) + 1.0
    overall = by_class / by_class.sum()
    transition = np.log10(
        (matrix + TRANSITION_PRIOR * overall) / (matrix.sum(axis=1, keepdims=True) + TRANSITION_PRIOR)
    )
    # Tokens and words of each class, for emissions; a form has room for one word it has not met.
    class_tokens, class_words = np.array(sums, np.float64).T
    class_words[CLASSES + 1:] += 1
    room = np.log10(np.maximum(class_tokens + EMISSION_PRIOR * class_words, 1e-300))
    base_room = math.log10(tokens + types + 1)

    def run(batches):
        for batch in batches:
            columns = ("doc_id", "held_out", "places", "labels")
            for doc, held, places, labels in zip(*(batch.column(c).to_pylist() for c in columns)):
                cls, count = label_arrays(labels, "classes", CLASSES), label_arrays(labels, "counts", ends)
                emit = np.log10(count + EMISSION_PRIOR) - room[cls]
                emit[-1] = 0.0
                base = np.log10(count + 1.0) - base_room
                places = numbers_of(places)
                line, at_end = cls[places], np.flatnonzero(places == len(cls) - 1)
                start = np.concatenate(([0], at_end[:-1] + 1))
                scored = (count > 0).astype(np.int64)[places], base[places], emit[places] + transition[preceding(line, CLASSES), line]
                scores = [np.add.reduceat(x, start) for x in scored]
                values = [doc, held, at_end - start + 1, scores[0], np.full(len(doc), tokens, np.int64), *scores[1:]]
                kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
                names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    return run


def score_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Scores of every row by a model of the rows that are not held out.

    A null text is empty: its only token is the end. A null key counts as the empty
    string for holding out. Rows that repeat count as often as they occur. Without
    training rows every word is unknown.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), is_held_out(F.col(key)).alias("held_out"), F.col(text).alias("text")
    )
    parts = max(1, rows.rdd.getNumPartitions())
    buckets = max(2 * parts, 2 * BUCKET_PARTS)
    blocks = bucketed(rows.mapInArrow(block_maker(buckets), BLOCKS), "blocks", "block", parts)
    lists = blocks.select("block", "words", "n_train", "buckets", "sizes").mapInArrow(word_lists, LISTS)
    members = bucketed(lists.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(member_maker, MEMBERS), "members", "bucket", buckets)
    ends, tokens = blocks.agg(
        F.coalesce(F.sum(F.expr("size(filter(held_out, x -> not x))")), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0))
    ).first()
    # At most CLUSTERED words make up this share.
    found = members.select("words", "n_train").mapInArrow(frequent_words(tokens / CLUSTERED), "word binary, n long").collect()
    types = sum(r.n for r in found if r.word is None) + (ends > 0)
    clustered = [w for w, _ in sorted(((bytes(r.word), r.n) for r in found if r.word is not None), key=lambda x: (-x[1], x[0]))]
    unit_of = {w: i for i, w in enumerate(clustered)}
    pairs = blocks.select("trained", "places", "words").mapInArrow(
        pair_counter(unit_of, len(unit_of)), "prev int, next int, n long"
    )
    near = stored(contexts(pairs.groupBy("prev", "next").agg(F.sum("n").alias("n"))), "contexts")
    classes, _ = exchange(near, len(unit_of))
    state = stored(members.select("bucket", "words").mapInArrow(first_classes({w: int(classes[i]) for w, i in unit_of.items()}), STATE), "state")
    state, moved, matrix = exchange_all(blocks, members, state, buckets, parts)
    known = members.select("bucket", "n_train").join(state, "bucket")
    sums = [(0, 0)] * SIZE
    for c, n, v in known.mapInArrow(class_sums(moved), "class long, tokens long, words long").groupBy("class").agg(F.sum("tokens"), F.sum("words")).collect():
        sums[c] = (n, v)
    texts = labelled(blocks, members, state, moved, parts, counted=True).select("doc_id", "held_out", "places", "labels")
    return texts.mapInArrow(scorer(sums, matrix, ends, tokens, types), SCORES)


def op2_brown_lm(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of six sevenths of them."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
