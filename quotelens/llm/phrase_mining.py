"""Phrase collocations: longest windows are counted once, shorter phrases come from them by ROLLUP.

Each word starts one window: itself and, in lead columns, the next words of its piece,
padded with null where the piece ends. Only these windows are counted. A phrase of k words
occurs as often as windows begin with it, so the counts of all shorter phrases are sums over
prefixes, which Spark's ROLLUP gives in one pass; phrases of each length are never exploded.

Windows are counted in two steps. A task counts those of its texts and sends them, sorted and
compressed, to buckets by their first two words. In its bucket a window's count is final, so
one that is too rare for a phrase goes on as its first two words, or its first, and padding.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelens.llm.common import stored

WORDS = ["w1", "w2", "w3"]
BLOCKS = "bucket int, lang string, windows binary"
WINDOWS = "lang string, w1 string, w2 string, w3 string, f long"

#: Words whose windows a task counts at a time. Three codes below this fit in 64 bits.
CHUNK_WORDS = 1_000_000
#: Bytes of text that a task cuts into words at a time, and of text for each bucket.
CHUNK_BYTES, BUCKET_BYTES = 4_000_000, 3_000_000
#: Windows that a bucket's task holds before it merges equal ones.
HELD_WINDOWS = 500_000

BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"


def window_blocks(buckets: int):
    """Texts to the distinct windows of each chunk with their counts: lines `w1 w2 w3 n`, a compressed block a bucket."""
    import zlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    kinds = np.zeros(256, np.uint8)
    kinds[list(BLANKS)], kinds[list(BREAKS)] = 1, 2

    def words_of(texts: list[bytes], langs):
        """All words in lower case (A-Z), with the piece and the language of each."""
        joined = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        kind = kinds[joined]
        inside = kind == 0
        starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
        ends = np.flatnonzero(inside & np.concatenate((~inside[1:], [True]))) + 1
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(
            pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[inside])]
        )
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        return words, piece, langs[np.searchsorted(text_ends, starts, side="right")]

    def lead_columns(words, piece):
        """The words in order, the empty one first, which pads; and the places there of each word and the next two."""
        encoded = words.dictionary_encode()
        order = pc.sort_indices(encoded.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(1, len(order) + 1)
        code = np.concatenate((rank[encoded.indices.to_numpy()], [0, 0]))
        ahead = np.concatenate((piece, [-1, -1]))
        second = np.where(ahead[1:-1] == piece, code[1:-1], 0)
        third = np.where(ahead[2:] == piece, code[2:], 0)
        names = pa.concat_arrays([pa.array([""], pa.string()), encoded.dictionary.take(order)])
        return names, code[:-2], second, third

    def blocks(texts, langs, lang_names) -> Iterator[tuple]:
        words, piece, lang = words_of(texts, langs)
        for at in range(0, len(words), CHUNK_WORDS):
            end = min(at + CHUNK_WORDS, len(words))
            # Two more words, for the windows that begin near the end.
            ahead = min(end + 2, len(words))
            names, first, second, third = lead_columns(words[at:ahead], piece[at:ahead])
            base = len(names)
            key = ((first * base + second) * base + third)[: end - at]
            hashes = np.array([zlib.crc32(w.as_buffer() or b"") for w in names], np.int64)
            for k in np.unique(lang[at:end]):
                found, n = np.unique(key[lang[at:end] == k], return_counts=True)
                pair, w3 = found // base, found % base
                w1, w2 = pair // base, pair % base
                bucket = (hashes[w1] * 31 + hashes[w2] * 17) % 2_147_483_647 % buckets
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                columns = [names.take(pa.array(c[order])) for c in (w1, w2, w3)]
                lines = pc.binary_join_element_wise(*columns, pa.array(n[order]).cast(pa.string()), " ")
                starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                offsets = pa.array(np.concatenate((starts, [len(bucket)])), pa.int32())
                for b, block in zip(bucket[starts].tolist(), pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")):
                    yield b, lang_names[k], packed(block.as_buffer())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, names, size = [], [], {}, 0

        def sent():
            columns = list(zip(*blocks(texts, np.array(langs), list(names)))) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.binary()))],
                names=["bucket", "lang", "windows"],
            )

        for batch in batches:
            for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
                texts.append(text)
                langs.append(names.setdefault(lang, len(names)))
                size += len(text) + 1
                if size >= CHUNK_BYTES:
                    yield sent()
                    texts, langs, size = [], [], 0
        if texts:
            yield sent()
        # The worker waits for its next task with what it holds.
        pa.default_memory_pool().release_unused()

    return run


def window_merger(least: int):
    """Sorted blocks to the windows of each bucket and language; what is too rare for a phrase is padded.

    A window of three words that occurs less than `least` times adds to the row of its
    first two, and two words that do so add to the row of the first.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def lines_of(blocks):
        """Windows `w1 w2 w3` and counts of blocks."""
        lines = pc.split_pattern(pa.array([unpacked(b) for b in blocks]).cast(pa.string()), "\n").flatten()
        halves = pc.split_pattern(lines, " ", max_splits=1, reverse=True).flatten()
        even = np.arange(0, len(halves), 2)
        return halves.take(pa.array(even)), halves.take(pa.array(even + 1)).cast(pa.int64()).to_numpy()

    def merged(parts):
        """One row for each window, its counts added up."""
        windows = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
        n = np.concatenate([p[1] for p in parts])
        total = np.zeros(len(windows.dictionary), np.int64)
        np.add.at(total, windows.indices.to_numpy(), n)
        return windows.dictionary, total

    def added(keys, n):
        """Distinct keys, in order, with the sums of n."""
        found, at = np.unique(keys, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, at, n)
        return found, total

    def final(lang, parts):
        windows, f = merged(parts)
        words = pc.split_pattern(windows, " ").flatten().dictionary_encode()
        names, codes = words.dictionary, words.indices.to_numpy().astype(np.int64).reshape(-1, 3)
        empty = pc.index(names, "").as_py()
        base = len(names)
        pairs = codes[:, 0] * base + codes[:, 1]
        whole = (f >= least) & (codes[:, 2] != empty)
        pair, pair_total = added(pairs, f)
        often = (pair_total >= least) & (pair % base != empty)
        # What windows of their own leave to their pair, and pairs to their word.
        rest_at, rest = added(pairs[~whole], f[~whole])
        stays = often[np.searchsorted(pair, rest_at)]
        single, single_rest = added(rest_at[~stays] // base, rest[~stays])
        none = np.full(len(single), empty)
        columns = [
            np.concatenate((codes[whole, 0], rest_at[stays] // base, single)),
            np.concatenate((codes[whole, 1], rest_at[stays] % base, none)),
            np.concatenate((codes[whole, 2], np.full(int(stays.sum()), empty), none)),
        ]
        arrays = [names.take(pa.array(c, mask=c == empty)) for c in columns]
        n = pa.array(np.concatenate((f[whole], rest[stays], single_rest)))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *arrays, n], names=["lang", *WORDS, "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, held = None, [], 0
        for batch in batches:
            for b, lang, block in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "windows"))):
                if key is not None and key != (b, lang):
                    yield final(key[1], parts)
                    parts, held = [], 0
                key = (b, lang)
                parts.append(lines_of([block]))
                held += len(parts[-1][1])
                if held > HELD_WINDOWS:
                    parts = [merged(parts)]
                    held = 0
        if key is not None:
            yield final(key[1], parts)
        parts = []
        pa.default_memory_pool().release_unused()

    return run


def packed(data) -> bytes:
    """Compressed bytes after their number."""
    import pyarrow as pa

    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    import pyarrow as pa

    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def count_windows(docs: DataFrame, text: str, lang: str, least: int) -> DataFrame:
    """(lang, w1, w2, w3, f): windows with their counts, null words where they are padded.

    Rows of one window add up; rare ones are padded further, so that each prefix still
    has the sum that all its windows have.
    """
    rows = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, min(2_000_000_000, -(-size // BUCKET_BYTES)))
    blocks = rows.mapInArrow(window_blocks(buckets), BLOCKS)
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket", "lang")
    return dealt.mapInArrow(window_merger(least), WINDOWS)


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """(lang, words, w1, w2, w3, f) of the phrases that occur `least` times, and each language's words at `words` 0.

    ROLLUP sums the windows over their prefixes: three words, two, one, none.
    """
    windows.createOrReplaceTempView("quotelens_windows")
    counts = windows.sparkSession.sql("""
        SELECT lang, 3 - grouping(w1) - grouping(w2) - grouping(w3) AS words, w1, w2, w3, sum(f) AS f
        FROM quotelens_windows GROUP BY lang, ROLLUP (w1, w2, w3)
    """)
    windows.sparkSession.catalog.dropTempView("quotelens_windows")
    # A group whose last word is padding is no phrase.
    ends = "words = 1 OR words = 2 AND w2 IS NOT NULL OR w3 IS NOT NULL"
    return counts.where(f"words = 0 OR f >= {least} AND ({ends})")


def millionths(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    return F.expr(
        f"CAST(1000000 * CAST({a} AS DECIMAL(15, 0)) * CAST({a} AS DECIMAL(15, 0)) AS DECIMAL(38, 0))"
        f" div (CAST({left} AS DECIMAL(18, 0)) * CAST({right} AS DECIMAL(18, 0)))"
    )


def scored(counts: DataFrame) -> DataFrame:
    """(lang, words, w1, w2, w3, a, l, r, score) of all candidates; the lowest cut counts, ties to the first."""

    def level(words: int, names: list[str], value: str) -> DataFrame:
        kept = counts.where(F.col("words") == words)
        return kept.select("lang", *[F.col(w).alias(n) for w, n in zip(WORDS, names)], F.col("f").alias(value))

    # A part of a phrase occurs at least as often as the phrase, so every count looked up is there.
    pairs = (
        level(2, ["w1", "w2"], "a").join(level(1, ["w1"], "l"), ["lang", "w1"]).join(level(1, ["w2"], "r"), ["lang", "w2"])
        .select("lang", F.lit(2).alias("words"), "w1", "w2", F.lit(None).cast("string").alias("w3"), "a", "l", "r",
                millionths("a", "l", "r").alias("score"))
    )
    triples = (
        level(3, WORDS, "a")
        .join(level(1, ["w1"], "l1"), ["lang", "w1"]).join(level(2, ["w2", "w3"], "r1"), ["lang", "w2", "w3"])
        .join(level(2, ["w1", "w2"], "l2"), ["lang", "w1", "w2"]).join(level(1, ["w3"], "r2"), ["lang", "w3"])
        .withColumns({"s1": millionths("a", "l1", "r1"), "s2": millionths("a", "l2", "r2")})
    )
    first = F.col("s1") <= F.col("s2")
    triples = triples.select(
        "lang", F.lit(3).alias("words"), *WORDS, "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    return pairs.unionByName(triples)


def without_contained(candidates: DataFrame) -> DataFrame:
    """Candidates less the pairs that mostly occur inside one longer candidate."""
    longer = candidates.where("words = 3")
    inside = longer.select("lang", "w1", "w2", "a").unionByName(
        longer.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    most = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest"), F.lit(2).alias("words"))
    joined = candidates.join(most, ["lang", "words", "w1", "w2"], "left")
    # Counts below 10^16 keep these products within 64 bits.
    return joined.where("longest IS NULL OR 100 * longest < 50 * a").drop("longest")


def mine_phrases(docs: DataFrame, text: str, lang: str, least: int = 10, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the leading phrases of two and three words per language.

    A null text is empty, a null language `und`. Repeated rows count each time. Equal
    scores go by the count and then by the phrase's bytes, so no ties are left. No rows,
    or no phrase often enough, give no rows.
    """
    counts = stored(phrase_counts(count_windows(docs, text, lang, least), least), "phrases")
    kept = without_contained(stored(scored(counts), "candidates"))
    kept = kept.withColumn("phrase", F.concat_ws(" ", *WORDS))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The leaders of each of many parts of a language, and of those the leaders: no task holds a language whole.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    leaders = kept.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ).where(F.col("rank") <= top)
    ranked = leaders.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11_phrase_mining(spark, sf_dir: str) -> DataFrame:
    """The 2,000 leading phrases of each language among all documents."""
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", "lang")
