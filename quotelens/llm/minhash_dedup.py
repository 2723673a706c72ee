"""Near-duplicate detection: banded MinHash candidates, sequential Bayesian pruning, exact verification.

Signatures find pairs that may be alike, and a Bayesian test drops those that almost
surely are not: it looks at a signature batch by batch and stops as soon as the
posterior probability of a similar pair is below the miss probability. Survivors are
compared on their full shingle sets, so no link is wrong.

Texts with the same word sequence are one class and enter once. A bucket of many
classes never gives all its pairs: its classes are first compared with one of them,
and only what is not yet connected is compared further, in blocks of bounded size.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import components, forest, give_back, in_slices, stored
from quotelens.llm.tokenizing import forget
from quotelens.operators.joins import lookup_join

SHINGLE = 5
THRESHOLD = (75, 100)
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Values of a signature that the Bayesian test takes at a time.
BATCH = 32
#: Posterior probability of a similar pair below which it is dropped. At a similarity of
#: 0.75 the bands miss a pair with (1 - 0.75^4)^32 = 5e-6, each batch with about this.
MISS = 1e-6
#: Buckets of so few classes give all their pairs; larger ones go by a pivot and blocks.
SMALL_BUCKET = 12
BLOCK = 512

SKETCH = "doc_id long, text_digest binary, n_shingles long, digest binary, signature binary, bands array<long>"


def normalised(text: bytes) -> bytes:
    """Words in lower case (A-Z), one space after each."""
    return b"".join([w + b" " for w in text.lower().split()])


def held() -> dict:
    """What this process has worked out before. It hangs on a module that every process has, so functions travel without it."""
    return sys.__dict__.setdefault("_quotelens_minhash", {})


def tables():
    """Random constants of the hash functions."""
    import numpy as np

    if "tables" in held():
        return held()["tables"]
    random = np.random.Generator(np.random.PCG64(20240229))
    byte = random.integers(1, 2**63, 256, np.uint64)
    scale = random.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
    shift = random.integers(0, 2**32, HASHES, np.uint32)
    mix = random.integers(0, 2**62, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    held()["tables"] = byte, scale, shift, mix
    return held()["tables"]


#: Shingles of a very long text that are hashed at a time.
CHUNK_WORDS = 20_000

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def powers(n: int):
    """Powers of BASE and of its inverse, modulo 2^64."""
    import numpy as np

    if "powers" not in held() or held()["powers"].shape[1] < n:
        both = np.ones((2, n), np.uint64)
        both[0, 1:], both[1, 1:] = BASE, INVERSE
        held()["powers"] = np.cumprod(both, axis=1, dtype=np.uint64)
    return held()["powers"]


def shingle_hashes(words: bytes):
    """Distinct 64-bit hashes of the shingles of normalised text, sorted; none for none.

    The bytes of a shingle are hashed as a polynomial, taken from running sums.
    """
    import numpy as np

    data = np.frombuffer(words, np.uint8)
    ends = np.flatnonzero(data == 32)
    if not len(ends):
        return np.empty(0, np.uint64)
    if len(ends) > CHUNK_WORDS + SHINGLE:
        n, at = len(ends) - SHINGLE + 1, np.concatenate(([0], ends + 1))
        parts = [words[at[i] : at[min(i + CHUNK_WORDS, n) + SHINGLE - 1]] for i in range(0, n, CHUNK_WORDS)]
        return np.unique(np.concatenate([shingle_hashes(part) for part in parts]))
    up, down = powers(1 << len(data).bit_length())
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tables()[0][data] * up[: len(data)], dtype=np.uint64)))
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(ends) - SHINGLE + 1)
    first, last = starts[:n], ends[-n:]
    value = (sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return np.unique(value)


def signature(hashes):
    """Smallest value of each hash function over the set, in 16 bits, and a key for each band."""
    import numpy as np

    _, scale, shift, mix = tables()
    high = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(high), 512):
        np.minimum(least, (high[at : at + 512] * scale + shift).min(axis=0), out=least)
    keys = ((least.astype(np.uint64) + np.uint64(1)) * mix).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + np.arange(BANDS, dtype=np.uint64)
    return (least & np.uint32(0xFFFF)).astype("<u2"), keys.view(np.int64)


def sketcher():
    import hashlib

    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in in_slices(batches, "text"):
            sizes, digests, signatures, bands = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = normalised(text or b"")
                hashes = shingle_hashes(words)
                sizes.append(len(hashes))
                if not len(hashes):
                    digests.append(None), signatures.append(None), bands.append(None)
                    continue
                least, keys = signature(hashes)
                digests.append(hashlib.blake2b(words, digest_size=16).digest())
                signatures.append(least.tobytes())
                bands.append(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_digest"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_digest", "n_shingles", "digest", "signature", "bands"],
            )
        give_back()

    return run


def fewest_matches(seen: int) -> int:
    """Matches among `seen` values that keep a pair: the posterior of a similar pair is at least MISS.

    With a uniform prior and m matches the similarity follows Beta(m + 1, seen - m + 1),
    which exceeds t with the probability that seen + 1 throws of t give at most m.
    """
    t, below = THRESHOLD[0] / THRESHOLD[1], 0.0
    for m in range(seen + 1):
        below += math.comb(seen + 1, m) * t**m * (1 - t) ** (seen + 1 - m)
        if below >= MISS:
            return m
    return seen


def may_be_similar(one, others):
    """For each row of `others` (signatures), whether it survives every batch against `one`."""
    import numpy as np

    alive, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for at in range(0, HASHES, BATCH):
        matches = matches + (others[alive, at : at + BATCH] == one[at : at + BATCH]).sum(axis=1)
        keep = matches >= fewest_matches(at + BATCH)
        alive, matches = alive[keep], matches[keep]
    return alive


def similar(a, b) -> bool:
    """Whether two shingle sets reach the threshold, in whole numbers."""
    import numpy as np

    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if THRESHOLD[1] * len(small) < THRESHOLD[0] * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return THRESHOLD[1] * both >= THRESHOLD[0] * (len(a) + len(b) - both)


def pruner():
    import numpy as np
    import pyarrow as pa

    def matrix(column):
        return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = matrix(batch.column("signature_a")), matrix(batch.column("signature_b"))
            alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
            for at in range(0, HASHES, BATCH):
                matches = matches + (a[alive, at : at + BATCH] == b[alive, at : at + BATCH]).sum(axis=1)
                keep = matches >= fewest_matches(at + BATCH)
                alive, matches = alive[keep], matches[keep]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def verifier():
    """Pairs with both texts to the pairs that are linked; the sets of a text are kept while it repeats."""
    import pyarrow as pa

    def run(batches):
        kept = {}
        for batch in in_slices(batches, "text_a"):
            texts = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b")]
            linked = []
            for a, b in zip(*texts):
                sets = []
                for text in (a, b):
                    if text not in kept:
                        if len(kept) >= 64:
                            kept.clear()
                        kept[text] = shingle_hashes(normalised(text))
                    sets.append(kept[text])
                linked.append(similar(*sets))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
        kept.clear()
        give_back()

    return run


def block_linker():
    """Links that connect the components of one block pair; what is connected is not compared again."""
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cls", "ascending")])
        ids, comps = table.column("cls").to_pylist(), table.column("comp").to_pylist()
        signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, HASHES)
        texts = table.column("text").cast(pa.binary()).to_pylist()
        parent = {c: c for c in comps}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        sets, links = {}, []
        for i in range(len(ids)):
            for j in (may_be_similar(signatures[i], signatures[i + 1 :]) + i + 1).tolist():
                one, two = root(comps[i]), root(comps[j])
                if one == two:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = shingle_hashes(normalised(texts[k]))
                if similar(sets[i], sets[j]):
                    parent[max(one, two)] = min(one, two)
                    links.append((ids[i], ids[j]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def texts_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, repeated: bool) -> DataFrame:
    """(id, text) of the classes with these ids, each once; stored, as it is read several times.

    Only where rows repeat a key and its text (`repeated`) are there several rows of a class to choose from.
    """
    wanted = classes.join(ids.toDF("cls"), "cls", "left_semi").select("cls", "first.doc_id", "first.text_digest")
    found = docs.join(wanted, ["doc_id", "text_digest"]).select(F.col("cls").alias("id"), "text")
    return stored(found.groupBy("id").agg(F.first("text").alias("text")) if repeated else found, "texts")


def bucket_pairs(members: DataFrame) -> DataFrame:
    """All pairs of buckets of at most SMALL_BUCKET classes."""
    small = members.where(F.col("n") <= SMALL_BUCKET).groupBy("key").agg(F.sort_array(F.collect_list("cls")).alias("all"))
    pairs = F.flatten(F.transform(
        "all", lambda a, i: F.transform(F.slice("all", i + 2, SMALL_BUCKET), lambda b: F.struct(a.alias("a"), b.alias("b")))
    ))
    return small.select(F.explode(pairs).alias("pair")).select("pair.a", "pair.b")


def block_links(members: DataFrame, labels: DataFrame, signatures: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that share a large bucket.

    In each bucket, the classes outside the pivot's component are compared with each
    other and with the pivot's component. Both are dealt into blocks of about BLOCK
    classes, and a task gets one pair of blocks.
    """
    comp = labels.select(F.col("node").alias("cls"), F.col("component").alias("comp"))
    rows = members.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    main = rows.where("cls = pivot").select("key", F.col("comp").alias("main"))
    counted = rows.join(main, "key").withColumn("rest", F.col("comp") != F.col("main"))
    sizes = counted.groupBy("key").agg(
        F.ceil(F.count_if("rest") / BLOCK).cast("int").alias("n_rest"),
        F.ceil(F.count_if(~F.col("rest")) / BLOCK).cast("int").alias("n_main"),
    ).where("n_rest > 0")
    dealt = counted.join(sizes, "key").withColumn("hash", F.xxhash64("cls"))
    own = F.when(F.col("rest"), F.expr("pmod(hash, n_rest)")).otherwise(F.expr("pmod(hash, n_main)")).cast("int")
    dealt = dealt.withColumn("own", own)
    units = F.expr(
        "if(rest,"
        " concat(transform(sequence(0, n_rest - 1), k -> struct('r' as side, least(own, k) as i, greatest(own, k) as j)),"
        "  transform(sequence(0, n_main - 1), k -> struct('m' as side, own as i, k as j))),"
        " transform(sequence(0, n_rest - 1), k -> struct('m' as side, k as i, own as j)))"
    )
    dealt = dealt.select("key", "cls", "comp", F.explode(units).alias("unit"))
    dealt = dealt.join(signatures.select("cls", "signature"), "cls").join(texts.withColumnRenamed("id", "cls"), "cls")
    return dealt.groupBy("key", "unit").applyInArrow(block_linker(), "a long, b long")


def text_digest(text: str):
    """Digest of a whole text, a null one as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256), 1, 32))


def find_near_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_digest of every row.

    A text that is null or without words has no shingles and is linked with nothing. A
    row whose key is null is linked with nothing, has no component and is kept. Rows
    that repeat a key and its text are one document in links and are each returned;
    rows that give a key another text are linked by that text alone, so its near copies
    decide about this row and not about the key's other ones.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), text_digest(text).alias("text_digest"))
    sketches = stored(docs.mapInArrow(sketcher(), SKETCH), "sketches")
    classes = sketches.where("doc_id is not null and digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_digest")).alias("first"), F.first("signature").alias("signature"),
        F.first("bands").alias("bands"),
    )
    # Classes are named by numbers of their own, as one key may stand before several texts.
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    # Fewer than two classes in a bucket give no pair. A pivot is drawn by the class alone, so that the buckets of a
    # group of near copies mostly agree on theirs.
    keys = classes.select("cls", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.min_by("cls", F.xxhash64("cls")).alias("pivot")
    ).where("n > 1")
    members = stored(keys.join(buckets, "key"), "members")
    large = members.where(F.col("n") > SMALL_BUCKET)
    star = large.where("cls != pivot").select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b"))
    pairs = bucket_pairs(members).union(star).where("a != b").distinct()
    signatures = classes.select("cls", "signature")
    for side in ("a", "b"):
        pairs = pairs.join(signatures.toDF(side, f"signature_{side}"), side)
    survivors = stored(pairs.mapInArrow(pruner(), "a long, b long"), "survivors")
    ids = survivors.select(F.explode(F.array("a", "b")).alias("id")).union(large.select("cls")).distinct()
    rows = sketches.where("doc_id is not null").groupBy("doc_id", "text_digest").count()
    texts = texts_of(docs, classes, ids, rows.where("count > 1").limit(1).count() > 0)
    both = survivors.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    links = forest(both.mapInArrow(verifier(), "a long, b long"))
    labels = components(links)
    more = stored(block_links(large, labels, signatures, texts), "links")
    if more.limit(1).count():
        labels = components(links.union(more))
    named = classes.select("digest", "cls", "first.doc_id").join(labels.toDF("cls", "component"), "cls", "left")
    named = stored(named.select("digest", "doc_id", F.coalesce("component", "cls").alias("component")), "components")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = lookup_join(named.select("digest", "component"), least, ["component"], "inner").drop("component")
    found = sketches.select("doc_id", "text_digest", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_digest",
    )


def op5_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates among all documents."""
    found = find_near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return found.drop("text_digest")
