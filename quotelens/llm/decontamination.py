"""Benchmark decontamination by a positional inverted index of the training texts.

The index holds, for each document, the postings of the words that test items use:
term, number of places, places. It is a table in the shared folder, spread like the
documents, so it is built and searched without moving a text. A search takes each
window of a test item, starts from the places of its rarest term (by document
frequency in the whole corpus) and intersects the lists of the other terms, moved
by their distance to it, from rare to frequent.

Test items go to the tasks in blocks of bounded size; a benchmark that exceeds one
block is searched block by block and the findings are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import give_back, in_slices, stored

#: Words are runs of ASCII letters and digits, A-Z in lower case, and all other characters beyond ASCII.
LOWER_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

INDEX = "doc long, text_digest binary, n_words long, terms array<int>, counts array<int>, places array<int>"
FOUND = (
    "doc long, text_digest binary, n_words long, hit_from array<int>, hit_to array<int>, items array<string>, near long"
)
#: Windows of a block: with 10 words each, some 30 MB.
BLOCK_WINDOWS = 200_000
#: Words that a task searches at a time.
SEGMENT_WORDS = 1_000_000


def words(text: bytes) -> list[bytes]:
    return text.translate(LOWER_WORDS).split()


def windows_of(item: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    """Every run of `size` words; a shorter item is one window, one without words none."""
    if not item:
        return []
    return [tuple(item[i : i + size]) for i in range(max(1, len(item) - size + 1))]


def blocks(items: DataFrame, key: str, text: str, size: int, limit: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Windows with their items, at most about `limit` windows at a time."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    rows = items.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    for item, body in rows.select(F.col(key).cast("string"), F.col(text)).toLocalIterator():
        for window in windows_of(words(body.encode()), size):
            block.setdefault(window, set()).add(item)
        if len(block) >= limit:
            yield block
            block = {}
    yield block


def indexer(term_ids: dict[bytes, int]):
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = term_ids.get
        for batch in in_slices(batches, "text"):
            n_words, digests, terms, counts, places, ends, sums = [], [], [], [], [], [0], [0]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = words(text or b"")
                digests.append(hashlib.sha256(text or b"").digest()[:16])
                n_words.append(len(found))
                ids = np.fromiter((-1 if t is None else t for t in map(get, found)), np.int32, len(found))
                place = np.flatnonzero(ids >= 0).astype(np.int32)
                order = np.argsort(ids[place], kind="stable")
                term, n = np.unique(ids[place], return_counts=True)
                terms.append(term.astype(np.int32))
                counts.append(n.astype(np.int32))
                places.append(place[order])
                ends.append(ends[-1] + len(term))
                sums.append(sums[-1] + len(place))

            def lists(at, values):
                flat = np.concatenate(values) if values else np.empty(0, np.int32)
                return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))

            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(digests, pa.binary()), pa.array(n_words, pa.int64()),
                 lists(ends, terms), lists(ends, counts), lists(sums, places)],
                names=["doc", "text_digest", "n_words", "terms", "counts", "places"],
            )
        give_back()

    return run


def build_index(docs: DataFrame, key: str, text: str, term_ids: dict[bytes, int]) -> DataFrame:
    """One row per document, with the postings of the given terms; stored."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(indexer(term_ids), INDEX), "postings")


def document_frequency(index: DataFrame, n_terms: int) -> list[int]:
    """By term id, over all documents: one row per task and term, then summed."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        seen = np.zeros(n_terms, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        term = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(seen[term])], names=["term", "n"])

    frequency = [0] * n_terms
    counted = index.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in counted.toLocalIterator():  # at most the terms of a block
        frequency[term] = n
    return frequency


def searcher(block: dict[tuple[bytes, ...], set[str]], term_ids: dict[bytes, int], frequency: list[int], size: int, slop: int):
    """Task side of the search; arrays hold for each window its terms from rare to frequent and their distances."""
    import numpy as np
    import pyarrow as pa

    window_list = list(block)
    n = len(window_list)
    length = np.array([len(w) for w in window_list], np.int32)
    term = np.full((n, size), -2, np.int32)
    shift = np.zeros((n, size), np.int32)
    for i, w in enumerate(window_list):
        by_rarity = sorted(range(len(w)), key=lambda j: (frequency[term_ids[w[j]]], j))
        term[i, : len(w)] = [term_ids[w[j]] for j in by_rarity]
        shift[i, : len(w)] = by_rarity
    by_anchor = np.argsort(term[:, 0], kind="stable").astype(np.int32)
    first = np.searchsorted(term[by_anchor, 0], np.arange(len(term_ids) + 1)).astype(np.int32)
    item_names = sorted({item for items in block.values() for item in items})
    item_id = {item: i for i, item in enumerate(item_names)}
    item_of = [np.array(sorted(item_id[x] for x in block[w]), np.int32) for w in window_list]
    item_end = np.concatenate(([0], np.cumsum([len(x) for x in item_of]))).astype(np.int64)
    item_flat = np.concatenate(item_of) if item_of else np.empty(0, np.int32)
    reach = size - 1 + slop

    def expand(at, ends):
        """Index of each element of the lists `at` in a flat array with the given ends, and whose it is."""
        counts = ends[at + 1] - ends[at]
        owner = np.repeat(np.arange(len(at)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return ends[at][owner] + inside, owner

    def segment(ids, anchors):
        """Starts and windows of the phrases; places and windows of the near matches."""
        flat, owner = expand(ids[anchors], first)
        window, place = by_anchor[flat], anchors[owner]
        start = place - shift[window, 0]
        w, s = window, start
        for j in range(1, size):
            same = (j >= length[w]) | (ids[s + shift[w, j]] == term[w, j])
            w, s = w[same], s[same]
        near_w, near_p = window, place
        for j in range(1, size):
            if not len(near_w):
                break
            want, inside = term[near_w, j], j >= length[near_w]
            for d in range(-reach, reach + 1):
                inside |= ids[near_p + d] == want
            near_w, near_p = near_w[inside], near_p[inside]
        return s, w, near_p, near_w

    def search(n_words, terms, counts, places, place_counts):
        """All of some documents at once: their words stand in one array with gaps between documents."""
        gap = 2 * reach + size
        base = np.cumsum(n_words + gap) - n_words - gap + reach + size
        ids = np.full(int((n_words + gap).sum()) + gap, -1, np.int32)
        at = places + np.repeat(base, place_counts)
        by_term = np.repeat(terms, counts)
        ids[at] = by_term
        anchors = at[first[by_term + 1] > first[by_term]]
        found = [segment(ids, anchors[i : i + 100_000]) for i in range(0, len(anchors), 100_000)]
        s, w, near_p, near_w = (np.concatenate(x) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 4
        doc = np.searchsorted(base, s, "right") - 1
        near_doc = np.searchsorted(base, near_p, "right") - 1
        near = np.bincount(np.unique(near_doc * np.int64(n) + near_w) // max(n, 1), minlength=len(n_words))
        order = np.lexsort((s, doc))
        s, w, doc = s[order], w[order], doc[order]
        flat, owner = expand(w, item_end)
        pair = np.unique(doc[owner] * np.int64(len(item_names)) + item_flat[flat])
        return doc, s - base[doc], length[w], pair, near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = whole.column("n_words").to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SEGMENT_WORDS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
                batch = whole.slice(a, b - a)
                lists = [batch.column(c) for c in ("terms", "counts", "places")]
                terms, counts, places = (x.flatten().to_numpy() for x in lists)
                n_places = lists[2].value_lengths().to_numpy()
                doc, start, span, pair, near = search(sizes[a:b], terms, counts, places, n_places)
                froms, tos, items = ([[] for _ in range(b - a)] for _ in range(3))
                for d, f, t in zip(doc.tolist(), start.tolist(), (start + span).tolist()):
                    if tos[d] and f <= tos[d][-1]:
                        tos[d][-1] = max(t, tos[d][-1])
                    else:
                        froms[d].append(f)
                        tos[d].append(t)
                for p in pair.tolist():
                    items[p // len(item_names)].append(item_names[p % len(item_names)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc"), batch.column("text_digest"), batch.column("n_words"),
                     pa.array(froms, pa.list_(pa.int32())), pa.array(tos, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string())), pa.array(near, pa.int64())],
                    names=["doc", "text_digest", "n_words", "hit_from", "hit_to", "items", "near"],
                )
        give_back()

    return run


def merged(parts: list[DataFrame]) -> DataFrame:
    """Findings of several blocks as one row per document; rows that repeat a document and its text stay as many."""
    own = ["doc", "text_digest"]
    alike = [
        p.groupBy(own).agg(
            F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("hit_from").alias("hit_from"),
            F.first("hit_to").alias("hit_to"), F.first("items").alias("items"), F.first("near").alias("near"),
        )
        for p in parts
    ]
    every = alike[0]
    for p in alike[1:]:
        every = every.unionByName(p)
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("hit_from", "hit_to"))))
    # Joins spans that touch: the last one grows, or a new one begins.
    join = F.aggregate(
        "spans",
        F.expr("cast(array() as array<struct<hit_from:int,hit_to:int>>)"),
        lambda seen, x: F.when(
            (F.size(seen) > 0) & (F.element_at(seen, -1)["hit_to"] >= x["hit_from"]),
            F.concat(
                F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(0))),
                F.array(F.struct(
                    F.element_at(seen, -1)["hit_from"].alias("hit_from"),
                    F.greatest(F.element_at(seen, -1)["hit_to"], x["hit_to"]).alias("hit_to"),
                )),
            ),
        ).otherwise(F.concat(seen, F.array(F.struct(x["hit_from"].alias("hit_from"), x["hit_to"].alias("hit_to"))))),
    )
    rows = every.groupBy(own).agg(
        F.max("copies").alias("copies"), F.max("n_words").alias("n_words"), spans.alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.sum("near").alias("near"),
    )
    rows = rows.withColumn("spans", join).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(
        *own, "n_words", F.col("spans.hit_from").alias("hit_from"), F.col("spans.hit_to").alias("hit_to"), "items", "near"
    )


def find_contamination(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str,
    size: int = 10, slop: int = 2, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per document: doc, n_words, spans of words inside phrase matches, items with phrase matches, near matches.

    A phrase match is an occurrence of a window of an item. `near` counts the windows
    of which every word stands within size - 1 + slop words of one occurrence of its
    rarest word, in any order. A null text has no words; an item that is null or has
    no words matches nothing; a null doc stays null. Rows that repeat a document are
    searched and returned each.
    """
    parts = []
    for block in blocks(items, item_key, item_text, size, block_windows):
        if parts and not block:
            continue
        terms = sorted({t for w in block for t in w})
        term_ids = {t: i for i, t in enumerate(terms)}
        index = build_index(docs, key, text, term_ids)
        frequency = document_frequency(index, len(terms))
        parts.append(index.mapInArrow(searcher(block, term_ids, frequency, size, slop), FOUND))
    return parts[0] if len(parts) == 1 else merged(parts)


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, in windows of 10 words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, "doc_id", "text", items, "item_id", "text")
    hit = F.expr("aggregate(zip_with(hit_from, hit_to, (a, b) -> b - a), 0, (s, x) -> s + x)").cast("long")
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_from") > 0).alias("contaminated"), F.col("near").alias("n_near"),
    )
