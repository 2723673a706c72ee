"""Helpers that the operators share: the shared folder, stored tables, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one the session names. Only where none is named, as in tests on one
    machine, a new temporary folder is set for the session.
    """
    named = spark.conf.get(SHARED_DIR, None)
    if not named:
        named = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set(SHARED_DIR, named)
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage and survives a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of text that a task works on at a time.
SLICE_BYTES = 3_000_000


def in_slices(batches, text: str):
    """Arrow batches in the same order, cut where their texts reach SLICE_BYTES; a longer text is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(batch):
            before = int(ends[at] - sizes[at])
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def give_back() -> None:
    """Return what this worker no longer uses to the system: it waits for its next task with all that it holds."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    # The C library keeps freed arrays of some megabytes; other libraries than glibc have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: Links that a task holds at a time.
FOREST_LINKS = 1_000_000


def forester():
    """Links to those of them that connect something new within a task's blocks of links."""
    import pyarrow as pa

    def trees(pairs):
        parent: dict[int, int] = {}

        def root(node):
            while parent.setdefault(node, node) != node:
                parent[node] = node = parent[parent[node]]
            return node

        for a, b in pairs:
            one, two = root(a), root(b)
            if one != two:
                parent[max(one, two)] = min(one, two)
                yield a, b

    def block(pairs):
        a, b = zip(*trees(pairs))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        held: list[tuple[int, int]] = []
        for batch in batches:
            held += [(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()) if a != b]
            if len(held) >= FOREST_LINKS:
                yield block(held)
                held = []
        if held:
            yield block(held)

    return run


def forest(links: DataFrame) -> DataFrame:
    """Stored links (a, b) that connect the same nodes, each once, without those that others of their task make needless."""
    return stored(links.select("a", "b").where("a != b").mapInArrow(forester(), "a long, b long").distinct(), "forest")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the undirected links (a, b); component is the smallest node reachable.

    Each round gives a node the smallest label among its neighbours' and then that
    label's own label, so the rounds grow with the logarithm of a component's
    width. Labels are stored after each round. Sums over a node's neighbours
    combine before the shuffle and the joins have only equality conditions, so a
    node with very many links is split by adaptive execution. Nulls and links of a
    node to itself are left out.
    """
    links = links.select("a", "b").where("a != b")
    both = stored(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "edges")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        near = labels.toDF("other", "near")
        reached = both.join(near, "other").groupBy("node").agg(F.min("near").alias("near"))
        nearer = labels.join(reached, "node").select("node", F.least("component", "near").alias("next"), "component")
        jump = nearer.select(F.col("node").alias("next"), F.col("next").alias("further"))
        moved = stored(
            nearer.join(jump, "next").select("node", F.least("next", "further").alias("next"), "component"), "labels"
        )
        changed = moved.where("next != component").limit(1).count()
        labels = moved.select("node", F.col("next").alias("component"))
        if not changed:
            return labels
