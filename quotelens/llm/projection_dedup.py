"""Near-duplicate vectors by sorted projection passes.

Each pass orders the vectors lexicographically by concatenated random hashes (signs of
random projections), cuts the order into blocks and compares each block with itself and
the next, so every vector meets a bounded window of neighbours. How many signs single out
a vector's window is measured in each pass. Vectors for which the passes so far leave more
than MISS go on among themselves: in further passes, or compared with each other outright.
Verified pairs connect vectors; the union over all passes gives the components. Links are
then counted exactly inside the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quotelens.llm.common import components, stored

COSINE = 0.95
#: Vectors of a block: a window holds the rest of a vector's block and the next one.
BLOCK = 512
#: Signs that make a key; the first ones decide who are neighbours, the others order dense groups.
BITS = 48
#: Probability, by the measured keys, that no pass brings a vector together with one at cosine COSINE.
MISS = 1e-5
#: Vectors of each side of a unit where vectors are compared outright.
UNIT = 4096
#: Passes that one round adds at most.
ROUND = 64
#: Room for rounding in the bounds that need no comparison.
MARGIN = 1e-6


def same_sign() -> float:
    """Probability that two vectors at cosine COSINE share a sign: at angle a it is 1 - a / pi."""
    return 1 - math.acos(COSINE) / math.pi


def passes_needed(n: int) -> int:
    """Passes to begin with for `n` vectors: as many as they need if k signs single out a block; see `open_vectors`."""
    k = max(1, math.ceil(math.log2(max(n, 2) / BLOCK)))
    together = same_sign() ** k
    return max(2, math.ceil(math.log(MISS) / math.log(1 - together)))


def matrix(column, kind: str):
    """Unit vectors in double precision of an Arrow column of equally long vectors' bytes."""
    import numpy as np

    rows = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    return scaled(rows)


def scaled(rows):
    """Rows of length one; divided by the largest component first, so that no square over- or underflows."""
    import numpy as np

    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def reader(kind: str):
    """vec_id, bytes of the vector; null bytes where it can't have a direction."""
    import numpy as np
    import pyarrow as pa

    def usable(v) -> bytes | None:
        if not v or None in v:
            return None
        a = np.array(v, kind)
        return (a + 0).tobytes() if np.isfinite(a).all() and a.any() else None  # -0 becomes 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [usable(v) for v in batch.column("vec").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(found, pa.binary())], names=["vec_id", "vec"])

    return run


def keyer(passes: int, number: int, kind: str):
    """cls and a key for each pass; the planes depend only on the vectors' length, the round's number and the pass."""
    import numpy as np
    import pyarrow as pa

    planes = {}

    def keys(rows):
        d = rows.shape[1]
        if d not in planes:
            planes[d] = np.random.Generator(np.random.PCG64([d, number] if number else d)).standard_normal((passes, d, BITS))
        weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        return np.stack([((rows @ p) > 0) @ weights for p in planes[d]], axis=1)

    def run(batches):
        for batch in batches:
            data = batch.column("vec").to_pylist()
            out = np.empty((len(data), passes), np.int64)
            lengths = np.array([len(v) for v in data])
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                for part in np.array_split(at, max(1, len(at) // 2048)):
                    out[part] = keys(matrix(pa.array([data[i] for i in part], pa.binary()), kind))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(data) + 1) * passes, pa.int32()), pa.array(out.reshape(-1), pa.int64())
            )
            yield pa.RecordBatch.from_arrays([batch.column("cls"), lists], names=["cls", "keys"])

    return run


def window_linker(kind: str):
    """Pairs that connect the vectors of a block and its next one: of all verified pairs, a forest."""
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cls", "ascending")])
        ids, own = table.column("cls").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
        data = table.column("vec").to_pylist()
        lengths = np.array([len(v) for v in data])
        a, b = [], []
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            rows = matrix(pa.array([data[i] for i in at], pa.binary()), kind)
            mine = np.flatnonzero(own[at])
            label = np.arange(len(at))
            compared = (zip(part.tolist(), rows[part] @ rows.T >= COSINE) for part in np.split(mine, range(BLOCK, len(mine), BLOCK)))
            for i, row in chain.from_iterable(compared):
                labels, first = np.unique(label[row], return_index=True)
                others = labels != label[i]
                if others.any():
                    found = np.flatnonzero(row)[first[others]]
                    a += [ids[at[i]]] * len(found)
                    b += ids[at[found]].tolist()
                    label[np.isin(label, labels[others])] = label[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def ranks(rows: DataFrame, passes: int, number: int, kind: str) -> DataFrame:
    """(pass, cls, key, block) of every row and pass, blocks in the order of keys."""
    keyed = rows.select("cls", "vec").mapInArrow(keyer(passes, number, kind), "cls long, keys array<long>")
    keyed = keyed.select("cls", F.posexplode("keys").alias("pass", "key"))
    # Ranks in the order of all keys: place in the sorted partition plus what the lower ones hold.
    order = ["pass", "key", "cls"]
    placed = stored(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "pass", "cls", "key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
        ),
        "order",
    )
    before = Window.partitionBy("pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("pass", "part").agg(F.count("*").alias("n"), F.min("place").alias("first")).select(
        "pass", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    ranked = placed.join(starts, ["pass", "part"]).withColumn("block", F.expr(f"(place + shift) div {BLOCK}"))
    return ranked.select("pass", "cls", "key", "block")


def windows(ranked: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows (pass, block, own, cls, vec): each class in its block, and once more as a neighbour of the one before."""
    ranked = ranked.join(rows.select("cls", "vec"), "cls")
    both = F.expr("array(struct(block as block, true as own), struct(block - 1 as block, false as own))")
    return ranked.select("pass", "cls", "vec", F.explode(both).alias("at")).select("pass", "at.block", "at.own", "cls", "vec")


def open_vectors(ranked: DataFrame, rows: DataFrame, passes: int) -> DataFrame:
    """(cls, vec, miss, more): rows whose log probability `miss` of not meeting a neighbour exceeds MISS; `more` passes would do.

    A vector meets all of its block and of the two beside it. So it meets each vector that
    shares as many signs as tell it from the last key before those blocks and the first one after.
    """
    ends = ranked.groupBy("pass", "block").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    under = ends.select("pass", (F.col("block") + 2).alias("block"), F.col("high").alias("under"))
    over = ends.select("pass", (F.col("block") - 2).alias("block"), F.col("low").alias("over"))
    edges = ends.select("pass", "block").join(under, ["pass", "block"], "left").join(over, ["pass", "block"], "left")

    def shared(other: str):
        """Signs shared with the key and one more; none are needed where there is no such key."""
        apart = F.col("key").bitwiseXOR(F.col(other))
        return F.when(F.col(other).isNull(), 0).when(apart == 0, BITS + 1).otherwise(BITS + 1 - F.length(F.bin(apart)))

    needed = F.greatest(shared("under"), shared("over"))
    together = F.when(needed <= BITS, F.pow(F.lit(same_sign()), needed)).otherwise(0.0)
    log = F.log(F.greatest(1 - together, F.lit(1e-300)))
    added = ranked.join(edges, ["pass", "block"]).groupBy("cls").agg(F.sum(log).alias("added"))
    left = rows.join(added, "cls").select("cls", "vec", (F.col("miss") + F.col("added")).alias("miss"), "added")
    more = F.coalesce((F.lit(math.log(MISS)) - F.col("miss")) * passes / F.nullif("added", F.lit(0.0)), F.lit(1e9))
    return left.select("cls", "vec", "miss", more.alias("more")).where(F.col("miss") > math.log(MISS))


def every_pair(rest: DataFrame, n_rest: int, rows: DataFrame, n: int) -> DataFrame:
    """Rows (i, j, own, cls, vec) of units that bring each of `rest` together with each of `rows`."""
    i, j = -(-n_rest // UNIT), -(-n // UNIT)

    def dealt(df: DataFrame, own: bool, mine: str, of: int, other: str, others: int) -> DataFrame:
        at = df.select("cls", "vec", F.lit(own).alias("own"), F.expr(f"cast(pmod(xxhash64(cls), {of}) as int)").alias(mine))
        return at.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).select("i", "j", "own", "cls", "vec")

    return dealt(rest, True, "i", i, "j", j).union(dealt(rows, False, "j", j, "i", i))


def near_pairs(classes: DataFrame, kind: str) -> DataFrame:
    """(a, b) of verified pairs that connect all components; a pair with one vector that is not open needs no more passes.

    Pairs inside a component change nothing, so what is open is done once it is all in one.
    Where passes would take more comparisons, open vectors outside the largest component are
    compared with all open ones.
    """
    linker, schema = window_linker(kind), "a long, b long"
    rows, passes, number = classes.select("cls", "vec", F.lit(0.0).alias("miss")), passes_needed(classes.count()), 0
    found = None
    while True:
        ranked = ranks(rows, passes, number, kind)
        new = stored(windows(ranked, rows).groupBy("pass", "block").applyInArrow(linker, schema), "links")
        found = found.union(new) if found is not None else new
        rows = stored(open_vectors(ranked, rows, passes), "open")
        n, more = rows.agg(F.count("*"), F.percentile_approx("more", 0.5)).first()
        if not n:
            return found
        rest, n_rest = rows, n
        if n > UNIT:
            labels = components(found).toDF("cls", "comp")
            labelled = rows.join(labels, "cls", "left").select("cls", "vec", F.coalesce("comp", "cls").alias("comp"))
            largest = labelled.groupBy("comp").count().orderBy(F.desc("count"), "comp").first()["comp"]
            rest = stored(labelled.where(F.col("comp") != largest), "rest")
            n_rest = rest.count()
        if not n_rest:
            return found
        if n_rest <= 2 * BLOCK * more:
            units = every_pair(rest, n_rest, rows, n)
            return found.union(stored(units.groupBy("i", "j").applyInArrow(linker, schema), "links"))
        rows, passes, number = rows.drop("more"), min(max(1, math.ceil(more)), ROUND), number + 1


def core_finder(kind: str):
    """Whether a vector is so near its component's pivot that it is linked with every other such one."""
    import numpy as np
    import pyarrow as pa

    half = math.cos(math.acos(COSINE) / 2) + MARGIN

    def run(batches):
        for batch in batches:
            core = []
            for v, p in zip(batch.column("vec").to_pylist(), batch.column("pivot").to_pylist()):
                two = scaled(np.stack([np.frombuffer(v, kind), np.frombuffer(p, kind)]).astype(np.float64))
                core.append(bool(two[0] @ two[1] >= half))
            columns = [batch.column(c) for c in ("cls", "comp", "copies")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(core)], names=["cls", "comp", "copies", "core"])

    return run


def link_counter(kind: str):
    """Links of each vector within one unit: pairs of one component and, in a unit of two blocks, across them."""
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        rows = matrix(table.column("vec"), kind)
        comp, own = table.column("comp").to_numpy(), table.column("own").to_numpy()
        copies = table.column("copies").to_numpy()
        near = (rows @ rows.T >= COSINE) & (comp[:, None] == comp[None, :])
        if len(np.unique(own)) > 1:
            near &= own[:, None] != own[None, :]
        elif len(rows) and own[0] < 0:
            near[:] = False  # only one of the unit's two blocks has rows
        np.fill_diagonal(near, False)
        return pa.table({"cls": table.column("cls"), "links": pa.array(near @ copies, pa.int64())})

    return run


def link_counts(classes: DataFrame, labels: DataFrame, kind: str) -> DataFrame:
    """(cls, links): other vectors of the component within COSINE, copies of other classes included.

    Components of at most BLOCK classes share units. In a larger one, the classes near
    its pivot are linked with each other for certain, as angles add up; only the rest is
    compared, with itself and with those, in pairs of blocks.
    """
    rows = classes.join(labels.toDF("cls", "comp"), "cls")
    sizes = rows.groupBy("comp").agg(F.count("*").alias("m"))
    sized = rows.join(sizes, "comp")
    small = sized.where(F.col("m") <= BLOCK)
    units = max(1, -(-small.count() // BLOCK))
    width = F.octet_length("vec")
    small = small.select(
        "cls", "comp", "vec", "copies", F.lit(0).alias("own"),
        F.struct(F.lit("s").alias("side"), width.cast("long").alias("of"), F.lit(0).alias("i"),
                 F.expr(f"cast(pmod(xxhash64(comp), {units}) as int)").alias("j")).alias("unit"),
    )
    large = sized.where(F.col("m") > BLOCK)
    pivots = large.where("cls = comp").select("comp", F.col("vec").alias("pivot"))
    cored = stored(
        large.join(pivots, "comp").select("cls", "comp", "copies", "vec", "pivot").mapInArrow(
            core_finder(kind), "cls long, comp long, copies long, core boolean"
        ),
        "core",
    )
    parts = cored.groupBy("comp").agg(
        F.ceil(F.count_if(~F.col("core")) / BLOCK).cast("int").alias("n_rest"),
        F.ceil(F.count_if("core") / BLOCK).cast("int").alias("n_core"),
        F.coalesce(F.sum(F.when(F.col("core"), F.col("copies"))), F.lit(0)).alias("in_core"),
    )
    dealt = cored.join(parts, "comp").withColumn("hash", F.xxhash64("cls"))
    certain = dealt.where("core").select("cls", (F.col("in_core") - F.col("copies")).alias("links"))
    dealt = dealt.where("n_rest > 0").withColumn(
        "b", F.expr("cast(if(core, pmod(hash, n_core), pmod(hash, n_rest)) as int)")
    )
    pairs = F.expr(
        "if(core,"
        " transform(sequence(0, n_rest - 1), k -> struct('m' as side, comp as of, k as i, b as j, -1 as own)),"
        " concat(transform(sequence(0, n_rest - 1), k ->"
        "   struct('r' as side, comp as of, least(b, k) as i, greatest(b, k) as j, if(b = k, 0, if(b < k, -2, -3)) as own)),"
        "  if(n_core = 0, cast(array() as array<struct<side:string,of:bigint,i:int,j:int,own:int>>),"
        "   transform(sequence(0, n_core - 1), k -> struct('m' as side, comp as of, b as i, k as j, -2 as own)))))"
    )
    dealt = dealt.select("cls", "comp", "copies", F.explode(pairs).alias("unit")).join(classes.select("cls", "vec"), "cls")
    large_units = dealt.select(
        "cls", "comp", "vec", "copies", "unit.own",
        F.struct("unit.side", "unit.of", "unit.i", "unit.j").alias("unit"),
    )
    counted = small.unionByName(large_units).groupBy("unit").applyInArrow(link_counter(kind), "cls long, links long")
    return counted.union(certain).groupBy("cls").agg(F.sum("links").alias("links"))


def find_near_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    A vector that is null, empty, zero or holds null or non-finite components is linked
    with nothing, and so is a row whose key is null: it has no component and is kept.
    Vectors of different lengths are never linked. Equal vectors are one class, which
    enters once; each of them counts as a link of the others.
    """
    kind = "<f4" if vectors.schema[vector].dataType == T.ArrayType(T.FloatType()) else "<f8"
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vec"))
    read = rows.mapInArrow(reader(kind), "vec_id long, vec binary")
    read = stored(read.select("vec_id", "vec", F.md5("vec").alias("digest")), "vectors")
    usable = read.where("vec_id is not null and vec is not null")
    classes = stored(
        usable.groupBy("digest").agg(
            F.min("vec_id").alias("cls"), F.count("*").alias("copies"), F.first("vec").alias("vec")
        ),
        "classes",
    )
    labels = components(near_pairs(classes, kind))
    links = link_counts(classes, labels, kind)
    out = read.select("vec_id", "digest").join(classes.select("digest", "cls", "copies"), "digest", "left")
    out = out.join(labels.toDF("cls", "component"), "cls", "left").join(links, "cls", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "cls", "vec_id"))
    has_class = F.col("vec_id").isNotNull() & F.col("cls").isNotNull()
    return out.select(
        "vec_id",
        F.when(has_class, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op10_projection_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings."""
    return find_near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
