"""Vectors against brute force, components, the registered queries and the pipeline."""

import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from quotelens.llm import common, projection_dedup, queries

REPO = Path(__file__).resolve().parents[2]


def brute(vectors):
    usable = {i: np.array(v, float) for i, v in vectors if v and None not in v and np.isfinite(v).all() and any(v)}
    comp, links = {i: i for i, _ in vectors}, {i: 0 for i, _ in vectors}
    edges = []
    for a, x in usable.items():
        for b, y in usable.items():
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links[a], links[b] = links[a] + 1, links[b] + 1
                edges.append((a, b))
    for _ in vectors:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return links, comp


@pytest.mark.parametrize("block", [512, 16])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(projection_dedup, "BLOCK", block)
    r = np.random.default_rng(7)
    centre = r.normal(size=16)
    rows = [(i, (centre + r.normal(size=16) * (0.02 if i % 3 else 0.3)).tolist()) for i in range(90)]
    rows += [(100 + i, r.normal(size=16).tolist()) for i in range(60)] + [(200 + i, centre.tolist()) for i in range(5)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [1.0, None]), (304, [float("nan")] * 16), (305, [1e200] * 16),
             (306, [1e-200] * 16), (307, [1.0] * 3), (308, [2.0] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'z' as cls", "1 as vec")
    found = {r.vec_id: r for r in projection_dedup.find_near_vectors(table, "vec_id", "embedding").collect()}
    rows[-4:-2] = [(305, [1.0] * 16), (306, [1.0] * 16)]  # the same directions
    links, comp = brute(rows)
    wrong = [(i, found[i], links[i], comp[i]) for i in links if (found[i].n_links, found[i].component_id, found[i].kept) != (links[i], comp[i], comp[i] == i)]
    assert not wrong and len(found) == len(rows)
    assert projection_dedup.find_near_vectors(table.limit(0), "vec_id", "embedding").count() == 0


def skewed(n_even, n_hot, planted, dimensions=64):
    """Rows of which some share a direction, and pairs at cosine 0.955 planted among those."""
    r = np.random.default_rng(3)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    centre = unit(r.normal(size=dimensions))
    hot = unit(2.0 * centre + unit(r.normal(size=(n_hot, dimensions))))
    first = hot[:planted]
    aside = r.normal(size=first.shape)
    aside = unit(aside - (aside * first).sum(axis=1, keepdims=True) * first)
    second = 0.955 * first + np.sqrt(1 - 0.955**2) * aside
    return np.concatenate((hot, second, unit(r.normal(size=(n_even, dimensions)))))


@pytest.mark.parametrize("unit", [4096, 100])
def test_pairs_in_a_group_with_a_common_direction(spark, monkeypatch, unit):
    monkeypatch.setattr(projection_dedup, "BLOCK", 8)
    monkeypatch.setattr(projection_dedup, "UNIT", unit, raising=False)
    vectors = skewed(300, 600, 100)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    near = vectors @ vectors.T >= 0.95
    comp = np.arange(len(vectors))
    for _ in range(20):
        comp = np.where(near, comp[None, :], len(comp)).min(axis=1)
    found = {r.vec_id: (r.n_links, r.component_id) for r in projection_dedup.find_near_vectors(table, "vec_id", "embedding").collect()}
    assert [i for i in found if found[i] != (near[i].sum() - 1, comp[i])] == []


def test_components(spark):
    r = random.Random(2)
    nodes = r.sample(range(10_000), 400)
    links = [(nodes[i], nodes[i + 1]) for i in range(120)] + [(nodes[200], n) for n in nodes[201:300]] + [(5, 5), (None, 3)]
    found = {x.node: x.component for x in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[n] for n in nodes[:121]} == {min(nodes[:121])} and {found[n] for n in nodes[200:300]} == {min(nodes[200:300])}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_connects_the_same_nodes(spark, monkeypatch):
    r = random.Random(4)
    monkeypatch.setattr(common, "FOREST_LINKS", 50)
    rows = [(r.randrange(300), r.randrange(300)) for _ in range(400)] + [(7, i) for i in range(300, 500)] * 3 + [(9, 9)]
    links = spark.createDataFrame(rows, "a long, b long").repartition(3)
    thin = common.forest(links)
    assert thin.count() < links.count() - 200
    assert sorted(common.components(thin).collect()) == sorted(common.components(links).collect())
    assert common.forest(links.limit(0)).count() == 0


def test_registered_queries():
    assert [int(n.split("_")[0][2:]) for n in queries.QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, name):
    folder, connection = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    rows = queries.QUERIES[name](spark, folder)
    twin = connection.execute(f"SELECT {', '.join(rows.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, rows.collect())) == Counter(twin)


def test_pipeline_stages(spark, tmp_path):
    """Each stage on all its predecessor kept, decisions against plain Python."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r.doc_id: r for r in docs.collect()})
        if name != "packing":
            assert docs.columns == columns
    languages, unique, clean, redacted, packed = kept
    words = {i: (r.text or "").encode().lower().split() for i, r in languages.items()}
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in words.items() if w}
    comp = {i: i for i in languages}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in range(20):
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert set(unique) == {i for i in comp if comp[i] == i}
    assert set(redacted) == set(clean) == set(packed) and set(clean) < set(unique)
    assert all(r.n_chars == len(r.text) for r in redacted.values())


def test_library_without_the_subpackage():
    """The contract module imports and lists its own queries where the subpackage and the pipeline are not found."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'quotelens.llm'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries()) and e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=100)
