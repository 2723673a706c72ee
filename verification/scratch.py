"""A stored cube per session and scale factor, for the queries that read one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from quotelens.operators.collapse import state_cube
from quotelens.operators.cube import monthly_cube
from quotelens.schemas import FACTS
from quotelens.sources.facts import write_facts
from quotelens.sources.store import CubeStore, Places
from verification.mapping import CONFIG, mapped_facts

_stores: dict[tuple[str, str], CubeStore] = {}
_folded: dict[tuple[str, str], Places] = {}
_facts: dict[tuple[str, str], tuple[str, set[str]]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder that the session names as shared; where none is named, as in tests, a new one is named for it."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quotelens-"))
    return spark.conf.get("spark.checkpoint.dir")


def cube_store(spark: SparkSession, sf_dir: str, root: str | None = None, folded: bool = True) -> CubeStore:
    """The cubes of the mapped facts, each written on first use under `root`, by default the shared folder.

    The state cube is only written for those who read it (`folded`).
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = CubeStore(spark, f"{root or scratch_root(spark)}/quotelens-{uuid.uuid4().hex}")
        facts = mapped_facts(spark, sf_dir, "rate", "car", "driver", by_policy=True)
        months = store.stage("monthly", monthly_cube(facts["rate"], facts["car"], facts["driver"], CONFIG))
        store.publish(store.snapshot(), monthly=months)
        _stores[key] = store
    store, base = _stores[key], _stores[key].snapshot()
    if folded and not base.states:
        store.publish(base, states=store.stage("states", state_cube(store.monthly(base), CONFIG)))
    return store


def folded_months(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Some months of the folded cube: of the state cube where that is written, else folded by the lists of all months
    and written on first use without the other months."""
    store = cube_store(spark, sf_dir, folded=False)
    base = store.snapshot()
    if base.states:
        return store.states(base).where(which)
    key = (store.root, which)
    if key not in _folded:
        _folded[key] = store.stage("states", state_cube(store.monthly(base), CONFIG, distinct=True).where(which))
    return store.read("states", _folded[key])


def stored_facts(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """A folder with the named mapped facts (all four by default) in their stored layout, each written on first use."""
    root, written = _facts.setdefault(
        (spark.sparkContext.applicationId, sf_dir), (f"{scratch_root(spark)}/quotelens-facts-{uuid.uuid4().hex}", set())
    )
    for name in names or FACTS:
        if name not in written:
            write_facts(mapped_facts(spark, sf_dir, name), root)
            written.add(name)
    return root
