"""Registry of query keys: a Spark plan and, where SQL can say it, a DuckDB oracle.

Each query reads the driver tables in ``sf_dir`` (through the fixtures in
``ledgerline.sources.fixtures``), runs one operator over the whole input and
returns a DataFrame.  Oracles start from the same fixture text as a CTE and
restate the semantics in plain SQL, independently of the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def load_all() -> None:
    """Import every ``q_*`` module of this package; each registers its queries."""
    import importlib
    import pkgutil

    import ledgerline.plans as pkg

    for mod in sorted(m.name for m in pkgutil.iter_modules(pkg.__path__)):
        if mod.startswith("q_"):
            importlib.import_module(f"ledgerline.plans.{mod}")
