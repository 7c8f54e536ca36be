"""The whole parameter search: null columns, scaling, split, both criteria, one log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.ml import absolute_trees, models
from sitescore.operators.columns import NullPolicy
from sitescore.operators.sampling import SEED, split
from sitescore.session import cut_lineage

#: Share of the rows that the search is measured on.
TUNING_SHARE = 0.2
DEFAULT_DEPTH = 5


def search(train: DataFrame, test: DataFrame, grid: Sequence[Mapping[str, object]], label: str = "stars", seed: int = SEED, scaling: str = "none", key: str = "site_id") -> DataFrame:
    """The run log of :func:`models.grid_search` with the ``mae`` rows measured as well.

    All absolute-error forests grow together: one for each ``bootstrap``,
    ``max_samples`` and ``max_depth``, of the largest number of trees asked for,
    whose first k trees are the forest of k.
    """
    log = cut_lineage(models.grid_search(train, test, grid, label, seed=seed, scaling=scaling))
    shared: dict[tuple, list[tuple[int, int]]] = {}
    for run_id, p in enumerate(grid):
        if p.get("criterion") == "mae":
            trees = int(p.get("n_estimators", models.DEFAULT_TREES))
            # as with the other criterion, a single tree splits on all features
            kind = (trees == 1, int(p.get("max_depth", DEFAULT_DEPTH)), bool(p.get("bootstrap", True)), float(p.get("max_samples", 1.0)))
            shared.setdefault(kind, []).append((run_id, trees))
    if not shared:
        return log
    scale = absolute_trees.Scale.fit(train, label)
    parts = []
    for single, depth in sorted({k[:2] for k in shared}):
        kinds = [k for k in shared if k[:2] == (single, depth)]
        rates, bootstrap, forests = [], [], []
        for k in kinds:
            size = max(n for _, n in shared[k])
            forests.append(range(len(rates), len(rates) + size))
            rates += [k[3]] * size
            bootstrap += [k[2]] * size
        grown = absolute_trees.grow(train, rates, bootstrap, label, key, depth, 1.0 if single else 1 / 3, seed, scale)
        counts = sorted({n for k in kinds for _, n in shared[k]})
        measured = absolute_trees.first_trees_metrics(grown, forests, test, counts, label)
        asked = [(run_id, n, trees) for n, k in enumerate(kinds) for run_id, trees in shared[k]]
        runs = train.sparkSession.createDataFrame(asked, "run_id int, forest int, trees int")
        found = F.create_map(*[c for m in ("rmse", "mape", "mae") for c in (F.lit(m), F.col(m))])
        parts.append(runs.join(measured, on=["forest", "trees"]).select("run_id", found.alias("__found")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    done = log.join(every, on="run_id", how="left")
    status = F.when(F.col("__found").isNotNull(), "finished").otherwise(F.col("status"))
    return done.withColumns({"metrics": F.coalesce("__found", "metrics"), "status": status}).select(*log.columns)


def tune(matrix: DataFrame, grid: Sequence[Mapping[str, object]], label: str = "stars", test_share: float = TUNING_SHARE, seed: int = SEED, partitions: int = models.FIT_PARTITIONS) -> DataFrame:
    """Drop the columns that hold a NULL, split, standardise by the training rows, search, and return the log."""
    rows = cut_lineage(matrix)
    fixed = models.FeatureList.fit(rows, NullPolicy("drop_columns"), label)
    train, test = (models.steady(fixed.assemble(part), partitions=partitions) for part in split(rows, test_share, seed))
    train, test = models.scale(train, test)
    return search(cut_lineage(train), cut_lineage(test), grid, label, seed, "standard")
