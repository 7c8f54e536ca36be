"""The whole way from sites to features, models and a ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame

from sitescore.ml import models
from sitescore.operators import features, rank
from sitescore.operators.balance import FIND, hot_keys
from sitescore.operators.enrich import FeatureSource
from sitescore.operators.sampling import SEED, TEST_SHARE, split
from sitescore.session import cut_lineage


@dataclass(frozen=True)
class SiteFeatures:
    """What describes the surroundings of a site, for training and scoring alike."""

    fabric: DataFrame
    poi: DataFrame
    sources: Sequence[FeatureSource]
    columns: dict[str, list[str]]
    code_source: str
    brand: str
    group: str

    def business(self, bridge: DataFrame, hot: DataFrame | str | None = FIND) -> DataFrame:
        return features.business(bridge, self.fabric, self.poi, self.brand, self.group, hot=hot)

    def residential(self, bridge: DataFrame, hot: DataFrame | str | None = FIND) -> DataFrame:
        return features.residential(bridge, self.fabric, self.sources, self.columns, self.code_source, hot=hot)

    def matrix(self, bridge: DataFrame, labels: DataFrame | None = None) -> DataFrame:
        """One row per site with both kinds of features, and labels if given.

        The bridge feeds several joins, so it is written once and read back, and
        its frequent addresses are counted once.
        """
        narrow = cut_lineage(bridge.select("site_id", "addr_id"))
        hot = hot_keys(narrow, None, ["addr_id"])
        shops = self.business(narrow, hot)
        if labels is not None:
            shops = features.with_labels(shops, labels)
        return features.training_matrix(shops, self.residential(narrow, hot))


def prepare(matrix: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED, partitions: int = models.FIT_PARTITIONS) -> tuple[models.FeatureList, DataFrame, DataFrame]:
    """(feature list, train vectors, test vectors), written in a steady order over ``partitions``."""
    rows = cut_lineage(matrix)
    fixed = models.FeatureList.fit(rows)
    train, test = split(rows, test_share, seed)
    return fixed, models.steady(fixed.assemble(train), partitions=partitions), models.steady(fixed.assemble(test), partitions=partitions)


def score_sites(model: Model, fixed: models.FeatureList, candidates: DataFrame) -> DataFrame:
    """(site_id, stars_score) of candidate feature rows."""
    return models.score(model, fixed.assemble(candidates)).withColumnRenamed("prediction", "stars_score")


def rank_candidates(
    model: Model,
    fixed: models.FeatureList,
    candidates: DataFrame,
    attributes: DataFrame,
    sales: DataFrame,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """Candidates by combined score of prediction, sales, price and size."""
    scored = score_sites(model, fixed, candidates)
    metrics = scored.join(attributes, on="site_id", how="left").join(sales, on="site_id", how="left")
    return rank.combined_score(metrics, weights)
