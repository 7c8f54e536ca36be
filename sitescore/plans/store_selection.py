"""One plan from stores with ratings and listings with addresses to a ranking by a trained model."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.ml import models
from sitescore.operators import features, geocode, rank
from sitescore.operators.columns import expand, keep_keys
from sitescore.operators.geofence import geofence
from sitescore.operators.sampling import SEED, TEST_SHARE, split
from sitescore.plans.site_selection import SiteFeatures, prepare, rank_candidates
from sitescore.session import cut_lineage


@dataclass(frozen=True)
class TrainedStores:
    """What training on fenced stores leaves for scoring.

    ``labelled`` is (site_id, label, in_test) of all rows of the matrix,
    ``held_out`` the errors on the test rows.
    """

    model: Model
    fixed: models.FeatureList
    labelled: DataFrame
    held_out: DataFrame
    lowest: float
    highest: float


@dataclass(frozen=True)
class StoreSelection:
    """Fences, features, training and scoring by one rule for stores and listings.

    ``boundary`` adds a ``polygon`` to sites with (site_id, x, y): an octagon, the
    outline of reached roads, or any other. The addresses and what is known about
    them come from ``surroundings``.
    """

    surroundings: SiteFeatures
    boundary: Callable[[DataFrame], DataFrame]

    def fence(self, sites: DataFrame) -> DataFrame:
        """Written (site_id, addr_id) of the addresses around each site; sites without a key are left out."""
        known = sites.where(F.col("site_id").isNotNull())
        return cut_lineage(geofence(self.boundary(known), self.surroundings.fabric))

    def locate(self, listings: DataFrame, key: str = "listing_id", fuzzy: bool = True) -> DataFrame:
        """Written sites at the addresses that were found, with the other columns of ``listings``."""
        coded = geocode.geocode(listings, self.surroundings.fabric, fuzzy=fuzzy)
        found = expand(coded, "geocode_result").withColumnRenamed(key, "site_id")
        return cut_lineage(found.drop("addr_id", "precision", "error"))

    def train(
        self, stores: DataFrame, labels: DataFrame, params: Mapping[str, object] | None = None, test_share: float = TEST_SHARE, seed: int = SEED
    ) -> TrainedStores:
        """Fit on the stores' surroundings; without any labelled store with both kinds of features there is an error."""
        matrix = cut_lineage(self.surroundings.matrix(self.fence(stores), labels))
        fixed, train, test = prepare(matrix, test_share, seed)
        label = fixed.label
        limits = train.agg(F.min(label).alias("lowest"), F.max(label).alias("highest")).first()
        if limits.lowest is None:
            raise ValueError("no labelled store with features is left for training")
        model, held_out = models.train_final(train, test, params, label, seed)
        # the rule of the split, on the keys that training saw
        fitted, _ = split(matrix.select("site_id", label), test_share, seed)
        in_test = matrix.select("site_id", label).join(fitted.select("site_id", F.lit(False).alias("in_test")), on="site_id", how="left")
        labelled = in_test.withColumn("in_test", F.coalesce("in_test", F.lit(True)))
        return TrainedStores(model, fixed, labelled, held_out, limits.lowest, limits.highest)

    def rank(self, trained: TrainedStores, sites: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
        """Located sites by combined score of predicted label, local sales, price and size, best first.

        Only sites with both kinds of features are scored; address and place stay
        on the row. Each site is scored under its own key.
        """
        around = self.fence(sites)
        matrix = cut_lineage(self.surroundings.matrix(around))
        sales = features.local_sales(around, self.surroundings.fabric, self.surroundings.poi)
        attributes = keep_keys(sites, matrix, "site_id")
        ranked = rank_candidates(trained.model, trained.fixed, matrix, attributes.select("site_id", "price", "size_sqft"), sales, weights)
        return rank.with_attributes(ranked, attributes.select("site_id", "formatted_address", "x", "y"), "score")
