"""Model graph: raw sources -> staging -> journey -> mart / features.

``Models`` builds each model's plan lazily, once. ``build_all`` runs the
graph as a batch job: models are written as tables (in dependency order),
every downstream model reads its inputs back from the written tables (so no
plan's lineage reaches further back than the previous table and a lost executor
only recomputes one stage of one model), and all are published together.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures
from ..sources.readers import read_raw_sources
from ..sources.sinks import bucketed, checkpoint_base
from ..sources.tables import Store
from . import campaign, features, journey, staging

MODEL_ORDER = (
    "stg_marketing_spend",
    "stg_marketing_campaigns",
    "stg_dim_user",
    "stg_user_activity",
    "fct_user_journey",
    "mart_campaign_performance",
    "user_features",
)


class Models:
    """Lazy model plans over a dict of raw source frames."""

    def __init__(self, raw: dict[str, DataFrame], overrides: dict[str, DataFrame] | None = None):
        self.raw = raw
        self._overrides = overrides or {}

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> Models:
        return cls(fixtures.raw_sources(spark, sf_dir))

    @classmethod
    def from_raw_files(cls, spark: SparkSession, base: str, fmt: str = "csv") -> Models:
        return cls(read_raw_sources(spark, base, fmt))

    def _get(self, name: str, make):
        return self._overrides.get(name) if name in self._overrides else make()

    @cached_property
    def stg_marketing_spend(self) -> DataFrame:
        return self._get("stg_marketing_spend", lambda: staging.stg_marketing_spend(self.raw["marketing_spend"]))

    @cached_property
    def stg_marketing_campaigns(self) -> DataFrame:
        return self._get(
            "stg_marketing_campaigns", lambda: staging.stg_marketing_campaigns(self.raw["marketing_campaigns"])
        )

    @cached_property
    def stg_dim_user(self) -> DataFrame:
        return self._get("stg_dim_user", lambda: staging.stg_dim_user(self.raw["dim_user"]))

    @cached_property
    def stg_user_activity(self) -> DataFrame:
        return self._get("stg_user_activity", lambda: staging.stg_user_activity(self.raw["user_activity"]))

    @cached_property
    def fct_user_journey(self) -> DataFrame:
        return self._get(
            "fct_user_journey", lambda: journey.fct_user_journey(self.stg_user_activity, self.stg_dim_user)
        )

    @cached_property
    def mart_campaign_performance(self) -> DataFrame:
        return self._get(
            "mart_campaign_performance",
            lambda: campaign.mart_campaign_performance(
                self.fct_user_journey, self.stg_marketing_campaigns, self.stg_marketing_spend
            ),
        )

    @cached_property
    def user_features(self) -> DataFrame:
        return self._get(
            "user_features", lambda: features.user_features(self.fct_user_journey, self.stg_marketing_campaigns)
        )

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)


# user-keyed models: bucketed alike, the journey reads them co-partitioned
USER_KEYED = ("stg_user_activity", "stg_dim_user")


def build_all(raw: dict[str, DataFrame], base: str | None = None, checks=None,
              user_buckets: int | None = None) -> Models:
    """Write every model in dependency order, each planned over the tables just
    written, then publish them all in one step (``tables.Store`` under
    ``base``, by default a folder of its own in the checkpoint dir).
    ``checks(models, name)`` sees a model before anyone else does and may
    raise: nothing that depends on it is built then, and readers keep the
    models of the last build that passed.

    With ``user_buckets``, the user-keyed staging tables are written bucketed
    by ``user_id`` into that many buckets, so the journey's aggregations and
    joins read them co-partitioned, with no exchange (size the count so a
    bucket is a few hundred MB)."""
    spark = next(iter(raw.values())).sparkSession
    store = Store(spark, base or f"{checkpoint_base(spark)}/models")
    entries: dict[str, dict] = {}
    written: dict[str, DataFrame] = {}
    for name in MODEL_ORDER:
        plan = Models(raw, written).get(name)
        write = bucketed(name, "user_id", user_buckets) if user_buckets and name in USER_KEYED else None
        entries[name] = store.stage(plan, name, write)
        written[name] = store.read_version(name, entries[name])
        if checks is not None:
            checks(Models(raw, written), name)
    store.publish(entries)
    return Models(raw, written)
