"""Monthly customer segmentation over retail sales, written for Spark."""

from clientela.config import FeatureSetConfig, OutlierRule, RunConfig
from clientela.sources.tables import Sources

__all__ = ["FeatureSetConfig", "OutlierRule", "RunConfig", "Sources"]
