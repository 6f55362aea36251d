"""Retail analytics on Spark: star schema, marts, features, models and scoring."""

from tidemart.session import build_session, shared_dir, tune
from tidemart.sources.star import Star, load_star

__all__ = ["Star", "build_session", "load_star", "shared_dir", "tune"]
