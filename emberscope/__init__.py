"""Satellite fire detections on Spark: ingest, validate, cluster, enrich, export."""

from emberscope.config import Config, ImageryParams

__all__ = ["Config", "ImageryParams"]
