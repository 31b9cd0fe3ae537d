"""sluice: Spark-native ingestion, data quality and pipeline metrics (DataFrame in, DataFrame out)."""

from sluice.operators.bronze import bronze_transform, standardize
from sluice.operators.quality import gate, quality_report, validate
from sluice.plans.ingest import IngestConfig, daily_run, ingest_all, ingest_summary
from sluice.session import checkpoint_root, cluster_conf
from sluice.sources.csv import read_raw_csv, scan_csv
from sluice.specs import PRESETS, REGISTRY, TableSpec, Thresholds

__all__ = [
    "IngestConfig",
    "PRESETS",
    "REGISTRY",
    "TableSpec",
    "Thresholds",
    "bronze_transform",
    "checkpoint_root",
    "cluster_conf",
    "daily_run",
    "gate",
    "ingest_all",
    "ingest_summary",
    "quality_report",
    "read_raw_csv",
    "scan_csv",
    "standardize",
    "validate",
]
