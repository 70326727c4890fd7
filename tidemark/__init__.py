"""Daily marketplace snapshots on Spark: ingest, label, features, models, decisions."""

from tidemark.session import checkpoint_root, get_session, stage_table

__all__ = ["checkpoint_root", "get_session", "stage_table"]
