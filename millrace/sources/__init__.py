from millrace.sources.catalog import SCHEMAS, load
from millrace.sources.sink import save, scratch_dir, stage, stage_all

__all__ = ["SCHEMAS", "load", "save", "scratch_dir", "stage", "stage_all"]
