"""Named queries: each binds operators to the driver tables and carries its
DuckDB twin (``oracle_sql``) when the result is expressible in plain SQL."""

from .registry import REGISTRY, oracle_sql, queries  # noqa: F401
from . import (series_plans, profile_plans, clean_plans, table_plans,  # noqa: F401
               sampling_plans, metric_plans, text_plans, model_plans, source_plans,
               stream_plans, image_plans)
