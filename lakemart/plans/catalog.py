"""All models of the admission marts."""

from __future__ import annotations

from lakemart.plans import applications, codes, dw, gen, int1, organisations, pub, stg  # noqa: F401
from lakemart.plans.model import MODELS, evaluate, in_order, run, sources_from
from lakemart.plans.stg import raw_defaults, raw_tables

__all__ = ["MODELS", "evaluate", "in_order", "raw_defaults", "raw_tables", "run", "sources_from"]
