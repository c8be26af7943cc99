"""Whole pipelines (V1, V2, V3) and the registry of fixture queries."""

from .pipelines import REFERENCE, Roles, pipeline_v1, pipeline_v2, pipeline_v3, v3_join, warehouse

__all__ = ["REFERENCE", "Roles", "pipeline_v1", "pipeline_v2", "pipeline_v3", "v3_join", "warehouse"]
