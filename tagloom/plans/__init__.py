"""Specs and the jobs made of them."""

from tagloom.context import RunContext
from tagloom.plans.job import JobResult, build, run_job, transform, with_metadata
from tagloom.plans.spec import ExportSpec, OutputSpec, ProcessingSpec

__all__ = [
    "ExportSpec",
    "JobResult",
    "OutputSpec",
    "ProcessingSpec",
    "RunContext",
    "build",
    "run_job",
    "transform",
    "with_metadata",
]
