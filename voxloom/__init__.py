"""voxloom: curation of multi-source speech corpora on Spark.

Sources are described by :class:`~voxloom.specs.SourceSpec`; plans in
:mod:`voxloom.plans` and :mod:`voxloom.streaming` turn raw files into one
corpus table with quality metrics, drop reasons and reports.
"""

from .specs import REGISTRY, SignalParams, SourceSpec, spec_for

__all__ = ["REGISTRY", "SignalParams", "SourceSpec", "spec_for"]
