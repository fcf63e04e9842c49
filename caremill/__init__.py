"""Spark DataFrame operators for coded event records: reading, cleaning, numbering, vocabulary, eras, coverage, checks."""

from caremill.plans.convert import convert, coverage_report, validate, validation_report
from caremill.operators.quality import triage_results as triage

__all__ = ["convert", "coverage_report", "triage", "validate", "validation_report"]
