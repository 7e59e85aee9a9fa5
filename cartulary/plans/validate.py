"""Validation plan: parsed documents → findings, verdicts and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.operators.findings import (
    collect_findings,
    first_findings,
    histogram,
    totals,
    verdicts,
)
from cartulary.operators.links import check_documents, entity_findings, explode_findings, probe_findings, probe_results
from cartulary.session import enable_checkpoints


@dataclass
class Validation:
    findings: DataFrame
    verdicts: DataFrame

    def totals(self) -> DataFrame:
        return totals(self.verdicts, F.col("n_findings"), F.col("n_unchecked"))

    def histogram(self) -> DataFrame:
        return histogram(self.findings)

    def report(self, n: int = 100, root: str | None = None) -> DataFrame:
        return first_findings(self.findings, n, root)


def validate(
    parsed: DataFrame,
    probes: DataFrame | None = None,
    labels: DataFrame | None = None,
    check_urls: bool = True,
    at: Column | None = None,
    max_age: Column | None = None,
) -> Validation:
    """Validate parsed documents (``path, doc, error``).

    With ``at`` the latest probe of a link up to then counts, and none older than ``max_age``.
    A document whose links were not all checked has no verdict unless something was found.

    Without ``probes`` and ``labels`` those checks are off and nothing shuffles: findings
    and verdicts are row-local. With them the checked rows, which are read several times,
    are written to the checkpoint folder, so documents are parsed once.
    """
    checked = check_documents(parsed)
    if probes is not None or labels is not None:
        enable_checkpoints(parsed.sparkSession)
        checked = checked.checkpoint()
    joined, unchecked = [], None
    if probes is not None:
        results = probe_results(checked, probes, at, max_age)
        joined.append(probe_findings(results))
        unchecked = results.filter(F.col("ok").isNull())
    if labels is not None:
        joined.append(entity_findings(checked, labels))
    findings = collect_findings(explode_findings(checked, check_urls), *joined)
    remote = collect_findings(*joined) if joined else None
    return Validation(findings, verdicts(checked, remote, check_urls, unchecked))
