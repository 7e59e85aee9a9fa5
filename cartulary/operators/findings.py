"""Findings tables: unreadable documents, verdicts, totals and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.operators.links import FINDING_COLUMNS, check_documents, explode_findings, local_findings


def unreadable(parsed: DataFrame, doc: str = "doc", path: str = "path", error: str = "error") -> DataFrame:
    """Findings for empty documents and for those that could not be parsed."""
    checked = check_documents(parsed, doc, path, error).filter(F.col("unreadable").isNotNull())
    return explode_findings(checked)


def collect_findings(*tables: DataFrame) -> DataFrame:
    """All findings in one long table."""
    combined = tables[0].select(*FINDING_COLUMNS)
    for table in tables[1:]:
        combined = combined.unionByName(table.select(*FINDING_COLUMNS))
    return combined


def verdicts(
    checked: DataFrame, joined: DataFrame | None = None, check_urls: bool = True, unchecked: DataFrame | None = None
) -> DataFrame:
    """``path, n_findings, n_unchecked, valid`` for every document.

    Invalid means findings, valid that there are none; where nothing was found but links were not
    checked (``unchecked``, a row each), that is not known, and ``valid`` is null. Local findings are
    counted within the row. Those of the probe and entity joins, if
    any, are counted per document before they meet it, so both sides are unique.
    """
    local = F.size(local_findings(check_urls)).cast("bigint")
    counted = checked.select("path", local.alias("n_findings"), F.lit(0).cast("bigint").alias("n_unchecked"))
    remote = [] if joined is None else [joined.select("path", F.lit(1).alias("f"), F.lit(0).alias("u"))]
    remote += [] if unchecked is None else [unchecked.select("path", F.lit(0).alias("f"), F.lit(1).alias("u"))]
    if remote:
        rows = remote[0] if len(remote) == 1 else remote[0].unionByName(remote[1])
        more = rows.groupBy("path").agg(F.sum("f").alias("f"), F.sum("u").alias("u"))
        total = F.col("n_findings") + F.coalesce("f", F.lit(0))
        counted = counted.join(more, "path", "left").select("path", total.alias("n_findings"), F.coalesce("u", F.lit(0)).alias("n_unchecked"))
    known = F.when((F.col("n_findings") > 0) | (F.col("n_unchecked") == 0), F.col("n_findings") == 0)
    return counted.withColumn("valid", known)


def totals(checked: DataFrame, n_findings: Column, n_unchecked: Column | None = None) -> DataFrame:
    """One row: valid and invalid documents, and findings in all; with ``n_unchecked`` also ``n_undecided``, documents
    without findings whose links were not all checked, and links not checked."""
    open_links = F.lit(0) if n_unchecked is None else n_unchecked
    more = [] if n_unchecked is None else [
        F.count_if((n_findings == 0) & (open_links > 0)).alias("n_undecided"),
        F.coalesce(F.sum(open_links.cast("bigint")), F.lit(0)).alias("n_unchecked"),
    ]
    return checked.agg(
        F.count_if((n_findings == 0) & (open_links == 0)).alias("n_valid"),
        F.count_if(n_findings > 0).alias("n_invalid"),
        *more,
        F.coalesce(F.sum(n_findings.cast("bigint")), F.lit(0)).alias("n_findings"),
    )


# A word in the message, whether its case counts, and the class it stands for.
FINDING_CLASSES = [
    ("HTTP", True, "HTTP errors"),
    ("wikidata", False, "Wikidata errors"),
    ("URL", True, "URL format errors"),
]
OTHER_CLASS = "Other errors"
REST_MESSAGE = "... and %d more errors"


def finding_class(message: Column) -> Column:
    """Class by the wording of the message, the first hit counts."""
    found = F
    for word, exact, name in FINDING_CLASSES:
        found = found.when(F.contains(message if exact else F.lower(message), F.lit(word)), name)
    return found.otherwise(OTHER_CLASS)


def histogram(findings: DataFrame, message: str = "message") -> DataFrame:
    return (
        findings.groupBy(finding_class(F.col(message)).alias("finding_class"))
        .agg(F.count("*").alias("n"))
        .orderBy("finding_class")
    )


def relative_path(path: Column, root: str) -> Column:
    prefix = F.lit(root.rstrip("/") + "/")
    rest = F.substr(path, F.length(prefix) + 1)
    return F.when(F.startswith(path, prefix), rest).otherwise(path)


def first_findings(findings: DataFrame, n: int = 100, root: str | None = None) -> DataFrame:
    """The first ``n`` findings in path order, and a last row for how many more there are.

    The top n is taken per task and merged; the count is a plain aggregate.
    """
    path = F.col("path") if root is None else relative_path(F.col("path"), root)
    top = (
        findings.select(path.alias("path"), "ordinal", "message")
        .orderBy("path", "ordinal", "message")
        .limit(n)
    )
    rest = (
        findings.agg((F.count("*") - n).alias("more"))
        .filter(F.col("more") > 0)
        .select(
            F.lit(None).cast("string").alias("path"),
            F.lit(None).cast("bigint").alias("ordinal"),
            F.format_string(REST_MESSAGE, "more").alias("message"),
        )
    )
    return top.unionByName(rest)
