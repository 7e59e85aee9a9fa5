"""Validation of the links and the entity id of a document.

Everything that needs the document alone is a row-local expression. Probe results and
entity labels are tables, joined by URL and by id.

A checked frame has ``entity_id, path, error, unreadable, links, ids, wikidata_id, name``
where ``links`` is an array of ``LINK`` structs. Findings have ``entity_id, path, ordinal, rule, position,
message``; ``ordinal`` orders the findings of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.plan import compute_once
from cartulary.functions.text import entity_id, quoted_list, similar_names, valid_entity_id, well_formed_url
from cartulary.functions.variants import (
    as_elements,
    as_fields,
    as_text,
    as_variant,
    field,
    is_bool,
    is_falsy,
    is_null,
    is_number,
    is_object,
    is_string,
    kind,
    truthy_text,
)

LINK = "struct<position:int,url:string,type:string,fault:string,qid:string,route:string>"
FINDING = "struct<ordinal:bigint,rule:string,position:int,message:string>"
FINDING_COLUMNS = ["entity_id", "path", "ordinal", "rule", "position", "message"]

# Hosts with a route of their own, and the texts of findings.
ENTITY_HOST = "wikidata.org"
HEAD_ONLY_HOST = "wikipedia.org"
ENTITY_LINK_TYPE = "wikidata"
UNKNOWN_ENTITY = "UNKNOWN"
MESSAGES = {
    "empty_document": "File is empty or contains only null",
    "parse_error": "Error: %s",
    "yaml_error": "YAML error: %s",
    "link_format": "Link %d: Invalid format (not a dictionary)",
    "link_url": "Link %d: Missing URL",
    "link_type": "Link %d: Missing type",
    "link_entity_id": "Link %d (%s): Could not extract Q-number from URL: %s",
    "url_check": "Link %d (%s): %s - %s",
    "id_format": "wikidata_id has invalid format: %s",
    "id_mismatch": "wikidata_id (%s) doesn't match any wikidata link Q-numbers: %s",
    "id_missing": "Has wikidata link(s) but no wikidata_id field. Q-numbers found: %s",
    "entity_not_found": "wikidata_id validation: Entity %s not found in Wikidata",
    "entity_name_mismatch": "wikidata_id validation: Name mismatch: Wikidata label is '%s', entity name is '%s'",
}
# What stops a check half-way, and how values are called there.
STOPPED = {
    "not_an_object": "the document is no object but of type %s",
    "links_not_a_list": "the links are no list but of type %s",
}
TYPE_NAMES = {"BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "VOID": "null"}
PROBLEMS = {
    "invalid": "Invalid URL format",
    "timeout": "Request timeout",
    "connection": "Connection error",
    "status": "HTTP %d",
}
# Findings about the document as a whole come after those of its links.
AFTER_LINKS = 1 << 40


def link_fault(link: Column) -> Column:
    """First structural fault of a link, NULL when it has none."""
    return (
        F.when(~is_object(link), "format")
        .when(truthy_text(field(link, "url")) == "", "url")
        .when(truthy_text(field(link, "type")) == "", "type")
    )


def check_route(url: Column) -> Column:
    """How a URL is checked: ``invalid``, ``entity``, ``head`` or ``head_then_get``."""
    return (
        F.when(~well_formed_url(url), "invalid")
        .when(F.contains(url, F.lit(ENTITY_HOST)), "entity")
        .when(F.contains(url, F.lit(HEAD_ONLY_HOST)), "head")
        .otherwise("head_then_get")
    )


def link_entries(links: Column) -> Column:
    """array<LINK> with 1-based positions from a VARIANT list of links."""

    def entry(link: Column, i: Column) -> Column:
        url, kind = truthy_text(field(link, "url")), truthy_text(field(link, "type"))
        fault = link_fault(link)
        sound = fault.isNull()
        return F.struct(
            (i + 1).alias("position"),
            url.alias("url"),
            kind.alias("type"),
            fault.alias("fault"),
            F.when(sound & (kind == ENTITY_LINK_TYPE), entity_id(url)).alias("qid"),
            F.when(sound, check_route(url)).alias("route"),
        ).cast(LINK)

    # Of an object the keys count as entries, of a text the characters; none is a link.
    keys = F.map_keys(as_fields(links))
    characters = F.when(is_string(links), F.filter(F.split(as_text(links), ""), lambda c: c != ""))
    others = F.transform(F.coalesce(keys, characters), as_variant)
    entries = F.transform(F.coalesce(as_elements(links), others), entry)
    return F.coalesce(entries, F.array().cast(f"array<{LINK}>"))


def positioned_links(df: DataFrame, doc: str, keep: list[str]) -> DataFrame:
    """One row per link with its 1-based position; documents without links keep one row."""
    entries = link_entries(field(F.col(doc), "links"))
    exploded = df.select(*keep, F.explode_outer(entries).alias("link"))
    return exploded.select(*keep, "link.*")


def ids_in_links(links: Column) -> Column:
    """Entity ids of a document's links, in link order."""
    return F.filter(F.transform(links, lambda e: e["qid"]), lambda q: q.isNotNull())


def unreadable_rule(doc: Column, error: Column) -> Column:
    """Why a document cannot be checked; NULL when it can.

    ``parse_error``, ``empty_document``, ``not_an_object`` or ``links_not_a_list``. Such a
    document has this one finding.
    """
    links = field(doc, "links")
    return (
        F.when(error.isNotNull(), "parse_error")
        .when(is_falsy(doc), "empty_document")
        .when(~is_object(doc), "not_an_object")
        .when(is_null(links) | is_number(links) | is_bool(links), "links_not_a_list")
    )


def _type_name(value: Column) -> Column:
    found = F
    for name, wording in TYPE_NAMES.items():
        found = found.when(kind(value) == name, wording)
    return found.otherwise(F.lower(kind(value)))


def check_documents(parsed: DataFrame, doc: str = "doc", path: str = "path", error: str = "error") -> DataFrame:
    """The row-local part: what could not be read, links taken apart, ids collected."""
    value = F.col(doc)
    entity = truthy_text(field(value, "id"))
    checked = compute_once(
        parsed.select(F.col(path).alias("path"), value, F.col(error).alias("_error")),
        entity_id=F.when(entity == "", UNKNOWN_ENTITY).otherwise(entity),
        unreadable=unreadable_rule(value, F.col("_error")),
        links=link_entries(field(value, "links")),
        wikidata_id=truthy_text(field(value, "wikidata_id")),
        name=truthy_text(field(value, "name")),
    )
    reason = (
        F.when(F.col("unreadable") == "parse_error", F.col("_error"))
        .when(
            F.col("unreadable") == "not_an_object",
            F.format_string(STOPPED["not_an_object"], _type_name(value)),
        )
        .when(
            F.col("unreadable") == "links_not_a_list",
            F.format_string(STOPPED["links_not_a_list"], _type_name(field(value, "links"))),
        )
    )
    once = compute_once(checked, ids=ids_in_links(F.col("links")), error=reason)
    return once.select(
        "path", "entity_id", "unreadable", "error", "links", "ids", "wikidata_id", "name"
    )


def id_fault(wikidata_id: Column, ids: Column) -> Column:
    """``id_format``, ``id_mismatch`` or ``id_missing``; NULL when consistent."""
    return (
        F.when((wikidata_id != "") & ~valid_entity_id(wikidata_id), "id_format")
        .when((wikidata_id != "") & (F.size(ids) > 0) & ~F.array_contains(ids, wikidata_id), "id_mismatch")
        .when((wikidata_id == "") & (F.size(ids) > 0), "id_missing")
    )


def _message(rule: str, *values: Column) -> Column:
    return F.format_string(MESSAGES[rule], *values) if values else F.lit(MESSAGES[rule])


def _finding(ordinal: Column, rule: str, position: Column, message: Column) -> Column:
    return F.struct(
        ordinal.cast("bigint").alias("ordinal"),
        F.lit(rule).alias("rule"),
        position.cast("int").alias("position"),
        message.alias("message"),
    ).cast(FINDING)


def _link_finding(link: Column) -> Column:
    """The finding about the make-up of a link, NULL when there is none."""
    place = link["position"]
    found = F
    for fault in ("format", "url", "type"):
        rule = f"link_{fault}"
        found = found.when(link["fault"] == fault, _finding(place * 2, rule, place, _message(rule, place)))
    without_id = (link["type"] == ENTITY_LINK_TYPE) & link["qid"].isNull()
    message = _message("link_entity_id", place, link["type"], link["url"])
    return found.when(without_id, _finding(place * 2, "link_entity_id", place, message))


def _url_finding(link: Column) -> Column:
    place = link["position"]
    message = _message("url_check", place, link["type"], F.lit(PROBLEMS["invalid"]), link["url"])
    return F.when(link["route"] == "invalid", _finding(place * 2 + 1, "url_format", place, message))


def _document_finding() -> Column:
    """The finding about an unreadable document or its entity id, NULL when there is none."""
    nowhere = F.lit(None).cast("int")
    unread, fault = F.col("unreadable"), id_fault(F.col("wikidata_id"), F.col("ids"))
    listed = quoted_list(F.col("ids"))
    start, end = F.lit(0), F.lit(AFTER_LINKS)
    # A YAML parser's own wording already has its prefix.
    worded = F.startswith("error", F.lit(MESSAGES["yaml_error"].removesuffix("%s")))
    reason = F.when(worded, F.col("error")).otherwise(_message("parse_error", F.col("error")))
    stopped = F
    for rule in ("parse_error", *STOPPED):
        stopped = stopped.when(unread == rule, _finding(start, rule, nowhere, reason))
    return (
        stopped.when(unread == "empty_document", _finding(start, "empty_document", nowhere, _message("empty_document")))
        .when(fault == "id_format", _finding(end, "id_format", nowhere, _message("id_format", F.col("wikidata_id"))))
        .when(
            fault == "id_mismatch",
            _finding(end, "id_mismatch", nowhere, _message("id_mismatch", F.col("wikidata_id"), listed)),
        )
        .when(fault == "id_missing", _finding(end + 2, "id_missing", nowhere, _message("id_missing", listed)))
    )


def local_findings(check_urls: bool = True) -> Column:
    """array<FINDING> of a checked row: unreadable document, or link faults, ids, and
    malformed URLs if asked."""
    tests = [_link_finding, _url_finding] if check_urls else [_link_finding]
    of_links = F.flatten(F.transform("links", lambda link: F.array(*[test(link) for test in tests])))
    of_links = F.when(F.col("unreadable").isNull(), of_links).otherwise(F.array().cast(f"array<{FINDING}>"))
    return F.array_compact(F.concat(of_links, F.array(_document_finding())))


def explode_findings(checked: DataFrame, check_urls: bool = True) -> DataFrame:
    return checked.select("entity_id", "path", F.inline(local_findings(check_urls)))


def latest_probes(asked: DataFrame, probes: DataFrame, max_age: Column | None = None) -> DataFrame:
    """``url, at, head, get``: of each method the latest probe made at or before ``at``.

    ``asked`` has distinct ``url, at``, ``probes`` also ``probed_at``. A probe older than
    ``max_age`` (an interval) at that time is stale and does not count. Of probes of one
    time the one with the greatest status counts. Each pair keeps one candidate per task before the shuffle.
    """
    taken = F.col("probed_at") <= F.col("at")
    if max_age is not None:
        taken = taken & (F.col("probed_at") >= F.col("at") - max_age)
    shot = F.struct("status", "error")
    order = F.struct("probed_at", F.coalesce("status", F.lit(-1)), F.coalesce("error", F.lit("")))
    return (
        asked.join(probes, "url")
        .filter(taken)
        .groupBy("url", "at")
        .agg(*[F.max_by(shot, F.when(F.col("method") == m.upper(), order)).alias(m) for m in ("head", "get")])
    )


def probe_outcomes(links: DataFrame, probes: DataFrame, at: Column | None = None, max_age: Column | None = None) -> DataFrame:
    """Attach the outcome of probing to links that carry ``url`` and ``route``.

    ``probes``: ``url, method, status, error``, and ``probed_at`` if there are several of a URL
    and method: with ``at``, a time (of the check, or of each link), the latest up to then counts,
    unless it is older than ``max_age``. The methods of one URL are folded into one
    row first, so each link meets one row. Adds ``ok, status, problem``; a link without the probe it
    needs is not checked and has a NULL ``ok``.
    """
    if at is None:
        shots = [
            F.max(F.when(F.col("method") == method.upper(), F.struct("status", "error"))).alias(method)
            for method in ("head", "get")
        ]
        joined = links.join(probes.groupBy("url").agg(*shots), "url", "left")
    else:
        timed = links.withColumn("at", at)
        joined = timed.join(latest_probes(timed.select("url", "at").distinct(), probes, max_age), ["url", "at"], "left").drop("at")
    second = (F.col("route") == "head_then_get") & F.col("head.error").isNull() & (F.col("head.status") == 405)
    shot = F.when(second, F.col("get")).otherwise(F.col("head"))
    fetched = F.col("route").isin("head", "head_then_get")
    failed = F.col("_shot.error").isNotNull()
    status = F.when(failed, 0).otherwise(F.col("_shot.status"))
    good = (status == 200) | ((status >= 300) & (status < 400))
    worded = F.col("route") == "head_then_get"
    problem = (
        F.when(F.col("route") == "invalid", F.lit(PROBLEMS["invalid"]))
        .when(fetched & failed & worded & (F.col("_shot.error") == "timeout"), F.lit(PROBLEMS["timeout"]))
        .when(fetched & failed & worded & (F.col("_shot.error") == "connection"), F.lit(PROBLEMS["connection"]))
        .when(fetched & failed, F.col("_shot.error"))
        .when(fetched & ~good, F.format_string(PROBLEMS["status"], status))
    )
    return (
        joined.withColumn("_shot", shot)
        .withColumn(
            "ok",
            F.when(F.col("route") == "entity", True)
            .when(F.col("route") == "invalid", False)
            .when(F.col("_shot").isNotNull(), ~failed & good),
        )
        .withColumn(
            "status",
            F.when(F.col("route") == "entity", 200).when(F.col("route") == "invalid", 0).otherwise(status),
        )
        .withColumn("problem", F.when(~F.col("ok"), problem))
        .drop("head", "get", "_shot")
    )


def probe_results(checked: DataFrame, probes: DataFrame, at: Column | None = None, max_age: Column | None = None) -> DataFrame:
    """Outcomes of all links that need a probe; malformed URLs are found row-locally."""
    links = checked.select("entity_id", "path", F.inline("links")).filter(
        F.col("route").isin("head", "head_then_get")
    )
    return probe_outcomes(links, probes, at, max_age)


def probe_findings(results: DataFrame) -> DataFrame:
    """Findings of links whose probe failed."""
    return results.filter(~F.col("ok")).select(
        "entity_id",
        "path",
        (F.col("position") * 2 + 1).cast("bigint").alias("ordinal"),
        F.lit("url_probe").alias("rule"),
        "position",
        F.format_string(MESSAGES["url_check"], "position", "type", "problem", "url").alias("message"),
    )


def entity_outcomes(entities: DataFrame, labels: DataFrame) -> DataFrame:
    """Look up ``qid`` (with ``name``) in ``labels``: ``qid, label, missing``.

    Adds ``label`` and ``verdict``: ``not_found``, ``name_mismatch`` or ``ok``. ``labels``
    has one row per id and may be as large as the entities, so no side is forced into a
    broadcast; an id that many rows share is split at run time.
    """
    known = labels.select("qid", "label", F.coalesce("missing", F.lit(False)).alias("_missing"))
    joined = entities.join(known, "qid", "left")
    verdict = (
        F.when(F.col("_missing").isNull() | F.col("_missing"), "not_found")
        .when(~similar_names(F.col("name"), F.col("label")), "name_mismatch")
        .otherwise("ok")
    )
    return joined.withColumn("verdict", verdict).drop("_missing")


def entity_findings(checked: DataFrame, labels: DataFrame) -> DataFrame:
    """Findings of the entity check, for documents with a name and a well-formed id."""
    sound = F.col("unreadable").isNull() & valid_entity_id(F.col("wikidata_id"))
    asked = checked.filter(sound & (F.col("name") != "")).select(
        "entity_id", "path", F.col("wikidata_id").alias("qid"), "name"
    )
    failed = entity_outcomes(asked, labels).filter(F.col("verdict") != "ok")
    message = F.when(F.col("verdict") == "not_found", _message("entity_not_found", F.col("qid"))).otherwise(
        _message("entity_name_mismatch", F.col("label"), F.col("name"))
    )
    return failed.select(
        "entity_id",
        "path",
        F.lit(AFTER_LINKS + 1).cast("bigint").alias("ordinal"),
        F.concat(F.lit("entity_"), F.col("verdict")).alias("rule"),
        F.lit(None).cast("int").alias("position"),
        message.alias("message"),
    )
