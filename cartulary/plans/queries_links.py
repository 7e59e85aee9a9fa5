"""Queries for link and identity validation.

Documents are made from ``pages``: the page URL, faulty entries by language, an entity
link on secure pages, and all hrefs of the whole HTML as further links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.text import similar_names, well_formed_url
from cartulary.operators.findings import (
    collect_findings,
    first_findings,
    histogram,
    totals,
    unreadable,
)
from cartulary.operators.links import (
    check_documents,
    check_route,
    entity_outcomes,
    explode_findings,
    id_fault,
    local_findings,
    positioned_links,
    probe_outcomes,
)
from cartulary.plans.queries_documents import docs
from cartulary.plans.registry import Tables, arr, obj, query, quote
from cartulary.plans.validate import Validation, validate
from cartulary.sources.documents import parse_documents

HREF = r'href="([^"]*)"'

# The same documents, as lists of structs.
LINKS_SQL = r"""
p AS (
  SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)', 1) AS seg,
         starts_with(url, 'https:') AS secure, regexp_extract(url, 'example\.([a-z]+)', 1) AS tld,
         regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs
  FROM pages),
d AS (
  SELECT page_id, 'P' || page_id AS entity_id, seg,
         CASE WHEN tld = 'com' THEN 'Q' || page_id WHEN tld = 'net' THEN 'Q' || (page_id + 1)
              WHEN NOT secure THEN 'X1' ELSE '' END AS wikidata_id,
         list_concat(
           CASE WHEN seg = 'fr' THEN [{'o': false, 'url': '', 'type': ''}] ELSE [] END,
           [{'o': true, 'url': url, 'type': 'website'}],
           CASE WHEN seg = 'de' THEN [{'o': true, 'url': '', 'type': 'wikipedia'}] ELSE [] END,
           CASE WHEN seg = 'es' THEN [{'o': true, 'url': url, 'type': ''}] ELSE [] END,
           CASE WHEN secure THEN [{'o': true, 'type': 'wikidata', 'url':
             'https://www.wikidata.org/wiki/' || CASE WHEN seg = 'es' THEN 'x' ELSE 'Q' || page_id END}] ELSE [] END,
           list_transform(hrefs, lambda h: {'o': true, 'url': h, 'type': 'website'})) AS links,
         CASE WHEN secure AND seg <> 'es' THEN 'Q' || page_id END AS qid
  FROM p),
l AS (
  SELECT page_id, entity_id, generate_subscripts(links, 1) AS position, unnest(links) AS link FROM d),
e AS (
  SELECT page_id, entity_id, CAST(position AS INTEGER) AS position, link.url AS url, link.type AS type,
         CASE WHEN NOT link.o THEN 'format' WHEN link.url = '' THEN 'url' WHEN link.type = '' THEN 'type' END AS fault,
         CASE WHEN link.type = 'wikidata' THEN nullif(regexp_extract(link.url, '(Q[0-9]+)', 1), '') END AS qid
  FROM l),
g AS (
  SELECT page_id, entity_id, wikidata_id, qid,
         CASE WHEN wikidata_id <> '' AND NOT regexp_matches(wikidata_id, '^Q[0-9]+$') THEN 'id_format'
              WHEN wikidata_id <> '' AND qid IS NOT NULL AND qid <> wikidata_id THEN 'id_mismatch'
              WHEN wikidata_id = '' AND qid IS NOT NULL THEN 'id_missing' END AS fault
  FROM d),
f AS (
  SELECT entity_id, CAST(position * 2 AS BIGINT) AS ordinal, 'link_' || fault AS rule, position,
         'Link ' || position || ': ' || CASE fault WHEN 'format' THEN 'Invalid format (not a dictionary)'
           WHEN 'url' THEN 'Missing URL' ELSE 'Missing type' END AS message
  FROM e WHERE fault IS NOT NULL
  UNION ALL
  SELECT entity_id, position * 2, 'link_entity_id', position,
         'Link ' || position || ' (wikidata): Could not extract Q-number from URL: ' || url
  FROM e WHERE fault IS NULL AND type = 'wikidata' AND qid IS NULL
  UNION ALL
  SELECT entity_id, position * 2 + 1, 'url_format', position,
         'Link ' || position || ' (' || type || '): Invalid URL format - ' || url
  FROM e WHERE fault IS NULL AND (regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) = ''
    OR regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) = '')
  UNION ALL
  SELECT entity_id, 1099511627776 + CASE WHEN fault = 'id_missing' THEN 2 ELSE 0 END, fault, NULL,
         CASE fault WHEN 'id_format' THEN 'wikidata_id has invalid format: ' || wikidata_id
           WHEN 'id_mismatch' THEN 'wikidata_id (' || wikidata_id || ') doesn''t match any wikidata link Q-numbers: ['''
             || qid || ''']'
           ELSE 'Has wikidata link(s) but no wikidata_id field. Q-numbers found: [''' || qid || ''']' END
  FROM g WHERE fault IS NOT NULL)
"""


def page_documents(t: Tables) -> DataFrame:
    """``path, page_id, doc, error``: one document per page."""
    segment = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)", 1)
    tld = F.regexp_extract("url", r"example\.([a-z]+)", 1)
    pages = t.pages.select(
        "page_id",
        "url",
        segment.alias("seg"),
        tld.alias("tld"),
        F.startswith("url", F.lit("https:")).alias("secure"),
        F.regexp_extract_all("html", F.lit(HREF), F.lit(1)).alias("hrefs"),
    )
    seg, page_id = F.col("seg"), F.col("page_id").cast("string")
    qid = F.concat(F.lit("Q"), page_id)
    entity_url = F.concat(F.lit("https://www.wikidata.org/wiki/"), F.when(seg == "es", "x").otherwise(qid))
    website = F.lit('"website"')
    hrefs = F.array_join(F.transform("hrefs", lambda h: obj(url=quote(h), type=website)), ",")
    links = F.concat_ws(
        ",",
        F.when(seg == "fr", '"bare"'),
        obj(url=quote(F.col("url")), type=website),
        F.when(seg == "de", '{"url":null,"type":"wikipedia"}'),
        F.when(seg == "es", obj(url=quote(F.col("url")))),
        F.when(F.col("secure"), obj(url=quote(entity_url), type=F.lit('"wikidata"'))),
        F.nullif(hrefs, F.lit("")),
    )
    wikidata_id = (
        F.when(F.col("tld") == "com", quote(qid))
        .when(F.col("tld") == "net", quote(F.concat(F.lit("Q"), (F.col("page_id") + 1).cast("string"))))
        .when(~F.col("secure"), '"X1"')
        .when(seg == "de", "null")
    )
    text = obj(
        id=quote(F.concat(F.lit("P"), page_id)),
        name=quote(seg),
        links=F.concat(F.lit("["), links, F.lit("]")),
        wikidata_id=wikidata_id,
    )
    path = F.concat(F.lit("/data/pages/"), seg, F.lit("/P"), page_id, F.lit(".json"))
    return parse_documents(pages.select(path.alias("path"), "page_id", text.alias("text")), "text").drop("text")


def page_links(t: Tables) -> DataFrame:
    return positioned_links(page_documents(t), "doc", ["page_id"])


def checked_pages(t: Tables) -> DataFrame:
    return check_documents(page_documents(t))


@query("v02_positioned_links", f"WITH {LINKS_SQL} SELECT page_id, position, url, type FROM e")
def links_with_positions(t: Tables) -> DataFrame:
    return page_links(t).select("page_id", "position", "url", "type")


@query("v03_link_structure", f"WITH {LINKS_SQL} SELECT page_id, position, fault FROM e WHERE fault IS NOT NULL")
def link_structure(t: Tables) -> DataFrame:
    return page_links(t).filter(F.col("fault").isNotNull()).select("page_id", "position", "fault")


@query("v04_entity_id_extraction", f"WITH {LINKS_SQL} SELECT page_id, position, qid FROM e WHERE type = 'wikidata'")
def entity_id_extraction(t: Tables) -> DataFrame:
    return page_links(t).filter(F.col("type") == "wikidata").select("page_id", "position", "qid")


@query("v05_ids_per_entity", f"WITH {LINKS_SQL} SELECT entity_id, coalesce(qid, '') AS ids FROM d")
def ids_per_entity(t: Tables) -> DataFrame:
    return checked_pages(t).select("entity_id", F.array_join("ids", ",").alias("ids"))


def id_faults(t: Tables, fault: str) -> DataFrame:
    found = id_fault(F.col("wikidata_id"), F.col("ids"))
    return checked_pages(t).filter(found == fault).select("entity_id", "wikidata_id", F.array_join("ids", ",").alias("ids"))


_ID_SQL = f"WITH {LINKS_SQL} SELECT entity_id, wikidata_id, coalesce(qid, '') AS ids FROM g WHERE fault = "


@query("v06_id_format", _ID_SQL + "'id_format'")
def id_format(t: Tables) -> DataFrame:
    return id_faults(t, "id_format")


@query("v07_id_consistency", _ID_SQL + "'id_mismatch'")
def id_consistency(t: Tables) -> DataFrame:
    return id_faults(t, "id_mismatch")


@query("v07b_id_missing", _ID_SQL + "'id_missing'")
def id_missing(t: Tables) -> DataFrame:
    return id_faults(t, "id_missing")


@query(
    "v08_url_format",
    r"""
    WITH u AS (
      SELECT page_id, url FROM pages
      UNION ALL SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) FROM pages)
    SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) <> ''
      AND regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) <> '' AS well_formed
    FROM u
    """,
)
def url_format(t: Tables) -> DataFrame:
    hrefs = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    urls = t.pages.select("page_id", F.explode(F.concat(F.array("url"), hrefs)).alias("url"))
    return urls.withColumn("well_formed", well_formed_url(F.col("url")))


@query(
    "v09_check_routing",
    r"""
    SELECT page_id, CASE WHEN starts_with(url, 'http:') AND contains(url, 'example.com') THEN 'invalid'
        WHEN contains(url, 'example.net') THEN 'entity'
        WHEN contains(url, 'example.org') THEN 'head' ELSE 'head_then_get' END AS route
    FROM pages
    """,
)
def check_routing(t: Tables) -> DataFrame:
    url = F.replace("url", F.lit("example.net"), F.lit("wikidata.org"))
    url = F.replace(url, F.lit("example.org"), F.lit("wikipedia.org"))
    url = F.regexp_replace(url, "^http:(.*example\\.com)", "$1")
    return t.pages.select("page_id", check_route(url).alias("route"))


@query(
    "v10_probe_outcomes",
    """
    WITH probed AS (
      SELECT c_custkey, c_mktsegment <> 'BUILDING' AS probed,
             CASE c_nationkey % 6 WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 404 WHEN 3 THEN 405 END AS head,
             CASE c_nationkey % 6 WHEN 4 THEN 'timeout' WHEN 5 THEN 'connection' END AS error,
             CASE c_nationkey % 2 WHEN 0 THEN 200 ELSE 500 END AS fetched,
             CASE c_custkey % 3 WHEN 0 THEN 'head' WHEN 1 THEN 'entity' ELSE 'head_then_get' END AS route
      FROM customer),
    shot AS (
      SELECT *, CASE WHEN error IS NOT NULL THEN 0 WHEN head = 405 AND route = 'head_then_get' THEN fetched ELSE head END AS st
      FROM probed),
    verdict AS (
      SELECT *, CASE WHEN route = 'entity' THEN true WHEN NOT probed THEN NULL
                     ELSE st = 200 OR (st >= 300 AND st < 400) END AS ok FROM shot)
    SELECT o_orderkey, v.ok, CASE WHEN route = 'entity' THEN 200 WHEN probed THEN st END AS status,
           CASE WHEN NOT v.ok THEN CASE WHEN error IS NULL THEN 'HTTP ' || st WHEN route = 'head' THEN error
             WHEN error = 'timeout' THEN 'Request timeout' ELSE 'Connection error' END END AS problem
    FROM orders JOIN verdict v ON o_custkey = c_custkey
    """,
)
def probing(t: Tables) -> DataFrame:
    def url_of(key: str):
        host = (
            F.when(F.col(key) % 3 == 0, "en.wikipedia.org").when(F.col(key) % 3 == 1, "www.wikidata.org").otherwise(
                "shop.example.com"
            )
        )
        return F.concat(F.lit("https://"), host, F.lit("/c/"), F.col(key))

    nation = F.col("c_nationkey")
    head = F.when(nation % 6 == 0, 200).when(nation % 6 == 1, 301).when(nation % 6 == 2, 404).when(nation % 6 == 3, 405)
    error = F.when(nation % 6 == 4, "timeout").when(nation % 6 == 5, "connection")
    get = F.when(nation % 2 == 0, 200).otherwise(500)
    shots = F.array(
        F.struct(F.lit("HEAD").alias("method"), head.alias("status"), error.alias("error")),
        F.struct(F.lit("GET").alias("method"), get.alias("status"), F.lit(None).cast("string").alias("error")),
    )
    probes = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        url_of("c_custkey").alias("url"), F.inline(shots)
    )
    links = t.orders.select("o_orderkey", url_of("o_custkey").alias("url"))
    outcomes = probe_outcomes(links.withColumn("route", check_route(F.col("url"))), probes)
    return outcomes.select("o_orderkey", "ok", "status", "problem")


@query(
    "v11_entity_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN p_type = 'ECONOMY' OR p_size > 40 THEN 'not_found'
                WHEN l_linenumber % 3 = 0 THEN 'name_mismatch' ELSE 'ok' END AS verdict
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def entity_lookup(t: Tables) -> DataFrame:
    """Each line names its part as the label does, as a part of the label, or as something else."""
    labels = t.part.filter(F.col("p_type") != "ECONOMY").select(
        F.col("p_partkey").alias("qid"), F.concat(F.lit("Part "), "p_partkey").alias("label"), (F.col("p_size") > 40).alias("missing")
    )
    key, line = F.col("l_partkey"), F.col("l_linenumber") % 3
    name = F.when(line == 0, F.lit("nothing alike")).when(line == 1, F.concat(F.lit("part "), key)).otherwise(F.concat(F.lit("THE PART "), key))
    outcome = entity_outcomes(t.lineitem.select("l_orderkey", "l_linenumber", key.alias("qid"), name.alias("name")), labels)
    return outcome.select("l_orderkey", "l_linenumber", F.col("qid").alias("l_partkey"), "verdict")


@query(
    "v12_name_similarity",
    r"""
    WITH n AS (
      SELECT a.p_partkey, upper(a.p_name) || '  ' || a.p_type || ' ' || a.p_brand AS name,
             CASE WHEN b.p_size > 45 THEN '' WHEN b.p_size > 35 THEN b.p_name
                  WHEN b.p_size > 30 THEN a.p_type ELSE b.p_name || ' ' || lower(b.p_type) || ' ' || b.p_brand END AS label
      FROM part a JOIN part b ON a.p_partkey // 2 = b.p_partkey),
    w AS (
      SELECT *, list_filter(string_split_regex(lower(name), '\s+'), lambda x: x <> '') AS nw,
             list_filter(string_split_regex(lower(label), '\s+'), lambda x: x <> '') AS lw FROM n)
    SELECT p_partkey, name, label,
           label = '' OR contains(array_to_string(lw, ' '), array_to_string(nw, ' '))
             OR contains(array_to_string(nw, ' '), array_to_string(lw, ' '))
             OR len(list_intersect(nw, lw)) * 10 > greatest(len(list_distinct(nw)), len(list_distinct(lw))) * 3 AS similar_to
    FROM w
    """,
)
def name_similarity(t: Tables) -> DataFrame:
    a, b = t.part.alias("a"), t.part.alias("b")
    joined = a.join(b, F.floor(F.col("a.p_partkey") / 2) == F.col("b.p_partkey"))
    size = F.col("b.p_size")
    name = F.concat(F.upper("a.p_name"), F.lit("  "), F.col("a.p_type"), F.lit(" "), F.col("a.p_brand"))
    label = (
        F.when(size > 45, "")
        .when(size > 35, F.col("b.p_name"))
        .when(size > 30, F.col("a.p_type"))
        .otherwise(F.concat_ws(" ", "b.p_name", F.lower("b.p_type"), "b.p_brand"))
    )
    named = joined.select("a.p_partkey", name.alias("name"), label.alias("label"))
    return named.withColumn("similar_to", similar_names(F.col("name"), F.col("label")))


@query(
    "v14_unreadable_documents",
    """
    SELECT 'UNKNOWN' AS entity_id, 'events/' || event_id AS path,
           CASE event_type WHEN 'error' THEN 'parse_error' ELSE 'empty_document' END AS rule,
           CASE event_type WHEN 'error' THEN 'Error: malformed document'
                ELSE 'File is empty or contains only null' END AS message
    FROM events WHERE event_type IN ('error', 'view')
    """,
)
def unreadable_documents(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    body = F.when(kind == "error", F.regexp_replace("props", "\\}$", "")).when(kind == "view", "null").otherwise(F.col("props"))
    path = F.concat(F.lit("events/"), F.col("event_id"))
    parsed = docs(t.events.withColumn("path", path), body, "path")
    return collect_findings(unreadable(parsed)).select("entity_id", "path", "rule", "message")


@query("v15_findings", f"WITH {LINKS_SQL} SELECT entity_id, ordinal, rule, position, message FROM f")
def all_findings(t: Tables) -> DataFrame:
    return explode_findings(checked_pages(t)).drop("path")


@query(
    "v15_verdicts",
    f"""
    WITH {LINKS_SQL}
    SELECT '/data/pages/' || d.seg || '/' || d.entity_id || '.json' AS path, count(f.entity_id) AS n_findings,
           count(f.entity_id) = 0 AS valid
    FROM d LEFT JOIN f ON d.entity_id = f.entity_id GROUP BY d.seg, d.entity_id
    """,
)
def document_verdicts(t: Tables) -> DataFrame:
    return validate(page_documents(t)).verdicts.drop("n_unchecked")


# Two links a page, and what probes of the first said by the page's number: none; an old failure and a later success;
# the reverse; one that is stale; a refused HEAD with a GET; one from after the check; a timeout. Pages may share a URL, and
# so its probes: of those of one time the greatest status counts, then the greatest error.
ONLINE_SQL = """
probe AS (
  SELECT url, m AS method, TIMESTAMP '2024-06-01 00:00:00' - to_days(CAST(days AS INTEGER)) AS probed_at, status, error
  FROM pages, (VALUES (1, 'HEAD', 30, 404, NULL), (1, 'HEAD', 3, 200, NULL), (2, 'HEAD', 30, 200, NULL), (2, 'HEAD', 3, 404, NULL),
    (3, 'HEAD', 800, 200, NULL), (4, 'HEAD', 2, 405, NULL), (4, 'GET', 2, 301, NULL), (5, 'HEAD', 9, 200, NULL), (5, 'HEAD', -9, 500, NULL),
    (6, 'HEAD', 1, NULL, 'timeout')) AS s(k, m, days, status, error)
  WHERE page_id % 7 = k
  UNION ALL SELECT url || '/about', 'HEAD', TIMESTAMP '2024-05-20 00:00:00', 200, NULL FROM pages WHERE page_id % 5 > 0),
link AS (
  SELECT page_id, url, 1 AS position FROM pages UNION ALL SELECT page_id, url || '/about', 2 FROM pages),
fresh AS (
  SELECT * FROM probe WHERE probed_at <= TIMESTAMP '2024-06-01 00:00:00' AND probed_at >= TIMESTAMP '2023-06-02 00:00:00'),
last AS (
  SELECT url, method, struct_pack(s := status, e := error) AS shot FROM fresh
  QUALIFY row_number() OVER (PARTITION BY url, method ORDER BY probed_at DESC, coalesce(status, -1) DESC, coalesce(error, '') DESC) = 1),
shot AS (
  SELECT page_id, position, CASE WHEN h.shot.s = 405 THEN g.shot ELSE h.shot END AS shot
  FROM link LEFT JOIN last h ON h.url = link.url AND h.method = 'HEAD' LEFT JOIN last g ON g.url = link.url AND g.method = 'GET'),
seen AS (
  SELECT page_id, position, shot IS NULL AS open,
         shot IS NOT NULL AND (shot.e IS NOT NULL OR NOT (shot.s = 200 OR shot.s BETWEEN 300 AND 399)) AS bad
  FROM shot),
verdict AS (
  SELECT '/data/pages/P' || page_id AS path, count(*) FILTER (WHERE bad) AS n_findings, count(*) FILTER (WHERE open) AS n_unchecked
  FROM seen GROUP BY page_id)
"""


def online_validation(t: Tables) -> Validation:
    page, url = F.col("page_id"), F.col("url")
    link = lambda u: obj(url=quote(u), type=F.lit('"website"'))
    text = obj(id=quote(F.concat(F.lit("P"), page)), links=arr(link(url), link(F.concat(url, F.lit("/about")))))
    parsed = docs(t.pages.select(F.concat(F.lit("/data/pages/P"), page).alias("path"), text.alias("body")), F.col("body"), "path")
    at = F.lit("2024-06-01 00:00:00").cast("timestamp")

    def shot(k: int, method: str, days: int, status: int | None, error: str | None = None) -> Column:
        row = F.struct(
            F.lit(method).alias("method"), (at - F.make_dt_interval(F.lit(days))).alias("probed_at"),
            F.lit(status).cast("int").alias("status"), F.lit(error).cast("string").alias("error"),
        )
        return F.when(page % 7 == k, row)

    shots = F.array_compact(F.array(
        shot(1, "HEAD", 30, 404), shot(1, "HEAD", 3, 200), shot(2, "HEAD", 30, 200), shot(2, "HEAD", 3, 404), shot(3, "HEAD", 800, 200),
        shot(4, "HEAD", 2, 405), shot(4, "GET", 2, 301), shot(5, "HEAD", 9, 200), shot(5, "HEAD", -9, 500), shot(6, "HEAD", 1, None, "timeout"),
    ))
    about = t.pages.filter(page % 5 > 0).select(
        F.concat(url, F.lit("/about")).alias("url"), F.lit("HEAD").alias("method"), (at - F.make_dt_interval(F.lit(12))).alias("probed_at"),
        F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"),
    )
    probes = t.pages.select("url", F.inline(shots)).unionByName(about)
    return validate(parsed, probes, at=at, max_age=F.make_dt_interval(F.lit(365)))


@query(
    "v15_online_verdicts",
    f"""
    WITH {ONLINE_SQL}
    SELECT path, n_findings, n_unchecked, CASE WHEN n_findings > 0 THEN false WHEN n_unchecked = 0 THEN true END AS valid FROM verdict
    """,
)
def online_verdicts(t: Tables) -> DataFrame:
    return online_validation(t).verdicts


@query(
    "v16_online_totals",
    f"""
    WITH {ONLINE_SQL}
    SELECT count(*) FILTER (WHERE n_findings = 0 AND n_unchecked = 0) AS n_valid, count(*) FILTER (WHERE n_findings > 0) AS n_invalid,
           count(*) FILTER (WHERE n_findings = 0 AND n_unchecked > 0) AS n_undecided, CAST(sum(n_unchecked) AS BIGINT) AS n_unchecked,
           CAST(sum(n_findings) AS BIGINT) AS n_findings
    FROM verdict
    """,
)
def online_totals(t: Tables) -> DataFrame:
    return online_validation(t).totals()


@query(
    "v16_totals",
    f"""
    WITH {LINKS_SQL}, v AS (
      SELECT d.entity_id, count(f.entity_id) AS n FROM d LEFT JOIN f ON d.entity_id = f.entity_id GROUP BY d.entity_id)
    SELECT count(*) FILTER (n = 0) AS n_valid, count(*) FILTER (n > 0) AS n_invalid, CAST(sum(n) AS BIGINT) AS n_findings
    FROM v
    """,
)
def validation_totals(t: Tables) -> DataFrame:
    return totals(checked_pages(t), F.size(local_findings()))


@query(
    "v17_finding_histogram",
    f"""
    WITH {LINKS_SQL}
    SELECT CASE WHEN contains(message, 'HTTP') THEN 'HTTP errors' WHEN contains(lower(message), 'wikidata')
                THEN 'Wikidata errors' WHEN contains(message, 'URL') THEN 'URL format errors' ELSE 'Other errors' END
             AS finding_class, count(*) AS n
    FROM f GROUP BY 1
    """,
)
def finding_histogram(t: Tables) -> DataFrame:
    return histogram(explode_findings(checked_pages(t)))


@query(
    "v19_first_findings",
    f"""
    WITH {LINKS_SQL}, r AS (
      SELECT d.seg || '/' || d.entity_id || '.json' AS path, f.ordinal, f.message
      FROM f JOIN d ON f.entity_id = d.entity_id)
    SELECT * FROM (SELECT * FROM r ORDER BY path, ordinal, message LIMIT 100)
    UNION ALL
    SELECT NULL, NULL, '... and ' || (count(*) - 100) || ' more errors' FROM r HAVING count(*) > 100
    """,
)
def findings_report(t: Tables) -> DataFrame:
    return first_findings(explode_findings(checked_pages(t)), 100, "/data/pages")
