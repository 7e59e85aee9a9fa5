"""Secret scans over a ledger of blobs; DataFrame functions only.

A text is a blob, addressed by the SHA-256 of its content; every version of every path points
to its blob. The ledger lists the pairs of blob and rule version already scanned. A run takes
one path for each blob, drops the pairs that are in the ledger, scans the rest, and joins the
findings, old and new, back to all paths. A blob that a third of all paths share is scanned once.

Spans come from the text between matches: it is split by the rule, and the lengths of gaps and
matches add up to positions in code points, ``BLOCK`` matches at a time, so that no list is copied for
each of them. A match that fails the rule's length is dropped but uses up its text. Patterns are
linear in the text: what may be long starts only where its run of characters starts, and gives nothing back.

A row whose text holds no hint of any rule has no findings and takes no part in the join back.

Results for odd input: null or empty text is the empty blob and has no findings; null ids are
carried; rows of one id and repeated rows each get the findings of their own text; other
columns of the input are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.variants import let
from cartulary.llm.shared import NO_ID, keyed, partitions, read, store

FINDINGS = "array<struct<start:int,place:int,kind:string,stop:int>>"


class Rule(NamedTuple):
    """A pattern; the group that must have ``least`` characters; what every matching text holds."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str


# fixed values: kinds in the order in which spans of equal start are listed; base kinds first
RULES = [
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, r"(?i)(passw|secret|token|api_?key)"),
    # runs are maximal, so their least length can stand in the pattern
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16, r"AKIA[A-Z0-9]{12}"),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, r"PRIVATE KEY"),
    Rule("web_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", 0, 24, r"eyJ"),
    Rule("host_token", 1, r"gh[opsur]_[A-Za-z0-9]+", 0, 40, r"gh[opsur]_"),
    Rule("url_login", 2, r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*+://[^\s:/@]++:[^\s:/@]++@", 0, 0, r"://[^\s:/@]++:[^\s:/@]++@"),
]
BASE = ["assign", "access", "hex"]
# Matches whose positions are summed up in one list.
BLOCK = 512


def find(rule: Rule, place: int) -> Column:
    """The findings of a rule in ``text``, in order."""
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    matches = F.arrays_zip(gaps.alias("gap"), F.transform(whole, lambda x: F.length(x)).alias("size"), F.transform(tested, lambda x: F.length(x)).alias("tested"))
    empty = F.struct(F.lit(0).alias("end"), F.array().cast(FINDINGS).alias("found"))

    def row(start: Column, stop: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), stop.alias("stop"))

    def step(done: Column, m: Column) -> Column:
        start = done["end"] + m["gap"]
        stop = start + F.coalesce(m["size"], F.lit(0))
        found = F.when(m["tested"] >= rule.least, F.concat(done["found"], F.array(row(start, stop)))).otherwise(done["found"])
        return F.struct(stop.alias("end"), found.alias("found"))

    def shift(done: Column, block: Column) -> Column:
        moved = F.transform(block["found"], lambda x: row(x["start"] + done["end"], x["stop"] + done["end"]))
        return F.struct((done["end"] + block["end"]).alias("end"), F.concat(done["found"], moved).alias("found"))

    def summed(m: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(m) - 1, F.lit(BLOCK))
        return F.transform(starts, lambda i: F.aggregate(F.slice(m, i + 1, BLOCK), empty, step))

    # bound once: within a lambda the text would be matched anew for each block
    every = F.aggregate(let(matches, summed), empty, shift, lambda done: done["found"])
    return F.when(F.col("text").rlike(rule.hint), every).otherwise(F.array().cast(FINDINGS))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Paths with their findings, and the ledger to keep.

    ``docs`` has ``doc, salt, text``; the ledger ``blob, kind, version, findings`` with one row
    for each blob and rule version scanned. The first result is ``doc, blob, findings``.
    """
    rules = RULES if rules is None else rules
    spark = docs.sparkSession
    hinted = F.greatest(*[F.col("text").rlike(r.hint) for r in rules], F.lit(False))
    paths = store(docs.select("doc", "salt", F.sha2("text", 256).alias("blob"), hinted.alias("hinted")), "paths")
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    blobs = paths.groupBy("blob").agg(F.min(F.struct("doc", "salt")).alias("home"))
    if ledger is None:
        unseen = blobs.select("blob", "home", wanted.alias("pairs"))
    else:
        pairs = blobs.select("blob", "home", F.explode(wanted).alias("pair")).select("blob", "home", "pair.kind", "pair.version")
        unseen = pairs.join(ledger, ["blob", "kind", "version"], "left_anti").groupBy("blob").agg(F.first("home").alias("home"), F.collect_list(F.struct("kind", "version")).alias("pairs"))
    unseen = unseen.select("blob", F.col("home.doc").alias("doc"), F.col("home.salt").alias("salt"), "pairs")
    texts = docs.repartition(partitions(spark), "doc", "salt").join(unseen, ["doc", "salt"])
    asked = lambda r: F.array_contains("pairs", F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")))
    scanned = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.when(asked(r), find(r, i)).alias("findings"))
        for i, r in enumerate(rules)
    ])
    rows = texts.select("blob", F.filter(scanned, lambda x: x["findings"].isNotNull()).alias("scanned"))
    # equal rows of one path are one blob, scanned as often as they occur
    fresh = store(rows.select("blob", F.inline("scanned")).dropDuplicates(["blob", "kind", "version"]), "ledger")
    now = fresh if ledger is None else ledger.select(fresh.columns).unionByName(fresh)
    current = F.array_contains(wanted, F.struct("kind", "version"))
    found = now.where(current).where(F.size("findings") > 0).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    none = F.array().cast(FINDINGS)
    joined = paths.where("hinted").select("doc", "blob").join(found, "blob", "left").select("doc", "blob", F.coalesce("findings", none).alias("findings"))
    return joined.unionByName(paths.where("NOT hinted").select("doc", "blob", none.alias("findings"))), now


def of_kinds(kinds: list[str]) -> Column:
    return F.filter("findings", lambda x: x["kind"].isin(kinds))


def spans(kinds: list[str] | None = None) -> Column:
    """``kind:start:stop`` of all findings, or those of some kinds, joined by commas."""
    rows = F.col("findings") if kinds is None else of_kinds(kinds)
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = scan(keyed(read(spark, sf_dir, "documents")))
    counts = [F.size(of_kinds([k])).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(F.nullif(F.col("doc"), F.lit(NO_ID)).alias("doc_id"), *counts, F.sha2(spans(BASE), 256).alias("base_sha256"), spans().alias("spans"))
