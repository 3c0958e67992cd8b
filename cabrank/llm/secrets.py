r"""Secret scans over versions of blobs, with a ledger of what was scanned already.

Every version of a path is addressed by the SHA-256 of its content. The ledger holds one
row per blob and rule version with the findings of that scan, also if there are none. A
run scans only blobs the ledger lacks for the rule version, each once however many paths
and versions hold it, and joins the findings back to all of them. Copies of a blob are
reduced where they are read, before anything is shuffled.

All of it is DataFrame functions. A rule is a Java pattern, the group whose length
counts, and the least length; matches are the leftmost ones that do not overlap, and those
that are too short are dropped afterwards. Offsets come from running sums over the
matches and the text between them, so a blob with very many matches stays linear; they
are code points, the end exclusive.

Null contents count as empty and have no findings. Null and repeated keys keep their rows. An
empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from cabrank.llm.common import saved, text_of


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int
    least: int


# The kinds of secrets and their patterns. A run of hex digits or of an access key
# cannot be found again inside a shorter run, so there the least length may be part of the pattern.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
VERSION = "1"
SPANS = "array<struct<start:bigint,place:int,end:bigint,kind:string>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"


def address(content: Column) -> Column:
    return F.sha2(content, 256)


def _matches(rule: Rule, place: int) -> Column:
    """Every match of a text with the length of the text before it, or null without a match."""
    pattern, text = F.lit(rule.pattern), F.col("content")
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s).cast("long"))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda s: F.length(s).cast("long"))
    counted = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda s: F.length(s).cast("long"))
    zipped = F.slice(F.arrays_zip(gaps.alias("gap"), whole.alias("long"), counted.alias("counted")), 1, F.size(whole))
    told = F.transform(
        zipped,
        lambda m, i: F.struct(
            F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), i.alias("number"),
            m["gap"].alias("gap"), m["long"].alias("long"), (m["counted"] >= rule.least).alias("valid"),
        ),
    )
    return F.when(text.rlike(rule.pattern), told)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blobs`` (blob, content), each once, as blob and spans; spans are sorted by start, then by the order of the rules."""
    found = F.flatten(F.array(*[F.coalesce(_matches(rule, i), F.array()) for i, rule in enumerate(rules)]))
    # Two numbers decide what happens, and the content is left behind.
    matched = blobs.select("blob", F.explode_outer(found).alias("m")).select("blob", "m.*")
    before = Window.partitionBy("blob", "place").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("long")).over(before)
    placed = matched.withColumn("end", end).withColumn("start", F.col("end") - F.col("long"))
    span = F.when(F.col("valid"), F.struct("start", "place", "end", "kind"))
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).cast(SPANS).alias("spans"))


def update(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    version: str = VERSION,
    blob: str = "blob",
) -> DataFrame:
    """The ledger with every blob of ``versions`` (content and its address in ``blob``) scanned under this rule version."""
    unseen = versions.select(F.col(blob).alias("blob"), "content")
    if ledger is not None:
        done = ledger.where(F.col("rule_version") == version).select("blob")
        unseen = unseen.join(done, "blob", "left_anti")
    scanned = scan(unseen.dropDuplicates(["blob"]), rules)
    fresh = scanned.select("blob", F.lit(version).alias("rule_version"), "spans")
    return saved(fresh if ledger is None else ledger.select("blob", "rule_version", "spans").unionByName(fresh))


def secrets(
    documents: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    version: str = VERSION,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob, spans) for every document, and the ledger for the next run."""
    addressed = documents.select("doc_id", text_of().alias("content")).withColumn("blob", address(F.col("content")))
    ledger = update(addressed, ledger, rules, version)
    paths = saved(addressed.select("doc_id", "blob"))
    known = ledger.where(F.col("rule_version") == version).select("blob", "spans")
    return paths.join(known, "blob").select("doc_id", "blob", "spans"), ledger


def written(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, the number of findings of each kind, base_sha256 and spans."""
    found, _ = secrets(documents)

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [of(rule.kind).alias(f"n_{rule.kind}") for rule in RULES]
    listed = written(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))
