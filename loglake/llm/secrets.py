"""Secret scans: credentials in whole texts, weak ones only beside what completes them.

Base kinds are reported wherever they stand. Weak kinds are not secrets by themselves: an
identifier, a random-looking word, an endpoint. They count where parts of a credential meet
within a scope, a stretch of `reach` code points. The interval join that finds them runs over
the parts of a document in order of place: of each role, the nearest part before and the
nearest behind decide whether any lies in scope, so no pairs are made.

Texts without a part never leave the scan; only parts (places, no texts) are shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.keys import KEY, with_key


class Kind(NamedTuple):
    """A pattern; the group whose length must reach `least`; the part it plays."""

    name: str
    pattern: str
    group: int
    least: int
    role: str
    weak: bool


#: In the order in which kinds at one place are listed. A pattern states the length itself where
#: that changes no match (a run is taken whole), so that short runs are not even rows.
KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, "secret", False),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16, "access", False),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, "secret", False),
    Kind("login", r"""((?i:user(?:name)?|login|client_id|access_key_id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)""", 2, 3, "access", True),
    Kind("random", r"[A-Za-z0-9+/]{24,}={0,2}", 0, 24, "secret", True),
    Kind("endpoint", r"""(?:https?|jdbc:[a-z]+|postgres|mysql|redis|mongodb|s3|ftp)://[^\x00-\x20"'<>]+|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+""", 0, 6, "endpoint", True),
)
ROLES = ("access", "secret", "endpoint")
#: Code points between the parts of one credential.
REACH = 200


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (kind number, index, gap before the match, match length, long enough)."""
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = found if kind.group == 0 else F.regexp_extract_all(text, pattern, F.lit(kind.group))
    rows = F.transform(
        F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), found.alias("found"), measured.alias("measured")),
        lambda m: F.struct(
            F.length(m["gap"]).cast("long").alias("gap"),
            F.length(m["found"]).cast("long").alias("size"),
            (F.length(m["measured"]) >= kind.least).alias("fits"),
        ),
    )
    return F.when(text.rlike(kind.pattern), rows)


def find_parts(docs: DataFrame) -> DataFrame:
    """Rows (key, kind, start, end) of all parts, base and weak, in code points, end exclusive.

    Matches of a kind are leftmost and do not overlap; those under the kind's length drop.
    A match lies behind all gaps and matches before it, so places are running sums.
    """
    numbered = F.array(
        *(F.struct(F.lit(i).alias("kind"), _matches(F.col("text"), kind).alias("found")) for i, kind in enumerate(KINDS))
    )
    found = (
        with_key(docs)
        .select(*KEY, F.inline(numbered))
        .where(F.col("found").isNotNull())
        .select(*KEY, "kind", F.posexplode("found").alias("i", "m"))
        .where(F.col("m.size").isNotNull())
        .distinct()
    )
    before = Window.partitionBy(*KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
    return (
        found.select(*KEY, "kind", end.alias("end"), (end - F.col("m.size")).alias("start"), "m.fits")
        .where("fits")
        .drop("fits")
    )


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Base parts, and the weak parts that others in their scope complete.

    A login needs a secret, a random word an access identifier, an endpoint both. A weak
    part that overlaps a base part is the same thing seen twice and is left out.
    """
    names = F.array(*(F.lit(k.role) for k in KINDS))
    weak = F.array(*(F.lit(k.weak) for k in KINDS))
    rows = parts.withColumn("role", F.element_at(names, F.col("kind") + 1)).withColumn(
        "weak", F.element_at(weak, F.col("kind") + 1)
    )
    order = Window.partitionBy(*KEY).orderBy("start", "end", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(1, Window.unboundedFollowing)

    def ends(what: Column) -> Column:
        return F.max(F.when(what, F.col("end"))).over(before)

    def starts(what: Column) -> Column:
        return F.min(F.when(what, F.col("start"))).over(behind)

    base = ~F.col("weak")
    placed = rows.select(
        "*",
        F.coalesce(ends(base) > F.col("start"), F.lit(False)).alias("_over"),
        F.coalesce(starts(base) < F.col("end"), F.lit(False)).alias("_under"),
    )
    apart = placed.where(base | ~(F.col("_over") | F.col("_under")))

    def near(role: str) -> Column:
        is_role = F.col("role") == role
        return F.coalesce(ends(is_role) >= F.col("start") - reach, F.lit(False)) | F.coalesce(
            starts(is_role) <= F.col("end") + reach, F.lit(False)
        )

    scoped = apart.select("*", *(near(r).alias(f"_near_{r}") for r in ROLES))
    complete = (
        F.when(F.col("role") == "access", F.col("_near_secret"))
        .when(F.col("role") == "secret", F.col("_near_access"))
        .otherwise(F.col("_near_access") & F.col("_near_secret"))
    )
    return scoped.where(base | complete).select(*KEY, "kind", "start", "end", "weak")


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id and `spans`, an array of (start, kind, end, weak).

    Spans are ordered by start, then kind number (see KINDS). Missing or empty texts have
    none. Repeated rows each get their spans; other columns are left out.
    """
    spans = (
        link_parts(find_parts(docs), reach)
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "weak"))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,weak:boolean>>")
    return (
        with_key(docs)
        .select("doc_id", *KEY)
        .join(spans, KEY, "left")
        .select("doc_id", F.coalesce("spans", none).alias("spans"))
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*(F.lit(k.name) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
