"""URL filters: rules by host and path, then a list of URLs behind a blocked Bloom filter.

The Bloom filter is a table of at most `blocks` rows of eight 64-bit words, so its size has a
bound (72 bytes a row) whatever the length of the list; it is broadcast and tells which URLs
may be listed. Only those are shuffled, to an equality join with the list, which removes the
false ones. A longer list lets more URLs through to that join; the verdicts stay the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.bloom import BLOCKS, bloom_table, maybe_in
from loglake.llm.keys import lower_ascii, plain

#: Query parameters that say where a visitor came from.
TRACKING = r"^(utm_[A-Za-z0-9_]*|ref|fbclid|gclid)(=|$)"


class Rule(NamedTuple):
    """What to do with a host, its subdomains and the paths that start alike."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the registered query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a URL; all empty without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^/?#]*[^?#]*\?([^#]*)", 1)
    return lower_ascii(host), after, query


def canonical_url(url: Column) -> Column:
    """One spelling for the URLs of a page: no scheme, fragment, `www.`, default port, end
    slash or tracking parameter, and the other parameters in order. Empty without `://`."""
    host, path, query = url_parts(url)
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    kept = F.array_join(F.array_sort(kept), "&")
    return F.concat(
        host, F.regexp_replace(path, "/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")
    )


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    ordered = sorted(rules, key=lambda r: len(r.text), reverse=True)

    def first(value) -> Column:
        cases = (
            F.when(
                ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path)),
                F.lit(value(r)),
            )
            for r in ordered
        )
        return F.coalesce(*cases, F.lit(None).cast("string"))

    return first(lambda r: r.text), first(lambda r: r.verdict)


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule] = (),
    url_column: str = "url",
    listed_column: str = "url",
    blocks: int = BLOCKS,
) -> DataFrame:
    """The pages with host, path, rule and verdict (`block` or `allow`) as a struct `_url`.

    A rule decides where one fits; other pages are blocked if their canonical URL is that of
    a listed one. A missing URL, or one without `://`, is allowed, and so is everything by an
    empty list. Plain columns stay as they are (see keys.plain), repeated rows too.
    """
    pages = plain(pages)
    host, path, _ = url_parts(F.col(url_column))
    rule, verdict = rule_of(host, path, rules)
    entries = (
        listed.select(canonical_url(F.col(listed_column)).alias("_listed")).where("_listed <> ''").distinct()
    )
    judged = pages.withColumn(
        "_url", F.struct(host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("verdict"))
    ).withColumn("_key", F.when(F.col("_url.rule").isNull(), canonical_url(F.col(url_column))))
    seen = maybe_in(judged, "_key", bloom_table(entries, "_listed", blocks), blocks)
    clear = seen.where(~F.col("_maybe")).withColumn("_listed", F.lit(None).cast("string"))
    checked = seen.where("_maybe").join(entries, F.col("_key") == F.col("_listed"), "left")
    columns = [F.col(f"`{c}`") for c in pages.columns]
    method = F.when(F.col("_listed").isNotNull(), "block").otherwise("allow")
    result = F.col("_url").withField("verdict", F.coalesce(F.col("_url.verdict"), method))
    return clear.unionByName(checked).select(*columns, result.alias("_url"))
