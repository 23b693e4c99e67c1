"""URL rules spread over redirects: block decisions reach aliases.

Pages name other addresses of themselves by canonical links and by refresh
redirects in their HTML; recorded HTTP redirects can be given as a table.
These edges join addresses (host, path and query; scheme, host case and
fragment do not matter) into groups by distributed connected components. An
address that a rule fits takes the longest rule's verdict. Every other
address takes its group's: allow if a rule allows some alias (explicit allow
has precedence), else block if a rule blocks some alias, else allow.

Defined cases: a null url, or one without "://", has an empty host and path;
it fits no rule whose host is not empty, has no aliases and is allowed. A
link is resolved against the page's url (absolute, "//host", "/path" and
relative forms); dot segments are not folded. Repeated urls are one address.
Extra columns pass through unless they have a result's name; an empty table
gives no rows; a null html has no edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import staged
from fleetscope.llm.components import connected_components

# (verdict, host, path) per rule; a short list that the plan carries.
Rules = Sequence[tuple[str, str, str]]
MAX_RULES = 1000


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(df: DataFrame, url: str, prefix: str) -> DataFrame:
    """Add ``prefix`` + host, path, query and address of a url column. The
    address (host, path and query; null without host) tells urls apart. Built
    in steps, so that no expression is repeated."""
    p = prefix
    df = df.withColumn(f"{p}rest", F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")))
    df = df.withColumns({f"{p}host": F.coalesce(ascii_lower(F.regexp_extract(f"{p}rest", r"^[^/?#]*", 0)), F.lit("")),
                         f"{p}path": F.coalesce(F.regexp_extract(f"{p}rest", r"^[^/?#]*([^?#]*)", 1), F.lit("")),
                         f"{p}query": F.coalesce(F.regexp_extract(f"{p}rest", r"^[^?#]*(\?[^#]*)?", 1), F.lit(""))}).drop(f"{p}rest")
    path = F.when(F.col(f"{p}path") == "", F.lit("/")).otherwise(F.col(f"{p}path"))
    return df.withColumn(f"{p}address", F.when(F.col(f"{p}host") != "", F.concat(f"{p}host", path, f"{p}query")))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. Of
    equally long rules the allowing one wins."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; join them as a table instead")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def resolved(df: DataFrame, link: str, base: str) -> DataFrame:
    """Add ``target``: the absolute url of a link found on the page ``base``."""
    df = with_parts(df, base, "base_").withColumn("scheme", F.regexp_extract(base, r"(?s)^(.*?)://", 1))
    df = df.withColumns({"root": F.concat("scheme", F.lit("://"), "base_host"),
                         "folder": F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace("base_path", r"[^/]*$", ""), "^/", ""))})
    c = F.col(link)
    absolute = (F.when(c == "", F.lit(None).cast("string"))
                 .when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), c)
                 .when(c.startswith("//"), F.concat("scheme", F.lit(":"), c))
                 .when(c.startswith("/"), F.concat("root", c))
                 .when(c.rlike(r"^[?#]"), F.concat("root", "base_path", c))
                 .when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
                 .otherwise(F.concat("root", "folder", c)))
    return df.withColumn("target", absolute)


def page_edges(pages: DataFrame) -> DataFrame:
    """(source, target) urls of canonical links and refresh redirects."""
    attribute = r"""\s*=\s*["']?\s*([^"'\s>]+)"""
    tag = F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0))
    tags = (pages.filter(F.col("html").rlike(r"(?is)<(?:link\b[^>]*canonical|meta\b[^>]*refresh)") & F.col("url").isNotNull())
            .select("url", tag.alias("tag")))
    canonical = F.when(F.col("tag").rlike(r"""(?is)^<link\b.*\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""),
                       F.regexp_extract("tag", r"(?is)\bhref" + attribute, 1))
    refresh = F.when(F.col("tag").rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?\s*refresh\b"""),
                     F.regexp_extract("tag", r"""(?is);\s*url\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    # Written before the next steps: filters pushed through them would repeat
    # their expressions many times.
    tags = staged(tags.select("url", F.regexp_replace(F.coalesce(canonical, refresh), "&amp;", "&").alias("link")), "page-links")
    return resolved(tags.filter("link IS NOT NULL"), "link", "url").select(F.col("url").alias("source"), "target")


def alias_verdicts(edges: DataFrame, rules: Rules) -> DataFrame:
    """(address, group_verdict) of every address in a group, from edges of urls."""
    ends = with_parts(with_parts(edges, "source", "s_"), "target", "t_")
    ends = staged(ends.select(F.col("s_address").alias("s"), F.col("t_address").alias("t")), "edges").filter("s <> t").distinct()
    links = ends.select(F.xxhash64("s").alias("a"), F.xxhash64("t").alias("b"))
    groups = connected_components(links)
    nodes = ends.select(F.col("s").alias("address")).unionByName(ends.select(F.col("t").alias("address"))).distinct()
    host, path = F.regexp_extract("address", r"^[^/]*", 0), F.regexp_extract("address", r"^[^/]*([^?]*)", 1)
    verdict = rule_of(host, path, rules)["verdict"]
    nodes = nodes.select("address", verdict.alias("own"), F.xxhash64("address").alias("node")).join(groups, "node")
    per_group = nodes.groupBy("component").agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    per_group = staged(per_group, "groups")
    decided = F.when(F.col("allowed"), F.lit("allow")).when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return nodes.join(per_group, "component").select("address", decided.alias("group_verdict"))


def judge_urls(pages: DataFrame, rules: Rules, redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` (without its html) with host, path, rule and verdict.
    ``redirects(source, target)`` are further edges between urls."""
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    aliases = staged(alias_verdicts(edges, rules), "aliases")
    results = ("host", "path", "rule", "verdict")
    keep = [c for c in pages.columns if c not in (*results, "html")]
    judged = with_parts(pages.select(*[F.col(f"`{c}`") for c in keep]), "url", "__")
    judged = judged.withColumn("__rule", rule_of(F.col("__host"), F.col("__path"), rules))
    judged = judged.join(aliases.select(F.col("address").alias("__address"), F.col("group_verdict").alias("__group")), "__address", "left")
    return judged.select(*[F.col(f"`{c}`") for c in keep], F.col("__host").alias("host"), F.col("__path").alias("path"),
                         F.col("__rule.rule").alias("rule"),
                         F.coalesce(F.col("__rule.verdict"), F.col("__group"), F.lit("allow")).alias("verdict"))
