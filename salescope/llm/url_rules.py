"""URL allow and block rules, carried over redirects and canonical links.

A rule is a host suffix and a path prefix. The longest rule that fits decides for its
url. Urls without a rule follow their equivalence class: pages, the targets of their
redirects and canonical links, and the plain form of each url (scheme, fragment,
tracking parameters, ``www.``/``m.`` and file endings aside) are nodes, and the
connected components are the classes. A class with an allowed url allows, else a class
with a blocked url blocks, else the default holds: an explicit allow goes before any
block that arrives by an alias, and an own rule before both.

Nodes are 64-bit hashes of urls; at n urls about n^2 / 2^65 pairs share a node.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import WHITESPACE, lower_ascii
from salescope.llm.components import connected_components
from salescope.session import materialize

TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest (verdict, host, path) rule that fits, or null."""
    def fits(rule_host: str, rule_path: str) -> Column:
        return ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))

    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    hits = [F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ordered]
    return F.coalesce(*hits)


def plain_form(url: Column) -> Column:
    """The alias that all spellings of a page share; null where there is no ``://``."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(?:/index)?\.html?$|/+$", "")
    query = F.regexp_extract(after_scheme(url), r"\?([^#]*)", 1)
    query = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(?:=|$)"))), "&")
    return F.when(F.instr(url, "://") > 0, F.concat(F.lit("http://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


#: Comments, and elements whose content is no markup; then whole tags, quotes minded, and their attributes.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
TAG = r"(?is)<(?:link|meta|base)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
ATTRIBUTE = r"(?s)(?<![^\s\"'<>/])([^\s\"'<>/=]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def attribute(tag: Column, name: str) -> Column:
    """The first value of an attribute of a tag without its quotes, null if it has none."""
    at = F.array_position(F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 1), lower_ascii), name)
    value = F.try_element_at(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 2), F.nullif(at, F.lit(0)).cast("int"))
    return F.trim(F.replace(F.regexp_replace(value, r"(?s)\A([\"'])(.*)\1\z", "$2"), F.lit("&amp;"), F.lit("&")), F.lit(WHITESPACE))


def without_dots(path: Column) -> Column:
    """An absolute path with its segments ``.`` and ``..`` resolved."""
    def joined(parts: Column) -> Column:
        kept = F.aggregate(parts, F.expr("cast(array() as array<string>)"), lambda done, x: F.when(
            x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x)))
        tail = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.expr("cast(array() as array<string>)"))
        return F.concat(F.lit("/"), F.array_join(F.concat(kept, tail), "/"))

    return let(F.split(F.substring(path, 2, F.lit(2**31 - 1)), "/"), joined)


def resolved(base: Column, reference: Column) -> Column:
    """The absolute url of a reference found on a page (RFC 3986); null for one that names no host, as mailto: does."""
    scheme = F.regexp_extract(base, r"^[^:]*(?=://)", 0)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(after_scheme(base), r"^[^/?#]*", 0))
    path = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    own = F.regexp_extract(reference, r"^[^?#]*", 0)
    rest = F.regexp_extract(reference, r"^[^?#]*((?:\?[^#]*)?)", 1)
    merged = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(F.regexp_extract(path, r"^(?s:.*)/", 0), own))
    return (
        F.when(F.instr(own, "://") > 0, reference)
        .when(F.startswith(reference, F.lit("//")), F.concat(scheme, F.lit(":"), reference))
        .when(reference.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(own == "", F.concat(root, path, F.when(F.startswith(reference, F.lit("?")), rest).otherwise(query)))
        .otherwise(F.concat(root, without_dots(merged), rest)))


def link_targets(url: Column, html: Column) -> Column:
    """Absolute targets of the page's canonical links and of its meta refresh.

    Tags count where a browser sees them: not in comments or scripts, over several lines,
    with ``>`` in quotes, and with any attribute before. ``<base href>`` moves the base.
    """
    def targets(tags: Column) -> Column:
        def of(kind: str) -> Column:
            return F.filter(tags, lambda t: t.rlike(rf"(?i)^<{kind}\b"))

        canonical = F.filter(of("link"), lambda t: F.array_contains(F.split(lower_ascii(F.coalesce(attribute(t, "rel"), F.lit(""))), r"\s+"), "canonical"))
        refresh = F.filter(of("meta"), lambda t: lower_ascii(F.coalesce(attribute(t, "http-equiv"), F.lit(""))) == "refresh")
        jumps = F.transform(refresh, lambda t: F.regexp_extract(F.coalesce(attribute(t, "content"), F.lit("")), r"(?is)\burl\s*=\s*[\"']?([^\"'\s]+)", 1))
        found = F.filter(F.concat(F.transform(canonical, lambda t: F.coalesce(attribute(t, "href"), F.lit(""))), jumps), lambda h: h != "")
        bases = F.filter(F.transform(of("base"), lambda t: attribute(t, "href")), lambda h: F.coalesce(h != "", F.lit(False)))
        base = let(F.try_element_at(bases, F.lit(1)), lambda b: F.coalesce(resolved(url, b), url))
        return let(base, lambda b: F.array_compact(F.transform(found, lambda h: resolved(b, h))))

    seen = html.rlike(r"(?i)\brel\s*=|\bhttp-equiv\s*=")
    return F.when(seen, let(F.regexp_extract_all(F.regexp_replace(html, UNSEEN, " "), F.lit(TAG), 0), targets))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url", html: str | None = "html",
    default: str = "allow",
) -> DataFrame:
    """One row per row of ``pages``: (page_id, host, path, rule, verdict, by_alias).

    ``rules`` are (verdict, host, path) with verdict ``allow`` or ``block``. ``by_alias``
    tells that the class decided. A null url or one without ``://`` has an empty host and
    path, fits no rule, has no aliases and gets the default; a null html has no links.
    Repeated rows and repeated urls each get their row. Of rules of one length that fit,
    the first by name decides, allow before block. An html of any length is read whole; an
    empty table gives no rows. Other columns are ignored.
    """
    u = F.col("_url")
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
    targets = link_targets(u, F.col("_html")) if html else F.expr("cast(array() as array<string>)")
    linked = pages.select(F.col(url).alias("_url"), *([F.col(html).alias("_html")] if html else [])).filter(F.instr(u, "://") > 0)
    links = linked.select("_url", F.explode(F.array_append(F.coalesce(targets, F.expr("cast(array() as array<string>)")), plain_form(u))).alias("_to"))
    links = links.filter("_to is not null").distinct()
    # a target that is not itself a page meets the pages of its class in its plain form
    links = materialize(links.union(links.select(F.col("_to"), plain_form(F.col("_to")))).filter("_url <> _to").distinct(), "links")
    classes = connected_components(links.select(F.xxhash64("_url").alias("src"), F.xxhash64("_to").alias("dst")))

    nodes = links.select("_url").union(links.select("_to")).union(base.select("_url").filter(F.instr(u, "://") > 0))
    ruled = nodes.select(F.xxhash64("_url").alias("node"), rule_for(host_of(u), path_of(u), rules)["verdict"].alias("v")).filter("v is not null")
    classes = materialize(classes, "classes")
    votes = classes.join(ruled.groupBy("node").agg(F.first("v").alias("v")), "node")
    votes = votes.groupBy("component").agg(F.min("v").alias("class_verdict"))  # allow sorts before block
    votes = materialize(votes, "votes")
    voted = materialize(classes.join(votes, "component").select(F.col("node").alias("_n"), "class_verdict"), "voted")

    out = base.withColumn("host", host_of(u)).withColumn("path", path_of(u))
    out = out.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules)).withColumn("_n0", F.xxhash64("_url"))
    out = out.join(voted, F.col("_n0") == F.col("_n"), "left")
    return out.select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce("_r.verdict", "class_verdict", F.lit(default)).alias("verdict"),
        (F.col("_r.verdict").isNull() & F.col("class_verdict").isNotNull()).alias("by_alias"))
