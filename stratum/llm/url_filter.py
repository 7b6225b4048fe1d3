"""URL filters with redirect equivalence.

Allow and block rules by host and path prefix, longest first.  Redirects and
canonical links make urls aliases of each other; a url that no rule fits takes
over the block of an alias, unless an alias is explicitly allowed.  Only
DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored
from stratum.llm.components import connected_components

MAX_RULES = 10_000  # rules are part of the plan; a longer list is an error


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str  # allow or block


_upper, _lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _upper, _lower)


def url_path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def without_dot_segments(path: Column) -> Column:
    """An absolute path without ``.`` and ``..`` (RFC 3986, 5.2.4)."""
    whole = F.when(path.rlike(r"/\.\.?$"), F.concat(path, F.lit("/"))).otherwise(path)

    def step(done: Column, part: Column) -> Column:
        up, rest = done["up"], done["rest"]

        def state(levels: Column, kept: Column) -> Column:
            return F.struct(levels.alias("up"), kept.alias("rest"))

        return (
            F.when(part == ".", state(up, rest))
            .when(part == "..", state(up + 1, rest))
            .when(up > 0, state(up - 1, rest))
            .otherwise(state(up, F.concat(F.lit("/"), part, rest)))
        )

    last_first = F.reverse(F.split(F.regexp_replace(whole, "^/", ""), "/"))
    start = F.struct(F.lit(0).alias("up"), F.lit("").alias("rest"))
    resolved = F.aggregate(last_first, start, step, lambda done: done["rest"])
    return F.when(path.rlike(r"/\.\.?(/|$)"), resolved).otherwise(path)


def url_key(url: Column) -> Column:
    """Identity of a url; null without a host.

    Scheme and host are in lower case, an empty path is ``/``, dot segments
    are resolved and the fragment is dropped.
    """
    plain = F.substring_index(url, "#", 1)
    query = F.regexp_extract(after_scheme(plain), r"(?s)\?.*$", 0)
    path = F.when(url_path(plain) == "", F.lit("/")).otherwise(without_dot_segments(url_path(plain)))
    scheme = F.translate(F.substring_index(plain, "://", 1), _upper, _lower)
    return F.when(url_host(plain) != "", F.concat(scheme, F.lit("://"), url_host(plain), path, query))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(host, path, rule, verdict); null if none does.

    Of rules that are equally long, an allow comes first.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit in a plan")
    if not rules:
        return F.lit(None).cast("struct<host:string,path:string,rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict != "allow", r))
    table = F.array(
        *(
            F.struct(
                F.lit(r.host).alias("host"),
                F.lit(r.path).alias("path"),
                F.lit(r.host + r.path).alias("rule"),
                F.lit(r.verdict).alias("verdict"),
            )
            for r in ordered
        )
    )

    def fits(r: Column) -> Column:
        of_host = (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))
        return of_host & F.startswith(path, r["path"])

    return F.get(F.filter(table, fits), F.lit(0))


def judged(rows: DataFrame, url: str, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` with host, path and the fitting rule ``found``.

    Each is made by a generator, so that it is computed once and not again
    wherever the next expression uses it.
    """
    parts = F.struct(url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    split = rows.select("*", F.inline(F.array(parts)))
    return split.select("*", F.explode(F.array(fitting_rule(F.col("host"), F.col("path"), rules))).alias("found"))


# fixed values of HTML: character references by name, and how references, tags and attributes are written
NAMED = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
REFERENCE = r"&(?:amp|lt|gt|quot|apos|#0*+[0-9]{0,7}|#[xX]0*+[0-9a-fA-F]{0,6});"
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
TAG = r"(?i)<(?:link|meta|base)\b[^<>]*+>"
ATTRIBUTE = r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
REFRESH = r"(?is)^\s*(?:[0-9.]+[\s;,]+(?:url\s*=\s*)?|url\s*=\s*)(?:\"([^\"]*)|'([^']*)|(.*))"


def _character(reference: Column) -> Column:
    is_hex = F.lower(F.substring(reference, 1, 3)) == "&#x"
    digits = F.regexp_extract(reference, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
    code = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    by_name = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
    return F.when(F.startswith(reference, F.lit("&#")), numbered).otherwise(F.try_element_at(by_name, reference))


def unescaped(text: Column) -> Column:
    """``text`` with its character references replaced, each once: ``&amp;lt;`` gives ``&lt;``."""
    found = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    between = F.split(text, REFERENCE, -1)

    def joined(part: Column, i: Column) -> Column:
        return F.concat(part, F.coalesce(_character(F.get(found, i)), F.lit("")))

    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(between, joined), "")).otherwise(text)


def _attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute ``name`` of a tag, unescaped, without space around it; null if it has none."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
    values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
    value = F.get(values, F.array_position(names, F.lit(name)).cast("int") - 1)
    plain = F.regexp_replace(value, r"^(?:\"([^\"]*)\"|'([^']*)')$", "$1$2")
    return F.regexp_replace(unescaped(plain), r"^\s+|\s+$|[\t\r\n]", "")


def resolve(link: Column, base: Column) -> Column:
    """Absolute url of a link found at the url ``base`` (RFC 3986, 5.2), its dot segments left to ``url_key``.

    Null for a link within the page and for a scheme without a host, as ``mailto:``.
    """
    link = F.substring_index(link, "#", 1)
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), url_host(base))
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    return (
        F.when(link == "", None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(link.rlike(r"^[^:]*://[^/?]"), link))
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, url_path(base), link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def _once(**columns: Column) -> Column:
    """The columns as a generator, so that each is computed once and not wherever a later one uses it."""
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) of all canonical links and meta refreshes in the pages' html.

    Tags in comments don't count; links are resolved against the first
    ``<base href>``, or else the page's url.
    """
    found = F.regexp_extract_all(F.regexp_replace("html", COMMENT, ""), F.lit(TAG), F.lit(0))
    tags = stored(
        pages.filter(F.col("html").rlike("(?i)canonical|refresh")).select(F.col("url").cast("string").alias("url"), found.alias("tags")),
        "url-tags",
    )
    first_base = F.get(F.filter("tags", lambda t: t.rlike(r"(?i)^<base\b.*\bhref\s*=")), F.lit(0))
    based = tags.select("url", "tags", _once(given=_attribute(first_base, "href")))
    based = based.select("url", "tags", _once(base=F.coalesce(resolve(F.col("given"), F.col("url")), F.col("url"))))
    tag = F.col("tag")
    of_tag = based.select("url", "base", F.explode("tags").alias("tag")).filter(~tag.rlike(r"(?i)^<base\b"))
    read = of_tag.select(
        "url",
        "base",
        _once(
            kinds=F.split(F.lower(F.coalesce(_attribute(tag, "rel"), F.lit(""))), r"\s+"),
            is_refresh=F.lower(_attribute(tag, "http-equiv")) == "refresh",
            is_link=tag.rlike(r"(?i)^<link\b"),
            href=_attribute(tag, "href"),
            content=_attribute(tag, "content"),
        ),
    )
    target = F.concat(*[F.regexp_extract("content", REFRESH, group) for group in (1, 2, 3)])
    link = F.when(F.col("is_link"), F.when(F.array_contains("kinds", "canonical"), F.col("href"))).when(F.col("is_refresh"), F.trim(target))
    links = read.select("url", "base", _once(link=link)).filter("link <> ''")
    return links.select(F.col("url").alias("src"), _once(dst=resolve(F.col("link"), F.col("base"))))


def alias_verdicts(links: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    """(key, blocked) of each url in ``links``: what its class of aliases has decided.

    None without links.  A class is blocked if a rule blocks one of its urls
    and none is allowed by a rule.
    """
    keys = F.array(F.struct(url_key(F.col("src")).alias("src"), url_key(F.col("dst")).alias("dst")))
    pairs = links.select(F.inline(keys))
    pairs = stored(pairs.dropna().filter("src <> dst").distinct(), "url-links")
    if pairs.isEmpty():
        return None
    classes = connected_components(pairs.select(F.xxhash64("src").alias("u"), F.xxhash64("dst").alias("v")))
    urls = pairs.select(F.col("src").alias("key")).union(pairs.select("dst")).distinct()
    urls = urls.withColumn("node", F.xxhash64("key"))
    member = stored(
        judged(urls, "key", rules).join(classes, "node", "left").select(
            "key", F.coalesce("component", "node").alias("component"), F.col("found.verdict").alias("verdict")
        ),
        "url-members",
    )
    decided = member.groupBy("component").agg(
        (F.max((F.col("verdict") == "block").cast("int")) == 1).alias("has_block"),
        (F.max((F.col("verdict") == "allow").cast("int")) == 1).alias("has_allow"),
    )
    blocked = stored(
        decided.filter(F.col("has_block") & ~F.coalesce("has_allow", F.lit(False))).select("component"), "url-blocked"
    )
    return member.join(blocked, "component", "left_semi").select("key", F.lit(True).alias("blocked"))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], *, redirects: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages`` (page_id, url, html).

    ``redirects`` (src, dst) adds observed redirects to the links in the html.
    A rule that fits decides; else a class of aliases with a blocked and no
    allowed url blocks; else ``default``.

    A null url, or one without ``://``, has an empty host and path and no
    aliases; null html has no links.  Repeated rows are judged each; an empty
    table gives no rows; other columns are ignored.  Of html that is cut off, the
    tags that end count; one whose attributes hold ``<`` or ``>`` isn't read.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("src", "dst"))
    aliases = alias_verdicts(links, rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    pages = judged(rows, "url", rules)
    if aliases is None:
        alias_block = F.lit(False)
    else:
        pages = pages.withColumn("key", url_key(F.col("url"))).join(aliases, "key", "left")
        alias_block = F.coalesce("blocked", F.lit(False))
    verdict = F.coalesce(F.col("found.verdict"), F.when(alias_block, "block"), F.lit(default))
    return pages.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))
