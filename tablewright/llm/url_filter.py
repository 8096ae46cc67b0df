"""URL rules, and block decisions carried over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import query, table
from tablewright.llm.components import components
from tablewright.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parts of an address that do not change what it names; the same in Java and RE2 syntax.
MIRROR_HOST = r"^(www|m)\."
PAGE_SUFFIX = r"(/|\.html)$"
TRACKING = r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"

#: Whole tags (a ">" in quotes does not end one), and an attribute: name, then value with its quotes.
TAGS = r"""(?is)<(?:link|meta|base)(?=[\s/])(?:[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>|[^>]*+>)"""
ATTRIBUTE = r"""(?s)([^\s"'>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
#: The address in the content of a refresh, in either quotes or none.
REFRESH_URL = r"""(?is)^[^=]*?url\s*=\s*(?:"([^"]*)|'([^']*)|([^"'\s].*))"""

Rule = tuple[str, str, str]


def _rest(url: Column) -> Column:
    """What follows the first "://"; NULL without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)"))


def with_address(urls: DataFrame) -> DataFrame:
    """Add host, path and the key of the canonical form to a table with a column ``url``.

    The key drops the scheme, a leading "www." or "m.", a "/" or ".html" at the end of the path,
    tracking parameters and the fragment. Addresses without "://" have empty host and path and
    stand for themselves.
    """
    rest = _rest(F.col("url"))
    parts = urls.withColumns({
        "host": F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit("")),
        "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
        "_query": F.coalesce(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), F.lit(""))})
    kept = F.regexp_replace(F.regexp_replace("_query", TRACKING, ""), "^&", "")
    key = F.concat(F.regexp_replace("host", MIRROR_HOST, ""), F.regexp_replace("path", PAGE_SUFFIX, ""),
                   F.lit("?"), kept)
    return parts.withColumn("key", F.when(F.locate("://", F.col("url")) > 0, key).otherwise(F.col("url"))).drop("_query")


def match_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` and ``action`` of the longest rule that fits; NULL where none does.

    Rules are (host, path, action) rows. Every host is looked up with all its parent domains, so
    the rules are found by an equality join whatever their number; of equally long rules "allow" wins.
    """
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action")
    looked = addresses.withColumn("rule_host", F.explode(parents)).join(listed, "rule_host", "left")
    found = F.when(F.col("rule_path").isNotNull() & F.startswith("path", "rule_path"), F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("length"), (F.col("action") == "allow").alias("allows"),
        F.concat("rule_host", "rule_path").alias("rule"), "action"))
    best = looked.groupBy("url").agg(F.first("host").alias("host"), F.first("path").alias("path"),
                                     F.first("key").alias("key"), F.max(found).alias("best"))
    return best.select("url", "host", "path", "key", "best.rule", "best.action")


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it.

    A column that is named twice becomes two copies of its expression when the optimizer merges
    projections; the variable of a lambda function stays one.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _tag(tag: Column) -> Column:
    """Kind of a tag and its first rel, href, http-equiv (event) and content, without quotes; NULL where it has none."""
    pairs = F.struct(F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower).alias("names"),
                     F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2)).alias("values"))

    def value(read: Column, name: str) -> Column:
        found = F.get(read["values"], (F.array_position(read["names"], name) - 1).cast("int"))
        return F.trim(F.regexp_replace(F.regexp_replace(found, r"""(?s)^(["'])(.*)\1$""", "$2"), "&amp;", "&"))

    return _bound(pairs, lambda read: F.struct(F.lower(F.substring(tag, 2, 4)).alias("kind"), *[
        value(read, name).alias(to) for name, to in (("rel", "rel"), ("href", "href"), ("http-equiv", "event"), ("content", "content"))]))


def _resolved(target: Column, base: Column) -> Column:
    """A target as an address: relative ones from scheme, host and path of ``base``; NULL if that names none."""
    parts = F.struct(F.regexp_replace(target, r"[\t\r\n]", "").alias("to"), base.alias("base"), F.regexp_extract(base, r"^([^/?#]*):", 1).alias("scheme"),
                     F.regexp_extract(base, r"^([^/?#]*://[^/?#]*)", 1).alias("host"), F.regexp_extract(base, r"^[^/?#]*://[^/?#]*([^?#]*)", 1).alias("path"))

    def whole(p: Column) -> Column:
        to = p["to"]
        folder = F.concat(p["host"], F.regexp_extract(p["path"], r"(?s)^(.*/)?", 1), F.when(p["path"] == "", "/").otherwise(""))
        return F.when(F.length(to) == 0, None).when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), to).when(p["host"] == "", None).when(
            F.startswith(to, F.lit("//")), F.concat(p["scheme"], F.lit(":"), to)).when(F.startswith(to, F.lit("/")), F.concat(p["host"], to)).when(
            F.startswith(to, F.lit("?")), F.concat(p["host"], p["path"], to)).when(
            F.startswith(to, F.lit("#")), F.concat(F.regexp_extract(p["base"], r"^([^#]*)", 1), to)).otherwise(F.concat(folder, to))

    def plain(p: Column) -> Column:
        """The address without "." and ".." in its path, whose first step is empty, as it begins with "/"."""
        steps = p["steps"]
        walked = F.aggregate(steps, F.array().cast("array<string>"), lambda at, step: F.when(step == ".", at).when(
            step == "..", F.slice(at, 1, F.greatest(F.lit(1), F.size(at) - 1))).otherwise(F.concat(at, F.array(step))))
        closing = F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        joined = F.concat(F.regexp_extract(p["whole"], r"^([^/?#]*://[^/?#]*)", 1), F.array_join(F.concat(walked, closing), "/"),
                          F.regexp_extract(p["whole"], r"(?s)^[^?#]*(.*)", 1))
        return F.when(p["whole"].contains("://"), F.when(F.exists(steps, lambda step: step.isin(".", "..")), joined).otherwise(p["whole"]))

    return _bound(parts, lambda p: _bound(whole(p), lambda w: _bound(F.struct(
        w.alias("whole"), F.split(F.regexp_extract(w, r"^[^/?#]*://[^/?#]*([^?#]*)", 1), "/").alias("steps")), plain)))


def _named(tag: Column) -> Column:
    """What a tag's canonical link or refresh names, as it is written; else NULL."""
    later = F.concat(*[F.regexp_extract(tag["content"], REFRESH_URL, k) for k in (1, 2, 3)])
    return F.when((tag["kind"] == "link") & F.array_contains(F.split(F.lower(tag["rel"]), r"\s+"), "canonical"), tag["href"]).when(
        (tag["kind"] == "meta") & (F.lower(tag["event"]) == "refresh"), F.trim(later))


def page_edges(pages: DataFrame) -> DataFrame:
    """(source, target) addresses of all canonical links and refresh redirects in the pages' HTML.

    Attributes may come in any order, with either quotes or none; relative targets are resolved against
    the page's base tag, if it has one, and its address.
    """
    marked = pages.select("url", "html").where(
        "url IS NOT NULL").where(F.lower("html").contains("canonical") | F.lower("html").contains("refresh"))

    def targets(tags: Column) -> Column:
        """Addresses that a page's tags name."""
        of_base = F.get(F.filter(tags, lambda t: (t["kind"] == "base") & t["href"].isNotNull()), F.lit(0))["href"]
        return _bound(F.coalesce(_resolved(of_base, F.col("url")), F.col("url")), lambda base: F.transform(
            F.filter(F.transform(tags, _named), lambda name: name.isNotNull()), lambda name: _resolved(name, base)))

    read = F.transform(F.regexp_extract_all("html", F.lit(TAGS), F.lit(0)), _tag)
    # The outer form keeps Spark from testing the whole expression once more in a filter before it.
    found = marked.select(F.col("url").alias("source"), F.explode_outer(_bound(read, targets)).alias("target"))
    return found.where("target IS NOT NULL")


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None,
               default: str = "allow") -> DataFrame:
    """Per page: page_id, url, host, path, rule, action, verdict.

    A rule that fits decides. Pages without one follow their group: a connected component of the graph
    of addresses, whose edges are canonical links and refresh redirects in the HTML, ``redirects``
    (source, target), and each address with its canonical form, in either direction. A group in which a
    rule blocks an address is blocked, unless a rule explicitly allows one of its addresses; a group
    without rules gets ``default``. Targets that are no pages count with their rules.

    Works on distinct addresses, so a hot address is judged once. Addresses that share their form with no
    other and have no link stay out of the graph. NULL addresses have empty host and path, no rule and no
    group. Repeated rows are all kept; other columns are ignored; an empty table gives no row.
    """
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL"))
    edges = materialize(edges.distinct(), "url-edges")
    ends = edges.select(F.col("source").alias("url")).union(edges.select(F.col("target").alias("url")))
    urls = pages.select("url").where("url IS NOT NULL").union(ends).distinct()
    judged = materialize(match_rules(with_address(urls), rules), "url-rules")
    # Nodes are addresses and forms, told apart by their first letter.
    forms = judged.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    address = F.concat(F.lit("a:"), F.col("url"))
    links = judged.join(forms, "key").select(address.alias("a"), F.concat(F.lit("f:"), F.col("key")).alias("b")).union(
        edges.select(*[F.concat(F.lit("a:"), F.col(c)) for c in ("source", "target")]))
    groups = components(links)
    judged = judged.withColumn("node", address).join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    by_group = judged.where("action IS NOT NULL").groupBy("group").agg(
        F.bool_or(F.col("action") == "block").alias("blocked"), F.bool_or(F.col("action") == "allow").alias("allowed"))
    carried = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise(default)
    verdicts = judged.join(by_group, "group", "left").select(
        "url", "host", "path", "rule", "action", F.coalesce("action", carried).alias("verdict"))
    return pages.select("page_id", "url").join(verdicts, "url", "left").select(
        "page_id", "url", *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")], "rule", "action",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))


PAGE_RULES: Sequence[Rule] = (("com", "/", "allow"), ("example.com", "/en/", "block"),
                              ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def _address_sql(source: str) -> str:
    """host, path and key of a relation with a column url."""
    rest = "substr(url, strpos(url, '://') + 3)"
    has = "strpos(url, '://') > 0"
    host = f"translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    return f"""
  SELECT *, CASE WHEN {has} THEN regexp_replace(host, '{MIRROR_HOST}', '') || regexp_replace(path, '{PAGE_SUFFIX}', '')
      || '?' || regexp_replace(regexp_replace(query, '{TRACKING}', '', 'g'), '^&', '') ELSE url END AS key
  FROM (SELECT *, CASE WHEN {has} THEN {host} ELSE '' END AS host,
          CASE WHEN {has} THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
          CASE WHEN {has} THEN regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1) ELSE '' END AS query
        FROM {source})"""


def _resolved_sql(target: str, base: str) -> str:
    """The address that a target names from a base, as one expression."""
    plain = f"regexp_replace({target}, '[\\t\\r\\n]', '', 'g')"
    origin = f"regexp_extract({base}, '^[^/?#]*://[^/?#]*')"
    path = f"regexp_extract({base}, '^[^/?#]*://[^/?#]*([^?#]*)', 1)"
    whole = f"""CASE WHEN {plain} = '' THEN NULL WHEN regexp_matches({plain}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {plain}
      WHEN {origin} = '' THEN NULL WHEN starts_with({plain}, '//') THEN regexp_extract({base}, '^[^/?#]*:') || {plain}
      WHEN starts_with({plain}, '/') THEN {origin} || {plain} WHEN starts_with({plain}, '?') THEN {origin} || {path} || {plain}
      WHEN starts_with({plain}, '#') THEN regexp_extract({base}, '^[^#]*') || {plain}
      ELSE {origin} || CASE WHEN {path} = '' THEN '/' ELSE regexp_extract({path}, '(?s)^(.*/)?') END || {plain} END"""
    return f"""(SELECT CASE WHEN strpos(w, '://') = 0 THEN NULL WHEN NOT list_has_any(steps, ['.', '..']) THEN w
      ELSE regexp_extract(w, '^[^/?#]*://[^/?#]*') || list_reduce(list_prepend('', steps[2:]), lambda x, y: CASE y
             WHEN '.' THEN x WHEN '..' THEN regexp_replace(x, '/[^/]*$', '') ELSE x || '/' || y END)
           || CASE WHEN steps[-1] IN ('.', '..') THEN '/' ELSE '' END || regexp_extract(w, '^[^?#]*((?s).*)', 1) END
    FROM (SELECT w, string_split(regexp_extract(w, '^[^/?#]*://[^/?#]*([^?#]*)', 1), '/') AS steps FROM (SELECT {whole} AS w)))"""


def _value_sql(name: str) -> str:
    return f"""trim(replace(regexp_replace(list_extract(vals, list_position(names, '{name}')), '^("(.*)"|''(.*)'')$', '\\2\\3', 's'), '&amp;', '&'))"""


_ATTRIBUTE = ATTRIBUTE.replace("'", "''")
OP9_SQL = f"""
WITH RECURSIVE tags AS (
  SELECT page, url, row_number() OVER () AS place, tag FROM (
    SELECT page, url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta|base)[\\s/](?:(?:[^>"'']|"[^"]*"|''[^'']*'')*>|[^>]*>)')) AS tag
    FROM (SELECT row_number() OVER () AS page, url, html FROM pages)
    WHERE url IS NOT NULL AND (contains(lower(html), 'canonical') OR contains(lower(html), 'refresh')))),
read AS (
  SELECT page, url, place, lower(tag[2:5]) AS kind, {_value_sql("rel")} AS rel, {_value_sql("href")} AS href,
         {_value_sql("http-equiv")} AS event, {_value_sql("content")} AS content
  FROM (SELECT *, list_transform(regexp_extract_all(tag, '{_ATTRIBUTE}', 1), lambda n: lower(n)) AS names,
               regexp_extract_all(tag, '{_ATTRIBUTE}', 2) AS vals FROM tags)),
based AS (
  SELECT page, url, coalesce({_resolved_sql("href", "url")}, url) AS base
  FROM (SELECT page, url, arg_min(href, place) FILTER (kind = 'base' AND href IS NOT NULL) AS href FROM read GROUP BY page, url)),
named AS (
  SELECT page, href AS name FROM read WHERE kind = 'link' AND list_contains(string_split_regex(lower(rel), '\\s+'), 'canonical') AND href IS NOT NULL
  UNION ALL
  SELECT page, trim(concat({", ".join(f"regexp_extract(content, '{REFRESH_URL.replace(chr(39), chr(39) * 2)}', {k})" for k in (1, 2, 3))}))
  FROM read WHERE kind = 'meta' AND lower(event) = 'refresh' AND content IS NOT NULL),
edges AS (
  SELECT DISTINCT source, target FROM (SELECT b.url AS source, {_resolved_sql("n.name", "b.base")} AS target FROM named n JOIN based b ON b.page = n.page)
  WHERE target IS NOT NULL),
urls AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT source FROM edges UNION SELECT target FROM edges),
addressed AS ({_address_sql("urls")}),
rules(rule_host, rule_path, action) AS (VALUES {", ".join(str(r) for r in PAGE_RULES)}),
judged AS (
  SELECT url, host, path, key, rule, action FROM (
    SELECT a.*, rule_host || rule_path AS rule, action,
           row_number() OVER (PARTITION BY url ORDER BY length(rule_host || rule_path) DESC NULLS LAST, action = 'allow' DESC) AS place
    FROM addressed a LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
  WHERE place = 1),
links AS (
  SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges
  UNION SELECT x.url, y.url FROM judged x JOIN judged y ON x.key = y.key AND x.url <> y.url),
reach(url, other) AS (
  SELECT url, url FROM judged UNION SELECT r.url, l.b FROM reach r JOIN links l ON l.a = r.other),
carried AS (
  SELECT r.url, bool_or(action = 'block') AND NOT bool_or(action = 'allow') AS blocked
  FROM reach r JOIN judged j ON j.url = r.other WHERE action IS NOT NULL GROUP BY r.url)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(action, CASE WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM pages p LEFT JOIN judged j ON p.url = j.url LEFT JOIN carried c ON c.url = j.url
"""


@query("op9_url_filter", OP9_SQL)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(PAGE_RULES), "host string, path string, action string")
    judged = judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")
