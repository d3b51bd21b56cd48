"""URL filters: rules judge addresses, and blocks reach aliases through redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, query, table
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# How pages name another address for themselves. A tag ends at its first ">".
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
_TAG = r"(?i)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?i)[\s"'/]rel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_REFRESH = r"""(?i)[\s"'/]http-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?i)[\s"'/]href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_CONTENT = r"""(?i)[\s"'/]content\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TARGET = r"""(?i)[;,\s]\s*url\s*=\s*["']?([^"']*)"""
_SPACE = " \t\n\r\x0c"


def _after(text: Column, mark: str) -> Column:
    """What stands after the first ``mark``; null without one."""
    at = F.locate(mark, text)
    return F.when(at > 0, F.substr(text, at + len(mark)))


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty without one."""
    return _lowered(F.coalesce(F.regexp_extract(_after(url, "://"), "^([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; empty without a host's "://"."""
    return F.coalesce(F.regexp_extract(_after(url, "://"), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query: scheme and fragment do not make another page. Null without "://"."""
    rest = _after(url, "://")
    return F.concat(_lowered(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1))


def _attribute(tag: Column, pattern: str) -> Column:
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.trim(F.replace(value, F.lit("&amp;"), F.lit("&")), F.lit(_SPACE))


def _resolved(target: Column, url: Column) -> Column:
    """A target as an absolute address, seen from a page; null if it names no web page."""
    base = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_extract(path_of(url), "^(.*/)", 1)
    return (
        F.when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(base, target))
        .when(F.startswith(target, F.lit("?")), F.concat(base, path_of(url), target))
        .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, target) of each canonical link and each redirect (meta refresh) that pages hold.

    Comments, scripts and styles do not count.  Relative targets go by the page's own address; dot
    segments are not resolved.  Null pages, pages without an address and targets of other kinds
    (``mailto:``) give no rows.
    """
    held = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    held = held.where((F.locate("://", "url") > 0) & F.col("html").rlike("(?i)canonical|http-equiv"))
    tags = held.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", _HIDDEN, ""), F.lit(_TAG), 0)).alias("tag"))
    tag = F.col("tag")
    target = F.when(tag.rlike("(?i)^<link") & tag.rlike(_CANONICAL), _attribute(tag, _HREF)).when(
        tag.rlike("(?i)^<meta") & tag.rlike(_REFRESH),
        F.trim(F.regexp_extract(F.concat(F.lit(";"), _attribute(tag, _CONTENT)), _TARGET, 1), F.lit(_SPACE)),
    )
    found = tags.select("url", target.alias("target")).where("target is not null")
    return found.select("url", _resolved(F.col("target"), F.col("url")).alias("target")).where("target is not null")


def fitting_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(address, rule, action) of the addresses that a rule fits; the longest rule wins, then "allow".

    ``addresses`` has unique ``address`` with ``host`` and ``path``, ``rules`` has ``host``, ``path``
    and ``action``.  An address is looked up under its domains and the beginnings of its path, of the
    sizes that rules use, so it is one equi-join whatever the number of rules.  Rules without a host
    fit nothing.
    """
    keyed = rules.where("host <> ''").select(
        F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"),
        F.col("action"),
        F.size(F.split("host", r"\.")).alias("_labels"),
        F.length(F.coalesce("path", F.lit(""))).alias("_length"),
    )
    # Two short arrays, bounded by the deepest domain and the longest path of a rule.
    labels, lengths = (keyed.agg(F.coalesce(F.collect_set(c), F.array())).scalar() for c in ("_labels", "_length"))
    sized = addresses.withColumns({"_labels": labels, "_lengths": lengths})

    def under(n: Column) -> Column:
        domain = F.call_function("substring_index", F.col("host"), F.lit("."), -n)
        fitting = F.filter("_lengths", lambda m: m <= F.length("path"))
        return F.transform(fitting, lambda m: F.concat(domain, F.left(F.col("path"), m)))

    keys = F.array_distinct(F.flatten(F.transform("_labels", under)))
    looked_up = sized.select("address", F.explode(keys).alias("rule"))
    fitting = looked_up.join(keyed.select("rule", "action"), "rule")
    best = F.struct(-F.length("rule"), "action", "rule")
    return fitting.groupBy("address").agg(F.min(best).alias("best")).select(
        "address", F.col("best.rule").alias("rule"), F.col("best.action").alias("action")
    )


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, url_col: str = "url") -> DataFrame:
    """``pages`` with the columns ``_host``, ``_path``, ``_rule`` and ``_verdict`` added.

    A rule (``host``, ``path``, ``action``) fits its host and all subdomains if an address' path starts
    with the rule's.  The rule that fits decides.  An address that no rule fits is blocked if
    its component of ``links`` (``url``, ``target``) holds a blocked address, also one no page has;
    else it is allowed.  So an explicit allow is never overruled by an alias, and of two equally long
    rules the one that allows wins.

    Each address is judged once, however many rows have it.  A null url, or one without "://", has
    an empty host and path, no rule and no aliases, and is allowed.  Rows are kept as they are, also
    repeated ones.  No rows give no rows; without rules all is allowed.  Names of other columns do
    not matter, but the four added ones replace columns of their name.
    """
    spark = pages.sparkSession
    if links is None:
        links = spark.createDataFrame([], "url string, target string")
    ends = links.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b"))
    ends = materialise(ends.where("a is not null and b is not null and a <> b").distinct(), "url-links")
    urls = pages.select(F.col(url_col).alias("url")).unionByName(links.select("url"))
    urls = urls.unionByName(links.select(F.col("target").alias("url")))
    addresses = urls.select(
        address_of(F.col("url")).alias("address"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    ruled = materialise(fitting_rules(addresses.where("address is not null").distinct(), rules), "url-rules")

    members = materialise(connected_components(ends, split_hubs=True), "url-aliases")
    blocked = ruled.where("action = 'block'").select(F.col("address").alias("node"))
    tainted = materialise(members.join(blocked, "node").select("component").distinct(), "url-blocked")
    aliases = members.join(tainted, "component").select(F.col("node").alias("address"))
    aliases = aliases.join(ruled, "address", "left_anti")
    verdicts = ruled.unionByName(
        aliases.select("address", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("action"))
    )
    verdicts = materialise(verdicts, "url-verdicts").select(
        F.col("address").alias("_address"), F.col("rule").alias("_rule"), F.col("action").alias("_action")
    )

    own = [c for c in pages.columns if c not in ("_host", "_path", "_rule", "_verdict")]
    named = {c: f"_own_{i}" for i, c in enumerate(own)}
    rows = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    url = F.col(named[url_col])
    rows = rows.withColumn("_address", address_of(url)).join(verdicts, "_address", "left")
    return rows.select(
        *[F.col(n).alias(c) for c, n in named.items()],
        host_of(url).alias("_host"),
        path_of(url).alias("_path"),
        "_rule",
        F.coalesce("_action", F.lit("allow")).alias("_verdict"),
    )


#: The rules of the query: (host, path, action).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_LOWER_SQL = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
_REST_SQL = "substr({0}, strpos({0}, '://') + 3)"


def _sql_place(url: str) -> tuple[str, str, str]:
    """Host, path and address of a url column in SQL."""
    rest, known = _REST_SQL.format(url), f"coalesce({url} LIKE '%://%', false)"
    host = _LOWER_SQL.format(f"regexp_extract({rest}, '^([^/?#]*)', 1)")
    return (
        f"CASE WHEN {known} THEN {host} ELSE '' END",
        f"CASE WHEN {known} THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END",
        f"CASE WHEN {known} THEN {host} || regexp_extract({rest}, '^[^/?#]*([^#]*)', 1) END",
    )


def _sql_attribute(pattern: str) -> str:
    held = pattern.replace("'", "''")
    value = " || ".join(f"coalesce(regexp_extract(tag, '{held}', {i}), '')" for i in (1, 2, 3))
    return f"trim(replace({value}, '&amp;', '&'), chr(32) || chr(9) || chr(10) || chr(13) || chr(12))"


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    host, path, address = _sql_place("url")
    target_host, target_path, target_address = _sql_place("target")
    return f"""WITH RECURSIVE rules(h, p, action) AS (VALUES {rules}),
    tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, {quoted(_HIDDEN)}, '', 'g'), {quoted(_TAG)})) AS tag
        FROM pages WHERE url LIKE '%://%'),
    named AS (SELECT url, CASE
        WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, {quoted(_CANONICAL)}) THEN {_sql_attribute(_HREF)}
        WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, {quoted(_REFRESH)})
            THEN trim(regexp_extract(';' || {_sql_attribute(_CONTENT)}, {quoted(_TARGET)}, 1),
                      chr(32) || chr(9) || chr(10) || chr(13) || chr(12)) END AS t FROM tags),
    linked AS (SELECT url, CASE WHEN t = '' OR t LIKE '#%' THEN NULL
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
        WHEN t LIKE '//%' THEN 'http:' || t
        WHEN t LIKE '/%' THEN 'http://' || {host} || t
        WHEN t LIKE '?%' THEN 'http://' || {host} || {path} || t
        ELSE 'http://' || {host} || coalesce(nullif(regexp_extract({path}, '^(.*/)', 1), ''), '/') || t END AS target
        FROM named WHERE t IS NOT NULL),
    ends AS (SELECT DISTINCT {address} AS a, {target_address} AS b FROM linked WHERE target IS NOT NULL),
    edges AS (SELECT a, b FROM ends WHERE b IS NOT NULL UNION SELECT b, a FROM ends WHERE b IS NOT NULL),
    places AS (SELECT {address} AS address, {host} AS host, {path} AS path FROM pages
        UNION SELECT {target_address}, {target_host}, {target_path} FROM linked WHERE target IS NOT NULL),
    ruled AS (SELECT address, h || p AS rule, action FROM places JOIN rules
        ON address IS NOT NULL AND (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY address ORDER BY length(h || p) DESC, action, h || p) = 1),
    reached(node) AS (SELECT address FROM ruled WHERE action = 'block'
        UNION SELECT b FROM reached JOIN edges ON a = node)
    SELECT page_id, {host} AS host, {path} AS path, rule,
        coalesce(action, CASE WHEN node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
    FROM (SELECT *, {address} AS own FROM pages) LEFT JOIN ruled ON own = ruled.address LEFT JOIN reached ON own = node"""


@query("op11_url_filter", _sql())
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    judged = judge(pages, rules, page_links(pages))
    return judged.select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"),
    )
