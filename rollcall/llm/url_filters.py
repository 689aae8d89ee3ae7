"""URL rules whose block decisions reach aliases (operator 3).

Longest rules decide the addresses they fit.  The others take the decision of
their aliases: addresses tied by redirects and canonical links are one class, and
a class that holds a blocked address is blocked, unless an address in it is
explicitly allowed.  DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.components import connected_components
from rollcall.plans.staging import written

#: Rules as (host, path, verdict), a rule being written as host and path in a row; a list of them or a table.
Rules = Sequence[tuple[str, str, str]] | DataFrame
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TAGS = r"(?is)<(?:link|meta)\s[^<>]*>"
_CANONICAL = r"(?is)\srel\s*=\s*[\"']?[^\"'<>]*\bcanonical\b"
_HREF = r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+))"
_REFRESH = r"(?is)\shttp-equiv\s*=\s*[\"']?refresh\b"
_TARGET = r"(?is)\scontent\s*=\s*[\"'][^\"'<>]*?\burl\s*=\s*([^\"'\s<>]+)"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column | str) -> Column:
    """Lower-case host, empty for a null address or one without ``://``."""
    host = F.regexp_extract(_rest(F.col(url) if isinstance(url, str) else url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column | str) -> Column:
    """Path up to ``?`` or ``#``, empty for a null address or one without ``://``."""
    rest = _rest(F.col(url) if isinstance(url, str) else url)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Rules) -> DataFrame:
    """``(host, path, verdict)``, written, so that its size is known; rules with a null are none."""
    if not isinstance(rules, DataFrame):
        fields = "array<struct<host:string,path:string,verdict:string>>"
        listed = F.array(*[F.struct(*map(F.lit, rule)) for rule in rules]).cast(fields)
        rules = spark.range(1).select(F.inline(listed))
    rules = rules.select(*[F.col(name).cast("string") for name in ("host", "path", "verdict")]).dropna()
    return written(rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict")))


def fitting_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` of the distinct addresses that a rule of :func:`rule_table` fits.

    The longest rule counts, then the one with the longer host, then allow.  A host meets
    the rules of its own suffixes, of at most as many labels as a rule has, and the path
    is cut to the lengths that the suffix's rules have: equality joins alone, whose rows
    do not grow with the number of rules of a host, only with their different lengths.
    """
    labels = F.split("host", r"\.")
    most = rules.agg(F.max(F.size(labels)).alias("most")).first().most or 1
    from_label = F.sequence(F.greatest(F.lit(1), F.size(labels) - (most - 1)), F.size(labels))
    suffixes = F.transform(from_label, lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    asked = addresses.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("suffix"))
    lengths = written(rules.select(F.col("host").alias("suffix"), F.length("path").alias("length")).distinct())
    cut = asked.join(lengths, "suffix").filter(F.col("length") <= F.length("path"))
    cut = cut.select("host", "path", "suffix", F.expr("substring(path, 1, length)").alias("start"))
    whole = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "verdict")
    rule = F.concat("suffix", "start")
    order = F.struct((-F.length(rule)).alias("length"), (-F.length("suffix")).alias("host_length"), "verdict", rule.alias("rule"))
    best = cut.join(whole, ["suffix", "start"]).groupBy("host", "path").agg(F.min(order).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def address_node(url: Column | str) -> Column:
    """What two spellings of one address share: host, path and query, without scheme and fragment; else null."""
    url = F.col(url) if isinstance(url, str) else url
    path = path_of(url)
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    whole = F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(path), query)
    return F.when(host_of(url) != "", whole)


def _resolved(target: Column, page: Column) -> Column:
    """An absolute address for a link found on a page; dot segments stay as they are."""
    scheme = F.concat(F.substring_index(page, "://", 1), F.lit("://"))
    folder = F.regexp_replace(path_of(page), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(F.instr(target, "://") > 0, target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(scheme, host_of(page), target))
        .when(F.startswith(target, F.lit("?")), F.concat(scheme, host_of(page), path_of(page), target))
        .otherwise(F.concat(scheme, host_of(page), folder, target))
    )


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(source, target)`` addresses tied by a canonical link or a redirect in the page's head.

    Pages without text, address or such a tag give no row.
    """
    tags = F.regexp_extract_all(F.col(html), F.lit(_TAGS), F.lit(0))

    def target(tag: Column) -> Column:
        href = F.concat(*[F.regexp_extract(tag, _HREF, k) for k in (1, 2, 3)])
        return F.trim(F.when(tag.rlike(_CANONICAL), href).otherwise(F.regexp_extract(tag, _TARGET, 1)))

    tagged = F.filter(tags, lambda tag: tag.rlike(_CANONICAL) | tag.rlike(_REFRESH))
    found = pages.select(F.col(url).alias("source"), F.explode(F.transform(tagged, target)).alias("target"))
    return found.select("source", _resolved(F.col("target"), F.col("source")).alias("target"))


def judge(
    pages: DataFrame,
    links: DataFrame,
    rules: Rules = RULES,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    ``links`` holds ``(source, target)`` addresses; either may be on no page.  ``rules`` is
    a list of ``(host, path, verdict)`` or a table with these columns, of any length.  A
    null address, or one without ``://``, has an empty host and path, fits no rule and has
    no alias: it is allowed.  Rows may repeat; only the named columns are read.  An empty
    table gives an empty one; without rules all is allowed.
    """
    table = rule_table(pages.sparkSession, rules)
    addresses = pages.select(F.col(key), F.col(url).cast("string").alias("_url"))
    judged = addresses.select(
        key, host_of("_url").alias("host"), path_of("_url").alias("path"), address_node("_url").alias("_node")
    )
    # both written, so that the joins with the pages have plain exchanges, which Spark can split at a hot address
    fits = written(fitting_rules(judged, table).select("host", "path", "rule", F.col("verdict").alias("_verdict")))
    ties = links.select(address_node("source").alias("u"), address_node("target").alias("v"))
    classes = connected_components(written(ties), "u", "v")
    host = F.regexp_extract("node", r"^[^/?]*", 0).alias("host")
    members = written(classes.select("node", "component", host, F.regexp_extract("node", r"^[^/?]*([^?]*)", 1).alias("path")))
    known = members.join(fitting_rules(members, table), ["host", "path"])
    # the least verdict of a class is block only if none is allow
    sides = known.groupBy("component").agg(F.min("verdict").alias("least"))
    refused = members.join(sides.filter("least = 'block'").select("component"), "component", "left_semi")
    refused = written(refused.select(F.col("node").alias("_node"), F.lit("block").alias("_alias")))
    return judged.join(fits, ["host", "path"], "left").join(refused, "_node", "left").select(
        key, "host", "path", "rule", F.coalesce("_verdict", "_alias", F.lit("allow")).alias("verdict")
    )


def op3_url_filters(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return judge(pages, alias_links(pages))


# The given pages hold no canonical link or redirect tag of a page with another verdict.
OP3_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), fits AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM named
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""
