
from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions.markup import extract_groups, repair, root_kind, split_bad
from rollcall.functions.measures import co_members, share_hundredths
from rollcall.functions.specs import category_of, parse_bins, parse_categories, parse_ranges
from rollcall.operators import (
    attach_category,
    bin_by_category,
    bin_by_range,
    bin_sizes,
    contribution_scores,
    explode_members,
    member_stats,
    size_histogram,
    sort_scores,
    top_bottom,
    with_rank,
)
from rollcall.plans import documents, orders
from rollcall.plans.staging import passing_folder, written
from rollcall.plans.suite import (
    DEFAULT_BINS,
    DEFAULT_CATEGORIES,
    DEFAULT_YEAR_RANGES,
    FOLDERS,
    JOB_NAMES,
    SORTED,
    run_jobs,
    scan_groups,
)
from rollcall.sinks import write_key_values, write_report, write_table
from rollcall.sources import read_in_order, read_results, read_xml_records

try:  # an optional subpackage and its pipeline, which need further libraries
    import corpus_pipeline
    from rollcall.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    warnings.warn(f"no queries of rollcall.llm: {missing}", stacklevel=2)
    corpus_pipeline = llm_queries = None

TOP = 20


def entry(spark: SparkSession) -> DataFrame:
    """Binned size histogram of orders by category."""
    return queries()["size_by_category_binned"](spark, "/root/testdata/sf0.001")


# --- orders as records ------------------------------------------------------


def size_histogram_query(spark, folder):
    return size_histogram(orders.order_sizes(spark, folder))


def size_histogram_binned(spark, folder):
    return bin_sizes(size_histogram_query(spark, folder), parse_bins(orders.BINS))


def category_lookup(spark, folder):
    table = spark.read.parquet(f"{folder}/orders.parquet")
    category = category_of("o_orderpriority", parse_categories(orders.CATEGORIES))
    kind = F.col("o_orderpriority").alias("kind")
    return table.select("o_orderkey", kind, category.alias("category"))


def category_table_lookup(spark, folder):
    """Customers' countries as kinds, and the regions of these in a table as categories."""
    regions = spark.read.parquet(f"{folder}/region.parquet").where("r_name <> 'ASIA'")
    nations = spark.read.parquet(f"{folder}/nation.parquet").join(regions, F.expr("n_regionkey = r_regionkey"))
    customers = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", F.col("c_nationkey").alias("kind"))
    return attach_category(customers, nations, key="n_nationkey", category="r_name").withColumnRenamed("r_name", "category")


def size_by_category(spark, folder):
    return size_histogram(orders.order_records(spark, folder), ["category"])


def size_by_category_binned(spark, folder):
    categories = parse_categories(orders.CATEGORIES).values()
    histogram = size_by_category(spark, folder)
    return bin_by_category(histogram, parse_bins(orders.BINS), list(categories))


def size_by_year(spark, folder):
    return size_histogram(orders.order_records(spark, folder), ["year"])


def size_by_range_binned(spark, folder):
    ranges = parse_ranges(orders.YEAR_RANGES)
    return bin_by_range(size_by_year(spark, folder), parse_bins(orders.BINS), ranges)


def member_shares(spark, folder):
    rows = orders.order_memberships(spark, folder)
    share = share_hundredths("n").alias("hundredths")
    return rows.select("l_orderkey", "member", share, co_members("n").alias("fellows"))


def contribution_score(spark, folder):
    return contribution_scores(orders.order_memberships(spark, folder))


def sorted_scores(spark, folder):
    return sort_scores(contribution_score(spark, folder))


def sorted_scores_descending(spark, folder):
    return sort_scores(contribution_score(spark, folder), descending=True)


def scores_with_rank(spark, folder):
    return with_rank(contribution_score(spark, folder), [F.col("score"), F.col("member")])


def top_bottom_members(spark, folder):
    return top_bottom(contribution_score(spark, folder), TOP)


def member_stats_query(spark, folder):
    return member_stats(orders.order_memberships(spark, folder))


def member_stats_by_category(spark, folder):
    return member_stats(orders.order_memberships(spark, folder, described=True), ["category"])


# --- record text ------------------------------------------------------------


def repair_markup(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", repair("html").alias("repaired"))


def root_element(spark, folder):
    records = documents.document_records(spark, folder)
    return records.select("doc_id", root_kind("raw").alias("kind"))


# --- documents as XML files -------------------------------------------------


def _scan(spark, folder, **options):
    packed = "split_bytes" not in options
    return read_xml_records(spark, documents.written_documents(spark, folder, packed=packed), **options)


def xml_scan(spark, folder):
    return _scan(spark, folder).select("kind", "raw")


def xml_scan_kinds(spark, folder):
    return _scan(spark, folder, kinds=["article", "www"]).select("kind", "raw")


def xml_scan_any_start(spark, folder):
    return _scan(spark, folder, require_attributes=False).select("kind", "raw")


def xml_scan_offsets(spark, folder):
    """What each record's end adds to the bytes of its file up to there, ranges being short."""
    records = _scan(spark, folder, require_attributes=False, split_bytes=1 << 16)
    so_far = Window.partitionBy("path").orderBy("end_offset").rowsBetween(Window.unboundedPreceding, 0)
    lines = F.sum(F.octet_length("raw") + 1).over(so_far)
    return records.select("kind", "raw", (F.col("end_offset") - lines).alias("beyond"))


def xml_scan_untidy(spark, folder):
    return read_xml_records(spark, documents.written_untidy(spark, folder)).select("kind", "raw")


def xml_scan_end_tag(spark, folder):
    """Records up to their own end tags, over starts of others, in ranges of 64 KiB."""
    options = {"capture": "end_tag", "split_bytes": 1 << 16}
    return read_xml_records(spark, documents.written_nested(spark, folder), **options).select("kind", "raw")


def _extracted(spark, folder, on_bad="quarantine"):
    return extract_groups(_scan(spark, folder, require_attributes=False), on_bad=on_bad)


def extract_fields(spark, folder):
    good, _ = split_bad(_extracted(spark, folder))
    members = F.array_join("members", "|").alias("members")
    return good.select("kind", "year", F.col("n").cast("bigint"), members)


def bad_records(spark, folder):
    _, bad = split_bad(_extracted(spark, folder))
    return bad.select("kind", F.col("_corrupt_record").alias("text"))


def salvaged_members(spark, folder):
    """All groups, those of bad records with what stands before the place where they break."""
    groups = _extracted(spark, folder, on_bad="salvage").where("_corrupt_record IS NULL")
    members = F.array_join("members", "|").alias("members")
    return groups.select("kind", "year", F.col("n").cast("bigint"), members, "bad_reason", F.col("bad_place").cast("bigint"))


def sorted_members(spark, folder):
    groups = _extracted(spark, folder, on_bad="drop")
    return groups.select("kind", F.array_join(F.array_sort("members"), "|").alias("members"))


def _groups(spark, folder):
    groups, _ = split_bad(scan_groups(spark, documents.written_documents(spark, folder)))
    return groups


def xml_size_binned(spark, folder):
    return bin_sizes(size_histogram(_groups(spark, folder)), parse_bins(DEFAULT_BINS))


def xml_size_by_category_binned(spark, folder):
    histogram = size_histogram(_groups(spark, folder), ["category"])
    categories = list(parse_categories(DEFAULT_CATEGORIES).values())
    return bin_by_category(histogram, parse_bins(DEFAULT_BINS), categories)


def xml_size_by_range_binned(spark, folder):
    histogram = size_histogram(_groups(spark, folder), ["year"])
    return bin_by_range(histogram, parse_bins(DEFAULT_BINS), parse_ranges(DEFAULT_YEAR_RANGES))


def xml_contribution_score(spark, folder):
    return contribution_scores(explode_members(_groups(spark, folder)))


def xml_top_bottom(spark, folder):
    return top_bottom(written(xml_contribution_score(spark, folder)), TOP)


def xml_member_stats(spark, folder):
    return member_stats(explode_members(_groups(spark, folder)))


def xml_member_stats_by_category(spark, folder):
    return member_stats(explode_members(_groups(spark, folder), ["category"]), ["category"])


# --- pages as they are ------------------------------------------------------


def _page_records(spark, folder, kind, **options):
    return read_xml_records(spark, documents.written_pages(spark, folder), kinds=[kind], **options)


def page_articles(spark, folder):
    return _page_records(spark, folder, "article", require_attributes=False).select("kind", "raw")


def page_links(spark, folder):
    return _page_records(spark, folder, "a").select("kind", "raw")


def _link_lists(spark, folder):
    records = _page_records(spark, folder, "nav", require_attributes=False)
    return extract_groups(records, member="a", on_bad="fail")


def page_link_sizes(spark, folder):
    return size_histogram(_link_lists(spark, folder))


def page_link_scores(spark, folder):
    return contribution_scores(explode_members(_link_lists(spark, folder)))


def page_link_stats(spark, folder):
    return member_stats(explode_members(_link_lists(spark, folder)))


# --- written and read back --------------------------------------------------


def _target(spark, name):
    return f"{passing_folder(spark, name)}/result"


def key_value_round_trip(spark, folder):
    target = _target(spark, "scores")
    write_key_values(xml_contribution_score(spark, folder), target)
    return read_results(spark, target, "member string, score double", header=False)


def table_round_trip(spark, folder):
    target = _target(spark, "stats")
    header = ["Author", "Mean", "Median", "Minimum", "Maximum"]
    write_table(xml_member_stats(spark, folder), target, header)
    return read_results(
        spark, target, "member string, mean bigint, median bigint, min bigint, max bigint"
    )


def report_round_trip(spark, folder):
    target = _target(spark, "report")
    write_report(size_by_range_binned(spark, folder), target, ["Bin", "Range", "Records"])
    return read_results(spark, target, "bin string, range string, records bigint")


def results_blank_lines(spark, folder):
    """Lines with a blank one behind each, read back."""
    target = _target(spark, "lines")
    table = spark.read.parquet(f"{folder}/orders.parquet")
    table.select(F.format_string("%d,%s\n", "o_orderkey", "o_orderstatus").alias("line")).write.text(target)
    return read_results(spark, target, "o_orderkey bigint, o_orderstatus string", header=False)


def counts_in_order(spark, folder):
    target = _target(spark, "counts")
    run_jobs(spark, documents.written_documents(spark, folder), target, "AuthorCount")
    return read_in_order(spark, f"{target}/{FOLDERS['AuthorCount']}/counts", "n bigint, records bigint")


def _written_in_order(spark, scores):
    target = _target(spark, "sorted")
    write_key_values(scores, target)
    return read_in_order(spark, target, "member bigint, score double")


def scores_in_order(spark, folder):
    return _written_in_order(spark, sorted_scores(spark, folder))


def scores_in_order_descending(spark, folder):
    return _written_in_order(spark, sorted_scores_descending(spark, folder))


def job_suite(spark, folder):
    """All jobs over the XML files; their reports as ``(job, line)``."""
    target = _target(spark, "jobs")
    reports = run_jobs(spark, documents.written_documents(spark, folder), target)
    lines = None
    for job in JOB_NAMES:
        width = {"AuthorCount": 2, "Authorship": 2, "MeanMedianStatistics": 5}.get(job, 3)
        width = 6 if job == "MeanMedianStatisticsWithStratification" else width
        lines = _with_lines(lines, job, read_results(spark, reports[job], _columns(width)))
    scores = read_results(spark, f"{target}/{SORTED}", _columns(2), header=False)
    return _with_lines(lines, "SortedScores", scores)


def _columns(width):
    return ", ".join(f"c{i} string" for i in range(width))


def _with_lines(lines, job, table):
    named = table.select(F.lit(job).alias("job"), F.concat_ws("|", *table.columns).alias("line"))
    return named if lines is None else lines.unionAll(named)


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run} if llm_queries else {}


def _llm_sql() -> dict[str, str]:
    if not llm_queries:
        return {}
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm_queries.ORACLE_SQL, **whole}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "size_histogram": size_histogram_query,
        "size_histogram_binned": size_histogram_binned,
        "category_lookup": category_lookup,
        "category_table_lookup": category_table_lookup,
        "size_by_category": size_by_category,
        "size_by_category_binned": size_by_category_binned,
        "size_by_year": size_by_year,
        "size_by_range_binned": size_by_range_binned,
        "member_shares": member_shares,
        "contribution_score": contribution_score,
        "sorted_scores": sorted_scores,
        "sorted_scores_descending": sorted_scores_descending,
        "scores_with_rank": scores_with_rank,
        "top_bottom_members": top_bottom_members,
        "member_stats": member_stats_query,
        "member_stats_by_category": member_stats_by_category,
        "repair_markup": repair_markup,
        "root_element": root_element,
        "extract_fields": extract_fields,
        "bad_records": bad_records,
        "salvaged_members": salvaged_members,
        "sorted_members": sorted_members,
        "xml_scan": xml_scan,
        "xml_scan_kinds": xml_scan_kinds,
        "xml_scan_any_start": xml_scan_any_start,
        "xml_size_binned": xml_size_binned,
        "xml_size_by_category_binned": xml_size_by_category_binned,
        "xml_size_by_range_binned": xml_size_by_range_binned,
        "xml_contribution_score": xml_contribution_score,
        "xml_top_bottom": xml_top_bottom,
        "xml_member_stats": xml_member_stats,
        "xml_member_stats_by_category": xml_member_stats_by_category,
        "page_articles": page_articles,
        "page_links": page_links,
        "page_link_sizes": page_link_sizes,
        "page_link_scores": page_link_scores,
        "page_link_stats": page_link_stats,
        "key_value_round_trip": key_value_round_trip,
        "table_round_trip": table_round_trip,
        "report_round_trip": report_round_trip,
        "xml_scan_offsets": xml_scan_offsets,
        "xml_scan_untidy": xml_scan_untidy,
        "xml_scan_end_tag": xml_scan_end_tag,
        "results_blank_lines": results_blank_lines,
        "counts_in_order": counts_in_order,
        "scores_in_order": scores_in_order,
        "scores_in_order_descending": scores_in_order_descending,
        "job_suite": job_suite,
        **_llm_queries(),
    }


# --- SQL counterparts -------------------------------------------------------

# Orders: one row per record and one per membership.
_ORDER_RECORDS = """
sizes AS (
  SELECT l_orderkey, count(l_suppkey) AS n FROM lineitem
  WHERE l_suppkey IS NOT NULL GROUP BY l_orderkey
), records AS (
  SELECT l_orderkey, n, CAST(year(o_orderdate) AS INTEGER) AS year,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'rush' WHEN '2-HIGH' THEN 'rush'
      WHEN '3-MEDIUM' THEN 'normal' WHEN '4-NOT SPECIFIED' THEN 'unset' END AS category
  FROM sizes JOIN orders ON l_orderkey = o_orderkey
)"""
_ORDER_MEMBERS = (
    _ORDER_RECORDS
    + """, members AS (
  SELECT l_orderkey, l_suppkey AS member, n, category
  FROM lineitem JOIN sizes USING (l_orderkey) LEFT JOIN records USING (l_orderkey, n)
  WHERE l_suppkey IS NOT NULL
)"""
)

# Documents: the XML text, and the fields a correct scan and parse must find.
_KIND = """CASE WHEN regexp_full_match(source, 'src[0-9]{1,9}') THEN
      ['article', 'inproceedings', 'proceedings', 'book', 'incollection', 'phdthesis', 'mastersthesis', 'www'][
        CAST(substr(source, 4) AS INTEGER) % 8 + 1]
    ELSE 'article' END"""
_XML = f"""
parts AS (
  SELECT doc_id, source, {_KIND} AS kind,
    string_split(replace(coalesce(text, ''), '<', '&lt;'), ' ') AS words,
    CAST(1890 + n_chars // 50 AS INTEGER) AS y,
    CASE WHEN source = 'src13' THEN 'editor' ELSE 'author' END AS tag
  FROM documents
), tags AS (
  SELECT *,
    '<' || tag || CASE WHEN source = 'src2' THEN ' orcid="0-1"' ELSE '' END || '>'
      || CASE WHEN source = 'src9' THEN '<i>' ELSE '' END AS o,
    CASE WHEN source = 'src9' THEN '</i>' ELSE '' END || '</' || tag || '>' AS c
  FROM parts
), xml AS (
  SELECT doc_id, source, kind,
    '<' || kind || CASE WHEN source = 'src19' THEN '' ELSE ' key=''doc/' || doc_id || '''' END
    || '>' || chr(10)
    || CASE WHEN source = 'src5' THEN '<people>' ELSE '' END
    || array_to_string([o || w || c FOR w IN words], '')
    || CASE WHEN source = 'src5' THEN '</people>' ELSE '' END
    || chr(10) || '<title>On <i>words</i> & <1 more> or a < b'
    || CASE WHEN source = 'src17' THEN '' ELSE '</title>' END
    || CASE source WHEN 'src7' THEN '<year>n.d.</year>' WHEN 'src11' THEN ''
         WHEN 'src3' THEN '<year>1800</year><year>' || y || '</year>'
         ELSE '<year>' || y || '</year>' END
    || '</' || kind || '>' AS raw
  FROM tags
)"""
_ALL_FIELDS = f"""
fields AS (
  SELECT doc_id, source, {_KIND} AS kind,
    CASE WHEN source IN ('src7', 'src11') THEN NULL
      ELSE CAST(1890 + n_chars // 50 AS INTEGER) END AS year,
    CASE WHEN source = 'src13' THEN []::VARCHAR[]
      ELSE [replace(w, chr(10), '') FOR w IN string_split(replace(coalesce(text, ''), '<', '&lt;'), ' ')
        IF replace(w, chr(10), '') <> ''] END AS members
  FROM documents
)"""
_FIELDS = _ALL_FIELDS.replace("FROM documents", "FROM documents WHERE source <> 'src17'")
_REPAIRED = """replace(replace(replace(replace(raw, chr(10), ''), '&', '&amp;'),
  '<1 more>', '&lt;1 more&gt;'), 'a < b', 'a &lt; b')"""
_DOC_RECORDS = (
    _FIELDS
    + """, records AS (
  SELECT doc_id, kind, year, members, CAST(len(members) AS BIGINT) AS n,
    CASE kind WHEN 'article' THEN 'journal' WHEN 'www' THEN 'webpage'
      WHEN 'phdthesis' THEN 'school' WHEN 'mastersthesis' THEN 'school' ELSE 'book' END AS category
  FROM fields WHERE source <> 'src19'
)"""
)
_DOC_MEMBERS = (
    _DOC_RECORDS
    + """, members AS (
  SELECT unnest(members) AS member, n, category FROM records
)"""
)

# Pages: the texts of the links in each page's link list.
_LINK_LISTS = r"""
records AS (
  SELECT links AS members, CAST(len(links) AS BIGINT) AS n
  FROM (SELECT [w FOR w IN regexp_extract_all(replace(nav, chr(10), ''),
      '<a href="[^"]*">([^<]*)</a>', 1) IF w <> ''] AS links
    FROM (SELECT unnest(regexp_extract_all(html, '(?s)<nav[\s>].*?</nav>')) AS nav FROM pages))
), members AS (
  SELECT unnest(members) AS member, n FROM records
)"""
_HISTOGRAM = "SELECT CAST(n AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS records FROM {t} WHERE n > 0 GROUP BY n"
_BINS = """
bins(pos, label, lo, hi) AS (VALUES (0, '1', 1, 1), (1, '2', 2, 2), (2, '3', 3, 3),
  (3, '4-6', 4, 6), (4, '7-10', 7, 10), (5, '11-end', 11, NULL))"""
_INSIDE = "n >= lo AND (hi IS NULL OR n <= hi)"
_LABEL = """CASE WHEN hi IS NULL AND max_n >= lo THEN lo || '-' || max_n ELSE label END"""
_SCORES = """
  SELECT member, ((2 * s + k) // (2 * k)) / 100.0::DOUBLE AS score
  FROM (SELECT member, CAST(sum((200 + n) // (2 * n)) AS BIGINT) AS s, count(*) AS k
    FROM members GROUP BY member)"""
_RANKS = f"""
WITH {{members}}, scores AS ({_SCORES}),
low AS (SELECT row_number() OVER (ORDER BY score, member) AS rank, member FROM scores),
high AS (SELECT row_number() OVER (ORDER BY score DESC, member DESC) AS rank, member FROM scores)
SELECT CAST(rank AS INTEGER) AS rank, low.member AS most_collaborative,
  high.member AS least_collaborative
FROM low FULL JOIN high USING (rank) WHERE rank <= {TOP}"""
_STATS = """
  CAST(sum(n - 1) // count(*) AS BIGINT) AS mean,
  CAST(list_sort(list(n - 1))[count(*) // 2 + 1] AS BIGINT) AS median,
  CAST(min(n - 1) AS BIGINT) AS min, CAST(max(n - 1) AS BIGINT) AS max"""
_STATS_ALL = f"SELECT member, {_STATS} FROM members GROUP BY member"
_STATS_BY = f"SELECT member, category, {_STATS} FROM members WHERE category IS NOT NULL GROUP BY member, category"


def _binned(records):
    return f"""WITH {records}, top AS (SELECT max(n) AS max_n FROM {{t}} WHERE n > 0), {_BINS}
SELECT {_LABEL} AS bin, CAST(count(r.n) AS BIGINT) AS records
FROM bins CROSS JOIN top LEFT JOIN {{t}} r ON {_INSIDE} GROUP BY pos, 1"""


def _by_category(records, categories):
    names = ", ".join(f"('{name}')" for name in categories)
    return f"""WITH {records}, kept AS (SELECT * FROM records WHERE n > 0 AND category IS NOT NULL),
top AS (SELECT max(n) AS max_n FROM kept), categories(name) AS (VALUES {names}), {_BINS}
SELECT {_LABEL} AS bin, name AS category, CAST(count(r.n) AS BIGINT) AS records
FROM bins CROSS JOIN top CROSS JOIN categories
LEFT JOIN kept r ON {_INSIDE} AND r.category = name GROUP BY pos, 1, 2"""


def _by_range(records, ranges):
    items = ", ".join(f"('{label}', {label.replace('-', ', ')})" for label in ranges.split(","))
    return f"""WITH {records}, kept AS (SELECT * FROM records WHERE n > 0 AND year IS NOT NULL),
top AS (SELECT max(n) AS max_n FROM kept), ranges(name, y1, y2) AS (VALUES {items}), {_BINS}
SELECT {_LABEL} AS bin, name AS range, CAST(count(r.n) AS BIGINT) AS records
FROM bins CROSS JOIN top CROSS JOIN ranges
LEFT JOIN kept r ON {_INSIDE} AND r.year BETWEEN y1 AND y2 GROUP BY pos, 1, 2"""


def oracle_sql() -> dict[str, str]:
    order_range = _by_range(_ORDER_RECORDS, orders.YEAR_RANGES)
    doc_categories = ["journal", "book", "school", "webpage"]
    doc_binned = _binned(_DOC_RECORDS).replace("{t}", "records")
    doc_category = _by_category(_DOC_RECORDS, doc_categories)
    doc_range = _by_range(_DOC_RECORDS, DEFAULT_YEAR_RANGES)
    doc_scores = f"WITH {_DOC_MEMBERS} {_SCORES}"
    doc_stats = f"WITH {_DOC_MEMBERS} {_STATS_ALL}"
    doc_stats_by = f"WITH {_DOC_MEMBERS} {_STATS_BY}"
    # scores print as Spark prints doubles: 1.0, 0.5, 0.33
    suite = f"""
SELECT 'AuthorCount' AS job, concat_ws('|', bin, records) AS line FROM ({doc_binned})
UNION ALL SELECT 'PublicationVenueStratification', concat_ws('|', bin, category, records) FROM ({doc_category})
UNION ALL SELECT 'PublicationYearStratification', concat_ws('|', bin, range, records) FROM ({doc_range})
UNION ALL SELECT 'Authorship', concat_ws('|', most_collaborative, least_collaborative)
  FROM ({_RANKS.format(members=_DOC_MEMBERS).replace(f"<= {TOP}", "<= 100")})
UNION ALL SELECT 'MeanMedianStatistics', concat_ws('|', member, mean, median, min, max) FROM ({doc_stats})
UNION ALL SELECT 'MeanMedianStatisticsWithStratification',
  concat_ws('|', member, category, mean, median, min, max) FROM ({doc_stats_by})
UNION ALL SELECT 'SortedScores', concat_ws('|', member, CAST(score AS VARCHAR)) FROM ({doc_scores})"""
    return {
        "size_histogram": f"WITH {_ORDER_RECORDS} {_HISTOGRAM.format(t='sizes')}",
        "size_histogram_binned": _binned(_ORDER_RECORDS).replace("{t}", "sizes"),
        "category_lookup": """SELECT o_orderkey, o_orderpriority AS kind,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'rush' WHEN '2-HIGH' THEN 'rush'
    WHEN '3-MEDIUM' THEN 'normal' WHEN '4-NOT SPECIFIED' THEN 'unset' END AS category
FROM orders""",
        "category_table_lookup": """SELECT c_custkey, c_nationkey AS kind, r_name AS category
FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA') ON c_nationkey = n_nationkey""",
        "size_by_category": f"""WITH {_ORDER_RECORDS}
SELECT n, category, CAST(count(*) AS BIGINT) AS records FROM records
WHERE category IS NOT NULL GROUP BY n, category""",
        "size_by_category_binned": _by_category(_ORDER_RECORDS, ["rush", "normal", "unset"]),
        "size_by_year": f"""WITH {_ORDER_RECORDS}
SELECT n, year, CAST(count(*) AS BIGINT) AS records FROM records
WHERE year IS NOT NULL GROUP BY n, year""",
        "size_by_range_binned": order_range,
        "member_shares": f"""WITH {_ORDER_MEMBERS}
SELECT l_orderkey, member, CAST((200 + n) // (2 * n) AS BIGINT) AS hundredths,
  CAST(n - 1 AS BIGINT) AS fellows FROM members""",
        "contribution_score": f"WITH {_ORDER_MEMBERS} {_SCORES}",
        "sorted_scores": f"WITH {_ORDER_MEMBERS} {_SCORES} ORDER BY score, member",
        "sorted_scores_descending": f"WITH {_ORDER_MEMBERS} {_SCORES} ORDER BY score DESC, member DESC",
        "scores_with_rank": f"""WITH {_ORDER_MEMBERS}, scores AS ({_SCORES})
SELECT member, score, CAST(row_number() OVER (ORDER BY score, member) AS BIGINT) AS rank FROM scores""",
        "top_bottom_members": _RANKS.format(members=_ORDER_MEMBERS),
        "member_stats": f"WITH {_ORDER_MEMBERS} {_STATS_ALL}",
        "member_stats_by_category": f"WITH {_ORDER_MEMBERS} {_STATS_BY}",
        "repair_markup": r"""
SELECT page_id, replace(replace(regexp_replace(
    regexp_replace(replace(replace(html, chr(10), ''), '&', '&amp;'),
      '<([^<>/a-zA-Z_!?][^<>]*)>', '&lt;\1&gt;', 'g'),
    '<([/a-zA-Z_!?])', chr(1) || '\1', 'g'), '<', '&lt;'), chr(1), '<') AS repaired
FROM pages""",
        "root_element": f"WITH {_XML} SELECT doc_id, kind FROM xml",
        "extract_fields": f"""WITH {_FIELDS}
SELECT kind, year, CAST(len(members) AS BIGINT) AS n,
  coalesce(array_to_string(members, '|'), '') AS members FROM fields""",
        "bad_records": f"""WITH {_XML}
SELECT kind, {_REPAIRED} AS text FROM xml WHERE source = 'src17'""",
        "salvaged_members": f"""WITH {_ALL_FIELDS}, {_XML}
SELECT kind, year, CAST(len(members) AS BIGINT) AS n, coalesce(array_to_string(members, '|'), '') AS members,
  CASE WHEN source = 'src17' THEN 'end tag </' || kind || '> inside <title>' END AS bad_reason,
  CASE WHEN source = 'src17' THEN CAST(length({_REPAIRED}) - length(kind) - 3 AS BIGINT) END AS bad_place
FROM fields JOIN xml USING (doc_id, source, kind)""",
        "sorted_members": f"""WITH {_FIELDS}
SELECT kind, coalesce(array_to_string(list_sort(members), '|'), '') AS members FROM fields""",
        "xml_scan": f"WITH {_XML} SELECT kind, raw FROM xml WHERE source <> 'src19'",
        "xml_scan_kinds": f"""WITH {_XML}
SELECT kind, raw FROM xml WHERE source <> 'src19' AND kind IN ('article', 'www')""",
        "xml_scan_any_start": f"WITH {_XML} SELECT kind, raw FROM xml",
        "xml_size_binned": doc_binned,
        "xml_size_by_category_binned": doc_category,
        "xml_size_by_range_binned": doc_range,
        "xml_contribution_score": doc_scores,
        "xml_top_bottom": _RANKS.format(members=_DOC_MEMBERS),
        "xml_member_stats": doc_stats,
        "xml_member_stats_by_category": doc_stats_by,
        "page_articles": r"""
SELECT 'article' AS kind, unnest(regexp_extract_all(html, '(?s)<article[\s>].*?</article>')) AS raw FROM pages""",
        "page_links": r"""
SELECT 'a' AS kind, unnest(regexp_extract_all(html, '(?s)<a .*?</a>')) AS raw FROM pages""",
        "page_link_sizes": f"WITH {_LINK_LISTS} {_HISTOGRAM.format(t='records')}",
        "page_link_scores": f"WITH {_LINK_LISTS} {_SCORES}",
        "page_link_stats": f"WITH {_LINK_LISTS} {_STATS_ALL}",
        "key_value_round_trip": doc_scores,
        "table_round_trip": doc_stats,
        "report_round_trip": order_range,
        "xml_scan_offsets": f"WITH {_XML} SELECT kind, raw, CAST(-1 AS BIGINT) AS beyond FROM xml",
        "xml_scan_untidy": """
WITH named AS (SELECT doc_id, chr(39) || doc_id || chr(39) || '>' AS k, chr(39) || 'inner' || chr(39) || '>' AS i FROM documents)
SELECT unnest(CASE doc_id % 3 WHEN 0 THEN ['book', 'article'] WHEN 1 THEN ['phdthesis', 'book'] ELSE ['www'] END) AS kind,
  unnest(CASE doc_id % 3
    WHEN 0 THEN ['<book k=' || k || 'A<!-- ', '<article k=' || i || ' -->B</book>' || chr(10)]
    WHEN 1 THEN ['<phdthesis k=' || k || '<![CDATA[', '<book k=' || i || ']]></phdthesis>' || chr(10)]
    ELSE ['<www k=' || k || 'not closed' || chr(10)] END) AS raw
FROM named""",
        "xml_scan_end_tag": """
WITH named AS (
  SELECT doc_id % 3 AS shape, ' k=' || chr(39) || doc_id || chr(39) || '>' AS k, ' k=' || chr(39) || 'inner' || chr(39) || '>' AS i,
    replace(coalesce(text, ''), '<', '&lt;') AS t
  FROM documents
)
SELECT 'book' AS kind, '<book' || k || t || '<article' || i || 'B</article>C</book>' AS raw FROM named WHERE shape = 0
UNION ALL SELECT 'www', '<www' || k || '<book' || i || t || '</www>' FROM named WHERE shape = 1
UNION ALL SELECT 'phdthesis', '<phdthesis' || k || '</phdthesis>' FROM named WHERE shape = 1
UNION ALL SELECT 'article', '<article' || k || '<article' || i || '<www >' || t || '</article>' FROM named WHERE shape = 2""",
        "results_blank_lines": "SELECT o_orderkey, o_orderstatus FROM orders",
        "counts_in_order": f"""WITH {_DOC_RECORDS}, counted AS ({_HISTOGRAM.format(t='records')})
SELECT CAST(row_number() OVER (ORDER BY n) AS BIGINT) AS position, n, records FROM counted""",
        "scores_in_order": f"""WITH {_ORDER_MEMBERS}, scores AS ({_SCORES})
SELECT CAST(row_number() OVER (ORDER BY score, member) AS BIGINT) AS position, member, score FROM scores""",
        "scores_in_order_descending": f"""WITH {_ORDER_MEMBERS}, scores AS ({_SCORES})
SELECT CAST(row_number() OVER (ORDER BY score DESC, member DESC) AS BIGINT) AS position, member, score FROM scores""",
        "job_suite": suite,
        **_llm_sql(),
    }
