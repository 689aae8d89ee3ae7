"""Texts written out as files for the record scan.

Documents become XML records with their words as members.  Their markup is made
untidy on purpose, by the source of the document, so that the scan, the repair
and the parse meet every shape they have to handle.  Pages are written as they
are: their articles, links and link lists are records too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans.staging import passing_folder, table_state
from rollcall.sources.xml_records import DEFAULT_KINDS

PACKED_RECORDS = 1000
ONLY_EDITORS = "src13"
NO_ATTRIBUTES = "src19"
UNCLOSED_TITLE = "src17"
TEXT_YEAR = "src7"
NO_YEAR = "src11"
TWO_YEARS = "src3"
# how the words are listed by some sources: start of the list, between two words, end
_LISTS = (
    {
        "src2": '<author orcid="0-1">',
        "src5": "<people><author>",
        "src9": "<author><i>",
        ONLY_EDITORS: "<editor>",
    },
    {
        "src2": '</author><author orcid="0-1">',
        "src9": "</i></author><author><i>",
        ONLY_EDITORS: "</editor><editor>",
    },
    {"src5": "</author></people>", "src9": "</i></author>", ONLY_EDITORS: "</editor>"},
)


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, kind, raw)``: the XML text of every document, whole.

    The number in a source's name chooses the kind; any other source, or none, means
    the first kind.  A null text has no words, a null length no year.
    """
    documents = spark.read.parquet(f"{folder}/documents.parquet").withColumn("kind", _kind(F.col("source")))
    opened, between, closed = (
        F.coalesce(F.try_element_at(_literal_map(texts), "source"), F.lit(plain))
        for texts, plain in zip(_LISTS, ("<author>", "</author><author>", "</author>"))
    )
    words = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("<"), F.lit("&lt;")), F.lit(" "), between)
    source = F.col("source")
    raw = F.concat(
        F.lit("<"),
        F.col("kind"),
        F.when(source == NO_ATTRIBUTES, F.lit("")).otherwise(F.format_string(" key='doc/%d'", "doc_id")),
        F.lit(">\n"),
        opened,
        words,
        closed,
        F.lit("\n<title>On <i>words</i> & <1 more> or a < b"),
        F.when(source == UNCLOSED_TITLE, F.lit("")).otherwise(F.lit("</title>")),
        _years(source),
        F.lit("</"),
        F.col("kind"),
        F.lit(">"),
    )
    return documents.select("doc_id", "kind", raw.alias("raw"))


def _kind(source: Column) -> Column:
    number = F.regexp_extract(source, r"^src(\d{1,9})$", 1)
    place = F.when(number != "", number.cast("int") % len(DEFAULT_KINDS)).otherwise(0)
    return F.get(F.array(*map(F.lit, DEFAULT_KINDS)), place)


def _literal_map(texts: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in texts.items() for part in pair])


def _years(source: Column) -> Column:
    year = F.format_string("<year>%d</year>", F.expr("1890 + n_chars div 50"))
    year = F.when(F.col("n_chars").isNotNull(), year).otherwise(F.lit(""))
    return (
        F.when(source == TEXT_YEAR, F.lit("<year>n.d.</year>"))
        .when(source == NO_YEAR, F.lit(""))
        .when(source == TWO_YEARS, F.concat(F.lit("<year>1800</year>"), year))
        .otherwise(year)
    )


_written: dict[tuple, str] = {}


def written_documents(spark: SparkSession, folder: str, *, packed: bool = True) -> str:
    """Folder of XML files with every document, written once per application.

    Tags are most of the text, so the files are packed; a scan reads each of these by one
    task, and they hold few records each.  Plain files can be cut into ranges.
    """
    return _written_once(spark, folder, "documents", document_records, "packed" if packed else "text")


def written_pages(spark: SparkSession, folder: str) -> str:
    """Folder of files with every page, written once per application."""
    return _written_once(spark, folder, "pages", page_texts)


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet").select(F.col("html").alias("raw"))


def written_untidy(spark: SparkSession, folder: str) -> str:
    """Folder of files with record starts in comments, in CDATA and behind unclosed records."""
    return _written_once(spark, folder, "documents", untidy_records, "untidy")


def untidy_records(spark: SparkSession, folder: str) -> DataFrame:
    shapes = (
        "<book k='%1$d'>A<!-- <article k='inner'> -->B</book>",
        "<phdthesis k='%1$d'><![CDATA[<book k='inner'>]]></phdthesis>",
        "<www k='%1$d'>not closed",
    )
    shape = F.get(F.array(*[F.format_string(text, "doc_id") for text in shapes]), F.pmod("doc_id", F.lit(3)).cast("int"))
    return spark.read.parquet(f"{folder}/documents.parquet").select(shape.alias("raw"))


def written_nested(spark: SparkSession, folder: str) -> str:
    """Folder of files whose records hold starts and ends of others."""
    return _written_once(spark, folder, "documents", nested_records, "nested")


def nested_records(spark: SparkSession, folder: str) -> DataFrame:
    """Each row's records are closed in it, so the order of rows does not matter."""
    shapes = (
        "<book k='%1$d'>%2$s<article k='inner'>B</article>C</book>",
        "<www k='%1$d'><book k='inner'>%2$s</www></book><phdthesis k='%1$d'></phdthesis>",
        "</www><article k='%1$d'><article k='inner'><www >%2$s</article></article>",
    )
    words = F.replace(F.coalesce("text", F.lit("")), F.lit("<"), F.lit("&lt;"))
    shape = F.get(F.array(*[F.format_string(text, "doc_id", words) for text in shapes]), F.pmod("doc_id", F.lit(3)).cast("int"))
    return spark.read.parquet(f"{folder}/documents.parquet").select(shape.alias("raw"))


def _written_once(
    spark: SparkSession, folder: str, name: str, texts: Callable[[SparkSession, str], DataFrame], form: str = "text"
) -> str:
    key = (spark.sparkContext.applicationId, name, form, folder, table_state(spark, f"{folder}/{name}.parquet"))
    if key not in _written:
        target = passing_folder(spark, name)
        writer = texts(spark, folder).select("raw").write.mode("append")
        if form == "packed":  # tags repeat: little is gained by looking longer
            writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", PACKED_RECORDS)
        writer.text(target)
        _written[key] = target
    return _written[key]
