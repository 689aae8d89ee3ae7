"""The six reports over a folder of XML records, run by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from rollcall.functions.markup import extract_groups, observe_bad, split_bad
from rollcall.functions.specs import parse_bins, parse_categories, parse_ranges
from rollcall.operators.histograms import bin_by_category, bin_by_range, bin_sizes, histogram_by, size_histograms
from rollcall.operators.members import explode_members, membership_counts
from rollcall.operators.scores import contribution_scores, sort_scores, top_bottom
from rollcall.operators.stats import member_stats
from rollcall.plans.staging import staging_folder
from rollcall.sinks.csv import write_key_values, write_report, write_table
from rollcall.sources.xml_records import DEFAULT_KINDS, read_xml_records

# Default settings, job names, output folder names and headers.
DEFAULT_CATEGORIES = (
    "article:journal;inproceedings:book;proceedings:book;book:book;"
    "incollection:book;phdthesis:school;mastersthesis:school;www:webpage"
)
DEFAULT_BINS = "1,2,3,4-6,7-10,11-end"
DEFAULT_YEAR_RANGES = "1901-1950,1951-1980,1981-2000,2001-2020"
DEFAULT_TOP = 100

FOLDERS = {
    "AuthorCount": "MapReduceJob1",
    "PublicationVenueStratification": "MapReduceJob2",
    "PublicationYearStratification": "MapReduceJob3",
    "Authorship": "MapReduceJob4",
    "MeanMedianStatistics": "MapReduceJob5",
    "MeanMedianStatisticsWithStratification": "MapReduceJob6",
}
JOB_NAMES = tuple(FOLDERS)
SORTED = "SortedMapReduceJob4"
QUARANTINE = "Quarantine"

HEADERS = {
    "AuthorCount": ["Co-Author Bin", "Number Of Co-Authors"],
    "PublicationVenueStratification": [
        "Co-Author Bin",
        "Publication Venue",
        "Number Of Co-Authors",
    ],
    "PublicationYearStratification": [
        "Co-Author Bin",
        "Publication Year Range",
        "Number Of Co-Authors",
    ],
    "Authorship": [
        "Top 100 Authors who publish with most Co-authors",
        "Top 100 Authors who publish with least Co-authors",
    ],
    "MeanMedianStatistics": ["Author", "Mean", "Median", "Minimum", "Maximum"],
    "MeanMedianStatisticsWithStratification": [
        "Author",
        "Venue",
        "Mean",
        "Median",
        "Minimum",
        "Maximum",
    ],
}

# jobs that need sizes only, and by what; then those that look at single members
_SIZE_JOBS = {"AuthorCount": "", "PublicationVenueStratification": "category", "PublicationYearStratification": "year"}
_MEMBER_JOBS = {"Authorship", "MeanMedianStatistics", "MeanMedianStatisticsWithStratification"}


@dataclass(frozen=True)
class Settings:
    """What the jobs can be told; the defaults suit a bibliography."""

    categories: str = DEFAULT_CATEGORIES
    bins: str = DEFAULT_BINS
    year_ranges: str = DEFAULT_YEAR_RANGES
    top: int = DEFAULT_TOP
    kinds: tuple[str, ...] = DEFAULT_KINDS
    member: str = "author"
    year: str = "year"
    on_bad: str = "quarantine"
    scan: dict = field(default_factory=dict)  # further options of the record scan


def scan_groups(spark: SparkSession, path: str, settings: Settings = Settings()) -> DataFrame:
    """Scan, repair and parse: one row per record, bad ones as ``on_bad`` says."""
    records = read_xml_records(spark, path, kinds=settings.kinds, **settings.scan)
    return extract_groups(
        records,
        member=settings.member,
        year=settings.year,
        categories=parse_categories(settings.categories),
        on_bad=settings.on_bad,
    )


def run_jobs(
    spark: SparkSession,
    source: str,
    output: str,
    names: str | Iterable[str] = JOB_NAMES,
    settings: Settings = Settings(),
    *,
    mode: str = "error",
    observation: Observation | None = None,
) -> dict[str, str]:
    """Run the named jobs and give the report folder of each.

    ``names`` may be a comma separated text.  ``(jobName)`` in ``output`` is
    replaced by each job's folder name, or appended when it is not there.  The
    scan and parse happen once: the extracted groups are written to the shared
    staging folder, so a lost executor costs no second scan, and each job reads
    only the columns it needs.  Records that did not parse go to ``Quarantine``, with the
    reason; ``observation`` counts them on the way (:func:`observe_bad`).  The jobs about sizes share
    one pass over the groups, those about members one shuffle of the memberships.
    """
    wanted = _checked(names)
    jobs = _jobs(settings)
    if "(jobName)" not in output:
        output = f"{output.rstrip('/')}/(jobName)"
    with staging_folder(spark) as folder:
        scanned = scan_groups(spark, source, settings)
        quarantines = settings.on_bad in ("quarantine", "salvage")
        if observation is not None and quarantines:
            scanned = observe_bad(scanned, observation)
        if not _MEMBER_JOBS.intersection(wanted):
            scanned = scanned.drop("members")
        scanned.write.parquet(f"{folder}/groups")
        groups = spark.read.parquet(f"{folder}/groups")
        if quarantines:
            groups, bad = split_bad(groups)
            bad.write.mode(mode).parquet(output.replace("(jobName)", QUARANTINE))
        sizes = members = None
        keys = [_SIZE_JOBS[name] for name in wanted if _SIZE_JOBS.get(name)]
        if _SIZE_JOBS.keys() & set(wanted):
            size_histograms(groups, keys).write.parquet(f"{folder}/sizes")
            sizes = spark.read.parquet(f"{folder}/sizes")
        if _MEMBER_JOBS.intersection(wanted):
            counted = membership_counts(explode_members(groups, ["category"]), ["category"])
            counted.write.parquet(f"{folder}/members")
            members = spark.read.parquet(f"{folder}/members")

        def place(job_folder: str) -> str:
            return output.replace("(jobName)", job_folder)

        def run(name: str) -> str:
            job = FOLDERS[name]
            report = f"{place(job)}/{job}.csv"
            table = members if name in _MEMBER_JOBS else sizes
            jobs[name](table, place, report, f"{folder}/{job}", mode)
            return report

        # jobs overlap, so one job's last tasks leave no cores idle
        with ThreadPoolExecutor(len(wanted)) as pool:
            return dict(zip(wanted, pool.map(inheritable_thread_target(spark)(run), wanted)))


def _checked(names: str | Iterable[str]) -> list[str]:
    items = names.split(",") if isinstance(names, str) else names
    wanted = list(dict.fromkeys(name.strip() for name in items))
    unknown = [name for name in wanted if name not in FOLDERS]
    if unknown or not wanted:
        raise ValueError(f"unknown jobs {unknown}; choose from {', '.join(JOB_NAMES)}")
    return wanted


def _jobs(settings: Settings) -> dict[str, Callable]:
    """Each job takes its table, a function from folder name to path, its report
    folder, a staging folder of its own and the write mode.  The table holds the size
    histograms, or for jobs about members how often each has a record of each size and category."""
    bins = parse_bins(settings.bins)
    ranges = parse_ranges(settings.year_ranges)
    categories = list(parse_categories(settings.categories).values())

    def histogram(job, binned):
        def run(sizes, place, report, folder, mode):
            table = histogram_by(sizes, _SIZE_JOBS[job])
            write_key_values(table.orderBy(*table.columns[:-1]), f"{place(FOLDERS[job])}/counts", mode=mode)
            write_report(binned(table), report, HEADERS[job], mode=mode)

        return run

    by_size = histogram("AuthorCount", lambda table: bin_sizes(table, bins))
    by_category = histogram("PublicationVenueStratification", lambda table: bin_by_category(table, bins, categories))
    by_year = histogram("PublicationYearStratification", lambda table: bin_by_range(table, bins, ranges))

    def by_score(members, place, report, folder, mode):
        contribution_scores(members, times="times").write.parquet(folder)
        scores = members.sparkSession.read.parquet(folder)
        write_key_values(scores, f"{place(FOLDERS['Authorship'])}/scores", mode=mode)
        write_key_values(sort_scores(scores), place(SORTED), mode=mode)
        table = top_bottom(scores, settings.top).drop("rank")
        write_report(table, report, HEADERS["Authorship"], mode=mode)

    def by_member(members, place, report, folder, mode):
        table = member_stats(members, times="times")
        write_table(table, report, HEADERS["MeanMedianStatistics"], mode=mode)

    def by_member_and_category(members, place, report, folder, mode):
        table = member_stats(members, ["category"], times="times")
        write_table(table, report, HEADERS["MeanMedianStatisticsWithStratification"], mode=mode)

    jobs = (by_size, by_category, by_year, by_score, by_member, by_member_and_category)
    return dict(zip(JOB_NAMES, jobs))
