"""Repair raw record text, parse it, and pull out members and year."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.functions.specs import category_of

CORRUPT = "_corrupt_record"
#: Why a record did not parse, and after how many characters of its repaired text.
REASON, PLACE = "bad_reason", "bad_place"
_ON_BAD = ("quarantine", "salvage", "drop", "fail")

# '<' before something no tag can start with; and the same closed by '>'
_LONE_BRACKET = r"<(?![/a-zA-Z_!?])"
_STRAY_TAG = _LONE_BRACKET + r"([^<>]+)>"
_CHARACTER_DATA = r"(<!\[CDATA\[.*?\]\]>)"
_COMMENT = r"<!--.*?-->"
_ATTRIBUTES = r"""(?:[^<>"']++|"[^<"]*+"|'[^<']*+')*+"""
# all of a text in pieces: what is skipped as a whole, elements in a row that hold only
# text, a tag, plain text, a bracket that opens nothing
_PIECE = (
    rf"(?s){_COMMENT}|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
    rf"|(?:<([a-zA-Z_][^\s/<>]*+)(?:\s{_ATTRIBUTES})?(?<!/)>[^<]*+</\1\s*>)++"
    rf"|</?[a-zA-Z_]{_ATTRIBUTES}>|[^<]++|<"
)

# a name, an attribute and a text that every parser takes as they stand, lone brackets being text;
# characters are named, not excluded, since most are found in the first range then
_SOUND = r"=-\ufffd -;\t\x{10000}-\x{10ffff}"
_PLAIN_NAME = r"[a-zA-Z][a-zA-Z0-9_.-]{0,99}+"
_PLAIN_VALUE = rf"""(?:"(?:(?!")[{_SOUND}])*+"|'(?:(?!')[{_SOUND}])*+')"""
_PLAIN_ATTRIBUTE = rf"(?!(?i:xml|corrupt_record)){_PLAIN_NAME}[ \t]*+=[ \t]*+{_PLAIN_VALUE}"
_LONE_IN_TEXT = rf"{_LONE_BRACKET}[{_SOUND}]*+"


def repair(raw: Column | str) -> Column:
    """Make record text parseable.

    Newlines are removed, every ampersand is escaped (so undeclared entities
    survive as literal text), and angle brackets that are not markup are escaped.
    """
    return _escape_brackets(_escape_plain(F.col(raw) if isinstance(raw, str) else raw))


def _joined(raw: Column) -> Column:
    return F.replace(raw, F.lit("\n"), F.lit(""))


def _escape_plain(raw: Column) -> Column:
    return F.replace(_joined(raw), F.lit("&"), F.lit("&amp;"))


def _escape_brackets(text: Column) -> Column:
    escaped = F.regexp_replace(text, _STRAY_TAG, "&lt;$1&gt;")
    escaped = F.regexp_replace(escaped, _LONE_BRACKET, "&lt;")
    # most text has nothing to escape, and looking is cheaper than replacing
    return F.when(F.rlike(text, F.lit(_LONE_BRACKET)), escaped).otherwise(text)


def root_kind(raw: Column | str) -> Column:
    """Name of the root element, for text that did not come from the record scan."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.regexp_extract(raw, r"^\s*<([A-Za-z_][A-Za-z0-9_.-]*)", 1)


def extract_groups(
    records: DataFrame,
    *,
    text: str = "raw",
    member: str = "author",
    year: str = "year",
    categories: Mapping[str, str] | None = None,
    on_bad: str = "quarantine",
) -> DataFrame:
    """Parse ``text`` and replace it by ``members``, ``n``, ``year`` (and ``category``).

    ``members`` holds the text of every non-empty ``member`` element at any
    depth, in document order, repeats kept.  ``year`` is the last ``year``
    element as an int, null when absent or not a number.  Other columns pass
    through; ``category`` needs a ``kind`` column.

    ``on_bad`` says what happens to text that does not parse: ``quarantine``
    keeps the row with its repaired text in ``_corrupt_record``, ``drop``
    removes it, ``fail`` stops the query.  ``salvage`` keeps what stands before the
    first tag that does not fit: the text is cut there, what is open is closed, and
    the row is a group like others; text that this does not mend stays in
    ``_corrupt_record``.  ``quarantine`` and ``salvage`` also say what is wrong:
    ``bad_reason``, and ``bad_place``, the characters of repaired text before that
    (null where all tags fit).  Only bad records cost anything for it.
    """
    if on_bad not in _ON_BAD:
        raise ValueError(f"on_bad must be one of {', '.join(_ON_BAD)}, not {on_bad!r}")
    passed = [name for name in records.columns if name != text]
    # each step on its own, so that none is computed for each use of it
    joined = records.select(*passed, _joined(F.col(text)).alias("_joined"))
    looked = joined.select(*passed, "_joined", _is_plain(F.col("_joined"), member, year).alias("_simple"))
    others = F.when(~F.col("_simple"), F.col("_joined"))
    plain = looked.select(*passed, "_joined", "_simple", _escape_plain(others).alias("_plain"))
    fixed = plain.select(*passed, "_joined", "_simple", _escape_brackets(F.col("_plain")).alias("_fixed"))
    direct = fixed.select(
        *passed, "_joined", "_simple", "_fixed", _parse(F.col("_fixed"), member, year, on_bad).alias("_direct")
    )
    flat = _parse(_flatten(F.col("_fixed"), member, year), member, year, on_bad)
    salvages, told = on_bad == "salvage", on_bad in ("quarantine", "salvage")
    found = F.coalesce(F.when(_needs_flattening(member, year, on_bad), flat), F.col("_direct"))
    found = F.when(F.col("_simple"), _plain_fields(F.col("_joined"), member, year, on_bad)).otherwise(found)
    parsed = direct.select(*passed, *["_fixed"] * salvages, found.alias("_found"))
    found = F.col("_found")
    if salvages:
        broken = F.when(found[CORRUPT].isNotNull(), _unbalanced(F.col("_fixed")))
        parsed = parsed.select(*passed, "_fixed", "_found", broken.alias("_broken"))
        broken = F.col("_broken")
        mended = _parse(_flatten(_closed(F.col("_fixed"), broken), member, year), member, year, on_bad)
        parsed = parsed.select(*passed, "_found", "_broken", F.when(broken[PLACE].isNotNull(), mended).alias("_mended"))
        sound = F.col("_mended").isNotNull() & F.col("_mended")[CORRUPT].isNull()
        parsed = parsed.select(*passed, F.when(sound, F.col("_mended")).otherwise(found).alias("_found"), "_broken")
    corrupt = F.lit(None).cast("string") if on_bad == "fail" else found[CORRUPT]
    fields = F.struct(
        _texts(found[member]).alias("members"),
        _texts(found[year]).alias("_years"),
        corrupt.alias(CORRUPT),
        *([F.col("_broken")] if salvages else []),
    )
    # Generated columns, not projected ones: a filter on them stays above this
    # step, where a projection would let it through and have the text parsed twice.
    groups = parsed.select(*passed, F.inline(F.array(fields)))
    if told and not salvages:
        # looked for where somebody reads it only
        groups = groups.withColumn("_broken", F.when(F.col(CORRUPT).isNotNull(), _unbalanced(F.col(CORRUPT))))
    groups = groups.select(
        *passed,
        "members",
        F.size("members").alias("n"),
        F.try_element_at("_years", F.lit(-1)).try_cast("int").alias("year"),
        CORRUPT,
        *([F.col("_broken")[name].alias(name) for name in (REASON, PLACE)] if told else []),
    )
    if categories is not None:
        groups = groups.withColumn("category", category_of("kind", categories))
    if told:
        return groups
    return groups.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def split_bad(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Separate parsed groups, salvaged ones included, from quarantined ones, which say why."""
    good = groups.where(F.col(CORRUPT).isNull()).drop(CORRUPT, REASON, PLACE)
    bad = groups.where(F.col(CORRUPT).isNotNull()).drop("members", "n", "year", "category")
    return good, bad


def observe_bad(groups: DataFrame, observation: Observation) -> DataFrame:
    """The groups as they are; what reads them all counts ``records``, ``salvaged`` and ``quarantined``."""
    corrupt = F.col(CORRUPT).isNotNull()
    return groups.observe(
        observation,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(REASON).isNotNull() & ~corrupt).alias("salvaged"),
        F.count_if(corrupt).alias("quarantined"),
    )


def _parse(fixed: Column, member: str, year: str, on_bad: str) -> Column:
    corrupt = "" if on_bad == "fail" else f", {CORRUPT} string"
    return F.from_xml(
        fixed,
        f"`{member}` array<string>, `{year}` array<string>{corrupt}",
        {
            "mode": "FAILFAST" if on_bad == "fail" else "PERMISSIVE",
            "ignoreSurroundingSpaces": "false",
        },
    )


def _is_plain(joined: Column, member: str, year: str) -> Column:
    """Whether the record is so plain that its fields can be cut out of the text.

    All tags fit, members and years hold text alone, other elements nest no deeper than
    two below the outermost, and nothing is in it that a parser changes, refuses or skips.  Names,
    attributes and characters are those that are sound beyond doubt; any other record is parsed.
    """
    if not all(re.fullmatch(r"[a-zA-Z][a-zA-Z0-9_.-]{0,99}", name) for name in (member, year)) or member.lower() == year.lower():
        return F.lit(False)
    wanted = f"{re.escape(member)}|{re.escape(year)}"
    numbers = iter(range(100))

    def element(name: str, inside: str) -> str:
        k = next(numbers)
        attributes = rf"(?:[ \t]++(?=(?<a{k}>{_PLAIN_NAME})){_PLAIN_ATTRIBUTE}(?:[ \t]++(?!\k<a{k}>[ \t=]){_PLAIN_ATTRIBUTE})?+)?+[ \t]*+"
        return rf"<(?<n{k}>{name}){attributes}>{inside}</\k<n{k}>[ \t]*+>"

    # members in a row as they mostly are; blanks alone count as no text to some parsers
    usual = rf"(?:<{re.escape(member)}>(?![ \t])[{_SOUND}]++</{re.escape(member)}>)++"
    other = rf"(?!(?i:{wanted})[ \t>]){_PLAIN_NAME}"
    inner = ""
    for _ in range(3):
        field = element(rf"(?:{wanted})(?=[ \t>])", rf"(?:(?=</)|(?![ \t]*+<)[{_SOUND}]*+(?:{_LONE_IN_TEXT})*+)")
        inner = element(other, rf"(?:[{_SOUND}]++|{usual}|{field}|{inner}{_LONE_BRACKET})*+") + "|"
    return F.coalesce(F.rlike(joined, F.lit(rf"\A{inner[:-1]}\z")) & ~F.contains(joined, F.lit("]]>")), F.lit(False))


def _plain_fields(joined: Column, member: str, year: str, on_bad: str) -> Column:
    """What :func:`_parse` and flattening find in a plain record."""

    # pieces from one start tag to the next; the first begins before any, and gives an empty text
    text = rf"^(?:[ \t]{_ATTRIBUTES})?+>([^<]*+(?:{_LONE_BRACKET}[^<]*+)*+)"

    def texts(name: str) -> Column:
        pieces = F.split(joined, rf"<{re.escape(name)}(?=[ \t>])")
        return F.transform(pieces, lambda piece: F.regexp_extract(piece, text, 1)).alias(name)

    corrupt = [] if on_bad == "fail" else [F.lit(None).cast("string").alias(CORRUPT)]
    return F.struct(texts(member), texts(year), *corrupt)


def _texts(elements: Column) -> Column:
    """Element texts without the empty ones; an empty array when there are none."""
    kept = F.filter(elements, lambda text: text != F.lit(""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def _needs_flattening(member: str, year: str, on_bad: str) -> Column:
    """Whether the direct parse of a sound record may have missed something.

    ``from_xml`` sees direct children only, takes names in any case unless
    ``spark.sql.caseSensitive`` is on, and leaves inline tags in texts.  So the
    record needs another look when it closes other numbers of member or year
    elements than were found with text, closes some in another case, or when a
    text holds a bracket.
    """
    fixed, direct = F.col("_fixed"), F.col("_direct")
    texts = F.coalesce(F.array_join(direct[member], ""), F.lit(""))
    missed = F.contains(texts, F.lit("<"))
    for name in (member, year):
        found = F.size(F.array_remove(direct[name], ""))
        missed = missed | (_occurrences(fixed, f"</{name}") != F.coalesce(found, F.lit(0)))
    names = f"{re.escape(member)}|{re.escape(year)}"
    missed = missed | F.rlike(fixed, F.lit(f"</(?!{names})(?iu:{names})"))
    return missed if on_bad == "fail" else direct[CORRUPT].isNull() & missed


def _occurrences(text: Column, part: str) -> Column:
    without = F.octet_length(F.replace(text, F.lit(part), F.lit("")))
    return F.call_function("div", F.octet_length(text) - without, F.lit(len(part.encode())))


def _flatten(fixed: Column, member: str, year: str) -> Column:
    """Take out comments and all tags but the wanted ones, whose depth then is one.

    Character data sections stay, so that tags quoted in them stay text.
    """
    wanted = f"{re.escape(member)}|{re.escape(year)}"
    other_tag = rf"</?(?!(?:{wanted})[\s/>])[a-zA-Z_!?][^<>]*>"
    bare = F.regexp_replace(fixed, f"{_CHARACTER_DATA}|{_COMMENT}|{other_tag}", "$1")
    return F.concat(F.lit("<r>"), bare, F.lit("</r>"))


def _unbalanced(fixed: Column) -> Column:
    """``(open, bad_reason, bad_place)``: the first tag that does not fit, and the elements open there.

    A fold over the pieces of the text keeps the names of the open elements, the
    characters so far and how many elements stood outermost.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("open"),
        F.lit(0).alias("at"),
        F.lit(0).alias("roots"),
        F.lit(None).cast("string").alias(REASON),
        F.lit(None).cast("int").alias(PLACE),
    )

    def step(state, piece):
        opened, root = state["open"], state["roots"]
        top = F.try_element_at(opened, F.lit(-1))
        name = F.regexp_extract(piece, r"^</?([^\s/>]+)", 1)
        ends, bracket, outside = F.startswith(piece, F.lit("</")), F.startswith(piece, F.lit("<")), F.size(opened) == 0
        whole = F.rlike(piece, F.lit(r"^<(?:!--|!\[CDATA\[|\?)"))
        starts = bracket & ~ends & ~whole & (F.length(piece) > 1)
        stays = starts & ~F.endswith(piece, F.lit("/>")) & ~F.contains(piece, F.lit("</"))
        reason = (
            F.when(piece == "<", F.lit("a bracket that opens no tag"))
            .when(ends & outside, F.concat(F.lit("end tag </"), name, F.lit("> without a start")))
            .when(ends & (name != top), F.concat(F.lit("end tag </"), name, F.lit("> inside <"), top, F.lit(">")))
            .when(starts & outside & (root > 0), F.lit("a second outermost element"))
            .when(~bracket & outside & (F.trim(piece) != ""), F.lit("text outside the outermost element"))
        )
        after = (
            F.when(ends, F.slice(opened, 1, F.greatest(F.size(opened) - 1, F.lit(0))))
            .when(stays, F.concat(opened, F.array(name)))
            .otherwise(opened)
        )
        found = state[REASON].isNotNull() | reason.isNotNull()
        return F.struct(
            F.when(found, opened).otherwise(after).alias("open"),
            (state["at"] + F.length(piece)).alias("at"),
            F.when(starts & outside, root + 1).otherwise(root).alias("roots"),
            F.coalesce(state[REASON], reason).alias(REASON),
            F.coalesce(state[PLACE], F.when(reason.isNotNull(), state["at"])).alias(PLACE),
        )

    def finish(state):
        top = F.try_element_at(state["open"], F.lit(-1))
        ends = F.concat(F.lit("end of the record inside <"), top, F.lit(">"))
        unclosed = state[REASON].isNull() & (F.size(state["open"]) > 0)
        reason = F.coalesce(state[REASON], F.when(unclosed, ends), F.lit("markup that does not parse, though all tags fit"))
        return F.struct(
            state["open"].alias("open"),
            reason.alias(REASON),
            F.coalesce(state[PLACE], F.when(unclosed, state["at"])).alias(PLACE),
        )

    return F.aggregate(F.regexp_extract_all(fixed, F.lit(_PIECE), F.lit(0)), start, step, finish)


def _closed(fixed: Column, broken: Column) -> Column:
    """The text before the tag that does not fit, with end tags for what is open there."""
    ends = F.transform(F.reverse(broken["open"]), lambda name: F.concat(F.lit("</"), name, F.lit(">")))
    return F.concat(F.substring(fixed, F.lit(1), broken[PLACE]), F.array_join(ends, ""))
