"""Repair and extraction, one untidy shape at a time."""

import random
import re
from xml.etree import ElementTree

from xml.parsers import expat

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rollcall.functions import markup
from rollcall.functions.markup import extract_groups, observe_bad, repair, root_kind, split_bad


def extracted(spark, *texts, **options):
    frame = spark.createDataFrame([(i, "article", t) for i, t in enumerate(texts)], "id int, kind string, raw string")
    return extract_groups(frame, **options).orderBy("id")


def test_repair(spark):
    raw = (
        '<book key="b/1">\n<editor>A & B</editor>\n<editor>J K&ouml;hn</editor>\n'
        "<isbn>11-<42-1>x</isbn><note>it's < 3 <!-- c --> <i>y</i> <7> <</note></book>"
    )
    fixed = spark.createDataFrame([(raw,)], "raw string").select(repair("raw")).collect()[0][0]
    assert fixed == (
        '<book key="b/1"><editor>A &amp; B</editor><editor>J K&amp;ouml;hn</editor>'
        "<isbn>11-&lt;42-1&gt;x</isbn><note>it's &lt; 3 <!-- c --> <i>y</i> &lt;7&gt; &lt;</note></book>"
    )


MEMBERS = {
    "plain": ('<article key="a/1"><author>Ann</author><author>Bo</author></article>', ["Ann", "Bo"]),
    "entity": ("<article k='1'><author>K&uuml;ng &amp; X</author></article>", ["K&uuml;ng &amp; X"]),
    "stray": ("<article k='1'><author>A</author><isbn>978-<642-4></isbn><note><1 b></note></article>", ["A"]),
    "lone": ("<article k='1'><author>A</author><title>a < b <i>c</i></title></article>", ["A"]),
    "stray in name": ("<article k='1'><author>A <1 b> c</author></article>", ["A <1 b> c"]),
    "attribute": ('<article k="1"><author orcid="0">Ann</author></article>', ["Ann"]),
    "empty": ("<article k='1'><author></author><author/><title>T</title></article>", []),
    "inline": ("<article k='1'><author>M <sub>n</sub> o</author></article>", ["M n o"]),
    "newline": ("<article k='1'><author>Zed\nB</author></article>", ["ZedB"]),
    "blanks": ("<article k='1'><author> Ann  B </author></article>", [" Ann  B "]),
    "editors": ('<article key="p"><editor>E</editor></article>', []),
    "hyphen, comma": ("<article k='1'><author>Jean-Pierre D</author><author>Roe, Jr.</author></article>", ["Jean-Pierre D", "Roe, Jr."]),
    "repeated": ("<article k='1'><author>Ann</author><author>Ann</author></article>", ["Ann", "Ann"]),
    "nested": ("<article k='1'><p><author>B</author></p><author>A</author><q><r><author>C</author></r></q></article>", ["B", "A", "C"]),
    "nested behind an empty one": ("<article k='1'><author/><p><author>B</author></p></article>", ["B"]),
    "comment": ("<article k='1'><!-- <author>no</author> --><author>A</author></article>", ["A"]),
    "character data": (
        "<article k='1'><t><![CDATA[a > <author>no</author> <b>]]></t><p><author><![CDATA[x<y> z]]></author></p></article>",
        ["x<y> z"],
    ),
    "other case": ("<article k='1'><Author>no</Author><author>A</author></article>", ["A"]),
    "other case and nested": (
        "<article k='1'><aUTHOR>no</aUTHOR><p><author>A</author></p></article>",
        ["A"],
    ),
    "only other case": ("<article k='1'><AUTHOR>no</AUTHOR></article>", []),
    "bracket in an attribute": ("<article k='1'><p t='a>b'><author>A</author></p></article>", ["A"]),
    "longer name": ("<article k='1'><authors>x</authors><author>A</author></article>", ["A"]),
}


@pytest.mark.parametrize("shape", MEMBERS)
def test_members(spark, shape):
    text, expected = MEMBERS[shape]
    row = extracted(spark, text).collect()[0]
    assert row["_corrupt_record"] is None
    assert row["members"] == expected
    assert row["n"] == len(expected)


@pytest.mark.parametrize(
    "inner, year",
    [
        ("<year>1999</year>", 1999),
        ("<year>1998</year><year>1999</year>", 1999),
        ("<p><year>1998</year></p>", 1998),
        ("<year>20x1</year>", None),
        ("<year></year>", None),
        ("", None),
    ],
)
def test_year(spark, inner, year):
    row = extracted(spark, f"<article k='1'><author>A</author>{inner}</article>").collect()[0]
    assert (row["members"], row["year"]) == (["A"], year)


BAD = '<book key="b"><author>Q<title>bad</book>'
TAIL = '<book key="b"><author>Q</author>'
GOOD = "<book k='1'><author>A</author></book>"


def test_bad_records(spark):
    groups = extracted(spark, BAD, GOOD, TAIL, categories={"article": "journal"})
    good, bad = split_bad(groups)
    assert [(r["id"], r["members"], r["category"]) for r in good.collect()] == [(1, ["A"], "journal")]
    assert [(r["id"], r["_corrupt_record"]) for r in bad.collect()] == [(0, BAD), (2, TAIL)]
    dropped = extracted(spark, BAD, GOOD, TAIL, on_bad="drop")
    assert [r["id"] for r in dropped.collect()] == [1]
    assert extracted(spark, GOOD, on_bad="fail").count() == 1
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        extracted(spark, GOOD, BAD, on_bad="fail").collect()
    with pytest.raises(ValueError):
        extracted(spark, GOOD, on_bad="ignore")


# text, members kept, what is wrong, and the part of the repaired text before that
BROKEN = {
    "unclosed inside": (BAD, ["Qbad"], "end tag </book> inside <title>", '<book key="b"><author>Q<title>bad'),
    "unclosed record": (TAIL, ["Q"], "end of the record inside <book>", TAIL),
    "later members": ("<a><author>A</author><t>x</a><author>B</author>", ["A"], "end tag </a> inside <t>", "<a><author>A</author><t>x"),
    "crossed": ("<a><author>A<i>b</author></i></a>", ["Ab"], "end tag </author> inside <i>", "<a><author>A<i>b"),
    "cut tag": ("<a><author>A</author><author x='1", ["A"], "a bracket that opens no tag", "<a><author>A</author>"),
    "cut comment": ("<a><author>A</author><!-- <author>", ["A"], "a bracket that opens no tag", "<a><author>A</author>"),
    "quoted bracket": ("<a><author>A</author><p t='a>b'></a>", ["A"], "end tag </a> inside <p>", "<a><author>A</author><p t='a>b'>"),
    "quoted tags": ("<a><![CDATA[</x>]]><author>A</author><!-- </y> --></q>", ["A"], "end tag </q> inside <a>", "<a><![CDATA[</x>]]><author>A</author><!-- </y> -->"),
    "no start": ("</a>", [], "end tag </a> without a start", ""),
    "text before": ("x<a/>", [], "text outside the outermost element", ""),
    "escaped before": ("<a>R & D <author>A</author></b>", ["A"], "end tag </b> inside <a>", "<a>R &amp; D <author>A</author>"),
    "year": ("<a><year>1999</year><author>A</author><t></a>", ["A"], "end tag </a> inside <t>", "<a><year>1999</year><author>A</author><t>"),
}


def test_salvage(spark):
    texts = [text for text, *_ in BROKEN.values()]
    for row, (_, members, reason, before) in zip(extracted(spark, *texts, on_bad="salvage").collect(), BROKEN.values()):
        assert (row["members"], row["bad_reason"], row["bad_place"], row["_corrupt_record"]) == (members, reason, len(before), None)
    for row, (_, _, reason, before) in zip(extracted(spark, *texts).collect(), BROKEN.values()):
        assert (row["members"], row["bad_reason"], row["bad_place"]) == ([], reason, len(before))
        assert row["_corrupt_record"].startswith(before)
    years = [row["year"] for row in extracted(spark, *texts, on_bad="salvage").collect()]
    assert years == [None] * (len(texts) - 1) + [1999]


def test_what_salvage_leaves(spark):
    """Sound records and null text have no reason; what no tag explains stays in quarantine, with one."""
    twice = "<a><author x='1' x='2'>A</author></a>"
    found = extracted(spark, GOOD, None, twice, BAD, on_bad="salvage")
    rows = [(r["members"], r["bad_reason"], r["bad_place"], r["_corrupt_record"]) for r in found.collect()]
    assert rows[:2] == [(["A"], None, None, None), ([], None, None, None)]
    assert rows[2] == ([], "markup that does not parse, though all tags fit", None, twice)
    good, bad = split_bad(found)
    assert [r["id"] for r in good.collect()] == [0, 1, 3] and not {"bad_reason", "bad_place"} & set(good.columns)
    assert [(r["id"], r["bad_reason"]) for r in bad.collect()] == [(2, rows[2][1])]


def test_bad_records_are_counted_on_the_way(spark):
    for on_bad, salvaged in (("salvage", 2), ("quarantine", 0)):
        seen = Observation()
        assert observe_bad(extracted(spark, GOOD, BAD, TAIL, on_bad=on_bad), seen).count() == 3
        assert seen.get == {"records": 3, "salvaged": salvaged, "quarantined": 2 - salvaged}


def read_until_broken(text):
    """Members and years as another parser reports them until it meets something that does not fit; and where."""
    parser, members, years, open_ = expat.ParserCreate("utf-8"), [], [], []

    def start(name, _):
        if name in ("author", "year"):
            (members if name == "author" else years).append("")
        open_.append((name, len(members) - 1, len(years) - 1))

    def data(some):
        for name, m, y in open_:
            if name == "author":
                members[m] += some
            elif name == "year":
                years[y] += some

    parser.StartElementHandler, parser.CharacterDataHandler = start, data
    parser.EndElementHandler = lambda _: open_.pop()
    try:
        parser.Parse(text.encode(), True)
    except expat.ExpatError:
        pass
    return [m for m in members if m], [y for y in years if y]


def test_random_breaks_against_another_parser(spark):
    """Tags taken out, doubled or cut off: what is kept is what that parser had read."""
    rng, texts = random.Random(12), []
    while len(texts) < 400:
        text = random_record(rng)
        tags = [m.span() for m in re.finditer(r"</?[a-z][^<>]*>", text)]
        a, b = rng.choice(tags[1:])
        texts.append(rng.choice([text[:a] + text[b:], text[:a] + "</x>" + text[a:], text[:b] + text[a:], text[:a], text[: a + 1], text[:b]]))
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, raw string").repartition(8)
    fixed, salvaged = dict(frame.select("id", repair("raw")).collect()), 0
    for row in extract_groups(frame, on_bad="salvage").collect():
        members, years = read_until_broken(fixed[row["id"]])
        nested = re.search(r"<(author|year)[^<>]*(?<!/)>(?:(?!</\1>).)*<(author|year)\b", fixed[row["id"]])
        assert row["_corrupt_record"] is None, texts[row["id"]]
        salvaged += row["bad_reason"] is not None
        if not nested:  # members inside members are not supported
            assert row["members"] == members, texts[row["id"]]
            assert row["year"] == (int(years[-1]) if years and years[-1].isdigit() else None), texts[row["id"]]
    assert salvaged > 150


def test_salvage_is_worked_out_for_bad_records_only(spark):
    """The fold and the second parse stand behind a condition, and no parse is done twice."""
    frame = spark.createDataFrame([(GOOD,)], "raw string")
    plan = extract_groups(frame, on_bad="salvage")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 3 and plan.count("regexp_extract_all(") == 1
    assert "CASE WHEN isnotnull(_found" in plan


def test_other_element_names(spark):
    frame = spark.createDataFrame([("<a><by>X</by><by>Y</by><when>7</when></a>",)], "raw string")
    row = extract_groups(frame, member="by", year="when").collect()[0]
    assert (row["members"], row["year"]) == (["X", "Y"], 7)


def test_no_text_is_no_members(spark):
    row = extract_groups(spark.createDataFrame([(None,)], "raw string")).collect()[0]
    assert (row["members"], row["n"], row["year"]) == ([], 0, None)


def test_root_kind(spark):
    frame = spark.createDataFrame([("<book k='1'>",), (" <www>",), ("x",)], "raw string")
    assert [r[0] for r in frame.select(root_kind("raw")).collect()] == ["book", "www", ""]


def test_text_is_parsed_once(spark):
    """A filter on extracted fields must not run the parser again."""
    frame = spark.createDataFrame([(GOOD,)], "raw string")
    good, _ = split_bad(extract_groups(frame))
    plan = good.where((F.col("n") > 0) & (F.col("year") > 1900))._jdf.queryExecution().optimizedPlan().toString()
    # the direct parse and the one of flattened text, which runs only where needed
    assert plan.count("from_xml(") == 2


def random_record(rng):
    """Sound markup around untidy text, with members at any depth."""
    words = ["Ann", "B & C", "K&ouml;hn", "x < 3", "<1 y>", "é\n", " ", "", "D-E, F", "it's"]

    def text():
        return "".join(rng.choice(words) for _ in range(rng.randint(0, 3)))

    def element(depth):
        kind = rng.random()
        if kind < 0.4:
            attribute = rng.choice(["", ' o="1"', " o='a b'"])
            inner = rng.choice([text(), f"{text()}<i>{text()}</i>{text()}"])
            return f"<author{attribute}>{inner}</author>"
        if kind < 0.5:
            return f"<year>{rng.choice(['1999', '2001', 'n.d.', ''])}</year>"
        if kind < 0.6:
            return rng.choice(["<author/>", "<year/>", "<hr/>", "<!-- <author>no</author> -->"])
        if depth < 3:
            return f"<part>{''.join(element(depth + 1) for _ in range(rng.randint(0, 3)))}</part>"
        return f"<title>{text()}</title>"

    return f"<article k='1'>{''.join(element(0) for _ in range(rng.randint(0, 6)))}</article>"


def test_random_records_against_a_tree_parser(spark):
    """Fields of the repaired text as another XML parser sees them."""
    rng = random.Random(11)
    texts = [random_record(rng) for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, raw string").repartition(8)
    fixed = dict(frame.select("id", repair("raw")).collect())
    for row in extract_groups(frame).collect():
        root = ElementTree.fromstring(fixed[row["id"]])
        members = ["".join(e.itertext()) for e in root.iter("author")]
        years = [t for t in ("".join(e.itertext()) for e in root.iter("year")) if t]
        assert row["_corrupt_record"] is None, texts[row["id"]]
        assert row["members"] == [m for m in members if m], texts[row["id"]]
        expected = int(years[-1]) if years and years[-1].isdigit() else None
        assert row["year"] == expected, texts[row["id"]]


def _parsed_only(spark, table, monkeypatch, **options):
    """The groups with every record parsed."""
    with monkeypatch.context() as patched:
        patched.setattr(markup, "_is_plain", lambda *args: F.lit(False))
        return extract_groups(table, **options)


def test_plain_records_are_cut_out_and_others_parsed(spark):
    plain = [
        "<article key='a/1' mdate=\"1 > 0\">\n<author>A B</author><author orcid='0'>C & D</author ><year>1999</year></article>",
        "<www><people><author>É😀</author></people><title>a < b & <1 more> <i>c</i></title><author></author></www>",
        "<book><author>&uuml; x\ty</author><authority>no</authority></book>",
    ]
    others = [
        "<article><author>open</article>",
        "<article><author><i>A</i></author></article>",
        "<article><author> </author></article>",
        "<article><AUTHOR>A</AUTHOR></article>",
        "<article><author>a]]>b</author></article>",
        "<article><author>a\rb</author></article>",
        "<article><author>a\x01b</author></article>",
        "<article k='1' k='2'><author>A</author></article>",
        "<article corrupt_record='x'><author>A</author></article>",
        "<article><!-- <author>A</author> --></article>",
        "<article><![CDATA[<author>A</author>]]></article>",
        "<article><author/></article>",
        "<author><author>A</author></author>",
        "<article><author>A</author></article>behind",
        "",
        None,
    ]
    table = spark.createDataFrame([(text,) for text in plain + others], "raw string")
    rows = table.select("raw", markup._is_plain(markup._joined(F.col("raw")), "author", "year").alias("plain")).collect()
    assert {row.raw for row in rows if row.plain} == set(plain)


@pytest.mark.parametrize("on_bad", ["quarantine", "salvage", "drop"])
def test_plain_records_give_what_a_parse_gives(spark, monkeypatch, on_bad):
    rng = random.Random(17)
    shapes = ["<author>%s</author>", "<author k='1'>%s</author >", "<year>%s</year>", "<p><q><author>%s</author></q></p>", "<i>%s</i>"]
    shapes += ["%s", "<author><i>%s</i></author>", "<authority>%s</authority>", "<AUTHOR>%s</AUTHOR>", "<author>%s"]
    texts = ["", "x", " ", "  y ", "a & b", "< b", "<1 m> z", "1999", "]]>", "\t", "a\rb", "é", "😀", "\x01", " ", "a\n b", "&lt;", "<>"]
    roots = ["", " key='1'", " a='1' b='2'", " a='1' a='2'", " ab='1' a='2'", " a='1' ab='2'", " corrupt_record='z'", " k='<'", " "]
    rows = []
    for number in range(1500):
        body = "".join(rng.choice(shapes).replace("%s", rng.choice(texts)) for _ in range(rng.randint(0, 4)))
        rows.append((number, f"<article{rng.choice(roots)}>{body}</article>"))
    table = spark.createDataFrame(rows, "id int, raw string")
    assert table.where(markup._is_plain(markup._joined(F.col("raw")), "author", "year")).count() > 100
    found = extract_groups(table, on_bad=on_bad)
    parsed = _parsed_only(spark, table, monkeypatch, on_bad=on_bad)
    assert sorted(map(str, found.collect())) == sorted(map(str, parsed.collect()))
