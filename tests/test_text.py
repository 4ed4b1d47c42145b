"""Text functions on texts written for these tests, with results worked out by hand."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from rolegauge.functions import experience, terms
from rolegauge.functions import text as T


def column_of(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "n int, t string")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("t"))).collect()]


def test_normalize_and_strip(spark):
    values = ["  Ab\t\nC ", " x y\x1c", "", "　", "İx"]
    assert column_of(spark, values, T.normalize) == ["ab c", "x y", "", "", "i̇x"]
    assert column_of(spark, values, T.strip) == ["Ab\t\nC", "x y", "", "", "İx"]
    assert column_of(spark, [T.SPACES + "a" + T.SPACES], T.strip) == ["a"]
    pattern = re.compile(r"[\s\x1c-\x1f\x85]")
    assert all(pattern.match(c) for c in T.SPACES)


def test_long_junk_takes_linear_time(spark):
    spaces, signs = "a" + " " * 1_000_000 + "b", "@ " + "a." * 500_000
    begin = time.time()
    assert column_of(spark, [spaces], T.strip) == [spaces]
    assert column_of(spark, [spaces], lambda t: F.size(T.bullet_lines(t))) == [1]
    assert column_of(spark, [signs], T.has_contact) == [False]
    assert time.time() - begin < 30


def test_email_hits_are_those_of_the_plain_pattern(spark):
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    rng = random.Random(4)
    values = ["".join(rng.choice(["a", "B7", ".", "@", "@b.", "io", "-", " ", "é", "_", "%"]) for _ in range(rng.randrange(14))) for _ in range(1500)]
    assert column_of(spark, values, lambda t: F.rlike(t, F.lit(T.EMAIL))) == [bool(plain.search(v)) for v in values]
    assert column_of(spark, values, T.is_email) == [bool(plain.fullmatch(v)) for v in values]


def test_term_hits(spark):
    values = ["java and javascript", "c++ c+ c", "go-lang go.", "node.js, nodes", ""]
    wanted = ["java", "javascript", "c++", "c", "go", "node.js", "node"]
    found = [sorted(h) for h in column_of(spark, values, lambda t: T.term_hits(t, wanted))]
    assert found == [["java", "javascript"], ["c", "c++"], [], ["node.js"], []]


def test_skills(spark):
    values = ["wrote css and docker files", "nosqlx", "kubernetes"]
    got = column_of(spark, values, terms.skills)
    assert "css" in got[0] and got[1] == []


def test_tokens(spark):
    values = ["the quick c# x node.js. a1 re-use 9lives", "_ab ab_ é"]
    assert column_of(spark, values, terms.base_tokens) == [["quick", "node.js", "re-use"], []]


def test_counts(spark):
    values = ["one two_three ² x-y", "- a • b * c -d", ""]
    assert column_of(spark, values, T.word_count) == [5, 4, 0]
    assert column_of(spark, values, T.bullet_markers) == [0, 3, 0]
    years = ["1987 2031 1887 x1999 1999x 20 2005.", "2010-2012"]
    assert column_of(spark, years, T.year_markers) == [3, 2]


def test_compact(spark):
    values = ["q  r", " \n q ", "y" * 150, "y" * 151, "ab " * 60, ""]
    out = column_of(spark, values, T.compact)
    assert out[:3] == ["q r", "q", "y" * 150] and out[3] == "y" * 147 + "..."
    assert out[4] == ("ab " * 49).rstrip() + "..." and out[5] == ""


def test_bullet_lines(spark):
    value = "  -* • first line of enough signs  \nshort\n• second line of enough signs\x1c\r\n- - - third, with dashes inside - yes"
    assert column_of(spark, [value], T.bullet_lines) == [
        ["first line of enough signs", "second line of enough signs", "third, with dashes inside - yes"]
    ]


def test_rewrites(spark):
    df = spark.createDataFrame([("* Assisted a museum in moving its archive", "Archivist"), ("- helped 12 clinics open on time", None)], "t string, title string")
    one, two = [r[0] for r in df.select(T.bullet_rewrites(F.col("t"), F.col("title"))).collect()]
    assert one[0]["before"] == "Assisted a museum in moving its archive"
    assert one[0]["after"].startswith("Improved delivered a museum in moving its archive for Archivist, adding")
    assert two[0]["after"] == "Delivered 12 clinics open on time"


@pytest.mark.parametrize(
    "text, years",
    [
        ("degree at a college, 2001 - 2005. hobbies: chess.", 0),
        ("a nurse with 11 years of work experience in three towns.", 11),
        ("experience of 6 yrs", 6),
        ("experience: 99 years", 25),
        ("engineer, 2003 - 2006, then engineer, 2005 - 2009", 6),
        ("developer, 1969 - 1975", 0),
        ("developer, 2018 - 2011", 0),
        ("manager from march 2016 to present", 10),
        ("", 0),
    ],
)
def test_experience_years(spark, text, years):
    assert column_of(spark, [text], lambda t: experience.experience_years(t, 2026)) == [years]


def test_dated_ranges(spark):
    value = "jan 2011 until now; " + "z" * 90 + " work 1999 – 2001 " + "z" * 90 + " 2020 to dec 2022"
    got = column_of(spark, [value], lambda t: experience.dated_ranges(t, 2026))[0]
    assert [tuple(r)[:2] for r in got] == [(2011, 2026), (1999, 2001), (2020, 2022)]
    assert tuple(got[1])[2] is True and tuple(got[2])[2] is False


def test_term_vector_and_ranking(spark):
    df = spark.createDataFrame([(["x", "k", "x", "m", "x", "k"],), ([],)], "bag array<string>")
    rows = df.select(terms.term_vector(F.col("bag")), terms.ranked_terms(F.col("bag"))).collect()
    assert [tuple(t) for t in rows[0][0]] == [("k", 2), ("m", 1), ("x", 3)]
    assert rows[0][1] == ["x", "k", "m"] and (rows[1][0], rows[1][1]) == ([], [])


def test_dot_product(spark):
    rng = random.Random(6)
    bags = [([rng.choice("abcdefgh") for _ in range(rng.randrange(12))], [rng.choice("efghijkl") for _ in range(rng.randrange(12))]) for _ in range(200)]
    df = spark.createDataFrame([(n, *b) for n, b in enumerate(bags)], "n int, l array<string>, r array<string>").orderBy("n")
    got = [r[0] for r in df.select(terms.dot_product(terms.term_vector(F.col("l")), terms.term_vector(F.col("r")))).collect()]
    assert got == [sum(left.count(t) * right.count(t) for t in set(left)) for left, right in bags]


def test_bag_cosine_is_the_cosine_of_the_vectors(spark):
    rng = random.Random(7)
    many = [f"t{n}" for n in range(3 * terms.MOST_LOOKUPS)]
    pools = [("abcdefgh", "efghijkl", 12)] * 60 + [(many, many, 600)] * 4
    bags = [([rng.choice(a) for _ in range(rng.randrange(n))], [rng.choice(b) for _ in range(rng.randrange(n))]) for a, b, n in pools]
    bags += [([], []), (["a"], []), (None, ["a"]), (["a", "a"], ["a"])]
    df = spark.createDataFrame(bags, "l array<string>, r array<string>")
    plain = terms.cosine(terms.term_vector(F.col("l")), terms.term_vector(F.col("r")))
    rows = df.select(terms.bag_cosine(F.col("l"), F.col("r")), plain).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] and rows[-1][0] == 1.0
    assert max(len(set(a or []) & set(b or [])) for a, b in bags) > terms.MOST_LOOKUPS


def test_occurrences_of_nothing_and_of_null(spark):
    assert column_of(spark, ["teh teh", "the", "", None], T.typo_count) == [2, 0, 0, None]


def test_few_terms_that_start_longer_ones(spark):
    wanted = ["responsive", "responsive design", "css", "html", "sql", "git"]
    values = ["responsive design", "a responsive site", "unresponsive", "css", None]
    found = column_of(spark, values, lambda t: F.sort_array(T.term_hits(t, wanted)))
    assert found == [["responsive", "responsive design"], ["responsive"], [], ["css"], None]


def test_ranges_beside_marks_and_words(spark):
    values = ["2018 \x01 2019", "\x012011 - 2014\x02", "sept 2011 until now", "2011 to", "12 2011 - march 2014", "x2011–2012"]
    got = column_of(spark, values, lambda t: experience.dated_ranges(t, 2026))
    assert [[tuple(r)[:2] for r in rows] for rows in got] == [[], [(2011, 2014)], [(2011, 2026)], [], [(2011, 2014)], [(2011, 2012)]]


def test_keyword_list(spark):
    assert column_of(spark, ["q, r s,, T ,"], T.keyword_list) == [["q", "r s", "T"]]


def test_classes_hold_the_characters_of_their_properties(spark):
    """Classes name their ASCII characters one by one and mean the same as the properties, for every code point."""
    signs = spark.createDataFrame([(chr(n),) for n in range(0x110000) if not 0xD800 <= n < 0xE000], "c string").repartition(4)
    classes = {
        T.SPACE: r"[\s\x1c-\x1f\x85\p{Z}]", T.WORD_CHAR: r"[\p{L}\p{N}_]", T.DIGIT: r"\p{Nd}", T.FIGURE: r"[\p{Nd}%$]", T.TERM_CHAR: "[a-z0-9+#.-]",
        T.LINE_BREAK: r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]",
    }
    for named, plain in classes.items():
        assert signs.filter(F.rlike("c", F.lit(named)) != F.rlike("c", F.lit(plain))).count() == 0, named


def test_only_uneven_space_is_replaced(spark):
    values = ["a b", " a  b ", "a\tb", "a \u00a0b", "\u2003a\r\n b", "a\n", "", None]
    plain = column_of(spark, values, lambda t: F.regexp_replace(t, r"[\s\x1c-\x1f\x85\p{Z}]+", " "))
    assert column_of(spark, values, lambda t: F.regexp_replace(t, T.UNEVEN_SPACE, " ")) == plain
    assert column_of(spark, ["a\r\nb\rc\n\rd"], lambda t: F.split(t, T.LINE_BREAK)) == [["a", "b", "c", "", "d"]]


def test_weak_lines_are_the_first_of_the_bullet_lines(spark):
    lines = ["- short", "\u2022 - helped with the whole project", "* Increased the sales by 20 %", "  responsible for many things here", "nothing is named in this line", "one more line without results"]
    values = ["\n".join(lines), "\r\n".join(lines[:3]), "", None]
    expected = ["helped with the whole project", "responsible for many things here", "nothing is named in this line"]
    assert column_of(spark, values, T.weak_bullets) == [expected, expected[:1], [], None]


def test_stated_years_are_looked_for_once(spark):
    """Each of the two patterns stood twice in the plan, for the comparison and for the value."""
    df = spark.createDataFrame([("9 years of experience",), ("experience: 40 yrs",), ("years",), (None,)], "t string")
    years = df.select(experience.explicit_years(F.col("t")).alias("n"))
    assert [r[0] for r in years.collect()] == [9, 25, None, None]
    assert years._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == len(experience.EXPLICIT)
