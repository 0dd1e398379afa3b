import html
import random
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsflow.fixed_values import BOILERPLATE_PHRASES, CHARACTER_REPLACEMENTS
from newsflow.functions import text as T


def run(spark, values, change):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    rows = df.select("i", change(F.col("c")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


GOLDEN = [
    (T.clean_text, None, ""),
    (T.clean_text, "", ""),
    (T.clean_text, "&amp;amp; a\n\n\n\nb", "& a b"),
    (T.clean_text, "see https://x.y/z?a=b now", "see now"),
    (T.clean_text, "mail a.b@c.de ok", "mail ok"),
    (T.clean_text, "<p>hi</p> there x", "hi there x"),
    (T.clean_text, "“quoted” – it’s…", '"quoted" - it\'s...'),
    (T.strip_phones, "in 2024 at 12", "in   at 12"),
    (T.strip_phones, "Tel. +84 (28) 3829-1234!", "Tel. + !"),
    (T.normalize_title, None, ""),
    (T.normalize_title, "hello | Site", "Hello"),
    (T.normalize_title, "[Video] abc", "abc"),
    (T.normalize_title, "a &amp; <b>b</b>  c - news.vn", "A & b c"),
    (T.normalize_title, "élan", "Élan"),
    (T.strip_boilerplate, "x\nSource: y\nz", "x\n\nz"),
    (T.strip_boilerplate, "x Image credit: y", "x Image \n"),
    (T.strip_boilerplate, "a (Copyright ©) b\r\nc", "a (\nc"),
    (T.strip_boilerplate, "ſOURCE: a\nALL RİGHTS RESERVED b", "\n\n"),
    (T.strip_boilerplate, "", ""),
    (T.collapse_whitespace, " a  b \t\n c\u00a0d\u2003 e ", " a b c d e "),
    (T.strip_edges, "\u3000\x1c\x85 a b \u00a0\n", "a b"),
    (T.strip_byline, "By John Smith\nText", "Text"),
    (T.strip_byline, "Text\nby Ann Lee Roe ", "Text"),
    (T.strip_byline, "By Trần An\nText", "By Trần An\nText"),
    (T.strip_pubinfo, "Published on Monday, May 5, 2025 at 10\nText", "Text"),
    (T.strip_pubinfo, "Text\nUpdated Tue, June 10, 2025 x", "Text"),
    (T.cap_newlines, "a\n\n\n\nb\n\nc", "a\n\nb\n\nc"),
    (T.unescape_html, "&eacute;&#8212;&lt;&nope;", "é—<&nope;"),
    (T.normalize_unicode, "ﬁ ① Ａ", "fi 1 A"),
]


@pytest.mark.parametrize(("change", "value", "expected"), GOLDEN)
def test_golden(spark, change, value, expected):
    assert run(spark, [value], change) == [expected]


def test_own_phrases(spark):
    values = ["Đọc thêm: x\ny", "ĐỌC THÊM: x", "straẞe x", "none"]
    got = run(spark, values, lambda c: T.strip_boilerplate(c, ["đọc thêm:", "straße"]))
    assert got == ["\ny", "\n", "\n", "none"]
    assert run(spark, ["Source: x"], lambda c: T.strip_boilerplate(c, [])) == ["Source: x"]


def test_flags(spark):
    keep = dict(remove_urls=False, remove_phones=False, normalize_spaces=False, remove_tags=False)
    value = " http://a.b 2024\n\n\n\n<b>&lt;x</b>\t"
    assert run(spark, [value], lambda c: T.clean_text(c, **keep)) == ["http://a.b 2024\n\n<b><x</b>"]
    raw = run(spark, ["&lt; ’"], lambda c: T.clean_text(c, decode_entities=False))
    assert raw == ["< '"]
    assert run(spark, ["&lt; ’"], lambda c: T.clean_text(c, normalize_characters=False)) == ["< ’"]


EMAIL = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", re.I)
PHONE = re.compile(
    r"\b(\+?[0-9]{1,3}[-.\s]?)?(\([0-9]{1,4}\)|[0-9]{1,4})[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,9}\b"
)


def plain_clean(text):
    text = html.unescape(text)
    for old, new in CHARACTER_REPLACEMENTS:
        text = text.replace(old, new)
    text = unicodedata.normalize("NFKC", text)
    text = re.sub(r"https?://[^\s]+", " ", text, flags=re.I)
    text = PHONE.sub(" ", EMAIL.sub(" ", text))
    text = re.sub(r"<[^>]*>", " ", text)
    return re.sub(r"\s+", " ", text).strip()


def plain_boilerplate(text):
    for phrase in BOILERPLATE_PHRASES:
        text = re.sub(re.escape(phrase) + r".*?(\n|$)", "\n", text, flags=re.I)
    return text


PIECES = [
    "é", "à", "1", "23", "4567", "+84", "(028)", "-", ".", " ", " ", " ", "\n", "\r\n",
    "\x1c", "\x85", "a@b.co", "é@x.vn", "x.y@z", "http://a/b", "HTTPS://é", "&amp;", "&lt;b&gt;",
    "<i>", "</i>", "<", ">", "source:", "Image Credit: z", "share this article", "Copyright ©",
    "abc", "Zß", "_", "’", "…", "ﬁ", "٣٤٥",
]
SAMPLES = st.lists(st.sampled_from(PIECES), max_size=14).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SAMPLES, min_size=40, max_size=40))
def test_cleaning_equals_plain_python(spark, values):
    assert run(spark, values, T.clean_text) == [plain_clean(v) for v in values]
    assert run(spark, values, T.strip_boilerplate) == [plain_boilerplate(v) for v in values]


def test_documents_equal_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    rows = docs.select("text", T.clean_text(F.col("text")).alias("c")).collect()
    assert all(r["c"] == plain_clean(r["text"]) for r in rows)
    assert not any("  " in r["c"] for r in rows)


def test_clean_article_leaves_absent_columns_and_nulls(spark):
    df = spark.createDataFrame(
        [(None, None, None, "x", "a\nSource: b\nhttp://k/2 <i>"), ("t", "A  B", "2024", "y", None)],
        "title string, author string, publish_time string, other string, markdown_content string",
    )
    rows = T.clean_article(df).collect()
    assert rows[0].asDict() == {
        "title": "", "author": None, "publish_time": None, "other": "x",
        "markdown_content": "a http://k/2 <i>",
    }
    assert rows[1]["author"] == "A B" and rows[1]["markdown_content"] == ""


def test_clean_article_html(spark):
    page = "<body><p>nav</p><article onclick='x' id='a'>Hi<!-- c --><script>s</script></article></body>"
    df = spark.createDataFrame([("u", page)], "url string, html_content string")
    assert T.clean_article(df).first()["html_content"] == '<article id="a">Hi</article>'


def test_plain_rows_send_no_text_to_python(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice("abc <>1") for _ in range(20)) for _ in range(30)]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    # Rows without entities and beyond ASCII reach the Python step as null.
    plan = df.select(T.clean_text(F.col("c")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "CASE WHEN" in plan.split("ArrowEvalPython")[1]


SQL_NAMES = {
    T.clean_text: "clean_text", T.strip_phones: "strip_phones", T.cap_newlines: "cap_newlines",
    T.normalize_title: "normalize_title", T.strip_boilerplate: "strip_boilerplate",
    T.collapse_whitespace: "collapse_whitespace", T.unescape_html: "unescape_html",
    T.normalize_unicode: "normalize_unicode",
}


def test_sql_functions_equal_the_column_functions(spark):
    from newsflow.functions import register_sql_functions

    register_sql_functions(spark)
    cases = [(SQL_NAMES[f], value, expected) for f, value, expected in GOLDEN if f in SQL_NAMES]
    for name in sorted(set(SQL_NAMES.values())):
        rows = [(v, e) for n, v, e in cases if n == name]
        df = spark.createDataFrame(rows, "v string, e string")
        got = spark.sql(f"SELECT {name}(v) AS r, e FROM {{df}}", df=df).collect()
        assert [r["r"] for r in got] == [r["e"] for r in got], name


@pytest.mark.parametrize("name", ["strip_urls", "strip_emails", "strip_tags", "cap_newlines", "strip_boilerplate"])
def test_sql_functions_skip_texts_that_patterns_leave_alone(spark, name):
    """The pattern runs only behind a search for what it needs, and the results are those of the column functions."""
    from newsflow.functions import register_sql_functions

    register_sql_functions(spark)
    parts = ["a@b.co", "http://x.y z", "HTTPS://Q", "://", "<b>", "<", ">", "\n", "\n\n\n\n", "  ", "\t", " ", " ",
             "SOURCE: x", "Shareİthis", "Sıgn up", "share thİs article q\n", "Copyright ©", "K", "credit: K", "word"]
    rng = random.Random(7)
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(0, 8))),) for _ in range(400)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "v string")
    got = spark.sql(f"SELECT v, {name}(v) AS r, collapse_whitespace(v) AS s, clean_text(v) AS t FROM {{df}}", df=df)
    plan = spark.sql(f"SELECT {name}(v) AS r FROM {{df}}", df=df)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "Contains" in plan.replace("contains", "Contains")
    found = [(r.r, r.s, r.t) for r in got.collect()]
    change = getattr(T, name)
    expected = df.select(change(F.col("v")).alias("r"), T.collapse_whitespace(F.col("v")).alias("s"), T.clean_text(F.col("v")).alias("t"))
    assert found == [tuple(r) for r in expected.collect()]
