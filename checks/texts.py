"""String cleaning functions over documents, page sources and part names."""

from pyspark.sql import functions as F

from checks.registry import check, table, texts
from newsflow.fixed_values import BOILERPLATE_PHRASES, EMAIL_PATTERN, PHONE_PATTERN
from newsflow.functions import text as T
from newsflow.functions import clean_article, register_sql_functions

# The regex dialect of the check engine: its own whitespace class lacks the Unicode separators.
SQL_SPACE = r"[\s\x0b\p{Z}\x1c-\x1f\x{85}]"


SQL_KEPT_COUNT = (
    r"len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), "
    "lambda x: length(x) >= 3))"
)


def sql_replace(expr: str, pattern: str, new: str, options: str = "g") -> str:
    pattern = pattern.replace("'", "''")
    return f"regexp_replace({expr}, '{pattern}', '{new}', '{options}')"


def sql_emails(expr: str) -> str:
    return sql_replace(expr, EMAIL_PATTERN, " ", "gi")


def sql_phones(expr: str) -> str:
    return sql_replace(expr, PHONE_PATTERN, " ", "gi")


def sql_urls(expr: str) -> str:
    return sql_replace(expr, r"https?://[^\s\x0b\p{Z}\x1c-\x1f\x{85}]+", " ", "gi")


def sql_collapse(expr: str) -> str:
    return sql_replace(expr, SQL_SPACE + "+", " ")


def sql_clean(expr: str, urls: bool = True, tags: bool = True) -> str:
    expr = sql_urls(expr) if urls else expr
    expr = sql_phones(sql_emails(expr))
    expr = sql_replace(expr, "<[^>]*>", " ") if tags else expr
    return f"coalesce(trim({sql_collapse(expr)}), '')"


def sql_boilerplate(expr: str) -> str:
    for phrase in BOILERPLATE_PHRASES:
        expr = sql_replace(expr, rf"\Q{phrase}\E[^\n]*(?:\n|\z)", "\n", "gi")
    return expr.replace("'\n'", "chr(10)")


NAMES = rf"[A-Z][a-z]+({SQL_SPACE}+[A-Z][a-z]+)*"


def sql_byline(expr: str) -> str:
    expr = sql_replace(expr, rf"^By{SQL_SPACE}+{NAMES}{SQL_SPACE}*\n", "")
    return sql_replace(expr, rf"\n[Bb]y{SQL_SPACE}+{NAMES}{SQL_SPACE}*\z", "")


DATELINE = (
    rf"(?:Published|Updated|Posted)(?:{SQL_SPACE}+on)?{SQL_SPACE}+[\p{{L}}\p{{N}}_]+,{SQL_SPACE}+"
    rf"[\p{{L}}\p{{N}}_]+{SQL_SPACE}+\p{{Nd}}{{1,2}},{SQL_SPACE}+\p{{Nd}}{{4}}[^\n]*"
)


def sql_pubinfo(expr: str) -> str:
    return sql_replace(
        sql_replace(expr, rf"^{DATELINE}\n", ""), rf"\n{DATELINE}(\n?)\z", r"\1"
    )


def _docs(spark, sf_dir, text):
    """Documents with their text changed by an expression on it."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", text(F.col("text")).alias("text"))


def _apply(spark, sf_dir, decorate, change):
    return _docs(spark, sf_dir, decorate).select("doc_id", change(F.col("text")).alias("text"))


def _wrap(before: str, after: str):
    return lambda c: F.concat(F.lit(before), c, F.lit(after))


@check("unescape_html", """
    SELECT doc_id, text || ' & <b> é — "q" &unknown; &' AS text FROM documents""")
def q_unescape(spark, sf_dir):
    return _apply(
        spark, sf_dir, _wrap("", " &amp; &lt;b&gt; &eacute; &#8212; &quot;q&quot; &unknown; &"),
        T.unescape_html,
    )


@check("normalize_unicode", """
    SELECT doc_id, text || ' ''a'' "b" - -- ... fi 1 & <' AS text FROM documents""")
def q_normalize_unicode(spark, sf_dir):
    return _apply(
        spark, sf_dir, _wrap("", " ‘a’ “b” – — … ﬁ ① &amp; &lt;"), T.normalize_unicode
    )


@check("strip_urls", f"""
    SELECT doc_id, {sql_urls("'HTTP://x.example/a?b=1 ' || text || ' https://y.example/é#z, end'")}
      AS text FROM documents""")
def q_strip_urls(spark, sf_dir):
    return _apply(
        spark, sf_dir, _wrap("HTTP://x.example/a?b=1 ", " https://y.example/é#z, end"), T.strip_urls
    )


@check("strip_emails", f"""
    SELECT doc_id, {sql_emails("text || ' Mail A.B+c@Example.co.uk, x@y.z and q@r.io!'")} AS text
    FROM documents""")
def q_strip_emails(spark, sf_dir):
    return _apply(
        spark, sf_dir, _wrap("", " Mail A.B+c@Example.co.uk, x@y.z and q@r.io!"), T.strip_emails
    )


@check("strip_phones", f"""
    SELECT doc_id, {sql_phones("text || ' in 2024 at 12 call +84 (28) 3829-1234.'")} AS text
    FROM documents""")
def q_strip_phones(spark, sf_dir):
    return _apply(
        spark, sf_dir, _wrap("", " in 2024 at 12 call +84 (28) 3829-1234."), T.strip_phones
    )


@check("strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS text FROM pages")
def q_strip_tags(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", T.strip_tags(F.col("html")).alias("text"))


@check("collapse_whitespace", f"""
    SELECT doc_id, {sql_collapse("text || chr(9) || chr(160) || chr(8195) || ' x' || chr(133)")}
      AS text FROM documents""")
def q_collapse_whitespace(spark, sf_dir):
    return _apply(spark, sf_dir, _wrap("", "\t   x\u0085"), T.collapse_whitespace)


@check("cap_newlines", r"""
    SELECT doc_id, regexp_replace(replace(text, chr(10), chr(10) || chr(10) || chr(10)),
      '\n{3,}', chr(10) || chr(10), 'g') AS text FROM documents""")
def q_cap_newlines(spark, sf_dir):
    return _apply(spark, sf_dir, lambda c: F.replace(c, F.lit("\n"), F.lit("\n\n\n")), T.cap_newlines)


@check("clean_text", f"SELECT doc_id, {sql_clean('text')} AS text FROM documents")
def q_clean_text(spark, sf_dir):
    return _apply(spark, sf_dir, lambda c: c, T.clean_text)


@check("strip_boilerplate", f"""
    SELECT doc_id, {sql_boilerplate("text || chr(10) || 'x Image Credit: y' || chr(10) || 'end'")}
      AS text FROM documents""")
def q_strip_boilerplate(spark, sf_dir):
    return _apply(spark, sf_dir, _wrap("", "\nx Image Credit: y\nend"), T.strip_boilerplate)


@check("strip_byline", f"""
    SELECT doc_id,
      {sql_byline("'By John Smith' || chr(10) || text || chr(10) || 'by Mary Ann Lee '")} AS text
    FROM documents""")
def q_strip_byline(spark, sf_dir):
    return _apply(spark, sf_dir, _wrap("By John Smith\n", "\nby Mary Ann Lee "), T.strip_byline)


@check("strip_pubinfo", f"""
    SELECT doc_id, {sql_pubinfo('''
      'Published on Monday, May 5, 2025 by desk' || chr(10) || text || chr(10)
      || 'Updated Tuesday, June 10, 2025 10:00' || chr(10)''')} AS text
    FROM documents""")
def q_strip_pubinfo(spark, sf_dir):
    return _apply(
        spark, sf_dir,
        _wrap("Published on Monday, May 5, 2025 by desk\n", "\nUpdated Tuesday, June 10, 2025 10:00\n"),
        T.strip_pubinfo,
    )


@check("normalize_title", """
    SELECT p_partkey, CASE p_partkey % 6
      WHEN 0 THEN upper(p_name[1]) || p_name[2:] || ' & co'
      WHEN 1 THEN p_name
      WHEN 2 THEN upper(p_name[1]) || p_name[2:]
      WHEN 3 THEN upper(p_name[1]) || p_name[2:]
      WHEN 4 THEN upper(p_name[1]) || p_name[2:] || ' x'
      ELSE '' END AS title
    FROM part""")
def q_normalize_title(spark, sf_dir):
    name = F.col("p_name")
    cases = [
        F.concat(name, F.lit(" &amp; co")),
        F.concat(F.lit("[Video] "), name),
        F.concat(name, F.lit(" | Site | More")),
        F.concat(name, F.lit(" - site.example")),
        F.concat(F.lit("\n <b>"), name, F.lit("</b>\t\tx [UPDATE] ")),
        F.lit(None).cast("string"),
    ]
    title = F.coalesce(*[F.when(F.col("p_partkey") % 6 == i, c) for i, c in enumerate(cases)])
    return table(spark, sf_dir, "part").select("p_partkey", T.normalize_title(title).alias("title"))


@check("remove_boilerplate", f"""
    SELECT doc_id, regexp_replace({sql_pubinfo(sql_byline(sql_boilerplate(
        "'By Ann Lee' || chr(10) || text || chr(10) || 'Source: x'")))},
      '^{SQL_SPACE}+|{SQL_SPACE}+\\z', '', 'g') AS text
    FROM documents""")
def q_remove_boilerplate(spark, sf_dir):
    return _apply(spark, sf_dir, _wrap("By Ann Lee\n", "\nSource: x"), T.remove_boilerplate)


@check("clean_article", f"""
    SELECT doc_id, 'Story of ' || lang AS title, {sql_clean('text')} AS short_description,
      CASE WHEN doc_id % 3 > 0 THEN source || ' desk' END AS author,
      {sql_clean(f"regexp_replace({sql_pubinfo(sql_byline(sql_boilerplate('text')))}, "
                 f"'^{SQL_SPACE}+|{SQL_SPACE}+\\z', '', 'g')", urls=False, tags=False)}
        AS markdown_content
    FROM documents""")
def q_clean_article(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return clean_article(
        docs.select(
            "doc_id",
            F.concat(F.lit("<i>story</i> of "), "lang", F.lit(" | Daily")).alias("title"),
            F.col("text").alias("short_description"),
            F.when(F.col("doc_id") % 3 > 0, F.concat("source", F.lit("  desk "))).alias("author"),
            F.col("text").alias("markdown_content"),
        )
    )


@check("sql_functions", f"""
    SELECT doc_id, {sql_clean('text')} AS cleaned, {sql_boilerplate('text')} AS stripped,
      'Story of ' || lang AS title, text || ' & fi' AS decoded, {SQL_KEPT_COUNT} AS n_tokens
    FROM documents""")
def q_sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return spark.sql(
        """SELECT doc_id, clean_text(text) AS cleaned, strip_boilerplate(text) AS stripped,
             normalize_title('[Update]' || '<b>Story</b> of ' || lang || ' - n.example') AS title,
             normalize_unicode(unescape_html(text || ' &amp; &#64257;')) AS decoded,
             CAST(size(trend_tokens(text)) AS BIGINT) AS n_tokens
           FROM {docs}""",
        docs=docs,
    )
