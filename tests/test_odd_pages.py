"""Queries over pages that lack an address or a text, or whose title has what looks like a tag."""

import __spark_entry__ as entry
import duckdb
import pytest
from conftest import oracle_rows, rows_of

PAGE = '<!DOCTYPE html><html lang="en"><head><title>{t}</title></head><body><nav>no</nav><article><h1>{h}</h1><p>Body {n}</p></article></body></html>'
SHOWN = PAGE.replace("{h}", "{t}")
ADDRESS = "https://www.e{n}.example.org/a/{n}?x=1"


def stored(spark, d, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet/*.parquet'")
    return str(d), con


def test_archive_run_passes_pages_without_address(spark, tmp_path):
    """They have no form that an archive could be asked for; the others are as the SQL has them."""
    rows = [(n, {0: None, 1: "", 2: "no address"}.get(n // 8, ADDRESS.format(n=n)), SHOWN.format(t=f"T {n}", n=n)) for n in range(48)]
    d, con = stored(spark, tmp_path, rows)
    lacking = {str(n) for n, url, _ in rows if url != ADDRESS.format(n=n)}
    df = entry.queries()["archive_run"](spark, d)
    names, want = oracle_rows(con, entry.oracle_sql()["archive_run"])
    got, at = rows_of(df), names.index("id")
    assert {x[at] for x in got} == {str(n) for n in range(48)} and len(got) == 48
    assert [x for x in got if x[at] not in lacking] == [x for x in want if x[at] not in lacking]


def test_identity_level_has_no_row_for_pages_without_text(spark, tmp_path):
    none = [None, "", "  ", "<html></html>", "<title>t</title>", "<nav></nav>"]
    rows = [(n, ADDRESS.format(n=n), none[n] if n < len(none) else SHOWN.format(t=f"T {n}", n=n)) for n in range(12)]
    d, con = stored(spark, tmp_path, rows)
    assert rows_of(entry.queries()["identity_level"](spark, d)) == oracle_rows(con, entry.oracle_sql()["identity_level"])[1]


@pytest.mark.parametrize("name", ["live_scrape", "identity_level", "archive_run", "page_candidates", "page_extract"])
def test_tags_in_titles_are_text(spark, tmp_path, name):
    rows = [(n, ADDRESS.format(n=n), PAGE.format(t=f"Use <vector> &amp; </b> {n} &am", h=f"Use &lt;vector&gt; &amp; &lt;/b&gt; {n} &am", n=n)) for n in range(24)]
    d, con = stored(spark, tmp_path, rows)
    assert rows_of(entry.queries()[name](spark, d)) == oracle_rows(con, entry.oracle_sql()[name])[1]


def test_titles_and_tags_end():
    from salvor.functions import html

    root = html.document("<title>a <b>&amp;lt; <p>x</p><title>y<article>z</article>")  # none has an end tag
    assert [n.text() for n in root.walk() if n.tag == "article"] == ["z"]
    root = html.document("<TITLE>a <b> &amp;lt;</Title><svg><title>c</title></svg><x&y>d</x&y><i>e</i>")
    assert [(n.tag, n.text(frozenset())) for n in root.children] == [("title", "a <b> &lt;"), ("svg", "c"), ("x&y", "d"), ("i", "e")]
