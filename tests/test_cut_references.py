"""Queries over pages in which a title, a heading or a text was cut within a character reference."""

import __spark_entry__ as entry
import duckdb
import pytest
from conftest import oracle_rows, rows_of

QUERIES = ["archive_all", "archive_run", "identity_level", "live_scrape", "page_candidates", "page_extract", "page_title_norm"]
CUTS = ["&amp", "&quot", "&am", "&lt", "&copy"]
PAGE = '<!DOCTYPE html><html lang="en"><head><title>{t}</title></head><body><nav>no</nav><article><h1>{t}</h1><p>Body {n}: x &amp; y &copy;{cut}</p>{cut}</article></body></html>'


@pytest.fixture(scope="module")
def cut_pages(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pages"))
    cut = lambda n: CUTS[n % len(CUTS)]
    rows = [(n, f"https://www.e{n}.example.org/a/{n}?x=1", PAGE.format(n=n, cut=cut(n), t=f"T {n} &amp;&amp;{cut(n)}")) for n in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet/*.parquet'")
    return d, con


@pytest.mark.parametrize("name", QUERIES)
def test_cut_references_equal_sql(spark, cut_pages, name):
    d, con = cut_pages
    df = entry.queries()[name](spark, d)
    names, want = oracle_rows(con, entry.oracle_sql()[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == want


def test_references_need_their_semicolon():
    from salvor.functions import html, text

    assert text.normalized_title("A &amp;amp; &#39;B&quot; &amp &ampx; &quot &nothing; & &#3") == "a &amp; 'b\" & &x; &quot &nothing; & &#3"
    page = '<title>a&amp;amp &ampb</title><p title="x&copy=1&amp;y">c&amp &copy; <b&c><script type="application/ld+json">{"articleBody": "d & e&amp"}</script>'
    root = html.document(page)
    p = next(n for n in root.walk() if n.tag == "p")
    assert p.attrs == {"title": "x&copy=1&y"} and p.text() == "c&amp © " and "b&c" in {n.tag for n in root.walk()}
    assert next(n.text() for n in root.walk() if n.tag == "title") == "a&amp &b"
    assert html.json_ld(root) == [{"articleBody": "d & e&amp"}]
