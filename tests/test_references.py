"""Queries over pages whose headings are cut inside a character reference, against their SQL."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from parchmill.plans import registry
from parchmill.sources.html import parse_html

HEADINGS = ["token = &quot", "token = &quot;9c4&quot;", "this &amp; that &amp", "one &am", "one &a", "one &quo", "a &amp;amp; b &amp;quot", "plain"]


def against_sql(spark, folder, name):
    pages = [f"<html><head><title>t</title></head><body><article><h1>{h}</h1>\n<p>Text &amp; &quot;more&quot; of {k}</p></article></body></html>" for k, h in enumerate(HEADINGS)]
    pq.write_table(pa.table({"page_id": pa.array(range(len(pages)), pa.int64()), "html": pages}), f"{folder}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, str(folder)).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_blocks_of_cut_headings(spark, tmp_path):
    against_sql(spark, tmp_path, "html_blocks")


def test_titles_of_cut_headings(spark, tmp_path):
    against_sql(spark, tmp_path, "html_title")


def test_the_loader_reads_references_as_html_has_it():
    texts = {"a &quot": 'a "', "a &lt; b &amp": "a < b &", "a &quo": "a &quo"}
    assert {k: parse_html(f"<h1>{k}</h1>")[1] for k in texts} == texts
