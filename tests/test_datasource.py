"""Documents as a Spark data source: batch reads by partition, and a stream that takes new files only."""

import pytest
from pyspark.sql import functions as F

from parchmill.errors import ConfigurationError
from parchmill.plans.ingest_queries import _printed
from parchmill.sources import datasource, files


@pytest.fixture()
def folder(tmp_path):
    corpus = tmp_path / "corpus"
    (corpus / "deep").mkdir(parents=True)
    (corpus / "rules.md").write_text("# Rules\n\ntext one")
    (corpus / "deep" / "page.HTML").write_text("<h1>Head</h1><p>words")
    (corpus / "broken.docx").write_bytes(b"none")
    (corpus / "lines.pdf").write_bytes(_printed("x 1", [{"page": 0, "text": "Printed", "size": 10, "bold": False, "base": 40}]))
    for skipped in ("README.md", ".hidden.md", "notes.rtf"):
        (corpus / skipped).write_text("# skipped")
    return corpus


def test_format_gives_blocks(spark, folder):
    datasource.register(spark)
    rows = spark.read.format("parchmill").option("partBytes", 1).load(str(folder))
    assert rows.rdd.getNumPartitions() == 4
    got = {r["path"].rsplit("/", 1)[-1]: r for r in rows.collect()}
    assert set(got) == {"rules.md", "page.HTML", "broken.docx", "lines.pdf"}
    assert [b["text"] for b in got["rules.md"]["blocks"]] == ["Rules", "text one"] and got["page.HTML"]["document_type"] == "html"
    assert got["broken.docx"]["error_class"] == "DocumentParseError" and got["lines.pdf"]["lines"][0]["text"] == "Printed" and not got["lines.pdf"]["blocks"]
    laid = {r["path"].rsplit("/", 1)[-1]: r for r in files.laid(rows).collect()}
    same = {r["path"].rsplit("/", 1)[-1]: r for r in files.load(files.discover(spark, str(folder))).collect()}
    assert {n: (r["blocks"], r["title_hint"], r["error"]) for n, r in laid.items()} == {n: (r["blocks"], r["title_hint"], r["error"]) for n, r in same.items()}
    assert spark.read.format("parchmill").load(str(folder / "notes.rtf")).first()["error_class"] == "UnsupportedFormatError"
    with pytest.raises(ConfigurationError):
        datasource.listed(str(folder / "missing"))


def test_stream_takes_new_files(spark, folder, tmp_path, monkeypatch):
    datasource.register(spark)
    out = str(tmp_path / "out")

    def run():
        stream = spark.readStream.format("parchmill").load(str(folder)).select("path", F.size("blocks").alias("n"))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted(r["path"].rsplit("/", 1)[-1] for r in spark.read.schema("path string, n int").parquet(out).collect())

    assert run() == ["broken.docx", "lines.pdf", "page.HTML", "rules.md"]
    assert run() == ["broken.docx", "lines.pdf", "page.HTML", "rules.md"]
    (folder / "new.md").write_text("# New")
    assert run() == ["broken.docx", "lines.pdf", "new.md", "page.HTML", "rules.md"]
