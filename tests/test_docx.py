"""Word files: packages of every kind, and the query's plan reads each file once."""

import io
import random
import zipfile

import pytest

from parchmill.plans import ingest_queries
from parchmill.plans.ingest_queries import _NS, _STYLES, _package
from parchmill.sources import docx, files

ITEMS = [{"part": k, "quantity": k + 1, "supplier": k + 2} for k in range(3)]


def test_the_written_package_is_a_valid_one():
    content = _package(7, 8, "<F&", ITEMS)
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        assert z.testzip() is None and z.namelist() == ["word/styles.xml", "word/document.xml"]
    blocks, title, _ = docx.parse_docx(content)
    assert title == "Order 7" and [b["kind"] for b in blocks] == ["heading", "heading", "paragraph", "table", "heading"] + ["list_item"] * 3
    assert blocks[2]["text"] == "It has status <F&." and blocks[3]["text"].splitlines()[2:] == ["| 0 | 1 |", "| 1 | 2 |", "| 2 | 3 |"]


def package(method=zipfile.ZIP_DEFLATED, before=b"", comment=b"", core=False):
    out = io.BytesIO()
    out.write(before)
    with zipfile.ZipFile(out, "a" if before else "w", method) as z:
        z.comment = comment
        z.writestr("word/document.xml", f'<w:document {_NS}><w:body><w:p><w:pPr><w:pStyle w:val="T"/></w:pPr><w:r><w:t>One</w:t></w:r></w:p></w:body></w:document>')
        z.writestr("word/styles.xml", f"<w:styles {_NS}>{_STYLES}</w:styles>")
        if core:
            z.writestr("docProps/core.xml", '<c xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>Named</dc:title></c>')
    return out.getvalue()


@pytest.mark.parametrize("options", [{}, {"method": zipfile.ZIP_STORED}, {"method": zipfile.ZIP_LZMA}, {"before": b"front"}, {"comment": b"note"}, {"core": True}])
def test_packages_of_every_kind(options):
    blocks, title, hints = docx.parse_docx(package(**options))
    assert (title, hints) == ("One", {"title": "Named"} if options.get("core") else {}) and blocks == [{"kind": "heading", "text": "One", "level": 1}]


def test_broken_packages_fail_as_in_the_library():
    whole, drawn = package(), random.Random(3)
    for _ in range(300):
        at = drawn.randrange(len(whole))
        for broken in (whole[:at], whole[:at] + bytes([whole[at] ^ 1 << drawn.randrange(8)]) + whole[at + 1 :]):
            plain = docx._plain_package(broken)
            if plain is not None:
                wanted = docx._any_package(broken)
                assert all(plain(n) == wanted(n) for n in ("word/document.xml", "word/styles.xml", "docProps/core.xml"))
            row = files.parse_file("a.docx", broken, files.LOADERS)
            assert row[0] == "docx" and (row[4] is None or row[5].startswith("cannot read docx a.docx") or "no content" in row[5])


def test_tables_in_one_walk_and_by_cells(monkeypatch):
    """Random tables: what the one walk takes is what the walk by cells gives."""
    drawn, taken = random.Random(5), 0

    def tree(tag, deep):
        below = {"tbl": ["tr"] * 6 + ["tc"], "tr": ["tc"] * 8 + ["p", "tr"], "tc": ["p"] * 8 + ["tbl", "tcPr"], "p": ["r"] * 6 + ["tab"], "r": ["t"] * 8 + ["br", "tab"], "tcPr": ["gridSpan", "vMerge"]}.get(tag, []) if deep < 9 else []
        value = ' w:val="2"' if tag == "gridSpan" else ""
        inner = "".join(tree(drawn.choice(below), deep + 1) for _ in range(drawn.randrange(1, 4))) if below else drawn.choice(["a ", " b", "c  d", ""]) if tag == "t" else ""
        return f"<w:{tag}{value}>{inner}</w:{tag}>"

    for _ in range(3000):
        table = docx.ElementTree.fromstring(tree("tbl", 0).replace("<w:tbl>", f"<w:tbl {_NS}>", 1))
        plain = docx._plain_rows(table)
        with monkeypatch.context() as m:
            m.setattr(docx, "_plain_rows", lambda _: None)
            if plain is not None:
                taken += 1
                assert plain == docx._rows(table)
    assert taken > 30


def test_files_are_made_and_read_once(spark, sf_dir, monkeypatch):
    """The files of the query aren't made once more to look for paged formats among them."""
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda frame: pytest.fail("the files are looked at first"))
    ingest_queries.docx_blocks(spark, sf_dir)
