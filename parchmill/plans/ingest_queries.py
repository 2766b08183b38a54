"""Registered queries of loading, normalizing, indexing and the ingestion run.

Where the tables hold no files of a format, Spark writes each row as such a
file's bytes, and the loader reads them back.
"""

from __future__ import annotations

import struct
import zlib
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.paths import shared_dir
from ..operators import chunk, embed, index, layout, normalize
from ..sources import files
from . import ingest
from .base import register, table

_WORDS = "len(list_filter(string_split_regex({0}, '\\s+'), lambda x: x <> ''))"
_TOKENS = "CASE WHEN {0} = 0 THEN 0 ELSE greatest(1, floor(({0}) * 1.35::DOUBLE)) END::INT"


# -- files and loaders

@register("""
WITH f AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'a/p' || page_id || '.html' WHEN 1 THEN 'a/p' || page_id || '.HTM' WHEN 2 THEN 'b/.p' || page_id || '.md'
  WHEN 3 THEN 'b/README.md' WHEN 4 THEN 'b/p' || page_id || '.rtf' ELSE 'b/p.' || page_id || '.docx' END AS path FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'html' WHEN 1 THEN 'html' WHEN 2 THEN 'markdown' WHEN 3 THEN 'markdown' WHEN 5 THEN 'docx' END AS document_type,
  page_id % 6 IN (0, 1, 5) AS wanted, CASE page_id % 6 WHEN 0 THEN 'p' || page_id WHEN 1 THEN 'p' || page_id WHEN 2 THEN '.p' || page_id WHEN 3 THEN 'README' WHEN 4 THEN 'p' || page_id ELSE 'p.' || page_id END AS stem FROM f
""")
def file_routing(spark, sf_dir):
    """Paths of the pages under six kinds of names: which are documents, of what type."""
    n = F.col("page_id").cast("string")
    kind = F.col("page_id") % 6
    path = F.when(kind == 0, F.concat(F.lit("a/p"), n, F.lit(".html"))).when(kind == 1, F.concat(F.lit("a/p"), n, F.lit(".HTM"))).when(kind == 2, F.concat(F.lit("b/.p"), n, F.lit(".md"))).when(
        kind == 3, F.lit("b/README.md")).when(kind == 4, F.concat(F.lit("b/p"), n, F.lit(".rtf"))).otherwise(F.concat(F.lit("b/p."), n, F.lit(".docx")))
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    return rows.select("page_id", files.document_type(F.col("path")).alias("document_type"), files.wanted(F.col("path")).alias("wanted"), files.stem(F.col("path")).alias("stem"))


def _order_lines(spark, sf_dir) -> DataFrame:
    """Orders with their items in order."""
    item = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_quantity").cast("long").alias("quantity"), F.col("l_returnflag").alias("flag"))
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus", "items")


def _loaded(rows: DataFrame) -> DataFrame:
    """Blocks of rows (id, path, content) through the loader of each path's extension; none is of a paged format."""
    loaded = files.load(rows.select("path", "content"), paged=False).select(files.stem(F.col("path")).cast("long").alias("id"), "blocks")
    return loaded.select("id", F.posexplode("blocks").alias("pos", "b")).select("id", "pos", "b.kind", "b.text", F.coalesce("b.level", F.lit(0)).alias("level"))


_ITEMS = """
WITH i AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS part, l_suppkey AS supplier, l_quantity::BIGINT AS quantity, l_returnflag AS flag FROM lineitem),
o AS (SELECT o_orderkey AS id, o_custkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT id FROM i)),
t AS (SELECT id, string_agg('| ' || part || ' | ' || quantity || ' |', chr(10) ORDER BY n, part, supplier, quantity, flag) AS body, count(*) AS k FROM i GROUP BY id)
"""


@register(_ITEMS + """
SELECT id, 0 AS pos, 'heading' AS kind, 'Order ' || id AS text, 1 AS level FROM o UNION ALL
SELECT id, 1, 'paragraph', 'Customer ' || o_custkey || ' has status ' || o_orderstatus || ' today.', 0 FROM o UNION ALL
SELECT id, 2, 'table', '| part | quantity |' || chr(10) || '|---|---|' || chr(10) || body, 0 FROM t UNION ALL
SELECT id, 3, 'heading', 'Notes', 2 FROM o UNION ALL
SELECT id, 3 + row_number() OVER (PARTITION BY id ORDER BY n, part, supplier, quantity, flag)::INT, 'paragraph', 'Part ' || part || ' from ' || supplier, 0 FROM i UNION ALL
SELECT id, 4 + k::INT, 'paragraph', '```' || chr(10) || 'flag = *' || o_orderstatus || '*' || chr(10) || '```', 0 FROM o JOIN t USING (id)
""")
def markdown_blocks(spark, sf_dir):
    """Orders as Markdown files: headings of both kinds, emphasis, a link, a table, a list and code."""
    rows = F.array_join(F.transform("items", lambda x: F.format_string("| %d | %d |", x["part"], x["quantity"])), "\n")
    listed = F.array_join(F.transform("items", lambda x: F.format_string("- Part **%d** from\n  [%d](x \"y\")", x["part"], x["supplier"])), "\n")
    content = F.concat(
        F.lit("# Order "), "id", F.lit(" #\n\nCustomer *"), F.col("o_custkey"), F.lit("* has status\n`"), "o_orderstatus", F.lit("` today.\n\n| part | quantity |\n|:---|---:|\n"), rows,
        F.lit("\n\nNotes\n---\n"), listed, F.lit("\n\n<!-- hidden -->\n\n```\nflag = *"), "o_orderstatus", F.lit("*\n```\n"),
    )
    return _loaded(_order_lines(spark, sf_dir).select(F.concat(F.col("id").cast("string"), F.lit(".md")).alias("path"), content.cast("binary").alias("content")))


_STYLES = "".join(f'<w:style w:styleId="{i}"><w:name w:val="{n}"/></w:style>' for i, n in (("H1", "heading 1"), ("H9", "Heading 9"), ("T", "Title"), ("B", "List Bullet")))
_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def _paragraph(text: str, style: str = "", bold: bool = False) -> str:
    props = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
    return f"<w:p>{props}<w:r>{'<w:rPr><w:b/></w:rPr>' if bold else ''}<w:t>{text}</w:t></w:r></w:p>"


_ROW, _ITEM = f"<w:tr><w:tc>{_paragraph('%s')}</w:tc><w:tc>{_paragraph('%s')}</w:tc></w:tr>", _paragraph("Part %s from %s", "B")
_DOCUMENT = (
    f"<w:document {_NS}><w:body>" + _paragraph("Order %s", "T") + _paragraph("Customer %s", bold=True) + _paragraph("It has status %s.", bold=True) + "<w:tbl>" + _ROW % ("part", "quantity") + "%s</w:tbl>"
    + _paragraph("Notes", "H9") + "%s" + _paragraph("  ") + "</w:body></w:document>"
)


def _member(name: bytes, text: bytes, place: int) -> tuple[bytes, bytes]:
    """A deflated member of a package whose header is at ``place``, and its line in the directory."""
    packer = zlib.compressobj(wbits=-15)
    data = packer.compress(text) + packer.flush()
    facts = struct.pack("<5H3I2H", 20, 0, 8, 0, 0x21, zlib.crc32(text), len(data), len(text), len(name), 0)  # 1 January 1980
    return b"PK\3\4" + facts + name + data, b"PK\1\2" + struct.pack("<H", 20) + facts + struct.pack("<3H2I", 0, 0, 0, 0, place) + name


_STYLED = _member(b"word/styles.xml", f"<w:styles {_NS}>{_STYLES}</w:styles>".encode(), 0)


def _package(key: int, customer: int, status: str, items: list[dict]) -> bytes:
    """An order as a Word file."""
    return _word_file(key, customer, status, *([x[c] for x in items] for c in ("part", "quantity", "supplier")))


def _word_file(key: int, customer: int, status: str, parts: list[int], quantities: list[int], suppliers: list[int]) -> bytes:
    rows, listed = "".join([_ROW % x for x in zip(parts, quantities)]), "".join([_ITEM % x for x in zip(parts, suppliers)])
    document, line = _member(b"word/document.xml", (_DOCUMENT % (key, customer, escape(str(status)), rows, listed)).encode(), len(_STYLED[0]))
    directory = _STYLED[1] + line
    return b"".join((_STYLED[0], document, directory, b"PK\5\6", struct.pack("<4H2IH", 0, 0, 2, 2, len(directory), len(_STYLED[0]) + len(document), 0)))


@register(_ITEMS + """
SELECT id, 0 AS pos, 'heading' AS kind, 'Order ' || id AS text, 1 AS level FROM o UNION ALL
SELECT id, 1, 'heading', 'Customer ' || o_custkey, 2 FROM o UNION ALL
SELECT id, 2, 'paragraph', 'It has status ' || o_orderstatus || '.', 0 FROM o UNION ALL
SELECT id, 3, 'table', '| part | quantity |' || chr(10) || '|---|---|' || chr(10) || body, 0 FROM t UNION ALL
SELECT id, 4, 'heading', 'Notes', 6 FROM o UNION ALL
SELECT id, 4 + row_number() OVER (PARTITION BY id ORDER BY n, part, supplier, quantity, flag)::INT, 'list_item', 'Part ' || part || ' from ' || supplier, 0 FROM i
""")
def docx_blocks(spark, sf_dir):
    """Orders as Word files: a title, a bold line, a bold sentence, a table, a deep heading and list items."""
    def run(batches):
        for batch in batches:
            keys, customers, states = (batch.column(c).to_pylist() for c in ("id", "o_custkey", "o_orderstatus"))
            held = batch.column("items")
            ends = np.cumsum(pc.list_value_length(held).to_numpy(zero_copy_only=False)).tolist()
            each = dict(zip(held.type.value_type.names, (x.to_pylist() for x in held.flatten().flatten())))
            made = [
                _word_file(*x, each["part"][a:b], each["quantity"][a:b], each["supplier"][a:b]) for *x, a, b in zip(keys, customers, states, [0, *ends], ends)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([f"{i}.docx" for i in keys]), pa.array(made, pa.binary())], ["path", "content"])

    return _loaded(_order_lines(spark, sf_dir).mapInArrow(run, "path string, content binary"))


@register(_ITEMS + """
SELECT id, 0 AS pos, 'heading' AS kind, 'Order ' || id AS text, 1 AS level FROM o UNION ALL
SELECT id, 1, 'table', '| part | quantity | |' || chr(10) || '|---|---|---|' || chr(10) || replace(body, ' |' || chr(10), ' |  |' || chr(10)) || '  |' , 0 FROM t UNION ALL
SELECT id, 1 + row_number() OVER (PARTITION BY id ORDER BY n, part, supplier, quantity, flag)::INT, 'list_item', 'Part ' || part || ' from ' || supplier, 0 FROM i
""".replace("| part | quantity | |", "| part | quantity |  |"))
def html_table_blocks(spark, sf_dir):
    """Orders as pages with unclosed cells, rows and list items, rows of unequal width, and parts that are dropped."""
    rows = F.array_join(F.transform("items", lambda x: F.format_string("<tr><td>%d<td> %d ", x["part"], x["quantity"])), "")
    listed = F.array_join(F.transform("items", lambda x: F.format_string("<li>Part <b>%d</b> from %d", x["part"], x["supplier"])), "")
    content = F.concat(
        F.lit("<html><head><title>t</title></head><body><div><nav>menu</div><h1>Order "), "id", F.lit("</h1><![if x]>loose<table><tr><td></td></tr><tr><th>part<th>quantity<th></tr>"), rows,
        F.lit("</table><script>no('<p>')</script><ul>"), listed, F.lit("</ul>"),
    )
    return _loaded(_order_lines(spark, sf_dir).select(F.concat(F.col("id").cast("string"), F.lit(".htm")).alias("path"), content.cast("binary").alias("content")))


# -- printed lines

_LINES = """
WITH l AS (SELECT p_brand AS document_id, p_partkey AS pos, 1 + p_partkey // 200 AS page_number, CASE WHEN p_partkey % 7 = 0 THEN '• ' ELSE '' END || p_name AS text, p_size::DOUBLE AS size,
  p_partkey % 11 = 0 AS bold, (p_partkey % 200) * 20.0 AS top, (p_partkey % 200) * 20.0 + CASE WHEN p_partkey % 3 = 0 THEN 19.0 ELSE 2.0 END AS bottom FROM part),
s AS (SELECT document_id, size, sum(length(text)) AS n, min(pos) AS first FROM l GROUP BY ALL),
b AS (SELECT document_id, arg_max(size, (n, -first)) AS body FROM s GROUP BY ALL),
h AS (SELECT l.*, length(text) <= 120 AND (text = 'cold widget' OR size >= 1.15 * body OR (bold AND length(text) <= 80)) AS heading FROM l JOIN b USING (document_id)),
v AS (SELECT document_id, size, least(dense_rank() OVER (PARTITION BY document_id ORDER BY size DESC), 6)::INT AS level FROM (SELECT DISTINCT document_id, size FROM h WHERE heading)),
w AS (SELECT h.*, lag(heading) OVER o AS ph, lag(page_number) OVER o AS pp, lag(bottom) OVER o AS pb FROM h WINDOW o AS (PARTITION BY document_id ORDER BY pos)),
g AS (SELECT *, sum(CASE WHEN heading OR coalesce(ph, true) OR text LIKE '• %' OR pp <> page_number OR top - pb > 0.45 * greatest(size, 1) THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY pos) AS block FROM w)
"""


@register(_LINES + """
SELECT g.document_id, min(pos) AS pos, arg_min(CASE WHEN heading THEN 'heading' WHEN text LIKE '• %' THEN 'list_item' ELSE 'paragraph' END, pos) AS kind,
  string_agg(CASE WHEN heading THEN text ELSE replace(text, '• ', '') END, ' ' ORDER BY pos) AS text, max(CASE WHEN heading THEN level ELSE 0 END)::INT AS level, arg_min(page_number, pos)::INT AS page_number
FROM g LEFT JOIN v USING (document_id, size) GROUP BY g.document_id, block
""")
def line_blocks(spark, sf_dir):
    """Parts as printed lines of a document per brand: headings by size, outline and weight, list items, wrapped and parted paragraphs."""
    k = F.col("p_partkey")
    top = (k % 200) * 20.0
    lines = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("document_id"), k.alias("pos"), (F.lit(1) + F.floor(k / 200)).cast("int").alias("page_number"), F.concat(F.when(k % 7 == 0, "• ").otherwise(""), "p_name").alias("text"),
        F.col("p_size").cast("double").alias("size"), (k % 11 == 0).alias("bold"), top.alias("top"), (top + F.when(k % 3 == 0, 19.0).otherwise(2.0)).alias("bottom"),
    )
    outline = table(spark, sf_dir, "part").select(F.col("p_brand").alias("document_id")).distinct().withColumn("text", F.lit("cold widget"))
    return layout.line_blocks(lines, outline).withColumn("level", F.coalesce("level", F.lit(0)))


@register("""
WITH s AS (SELECT p_brand, p_size, sum(length(p_name)) AS n, min(p_partkey) AS first FROM part GROUP BY ALL), b AS (SELECT p_brand, arg_max(p_size, (n, -first)) AS body FROM s GROUP BY p_brand)
SELECT p_partkey, least(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC), 6)::INT AS level FROM part JOIN b USING (p_brand) WHERE p_size >= 1.15 * body
""")
def level_rank(spark, sf_dir):
    """Parts as lines of a document per brand: the size with most characters is the body; larger ones are headings, ranked by size."""
    lines = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("document_id"), F.col("p_size").alias("size"), F.col("p_name").alias("text"), F.col("p_partkey").alias("pos"))
    heads = lines.join(layout.body_size(lines), "document_id").where(F.col("size") >= F.lit(1.15) * F.col("body_size"))
    return heads.join(layout.heading_levels(heads), ["document_id", "size"]).select("p_partkey", "level")


# Lines of 8 to 12 points 12.3 apart, 50 on a page; ascent 0.8 and descent 0.2 of the size.
_PRINTED = """
WITH n AS (SELECT 'c' || conv_id AS document_id, coalesce(length(text), 0) AS k, role || ' writes ' || coalesce(length(text), 0) || ' signs' AS name, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
  (8 + coalesce(length(text), 0) % 5)::DOUBLE AS size FROM conversations),
l AS (SELECT document_id, pos, (1 + pos // 50)::INT AS page_number, CASE WHEN k % 7 = 0 THEN '• ' ELSE '' END || name AS text, size, k % 11 = 0 AS bold, 40 + (pos % 50) * 12.3::DOUBLE AS base FROM n),
"""


def _printed(name: str, lines: list[dict]) -> bytes:
    """Lines (page, text, size, bold, base) as a PDF file; files of every second name have packed objects and a cross-reference stream."""
    packed, pages = int(name[-1:] or 0) % 2 == 1 if name[-1:].isdigit() else False, {}
    for x in lines:
        shown = x["text"].encode("cp1252", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)")
        words = shown.split(b" ")
        parts = b" ".join(b"(%s%s)" % (w, b" " if k % 2 and k + 1 < len(words) else b"") + (b" -300" if k % 2 == 0 and k + 1 < len(words) else b"") for k, w in enumerate(words))
        pages.setdefault(x["page"], []).append(b"/F%d %d Tf 1 0 0 1 50 %.1f Tm [%s] TJ" % (2 if x["bold"] else 1, x["size"], 792 - x["base"], parts))
    font = b"<< /Type /Font /Subtype /TrueType /BaseFont /%s /Encoding /WinAnsiEncoding /FirstChar 32 /Widths [%s] /FontDescriptor << /Ascent 800 /Descent -200 >> >>"
    objects: dict[int, bytes] = {
        1: b"<< /Type /Catalog /Pages 2 0 R /Outlines 5 0 R >>", 3: font % (b"Sans", b"500 " * 224), 4: font % (b"Sans-Bold", b"500 " * 224),
        5: b"<< /First 6 0 R >>", 6: b"<< /Title (cold  widget) /Parent 5 0 R >>",
    }
    kids = []
    for number in sorted(pages):
        body, at = b"BT " + b"\n".join(pages[number]) + b" ET", 7 + 2 * len(kids)
        data = zlib.compress(body) if packed else body
        objects[at] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (at + 1)
        objects[at + 1] = b"<< /Length %d %s>>\nstream\n%s\nendstream" % (len(data), b"/Filter /FlateDecode " if packed else b"", data)
        kids.append(b"%d 0 R" % at)
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] /MediaBox [0 0 612 792] /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> >>" % (len(kids), b" ".join(kids))
    out, places = bytearray(b"%PDF-1.7\n"), {}
    inner = [n for n in sorted(objects) if packed and not objects[n].endswith(b"endstream")]
    if inner:
        heads, bodies = [], b""
        for n in inner:
            heads.append(b"%d %d" % (n, len(bodies)))
            bodies += objects.pop(n) + b" "
        head, holder = b" ".join(heads) + b"\n", max([*objects, *inner]) + 1
        data = zlib.compress(head + bodies)
        objects[holder] = b"<< /Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (len(inner), len(head), len(data), data)
        places = {n: (2, holder, k) for k, n in enumerate(inner)}
    for n in sorted(objects):
        places[n] = (1, len(out), 0)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, objects[n])
    size, start = max(places) + 1, len(out)
    if packed:
        rows = b"".join(t.to_bytes(1, "big") + a.to_bytes(4, "big") + b.to_bytes(2, "big") for n in range(size) for t, a, b in [places.get(n, (0, 0, 0))])
        out += b"%d 0 obj\n<< /Type /XRef /Size %d /W [1 4 2] /Root 1 0 R /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (size, size, len(rows), rows)
    else:
        out += b"xref\n0 %d\n0000000000 65535 f \n" % size + b"".join(b"%010d 00000 n \n" % places[n][1] for n in range(1, size)) + b"trailer\n<< /Size %d /Root 1 0 R >>\n" % size
    return bytes(out + b"startxref\n%d\n%%%%EOF\n" % start)


@register(_PRINTED + _LINES[_LINES.index("s AS (SELECT"):].replace("top - pb", "base - 0.8 * size - pb").replace("lag(bottom) OVER o", "lag(base + 0.2 * size) OVER o") + """,
r AS (SELECT g.document_id, min(pos) AS first, arg_min(CASE WHEN heading THEN 'heading' WHEN text LIKE '• %' THEN 'list_item' ELSE 'paragraph' END, pos) AS kind,
  string_agg(CASE WHEN heading THEN text ELSE replace(text, '• ', '') END, ' ' ORDER BY pos) AS text, max(CASE WHEN heading THEN level ELSE 0 END)::INT AS level, arg_min(page_number, pos)::INT AS page_number
FROM g LEFT JOIN v USING (document_id, size) GROUP BY g.document_id, block)
SELECT document_id, (row_number() OVER (PARTITION BY document_id ORDER BY first) - 1)::INT AS pos, kind, text, level, page_number FROM r
""")
def pdf_blocks(spark, sf_dir):
    """Turns as lines of a PDF file per conversation, through the PDF loader and the layout."""
    k = F.coalesce(F.length("text"), F.lit(0))
    line = F.struct("turn", F.concat(F.when(k % 7 == 0, "• ").otherwise(""), "role", F.lit(" writes "), k.cast("string"), F.lit(" signs")).alias("text"), (8 + k % 5).alias("size"), (k % 11 == 0).alias("bold"))
    whole = table(spark, sf_dir, "conversations").groupBy(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("name")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    placed = F.transform("lines", lambda x, i: F.struct(F.floor(i / 50).cast("int").alias("page"), x["text"].alias("text"), x["size"].cast("int").alias("size"), x["bold"].alias("bold"), (F.lit(40) + i % 50 * 12.3).cast("double").alias("base")))

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            made = [_printed(*x) for x in zip(names, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([f"{n}.pdf" for n in names]), pa.array(made, pa.binary())], ["path", "content"])

    loaded = files.load(whole.select("name", placed.alias("lines")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").mapInArrow(run, "path string, content binary"))
    blocks = loaded.select(files.stem(F.col("path")).alias("document_id"), F.posexplode("blocks").alias("pos", "b"))
    return blocks.select("document_id", "pos", "b.kind", "b.text", F.coalesce("b.level", F.lit(0)).alias("level"), "b.page_number")


# -- vectors

@register("""
WITH d AS (SELECT doc_id, sha256(coalesce(text, '') || '|0') AS h FROM documents),
n AS (SELECT doc_id, list_transform(range(8), lambda k: ('0x' || h[k * 8 + 7 : k * 8 + 8] || h[k * 8 + 5 : k * 8 + 6] || h[k * 8 + 3 : k * 8 + 4] || h[k * 8 + 1 : k * 8 + 2])::BIGINT) AS u FROM d),
s AS (SELECT doc_id, list_transform(u, lambda x: (CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END) / 2147483648.0::DOUBLE) AS v FROM n)
SELECT doc_id, array_to_string(list_transform(v, lambda x: round((x / sqrt(list_sum(list_transform(v, lambda y: y * y))))::FLOAT::DOUBLE * 10000)::BIGINT), ',') AS vector FROM s
""")
def offline_vectors(spark, sf_dir):
    """Vectors of eight numbers from the texts' digests."""
    v = table(spark, sf_dir, "documents").select("doc_id", embed.embed(F.coalesce("text", F.lit("")), 8).alias("vector"))
    return v.select("doc_id", F.array_join(F.transform("vector", lambda x: F.round(x.cast("double") * 10000).cast("long").cast("string")), ",").alias("vector"))


@register("SELECT label AS document_id, count(*) AS n_bad FROM embeddings WHERE vec_id % 7 = 0 GROUP BY label")
def vector_check(spark, sf_dir):
    """Every seventh vector is cut: their labels are reported."""
    cut = F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
    v = table(spark, sf_dir, "embeddings").where("embedding is not null")
    return embed.check_vectors(v.select(F.col("label").alias("document_id"), cut.alias("embedding")), 64)


@register(f"""
WITH w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, md5(CASE WHEN {_TOKENS.format('len(ws)')} > 100 THEN array_to_string(ws[1:74], ' ') ELSE text END) AS fitted FROM w
""")
def fitted_input(spark, sf_dir):
    """Texts as a model of at most 100 tokens takes them."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(embed.fitted(F.col("text"), 100)).alias("fitted"))


@register("SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')[1:7], ' ') AS head FROM documents")
def truncate_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.truncate_tokens(F.col("text"), 10).alias("head"))


# -- the run: conversations as Markdown files, one heading and section per turn

def conversation_files(turns: DataFrame) -> DataFrame:
    sections = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("# Turn "), "turn", F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\n")).alias("part"))))
    body = F.array_join(F.transform(sections, lambda x: x["part"]), "\n")
    return turns.groupBy("conv_id").agg(body.cast("binary").alias("content")).select(F.concat(F.lit("corpus/c"), "conv_id", F.lit(".md")).alias("path"), "content")


_SETTINGS = ingest.Settings(dimensions=8)
_TURNS = f"""
WITH t AS (SELECT conv_id, turn, text, {_WORDS.format("coalesce(text, '')")} AS n, min(turn) OVER (PARTITION BY conv_id) AS first FROM conversations),
k AS (SELECT conv_id, turn, text, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ordinal, {_TOKENS.format('n + CASE WHEN turn = first THEN 2 ELSE 5 END')} AS tokens, first FROM t WHERE n > 0)
"""


@register(_TURNS + """
SELECT 'corpus/c' || conv_id || '.md' AS source_path, CASE WHEN count(k.turn) = 0 THEN 'failed' ELSE 'indexed' END AS outcome, 'C' || conv_id AS document_id,
  'Turn ' || min(t.first) AS document_name, 'markdown' AS document_type, count(k.turn) AS chunks_written, 0::BIGINT AS chunks_deleted, coalesce(sum(tokens), 0)::BIGINT AS embedding_tokens
FROM t LEFT JOIN k USING (conv_id, turn) GROUP BY conv_id
""")
def ingest_run(spark, sf_dir):
    """A first run over all conversations: a result per file."""
    done = ingest.run(conversation_files(table(spark, sf_dir, "conversations")), index.Snapshots(spark, shared_dir(spark, "index"), 8), _SETTINGS)
    return done.results.select("source_path", "outcome", "document_id", "document_name", "document_type", "chunks_written", "chunks_deleted", "embedding_tokens")


@register(_TURNS + """
, d AS (SELECT conv_id, conv_id % 3 = 0 AND count(*) > 2 AS changed, count(*) AS n_chunks, count(*) FILTER (WHERE ordinal < 2) AS kept, coalesce(sum(tokens) FILTER (WHERE ordinal < 2), 0) AS tokens FROM k GROUP BY conv_id)
SELECT count(*) AS docs_total, count(*) FILTER (WHERE changed) AS docs_indexed, count(*) FILTER (WHERE NOT changed) AS docs_skipped, 0::BIGINT AS docs_failed,
  coalesce(sum(CASE WHEN changed THEN kept END), 0)::BIGINT AS chunks_written, coalesce(sum(CASE WHEN changed THEN n_chunks - kept END), 0)::BIGINT AS chunks_deleted, coalesce(sum(CASE WHEN changed THEN tokens END), 0)::BIGINT AS embedding_tokens, 'succeeded' AS status,
  sum(CASE WHEN changed THEN kept ELSE n_chunks END)::BIGINT AS chunks_left FROM d
""")
def ingest_changed(spark, sf_dir):
    """A second run after every third conversation lost all but its first two turns: unchanged files are skipped, stale chunks go."""
    store, turns = index.Snapshots(spark, shared_dir(spark, "index"), 8), table(spark, sf_dir, "conversations")
    turns = turns.where(F.length(F.trim("text")) > 0)
    ingest.run(conversation_files(turns), store, _SETTINGS)
    nth = F.row_number().over(ingest.Window.partitionBy("conv_id").orderBy("turn"))
    again = ingest.run(conversation_files(turns.withColumn("nth", nth).where("conv_id % 3 != 0 or nth <= 2")), store, _SETTINGS)
    return again.report().crossJoin(F.broadcast(store.read().agg(F.count("*").alias("chunks_left"))))  # one row


@register(_TURNS + """
SELECT 'C' || conv_id || '-' || format('{:04d}', ordinal) AS chunk_id, 'C' || conv_id AS document_id, 'Turn ' || first AS document_name, 'Turn ' || turn AS section, 'Turn ' || turn AS section_path,
  'file://corpus/c' || conv_id || '.md' AS source_uri, ordinal::INT AS ordinal, tokens AS token_count,
  md5(array_to_string(list_filter(list_transform(string_split_regex(text, '\\n\\s*\\n'), lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))), lambda p: p <> ''), chr(10) || chr(10))) AS content, 8 AS n_vector FROM k
""")
def index_rows(spark, sf_dir):
    """The rows of the index after a first run."""
    store = index.Snapshots(spark, shared_dir(spark, "index"), 8)
    ingest.run(conversation_files(table(spark, sf_dir, "conversations")), store, _SETTINGS)
    return store.read().select("chunk_id", "document_id", "document_name", "section", "section_path", "source_uri", "ordinal", "token_count", F.md5("content").alias("content"), F.size("content_vector").alias("n_vector"))


@register(_TURNS + ", c AS (SELECT 'C' || conv_id AS document_id, count(*) AS chunk_count FROM k GROUP BY conv_id) SELECT document_id, chunk_count, 'indexed' AS status FROM c")
def admin_documents(spark, sf_dir):
    """Documents with their chunk counts and status, as a dry run would leave them."""
    empty = spark.createDataFrame([], index.DDL)
    done = ingest.plan(conversation_files(table(spark, sf_dir, "conversations")), empty, _SETTINGS, dry_run=True)
    counts = index.chunk_counts(done.chunks)
    return done.results.join(counts, "document_id").select("document_id", "chunk_count", F.col("outcome").alias("status"))


@register(_TURNS + """
SELECT 'document_id' AS facet, 'C' || conv_id AS value, count(*) AS n FROM k GROUP BY conv_id UNION ALL SELECT 'document_type', 'markdown', count(*) FROM k HAVING count(*) > 0
""")
def index_facets(spark, sf_dir):
    rows = ingest.plan(conversation_files(table(spark, sf_dir, "conversations")), spark.createDataFrame([], index.DDL), _SETTINGS, dry_run=True).chunks
    return index.facets(rows, "document_id").union(index.facets(rows, "document_type"))


@register("""
SELECT o_orderkey AS id, sha256('ORD-' || o_orderkey || chr(10) || 'heading:1:Order ' || o_orderkey || chr(10) || 'heading:2:' || o_orderpriority || chr(10) || 'paragraph:0:Customer ' || o_custkey) AS content_hash FROM orders
""")
def document_hash(spark, sf_dir):
    """Digests over kind, level and text; an empty block doesn't count, and a heading without a level has level 2."""
    block = lambda pos, kind, text, level=None: F.struct(F.lit(pos).alias("pos"), F.lit(kind).alias("kind"), text.alias("text"), F.lit(level).cast("int").alias("level"))
    blocks = F.array(block(0, "heading", F.concat(F.lit("Order "), "o_orderkey"), 1), block(1, "paragraph", F.lit(" \n ")), block(2, "heading", F.col("o_orderpriority")), block(3, "paragraph", F.concat(F.lit(" Customer  "), "o_custkey")))
    rows = normalize.clean_blocks(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), F.explode(blocks).alias("b")).select("document_id", "b.*"))
    kept = rows.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "text", "level"))).alias("blocks"))
    return kept.select(F.col("document_id").alias("id"), normalize.document_hash(F.concat(F.lit("ORD-"), "document_id"), F.col("blocks")).alias("content_hash"))


@register("""
SELECT s_suppkey, CASE WHEN lower(r_name) = lower(n_name) THEN r_name ELSE r_name || ' > ' || n_name END || ' > ' || s_name AS breadcrumb, (floor((len(string_split(r_name, ' ')) + len(string_split(n_name, ' ')) + len(string_split(s_name, ' ')) + 2) * 1.35::DOUBLE))::INT AS overhead
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def breadcrumbs(spark, sf_dir):
    """Suppliers below their nation, in a document named after the region; and what the line costs."""
    r, n, s = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    line = T.breadcrumb(F.col("r_name"), F.array(F.lower("r_name"), "n_name", "s_name"), chunk.MAXIMUM)
    return rows.select("s_suppkey", line.alias("breadcrumb"), T.token_estimate(F.concat(line, F.lit("\n\n"))).alias("overhead"))
