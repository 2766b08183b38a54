"""Files as documents: discovery, routing by extension, loading, and the corpus lists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .docx import parse_docx
from ..errors import ConfigurationError, DocumentParseError, EmbeddingError, IndexingError, IngestionError, UnsupportedFormatError  # noqa: F401  (taken from here)
from ..functions.paths import materialize
from ..operators import layout
from .html import BLOCK_DDL, block_array, parse_html
from .markdown import parse_markdown
from .pdf import PdfError, read_pdf

# File names that are never documents.
SKIPPED = [".DS_Store", "Thumbs.db", "README.md", "readme.md"]


def _html(content: bytes):
    return parse_html(content.decode("utf-8", "replace"))


def _markdown(content: bytes):
    return parse_markdown(content.decode("utf-8"))


@dataclass
class Printed:
    """What a parser of a paged format gives instead of blocks: lines for ``operators.layout``, and the outline's titles."""

    lines: list[dict]
    outline: list[str]


def _pdf(content: bytes):
    lines, outline, pages = read_pdf(content)
    return Printed(lines, outline), None, {"page_count": str(pages)}


#: Extension to (document type, parser of bytes into blocks or Printed, title hint and hints); ``register`` adds to it.
LOADERS: dict[str, tuple[str, Callable]] = {}


def register(document_type: str, extensions: list[str], parse: Callable) -> None:
    LOADERS.update({e.lower(): (document_type, parse) for e in extensions})


register("html", [".html", ".htm", ".xhtml"], _html)
register("markdown", [".md", ".markdown"], _markdown)
register("docx", [".docx"], parse_docx)
register("pdf", [".pdf"], _pdf)
#: Types whose parsers give Printed.
PRINTED = {"pdf"}


def supported_extensions() -> list[str]:
    return sorted(LOADERS)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def document_type(path: Column) -> Column:
    """The type that an extension names, null for others."""
    types = F.create_map(*[F.lit(x) for e, (t, _) in sorted(LOADERS.items()) for x in (e, t)])
    return F.try_element_at(types, extension(path))


def wanted(path: Column) -> Column:
    """Files of a folder that are documents: a known extension, not a name of SKIPPED, no leading dot."""
    name = file_name(path)
    return extension(path).isin(supported_extensions()) & ~name.isin(SKIPPED) & ~name.startswith(".")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of the documents below ``root``; a single file is taken whatever its name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    single = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isFile()
    return files.select("path", "content") if single else files.where(wanted(F.col("path"))).select("path", "content")


LINE_TYPE = pa.list_(pa.struct([("page_number", pa.int32()), ("text", pa.string()), ("size", pa.float64()), ("bold", pa.bool_()), ("top", pa.float64()), ("bottom", pa.float64())]))
LINE_DDL = "array<struct<page_number:int,text:string,size:double,bold:boolean,top:double,bottom:double>>"


def load(files: DataFrame, paged: bool | None = None) -> DataFrame:
    """(path, document_type, title_hint, hints, blocks, error_class, error) for rows (path, content).

    Every file is parsed by the loader of its extension, in one pass without a
    shuffle.  Paged formats give printed lines, and Spark makes their blocks
    from them; only then the parsed rows are written once.  A file that can't be
    read, or holds nothing, has no blocks and says why; it doesn't stop the
    others.  Null contents count as empty.  ``paged`` says whether there are
    files of such formats; without it, all paths are looked at first, for
    which files that are made on the way would be made twice.
    """
    read = _parsed(files)
    if paged is None:
        paged = not files.where(document_type(F.col("path")).isin(sorted(PRINTED))).select("path").isEmpty()
    return laid(read) if paged else read.drop("lines", "outline")


def laid(read: DataFrame) -> DataFrame:
    """Parsed rows with the blocks of their printed lines; the rows are written once."""
    read = materialize(read.withColumn("row", F.monotonically_increasing_id()), "read")
    key = F.col("row").alias("document_id")
    lines = read.select(key, F.posexplode("lines").alias("pos", "line")).select("document_id", "pos", "line.*")
    blocks = layout.line_blocks(lines, read.select(key, F.explode("outline").alias("text")))
    block = F.struct("pos", "kind", "text", "level", "page_number")
    each = blocks.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(block)), lambda b: b.dropFields("pos")).alias("laid"))
    title = F.get(F.filter("laid", lambda b: b["level"] == 1), F.lit(0))["text"]
    return read.join(each, F.col("row") == F.col("document_id"), "left").select(
        "path", "document_type", F.coalesce("title_hint", title).alias("title_hint"), "hints", F.coalesce("laid", "blocks").alias("blocks"), "error_class", "error"
    )


PARSED = f"path string, document_type string, title_hint string, hints map<string,string>, blocks {BLOCK_DDL}, error_class string, error string, lines {LINE_DDL}, outline array<string>"


def parse_file(path: str | None, content: bytes | None, loaders: dict[str, tuple[str, Callable]]) -> tuple:
    """One file as the columns of PARSED behind its path."""
    name = (path or "").rsplit("/", 1)[-1]
    ending = "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if ending not in loaders:
        return None, None, [], [], UnsupportedFormatError.__name__, f"no loader for '{ending}': {name}", None, None
    kind, parse = loaders[ending]
    try:
        blocks, title, hints = parse(content or b"")
    except PdfError as e:
        return kind, None, [], [], DocumentParseError.__name__, f"cannot read {kind} {name}: {e}", None, None
    except Exception as e:  # parsers meet arbitrary bytes; the document fails, not the task
        return kind, None, [], [], DocumentParseError.__name__, f"cannot read {kind} {name}: {type(e).__name__}", None, None
    if isinstance(blocks, Printed):
        return kind, title, list(hints.items()), [], None, None, blocks.lines, blocks.outline
    if not blocks:
        return kind, title, list(hints.items()), [], DocumentParseError.__name__, f"{kind} {name} produced no content", None, None
    return kind, title, list(hints.items()), blocks, None, None, None, None


def parsed_batch(paths: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), None, pa.string(), pa.string(), LINE_TYPE, pa.list_(pa.string())]
    names = ["path", "document_type", "title_hint", "hints", "blocks", "error_class", "error", "lines", "outline"]
    columns = list(zip(*rows)) or [()] * 8
    return pa.RecordBatch.from_arrays([paths, *(pa.array(list(c), t) if t else block_array(list(c)) for c, t in zip(columns, types))], names)


def _parsed(files: DataFrame) -> DataFrame:
    loaders = dict(LOADERS)

    def run(batches):
        for batch in batches:
            yield parsed_batch(batch.column(0), [parse_file(p, c, loaders) for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])

    return files.select("path", "content").mapInArrow(run, PARSED)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The corpus list: one row per expected document."""
    columns = "document_id title format department category version effective_date status".split()
    return spark.read.schema(", ".join(f"{c} string" for c in columns)).option("multiLine", "true").json(path)


def questions(spark: SparkSession, path: str) -> DataFrame:
    """The evaluation set; a question that no document answers has an empty source list."""
    rows = spark.read.schema("id string, question string, source_documents array<string>, expected_answer string").option("multiLine", "true").json(path)
    return rows.withColumn("source_documents", F.filter("source_documents", lambda d: d != "NONE"))
