"""Sources and sinks: page manifests, page images, documents' words, and results as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "images array<struct<id: int, path: string>>"
WORDS = "pdf_texts array<struct<text: string, bbox: array<double>>>, pdf_size array<double>"


def manifests(spark: SparkSession, *paths: str) -> DataFrame:
    """(page_id, path, manifest) of manifest files; a missing or null list of images gives no rows."""
    rows = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).json(list(paths)).select(F.input_file_name().alias("manifest"), F.explode("images").alias("i"))
    return rows.select(F.col("i.id").cast("long").alias("page_id"), F.col("i.path").alias("path"), "manifest")


def write_manifests(pages: DataFrame, path: str) -> None:
    """Pages (manifest, id, path) as one manifest file for each value of ``manifest``, in folders below ``path``."""
    image = F.struct("id", "path")
    pages.groupBy("manifest").agg(F.array_sort(F.collect_list(image)).alias("images")).write.partitionBy("manifest").json(path)


def document_of(path: Column) -> Column:
    """The folder that holds a page's image; null where there is none."""
    parts = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda p: (p != "") & (p != "."))
    return F.try_element_at(parts, F.lit(-2))


def page_images(spark: SparkSession, pages: DataFrame, root: str, pattern: str = "*.png") -> DataFrame:
    """The images below ``root`` as (path, content); reading fails on a path of ``pages`` that has no image once it is used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    files = files.select(F.regexp_replace("path", r"^[a-z]+:/+", "/").alias("file"), "content")
    missing = F.when(F.col("content").isNull(), F.raise_error(F.concat(F.lit("no such image: "), F.col("path")))).otherwise(F.col("content"))
    return pages.join(files, F.regexp_replace("path", r"^[a-z]+:/+", "/") == F.col("file"), "left").drop("file").withColumn("content", missing)


def page_words(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """(document, page_id, word_id, text, x0, top, x1, bottom, pdf_w, pdf_h) of files ``<document>/<document>_page<id>.pdf.json``.

    lines: files of many pages instead, one a line, which name document and page (:func:`write_page_words`).
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if lines:
        named = reader.schema(f"document string, page_id long, {WORDS}").json(root)
    else:
        files = reader.schema(WORDS).option("multiLine", True).option("pathGlobFilter", "*.pdf.json").json(root).withColumn("file", F.input_file_name())
        name = r"/([^/]+)/\1_page(\d+)\.pdf\.json$"
        named = files.where(F.col("file").rlike(name)).withColumns({"document": F.regexp_extract("file", name, 1), "page_id": F.regexp_extract("file", name, 2).cast("long")})
    rows = named.select("document", "page_id", F.col("pdf_size")[0].alias("pdf_w"), F.col("pdf_size")[1].alias("pdf_h"), F.posexplode("pdf_texts").alias("word_id", "t"))
    return rows.select("document", "page_id", "word_id", F.col("t.text").alias("text"), *[F.col("t.bbox")[i].alias(c) for i, c in enumerate(("x0", "top", "x1", "bottom"))], "pdf_w", "pdf_h")


def write_page_words(words: DataFrame, path: str) -> None:
    """Words (document, page_id, word_id, text, x0, top, x1, bottom, pdf_w, pdf_h) as JSON, a line a page: one file would be too small."""
    word = F.struct("word_id", F.struct("text", F.array("x0", "top", "x1", "bottom").alias("bbox")).alias("t"))
    pages = words.groupBy("document", "page_id").agg(F.array_sort(F.collect_list(word)).alias("w"), F.first("pdf_w").alias("pdf_w"), F.first("pdf_h").alias("pdf_h"))
    pages.select("document", "page_id", F.col("w.t").alias("pdf_texts"), F.array("pdf_w", "pdf_h").alias("pdf_size")).write.json(path)


def scanned_documents(page_texts: DataFrame, document: str = "document", text: str = "text", least: int = 10) -> DataFrame:
    """(document, scanned): whether no page has more than ``least`` characters of text; a document without any text is scanned."""
    has = F.length(F.trim(F.col(text))) > least
    return page_texts.groupBy(document).agg((~F.coalesce(F.bool_or(has), F.lit(False))).alias("scanned"))


def write_results(results: DataFrame, path: str) -> None:
    """Page results as JSON lines."""
    results.write.mode("errorifexists").json(path)
