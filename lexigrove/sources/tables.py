"""Reading tables and bundles; every schema is stated, none inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a bundle's manifest, one row per output file.
MANIFEST = (
    "entry_id string, kind string, title string, output_path string, flat_output_path string, rag_output_path string, spatial_output_path string, "
    "context_path string, book_page_start string, book_page_end string, pdf_page_start int, pdf_page_end int, complex_pdf_pages array<int>, child_ids array<string>"
)
#: Columns of positioned lines, what a page scan yields.
PAGE_LINES = "book_id string, pdf_page int, line_no int, text string, x0 double, y0 double, x1 double, y1 double, size double"
#: Pages with their regions, one file per entry.
SIDECAR = (
    "entry_id string, pages array<struct<page_label:string,pdf_page:int,slice_min_y:double,slice_max_y:double,layout_kind:string,content_mode:string,"
    "complex:boolean,reasons:array<string>,layout_text:string,regions:array<struct<region_id:string,role:string,zone:string,"
    "bbox:struct<x0:double,y0:double,x1:double,y1:double>,raw_text:string,semantic_text:string>>>>"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_manifest(spark: SparkSession, bundle: str) -> DataFrame:
    """The manifest of a bundle's metadata file, in order."""
    whole = spark.read.schema(f"file_manifest array<struct<{MANIFEST.replace(' ', ':').replace(',:', ',')}>>").json(f"{bundle}/metadata.json", multiLine=True, mode="FAILFAST")
    return whole.select(F.posexplode("file_manifest").alias("manifest_ord", "x")).select("manifest_ord", "x.*")


def read_texts(spark: SparkSession, bundle: str, pattern: str = "*.md") -> DataFrame:
    """(path, text) of a bundle's files, paths relative to it."""
    files = spark.read.text(bundle, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    full = F.col("_metadata.file_path")
    return files.select(F.regexp_replace(full, r"^.*?" + bundle.rstrip("/").rpartition("/")[2] + "/", "").alias("path"), F.col("value").alias("text"))


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """Regions of all spatial sidecars, exploded."""
    sidecars = spark.read.schema(SIDECAR).json(folder, multiLine=True, recursiveFileLookup=True, mode="FAILFAST")
    pages = sidecars.select("entry_id", F.posexplode("pages").alias("page_ord", "p"))
    return pages.select("entry_id", "page_ord", "p.*").select("*", F.posexplode_outer("regions").alias("region_ord", "region")).drop("regions")


def manifest_texts(manifest: DataFrame, texts: DataFrame, column: str = "output_path") -> DataFrame:
    """Manifest rows with the text of their file, null where it is missing; a path is read once."""
    return manifest.join(texts.dropDuplicates(["path"]), F.col(column) == F.col("path"), "left").drop("path")


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of the files of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha256"))
