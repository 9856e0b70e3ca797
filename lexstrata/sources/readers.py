"""Readers: regulation files, bulk volumes, notice records, configuration tables. All give DataFrames and read only
through Spark, so any store that Spark reaches will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import regxml
from ..functions.arrow import flat_map
from ..functions.model import ROW_SCHEMA, to_rows

NOTICE_SCHEMA = (
    "document_number string, publication_date date, effective_on date, comments_close_on date, abstract string, action string, agency_names array<string>, "
    "cfr_references array<struct<title:int, part:int>>, citation string, dates string, start_page int, end_page int, volume int, type string, html_url string, full_text_xml_url string, regulation_id_numbers array<string>"
)


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """path, text, digest (SHA-256 of the bytes) of each file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.decode("content", "UTF-8").alias("text"), F.sha2("content", 256).alias("digest"))


def regulation_trees(files: DataFrame) -> DataFrame:
    """Node tables of regulation files (tree = path): XML by its elements; anything else is refused, as its format is not known."""

    def build(text):
        if not (text or "").lstrip().startswith("<"):
            raise ValueError("a regulation has to be XML; for plain text use text_trees()")
        yield from to_rows(regxml.build_tree(text))

    return flat_map(files.withColumn("tree", F.col("path")).select("tree", "text"), ["tree"], ["text"], build, ROW_SCHEMA)


def text_trees(files: DataFrame) -> DataFrame:
    """Node tables of plain-text regulations."""
    return flat_map(files.withColumn("tree", F.col("path")).select("tree", "text"), ["tree"], ["text"], lambda t: to_rows(regxml.build_text_tree(t or "")), ROW_SCHEMA)


def xml_elements(files: DataFrame) -> DataFrame:
    """Elements of XML files in document order, mixed content kept: path, elem_id, parent_id, ord, tag, attrs, text, tail."""
    return flat_map(files, ["path"], ["text"], lambda t: ((i, a, o, tag, list(at.items()), x, y) for i, a, o, tag, at, x, y in regxml.elements(t)), "elem_id int, parent_id int, ord int, tag string, attrs map<string,string>, text string, tail string")


def notices(spark: SparkSession, path: str, title: int | None = None, part: int | None = None, final_only: bool = False, until: str | None = None, most: int | None = None) -> DataFrame:
    """Notice records (JSON lines) with the filters of a search: by title and part, final rules, effective until a date; the oldest first; all of them, or `most` where a page's size is asked for."""
    n = spark.read.schema(NOTICE_SCHEMA).json(path)
    if title is not None:
        n = n.where(F.exists("cfr_references", lambda r: (r["title"] == title) & (F.lit(part is None) | (r["part"] == part))))
    if final_only:
        n = n.where("type = 'Rule'")
    if until is not None:
        n = n.where(F.col("effective_on") <= F.lit(until).cast("date"))
    n = n.orderBy("publication_date", "document_number")
    return n if most is None else n.limit(most)


def first_notice_and_text(notices_: DataFrame, files: DataFrame) -> DataFrame:
    """The oldest notice whose file is there, with its text: one row. files: (path, text), named by document number."""
    named = files.select(F.regexp_extract("path", r"([^/]+?)(?:_\d{8})?\.\w+$", 1).alias("document_number"), "text")
    return notices_.join(named, "document_number").orderBy("publication_date", "document_number").limit(1)


def document_number(frdoc: DataFrame, rules: DataFrame) -> DataFrame:
    """The number that a document names itself ([FR Doc. X), else that of the oldest final rule effective on or before its date (null
    if there is none). frdoc: (tree, frdoc, original_date), a row for each of them; rules: notices."""
    own = F.nullif(F.regexp_extract("frdoc", r"\[?FR Doc\.? ([\w-]+)", 1), F.lit(""))
    day = lambda c: F.col(c).cast("date").alias("_day")
    oldest = F.min(F.struct(F.col("publication_date").alias("p"), F.col("document_number").alias("n")))
    # One row a calendar day: the running minimum over days is small whatever the number of rules and documents.
    rule = rules.where("type = 'Rule' and effective_on is not null").groupBy(day("effective_on")).agg(oldest.alias("_oldest"))
    asked = frdoc.select(day("original_date")).where("_day is not null").distinct()
    days = rule.withColumn("_asked", F.lit(False)).unionByName(asked.select("_day", F.lit(None).cast(rule.schema["_oldest"].dataType).alias("_oldest"), F.lit(True).alias("_asked")))
    upto = days.withColumn("_oldest", F.min("_oldest").over(W.orderBy("_day"))).where("_asked").select("_day", F.col("_oldest.n").alias("_number"))
    return frdoc.withColumn("_day", F.col("original_date").cast("date")).join(F.broadcast(upto), "_day", "left").select("tree", F.coalesce(own, "_number").alias("document_number"))


def with_macros(files: DataFrame, macros: list) -> DataFrame:
    """files (text) with replacements (old, new) made in every text, in order."""
    for old, new in macros:
        files = files.withColumn("text", F.replace("text", F.lit(old), F.lit(new)))
    return files


def volumes(spark: SparkSession, path: str) -> DataFrame:
    """Bulk volumes with the range of parts that they declare: path, low, high (null: open)."""
    f = whole_files(spark, path)
    declared = F.regexp_extract("text", r"<PARTS>[^<]*?(\d+)", 1).cast("int")
    end = F.nullif(F.regexp_extract("text", r"<PARTS>[^<]*?\d+\s*(?:to|-|–)\s*(\d+)", 1), F.lit("")).cast("int")
    return f.select("path", "text", declared.alias("low"), F.when(F.col("text").rlike(r"<PARTS>[^<]*[Tt]o [Ee]nd"), None).otherwise(F.coalesce(end, declared)).alias("high"))


def volume_of(vols: DataFrame, part: int) -> DataFrame:
    """The first volume that should hold a part."""
    return vols.where((F.col("low") <= part) & (F.col("high").isNull() | (F.col("high") >= part))).orderBy("path").limit(1)


def local_files(wanted: DataFrame, present: DataFrame, url: str = "url") -> DataFrame:
    """For each url the local copies: the file of its name, else files that begin with it (one for each effective date)."""
    name = F.regexp_extract(url, r"([^/]+?)(?:\.\w+)?$", 1)
    own = present.withColumn("_name", F.regexp_extract("path", r"([^/]+?)(?:\.\w+)?$", 1)).withColumn("_stem", F.regexp_replace("_name", r"_\d{8}$", ""))
    met = wanted.withColumn("_stem", name).join(own, "_stem", "left")
    return met.withColumn("exact", F.col("_name") == F.col("_stem")).drop("_stem", "_name")


def config_table(spark: SparkSession, rows: dict[str, str], key: str, value: str) -> DataFrame:
    """A small table of settings, for joins that put it over other sources."""
    return spark.createDataFrame(sorted(rows.items()), f"{key} string, {value} string")
