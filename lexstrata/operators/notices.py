"""Notices as tables: effective dates after delays, the versions that notices make, and what applies as of a version.

A notice's place in time is (effective_on, publication_date). Dates are ISO strings or dates; both compare in order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import notices as N
from ..functions.arrow import flat_map
from ..plans.checkpoint import shared_root

#: Pages of a bucket that citations meet notices in.
PAGES = 64
#: Cited pages that are sent to all tasks; more are shuffled.
SENT = 400_000
TIME = ("effective_on", "publication_date")


def delay_citations(notices: DataFrame) -> DataFrame:
    """What final rules say about the dates of others, a row for each cited page: document_number, publication_date, sentence (its
    place in `dates`), citation (its place in the sentence), volume, page, changed_to.

    notices: document_number, publication_date, type, dates (the text on dates; null and empty ones say nothing)."""

    def read(dates):
        for i, sentence in enumerate((dates or "").split(".")):
            cited, to = N.delays(sentence)
            yield from ((i, j, volume, page, to) for j, (volume, page) in enumerate(cited))

    rules = notices.where("type = 'Rule' and dates is not null")
    return flat_map(rules, ["document_number", "publication_date"], ["dates"], read, "sentence int, citation int, volume int, page int, changed_to string")


def last_said(notices: DataFrame) -> DataFrame:
    """The last that is said of each cited page: volume, page, said (published, by, sentence, citation, changed_to; in this order)."""
    said = F.struct(F.col("publication_date").alias("published"), F.col("document_number").alias("by"), "sentence", "citation", "changed_to")
    return delay_citations(notices).groupBy("volume", "page").agg(F.max(said).alias("said"))


def delayed(notices: DataFrame, pages: int = PAGES) -> DataFrame:
    """notices with the effective dates that later rules give them: of several, the one published last (then the larger number,
    then the later sentence). A notice is meant if a cited page of its volume lies within its pages, ends included.

    notices: as for delay_citations, with volume, start_page, end_page and effective_on; all columns stay. A delay sets a date and
    reads none, so the order in which delays apply is the order of publication, whatever they do to one another. Notices
    without dates get one if they are named. A page that no notice holds and notices without pages change nothing.

    Of what is said of a page only the last counts, so citations are brought down to one a page first, and these to arrays by
    buckets of pages; a notice meets the buckets that it touches and takes the last of those within its pages. So there is one row for
    each notice and bucket, however many citations and notices share a page.
    """
    kind = notices.schema["effective_on"].dataType
    best = last_said(notices)
    path = f"{shared_root(notices.sparkSession)}/delays-{uuid.uuid4().hex[:12]}"
    best.write.parquet(path)
    best = notices.sparkSession.read.schema(best.schema).parquet(path)
    cells = best.groupBy("volume", F.floor(F.col("page") / pages).cast("long").alias("_b")).agg(F.collect_list(F.struct("page", "said")).alias("_cell"))
    held = notices.where("volume is not null and start_page <= end_page").select("document_number", F.col("volume").cast("int").alias("volume"), "start_page", "end_page")
    touched = held.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start_page") / pages).cast("long"), F.floor(F.col("end_page") / pages).cast("long"))))
    met = touched.join(F.broadcast(cells) if best.count() <= SENT else cells, ["volume", "_b"])
    inside = F.filter("_cell", lambda x: x["page"].between(F.col("start_page"), F.col("end_page")))
    met = met.select("document_number", F.array_max(F.transform(inside, lambda x: x["said"])).alias("said")).where("said is not null")
    last = met.groupBy(F.col("document_number").alias("_number")).agg(F.max("said").alias("said")).select("_number", F.col("said.changed_to").cast(kind).alias("_to"))
    out = notices.join(last, F.col("document_number") == F.col("_number"), "left")
    return out.withColumn("effective_on", F.coalesce("_to", "effective_on")).select(*notices.columns)


def version_table(changes: DataFrame) -> DataFrame:
    """The versions of every tree: tree, version, version_no, effective_on, publication_date. Version '' (number 0, without dates) is
    the first; every notice that changes the tree makes one more, in order of time, then number."""
    made = changes.where("effective_on is not null").groupBy("tree", F.col("document_number").cast("string").alias("version")).agg(F.min(F.struct(*TIME)).alias("t")).select("tree", "version", "t.*")
    numbered = made.withColumn("version_no", F.row_number().over(W.partitionBy("tree").orderBy(*TIME, "version")))
    none = [F.lit(None).cast(made.schema[c].dataType).alias(c) for c in TIME]
    first = changes.select("tree").distinct().select("tree", F.lit("").alias("version"), *none, F.lit(0).alias("version_no"))
    return numbered.unionByName(first).select("tree", "version", "version_no", *TIME)


def applies(notice: str, version: str):
    """The condition that a notice applies to a version, for the names of two structs (number, effective_on, publication_date): it is
    the version's own, or takes effect earlier, or on the same day and was published earlier. Without a date it does not."""
    earlier = f"{notice}.effective_on < {version}.effective_on or ({notice}.effective_on = {version}.effective_on and {notice}.publication_date < {version}.publication_date)"
    return F.expr(f"{notice}.number = {version}.number or coalesce({earlier}, false)")


def notice_struct(number: str):
    return F.struct(F.col(number).cast("string").alias("number"), *TIME)


def applicable_to(versions: DataFrame, notices: DataFrame) -> DataFrame:
    """The notices of each version: tree, version, applicable (position by time, from 1), document_number.

    versions: see version_table. notices: tree, document_number, effective_on, publication_date. The result is as large as
    what it lists; layers join their rows with versions by label instead (see layers.analyses) and need no such list."""
    v = versions.select("tree", "version", notice_struct("version").alias("v"))
    n = notices.select("tree", "document_number", notice_struct("document_number").alias("n"))
    met = v.join(n, "tree").where(applies("n", "v"))
    order = W.partitionBy("tree", "version").orderBy("n.effective_on", "n.publication_date", "n.number")
    return met.select("tree", "version", F.row_number().over(order).alias("applicable"), "document_number")


def applicable_counts(versions: DataFrame, notices: DataFrame) -> DataFrame:
    """How many notices apply to each version: tree, version, n_applicable. One window over versions and notices in order of time: a
    running count, so no pair of a version and a notice is made."""
    events = notices.select("tree", *TIME, F.lit(None).cast("string").alias("version"), F.lit(1).alias("n"), F.lit(None).cast("boolean").alias("own"))
    own = versions.join(notices.select("tree", F.col("document_number").cast("string").alias("version"), F.lit(True).alias("own")).distinct(), ["tree", "version"], "left")
    events = events.where("effective_on is not null").unionByName(own.select("tree", *TIME, "version", F.lit(0).alias("n"), "own"))
    # rows of the same time are one step of a range frame; those before it count
    w = W.partitionBy("tree").orderBy(F.struct(*TIME)).rangeBetween(W.unboundedPreceding, W.currentRow)
    here = W.partitionBy("tree", F.struct(*TIME))
    before = F.sum("n").over(w) - F.sum("n").over(here)
    counted = events.withColumn("before", before).where("version is not null")
    return counted.select("tree", "version", (F.when(F.col("effective_on").isNull(), 0).otherwise(F.col("before")) + F.coalesce(F.col("own").cast("int"), F.lit(0))).cast("long").alias("n_applicable"))
