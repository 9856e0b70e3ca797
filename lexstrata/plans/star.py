"""The driver's tables as documents: the star schema as a label tree, events as a change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tree import label_id

ACTIONS = {"signup": "POST", "click": "PUT", "purchase": "PUT", "error": "DELETE", "view": "KEEP"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nodes(spark: SparkSession, sf_dir: str, depth: int = 3) -> DataFrame:
    """region > nation > customer > order as nodes: tree, path, label, label_id, depth, title, text."""
    t = lambda n: table(spark, sf_dir, n)
    key = lambda c: F.col(c).cast("long")
    levels = [t("region").select(F.array(key("r_regionkey")).alias("path"), F.col("r_name").alias("title"), F.col("r_name").alias("text"))]
    nation = t("nation").select("n_regionkey", "n_nationkey", "n_name")
    levels.append(nation.select(F.array(key("n_regionkey"), key("n_nationkey")).alias("path"), F.col("n_name").alias("title"), F.col("n_name").alias("text")))
    customer = t("customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    levels.append(customer.select(F.array(key("n_regionkey"), key("n_nationkey"), key("c_custkey")).alias("path"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("text")))
    if depth > 3:
        orders = t("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        levels.append(orders.select(F.array(key("n_regionkey"), key("n_nationkey"), key("c_custkey"), key("o_orderkey")).alias("path"), F.col("o_orderpriority").alias("title"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("text")))
    out = reduce(DataFrame.unionByName, [level.withColumn("depth", F.lit(d)) for d, level in enumerate(levels[:depth], 1)])  # a constant, so that a level is read without the others
    label = F.transform("path", lambda x: x.cast("string"))
    return out.select(F.col("path")[0].alias("tree"), "path", label.alias("label"), label_id(label).alias("label_id"), "depth", "title", "text")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as changes: key (user_id, k), ts, event_id, action, value in cents."""
    events = table(spark, sf_dir, "events")
    action = reduce(lambda a, e: a.when(F.col("event_type") == e[0], e[1]), ACTIONS.items(), F.when(F.lit(False), ""))
    return events.select("user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "ts", "event_id", "event_type", action.alias("action"), F.round(F.col("value") * 100).cast("long").alias("cents"))


def part_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as paragraphs 100-<part>-<a..e>, with markers, emphasised terms, subscripts, dashes, fences and pictures."""
    p = table(spark, sf_dir, "part")
    letter = F.expr("substr('abcde', cast(p_size % 5 + 1 as int), 1)")
    marker = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("("), letter, F.lit(") "))).otherwise("")
    body = F.expr("concat('Let x_{', p_size, '} be and y_{', p_size, '} then x_{', p_size, '}', if(p_size % 2 = 0, '\nSign_____', ''), '\n```', p_type, '\n', p_name, '\n```', '\n![', p_name, '](G', p_partkey, ')')")
    tagged = F.concat(marker, F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('<E T="03">'), "p_brand", F.lit(".</E> "))).otherwise(""), F.lit("words"))
    label = F.array(F.lit("100"), F.col("p_partkey").cast("string"), letter)
    return p.select(F.lit("100").alias("tree"), F.array(F.lit(0).cast("long"), F.col("p_partkey").cast("long"), F.lit(0).cast("long")).alias("path"), label.alias("label"), label_id(label).alias("label_id"), F.lit("regtext").alias("node_type"), F.lit(None).cast("string").alias("title"), F.concat(marker, body).alias("text"), tagged.alias("tagged_text"))


def segment_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of nations: section 1 defines market segments and `account`, sections 1000 + customer use and cite them, and the
    interpretations of every third of them hold a comment."""
    c = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("tree"), "n_name")
    seg = c.select("c_mktsegment").distinct().select(F.lower("c_mktsegment").alias("s"))

    def node(df: DataFrame, label, path, title, text, kind: str = "regtext") -> DataFrame:
        return df.select("tree", path.alias("path"), label.alias("label"), label_id(label).alias("label_id"), F.lit(kind).alias("node_type"), title.alias("title"), text.alias("text"), F.lit("").alias("tagged_text"))

    none, key = F.lit(None).cast("string"), lambda x: F.lit(x).cast("long")
    top = node(nation, F.array("tree"), F.array(key(0)), F.concat(F.lit("PART "), "tree", F.lit("—"), "n_name", F.lit(" (REGULATION Z)")), F.lit(""))
    section = node(nation, F.array("tree", F.lit("1")), F.array(key(0), key(1)), F.lit("§ 1 Definitions."), F.lit("For purposes of this part:"))
    defined = node(nation.crossJoin(F.broadcast(seg)), F.array("tree", F.lit("1"), "s"), F.array(key(0), key(1), F.crc32("s")), none, F.concat(F.lit("The term “"), "s", F.lit("” means a thing.")))
    sold = c.select(F.col("c_nationkey").cast("string").alias("tree"), (F.col("c_custkey") + 1000).cast("long").alias("k"), F.lower("c_mktsegment").alias("s"), (F.col("c_custkey") % 4).alias("m"))
    cited = F.concat(F.lit("A "), "s", F.lit(" customer. See § "), "tree", F.lit("."), F.when(F.col("m") == 0, F.lit("1")).otherwise(F.lit("2")), F.lit(" and 12 U.S.C. "), (F.col("m") + 5000).cast("string"), F.lit("."))
    label = F.array("tree", F.col("k").cast("string"))
    used = node(sold, label, F.array(key(0), F.col("k")), F.concat(F.lit("§ "), F.col("k").cast("string")), cited)
    held = sold.where("k % 3 = 0")
    comments = node(held, F.concat(label, F.array(F.lit("Interp"))), F.array(key(1), F.col("k")), none, F.when(F.col("m") == 1, F.lit("")).otherwise(F.lit("Words.")), "interp")
    return reduce(DataFrame.unionByName, [top, section, defined, used, comments])
