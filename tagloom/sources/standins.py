"""

* image + raw tag lines   <- documents(doc_id, text) split into lines
* photo-metadata tags     <- strings built from part / orders / lineitem columns
* scored image features   <- embeddings(vec_id, embedding, label)
* second label vocabulary <- labels(doc_id, quality, toxic)
* HTML image index        <- pages(page_id, url, html)
* node-id dictionary      <- nation(n_nationkey, n_name) / region
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tags as tag_ops
from . import tables


def tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image BIGINT, label STRING): every line of every document is a tag."""
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    return tag_ops.lines_from_text(docs, "doc_id", "text")


def _s(c):
    return F.col(c).cast("bigint").cast("string") if isinstance(c, str) else c.cast("bigint").cast("string")


def metadata_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, label) camera-style tags built from integer TPC-H-like columns:
    geo positions, lens focal lengths, apertures, dates, decimal commas,
    emoticons.  Integer arithmetic only, so the SQL twin is exact."""
    part = tables.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    line = tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    key, size = F.col("p_partkey"), F.col("p_size")
    p = part.select(
        key.alias("image"),
        F.array(
            F.concat(F.lit("geo:lat="), _s(size), F.lit("."), F.lpad(_s(key * 7919 % 1000000), 6, "0")),
            F.concat(F.lit("geo:lon=-"), _s(size % 3), F.lit("."), F.lpad(_s(key * 104729 % 100000), 5, "0")),
            F.concat(_s(size), F.lit("mm f/"), _s(size % 9 + 1), F.lit("."), _s(size % 10)),
            F.concat(_s(size % 30 + 10), F.lit("-"), _s(size * 4 + 40), F.lit("mm")),
            F.concat(F.lit("Canon EOS "), _s(size), F.lit("D")),
            F.concat(_s(size % 80 + 10), _s(size + 100), F.lit("mm")),
            F.concat(F.lower(F.regexp_replace("p_brand", "#", "")), F.lit(":)")),
        ).alias("tags"))
    o = orders.select(
        (F.col("o_orderkey") + 1000000).alias("image"),
        F.array(
            F.date_format("o_orderdate", "d.M.yyyy"),
            F.date_format("o_orderdate", "dd/MM/yyyy"),
            F.concat(_s(F.col("o_orderkey") % 1000), F.lit(","), _s(F.col("o_custkey") % 100)),
            F.concat(F.lit("f"), _s(F.col("o_orderkey") % 64)),
        ).alias("tags"))
    qty = F.col("l_quantity").cast("bigint")
    li = line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 10000000).alias("image"),
        F.array(
            F.concat(_s(qty), F.lit(" off;-)")),
            F.concat(F.lit("sigma"), _s(qty), F.lit("-"), _s(qty * 10), F.lit("mm")),
            F.concat(F.lit("EF-S "), _s(F.col("l_linenumber")), F.lit("."), _s(qty)),
        ).alias("tags"))
    return p.unionByName(o).unionByName(li).select("image", F.explode("tags").alias("label"))
