"""The batch programs from a command line:

    spark-submit ... -m tagloom tags   --lines DIR --scores DIR --out DIR [--files N]
    python -m tagloom           score  --index DIR --contents DIR --model PARQUET --names PARQUET --out DIR
                                       [-n IMAGES] [-l LOT] [-m LABELS]
    python -m tagloom           infer  --features DIR --truth DIR --labels DIR --out DIR [--scores] [--depth N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import constants as C
from .functions import text as X
from .plans import jobs
from .plans.q_scoring import listing_of
from .session import get_session
from .sources import tables


def _positive(value: str) -> int:
    n = int(value)
    if n < 1:
        raise argparse.ArgumentTypeError(f"{value} is not 1 or more")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagloom")
    sub = p.add_subparsers(dest="job", required=True)
    tags = sub.add_parser("tags", help="tag analysis: tokens, counts, rankings, languages")
    tags.add_argument("--lines", required=True, help="folder of tags<N>.txt files")
    tags.add_argument("--scores", required=True, help="folder of {image, label, score} JSON lines")
    tags.add_argument("--files", type=_positive, help="files of each large output")
    score = sub.add_parser("score", help="score the images of HTML index listings")
    score.add_argument("--index", required=True, help="folder of HTML listings")
    score.add_argument("--contents", required=True, help="folder of im<N>.* files")
    score.add_argument("--model", required=True, help="table (node, centroid)")
    score.add_argument("--names", required=True, help="table (node_id, name)")
    score.add_argument("-n", "--images", type=_positive, default=C.IMAGES_PER_INDEX, help="images to score")
    score.add_argument("-l", "--lot", type=_positive, default=C.LOT_SIZE, help="images of a lot")
    score.add_argument("-m", "--labels", type=_positive, default=C.MAX_SCORE_LABELS, help="labels kept per image")
    infer = sub.add_parser("infer", help="predict one vocabulary from another")
    infer.add_argument("--features", required=True, help="folder of {id, label} or {image, label, score} JSON lines")
    infer.add_argument("--truth", required=True, help="folder of {id, label} JSON lines")
    infer.add_argument("--labels", required=True, help="text file of the labels to predict")
    infer.add_argument("--scores", action="store_true", help="the features are scores")
    infer.add_argument("--depth", type=_positive, default=C.TREE_DEPTH)
    for s in (tags, score, infer):
        s.add_argument("--out", required=True, help="output folder")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or get_session()
    if a.job == "tags":
        jobs.tag_analysis_job(spark, tables.read_tag_files(spark, a.lines), tables.read_scores(spark, a.scores), a.out, files=a.files)
    elif a.job == "score":
        pages = spark.read.option("wholetext", True).text(a.index).select(
            F.col("_metadata.file_path").alias("page_id"), F.lit("").alias("url"), F.col("value").alias("html"))
        index = listing_of(pages).select(X.image_number(X.url_base_name(F.col("name"))).alias("id")).where("id is not null")
        jobs.scoring_job(index, tables.read_stored_vectors(spark, a.contents), spark.read.parquet(a.model), spark.read.parquet(a.names),
                         a.out, n_images=a.images, lot_size=a.lot, max_labels=a.labels)
    else:
        if a.scores:
            features = tables.read_scores(spark, a.features).select(X.image_number(F.col("image")).alias("id"), "label", "score")
        else:
            features = tables.read_pairs(spark, a.features)
        jobs.inference_job(spark, features, tables.read_pairs(spark, a.truth), tables.read_label_list(spark, a.labels), a.out,
                           not a.scores, a.depth)


if __name__ == "__main__":
    main()
