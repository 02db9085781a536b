"""Every registered query with an SQL twin equals DuckDB on sf0.001."""

import hashlib
import math

import pytest

from tagloom.plans.registry import load_all

from .conftest import SF_SMOKE

FAST = ["raw_tag_lines", "accent_fold", "singularize_words", "metadata_tag_rewrite", "tokenize_tags",
        "stopword_filter", "tag_counts", "tag_top50", "tags_per_image", "language_identify", "language_histogram",
        "score_topk", "score_sentinel", "label_counts", "label_top50", "unscored_images", "index_listing",
        "image_lots", "label_vocabulary", "score_features", "dashboard_totals", "train_test_split",
        "bag_of_words", "one_vs_rest", "infer_labels_from_tags", "infer_tags_from_labels", "prediction_stats",
        "hit_rate", "delimited_roundtrip", "pair_json_roundtrip", "label_list_roundtrip", "original_tags_json",
        "label_dictionary", "file_key_parse", "stream_photo_urls", "stream_classification", "stream_top25",
        "label_recent40", "label_drilldown", "score_batch_udf", "metadata_tag_tokens", "listed_image_scores",
        "label_recent40_stream", "label_latest_images", "distinct_photo_urls", "infer_tags_quantile_bins",
        "infer_tags_quantile_bins_depth8", "tag_file_scan", "stored_image_scores", "unscored_stored_images",
        "stream_stored_images", "unnamed_classes", "language_file_roundtrip", "distinct_lines_sketch",
        "infer_labels_from_tags_depth8", "infer_tags_from_labels_depth8", "prediction_stats_depth8"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def test_every_sql_query_is_listed():
    reg = load_all()
    assert {n for n, q in reg.items() if q.sql} == set(FAST)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    q = load_all()[name]
    df = q.build(spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)
