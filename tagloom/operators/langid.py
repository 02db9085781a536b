"""Language identification of tag lines: character-trigram naive Bayes.

Training (lines with a known language) and prediction are Spark joins and
aggregations.  With add-one smoothing over the trigram vocabulary V and N_l
trigrams seen in language l:

    score(line, l) = ln P(l) - T(line) * ln(N_l + V) + sum over the line's
                     trigrams seen in l of ln(c_l(trigram) + 1)

so only trigrams a language has seen join with the model, and the sum is a
grouped aggregate on (line, language) that combines map-side.  Spark picks the
join with the model by its size in bytes.
Ties (scores rounded to 9 decimals) go to the smaller language code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

SCORE_DECIMALS = 9


def trigrams(text) -> F.Column:
    """Overlapping trigrams of ' ' + lower(text) + ' ' in one linear regex
    pass (a zero-width look-ahead captures each; none for an empty line)."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return F.regexp_extract_all(padded, F.lit("(?s)(?=(.{3}))"), 1)


def _exploded(lines: DataFrame, key_cols: list[str]) -> DataFrame:
    s_len = F.length(F.col("label")) + 2
    return (spread(lines.where(s_len >= 3))
            .select(*key_cols, F.explode(trigrams(F.col("label"))).alias("tri")))


def train(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lines (lang, label) -> (model (tri, lang, w = ln(c+1)), langs (lang, base))
    with base = ln P(lang) and norm = ln(N_lang + V)."""
    tris = _exploded(lines, ["lang"])
    # The fitted counts (trigram vocabulary x languages) feed four branches;
    # materialise them once, as a fitted model.
    counts = tris.groupBy("tri", "lang").agg(F.count(F.lit(1)).alias("c"))
    counts = materialize(counts, "trigram-counts")
    model = counts.select("tri", "lang", F.log(F.col("c") + 1.0).alias("w"))
    vocab = counts.select("tri").distinct().agg(F.count(F.lit(1)).alias("V"))
    totals = counts.groupBy("lang").agg(F.sum("c").alias("N"))
    priors = lines.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines"))
    all_lines = priors.agg(F.sum("n_lines").alias("n_all"))
    langs = (priors.join(totals, "lang", "left").withColumn("_k", F.lit(0))
             .join(vocab.withColumn("_k", F.lit(0)), "_k").join(all_lines.withColumn("_k", F.lit(0)), "_k")
             .select("lang", F.log(F.col("n_lines") / F.col("n_all")).alias("prior"),
                     F.log(F.coalesce("N", F.lit(0)) + F.col("V")).alias("norm")))
    return model, langs


MAX_LANGUAGES = 500


def predict(lines: DataFrame, model: DataFrame, langs: DataFrame, key_cols: list[str]) -> DataFrame:
    """(key..., lang) most probable language of every line.

    The model is pivoted to one row per trigram with one weight column per
    language (the language list is counted first and bounded), so the join
    keeps one row per trigram occurrence and each line aggregates to a single
    row of per-language sums."""
    # At most MAX_LANGUAGES + 1 rows reach the driver: enough to refuse an
    # unbounded language set without gathering it.
    lang_rows = langs.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(lang_rows) > MAX_LANGUAGES:
        raise ValueError(f"too many languages: {len(lang_rows)}")
    codes = [r["lang"] for r in lang_rows]
    wide = model.groupBy("tri").pivot("lang", codes).agg(F.first("w"))
    wide = wide.toDF("tri", *[f"w{i}" for i in range(len(codes))])
    # The line's length rides in the grouping key, and lines without a trigram
    # keep one row, so the lines are read once.
    tris = spread(lines, *key_cols).select(
        *key_cols, F.length("label").alias("T"), F.explode_outer(trigrams(F.col("label"))).alias("tri"))
    scored = (tris.join(wide, "tri", "left")
              .groupBy(*key_cols, "T").agg(*[F.sum(f"w{i}").alias(f"s{i}") for i in range(len(codes))]))
    cands = F.array(*[
        F.struct((-F.round(F.lit(r["prior"]) - F.col("T") * F.lit(r["norm"])
                           + F.coalesce(F.col(f"s{i}"), F.lit(0.0)), SCORE_DECIMALS)).alias("neg"),
                 F.lit(r["lang"]).alias("lang"))
        for i, r in enumerate(lang_rows)])
    return scored.select(*key_cols, F.array_min(cands)["lang"].alias("lang"))
