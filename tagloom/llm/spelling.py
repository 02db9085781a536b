"""Spelling variants by permuterm rotations.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  A word's form is its near word of the largest count (ties: the
smallest in code-point order), if that count is ``RATIO`` times the word's own
or more; its root is where the forms end.

1. Words are marked with a terminator that no word has, and rotated.  The
   rotation that ends in the code point at place i, without that code point,
   is a prefix that says everything of the word but the code point: words that
   share it differ by a replacement there, and a word whose whole rotation is
   that prefix differs by a deletion there.
2. The rotations are grouped by prefix (Spark sorts them).  A group has at most
   one word for each code point of the words and one more, so it is bounded by
   the alphabet, whatever the vocabulary.
3. Each group gives each of its words the number and the best of the others: one
   row a word, never a pair.  These are summed up by word.  In a run of equal
   code points a deletion counts at the last of them only, so every near word
   counts once.
4. Forms are chained by pointer doubling; counts grow by the ratio on the way,
   so a chain is short.

Words are known by their place in code-point order (the id of the sorted and
stored vocabulary), which settles ties; prefixes of more than ``LONG`` code
points are carried as their SHA-256, so a word of L code points makes 2 L + 1
rows of bounded size (and work in the square of L).

Defined results: null and empty texts have no runs; a document without an id
counts with an empty id; repeated rows count again; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
LONG = 40
END = "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 199


def runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, run): every maximal run of Latin letters of ``min_length`` code
    points or more, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col("text"), F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def slipped(doc_id: Column, run: Column, every: int = SLIP) -> Column:
    """The run with a known slip: where ``every`` divides the CRC-32 of
    ``<doc_id>:<run>``, the code point at that CRC-32 modulo the length is left out."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of a table of words (column ``word``, one row an occurrence)."""
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _prefix(word: Column, skipped: Column, i: Column) -> Column:
    """The rotation that begins behind place ``i`` (from 0) and ends before it;
    ``skipped`` code points stay out between."""
    p = F.concat(F.substring(word, i + 1 + skipped, F.length(word)), F.lit(END), F.substring(word, F.lit(1), i))
    return F.when(F.length(word) + 1 - skipped <= LONG, p).otherwise(F.sha2(p, 256))


def _rotations(words: DataFrame) -> DataFrame:
    """(prefix, id, n, left_out, counts) of (id, word, n): all rotations, with
    (left_out) and without their last code point."""
    word, n = F.col("word"), F.length("word")

    def without(i):
        own, next_one = F.substring(word, i + 1, F.lit(1)), F.substring(word, i + 2, F.lit(1))
        return F.struct(_prefix(word, F.lit(1), i).alias("prefix"), F.lit(True).alias("left_out"), (own != next_one).alias("counts"))

    def whole(i):
        return F.struct(_prefix(word, F.lit(0), i).alias("prefix"), F.lit(False).alias("left_out"), F.lit(True).alias("counts"))
    rotated = F.concat(F.transform(F.sequence(F.lit(0), n - 1), without), F.transform(F.sequence(F.lit(0), n), whole))
    return words.select("id", "n", F.explode(rotated).alias("r")).select("id", "n", "r.*")


def _near(words: DataFrame) -> DataFrame:
    """(id, n_near, best): the number of near words of each word that has one,
    and the best of them as (less: minus its count, id)."""
    key = F.struct((-F.col("n")).alias("less"), F.col("id"))
    groups = _rotations(words).groupBy("prefix").agg(
        F.array_sort(F.collect_list(F.when(F.col("left_out"), F.struct(key.alias("key"), "counts")))).alias("same"),
        F.max(F.when(~F.col("left_out"), key)).alias("shorter")
    ).where((F.size("same") > 1) | ((F.size("same") > 0) & F.col("shorter").isNotNull()))
    best, second = F.col("same")[0]["key"], F.try_element_at("same", F.lit(2))["key"]
    short, long = F.col("shorter"), F.filter("same", lambda s: s["counts"])

    def of_same(s):
        other = F.when(s["key"] == best, second).otherwise(best)
        also = F.when(s["counts"], short)
        return F.struct(s["key"]["id"].alias("id"), (F.size("same") - 1 + also.isNotNull().cast("int")).alias("n"),
                        F.least(other, also).alias("best"))
    of_short = F.struct(short["id"].alias("id"), F.size(long).alias("n"), F.try_element_at(long, F.lit(1))["key"].alias("best"))
    members = F.concat(F.transform("same", of_same), F.when(short.isNotNull() & (F.size(long) > 0), F.array(of_short))
                       .otherwise(F.slice(F.array(of_short), 1, 0)))
    return (groups.select(F.explode(members).alias("m")).where("m.n > 0").groupBy(F.col("m.id").alias("id"))
            .agg(F.sum("m.n").cast("bigint").alias("n_near"), F.min("m.best").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, form) -> (id, root), by pointer doubling."""
    roots = materialize(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if roots.join(step, "root", "left_semi").isEmpty():
            return roots
        roots = materialize(roots.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "roots")


def variants(vocabulary: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, n) of distinct words -> word, n, n_near, form, form_n, root."""
    # Ids grow with the place in the sorted table, which is stored, so they stay.
    words = materialize(vocabulary.select("word", "n").orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")
    near = _near(words)
    judged = words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(-F.col("best.less") >= F.col("n") * ratio, F.col("best")).alias("best"))
    judged = materialize(judged, "near-words")
    forms = judged.where("best is not null").select("id", F.col("best.id").alias("form"))
    named = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    ends = _roots(forms).join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    changed = (judged.where("best is not null").withColumn("form", F.col("best.id")).join(named, "form").join(ends, "id")
               .select("word", "n", "n_near", F.col("form_word").alias("form"), (-F.col("best.less")).alias("form_n"),
                       F.col("root_word").alias("root")))
    same = judged.where("best is null").select("word", "n", "n_near", F.lit(None).cast("string").alias("form"),
                                               F.lit(None).cast("bigint").alias("form_n"), F.col("word").alias("root"))
    return same.unionByName(changed)
