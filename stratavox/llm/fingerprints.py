"""Threshold-scaled document fingerprints; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, id_text

SHINGLE_WORDS = 5
#: A shingle's hash is kept where it is below this part of all 2^64 (at most a half).
FRACTION = 0.25


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_GAP), "")


def hashes_of(words: str) -> Column:
    """A 64-bit hash of each run of SHINGLE_WORDS words; of fewer words, one of them all."""
    n = F.size(words)
    runs = F.transform(F.slice(words, F.lit(1), F.greatest(n - (SHINGLE_WORDS - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE_WORDS)]))
    return F.when(n >= SHINGLE_WORDS, runs).when(n > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))


def sketch_of(hashes: str, fraction: float = FRACTION) -> Column:
    """The sorted different hashes below the threshold, none where none is."""
    return F.sort_array(F.array_distinct(F.filter(hashes, lambda h: (h >= 0) & (h < F.lit(int(fraction * 2**64))))))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together: exactly sketch_of() of the union of their hashes."""
    return F.sort_array(F.array_union(a, b))


def likeness(a: str, b: str, same: Column) -> Column:
    """Estimated Jaccard likeness of two sketches, 0 to 1. Two empty ones, of texts without words or of
    few shingles, say nothing: then `same`, whether the texts have the same words, decides (1 or 0)."""
    both, one = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(one == 0, same.cast("double")).otherwise(both / one)


def containment(a: str, b: str) -> Column:
    """Estimated part of a's shingles that b has too, however unequal they are; 1 for an empty sketch a."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, sketch array<long> and words_hash (of all words in order, long) of every whole text; one
    narrow stage.

    A null or empty text has an empty sketch, and so may a short one: each shingle is kept with the
    probability FRACTION, whatever the text's length, which is what makes sketches mergeable. Null
    doc_ids and repeated rows are kept as they are; a text of any length is read whole; an empty table
    gives no rows; other columns are ignored.
    """
    at = id_text(docs).select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", hashes_of("words").alias("hashes"), F.xxhash64("words").alias("words_hash"))
    return at.select("doc_id", sketch_of("hashes").alias("sketch"), "words_hash")


def with_next(docs: DataFrame) -> tuple[DataFrame, object]:
    """(rows, window): doc_id, text, is_row and a `range` of neighbouring doc_ids, and the window that
    orders each range. Every range also holds the first row of the next one, with is_row false (of
    the last one, the first row of all), so lead() never has to leave a range.

    Null doc_ids come first; rows of one doc_id are ordered by their text. The driver sees only
    the borders: four for each shuffle partition.
    """
    spark = docs.sparkSession
    rows = id_text(docs)
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], max(10_000, 20 * n)).alias("x")).first()["x"] or []
    cuts = sorted(set(cuts))
    # Two short searches instead of one long one: the coarse step, then the cuts within it.
    step = max(1, int(len(cuts) ** 0.5))
    fine, coarse = F.array(*map(F.lit, cuts)).cast("array<bigint>"), F.array(*map(F.lit, cuts[::step])).cast("array<bigint>")
    count = lambda array: F.size(F.filter(array, lambda c: c <= F.col("doc_id")))
    block = F.greatest(count(coarse) - 1, F.lit(0)) * step
    number = F.when(F.col("doc_id").isNull(), 0).otherwise(block + count(F.slice(fine, block + 1, F.lit(step)))) if cuts else F.lit(0)
    rows = rows.withColumn("range", number)
    firsts = [(r["range"], r["first"]) for r in rows.groupBy("range").agg(F.min(F.struct("doc_id")).alias("x")).select("range", F.col("x.doc_id").alias("first")).orderBy("range").collect()]
    if firsts:
        before = {b[0]: a[0] for a, b in zip(firsts, firsts[1:] + firsts[:1], strict=True)}
        known = [x for _, x in firsts if x is not None]
        some = F.col("doc_id").isin(known) if len(known) == len(firsts) else F.col("doc_id").isin(known) | F.col("doc_id").isNull()
        borders = rows.filter(some).groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("x"))
        to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        borders = borders.select("x.doc_id", "x.text", to[F.col("range")].alias("range"), F.lit(False).alias("is_row"))
        rows = rows.withColumn("is_row", F.lit(True)).unionByName(borders)
    else:
        rows = rows.withColumn("is_row", F.lit(True))
    return rows, Window.partitionBy("range").orderBy(F.desc("is_row"), F.asc_nulls_first("doc_id"), "text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document, its edited text and its next document, fingerprinted and compared.

    Edited: the last floor(n/4) of n code points give way to the first as many of the next
    document's text. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, contained_edited, contained_next. A null text is empty; a single
    document is its own next; repeated rows follow one another; an empty table gives no rows; a short
    text's fingerprint may be empty (see likeness()).
    """
    rows, order = with_next(docs)
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    at = rows.select("doc_id", "range", "is_row", "text", F.lead("text").over(order).alias("next"), F.length("text").alias("n_chars"))
    at = at.select("doc_id", "range", "is_row", "text", "n_chars", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - cut), F.substring("next", F.lit(1), cut)).alias("edited"))
    at = at.select("doc_id", "range", "is_row", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("text"), words_of(F.col("text")).alias("words"), words_of(F.coalesce("edited", F.lit(""))).alias("edited_words"))
    of = [F.xxhash64("words").alias("own"), F.xxhash64("edited_words").alias("edited_own")]
    at = at.select("doc_id", "range", "is_row", "text", "n_chars", "edited_sha256", *of, hashes_of("words").alias("hashes"), hashes_of("edited_words").alias("edited_hashes"))
    at = at.select("doc_id", "range", "is_row", "text", "n_chars", "edited_sha256", "own", "edited_own", sketch_of("hashes").alias("sketch"), sketch_of("edited_hashes").alias("edited_sketch"))
    at = at.select("*", F.lead("sketch").over(order).alias("next_sketch"), F.lead("own").over(order).alias("next_own")).filter("is_row")
    return at.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch", F.col("own") == F.col("edited_own")).alias("near_edited"),
        likeness("sketch", "next_sketch", F.col("own") == F.col("next_own")).alias("near_next"),
        containment("sketch", "edited_sketch").alias("contained_edited"),
        containment("sketch", "next_sketch").alias("contained_next"),
    )
