"""Quality rules as a bitmask ledger; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, id_text

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits")


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where `fails`, SQL over the measurements, holds."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "shouting", "2 * n_upper > word_chars"),
    Rule(4, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(5, "digits", "2 * n_digits > word_chars"),
    Rule(6, "long_words", "word_chars > 20 * n_words"),
)
#: A policy is the set of rules that reject, as a mask of their bits. Versions are added, never changed.
POLICIES = {"base-1": 0b0000011, "strict-1": 0b1111111}


def measure(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and MEASURES (long) of every whole text, in one narrow pass; with carry, the whole row
    too, as struct `row`, and `fence`, a number that the optimizer cannot push a filter past: pushed
    into the measurements, a filter would repeat them all for each use.

    Words are separated by the six characters of WORD_GAP. A null or empty text measures 0
    throughout; null doc_ids and repeated rows are measured each; other columns are ignored.
    """
    has_word = "[^\\x20\\x09-\\x0D]"
    n = F.size("words")
    row = [F.col("row")] if carry else []
    fence = [F.monotonically_increasing_id().alias("fence")] if carry else []
    texts = id_text(docs)
    if carry:
        texts = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
        texts = texts.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text"), "row")
    at = texts.select(
        "doc_id",
        *row,
        F.array_remove(F.split("text", WORD_GAP), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(has_word)).alias("lines"),
        F.length("text").alias("n_chars"),
        *[F.regexp_count("text", F.lit(p)).cast("long").alias(c) for c, p in (("n_gaps", "[\\x20\\x09-\\x0D]"), ("n_symbols", "[#*$%&|<>]"), ("n_upper", "\\p{Lu}"), ("n_digits", "[0-9]"))],
    )
    window = F.transform(F.slice("words", F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("p")))
    at = at.select("*", F.sort_array(window).alias("sorted"))
    same = lambda x, j: F.coalesce(F.get("sorted", j)["h"] == x["h"], F.lit(False))
    found = F.filter("sorted", lambda x, i: F.when(i > 0, same(x, i - 1)).otherwise(False) | same(x, i + 1))
    at = at.select("*", F.sort_array(F.transform(found, lambda x: x["p"])).alias("again"))
    covered = F.transform("again", lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get("again", i - 1))))
    return at.select(
        "doc_id",
        *row,
        n.cast("long").alias("n_words"),
        (F.col("n_chars") - F.col("n_gaps")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_upper",
        "n_digits",
        *fence,
    )


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: bool = False) -> DataFrame:
    """measure()'s rows and `failed`: a long whose bit b is set where the rule of bit b fails. Rows without
    words fail few_words alone; nulls, repeated rows, empty tables and names as in measure()."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0).cast("long") for r in rules]
    failed: Column = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs, carry).withColumn("failed", failed)


def apply_policy(book: DataFrame, policy: str) -> DataFrame:
    """The ledger and `kept`: no rule of the policy fails. The texts are not needed again."""
    return book.withColumn("kept", F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(book: DataFrame, policy: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: the documents that fail it, and those that only it rejects.

    One aggregation over the ledger's distinct masks, at most 2^rules of them.
    """
    mask = POLICIES[policy]
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed")).agg(F.count("*").alias("n"))
    sums = [x for r in rules if mask >> r.bit & 1 for x in (F.sum(F.when(F.col("failed").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n"))).alias(f"f{r.bit}"), F.sum(F.when(F.col("failed") == (1 << r.bit), F.col("n"))).alias(f"o{r.bit}"))]
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.coalesce(f"f{r.bit}", F.lit(0)).alias("n_failed"), F.coalesce(f"o{r.bit}", F.lit(0)).alias("n_only")) for r in rules if mask >> r.bit & 1])
    return masks.agg(*sums).select(F.explode(rows).alias("x")).select("x.*")


def verdicts(docs: DataFrame, policy: str = "strict-1", base: str = "base-1") -> DataFrame:
    """doc_id, the measurements, failed, base_failed and kept, for every row; nulls, repeated rows, empty
    tables and names as in measure()."""
    book = apply_policy(ledger(docs), policy)
    return book.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(POLICIES[base])) != 0)


def keep(docs: DataFrame, policy: str = "strict-1") -> DataFrame:
    """The rows of docs, all columns whatever their names, that no rule of the policy rejects; no shuffle.
    Null and empty texts are rejected by few_words; repeated rows and null doc_ids are judged each; an
    empty table gives no rows."""
    return apply_policy(ledger(docs, carry=True), policy).filter("kept and fence >= 0").select("row.*")
