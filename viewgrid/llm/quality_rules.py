"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions alone (operator 10).

Base figures come from words (runs of characters other than space and 0x09-0x0D),
lines and 8-word windows, all inside the row: a window's hash is built from
the hashes of its words by doubling, so no row is exploded and nothing is
shuffled.

The method's verdict compares two multinomials over ``BUCKETS`` hashed n-grams
(tokens and token pairs; a token is a run of letters and digits or a run of
other signs): one of the trusted documents, all those labelled good, and one of all
documents.  The sum of a document's log ratios over its
n-grams, divided by their number, must reach ``LEAST_RATIO``.  Log ratios are
rounded to millionths and added as integers, so the verdict doesn't depend on
the order of anything.  The table of ratios has a fixed size and goes into
the plan as a constant.

Defined results: a null or empty text has no words and fails the base rules.
Rows are judged independently, so repeated rows repeat their result and rows
without doc_id are judged as well.  Other columns are ignored.  Without any
trusted document the method keeps everything that passes the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewgrid.llm.tables import MOST_BROADCAST_IDS, id_and_text

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
BUCKETS = 1 << 14
LEAST_RATIO = -0.25
UNIT = 1_000_000

SPACE = " \t\n\x0b\x0c\r"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def _pairs(c: str, n: Column, gap: int) -> Column:
    """Hash of each of the first n elements of c with the one ``gap`` places on."""
    return F.zip_with(F.slice(c, 1, n), F.slice(c, gap + 1, n), lambda a, b: F.xxhash64(a, b))


def base_figures(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text without nulls) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    trimmed = F.btrim("text", F.lit(SPACE))
    d = docs.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    d = d.select(
        *docs.columns,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("w1"),
    )
    rest = [c for c in d.columns if c != "w1"]
    size = 1
    while size < WINDOW:  # hashes of 2, 4 and 8 words from each place
        n = F.greatest(F.size(f"w{size}") - size, F.lit(0))
        d = d.select(*rest, _pairs(f"w{size}", n, size).alias(f"w{2 * size}"))
        size *= 2
    # Windows sorted by hash, then place; those beside an equal one are repeats.
    again = F.size(F.array_distinct(f"w{size}")) < F.size(f"w{size}")
    d = d.select(*rest, F.when(again, F.sort_array(F.transform(f"w{size}", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("sorted"))
    at = F.col("sorted")
    beside = F.transform(
        at,
        lambda x, j: F.when(
            (F.try_element_at(at, j + 2)["h"] == x["h"]) | F.coalesce(F.when(j > 0, F.try_element_at(at, F.greatest(j, F.lit(1)))["h"] == x["h"]), F.lit(False)), x["i"]
        ),
    )
    d = d.select(*rest, F.sort_array(F.filter(beside, lambda i: i.isNotNull())).alias("at"))
    covered = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, i: F.struct((s["n"] + i + WINDOW - F.greatest(i, s["end"])).alias("n"), (i + WINDOW).alias("end")), lambda s: s["n"])
    d = d.select(*rest, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def with_grams(docs: DataFrame) -> DataFrame:
    """docs with ``grams``, the hashes of their tokens and token pairs."""
    d = docs.withColumn("tokens", F.transform(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x)))
    pairs = _pairs("tokens", F.greatest(F.size("tokens") - 1, F.lit(0)), 1)
    return d.withColumn("grams", F.concat("tokens", pairs)).drop("tokens")


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[int]:
    """Log ratio of each bucket in millionths, from all documents; BUCKETS numbers, whatever the corpus."""
    good = labels.where((F.col("quality").cast("int") == 1) & F.col("doc_id").isNotNull())
    target = good.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("trusted")).distinct()
    small = target.count() <= MOST_BROADCAST_IDS
    d = with_grams(docs.join(F.broadcast(target) if small else target, "doc_id", "left")).select("grams", F.coalesce("trusted", F.lit(0)).alias("trusted"))
    # The outer form: for the plain one the optimizer adds a filter that builds the n-grams several times more.
    d = d.select(F.explode_outer("grams").alias("gram"), "trusted").where("gram is not null").groupBy(F.pmod("gram", F.lit(BUCKETS)).cast("int").alias("bucket"))
    rows = d.agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    whole = rows.agg(F.collect_list(F.struct("bucket", "raw", "target")).alias("b"), F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    ratio = F.round(UNIT * (F.log((F.col("x.target") + 1) / (F.col("all_target") + BUCKETS)) - F.log((F.col("x.raw") + 1) / (F.col("all_raw") + BUCKETS)))).cast("long")
    found = whole.select(F.explode("b").alias("x"), "all_raw", "all_target").where("all_target > 0").select("x.bucket", ratio.alias("ratio")).collect()
    out = [0] * BUCKETS
    for r in found:
        out[r["bucket"]] = r["ratio"]
    return out


def judged(docs: DataFrame, ratios: list[int], least_ratio: float = LEAST_RATIO) -> DataFrame:
    """doc_id, the base figures, base_failed, ratio (millionths for each n-gram, null without any) and kept."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<long>")  # folded to one constant
    d = with_grams(id_and_text(docs).withColumn("text", F.coalesce("text", F.lit(""))))
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda s, g: s + F.get(table, F.pmod(g, F.lit(BUCKETS)).cast("int")))
    d = d.select("doc_id", "text", F.size("grams").cast("long").alias("n_grams"), total.alias("total"))
    d = base_figures(d)
    passed = F.col("total") >= int(least_ratio * UNIT) * F.col("n_grams")
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & passed).alias("kept"),
        F.when(F.col("n_grams") > 0, F.col("total") / F.col("n_grams") / UNIT).alias("ratio"),
    )


def rules(docs: DataFrame, labels: DataFrame, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """Every document's figures and verdict; see the module's text."""
    plain = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return judged(docs, log_ratios(plain, labels), least_ratio)
