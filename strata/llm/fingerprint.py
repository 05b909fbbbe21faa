"""Document fingerprints by one-permutation MinHash.

Every shingle (five words) is hashed once.  The top bits of the hash choose one
of ``BINS`` bins, each bin keeps its smallest hash.  An empty bin borrows from a
bin that its own random sequence of probes meets first (optimal
densification).  The lowest four bits of each bin are one hex digit, so a
fingerprint is a string of ``BINS`` digits.  The share of equal digits, less
what chance gives (1/16), estimates the Jaccard similarity.

Native: array expressions only.  In sorted order a bin's minimum is the first
hash with its top bits, so one sort of the hashes gives all bins.

Defined cases: a null text is empty; a text without words has the fingerprint
"" (likeness 1 to another such, else 0); with fewer words than a shingle the
whole sequence is the one shingle; rows equal in doc_id and text are one
document and get equal results each; texts that share a doc_id follow each
other by hash; a single document is its own next; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, SPACED_WORD, cut_lineage, keyed, lower_ascii, read_table, unkeyed

BINS = 128
BITS = 4
SHINGLE = 5
#: Probes of an empty bin before all full bins are compared at once.
PROBES = 12
_TOP = 64 - BINS.bit_length() + 1


def with_bins(df: DataFrame, text: str, out: str, k: int = SHINGLE) -> DataFrame:
    """Adds ``out``: the low bits of each bin of ``text``, or no element for a
    text without words.  Each step is a column of its own, so none is computed twice."""
    w, h, firsts, full = f"_{out}_w", f"_{out}_h", f"_{out}_f", f"_{out}_b"
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(SPACED_WORD), F.lit(0))
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.xxhash64(F.slice(w, i, k)))
    shingles = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) < k, F.array(F.xxhash64(w))).otherwise(grams)
    # In sorted order, the first hash and every hash whose top bits are not its predecessor's.
    new_bin = F.filter(F.col(h), lambda x, i: F.shiftright(x.bitwiseXOR(F.get(F.col(h), i - 1)), _TOP) != 0)
    bin_of = lambda x: (F.shiftright(x, _TOP) + BINS // 2).cast("int")
    low = lambda x: x.bitwiseAND(2**BITS - 1).cast("int")
    nothing = F.lit(None).cast("int")
    # Nulls for the empty bins before each full one, its bits, and nulls up to the end.
    gap = lambda x, i: bin_of(x) - F.coalesce(bin_of(F.get(F.col(firsts), i - 1)), F.lit(-1)) - 1
    spaced_out = F.flatten(F.transform(firsts, lambda x, i: F.concat(F.array_repeat(nothing, gap(x, i)), F.array(low(x)))))
    padded = F.slice(F.concat(spaced_out, F.array_repeat(nothing, BINS)), 1, BINS)
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    filled = F.when(F.size(firsts) == BINS, F.transform(firsts, low)).otherwise(padded)

    def borrowed(j: Column) -> Column:
        probe = F.aggregate(
            F.sequence(F.lit(1), F.lit(PROBES)),
            F.lit(None).cast("int"),
            lambda found, a: F.coalesce(found, F.element_at(full, (F.pmod(F.xxhash64(j, a), F.lit(BINS)) + 1).cast("int"))),
        )
        every = F.array_min(F.transform(firsts, lambda x: F.struct(F.xxhash64(j, bin_of(x), F.lit(1)).alias("p"), low(x).alias("v"))))
        return F.coalesce(probe, every["v"])

    dense = F.when(F.size(firsts) == BINS, F.col(full)).otherwise(
        F.transform(bins, lambda j: F.coalesce(F.element_at(full, j + 1), borrowed(j)))
    )
    return (
        df.withColumn(w, words)
        .withColumn(h, F.sort_array(shingles))
        .withColumn(firsts, F.concat(F.slice(h, 1, 1), new_bin))
        .withColumn(full, filled)
        .withColumn(out, F.when(F.size(firsts) == 0, F.array().cast("array<int>")).otherwise(dense))
        .drop(w, h, firsts, full)
    )


def packed(bins: Column) -> Column:
    """The fingerprint string: a hex digit for each bin."""
    return F.array_join(F.transform(bins, lambda v: F.lower(F.hex(v))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts by their bins, 0 to 1."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 1 / 2**BITS
    corrected = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (equal - chance) / (1 - chance)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(corrected)


def succession(ids: DataFrame) -> DataFrame:
    """``(_id, _tie, _n, _before, _before_tie, _before_n)``: each distinct
    document and the one before it in ascending order (before the first: the last).

    Ids alone are spread by range and sorted there; only each range's last
    document is compared with the next range.
    """
    keys = ["_id", "_tie", "_n"]
    spread = ids.select(*keys).distinct().repartitionByRange("_id", "_tie").withColumn("_part", F.spark_partition_id())
    spread = cut_lineage(spread)
    own = F.struct(*keys)
    inner = spread.withColumn("_prior", F.lag(own).over(Window.partitionBy("_part").orderBy("_id", "_tie")))
    ends = spread.groupBy("_part").agg(F.max(own).alias("_last"))
    order = Window.partitionBy(F.lit(0)).orderBy("_part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(F.col("_part").alias("_p"), F.coalesce(F.lag("_last").over(order), F.last("_last").over(whole)).alias("_outer"))
    joined = inner.join(ends, F.col("_part") == F.col("_p"))
    before = F.coalesce("_prior", "_outer")
    return joined.select(
        *keys, before["_id"].alias("_before"), before["_tie"].alias("_before_tie"), before["_n"].alias("_before_n")
    )


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text
    (the last half replaced from the start of the next document), and the
    likeness to that and to the next document."""
    texts = keyed(docs).select("_id", F.coalesce("_text", F.lit("")).alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    chain = cut_lineage(succession(texts.select("_id", "_tie", F.length("_text").alias("_n"))))
    marked = with_bins(texts, "_text", "_bins")
    rows = marked.join(chain, ["_id", "_tie"])
    half = F.floor(F.col("_before_n") / 2).cast("int")
    following = (
        rows.select(
            F.col("_before").alias("_id"),
            F.col("_before_tie").alias("_tie"),
            F.struct(F.substring(F.col("_text"), F.lit(1), half).alias("head"), F.col("_bins").alias("bins")).alias("_next"),
        )
        .groupBy("_id", "_tie")
        .agg(F.any_value("_next").alias("_next"))
    )
    keep = F.col("_n") - F.floor(F.col("_n") / 2)
    both = rows.join(following, ["_id", "_tie"]).withColumn(
        "_edited", F.concat(F.substring(F.col("_text"), F.lit(1), keep.cast("int")), F.col("_next.head"))
    )
    done = with_bins(both, "_edited", "_edited_bins")
    return done.select(
        unkeyed(F.col("_id")).alias("doc_id"),
        F.col("_n").cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited", "utf-8"), 256).alias("edited_sha256"),
        packed(F.col("_bins")).alias("fingerprint"),
        packed(F.col("_edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("_bins"), F.col("_edited_bins")).alias("near_edited"),
        likeness(F.col("_bins"), F.col("_next.bins")).alias("near_next"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read_table(spark, sf_dir, "documents"))
