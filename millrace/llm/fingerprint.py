"""Document fingerprints: one-permutation MinHash with optimal densification and packed bits.

Every shingle is hashed once. The top bits of the hash choose a bin, and a bin keeps its
smallest hash. An empty bin borrows from the first occupied bin of its own sequence of random
bins, so the borrowing is independent from bin to bin. A bin's hash is hashed with the number of
the bin, so that bins which borrow from one bin differ, and of that the low four bits are kept,
one hexadecimal digit. Two unrelated bins agree by chance in one case of 16, which the
likeness corrects. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import shuffle_width

BIN_BITS = 8
LOW = 16
#: Random bins that an empty bin tries one by one; beyond, the least of a random ranking wins.
PROBES = 16
SPACE = " \t\n\x0b\x0c\r"


def with_fingerprint(df: DataFrame, text: str, out: str, width: int = 5) -> DataFrame:
    """``df`` with ``out``: one hexadecimal digit a bin, '' for a text without words.

    Words are what white space (space, 0x09-0x0D) separates, in lower case. Fewer than
    ``width`` words are one shingle.
    """
    bins = 2 ** BIN_BITS
    names = df.columns
    trimmed = F.lower(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE)))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    # Each step is a column of its own, so that a lambda reads it instead of computing it again.
    df = df.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_words")
    wide = F.transform(F.slice("_words", 1, n - (width - 1)), lambda w, i: F.xxhash64(
        w, *[F.get("_words", i + k) for k in range(1, width)]))
    hashes = (F.when(n >= width, wide).when(n > 0, F.array(F.xxhash64("_words")))
              .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_sorted", F.sort_array(hashes)).drop("_words")
    bin_of = lambda h: F.shiftrightunsigned(h, 64 - BIN_BITS)
    least = F.filter("_sorted", lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get("_sorted", i - 1))))
    slot = lambda b, h: F.struct(b.cast("int").alias("bin"), h.cast("bigint").alias("hash"))
    df = df.withColumn("_least", F.transform(least, lambda h: slot(bin_of(h), h))).drop("_sorted")
    free = F.array_except(F.sequence(F.lit(0), F.lit(bins - 1)), F.col("_least.bin"))
    slots = F.sort_array(F.concat("_least", F.transform(free, lambda b: slot(b, F.lit(None)))))
    df = df.withColumn("_bins", F.transform(slots, lambda s: s["hash"]))

    def borrowed(i: Column) -> Column:
        tries = [F.get("_bins", F.pmod(F.xxhash64(F.lit(t), i), F.lit(bins)).cast("int")) for t in range(PROBES)]
        ranked = F.array_min(F.transform("_least", lambda v: F.struct(
            F.xxhash64(F.lit(PROBES), i, v["bin"]).alias("rank"), v["hash"].alias("hash"))))
        return F.coalesce(*tries, ranked["hash"])

    digits = F.transform("_bins", lambda v, i: F.hex(
        F.xxhash64(F.coalesce(v, borrowed(i)), i).bitwiseAND(F.lit(LOW - 1))))
    packed = F.when(F.size("_least") > 0, F.lower(F.array_join(digits, ""))).otherwise(F.lit(""))
    return df.withColumn(out, packed).select(*names, out)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1, chance agreement taken out."""
    left, right = F.split(a, ""), F.split(b, "")
    same = F.size(F.filter(F.arrays_zip(left.alias("x"), right.alias("y")), lambda p: p["x"] == p["y"]))
    raw = (same / F.lit(float(2 ** BIN_BITS)) - 1 / LOW) / (1 - 1 / LOW)
    return (F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))))


def with_next(docs: DataFrame, key: str, tie: str, carried: list[str], buckets: int) -> DataFrame:
    """Each row with ``next``: the carried columns of the row after it, in descending order of
    ``key`` (nulls last), then ``tie``; after the last row comes the first.

    The order is cut into ranges of ``key``. A range's first row also goes to the range before
    it, so rows move once and no task holds more than a range. Equal keys share a range.
    """
    fractions = [i / buckets for i in range(1, buckets)]
    bounds = docs.agg(F.percentile_approx(key, fractions, 10 * buckets)).first()[0] if fractions else None
    bounds = sorted(set(bounds or []))
    if bounds:
        edges = F.array(*[F.lit(b).cast("bigint") for b in bounds])
        steps = F.array(*[F.lit(2 ** i) for i in reversed(range(len(bounds).bit_length()))])
        # Binary search: how many bounds are below the key.
        place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get("_edges", at + step - 1) < F.col(key)), at + step).otherwise(at))
        docs = docs.withColumn("_edges", edges).withColumn("_range", F.coalesce(
            F.when(F.col(key).isNotNull(), place), F.lit(-1))).drop("_edges")
    else:
        docs = docs.withColumn("_range", F.when(F.col(key).isNull(), -1).otherwise(0))
    # At most one row for each range.
    tops = docs.groupBy("_range").agg(F.max(key).alias("top")).orderBy(F.desc("_range")).collect()
    if not tops:
        return docs.withColumn("next", F.struct(*carried)).drop("_range")
    ranges = [r["_range"] for r in tops]
    before = dict(zip(ranges, [ranges[-1], *ranges[:-1]]))
    top = F.create_map(*[x for r in tops for x in (F.lit(r["_range"]), F.lit(r["top"]).cast("bigint"))])
    goes = F.create_map(*[x for r, b in before.items() for x in (F.lit(r), F.lit(b))])
    own = F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest"))
    guest = F.struct(goes[F.col("_range")].alias("at"), F.lit(1).alias("guest"))
    spread = docs.withColumn("_to", F.explode(
        F.when(F.col(key).eqNullSafe(top[F.col("_range")]), F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy(F.col("_to.at")).orderBy(
        F.col("_to.guest"), F.desc_nulls_last(key), F.desc_nulls_last(tie))
    return (spread.withColumn("next", F.lead(F.struct(*carried)).over(order))
            .where("_to.guest = 0").drop("_to", "_range"))


def fingerprint_edits(docs: DataFrame, width: int = 5) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they come.

    The edited text has the last half of the code points (rounded down) replaced by as many
    first ones of the next text (or all it has), by descending ``doc_id``; the first follows
    the last. A null text is empty; an empty or wordless text has the fingerprint ''. Null ids
    come last and rows that share an id are ordered by their text; a single row follows
    itself; an empty table gives no rows. Other columns are ignored and texts taken whole.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_fingerprint(rows, "text", "fingerprint", width)
    rows = with_next(rows, "doc_id", "text", ["text", "fingerprint"], 4 * max(shuffle_width(docs.sparkSession), 4))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "fingerprint", F.col("next.fingerprint").alias("next_fingerprint"),
        F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.col("next.text"), F.lit(1), half)).alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint", width)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
