"""I-Match fingerprints with Spark expressions only.

A text's terms are its distinct lower-case words of letters and digits, each known by its XXH64. The lexicon keeps the terms
whose inverse document frequency lies in a band: no more than COMMON of the documents have them, and at least so many that
no more than LEXICON terms can (the mean number of distinct terms of a document, divided by LEXICON, is the least share of
documents). So the lexicon has a proven bound at every size. A fingerprint has a part for the lexicon and one for each random
subset of it: a hash of the text's sorted distinct terms in that subset. Subsets come in scales; one of scale s keeps a term
in 2 ** SCALES[s], and a scale has CELLS subsets at most. A text takes the scales at which a subset has DENSE of its terms or
fewer on average: denser parts change with every edit. So texts of any length have parts that an edit leaves alone.

The likeness of two fingerprints is the share of equal parts among those where either has terms, over the scales that both
take. Texts without any term of the lexicon use all their terms; texts without any term have no parts, and are like each other
only.

Defined cases: null text is empty; repeated rows and equal ids are ordered by a hash of their text; a null id comes last; an
only row's next row is itself; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import checkpointed, forget, written

LEXICON = 32_768
COMMON = 0.05
SLOTS = 1 << 13
SCALES = (4, 6, 8, 10, 12, 14)
CELLS = 64
DENSE = 2
#: Bits of a part that hold its hash; those above say which part it is.
HASH_BITS = 44


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1)
    return F.array_distinct(F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame) -> DataFrame:
    """One row (slots): the terms of the band, dealt into SLOTS lists by their last bits."""
    frequency = written(texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n")))
    documents, pairs = texts.count(), frequency.agg(F.sum("n")).first()[0] or 0
    least = max(2.0, pairs / LEXICON)  # the sum of all n is pairs, so no more than LEXICON terms have it
    kept = frequency.filter((F.col("n") >= least) & (F.col("n") <= max(2.0, COMMON * documents))).select("term", F.pmod("term", F.lit(SLOTS)).alias("slot"))
    filled = kept.groupBy("slot").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    every = texts.sparkSession.range(SLOTS).withColumnRenamed("id", "slot").join(filled, "slot", "left")
    rows = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms"))))
    out = checkpointed(every.agg(F.transform(rows, lambda r: r["terms"]).alias("slots")))
    forget(frequency)
    return out


def parts(known: Column) -> Column:
    """Struct (first, parts): the first scale that the text takes, and its parts, each a subset and a hash in one long."""

    def part(which: Column, mine: Column) -> Column:
        return F.shiftleft(which.cast("long"), HASH_BITS).bitwiseOR(F.shiftrightunsigned(F.xxhash64(mine), 64 - HASH_BITS))

    def of_scale(s: int, at: int, bits: int) -> Column:
        cell = lambda t: F.shiftrightunsigned(t, at).bitwiseAND(F.lit((1 << bits) - 1))
        mine = F.filter(known, lambda t: cell(t) < CELLS) if 1 << bits > CELLS else known
        cells = F.array_distinct(F.transform(mine, cell))
        return F.transform(cells, lambda c: part(c + ((s + 1) << 14), F.filter(mine, lambda t: cell(t) == c)))

    found, at = [F.when(F.size(known) > 0, F.array(part(F.lit(0), known))).otherwise(F.array().cast("array<long>"))], 0
    for s, bits in enumerate(SCALES):
        found.append(F.when(F.size(known) <= DENSE << bits, of_scale(s, at, bits)).otherwise(F.array().cast("array<long>")))
        at += bits
    first = sum(F.when(F.size(known) > DENSE << bits, 1).otherwise(0) for bits in SCALES)
    return F.struct(first.alias("first"), F.concat(*found).alias("parts"))


def with_parts(texts: DataFrame, text: str, slots: Column, out: str) -> DataFrame:
    """The fingerprint's parts of a text column as column out.

    Steps of their own, so that each is computed once; the lexicon, a scalar subquery, is used in the step that adds it, and
    no row carries it.
    """
    rest = [c for c in texts.columns if c != out]
    every = texts.select(*rest, terms(F.col(text)).alias("_every")).select("*", slots.alias("_slots"))
    mine = F.filter("_every", lambda t: F.array_contains(F.get(F.col("_slots"), F.pmod(t, F.lit(SLOTS)).cast("int")), t))
    kept = every.select(*rest, "_every", mine.alias("_kept"))
    known = kept.select(*rest, F.array_sort(F.when(F.size("_kept") > 0, F.col("_kept")).otherwise(F.col("_every"))).alias("_known"))
    return known.select(*rest, parts(F.col("_known")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    first = F.greatest(a["first"], b["first"])
    which = lambda p: F.shiftrightunsigned(p, HASH_BITS)
    mine = lambda x: F.filter(x["parts"], lambda p: (which(p) == 0) | (which(p) >= F.shiftleft((first + 1).cast("long"), 14)))
    said = F.size(F.array_union(F.transform(mine(a), which), F.transform(mine(b), which)))
    return F.when(said > 0, F.size(F.array_intersect(mine(a), mine(b))) / said).otherwise(1.0)


def shown(p: Column) -> Column:
    return F.concat(p["first"].cast("string"), F.lit(":"), F.array_join(F.transform(F.array_sort(p["parts"]), lambda x: F.lower(F.hex(x))), "."))


def _bounds(documents: DataFrame, n: int) -> Column:
    """n - 1 values of doc_id that part the rows into about equal counts, as a scalar array."""
    shares = ", ".join(f"{i / n:.9f}D" for i in range(1, max(2, n)))
    return checkpointed(documents.agg(F.expr(f"percentile_approx(cast(doc_id as bigint), array({shares}), {20 * n}) as bounds"))).scalar()


def _below(bounds: Column, value: Column) -> Column:
    """How many of the sorted bounds are below a value, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s <= F.size(bounds)) & (F.get(bounds, p + s - 1) < value), p + s).otherwise(p))


def with_next(documents: DataFrame, carried: list[str], prepared=lambda rows: rows) -> DataFrame:
    """Each row (with tie, a hash) with next_<column> of the row after it by descending doc_id; after the last comes the first.

    Rows are dealt into buckets by doc_id at counted bounds, one exchange; a bucket that holds a single id, or rows without
    one, is dealt on by tie. Each bucket also gets the row that follows it. prepared adds columns to rows before they move.
    """
    n = 4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # several a partition, so that partitions are of like size
    bounds = _bounds(documents, n)
    coarse = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + _below(F.col("_bounds"), F.col("doc_id").cast("long")))
    marked = lambda rows: rows.withColumn("_bounds", bounds).withColumn("coarse", coarse).drop("_bounds")
    counts = marked(documents.select("doc_id")).groupBy("coarse").agg(F.count("*").alias("n"), F.min("doc_id").eqNullSafe(F.max("doc_id")).alias("single"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    cells = checkpointed(counts.select("coarse", F.when(F.col("single"), F.ceil(F.col("n") * n / total)).otherwise(1).alias("of")))  # n + 1 rows at most
    place = F.least(F.col("of") - 1, F.floor((F.col("tie") / float(1 << 64) + 0.5) * F.col("of")))
    bucket = F.shiftleft(F.col("coarse").cast("long"), 32) + place
    dealt = lambda rows: marked(rows).join(F.broadcast(cells), "coarse").withColumn("bucket", bucket).drop("coarse", "of")
    first = F.max(F.struct("doc_id", "tie")).alias("head")
    heads = dealt(documents.select("doc_id", "tie")).groupBy("bucket").agg(first)  # a row for each bucket
    whole = Window.orderBy(F.desc("bucket"))
    top = F.first("head").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = heads.select("bucket", F.coalesce(F.lead("head").over(whole), top).alias("head"))
    follows = checkpointed(follows.select(F.col("bucket").alias("ghost_of"), F.coalesce("head.doc_id", F.lit(0)).alias("d"), F.col("head.doc_id").isNull().alias("n"), F.col("head.tie").alias("t")))
    match = (F.coalesce("doc_id", F.lit(0)) == F.col("d")) & (F.col("doc_id").isNull() == F.col("n")) & (F.col("tie") == F.col("t"))
    ghosts = documents.join(F.broadcast(follows), match).select(*documents.columns, F.col("ghost_of").alias("bucket"), F.lit(True).alias("ghost"))
    rows = prepared(dealt(documents).select(*documents.columns, "bucket", F.lit(False).alias("ghost")).unionByName(ghosts))
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]).filter(~F.col("ghost")).drop("bucket", "ghost")


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n / 2) code points replaced by the first as many of the next row's.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    slots = lexicon(texts).scalar()
    rows = texts.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    near = with_next(rows, ["text", "parts"], lambda rows: with_parts(rows, "text", slots, "parts"))
    made = near.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "parts", "next_parts")
    found = with_parts(made.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", slots, "edited_parts")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("parts")).alias("fingerprint"), shown(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"), likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
    )
