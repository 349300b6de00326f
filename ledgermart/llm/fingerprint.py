"""Document fingerprints by order MinHash. DataFrame functions only.

A text's word k-mers are numbered by occurrence, so that repeats count. Hashing deals the
numbered k-mers to ``slots``, and within a slot to LANES; a slot's tuple takes each
lane's k-mer of least hash, in the order in which they stand in the text, and hashes them
together. Moving, adding or dropping words therefore changes tuples, as with edit distance, and
the share of equal tuples estimates likeness.

A document and its successor meet in ordered buckets; each bucket also gets the first
document of the next one. One shuffle of the texts by bucket serves all that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermart.llm.common import order_bounds, order_bucket

WORDS = 3
SLOTS = 64
LANES = 2
#: Documents in a bucket, about; a task sorts the k-mers of one bucket.
BUCKET_DOCS = 128


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def kmers(words: str, k: int = WORDS) -> Column:
    """Hashes of the k-mers of an array column of words; of fewer words, one of them all; none without words."""
    w = F.col(words)
    several = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + j) for j in range(k)]))
    one = F.array(F.xxhash64(F.array_join(w, " ")))
    return F.when(F.size(w) >= k, several).when(F.size(w) > 0, one).otherwise(F.array().cast("array<bigint>"))


def _in_buckets(docs: DataFrame, bucket_docs: int) -> tuple[DataFrame, int]:
    """(bucket, guest, doc_id, text): every row in its bucket, and as a guest the first row of the bucket after it."""
    n = docs.count()
    bounds = order_bounds(docs, "doc_id", n, bucket_docs)
    own = docs.withColumn("bucket", order_bucket(F.col("doc_id"), bounds))
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))
    firsts = [(r["bucket"], r["first"]["doc_id"]) for r in own.groupBy("bucket").agg(least.alias("first")).orderBy("bucket").collect()]  # at most one a bucket
    guests = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]  # of the first bucket, to the last
    hosts = docs.sparkSession.createDataFrame(guests, "first_id long, bucket int")
    invited = docs.join(F.broadcast(hosts), docs["doc_id"].eqNullSafe(F.col("first_id")))
    invited = invited.groupBy("bucket", "doc_id").agg(F.min(F.struct("text"))["text"].alias("text"))
    rows = own.withColumn("guest", F.lit(False)).unionByName(invited.withColumn("guest", F.lit(True)))
    return rows, len(bounds) + 1


def edited_text(text: Column, following: Column) -> Column:
    """The last quarter of the characters replaced by as many, or all, of the next text's first."""
    quarter = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - quarter), F.substring(following, F.lit(1), quarter))


def _likeness(a: str, b: str) -> Column:
    """Equal tuples among the slots that either fingerprint uses; 1 of two empty ones."""
    used = F.bit_count(F.col(f"{a}_used").bitwiseOR(F.col(f"{b}_used")))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(f"{a}_tuples", f"{b}_tuples")) / used)


def _written(tuples: str) -> Column:
    """Tuples as ten hex digits each: the slot's two and the hash's eight."""
    return F.array_join(F.transform(F.array_sort(tuples), lambda t: F.lpad(F.lower(F.hex(t)), 10, "0")), "")


def with_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, slots: int = SLOTS, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after it by doc_id, nulls first; rows that share a doc_id
    are ordered by their text; after the last comes the first, so a single row follows
    itself. Null texts are empty. Texts without words have the empty fingerprint, which
    is like itself only. Other columns of ``docs``, whatever their names, aren't read.
    """
    if not 1 <= slots <= 64:
        raise ValueError("slots must be from 1 to 64")
    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, buckets = _in_buckets(kept, bucket_docs)
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    placed = rows.repartition(buckets, "bucket").select(
        "bucket", "guest", "doc_id", "text", F.row_number().over(order).alias("at"), F.lead("text").over(order).alias("following")
    )
    sides = placed.withColumn("edited", edited_text(F.col("text"), F.coalesce("following", F.lit(""))))
    sides = sides.withColumn("own_words", words_of(F.col("text"))).withColumn("edit_words", words_of(F.when(~F.col("guest"), F.col("edited")).otherwise("")))
    sides = sides.withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    # three lists of numbers of each document: what is known of it, its own k-mers, its edited text's
    sha = [F.conv(F.substring("sha", 1 + 16 * i, 16), 16, -10).cast("long") for i in range(4)]
    known = F.array("doc_id", F.col("guest").cast("long"), F.char_length("text").cast("long"), *sha)
    lists = F.array(known, kmers("own_words", words), kmers("edit_words", words))
    each = sides.select("bucket", "at", F.posexplode(lists).alias("side", "numbers")).select("bucket", "at", "side", F.posexplode("numbers").alias("place", "number"))
    # led by the k-mer's hash, which sorts fast; the bucket's partitioning serves
    turn = F.row_number().over(Window.partitionBy("number", "bucket", "at", "side").orderBy("place"))
    fact = F.col("side") == 0
    hashed = each.withColumn("hash", F.xxhash64("number", turn))
    dealt = hashed.select(
        "bucket",
        "at",
        "side",
        "place",
        F.when(fact, F.col("place")).otherwise(F.pmod("hash", F.lit(slots)).cast("int")).alias("slot"),
        F.when(fact, F.lit(0)).otherwise(F.pmod(F.shiftright("hash", 8), F.lit(LANES)).cast("int")).alias("lane"),
        F.when(fact, F.col("number")).otherwise(F.col("hash")).alias("rank"),
    )
    # a lane's least hash, and where in the text it stands
    own = lambda i, c: F.when(F.col("lane") == i, F.col(c))
    lanes = [c for i in range(LANES) for c in (F.min(own(i, "rank")).alias(f"lane_{i}"), F.min_by(own(i, "place"), own(i, "rank")).alias(f"place_{i}"))]
    least = dealt.groupBy("bucket", "at", "side", "slot").agg(*lanes)
    taken = [F.when(F.col(f"lane_{i}").isNotNull(), F.struct(F.col(f"place_{i}").alias("place"), F.col(f"lane_{i}").alias("hash"))) for i in range(LANES)]
    ordered = F.array_sort(F.array_compact(F.array(*taken)))
    mixed = F.xxhash64(F.transform(ordered, lambda r: r["hash"])).bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.shiftleft(F.col("slot").cast("long"), 32))
    tuples = least.select("bucket", "at", "side", "slot", "lane_0", F.when(~fact, mixed).alias("tuple"))
    used = F.expr("shiftleft(1L, slot)")
    facts = {n: F.min(F.when(fact & (F.col("slot") == i), F.col("lane_0"))) for i, n in enumerate(("doc_id", "guest", "n_chars", "sha_0", "sha_1", "sha_2", "sha_3"))}
    prints = tuples.groupBy("bucket", "at").agg(
        *[c.alias(n) for n, c in facts.items()],
        *[F.collect_list(F.when(F.col("side") == i, F.col("tuple"))).alias(f"{n}_tuples") for i, n in ((1, "own"), (2, "edit"))],
        *[F.coalesce(F.bit_or(F.when(F.col("side") == i, used)), F.lit(0).cast("long")).alias(f"{n}_used") for i, n in ((1, "own"), (2, "edit"))],
    )
    after = Window.partitionBy("bucket").orderBy("at")
    pairs = prints.withColumns({f"next_{c}": F.lead(f"own_{c}").over(after) for c in ("tuples", "used")}).filter("guest = 0")
    return pairs.select(
        "doc_id",
        "n_chars",
        F.concat(*[F.lpad(F.lower(F.hex(f"sha_{i}")), 16, "0") for i in range(4)]).alias("edited_sha256"),
        _written("own_tuples").alias("fingerprint"),
        _written("edit_tuples").alias("edited_fingerprint"),
        _likeness("own", "edit").alias("near_edited"),
        _likeness("own", "next").alias("near_next"),
    )
