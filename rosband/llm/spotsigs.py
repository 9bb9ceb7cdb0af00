"""Operator 2: SpotSigs document fingerprints (DataFrame operations only).

A text is read as lower-cased words of letters and digits.  Every anchor (a common word) begins a spot signature:
the anchor and the chain of the next ``chain`` content words, common words passed over.  The set of hashed
signatures is the fingerprint; two texts are as alike as the Jaccard similarity of their sets.

Sets are compared pruned: the smaller size over the larger bounds the similarity from above, so sets whose bound is
below the threshold are never looked at.  For a threshold ``t`` all sets are partitioned by length so that sets
of one partition and the next hold every pair that the bound allows (``length_class``).

Defined cases: a null text is an empty text; a text without a whole chain has one signature, the hash of all its words,
so equal texts are alike (1) and others are not (0); rows that share doc_id and text are one document in the order
of documents, and each gets the result; among equal doc_id the order is by text hash; a null doc_id comes last;
one document alone is its own next one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosband.llm.common import let, text_or_empty, written

CHAIN = 2
_FIRST_ID = -(1 << 63)

# Common words (articles, prepositions, conjunctions, pronouns, auxiliaries) by language.
ANCHORS: dict[str, str] = {
    "en": "a an and are as at be but by can do for from had has have he her his i if in is it its my no not of on or our "
          "she so that the their there they this to was we were what when which who will with would you your",
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die du ein eine einen einer er es "
          "für hat ich ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über um und von war was "
          "wenn wie wir zu zum zur",
    "fr": "à au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou "
          "où par pas plus pour qu que qui sa se ses son sont sur un une vous",
    "es": "al como con de del el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o "
          "para pero por que se si sin su sus también un una y ya",
}


def anchor_list() -> list[str]:
    return sorted({w for words in ANCHORS.values() for w in words.split()})


def words(text: Column) -> Column:
    flat = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.split(flat, " ")


def signatures(text: Column, chain: int = CHAIN, anchors: list[str] | None = None) -> Column:
    """The sorted set of the text's spot signatures, as 32-bit hashes.

    The j-th common word (from 0) at word ``p`` has ``p - j`` content words before it, so its chain is the content words
    from ``p - j`` on: one pass over the words and one over the anchors."""
    common = anchors if anchors is not None else anchor_list()

    def parts(w: Column) -> Column:
        at = F.filter(F.transform(w, lambda x, i: F.when(x.isin(common), i)), lambda i: i.isNotNull())
        return F.struct(w.alias("w"), at.alias("at"), F.filter(w, lambda x: ~x.isin(common)).alias("content"))

    def chains(x: Column) -> Column:
        content = x["content"]

        def spot(p: Column, j: Column) -> Column:
            links = [F.get(content, p - j + k) for k in range(chain)]
            return F.when(links[-1].isNotNull(), F.hash(F.get(x["w"], p), *links))

        found = F.array_distinct(F.filter(F.transform(x["at"], spot), lambda h: h.isNotNull()))
        return let(found, lambda s: F.when(F.size(s) > 0, F.array_sort(s)).otherwise(F.array(F.hash(x["w"]))))

    return let(let(words(text), parts), chains)


def fingerprint(sigs: Column) -> Column:
    """The digest of a set: its size and the 64-bit hash of its sorted signatures; equal for equal sets only."""
    return F.concat(F.lpad(F.size(sigs).cast("string"), 7, "0"), F.lit("-"), F.lower(F.lpad(F.hex(F.xxhash64(sigs)), 16, "0")))


def length_class(size: Column, threshold: float) -> Column:
    """Sets at ``threshold`` or more are in the same class or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without comparing where their sizes keep it below ``threshold``."""
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    exact = let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    return F.when(bound < threshold, F.lit(0.0)).otherwise(exact)


def in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``key, text_hash, n, next_key, next_hash, prev_key, prev_hash, prev_n`` of every distinct document, where the next one
    follows in descending doc_id and the first follows the last.

    Thin rows are dealt to ranges of the order and written; neighbours within a range come from a window over that
    range, those across ranges from the ends of the ranges (one row each)."""
    text = text_or_empty()
    thin = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_ID)).alias("key"),
        F.xxhash64(text).alias("text_hash"),
        F.length(text).alias("n"),
    ).distinct()
    order = [F.col("key").desc(), F.col("text_hash")]
    count = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(thin.repartitionByRange(count, *order).withColumn("part", F.spark_partition_id()))
    own = F.struct("key", "text_hash", "n")
    inside = Window.partitionBy("part").orderBy(*order)
    least = F.struct(F.bitwise_not("key").alias("down"), F.col("text_hash").alias("h"))
    ends = ranged.groupBy("part").agg(F.min_by(own, least).alias("head"), F.max_by(own, least).alias("tail"))
    whole = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = Window.partitionBy(F.lit(0)).orderBy("part")
    ends = ends.select(
        "part",
        F.coalesce(F.lead("head").over(row), F.first("head").over(whole)).alias("after"),
        F.coalesce(F.lag("tail").over(row), F.last("tail").over(whole)).alias("before"),
    )
    near = ranged.withColumn("next", F.lead(own).over(inside)).withColumn("prev", F.lag(own).over(inside)).join(ends, "part")
    nxt, prev = F.coalesce("next", "after"), F.coalesce("prev", "before")
    return near.select(
        "key", "text_hash", "n",
        nxt["key"].alias("next_key"), nxt["text_hash"].alias("next_hash"),
        prev["key"].alias("prev_key"), prev["text_hash"].alias("prev_hash"), prev["n"].alias("prev_n"),
    )


def edited(text: Column, n: Column, beginning: Column) -> Column:
    """``text`` with its last ``floor(n / 2)`` code points replaced by ``beginning``."""
    return F.concat(F.substring(text, F.lit(1), n - F.floor(n / 2).cast("int")), beginning)


def digest(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likenesses."""
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_ID)).alias("key"), text_or_empty().alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    order = written(in_order(docs))
    placed = keyed.join(order, ["key", "text_hash"])
    # what the document before needs of this one: as many first code points as it loses, and the signatures
    handed = placed.dropDuplicates(["key", "text_hash"]).select(
        F.col("prev_key").alias("key"),
        F.col("prev_hash").alias("text_hash"),
        F.substring("text", F.lit(1), F.floor(F.col("prev_n") / 2).cast("int")).alias("beginning"),
        signatures(F.col("text"), chain).alias("next_sigs"),
    )
    both = placed.select("key", "text_hash", "n", "text").join(handed, ["key", "text_hash"])
    both = both.withColumn("other", edited(F.col("text"), F.col("n"), F.col("beginning")))
    sets = both.select(
        "key", "n", F.sha2("other", 256).alias("edited_sha256"), "next_sigs",
        F.inline(F.array(F.struct(
            signatures(F.col("text"), chain).alias("sigs"), signatures(F.col("other"), chain).alias("edited_sigs")
        ))),
    )
    return sets.select(
        F.expr(f"nullif(key, {_FIRST_ID + 1}L - 1L)").alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        length_class(F.size("sigs"), 0.8).alias("length_class"),
    )
