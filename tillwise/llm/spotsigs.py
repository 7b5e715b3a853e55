"""SpotSigs fingerprints: chains of content words that follow common words.

A signature is a common word (the anchor) with the next content words after it. Common words are
spread over running text but not over headings and navigation, so signatures sample the prose. All
of it is built-in expressions on arrays within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import land, let
from tillwise.llm.order import next_key

#: The anchors, common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to a in is that it for be by are was with as on from or an at this "
    "der die das und den dem des ein eine von zu im mit ist auf für als sich nicht auch "
    "le la les de du une et en que qui pour par dans sur avec au est "
    "el los las del y un una por con para se su es lo como no"
).split()
CHAIN = 2
#: Set sizes whose ratio is at least this fall in the same or in neighbouring partitions.
PARTITION_RATIO = 0.8
#: Classes in the list of one signature that meet in one task.
LIST_PART = 512
_FIRST_KEY = -(2**63)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct 32-bit signatures of ``text``.

    Texts in which no anchor is followed by ``chain`` content words use every run of ``chain``
    words instead, shorter ones their whole sequence; texts without words have no signature.
    """

    def chains(w: Column, anchors: Column, content: Column) -> Column:
        # the anchor at word p is the j-th, so p - j content words stand before it
        def one(p: Column, j: Column) -> Column:
            following = [F.get(content, p - j + i) for i in range(chain)]
            return F.when(p - j + chain <= F.size(content), F.hash(F.get(w, p), *following))

        return F.array_compact(F.transform(anchors, one))

    def plain(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - chain, F.lit(0))),
            lambda i: F.hash(*[F.get(w, i + k) for k in range(chain)]),
        )
        return F.when(F.size(w) > 0, runs).otherwise(F.array().cast("array<int>"))

    def of_words(w: Column) -> Column:
        anchors = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), i)))
        content = F.filter(w, lambda x: ~x.isin(ANCHORS))
        found = let(anchors, lambda a: let(content, lambda c: chains(w, a, c)))
        return let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(plain(w)))

    return F.array_sort(F.array_distinct(let(words(text), of_words)))


def fingerprint(signature_set: Column) -> Column:
    """The signatures as text: lower-case hex, in order, one space between."""
    return F.lower(F.array_join(F.transform(signature_set, lambda s: F.hex(s.cast("bigint").bitwiseAND(F.lit(2**32 - 1)))), " "))


def length_partition(signature_set: Column, ratio: float = PARTITION_RATIO) -> Column:
    """Number of the partition of set sizes; sets with a Jaccard likeness of ``ratio`` or more are
    at most one partition apart. Empty sets are in partition -1."""
    return _partition_of(F.size(signature_set), ratio)


def _partition_of(size: Column, ratio: float) -> Column:
    if ratio >= 1:
        return size - 1
    return F.when(size == 0, F.lit(-1)).otherwise(F.floor(F.log(size) / F.log(F.lit(1 / ratio)) + 1e-9).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; 1 for two empty sets. Always exact."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(let(F.size(F.array_intersect(a, b)), lambda c: c / (both - c)))


def classes_of(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with equal sets as one: (members, classes) of ``sets`` (doc_id, signatures).

    Members are (doc_id, class_id), one row for each row of ``sets``; classes are (class_id, n_documents,
    signatures). A class is named by its smallest doc_id, null if it has no other. Sets meet by a
    128-bit digest, so documents with many copies are reduced in each task first.
    """
    keyed = land(sets.select("doc_id", "signatures", F.md5(F.array_join("signatures", ",")).alias("key")))
    classes = land(
        keyed.groupBy("key").agg(
            F.min("doc_id").alias("class_id"), F.count("*").alias("n_documents"), F.first("signatures").alias("signatures")
        )
    )
    members = keyed.select("doc_id", "key").join(classes.select("key", "class_id"), "key").drop("key")
    return members, classes


def _rarest_first(classes: DataFrame, threshold: float) -> DataFrame:
    """(key, size, partition, signature, n): as many of a class's rarest signatures as a class alike must share one of.

    Two sets of a likeness of ``threshold`` or more differ in few signatures; under any one order of all
    signatures they share one among the first size - ceil(threshold * size) + 1 of each. The order is by
    how many classes (``n``) have the signature, then by its value.
    """
    size = F.size("signatures")
    listed = classes.select("key", size.alias("size"), F.explode("signatures").alias("signature"))
    counts = listed.groupBy("signature").agg(F.count("*").alias("n"))
    # a signature alone cannot be shared, but it holds its place in the order
    ordered = listed.join(counts, "signature").groupBy("key", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "signature"))).alias("ordered")
    )
    kept = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9).cast("int") + 1
    rare = F.filter(F.slice("ordered", F.lit(1), kept), lambda x: x["n"] > 1)
    return ordered.select(
        "key", "size", _partition_of(F.col("size"), threshold).alias("partition"), F.explode(rare).alias("entry")
    ).select("key", "size", "partition", "entry.signature", "entry.n")


def near_pairs(sets: DataFrame, threshold: float = PARTITION_RATIO) -> tuple[DataFrame, DataFrame]:
    """Which documents are near duplicates: (members, pairs) of ``sets`` (doc_id, signatures).

    Members are (doc_id, class_id) as of ``classes_of``. Pairs are (class_a, class_b, near), every pair of
    classes with a likeness of ``threshold`` (above 0) or more once; copies are not expanded. Documents
    without a signature are a class without pairs. Null ids and repeated rows are members like any other;
    no rows give none. Other columns are ignored.

    Partitions of the set size decide who meets: a class looks for others in the lists of its rarest
    signatures, in its own partition and the next one only, as sizes further apart rule the likeness out.
    Lists of frequent signatures are split into parts, so the longest of them is no task of its own.
    Candidates are pruned by their sizes and then compared by their whole sets. All of it is joins and
    expressions; the number of candidates grows with the pairs that share rare signatures.
    """
    members, classes = classes_of(sets)
    full = classes.where(F.size("signatures") > 0)
    rare = land(_rarest_first(full, threshold))
    parts = F.ceil(F.col("n") / LIST_PART).cast("int")
    listed = rare.select(
        F.col("key").alias("key_b"), F.col("size").alias("size_b"), F.col("partition").alias("partition_b"), "signature",
        F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"),
    )
    seeking = rare.select(
        F.col("key").alias("key_a"), F.col("size").alias("size_a"), F.col("partition").alias("partition_a"), "signature",
        F.explode(F.array(F.col("partition"), F.col("partition") + 1)).alias("partition_b"), parts.alias("parts"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    candidates = (
        seeking.join(listed, ["signature", "partition_b", "part"])
        .where((F.col("partition_a") < F.col("partition_b")) | (F.col("key_a") < F.col("key_b")))
        .where(small >= large * threshold - 1e-9)
        .select("key_a", "key_b")
        .distinct()
    )

    def side(name: str) -> DataFrame:
        return full.select(
            F.col("key").alias(f"key_{name}"), F.col("class_id").alias(f"class_{name}"), F.col("signatures").alias(f"set_{name}")
        )

    compared = candidates.join(side("a"), "key_a").join(side("b"), "key_b").select(
        "class_a", "class_b", likeness(F.col("set_a"), F.col("set_b")).alias("near")
    )
    return members, compared.where(F.col("near") >= threshold - 1e-12)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text), of its edited text and of the next document.

    The next document is the one with the next smaller doc_id, after the last the first. The edited
    text has its last floor(n/2) code points replaced by the first as many of the next document
    (all, if it has fewer). Columns: doc_id, n_chars, edited (text), signatures, edited_signatures,
    next_signatures (int arrays), next_doc_id.

    Null texts are empty. Repeated ids give one row per row; as a next document such an id stands
    for the text with the smallest hash. Null ids come last. One row is its own next; an empty
    table gives no rows. Other columns are ignored.

    Order is worked out on ids alone. Texts are shuffled once by id; what a document lends to the
    one before it, half a text at most and the signatures, is shuffled a second time.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.coalesce("doc_id", F.lit(_FIRST_KEY)).alias("key"), F.col("doc_id").alias("id"), text.alias("body")
    )
    ids = base.select("key", F.xxhash64("body").alias("h"), F.length("body").alias("n")).groupBy("key").agg(
        F.min("h").alias("h"), F.max("n").alias("n")
    )
    order = next_key(ids).join(ids, "key")
    wanted = order.select(
        F.col("next").alias("key"), F.col("key").alias("for"), F.floor(F.col("n") / 2).cast("int").alias("need")
    ).join(ids.select("key", "h"), "key")
    lent = (
        base.join(wanted, "key")
        # not an equality, which would become a second join key and a second shuffle of the texts
        .where(F.xxhash64("body").bitwiseXOR(F.col("h")) == 0)
        .select(
            F.col("for").alias("key"),
            F.col("id").alias("next_doc_id"),
            F.substring("body", F.lit(1), F.col("need")).alias("head"),
            signatures(F.col("body")).alias("next_signatures"),
        )
        .dropDuplicates(["key"])
    )
    half = F.floor(F.length("body") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("body"), F.lit(1), F.length("body") - half), F.substring(F.col("head"), F.lit(1), half)
    )
    return (
        base.join(lent, "key")
        .select("id", "body", edited.alias("edited"), "next_doc_id", "next_signatures")
        .select(
            F.col("id").alias("doc_id"),
            F.length("body").cast("bigint").alias("n_chars"),
            "edited",
            signatures(F.col("body")).alias("signatures"),
            signatures(F.col("edited")).alias("edited_signatures"),
            "next_signatures",
            "next_doc_id",
        )
    )
