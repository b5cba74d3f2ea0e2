"""Exact document fingerprints: Unicode normalisation, case and blank folding, two 64-bit xxhash lanes, and a byte comparison of what shares a digest.

All of it is DataFrame expressions. Two texts get one fingerprint exactly when their canonical forms are the same
bytes: a bucket of equal digests that holds different canonical texts (none has been seen at 128 bits) gives each
of them a suffix of its own.

Defined results: a null text counts as empty; the empty text has a fingerprint like any other; rows with the same id
are kept and ordered by text; a null id sorts first; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.storage import cut, small_or_shuffled

#: Unicode White_Space.
BLANKS = r"[\u0009-\u000D\u0020\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
#: Documents whose ids share all bits above these lie in one partition when neighbours are looked up.
NEIGHBOUR_BITS = 8
_ICU, _FOLD = "com.ibm.icu.text.Normalizer", "com.ibm.icu.lang.UCharacter"


def canonical(text: Column) -> Column:
    """NFKC, full case folding, NFKC again; runs of blanks become one space, none at the ends. Null gives the empty text."""
    compose = lambda c: F.reflect(F.lit(_ICU), F.lit("compose"), c, F.lit(True))
    folded = compose(F.reflect(F.lit(_FOLD), F.lit("foldCase"), compose(F.coalesce(text, F.lit(""))), F.lit(True)))
    return F.trim(F.regexp_replace(folded, BLANKS, " "))


def lanes(canon: Column, bits: int = 64) -> Column:
    """The digest of a canonical text: two xxhash64 lanes of different seeds. Fewer bits, and one lane, are for tests of collisions."""
    if bits < 64:
        return F.struct(F.shiftrightunsigned(F.xxhash64(canon), 64 - bits).alias("a"), F.lit(0).cast("long").alias("b"))
    return F.struct(F.xxhash64(canon).alias("a"), F.xxhash64(F.lit("second lane"), canon).alias("b"))


def _hex(h: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(h["a"]), 16, "0"), F.lpad(F.hex(h["b"]), 16, "0")))


def clashes(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """texts(h, canon), shared(h): the digests that occur twice -> (h, canon, variant) of those that different canonical texts share.

    Only texts whose digest occurs twice move; copies are folded before the shuffle, so a hot group sends one row a task.
    """
    distinct = texts.join(shared, "h", "left_semi").groupBy("h", "canon").agg(F.lit(1).alias("one"))
    clash = distinct.groupBy("h").agg(F.sum("one").alias("n")).where("n > 1").select("h")
    rank = F.row_number().over(Window.partitionBy("h").orderBy("canon")) - 1
    return distinct.join(clash, "h", "left_semi").select("h", "canon", rank.alias("variant"))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", bits: int = 64) -> DataFrame:
    """df with the column out: equal exactly where the canonical texts are equal."""
    own = df.withColumn("__h", lanes(canonical(F.col(text)), bits))
    shared = small_or_shuffled(own.groupBy(F.col("__h").alias("h")).count().where("count > 1").select("h"))
    found = cut(clashes(df.select(lanes(canonical(F.col(text)), bits).alias("h"), canonical(F.col(text)).alias("canon")), shared))
    if found.isEmpty():
        return own.withColumn(out, _hex(F.col("__h"))).drop("__h")
    keyed = own.withColumn("__c", canonical(F.col(text)))
    return _with_variant(keyed, found, "__h", "__c", out).drop("__h", "__c")


def _with_variant(df: DataFrame, found: DataFrame, h: str, canon: str, out: str) -> DataFrame:
    known = found.select(F.col("h").alias("__kh"), F.col("canon").alias("__kc"), F.col("variant").alias("__kv"))
    joined = df.join(known, (F.col(h) == F.col("__kh")) & (F.col(canon) == F.col("__kc")), "left")
    suffix = F.when(F.coalesce(F.col("__kv"), F.lit(0)) > 0, F.concat(F.lit("-"), F.col("__kv").cast("string"))).otherwise(F.lit(""))
    return joined.withColumn(out, F.concat(_hex(F.col(h)), suffix)).drop("__kh", "__kc", "__kv")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """(fingerprint, keeper, copies): the groups of canonically equal texts, each with its smallest id."""
    marked = fingerprint(df.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")), "__text", bits=bits)
    return marked.groupBy("fingerprint").agg(F.min("__id").alias("keeper"), F.count(F.lit(1)).alias("copies"))


def successor(keys: DataFrame, levels: int = 2) -> DataFrame:
    """keys(k), distinct longs -> (k, next): the next larger key, null after the last. Windows span 65,536 possible keys; what crosses them goes up a level."""
    if not levels:
        return keys.select("k", F.lead("k").over(Window.orderBy("k")).alias("next"))
    grouped = keys.withColumn("g", F.shiftright("k", 16))
    inner = grouped.select("k", "g", F.lead("k").over(Window.partitionBy("g").orderBy("k")).alias("inner"))
    heads = grouped.groupBy("g").agg(F.min("k").alias("head"))
    above = successor(heads.select(F.col("g").alias("k")), levels - 1).select(F.col("k").alias("g"), F.col("next").alias("ng"))
    beyond = above.join(heads.withColumnRenamed("g", "ng"), "ng").select("g", "head")
    return inner.join(beyond, "g", "left").select("k", F.coalesce("inner", "head").alias("next"))


def with_next(docs: DataFrame, carried: list[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """derive(docs(doc_id, text)) with next_<c> for each carried column: that of the next document by doc_id, the first after the last.

    One shuffle of the rows, by the high bits of doc_id: a window spans 256 ids. The last row of each takes its
    neighbour from the first row of the next bucket in use, the only rows that move again.
    """
    rows = docs.withColumn("k", F.coalesce(F.shiftright("doc_id", NEIGHBOUR_BITS), F.lit(-(1 << 62)).cast("long")))
    w = Window.partitionBy("k").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    inside = derive(rows).select("*", *(F.lead(c).over(w).alias(f"in_{c}") for c in carried))
    heads = derive(rows.withColumn("rn", F.row_number().over(w)).where("rn = 1")).select("k", *carried)
    used = rows.groupBy("k").agg(F.lit(1).alias("one")).select("k")
    first = used.agg(F.min("k").alias("first"))
    after = successor(used).crossJoin(F.broadcast(first)).select("k", F.coalesce("next", "first").alias("nk"))  # first: one row
    borrowed = after.join(heads.withColumnRenamed("k", "nk"), "nk").select("k", *(F.col(c).alias(f"out_{c}") for c in carried))
    last = F.col("in_text").isNull()
    return inside.join(borrowed, "k", "left").select(*derive(docs).columns, *(F.when(last, F.col(f"out_{c}")).otherwise(F.col(f"in_{c}")).alias(f"next_{c}") for c in carried))


def _edited() -> Column:
    """The text whose last floor(n / 2) code points give way to the first as many (or all) of next_text."""
    half = F.floor(F.length("text") / 2).cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))


def _edits_again(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The edited texts of wanted(doc_id, next_doc_id), with doc_id, made anew from docs without moving the other texts."""
    ids = small_or_shuffled(wanted.select("doc_id", "next_doc_id").distinct())
    named = ids.select(F.col("doc_id").alias("own_id"), "next_doc_id")
    own = docs.join(named, F.col("doc_id").eqNullSafe(F.col("own_id"))).drop("own_id")
    after = docs.select(F.col("doc_id").alias("after_id"), F.col("text").alias("next_text")).join(ids.select(F.col("next_doc_id").alias("want_id")), F.col("after_id").eqNullSafe(F.col("want_id")), "left_semi")
    return own.join(after, F.col("next_doc_id").eqNullSafe(F.col("after_id"))).select("doc_id", _edited().alias("text"))


def neighbour_report(documents: DataFrame, bits: int = 64) -> DataFrame:
    """Fingerprints of every whole text and of its edited text (its second half replaced from the next document), and how they compare.

    An exact digest has only two likenesses: 1 for the same canonical text, 0 for any other.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(docs, ["doc_id", "text", "h"], lambda df: df.withColumn("h", lanes(canonical(F.col("text")), bits)))
    rows = pairs.select("doc_id", "next_doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode(_edited(), "UTF-8"), 256).alias("edited_sha256"), "h", lanes(canonical(_edited()), bits).alias("eh"), F.col("next_h").alias("nh"))
    rows = cut(rows)
    both = rows.select("h").unionAll(rows.select(F.col("eh").alias("h")))
    shared = small_or_shuffled(both.groupBy("h").count().where("count > 1").select("h"))
    edits = _edits_again(docs, rows.join(shared.select(F.col("h").alias("eh")), "eh", "left_semi"))
    texts = docs.unionAll(edits).select(canonical(F.col("text")).alias("canon")).select(lanes(F.col("canon"), bits).alias("h"), "canon")
    found = cut(clashes(texts, shared))
    if found.isEmpty():
        named = rows.select("*", _hex(F.col("h")).alias("fingerprint"), _hex(F.col("eh")).alias("edited_fingerprint"), _hex(F.col("nh")).alias("next_fingerprint"))
    else:
        full = pairs.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode(_edited(), "UTF-8"), 256).alias("edited_sha256"), "h", F.col("next_h").alias("nh"), canonical(F.col("text")).alias("c"), canonical(_edited()).alias("ec"), canonical(F.col("next_text")).alias("nc"))
        named = full.withColumn("eh", lanes(F.col("ec"), bits))
        for h, c, out in (("h", "c", "fingerprint"), ("eh", "ec", "edited_fingerprint"), ("nh", "nc", "next_fingerprint")):
            named = _with_variant(named, found, h, c, out)
    same = lambda other: (F.col("fingerprint") == F.col(other)).cast("double")
    return named.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", same("edited_fingerprint").alias("near_edited"), same("next_fingerprint").alias("near_next"))
