"""SpotSigs document fingerprints.

A signature is an anchor (a very common word) and the chain of the next
``CHAIN`` content words after it; a document's fingerprint is the set of its
signatures (64-bit hashes, sorted). Sets are compared by Jaccard likeness.

``classes`` finds alike documents anywhere in a table. Sets are partitioned
by length into ranges so wide that alike sets lie in one or in neighbouring
ranges. Any two alike sets share one of their rarest signatures (as many as
may be missing, and one), so only sets that share one of those meet, in a
bucket of signature and range; those of unlike lengths are pruned, the others
verified. The classes are the connected components of what is left.
In a bucket every set is first held against the bucket's smallest; after
that only sets of different classes are compared, so a large group of near
copies costs a comparison each. The registered query compares a document
with its edited self and its neighbour in full and has no class column.

Main path: SQL functions only, a few array passes over each text, linear in
its length. ``with_next`` pairs each document with the one that follows in
descending id order by one shuffle of the texts: ids are cut into ranges at
quantiles, a window looks ahead inside a range, and the first row of each
range is also sent to the range before it.

Defined cases: a null text counts as empty; a text without a chain has one
signature, the hash of its words (or of the text when it has no word); an
empty text has none; two empty sets are alike 1, an empty and a full set 0;
documents with one id follow each other by text hash, null ids come last;
a single document is followed by itself; repeated rows each get a result;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstats.llm.common import cut, spare, topmost
from trendstats.llm.graph import connected_components

CHAIN = 3
RANGE_ROWS = 5_000  # documents in an id range, about
RANGES = 20_000  # id ranges, at most
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Anchors: common function words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "were", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und",
    "von", "zu",
    "au", "aux", "dans", "de", "du", "en", "et", "la", "le", "les", "ne", "pas", "pour", "que", "qui", "sur", "un", "une",
    "al", "con", "del", "el", "los", "las", "no", "para", "por", "se", "su", "y",
)


def with_signatures(df: DataFrame, into: str, text: Column, anchors=ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``df`` with the sorted signature set (array<long>) in ``into``.

    The words and the content words are columns of their own, each read
    more than once by the next step, so that they are computed once a row.
    """
    common = sorted(set(anchors))
    words, content, at, found = (spare(df, f"{into}_{n}") for n in ("words", "content", "at", "found"))
    text = F.coalesce(text, F.lit(""))
    out = df.withColumn(words, F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
    out = out.withColumns(
        {
            content: F.filter(words, lambda w: ~w.isin(common)),
            at: F.filter(F.transform(words, lambda w, i: F.when(w.isin(common), i)), lambda i: i.isNotNull()),
        }
    )
    # j anchors come before the anchor at p, so p - j content words do
    chains = F.transform(
        at,
        lambda p, j: F.when(
            p - j + chain <= F.size(content),
            F.xxhash64(F.get(words, p), F.slice(content, p - j + 1, F.lit(chain))),
        ),
    )
    out = out.withColumn(found, F.sort_array(F.array_distinct(F.array_compact(chains))))
    whole = F.array(F.when(F.size(words) > 0, F.xxhash64(F.array_join(words, " "))).otherwise(F.xxhash64(text)))
    sets = F.when(F.size(found) > 0, F.col(found)).when(F.length(text) > 0, whole).otherwise(F.array().cast("array<bigint>"))
    return out.withColumn(into, sets).drop(words, content, at, found)


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets, 0 where the set lengths alone
    show that it is below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    full = shared / (F.size(a) + F.size(b) - shared)
    return (
        F.when(large == 0, 1.0).when(small == 0, 0.0).when(small < large * F.lit(least), 0.0).otherwise(full).cast("double")
    )


def _met(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` of ``rows`` that are verified to be alike."""
    rows = rows.distinct()
    a = sets.select(F.col("set").alias("a"), F.col("sigs").alias("x"))
    b = sets.select(F.col("set").alias("b"), F.col("sigs").alias("y"))
    near = likeness(F.col("x"), F.col("y"), least)
    return rows.join(a, "a").join(b, "b").where(near >= least).select("a", "b")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, hot: int = 1000, sample: int = 20_000
) -> DataFrame:
    """``(doc_id, class_id)`` for each row: the smallest id of its class of
    documents that are alike ``least`` or more, directly or by others.

    The ``hot`` most frequent signatures of about ``sample`` sets are ranked
    as least rare; the ranking changes the work, never the result.
    """
    slim = with_signatures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")), "sigs", F.col("t"))
    slim = cut(slim.select("doc_id", "sigs"))
    sets = slim.groupBy("sigs").agg(F.min("doc_id").alias("first_id"))
    sets = cut(sets.withColumn("set", F.monotonically_increasing_id()))
    some = max(1, sets.count() // sample)
    seen = sets.where(F.pmod(F.xxhash64("set"), F.lit(some)) == 0).select(F.explode("sigs").alias("s"))
    often = seen.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = topmost(often, hot, F.desc("n"), "s").collect()
    last = F.array(*[F.lit(r["s"]) for r in reversed(often)]).cast("array<bigint>")
    size = F.size("sigs")
    rare = F.concat(F.array_except("sigs", last), F.array_intersect(last, F.col("sigs")))
    # alike sets share least * size signatures of either
    rare = F.slice(rare, F.lit(1), size - F.ceil(size * F.lit(least) - F.lit(1e-9)).cast("int") + 1)
    band = F.floor(F.log(size.cast("double")) / F.lit(-math.log(least)) + F.lit(1e-9)).cast("int")
    held = sets.where(size > 0).select("set", size.alias("n"), band.alias("band"), F.explode(rare).alias("s"))
    # a set meets its own range and the next
    dealt = held.select("set", "n", "s", F.explode(F.array("band", F.col("band") + 1)).alias("r"), "band")
    sizes = dealt.groupBy("s", "r").agg(F.count(F.lit(1)).alias("m"), F.min("set").alias("pivot")).where("m > 1")
    dealt = cut(dealt.join(sizes, ["s", "r"]).select("s", "r", "set", "n", "band", "pivot"))
    first = dealt.where("set != pivot").select(F.col("pivot").alias("a"), F.col("set").alias("b"))
    links = cut(_met(first, sets, least))
    known = connected_components(links).withColumnRenamed("node", "set")
    marked = dealt.join(known, "set", "left").withColumn("c", F.coalesce("component", "set"))
    # the largest class of a bucket is never compared with itself
    tops = marked.groupBy("s", "r", "c").agg(F.count(F.lit(1)).alias("m"))
    tops = tops.groupBy("s", "r").agg(F.max_by("c", F.struct("m", "c")).alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1")
    marked = cut(marked.join(tops, ["s", "r"]).select("s", "r", "set", "n", "band", "c", "top"))
    a = marked.where("c != top").select("s", "r", *[F.col(x).alias(x + "_a") for x in ("set", "n", "band", "c")])
    ratio = F.least("n", "n_a") >= F.greatest("n", "n_a") * F.lit(least) - F.lit(1e-9)
    pairs = a.join(marked, ["s", "r"]).where(ratio & (F.col("c") != F.col("c_a")))
    pairs = pairs.select(F.least("set", "set_a").alias("a"), F.greatest("set", "set_a").alias("b"))
    links = links.union(_met(pairs, sets, least))
    comps = connected_components(links).withColumnRenamed("node", "set")
    named = sets.join(comps, "set", "left").select("sigs", "first_id", F.coalesce("component", "set").alias("c"))
    ids = named.groupBy("c").agg(F.min("first_id").alias("class_id"))
    return slim.join(named.join(ids, "c").select("sigs", "class_id"), "sigs").select("doc_id", "class_id")


def text_of(signatures: Column) -> Column:
    """The fingerprint as text: 16 hex digits a signature."""
    return F.lower(F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s), 16, "0")), ""))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds below ``key`` (binary search)."""
    if not bounds:
        return F.lit(0)
    values = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halve(acc: Column, _: Column) -> Column:
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.get(values, mid) < key
        open_ = acc["lo"] < acc["hi"]
        return F.struct(
            F.when(open_ & below, mid + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(open_ & ~below, mid).otherwise(acc["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.coalesce(F.aggregate(steps, start, halve, lambda acc: acc["lo"]), F.lit(0))


def with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``doc_id``, ``text``, ``sigs`` and ``next_text``, ``next_sigs`` of the
    next document in descending id order (after the last: the first)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = slim.select("doc_id")
    n = ids.count()
    ranges = max(1, min(RANGES, n // range_rows))
    cuts = [F.lit(i / ranges) for i in range(1, ranges)]
    bounds, top = [], None
    if n:
        # range bounds are ids that occur, so no range in between is empty
        marks = F.percentile_approx("doc_id", F.array(*cuts), 10 * RANGES) if cuts else F.lit(None)
        row = ids.agg(marks.alias("b"), F.max("doc_id").alias("top")).first()
        top = row["top"]
        bounds = sorted({b for b in row["b"] or [] if b != top})
    own = _range_of(F.col("doc_id"), bounds)
    # the largest id of a range is the next document of the range above
    places = [F.struct(own.alias("range"), F.lit(0).alias("role"))]
    if bounds:
        edge = F.array_contains(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("doc_id"))
        places.append(F.when(edge, F.struct((own + 1).alias("range"), F.lit(1).alias("role"))))
    first = F.col("doc_id").isNull() if top is None else F.col("doc_id") == F.lit(top)
    places.append(F.when(first, F.struct(F.lit(0).alias("range"), F.lit(2).alias("role"))))
    dealt = slim.select("doc_id", "text", F.explode(F.array_compact(F.array(*places))).alias("p"))
    dealt = dealt.select("doc_id", "text", "p.range", "p.role").repartition("range")
    signed = with_signatures(dealt, "sigs", F.col("text"))
    order = Window.partitionBy("range").orderBy("role", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    ahead = signed.withColumns({"next_text": F.lead("text").over(order), "next_sigs": F.lead("sigs").over(order)})
    return ahead.where("role = 0").select("doc_id", "text", "sigs", "next_text", "next_sigs")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half (rounded down, in code points) replaced by
    as many first code points of ``other``, or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(other, half))
