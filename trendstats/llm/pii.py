"""Personal data: candidate gradient boosting over fixed base patterns.

Base spans (email, ip, card, phone) come from patterns with validators.
Beyond them, high-recall generators propose overlapping candidate spans
(written-out addresses, digit runs with any separators). Boosted trees score
each candidate from its format and its context; a threshold calibrated per
kind selects the candidates to add. Base spans always stay.

The trees are fitted on the candidates of all documents, and
only on such as could be added, those that overlap no base span. Weak
labels: negatives are the candidates of the texts as they are, but for those
that a cue, a written-out separator or the Luhn check makes open; positives are
those that meet a base span after it was rewritten to a form that no base
pattern takes (written-out or spaced separators in addresses, numbers
without plus or with other separators), in its own context. One pass counts
the candidates that agree in kind, label and format; the trees weigh each
such row by its count, so no document and no candidate is left out. On the
candidates of a quarter of the ids, held out from the trees, each kind's threshold is the lowest score of
``LEAST_SCORE`` or more from which on the share of positives reaches
``PRECISION``; a kind without such a score adds nothing.

Scale: the pass over the documents ends in partial counts; what is shuffled
and fitted on are the distinct rows of candidates' formats. The driver sees
the trees and at most 101 bins a kind.

Main path: SQL functions only. Every document is scanned in place by one
projection (the fitted trees become a CASE expression), no shuffle. Match
positions come from splitting the text at the matches and adding up lengths,
so they are code points. The patterns are written with possessive
quantifiers and start at run beginnings, which keeps them linear and free of
deep recursion on very long texts; what they match is the same.

Defined cases: null and empty texts have no span; repeated rows each get a
result; documents with too few positive or negative candidates, or an empty
table, add no span beyond the base; other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import cut, spare

KINDS = ("email", "ip", "card", "phone")
LEAST = 30  # positives and negatives needed to fit
PRECISION = 0.99
LEAST_SCORE = 0.9
TREES, DEPTH = 8, 3
CHUNK = 256  # matches folded together
FIT_PARTITIONS = 32  # of the counted candidates, dealt by hash

# --- fixed values: the base patterns -----------------------------------------
# email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
# ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
# card  [0-9]([\x20-]?[0-9])+, 14 to 19 digits that pass Luhn
# phone \+[0-9][\x20().0-9-]+[0-9], 10 to 15 digits
# A match can only begin inside a run where it could begin at the run's start
# or where the last match ended (\G).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# --- end of fixed values -----------------------------------------------------

# Generators: address with a written-out or spaced separator; digit run.
_ADDRESS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:\x20?(?:@|\(at\)|\[at\])\x20?|\x20at\x20)"
    r"[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)[A-Za-z0-9-]++)++"
)
_NAMED = r"[^A-Za-z0-9-][A-Za-z][A-Za-z0-9-]*[A-Za-z0-9]$"  # the last part is no number ("at 5.30")
_NUMBER = r"\+?\(?[0-9](?:[\x20().:/-]{0,2}+[0-9])++"
_BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
_CUES = r"(?i)(?:mail|contact|tel|phone|call|fax|mobile|card|visa|credit|account|konto|iban|host|server|ip|ssn)[^A-Za-z]{0,12}$"
_SPAN = "struct<start:int,end:int,s:string,before:string,after:string>"
FEATURES = (
    "length", "digits", "letters", "separators", "plus", "parens", "dots", "colons", "ats", "luhn",
    "longest_group", "glued_before", "glued_after", "cue", "brackets",
)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn check of up to 19 digits."""
    back = F.reverse(digits)
    values = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda part: part.rlike(_BYTE))
    n = F.length(_digits(s))
    if kind == "phone":
        return n.between(10, 15)
    return F.when(n.between(14, 19), _luhn(_digits(s))).otherwise(False)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str, needs: Column, valid) -> Column:
    """Valid matches of ``pattern`` with code-point offsets, the 24
    characters before and the one after; none where ``needs`` is not true.

    Offsets are prefix sums in two levels: those of ``CHUNK`` matches from the
    chunk's start, and the chunks' from the text's, so that no array grows
    with the text match by match."""
    gaps = F.split(text, pattern, -1)
    rows = F.arrays_zip(
        gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("s"),
        F.slice(gaps, F.lit(2), F.lit(2**31 - 1)).alias("next"),
    )
    empty = F.array().cast(f"array<{_SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.length(x["s"])
        span = F.struct(
            start.alias("start"), end.alias("end"), x["s"].alias("s"),
            F.right(x["gap"], F.lit(24)).alias("before"), F.left(x["next"], F.lit(1)).alias("after"),
        )
        found = F.when(valid(x["s"]), F.array_append(acc["found"], span)).otherwise(acc["found"])
        # the last gap has no match after it
        return F.struct(
            F.coalesce(end, acc["pos"]).alias("pos"), F.when(x["s"].isNull(), acc["found"]).otherwise(found).alias("found")
        )

    start = F.struct(F.lit(0).alias("pos"), empty.alias("found"))

    def chunked(rows: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(rows), F.lit(CHUNK))
        return F.transform(firsts, lambda at: F.aggregate(F.slice(rows, at, F.lit(CHUNK)), start, step))

    def placed(chunks: Column) -> Column:
        def after(acc: Column, c: Column) -> Column:
            return F.array_append(acc, F.element_at(acc, -1) + c["pos"])

        def moved(at: Column, c: Column) -> Column:
            return F.transform(
                c["found"],
                lambda x: F.struct(
                    (x["start"] + at).alias("start"), (x["end"] + at).alias("end"), x["s"].alias("s"), x["before"].alias("before"),
                    x["after"].alias("after"),
                ),
            )

        starts = F.aggregate(chunks, F.array(F.lit(0)), after)
        return F.flatten(F.zip_with(F.slice(starts, F.lit(1), F.size(chunks)), chunks, moved))

    return F.when(needs, _bound(_bound(rows, chunked), placed)).otherwise(empty)


def _kinded(spans: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("k"), x["end"].alias("end"))
    )


_DIGIT = r"[0-9]"


def base_spans(text: Column) -> Column:
    """Array of ``(start, k, end)`` in order; ``k`` numbers ``KINDS``."""
    needs = {
        "email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")),
        "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
    }
    found = [_kinded(matches(text, BASE[k], needs[k], lambda s, k=k: _valid(k, s)), k) for k in KINDS]
    return F.array_sort(F.concat(*found))


def candidates(text: Column) -> Column:
    """Proposed spans: ``(start, k, end, f)`` with the features ``f``."""
    written = F.contains(text, F.lit("@")) | F.contains(text, F.lit(" at "))
    written = written | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    address = matches(text, _ADDRESS, written, lambda s: s.rlike(_NAMED))
    number = matches(text, _NUMBER, text.rlike(r"[0-9]\D{0,2}[0-9]"), lambda s: F.length(_digits(s)) >= 4)

    def shaped(x: Column, k: Column) -> Column:
        s = x["s"]
        digits = _digits(s)
        count = lambda chars: F.length(s) - F.length(F.translate(s, chars, ""))
        f = [
            F.length(s), F.length(digits), F.length(F.regexp_replace(s, "[^A-Za-z]", "")), count(" ().:/-"), count("+"),
            count("()"), count("."), count(":"), count("@"),
            F.when(F.length(digits).between(13, 19), _luhn(digits).cast("int")).otherwise(0),
            F.array_max(F.transform(F.split(s, "[^0-9]+"), lambda g: F.length(g))),
            x["before"].rlike("[A-Za-z0-9]$").cast("int"), x["after"].rlike("^[A-Za-z0-9]").cast("int"),
            x["before"].rlike(_CUES).cast("int"), count("[]"),
        ]
        f = F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in f])
        return F.struct(x["start"].alias("start"), k.alias("k"), x["end"].alias("end"), f.alias("f"))

    def number_kind(x: Column) -> Column:
        dots = F.length(x["s"]) - F.length(F.translate(x["s"], ".", ""))
        n = F.length(_digits(x["s"]))
        parts = ~x["s"].rlike("[0-9]{4}")
        return F.when((dots == 3) & (n <= 12) & parts, 1).when(n >= 13, 2).otherwise(3)

    return F.concat(
        F.transform(address, lambda x: shaped(x, F.lit(0))), F.transform(number, lambda x: shaped(x, number_kind(x)))
    )


def _open(c: Column) -> Column:
    """Candidates of a text as it is that may well be personal data in a form
    that no base pattern takes; they are no negatives."""
    f = {n: F.get(c["f"], F.lit(i)) for i, n in enumerate(FEATURES)}
    cue = f["cue"] > 0
    return (
        F.when(c["k"] == 0, cue | (f["ats"] + f["parens"] + f["brackets"] > 0))
        .when(c["k"] == 1, cue).when(c["k"] == 2, f["luhn"] > 0).otherwise(cue & f["digits"].between(7, 15))
    )


def _chunks(spans: Column) -> Column:
    """``spans`` in runs of ``CHUNK``."""
    starts = F.when(F.size(spans) > 0, F.sequence(F.lit(1), F.size(spans), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.slice(spans, at, F.lit(CHUNK)))


def _ranges(spans: Column) -> Column:
    """Runs of the ordered ``spans`` with the range that each covers."""
    return F.transform(_chunks(spans), lambda part: F.struct(
        F.array_min(F.transform(part, lambda x: x["start"])).alias("start"),
        F.array_max(F.transform(part, lambda x: x["end"])).alias("end"), part.alias("part"),
    ))


def _overlaps(c: Column, ranges: Column, same_kind: bool = False) -> Column:
    """Whether ``c`` meets one of the spans of ``_ranges``."""

    def meets(b: Column) -> Column:
        return (b["start"] < c["end"]) & (c["start"] < b["end"])

    def one(b: Column) -> Column:
        return meets(b) & (b["k"] == c["k"]) if same_kind else meets(b)

    return F.exists(ranges, lambda p: meets(p) & F.exists(p["part"], one))


# Rewrites of a base span to forms that no base pattern takes: (pattern,
# replacement) steps of each variant.
_LOCAL = (r"^\+[0-9]{1,3}[\x20.-]+(?=(?:[^0-9]*[0-9]){7})", "")
_VARIANTS = {
    "email": (
        (("@", " (at) "), (r"\.(?=[^)]*$)", " (dot) ")), (("@", " at "),), (("@", "[at]"),), (("@", " [at] "), (r"\.(?=[^\]]*$)", " [dot] ")),
        (("@", " @ "),), (("@", "(at)"),), (("@", " at "), (r"\.(?=[^ ]*$)", " dot ")),
    ),
    "ip": (((r"\.", ". "),), ((r"\.", " ."),)),
    "card": tuple((("[^0-9]", ""), ("([0-9]{4})(?=[0-9])", f"$1{by}")) for by in (".", "  ", "/")),
    "phone": (
        ((r"^\+", ""),), (_LOCAL, (r"^\+", "")), ((r"^\+", ""), (r"[\x20()-]+", ".")),
        (_LOCAL, (r"^\+", ""), (r"[()]", ""), (r"[\x20-]+", "/")),
    ),
}


def rewritten(text: Column, spans: Column, seed: Column) -> Column:
    """``text`` with each of the ``spans`` in a variant chosen by the seed and
    the span's place, and the ``spans`` of these."""

    def variant(s: Column, x: Column) -> Column:
        out = s
        for k, kind in enumerate(KINDS):
            forms = _VARIANTS[kind]
            pick = F.pmod(F.xxhash64(seed, x["start"]), F.lit(len(forms)))
            for i, steps in enumerate(forms):
                new = s
                for pattern, by in steps:
                    new = F.regexp_replace(new, pattern, by)
                out = F.when((x["k"] == k) & (pick == i), new).otherwise(out)
        return out

    spans_of = "array<struct<start:int,k:int,end:int>>"
    texts, none = F.array().cast("array<string>"), F.array().cast(spans_of)

    def chunk(acc: Column, part: Column) -> Column:
        """``CHUNK`` spans, rewritten in the piece of text that they span."""
        until = F.greatest(acc["pos"], F.array_max(F.transform(part, lambda x: x["end"])))

        def folded(piece: Column) -> Column:
            def step(a: Column, x: Column) -> Column:
                gap = F.substring(piece, a["pos"] - acc["pos"] + 1, x["start"] - a["pos"])
                form = variant(F.substring(piece, x["start"] - acc["pos"] + 1, x["end"] - x["start"]), x)

                def moved(made: Column) -> Column:
                    at = a["length"] + F.length(made["gap"])
                    end = at + F.length(made["form"])
                    span = F.struct(at.alias("start"), x["k"].alias("k"), end.alias("end"))
                    return F.struct(
                        x["end"].alias("pos"), end.alias("length"),
                        F.concat(a["out"], F.array(made["gap"], made["form"])).alias("out"),
                        F.array_append(a["spans"], span).alias("spans"),
                    )

                made = _bound(F.struct(gap.alias("gap"), form.alias("form")), moved)
                return F.when(x["start"] >= a["pos"], made).otherwise(a)

            first = F.struct(acc["pos"].alias("pos"), acc["length"].alias("length"), texts.alias("out"), none.alias("spans"))
            return F.aggregate(part, first, step)

        done = _bound(F.substring(text, acc["pos"] + 1, until - acc["pos"]), folded)
        return _bound(done, lambda a: F.struct(
            a["pos"].alias("pos"), a["length"].alias("length"),
            F.array_append(acc["out"], F.array_join(a["out"], "")).alias("out"),
            F.array_append(acc["spans"], a["spans"]).alias("spans"),
        ))

    start = F.struct(
        F.lit(0).alias("pos"), F.lit(0).alias("length"), texts.alias("out"), F.array().cast(f"array<{spans_of}>").alias("spans")
    )
    whole = lambda acc: F.struct(
        F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))).alias("text"),
        F.flatten(acc["spans"]).alias("spans"),
    )
    return F.aggregate(_chunks(spans), start, chunk, whole)


# --- boosted trees -----------------------------------------------------------


@dataclass
class Booster:
    """Trees as nested ``(feature, threshold, left, right)`` or leaf values,
    and the calibrated threshold of each kind."""

    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def margin(self, f: Column) -> Column:
        def of(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(F.get(f, F.lit(feature)) <= threshold, of(left)).otherwise(of(right))

        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + F.lit(weight) * of(tree)
        return total

    def score(self, f: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * self.margin(f)))

    def selects(self, c: Column) -> Column:
        if not self.thresholds:
            return F.lit(False)
        least = F.lit(2.0)
        for k, t in self.thresholds.items():
            least = F.when(c["k"] == k, F.lit(t)).otherwise(least)
        return self.score(c["f"]) >= least


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    return (node.split().featureIndex(), float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def examples(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The candidates of all documents that overlap no base span, counted:
    ``label, held`` (of a document that is held out), ``k``, the features and
    ``n``. Label 0 are those of the texts as they are but for the open ones,
    label 1 those that meet a rewritten base span."""

    def free(found: Column, base: Column, label: float, keep) -> Column:
        chosen = _bound(_ranges(base), lambda ranges: F.filter(found, lambda c: keep(c) & ~_overlaps(c, ranges)))
        return F.transform(chosen, lambda c: F.struct(F.lit(label).alias("label"), c["k"].alias("k"), c["f"].alias("f")))

    def moved(r: Column) -> Column:
        def met(planted: Column) -> Column:
            return free(candidates(r["text"]), base_spans(r["text"]), 1.0, lambda c: _overlaps(c, planted, True))

        return _bound(_ranges(r["spans"]), met)

    def both(base: Column) -> Column:
        asis = free(candidates(text), base, 0.0, lambda c: ~_open(c))
        none = F.array().cast("array<struct<label:double,k:int,f:array<double>>>")
        return F.concat(asis, F.when(F.size(base) > 0, _bound(rewritten(text, base, F.col("id")), moved)).otherwise(none))

    text = F.col("t")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null")
    held = F.coalesce(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0, F.lit(False))
    rows = texts.select(held.alias("held"), F.explode(_bound(base_spans(text), both)).alias("c"))
    return rows.groupBy("c.label", "held", "c.k", "c.f").agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Booster:
    """Fit the trees on the candidates of all documents and calibrate the
    thresholds on those of the held-out ones."""
    found = examples(docs, text_col, id_col)
    rows = found.select("label", "held", "k", *[F.col("f")[i].alias(n) for i, n in enumerate(FEATURES)], "n")
    # the same partitions in the same order on every run
    rows = cut(rows.repartition(FIT_PARTITIONS, "label", *FEATURES).sortWithinPartitions("label", "held", "k", *FEATURES))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST:
        return Booster()
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="n").fit(rows.where("not held"))
    trees = [(float(w), _tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)]
    booster = Booster(trees)
    # rounded down: every candidate of a bin reaches the bin's score
    scored = rows.where("held").select("k", "label", "n", (F.floor(booster.score(F.array(*FEATURES)) * 100) / 100).alias("score"))
    bins = scored.groupBy("k", "score").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("hits"))
    # at most 4 kinds x 101 scores
    for k in range(len(KINDS)):
        n = hits = 0
        for r in bins.where(F.col("k") == k).orderBy(F.desc("score")).collect():
            n, hits = n + r["n"], hits + r["hits"]
            if r["score"] >= LEAST_SCORE and hits / n >= PRECISION and n >= LEAST:
                booster.thresholds[k] = r["score"]
    return booster


# --- operator ----------------------------------------------------------------


def find(docs: DataFrame, into: str, booster: Booster, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: ``base`` and ``spans`` (base
    and added), arrays of ``(start, k, end)`` in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, proposed = spare(docs, f"{into}_base"), spare(docs, f"{into}_proposed")
    out = docs.withColumns({base: base_spans(text), proposed: candidates(text) if booster.thresholds else F.lit(None)})
    added = F.array().cast("array<struct<start:int,k:int,end:int>>")
    if booster.thresholds:
        def chosen_by(ranges: Column) -> Column:
            return F.filter(F.col(proposed), lambda c: booster.selects(c) & ~_overlaps(c, ranges))

        chosen = _bound(_ranges(F.col(base)), chosen_by)
        added = F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end")))
    both = F.array_sort(F.concat(F.col(base), added))
    return out.withColumn(into, F.struct(F.col(base).alias("base"), both.alias("spans"))).drop(base, proposed)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by ``[KIND]``; overlapping spans are
    replaced together, under the kind of the first."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    none = F.array().cast("array<string>")

    def chunk(acc: Column, part: Column) -> Column:
        """``CHUNK`` spans, replaced in the piece of text that they span."""
        until = F.greatest(acc["pos"], F.array_max(F.transform(part, lambda x: x["end"])))

        def folded(piece: Column) -> Column:
            def step(a: Column, x: Column) -> Column:
                gap = F.substring(piece, a["pos"] - acc["pos"] + 1, x["start"] - a["pos"])
                apart = x["start"] >= a["pos"]
                parts = F.when(apart, F.concat(a["out"], F.array(gap, F.get(kinds, x["k"])))).otherwise(a["out"])
                return F.struct(F.greatest(a["pos"], x["end"]).alias("pos"), parts.alias("out"))

            first = F.struct(acc["pos"].alias("pos"), none.alias("out"))
            return F.aggregate(part, first, step, lambda a: F.struct(a["pos"].alias("pos"), F.array_join(a["out"], "").alias("s")))

        done = _bound(F.substring(text, acc["pos"] + 1, until - acc["pos"]), folded)
        return _bound(done, lambda d: F.struct(d["pos"].alias("pos"), F.array_append(acc["out"], d["s"]).alias("out")))

    def chunks(spans: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(spans), F.lit(CHUNK)), lambda at: F.slice(spans, at, F.lit(CHUNK)))

    start = F.struct(F.lit(0).alias("pos"), none.alias("out"))
    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(_bound(spans, chunks), start, chunk, rest)).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with personal data replaced in the text (and the length
    column, if there is one, brought up to date)."""
    into = spare(docs, "__pii")
    found = find(docs, into, fit(docs, text_col=text_col, **options), text_col)
    out = found.withColumn(text_col, redacted(F.col(text_col), F.col(into)["spans"])).drop(into)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.coalesce(F.length(text_col).cast(kind), F.col(length_col)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
