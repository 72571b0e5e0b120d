"""Operator 10: personal data by patterns and bootstrapped contexts (DataFrame functions only).

*Base.*  Emails, IP addresses, card numbers and phone numbers are found by their
patterns, leftmost and without overlaps per kind, in code points.  A match's
start is the summed length of the gaps and matches before it: the text is
split by the same pattern that extracts the matches.  Matches that fail their
check (octets up to 255, Luhn, number of digits) are dropped.

*Method.*  Everything that looks like an identifier (a number with separators,
an address with an at sign, a word with a digit) is an occurrence with the words
before and after it, up to the next occurrence.  Occurrences that are base
entities are the seeds.  A lexical pattern is the one to ``WINDOW`` words next to
the occurrence on one side; what the occurrence itself looks like is no part of
it, so that values of other formats share patterns with the seeds.  On the graph
of patterns and instances a pattern's confidence for a kind is the scored share
of its instances, and an instance's score is the noisy-or of its most confident
pattern on either side (windows of one side hold each other and are no separate
evidence).  Instances that ``min_patterns`` confident patterns support with
``min_score`` or more are accepted with the score and kind they have then, and
count like seeds from the next round on; the confident patterns are selected anew
in every round, from all patterns that ``min_support`` seeds and accepted
instances share, until a round accepts none.  Kinds and scores stay as accepted,
so confidences only grow and the rounds end.  Accepted instances are personal
data outside base spans: wherever they occur if at least half of their
occurrences stand in confident patterns, otherwise (a common number that is an
identifier here and there) only in these.  Confidences and scores are partial
sums per task before any row moves.

Defined cases: null and empty texts have no spans; texts of any length are
searched whole; spans of different kinds may overlap; repeated rows have equal
spans; a null id is passed on; an empty table gives no rows; other columns are
not read (``redact`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prismark.llm.runtime import shared_path, small_enough, stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
# The patterns of the contract, written so that no start is tried twice and nothing is backtracked in vain:
# a start inside a run that has just failed would fail too, unless a match ended there.
PATTERN = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts that can hold a match; all others are not searched.
MAY_HOLD = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
SPAN = "array<struct<kind:int,s:int,e:int>>"
#: Code points of the pieces in which a text is looked up.
PIECE = 4096
#: Words of the widest lexical pattern.
WINDOW = 3
#: What looks like an identifier: an address, a number with separators, a word with a digit.
OCCURRENCE = (
    rf"(?<![{LOCAL}])[{LOCAL}]++@[A-Za-z0-9.-]*[A-Za-z0-9]"
    r"|(?<![A-Za-z0-9_])[+(]?[0-9][0-9\x20().-]*[0-9](?![A-Za-z0-9_])"
    r"|(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{6,}"
)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern is kept."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    n = F.length(_digits(match))
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), _luhn(_digits(match))).otherwise(False)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _scan(values: Column, op) -> Column:
    """``out``: ``op`` over all numbers before each one (0 for the first), and ``at``: over all of them.

    Numbers are folded in blocks of about the root of their count, so that the
    arrays that a fold copies in every step stay short.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def fold(block: Column) -> Column:
        return F.aggregate(block, start, lambda acc, v: F.struct(
            op(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
        ))

    def blocks(v: Column) -> Column:
        wide = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(v))).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / wide).cast("int")), lambda k: fold(F.slice(v, k * wide + 1, wide)))

    def whole(parts: Column) -> Column:
        return _let(fold(F.transform(parts, lambda x: x["at"])), lambda base: F.struct(
            base["at"].alias("at"),
            F.flatten(F.zip_with(parts, base["out"], lambda x, b: F.transform(x["out"], lambda v: op(v, b)))).alias("out"),
        ))

    return _let(values, lambda v: _let(blocks(v), whole))


def _matches(text: Column, pattern: str) -> Column:
    """``array<struct<m, s>>``: every match and where it starts, the lengths of gaps and matches before it added up."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gaps"))

    def placed(x: Column) -> Column:
        steps = F.zip_with(x["m"], F.slice(x["gaps"], F.lit(2), F.size(x["m"])), lambda m, after: F.length(m) + F.length(after))
        starts = _scan(steps, lambda u, v: u + v)["out"]
        return F.zip_with(x["m"], starts, lambda m, at: F.struct(m.alias("m"), (at + F.length(x["gaps"][0])).alias("s")))

    return _let(both, placed)


def kind_spans(text: Column, kind: str) -> Column:
    """All spans of one kind, by start."""
    kept = F.filter(_matches(text, PATTERN[kind]), lambda x: passes(kind, x["m"]))
    spans = F.transform(kept, lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), x["s"].alias("s"), (x["s"] + F.length(x["m"])).alias("e")
    ))
    return F.when(text.rlike(MAY_HOLD[kind]), spans).otherwise(F.array().cast(SPAN))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind."""
    return F.array_sort(spans, lambda a, b: F.when(
        (a["s"] < b["s"]) | ((a["s"] == b["s"]) & (a["kind"] < b["kind"])), -1
    ).when((a["s"] == b["s"]) & (a["kind"] == b["kind"]), a["e"] - b["e"]).otherwise(1))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string")
    )), ",")


def base_spans(text: Column) -> Column:
    return F.concat(*(kind_spans(text, k) for k in KINDS))


def kind_of(value: Column) -> Column:
    """Number of the base kind that a whole string is, else null."""
    out = F.lit(None).cast("int")
    for k in reversed(KINDS):
        whole = value.rlike(f"^(?:{PATTERN[k]})$")
        out = F.when(F.when(whole, passes(k, value)).otherwise(False), F.lit(KINDS.index(k))).otherwise(out)
    return out


def occurrences(rows: DataFrame) -> DataFrame:
    """``doc_id, row, s, e, value, patterns`` of everything that looks like an identifier; ``rows``: doc_id, row, text."""
    text = F.col("text")
    none = F.array().cast("array<struct<s:int,value:string>>")
    found = F.when(
        text.rlike("[0-9@]"),
        F.transform(_matches(text, OCCURRENCE), lambda x: F.struct(x["s"].alias("s"), x["m"].alias("value"))),
    ).otherwise(none)
    words = F.transform(F.split(text, OCCURRENCE, -1), lambda g: F.filter(F.split(F.lower(g), r"\s+"), lambda w: w != ""))
    ends = F.transform(words, lambda w: F.struct(
        F.slice(w, F.lit(1), F.lit(WINDOW)).alias("first"),
        F.slice(w, F.greatest(F.size(w) - (WINDOW - 1), F.lit(1)), F.lit(WINDOW)).alias("last"),
    ))
    n = F.size("found")
    sides = F.arrays_zip(
        F.col("found").alias("f"), F.slice("gaps", F.lit(1), n)["last"].alias("left"), F.slice("gaps", F.lit(2), n)["first"].alias("right")
    )
    each = (
        rows.withColumn("found", found).where(n > 0).withColumn("gaps", ends)
        .select("doc_id", "row", F.explode(sides).alias("x"))
        .select("doc_id", "row", F.col("x.f.s").alias("s"), F.col("x.f.value").alias("value"), "x.left", "x.right")
    )
    widths = range(1, WINDOW + 1)
    left = [F.when(F.size("left") >= k, F.concat_ws(" ", F.lit(f"l{k}"), F.slice("left", -k, k))) for k in widths]
    right = [F.when(F.size("right") >= k, F.concat_ws(" ", F.lit(f"r{k}"), F.slice("right", 1, k))) for k in widths]
    return each.select(
        "doc_id", "row", "s", (F.col("s") + F.length("value")).alias("e"), "value", F.array_compact(F.array(*left, *right)).alias("patterns")
    )


def _support(edges: DataFrame, trusted: DataFrame) -> DataFrame:
    """``value, kind, score, patterns, inside``: score, number of trusted patterns, and occurrences known to stand in one."""

    def best(side: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("window").startswith(side), F.col("trust"))), F.lit(0.0))

    # an occurrence has one pattern of each side and width, so the sum over one of them counts no occurrence twice
    by_window = (
        edges.join(trusted, "pattern").groupBy("value", "kind", F.substring("pattern", 1, 2).alias("window"))
        .agg(F.max("trust").alias("trust"), F.sum("n").alias("inside"), F.count(F.lit(1)).alias("patterns"))
    )
    return by_window.groupBy("value", "kind").agg(
        (1 - (1 - best("l")) * (1 - best("r"))).alias("score"), F.sum("patterns").alias("patterns"), F.max("inside").alias("inside")
    )


def discover(
    found: DataFrame, confident: float = 0.8, min_score: float = 0.9, min_patterns: int = 2, min_support: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """``value, kind, everywhere`` of instances that are no seeds but that confident patterns support, and these patterns (``pattern, kind``)."""
    spark = found.sparkSession
    edges = stored(
        found.select(F.explode("patterns").alias("pattern"), "value").groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n")),
        "pii-edges",
    )
    every = edges.select("value").distinct().withColumn("kind", kind_of(F.col("value")))
    seeds = stored(every.where(F.col("kind").isNotNull()).withColumn("score", F.lit(1.0)), "pii-seeds")
    # a pattern of fewer instances cannot have the support in any round
    total = edges.groupBy("pattern").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values"))
    total = stored(total.where(F.col("values") >= min_support).drop("values"), "pii-totals")
    edges = stored(edges.join(total.select("pattern"), "pattern", "left_semi"), "pii-graph")
    accepted_path = shared_path(spark, "pii-accepted")
    seeds.limit(0).write.parquet(accepted_path)
    while True:
        accepted = spark.read.schema(seeds.schema).parquet(accepted_path)
        known = seeds.unionByName(accepted)
        held = edges.join(known, "value").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("held"), F.count(F.lit(1)).alias("support")
        )
        trust = held.where(F.col("support") >= min_support).join(total, "pattern").select(
            "pattern", "kind", (F.col("held") / (F.col("total") + 1)).alias("trust")
        )
        trusted = stored(trust.where(F.col("trust") >= confident), "pii-trusted")
        support = _support(edges.join(known.select("value"), "value", "left_anti"), trusted)
        fine = support.where((F.col("score") >= min_score) & (F.col("patterns") >= min_patterns))
        best = fine.groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("best"))
        new = stored(best.select("value", "best.kind", "best.score"), "pii-new")
        if new.isEmpty():
            break
        new.write.mode("append").parquet(accepted_path)
    inside = _support(edges.join(accepted.select("value"), "value", "left_semi"), trusted).select("value", "kind", "inside")
    times = found.groupBy("value").agg(F.count(F.lit(1)).alias("times"))
    values = accepted.join(inside, ["value", "kind"]).join(times, "value")
    return values.select("value", "kind", (2 * F.col("inside") >= F.col("times")).alias("everywhere")), trusted.select("pattern", "kind")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("text"))


def added_spans(rows: DataFrame) -> DataFrame:
    """``_d, _r, added``: the method's spans of the rows (``doc_id, row, text``) that have any."""
    found = stored(occurrences(rows), "pii-occurrences")
    values, patterns = discover(found)
    hits = found.join(values, "value")
    within = hits.where(~F.col("everywhere")).withColumn("pattern", F.explode("patterns")).join(patterns, ["pattern", "kind"], "left_semi")
    span = ["doc_id", "row", "kind", "s", "e"]
    added = (
        hits.where("everywhere").select(span).unionByName(within.select(span))
        .groupBy("doc_id", "row")
        .agg(F.collect_set(F.struct("kind", "s", "e")).alias("added"))
    )
    return stored(added.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "added"), "pii-added")


def _free(base: Column, added: Column) -> Column:
    """The method's spans that touch no base span."""
    return F.filter(
        F.coalesce(added, F.array().cast(SPAN)), lambda x: ~F.exists(base, lambda b: (x["s"] < b["e"]) & (b["s"] < x["e"]))
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, base, added``: base spans by start and kind, and the method's spans, of every row."""
    rows = _rows(docs, id_col, text_col)
    base = rows.select("doc_id", "row", in_order(base_spans(F.col("text"))).alias("base"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r"))
    both = base.join(small_enough(added_spans(rows), 1 << 16), same, "left")
    return both.select("doc_id", "row", "base", _free(F.col("base"), F.col("added")).alias("added"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base spans per kind, the digest of the base spans, and all spans, of every row."""
    spans = find_pii(docs, id_col, text_col)

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select(
        "doc_id", *counts,
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(in_order(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def without(text: Column, spans: Column) -> Column:
    """The text with its spans (by start) replaced by their kinds; what overlaps an earlier span goes with it."""
    names = F.array(*(F.lit(f"<{k}>") for k in KINDS))
    # code points are looked up in pieces of a fixed length, so that no look-up walks the whole text
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def part(x: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        near = F.array_join(F.slice(x["pieces"], first + 1, F.floor(b / PIECE).cast("int") - first + 1), "")
        return F.substring(near, a - first * PIECE + 1, b - a)

    def joined(x: Column) -> Column:
        ends = F.zip_with(x["spans"], x["ends"]["out"], lambda y, before: F.struct(y["kind"].alias("kind"), y["s"].alias("s"), before.alias("b")))
        first = F.filter(ends, lambda y: y["s"] >= y["b"])
        done = F.transform(first, lambda y: F.concat(part(x, y["b"], y["s"]), F.element_at(names, y["kind"] + 1)))
        return F.concat(F.array_join(done, ""), part(x, x["ends"]["at"], x["n"]))

    ends = _scan(F.transform(spans, lambda y: y["e"]), lambda u, v: F.greatest(u, v))
    return _let(F.struct(spans.alias("spans"), ends.alias("ends"), pieces.alias("pieces"), F.length(text).alias("n")), joined)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans by the first one's."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))  # no name of the input can clash
    text = F.col("doc")[text_col]
    same = F.col("doc")[id_col].eqNullSafe(F.col("_d")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_r"))
    joined = held.withColumn("_base", base_spans(F.coalesce(text, F.lit("")))).join(
        small_enough(added_spans(_rows(docs, id_col, text_col)), 1 << 16), same, "left"
    )
    spans = joined.withColumn("_spans", in_order(F.concat("_base", _free(F.col("_base"), F.col("added")))))
    clear = F.when(F.size("_spans") > 0, without(text, F.col("_spans"))).otherwise(text)
    return spans.select(*((clear if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns))
