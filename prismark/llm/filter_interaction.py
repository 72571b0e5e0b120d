"""Operator 13: how quality filters interact, by the potential of their removal game.

The filters are the players of a game whose value of a coalition is the number of
documents that at least one of its filters removes.  Per part of the corpus the
documents are counted by the set of filters that they fail (a mask of k bits), so
2^k counts hold all there is to know.  From them come, per part:

* the value of each of the 2^k coalitions;
* the Hart-Mas-Colell potential of each coalition, recursively over its
  sub-coalitions, ``P(S) = (v(S) + sum of P(S - i)) / |S|``, kept exact as the
  integer ``k! * P(S)``;
* the Shapley value of a filter, the potential of the grand coalition minus that
  of the coalition without the filter;
* each step of each order, as differences of coalition values.

One pass over the texts gives 50 bytes a document (id, part, digest, mask).  Texts
are identical when their SHA-256 digests are.  The smallest id of each text is
found by a partial aggregate, and documents are joined to it by (digest, id), so a
text that a third of all rows hold is spread by its ids.

Defined cases: null text and null source count as empty; a row with a null id has
no label and is neither a smaller nor a larger copy; rows with the same id and text
are no smaller copies of each other, each counts; several label rows of an id
count as one that has any of their marks; parts with a single document have all
their rows; an empty table gives no rows; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from prismark.llm.runtime import stored

FILTERS = "ABCDE"
#: The letter of the filter that needs the whole table.
COPY = "E"
#: Filter D fails texts with one of these.
SYMBOLS = b"#$%&*|"


def _fails(batches):
    """Arrow batches of (id, part, text bytes) to (id, part, digest, mask of the filters A to D)."""
    import hashlib
    import string

    import pyarrow as pa

    capitals = string.ascii_uppercase.encode()
    trailing = bytes(range(0x80, 0xC0))
    for batch in batches:
        digests, masks = [], []
        for text in batch.column(2).to_pylist():
            words = text.split()  # bytes are split at the six ASCII white-space characters, and at nothing else
            n = len(words)
            upper = len(text) - len(text.translate(None, capitals))
            points = len(text) if text.isascii() else len(text.translate(None, trailing))
            digests.append(hashlib.sha256(text).digest())
            masks.append(
                (n < 50)
                | (100 * len(set(words)) < 65 * n) << 1
                | (100 * upper > 5 * points) << 2
                | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
            )
        columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "part", "digest", "mask"])


def failure_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part by the filters that they fail (bit 0 is A)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    facts = stored(read.mapInArrow(_fails, f"id {id_type}, part string, digest binary, mask int"), "filter-facts")
    named = facts.where("id is not null").groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = facts.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    copy = 1 << FILTERS.index(COPY)
    judged = (
        named.join(first.withColumn("first", F.lit(True)), ["id", "digest"], "left").join(marks, "id", "left")
        .select("part", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + copy).alias("mask"), "n", "good", "toxic")
    )
    nameless = facts.where("id is null").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("int")
    return judged.unionByName(nameless.select("*", none.alias("good"), none.alias("toxic"))).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(F.col("n") * F.col("good"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("n") * F.col("toxic"), F.lit(0))).alias("toxic"),
    )


def _value(cells: Column, field: str, k: int) -> Column:
    """Array by coalition: the sum of ``field`` over the masks that meet it."""

    def met(coalition):
        hit = F.filter(cells, lambda c: c["mask"].bitwiseAND(coalition) != 0)
        return F.aggregate(hit, F.lit(0).cast("long"), lambda acc, c: acc + c[field])

    return F.transform(F.sequence(F.lit(0), F.lit((1 << k) - 1)), met)


def _potential(value: Column, k: int) -> Column:
    """Array by coalition: ``k!`` times the potential; sub-coalitions have smaller numbers, so they are there already."""

    def grown(acc, s):
        without = [
            F.when(s.bitwiseAND(1 << i) != 0, F.get(acc, s - (1 << i))).otherwise(F.lit(0)) for i in range(k)
        ]
        whole = F.lit(math.factorial(k)) * F.get(value, s) + sum(without[1:], without[0])
        return F.concat(acc, F.array(F.call_function("div", whole, F.bit_count(s)).cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << k) - 1)), F.array(F.lit(0).cast("long")), grown)


def interaction_audit(counts: DataFrame, letters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``counts`` as ``failure_counts`` gives them.

    ``letters`` name the bits of the masks; k filters have k! orders, so this is for up to about seven.
    """
    k = len(letters)
    grand = (1 << k) - 1
    parts = counts.groupBy("part").agg(  # at most 2^k entries a part
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"), F.sum("n").alias("documents")
    )
    cells = F.col("cells")
    valued = parts.select(
        "part", "documents", _value(cells, "n", k).alias("v"), _value(cells, "good", k).alias("g"), _value(cells, "toxic", k).alias("t")
    ).withColumn("potential", _potential(F.col("v"), k))
    orders = ["".join(p) for p in itertools.permutations(letters)]
    steps = valued.select("*", F.explode(F.lit(orders)).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")
    )
    names = F.lit("".join(letters))

    bits = F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda j: F.element_at(F.lit([1 << i for i in range(k)]), F.instr(names, F.substring("filter_order", j, F.lit(1)))),
    )
    before = F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda acc, b: acc + b)
    placed = steps.withColumn("bits", bits).select("*", F.element_at("bits", F.col("step")).alias("bit"), before.alias("before"))
    after = F.col("before") + F.col("bit")
    removed = F.get("v", after) - F.get("v", F.col("before"))
    return placed.select(
        "part", "filter_order", "step",
        (F.col("documents") - F.get("v", after)).alias("kept"),
        removed.alias("removed"),
        (F.get("v", F.col("bit")) - removed).alias("redundant"),
        (F.get("v", F.lit(grand)) - F.get("v", F.lit(grand) - F.col("bit"))).alias("unique_fails"),
        (F.get("g", after) - F.get("g", F.col("before"))).alias("good_lost"),
        (F.get("t", after) - F.get("t", F.col("before"))).alias("toxic_lost"),
        (F.get("potential", F.lit(grand)) - F.get("potential", F.lit(grand) - F.col("bit"))).alias("shapley"),
    )


ORACLE_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
m as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
f as (
  select d.part, coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic, [
      len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
      100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
      coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)] as fails
  from d left join m on m.doc_id = d.doc_id),
n as (select part, fails, count(*) as n, sum(good::int) as good, sum(toxic::int) as toxic from f group by all),
l as (select unnest(range(1, 6)) as i),
o as (
  select [a.i, b.i, c.i, e.i, 15 - a.i - b.i - c.i - e.i] as o from l a, l b, l c, l e
  where len(list_distinct([a.i, b.i, c.i, e.i])) = 4),
s as (select o, l.i as step, o[l.i] as flt, o[1:l.i - 1] as earlier from o, l),
x as (
  select n.part, s.o, s.step, s.flt, n.n, n.good, n.toxic, fails[s.flt] as f,
    len(list_filter(s.earlier, lambda j: fails[j])) > 0 as gone,
    len(list_filter(fails, lambda b: b)) as n_fails
  from n, s),
r as (
  select part, o, step, flt,
    sum(case when not gone and not f then n else 0 end) as kept,
    sum(case when not gone and f then n else 0 end) as removed,
    sum(case when gone and f then n else 0 end) as redundant,
    sum(case when f and n_fails = 1 then n else 0 end) as unique_fails,
    sum(case when not gone and f then good else 0 end) as good_lost,
    sum(case when not gone and f then toxic else 0 end) as toxic_lost
  from x group by all)
select part, array_to_string(list_transform(o, lambda j: 'ABCDE'[j]), '') as filter_order, step::integer as step,
  kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, flt))::bigint as shapley
from r
"""
