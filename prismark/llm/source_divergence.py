"""Operator 11: how far the sources of a language differ in their words, by a three-dimensional cube of cells.

Each (lang, source) group has counts of the terms that its language keeps.  The
comparison of all groups of a language is a cube: group blocks along two axes,
term blocks along the third.  A task owns one cell (group block, group block,
term block); it receives the slices of the groups of both blocks over that term
block, replicated to every cell that needs them, and computes the partial
divergence of each pair.  The partial sums of a pair are then added along the
term axis.

* Terms are counted per task first (a table of at most ``max_entries`` entries,
  emitted whenever it is full), so a frequent word or a hot source reaches the
  shuffle as one row per task.
* Term blocks and group blocks are hash blocks of about ``term_block`` terms and
  ``group_block`` groups, so a cell holds a bounded slice whatever the number of
  documents.  A term's place in its block is its rank there: a cell is a dense
  matrix of integers, no hash decides which terms are equal.
* All arithmetic is exact: smoothed shares are integer divisions of decimals.

Defined cases: null text, lang and source count as empty strings; a group without
terms has only smoothed shares; a language that keeps no term has pairs of value
0 and no term rows; a language with one source has no pairs; each row is a
document, also when ids or texts repeat; an empty table gives no rows; columns
other than the three read do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from prismark.llm.runtime import small_enough, stored

#: Entries of the counting table of a task (about 200 bytes each) before it is emitted.
MAX_ENTRIES = 400_000
#: Rows of an emitted batch.
BATCH_ROWS = 50_000
#: Shares are parts of a billion.
SCALE = 1_000_000_000
#: Added to every count.
SMOOTHING = 5


def _counter(max_entries: int):
    """Arrow batches of (lang, source, text bytes) to partial counts; an empty term marks that the group occurs."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        # Term bytes are ASCII letters, lower-cased, and all bytes of non-ASCII characters; the rest separates terms.
        table = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
        names = ["lang", "source", "term", "n", "docs"]
        groups: dict = {}

        def emitted():
            langs, sources, terms, n, docs = [], [], [], [], []
            for (lang, source), (times, held) in groups.items():
                langs += [lang] * (len(times) + 1)
                sources += [source] * (len(times) + 1)
                terms += [b"", *times]
                n += [0, *times.values()]
                docs += [0, *(held[t] for t in times)]
            groups.clear()
            for k in range(0, len(terms), BATCH_ROWS):
                cut = slice(k, k + BATCH_ROWS)
                columns = [
                    pa.array(langs[cut], pa.string()), pa.array(sources[cut], pa.string()), pa.array(terms[cut], pa.binary()),
                    pa.array(n[cut], pa.int64()), pa.array(docs[cut], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

        words = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts = groups.get((lang, source))
                if counts is None:
                    counts = groups[lang, source] = Counter(), Counter()
                found = text.translate(table).split()
                counts[0].update(found)
                counts[1].update(set(found))
                words += len(found) + 20
                if words > max_entries:  # look at the size of the table now and then
                    words = 0
                    if sum(20 + len(c[0]) for c in groups.values()) > max_entries:
                        yield from emitted()
        yield from emitted()

    return run


def term_counts(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", max_entries: int = MAX_ENTRIES
) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term per group.

    Every group also has one row with the empty term, so groups without terms are known.
    """
    read = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    partial = read.mapInArrow(_counter(max_entries), "lang string, source string, term binary, n long, docs long")
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 5) / (total + 5 * terms))``, exact for any count that a long holds."""
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")).cast("decimal(38,0)")
    below = (total + SMOOTHING * terms).cast("decimal(20,0)")
    return F.call_function("div", wide, below).cast("long") + 1


def _cell(cell_key, rows):
    """Partial divergences of one cell: rows are (source, own block, base share, width, places, shares)."""
    import numpy as np
    import pyarrow as pa

    lang, first, second, _ = (k.as_py() for k in cell_key)
    source = rows.column("source").to_pylist()
    block = rows.column("own").to_numpy()
    shares = np.repeat(rows.column("base").to_numpy()[:, None], rows.column("width")[0].as_py(), axis=1)
    for k, (at, p) in enumerate(zip(rows.column("places").to_pylist(), rows.column("shares").to_pylist())):
        if at:
            shares[k, at] = p
    right = np.flatnonzero(block == second)
    a, b, value = [], [], []
    for k in np.flatnonzero(block == first).tolist():
        others = right[right > k] if first == second else right
        value.append(np.abs(shares[others] - shares[k]).sum(axis=1))
        a += [source[k]] * len(others)
        b += [source[j] for j in others.tolist()]
    value = np.concatenate(value) if value else np.zeros(0, np.int64)
    return pa.table({
        "lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()),
        "value": pa.array(value, pa.int64()),
    })


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 30,
    top_terms: int = 50,
    group_block: int = 16,
    term_block: int = 4096,
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for each group.

    A language keeps the terms in at least ``min_docs`` of its documents.  Part
    ``pair`` holds every other source of the language by summed difference of
    smoothed shares, part ``term`` the ``top_terms`` kept terms whose share in the
    group is above that in the language, by the difference.
    """
    counts = stored(term_counts(docs, lang_col, source_col, text_col, max_entries), "divergence-counts")
    kept = (
        counts.where("term <> ''").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs).drop("docs")
    )
    kept = stored(kept, "divergence-kept")
    marks = counts.where("term = ''").select("lang", "source")
    langs = marks.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")), "lang", "left"
    )
    langs = stored(langs.na.fill(0, ["terms", "lang_total"]).select(
        "*", F.greatest(F.lit(1), F.ceil(F.col("sources") / group_block)).cast("int").alias("group_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / term_block)).cast("int").alias("term_blocks"),
    ), "divergence-langs")

    # A term's block along the third axis and its place there.
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy("term")) - 1
    vocabulary = stored(
        kept.join(small_enough(langs.select("lang", "term_blocks")), "lang")
        .select("lang", "term", "lang_n", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("part"))
        .withColumn("place", place.cast("int")),
        "divergence-vocabulary",
    )
    widths = vocabulary.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("width"))
    held = stored(
        counts.where("term <> ''").select("lang", "source", "term", "n").join(small_enough(vocabulary), ["lang", "term"]),
        "divergence-held",
    )
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        marks.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(small_enough(langs), "lang")
        .withColumn("own", F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int")),
        "divergence-groups",
    )
    shared = small_enough(groups.select("lang", "source", "total", "terms", "lang_total"))
    weighed = held.join(shared, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    # One slice per group and term block (at most about ``term_block`` places), also where the group has no term.
    slices = weighed.groupBy("lang", "source", "part").agg(
        F.collect_list(F.struct("place", "p")).alias("slice")
    )
    everywhere = groups.select(
        "lang", "source", "own", "group_blocks", "terms", "total", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("part")
    ).join(small_enough(widths), ["lang", "part"], "left").join(slices, ["lang", "source", "part"], "left")
    base = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.greatest("terms", F.lit(1)))).otherwise(F.lit(0))
    cells = everywhere.select(
        "lang", "source", "own", "part", base.alias("base"), F.coalesce("width", F.lit(0)).alias("width"),
        F.col("slice.place").alias("places"), F.col("slice.p").alias("shares"),
        F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other"),
    ).withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")}).drop("other")
    partial = cells.groupBy("lang", "first", "second", "part").applyInArrow(
        _cell, "lang string, a string, b string, value long"
    )
    pairs = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )).alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")

    over = F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = weighed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value")).where("value > 0")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(by).alias("rank")
    return both.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top_terms))


ORACLE_SQL = r"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
w as (select id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term, count(*) as n from w group by lang, term having count(distinct id) >= 30),
l as (select lang, count(*) as v, sum(n) as n from k group by lang),
g as (select distinct lang, source from d),
c as (select w.lang, w.source, w.term, count(*) as n from w join k on k.lang = w.lang and k.term = w.term group by all),
gn as (select g.lang, g.source, coalesce(sum(c.n), 0) as n from g left join c on c.lang = g.lang and c.source = g.source group by all),
p as (
  select gn.lang, gn.source, k.term, coalesce(c.n, 0) as cnt,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)::hugeint) // (gn.n + 5 * l.v)::hugeint as p,
    1 + (1000000000::hugeint * (k.n + 5)::hugeint) // (l.n + 5 * l.v)::hugeint as q
  from gn join k on k.lang = gn.lang join l on l.lang = gn.lang
  left join c on c.lang = gn.lang and c.source = gn.source and c.term = k.term),
s as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
x as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, p - q from p where cnt > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from x)
select lang, source, part, item, value::bigint as value, rank::integer as rank from r where part = 'pair' or rank <= 50
"""
