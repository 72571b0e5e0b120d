"""Source divergence, chat formatting and the filter interaction audit against plain versions."""

import collections
import hashlib
import itertools
import re

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from prismark.llm import chat_format as chat, filter_interaction as fi, source_divergence as sd
from tests.llm import brute

SF = "/root/testdata/sf0.001"
BYTE_BPE = P.path("byte_bpe_50k.json")


# --- operator 11 -----------------------------------------------------------------------------


def plain_divergence(rows, min_docs, top):
    """rows: (lang, source, text) as Python strings or None."""
    rows = [tuple(x or "" for x in r) for r in rows]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(low)) for _, _, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [(s, w) for (g, s, _), w in zip(rows, words) if g == lang]
        held = collections.Counter(t for _, w in own for t in set(w))
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        counts = {s: collections.Counter() for s, _ in own}
        for s, w in own:
            counts[s].update(t for t in w if held[t] >= min_docs)
        every = sum(counts.values(), collections.Counter())

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(every)
        for s in counts:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(found[:limit])]
    return sorted(out)


CORPUS = [
    ("en", "a", "The cat, the CAT; the dog"), ("en", "a", "the dog sat"), ("en", "b", "a cat sat on a mat"), ("en", "b", None),
    ("en", "c", "12 34 -- "), ("en", None, "the Éa éa naïve mat"), ("en", "d", "éa\x00ÉA mat dog dog dog"), ("en", "e", ""),
    (None, "a", "cat cat dog"), (None, "b", "dog"), ("xx", "only", "one two"), ("yy", "a", "p q"), ("yy", "b", "r s"),
    ("de", "z", "日本語 straße STRASSE " * 400), ("de", "z", "日本語 straße " + "wort " * 3000), ("de", "y", "wort"), ("de", "x", "x" * 5000),
    ("en", "a", "the dog sat"), ("en", "a", "the dog sat"),
]


@pytest.mark.parametrize("group_block,term_block,max_entries", [(16, 4096, 400_000), (2, 3, 10), (1, 1, 1)])
def test_divergence_equals_a_plain_version(spark, group_block, term_block, max_entries):
    df = spark.createDataFrame(
        [(*r, k, "p", 1, "t") for k, r in enumerate(CORPUS)],
        "lang string, source string, text string, part int, term string, value int, own string",
    )
    got = sd.source_divergence(df, min_docs=2, top_terms=3, group_block=group_block, term_block=term_block, max_entries=max_entries)
    assert sorted(tuple(r) for r in got.collect()) == plain_divergence(CORPUS, 2, 3)


def test_divergence_of_an_empty_table_and_of_shares_beyond_a_long(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert sd.source_divergence(empty).collect() == []
    big = spark.createDataFrame([(9 * 10**12, 10**14, 10**6), (0, 0, 1), (10**15, 10**15, 1)], "n long, total long, v long")
    got = [r[0] for r in big.select(sd._share(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in big.collect()]


# --- operator 12 -----------------------------------------------------------------------------

SAYINGS = [
    "", None, "plain words", "</s>[INST] ok [/INST]", "<|turn|>user<|text|>no<|end|>", "a <| b <\\| c <\\\\| d |<", "ends with <", "<\\",
    "| starts", "<|endoftext|>", "日本語 😀 naïve\n\n  two  spaces\t", "\x00 nul", "x" * 30_000, " ", "\n", "don't we'll", "é ￾￿",
]


def conversations():
    rows = [(0, k, "user" if k % 2 else "assistant", s) for k, s in enumerate(SAYINGS)]
    rows += [(1, k, "assistant", s) for k, s in enumerate(SAYINGS)]
    rows += [(2, 0, "system", "only"), (3, 0, None, "no role"), (3, None, "assistant", "null turn comes first")]
    rows += [(4, 1, "user", "same turn b"), (4, 1, "user", "same turn a"), (4, 1, "assistant", "c"), (4, 1, "assistant", "c")]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "nobody's"), (5, 0, "assistant", ""), (6, 0, "<|role|>", "r"), (6, 1, "assistant", "s")]
    rows += [(7, k, "assistant" if k % 2 else "user", f"turn {k} says <| this") for k in range(3000)]
    return rows


def plain_chats(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chats_read_back_what_went_in(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "f", b"i") for r in rows], "conv_id long, turn long, role string, text string, formatted string, input_ids binary")
    formatted = chat.format_chats(df, BYTE_BPE)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.summary(formatted, BYTE_BPE).collect()}
    assert got == plain_chats(rows)
    table = chat.token_bytes(BYTE_BPE)
    for r in formatted.collect():
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == len(r.loss_mask) and b"".join(table[k] for k in ids).decode() == r.formatted
        text, turns, _ = chat.read_back(r.input_ids, r.loss_mask, table)
        assert text == r.formatted and len(turns) == r.n_turns
        assert r.formatted.count("<|turn|>") == r.formatted.count("<|end|>") == r.n_turns
    users = chat.format_chats(df, BYTE_BPE, trained_roles=("user", "system")).where("conv_id = 4").first()
    assert chat.read_back(users.input_ids, users.loss_mask, table)[2] == ["same turn a", "same turn b"]


def test_chats_of_an_empty_table_and_escapes(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert chat.summary(chat.format_chats(empty, BYTE_BPE), BYTE_BPE).collect() == []
    for n in range(7):
        for text in map("".join, itertools.product("<\\|", repeat=n)):
            assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_loss_mask_is_cut_at_the_borders():
    offsets = [(0, 3), (3, 4), (4, 5), (4, 5), (4, 5), (5, 9), (9, 12)]
    assert chat.loss_mask(offsets, [(4, 9)]).tolist() == [0, 0, 1, 1, 1, 1, 0]
    assert chat.loss_mask(offsets, [(0, 3), (9, 12)]).tolist() == [1, 0, 0, 0, 0, 0, 1]
    with pytest.raises(ValueError):
        chat.loss_mask(offsets, [(1, 9)])


# --- operator 13 -----------------------------------------------------------------------------


def plain_audit(docs, labels):
    """docs: (id, source, text); labels: (id, quality, toxic).  The definition, order by order."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    ids = collections.defaultdict(list)
    for i, _, t in docs:
        ids[t or ""].append(i)
    parts = collections.defaultdict(list)
    for i, source, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": bool(set("#$%&*|") & set(t)), "E": i is not None and any(o is not None and o < i for o in ids[t]),
        }
        parts[source or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        steps, shapley = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left, gone = rows, []
            for k, f in enumerate(order):
                now, gone_before = [r for r in left if f in r[0]], gone
                left, gone = [r for r in left if f not in r[0]], gone + now
                shapley[f] += len(now)
                steps.append((part, "".join(order), k + 1, len(left), len(now), sum(f in r[0] for r in gone_before),
                              sum(r[0] == {f} for r in rows), sum(r[1] for r in now), sum(r[2] for r in now), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def test_audit_equals_the_definition(spark):
    long = " ".join(f"word{k}" for k in range(60))
    texts = [long, long, long, "SHOUT", "a b", "a b", None, "", "x " * 80, "# tag " + long, "É" * 40 + "AB", "AB" + "é" * 38, "\x00", "a　b " * 60, "%" * 9, long.upper(), "w1 w2 " * 40, long + " end"]
    docs = [(k % 15 if k != 7 else None, f"s{k % 3}" if k % 4 else None, t) for k, t in enumerate(texts * 2)]
    docs += [(1, "s1", long), (1, "s1", long), (None, None, "a b"), (99, "alone", "just one row")]
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(12)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (500, 1, 1), (4, None, None)]
    df = spark.createDataFrame([(*d, 1, "m", "v", 2) for d in docs], "doc_id long, source string, text string, n int, mask string, part string, id int")
    marks = spark.createDataFrame([(*l, 3, "x") for l in labels], "doc_id long, quality int, toxic int, good int, part string")
    got = fi.interaction_audit(fi.failure_counts(df, marks))
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fi.interaction_audit(fi.failure_counts(docs, labels)).collect() == []
    one = spark.createDataFrame([(1, "s", "a b")], docs.schema)
    rows = fi.interaction_audit(fi.failure_counts(one, labels)).collect()
    assert len(rows) == 600 and {r.shapley for r in rows if r.filter_order[r.step - 1] == "A"} == {120}


def test_potential_of_other_numbers_of_filters(spark):
    cells = [("p", 0, 4, 0, 0), ("p", 1, 3, 1, 0), ("p", 6, 5, 2, 1), ("p", 7, 2, 0, 2), ("q", 4, 1, 1, 1)]
    df = spark.createDataFrame(cells, "part string, mask int, n long, good long, toxic long")
    got = fi.interaction_audit(df, "XYZ").collect()
    assert len(got) == 2 * 6 * 3
    for part in "pq":
        rows = [r for r in got if r.part == part]
        for f in "XYZ":
            own = [r for r in rows if r.filter_order[r.step - 1] == f]
            assert {r.shapley for r in own} == {sum(r.removed for r in own)}


# --- operator 5: many members of one signature ------------------------------------------------


def test_members_of_one_signature_that_do_not_link_make_few_candidates(spark, monkeypatch):
    """5,000 different texts share one passage: proposals stay in proportion to them, and the few links are found."""
    from prismark.llm import jaccard_join as jj

    made = []

    def counted(df, name, stored=jj.stored):
        out = stored(df, name)
        if name == "join-candidates":
            made.append(out.count())
        return out

    monkeypatch.setattr(jj, "stored", counted)
    shared = " ".join(f"s{k}" for k in range(8))
    rows = [(k, shared + " " + " ".join(f"w{k}x{j}" for j in range(30))) for k in range(5000)]
    rows += [(10_000 + k, rows[7 * k][1] + " tail") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in jj.jaccard_components(df, n=3, p=80, q=100).collect()}
    assert got == {i: 7 * (i - 10_000) if i >= 10_000 else i for i in got} and len(got) == 5040
    assert sum(made) <= 5040


def test_near_copies_that_do_not_link_are_no_candidates(spark, monkeypatch):
    """250 variants of one text: 60 with one changed word link, 190 with two link to nothing and are not held against each other by full sets."""
    from prismark.llm import jaccard_join as jj

    made = []

    def counted(df, name, stored=jj.stored):
        out = stored(df, name)
        if name == "join-candidates":
            made.append(out.count())
        return out

    monkeypatch.setattr(jj, "stored", counted)
    base, rows = [f"w{k}" for k in range(150)], []
    for k, changed in enumerate([(j % 9,) for j in range(60)] + list(itertools.combinations(range(9, 29), 2))):
        words = list(base)
        for at in changed:
            words[5 * at + 3] = f"new{k}x{at}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df, n=3, p=90, q=100).collect()}
    assert got == brute.components(rows, 3, 90, 100) and sum(c == 0 for _, c in got.values()) == 60
    assert sum(made) <= 1000


def test_sketches_bound_the_distance_at_every_size():
    from prismark.llm import jaccard_join as jj

    rnd = np.random.default_rng(3)
    for size, other in ((40, 50), (1500, 1600), (1600, 9000), (20_000, 21_000)):
        base = rnd.integers(0, 1 << 63, max(size, other) + 300, np.uint64)
        x, y = np.unique(base[:size]), np.unique(base[300 : 300 + other])
        apart = len(np.setxor1d(x, y))
        a, b = jj.cell_hashes(x), jj.cell_hashes(y)
        rough = int(jj.least_distance(jj.coarse([a]), jj.coarse([b]))[0])
        assert rough <= jj.finest_distance([a], [b])[0] <= apart
        if size > 1500:
            assert jj.finest_distance([a], [b])[0] > min(apart, len(x)) // 4


def test_sketches_of_many_long_sets_are_compared_a_few_at_a_time():
    import tracemalloc

    from prismark.llm import jaccard_join as jj

    x, y = bytes(16_384), bytes(16_383) + b"x"
    tracemalloc.start()
    assert jj.finest_distance([x] * 2000, [y] * 2000).tolist() == [1] * 2000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000  # 2000 rows of both sides and their comparison take 98 MB


def test_a_task_of_blocks_sorts_a_bounded_number_of_bytes(spark, monkeypatch):
    from prismark.llm import jaccard_join as jj

    rnd = np.random.default_rng(4)
    base = [np.unique(rnd.integers(0, 1 << 63, 700, np.uint64)) for _ in range(30)]
    held = [(k, len(b), 0, bytearray(jj.cell_hashes(b))) for k, b in enumerate(base + [b[1:] for b in base])]
    cells = spark.createDataFrame(held, "rep long, size long, alone long, cells binary")
    rows = spark.createDataFrame([(7, k, n, k, 0, 60) for k, n, _, _ in held], "sig long, rep long, size long, component long, component2 long, m long")
    monkeypatch.setattr(jj, "BLOCK", 10)
    monkeypatch.setattr(jj, "TASK_BYTES", 20_000)
    # six blocks meet the rows; all but one are members outside the leader's component too
    tasks = sum(6 * (2 if k else 1) * (n + 100) for k, n, _, _ in held) // 20_000 + 1
    assert jj.block_tasks(rows) == tasks > 25
    for most in (jj.BROADCAST_BYTES, 0):
        found = jj.in_blocks(rows, cells, 80, 100, 4, most)
        assert f", {tasks}), REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
        assert {(r.a, r.b) for r in found.collect()} == {(k, k + 30) for k in range(30)}


def test_a_worker_drops_what_other_work_cached():
    from prismark.llm.runtime import tidy, worker_cached

    made = []
    build = lambda: made.append(1) or len(made)
    assert worker_cached("test", build) == 1
    assert list(tidy(lambda batches: (b + worker_cached("test", build) for b in batches), cached=True)(iter([10, 20]))) == [11, 21]
    assert list(tidy(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert worker_cached("test", build) == 2


# --- operators 1 to 3: texts that stand for themselves ------------------------------------------


def test_a_text_like_the_mark_of_an_uncut_one_keeps_its_ids():
    from tokenizers import Tokenizer

    from prismark.llm.tokens import library_encoder

    plain = Tokenizer.from_file(BYTE_BPE)
    plain.encode_special_tokens = True
    texts = ["a\0b", "a\ufffe\uffffb", "\ufffe\uffff", "x \ufffe y", "\0", "a b"]
    got = library_encoder(BYTE_BPE).encode(texts)
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_stages_keep_columns_whose_names_clash(spark):
    from prismark.llm import exact_dedup, pii

    names = ["doc_id", "text", "added", "_base", "_spans", "_d", "_r", "_gone_id", "_gone_text", "doc", "n.o"]
    rows = [(1, "write to a@b.c or 1.2.3.4", *range(9)), (2, " write to a@b.c  or 1.2.3.4", *range(9)), (3, None, *range(9)), (4, "none", *range(9))]
    df = spark.createDataFrame(rows, "`" + "` int, `".join(names).replace("`text` int", "`text` string") + "` int")
    assert df.columns == names and df.schema["text"].dataType.simpleString() == "string"
    got = {r[0]: tuple(r) for r in pii.redact(df).collect()}
    assert got == {1: (1, "write to <email> or <ip>", *range(9)), 2: (2, " write to <email>  or <ip>", *range(9)), 3: rows[2], 4: rows[3]}
    first = exact_dedup.keep_first(df)
    assert first.columns == names and {tuple(r) for r in first.collect()} == {rows[1], rows[2], rows[3]}


# --- operator 5: disk of blocks ----------------------------------------------------------------


def test_signatures_with_the_same_members_are_one(spark, monkeypatch):
    """Three texts that link share dozens of signatures, but few sets of members."""
    from prismark.llm import jaccard_join as jj

    made = []

    def watched(df, name, stored=jj.stored):
        out = stored(df, name)
        if name == "join-signatures":
            made.extend((r.sig, r.rep) for r in out.collect())
        return out

    monkeypatch.setattr(jj, "stored", watched)
    base = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(base[:-1] + [f"new{k}"])) for k in range(3)] + [(9, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df, n=3, p=80, q=100).collect()}
    assert got == brute.components(rows, 3, 80, 100)
    members = [frozenset(rep for _, rep in held) for _, held in itertools.groupby(sorted(made), lambda m: m[0])]
    assert 1 <= len(members) == len(set(members)) <= 4


def test_a_sketch_goes_once_to_a_tile_however_many_signatures_need_it(spark, monkeypatch):
    from prismark.llm import jaccard_join as jj

    rnd = np.random.default_rng(4)
    base = [np.unique(rnd.integers(0, 1 << 63, 700, np.uint64)) for _ in range(30)]
    held = [(k, len(b), 0, bytearray(jj.cell_hashes(b))) for k, b in enumerate(base + [b[1:] for b in base])]
    cells = spark.createDataFrame(held, "rep long, size long, alone long, cells binary")
    signed = [(sig, k, n, k, 0) for sig in range(50) for k, n, _, _ in held if (k + sig) % 30 < 25]
    counts = collections.Counter(r[0] for r in signed)
    rows = spark.createDataFrame([(*r, counts[r[0]]) for r in signed], "sig long, rep long, size long, component long, component2 long, m long")
    assert jj.tile_blocks(1 << 30, 6) == (1 << 31) // jj.TASK_BYTES and jj.tile_blocks(1, 6) == 4
    for block, most_tiles in ((100, 2), (10, 2 * 3 - 1)):  # in two groups as a whole; in tiles of three blocks
        monkeypatch.setattr(jj, "BLOCK", block)
        tiles = jj.in_tiles(rows, cells, 3, 2).collect()
        shipped = [(r.i, r.j, r.rep) for r in tiles if r.cells is not None]
        assert len(shipped) == len(set(shipped)) <= 60 * most_tiles < len(signed) and all((r.cells is None) == (r.side >= 0) for r in tiles)
        for pairs, most in ((jj.PAIRS, 0), (10, 0), (10, jj.BROADCAST_BYTES)):
            monkeypatch.setattr(jj, "PAIRS", pairs)
            found = jj.in_blocks(rows, cells, 80, 100, 4, most)
            assert sorted(map(tuple, found.collect())) == [(k, k + 30, False) for k in range(30)]

