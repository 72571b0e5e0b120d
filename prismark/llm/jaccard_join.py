"""Operator 5: n-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct word n-grams (as 64-bit hashes).  Documents
link when intersection / union >= p / q.  Sizes are cut into bands; sets of one
band, or near the edge of neighbouring bands, that link differ in at most
k = 2 (q - p) / (q + p) * (top of the band) elements.  The hash space is cut into
first-level parts and each of these into ``subs`` second-level parts; for every
first-level part and every choice of ``subs - skip`` of its second-level parts, the
chosen elements are hashed to one signature.  With n1 = k // (skip + 1) + 1 first-level
parts at least one part differs in at most ``skip`` elements, so linking sets share a
signature: no link is lost.  ``spare`` adds first-level parts; a set may then leave
out its signatures of fewer than ``weak`` elements (which unrelated sets would
share), as long as these lie in no more parts than were added.

An element that only one class holds is in no intersection.  So a class of which more than
1 - p / q of the elements are its own links to nothing; most texts go this way, by a
part of the hash space that is wide enough for it.  Of the others the elements that none
of them shares are counted exactly and taken out of the set: what is left (``rest``) has the same
intersections, and two sets differ in their own elements besides what their rests differ in.

Candidates are first held against a sketch: a byte of hash per cell of a fine partition
of the hash space, which has more cells for larger sets.  Rests differ in at least one
element per cell with different hashes; pairs for which this and their own elements are more
than they may differ in cannot link, so this rejects no link.

Equal sets are one class; only classes are joined.  Of the sets that share a
signature each is first compared with one leader, which joins groups of
near copies with as many comparisons as they have members.  What then still
lies in different components under one signature meets in blocks: each set outside
the leader's component proposes, for each other component, its nearest sets by
sketch, a few at first and four times as many in every further round.  Proposals are
compared by full sets, components merge, and rounds go on until no proposal was
held back, so the result is exact and the number of proposals stays in proportion to
the members of a signature where one of the nearest sets links.  Tables that a later
one replaces are deleted.

Defined cases: null and empty texts have an empty set and are linked with
nothing (their component is their own id); a text with fewer than n words is
one n-gram; repeated rows are one class, and rows that share an id one
document; rows without an id take part in links, their component is null if no
linked row has an id (where ids are null or stand for several texts, all is joined
by id and digest of the text first, and ids are put in at the end); an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from prismark.llm.components import connected
from prismark.llm.runtime import discard, free_shuffles, small_enough, stored, tidy

M1, M2, M3 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: Cells of a sketch at least, a byte of hash each; doubled until there is one for two elements.
CELLS = 256
#: The part of the hash space that is searched for elements of one class only, in units of 1 - p / q.
SAMPLE = 2.25
#: Bytes of sketches that may be broadcast.
BROADCAST_BYTES = 1 << 27
#: Members of a signature in one block.
BLOCK = 512
#: Bytes of rows with sketches that one task of blocks sorts, about.
TASK_BYTES = 1 << 25
#: Bytes of sketches that are compared at once.
COMPARED_BYTES = 1 << 22
#: Pairs of rows of one signature that are looked at together.
PAIRS = 1 << 18
#: Rounds of leaders before blocks.
LEADERS = 2
#: Sets of another component that a member proposes in the first round of blocks.
PROPOSALS = 4


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(M2)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(M3)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown as needed."""

    def __init__(self, base: int = 0x5851F42D4C957F2D):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))), dtype=np.uint64)
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


def word_hashes(text: str, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every word, A-Z lower-cased; words are separated by the six ASCII white-space characters."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(M1))


def gram_set(text: str | None, n: int, powers: Powers) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of words; all words as one if there are fewer than n."""
    with np.errstate(over="ignore"):
        words = word_hashes(text or "", powers)
        if not len(words):
            return words
        width = min(n, len(words))
        grams = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            grams = mix(grams * np.uint64(M1) + words[k : len(words) - width + 1 + k])
        return np.unique(grams)


class PartEnum:
    """Signatures of sets for the threshold p / q."""

    def __init__(self, p: int, q: int, subs: int, skip: int, spare: float, weak: int, growth: float = 1.3):
        self.p, self.q, self.subs, self.skip, self.spare, self.weak = p, q, subs, skip, spare, weak
        self.choices = list(itertools.combinations(range(subs), subs - skip))
        self.growth = growth
        first = 1
        while self.distance(first + 1) == 0:
            first += 1
        self.tops = [first]

    def distance(self, top: int) -> int:
        """The most elements in which two linking sets of at most ``top`` elements differ."""
        return 2 * (self.q - self.p) * top // (self.q + self.p)

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            low = self.tops[-1] + 1
            # no band is so narrow that sets could link past the next one
            self.tops.append(max(low, int(low * self.growth), low * self.q // self.p))
        return int(np.searchsorted(self.tops, size))

    def signatures(self, grams: np.ndarray, size: int | None = None) -> np.ndarray:
        """All signatures of a set, as signed 64-bit numbers; of ``size`` elements, if ``grams`` are but those that others hold."""
        if not len(grams):
            return np.zeros(0, np.int64)
        size = size or len(grams)
        band = self.band(size)
        bands = [band]
        if size * self.q >= self.p * (self.tops[band] + 1):
            self.band(self.tops[band] + 1)
            bands.append(band + 1)
        with np.errstate(over="ignore"):
            spread = mix(grams + np.uint64(M1))
            value = mix(grams ^ np.uint64(M3))
            out = [self._of_band(b, spread, value) for b in bands if self.distance(self.tops[b])]
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)

    def _of_band(self, band: int, spread: np.ndarray, value: np.ndarray) -> np.ndarray:
        least = self.distance(self.tops[band]) // (self.skip + 1) + 1
        extra = int(self.spare * least)
        n1, n2 = least + extra, self.subs
        part = ((spread >> np.uint64(32)) * np.uint64(n1)) >> np.uint64(32)
        sub = ((spread & np.uint64(0xFFFFFFFF)) * np.uint64(n2)) >> np.uint64(32)
        cell = (part * np.uint64(n2) + sub).astype(np.int64)
        low = np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n1 * n2)
        high = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), n1 * n2)
        sums = (low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))).reshape(n1, n2)
        count = np.bincount(cell, minlength=n1 * n2).reshape(n1, n2)
        seed = np.uint64(band + 1) * np.uint64(M1) + np.arange(n1, dtype=np.uint64) * np.uint64(M2)
        found = np.stack([mix(sums[:, c].sum(axis=1) + seed + np.uint64(k) * np.uint64(M3)) for k, c in enumerate(self.choices)], 1)
        few = np.stack([count[:, c].sum(axis=1) < self.weak for c in self.choices], 1)
        if few.any() and few.any(axis=1).sum() <= extra:
            return found[~few]
        return found.ravel()


def set_key(grams: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    with np.errstate(over="ignore"):
        a = mix(grams + np.uint64(M2)).sum(dtype=np.uint64)
        b = mix(grams * np.uint64(M3) + np.uint64(len(grams))).sum(dtype=np.uint64)
    return a.tobytes() + b.tobytes()


def cell_hashes(grams: np.ndarray) -> bytes:
    """A byte of hash for each cell of the hash space; the cells are a power of two times ``CELLS``."""
    cells = CELLS
    while 2 * cells < len(grams):
        cells *= 2
    with np.errstate(over="ignore"):
        h = mix(grams ^ np.uint64(M1))
    cell = ((h >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    sums = np.bincount(cell, (h & np.uint64(255)).astype(np.float64), cells)
    return (sums.astype(np.int64) & 255).astype(np.uint8).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch in ``size`` cells: hashes of neighbouring cells add up."""
    held = np.frombuffer(sketch, np.uint8)
    return held if len(held) == size else held.reshape(size, -1).sum(axis=1, dtype=np.uint8)


def coarse(sketches, size: int = CELLS) -> np.ndarray:
    """Sketches as rows of ``size`` bytes."""
    out = np.empty((len(sketches), size), np.uint8)
    for k, s in enumerate(sketches):
        out[k] = folded(s, size)
    return out


def least_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A lower bound of the elements in which sets differ, from rows of sketches."""
    return np.count_nonzero(x != y, axis=-1)


def finest_distance(x, y) -> np.ndarray:
    """The same bound for pairs of whole sketches, over as many cells as both have."""
    size = np.minimum(np.fromiter(map(len, x), np.int64, len(x)), np.fromiter(map(len, y), np.int64, len(y)))
    out = np.zeros(len(size), np.int64)
    for n in np.unique(size).tolist():
        rows, step = np.flatnonzero(size == n), max(1, COMPARED_BYTES // n)
        for at in range(0, len(rows), step):
            some = rows[at : at + step].tolist()
            out[some] = least_distance(coarse([x[k] for k in some], n), coarse([y[k] for k in some], n))
    return out


def _lists(values: list):
    """Arrays of 64-bit numbers as one Arrow array of lists."""
    import pyarrow as pa

    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def sketch(docs: DataFrame, n: int, share: float, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, key, node, sample`` of every row: size, set key (null: empty), its first half, the elements in the first ``share`` of the hash space."""
    kind = docs.schema[id_col].dataType.simpleString()
    top = np.uint64(min(int(share * 2.0**64), 2**64 - 1))

    def run(batches):
        import pyarrow as pa

        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                size, key, sample = [], [], []
                for text in part.column(1):
                    grams = gram_set(text.as_py(), n, powers)
                    size.append(len(grams))
                    key.append(set_key(grams) if len(grams) else None)
                    sample.append(grams[: np.searchsorted(grams, top, "right")])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                        pa.array([k and _node(k) for k in key], pa.int64()), _lists(sample),
                    ],
                    names=["doc_id", "n_shingles", "key", "node", "sample"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), f"doc_id {kind}, n_shingles long, key binary, node long, sample array<long>"
    )


def alone(held: DataFrame) -> DataFrame:
    """The rows of ``held`` (node, gram) whose element no other node holds, each once."""
    ends = held.groupBy("gram").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    return ends.where("lo = hi").select(F.col("lo").alias("node"), "gram")


def sets_of(docs: DataFrame, wanted: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``rep, node, grams`` (64-bit hashes, all different) of the documents whose id is in ``wanted.rep``, one row an id."""
    ids = small_enough(wanted.select(F.col("rep").alias("_id")))
    rows = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text"))
    rows = rows.join(ids, F.col("rep") == F.col("_id"), "left_semi")
    kind = rows.schema["rep"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [gram_set(t.as_py(), n, powers) for t in part.column(1)]
                nodes = [_node(set_key(m)) if len(m) else None for m in made]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes, pa.int64()), _lists(made)], names=["rep", "node", "grams"])

    made = rows.mapInArrow(tidy(run), f"rep {kind}, node long, grams array<long>").where("node is not null")
    return made.groupBy("rep").agg(F.first("node").alias("node"), F.first("grams").alias("grams"))


def rests(sets: DataFrame, join: PartEnum) -> DataFrame:
    """``rep, size, alone, rest, cells, sigs`` of the sets that can link to another of ``sets``: the elements that others
    hold, the number of those that none holds, sketch and signatures of the rest."""
    own = alone(sets.select("node", F.explode("grams").alias("gram"))).groupBy("node").agg(F.collect_list("gram").alias("own"))
    kind = sets.schema["rep"].dataType.simpleString()
    p, q = join.p, join.q

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keep, size, rest, cells, sigs = [], [], [], [], []
                for k, (grams, own) in enumerate(zip(part.column(1), part.column(2))):
                    grams = grams.values.to_numpy().view(np.uint64)
                    left = np.setdiff1d(grams, own.values.to_numpy().view(np.uint64), assume_unique=True) if own.is_valid else grams
                    if q * len(left) < p * len(grams):
                        continue
                    keep.append(k)
                    size.append(len(grams))
                    rest.append(left)
                    cells.append(cell_hashes(left))
                    sigs.append(np.unique(join.signatures(left, len(grams))))
                counts = [pa.array(size, pa.int64()), pa.array([n - len(r) for n, r in zip(size, rest)], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keep, pa.int64())), *counts, _lists(rest), pa.array(cells, pa.binary()), _lists(sigs)],
                    names=["rep", "size", "alone", "rest", "cells", "sigs"],
                )

    return sets.join(own, "node", "left").select("rep", "grams", "own").mapInArrow(
        tidy(run), f"rep {kind}, size long, alone long, rest array<long>, cells binary, sigs array<long>"
    )


def possible(pairs: DataFrame, cells: DataFrame, p: int, q: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """The pairs ``a, b`` whose sketches do not rule out a link; ``cells``: rep, size, alone, cells."""
    left, right = (
        cells.select(F.col("rep").alias(s), F.col("size").alias(f"s{s}"), F.col("alone").alias(f"o{s}"), F.col("cells").alias(f"c{s}"))
        for s in ("a", "b")
    )

    @F.pandas_udf("long")
    def differ(x, y):
        import pandas as pd

        if not len(x):
            return pd.Series([], dtype="int64")
        return pd.Series(finest_distance(list(x), list(y)))

    if sketch_bytes(cells) <= most:
        left, right = F.broadcast(left), F.broadcast(right)
    both = pairs.join(left, "a").join(right, "b")
    apart = differ("ca", "cb") + F.col("oa") + F.col("ob")
    return both.where(apart * (q + p) <= (F.col("sa") + F.col("sb")) * (q - p)).select("a", "b")


def sketch_bytes(cells: DataFrame) -> int:
    return cells.agg(F.coalesce(F.sum(F.length("cells")), F.lit(0))).first()[0]


def block_tasks(rows: DataFrame) -> int:
    """Tasks for the blocks of ``rows``, by the bytes that they have with their sketches: these are joined to rows already dealt, so Spark sees far fewer."""
    sides = F.when(F.col("component") != F.col("component2"), 2).otherwise(1)
    row = F.greatest(F.lit(CELLS), F.col("size")) + 100  # a sketch has no more cells than its set has elements, or CELLS
    total = rows.agg(F.sum(F.ceil(F.col("m") / BLOCK) * sides * row)).first()[0]
    return (total or 0) // TASK_BYTES + 1


def one_of_each(signed: DataFrame) -> DataFrame:
    """``sig`` of ``signed`` (sig, rep) that several sets hold; of those with the same members only one, since they propose the same pairs."""
    # each set holds a signature once, so 128 bits of its members' hashes and their number stand for all of them
    members = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("rep"))).alias(f"h{seed}") for seed in (1, 2)]
    held = signed.groupBy("sig").agg(F.count(F.lit(1)).alias("held"), *members).where("held > 1")
    return held.groupBy("held", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig")


def tile_blocks(total: int, cores: int) -> int:
    """Blocks of all sets, whose sketches have ``total`` bytes: a tile of two holds ``TASK_BYTES`` about, and there are two tiles a core at least."""
    return max(-(-2 * total // TASK_BYTES), math.isqrt(2 * cores - 1) + 1)


def in_tiles(rows: DataFrame, cells: DataFrame, blocks: int, groups: int) -> DataFrame:
    """The sides of ``in_blocks`` without sketches, dealt to tiles ``i, j``, and a row (``side`` -1) with the sketch of each set in a tile.

    Members of a large signature meet in tiles of ``blocks`` blocks of all sets, those of others as a whole, together with
    the signatures that have the same first member: near copies share many signatures, but need few sketches twice.
    """
    own = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("own")
    placed = rows.select("sig", "rep", "component", "m", (F.col("component") != F.col("component2")).alias("minor"), own)
    # at most ``blocks`` of either: the blocks that a signature has members in
    met = placed.groupBy("sig").agg(
        F.collect_set("own").alias("members"), F.collect_set(F.when(F.col("minor"), F.col("own"))).alias("minors"),
        F.pmod(F.min(F.xxhash64("rep")), F.lit(groups)).cast("int").alias("first"),
    )
    base, tile = placed.join(met, "sig"), lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    whole = F.when(F.col("m") <= BLOCK, F.array(tile(F.lit(-1), F.col("first"))))
    minor = base.where("minor").withColumn("t", F.explode(whole.otherwise(F.transform("members", lambda b: tile(F.col("own"), b))))).withColumn("side", F.lit(0))
    member = base.withColumn("t", F.explode(whole.otherwise(F.transform("minors", lambda b: tile(b, F.col("own")))))).withColumn("side", F.lit(1))
    sides = minor.unionByName(member).select("sig", "t.i", "t.j", "side", "rep", "component")
    needed = sides.select("i", "j", "rep").distinct().join(cells, "rep").withColumns({"sig": F.lit(0).cast("long"), "side": F.lit(-1)})
    return sides.unionByName(needed, allowMissingColumns=True)


def in_blocks(rows: DataFrame, cells: DataFrame, p: int, q: int, limit: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """Pairs ``a, b`` under one signature, in different components, that sketches allow.

    ``rows``: sig, rep, size, component, component2 (the leader's), m (members of the
    signature).  Members outside the leader's component meet all members, block by
    block; a block pair is one run of sorted rows in some task.  A member proposes
    the ``limit`` nearest of each other component; ``more`` marks proposals of which
    others were held back.  Sketches of more than ``most`` bytes are not broadcast, but
    go to each tile that has a row of their set once (``in_tiles``).
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    base = rows.select("sig", "rep", "component", "component2", own.alias("own"), every.alias("other"))
    minor = base.where(F.col("component") != F.col("component2")).select(
        "sig", F.col("own").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "rep", "component"
    )
    member = base.select("sig", F.col("other").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "rep", "component")
    key, tasks, total = ("i", "j", "sig"), block_tasks(rows), sketch_bytes(cells)
    whole_tiles = total > most
    if not whole_tiles:  # sketches are looked up where the rows have been dealt to
        both = minor.unionByName(member).repartition(tasks, *key).join(F.broadcast(cells), "rep")
    else:
        cores = rows.sparkSession.sparkContext.defaultParallelism
        both = in_tiles(rows, cells, tile_blocks(total, cores), tasks).repartition(tasks, "i", "j")
    both = both.select(*key, "side", "size", "cells", "rep", "component", "alone")
    kind = rows.schema["rep"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        def candidates(side, rep, component, size, whole, own):
            n0 = side.count(0)
            if not n0 or n0 == len(side):
                return
            codes = {}
            comp = np.array([codes.setdefault(c, len(codes)) for c in component])
            if len(codes) == 1:
                return
            rep, size, own = np.array(rep, object), np.array(size), np.array(own)
            sketch = coarse(whole)
            fine = np.fromiter(map(len, whole), np.int64, len(whole)) > sketch.shape[1]
            step = min(32, max(1, PAIRS // (len(rep) - n0)))
            for at in range(0, n0, step):
                to = min(at + step, n0)
                sums = size[at:to, None] + size[None, n0:]
                # elements in which the rests may differ
                room = sums * (q - p) // (q + p) - own[at:to, None] - own[None, n0:]
                fits = q * np.minimum(size[at:to, None], size[None, n0:]) >= p * np.maximum(size[at:to, None], size[None, n0:])
                x, y = np.nonzero(fits & (room >= 0) & (comp[at:to, None] != comp[None, n0:]))
                room = room[x, y]
                apart = np.concatenate([
                    least_distance(sketch[at + x[k : k + 4096]], sketch[n0 + y[k : k + 4096]]) for k in range(0, len(x), 4096)
                ] or [np.zeros(0, np.int64)])
                ok = apart <= room
                x, y, apart, room = x[ok], y[ok], apart[ok], room[ok]
                both_fine = np.flatnonzero(fine[at + x] & fine[n0 + y])
                if len(both_fine):
                    apart[both_fine] = finest_distance([whole[at + k] for k in x[both_fine].tolist()], [whole[n0 + k] for k in y[both_fine].tolist()])
                ok = apart <= room
                x, y, apart = x[ok], y[ok], (apart + own[at + x] + own[n0 + y])[ok]
                if len(x):
                    to_comp = comp[n0 + y]
                    order = np.lexsort((y, apart, to_comp, x))
                    x, y, to_comp = x[order], y[order], to_comp[order]
                    first = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (to_comp[1:] != to_comp[:-1]))))
                    count = np.diff(np.append(first, len(x)))
                    rank = np.arange(len(x)) - np.repeat(first, count)
                    near, more = rank < limit, np.repeat(count > limit, count)
                    a, b = rep[at + x[near]], rep[n0 + y[near]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([min(u, v) for u, v in zip(a, b)], id_type), pa.array([max(u, v) for u, v in zip(a, b)], id_type), pa.array(more[near])],
                        names=["a", "b", "more"],
                    )

        held, key, known = [[], [], []], None, {}  # known: the sketches of a tile, or of a run
        for batch in batches:
            id_type = batch.schema.field("rep").type
            side = batch.column(3).to_numpy()
            keys = np.stack([*(batch.column(k).to_numpy() for k in range(3)), side < 0], 1)
            rows = [side.tolist(), *(batch.column(c).to_pylist() for c in ("rep", "component"))]
            sketches = list(zip(*(batch.column(c).to_pylist() for c in ("size", "cells", "alone"))))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(keys)]
            for u, v in zip(edges[:-1], edges[1:]):
                if u == v:
                    continue
                if held[0] and key != tuple(keys[u].tolist()):
                    yield from candidates(*held, *zip(*map(known.__getitem__, held[1])))
                    held = [[], [], []]
                if (not key or key[:2] != tuple(keys[u, :2].tolist())) if whole_tiles else not held[0]:
                    known = {}
                key = tuple(keys[u].tolist())
                if sketches[u][1] is not None:
                    known.update(zip(rows[1][u:v], sketches[u:v]))
                if side[u] >= 0:
                    for have, values in zip(held, rows):
                        have.extend(values[u:v])
        if held[0]:
            yield from candidates(*held, *zip(*map(known.__getitem__, held[1])))

    return both.sortWithinPartitions("i", "j", F.col("side") >= 0, "sig", "side").mapInArrow(tidy(run), f"a {kind}, b {kind}, more boolean").groupBy("a", "b").agg(
        F.max("more").alias("more")
    )


def verified(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold; ``sets``: rep, size, rest (all elements that another set holds)."""
    left, right = (sets.select(F.col("rep").alias(s), F.col("size").alias(f"s{s}"), F.col("rest").alias(f"g{s}")) for s in ("a", "b"))

    # 64-bit hashes, so one row at a time in the JVM: batches of whole sets would take far more memory than one pair does
    common = F.size(F.array_intersect("ga", "gb"))
    enough = common.cast("long") * (q + p) >= (F.col("sa") + F.col("sb")) * p
    return pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")


def jaccard_components(
    docs: DataFrame, n: int = 5, p: int = 80, q: int = 100, subs: int = 2, skip: int = 1, spare: float = 0.15, weak: int = 1,
    id_col: str = "doc_id", text_col: str = "text", lean: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    ``lean`` trades time for disk where the threshold is low: the sampled elements are made
    anew instead of being stored, and only a quarter as many sketches are broadcast.  The
    result is the same.
    """
    join = PartEnum(p, q, subs, skip, spare, weak)
    share = min(1.0, SAMPLE * (q - p) / q)
    rows = stored(sketch(docs, n, 0.0 if lean else share, id_col, text_col), "join-sketch")
    if not _one_text_an_id(rows):
        discard(rows)
        return _by_id_and_text(docs, n, p, q, subs, skip, spare, weak, id_col, text_col, lean)
    classes = stored(
        rows.where(F.col("key").isNotNull()).groupBy("node", "key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size")),
        "join-classes",
    )
    if lean:
        free_shuffles(docs.sparkSession)
    sample = (sketch(docs, n, share, id_col, text_col) if lean else rows).select("node", F.explode("sample").alias("gram"))
    own = alone(sample).groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    able = stored(
        classes.join(own, "node", "left").where(q * (F.col("size") - F.coalesce("own", F.lit(0))) >= p * F.col("size")).select("rep"),
        "join-able",
    )
    if lean:
        free_shuffles(docs.sparkSession)
    sets = stored(sets_of(docs, able, n, id_col, text_col), "join-sets")
    core = stored(rests(sets, join), "join-rests")
    discard(able, sets)
    signed = core.select(F.explode("sigs").alias("sig"), "rep", "size", "alone")
    table = stored(signed.join(one_of_each(signed), "sig"), "join-signatures")
    labels = _link(table, core, p, q, lean)
    answer = rows.select("doc_id", "n_shingles", "node", "key").join(
        classes.select(F.col("node").alias("_n"), F.col("key").alias("_k"), "rep"),
        (F.col("node") == F.col("_n")) & (F.col("key") == F.col("_k")), "left",
    )
    if labels is not None:
        answer = answer.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        answer = answer.withColumn("component", F.lit(None).cast(answer.schema["rep"].dataType))
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("rep"))
    return answer.select("doc_id", "n_shingles", F.coalesce("component", own).alias("component_id"))


def _one_text_an_id(rows: DataFrame) -> bool:
    """Whether every row with a set has an id, and no id has two sets."""
    held = rows.where(F.col("node").isNotNull()).groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    return held.where(F.col("doc_id").isNull() | (F.col("lo") < F.col("hi"))).isEmpty()


def _by_id_and_text(docs, n, p, q, subs, skip, spare, weak, id_col, text_col, lean) -> DataFrame:
    """``jaccard_components`` where ids do not tell texts apart: rows that share an id hold together, null ids are no ids."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.when(F.col(id_col).isNull(), F.lit("none")).otherwise(F.concat(F.lit("id "), F.col(id_col).cast("string")))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.concat(name, F.lit(" "), F.sha2(text.cast("binary"), 256)).alias("row"), text.alias("text")
    )
    joined = jaccard_components(rows, n, p, q, subs, skip, spare, weak, "row", "text", lean)
    joined = joined.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("part")).distinct()
    placed = stored(rows.select("doc_id", "row").join(joined, "row").select("doc_id", "n_shingles", "part"), "join-placed")
    held = placed.where(F.col("doc_id").isNotNull()).select("doc_id", "part").distinct()
    first = held.groupBy("doc_id").agg(F.min("part").alias("a"))
    same = connected(held.join(first, "doc_id").select("a", F.col("part").alias("b")).where("a <> b"))
    whole = stored(
        placed.join(same.withColumnRenamed("node", "part"), "part", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "part").alias("part")), "join-whole",
    )
    least = whole.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    # rows without an id and without words are linked with nothing, other rows without an id with their component
    alone = F.col("doc_id").isNull() & (F.col("n_shingles") == 0)
    return whole.join(least, "part").select(
        "doc_id", "n_shingles", F.when(~alone, F.col("component_id")).alias("component_id")
    )


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that link to one with a smaller id; rows without an id stay."""
    joined = jaccard_components(docs, id_col=id_col, text_col=text_col, **options)
    gone = joined.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone_id")).distinct()
    gone = small_enough(stored(gone, "join-gone"))
    return docs.join(gone, docs[id_col] == gone["_gone_id"], "left_anti")


def _link(table, core, p, q, lean) -> DataFrame | None:
    """``node, component`` of the classes that share a signature with another; None if no class does."""
    wanted = stored(table.select("rep").distinct(), "join-wanted")
    if wanted.isEmpty():
        return None
    cells = stored(core.join(small_enough(wanted), "rep", "left_semi").select("rep", "size", "alone", "cells"), "join-cells")
    fits = (q * F.least("size", "size2") >= p * F.greatest("size", "size2"))
    fits &= (F.col("alone") + F.col("alone2")) * (q + p) <= (F.col("size") + F.col("size2")) * (q - p)
    labels, edges, tried, opened, limit = None, None, None, None, PROPOSALS
    most = BROADCAST_BYTES // 4 if lean else BROADCAST_BYTES
    for turn in itertools.count():
        if labels is None:
            left = table.withColumn("component", F.col("rep"))
        else:
            left = table.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
                "component", F.coalesce("component", "rep")
            )
        open_sigs = left.groupBy("sig").agg(
            F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("m"),
            F.min(F.struct(F.xxhash64(F.col("rep"), F.lit(turn)).alias("h"), "rep", "size", "alone", "component")).alias("_lead"),
        ).where("_lo < _hi").select("sig", "m", "_lead")
        lead = open_sigs.select(
            "sig", "m", F.col("_lead.rep").alias("rep2"), F.col("_lead.size").alias("size2"), F.col("_lead.alone").alias("alone2"),
            F.col("_lead.component").alias("component2"),
        )
        left = left.join(lead, "sig")
        blocks = turn >= LEADERS
        if turn:
            left = stored(left, "join-open")
            if opened is not None:
                discard(opened)
            opened, table = left, left.select("sig", "rep", "size", "alone")  # what is closed stays closed
            if left.isEmpty():
                return labels
        if blocks:
            found = stored(in_blocks(left, cells, p, q, limit, most), "join-candidates")
            held_back = not found.where("more").isEmpty()
            pairs = found.select("a", "b")
            limit *= 4
        else:
            pairs = left.where((F.col("component") != F.col("component2")) & fits)
            pairs = pairs.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
            pairs = found = stored(possible(pairs, cells, p, q, most), "join-candidates")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "join-ends")
        sets = core.select("rep", "size", "rest").join(small_enough(ends), "rep", "left_semi")
        new = stored(verified(pairs, sets, p, q), "join-links")
        discard(ends)
        tried = found.select("a", "b") if tried is None else tried.unionByName(found.select("a", "b"))
        edges = new if edges is None else edges.unionByName(new)
        labels = connected(edges)
        if blocks and not held_back:
            return labels
