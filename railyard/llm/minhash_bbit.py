"""Near-duplicate documents by b-bit MinHash (operator 6).

A document's set is its distinct word shingles. 200 hash minima per set give

* 40 band keys of 5 minima each: documents that share a key are candidates (at
  similarity 0.8 a pair shares none with probability (1 - 0.8^5)^40 = 1.2e-7);
* a packed signature of the low 4 bits of every minimum. The number of equal
  4-bit fields of a pair, corrected for chance collisions (a sixteenth of the
  unequal minima agree by accident), estimates the similarity. A candidate is
  dropped only when a pair at the threshold would score that low with
  probability under 1e-9.

Every remaining candidate is confirmed on the full sets (64-bit shingle
hashes), so no link below the threshold is ever reported.

Candidates are never listed as all pairs of a bucket. Equal sets are one class
from the start. First every bucket member is compared with the bucket's
smallest class only. Where a bucket still holds several components, the
members outside its main one are compared with the others by signature, in
blocks, and their candidates are confirmed there, from the likeliest on, until
they are connected or none is left. Only links that connect components leave a
task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import components, materialise

HASHES, ROWS, BITS = 200, 5, 4
BANDS = HASHES // ROWS
#: Rows of one side of a signature comparison.
BLOCK = 512
_MASK = (1 << 64) - 1


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    a = rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered; emptied when it has grown large."""

    def __missing__(self, word):
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, size: int, words: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text (A-Z lower-cased)."""
    w = (text or b"").lower().split()  # bytes.lower and bytes.split touch ASCII only
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    k = min(size, len(h))
    s = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
    return np.unique(s)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set, mixed once more."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):  # bounded memory for very long texts
        h = a * x[None, i:i + 1024]
        h += b
        np.minimum(out, h.min(1), out)
    return _mix(out.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


#: Bytes of a bit plane, padded to whole 64-bit words.
PLANE = -(-HASHES // 64) * 8


def pack_bits(m: np.ndarray) -> bytes:
    """The low bits of every minimum: one bit plane after the other."""
    return b"".join(np.packbits(((m >> np.uint64(j)) & np.uint64(1)).astype(np.uint8)).tobytes().ljust(PLANE, b"\0")
                    for j in range(BITS))


def equal_fields(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal b-bit fields of every row of x with every row of y (packed signatures, as 64-bit words)."""
    n = PLANE // 8
    differ = np.zeros((len(x), len(y)), np.uint8 if HASHES < 256 else np.int32)
    for w in range(n):
        d = x[:, None, w] ^ y[None, :, w]
        for j in range(1, BITS):
            d |= x[:, None, j * n + w] ^ y[None, :, j * n + w]
        differ += np.bitwise_count(d)
    return HASHES - differ.astype(np.int32)


def estimated_similarity(equal):
    """Similarity from the share of equal fields, corrected for chance collisions."""
    c = 2.0 ** -BITS
    return (equal / HASHES - c) / (1 - c)


def least_equal(threshold: float, miss: float = 1e-9) -> int:
    """Smallest count of equal fields kept: below it a pair at `threshold` has probability < miss."""
    p = threshold + (1 - threshold) * 2.0 ** -BITS
    total = 0.0
    for k in range(HASHES + 1):
        total += math.exp(math.lgamma(HASHES + 1) - math.lgamma(k + 1) - math.lgamma(HASHES - k + 1)
                          + k * math.log(p) + (HASHES - k) * math.log1p(-p)) if 0 < p < 1 else float(k == HASHES)
        if total >= miss:
            return k
    return HASHES


def _signer(size: int):
    def run(batches):
        words, (a, b) = WordHash(), _constants()
        for rb in batches:
            n, cls, bits, bands = [], [], [], []
            for t in rb.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(t, size, words)
                n.append(len(s))
                if not len(s):
                    cls.append(None), bits.append(None), bands.append(None)
                    continue
                m = minima(s, a, b)
                cls.append(xxhash.xxh3_128_digest(s.tobytes()))
                bits.append(pack_bits(m))
                k = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
                for r in range(ROWS):
                    k = _mix(k * np.uint64(0x9E3779B97F4A7C15) + m[r::ROWS][:BANDS])
                bands.append(k.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(bits, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n", "cls", "bits", "bands"])
    return run


def _sets(size: int):
    def run(batches):
        words, seen = WordHash(), set()
        for rb in batches:
            out, ids = [], []
            for i, cls, t in zip(*(rb.column(c).to_pylist() for c in (0, 1)), rb.column(2).cast(pa.binary()).to_pylist()):
                if i in seen:  # a further row of the same document
                    continue
                s = shingle_set(t, size, words)
                if xxhash.xxh3_128_digest(s.tobytes()) == cls:
                    seen.add(i)
                    ids.append(i), out.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["id", "shingles"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of `pairs` (a, b: classes) whose full sets are similar enough."""
    sa = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    # First the many-sided end, then the end that may be one class for many
    # pairs: its set is joined last, so it is not carried through a shuffle.
    inter = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sb, "b").join(sa, "a")
            .where(100 * inter >= percent * (F.size("sa") + F.size("sb") - inter)).select("a", "b"))


def _overlaps(one: np.ndarray, others: list) -> np.ndarray:
    """Sizes of the intersections of one sorted set with others."""
    size = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    return np.add.reduceat((one[at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(size)[:-1])))


def _missing_links(least: int, percent: int):
    """Per task of active rows against other rows: links that connect two components.

    A row's candidates are tried from the likeliest on, and not beyond the
    point where they are connected; each is confirmed on the full sets.
    """
    def run(key, t):
        act = np.asarray(t.column("active").to_numpy(zero_copy_only=False), bool)
        ids, comp = t.column("id").to_numpy(), t.column("comp").to_numpy()
        sig = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(len(ids), -1)
        column = t.column("shingles").combine_chunks()
        flat, cut = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
        sets = [np.sort(flat[cut[i]:cut[i + 1]]) for i in range(len(ids))]
        size = np.diff(cut)
        names = dict(zip(comp.tolist(), comp.tolist()))

        def name(c):
            while names[c] != c:
                names[c] = c = names[names[c]]
            return c

        x, y = np.flatnonzero(act), np.flatnonzero(~act)
        a, b = [], []
        for i in range(0, len(x), 256):
            xi = x[i:i + 256]
            eq = equal_fields(sig[xi], sig[y])
            eq[comp[xi][:, None] == comp[y][None, :]] = -1
            for r, row in zip(xi, eq):
                c = np.flatnonzero(row >= least)
                c = y[c[np.argsort(-row[c], kind="stable")]]
                done, step = 0, 8
                while done < len(c):
                    some = [j for j in c[done:done + step] if name(int(comp[j])) != name(int(comp[r]))]
                    done, step = done + step, 512
                    if not some:
                        continue
                    both = _overlaps(sets[r], [sets[j] for j in some])
                    for j in np.array(some)[100 * both >= percent * (size[r] + size[some] - both)]:
                        p, q = name(int(comp[j])), name(int(comp[r]))
                        if p != q:
                            names[max(p, q)] = min(p, q)
                            a.append(ids[r]), b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _between_components(mem: DataFrame, comps: DataFrame, classes: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """Links between classes that share a bucket but are in different components.

    All open buckets (with several components) that have the same main
    component are searched together, so a class's set is shipped once for
    them, not once for each bucket.
    """
    m = (mem.join(comps.select(F.col("node").alias("id"), "component"), "id", "left")
         .select("key", "id", F.coalesce("component", "id").alias("comp")))
    per = m.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    open_ = (per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("main"), F.sum("c").alias("all"))
             .where("main.c < all").select("key", F.col("main.comp").alias("main")))
    near = materialise(m.join(open_, "key").select("main", "id", "comp").distinct(), "neighbourhoods")
    count = near.groupBy("main").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("comp") != F.col("main")).alias("active"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("bigint").alias("n" + c)
    rows = (near.join(count.select("main", blocks("all"), blocks("active")), "main")
            .withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1_000_003))))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n" + c) - 1))
    # active rows (outside the main component) meet every block of all rows, and
    # every row meets every block of active rows
    active = rows.where("comp <> main").select("main", "id", "comp", (F.col("h") % F.col("nactive")).alias("bx"),
                                               upto("all").alias("by"), F.lit(True).alias("active"))
    others = rows.select("main", "id", "comp", upto("active").alias("bx"), (F.col("h") % F.col("nall")).alias("by"),
                         F.lit(False).alias("active"))
    return (active.select(*others.columns).unionByName(others)
            .join(sets.join(classes.select("id", "bits"), "id"), "id")
            .groupBy("main", "bx", "by").applyInArrow(_missing_links(least, percent), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Links rows whose sets of `shingle`-word shingles have 100 * intersection >=
    `percent` * union; ``component_id`` is the smallest id reachable. Words are
    runs of non-white-space after lower-casing A-Z; a text with fewer words than
    `shingle` is one shingle as a whole.

    Defined cases: null, empty and white-space texts have no shingles, link with
    nothing and are kept. Rows that repeat an id each get a row; the id's links
    are those of all its rows. A null id links with nothing (component null,
    kept). Other columns, whatever their names, are ignored. An empty table
    gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sigs = materialise(docs.mapInArrow(_signer(shingle), "doc_id bigint, n bigint, cls binary, bits binary, bands array<bigint>"), "signatures")
    rows = sigs.where("cls is not null and doc_id is not null")
    # Equal sets have equal signatures. A class is numbered as the table is
    # written, so its number stays the same for every later reader.
    classes = (rows.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.any_value("bits").alias("bits"), F.any_value("bands").alias("bands"))
               .withColumn("id", F.monotonically_increasing_id()))
    classes = materialise(classes, "classes")

    mem = classes.select("id", F.explode("bands").alias("key"))
    heads = mem.groupBy("key").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    mem = materialise(mem.join(heads, "key"), "buckets")
    wanted = mem.select("id").distinct().join(classes.select("id", "cls", "doc_id"), "id")
    sets = materialise(docs.join(wanted, "doc_id").select("id", "cls", "text").mapInArrow(_sets(shingle), "id bigint, shingles array<bigint>"), "sets")

    least = least_equal(percent / 100)
    equal = F.lit(HASHES) - _differing("x", "y")
    bits = classes.select("id", "bits")
    pairs = (mem.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
             .join(bits.select(F.col("id").alias("b"), F.col("bits").alias("y")), "b")
             .join(bits.select(F.col("id").alias("a"), F.col("bits").alias("x")), "a")
             .where(equal >= least).select("a", "b"))
    # rows of one id with different texts are one node
    spread = rows.groupBy("doc_id").agg(F.min("cls").alias("one"), F.max("cls").alias("other")).where("one <> other").select("doc_id")
    same = rows.select("doc_id", "cls").join(spread, "doc_id").join(classes.select("cls", "id"), "cls").select("doc_id", "id")
    same = same.groupBy("doc_id").agg(F.min("id").alias("a")).join(same, "doc_id").select("a", F.col("id").alias("b"))
    links = materialise(_confirmed(pairs, sets, percent).unionByName(same.where("a <> b")), "links")

    comps = components(links)
    several = mem.where("m > 2").select("key", "id")
    new = materialise(_between_components(several, comps, classes, sets, least, percent), "links")
    if new.limit(1).count():
        comps = components(new.unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    named = (classes.join(comps.select(F.col("node").alias("id"), "component"), "id", "left")
             .select("cls", "doc_id", F.coalesce("component", "id").alias("component")))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(smallest, "component").select("cls", "component_id")
    comp = F.coalesce("component_id", "doc_id")
    return (sigs.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("cls")).alias("cls"))
            .join(of_class, "cls", "left")
            .select("doc_id", "n_shingles", comp.alias("component_id"),
                    F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept")))


def _differing(x: str, y: str) -> F.Column:
    """Number of b-bit fields in which two packed signatures differ, with built-in functions.

    The planes are compared as hexadecimal words of 14 digits.
    """
    total = F.lit(0)
    for at in range(1, (HASHES + 7) // 8 + 1, 7):
        n = min(7, (HASHES + 7) // 8 + 1 - at)
        d = None
        for j in range(BITS):
            w = [F.conv(F.hex(F.substring(c, j * PLANE + at, n)), 16, 10).cast("long") for c in (x, y)]
            v = w[0].bitwiseXOR(w[1])
            d = v if d is None else d.bitwiseOR(v)
        total = total + F.bit_count(d)
    return total
