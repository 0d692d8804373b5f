"""Alignment of two tokenizers with corpus-wide pair counts from inverted bitmaps (operator 12).

Tokens of both vocabularies cover the same bytes. Where a token of each ends at one
byte, the two are linked, and the text falls into groups there. A linked pair of ids is
known by one number.

The corpus is inverted: for each pair and each block of `SPAN` documents a compressed bitmap
tells which documents hold the pair. What a document holds more than once is told by
further bitmaps, the multiplicity planes: plane k holds the documents with bit k
of (number of links - 1) set. Bitmaps of the same pair, block and plane that several
tasks made are OR-merged. Their popcounts give the number of documents of a pair, and
with the planes' weights its number of links; both are sums over blocks, combined
before the shuffle. The bitmaps are then the postings by which a pair's
count returns to its documents: each posting adds weight * count to all documents in it,
one block of documents at a time.

A bitmap is kept as the sorted 16-bit numbers of its documents or, where that is longer,
as one bit for each document of the block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import materialise
from railyard.llm.segments import Flat, SegmentEncoder, kept, slices

#: Documents of a block, and how many of them make the bit form the shorter one.
SPAN = 8192
DENSE = SPAN // 16
#: A pair that all blocks hold is joined with its count in so many shares.
SHARES = 16
_LOW = (1 << 32) - 1


class Aligner(SegmentEncoder):
    """Groups and links of the segments of texts, remembered with their tokens.

    A's tokens are those of a space and the text; B's are those of the text, to which the
    library adds the space.
    """

    def __init__(self, path_a: str, path_b: str):
        self.b = SegmentEncoder(path_b, plain=True)
        super().__init__(path_a, spaced=True, plain=True)
        if not (self.separable and self.b.separable):
            raise ValueError("both files must allow texts to be encoded by segments")
        self.spelled, self.b.spelled = (Flat(np.uint8) for _ in range(2))
        for enc in (self, self.b):
            enc.n_bytes = np.maximum(enc.n_bytes, 0)
            enc.spelled.extend(np.frombuffer(b"".join(x or b"" for x in enc.bytes), np.uint8), enc.n_bytes)
        # bits of an id of each vocabulary: several ids of a group make one number
        self.bits = [max(1, len(enc.bytes) - 1).bit_length() for enc in (self, self.b)]

    def reset(self) -> None:
        super().reset()
        self.b.reset()
        # per segment: tokens of B, links, whether its bytes come back, groups as text
        self.size_b, self.links, self.good, self.groups = Flat(np.int64), Flat(np.int32), Flat(np.int64), []
        self.pair_no, self.pairs = {}, []

    def _come_back(self, enc: SegmentEncoder, ids: np.ndarray, size: np.ndarray, text: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of segments with these tokens: whether the tokens' bytes are those of the segment, none of them empty."""
        n, of = enc.n_bytes[ids], np.repeat(np.arange(len(size)), size)
        ok = np.bincount(of, n, len(size)).astype(np.int64) == length
        ok[of[n == 0]] = False
        got = enc.spelled.gather(ids[ok[of]].astype(np.int64))
        wrong = got != text[np.repeat(ok, length)]
        ok[np.repeat(np.flatnonzero(ok), length[ok])[wrong]] = False
        return ok

    def _group_texts(self, a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> list[str]:
        """Groups as text, given the last token of each; equal groups of few tokens are written once."""
        a0, b0 = np.concatenate(([0], ia[:-1] + 1)), np.concatenate(([0], ib[:-1] + 1))
        na, nb = ia - a0 + 1, ib - b0 + 1
        out = np.empty(len(ia), object)
        join = lambda p, q: ",".join(map(str, p)) + "|" + ",".join(map(str, q))
        kind = na * 1024 + nb
        kind[(na >= 1024) | (nb >= 1024)] = -1
        for k in np.unique(kind).tolist():
            i = np.flatnonzero(kind == k)
            x, y = divmod(k, 1024)
            if k < 0 or x * self.bits[0] + y * self.bits[1] > 63:
                for g in i.tolist():
                    out[g] = join(a[a0[g]:ia[g] + 1].tolist(), b[b0[g]:ib[g] + 1].tolist())
                continue
            number = np.zeros(len(i), np.int64)
            for j in range(x):
                number = number << self.bits[0] | a[a0[i] + j]
            for j in range(y):
                number = number << self.bits[1] | b[b0[i] + j]
            _, first, of = np.unique(number, return_index=True, return_inverse=True)
            texts = [join(a[a0[g]:ia[g] + 1].tolist(), b[b0[g]:ib[g] + 1].tolist()) for g in i[first].tolist()]
            out[i] = np.array(texts, object)[of]
        return out.tolist()

    def added(self, keys: pa.Array, whole: bool, data: np.ndarray, size: np.ndarray) -> None:
        super().added(keys, whole, data, size)
        n = len(keys)
        if whole:  # the empty text: no tokens
            b_data, b_size, length, text = np.empty(0, np.uint32), np.zeros(n, np.int64), np.zeros(n, np.int64), np.empty(0, np.uint8)
        else:
            at = self.b.remember(keys, False)
            b_data, b_size = self.b.ids.gather(at), self.b.ids.sizes(at)
            spaced = pc.binary_join_element_wise("", keys, " ")
            length = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.frombuffer("".join(spaced.to_pylist()).encode(), np.uint8)
        ok = self._come_back(self, data, size, text, length) & self._come_back(self.b, b_data, b_size, text, length)
        if not ok.all():
            data, b_data = data[np.repeat(ok, size)], b_data[np.repeat(ok, b_size)]
        a_end, b_end = np.cumsum(self.n_bytes[data]), np.cumsum(self.b.n_bytes[b_data])
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        ia, ib = np.searchsorted(a_end, both), np.searchsorted(b_end, both)
        data, b_data = data.astype(np.int64), b_data.astype(np.int64)
        kinds, of = np.unique(data[ia] << 32 | b_data[ib], return_inverse=True)
        numbers = []
        for p in kinds.tolist():
            no = self.pair_no.setdefault(p, len(self.pairs))
            if no == len(self.pairs):
                self.pairs.append(p)
            numbers.append(no)
        # links of each segment: those that end within its bytes
        upto = np.searchsorted(both, np.cumsum(np.where(ok, length, 0)), side="right")
        self.links.extend(np.array(numbers, np.int32)[of] if len(kinds) else np.empty(0, np.int32), np.diff(upto, prepend=0))
        self.size_b.extend(b_size, np.ones(n, np.int64))
        self.good.extend(ok.astype(np.int64), np.ones(n, np.int64))
        each = self._group_texts(data, b_data, ia, ib) if len(ia) else []
        cut = [0, *upto.tolist()]
        self.groups += [";".join(each[p:q]) for p, q in zip(cut, cut[1:])]

    def aligned(self, texts: pa.Array) -> pa.RecordBatch:
        """Per text: n_a, n_b, n_groups, n_links, groups_sha256, pairs and how often each is linked."""
        i, at = self.places(texts)
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[at])
        ok = total(1 - self.good.data[i]) == 0
        n_a, n_b, n = (np.where(ok, total(x), 0) for x in (self.ids.sizes(i), self.size_b.data[i], self.links.sizes(i)))
        ok &= n_a > 0
        sha, text_of, places = [], self.groups.__getitem__, i.tolist()
        for good, a, z in zip(ok.tolist(), at[:-1].tolist(), at[1:].tolist()):
            sha.append(hashlib.sha256(";".join(map(text_of, places[a:z])).encode()).hexdigest() if good else "")
        keep = np.repeat(ok, np.diff(at))
        links = self.links.gather(i[keep]).astype(np.int64)
        key, times = np.unique(np.repeat(np.arange(len(ok)), n) << 32 | links, return_counts=True)
        start = np.searchsorted(key >> 32, np.arange(len(ok) + 1)).astype(np.int32)
        pairs = np.array(self.pairs, np.int64)[key & _LOW] if len(key) else np.empty(0, np.int64)
        lists = [pa.ListArray.from_arrays(pa.array(start), pa.array(x)) for x in (pairs, times.astype(np.int64))]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (n_a, n_b, n, n)), pa.array(sha, pa.string()), *lists],
            ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _align(path_a: str, path_b: str):
    def run(batches):
        aligner = kept(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        for rb in batches:
            for at, texts in slices(rb.column("text")):
                got = aligner.aligned(texts)
                yield pa.RecordBatch.from_arrays([rb.column("doc_id").slice(at, len(texts)), *got.columns], ["doc_id", *got.schema.names])
    return run


# --- bitmaps ---------------------------------------------------------------------

def bitmap(low: np.ndarray) -> bytes:
    """Documents of a block (sorted, distinct) as a compressed bitmap."""
    if len(low) <= DENSE:
        return low.astype("<u2").tobytes()
    bits = np.zeros(SPAN, np.uint8)
    bits[low] = 1
    return np.packbits(bits).tobytes()


def members(data: bytes, dense: bool) -> np.ndarray:
    if not dense:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def _bitmaps(pair: np.ndarray, low: np.ndarray, block: int, plane: int) -> pa.RecordBatch:
    """One bitmap for each pair; `pair` is sorted, `low` ascends within a pair."""
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    n = np.diff(np.append(first, len(pair)))
    dense = n > DENSE
    small = low[~np.repeat(dense, n)].astype("<u2")
    size = np.where(dense, SPAN // 8, 2 * n)
    data = np.empty(int(size.sum()), np.uint8)
    end = np.cumsum(size)
    data[~np.repeat(dense, size)] = small.view(np.uint8)
    for k in np.flatnonzero(dense):
        data[end[k] - size[k]:end[k]] = np.frombuffer(bitmap(low[first[k]:first[k] + n[k]]), np.uint8)
    body = pa.BinaryArray.from_buffers(pa.binary(), len(n), [
        None, pa.py_buffer(np.concatenate(([0], end)).astype(np.int32)), pa.py_buffer(data)])
    full = lambda v, kind: pa.array(np.full(len(n), v), kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(pair[first]), full(block, pa.int64()), full(plane, pa.int32()), pa.array(n, pa.int64()), pa.array(dense), body], _BITMAP_COLUMNS)


_BITMAP_COLUMNS = ["pair", "block", "plane", "n", "dense", "bits"]
_BITMAP = "pair bigint, block bigint, plane int, n bigint, dense boolean, bits binary"


def _invert(batches):
    """Bitmaps of the documents at hand, block by block. Plane -1 tells which documents hold a pair."""
    held, block = [], None

    def flush():
        pair, low, times = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(pair, kind="stable")
        pair, low, more = pair[order], low[order], times[order] - 1
        if len(pair):
            yield _bitmaps(pair, low, block, -1)
        for k in range(int(more.max()).bit_length() if len(more) else 0):
            some = (more >> k & 1).astype(bool)
            if some.any():
                yield _bitmaps(pair[some], low[some], block, k)

    for rb in batches:
        number = rb.column("number").to_numpy()
        pairs, times = rb.column("pairs"), rb.column("times")
        cut = pairs.offsets.to_numpy().astype(np.int64)
        flat, count = pairs.flatten().to_numpy(), times.flatten().to_numpy()
        of = number // SPAN
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(number)]
        for a, z in zip(edges, edges[1:]):
            if a == z:
                continue
            if held and of[a] != block:
                yield from flush()
                held = []
            block = int(of[a])
            span = slice(cut[a] - cut[0], cut[z] - cut[0])
            held.append((flat[span], np.repeat(number[a:z] % SPAN, np.diff(cut[a:z + 1])), count[span]))
    if held:
        yield from flush()


def _or_merge(batches):
    """Of rows sorted by block, pair and plane: one for each, with the union of its documents."""
    rest = None
    for rb in _with_end(batches):
        t = rest if rb is None else pa.Table.from_batches([rb]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([rb])])
        if t is None or not t.num_rows:
            continue
        keys = [t.column(c).to_numpy() for c in ("block", "pair", "plane")]
        new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
        first = np.flatnonzero(new)
        if rb is not None:  # the last key may go on in the next batch
            rest, t, first = t.slice(first[-1]), t.slice(0, first[-1]), first[:-1]
        if not t.num_rows:
            continue
        n = np.diff(np.append(first, t.num_rows))
        if (n == 1).all():
            yield from t.to_batches()
            continue
        yield from t.take(pa.array(first[n == 1])).to_batches()
        for a, z in zip(first[n > 1].tolist(), (first + n)[n > 1].tolist()):
            rows = t.slice(a, z - a).to_pylist()
            low = np.unique(np.concatenate([members(r["bits"], r["dense"]) for r in rows]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[0]["pair"]], pa.int64()), pa.array([rows[0]["block"]], pa.int64()), pa.array([rows[0]["plane"]], pa.int32()),
                 pa.array([len(low)], pa.int64()), pa.array([len(low) > DENSE]), pa.array([bitmap(low)], pa.binary())], _BITMAP_COLUMNS)


def _with_end(batches):
    yield from batches
    yield None


def _return_scores(batches):
    """Of postings with their pair's count, sorted by block: per document the sums over its links."""
    block, sums, best = None, None, None

    def done():
        there = np.flatnonzero(sums)
        return pa.RecordBatch.from_arrays([pa.array(block * SPAN + there), pa.array(best[there]), pa.array(sums[there])],
                                          ["number", "n_best", "count_sum"])

    for rb in batches:
        of = rb.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for a, z in zip(edges, edges[1:]):
            if a == z:
                continue
            if of[a] != block:
                if block is not None:
                    yield done()
                block, sums, best = int(of[a]), np.zeros(SPAN, np.int64), np.zeros(SPAN, np.int64)
            part = rb.slice(a, z - a)
            weight, count, top = (part.column(c).to_numpy(zero_copy_only=False) for c in ("weight", "count", "best"))
            dense, bits = part.column("dense").to_numpy(zero_copy_only=False), part.column("bits")
            few = np.flatnonzero(~dense)
            if len(few):
                column = bits.take(pa.array(few))
                low = np.frombuffer(b"".join(column.to_pylist()), "<u2")
                n = pc.binary_length(column).to_numpy(zero_copy_only=False) // 2
                np.add.at(sums, low, np.repeat((weight * count)[few], n))
                np.add.at(best, low, np.repeat((weight * top)[few], n))
            for k in np.flatnonzero(dense).tolist():
                low = members(bits[k].as_py(), True)
                sums[low] += weight[k] * count[k]
                best[low] += weight[k] * top[k]
    if block is not None:
        yield done()


# --- the operator ------------------------------------------------------------------

def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`, written: doc_id, number (its own), n_a, n_b, n_groups, n_links, groups_sha256, pairs, times."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    got = src.mapInArrow(_align(path_a, path_b), "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                         "groups_sha256 string, pairs array<bigint>, times array<bigint>")
    return materialise(got.withColumn("number", F.monotonically_increasing_id()), "aligned")


def postings(aligned: DataFrame) -> DataFrame:
    """Bitmaps by pair, block and plane: pair, block, plane, n (documents in it), dense, bits."""
    made = aligned.where(F.size("pairs") > 0).select("number", "pairs", "times").mapInArrow(_invert, _BITMAP)
    keys = ["block", "pair", "plane"]
    # a block of documents has a bounded number of them, whatever their number in all
    return materialise(made.repartition("block").sortWithinPartitions(*keys).mapInArrow(_or_merge, _BITMAP), "postings")


def _weight() -> F.Column:
    return F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane)")).cast("long")


def pair_counts(posted: DataFrame) -> DataFrame:
    """One row per linked pair of ids: pair, a, b, n_docs, n_links, best (no pair of this b has more links)."""
    per = posted.groupBy("pair").agg(F.sum(F.when(F.col("plane") < 0, F.col("n")).otherwise(0)).alias("n_docs"),
                                     F.sum(F.col("n") * _weight()).alias("n_links"))
    per = per.select("pair", F.expr("shiftright(pair, 32)").cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(_LOW)).cast("int").alias("b"),
                     "n_docs", "n_links")
    per = materialise(per, "pair-counts")
    most = per.groupBy("b").agg(F.max("n_links").alias("most"))
    return per.join(most, "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `path_a` and `path_b` are vocabulary files: of the tokenizers library with byte-level entries,
    and of sentencepiece. Special strings inside texts are ordinary text.

    Defined cases: null and empty texts, and those whose tokens' bytes are not the text's, have
    no tokens: zeros and an empty groups_sha256. Repeated rows each get a row and
    each count; null ids are kept. Other columns are ignored, an empty table gives
    an empty result.
    """
    aligned = aligned_documents(docs, path_a, path_b, id_col, text_col)
    posted = postings(aligned)
    share = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share")
    counts = pair_counts(posted).select("pair", F.col("n_links").alias("count"), F.col("best").cast("long").alias("best"), share)
    scored = (posted.withColumn("share", F.pmod("block", F.lit(SHARES)).cast("int")).join(counts, ["pair", "share"])
              .select("block", _weight().alias("weight"), "count", "best", "dense", "bits"))
    sums = (scored.repartition("block").sortWithinPartitions("block")
            .mapInArrow(_return_scores, "number bigint, n_best bigint, count_sum bigint"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (aligned.select("number", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "number", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"))
