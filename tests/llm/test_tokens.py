"""Operators on token ids against the libraries and brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railyard.llm import bitpack, importance, pair_bitmaps, registry, segments, token_counts
from railyard.session import new_work_dir

A, B = registry.tokenizer_path(), registry.tokenizer_path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "foo", "'s", " ", " ", " the", "  ", "\n", "\t", "é", "日", "<|endoftext|>", "▁", "1", "12", ".", "!?", "\xa0",
            "　", "​", "don't", " \n", "\x00", "ﬁ", "́", "🙂", "\x1c", "\x85", "</s>"]


def fuzz(n, seed=1, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(n)] + ["", " ", "  ", "\n", "x" * 3000]


def docs_of(spark, rows):
    """With columns whose names clash with those the operators use."""
    return (spark.createDataFrame(rows, "doc_id long, text string")
            .withColumns({c: F.lit("x") for c in ("row", "number", "n_tokens", "ids", "block", "pair", "score", "rank", "a`b")}))


ROWS = [(5, "the cat and the cat"), (5, "the cat and the cat"), (None, "null id"), (None, None), (1, None), (2, ""), (3, "  two  spaces "),
        (4, "▁ marks"), (7, "x <|endoftext|> y"), (9, "the " * 700), (8, "l'été ça\n\n va\t"), (2**62, "big id")]


@pytest.mark.parametrize("path", [A, B, registry.tokenizer_path("word_bpe_49k.json")])
@pytest.mark.parametrize("spaced", [False, True])
def test_segments_give_the_tokens_of_the_whole_text(path, spaced):
    enc = segments.SegmentEncoder(path, spaced=spaced, plain=spaced)
    texts = fuzz(4000)
    lead = [" " if spaced and not enc.model and (t or not enc.separable) else "" for t in texts]
    want = segments.encode(enc.tokenizer, [x + t for x, t in zip(lead, texts)])
    got = []
    for _, some in segments.slices(pa.array(texts), 9000):
        ids, at = enc.encoded(some)
        got += [ids[a:z].tolist() for a, z in zip(at, at[1:])]
    assert got == [list(x) for x in want]
    counts = np.concatenate([enc.counts(some) for _, some in segments.slices(pa.array(texts), 9000)])
    assert counts.tolist() == list(map(len, want))


def test_token_bytes_spell_the_text():
    for path in (A, B):
        t = segments.tokenizer(path)
        table, text = segments.token_bytes(path, t), "Straße 12 日本 don't\n"
        joined = b"".join(table[i] for i in segments.encode(t, [text])[0])
        assert joined == ((" " if path.endswith(".model") else "") + text).encode()


def test_counts_of_model_files(spark):
    want = [len(x) for x in segments.encode(segments.tokenizer(B), [t or "" for _, t in ROWS])]
    got = token_counts.token_counts(docs_of(spark, ROWS), B).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(i), n) for (i, _), n in zip(ROWS, want))


def test_cutting_is_linear_and_covers_the_text():
    text = "".join(chr(97 + k % 26) for k in range(100_000))
    rows = pa.RecordBatch.from_arrays([pa.array(["d"]), pa.array([text])], ["row", "text"])
    parts = [r for b in token_counts._cutter(1000, 100)([rows]) for r in b.to_pylist()]
    assert [p["part"] for p in parts] == list(range(parts[0]["parts"])) and max(len(p["piece"]) for p in parts) <= 1100
    assert parts[0]["piece"][:1000] + "".join(p["piece"][:1000] for p in parts[1:-1]) + parts[-1]["piece"] == text


# --- 12: pairs ----------------------------------------------------------------

def brute_alignment(rows):
    ta, tb = segments.tokenizer(A), segments.tokenizer(B)
    ta.encode_special_tokens = True
    ba, bb = segments.token_bytes(A, ta), segments.token_bytes(B, tb)
    out = []
    for i, text in rows:
        want = (" " + (text or "")).encode()
        a, b = (segments.encode(t, [x])[0] if text else [] for t, x in ((ta, " " + (text or "")), (tb, text or "")))
        if not text or any(b"".join(tab[k] for k in ids) != want for tab, ids in ((ba, a), (bb, b))):
            out.append((i, [], [], [], []))
            continue
        ea, eb = np.cumsum([len(ba[k]) for k in a]).tolist(), np.cumsum([len(bb[k]) for k in b]).tolist()
        links = [(a[ea.index(e)], b[eb.index(e)]) for e in ea if e in set(eb)]
        groups, x, y = [], 0, 0
        for e in (e for e in ea if e in set(eb)):
            p, q = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        out.append((i, a, b, links, groups))
    count = collections.Counter(k for r in out for k in r[3])
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return count, [(str(i), len(a), len(b), len(groups), len(links), sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for i, a, b, links, groups in out]


def test_alignment_equals_brute_force(spark, monkeypatch):
    rows = ROWS + [(100 + k, t) for k, t in enumerate(fuzz(300, 2))]
    docs = docs_of(spark, rows).repartition(3)
    got = pair_bitmaps.alignment(docs, A, B).collect()
    count, want = brute_alignment(rows)
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    pairs = pair_bitmaps.pair_counts(pair_bitmaps.postings(pair_bitmaps.aligned_documents(docs, A, B))).collect()
    assert {(r.a, r.b): r.n_links for r in pairs} == count
    assert pair_bitmaps.alignment(docs.where("false"), A, B).count() == 0
    assert pair_bitmaps.alignment(docs.where("text is null"), A, B).select("n_a", "count_sum", "groups_sha256").distinct().collect() == [(0, 0, "")]


@pytest.mark.parametrize("n", [1, 511, 512, 513, 8192])
def test_bitmaps_round_trip(n):
    low = np.sort(np.random.default_rng(n).choice(pair_bitmaps.SPAN, n, replace=False))
    assert (pair_bitmaps.members(pair_bitmaps.bitmap(low), n > pair_bitmaps.DENSE) == low).all()


def test_bitmaps_of_several_tasks_are_united():
    """A block whose documents were read in two parts, with one pair in very many of them."""
    n = 1500
    batch = lambda a, z: pa.RecordBatch.from_arrays(
        [pa.array(range(a, z), pa.int64()), pa.array([[7, 8 + k % 3] for k in range(a, z)], pa.list_(pa.int64())),
         pa.array([[1 + k % 5, 1] for k in range(a, z)], pa.list_(pa.int64()))], ["number", "pairs", "times"])
    rows = [r for a, z in ((0, 700), (700, n)) for b in pair_bitmaps._invert([batch(a, z)]) for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["block"], r["pair"], r["plane"]))
    whole = pa.RecordBatch.from_pylist(rows)
    for step in (1, 2, 100):
        merged = [r for b in pair_bitmaps._or_merge([whole.slice(i, step) for i in range(0, len(rows), step)]) for r in b.to_pylist()]
        assert len({(r["block"], r["pair"], r["plane"]) for r in merged}) == len(merged)
        links = sum(r["n"] * (1 if r["plane"] < 0 else 1 << r["plane"]) for r in merged if r["pair"] == 7)
        assert links == sum(1 + k % 5 for k in range(n))
        assert [r["n"] for r in merged if (r["pair"], r["plane"]) == (7, -1)] == [n]


# --- 13: packed ids -------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 3, 7, 8, 15, 16, 17, 24, 31, 32])
def test_files_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 5000, 8193):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        f = bitpack.PackedFile(bitpack.file_bytes([None, 5, -1], np.array([0, n // 2, n // 2, n]), ids, bits))
        assert (f.ids() == ids).all() and f.doc_ids == [None, 5, -1]
        assert (f.document(0) == ids[:n // 2]).all() and not len(f.document(1))
        for a, z in ((0, 1), (3, 9), (4090, 4100), (8192, 9000)):
            assert (f.ids(a, z) == ids[a:z]).all()
    with pytest.raises(ValueError):
        bitpack.PackedFile(b"something else, long enough to have a header of its own")


@pytest.mark.parametrize("path", [A, B])
def test_store_reads_back_the_library_s_ids(spark, path):
    rows = ROWS + [(100 + k, t) for k, t in enumerate(fuzz(200, 3))]
    out = new_work_dir(spark, "ids")
    manifest = bitpack.write_packed(docs_of(spark, rows).repartition(3), path, out, end_id=2, file_ids=500)
    assert manifest.agg(F.sum("n_docs")).first()[0] == len(rows) and manifest.count() > 4
    got = bitpack.read_packed(spark, out).orderBy("start").collect()
    t = segments.tokenizer(path)
    want = collections.Counter((i, *ids, 2) for (i, x) in rows for ids in segments.encode(t, [x or ""]))
    assert collections.Counter((r.doc_id, *r.ids) for r in got) == want
    numbers = [r.doc_id for r in got]
    assert numbers == sorted(numbers, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)


def test_store_of_nothing(spark):
    out = new_work_dir(spark, "ids")
    assert bitpack.write_packed(docs_of(spark, ROWS).where("false"), A, out, end_id=2).count() == 0
    assert bitpack.read_packed(spark, out).count() == 0


def test_files_outside_the_manifest_are_not_read(spark):
    out = new_work_dir(spark, "ids")
    bitpack.write_packed(docs_of(spark, ROWS), A, out, end_id=2)
    with open(out.replace("file:", "") + "/part-000000-000000-lost.ids", "wb") as f:
        f.write(b"left by an attempt that failed")
    assert bitpack.read_packed(spark, out).count() == len(ROWS)


# --- 11: importance ---------------------------------------------------------------

def brute_resample(rows, target, n=1, percent=10, min_words=20, k=10_000, seed=2024):
    import math
    import re

    def found(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
        return len(w), [zlib.crc32(" ".join(w[i:i + s]).encode()) % k for s in range(1, n + 1) for i in range(len(w) - s + 1)]

    docs = [(i, *found(t)) for i, t in rows]
    s, t = collections.Counter(b for d in docs for b in d[2]), collections.Counter(b for x in target for b in found(x)[1])
    s_all, t_all = sum(s.values()) + k, sum(t.values()) + k
    out = []
    for i, w, f in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, w, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[5] = rank
    return sorted(str((r[0], *r[2:])) for r in out)


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_equals_brute_force(spark, n):
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "Éa", "ß", "x1", "日本", "don't", "a_b", "ÀB"]
    text = lambda m: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "\x7f"]) for _ in range(m))
    rows = ROWS + [(1000 + k, text(rng.randrange(60))) for k in range(150)] + [(77, "same words " * 15)] * 40
    target = [text(50) for _ in range(4)] + [None, ""]
    bench = spark.createDataFrame([(1, t) for t in target], "doc_id long, text string")
    got = importance.resample(docs_of(spark, rows).repartition(4), bench, percent=30, n=n).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_resample(rows, target, n, 30)
    assert [r.rank for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == list(range(1, len([r for r in got if r.rank]) + 1))


def test_resampling_of_nothing(spark):
    docs = docs_of(spark, ROWS)
    assert importance.resample(docs.where("false"), docs).count() == 0
    assert {r.rank for r in importance.resample(docs, docs.where("false"), min_words=10_000).collect()} == {None}


def test_long_texts_are_cut_between_words():
    split, text = importance.splitter(), "Über-ALLES  42nd;" * 400
    whole = importance.histogram(split, text, importance.Bucket(997), 3)
    for step in (1, 50, 1000):
        found = [x for part in importance.words(split, text, step) for x in part]
        assert found == split.pre_tokenize_str(importance.lowered(text))
        count, buckets = importance.histogram(split, text, importance.Bucket(997), 3, step)
        assert count == whole[0] and sorted(buckets.tolist()) == sorted(whole[1].tolist())
    assert sorted(whole[1].tolist()) == sorted(zlib.crc32(f.encode()) % 997 for s in (1, 2, 3)
                                               for f, _ in importance.windows([x for p in importance.words(split, text) for x in p], s))
