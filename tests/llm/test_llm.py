"""The training-data operators against brute force, on small and odd inputs."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm import (chat, decontaminate, int8_near_dup, langid, minhash_bbit, mixing, pairwise_quality,
                          recompression, registry, sharding, token_counts)
from railyard.llm.common import components, held_out

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (5, "one two"), (None, "one two three"),
       (6, "ONE Two"), (7, "x" * 5000), (8, "é ü a b"), (9, "a " * 300)]


# --- components ---------------------------------------------------------------

def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(17)]
    edges += [(300, 400 + i) for i in range(40)] + [(7, 7), (500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: v for k, v in _union_find([e for e in edges if e[0] != e[1]]).items() if k != v}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1: vectors ---------------------------------------------------------------

def _brute_vectors(rows, t=0.95):
    good = {}
    for k, (i, v) in enumerate(rows):
        if v and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {k: [j for j in good if j != k and len(good[j]) == len(good[k]) and good[j] @ good[k] >= t - 1e-12] for k in good}
    comp = _union_find([(rows[k][0], rows[j][0]) for k in links for j in links[k]])
    return sorted((i if i is not None else -1, len(links.get(k, [])), comp.get(i, i) if i is not None else -1) for k, (i, _) in enumerate(rows))


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = [(int(i), [float(x) for x in base[i % 12] + rng.normal(size=16) * 0.06 * (i % 5)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [0.0] * 16), (203, [float("nan")] + [1.0] * 15), (204, [None] + [1.0] * 15),
             (205, [float("inf")] * 16), (206, [1.0, 2.0]), (207, [2.0, 4.0]), (208, rows[3][1]), (209, rows[3][1]),
             (None, rows[3][1]), (210, [x * 1e-160 for x in rows[3][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cls", F.lit(1)).withColumn("v", F.lit("x"))
    for tile in (8192, 20):
        got = int8_near_dup.near_duplicate_vectors(df, tile=tile).collect()
        assert sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got) == _brute_vectors(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_quantisation_bound_holds():
    rng = np.random.default_rng(5)
    u, q, s, e = int8_near_dup.quantise(rng.normal(size=(300, 24)) * np.exp(rng.normal(size=(300, 1)) * 5))
    approx = (q.astype(float) @ q.T.astype(float)) / np.outer(s, s)
    assert (np.abs(approx - u @ u.T) <= int8_near_dup.bound(e[:, None], e[None, :])).all()


def test_vectors_empty(spark):
    assert int8_near_dup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- 2: quality ---------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    out = registry.op2_pairwise_quality(spark, "/root/testdata/sf0.01").toPandas()
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    m = out.merge(lab, on="doc_id")
    m = m[m.held_out]
    assert (m.predicted == m.quality).mean() > 0.95
    assert out.score.between(0, 1).all() and ((out.score >= 0.7).astype(int) == out.predicted).all()


def test_quality_odd_inputs(spark):
    d = docs_of(spark, ODD).withColumn("score", F.lit("clash")).withColumn("quality", F.lit(9))
    lab = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (7, None), (9, 0)], "doc_id long, quality int")
    out = pairwise_quality.quality(d, lab).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in out if r.doc_id in (1, 2, 3)} == {out[1].score}
    none = lab.where("false")
    assert {r.predicted for r in pairwise_quality.quality(d, none).collect()} == {1}
    assert pairwise_quality.quality(d.where("false"), lab).count() == 0
    kept = pairwise_quality.keep_good(d.drop("score"), none)
    assert kept.count() == len(ODD) and kept.columns == ["doc_id", "text", "quality"]


def test_held_out_rule(spark):
    import zlib
    got = {r.i: r.h for r in spark.range(200).select(F.col("id").alias("i"), held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


# --- 3: token counts ----------------------------------------------------------

@pytest.mark.parametrize("chunk,overlap", [(32768, 1024), (600, 300)])
def test_token_counts_equal_the_library(spark, chunk, overlap):
    from tokenizers import Tokenizer
    path = registry.tokenizer_path()
    tok = Tokenizer.from_file(path)
    rows = ODD + [(20, "a" * 4000), (21, " " * 3000), (22, "x <|endoftext|> y  <|endoftext|>" * 60), (23, "l'été  ça\n\n  va\t\t " * 120),
                  (24, "日本語のテキスト" * 200), (25, "don't  we'll " * 200), (26, "1234567890" * 300), (27, ("  \n" * 3 + "word") * 300)]
    got = token_counts.token_counts(docs_of(spark, rows).withColumn("row", F.lit(1)), path, chunk=chunk, overlap=overlap, limit=50).collect()
    want = sorted((str(i), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)


# --- 4: repeats ---------------------------------------------------------------

def _brute_repeats(rows, window=20):
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = (t or "").encode().split()
        cov = [False] * len(w)
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            if k in seen:
                cov[j:j + window] = [True] * window
            else:
                seen[k] = 1
        kept = [x for x, c in zip(w, cov) if not c]
        out.append((str(i), len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vocab = [f"w{k}" for k in range(8)]
    texts = [" ".join(rng.choice(vocab, int(rng.integers(5, 90)))) for _ in range(60)]
    for k in range(40):  # stretches copied into other texts
        a, b = rng.integers(0, 60, 2)
        w = texts[a].split()
        s = int(rng.integers(0, max(1, len(w) - 18)))
        texts[b] += " " + " ".join(w[s:s + int(rng.integers(15, 40))])
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, "a " * 100), (101, "a " * 50 + "b " * 50), (102, "x a " * 40), (103, "b " * 45 + "a " * 10), (104, None), (105, " "),
             (106, " ".join("ab"[(k * k) % 7 % 2] for k in range(300))), (107, rows[0][1]), (None, rows[1][1] + " q")]
    for window in (20, 7):
        got = recompression.remove_repeats(docs_of(spark, rows).withColumn("sha", F.lit(0)), window=window).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == _brute_repeats(rows, window)


def test_repeats_of_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.op4_recompression(spark, SF).collect()
    want = _brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_repeated_rows_in_several_partitions(spark, tmp_path):
    words = [f"w{k}" for k in range(60)]
    first, second = " ".join(words[:40]), " ".join(words[10:60])
    long = " ".join(f"x{k}" for k in range(8000))
    for k, row in enumerate([(1, first)] + [(2, second)] * 4 + [(3, long)]):
        docs_of(spark, [row]).coalesce(1).write.parquet(str(tmp_path / f"part={k}"))
    docs = spark.read.parquet(str(tmp_path))
    # joins with all texts are planned with shuffles and turned into broadcasts: the rows stay in their tasks
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10k", "spark.sql.files.maxPartitionBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = sorted((r.doc_id, r.n_removed, r.kept) for r in recompression.remove_repeats(docs).collect())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == [(1, 0, None)] + [(2, 30, " ".join(words[40:]))] * 4 + [(3, 0, None)]


# --- 5: benchmark -------------------------------------------------------------

ITEM = "Anna Miller drives 120 km from Oldtown to the coast at 60 km per hour and then Anna Miller rests there for 2 hours"


def test_templates_catch_new_parameters(spark):
    docs = docs_of(spark, [
        (1, "Some text. At noon " + ITEM + " before dinner."),
        (2, "At noon " + ITEM.replace("120", "75").replace("60", "50").replace("Anna Miller", "Boris Brown").replace("Oldtown", "Newport")),
        (3, "At noon " + ITEM.replace("Anna Miller rests", "Carl Miller rests")),  # 17 words of the item as they are
        (4, "drives from the coast and rests, nothing else in common with it at all"), (5, None), (6, ""), (None, ITEM)]).withColumn("item_id", F.lit(0))
    bench = spark.createDataFrame([(10, "Once " + ITEM), (11, "too short"), (12, None), (13, "")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert got == {(1, 10), (2, 10), (3, 10), (None, 10)}
    assert {r.doc_id for r in decontaminate.clean_documents(docs, bench).collect()} == {4, 5, 6}
    assert decontaminate.matches(docs.where("false"), bench).count() == 0
    assert decontaminate.matches(docs, bench.where("false")).count() == 0


def brute_template_matches(docs, items, window=8, min_words=5):
    """The rule word by word, for texts of lower-case words and numbers (where all three templates are one)."""
    number = lambda w: "#" if any(c.isdigit() for c in w) else w
    out = set()
    for item_id, item in items:
        v = item.split()
        if len(v) < min_words:
            continue
        k, hits = min(window, len(v)), collections.defaultdict(dict)
        of = len(v) - k + 1
        for doc_id, text in docs:
            d = (text or "").split()
            for p in range(len(d) - k + 1):
                for a in range(of):
                    x, y = v[a:a + k], d[p:p + k]
                    t = list(map(number, x))
                    shown = t if 2 * sum(w != "#" for w in t) >= k else x
                    if (list(map(number, y)) if shown is t else y) == shown:
                        hits[doc_id, p - a][a] = None if x == y else {(i, j) for i, j, w in zip(x, y, t) if w == "#"}
        for (doc_id, _), at in hits.items():
            own = sum(s is None for s in at.values())
            other = [s for s in at.values() if s is not None]
            votes = collections.Counter(pair for s in other for pair in s)
            chosen = {i: max((n, j) for (i2, j), n in votes.items() if i2 == i)[1] for i, _ in votes}
            fit = sum(all(chosen[i] == j for i, j in s) for s in other)
            if own or (2 * fit >= len(other) and fit >= min(2, of) and fit):
                out.add((doc_id, item_id))
    return out


@pytest.mark.parametrize("seed,limit", [(1, 200_000), (2, 1)])  # by the filter, and by joins
def test_changed_parameters_equal_brute_force(spark, seed, limit):
    rng = random.Random(seed)
    vocabulary = "he she buys sells walks red blue box from to and then the of with near".split()
    make = lambda n: [str(rng.randrange(1, 6)) if rng.random() < .3 else rng.choice(vocabulary) for _ in range(n)]
    items = [(100 + i, " ".join(make(rng.choice([4, 5, 7, 8, 12, 25])))) for i in range(12)]
    docs = []
    for k in range(60):
        w = rng.choice(items)[1].split()
        mapping = {str(i): str(rng.randrange(1, 90)) for i in range(1, 6)}
        mode = k % 4  # verbatim, renamed, renamed with conflicts, renamed at random
        new = [x if not x.isdigit() or mode == 0 else mapping[x] if mode == 1 or (mode == 2 and rng.random() < .7) else str(rng.randrange(1, 90)) for x in w]
        cut = rng.randrange(0, 4)
        docs.append((k, " ".join(make(5) + new[cut:] + make(5))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_template_matches(docs, items)
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs_of(spark, docs), bench, max_broadcast=limit).collect()}
    assert got == want
    left = {r.doc_id for r in decontaminate.clean_documents(docs_of(spark, docs), bench, max_broadcast=limit).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in want}
    assert want and left


def test_a_name_with_two_values_everywhere_is_another_question(spark):
    item = "Anna drives the red car 10 km and then Anna walks along the old river 10 km and later Anna swims in the lake"
    mixed = "Boris drives the red car 21 km and then Carl walks along the old river 32 km and later Doris swims in the lake"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of(spark, [(1, "so " + item.replace("Anna", "Eva").replace("10", "77")), (2, "so " + mixed)])
    got = {r.doc_id for r in decontaminate.matches(docs, bench).collect()}
    assert got == {1}


def test_the_filter_is_looked_up_in_place(spark):
    """Its words are never copied into a row, and no text is shuffled before it is looked up."""
    bench = decontaminate._Benchmark(spark.createDataFrame([(10, ITEM)], "item_id long, text string"), 8, 5, 1000)
    flagged = bench.flagged(docs_of(spark, [(1, ITEM), (2, "clean")]).select("text"))
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert "AS filter#" not in plan
    assert "Exchange" not in flagged._jdf.queryExecution().sparkPlan().toString().split("Subquery")[0]
    assert {r.text: r.hit for r in flagged.collect()} == {ITEM: True, "clean": False}


def test_decontamination_finds_exact_passages(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, " ".join(r.text.lower().split())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = r.text.lower().split()
        for j in range(max(1, len(w) - 7)):
            want |= {i for i, t in docs if " ".join(w[j:j + 8]) in t}
    assert {r.doc_id for r in registry.op5_template_decontamination(spark, sf).collect()} == want


def test_conflicting_windows_do_not_hide_the_others(spark):
    verbatim = ITEM.replace("for 2 hours", "for 2 hours while 2 friends wait outside of the town hall")
    docs = docs_of(spark, [
        (1, "At noon " + verbatim.replace("while 2", "while 3")),  # one repeated number edited in one place
        (2, "At noon " + verbatim.replace("while 2", "while 3").replace("Miller", "MILLER")),  # values in another case
        (3, "At noon " + verbatim.replace("120", "75").replace("while 2", "while 3")),  # new numbers, one conflict
        (4, "he rests for 2 hours and that is all there is to say about it")])
    bench = spark.createDataFrame([(10, verbatim)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.matches(docs, bench).collect()}
    assert set(got) == {1, 2, 3} and all(r.n_windows > 8 and r.share < 1 for r in got.values())


def test_names_in_any_place_case_and_layout(spark):
    item = "Tom has 5 apples. Tom buys 3 more. Tom eats 2 apples. Tom gives 4 away."
    docs = docs_of(spark, [
        (1, "Eva has 7 apples. Eva buys 9 more. Eva eats 6 apples. Eva gives 8 away."),
        (2, item.lower()), (3, item.upper()), (4, item.replace(" ", "\n")),
        (5, "they say that the capital of france is paris"), (6, "THE CAPITAL OF\nFRANCE  IS PARIS"), (7, "he knows the\ncapital of\r\nFrance is\tParis"),
        (8, "Zoe has no apples. The capital of Norway is not Paris."),
        (9, "at noon anna miller drives 75 km from oldtown to the coast at 50 KM per hour")])
    bench = spark.createDataFrame([(10, item), (11, "The capital of France is Paris"), (12, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert got == {(1, 10), (2, 10), (3, 10), (4, 10), (5, 11), (6, 11), (7, 11), (9, 12)}


def test_clean_documents_decides_by_text(spark):
    rows = [(None, ITEM), (None, "clean text under no id"), (None, None), (1, ITEM), (1, "clean text under the same id"), (1, ITEM), (2, "more")]
    bench = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    docs = docs_of(spark, rows)
    left = [(r.doc_id, r.text) for r in decontaminate.clean_documents(docs, bench).collect()]
    assert sorted(left, key=str) == sorted((x for x in rows if x[1] != ITEM), key=str)
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()} == {(None, 10), (1, 10)}


# --- 6: near-duplicates -------------------------------------------------------

def _brute_near(rows, size, percent=80):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(size, len(w))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    edges = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and rows[a][0] is not None and rows[b][0] is not None and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = _union_find(edges)
    return sorted((str(i), len(s), str(comp.get(i, i))) for (i, _), s in zip(rows, sets))


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(8)
    vocab = [f"w{k}" for k in range(500)]
    rows, n = list(ODD), 30
    for g in range(12):
        base = list(rng.choice(vocab, 60))
        for c in range(12):  # copies with some words changed: similarities around the threshold
            w = list(base)
            for p in rng.choice(60, int(rng.integers(0, 8)), replace=False):
                w[p] = str(rng.choice(vocab))
            rows.append((n, " ".join(w).title() if c % 3 == 0 else " ".join(w)))
            n += 1
    rows.append((30, "other words under an id that is there already, one two three four"))
    for size in (2, 5):
        got = minhash_bbit.near_duplicates(docs_of(spark, rows).withColumn("cls", F.lit(1)), shingle=size).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _brute_near(rows, size)
        assert all(r.kept for r in got if r.doc_id in (None, 1, 2, 3))


def test_bit_estimate_and_its_bound():
    rng = np.random.default_rng(4)
    a, b = minhash_bbit._constants()
    x = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    y = np.concatenate((x[:800], rng.integers(0, 1 << 62, 200).astype(np.uint64)))
    sig = [np.frombuffer(minhash_bbit.pack_bits(minhash_bbit.minima(np.unique(s), a, b)), np.uint64)[None] for s in (x, y)]
    assert abs(minhash_bbit.estimated_similarity(minhash_bbit.equal_fields(*sig)[0, 0]) - 800 / 1200) < 0.12
    assert minhash_bbit.least_equal(0.8) < minhash_bbit.HASHES * 0.8125


def test_signature_distance_with_built_in_functions(spark):
    rng = np.random.default_rng(6)
    sig = [minhash_bbit.pack_bits(rng.integers(0, 3, minhash_bbit.HASHES).astype(np.uint64)) for _ in range(6)]
    df = spark.createDataFrame([(sig[i], sig[i + 1]) for i in range(5)], "x binary, y binary")
    got = [minhash_bbit.HASHES - r[0] for r in df.select(minhash_bbit._differing("x", "y")).collect()]
    words = [np.frombuffer(s, np.uint64)[None] for s in sig]
    assert got == [int(minhash_bbit.equal_fields(words[i], words[i + 1])[0, 0]) for i in range(5)]


def test_near_duplicates_empty(spark):
    assert minhash_bbit.near_duplicates(docs_of(spark, [])).count() == 0
    assert minhash_bbit.near_duplicates(docs_of(spark, [(1, None), (2, "")])).count() == 2


# --- 7: mixing ----------------------------------------------------------------

def test_poisson_copies_match_brute_force(spark):
    import math
    rows = [(i, f"s{i % 3 if i % 2 else 0}" if i % 11 else None) for i in range(600)] + [(None, "s0"), (3, "s0")]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("n", F.lit(1)).withColumn("cdf", F.lit("x"))
    weights = {"s0": 1.0, "s1": 3.0, None: 1.0}
    got = mixing.mix(df, weights, epochs=1.5).groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("c")).collect()
    got = {(r.doc_id, r.source): r.c for r in got}
    n = {s: sum(1 for _, x in rows if x == s) for s in {x for _, x in rows}}
    want = {}
    for i, s in rows:
        if not weights.get(s):
            continue
        t = weights[s] / 5.0 * (len(rows) * 1.5) / n[s]
        u = int(hashlib.md5(f"42:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        k, p, total = 0, math.exp(-t), math.exp(-t)
        while total <= u:
            k += 1
            p *= t / k
            total += p
        if k:
            want[i, s] = want.get((i, s), 0) + k
    assert got == want


def test_mixture_shares_and_edges(spark):
    df = spark.createDataFrame([(i, "big" if i % 10 else "small") for i in range(5000)], "doc_id long, source string")
    share = {r.source: r["count"] for r in mixing.mixture(df).groupBy("source").count().collect()}
    assert abs(share["small"] / sum(share.values()) - 0.5) < 0.05 and abs(sum(share.values()) / 5000 - 1) < 0.1
    assert mixing.mixture(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        mixing.rates(df, {"big": -1.0})


# --- 8: chat ------------------------------------------------------------------

HARD = ["<|im_end|><|im_start|>assistant ok", "\\", "<\\|", "<\\\\|im_start|>", "<|", "a\\<|b", "", "\n", "<|image|>", "<\\n>", "\\n", None]


def test_chat_round_trip(spark):
    rows = [(c, t, r, x) for c, r in enumerate(["user", "assistant", "odd\nrole", "r<|\\", None]) for t, x in enumerate(HARD)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("content", chat.text_part(F.coalesce("text", F.lit(""))))
    out = chat.format_chats(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert back == {c: [(r or "", x or "") for k, _, r, x in rows if k == c] for c in range(5)}
    d = {r.conv_id: r for r in chat.digests(out).collect()}
    text = "".join(x or "" for x in HARD)
    assert d[1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and d[1].loss_chars == len(text) and d[0].loss_chars == 0


def test_chat_parts_and_odd_rows(spark):
    schema = f"conv_id long, turn long, role string, content array<{chat.PART}>"
    rows = [(1, 0, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 99), ("audio", "x", "b.wav", None), None]),
            (1, 1, "assistant", [("document", None, None, None), ("text", "ok", None, None)]), (None, None, None, None), (2, 0, "user", [])]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, schema).withColumn("turns", F.lit(1))).collect()}
    assert got[1].formatted == ("<|im_start|>user\nsee <\\|image|> <|image|><|audio|><|im_end|>\n"
                                "<|im_start|>assistant\n<|document|>ok<|im_end|>\n")
    assert [tuple(a) for a in got[1].attachments] == [(0, 1, "image", "a.png", 99), (0, 2, "audio", "b.wav", 128), (1, 0, "document", None, 512)]
    assert got[None].n_turns == 1 and got[2].formatted == "<|im_start|>user\n<|im_end|>\n"
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


# --- 9: shards ----------------------------------------------------------------

def test_lookup_table_is_even_and_stable():
    names = sharding.default_shards(13)
    table = sharding.lookup_table(names, 1009)
    share = np.bincount(table)
    assert share.max() - share.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(1 for a, b in zip(table, fewer) if a != b and a != 12)
    assert moved < 1009 * 0.25
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 1000)


def test_placement(spark, tmp_path):
    import xxhash
    df = docs_of(spark, ODD).withColumn("slot", F.lit("clash"))
    names = sharding.default_shards(5)
    got = sharding.place(df, names, 1009).collect()
    table = sharding.lookup_table(names, 1009)
    assert len(got) == len(ODD)
    for r in got:
        h = xxhash.xxh64_intdigest(("null" if r.doc_id is None else str(r.doc_id)).encode(), seed=42)
        h = h - (1 << 64) if h >> 63 else h
        assert r.slot == h % 1009 and r.shard == names[table[r.slot]]
    sharding.write_shards(df, names, str(tmp_path / "out"), parts=2, slots=1009)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ODD)
    assert sharding.place(df.where("false"), names).count() == 0


# --- 10: languages ------------------------------------------------------------

def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = registry.op10_string_kernel_langid(spark, sf).toPandas()
    m = out.merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert (m.lang_pred == m.lang).mean() > 0.97 and out.score.between(0, 1).all()


def test_language_odd_inputs(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(30)] + [(50 + i, "der hund und die katze", "de") for i in range(30)]
    rows += [(90, None, "en"), (91, "", None), (92, "12 34 !!", "en"), (None, "the dog", "en"), (93, "日本語", None), (94, "the " * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in langid.languages(df, landmarks=10).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (90, 91, 92))
    assert got[0].lang_pred == "en" and got[51].lang_pred == "de" and got[None].lang_pred == "en" and got[94].lang_pred == "en"
    assert {r.lang_pred for r in langid.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.languages(df.where("false")).count() == 0


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(7)
    words = {f"l{k:02}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for k in range(70)}
    rows = [(8 * k + j, " ".join(rng.choice(w, 30)), lang) for k, (lang, w) in enumerate(words.items()) for j in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {i: lang for i, _, lang in rows}
    got = {r.doc_id: r.lang_pred for r in langid.languages(df).collect()}
    assert set(got.values()) == set(words) and np.mean([got[i] == want[i] for i in want]) > 0.95


def test_grams_of_large_alphabets_are_told_apart():
    han = [chr(0x4E00 + k) for k in range(600)]
    texts = ["".join(han[:400]), "".join(han[400:]), "".join(han[400:500])]  # the first two share no letter
    k, ok = langid.fit(texts[:2], ["p", "q"], landmarks=2).kernel(texts)
    assert ok.all() and np.allclose(k, [[1, 0], [0, 1], [0, (297 / 597) ** 0.5]])


def test_kernel_equals_its_definition():
    texts = ["abc abd", "Abc, abd!", "xyz", "a", "ab c"]
    m = langid.fit(texts, ["p", "p", "q", "q", "p"], landmarks=10)

    def spectrum(t):
        t = "".join(c if c.isalpha() else "\0" for c in t.lower())
        while "\0\0" in t:
            t = t.replace("\0\0", "\0")
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    k, ok = m.kernel(texts)
    sets = [spectrum(t) for t in texts]
    landmark = [sets[0], sets[1], sets[4], sets[2], sets[3]]
    rows = {tuple(sorted(np.round(k[:, c], 5))) for c in range(k.shape[1])}
    want = {tuple(sorted(np.round([len(s & l) / (len(s) * len(l)) ** 0.5 for s in sets], 5))) for l in landmark}
    assert ok.all() and {tuple(map(float, r)) for r in rows} == {tuple(map(float, r)) for r in want}


# --- pipeline -----------------------------------------------------------------

CLASHES = ["score", "__text", "__drop", "__leak", "__digest", "digest", "__s", "s", "__u", "__n", "n", "__copy", "copy", "__place", "place",
           "__slot", "row", "number", "key", "hit", "cdf", "group", "a`b", "x.y", "a b"]


def _clashing(spark, rows):
    """Documents with columns of the names that the stages use or used, and odd ones."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.select("*", *[F.concat(F.lit(f"{i}:"), F.coalesce("text", F.lit(""))).alias(c) for i, c in enumerate(CLASHES)])


def _unharmed(r):
    return all(r[c] == f"{i}:{r.text or ''}" for i, c in enumerate(CLASHES))


def _stage(spark, name, docs):
    """A stage as a caller runs it: its output written and read again."""
    import corpus_pipeline as p
    from railyard.llm.common import materialise
    return materialise(dict(p.STAGES)[name](spark, docs, SF), "stage")


LONG = " ".join(f"word{i}" for i in range(40))
STAGE_ROWS = [(None, LONG, "a"), (None, LONG, "a"), (None, LONG, "b"), (5, LONG, "a"), (6, LONG, "a"), (6, LONG, None),
              (7, LONG, "a"), (7, "a text of its own that no other row has in any part of it", "a"),
              (None, "another text of its own, under no id at all, as it stands", "b"), (8, None, "a"), (9, "", None), (9, " ", "a"), (None, None, None)]


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "decontaminate", "mix", "shard"])
def test_stages_on_odd_rows_and_clashing_names(spark, name):
    docs = _clashing(spark, STAGE_ROWS).repartition(3)
    out = _stage(spark, name, docs)
    got = out.collect()
    assert all(_unharmed(r) for r in got)
    assert out.columns == docs.columns + (["slot", "shard"] if name == "shard" else [])
    key = lambda r: str((r[0], r[1], r[2]))
    if name in ("decontaminate", "shard"):
        assert sorted(map(key, got)) == sorted(map(key, STAGE_ROWS))
    if name == "near_duplicates":  # one row of the group, the smallest id; every other text stays
        assert sorted(key(r) for r in got if r.text == LONG) == [key((5, LONG, "a"))]
        assert sorted(key(r) for r in got if r.text != LONG) == sorted(key(r) for r in STAGE_ROWS if r[1] != LONG)
    empty = _stage(spark, name, docs.where("false"))
    assert empty.count() == 0 and empty.columns == out.columns


def test_near_duplicates_of_null_ids_only(spark):
    docs = _clashing(spark, [(None, LONG, "a")] * 5 + [(None, LONG + f" tail{i}", "b") for i in range(3)])
    assert _stage(spark, "near_duplicates", docs.repartition(4)).count() == 1


def test_null_ids_do_not_share_one_draw(spark):
    """1,000 rows without an id, each with its own text: about 1,000 copies whatever the seed, also for small means."""
    docs = spark.createDataFrame([(None, f"text {i}", "a") for i in range(1000)], "doc_id long, text string, source string")
    for seed in (1, 2, 3):
        assert 850 < mixing.mixture(docs, seed=seed).count() < 1150
        assert 200 < mixing.mixture(docs, seed=seed, epochs=0.3).count() < 400


def test_mixture_sql_has_no_cap(spark):
    """A rare source whose rows repeat hundreds of times: SQL and Spark give the same rows."""
    import duckdb
    docs = spark.createDataFrame([(i, f"t{i}", "big") for i in range(3000)] + [(9000 + i, f"u{i}", "rare") for i in range(3)],
                                 "doc_id long, text string, source string").select("*", F.lit("en").alias("lang"), F.length("text").alias("n_chars"))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(f"SELECT doc_id, copy FROM ({registry.ORACLE['op7_poisson_mixture']})").fetchall()
    got = [(r.doc_id, r.copy) for r in mixing.mix(docs).withColumnsRenamed({"__copy": "copy"}).collect()]
    assert sorted(got) == sorted(want) and max(c for i, c in got if i >= 9000) > 400


def test_repeats_keep_the_largest_id_apart_from_null(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(2**63 - 1, words), (None, "x " + words), (1, words + " y")]
    got = {r.doc_id: r.n_removed for r in recompression.remove_repeats(docs_of(spark, rows)).collect()}
    assert got == {2**63 - 1: 30, None: 30, 1: 0}


def test_quality_learns_one_text_per_id(spark):
    docs = docs_of(spark, [(i, f"good words number {i}") for i in range(40)] * 5 + [(100 + i, "$$$ ### | |") for i in range(40)])
    lab = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)], "doc_id long, quality int")
    models = {pairwise_quality.train(docs.repartition(n), lab, max_per_label=10) for n in (1, 7)}
    assert len(models) == 1


def test_scratch_goes_with_the_pipeline(spark):
    import corpus_pipeline as p
    from railyard.llm import common
    before = common.scratch()
    assert p.run(spark, SF).count() > 0
    assert common.scratch() == before + 1  # the input of the last stage


def test_pipeline_against_its_stages(spark):
    import corpus_pipeline as p
    out = p.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = pairwise_quality.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    near = _brute_near([(r.doc_id, r.text) for r in good], 5)
    kept = {int(i) for i, _, c in near if i == c}
    leaks = {r.doc_id for r in decontaminate.matches(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    left = [r for r in good if r.doc_id in kept and r.doc_id not in leaks]
    mixed = mixing.mixture(spark.createDataFrame(left, docs.schema)).collect()
    key = lambda r: (r.doc_id, r.text, r.lang, r.source, r.n_chars)
    assert sorted(map(key, out)) == sorted(map(key, mixed))
    assert all(r.shard for r in out)


def test_recompression_sends_short_names():
    """What is counted and joined over all windows is a few bytes each, not whole hashes."""
    import pyarrow as pa

    from railyard.llm import recompression as R
    text = " ".join(str(i % 30) for i in range(90))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "unnamed": [False, False], "text": [text, "a b"]})
    (out,) = R._first_pass(20)([rows])
    names = out.column("keys").to_pylist()[0]
    assert names and all(0 <= x < 1 << 40 for x in names)
    assert out.column("twice").to_pylist()[0] and set(out.column("twice").to_pylist()[0]) <= set(names)
    assert out.column("keys").to_pylist()[1] == []
