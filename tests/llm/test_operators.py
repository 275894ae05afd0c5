"""Every operator against a brute-force version, over ordinary rows and the odd ones of the fixture."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from knownby.llm import ann, bpe, common, exact_dedup, langid, licenses, lmscore, mixing, near_dedup, quality, secrets
from knownby.llm.components import connected_components
from tests.llm.fixtures import DOCS, rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def key(values):
    return sorted(values, key=repr)


# --- exact dedup -------------------------------------------------------------------------------

def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("options", [{}, {"capacity": 4}, {"capacity": 2, "key_bits": 3}])
def test_exact_groups(docs, options):
    groups = defaultdict(list)
    for r in rows():
        groups[norm(r[1])].append(r[0])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = [tuple(r) for r in exact_dedup.exact_groups(docs, **options).collect()]
    assert key(got) == key(want)


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    keys = spark.range(4000).select((F.col("id") * 37 % 4096).alias("key")).distinct()
    d = exact_dedup.build_directory(keys, capacity=100, key_bits=12)
    held = np.bincount(d.bucket_of(np.array([r[0] for r in keys.collect()])))
    assert held.max() <= 100 and len(d.cells) == 2 ** d.depth
    skewed = spark.range(500).select(F.col("id").alias("key"))  # all in one corner of a wide key space
    d = exact_dedup.build_directory(skewed, capacity=100, key_bits=20)
    assert np.bincount(d.bucket_of(np.arange(500))).max() <= 100


def test_drop_copies(docs, none):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert key(norm(r["text"]) for r in kept.collect()) == key({norm(r[1]) for r in rows()})
    assert exact_dedup.drop_copies(none).count() == 0


# --- near dedup --------------------------------------------------------------------------------

def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def near_brute(table):
    sets = [(r[0], shingle_set(r[1])) for r in table]
    up = {i: i for i, _ in sets}

    def root(i):
        return i if up[i] == i else root(up[i])

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                up[high] = low
    return [(i, len(s), root(i) if s else i, i == (root(i) if s else i)) for i, s in sets]


@pytest.mark.parametrize("few, small", [(32, 64), (2, 64), (2, 3), (32, 0)])
def test_near_groups(docs, monkeypatch, few, small):
    """With small limits, the sketch path and the block path see every set."""
    monkeypatch.setattr(near_dedup, "FEW", few)
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "SMALL_PARTNER", small * 100 // 75)
    table = [r for r in rows() if r[0] != 81]  # two texts with one id have a component each
    got = [tuple(r) for r in near_dedup.near_groups(docs.where("doc_id IS NULL OR doc_id != 81")).collect()]
    assert key(got) == key(near_brute(table))


def test_near_empty_table_and_columns(docs, none):
    assert near_dedup.near_groups(none).count() == 0
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {30, 31, 41, 50} & {r["doc_id"] for r in kept.collect()} == {30}


def test_sketch_estimate():
    rng = np.random.default_rng(5)
    for share in (0.2, 0.6, 0.9):
        pool = rng.integers(0, 2 ** 63, 6000, dtype=np.uint64)
        both = int(4000 * share)
        a, b = np.unique(pool[:4000]), np.unique(np.concatenate([pool[:both], pool[4000:8000 - both]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        regs = [near_dedup.registers(x)[None, :] for x in (a * np.uint64(2), b * np.uint64(2))]
        j, used = near_dedup.estimate(*regs, np.array([len(a)]), np.array([len(b)]))
        assert abs(j[0] - true) < 5 * math.sqrt(0.25 / used[0])


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[103] == 100 and got[229] == 200


# --- mixing ------------------------------------------------------------------------------------

def fill(budget, caps, weights):
    """Shares by weight; full children give back to their siblings."""
    given, left = {}, dict(caps)
    while left:
        rest, w_all = budget - sum(given.values()), sum(weights[c] for c in left)
        full = [c for c in left if left[c] * w_all <= weights[c] * rest]
        if not full:
            return given | {c: weights[c] * rest // w_all for c in left}
        for c in full:
            given[c] = left.pop(c)
    return given


def test_mixture(docs, none):
    weights = {("en",): 5, ("de",): 1, ("fr",): 3, ("fr", "src2"): 4}
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    leaves = defaultdict(list)
    for r in rows():
        leaves[(r[2] or "(none)", r[3] or "(none)")].append((r[0], len((r[1] or "").split())))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
    langs = sorted({k[0] for k in tokens})
    total = sum(tokens.values()) * 80 // 100
    by_lang = fill(total, {g: 2 * sum(n for k, n in tokens.items() if k[0] == g) for g in langs}, {g: weights.get((g,), 1) for g in langs})
    want = []
    for g in langs:
        own = [k for k in tokens if k[0] == g]
        budgets = fill(by_lang[g], {k: 2 * tokens[k] for k in own}, {k: weights.get(k, 1) for k in own})
        for k in own:
            epochs = budgets[k] // tokens[k] if tokens[k] else 0
            rest, upto = budgets[k] - epochs * tokens[k], 0
            order = lambda d: (hashlib.md5(f"mix-1-{epochs}-{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[0] or -1, d[1])  # noqa: E731, B023
            for doc_id, n in sorted(leaves[k], key=order):
                upto += n
                want.append((doc_id, *k, n, budgets[k], epochs + (upto <= rest)))
    got = [tuple(r) for r in mixing.mixture(docs, levels, weights).collect()]
    assert key(got) == key(want)
    assert sum(n for _, _, _, n, _, c in got for _ in range(c)) <= total
    assert mixing.mixture(none, levels, weights).count() == 0
    chosen = mixing.select_mixture(docs, levels, weights)
    assert chosen.columns == docs.columns and chosen.count() == sum(c for *_, c in got)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000)], "d string, s string, tokens long")
    got = {(r["d"], r["s"]): r["budget"] for r in mixing.allocate(leaves, ["d", "s"], {}, 1, 50).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 492, ("b", "z"): 502}


# --- byte-level BPE ----------------------------------------------------------------------------

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.mark.parametrize("block_chars", [bpe.BLOCK_CHARS, 200])
def test_bpe_as_the_library_encodes(docs, block_chars):
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    got = bpe.with_digests(bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, block_chars), RANKS)).collect()
    want = []
    for r in rows():
        ids = whole.encode_ordinary(r[1] or "")
        want.append((r[0], ids, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert key(tuple(r) for r in got) == key(want)


def test_bpe_equal_blocks_and_empty_table(spark, none):
    twice = spark.createDataFrame([(1, "same words here", None)] * 2, "doc_id long, text string, ids string").repartition(2)
    got = bpe.encode(twice, RANKS, public_tokenizers.PATTERN, 1).collect()
    assert len(got) == 2 and got[0]["ids"] == got[1]["ids"]
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


# --- classifiers -------------------------------------------------------------------------------

def test_language(spark, docs, none):
    en, es = ["the house and the river run", "this is that which was here"], ["la casa y el río corren", "esto es lo que estaba aquí"]
    many = [(i, f"{(en if i % 2 else es)[i // 2 % 2]} {i}", "en" if i % 2 else "es") for i in range(120)]
    table = spark.createDataFrame(many + [(500, None, "en"), (501, "123 !", "en"), (None, "the river", "en")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(table, langid.train(table)).collect()}
    assert all(got[i]["lang_pred"] == lang and 0.5 < got[i]["score"] <= 1 for i, _, lang in many)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in many)
    assert [tuple(got[i])[2:] for i in (500, 501)] == [("und", 0.0)] * 2 and got[None]["lang_pred"] == "en"
    assert langid.identify(docs, langid.train(none)).where("lang_pred != 'und' OR score != 0").count() == 0
    assert langid.identify(none, langid.train(docs)).count() == 0


def test_three_close_languages_vote(spark):
    words = {"fr": "le chat est dans la maison avec eau", "es": "el gato está en la casa con agua", "it": "il gatto sta nella casa con acqua"}
    table = spark.createDataFrame([(i, words[g] + f" x{i}", g) for i, g in enumerate(list(words) * 40)], "doc_id long, text string, lang string")
    model = langid.train(table)
    assert model.families == ["romance"] and len(model.pairs["romance"]) == 3
    got = langid.identify(table, model).join(table, "doc_id")
    assert got.where("lang_pred != lang").count() == 0


def test_quality(spark, docs, none):
    good = "Some plain words make a sentence here and go on."
    bad = "BUY!! NOW!! CHEAP$$$ *** ||| !!"
    table = spark.createDataFrame([(i, f"{good if i % 3 else bad} {i}") for i in range(240)] + [(900, None), (901, ""), (None, good)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, "x") for i in range(240)] + [(7, None, "x"), (None, 0, "x"), (5000, 1, "x")], "doc_id long, quality int, text string")
    model = quality.train(table, labels)
    got = {r["doc_id"]: r for r in quality.quality_scores(table, model).collect()}
    assert all(got[i]["predicted"] == (1 if i % 3 else 0) == (got[i]["score"] >= 0.3) for i in range(240))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(240))
    assert 0 <= got[900]["score"] <= 1 and got[None]["predicted"] == 1
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    unlabelled = quality.quality_scores(docs, quality.train(docs, labels.limit(0)))
    assert unlabelled.where("score != 0.5").count() == 0 and unlabelled.count() == len(rows())
    assert quality.quality_scores(none, model).count() == 0
    assert quality.quality_scores(none, quality.train(none, labels)).count() == 0


def test_context_vectors_are_sums_over_all_documents(spark):
    texts = ["a b c d e f", "c a b", "", None, "b"]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    index, bins = quality.index_vectors().astype(int), quality.Bins()
    want = np.zeros((quality.BINS, quality.DIM))
    for t in texts:
        packed = bins.of(t)
        for i, p in enumerate(packed):
            around = sum((index[packed[j] & 0xFFFF] + index[packed[j] >> 16] for j in range(max(0, i - 2), min(len(packed), i + 3)) if j != i),
                         np.zeros(quality.DIM, int))
            want[p & 0xFFFF] += around
            want[p >> 16] += around
    norms = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(quality.word_vectors(table), np.where(norms > 0, want / np.maximum(norms, 1e-9), 0), atol=1e-6)


# --- language-model scores ---------------------------------------------------------------------

def test_cross_entropy_difference(spark, docs, none):
    wanted = {1, 5, 9, 13, 50, 71}
    got = lmscore.cross_entropy_difference(docs, spark.createDataFrame([(i,) for i in wanted] + [(None,)], "doc_id long"), block_chars=2000).collect()
    table = [(r[0], b"\0\0\0\0" + (r[1] or "").encode()) for r in rows()]
    n = [defaultdict(float) for _ in range(2)]
    total = [0, 0]
    for doc_id, b in table:
        for which in [1] + [0] * (doc_id in wanted):
            total[which] += len(b) - 4
            for i in range(4, len(b)):
                for k in range(5):
                    n[which][b[i - k:i + 1]] += 1
                    n[which][b[i - k:i], "next"] += 1
    scale = [1, total[0] / total[1]]

    def p(which, h, c):
        lower = p(which, h[1:], c) if h else 1 / 256
        return (n[which][h + c] * scale[which] + 4 * lower) / (n[which][h, "next"] * scale[which] + 4)

    want = defaultdict(list)
    for doc_id, b in table:
        losses = [-np.mean([math.log(p(w, b[i - 4:i], b[i:i + 1])) for i in range(4, len(b))]) if len(b) > 4 else None for w in (0, 1)]
        want[doc_id].append((len(b) - 4, *losses))
    have = defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["n_tokens"], r["target_loss"], r["background_loss"]))
        assert (r["score"] is None) == (r["n_tokens"] == 0)
    assert set(have) == set(want)
    for i in want:
        for x, y in zip(sorted(have[i]), sorted(want[i])):
            assert x[0] == y[0] and (x[1] is None if y[1] is None else np.allclose(x[1:], y[1:], rtol=1e-9))
    empty = lmscore.cross_entropy_difference(docs, none)
    assert empty.count() == len(rows()) and empty.where("score IS NOT NULL").count() == 0
    assert lmscore.cross_entropy_difference(none, docs).count() == 0


# --- licenses ----------------------------------------------------------------------------------

def test_licenses(spark, none):
    mit, rights = "Released under the MIT License.", "All rights reserved."
    table = [(1, "a/LICENSE", mit), (2, "a/b/x.txt", "some text"), (3, "a/b/c/y.txt", f"text\n{rights}\nmore"), (4, "a/b/c/LICENSE", "Licensed under CC BY-NC 4.0"),
             (5, "a/b/c/d/z", None), (6, "q/w", ""), (7, None, rights), (8, None, "x"), (9, "top", "x"), (9, "top", "x"), (10, "ab/x", "the license of all"),
             (11, "a/b/c/LICENSE", rights), (12, "m/LICENSE", "no license here at all")]
    df = spark.createDataFrame([(*r, "k") for r in table], "doc_id long, path string, text string, license string")
    got = {r["doc_id"]: (r["own_license"], r["license"], r["origin"], r["inherited_from"]) for r in licenses.scan_licenses(df, F.col("path").endswith("LICENSE")).collect()}
    assert got == {
        1: ("MIT", "MIT", "file", None), 2: (None, "MIT", "inherited", "a"), 3: ("Proprietary", "Proprietary", "header", None),
        4: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "file", None), 5: (None, "CC-BY-NC-4.0", "inherited", "a/b/c"), 6: (None, None, "none", None),
        7: ("Proprietary", "Proprietary", "header", None), 8: (None, None, "none", None), 9: (None, None, "none", None),
        10: (None, None, "none", None), 11: ("Proprietary", "Proprietary", "file", None), 12: (None, None, "none", None)}
    assert licenses.scan_licenses(none.withColumn("path", F.lit("a/b")), F.lit(False)).count() == 0


def test_license_scores_against_all_lines(spark):
    """Scores without the anchor filter, word by word."""
    lines = ["Licensed under the Apache License, Version 2.0.", "licensed under the apache license version 3 0", "under the license", "permission is granted",
             "All rights reserved by the house", "all rights", "GNU General Public License version 3", "Released under the MIT License today in the morning"]
    df = spark.createDataFrame([(i, None, x) for i, x in enumerate(lines)], "doc_id long, path string, text string")
    low = 0.5
    got = {r["doc_id"]: (r["own_license"], r["own_score"]) for r in licenses.own_licenses(df, low).collect()}
    tok = lambda x: [w for w in re.split("[^a-z0-9]+", x.lower()) if w]
    vocabulary = {w for _, t in licenses.TEMPLATES for w in tok(t)}
    df_ = {w: sum(w in tok(x) for x in lines) for w in vocabulary}
    idf = lambda w: math.log((1 + len(lines)) / (1 + df_.get(w, 1))) + 1
    for i, x in enumerate(lines):
        best = (0, None)
        for name, t in licenses.TEMPLATES:
            a, b = ({w: tok(s).count(w) * idf(w) for w in tok(s)} for s in (x, t))
            cos = sum(a[w] * b[w] for w in a if w in b) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
            best = max(best, (round(cos, 6), name), key=lambda s: (s[0], [-ord(c) for c in s[1] or "~"]))
        assert got[i] == ((best[1], pytest.approx(best[0], abs=2e-6)) if best[0] >= low else (None, None))


# --- secrets -----------------------------------------------------------------------------------

def base_spans(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate([
            ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
            ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(found)


def test_secrets(spark, docs, none):
    extra = [(200 + i, f"word Qx7{hashlib.md5(str(i).encode()).hexdigest().upper()[:20]}zK and thereforeitisalongword{chr(97 + i % 26)} x") for i in range(60)]
    table = docs.select("doc_id", "text", "key").unionByName(spark.createDataFrame([(*r, "k") for r in extra], "doc_id long, text string, key string"))
    got = secrets.find_secrets(table).collect()
    texts = [(r[0], r[1]) for r in rows()] + extra
    want, have = [], []
    for doc_id, text in texts:
        base = base_spans(text)
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        want.append((doc_id, *(sum(k == kind for *_, k in base) for kind in ("assign", "access", "hex")), hashlib.sha256(listed.encode()).hexdigest(), listed))
    for r in got:
        listed = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("markov"))
        have.append((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], listed))
        assert r["spans"].count("markov") == r["n_markov"]
    assert key(have) == key(want)
    assert secrets.find_secrets(none).count() == 0


def test_markov_spans(spark):
    import random
    rng = random.Random(4)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_string = lambda n: "".join(rng.choice(chars) for _ in range(n))
    plain = "therationalityoferingandthenheshereforeandtheoration"
    table = [(i, f"password={random_string(24)} {plain[i % 20:i % 20 + 24]}") for i in range(200)]
    table += [(1000, f"see {plain[3:25]}2 end"), (1001, "see Zq8Xw3KpVt6Rj2Lm9Yb end"), (1002, "Zq8Xw3KpVt6Rj2Lm9Yb")]
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got[1000] == "" and got[1001] == "markov:4:23" and got[1002] == "markov:0:19"
    assert all("markov" not in got[i] for i in range(200))


# --- nearest neighbours ------------------------------------------------------------------------

def test_ann_whole_windows_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[50:70] = x[50]  # copies tie
    table = [(i, [float(v) for v in row], "a") for i, row in enumerate(x)]
    odd = [(300, None, "a"), (301, [0.0] * 16, "a"), (302, [float("nan")] * 16, "a"), (303, [1.0, None] + [0.0] * 14, "a"), (400, [float("inf")] * 16, "a"),
           (500, [1.0], "a"), (None, [1.0] * 16, "a")]
    df = spark.createDataFrame(table + odd + [table[100], table[7]], "vec_id long, embedding array<float>, rank string")
    got = key(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0, block=64).collect())
    want = []
    exact = x.astype(float)
    for q in (0, 100, 200):
        d = np.sqrt(np.square(exact - exact[q]).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(300), d)) if i != q][:10]
        want += [(q, n + 1, int(i), float(d[i])) for n, i in enumerate(order)]
    assert got == key(want)
    assert ann.nearest(df.where("vec_id < 5"), F.col("vec_id") % 100 == 0).count() == 4
    assert ann.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_hilbert_neighbours_touch():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = ann.hilbert_keys(cells, 3)
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert len(set(keys)) == 512 and (steps == 1).all()


def test_text_batches_bounds_a_batch_and_puts_the_setting_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    with common.text_batches(spark, 100):
        got = [r["n"] for r in spark.range(0, 950, 1, 1).mapInArrow(sizes, "n long").collect()]
    assert max(got) == 100 and sum(got) == 950 and spark.conf.get(key) == before


def test_exact_index_reads_small_batches(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(exact_dedup, "store", lambda df, purpose: seen.append(
        (purpose, df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))) or common.store(df, purpose))
    exact_dedup.exact_groups(docs).collect()
    assert ("hash-index", str(common.TEXT_ROWS)) in seen
