"""Search, quality rules and spelling variants against plain-Python versions of their contracts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
import regex

from knownby.llm import rules, search, variants
from knownby.llm.common import store
from tests.llm.fixtures import DOCS, rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


# --- ranked lexical search -------------------------------------------------------------------------

def py_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def search_brute(doc_rows, items, k=10):
    parts = defaultdict(list)
    for doc_id, text in doc_rows:
        if doc_id is not None:
            parts[doc_id] += py_terms(text)
    tf = {d: Counter(t) for d, t in parts.items() if t}
    big_n, big_l = len(tf), sum(len(parts[d]) for d in tf)
    df = Counter(t for c in tf.values() for t in c)
    out = []
    for item_id, text in items:
        if item_id is None:
            continue
        asked = set(py_terms(text))
        scores = {}
        for d, c in tf.items():
            m = 10 + (90 * sum(c.values()) * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in asked if t in c)
            if s > 0:
                scores[d] = s
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(item_id, r + 1, d, s) for r, (d, s) in enumerate(best)]
    return sorted(out)


ITEMS = [(1, "the and eri ath ber"), (2, None), (3, "ONE id, of two texts"), (None, "the"), (4, "!!! ..."),
         (5, "same short text"), (6, "zzzz-nowhere"), (7, "Ath ber ung sch ción eau lich ou re the"), (1, "more terms")]


@pytest.mark.parametrize("first_depth, growth", [(256, 8), (1, 2), (3, 3)])
def test_search_equals_brute_force(spark, docs, first_depth, growth):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = search.search(docs, items, k=10, first_depth=first_depth, growth=growth).collect()
    doc_rows = [(r[0], r[1]) for r in rows()]
    merged = defaultdict(str)
    for item_id, text in ITEMS:
        merged[item_id] += " " + (text or "")
    assert sorted(tuple(r) for r in got) == search_brute(doc_rows, merged.items())


def test_search_ties_rank_by_doc_id(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(30)] + [(100, "gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    got = search.search(docs, items, first_depth=2, growth=2).collect()
    assert [r["doc_id"] for r in got] == list(range(10)) and [r["rank"] for r in got] == list(range(1, 11))


def test_search_reads_twice_at_most(spark, monkeypatch):
    """The k-th score of the first round sets the depth of the second; no round by round deepening."""
    texts = [(i, f"alpha beta w{i % 7} " + "gamma " * (i % 5) + "pad " * (i % 11)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    asked = [(1, "alpha gamma w3"), (2, "beta pad"), (3, "w1 w2 alpha beta"), (4, "alpha")]
    purposes = []
    monkeypatch.setattr(search, "store", lambda df, purpose: purposes.append(purpose) or store(df, purpose))
    got = search.search(docs, spark.createDataFrame(asked, "item_id long, text string"), first_depth=1, growth=2).collect()
    assert sorted(tuple(r) for r in got) == search_brute(texts, asked)
    assert purposes.count("search-hits") <= 2 and "search-postings" not in purposes


def test_search_empty_and_clashing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert search.search(empty, items).count() == 0
    odd = spark.createDataFrame([(1, "alpha", 5, "x")], "doc_id long, text string, c int, pos string")
    assert search.search(odd, items).count() == 1
    long_text = spark.createDataFrame([(1, "alpha " * 200_000), (2, "alpha beta")], "doc_id long, text string")
    assert [r["doc_id"] for r in search.search(long_text, items).collect()] == [1, 2]


# --- quality rules ---------------------------------------------------------------------------------

def rules_brute(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    n = len(w)
    lines = [line for line in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    covered = {i + o for i in range(n - 2) if grams[tuple(w[i:i + 3])] >= 2 for o in range(3)}
    m = dict(n_words=n, word_chars=sum(len(x) for x in w), n_symbols=len(re.findall(r"[#*$%&|<>]", t)),
             n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered))
    m["base_failed"] = n < 50 or 100 * len(covered) > 50 * n
    nl = max(len(lines), 1)
    rejected = (m["word_chars"] < 3 * n or m["word_chars"] > 10 * n or m["n_symbols"] * 10 > n
                or m["n_dup_lines"] * 10 > len(lines) * 3
                or sum(1 for x in w if not regex.search(r"\p{L}", x)) / max(n, 1) > 0.2
                or sum(1 for line in lines if re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*\Z", line)) / nl > 0.3
                or sum(1 for line in lines if re.match(r"[\x20\x09-\x0D]*[-*•]", line)) / nl > 0.9)
    m["kept"] = not (m["base_failed"] or rejected)
    return m


def rule_texts():
    prose = " ".join(f"word{i % 17}x lorem{i % 5}" for i in range(60))
    return [
        (1, prose), (2, None), (3, ""), (4, "a b c " * 40), (5, "# $ % & | < > " * 10 + prose),
        (6, "\n".join(["- item one two three four"] * 2 + [f"- point {i} here" for i in range(20)])),
        (7, "\n".join(f"line {i} of words and more words..." for i in range(30))),
        (8, "\n".join(["same line here"] * 20 + [prose])), (9, " ".join(str(i) for i in range(80))),
        (10, prose + "\nend."), (10, prose + "\nend."), (None, prose), (11, "x" * 100_000 + " " + prose),
    ]


def test_rules_equal_brute_force(spark, docs):
    extra = spark.createDataFrame(rule_texts(), "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(extra)
    got = rules.judge(table).collect()
    want = [rules_brute(r["text"]) for r in got]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert [{k: r[k] for k in names} for r in got] == want
    assert sum(w["kept"] for w in want) >= 3 and sum(not w["kept"] and not w["base_failed"] for w in want) >= 3


def test_rule_order_changes_no_verdict(spark):
    table = spark.createDataFrame(rule_texts(), "doc_id long, text string")
    forward = [r["kept"] for r in rules.judge(table, rules.default_rules()).collect()]
    backward = [r["kept"] for r in rules.judge(table, rules.default_rules()[::-1]).collect()]
    planned = rules.plan(table, sample_rows=100)
    assert forward == backward and len(planned) == len(rules.default_rules())
    assert [p.score for p in planned] == sorted((p.score for p in planned), reverse=True)


def test_rules_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b c", 7, True)], "doc_id long, text string, n_words int, kept boolean")
    got = rules.judge(clash).first()
    assert got["n_words"] == 3 and got["kept"] is False


# --- spelling variants -----------------------------------------------------------------------------

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def variants_brute(doc_rows, ratio=5):
    counts = Counter()
    for doc_id, text in doc_rows:
        for run in (r.translate(FOLD) for r in re.findall("[A-Za-z\u00C0-\u00FF]+", text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 6:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-words[v], v)) if vs else None
        form[w] = top if top is not None and words[top] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def variant_rows():
    out = []
    spellings = [("spelling", 300), ("speling", 50), ("spelping", 9), ("spellings", 6), ("grammar", 40),
                 ("grammer", 40), ("grammaire", 7), ("résumé", 20), ("resume", 30), ("Résumés", 5),
                 ("ÀÀÀÀÀÀÀÀ", 5), ("abcdef", 4), ("bananas", 12), ("bananes", 12)]
    i = 0
    for word, n in spellings:
        for _ in range(n):
            out.append((i, f"{word}, and {word.upper()}!" if i % 7 == 0 else f"Some {word} here", "en", "s"))
            i += 1
    out += [(None, "spelling spelling"), (5000, None), (5001, ""), (5002, "x" * 50_000)]
    return [(d, t) for d, t, *_ in out]


def test_variants_equal_brute_force(spark, docs):
    extra = spark.createDataFrame(variant_rows(), "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(extra)
    got = sorted(tuple(r) for r in variants.variants(table).collect())
    want = variants_brute([(r[0], r[1]) for r in rows()] + variant_rows())
    assert got == want
    assert any(f is not None for _, f, *_ in want) and any(root != w for w, _, root, *_ in want)


def test_stored_words_are_never_broadcast(spark, monkeypatch):
    # a stored table is sized by its compressed file, the shifted prefix rows by their input: both far too low
    plans = []

    def planned(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, purpose)

    monkeypatch.setattr(variants, "store", planned)
    table = spark.createDataFrame(variant_rows(), "doc_id long, text string")
    assert variants.variants(table).count() > 0
    assert any("SortMergeJoin" in plan for plan in plans)
    assert not any("Broadcast" in plan for plan in plans)


def test_pivots_are_disjoint_and_cheapest():
    grams = [(5, "ab", 0), (1, "bc", 1), (1, "cd", 2), (9, "de", 3), (2, "ef", 4)]
    chosen = variants.choose_pivots(grams)
    positions = sorted(grams[i][2] for i in chosen)
    assert positions[1] - positions[0] >= 2 and sum(grams[i][0] for i in chosen) == 3


def test_variants_empty(spark):
    assert variants.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
