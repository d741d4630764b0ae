import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import spelling
from riskloom.llm.queries import llm_queries
from tests.llm.conftest import prose

UPPER = {c: c + 32 for c in range(65, 91)}


def brute_variants(rows, noise=97, least_length=5, least_rows=3):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(UPPER)):
            picked = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = picked % len(run)
            n[run[:at] + run[at + 1 :] if noise and picked % noise == 0 else run] += 1
    words = {w: k for w, k in n.items() if k >= least_rows and len(w) >= least_length}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def found(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_variants_equal_brute_force(spark, tables, monkeypatch):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    # blocks far smaller than a cell, so that cells are cut
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 8)
    monkeypatch.setattr(spelling, "GATHERED", 16)
    out = llm_queries()["op12_spelling_variants"](spark, tables)
    assert found(out) == expected_of(rows)


def expected_of(rows):
    """The brute force over pairs that share a letter-deleted form, which all near words do."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(UPPER)):
            picked = zlib.crc32(f"{doc}:{run}".encode())
            at = picked % len(run)
            n[run[:at] + run[at + 1 :] if picked % 97 == 0 else run] += 1
    words = {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}
    cut = defaultdict(set)
    for w in words:
        cut[w].add(w)
        for k in range(len(w)):
            cut[w[:k] + w[k + 1 :]].add(w)
    near = {w: set() for w in words}
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    out = set()
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w in words:
        end = w
        while form[end] is not None:
            end = form[end]
        out.add((w, form[w], end, words[w], len(near[w]), words.get(form[w])))
    return out


def test_chains_ties_and_odd_texts(spark, odd_docs, no_docs):
    long = "ab" * 2_000
    texts = ["paper " * 40, "papers " * 20, "paperss " * 9, "PAPERz " * 9, "pepper " * 3, "abcde abcdf abcdg " * 3]
    texts += [f"{long} " * 8, f"{long}c " * 4, f"{long[:-1]}É " * 3, "élève élèves ÉLÈVE " * 5, None, "", " \n"]
    rows = [*enumerate(texts), (0, "paper"), (0, "paper"), (None, "paper papers")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = spelling.variant_groups(spelling.word_counts(df))
    assert found(out) == brute_variants(rows)
    by_word = {r["word"]: r for r in out.collect()}
    assert by_word["paperss"]["root"] == by_word["paperz"]["root"] == "paper" and by_word["paperss"]["form"] in ("papers", "paperz")
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(spelling.variant_groups(spelling.word_counts(odd_docs))) == brute_variants(odd)
    assert spelling.variant_groups(spelling.word_counts(no_docs)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_block_products_find_every_pair(seed):
    draw = np.random.default_rng(seed)
    a = ["".join(draw.choice(list("abcé"), 6)) for _ in range(200)]
    b = ["".join(draw.choice(list("abcé"), 6 + k % 2)) for k in range(200)]
    a, b = sorted(set(a)), sorted(set(b))
    i, j = spelling.near_pairs(spelling.Words(a, np.ones(len(a))), spelling.Words(b, np.ones(len(b))))
    got = {(a[x], b[y]) for x, y in zip(i, j, strict=True)}
    assert got == {(x, y) for x in a for y in b if one_edit(x, y)}


def test_prose_without_noise(spark):
    rows = [(k, prose(k, 200)) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = spelling.variant_groups(spelling.word_counts(df, noise=None, least_length=3, least_rows=1))
    assert found(out) == brute_variants(rows, noise=None, least_length=3, least_rows=1)
