import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import ranked
from tests.llm.conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    """Every document against every query, by plain loops."""
    found = [(d, Counter(terms(t))) for d, t in docs]
    full = [c for _, c in found if c]
    n_docs, total = len(full), sum(sum(c.values()) for c in full)
    df = Counter(t for c in full for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        asked = Counter(terms(text))
        scores = []
        for doc, counts in found:
            m = 25 + 75 * sum(counts.values()) * n_docs // max(total, 1)
            score = sum(q * weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t, q in asked.items() if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    docs = [(k, prose(k, 5 + k * 7 % 90)) for k in range(400)]
    docs += [(1000 + k, prose(7, 40)) for k in range(30)]  # equal scores
    docs += [(2000, "alpha1 " * 500 + "rare"), (2001, ""), (2002, None), (None, prose(7, 40)), (None, "rare"), (3, prose(3, 26))]
    items = [(k, prose(k * 11, 12)) for k in range(20)] + [(50, prose(7, 40)), (51, "rare RARE nowhere"), (52, None), (53, "..."), (50, prose(7, 40)), (54, "nowhere"), (None, "rare")]
    return docs, items


@pytest.mark.parametrize(("block", "rows", "queries"), [(128, 4_096, 512), (4, 16, 3)])
def test_search_equals_brute_force(spark, corpus, monkeypatch, block, rows, queries):
    docs, items = corpus
    monkeypatch.setattr(ranked, "QUERIES", queries)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit("x"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    index = ranked.build_index(df, shard_bytes=20_000)
    assert index[0].count() >= 3
    assert found(ranked.search(index, asked, k=10)) == brute(docs, items, 10)
    # the same shards with small blocks and ranges, in this process
    monkeypatch.setattr(ranked, "BLOCK", block)
    monkeypatch.setattr(ranked, "RANGE", rows)
    assert local_search(docs, items, 10) == brute(docs, items, 10)


def local_search(docs, items, k):
    documents = lists = None
    parts = list(ranked._index_shard(0, [d for d, _ in docs], [t or "" for _, t in docs]))
    documents = parts[0][1]
    ids, lengths = documents.column("ids")[0].as_py(), np.array(documents.column("lengths")[0].as_py())
    corpus = ranked.Corpus(int((lengths > 0).sum()), int(lengths.sum()))
    lists = {}
    for _, rows in parts[1:]:
        for at, term in enumerate(rows.column("term").to_pylist()):
            lists[term] = ranked.PostingList(rows.column("blocks")[at].values, lengths, corpus)
    queries = {}
    for key in set(items):
        for term, n in Counter(ranked.terms_of([key[1] or ""])[1].tolist()).items():
            if term in lists:
                df = int(lists[term].n.sum())
                weight = math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * df + 1)))
                queries.setdefault(key, []).append((weight * n, term))
    out = []
    for (item, _), rows in ranked.search_shard(lists, queries, len(ids), k).items():
        out += [(item, rank, None if ids[doc] == ranked.NO_ID else ids[doc], -score) for rank, (score, doc) in enumerate(rows, 1)]
    return sorted(out, key=repr)


def test_blocks_are_left_closed():
    """A list that cannot lift a document over the k-th best is not decompressed."""
    texts = ["common best best best"] * 20 + ["common other"] * 2_000
    documents, *lists = (rows for _, rows in ranked._index_shard(0, list(range(len(texts))), texts))
    lengths = np.array(documents.column("lengths")[0].as_py())
    corpus = ranked.Corpus(len(texts), int(lengths.sum()))
    posted = {t: ranked.PostingList(r.column("blocks")[k].values, lengths, corpus) for r in lists for k, t in enumerate(r.column("term").to_pylist())}
    common, best = ranked.terms_of(["common best"])[1].tolist()
    rows = ranked.search_shard(posted, {0: [(10, common), (5_000, best)]}, len(texts), 10)[0]
    assert [doc for _, doc in rows] == list(range(10))
    ranked.RANGE, size = 64, ranked.RANGE
    try:
        for p in posted.values():
            p.opened.clear()
        assert ranked.search_shard(posted, {0: [(10, common), (5_000, best)]}, len(texts), 10)[0] == rows
        assert len(posted[common].opened) <= 1 < len(posted[common].n)
    finally:
        ranked.RANGE = size


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = [(0, "one two"), (1, "DÉJÀ vu"), (2, "s endoftext"), (3, prose(8, 30))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(ranked.search(ranked.build_index(odd_docs), asked)) == brute(rows, items, 10)
    assert ranked.search(ranked.build_index(no_docs), asked).count() == 0
    assert ranked.search(ranked.build_index(odd_docs), asked.limit(0)).count() == 0
