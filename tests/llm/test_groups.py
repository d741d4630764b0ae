import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm.graph import components
from riskloom.llm.jaccard import column_components, jaccard_components
from riskloom.llm import leaks as decontamination
from riskloom.llm import substrings
from riskloom.llm.leaks import align, leaks
from riskloom.llm.lines import drop_boilerplate
from riskloom.llm.neighbours import hilbert_keys, nearest
from riskloom.llm.packed import pack, pack_sorted, unpack, unpack_sorted
from riskloom.llm.sharding import _split_equal_rows, overflow_plan, ring_nodes, shard_rows
from riskloom.llm.substrings import remove_repeats
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_components(rows, size=5, percent=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(lower))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = [d for d, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                linked = a and b and 100 * len(a & b) >= percent * len(a | b) or rows[i][0] == rows[j][0]
                if linked and label[j] < label[i]:
                    label[i], changed = label[j], True
    return {(d, len(s), c) for (d, _), s, c in zip(rows, sets, label, strict=True)}


def near_copies():
    """Chains and stars of edited copies around two texts, with a passage all of them share."""
    base, other, passage = prose(3, 120).split(), prose(4, 120).split(), prose(5, 30).split()
    rows = []
    for k in range(40):
        words = list(base if k % 2 else other)
        for e in range(k % 7):
            words[(k * 13 + e * 29) % len(words)] = f"edit{k}x{e}"
        rows.append((100 + k, " ".join(words + (passage if k % 3 else []))))
    for k in range(20):
        rows.append((200 + k, " ".join([*prose(50 + k, 60).split(), *passage])))
    drift = list(base)
    for k in range(12):  # each like the one before, the last unlike the first
        drift[k * 9] = f"drift{k}"
        rows.append((300 + k, " ".join(drift)))
    return rows


def test_jaccard_equals_brute_force(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in jaccard_components(df).collect()}
    assert found == brute_components(rows)


def test_jaccard_on_odd_texts(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
    found = jaccard_components(odd_docs)
    assert found.count() == len(rows)
    assert {tuple(r) for r in found.collect()} == brute_components(rows)
    assert jaccard_components(no_docs).count() == 0


def test_jaccard_by_columns_equals_brute_force(spark, odd_docs, no_docs):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in column_components(df).collect()} == brute_components(rows)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
    rows += [(0, prose(70, 30)), (50, prose(70, 29)), (51, "\u00c9t\u00e9 A\x0bB\x1cC"), (52, "\u00e9t\u00e9 a b\x1cc"), (53, "\u00c9t\u00e9 a\rb\x1cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = column_components(df).collect()
    assert len(found) == len(rows) and {tuple(r) for r in found} == brute_components(rows)
    assert column_components(no_docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[k] == 0 for k in range(51))
    assert all(found[k] == 100 for k in range(100, 140))
    assert found[201] == 200


def brute_repeats(rows, window):
    first, words = {}, [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("window", [1, 2, 13])
def test_repeats_equal_brute_force(spark, odd_docs, no_docs, window):
    rows = near_copies()
    rows += [(1000, "a " * 40), (1001, "a " * 30 + "b"), (5, rows[3][1] + " " + rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, remove_repeats(df, window).collect())) == brute_repeats(rows, window)
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
    assert sorted(map(tuple, remove_repeats(odd_docs, window).collect())) == brute_repeats(odd, window)
    assert remove_repeats(no_docs, window).count() == 0


def test_shared_blocks_are_matched_once(spark):
    df = spark.createDataFrame(near_copies(), "doc_id long, text string")
    plan = remove_repeats(df)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 2 and plan.count("FlatMapCoGroupsInArrow") == 2


def test_a_window_is_sent_once_for_its_smallest_document():
    own = np.array([9, 9, 4, 4, 4, 4, 7])
    start = np.array([0, 1, 20, 21, 25, 28, 40])
    value = np.array([5, 6, 5, 8, 5, 5, 8], np.uint64)
    earlier, sent, again, leader = substrings._senders(own, start, value)
    assert earlier.tolist() == [True, False, False, False, False, False, True]
    assert start[sent].tolist() == [1, 20, 21] and again.tolist() == [25, 28] and leader.tolist() == [20, 20]


def test_repeats_within_a_document_go_with_an_earlier_copy(spark):
    part = prose(31, 20)
    rows = [(5, f"{part} x {part} y {part}"), (9, f"z {part}"), (3, f"w {part} v"), (7, part)]
    for parts in (1, 4):  # in one chunk and in four
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = sorted(map(tuple, remove_repeats(df).collect()))
        assert found == brute_repeats(rows, 13) and [r[2] for r in found] == [0, 60, 20, 20]


def test_colliding_codes_keep_all_flags():
    code, aligned = np.array([7, 3, 7, 7, 9], np.uint32), np.array([False, True, True, False, False])
    several = np.array([False, False, False, True, False])
    kept, flags = substrings._by_code(code, aligned, several)
    assert kept.tolist() == [3, 7, 9] and flags.tolist() == [1, 3, 0]


def test_packed_arrays_return():
    for kind in (np.uint8, np.uint32, np.uint64, np.int64):
        a = np.array([1, 5, 5, 200], kind)
        assert (unpack(pack(a), kind) == a).all() and (unpack_sorted(pack_sorted(a), kind) == a).all()
        assert len(unpack(pack(a[:0]), kind)) == 0


def test_boilerplate_lines(spark, odd_docs, no_docs):
    rows = [(k, f"menu\nown line {k}\nmenu\n\n footer {'x' * (k % 2)}", "h") for k in range(10)]
    rows += [(20, "menu\nfooter", "other"), (21, None, "h"), (22, "", "h"), (23, "menu", None), (24, "menu", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: (r["text"], r["gone"]) for r in drop_boilerplate(df, ratio=0.3, dropped="gone").collect()}
    assert out[0] == ("own line 0\n", 3) and out[1] == ("own line 1\n", 3)
    assert out[20] == ("menu\nfooter", 0) and out[21] == (None, 0) and out[22] == ("", 0)
    assert out[23] == ("menu", 0) and out[24] == ("", 1)
    same = drop_boilerplate(odd_docs)
    assert same.columns == odd_docs.columns and sorted(map(repr, same.collect())) == sorted(map(repr, odd_docs.collect()))
    assert drop_boilerplate(no_docs).count() == 0


def test_shards_are_even_and_gapless(spark, no_docs):
    rows = [(k, "hot" if k % 3 == 0 else f"key {k}") for k in range(2_003)] + [(5, None), (5, None), (None, "x")]
    df = spark.createDataFrame(rows, "row long, order string")
    out = shard_rows(df, df["order"], shards=8, cell_rows=50).collect()
    assert sorted(repr((r["row"], r["order"])) for r in out) == sorted(map(repr, rows))
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(s) for s in slots.values()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shard_rows(df.repartition(5), df["order"], shards=8, cell_rows=50).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    assert shard_rows(no_docs.select("doc_id"), F.col("doc_id")).count() == 0


def test_equal_rows_fill_no_cell(spark):
    rows = spark.range(3_000).selectExpr("concat('k', id % 2 + id * (id % 2)) AS key", "1L AS size")
    rows = rows.selectExpr("key", "size").unionAll(spark.range(6_000).selectExpr("'hot' AS key", "1L AS size"))
    cells = rows.selectExpr("struct(key, size) AS row", "xxhash64(key, size) AS order", "monotonically_increasing_id() AS salt")
    cells = cells.selectExpr("*", "0 AS arc", "0 AS home_shard", "pmod(order, 90) AS cell")
    parts = _split_equal_rows(cells, 100).groupBy("arc", "cell", "equal", "part").count()
    assert parts.agg({"count": "max"}).first()[0] < 400 and parts.where("equal <> 0").count() >= 60
    found = shard_rows(rows, F.col("key"), shards=8, cell_rows=100)
    assert found.count() == 9_000 and found.select("shard", "slot").distinct().count() == 9_000
    by_shard = found.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert all(r["n"] == 1_125 and r["last"] == 1_124 for r in by_shard)


def test_shards_equal_a_plain_ring(spark):
    rows = spark.range(500).selectExpr("concat('key ', id div 7) AS key", "id")
    found = shard_rows(rows, F.col("key"), shards=5, virtual_nodes=4).collect()
    nodes = ring_nodes(5, 4)
    by_arc = {}
    for r in found:
        place = int(hashlib.md5(r["key"].encode()).hexdigest()[:15], 16)
        arc = next((k for k, (at, _) in enumerate(nodes) if at >= place), 0)
        assert r["home_shard"] == nodes[arc][1]
        by_arc.setdefault(arc, []).append(r["shard"])
    # a plain walk: every row left goes one node further each round, while there is room
    room, left, want = [100] * 5, {a: len(v) for a, v in sorted(by_arc.items())}, {a: Counter() for a in by_arc}
    for step in range(len(nodes)):
        for arc in left:
            shard = nodes[(arc + step) % len(nodes)][1]
            while left[arc] and room[shard]:
                left[arc], room[shard] = left[arc] - 1, room[shard] - 1
                want[arc][shard] += 1
    assert {a: Counter(v) for a, v in by_arc.items()} == want


def test_few_rows_move_when_a_shard_joins(spark):
    df = spark.createDataFrame([(k, f"key {k}") for k in range(4_000)], "id long, key string")
    eight = {r["id"]: r["shard"] for r in shard_rows(df, df["key"], shards=8).collect()}
    nine = {r["id"]: r["shard"] for r in shard_rows(df, df["key"], shards=9).collect()}
    assert sum(eight[k] != nine[k] for k in eight) < 0.35 * len(eight)  # a fresh deal would move 8 of 9


def test_overflow_goes_clockwise():
    plan = overflow_plan({0: 5, 1: 1, 2: 0, 3: 2}, owners=[0, 1, 2, 0], most=[3, 3, 2])
    assert plan == [(0, 0, 3, 0, 0), (1, 0, 1, 1, 0), (0, 3, 5, 1, 1), (3, 0, 2, 2, 0)]


def test_hilbert_neighbours_touch():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    key = hilbert_keys(cells, bits=3)
    assert sorted(key.tolist()) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("unit", [True, False])
def test_neighbours_equal_brute_force(spark, unit):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 12)) + 3 * draw.integers(0, 3, size=(600, 1))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x
    x[40:140] = x[40]  # copies
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 12), (1003, [float("nan")] * 12), (1004, [None, *[1.0] * 11]), (1005, [1.0] * 3), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    score = np.round(score, 9)
    for q in range(0, 600, 20):
        assert found[q] == np.lexsort((np.arange(600), -score[q]))[:5].tolist()
    assert set(found) == set(range(0, 600, 20))


def test_few_or_no_neighbours(spark):
    shape = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.0, 2.0])], shape)
    rows = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest(three, F.col("vec_id") % 20 == 0).collect()}
    assert rows == {(0, 1, 20, 1.0), (0, 2, 3, 0.0), (20, 1, 0, 1.0), (20, 2, 3, 0.0)}
    assert nearest(three.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_leaks(spark, odd_docs, no_docs):
    item, second = prose(70, 30), prose(71, 12)
    edited = item.split()
    edited[4], edited[15] = "other", "words"
    del edited[22]
    docs = spark.createDataFrame(
        [
            (1, prose(80, 50) + " " + item + " " + prose(81, 50)),
            (2, prose(82, 20) + " " + " ".join(edited) + "."),
            (3, prose(83, 200)),
            (4, prose(84, 10) + "\n" + second.upper()),
            (5, None),
            (6, ""),
            (7, "exact phrase"),
        ],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(0, item), (1, second), (2, None), (3, ""), (4, "Exact, phrase"), (5, item)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks(docs, items).collect()}
    assert set(found) == {(1, 0), (1, 5), (2, 0), (2, 5), (4, 1), (7, 4)}
    assert found[1, 0] == found[4, 1] == 1.0 and 0.7 < found[2, 0] < 1
    assert leaks(odd_docs, items).count() == 0
    assert leaks(no_docs, items).count() == 0 and leaks(docs, items.limit(0)).count() == 0


def brute_align(a, b, p):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if a[i] == b[j] else -p), h[i, j + 1] - p, h[i + 1, j] - p)
    return h.max()


def test_alignment_equals_the_full_table():
    draw = np.random.default_rng(1)
    for _ in range(200):
        a, b = (draw.integers(0, 4, draw.integers(0, 12)).astype(np.uint64) for _ in range(2))
        assert align(a, b, 0.5)[0] == pytest.approx(brute_align(a, b, 0.5))


def test_leaks_equal_brute_force(spark):
    items = [prose(500 + k, n).split() for k, n in enumerate((30, 40, 59))]
    common = " ".join(items[2][10:13])  # a trigram of an item that most documents hold
    rows = [" ".join([prose(600 + k, 12), common, prose(700 + k, 12)]) for k in range(20)]
    for i, item in enumerate(items):
        for step in (4, 5, 6):
            edited = [f"new{k}" if k % step == step - 1 else w for k, w in enumerate(item)]
            rows.append(" ".join([prose(800 + step, 9), *edited, prose(810 + i, 9)]))
        rows.append(" ".join([prose(820 + i, 9), *item[: len(item) // 2], prose(830 + i, 9)]))  # a part
        rows.append(" ".join([prose(840 + i, 70), *item]))  # exact, beside the edited ones
        spread = [x for k, w in enumerate(item) for x in ([w, f"in{k}"] if k >= 6 else [w])]
        rows.append(" ".join([prose(850 + i, 9), *spread]))  # seeds at one end only
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    expected = {}
    for d, text in enumerate(rows):
        for i, item in enumerate(items):
            score = brute_align(item, text.split(), 0.5) / len(item)
            if score >= 0.4:
                expected[d, i] = pytest.approx(score)
    assert len(expected) == 18
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in leaks(docs, tests).collect()} == expected


EDITS = {
    "every 2nd replaced": lambda w: [f"n{k}" if k % 2 else x for k, x in enumerate(w)],
    "every 3rd replaced": lambda w: [f"n{k}" if k % 3 == 2 else x for k, x in enumerate(w)],
    "every 4th and 5th replaced": lambda w: [f"n{k}" if k % 5 > 2 else x for k, x in enumerate(w)],
    "two of four replaced": lambda w: [f"n{k}" if k % 4 > 1 else x for k, x in enumerate(w)],
    "one put in after each": lambda w: [y for k, x in enumerate(w) for y in (x, f"n{k}")],
    "one put in after each two": lambda w: [y for k, x in enumerate(w) for y in ([x, f"n{k}"] if k % 2 else [x])],
    "two put in after each three": lambda w: [y for k, x in enumerate(w) for y in ([x, f"n{k}", "m"] if k % 3 == 2 else [x])],
    "every 3rd left out": lambda w: [x for k, x in enumerate(w) if k % 3 != 2],
    "neighbours swapped": lambda w: [w[min(k ^ 1, len(w) - 1)] for k in range(len(w))],
    "every 4th pair swapped": lambda w: [w[min(k ^ 1, len(w) - 1)] if k % 8 < 2 else x for k, x in enumerate(w)],
    "first half": lambda w: w[: (len(w) + 1) // 2],
    "upper case": lambda w: [x.upper() for x in w],
}


@pytest.mark.parametrize("broadcast", [True, False])
def test_leaks_of_edited_copies_equal_brute_force(spark, monkeypatch, broadcast):
    """Each kind of edit of items of 3 to 59 words, between words that many documents hold; a third of
    all documents hold one item."""
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_WORDS", 0)
    items = [prose(1500 + n, n).split() for n in (3, 4, 5, 8, 13, 30, 40, 59)]
    items.append((prose(1600, 3) + " ").split() * 8)  # a sequence that repeats
    rows = []
    for i, item in enumerate(items):
        for e, edit in enumerate(EDITS.values()):
            rows.append([*prose(1700 + i, 20).split(), *edit(item), *prose(1800 + e, 9).split()])
    rows += [[*prose(1900 + k, 5).split(), *items[6], *prose(2000 + k, 5).split()] for k in range(len(rows) // 2)]
    texts = [" ".join(r) for r in rows]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    tests = spark.createDataFrame(
        [(i, " ".join(w), 7) for i, w in enumerate(items)], "item_id long, text string, doc_id long"
    )
    expected = {}
    lowered = {t: t.lower().split() for t in texts}
    for i, item in enumerate(items):
        for d, text in enumerate(texts):
            score = brute_align(item, lowered[text], 0.5) / len(item)
            if score >= 0.4:
                expected[d, i] = pytest.approx(score)
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks(docs, tests).collect()}
    assert found == expected and len(expected) > 100


def test_leaks_of_odd_rows(spark):
    item = prose(2100, 25)
    rows = [(1, item), (1, prose(2101, 30)), (1, item), (None, item), (2, None), (3, "solo"), (4, item + " ."), (4, item + " .")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame([(0, item), (0, "other words here now"), (None, item), (5, "Solo"), (6, "?!")], "item_id long, text string")
    found = sorted(tuple(r) for r in leaks(docs, tests).select("doc_id", "item_id", "score").collect())
    assert found == [(1, 0, 1.0), (3, 5, 1.0), (4, 0, 1.0)]


def test_bitmap_holds_every_code(spark):
    codes = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64)
    bits = decontamination.bitmap(spark.createDataFrame([(int(c),) for c in codes], "code long"))
    others = np.random.default_rng(4).integers(0, 1 << 64, 100_000, dtype=np.uint64)
    assert len(decontamination.in_bitmap(bits, codes.view(np.uint64))) == 3000
    assert len(decontamination.in_bitmap(bits, others)) < 50
    assert int(np.unpackbits(bits).sum()) == len(np.unique(codes.view(np.uint64) >> np.uint64(38)))
