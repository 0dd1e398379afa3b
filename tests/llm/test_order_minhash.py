"""Order MinHash: the alignment, the sketches, and groups against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.llm import order_minhash as om


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40), st.integers(0, 45))
def test_banded_distance(a, b, most):
    true = distance(a, b)
    assert om.distance_within(a, b, most) == (true if true <= most else None)


@settings(deadline=None, max_examples=50)
@given(st.lists(st.integers(0, 50), min_size=20, max_size=150), st.integers(0, 30), st.randoms())
def test_banded_distance_of_near_copies(a, edits, rng):
    b = list(a)
    for _ in range(edits):
        at = rng.randrange(len(b) + 1)
        b[at : at + rng.randrange(2)] = [rng.randrange(50)] * rng.randrange(2)
    true = distance(a, b)
    for most in (true - 1, true, true + 1, 30):
        if most >= 0:
            assert om.distance_within(a, b, most) == (true if true <= most else None)


def test_sketch():
    worker = om.Sketcher(om.Sketch())
    text = " ".join(f"w{i}" for i in range(200))
    assert (worker.keys(text) == worker.keys(text.upper().replace(" ", ",  "))).all()
    backwards = " ".join(f"w{i}" for i in list(range(100, 200)) + list(range(100)))
    shared = (worker.keys(text) == worker.keys(backwards)).mean()
    # The same k-mers but for the seam; the order tells tuples across it apart.
    assert 0.25 < shared < 0.75
    assert worker.keys(" \n") is None and len(worker.keys("a")) == 64
    long = " ".join(f"w{i % 7}" for i in range(30000))
    assert (worker.keys(long) == om.Sketcher(om.Sketch()).keys(long)).all()


def edited(rng, words, share):
    out = []
    for w in words:
        if rng.random() < share:
            out += rng.choice([[], [f"x{rng.randrange(10**6)}"], [w, f"y{rng.randrange(10**6)}"]])
        else:
            out.append(w)
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    line = " ".join(f"hot{i}" for i in range(14))
    for _ in range(60):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([25, 60, 200, 700]))]
        base = " ".join(words)
        texts.append(f"{line}\n{base}" if rng.random() < 0.3 else base)
        for _ in range(rng.choice([0, 0, 1, 2, 12])):
            texts.append(" ".join(edited(rng, texts[-1].split(), rng.choice([0.0, 0.02, 0.05, 0.08]))))
    texts += ["", "", " ", "a b", "a b", "A  b.", "a c", None]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_groups(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS keys")
    out = {r.doc_id: r for r in om.near_documents(docs).collect()}
    assert sorted(out) == list(range(len(texts)))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = found = 0
    for i in range(len(texts)):
        for j in range(i):
            x, y = om.words_of(texts[i] or ""), om.words_of(texts[j] or "")
            # The alignment is held against the plain table above; here it saves time.
            near = (texts[i] or "") == (texts[j] or "") or (
                x and y and om.distance_within(x, y, max(len(x), len(y)) // 5) is not None)
            if near:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
                links += 1
                found += out[i].group_id == out[j].group_id
    # No link that brute force lacks, and next to all of them.
    for i, r in out.items():
        assert find(r.group_id) == find(i) and r.kept == (r.group_id == i)
    assert found >= 0.99 * links, (found, links)


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (5, "p q"), (5, "r s"), (9, "r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((tuple(r) for r in om.near_documents(docs).collect()), key=str)
    assert out == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (None, None, True),
                          (5, 5, True), (5, 5, True), (9, 5, False)], key=str)
    assert om.near_documents(docs.limit(0)).count() == 0


def test_links_beside_the_smallest_document(spark):
    """Two texts that share only a passage's tuples, whose smallest document is like neither."""
    passage = [f"p{i}" for i in range(70)]

    def own(name, shared):
        return [f"s{i}" if shared and i % 2 else f"{name}{i}" for i in range(30)]

    # So many smaller ids that one of them heads each bucket of the passage.
    texts = [passage + own(f"z{k}x", False) for k in range(40)] + [passage + own("b", True), passage + own("c", True)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert om.alike(" ".join(texts[40]), " ".join(texts[41]), 80) and not om.alike(" ".join(texts[0]), " ".join(texts[40]), 80)
    out = {r.doc_id: r.group_id for r in om.near_documents(docs).collect()}
    assert out == {i: 40 if i == 41 else i for i in range(len(texts))}


def test_links_of_short_texts(spark):
    """All links of texts of 5 to 100 words near the threshold; brute force finds the same."""
    rng, texts = random.Random(3), []
    line = [f"l{i}" for i in range(5)]
    for n in [5, 8, 9, 10, 11, 14, 15, 16, 20, 25, 30, 50, 75, 100]:
        for k in range(6):
            base = (line if k % 2 else []) + [f"n{n}k{k}w{rng.randrange(4 * n)}" for _ in range(n)]
            base = base[:n]
            copy = list(base)
            for at in sorted(rng.sample(range(n), n // 5), reverse=True):
                copy[at : at + 1] = rng.choice([[f"e{rng.randrange(10**6)}"], [f"e{rng.randrange(10**6)}"], [], [copy[at], "i"]])
            texts += [base, copy]
    texts += ["a b c d e f g h i j".split(), "a b c d X f g h i j".split(), "q r s t u".split(), "q r s t u v".split()]
    out = {r.doc_id: r.group_id for r in om.near_documents(
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    links = [(i, j) for i in range(len(texts)) for j in range(i) if om.alike(" ".join(texts[i]), " ".join(texts[j]), 80)]
    found = sum(out[i] == out[j] for i, j in links)
    assert len(links) > 70 and found == len(links), (found, len(links))
    assert out[len(texts) - 3] == len(texts) - 4 and out[len(texts) - 1] == len(texts) - 2


def replaced(rng, words, share, even):
    """The words with a share of them replaced, evenly spread or by chance."""
    n = round(len(words) * share)
    at = {int((i + 0.5) * len(words) / n) for i in range(n)} if even else set(rng.sample(range(len(words)), n))
    return [f"x{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(words)]


@pytest.mark.parametrize("even", [False, True])
@pytest.mark.parametrize("share,least", [(0.15, 0.9), (0.18, 0.9), (0.199, 0.8)])
@pytest.mark.parametrize("n", [220, 400, 1000, 2000])
def test_long_texts_near_the_threshold_share_a_bucket(n, share, least, even):
    rng, worker, found = random.Random(n), om.Sketcher(om.Sketch()), 0
    for _ in range(60):
        words = [f"v{rng.randrange(20000)}" for _ in range(n)]
        a, b = " ".join(words), " ".join(replaced(rng, words, share, even))
        found += len(np.intersect1d(worker.keys(a), worker.keys(b))) > 0
    assert found >= least * 60, found


def block(key, cell, units):
    """A block of ``possible`` of units `name, component, many, start, keys`, all with the same ten words."""
    import pyarrow as pa

    bins = np.full(om.BINS, 10, np.uint8).tobytes()
    rows = [{"name": n, "component": c, "many": m, "start": s, "keys": k, "key": key, "cell": cell, "n": 2 if m else 1, "low": 10,
             "high": 10, "part": 0, "bins": bins, "full": False, "i": 0, "j": 0} for n, c, m, s, k in units]
    return pa.Table.from_pylist(rows)


def test_a_pair_is_given_in_the_first_bucket_it_shares():
    keys = {1: [-7, 4, 9], 2: [4, 9], 3: [-7, 9]}
    given = []
    for key in (-7, 4, 9):
        units = [(n, n, False, 10, k) for n, k in keys.items() if key in k]
        given += [(key, r["b"], r["a"]) for r in om.possible(block(key, 10, units), 80).to_pylist()]
    assert sorted(given) == [(-7, 1, 3), (4, 1, 2), (9, 2, 3)]


def test_units_meet_in_one_cell():
    """Units are in the cell before their first and in all up to their last; two meet in one of these."""
    for other in (9, 10, 11):
        units = [(1, 1, True, 10, None), (2, 2, True, other, None)]
        given = [cell for cell in range(max(10, other) - 1, 13) if om.possible(block(5, cell, units), 80).num_rows]
        assert given == [10 if other == 10 else max(10, other) - 1]


def test_a_meeting_of_groups_is_given_in_the_first_bucket_they_share():
    keys = {1: [-7, 4, 9], 2: [4, 9, 12], 3: [9, 12]}
    given = []
    for key in (-7, 4, 9, 12):
        units = [(n, n, n != 3, 10, k) for n, k in keys.items() if key in k]
        given += [(key, r["host"], r["guest"]) for r in om.possible(block(key, 10, units), 80).to_pylist()]
    assert sorted(given) == [(4, 1, 2), (9, 1, 3), (9, 2, 3)]


@pytest.mark.parametrize("seed", range(5))
def test_blocks_that_follow_each_other(seed):
    """Blocks of one part and of two, cut into batches anywhere, give what a plain loop over their pairs gives."""
    import pyarrow as pa

    rng, rows, expected = random.Random(seed), [], set()
    for key in range(6):
        for i, j in [(0, 0), (0, 1)]:
            part = []
            for _ in range(rng.choice([1, 2, 3, 30])):
                counts = np.bincount([rng.randrange(4) for _ in range(rng.randrange(8, 13))], minlength=om.BINS).astype(np.uint8)
                n, many = int(counts.sum()), rng.random() < 0.2
                part.append({
                    "name": rng.randrange(10**9), "component": rng.randrange(8), "many": many, "start": 10, "keys": [key], "key": key,
                    "cell": 10, "n": 2 if many else 1, "low": n - many, "high": n + many, "part": rng.choice([i, j]),
                    "bins": counts.tobytes(), "full": rng.random() < 0.1, "i": i, "j": j})
            part.sort(key=lambda r: r["part"])
            rows += part
            for at, x in enumerate(part):
                for y in part[at + 1 :]:
                    least = max(x["low"], y["low"]) - max(x["low"], y["low"]) * 20 // 100
                    shared = np.minimum(*[np.frombuffer(r["bins"], np.uint8).astype(int) for r in (x, y)]).sum()
                    room = any(r["many"] and r["full"] for r in (x, y))
                    if (i == j or x["part"] != y["part"]) and x["component"] != y["component"] and (
                            min(x["high"], y["high"]) >= least and (shared >= least or room)):
                        if x["many"] or y["many"]:
                            expected.add(("groups", *sorted((x["component"], y["component"]))))
                        else:
                            expected.add(("documents", *sorted((x["name"], y["name"]))))
    table = pa.Table.from_pylist(rows)
    for size in (1, 7, len(rows)):
        found = pa.Table.from_batches(om.possible_in_order(table.to_batches(max_chunksize=size), 80)).to_pylist()
        pairs = [("documents", r["b"], r["a"]) if r["host"] is None else ("groups", *sorted((r["host"], r["guest"]))) for r in found]
        assert set(pairs) == expected and expected


def test_pairs_of_few_texts_are_dealt_over_tasks(spark):
    texts = spark.createDataFrame([(i, f"a b c d e{i}") for i in range(60)], "id long, text string")
    pairs = spark.createDataFrame([(i, j) for i in range(60) for j in range(i)], "a long, b long").coalesce(1)
    assert om.verified(pairs, texts, 80).rdd.getNumPartitions() > 1


def test_few_links_are_written_in_few_files(spark):
    """However many shuffle partitions are set, some links don't become a file for each of them."""
    from newsflow.llm.components import components

    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        links = spark.createDataFrame([(i, i - i % 2 - 2 * (i % 2 == 0)) for i in range(1, 200)], "u long, v long")
        found = components(links, 199)
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert {r.component for r in found.collect()} == {0} and found.count() == 200
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
