import random
import re

import numpy as np
import pytest

from cardrisk.llm import lsh_forest as L
from cardrisk.llm import shingles
from cardrisk.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts, width):
    out = []
    for t in texts:
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(t or "")]
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def brute(rows, width, percent=80):
    """(n_shingles, component) per row from all pairs."""
    sets = brute_sets([t for _, t in rows], width)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            names[find(i)] = min(names.get(find(i), d), d)
    return [(d, len(s), names.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, groups=25, copies=8):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([5, 20, 60, 200]))]
        for _ in range(rnd.randrange(1, copies)):
            rate = rnd.choice([0, 0, 0.02, 0.05, 0.08])
            rows.append(" ".join(rnd.choice(vocab) if rnd.random() < rate else w for w in base))
    rnd.shuffle(rows)
    return rows


def result(spark, rows, width):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "'x' AS cls", "doc_id", "0L AS component_id")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in L.near_duplicates(spark, df, width).collect()), key=repr)


@pytest.mark.parametrize("seed,width", [(1, 2), (2, 5)])
def test_equals_all_pairs(spark, seed, width):
    rows = list(enumerate(corpus(seed)))
    assert result(spark, rows, width) == sorted(brute(rows, width), key=repr)


def test_small_regions_and_blocks_give_the_same(spark, monkeypatch):
    """Crowded regions go deeper and large groups into blocks; the result stays."""
    base = [f"v{i}" for i in range(150)]
    rnd = random.Random(9)
    rows = [" ".join(f"n{rnd.randrange(99)}" if rnd.random() < 0.03 else w for w in base) for _ in range(60)] + corpus(4, 6)
    rows = list(enumerate(rows))
    monkeypatch.setattr(L, "REGION", 8)
    monkeypatch.setattr(L, "BLOCK", 16)
    assert result(spark, rows, 2) == sorted(brute(rows, 2), key=repr)


def test_nulls_empties_ties_and_repeats(spark):
    long_ = " ".join(f"t{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "two"), (7, long_), (7, long_), (3, long_.upper()), (None, long_),
            (None, "only here"), (8, "one two"), (9, "x" * 20000)]
    assert result(spark, rows, 2) == sorted(brute(rows, 2), key=repr)
    assert result(spark, [(1, None)], 2) == [(1, 0, 1)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.near_duplicates(spark, empty, 2).count() == 0 and L.keep_one_of_each(spark, empty, 2).count() == 0


def test_word_hashes_follow_the_words():
    for t in ["", "a", " a  b\tc\x0bd\r\ne ", "É é A a", "\x1fx\x85 y\xa0z", "q" * 300 + " r"]:
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(t)]
        h = shingles.word_hashes(t).tolist()
        assert len(h) == len(words) and len(set(h)) == len(set(words))
    assert len(shingles.shingle_set("a b a b a", 2)) == 2


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(links, "u long, v long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}
    assert got == want
    assert components(spark, spark.createDataFrame([], "u long, v long")).count() == 0


def test_exact_forest_spans_links():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 10 ** 6, 50)).astype(np.uint64)
    sets = [base, base.copy(), base[:-3], np.arange(10, dtype=np.uint64) + np.uint64(2 * 10 ** 6)]
    keys = [b"a", b"b", b"c", b"d"]
    assert sorted(L.exact_forest(keys, sets, np.zeros(4, bool), 80)) == [(b"a", b"b"), (b"a", b"c")]
    assert L.exact_forest(keys, sets, np.array([False, False, False, True]), 80) == []


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """A star whose spokes are near the hub only, all in regions far beyond ``REGION``."""
    monkeypatch.setattr(L, "REGION", 8)
    rng = np.random.default_rng(3)
    hub = rng.integers(0, 256, 2 * L.N_HASHES).astype(np.uint8)
    sigs = [hub]
    for _ in range(200):
        s = hub.copy()
        other = rng.choice(L.N_HASHES, 38, replace=False)
        for half in (other, other + L.N_HASHES):
            s[half] += rng.integers(1, 256, 38).astype(np.uint8)
        sigs.append(s)
    x = np.array(sigs)
    keys = [x[:, [k + t * L.WIDTH for k in range(L.WIDTH)] + [k + t * L.WIDTH + L.N_HASHES for k in range(L.WIDTH)]]
            for t in range(L.TREES)]
    meets = np.any([(k == k[0]).all(1) for k in keys], axis=0)
    assert meets.sum() > 195 and max((k == k[0]).all(1).sum() for k in keys) > 4 * L.REGION
    df = spark.createDataFrame([(i.to_bytes(2, "big"), bytearray(s.tobytes())) for i, s in enumerate(sigs)], "cls binary, sig binary")
    links = [(int.from_bytes(r.u, "big"), int.from_bytes(r.v, "big")) for r in L.candidate_links(spark, df, 0.8).collect()]
    reached = {0}
    while more := {b for link in links for a, b in (link, link[::-1]) if a in reached} - reached:
        reached |= more
    assert set(np.flatnonzero(meets).tolist()) <= reached


def signatures_df(spark, sigs):
    rows = [(i.to_bytes(4, "big"), bytearray(s.tobytes())) for i, s in enumerate(sigs)]
    return spark.createDataFrame(rows, "cls binary, sig binary")


def changed(rng, sig, places):
    s = sig.copy()
    for half in (places, places + L.N_HASHES):
        s[half] += rng.integers(1, 256, len(places)).astype(np.uint8)
    return s


def components_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in links:
        root[find(u)] = find(v)
    return [find(i) for i in range(n)]


def test_a_crowded_prefix_of_unrelated_texts_falls_apart_and_keeps_its_pairs(spark, monkeypatch):
    """600 signatures share the minima of six trees; 60 pairs among them are at 0.8."""
    monkeypatch.setattr(L, "REGION", 16)
    monkeypatch.setattr(L, "CROWDED", 64)
    rng = np.random.default_rng(11)
    common = rng.integers(0, 256, 2 * L.N_HASHES).astype(np.uint8)
    crowd = np.concatenate([np.arange(L.WIDTH * t, L.WIDTH * t + L.WIDTH) for t in (0, 5, 10, 15, 20, 25)])
    sigs = []
    for i in range(600):
        s = rng.integers(0, 256, 2 * L.N_HASHES).astype(np.uint8)
        shared = np.r_[crowd, rng.choice(np.setdiff1d(np.arange(L.N_HASHES), crowd), 15, replace=False)]     # about 0.3 in all
        for half in (shared, shared + L.N_HASHES):
            s[half] = common[half]
        sigs.append(s)
    for i in range(60):            # 0.8 of all places agree, those of the crowded trees among them at random
        sigs.append(changed(rng, sigs[i], rng.choice(L.N_HASHES, L.N_HASHES // 5, replace=False)))
    df = signatures_df(spark, sigs)
    sizes, members = L.forest_regions(spark, df)
    n = [r.n for r in sizes.collect()]
    compared = sum(x * x / 2 for x in n)
    assert max(n) <= 64 and compared < 0.25 * 6 * 600 ** 2 / 2       # six whole regions would be all pairs six times
    assert members.join(sizes, "region").groupBy("region").count().join(sizes, "region").filter("count <> n").count() == 0
    links = [(int.from_bytes(r.u, "big"), int.from_bytes(r.v, "big")) for r in L.candidate_links(spark, df, 0.8).collect()]
    root = components_of(len(sigs), links)
    assert all(root[i] == root[600 + i] for i in range(60))


def test_the_miss_bound_holds_in_deepened_regions():
    """Pairs at 0.8: how many that share a tree's region share no part of it after one, two and three steps."""
    rng = np.random.default_rng(2)
    n = 4000
    agree = rng.random((n, L.N_HASHES)) < 0.8

    def meets(tree, path, rows, steps):
        """Which pairs stay together somewhere below this region."""
        if not steps:
            return rows
        out = np.zeros(n, bool)
        for r, places in enumerate(L.further_places(tree, path)):
            out |= meets(tree, f"{path}{r}", rows & agree[:, list(places)].all(1), steps - 1)
        return out
    for tree in (0, 17, 31):
        base = agree[:, list(L.used_places(tree, ""))].all(1)
        for steps, least in ((1, 0.977), (2, 0.96)):
            assert meets(tree, "", base, steps).sum() >= least * base.sum()
    assert (1 - 0.8 ** L.WIDTH * (1 - (1 - 0.8 ** L.WIDTH) ** L.MORE) ** L.STEPS) ** L.TREES < 1.5e-7


def test_regions_whose_members_are_alike_are_not_deepened(spark, monkeypatch):
    monkeypatch.setattr(L, "REGION", 16)
    monkeypatch.setattr(L, "CROWDED", 64)
    rng = np.random.default_rng(4)
    hub = rng.integers(0, 256, 2 * L.N_HASHES).astype(np.uint8)
    sigs = [changed(rng, hub, rng.choice(L.N_HASHES, 6, replace=False)) for _ in range(300)]
    df = signatures_df(spark, sigs)
    sizes, _ = L.forest_regions(spark, df)
    assert sizes.filter("n > 64").count() >= L.TREES // 2 and sizes.count() < 40 * L.TREES
    links = [(int.from_bytes(r.u, "big"), int.from_bytes(r.v, "big")) for r in L.candidate_links(spark, df, 0.8).collect()]
    assert len(set(components_of(300, links))) == 1


def test_neighbours_by_prefix_and_all_others_are_linked_in_a_region():
    rng = np.random.default_rng(6)
    bases = rng.integers(0, 256, (5, L.N_HASHES)).astype(np.uint8)
    low = np.array([np.where(rng.random(L.N_HASHES) < 0.1, rng.integers(0, 256, L.N_HASHES), bases[i % 5]) for i in range(80)]).astype(np.uint8)
    least = 75
    near = (low[:, None] == low[None]).sum(2) >= least
    for side in (np.zeros(80, bool), np.arange(80) % 3 == 0):
        ok = near & (side[:, None] != side[None]) if side.any() else near
        want = components_of(80, list(zip(*np.nonzero(ok))))
        got = L.likely_forest(list(range(80)), low, 7, least, side)
        assert len(got) < 200
        have = components_of(80, got)
        assert [[have[i] == have[j] for j in range(80)] for i in range(80)] == [[want[i] == want[j] for j in range(80)] for i in range(80)]
