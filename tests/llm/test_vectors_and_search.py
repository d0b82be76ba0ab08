"""Whitening, ranked search and SimHash groups against brute force, with the awkward rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm import ranked_search, simhash_tiles, whitening
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(300)]


def prose(seed, n=80):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


# --- whitening -------------------------------------------------------------------------


def brute_whitening(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, centred, values[::-1], axes[:, ::-1]


def test_components_equal_an_eigen_decomposition(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    kept = sorted((r["vec_id"], r["embedding"]) for r in rows.collect())
    x, n, sums, centred, values, axes = brute_whitening([v for _, v in kept])
    got = {(r["vec_id"], r["component"]): r for r in QUERIES["op11_embedding_whitening"](spark, SF).collect()}
    assert len(got) == len(kept) * 32
    want = centred @ axes[:, :32] / np.sqrt(values[:32])
    for c in range(32):
        column = np.array([got[i, c + 1]["whitened"] for i, _ in kept])
        sign = np.sign(column @ want[:, c])
        assert np.allclose(column, sign * want[:, c], atol=1e-7)
        assert got[kept[0][0], c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
    exact = ((n * x - sums) ** 2).sum(axis=1)
    assert [got[i, 1]["deviation"] for i, _ in kept] == exact.tolist()
    assert {r["n"] for r in got.values()} == {n}
    assert max(r["identity_error"] for r in got.values()) < 1e-9


SCHEMA = "vec_id long, embedding array<float>, n int, Component string"


def whitened(spark, vectors, schema=SCHEMA):
    rows = spark.createDataFrame([(i, v, 7, "x") for i, v in vectors], schema)
    return whitening.whiten(rows, whitening.fit_whitening(rows)).collect()


def test_unusable_vectors_dependent_dimensions_repeats(spark):
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(60, 5)).astype(np.float32)
    plain[:, 3] = 0.5  # does not vary
    plain[:, 4] = plain[:, 0]  # depends on another
    good = [(i, v.tolist()) for i, v in enumerate(plain)]
    good += [good[5], (None, good[6][1])]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [nan, 0.0, 0.0, 0.0, 0.0]),
           (103, [0.0, -inf, 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.0, 0.0])]
    got = whitened(spark, good + bad)
    assert {r["component"] for r in got} == {1, 2, 3}
    assert Counter(r["vec_id"] for r in got) == Counter([i for i, _ in good] * 3)
    *_, values, _ = brute_whitening([v for _, v in good])
    shares = sorted({round(r["explained"], 9) for r in got}, reverse=True)
    assert shares == [round(v / values.sum(), 9) for v in values[:3]]
    assert got[0]["identity_error"] < 1e-9
    twice = [sorted((r["component"], r["whitened"]) for r in got if r["vec_id"] == 5)]
    assert len(twice[0]) == 6 and twice[0][0] == twice[0][1]


def test_nearly_dependent_dimensions(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 1)) * 1e6
    vectors = np.concatenate([base, base + rng.normal(size=(400, 1)) / 16, rng.normal(size=(400, 1))], axis=1)
    got = whitened(spark, list(enumerate(vectors.tolist())), SCHEMA.replace("float", "double"))
    assert {r["component"] for r in got} == {1, 2, 3}
    assert got[0]["identity_error"] < 1e-4


def test_nothing_to_whiten(spark):
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert whitened(spark, [(1, None), (2, [])]) == []


def test_large_values_stay_exact(spark):
    vectors = [(0, [2.0**45, 1.0]), (1, [-(2.0**45), 3.0]), (2, [5.0, 2.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitened(spark, vectors, SCHEMA.replace("float", "double"))}
    assert got[0] is None and got[1] is None and got[2] is not None


# --- ranked search ---------------------------------------------------------------------


def brute_search(docs, items, k=10):
    split = lambda t: re.findall(ranked_search.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counted = [(i, Counter(split(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    total = sum(c.total() for _, c in counted)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for doc, c in counted:
            score = 0
            for term in set(split(text)) & set(c):
                df = sum(term in other for _, other in counted)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                m = 10 + 90 * c.total() * n_docs // total
                score += w * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(best, 1)]
    return sorted(out, key=str)


DOCS = "doc_id long, text string, rank int, Score string"
ITEMS = "item_id long, text string, query string"


def searched(spark, docs, items, **options):
    rows = ranked_search.search(
        spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, "y") for i in items], ITEMS),
        **options,
    )
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("block", [8192, 7])
def test_search_equals_scoring_every_document(spark, monkeypatch, block):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    rng = np.random.default_rng(1)
    vocabulary = [f"T{i}" for i in range(60)]
    shares = 1 / np.arange(1, 61)
    words = lambda n: " ".join(rng.choice(vocabulary, n, p=shares / shares.sum()))
    docs = [(i, words(rng.integers(1, 60))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .,! "), (None, words(20)), (203, "Ünder-scöre_T1 t1"), docs[3], docs[3],
             (300, docs[9][1]), (301, docs[9][1]), (204, words(12000))]
    items = [(i, words(rng.integers(1, 25))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "unknown words"), (53, "T0"), items[2], (2, "t5 T6 t6"), (None, "t9 ünder")]
    assert searched(spark, docs, items) == brute_search(docs, items)


def test_several_rounds_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "ROUND_BYTES", 300)
    docs = [(i, prose(i)) for i in range(30)]
    items = [(i, prose(100 + i, 12)) for i in range(12)]
    assert searched(spark, docs, items, k=3) == brute_search(docs, items, 3)


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a b")]) == []
    assert searched(spark, [(1, "a b")], []) == []
    assert searched(spark, [(1, None), (2, "...")], [(1, "a b")]) == []


def test_pairs_tighten_the_bounds():
    single = np.array([3, 4, 5, 6])
    assert ranked_search.combined_bounds(single, np.array([7, 9, 11])).tolist() == [0, 3, 7, 12, 18]
    # terms that never meet bring only the larger of the two
    assert ranked_search.combined_bounds(single, np.array([0, 0, 0])).tolist() == [0, 3, 4, 8, 10]


# --- SimHash ---------------------------------------------------------------------------


def brute_simhash(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_simhash(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    out = []
    for r, p, mine in zip(rows, prints, root):
        ids = [o[0] for o, x in zip(rows, root) if x == mine and o[0] is not None]
        out.append((r[0], f"{p:016x}", min(ids, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [2048, 4])
def test_simhash_groups_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash_tiles, "TILE", tile)
    rng, rows = np.random.default_rng(8), []
    for i in range(60):
        words = prose(9, 150).split()
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            words[at] = f"X{rng.integers(1000)}"
        rows.append((70 - i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "one"), (104, "ONE"), (105, "Two words"), (106, prose(2, 9000)),
             (107, "a b ÄÖ"), (108, "a b äÖ"), rows[3], (None, rows[4][1]), (None, prose(77))]
    rows += [(200 + i, prose(20 + i)) for i in range(40)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, Component_Id string")
    found = simhash_tiles.simhash_groups(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_groups(rows)


def test_near_fingerprints_across_tiles(spark):
    rng = np.random.default_rng(5)
    values = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for v in list(values)[:150]:
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            v ^= 1 << int(b)
        values.add(v)
    values = sorted(values)
    near = lambda a, b: (a ^ b).bit_count() <= 3
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(values) for b in values[:i] if near(a, b)}
    got = {tuple(sorted(r)) for r in simhash_tiles.simhash_links(prints).collect()}
    assert want and got <= {(a, b) for a in map(signed, values) for b in map(signed, values)}

    def parts(links):
        label = {signed(v): signed(v) for v in values}
        for _ in values:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert parts(got) == parts(want)


def test_simhash_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_tiles.simhash_groups(docs).collect() == []


def test_bit_counts():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    want = [sum(int(h) >> b & 1 for h in hashes) for b in range(64)]
    assert simhash_tiles._bit_counts(hashes).tolist() == want
