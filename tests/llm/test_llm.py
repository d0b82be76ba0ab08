"""The training-data operators against brute force, on small tables with the awkward rows."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from compare import check, duck
from tidemark.llm import (
    containment, language, licences, line_chunks, mixing, ngram_join, order_minhash, token_files,
    toxicity, warc,
)
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Shard int, words int"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n=120):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def rows():
    base = prose(1)
    near = base.replace(base.split()[60], "edited", 1)
    texts = [base, near, base, None, "", " \n ", "one", prose(2), prose(3, 9000), base + " tail"]
    out = [(i, t, "en", f"s{i % 3}" if i != 7 else None, 0, i, i) for i, t in enumerate(texts)]
    return [*out, out[7], (None, prose(2), None, "s0", 0, 1, 1), (5, "Two words.", "en", "s1", 0, 2, 2)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_components(rows, k, percent):
    sets = defaultdict(set)
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        if i is not None:
            sets[i, t] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    keys = sorted(sets, key=str)
    label = {x: x[0] for x in keys}
    for _ in keys:
        for x in keys:
            for y in keys:
                both = len(sets[x] & sets[y])
                if both and 100 * both >= percent * len(sets[x] | sets[y]):
                    label[x] = label[y] = min(label[x], label[y])
    return sorted((x[0], len(sets[x]), label[x]) for x in keys)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs, rows, k, percent):
    found = ngram_join.ngram_jaccard_components(docs, k=k, percent=percent)
    got = {tuple(r)[:2] + (r["component_id"],) for r in found.collect() if r[0] is not None}
    assert sorted(got) == sorted(set(brute_components(rows, k, percent)))


def test_a_group_of_near_copies(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        words = prose(9, 150).split()
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            words[at] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    found = ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r[0], r[1], r["component_id"]) for r in found.collect())
    assert got == brute_components(rows, 3, 90)


def brute_links(rows, k, percent):
    first = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        if i is not None and w:
            grams = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1)))
            first[grams] = min(i, first.get(grams, i))
    return {
        tuple(sorted((first[x], first[y])))
        for x, y in itertools.combinations(first, 2)
        if x & y and 100 * len(x & y) >= percent * len(x | y)
    }


@pytest.mark.parametrize(("percent", "block"), [(90, 1024), (40, 16)])
def test_the_join_gives_every_link(spark, rows, monkeypatch, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng, own = np.random.default_rng(4), [(r[0], r[1]) for r in rows if r[0] not in (5, 7)]
    for i in range(100, 160):
        words = prose(9, 150).split()
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            words[at] = f"x{rng.integers(1000)}"
        own.append((i, " ".join(words)))
    # long texts, and their first thirds
    own += [(200 + i, prose(9, 150 if i else 60) + f" t{i}") for i in range(2)]
    docs = spark.createDataFrame(own, "doc_id long, text string")
    want = brute_links(own, 3, percent)
    found = ngram_join.ngram_jaccard_links(docs, percent=percent).collect()
    assert len(found) == len(want) and set(map(tuple, found)) == want
    joined = ngram_join.ngram_jaccard_join(docs, percent=percent).collect()
    for r in joined:
        assert r["n_links"] == sum(r["class_id"] in pair for pair in want) or r["doc_id"] is None
    got = sorted({(r[0], r[1], r["component_id"]) for r in joined if r[0] is not None})
    assert got == sorted(set(brute_components(own, 3, percent)))


def test_candidates_meet_at_their_first_shared_n_gram(spark):
    # n-gram 1 may be the first that sets of 100 share, n-gram 2 stands too late in both
    rows = [(1, 7, 100, 4, 0), (1, 8, 100, 5, -1), (2, 8, 100, 9, 3), (2, 9, 100, 9, 4)]
    # 6 and 5 share the n-gram before 4 as well, and the one before that n-gram is not shared
    rows += [(3, 5, 100, 0, None), (3, 6, 100, 0, None), (4, 5, 100, 1, 3), (4, 6, 100, 1, 3)]
    posts = spark.createDataFrame(rows, "gram long, node long, n long, pos int, prev long")
    again = ngram_join._all_pairs(posts.where("gram = 4"), 90)
    assert again.count() == 0
    posts = posts.where("gram < 3")
    assert [(r["a"], r["b"]) for r in ngram_join._all_pairs(posts, 90).collect()] == [(7, 8)]


@pytest.mark.parametrize("keys", [200, 1 << 18])
def test_near_copies_move_to_buckets_and_not_to_pairs(spark, monkeypatch, keys):
    monkeypatch.setattr(ngram_join, "BLOCK_KEYS", keys)
    own = []
    for i in range(40):
        words = prose(9, 150).split()
        words[3 * i] = f"x{i % 9}"
        own += [(i, " ".join(words))] * (1 + i % 2)
    nodes = range(-20, 20)
    pairs = [(a, b, 148, 148) for a, b in itertools.combinations(nodes, 2)]
    pairs = spark.createDataFrame(pairs, "a long, b long, a_n long, b_n long")
    dealt, copies = ngram_join._dealt(pairs, 0)
    assert dealt.select("a", "b").distinct().count() == dealt.count() == 40 * 39 // 2
    # before, all n-grams of one end moved with each of the 780 pairs; blocks of one class are the worst case
    assert copies.count() <= (40 if keys > 200 else 2 * 780)
    docs = spark.createDataFrame(own, "doc_id long, text string")
    found = ngram_join.ngram_jaccard_links(docs).collect()
    want = brute_links(own, 3, 90)
    assert len(want) > 700 and len(found) == len(want) and set(map(tuple, found)) == want
    # the search for components is handed a row for each class and bucket, and not every link
    staged, stage = {}, ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    ngram_join.ngram_jaccard_join(docs).collect()
    assert staged["ngram-fragments-0"].count() <= (40 if keys > 200 else 2 * 780)


def test_empty_tables(spark, none):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert ngram_join.ngram_jaccard_components(none).count() == 0
    assert order_minhash.edited_fingerprints(none).count() == 0
    assert line_chunks.remove_repeated_chunks(none).count() == 0
    assert containment.leaking_documents(none, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert licences.scan_licenses(none, licences.known_digests(spark)).count() == 0
    assert mixing.taken_words(mixing.mix_sources(none)).count() == 0
    assert toxicity.score_toxicity(none, toxicity.fit_toxicity(none, labels)).count() == 0
    model = language.fit_languages(none)
    assert language.identify_languages(language.page_records(pages), model, True).count() == 0


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for values in ([], [0], [7, 7, 7], sorted(rng.integers(0, 10**9, 3000).tolist()), [2**63 + 1]):
        ef = token_files.EliasFano(token_files.EliasFano.encode(np.array(values, np.uint64)))
        assert ef.values().tolist() == values
        assert [ef.select(i) for i in range(len(values))] == values


def test_pieces_encode_as_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = token_files.Encoder(open(path).read(), "<u2")
    whole = Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    parts = ["a", "b'll", " ", " ", "\n", "\t", "é", "1", "　", "\x1c", "!", "中", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 20))) for _ in range(2000)]
    for text, ids in zip(texts, own.ids(texts)):
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u2").tolist() == want


def test_encoder_bounds_its_memory_by_bytes(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(token_files, "CACHE_BYTES", 20_000)
    monkeypatch.setattr(token_files, "LONG_PIECE", 12)
    whole, own = Tokenizer.from_file(path), token_files.Encoder(open(path).read(), "<u2")
    texts = [prose(i, 60) + " " + "語" * (i % 40) + " " + prose(i % 7, 5) for i in range(300)]
    for at in range(0, 300, 10):
        want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts[at : at + 10]]
        assert own.ids(texts[at : at + 10]) == want
        for held in (own._young, own._old):
            assert sum(token_files.ENTRY_BYTES + 4 * len(p) for p in held) < 20_000 + 10 * 70 * 300
            assert all(len(p) <= 12 for p in held)
    assert own._old


def test_the_memory_of_pieces_is_given_by_the_caller(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    small, large = (token_files.Encoder(open(path).read(), "<u2", size) for size in (20_000, 40_000_000))
    whole, texts = Tokenizer.from_file(path), [prose(i, 60) + f" x{i}" * 90 for i in range(60)]
    for text in texts:
        want = np.array(whole.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        assert small.ids([text]) == large.ids([text]) == [want]
    assert small._old and not large._old
    # stages before it leave memory in the workers of the pipeline
    given = {}
    monkeypatch.setattr(token_files, "write_token_files", lambda *a, **options: given.update(options))
    monkeypatch.setattr(token_files, "read_token_documents", lambda *a: None)
    corpus_pipeline.write_tokens(spark, docs, SF)
    assert given["cache_bytes"] < token_files.CACHE_BYTES


def test_languages_are_scored_on_few_texts_at_a_time(spark, monkeypatch):
    """Whole texts are held by Spark and by the worker, a batch each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stage = spark.conf.get(key), {}, language.stage

    def watched(df, name):
        seen[name] = int(spark.conf.get(key))
        return stage(df, name)

    monkeypatch.setattr(language, "stage", watched)
    labelled = [("the cat and the dog", "en"), ("le chat et le chien", "fr")]
    model = language.fit_languages(spark.createDataFrame(labelled, "text string, lang string"))
    own = spark.createDataFrame([(1, "the dog", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert language.identify_languages(language.document_records(own), model, html=False).count() == 2
    assert seen["language-text"] <= 1024 and spark.conf.get(key) == before


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def __getattr__(self, name):
        def call(texts, **options):
            self.texts += len(texts)
            return getattr(self.tokenizer, name)(texts, **options)

        return call


def test_new_pieces_are_encoded_together():
    """One call of the tokenizer for many pieces; pieces whose ends are in doubt are encoded alone."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, whole = token_files.Encoder(open(path).read(), "<u2"), Tokenizer.from_file(path)
    text = " ".join(f"{w}{i}" for i, w in enumerate(WORDS)) + " \u0120 a\u0120b x<|endoftext|>y é\n語"
    want = np.array(whole.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
    own._tokenizer = counted = Counted(own._tokenizer)
    assert own.ids([text]) == [want]
    assert counted.texts < 20
    other = token_files.Encoder(open(path).read(), "<u2")
    other._spaced[:] = False
    assert other.ids([text]) == [want]


class Asked(dict):
    """A memory that counts how often it is asked."""

    times = 0

    def __getitem__(self, key):
        self.times += 1
        return super().__getitem__(key)

    def get(self, key, default=None):
        self.times += 1
        return super().get(key, default)


def test_a_repeated_piece_is_looked_up_once_for_many_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, whole = token_files.Encoder(open(path).read(), "<u2"), Tokenizer.from_file(path)
    own._young = asked = Asked()
    texts = ["sea of sand " * 300 + "end", "", "sand  of the\nsea " * 200, "sea"]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert own.ids(texts) == want
    assert asked.times < 50


def test_the_encoder_is_handed_small_batches(spark, tmp_path, monkeypatch):
    path, out = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "batches")

    def writer(definition, dtype, end_id, arrow):
        def write(batches):
            for seq, batch in enumerate(batches):
                none = dict.fromkeys(arrow.names)
                yield token_files.pa.RecordBatch.from_pylist([{**none, "seq": seq, "n_docs": batch.num_rows}], arrow)

        return write

    monkeypatch.setattr(token_files, "_writer", writer)
    rows = spark.range(3000).selectExpr("1L as doc_id", "'a b' as text").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    token_files.write_token_files(rows, out, path)
    sizes = [r["n_docs"] for r in spark.read.parquet(out).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 512
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_idle_workers_forget_their_encoder(spark, docs, tmp_path, monkeypatch):
    from tidemark.llm import common

    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(docs, str(tmp_path / "idle"), path)

    def held(batches):
        import sys
        import time

        time.sleep(token_files.IDLE_SECONDS + 1)
        count = len(sys.__dict__.get("_tidemark_encoders", {}))
        for batch in batches:
            yield common.pa.RecordBatch.from_pydict({"n": [count]})

    rows = spark.range(8).repartition(8).mapInArrow(held, "n long").collect()
    assert {r["n"] for r in rows} == {0}


def test_token_files_round_trip(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    path, out = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "t")
    token_files.write_token_files(docs, out, path)
    whole, start, want = Tokenizer.from_file(path), 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for i, text, *_ in order:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.read_token_documents(spark, out).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_fingerprints(docs):
    got = order_minhash.edited_fingerprints(docs).collect()
    prints = {r["doc_id"]: r for r in got if r["doc_id"] not in (5, 7)}
    assert prints[0]["fingerprint"] == prints[2]["fingerprint"] != prints[1]["fingerprint"]
    assert prints[0]["near_next"] > 0.7 and prints[3]["fingerprint"] == ""
    assert prints[3]["near_next"] == 1.0 and prints[6]["near_next"] == 0.0
    text = {0: prose(1)}[0]
    half = len(text) // 2
    near = text.replace(text.split()[60], "edited", 1)
    edited = text[: len(text) - half] + near[:half]
    assert prints[0]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_order_matters(spark):
    words = prose(5, 300).split()
    rows = [(1, " ".join(words)), (2, " ".join(words[150:] + words[:150])), (3, prose(6, 300))]
    got = order_minhash.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    near = {r["doc_id"]: r["near_next"] for r in got.collect()}
    assert 0.05 < near[1] < 0.9 and near[2] < 0.05


def test_repeated_chunks_go_and_the_rest_stays(spark):
    passage = " ".join(f"{prose(100 + i, 9)}." for i in range(40))
    texts = [f"{prose(200 + i, 30)}.\n{passage} {prose(300 + i, 30)}." for i in range(6)]
    rows = [*enumerate(texts), (6, None), (7, ""), (8, "Short one. Short two.")]
    out = line_chunks.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["text"] == texts[0] and got[6]["text"] is None and got[7]["text"] == ""
    assert got[8]["removed_lines"] == 0
    for i in range(1, 6):
        # the last line of the passage goes on in the line after it
        assert got[i]["removed_chars"] >= len(passage) - 2 * 9 * 5
        assert len(got[i]["text"]) == len(texts[i]) - got[i]["removed_chars"]
        assert prose(200 + i, 30) in got[i]["text"] and prose(300 + i, 30) in got[i]["text"]


def brute_without_chunks(rows):
    """Boundaries by the smaller of two neighbouring hashes, each laid over its first copy line by line."""

    def signed(data, seed=42):
        return (xxhash.xxh64_intdigest(data, seed) ^ (1 << 63)) - (1 << 63)

    def rolled(a, b):
        first = xxhash.xxh64_intdigest(signed(a.encode()).to_bytes(8, "little", signed=True), 42)
        return signed(signed(b.encode()).to_bytes(8, "little", signed=True), first)

    texts, first, out = {}, {}, {}
    for i, text in sorted(r for r in rows if r[1] is not None):
        lines = texts[i] = re.split(r"(?<=\n)|(?<=[.!?] )", text)
        hashes = [rolled(*pair) for pair in zip(lines, lines[1:])]
        gone = set()
        for at, own in enumerate(hashes):
            beside = [hashes[j] for j in (at - 1, at + 1) if 0 <= j < len(hashes)]
            if beside and all(own > x for x in beside):
                continue
            kept, place = first.setdefault(own, (i, at))
            for j in range(-1, 3) if (kept, place) != (i, at) else ():
                mine, theirs = (x[n] if 0 <= n < len(x) else None for x, n in ((lines, at + j), (texts[kept], place + j)))
                if mine is not None and mine == theirs:
                    gone.add(at + j)
        for at in sorted(gone):
            if at - 1 not in gone:
                run = list(itertools.takewhile(gone.__contains__, itertools.count(at)))
                if len(run) < 2 or sum(len(lines[j]) for j in run) < 40:
                    gone -= set(run)
        out[i] = ("".join(x for j, x in enumerate(lines) if j not in gone), len(gone))
    return out


def test_short_repeated_passages_go_whole(spark):
    rng, rows = np.random.default_rng(8), []
    for p in range(60):
        passage = " ".join(f"{prose(4000 + 10 * p + j, 14)}." for j in range(2 + p % 5))
        for copy in range(2):
            head, tail = (f"{prose(int(rng.integers(10**6)), 20)}." for _ in range(2))
            rows.append((2 * p + copy, f"{head} {passage} {tail}"))
    rows += [(200, "Hi. Yo. " + rows[0][1]), (201, "Hi. Yo. "), (202, "Same old line here.\n" * 9), (203, None)]
    long = " ".join(f"{prose(9000 + j, 12)}." for j in range(300))
    rows += [(204, long), (205, "Another start. " * 40 + long), (206, ""), (207, long[: len(long) // 2])]
    out = line_chunks.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in out.collect() if r["doc_id"] != 203}
    assert got == brute_without_chunks(rows)
    for p in range(60):
        # two lines are one window, which need not be a boundary
        assert got[2 * p + 1][1] == 2 + p % 5 or p % 5 == 0
        assert got[2 * p][1] == 0


def test_repeated_rows_null_ids_and_clashing_columns_of_chunks(spark):
    passage = " ".join(f"{prose(700 + j, 12)}." for j in range(6))
    rows = [(None, passage, 1, "a", 5), (1, "Head. " + passage, 2, "b", 6), (1, "Head. " + passage, 3, "b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, r_id int, Chunk_Key string, removed_lines int")
    out = line_chunks.remove_repeated_chunks(docs)
    assert out.columns == [*docs.columns, "_removed_lines", "removed_chars"]
    got = sorted(map(tuple, out.collect()), key=lambda r: r[2])
    assert got == [(*rows[0], 0, 0), *((1, "Head. ", *r[2:], 6, len(passage)) for r in rows[1:])]


def test_whole_licences_are_found(spark):
    head = {
        "MIT": "The MIT License (MIT)", "BSD-2-Clause": "BSD 2-Clause License", "Unlicense": "",
        "BSD-3-Clause": "BSD 3-Clause License", "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003",
        "ISC": "ISC License", "Zlib": "The zlib License",
    }
    texts = {**licences.TEXTS, **licences.MORE_TEXTS}
    names = sorted(texts)
    rows = [(i, f"{head[n]}\n\nCopyright (c) 2020, A. Author\n\n{texts[n]}\n") for i, n in enumerate(names)]
    rows += [(50, "Terms of my own,\nin two lines"), (51, texts["BSL-1.0"] + " And more.")]
    more = spark.createDataFrame([("LicenseRef-own", "Terms of MY own, in two lines.")], "license string, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licences.scan_licenses(docs, licences.known_digests(spark, more)).collect()
    want = {**dict(enumerate(names)), 50: "LicenseRef-own", 51: None}
    assert {r["doc_id"]: r["license"] for r in found} == want


def test_warc_round_trip(spark, tmp_path):
    big = "<html>" + "é" * 200 + "\r\n\r\nWARC/1.1\r\n</html>"
    rows = [(3, "http://a/\r\nx", big), (1, None, big), (2, "u", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", big + "!"), (9, "u", big)]
    out = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), out)
    got = {r["page_id"]: r for r in warc.read_warc(spark, out).collect()}
    assert {i: r["refers_to"] for i, r in got.items()} == {1: None, 2: None, 3: 1, 4: None, 5: None, 6: None, 9: 1}
    for i, _, html in rows:
        data = (html or "").encode()
        assert got[i]["payload_bytes"] == len(data) and got[i]["intact"]
        assert got[i]["payload_digest"] == hashlib.sha256(data).hexdigest()


def test_archives_of_large_records_hold_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 200_000)
    monkeypatch.setattr(warc, "BATCH_RECORDS", 3)
    rows = [(i, f"http://h/{i}", f"<html>{i} " + "long page " * 5000, "x") for i in range(20)]
    rows += [(None, None, "n" * 200, "x"), (7, "http://h/7", rows[7][2], "x")]
    out = str(tmp_path / "w")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").coalesce(1)
    warc.write_warc(pages, out)
    assert len(list((tmp_path / "w").glob("*.gz"))) >= 5
    got = warc.read_warc(spark, out).collect()
    assert len(got) == 22 and all(r["intact"] and r["record_type"] == "response" for r in got)
    warc.write_warc(pages.limit(0), out + "0")
    assert warc.read_warc(spark, out + "0").count() == 0


def test_mix_meets_targets(spark, docs):
    got = mixing.taken_words(mixing.mix_sources(docs, block=16)).collect()
    again = mixing.taken_words(mixing.mix_sources(docs, block=16)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(t - n) <= 1 for (_, t), n in taken.items())


def reshared(sizes):
    """Targets by the words of the rule: cap what is above its limit, share the excess anew, until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (budget - sum(out.values())) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in above}
        free -= above
    return out


def test_targets_equal_a_resharing_loop(spark):
    """Ties of size to weight, zero sizes, the null source, one source."""
    rng = np.random.default_rng(7)
    tables = [{"a": 5000, "b": 10, None: 1000}, {"a": 0, "b": 0}, {"a": 7}, {None: 3}, {"a": 50, "b": 20, "c": 10}]
    for _ in range(12):
        names = [f"s{i}" for i in range(rng.integers(1, 8))] + [None]
        tables.append({s: int(rng.choice([0, 1, 2, 5, 10, 20, 50, 1000])) for s in names})
    for sizes in tables:
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
        assert got == pytest.approx(reshared(sizes)), sizes


def test_a_mix_of_tied_sources(spark):
    """Fifty, one and ten documents of three sources, and two that tie."""
    rows = [(i, prose(i, 20), s) for i, s in enumerate(["a"] * 50 + ["b"] + ["c"] * 10 + ["d"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.taken_words(mixing.mix_sources(docs, block=16)).collect()
    want = reshared({"a": 1000, "b": 20, "c": 200, "d": 100})
    source = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in found:
        assert r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]])
    assert all(abs(taken[s] - want[s]) <= max(32, 0.15 * want[s]) for s in want), (dict(taken), want)


def test_index_permutation():
    for n in (1, 2, 5, 64, 1000):
        p = mixing.IndexPermutation(n, 7)
        assert sorted(p(np.arange(n))) == list(range(n))
        assert p.inverse(p(np.arange(n))).tolist() == list(range(n))


def test_maximal_segments_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        hits = sorted(rng.choice(40, rng.integers(1, 12), replace=False).tolist())
        gains = rng.uniform(0.1, 2, len(hits)).tolist()
        score = np.full(40, -0.4)
        score[hits] = gains

        def best(a, b):
            spans = [(score[i:j].sum(), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
            top = max(spans, default=(0,))
            if top[0] <= 1e-12:
                return []
            _, _, i, j = top
            return best(a, i) + [(i, j)] + best(j, b)

        assert [s[:2] for s in toxicity.maximal_segments(hits, gains, 0.4)] == best(0, 40)


def test_toxicity_fits_each_labelled_id_once(spark, monkeypatch):
    fitted, fit = [], toxicity._fit_logistic
    monkeypatch.setattr(toxicity, "_fit_logistic", lambda x, y: fitted.append(len(x)) or fit(x, y))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, prose(i, 20) + (" slur" if i % 2 else "")) for i in range(60)]
    again = [(ids[0], prose(900 + j, 30)) for j in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    for docs in (rows, rows + again):
        toxicity.fit_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    assert fitted == [len(ids)] * 2


def test_toxicity_learns_and_leaves_clean_rows(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(1000 + i, 80).split(), i % 6 == 0
        for at in rng.integers(0, 80, 5 if toxic else 0):
            words[at] = f"slur{rng.integers(4)}"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (9000, None)], "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    wrong = sum(got[i]["predicted"] != t for i, _, t in labels)
    assert wrong <= 6 and got[9000]["predicted"] == 0
    assert got[5]["held_out"] == (zlib.crc32(b"5") % 3 == 1)


def test_language_cues_decide_without_text(spark):
    docs = spark.createDataFrame(
        [(f"das ist ein Haus {i}", "de") for i in range(30)] + [(f"the house is big {i}", "en") for i in range(30)],
        "text string, lang string",
    )
    pages = [(i, f"https://a.example.de/{i}", '<html lang="de"><p>das ist ein Haus</p></html>') for i in range(20)]
    pages += [(100 + i, f"https://b.example.com/{i}", "<html><p>the house is big</p></html>") for i in range(20)]
    pages += [(200, "https://a.example.de/x", '<html lang="de">'), (201, None, None), (None, "?", "")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = language.identify_languages(language.page_records(rows), language.fit_languages(docs), True)
    got = {r["page_id"]: r["lang"] for r in found.collect()}
    assert len(got) == 43 and got[200] == "de" and got[0] == "de" and got[100] == "en"


def brute_languages(model, rows):
    """(lang, probability, text_lang) of (text, declared, suffix, host, domain) rows, one at a time."""
    cells, n = language._Cells(), len(model.languages)
    logs, posts = [], []
    for text, *_ in rows:
        own = cells.of(text or "")
        mean = model.logs[:, own].mean(axis=1, dtype=float) * min(len(own), 40) if len(own) else np.zeros(n)
        logs.append(mean - mean.max())
        posts.append(np.exp(logs[-1]) / np.exp(logs[-1]).sum())
    share = (np.sum(posts, axis=0) + 1) / (len(rows) + n)

    def smoothed(at, columns, weight, towards):
        key = [rows[at][c] for c in columns]
        if None in key:
            return None
        others = [posts[i] for i, r in enumerate(rows) if i != at and [r[c] for c in columns] == key]
        return (np.sum(others, axis=0) + weight * towards) / (len(others) + weight)

    for i in range(len(rows)):
        domain = smoothed(i, [4], 20, share)
        domain = share if domain is None else domain
        host = smoothed(i, [3, 4], 5, domain)
        total = logs[i] + np.log(domain if host is None else host)
        for cue in (1, 2):
            given = smoothed(i, [cue], 2, share)
            total += 0 if given is None else np.log(given / share)
        p = np.exp(total - total.max())
        yield model.languages[p.argmax()], p.max() / p.sum(), model.languages[posts[i].argmax()]


def test_every_language_is_kept_and_fused_as_by_hand(spark):
    rng, names = np.random.default_rng(5), [f"l{i:02d}" for i in range(70)]

    def words(i, n):
        return " ".join(f"word{i}x{j}" for j in rng.integers(0, 30, n))

    labelled = [(words(i % 70, 20), names[i % 70]) for i in range(280)] + [(None, "l00"), ("stray", None)]
    model = language.fit_languages(spark.createDataFrame(labelled, "text string, lang string"))
    assert model.languages == tuple(names)
    rows = [(words(i % 70, 6), names[i % 70], f"s{i % 3}", f"h{i % 9}.a{i % 3}", f"a{i % 3}") for i in range(140)]
    rows += [(None, None, None, None, None), ("", None, "s1", "h1.a1", "a1"), (None, "l03", None, None, None)]
    rows += [rows[5]] * 3 + [(words(69, 3000), None, None, "h0.a0", "a0")]
    given = [(*r, i, -i, f"e{i}") for i, r in enumerate(rows)]
    records = spark.createDataFrame(
        given, "text string, declared string, suffix string, host string, domain string, salt int, post int, Lang string"
    )
    found = language.identify_languages(records, model, html=False)
    assert found.columns == [*records.columns[1:], "_lang", "probability", "text_lang"]
    got = {r["salt"]: r for r in found.collect()}
    assert len(got) == len(rows) and {r["text_lang"] for r in got.values()} == set(names)
    for i, (lang, probability, text_lang) in enumerate(brute_languages(model, rows)):
        r = got[i]
        assert (r["post"], r["Lang"], r["host"]) == (-i, f"e{i}", rows[i][3])
        assert r["probability"] == pytest.approx(probability, rel=1e-4)
        if rows[i][0]:
            assert (r["_lang"], r["text_lang"]) == (lang, text_lang)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duck("/root/testdata/sf0.01")
    assert check(QUERIES[name](spark, "/root/testdata/sf0.01"), con, ORACLES[name]) > 0
    con.close()


def near_duplicates(rows):
    """Which (id, text) rows the second stage keeps: the smallest id of each group of linked texts."""
    keys = sorted({(i, t) for i, t, *_ in rows if i is not None}, key=str)
    sets = {}
    for i, t in keys:
        w = (t or "").encode().lower().split()
        sets[i, t] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    similar = lambda p, q: p & q and 100 * len(p & q) >= 80 * len(p | q)
    links = [(x, y) for x, y in itertools.combinations(keys, 2) if similar(sets[x], sets[y])]
    label = {x: x[0] for x in keys}
    for _ in keys:
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    return {x for x in keys if label[x] == x[0]} | {(i, t) for i, t, *_ in rows if i is None}


def test_near_duplicates_go_by_text_where_ids_repeat(spark, none):
    a, b = prose(31), prose(32)
    rows = [(3, a), (5, a + " tail"), (5, b), (6, b + " tail"), (5, b), (None, a), (7, None), (8, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, 3) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(got, key=str) == sorted(near_duplicates(rows), key=str)
    assert {i for i, _ in got if i} == {3, 5, 7, 8, 9} and len(got) == 6
    assert corpus_pipeline.drop_near_duplicates(spark, none, SF).collect() == []


def brute_leaks(rows, items):
    """Ids of documents that hold every five-word shingle of an item (the whole item if it is shorter)."""
    split = lambda t: (t or "").encode().lower().split()
    grams = lambda w: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    wanted = [grams(split(t)) for t in items if split(t)]
    return {i for i, t in rows if any(g <= grams(split(t)) for g in wanted if len(next(iter(g))) == 5)}


def test_near_duplicates_move_whole_texts_once(spark, tmp_path):
    rows = [(i, prose(i, 40), "en") for i in range(30)] + [(3, prose(3, 40), "fr"), (None, "a b", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/d")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/d"), "")
        plan = found._jdf.queryExecution().executedPlan().toString()
        # before, a second exchange moved all that is kept again, by id and text
        assert "hashpartitioning(doc_id, text," not in re.sub(r"#\d+L?", "", plan)
        assert found.count() == 31
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pipeline_equals_its_stages_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, kept = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, SF)
        assert out.columns == columns
        rows = out.collect()
        before = docs
        docs = spark.createDataFrame(rows, out.schema)
        kept.append([(r["doc_id"], r["text"]) for r in rows])
        if number == 1:
            given = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert sorted(kept[1]) == sorted(near_duplicates(given))
        if number == 2:
            leaks = brute_leaks(kept[1], items)
            assert leaks <= {i for i, _ in kept[1]} - {i for i, _ in kept[2]}
    assert len(kept[0]) > len(kept[1]) >= len(kept[2]) > 0
    # each word of the mix is a word of a document that was left
    whole = {i: t.split() for i, t in kept[2]}
    assert {i for i, _ in kept[3]} <= set(whole)
    assert all(set(t.split()) <= set(whole[i]) for i, t in kept[3])
    words = sum(map(len, whole.values()))
    assert abs(sum(len(t.split()) for _, t in kept[3]) - 1.5 * words) < 0.1 * words
    tokens = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in tokens) == sorted(i for i, _ in kept[3])


def test_fragments_are_handed_on_in_small_batches(monkeypatch):
    """A task holds ``KEYS_HELD`` n-grams and one text, whatever its rows hold together."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "KEYS_HELD", 500)
    batch = pa.RecordBatch.from_pydict({"id": list(range(40)), "text": [prose(i, 100) for i in range(40)]})
    classes = bytes(1 << ngram_join.TABLE_BITS)
    found = list(ngram_join._fragment_writer(3, classes)(iter([batch])))
    sizes = [sum(map(len, b.column(2).to_pylist())) for b in found]
    assert max(sizes) <= 500 + 100 and sum(sizes) >= 40 * 95
    counts = ngram_join._counter(3)(iter([batch]))
    monkeypatch.setattr(ngram_join, "KEYS_HELD", 1 << 30)
    assert (counts == ngram_join._counter(3)(iter([batch]))).all() and counts.sum() == 40 * 98


def test_whole_texts_are_handed_over_in_small_batches(spark, docs, monkeypatch):
    from tidemark.llm import common

    key, taken = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    stage = ngram_join.stage

    def noted(df, name):
        taken[name] = int(spark.conf.get(key))
        return stage(df, name)

    def large(batches):
        # 64 counters: rows, then batches beyond the bound
        sizes = [b.num_rows for b in batches]
        return np.array([sum(sizes), sum(n > 1024 for n in sizes)] + [0] * 62, np.int64)

    before = spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "stage", noted)
    ngram_join.ngram_jaccard_join(docs).collect()
    assert taken["ngram-sets"] <= 1024 and taken["ngram-fragments-0"] <= 1024
    counts = common.count_table(spark.range(5000).coalesce(1), large, 64)
    assert counts[0] == 5000 and counts[1] == 0
    assert spark.conf.get(key) == before
