"""Periodic runs, token counts and ranked search against brute force and the tokenizer library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lumenlake.llm import runs, search, tokens
from lumenlake.llm.common import written
from lumenlake.llm.queries import QUERIES, planted_runs, tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = [
    (0, None), (1, ""), (2, " \t\n"), (3, "word " * 30), (4, "A a\x0ba  a"), (4, "A a\x0ba  a"), (None, "no id " * 20),
    (5, "ünï 字 " * 12), (6, "x" * 5000), (7, "lamp " * 20_000), (8, "<|endoftext|>" * 40), (9, "a-b a_b 12 '12's"),
]


def _odd(spark):
    rows = [(*r, "x", "y", "z", 1) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, runs string, n string, n_tokens int")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs -----------------------------------------------------------


def _words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def _brute_runs(words, least_length=24, least_periods=3):
    """Every period tried at every place; a period that another one divides spans the same stretch."""
    found = {}
    for q in range(1, len(words) // least_periods + 1):
        same = np.array([a == b for a, b in zip(words, words[q:])], dtype=bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same, [0]])))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + q
            if length >= max(least_length, least_periods * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize(("least_length", "least_periods"), [(24, 3), (6, 3), (10, 4)])
def test_runs_equal_brute_force(least_length, least_periods):
    rng = random.Random(least_length)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.choice([0, 1, 5, 23, 24, 25, 60, 200]))]
            for _ in range(rng.randint(0, 3) if words else 0):
                a, p, size = rng.randrange(len(words)), rng.randint(1, 12), rng.randint(0, 100)
                for i in range(a, min(len(words), a + size)):
                    words[i] = words[a + (i - a) % p]
            texts.append(words)
        codes = np.array([w for t in texts for w in t], dtype=np.int64)
        found = runs.runs_of(codes, np.cumsum([len(t) for t in texts]), least_length, least_periods) if len(codes) else {}
        for number, words in enumerate(texts):
            assert found.get(number, []) == _brute_runs(words, least_length, least_periods)


def test_runs_of_long_texts():
    """One word, one period, and a passage that returns behind ever other words: no blow-up, right results."""
    n = 200_000
    assert runs.runs_of(np.zeros(n, dtype=np.int64), np.array([n])) == {0: [(0, n, 1)]}
    assert runs.runs_of(np.arange(n) % 7, np.array([n])) == {0: [(0, n, 7)]}
    rng = np.random.default_rng(1)
    words = rng.integers(0, 5000, n)
    words[np.arange(n) % 50 < 40] = np.resize(rng.integers(0, 5000, 40), int((np.arange(n) % 50 < 40).sum()))
    assert runs.runs_of(words, np.array([n])) == {}


def _planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _run_row(doc_id, words):
    found = _brute_runs(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return doc_id, len(found), *top, _sha(listed), _sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [_run_row(d.doc_id, _planted(d.doc_id, _words(d.text))) for d in docs]
    assert sum(r[1] > 0 for r in want) > 5
    assert sorted(map(tuple, QUERIES["op11_runs"](spark, SF).collect())) == sorted(want)


def test_runs_of_odd_rows(spark):
    docs = _odd(spark)
    found = runs.find_runs(docs).collect()
    assert len(found) == len(ODD)
    assert found[0].row.asDict().keys() == set(docs.columns)
    got = sorted(((r.row.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=str)
    want = []
    for doc_id, text in ODD:
        words = _words(text)
        listed = [(0, len(words), 1)] if len(words) > 1000 else _brute_runs(words)
        dropped = {i for s, n, q in listed for i in range(s + q, s + n)}
        want.append((doc_id, listed, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert got == sorted(want, key=str)
    assert runs.find_runs(docs.limit(0)).count() == 0
    same = planted_runs(docs).where("doc_id is null").first()
    assert same.text == "no id " * 20


# --- token counts ------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.load(Path(tokenizer_path("byte_bpe_50k.json")).read_bytes())


def test_every_character_is_split_alike(library, vocabulary):
    texts = [f"a{c}b1{c}2 {c}{c}  {c} .{c}'{c}s\n{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)])]
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert all(list(vocabulary.encode(t)) == w.ids for t, w in zip(texts, want, strict=True))


def test_splices_equal_the_whole(library, vocabulary):
    parts = ["a", "b", "the", " ", "  ", "\n", "'s", "'", "é", "字", "。", "1", "23", ".", "!?", "<|endoftext|>", "<|end", "oftext|>", "😀", " word"]
    rng, joined = random.Random(1), 0
    for _ in range(600):
        text = "".join(rng.choices(parts, k=rng.randint(0, 400)))
        chunk, overlap = rng.choice([(64, 40), (100, 60), (200, 64)])
        cuts = tokens.cut(text, chunk, overlap)
        found = [vocabulary.chunk(c, overlap if i else 0, overlap if i < len(cuts) - 1 else 0) for i, c in enumerate(cuts)]
        want = len(library.encode(text, add_special_tokens=False).ids)
        for place in (min, max):
            total, whole = sum(f[0] for f in found), True
            for (n, _, tail), (_, head, _) in zip(found, found[1:]):
                both = set(dict(tail)) & set(dict(head))
                whole &= bool(both)
                if both:
                    total -= n - dict(tail)[place(both)] + dict(head)[place(both)]
                    joined += 1
            assert not whole or total == want
    assert joined > 3000


@pytest.mark.parametrize(("chunk", "overlap"), [(tokens.CHUNK, tokens.OVERLAP), (200, 40), (64, 64)])
def test_counts_equal_the_library(spark, library, chunk, overlap):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id % 4 = 0")
    odd = _odd(spark).select("doc_id", "text").unionByName(
        spark.createDataFrame([(20, " " * 4000 + "x"), (21, "no'blank'at'all" * 300), (22, "字" * 900)], "doc_id long, text string")
    )
    rows = written(docs.unionByName(odd), "token-docs")
    found = tokens.count_tokens(rows, tokenizer_path("byte_bpe_50k.json"), chunk, overlap)
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in rows.collect()]
    assert got == sorted(want, key=str)


def test_token_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op12_tokens"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_blanks_beyond_the_stack_of_the_pattern(vocabulary, library):
    text = " " * 1_500_000 + "x"
    assert len(vocabulary.encode(text)) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_tables_empty_and_clashing(spark):
    docs = _odd(spark)
    found = tokens.count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))
    assert found.columns == ["row", "n_bytes", "n_tokens"]
    assert found.first().row.asDict().keys() == set(docs.columns)
    assert tokens.count_tokens(docs.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokens.Vocabulary(Path(tokenizer_path("word_bpe_49k.json")).read_bytes())


# --- ranked search -----------------------------------------------------------


def _terms(text):
    return re.findall(search.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute_search(docs, items, top=10):
    docs = [(i, _terms(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n_docs, total = len(docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, terms in docs for t in set(terms))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(_terms(text))
    rows = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, held in docs:
            m = 100 - 90 + (90 * len(held) * n_docs) // total
            counts = Counter(held)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in terms if counts[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows, key=str)


def test_terms_of_bytes():
    texts = ["Aa-bB 0.9_x", "", None, "É字a b", "\x00\x7f{z}"]
    flat, ends = search.terms_of(pa.array(texts).slice(0))
    assert flat.to_pylist() == [t for x in texts for t in _terms(x)]
    assert ends.tolist() == np.cumsum([len(_terms(x)) for x in texts]).tolist()


@pytest.mark.parametrize(("block", "shard", "top"), [(search.BLOCK_TERMS, search.SHARD_POSTINGS, 10), (60, 500, 10), (1, 1, 3)])
def test_search_equals_brute_force(spark, block, shard, top):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(_odd(spark).select("doc_id", "text"))
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(12).select("item_id", "text")
    items = items.unionByName(spark.createDataFrame(
        [(900, None), (901, ""), (902, "lamp word"), (902, "WORD x"), (None, "no id a"), (903, "zzzznothing")], "item_id long, text string"
    ))
    docs, items = written(docs, "docs"), written(items, "items")
    found = sorted(map(tuple, search.search(docs, items, top, block, shard).collect()), key=str)
    assert found == _brute_search(docs.collect(), items.collect(), top)


def test_search_with_few_terms_and_many_ties(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 3, 8, 20])))) for i in range(1500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(40)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item string")
    found = search.search(frame, spark.createDataFrame(items, "item_id long, text string"), shard_postings=1000)
    assert sorted(map(tuple, found.collect()), key=str) == _brute_search(docs, items)


def test_pair_bounds_are_tighter_and_hold(spark):
    """Two frequent terms that never meet: their joint bound lets both lists be skipped."""
    n = 400
    lists = {0: np.arange(0, n, 2), 1: np.arange(1, n, 2), 2: np.arange(5)}
    terms = np.array([0, 1, 2])
    places = np.concatenate(list(lists.values()))
    impacts = np.concatenate([np.full(len(p), v) for p, v in zip(lists.values(), (6, 7, 10))])
    shard = search.Shard(terms, np.cumsum([len(p) for p in lists.values()]), places, impacts)
    joint = [int(shard.joint(a, b)[1].max(initial=0)) for a, b in ((0, 1), (1, 2))]
    assert joint == [0, 17]
    bounds = shard.bounds([0, 1, 2], {0: 6, 1: 7, 2: 10}, joint)
    assert bounds == [0, 6, 7, 17]
    places, scores = shard.best([0, 1, 2], bounds, n, 9, 10)
    assert sorted(zip(places.tolist(), scores.tolist())) == [(0, 16), (1, 17), (2, 16), (3, 17), (4, 16)]


def test_search_in_empty_tables(spark):
    docs, items = _odd(spark), spark.createDataFrame([(1, "word", "x")], "item_id int, text string, rank string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id < 3"), items)):
        found = search.search(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert found.count() == 0
    assert [tuple(r)[:3] for r in search.search(docs, items).collect()] == [(1, 1, 3)]
