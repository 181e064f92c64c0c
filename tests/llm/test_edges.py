"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenlake.llm import exact, itq, language, licenses, lines, mixing, pieces, simhash, toxicity, warc
from lumenlake.llm.common import new_folder, written
from lumenlake.llm.queries import tokenizer_path

# The columns of documents, and some whose names the operators use inside.
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, fp string, size string, "
    "digest string, score string, owner string, lines string, weight string, place string"
)
EXTRA = ("row", "fp", "size", "digest", "score", "owner", "lines", "weight", "place")
LONG = "word " * 40_000


def _docs(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    words = "alpha beta gamma delta idiot scum river stone cloud lamp".split()
    rows = [(i, " ".join(rng.choices(words[:4] + words[6:], k=30)), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, " ".join(rng.choices(words, k=30)) + " idiot scum", "en", "s1") for i in range(20)]
    rows += [
        (200, None, None, None), (201, "", "en", "s0"), (202, " \t\n ", "de", None), (203, LONG, "en", "s0"),
        (204, "same text here", "en", "s0"), (204, "same text here", "en", "s0"), (205, "same \t text\nhere", None, "s1"),
        (None, "no id at all", "en", "s1"), (None, None, None, None), (206, "12 34   !?", "fr", ""),
        (207, "ünïcödé ▁ 字 \U0001f600", "de", "s2"), (208, "\n\n\n", "en", "s2"),
    ]
    return written(_docs(spark, rows), "odd")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, int(i >= 100)) for i in [*range(40), *range(100, 120)]] + [(None, None, 1), (3, None, None), (5, 0, 0), (7, 0, 9)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def sf_dir(spark, odd, labels):
    folder = new_folder(spark, "sf")
    odd.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def _models(docs, labels):
    return language.fit(docs, min_count=1), toxicity.fit(docs, labels, min_docs=1)


def _per_row(docs, labels):
    """Every operator that returns a row for each document."""
    lang, toxic = _models(docs, labels)
    return {
        "mix": mixing.mix(docs), "language": language.predict(docs, lang), "toxicity": toxicity.score(docs, toxic),
        "simhash": simhash.near_groups(docs), "exact": exact.groups(docs), "lines": lines.dedup_lines(docs),
        "pieces": pieces.encode(docs, tokenizer_path()), "licenses": licenses.scan(docs),
    }


def test_every_row_comes_back(odd, labels):
    n = odd.count()
    for name, found in _per_row(odd, labels).items():
        assert found.count() == n, name


def test_whole_row_travels_along(odd, labels):
    found = mixing.mix(odd).select("row.*")
    assert found.columns == odd.columns
    assert sorted(found.collect(), key=str) == sorted(odd.collect(), key=str)


def test_empty_tables(spark, labels):
    empty = _docs(spark, [])
    for docs, known in ((empty, labels), (empty, labels.limit(0))):
        for name, found in _per_row(docs, known).items():
            assert found.count() == 0, name


def test_stages_keep_the_columns(spark, odd, sf_dir):
    docs, n = odd, odd.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == odd.columns, name
        assert 0 < docs.count() <= 2 * n, name


def test_stages_on_an_empty_table(spark, odd, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), sf_dir).count() == 0, name


def test_repeated_rows_leave_one(odd):
    kept = exact.unique_rows(odd).where("text like 'same%'").select("doc_id", "text").collect()
    assert [tuple(r) for r in kept] == [(204, "same text here")]
    kept = simhash.one_of_each_group(odd).where("text like 'same%'").select("doc_id").collect()
    assert [r.doc_id for r in kept] == [204]
    marked = exact.groups(odd).where("doc_id = 204").select("kept").collect()
    assert sorted(r.kept for r in marked) == [False, True]


def test_null_ids(odd):
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.groups(odd).where("doc_id is null").collect()}
    assert found == {(None, None, 1, True), (None, 200, 3, False)}  # alone, and with the other empty texts
    found = {r.component_id for r in simhash.near_groups(odd).where("doc_id is null").collect()}
    assert found == {None, 200}
    n = lines.dedup_lines(odd).where("row.doc_id is null").agg(F.sum("n_dropped")).first()[0]
    assert n == 0


def test_mix_of_odd_sizes(odd):
    found = mixing.mix(odd).collect()
    assert all(r.taken <= 2 * r["size"] for r in found)
    assert {r["size"] for r in found if not (r.row.text or "").strip()} == {0}
    assert sum(r.taken for r in found) == pytest.approx(1.5 * sum(r["size"] for r in found), rel=0.35)


def test_language_of_odd_texts(odd):
    found = {r.row.doc_id: r for r in language.predict(odd, language.fit(odd, min_count=1)).collect()}
    for i in (200, 201, 202, 206, 208):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[203].lang_pred != "und"


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]),
        (6, [1.0, None, 0.0]), (7, [1.0, nan, 0.0]), (8, [inf, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (9, [1.0, 0.0]),
        (10, [0.0, 1.0, 0.0]),
    ]
    vectors = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    found, links = itq.near_duplicates(vectors)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in found.collect()), key=str)
    want = [(1, 3, 1), (2, 3, 1), (2, 3, 1), (None, 3, 1)] + [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert got == sorted(want, key=str)
    assert [tuple(r) for r in links.collect()] in ([(1, 2)], [(2, 1)])
    assert itq.near_duplicates(vectors.limit(0))[0].count() == 0


def test_pages(spark):
    body = "<p>" + "x" * 200 + "</p>"
    rows = [
        (1, "http://a/1", body), (2, None, body), (3, "http://a/3\r\nX: y", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
        (None, "u", body), (7, "http://a/ü", "é" * 60), (1, "http://a/1", body),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    folder = new_folder(spark, "odd-pages")
    warc.write_archives(warc.records(pages), folder)
    found = warc.read_archives(spark, folder, verify="true").collect()
    assert len(found) == len(rows)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in found)
    assert kinds == sorted([
        ("1", "response", None), ("1", "response", None), ("2", "revisit", 1), ("3", "response", None), ("4", "response", None),
        ("5", "response", None), ("6", "response", None), ("None", "revisit", 1), ("7", "response", None),
    ])
    assert {r.payload_bytes for r in found if r.page_id == 7} == {120}
    assert {r.target_uri for r in found if r.page_id == 3} == {"http://a/3%0D%0AX: y"}
    empty = new_folder(spark, "no-pages")
    warc.write_archives(warc.records(pages.limit(0)), empty)
    assert warc.read_archives(spark, empty).count() == 0


# --- ids that are missing or repeated in whole sources -------------------------


@pytest.mark.parametrize("same_id", [None, 7])
def test_mix_meets_its_targets_without_own_ids(spark, same_id):
    """Sources b and c have one id for all rows: places come from the texts, too."""
    rows = [(i, f"{s}{i} " * 100, "en", s) for s in "abc" for i in range(400)]
    docs = _docs(spark, [(r[0] if r[3] == "a" else same_id, *r[1:]) for r in rows])
    found = mixing.mix(docs).groupBy("row.source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    for r in found.collect():
        assert abs(r.taken - r.target) <= 50, r


def test_language_of_rows_without_ids_is_learned(spark):
    rng = random.Random(4)
    texts = {"en": "the of and with for that this from".split(), "de": "der die und mit für das dies von".split()}
    rows = [(None if lang == "en" else i, " ".join(rng.choices(words, k=12)), lang, "s") for lang, words in texts.items() for i in range(600)]
    rows += [(None, "one text the whole table repeats", "xx", "s")] * 500
    docs = _docs(spark, rows)
    sample = language.labelled_sample(docs, 100, 4, 2).groupBy("lang").count().collect()
    sizes = dict(map(tuple, sample))
    assert 60 <= sizes["en"] <= 140 and 60 <= sizes["de"] <= 140 and sizes["xx"] == 1
    model = language.fit(docs, sample_rows=100)
    probe = _docs(spark, [(2, "the and of", None, "s"), (3, "der und die", None, "s")])
    assert {r.row.doc_id: r.lang_pred for r in language.predict(probe, model).collect()} == {2: "en", 3: "de"}


def test_toxicity_sample_is_bounded_where_ids_repeat(spark):
    rows = [(5, f"one id many texts {i}", "en", "s") for i in range(3000)] + [(6, "the same row", "en", "s")] * 3000
    labels = spark.createDataFrame([(5, 0, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(_docs(spark, rows), labels, 100, 3, 99).groupBy("toxic").count().collect()
    sizes = dict(map(tuple, sample))
    assert 60 <= sizes[1] <= 140 and sizes[0] == 1
