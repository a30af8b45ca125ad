"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest

from panelforge.llm import (
    decontaminate, exact_dedup, language_id, license_scan, page_text, repeat_removal, sentencepiece_codec, simhash_near,
    token_files, toxicity,
)

LONG = "word of the long one " * 20_000
TEXTS = [
    (1, "the cat sat on the mat", "en"), (2, None, "en"), (3, "", None), (4, "   \n\t ", "de"),
    (5, "the cat sat on the mat", "en"), (6, LONG, "en"), (7, "1234 %%% 99", None), (8, "日本語 🦄 \u0000 é", "fr"),
    (None, "no id here", "de"), (9, "der Hund und die Katze", "de"), (9, "der Hund und die Katze", "de"), (10, "x" * 70_000, "en"),
]
# Names that the operators use inside.
EXTRA = "row bigint, id bigint, name string, _row int, root int, fp int, ids string, score int, item string, spans int, _text int"
SCHEMA = f"doc_id bigint, text string, lang string, {EXTRA}"


def frame(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
    spark.createDataFrame([(*r, 1, 2, "n", 3, 4, 5, "i", 6, "t", 7, 8) for r in rows], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return frame(spark, tmp_path_factory, TEXTS)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return frame(spark, tmp_path_factory, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 0, "a"), (5, 0, "b"), (6, 1, "c"), (9, None, "d"), (None, 1, "e")], "doc_id bigint, toxic int, text string"
    )


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(0, "the cat sat on the mat", 1), (1, None, 1), (2, "", 1), (3, "a long one word of the long one word of", 1)]
    return spark.createDataFrame(rows, "item_id bigint, text string, doc_id int")


def test_exact(docs, nothing):
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == len(TEXTS)
    by_text = {(r.doc_id, r.text_sha256): r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    assert by_text[2, empty].group_size == 2 and by_text[2, empty].keep_id == 3
    assert sorted(r.kept for r in rows if r.doc_id == 9) == [False, True]
    assert sum(r.kept for r in rows) == len({t or "" for _, t, _ in TEXTS})
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.keep_one_of_each(docs).columns == docs.columns


def test_simhash(docs, nothing):
    rows = simhash_near.simhash_groups(docs).collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert len(rows) == len(TEXTS)
    assert found[2] == found[3] == found[4] == ("0" * 16, 2)
    assert found[1] == found[5] and found[5][1] == 1
    assert simhash_near.simhash_groups(nothing).count() == 0
    kept = simhash_near.keep_one_per_component(docs)
    assert kept.columns == docs.columns


def test_languages(docs, nothing):
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 7)} == dict.fromkeys((2, 3, 4, 7), "und")
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "und"}
    assert language_id.identify(nothing).count() == 0
    assert language_id.keep_identified(docs).columns == docs.columns


def test_toxicity(docs, nothing, labels):
    rows = toxicity.toxic_documents(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxic_documents(nothing, labels).count() == 0
    assert toxicity.toxic_documents(docs, labels.where("false")).count() == len(TEXTS)


def test_contamination(docs, nothing, benchmark):
    rows = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(6, 3)}  # shorter items are no evidence
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.where("false")).count() == 0
    assert decontaminate.keep_clean(docs, benchmark).columns == docs.columns
    assert decontaminate.keep_clean(docs, benchmark).count() == len(TEXTS) - 1


def test_repeats(docs, nothing):
    rows = {r.doc_id: r for r in repeat_removal.remove_repeats(docs).collect()}
    assert rows[6].n_removed == rows[6].n_bytes == len(LONG) and rows[6].n_spans == 1
    assert rows[10].n_removed == 70_000 and rows[2].n_bytes == 0
    assert rows[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert repeat_removal.remove_repeats(nothing).count() == 0


def test_sentencepiece(docs, nothing):
    rows = sentencepiece_codec.token_ids(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows if r.doc_id in (2, 3)} == {2: 0, 3: 0}
    encoded = sentencepiece_codec.encode_texts(docs)
    assert set(encoded.columns) == {*docs.columns, "ids", "n_tokens", "round_trip"}
    back = sentencepiece_codec.decode_texts(encoded.drop("text"))
    assert {r.text for r in back.collect()} == {t or "" for _, t, _ in TEXTS}
    assert sentencepiece_codec.token_ids(nothing).count() == 0


def test_token_counts(docs, nothing):
    rows = token_files.document_token_counts(docs, block_tokens=1000).collect()
    encode = token_files.tokenizer(token_files.RANKS_PATH).encode_ordinary
    assert sorted(r.n_tokens for r in rows) == sorted(len(encode(t or "")) for _, t, _ in TEXTS)
    assert token_files.document_token_counts(nothing).count() == 0


def test_licenses(docs, nothing):
    assert license_scan.find_licenses(docs).where("confirmed").count() == 0
    assert license_scan.find_licenses(nothing).count() == 0


def test_pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    body = "<nav><a>menu</a></nav><article><h1>T &amp; x</h1><p>one\n two<p>three<br>four</article><footer>f</footer>"
    rows = [
        (1, "http://a.b/x", body, 1), (2, None, None, 1), (3, "http://a.b/y", "", 1), (4, "http://[bad", body, 1),
        (4, "http://[bad", body, 1), (None, "http://a.b/z", "plain <b>text", 1),
    ]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, row int").write.parquet(path)
    pages = spark.read.parquet(path)
    found = [(r.page_id, r.text, r.n_chars) for r in page_text.extract_text(pages).collect()]
    text = "T & x\none two\nthree four"
    assert sorted(found, key=str) == sorted(
        [(1, text, len(text)), (2, "", 0), (3, "", 0), (4, text, len(text)), (4, text, len(text)), (None, "plain text", 10)],
        key=str,
    )
    assert page_text.extract_text(pages.where("false")).count() == 0
