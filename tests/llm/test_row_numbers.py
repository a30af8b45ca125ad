"""Results when files are cut into partitions in another way for each scan, as a lost executor may cause."""

import hashlib
import random

import pytest

from panelforge.llm import exact_dedup, page_text, repeat_removal, simhash_near

CUT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def shifting(spark, monkeypatch):
    """Every stored result changes the cut of the scans that follow."""

    calls = []

    def wrap(land):
        def run(df, label):
            out = land(df, label)
            calls.append(label)
            spark.conf.set(CUT, f"{300 + 700 * (len(calls) % 5)}b")
            return out

        return run

    from panelforge import session
    from panelforge.llm import common

    for module in (exact_dedup, page_text, repeat_removal, simhash_near, common):
        if hasattr(module, "land"):
            monkeypatch.setattr(module, "land", wrap(session.land))
    before, cost = spark.conf.get(CUT), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set(CUT, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def stored(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).repartition(12).write.parquet(str(path))
    return spark.read.parquet(str(path))


def words(k, n=60):
    rnd = random.Random(k)
    return " ".join(f"w{rnd.randrange(9999)}" for _ in range(n))


@pytest.mark.parametrize(
    "keep, best",
    [(exact_dedup.keep_one_of_each, max), (simhash_near.keep_one_per_component, min)],
)
def test_one_row_of_each_text_stays(spark, tmp_path, shifting, keep, best):
    docs = stored(spark, tmp_path / "d", [(i, words(i % 25)) for i in range(60)], "doc_id long, text string")
    expected = sorted(best(i for i in range(60) if i % 25 == k) for k in range(25))
    assert sorted(r.doc_id for r in keep(docs).collect()) == expected


def test_repeats_are_cut_from_their_own_text(spark, tmp_path, shifting):
    own = [words(i, 40) + chr(65 + i) for i in range(30)]  # the byte before the passage differs
    rows = [(i, own[i] + (" " + words(99) if i % 3 == 0 else "")) for i in range(30)]
    found = repeat_removal.remove_repeats(stored(spark, tmp_path / "d", rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in found.collect()}
    passage = len(" " + words(99))
    for i, text in rows:
        assert got[i].n_bytes == len(text) and got[i].n_removed == (passage if i % 3 == 0 else 0)
        assert got[i].kept_sha256 == hashlib.sha256(own[i].encode()).hexdigest()


def test_template_goes_from_its_own_page(spark, tmp_path, shifting):
    rows = []
    for k in range(24):
        head = "".join(f"<p>{words(1000 * k + n, 12)}</p>" for n in range(k % 3))
        rows.append((k, f"http://h.example/{k:03d}", head + f"<div>Home</div><p>{words(k, 30)}</p>"))
    found = page_text.extract_text(stored(spark, tmp_path / "p", rows, "page_id long, url string, html string"))
    for r in found.collect():
        assert r.text == "\n".join([words(1000 * r.page_id + n, 12) for n in range(r.page_id % 3)] + [words(r.page_id, 30)])
