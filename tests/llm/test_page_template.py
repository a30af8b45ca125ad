"""Template without a telling name, in articles and around them, and copies that must keep their text."""

import random

import pytest

from panelforge.llm.page_text import extract_text

NOTICE = "Readers of this site agree that the editors may shorten, move or drop what they send, at any time and without notice."
SIGN_UP = "Get the letter of the week in your mail box every Friday, free of charge, and leave the list whenever you like."


def extract(spark, path, rows, parts):
    schema = "page_id long, url string, html string"
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(str(path))
    return {r.page_id: r for r in extract_text(spark.read.parquet(str(path))).collect()}


def story(k, lines=5):
    rnd = random.Random(k)
    return [" ".join(f"word{rnd.randrange(5000)}" for _ in range(14)) for _ in range(lines)]


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("tag", ["main", "article"])
def test_unnamed_template_in_main(spark, tmp_path, tag, parts):
    def page(k):
        body = "".join(f"<p>{x}</p>" for x in story(k))
        return f"<{tag}><div>{SIGN_UP}</div>{body}<div>{NOTICE}</div><div>Write to us</div></{tag}>"

    found = extract(spark, tmp_path / "p", [(k, f"http://h.example/a/{k:03d}", page(k)) for k in range(30)], parts)
    assert all(found[k].text == "\n".join(story(k)) and found[k].n_shared == 3 for k in range(30))


@pytest.mark.parametrize("parts", [1, 5])
def test_prose_that_both_neighbours_hold_by_chance_stays(spark, tmp_path, parts):
    chance = "She left the house in the early morning."

    def body(k):
        return [*story(k), *([chance] if k in (11, 12, 13, 20, 21, 22) else [])]

    def page(k):
        return "<article>" + "".join(f"<p>{x}</p>" for x in body(k)) + f"<div>{NOTICE}</div></article>"

    found = extract(spark, tmp_path / "p", [(k, f"http://h.example/a/{k:03d}", page(k)) for k in range(30)], parts)
    assert all(found[k].text == "\n".join(body(k)) for k in range(30))


def test_template_longer_than_the_article(spark, tmp_path):
    frame = "".join(f"<div>{x}</div>" for x in [NOTICE, SIGN_UP, *(f"Section {n} of the shop" for n in range(30))])

    def page(k):
        return frame + "".join(f"<p>{x}</p>" for x in story(k, 2))

    found = extract(spark, tmp_path / "p", [(k, f"http://h.example/a/{k:03d}", page(k)) for k in range(30)], 4)
    assert all(found[k].text == "\n".join(story(k, 2)) and found[k].n_shared == 32 for k in range(30))


@pytest.mark.parametrize("opening, closing", [("<main>", "</main>"), ("<div>", "</div>")])
def test_copies_keep_their_text_without_the_template(spark, tmp_path, opening, closing):
    def page(k):  # pages 2n and 2n + 1 are copies
        return f"{opening}<div>{NOTICE}</div>" + "".join(f"<p>{x}</p>" for x in story(k // 2)) + closing

    found = extract(spark, tmp_path / "p", [(k, f"http://h.example/a/{k:03d}", page(k)) for k in range(20)], 3)
    assert all(found[k].text == "\n".join(story(k // 2)) for k in range(1, 19))


def test_a_run_of_copies_and_a_lone_page_stay_whole(spark, tmp_path):
    body = "".join(f"<p>{x}</p>" for x in story(1, 8))
    rows = [(k, f"http://h.example/a?v={k}", f"<article>{body}<p>Read {k} times</p></article>") for k in range(6)]
    rows.append((9, "http://lone.example/x", f"<article>{body}</article>"))
    found = extract(spark, tmp_path / "p", rows, 2)
    assert all(found[k].text == "\n".join([*story(1, 8), f"Read {k} times"]) for k in range(6))
    assert found[9].text == "\n".join(story(1, 8)) and found[9].n_shared == 0


def test_repeated_rows_each_get_the_text_of_one_page(spark, tmp_path):
    def row(k):
        body = "".join(f"<p>{x}</p>" for x in story(k))
        return (k, f"http://h.example/a/{k:03d}", f"<main><div>{NOTICE}</div>{body}</main>")

    rows = [row(k) for k in range(12) for _ in range(9 if k == 5 else 1)]
    schema = "page_id long, url string, html string"
    found = extract_text(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert sorted((r.page_id, r.text) for r in found) == sorted((k, "\n".join(story(k))) for k, _, _ in rows)
