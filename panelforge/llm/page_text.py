"""Main text of web pages by nearest-URL page differencing.

Pages of a host are sorted by URL path and the text lines of each are aligned with
those of its two neighbours by a longest common subsequence; the first and the last
page of a host, which have one neighbour, are aligned with the page next to that
too. A line that a page shares with both is template and goes, wherever it stands.
A line shared with one of them goes too, unless it stands in an explicit article
element, which may quote or repeat another article. What is left loses the regions
that markup itself names as menu, footer, advert and the like.

Two neighbours may hold a sentence of an article by chance, so inside an article a line
that both share goes only if the next pages on either side have it too.

A page that is a copy of a neighbour keeps what it shares with it. A copy is known by
its long lines: they outweigh what the page has of its own.

A page is known by a 128-bit digest of its row, so two scans agree about it however the
files are cut, and no page is stored. Sorting is by range partitions, so a host with
very many pages spreads over tasks. Only hashes of lines are sorted and compared; the
pages at the ends of a partition are compared on the driver, from the few first and last
pages of each. Texts travel once, to meet the lines that go.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, require
from panelforge.llm.html_lines import Line, page_lines, shared_lines
from panelforge.session import land

#: Characters of a long line, which tells a copy; menus, labels and buttons are shorter.
LONG_LINE = 80
#: A page is a copy if its own text is less than this share of the long lines that it has in common.
OWN_SHARE = 0.2
#: Pages at each end of a partition that the driver sees, and those of them that it compares.
EDGE, BORDER = 6, 3
#: Pages that must all hold a line before it goes from an article, where the host has so many within ``BORDER``.
WITNESSES = 4


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host in lower case without port, and path without query, fragment, ending and last slash; null and broken URLs have empty ones."""

    try:
        parts = urlsplit((url or "").strip())
        path = parts.path.rstrip("/")
        name = path.rsplit("/", 1)[-1]
        if "." in name:
            path = path[: len(path) - len(name)] + name.split(".", 1)[0]
        return (parts.hostname or ""), path
    except ValueError:
        return "", ""


def content_lines(lines: list[Line]) -> list[int]:
    """The lines of the article, or of the page if markup names none, outside the regions that are named as something else."""

    article = any(line.main and not line.aside for line in lines)
    return [i for i, line in enumerate(lines) if not line.aside and (line.main or not article)]


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and text of the content lines, and whether they are an article's."""

    for batch in batches:
        articles, places, texts = [], [], []
        for html in batch.column("html").to_pylist():
            lines = page_lines(html)
            content = content_lines(lines)
            articles.append(bool(content) and lines[content[0]].main)
            places.append(content)
            texts.append([lines[i].text for i in content])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"), batch.column("id"), batch.column("url"), pa.array(articles, pa.bool_()),
                pa.array(places, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string())),
            ],
            names=["row", "id", "url", "article", "content", "texts"],
        )


def _index_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path and the hashes of all lines."""

    for batch in batches:
        hosts, paths, hashes = [], [], []
        for url, html in zip(batch.column("address").to_pylist(), batch.column("html").to_pylist()):
            host, path = host_and_path(url)
            hosts.append(host)
            paths.append(path)
            hashes.append([xxhash.xxh64_intdigest(line.text) >> 1 for line in page_lines(html)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(hashes, pa.list_(pa.int64()))],
            names=["row", "host", "path", "lines"],
        )


#: A page on its way: digest, host, hashes of its lines. None marks a gap.
Page = tuple[str, str, list[int]] | None


class Comparer:
    """Aligns the pages of a sorted run; each pair once while it is near."""

    def __init__(self) -> None:
        self.held: dict[tuple[str, str], tuple[list[int], list[int]]] = {}

    def pair(self, a: Page, b: Page) -> tuple[list[int], list[int]]:
        key = (a[0], b[0])
        if key not in self.held:
            if len(self.held) >= 4:
                del self.held[next(iter(self.held))]
            self.held[key] = shared_lines(a[2], b[2])
        return self.held[key]

    def shared(self, run: list[Page], i: int) -> list[list[int]]:
        """For each of the up to two references of page ``i``: its lines that are shared with it.

        After two references a third list holds those of both that further pages nearby have as
        well, up to ``WITNESSES`` pages in all.
        """

        def same(j: int) -> bool:
            return 0 <= j < len(run) and run[j] is not None and run[j][1] == run[i][1]

        back, ahead = same(i - 1), same(i + 1)
        others = ([i - 1] if back else []) + ([i + 1] if ahead else [])
        if back and not ahead and same(i - 2):
            others.append(i - 2)
        if ahead and not back and same(i + 2):
            others.append(i + 2)
        found = [self.pair(run[j], run[i])[1] if j < i else self.pair(run[i], run[j])[0] for j in others]
        if len(found) == 2:
            near = [j for d in range(1, BORDER + 1) for j in (i - d, i + d) if j not in others and same(j)]
            further = [set(run[j][2]) for j in near[: WITNESSES - 2]]
            both = set(found[0]).intersection(found[1])
            found.append(sorted(k for k in both if all(run[i][2][k] in lines for lines in further)))
        return found


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared line positions per page and reference. The first and last pages of the range are handed on whole."""

    part, comparer = TaskContext.get().partitionId(), Comparer()
    run: list[Page] = []  # the pages around the one that is compared
    start, count = 0, 0  # place of run[0]; pages seen
    head: list[Page] = []
    for batch in batches:
        found: list[tuple] = []
        for page in zip(*[batch.column(n).to_pylist() for n in ("row", "host", "lines")]):
            if len(head) < EDGE:
                head.append(page)
            run.append(page)
            count += 1
            at = count - 1 - BORDER  # has its two successors; the last two never come here
            if at >= BORDER:
                found.append((run[at - start][0], comparer.shared(run, at - start), None, None, None, None))
            while len(run) > 2 * BORDER + 1:
                run.pop(0)
                start += 1
        yield _compared(found)
    tail = run[-EDGE:]
    ends = [(k, p) for k, p in enumerate(head)] + [(count - len(tail) + k, p) for k, p in enumerate(tail)]
    yield _compared([(p[0], [p[2]], part, k, count, p[1]) for k, p in dict(ends).items()])


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.list_(pa.list_(pa.int64())), pa.int32(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["row", "lines", "part", "place", "pages", "host"]
    )


def _compare_ends(ends: list) -> list[tuple[str, list[list[int]]]]:
    """The pages next to partition borders, compared; ``ends`` are all handed-on pages in order."""

    run: list[Page] = []
    places: list[int] = []
    before = None
    for r in ends:
        if before is not None and before[0] == r["part"] and before[1] + 1 < r["place"]:
            run.append(None)  # pages in between were compared by their task
        if r["place"] < BORDER or r["place"] >= r["pages"] - BORDER:
            places.append(len(run))
        run.append((r["row"], r["host"], r["lines"][0]))
        before = (r["part"], r["place"])
    comparer = Comparer()
    return [(run[i][0], comparer.shared(run, i)) for i in places]


def template_lines(index: DataFrame) -> DataFrame:
    """For a stored table of ``row``, ``host``, ``path`` and hashes ``lines``: ``row`` and ``shared``, as :meth:`Comparer.shared` gives it.

    Lines are numbered in page order. Pages alone on their host have an empty list. The
    driver compares six pages per partition, nothing else.
    """

    order = ["host", "path", "row"]
    compared = land(
        map_arrow(
            index.select(*order, "lines").repartitionByRange(*order).sortWithinPartitions(*order), _compare_neighbours,
            "row string, lines array<array<bigint>>, part int, place bigint, pages bigint, host string",
        ),
        "compared-pages",
    )
    ends = sorted(compared.where("part is not null").collect(), key=lambda r: (r["part"], r["place"]))
    shared = compared.where("part is null").select("row", F.col("lines").alias("shared"))
    extra = _compare_ends(ends)
    if extra:
        shared = shared.unionByName(index.sparkSession.createDataFrame(extra, "row string, shared array<array<bigint>>"))
    return shared


def template_of(article: bool, sizes: dict[int, int], shared: list[list[int]]) -> set[int]:
    """The lines that go because pages nearby have them too; ``sizes`` are the characters of the content lines."""

    content = set(sizes)
    sides = [set(s) for s in shared[:2]]
    every = set.intersection(*sides) if len(sides) > 1 else set()
    once = set().union(*sides) - every
    own = content - every - once

    def size(some: set[int], least: int = 0) -> int:
        return sum(n for n in (sizes[i] for i in some & content) if n >= least)

    # Lines that one page has too: kept from a copy, and in an article, which may quote another.
    # On a host of two pages nothing else tells template from copy, so there own text weighs more.
    share = 1.0 if len(sides) > 1 else OWN_SHARE
    if article:
        if len(sides) > 1:
            once -= content
        elif size(own) <= share * size(once, LONG_LINE):
            once -= content
    else:
        for side in sides:
            if size(own) <= share * size(side & once, LONG_LINE):
                once -= side
    # A copy of both neighbours has next to nothing but what all three share.
    rest = content - every - once
    if not size(rest) or size(rest) < OWN_SHARE * size(every, LONG_LINE):
        every -= content
    # Lines of an article that two neighbours may hold by chance.
    if article and len(shared) > 2:
        every -= content - set(shared[2])
    return every | once


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        rows = zip(*[batch.column(n).to_pylist() for n in ("article", "content", "texts", "shared")])
        for article, content, lines, shared in rows:
            template = template_of(article, dict(zip(content, map(len, lines))), shared or [])
            texts.append("\n".join(line for i, line in zip(content, lines) if i not in template))
            counts.append(len(template))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int32()),
            ],
            names=["id", "url", "text", "n_chars", "n_shared"],
        )


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per page: id, url, ``text``, ``n_chars`` (code points) and ``n_shared``, the template lines found.

    Blocks keep the page's order, joined by a line feed; white space in a block is one
    space. Null and empty pages give an empty text; null URLs are one host of their own;
    pages with equal URLs are neighbours; rows equal in id, URL and html count as one page
    and each get a row with its text; an empty table gives an empty result.
    """

    require(pages, id_column, url_column, html_column)
    kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_column, url_column))
    fields = [F.col(id_column), F.col(url_column), F.col(html_column).cast("string")]
    picked = pages.select(
        F.concat_ws("-", F.xxhash64(*fields), F.xxhash64(F.lit(1), *fields)).alias("row"), F.col(id_column).alias("id"),
        F.col(url_column).alias("url"), fields[2].alias("html"),
    )
    index = map_arrow(
        picked.select("row", F.col("url").cast("string").alias("address"), "html"), _index_pages,
        "row string, host string, path string, lines array<bigint>",
    )
    # Stored, so that the range bounds are sampled without parsing every page once more.
    index = land(index.groupBy("row").agg(*[F.min(c).alias(c) for c in ("host", "path", "lines")]), "page-index")
    shared = land(template_lines(index), "template-lines")
    parsed = map_arrow(
        picked, _parse_pages,
        f"row string, id {kind}, url {url_kind}, article boolean, content array<int>, texts array<string>",
    )
    joined = parsed.join(shared, "row", "left")
    found = map_arrow(
        joined.select("id", "url", "article", "content", "texts", "shared"), _assemble,
        f"id {kind}, url {url_kind}, text string, n_chars bigint, n_shared int",
    )
    return found.withColumnRenamed("id", id_column).withColumnRenamed("url", url_column)
