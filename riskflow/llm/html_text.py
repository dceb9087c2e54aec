"""Main text of web pages: differences from the page with the nearest URL, checked by structure.

A page is read into text lines, one per block, menus and adverts among them. Each page is
compared with the page whose URL path is nearest on the same host and whose text is another
one: the two line sequences are aligned by their longest common subsequence, and shared
lines are deleted. The structure checks what the differences say: lines of menus, headers,
footers, sidebars, notices, adverts, forms and comments, known by their elements, roles,
ids and classes, go even if no other page has them; lines of an ``article`` or ``main`` are
the page's own and come back, and a page that has them is made of them alone. (Menus and
adverts may differ between any two pages, and articles may share passages; README has the
figures.) So differences decide about the lines that the structure leaves open.

Neighbours come from a range sort of (host, path, page_id) alone; pages of one text that
stand together there look past each other. Lines travel as 64-bit prints, so no host gathers pages
in a task, however many it has.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.grouping import join_groups
from riskflow.llm.host_reputation import url_parts
from riskflow.plans.shared import materialize

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_HINT = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_PART = re.compile(r"[^a-z0-9]+")

# fixed values: names of HTML
_RAW = frozenset("script style title textarea noscript iframe template noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
_MAIN = frozenset(("article", "main"))
_DROP = frozenset(
    "nav footer aside form button select dialog menu search head svg math object audio video canvas map".split()
)
#: Words in class, id or role that name what is not the article.
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe signup sidebar sidebars nav navbar navigation menu menus "
    "breadcrumb breadcrumbs footer comment comments disqus respond share sharing social related recommended widget "
    "promo promotion toolbar pagination pager login contentinfo complementary search".split()
)
#: Names that only count outside the article, whose own heading may bear them.
_OUTER = frozenset(("header", "masthead"))
#: What the structure says of a line.
UNWANTED, OPEN, OWN = range(3)


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    if name in _DROP or (name in _OUTER and not inside):
        return True
    if not attributes or name in ("html", "body"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for hint in _HINT.finditer(attributes):
        words = _PART.split((hint[2] or hint[3] or hint[4] or "").lower())
        if any(w in _WORDS or (w in _OUTER and not inside) for w in words) and name not in _MAIN:
            return True
        if name in _MAIN and any(w in ("comment", "comments") for w in words):
            return True
    return False


def page_blocks(page: str) -> list[tuple[str, int]]:
    """(text, place) of each block in page order; place is UNWANTED, OPEN or OWN (in article or main)."""
    lines: list[tuple[str, int]] = []
    text: list[str] = []
    main = 0
    dropped = ""  # the unwanted element that is open
    depth = 0
    at = 0

    def flush() -> None:
        words = "".join(text).split()
        text.clear()
        if words:
            lines.append((" ".join(words), UNWANTED if dropped else OWN if main else OPEN))

    def add(piece: str) -> None:
        text.append(html.unescape(piece) if "&" in piece else piece)

    while True:
        tag = _TAG.search(page, at)
        add(page[at : tag.start()] if tag else page[at:])
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        attributes = tag[3] or tag[6] or ""
        if name in _RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            continue
        if dropped:
            if name in _MAIN and not closing and not main and not _unwanted(name, attributes, True):
                flush()
                dropped = ""  # an element before the article was never closed
            else:
                if name == "br":
                    text.append(" ")
                elif name in _BLOCK or name == dropped:
                    flush()
                if name == dropped:
                    depth += -1 if closing else 1
                    if depth == 0:
                        dropped = ""
                continue
        if name == "br":
            text.append(" ")
            continue
        if not closing and name not in _VOID and _unwanted(name, attributes, main > 0):
            flush()
            if not attributes.endswith("/"):
                dropped, depth = name, 1
            continue
        if name in _BLOCK:
            flush()
        if name in _MAIN:
            main = max(0, main + (-1 if closing else 1))
    flush()
    return lines


def page_lines(page: str) -> list[tuple[str, bool]]:
    """(text, in article or main) of each block outside unwanted elements, in page order."""
    return [(line, place == OWN) for line, place in page_blocks(page) if place != UNWANTED]


def line_print(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def common_lines(one: list[int], two: list[int]) -> list[int]:
    """The members of a longest common subsequence of two print sequences."""
    begin = 0
    while begin < min(len(one), len(two)) and one[begin] == two[begin]:
        begin += 1
    end = 0
    while end < min(len(one), len(two)) - begin and one[-1 - end] == two[-1 - end]:
        end += 1
    head, tail = one[:begin], one[len(one) - end :]
    a, b = np.array(one[begin : len(one) - end], np.int64), np.array(two[begin : len(two) - end], np.int64)
    # only lines that occur in both can be shared
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]
    return head + _longest_common(a, b) + tail


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of a with each prefix of b."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def _longest_common(a: np.ndarray, b: np.ndarray) -> list[int]:
    """A longest common subsequence, halving the first sequence so that only rows are kept."""
    if not len(a) or not len(b):
        return []
    if len(a) == 1:
        return [int(a[0])] if a[0] in b else []
    half = len(a) // 2
    cut = int(np.argmax(_scores(a[:half], b) + _scores(a[half:][::-1], b[::-1])[::-1]))
    return _longest_common(a[:half], b[:cut]) + _longest_common(a[half:], b[cut:])


def _line_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, host, path, a print of the wanted lines together, and the prints of all lines."""
    for batch in batches:
        looks, prints = [], []
        for page in batch.column(3):
            lines = page_blocks(page.as_py() or "")
            prints.append([line_print(line) for line, _ in lines])
            looks.append(line_print("\n".join(line for line, place in lines if place != UNWANTED)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(looks, pa.int64()), pa.array(prints, pa.list_(pa.int64()))],
            names=["page_id", "host", "path", "look", "prints"],
        )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [
            list(dict.fromkeys(common_lines(a or [], b or [])))
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared, pa.list_(pa.int64()))], names=["page_id", "shared"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, sizes = [], []
        for page, shared in zip(batch.column(2), batch.column(3).to_pylist()):
            lines = page_lines(page.as_py() or "")
            gone = set(shared or ())
            kept = [line for line, _ in lines if not gone or line_print(line) not in gone]
            if any(inside for _, inside in lines):  # the check: an article is whole, and the page is nothing else
                kept = [line for line, inside in lines if inside]
            texts.append("\n".join(kept))
            sizes.append(len(texts[-1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.large_string()).cast(pa.string()), pa.array(sizes, pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def _common_prefix(a: Column, b: Column) -> Column:
    """Number of leading path parts two paths share."""
    one, two = F.split(a, "/"), F.split(b, "/")
    same = F.zip_with(one, two, lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))
    first_other = F.array_position(same, F.lit(0))
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(same))


def nearest_pages(urls: DataFrame) -> DataFrame:
    """(page_id, other_id) from (page_id, host, path, look): the nearest path on the host with another look.

    It is the last before or the first after the page that looks otherwise, whichever
    shares more of the path. Pages of one look that stand together are a run: who comes
    before or after is known where it begins or ends, and carried through it.
    """
    order = ["host", "path", "page_id"]
    placed = materialize(urls.select(*order, "look").repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "urls")
    own = F.struct(*order, "look")
    inside = W.partitionBy("part").orderBy(*order, "look")

    def unlike(other: Column, row: Column) -> Column:
        """The other row if it is of another run."""
        same = (other.getField("host") == row.getField("host")) & (other.getField("look") == row.getField("look"))
        return F.when(other.isNotNull() & ~same, other)

    placed = placed.select(*order, "look", "part", own.alias("own"), F.lag(own).over(inside).alias("b"), F.lead(own).over(inside).alias("a"))
    placed = placed.withColumns({"b": unlike(F.col("b"), F.col("own")), "a": unlike(F.col("a"), F.col("own"))})
    # what the partitions around each one tell: one row per partition
    edges = placed.groupBy("part").agg(
        F.min("own").alias("low"),
        F.max("own").alias("high"),
        F.max_by("b", F.when(F.col("b").isNotNull(), F.col("own"))).alias("last_b"),
        F.min_by("a", F.when(F.col("a").isNotNull(), F.col("own"))).alias("first_a"),
    )
    around = W.orderBy("part")
    edges = edges.withColumns(
        {
            "start": unlike(F.lag("high").over(around), F.col("low")),
            "end": unlike(F.lead("low").over(around), F.col("high")),
        }
    )
    # backward carries run down the reversed order: frames that end with the partition would be read again for each row
    earlier, later = (w.rowsBetween(W.unboundedPreceding, -1) for w in (around, W.orderBy(F.desc("part"))))
    edges = edges.select(
        "part",
        F.coalesce("start", F.last(F.coalesce("last_b", "start"), ignorenulls=True).over(earlier)).alias("start"),
        F.coalesce("end", F.last(F.coalesce("first_a", "end"), ignorenulls=True).over(later)).alias("end"),
    )
    backward = W.partitionBy("part").orderBy(*[F.desc(c) for c in (*order, "look")])
    upto, onward = (w.rowsBetween(W.unboundedPreceding, 0) for w in (inside, backward))
    near = placed.join(edges, "part").select(
        *order,
        F.coalesce(F.last("b", ignorenulls=True).over(upto), F.col("start")).alias("before"),
        F.coalesce(F.last("a", ignorenulls=True).over(onward), F.col("end")).alias("after"),
    )
    score = {s: F.when(F.col(f"{s}.host") == F.col("host"), _common_prefix(F.col("path"), F.col(f"{s}.path"))) for s in ("before", "after")}
    near = near.withColumns({"b": F.coalesce(score["before"], F.lit(-1)), "a": F.coalesce(score["after"], F.lit(-1))})
    other = F.when(F.greatest("a", "b") < 0, None).when(F.col("b") >= F.col("a"), F.col("before.page_id"))
    return near.select("page_id", other.otherwise(F.col("after.page_id")).alias("other_id")).where("other_id is not null")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are not looked at. A null
    or empty page has the text "". A page cut off in mid-tag or in an unwanted element
    yields what came before. Pages without a host, without a page_id, without any line, or
    on a host where all have the same wanted lines are compared with none. Rows that repeat a page_id are compared each, and
    lines deleted from one are deleted from all of them. No rows give no rows.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    prints = materialize(
        rows.select("page_id", host.alias("host"), path.alias("path"), "html").mapInArrow(
            _line_prints, "page_id bigint, host string, path string, look bigint, prints array<bigint>"
        ),
        "lines",
    )
    lined = prints.where("host <> '' and page_id is not null and size(prints) > 0")
    pairs = nearest_pages(lined.select("page_id", "host", "path", "look")).where("other_id <> page_id")
    pairs = materialize(pairs.distinct(), "pairs")
    lines = lined.select("page_id", "prints").distinct()
    # a page may be the nearest one of a whole group of copies
    others = pairs.groupBy("other_id").agg(F.count("*").alias("n_pages")).join(lines.toDF("other_id", "other_prints"), "other_id")
    shared = (
        join_groups(lines.join(pairs, "page_id"), materialize(others, "others"), "other_id", "n_pages")
        .select("page_id", "prints", "other_prints")
        .mapInArrow(_shared, "page_id bigint, shared array<bigint>")
        .where("size(shared) > 0")
        .groupBy("page_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("shared"))).alias("shared"))
    )
    shared = materialize(shared, "shared")
    return (
        rows.join(shared, "page_id", "left")
        .select("page_id", "url", "html", "shared")
        .mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint")
    )
