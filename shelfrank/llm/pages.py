"""Main text of web pages by structure and by differences to the nearest page of the same host.

A page is cut into blocks of text. Blocks in menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments go by their element or its class. Then pages are paired with the page of
their host whose URL path is nearest in path order; the blocks of both are aligned by longest common
subsequence, and shared blocks, the template of the site, are deleted. Paragraphs and headings of an article
element are never deleted that way, nor blocks of a page that is mostly a copy of its pair.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.common import table, written
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title|select|button)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!/?a-zA-Z][^<>]*(?:>|\Z)|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements and words in class, id or role that hold no article text.
SKIPPED = set("head nav header footer aside form menu dialog object audio video canvas fieldset".split())
SKIPPED_WORDS = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adbox advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices popup modal overlay "
    "newsletter subscribe subscription comment comments reply replies respond share sharing social related "
    "recommended breadcrumb breadcrumbs pagination pager widget login signup search form contentinfo complementary "
    "disclaimer alert toolbar skip hidden".split()
)
# First parts of names that tell what a page has or lacks.
STATES = set("no not has have with without is hide show".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CONTENT = set("h1 h2 h3 h4 h5 h6 p blockquote pre li dd dt figcaption caption td th tr".split())
CELLS = {"td", "th", "br"}
# Share of the shorter page from which a pair counts as copies of one article.
COPY_SHARE = 0.5


def _skips(tag: str, attributes: str, by_name: bool = True) -> bool:
    """Whether an element goes by its tag or by a whole name, or the last part of one, in class, id or role."""
    if tag in SKIPPED:
        return True
    if not by_name or tag in ("html", "body", "main") or tag in HEADINGS or not attributes:
        return False
    for match in ATTRIBUTE.finditer(attributes):
        if match[1].lower() not in ("class", "id", "role"):
            continue
        for name in (match[2] or match[3] or match[4] or "").lower().split():
            parts = [x for x in re.split(r"[^a-z]+", name) if x]
            if parts and parts[-1] in SKIPPED_WORDS and parts[0] not in STATES:
                return True
    return False


def page_blocks(source: str | None) -> list[tuple[str, bool]]:
    """Blocks of a page in order with whether an article element holds them as content.

    Where an article or main element holds half of the page's blocks or of its text, only its blocks count, and
    top headlines before it. Names of elements do not count where they would leave nothing of the articles, or
    of a page with paragraphs.
    """
    blocks = _blocks(source, True)
    if not any(b[1] for b in blocks) and source:
        every = _blocks(source, False)
        if any(b[1] for b in every) or not blocks and re.search(r"<p\b", source, re.IGNORECASE):
            blocks = every
    inside = [i for i, b in enumerate(blocks) if b[1]]
    size = lambda places: sum(len(blocks[i][0]) for i in places)
    if inside and (2 * len(inside) >= len(blocks) or 2 * size(inside) >= size(range(len(blocks)))):
        blocks = [b for i, b in enumerate(blocks) if b[1] or b[3] and i < inside[0]]
    return [(text, sure) for text, _, sure, _ in blocks]


def _blocks(source: str | None, by_name: bool) -> list[tuple[str, bool, bool, bool]]:
    """Text, whether it is in an article, whether it is content there, and whether it is a top headline, of every
    block that isn't skipped. A header inside an article belongs to it."""
    blocks: list[tuple[str, bool, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, skipped, in article
    content: str | None = None

    def close() -> None:
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            inside = bool(stack) and stack[-1][2]
            if text:
                blocks.append((text, inside, inside and content is not None, content == "h1"))
            parts = []

    for match in TOKEN.finditer(source or ""):
        tag = match[2]
        token = match[0]
        if tag is None:
            if token[0] != "<" or token == "<":
                if not (stack and stack[-1][1]):
                    parts.append(token)
            continue
        tag = tag.lower()
        if token[1] != "/":
            if tag in CELLS:
                parts.append(" ")
            if tag in BLOCKS:
                close()
                content = tag if tag in CONTENT else None
            if tag in BLOCKS and tag not in VOID and tag not in ("p", "hr"):
                above = stack[-1] if stack else ("", False, False)
                # An article goes by its name only inside another one.
                named = by_name and (tag != "article" or above[2])
                head = tag == "header" and above[2]
                skipped = above[1] or not head and _skips(tag, match[3], named)
                inside = above[2] or tag in ("article", "main") or 'role="main"' in match[3]
                stack.append((tag, skipped, inside and not skipped))
            elif tag in SKIPPED and tag not in BLOCKS or tag not in VOID and match[3] and _skips(tag, match[3], by_name):
                close()
                above = stack[-1] if stack else ("", False, False)
                stack.append((tag, True, False))
        else:
            if tag in BLOCKS:
                close()
                content = None
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close()
                    del stack[depth:]
                    break
    close()
    return blocks


def shared_lines(left: list[int], right: list[int]) -> list[int]:
    """Places in ``left`` of a longest common subsequence of both, by bit vectors."""
    places: dict[int, int] = {}
    for i, value in enumerate(left):
        places[value] = places.get(value, 0) | 1 << i
    every = (1 << len(left)) - 1
    state, history = every, []
    for value in right:
        match = state & places.get(value, 0)
        state = ((state + match) | (state - match)) & every
        history.append(state)
    out, row, column = [], len(right), len(left)
    while row and column:
        bit = 1 << (column - 1)
        if history[row - 1] & bit:
            column -= 1
        else:
            row -= 1
            if not (row and not history[row - 1] & bit):
                column -= 1
                out.append(column)
    return out[::-1]


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _line_hash(text: str) -> int:
    import zlib

    data = text.encode()
    return zlib.crc32(data) << 31 | zlib.adler32(data) >> 1


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            pages = [page_blocks(x.as_py()) for x in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("host"), part.column("path"),
                 pa.array([[_line_hash(t) for t, _ in page] for page in pages], pa.list_(pa.int64())),
                 pa.array([[len(t) for t, _ in page] for page in pages], pa.list_(pa.int32())),
                 pa.array([[s for _, s in page] for page in pages], pa.list_(pa.bool_()))],
                ["key", "host", "path", "lines", "lengths", "sure"],
            )


def _drops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, drops = [], []
        for row in batch.to_pylist():
            shared = shared_lines(row["lines"], row["other_lines"])
            size = sum(row["lengths"][i] for i in shared)
            shorter = max(1, min(sum(row["lengths"]), sum(row["other_lengths"])))
            gone = [i for i in shared if not row["sure"][i]]
            if gone and size <= COPY_SHARE * shorter:
                keys.append(row["key"])
                drops.append(gone)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(drops, pa.list_(pa.int32()))], ["key", "drops"]
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            out = []
            for source, drops in zip(part.column("html"), part.column("drops"), strict=True):
                gone = set(drops.as_py() or ())
                out.append("\n\n".join(t for i, (t, _) in enumerate(page_blocks(source.as_py())) if i not in gone))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"]
            )


def nearest_pages(prints: DataFrame) -> DataFrame:
    """``key, other``: each page's nearest page in path order within its host.

    Pages are sorted over the cluster in ranges of (host, path); neighbours across range borders come
    from the first and last page of each range. Of the page before and the page after, the one that
    shares the longer start of the path is nearer; in a tie it is the one before.
    """
    order = ["host", "path", "key"]
    ranged = prints.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(
        ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ranges"
    )
    page = F.struct("host", "path", "key").alias("page")
    line = Window.partitionBy("part").orderBy("at")
    inner = ranged.select("part", "at", "key", "host", "path", F.lag(page).over(line).alias("prev"), F.lead(page).over(line).alias("next"))
    # One row per range.
    borders = ranged.groupBy("part").agg(F.min_by(page, "at").alias("first"), F.max_by(page, "at").alias("last"))
    across = Window.orderBy("part")
    borders = borders.select("part", F.lag("last").over(across).alias("before"), F.lead("first").over(across).alias("after"))
    both = inner.join(borders, "part").select(
        "key", "host", "path", F.coalesce("prev", "before").alias("prev"), F.coalesce("next", "after").alias("next")
    )
    same = lambda side: F.col(f"{side}.host").eqNullSafe(F.col("host"))
    # Length of the common start: where a page and its neighbour first differ.
    size = lambda side: F.when(
        same(side) & F.col(side).isNotNull(),
        F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length("path"), F.length(f"{side}.path")))),
            F.lit(0),
            lambda n, i: F.when((n == i - 1) & (F.substr("path", i, F.lit(1)) == F.substr(F.col(f"{side}.path"), i, F.lit(1))), i).otherwise(n),
        ),
    ).otherwise(-1)
    sized = both.withColumn("p", size("prev")).withColumn("n", size("next"))
    nearer = F.when((F.col("p") >= F.col("n")) & (F.col("p") >= 0), F.col("prev.key")).when(F.col("n") >= 0, F.col("next.key"))
    return sized.select("key", nearer.alias("other")).where("other is not null")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text``: the main text of every page, blocks in page order joined by two line feeds.

    Null and empty pages give an empty text. A null URL is a host of its own with an empty path. Repeated rows
    count as one page when pairing and give repeated results; a page alone on its host is not compared.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    keyed = pages.select(
        F.xxhash64(id_col, url_col, html_col).alias("key"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.col(html_col).alias("html"), F.lower(F.regexp_extract(url, "^[a-zA-Z]+://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, "^[a-zA-Z]+://[^/?#]*([^#]*)", 1).alias("path"),
    )
    prints = written(
        keyed.select("key", "host", "path", "html").mapInArrow(
            _prints, "key long, host string, path string, lines array<long>, lengths array<int>, sure array<boolean>"
        ).dropDuplicates(["key"]),
        "page-prints",
    )
    pairs = nearest_pages(prints)
    # Pages whose every block is article content have nothing to delete.
    open_pages = prints.where(F.exists("sure", lambda s: ~s)).select("key", "lines", "lengths", "sure")
    other = prints.select(
        F.col("key").alias("other"), F.col("lines").alias("other_lines"), F.col("lengths").alias("other_lengths")
    )
    compared = open_pages.join(pairs, "key").join(other, "other")
    drops = written(compared.drop("other").mapInArrow(_drops, "key long, drops array<int>"), "page-drops")
    joined = keyed.select("key", "page_id", "url", "html").join(drops, "key", "left")
    kinds = pages.schema
    return joined.select("page_id", "url", "html", "drops").mapInArrow(
        _texts, f"page_id {kinds[id_col].dataType.simpleString()}, url string, text string"
    )


@query("op9_page_text")
def op9_page_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_pages(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
