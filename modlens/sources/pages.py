"""Comment records and text blocks from stored HTML pages."""

from __future__ import annotations

import html as html_lib
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlens.functions import text as tx
from modlens.functions.once import evaluate_once
from modlens.operators.corpus import keep_first

# Markup of the comment pages and the entities decoded in texts.
HIDDEN_BLOCKS = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
TAG = r"(?s)<[^>]*>"
COMMENT_CLASS, BODY_CLASS, SCORE_CLASSES, TITLE_CLASS = "comment", "md", {"score", "unvoted"}, "title"
NEXT_LINK = r'''(?s)<span[^>]*\sclass=["']next-button["'][^>]*>\s*<a[^>]*\shref=(?:"([^"]*)"|'([^']*)')'''
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# End of fixed values.


def visible_html(html: Column) -> Column:
    """Markup without scripts, styles and comments."""
    return F.regexp_replace(html, HIDDEN_BLOCKS, "")


def decoded(text: Column) -> Column:
    """Character references, named and numeric, as the characters they stand for."""

    @F.pandas_udf("string")
    def unescape(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: t if t is None else html_lib.unescape(t))

    return F.when(F.contains(text, F.lit("&")), unescape(text)).otherwise(text)


def markup_text(html: Column) -> Column:
    """Text of a piece of markup: tags become blanks, character references are decoded, white space collapses."""
    return tx.collapse_spaces(decoded(F.regexp_replace(html, TAG, " ")))


def blocks(pages: DataFrame, key: str, html: str = "html", tag: str = "p", title_tag: str = "h1") -> DataFrame:
    """One row per ``tag`` block of each page: key, position, text and the page's title."""
    page = pages.select(F.col(key), visible_html(F.col(html)).alias("_h"))
    found = F.regexp_extract_all("_h", F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    title = markup_text(F.regexp_extract("_h", rf"(?is)<{title_tag}(?:\s[^>]*)?>(.*?)</{title_tag}>", 1))
    rows = page.select(key, title.alias("post_title"), F.posexplode(found).alias("pos", "_block"))
    return rows.select(key, "pos", markup_text(F.col("_block")).alias("text"), "post_title")


class _CommentPage(HTMLParser):
    """Comments of one page: id, body text (null without a body), score text; and the page's title."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, object]] = []  # tag, and what it began
        self.comments: list[dict] = []
        self.title: list[str] | None = None

    def handle_starttag(self, tag: str, attributes) -> None:
        given = dict(attributes)
        classes = set((given.get("class") or "").split())
        inside = next((began for _, began in reversed(self.open) if isinstance(began, dict)), None)
        began: object = None
        if tag == "div" and COMMENT_CLASS in classes:
            began = {"id": given.get("data-fullname") or given.get("id") or "", "body": None, "score": None}
            self.comments.append(began)
        elif inside is not None and BODY_CLASS in classes and inside["body"] is None:
            began = inside["body"] = []
        elif inside is not None and SCORE_CLASSES <= classes and inside["score"] is None:
            began = inside["score"] = []
        elif tag == "a" and TITLE_CLASS in classes and self.title is None:
            began = self.title = []
        if tag not in VOID_TAGS:
            self.open.append((tag, began))

    def handle_startendtag(self, tag: str, attributes) -> None:
        if tag not in VOID_TAGS:  # "<div/>" opens an element like "<div>" does
            self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for _, began in reversed(self.open):
            if isinstance(began, list):
                began.append(data)
            if isinstance(began, dict):
                break


def page_comments(html: str | None) -> tuple[str, list[dict]]:
    """The title of a page and its comments, in order: id, body and score, each null if the page has none."""
    page = _CommentPage()
    page.feed(html or "")
    page.close()

    def text(parts):
        return None if parts is None else " ".join(p.strip() for p in parts if p.strip())

    found = [{"id": c["id"], "body": text(c["body"]), "score": text(c["score"])} for c in page.comments]
    return "".join(page.title or []), found


def comment_records(
    pages: DataFrame, html: str = "html", order_by=(), min_words: int = 4, subreddit: str | None = None, fetched: str | None = None
) -> DataFrame:
    """Raw comment rows of discussion pages, first copy of each id, short ones left out afterwards.

    Body and score are a comment's own: a reply inside it has its own row.  Comments without an id or a body are
    skipped.  ``subreddit`` and ``fetched`` name the columns that hold a page's community and the time it was fetched
    (``created_utc`` of its rows); without them the first is empty and the second null.
    """
    extra = [F.lit("") if subreddit is None else F.col(subreddit), F.lit(None) if fetched is None else F.col(fetched)]
    rows = pages.select(*order_by, extra[0].cast("string").alias("subreddit"), extra[1].cast("timestamp").alias("created_utc"), F.col(html).alias("_h"))
    n = len(rows.columns) - 1
    schema = T.StructType(rows.schema.fields[:n]).add("_title", T.StringType()).add(
        "_found", T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in ("id", "body", "score")]))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(f, pa.string()) for f in ("id", "body", "score")]))
        for batch in batches:
            got = [page_comments(h) for h in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array([t for t, _ in got], pa.string()), pa.array([c for _, c in got], kind)], schema.names
            )

    cut = rows.mapInArrow(run, schema).select(*rows.columns[:n], "_title", F.posexplode("_found").alias("pos", "_c"))
    named = cut.select("*", F.col("_c.id").alias("id")).filter("id <> ''")
    first = keep_first(named, ["id"], [*order_by, "pos"])
    kept = evaluate_once(first.filter("_c.body is not null"), {"text": tx.safe_text(F.col("_c.body"))})
    enough = tx.word_count(F.col("text"), collapsed=True) >= min_words
    return kept.filter(enough).select(
        *order_by, "id", "text", *[c for c in ("subreddit",) if c not in order_by], tx.safe_text(F.col("_title")).alias("post_title"),
        tx.first_int(F.col("_c.score")).alias("upvotes"), *[c for c in ("created_utc",) if c not in order_by], F.lit("reddit").alias("source"),
    )


def next_cursor(html: Column, name: str = "after") -> Column:
    """Cursor of the page's next-page link, or null."""
    link = F.concat(F.regexp_extract(html, NEXT_LINK, 1), F.regexp_extract(html, NEXT_LINK, 2))
    return tx.query_param(F.replace(link, F.lit("&amp;"), F.lit("&")), name)
