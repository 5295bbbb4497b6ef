"""Page-text operators (T1-T10): table-boundary flags, continuation,
context carry, table stitching, document assembly, resume filter, request
building, Markdown table normalisation, sheets and paragraphs.

Per-document sequencing (previous page, running block number) runs per
``(doc_id, page range)`` with a small carry table between ranges, so a
document holding a large share of all pages does not land in one task; the
lag runs over the full page sequence (a resumed slice still sees the page
before it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators.sequence import DEFAULT_PAGE_BUCKET, prev_values, range_bucket, running_count
from quire.sources.tables import is_clustered_by

# Line patterns.
PAGE_NUMBER_RE = r"^\s*(Page\s+)?\d+\s*$"
BLANK_RE = r"^\s*$"
TABLE_ROW_RE = r"^\s*\|.*\|\s*$"
CELL_EDGE_RE = r"^\s*\|\s*|\s*\|\s*$"
CELL_SPLIT_RE = r"\s*\|\s*"
# A row of dashes (and colons) between header and body.
SEPARATOR_RE = r"^\s*\|?(\s*:?-+:?\s*\|)+(\s*:?-+:?\s*)?$"


def content_lines(content) -> Column:
    """Lines that are neither blank nor a bare page number."""
    return F.filter(F.split(tx.col(content), "\n"),
                    lambda l: ~l.rlike(BLANK_RE) & ~l.rlike(PAGE_NUMBER_RE))


def table_flags(pages: DataFrame, row_regex: str = TABLE_ROW_RE, content: str = "content") -> DataFrame:
    """Is the first / last content line of the page a table row?"""
    lines = content_lines(content)
    first, last = F.get(lines, 0), F.get(lines, F.size(lines) - 1)
    return (pages.withColumn("first_is_table", F.coalesce(first.rlike(row_regex), F.lit(False)))
            .withColumn("last_is_table", F.coalesce(last.rlike(row_regex), F.lit(False))))


def table_continuation(pages: DataFrame, page_bucket: int = DEFAULT_PAGE_BUCKET, **kw) -> DataFrame:
    """The previous page ends with a table and this one starts with one.
    The previous page comes from a page-range-bucketed lag, so a document
    holding a large share of all pages is still spread over tasks."""
    return _continuation(pages, page_bucket, **kw).drop("_b", "prev_content")


def _continuation(pages: DataFrame, page_bucket: int = DEFAULT_PAGE_BUCKET, **kw) -> DataFrame:
    """T2 keeping ``prev_content`` and the bucket column ``_b``."""
    f = table_flags(pages, **kw) if "first_is_table" not in pages.columns else pages
    x = prev_values(f, "doc_id", ["page_no"], range_bucket("page_no", page_bucket),
                    ["last_is_table", "content"])
    x = x.withColumn("continued", F.coalesce(F.col("prev_last_is_table"), F.lit(False))
                     & F.col("first_is_table"))
    return x.drop("prev_last_is_table")


def page_context(pages: DataFrame, content: str = "content", **kw) -> DataFrame:
    """Previous page's text, only where the page continues a table."""
    c = _continuation(pages, **kw)
    return c.withColumn("previous_text", F.when(F.col("continued"), F.col("prev_content"))) \
        .drop("prev_content", "_b")


def stitch_tables(pages: DataFrame, content: str = "content", page_bucket: int = DEFAULT_PAGE_BUCKET,
                  **kw) -> DataFrame:
    """T4: merge runs of continued pages into one block (gaps and islands:
    a running count of non-continued pages numbers the blocks). Pages that are
    partitioned by ``doc_id`` stay where they are."""
    if is_clustered_by(pages, "doc_id"):
        c = _blocks_in_place(pages, **kw)
    else:
        c = _continuation(pages, page_bucket=page_bucket, **kw).drop("prev_content")
        c = c.withColumn("_start", F.when(F.col("continued"), 0).otherwise(1))
        c = running_count(c, "doc_id", ["page_no"], None, "_start", "block_no").drop("_b")
    c = c.withColumn("block_no", F.col("block_no").cast("int"))
    return (c.groupBy("doc_id", "block_no")
            .agg(F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"),
                 F.count(F.lit(1)).alias("n_pages"),
                 F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_no", content))),
                                          lambda x: x[content]), "\n").alias("content")))


def _blocks_in_place(pages: DataFrame, **kw) -> DataFrame:
    """Pages with their ``block_no``, where each document's pages are together
    already: they are neither moved nor joined with anything."""
    f = table_flags(pages, **kw) if "first_is_table" not in pages.columns else pages
    w = W.partitionBy("doc_id").orderBy("page_no")
    f = f.withColumn("_start", F.when(F.coalesce(F.lag("last_is_table").over(w), F.lit(False)) & F.col("first_is_table"), 0).otherwise(1))
    no = F.sum("_start").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return f.withColumn("block_no", F.when(F.col("doc_id").isNotNull() & F.col("page_no").isNotNull(), no)).drop("_start")


def assemble_document(pages: DataFrame, content: str = "content") -> DataFrame:
    """T5: ``Page n\\n{text}\\n\\n`` in numeric page order, one row a doc."""
    g = pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_no", content))).alias("_p"))
    text = F.array_join(F.transform("_p", lambda x: F.concat(
        F.lit("Page "), x["page_no"].cast("string"), F.lit("\n"), x[content], F.lit("\n\n"))), "")
    return g.select("doc_id", F.size("_p").alias("n_pages"), text.alias("text"))


def resume_pages(pages: DataFrame, progress: DataFrame) -> DataFrame:
    """Keep pages after the recorded ``page_counter`` (0-based count of
    pages done). A resume past the last page yields no rows."""
    p = progress.groupBy("doc_id").agg(F.max("page_counter").alias("page_counter"))
    j = pages.join(p, "doc_id", "left")
    return j.where(F.col("page_no") > F.coalesce(F.col("page_counter"), F.lit(0))).drop("page_counter")


# Own wording of the two transcription requests (the model is delegated).
PAGE_PROMPT = ("Transcribe the text of this page as Markdown, not in a code block. Write tables as Markdown "
               "tables with the same number of columns in every row and a |-|-| row under the header; put "
               "the text of a merged cell in its top-left cell and ' ' in the others.\n\n"
               "Page:\n{page}")
CONTINUED_PROMPT = ("Transcribe the text of this page as Markdown, not in a code block. The previous page is "
                    "given so that a table or paragraph that continues here is completed, not split: keep "
                    "the same columns as the table above.\n\n"
                    "Previous page:\n{previous}\n\nPage:\n{page}")


def _fmt(template: str, **cols: Column) -> Column:
    import re
    parts = re.split(r"(\{[a-z]+\})", template)
    return F.concat(*[cols[p[1:-1]] if p.startswith("{") else F.lit(p) for p in parts if p])


def build_requests(pages: DataFrame, content: str = "content", **kw) -> DataFrame:
    """One transcription request a page; the continued variant carries
    the previous page."""
    c = page_context(pages, content, **kw)
    prompt = F.when(F.col("continued"), _fmt(CONTINUED_PROMPT, previous=F.col("previous_text"),
                                                page=F.col(content))) \
        .otherwise(_fmt(PAGE_PROMPT, page=F.col(content)))
    return c.withColumn("prompt", prompt)


def normalize_table(blocks: DataFrame, content: str = "content", row_regex: str = TABLE_ROW_RE) -> DataFrame:
    """Every table of a block padded to its widest row with ' ' cells,
    with one separator row after its first row; a separator that is there
    already is replaced. Other lines stay where they are, so tables with text
    between them stay apart. ``n_rows`` counts table rows without separators,
    ``n_cols`` is the widest table's. Blocks without table rows are dropped."""
    is_row = lambda l: l.rlike(row_regex)

    def cells(lines: Column) -> Column:
        rows = F.filter(lines, lambda r: ~r.rlike(SEPARATOR_RE))
        return F.transform(rows, lambda r: F.split(F.regexp_replace(r, CELL_EDGE_RE, ""), CELL_SPLIT_RE))

    def table_text(c: Column, n: Column) -> Column:
        row = lambda x: F.concat(F.lit("| "), F.array_join(F.concat(x, F.array_repeat(F.lit(" "), n - F.size(x))), " | "), F.lit(" |"))
        made = F.transform(c, row)
        sep = F.array(F.concat(F.lit("|"), F.repeat(F.lit("-|"), n)))
        return F.array_join(F.concat(F.slice(made, 1, 1), F.when(F.size(c) > 0, sep).otherwise(F.array().cast("array<string>")),
                                     F.slice(made, F.lit(2), F.greatest(F.size(made) - 1, F.lit(0)))), "\n")

    width = lambda c: F.coalesce(F.array_max(F.transform(c, lambda x: F.size(x))), F.lit(0))
    b = blocks.withColumn("_l", F.split(F.col(content), "\n"))
    b = b.where(F.exists("_l", lambda l: is_row(l) & ~l.rlike(SEPARATOR_RE))).withColumn("_t", F.transform("_l", is_row))
    # runs of lines: (is a table, its lines), cut out by where they start
    b = b.withColumn("_s", F.filter(F.sequence(F.lit(0), F.size("_l") - 1), lambda i: (i == 0) | (F.get("_t", i) != F.get("_t", i - 1))))
    b = b.withColumn("_r", F.transform("_s", lambda s, j: F.struct(F.get("_t", s).alias("t"), F.slice(
        "_l", s + 1, F.coalesce(F.get("_s", j + 1), F.size("_l")) - s).alias("lines"))))
    b = b.withColumn("_c", F.transform("_r", lambda r: F.when(r["t"], cells(r["lines"]))))
    text = F.zip_with("_r", "_c", lambda r, c: F.when(r["t"], table_text(c, width(c))).otherwise(F.array_join(r["lines"], "\n")))
    return (b.withColumn("n_cols", F.array_max(F.transform("_c", lambda c: F.when(c.isNotNull(), width(c)))))
            .withColumn("n_rows", F.aggregate("_c", F.lit(0), lambda a, c: a + F.when(c.isNull(), 0).otherwise(F.size(c))))
            .withColumn("markdown", F.array_join(F.filter(text, lambda x: x != ""), "\n")).drop("_l", "_t", "_s", "_r", "_c"))


def sheet_to_page(rows: DataFrame) -> DataFrame:
    """One sheet = one page of Markdown rows in row order."""
    g = rows.groupBy("sheet").agg(F.sort_array(F.collect_list(F.struct("row_no", "cells"))).alias("_r"))
    lines = F.transform("_r", lambda x: F.concat(F.lit("| "), F.array_join(x["cells"], " | "), F.lit(" |")))
    return g.select("sheet", F.size("_r").alias("n_rows"), F.array_join(lines, "\n").alias("page"))


def split_paragraphs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Inverse of T10: one row per paragraph with its position."""
    keep = [c for c in docs.columns if c != text]
    return docs.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("para_no", "paragraph"))


def join_paragraphs(paras: DataFrame, key: str = "doc_id") -> DataFrame:
    """Paragraphs joined by newline in order."""
    g = paras.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("para_no", "paragraph"))).alias("_p"))
    return g.select(key, F.size("_p").alias("n_paragraphs"),
                    F.array_join(F.transform("_p", lambda x: x["paragraph"]), "\n").alias("text"))
