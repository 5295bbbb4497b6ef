"""Registered queries: page text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import html as H
from quire.operators import infer as I
from quire.operators import pages as PG
from quire.plans import fixtures as FX
from quire.plans.catalog import register
from quire.plans.sql_fixtures import cte, with_ctes, ws_tokens
from quire.sources import events as EV
from quire.sources.tables import table

NL = "chr(10)"


def _q(s: str) -> str:
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in s.split("\n"))


cte("op_flags", ("order_pages",), f"""
  SELECT doc_id, page_no, content,
         coalesce(regexp_matches(lines[1], '{PG.TABLE_ROW_RE}'), false) AS first_is_table,
         coalesce(regexp_matches(lines[-1], '{PG.TABLE_ROW_RE}'), false) AS last_is_table
  FROM (SELECT doc_id, page_no, content,
               list_filter(string_split(content, {NL}), lambda l: NOT regexp_matches(l, '{PG.BLANK_RE}')
                           AND NOT regexp_matches(l, '{PG.PAGE_NUMBER_RE}')) AS lines
        FROM order_pages) x""")

cte("op_cont", ("op_flags",), """
  SELECT *, coalesce(lag(last_is_table) OVER (PARTITION BY doc_id ORDER BY page_no), false) AND first_is_table AS continued,
         lag(content) OVER (PARTITION BY doc_id ORDER BY page_no) AS prev_content
  FROM op_flags""")

cte("op_blocks", ("op_cont",), f"""
  SELECT doc_id, block_no, min(page_no) AS first_page, max(page_no) AS last_page, count(*) AS n_pages,
         string_agg(content, {NL} ORDER BY page_no) AS content
  FROM (SELECT *, CAST(sum(CASE WHEN continued THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS block_no FROM op_cont) x
  GROUP BY doc_id, block_no""")


@register("table_flags", with_ctes("SELECT doc_id, page_no, first_is_table, last_is_table FROM op_flags", "op_flags"))
def table_flags(spark, sf):
    return PG.table_flags(FX.order_pages(spark, sf)).select("doc_id", "page_no", "first_is_table", "last_is_table")


@register("table_continuation", with_ctes(
    "SELECT doc_id, page_no, first_is_table, last_is_table, continued FROM op_cont", "op_cont"))
def table_continuation(spark, sf):
    return PG.table_continuation(FX.order_pages(spark, sf)) \
        .select("doc_id", "page_no", "first_is_table", "last_is_table", "continued")


@register("page_context", with_ctes(
    "SELECT doc_id, page_no, continued, CASE WHEN continued THEN prev_content END AS previous_text FROM op_cont",
    "op_cont"))
def page_context(spark, sf):
    return PG.page_context(FX.order_pages(spark, sf)).select("doc_id", "page_no", "continued", "previous_text")


@register("stitch_tables", with_ctes("SELECT * FROM op_blocks", "op_blocks"))
def stitch_tables(spark, sf):
    # no order is in two parts
    return reduce(DataFrame.unionByName, [PG.stitch_tables(p) for p in FX.order_page_parts(spark, sf)])


@register("assemble_document", with_ctes(f"""
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_pages,
       string_agg('Page ' || CAST(page_no AS VARCHAR) || {NL} || content || {NL} || {NL}, '' ORDER BY page_no) AS text
FROM doc_pages GROUP BY doc_id""", "doc_pages"))
def assemble_document(spark, sf):
    return PG.assemble_document(FX.doc_pages(spark, sf))


def _progress(spark, sf):
    r = EV.parse_resume(EV.parse_events(FX.event_json(spark, sf)))
    return r.where(F.col("error").isNull()).select("doc_id", "page_counter")


@register("resume_pages", """
WITH ev AS (SELECT doc_id, body FROM (""" + with_ctes("SELECT * FROM event_json", "event_json") + """) e),
prog AS (
  SELECT doc_id, max(m.page_counter) AS page_counter
  FROM (SELECT doc_id, json_transform(json_extract_string(body, '$.Records[0].body'),
          '{"source_key":"VARCHAR","page_counter":"INTEGER"}') AS m
        FROM ev WHERE json_valid(body) AND json_extract_string(body, '$.Records[0].body') IS NOT NULL) x
  WHERE m.source_key IS NOT NULL GROUP BY doc_id)
SELECT p.doc_id, p.page_no FROM (""" + with_ctes("SELECT * FROM doc_pages", "doc_pages") + """) p
LEFT JOIN prog ON p.doc_id = prog.doc_id
WHERE p.page_no > coalesce(prog.page_counter, 0)""")
def resume_pages(spark, sf):
    return PG.resume_pages(FX.doc_pages(spark, sf), _progress(spark, sf)).select("doc_id", "page_no")


def _prompt_sql() -> str:
    a = PG.PAGE_PROMPT.split("{page}")
    b0, rest = PG.CONTINUED_PROMPT.split("{previous}")
    b1, b2 = rest.split("{page}")
    return (f"CASE WHEN continued THEN {_q(b0)} || prev_content || {_q(b1)} || content || {_q(b2)} "
            f"ELSE {_q(a[0])} || content || {_q(a[1])} END")


@register("build_requests", with_ctes(
    f"SELECT doc_id, page_no, continued, {_prompt_sql()} AS prompt FROM op_cont", "op_cont"))
def build_requests(spark, sf):
    return PG.build_requests(FX.order_pages(spark, sf)).select("doc_id", "page_no", "continued", "prompt")


@register("normalize_table", with_ctes(f"""
SELECT doc_id, block_no, CAST(max(CASE WHEN t THEN n_cols END) AS INTEGER) AS n_cols,
       CAST(sum(CASE WHEN t THEN n_rows ELSE 0 END) AS INTEGER) AS n_rows,
       coalesce(string_agg(md, {NL} ORDER BY g) FILTER (md <> ''), '') AS markdown
FROM (
  SELECT doc_id, block_no, g, t, n_cols, n_rows,
         CASE WHEN NOT t THEN plain WHEN n_rows = 0 THEN ''
              ELSE array_to_string(list_concat([rows[1]], ['|' || repeat('-|', n_cols)], rows[2:]), {NL}) END AS md
  FROM (SELECT *, list_transform(c, lambda r: '| ' || array_to_string(list_resize(r, n_cols, ' '), ' | ') || ' |') AS rows
        FROM (SELECT *, CAST(len(c) AS INTEGER) AS n_rows, CAST(coalesce(list_max(list_transform(c, lambda r: len(r))), 0) AS INTEGER) AS n_cols
              FROM (SELECT doc_id, block_no, g, bool_and(t) AS t, string_agg(l, {NL} ORDER BY i) AS plain,
                           coalesce(list(regexp_split_to_array(regexp_replace(l, '{PG.CELL_EDGE_RE}', '', 'g'), '{PG.CELL_SPLIT_RE}') ORDER BY i)
                             FILTER (t AND NOT regexp_matches(l, '{PG.SEPARATOR_RE}')), []) AS c
                    FROM (SELECT *, sum(CASE WHEN t IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, block_no ORDER BY i) AS g
                          FROM (SELECT *, lag(t) OVER (PARTITION BY doc_id, block_no ORDER BY i) AS before
                                FROM (SELECT doc_id, block_no, i, lines[i] AS l, regexp_matches(lines[i], '{PG.TABLE_ROW_RE}') AS t
                                      FROM (SELECT doc_id, block_no, lines, unnest(range(1, len(lines) + 1)) AS i
                                            FROM (SELECT doc_id, block_no, string_split(content, {NL}) AS lines FROM op_blocks) z) y) x) w) v
                    GROUP BY doc_id, block_no, g) u) s) r) q
GROUP BY doc_id, block_no HAVING sum(CASE WHEN t THEN n_rows ELSE 0 END) > 0""", "op_blocks"))
def normalize_table(spark, sf):
    return PG.normalize_table(stitch_tables(spark, sf)).select("doc_id", "block_no", "n_cols", "n_rows", "markdown")


@register("sheet_to_page", with_ctes(f"""
SELECT sheet, CAST(count(*) AS INTEGER) AS n_rows,
       string_agg('| ' || array_to_string(cells, ' | ') || ' |', {NL} ORDER BY row_no) AS page
FROM sheet_rows GROUP BY sheet""", "sheet_rows"))
def sheet_to_page(spark, sf):
    return PG.sheet_to_page(FX.sheet_rows(spark, sf))


@register("join_paragraphs", f"""
SELECT doc_id, CAST(len(string_split(text, {NL})) AS INTEGER) AS n_paragraphs, text FROM documents""")
def join_paragraphs(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return PG.join_paragraphs(PG.split_paragraphs(d))


@register("html_to_text", "SELECT page_id, " + H.html_to_text_sql("html") + " AS text FROM pages")
def html_to_text(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", H.html_to_text("html").alias("text"))


@register("batch_infer")
def batch_infer(spark, sf):
    r = PG.build_requests(FX.order_pages(spark, sf)).select("doc_id", "page_no", "prompt")
    return I.batch_infer(r, I.extractive_stub, "prompt").drop("prompt")


cte("requests_usage", ("doc_pages",), f"""
  SELECT doc_id, page_no, n AS input_tokens, n AS output_tokens,
         CASE WHEN n > 100 THEN 'max_tokens' ELSE 'end_turn' END AS stop_reason
  FROM (SELECT doc_id, page_no, CAST(len({ws_tokens('content')}) AS BIGINT) AS n FROM doc_pages) x""")


def requests_usage(spark, sf):
    p = FX.doc_pages(spark, sf)
    n = F.size(tx.ws_tokens("content")).cast("bigint")
    return p.select("doc_id", "page_no", n.alias("input_tokens"), n.alias("output_tokens"),
                    F.when(n > 100, F.lit("max_tokens")).otherwise(F.lit("end_turn")).alias("stop_reason"))


@register("token_usage", with_ctes("""
SELECT doc_id, count(*) AS n_requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
       CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
       CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) AS total_tokens,
       CAST(sum(CASE WHEN stop_reason = 'max_tokens' THEN 1 ELSE 0 END) AS BIGINT) AS n_truncated
FROM requests_usage GROUP BY doc_id""", "requests_usage"))
def token_usage(spark, sf):
    return I.token_usage(requests_usage(spark, sf))
