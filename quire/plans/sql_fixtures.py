"""DuckDB twins of ``plans.fixtures`` as named CTEs.

``with_ctes(body, *names)`` prefixes a query with the CTEs it needs (and
their dependencies) so each oracle string runs on the bare driver tables.
"""

from __future__ import annotations

import re

NL = "chr(10)"

# Extension by doc_id % 12 (same list as the Spark fixture).
_EXTS = "['.pdf', '.ppt', '.pptx', '.docx', '.xlsx', '.xls', '.excel', '.html', '.mp4', '.csv', '.doc', '.PDF']"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


# Shared scalar snippets (DuckDB dialect).
def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def ws_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def word_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\pL\\pN]+'), lambda t: t <> '')"


def sentences(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, '[.!?]+(\\s+|$)'), "
            f"lambda s: {strip('s')}), lambda s: s <> '')")


def first_sentence(x: str) -> str:
    return f"coalesce({sentences(x)}[1], '')"


def last_line(x: str) -> str:
    return strip(f"string_split({x}, {NL})[-1]")


def url_decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


cte("object_keys", (), f"""
  SELECT doc_id, 'raw-' || source AS bucket,
         'raw/' || source || '/doc+' || CAST(doc_id AS VARCHAR) || '%20v1' || ext AS raw_key, ext
  FROM (SELECT doc_id, source, {_EXTS}[(doc_id % 12) + 1] AS ext FROM documents) x""")

cte("event_json", ("object_keys",), """
  SELECT doc_id, CASE
    WHEN doc_id % 37 = 0 THEN '{"Records":[{"s3":{"bucket":{"name":"' || bucket || '"}'
    WHEN doc_id % 10 = 0 THEN '{"Records":[{"body":"' ||
        '{\\"source_bucket\\":\\"' || bucket || '\\",' ||
        CASE WHEN doc_id % 40 = 10 THEN '' ELSE '\\"source_key\\":\\"' || raw_key || '\\",' END ||
        '\\"page_counter\\":' || CAST(doc_id % 4 AS VARCHAR) ||
        ',\\"previous_text\\":\\"carry ' || CAST(doc_id AS VARCHAR) ||
        '\\",\\"s3_output_key\\":\\"' || raw_key || '.txt\\"}' ||
        '","receiptHandle":"rh-' || CAST(doc_id AS VARCHAR) || '"}]}'
    ELSE '{"Records":[' ||
        '{"s3":{"bucket":{"name":"' || bucket || '"},"object":{"key":"' || raw_key || '"}}}' ||
        CASE WHEN doc_id % 3 = 0 THEN ',{"s3":{"bucket":{"name":"interim"},"object":{"key":"converted/doc+'
             || CAST(doc_id AS VARCHAR) || '.pdf"}}}' ELSE '' END || ']}'
  END AS body
  FROM object_keys""")

cte("doc_pages", (), f"""
  SELECT doc_id, CAST(page_no AS INTEGER) AS page_no,
         array_to_string(lines[(page_no - 1) * 10 + 1 : page_no * 10], {NL}) AS content
  FROM (SELECT doc_id, lines,
               unnest(range(1, CAST(greatest(ceil(len(lines) / 10.0), 1) AS BIGINT) + 1)) AS page_no
        FROM (SELECT doc_id, string_split(text, {NL}) AS lines FROM documents) a) b""")

cte("page_names", ("doc_pages",), """
  SELECT doc_id, 'page_' || CAST(page_no AS VARCHAR) || '.png' AS name FROM doc_pages
  UNION ALL SELECT doc_id, 'cover.png' AS name FROM doc_pages WHERE page_no = 1""")

cte("order_pages", (), f"""
  SELECT doc_id, page_no,
         CASE WHEN doc_id % 2 = 0 AND page_no = 1 THEN '# Order ' || CAST(doc_id AS VARCHAR) || {NL} ELSE '' END
         || body ||
         CASE WHEN doc_id % 5 = 0 AND page_no % 2 = 1 THEN {NL} || 'Page ' || CAST(page_no AS VARCHAR) ELSE '' END
         AS content
  FROM (SELECT doc_id, page_no, string_agg(line, {NL} ORDER BY rn) AS body
        FROM (SELECT l_orderkey AS doc_id,
                     CAST((rn - 1) // 3 + 1 AS INTEGER) AS page_no, rn, line
              FROM (SELECT l_orderkey,
                           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                               l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                               l_linestatus, l_shipdate) AS rn,
                           '| ' || CAST(l_linenumber AS VARCHAR) || ' | ' || CAST(l_partkey AS VARCHAR)
                           || ' | ' || CAST(l_suppkey AS VARCHAR) || ' | '
                           || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' | ' || l_returnflag || ' |'
                           || CASE WHEN l_linestatus = 'O' THEN ' O |' ELSE '' END AS line
                    FROM lineitem) r) s
        GROUP BY doc_id, page_no) t""")

cte("sheet_rows", (), """
  SELECT 'nation' AS sheet, CAST(n_nationkey AS BIGINT) AS row_no,
         [CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)] AS cells FROM nation
  UNION ALL
  SELECT 'region', CAST(r_regionkey AS BIGINT), [CAST(r_regionkey AS VARCHAR), r_name] FROM region""")

cte("kb_meta", (), """
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'external' ELSE 'internal' END AS exposure,
         split_part(text, chr(10), 1) AS title,
         CAST(1704067200 + 86400 * (doc_id % 365) AS BIGINT) AS created_date_epoch
  FROM documents""")

cte("answers_raw", (), """
  SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS output FROM documents""")

cte("calls", (), """
  SELECT event_id AS call_id,
         ['createClaim', 'gatherEvidence', 'sendReminder'][(event_id % 3) + 1] AS function,
         list_filter(list_filter(
           ['claimType', 'policyNumber', 'claimId', 'reminderType', 'note'],
           lambda k: (event_id % 3 = 0 AND k IN ('claimType', 'policyNumber'))
                  OR (event_id % 3 <> 0 AND k = 'claimId')
                  OR (event_id % 3 = 2 AND k = 'reminderType' AND value > 10)
                  OR (event_id % 7 = 0 AND k = 'note')),
           lambda k: NOT (event_id % 5 = 0 AND k IN ('policyNumber', 'claimId'))) AS param_keys
  FROM events""")

cte("golden", (), f"""
  SELECT item_id AS qid, {first_sentence('text')} AS question, text AS ground_truth FROM benchmark""")


def labels_json_sql(frames: str) -> str:
    return ("'[' || array_to_string(list_transform(" + frames + ", lambda f: '{\"Frame ' || "
            "CAST(f.frame_no AS VARCHAR) || '\": [' || array_to_string(list_transform(f.labels, "
            "lambda l: '\"' || l || '\"'), ', ') || ']}'), ', ') || ']'")


cte("detections", (), """
  SELECT l_orderkey // 150 AS video, l_linenumber AS frame_no, 'L' || CAST(l_partkey % 25 AS VARCHAR) AS label,
         max(l_quantity * 2) AS confidence
  FROM lineitem GROUP BY 1, 2, 3""")

cte("frame_lab", ("detections",), """
  SELECT video, frame_no, label, confidence,
         CAST(row_number() OVER (PARTITION BY video, frame_no ORDER BY confidence DESC, label) AS INTEGER) AS rank
  FROM detections WHERE confidence >= 70
  QUALIFY rank <= 10""")

cte("video_frames", ("detections", "frame_lab"), """
  SELECT video, list({'frame_no': frame_no, 'labels': labels} ORDER BY frame_no) AS frames,
         CAST(count(*) AS INTEGER) AS n_frames
  FROM (SELECT f.video, f.frame_no,
               list_filter(list(l.label ORDER BY l.rank), lambda x: x IS NOT NULL) AS labels
        FROM (SELECT DISTINCT video, frame_no FROM detections) f
        LEFT JOIN frame_lab l ON f.video = l.video AND f.frame_no = l.frame_no
        GROUP BY f.video, f.frame_no) g
  GROUP BY video""")

cte("transcripts", (), """
  SELECT doc_id, CAST(doc_id AS VARCHAR) || '.mp4_transcription_' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)
         || '.json' AS key,
         CAST(to_json({'results': {'transcripts': [{'transcript': text}]}}) AS VARCHAR) AS body
  FROM documents""")

cte("label_files", ("video_frames",), """
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) || '.mp4_labels_' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 8)
         || '.json' AS key, """ + labels_json_sql("v.frames") + """ AS body
  FROM documents d JOIN video_frames v ON d.doc_id // 10 = v.video
  WHERE d.doc_id % 7 <> 0""")


def chunks_sql(max_tokens: int = 512, overlap_pct: int = 20, source: str = "documents") -> str:
    overlap = max_tokens * overlap_pct // 100
    stride = max_tokens - overlap
    return f"""
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_no,
         CAST(s AS INTEGER) AS start_token, CAST(len(piece) AS INTEGER) AS n_tokens,
         array_to_string(piece, ' ') AS text, raw_key
  FROM (SELECT doc_id, s, tok[s + 1 : s + {max_tokens}] AS piece, raw_key
        FROM (SELECT doc_id, tok, raw_key, unnest(list_filter(range(0, greatest(len(tok), 1), {stride}),
                     lambda s: s = 0 OR s + {overlap} < len(tok))) AS s
              FROM (SELECT d.doc_id, {ws_tokens('d.text')} AS tok, k.raw_key
                    FROM {source} d LEFT JOIN object_keys k ON d.doc_id = k.doc_id) a) b) c"""


cte("chunks512", ("object_keys",), chunks_sql(512, 20))

cte("kb_chunks", ("chunks512",), """
  SELECT sha256(CAST(doc_id AS VARCHAR) || ':' || CAST(chunk_no AS VARCHAR)) AS chunk_id, doc_id, chunk_no, text,
         '{"source_uri":"' || raw_key || '","doc_id":' || CAST(doc_id AS VARCHAR) || ',"chunk_no":'
         || CAST(chunk_no AS VARCHAR) || '}' AS metadata
  FROM chunks512""")

cte("vec_queries", (), """
  SELECT CAST(label AS BIGINT) AS qid, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS qvec
  FROM (SELECT label, list(x ORDER BY pos) AS v
        FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x
              FROM (SELECT label, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings) a
              GROUP BY label, pos) b
        GROUP BY label) c""")

# Lexical index and searches over kb_chunks for the golden questions.
cte("lx_toks", ("kb_chunks",), f"SELECT chunk_id, {word_tokens('text')} AS w FROM kb_chunks")
cte("lx_dl", ("lx_toks",), "SELECT chunk_id, len(w) AS dl FROM lx_toks")
cte("lx_post", ("lx_toks",), """
  SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(w) AS term FROM lx_toks) a GROUP BY chunk_id, term""")
cte("lx_stats", ("lx_dl",), "SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avgdl FROM lx_dl")
cte("lx_terms", ("lx_post", "lx_stats"), """
  SELECT term, df, ln(1.0::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) AS idf_bm25,
         ln((n + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) AS idf
  FROM (SELECT term, count(*) AS df FROM lx_post GROUP BY term) t, lx_stats""")
cte("lx_qterms", ("golden",), f"""
  SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({word_tokens('question')}) AS term FROM golden) a
  GROUP BY qid, term""")
cte("lx_bm25", ("lx_qterms", "lx_terms", "lx_post", "lx_dl", "lx_stats"), """
  SELECT q.qid, p.chunk_id,
         sum(q.qtf * t.idf_bm25 * p.tf * 2.2::DOUBLE / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.dl / s.avgdl))) AS score
  FROM lx_qterms q JOIN lx_terms t ON q.term = t.term JOIN lx_post p ON p.term = q.term
       JOIN lx_dl d ON d.chunk_id = p.chunk_id, lx_stats s
  GROUP BY q.qid, p.chunk_id""")
cte("lx_cnorm", ("lx_post", "lx_terms"), """
  SELECT p.chunk_id, sqrt(sum(pow(p.tf * t.idf, 2))) AS cnorm FROM lx_post p JOIN lx_terms t ON p.term = t.term
  GROUP BY p.chunk_id""")
cte("lx_qw", ("lx_qterms", "lx_terms"), """
  SELECT q.qid, q.term, q.qtf * t.idf AS wq FROM lx_qterms q JOIN lx_terms t ON q.term = t.term""")
cte("lx_sem", ("lx_qw", "lx_post", "lx_terms", "lx_cnorm"), """
  SELECT a.qid, a.chunk_id, a.dot / (n.qnorm * c.cnorm) AS score
  FROM (SELECT w.qid, p.chunk_id, sum(w.wq * p.tf * t.idf) AS dot
        FROM lx_qw w JOIN lx_post p ON p.term = w.term JOIN lx_terms t ON t.term = w.term
        GROUP BY w.qid, p.chunk_id) a
  JOIN (SELECT qid, sqrt(sum(pow(wq, 2))) AS qnorm FROM lx_qw GROUP BY qid) n ON n.qid = a.qid
  JOIN lx_cnorm c ON c.chunk_id = a.chunk_id
  WHERE n.qnorm > 0 AND c.cnorm > 0""")


def topk_sql(src: str, k: int, score: str = "score", desc: bool = True) -> str:
    o = "DESC" if desc else "ASC"
    if src.lstrip().startswith("("):
        src = src + " x"
    return (f"SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY round({score}, 9) {o}, chunk_id) AS INTEGER)"
            f" AS rank FROM {src} QUALIFY rank <= {k}")


cte("bm25_top3", ("lx_bm25",), topk_sql("lx_bm25", 3))
cte("bm25_top10", ("lx_bm25",), topk_sql("lx_bm25", 10))
cte("sem_top3", ("lx_sem",), topk_sql("(SELECT * FROM lx_sem WHERE score > 0)", 3))
cte("sem_top10", ("lx_sem",), topk_sql("(SELECT * FROM lx_sem WHERE score > 0)", 10))
cte("hyb_top3", ("bm25_top10", "sem_top10"), topk_sql("""(SELECT qid, chunk_id, sum(1.0::DOUBLE / (60.0::DOUBLE + rank)) AS score
   FROM (SELECT qid, chunk_id, rank FROM bm25_top10 UNION ALL SELECT qid, chunk_id, rank FROM sem_top10) u
   GROUP BY qid, chunk_id)""", 3))


def lexical_family(suffix: str, chunks: str) -> None:
    """The lexical index CTEs again, over another chunk table."""
    names = ("lx_toks", "lx_dl", "lx_post", "lx_stats", "lx_terms", "lx_bm25")
    for name in names:
        deps, sql = CTES[name]
        swap = {n: n + suffix for n in names} | {"kb_chunks": chunks}
        for old, new in swap.items():
            sql = re.sub(rf"\b{old}\b", new, sql)
        cte(name + suffix, tuple(swap.get(d, d) for d in deps), sql)


#: Chunks that a metadata filter admits.
FILTERED = "m.exposure = 'external' AND m.created_date_epoch > 1704067200 + 86400 * 60"
cte("kb_admitted", ("kb_chunks", "kb_meta"), f"""
  SELECT c.chunk_id FROM kb_chunks c JOIN kb_meta m ON m.doc_id = c.doc_id WHERE {FILTERED}""")
for _k, _src in (("bm25", "lx_bm25"), ("sem", "lx_sem")):
    cte(f"{_k}_admitted", (_src, "kb_admitted"), f"SELECT s.* FROM {_src} s JOIN kb_admitted a ON a.chunk_id = s.chunk_id")
cte("bm25_admitted3", ("bm25_admitted",), topk_sql("bm25_admitted", 3))
cte("bm25_admitted10", ("bm25_admitted",), topk_sql("bm25_admitted", 10))
cte("sem_admitted10", ("sem_admitted",), topk_sql("(SELECT * FROM sem_admitted WHERE score > 0)", 10))
cte("hyb_admitted5", ("bm25_admitted10", "sem_admitted10"), topk_sql("""(SELECT qid, chunk_id, sum(1.0::DOUBLE / (60.0::DOUBLE + rank)) AS score
   FROM (SELECT qid, chunk_id, rank FROM bm25_admitted10 UNION ALL SELECT qid, chunk_id, rank FROM sem_admitted10) u
   GROUP BY qid, chunk_id)""", 5))


# The offline embedding model (64 places) over kb_chunks, and its dense search.
def _place(term: str) -> str:
    return f"CAST('0x' || substr(md5({term}), 1, 8) AS BIGINT) % 64"


cte("emb_tf", ("lx_toks",), f"""
  SELECT chunk_id, p, count(*) AS tf FROM (SELECT chunk_id, {_place('term')} AS p FROM (SELECT chunk_id, unnest(w) AS term FROM lx_toks) a) b
  GROUP BY chunk_id, p""")
cte("emb_idf", ("emb_tf", "lx_stats"), """
  SELECT r.p, ln((n + 1.0::DOUBLE) / (coalesce(df, 0) + 1.0::DOUBLE)) AS idf
  FROM (SELECT unnest(range(64)) AS p) r LEFT JOIN (SELECT p, count(*) AS df FROM emb_tf GROUP BY p) d ON d.p = r.p, lx_stats""")


def _vectors(ids: str, key: str, tf: str) -> str:
    return f"""
  SELECT {key}, list(CASE WHEN norm > 0 THEN x / norm ELSE 0.0::DOUBLE END ORDER BY p) AS v FROM (
    SELECT {key}, p, x, sqrt(sum(x * x) OVER (PARTITION BY {key})) AS norm FROM (
      SELECT i.{key}, m.p, coalesce(t.tf, 0) * m.idf AS x
      FROM {ids} i CROSS JOIN emb_idf m LEFT JOIN {tf} t ON t.{key} = i.{key} AND t.p = m.p) a) b GROUP BY {key}"""


cte("emb_chunks", ("lx_toks", "emb_tf", "emb_idf"), _vectors("lx_toks", "chunk_id", "emb_tf"))
cte("emb_qtf", ("lx_qterms",), f"SELECT qid, {_place('term')} AS p, sum(qtf) AS tf FROM lx_qterms GROUP BY 1, 2")
cte("emb_questions", ("golden", "emb_qtf", "emb_idf"), _vectors("golden", "qid", "emb_qtf"))
cte("dense_all", ("emb_chunks", "emb_questions"), """
  SELECT q.qid, c.chunk_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance
  FROM emb_questions q, emb_chunks c
  WHERE list_sum(list_transform(q.v, lambda x: abs(x))) > 0 AND list_sum(list_transform(c.v, lambda x: abs(x))) > 0""")
cte("dense_top10", ("dense_all",), topk_sql("dense_all", 10, "distance", False))
cte("dense_top5", ("dense_all",), topk_sql("dense_all", 5, "distance", False))
cte("hyb_dense5", ("bm25_top10", "dense_top10"), topk_sql("""(SELECT qid, chunk_id, sum(1.0::DOUBLE / (60.0::DOUBLE + rank)) AS score
   FROM (SELECT qid, chunk_id, rank FROM bm25_top10 UNION ALL SELECT qid, chunk_id, rank FROM dense_top10) u
   GROUP BY qid, chunk_id)""", 5))
