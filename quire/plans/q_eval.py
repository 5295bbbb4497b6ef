"""Registered queries: evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import evaluate as EV
from quire.operators.answer import answer_questions
from quire.plans import fixtures as FX
from quire.plans import q_retrieve
from quire.plans.catalog import register
from quire.plans.sql_fixtures import cte, sentences, with_ctes, word_tokens
from quire.sources.tables import table

K_EVAL = 3
NOW = "2024-01-31 00:00:00"
CONFIG = {"kb_search_type": "HYBRID", "kb_num_results": K_EVAL, "kb_filter": None,
          "chunking": "FIXED_SIZE 512/20", "model": "extractive-stub"}


def _answers(spark, sf):
    return answer_questions(None, FX.golden(spark, sf), k=K_EVAL, now=NOW, idx=q_retrieve._index(spark, sf))


def _scores(spark, sf):
    return EV.score(_answers(spark, sf), table(spark, sf, "labels"))


def _dtok(x: str) -> str:
    return f"list_distinct({word_tokens(x)})"


def _contain(part: str, whole: str) -> str:
    return f"(CASE WHEN len({part}) > 0 THEN len(list_intersect({part}, {whole})) / len({part}) END)"


def _mean_supported(text: str, ctx: str) -> str:
    v = f"list_transform({sentences(text)}, lambda s: coalesce({_contain(_dtok('s'), ctx)} >= 0.5, false))"
    return (f"(CASE WHEN len({sentences(text)}) > 0 THEN list_sum(list_transform({v}, "
            f"lambda b: CASE WHEN b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) / len({sentences(text)}) END)")


def _precision(contexts: str, gt: str) -> str:
    rel = (f"list_transform({contexts}, lambda c: CASE WHEN coalesce({_contain(_dtok(gt), _dtok('c'))} >= 0.5, false) "
           f"THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)")
    return f"""(SELECT CASE WHEN coalesce(list_sum(rel), 0) > 0 THEN
        list_sum(list_transform(list_zip(list_transform(rel, lambda r, i: list_sum(rel[1:i]) / i), rel),
                                lambda p: p[1] * p[2])) / list_sum(rel) ELSE 0.0::DOUBLE END
        FROM (SELECT {rel} AS rel) r)"""


HARM_RE = r"\b(" + "|".join(EV.HARM_TERMS) + r")\b"

cte("ev_base", ("answers",), f"""
  SELECT *, list_distinct(flatten(list_transform(contexts, lambda c: {word_tokens('c')}))) AS ctx FROM answers""")
cte("ev_scores", ("ev_base",), f"""
  SELECT b.qid, {_mean_supported('b.answer', 'b.ctx')} AS faithfulness,
         {_mean_supported('b.ground_truth', 'b.ctx')} AS context_recall,
         {_precision('b.contexts', 'b.ground_truth')} AS context_precision,
         CAST(coalesce(l.toxic, CASE WHEN regexp_matches(lower(b.answer), '{HARM_RE}') THEN 1 ELSE 0 END) AS INTEGER)
           AS harmfulness
  FROM ev_base b LEFT JOIN labels l ON l.doc_id = b.top_doc_id""")


@register("statements", with_ctes(f"""
SELECT qid, CAST(i - 1 AS INTEGER) AS stmt_no, st[i] AS statement
FROM (SELECT qid, st, unnest(range(1, len(st) + 1)) AS i FROM (SELECT qid, {sentences('answer')} AS st FROM answers) a) b""",
                                  "answers"))
def statements(spark, sf):
    return EV.statements(_answers(spark, sf))


@register("statement_verdicts", with_ctes(f"""
SELECT qid, CAST(i - 1 AS INTEGER) AS stmt_no, st[i] AS statement,
       coalesce({_contain(_dtok('st[i]'), 'ctx')} >= 0.5, false) AS supported
FROM (SELECT qid, ctx, st, unnest(range(1, len(st) + 1)) AS i
      FROM (SELECT qid, ctx, {sentences('answer')} AS st FROM ev_base) a) b""", "ev_base"))
def statement_verdicts(spark, sf):
    return EV.statement_verdicts(_answers(spark, sf))


for _m in ("faithfulness", "context_recall", "context_precision", "harmfulness"):
    def _mk(m):
        rnd = f"round({m}, 6)" if m != "harmfulness" else m

        @register(m, with_ctes(f"SELECT qid, {rnd} AS {m} FROM ev_scores", "ev_scores"))
        def q(spark, sf):
            c = F.round(m, 6) if m != "harmfulness" else F.col(m)
            return _scores(spark, sf).select("qid", c.alias(m))
        return q
    _mk(_m)

_SUMMARY_SQL = """
SELECT count(*) AS n_questions, round(avg(faithfulness), 6) AS faithfulness,
       round(avg(context_recall), 6) AS context_recall, round(avg(context_precision), 6) AS context_precision,
       round(avg(harmfulness), 6) AS harmfulness
FROM ev_scores"""


@register("run_summary", with_ctes(_SUMMARY_SQL, "ev_scores"))
def run_summary(spark, sf):
    s = EV.run_summary(_scores(spark, sf))
    return s.select("n_questions", *[F.round(c, 6).alias(c) for c in
                                     ("faithfulness", "context_recall", "context_precision", "harmfulness")])


@register("experiment_log", with_ctes(f"""
SELECT '{NOW.replace(' ', '_').replace(':', '-')}' AS run_time,
       {', '.join(f"'{v if v is not None else 'null'}' AS {k}" for k, v in CONFIG.items())},
       faithfulness, context_recall, context_precision, harmfulness, CAST(1 AS BIGINT) AS serial
FROM ({_SUMMARY_SQL}) s""", "ev_scores"))
def experiment_log(spark, sf):
    return EV.experiment_log(EV.run_summary(_scores(spark, sf)), CONFIG, NOW)
