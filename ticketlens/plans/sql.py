"""DuckDB SQL for the oracle side: the same views and rules as plain SQL.

Patterns, stop lists, label orders and rules come from the same Python
constants the Spark plans use. NFKC has no DuckDB function; the driver
documents contain no text NFKC changes, so the oracle omits it (the NFKC
branch is covered by literal-row tests).
"""

from __future__ import annotations

from ..functions import stopwords
from ..functions import text as tx
from ..sources import tables
from . import views


def q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def str_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def re_sub(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def unicode_strip(expr: str) -> str:
    return re_sub(expr, tx.EDGE_SPACE_PATTERN, "")


def combine_text(subject: str, body: str) -> str:
    s = unicode_strip(f"coalesce({subject}, '')")
    b = unicode_strip(f"coalesce({body}, '')")
    return unicode_strip(f"({s} || ' ' || {b})")


def normalize_chars(expr: str) -> str:
    out = f"lower({expr})"
    for pattern, repl in tx.REPLACEMENT_CHAIN:
        out = re_sub(out, pattern, repl)
    return f"trim({out})"


def language_for_text(expr: str) -> str:
    return f"lower(coalesce({expr}, 'unknown'))"


def language_for_slices(expr: str) -> str:
    cleaned = unicode_strip(f"lower(coalesce({expr}, 'unknown'))")
    return f"CASE WHEN {cleaned} = '' THEN 'unknown' ELSE {cleaned} END"


def remove_stop_words(tokens: str, language: str) -> str:
    branches = []
    for prefix, words in stopwords.lists_by_prefix():
        kept = f"list_filter({tokens}, lambda t: NOT list_contains({str_list(words)}, t))" if words else tokens
        branches.append(f"WHEN starts_with({language}, {q(prefix)}) THEN {kept}")
    return f"CASE {' '.join(branches)} ELSE {tokens} END"


def metric_slug(expr: str) -> str:
    return re_sub(unicode_strip(f"lower({expr})"), tx.SPACE_RUN_PATTERN, "_")


def run_slug(expr: str) -> str:
    stripped = re_sub(re_sub(expr, r"[^A-Za-z0-9_.\-]+", "-"), r"^-+|-+$", "")
    return f"CASE WHEN {stripped} = '' THEN 'run' ELSE {stripped} END"


# ---------------------------------------------------------------- ticket CTEs

TICKETS = """tickets AS (
  SELECT d.doc_id AS id,
         CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, 1, strpos(d.text, chr(10)) - 1) END AS subject,
         CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1) ELSE d.text END AS body,
         d.lang AS language,
         CAST(l.quality AS VARCHAR) AS quality,
         CAST(l.toxic AS VARCHAR) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def prepared_ctes() -> str:
    """tickets → t_text → t_chars → t_split → prepared(words, clean, length) → grams."""
    return f"""{TICKETS},
t_text AS (SELECT *, {combine_text('subject', 'body')} AS ticket_text FROM tickets),
t_chars AS (SELECT *, {normalize_chars('ticket_text')} AS chars FROM t_text),
t_split AS (SELECT *, CASE WHEN chars = '' THEN []::VARCHAR[] ELSE string_split(chars, ' ') END AS split FROM t_chars),
t_words AS (SELECT *, {remove_stop_words('split', language_for_text('language'))} AS words FROM t_split),
prepared AS (SELECT *, array_to_string(words, ' ') AS ticket_text_clean, CAST(length(array_to_string(words, ' ')) AS BIGINT) AS ticket_text_length FROM t_words),
t_feat AS (SELECT *, list_filter(words, lambda t: length(t) >= 2) AS feat FROM prepared),
grams AS (SELECT *,
  feat
  || CASE WHEN len(feat) >= 2 THEN list_transform(range(1, len(feat)), lambda i: feat[i] || ' ' || feat[i + 1]) ELSE []::VARCHAR[] END
  || CASE WHEN len(feat) >= 3 THEN list_transform(range(1, len(feat) - 1), lambda i: feat[i] || ' ' || feat[i + 1] || ' ' || feat[i + 2]) ELSE []::VARCHAR[] END
  AS grams FROM t_feat)"""


def tf_ctes() -> str:
    return f"""{prepared_ctes()},
tf AS (SELECT id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT id, unnest(grams) AS term FROM grams) GROUP BY id, term),
n_docs AS (SELECT count(*) AS n FROM documents),
dfs AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
idf AS (SELECT term, df, ln((1.0 + (SELECT n FROM n_docs)) / (1.0 + df)) + 1.0 AS idf FROM dfs
        WHERE df <= 0.95 * (SELECT n FROM n_docs) AND df >= 1),
tfidf AS (SELECT id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight
          FROM (SELECT tf.id, tf.term, tf.tf, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term)))"""


def folds_sql(source: str, id_col: str, strata_cols, n: int = views.N_FOLDS, seed: int = views.SEED) -> str:
    """SELECT *, stratum, fold FROM source — rows dealt in (stratum, md5, id) order."""
    parts = [f"coalesce(CAST({c} AS VARCHAR), '__missing__')" for c in strata_cols]
    key = " || '__|__' || ".join(parts)
    return f"""(SELECT * EXCLUDE (_h), CAST((row_number() OVER (ORDER BY stratum, _h, {id_col}) - 1) % {n} + 1 AS INTEGER) AS fold
   FROM (SELECT *, {key} AS stratum, md5('{seed}:' || CAST({id_col} AS VARCHAR)) AS _h FROM {source}))"""


ORDERS_BASE = """order_rows AS (
  SELECT o.o_orderkey AS id, o.o_orderpriority AS priority, o.o_orderstatus AS status, o.o_totalprice AS price, r.r_name AS region
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def priority_code(expr: str) -> str:
    return f"CAST(list_position({str_list(tables.ORDER_PRIORITY_ORDER)}, {expr}) - 1 AS INTEGER)"


def predicted_code(rule: int = 0) -> str:
    return (
        f"CAST(CASE WHEN (id + {rule}) % 5 < 3 THEN y "
        f"ELSE (CAST(floor(price) AS BIGINT) + {rule}) % 5 END AS INTEGER)"
    )


def outcomes_ctes(rule: int = 0, name: str = "outcomes") -> str:
    return f"""{ORDERS_BASE},
order_folds AS {folds_sql('order_rows', 'id', views.ORDER_STRATA)},
{name} AS (SELECT fold, id, region AS language, y, {predicted_code(rule)} AS yhat
  FROM (SELECT *, {priority_code('priority')} AS y FROM order_folds))"""


def labels_values(labels) -> str:
    rows = ", ".join(f"({int(i)}, {q(n)})" for i, n in labels)
    return f"(VALUES {rows}) AS lbl(label_id, label)"


def cube_ctes(labels, rule: int = 0, outcomes: str | None = None) -> str:
    """outcomes → cube(fold, language, y, yhat, n) → stats per (fold[, language], class).

    ``outcomes``: CTE text defining a relation named ``outcomes``; default the
    orders outcomes with prediction rule ``rule``.
    """
    lv = labels_values(labels)
    return f"""{outcomes or outcomes_ctes(rule)},
cube AS (SELECT fold, {language_for_slices('language')} AS language, y, yhat, count(*) AS n FROM outcomes GROUP BY ALL),
lbl AS (SELECT * FROM {lv}),
tot_f AS (SELECT fold, sum(n) AS total, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS correct FROM cube GROUP BY fold),
stats_f AS (
  SELECT t.fold, lbl.label_id, lbl.label, t.total, t.correct,
    coalesce((SELECT sum(n) FROM cube c WHERE c.fold = t.fold AND c.y = lbl.label_id AND c.yhat = lbl.label_id), 0) AS tp,
    coalesce((SELECT sum(n) FROM cube c WHERE c.fold = t.fold AND c.y = lbl.label_id), 0) AS support,
    coalesce((SELECT sum(n) FROM cube c WHERE c.fold = t.fold AND c.yhat = lbl.label_id), 0) AS predicted
  FROM tot_f t, lbl),
tot_fl AS (SELECT fold, language, sum(n) AS total, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS correct FROM cube GROUP BY fold, language),
stats_fl AS (
  SELECT t.fold, t.language, lbl.label_id, lbl.label, t.total, t.correct,
    coalesce((SELECT sum(n) FROM cube c WHERE c.fold = t.fold AND c.language = t.language AND c.y = lbl.label_id AND c.yhat = lbl.label_id), 0) AS tp,
    coalesce((SELECT sum(n) FROM cube c WHERE c.fold = t.fold AND c.language = t.language AND c.y = lbl.label_id), 0) AS support,
    coalesce((SELECT sum(n) FROM cube c WHERE c.fold = t.fold AND c.language = t.language AND c.yhat = lbl.label_id), 0) AS predicted
  FROM tot_fl t, lbl),
prf_f AS (SELECT *, {prf_cols()} FROM stats_f),
prf_fl AS (SELECT *, {prf_cols()} FROM stats_fl),
fold_m AS (SELECT fold, max(correct) / max(total) AS accuracy, avg(f1) AS macro_f1, max(total) AS sample_count FROM prf_f GROUP BY fold),
lang_m AS (SELECT fold, language, max(correct) / max(total) AS accuracy, avg(f1) AS macro_f1, max(total) AS sample_count FROM prf_fl GROUP BY fold, language)"""


def f1_expr() -> str:
    return (
        "CASE WHEN 2 * tp + (predicted - tp) + (support - tp) = 0 THEN 0.0 "
        "ELSE 2 * tp / (2 * tp + (predicted - tp) + (support - tp)) END"
    )


def prf_cols() -> str:
    return (
        "CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision, "
        "CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, "
        "CASE WHEN 2 * tp + (predicted - tp) + (support - tp) = 0 THEN 0.0 "
        "ELSE 2 * tp / (2 * tp + (predicted - tp) + (support - tp)) END AS f1"
    )


def ms(col: str) -> str:
    return f"round(avg({col}), 6) AS {col}_mean, round(stddev_pop({col}), 6) AS {col}_std"
