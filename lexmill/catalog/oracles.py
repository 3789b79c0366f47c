"""SQL that computes the registered queries' results independently, in DuckDB's dialect."""

from __future__ import annotations

from lexmill.config import STOP_WORDS

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_SYMBOL = r"[^\p{L}\p{N}_\s]"


def _plain(c: str) -> str:
    """One field without symbols, folded to ASCII."""
    return rf"regexp_replace(strip_accents(regexp_replace({c}, '{_SYMBOL}', ' ', 'g')), '[^\x00-\x7F]', '', 'g')"


def _trim(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _clean(c: str) -> str:
    return (
        rf"array_to_string(list_filter(string_split_regex({c}, '\s+'), "
        rf"lambda w: w <> '' AND NOT list_contains({_STOP}, lower(w))), ' ')"
    )


_CLEANED = f"cleaned AS (SELECT doc_id, lang, {_clean(_plain('text'))} AS clean FROM documents)"
_TOKENS = (
    f"{_CLEANED}, tokens AS (SELECT doc_id, lang, "
    "list_filter(string_split(translate(lower(clean), '_', ' '), ' '), lambda w: w <> '') AS tokens FROM cleaned)"
)
_SPLIT = """ranked AS (SELECT doc_id, lang, row_number() OVER (ORDER BY md5(concat('1:', doc_id)), doc_id) AS rn,
  count(*) OVER () AS n FROM documents),
sized AS (SELECT *, CAST(ceil(CAST(0.3 AS DOUBLE) * n) AS BIGINT) AS holdout FROM ranked),
assigned AS (SELECT doc_id, lang, rn, CASE WHEN rn <= holdout - CAST(ceil(holdout / 2.0) AS BIGINT) THEN 'test'
  WHEN rn <= holdout THEN 'validation' ELSE 'train' END AS split FROM sized)"""
_TRAIN = f"""{_TOKENS}, {_SPLIT},
train AS (SELECT doc_id, rn, tokens FROM tokens JOIN assigned USING (doc_id) WHERE split = 'train'),
train_words AS (SELECT doc_id, rn, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM train),
counted AS (SELECT word, count(*) AS n, count(DISTINCT doc_id) AS df, min(rn * 100000000 + pos) AS first_use
  FROM train_words GROUP BY word),
vocab AS (SELECT word, n, df, row_number() OVER (ORDER BY n DESC, first_use) + 1 AS idx FROM counted),
corpus AS (SELECT count(*) AS n_docs FROM train)"""
_POSTINGS = """postings AS (SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(tokens) AS word FROM tokens) GROUP BY doc_id, word)"""


def _weighted(num_words: int | None, key: str = "doc_id") -> str:
    known = "" if num_words is None else f" AND v.idx < {num_words}"
    return f"""counts AS (SELECT p.{key}, coalesce(v.idx, 1) AS idx, coalesce(v.df, 0) AS df, sum(p.n) AS c
  FROM postings p LEFT JOIN vocab v ON p.word = v.word{known} GROUP BY ALL),
x AS (SELECT {key}, idx, (1 + ln(c)) * ln(1 + n_docs / (1 + df)) AS tfidf FROM counts, corpus)"""


def _scores(num_words: int | None, divisor: float, key: str = "doc_id", source: str = "tokens") -> str:
    sums = ", ".join(f"sum(tfidf * ((31 * idx + 17 * {j}) % 101 - 50) / {divisor}) AS z{j}" for j in range(5))
    hidden = ", ".join(f"greatest(coalesce(z{j}, 0) + {j / 10}, 0) AS h{j}" for j in range(5))
    outs = []
    for k in range(4):
        terms = " + ".join(f"h{j} * {((13 * j + 7 * k) % 11 - 5) / 5}" for j in range(5))
        outs.append(f"round(1 / (1 + exp(-({k / 100} + {terms}))), 9)")
    return f"""{_weighted(num_words, key)},
sums AS (SELECT {key}, {sums} FROM x GROUP BY {key}),
hidden AS (SELECT d.{key}, {hidden} FROM {source} d LEFT JOIN sums USING ({key})),
scores AS (SELECT {key}, [{', '.join(outs)}] AS p FROM hidden),
classes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_idx
  FROM (SELECT DISTINCT lang AS label FROM documents)),
best AS (SELECT {key}, p, list_max(p) AS score, list_position(p, list_max(p)) - 1 AS label_idx FROM scores),
predicted AS (SELECT {key}, label, score, label_idx, p FROM best JOIN classes USING (label_idx))"""


_JUDGED = """judged AS (SELECT doc_id, source, lang AS y_true,
  CASE WHEN doc_id % 5 = 0 THEN 'en' WHEN lang = 'es' THEN 'de' ELSE lang END AS y_pred FROM documents)"""
_TOTALS = """totals AS (SELECT count(*) AS n_evaluated, count(*) FILTER (y_true = y_pred) AS n_correct,
  count(*) FILTER (y_true <> y_pred) AS n_errors,
  count(DISTINCT y_true) FILTER (y_true NOT IN ('de', 'en', 'fr')) AS n_unknown_labels,
  count(*) FILTER (y_true NOT IN ('de', 'en', 'fr')) AS n_unknown_rows FROM judged)"""


def _history(group: str = "") -> str:
    keys = f"{group}, " if group else ""
    return f"""history AS (SELECT {keys}(doc_id // 2) % 10 + 1 AS epoch,
  avg(CAST(y_true = y_pred AS DOUBLE)) FILTER (doc_id % 2 = 0) AS accuracy,
  avg(CAST(y_true = y_pred AS DOUBLE)) FILTER (doc_id % 2 = 1) AS val_accuracy FROM judged GROUP BY ALL)"""


_DECISION = f"""WITH {_JUDGED}, {_TOTALS}, {_history()},
base AS (SELECT avg(val_accuracy) - CAST(0.02 AS DOUBLE) AS threshold FROM history),
rules AS (SELECT *, n_correct / n_evaluated AS share, n_correct / n_evaluated <= threshold AS below,
  n_unknown_labels > 0 AS unknown FROM totals, base)
SELECT below OR unknown AS retrain, n_evaluated, n_correct, n_errors,
  printf('%.4f%%', threshold * 100) AS threshold,
  CASE WHEN below THEN printf('%.4f%%', share * 100) END AS evaluated_accuracy,
  CASE WHEN below THEN printf('%d of %d labels were predicted correctly (%d errors)', n_correct, n_evaluated, n_errors)
    END AS hits_text,
  CASE WHEN below THEN concat('accuracy is at or below that of the published model less 2.0000% (threshold ',
    printf('%.4f%%', threshold * 100), ')') END AS accuracy_text,
  CASE WHEN unknown THEN n_unknown_labels END AS n_unknown_labels,
  CASE WHEN unknown THEN n_unknown_rows END AS n_unknown_rows,
  CASE WHEN unknown THEN printf('%d labels on %d rows were not in training', n_unknown_labels, n_unknown_rows)
    END AS labels_text,
  CASE WHEN unknown THEN (SELECT string_agg(concat(y_true, '=', n), ';' ORDER BY n DESC, y_true) FROM
    (SELECT y_true, count(*) AS n FROM judged WHERE y_true NOT IN ('de', 'en', 'fr') GROUP BY 1)) END AS unknown_labels,
  CASE WHEN NOT below AND NOT unknown THEN 'the accuracy is above the threshold and every label is known: no retrain is needed'
    END AS not_needed_text
FROM rules"""

_MISSING = """m AS (SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN NULL ELSE text END AS text
  FROM documents)"""
_REQUESTS = """requests AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, '. ', ';')
  ELSE concat(source, ';', text) END AS request FROM documents),
fields AS (SELECT doc_id, string_split(request, ';') AS fields FROM requests)"""
_CONVERSATIONS = f"""turns AS (SELECT conv_id * 1000 + turn AS request_id,
  {_clean(f"concat({_plain('role')}, ' ', {_plain('text')})")} AS clean FROM conversations),
turn_tokens AS (SELECT request_id,
  list_filter(string_split(translate(lower(clean), '_', ' '), ' '), lambda w: w <> '') AS tokens FROM turns),
postings AS (SELECT request_id, word, count(*) AS n
  FROM (SELECT request_id, unnest(tokens) AS word FROM turn_tokens) GROUP BY request_id, word)"""
_PREDICTED_TURNS = f"""WITH {_TRAIN}, {_CONVERSATIONS}, {_scores(None, 1000.0, 'request_id', 'turn_tokens')}
SELECT request_id, label, round(score, 6) AS score FROM predicted"""
_ITEMS = f"""items AS (SELECT item_id,
  list_filter(string_split(translate(lower({_clean(_plain('text'))}), '_', ' '), ' '), lambda w: w <> '') AS tokens
  FROM benchmark),
postings AS (SELECT item_id, word, count(*) AS n
  FROM (SELECT item_id, unnest(tokens) AS word FROM items) GROUP BY item_id, word)"""
_SCORED = f"WITH {_TRAIN}, {_POSTINGS}, {_scores(200, 500.0)}"
_PUBLISHED = f"WITH {_TRAIN}, {_POSTINGS}, {_scores(None, 1000.0)}"



def _train_step() -> str:
    """Back-propagation written out for the fixed network of five neurons and four classes."""
    weights = [[((13 * j + 7 * k) % 11 - 5) / 5 for j in range(5)] for k in range(4)]
    z = ", ".join(f"coalesce(sum(tfidf * ((31 * idx + 17 * {j}) % 101 - 50) / 1000.0), 0) + {j / 10} AS z{j}" for j in range(5))
    p = ", ".join(
        f"1 / (1 + exp(-({k / 100} + " + " + ".join(f"greatest(z{j}, 0) * {weights[k][j]}" for j in range(5)) + f"))) AS p{k}"
        for k in range(4)
    )
    out = ", ".join(
        f"(p{k} / t - CASE WHEN target = {k} THEN 1 ELSE 0 END) * (1 - p{k}) * held / (SELECT n_docs FROM corpus) AS o{k}"
        for k in range(4)
    )
    back = ", ".join(
        f"CASE WHEN z{j} > 0 THEN " + " + ".join(f"o{k} * ({weights[k][j]})" for k in range(4)) + f" ELSE 0 END AS d{j}"
        for j in range(5)
    )
    shares = "CASE target " + " ".join(f"WHEN {k} THEN p{k}" for k in range(4)) + " END / t"
    words = " UNION ALL ".join(
        f"SELECT 'word' AS part, idx, {j} AS neuron, sum(tfidf * d{j}) AS g FROM x JOIN slopes USING (doc_id) GROUP BY idx"
        for j in range(5)
    )
    biases = " UNION ALL ".join(f"SELECT 'hidden_bias', NULL, {j}, sum(d{j}) FROM slopes" for j in range(5))
    outputs = " UNION ALL ".join(
        f"SELECT 'output_weight', {k}, {j}, sum(greatest(z{j}, 0) * o{k}) FROM slopes" for k in range(4) for j in range(5)
    )
    out_biases = " UNION ALL ".join(f"SELECT 'output_bias', {k}, NULL, sum(o{k}) FROM slopes" for k in range(4))
    return f"""WITH {_TRAIN}, {_POSTINGS}, {_weighted(None)},
classes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_idx
  FROM (SELECT DISTINCT lang AS label FROM documents)),
sums AS (SELECT a.doc_id, any_value(c.label_idx) AS target, {z} FROM assigned a JOIN classes c ON c.label = a.lang
  LEFT JOIN x USING (doc_id) WHERE a.split = 'train' GROUP BY a.doc_id),
scored AS (SELECT *, {p} FROM sums),
totalled AS (SELECT *, p0 + p1 + p2 + p3 AS t FROM scored),
clipped AS (SELECT *, CASE WHEN {shares} >= 1e-7 AND {shares} <= 1 - 1e-7 THEN 1 ELSE 0 END AS held FROM totalled),
outs AS (SELECT *, {out} FROM clipped),
slopes AS (SELECT *, {back} FROM outs),
every AS ({words} UNION ALL {biases} UNION ALL {outputs} UNION ALL {out_biases})
SELECT part, CAST(idx AS BIGINT) AS idx, CAST(neuron AS BIGINT) AS neuron, round(g, 8) AS gradient,
  round(-0.001 * sqrt(1 - CAST(0.999 AS DOUBLE)) / (1 - CAST(0.9 AS DOUBLE)) * (1 - CAST(0.9 AS DOUBLE)) * g
    / (sqrt((1 - CAST(0.999 AS DOUBLE)) * g * g) + 1e-7), 8) AS step FROM every"""


def _run_tables(picked: str) -> str:
    """What a job fits on rows numbered by their place in a file, of which it uses the ``picked`` ones."""
    fitted = _TRAIN.replace("FROM documents", "FROM picked")
    return f"""WITH numbered AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id,
  coalesce(nullif(text, ''), 'nanvazio') AS text, lang FROM documents),
picked AS (SELECT * FROM numbered {picked}), {fitted}
SELECT 'split' AS kind, split AS name, count(*) AS number FROM assigned GROUP BY split UNION ALL
SELECT 'word', word, idx FROM vocab UNION ALL
SELECT 'label', lang, row_number() OVER (ORDER BY lang) - 1 FROM (SELECT DISTINCT lang FROM picked)"""


ORACLES: dict[str, str] = {
    "train_step": _train_step(),
    "csv_scan": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents",
    "csv_scan_lines": r"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(text, '[\r\n]+', ' ', 'g') AS text, lang
FROM documents""",
    "na_tokens": f"WITH {_MISSING} SELECT doc_id, text FROM m",
    "paired_scan": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, text, lang FROM documents",
    "paired_by_key": "SELECT doc_id, text, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "request_split": f"""WITH {_REQUESTS}
SELECT doc_id, generate_subscripts(fields, 1) - 1 AS position, unnest(fields) AS field FROM fields""",
    "ragged_check": f"""WITH {_REQUESTS}, first AS (SELECT len(fields) AS w FROM fields ORDER BY doc_id LIMIT 1)
SELECT doc_id, len(fields) AS n_fields FROM fields, first WHERE len(fields) <> w""",
    "request_widths": f"WITH {_REQUESTS} SELECT len(fields) AS n_fields, count(*) AS n_rows FROM fields GROUP BY 1",
    "artifact_roundtrip": f"""WITH {_TRAIN} SELECT word, idx FROM vocab UNION ALL
SELECT label, row_number() OVER (ORDER BY label) - 1 FROM (SELECT DISTINCT lang AS label FROM documents)""",
    "published_tables": f"""WITH {_TRAIN}, classes AS (SELECT count(DISTINCT lang) AS k FROM documents),
indices AS (SELECT idx FROM vocab UNION ALL SELECT 1)
SELECT 'vocabulary' AS artifact, count(*) AS n_rows, CAST(sum(n * idx) AS BIGINT) AS total FROM vocab UNION ALL
SELECT 'labels', k, CAST(k * (k - 1) // 2 AS BIGINT) FROM classes UNION ALL
SELECT 'hidden', count(*), CAST(sum((31 * idx + 17) % 101 - 50) AS BIGINT) FROM indices UNION ALL
SELECT 'network', 1, k FROM classes UNION ALL
SELECT 'scoring_words', count(*), CAST(sum(idx) AS BIGINT) FROM vocab UNION ALL
SELECT 'corpus', 1, n_docs FROM corpus UNION ALL
SELECT 'training_params', 1, 10 UNION ALL SELECT 'training_history', 10, 55 UNION ALL
SELECT 'baseline_metrics', 1, 875 UNION ALL SELECT 'model_info', 1, 1""",
    "word_count_sink": f"""WITH {_TRAIN} SELECT word AS palavra, n AS quantidade,
  round(n / (SELECT sum(n) FROM vocab) * 100, 6) AS percentual FROM vocab""",
    "reasons_sink": _DECISION,
    "run_registry": f"""WITH {_JUDGED}, {_history('source')}
SELECT source AS experiment, concat('run-', source) AS run_id, epoch, round(accuracy, 6) AS accuracy,
  round(val_accuracy, 6) AS val_accuracy FROM history""",
    "model_info": f"""WITH {_JUDGED}, {_history()}
SELECT 'languages' AS experiment, 'check' AS run_name, 'run-1' AS run_id, 'run-1' AS version,
  printf('%.2f%%', avg(accuracy) * 100) AS train_accuracy, printf('%.2f%%', avg(val_accuracy) * 100) AS val_accuracy,
  '87.50%' AS test_accuracy, 'text' AS features, 'lang' AS targets,
  (SELECT string_agg(l, ',' ORDER BY l) FROM (SELECT DISTINCT lang AS l FROM documents)) AS predictable_labels
FROM history""",
    "project_roles": "SELECT doc_id, source, text, lang FROM documents",
    "repair_selected": """SELECT doc_id, text, source, lang FROM documents
WHERE doc_id % 13 <> 0 AND text IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL""",
    "null_profile": f"""WITH {_MISSING} SELECT 'text' AS column_name, count(*) - count(text) AS n_missing FROM m
UNION ALL SELECT 'lang', count(*) - count(lang) FROM m""",
    "drop_missing": f"WITH {_MISSING} SELECT doc_id, text, lang FROM m WHERE text IS NOT NULL AND lang IS NOT NULL",
    "cleaning_report": f"""WITH {_MISSING} SELECT count(*) AS rows_before, count(*) - count(text) AS rows_removed,
  count(text) AS rows_after, printf('%.2f%%', (count(*) - count(text)) / count(*) * 100) AS share_removed FROM m""",
    "fill_missing": f"WITH {_MISSING} SELECT doc_id, coalesce(text, 'nanvazio') AS text, lang FROM m",
    "shuffle_rank": f"WITH {_SPLIT} SELECT doc_id, rn AS shuffle_rank FROM ranked",
    "split_assign": f"WITH {_SPLIT} SELECT doc_id, lang, split FROM assigned",
    "split_shapes": f"""WITH {_TRAIN} SELECT split, count(*) AS n_rows,
  (SELECT count(*) + 2 FROM vocab) AS n_columns FROM assigned GROUP BY split""",
    "capped_sample": """SELECT event_id, event_type FROM events
ORDER BY md5(concat('0:', event_id)), event_id LIMIT 5000""",
    "head_n": """SELECT event_id - (SELECT min(event_id) FROM events) AS row_index, event_id, event_type FROM events
ORDER BY event_id LIMIT 5000""",
    "number_rows": """SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS position
FROM documents""",
    "preview": "SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 10",
    "clean_fields": f"SELECT doc_id, regexp_replace({_trim('text')}, '{_SYMBOL}', ' ', 'g') AS field FROM documents",
    "ascii_fold": r"""SELECT doc_id, regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g') AS folded
FROM documents""",
    "concat_fields": "SELECT doc_id, concat(source, ' ', text) AS joined FROM documents",
    "stopword_filter": rf"""WITH w AS (SELECT doc_id,
  list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS words FROM documents),
k AS (SELECT doc_id, words, list_filter(words, lambda w: NOT list_contains({_STOP}, lower(w))) AS kept FROM w)
SELECT doc_id, len(words) - len(kept) AS n_removed, array_to_string(kept, ' ') AS kept FROM k""",
    "clean_text": f"WITH {_CLEANED} SELECT doc_id, clean FROM cleaned",
    "clean_text_two_fields": f"""SELECT doc_id,
  {_clean(f"concat({_plain('source')}, ' ', {_plain('text')})")} AS clean FROM documents""",
    "clean_text_keep_stop_words": f"SELECT doc_id, {_plain(_trim('text'))} AS clean FROM documents",
    "tokenize": f"""WITH {_TOKENS}
SELECT doc_id, generate_subscripts(tokens, 1) - 1 AS position, unnest(tokens) AS token FROM tokens""",
    "word_count": f"WITH {_TRAIN} SELECT word, n FROM vocab",
    "doc_freq": f"WITH {_TRAIN} SELECT word, df FROM vocab",
    "vocab_index": f"WITH {_TRAIN} SELECT word, n, df, idx FROM vocab",
    "word_count_report": f"""WITH {_TRAIN} SELECT idx, word, n AS quantity,
  round(n / (SELECT sum(n) FROM vocab) * 100, 6) AS percent FROM vocab""",
    "word_count_report_limited": f"""WITH {_TRAIN} SELECT idx, word, n AS quantity,
  round(n / (SELECT sum(n) FROM vocab) * 100, 6) AS percent FROM vocab ORDER BY idx LIMIT 200""",
    "top_words": f"WITH {_TRAIN} SELECT word, n, idx FROM vocab ORDER BY idx LIMIT 20",
    "top_vocab": f"""WITH {_TRAIN} SELECT '***UNK***' AS word, 1 AS idx UNION ALL
SELECT word, idx FROM vocab WHERE idx <= 20""",
    "corpus_stats": f"""WITH {_TRAIN} SELECT (SELECT n_docs FROM corpus) AS n_documents,
  count(DISTINCT lang) AS n_classes, count(DISTINCT lang) FILTER (split = 'train') AS n_classes_train,
  (SELECT count(*) + 1 FROM vocab) AS n_unique_words FROM assigned""",
    "term_freq": f"WITH {_TOKENS}, {_POSTINGS} SELECT doc_id, word, n FROM postings",
    "vocab_lookup": f"""WITH {_TRAIN}, {_POSTINGS}
SELECT doc_id, p.word, p.n, coalesce(idx, 1) AS idx FROM postings p LEFT JOIN vocab v ON p.word = v.word AND idx < 200""",
    "vocab_lookup_large": f"""WITH {_TRAIN}, {_POSTINGS}
SELECT doc_id, p.word, p.n, coalesce(idx, 1) AS idx FROM postings p LEFT JOIN vocab v ON p.word = v.word""",
    "vocab_lookup_salted": f"""WITH {_TRAIN}, {_POSTINGS}
SELECT doc_id, p.word, p.n, coalesce(idx, 1) AS idx FROM postings p LEFT JOIN vocab v ON p.word = v.word""",
    "idf": f"WITH {_TRAIN} SELECT word, df, round(ln(1 + n_docs / (1 + df)), 6) AS idf FROM vocab, corpus",
    "tfidf": f"WITH {_TRAIN}, {_POSTINGS}, {_weighted(None)} SELECT doc_id, idx, round(tfidf, 6) AS tfidf FROM x",
    "tfidf_limited": f"""WITH {_TRAIN}, {_POSTINGS}, {_weighted(200)}
SELECT doc_id, idx, round(tfidf, 6) AS tfidf FROM x""",
    "tfidf_shared_ids": f"""WITH {_TRAIN}, {_POSTINGS}, {_weighted(None)}
SELECT CASE WHEN doc_id % 5 <> 0 THEN doc_id % 17 END AS doc_id, idx, round(tfidf, 6) AS tfidf FROM x""",
    "distinct_labels": f"""WITH {_SPLIT}
SELECT lang AS label, bool_or(split = 'train') AS in_train FROM assigned GROUP BY lang""",
    "label_encode": "SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang) - 1 AS label_idx FROM documents",
    "label_decode": """WITH c AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_idx
  FROM (SELECT DISTINCT lang AS label FROM documents))
SELECT doc_id, label_idx, label FROM documents JOIN c ON doc_id % (SELECT count(*) FROM c) = label_idx""",
    "one_hot": """WITH c AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS class_idx
  FROM (SELECT DISTINCT lang AS label FROM documents))
SELECT doc_id, class_idx, 1.0::DOUBLE AS hot FROM documents JOIN c ON lang = label""",
    "score_fixed_mlp": f"{_SCORED} SELECT doc_id, label, round(score, 6) AS score FROM predicted",
    "score_full_vocabulary": f"""WITH {_TRAIN}, {_POSTINGS}, {_scores(None, 1000.0)}
SELECT doc_id, label, round(score, 6) AS score FROM predicted""",
    "score_unseen_texts": f"""WITH {_TRAIN}, {_ITEMS}, {_scores(None, 1000.0, 'item_id', 'items')}
SELECT item_id, label, round(score, 6) AS score FROM predicted""",
    "predict_requests": _PREDICTED_TURNS,
    "predict_shared_ids": f"""SELECT CASE WHEN request_id % 5 <> 0 THEN request_id % 17 END AS request_id, label, score
FROM ({_PREDICTED_TURNS})""",
    "score_stream_batches": _PREDICTED_TURNS,
    "score_stream_rejects": """WITH turns AS (SELECT conv_id * 1000 + turn AS request_id, concat(role, ';', text) AS r
  FROM conversations),
broken AS (SELECT request_id, CASE WHEN request_id % 5 = 0 THEN NULL WHEN request_id % 7 = 0 THEN replace(r, ';', ' ')
  WHEN request_id % 11 = 0 THEN concat(r, ';more') ELSE r END AS request FROM turns),
judged AS (SELECT request_id, CASE WHEN request IS NULL THEN 'the request holds no text'
  WHEN len(string_split(request, ';')) <> 2
  THEN concat('expected 2 field(s), found ', len(string_split(request, ';'))) END AS reason FROM broken)
SELECT request_id, reason IS NULL AS scored, reason FROM judged""",
    "cross_entropy": f"""{_PUBLISHED},
truth AS (SELECT p.doc_id, p.p, p.label_idx, c.label_idx AS target FROM predicted p JOIN assigned d USING (doc_id)
  JOIN classes c ON c.label = d.lang WHERE d.split = 'test')
SELECT round(avg(-ln(least(greatest(p[target + 1] / list_sum(p), 1e-7), 1 - 1e-7))), 6) AS loss,
  round(avg(CAST(label_idx = target AS DOUBLE)), 6) AS accuracy FROM truth""",
    "accuracy": f"""WITH {_JUDGED}, {_TOTALS} SELECT n_evaluated, n_correct, n_errors,
  round(n_correct / n_evaluated, 6) AS accuracy FROM totals""",
    "evaluate_report": f"""{_PUBLISHED}
SELECT printf('%.2f%%', avg(CAST(label = lang AS DOUBLE)) * 100) AS accuracy
FROM predicted JOIN documents USING (doc_id)""",
    "batch_accuracy": f"""WITH {_SPLIT}, {_JUDGED}
SELECT (rn - 1) // 300 AS batch_id, count(*) AS n_rows, count(*) FILTER (y_true = y_pred) AS n_correct,
  round(count(*) FILTER (y_true = y_pred) / count(*), 6) AS accuracy
FROM judged JOIN ranked USING (doc_id) GROUP BY 1""",
    "unknown_labels": f"""WITH {_JUDGED}
SELECT y_true AS label, count(*) AS n FROM judged WHERE y_true NOT IN ('de', 'en', 'fr') GROUP BY 1""",
    "feedback_report": f"""WITH {_JUDGED}, {_TOTALS}
SELECT printf('%.2f%%', n_correct / n_evaluated * 100) AS accuracy, n_correct, n_evaluated, n_errors,
  n_unknown_labels, n_unknown_rows,
  CASE WHEN n_unknown_labels > 0 AND n_errors > 0 THEN printf('%.2f%%', n_unknown_rows / n_errors * 100) END
    AS unknown_share_of_errors FROM totals""",
    "baseline_metrics": f"""WITH {_JUDGED}, {_history()}
SELECT round(avg(accuracy), 6) AS mean_train_accuracy, round(avg(val_accuracy), 6) AS mean_val_accuracy,
  CAST(0.875 AS DOUBLE) AS test_accuracy, CAST(0.02 AS DOUBLE) AS accuracy_tolerance,
  (SELECT string_agg(l, ',' ORDER BY l) FROM (SELECT DISTINCT lang AS l FROM documents)) AS dataset_labels
FROM history""",
    "retrain_decision": _DECISION,
    "retrain_low_accuracy": f"""WITH {_JUDGED}, {_TOTALS}, {_history()},
base AS (SELECT avg(val_accuracy) AS threshold FROM history),
rules AS (SELECT *, n_correct / n_evaluated AS share, n_correct / n_evaluated <= threshold AS below FROM totals, base)
SELECT below AS retrain, n_evaluated, n_correct, n_errors, printf('%.4f%%', threshold * 100) AS threshold,
  CASE WHEN below THEN printf('%.4f%%', share * 100) END AS evaluated_accuracy,
  CASE WHEN below THEN printf('%d of %d labels were predicted correctly (%d errors)', n_correct, n_evaluated, n_errors)
    END AS hits_text,
  CASE WHEN below THEN concat('accuracy is at or below that of the published model less 0.0000% (threshold ',
    printf('%.4f%%', threshold * 100), ')') END AS accuracy_text,
  CAST(NULL AS BIGINT) AS n_unknown_labels, CAST(NULL AS BIGINT) AS n_unknown_rows,
  CAST(NULL AS VARCHAR) AS labels_text, CAST(NULL AS VARCHAR) AS unknown_labels,
  CASE WHEN NOT below THEN 'the accuracy is above the threshold and every label is known: no retrain is needed' END
    AS not_needed_text FROM rules""",
    "retrain_not_needed": f"""WITH {_JUDGED}, {_TOTALS}, {_history()},
base AS (SELECT avg(val_accuracy) - CAST(0.5 AS DOUBLE) AS threshold FROM history)
SELECT n_correct / n_evaluated <= threshold AS retrain, n_evaluated, n_correct, n_errors,
  printf('%.4f%%', threshold * 100) AS threshold, CAST(NULL AS VARCHAR) AS evaluated_accuracy,
  CAST(NULL AS VARCHAR) AS hits_text, CAST(NULL AS VARCHAR) AS accuracy_text,
  CAST(NULL AS BIGINT) AS n_unknown_labels, CAST(NULL AS BIGINT) AS n_unknown_rows,
  CAST(NULL AS VARCHAR) AS labels_text, CAST(NULL AS VARCHAR) AS unknown_labels,
  CASE WHEN n_correct / n_evaluated > threshold THEN
    'the accuracy is above the threshold and every label is known: no retrain is needed' END AS not_needed_text
FROM totals, base""",
    "retrain_evaluation": f"""{_PUBLISHED}, {_JUDGED}, {_history()},
base AS (SELECT avg(val_accuracy) - CAST(0.02 AS DOUBLE) AS threshold FROM history),
hits AS (SELECT count(*) AS n, count(*) FILTER (label = lang) AS c FROM predicted JOIN documents USING (doc_id))
SELECT c / n <= threshold AS retrain, 'run-1' AS evaluated_run_id, n AS n_evaluated, c AS n_correct,
  n - c AS n_errors, printf('%.4f%%', threshold * 100) AS threshold,
  CASE WHEN c / n <= threshold THEN printf('%.4f%%', c / n * 100) END AS evaluated_accuracy FROM hits, base""",
    "percent_format": """SELECT event_id, printf('%.2f%%', value / 1000 * 100) AS two,
  printf('%.4f%%', value / 1000 * 100) AS four FROM events""",
    "run_id_format": "SELECT event_id, strftime(ts, '%Y-%m-%d_%H%M%Shs') AS run_name FROM events",
    "duration_hms": """WITH s AS (SELECT event_id, (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) // 1000000 AS t
  FROM events)
SELECT event_id, t // 3600 AS hours, t % 3600 // 60 AS minutes, t % 60 AS seconds FROM s""",
    "train_job_tables": _run_tables("ORDER BY md5(concat('0:', doc_id)), doc_id LIMIT 150"),
    "retrain_job_tables": _run_tables("ORDER BY doc_id LIMIT 150"),
}
