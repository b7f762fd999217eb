"""The queries in SQL for DuckDB, from the same tables."""

from __future__ import annotations

from chronolex.functions.text import BOUNDARY
from chronolex.operators.labels import CONFIDENCES, TOPIC_TYPES
from chronolex.plans import testdata as td


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) for v in values)


CI = "source || '-' || (1850 + doc_id % 150) || '-' || lpad((1 + doc_id % 12)::VARCHAR, 2, '0') || '-' || lpad((1 + doc_id % 28)::VARCHAR, 2, '0') || '-a-i' || lpad((doc_id % 10000)::VARCHAR, 4, '0')"
#: White space and control signs of the boundary set can't stand in a token, so the trimmed signs are the visible ones.
_BASE = "strip_accents(replace(lower({w}), 'ß', 'ss'))"
_CORE = "replace(replace(replace(trim(" + _BASE + ", " + _q("".join(c for c in BOUNDARY if c > " ")).replace("{", "{{").replace("}", "}}") + "), '.', ''), '-', ''), '''', '')"


def _norm(w: str) -> str:
    base, core = _BASE.format(w=w), _CORE.format(w=w)
    return f"CASE WHEN regexp_full_match({core}, '[a-z]+') AND length({core}) >= 3 AND length({core}) / length({base}) >= 0.75 THEN {core} END"


def _key(w: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({w})), '\\s+', ' ', 'g'))"


def _chain(**parts: str) -> str:
    return ", ".join(f"{name} AS ({sql})" for name, sql in parts.items())


CORPUS = _chain(
    corpus=f"SELECT row_number() OVER () AS r, {CI} AS ci_id, lang, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents",
    line="SELECT r, ci_id, lang, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, len(ls) AS k FROM corpus",
    sent="SELECT r, ci_id, lang, CASE WHEN i = 1 THEN k - 1 ELSE i - 2 END::BIGINT AS sent_pos, list_filter(string_split(line, ' '), lambda x: x <> '') AS ws FROM line",
    tok="SELECT r, ci_id, lang, sent_pos, unnest(ws) AS t, generate_subscripts(ws, 1)::BIGINT - 1 AS tok_pos FROM sent",
    token="SELECT *, CASE WHEN left(t, 1) <> lower(left(t, 1)) THEN 'PROPN' WHEN length(t) % 5 = 0 THEN 'VERB' ELSE 'NOUN' END AS p, CASE WHEN length(t) % 7 = 0 THEN '' ELSE lower(t) END AS l FROM tok",
    lem="SELECT *, CASE WHEN trim(l) <> '' THEN l ELSE lower(t) END AS lemma FROM token",
    freqs="SELECT lang, lemma, count(*) AS freq FROM lem GROUP BY ALL",
)
NORMED = _chain(normed=f"SELECT lang, lemma, freq, {_norm('lemma')} AS norm FROM freqs")
TEXTS = _chain(
    vocab=f"SELECT lang, norm AS lemma FROM normed WHERE norm IS NOT NULL GROUP BY ALL HAVING sum(freq) BETWEEN {td.MIN_FREQ} AND {td.MAX_FREQ}",
    candidate=f"SELECT r, lang, sent_pos, tok_pos, {_norm('lemma')} AS lemma FROM lem WHERE p IN ({_list(td.POS)})",
    kept="SELECT c.* FROM candidate c SEMI JOIN vocab v ON c.lang = v.lang AND c.lemma = v.lemma",
    counted="SELECT r, count(*) AS n, count(DISTINCT lemma) AS n_unique, string_agg(lemma, ' ' ORDER BY sent_pos, tok_pos) AS lemmas FROM kept GROUP BY r",
    doc="SELECT r, ci_id, corpus.lang, coalesce(n, 0) AS n, coalesce(n_unique, 0) AS n_unique, coalesce(lemmas, '') AS lemmas FROM corpus LEFT JOIN counted USING (r)",
    judged=f"SELECT *, CASE WHEN n < {td.LIMITS[0]} THEN 'short' WHEN n_unique < {td.LIMITS[1]} THEN 'few_unique' WHEN n > {td.LIMITS[2]} THEN 'long' END AS reason FROM doc",
    ok="SELECT * FROM judged WHERE reason IS NULL",
    word="SELECT o.r, o.ci_id, o.lang, k.lemma FROM kept k JOIN ok o ON k.r = o.r",
    df="SELECT lemma, count(DISTINCT r) AS document_frequency, count(*) AS total_frequency FROM word GROUP BY lemma",
)
C, N, T = f"WITH {CORPUS}", f"WITH {CORPUS}, {NORMED}", f"WITH {CORPUS}, {NORMED}, {TEXTS}"

_PATTERN = "'^(.+?)-(\\d{4})-\\d{2}-\\d{2}-'"


def _part(c: str, x: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {_PATTERN}) THEN {x} ELSE 'unknown' END"


def _newspaper(c: str) -> str:
    return _part(c, f"regexp_extract({c}, {_PATTERN}, 1)")


def _year(c: str) -> str:
    return _part(c, f"try_cast(regexp_extract({c}, {_PATTERN}, 2) AS INT)::VARCHAR")


def _decade(c: str) -> str:
    return _part(c, f"(try_cast(regexp_extract({c}, {_PATTERN}, 2) AS INT) // 10 * 10)::VARCHAR || 's'")


ROWS = _chain(
    base=f"SELECT doc_id, {CI} AS ci_id FROM documents",
    lab="SELECT ci_id, 'DUMMY' AS label FROM base UNION ALL SELECT ci_id, 'again' FROM base WHERE doc_id % 4 = 0",
    rows=f"SELECT ci_id, label, ci_id || chr(9) || label AS row_, md5('42' || chr(9) || ci_id) AS score, {_newspaper('ci_id')} || '|' || {_decade('ci_id')} AS stratum FROM lab",
    capped="SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY score, row_ DESC) <= 3",
    single="SELECT * FROM capped QUALIFY row_number() OVER (PARTITION BY ci_id ORDER BY score, row_ DESC) = 1",
    chosen="SELECT * FROM single ORDER BY score, ci_id LIMIT 100",
)
S = f"WITH {ROWS}"
ODD = f"SELECT CASE WHEN doc_id % 10 = 7 THEN 'odd' || doc_id ELSE {CI} END AS ci_id FROM documents"

WEIGHTS = _chain(
    piece="SELECT substring(source, 4)::INT AS topic, unnest(regexp_split_to_array(lower(text), '[ \\n]')) AS word FROM documents",
    weights="SELECT topic, word, count(*)::DOUBLE AS weight FROM piece WHERE word <> '' GROUP BY ALL",
    shares="SELECT topic, word, weight / sum(weight) OVER (PARTITION BY topic) AS prob FROM weights WHERE weight > 1.0",
    probs="SELECT * FROM shares WHERE prob >= 0.001",
    top="SELECT *, row_number() OVER (PARTITION BY topic ORDER BY prob DESC, word) AS rank FROM probs QUALIFY rank <= 20",
)
W = f"WITH {WEIGHTS}"
DENSE = _chain(
    vec="SELECT vec_id AS idx, unnest(embedding)::DOUBLE AS e, generate_subscripts(embedding, 1) - 1 AS t FROM embeddings",
    share="SELECT idx, t::BIGINT AS t, round(e * e / sum(e * e) OVER (PARTITION BY idx), 6) AS p FROM vec",
    ref="SELECT vec_id AS idx, 'src' || (vec_id % 20) || '-1900-01-01-a-i' || lpad((vec_id % 400)::VARCHAR, 4, '0') AS ci_ref FROM embeddings",
    first="SELECT ci_ref, min(idx) AS idx FROM ref GROUP BY ci_ref",
    sorted=f"SELECT ci_ref, t, round(p, 3) AS p, row_number() OVER (PARTITION BY idx ORDER BY round(p, 3) DESC, t) - 1 AS pos FROM first JOIN share USING (idx) WHERE p >= {td.EPS}",
)
D = f"WITH {DENSE}"
_TOPICS = ", ".join(f"({_q(t)}, {i}, {_q(w)})" for t, ws in td.TOPICS for i, w in enumerate(ws))
_LABELS = ", ".join(f"({i}, {_list(r[:3])}, {_q(r[3])}, {_q(r[4])}, {_q(r[5])}, [{_list(r[6])}])" for i, r in enumerate(td.LABELS))
LABELS = _chain(
    topics=f"SELECT * FROM (VALUES {_TOPICS}) v(topic_id, pos, word)",
    labels=f"SELECT * FROM (VALUES {_LABELS}) v(row_, topic_id, label_short, label_long, topic_type, confidence, rationale, terms)",
    lookup=f"SELECT topic_id, {_key('word')} AS key, arg_max(word, pos) AS canonical FROM topics GROUP BY ALL",
    terms="SELECT row_, topic_id, rationale, unnest(terms) AS term, generate_subscripts(terms, 1)::BIGINT - 1 AS pos FROM labels",
    pieces="SELECT row_, topic_id, pos, unnest(string_split(term, ' ')) AS piece, generate_subscripts(string_split(term, ' '), 1) AS part FROM terms",
    found=f"SELECT p.row_, p.pos, count(*) AS n, count(canonical) AS known, string_agg(canonical, '|' ORDER BY part) AS words FROM pieces p LEFT JOIN lookup l ON p.topic_id = l.topic_id AND {_key('piece')} = l.key GROUP BY ALL",
    resolved=f"SELECT t.row_, t.topic_id, t.rationale, t.pos, t.term, coalesce(canonical, CASE WHEN n > 1 AND n = known THEN words END) AS resolved FROM terms t JOIN found f ON t.row_ = f.row_ AND t.pos = f.pos LEFT JOIN lookup l ON t.topic_id = l.topic_id AND {_key('term')} = l.key",
)
L = f"WITH {LABELS}"
_NOISE = "coalesce(string_agg(CASE WHEN topic_type = '{}' THEN topic_id END, '|' ORDER BY topic_id), '')"

ORACLES = {
    "scan_corpus": f"""SELECT doc_id, CASE WHEN doc_id % 10 IN (3, 4, 6) THEN NULL ELSE {CI} END AS ci_id,
        CASE WHEN doc_id % 10 IN (3, 4) THEN 'json_error' WHEN doc_id % 10 = 6 THEN 'no_id' ELSE 'ok' END AS status,
        CASE WHEN doc_id % 10 IN (3, 4) THEN 0 ELSE len(string_split(coalesce(text, ''), chr(10))) - 1 END::BIGINT AS sentences FROM documents""",
    "scan_eligible": f"""SELECT {CI} AS ci_id, 'DUMMY' AS label, array_to_string(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> ''), ' ') AS lemmas
        FROM documents WHERE doc_id % 10 NOT IN (3, 4)""",
    "wordlist": "SELECT DISTINCT lower(n_name) AS word FROM nation",
    "scan_tsv_comment": "SELECT 2::BIGINT AS n, doc_id || '|' || source AS fields FROM documents WHERE doc_id % 7 <> 0",
    "topic_keys_topn": "SELECT n_nationkey AS topic, array_to_string(string_split(n_name || ' a b c', ' ')[1:3], ' ') AS words FROM nation WHERE n_nationkey % 5 <> 4",
    "text_last_wins": "SELECT 'src' || (doc_id % 20) || '-1900-01-01-a-i' || lpad((doc_id % 400)::VARCHAR, 4, '0') AS ci_ref, arg_max(text, doc_id) AS original_text FROM documents GROUP BY ALL",
    "topic_id_coalesce": "SELECT CASE n_nationkey % 3 WHEN 0 THEN 'i' WHEN 1 THEN 't' ELSE '' END || n_nationkey AS topic_id, lower(n_name) || ' w' || n_nationkey AS words FROM nation",
    "collection_filter": "SELECT r_name || '/' || n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name || '/' || n_name GLOB 'A*/*'",
    "lemma_freq": f"{C} SELECT lang, lemma, freq FROM freqs",
    "char_freq": f"{C} SELECT lang, ch, sum(freq)::BIGINT AS freq FROM (SELECT lang, freq, unnest(string_split(lemma, '')) AS ch FROM freqs) WHERE ch <> '' GROUP BY ALL",
    "normalize_lemma": f"{C} SELECT t, {_norm('t')} AS norm FROM (SELECT DISTINCT t FROM tok)",
    "norm_freqs": f"{N} SELECT lang, norm, sum(freq)::BIGINT AS freq FROM normed WHERE norm IS NOT NULL GROUP BY ALL",
    "norm_diagnostics": f"""{N} SELECT lang, count(*) AS input_types, sum(freq)::BIGINT AS input_freq, count(DISTINCT norm) AS normalized_types,
        coalesce(sum(freq) FILTER (WHERE norm IS NOT NULL), 0)::BIGINT AS normalized_freq, count(*) FILTER (WHERE norm IS NULL) AS removed_types,
        coalesce(sum(freq) FILTER (WHERE norm IS NULL), 0)::BIGINT AS removed_freq, count(*) FILTER (WHERE norm <> lemma) AS changed_types,
        coalesce(sum(freq) FILTER (WHERE norm <> lemma), 0)::BIGINT AS changed_freq FROM normed GROUP BY lang""",
    "norm_examples": f"""{N} SELECT lang, norm, string_agg(lemma || ':' || freq, '|' ORDER BY freq DESC, lemma) AS forms FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, norm ORDER BY freq DESC, lemma) AS r FROM normed WHERE norm <> lemma) WHERE r <= 10 GROUP BY lang, norm""",
    "norm_removed_top": f"{C} SELECT lemma, freq FROM (SELECT lemma, count(*) AS freq FROM lem GROUP BY lemma) WHERE ({_norm('lemma')}) IS NULL ORDER BY freq DESC, lemma LIMIT 100",
    "vocab_filter": f"{C} SELECT lang, lemma, freq FROM freqs WHERE length(lemma) >= {td.MIN_LENGTH} AND freq BETWEEN {td.MIN_FREQ} AND 200 AND lemma NOT IN ({_list(td.EXCLUDE[0])})",
    "set_union_exclude": f"SELECT unnest([{_list(td.EXCLUDE[0])}]) AS word UNION SELECT unnest([{_list(td.EXCLUDE[1])}]) UNION SELECT lower(n_name) FROM nation",
    "join_anti_exclude": f"{C} SELECT lang, lemma, freq FROM freqs WHERE lemma NOT IN ({_list(td.EXCLUDE[0] + td.EXCLUDE[1])})",
    "join_semi_include": f"{C} SELECT lang, lemma, freq FROM freqs WHERE lemma IN ({_list(td.INCLUDE)})",
    "explode_sents": f"{C} SELECT ci_id, sent_pos, lang AS lg, len(ws)::BIGINT AS n FROM sent",
    "explode_tokens": f"{C} SELECT ci_id, sent_pos, tok_pos, t, p, l FROM token",
    "lemma_fallback": f"{C} SELECT ci_id, sent_pos, tok_pos, lemma FROM lem",
    "join_semi_vocab": f"{T} SELECT lang, lemma, count(*) AS n FROM kept GROUP BY ALL",
    "extract_lemmas": f"{T} SELECT ci_id, lang, lemmas FROM doc",
    "eligible_docs": f"{T} SELECT ci_id, lang, n, n_unique, lemmas FROM ok",
    "reject_reasons": f"{T} SELECT lang, coalesce(reason, 'eligible') AS reason, count(*) AS docs, sum(n)::BIGINT AS tokens FROM judged GROUP BY ALL",
    "eligible_strata": f"{T} SELECT {_newspaper('ci_id')} AS newspaper, {_decade('ci_id')} AS decade, count(*) AS docs, sum(n)::BIGINT AS tokens FROM ok GROUP BY ALL",
    "token_extract": f"""{C} SELECT s.ci_id, s.lang AS language, coalesce(string_agg(w, ' ' ORDER BY sent_pos, tok_pos), '') AS tokens
        FROM (SELECT DISTINCT ci_id, lang FROM line WHERE i > 1 AND lang IN ('fr', 'de')) s LEFT JOIN (
          SELECT t.ci_id, sent_pos, tok_pos, l AS w FROM token t JOIN corpus c ON t.ci_id = c.ci_id
          WHERE sent_pos < len(c.ls) - 1 AND p IN ({_list(td.POS)}) AND length(l) >= 3) x ON s.ci_id = x.ci_id GROUP BY s.ci_id, s.lang""",
    "doc_freq": f"{T} SELECT lemma, document_frequency, total_frequency FROM df",
    "rare_lemmas": f"{T} SELECT lemma, document_frequency, total_frequency FROM df WHERE document_frequency <= {td.MAX_DF}",
    "rare_doc_ids": f"{T} SELECT lemma, string_agg(DISTINCT ci_id, '|' ORDER BY ci_id) AS document_ids FROM word SEMI JOIN (SELECT lemma FROM df WHERE document_frequency <= {td.MAX_DF}) r USING (lemma) GROUP BY lemma",
    "docfreq_totals": f"""{T} SELECT (SELECT count(*) FROM ok) AS documents, (SELECT sum(n)::BIGINT FROM ok) AS tokens,
        (SELECT count(*) FROM df) AS vocabulary, (SELECT count(*) FROM df WHERE document_frequency <= {td.MAX_DF}) AS reported""",
    "sample_score_md5": f"{S} SELECT DISTINCT ci_id, score FROM rows",
    "parse_ci_id": f"SELECT ci_id, {_newspaper('ci_id')} AS newspaper, {_year('ci_id')} AS year, {_decade('ci_id')} AS decade FROM ({ODD})",
    "stratum_key": f"SELECT ci_id, {_newspaper('ci_id')} || '|' || {_decade('ci_id')} AS two, {_newspaper('ci_id')} || '|' || {_year('ci_id')} || '|' || {_decade('ci_id')} AS three, 'all' AS none FROM ({ODD})",
    "sample_topk_stratum": f"{S} SELECT stratum, ci_id, label, score FROM capped",
    "sample_dedupe": f"{S} SELECT stratum, ci_id, label FROM single",
    "sample_global": f"{S} SELECT ci_id, label, score FROM chosen",
    "sample_min_noop": f"{S} SELECT ci_id, label, score FROM chosen",
    "smoke_sample": f"{S} SELECT ci_id, score FROM chosen ORDER BY score LIMIT 10",
    "stratum_counts": f"{S} SELECT stratum, available, coalesce(selected, 0) AS selected FROM (SELECT stratum, count(*) AS available FROM rows GROUP BY stratum) LEFT JOIN (SELECT stratum, count(*) AS selected FROM chosen GROUP BY stratum) USING (stratum)",
    "topic_word_probs": f"{W} SELECT topic, word, round(prob, 9) AS prob FROM probs",
    "topic_top_words": f"{W} SELECT topic, rank, word, round(prob, 9) AS prob FROM top",
    "topic_description": f"{W} SELECT topic, count(*) AS n, string_agg(word, ' ' ORDER BY rank) AS words FROM top GROUP BY topic",
    "top_terms": f"{W} SELECT topic, string_agg(word, ' ' ORDER BY rank) AS terms FROM top WHERE rank <= 5 GROUP BY topic",
    "format_topic_id": """SELECT n_nationkey AS topic, 'tm_tp' || lpad(n_nationkey::VARCHAR, 2, '0') || '_fr' AS hundred, 'tm_tp' || lpad(n_nationkey::VARCHAR, 2, '0') || '_fr' AS described,
        'tm_tp' || CASE WHEN n_nationkey * 40 < 10 THEN '0' ELSE '' END || (n_nationkey * 40) || '_fr' AS longer, 'tm_tp' || n_nationkey || '_fr' AS single FROM nation""",
    "parse_dense": f"{D} SELECT idx, t, p FROM share",
    "parse_sparse": f"{D} SELECT idx, t, p FROM share WHERE p >= 0.05",
    "normalize_ci_ref": f"{D} SELECT idx, ci_ref FROM (SELECT idx, ci_ref FROM ref)",
    "topic_round": f"{D} SELECT idx, t, round(p, 3) AS p FROM share",
    "topic_threshold": f"{D} SELECT idx, t, round(p, 3) AS p FROM share WHERE p >= {td.EPS}",
    "assign_dedupe": f"{D} SELECT ci_ref, idx FROM first",
    "dup_count": f"{D} SELECT count(*) - count(DISTINCT ci_ref) AS duplicates FROM ref",
    "assign_sorted": f"{D} SELECT ci_ref, pos, t, p FROM sorted",
    "join_left_text": f"""{D} SELECT ci_ref, original_text FROM first LEFT JOIN (
        SELECT 'src' || (doc_id % 20) || '-1900-01-01-a-i' || lpad((doc_id % 400)::VARCHAR, 4, '0') AS ci_ref, arg_max(text, doc_id) AS original_text
        FROM documents GROUP BY ALL) USING (ci_ref)""",
    "join_left_words": f"""WITH {WEIGHTS}, {DENSE} SELECT ci_ref, t, p, coalesce(words, '') AS words FROM sorted LEFT JOIN (
        SELECT topic, string_agg(word, ' ' ORDER BY rank) AS words FROM top WHERE rank <= 3 GROUP BY topic) w ON t = w.topic""",
    "term_key": f"{C} SELECT t, {_key('t')} AS key FROM (SELECT DISTINCT t FROM tok)",
    "join_term_resolve": f"{L} SELECT topic_id, key, canonical FROM lookup",
    "resolve_terms": f"{L} SELECT topic_id, pos, term, resolved FROM resolved WHERE rationale <> 'twice'",
    "label_validate": f"""{L} SELECT l.topic_id, CASE WHEN label_short IS NULL OR label_long IS NULL OR topic_type IS NULL OR confidence IS NULL OR rationale IS NULL OR terms IS NULL THEN 'missing_field'
        WHEN topic_type NOT IN ({_list(TOPIC_TYPES)}) THEN 'topic_type' WHEN confidence NOT IN ({_list(CONFIDENCES)}) THEN 'confidence'
        WHEN len(terms) NOT BETWEEN 5 AND 10 THEN 'term_count' WHEN f.unknown > 0 THEN 'unknown_term' WHEN f.total NOT BETWEEN 5 AND 10 THEN 'resolved_count' END AS reason
        FROM labels l JOIN (SELECT topic_id, count(*) FILTER (WHERE resolved IS NULL) AS unknown, sum(len(string_split(resolved, '|'))) AS total FROM resolved GROUP BY topic_id) f ON l.topic_id = f.topic_id""",
    "ids_bag_equal": f"""{L}, a AS (SELECT topic_id, count(*) AS n FROM labels GROUP BY ALL), b AS (SELECT DISTINCT topic_id, 1 AS n FROM topics)
        SELECT topic_id, side FROM (SELECT coalesce(a.topic_id, b.topic_id) AS topic_id, coalesce(a.n, 0) - coalesce(b.n, 0) AS extra, CASE WHEN coalesce(a.n, 0) > coalesce(b.n, 0) THEN 'label' ELSE 'topic' END AS side
        FROM a FULL JOIN b ON a.topic_id = b.topic_id), (SELECT unnest(range(1, 10)) AS i) WHERE i <= abs(extra)""",
    "label_summary": f"{L} SELECT confidence, count(*) AS labels, {_NOISE.format('ocr_noise')} AS noise, {_NOISE.format('mixed_uncertain')} AS mixed FROM labels GROUP BY confidence",
    "bow_counts": f"{T} SELECT lang, ci_id, lemma, count(*) AS n FROM word GROUP BY ALL",
}
