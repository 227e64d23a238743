"""Corpus text operators over whole documents, pages and conversations."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import cte, has, query, rnd
from ticketlake import rules as R
from ticketlake.functions import cleanse as X, text as T
from ticketlake.operators.ordering import label_classes, number_in_order
from ticketlake.plans import corpus as C

NS = r"[^\s\x0b\p{Z}\x85\x1c-\x1f]"
SP = r"[\s\x0b\p{Z}\x85\x1c-\x1f]+"


def g(x, pattern, to=" "):
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def sql_clean(x, symbols=r"[^a-zA-Z0-9\-_./]+"):
    out = f"lower(COALESCE({x}, ''))"
    for p in (r"<[^>\n]*>", rf"https?://{NS}+|www\.{NS}+", rf"{NS}+@{NS}+", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", r"(ticket|inc|req)[-_ ]?\p{Nd}+"):
        out = g(out, p)
    for p, to in ((r"!+", "!"), (r"\?+", "?"), (r"\.+", "."), (r",+", ",")):
        out = g(out, p, to)
    return f"trim({g(out, symbols)})"


def sql_noise(x):
    for phrase in R.NOISE_PHRASES:
        x = f"replace({x}, '{phrase}', ' ')"
    return f"trim({g(x, SP)})"


def sql_words(x):
    return f"list_filter(string_split({x}, ' '), lambda x: x <> '')"


def sql_raw_words(x):
    return f"list_filter(regexp_split_to_array({x}, '{SP}'), lambda x: x <> '')"


def sql_rep(w):
    return f"CASE WHEN len({w}) = 0 THEN 0.0 ELSE 1 - len(list_distinct({w})) / len({w})::DOUBLE END"


def sql_uwr(w):
    return f"CASE WHEN len({w}) = 0 THEN 0.0 ELSE len(list_distinct({w})) / len({w})::DOUBLE END"


def sql_awl(w):
    return f"CASE WHEN len({w}) = 0 THEN 0.0 ELSE length(array_to_string({w}, '')) / len({w})::DOUBLE END"


def sql_share(x, cls):
    return f"CASE WHEN length({x}) = 0 THEN 0.0 ELSE (length({x}) - length({g(x, cls, '')})) / length({x})::DOUBLE END"


SPECIAL = r"[^a-zA-Z0-9\s\x0b\p{Z}\x85\x1c-\x1f]+"

# ---- repeated phrases: leftmost start, shortest phrase, as often as it follows itself ------------
def _edge(x):
    """Whether position x of s is a word boundary."""
    return f"(regexp_matches(substr(s, ({x})::INT - 1, 1), '[a-z0-9_]') <> regexp_matches(substr(s, ({x})::INT, 1), '[a-z0-9_]'))"


def collapse_ctes(prefix, source):
    """`{prefix}_collapsed (s, collapsed)` for the distinct cleaned texts s of a query.

    A phrase ends at a blank, so its first piece (from a boundary to the end of the word) starts the word in which the copy
    starts. Candidates come from equal pieces and words at one distance; a recursive walk then takes them from left to
    right and follows each phrase as long as it repeats.
    """
    n = f"corpus_{prefix}"
    cte(f"{n}_src", f"SELECT row_number() OVER () AS k, s, string_split(s, ' ') AS t FROM (SELECT DISTINCT s FROM ({source}) WHERE s <> '')")
    cte(f"{n}_tok", f"""SELECT k, j, w, 1 + coalesce(sum(length(w) + 1) OVER (PARTITION BY k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM (SELECT k, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS j FROM {n}_src)""")
    # pieces of plain words are the words; others may start at any boundary inside
    cte(f"{n}_piece", f"""SELECT k, j, a + o AS i, w[o + 1:] AS p FROM (SELECT *, unnest(CASE WHEN regexp_full_match(w, '[a-z0-9]+') THEN [0] ELSE
    list_filter(range(0, length(w)), lambda o: regexp_matches(CASE WHEN o = 0 THEN ' ' ELSE w[o] END, '[a-z0-9_]') <> regexp_matches(w[o + 1], '[a-z0-9_]')) END) AS o FROM {n}_tok)""")
    after = "regexp_matches({0}[-1], '[a-z0-9_]') <> regexp_matches({1}[length({0}) + 1], '[a-z0-9_]')"
    cte(f"{n}_one", f"""SELECT x.k, x.i, length(p) AS len FROM {n}_piece x JOIN {n}_tok y ON y.k = x.k AND y.j = x.j + 1 WHERE prefix(y.w, x.p) AND {after.format("x.p", "y.w")}""")
    cte(f"{n}_pair", f"""SELECT x.k, x.j, x.i, y.j AS j2, y.a - 1 - x.i AS len FROM (SELECT * FROM {n}_piece ANTI JOIN {n}_one USING (k, i)) x JOIN {n}_tok y ON y.k = x.k AND y.w = x.p AND y.j >= x.j + 2""")
    cte(f"{n}_near", f"""SELECT c.* FROM {n}_pair c JOIN {n}_tok x ON x.k = c.k AND x.j = c.j + 1 JOIN {n}_tok y ON y.k = c.k AND y.j = c.j2 + 1 WHERE c.j2 = c.j + 2 AND prefix(y.w, x.w) OR x.w = y.w""")
    cte(f"{n}_more", f"""SELECT c.k, c.i, c.len FROM {n}_near c JOIN {n}_src x USING (k)
  WHERE 2 * j2 - j - 1 <= len(t) AND t[j + 1:j2 - 2] = t[j2 + 1:2 * j2 - j - 2] AND prefix(t[2 * j2 - j - 1], t[j2 - 1]) AND {after.format("t[j2 - 1]", "t[2 * j2 - j - 1]")}""")
    cte(f"{n}_best", f"SELECT k, list(i ORDER BY i) AS starts, list(len ORDER BY i) AS lens FROM (SELECT k, i, min(len) AS len FROM (SELECT * FROM {n}_one UNION ALL SELECT * FROM {n}_more) GROUP BY k, i) GROUP BY k")
    cte(f"{n}_walk", f"""SELECT * FROM (WITH RECURSIVE walk(k, i, len, e) AS (
    SELECT k, starts[1]::BIGINT, lens[1]::BIGINT, (starts[1] + lens[1])::BIGINT FROM {n}_best
    UNION ALL SELECT k, CASE WHEN on_ THEN i ELSE starts[f] END, CASE WHEN on_ THEN len ELSE lens[f] END, CASE WHEN on_ THEN e + len + 1 ELSE starts[f] + lens[f] END
    FROM (SELECT *, CASE WHEN NOT on_ THEN list_position(list_transform(starts, lambda x: x >= e), true) END AS f
      FROM (SELECT w.*, b.starts, b.lens, substr(s, e::INT, len::INT + 1) = ' ' || substr(s, i::INT, len::INT) AND {_edge("e + len + 1")} AS on_
        FROM walk w JOIN {n}_best b USING (k) JOIN {n}_src USING (k)))
    WHERE on_ OR f > 0) SELECT k, i, len, max(e) AS e FROM walk GROUP BY k, i, len)""")
    cte(f"{n}_collapsed", f"""SELECT any_value(s) AS s, trim(string_agg(part, '' ORDER BY i) || substr(any_value(s), max(e)::INT)) AS collapsed FROM (
    SELECT *, substr(s, b::INT, (i - b)::INT) || substr(s, i::INT, len::INT) AS part FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY k ORDER BY i), 1) AS b FROM {n}_walk) JOIN {n}_src USING (k)) GROUP BY k
  UNION ALL SELECT s, trim(s) FROM {n}_src ANTI JOIN {n}_walk USING (k) UNION ALL SELECT '', ''""")


# ---- cleaned corpus ------------------------------------------------------------------------------
collapse_ctes("ticket", f"SELECT {sql_noise(sql_clean('text_corpus'))} AS s FROM bronze_ticket_texts")
_TURNS = """SELECT md5(a.conv_id || '|' || a.turn) AS rag_id, a.conv_id, a.turn, a.text AS problem_text, b.text AS solution_text
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'"""
collapse_ctes("turn", f"SELECT {sql_noise(sql_clean('problem_text'))} AS s FROM ({_TURNS}) UNION ALL SELECT {sql_noise(sql_clean('solution_text'))} FROM ({_TURNS})")
cte("corpus_steps", f"""
SELECT *, len(w) AS text_word_count, length(retrieval_text_clean) AS text_char_count, {sql_rep('w')} AS repetition_ratio
FROM (SELECT *, {sql_words('retrieval_text_clean')} AS w FROM (SELECT b.*, c.collapsed AS retrieval_text_clean
  FROM (SELECT *, {sql_noise(sql_clean('text_corpus'))} AS s FROM bronze_ticket_texts) b JOIN corpus_ticket_collapsed c ON c.s = b.s))
""")
cte("corpus_clean", f"""
SELECT * EXCLUDE (rn) FROM (SELECT doc_id, {', '.join(C.CLEAN_COLUMNS)}, ROW_NUMBER() OVER (PARTITION BY ticket_pk ORDER BY doc_id) AS rn FROM corpus_steps
  WHERE text_source_type = 'real_text' AND {has('text_corpus')} AND length(text_corpus) >= 20 AND length(retrieval_text_clean) >= 20 AND text_word_count >= 5)
WHERE rn = 1 AND repetition_ratio <= 0.6
""")
cte("corpus_features", f"""
SELECT *, avg_word_length * 0.4::DOUBLE + unique_word_ratio * 0.4::DOUBLE + text_word_count / 100 * 0.2::DOUBLE AS text_complexity_score,
  (COALESCE(corpus_quality_score, 0) + COALESCE(similarity_confidence, 0) + COALESCE(unique_word_ratio, 0)) / 3 AS retrieval_quality_score,
  'doc_' || md5(ticket_pk) AS document_id
FROM (SELECT * EXCLUDE (w), {sql_awl('w')} AS avg_word_length, {sql_uwr('w')} AS unique_word_ratio, {sql_share('retrieval_text_clean', r'[\p{Lu}]+')} AS uppercase_ratio,
  {sql_share('retrieval_text_clean', r'[\p{Nd}]+')} AS digit_ratio, {sql_share('retrieval_text_clean', SPECIAL)} AS special_char_ratio
FROM (SELECT *, {sql_words('retrieval_text_clean')} AS w FROM corpus_clean))
""")
cte("corpus_chunks", r"""
SELECT document_id || '_chunk_' || i AS chunk_id, document_id, ticket_pk, doc_id, priority_encoded, urgency_encoded, impact_encoded, retrieval_quality_score,
  i AS chunk_index, array_to_string(p, ' ') AS chunk_text, len(p) AS chunk_word_count, CAST(floor(len(p) / 0.75) AS INT) AS chunk_token_estimate,
  regexp_extract_all(array_to_string(p, ' '), '[\p{L}\p{N}_]+') AS bm25_tokens
FROM (SELECT * EXCLUDE (i, w), CAST(i AS INT) AS i, list_slice(w, i * 206 + 1, i * 206 + 256) AS p FROM (
  SELECT *, string_split(retrieval_text_clean, ' ') AS w, unnest(range(CAST(ceil(text_word_count / 206.0) AS BIGINT))) AS i FROM corpus_features)) WHERE len(p) >= 5
""")
cte("corpus_pairs", f"""
SELECT *, len(pw) AS problem_word_count, length(problem_text_clean) AS problem_char_count, {sql_rep('pw')} AS problem_repetition_ratio,
  len(sw) AS solution_word_count, length(solution_text_clean) AS solution_char_count, {sql_rep('sw')} AS solution_repetition_ratio
FROM (SELECT *, {sql_words('problem_text_clean')} AS pw, {sql_words('solution_text_clean')} AS sw FROM (
  SELECT q.* EXCLUDE (ps, ss), x.collapsed AS problem_text_clean, y.collapsed AS solution_text_clean
  FROM (SELECT *, {sql_noise(sql_clean('problem_text'))} AS ps, {sql_noise(sql_clean('solution_text'))} AS ss FROM ({_TURNS})) q
  JOIN corpus_turn_collapsed x ON x.s = q.ps JOIN corpus_turn_collapsed y ON y.s = q.ss
  WHERE {has('problem_text')} AND {has('solution_text')} AND length(problem_text) >= 20 AND length(solution_text) >= 20))
WHERE length(problem_text_clean) >= 20 AND length(solution_text_clean) >= 20 AND len(pw) >= 5 AND len(sw) >= 5
""")
cte("corpus_pairs_ok", "SELECT * EXCLUDE (pw, sw) FROM corpus_pairs WHERE problem_repetition_ratio <= 0.6 AND solution_repetition_ratio <= 0.6")


def texts(t):
    return t.bronze("ticket_texts")


def docs(t):
    return t.documents.select("doc_id", "text")


# ---- operators -----------------------------------------------------------------------------------
@query("tx1_text_source", "SELECT doc_id, md5(CASE WHEN text_source_type = 'real_text' THEN text_corpus ELSE synthetic_text_corpus END) AS picked FROM bronze_ticket_texts")
def _(t):
    return texts(t).select("doc_id", F.md5(C.pick_source()).alias("picked"))


@query("tx2_clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def _(t):
    return docs(t).select("doc_id", T.clean_text("text").alias("cleaned"))


@query("tx2_clean_text_unicode", f"SELECT doc_id, {sql_clean('text', r'[^\p{L}\p{N}\-_./]+')} AS cleaned FROM documents")
def _(t):
    return docs(t).select("doc_id", T.clean_text("text", ascii_only=False).alias("cleaned"))


@query("tx2_clean_html_pages", f"SELECT page_id, {sql_clean('html')} AS cleaned, trim({g(g('html', r'<[^>\n]*>'), SP)}) AS visible FROM pages")
def _(t):
    return t.pages.select("page_id", T.clean_text("html").alias("cleaned"), F.trim(F.regexp_replace(T.strip_html("html"), T.SPACE, " ")).alias("visible"))


@query("tx3_boilerplate", f"SELECT doc_id, {sql_noise('lower(text)')} AS stripped FROM documents")
def _(t):
    return docs(t).select("doc_id", T.remove_boilerplate(F.lower("text")).alias("stripped"))


collapse_ctes("document", f"SELECT {sql_noise(sql_clean('text'))} AS s FROM documents")


@query("tx4_repeated_phrases", f"SELECT doc_id, collapsed FROM documents JOIN corpus_document_collapsed ON s = {sql_noise(sql_clean('text'))}")
def _(t):
    return docs(t).select("doc_id", C.normalise(F.col("text")).alias("collapsed"))


_WORD, _BLANK = r"[\p{L}\p{N}_]+", r"[\s\x0b\p{Z}\x85\x1c-\x1f]+"
_SPACED = rf"""SELECT doc_id, i, regexp_extract(x, '^{_WORD}') AS w, CASE WHEN regexp_full_match(regexp_replace(x, '^{_WORD}', ''), '{_BLANK}') THEN regexp_replace(x, '^{_WORD}', '') END AS s
  FROM (SELECT doc_id, unnest(x) AS x, unnest(range(len(x))) AS i FROM (SELECT doc_id, regexp_extract_all(lower(COALESCE(text, '')), '{_WORD}[^\p{{L}}\p{{N}}_]*') AS x FROM documents))"""
# a phrase of m words: m words and m - 1 spaces recur m words ahead, and white space follows each of them
_MARKS = ", ".join(f"s IS NOT NULL AND w = lead(w, {m}) OVER o AS w{m}, s = lead(s, {m}) OVER o AS s{m}" for m in range(2, 7))
_RUNS = " OR ".join(f"count_if(w{m}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING) = {m} AND count_if(w{m} AND s{m}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {m - 2} FOLLOWING) = {m - 1}" for m in range(2, 7))


@query("tx5_repeated_pattern", f"SELECT doc_id, COALESCE(hit, FALSE) AS has_repeat FROM documents LEFT JOIN (SELECT doc_id, bool_or(r) AS hit FROM (SELECT doc_id, {_RUNS} AS r FROM (SELECT *, {_MARKS} FROM ({_SPACED}) WINDOW o AS (PARTITION BY doc_id ORDER BY i))) GROUP BY doc_id) USING (doc_id)")
def _(t):
    w = T.spaced_words("text")
    return docs(t).select("doc_id", "text", w.alias("w")).select("doc_id", T.has_repeated_pattern("w").alias("has_repeat"))


@query("tx6_counts", f"SELECT doc_id, CAST(len({sql_raw_words('text')}) AS INT) AS word_count, CAST(length(text) AS INT) AS char_count FROM documents")
def _(t):
    return docs(t).select("doc_id", T.word_count("text").alias("word_count"), F.char_length("text").alias("char_count"))


@query("tx7_repetition_ratio", f"SELECT doc_id, {rnd(sql_rep('w'), 6)} AS repetition_ratio FROM (SELECT doc_id, {sql_raw_words('text')} AS w FROM documents)")
def _(t):
    return docs(t).select("doc_id", T.words("text").alias("w")).select("doc_id", X.rounded(T.repetition_ratio(F.col("w")), 6).alias("repetition_ratio"))


@query("tx8_word_features", f"SELECT doc_id, {rnd(sql_awl('w'), 6)} AS avg_word_length, {rnd(sql_uwr('w'), 6)} AS unique_word_ratio FROM (SELECT doc_id, {sql_raw_words('text')} AS w FROM documents)")
def _(t):
    return docs(t).select("doc_id", T.words("text").alias("w")).select(
        "doc_id", X.rounded(T.avg_word_length(F.col("w")), 6).alias("avg_word_length"), X.rounded(T.unique_word_ratio(F.col("w")), 6).alias("unique_word_ratio")
    )


@query(
    "tx9_char_ratios",
    f"SELECT doc_id, {rnd(sql_share('text', r'[\p{Lu}]+'), 6)} AS uppercase_ratio, {rnd(sql_share('text', r'[\p{Nd}]+'), 6)} AS digit_ratio, {rnd(sql_share('text', SPECIAL), 6)} AS special_char_ratio FROM documents",
)
def _(t):
    return docs(t).select(
        "doc_id", X.rounded(T.uppercase_ratio("text"), 6).alias("uppercase_ratio"), X.rounded(T.digit_ratio("text"), 6).alias("digit_ratio"),
        X.rounded(T.special_char_ratio("text"), 6).alias("special_char_ratio"),
    )


def _features(t):
    return C.with_features(C.clean(texts(t)), encode=False)


@query("tx10_complexity", f"SELECT document_id, {rnd('text_complexity_score', 6)} AS text_complexity_score FROM corpus_features")
def _(t):
    return _features(t).select("document_id", X.rounded("text_complexity_score", 6).alias("text_complexity_score"))


@query("tx11_retrieval_quality", f"SELECT document_id, {rnd('retrieval_quality_score', 6)} AS retrieval_quality_score FROM corpus_features")
def _(t):
    return _features(t).select("document_id", X.rounded("retrieval_quality_score", 6).alias("retrieval_quality_score"))


@query(
    "tx12_density_formatting",
    f"SELECT document_id, {rnd('text_word_count / text_char_count::DOUBLE', 6)} AS text_content_density, {rnd('uppercase_ratio + digit_ratio + special_char_ratio', 6)} AS text_formatting_ratio FROM corpus_features",
)
def _(t):
    return _features(t).select(
        "document_id", X.ratio("text_word_count", "text_char_count", 6).alias("text_content_density"),
        X.rounded(F.col("uppercase_ratio") + F.col("digit_ratio") + F.col("special_char_ratio"), 6).alias("text_formatting_ratio"),
    )


@query("tx13_label_encode", "SELECT label, ROW_NUMBER() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT COALESCE(source, 'None') AS label FROM documents)")
def _(t):
    return label_classes(t.documents, "source")


@query("tx14_document_ids", "SELECT doc_id, 'doc_' || (ROW_NUMBER() OVER (ORDER BY doc_id) - 1) AS document_id FROM documents")
def _(t):
    numbered = number_in_order(t.documents.select("doc_id"), "doc_id", "n", start=0)
    return numbered.select("doc_id", F.concat(F.lit("doc_"), F.col("n").cast("string")).alias("document_id"))


@query(
    "tx15_metadata_json",
    """SELECT document_id, '{"ticket_pk":"' || ticket_pk || '","source_system":"' || source_system || '","priority_encoded":' || COALESCE(CAST(priority_encoded AS VARCHAR), 'null')
  || ',"urgency_encoded":' || COALESCE(CAST(urgency_encoded AS VARCHAR), 'null') || ',"impact_encoded":' || COALESCE(CAST(impact_encoded AS VARCHAR), 'null')
  || ',"similarity_method":"' || similarity_method || '","corpus_quality_score":' || CAST(corpus_quality_score AS VARCHAR) || ',"similarity_confidence":'
  || COALESCE(CAST(similarity_confidence AS VARCHAR), 'null') || '}' AS metadata_json FROM corpus_features""",
)
def _(t):
    return _features(t).select("document_id", "metadata_json")


_CONTEXT = """'category ' || conv_id % 5 AS category, CASE turn % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END AS priority,
  CASE conv_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' END AS language, 'product ' || conv_id % 7 AS product, conv_id % 4 = 0 AS is_sla_breached,
  (conv_id % 10)::DOUBLE AS issue_complexity_score, (turn % 8)::DOUBLE / 2 AS sla_risk_score, CASE WHEN conv_id % 6 = 0 THEN 'high' ELSE 'low' END AS escalation_risk_level"""
cte("corpus_pair_rows", f"SELECT *, {_CONTEXT} FROM corpus_pairs_ok")


def _pairs(t):
    return C.clean_pairs(C.enrich_pairs(C.pairs(t.conversations)))


@query(
    "tx16_retrieval_document",
    r"""SELECT rag_id, concat_ws(chr(10), '[PROBLEM]', problem_text_clean, '[RESOLUTION]', solution_text_clean, '[CONTEXT]', 'Category  : ' || category, 'Priority  : ' || priority,
  'Product   : ' || product, 'Language  : ' || COALESCE(language, 'unknown'), 'Escalation: ' || escalation_risk_level,
  'SLA Status: ' || CASE WHEN is_sla_breached THEN 'breached' ELSE 'met' END) AS retrieval_text_clean FROM corpus_pair_rows""",
)
def _(t):
    return C.pair_features(_pairs(t)).select("rag_id", "retrieval_text_clean")


@query("tx17_token_estimate", f"SELECT doc_id, CAST(floor(n / 0.75) AS INT) AS tokens_from_words, CAST(n AS INT) AS tokens_as_words, CAST(floor(c / 4) AS BIGINT) AS tokens_from_chars FROM (SELECT doc_id, len({sql_raw_words('text')}) AS n, length(text) AS c FROM documents)")
def _(t):
    return docs(t).select("doc_id", T.word_count("text").alias("n"), F.char_length("text").alias("c")).select(
        "doc_id", T.token_estimate("n").alias("tokens_from_words"), F.col("n").alias("tokens_as_words"), F.floor(F.col("c") / 4).alias("tokens_from_chars")
    )


@query(
    "tx18_word_chunks",
    f"SELECT doc_id, CAST(i AS INT) AS chunk_index, array_to_string(list_slice(w, i * 206 + 1, i * 206 + 256), ' ') AS chunk_text FROM (SELECT doc_id, w, unnest(range(CAST(ceil(len(w) / 206.0) AS BIGINT))) AS i FROM (SELECT doc_id, {sql_raw_words('text')} AS w FROM documents))",
)
def _(t):
    return docs(t).select("doc_id", F.posexplode(T.chunks(T.words("text"))).alias("chunk_index", "chunk_text"))


@query(
    "tx19_chunk_rows",
    f"SELECT chunk_id, document_id, ticket_pk, chunk_index, chunk_text, CAST(chunk_word_count AS INT) AS chunk_word_count, chunk_token_estimate, array_to_string(bm25_tokens, ' ') AS bm25_tokens, priority_encoded, {rnd('retrieval_quality_score', 6)} AS retrieval_quality_score FROM corpus_chunks",
)
def _(t):
    return C.chunks_v1(texts(t)).select(
        "chunk_id", "document_id", "ticket_pk", "chunk_index", "chunk_text", "chunk_word_count", "chunk_token_estimate",
        F.array_join("bm25_tokens", " ").alias("bm25_tokens"), "priority_encoded", X.rounded("retrieval_quality_score", 6).alias("retrieval_quality_score"),
    )


@query(
    "tx20_tokenizers",
    rf"""SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), ' ') AS word_tokens, array_to_string({sql_raw_words('lower(text)')}, ' ') AS query_tokens,
  array_to_string(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda x: length(x) >= 2), ' ') AS index_tokens FROM documents""",
)
def _(t):
    return docs(t).select(
        "doc_id", F.array_join(T.bm25_tokens("text"), " ").alias("word_tokens"), F.array_join(T.query_tokens("text"), " ").alias("query_tokens"),
        F.array_join(T.index_tokens("text"), " ").alias("index_tokens"),
    )


def _sql_expand(x, fix):
    arms = " ".join(f"WHEN contains(lower({x}), '{k.lower() if fix else k}') THEN {x} || ' {v}'" for k, v in R.QUERY_EXPANSION)
    return f"CASE {arms} ELSE {x} END"


@query("tx21_query_expansion", f"SELECT conv_id, turn, {_sql_expand('text', False)} AS expanded, {_sql_expand('text', True)} AS expanded_any_case FROM conversations")
def _(t):
    return t.conversations.select("conv_id", "turn", T.expand_query("text").alias("expanded"), T.expand_query("text", fix_case=True).alias("expanded_any_case"))


@query("tx22_duplicate_texts", f"SELECT COUNT(*) AS documents, COUNT(*) - COUNT(DISTINCT text) AS duplicates, {rnd('(COUNT(*) - COUNT(DISTINCT text)) * 100.0 / COUNT(*)', 4)} AS duplicate_pct FROM documents")
def _(t):
    # two steps on a digest: copies collapse before the shuffle, whole texts never travel
    per_text = t.documents.groupBy(F.sha2("text", 256).alias("k")).agg(F.count("*").alias("n"))
    dup = F.sum("n") - F.count("*")
    return per_text.agg(F.sum("n").alias("documents"), dup.alias("duplicates"), X.ratio(dup * 100, F.sum("n")).alias("duplicate_pct"))


@query(
    "fl5_corpus_filters",
    f"SELECT doc_id, ticket_pk, retrieval_text_clean, CAST(text_word_count AS INT) AS text_word_count, CAST(text_char_count AS INT) AS text_char_count, {rnd('repetition_ratio', 6)} AS repetition_ratio FROM corpus_clean",
)
def _(t):
    return C.clean(texts(t)).select(
        "doc_id", "ticket_pk", "retrieval_text_clean", "text_word_count", "text_char_count", X.rounded("repetition_ratio", 6).alias("repetition_ratio")
    )


@query("corpus_v1_full")
def _(t):
    """Whole ticket corpus with phrase collapsing and encoded labels."""
    return C.with_features(C.clean(texts(t)))


@query("corpus_v1_chunks_full")
def _(t):
    return C.chunks_v1(texts(t)).drop("metadata_json")


@query(
    "corpus_v2_pairs",
    f"SELECT rag_id, problem_text_clean, solution_text_clean, category, priority, CAST(problem_word_count AS INT) AS problem_word_count, CAST(solution_char_count AS INT) AS solution_char_count, {rnd('solution_repetition_ratio', 6)} AS solution_repetition_ratio FROM corpus_pair_rows",
)
def _(t):
    return _pairs(t).select(
        "rag_id", "problem_text_clean", "solution_text_clean", "category", "priority", "problem_word_count", "solution_char_count",
        X.rounded("solution_repetition_ratio", 6).alias("solution_repetition_ratio"),
    )


@query(
    "w6_next_turn_pairs",
    "SELECT md5(a.conv_id || '|' || a.turn) AS rag_id, a.conv_id, a.turn, a.text AS problem_text, b.text AS solution_text FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'",
)
def _(t):
    return C.pairs(t.conversations)


@query("w6_next_turn_window", "SELECT conv_id, turn, role, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def _(t):
    return C.next_turn(t.conversations)


_PAIR_CODE = "(CASE priority WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'low' THEN 2 ELSE 3 END)"
_CPX = lambda s: f"({sql_awl(s + 'w')} * 0.4::DOUBLE + {sql_uwr(s + 'w')} * 0.4::DOUBLE + len({s}w) / 100 * 0.2::DOUBLE)"


@query(
    "sc10_pair_escalation",
    f"""SELECT rag_id, code AS priority_encoded, {rnd(f"code * 0.25::DOUBLE + issue_complexity_score * 0.25::DOUBLE + sla_risk_score * 0.20::DOUBLE + {_CPX('p')} * 0.15::DOUBLE + {_CPX('s')} * 0.15::DOUBLE", 6)} AS escalation_risk_score
FROM (SELECT *, {sql_words('problem_text_clean')} AS pw, {sql_words('solution_text_clean')} AS sw,
  (SELECT COUNT(DISTINCT priority) FROM corpus_pair_rows o WHERE o.priority < c.priority) AS code FROM corpus_pair_rows c)""",
)
def _(t):
    return C.pair_features(_pairs(t)).select("rag_id", "priority_encoded", X.rounded("escalation_risk_score", 6).alias("escalation_risk_score"))


@query("pr11_text_audit", "SELECT COUNT(*) AS documents, COUNT(*) FILTER (contains(text, chr(10))) AS with_newline, COUNT(*) FILTER (contains(text, '\\n')) AS with_escaped_newline, COUNT(*) FILTER (repetition > 0.6) AS corrupted FROM (SELECT text, " + sql_rep("w") + " AS repetition FROM (SELECT text, " + sql_raw_words("text") + " AS w FROM documents))")
def _(t):
    rep = T.repetition_ratio(F.col("w"))
    return t.documents.select("text", T.words("text").alias("w")).agg(
        F.count("*").alias("documents"), F.count_if(F.col("text").contains("\n")).alias("with_newline"),
        F.count_if(F.col("text").contains("\\n")).alias("with_escaped_newline"), F.count_if(rep > R.MAX_REPETITION).alias("corrupted"),
    )
