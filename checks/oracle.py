"""The same results in plain SQL, written without looking at how the queries get there."""

from __future__ import annotations

from sedimenta.constants import DEFAULT_CREDIBILITY, SEARCH_TERMS

from . import tables as given

SPACE = r"[ \t\n\x0B\f\r]"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def listing(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def with_tables(select: str, *names: str) -> str:
    """``select`` after the named common tables and those they need, in order."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    tables = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in needed)
    return f"WITH {tables}\n{select.strip()}"


# --- expressions ---------------------------------------------------------------


def label_class(column: str) -> str:
    word = rf"regexp_replace(lower({column}), '^\s+|\s+$', '', 'g')"
    return (
        f"CAST(CASE WHEN {word} IN ('true', 'mostly-true', 'half-true', 'real') THEN 0 "
        f"WHEN {word} IN ('false', 'pants-fire', 'barely-true', 'fake') THEN 1 "
        "ELSE -1 END AS INTEGER)"
    )


def clean(column: str) -> str:
    return (
        f"lower(trim(regexp_replace(regexp_replace({column}, '<[^>]+>', '', 'g'), "
        f"'{SPACE}+', ' ', 'g'), ' '))"
    )


def has_text(column: str) -> str:
    return f"({column} IS NOT NULL AND trim({column}, ' ') <> '')"


def counted(select_from: str) -> str:
    """Words and characters of ``text_clean``, words by splitting."""
    return (
        f"SELECT *, CAST(len(regexp_split_to_array(text_clean, '{SPACE}+')) AS INTEGER) "
        f"AS word_count, CAST(length(text_clean) AS INTEGER) AS char_count FROM {select_from}"
    )


EXCLAMATIONS = (
    "CASE WHEN char_count > 0 THEN CAST(len(regexp_extract_all(text_clean, '!')) AS DOUBLE) "
    "/ char_count ELSE 0.0::DOUBLE END"
)
CAPS = (
    "CASE WHEN length(text) > 0 THEN CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) "
    "AS DOUBLE) / length(text) ELSE 0.0::DOUBLE END"
)
WORD_LENGTH = (
    "CASE WHEN word_count > 0 THEN CAST(char_count AS DOUBLE) / word_count "
    "ELSE 0.0::DOUBLE END"
)


def credibility_of(column: str) -> str:
    cases = " ".join(f"WHEN {text(s)} THEN {c}" for s, c in given.CREDIBILITY.items())
    return f"CAST(CASE {column} {cases} ELSE {DEFAULT_CREDIBILITY} END AS FLOAT)"


# 32-bit Murmur3 with seed 42 over ASCII bytes, in the variant that mixes each byte after the
# last whole word as a word of its own.


def _mod32(expression: str) -> str:
    return f"(({expression}) % 4294967296::UHUGEINT)"


def _rotl(expression: str, bits: int) -> str:
    return _mod32(f"({expression}) * {1 << bits} + ({expression}) // {1 << (32 - bits)}")


def murmur(key: str) -> str:
    whole = (
        f"list_transform(range(length({key}) // 4), lambda i: "
        + " + ".join(
            f"ascii(substr({key}, CAST(4 * i + {n + 1} AS BIGINT), 1))::UHUGEINT * {256 ** n}"
            for n in range(4)
        )
        + ")"
    )
    rest = (
        f"list_transform(range(length({key}) // 4 * 4, length({key})), lambda i: "
        f"ascii(substr({key}, CAST(i + 1 AS BIGINT), 1))::UHUGEINT)"
    )
    mixed = _mod32(f"{_rotl(_mod32('w * 3432918353::UHUGEINT'), 15)} * 461845907::UHUGEINT")
    step = _mod32(f"{_rotl(f'xor(h, {mixed})', 13)} * 5 + 3864292196::UHUGEINT")
    state = f"list_reduce(list_concat([42::UHUGEINT], {whole}, {rest}), lambda h, w: {step})"
    return f"xor({state}, length({key})::UHUGEINT)"


def finished(state: str) -> str:
    """Steps that end the hash, as nested selects so that no expression is repeated."""
    return f"""
        SELECT id, source, xor(h, h // 65536) AS h FROM (
        SELECT id, source, {_mod32('h * 3266489909::UHUGEINT')} AS h FROM (
        SELECT id, source, xor(h, h // 8192) AS h FROM (
        SELECT id, source, {_mod32('h * 2246822507::UHUGEINT')} AS h FROM (
        SELECT id, source, xor(h, h // 65536) AS h FROM ({state})))))
    """


# The hash is read as a signed number; its remainder by ten is made positive.
SPLIT = """
    CASE WHEN m <= 7 THEN 'train' WHEN m = 8 THEN 'val' ELSE 'test' END
"""
SIGNED = "CASE WHEN h >= 2147483648 THEN h::BIGINT - 4294967296 ELSE h::BIGINT END"


def splits(table: str) -> str:
    return f"""
        SELECT id, source, {SPLIT} AS split FROM (
            SELECT id, source, ((({SIGNED}) % 10) + 10) % 10 AS m
            FROM ({finished(f"SELECT id, source, {murmur('id')} AS h FROM {table}")}))
    """


WORDS = ", ".join(f"({text(w)}, {p}::DOUBLE, {text(k)})" for w, p, k in given.WORDS)


def sentiments(table: str) -> str:
    """Mean score of polar words, by looking back from each word."""
    return f"""
        SELECT t.id, t.source,
               CAST(coalesce(round(m.mean, 6), 0.0) AS FLOAT) AS sentiment_score
        FROM {table} t LEFT JOIN (
            SELECT id, source, avg(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, polarity * CASE
                WHEN before.kind = 'negator' THEN -0.5
                WHEN before.kind = 'intensifier' THEN before.strength ELSE 1.0 END))) AS mean
            FROM (
                SELECT id, source, words[i] AS word, CASE WHEN i > 1 THEN words[i - 1] END AS last
                FROM (
                    SELECT id, source, words, unnest(range(1, len(words) + 1)) AS i FROM (
                        SELECT id, source, list_filter(string_split(
                            regexp_replace(text_clean, '[^a-z'' ]', ' ', 'g'), ' '),
                            lambda w: w <> '') AS words
                        FROM {table}))) pairs
            JOIN (SELECT * FROM (VALUES {WORDS}) v(word, polarity, kind)
                  WHERE kind = 'polar') polar USING (word)
            LEFT JOIN (SELECT * FROM (VALUES {WORDS}) v(last, strength, kind)) before
                USING (last)
            GROUP BY id, source) m
        ON t.id = m.id AND t.source = m.source
    """


def silver_of(records: str) -> str:
    return counted(
        f"""(
        SELECT id, text, {clean('text')} AS text_clean, label,
               {label_class('label')} AS label_binary, source, raw_meta
        FROM (SELECT *, row_number() OVER (PARTITION BY text, source ORDER BY id) AS n
              FROM {records} WHERE {has_text('text')})
        WHERE n = 1)"""
    )


SILVER_COLUMNS = (
    "id, text, text_clean, label, label_binary, source, word_count, char_count, raw_meta"
)
GOLD_COLUMNS = (
    "id, text_clean, label_binary, source, word_count, char_count, sentiment_score, "
    "exclamation_ratio, caps_ratio, avg_word_length, source_credibility, split"
)


def gold_of(silver: str, sentiment: str, split: str) -> str:
    return f"""
        SELECT s.id, text_clean, label_binary, s.source, word_count, char_count, sentiment_score,
               {EXCLAMATIONS} AS exclamation_ratio, {CAPS} AS caps_ratio,
               {WORD_LENGTH} AS avg_word_length,
               {credibility_of('s.source')} AS source_credibility, split
        FROM {silver} s
        JOIN {sentiment} m ON s.id = m.id AND s.source = m.source
        JOIN {split} p ON s.id = p.id AND s.source = p.source
        WHERE label_binary <> -1
    """


def after_upsert(target: str, batch: str) -> str:
    return f"""
        SELECT * FROM {batch} UNION ALL BY NAME
        SELECT t.* FROM {target} t WHERE NOT EXISTS (
            SELECT 1 FROM {batch} b WHERE b.id = t.id AND b.source = t.source)
    """


LABEL_WORD = """
    CASE WHEN toxic = 1 THEN 'fake' WHEN quality = 0 THEN 'barely-true'
         WHEN quality = 1 THEN 'mostly-true' ELSE 'unknown' END
"""
DOCUMENT_SPLIT = (
    "CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' ELSE 'test' END"
)

TABLES = {
    "labeled": """
        SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
    "document_records": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, text, {LABEL_WORD} AS label, source,
               CAST(to_json({{'lang': lang, 'n_chars': n_chars}}) AS VARCHAR) AS raw_meta
        FROM labeled
    """,
    "page_records": """
        SELECT CAST(page_id AS VARCHAR) AS id, html AS text, 'half-true' AS label,
               'pages' AS source, CAST(to_json({'url': url}) AS VARCHAR) AS raw_meta
        FROM pages
    """,
    "benchmark_records": """
        SELECT CAST(item_id AS VARCHAR) AS id, text, 'Pants-Fire' || chr(10) AS label,
               'benchmark' AS source, '{}' AS raw_meta
        FROM benchmark
    """,
    "bronze": """
        SELECT * FROM document_records UNION ALL BY NAME SELECT * FROM page_records
        UNION ALL BY NAME SELECT * FROM benchmark_records
    """,
    "changed_records": """
        SELECT CAST(doc_id AS VARCHAR) AS id, 'Checked! ' || text AS text, 'real' AS label,
               source, CAST(to_json({'lang': lang}) AS VARCHAR) AS raw_meta
        FROM documents JOIN labels USING (doc_id)
        UNION ALL BY NAME SELECT * FROM page_records
        UNION ALL BY NAME SELECT * FROM benchmark_records
    """,
    "cleaned": counted(f"(SELECT *, {clean('text')} AS text_clean FROM bronze)"),
    "silver": silver_of("bronze"),
    "sentiment": sentiments("silver"),
    "split": splits("silver"),
    "gold": gold_of("silver", "sentiment", "split"),
    "old_silver": silver_of("document_records"),
    "new_silver": silver_of("changed_records"),
    "old_sentiment": sentiments("old_silver"),
    "new_sentiment": sentiments("new_silver"),
    "old_split": splits("old_silver"),
    "new_split": splits("new_silver"),
    "old_gold": gold_of("old_silver", "old_sentiment", "old_split"),
    "new_gold": gold_of("new_silver", "new_sentiment", "new_split"),
    "turns": f"""
        SELECT *, CASE WHEN role = 'system' THEN '' ELSE 'at://' || conv_id || '/' || turn END
                  AS uri,
               '2024-01-0' || (turn + 1) AS indexed_at,
               {listing(SEARCH_TERMS)}[conv_id % {len(SEARCH_TERMS)} + 1] AS query
        FROM conversations
    """,
    "post_records": """
        SELECT uri AS id, coalesce(text, '') AS text, 'unknown' AS label, 'bluesky' AS source,
               CAST(to_json({'cid': CAST(conv_id AS VARCHAR), 'author_did': role,
                    'author_handle': role || '.example', 'indexed_at': indexed_at,
                    'reply_count': turn, 'repost_count': 0, 'like_count': conv_id % 7,
                    'query': query}) AS VARCHAR) AS raw_meta,
               conv_id, turn, indexed_at, query
        FROM turns
    """,
    "statements": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, text,
               {listing(given.STATEMENT_CLASSES)}[doc_id % {len(given.STATEMENT_CLASSES)} + 1]
                   AS label, 'liar' AS source,
               CAST(to_json({{'subject': lang,
                    'speaker': CASE WHEN source <> 'src3' THEN source END,
                    'split': {DOCUMENT_SPLIT}}}) AS VARCHAR) AS raw_meta
        FROM documents
    """,
    "headlines": f"""
        SELECT split || '_' || (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) AS id,
               text, CASE WHEN quality = 1 THEN 'real' ELSE 'fake' END AS label,
               'fakenewsnet' AS source,
               CAST(to_json({{'news_url': 'https://example.org/' || doc_id,
                    'source_domain': lang, 'tweet_num': 0, 'split': split}}) AS VARCHAR)
                   AS raw_meta
        FROM (SELECT *, {DOCUMENT_SPLIT} AS split FROM labeled)
    """,
    "guesses": """
        SELECT vec_id, label,
               list_position(embedding, list_max(embedding)) - 1 AS position FROM embeddings
    """,
}

NEEDS = {
    "document_records": ["labeled"],
    "bronze": ["document_records", "page_records", "benchmark_records"],
    "changed_records": ["page_records", "benchmark_records"],
    "cleaned": ["bronze"],
    "silver": ["bronze"],
    "sentiment": ["silver"],
    "split": ["silver"],
    "gold": ["silver", "sentiment", "split"],
    "old_silver": ["document_records"],
    "new_silver": ["changed_records"],
    "old_sentiment": ["old_silver"],
    "new_sentiment": ["new_silver"],
    "old_split": ["old_silver"],
    "new_split": ["new_silver"],
    "old_gold": ["old_silver", "old_sentiment", "old_split"],
    "new_gold": ["new_silver", "new_sentiment", "new_split"],
    "post_records": ["turns"],
    "headlines": ["labeled"],
}


def weighted_metrics(rows: str, by: str = "") -> str:
    """Metrics of rows ``(by, label, prediction)``, class by class."""
    also = f"{by}, " if by else ""
    same = f"r.{by} = c.{by} AND " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
        SELECT {also}round(sum(support * f1) / sum(support), 9) AS f1,
               round(sum(hits) / sum(support), 9) AS accuracy,
               round(sum(support * precision) / sum(support), 9) AS precision,
               round(sum(support * recall) / sum(support), 9) AS recall,
               CAST(sum(support) AS BIGINT) AS n_rows
        FROM (
            SELECT *, hits / support AS recall,
                   CASE WHEN given > 0 THEN hits / given ELSE 0.0 END AS precision,
                   2.0 * hits / (support + given) AS f1
            FROM (
                SELECT {f"c.{by}, " if by else ""}c.cls,
                       CAST(count(*) FILTER (r.label = c.cls) AS DOUBLE) AS support,
                       CAST(count(*) FILTER (r.prediction = c.cls) AS DOUBLE) AS given,
                       CAST(count(*) FILTER (r.label = c.cls AND r.prediction = c.cls) AS DOUBLE)
                           AS hits
                FROM (SELECT DISTINCT {also}label AS cls FROM {rows}) c
                JOIN {rows} r ON {same}(r.label = c.cls OR r.prediction = c.cls)
                GROUP BY {f"c.{by}, " if by else ""}c.cls))
        {group}
    """


BINARY = "(SELECT label % 2 AS label, position % 2 AS prediction FROM guesses)"
CANDIDATES = (
    "(SELECT n AS candidate, label % 2 AS label, position % n % 2 AS prediction "
    "FROM guesses, (VALUES (2), (3), (5), (7)) v(n))"
)

AS_OF = "'2024-01-01 00:00:00'"

RECORD = "id, text, label, source, raw_meta"

ORACLE = {
    "normalize_label": f"""
        SELECT doc_id, label, {label_class('label')} AS label_binary FROM (
            SELECT doc_id, {listing(given.LABEL_SPELLINGS)}[doc_id % {len(given.LABEL_SPELLINGS)} + 1]
                   AS label FROM documents)
    """,
    "text_clean": with_tables("SELECT id, source, text_clean FROM cleaned", "cleaned"),
    "word_char_counts": with_tables(
        "SELECT id, source, word_count, char_count FROM cleaned", "cleaned"
    ),
    "filter_nonblank": with_tables(
        f"""
        SELECT * FROM (
            SELECT id, source, text FROM bronze UNION ALL
            SELECT id, 'skeleton', regexp_replace(text, '[^ \\n]', '', 'g') FROM bronze)
        WHERE {has_text('text')}
        """,
        "bronze",
    ),
    "filter_known_labels": with_tables(
        "SELECT id, source, label_binary FROM silver WHERE label_binary <> -1", "silver"
    ),
    "input_validation": with_tables(
        "SELECT id, source, coalesce(length(text) BETWEEN 10 AND 2000, false) AS is_valid "
        "FROM bronze",
        "bronze",
    ),
    "dedup_text_source": with_tables(
        f"""
        SELECT {RECORD} FROM (
            SELECT *, row_number() OVER (PARTITION BY text, source ORDER BY id) AS n FROM bronze)
        WHERE n = 1
        """,
        "bronze",
    ),
    "dedup_stats": with_tables(
        """
        SELECT rows_before, rows_after, rows_before - rows_after AS rows_dropped FROM (
            SELECT (SELECT count(*) FROM bronze) AS rows_before,
                   (SELECT count(*) FROM (SELECT DISTINCT text, source FROM bronze)) AS rows_after)
        """,
        "bronze",
    ),
    "unique_batch_keys": """
        SELECT user_id, event_type, event_id, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)
                   AS n FROM events)
        WHERE n = 1
    """,
    "exclamation_ratio": with_tables(
        f"SELECT id, source, {EXCLAMATIONS} AS exclamation_ratio FROM cleaned", "cleaned"
    ),
    "caps_ratio": with_tables(f"SELECT id, source, {CAPS} AS caps_ratio FROM bronze", "bronze"),
    "avg_word_length": with_tables(
        f"SELECT id, source, {WORD_LENGTH} AS avg_word_length FROM cleaned", "cleaned"
    ),
    "safe_divide": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_tax / l_discount END AS quotient
        FROM lineitem
    """,
    "source_credibility": with_tables(
        f"SELECT id, source, {credibility_of('source')} AS source_credibility FROM bronze",
        "bronze",
    ),
    "source_credibility_join": with_tables(
        """
        SELECT id, b.source, CAST(coalesce(share, 0.5) AS FLOAT) AS source_credibility
        FROM bronze b LEFT JOIN (
            SELECT source, CAST(sum(quality) AS DOUBLE) / count(*) AS share
            FROM labeled WHERE quality IS NOT NULL GROUP BY source) s ON b.source = s.source
        """,
        "bronze", "labeled",
    ),
    "hash_split": with_tables(splits("bronze"), "bronze"),
    "sentiment_score": with_tables(sentiments("silver"), "silver"),
    "sentiment_score_join": with_tables(sentiments("silver"), "silver"),
    "bronze_union": with_tables(f"SELECT {RECORD} FROM bronze", "bronze"),
    "silver_build": with_tables(f"SELECT {SILVER_COLUMNS} FROM silver", "silver"),
    "gold_build": with_tables(f"SELECT {GOLD_COLUMNS} FROM gold", "gold"),
    "layers_refresh": with_tables(f"SELECT {GOLD_COLUMNS} FROM gold", "gold"),
    "bronze_times": with_tables(
        f"SELECT id, source, {AS_OF} AS ingested_at FROM bronze", "bronze"
    ),
    "gold_times": with_tables(
        f"SELECT id, source, {AS_OF} AS ingested_at, {AS_OF} AS processed_at, "
        f"{AS_OF} AS featurized_at FROM gold",
        "gold",
    ),
    "refresh_counts": with_tables(
        f"""
        SELECT 'first' AS run, 'rows_before' AS name, count(*) AS n FROM bronze
        UNION ALL SELECT 'first', 'rows_after', count(*) FROM silver
        UNION ALL SELECT 'again', 'rows_before', 0
        UNION ALL SELECT 'again', 'rows_after', 0
        UNION ALL SELECT run, 'class_' || label_binary, count(*)
        FROM gold, (VALUES ('first'), ('again')) v(run) GROUP BY run, label_binary
        """,
        "bronze", "silver", "gold",
    ),
    "class_distribution": with_tables(
        "SELECT label_binary, count(*) AS n_rows FROM silver WHERE label_binary <> -1 "
        "GROUP BY label_binary",
        "silver",
    ),
    "source_rollup": with_tables(
        """
        SELECT source, count(*) AS n_rows, false AS is_total FROM bronze GROUP BY source
        UNION ALL SELECT NULL, count(*), true FROM bronze
        """,
        "bronze",
    ),
    "split_counts": with_tables(
        "SELECT split, count(*) AS n_rows FROM gold GROUP BY split", "gold"
    ),
    "layer_status": with_tables(
        """
        SELECT 'bronze' AS layer, true AS present, (SELECT count(*) FROM bronze) AS row_count,
               CAST(NULL AS VARCHAR) AS error
        UNION ALL SELECT 'silver', true, (SELECT count(*) FROM silver), NULL
        UNION ALL SELECT 'gold', false, NULL, NULL
        """,
        "bronze", "silver",
    ),
    "export_train": with_tables(
        "SELECT text_clean, label_binary FROM gold WHERE split = 'train'", "gold"
    ),
    "export_val": with_tables(
        "SELECT text_clean, label_binary AS labels FROM gold WHERE split = 'val'", "gold"
    ),
    "merge_insert_only": with_tables(
        f"""
        SELECT {RECORD} FROM document_records UNION ALL
        SELECT {RECORD} FROM changed_records c WHERE NOT EXISTS (
            SELECT 1 FROM document_records d WHERE d.id = c.id AND d.source = c.source)
        """,
        "document_records", "changed_records",
    ),
    "merge_upsert": with_tables(
        f"SELECT {SILVER_COLUMNS} FROM ({after_upsert('old_silver', 'new_silver')})",
        "old_silver", "new_silver",
    ),
    "merge_upsert_gold": with_tables(
        f"SELECT {GOLD_COLUMNS} FROM ({after_upsert('old_gold', 'new_gold')})",
        "old_gold", "new_gold",
    ),
    "ingest_statements": with_tables(f"SELECT {RECORD} FROM statements", "statements"),
    "ingest_headlines": with_tables(f"SELECT {RECORD} FROM headlines", "headlines"),
    "ingest_static": with_tables(
        f"SELECT {RECORD} FROM statements UNION ALL SELECT {RECORD} FROM headlines",
        "statements", "headlines",
    ),
    "ingest_headline_files": """
        SELECT 'all_' || (row_number() OVER (ORDER BY doc_id) - 1) AS id, text, 'fake' AS label, 'fakenewsnet' AS source,
               '{"news_url":"","source_domain":"","tweet_num":0,"split":"all"}' AS raw_meta
        FROM documents
    """,
    "ingest_posts": with_tables(
        f"SELECT {RECORD} FROM post_records WHERE id <> ''", "post_records"
    ),
    "ingest_all_posts": with_tables(
        f"SELECT {RECORD} FROM post_records WHERE id <> ''", "post_records"
    ),
    "quarantined_posts": with_tables(
        """
        SELECT '{"uri":"at://' || conv_id || '","record":{"text' AS line,
               (SELECT count(*) FROM post_records WHERE id <> '') AS n_ingested
        FROM turns WHERE uri = ''
        """,
        "post_records",
    ),
    "posts_top_k": with_tables(
        """
        SELECT query, indexed_at, CAST(conv_id AS VARCHAR) AS cid, text, uri FROM (
            SELECT *, row_number() OVER (PARTITION BY query ORDER BY indexed_at DESC, uri) AS n
            FROM turns)
        WHERE n <= 25 AND uri <> ''
        """,
        "turns",
    ),
    "ingest_capped_posts": with_tables(
        f"""
        SELECT {RECORD} FROM (
            SELECT *, row_number() OVER (PARTITION BY query ORDER BY indexed_at DESC, id) AS n
            FROM post_records)
        WHERE n <= 25 AND id <> ''
        """,
        "post_records",
    ),
    "stream_ingest": with_tables(
        f"""
        SELECT {RECORD} FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY raw_meta) AS n FROM (
                SELECT {RECORD} FROM post_records UNION ALL
                SELECT id, text, label, source,
                       replace(raw_meta, '"query":"' || query, '"query":"archive')
                FROM post_records)
            WHERE id <> '')
        WHERE n = 1
        """,
        "post_records",
    ),
    "row_indexes": """
        SELECT doc_id, lang, n_chars,
               row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) - 1 AS row_index
        FROM documents
    """,
    "first_present_text": with_tables(
        "SELECT doc_id, CASE WHEN quality IS NULL THEN text ELSE quality::VARCHAR END AS text "
        "FROM labeled",
        "labeled",
    ),
    "json_meta": with_tables(
        """
        SELECT doc_id, CAST(to_json({'lang': lang, 'quality': quality,
                    'nested': {'toxic': toxic, 'n_chars': n_chars},
                    'listed': [source, lang]}) AS VARCHAR) AS raw_meta, '{}' AS empty_meta
        FROM labeled
        """,
        "labeled",
    ),
    "token_features": with_tables(
        "SELECT id, source, CAST(len(string_split(text_clean, ' ')) AS INTEGER) AS n_tokens, "
        "len(string_split(text_clean, ' ')) AS n_terms, true AS weighted FROM silver",
        "silver",
    ),
    "train_classifier": with_tables(
        """
        SELECT candidate, reg_param, n_rows, true AS scored, true AS has_loss
        FROM (VALUES (0, 0.001::DOUBLE), (1, 0.01::DOUBLE), (2, 0.1::DOUBLE))
             v(candidate, reg_param),
             (SELECT count(*) AS n_rows FROM gold WHERE split = 'val')
        """,
        "gold",
    ),
    "score_batch": with_tables(
        "SELECT id, source, '1' AS model_version, "
        "coalesce(length(text) BETWEEN 10 AND 2000, false) AS is_valid, "
        "true AS named, true AS sure FROM bronze",
        "bronze",
    ),
    "evaluate_scored": with_tables(
        """
        SELECT label_binary AS label, count(*) AS n_rows, count(DISTINCT (id, source)) AS n_keys,
               0::BIGINT AS n_missing, true AS agrees, true AS named, true AS scored
        FROM gold WHERE split = 'test' GROUP BY label_binary
        """,
        "gold",
    ),
    "argmax_prediction": with_tables(
        "SELECT vec_id, label, CAST(position AS INTEGER) AS position FROM guesses", "guesses"
    ),
    "class_name": """
        SELECT vec_id, CASE label WHEN 0 THEN 'credible' WHEN 1 THEN 'misinformation'
               ELSE 'unknown' END AS label_name FROM embeddings
    """,
    "confusion_matrix": with_tables(
        f"""
        SELECT CAST(label AS INTEGER) AS truth,
               count(*) FILTER (prediction = 0) AS predicted_credible,
               count(*) FILTER (prediction = 1) AS predicted_misinformation,
               count(*) FILTER (prediction = 2) AS predicted_other
        FROM (SELECT CASE WHEN label < 8 THEN label % 2 END AS label, position % 3 AS prediction
              FROM guesses) GROUP BY label
        """,
        "guesses",
    ),
    "classification_metrics": with_tables(weighted_metrics(BINARY), "guesses"),
    "classification_metrics_many": with_tables(
        weighted_metrics("(SELECT label, position % 13 AS prediction FROM guesses)"), "guesses"
    ),
    "best_model": with_tables(
        f"""
        SELECT CAST(candidate AS INTEGER) AS candidate, * EXCLUDE (candidate)
        FROM ({weighted_metrics(CANDIDATES, 'candidate')}) ORDER BY f1 DESC, candidate LIMIT 1
        """,
        "guesses",
    ),
    "quality_gate": with_tables(
        f"""
        SELECT m.*, train_rows,
               CASE WHEN f1 IS NULL THEN 'pass_with_warning' WHEN f1 < 0.8 THEN 'fail_f1'
                    WHEN train_rows < 15 THEN 'fail_train_rows' ELSE 'pass' END AS gate,
               CASE WHEN f1 >= 0.8 AND train_rows >= 15 THEN 'production' ELSE 'staging' END
                   AS verdict
        FROM ({weighted_metrics(
            "(SELECT source, quality AS label, 1 - toxic AS prediction FROM labeled "
            "WHERE quality IS NOT NULL)", "source")}) m
        JOIN (SELECT source, count(*) FILTER (split = 'train') AS train_rows
              FROM ({splits("(SELECT CAST(doc_id AS VARCHAR) AS id, source FROM labeled "
                            "WHERE quality IS NOT NULL)")})
              GROUP BY source) t USING (source)
        """,
        "labeled",
    ),
}
