"""SQL that states the expected result of a query over the same tables."""

from __future__ import annotations

# Whitespace code points, as an RE2 class.
WS = r"\x{09}-\x{0d}\x{1c}-\x{1f}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def words(text: str) -> str:
    return f"[w for w in regexp_split_to_array({text}, '[{WS}]+') if w <> '']"


WIDTH = "(SELECT (max(doc_id) + 5) // 5 AS width FROM documents)"
SHARDED = f"SELECT d.*, doc_id // width AS shard FROM documents d, {WIDTH}"
SHARD_NAME = "format('train-{:05d}.parquet', shard)"
TALK = (
    "SELECT conv_id, turn, role, 'c' || conv_id || '_' || turn || '.wav' AS audio_filepath, "
    "length(text) / 16.0 AS duration, text FROM conversations"
)
TURNS = "SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ordinal FROM conversations"
DOC_ORDINAL = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents"
EVENT_ORDINAL = "SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ordinal FROM events"
RAW = "CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type <> 'view' THEN CAST(value AS VARCHAR) END"
MARKED = f"SELECT '▁' || unnest({words('text')}) AS word FROM documents"
WORD_TABLE = f"SELECT word, count(*) AS n FROM ({MARKED}) GROUP BY word"


def char_table(source: str = WORD_TABLE) -> str:
    return (
        "SELECT ch, CAST(sum(n) AS BIGINT) AS n FROM (SELECT unnest(string_split(word, '')) AS ch, n "
        f"FROM ({source})) GROUP BY ch"
    )


def ranked(coverage: float, source: str = WORD_TABLE) -> str:
    return (
        "SELECT ch, n, row_number() OVER (ORDER BY n DESC, ch) AS rank, "
        "sum(n) OVER (ORDER BY n DESC, ch ROWS UNBOUNDED PRECEDING) AS running, "
        f"sum(n) OVER () AS total FROM ({char_table(source)})"
    )


RESERVED = "(0, '<unk>', 'unknown'), (1, '<s>', 'control'), (2, '</s>', 'control'), (3, '<pad>', 'control')"


def char_vocab(coverage: float = 1.0, head: str = RESERVED, size: int = 4, known: str = "''", source: str = WORD_TABLE) -> str:
    return (
        f"SELECT id, piece, 0.0 AS score, kind FROM (VALUES {head}) v(id, piece, kind) UNION ALL "
        f"SELECT {size} - 1 + row_number() OVER (ORDER BY rank), ch, round(ln(CAST(n AS DOUBLE) / total), 6), 'learned' "
        f"FROM ({ranked(coverage, source)}) WHERE running - n < {coverage} * total AND ch NOT IN ({known}) "
        f"AND rank <= {400 - size}"
    )


WORD_RANKED = (
    "SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank, sum(n) OVER () AS total "
    f"FROM ({WORD_TABLE})"
)
WORD_IDS = f"SELECT word, 3 + rank AS id FROM ({WORD_RANKED}) WHERE rank <= 1996"
ENCODED_WORDS = (
    "SELECT doc_id, place, coalesce(id, 0) AS id FROM (SELECT doc_id, unnest(ws) AS w, "
    f"generate_subscripts(ws, 1) AS place FROM (SELECT doc_id, ['▁' || x for x in {words('text')}] AS ws "
    f"FROM documents)) LEFT JOIN ({WORD_IDS}) v ON v.word = w"
)
CHARS = f"string_split(array_to_string(['▁' || x for x in {words('text')}], ''), '')"
LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents"
HEARD = (
    "regexp_replace(regexp_replace(regexp_replace(lower(text), '[.,!?]', '', 'g'), "
    "' (the|and|la|de) ', ' ', 'g'), ' (of|un) ', ' o n ', 'g')"
)


def coded(value: str, alphabet: str) -> str:
    """A list as a string of one ASCII character per entry, so byte distance is entry distance."""
    return f"array_to_string([chr(CAST(list_position({alphabet}, x) AS INT)) for x in {value}], '')"


MANIFEST = (
    "SELECT event_id, CASE WHEN event_id % 97 = 0 THEN '' WHEN event_type <> 'signup' THEN "
    "'u' || user_id || '_' || props || '.wav' ELSE 'e' || event_id || '.wav' END AS audio_filepath, "
    f"CASE WHEN event_id % 89 = 0 THEN '0' ELSE {RAW} END AS raw_duration, "
    "CASE WHEN event_id % 83 <> 0 THEN props END AS text FROM events"
)
KNOWN_AUDIO = "SELECT DISTINCT 'u' || user_id || '_' || props || '.wav' AS path FROM events WHERE event_type <> 'signup'"


def checks(missing: str) -> str:
    return (
        f"SELECT m.*, {missing} AS missing_audio, text IS NULL AS null_text, seconds IS NULL AS bad_duration, "
        "coalesce(seconds = 0, false) AS zero_duration, "
        "coalesce(seconds <> 0 AND seconds NOT BETWEEN 0.1 AND 20, false) AS duration_out_of_range, "
        "audio_filepath <> '' AND copies > 1 AS duplicate_path "
        "FROM (SELECT *, try_cast(raw_duration AS DOUBLE) AS seconds, count(*) OVER (PARTITION BY audio_filepath) AS copies "
        f"FROM ({MANIFEST})) m"
    )


REASONS = ("missing_audio", "null_text", "bad_duration", "zero_duration", "duration_out_of_range", "duplicate_path")
ANY = " OR ".join(REASONS)


def padded(group: str, inner: str) -> str:
    return (
        f"SELECT {group}, (rn - 1) // 16 AS batch, count(*) AS rows, max(duration) AS pad_length, "
        "round(sum(duration), 4) AS used, "
        "round(1 - sum(duration) / (count(*) * max(duration)), 6) AS wasted_share "
        f"FROM (SELECT {group}, value AS duration, row_number() OVER (PARTITION BY {group} ORDER BY event_id) AS rn "
        f"FROM ({inner})) GROUP BY {group}, (rn - 1) // 16"
    )


BUCKET = "(value >= 5)::BIGINT + (value >= 20)::BIGINT + (value >= 60)::BIGINT + (value >= 120)::BIGINT"
MIXED_TEXT = f"SELECT doc_id, text, shard FROM ({SHARDED}) WHERE shard <> 3"
PRESET_WORDS = (
    f"SELECT word, count(*) AS n FROM (SELECT '▁' || unnest({words('text')}) AS word FROM ({MIXED_TEXT})) GROUP BY word"
)
TALK_WORDS = f"SELECT word, count(*) AS n FROM (SELECT '▁' || unnest({words('text')}) AS word FROM conversations) GROUP BY word"
BYTE_ROWS = ", ".join(f"({4 + b}, '<0x{b:02X}>', 'byte')" for b in range(256))
MS = "CAST(round(value * 1000) AS BIGINT)"
FRAMES = f"greatest(0, CAST(floor(({MS} - 25) / 10.0) AS BIGINT) + 1)"

ORACLES: dict[str, str] = {
    "scan_split": f"SELECT doc_id, lang, shard FROM ({SHARDED}) WHERE shard < 3",
    "scan_text_only": "SELECT text FROM documents",
    "text_fallback": MIXED_TEXT,
    "tolerant_scan": f"SELECT doc_id, shard FROM ({SHARDED}) WHERE shard < 3",
    "read_manifest": "SELECT text AS value FROM conversations",
    "read_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "read_manifest_csv": f"SELECT audio_filepath, text FROM ({TALK}) ORDER BY conv_id, turn LIMIT 100",
    "shard_inventory": f"SELECT {SHARD_NAME} AS shard, count(*) AS rows FROM ({SHARDED}) GROUP BY shard",
    "find_shards": f"SELECT DISTINCT {SHARD_NAME} AS shard, true AS has_bytes FROM ({SHARDED})",
    "incremental_ingest": f"SELECT doc_id, {strip('text')} AS text FROM documents WHERE {strip('text')} <> ''",
    "incremental_ingest_sampled": (
        f"SELECT doc_id, {strip('text')} AS text, ordinal FROM "
        "(SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, count(*) OVER () AS total FROM documents) "
        f"WHERE ordinal < total * 3 // 4 AND ordinal % 2 = 0 AND {strip('text')} <> ''"
    ),
    "incremental_word_counts": WORD_TABLE,
    "progress_counters": (
        f"SELECT count(*) AS rows_read, count(*) FILTER ({strip('text')} <> '') AS lines_kept FROM documents"
    ),
    "chunk_plan": (
        "SELECT event_id, chunk, chunk * 1120 AS start_ms, least(1120, total_ms - chunk * 1120) AS length_ms FROM "
        f"(SELECT event_id, total_ms, unnest(range(0, CAST(ceil(total_ms / 1120.0) AS BIGINT))) AS chunk FROM "
        f"(SELECT event_id, {MS} AS total_ms FROM events) WHERE total_ms > 0)"
    ),
    "write_corpus": f"SELECT unnest(string_split({strip('text')}, chr(10))) AS value FROM documents WHERE {strip('text')} <> ''",
    "write_corpus_if_absent": (
        f"SELECT unnest(string_split({strip('text')}, chr(10))) AS value FROM conversations WHERE {strip('text')} <> ''"
    ),
    "write_manifest": f"SELECT audio_filepath, duration, text FROM ({TALK})",
    "export_audio": "SELECT 'c' || conv_id || '_' || turn || '.wav' AS name, 44 + strlen(text) AS bytes FROM conversations",
    "export_audio_report": (
        "WITH named AS (SELECT conv_id, turn, turn <> 4 AND text <> '' AS given, sha256(text) AS sha, "
        "CASE WHEN turn = 5 THEN '../x.wav' ELSE role || '/c' || conv_id % 17 || '.wav' END AS file FROM conversations), "
        "counted AS (SELECT *, count(*) FILTER (given) OVER (PARTITION BY file) AS n, "
        "min(sha) FILTER (given) OVER (PARTITION BY file) AS first FROM named) "
        "SELECT conv_id, turn, CASE WHEN given THEN n ELSE 0 END AS copies, CASE WHEN NOT given THEN 'no_bytes' "
        "WHEN turn = 5 THEN 'bad_name' WHEN sha = first THEN 'written' ELSE 'duplicate' END AS status, file FROM counted"
    ),
    "write_shard_manifest": (
        "SELECT 'train' AS split, 50.0 AS percent, 5 AS total_shards_for_split, 3 AS requested_shards, "
        f"3 AS downloaded_files, {SHARD_NAME} AS shard, count(*) AS rows, 'local' AS source "
        f"FROM ({SHARDED}) WHERE shard < 3 GROUP BY shard"
    ),
    "write_run_manifest": (
        "SELECT 'local-subset' AS profile, 'bpe' AS model_type, 8000 AS vocab_size, 10 AS num_files, "
        "count(*) AS max_samples, 100.0 AS percent FROM documents"
    ),
    "write_vocab": f"SELECT piece, score FROM ({char_vocab()})",
    "clean_text": (
        f"SELECT doc_id, line, {strip('part')} AS text FROM (SELECT doc_id, unnest(ls) AS part, "
        "generate_subscripts(ls, 1) - 1 AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)) "
        f"WHERE {strip('part')} <> ''"
    ),
    "global_ordinal": DOC_ORDINAL,
    "stride_sample": f"SELECT * FROM ({DOC_ORDINAL}) WHERE ordinal % 3 = 0",
    "cap_rows": f"SELECT * FROM ({DOC_ORDINAL}) WHERE ordinal < 450 AND ordinal % 2 = 0",
    "head_percent": (
        f"WITH o AS ({DOC_ORDINAL}), t AS (SELECT count(*) AS n FROM documents), "
        f"f AS (SELECT 5 * count(*) AS n FROM ({SHARDED}) WHERE shard = 0) "
        "SELECT o.*, 'exact' AS total FROM o, t WHERE ordinal < greatest(1, CAST(floor(n * 0.125) AS BIGINT)) UNION ALL "
        "SELECT o.*, 'first_shard' FROM o, f WHERE ordinal < greatest(1, CAST(floor(n * 0.125) AS BIGINT))"
    ),
    "select_shards": f"SELECT {SHARD_NAME} AS shard, count(*) AS rows FROM ({SHARDED}) WHERE shard < 2 GROUP BY shard",
    "coerce_duration": f"SELECT event_id, coalesce(try_cast({RAW} AS DOUBLE), 0.0) AS duration FROM events",
    "audio_path": (
        "SELECT ordinal, CASE WHEN role = 'system' THEN '' ELSE CASE WHEN turn % 3 <> 0 THEN 'audio/' ELSE '' END || "
        "CASE WHEN turn % 2 = 0 THEN 'c' || conv_id || '_' || turn || '.wav' ELSE format('sample_{:06d}.wav', ordinal) END "
        f"END AS audio_filepath FROM ({TURNS})"
    ),
    "manifest_rows": (
        "SELECT ordinal, CASE WHEN role = 'system' THEN '' ELSE CASE WHEN turn % 3 <> 0 THEN 'audio/' ELSE '' END || "
        "CASE WHEN turn % 2 = 0 THEN 'c' || conv_id || '_' || turn || '.wav' ELSE format('sample_{:06d}.wav', ordinal) END "
        f"END AS audio_filepath, CASE WHEN turn = 1 THEN 0.0 ELSE length(text) / 16.0 END AS duration, text FROM ({TURNS})"
    ),
    "manifest_from_nested": (
        "SELECT ordinal, 'c' || conv_id || '_' || turn || '.wav' AS audio_filepath, length(text) / 16.0 AS duration, text "
        f"FROM ({TURNS}) WHERE ordinal < 300 AND role <> 'system' AND turn % 2 = 0"
    ),
    "duration_filter": "SELECT event_id, value AS duration FROM events WHERE value BETWEEN 0.1 AND 20",
    "limit_samples": f"SELECT event_id, value, ordinal FROM ({EVENT_ORDINAL}) WHERE ordinal < 777",
    "bert_normalize": f"SELECT doc_id, strip_accents(lower(regexp_replace(text, '[{WS}]', ' ', 'g'))) AS text FROM documents",
    "collapse_whitespace": (
        f"SELECT page_id, {strip(f'''regexp_replace(html, '[{WS}]+', ' ', 'g')''')} AS html FROM pages"
    ),
    "split_symbols": (
        "SELECT doc_id, unnest(s) AS segment, generate_subscripts(s, 1) - 1 AS position FROM (SELECT doc_id, [x for x in string_split("
        r"regexp_replace(text, '(\*\*\*|%%%|the|th)', chr(31) || '\1' || chr(31), 'g'), chr(31)) if x <> ''] AS s FROM documents)"
    ),
    "pretokenize": (
        r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(word, '▁?(?:\p{Latin}+|\p{Nd}|[^\p{Latin}▁\p{Nd}]+)|(?s:.)')) "
        f"AS word FROM ({MARKED})) GROUP BY word"
    ),
    "segment_counts": (
        r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(word, '▁?(?:\p{Latin}+|\p{Nd}|[^\p{Latin}▁\p{Nd}]+)|(?s:.)')) "
        f"AS word FROM ({MARKED})) GROUP BY word"
    ),
    "bert_word_counts": (
        "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(strip_accents(lower(text)), "
        f"'[^{WS}a-z0-9ßœæ]|[a-z0-9ßœæ]+')) AS word FROM documents) GROUP BY word"
    ),
    "dedup_records": (
        "SELECT strlen(text) AS bytes, sha1(text) AS sha1, min(doc_id) AS doc_id, count(*) AS copies FROM documents "
        "GROUP BY strlen(text), sha1(text)"
    ),
    "dedup_records_rows": (
        "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)"
    ),
    "manifest_validate": (
        f"SELECT count(*) AS rows, count(*) FILTER (NOT ({ANY})) AS valid, "
        + ", ".join(f"count(*) FILTER ({r}) AS {r}" for r in REASONS)
        + f" FROM ({checks('''audio_filepath = '' ''')})"
    ),
    "manifest_rejects": (
        "SELECT event_id, concat_ws(',', " + ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in REASONS) + ") AS reasons "
        f"FROM ({checks(f'audio_filepath NOT IN (SELECT path FROM ({KNOWN_AUDIO}))')})"
    ),
    "audio_probe": (
        "SELECT 'c' || conv_id || '_' || turn || '.wav' AS id, r AS sample_rate, 1 AS channels, 2 AS sample_width, "
        "strlen(text) // 2 AS frames, (strlen(text) // 2) / CAST(r AS DOUBLE) AS duration, r = 16000 AS rate_ok "
        "FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN 16000 ELSE 8000 END AS r FROM conversations)"
    ),
    "extraction_counters": (
        f"SELECT count(DISTINCT shard) AS files_processed, count(*) AS rows_read, "
        f"count(*) FILTER ({strip('text')} <> '') AS lines_kept FROM ({SHARDED})"
    ),
    "corpus_stats": (
        "SELECT count(*) AS rows, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines, "
        "CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes, round(sum(strlen(text) + 1) / 1048576.0, 6) AS megabytes FROM documents"
    ),
    "manifest_counts": "SELECT role AS manifest, count(*) AS sentences FROM conversations GROUP BY ROLLUP (role)",
    "word_counts": WORD_TABLE,
    "char_coverage": (
        f"SELECT ch, n, rank, round(running / CAST(total AS DOUBLE), 9) AS share, running - n < 0.9995 * total AS covered "
        f"FROM ({ranked(0.9995)})"
    ),
    "dataset_hours": "SELECT event_type, count(*) AS rows, round(sum(value) / 3600, 6) AS hours FROM events GROUP BY event_type",
    "training_step_plan": (
        "SELECT lang, count(*) AS samples, CAST(ceil(count(*) / 16.0) AS BIGINT) AS steps_per_epoch, "
        "3 * CAST(ceil(count(*) / 16.0) AS BIGINT) AS max_steps FROM documents GROUP BY lang"
    ),
    "pad_batches": padded("event_type", "SELECT event_type, value, event_id FROM events"),
    "bucket_batches": padded("bucket", f"SELECT {BUCKET} AS bucket, value, event_id FROM events"),
    # Every way to cut the distinct lengths in four, one cut after the other.
    "padding_edges": (
        "WITH RECURSIVE lengths AS (SELECT floor(value / 10) + 1 AS d, count(*) AS n FROM events GROUP BY ALL), "
        "bins AS (SELECT d, n, row_number() OVER (ORDER BY d) AS b, sum(n) OVER (ORDER BY d) AS until FROM lengths), "
        "parts AS (SELECT x.b AS a, y.b AS b, (y.until - x.until + x.n) * y.d AS cost FROM bins x JOIN bins y ON x.b <= y.b), "
        "way AS (SELECT b, cost, [b] AS ends FROM parts WHERE a = 1 UNION ALL "
        "SELECT b, cost, ends FROM (SELECT p.b, w.cost + p.cost AS cost, list_append(w.ends, p.b) AS ends, "
        "row_number() OVER (PARTITION BY p.b ORDER BY w.cost + p.cost) AS place "
        "FROM way w JOIN parts p ON p.a = w.b + 1 WHERE len(w.ends) < 4) WHERE place = 1), "
        "best AS (SELECT ends FROM way WHERE b = (SELECT max(b) FROM bins) ORDER BY cost LIMIT 1), "
        "cut AS (SELECT unnest(ends) AS e, unnest(range(len(ends))) AS bucket FROM best) "
        "SELECT bucket, max(d) AS upper, sum(n)::BIGINT AS rows, sum(n * d)::DOUBLE AS used, (sum(n) * max(d))::DOUBLE AS padded "
        "FROM bins JOIN (SELECT bucket, e, coalesce(lag(e) OVER (ORDER BY e), 0) AS f FROM cut) ON b > f AND b <= e GROUP BY bucket"
    ),
    "frame_budget": (
        f"SELECT event_id, value AS duration, {FRAMES} AS frames, CAST(ceil({FRAMES} / 8.0) AS BIGINT) AS encoder_steps FROM events"
    ),
    "token_length_stats": (
        "SELECT lang, count(*) AS texts, CAST(sum(n) AS BIGINT) AS tokens, min(n) AS shortest, max(n) AS longest, "
        "round(avg(n), 6) AS average, quantile_disc(n, 0.5) AS median "
        f"FROM (SELECT lang, len({CHARS}) AS n FROM documents) GROUP BY lang"
    ),
    "error_rates": (
        "SELECT role, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS ref_chars, CAST(sum(edits) AS BIGINT) AS char_edits, "
        "round(sum(edits) / CAST(sum(length(text)) AS DOUBLE), 6) AS cer FROM (SELECT role, text, levenshtein("
        f"{coded('r', 'list_distinct(r || h)')}, {coded('h', 'list_distinct(r || h)')}) AS edits FROM (SELECT role, text, "
        f"string_split(text, '') AS r, string_split({HEARD}, '') AS h FROM conversations)) GROUP BY role"
    ),
    "word_error_rates": (
        "SELECT count(*) AS rows, CAST(sum(len(r)) AS BIGINT) AS ref_words, CAST(sum(we) AS BIGINT) AS word_edits, "
        "round(sum(we) / CAST(sum(len(r)) AS DOUBLE), 6) AS wer, CAST(sum(ce) AS BIGINT) AS char_edits, "
        "round(sum(ce) / CAST(sum(length(text)) AS DOUBLE), 6) AS cer FROM (SELECT text, r, "
        f"levenshtein({coded('r', 'list_distinct(r || h)')}, {coded('h', 'list_distinct(r || h)')}) AS we, "
        f"levenshtein({coded('rc', 'list_distinct(rc || hc)')}, {coded('hc', 'list_distinct(rc || hc)')}) AS ce "
        f"FROM (SELECT text, {words('text')} AS r, {words(HEARD)} AS h, string_split(text, '') AS rc, "
        f"string_split({HEARD}, '') AS hc FROM benchmark))"
    ),
    # One row of the alignment table per step; a cell packs cost and, below it, the number of indels.
    "word_edit_parts": (
        f"WITH RECURSIVE items AS (SELECT item_id, {words('text')} AS r, {words(HEARD)} AS h, "
        f"len({words('text')}) + len({words(HEARD)}) + 1 AS scale FROM benchmark), "
        "step AS (SELECT item_id, 0 AS k, list_transform(range(0, len(h) + 1), lambda j: j * (scale + 1)) AS line FROM items "
        "UNION ALL SELECT s.item_id, k + 1, list_transform(range(0, len(h) + 1), lambda j: j * (scale + 1) + list_min("
        "list_transform(range(0, j + 1), lambda i: least(line[i + 1] + scale + 1, CASE WHEN i > 0 THEN line[i] + "
        "CASE WHEN h[i] = r[k + 1] THEN 0 ELSE scale END END) - i * (scale + 1)))) "
        "FROM step s JOIN items USING (item_id) WHERE k < len(r)), "
        "ended AS (SELECT item_id, len(r) AS n, len(h) - len(r) AS more, line[-1] // scale AS cost, line[-1] % scale AS indels "
        "FROM step JOIN items USING (item_id) WHERE k = len(r)) "
        "SELECT item_id, n AS ref_words, cost - indels AS substitutions, (indels + more) // 2 AS insertions, "
        "indels - (indels + more) // 2 AS deletions FROM ended"
    ),
    "best_k_runs": (
        "SELECT * FROM (SELECT o_orderpriority, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority "
        "ORDER BY o_totalprice, o_orderkey) AS rank FROM orders) WHERE rank <= 3"
    ),
    "train_char": char_vocab(0.9995),
    "train_word": (
        f"SELECT id, piece, 0.0 AS score, kind FROM (VALUES {RESERVED}) v(id, piece, kind) UNION ALL "
        f"SELECT 3 + rank, word, round(ln(CAST(n AS DOUBLE) / total), 6), 'learned' FROM ({WORD_RANKED}) WHERE rank <= 1996"
    ),
    "reserve_ids": char_vocab(
        head=RESERVED + ", (4, '<ctl>', 'control'), (5, '***', 'user'), (6, 'the', 'user')", size=7,
        known="'***', 'the', '<ctl>'",
    ),
    "byte_fallback": char_vocab(head=RESERVED + ", " + BYTE_ROWS, size=260),
    "soft_vocab_limit": f"SELECT 4 + count(*) AS pieces, 3 + count(*) AS last_id FROM ({WORD_TABLE})",
    "tokenizer_run_name": (
        f"SELECT 'tokenizer_spe_char_v400_max_16_pad_eos' AS run, 4 + count(*) AS pieces FROM ({char_table()})"
    ),
    "train_presets": char_vocab(0.9995, source=PRESET_WORDS),
    "encode_pieces": f"SELECT doc_id, array_to_string({CHARS}, ' ') AS pieces FROM documents",
    "encode_ids": f"SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY place) AS ids FROM ({ENCODED_WORDS}) GROUP BY doc_id",
    "decode_pieces": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS text FROM documents",
    "ids_to_pieces": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS text FROM documents",
    "roundtrip_check": "SELECT lang, count(*) AS texts, count(*) AS unchanged, 0.0 AS mismatch_rate FROM documents GROUP BY lang",
    "token_preview": (
        "SELECT doc_id, array_to_string(list_slice(ids, 1, 8), ' ') || CASE WHEN len(ids) > 8 THEN ' ...' ELSE '' END AS preview, "
        f"len(ids) AS tokens FROM (SELECT doc_id, list(CAST(id AS VARCHAR) ORDER BY place) AS ids FROM ({ENCODED_WORDS}) GROUP BY doc_id)"
    ),
    "vocab_diff": (
        f"SELECT piece, a.id AS old_id, b.id AS new_id, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' "
        f"WHEN a.id = b.id THEN 'kept' ELSE 'moved' END AS status FROM ({char_vocab()}) a "
        f"FULL OUTER JOIN ({char_vocab(source=TALK_WORDS)}) b USING (piece)"
    ),
    "token_counts": f"SELECT 3 + rank AS token, n FROM ({ranked(1.0)})",
    "ordered_shards": f"SELECT {SHARD_NAME} AS shard, count(*) AS rows FROM ({SHARDED}) GROUP BY shard",
    "union_manifests": (
        "SELECT audio_filepath, duration, text, CASE role WHEN 'assistant' THEN 0 WHEN 'system' THEN 1 ELSE 2 END AS file_order "
        f"FROM ({TALK})"
    ),
    "union_manifests_ordered": (
        "SELECT audio_filepath, row_number() OVER (ORDER BY role, conv_id, turn) - 1 AS position "
        f"FROM ({TALK})"
    ),
    "scalar_suite": (
        "SELECT doc_id, format('train-{:05d}.parquet', doc_id) AS shard, format('sample_{:06d}.wav', doc_id) AS sample, "
        "sha1(encode(text)[1:64]) AS sha1_64, strlen(text) AS bytes, CAST(ceil(n_chars / 7.0) AS BIGINT) AS up, "
        "greatest(1, least(n_chars, 999)) AS clamped, doc_id % 3 AS phase, source AS json_source, lang AS base, "
        "coalesce(try_cast(source || '.5' AS DOUBLE), 0.0) AS number, "
        f"array_to_string(list_slice({words('text')}, 1, 3), '|') AS first_words FROM documents"
    ),
}
