"""SQL with the meaning of each query, for an independent engine.

Written from the definitions, not from the Spark plans: global windows and correlated
lists are fine here.
"""

from __future__ import annotations

import re

from textmill import tables
from textmill.registry.decoration import DECORATIONS
from textmill.registry.queries import SEED, VOCAB

FIRST_CONTROL = VOCAB - 10
CONTROL = tables.CONTROL_TOKENS["tiktoken"]

# spellings of the characters that occur in the tables or are put into them
SPELLINGS = {
    "ó": "o", "ñ": "n", "í": "i", "Ó": "O", "Ñ": "N", "Í": "I", "ß": "ss", "—": "-",
    "…": "...", "½": "1/2", "™": "tm", "“": '"', "”": '"', "𝐀": "A", "ﬁ": "fi", "ĳ": "ij",
    "–": "-", "\xa0": " ",
}


# words of other scripts that are put into the tables, letter by letter
SCRIPTS = [
    ("Москва", "Moskva"), ("щука", "shchuka"), ("й", "i"), ("Αθήνα", "Athena"), ("ひらがな", "hiragana"), ("カタカナ", "katakana"),
    ("한글", "hangeul"), ("값", "gabs"), ("שלום", "SHlvm"), ("سلم", "slm"),
]

# characters that pass, one by one as listed, for a class of this engine
PASSING = "\t\n -~" + "".join(
    tables.ALLOWED_LETTERS + tables.ALLOWED_SIGNS + tables.ALLOWED_EMOJI
) + "".join(one for _, one in tables.EMOJI_SENTINELS)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def replaces(expr: str, pairs) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {text(old)}, {text(new)})"
    return expr


def drop(expr: str) -> str:
    return f"regexp_replace({expr}, {text(f'[^{PASSING}]')}, '', 'g')"


def tidy(expr: str) -> str:
    for pattern, new in ((" +\n", "\n"), ("\t+\n", "\n"), ("\n{3,}", "\n\n")):
        expr = f"regexp_replace({expr}, {text(pattern)}, {text(new)}, 'g')"
    return expr


CIRCLED = [(c, str(i)) for i, c in enumerate("①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱", 1)]


def allowed(expr: str) -> str:
    expr = replaces(expr, [("\r", "")])
    expr = replaces(expr, tables.SIGN_REPLACEMENTS)
    expr = replaces(expr, CIRCLED)
    expr = replaces(expr, tables.EMOJI_SENTINELS)
    return drop(replaces(expr, SPELLINGS.items()))


def control(expr: str, family: str = "tiktoken") -> str:
    token = tables.CONTROL_TOKENS[family]
    return replaces(expr, [("\t", token["tab"]), ("\n", token["new_line"])])


def clean(expr: str) -> str:
    return control(f"trim({tidy(allowed(expr))}, {text(' ' + chr(9) + chr(10))})")


def clean_with_ideographs(expr: str) -> str:
    """As :func:`clean`, with the table's spelling of the ideographs that are put into the tables, and no other."""
    for pairs in ([("\r", "")], tables.SIGN_REPLACEMENTS, CIRCLED, tables.EMOJI_SENTINELS, [(c, f"u{ord(c):x} ") for c in "北京東中㐀龥"]):
        expr = replaces(expr, pairs)
    return control(f"trim({tidy(drop(expr))}, {text(' ' + chr(9) + chr(10))})")


def decode(expr: str) -> str:
    return replaces(expr, [(one, many) for many, one in reversed(tables.EMOJI_SENTINELS)])


def quotes(expr: str) -> str:
    return f"""array_to_string(list_transform(string_split({expr}, '"'), lambda part, i:
        CASE WHEN i = 1 THEN part WHEN i % 2 = 0 THEN '«' || part ELSE '»' || part END), '')"""


def digits(expr: str) -> str:
    return rf"regexp_replace({expr}, '(\d)\s*,\s*(\d)', '\1,\2', 'g')"


def wiki(expr: str) -> str:
    return quotes(digits(replaces(expr, tables.WIKI_SPACING)))


def per_text(kind: str, result) -> str:
    return f"SELECT doc_id, {result(replaces('text', DECORATIONS[kind]))} AS text FROM documents"


# --- pieces, vocabulary, tokens ---------------------------------------------
# No look-ahead here: a mark (U+0001) goes in front of the last blank of a run that a
# word follows, and around control tokens (U+0002).

ANY_CONTROL = "|".join(re.escape(t).replace("/", "") for t in CONTROL.values())
GPT2 = (
    rf"{ANY_CONTROL}|'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+"
    r"| ?[^\s\p{L}\p{N}\x01\x02]+|\s+"
)
GPT4 = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}\x01]?\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}\x01]+[\r\n]*|\s*[\r\n]|\s+"
)


def cut2(expr: str) -> str:
    marked = rf"regexp_replace({expr}, '({ANY_CONTROL})', chr(2) || '\1' || chr(2), 'g')"
    apart = rf"regexp_replace({marked}, '(\s+)(\s)([^\s\x02])', '\1' || chr(1) || '\2\3', 'g')"
    return f"regexp_extract_all({apart}, {text(GPT2)})"


def cut4(expr: str) -> str:
    blank = r"[^\S\r\n]"
    apart = (
        rf"regexp_replace({expr}, '({blank}+)({blank})(\S)', '\1' || chr(1) || '\2\3', 'g')"
    )
    return f"regexp_extract_all({apart}, {text(GPT4)})"


def pieces(relation: str, cut=cut2) -> str:
    return f"""SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps)))::INTEGER AS pos
        FROM (SELECT doc_id, {cut('text')} AS ps FROM {relation})"""


def vocabulary(size: int, relation: str = "documents") -> str:
    """CTEs ``raw_pieces`` and ``vocab`` of the texts of a relation."""
    return f"""raw_pieces AS ({pieces(relation)}),
    counted AS (
        SELECT piece, sum(n)::BIGINT AS n FROM (
            SELECT piece, count(*) AS n FROM raw_pieces
            WHERE strlen(piece) <= 32 AND piece NOT IN ({', '.join(map(text, CONTROL.values()))}) GROUP BY piece
            UNION ALL SELECT 'AI', 0)
        GROUP BY piece ORDER BY (piece = 'AI') DESC, n DESC, piece LIMIT {size - 266}),
    vocab AS (
        SELECT piece, n AS occurrences,
            (255 + row_number() OVER (ORDER BY n DESC, piece))::INTEGER AS id FROM counted)"""


CONTROL_ROWS = ", ".join(
    f"({text(name)}, {text(tables.CONTROL_TOKENS['custom'][name])}, "
    f"{text(CONTROL[name])}, {FIRST_CONTROL + i})"
    for i, name in enumerate(CONTROL)
)
BYTES = (
    "list_transform(regexp_extract_all(hex(p.piece), '..'), lambda h: ('0x' || h)::INTEGER)"
)


def tokens(relation: str = "documents", missing: str = BYTES, learned: str = "documents") -> str:
    """CTE ``token``: ``doc_id, pos, j, id`` in byte mode."""
    return f"""{vocabulary(VOCAB, learned)},
    known AS (SELECT piece, id FROM vocab UNION ALL
        SELECT col2, col3 FROM (VALUES {CONTROL_ROWS}) AS c(col0, col1, col2, col3)),
    found AS (
        SELECT p.doc_id, p.pos, p.piece,
            CASE WHEN k.id IS NOT NULL THEN [k.id] ELSE {missing} END AS ids
        FROM ({pieces(relation)}) AS p LEFT JOIN known AS k USING (piece)),
    token AS (
        SELECT doc_id, pos, piece, unnest(ids)::INTEGER AS id,
            unnest(range(len(ids)))::INTEGER AS j, len(ids) AS n FROM found)"""


def split(ratio: float, relation: str = "documents") -> str:
    return f"""SELECT doc_id, source, text,
        CASE WHEN row_number() OVER (ORDER BY md5(doc_id || '-{SEED}'), doc_id)
            <= ceil(count(*) OVER () * {ratio}::DOUBLE) THEN 'val' ELSE 'train' END AS split
        FROM {relation}"""


def token_lists(relation: str = "documents", missing: str = BYTES, extra: str = "") -> str:
    return f"""WITH {extra}{tokens(relation, missing)},
    listed AS (SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY pos, j) AS tokens
        FROM token GROUP BY doc_id)
    SELECT doc_id, coalesce(tokens, '') AS tokens
    FROM (SELECT doc_id FROM {relation}) LEFT JOIN listed USING (doc_id)"""


WHOLE_RANKS = """ranks AS (
        SELECT hex(piece) AS t, id FROM vocab WHERE strlen(piece) > 1
        UNION ALL SELECT printf('%02X', i), i::INTEGER FROM range(256) AS r(i))"""
PREFIX_RANKS = """prefixes AS (
        SELECT DISTINCT piece[:n] AS piece
        FROM (SELECT piece, unnest(range(2, length(piece) + 1)) AS n FROM vocab WHERE id < 856)),
    ranks AS (
        SELECT hex(piece) AS t, (255 + row_number() OVER (ORDER BY strlen(piece), piece))::INTEGER AS id FROM prefixes
        UNION ALL SELECT printf('%02X', i), i::INTEGER FROM range(256) AS r(i))"""


def merged_tokens(ranks: str) -> str:
    """Byte-pair merges by recursion: in every distinct piece the lowest-ranked pair becomes one part."""
    return f"""WITH RECURSIVE {vocabulary(VOCAB)}, {ranks},
    cut AS ({pieces('documents')}),
    step(piece, parts) AS (
        SELECT piece, regexp_extract_all(hex(piece), '..') FROM (SELECT DISTINCT piece FROM cut)
        UNION ALL
        SELECT s.piece, list_concat(list_concat(s.parts[:b.i - 1], [s.parts[b.i] || s.parts[b.i + 1]]), s.parts[b.i + 2:])
        FROM step AS s JOIN (
            SELECT piece, min({{'r': r.id, 'i': i}})['i'] AS i
            FROM (SELECT piece, parts, unnest(range(1, len(parts))) AS i FROM step) AS p
            JOIN ranks AS r ON r.t = p.parts[p.i] || p.parts[p.i + 1] GROUP BY piece) AS b USING (piece)),
    last AS (
        SELECT piece, CASE WHEN hex(piece) IN (SELECT t FROM ranks) THEN [hex(piece)] ELSE arg_min(parts, len(parts)) END AS parts
        FROM step GROUP BY piece),
    spelled AS (
        SELECT piece, string_agg(id::VARCHAR, ' ' ORDER BY j) AS ids
        FROM (SELECT piece, unnest(parts) AS t, unnest(range(len(parts))) AS j FROM last) JOIN ranks USING (t) GROUP BY piece)
    SELECT doc_id, string_agg(ids, ' ' ORDER BY pos) AS tokens FROM cut JOIN spelled USING (piece) GROUP BY doc_id"""


def stream(relation: str = "documents") -> str:
    """CTEs up to ``whole``: tokens with both ends, their split and stream position ``g``."""
    return f"""{tokens(relation, learned=relation)},
    parted AS ({split(0.1, relation)}),
    ended AS (
        SELECT doc_id, pos, j, id FROM token
        UNION ALL SELECT doc_id, -1, 0, {FIRST_CONTROL + 2} FROM {relation}
        UNION ALL SELECT doc_id, 2000000000, 0, {FIRST_CONTROL + 9} FROM {relation}),
    whole AS (
        SELECT split, doc_id, pos, j, id,
            row_number() OVER (PARTITION BY split ORDER BY doc_id, pos, j) - 1 AS g
        FROM ended JOIN parted USING (doc_id)),
    stored AS (
        SELECT split, doc_id, min(g) AS start, count(*)::INTEGER AS size,
            string_agg(id::VARCHAR, ' ' ORDER BY g) AS tokens
        FROM whole GROUP BY split, doc_id)"""


STREAM = stream()

SHARDS = "CASE " + " ".join(
    f"WHEN n > {1024 >> i} THEN {1024 >> i}" for i in range(11)
) + " ELSE 1 END"


def sharded(relation: str) -> str:
    return f"""SELECT *, (ntile(k) OVER (PARTITION BY split ORDER BY doc_id) - 1)::INTEGER AS shard
        FROM (SELECT *, {SHARDS} AS k FROM
            (SELECT *, count(*) OVER (PARTITION BY split) AS n FROM {relation}))"""


XS = """xs AS (SELECT split, g // 64 AS block, list(id ORDER BY g) AS x
        FROM whole GROUP BY split, g // 64),
    ys AS (SELECT split, (g - 1) // 64 AS block, list(id ORDER BY g) AS y
        FROM whole WHERE g > 0 GROUP BY split, (g - 1) // 64),
    xy AS (SELECT split, block::BIGINT AS block, x, coalesce(y, []) AS y
        FROM xs LEFT JOIN ys USING (split, block))"""

PADDING = FIRST_CONTROL + 1


def padded(name: str) -> str:
    return f"array_to_string(list_concat({name}, list_transform(range(64 - len({name})), lambda i: {PADDING})), ' ')"


ROLES = "CASE role " + " ".join(
    f"WHEN '{r}' THEN '{{{r}}}'" for r in ("system", "user", "assistant", "human")
) + " ELSE '{unknown}' END"


def roles(spelling: dict[str, str]) -> str:
    return ROLES.format(**spelling)


def rendered(spelling: dict[str, str]) -> str:
    return f"""{text(spelling['start_of_text'])}
        || string_agg({roles(spelling)} || text, '' ORDER BY turn)
        || {text(spelling['end_of_text'])}"""


RECORDS = """records AS (
        SELECT user_id::VARCHAR AS run, ts, iter, (iter + 1) * 8192 AS tokens,
            iter // 20 AS epochs, value AS loss, value * 2 AS val_loss
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1
            AS iter FROM events))"""


def mix(relation: str) -> str:
    return f"""SELECT CASE WHEN grouping(source) = 1 THEN 'Total' ELSE source END AS source,
        count(*) AS documents, sum(size)::BIGINT AS tokens,
        round(100.0::DOUBLE * sum(size)::DOUBLE / (SELECT sum(size) FROM {relation})::DOUBLE, 4)
            AS ratio
    FROM {relation} GROUP BY ROLLUP (source)"""


by_source = """indexed AS (
    SELECT source AS corpus, CASE source WHEN 'src0' THEN 1.0 WHEN 'src1' THEN 0.5 WHEN 'src2' THEN 2.25 ELSE 1.0 END AS f, doc_id,
        length(text)::INTEGER AS size,
        coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM documents)"""


def mixed(indexed: str) -> str:
    """CTEs up to ``streamed``: whole copies, a part by tokens in hash order, interleaved by hash."""
    return f"""cut AS (
        SELECT *, sum(size) OVER (PARTITION BY corpus ORDER BY md5(corpus || '-' || doc_id || '-{SEED}'), doc_id) - size AS before,
            sum(size) OVER (PARTITION BY corpus) AS total FROM {indexed}),
    copied AS (
        SELECT corpus, doc_id, start AS source_start, size,
            unnest(range(1, floor(f)::BIGINT + 1 + CASE WHEN before < (f - floor(f)) * total THEN 1 ELSE 0 END))::INTEGER AS copy FROM cut),
    streamed AS (
        SELECT *, (sum(size) OVER (ORDER BY md5(corpus || '-' || doc_id || '-' || copy || '-{SEED}'), corpus, doc_id, copy) - size)::BIGINT AS start
        FROM copied)"""


def sql() -> dict[str, str]:
    readable = tables.READABLE_CONTROL
    custom = tables.CONTROL_TOKENS["custom"]
    space = tables.WHITE_SPACE
    return {
        "corpus_source": """SELECT doc_id, 'wikipedia' AS source,
            length(text)::INTEGER AS characters FROM documents""",
        "corpus_union": """SELECT source, count(*) AS documents,
            sum(length(text))::BIGINT AS characters
            FROM (SELECT 'wikipedia' AS source, text FROM documents
                UNION ALL SELECT 'openwebtext', html FROM pages) GROUP BY source""",
        "text_array_round_trip": """SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, value
            FROM (SELECT doc_id, unnest(lines) AS value, unnest(range(len(lines))) AS i
                FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
        "control_token_counts": f"""WITH tokens AS (
                SELECT * FROM (VALUES {CONTROL_ROWS}) AS c(name, custom, tiktoken, id)),
            cleaned AS (SELECT conv_id, role, {clean('text')} AS text FROM conversations),
            counts AS (
                SELECT name, CASE
                    WHEN name IN ('start_of_text', 'end_of_text')
                        THEN (SELECT count(DISTINCT conv_id) FROM conversations)
                    WHEN name IN ('system', 'user', 'assistant', 'human')
                        THEN (SELECT count(*) FROM conversations WHERE role = name)
                    WHEN name IN ('tab', 'new_line')
                        THEN (SELECT sum((length(text) - length(replace(text, tiktoken, '')))
                            // length(tiktoken)) FROM cleaned)
                    ELSE 0 END AS n FROM tokens)
            SELECT name, custom, tiktoken, id, n::BIGINT AS n FROM tokens JOIN counts USING (name)""",
        "rank_table": f"""WITH {vocabulary(VOCAB)}
            SELECT hex(piece) AS token, id FROM vocab
            UNION ALL SELECT printf('%02X', i), i::INTEGER FROM range(256) AS r(i)""",
        "token_shards": f"""WITH {STREAM}
            SELECT split, shard, doc_id, start, size, tokens FROM ({sharded('stored')})""",
        "corpus_without_ids": """SELECT row_number() OVER () - 1 AS doc_id, source, md5(text) AS text FROM documents""",
        "raw_tokens_read_back": f"""WITH {STREAM}, {XS}
            SELECT split, block::BIGINT AS block, array_to_string(x, ' ') AS x FROM xs""",
        "tokens_by_index": f"""WITH {STREAM}
            SELECT split, doc_id, start, size, tokens FROM ({sharded('stored')}) WHERE split = 'val'""",
        "raw_tokens_by_index": f"""WITH {STREAM}
            SELECT split, doc_id, start, size, tokens FROM ({sharded('stored')})""",
        "offset_index": f"WITH {STREAM} SELECT split, doc_id, start, size FROM stored",
        "corpus_metadata": f"""WITH {STREAM}
            SELECT 'pretraining' AS training_part, 'wikipedia' AS name,
                count(*) FILTER (split = 'train') AS train,
                count(*) FILTER (split = 'val') AS val,
                0::BIGINT AS test, 1.0::DOUBLE AS multiplier FROM whole""",
        "drop_carriage_returns": per_text("returns", lambda e: replaces(e, [("\r", "")])),
        "replace_signs": per_text("signs", lambda e: replaces(e, tables.SIGN_REPLACEMENTS)),
        "escape_circled_numbers": per_text("circled", lambda e: replaces(e, CIRCLED)),
        "encode_emoji": per_text("emoji", lambda e: replaces(e, tables.EMOJI_SENTINELS)),
        "drop_unknown_characters": per_text("unknown", drop),
        "fold_to_ascii": per_text("folds", lambda e: replaces(e, SPELLINGS.items())),
        "fold_other_scripts": per_text("scripts", lambda e: replaces(e, [*SCRIPTS, *SPELLINGS.items()])),
        "clean_with_large_table": per_text("ideographs", clean_with_ideographs),
        "allowed_text": per_text("everything", allowed),
        "tidy_blanks": per_text("blanks", tidy),
        "strip_text": per_text(
            "none",
            lambda e: f"trim({text(' ' + chr(9) + chr(10) + chr(0x3000))} || {e} || "
            f"{text(' ' + chr(10) + chr(0x1C) + ' ')}, {text(space)})",
        ),
        "controls_to_tokens": per_text("blanks", lambda e: control(e, "custom")),
        "clean_text": per_text("none", clean),
        "clean_text_all_cases": per_text("everything", clean),
        "clean_text_keep_control": per_text(
            "control",
            lambda e: f"array_to_string(list_transform(string_split({e}, '<|tab|>'), "
            f"lambda part: {clean('part')}), '<|tab|>')",
        ),
        "decode_emoji": per_text(
            "emoji", lambda e: decode(replaces(e, tables.EMOJI_SENTINELS))
        ),
        "unclean_keep_control": per_text("everything", lambda e: decode(clean(e))),
        "unclean_conversations": f"""SELECT conv_id, {rendered(readable)} AS text
            FROM conversations GROUP BY conv_id""",
        "wiki_spacing": per_text("spacing", lambda e: replaces(e, tables.WIKI_SPACING)),
        "join_digit_commas": per_text("digits", digits),
        "pair_quotes": per_text("quotes", quotes),
        "clean_wiki": per_text("wiki", wiki),
        "wiki_then_clean": per_text("wiki", lambda e: clean(wiki(e))),
        "character_audit": f"""SELECT character, count(*) AS occurrences,
                regexp_matches(character, {text(f'^[{PASSING}]$')}) AS authorized
            FROM (SELECT unnest(regexp_extract_all(
                {replaces('text', DECORATIONS['everything'])}, '(?s).')) AS character FROM documents)
            GROUP BY character""",
        "min_size": f"""SELECT doc_id, length(text)::INTEGER AS characters FROM documents
            WHERE length(trim(text, {text(space)})) >= 500""",
        "wrap_document": per_text(
            "none", lambda e: f"'<|startoftext|>' || {clean(e)} || '<|endoftext|>'"
        ),
        "document_at": f"""SELECT doc_id, '<|startoftext|>' || {clean('text')} || '<|endoftext|>'
            AS text FROM documents WHERE doc_id = 7""",
        "random_document": f"""SELECT doc_id,
                '<|startoftext|>' || {clean('text')} || '<|endoftext|>' AS text
            FROM documents ORDER BY md5(doc_id || '-{SEED}'), doc_id LIMIT 1""",
        "documents_with_control": f"""SELECT source, count(*) FILTER (
                contains({replaces('text', DECORATIONS['some_control'])}, '<|system|>') OR
                contains({replaces('text', DECORATIONS['some_control'])}, '<|endoftext|>')
            ) AS documents FROM documents GROUP BY source""",
        "gpt2_pieces": pieces("documents"),
        "gpt4_pieces": pieces("documents", cut4),
        "pieces_join_to_text": "SELECT doc_id, text AS gpt2, text AS gpt4 FROM documents",
        "vocabulary_table": f"""WITH {vocabulary(tables.VOCABULARY_SIZE)}
            SELECT piece, occurrences, id FROM vocab""",
        "vocabulary_of_clean_text": f"""WITH cleaned AS (SELECT doc_id, {clean('text')} AS text FROM documents),
            {vocabulary(VOCAB, 'cleaned')} SELECT piece, occurrences, id FROM vocab""",
        "union_tokens": token_lists("both_corpora", extra="""both_corpora AS (SELECT doc_id * 2 AS doc_id, text FROM documents
            UNION ALL SELECT page_id * 2 + 1, html FROM pages), """),
        "prepared_corpus": f"""WITH cleaned AS (
                SELECT doc_id, source, {clean('tight')} AS text FROM (SELECT doc_id, source, {wiki('text')} AS tight FROM documents)
                WHERE length(trim(tight, {text(space)})) >= 500),
            {stream('cleaned')}
            SELECT split, shard, doc_id, start, size, tokens FROM ({sharded('stored')})""",
        "encode_ranks": merged_tokens(WHOLE_RANKS),
        "encode_merged_ranks": merged_tokens(PREFIX_RANKS),
        "encode_bytes": token_lists(),
        "encode_clean_text": token_lists(
            "cleaned", extra=f"cleaned AS (SELECT doc_id, {clean('text')} AS text FROM documents), "
        ),
        "encode_unknown_token": token_lists(missing=f"[{FIRST_CONTROL}]"),
        "document_tokens": f"""WITH {STREAM} SELECT doc_id, split, size, tokens FROM stored""",
        "document_sizes": f"""WITH {tokens()},
            sized AS (SELECT doc_id, count(*)::INTEGER AS size FROM token GROUP BY doc_id)
            SELECT doc_id, source, coalesce(size, 0)::INTEGER AS size
            FROM documents LEFT JOIN sized USING (doc_id)""",
        "encode_decode_ranks": f"SELECT doc_id, {clean('text')} AS text FROM documents",
        "decode_bytes": "SELECT doc_id, text FROM documents",
        "token_words": f"""WITH {tokens()}
            SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos, j) - 1)::INTEGER
                AS pos, id, CASE WHEN id >= 256 THEN piece
                    WHEN id < 128 THEN chr(id) ELSE '�' END AS word FROM token""",
        "id_width": f"""WITH {STREAM}
            SELECT max(id)::INTEGER AS max_id,
                CASE WHEN max(id) < 65536 THEN 'uint16' ELSE 'uint32' END AS dtype FROM whole""",
        "exact_split": f"SELECT doc_id, split FROM ({split(1e-3)})",
        "hash_split": f"""SELECT doc_id, CASE WHEN
                ('0x' || substr(md5(doc_id || '-{SEED}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.2
                THEN 'val' ELSE 'train' END AS split FROM documents""",
        "offsets_and_shards": f"""WITH parted AS ({split(0.1)}),
            sized AS (SELECT doc_id, split, length(text)::INTEGER AS size FROM parted)
            SELECT doc_id, split, size,
                coalesce(sum(size) OVER (PARTITION BY split ORDER BY doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
                row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS row_index,
                shard FROM ({sharded('sized')})""",
        "split_sizes": f"""SELECT split, count(*) AS documents,
                sum(length(text))::BIGINT AS tokens, sum(length(text))::BIGINT AS characters
            FROM ({split(0.1)}) GROUP BY split""",
        "mix_report": f"""WITH sized AS (SELECT source, length(text) AS size FROM documents)
            {mix('sized')}""",
        "repeat_documents": f"""WITH factors AS (
                SELECT doc_id, source, CASE source WHEN 'src0' THEN 1.0 WHEN 'src1' THEN 0.5
                    WHEN 'src2' THEN 2.25 ELSE 4.0 END::DOUBLE AS f,
                    ('0x' || substr(md5(doc_id || '-{SEED}'), 1, 8))::BIGINT
                        / 4294967296.0::DOUBLE AS h FROM documents)
            SELECT doc_id, source, unnest(range(1, floor(f)::BIGINT + 1
                + CASE WHEN h < f - floor(f) THEN 1 ELSE 0 END))::INTEGER AS copy FROM factors""",
        "mixed_stream_entries": f"""WITH {by_source}, {mixed('indexed')}
            SELECT corpus, doc_id, copy, source_start, size, start FROM streamed""",
        "mixed_stream_shares": f"""WITH {by_source}, {mixed('indexed')}
            SELECT corpus, count(*) AS documents, sum(size)::BIGINT AS tokens,
                round(sum(size) / sum(sum(size)) OVER (), 6) AS share FROM streamed GROUP BY corpus""",
        "mixed_stream_tokens": f"""WITH {STREAM}, kept AS (SELECT * FROM stored WHERE split = 'train'),
            indexed AS (
                SELECT corpus, f, doc_id, start, size FROM kept, (VALUES ('twice', 2.0), ('half', 0.5)) AS c(corpus, f)),
            {mixed('indexed')}
            SELECT corpus, s.doc_id, copy, s.size, s.start, tokens FROM streamed AS s JOIN kept USING (doc_id)""",
        "next_token_examples": f"""WITH {STREAM}, {XS}
            SELECT split, block, array_to_string(x, ' ') AS x, array_to_string(y, ' ') AS y FROM xy""",
        "padded_examples": f"""WITH {STREAM}, {XS}
            SELECT split, block, {padded('x')} AS x, {padded('y')} AS y,
                len(list_filter(y, lambda t: t <> {PADDING}))::INTEGER AS counted FROM xy""",
        "shuffled_batches": f"""WITH {STREAM}, {XS},
            ordered AS (
                SELECT split, e.epoch, block, x, row_number() OVER (PARTITION BY split, e.epoch
                    ORDER BY md5(split || '-' || block || '-' || e.epoch || '-{SEED}'), block) - 1 AS rn
                FROM xy, (VALUES (0), (1)) AS e(epoch))
            SELECT split, epoch, (rn // 128)::BIGINT AS batch, (rn % 128)::INTEGER AS slot, block,
                array_to_string(x, ' ') AS x FROM ordered""",
        "render_conversations": f"""SELECT conv_id, 0::INTEGER AS part, {rendered(CONTROL)} AS text
            FROM conversations GROUP BY conv_id""",
        "render_conversations_in_parts": f"""WITH ends AS (
                SELECT conv_id, min(turn // 3) AS lo, max(turn // 3) AS hi
                FROM conversations GROUP BY conv_id),
            parts AS (
                SELECT conv_id, turn // 3 AS p,
                    string_agg({roles(custom)} || text, '' ORDER BY turn) AS text
                FROM conversations GROUP BY conv_id, turn // 3)
            SELECT conv_id, (p - lo)::INTEGER AS part,
                CASE WHEN p = lo THEN {text(custom['start_of_text'])} ELSE '' END || text
                || CASE WHEN p = hi THEN {text(custom['end_of_text'])} ELSE '' END AS text
            FROM parts JOIN ends USING (conv_id)""",
        "metric_records": f"""WITH {RECORDS}
            SELECT run, epoch_us(ts) / 1000000.0::DOUBLE AS time, iter, tokens, epochs, 1 / (1 + abs(loss)) AS accuracy,
                loss, 1 / (1 + abs(val_loss)) AS val_accuracy, val_loss,
                min(val_loss) OVER (PARTITION BY run ORDER BY iter) AS best_val_loss FROM records""",
        "metric_records_with_gaps": f"""WITH {RECORDS}, lost AS (
                SELECT CASE WHEN iter % 7 <> 3 THEN run END AS run, CASE WHEN iter % 11 <> 5 THEN iter END AS iter
                FROM records)
            SELECT run, count(*) AS saves, count(iter) AS numbered FROM lost GROUP BY run""",
        "metric_elapsed": f"""WITH {RECORDS}
            SELECT run, iter, (epoch_us(ts) - epoch_us(lag(ts) OVER
                (PARTITION BY run ORDER BY iter))) / 1000000.0::DOUBLE AS elapsed FROM records""",
        "metric_running_best": f"""WITH {RECORDS}
            SELECT run, iter, min(val_loss) OVER (PARTITION BY run ORDER BY iter
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_val_loss FROM records""",
        "metric_resume": f"""WITH {RECORDS}
            SELECT run, max(iter) AS iter, max_by(tokens, iter) AS tokens,
                max_by(epochs, iter) AS epochs, max_by(loss, iter) AS loss,
                max_by(val_loss, iter) AS val_loss, min(val_loss) AS best_val_loss
            FROM records GROUP BY run""",
        "metric_epoch_losses": f"""WITH {RECORDS}
            SELECT run, epochs, round(avg(loss), 6) AS epoch_loss, count(*) AS batches
            FROM records GROUP BY run, epochs""",
        "metric_validation_rows": f"""WITH {RECORDS}
            SELECT run, iter, val_loss FROM records WHERE iter % 50 = 0""",
        "pieces_per_source": f"""WITH cleaned AS (
                SELECT source, {clean('text')} AS text FROM documents
                WHERE length(trim(text, {text(space)})) >= 100),
            sized AS (SELECT source, len({cut2('text')}) AS size FROM cleaned)
            {mix('sized')}""",
    }
