"""The catalog's queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from pairloom.plans import catalog as c

END = c.END_OF_TEXT
FIRST_MERGE = 256 + len(c.SPECIALS)


def _with(*ctes: tuple[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# RE2 has no look-ahead: a mark before the last blank of a run stands in for it.
def _pretokens(text: str) -> str:
    marked = rf"regexp_replace({text}, '(\s)(\s\S)', concat('\1', chr(1), '\2'), 'g')"
    pattern = r"'''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+'"
    return f"regexp_extract_all({marked}, {pattern})"


def _lines(text: str) -> str:
    return rf"regexp_extract_all({text}, '[^\n]*\n|[^\n]+')"


def _symbols(seq: str) -> str:
    return f"regexp_extract_all({seq}, '<([0-9A-F]+)>', 1)"


def _bytes(text: str) -> str:
    return rf"regexp_replace(hex(encode({text})), '(..)', '<\1>', 'g')"


def _pairs(relation: str, keep: str = "cnt") -> str:
    """Rows (l, r, keep) of all adjacent symbols of relation.seq."""
    return (
        f"SELECT struct_extract(u, 1) AS l, struct_extract(u, 2) AS r, {keep} FROM ("
        f"SELECT unnest(list_zip(a[1:len(a)-1], a[2:])) AS u, {keep} FROM ("
        f"SELECT {_symbols('seq')} AS a, {keep} FROM {relation}) WHERE len(a) > 1)"
    )


TURNS = (
    "turns",
    f"SELECT conv_id, turn, concat(role, '{END}', text, '{END}') AS text FROM conversations",
)
TURN_SEGMENTS = (
    "turn_segments",
    f"""SELECT conv_id, turn, 2 * i AS place, parts[i + 1] AS segment, false AS is_special
        FROM (SELECT *, unnest(range(len(parts))) AS i
              FROM (SELECT conv_id, turn, string_split(text, '{END}') AS parts FROM turns))
        WHERE parts[i + 1] <> ''
        UNION ALL
        SELECT conv_id, turn, 2 * i + 1, '{END}', true
        FROM (SELECT conv_id, turn, unnest(range(len(string_split(text, '{END}')) - 1)) AS i FROM turns)""",
)
WORDS = (
    "words",
    f"""SELECT pretoken, count(*) AS cnt
        FROM (SELECT unnest({_pretokens('text')}) AS pretoken FROM documents) GROUP BY 1""",
)


def _merge_chain(start: str, prefix: str) -> list[tuple[str, str]]:
    """Apply the merges b0.. to relation ``start (key, seq)``, one CTE per merge."""
    steps = []
    for k in range(c.MERGES):
        source = start if k == 0 else f"{prefix}{k - 1}"
        steps.append(
            (
                f"{prefix}{k}",
                f"""SELECT * REPLACE (replace(seq, (SELECT '<' || l || '><' || r || '>' FROM b{k}),
                                             (SELECT '<' || l || r || '>' FROM b{k})) AS seq) FROM {source}""",
            )
        )
    return steps


def _training() -> list[tuple[str, str]]:
    ctes = [WORDS, ("w", f"SELECT pretoken, cnt, {_bytes('pretoken')} AS seq FROM words")]
    merged = _merge_chain("w", "w")
    for k in range(c.MERGES):
        source = "w" if k == 0 else f"w{k - 1}"
        best = (
            f"b{k}",
            f"""SELECT l, r, sum(cnt)::BIGINT AS cnt FROM ({_pairs(source)})
                GROUP BY l, r ORDER BY cnt DESC, l DESC, r DESC LIMIT 1""",
        )
        ctes += [best, merged[k]]
    union = " UNION ALL ".join(f"SELECT {k} AS rank, l, r, cnt FROM b{k}" for k in range(c.MERGES))
    ctes.append(("merges", union))
    ctes.append(
        (
            "vocab",
            f"""SELECT i::INTEGER AS token_id, format('{{:02X}}', i) AS token, 'byte' AS kind
                FROM (SELECT unnest(range(256)) AS i)
                UNION ALL SELECT 256, hex(encode('{END}')), 'special'
                UNION ALL SELECT {FIRST_MERGE} + rank, l || r, 'merge' FROM merges""",
        )
    )
    return ctes


def _piece_ids() -> list[tuple[str, str]]:
    """Ids of the distinct pieces of relation ``pieces``: (piece, ids LIST)."""
    return [
        ("x", f"SELECT piece, {_bytes('piece')} AS seq FROM (SELECT DISTINCT piece FROM pieces WHERE piece <> '{END}')"),
        *_merge_chain("x", "x"),
        (
            "piece_ids",
            f"""SELECT piece, list(token_id ORDER BY i) AS ids FROM (
                  SELECT piece, i, symbols[i + 1] AS token FROM (
                    SELECT piece, symbols, unnest(range(len(symbols))) AS i FROM (
                      SELECT piece, {_symbols('seq')} AS symbols FROM x{c.MERGES - 1})))
                JOIN vocab USING (token) GROUP BY piece
                UNION ALL SELECT '{END}', [256]""",
        ),
    ]


def _pieces(source: str, keys: str, cut: str) -> tuple[str, str]:
    """Relation ``pieces (keys, pos, piece)``."""
    return (
        "pieces",
        f"""SELECT {keys}, i AS pos, p[i + 1] AS piece
            FROM (SELECT *, unnest(range(len(p))) AS i FROM (SELECT {keys}, {cut} AS p FROM {source}))""",
    )


def _encoded(keys: str) -> str:
    return f"""SELECT {keys}, array_to_string(flatten(list(ids ORDER BY pos)), ' ') AS ids
               FROM pieces JOIN piece_ids USING (piece) GROUP BY {keys}"""


def _tokens(source: str, key: str, suffix: str = "") -> list[tuple[str, str]]:
    """Relation ``tokens{suffix} (key, p, token_id)`` with global positions ``p``."""
    return [
        _pieces(source, key, _pretokens("text")),
        *_piece_ids(),
        (
            f"tokens{suffix}",
            f"""SELECT {key}, row_number() OVER (ORDER BY {key}, pos, i) - 1 AS p, ids[i + 1] AS token_id
                FROM (SELECT {key}, pos, ids, unnest(range(len(ids))) AS i
                      FROM pieces JOIN piece_ids USING (piece))""",
        ),
    ]


def _renamed(ctes: list[tuple[str, str]], suffix: str) -> list[tuple[str, str]]:
    """A second token relation in the same statement, under other CTE names."""
    names = {"pieces", "piece_ids", "x", *(f"x{k}" for k in range(c.MERGES))}
    out = []
    for name, sql in ctes:
        for old in ("pieces", "piece_ids"):
            sql = sql.replace(f"FROM {old} ", f"FROM {old}{suffix} ").replace(f"JOIN {old} ", f"JOIN {old}{suffix} ")
        for old in ("x", *(f"x{k}" for k in range(c.MERGES))):
            sql = sql.replace(f"FROM {old})", f"FROM {old}{suffix})")
            if sql.endswith(f"FROM {old}"):
                sql += suffix
        out.append((name + suffix if name in names else name, sql))
    return out


def _hashed(*keys: str) -> str:
    text = " || ':' || ".join([f"'{c.SEED}'", *keys])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _windows(starts: str, key: str) -> list[tuple[str, str]]:
    return [
        ("starts", starts),
        (
            "spans",
            f"""SELECT {key}, start_pos, CASE WHEN count(*) = {c.CONTEXT + 1} THEN list(token_id ORDER BY p) END AS ids
                FROM (SELECT {key}, start_pos, unnest(range(start_pos, start_pos + {c.CONTEXT + 1})) AS p FROM starts)
                JOIN tokens USING (p) GROUP BY {key}, start_pos""",
        ),
    ]


def _show_windows(key: str) -> str:
    return f"""SELECT {key}, start_pos, array_to_string(ids[1:{c.CONTEXT}], ' ') AS x,
                      array_to_string(ids[2:{c.CONTEXT + 1}], ' ') AS y FROM spans"""


SAMPLED = f"""SELECT i AS sample_id, {_hashed('i')} % ((SELECT count(*) FROM tokens) - {c.CONTEXT}) AS start_pos
              FROM (SELECT unnest(range({c.SAMPLES})) AS i)"""

LOGITS = (
    "logits",
    f"""SELECT vec_id AS row_id, i::INTEGER AS class_id, label AS target, embedding[i + 1]::DOUBLE * {c.SHARPNESS} AS logit
        FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)""",
)
SHARP = ("sharp", f"SELECT row_id, class_id, target, logit / ({c.TEMPERATURE} + 1e-8) AS logit FROM logits")


def _softmax(source: str) -> tuple[str, str]:
    return (
        "probs",
        f"""SELECT row_id, class_id, logit, exp(logit - m) / sum(exp(logit - m)) OVER (PARTITION BY row_id) AS prob
            FROM (SELECT *, max(logit) OVER (PARTITION BY row_id) AS m FROM {source})""",
    )


LOSSES = (
    "losses",
    """SELECT row_id, m + ln(sum(exp(logit - m))) - max(CASE WHEN class_id = target THEN logit END) AS loss
       FROM (SELECT *, max(logit) OVER (PARTITION BY row_id) AS m FROM logits) GROUP BY row_id, m""",
)
NUCLEUS = (
    "nucleus",
    f"""SELECT *, sum(prob) OVER (PARTITION BY row_id) AS mass FROM (
          SELECT row_id, class_id, prob, coalesce(sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, class_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM probs)
        WHERE before <= {c.TOP_P}""",
)

STEPS = (
    "steps",
    """SELECT context, next, count(*) AS cnt FROM (
         SELECT token_id AS context, lead(token_id) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM tokens)
       WHERE next IS NOT NULL GROUP BY 1, 2""",
)


def _step_loss(asked: str) -> str:
    return f"""SELECT sum(n)::BIGINT AS n_tokens,
                      round(sum(n * -ln((coalesce(cnt, 0) + 1.0) / (coalesce(total, 0) + {c.VOCAB_SIZE}.0))) / sum(n), 6) AS loss
               FROM ({asked}) a
               LEFT JOIN steps USING (context, next)
               LEFT JOIN (SELECT context, sum(cnt) AS total FROM steps GROUP BY 1) USING (context)"""


#: Every token after every token, with its count or 0.
ALL_STEPS = f"""(SELECT context, next, coalesce(cnt, 0) AS cnt FROM (
    SELECT a.i AS context, b.i AS next FROM range({c.VOCAB_SIZE}) a(i), range({c.VOCAB_SIZE}) b(i)) LEFT JOIN steps USING (context, next))"""


def _generation(steps: str = "steps") -> list[tuple[str, str]]:
    """Continuations of the benchmark items, one CTE per new token."""
    ctes = [
        (
            "chances",
            f"""SELECT context, next, x / sum(x) OVER (PARTITION BY context) AS prob FROM (
                  SELECT context, next, exp(logit - max(logit) OVER (PARTITION BY context)) AS x FROM (
                    SELECT context, next, ln(cnt + 1.0) / ({c.TEMPERATURE} + 1e-8) AS logit FROM {steps}))""",
        ),
        (
            "kept",
            f"""SELECT *, sum(prob) OVER (PARTITION BY context) AS mass FROM (
                  SELECT context, next, prob, coalesce(sum(prob) OVER (PARTITION BY context ORDER BY prob DESC, next
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM chances)
                WHERE before <= {c.TOP_P}""",
        ),
        (
            "g0",
            """SELECT item_id AS prompt_id, list(token_id ORDER BY p) AS ids, 0 AS n_new, true AS live
               FROM tokens_valid GROUP BY 1""",
        ),
    ]
    for k in range(c.NEW_TOKENS):
        draw = f"({_hashed('prompt_id', repr(str(k)))} % {1 << 52}) / {float(1 << 52)!r}"
        ctes.append(
            (
                f"g{k + 1}",
                f"""SELECT prompt_id, CASE WHEN go THEN list_append(ids, next) ELSE ids END AS ids,
                           n_new + go::INTEGER AS n_new, go AS live FROM (
                      SELECT g.*, d.next, coalesce(live AND d.next <> 256, false) AS go FROM g{k} g LEFT JOIN (
                        SELECT prompt_id, arg_min(next, before) AS next FROM g{k} JOIN kept ON context = ids[-1]
                        WHERE before + prob > {draw} * mass GROUP BY prompt_id) d USING (prompt_id))""",
            )
        )
    return ctes


def _reread() -> str:
    return "SELECT md5(text) AS text_md5, count(*) AS copies, max(length(text))::INTEGER AS n_chars FROM documents GROUP BY 1"


def build() -> dict[str, str]:
    """SQL per query name."""
    train = _training()
    documents = [*train, _pieces("documents", "doc_id", _pretokens("text")), *_piece_ids()]
    doc_tokens = [*train, *_tokens("documents", "doc_id")]
    merges = _with(*train, final="SELECT rank, l, r FROM merges")
    line_cut = f"flatten(list_transform({_lines('text')}, lambda t: {_pretokens('t')}))"
    split_pieces = (
        "pieces",
        f"""SELECT conv_id, turn, place * 1000000 + i AS pos, p[i + 1] AS piece FROM (
              SELECT *, unnest(range(len(p))) AS i FROM (
                SELECT conv_id, turn, place,
                       CASE WHEN is_special THEN [segment] ELSE {_pretokens('segment')} END AS p
                FROM turn_segments))""",
    )
    lines = (
        "lines",
        f"""SELECT doc_id, i AS line_no, l[i + 1] AS text FROM (
              SELECT *, unnest(range(len(l))) AS i FROM (SELECT doc_id, {_lines('text')} AS l FROM documents))""",
    )
    changes = (
        "changes",
        f"""SELECT l, r, cnt FROM ({_pairs('w0')}) UNION ALL SELECT l, r, -cnt FROM ({_pairs('w')})""",
    )
    sql = {
        "read_corpus": _reread(),
        "read_corpus_gz": _reread(),
        "decode_text": "SELECT doc_id, md5(text || chr(65533)) AS replaced, md5(text) AS ignored, md5(text) AS strict FROM documents",
        "vocab_file": _with(*train, final="SELECT token_id, token FROM vocab"),
        "merges_file": merges,
        "resume_training": merges,
        "token_stream_file": _with(
            *doc_tokens,
            final=f"""SELECT p // {c.BLOCK} AS block_id, (p // {c.BLOCK}) * {c.BLOCK} AS start_pos, count(*)::INTEGER AS n_ids,
                             md5(string_agg(token_id::VARCHAR, ' ' ORDER BY p)) AS ids_md5 FROM tokens GROUP BY 1, 2""",
        ),
        "split_special": _with(
            TURNS,
            TURN_SEGMENTS,
            final="""SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id, turn ORDER BY place) - 1)::INTEGER AS seg_pos,
                            segment, is_special FROM turn_segments""",
        ),
        "pretokenize": _with(
            _pieces("documents", "doc_id", _pretokens("text")),
            final="SELECT doc_id, pos::INTEGER AS pos, piece AS pretoken FROM pieces",
        ),
        "pretokenize_special": _with(
            TURNS,
            TURN_SEGMENTS,
            split_pieces,
            final=f"""SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos) - 1)::INTEGER AS pos,
                             piece AS pretoken FROM pieces WHERE piece <> '{END}'""",
        ),
        "count_pretokens": _with(WORDS, final="SELECT pretoken, cnt FROM words"),
        "merge_pretoken_counts": _with(
            TURNS,
            TURN_SEGMENTS,
            final=f"""SELECT pretoken, count(*) AS cnt FROM (
                        SELECT unnest({_pretokens('text')}) AS pretoken FROM documents
                        UNION ALL SELECT unnest({_pretokens('text')}) FROM benchmark
                        UNION ALL SELECT unnest({_pretokens('segment')}) FROM turn_segments WHERE NOT is_special)
                      GROUP BY 1""",
        ),
        "to_byte_symbols": _with(
            WORDS,
            final=f"SELECT pretoken, {_bytes('pretoken')} AS symbols, strlen(pretoken)::INTEGER AS n_symbols FROM words",
        ),
        "corpus_stats": _with(
            train[0],
            train[1],
            final=f"""SELECT count(*) AS distinct_pretokens, sum(cnt)::BIGINT AS pretokens,
                             sum(cnt * strlen(pretoken))::BIGINT AS bytes,
                             (SELECT count(*) FROM (SELECT DISTINCT l, r FROM ({_pairs('w')}))) AS distinct_pairs FROM w""",
        ),
        "base_vocab": _with(
            *train[:2],
            final=f"""SELECT token_id, token, kind, coalesce(occurrences, 0)::BIGINT AS occurrences
                      FROM (SELECT i::INTEGER AS token_id, format('{{:02X}}', i) AS token, 'byte' AS kind
                            FROM (SELECT unnest(range(256)) AS i)
                            UNION ALL SELECT 256, hex(encode('{END}')), 'special')
                      LEFT JOIN (SELECT token, sum(cnt) AS occurrences
                                 FROM (SELECT unnest({_symbols('seq')}) AS token, cnt FROM w) GROUP BY 1) USING (token)""",
        ),
        "trained_vocab": _with(*train, final="SELECT token_id, token, kind FROM vocab"),
        "count_pairs": _with(
            *train[:2], final=f"SELECT l, r, sum(cnt)::BIGINT AS cnt FROM ({_pairs('w')}) GROUP BY l, r"
        ),
        "pair_index": _with(*train[:2], final=f"SELECT DISTINCT l, r, pretoken FROM ({_pairs('w', 'pretoken')})"),
        "top_pairs": _with(
            *train[:2],
            final=f"""SELECT l, r, sum(cnt)::BIGINT AS cnt FROM ({_pairs('w')}) GROUP BY l, r
                      ORDER BY cnt DESC, l DESC, r DESC LIMIT {c.TOP_PAIRS}""",
        ),
        "apply_merge": _with(
            *train, final=f"SELECT pretoken, seq AS symbols, cnt FROM w{c.MERGES // 2 - 1}"
        ),
        "pair_count_delta": _with(
            *train[:4],
            changes,
            final="SELECT l, r, sum(cnt)::BIGINT AS delta FROM changes GROUP BY l, r HAVING sum(cnt) <> 0",
        ),
        "train_bpe": _with(*train, final="SELECT rank, l, r, cnt FROM merges"),
        "segmented_words": _with(*train, final=f"SELECT pretoken, seq AS symbols, cnt FROM w{c.MERGES - 1}"),
        "verify_tokenizer": _with(
            *train,
            final="""SELECT 'vocab' AS part, count(*) AS size, 0::BIGINT AS differences FROM vocab
                     UNION ALL SELECT 'merges', count(*), 0::BIGINT FROM merges""",
        ),
        "with_special_tokens": _with(
            *train,
            final="""SELECT token_id, token FROM vocab
                     UNION ALL SELECT (SELECT count(*) FROM vocab)::INTEGER, hex(encode('<|turn|>'))
                     UNION ALL SELECT (SELECT count(*) FROM vocab)::INTEGER + 1, hex(encode('<|pad|>'))""",
        ),
        "vocab_lookup": _with(*train, final="SELECT token, max(token_id) AS token_id FROM vocab GROUP BY token"),
        "encode_pretokens": _with(
            *train,
            ("pieces", "SELECT pretoken AS piece FROM words"),
            *_piece_ids(),
            final=f"SELECT piece AS pretoken, array_to_string(ids, ' ') AS ids FROM piece_ids WHERE piece <> '{END}'",
        ),
        "encode_documents": _with(*documents, final=_encoded("doc_id")),
        "encode_stream": _with(*documents, final=_encoded("doc_id")),
        "encode_special": _with(
            *train, TURNS, TURN_SEGMENTS, split_pieces, *_piece_ids(), final=_encoded("conv_id, turn")
        ),
        "encode_lines": _with(
            *train,
            lines,
            _pieces("lines", "doc_id, line_no", _pretokens("text")),
            *_piece_ids(),
            final=_encoded("doc_id, line_no").replace("SELECT doc_id, line_no", "SELECT doc_id, line_no::INTEGER AS line_no"),
        ),
        "encode_line_files": _with(
            *train,
            ("lines", lines[1].replace(_lines("text"), _lines("text || chr(10)"))),
            _pieces("lines", "doc_id, line_no", _pretokens("text")),
            *_piece_ids(),
            final=f"SELECT ids, count(*) AS lines FROM ({_encoded('doc_id, line_no')}) GROUP BY ids",
        ),
        "encode_by_line": _with(
            *train, _pieces("documents", "doc_id", line_cut), *_piece_ids(), final=_encoded("doc_id")
        ),
        "count_tokens": _with(
            *documents,
            final="""SELECT lang, sum(len(ids))::BIGINT AS n_tokens
                     FROM pieces JOIN piece_ids USING (piece) JOIN documents USING (doc_id) GROUP BY lang""",
        ),
        "document_positions": _with(
            *doc_tokens, final="SELECT doc_id, count(*) AS n_ids, min(p) AS start_pos FROM tokens GROUP BY doc_id"
        ),
        "decode_documents": "SELECT doc_id, length(text)::INTEGER AS n_chars, md5(text) AS text_md5 FROM documents",
        "roundtrip_audit": " UNION ALL ".join(
            f"SELECT '{name}' AS source, count(*) AS texts, 0::BIGINT AS bad FROM {name}"
            for name in ("documents", "conversations", "benchmark", "pages")
        ),
        "windows_at": _with(
            *doc_tokens,
            *_windows("SELECT doc_id, min(p) AS start_pos FROM tokens GROUP BY doc_id", "doc_id"),
            final=_show_windows("doc_id"),
        ).replace("JOIN tokens USING (p)", "JOIN (SELECT p, token_id FROM tokens) USING (p)"),
        "sample_windows": _with(*doc_tokens, *_windows(SAMPLED, "sample_id"), final=_show_windows("sample_id")),
        "load_split": _with(
            *doc_tokens,
            *_renamed(_tokens("benchmark", "item_id", "_valid"), "_valid"),
            final=" UNION ALL ".join(
                f"SELECT '{split}' AS split, count(DISTINCT p // {c.BLOCK}) AS n_blocks, count(*) AS n_ids, sum(token_id * (p % 1009 + 1))::BIGINT AS content FROM {tokens}"
                for split, tokens in (("train", "tokens"), ("valid", "tokens_valid"))
            ),
        ),
        "softmax": _with(LOGITS, _softmax("logits"), final="SELECT row_id, class_id, round(prob, 6) AS prob FROM probs"),
        "cross_entropy": _with(LOGITS, LOSSES, final="SELECT row_id, round(loss, 6) AS loss FROM losses"),
        "cross_entropy_mean": _with(LOGITS, LOSSES, final="SELECT round(avg(loss), 6) AS loss FROM losses"),
        "apply_temperature": _with(
            LOGITS,
            SHARP,
            _softmax("sharp"),
            final="SELECT row_id, class_id, round(logit, 6) AS logit, round(prob, 6) AS prob FROM probs",
        ),
        "top_p_filter": _with(
            LOGITS,
            SHARP,
            _softmax("sharp"),
            NUCLEUS,
            final="SELECT row_id, class_id, round(prob / mass, 6) AS prob FROM nucleus",
        ),
        "top_p_sample": _with(
            LOGITS,
            SHARP,
            _softmax("sharp"),
            NUCLEUS,
            final=f"""SELECT row_id, arg_min(class_id, before) AS class_id FROM nucleus
                      WHERE before + prob > ({_hashed('row_id')} % {1 << 52}) / {float(1 << 52)!r} * mass GROUP BY row_id""",
        ),
        "embedding_lookup": _with(
            *documents,
            final="""SELECT doc_id, count(*) AS n_tokens, sum(pos)::BIGINT AS pos_sum,
                            round(sum(list_sum(list_transform(embedding, lambda e, i: e::DOUBLE * i))), 3) AS entries
                     FROM (SELECT doc_id, ids[i + 1] AS token_id, i AS pos FROM (
                             SELECT doc_id, ids, unnest(range(len(ids))) AS i FROM (
                               SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids
                               FROM pieces JOIN piece_ids USING (piece) GROUP BY doc_id)))
                     JOIN embeddings ON vec_id = token_id GROUP BY doc_id""",
        ),
        "rms_normalize": """
            SELECT vec_id, i::INTEGER AS place, round(embedding[i + 1]::DOUBLE / sqrt(q + 1e-5), 6) AS entry
            FROM (SELECT *, unnest(range(len(embedding))) AS i FROM (
                    SELECT vec_id, embedding,
                           list_sum(list_transform(embedding, lambda e: e::DOUBLE * e::DOUBLE)) / len(embedding) AS q
                    FROM embeddings))""",
        "next_token_table": _with(
            *doc_tokens, STEPS, final="SELECT context, next, cnt, round(ln(cnt + 1.0), 6) AS logit FROM steps"
        ),
        "validate_held_out": _with(
            *doc_tokens,
            STEPS,
            *_renamed(_tokens("benchmark", "item_id", "_valid"), "_valid"),
            final=_step_loss(
                """SELECT context, next, count(*) AS n FROM (
                     SELECT token_id AS context, lead(token_id) OVER (PARTITION BY item_id ORDER BY p) AS next
                     FROM tokens_valid) WHERE next IS NOT NULL GROUP BY 1, 2"""
            ),
        ),
        "validate_sampled": _with(
            *doc_tokens,
            STEPS,
            *_renamed(_tokens("benchmark", "item_id", "_valid"), "_valid"),
            *[
                (name, s.replace("tokens", "tokens_valid"))
                for name, s in _windows(SAMPLED, "sample_id")
            ],
            final=_step_loss(
                f"""SELECT context, next, count(*) AS n FROM (
                      SELECT ids[i] AS context, ids[i + 1] AS next FROM (
                        SELECT ids, unnest(range(1, {c.CONTEXT + 1})) AS i FROM spans)) GROUP BY 1, 2"""
            ),
        ),
    }
    sql["softmax_array"] = sql["softmax"]
    sql["top_p_array"] = sql["top_p_filter"]
    sql["top_p_sample_array"] = sql["top_p_sample"]
    ended = [
        ("ended", "SELECT doc_id, pos, piece FROM pieces UNION ALL SELECT doc_id, 1000000000, '" + END + "' FROM documents"),
    ]
    sql["encode_with_end"] = _with(*documents, *ended, final=_encoded("doc_id").replace("FROM pieces", "FROM ended"))
    sql["flatten_with_end"] = _with(
        *documents,
        *ended,
        (
            "stream",
            """SELECT row_number() OVER (ORDER BY doc_id, pos, i) - 1 AS p, ids[i + 1] AS token_id
               FROM (SELECT doc_id, pos, ids, unnest(range(len(ids))) AS i FROM ended JOIN piece_ids USING (piece))""",
        ),
        final=f"""SELECT p // {c.BLOCK} AS block_id, (p // {c.BLOCK}) * {c.BLOCK} AS start_pos, count(*)::INTEGER AS n_ids,
                         array_to_string(list(token_id ORDER BY p), ' ') AS ids FROM stream GROUP BY p // {c.BLOCK}""",
    )
    sql["score_documents"] = _with(
        *doc_tokens,
        STEPS,
        (
            "asked",
            """SELECT doc_id, context, next, count(*) AS n FROM (
                 SELECT doc_id, token_id AS context, lead(token_id) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM tokens)
               WHERE next IS NOT NULL GROUP BY 1, 2, 3""",
        ),
        (
            "scored",
            f"""SELECT doc_id, sum(n)::BIGINT AS n,
                       sum(n * -ln((coalesce(cnt, 0) + 1.0) / (coalesce(total, 0) + {c.VOCAB_SIZE}.0))) / sum(n) AS loss
                FROM asked LEFT JOIN steps USING (context, next)
                LEFT JOIN (SELECT context, sum(cnt) AS total FROM steps GROUP BY 1) USING (context) GROUP BY doc_id""",
        ),
        final="""SELECT doc_id, coalesce(n, 0) AS n_tokens, round(loss, 6) AS loss, round(exp(loss), 4) AS perplexity
                 FROM documents LEFT JOIN scored USING (doc_id)""",
    )
    sql["flatten_token_stream"] = sql["token_stream_file"]
    for name, steps in (("generate_batch", "steps"), ("generate_smoothed", ALL_STEPS)):
        sql[name] = _with(
            *doc_tokens,
            STEPS,
            *_renamed(_tokens("benchmark", "item_id", "_valid"), "_valid"),
            *_generation(steps),
            final=f"SELECT prompt_id, n_new, array_to_string(ids, ' ') AS ids FROM g{c.NEW_TOKENS}",
        )
    return sql
