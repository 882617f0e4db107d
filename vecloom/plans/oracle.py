"""The same answers in DuckDB SQL, for every registered query that SQL can state.

Written from the operators' definitions, not from their plans: where Spark counts, blocks or prefix-sums,
the SQL joins, sorts and numbers in the plain way.
"""

from __future__ import annotations

from vecloom.params import Params
from vecloom.plans.queries import PARTS, PROBED, STEPS, WEIGHT_POWER, WIDE

_P = Params()
_FULL = _P.vocab_size

_SPLIT = r"regexp_split_to_array(text, '\r\n|\n|\r')"
_PIECE = r"' ?\p{L}+| ?\p{N}{1,3}| ?[^\s\p{L}\p{N}]+'"

_LINES = f"""
  parts AS (SELECT doc_id, {_SPLIT} AS p FROM documents),
  closed AS (SELECT doc_id, CASE WHEN p[-1] = '' THEN p[1:len(p)-1] ELSE p END AS p FROM parts),
  lines AS (SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS BIGINT) AS pos, unnest(p) AS line FROM closed)"""

_NUMBERED = _LINES + """,
  numbered AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS line_no, line FROM lines)"""

_WORDS = f"""
  pieces AS (SELECT lang, unnest(regexp_extract_all(text, {_PIECE})) AS piece FROM documents),
  counted AS (SELECT piece, count(*) AS n FROM pieces GROUP BY piece),
  words AS (SELECT row_number() OVER (ORDER BY n DESC, piece) - 1 AS token, piece AS text, n FROM counted)"""


def _draw(limit: int | str, *parts: str) -> str:
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {limit}"


def _draw_wide(limit: int | str, *parts: str) -> str:
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT) % {limit}"


def _spans(sequences: str = "sequences") -> str:
    """``spans (token, start, "end")``: the tokens' stretches of the summed weights, in the order of the tokens."""
    assert WEIGHT_POWER == 0.75
    return f"""
  used_counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM {sequences}) GROUP BY token),
  weights AS (SELECT token, greatest(CAST(floor(sqrt(CAST(n AS DOUBLE)) * sqrt(sqrt(CAST(n AS DOUBLE))) * 1024) AS BIGINT), 1) AS w FROM used_counts),
  spans AS (SELECT token, CAST(sum(w) OVER (ORDER BY token) - w AS BIGINT) AS start, CAST(sum(w) OVER (ORDER BY token) AS BIGINT) AS "end" FROM weights),
  weight AS (SELECT max("end") AS total FROM spans)"""


def _piece_ids(column: str, vocab_size: int | str) -> str:
    hashed = f"CAST('0x' || substr(md5(q), 1, 8) AS BIGINT) % {vocab_size}"
    return f"list_transform(regexp_extract_all({column}, {_PIECE}), lambda q: CAST({hashed} AS INTEGER))"


def _ids_text(column: str) -> str:
    return f"coalesce(array_to_string({column}, ' '), '')"


def _windows(source: str, keys: str, size: int = _P.window_size, step: int = _P.stride) -> str:
    """``windows (keys, win_no, window)`` over lists ``tokens`` of ``source``."""
    last = f"CAST(ceil(greatest(len(tokens) - {max(size, step)}, 0) / {step}) AS BIGINT)"
    return f"""
  numbers AS (SELECT {keys}, tokens, unnest(range(0, {last} + 1)) AS win_no FROM {source} WHERE len(tokens) > 0),
  windows AS (SELECT {keys}, win_no, tokens[win_no * {step} + 1 : win_no * {step} + {size}] AS "window" FROM numbers)"""


def _sequences(vocab_size: int) -> str:
    return f"sequences AS (SELECT doc_id, {_piece_ids('text', vocab_size)} AS tokens FROM documents)"


#: Pieces folded into as many ids as the table ``embeddings`` has rows.
_FOLDED = f"""size AS (SELECT count(*) AS nv FROM embeddings),
  sequences AS (SELECT doc_id, {_piece_ids('text', 'nv')} AS tokens FROM documents, size)"""


def _pairs(sequences: str) -> str:
    return sequences + "," + _windows("sequences", "doc_id") + """,
  places AS (SELECT doc_id, win_no, "window", unnest(range(0, len("window") - 1)) AS pair_no FROM windows WHERE len("window") > 1),
  pairs AS (SELECT doc_id, win_no, pair_no, "window"[pair_no + 1] AS c, "window"[pair_no + 2] AS o FROM places)"""


def _triples(sequences: str, vocab_size: int | str) -> str:
    negative = _draw(vocab_size, str(_P.seed), "doc_id", "win_no", "pair_no")
    return _pairs(sequences) + f""",
  triples AS (SELECT *, CAST({negative} AS INTEGER) AS n FROM pairs)"""


def _start(source: str) -> str:
    unit = "CAST('0x' || substr(md5('%d:' || token || ':' || j), 1, 8) AS BIGINT) / 4294967296.0" % _P.seed
    return f"""
  start AS (SELECT token, list_transform(range(0, {_P.embedding_dim}),
      lambda j: CAST({unit} AS DOUBLE)) AS v FROM {source})"""


_SCORED = """,
  used AS (SELECT c AS token FROM triples UNION SELECT o FROM triples UNION SELECT n FROM triples),""" + _start("used") + """,
  scored AS (
    SELECT t.c, t.o, t.n, a.v AS vc, b.v AS vo, d.v AS vn,
           list_inner_product(a.v, b.v) AS near, list_inner_product(a.v, d.v) AS far
    FROM triples t JOIN start a ON t.c = a.token JOIN start b ON t.o = b.token JOIN start d ON t.n = d.token)"""

_STEP_INPUTS = _triples(_sequences(_FULL), _FULL) + _SCORED

_SUMS = """,
  pulls AS (SELECT *, 1 / (1 + exp(-near)) - 1 AS g, 1 / (1 + exp(-far)) AS h FROM scored),
  moves AS (
    SELECT c AS token, g AS f, vo AS v FROM pulls UNION ALL SELECT c, h, vn FROM pulls
    UNION ALL SELECT o, g, vc FROM pulls UNION ALL SELECT n, h, vc FROM pulls),
  cells AS (SELECT token, generate_subscripts(v, 1) - 1 AS dim, f * unnest(v) AS x FROM moves),
  gradient AS (SELECT token, dim, sum(x) AS x FROM cells GROUP BY token, dim)"""

_MOVED = f""",
  old AS (SELECT token, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS x FROM start),
  step AS (SELECT token, o.dim, o.x - {_P.learning_rate} * coalesce(g.x, 0) AS x
           FROM old o LEFT JOIN gradient g USING (token, dim))"""

_GRADIENT = _STEP_INPUTS + _SUMS
_STEP = _GRADIENT + _MOVED

_DRAWN_EVENLY = f"""
  ranked AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS rank FROM corpus),
  drawn AS (SELECT shard, place, {_draw('(SELECT count(*) FROM corpus)', str(STEPS.seed), 'shard', 'place')} AS rank FROM places),
  pool AS (SELECT shard, place, token AS n FROM drawn JOIN ranked USING (rank)),"""
_DRAWN_BY_WEIGHT = _spans() + f""",
  drawn AS (SELECT shard, place, {_draw_wide('(SELECT total FROM weight)', str(STEPS.seed), 'shard', 'place')} AS d FROM places),
  pool AS (SELECT shard, place, token AS n FROM drawn ASOF JOIN spans ON d >= start),"""

# training in rounds: shards of windows in a row, each with a pool of negatives, one full step per shard and round
_SHARD_TRIPLES = _sequences(_FULL) + "," + _windows("sequences", "doc_id") + f""",
  counted AS (SELECT doc_id, count(*) AS n FROM windows GROUP BY doc_id),
  begun AS (SELECT doc_id, CAST(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS base FROM counted),
  placed AS (SELECT base + win_no AS win, (base + win_no) // {STEPS.windows_per_shard} AS shard, "window" FROM windows JOIN begun USING (doc_id)),
  corpus AS (SELECT DISTINCT unnest(tokens) AS token FROM sequences),
  places AS (SELECT shard, unnest(range(0, {STEPS.negative_pool})) AS place FROM (SELECT DISTINCT shard FROM placed)),{_DRAWN_EVENLY}
  links AS (SELECT shard, win, unnest(range(0, len("window") - 1)) AS p, "window" FROM placed WHERE len("window") > 1),
  pairs AS (SELECT shard, "window"[p + 1] AS c, "window"[p + 2] AS o, win * {STEPS.window_size} + p AS number, (win * {STEPS.window_size} + p) % {STEPS.negative_pool} AS place FROM links),
  triples AS (SELECT shard, c, o, n, number FROM pairs JOIN pool USING (shard, place)),
  ends AS (SELECT shard, c AS token FROM triples UNION ALL SELECT shard, o FROM triples UNION ALL SELECT shard, n FROM triples),
  touched AS (SELECT shard, token, count(*) AS k FROM ends GROUP BY shard, token),""" + _start("corpus") + """,
  table0 AS (SELECT token, v FROM start)"""


def _scores(number: int) -> str:
    return f""",
  scored{number} AS (
    SELECT t.shard, t.c, t.o, t.n, a.v AS vc, b.v AS vo, d.v AS vn, list_inner_product(a.v, b.v) AS near, list_inner_product(a.v, d.v) AS far
    FROM triples t JOIN table{number} a ON t.c = a.token JOIN table{number} b ON t.o = b.token JOIN table{number} d ON t.n = d.token)"""


def _rate(number: int) -> float:
    return STEPS.learning_rate * STEPS.decay_rate ** number


def _round(number: int) -> str:
    """``table{number + 1}``: the mean over shards of their tables after one step, weighted by how often they touch a token."""
    return _scores(number) + f""",
  pulls{number} AS (SELECT *, 1 / (1 + exp(-near)) - 1 AS g, 1 / (1 + exp(-far)) AS h FROM scored{number}),
  moves{number} AS (
    SELECT shard, c AS token, g AS f, vo AS v FROM pulls{number} UNION ALL SELECT shard, c, h, vn FROM pulls{number}
    UNION ALL SELECT shard, o, g, vc FROM pulls{number} UNION ALL SELECT shard, n, h, vc FROM pulls{number}),
  cells{number} AS (SELECT shard, token, generate_subscripts(v, 1) - 1 AS dim, f * unnest(v) AS x FROM moves{number}),
  slopes{number} AS (SELECT shard, token, dim, sum(x) AS x FROM cells{number} GROUP BY shard, token, dim),
  means{number} AS (SELECT token, dim, sum(k * x) / sum(k) AS x FROM slopes{number} JOIN touched USING (shard, token) GROUP BY token, dim),
  old{number} AS (SELECT token, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS x FROM table{number}),
  table{number + 1} AS (
    SELECT token, list(o.x - {_rate(number)} * coalesce(m.x, 0) ORDER BY o.dim) AS v
    FROM old{number} o LEFT JOIN means{number} m USING (token, dim) GROUP BY token)"""


def _probe(step: int) -> str:
    """``probe{step}``: each shard's loss on its held-back triples; ``own{step + 1}``: its table after one step over the others."""
    held = f"number % {PROBED.hold_out} = 0"
    return f""",
  near{step} AS (
    SELECT t.shard, t.c, t.o, t.n, t.number, a.v AS vc, b.v AS vo, d.v AS vn, list_inner_product(a.v, b.v) AS near, list_inner_product(a.v, d.v) AS far
    FROM triples t JOIN own{step} a ON t.shard = a.shard AND t.c = a.token JOIN own{step} b ON t.shard = b.shard AND t.o = b.token
    JOIN own{step} d ON t.shard = d.shard AND t.n = d.token),
  probe{step} AS (SELECT shard, CAST({step} AS BIGINT) AS step, avg(ln(1 + exp(-near)) + ln(1 + exp(far))) AS loss FROM near{step} WHERE {held} GROUP BY shard),
  drag{step} AS (SELECT *, 1 / (1 + exp(-near)) - 1 AS g, 1 / (1 + exp(-far)) AS h FROM near{step} WHERE NOT {held}),
  shift{step} AS (
    SELECT shard, c AS token, g AS f, vo AS v FROM drag{step} UNION ALL SELECT shard, c, h, vn FROM drag{step}
    UNION ALL SELECT shard, o, g, vc FROM drag{step} UNION ALL SELECT shard, n, h, vc FROM drag{step}),
  grain{step} AS (SELECT shard, token, generate_subscripts(v, 1) - 1 AS dim, f * unnest(v) AS x FROM shift{step}),
  slope{step} AS (SELECT shard, token, dim, sum(x) AS x FROM grain{step} GROUP BY shard, token, dim),
  flat{step} AS (SELECT shard, token, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS x FROM own{step}),
  own{step + 1} AS (
    SELECT f.shard, f.token, list(f.x - {_rate(step)} * coalesce(s.x, 0) ORDER BY f.dim) AS v
    FROM flat{step} f LEFT JOIN slope{step} s ON f.shard = s.shard AND f.token = s.token AND f.dim = s.dim GROUP BY f.shard, f.token)"""


_TIDY = "round({0}, 6) + 0.0"
_LOSSES = f"WITH {_SHARD_TRIPLES + _round(0) + _round(1) + _scores(2)} " + " UNION ALL ".join(
    f"""SELECT CAST({i} AS BIGINT) AS round, {_TIDY.format(f'CAST({_rate(i)} AS DOUBLE)')} AS rate,
        {_TIDY.format('avg(ln(1 + exp(-near)) + ln(1 + exp(far)))')} AS loss, false AS stopped FROM scored{i}""" for i in range(3))


def _top(source: str) -> str:
    return f"""
  units AS (SELECT token, v, sqrt(list_inner_product(v, v)) AS size FROM {source}),
  every AS (SELECT a.token, b.token AS neighbour,
              round(list_inner_product(a.v, b.v) / (a.size * b.size), 6) + 0.0 AS sim
            FROM units a JOIN units b ON a.token <> b.token),
  ranked AS (SELECT token, CAST(row_number() OVER (PARTITION BY token ORDER BY sim DESC, neighbour) AS INTEGER) AS rank,
              neighbour, sim FROM every),
  top AS (SELECT * FROM ranked WHERE rank <= {_P.neighbours})"""


_VECTORS = "vectors AS (SELECT vec_id AS token, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_TEXT_FLOAT = "CAST(CAST(printf('%.6f', CAST(x AS DOUBLE)) AS FLOAT) AS DOUBLE)"
_STREAM = f"""
  ids AS (SELECT doc_id, pos, {_piece_ids('line', _FULL)} AS tokens FROM lines),
  flat AS (SELECT doc_id, pos, generate_subscripts(tokens, 1) AS place, unnest(tokens) AS token FROM ids),
  stream AS (SELECT row_number() OVER (ORDER BY doc_id, pos, place) - 1 AS pos, token FROM flat)"""
_SHARDS = _LINES + "," + _STREAM + f""",
  sharded AS (SELECT CAST(pos % {_P.num_shards_embeddings} AS INTEGER) AS shard,
                     pos // {_P.num_shards_embeddings} AS shard_pos, token FROM stream)"""
_FORMAT = "text || ' ' || n || ' ' || token"
_VECTOR_TEXT = "'[' || array_to_string(list_transform({0}, lambda x: printf('%.6f', CAST(x AS DOUBLE))), ',') || ']'"
_DIMS = "CAST(generate_subscripts({0}, 1) - 1 AS BIGINT) AS dim, unnest({0}) AS x"


_TAB = "strpos(value, chr(9))"
_HEAD_IS_NUMBER = rf"regexp_full_match(substr(value, 1, {_TAB} - 1), '\s*[+-]?[0-9]{{1,18}}\s*')"
_JUDGED = rf"""{_NUMBERED},
  coded AS (SELECT line_no, line, {_piece_ids('line', _FULL)} AS t FROM numbered),
  vectors AS (SELECT {_VECTOR_TEXT.format('embedding')} AS v, vec_id || chr(9) || {_VECTOR_TEXT.format('embedding')} AS value FROM embeddings),
  lists AS (SELECT line_no, {_ids_text('t')} || CASE WHEN len(t) > 0 THEN ' ' ELSE '' END || 'x1 4.5 99999999999 -7 ' || substr(line, 1, 20) AS ids FROM coded),
  judged AS (
    SELECT 'numbered lines' AS parser, value, CASE WHEN {_TAB} = 0 THEN 'no tab' WHEN NOT {_HEAD_IS_NUMBER} THEN 'not a number' END AS reason
    FROM (SELECT doc_id || chr(9) || line AS value FROM lines UNION ALL SELECT line FROM lines)
    UNION ALL SELECT 'token lines', line_no || chr(9) || ids, NULL FROM lists
    UNION ALL SELECT 'token lines', line_no || chr(9) || '   ', 'no tokens' FROM lists
    UNION ALL SELECT 'token lines', line_no || ' ' || ids, CASE WHEN strpos(ids, chr(9)) = 0 THEN 'no tab' ELSE 'not a number' END FROM lists
    UNION ALL SELECT 'token lines', 'n' || line_no || chr(9) || '1 2', 'not a number' FROM lists
    UNION ALL SELECT 'embeddings', value || chr(9), NULL FROM vectors UNION ALL SELECT 'embeddings', value, NULL FROM vectors
    UNION ALL SELECT 'embeddings', value || 'x', 'not a vector' FROM vectors UNION ALL SELECT 'embeddings', chr(9) || value, 'not a number' FROM vectors
    UNION ALL SELECT 'embeddings', concat_ws(chr(9), role, text), 'not a number' FROM conversations
    UNION ALL SELECT 'strict embeddings', value, NULL FROM vectors UNION ALL SELECT 'strict embeddings', value || chr(9), NULL FROM vectors
    UNION ALL SELECT 'strict embeddings', chr(9) || ' ' || value || ' ' || chr(9), NULL FROM vectors
    UNION ALL SELECT 'strict embeddings', role, 'not two fields' FROM conversations
    UNION ALL SELECT 'strict embeddings', value || chr(9) || 'more', 'not two fields' FROM vectors
    UNION ALL SELECT 'vectors', v, NULL FROM vectors UNION ALL SELECT 'vectors', '[0.1,x]', 'not a vector' FROM vectors
    UNION ALL SELECT 'vectors', NULL, 'no value' FROM vectors)"""


ORACLE: dict[str, str] = {
    "corpus_lines": f"WITH {_LINES} SELECT doc_id, pos, line FROM lines",
    "number_lines": f"WITH {_NUMBERED} SELECT line_no, line FROM numbered",
    "numbered_corpus_files": f"WITH {_NUMBERED} SELECT line_no, line FROM numbered",
    "overwritten_lines": f"WITH {_NUMBERED} SELECT line_no, line FROM numbered",
    "order_lines": """
        SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS line_no, conv_id, turn, role, text
        FROM conversations ORDER BY line_no""",
    "shard_lines": f"""WITH {_NUMBERED}
        SELECT CAST(line_no % {_P.num_shards} AS INTEGER) AS shard, line_no // {_P.num_shards} AS shard_line, line_no, line
        FROM numbered""",
    "line_splits": f"""WITH {_NUMBERED}
        SELECT line_no // {_P.lines_per_split} AS split_no, count(*) AS n, min(line_no) AS first_line,
               max(line_no) AS last_line FROM numbered GROUP BY split_no""",
    "corpus_stats": f"""WITH {_LINES}, {_sequences(_FULL)}
        SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM lines) AS n_lines,
               (SELECT CAST(sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) AS BIGINT)
                FROM documents) AS n_words,
               (SELECT CAST(sum(len(tokens)) AS BIGINT) FROM sequences) AS n_tokens,
               (SELECT CAST(max(list_max(tokens)) + 1 AS BIGINT) FROM sequences) AS vocab_size""",
    "split_words": f"""WITH {_LINES},
        words AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '') AS w FROM lines)
        SELECT doc_id, pos, CAST(generate_subscripts(w, 1) - 1 AS BIGINT) AS word_no, unnest(w) AS word FROM words""",
    "piece_frequency": f"WITH {_WORDS} SELECT piece, n FROM counted",
    "piece_vocabulary": f"WITH {_WORDS} SELECT token, text, n FROM words",
    "format_word_counts": f"WITH {_WORDS} SELECT token, {_FORMAT} AS value FROM words",
    "merged_word_counts": f"WITH {_WORDS} SELECT token AS line_no, {_FORMAT} AS line FROM words",
    "concat_by_line": f"""WITH {_LINES}
        SELECT doc_id, pos, array_to_string(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> ''), ' ') AS word
        FROM lines WHERE len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '')) > 0""",
    "parse_numbered_lines": rf"""WITH {_LINES},
        rows AS (SELECT doc_id || chr(9) || line AS value FROM lines UNION ALL SELECT line FROM lines),
        cut AS (SELECT value, strpos(value, chr(9)) AS tab FROM rows)
        SELECT CAST(substr(value, 1, tab - 1) AS BIGINT) AS line_no, substr(value, tab + 1) AS line FROM cut
        WHERE tab > 0 AND regexp_full_match(substr(value, 1, tab - 1), '\s*[+-]?[0-9]{{1,18}}\s*')""",
    "parse_token_lines": f"""WITH {_NUMBERED},
        coded AS (SELECT line_no, line, {_piece_ids('line', _FULL)} AS t FROM numbered),
        words AS (SELECT line_no, regexp_split_to_array({_ids_text('t')} || ' x1 4.5 99999999999 -7 ' || substr(line, 1, 20), '\\s+') AS w FROM coded),
        ids AS (SELECT line_no, list_filter(list_transform(list_filter(w, lambda x: regexp_full_match(x, '[+-]?[0-9]+')),
                  lambda x: TRY_CAST(x AS INTEGER)), lambda x: x IS NOT NULL) AS ids FROM words)
        SELECT line_no, {_ids_text('ids')} AS tokens FROM ids""",
    "parse_token_shard": f"""WITH {_LINES},
        ids AS (SELECT doc_id, pos, {_piece_ids('line', _FULL)} AS t FROM lines)
        SELECT doc_id, pos, CAST(generate_subscripts(t, 1) - 1 AS BIGINT) AS place, unnest(t) AS token FROM ids""",
    "format_token_lines": f"""WITH {_NUMBERED}
        SELECT line_no, line_no || chr(9) || {_ids_text(_piece_ids('line', _FULL))} AS value FROM numbered""",
    "detokenize_lines": f"WITH {_LINES} SELECT doc_id, pos, line FROM lines",
    "detokenize_ids": f"""WITH {_WORDS},
        counts AS (SELECT lang, piece, count(*) AS n FROM pieces GROUP BY lang, piece)
        SELECT lang, token, counts.n, text FROM counts JOIN words ON piece = text""",
    "token_stream": f"WITH {_LINES}, {_STREAM} SELECT pos, token FROM stream",
    "shard_tokens": f"WITH {_SHARDS} SELECT shard, shard_pos, token FROM sharded",
    "shard_windows": f"""WITH {_SHARDS},
        whole AS (SELECT shard, list(token ORDER BY shard_pos) AS tokens FROM sharded GROUP BY shard),
        {_windows('whole', 'shard')}
        SELECT shard, win_no, {_ids_text('"window"')} AS "window" FROM windows""",
    "distinct_tokens": f"WITH {_sequences(_FULL)} SELECT DISTINCT unnest(tokens) AS token FROM sequences",
    "token_windows": f"""WITH {_sequences(_FULL)}, {_windows('sequences', 'doc_id')}
        SELECT doc_id, win_no, {_ids_text('"window"')} AS "window" FROM windows""",
    "skipgram_pairs": f"WITH {_pairs(_sequences(_FULL))} SELECT doc_id, win_no, pair_no, c, o FROM pairs",
    "negative_samples": f"WITH {_triples(_sequences(_FULL), _FULL)} SELECT doc_id, win_no, pair_no, c, o, n FROM triples",
    "parse_embeddings": f"""WITH cells AS (SELECT CAST(vec_id AS INTEGER) AS token, {_DIMS.format('embedding')} FROM embeddings)
        SELECT token, dim, {_TIDY.format(_TEXT_FLOAT)} AS x FROM cells, range(2)""",
    "unknown_tokens": f"""WITH {_sequences(_FULL)},
        flat AS (SELECT unnest(tokens) AS token FROM sequences)
        SELECT token, count(*) AS n FROM flat WHERE token NOT IN (SELECT vec_id FROM embeddings) GROUP BY token""",
    "narrow_scores": f"""WITH {_VECTORS}, {_top('vectors')}
        SELECT token, rank, neighbour, CAST(sim AS FLOAT) AS sim FROM top""",
    "format_embeddings": f"""SELECT vec_id AS token, vec_id || chr(9) || {_VECTOR_TEXT.format('embedding')} AS value
        FROM embeddings""",
    "dedupe_embeddings": f"""WITH last AS (SELECT label, max(vec_id) AS token FROM embeddings GROUP BY label),
        cells AS (SELECT e.label, token, {_DIMS.format('embedding')} FROM embeddings e JOIN last ON vec_id = token)
        SELECT label, token, dim, {_TIDY.format('CAST(x AS DOUBLE)')} AS x FROM cells""",
    "lookup_embeddings": f"""WITH {_FOLDED},
        flat AS (SELECT unnest(tokens) AS token FROM sequences),
        counts AS (SELECT token, count(*) AS n FROM flat GROUP BY token),
        cells AS (SELECT token, n, {_DIMS.format('embedding')} FROM counts JOIN embeddings ON vec_id = token)
        SELECT token, n, dim, {_TIDY.format('CAST(x AS DOUBLE)')} AS x FROM cells""",
    "mean_embeddings": f"""WITH cells AS (SELECT label, {_DIMS.format('embedding')} FROM embeddings)
        SELECT label, dim, {_TIDY.format(f'avg({_TEXT_FLOAT})')} AS x FROM cells GROUP BY label, dim""",
    "vector_dot": f"""WITH {_VECTORS}
        SELECT a.token, {_TIDY.format('list_inner_product(a.v, b.v)')} AS dot FROM vectors a JOIN vectors b ON b.token = a.token + 1""",
    "vector_norm": f"WITH {_VECTORS} SELECT token, {_TIDY.format('sqrt(list_inner_product(v, v))')} AS norm FROM vectors",
    "cosine_pairs": f"""WITH {_pairs(_FOLDED)}, {_VECTORS},
        met AS (SELECT DISTINCT c AS a, o AS b FROM pairs WHERE c <> o)
        SELECT a, b, {_TIDY.format('list_cosine_similarity(x.v, y.v)')} AS sim
        FROM met JOIN vectors x ON a = x.token JOIN vectors y ON b = y.token""",
    "top_k_similar": f"WITH {_VECTORS}, {_top('vectors')} SELECT token, rank, neighbour, sim FROM top",
    "format_neighbours": f"""WITH {_VECTORS}, {_top('vectors')}, {_WORDS},
        named AS (SELECT t.token, concat_ws(':', a.text, t.token) AS head, rank,
                    concat_ws(':', b.text, neighbour, printf('%.6f', sim)) AS part
                  FROM top t LEFT JOIN words a ON t.token = a.token LEFT JOIN words b ON neighbour = b.token)
        SELECT token, head || chr(9) || string_agg(part, ' ' ORDER BY rank) AS value FROM named GROUP BY token, head""",
    "init_embeddings": f"""WITH {_sequences(_FULL)},
        used AS (SELECT DISTINCT unnest(tokens) AS token FROM sequences), {_start('used')},
        cells AS (SELECT token, {_DIMS.format('v')} FROM start)
        SELECT token, dim, {_TIDY.format('x')} AS x FROM cells""",
    "sgns_loss": f"""WITH {_STEP_INPUTS}
        SELECT count(*) AS pairs, {_TIDY.format('avg(ln(1 + exp(-near)) + ln(1 + exp(far)))')} AS loss FROM scored""",
    "sgns_gradient": f"""WITH {_GRADIENT}
        SELECT token, CAST(dim AS BIGINT) AS dim, {_TIDY.format('x')} AS x FROM gradient""",
    "sgns_step": f"WITH {_STEP} SELECT token, CAST(dim AS BIGINT) AS dim, {_TIDY.format('x')} AS x FROM step",
}
ORACLE["pruned_neighbours"] = ORACLE["top_k_similar"]
ORACLE["parse_embeddings_strict"] = ORACLE["parse_embeddings"].replace("range(2)", "range(3)")
ORACLE |= {
    "lookup_occurrences": f"""WITH {_FOLDED},
        flat AS (SELECT doc_id, unnest(tokens) AS token FROM sequences),
        cells AS (SELECT doc_id, {_DIMS.format('embedding')} FROM flat JOIN embeddings ON vec_id = token)
        SELECT doc_id, count(*) AS n, dim, {_TIDY.format('avg(CAST(x AS DOUBLE))')} AS x FROM cells GROUP BY doc_id, dim""",
    "lookup_occurrence_sums": f"""WITH {_FOLDED},
        flat AS (SELECT doc_id, unnest(tokens) AS token FROM sequences),
        cells AS (SELECT doc_id, {_DIMS.format('embedding')} FROM flat JOIN embeddings ON vec_id = token)
        SELECT doc_id, dim, {_TIDY.format('sum(CAST(x AS DOUBLE))')} AS x FROM cells GROUP BY doc_id, dim""",
    "encoded_words": r"""
        WITH words AS (SELECT unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS word FROM documents)
        SELECT word, count(*) AS n, word AS text FROM words GROUP BY word""",
    "word_frequency_bytes": r"""
        SELECT lang, CAST(sum(strlen(regexp_replace(text, '\s+', '', 'g'))) AS BIGINT) AS n_bytes FROM documents GROUP BY lang""",
    "line_frequency_bytes": "SELECT lang, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM documents GROUP BY lang",
    "train_two_rounds": f"""WITH {_SHARD_TRIPLES + _round(0) + _round(1)},
        final AS (SELECT token, {_DIMS.format('v')} FROM table2)
        SELECT token, dim, {_TIDY.format('x')} AS x FROM final""",
    "nline_corpus": f"""WITH {_NUMBERED}
        SELECT line_no // {_P.lines_per_split} AS split, CAST(line_no % {_P.lines_per_split} AS INTEGER) AS place, line FROM numbered""",
    "rejected_rows": f"WITH {_JUDGED} SELECT parser, reason, value FROM judged WHERE reason IS NOT NULL",
    "parser_accounts": f"""WITH {_JUDGED}
        SELECT parser, count(*) AS n_read, count(*) FILTER (reason IS NULL) AS n_kept, count(reason) AS n_rejected FROM judged GROUP BY parser""",
    "observed_counts": f"""WITH {_LINES}, {_STREAM}
        SELECT (SELECT count(*) FROM lines) AS n_lines, count(*) AS n_tokens, CAST(max(token) + 1 AS BIGINT) AS vocab_size FROM stream""",
    "wide_means": f"""WITH cells AS (
          SELECT label, vec_id AS w, unnest(range(0, {WIDE})) AS dim, embedding FROM embeddings),
        scaled AS (SELECT label, w, dim, CAST(embedding[dim % 64 + 1] AS DOUBLE) * (dim // 64 + 1) AS x FROM cells)
        SELECT label, dim, {_TIDY.format('sum(w * x) / sum(w)')} AS x FROM scaled GROUP BY label, dim""",
    "part_word_counts": f"WITH {_WORDS} SELECT CAST(token % {PARTS} AS INTEGER) AS part, {_FORMAT} AS line FROM words",
    "reshape_vectors": f"""WITH cells AS (SELECT vec_id AS token, {_DIMS.format('embedding')} FROM embeddings)
        SELECT token, dim // {_P.embedding_dim} AS row, dim % {_P.embedding_dim} AS dim, {_TIDY.format('CAST(x AS DOUBLE)')} AS x FROM cells""",
    "train_probe": f"""WITH {_SHARD_TRIPLES},
        own0 AS (SELECT shard, token, v FROM (SELECT DISTINCT shard, token FROM ends) JOIN start USING (token)) {_probe(0) + _probe(1) + _probe(2)},
        taken AS (FROM probe0 UNION ALL FROM probe1 UNION ALL FROM probe2)
        SELECT shard, step, {_TIDY.format('loss')} AS loss,
               coalesce(loss < min(loss) OVER (PARTITION BY shard ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS best FROM taken""",
    "train_losses": _LOSSES,
    "train_losses_weighted": _LOSSES.replace(_DRAWN_EVENLY, _DRAWN_BY_WEIGHT),
    "token_spans": f"""WITH {_sequences(_FULL)}, {_spans()} SELECT token, start, "end" FROM spans""",
    "negative_samples_weighted": f"""WITH {_pairs(_sequences(_FULL))}, {_spans()},
        draws AS (SELECT *, {_draw_wide('(SELECT total FROM weight)', str(_P.seed), 'doc_id', 'win_no', 'pair_no')} AS d FROM pairs)
        SELECT doc_id, win_no, pair_no, c, o, s.token AS n FROM draws ASOF JOIN spans s ON d >= s.start""",
}
