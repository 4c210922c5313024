"""The SQL that registered queries are held against."""

from __future__ import annotations

import re

from ..operators.notes import TEMPLATE

# Fixed value: white space as Python has it, for RE2.
_SP = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"

_PAGES = """pages AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, page_num ORDER BY coalesce(ingested_at, TIMESTAMP '0001-01-01') DESC, record_id DESC) AS rn FROM page_records) WHERE rn = 1)"""


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_SP}+', ''), '{_SP}+$', '')"


_LINE_TEXT = f"""CASE WHEN len(line.words) > 0 THEN {_strip("array_to_string([coalesce(w.text, '') for w in line.words if regexp_replace(coalesce(w.text, ''), '" + _SP + "+', '', 'g') <> ''], ' ')")} ELSE {_strip("coalesce(line.text, '')")} END"""


def _metrics(source: str, key: str, lines: str) -> str:
    """CTEs ending in m(key, char_count, line_count, avg_word_conf, alpha_ratio, garbage_ratio, pipe_ratio)."""
    return f"""
        l AS (SELECT {key}, generate_subscripts({lines}, 1) AS i, unnest({lines}) AS line FROM {source}),
        t AS (SELECT {key}, i, line, {_LINE_TEXT} AS x FROM l WHERE line IS NOT NULL),
        g AS (SELECT {key}, string_agg(x, chr(10) ORDER BY i) AS c, count(*) AS n, flatten(list([w.confidence for w in line.words if w.confidence >= 0])) AS confs FROM t WHERE x <> '' GROUP BY ALL),
        a AS (SELECT s.{key}, coalesce(length(g.c), 0) AS char_count, coalesce(g.n, 0) AS line_count, list_avg(g.confs) AS avg_word_conf,
            length(regexp_replace(g.c, '[^\\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(g.c, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS alnum,
            length(regexp_replace(g.c, '{_SP}', '', 'g')) AS solid, length(regexp_replace(g.c, '[^|]', '', 'g')) AS pipes
            FROM (SELECT {key} FROM {source}) s LEFT JOIN g USING ({key})),
        m AS (SELECT {key}, char_count, line_count, avg_word_conf, CASE WHEN alnum > 0 THEN letters / alnum ELSE 0.0 END AS alpha_ratio,
            CASE WHEN solid > 0 THEN (solid - alnum) / solid ELSE 0.0 END AS garbage_ratio, CASE WHEN solid > 0 THEN pipes / solid ELSE 0.0 END AS pipe_ratio FROM a)"""


_LOW = """(line_count <= 0 OR char_count <= 0 OR (char_count < 12 AND alpha_ratio < 0.35) OR (pipe_ratio > 0.04 AND alpha_ratio < 0.45) OR (garbage_ratio > 0.22 AND alpha_ratio < 0.45)
    OR (coalesce(avg_word_conf < 58.0, false) AND garbage_ratio > 0.22 * 0.75))"""

_PLACEHOLDER = """'OCR LOW QUALITY (avg_conf=' || coalesce(printf('%.1f', avg_word_conf), 'n/a') || ', garbage=' || printf('%.3f', garbage_ratio) || '). See scan: ' || coalesce(scan_relpath, '')"""

_RAW = f"coalesce(array_to_string([x.text for x in LINES if x.text IS NOT NULL AND regexp_replace(x.text, '{_SP}+', '', 'g') <> ''], chr(10)), '')"

_ROMAN_LETTERS = "regexp_replace(lower(TEXT), '[^ivxlcdm]', '', 'g')"


def _roman_value(text: str) -> str:
    r = _ROMAN_LETTERS.replace("TEXT", text)
    times = lambda s: f"((length({r}) - length(replace({r}, '{s}', ''))) / {len(s)})"
    plus = " + ".join(f"{times(k)} * {v}" for k, v in (("i", 1), ("v", 5), ("x", 10), ("l", 50), ("c", 100), ("d", 500), ("m", 1000)))
    minus = "".join(f" - {times(k)} * {v}" for k, v in (("iv", 2), ("ix", 2), ("xl", 20), ("xc", 20), ("cd", 200), ("cm", 200)))
    return f"CASE WHEN {r} <> '' AND regexp_full_match({r}, 'm{{0,4}}(cm|cd|d?c{{0,3}})(xc|xl|l?x{{0,3}})(ix|iv|v?i{{0,3}})') THEN CAST({plus}{minus} AS INTEGER) END"


_SIDE = r"""CASE WHEN regexp_matches(lower(regexp_replace(regexp_extract(coalesce(scan_relpath, ''), '([^/]*)$', 1), '(.)\.[^.]*$', '\1')), '_l$') THEN 'left'
    WHEN regexp_matches(lower(regexp_replace(regexp_extract(coalesce(scan_relpath, ''), '([^/]*)$', 1), '(.)\.[^.]*$', '\1')), '_r$') THEN 'right' ELSE 'neutral' END"""

_BARE = f"trim(trim(regexp_replace(coalesce(w.text, ''), '{_SP}+', ' ', 'g')), '|\\()')"

_SEEN = f"""
        {_PAGES},
        ls AS (SELECT book_id, page_num, [x for x in lines if len(x.bbox) = 4] AS ls FROM pages),
        cand AS (SELECT run_id, book_id, page_num, generate_subscripts(candidates, 1) - 1 AS cand_no, unnest(candidates) AS c FROM highlight_candidates),
        met AS (SELECT cand.*, c.bbox AS b, ls FROM cand JOIN ls USING (book_id, page_num) WHERE len(c.bbox) = 4 AND len(ls) > 0),
        line AS (SELECT run_id, book_id, page_num, cand_no, b, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS x FROM met),
        seen AS (SELECT *, least(x.bbox[3], b[3]) - greatest(x.bbox[1], b[1]) AS w, least(x.bbox[4], b[4]) - greatest(x.bbox[2], b[2]) AS h,
            greatest(1, (x.bbox[3] - x.bbox[1]) * (x.bbox[4] - x.bbox[2])) AS area, abs((x.bbox[2] + x.bbox[4]) / 2.0 - (b[2] + b[4]) / 2.0) AS off FROM line),
        hit AS (SELECT *, w > 0 AND h > 0 AND (w * h / area >= 0.02 OR w >= 40) AS hit FROM seen),
        picked AS (SELECT run_id, book_id, page_num, cand_no, any_value(b) AS b, count(*) AS n,
            CASE WHEN count(*) FILTER (hit) BETWEEN 1 AND 8 THEN list(i ORDER BY i) FILTER (hit)
                 WHEN count(*) FILTER (hit) > 8 THEN [arg_min(i, (off, i)) FILTER (hit)] ELSE [arg_min(i, (off, i))] END AS idx FROM hit GROUP BY run_id, book_id, page_num, cand_no)"""

_NOTE_ROWS = f"""
        {_PAGES},
        sp AS (SELECT run_id, book_id, page_num, unnest(spans) AS s FROM page_spans),
        j AS (SELECT row_number() OVER () AS k, sp.run_id, sp.book_id, sp.page_num, s.span_id AS span_id, s.line_ids AS line_ids, s.trigger_bboxes AS trigger_bboxes, s.span_bbox AS span_bbox, p.scan_relpath, p.config.config_hash AS config_hash, p.printed_page,
            p.printed_page_text, p.printed_page_kind, b.title, b.tags,
            list_filter(list_transform(s.line_ids, lambda id: list_filter(coalesce(p.lines, []), lambda x: x.line_id = id)[-1]), lambda x: x IS NOT NULL) AS q
            FROM sp JOIN pages p USING (book_id, page_num) JOIN books b USING (book_id)),
        {_metrics("j", "k", "q").strip()},
        n AS (SELECT j.*, CASE WHEN {_LOW} THEN {_PLACEHOLDER} ELSE {_RAW.replace("LINES", "q")} END AS quote FROM j JOIN m USING (k)),
        note AS (SELECT * FROM n WHERE regexp_replace(quote, '{_SP}+', '', 'g') <> '')"""

_TAGS = "list_concat(['book/' || book_id, 'ingest/highlight_excerpt'], [t for t in coalesce(tags, []) if t IS NOT NULL])"


def _distinct(tags: str) -> str:
    return f"list_transform(list_filter(list_transform({tags}, lambda t, i: {{'t': t, 'first': list_position({tags}, t) = i}}), lambda x: x.first), lambda x: x.t)"


def _elements(of: str, name: str) -> str:
    return f"""CASE json_type({of}, '$.{name}') WHEN 'ARRAY' THEN json_extract({of}, '$.{name}[*]') WHEN 'VARCHAR' THEN json_extract(TRY_CAST(json_extract_string({of}, '$.{name}') AS JSON), '$[*]') END"""


def _tokens(source: str, key: str, lines: str) -> str:
    """CTEs ending in tok(key, i, k, t, junk): the bare tokens of each line."""
    return rf"""
        l_ AS (SELECT {key}, generate_subscripts({lines}, 1) AS i, unnest({lines}) AS line FROM {source}),
        s_ AS (SELECT {key}, i, CASE WHEN len(line.words) > 0 THEN [{{'text': w.text, 'confidence': coalesce(w.confidence, 100.0)}} for w in line.words]
            ELSE [{{'text': p, 'confidence': 100.0}} for p in string_split(trim(regexp_replace(coalesce(line.text, ''), '{_SP}+', ' ', 'g')), ' ')] END AS words FROM l_ WHERE line IS NOT NULL),
        w_ AS (SELECT {key}, i, generate_subscripts(words, 1) AS k, unnest(words) AS w FROM s_),
        b_ AS (SELECT {key}, i, k, {_BARE} AS t, w.confidence AS c FROM w_),
        a_ AS (SELECT *, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) / greatest(length(t), 1) AS alpha FROM b_),
        tok AS (SELECT *, (t = '' OR regexp_full_match(t, '\|+') OR (contains(t, '|') AND c < 85) OR (contains(t, '\') AND c < 85)
            OR (length(t) = 1 AND NOT regexp_full_match(t, '[\p{{L}}\p{{N}}]')) OR (length(t) <= 2 AND lower(t) IN ('fi','fl','hl','hh','th','th!','i|','|i','l|','il') AND c < 85)
            OR (length(t) <= 2 AND regexp_full_match(t, '\p{{L}}+') AND t NOT IN ('I','A','a') AND c < 55) OR (alpha < 0.4 AND length(t) < 5 AND c < 70)) AS junk FROM a_)"""


def _clean(source: str, key: str, lines: str) -> str:
    """CTEs ending in cl(key, line_no, text): the readable lines."""
    return _tokens(source, key, lines) + rf""",
        j_ AS (SELECT {key}, i, trim(regexp_replace(string_agg(t, ' ' ORDER BY k), '{_SP}+', ' ', 'g')) AS text FROM tok WHERE NOT junk GROUP BY {key}, i),
        cl AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY i) - 1 AS line_no, text FROM j_ WHERE text <> '' AND NOT regexp_full_match(text, '\|+') AND NOT (length(text) = 1 AND NOT regexp_full_match(text, '[\p{{L}}\p{{N}}]')))"""


_TAIL = """-\\s*[)\\]}"''`.:;,_!]*$"""


def _merged(source: str, key: str, lines: str) -> str:
    """CTEs ending in mg(key, line_no, text): readable lines with broken words joined. In a row of lines that each could begin a pair the first, third, ... do."""
    return _clean(source, key, lines) + rf""",
        f_ AS (SELECT *, lead(text) OVER o AS after, regexp_matches(text, '{_TAIL}') AND coalesce(regexp_matches(lead(text) OVER o, '^[a-z]'), false) AS opens FROM cl WINDOW o AS (PARTITION BY {key} ORDER BY line_no)),
        g_ AS (SELECT *, line_no - max(CASE WHEN NOT opens THEN line_no END) OVER (PARTITION BY {key} ORDER BY line_no) AS since FROM f_),
        h_ AS (SELECT *, opens AND coalesce(since, line_no + 1) % 2 = 1 AS joins FROM g_),
        i_ AS (SELECT *, coalesce(lag(joins) OVER (PARTITION BY {key} ORDER BY line_no), false) AS taken FROM h_),
        mg AS (SELECT {key}, line_no, CASE WHEN joins THEN trim(regexp_replace(rtrim(regexp_replace(text, '{_TAIL}', '')) || after, '{_SP}+', ' ', 'g')) ELSE text END AS text FROM i_ WHERE NOT taken)"""


def _paragraphs(source: str, key: str, lines: str) -> str:
    """CTEs, recursive, ending in par(key, text): the lines folded into paragraphs, one after another."""
    return _merged(source, key, lines) + rf""",
        n_ AS (SELECT {key}, text, row_number() OVER (PARTITION BY {key} ORDER BY line_no) AS n FROM mg),
        fold AS (SELECT {key}, n, '' AS done, text AS cur FROM n_ WHERE n = 1
            UNION ALL SELECT n_.{key}, n_.n,
                CASE WHEN {_GOES_ON} THEN fold.done ELSE fold.done || fold.cur || chr(10) || chr(10) END,
                CASE WHEN {_GOES_ON} THEN trim(regexp_replace(fold.cur || ' ' || n_.text, '{_SP}+', ' ', 'g')) ELSE n_.text END
            FROM fold JOIN n_ ON n_.{key} = fold.{key} AND n_.n = fold.n + 1),
        par AS (SELECT {key}, arg_max(done || cur, n) AS text FROM fold GROUP BY {key})"""


_LISTED = "regexp_matches({}, '^([0-9]{{3,4}}\\s|[-*•]\\s)')"
_GOES_ON = f"""(NOT {_LISTED.format("fold.cur")} AND NOT {_LISTED.format("n_.text")} AND NOT regexp_matches(fold.cur, '[.!?]["'')\\]]*$') AND regexp_matches(n_.text, '^[a-z]'))"""

_RANKED = rf"""p AS (SELECT record_id, words, lines, page_width AS pw, page_height AS ph, {_SIDE} AS side FROM page_records),
        w0 AS (SELECT record_id, pw, ph, side, unnest(words) AS w FROM p),
        w AS (SELECT record_id, pw, ph, side, w.text AS text, w.confidence AS conf, w.bbox AS bbox, 'word' AS source, '' AS line_id FROM w0 WHERE len(w.bbox) = 4),
        l0 AS (SELECT record_id, pw, ph, side, unnest(lines) AS l FROM p),
        l1 AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY ((l.bbox[2] + l.bbox[4]) / 2.0) / greatest(1, ph), l.bbox[1], coalesce(l.line_id, '')) AS rn FROM l0 WHERE len(l.bbox) = 4),
        l AS (SELECT record_id, pw, ph, side, CASE WHEN len(l.words) > 0 THEN l.words[-1].text ELSE nullif(regexp_extract({_strip("coalesce(l.text, '')")}, '([A-Za-z0-9]+)[^A-Za-z0-9]*$', 1), '') END AS text,
            CASE WHEN len(l.words) > 0 THEN l.words[-1].confidence ELSE 0.0 END AS conf, l.bbox AS bbox, 'line' AS source, coalesce(l.line_id, '') AS line_id FROM l1 WHERE rn <= 5),
        c0 AS (SELECT * FROM w UNION ALL SELECT * FROM l WHERE coalesce(text, '') <> ''),
        c1 AS (SELECT *, ((bbox[1] + bbox[3]) / 2.0) / greatest(1, pw) AS x, ((bbox[2] + bbox[4]) / 2.0) / greatest(1, ph) AS y FROM c0),
        c AS (SELECT *, CASE side WHEN 'left' THEN x < 0.35 WHEN 'right' THEN x > 0.65 ELSE true END AS preferred, CASE side WHEN 'left' THEN 1 - x WHEN 'right' THEN x ELSE greatest(x, 1 - x) END AS edge,
            coalesce(text, '') AS tx, coalesce(conf, 0.0) AS cf FROM c1 WHERE y * ph <= 0.12 * greatest(1, ph)),
        k AS (SELECT *, CASE WHEN regexp_full_match(tx, '[0-9]{{1,4}}') THEN 0 WHEN length({_ROMAN_LETTERS.replace('TEXT', 'tx')}) >= 2 AND coalesce({_roman_value('tx')} <= 80, false) THEN 1 END AS kind FROM c WHERE cf >= 40),
        r AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY kind, NOT preferred, edge DESC, cf DESC, y, tx, line_id, source, bbox) AS best,
            row_number() OVER (PARTITION BY record_id, kind ORDER BY NOT preferred, edge DESC, cf DESC, y, tx, line_id, source, bbox) AS rn, min(kind) OVER (PARTITION BY record_id) AS least_kind FROM k WHERE kind IS NOT NULL)"""


def _written(source: str, key: str) -> str:
    """What is written of rows with metrics m and paragraphs par: the placeholder or the text."""
    return f"CASE WHEN {_LOW} THEN {_PLACEHOLDER} ELSE coalesce(par.text, '') END"


_NOTE_NAME = "coalesce(nullif(trim(regexp_replace(book_id || '_' || span_id, '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'note')"

_SIDECAR = """CASE WHEN coalesce(nullif(printed_page_text, ''), CAST(printed_page AS VARCHAR)) IS NULL
    THEN to_json({'book_id': book_id, 'page_num': page_num, 'span_id': span_id, 'line_ids': line_ids, 'trigger_bboxes': trigger_bboxes, 'span_bbox': span_bbox, 'run_id': run_id, 'config_hash': config_hash, 'scan_relpath': coalesce(scan_relpath, '')})
    ELSE to_json({'book_id': book_id, 'page_num': page_num, 'span_id': span_id, 'line_ids': line_ids, 'trigger_bboxes': trigger_bboxes, 'span_bbox': span_bbox, 'run_id': run_id, 'config_hash': config_hash, 'scan_relpath': coalesce(scan_relpath, ''),
        'printed_page': coalesce(nullif(printed_page_text, ''), CAST(printed_page AS VARCHAR))}) END"""


def _yaml(x: str) -> str:
    return f"CAST(to_json(coalesce({x}, '')) AS VARCHAR)"


def _source() -> str:
    return """'- book_id: ' || book_id || chr(10) || '- page_num: ' || page_num || chr(10) || '- scan_relpath: ' || coalesce(scan_relpath, '') || chr(10) || '- span_id: ' || span_id || chr(10)
            || '- line_ids: ' || array_to_string(line_ids, ', ') || chr(10) || '- run_id: ' || run_id || chr(10) || '- config_hash: ' || coalesce(config_hash, '')
            || coalesce(chr(10) || '- printed_page: ' || nullif(printed_page_text, '') || coalesce(' (' || nullif(printed_page_kind, '') || ')', ''), '')"""


def _filled() -> str:
    """The note template as a concatenation of its parts."""
    values = {k: _yaml(k) for k in ("note_version", "note_type", "note_status", "format", "creator", "year", "publisher_studio", "register")} | {
        "uuid": _yaml("'0'"),
        "YAML_schema_version": _yaml("yaml_schema_version"),
        "title": _yaml("coalesce(nullif(title, ''), book_id) || ' p' || page_num || ' ' || span_id"),
        "tags_block": f"array_to_string(list_transform({_distinct(_TAGS)}, lambda t: '  - ' || CAST(to_json(t) AS VARCHAR)), chr(10))",
        "quote_text": "quote",
        "source_block": "source",
    }
    parts = re.split(r"\{\{(\w+)\}\}", TEMPLATE)
    return " || ".join(values[x] if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(parts))


#: The keys of the note template, sorted, as the broken notes have them.
_KEYS = "YAML_schema_version,creator,format,note_status,note_type,note_version,publisher_studio,register,tags,title,uuid,year"
_KEYS_2 = "YAML_schema_version,creator,format,note_status,note_type,note_version,publisher_studio,register,tags,title,uuid,version,year,zeta"
_KEYS_3 = "YAML_schema_version,creator,format,note_status,note_type,note_version,publisher_studio,register,tags,title,title_2,uuid,year"

#: The default settings in their canonical JSON form.
_PIPELINE = (
    '{"emit_obsidian": {"sidecar_json_default": true}, "highlights": {"hsv_high": [95, 255, 255], "hsv_low": [15, 20, 80], "kernel_size": 5, "min_area": 120}, '
    '"ocr": {"language": "eng", "line_y_tolerance_px": 14, "psm": 6}, "spans": {"k_after": 2, "k_before": 2}}'
)


def _scalar(of: str, name: str) -> str:
    """A field of an object as text; null unless it is a scalar."""
    return f"CASE WHEN json_type({of}, '$.{name}') NOT IN ('NULL', 'OBJECT', 'ARRAY') THEN json_extract_string({of}, '$.{name}') END"


_RAW_LEVELS = f"""t AS (SELECT raw_id, trim(payload, chr(65279) || ' ' || chr(9) || chr(10) || chr(13)) AS p FROM raw_pages),
        v AS (SELECT raw_id, CAST(p AS JSON) AS v FROM t WHERE json_valid(p)),
        b AS (SELECT raw_id, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') WHEN 'OBJECT' THEN CASE WHEN json_type(v, '$.pages') = 'ARRAY' THEN json_extract(v, '$.pages[*]')
            WHEN json_type(v, '$.records') = 'ARRAY' THEN json_extract(v, '$.records[*]') WHEN json_type(v, '$.page') = 'OBJECT' THEN [json_extract(v, '$.page')] ELSE [v] END END AS b FROM v),
        r AS (SELECT raw_id, generate_subscripts(b, 1) - 1 AS rec_pos, unnest(b) AS rec FROM b),
        a AS (SELECT raw_id, rec_pos, {_elements("rec", "lines")} AS ls, {_elements("rec", "words")} AS ws FROM r WHERE json_type(rec) = 'OBJECT'),
        l AS (SELECT raw_id, rec_pos, generate_subscripts(ls, 1) - 1 AS line_pos, unnest(ls) AS line FROM a),
        lw AS (SELECT raw_id, rec_pos, line_pos, {_elements("line", "words")} AS ws FROM l WHERE json_type(line) <> 'NULL'),
        o AS (SELECT * FROM lw UNION ALL SELECT raw_id, rec_pos, -1 AS line_pos, ws FROM a)"""


ORACLES: dict[str, str] = {
    "p1_found": f"""
        WITH {_RAW_LEVELS},
        w AS (SELECT raw_id, rec_pos, line_pos, list_filter(list_transform(coalesce(ws, []), lambda x, i: CASE WHEN json_type(x) <> 'NULL' THEN i - 1 END), lambda i: i IS NOT NULL) AS places FROM o)
        SELECT raw_id, CAST(rec_pos AS INTEGER) AS rec_pos, CAST(line_pos AS INTEGER) AS line_pos, CAST(unnest(CASE WHEN len(places) = 0 AND line_pos >= 0 THEN [-1] ELSE places END) AS INTEGER) AS word_pos FROM w
    """,
    "p1_records": f"""
        WITH {_RAW_LEVELS}
        SELECT raw_id, CAST(rec_pos AS INTEGER) AS rec_pos, {_scalar("rec", "book_id")} AS book_id, TRY_CAST({_scalar("rec", "page_num")} AS INTEGER) AS page_num FROM r WHERE json_type(rec) <> 'NULL'
    """,
    "p1_lines": f"""
        WITH {_RAW_LEVELS}
        SELECT raw_id, CAST(rec_pos AS INTEGER) AS rec_pos, CAST(line_pos AS INTEGER) AS line_pos, {_scalar("line", "line_id")} AS line_id, {_scalar("line", "text")} AS text FROM l WHERE json_type(line) <> 'NULL'
    """,
    "p1_words": f"""
        WITH {_RAW_LEVELS},
        w AS (SELECT raw_id, rec_pos, line_pos, generate_subscripts(ws, 1) - 1 AS word_pos, unnest(ws) AS w FROM o)
        SELECT raw_id, CAST(rec_pos AS INTEGER) AS rec_pos, CAST(line_pos AS INTEGER) AS line_pos, CAST(word_pos AS INTEGER) AS word_pos, {_scalar("w", "text")} AS text FROM w WHERE json_type(w) <> 'NULL'
    """,
    "p1_page_words": """
        WITH l AS (SELECT record_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_pos FROM page_records),
        w AS (SELECT record_id, line_pos, unnest(line.words) AS word, generate_subscripts(line.words, 1) - 1 AS word_pos FROM l WHERE line IS NOT NULL)
        SELECT record_id, CAST(line_pos AS INTEGER) AS line_pos, CAST(word_pos AS INTEGER) AS word_pos, word.text AS text, word.confidence AS confidence
        FROM w WHERE word IS NOT NULL
    """,
    "q_text_metrics": f"""
        WITH {_metrics("page_records", "record_id", "lines").strip()}
        SELECT record_id, char_count, line_count, round(avg_word_conf, 9) AS avg_word_conf, round(alpha_ratio, 9) AS alpha_ratio, round(garbage_ratio, 9) AS garbage_ratio, round(pipe_ratio, 9) AS pipe_ratio FROM m
    """,
    "q_low_quality": f"""
        WITH {_metrics("page_records", "record_id", "lines").strip()}
        SELECT record_id, {_LOW} AS low_quality, round(alpha_ratio, 9) AS alpha_ratio, round(garbage_ratio, 9) AS garbage_ratio FROM m
    """,
    "q_clean_lines": f"WITH {_clean('page_records', 'record_id', 'lines')} SELECT record_id, CAST(line_no AS INTEGER) AS line_no, text FROM cl",
    "q_clean_tokens": f"""
        WITH {_tokens('page_records', 'record_id', 'lines')}
        SELECT record_id, CAST(i - 1 AS INTEGER) AS line_pos, CAST(k - 1 AS INTEGER) AS token_pos, t AS token, junk FROM tok
    """,
    "q_hyphen_merge": f"WITH {_merged('page_records', 'record_id', 'lines')} SELECT record_id, CAST(row_number() OVER (PARTITION BY record_id ORDER BY line_no) - 1 AS INTEGER) AS line_no, text FROM mg",
    "q_paragraphs": f"WITH RECURSIVE {_paragraphs('page_records', 'record_id', 'lines')} SELECT record_id, coalesce(text, '') AS text FROM page_records LEFT JOIN par USING (record_id)",
    "q_page_text": f"SELECT record_id, {_RAW.replace('LINES', 'lines')} AS text FROM page_records",
    "q_word_boxes": f"""
        WITH w AS (SELECT record_id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS word_pos FROM page_records),
        b AS (SELECT record_id, word_pos, CASE WHEN word_pos % 13 = 6 THEN ' ' || chr(160) ELSE w.text END AS text, w.bbox AS b,
            CASE WHEN word_pos % 7 = 3 THEN -1.0 WHEN word_pos % 11 = 5 THEN NULL ELSE w.confidence END AS conf, CASE WHEN word_pos % 17 = 9 THEN 0 ELSE w.bbox[3] - w.bbox[1] END AS width FROM w WHERE len(w.bbox) = 4)
        SELECT record_id, CAST(word_pos AS INTEGER) AS word_pos, text, round(conf, 6) AS confidence, b[1] || ',' || b[2] || ',' || (b[1] + width) || ',' || b[4] AS bbox
        FROM b WHERE {_strip("text")} <> '' AND conf >= 0 AND width > 0 AND b[4] > b[2]
    """,
    "q_line_grouping": """
        WITH RECURSIVE w0 AS (SELECT record_id, page_num, coalesce(CAST(config.line_y_tolerance_px AS DOUBLE), 14.0) AS tol, unnest(words) AS w, generate_subscripts(words, 1) AS k FROM page_records),
        w AS (SELECT record_id, page_num, tol, w, w.bbox AS b, (w.bbox[2] + w.bbox[4]) / 2.0 AS mid, row_number() OVER (PARTITION BY record_id ORDER BY (w.bbox[2] + w.bbox[4]) / 2.0, w.bbox[1], k) AS n FROM w0 WHERE len(w.bbox) = 4),
        g AS (SELECT record_id, n, mid AS total, 1 AS held, 1 AS line FROM w WHERE n = 1
            UNION ALL SELECT w.record_id, w.n, CASE WHEN abs(w.mid - g.total / g.held) <= w.tol THEN g.total + w.mid ELSE w.mid END, CASE WHEN abs(w.mid - g.total / g.held) <= w.tol THEN g.held + 1 ELSE 1 END,
                CASE WHEN abs(w.mid - g.total / g.held) <= w.tol THEN g.line ELSE g.line + 1 END FROM g JOIN w ON w.record_id = g.record_id AND w.n = g.n + 1)
        SELECT record_id, CAST(line - 1 AS INTEGER) AS line_pos, 'p' || any_value(page_num) || '_l' || line AS line_id, string_agg(coalesce(w.text, ''), ' ' ORDER BY b[1], n) AS text,
            min(b[1]) || ',' || min(b[2]) || ',' || max(b[3]) || ',' || max(b[4]) AS bbox FROM g JOIN w USING (record_id, n) GROUP BY record_id, line
    """,
    "q_roman_value": f"SELECT record_id, {_ROMAN_LETTERS.replace('TEXT', 'printed_page_text')} AS letters, {_roman_value('printed_page_text')} AS value FROM page_records WHERE printed_page_text IS NOT NULL",
    "q_printed_page": f"""
        WITH {_RANKED}
        SELECT p.record_id, CASE r.kind WHEN 0 THEN CAST(r.tx AS INTEGER) WHEN 1 THEN {_roman_value('r.tx')} END AS found_page, r.tx AS found_text, CASE r.kind WHEN 0 THEN 'arabic' WHEN 1 THEN 'roman' END AS found_kind
        FROM p LEFT JOIN (SELECT * FROM r WHERE best = 1) r USING (record_id)
    """,
    "q_printed_candidates": f"""
        WITH {_RANKED}
        SELECT record_id, CASE kind WHEN 0 THEN 'arabic' ELSE 'roman' END AS kind, CAST(rn AS INTEGER) AS rank, tx AS text, round(cf, 6) AS conf, array_to_string(bbox, ',') AS bbox, round(x, 9) AS x, round(y, 9) AS y, source, line_id
        FROM r WHERE rn <= 10 AND kind = least_kind
    """,
    "q_page_mode": f"""
        WITH {_PAGES},
        s AS (SELECT *, coalesce(bool_or(printed_page_kind = 'arabic' AND printed_page >= 10) OVER (PARTITION BY book_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS before,
            coalesce(bool_or(printed_page_kind = 'arabic' AND printed_page >= 10) OVER (PARTITION BY book_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS after FROM pages)
        SELECT book_id, page_num, CASE WHEN NOT (before AND coalesce(printed_page_kind = 'roman', false)) THEN printed_page END AS printed_page,
            CASE WHEN NOT (before AND coalesce(printed_page_kind = 'roman', false)) THEN printed_page_kind END AS printed_page_kind, CASE WHEN after THEN 'arabic' ELSE 'auto' END AS mode FROM s
    """,
    "q_scan_side": f"SELECT record_id, {_SIDE} AS side FROM page_records WHERE scan_relpath IS NOT NULL",
    "q_natural_order": rf"""
        WITH {_PAGES},
        n AS (SELECT book_id, record_id, regexp_extract(scan_relpath, '([^/]*)$', 1) AS name FROM pages WHERE scan_relpath IS NOT NULL),
        k AS (SELECT *, list_transform(regexp_extract_all(lower(name), '\d+|\D+'), lambda t: CASE WHEN regexp_matches(t, '^\d') THEN {{'kind': 0, 'size': length(regexp_replace(t, '^0+(\d)', '\1')), 'text': regexp_replace(t, '^0+(\d)', '\1')}} ELSE {{'kind': 1, 'size': 0, 'text': t}} END) AS key FROM n)
        SELECT book_id, record_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY key, name, record_id) AS INTEGER) AS ordinal FROM k
    """,
    "q_line_map": f"""
        WITH {_PAGES}, l AS (SELECT book_id, page_num, generate_subscripts(lines, 1) - 1 AS line_pos, unnest(lines) AS l FROM pages)
        SELECT book_id, page_num, CAST(line_pos AS INTEGER) AS line_pos, l.line_id AS line_id, l.text AS text FROM l WHERE l IS NOT NULL
    """,
    "q_shape_filter": f"""
        WITH {_PAGES}, cand AS (SELECT run_id, book_id, page_num, config, generate_subscripts(candidates, 1) - 1 AS cand_no, unnest(candidates) AS c FROM highlight_candidates),
        g AS (SELECT cand.*, c.bbox AS b, page_width AS pw, greatest(1, c.bbox[3] - c.bbox[1]) AS w, greatest(1, c.bbox[4] - c.bbox[2]) AS h, greatest(1, page_height) AS ph FROM cand JOIN pages USING (book_id, page_num) WHERE len(c.bbox) = 4)
        SELECT run_id, book_id, page_num, CAST(cand_no AS INTEGER) AS cand_no, NOT (h / w > config.max_hw_ratio OR h / ph > config.max_height_frac
            OR ((b[1] <= config.edge_margin_px OR b[3] >= pw - config.edge_margin_px) AND h / ph > config.max_height_frac * 0.6)) AS ok FROM g
    """,
    "q_trigger_select": f"WITH {_SEEN} SELECT run_id, book_id, page_num, CAST(cand_no AS INTEGER) AS cand_no, array_to_string(idx, ',') AS picked FROM picked",
    "q_spans": f"""
        WITH {_SEEN},
        anchored AS (SELECT *, idx[len(idx) // 2 + 1] AS a FROM picked),
        win AS (SELECT a.*, [x for x in met.ls[greatest(0, a.a - 2) + 1 : least(a.n - 1, a.a + 2) + 1]] AS wl FROM anchored a JOIN met USING (run_id, book_id, page_num, cand_no)),
        one AS (SELECT run_id, book_id, page_num, cand_no, b, [x.line_id for x in wl] AS ids, list_min([x.bbox[1] for x in wl]) AS x1, list_min([x.bbox[2] for x in wl]) AS y1, list_max([x.bbox[3] for x in wl]) AS x2, list_max([x.bbox[4] for x in wl]) AS y2 FROM win),
        merged AS (SELECT run_id, book_id, page_num, ids, min(cand_no) AS first, string_agg(array_to_string(b, ','), ';' ORDER BY cand_no) AS triggers, min(x1) || ',' || min(y1) || ',' || max(x2) || ',' || max(y2) AS span_bbox FROM one GROUP BY run_id, book_id, page_num, ids)
        SELECT run_id, book_id, page_num, 'p' || page_num || '_s' || row_number() OVER (PARTITION BY run_id, book_id, page_num ORDER BY first) AS span_id, array_to_string(ids, ',') AS line_ids, triggers, span_bbox FROM merged
    """,
    "q_notes_raw": rf"""
        WITH {_NOTE_ROWS}
        SELECT run_id, book_id, page_num, span_id, coalesce(nullif(trim(regexp_replace(book_id || '_' || span_id, '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'note') AS note_name,
            coalesce(nullif(title, ''), book_id) || ' p' || page_num || ' ' || span_id AS title, quote, array_to_string(list_transform({_distinct(_TAGS)}, lambda t: '  - ' || CAST(to_json(t) AS VARCHAR)), chr(10)) AS tags_block,
            coalesce(nullif(printed_page_text, ''), CAST(printed_page AS VARCHAR)) AS printed_page FROM note
    """,
    "q_source_block": f"""
        WITH {_NOTE_ROWS}
        SELECT run_id, book_id, page_num, span_id, '- book_id: ' || book_id || chr(10) || '- page_num: ' || page_num || chr(10) || '- scan_relpath: ' || coalesce(scan_relpath, '') || chr(10) || '- span_id: ' || span_id || chr(10)
            || '- line_ids: ' || array_to_string(line_ids, ', ') || chr(10) || '- run_id: ' || run_id || chr(10) || '- config_hash: ' || coalesce(config_hash, '')
            || coalesce(chr(10) || '- printed_page: ' || nullif(printed_page_text, '') || coalesce(' (' || nullif(printed_page_kind, '') || ')', ''), '') AS source FROM note
    """,
    "q_frontmatter_ok": f"""
        WITH {_NOTE_ROWS},
        v AS (SELECT run_id, book_id, page_num, span_id, unnest(range(6)) AS variant FROM note)
        SELECT run_id, book_id, page_num, span_id, CAST(variant AS INTEGER) AS variant, CASE variant WHEN 0 THEN '{_KEYS}' WHEN 2 THEN '{_KEYS_2}' WHEN 3 THEN '{_KEYS_3}' ELSE '' END AS keys,
            CASE variant WHEN 2 THEN 'version,zeta' WHEN 3 THEN 'title_2' ELSE '' END AS "foreign", variant = 0 AS ok FROM v
    """,
    "q_sidecar": f"""
        WITH {_NOTE_ROWS}
        SELECT run_id, book_id, page_num, span_id, {_SIDECAR} AS sidecar FROM note
    """,
    "q_notes": f"""
        WITH RECURSIVE {_NOTE_ROWS.replace("b.title, b.tags,", "b.title, b.tags, b.creator, b.year, b.format, b.publisher_studio, b.note_type, b.note_status, b.note_version, b.yaml_schema_version, b.register,")},
        {_paragraphs("j", "k", "q").strip()},
        whole AS (SELECT j.*, {_written("j", "k")} AS quote, {_source()} AS source FROM j JOIN m USING (k) LEFT JOIN par USING (k))
        SELECT run_id, book_id, page_num, span_id, {_NOTE_NAME} AS note_name, {_filled()} AS note, {_SIDECAR} AS sidecar FROM whole WHERE regexp_replace(quote, '{_SP}+', '', 'g') <> ''
    """,
    "q_config_hash": f"""SELECT book_id, left(sha256('{{"book": {{"book_id": ' || {_yaml("book_id")} || ', "scans_path": ' || {_yaml("scans_path")} || '}}, "pipeline": {_PIPELINE}}}'), 16) AS config_hash FROM books""",
    "q_export_txt": f"""
        WITH RECURSIVE {_PAGES}, {_metrics("pages", "record_id", "lines").strip()}, {_paragraphs("pages", "record_id", "lines").strip()}
        SELECT book_id, page_num, {_strip("'# Page ' || page_num || chr(10) || " + _written("pages", "record_id"))} AS part FROM pages JOIN m USING (record_id) LEFT JOIN par USING (record_id)
    """,
    "q_export_md": f"""
        WITH RECURSIVE {_PAGES}, {_metrics("pages", "record_id", "lines").strip()}, {_paragraphs("pages", "record_id", "lines").strip()},
        body AS (SELECT book_id, page_num, ['## Page ' || coalesce(printed_page, page_num) || ' (scan: ' || coalesce(scan_relpath, '') || ')', {_strip(_written("pages", "record_id"))}, '---', ''] AS parts FROM pages JOIN m USING (record_id) LEFT JOIN par USING (record_id)),
        front AS (SELECT book_id, CAST(NULL AS INTEGER) AS page_num, [{_strip("'# ' || coalesce(nullif(title, ''), book_id)")}, ''] AS parts FROM books WHERE book_id IN (SELECT book_id FROM pages))
        SELECT book_id, page_num, CAST(unnest(range(len(parts))) AS INTEGER) AS part_no, unnest(parts) AS part FROM (SELECT * FROM body UNION ALL SELECT * FROM front)
    """,
    "q_trigger_overlap": f"""
        WITH {_SEEN}
        SELECT run_id, book_id, page_num, CAST(cand_no AS INTEGER) AS cand_no, CAST(i AS INTEGER) AS line_no, CAST(w * h AS INTEGER) AS area, CAST(w AS INTEGER) AS w, CAST(h AS INTEGER) AS h, hit FROM hit WHERE w > 0 AND h > 0
    """,
    "q_trigger_nearest": f"""
        WITH {_SEEN}, best AS (SELECT *, row_number() OVER (PARTITION BY run_id, book_id, page_num, cand_no ORDER BY off, i) AS rn FROM seen)
        SELECT run_id, book_id, page_num, CAST(cand_no AS INTEGER) AS cand_no, CAST(i AS INTEGER) AS line_no, off FROM best WHERE rn = 1
    """,
    "q_export_raw": f"""
        WITH {_PAGES}, {_metrics("pages", "record_id", "lines").strip()}
        SELECT book_id, page_num, {_strip("'# Page ' || page_num || chr(10) || CASE WHEN " + _LOW + " THEN " + _PLACEHOLDER + " ELSE " + _RAW.replace("LINES", "lines") + " END")} AS part FROM pages JOIN m USING (record_id)
    """,
    "q_filename_sanitize": "SELECT book_id, coalesce(nullif(trim(regexp_replace(coalesce(title, ''), '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'note') AS name FROM books",
    "q_tags": f"SELECT book_id, array_to_string({_distinct(_TAGS)}, '|') AS tags FROM books",
}
