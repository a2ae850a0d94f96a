"""SQL expressions (DuckDB dialect) that restate the text functions for the side-by-side check."""

from __future__ import annotations

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NL = "chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean_prose(x: str) -> str:
    x = rf"regexp_replace(nfc_normalize({x}), '[^\PC\n ]', '', 'g')"
    x = rf"regexp_replace({x}, '\n{{3,}}', {NL} || {NL}, 'g')"
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = rf"regexp_replace({x}, ' *\n *', {NL}, 'g')"
    return strip(x)


def clean_code(x: str) -> str:
    x = rf"regexp_replace(nfc_normalize({x}), '[^\PC\n\t ]', '', 'g')"
    x = rf"regexp_replace({x}, '\n{{5,}}', {NL} || {NL} || {NL}, 'g')"
    x = rf"regexp_replace({x}, '(?m)[ \t]+$', '', 'g')"
    return strip(x)


def _next_fit(pieces: str, gap: str, limit: int) -> str:
    """Last state of a next-fit fold over a list of structs (pos, buf, done)."""
    joined = f"a.buf || {gap} || e.buf"
    return f"""list_reduce({pieces}, lambda a, e:
        CASE WHEN length({joined}) > {limit}
             THEN struct_pack(pos := e.pos, buf := e.buf, done :=
                  list_append(a.done, struct_pack(pos := e.pos, txt := a.buf)))
             ELSE struct_pack(pos := e.pos, buf := {joined}, done := a.done) END)"""


def _pieces(rows: str, pos: str, text: str) -> str:
    empty = "CAST([] AS STRUCT(pos BIGINT, txt VARCHAR)[])"
    return f"list(struct_pack(pos := CAST({pos} AS BIGINT), buf := {text}, done := {empty}) ORDER BY {pos}){rows}"


def packed_prose(source: str, limit: int = 2000, least: int = 150) -> str:
    """CTEs over `source(k, t)` (key, clean text), ending in `packed(k, frag_idx, text)`."""
    return f"""
    split_up AS (
        SELECT k, unnest(regexp_split_to_array(t, '\\n{{2,}}')) AS p,
               generate_subscripts(regexp_split_to_array(t, '\\n{{2,}}'), 1) AS i
        FROM {source}),
    paragraphs AS (
        SELECT k, p, row_number() OVER (PARTITION BY k ORDER BY i) AS i
        FROM (SELECT k, i, {strip('p')} AS p FROM split_up) WHERE p <> ''),
    short_state AS (
        SELECT k, {_next_fit('pieces', f'{NL} || {NL}', limit)} AS s FROM (
            SELECT k, {_pieces('', 'i', 'p')} AS pieces FROM paragraphs WHERE length(p) <= {limit} GROUP BY k)),
    long_sentences AS (
        SELECT k, i, unnest(str_split(regexp_replace(p, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))) AS s,
               generate_subscripts(str_split(regexp_replace(p, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), 1) AS j
        FROM paragraphs WHERE length(p) > {limit}),
    long_state AS (
        SELECT k, i, {_next_fit('pieces', "' '", limit)} AS s FROM (
            SELECT k, i, {_pieces('', 'j', 's')} AS pieces FROM long_sentences GROUP BY k, i)),
    emitted AS (
        SELECT k, d.pos AS pos, 0 AS sub, d.txt AS text FROM (SELECT k, unnest(s.done) AS d FROM short_state)
        UNION ALL SELECT k, 1000000000000, 0, s.buf FROM short_state
        UNION ALL SELECT k, i, d.pos, d.txt FROM (SELECT k, i, unnest(s.done) AS d FROM long_state)
        UNION ALL SELECT k, i, 1000000000000, s.buf FROM long_state),
    packed AS (
        SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY pos, sub) - 1 AS INTEGER) AS frag_idx, text
        FROM emitted WHERE length(text) >= {least})"""


def packed_code(source: str, limit: int = 2000, least: int = 100) -> str:
    """CTEs over `source(k, t)` (key, clean code with its header), ending in `packed(k, frag_idx, text)`."""
    return f"""
    lined AS (SELECT k, str_split(t, {NL}) AS ls FROM {source}),
    measured AS (
        SELECT k, ls, list_transform(ls, lambda l, i: struct_pack(at := CAST(i AS BIGINT),
            n := CAST(length(l) AS BIGINT), blank := {strip('l')} = '', used := CAST(-1 AS BIGINT),
            ends := CAST([] AS BIGINT[]))) AS ms FROM lined),
    folded AS (
        SELECT k, ls, list_reduce(ms, lambda a, e:
            CASE WHEN ((CASE WHEN a.used < 0 THEN e.n ELSE a.used + 1 + e.n END) >= {limit} AND e.blank)
                   OR (CASE WHEN a.used < 0 THEN e.n ELSE a.used + 1 + e.n END) >= 1.5 * {limit}
                 THEN struct_pack(at := e.at, n := e.n, blank := e.blank, used := CAST(-1 AS BIGINT),
                                  ends := list_append(a.ends, e.at))
                 ELSE struct_pack(at := e.at, n := e.n, blank := e.blank,
                                  used := CASE WHEN a.used < 0 THEN e.n ELSE a.used + 1 + e.n END, ends := a.ends)
            END, struct_pack(at := CAST(0 AS BIGINT), n := CAST(0 AS BIGINT), blank := false,
                             used := CAST(-1 AS BIGINT), ends := CAST([] AS BIGINT[]))) AS s
        FROM measured),
    bounds AS (
        SELECT k, ls, list_concat([CAST(0 AS BIGINT)], s.ends, [CAST(len(ls) AS BIGINT)]) AS b FROM folded),
    blocks AS (
        SELECT k, g, {strip(f"array_to_string(ls[b[g] + 1 : b[g + 1]], {NL})")} AS text
        FROM (SELECT k, ls, b, unnest(range(1, len(b))) AS g FROM bounds)),
    packed AS (
        SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY g) - 1 AS INTEGER) AS frag_idx, text
        FROM blocks WHERE length(text) >= {least})"""


def prose_of(table_expr: str) -> str:
    """`WITH` list that packs `table_expr`, a query giving (k, raw)."""
    return f"WITH src AS (SELECT k, {clean_prose('raw')} AS t FROM ({table_expr})),{packed_prose('src')}"


def code_of(table_expr: str) -> str:
    """`WITH` list that packs `table_expr`, a query giving (k, header, raw)."""
    return f"WITH src AS (SELECT k, header || {clean_code('raw')} AS t FROM ({table_expr})),{packed_code('src')}"


def any_of(column: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


def isin(column: str, values: list[str]) -> str:
    return f"{column} IN (" + ", ".join(f"'{v}'" for v in values) + ")"


BASE_NAME = "list_extract(str_split(path, '/'), -1)"
EXTENSION = rf"regexp_extract({BASE_NAME}, '^\.*[^.].*(\.[^.]*)$', 1, 's')"
PARENT = r"regexp_replace(path, '/?[^/]*$', '')"
