"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from emberscope.llm import licences, line_dedup, secret_scan
from emberscope.llm.chat import Template


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_sql() -> str:
    def canonical(text: str) -> str:
        owner = _quoted(licences.OWNER_LINE)
        words = rf"' ' || regexp_replace(regexp_replace(lower({text}), {owner}, ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
        for a, b in licences.SPELLINGS.items():
            words = f"replace({words}, ' {a} ', ' {b} ')"
        return f"trim({words})"

    known = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in licences.NOTICES)
    return rf"""
    WITH known AS (SELECT {canonical("t")} AS c, min(i) AS i FROM (VALUES {known}) k(i, t) GROUP BY 1),
    units AS (
      SELECT doc_id, 'document' AS level, coalesce(text, '') AS t FROM documents
      UNION ALL SELECT doc_id, 'paragraph', unnest(string_split_regex(coalesce(text, ''), '\n[\x20\x09-\x0D]*\n')) FROM documents
      UNION ALL SELECT doc_id, 'line', unnest(string_split(coalesce(text, ''), chr(10))) FROM documents),
    hits AS (SELECT DISTINCT doc_id, level, i FROM (SELECT doc_id, level, {canonical("t")} AS c FROM units) JOIN known USING (c))
    SELECT doc_id,
           coalesce((SELECT string_agg(i, ',' ORDER BY i) FROM (SELECT DISTINCT i FROM hits h WHERE h.doc_id = d.doc_id)), '') AS licences,
           coalesce((SELECT string_agg(level, ',' ORDER BY level) FROM (SELECT DISTINCT level FROM hits h WHERE h.doc_id = d.doc_id)), '') AS levels,
           (SELECT count(DISTINCT i) FROM hits h WHERE h.doc_id = d.doc_id) AS n_licences
    FROM documents d"""


def _chat_sql() -> str:
    t = Template()

    def escaped(text: str) -> str:
        out = rf"replace({text}, '\', '\\')"
        for c in t.controls:
            out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
        return out

    start, sep = t.before.split("{role}")
    mark = lambda s: _quoted(s).replace("\n", "' || chr(10) || '")
    allowed = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in t.transitions)
    return f"""
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    steps AS (SELECT *, coalesce(lag(role) OVER w, 'start') AS prior,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS final
              FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length({mark(start)} || {escaped("role")} || {mark(sep)} || {escaped("text")} || {mark(t.after)}))::BIGINT AS formatted_chars,
           bool_and((prior, role) IN ({allowed})) AND bool_or(final AND role = 'assistant') AS valid
    FROM steps GROUP BY conv_id"""


_EXACT = r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM t"""

_LINES = r"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k FROM l
          WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
    g AS (SELECT doc_id, k, s AS a, lead(s) OVER w AS b, lead(s, 2) OVER w AS c FROM k
          WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
    f AS (SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS r FROM g WHERE c IS NOT NULL),
    gone AS (SELECT DISTINCT doc_id, unnest([k, k + 1, k + 2]) AS k FROM f WHERE r > 1),
    marked AS (SELECT l.doc_id, l.p, l.s, k.k IS NOT NULL AS has_word, gone.k IS NOT NULL AS gone
               FROM l LEFT JOIN k USING (doc_id, p) LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.k = k.k)
    SELECT doc_id, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (gone) AS n_removed,
           sha256(coalesce(string_agg(s, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS text_sha256
    FROM marked GROUP BY doc_id"""

_PASSAGES = rf"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k, count(*) OVER (PARTITION BY doc_id) AS n,
                 len(list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda x: x != '')) AS w FROM l
          WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
    g AS (SELECT doc_id, k, n, w, s AS a, lead(s) OVER o AS b, lead(s, 2) OVER o AS c, lead(w) OVER o AS v FROM k
          WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
    f AS (SELECT doc_id, k, 3 AS m, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS r FROM g WHERE c IS NOT NULL
          UNION ALL
          SELECT doc_id, k, 2, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, k) FROM g
          WHERE b IS NOT NULL AND w + v > {line_dedup.WORDS}
          UNION ALL
          SELECT doc_id, k, 1, row_number() OVER (PARTITION BY a ORDER BY doc_id, k) FROM g WHERE w > {line_dedup.WORDS}
          UNION ALL
          SELECT doc_id, k, n, row_number() OVER (PARTITION BY a, b ORDER BY doc_id) FROM g WHERE n < 3 AND k = 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + m)) AS k FROM f WHERE r > 1),
    marked AS (SELECT l.doc_id, l.p, l.s, k.k IS NOT NULL AS has_word, gone.k IS NOT NULL AS gone
               FROM l LEFT JOIN k USING (doc_id, p) LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.k = k.k)
    SELECT doc_id, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (gone) AS n_removed,
           sha256(coalesce(string_agg(s, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS text_sha256
    FROM marked GROUP BY doc_id"""

_NEAR = r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    h AS (SELECT doc_id, hash(s) AS s FROM s),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM h a JOIN h b USING (s)
               WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
              UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
    FROM documents d LEFT JOIN n USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)"""


def _secret_sql() -> str:
    """Matches and the pieces between them, listed once per rule; running lengths give positions.

    The one-class rules carry their bound in the pattern: matches are whole runs, and lists
    of all shorter runs would be long.
    """
    rules = [secret_scan.bounded(r) for r in secret_scan.RULES]
    parts = []
    for rank, rule in enumerate(rules):
        p = _quoted(rule.pattern)
        parts.append(
            f"""SELECT doc_id, {rank} AS r, '{rule.kind}' AS k, regexp_extract_all(t, {p}) AS m,
                       regexp_extract_all(t, {p}, {rule.size_of}) AS g, string_split_regex(t, {p}) AS s, {rule.at_least} AS least
                FROM d WHERE regexp_matches(t, {p})"""
        )
    n = len(secret_scan.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (k = '{r.kind}') AS n_{r.kind}" for r in rules[:n])
    named = "string_agg(k || ':' || b || ':' || (b + n), ',' ORDER BY b, r)"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    lists AS ({" UNION ALL ".join(parts)}),
    each AS (SELECT doc_id, r, k, least, unnest(m) AS m, unnest(g) AS g, unnest(s[:-2]) AS s, generate_subscripts(m, 1) AS i FROM lists),
    spans AS (SELECT doc_id, r, k, length(m) AS n, length(g) >= least AS fits,
                     (sum(length(s) + length(m)) OVER (PARTITION BY doc_id, r ORDER BY i) - length(m))::BIGINT AS b FROM each),
    found AS (SELECT doc_id, {counts}, sha256(coalesce({named} FILTER (r < {n}), '')) AS base_sha256, {named} AS spans
              FROM spans WHERE fits GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules[:n])},
           coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN found USING (doc_id)"""


_SEARCH = r"""
    WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    size AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
    total AS (SELECT count(*) AS d, sum(n)::BIGINT AS l FROM size),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weight AS (SELECT term, floor(1000 * ln((2 * any_value(d) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
               FROM tf, total GROUP BY term),
    scored AS (SELECT item_id, doc_id,
                 sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * d) // l))))::BIGINT AS score
               FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY ALL)
    SELECT item_id, rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM scored WHERE score > 0)
    WHERE rank <= 50"""

# Words that share what is left after deleting the code point at one place differ there; a
# word that equals another with one deleted is near it.
_SPELLING = r"""
    WITH RECURSIVE steps AS (
      SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8),
               lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i::BIGINT)) AS tab),
    runs AS (SELECT doc_id, run, count(*) AS c FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
      WHERE length(run) >= 6 GROUP BY ALL),
    coded AS (SELECT run, c, hex(encode(doc_id || ':' || run)) AS x FROM runs),
    summed AS (SELECT run, c, xor(list_reduce(list_transform(range(0, length(x) // 2),
          lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]),
          4294967295::BIGINT), 4294967295::BIGINT) AS h FROM coded, steps),
    spelt AS (SELECT c, CASE WHEN h % 199 = 0
          THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed),
    words AS (SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
    cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
    pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest
                AND a.word != b.word
              UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
              UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
    best AS (SELECT word, any_value(n) AS n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other,
                    max(other_n) AS other_n FROM pairs GROUP BY word),
    forms AS (SELECT word, n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
                     CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM best),
    walk AS (SELECT word, word AS stop, 0 AS steps FROM words
             UNION ALL SELECT w.word, f.form, steps + 1 FROM walk w JOIN forms f ON f.word = w.stop WHERE f.form IS NOT NULL)
    SELECT w.word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
    FROM words w LEFT JOIN forms USING (word)
    JOIN (SELECT word, arg_max(stop, steps) AS root FROM walk GROUP BY word) USING (word)"""

ORACLES: dict[str, str] = {
    "op1_licence_scan": _licence_sql(),
    "op2_chat_format": _chat_sql(),
    "op4_exact_dedup": _EXACT,
    "op6_line_dedup": _PASSAGES,
    "op6_passage_dedup": _PASSAGES,
    "op7_jaccard_join": _NEAR,
    "op8_secret_scan": _secret_sql(),
    "op11_lexical_search": _SEARCH,
    "op12_spelling_variants": _SPELLING,
}
