"""SQL counterparts of the registered queries, for DuckDB on the same tables.

They are written from the rules, with other means than the Spark side: list lambdas instead of
look-arounds, recursive queries instead of folds, joins instead of array maps.
"""

from __future__ import annotations

from pagefold.functions.text import WHITESPACE
from pagefold.plans.derived import MEMO_SQL

# RE2 spellings of the character sets.
_SPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_LATIN = r"A-Za-z\x{130}\x{212a}"
_HANGUL = r"\x{ac00}-\x{d7a3}"
_DIGIT = (
    r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
)
_JAMO = "ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎㅏㅑㅓㅕㅗㅛㅜㅠㅡㅣㅐㅔ"
_EMAIL = r"[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}"
# Written from the format: [country] (area) or area, group of 3 or 4, group of 4.
_PHONE = (
    r"(?:(?:\+?\b\d{1,3}[ .-])?\(\d{2,4}\)[ .-]?|\+?\b(?:\d{1,3}[ .-])?\d{2,4}[ .-])\d{3,4}[ .-]\d{4}\b"
)
NL = "chr(10)"


_ENGLISH = "the and of to in is that it for with was are on as be"
_OTHER_LATIN = (
    "le la les des et que une est dans pour pas du der die und das ist nicht ein mit von den el los las y en por un una con de"
)


_DELIMITER = f"(?:[.!?][{_SPACE}]+|\\n\\n)"


def _among(words: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words.split())
    return f"len(list_filter(words, lambda w: w IN ({listed})))"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_q(WHITESPACE)})"


def _count(x: str, char_class: str) -> str:
    return f"length(regexp_replace({x}, {_q(f'[^{char_class}]')}, '', 'g'))"


def _split(x: str) -> str:
    return f"list_transform(string_split({x}, {NL}), lambda s: {_strip('s')})"


def _blank(x: str) -> str:
    return f"(length({_strip(x)}) = 0)"


def _rule(line: str) -> str:
    """Deciding rule of one stripped line."""
    n = f"length({line})"
    first = f"regexp_matches({line}, '^[\\p{{L}}\\p{{N}}]')"
    latin, vowels = _count(line, _LATIN), _count(line, r"AEIOUaeiou\x{130}")
    chars = f"string_split({line}, '')"
    triple = (
        f"len(list_filter(range(1, {n} - 1), lambda i: {chars}[i] = {chars}[i + 1] "
        f"AND {chars}[i + 1] = {chars}[i + 2])) > 0"
    )
    not_alnum = f"({n} - {_count(line, r'\p{L}\p{N}')} + {_count(line, _DIGIT)})"
    return f"""CASE
        WHEN {n} = 0 THEN 'blank'
        WHEN {n} < 2 THEN 'too_short'
        WHEN {_count(line, r'\p{L}\p{N}_')} = 0 THEN 'specials_only'
        WHEN {_count(line, r'\p{L}\p{N}')} / {n}::DOUBLE < 0.3 THEN 'low_signal'
        WHEN {n} < 10 AND {_count(line, _LATIN + _HANGUL)} < 3 THEN 'few_letters'
        WHEN {n} < 10 AND {not_alnum} > 0.7 * {n} THEN 'mostly_digits'
        WHEN NOT {first} AND {triple} THEN 'repeated_special'
        WHEN {_count(line, _JAMO)} > 0.2 * {n} THEN 'loose_jamo'
        WHEN {latin} BETWEEN 4 AND 7 AND ({vowels} / {latin}::DOUBLE < 0.15
             OR {vowels} / {latin}::DOUBLE > 0.85) THEN 'odd_latin' END"""


def _collapse(x: str) -> str:
    return f"regexp_replace({x}, {_q(f'[{_SPACE}]+')}, ' ', 'g')"


def _clean_basic(x: str) -> str:
    spaced = f"replace(regexp_replace({x}, ' +', ' ', 'g'), chr(9), ' ')"
    return f"coalesce(array_to_string(list_filter({_split(spaced)}, lambda s: length(s) > 0), {NL}), '')"


def _ocr_ctes(source: str, key: str, out: str = "ocr") -> str:
    """Common tables that clean ``source(key, text)`` line by line into ``out(key, text)``."""
    return f"""{out}_lines AS (
      SELECT {key}, i AS line_no, {_split('text')}[i] AS line
      FROM (SELECT {key}, text, unnest(range(1, len(string_split(text, {NL})) + 1)) AS i FROM {source})),
    {out}_kept AS (SELECT {key}, line_no, {_collapse('line')} AS line FROM {out}_lines WHERE {_rule('line')} IS NULL),
    {out} AS (
      SELECT s.{key}, coalesce(k.text, '') AS text FROM {source} s LEFT JOIN (
        SELECT {key}, string_agg(line, {NL} ORDER BY line_no) AS text FROM {out}_kept GROUP BY {key}) k
      ON s.{key} = k.{key})"""


MEMOS = f"memos AS (SELECT o_orderkey AS memo_id, {MEMO_SQL} AS text FROM orders)"


def _sentences(x: str) -> str:
    marked = (
        f"regexp_replace({x}, {_q(f'([.!?。！？]+)[{_SPACE}]+')}, '\\1' || chr(1), 'g')"
    )
    return (
        f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {_strip('s')}), "
        "lambda s: length(s) > 0)"
    )


def _windows(x: str, size: int, overlap: int) -> str:
    """List of fixed windows over a non-blank text."""
    step = size - overlap
    last = f"greatest(ceil((length({x}) - {size}) / {step}.0)::BIGINT, 0)"
    return (
        f"list_transform(range(0, {last} + 1), "
        f"lambda i: substring({x}, i * {step} + 1, {size}))"
    )


def _semantic_ctes(source: str, key: str, size: int = 500, overlap: int = 100) -> str:
    """Greedy merge, one sentence per step, over ``source(key, text)``; result ``merged``."""
    carried = (
        "coalesce(list_min(list_filter(range(w.first, w.pos), "
        f"lambda j: list_sum(s.sizes[j:w.pos - 1]) <= {overlap})), w.pos)"
    )
    return f"""sents AS MATERIALIZED (
      SELECT {key}, list AS parts, list_transform(list, lambda x: length(x)) AS sizes, len(list) AS n
      FROM (SELECT {key}, {_sentences('text')} AS list FROM {source} WHERE NOT {_blank('text')})),
    walk AS (
      SELECT {key}, 1 AS pos, 1 AS first, 0 AS used, NULL::BIGINT AS out_first, NULL::BIGINT AS out_last
      FROM sents
      UNION ALL
      SELECT w.{key}, w.pos + 1,
        CASE WHEN w.over THEN w.keep ELSE w.first END,
        CASE WHEN w.over THEN coalesce(list_sum(w.sizes[w.keep:w.pos - 1]), 0) ELSE w.used END + w.sizes[w.pos],
        CASE WHEN w.over THEN w.first END, CASE WHEN w.over THEN w.pos - 1 END
      FROM (SELECT w.*, s.sizes, {carried} AS keep,
              w.used + s.sizes[w.pos] > {size} AND w.first < w.pos AS over
            FROM walk w JOIN sents s ON w.{key} = s.{key} WHERE w.pos <= s.n) w),
    spans AS (
      SELECT {key}, out_first AS a, out_last AS b FROM walk WHERE out_first IS NOT NULL
      UNION ALL
      SELECT w.{key}, w.first, s.n FROM walk w JOIN sents s ON w.{key} = s.{key} WHERE w.pos = s.n + 1),
    merged AS (
      SELECT s.{key}, row_number() OVER (PARTITION BY s.{key} ORDER BY s.b) - 1 AS chunk_id,
        array_to_string(t.parts[s.a:s.b], ' ') AS text
      FROM spans s JOIN sents t ON s.{key} = t.{key}
      UNION ALL SELECT {key}, 0, '' FROM {source} WHERE {_blank('text')})"""


_SEPARATORS = f"[{NL} || {NL}, {NL}, '。', '. ', '! ', '? ', ', ', ' ', '']"


def _recursive_ctes(source: str, key: str, size: int = 500, overlap: int = 100) -> str:
    """Cut by the first separator a text has, cut long pieces by later ones, join short neighbours; result ``packed``.

    A piece's path is its number in its parent behind the parent's path, so paths sort as texts read.
    """
    level = f"list_min(list_filter(range(least, 10), lambda i: i = 9 OR contains(text, {_SEPARATORS}[i])))"
    split = f"""CASE WHEN level = 9 THEN list_transform(range(1, length(text) + 1), lambda i: text[i])
        ELSE list_filter(list_transform(string_split(text, {_SEPARATORS}[level]),
          lambda p, i: CASE WHEN i > 1 THEN {_SEPARATORS}[level] || p ELSE p END), lambda p: p <> '') END"""
    carried = (
        "coalesce(list_min(list_filter(range(w.first, w.pos), "
        f"lambda j: list_sum(r.sizes[j:w.pos - 1]) <= {overlap} "
        f"AND list_sum(r.sizes[j:w.pos]) <= {size})), w.pos)"
    )
    return f"""cut AS (
      SELECT {key}, '' AS path, level, {split} AS parts FROM (SELECT {key}, text, {level} AS level
        FROM (SELECT {key}, text, 1 AS least FROM {source} WHERE NOT {_blank('text')}))
      UNION ALL
      SELECT {key}, path, level, {split} FROM (SELECT {key}, path, text, {level} AS level
        FROM (SELECT {key}, path || lpad(n::VARCHAR, 8, '0') AS path, text, before + 1 AS least
          FROM (SELECT {key}, path, level AS before, unnest(parts) AS text, unnest(range(1, len(parts) + 1)) AS n FROM cut)
          WHERE length(text) >= {size} AND before < 9))),
    pieces AS (
      SELECT *, sum(CASE WHEN length(text) >= {size} THEN 1 ELSE 0 END) OVER (PARTITION BY {key}, path ORDER BY n) AS run
      FROM (SELECT {key}, path, unnest(parts) AS text, unnest(range(1, len(parts) + 1)) AS n FROM cut)),
    runs AS MATERIALIZED (
      SELECT {key}, path || lpad(min(n)::VARCHAR, 8, '0') AS place, list(text ORDER BY n) AS parts,
        list(length(text) ORDER BY n) AS sizes, count(*) AS n
      FROM pieces WHERE length(text) < {size} GROUP BY {key}, path, run),
    steps AS (
      SELECT {key}, place, 1 AS pos, 1 AS first, 0 AS used, NULL::BIGINT AS out_first, NULL::BIGINT AS out_last FROM runs
      UNION ALL
      SELECT w.{key}, w.place, w.pos + 1, CASE WHEN w.over THEN w.keep ELSE w.first END,
        CASE WHEN w.over THEN coalesce(list_sum(w.sizes[w.keep:w.pos - 1]), 0) ELSE w.used END + w.sizes[w.pos],
        CASE WHEN w.over THEN w.first END, CASE WHEN w.over THEN w.pos - 1 END
      FROM (SELECT w.*, r.sizes, {carried} AS keep, w.used + r.sizes[w.pos] > {size} AND w.first < w.pos AS over
            FROM steps w JOIN runs r ON w.{key} = r.{key} AND w.place = r.place WHERE w.pos <= r.n) w),
    joined AS (
      SELECT {key}, place, out_first AS a, out_last AS b FROM steps WHERE out_first IS NOT NULL
      UNION ALL
      SELECT w.{key}, w.place, w.first, r.n FROM steps w JOIN runs r ON w.{key} = r.{key} AND w.place = r.place
      WHERE w.pos = r.n + 1),
    packed AS (
      SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY place, b) - 1 AS chunk_id, text
      FROM (SELECT j.{key}, j.place, j.b, {_strip("array_to_string(r.parts[j.a:j.b], '')")} AS text
        FROM joined j JOIN runs r ON j.{key} = r.{key} AND j.place = r.place)
      WHERE text <> ''
      UNION ALL SELECT {key}, 0, '' FROM {source} WHERE {_blank('text')})"""


def _walk_recursive(ctes: str) -> str:
    return f"WITH RECURSIVE {ctes}"


CLEANED_DOCS = f"""{_ocr_ctes('documents', 'doc_id')},
    cleaned AS (SELECT doc_id, {_clean_basic('text')} AS text FROM ocr)"""


def _turns(blank_system: bool, cleaned: bool = False) -> str:
    text = "CASE WHEN role = 'system' THEN ' ' || chr(9) || chr(10) || ' ' ELSE text END" if blank_system else "text"
    text = _clean_basic("text") if cleaned else text
    return f"""turns AS (SELECT conv_id::VARCHAR AS source_file, (turn + 1)::INT AS page_num, {text} AS text
      FROM conversations),
    pieces AS (SELECT source_file, page_num,
      CASE WHEN {_blank('text')} THEN [''] ELSE {_windows('text', 500, 100)} END AS list FROM turns),
    chunks AS (
      SELECT source_file, page_num,
        (row_number() OVER (PARTITION BY source_file ORDER BY page_num, i) - 1)::INT AS chunk_id,
        list[i] AS text, length(list[i])::INT AS char_count
      FROM (SELECT *, unnest(range(1, len(list) + 1)) AS i FROM pieces))"""


# --- spans ----------------------------------------------------------------------------------


def _matches(pattern: str, entity: str, score: float, order: int) -> str:
    """Matches of a pattern with offsets, from the lengths of the pieces between them."""
    return f"""SELECT doc_id, {order} AS detector, i, place::INT AS start_at, (place + length(hits[i]))::INT AS end_at,
        {_q(entity)} AS entity, hits[i] AS text, {score}::DOUBLE AS score
      FROM (SELECT doc_id, hits, i,
          list_sum(list_transform(gaps[1:i], lambda g: length(g)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS place
        FROM (SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, {_q(pattern)}) AS hits,
                  string_split_regex(text, {_q(pattern)}) AS gaps FROM documents)))"""


def _spans(rules: list[tuple[str, str, float]]) -> str:
    found = " UNION ALL ".join(_matches(p, e, s, n) for n, (p, e, s) in enumerate(rules))
    # Kept spans are disjoint, so a new span only ever meets the last kept one.
    return f"""found AS ({found}),
    ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id
        ORDER BY start_at, end_at DESC, detector, i) AS n FROM found),
    merge AS (
      SELECT doc_id, n, start_at, end_at, entity, text, score, false AS closed,
        NULL::INT AS o_start, NULL::INT AS o_end, NULL::VARCHAR AS o_entity, NULL::VARCHAR AS o_text, NULL::DOUBLE AS o_score
      FROM ordered WHERE n = 1
      UNION ALL
      SELECT m.doc_id, o.n,
        CASE WHEN w THEN o.start_at ELSE m.start_at END, CASE WHEN w THEN o.end_at ELSE m.end_at END,
        CASE WHEN w THEN o.entity ELSE m.entity END, CASE WHEN w THEN o.text ELSE m.text END,
        CASE WHEN w THEN o.score ELSE m.score END, NOT meets,
        m.start_at, m.end_at, m.entity, m.text, m.score
      FROM merge m JOIN ordered o ON o.doc_id = m.doc_id AND o.n = m.n + 1,
        LATERAL (SELECT o.end_at <= m.end_at AS inside, o.start_at < m.end_at AS meets),
        LATERAL (SELECT CASE WHEN inside THEN o.score > m.score
          WHEN meets THEN o.end_at - o.start_at > m.end_at - m.start_at ELSE true END AS w)),
    kept AS (
      SELECT doc_id, o_start AS start_at, o_end AS end_at, o_entity AS entity, o_text AS text, o_score AS score
      FROM merge WHERE closed
      UNION ALL
      SELECT m.doc_id, start_at, end_at, entity, text, score FROM merge m
      JOIN (SELECT doc_id, max(n) AS n FROM ordered GROUP BY doc_id) l ON m.doc_id = l.doc_id AND m.n = l.n)"""


CONTACT = [(_EMAIL, "EMAIL_ADDRESS", 1.0), (_PHONE, "PHONE_NUMBER", 0.4)]
ENTITIES = [
    *CONTACT,
    (r"[A-Z][a-z]{4,}", "PERSON", 0.9),
    (r"[A-Z][a-z]+ [a-z]+", "ORGANIZATION", 0.65),
    (r"[0-9]{3,}", "QUANTITY", 0.7),
]
# Employee numbers need a letter and three characters; titles are ranks; other labels and low scores go.
LABELLED = _spans([*CONTACT, (r"[0-9]+[a-z]*", "사번", 0.8), (r"[A-Z][a-z]{5,}", "직급", 0.6)]).replace(
    "FROM found)",
    "FROM found WHERE NOT (entity = '사번' AND (regexp_matches(text, '^[0-9]+$') OR length(text) < 3)))",
)
SPAN_ROWS = "SELECT doc_id, start_at, end_at, entity, text FROM kept"
MASKED = f"""{_spans(CONTACT)},
    pieces AS (
      SELECT doc_id, start_at, entity,
        coalesce(lag(end_at) OVER (PARTITION BY doc_id ORDER BY start_at), 0) AS before, end_at FROM kept),
    masked AS (
      SELECT d.doc_id, CASE WHEN p.out IS NULL THEN d.text
          ELSE p.out || substring(d.text, p.last + 1) END AS text,
        p.out IS NOT NULL AS changes_made, coalesce(p.contact, false) AS contact
      FROM documents d LEFT JOIN (
        SELECT p.doc_id, true AS contact, max(end_at) AS last, string_agg(
          substring(d.text, before + 1, start_at - before) || '[' || entity || ']', '' ORDER BY start_at) AS out
        FROM pieces p JOIN documents d ON p.doc_id = d.doc_id GROUP BY p.doc_id) p
      ON d.doc_id = p.doc_id)"""

# --- vectors --------------------------------------------------------------------------------


def _vectors(source: str, key: str) -> str:
    """Signed word hashing of ``source(key, text)`` to ``hashed(key, v)``, 64 floats each."""
    hexa = "('0x' || substring(h, {}, 2))::INT"
    return f"""words_{source} AS (SELECT {key}, md5(unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS h
      FROM {source}),
    slots_{source} AS (SELECT {key}, {hexa.format(1)} % 64 AS slot,
        sum(CASE WHEN {hexa.format(3)} < 128 THEN 1 ELSE -1 END)::DOUBLE AS x FROM words_{source} GROUP BY ALL),
    norms_{source} AS (SELECT {key}, sqrt(sum(x * x)) AS norm FROM slots_{source} GROUP BY {key}),
    hashed_{source} AS (
      SELECT s.{key}, list(coalesce(CASE WHEN n.norm > 0 THEN t.x / n.norm END, 0)::FLOAT::DOUBLE ORDER BY d.slot) AS v
      FROM {source} s JOIN (SELECT unnest(range(0, 64)) AS slot) d ON true
      LEFT JOIN slots_{source} t ON t.{key} = s.{key} AND t.slot = d.slot
      LEFT JOIN norms_{source} n ON n.{key} = s.{key}
      GROUP BY s.{key})"""


def _nearest(index: str, questions: str, k: int) -> str:
    """``ranked(question_id, id, distance, rank)`` from ``index(id, v)``, ``questions(question_id, v)``."""
    return f"""pairs AS (SELECT q.question_id, e.id,
        list_sum(list_transform(list_zip(e.v, q.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
      FROM {index} e JOIN {questions} q ON true),
    ranked AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY question_id ORDER BY round(distance, 12), id) AS rank FROM pairs) WHERE rank <= {k})"""


CENTRES = """parts AS (SELECT {key} AS question_id, generate_subscripts(embedding, 1) AS pos,
        unnest(embedding)::DOUBLE AS x FROM embeddings),
    means AS (SELECT question_id, pos, avg(x) AS x FROM parts GROUP BY ALL),
    centres AS (SELECT question_id, list(x ORDER BY pos) AS v FROM means GROUP BY question_id),
    points AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"""
BY_LABEL, OVERALL = CENTRES.format(key="label"), CENTRES.format(key="0")

TURN_INDEX = f"""{_turns(False)},
    entries AS (SELECT source_file || '_' || chunk_id AS id, trim(text, {_q(WHITESPACE)}) AS text FROM chunks),
    items AS (SELECT item_id AS question_id, text FROM benchmark),
    {_vectors('entries', 'id')}, {_vectors('items', 'question_id')}"""


def _answers(k: int) -> str:
    return f"""WITH {TURN_INDEX}, {_nearest('hashed_entries', 'hashed_items', k)},
    context AS (SELECT r.question_id, count(*) AS sources, string_agg(e.text, {NL} || {NL} ORDER BY r.rank) AS context
      FROM ranked r JOIN entries e ON r.id = e.id GROUP BY r.question_id)
    SELECT question_id, true AS grade_passed, sources,
      {_sentences('context')}[1] AS answer FROM context"""


def _loaded(rows: str, method: str, suffix: str, prefix: str, key: str) -> str:
    return f"""WITH files AS ({rows}), {_ocr_ctes('files', key)}
    SELECT '{prefix}' || {key} || '{suffix}' AS source_file, '{suffix}' AS file_type, 1 AS page_num,
      text, '{method}' AS method, 'ok' AS status FROM ocr"""


_HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_BLOCK = (
    r"(?i)</?(?:html|head|title|body|header|footer|main|nav|section|article|aside|address|div|p|"
    r"h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tfoot|tr|td|th|caption|form|fieldset|blockquote|"
    r"pre|figure|figcaption|hr|br)\b[^>]*>"
)


def _elements(x: str) -> str:
    flat = _collapse(f"regexp_replace({x}, {_q(_HIDDEN)}, '', 'g')")
    text = f"regexp_replace(regexp_replace({flat}, {_q(_BLOCK)}, {NL}, 'g'), '<[^>]*>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = f"replace({text}, {_q(entity)}, {_q(char)})"
    return f"list_filter({_split(text)}, lambda e: length(e) > 0)"


_KINDS = f"""
    length(line) < 100 AND (regexp_matches(line, {_q(f'^[{chr(92)}p{{Nd}}가-힣]+[.)][{_SPACE}]*[가-힣]')})
      OR regexp_matches(line, '(?s)^\\[.+\\]$')) AS heading,
    contains(line, chr(9)) OR contains(line, '|') OR contains(line, '│') AS is_table,
    regexp_matches(line, {_q(f'^(?:[-*•]|{chr(92)}p{{Nd}}+[.)])[{_SPACE}]')}) AS is_list"""


def _lines(source: str, key: str) -> str:
    return f"""lines AS (SELECT {key}, (i - 1)::INT AS line, {_split('text')}[i] AS text FROM (
        SELECT {key}, text, unnest(range(1, len(string_split(text, {NL})) + 1)) AS i FROM {source}))"""


_MEMO_FIELDS = f"""
    CASE WHEN length(first) BETWEEN 1 AND 99 AND NOT regexp_matches(first, '[.。?!]$') THEN first END AS title,
    nullif(regexp_extract(text, {_q(f'{chr(92)}p{{Nd}}{{4}}[-년./][{_SPACE}]*{chr(92)}p{{Nd}}{{1,2}}[-월./][{_SPACE}]*{chr(92)}p{{Nd}}{{1,2}}')}), '') AS date,
    coalesce(nullif(regexp_extract(text, {_q(f'(소속|부서|팀)[{_SPACE}]*[:：]?[{_SPACE}]*([가-힣]+(?:팀|부|과|센터))')}, 2), ''),
      nullif(regexp_extract(text, '[가-힣]+(?:팀|부|과|센터)'), '')) AS department,
    nullif(trim(regexp_extract(text, {_q(f'(작성자|기안자|담당자)[{_SPACE}]*[:：]?[{_SPACE}]*([가-힣]{{2,4}})[{_SPACE}]*(팀원|대리|과장|차장|부장|이사)?')}, 2)
      || ' ' || regexp_extract(text, {_q(f'(작성자|기안자|담당자)[{_SPACE}]*[:：]?[{_SPACE}]*([가-힣]{{2,4}})[{_SPACE}]*(팀원|대리|과장|차장|부장|이사)?')}, 3)), '') AS author,
    CASE WHEN regexp_matches(head, '회의록|미팅|회의') THEN '회의록'
      WHEN regexp_matches(head, '요청서|신청서|의뢰서') THEN '요청서'
      WHEN regexp_matches(head, '보고서|결과 보고|진행 보고') THEN '보고서'
      WHEN regexp_matches(head, '계획서|기획서|제안서') THEN '계획서'
      WHEN regexp_matches(head, '승인|결재|기안') THEN '승인문서' END AS doc_type"""
MEMO_FACTS = f"""{MEMOS}, facts AS (SELECT memo_id, {_MEMO_FIELDS} FROM (
      SELECT memo_id, text, {_strip(f'string_split(text, {NL})[1]')} AS first, substring(text, 1, 200) AS head FROM memos))"""


def _valid(key: str, source: str) -> str:
    marks = r" \n\t.,!?\-()\[\]{}:;@#%&*+=/<>\x22\x27"
    return f"""SELECT {key}, length({_strip('text')}) >= 10 AND valid > 0 AND (valid / n::DOUBLE >= 0.5
        OR hangul / n::DOUBLE >= 0.05 OR hangul >= 3 OR (alnum >= 10 AND valid / n::DOUBLE >= 0.3)) AS valid
      FROM (SELECT {key}, text, length(text) AS n, {_count('text', _HANGUL)} AS hangul,
        {_count('text', r'\p{L}\p{N}')} AS alnum, {_count('text', _HANGUL + _LATIN + _DIGIT + marks)} AS valid
        FROM {source})"""


_TITLE = "string_split(text, chr(10))[1]"
# Words of a text, lower-cased, by runs of letters and digits.
_TERMS = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
_TERM_STATISTICS = f"""held AS (SELECT doc_id, term, count(*) AS times
      FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY doc_id, term),
    kept AS (SELECT term, count(*) AS documents FROM held GROUP BY term HAVING count(*) >= 2 ORDER BY documents DESC, term LIMIT 50000),
    statistics AS (SELECT term, documents, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (documents + 1)) + 1 AS idf FROM kept)"""
_GRAMS = """(SELECT *, unnest(list_transform(range(1, length(plain) - 1), lambda i: plain[i:i + 2])) AS gram
      FROM (SELECT doc_id, lang, lower(regexp_replace(' ' || text || ' ', '[\\s\\d]+', ' ', 'g')) AS plain FROM documents))"""
_LANGUAGES = f"""grams AS MATERIALIZED {_GRAMS},
    counts AS (SELECT lang, gram, count(*) AS n FROM grams WHERE doc_id % 3 <> 0 GROUP BY lang, gram),
    kept AS (SELECT gram FROM counts GROUP BY gram ORDER BY sum(n) DESC, gram LIMIT 4000),
    held AS (SELECT * FROM counts SEMI JOIN kept USING (gram)),
    sums AS (SELECT lang, sum(n) AS whole FROM held GROUP BY lang),
    model AS (SELECT gram, s.lang, floor(1000 * ln((coalesce(h.n, 0) + 1)::DOUBLE / (whole + (SELECT count(*) FROM kept))))::BIGINT AS score
      FROM kept CROSS JOIN sums s LEFT JOIN held h USING (gram, lang)),
    scores AS (SELECT doc_id, m.lang, sum(score)::BIGINT AS score FROM grams g JOIN model m ON g.gram = m.gram GROUP BY doc_id, m.lang)"""
_LETTERS = "regexp_extract_all({text}, '\\p{{L}}+')"
_WORDS = f"""texts AS (SELECT doc_id, {_LETTERS.format(text='text')} AS found, string_split_regex(text, '\\p{{L}}+') AS gaps FROM documents),
    words AS (SELECT doc_id, unnest(list_transform(range(1, len(found) + 1), lambda i: CASE
      WHEN gaps[i] LIKE '%[' AND gaps[i + 1] LIKE ']%' THEN NULL ELSE lower(found[i]) END)) AS word, unnest(range(1, len(found) + 1)) AS place
      FROM texts)"""

_FIXED = f"""WITH {CLEANED_DOCS},
        cut AS (SELECT doc_id, CASE WHEN {_blank('text')} THEN [''] ELSE {_windows('text', 500, 100)} END AS list FROM cleaned)
        SELECT doc_id, (i - 1)::INT AS chunk_id, length(list[i])::INT AS char_count, list[i] AS text
        FROM (SELECT *, unnest(range(1, len(list) + 1)) AS i FROM cut)"""

ORACLES: dict[str, str] = {
    "chunks_sql": _FIXED,
    "clean_basic": f"SELECT doc_id, {_clean_basic('text')} AS text FROM documents",
    "ocr_clean_text": f"WITH {_ocr_ctes('documents', 'doc_id')} SELECT doc_id, text FROM ocr",
    "ocr_line_rules": f"""WITH {_lines('documents', 'doc_id')}
        SELECT doc_id, line AS line_no, coalesce({_rule('text')}, 'kept') AS rule FROM lines""",
    "ocr_line_rules_hangul": f"""WITH {MEMOS}, {_lines('memos', 'memo_id')}
        SELECT memo_id, line AS line_no, coalesce({_rule('text')}, 'kept') AS rule FROM lines""",
    "ocr_rule_counts": f"""WITH {_lines('documents', 'doc_id')}
        SELECT coalesce({_rule('text')}, 'kept') AS rule, count(*) AS lines FROM lines GROUP BY 1""",
    "hangul_validity": f"WITH {MEMOS} {_valid('memo_id', 'memos')}",
    "validity": _valid("doc_id", "documents"),
    "preview": "SELECT doc_id, substring(text, 1, 100) || '...' AS preview FROM documents",
    "meta_title": f"""SELECT doc_id, CASE WHEN length(t) BETWEEN 1 AND 99
        AND NOT regexp_matches(t, '[.。?!]$') THEN t END AS title
        FROM (SELECT doc_id, {_strip(_TITLE)} AS t FROM documents)""",
    "meta_fields": f"WITH {MEMO_FACTS} SELECT * FROM facts",
    "doc_type": f"""WITH {MEMO_FACTS} SELECT coalesce(doc_type, 'none') AS doc_type, count(*) AS documents
        FROM facts GROUP BY 1""",
    "structure_lines": f"""WITH {MEMOS}, {_lines('memos', 'memo_id')},
        marked AS (SELECT memo_id, line, text, {_KINDS.replace('line', 'text')} FROM lines WHERE length(text) > 0)
        SELECT memo_id, line, 'heading' AS kind, text FROM marked WHERE heading
        UNION ALL SELECT memo_id, line, 'table', text FROM marked WHERE is_table
        UNION ALL SELECT memo_id, line, 'list', text FROM marked WHERE is_list""",
    "structure_summary": f"""WITH {_lines('documents', 'doc_id')},
        any_kind AS (SELECT doc_id, bool_or(heading) AS h, bool_or(is_list) AS l, bool_or(is_table) AS t
          FROM (SELECT doc_id, {_KINDS.replace('line', 'text')} FROM lines) GROUP BY doc_id)
        SELECT doc_id, h OR l OR t AS has_structure, nullif(concat_ws(',', CASE WHEN h THEN 'heading' END,
          CASE WHEN l THEN 'list' END, CASE WHEN t THEN 'table' END), '') AS types FROM any_kind""",
    "language_guess": f"""SELECT doc_id, CASE WHEN ko + ja = 0 AND en = 0 THEN 'ko'
          WHEN ko + ja = 0 AND other > english THEN 'ko'
          WHEN ko >= en AND ko >= ja THEN 'ko' WHEN en >= ja THEN 'en' ELSE 'ja' END AS language
        FROM (SELECT doc_id, {_count('text', _HANGUL)} AS ko, {_count('text', 'A-Za-z')} AS en,
            {_count('text', r'\x{3040}-\x{30ff}')} AS ja, {_among(_ENGLISH)} AS english, {_among(_OTHER_LATIN)} AS other
          FROM (SELECT doc_id, text, string_split_regex(lower(text), '[^\\p{{L}}]+') AS words FROM documents))""",
    "sentences": f"""SELECT doc_id, (i - 1)::INT AS pos, list[i] AS sentence FROM (
        SELECT doc_id, list, unnest(range(1, len(list) + 1)) AS i
        FROM (SELECT doc_id, {_sentences('text')} AS list FROM documents))""",
    "chunks_fixed": _FIXED,
    "chunks_semantic": f"""{_walk_recursive(CLEANED_DOCS)}, {_semantic_ctes('cleaned', 'doc_id')}
        SELECT doc_id, chunk_id::INT AS chunk_id, length(text)::INT AS char_count, text FROM merged""",
    "chunks_recursive": f"""{_walk_recursive(CLEANED_DOCS)}, {_recursive_ctes('cleaned', 'doc_id')}
        SELECT doc_id, chunk_id::INT AS chunk_id, length(text)::INT AS char_count, text FROM packed""",
    "chunk_numbering": f"""WITH {_turns(False)} SELECT source_file, page_num, chunk_id, char_count, text FROM chunks""",
    "chunk_facts": f"""{_walk_recursive(MEMO_FACTS)}, {_semantic_ctes('memos', 'memo_id')}, {_lines('memos', 'memo_id')},
        any_kind AS (SELECT memo_id, bool_or(heading) AS h, bool_or(is_list) AS l, bool_or(is_table) AS t
          FROM (SELECT memo_id, {_KINDS.replace('line', 'text')} FROM lines) GROUP BY memo_id)
        SELECT m.memo_id::VARCHAR AS source_file, m.chunk_id::INT AS chunk_id, 'ko' AS language, f.title,
          k.h OR k.l OR k.t AS has_structure, nullif(concat_ws(',', CASE WHEN h THEN 'heading' END,
          CASE WHEN l THEN 'list' END, CASE WHEN t THEN 'table' END), '') AS types
        FROM merged m JOIN facts f ON m.memo_id = f.memo_id JOIN any_kind k ON m.memo_id = k.memo_id""",
    "empty_placeholder": f"""WITH {_turns(True)} SELECT source_file, page_num, chunk_id, char_count,
        CASE WHEN char_count = 0 THEN 'no_text' END AS warning FROM chunks""",
    "pii_spans": f"WITH RECURSIVE {_spans(CONTACT)} {SPAN_ROWS}",
    "pii_merged": f"WITH RECURSIVE {_spans(ENTITIES)} {SPAN_ROWS}",
    "pii_labelled": f"WITH RECURSIVE {LABELLED} {SPAN_ROWS}",
    "pii_masked": f"""WITH RECURSIVE {MASKED} SELECT doc_id, text, changes_made,
        CASE WHEN contact THEN 'presidio' ELSE '' END AS methods FROM masked""",
    "pii_findings": f"""WITH RECURSIVE {_spans(ENTITIES)},
        numbered AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY doc_id, start_at) AS n FROM kept)
        SELECT entity AS type, count(*) AS count, round(avg(score), 3) AS avg_confidence,
          string_agg(text, ' | ' ORDER BY n) FILTER (WHERE n <= 5) AS examples, 'hybrid' AS method
        FROM numbered GROUP BY entity""",
    "pii_page_report": f"""WITH RECURSIVE {_spans(CONTACT)} SELECT doc_id::VARCHAR AS source_file, 1 AS page,
        count(*)::INT AS total_findings FROM kept GROUP BY doc_id""",
    "ner_label_map": """SELECT code, CASE code WHEN 'PS' THEN 'PERSON' WHEN 'lc' THEN 'LOCATION'
          WHEN 'Org' THEN 'ORGANIZATION' WHEN 'qt' THEN 'QUANTITY' ELSE code END AS entity, count(*) AS events
        FROM (SELECT CASE event_type WHEN 'view' THEN 'PS' WHEN 'click' THEN 'lc' WHEN 'error' THEN 'Org'
          WHEN 'purchase' THEN 'qt' ELSE event_type END AS code FROM events) GROUP BY code""",
    "mask_roundtrip": f"""WITH RECURSIVE {MASKED},
        cut AS (SELECT doc_id, string_split_regex(text, '\\[[A-Z가-힣_]+\\]') AS gaps FROM masked)
        SELECT doc_id, (len(gaps) - 1)::INT AS masks, true AS restored, array_to_string(list_transform(
          range(1, len(gaps) + 1), lambda i: gaps[i] || CASE WHEN i < len(gaps) THEN '<KEEP_' || (i - 1) || '>' ELSE '' END), '') AS protected
        FROM cut""",
    "normalized_chunks": f"""WITH {_turns(True)} SELECT source_file, chunk_id, char_count,
        CASE WHEN char_count > 0 THEN true END AS normalized,
        CASE WHEN char_count > 0 THEN char_count END AS original_length, NULL::VARCHAR AS normalization_error FROM chunks""",
    "normalization_totals": f"""WITH {_turns(True)} SELECT count(*) AS chunks, count_if(char_count > 0)::BIGINT AS succeeded,
        0::BIGINT AS failed, 0::BIGINT AS char_change FROM chunks""",
    "normalization_observed": f"""SELECT *, true AS timed FROM (WITH {_turns(True)} SELECT count(*) AS chunks, count_if(char_count > 0)::BIGINT AS succeeded,
        0::BIGINT AS failed, 0::BIGINT AS char_change FROM chunks)""",
    "document_outcomes": """SELECT CASE WHEN doc_id % 7 = 3 THEN 'unreadable' WHEN doc_id % 11 = 5 THEN 'no_chunks' ELSE 'read' END AS status,
          count(*) AS documents, count_if(doc_id % 7 <> 3 AND doc_id % 11 <> 5)::BIGINT AS chunks,
          count_if(doc_id % 7 <> 3)::BIGINT AS named, count_if(doc_id % 7 = 3)::BIGINT AS excerpts
        FROM documents GROUP BY status""",
    "index_lifecycle": f"""SELECT 'added' AS measure, count(*) AS entries FROM conversations
        UNION ALL SELECT 'blank', count_if(role = 'system' OR {_blank('text')})::BIGINT FROM conversations
        UNION ALL SELECT 'emptied', 0 UNION ALL SELECT 'again', count_if(role <> 'system')::BIGINT FROM conversations""",
    "model_windows": """WITH words AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\n]+'),
            lambda w: length(w) > 0) AS w FROM documents),
        cut AS (SELECT doc_id, w, unnest(range(0, greatest(ceil((len(w) - 448) / 384.0)::BIGINT, 0) + 1)) AS i
          FROM words WHERE len(w) > 0)
        SELECT doc_id, i::INT AS window_no, len(w[i * 384 + 1:i * 384 + 448])::INT AS tokens,
          array_to_string(w[i * 384 + 1:i * 384 + 448], ' ') AS text FROM cut""",
    "correction_batches": f"""WITH RECURSIVE texts AS MATERIALIZED (
        SELECT doc_id, list_transform(string_split_regex(text, {_q(_DELIMITER)}), lambda g: {_strip('g')}) AS gaps,
          regexp_extract_all(text, {_q(_DELIMITER)}) AS marks FROM documents),
      walk AS (
        SELECT doc_id, 0 AS pos, '' AS batch, NULL::VARCHAR AS flushed, NULL::VARCHAR AS mark FROM texts
        UNION ALL
        SELECT doc_id, pos + 1,
          CASE WHEN g = '' THEN batch WHEN batch = '' OR past THEN g ELSE batch || ' ' || g END,
          CASE WHEN g <> '' AND batch <> '' AND past THEN batch END, mark_here
        FROM (SELECT w.doc_id, w.pos, w.batch, t.gaps[w.pos + 1] AS g, t.marks[w.pos + 1] AS mark_here,
            length(w.batch) + length(t.gaps[w.pos + 1]) > 300 AS past
          FROM walk w JOIN texts t ON w.doc_id = t.doc_id WHERE w.pos < len(t.gaps))),
      parts AS (
        SELECT doc_id, pos, 0 AS k, flushed AS text, true AS correct FROM walk WHERE flushed IS NOT NULL
        UNION ALL SELECT doc_id, pos, 1, mark, false FROM walk WHERE mark IS NOT NULL
        UNION ALL SELECT w.doc_id, w.pos, 2, w.batch, true FROM walk w JOIN texts t ON w.doc_id = t.doc_id
          WHERE w.pos = len(t.gaps) AND w.batch <> '')
      SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos, k) - 1)::INT AS part_no, correct, text FROM parts""",
    "stored_chunks": f"""WITH {_turns(False, cleaned=True)}
      SELECT source_file, chunk_id, page_num, char_count, text FROM chunks""",
    "stored_vectors": f"""WITH {_turns(False, cleaned=True)}
      SELECT source_file, count(*) AS vectors, 64 AS dimension FROM chunks GROUP BY source_file""",
    "document_record": f"""WITH {_turns(True)} SELECT source_file, '.txt' AS file_type,
        count(DISTINCT page_num) AS total_pages, count(*) AS total_chunks, sum(char_count)::BIGINT AS total_characters,
        round_even(coalesce(sum(char_count) / nullif(count_if(char_count > 0), 0)::DOUBLE, 0), 2) AS average_chunk_size,
        'txt' AS methods_used FROM chunks GROUP BY source_file""",
    "document_parts": f"""WITH {_turns(False, cleaned=True)},
        sized AS (SELECT *, count(*) OVER (PARTITION BY source_file) AS total_chunks FROM chunks)
        SELECT source_file, (chunk_id // 3)::INT AS part, total_chunks, count(*)::INT AS chunks,
          string_agg(chunk_id, ',' ORDER BY chunk_id) AS ids, string_agg(text, {NL} ORDER BY chunk_id) AS text
        FROM sized GROUP BY ALL""",
    "run_summary": f"""WITH docs AS (SELECT 'd' || doc_id AS k, text FROM documents
          UNION ALL SELECT 'c' || c_custkey, 'customer nation segment' || {NL} || c_custkey || ' ' || c_nationkey || ' ' || c_mktsegment FROM customer),
        {_ocr_ctes('docs', 'k')},
        cut AS (SELECT unnest(CASE WHEN {_blank('text')} THEN [''] ELSE {_windows('text', 500, 100)} END) AS piece FROM ocr)
        SELECT (SELECT count(*) FROM docs) AS succeeded, (SELECT count(*) FROM customer) AS failed,
          count(*) AS total_chunks, sum(length(piece))::BIGINT AS total_characters FROM cut""",
    "file_routing": """SELECT suffix, CASE WHEN suffix IN ('.pdf', '.txt', '.docx', '.doc', '.pptx', '.ppt', '.xlsx',
          '.xls', '.csv', '.hwp', '.hwpx') THEN substring(suffix, 2) WHEN suffix IN ('.jpg', '.jpeg', '.png', '.bmp', '.tiff')
          THEN 'image' ELSE 'none' END AS loader, count(*) AS files
        FROM (SELECT '.' || (['pdf', 'txt', 'docx', 'doc', 'pptx', 'ppt', 'jpg', 'jpeg', 'png', 'bmp', 'tiff', 'xlsx', 'xls',
          'csv', 'hwp', 'hwpx', 'html', 'zip'])[o_orderkey % 18 + 1] AS suffix FROM orders) GROUP BY suffix""",
    "load_txt": _loaded(
        f"SELECT doc_id, replace(replace(text, chr(13) || {NL}, {NL}), chr(13), {NL}) AS text FROM documents",
        "txt", ".txt", "doc_", "doc_id"),
    "load_csv": _loaded(
        f"""SELECT c_custkey, 'customer nation segment' || {NL} || c_custkey || ' ' || c_nationkey || ' ' || c_mktsegment AS text
        FROM customer""", "csv", ".CSV", "c_", "c_custkey"),
    "load_office": f"""WITH sheets AS (
          SELECT doc_id || '.docx1' AS k, text || {NL} || '[표 데이터]' || {NL} || 'document | ' || doc_id AS text FROM documents WHERE lang = 'en'
          UNION ALL SELECT doc_id || '.pptx1', 'document ' || doc_id FROM documents WHERE lang = 'fr'
          UNION ALL SELECT doc_id || '.pptx2', text FROM documents WHERE lang = 'fr'
          UNION ALL SELECT doc_id || '.xlsx1', '[시트: index]' || {NL} || 'document | ' || doc_id FROM documents WHERE lang NOT IN ('en', 'fr')
          UNION ALL SELECT doc_id || '.xlsx2', '[시트: ' || lang || ']' || {NL} || text FROM documents WHERE lang NOT IN ('en', 'fr')),
        {_ocr_ctes('sheets', 'k')}
        SELECT 'doc_' || substring(k, 1, length(k) - 1) AS source_file, substring(k, length(k) - 5, 5) AS file_type,
          substring(k, length(k), 1)::INT AS page_num, text, substring(k, length(k) - 4, 4) AS method, 'ok' AS status FROM ocr""",
    "load_html": f"""WITH parsed AS (SELECT page_id, {_elements('html')} AS list FROM pages),
        joined AS (SELECT page_id, coalesce(array_to_string(list, {NL} || {NL}), '') AS text FROM parsed),
        {_ocr_ctes('joined', 'page_id')}
        SELECT p.page_id::VARCHAR AS source_file, 'unstructured_html' AS method, len(p.list)::INT AS elements_count, o.text
        FROM parsed p JOIN ocr o ON p.page_id = o.page_id""",
    "embed_chunks": f"""WITH {_turns(False)},
        entries AS (SELECT source_file || '_' || chunk_id AS id, source_file, chunk_id, text FROM chunks),
        {_vectors('entries', 'id')}
        SELECT source_file, chunk_id, (i - 1)::INT AS dim, round(v[i], 4) AS value FROM (
          SELECT e.source_file, e.chunk_id, h.v, unnest(range(1, 65)) AS i FROM entries e JOIN hashed_entries h ON e.id = h.id)
        WHERE round(v[i], 4) <> 0""",
    "zero_vectors": f"""WITH {_turns(True)} SELECT NOT regexp_matches(text, '[\\p{{L}}\\p{{N}}]') AS is_zero,
        64 AS embedding_dim, true AS has_embedding, count(*) AS chunks FROM chunks GROUP BY 1""",
    "embedding_summary": f"""WITH turns AS (SELECT conv_id || '-' || role AS source_file, role,
            CASE WHEN role = 'system' OR {_blank('text')} THEN [''] ELSE {_windows('text', 500, 100)} END AS list FROM conversations),
        docs AS (SELECT source_file, sum(len(list)) AS n, bool_or(role <> 'system') AS filled FROM turns GROUP BY 1)
        SELECT count_if(filled)::BIGINT AS succeeded, count_if(NOT filled)::BIGINT AS failed,
          coalesce(sum(n) FILTER (WHERE filled), 0)::BIGINT AS vectors FROM docs""",
    "index_upsert": f"""SELECT conv_id || '_' || turn AS id, turn::INT AS chunk_id, length(text)::INT AS char_count,
        CASE WHEN role = 'user' THEN {_strip("'old ' || text")} ELSE CASE WHEN {_blank('text')} THEN ' ' ELSE {_strip('text')} END END AS document
        FROM conversations""",
    "upload_summary": """WITH docs AS (SELECT role, conv_id, count(*) AS n FROM conversations GROUP BY ALL)
        SELECT 'paired' AS measure, count_if(role <> 'system')::BIGINT AS value FROM conversations
        UNION ALL SELECT 'in_index', count_if(role <> 'system')::BIGINT FROM conversations
        UNION ALL SELECT 'alone', count_if(role = 'system')::BIGINT FROM docs
        UNION ALL SELECT 'succeeded', count_if(role <> 'system')::BIGINT FROM docs
        UNION ALL SELECT 'failed', count_if(role = 'system')::BIGINT FROM docs
        UNION ALL SELECT 'uploaded', coalesce(sum(n) FILTER (WHERE role <> 'system'), 0)::BIGINT FROM docs""",
    "custom_metadata": """SELECT event_id, 'custom_' || key AS name, json_extract_string(props, '$."' || key || '"') AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""",
    "knn_single": f"""WITH {OVERALL}, {_nearest('points', 'centres', 5)}
        SELECT rank::INT AS rank, id, round(distance, 6) AS distance FROM ranked""",
    "knn_batch": f"""WITH {BY_LABEL}, {_nearest('points', 'centres', 5)}
        SELECT question_id, rank::INT AS rank, id, round(distance, 6) AS distance FROM ranked""",
    "ann_reranked": f"""WITH {BY_LABEL}, {_nearest('points', 'centres', 5)}
        SELECT question_id, rank::INT AS rank, id, round(distance, 6) AS distance FROM ranked""",
    "ann_recall": "SELECT 5 * count(*) AS wanted, true AS reached FROM embeddings WHERE vec_id % 20 = 0",
    "term_idf": f"WITH {_TERM_STATISTICS} SELECT term, documents, round(idf, 9) AS idf FROM statistics",
    "latent_fit": f"""WITH {_TERM_STATISTICS}
        SELECT count(DISTINCT doc_id) AS documents, count(DISTINCT term) AS terms, round(count(DISTINCT doc_id)::DOUBLE, 4) AS energy,
          true AS captured, 32::INT AS dimension FROM held SEMI JOIN statistics USING (term)""",
    "language_detected": f"""WITH {_LANGUAGES},
        placed AS (SELECT *, row_number() OVER w AS place, score - lead(score) OVER w AS margin FROM scores
          WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, lang))
        SELECT p.doc_id, p.lang AS guess, score, margin, p.doc_id % 3 = 0 AS held_out, p.lang = d.lang AS right
        FROM placed p JOIN documents d ON p.doc_id = d.doc_id WHERE place = 1""",
    "tagger_quality": f"""WITH {MEMO_FACTS}
        SELECT type, count(*) AS wanted, true AS reached FROM (
          SELECT 'DT' AS type FROM facts WHERE date IS NOT NULL UNION ALL SELECT 'OG' FROM facts WHERE department IS NOT NULL
          UNION ALL SELECT 'PS' FROM facts WHERE author IS NOT NULL) GROUP BY type""",
    "abbreviation_scores": """WITH w AS (SELECT unnest(regexp_extract_all(text, '\\p{L}+\\.?')) AS x FROM documents),
        counts AS (SELECT lower(rtrim(x, '.')) AS word, count_if(x LIKE '%.')::BIGINT AS with_stop, count_if(x NOT LIKE '%.')::BIGINT AS without
          FROM w GROUP BY 1),
        usual AS (SELECT sum(with_stop)::DOUBLE / sum(with_stop + without) AS p FROM counts),
        scored AS (SELECT word, with_stop, without,
          -2 * ((with_stop * ln(p) + without * ln(1 - p)) - (with_stop * ln(0.99::DOUBLE) + without * ln(1 - 0.99::DOUBLE)))
            * exp(-length(word)) * pow(length(word)::DOUBLE, -without) AS score FROM counts, usual WHERE with_stop > 0)
        SELECT word, with_stop, without, round(score, 6) AS score FROM scored WHERE score >= 0.3""",
    "word_pairs": f"""WITH {_WORDS},
        placed AS (SELECT word, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM words)
        SELECT before, word, count(*) AS n FROM placed WHERE before IS NOT NULL AND word IS NOT NULL GROUP BY before, word""",
    "spelling_neighbours": f"""WITH {_WORDS},
        counts AS (SELECT word, count(*) AS n FROM words WHERE word IS NOT NULL GROUP BY word),
        few AS (SELECT word, length(word) AS l FROM counts WHERE n <= 2 AND length(word) >= 4),
        often AS (SELECT word AS other, n, length(word) AS l FROM counts WHERE n >= 20 AND length(word) >= 3),
        f AS (SELECT *, unnest(range(1, l + 1)) AS i FROM few), o AS (SELECT *, unnest(range(1, l + 1)) AS i FROM often)
        SELECT f.word, o.other, o.n FROM f JOIN o ON f.i = o.i AND f.l = o.l AND f.word <> o.other
          AND substr(f.word, 1, f.i - 1) || substr(f.word, f.i + 1) = substr(o.other, 1, o.i - 1) || substr(o.other, o.i + 1)
        UNION SELECT f.word, g.other, g.n FROM f JOIN often g ON substr(f.word, 1, i - 1) || substr(f.word, i + 1) = g.other
        UNION SELECT g.word, o.other, o.n FROM o JOIN few g ON substr(o.other, 1, i - 1) || substr(o.other, i + 1) = g.word
        UNION SELECT f.word, g.other, g.n FROM f JOIN often g ON f.i < f.l AND f.word <> g.other
          AND substr(f.word, 1, i - 1) || f.word[i + 1] || f.word[i] || substr(f.word, i + 2) = g.other""",
    "grade_filter": f"""WITH {BY_LABEL}, {_nearest('points', 'centres', 5)},
        found AS (SELECT r.question_id, r.rank, r.id, p.label >= 3 AS good FROM ranked r JOIN points p ON r.id = p.id)
        SELECT question_id, bool_or(good) AS grade_passed,
          CASE WHEN bool_or(good) THEN count_if(good) ELSE count(*) END::INT AS sources,
          CASE WHEN bool_or(good) THEN string_agg(id, ',' ORDER BY rank) FILTER (WHERE good) ELSE string_agg(id, ',' ORDER BY rank) END AS ids,
          CASE WHEN bool_or(good) THEN string_agg('vector ' || id, {NL} || {NL} ORDER BY rank) FILTER (WHERE good)
            ELSE string_agg(' ', {NL} || {NL} ORDER BY rank) END AS context
        FROM found GROUP BY question_id""",
    "context_assembly": f"""WITH {TURN_INDEX}, {_nearest('hashed_entries', 'hashed_items', 5)}
        SELECT r.question_id, string_agg(r.id, ',' ORDER BY r.rank) AS ids,
          string_agg(e.text, {NL} || {NL} ORDER BY r.rank) AS context
        FROM ranked r JOIN entries e ON r.id = e.id GROUP BY r.question_id""",
    "answer_graded": _answers(5),
    "answer_simple": _answers(3),
    "answer_ranked": "SELECT item_id AS question_id, 5::INT AS sources, true AS cites FROM benchmark",
    "answer_refused": f"""WITH {TURN_INDEX}, {_nearest('hashed_entries', 'hashed_items', 1)},
      found AS (SELECT r.question_id, q.text AS question,
          CASE WHEN split_part(r.id, '_', -1)::INT % 2 = 0 THEN ' ' ELSE e.text END AS context
        FROM ranked r JOIN entries e ON r.id = e.id JOIN benchmark q ON q.item_id = r.question_id)
      SELECT question_id, NOT {_blank('context')} AS grade_passed, 1 AS sources,
        CASE WHEN {_blank('context')} THEN 'I don''t have enough information to answer this question.'
          ELSE {_sentences('context')}[1] END AS answer,
        'Use only the context below to answer the question, clearly and briefly.' || {NL}
          || 'If the context does not hold the answer, reply "I don''t have enough information to answer this question."'
          || {NL} || 'Write the answer in Korean.' || {NL} || {NL} || 'Context:' || {NL} || context || {NL} || {NL}
          || 'Question: ' || question || {NL} || {NL} || 'Answer:' AS prompt FROM found""",
    "retrieve_documents": f"""{_walk_recursive(CLEANED_DOCS)}, {_semantic_ctes('cleaned', 'doc_id')},
        entries AS (SELECT doc_id || '_' || chunk_id AS id, CASE WHEN {_blank('text')} THEN ' ' ELSE {_strip('text')} END AS text FROM merged),
        items AS (SELECT item_id AS question_id, text FROM benchmark),
        {_vectors('entries', 'id')}, {_vectors('items', 'question_id')}, {_nearest('hashed_entries', 'hashed_items', 3)}
        SELECT r.question_id, r.rank::INT AS rank, r.id, round(r.distance, 5) AS distance,
          substring(e.text, 1, 100) || '...' AS preview FROM ranked r JOIN entries e ON r.id = e.id""",
}
