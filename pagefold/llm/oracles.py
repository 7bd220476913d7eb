"""The same results in DuckDB SQL, for the operators that SQL can express."""

MIXING = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[rank % 3 + 1] AS weight FROM totals
), filling AS (
  SELECT *, sum(2.0 * source_size) OVER f - 2.0 * source_size AS held, sum(weight) OVER g AS rest,
    (SELECT sum(source_size) FROM totals) AS whole
  FROM weighted
  WINDOW f AS (ORDER BY source_size / weight, rank ROWS UNBOUNDED PRECEDING),
    g AS (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT held, rest, whole FROM filling
  WHERE weight * (1.5 * whole - held) / rest <= 2.0 * source_size
  ORDER BY source_size / weight, rank LIMIT 1
), targets AS (
  SELECT source, source_size,
    least(2.0 * source_size, weight * (1.5::DOUBLE * whole - held)::DOUBLE / rest) AS target
  FROM weighted, level
), units AS (
  SELECT source, size, doc_id, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS place FROM sized
), rated AS (
  SELECT u.*, t.source_size, t.target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix' || coalesce(u.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
  ((floor(rate * (place + 1) + shift) - floor(rate * place + shift)) * size)::BIGINT AS taken
FROM rated
"""

# Masks, window and agreement as the operator states them; list positions count from 1.
_MASKS = ("110011101", "110100111")


def _seed(words: str, at: str) -> str:
    """Per mask the selected words, as one list of two strings."""
    keys = [
        " || chr(31) || ".join(f"{words}[{at} + {i + 1}]" for i, c in enumerate(mask) if c == "1") for mask in _MASKS
    ]
    return "[" + ", ".join(f"'{n}' || chr(31) || {key}" for n, key in enumerate(keys)) + "]"


_SAME = (
    "list_transform(range(-4, 13), lambda o: CASE WHEN p + o >= 0 AND q + o >= 0 "
    "AND words[p + o + 1] = tokens[q + o + 1] THEN 1 ELSE 0 END)"
)
_BEST = f"list_max(list_transform(range(1, 6), lambda n: list_sum(({_SAME})[n:n + 12])))"
DECONTAMINATION = f"""
WITH items AS (
  SELECT min(item_id) AS item_id, tokens FROM (
    SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS tokens
    FROM benchmark) GROUP BY tokens HAVING len(tokens) >= 9
), seeds AS (
  SELECT item_id, tokens, q, unnest({_seed('tokens', 'q')}) AS seed
  FROM (SELECT item_id, tokens, unnest(range(0, len(tokens) - 8)) AS q FROM items)
), texts AS (
  SELECT row_number() OVER () AS n, doc_id, text,
    string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') AS words FROM documents
), places AS (
  SELECT n, p, unnest({_seed('words', 'p')}) AS seed
  FROM (SELECT n, words, unnest(range(0, len(words) - 8)) AS p FROM texts WHERE len(words) >= 9)
), hits AS (
  SELECT doc_id, text, item_id, p, {_BEST} AS agreed
  FROM (SELECT p.n, p.p, s.item_id, s.tokens, s.q FROM places p JOIN seeds s ON p.seed = s.seed) h JOIN texts t ON h.n = t.n
)
SELECT doc_id, item_id, count(*) AS n_hits, max(agreed)::BIGINT AS agreed, min(p)::BIGINT AS first_word,
  (max(p) + 8)::BIGINT AS last_word
FROM hits WHERE agreed >= 11 GROUP BY doc_id, text, item_id
"""

SUBSTRINGS = """
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT n, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT n, w, unnest(range(1, len(w) - 33)) AS i FROM texts WHERE len(w) >= 35)
), repeated AS (
  SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY h) AS times FROM windows) WHERE times > 1
), gone AS (
  SELECT DISTINCT n, i + k AS j FROM repeated, (SELECT unnest(range(0, 35)) AS k)
), words AS (
  SELECT n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM texts
), kept AS (
  SELECT n, string_agg(x, ' ' ORDER BY j) AS s, count(*) AS held FROM words ANTI JOIN gone USING (n, j) GROUP BY n
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(held, 0))::BIGINT AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (n)
"""

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The checksum's table from its rule, and the checksum of a string's UTF-8 bytes.
_CRC_TABLE = (
    "SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), "
    "lambda x, k: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tab"
)


def _crc32(text: str) -> str:
    code = f"hex(encode({text}))"
    bytes_ = f"list_transform(range(1, len({code}) // 2 + 1), lambda k: ('0x' || substr({code}, 2 * k - 1, 2))::BIGINT)"
    step = "lambda x, d: xor(x >> 8, tab[(xor(x, d) & 255) + 1])"
    return f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), {step}))"


SPELLING = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_FOLD}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY doc_id, run
), marked AS (
  SELECT run, times, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc
), words AS (
  SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM marked
), vocabulary AS (
  SELECT word, sum(times)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary
), holes AS (
  SELECT word, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS short
  FROM places
), near AS (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT h.word, v.word FROM holes h JOIN vocabulary v ON h.short = v.word
  UNION SELECT v.word, h.word FROM holes h JOIN vocabulary v ON h.short = v.word
), best AS (
  SELECT n.word, n.other, o.n AS other_n, count(*) OVER (PARTITION BY n.word) AS n_near,
    row_number() OVER (PARTITION BY n.word ORDER BY o.n DESC, n.other) AS place
  FROM near n JOIN vocabulary o ON n.other = o.word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END::BIGINT AS form_n
  FROM vocabulary v LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON v.word = b.word
), followed AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT f.word, g.form, steps + 1 FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, steps) AS root FROM followed GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN roots r ON f.word = r.word
"""

_RUNS = "list_filter(string_split_regex({text}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')".format(text=_FOLD)
RESAMPLING = f"""
WITH crc AS ({_CRC_TABLE}), texts AS (
  SELECT row_number() OVER () AS r, true AS raw, doc_id, {_RUNS} AS w FROM documents
  UNION ALL SELECT -row_number() OVER (), false, NULL, {_RUNS} FROM benchmark
), words AS (
  SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM texts
), runs AS (
  SELECT r, x, x || ' ' || lead(x) OVER p AS y, x || ' ' || lead(x) OVER p || ' ' || lead(x, 2) OVER p AS z
  FROM words WINDOW p AS (PARTITION BY r ORDER BY i)
), found AS (
  SELECT r, f, count(*) AS times FROM (
    SELECT r, x AS f FROM runs UNION ALL SELECT r, y FROM runs WHERE y IS NOT NULL UNION ALL SELECT r, z FROM runs WHERE z IS NOT NULL
  ) GROUP BY r, f
), buckets AS (
  SELECT f, {_crc32('f')} % 10000 AS bucket FROM (SELECT DISTINCT f FROM found), crc
), features AS (
  SELECT r, bucket, sum(times)::BIGINT AS times FROM found JOIN buckets USING (f) GROUP BY r, bucket
), sums AS (
  SELECT bucket, coalesce(sum(times) FILTER (r > 0), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (r < 0), 0)::DOUBLE AS t
  FROM features GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain
  FROM sums
), weights AS (
  SELECT r, sum(times)::BIGINT AS n_features, sum(times * gain)::BIGINT AS weight FROM features JOIN gains USING (bucket) GROUP BY r
), scores AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r) WHERE raw
), placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place,
    count(*) FILTER (n_words >= 20) OVER () AS able
  FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank FROM placed
"""

LLM_ORACLES = {
    "op1_mixing": MIXING,
    "op5_decontamination": DECONTAMINATION,
    "op7_substring": SUBSTRINGS,
    "op11_spelling_variants": SPELLING,
    "op12_resampling": RESAMPLING,
}
