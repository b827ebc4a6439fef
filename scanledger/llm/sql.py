"""The results of the corpus operators in DuckDB's SQL, for those that SQL can express."""

from __future__ import annotations

from scanledger.llm.mixing import EVENNESS, SEED
from scanledger.llm.secret_scan import (
    ASSIGN_CHARS, ENCODINGS, FALSE_SHARE, LEAST_WEIGHT, MOST_POWER, MOST_WEIGHT, STEPS, TOKEN_CHARS, USUAL,
)
from scanledger.llm.spelling import DAMAGE_EVERY, FORM_RATIO, MIN_CHARS, MIN_COUNT
from scanledger.llm.url_rules import ALLOWED_HOST_WORDS, BLOCKED_HOST_WORDS

EXACT_DEDUP = """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM hashed WINDOW same AS (PARTITION BY body)
"""

LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, row, unnest(string_split(body, chr(10))) AS line,
         generate_subscripts(string_split(body, chr(10)), 1) AS place
  FROM (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS body FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
repeated AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT row) >= 3)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                         FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (line_key) GROUP BY row
"""

SOURCE_MIXING = f"""
WITH RECURSIVE sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::BIGINT AS chars FROM documents GROUP BY source),
aimed AS (SELECT *, pow(chars::DOUBLE, {EVENNESS}) AS weight FROM sizes),
rates AS (
  SELECT source, CASE WHEN chars = 0 THEN 1.0
    ELSE weight / (SELECT sum(weight) FROM aimed) * (SELECT sum(chars) FROM aimed)::DOUBLE / chars END AS rate
  FROM aimed),
bounds(source, rate, k, p, cdf) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM bounds
  WHERE k < ceil(rate + 10 * sqrt(rate) + 25)),
drawn AS (
  SELECT *, ('0x' || substr(md5('{SEED}|1|' || coalesce(doc_id::VARCHAR, 'null|' || md5(coalesce(text, '')))), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE AS number
  FROM documents),
listed AS (SELECT source, list(cdf) AS sums FROM bounds GROUP BY source),
counted AS (
  SELECT d.*, len(list_filter(sums, lambda x: x <= number))::INTEGER AS times
  FROM drawn d JOIN listed r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, text, lang, source, n_chars, unnest(generate_series(1, times))::INTEGER AS copy
FROM counted WHERE times > 0
"""


def _word_test(words: tuple[str, ...]) -> str:
    joined = "|".join(w.replace("-", "[-]") for w in words)
    return f"regexp_matches(host || '/', '^(.*[.-])?({joined})([.-].*)?/')"


URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
targets AS (SELECT DISTINCT host, path FROM parsed),
best AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(rule_verdict, length(rule)) AS rule_verdict
  FROM targets JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule,
       CASE WHEN rule IS NOT NULL THEN rule_verdict
            WHEN {_word_test(BLOCKED_HOST_WORDS)} AND NOT {_word_test(ALLOWED_HOST_WORDS)} THEN 'block'
            ELSE 'allow' END AS verdict
FROM parsed p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
""".replace("host || '/'", "p.host || '/'")

# The checksum goes byte by byte over a table made by its rule.
_CRC_STEPS = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""
_CRC_OF_NAME = """xor(list_reduce(list_concat([4294967295], list_transform(range(len(name) // 2),
      lambda k: ('0x' || substr(name, 2 * k + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295)"""

# Near words meet at what deletions leave of them.
SPELLING = f"""
WITH RECURSIVE {_CRC_STEPS},
runs AS (
  SELECT doc_id, translate(found, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')) AS found FROM documents)
  GROUP BY ALL),
named AS (SELECT run, n, hex(encode(concat(coalesce(doc_id::VARCHAR, 'null'), ':', run))) AS name FROM runs),
hashed AS (
  SELECT run, n, {_CRC_OF_NAME} AS h FROM named, crc),
damaged AS (
  SELECT n, CASE WHEN h % {DAMAGE_EVERY} = 0
    THEN concat(left(run, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {MIN_CHARS}
  GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
deleted AS (
  SELECT word, place, concat(left(word, place), substr(word, place + 2)) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS place FROM words)),
pairs AS (
  SELECT DISTINCT w.word AS one, d.word AS two FROM words w JOIN deleted d ON d.rest = w.word
  UNION ALL
  SELECT a.word, b.word FROM deleted a JOIN deleted b ON a.rest = b.rest AND a.place = b.place AND a.word < b.word),
near AS (SELECT one AS word, two AS other FROM pairs UNION ALL SELECT two, one FROM pairs),
ranked AS (
  SELECT r.word, r.other, o.n AS other_n, w.n, count(*) OVER (PARTITION BY r.word) AS n_near,
         row_number() OVER (PARTITION BY r.word ORDER BY o.n DESC, encode(r.other)) AS place
  FROM near r JOIN words o ON o.word = r.other JOIN words w ON w.word = r.word),
best AS (
  SELECT word, n_near, CASE WHEN other_n >= {FORM_RATIO} * n THEN other END AS form,
         CASE WHEN other_n >= {FORM_RATIO} * n THEN other_n END AS form_n
  FROM ranked WHERE place = 1),
chain(word, root, step) AS (
  SELECT word, word, 0 FROM words
  UNION ALL
  SELECT c.word, b.form, step + 1 FROM chain c JOIN best b ON b.word = c.root WHERE b.form IS NOT NULL),
last_step AS (SELECT word, max_by(root, step) AS root FROM chain GROUP BY word)
SELECT w.word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM words w JOIN last_step USING (word) LEFT JOIN best USING (word)
"""

_WHITE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_NEVER = 1_000_000_000


def _after(state: str, cost: int | str, edits: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'e': concat({state}.e, '{edits}')}}"


def _cheapest(*entries: str) -> str:
    return f"list_sort([{', '.join(entries)}])[1]"


def _inserted(s0: str, s1: str, s2: str, s3: str) -> tuple[str, str]:
    """The states after a user and after an assistant row, with insertions so far."""
    user = _cheapest(s2, *(_after(s, 2, "I") for s in (s0, s1, s3)))
    assistant = _cheapest(s3, _after(s2, 2, "I"), *(_after(s, 4, "II") for s in (s0, s1)))
    return user, assistant


def _moved(kind: str, *states: str) -> list[str]:
    """Keep or rerole a row as one of a kind; not if it has to go."""
    barred = f"CASE WHEN symbol = '-' THEN {_NEVER} ELSE 0 END"
    other = f"CASE WHEN lower(symbol) = '{kind}' THEN 0 ELSE {_NEVER} END"
    late = "CASE WHEN symbol IN ('S', 'U', 'A', 'O') THEN 1 ELSE 0 END"
    keeps = [_after(s, f"{other} + {late}", "K") for s in states]
    return keeps + ([] if kind == "s" else [_after(s, f"2 + {barred} + {late}", "R") for s in states])


_USER_IN, _ASSISTANT_IN = _inserted("s0", "s1", "s2", "s3")

# The program goes row by row; what is kept of a state is its least cost and string.
CONVERSATION_REPAIR = f"""
WITH RECURSIVE {_CRC_STEPS},
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         hex(encode(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')))) AS name
  FROM conversations),
ways AS (SELECT *, {_CRC_OF_NAME} % 20 AS way FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN way = 1 THEN '' WHEN way = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN way = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM ways WHERE way <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place,
         rtrim(text, {_WHITE}) AS bare
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS kind
  FROM placed),
symbols AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN '-' WHEN fault = 'truncated' THEN upper(kind) ELSE kind END
      AS symbol,
    lag(kind) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM faulty),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND concat(before, kind) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM symbols GROUP BY conv_id),
states(conv_id, place, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0, 'e': ''}}, {{'c': {_NEVER}, 'e': ''}}, {{'c': {_NEVER}, 'e': ''}},
         {{'c': {_NEVER}, 'e': ''}} FROM counted
  UNION ALL
  SELECT conv_id, place + 1, {_after("s0", 3, "D")},
    {_cheapest(_after("s1", 3, "D"), *_moved("s", "s0"))},
    {_cheapest(_after("i2", 3, "D"), *_moved("u", "s0", "s1", "i3"))},
    {_cheapest(_after("i3", 3, "D"), *_moved("a", "i2"))}
  FROM (SELECT t.conv_id, t.place, symbol, s0, s1, {_USER_IN} AS i2, {_ASSISTANT_IN} AS i3
        FROM states t JOIN symbols y ON y.conv_id IS NOT DISTINCT FROM t.conv_id AND y.place = t.place + 1)),
ends AS (
  SELECT conv_id, {_cheapest("s0", _ASSISTANT_IN)} AS best
  FROM states QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1),
edits AS (
  SELECT conv_id, step, edit, count(*) FILTER (edit <> 'I') OVER earlier AS place,
         count(*) FILTER (edit <> 'D') OVER earlier AS row_no
  FROM (SELECT conv_id, unnest(string_split(best.e, '')) AS edit, generate_subscripts(string_split(best.e, ''), 1) AS step
        FROM ends WHERE best.e <> '')
  WINDOW earlier AS (PARTITION BY conv_id ORDER BY step ROWS UNBOUNDED PRECEDING)),
kept AS (
  SELECT e.conv_id, step, edit, row_no, y.role, CASE WHEN edit = 'I' THEN '' ELSE y.text END AS text,
         max(CASE WHEN row_no = 1 AND edit = 'K' AND left(y.role, 1) = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY e.conv_id) AS with_system
  FROM edits e LEFT JOIN symbols y ON y.conv_id IS NOT DISTINCT FROM e.conv_id AND y.place = e.place
  WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(concat(CASE WHEN edit = 'K' THEN role WHEN (row_no - with_system) % 2 = 1 THEN 'user'
      ELSE 'assistant' END, ':', text), chr(10) ORDER BY step) AS body
  FROM kept GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.e, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = f"({_NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_KINDS = {
    "assign": _ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}",
    "random": f"[A-Za-z0-9+/_-]{{{TOKEN_CHARS},}}",
}


def _pieces(kind: str, source: str = "texts") -> str:
    """The text in pieces, each second of which is a match, with the code points before it."""
    marked = f"regexp_replace(body, '{_KINDS[kind]}', concat(chr(1), '\\0', chr(1)), 'g')"
    return f"""
  SELECT row, piece, part, part % 2 = 0 AS matched,
    coalesce(sum(length(piece)) OVER (PARTITION BY row ORDER BY part
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM (SELECT row, unnest(string_split({marked}, chr(1))) AS piece,
          generate_subscripts(string_split({marked}, chr(1)), 1) AS part FROM {source})"""


_SYMBOLS = "CASE " + " ".join(
    f"WHEN regexp_full_match(piece, '{e.pattern}') THEN '{e.symbols}'" for e in ENCODINGS
) + " END"


def _tail(z: str) -> str:
    t = f"(1 / (1 + 0.2316419 * least(abs({z}), 12)))"
    series = "0"
    for factor in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        series = f"(({series} + {factor}::DOUBLE) * {t})"
    return f"least(1, 2 / sqrt(2 * pi()) * exp(-least(abs({z}), 12) * least(abs({z}), 12) / 2) * {series})"


SECRET_SCAN = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS body FROM documents),
assign_pieces AS ({_pieces("assign")}),
assigned AS (
  SELECT *, matched AND length(regexp_extract(piece, '{_KINDS["assign"]}', 2)) >= {ASSIGN_CHARS} AS found
  FROM assign_pieces),
access_pieces AS ({_pieces("access")}),
hex_pieces AS ({_pieces("hex")}),
blanked AS (
  SELECT row, string_agg(CASE WHEN found THEN repeat(' ', length(piece)) ELSE piece END, '' ORDER BY part) AS body
  FROM assigned GROUP BY row),
token_pieces AS ({_pieces("random", "blanked")}),
tokens AS (
  SELECT *, length(symbols)::DOUBLE AS k, length(piece)::DOUBLE AS n
  FROM (SELECT *, {_SYMBOLS} AS symbols FROM token_pieces
    WHERE matched AND regexp_matches(piece, '[0-9]') AND regexp_matches(piece, '[A-Za-z]')
      AND NOT regexp_matches(piece, '{_KINDS["hex"]}|{_KINDS["access"]}'))
  WHERE symbols IS NOT NULL),
measured AS (
  SELECT *, list_sum(list_transform(string_split(symbols, ''),
      lambda s: pow(length(piece) - length(replace(piece, s, '')), 2)))::DOUBLE AS squares,
    list_transform(string_split(piece, ''), lambda c: strpos(symbols, c) - 1 - (k - 1) / 2) AS places
  FROM tokens),
tested AS (
  SELECT *, (pow(greatest(0, 1 + (k / n * squares - n - (k - 1)) / (k - 1) / sqrt((n - 1) / n)), 1.0::DOUBLE / 3)
      - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))) AS z1,
    (len(list_filter(range(1, len(places)), lambda i: (places[i] < 0) <> (places[i + 1] < 0))) - (n - 1) / 2)
      / sqrt((n - 1) / 4) AS z2,
    list_sum(list_transform(range(1, len(places)), lambda i: places[i] * places[i + 1])) / sqrt(n - 1)
      / ((k * k - 1) / 12) AS z3
  FROM measured),
weighted AS (
  SELECT *, greatest({LEAST_WEIGHT}, least({MOST_WEIGHT}, {USUAL} / n)) AS weight,
    least(1, 3 * least({_tail("z1")}, {_tail("z2")}, {_tail("z3")})) AS p
  FROM tested),
scored AS (
  SELECT *, least({STEPS * MOST_POWER}, floor(-log10(greatest(p, 1e-{2 * MOST_POWER}) / weight) * {STEPS}))::INTEGER
      AS evidence
  FROM weighted),
levels AS (
  SELECT evidence, sum(count(*)) OVER (ORDER BY evidence DESC) AS reached,
    sum(count(*)) OVER () AS tokens, sum(sum(weight)) OVER () AS weights
  FROM scored GROUP BY evidence),
bound AS (
  SELECT min(evidence) AS least FROM levels
  WHERE pow(10::DOUBLE, -evidence / {STEPS}::DOUBLE) * weights <= {FALSE_SHARE} * reached),
spans AS (
  SELECT row, start, 0 AS rank, 'assign' AS kind, piece FROM assigned WHERE found
  UNION ALL SELECT row, start, 1, 'access', piece FROM access_pieces WHERE matched
  UNION ALL SELECT row, start, 2, 'hex', piece FROM hex_pieces WHERE matched
  UNION ALL SELECT row, start, 3, 'random', piece FROM scored, bound WHERE least IS NULL OR evidence < least),
listed AS (
  SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    string_agg(concat(kind, ':', start, ':', start + length(piece)), ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(concat(kind, ':', start, ':', start + length(piece)), ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row)
"""
