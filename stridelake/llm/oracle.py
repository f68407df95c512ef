"""SQL of the queries that SQL can express, for an engine with list functions and recursive queries."""

from __future__ import annotations

from stridelake.llm import secret_scan

#: CRC-32 of a list of byte values, bit by bit.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || {0}, lambda c, b: xor(c >> 8,
      list_reduce([xor(c, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))), 4294967295::BIGINT)"""


def _bytes(text: str) -> str:
    """Code points of an ASCII string."""
    return f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def secrets() -> str:
    assign = f"({_either_case('password|passwd|secret|token|api_?key')})" + r"""[""'']?\x20*[:=]\x20*[""'']?([A-Za-z0-9+/_.=-]+)""".replace('""', '"')
    patterns = [assign, secret_scan.ACCESS, "[0-9a-f]{%d,}" % secret_scan.HEX_LEAST, secret_scan.GITHUB, secret_scan.NPM, secret_scan.AGE]
    kinds = ", ".join(f"({i}, '{kind}', '{pattern}')" for i, (kind, pattern) in enumerate(zip(secret_scan.KINDS, patterns)))
    name = "age-secret-key-"
    head = [ord(c) >> 5 for c in name] + [0] + [ord(c) & 31 for c in name]
    steps = ["((c & 33554431) << 5)", "v", *[f"((c >> {25 + i}) & 1) * {g}" for i, g in enumerate(secret_scan.BECH32_STEPS)]]
    polymod = steps[0]
    for part in steps[1:]:
        polymod = f"xor({polymod}, {part})"
    digits = f"list_transform(string_split(lower(right(m, 58)), ''), lambda x: strpos('{secret_scan.BECH32}', x)::BIGINT - 1)"
    own = _CRC32.format(_bytes("substring(m, length(m) - 35, 30)"))
    base62 = f"array_to_string(list_transform(range(6), lambda i: substring('{secret_scan.BASE62}', ((crc // (62 ** (5 - i))::BIGINT) % 62)::INT + 1, 1)), '')"
    shown = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in secret_scan.KINDS)
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), chr(57344) || chr(57345), '??') AS text FROM documents),
kinds(k, kind, pattern) AS (VALUES {kinds}),
parts AS (
  SELECT r, k, kind, pattern, string_split(regexp_replace(text, pattern, chr(57344) || '\\0' || chr(57345), 'g'), chr(57344)) AS p FROM texts, kinds),
found AS (
  SELECT r, k, kind, pattern, substring(p[j], 1, strpos(p[j], chr(57345)) - 1) AS m,
    (length(p[1]) + coalesce(list_sum(list_transform(p[2:j - 1], lambda x: length(x) - 1)), 0))::BIGINT AS s
  FROM (SELECT *, unnest(range(2, len(p) + 1)) AS j FROM parts)),
checked AS (SELECT *, s + length(m) AS e, CASE WHEN k IN (3, 4) THEN {own} END AS crc FROM found),
good AS (
  SELECT r, k, kind, s, e FROM checked WHERE CASE k
    WHEN 0 THEN length(regexp_extract(m, pattern, 2)) >= {secret_scan.ASSIGN_LEAST}
    WHEN 1 THEN length(m) >= {secret_scan.ACCESS_LEAST}
    WHEN 2 THEN true
    WHEN 5 THEN list_reduce([1::BIGINT] || {head}::BIGINT[] || {digits}, lambda c, v: {polymod}) = 1
    ELSE right(m, 6) = {base62} END),
sums AS (SELECT r, {counts}, {shown} FILTER (WHERE k < 3) AS base, {shown} AS spans FROM good GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in secret_scan.KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN sums USING (r)"""


def repair() -> str:
    harm = _CRC32.format(_bytes("word"))
    return f"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS word
  FROM conversations),
harmed AS (SELECT *, {harm} % 20 AS harm FROM numbered),
kept AS (
  SELECT c, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM harmed WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS first,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM kept),
marked AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(first) OVER (PARTITION BY c ORDER BY i) || first AS step
  FROM placed),
inserts(place, k, spot, added) AS (VALUES
  (0, 0, 0, []::VARCHAR[]), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
  (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
  (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
  (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])),
edits(letter, spot, first, after, role, price) AS (VALUES
  ('D', 0, NULL, 0, NULL, 2), ('D', 1, NULL, 1, NULL, 2), ('D', 2, NULL, 2, NULL, 2), ('D', 3, NULL, 3, NULL, 2),
  ('K', 0, 's', 1, NULL, 0), ('K', 0, 'u', 2, NULL, 0), ('K', 1, 'u', 2, NULL, 0), ('K', 2, 'a', 3, NULL, 0), ('K', 3, 'u', 2, NULL, 0),
  ('R', 0, NULL, 2, 'user', 1), ('R', 1, NULL, 2, 'user', 1), ('R', 2, NULL, 3, 'assistant', 1), ('R', 3, NULL, 2, 'user', 1)),
paths AS (
  SELECT DISTINCT c, 0::BIGINT AS i, 0 AS place, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM numbered
  UNION ALL
  SELECT c, i, place, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY c, place ORDER BY cost, audit) AS n FROM (
      SELECT p.c, m.i, d.after AS place, p.cost + 5 * e.k + d.price + CASE WHEN d.letter <> 'D' AND m.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
        p.audit || repeat('I', e.k) || d.letter AS audit,
        p.lines || e.added || CASE WHEN d.letter = 'D' THEN [] ELSE [coalesce(d.role, m.role) || ':' || m.text] END AS lines
      FROM paths p JOIN marked m ON m.c = p.c AND m.i = p.i + 1 JOIN inserts e ON e.place = p.place JOIN edits d ON d.spot = e.spot
      WHERE (d.letter = 'D' OR m.fault NOT IN ('blank', 'duplicate')) AND (d.letter <> 'K' OR d.first = m.first)))
  WHERE n = 1),
ends AS (
  SELECT c, cost + 5 * k AS cost, audit || repeat('I', k) AS audit, lines || added AS lines FROM paths
  JOIN (SELECT c, count(m.i) AS i FROM (SELECT DISTINCT c FROM numbered) LEFT JOIN marked m USING (c) GROUP BY c) USING (c, i)
  JOIN inserts USING (place) WHERE (place, k) IN ((0, 0), (1, 2), (2, 1), (3, 0))
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost + 5 * k, audit || repeat('I', k)) = 1),
counts AS (
  SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM numbered) LEFT JOIN counts USING (c) JOIN ends USING (c)"""


def statements() -> dict[str, str]:
    return {"op11_secret_scan": secrets(), "op12_conversation_repair": repair()}
