"""SQL with the same result, for the operators that SQL can express."""

from clickmeter.llm.quality import KEEP_FROM, PRIOR_GOOD, ROUNDS

WORD = r"[^\x20\x09-\x0D]"

# A detector's rule votes 0 or abstains (1); one for prose votes 2 or abstains.
CALM = "n_symbols * 50 <= n_words AND n_exclaims * 50 <= n_words AND n_capitals * 5 <= word_chars"
DETECTORS = (
    "n_symbols * 10 > n_words",
    "n_letters * 4 < word_chars * 3",
    "n_bare_words * 5 > n_words",
    "n_dup_lines * 10 > n_lines * 3",
    "n_repeat_words * 4 > n_words",
    "n_words >= 50 AND n_distinct_words * 10 < n_words * 3",
    "n_capitals * 10 > word_chars * 3",
    "n_exclaims * 10 > n_words",
    "word_chars < n_words * 3 OR word_chars > n_words * 12",
)
PROSE = (
    f"{CALM} AND n_letters * 10 >= word_chars * 8 AND n_bare_words * 20 <= n_words",
    f"{CALM} AND n_repeat_words * 5 <= n_words AND n_dup_lines * 5 <= n_lines",
    f"{CALM} AND n_words >= 100 AND n_distinct_words * 5 >= n_words * 2",
)
VOTES = " || ".join(
    [f"CASE WHEN {rule} THEN '0' ELSE '1' END" for rule in DETECTORS]
    + [f"CASE WHEN {rule} THEN '2' ELSE '1' END" for rule in PROSE]
)
RULES = len(DETECTORS) + len(PROSE)
P_GOOD = (
    "1 / (1 + exp(-(ln(prior) - ln(1 - prior) + list_sum(list_transform(range(1, "
    f"{RULES + 1}), lambda j: ln(rates[j][1][x.c[j] + 1]) - ln(rates[j][2][x.c[j] + 1]))))))"
)
RATE = (
    "list_transform([0, 1, 2], lambda v: (1 + coalesce(list_sum(list_transform(list_filter(w, lambda x: x.c[j] = v), lambda x: x.{k})), 0))"
    " / (3 + list_sum(list_transform(w, lambda x: x.{k}))))"
)

QUALITY = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '{WORD}+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS ls
  FROM documents
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS n
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM split WHERE len(ws) >= 3)
), repeats AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM windows, (VALUES (0), (1), (2)) AS t(d) WHERE n > 1 GROUP BY rid
), counts AS (
  SELECT rid, doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, len(list_distinct(ws)) AS n_distinct_words,
         length(regexp_replace(body, '\\P{{Lu}}+', '', 'g')) AS n_capitals,
         length(body) - length(replace(body, '!', '')) AS n_exclaims,
         length(regexp_replace(body, '\\P{{L}}+', '', 'g')) AS n_letters,
         len(list_filter(ws, lambda w: NOT regexp_matches(w, '\\p{{L}}'))) AS n_bare_words
  FROM split LEFT JOIN repeats r USING (rid)
), voted AS (
  SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed, {VOTES} AS votes FROM counts
), patterns AS (
  SELECT list({{'votes': votes, 'c': list_transform(string_split(votes, ''), lambda v: v::INT), 'n': n}} ORDER BY votes) AS pats
  FROM (SELECT votes, count(*)::DOUBLE AS n FROM voted GROUP BY votes)
), em AS (
  SELECT 0 AS k, {PRIOR_GOOD}::DOUBLE AS prior,
         list_transform(range(1, {RULES + 1}), lambda j: [[0.1::DOUBLE, 0.2, 0.7], [0.7::DOUBLE, 0.2, 0.1]]) AS rates
  UNION ALL
  SELECT k + 1,
         (good + 1) / (good + bad + 2),
         list_transform(range(1, {RULES + 1}), lambda j: [{RATE.format(k="good")}, {RATE.format(k="bad")}])
  FROM (
    SELECT k, w, list_sum(list_transform(w, lambda x: x.good)) AS good, list_sum(list_transform(w, lambda x: x.bad)) AS bad
    FROM (
      SELECT k, list_transform(pats, lambda x: {{'c': x.c, 'good': x.n * {P_GOOD}, 'bad': x.n * (1 - {P_GOOD})}}) AS w
      FROM em, patterns WHERE k < {ROUNDS}
    )
  )
), model AS (
  SELECT x.votes AS votes, round({P_GOOD}, 6) AS p_good
  FROM (SELECT unnest(pats) AS x, prior, rates FROM em, patterns WHERE k = {ROUNDS})
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND p_good >= {KEEP_FROM} AS kept, votes
FROM voted JOIN model USING (votes)
"""

# A step of the checksum for each bit: a byte comes with the first of its eight.
CHECKSUM = (
    "xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(string_split({id}, ''), "
    "lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda a, b: xor(xor(a, b) >> 1, 3988292384::UBIGINT * (xor(a, b) & 1::UBIGINT))), 4294967295::UBIGINT)"
)

TRIE = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {CHECKSUM.format(id="conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)
), taken AS (
  SELECT c.conv_id, 0 AS kind, place, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND place <= h
  UNION ALL
  SELECT conv_id, 1, place, role, text FROM own JOIN convs USING (conv_id) WHERE place > h
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY kind, place) AS depth,
         sha256(length(role) || ':' || role || text) AS turn,
         len(regexp_extract_all(text, '{WORD}+')) AS words
  FROM taken
), paths AS (
  SELECT conv_id, depth, words, sha256(string_agg(turn, '') OVER upto) AS path,
         CASE WHEN depth = 1 THEN '' ELSE sha256(string_agg(turn, '') OVER before) END AS above
  FROM numbered
  WINDOW upto AS (PARTITION BY conv_id ORDER BY depth),
         before AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  UNION ALL
  SELECT conv_id, 0, 0, '', NULL FROM convs
), nodes AS (
  SELECT path, any_value(above) AS above, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words
  FROM paths GROUP BY path
), children AS (
  SELECT above AS path, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), added AS (
  SELECT conv_id, depth, (n_convs - 1) * words AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaves
  FROM nodes LEFT JOIN children USING (path)
), summed AS (
  SELECT path, sum(saved) AS saved, sum(leaves) AS leaves
  FROM (SELECT path, sum(coalesce(saved, 0)) OVER below AS saved, sum(coalesce(leaves, 0)) OVER below AS leaves
        FROM paths LEFT JOIN added USING (conv_id, depth)
        WINDOW below AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  GROUP BY path
), ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM paths JOIN (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id) USING (conv_id, depth)
  GROUP BY path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n JOIN summed USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes up ON up.path = n.above
"""

ORACLE: dict[str, str] = {"op1_quality_rules": QUALITY, "op12_prefix_trie": TRIE}
