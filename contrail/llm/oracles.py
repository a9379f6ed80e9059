"""SQL, written out, for the operators that SQL can express."""

_TOKENS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1"

# Rounds of fitting until no factor is off by 1e-9, or until they come no nearer; then the rate at which
# the probabilities, cut at 1, give 70 % of the tokens.
RAKING = rf"""
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce(text, '') AS body, {_TOKENS} AS tokens,
    coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang
  FROM documents
), shares AS (
  SELECT *, greatest(length(body), 1) AS n,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS symbols,
    length(body) - length(regexp_replace(body, '[0-9]', '', 'g')) AS digits
  FROM counted
), marked AS (
  SELECT doc_id, body, source, lang, tokens,
    CASE WHEN symbols / n > 0.03 THEN 'symbols' WHEN digits / n > 0.05 THEN 'numbers'
      WHEN tokens < 100 THEN 'short' WHEN tokens > 2000 THEN 'long' ELSE 'prose' END AS topic
  FROM shares
), cells AS (
  SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM marked GROUP BY ALL
), by_source AS (
  SELECT source, pow(sum(tokens), 0.7) AS raw FROM cells GROUP BY source
), by_lang AS (
  SELECT lang, pow(sum(tokens), 0.6) AS raw FROM cells GROUP BY lang
), by_topic AS (
  SELECT topic, pow(sum(tokens), 0.8) AS raw FROM cells GROUP BY topic
), total AS (
  SELECT sum(tokens)::DOUBLE AS total FROM cells
), wanted AS (
  SELECT c.*, total,
    s.raw / (SELECT sum(raw) FROM by_source) * total AS want_source,
    l.raw / (SELECT sum(raw) FROM by_lang) * total AS want_lang,
    t.raw / (SELECT sum(raw) FROM by_topic) * total AS want_topic
  FROM cells c JOIN by_source s USING (source) JOIN by_lang l USING (lang)
    JOIN by_topic t USING (topic) CROSS JOIN total
), raked AS (
  SELECT 0 AS round, source, lang, topic, tokens, total, want_source, want_lang, want_topic,
    tokens::DOUBLE AS weight, 1.0::DOUBLE AS off, NULL::DOUBLE AS before
  FROM wanted
  UNION ALL
  SELECT round + 1, source, lang, topic, tokens, total, want_source, want_lang, want_topic,
    w2 * f3, greatest(abs(f1 - 1), abs(f2 - 1), abs(f3 - 1)), CASE WHEN round > 0 THEN worst END
  FROM (
    SELECT *, want_topic / sum(w2) OVER (PARTITION BY topic) AS f3 FROM (
      SELECT *, w1 * f2 AS w2 FROM (
        SELECT *, want_lang / sum(w1) OVER (PARTITION BY lang) AS f2 FROM (
          SELECT *, weight * f1 AS w1 FROM (
            SELECT *, want_source / sum(weight) OVER (PARTITION BY source) AS f1,
              max(off) OVER () AS worst
            FROM raked
          )
        )
      )
    )
  )
  WHERE round < 200 AND worst >= 1e-9 AND (before IS NULL OR worst <= 0.999 * before)
), fitted AS (
  SELECT *, weight / tokens AS ratio FROM raked WHERE round = (SELECT max(round) FROM raked)
), rates AS (
  SELECT 0 AS step, 1.0::DOUBLE AS factor
  UNION ALL
  SELECT step + 1, (0.7 * total - cut) / free
  FROM (
    SELECT step, factor, total,
      sum(CASE WHEN step > 0 AND ratio * factor >= 1 THEN tokens ELSE 0 END)::DOUBLE AS cut,
      sum(CASE WHEN step > 0 AND ratio * factor >= 1 THEN 0 ELSE weight END) AS free
    FROM rates CROSS JOIN fitted GROUP BY step, factor, total
  )
  WHERE step < 1000 AND free > 0 AND 0.7 * total > cut AND (0.7 * total - cut) / free <> factor
), chosen AS (
  SELECT max_by(factor, step) AS factor FROM rates
)
SELECT doc_id, m.source, m.lang, m.topic, m.tokens::BIGINT AS tokens,
  round(ratio, 9) AS weight,
  round(least(ratio * factor, 1.0::DOUBLE), 9) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(body)) || ':11'), 1, 13))::BIGINT / pow(2, 52)
    < least(ratio * factor, 1.0::DOUBLE) AS sampled
FROM marked m JOIN fitted f ON m.source = f.source AND m.lang = f.lang AND m.topic = f.topic
  CROSS JOIN chosen
"""

# All ways to end 16 ranges of lengths, the least padding of each kept, then traced back.
LENGTH_BUCKETS = rf"""
WITH RECURSIVE counted AS (
  SELECT doc_id, {_TOKENS} AS total FROM documents
), split AS (
  SELECT doc_id, total, unnest(range(0, ((total + 4095) // 4096)::BIGINT)) AS piece FROM counted
), pieces AS (
  SELECT doc_id, piece, piece * 4096 AS start, least(total - piece * 4096, 4096) AS n_tokens FROM split
), histogram AS (
  SELECT n_tokens AS length, count(*) AS n, row_number() OVER (ORDER BY n_tokens) AS j
  FROM pieces GROUP BY n_tokens
), sums AS (
  SELECT j, length, sum(n) OVER (ORDER BY j) AS n, sum(n * length) OVER (ORDER BY j) AS tokens
  FROM histogram
  UNION ALL SELECT 0, 0, 0, 0
), ranges AS (
  SELECT a.j AS i, b.j AS j, ((b.n - a.n) * b.length - (b.tokens - a.tokens))::BIGINT AS padding
  FROM sums a JOIN sums b ON a.j < b.j
), best AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS j, 0::BIGINT AS padding, 0::BIGINT AS choice
  UNION ALL
  SELECT k + 1, j, least_way.padding, least_way.i
  FROM (
    SELECT best.k, ranges.j,
      min({{'padding': best.padding + ranges.padding, 'i': ranges.i}}) AS least_way
    FROM best JOIN ranges ON ranges.i = best.j
    WHERE best.k < 16 GROUP BY best.k, ranges.j
  )
), traced AS (
  SELECT least(16, max(j))::BIGINT AS k, max(j)::BIGINT AS j FROM histogram
  UNION ALL
  SELECT t.k - 1, b.choice FROM traced t JOIN best b ON b.k = t.k AND b.j = t.j WHERE t.k > 1
), ends AS (
  SELECT k - 1 AS bucket, length AS high, coalesce(lag(length) OVER (ORDER BY k), 0) AS low
  FROM traced JOIN histogram USING (j)
), buckets AS (
  SELECT bucket, low, high, (sum(n)::BIGINT + 19999) // 20000 AS shards
  FROM ends JOIN histogram h ON h.length > low AND h.length <= high GROUP BY ALL
), placed AS (
  SELECT doc_id, piece, start, n_tokens, bucket, high,
    ('0x' || substr(md5(concat_ws(':', doc_id, piece, n_tokens)), 1, 13))::BIGINT % shards AS shard
  FROM pieces JOIN buckets ON n_tokens > low AND n_tokens <= high
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bucket, shard ORDER BY n_tokens, doc_id, piece) - 1 AS place
  FROM placed
)
SELECT doc_id, piece::BIGINT AS piece, start::BIGINT AS start, n_tokens::BIGINT AS n_tokens,
  bucket::INTEGER AS bucket, high::BIGINT AS padded_to, shard::BIGINT AS shard,
  (place // (65536 // high))::BIGINT AS batch, (place % (65536 // high))::INTEGER AS slot
FROM numbered
"""

# The filters of a text as bits, documents by part and bits, and every order's steps over these.
FILTER_AUDIT = r"""
WITH graded AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marked AS (
  SELECT doc_id, part,
    [len(words) < 100,
     100 * len(list_distinct(words)) < 80 * len(words),
     100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 10 * length(body),
     regexp_matches(body, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS fails
  FROM texts
), counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good = 1) AS good,
    count(*) FILTER (toxic = 1) AS toxic
  FROM marked LEFT JOIN graded USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest(range(1, 6)) AS i
), orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT list_aggregate(list_transform(o, lambda i: substr('ABCDE', i::INT, 1)), 'string_agg', '') AS filter_order,
    i AS step, o[i] AS here, o[1:i - 1] AS before
  FROM orders CROSS JOIN letters
), reached AS (
  SELECT part, filter_order, step, here, n, good, toxic,
    fails[here] AS failing,
    len(list_filter(before, lambda i: fails[i])) = 0 AS there,
    len(list_filter(fails, lambda f: f)) = 1 AND fails[here] AS alone
  FROM counts CROSS JOIN steps
), summed AS (
  SELECT part, filter_order, step, here,
    sum(CASE WHEN there AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN there AND failing THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN failing AND NOT there THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN there AND failing THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN there AND failing THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM reached GROUP BY ALL
)
SELECT * EXCLUDE (here, step), step::INTEGER AS step,
  sum(removed) OVER (PARTITION BY part, here)::BIGINT AS shapley
FROM summed
"""

# All prefixes of all conversations, grouped; subtrees summed over each node's own prefixes. The crc32
# of the decimal id, by the table of its polynomial, says how many turns a conversation takes over.
PREFIX_TRIE = r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, 0 AS k, i::BIGINT AS v FROM range(256) r(i)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY byte) AS crc FROM bits WHERE k = 8
), own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM own CROSS JOIN crc_table
), rebuilt AS (
  SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
  FROM taken c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, turns[1:d] AS prefix, d AS depth, turns[d].text AS last, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * len(regexp_extract_all(coalesce(any_value(last), ''), '[^\x20\x09-\x0D]+')) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth
), children AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (prefix)
), sums AS (
  SELECT prefix, sum(saved)::BIGINT AS saved_tokens, sum((n_children = 0)::INT)::BIGINT AS n_leaves
  FROM (SELECT c.prefix[1:d] AS prefix, saved, n_children
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) c)
  GROUP BY prefix
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
  saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (prefix)
  LEFT JOIN nodes p ON c.depth > 0 AND p.prefix = c.prefix[1:c.depth - 1]
"""
