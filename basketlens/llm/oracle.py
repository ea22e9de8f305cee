"""DuckDB statements for the queries that SQL can express."""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
labelled AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY 1),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         sum(source_size) OVER () AS total
  FROM sources),
open AS (
  SELECT *, row_number() OVER ranked AS rank,
         CAST(sum(weight) OVER (ranked ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT)
           AS open_weight,
         CAST(total - 3 * coalesce(sum(source_size) OVER (
           ranked ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest
  FROM weighted WINDOW ranked AS (ORDER BY source_size / weight, source NULLS LAST)),
level AS (
  SELECT rest, open_weight FROM open WHERE rest * weight <= 3 * source_size * open_weight
  ORDER BY rank LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN level.rest IS NULL
                   OR CAST(3 * source_size AS DOUBLE) <= weight * level.rest / level.open_weight
              THEN CAST(3 * source_size AS DOUBLE)
              ELSE weight * level.rest / level.open_weight END AS target
  FROM open LEFT JOIN level ON true),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT)
                 ELSE 0 END AS epochs
  FROM targets),
keyed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs,
         p.target - p.epochs * p.source_size AS wanted, d.source,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
             / 4503599627370496.0)
         / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM docs d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
  LEFT JOIN labelled USING (doc_id)),
reached AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM keyed)
SELECT doc_id, size, source_size, target,
       size * least(3, epochs + CASE WHEN size > 0 AND upto - size < wanted
                                          AND upto - size / 2 <= wanted
                                     THEN 1 ELSE 0 END) AS taken
FROM reached
"""

DECONTAMINATION = r"""
WITH worded AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
itemized AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 13) AS n,
         array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS passage
  FROM itemized, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS s(i)
  WHERE len(words) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
stretches AS (
  SELECT row, i, n, array_to_string(words[i:i + n - 1], ' ') AS passage
  FROM worded, lengths, unnest(generate_series(1, len(words) - n + 1)) AS s(i)),
hits AS (SELECT row, i, n, item FROM stretches JOIN windows USING (n, passage)),
covered AS (
  SELECT row, count(DISTINCT p) AS n_hit
  FROM (SELECT row, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits WHERE item IS NOT NULL) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM worded LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""

def _normalised(text: str) -> str:
    return rf"lower(trim(regexp_replace({text}, '[\x20\x09-\x0D]+', ' ', 'g')))"


_NEWLINE, _MARKS, _BLANK_ENDS = "chr(10)", r"'^(?:>[\x20\x09]?)+'", r"'^\n+|\n+\z', '', 'g'"
QUOTATION_LINKS = rf"""
WITH RECURSIVE messages AS (
  SELECT conv_id, turn, min(role) AS role, CASE WHEN count(text) = count(*) THEN min(text) END AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
mail AS (
  SELECT m.conv_id, m.turn, m.role, concat_ws({_NEWLINE},
           '>> ' || replace(e.text, {_NEWLINE}, {_NEWLINE} || '>> '),
           '> ' || replace(b.text, {_NEWLINE}, {_NEWLINE} || '> '), m.text) AS text
  FROM messages m LEFT JOIN messages b ON b.conv_id = m.conv_id AND b.turn = m.turn - 1
  LEFT JOIN messages e ON e.conv_id = m.conv_id AND e.turn = m.turn - 2),
raw AS (
  SELECT conv_id, turn, unnest(string_split(text, {_NEWLINE})) AS raw,
         generate_subscripts(string_split(text, {_NEWLINE}), 1) AS pos FROM mail),
numbered AS (
  SELECT *, count(*) FILTER (level = 0) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS passage
  FROM (SELECT conv_id, turn, pos, regexp_replace(raw, {_MARKS}, '') AS line,
               length(regexp_replace(regexp_extract(raw, {_MARKS}), '[^>]', '', 'g')) AS level
        FROM raw)),
bodies AS (
  SELECT conv_id, turn, regexp_replace(coalesce(string_agg(line, {_NEWLINE} ORDER BY pos)
           FILTER (level = 0), ''), {_BLANK_ENDS}) AS body FROM numbered GROUP BY 1, 2),
quoted AS (
  SELECT *, row_number() OVER nested AS depth, first_value(words) OVER nested AS outermost,
         lead(words) OVER nested AS context
  FROM (SELECT conv_id, turn, passage, level, list(line ORDER BY pos) AS lines,
               {_normalised(f'string_agg(line, {_NEWLINE} ORDER BY pos)')} AS words
        FROM numbered WHERE level > 0 GROUP BY 1, 2, 3, 4)
  WINDOW nested AS (PARTITION BY conv_id, turn, passage ORDER BY level)),
asked AS (
  SELECT DISTINCT * FROM (
    SELECT conv_id, turn, passage, depth, context, 1 AS whole, words FROM quoted
    WHERE outermost <> ''
    UNION ALL
    SELECT conv_id, turn, passage, depth, context, 0, {_normalised('line')}
    FROM (SELECT *, unnest(lines) AS line FROM quoted WHERE outermost <> ''))
  WHERE words <> ''),
held AS (
  SELECT DISTINCT conv_id, turn, {_normalised('part')} AS words
  FROM (SELECT conv_id, turn, body AS part FROM bodies
        UNION ALL SELECT conv_id, turn, unnest(string_split(body, {_NEWLINE})) FROM bodies)
  WHERE {_normalised('part')} <> ''),
contexts AS (
  SELECT DISTINCT conv_id, turn, words AS context FROM quoted WHERE depth = 1 AND outermost <> ''),
answers AS (
  SELECT a.conv_id, a.turn, a.passage, a.depth, a.whole, length(a.words) AS size,
         count(c.turn) > 0 AS agrees,
         coalesce(max(c.turn), min(h.turn)) AS holder
  FROM asked a JOIN held h ON h.conv_id = a.conv_id AND h.words = a.words AND h.turn < a.turn
  LEFT JOIN contexts c ON c.conv_id = h.conv_id AND c.turn = h.turn AND c.context = a.context
  GROUP BY a.conv_id, a.turn, a.passage, a.depth, a.whole, a.words),
linked AS (
  SELECT m.conv_id, m.turn, m.role, b.body, a.holder AS parent
  FROM messages m JOIN bodies b USING (conv_id, turn) LEFT JOIN (
    SELECT conv_id, turn, holder FROM answers QUALIFY row_number() OVER (
      PARTITION BY conv_id, turn ORDER BY depth, passage, whole DESC, size DESC, agrees DESC, holder) = 1
  ) a USING (conv_id, turn)),
replies AS (
  SELECT conv_id, turn, turn AS root, 0 AS depth FROM linked WHERE parent IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, r.root, r.depth + 1
  FROM linked l JOIN replies r ON l.conv_id = r.conv_id AND l.parent = r.turn)
SELECT l.conv_id, l.turn, l.role, l.parent AS parent_turn, r.root AS root_turn,
       CAST(r.depth AS BIGINT) AS depth, l.body AS text
FROM linked l JOIN replies r ON l.conv_id = r.conv_id AND l.turn = r.turn
UNION ALL
SELECT conv_id, turn, role, NULL, turn, 0, regexp_replace(array_to_string(
         [x FOR x IN string_split(coalesce(text, ''), {_NEWLINE}) IF NOT starts_with(x, '>')],
         {_NEWLINE}), {_BLANK_ENDS})
FROM conversations WHERE conv_id IS NULL OR turn IS NULL
"""

#: The CRC-32 of the decimal id, bit by bit, as DuckDB has no function for it.
PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(
           length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, n,
         xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
           range(1, length(CAST(conv_id AS VARCHAR)) + 1),
           lambda i: list_prepend(CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT),
                                  [-1, -1, -1, -1, -1, -1, -1, -1])))),
           lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
                                  WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384)
                                  ELSE crc // 2 END), 4294967295) % 4 AS head
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1)),
rebuilt AS (
  SELECT c.conv_id, t.pos AS d, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.head
  UNION ALL
  SELECT c.conv_id, least(c.head, coalesce(b.n, 0)) + t.pos - c.head, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.head
  LEFT JOIN convs b ON b.conv_id = c.base),
steps AS (
  SELECT conv_id, d, role, text,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         list(md5(concat(length(role), ':', role, text))) OVER (
           PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
  FROM rebuilt),
visits AS (
  SELECT c.conv_id, 0 AS d, CAST([] AS VARCHAR[]) AS path, 0 AS words,
         c.conv_id NOT IN (SELECT conv_id FROM rebuilt) AS ends
  FROM convs c
  UNION ALL
  SELECT conv_id, d, path, words, d = max(d) OVER (PARTITION BY conv_id) FROM steps),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ','
                             ORDER BY conv_id), '') AS ends
  FROM visits GROUP BY 1, 2),
children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
above AS (
  SELECT path[1:CAST(up AS BIGINT)] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * words) AS saved_tokens
  FROM counted, unnest(generate_series(0, d)) AS s(up) GROUP BY 1)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs,
       CAST(c.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN above a ON a.path = c.path
LEFT JOIN nodes p ON c.d > 0 AND p.path = c.path[1:c.d - 1]
"""

ORACLE = {"op4_mixing": MIXING, "op8_decontamination": DECONTAMINATION,
          "op9_quotation_links": QUOTATION_LINKS, "op13_prefix_trie": PREFIX_TRIE}
