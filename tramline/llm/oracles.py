"""DuckDB SQL with the results of the corpus queries that SQL can express."""

from tramline.llm import collocations, decontaminate, ranked_search, repetition


def _shingled(name: str, id_column: str, size: int) -> str:
    """Distinct shingles of words, as CTEs."""
    return f"""
{name}_words AS (
  SELECT {id_column}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {name} WHERE text IS NOT NULL),
{name}_shingles AS (
  SELECT DISTINCT {id_column}, array_to_string(w[i : i + {size - 1}], ' ') AS s
  FROM (SELECT {id_column}, w, unnest(range(1, len(w) - {size - 2})) AS i FROM {name}_words))"""


LEAKS = f"""WITH {_shingled("documents", "doc_id", decontaminate.SHINGLE)},
{_shingled("benchmark", "item_id", decontaminate.SHINGLE)},
sizes AS (SELECT item_id, count(*) AS n FROM benchmark_shingles GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n) AS n_shingles
FROM benchmark_shingles JOIN documents_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY 1, 2 HAVING count(*) >= {decontaminate.LEAST_CONTAINMENT} * any_value(n)"""


def _folded(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_TERMS = rf"regexp_extract_all({_folded('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""WITH tokens AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY 1),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
holding AS (SELECT term, count(*) AS df FROM counts GROUP BY 1),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM holding, whole),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
impacts AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)) AS impact
  FROM counts JOIN lengths USING (doc_id), whole),
scored AS (
  SELECT item_id, doc_id, sum(w * impact)::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN impacts USING (term) GROUP BY 1, 2),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {ranked_search.TOP}"""


PHRASES = rf"""WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang,
      unnest(regexp_split_to_array({_folded("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
windows AS (SELECT lang, unnest(range(1, {collocations.LONGEST + 1})) AS m, w, i FROM places),
phrases AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS p, count(*) AS n
  FROM windows WHERE i + m - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM phrases WHERE m = 1 GROUP BY 1),
candidates AS MATERIALIZED (
  SELECT lang, m, p, string_split(p, ' ') AS w, n AS a FROM phrases WHERE m > 1 AND n >= {collocations.LEAST}),
starts AS (SELECT *, unnest(range(1, m)) AS s FROM candidates),
spans AS (SELECT *, unnest(range(s + 1, m + 1)) AS e FROM starts),
inside AS (
  SELECT lang, array_to_string(w[s : e], ' ') AS p, max(a) AS longer FROM spans WHERE e - s + 1 < m GROUP BY ALL),
cut_places AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
cuts AS (
  SELECT *, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 : m], ' ') AS y FROM cut_places),
scored AS (
  SELECT c.lang, c.p, c.a, f.n AS l, g.n AS r, t.n, k,
    (1000 * c.a::HUGEINT * t.n::HUGEINT) // (f.n::HUGEINT * g.n::HUGEINT) AS score
  FROM cuts c JOIN phrases f ON f.lang = c.lang AND f.p = c.x
  JOIN phrases g ON g.lang = c.lang AND g.p = c.y
  JOIN totals t ON t.lang = c.lang
  LEFT JOIN inside i ON i.lang = c.lang AND i.p = c.p
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
placed AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score
  FROM best)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM placed WHERE rank <= {collocations.TOP}"""


_SIZES = (repetition.REPEAT_WORDS, *repetition.COVERAGE_PERCENT)
_AHEAD = ", ".join(f"lead(word, {k}) OVER o AS w{k}" for k in range(1, max(_SIZES)))
_WINDOWS = " UNION ALL ".join(
    f"SELECT doc_id, {m} AS m, i, concat_ws(' ', word, {', '.join(f'w{k}' for k in range(1, m))}) AS p "
    f"FROM ahead WHERE w{m - 1} IS NOT NULL"
    for m in _SIZES
)
_COVERED = "\n".join(
    f"  AND 100 * coalesce(max(chars) FILTER (m = {m}), 0) <= {percent} * any_value(word_chars)"
    for m, percent in repetition.COVERAGE_PERCENT.items()
)
_WORDS = r"'[^\x20\x09-\x0D]+'"

REPETITION = rf"""WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
sizes AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
  FROM texts),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
repeated AS (
  SELECT doc_id, count(*) - 1 AS again,
    list_sum(list_transform(regexp_extract_all(line, {_WORDS}), lambda x: length(x))) AS chars
  FROM lines WHERE regexp_matches(line, {_WORDS}) GROUP BY doc_id, line),
line_sums AS (
  SELECT doc_id, sum(again)::BIGINT AS n_dup_lines, sum(again * chars)::BIGINT AS dup_line_chars FROM repeated GROUP BY 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
ahead AS (SELECT doc_id, i, word, {_AHEAD} FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
windows AS MATERIALIZED ({_WINDOWS}),
twice AS (SELECT doc_id, m, p FROM windows GROUP BY ALL HAVING count(*) > 1),
inside AS (SELECT DISTINCT doc_id, m, unnest(range(i, i + m)) AS i FROM windows JOIN twice USING (doc_id, m, p)),
covered AS (
  SELECT doc_id, m, count(*) AS words, sum(length(word)) AS chars FROM inside JOIN words USING (doc_id, i) GROUP BY 1, 2),
judged AS (
  SELECT doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
    coalesce(any_value(n_dup_lines), 0)::BIGINT AS n_dup_lines,
    coalesce(max(words) FILTER (m = {repetition.REPEAT_WORDS}), 0)::BIGINT AS n_repeat_words,
    100 * coalesce(any_value(dup_line_chars), 0) <= {repetition.LINE_PERCENT} * any_value(word_chars)
{_COVERED} AS fine
  FROM sizes LEFT JOIN line_sums USING (doc_id) LEFT JOIN covered USING (doc_id) GROUP BY doc_id),
based AS (
  SELECT *, n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > {repetition.REPEAT_PERCENT} * n_words AS base_failed FROM judged)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fine AS kept
FROM based"""
