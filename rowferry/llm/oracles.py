"""SQL counterparts, for DuckDB, of the queries that SQL can express; doc_id is taken to be unique in them."""

from __future__ import annotations

from rowferry.llm.quality_rules import CUTOFFS, ERROR, GOOD_WEIGHT, MIN_WORDS, RISK
from rowferry.llm.source_mix import MOST_COPIES, SEED, SHARE, WEIGHTS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SOURCE_MIX = f"""
    WITH sized AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
    sources AS (
        SELECT source, SUM(size)::BIGINT AS source_size,
               [{", ".join(map(str, WEIGHTS))}][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
        FROM sized GROUP BY source),
    ranked AS (SELECT *, {float(MOST_COPIES)} * source_size AS most FROM sources),
    filled AS (
        SELECT *, ROW_NUMBER() OVER up AS k,
               ({SHARE} * SUM(source_size) OVER () - (SUM(most) OVER up - most)) / (SUM(weight) OVER () - (SUM(weight) OVER up - weight)) AS level
        FROM ranked WINDOW up AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    levels AS (SELECT COALESCE(arg_min(level, k), 'inf'::DOUBLE) AS level FROM filled WHERE level * weight < most),
    targets AS (SELECT source, source_size, LEAST(level * weight, most) AS target FROM ranked, levels),
    placed AS (
        SELECT s.*, source_size, target, target / NULLIF(source_size, 0) AS rate,
               ('0x' || md5('{SEED}:' || COALESCE('=' || s.source, ''))[1:5])::BIGINT / 1048576.0::DOUBLE AS start,
               ROW_NUMBER() OVER (
                   PARTITION BY s.source ORDER BY FLOOR(SQRT(size)), md5('{SEED}/' || doc_id), size, doc_id) AS place
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           COALESCE(size * (FLOOR(start + rate * place) - FLOOR(start + rate * (place - 1))), 0)::BIGINT AS taken
    FROM placed"""

GRID = ", ".join(f"('{name}', {i}, {c!r}::DOUBLE)" for name, cuts in CUTOFFS.items() for i, c in enumerate(cuts))
RISK_EACH = RISK / len(CUTOFFS)

QUALITY_RULES = rf"""
    WITH split AS (
        SELECT doc_id, lang, COALESCE(text, '') AS text, {WORDS} AS words,
               list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    placed AS (SELECT doc_id, UNNEST(words) AS word, generate_subscripts(words, 1) AS place FROM split),
    windows AS (
        SELECT doc_id, place, word, LEAD(word) OVER w AS second, LEAD(word, 2) OVER w AS third
        FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    twice AS (
        SELECT doc_id, place FROM windows WHERE third IS NOT NULL
        QUALIFY COUNT(*) OVER (PARTITION BY doc_id, word, second, third) > 1),
    repeated AS (
        SELECT doc_id, COUNT(DISTINCT place + i) AS n FROM twice, (VALUES (0), (1), (2)) v(i) GROUP BY doc_id),
    counts AS (
        SELECT s.doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, COALESCE(n, 0) AS n_repeat_words, len(lines) AS n_lines,
               length(text) - length(regexp_replace(text, '\p{{Lu}}+', '', 'g')) AS n_upper
        FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id),
    measures AS (
        SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               [n_symbols / GREATEST(n_words, 1), n_dup_lines / GREATEST(n_lines, 1), n_repeat_words / GREATEST(n_words, 1),
                n_upper / GREATEST(word_chars, 1), word_chars / GREATEST(n_words, 1), -word_chars / GREATEST(n_words, 1)] AS values_
        FROM counts),
    signals AS (
        SELECT doc_id, lang, base_failed, UNNEST([{", ".join(f"'{name}'" for name in CUTOFFS)}]) AS signal, UNNEST(values_) AS value
        FROM measures),
    marks AS (SELECT doc_id, MIN(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    grid(signal, cut, cutoff) AS (VALUES {GRID}),
    tests AS (
        SELECT lang, signal, cutoff, COUNT(*) FILTER (quality = 1) AS n_good, COUNT(*) FILTER (quality <> 1) AS n_bad,
               COUNT(*) FILTER (quality = 1 AND value > cutoff) AS good, COUNT(*) FILTER (quality <> 1 AND value > cutoff) AS bad
        FROM signals JOIN marks USING (doc_id) JOIN grid USING (signal) WHERE NOT base_failed
        GROUP BY lang, signal, cutoff),
    tails AS (
        SELECT *, CASE WHEN good >= n_good * {RISK_EACH!r} THEN 1.0 ELSE list_sum(list_transform(range(0, good + 1), lambda i: exp(
                   lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({RISK_EACH!r}) + (n_good - i) * ln({1 - RISK_EACH!r}))))
               END AS tail, COUNT(*) OVER () AS n_tests
        FROM tests),
    useful AS (
        SELECT *, bad / GREATEST(n_bad, 1) - {GOOD_WEIGHT} * (good / GREATEST(n_good, 1)) AS use
        FROM tails WHERE tail <= {ERROR} / n_tests),
    chosen AS (
        SELECT lang, signal, cutoff FROM useful WHERE use > 0
        QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, signal ORDER BY use DESC, cutoff DESC) = 1),
    rejected AS (
        SELECT DISTINCT doc_id FROM signals s JOIN chosen c
        ON s.signal = c.signal AND s.lang IS NOT DISTINCT FROM c.lang AND value > cutoff)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
           n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
           NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
    FROM measures"""

ORACLES = {"op4_source_mix": SOURCE_MIX, "op7_quality_rules": QUALITY_RULES}
