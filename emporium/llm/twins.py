"""DuckDB SQL for the queries that SQL can state over whole tables."""

from emporium.llm.quality_rules import STOP_LANGS, STOP_WORDS

_OP8 = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    coalesce(regexp_extract(lower(lang), '^[a-z]*'), '') AS lang FROM documents),
split AS (SELECT rid, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    [l for l in string_split(t, chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines FROM docs),
windows AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM split WHERE len(w) >= 5),
hashed AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM windows),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM hashed) WHERE c > 1),
covered AS (SELECT rid, sum(least(5, coalesce(n - i, 5))) AS n_repeat
    FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS n FROM twice) GROUP BY rid),
m AS (SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len([l for l in lines if regexp_matches(l, '^[\x20\t]*[-*\x{2022}]\x20')]) AS bullets,
    len([x for x in w if regexp_matches(x, '\p{L}')]) AS alphas,
    len([x for x in w if lower(regexp_replace(x, '\P{L}+', '', 'g')) IN ({stop_words})])::BIGINT AS n_stop_words, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN covered USING (rid)),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, concat_ws(',',
    CASE WHEN n_words >= 20 AND (word_chars / n_words < 2 OR word_chars / n_words > 14) THEN 'mean_word_length' END,
    CASE WHEN n_words >= 10 AND n_symbols / n_words > 0.25 THEN 'symbols_per_word' END,
    CASE WHEN n_words >= 20 AND n_dup_lines / n_lines > 0.3 THEN 'repeated_lines' END,
    CASE WHEN n_words >= 50 AND bullets / n_lines > 0.9 THEN 'bullet_lines' END,
    CASE WHEN n_words >= 20 AND alphas / n_words < 0.6 THEN 'letters' END,
    CASE WHEN n_words >= 50 AND n_stop_words / n_words < 0.02 AND lang IN ({langs}) THEN 'stop_words' END) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND failed_rules = '' AS kept, failed_rules, n_stop_words FROM r
"""

_OP7 = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, regexp_replace(coalesce(role, 'unknown'), '[\x00-\x1F]|<\|', ' ', 'g') AS who,
    replace(coalesce(text, ''), '<|', '< |') AS words FROM conversations),
views AS (SELECT DISTINCT conv_id AS c, who AS speaker FROM turns WHERE who <> 'system'),
heads AS (SELECT *, '<|im_start|>' || CASE WHEN who = speaker THEN 'assistant' WHEN who = 'system' THEN 'system'
    ELSE 'user name=' || who END || chr(10) AS head FROM turns JOIN views ON conv_id IS NOT DISTINCT FROM c),
lines AS (SELECT *, head || words || '<|im_end|>' || chr(10) AS line FROM heads),
placed AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, who, words
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM lines)
SELECT conv_id, speaker, coalesce(floor(turn / 512), -1)::BIGINT AS part, count(*) AS n_turns,
    string_agg(line, '' ORDER BY turn NULLS FIRST, who, words) AS rendered, min(place) AS start,
    coalesce(string_agg(CASE WHEN who = speaker THEN (place + length(head)) || ':' || (place + length(line) - 1) END, ','
        ORDER BY turn NULLS FIRST, who, words), '') AS masks
FROM placed GROUP BY ALL
"""

def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_OP8 = _OP8.replace("{stop_words}", _list(STOP_WORDS)).replace("{langs}", _list(STOP_LANGS))
SQL: dict[str, str] = {"op7_chat_format": _OP7, "op8_quality_rules": _OP8}
