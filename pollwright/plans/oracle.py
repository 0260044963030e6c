"""SQL statements of the registered queries, run by DuckDB on the same tables."""

from __future__ import annotations

from pollwright.constants import FORMATS, TASKS
from pollwright.plans.fixtures import MODELS, SEGMENTS, TEMPLATE

WS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def text(value: str) -> str:
    """A SQL string literal; line breaks and tabs are spelled with chr()."""
    quoted = "'" + value.replace("'", "''") + "'"
    return quoted.replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '")


def items(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def normalise(x: str) -> str:
    bare = f"""trim(trim({strip(x)}, '"'), '''')"""
    return f"trim(regexp_replace({bare}, '{WS}+', ' ', 'g'))"


def blank(x: str) -> str:
    return f"({strip(f'coalesce({x}, {text(chr(39) * 0)})')} = '')"


RESULTS = f"""
keyed AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS pr,
         CAST(o_orderkey % 90 + 1 AS VARCHAR) AS a, CAST(o_custkey % 90 + 1 AS VARCHAR) AS b,
         {items(TASKS)}[CAST(o_orderkey % 6 AS INT) + 1] AS dir_task
  FROM orders),
expecting AS (
  SELECT *, CASE k % 11
    WHEN 0 THEN a
    WHEN 1 THEN '[''' || a || ''', ''' || b || ''']'
    WHEN 2 THEN '["' || a || '", "' || b || '"]'
    WHEN 3 THEN '"[''' || a || ''', ''' || b || ''']"'
    WHEN 4 THEN a || ', ' || b
    WHEN 5 THEN 'None' WHEN 6 THEN pr WHEN 7 THEN '' WHEN 8 THEN '[]'
    WHEN 9 THEN a || '.5'
    ELSE '[x' || a || ', y' || b || ']' END AS expected_answer
  FROM keyed),
results AS (
  SELECT k AS row_id, 'm' || (c % 3) AS model, 'ds' || (c % 5) AS dataset, dir_task,
    CASE WHEN k % 101 = 0 AND (k // 101) % 2 = 0 THEN 'free_form_probe'
         WHEN k % 101 = 0 THEN '  ' || upper(dir_task) || ' ' ELSE dir_task END AS task,
    {items(FORMATS)}[CAST((k // 6) % 6 AS INT) + 1] AS format,
    CASE WHEN k % 97 = 0 THEN 'item_' || (k % 50 + 1)
         WHEN k % 89 = 0 THEN ' case_' || (k % 50 + 1) || ' '
         ELSE 'case_' || (k % 50 + 1) END AS case_id,
    'Which respondents match order ' || k || '?' AS question,
    expected_answer,
    CASE k % 13
      WHEN 0 THEN expected_answer
      WHEN 1 THEN b || ', ' || a
      WHEN 2 THEN 'Respondent' || a || ' and Respondent' || b
      WHEN 3 THEN a || ', ' || b || ', ' || (CAST(a AS INT) + CAST(b AS INT) + 100)
      WHEN 4 THEN '   '
      WHEN 5 THEN ' None '
      WHEN 6 THEN CASE WHEN k % 4 = 0 THEN '### ANSWER ###  ### END ###'
        ELSE '### ANALYSIS ###' || chr(10) || 'looked at 12 rows' || chr(10) || '### ANSWER ###'
          || chr(10) || a || ', ' || b || chr(10) || '### END ###' END
      WHEN 7 THEN '### answer ### ' || a
      WHEN 8 THEN '"' || a || '"'
      WHEN 9 THEN 'The answer is ' || a || '  because order ' || k || chr(9) || 'says ' || lower(pr)
      WHEN 10 THEN 'A' || a
      WHEN 11 THEN 'HOSP_' || a || ' case_' || b
      ELSE 'no match' END AS "Response",
    CASE k % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE '' END AS "Correct",
    CASE k % 17 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' true ' WHEN 2 THEN 'FALSE'
      WHEN 3 THEN NULL ELSE '' END AS skip
  FROM expecting)"""

SECTION = rf"(?is)###{WS}*ANSWER{WS}*###{WS}*(.*?){WS}*###{WS}*END{WS}*###"


def section(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '{SECTION}') "
        f"THEN {strip(f'regexp_extract({x}, {text(SECTION)}, 1)')} ELSE {x} END"
    )


def identifiers(x: str) -> str:
    """Pattern by pattern, first occurrence kept; ASCII text only (RE2 word bounds)."""
    found = " || ".join(
        f"regexp_extract_all({x}, '{p}', {g})"
        for p, g in (
            (r"\b\d+\b", 0),
            (r"(?i)\bcase_\d+\b", 0),
            (r"\b[A-Za-z]\d+\b", 0),
            (r"\b[A-Za-z]+_\d+\b", 0),
            (r"\b[A-Za-z]+(\d+)\b", 1),
        )
    )
    return (
        f"(SELECT coalesce(list(v ORDER BY p), []) FROM (SELECT v, min(p) AS p FROM "
        f"(SELECT unnest({found}) AS v, generate_subscripts({found}, 1) AS p) GROUP BY v))"
    )


def identifier_set(x: str) -> str:
    return (
        rf"list_distinct(regexp_extract_all({x}, '\b(?:\d+|[A-Za-z]\d+|[A-Za-z]+_\d+)\b')"
        rf" || regexp_extract_all({x}, '\b[A-Za-z]+(\d+)\b', 1))"
    )


# Expected answers: one pair of quotes off, then list literal, comma list or value.
def parsed_ctes(source: str) -> str:
    inner = strip("substr(s, 2, greatest(length(s) - 2, 0))")
    item = r"""(?:'[^']*'|"[^"]*"|-?\d+(?:\.\d+)?|None|True|False|null|true|false)"""
    literal = rf"^\[\s*(?:{item}(?:\s*,\s*{item})*\s*,?)?\s*\]$"
    return f"""
bare AS (SELECT *, {strip("coalesce(expected_answer, '')")} AS s FROM {source}),
unquoted AS (SELECT * EXCLUDE (s), CASE
    WHEN (starts_with(s, '"') AND ends_with(s, '"')) OR (starts_with(s, '''') AND ends_with(s, ''''))
    THEN {inner} ELSE s END AS e FROM bare),
split AS (SELECT *, regexp_matches(e, {text(literal)}) AS bracketed,
    [trim(trim({strip("p")}, '"'), '''') FOR p IN string_split(e, ',')] AS parts FROM unquoted),
parsed AS (SELECT * EXCLUDE (e, bracketed, parts),
    bracketed OR (contains(e, ',') AND NOT list_contains(parts, '')) AS is_list,
    CASE WHEN bracketed THEN [{strip("trim(trim(p, '" + chr(34) + "'), '''')")}
           FOR p IN regexp_extract_all(e, {text(item)})]
         WHEN contains(e, ',') AND NOT list_contains(parts, '') THEN parts
         ELSE [e] END AS items FROM split)"""


def same_identifiers(clean: str) -> str:
    found = identifier_set(clean)
    return f"""((lower({clean}) = 'none' AND NOT is_list AND lower(items[1]) = 'none')
      OR CASE WHEN is_list THEN list_sort({found}) = list_sort(list_distinct(items))
              ELSE list_contains({found}, items[1]) END)"""


def contains_text(clean: str) -> str:
    expected = normalise("coalesce(expected_answer, '')")
    return f"contains(lower({clean}), lower({expected}))"


def names_number(raw: str) -> str:
    return (
        rf"coalesce(list_contains(regexp_extract_all({raw}, '\b\d+\b'),"
        rf" regexp_extract_all(coalesce(expected_answer, ''), '\b\d+\b')[1]), false)"
    )


PARSED = f"{RESULTS}, {parsed_ctes('results')}"

SCORED = f"""{PARSED},
answered AS (SELECT *, {section('"Response"')} AS ans FROM parsed),
cleaned AS (SELECT *, {normalise('ans')} AS clean, lower({strip('task')}) AS rule FROM answered),
scored AS (SELECT *, CASE
    WHEN {blank('"Response"')} OR {blank('ans')} THEN false
    WHEN rule IN ('rule_based_querying', 'answer_reverse_lookup', 'multi_hop_relational_inference')
      THEN {same_identifiers('clean')}
    WHEN rule IN ('conceptual_aggregation', 'respondent_count') THEN {names_number('ans')}
    ELSE {contains_text('clean')} END AS is_correct,
    coalesce(upper({strip('skip')}) = 'TRUE', false) AS skipped
  FROM cleaned)"""

PCT = "CASE WHEN total > 0 THEN correct / total * 100 ELSE 0.0 END"

CELLS = f"""{SCORED},
counted AS (SELECT dataset, dir_task, format,
    count(*) FILTER (NOT skipped AND is_correct) AS correct,
    count(*) FILTER (NOT skipped) AS total
  FROM scored WHERE starts_with({strip('case_id')}, 'case_') GROUP BY ALL),
cells AS (SELECT *, {PCT} AS percentage FROM counted)"""


def one_rule(condition: str) -> str:
    """A single rule on the answer as given, without choosing by task."""
    return f"""WITH {PARSED},
    cleaned AS (SELECT *, {normalise('"Response"')} AS clean FROM parsed)
    SELECT row_id, CASE WHEN {blank('"Response"')} THEN false ELSE {condition} END AS is_correct
    FROM cleaned"""


def pivoted(
    cell: str, column: str = "dir_task", cells: str = f"WITH {CELLS}", tasks: list[str] = TASKS,
    by: str | None = None,
) -> str:
    shown = ", ".join(
        f"coalesce(max(shown) FILTER (WHERE {column} = '{t}'), 'N/A') AS {t}" for t in tasks
    )
    keys, lead = (f"{by}, ", f"r.{by}, ") if by else ("", "")
    rows = f"(SELECT unnest({items(FORMATS)}) AS format) f"
    if by:
        rows = f"(SELECT * FROM {rows} CROSS JOIN (SELECT DISTINCT {by} FROM cells)) r"
    else:
        rows = f"{rows[:-2]} r"
    return f"""{cells},
    summed AS (SELECT {keys}format, dir_task, sum(correct) AS c, sum(total) AS t FROM cells GROUP BY ALL),
    texts AS (SELECT {keys}format, dir_task, CASE WHEN t > 0 THEN {cell} END AS shown FROM summed)
    SELECT {lead}r.format, {shown}
    FROM {rows} LEFT JOIN texts USING ({keys}format)
    GROUP BY ALL"""


def document_keys(n: str) -> str:
    return f"""'ds' || ({n} % 5) AS dataset, {items(TASKS)}[CAST({n} % 6 AS INT) + 1] AS task,
    'case_' || ({n} // 30 + 1) AS case_id"""


DOCUMENTS = f"""docs AS (
  SELECT {document_keys('doc_id')}, format, '[' || format || ' export]' || chr(10) || text AS content
  FROM documents CROSS JOIN
    (SELECT unnest({items(FORMATS)}) AS format, unnest(range({len(FORMATS)})) AS i)
  WHERE doc_id % 7 <> i)"""

SKIPS = f"skips AS (SELECT DISTINCT {document_keys('doc_id')} FROM labels WHERE toxic = 1)"


def _section(i: int, name: str) -> str:
    body = text(TEMPLATE[name])
    if name == "task":
        upper = text(TEMPLATE[name].replace("[question]", "[QUESTION]"))
        body = f"CASE WHEN u.conv_id % 3 = 0 THEN {upper} ELSE {body} END"
    return f"CASE WHEN u.conv_id % 8 = {i} THEN '' ELSE {body} END"


ITEMS = f"""items AS (
  SELECT {document_keys('u.conv_id')}, u.conv_id * 1000 + u.turn AS pos,
    'topic-' || (u.conv_id % 4) AS topic,
    u.text || CASE WHEN u.conv_id % 5 = 0 THEN ' (see [TOPIC] in [questionnaire])' ELSE '' END AS question,
    coalesce(a.text, '') AS expected_answer,
    {" || ".join(_section(i, s) for i, s in enumerate(TEMPLATE))} AS prompt,
    u.turn AS attempts, 'Focus on [TOPIC].' AS request
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def _with_content(x: str) -> str:
    block = "'[Insert the full data block here]'"
    return f"replace(replace({x}, {block}, content), '[questionnaire]', content)"


def _filled() -> str:
    p = "prompt"
    for key in ("case_id", "topic", "question", "expected_answer", "prompt", "attempts", "request"):
        value = "CAST(attempts AS VARCHAR)" if key == "attempts" else _with_content(key)
        p = f"replace({p}, '[{key.upper()}]', {value})"
    p = f"replace({p}, '[questionnaire]', content)"
    p = f"replace({p}, '[question]', question)"
    p = f"replace({p}, '[CASE_1]', example)"
    return f"replace({p}, '[Insert the full data block here]', content)"


FILLED = f"""{ITEMS}, {DOCUMENTS}, {SKIPS},
firsts AS (SELECT dataset, task, arg_min(question, pos) AS q, arg_min(expected_answer, pos) AS e
  FROM items WHERE case_id = 'case_1' GROUP BY ALL),
examples AS (SELECT dataset, task, format,
    content || chr(10) || chr(10) || 'Question: ' || q || chr(10) || 'Answer: ' || e AS example
  FROM docs JOIN firsts USING (dataset, task) WHERE case_id = 'case_1'),
joined AS (SELECT i.*, d.format, d.content, coalesce(x.example, '[CASE_1 data not available]') AS example,
    CASE WHEN s.case_id IS NULL THEN 'FALSE' ELSE 'TRUE' END AS skip
  FROM items i JOIN docs d USING (dataset, task, case_id)
  LEFT JOIN examples x USING (dataset, task, format)
  LEFT JOIN skips s USING (dataset, task, case_id)),
filled AS (SELECT * EXCLUDE (prompt), {_filled()} AS prompt FROM joined)"""
