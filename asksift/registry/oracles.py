"""The registered queries in SQL, for the check against another engine.

The logic is stated apart from the Spark code: plain joins and windows over the
whole tables, with the rules as single regular expressions. The word lists,
run and rater names and templates are the library's own; ``tests`` count and
probe them with data of their own.
"""

from __future__ import annotations

from ..functions.rules import (
    CLAUSE_MARKERS,
    INVERTED_BE,
    INVERTED_MODALS,
    KEYWORDS,
    REQUEST_PHRASES,
    TURKISH_PARTICLES,
)
from ..operators.batching import BATCH_SIZE
from ..operators.triage import CLASSIFY
from .inputs import DISPLAY, DOC_RATERS, LONG_TEXT, MANY_RATERS, MODELS, RATER_SETS, RUN_NAMES, RUNS
from .queries import PREAMBLE, SAMPLE_SIZE, SLICE

BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NO_WORD = r"[^\p{L}\p{N}_]"


def text(value: str) -> str:
    """A SQL string literal; line breaks go in as chr(10)."""
    quoted = "'" + value.replace("'", "''") + "'"
    return quoted.replace("\n", "' || chr(10) || '")


def names(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


def table_of(columns: str, rows: list[str]) -> str:
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS v({columns}))"


def clean(x: str) -> str:
    spaced = f"regexp_replace(replace({x}, chr(8203), ''), '{BLANK}+', ' ', 'g')"
    return f"trim({spaced})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def strip_quotes(x: str) -> str:
    return f"""trim(trim({strip(x)}, '"'), '''')"""


def digit(*parts: str) -> str:
    return f"substr(md5(concat_ws(':', {', '.join(parts)})), 1, 1)"


def alternatives(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


ALL_KEYWORDS = [w for ws in KEYWORDS.values() for w in ws]
MARK = r"\?$"
STRUCTURE = [
    r"\?$",
    f"^{alternatives(INVERTED_MODALS)}(?:{NO_WORD}|$)",
    f"^{alternatives(INVERTED_BE)}(?:{NO_WORD}|$)",
    rf"(?:^|{NO_WORD}){alternatives(TURKISH_PARTICLES)}\?$",
    rf"^(?:[^.!?]*{NO_WORD})?{alternatives(CLAUSE_MARKERS)}(?:{NO_WORD}|$)",
]
KEYWORD = f"(?:^|{NO_WORD}){alternatives(ALL_KEYWORDS)}(?:{NO_WORD}|$)"
REQUEST = f"{alternatives(REQUEST_PHRASES)}(?:{NO_WORD}|$)"


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {text(pattern)})"


def conditions(x: str) -> dict[str, str]:
    s = f"lower({strip(x)})"
    return {
        "punctuation": matches(s, MARK),
        "structure": "(" + " OR ".join(matches(s, p) for p in STRUCTURE) + ")",
        "keyword": matches(s, KEYWORD),
        "request": matches(s, REQUEST),
    }


def is_question(x: str) -> str:
    return "(" + " OR ".join(conditions(x).values()) + ")"


def yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'YES' ELSE 'NO' END"


RUN_TABLE = table_of(
    "run_name, seed",
    [f"({text(r.name)}, {text(r.seed) if r.seed else 'NULL'})" for r in RUNS],
)
MODEL_TABLE = table_of("model", [f"({text(m)})" for m in MODELS])

# Common table expressions, each built on those before it.
CTE = {
    "cells": """
        SELECT doc_id, lang, unnest(string_split(text, '.')) AS cell,
               generate_subscripts(string_split(text, '.'), 1) - 1 AS pos
        FROM documents""",
    "log": f"""
        SELECT doc_id * 4294967296 + pos AS ordinal, doc_id, lang, {clean('cell')} AS "Query"
        FROM cells WHERE cell <> ''""",
    "questions": f"""
        SELECT ordinal, doc_id, lang, CASE {digit('"Query"')}
            WHEN '0' THEN "Query" || '?'
            WHEN '1' THEN 'Can ' || "Query"
            WHEN '2' THEN '  Please EXPLAIN ' || "Query"
            WHEN '3' THEN "Query" || ' mu? '
            WHEN '4' THEN 'x, est-ce que ' || "Query"
            WHEN '5' THEN 'هل ' || "Query"
            WHEN '6' THEN 'آیا ' || "Query"
            WHEN '7' THEN 'xcould you ' || "Query"
            ELSE "Query" END AS "Query"
        FROM log""",
    "texts": """
        SELECT "Query", min(ordinal) AS first_ordinal, count(*) AS n_rows,
               row_number() OVER (ORDER BY min(ordinal)) AS "UniqueID"
        FROM log GROUP BY "Query" """,
    "ruled": f"""
        SELECT *, {yes_no(is_question('"Query"'))} AS "Rules" FROM texts""",
    "labels": f"""
        SELECT "UniqueID", "Query", run_name, CASE WHEN ("Rules" = 'YES') <>
                   ({digit('run_name', '"Query"')} < '3') THEN 'YES' ELSE 'NO' END AS label
        FROM ruled, {RUN_TABLE} runs
        WHERE {digit("'gap'", 'run_name', '"Query"')} <> '0'""",
    "wide": "SELECT \"UniqueID\", "
    + ", ".join(
        f"max(label) FILTER (run_name = {text(r)}) AS \"{r}\"" for r in RUN_NAMES
    )
    + ' FROM labels GROUP BY "UniqueID"',
    "labelled": 'SELECT * FROM ruled LEFT JOIN wide USING ("UniqueID")',
    "eligible": 'SELECT * FROM labelled WHERE "Rules" = \'YES\' OR '
    + " OR ".join(f"\"{r}\" = 'YES'" for r in RUN_NAMES),
    "assigned": f"""
        SELECT run_name, "UniqueID", "Query", seed,
               CAST((rank - 1) // {BATCH_SIZE} AS BIGINT) AS batch_id,
               CAST((rank - 1) % {BATCH_SIZE} AS INTEGER) AS pos
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY run_name
                  ORDER BY CASE WHEN seed IS NULL THEN NULL
                           ELSE md5(seed || ':' || "UniqueID") END, "UniqueID") AS rank
              FROM texts, {RUN_TABLE} runs)""",
    "batches": """
        SELECT run_name, batch_id, count(*) AS n_queries,
               list("UniqueID" ORDER BY pos) AS ids, list("Query" ORDER BY pos) AS queries
        FROM assigned GROUP BY run_name, batch_id""",
    "items": f"""
        SELECT a.run_name, a.batch_id, a.pos, a."Query" AS query, {digit("'shape'", 'a.run_name', 'a.batch_id')} AS shape,
               length(a."Query") > 40 AS longer
        FROM assigned a""",
    "shaped": """
        SELECT run_name, batch_id, shape, count(*) AS n,
               list({query: query, explicit_question: CASE
                   WHEN shape = '8' THEN CASE WHEN longer THEN ' yes ' ELSE 'no' END
                   WHEN shape = '9' AND longer THEN NULL
                   WHEN longer THEN 'YES' ELSE 'NO' END} ORDER BY pos) AS items
        FROM items GROUP BY run_name, batch_id, shape""",
    "responses": """
        SELECT run_name, batch_id, CASE shape
            WHEN '0' THEN regexp_replace(CAST(to_json(items) AS VARCHAR), '\\]$', '')
            WHEN '1' THEN to_json(items) || ' [end]'
            WHEN '2' THEN '```json' || chr(10) || to_json(items) || chr(10) || '```'
            WHEN '3' THEN 'Sure:' || chr(10) || to_json(items) || chr(10) || 'Done.'
            WHEN '4' THEN CAST(to_json(items[1:n - 1]) AS VARCHAR)
            WHEN '5' THEN CAST(to_json(list_append(items,
                {query: 'extra', explicit_question: 'YES'})) AS VARCHAR)
            WHEN '6' THEN NULL
            WHEN '7' THEN ''
            ELSE CAST(to_json(items) AS VARCHAR) END AS raw
        FROM shaped""",
    "candidates": """
        SELECT run_name, batch_id, raw, regexp_extract(raw, '(?s)\\[.*\\]') AS body
        FROM responses""",
    "parsed": """
        SELECT run_name, batch_id, raw,
               CASE WHEN body <> '' AND json_valid(body)
                    THEN json_extract(body, '$[*]') END AS items
        FROM candidates""",
    "answers": """
        SELECT run_name, batch_id, unnest(items) AS item,
               CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS pos
        FROM parsed WHERE items IS NOT NULL""",
    "given": f"""
        SELECT run_name, batch_id, pos, {strip("json_extract_string(item, '$.query')")} AS echo,
               upper({strip("coalesce(json_extract_string(item, '$.explicit_question'), 'NO')")}) AS label
        FROM answers""",
    "aligned": """
        SELECT a."UniqueID", run_name, batch_id, pos, g.label,
               g.echo = a."Query" AS echo_matches
        FROM assigned a JOIN given g USING (run_name, batch_id, pos)""",
    "triage_in": f"""
        SELECT "UniqueID", "Query", model, {digit("'triage'", 'model', '"Query"')} AS d,
               {digit("'question'", 'model', '"Query"')} AS e
        FROM eligible, {MODEL_TABLE} models""",
    "triage_raw": """
        SELECT "UniqueID", "Query", model, CASE
            WHEN d < '4' THEN 'Category: Foreground' || chr(10) || 'Reasoning: names ' || "Query" || ' ' || chr(10) || 'and more '
            WHEN d < '7' THEN '"''category:  [BACKGROUND]' || chr(10) || 'reasoning:' || "Query" || '''"'
            WHEN d < 'a' THEN chr(10) || ' Category:' || chr(10) || ' unrelated topic ' || chr(10) || 'Reasoning: ' || chr(10) || ' none '
            WHEN d = 'a' THEN 'Category: Other  ' || chr(10) || 'Reasoning: unsure'
            WHEN d = 'b' THEN 'I cannot tell.'
            WHEN d = 'c' THEN ''
            WHEN d = 'd' THEN 'Reasoning: Category: background and foreground'
            END AS raw, CASE
            WHEN e < '4' THEN ' "Error: Intervention too vague." '
            WHEN e < '5' THEN ''
            ELSE ' "''Should ' || trim("Query") || ' vs no treatment be used?''"' || chr(10)
            END AS raw_question
        FROM triage_in""",
    "triage_found": f"""
        SELECT "UniqueID", "Query", model, raw, raw_question,
               coalesce({strip(f"regexp_extract({strip_quotes('raw')}, '(?i)Category:{BLANK}*(.+)', 1)")}, '') AS found,
               coalesce({strip(f"regexp_extract({strip_quotes('raw')}, '(?is)Reasoning:{BLANK}*(.+)', 1)")}, '') AS reasoning
        FROM triage_raw""",
    "triage": f"""
        SELECT "UniqueID", "Query", model, CASE
                   WHEN lower(found) LIKE '%foreground%' THEN 'Foreground'
                   WHEN lower(found) LIKE '%background%' THEN 'Background'
                   WHEN lower(found) LIKE '%unrelated%' THEN 'Unrelated'
                   ELSE found END AS category, reasoning,
               coalesce({strip_quotes('raw_question')}, '') AS answer
        FROM triage_found""",
    "triaged": """
        SELECT "UniqueID", "Query", model, category, reasoning,
               CASE WHEN category = 'Foreground' THEN answer ELSE '' END AS question
        FROM triage""",
    "triage_wide": 'SELECT "UniqueID", "Query", '
    + ", ".join(
        f"coalesce(nullif(max({field}) FILTER (model = {text(m)}), ''), 'N/A') "
        f'AS "{prefix}_{m}"'
        for m in MODELS
        for prefix, field in (
            ("ARIA_Category", "category"),
            ("ARIA_Reasoning", "reasoning"),
            ("GRADE_Question", "question"),
        )
    )
    + ' FROM triaged GROUP BY "UniqueID", "Query"',
    "ratings": f"""
        SELECT d.doc_id, CAST({is_question('d.text')} AS INTEGER) AS rules,
               l.quality, l.toxic,
               CAST(d.n_chars >= {LONG_TEXT} AS INTEGER) AS long_text,
               CAST(regexp_matches(d.text, '[0-9]') AS INTEGER) AS has_digit
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "rated": """
        SELECT *, greatest(quality, toxic) AS any_manual,
               greatest(rules, long_text, has_digit) AS any_derived
        FROM ratings""",
    "votes": "\n UNION ALL ".join(
        f"SELECT doc_id AS id, {text(r)} AS rater, CAST({r} AS VARCHAR) AS rating "
        f"FROM rated WHERE {r} IS NOT NULL"
        for r in [*DOC_RATERS, "any_manual", "any_derived"]
    ),
    "run_votes": "\n UNION ALL ".join(
        f"SELECT \"UniqueID\" AS id, {text(r)} AS rater, "
        f"CAST(CAST(\"{r}\" = 'YES' AS INTEGER) AS VARCHAR) AS rating "
        f'FROM labelled WHERE "{r}" IS NOT NULL'
        for r in ["Rules", *RUN_NAMES]
    )
    + "\n UNION ALL SELECT \"UniqueID\", 'any_run', CAST(max(CAST(label = 'YES' AS INTEGER)) AS VARCHAR)"
    + ' FROM labels GROUP BY "UniqueID"',
    "many_votes": f"""
        SELECT doc_id AS id, rater, CAST(CAST(rules <> errs AS INTEGER) AS VARCHAR) AS rating
        FROM (SELECT doc_id, rater, {is_question('text')} AS rules, {digit('rater', 'doc_id')} AS d,
                     {digit('rater', 'doc_id')} < '3' AS errs
              FROM documents, {table_of("rater", [f"({text(r)})" for r in MANY_RATERS])} m)
        WHERE d <> 'f' OR doc_id % 2 = 0""",
    "model_votes": "\n UNION ALL ".join(
        f"SELECT \"UniqueID\" AS id, model AS rater, category AS rating FROM triaged "
        f"WHERE model = {text(m)} AND category <> ''"
        for m in MODELS
    ),
}

LOG = ["cells", "log"]
TEXTS = [*LOG, "texts"]
LABELS = [*TEXTS, "ruled", "labels"]
LABELLED = [*LABELS, "wide", "labelled"]
ELIGIBLE = [*LABELLED, "eligible"]
ASSIGNED = [*TEXTS, "assigned"]
PARSED = [*ASSIGNED, "items", "shaped", "responses", "candidates", "parsed"]
GIVEN = [*PARSED, "answers", "given"]
ALIGNED = [*GIVEN, "aligned"]
TRIAGE = [*ELIGIBLE, "triage_in", "triage_raw", "triage_found", "triage"]
TRIAGED = [*TRIAGE, "triaged"]
WIDE = [*TRIAGED, "triage_wide"]
RATED = ["ratings", "rated"]
VOTES = [*RATED, "votes"]


def using(ctes: list[str], select: str, **more: str) -> str:
    parts = [f"{name} AS ({CTE[name]})" for name in ctes]
    parts += [f"{name} AS ({body})" for name, body in more.items()]
    return f"WITH {', '.join(parts)}\n{select}"


def set_rows(rater_sets: dict[str, list[str]]) -> str:
    return table_of(
        "rater_set, rater",
        [f"({text(s)}, {text(r)})" for s, rs in rater_sets.items() for r in rs],
    )


def category_sums(votes: str, rater_sets: dict[str, list[str]]) -> str:
    return f"""
        SELECT rater_set, rating AS category, CAST(sum(n * (n - 1)) AS BIGINT) AS agreeing,
               CAST(sum(n * (k - 1)) AS BIGINT) AS possible
        FROM (SELECT rater_set, id, rating, count(*) AS n,
                     sum(count(*)) OVER (PARTITION BY rater_set, id) AS k
              FROM {votes} JOIN {set_rows(rater_sets)} s USING (rater)
              GROUP BY rater_set, id, rating)
        GROUP BY rater_set, rating"""


RATIO = "agreeing / nullif(possible, 0)"
PAIRS = "SELECT *, n_same / n_both AS value FROM pairs"
OVERALL = f"""SELECT *, {RATIO} AS value FROM (
    SELECT rater_set, CAST(sum(agreeing) AS BIGINT) AS agreeing,
           CAST(sum(possible) AS BIGINT) AS possible
    FROM sums GROUP BY rater_set)"""


def pair_sums(raters: list[str], votes: str = "votes") -> str:
    ranks = table_of("rater, r", [f"({text(x)}, {i})" for i, x in enumerate(raters)])
    return f"""
        SELECT a.rater AS rater_i, b.rater AS rater_j,
               count(*) FILTER (a.rating = b.rating) AS n_same, count(*) AS n_both
        FROM ({votes} JOIN {ranks} p USING (rater)) a JOIN ({votes} JOIN {ranks} q USING (rater)) b
          ON a.id = b.id AND a.r <= b.r
        GROUP BY a.rater, b.rater"""


def kappa(votes: str, raters: list[str]) -> dict[str, str]:
    """Pair table, totals and margins of Cohen's kappa over complete cases."""
    ranks = table_of("rater, r", [f"({text(x)}, {i})" for i, x in enumerate(raters)])
    return {
        "full_cases": f"""
            SELECT v.*, p.r FROM {votes} v JOIN {ranks} p USING (rater)
            QUALIFY count(*) OVER (PARTITION BY id) = {len(raters)}""",
        "cells2": """
            SELECT a.rater AS rater_i, b.rater AS rater_j, a.rating AS ci, b.rating AS cj,
                   CAST(count(*) AS HUGEINT) AS n
            FROM full_cases a JOIN full_cases b ON a.id = b.id AND a.r < b.r GROUP BY ALL""",
        "rows2": "SELECT rater_i, rater_j, ci AS c, sum(n) AS nr FROM cells2 GROUP BY ALL",
        "cols2": "SELECT rater_i, rater_j, cj AS c, sum(n) AS nc FROM cells2 GROUP BY ALL",
        "chance": """
            SELECT rater_i, rater_j, sum(nr * nc) AS e
            FROM rows2 JOIN cols2 USING (rater_i, rater_j, c) GROUP BY ALL""",
        "totals": """
            SELECT rater_i, rater_j, sum(n) AS t, coalesce(sum(n) FILTER (ci = cj), 0) AS d
            FROM cells2 GROUP BY ALL""",
        "kappas": """
            SELECT rater_i, rater_j, CAST(t AS BIGINT) AS n_cases,
                   CAST(d * t - coalesce(e, 0) AS DOUBLE)
                   / nullif(CAST(t * t - coalesce(e, 0) AS DOUBLE), 0) AS kappa
            FROM totals LEFT JOIN chance USING (rater_i, rater_j)""",
    }


def display(x: str) -> str:
    cases = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in DISPLAY.items())
    return f"CASE {x} {cases} ELSE {x} END"


def light(name: str, raters: list[str]) -> str:
    inner = using(VOTES, "SELECT avg(kappa) AS kappa FROM kappas", **kappa("votes", raters))
    return f"SELECT 'kappa' AS figure, {text(name)} AS name, round(kappa, 9) AS value FROM ({inner})"


def oracles() -> dict[str, str]:
    wide_columns = ", ".join(f'w."{r}"' for r in RUN_NAMES)
    rater_columns = ", ".join(DOC_RATERS)
    long_message = text(CLASSIFY.lead + "\n")
    system = text(CLASSIFY.system)
    call_digit = "substr(md5(model || ':' || \"Query\"), 1, 1)"
    called = f"""
        SELECT "UniqueID", "Query", model, CASE
                   WHEN d = 'f' THEN '' WHEN d < '8' THEN 'Foreground' ELSE 'Background'
               END AS category,
               CASE WHEN d = 'f' THEN '' ELSE 'starts with ' || d END AS reasoning,
               CASE WHEN d >= '8' THEN '' WHEN d < '2' THEN 'Error: Intervention too vague.'
                    ELSE {strip_quotes("'Should ' || \"Query\" || '?'")} END AS question,
               CASE WHEN d = 'f' THEN 'no answer' END AS error
        FROM (SELECT "UniqueID", "Query", model, {call_digit} AS d FROM eligible, {MODEL_TABLE} m)"""
    job_wide = "SELECT \"UniqueID\", " + ", ".join(
        f"max(label) FILTER (run_name = {text(r)}) AS \"{r}\"" for r in RUN_NAMES
    ) + ' FROM aligned GROUP BY "UniqueID"'
    job_labelled = 'SELECT * FROM ruled LEFT JOIN job_wide USING ("UniqueID")'
    job_eligible = 'SELECT * FROM job_labelled WHERE "Rules" = \'YES\' OR ' + " OR ".join(
        f"\"{r}\" = 'YES'" for r in RUN_NAMES
    )
    job_called = called.replace("FROM eligible", "FROM job_eligible")
    job_triage = 'SELECT "UniqueID", ' + ", ".join(
        f"coalesce(nullif(max({field}) FILTER (model = {text(m)}), ''), 'N/A') "
        f'AS "{prefix}_{m}"'
        for m in MODELS
        for prefix, field in (
            ("ARIA_Category", "category"),
            ("ARIA_Reasoning", "reasoning"),
            ("GRADE_Question", "question"),
        )
    ) + ' FROM job_called GROUP BY "UniqueID"'
    triage_names = [
        f"{prefix}_{m}"
        for m in MODELS
        for prefix in ("ARIA_Category", "ARIA_Reasoning", "GRADE_Question")
    ]

    def na(columns: list[str]) -> str:
        return ", ".join(
            f"coalesce(CAST(\"{c}\" AS VARCHAR), 'N/A') AS \"{c}\"" for c in columns
        )

    model_sets = {"models": MODELS, "first": ["north", "south"], "last": ["south", "west"]}
    job = {
        "job_wide": job_wide,
        "job_labelled": job_labelled,
        "job_eligible": job_eligible,
        "job_called": job_called,
        "job_triage": job_triage,
    }
    # Without rule labels a text is eligible by its model labels alone.
    bare = job | {"job_eligible": job_eligible.replace("\"Rules\" = 'YES' OR ", "")}

    turns = f"""
        SELECT conv_id * 4294967296 + turn AS ordinal, role, {clean('text')} AS "Query"
        FROM conversations"""
    turn_texts = """
        SELECT "Query", row_number() OVER (ORDER BY min(ordinal)) AS "UniqueID"
        FROM turns GROUP BY "Query" """
    turn_runs = table_of(
        "run_name, seed", ["('LLM_run1_x', NULL)", "('LLM_run2_x', 's')"]
    )
    turn_batches = f"""
        SELECT run_name, "UniqueID", "Query", (rank - 1) // 7 AS batch_id
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY run_name
                  ORDER BY CASE WHEN seed IS NULL THEN NULL
                           ELSE md5(seed || ':' || "UniqueID") END, "UniqueID") AS rank
              FROM turn_texts, {turn_runs} r)"""
    turn_labels = """
        SELECT run_name, "UniqueID",
               CASE WHEN bool_or(contains("Query", '@')) OVER (PARTITION BY run_name, batch_id)
                    THEN NULL WHEN length("Query") > 40 THEN 'YES' ELSE 'NO' END AS label
        FROM turn_batches"""

    return {
        "normalize_text": f"SELECT doc_id, {clean('text')} AS text_norm FROM documents",
        "nfkc_fullwidth": "SELECT doc_id, text AS folded FROM documents",
        "clean_log": using(LOG, "SELECT * FROM log"),
        "letter_case": using(
            ["cells"],
            f"""SELECT doc_id * 4294967296 + pos AS ordinal,
                lower({strip("nullif(cell, '')")}) AS lower_text,
                upper(replace({strip("nullif(cell, '')")}, 'ß', 'SS')) AS upper_text FROM cells""",
        ),
        "rule_labels": using(
            [*LOG, "questions"],
            f'SELECT *, {yes_no(is_question(chr(34) + "Query" + chr(34)))} AS "Rules" FROM questions',
        ),
        "rule_conditions": using(
            [*LOG, "questions"],
            "SELECT ordinal, "
            + ", ".join(f"{c} AS {n}" for n, c in conditions('"Query"').items())
            + " FROM questions",
        ),
        "rule_fired": using(
            [*LOG, "questions"],
            "SELECT lang, CASE "
            + " ".join(f"WHEN {c} THEN '{n}'" for n, c in conditions('"Query"').items())
            + " ELSE 'none' END AS rule, count(*) AS n_rows FROM questions GROUP BY ALL",
        ),
        "rule_labels_whole_texts": f"""
            SELECT doc_id, lang, {yes_no(is_question('text'))} AS "Rules" FROM documents""",
        "rule_rate_by_lang": using(
            [*TEXTS, "ruled"],
            """SELECT lang, "Rules", count(*) AS n_rows, count(DISTINCT "UniqueID") AS n_texts
               FROM log JOIN ruled USING ("Query") GROUP BY lang, "Rules" """,
        ),
        "dedup_ids": using(TEXTS, "SELECT * FROM texts"),
        "keep_first_by_key": """
            SELECT * FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
        "file_order": f"""
            SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place,
                   CAST(length({clean('text')}) AS INTEGER) AS n_kept FROM documents""",
        "run_matrix": using(
            TEXTS, f'SELECT "UniqueID", run_name, seed FROM texts, {RUN_TABLE} runs'
        ),
        "batch_assign": using(
            ASSIGNED,
            'SELECT run_name, "UniqueID", batch_id, pos FROM assigned WHERE seed IS NULL',
        ),
        "batch_assign_shuffled": using(
            ASSIGNED,
            'SELECT run_name, "UniqueID", batch_id, pos FROM assigned WHERE seed IS NOT NULL',
        ),
        "batch_size_table": using(
            ASSIGNED,
            "SELECT run_name, batch_id, count(*) AS n_queries FROM assigned GROUP BY ALL",
        ),
        "batch_prompts": using(
            [*ASSIGNED, "batches"],
            f"""SELECT run_name, batch_id, CAST(n_queries AS INTEGER) AS n_queries, {text(PREAMBLE)} ||
                array_to_string(list_transform(queries, lambda q: '- ' || q || chr(10)), '') AS prompt
                FROM batches""",
        ),
        "batch_members": using(
            [*ASSIGNED, "batches"],
            "SELECT run_name, batch_id, array_to_string(ids, ' ') AS members FROM batches",
        ),
        "triage_prompts": using(
            ELIGIBLE,
            f"""SELECT "UniqueID", {system} AS system_prompt,
                {long_message} || "Query" AS user_prompt,
                {system} || chr(10) || chr(10) || {long_message} || "Query" AS single_prompt
                FROM eligible""",
        ),
        "parse_responses": using(GIVEN, "SELECT * FROM given"),
        "dead_letter": using(
            PARSED,
            """SELECT run_name, batch_id, raw, CAST(NULL AS VARCHAR) AS error
               FROM parsed WHERE items IS NULL""",
        ),
        "dead_letter_append": using(
            PARSED,
            """SELECT run_name, count(*) AS n_batches, count(raw) AS n_with_text
               FROM parsed WHERE items IS NULL GROUP BY run_name""",
        ),
        "align_labels": using(ALIGNED, "SELECT * FROM aligned"),
        "batch_label_udf": using(
            ASSIGNED,
            """SELECT run_name, batch_id, "UniqueID",
                      CASE WHEN length("Query") > 40 THEN 'YES' ELSE 'NO' END AS label,
                      NULL AS error
               FROM (SELECT *, bool_or(contains("Query", '@')) OVER (
                         PARTITION BY run_name, batch_id) AS bad FROM assigned)
               WHERE NOT bad
               UNION ALL
               SELECT run_name, batch_id, NULL, NULL, 'personal data' FROM assigned
               GROUP BY run_name, batch_id HAVING bool_or(contains("Query", '@'))""",
        ),
        "batch_call_udf": using(
            ASSIGNED,
            """SELECT "UniqueID", run_name, batch_id, pos,
                      CASE WHEN length("Query") > 40 THEN 'YES' ELSE 'NO' END AS label,
                      true AS echo_matches
               FROM (SELECT *, bool_or(contains("Query", '@')) OVER (
                         PARTITION BY run_name, batch_id) AS bad FROM assigned)
               WHERE NOT bad AND run_name NOT LIKE '%beta%'""",
        ),
        "wide_labels": using(
            [*LABELS, "wide"], "SELECT *, CAST(NULL AS VARCHAR) AS \"LLM_run1_absent\" FROM wide"
        ),
        "attached_labels": using(LABELLED, "SELECT * FROM labelled"),
        "merge_back": using(
            LABELLED,
            f"""SELECT log.*, w."UniqueID", w."Rules", {wide_columns}
                FROM log LEFT JOIN labelled w USING ("Query")""",
        ),
        "eligible": using(ELIGIBLE, 'SELECT "UniqueID", "Query" FROM eligible'),
        "eligible_from_long": using(
            LABELS,
            """SELECT "UniqueID", "Query" FROM texts
               WHERE "UniqueID" IN (SELECT "UniqueID" FROM labels WHERE label = 'YES')""",
        ),
        "triage_parse": using(
            TRIAGE, 'SELECT "UniqueID", model, category, reasoning FROM triage'
        ),
        "triage_foreground": using(
            TRIAGE, "SELECT \"UniqueID\", model FROM triage WHERE category = 'Foreground'"
        ),
        "model_list": using(
            ELIGIBLE, f'SELECT "UniqueID", model FROM eligible, {MODEL_TABLE} m'
        ),
        "question_cleanup": using(
            TRIAGE,
            """SELECT "UniqueID", model, answer AS question,
                      answer = 'Error: Intervention too vague.' AS too_vague FROM triage""",
        ),
        "triage_two_stage": using(TRIAGED, "SELECT * FROM triaged"),
        "triage_wide": using(WIDE, "SELECT * FROM triage_wide"),
        "triage_report": using(
            TRIAGED,
            """SELECT model, category, count(*) AS n_texts,
                      count(*) FILTER (question = 'Error: Intervention too vague.') AS n_too_vague
               FROM triaged GROUP BY ALL""",
        ),
        "triage_merge_na": using(
            WIDE,
            "SELECT "
            + na(["UniqueID", "first_ordinal", "n_rows", "Rules", *RUN_NAMES, *triage_names])
            + """, l."Query" FROM labelled l
               LEFT JOIN (SELECT * EXCLUDE ("Query") FROM triage_wide) t USING ("UniqueID")""",
        ),
        "triage_call_udf": using(ELIGIBLE, called),
        "rating_pattern_counts": using(
            RATED, "SELECT * EXCLUDE (doc_id), count(*) AS n_cases FROM rated GROUP BY ALL"
        ),
        "long_document_ratings": using(
            ["ratings"],
            " UNION ALL ".join(
                f"SELECT doc_id, {text(r)} AS rater, {r} AS rating FROM ratings"
                for r in DOC_RATERS
            ),
        ),
        "wide_document_ratings": using(
            ["ratings"], f"SELECT doc_id, {rater_columns} FROM ratings"
        ),
        "agreement_overall": using(
            VOTES,
            f"""SELECT *, {RATIO} AS value FROM (
                    SELECT rater_set, CAST(sum(agreeing) AS BIGINT) AS agreeing,
                           CAST(sum(possible) AS BIGINT) AS possible
                    FROM sums GROUP BY rater_set)""",
            sums=category_sums("votes", {"all": DOC_RATERS}),
        ),
        "agreement_subsets": using(
            VOTES,
            f"""SELECT *, {RATIO} AS value FROM (
                    SELECT rater_set, CAST(sum(agreeing) AS BIGINT) AS agreeing,
                           CAST(sum(possible) AS BIGINT) AS possible
                    FROM sums GROUP BY rater_set)""",
            sums=category_sums("votes", RATER_SETS),
        ),
        "agreement_specific": using(
            VOTES,
            f"SELECT * REPLACE (CAST(category AS INTEGER) AS category), {RATIO} AS value FROM sums",
            sums=category_sums("votes", RATER_SETS),
        ),
        "agreement_pairs": using(
            VOTES, "SELECT *, n_same / n_both AS value FROM pairs", pairs=pair_sums(DOC_RATERS)
        ),
        "agreement_matrix_long": using(
            VOTES,
            f"""SELECT {display('a')} AS rater_i, {display('b')} AS rater_j, value,
                       round(value, 2) AS value_label
                FROM (SELECT rater_i AS a, rater_j AS b, n_same / n_both AS value FROM pairs
                      UNION SELECT rater_j, rater_i, n_same / n_both FROM pairs)""",
            pairs=pair_sums(DOC_RATERS),
        ),
        "agreement_matrix_square": using(
            VOTES,
            "SELECT rater_i, "
            + ", ".join(f"max(value) FILTER (rater_j = {text(r)}) AS {r}" for r in DOC_RATERS)
            + """ FROM (SELECT rater_i, rater_j, n_same / n_both AS value FROM pairs
                  UNION SELECT rater_j, rater_i, n_same / n_both FROM pairs) GROUP BY rater_i""",
            pairs=pair_sums(DOC_RATERS),
        ),
        "kappa_pairs": using(VOTES, "SELECT * FROM kappas", **kappa("votes", DOC_RATERS)),
        "kappa_light": using(
            VOTES,
            "SELECT count(*) AS n_pairs, round(avg(kappa), 9) AS kappa FROM kappas",
            **kappa("votes", DOC_RATERS),
        ),
        "agreement_runs": using(
            [*LABELLED, "run_votes"],
            f"SELECT * REPLACE (CAST(category AS INTEGER) AS category), {RATIO} AS value FROM sums",
            sums=category_sums(
                "run_votes",
                {"all": ["Rules", *RUN_NAMES], "runs": RUN_NAMES, "any": ["Rules", "any_run"]},
            ),
        ),
        "agreement_categories": using(
            [*TRIAGED, "model_votes"],
            f"SELECT *, {RATIO} AS value FROM sums",
            sums=category_sums("model_votes", model_sets),
        ),
        "agreement_category_subsets": using(
            [*TRIAGED, "model_votes"],
            OVERALL,
            sums=category_sums("model_votes", model_sets),
        ),
        "agreement_pairs_many": using(["many_votes"], PAIRS, pairs=pair_sums(MANY_RATERS, "many_votes")),
        "kappa_pairs_many": using(
            ["many_votes"], "SELECT * REPLACE (round(kappa, 9) AS kappa) FROM kappas", **kappa("many_votes", MANY_RATERS)
        ),
        "agreement_category_pairs": using(
            [*TRIAGED, "model_votes"], PAIRS, pairs=pair_sums(MODELS, "model_votes")
        ),
        "kappa_categories": using(
            [*TRIAGED, "model_votes"], "SELECT * FROM kappas", **kappa("model_votes", MODELS)
        ),
        "review_sample": using(
            TEXTS,
            f"""SELECT "UniqueID", "Query" FROM texts
                ORDER BY md5('review:' || "UniqueID"), "UniqueID" LIMIT {SAMPLE_SIZE}""",
        ),
        "review_sample_by_lang": f"""
            WITH sizes AS (SELECT lang, count(*) AS n, least({SAMPLE_SIZE}, sum(count(*)) OVER ()) AS wanted,
                                  sum(count(*)) OVER () AS total FROM documents GROUP BY lang),
                 shares AS (SELECT lang, n * wanted // total AS least, n * wanted % total AS over, wanted FROM sizes),
                 quotas AS (SELECT lang, least + CAST(row_number() OVER (ORDER BY over DESC, lang NULLS FIRST)
                                   <= wanted - sum(least) OVER () AS INTEGER) AS quota FROM shares)
            SELECT doc_id, lang FROM (
                SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('review:' || doc_id), doc_id) AS place
                FROM documents) JOIN quotas USING (lang) WHERE place <= quota""",
        "detection_counts": using(
            [*ALIGNED, "ruled"],
            """SELECT (SELECT count(*) FROM log) AS log_rows,
                      (SELECT count(*) FROM texts) AS distinct_texts,
                      (SELECT count(*) FROM job_eligible) AS eligible_texts,
                      (SELECT count(*) FROM log JOIN job_eligible USING ("Query")) AS eligible_rows""",
            job_wide=job_wide, job_labelled=job_labelled, job_eligible=job_eligible,
        ),
        "stage_funnel": using(
            ELIGIBLE,
            """SELECT (SELECT count(*) FROM log) AS log_rows,
                      (SELECT count(*) FROM texts) AS distinct_texts,
                      (SELECT count(*) FROM eligible) AS eligible_texts,
                      (SELECT count(*) FROM log JOIN eligible USING ("Query")) AS eligible_rows""",
        ),
        "log_head": using(LOG, f"SELECT * FROM log ORDER BY ordinal LIMIT {SLICE}"),
        "log_tail": using(LOG, f"SELECT * FROM log ORDER BY ordinal DESC LIMIT {SLICE}"),
        "csv_roundtrip": using(
            ["ratings"],
            f"SELECT {rater_columns}, count(*) AS n_cases FROM ratings GROUP BY ALL",
        ),
        "csv_log_order": f"""
            SELECT conv_id, turn, {clean('text')} AS "Query" FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
        "detection_job": using(
            [*ALIGNED, "ruled"],
            f"""SELECT log.*, r."UniqueID", r."Rules", {wide_columns}
                FROM log LEFT JOIN ruled r USING ("Query")
                LEFT JOIN job_wide w USING ("UniqueID")""",
            job_wide=job_wide,
        ),
        "detection_job_calls": f"""
            WITH turns AS ({turns}), turn_texts AS ({turn_texts}),
                 turn_batches AS ({turn_batches}), turn_labels AS ({turn_labels})
            SELECT t.ordinal, t.role, t."Query", u."UniqueID",
                   {yes_no(is_question('t."Query"'))} AS "Rules",
                   a.label AS "LLM_run1_x", b.label AS "LLM_run2_x", CAST(NULL AS VARCHAR) AS "LLM_run1_off"
            FROM turns t JOIN turn_texts u USING ("Query")
            LEFT JOIN turn_labels a ON a."UniqueID" = u."UniqueID" AND a.run_name = 'LLM_run1_x'
            LEFT JOIN turn_labels b ON b."UniqueID" = u."UniqueID" AND b.run_name = 'LLM_run2_x'""",
        "detection_job_files": using(
            [*ALIGNED, "ruled"],
            f"""SELECT log.doc_id, log."Query", r."UniqueID", r."Rules", {wide_columns}
                FROM log LEFT JOIN ruled r USING ("Query")
                LEFT JOIN job_wide w USING ("UniqueID")""",
            job_wide=job_wide,
        ).replace(CTE["cells"], "SELECT 1").replace(
            CTE["log"],
            f"""SELECT doc_id AS ordinal, doc_id, {clean("regexp_extract(text, '^[^.]*')")} AS "Query"
                FROM documents""",
        ),
        "detection_job_resumed": f"""
            WITH turns AS ({turns}), turn_texts AS ({turn_texts}), turn_batches AS ({turn_batches}),
                 asked AS (SELECT run_name, batch_id, NOT bool_or(contains("Query", '@')) AS usable
                           FROM turn_batches GROUP BY run_name, batch_id)
            SELECT run_name, CAST(r AS INTEGER) AS "round", usable, count(*) AS n_batches
            FROM asked, range(1, 3) AS t(r) WHERE r = 1 OR NOT usable GROUP BY ALL""",
        "triage_call_limit": using(
            ELIGIBLE,
            """SELECT "UniqueID", "Query", 'slow' AS model,
                      CASE WHEN hangs THEN '' ELSE 'Background' END AS category,
                      CASE WHEN hangs THEN '' ELSE 'answered' END AS reasoning, '' AS question,
                      CASE WHEN hangs THEN 'no answer within 2 s' END AS error
               FROM (SELECT *, substr(md5('slow:' || "Query"), 1, 2) = '00' AS hangs FROM eligible)""",
        ),
        "ratings_short_rows": """
            SELECT CAST(doc_id AS INTEGER) AS doc_id, CASE WHEN doc_id % 3 <> 0 THEN quality END AS quality,
                   CASE WHEN doc_id % 3 <> 0 THEN toxic END AS toxic FROM labels""",
        "triage_job": using(
            [*ALIGNED, "ruled"],
            'SELECT "UniqueID", "Query", '
            + na(["Rules", *RUN_NAMES, *triage_names])
            + ' FROM job_labelled LEFT JOIN job_triage USING ("UniqueID")',
            **job,
        ),
        "triage_from_log": using(
            [*ALIGNED, "ruled"],
            'SELECT "UniqueID", "Query", '
            + na(["Rules", *RUN_NAMES, *triage_names])
            + ' FROM job_labelled LEFT JOIN job_triage USING ("UniqueID")',
            **job,
        ),
        "triage_from_buckets": using(
            [*ALIGNED, "ruled"],
            'SELECT "UniqueID", "Query", '
            + na(["Rules", *RUN_NAMES, *triage_names])
            + ' FROM job_labelled LEFT JOIN job_triage USING ("UniqueID")',
            **job,
        ),
        "triage_from_log_without_rules": using(
            [*ALIGNED, "ruled"],
            'SELECT "UniqueID", "Query", '
            + na([*RUN_NAMES, *triage_names])
            + ' FROM job_labelled LEFT JOIN job_triage USING ("UniqueID")',
            **bare,
        ),
        "ratings_cells": """
            SELECT CAST(doc_id AS INTEGER) AS doc_id, quality, toxic FROM labels""",
        "study_job": using(
            VOTES,
            f"""SELECT 'overall' AS figure, rater_set AS name,
                       CAST(sum(agreeing) AS BIGINT) / CAST(sum(possible) AS BIGINT) AS value
                FROM sums GROUP BY rater_set
                UNION ALL SELECT 'specific ' || category, rater_set, {RATIO} FROM sums
                UNION ALL SELECT 'pair', {display('a')} || '/' || {display('b')}, value
                FROM (SELECT rater_i AS a, rater_j AS b, n_same / n_both AS value FROM pairs
                      UNION SELECT rater_j, rater_i, n_same / n_both FROM pairs)
                """
            + "".join(f" UNION ALL {light(n, rs)}" for n, rs in RATER_SETS.items()),
            sums=category_sums("votes", RATER_SETS),
            pairs=pair_sums([*DOC_RATERS, "any_manual", "any_derived"]),
        ),
    }
