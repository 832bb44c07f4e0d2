"""DuckDB SQL for the registered queries.

Every query has its twin here.
"""

from __future__ import annotations

from pagelathe.functions import prompts as P
from pagelathe.functions import text as X
from pagelathe.operators import agents

WS = "".join(f"\\x{{{ord(c):x}}}" for c in X.SPACES)
WORD = r"\p{L}\p{N}_"


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {q(X.SPACES)})"


def letter(x: str) -> str:
    return f"nullif(regexp_extract(upper({x}), '[ABCDE]'), '')"


def dotted(words) -> str:
    """Alternation that ignores case, dotted and dotless i included."""
    return "(?i:" + "|".join("".join("[İIiı]" if c in "İI" else c for c in w) for w in words) + ")"


PAIRS = f"""
WITH side AS (
  SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN ' ' || chr(10) || chr(9)
                      ELSE chr(9) || ' ' || text || chr(160) END AS t
  FROM documents),
raw AS (
  SELECT doc_id // 2 AS pair, max(CASE WHEN doc_id % 2 = 0 THEN t END) AS en, max(CASE WHEN doc_id % 2 = 1 THEN t END) AS tr
  FROM side GROUP BY 1),
pairs AS (
  SELECT pair, CASE pair % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split,
         {strip("coalesce(en, '')")} AS en, {strip("coalesce(tr, '')")} AS tr FROM raw),
kept AS (SELECT * FROM pairs WHERE en <> '' AND tr <> '' AND least(length(en), length(tr)) >= 5 AND greatest(length(en), length(tr)) <= 2000),
examples AS (
  SELECT split, 2 * pair AS ex_id, 'English' AS src_lang, 'Turkish' AS tgt_lang, en AS src, tr AS tgt FROM kept
  UNION ALL
  SELECT split, 2 * pair + 1, 'Turkish', 'English', tr, en FROM kept)
"""

DIRECTED = PAIRS + ", directed AS (SELECT *, CASE src_lang WHEN 'English' THEN 'en2tr' ELSE 'tr2en' END AS direction FROM examples)"

SCORED = DIRECTED + """,
scored AS (SELECT *, least(length(src), length(src))::DOUBLE / greatest(length(tgt), length(src), 1) AS seg_score FROM directed)
"""

SCORES = SCORED + """,
ours AS (SELECT direction, avg(seg_score) AS score, count(*) AS n FROM scored GROUP BY 1),
rates AS (SELECT avg(quality) AS q, avg(toxic) AS t FROM labels),
compared AS (
  SELECT direction, score, n,
         CASE direction WHEN 'tr2en' THEN t END AS zero_shot,
         CASE direction WHEN 'en2tr' THEN q END AS maps,
         CASE direction WHEN 'en2tr' THEN t ELSE q END AS rag
  FROM ours CROSS JOIN rates)
"""

EXCHANGES = """
WITH talk AS (
  SELECT u.conv_id, u.turn, u.text, a.text AS reply
  FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')
"""


def chat(role: str, content: str) -> str:
    return f"'{P.TURN_START}{role}' || chr(10) || {content} || '{P.TURN_END.strip()}' || chr(10)"


REPLY = f"'{P.TURN_START}assistant' || chr(10)"


def translation_chat(src: str, src_lang: str, tgt_lang: str) -> str:
    ask = f"'Translate the following text from ' || {src_lang} || ' to ' || {tgt_lang} || ':' || chr(10) || chr(10) || {src}"
    return chat("system", q(P.TRANSLATION_SYSTEM)) + " || " + chat("user", f"({ask})")


def words(x: str, n: int | str) -> str:
    return f"array_to_string(list_slice(regexp_split_to_array({strip(x)}, '[{WS}]+'), 1, {n}), ' ')"


def n_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{WS}]+'))"


def clean(x: str) -> str:
    x = f"replace({x}, chr(13), '')"
    x = rf"regexp_replace({x}, '-\n([{WORD}])', '\1', 'g')"
    x = rf"regexp_replace({x}, '(?m)^[{WS}]*\p{{Nd}}{{1,4}}[{WS}]*$', '', 'g')"
    x = rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    return strip(x)


END = dotted(X.END_HEADINGS)
CONTENTS = dotted(X.CONTENTS_HEADINGS)
_ORDINALS, _CHAPTERS = dotted(X.CHAPTER_ORDINALS), dotted(X.CHAPTER_WORDS)
HEADING = rf"(?:{dotted(X.OPENING_HEADINGS)}|{_ORDINALS}[{WS}]*\.[{WS}]*{_CHAPTERS}|{_CHAPTERS}[{WS}]*1)"


def trim_ctes(source: str, keys: str) -> str:
    """CTEs that end in ``trimmed`` (keys, text, trimmed_front, trimmed_end)."""
    front = rf"(?s)^((|.*?[^{WORD}]){CONTENTS}(?:[^{WORD}]|[^{WORD}].*?[^{WORD}])){HEADING}(?:[^{WORD}].*)?$"
    return rf"""
tail AS (SELECT {keys}, text, length(text) AS n, length(regexp_extract(text, '(?s)^(.*[^{WORD}])?{END}(?:[^{WORD}].*)?$', 1)) AS pos FROM {source}),
body AS (SELECT *, CASE WHEN pos > 0.7::DOUBLE * n THEN pos ELSE n END AS cut FROM tail),
found AS (SELECT {keys}, n, cut, substr(text, 1, cut) AS text,
                 length(regexp_extract(substr(text, 1, cut), '{front}', 1)) AS head,
                 length(regexp_extract(substr(text, 1, cut), '{front}', 2)) AS toc FROM body),
placed AS (SELECT *, CASE WHEN head > 0 AND toc < 0.2::DOUBLE * n AND head < 0.3::DOUBLE * n THEN head ELSE 0 END AS trimmed_front FROM found),
trimmed AS (SELECT {keys}, substr(text, trimmed_front + 1) AS text, trimmed_front, n - cut AS trimmed_end FROM placed)
"""


def noise(x: str) -> str:
    s = strip(x)
    return rf"""CASE WHEN length({s}) < 150 THEN 'short'
  WHEN len(regexp_extract_all({s}, '\.{{3,}}[{WS}]*\p{{Nd}}+')) >= 2 THEN 'dot_leaders'
  WHEN length(regexp_replace({s}, '[\p{{L}}\p{{N}}{WS}]+', '', 'g'))::DOUBLE / length({s}) > 0.4::DOUBLE THEN 'symbols' END"""


# Where to cut, size and overlap of chunks, and what counts as white space at a chunk's ends.
SEPARATORS = ("chr(10) || chr(10)", "chr(10)", "'. '", "'! '", "'? '", "' '")
SIZE, OVERLAP = 800, 120
SPACES = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))


def packed_ctes(source: str, key: str) -> str:
    """CTEs that end in ``packed`` (key, chunk_no, text): pieces between
    separators, coarse to fine, joined up to the size with an overlap.

    ``seg`` are parts still to be cut, ``cut`` their pieces by start and end;
    small neighbours form a run, long ones go to the next separator.  ``step``
    walks the edges of a run, chunk by chunk.  Needs WITH RECURSIVE.
    """
    parts = [f"uncut AS (SELECT {key}, coalesce(text, '') AS body FROM {source}), seg0 AS (SELECT {key}, 0 AS lo, length(body) AS hi FROM uncut)"]
    for n, sign in enumerate(SEPARATORS):
        parts.append(f"""
part{n} AS (SELECT {key}, lo, hi, string_split(substr(body, lo + 1, hi - lo), {sign}) AS p FROM seg{n} JOIN uncut USING ({key})),
flat{n} AS (SELECT {key}, lo, hi, unnest(p) AS piece, unnest(range(0, len(p))) AS i FROM part{n} WHERE len(p) > 1),
edge{n} AS (
  SELECT {key}, lo, hi, i, lo + CASE WHEN i = 0 THEN 0 ELSE (sum(length(piece)) OVER w)::BIGINT - length(piece) + (i - 1) * length({sign}) END AS a
  FROM flat{n} WINDOW w AS (PARTITION BY {key}, lo ORDER BY i)),
whole{n} AS (SELECT {key}, lo, a, coalesce(lead(a) OVER (PARTITION BY {key}, lo ORDER BY i), hi) AS b FROM edge{n}),
cut{n} AS (SELECT *, (count(*) FILTER (b - a >= {SIZE}) OVER (PARTITION BY {key}, lo ORDER BY a)) AS island FROM whole{n} WHERE b > a),
run{n} AS (SELECT {key}, list_prepend(min(a), list(b ORDER BY a)) AS e FROM cut{n} WHERE b - a < {SIZE} GROUP BY {key}, lo, island),
seg{n + 1} AS (
  SELECT {key}, a AS lo, b AS hi FROM cut{n} WHERE b - a >= {SIZE} UNION ALL SELECT {key}, lo, hi FROM part{n} WHERE len(p) <= 1)""")
    last = len(SEPARATORS)
    runs = " UNION ALL ".join([*(f"SELECT * FROM run{n}" for n in range(last)), f"SELECT {key}, range(lo, hi + 1) AS e FROM seg{last}"])
    parts.append(f"""
runs AS MATERIALIZED (SELECT row_number() OVER () AS run, {key}, e FROM ({runs}) WHERE len(e) > 1),
step AS (
  SELECT run, 1::BIGINT AS f, 1 + len(list_filter(e[2:{SIZE} + 1], lambda x: x <= e[1] + {SIZE})) AS l FROM runs
  UNION ALL
  SELECT run, f, f + len(list_filter(e[f + 1:f + {SIZE}], lambda x: x <= e[f] + {SIZE})) AS l FROM (
    SELECT run, e, least(f + len(list_filter(e[f:l], lambda x: x < greatest(e[l] - {OVERLAP}, e[l + 1] - {SIZE}))), l) AS f FROM step JOIN runs USING (run) WHERE l < len(e))),
chunked AS (SELECT {key}, e[1] AS start, f, trim(substr(body, e[f] + 1, e[l] - e[f]), {SPACES}) AS text FROM step JOIN runs USING (run) JOIN uncut USING ({key})),
packed AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY start, f) - 1 AS chunk_no, text FROM chunked WHERE text <> '')""")
    return ",".join(parts)


def stride_cte(source: str, keys: str) -> str:
    return f"""
windows AS (SELECT {keys}, text, unnest(range(0, greatest(1, ceil((length(text) - 120) / 680.0))::BIGINT)) AS chunk_no FROM {source} WHERE text <> ''),
chunks AS (SELECT {keys}, chunk_no, {strip("substr(text, chunk_no * 680 + 1, 800)")} AS text FROM windows)
"""


NOISY_CHUNKS = f"""
WITH {stride_cte("documents", "doc_id, lang")},
noisy AS (
  SELECT doc_id, lang, chunk_no, CASE (doc_id + chunk_no) % 4 WHEN 1 THEN translate(text, 'enatir', '#%*=+~')
    WHEN 2 THEN text || ' ..... 12 and .... 13' ELSE text END AS text FROM chunks WHERE text <> ''),
marked AS (SELECT doc_id, lang, chunk_no, {noise("text")} AS drop_reason FROM noisy)
"""

NOISY = """
noisy AS (
  SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, 'en', 'e-' || chr(13) || chr(10) || 'n')
    WHEN 1 THEN replace(text, '. ', '.' || repeat(chr(10), 4) || ' 12 ' || repeat(chr(10), 2))
    ELSE replace(text, ' ', ' ' || chr(9) || ' ') END AS text FROM documents)
"""

HEADED = """
headed AS (
  SELECT doc_id, CASE doc_id % 6
    WHEN 0 THEN text
    WHEN 1 THEN text || chr(10) || 'Kaynakça' || chr(10) || left(text, length(text) // 10)
    WHEN 2 THEN 'İçindekiler ' || left(text, length(text) // 10) || chr(10) || '1 . Ünite' || chr(10) || text
    WHEN 3 THEN 'İçindekiler ' || left(text, length(text) // 10) || chr(10) || '1 . Ünite' || chr(10) || text
                || chr(10) || 'Kaynakça' || chr(10) || left(text, length(text) // 10)
    WHEN 4 THEN left(text, length(text) // 2) || ' DİZİN ' || substr(text, length(text) // 2 + 1)
    ELSE text || ' içindekiler GİRİŞ ' || text END AS text
  FROM documents)
"""


def exam(fields: bool) -> str:
    """CTEs that end in ``items`` with a drop_reason."""
    option = lambda i: f"list_extract(string_split(text, ' '), {i})"
    given = [
        option(1),
        f"CASE WHEN doc_id % 3 = 0 THEN '' ELSE {option(2)} END",
        f"' ' || {option(3)} || ' '",
        f"CASE WHEN doc_id % 5 = 0 THEN NULL ELSE {option(4)} END",
        f"CASE WHEN doc_id % 4 IN (0, 1) THEN NULL ELSE {option(5)} END",
    ]
    choices = ", ".join(
        f"struct_pack(letter := '{c}', text := {strip(g)})" for c, g in zip("ABCDE", given)
    )
    filtered = "subject IS NOT NULL AND lower(" + strip("subject") + ") NOT IN ('history', 'tarih')" if fields else "FALSE"
    return f"""
raw AS (
  SELECT doc_id, text, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN ' Tarih ' ELSE 'Fizik' END AS subject,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END AS question,
    CASE doc_id % 8 WHEN 0 THEN ' b) x' WHEN 1 THEN '1' WHEN 2 THEN '5' WHEN 3 THEN 'Doğru: B' WHEN 4 THEN 'Z' WHEN 5 THEN NULL WHEN 6 THEN '٢' ELSE '4' END AS said
  FROM documents),
listed AS (SELECT *, list_filter([{choices}], lambda c: coalesce(c.text, '') <> '') AS choices FROM raw),
counted AS (SELECT *, len(choices) AS k, {strip("upper(said)")} AS s FROM listed),
lettered AS (
  SELECT *, CASE WHEN s = '٢' OR regexp_full_match(s, '[0-9]+') THEN
        CASE WHEN replace(s, '٢', '2')::INT < k THEN substr('ABCDE', replace(s, '٢', '2')::INT + 1, 1)
             WHEN replace(s, '٢', '2')::INT = k THEN substr('ABCDE', k, 1) END
      ELSE {letter("s")} END AS answer
  FROM counted),
items AS (
  SELECT doc_id AS qa_id, CASE WHEN subject IS NULL OR subject = '' THEN 'History' ELSE {strip("subject")} END AS subject,
    {strip("question")} AS question,
    array_to_string(list_transform(choices, lambda c: c.letter || ') ' || c.text), chr(10)) AS choices,
    answer, coalesce(list_contains(list_transform(choices, lambda c: c.letter), answer), FALSE) AS answer_in_choices,
    CASE WHEN question IS NULL OR said IS NULL THEN 'no_question_or_answer' WHEN {filtered} THEN 'other_subject'
         WHEN k < 2 THEN 'too_few_choices' WHEN answer IS NULL THEN 'no_answer_letter' END AS drop_reason
  FROM lettered)
"""


MARKED = f"""
WITH marked AS (
  SELECT CASE role WHEN 'user' THEN 'zero_shot' ELSE 'rag' END AS mode, conv_id, turn, text, substr('ABCDE', conv_id % 5 + 1, 1) AS answer,
         {letter("text")} AS prediction
  FROM conversations WHERE role <> 'system'),
judged AS (SELECT *, prediction IS NOT DISTINCT FROM answer AS correct FROM marked),
per_mode AS (SELECT mode, count(*) AS n, count(*) FILTER (WHERE correct) AS correct, (count(*) FILTER (WHERE correct))::DOUBLE / count(*) AS accuracy FROM judged GROUP BY 1)
"""

KNN = """
SELECT q.vec_id AS qa_id, b.vec_id AS chunk_id, list_distance(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
FROM embeddings q CROSS JOIN embeddings b
"""
RANKED_KNN = f"WITH d AS ({KNN}), r AS (SELECT *, row_number() OVER (PARTITION BY qa_id ORDER BY round(d * d, 12), chunk_id) AS rank FROM d)"


def counts(x: str) -> str:
    """Letter counts scaled to length one, in single precision."""
    raw = "[" + ", ".join(f"(length(lower({x})) - length(replace(lower({x}), '{c}', '')))::DOUBLE" for c in "abcdefghijklmnopqrstuvwxyz") + "]"
    return raw


def unit(v: str) -> str:
    norm = f"sqrt(list_dot_product({v}, {v}))"
    return f"list_transform({v}, lambda c: CASE WHEN {norm} = 0 THEN 0 ELSE c / {norm} END::FLOAT)"


RAG = f"""
WITH RECURSIVE {packed_ctes("documents", "doc_id")},
kb AS (SELECT doc_id::BIGINT * 4294967296 + chunk_no AS chunk_id, text, {counts("('passage: ' || text)")} AS v
       FROM packed WHERE text <> '' AND {noise("text")} IS NULL),
kbn AS (SELECT chunk_id, text, {unit("v")} AS e FROM kb),
ask AS (SELECT item_id AS qa_id, text AS question, string_split(text, ' ') AS w, {counts("('query: ' || text)")} AS v FROM benchmark),
askn AS (SELECT qa_id, {unit("v")} AS e FROM ask),
pairs AS (SELECT qa_id, chunk_id, text, list_distance(a.e::DOUBLE[], k.e::DOUBLE[]) AS d FROM askn a CROSS JOIN kbn k),
top AS (SELECT *, row_number() OVER (PARTITION BY qa_id ORDER BY round(d * d, 12), chunk_id) AS rank FROM pairs QUALIFY rank <= 5),
context AS (SELECT qa_id, string_agg('[' || rank || '] ' || regexp_replace(text, '^passage: ', ''), chr(10) || chr(10) ORDER BY rank) AS context FROM top GROUP BY 1)
"""

ITEMS = """
items AS (SELECT item_id AS qa_id, text AS question, substr('ABCDE', item_id % 5 + 1, 1) AS answer,
  array_to_string(list_transform([1, 2, 3, 4, 5], lambda i: substr('ABCDE', i, 1) || ') ' || list_extract(string_split(text, ' '), i)), chr(10)) AS choices
  FROM benchmark)
"""


def qa_chat(context: str) -> str:
    block = f"'{P.QUESTION_LABEL}' || question || chr(10) || chr(10) || choices || chr(10) || chr(10) || '{P.ANSWER_CUE}'"
    zero = chat("system", q(P.QA_SYSTEM)) + " || " + chat("user", f"({block})") + " || " + REPLY
    with_context = f"'Bağlam:' || chr(10) || {context} || chr(10) || chr(10) || {block}"
    rag = chat("system", q(P.QA_CONTEXT_SYSTEM)) + " || " + chat("user", f"({with_context})") + " || " + REPLY
    return f"CASE WHEN {context} <> '' THEN {rag} ELSE {zero} END"


LOG = """
WITH log AS (
  SELECT (user_id % 10)::VARCHAR AS run_id, event_id AS seq, event_id * 25 AS step,
         CASE WHEN event_type = 'view' THEN value END AS loss, CASE WHEN event_type = 'error' THEN value END AS eval_loss FROM events),
evals AS (SELECT run_id, seq, step, eval_loss, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS eval_no FROM log WHERE eval_loss IS NOT NULL)
"""

PLATEAUS = LOG + """,
spread AS (
  SELECT *, CASE WHEN eval_no >= 5 THEN max(eval_loss) OVER w - min(eval_loss) OVER w END AS spread FROM evals
  WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
plateaus AS (SELECT run_id, seq, step, eval_loss, eval_no, spread, coalesce(spread <= 6.0, FALSE) AS plateau FROM spread)
"""

PROFILES = """
letters AS (SELECT lang, lower(text) AS t FROM documents),
grams AS (SELECT lang, substr(t, i, 3) AS gram FROM (SELECT lang, t, unnest(range(1, length(t) - 1)) AS i FROM letters)),
counted AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY 1, 2),
profiles AS (SELECT lang, gram, n FROM counted QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= 1000),
langs AS (SELECT DISTINCT lang FROM documents),
vocab AS (SELECT DISTINCT gram FROM profiles),
mass AS (SELECT lang, sum(n) AS m FROM profiles GROUP BY 1),
model AS (
  SELECT v.gram, l.lang, ln((coalesce(p.n, 0) + 1) / (m.m + (SELECT count(*) FROM vocab))::DOUBLE) AS logp
  FROM vocab v CROSS JOIN langs l JOIN mass m USING (lang) LEFT JOIN profiles p ON p.gram = v.gram AND p.lang = l.lang)
"""


def detect_ctes(source: str, key: str) -> str:
    """CTEs that end in ``detected`` (key, detected, confidence)."""
    return f"""
cut AS (SELECT {key}, substr(t, i, 3) AS gram FROM (SELECT {key}, lower(text) AS t, unnest(range(1, length(text) - 1)) AS i FROM {source})),
scored AS (SELECT {key}, lang, sum(logp) AS s FROM cut JOIN model USING (gram) GROUP BY 1, 2),
best AS (SELECT {key}, max(s) AS top, arg_max(lang, s) AS detected FROM scored GROUP BY 1),
sure AS (SELECT b.{key}, any_value(detected) AS detected, 1.0 / sum(exp(s - top)) AS confidence FROM best b JOIN scored s ON s.{key} = b.{key} GROUP BY 1),
detected AS (SELECT d.{key}, s.detected, coalesce(s.confidence, 0) AS confidence FROM {source} d LEFT JOIN sure s ON s.{key} = d.{key})
"""


TRACE = """
WITH lines AS (
  SELECT conv_id, turn, CASE WHEN role <> 'assistant' THEN [] WHEN conv_id % 3 = 0 AND turn = 3 THEN ['finish'] WHEN turn = 7 THEN ['search', 'finish']
    WHEN conv_id % 3 = 1 THEN ['search', 'search'] ELSE ['search'] END AS kinds FROM conversations),
flat AS (SELECT conv_id, turn, unnest(kinds) AS kind, unnest(range(0, len(kinds))) AS action_no FROM lines),
actions AS (
  SELECT conv_id, turn, action_no,
    CASE WHEN kind = 'finish' THEN 'finish' WHEN conv_id % 2 = 0 THEN 'turkish_rag_search' ELSE 'wikipedia_search' END AS tool,
    CASE WHEN kind = 'finish' THEN 'answer ' || conv_id ELSE 'c' || conv_id || ' (t' || turn || ')' END AS arg FROM flat)
"""

GUARD = TRACE + """
SELECT conv_id, turn, action_no, tool, arg,
  CASE WHEN tool <> 'finish' THEN (count(*) FILTER (WHERE tool <> 'finish') OVER w) END AS round,
  coalesce(tool <> 'finish' AND (count(*) FILTER (WHERE tool <> 'finish') OVER w) > 3, FALSE) AS over_limit,
  coalesce((count(*) FILTER (WHERE tool = 'finish') OVER (PARTITION BY conv_id ORDER BY turn, action_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) > 0, FALSE) AS after_finish
FROM actions WINDOW w AS (PARTITION BY conv_id ORDER BY turn, action_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

VERDICTS = f"""
WITH said AS (
  SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'REVISE: ' || text WHEN 2 THEN 'ok then' ELSE 'REVISE:' || text END AS s FROM conversations),
verdicts AS (
  SELECT conv_id, turn, CASE WHEN s = 'OK' THEN 'ok' WHEN s LIKE 'REVISE:%' THEN 'revise' ELSE 'unparsed' END AS verdict,
    CASE WHEN s LIKE 'REVISE:%' THEN {strip("substr(s, 8)")} END AS reason FROM said)
"""

DISPLAY = lambda c, sign="": f"coalesce(printf('%{sign}.4f', {c}), '—')"

ORACLE = {
    "kept_chunks_per_language": f"""
WITH RECURSIVE src AS (SELECT doc_id, lang, {clean("text")} AS text FROM documents), {trim_ctes("src", "doc_id, lang")}, {packed_ctes("trimmed", "doc_id, lang")}
SELECT lang, count(*) AS n_chunks, sum(length(text))::BIGINT AS n_chars FROM packed WHERE text <> '' AND {noise("text")} IS NULL GROUP BY 1""",
    "pairs_clean": PAIRS + "SELECT * FROM examples",
    "pairs_one_direction": PAIRS + "SELECT * FROM examples WHERE src_lang = 'English'",
    "pairs_sample": PAIRS + "SELECT * FROM examples ORDER BY md5(ex_id || '|42'), ex_id LIMIT 150",
    "pairs_cap": DIRECTED + "SELECT direction, ex_id, src FROM directed QUALIFY row_number() OVER (PARTITION BY src_lang ORDER BY ex_id) <= 100",
    "pairs_counts": DIRECTED
    + "SELECT coalesce(split, 'all') AS split, coalesce(direction, 'all') AS direction, count(*) AS n FROM directed GROUP BY ROLLUP (split, direction)",
    "pairs_preview": PAIRS
    + "SELECT ex_id, src_lang, tgt_lang, substr(src, 1, 140) AS src, substr(tgt, 1, 140) AS tgt FROM examples ORDER BY ex_id LIMIT 3",
    "chat_text": EXCHANGES
    + f"SELECT {translation_chat('text', q('English'), q('Turkish'))} || coalesce({chat('assistant', 'reply')}, '') AS text FROM talk",
    "chat_prompt": PAIRS
    + f"SELECT ex_id, {translation_chat('src', 'src_lang', 'tgt_lang')} || {REPLY} AS prompt FROM examples",
    "doc_assemble": """
WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
pages AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS no FROM lines)
SELECT 'book-' || doc_id AS source, string_agg(line, chr(10) ORDER BY no) AS text FROM pages GROUP BY doc_id""",
    "doc_clean": f"""
WITH noisy AS (
  SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, 'en', 'e-' || chr(13) || chr(10) || 'n')
    WHEN 1 THEN replace(text, '. ', '.' || repeat(chr(10), 4) || ' 12 ' || repeat(chr(10), 2))
    ELSE replace(text, ' ', ' ' || chr(9) || ' ') END AS text FROM documents)
SELECT doc_id, {clean("text")} AS text FROM noisy""",
    "doc_trim": f"WITH {HEADED}, {trim_ctes('headed', 'doc_id')} SELECT * FROM trimmed",
    "doc_trim_parts": f"""
WITH {HEADED}, {trim_ctes('headed', 'doc_id')}
SELECT doc_id, length(replace(text, chr(10), '')) AS kept_chars, trimmed_front, trimmed_end FROM trimmed""",
    "doc_body_parts": rf"""
WITH {HEADED},
lined AS (SELECT doc_id, regexp_replace(text, '((?:[^ \n]+ ){{12}})', '\1' || chr(10), 'g') AS t FROM headed),
noisy AS (
  SELECT 'book-' || doc_id AS source, CASE doc_id % 3 WHEN 0 THEN replace(t, ' ' || chr(10), chr(10))
    WHEN 1 THEN replace(t, 'en', 'e-' || chr(13) || chr(10) || 'n')
    ELSE replace(t, ' ' || chr(10), chr(10) || ' 12 ' || repeat(chr(10), 3)) END AS text FROM lined),
src AS (SELECT source, {clean("text")} AS text FROM noisy), {trim_ctes("src", "source")}
SELECT source, text FROM trimmed""",
    "chunk_stride": f"WITH {stride_cte('documents', 'doc_id')} SELECT doc_id, chunk_no, text FROM chunks WHERE text <> ''",
    "chunk_recursive": f"WITH RECURSIVE {packed_ctes('documents', 'doc_id')} SELECT doc_id, chunk_no, text FROM packed",
    "chunk_noisy": f"WITH RECURSIVE {NOISY}, {packed_ctes('noisy', 'doc_id')} SELECT doc_id, chunk_no, text FROM packed",
    "chunk_headed": f"WITH RECURSIVE {HEADED}, {trim_ctes('headed', 'doc_id')}, {packed_ctes('trimmed', 'doc_id')} SELECT doc_id, chunk_no, text FROM packed",
    "book_chunks": f"""
WITH RECURSIVE src AS (SELECT 'book-' || doc_id AS source, {clean("text")} AS text FROM documents), {trim_ctes("src", "source")}, {packed_ctes("trimmed", "source")}
SELECT source, chunk_no, text FROM packed WHERE {noise("text")} IS NULL""",
    "chunk_noise": NOISY_CHUNKS + "SELECT doc_id, chunk_no, drop_reason FROM marked",
    "noise_report": NOISY_CHUNKS
    + "SELECT lang, count(*) AS n_before, count(*) FILTER (WHERE drop_reason IS NULL) AS n_after, count(drop_reason) AS n_dropped FROM marked GROUP BY 1",
    "noise_reasons": NOISY_CHUNKS + "SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM marked GROUP BY 1",
    "qa_normalise_list": f"WITH {exam(False)} SELECT * EXCLUDE (drop_reason) FROM items WHERE drop_reason IS NULL",
    "qa_normalise_fields": f"WITH {exam(True)} SELECT * EXCLUDE (drop_reason) FROM items WHERE drop_reason IS NULL",
    "qa_drop_reasons": f"WITH {exam(True)} SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM items GROUP BY 1",
    "qa_marks": MARKED + "SELECT conv_id, turn, mode, answer, prediction, correct FROM judged",
    "qa_strict_letters": rf"""
SELECT conv_id, turn, nullif(regexp_extract(upper(text), '(?:^|[^{WORD}])([ABCDE])(?:[^{WORD}]|$)', 1), '') AS prediction FROM conversations""",
    "qa_accuracy": MARKED + "SELECT mode, n, correct, round(accuracy, 6) AS accuracy FROM per_mode",
    "mode_compare": MARKED
    + """SELECT z.n AS zero_shot_n, z.correct AS zero_shot_correct, round(z.accuracy, 6) AS zero_shot_accuracy, r.n AS rag_n, r.correct AS rag_correct,
  round(r.accuracy, 6) AS rag_accuracy, 5::BIGINT AS top_k, round((r.accuracy - z.accuracy) * 100, 6) AS delta_pp,
  printf('%+.2f', (r.accuracy - z.accuracy) * 100) AS delta_text
FROM (SELECT * FROM per_mode WHERE mode = 'zero_shot') z CROSS JOIN (SELECT * FROM per_mode WHERE mode = 'rag') r""",
    "knn_topk": RANKED_KNN + "SELECT qa_id, rank, chunk_id, round(d, 6) AS distance FROM r WHERE rank <= 5",
    "articles_topk": RANKED_KNN.replace("FROM embeddings q CROSS JOIN embeddings b", "FROM embeddings q CROSS JOIN embeddings b JOIN documents ON doc_id = b.vec_id")
    + "SELECT qa_id, rank, chunk_id AS article_id, round(d, 6) AS distance, left(text, 1500) AS text FROM r JOIN documents ON doc_id = chunk_id WHERE rank <= 2",
    "rag_context": RAG + "SELECT item_id AS qa_id, coalesce(context, '') AS context FROM benchmark LEFT JOIN context ON qa_id = item_id",
    "rag_prompts": f"""
WITH {ITEMS}, asked AS (SELECT *, CASE WHEN qa_id % 2 = 0 THEN '[1] ' || question ELSE '' END AS context FROM items)
SELECT qa_id, {qa_chat("context")} AS prompt, context <> '' AS used_context FROM asked""",
    "rag_answers": RAG
    + f""", {ITEMS}, prompted AS (SELECT i.*, {qa_chat("coalesce(context, '')")} AS prompt FROM items i LEFT JOIN context USING (qa_id)),
replied AS (SELECT qa_id, answer, substr('ABCDE', length(prompt) % 5 + 1, 1) AS prediction FROM prompted)
SELECT qa_id, prediction || ')' AS raw, prediction, prediction = answer AS correct FROM replied""",
    "zero_shot_accuracy": f"""
WITH {ITEMS}, prompted AS (SELECT answer, {qa_chat("''")} AS prompt FROM items),
judged AS (SELECT substr('ABCDE', length(prompt) % 5 + 1, 1) = answer AS correct FROM prompted)
SELECT 'zero_shot' AS mode, count(*) AS n, count(*) FILTER (WHERE correct) AS correct, round((count(*) FILTER (WHERE correct))::DOUBLE / count(*), 6) AS accuracy FROM judged""",
    "direction_scores": SCORES + "SELECT direction, round(score, 6) AS score, n FROM ours",
    "score_compare": SCORES
    + """SELECT direction, round(score, 6) AS score, n, round(zero_shot, 6) AS zero_shot, round(maps, 6) AS maps, round(rag, 6) AS rag,
  round(score - maps, 6) AS delta FROM compared""",
    "score_table": SCORES
    + f"SELECT direction, {DISPLAY('zero_shot')} AS zero_shot, {DISPLAY('maps')} AS maps, {DISPLAY('rag')} AS rag, {DISPLAY('score')} AS score, {DISPLAY('score - maps', '+')} AS delta FROM compared",
    "train_summary": LOG
    + """SELECT run_id, max(step) AS last_step, arg_max(loss, seq) FILTER (WHERE loss IS NOT NULL AND eval_loss IS NULL) AS train_loss,
  arg_max(eval_loss, seq) FILTER (WHERE eval_loss IS NOT NULL) AS eval_loss FROM log GROUP BY 1""",
    "eval_curve": LOG
    + """, best AS (
  SELECT *, eval_loss - lag(eval_loss) OVER (PARTITION BY run_id ORDER BY seq) AS change,
    min(eval_loss) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_loss,
    arg_min(step, eval_loss) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS any_step
  FROM evals),
firsts AS (SELECT run_id, eval_loss, min(step) AS first_step FROM evals GROUP BY 1, 2)
SELECT b.run_id, eval_no, step, b.eval_loss, round(change, 6) AS change, best_loss, first_step AS best_step, b.eval_loss <= best_loss + 0.5::DOUBLE AS in_band
FROM best b JOIN firsts f ON f.run_id = b.run_id AND f.eval_loss = b.best_loss""",
    "loss_plateaus": PLATEAUS + "SELECT run_id, seq, step, eval_loss, eval_no, round(spread, 6) AS spread, plateau FROM plateaus",
    "early_stop": PLATEAUS
    + "SELECT run_id, count(*) AS n_evals, min(step) FILTER (WHERE plateau) AS stop_step, min(eval_no) FILTER (WHERE plateau) AS stop_eval_no FROM plateaus GROUP BY 1",
    "model_generate": "SELECT doc_id, substr('ABCDE', length(text) % 5 + 1, 1) || ')' AS raw FROM documents",
    "model_embed": f"""
WITH c AS (SELECT doc_id, {counts("('passage: ' || text)")} AS v FROM documents), e AS (SELECT doc_id, {unit("v")} AS e FROM c)
SELECT doc_id, unnest(range(0, 26)) AS dim, round(unnest(e)::DOUBLE, 5) AS value FROM e""",
    "model_score": SCORED + "SELECT ex_id, round(seg_score, 6) AS seg_score FROM scored",
    "truncate_tokens": f"SELECT doc_id, {words('text', 512)} AS text FROM documents",
    "truncate_words": f"SELECT doc_id, {words('text', 512)} AS text FROM documents",
    "prompt_budget": f"""
WITH framed AS (SELECT doc_id, text, 96 - {n_words(translation_chat("''", "'English'", "'Turkish'") + " || " + REPLY)} AS room FROM documents),
cut AS (SELECT doc_id, CASE WHEN {n_words("text")} <= room THEN text ELSE {words("text", "room")} END AS src FROM framed)
SELECT doc_id AS ex_id, {translation_chat("src", "'English'", "'Turkish'")} || {REPLY} AS prompt FROM cut""",
    "training_budget": PAIRS
    + f""",
counted AS (
  SELECT *, {n_words("src")} AS a, {n_words("tgt")} AS b,
         96 - {n_words(translation_chat("''", "src_lang", "tgt_lang") + " || " + chat("assistant", "''"))} AS room FROM examples),
shared AS (
  SELECT *, CASE WHEN a <= b THEN room // 2 ELSE room - least(b, room // 2) END AS for_src,
         CASE WHEN a <= b THEN room - least(a, room // 2) ELSE room // 2 END AS for_tgt FROM counted)
SELECT ex_id, src_lang, tgt_lang, CASE WHEN a <= for_src THEN src ELSE {words("src", "for_src")} END AS src,
  CASE WHEN b <= for_tgt THEN tgt ELSE {words("tgt", "for_tgt")} END AS tgt FROM shared""",
    "batch_rows": """
WITH numbered AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch_no FROM documents)
SELECT batch_no, count(*) AS n_rows, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS doc_ids FROM numbered GROUP BY 1""",
    "language_profiles": f"WITH {PROFILES} SELECT lang, gram, n FROM profiles",
    "lang_detect": f"""
WITH {PROFILES}, {detect_ctes("documents", "doc_id")}
SELECT d.doc_id, detected, round(confidence, 6) AS confidence, CASE WHEN confidence >= 0.9 THEN detected ELSE lang END AS lang FROM detected d JOIN documents USING (doc_id)""",
    "lang_route": f"""
WITH {PROFILES}, {detect_ctes("documents", "doc_id")},
decided AS (SELECT CASE WHEN confidence >= 0.9 THEN detected ELSE lang END AS l FROM detected d JOIN documents USING (doc_id)),
named AS (SELECT CASE l WHEN 'de' THEN 'tr' ELSE l END AS lang FROM decided)
SELECT CASE lang WHEN 'tr' THEN 'turkish_rag_search' ELSE 'wikipedia_search' END AS tool, lang, count(*) AS n FROM named GROUP BY 1, 2""",
    "trace_actions": TRACE + "SELECT * FROM actions",
    "trace_guard": GUARD,
    "trace_guard_segmented": GUARD,
    "trace_answer": TRACE
    + "SELECT conv_id, arg_min(arg, turn * 1000 + action_no) FILTER (WHERE tool = 'finish') AS final_answer FROM actions GROUP BY 1",
    "verdicts": VERDICTS + "SELECT * FROM verdicts",
    "allowed_revisions": VERDICTS
    + "SELECT conv_id, turn, reason FROM verdicts WHERE verdict = 'revise' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1",
    "abstain_rate": f"""
WITH said AS (SELECT role, {strip("text")} IN ({q(agents.ABSTENTIONS[0])}, {q(agents.ABSTENTIONS[1])}) OR (conv_id + turn) % 5 < 2 AS a FROM conversations)
SELECT role, count(*) AS n, count(*) FILTER (WHERE a) AS n_abstained, round(avg(a::INT), 6) AS rate FROM said GROUP BY 1""",
    "lang_match": EXCHANGES
    + f""", sides AS (
  SELECT conv_id, turn, 'q' AS side, concat(conv_id, ':', turn, ':q') AS k, text FROM talk WHERE reply IS NOT NULL
  UNION ALL SELECT conv_id, turn, 'a', concat(conv_id, ':', turn, ':a'), reply FROM talk WHERE reply IS NOT NULL),
{PROFILES}, {detect_ctes("sides", "k")},
paired AS (
  SELECT q.conv_id, q.turn, dq.detected AS question_lang, da.detected AS answer_lang
  FROM sides q JOIN sides a ON a.conv_id = q.conv_id AND a.turn = q.turn AND q.side = 'q' AND a.side = 'a'
  JOIN detected dq ON dq.k = q.k JOIN detected da ON da.k = a.k)
SELECT *, question_lang IS NOT DISTINCT FROM answer_lang AS same_language FROM paired""",
    "vote": rf"""
WITH said AS (SELECT conv_id AS qa_id, nullif(regexp_extract(upper(text), '(?:^|[^{WORD}])([ABCDE])(?:[^{WORD}]|$)', 1), '') AS answer FROM conversations),
tally AS (SELECT qa_id, answer, count(answer) AS votes FROM said GROUP BY 1, 2)
SELECT qa_id, answer, votes, sum(votes) OVER (PARTITION BY qa_id)::BIGINT AS n_votes FROM tally
QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY votes DESC, answer IS NULL, answer) = 1""",
    "io_examples": PAIRS + "SELECT * EXCLUDE (split) FROM examples",
    "io_without_ids": PAIRS
    + f""",
bare AS (SELECT pair, split, raw.en, raw.tr FROM raw JOIN pairs USING (pair)),
twice AS (SELECT * FROM bare UNION ALL SELECT * FROM bare WHERE pair % 3 = 0),
named AS (
  SELECT *, md5(concat_ws('|', {", ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in ("split", "en", "tr"))})) AS digest FROM twice),
ided AS (
  SELECT digest || '-' || row_number() OVER (PARTITION BY digest) AS id, {strip("coalesce(en, '')")} AS en, {strip("coalesce(tr, '')")} AS tr FROM named),
good AS (SELECT * FROM ided WHERE en <> '' AND tr <> '' AND least(length(en), length(tr)) >= 5 AND greatest(length(en), length(tr)) <= 2000),
both_ways AS (
  SELECT id || '.0' AS ex_id, 'English' AS src_lang, 'Turkish' AS tgt_lang, en AS src, tr AS tgt FROM good
  UNION ALL SELECT id || '.1', 'Turkish', 'English', tr, en FROM good),
sample AS (SELECT * FROM both_ways ORDER BY md5(ex_id || '|42'), ex_id LIMIT 150)
SELECT * FROM sample QUALIFY row_number() OVER (PARTITION BY src_lang ORDER BY ex_id) <= 40""",
    "io_exam": f"""
WITH {exam(False)}
SELECT * EXCLUDE (drop_reason, answer_in_choices) FROM items WHERE drop_reason IS NULL AND qa_id % 4 = 0""",
    "io_summary": MARKED + "SELECT 'all' AS mode, count(*) AS n, count(*) FILTER (WHERE correct) AS correct FROM judged",
    "io_knowledge_base": f"""
WITH RECURSIVE src AS (SELECT doc_id, {clean("text")} AS text FROM documents), {trim_ctes("src", "doc_id")}, {packed_ctes("trimmed", "doc_id")}
SELECT doc_id, chunk_no, text, 'passage: ' || text AS embed_text, 26::BIGINT AS dims FROM packed WHERE text <> '' AND {noise("text")} IS NULL""",
    "io_direction_order": PAIRS
    + """SELECT ex_id, src_lang, row_number() OVER (ORDER BY CASE src_lang WHEN 'English' THEN 0 ELSE 1 END, ex_id) AS position, true AS in_order
FROM examples""",
    "io_source_order": """
SELECT 'book-' || doc_id AS source, row_number() OVER (ORDER BY 'book-' || doc_id) AS position, true AS in_order, length(text) AS n_chars
FROM documents""",
    "io_blank_lines": "SELECT conv_id, turn, role, text FROM conversations",
}
ORACLE["io_scores"] = ORACLE["score_compare"]
ORACLE["knn_blocked"] = ORACLE["knn_topk"]
