"""DuckDB SQL for the registered queries, written independently of the operators.

RE2 has no look-around and ASCII-only word boundaries, so boundaries are spelled
out as character classes around the tested word.
"""

from __future__ import annotations

import re

from corpusloom.functions import fixed_values as fx
from corpusloom.operators.bpe import byte_alphabet, byte_order
from corpusloom.operators.language import MICRO
from corpusloom.operators.perplexity import MIX
from corpusloom.plans.models import BPE_MERGES
from corpusloom.plans.registry import NEAR_WIDE, QUERY_SHARD


def _re2(pattern: str) -> str:
    """Java's \\uXXXX written the RE2 way; quotes doubled for a SQL literal."""
    return re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", pattern).replace("'", "''")


def _text(value: str) -> str:
    """SQL expression for a literal with any characters."""
    parts = [f"chr({ord(c)})" if not c.isprintable() or ord(c) > 126 else None for c in value]
    out, plain = [], ""
    for c, code in zip(value, parts):
        if code is None:
            plain += c.replace("'", "''")
        else:
            out += ([f"'{plain}'"] if plain else []) + [code]
            plain = ""
    out += [f"'{plain}'"] if plain or not out else []
    return "(" + " || ".join(out) + ")"


_S = _re2(f"[{fx.SPACE_CLASS}]")
_S_IN = _re2(fx.SPACE_CLASS)
_W = r"[\pL\pN_]"
_NW = r"[^\pL\pN_]"
_D = r"\p{Nd}"


def _all(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', {to}, 'g')"


def _strip(x: str) -> str:
    return _all(x, f"^{_S}+|{_S}+$", "''")


def _any(x: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, '{p}')" for p in patterns) + ")"


def _normalize(x: str) -> str:
    out = _all(x, r"[\x{200B}-\x{200D}\x{FEFF}]", "''")
    out = _all(out, r"\x{A0}", "' '")
    out = _all(out, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "' '")
    out = _all(out, r"[ \t]+", "' '")
    out = _all(out, r"\n\n\n+", "chr(10) || chr(10)")
    return _strip(out)


_TAG = rf"</?[A-Za-z][A-Za-z0-9]*({_S}+[^>]*)?>"


def _has_html(x: str) -> str:
    return _any(
        x,
        [_TAG, "&[A-Za-z]+;", rf"&#{_D}+;", rf"(?i)<(script|style)[{_S_IN}>]"],
    )


def _strip_html(x: str) -> str:
    out = _all(x, r"(?is)<script.*?>.*?</script>|<style.*?>.*?</style>", "' '")
    out = _all(out, r"(?s)<!--.*?-->", "' '")
    out = _all(out, _TAG, "' '")
    # The references these tables hold; the ampersand last, so nothing is decoded twice.
    for name, code in [
        ("quot;?", 34), ("copy;?", 169), ("middot;?", 183), ("lt;?", 60), ("gt;?", 62),
        ("#169;?", 169), ("#[xX]E9;?", 233), ("amp;?", 38),
    ]:
        out = _all(out, f"&{name}", f"chr({code})")
    return _strip(_all(out, f"{_S}+", "' '"))


def _lines(x: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex({x}, '{_re2(fx.LINE_BREAK)}'), "
        f"lambda l: {_strip('l')}), lambda l: l <> '')"
    )


_VISIBLE = "|".join(fx.VISIBILITY_WORDS)
_WEAK = [
    rf"^def{_S}+{_W}+{_S}*\(",
    rf"^return({_NW}|$)",
    rf"^function{_S}+{_W}+{_S}*\(",
    rf"#include{_S}+<{_W}+\.h>",
    rf"^fn{_S}+{_W}+{_S}*\(",
    rf"^({_VISIBLE}){_S}+{_W}+{_S}+{_W}+{_S}*\(",
]
_PLAIN_WORDS = "|".join(w for w in fx.CODE_KEYWORDS if w[0] != "#")
_STRONG = [
    "|".join(fx.FENCE_MARKERS),
    r"^[^A-Za-z0-9]{4,}$",
    r";$",
    r"[{}]",
    rf"{_S}{_W}+{_S}*={_S}*[^=]",
    rf"(^|{_NW})({_PLAIN_WORDS})({_NW}|$)",
    rf"{_W}#include({_NW}|$)",
    rf"^def{_S}+{_W}+{_S}*\(",
    rf"^from{_S}+{_W}",
    rf"^import{_S}+{_W}",
]


def _ratio(x: str, patterns: list[str]) -> str:
    lines = _lines(x)
    code = f"len(list_filter({lines}, lambda l: {_any('l', patterns)}))"
    return f"coalesce({code}::DOUBLE / nullif(len({lines}), 0), 0.0)"


_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_PHONES = [
    rf"(^|{_NW}){_D}[{_D}\-{_S_IN}]{{7,}}{_D}({_NW}|$)",
    rf"{_W}\+{_D}[{_D}\-{_S_IN}]{{7,}}{_D}({_NW}|$)",
]
_CARD = rf"(^|{_NW}){_D}([ -]*{_D}){{12,15}}({_NW}|$)"


def _pii(x: str) -> str:
    email, phone, card = fx.PII_LABELS
    return (
        f"list_filter([CASE WHEN {_any(x, [_EMAIL])} THEN '{email}' END, "
        f"CASE WHEN {_any(x, _PHONES)} THEN '{phone}' END, "
        f"CASE WHEN {_any(x, [_CARD])} THEN '{card}' END], lambda v: v IS NOT NULL)"
    )


# --- derived inputs ----------------------------------------------------------

_DOCS = "docs AS (SELECT doc_id AS ord, text, lang FROM documents)"

_N_LINES = "len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> ''))"
_ABOVE = f"(CAST(floor({_N_LINES} * 2 / 3.0) AS BIGINT) + 1)"
_NOISY = f"""noisy AS (
  SELECT doc_id AS ord, lang, CASE doc_id % 8
    WHEN 1 THEN '<div class="post"><P>' || replace(text, ' the ', ' &lt;the&gt; ')
      || '</p><!-- note' || chr(10)
      || ' --><br/>&amp; &copy; &#169; &#xE9;<SCRIPT>x()</script></div>'
    WHEN 2 THEN replace(text, chr(10), ';' || chr(10)) || ';'
    WHEN 3 THEN repeat('x = y;' || chr(10), greatest({_ABOVE} - 1, 0)) || text
    WHEN 4 THEN 'def total(items):' || chr(10) || '  return sum(items)' || chr(10) || text
      || repeat(chr(10) || '{{ fn (); }}', {_ABOVE})
    WHEN 5 THEN replace(replace(text, ' of ', chr(8203) || ' of' || chr(7) || chr(160)),
      ' de ', chr(65279) || chr(160) || 'de' || chr(11) || ' ')
    WHEN 6 THEN replace(replace(text, ', ', ',' || chr(9) || chr(9) || ' '),
      '. ', '.' || repeat(chr(10), 4))
    WHEN 7 THEN CASE (doc_id // 8) % 3 WHEN 0 THEN ' ' || chr(10) || chr(9) || ' ' || chr(8195)
      WHEN 1 THEN rpad(text, 199, 'x') ELSE rpad(text, 200, 'x') END
    ELSE text END AS text
  FROM documents
  UNION ALL
  SELECT -1 - page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1), html FROM pages)"""

_LINES_IN = """jlines AS (
  SELECT doc_id AS ord, text, CASE doc_id % 10
    WHEN 1 THEN to_json({'doc_id': doc_id, 'text': text})::VARCHAR || ','
    WHEN 2 THEN '  '
    WHEN 3 THEN '{"doc_id":' || doc_id || '}'
    WHEN 4 THEN '{"doc_id":' || doc_id || ',"text":null}'
    WHEN 5 THEN '{"text":' || doc_id || '}'
    WHEN 6 THEN '[' || doc_id || ']'
    WHEN 7 THEN '{"doc_id":' || doc_id || ',"text":" \\n"}'
    -- The line itself has NaN and 2,000 levels here, which this engine's parser does not take.
    WHEN 8 THEN '{"score":null,"at":[],' || substr(to_json({'doc_id': doc_id, 'text': text})::VARCHAR, 2)
    ELSE to_json({'doc_id': doc_id, 'text': text})::VARCHAR END AS value
  FROM documents)"""
_PARSED = (
    _LINES_IN
    + f""", typed AS (
  SELECT ord, value, CASE WHEN json_valid(value) AND {_strip('value')} <> ''
    THEN value::JSON END AS doc FROM jlines),
  fields AS (
  SELECT ord, doc, json_type(doc) AS kind, json_type(doc, '$.text') AS text_kind,
    doc ->> '$.text' AS raw_text FROM typed),
  texts AS (
  SELECT ord, doc, kind, CASE WHEN kind = 'OBJECT' AND text_kind IS NULL THEN ''
    WHEN text_kind = 'VARCHAR' THEN raw_text END AS text FROM fields),
  parsed AS (
  SELECT ord, text, CASE WHEN doc IS NULL THEN 'BAD_JSON'
      WHEN kind <> 'OBJECT' OR text IS NULL THEN 'MALFORMED'
      WHEN {_strip('text')} = '' THEN 'EMPTY' ELSE 'OK' END AS status,
    CASE WHEN kind = 'OBJECT' THEN list_distinct(json_keys(doc)) END AS keys
  FROM texts)"""
)


def _sampled(table: str, n: int) -> str:
    return (
        f"SELECT * FROM {table} ORDER BY md5(ord || ':7')[1:15], ord LIMIT {n}"
    )


# --- language ----------------------------------------------------------------


def _grams(source: str, key: str) -> str:
    """(key, gram) of all letter trigrams of `source`(key, text)."""
    words = _all("lower(text)", r"[^\pL]+", "' '")
    return f"""(SELECT {key}, unnest(list_transform(range(1, len(c) - 1),
      lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
    FROM (SELECT {key}, string_split(' ' || trim({words}) || ' ', '') AS c
      FROM {source} WHERE trim({words}) <> ''))"""


_PROFILE = f"""gram_n AS (
  SELECT lang, gram, count(*) AS n
  FROM {_grams('(SELECT upper(lang) AS lang, text FROM documents)', 'lang')} GROUP BY 1, 2),
  top_grams AS (
  SELECT gram FROM (SELECT gram, sum(n) AS n FROM gram_n GROUP BY 1)),
  lang_total AS (
  SELECT lang, sum(n)::BIGINT AS total FROM gram_n JOIN top_grams USING (gram) GROUP BY 1),
  profile AS (
  SELECT l.lang, t.gram, coalesce(g.n, 0)::BIGINT AS n,
    round(ln((coalesce(g.n, 0) + 1)::DOUBLE / (l.total + (SELECT count(*) FROM top_grams)))
      * {MICRO})::BIGINT AS weight
  FROM lang_total l CROSS JOIN top_grams t
  LEFT JOIN gram_n g ON g.lang = l.lang AND g.gram = t.gram)"""


def _detected(source: str, name: str) -> str:
    """CTEs giving `name`(ord, lang, score, known) over `source`(ord, text)."""
    return f"""{name}_sum AS (
  SELECT ord, lang, sum(c * weight)::BIGINT AS score, sum(c)::BIGINT AS known
  FROM (SELECT ord, gram, count(*) AS c FROM {_grams(source, 'ord')} GROUP BY 1, 2)
  JOIN profile USING (gram) GROUP BY 1, 2),
  {name}_best AS (
  SELECT ord, lang, score, known FROM {name}_sum
  QUALIFY row_number() OVER (PARTITION BY ord ORDER BY score DESC, lang) = 1),
  {name} AS (
  SELECT s.ord, coalesce(b.lang, '{fx.UNKNOWN_LANG}') AS lang,
    coalesce(b.score, 0) AS score, coalesce(b.known, 0) AS known
  FROM {source} s LEFT JOIN {name}_best b USING (ord))"""


# --- cleaning ----------------------------------------------------------------


def _verdicts(source: str, given: bool = False) -> str:
    """CTEs giving verdicts(ord, verdict, html_stripped, text)."""
    lang = (
        f"body_lang AS (SELECT ord, coalesce(upper(lang), '{fx.UNKNOWN_LANG}') AS lang FROM {source})"
        if given
        else f"{_PROFILE}, {_detected('bodies', 'body_lang')}"
    )
    return f"""stripped AS (SELECT ord, {_strip('text')} AS text FROM {source}),
  flagged AS (SELECT ord, text, {_has_html('text')} AS html_stripped FROM stripped),
  bodies AS (
  SELECT ord, html_stripped, text AS plain,
    CASE WHEN html_stripped THEN {_strip_html('text')} ELSE text END AS text FROM flagged),
  {lang},
  verdicts AS (
  SELECT b.ord, html_stripped, CASE WHEN plain = '' THEN 'EMPTY'
      WHEN l.lang <> '{fx.TARGET_LANG}' THEN 'NON_ENGLISH'
      WHEN {_ratio('b.text', _STRONG)} > {fx.CODE_HEAVY_ABOVE} THEN 'CODE_HEAVY'
      WHEN length(b.text) < {fx.MIN_CHARS} THEN 'TOO_SHORT'
      WHEN length(b.text) > {fx.MAX_CHARS} THEN 'TOO_LONG' ELSE 'KEPT' END AS verdict,
    {_normalize('b.text')} AS text
  FROM bodies b JOIN body_lang l USING (ord))"""


_SUMMARY = f"""counters AS (
  SELECT verdict AS counter, count(*) AS docs FROM verdicts GROUP BY 1
  UNION ALL
  SELECT '{fx.HTML_COUNTER}', count(*) FROM verdicts WHERE html_stripped HAVING count(*) > 0),
  summary AS (
  SELECT counter, docs, round(docs * 100.0::DOUBLE / sum(docs) OVER (), 6) AS pct_counters,
    round(docs * 100.0::DOUBLE / (SELECT count(*) FROM verdicts), 6) AS pct_docs FROM counters)"""

_HTML, _OUT = "html_stripped", "('CODE_HEAVY', 'TOO_SHORT', 'TOO_LONG')"
_UNREAD = "('CODE_HEAVY', 'TOO_SHORT', 'TOO_LONG', 'EMPTY', 'MALFORMED')"


def _edge(no: int, source: str, target: str, ref: str, flow: str) -> str:
    return (
        f"SELECT {no}::BIGINT AS edge, '{source}' AS source, '{target}' AS target, "
        f"count(*) FILTER ({ref}) AS ref_value, count(*) FILTER ({flow}) AS flow_value "
        f"FROM verdicts"
    )


_RAW, _PAGE, _ENGLISH, _FILTERED = fx.FLOW_NODES[:4]
_FLOW = " UNION ALL ".join(
    [
        _edge(1, _RAW, _PAGE, _HTML, _HTML),
        _edge(2, _RAW, _FILTERED, "verdict = 'NON_ENGLISH'",
              f"verdict = 'NON_ENGLISH' AND NOT {_HTML}"),
        _edge(3, _PAGE, _ENGLISH, "verdict = 'KEPT'", f"verdict = 'KEPT' AND {_HTML}"),
        _edge(4, _PAGE, _FILTERED, f"verdict IN {_OUT}", f"verdict <> 'KEPT' AND {_HTML}"),
        _edge(5, _RAW, _FILTERED, f"verdict IN {_UNREAD}",
              f"verdict IN {_UNREAD} AND NOT {_HTML}"),
    ]
)


# --- categories --------------------------------------------------------------


def _exclusive(source: str) -> str:
    return f"""clipped AS (SELECT ord, {_strip('text')} AS text FROM {source}),
  {_PROFILE}, {_detected('clipped', 'found')},
  classes AS (
  SELECT c.ord, CASE WHEN c.text = '' THEN 'EMPTY' WHEN {_has_html('c.text')} THEN 'HTML'
    WHEN {_ratio('c.text', _STRONG)} > {fx.CODE_HEAVY_ABOVE} THEN 'CODE_HEAVY'
    WHEN f.lang <> '{fx.TARGET_LANG}' THEN 'NON_ENGLISH_LANG'
    WHEN length(c.text) >= {fx.MIN_CHARS} THEN 'GOOD_ENGLISH' ELSE 'SHORT_ENGLISH' END AS category
  FROM clipped c JOIN found f USING (ord))"""


# --- words, toxicity, perplexity ---------------------------------------------

_WORDS = r"regexp_extract_all(lower(text), '\pL+')"
_TOXIC = f"""labelled AS (
  SELECT doc_id AS ord, text, toxic FROM documents JOIN labels USING (doc_id)),
  tok_n AS (
  SELECT token, count(*) FILTER (toxic = 1) AS n_toxic, count(*) FILTER (toxic = 0) AS n_clean
  FROM (SELECT toxic, unnest({_WORDS}) AS token FROM labelled) GROUP BY 1),
  tok_top AS (
  SELECT * FROM tok_n),
  tok_sum AS (
  SELECT sum(n_toxic)::BIGINT AS t, sum(n_clean)::BIGINT AS c, count(*) AS v FROM tok_top),
  toxic_model AS (
  SELECT token, n_toxic, n_clean, round((ln((n_toxic + 1)::DOUBLE / (t + v))
    - ln((n_clean + 1)::DOUBLE / (c + v))) * {MICRO})::BIGINT AS weight FROM tok_top, tok_sum
  UNION ALL
  SELECT '', n_toxic, n_clean, round(ln((n_toxic + 1)::DOUBLE / (n_clean + 1)) * {MICRO})::BIGINT
  FROM (SELECT count(*) FILTER (toxic = 1) AS n_toxic,
    count(*) FILTER (toxic = 0) AS n_clean FROM labelled)),
  toxic_scores AS (
  SELECT ord, log_odds, 1 / (1 + exp(-log_odds / {MICRO}.0::DOUBLE)) AS toxicity FROM (
    SELECT d.ord, (coalesce(s.w, 0) + (SELECT weight FROM toxic_model WHERE token = ''))::BIGINT
      AS log_odds
    FROM docs d LEFT JOIN (
      SELECT ord, sum(weight) AS w
      FROM (SELECT ord, unnest({_WORDS}) AS token FROM docs) JOIN toxic_model USING (token)
      GROUP BY 1) s USING (ord)))"""

_LM = f"""steps AS (
  SELECT ord, unnest(list_zip(w[:-2], w[2:])) AS s FROM (SELECT ord, {_WORDS} AS w FROM docs)
  WHERE len(w) > 1),
  uni AS (
  SELECT token, n FROM (SELECT token, count(*) AS n
    FROM (SELECT unnest({_WORDS}) AS token FROM docs) GROUP BY 1)),
  bi AS (
  SELECT prev, token, n FROM (SELECT s[1] AS prev, s[2] AS token, count(*) AS n FROM steps GROUP BY 1, 2)),
  lm_total AS (SELECT sum(len({_WORDS}))::BIGINT AS n FROM docs)"""
_PPL = f"""{_LM},
  losses AS (
  SELECT ord, sum(round(-ln({MIX}::DOUBLE * (coalesce(b.n, 0) / greatest(coalesce(p.n, 0), 1)::DOUBLE)
      + (1.0::DOUBLE - {MIX}::DOUBLE) * ((coalesce(u.n, 0) + 1)::DOUBLE
        / (t.n + (SELECT count(*) FROM uni) + 1))) * {MICRO})) AS loss, count(*) AS steps
  FROM (SELECT ord, s[1] AS prev, s[2] AS token FROM steps) x
  LEFT JOIN uni u ON u.token = x.token LEFT JOIN uni p ON p.token = x.prev
  LEFT JOIN bi b ON b.prev = x.prev AND b.token = x.token
    AND u.token IS NOT NULL AND p.token IS NOT NULL
  CROSS JOIN lm_total t GROUP BY 1),
  ppl AS (
  SELECT d.ord, exp(loss / (steps * {MICRO}.0::DOUBLE)) AS perplexity
  FROM docs d LEFT JOIN losses USING (ord))"""


# --- signatures --------------------------------------------------------------

_TOKENS = f"trim({_all('lower(text)', '[^a-z0-9]+', chr(39) + ' ' + chr(39))})"
_CHUNKS = f"""words AS (
  SELECT ord, CASE WHEN {_TOKENS} = '' THEN []::VARCHAR[] ELSE string_split({_TOKENS}, ' ') END AS w
  FROM docs),
  chunks AS (
  SELECT ord, p AS pos, array_to_string(w[p * 8 + 1:p * 8 + 8], ' ') AS chunk
  FROM (SELECT ord, w, unnest(range((len(w) + 7) // 8)) AS p FROM words))"""
_SIGS = f"""{_CHUNKS},
  hashes AS (SELECT ord, ('0x' || substr(md5(chunk), 17, 16))::UBIGINT AS h FROM chunks),
  bits AS (
  SELECT ord, b, 2 * sum((h >> b::UBIGINT) & 1) > count(*) AS bit
  FROM hashes, (SELECT unnest(range(64)) AS b) GROUP BY 1, 2),
  sums AS (
  SELECT ord, sum(CASE WHEN bit THEN CASE WHEN b = 63 THEN -(2::HUGEINT ** 63)::HUGEINT
    ELSE 1::HUGEINT << b::INT END ELSE 0 END)::BIGINT AS sig FROM bits GROUP BY 1),
  sigs AS (SELECT d.ord, coalesce(s.sig, 0) AS sig FROM docs d LEFT JOIN sums s USING (ord)),
  nodes AS (SELECT sig, min(ord) AS ord, count(*) AS docs FROM sigs GROUP BY 1)"""


def _pairs(threshold: int) -> str:
    return f"""WITH {_DOCS}, {_SIGS}
  SELECT a.ord AS ord_a, b.ord AS ord_b, bit_count(xor(a.sig, b.sig))::BIGINT AS distance
  FROM nodes a JOIN nodes b ON a.ord < b.ord AND bit_count(xor(a.sig, b.sig)) <= {threshold}"""


def _near(threshold: int) -> str:
    return f"""WITH RECURSIVE {_DOCS}, {_SIGS},
  ranked AS MATERIALIZED (SELECT ord, sig, row_number() OVER (ORDER BY ord) AS i FROM nodes),
  scan AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS kept, NULL::BIGINT AS ord
  UNION ALL
  SELECT r.i, CASE WHEN near THEN kept ELSE list_append(kept, r.sig) END,
    CASE WHEN near THEN NULL ELSE r.ord END
  FROM (SELECT r.i, r.ord, r.sig, s.kept,
      len(list_filter(s.kept, lambda k: bit_count(xor(k, r.sig)) <= {threshold})) > 0 AS near
    FROM scan s JOIN ranked r ON r.i = s.i + 1) r)
  SELECT ord FROM scan WHERE ord IS NOT NULL"""


# --- tokens and blocks -------------------------------------------------------

_WS = _re2(r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
# A white-space run before a word leaves its last character to the next match. A
# private-use mark takes the place of the missing look-ahead.
_MARK = chr(0xE000)


def _pretokens(x: str) -> str:
    marked = _all(x, f"([{_WS}]+)([{_WS}])([^{_WS}])", f"'\\1{_MARK}\\2\\3'")
    pattern = (
        rf"''(?:[sdmt]|ll|ve|re)| ?\pL+| ?\pN+| ?[^{_WS}\pL\pN{_MARK}]+|[{_WS}]+"
    )
    return f"regexp_extract_all({marked}, '{pattern}')"


_VOCAB = f"""pieces AS (SELECT ord, {_pretokens(_strip('text'))} AS p FROM docs WHERE {_strip('text')} <> ''),
  piece_n AS (SELECT token, count(*) AS n FROM (SELECT unnest(p) AS token FROM pieces) GROUP BY 1),
  vocab AS (
  SELECT token, (row_number() OVER (ORDER BY n DESC, token) - 1) AS id, n FROM piece_n
  ORDER BY n DESC, token LIMIT {fx.BASE_VOCAB_SIZE})"""


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


# One symbol between brackets that the byte alphabet does not hold, as one string per word.
_OPEN, _CLOSE = chr(0xE001), chr(0xE002)
_JOINT = _CLOSE + _OPEN


def _bytes(x: str) -> str:
    """The symbols of a token's bytes, bracketed."""
    byte = f"('0x' || substr(hex(encode({x})), (2 * i + 1)::INT, 2))::INT + 1"
    return f"array_to_string(list_transform(range(strlen({x})), lambda i: '{_OPEN}' || names[{byte}] || '{_CLOSE}'), '')"


def _joined(x: str) -> str:
    return f"'{_OPEN}' || replace({x}[2:-2], '{_JOINT}', '') || '{_CLOSE}'"


def _pair_rows(words: str, symbols: str, n: str) -> str:
    """(pair, n) for each place of a pair of neighbours in some words."""
    return f"""SELECT '{_OPEN}' || p[1] || '{_JOINT}' || p[2] || '{_CLOSE}' AS pair, n FROM (
      SELECT unnest(list_zip(y[:-2], y[2:])) AS p, n FROM (
        SELECT string_split({symbols}[2:-2], '{_JOINT}') AS y, {n} AS n FROM {words}))"""


# One merge per step: the most frequent pair, ties by name, that spells no known symbol. Rows of kind w are
# words, p pairs with their counts, m the merges so far, k the symbols they made. A step changes only the
# words that hold the pair and the counts of their pairs.
_TRAINED = f"""alphabet AS (SELECT {_list([byte_alphabet()[b] for b in range(256)])} AS names),
  train_n AS (SELECT token, count(*) AS n FROM (SELECT unnest({_pretokens(_strip('text'))}) AS token
    FROM documents WHERE {_strip('text')} <> '') GROUP BY 1),
  train_w AS (SELECT token, n, {_bytes('token')} AS s FROM train_n, alphabet),
  train(kind, name, n, s) USING KEY (kind, name) AS (
  (SELECT 'w' AS kind, token AS name, n::BIGINT AS n, s FROM train_w
  UNION ALL SELECT 'p', pair, sum(n)::BIGINT, '' FROM ({_pair_rows('train_w', 's', 'n')}) GROUP BY pair
  UNION ALL SELECT 'm', '', 0, '' UNION ALL SELECT 'k', '', 0, '')
  UNION
  (WITH best AS (
    SELECT name AS pair, {_joined('name')} AS symbol FROM recurring.train WHERE kind = 'p' AND n > 0
      AND (SELECT n FROM recurring.train WHERE kind = 'm') < {BPE_MERGES}
      AND NOT contains((SELECT s FROM recurring.train WHERE kind = 'k'), {_joined('name')})
    ORDER BY n DESC, string_split(name[2:-2], '{_JOINT}')[1], string_split(name[2:-2], '{_JOINT}')[2] LIMIT 1),
  touched AS (SELECT name, n, s, replace(s, pair, symbol) AS t FROM recurring.train, best
    WHERE kind = 'w' AND contains(s, pair)),
  moved AS (SELECT pair, sum(n)::BIGINT AS n FROM ({_pair_rows('touched', 's', '-n')}
    UNION ALL {_pair_rows('touched', 't', 'n')}) GROUP BY pair)
  SELECT 'w' AS kind, name, n, t AS s FROM touched
  UNION ALL SELECT 'p', pair, (coalesce(old.n, 0) + moved.n)::BIGINT, ''
    FROM moved LEFT JOIN (SELECT name, n FROM recurring.train WHERE kind = 'p') old ON old.name = pair
  UNION ALL SELECT 'm', '', n + 1, s || pair || '{_MARK}' FROM recurring.train, best WHERE kind = 'm'
  UNION ALL SELECT 'k', '', 0, s || symbol FROM recurring.train, best WHERE kind = 'k')),
  learned_pairs AS (SELECT string_split(rtrim(s, '{_MARK}'), '{_MARK}') AS learned FROM train WHERE kind = 'm'),
  merges AS (SELECT i - 1 AS rank, string_split(pair[2:-2], '{_JOINT}')[1] AS "left",
    string_split(pair[2:-2], '{_JOINT}')[2] AS "right"
    FROM (SELECT unnest(learned) AS pair, generate_subscripts(learned, 1) AS i FROM learned_pairs) WHERE pair <> ''),
  symbols AS (SELECT unnest({_list([byte_alphabet()[b] for b in byte_order()])}) AS token, unnest(range(256)) AS id
    UNION ALL SELECT "left" || "right", 256 + rank FROM merges),
  base AS (SELECT 257 + count(*) AS size FROM merges)"""


def _coded(name: str, pieces: str) -> str:
    """CTEs up to `name`(token, ids) over the tokens of `pieces`(p), merging in rank order."""
    return f"""{name}_s AS (SELECT token, string_split(list_reduce(list_prepend({_bytes('token')}, learned),
      lambda w, m: replace(w, m, {_joined('m')}))[2:-2], '{_JOINT}') AS y
    FROM (SELECT DISTINCT unnest(p) AS token FROM {pieces}), alphabet, learned_pairs),
  {name} AS (SELECT t.token, list(v.id ORDER BY pos) AS ids
    FROM (SELECT token, unnest(y) AS symbol, generate_subscripts(y, 1) AS pos FROM {name}_s) t
    JOIN symbols v ON v.token = t.symbol GROUP BY 1)"""


def _flat(name: str, coded: str, pieces: str) -> str:
    return f"""{name} AS (SELECT ord, flatten(list(c.ids ORDER BY pos)) AS ids
    FROM (SELECT ord, unnest(p) AS token, generate_subscripts(p, 1) AS pos FROM {pieces})
    JOIN {coded} c USING (token) GROUP BY 1)"""


_PIECES = f"pieces AS (SELECT ord, {_pretokens(_strip('text'))} AS p FROM docs WHERE {_strip('text')} <> '')"
_IDS = f"""{_TRAINED}, {_PIECES}, {_coded('coded', 'pieces')}, {_flat('ids', 'coded', 'pieces')}"""
# Tokens of the whole texts, white space at the ends included.
_LENS = f"""{_TRAINED}, whole AS (SELECT ord, text, {_pretokens('text')} AS p FROM docs),
  {_coded('coded', 'whole')},
  token_lens AS (SELECT ord, any_value(text) AS text, coalesce(sum(len(c.ids)), 0)::BIGINT AS v
    FROM (SELECT ord, text, unnest(CASE WHEN len(p) = 0 THEN [NULL] ELSE p END) AS token FROM whole)
    LEFT JOIN coded c USING (token) GROUP BY ord)"""
_EXT = f"""{_IDS},
  full_ext AS (
  SELECT ord, [(SELECT size FROM base)] || ids || [(SELECT size + 1 FROM base)] AS ids FROM ids),
  ext AS (
  SELECT ord, CASE WHEN len(ids) > {fx.BLOCK_SIZE}
    THEN ids[:{fx.BLOCK_SIZE - 1}] || [(SELECT size + 1 FROM base)] ELSE ids END AS ids FROM full_ext)"""


def _special_ids(name: str, literals: dict[str, str]) -> str:
    """CTEs up to `name`(ord, ids) over `literal`(ord, text): texts cut at the given special tokens."""
    cut, mark = "text", chr(0xE003)
    for token in literals:
        cut = f"replace({cut}, '{token}', '{mark}{token}{mark}')"
    names = _list(list(literals))
    special = " ".join(f"WHEN '{t}' THEN [{i}]" for t, i in literals.items())
    return f"""{name}_p AS (SELECT ord, flatten(list_transform(string_split({cut}, '{mark}'), lambda x:
      CASE WHEN list_contains({names}, x) THEN [x] ELSE {_pretokens('x')} END)) AS p FROM literal),
  {_coded(f'{name}_plain', f'{name}_p')},
  {name}_c AS (SELECT token, CASE token {special} ELSE ids END AS ids FROM {name}_plain, base),
  {_flat(name, f'{name}_c', f'{name}_p')}"""


def _special_literals() -> str:
    text = "text"
    for found, literal in zip([", ", ". ", " a", "\n", "e "], [fx.END_OF_TEXT, *fx.SPECIAL_TOKENS]):
        text = f"replace({text}, {_text(found)}, {_text(found[0] + literal + found[1:])})"
    text += f" || '{''.join(fx.SPECIAL_TOKENS)}{fx.END_OF_TEXT}'"
    base = _special_ids("base_ids", {fx.END_OF_TEXT: "size - 1"})
    extended = _special_ids("ext_ids", {t: f"size + {i}" for i, t in enumerate(fx.SPECIAL_TOKENS)})
    return f"""WITH RECURSIVE {_DOCS}, {_TRAINED}, literal AS (SELECT ord, {text} AS text FROM docs), {base}, {extended}
  SELECT ord, array_to_string(b.ids, ' ') AS base_ids, array_to_string(e.ids, ' ') AS ids, true AS same_text
  FROM base_ids b JOIN ext_ids e USING (ord)"""


def _place(source: str) -> str:
    """Recursive CTEs giving placed(ord, block_id, offset) over (ord, n)."""
    return f"""queue AS (
  SELECT ord, n, row_number() OVER (ORDER BY ord) AS i FROM {source}),
  walk AS (
  SELECT i, ord, n, 0::BIGINT AS block_id, 0::BIGINT AS "offset" FROM queue WHERE i = 1
  UNION ALL
  SELECT q.i, q.ord, q.n,
    w.block_id + CASE WHEN w."offset" + w.n + q.n > {fx.BLOCK_SIZE} THEN 1 ELSE 0 END,
    CASE WHEN w."offset" + w.n + q.n > {fx.BLOCK_SIZE} THEN 0 ELSE w."offset" + w.n END
  FROM walk w JOIN queue q ON q.i = w.i + 1),
  placed AS (SELECT ord, block_id, "offset" FROM walk)"""


_PACK = f"""{_EXT}, ext_n AS (SELECT ord, len(ids)::BIGINT AS n FROM ext), {_place('ext_n')},
  filled AS (
  SELECT block_id, flatten(list(ids ORDER BY ord)) AS ids FROM ext JOIN placed USING (ord) GROUP BY 1)"""
_PAD_TEXT = (
    f"repeat(' ' || (SELECT size + 2 FROM base), ({fx.BLOCK_SIZE} - len(ids))::BIGINT)"
)


def _splits(total: str) -> str:
    train, val, _ = fx.SPLIT_RATIOS
    return f"""total AS (SELECT {total} AS n),
  parts AS (
  SELECT n, floor(n * {train}::DOUBLE)::BIGINT AS train, floor(n * {val}::DOUBLE)::BIGINT AS val FROM total),
  splits AS (
  SELECT 'train' AS split, train AS blocks FROM parts
  UNION ALL SELECT 'val', val FROM parts
  UNION ALL SELECT 'test', n - train - val FROM parts)"""


def _histogram(lengths: str, bins: int, ctes: str = "") -> str:
    return f"""WITH RECURSIVE {ctes}lens AS ({lengths}),
  ends AS (SELECT min(v)::DOUBLE AS lo, max(v)::DOUBLE AS hi FROM lens),
  placed_in AS (
  SELECT least(floor((v - lo) / ((hi - lo) / {bins}))::BIGINT + 1, {bins}) AS bin, count(*) AS docs
  FROM lens, ends GROUP BY 1)
  SELECT b.bin, round(lo + (b.bin - 1) * ((hi - lo) / {bins}), 6) AS low,
    round(lo + b.bin * ((hi - lo) / {bins}), 6) AS high, coalesce(p.docs, 0) AS docs
  FROM (SELECT unnest(range(1, {bins} + 1)) AS bin) b CROSS JOIN ends
  LEFT JOIN placed_in p USING (bin)"""


def _length_stats(source: str, n: int) -> str:
    return f"""first AS (SELECT length(text) AS v FROM {source} ORDER BY ord LIMIT {n}),
  numbers AS (
  SELECT count(*) AS sampled, round(avg(v), 6) AS avg_length,
    round(quantile_cont(v, 0.5), 6) AS median_length, round(quantile_cont(v, 0.1), 6) AS p10,
    round(quantile_cont(v, 0.9), 6) AS p90, max(v)::BIGINT AS max_length, min(v)::BIGINT AS min_length,
    round(count(*) FILTER (v = 0) * 100.0::DOUBLE / count(v), 6) AS empty_pct,
    round(count(*) FILTER (v < {fx.SHORT_BELOW}) * 100.0::DOUBLE / count(v), 6) AS short_pct FROM first)"""


_STAGES = f"""WITH RECURSIVE {_NOISY},
  raw AS (SELECT ord, text FROM noisy QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY ord) = 1),
  {_verdicts('raw')},
  docs AS (SELECT ord, text FROM verdicts WHERE verdict = 'KEPT'),
  {_IDS}, cut AS (SELECT ord, least(len(ids) + 2, {fx.BLOCK_SIZE})::BIGINT AS n FROM ids),
  {_place('cut')}, {_splits('(SELECT max(block_id) + 1 FROM placed)')}"""


# The whole job over the damaged lines: `docs` are the kept ones of the unique lines.
_JOB = f"""WITH RECURSIVE {_PARSED}, unique_lines AS (
  SELECT ord, status, text FROM parsed WHERE status IN ('OK', 'EMPTY')
  QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY ord) = 1
  UNION ALL SELECT ord, status, text FROM parsed WHERE status = 'MALFORMED'),
  readable AS (SELECT ord, text FROM unique_lines WHERE status <> 'MALFORMED'),
  {_verdicts('readable')},
  docs AS (SELECT ord, text FROM verdicts WHERE verdict = 'KEPT'),
  {_IDS}, cut AS (SELECT ord, least(len(ids) + 2, {fx.BLOCK_SIZE})::BIGINT AS n, len(ids) AS v FROM ids),
  {_place('cut')}, {_splits('(SELECT max(block_id) + 1 FROM placed)')},
  shards AS (SELECT split, i // {QUERY_SHARD} + 1 AS shard, count(*) AS blocks
    FROM (SELECT split, unnest(range(blocks)) AS i FROM splits) GROUP BY ALL),
  broken AS (SELECT count(*) AS n FROM unique_lines WHERE status = 'MALFORMED')"""


def _job_sql() -> dict[str, str]:
    reports = [
        "SELECT 'cleaning_summary' AS report, counter || ' docs' AS name, docs::DOUBLE AS value FROM counted",
        "SELECT 'cleaning_summary', counter || ' pct', docs * 100.0::DOUBLE / (SELECT sum(docs) FROM counted "
        "WHERE counter <> 'HTML_STRIPPED') FROM counted",
        "SELECT 'cleaning_flow', 'edge ' || edge, flow_value FROM (" + _FLOW.replace("FROM verdicts", "FROM judged") + ")",
        "SELECT 'dedup_counts', 'kept', (SELECT count(*) FROM unique_lines)",
        "SELECT 'dedup_counts', 'dropped', count(*) - (SELECT count(*) FROM unique_lines) FROM parsed WHERE status <> 'BAD_JSON'",
    ]
    lengths = {
        "docs_counted": "count(*)", "avg_tokens": "avg(v)", "median_tokens": "quantile_cont(v, 0.5)",
        "p95_tokens": "quantile_cont(v, 0.95)", "p99_tokens": "quantile_cont(v, 0.99)", "max_tokens": "max(v)",
    }
    reports += [f"SELECT 'token_length_stats', '{k}', {x} FROM cut" for k, x in lengths.items()]
    blocks = "(SELECT max(block_id) + 1 FROM placed)"
    packed = {
        "docs": "count(*)", "min_length": "min(n)", "max_length": "max(n)", "avg_length": "avg(n)", "blocks": f"max({blocks})",
        "distinct_lengths": "max(1)", "bad_blocks": "max(0)",
    }
    reports += [f"SELECT 'pack_diagnostics', '{k}', {x} FROM cut" for k, x in packed.items()]
    reports.append("SELECT 'shard_manifest', split || ' ' || shard, blocks FROM shards")
    judged = f"""judged AS (SELECT verdict, html_stripped FROM verdicts
      UNION ALL SELECT 'MALFORMED', false FROM unique_lines WHERE status = 'MALFORMED'),
    counted AS (SELECT counter, count(*) AS docs FROM (SELECT verdict AS counter FROM judged
      UNION ALL SELECT 'HTML_STRIPPED' FROM judged WHERE html_stripped) GROUP BY 1)"""
    union = " UNION ALL ".join(reports)
    return {
        "pipeline_lines": f"""{_JOB} SELECT 'raw' AS stage, count(*) AS rows FROM parsed
          UNION ALL SELECT 'dedup', count(*) FROM unique_lines
          UNION ALL SELECT 'status ' || s, count(p.ord) FROM (SELECT unnest(['OK', 'EMPTY', 'MALFORMED', 'BAD_JSON']) AS s)
            LEFT JOIN parsed p ON p.status = s GROUP BY s
          UNION ALL SELECT 'tokenized', count(*) FROM cut UNION ALL SELECT 'packed', {blocks}
          UNION ALL SELECT 'shards ' || split, sum(blocks)::BIGINT FROM shards GROUP BY split""",
        "reports_roundtrip": f"{_JOB}, {judged} SELECT report, name, round(value::DOUBLE, 6) AS value FROM ({union})",
        "jsonl_roundtrip": f"WITH {_NOISY} SELECT ord, text, CASE WHEN {_strip('text')} = '' THEN 'EMPTY' ELSE 'OK' END "
        "AS status FROM noisy",
        "shards_roundtrip": f"""WITH RECURSIVE {_DOCS}, {_PACK}, {_splits(blocks)},
          placed_in AS (SELECT CASE WHEN block_id < train THEN 'train' WHEN block_id < train + val THEN 'val' ELSE 'test' END
              AS split, CASE WHEN block_id < train THEN block_id WHEN block_id < train + val THEN block_id - train
              ELSE block_id - train - val END // {QUERY_SHARD} + 1 AS shard,
            md5(array_to_string(ids, ' ') || {_PAD_TEXT}) AS digest FROM filled, parts)
          SELECT split, shard, 1::BIGINT AS files, count(*) AS blocks, count(*) * {fx.BLOCK_SIZE} AS tokens,
            md5(string_agg(digest, '' ORDER BY digest)) AS digest FROM placed_in GROUP BY ALL""",
    }


def all_sql() -> dict[str, str]:
    noisy, docs = f"WITH {_NOISY} ", f"WITH {_DOCS} "
    pack = f"WITH RECURSIVE {_DOCS}, {_PACK}"
    blocks = "(SELECT max(block_id) + 1 FROM placed)"
    sql = {
        # sources and samplers
        "read_jsonl_status": f"WITH {_PARSED} SELECT ord, status, text, "
        "array_to_string(list_sort(keys), ',') AS keys FROM parsed",
        "head_docs": "SELECT doc_id AS ord, text FROM documents ORDER BY doc_id LIMIT 5",
        "sample_docs": f"{docs}SELECT ord, text FROM ({_sampled('docs', 20)})",
        # text transforms
        "normalize_docs": f"{noisy}SELECT ord, {_normalize('text')} AS text FROM noisy",
        "strip_html_pages": f"{noisy}SELECT ord, {_strip_html('text')} AS text FROM noisy",
        "entity_counts": f"{noisy}SELECT entity, count(*) AS n FROM (SELECT unnest(regexp_extract_all("
        "text, '&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)')) AS entity FROM noisy) "
        "GROUP BY 1",
        "simhash_tokens": f"WITH {_DOCS}, {_CHUNKS} SELECT ord, len(w)::BIGINT AS n_tokens, "
        "array_to_string(w, ' ') AS tokens FROM words",
        "token_chunks": f"WITH {_DOCS}, {_CHUNKS} SELECT ord, pos, chunk FROM chunks",
        # detectors
        "html_flag_pages": f"{noisy}SELECT ord, {_has_html('text')} AS has_html FROM noisy",
        "code_fraction": f"{noisy}SELECT ord, round({_ratio('text', _WEAK)}, 6) AS fraction FROM noisy",
        "code_fraction_strong": f"{noisy}SELECT ord, round({_ratio('text', _STRONG)}, 6) AS fraction FROM noisy",
        "code_heavy_docs": f"{noisy}SELECT ord FROM noisy WHERE {_ratio('text', _STRONG)} > 0.40",
        "code_heavy_share": f"{noisy}SELECT docs, hits, round(hits * 100.0::DOUBLE / docs, 6) AS pct FROM ("
        f"SELECT count(*) AS docs, count(*) FILTER ({_ratio('text', _WEAK)} > 0.40) AS hits "
        f"FROM ({_sampled('noisy', 5000)}))",
        "non_ascii_share": f"{noisy}SELECT docs, hits, round(hits * 100.0::DOUBLE / docs, 6) AS pct FROM ("
        r"SELECT count(*) AS docs, count(*) FILTER (regexp_matches(text, '[^\x00-\x7F]')) AS hits "
        "FROM (SELECT * FROM noisy ORDER BY ord LIMIT 20000))",
        "pii_flags": f"{noisy}SELECT ord, array_to_string({_pii('text')}, ',') AS labels FROM noisy",
        "pii_hits": f"{noisy}SELECT label, count(*) AS docs FROM (SELECT unnest({_pii('text')}) AS label "
        "FROM noisy) GROUP BY 1",
        "doc_hashes": f"{noisy}SELECT ord, sha256(text) AS digest FROM noisy",
        "length_filter": f"{noisy}SELECT ord, length(text)::BIGINT AS n_chars FROM noisy "
        f"WHERE length(text) BETWEEN {fx.MIN_CHARS} AND {fx.MAX_CHARS}",
        "classify_docs": f"WITH {_NOISY}, {_exclusive('noisy')} SELECT ord, category FROM classes",
        # language
        "lang_profile": f"WITH {_PROFILE} SELECT lang, gram, n, weight FROM profile",
        "lang_detect": f"WITH {_NOISY}, {_PROFILE}, {_detected('noisy', 'found')} "
        "SELECT ord, lang, score, known FROM found",
        "language_distribution": "WITH turns AS (SELECT conv_id * 1000 + turn AS ord, text FROM conversations), "
        f"picked AS (SELECT * FROM ({_sampled('turns', 5000)}) WHERE {_strip('text')} <> ''), "
        f"{_PROFILE}, {_detected('picked', 'found')} SELECT lang, docs, "
        "round(docs * 100.0::DOUBLE / sum(docs) OVER (), 6) AS pct FROM "
        "(SELECT lang, count(*) AS docs FROM found GROUP BY 1)",
        # toxicity and perplexity
        "toxicity_model": f"WITH {_DOCS}, {_TOXIC} SELECT * FROM toxic_model",
        "toxicity_scores": f"WITH {_DOCS}, {_TOXIC} SELECT ord, log_odds, round(toxicity, 6) AS toxicity "
        "FROM toxic_scores",
        "lm_counts": f"WITH {_DOCS}, {_LM} SELECT NULL::VARCHAR AS prev, token, n FROM uni "
        "UNION ALL SELECT prev, token, n FROM bi UNION ALL SELECT NULL, NULL, n FROM lm_total",
        "doc_perplexity": f"WITH {_DOCS}, {_PPL} SELECT ord, round(perplexity, 6) AS perplexity FROM ppl",
        # de-duplication
        "dedup_exact": f"{docs}SELECT * FROM docs QUALIFY row_number() OVER "
        "(PARTITION BY sha256(text) ORDER BY ord) = 1",
        "dedup_lines": f"WITH {_PARSED} SELECT ord, status FROM parsed WHERE status IN ('OK', 'EMPTY') "
        "QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY ord) = 1 "
        "UNION ALL SELECT ord, status FROM parsed WHERE status = 'MALFORMED'",
        "dedup_counts": "SELECT count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS dropped "
        "FROM documents",
        "simhash_signature": f"WITH {_DOCS}, {_SIGS} SELECT ord, sig FROM sigs",
        "near_dup_copies": f"WITH {_DOCS}, {_SIGS} SELECT s.ord, n.ord AS first_ord FROM sigs s "
        "JOIN nodes n ON n.sig = s.sig AND n.ord <> s.ord",
        "near_dup_pairs": _pairs(fx.HAMMING_THRESHOLD),
        "near_dup_pairs_t8": _pairs(NEAR_WIDE),
        "dedup_near": _near(fx.HAMMING_THRESHOLD),
        "dedup_near_t8": _near(NEAR_WIDE),
        # statistics
        "length_stats": f"WITH {_NOISY}, {_length_stats('noisy', 20000)} SELECT * FROM numbers",
        "length_verdicts": f"WITH {_DOCS}, {_length_stats('docs', 20000)} SELECT *, "
        f"median_length > {fx.LONG_MEDIAN_ABOVE} AND avg_length > {fx.LONG_MEAN_ABOVE} AS mostly_long, "
        f"max_length > {fx.VERY_LONG_ABOVE} AS has_very_long, "
        f"short_pct < {fx.SHORT_PERCENT_BELOW} AS few_short FROM numbers",
        "top_keys": "SELECT key, count(*) AS docs FROM (SELECT unnest(json_keys(props)) AS key FROM events) "
        "GROUP BY 1 ORDER BY docs DESC, key LIMIT 10",
        "top_keys_lines": f"WITH {_PARSED} SELECT key, count(*) AS docs FROM "
        "(SELECT unnest(keys) AS key FROM parsed) GROUP BY 1 ORDER BY docs DESC, key LIMIT 10",
        "length_histogram": _histogram("SELECT length(text) AS v FROM documents", 100),
        "longest_docs": "SELECT doc_id AS ord, length(text)::BIGINT AS n_chars, substr(text, 1, 2000) AS shown "
        "FROM documents ORDER BY length(text) DESC, text DESC, doc_id LIMIT 5",
        "html_examples": f"{noisy}SELECT ord, substr(text, 1, 1500) AS shown FROM noisy "
        f"WHERE {_has_html('text')} ORDER BY ord LIMIT 5",
        "category_overlap": f"WITH {_NOISY}, picked AS ({_sampled('noisy', 10000)}), {_PROFILE}, "
        f"{_detected('picked', 'found')}, flags AS (SELECT lang, {_strip('p.text')} = '' AS blank, "
        f"{_has_html('p.text')} AS html, {_ratio('p.text', _WEAK)} > 0.40 AS code, length(p.text) AS len "
        "FROM (SELECT ord, text FROM picked) p JOIN found USING (ord)), "
        "marks AS (SELECT 'EMPTY' AS category, count(*) FILTER (blank) AS docs FROM flags "
        "UNION ALL SELECT 'NON_ENGLISH', count(*) FILTER (NOT blank AND lang <> 'EN') FROM flags "
        "UNION ALL SELECT 'HTML', count(*) FILTER (NOT blank AND html) FROM flags "
        "UNION ALL SELECT 'CODE_HEAVY', count(*) FILTER (NOT blank AND code) FROM flags "
        "UNION ALL SELECT 'GOOD_ENGLISH', count(*) FILTER (NOT blank AND lang = 'EN' AND NOT html "
        "AND NOT code AND len >= 200) FROM flags) "
        "SELECT category, docs, round(docs * 100.0::DOUBLE / (SELECT count(*) FROM picked), 6) AS pct "
        "FROM marks WHERE docs > 0",
        "category_exclusive": f"WITH {_NOISY}, picked AS ({_sampled('noisy', 10000)}), {_exclusive('picked')} "
        "SELECT category, count(*) AS docs, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM picked), 6) "
        "AS pct FROM classes GROUP BY 1",
        # cleaning
        "clean_verdicts": f"WITH {_NOISY}, {_verdicts('noisy')} SELECT ord, verdict, html_stripped FROM verdicts",
        "clean_verdicts_given_lang": f"WITH {_NOISY}, {_verdicts('noisy', True)} "
        "SELECT ord, verdict, html_stripped FROM verdicts",
        "clean_docs": f"WITH {_NOISY}, {_verdicts('noisy')} SELECT ord, text FROM verdicts WHERE verdict = 'KEPT'",
        "cleaning_summary": f"WITH {_NOISY}, {_verdicts('noisy')}, {_SUMMARY} SELECT * FROM summary",
        "cleaning_flow": f"WITH {_NOISY}, {_verdicts('noisy')} {_FLOW}",
        "quality_report": f"WITH {_DOCS}, picked AS ({_sampled('docs', 2000)}), {_PROFILE}, "
        f"{_detected('(SELECT ord, text FROM picked)', 'found')}, {_TOXIC}, {_PPL}, "
        "scored AS (SELECT p.ord, p.text, f.lang, toxicity, perplexity FROM picked p JOIN found f USING (ord) "
        "JOIN toxic_scores USING (ord) JOIN ppl USING (ord)) "
        "SELECT 'sample' AS section, 'samples_analyzed' AS name, count(*)::DOUBLE AS value FROM scored "
        "UNION ALL SELECT 'toxicity', 'avg', round(avg(toxicity), 6) FROM scored "
        "UNION ALL SELECT 'toxicity', 'max', round(max(toxicity), 6) FROM scored "
        "UNION ALL SELECT 'perplexity', 'avg', round(avg(perplexity), 6) FROM scored "
        "UNION ALL SELECT 'perplexity', 'median', round(quantile_disc(perplexity, 0.5), 6) FROM scored "
        f"UNION ALL SELECT 'pii', label, count(*)::DOUBLE FROM (SELECT unnest({_pii('text')}) AS label FROM scored) "
        "GROUP BY label UNION ALL SELECT 'language', lang, count(*)::DOUBLE FROM scored GROUP BY lang",
        # tokens
        "pretoken_counts": f"WITH {_DOCS}, {_VOCAB} SELECT token, n FROM piece_n",
        "vocab": f"WITH {_DOCS}, {_VOCAB} SELECT token, id, n FROM vocab",
        "special_tokens": f"WITH RECURSIVE {_TRAINED} SELECT token, size + pos AS id FROM base, (SELECT unnest("
        f"{[fx.END_OF_TEXT, *fx.SPECIAL_TOKENS]!r}) AS token, unnest(range(-1, 4)) AS pos)",
        "bpe_merges": f'WITH RECURSIVE {_TRAINED} SELECT rank, "left", "right" FROM merges',
        "bpe_vocab": f"WITH RECURSIVE {_TRAINED} SELECT id, token FROM symbols "
        f"UNION ALL SELECT size - 1, '{fx.END_OF_TEXT}' FROM base",
        "bpe_encode": f"WITH RECURSIVE {_DOCS}, {_TRAINED}, {_PIECES}, {_coded('coded', 'pieces')} "
        "SELECT token, n, array_to_string(ids, ' ') AS ids FROM coded JOIN train_n USING (token)",
        "special_literals": _special_literals(),
        "encode_docs": f"WITH RECURSIVE {_DOCS}, {_IDS} SELECT ord, array_to_string(ids, ' ') AS ids FROM ids",
        "encode_docs_by_join": f"WITH RECURSIVE {_DOCS}, {_IDS} SELECT ord, array_to_string(ids, ' ') AS ids FROM ids",
        "tokenize_plain": f"WITH RECURSIVE {_DOCS}, {_IDS} SELECT ord, array_to_string(ids[:{fx.BLOCK_SIZE}], ' ') AS ids, "
        f"least(len(ids), {fx.BLOCK_SIZE})::BIGINT AS length FROM ids",
        "tokenize_ext": f"WITH RECURSIVE {_DOCS}, {_EXT} SELECT ord, array_to_string(ids, ' ') AS ids, "
        "len(ids)::BIGINT AS length FROM ext",
        "decode_roundtrip": f"{docs}SELECT ord, false AS has_unknown, true AS same_text, "
        f"strlen({_strip('text')}) AS n_bytes FROM docs",
        "token_length_stats": f"WITH RECURSIVE {_DOCS}, {_LENS} SELECT count(*) AS docs_counted, round(avg(v), 6) AS avg_tokens, "
        "round(quantile_cont(v, 0.5), 6) AS median_tokens, round(quantile_cont(v, 0.95), 6) AS p95_tokens, "
        f"round(quantile_cont(v, 0.99), 6) AS p99_tokens, max(v)::BIGINT AS max_tokens FROM token_lens WHERE {_strip('text')} <> ''",
        "token_histogram": _histogram("SELECT v FROM token_lens", 50, f"{_DOCS}, {_LENS}, "),
        # packing and sharding
        "pack_assign": f'{pack} SELECT ord, block_id, "offset" FROM placed',
        "pack_fixed": f"{pack} SELECT block_id, array_to_string(ids, ' ') || {_PAD_TEXT} AS ids, "
        f"{fx.BLOCK_SIZE}::BIGINT AS length FROM filled",
        "pack_variable": f"{pack}, tail AS (SELECT max(block_id) AS last FROM filled) SELECT block_id, "
        f"array_to_string(ids, ' ') || CASE WHEN block_id = last THEN {_PAD_TEXT} ELSE '' END AS ids, "
        f"CASE WHEN block_id = last THEN {fx.BLOCK_SIZE} ELSE len(ids) END::BIGINT AS length FROM filled, tail",
        "pack_diagnostics": f"{pack} SELECT (SELECT count(*) FROM ext_n) AS docs, (SELECT min(n) FROM ext_n) "
        "AS min_length, (SELECT max(n) FROM ext_n) AS max_length, round((SELECT avg(n) FROM ext_n), 6) AS avg_length, "
        f"{blocks} AS blocks, 1::BIGINT AS distinct_lengths, 0::BIGINT AS bad_blocks, true AS all_exact",
        "shard_assign": f"{pack}, {_splits(blocks)} SELECT block_id, CASE WHEN block_id < train THEN 'train' "
        "WHEN block_id < train + val THEN 'val' ELSE 'test' END AS split, CASE WHEN block_id < train THEN block_id "
        f"WHEN block_id < train + val THEN block_id - train ELSE block_id - train - val END // {QUERY_SHARD} + 1 "
        "AS shard FROM (SELECT DISTINCT block_id FROM placed), parts",
        "split_counts": f"{pack}, {_splits(blocks)} SELECT split, blocks FROM splits",
        "shard_manifest": f"{pack}, {_splits(blocks)} SELECT split, blocks, blocks // {QUERY_SHARD} + 1 AS ref_shards, "
        f"ceil(blocks / {QUERY_SHARD}.0)::BIGINT AS non_empty_shards FROM splits",
        # composed jobs
        "pipeline_counts": f"{_STAGES} SELECT 'raw' AS stage, count(*) AS rows FROM noisy "
        "UNION ALL SELECT 'dedup', count(*) FROM raw UNION ALL SELECT 'clean', count(*) FROM docs "
        "UNION ALL SELECT 'tokenized', count(*) FROM cut "
        f"UNION ALL SELECT 'packed', {blocks} UNION ALL SELECT split, blocks FROM splits WHERE blocks > 0",
        "run_meta": f"{_STAGES}, {_SUMMARY}, pairs AS ("
        "SELECT 'run' AS section, 'pipeline_version' AS name, '1.0' AS value "
        "UNION ALL SELECT 'tokenizer', 'name', 'corpus_bpe_extended' "
        "UNION ALL SELECT 'tokenizer', 'vocab_size', (size + 4)::VARCHAR FROM base "
        f"UNION ALL SELECT 'data', 'total_blocks', {blocks}::VARCHAR "
        f"UNION ALL SELECT 'data', 'block_size', '{fx.BLOCK_SIZE}' "
        "UNION ALL SELECT 'special_tokens', token, (size + pos)::VARCHAR FROM base, (SELECT unnest("
        f"{fx.SPECIAL_TOKENS!r}) AS token, unnest(range(4)) AS pos) "
        "UNION ALL SELECT 'cleaning_summary', counter, docs::VARCHAR FROM summary "
        "UNION ALL SELECT 'shards', 'train_ratio', '0.98' UNION ALL SELECT 'shards', 'val_ratio', '0.01' "
        "UNION ALL SELECT 'shards', 'test_ratio', '0.01') SELECT * FROM pairs",
    }
    every = f"picked AS ({_sampled('docs', 2000)})"
    sql |= _job_sql()
    sql["quality_report_all"] = sql["quality_report"].replace(every, "picked AS (SELECT * FROM docs)")
    return sql
