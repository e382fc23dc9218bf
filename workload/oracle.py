"""SQL checks: for each registered query, the same result in DuckDB.

Written apart from the package: the SQL works on strings and joins, and expands the
fixture dictionaries by itself.
"""

from __future__ import annotations

from murmur import fixed
from workload import fixtures as X

W = rf"[{fixed.WORD_CHARS}]+"
SP = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
EMAIL = fixed.EMAIL
PHONE = fixed.PHONE.replace(r"\x85", r"\x{85}")
NP = r"(?:D:\S+ )?(?:J:\S+ )*N:\S+ "
VP = rf"(?:J:\S+ )*V:\S+ (?:(?:I:\S+ )?{NP})+"


def q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def values(rows, *names) -> str:
    body = ", ".join("(" + ", ".join(str(v) if isinstance(v, (int, float)) else q(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"


def stem(x: str) -> str:
    w = f"lower({x})"
    cut = lambda n: f"left({w}, length({w}) - {n})"
    return (
        f"(CASE WHEN regexp_matches({w}, '[^ea]ies$') OR {w} = 'ies' THEN {cut(3)} || 'y'"
        f" WHEN regexp_matches({w}, '[^aeo]es$') OR {w} = 'es' THEN {cut(1)}"
        f" WHEN regexp_matches({w}, '[^us]s$') OR {w} = 's' THEN {cut(1)} ELSE {w} END)"
    )


def pystem(w: str) -> str:
    w = w.lower()
    if w[-3:] == "ies" and w[-4:-3] not in ("e", "a"):
        return w[:-3] + "y"
    if w[-2:] == "es" and (len(w) < 3 or w[-3] not in "aeo"):
        return w[:-1]
    if w[-1:] == "s" and (len(w) < 2 or w[-2] not in "us"):
        return w[:-1]
    return w


def words(x: str, pattern: str = W) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '{pattern}')"


STEMS = ", ".join(sorted({q(pystem(w)) for w in X.STOP}))
RAW_STOP = ", ".join(sorted({q(w) for w in X.STOP}))


def terms(x: str) -> str:
    return f"list_filter(list_transform({words(x)}, lambda w: {stem('w')}), lambda t: t NOT IN ({STEMS}))"


def pii(t: str) -> str:
    return f"(regexp_matches({t}, '{EMAIL}') OR regexp_matches({t}, '{PHONE}'))"


def count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, '{pattern}'))"


def rules(t: str) -> str:
    return (
        f"((length({t}) > 1000 AND {count(t, fixed.TOPIC)} < 2) OR {count(t, chr(92) + 'p{Nd}+')} > 30"
        f" OR {t} IS NULL OR {t} = {q(fixed.NO_LANGUAGE)})"
    )


def screened(name: str, source: str, key: str, text: str) -> str:
    """CTEs ending in ``name``(key, text, spam): removal repeated until nothing is found."""
    strip = f"regexp_replace(regexp_replace(t, '{EMAIL}', '', 'g'), '{PHONE}', '', 'g')"
    return f"""
    {name}_r AS (
      SELECT {key} AS k, {text} AS t, {rules(text)} AS spam, 0 AS n FROM {source}
      UNION ALL
      SELECT k, u, spam OR {rules('u')}, n + 1 FROM (SELECT k, {strip} AS u, spam, n FROM {name}_r WHERE {pii('t')})
    ),
    {name} AS (SELECT k AS {key}, arg_max(t, n) AS text, arg_max(spam, n) AS spam FROM {name}_r GROUP BY k)"""


# --- sentences, phrases -------------------------------------------------------------

PIECE = rf"[^\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}]*{SP}|[^\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}]+$"


def sentence_ctes(source: str, key: str, text: str) -> str:
    """CTEs sents(key, sid, sentence, ends): split after pieces that end a sentence."""
    body = "left(piece, length(piece) - 1)"
    return rf"""
    pieces AS (
      SELECT {key}, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos
      FROM (SELECT {key}, regexp_extract_all({text}, '{PIECE}') AS ps FROM {source})
    ),
    marked AS (
      SELECT *, (regexp_matches(piece, '{SP}$') AND regexp_matches({body}, '[.?]$')
        AND NOT regexp_matches({body}, '[{fixed.WORD_CHARS}]\.[{fixed.WORD_CHARS}].$')
        AND NOT regexp_matches({body}, '[A-Z][a-z]\.$')) AS fin
      FROM pieces
    ),
    numbered AS (
      SELECT *, coalesce(sum(CASE WHEN fin THEN 1 ELSE 0 END)
        OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sid
      FROM marked
    ),
    sents AS (
      SELECT {key}, cast(sid AS INT) AS sid, string_agg(CASE WHEN fin THEN {body} ELSE piece END, '' ORDER BY pos) AS sentence,
        count(*) FILTER (fin) AS ends
      FROM numbered GROUP BY {key}, sid
    )"""


def phrase_ctes() -> str:
    """CTEs phr(id, vps, nps) over fb(id, translated)."""
    strip = lambda p: f"list_transform(regexp_extract_all(tagged, '{p}'), lambda p: rtrim(regexp_replace(p, '[A-Z]:', '', 'g')))"
    return sentence_ctes("fb", "id", "translated") + f""",
    spoken AS (
      SELECT id, sid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT id, sid, {words('sentence')} AS ws FROM sents)
    ),
    tagged AS (
      SELECT id, string_agg((CASE WHEN i = 1 THEN '. ' ELSE '' END) || coalesce(tag, 'N') || ':' || w || ' ', '' ORDER BY sid, i) AS tagged
      FROM spoken LEFT JOIN {values(X.TAGS, 'word', 'tag')} t ON t.word = lower(w) GROUP BY id
    ),
    phr AS (
      SELECT fb.id, coalesce({strip(VP)}, []) AS vps, coalesce({strip(NP)}, []) AS nps FROM fb LEFT JOIN tagged USING (id)
    )"""


FB = "fb AS (SELECT doc_id AS id, lang AS store, source AS device, text AS translated FROM documents)"

# --- dictionaries -----------------------------------------------------------------------

import re  # noqa: E402


def listed(row_keywords):
    return [k.strip() for k in (row_keywords or "").split(",") if k.strip()]


def expanded(label, keywords):
    out = set()
    for k in listed(keywords) + label.split("/"):
        out.add(k)
        ws = k.split(" ")
        out |= {a + c + b for i, a in enumerate(ws) for j, b in enumerate(ws) if i != j for c in (" ", "-", "_", "")}
    return {k for k in out if k}


COMPONENTS = []  # store, keyword, component, feature
_feature = {(s, c): f for s, _, f, c, _ in X.CATEGORIES}
for _s, _, _, _c, _k in X.CATEGORIES:
    for _w in expanded(_c, _k):
        COMPONENTS.append((_s, _w, _c, _feature[_s, _c]))
COMPONENTS = sorted(set(COMPONENTS))
# The sides of an alternative carry its component.
COMPONENTS_AND_SIDES = sorted({*COMPONENTS, *(
    (s, p, c, f) for s, k, c, f in COMPONENTS if "/" in k or "&" in k for p in re.split("/| & ", k)
)})

ISSUE_WORDS = []  # store, keyword, issue
for _s, _i, _k in X.ISSUES:
    if _i == fixed.BUG_ISSUE:
        _ws = {f"{n} {v}" for n in fixed.NEGATIONS for v in listed(_k)} | {fixed.BUG_KEYWORD}
    else:
        _ws = expanded(_i, _k)
    ISSUE_WORDS += [(_s, w, _i) for w in _ws]
ISSUE_WORDS = sorted(set(ISSUE_WORDS))


def pair_rows(keywords):
    """(store, keyword, pairs, pair_no, a, b) of (store, keyword) rows."""
    forms = {}
    for store, k in sorted(keywords):
        ws = [pystem(w) for w in re.findall(r"\w+", k)]
        either = "/" in k or "&" in k
        found = []
        if " " in k or ("-" in k and not either):
            if len(ws) > 1:
                found.append((k, tuple(ws)))
        else:
            found.append((k, (pystem(k),)))
        if either:
            found += [(p, (pystem(p),)) for p in re.split("/| & ", k)]
        for surface, t in found:
            key = (store, t)
            forms[key] = max(forms.get(key, ""), surface)
    out = []
    for (store, t), surface in forms.items():
        pairs = [(t[0], t[0])] if len(t) == 1 else list(zip(t, t[1:]))
        out += [(store, surface, len(pairs), i, a, b) for i, (a, b) in enumerate(pairs)]
    return out


def find_ctes(name, source, keys, text, keywords):
    """CTEs ending in name(keys, store, keyword)."""
    ks = ", ".join(keys)
    same = " AND ".join(f"x.{k} = y.{k}" for k in keys)
    xs = ", ".join(f"x.{k}" for k in keys)
    rows = keywords if isinstance(keywords, str) else values(
        pair_rows(keywords), "store", "keyword", "pairs", "pair_no", "a", "b")
    return f"""
    {name}_t AS (
      SELECT {ks}, store, unnest(ts) AS term, generate_subscripts(ts, 1) AS i
      FROM (SELECT {ks}, store, {terms(text)} AS ts FROM {source})
    ),
    {name}_p AS (SELECT * FROM {rows}),
    {name}_h AS (
      SELECT DISTINCT {xs}, x.store, p.keyword, p.pairs, p.pair_no
      FROM {name}_t x JOIN {name}_p p ON p.store = x.store AND p.a = x.term
      JOIN {name}_t y ON {same} AND y.term = p.b AND y.i - x.i BETWEEN -2 AND 1
    ),
    {name} AS (SELECT {ks}, store, keyword FROM {name}_h GROUP BY {ks}, store, keyword, pairs HAVING count(*) = pairs)"""


PLAIN = sorted({(s, k) for s, _, _, _, ks in X.CATEGORIES for k in listed(ks)})
COMPONENT_WORDS = sorted({(s, k) for s, k, _, _ in COMPONENTS})
ISSUE_KEYS = sorted({(s, k) for s, k, _ in ISSUE_WORDS})


def fallback_rows():
    """(store, keyword, issue) for reported keywords that are not listed."""
    reported = {(r[0], r[1]) for r in pair_rows(ISSUE_KEYS)}
    out = []
    for store, k in sorted(reported - set(ISSUE_KEYS)):
        best = None
        for place, w in enumerate(k.split(" ")):
            hits = sorted(x for s, x, _ in ISSUE_WORDS if s == store and w and w in x)
            best = hits[0] if hits else best
        out += [(store, k, i) for s, x, i in ISSUE_WORDS if s == store and x == best]
    return sorted(set(out))


def contexts(sql_from: str) -> str:
    """Rows (id, keyword, sid, i, context) for rows (id, keyword) over ctx(id, sid, ws, w, i)."""
    return (
        f"SELECT k.id, k.keyword, c.sid, c.i, array_to_string(list_slice(c.ws, greatest(c.i - 2, 1), c.i), ' ') AS context"
        f" FROM {sql_from} k JOIN ctx c ON c.id = k.id AND c.stem = {stem('k.keyword')}"
    )


CTX = f"""
    ctx AS (
      SELECT id, sid, ws, i, {stem('ws[i]')} AS stem
      FROM (SELECT id, sid, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT id, sid, {words('sentence')} AS ws FROM sents))
    )"""


def categorize_ctes() -> str:
    """CTEs ending in cat(id, feature, component, acts)."""
    bodies = """
    bodies AS (
      SELECT id, store, 'text' AS origin, translated AS body FROM fb
      UNION ALL SELECT id, store, 'verb', array_to_string(vps, ', ') FROM phr JOIN fb USING (id)
      UNION ALL SELECT id, store, 'noun', array_to_string(nps, ', ') FROM phr JOIN fb USING (id)
    )"""
    normal = f"array_to_string({terms('p')}, ' ')"
    return f"""{FB}, {phrase_ctes()}, {bodies},
    {find_ctes('found', 'bodies', ['id', 'origin'], 'body', COMPONENT_WORDS)},
    flags AS (
      SELECT id, bool_or(origin = 'text') AS in_text, bool_or(origin = 'verb') AS in_verb,
        bool_or(origin <> 'text') AS in_phrase FROM found GROUP BY id
    ),
    chosen AS (
      SELECT DISTINCT f.id, f.store, f.keyword, g.in_verb FROM found f JOIN flags g USING (id)
      WHERE g.in_text AND (CASE WHEN g.in_phrase THEN origin <> 'text' ELSE origin = 'text' END)
    ),
    {CTX},
    verbs AS (
      SELECT c.id, c.keyword, unnest(list_filter(phr.vps, lambda p: contains({normal}, {stem('c.keyword')}))) AS act
      FROM chosen c JOIN phr USING (id) WHERE c.in_verb
    ),
    acts AS (
      SELECT id, keyword, act FROM verbs
      UNION ALL SELECT id, keyword, context FROM ({contexts('(SELECT id, keyword FROM chosen WHERE NOT in_verb)')})
    ),
    comps AS (SELECT * FROM {values(COMPONENTS_AND_SIDES, 'store', 'keyword', 'component', 'feature')}),
    merged AS (
      SELECT c.id, k.feature, k.component, coalesce(list_sort(list_distinct(list(a.act) FILTER (a.act IS NOT NULL))), []) AS acts
      FROM chosen c JOIN comps k ON k.store = c.store AND k.keyword = c.keyword
      LEFT JOIN acts a ON a.id = c.id AND a.keyword = c.keyword GROUP BY c.id, k.feature, k.component
    ),
    counted AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM merged),
    cat AS (
      SELECT id, feature, component, acts FROM counted WHERE component <> {q(X.GENERIC)} OR n = 1
      UNION ALL
      SELECT fb.id, 'Other', 'Others', [''] FROM fb LEFT JOIN flags g USING (id) WHERE NOT coalesce(g.in_text, false)
    )"""


def issue_ctes() -> str:
    return f"""{find_ctes('ifound', 'fb', ['id'], 'translated', ISSUE_KEYS)},
    iss AS (
      SELECT DISTINCT f.id, i.issue FROM ifound f
      JOIN {values(ISSUE_WORDS + fallback_rows(), 'store', 'keyword', 'issue')} i ON i.store = f.store AND i.keyword = f.keyword
    )"""


# --- similarity -----------------------------------------------------------------------------


def weight_ctes(prefix, source, by, key, copies="1"):
    """CTEs ending in {prefix}_w(by, key, term, n_texts, weight) over source(by, key, bag)."""
    b = ", ".join(by)
    join = " AND ".join(f"x.{c} = y.{c}" for c in by)
    return f"""
    {prefix}_n AS (SELECT {b}, sum({copies}) AS n FROM {source} GROUP BY {b}),
    {prefix}_tf AS (
      SELECT {b}, {key}, term, count(*) AS tf, max(c) AS c
      FROM (SELECT {b}, {key}, {copies} AS c, unnest(bag) AS term FROM {source}) GROUP BY {b}, {key}, term
    ),
    {prefix}_df AS (SELECT {b}, term, sum(c) AS df FROM {prefix}_tf GROUP BY {b}, term),
    {prefix}_raw AS (
      SELECT x.*, y.df, x.tf * (ln((1 + z.n) / (1.0 + y.df)) + 1) AS w
      FROM {prefix}_tf x JOIN {prefix}_df y ON {join} AND x.term = y.term
      JOIN {prefix}_n z ON {join.replace('y.', 'z.')}
    ),
    {prefix}_w AS (
      SELECT {b}, {key}, term, cast(df AS BIGINT) AS n_texts, w / sqrt(sum(w * w) OVER (PARTITION BY {b}, {key})) AS weight FROM {prefix}_raw
    )"""


ONE = FB.replace("source AS device", "'any' AS device")
FOLDED = f"""{ONE},
    bags AS (
      SELECT store, device, id, list_sort(list_filter({terms('translated')}, lambda t: length(t) >= 2)) AS bag FROM fb
    ),
    folded AS (SELECT store, device, bag, min(id) AS id, count(*) AS copies FROM bags WHERE len(bag) > 0 GROUP BY store, device, bag)"""


def pairs_cte(prefix):
    return f"""
    {prefix}_pairs AS (
      SELECT x.store, x.device, x.id AS a, y.id AS b, sum(x.weight * y.weight) AS similarity
      FROM {prefix}_w x JOIN {prefix}_w y ON x.store = y.store AND x.device = y.device AND x.term = y.term AND x.id < y.id
      GROUP BY ALL HAVING round(sum(x.weight * y.weight), 9) >= 0.3
    )"""


def cluster_ctes() -> str:
    return f"""{FOLDED}, {weight_ctes('c', 'folded', ['store', 'device'], 'id', 'copies')}, {pairs_cte('c')},
    edges AS (SELECT a, b FROM c_pairs UNION SELECT b, a FROM c_pairs),
    reach AS (
      SELECT id AS node, id AS seen FROM folded
      UNION
      SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen
    ),
    roots AS (SELECT node, min(seen) AS cluster FROM reach GROUP BY node),
    members AS (
      SELECT b.store, b.device, b.id, r.cluster FROM bags b
      JOIN folded f ON f.store = b.store AND f.device = b.device AND f.bag = b.bag JOIN roots r ON r.node = f.id
    ),
    clusters AS (SELECT * FROM members WHERE cluster IN (SELECT cluster FROM members GROUP BY cluster HAVING count(*) >= 4))"""


def summary_sql(head, source, group, limit):
    two = f"regexp_extract_all(translated, '[{fixed.WORD_CHARS}]{{2,}}')"
    return f"""{head},
    short AS (SELECT {group}, id, translated, list_transform({two}, lambda w: lower(w)) AS bag
      FROM {source} WHERE length(translated) <= {limit}),
    {weight_ctes('s', 'short', [group], 'id')},
    scored AS (SELECT {group}, id, round(sum(weight), 9) AS score FROM s_w GROUP BY {group}, id),
    best AS (SELECT {group}, translated, row_number() OVER (PARTITION BY {group} ORDER BY score DESC, id) AS r FROM scored JOIN short USING ({group}, id))
    SELECT g.{group}, coalesce(b.translated, 'Unknown') AS summary
    FROM (SELECT DISTINCT {group} FROM {source}) g LEFT JOIN best b ON b.{group} = g.{group} AND b.r = 1"""


# --- queries -----------------------------------------------------------------------------------

ORACLE: dict[str, str] = {}
O = ORACLE

O["pii_detect"] = f"""
SELECT doc_id, cast(regexp_matches(text, '{EMAIL}') AS INT) AS has_email, cast(regexp_matches(text, '{PHONE}') AS INT) AS has_phone,
  cast({pii('text')} AS INT) AS has_pii FROM documents"""
O["pii_scrub"] = f"WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')} SELECT doc_id, text FROM s"
O["spam_flags"] = f"""
WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')}
SELECT d.doc_id, cast(length(d.text) > 1000 AND {count('d.text', fixed.TOPIC)} < 2 AS INT) AS too_long,
  cast({count('d.text', chr(92) + 'p{Nd}+')} > 30 AS INT) AS too_many_numbers,
  cast(d.text IS NULL OR d.text = {q(fixed.NO_LANGUAGE)} AS INT) AS no_language, cast(s.spam AS INT) AS spam
FROM documents d JOIN s USING (doc_id)"""
O["spam_two_passes"] = f"""
WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')},
again AS (SELECT doc_id, text AS original, replace(text, 'a', 'A') || ' 555-1234' AS translated FROM s WHERE NOT spam),
{screened('z', 'again', 'doc_id', 'translated')}
SELECT doc_id, a.original AS text, z.text AS translated, 0 AS spam FROM again a JOIN z USING (doc_id) WHERE NOT z.spam"""
O["dedup_exact"] = """
SELECT text, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source FROM documents GROUP BY text"""
O["clean_pipeline"] = f"""
WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')}
SELECT s.text, min(s.doc_id) AS doc_id, arg_min(d.lang, s.doc_id) AS lang, 0 AS spam
FROM s JOIN documents d USING (doc_id) WHERE NOT s.spam GROUP BY s.text"""

IOS, WEB = fixed.VERSION_MARKERS
AGENT = f"""
  'Agent/5.0 (' || (['iPhone','iPad','Windows','Macintosh','Linux','Other'])[user_id % 6 + 1]
  || CASE WHEN event_id % 5 = 0 THEN '; Linux' ELSE '' END || ') '
  || (['{IOS}','{WEB}','Other/','{WEB}x','{IOS}'])[event_id % 5 + 1]
  || (event_id % 90)::VARCHAR || '.' || (user_id % 12)::VARCHAR || CASE WHEN event_id % 3 = 0 THEN '.7b12' ELSE '' END || ' Tail/1.0'
  || CASE WHEN event_id % 7 = 0 THEN ' {WEB}88.1' ELSE '' END"""
DEVICE = ("CASE WHEN contains(a, 'Linux') THEN 'Linux' WHEN contains(a, 'Macintosh') THEN 'Macintosh' WHEN contains(a, 'Windows') THEN 'Windows'"
          " WHEN contains(a, 'iPad') THEN 'iPad' WHEN contains(a, 'iPhone') THEN 'iPhone' ELSE 'Unknown' END")
STORE = "CASE WHEN d LIKE 'iP%' THEN 'iOS' WHEN d = 'Unknown' THEN '' ELSE 'Desktop' END"


def version_sql(a):
    after = lambda m: rf"coalesce(try_cast(regexp_extract(substr({a}, strpos({a}, '{m}') + {len(m)}), '^(\d+\.\d+)', 1) AS DOUBLE), 0)"
    return f"CASE WHEN strpos({a}, '{IOS}') > 1 THEN {after(IOS)} WHEN strpos({a}, '{WEB}') > 1 THEN {after(WEB)} ELSE 0.0 END"


O["device_store"] = f"""
SELECT event_id, d AS device, {STORE} AS store FROM (SELECT event_id, {DEVICE} AS d FROM (SELECT event_id, {AGENT} AS a FROM events))"""
O["version_extract"] = f"SELECT event_id, cast({version_sql('a')} AS DOUBLE) AS version FROM (SELECT event_id, {AGENT} AS a FROM events)"
O["country_recode"] = """
SELECT c_custkey, CASE WHEN n_name IN ('UNITED STATES', 'NATION_3') THEN 'United States' ELSE n_name END AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
SURVEY_AGENT = f"'Agent/5.0 (' || (['iPhone','iPad','Linux'])[doc_id % 3 + 1] || ') {WEB}' || (doc_id % 60)::VARCHAR || '.' || (doc_id % 7)::VARCHAR"
NORMALIZED = f"""
SELECT {STORE} AS store, d AS device, 'SurveyGizmo' AS source, CASE WHEN lang = 'en' THEN 'United States' ELSE lang END AS country,
  strftime(DATE '2024-01-01' + (doc_id % 30)::INT, '%Y-%m-%d') AS date, cast({version_sql('a')} AS DOUBLE) AS version,
  '' AS rating, CASE WHEN source = 'src0' THEN '' ELSE source END || text AS original, '' AS translated
FROM (SELECT *, {DEVICE} AS d FROM (SELECT *, {SURVEY_AGENT} AS a FROM documents))
UNION ALL
SELECT role, 'Unknown', 'Appbot', 'United States', '2024-02-03', turn + 0.5::DOUBLE, (turn % 5 + 1)::VARCHAR, role || '. ' || text, NULL
FROM conversations"""
O["normalize_union"] = NORMALIZED
O["read_feedback_files"] = NORMALIZED
O["source_kind"] = """
SELECT 'documents' AS name, 'SurveyGizmo' AS source, count(*) AS n FROM documents
UNION ALL SELECT 'conversations', 'Appbot', count(*) FROM conversations UNION ALL SELECT 'events', 'Unknown', count(*) FROM events"""
O["keyword_split"] = """
SELECT p_partkey, cast(pos - 1 AS INT) AS pos, ws[pos] AS word FROM (
  SELECT p_partkey, ws, unnest(range(1, len(ws) + 1)) AS pos FROM (
    SELECT p_partkey, list_filter(list_transform(string_split(p_name || ', ' || p_type || ',,  ' || p_brand || ' ,', ','), lambda w: trim(w)), lambda w: w <> '') AS ws FROM part))"""
O["dictionary_scan"] = """
SELECT DISTINCT p_type AS store, f.feature, p_brand AS component, p_name AS keyword FROM part
JOIN (SELECT p_type AS t, p_brand AS b, min(p_name) AS feature FROM part GROUP BY 1, 2) f ON f.t = p_type AND f.b = p_brand"""
O["issue_dictionary_scan"] = "SELECT DISTINCT p_type AS store, p_brand AS issue, p_name AS keyword FROM part"
O["word_list"] = f"""
SELECT DISTINCT {stem('w')} AS word FROM (SELECT unnest({words('p_name')}) AS w FROM part UNION ALL SELECT 'Plates' UNION ALL SELECT 'please')"""
O["unique_words"] = "SELECT p_name AS word FROM part GROUP BY p_name"
BASE = X.TODAY.replace("-", "") + "000000"
DAY = "(DATE '2024-01-01' + (doc_id % 30)::INT)"
stored = lambda t: f"replace(left({t}, 4000), '|', ' ')"
O["sink_rows"] = f"""
SELECT ({BASE} + doc_id)::VARCHAR AS id, lang AS store, 'Unknown' AS device, source, '' AS country,
  strftime({DAY}, '%Y-%m-%d') AS review_date, 1.5::DOUBLE AS version, '' AS rating,
  {stored('text')} AS original_reviews, {stored("(text || '|' || text)")} AS translated_reviews, 'Neutral' AS sentiment, 0 AS spam,
  lang || ', ' || source AS verb_phrases, source AS noun_phrases, 'Clear Filters' AS clear_filters, strftime({DAY}, '%m-%d-%Y') AS us_date
FROM documents WHERE lang <> 'es'"""
O["persisted_roundtrip"] = """
SELECT d.doc_id AS id, lang AS store, cast(least(4000, 2 * length(text) + 1) AS INT) AS chars, quality::VARCHAR AS key_issue, NULL::VARCHAR AS feature
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang <> 'es'"""
O["incremental_load"] = f"""
WITH d AS (SELECT doc_id, lang, text, doc_id % 30 < 14 AS early, doc_id % 7 = 3 AS undated FROM documents),
top AS (SELECT max(doc_id) + {BASE} + 1 AS b FROM d WHERE early AND (undated OR lang <> 'es')),
r AS (SELECT doc_id, CASE WHEN early THEN {BASE} ELSE b END + doc_id AS id FROM d, top WHERE lang <> 'es' AND NOT undated),
c AS (SELECT id FROM r JOIN labels USING (doc_id)),
u AS (SELECT CASE WHEN early THEN {BASE} ELSE b END + doc_id AS id FROM d, top
  WHERE undated AND (early OR text NOT IN (SELECT text FROM d WHERE early AND undated)))
SELECT 'reviews' AS name, count(*) AS rows, min(id)::VARCHAR AS low, max(id)::VARCHAR AS high FROM r
UNION ALL SELECT 'categorization', count(*), min(id)::VARCHAR, max(id)::VARCHAR FROM c
UNION ALL SELECT 'key_issue', count(*), min(id)::VARCHAR, max(id)::VARCHAR FROM c
UNION ALL SELECT 'undated', count(*), min(id)::VARCHAR, max(id)::VARCHAR FROM u"""
O["load_snapshot"] = f'''
WITH d AS (SELECT doc_id, doc_id % 30 < 10 AS early FROM documents WHERE lang <> 'es'),
top AS (SELECT max(doc_id) + {BASE} + 1 AS b FROM d WHERE early),
r AS (SELECT CASE WHEN early THEN {BASE} ELSE b END + doc_id AS id, early FROM d, top)
SELECT 'reviews' AS name, count(*) AS rows, min(id)::VARCHAR AS low, max(id)::VARCHAR AS high FROM r
UNION ALL SELECT 'categorization', count(*), min(id)::VARCHAR, max(id)::VARCHAR FROM r
UNION ALL SELECT 'key_issue', count(*), min(id)::VARCHAR, max(id)::VARCHAR FROM r WHERE NOT early'''
O["load_once"] = '''
WITH d AS (SELECT text, lang, doc_id % 3 AS k, min(doc_id) AS id FROM documents GROUP BY ALL),
copies AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY text, k ORDER BY id) = 1),
r AS (SELECT * FROM copies WHERE lang <> 'es' QUALIFY row_number() OVER (PARTITION BY text ORDER BY k) = 1)
SELECT 'load' || k AS batch, count(*) AS rows, sum(id)::BIGINT AS places FROM r GROUP BY k'''
O["compacted_lookup"] = '''
WITH e AS (SELECT unnest([min(doc_id), max(doc_id), max(doc_id) + 1]) AS id FROM labels)
SELECT e.id::VARCHAR AS id, CASE WHEN count(doc_id) > 0 THEN 1 ELSE 0 END::INT AS files, count(doc_id) AS rows, max(quality::VARCHAR) AS key_issue
FROM e LEFT JOIN labels l ON l.doc_id = e.id GROUP BY e.id'''
TRANSLATED = """'it''s ' || replace(text, 'a', 'A')"""
O["translation_memory"] = f"""
SELECT d.doc_id, d.lang, CASE WHEN d.lang = 'en' THEN d.text WHEN m.text IS NOT NULL THEN 'it''s ' || replace(d.text, 'a', 'A')
  ELSE {q(fixed.NO_LANGUAGE)} END AS translated
FROM documents d LEFT JOIN (SELECT DISTINCT lang, text FROM documents JOIN labels USING (doc_id)) m ON m.lang = d.lang AND m.text = d.text"""
O["html_unescape"] = "SELECT doc_id, replace(text, 'e ', 'e''') AS text FROM documents"


def sentiment_ctes(source, key, text):
    """CTEs ending in senti(key, score, magnitude)."""
    return f"""{sentence_ctes(source, key, text)},
    hits AS (
      SELECT {key}, sid, avg(l.score) AS score FROM (SELECT {key}, sid, lower(unnest({words('sentence')})) AS word FROM sents) t
      JOIN {values(X.SENTIMENT, 'word', 'score')} l ON l.word = t.word GROUP BY {key}, sid
    ),
    sizes AS (SELECT {key}, sum(ends) + 1 AS n FROM sents GROUP BY {key}),
    sums AS (SELECT {key}, sum(score) AS s, sum(abs(score)) AS m FROM hits GROUP BY {key}),
    senti AS (
      SELECT z.{key}, round(coalesce(s.s, 0.0) / coalesce(n.n, 1), 9)::DOUBLE AS score, round(coalesce(s.m, 0.0) / coalesce(n.n, 1), 9)::DOUBLE AS magnitude
      FROM {source} z LEFT JOIN sizes n USING ({key}) LEFT JOIN sums s USING ({key})
    )"""


LABEL = "CASE WHEN abs(magnitude) <= 0.25 OR abs(score) <= 0.15 THEN 'Neutral' WHEN score > 0 THEN 'Positive' ELSE 'Negative' END"
O["sentiment_label"] = f"""
WITH {sentiment_ctes('documents', 'doc_id', 'text')}
SELECT doc_id, round(score, 6) AS score, round(magnitude, 6) AS magnitude, {LABEL} AS sentiment FROM senti"""
O["dense_ids"] = """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text)"""
O["batch_id_base"] = f"""
WITH m AS (SELECT max(k) + {BASE} AS max_id FROM (SELECT max(o_orderkey) AS k FROM orders UNION ALL SELECT max(l_orderkey) FROM lineitem UNION ALL SELECT max(event_id) FROM events))
SELECT max_id, max_id + 1 AS same_day, greatest(20240116000000, max_id + 1) AS next_day, greatest(20240116000000, max_id + 4500001) AS after_large_day FROM m"""
O["high_water_mark"] = """
SELECT 'all' AS part, strftime(max(ts), '%Y-%m-%d') AS max_date FROM events UNION ALL SELECT 'none', '1999-01-01'
UNION ALL SELECT event_type, strftime(max(ts), '%Y-%m-%d') FROM events GROUP BY event_type"""
O["incremental_filter"] = f"""
WITH gone AS (SELECT o_orderkey FROM orders WHERE o_orderdate::DATE <= DATE '{X.HIGH_WATER}'),
kept AS (SELECT l_orderkey AS id, count(*) AS n_items, round(sum(l_quantity), 2) AS quantity FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone) GROUP BY l_orderkey),
new AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders WHERE o_orderdate::DATE > DATE '{X.HIGH_WATER}')
SELECT coalesce(n.id, k.id) AS id, n.date, k.n_items, k.quantity FROM new n FULL JOIN kept k ON n.id = k.id"""
O["forward_fill"] = """
WITH u AS (SELECT l_orderkey * 100 + l_linenumber AS line, max(CASE WHEN l_linenumber = 2 THEN l_returnflag END) AS flag FROM lineitem GROUP BY 1
  HAVING flag IS NOT NULL OR max(CASE WHEN l_linenumber <> 3 THEN l_linestatus END) IS NOT NULL)
SELECT line, coalesce(last_value(flag IGNORE NULLS) OVER (ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Unknown') AS flag FROM u"""
O["stage_counts"] = f"""
WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')}
SELECT 'read' AS stage, count(*) AS rows FROM documents UNION ALL SELECT 'cleaned', count(*) FROM s WHERE NOT spam
UNION ALL SELECT 'distinct', count(DISTINCT text) FROM s WHERE NOT spam"""
O["distinct_labels"] = "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem"

O["tokenize_count"] = f"""
SELECT doc_id, cast(len(ws) AS INT) AS n_words, cast(len(list_distinct(ws)) AS INT) AS n_distinct FROM (SELECT doc_id, {words('text')} AS ws FROM documents)"""
O["normalize_text"] = f"SELECT doc_id, array_to_string({terms('text')}, ' ') AS normal FROM documents"
WORDS3 = f"SELECT * FROM (SELECT *, unnest({words('text')}) AS w FROM documents) WHERE length(w) > 2"
COUNTS = f"SELECT {stem('w')} AS term, count(*) AS n FROM ({WORDS3}) WHERE {stem('w')} NOT IN ({STEMS}) GROUP BY 1"
O["term_freq"] = COUNTS
O["word_freq"] = f"SELECT w AS term, count(*) AS n FROM ({WORDS3}) WHERE lower(w) NOT IN ({RAW_STOP}) GROUP BY 1"
O["clean_term_freq"] = rf"""
SELECT lower(w) AS term, count(*) AS n FROM (SELECT unnest({words('text')}) AS w FROM documents)
WHERE lower(w) NOT IN ({RAW_STOP}) AND length(lower(w)) <> 1 AND NOT regexp_matches(w, '^\p{{Nd}}+$') GROUP BY 1"""
O["top_terms"] = f"SELECT term, n FROM ({COUNTS}) WHERE n >= 100 ORDER BY n DESC, term LIMIT 50"
O["group_top_terms"] = f"""
SELECT lang, term, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS r FROM (
  SELECT lang, {stem('w')} AS term, count(*) AS n FROM ({WORDS3}) WHERE {stem('w')} NOT IN ({STEMS}) GROUP BY 1, 2)) WHERE r <= 20"""
O["review_top_terms"] = f"""
WITH top AS (SELECT term, n FROM ({COUNTS}) ORDER BY n DESC, term LIMIT 30),
held AS (SELECT DISTINCT doc_id, term, n FROM (SELECT doc_id, unnest({words('text')}) AS w FROM documents) JOIN top ON term = {stem('w')})
SELECT d.doc_id, coalesce(k.keywords, '') AS keywords FROM documents d
LEFT JOIN (SELECT doc_id, string_agg(term, ' ' ORDER BY n DESC, term) AS keywords FROM held GROUP BY doc_id) k USING (doc_id)"""
O["list_freq"] = """
SELECT term, count(*) AS n FROM (SELECT unnest(string_split(replace(p_name, ' ', ', ') || ', ' || p_type || ', ' || p_brand, ', ')) AS term FROM part) GROUP BY 1"""


def usual_sql(source, by):
    b = "".join(c + ", " for c in by)
    return f"""SELECT {b}term, word FROM (
      SELECT *, row_number() OVER (PARTITION BY {b}term ORDER BY n DESC, word) AS r FROM (
        SELECT {b}{stem('word')} AS term, word, count(*) AS n FROM (SELECT {b}unnest({words('text')}) AS word FROM {source}) GROUP BY ALL)) WHERE r = 1"""


O["surface_mode"] = usual_sql("documents", [])


def pairs_sql(source, phrase, keys):
    ks = ", ".join(keys)
    return f"""SELECT DISTINCT {ks}, w[i] || c || w[j] AS pair FROM (
      SELECT {ks}, w, i, unnest(range(1, len(w) + 1)) AS j FROM (
        SELECT {ks}, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT {ks}, string_split({phrase}, ' ') AS w FROM {source}))),
      (SELECT unnest([' ', '-', '_', '']) AS c) WHERE i <> j"""


O["pair_expand"] = pairs_sql("(SELECT DISTINCT p_name || ' ' || p_type AS phrase FROM part)", "phrase", ["phrase"])
O["negation_expand"] = f"""
WITH v AS (SELECT DISTINCT p_type AS store, string_split(p_name, ' ')[-1] AS verb FROM part)
SELECT DISTINCT store, f || ' ' || verb AS keyword FROM v, {values([(n,) for n in fixed.NEGATIONS], 'f')} UNION SELECT DISTINCT store, 'bug' FROM v"""
SENSES = """
senses AS (SELECT DISTINCT replace(p_name, ' ', '_') AS lemma, string_split(p_name, ' ')[1] || ':' || p_type AS synset_id, p_type AS rank FROM part),
firsts AS (SELECT lemma, arg_min(synset_id, rank || chr(1) || synset_id) AS first FROM senses GROUP BY lemma)"""


def synonyms_ctes(source):
    """CTE syn(word, synonym) for words in source(word)."""
    return f"""
    near AS (SELECT DISTINCT w.word, b.lemma FROM {source} w JOIN senses a ON a.lemma = w.word JOIN senses b USING (synset_id)),
    size AS (SELECT word, count(*) AS n, count(*) FILTER (lemma <> word) AS others FROM near GROUP BY word),
    ranked AS (
      SELECT near.word, near.lemma, row_number() OVER (PARTITION BY near.word ORDER BY near.lemma) AS r FROM near
      JOIN firsts f ON f.lemma = near.word JOIN firsts g ON g.lemma = near.lemma WHERE f.first = g.first AND near.lemma <> near.word
    ),
    syn AS (
      SELECT DISTINCT word, replace(lemma, '_', ' ') AS synonym FROM (
        SELECT near.word, lemma FROM near JOIN size USING (word) WHERE n <= 3 OR (others <= 3 AND lemma <> word)
        UNION ALL SELECT ranked.word, lemma FROM ranked JOIN size USING (word) WHERE n > 3 AND others > 3 AND r <= 3)
    )"""


O["synonym_expand"] = f"""
WITH {SENSES}, asked AS (SELECT DISTINCT replace(p_name, ' ', '_') AS word FROM part), {synonyms_ctes('asked')} SELECT word, synonym FROM syn"""
O["word_similarity"] = f"""
WITH {SENSES}, p AS (SELECT DISTINCT replace(p_name, ' ', '_') AS a, string_split(p_name, ' ')[1] || '_gear' AS b FROM part)
SELECT a, b, CASE WHEN f.first = g.first THEN 1 ELSE 0 END AS similar FROM p LEFT JOIN firsts f ON f.lemma = a LEFT JOIN firsts g ON g.lemma = b"""
O["component_keywords"] = f"""
WITH {SENSES},
seeds AS (SELECT DISTINCT p_type AS store, p_brand AS component, p_name AS keyword FROM part UNION SELECT DISTINCT p_type, p_brand, p_brand FROM part),
prs AS ({pairs_sql('seeds', 'keyword', ['store', 'component'])}),
asked AS (SELECT DISTINCT pair AS word FROM prs), {synonyms_ctes('asked')},
allk AS (SELECT * FROM seeds UNION SELECT * FROM prs UNION SELECT store, component, synonym FROM prs JOIN syn ON word = pair)
SELECT store, keyword, component, f.feature, '1' AS tier FROM allk
JOIN (SELECT p_type AS store, p_brand AS component, min(p_name) AS feature FROM part GROUP BY 1, 2) f USING (store, component)"""

O["proximity_match"] = f"WITH {FB}, {find_ctes('found', 'fb', ['id'], 'translated', [r for r in PLAIN if ' ' in r[1] or '-' in r[1]])} SELECT * FROM found"
O["find_words"] = f"WITH {FB}, {find_ctes('found', 'fb', ['id'], 'translated', PLAIN)} SELECT * FROM found"
_parts = pair_rows([("x", k) for k in X.PART_KEYWORDS])
O["find_in_parts"] = f"""
WITH fb AS (SELECT p_partkey AS id, p_type AS store, p_name FROM part), {find_ctes('found', 'fb', ['id'], 'p_name',
  f"(SELECT s.store, v.* EXCLUDE (x) FROM (SELECT DISTINCT p_type AS store FROM part) s, {values(_parts, 'x', 'keyword', 'pairs', 'pair_no', 'a', 'b')} v)")}
SELECT * FROM found"""
O["fallback_issue"] = """
WITH u AS (SELECT DISTINCT p_type AS store, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS keyword FROM part),
l AS (SELECT p_type AS store, p_name AS listed, p_size::VARCHAR AS issue FROM part),
w AS (SELECT store, keyword, ws[i] AS word, i FROM (SELECT store, keyword, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT store, keyword, string_split(keyword, ' ') AS ws FROM u))),
b AS (SELECT *, row_number() OVER (PARTITION BY store, keyword ORDER BY i DESC, listed) AS r FROM (
  SELECT DISTINCT w.store, w.keyword, w.i, l.listed FROM w JOIN l ON l.store = w.store AND contains(l.listed, w.word) WHERE w.word <> ''))
SELECT DISTINCT b.store, b.keyword, l.issue FROM b JOIN l ON l.store = b.store AND l.listed = b.listed WHERE r = 1"""
O["sentence_split"] = f"WITH {sentence_ctes('documents', 'doc_id', 'text')} SELECT doc_id, sid AS pos, sentence FROM sents WHERE sentence <> ''"
O["sentence_windows"] = f"""
WITH conv AS (SELECT conv_id * 1000000 + turn AS k, conv_id, turn, text FROM conversations), {sentence_ctes('conv', 'k', 'text')},
ss AS (SELECT k, list(sentence ORDER BY sid) AS s FROM sents WHERE sentence <> '' GROUP BY k),
runs AS (SELECT k, s, unnest(range(1, CASE WHEN len(s) > 2 THEN len(s) ELSE 2 END)) AS i FROM ss)
SELECT conv_id, turn, cast(i - 1 AS INT) AS pos, array_to_string(s[i:i+1], ' / ') AS run FROM runs JOIN conv USING (k)"""
O["keyword_context"] = f"""
WITH {FB}, {sentence_ctes('fb', 'id', 'translated')}, {CTX},
ks AS (SELECT fb.id, v.keyword FROM fb JOIN {values(PLAIN, 'store', 'keyword')} v USING (store))
SELECT id, keyword, cast(dense_rank() OVER (PARTITION BY id ORDER BY sid, i) - 1 AS INT) AS pos, context FROM ({contexts('ks')})"""
O["phrase_chunks"] = f"""
WITH {FB}, {phrase_ctes()} SELECT id, array_to_string(vps, ', ') AS verb_phrases, array_to_string(nps, ', ') AS noun_phrases FROM phr"""
O["phrase_text"] = f"""
WITH {FB}, {phrase_ctes()} SELECT id, array_to_string(vps || nps, ', ') AS text FROM phr WHERE len(vps) + len(nps) > 0"""
O["categorize"] = f"WITH {categorize_ctes()} SELECT id, feature, component, array_to_string(acts, ' || ') AS actions FROM cat"
O["generic_component_drop"] = """
WITH d AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem), n AS (SELECT l_orderkey, count(*) AS n FROM d GROUP BY 1)
SELECT l_orderkey, l_returnflag FROM d JOIN n USING (l_orderkey) WHERE l_returnflag <> 'N' OR n = 1"""
O["key_issues"] = f"WITH {FB}, {issue_ctes()} SELECT id, issue FROM iss"

O["tfidf"] = f"""
WITH b AS (SELECT lang, doc_id, list_transform(regexp_extract_all(text, '[{fixed.WORD_CHARS}]{{2,}}'), lambda w: lower(w)) AS bag FROM documents),
{weight_ctes('t', 'b', ['lang'], 'doc_id')} SELECT lang, doc_id, term, n_texts, round(weight, 6) AS weight FROM t_w"""
O["tfidf_over_loads"] = O["tfidf"]
O["cosine_pairs"] = f"""
WITH {FOLDED}, {weight_ctes('c', 'folded', ['store', 'device'], 'id', 'copies')}, {pairs_cte('c')}
SELECT store, device, a, b, round(similarity, 6) AS similarity FROM c_pairs"""
O["clusters"] = f"WITH RECURSIVE {cluster_ctes()} SELECT store, device, id, cluster FROM clusters"
CLUSTERED = "ct AS (SELECT fb.*, c.cluster FROM fb JOIN clusters c USING (id))"
O["cluster_summary"] = summary_sql(f"WITH RECURSIVE {cluster_ctes()}, {CLUSTERED}", "ct", "cluster", 80)
O["group_summary"] = summary_sql(f"WITH {FB}", "fb", "store", 80)


def cluster_keyword_ctes(source, k, drop=""):
    """CTE ck(store, cluster, keyword) over source(store, cluster, text)."""
    return f"""
    kw AS (
      SELECT store, cluster, {stem('w')} AS term, count(*) AS n FROM (SELECT store, cluster, unnest({words('text')}) AS w FROM {source}) kk
      WHERE length(w) > 2 AND {stem('w')} NOT IN ({STEMS}) {drop} GROUP BY 1, 2, 3
    ),
    csize AS (SELECT store, cluster, count(*) AS t FROM {source} GROUP BY 1, 2),
    kr AS (SELECT kw.*, t, row_number() OVER (PARTITION BY store, cluster ORDER BY n DESC, term) AS r FROM kw JOIN csize USING (store, cluster)),
    ck AS (SELECT store, cluster, u.word AS keyword FROM kr JOIN ({usual_sql(source, ['store', 'cluster'])}) u USING (store, cluster, term)
      WHERE r <= CASE WHEN t < 5 THEN 1 ELSE {k} END)"""


O["cluster_keywords"] = f"""
WITH RECURSIVE {cluster_ctes()}, ct AS (SELECT fb.store, c.cluster, translated AS text FROM fb JOIN clusters c USING (id)),
{cluster_keyword_ctes('ct', 3)} SELECT store, cluster, keyword FROM ck"""


def merged_ctes():
    """CTE mb(store, device, id, bag) over fb."""
    g = "store, device"
    return f"""
    nt AS (SELECT store, device, id, list_filter({terms('translated')}, lambda t: length(t) >= 2) AS bag, {terms('translated')} AS ts FROM fb),
    used AS (SELECT {g}, term, count(*) AS n FROM (SELECT {g}, unnest(ts) AS term FROM nt) WHERE length(term) >= 3 GROUP BY {g}, term HAVING count(*) >= 4),
    raw AS (SELECT {g}, translated AS text FROM fb),
    meant AS (SELECT {g}, term, n, array_to_string(list_sort(string_split(lower(word), '')), '') AS sense FROM used JOIN ({usual_sql('raw', ['store', 'device'])}) USING ({g}, term)),
    heads AS (SELECT *, first_value(term) OVER (PARTITION BY {g}, sense ORDER BY n DESC, term) AS head FROM meant),
    more AS (
      SELECT id, list_sort(list(head)) AS more FROM (SELECT DISTINCT {g}, id, term FROM (SELECT {g}, id, unnest(bag) AS term FROM nt))
      JOIN heads USING ({g}, term) WHERE term <> head GROUP BY id
    ),
    mb AS (SELECT {g}, id, bag || coalesce(more, []) AS bag FROM nt LEFT JOIN more USING (id))"""


O["merged_words"] = f"WITH {FB}, {merged_ctes()} SELECT id, array_to_string(bag, ' ') AS bag FROM mb"
_merged_clusters = cluster_ctes().replace(ONE + ",", "", 1).replace(
    f"list_sort(list_filter({terms('translated')}, lambda t: length(t) >= 2)) AS bag FROM fb", "list_sort(bag) AS bag FROM mb")
_known = ", ".join(sorted("(" + q(s) + ", " + q(pystem(k)) + ")" for s, k in PLAIN))
O["bottom_up_issues"] = f"""
WITH RECURSIVE {ONE}, {merged_ctes()}, {_merged_clusters}, {phrase_ctes()},
ct AS (SELECT c.store, c.cluster, array_to_string(vps || nps, ', ') AS text FROM clusters c JOIN phr USING (id) WHERE len(vps) + len(nps) > 0),
{cluster_keyword_ctes('ct', 1, f"AND (store, {stem('w')}) NOT IN (SELECT * FROM (VALUES {_known}))")}
SELECT c.id, ck.keyword AS issue FROM clusters c JOIN ck ON ck.cluster = c.cluster"""

O["preprocess"] = f"""
WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')},
kept AS (SELECT s.text AS original, min(s.doc_id) AS doc_id FROM s WHERE NOT spam GROUP BY s.text),
memory AS (SELECT DISTINCT lang, text FROM documents JOIN labels USING (doc_id)),
tr AS (
  SELECT k.doc_id, k.original, CASE WHEN d.lang = 'en' THEN k.original WHEN m.text IS NOT NULL THEN 'it''s ' || replace(k.original, 'a', 'A')
    ELSE {q(fixed.NO_LANGUAGE)} END AS translated
  FROM kept k JOIN documents d USING (doc_id) LEFT JOIN memory m ON m.lang = d.lang AND m.text = k.original
),
{screened('z', 'tr', 'doc_id', 'translated')}, {sentiment_ctes('tr', 'doc_id', 'translated')}
SELECT row_number() OVER (ORDER BY tr.doc_id) - 1 AS id, tr.doc_id, tr.original, z.text AS translated, {LABEL} AS sentiment, 0 AS spam
FROM tr JOIN z USING (doc_id) JOIN senti USING (doc_id) WHERE NOT z.spam"""
O["report"] = f"""
WITH {categorize_ctes()}, {issue_ctes()},
c AS (SELECT id, string_agg(DISTINCT component, ', ' ORDER BY component) AS components, count(DISTINCT component) AS n FROM cat GROUP BY id),
i AS (SELECT id, string_agg(issue, ', ' ORDER BY issue) AS issues FROM iss GROUP BY id)
SELECT fb.id, fb.store, fb.device, coalesce(components, '') AS components, coalesce(issues, '') AS issues, cast(coalesce(n, 0) AS INT) AS n_components
FROM fb LEFT JOIN c USING (id) LEFT JOIN i USING (id)"""
O["order_report"] = """
SELECT o_orderkey AS id, o_orderstatus, coalesce(string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag), '') AS components,
  coalesce(string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus), '') AS issues, cast(count(DISTINCT l_returnflag) AS INT) AS n_components
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2"""
O["id_lookup"] = "SELECT doc_id::VARCHAR AS id, quality::VARCHAR AS key_issue FROM labels WHERE doc_id = (SELECT max(doc_id) FROM labels)"
O["id_range"] = "SELECT min(l_orderkey) AS min_id, max(l_orderkey) AS max_id FROM lineitem"
O["component_counts"] = f"""
WITH RECURSIVE {screened('s', 'documents', 'doc_id', 'text')},
kept AS (SELECT text, min(doc_id) AS id FROM s WHERE NOT spam GROUP BY text),
fb AS (SELECT k.id, d.lang AS store, k.text AS translated FROM kept k JOIN documents d ON d.doc_id = k.id),
{find_ctes('found', 'fb', ['id'], 'translated', COMPONENT_WORDS)}
SELECT store, component, count(DISTINCT id) AS reviews FROM found JOIN {values(sorted({c[:3] for c in COMPONENTS_AND_SIDES}), 'store', 'keyword', 'component')} c USING (store, keyword)
GROUP BY store, component"""
