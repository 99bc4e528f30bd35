"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from tripmill.llm import quality_rules, url_graph

SPACES = r"[ \t\n\v\f\r]"
WORDS = r"[^ \t\n\v\f\r]+"


def quality_sql() -> str:
    bits = " + ".join(f"CASE WHEN {test} THEN {1 << k} ELSE 0 END" for k, test in enumerate(quality_rules.RULES.values()))
    base = quality_rules.mask(quality_rules.BASE)
    policy = base | quality_rules.mask(quality_rules.POLICIES[quality_rules.CURRENT])
    return f"""
        WITH d AS (
          SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
        ), w AS (
          SELECT *, regexp_extract_all(t, '{WORDS}') AS ws,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\v\\f\\r]')) AS ls
          FROM d
        ), wins AS (
          SELECT rid, i, array_to_string(ws[i + 1 : i + 5], ' ') AS win
          FROM (SELECT rid, ws, unnest(range(0, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)
        ), twice AS (
          SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, win) AS n FROM wins) WHERE n > 1
        ), covered AS (
          SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY rid
        ), m AS (
          SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
            CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
            CAST(len(regexp_extract_all(t, '\\p{{Lu}}')) AS BIGINT) AS n_upper,
            CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
          FROM w LEFT JOIN covered c USING (rid)
        ), f AS (SELECT *, CAST({bits} AS BIGINT) AS failed_bits FROM m)
        SELECT *, failed_bits & {base} <> 0 AS base_failed, failed_bits & {policy} = 0 AS kept FROM f"""


def ablations_sql() -> str:
    """Per policy and rule, over the rows of the ledger's SQL."""
    rules = quality_rules
    lines = ", ".join(
        f"('{policy}', '{rule}', {rules.mask((rule,))}, {rules.mask(own)})" for policy, own in rules.POLICIES.items() for rule in own
    )
    return f"""
        SELECT policy, rule, CAST(count(*) FILTER (failed_bits & rule_bit <> 0) AS BIGINT) AS n_failed,
          CAST(count(*) FILTER (failed_bits & policy_bits = rule_bit) AS BIGINT) AS n_only_this
        FROM (VALUES {lines}) AS g(policy, rule, rule_bit, policy_bits) LEFT JOIN ({quality_sql()}) ON true
        GROUP BY policy, rule"""


def vectors_sql() -> str:
    return """
        WITH RECURSIVE v AS (
          SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        ), good AS (
          SELECT * FROM v
          WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
            AND len(list_filter(x, lambda e: e <> 0)) > 0
        ), links AS (
          SELECT a.rid AS a, b.rid AS b, b.vec_id AS other
          FROM good a JOIN good b ON a.rid <> b.rid AND len(a.x) = len(b.x)
          WHERE list_cosine_similarity(a.x, b.x) >= 0.95
        ), reach AS (
          SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a
        ), least AS (SELECT r.a, min(v.vec_id) AS low FROM reach r JOIN v ON v.rid = r.b GROUP BY r.a)
        SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links,
          least(v.vec_id, coalesce(l.low, v.vec_id)) AS component_id,
          v.vec_id = least(v.vec_id, coalesce(l.low, v.vec_id)) AS kept
        FROM v LEFT JOIN degree d ON d.a = v.rid LEFT JOIN least l ON l.a = v.rid"""


def shingles_sql() -> str:
    return f"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS ws
          FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 4], ' ') AS shingle
          FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 3, 1))) AS i FROM d WHERE len(ws) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), common AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
          FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
          SELECT a, b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
          WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
        ), reach AS (
          SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
          least(d.doc_id, coalesce(l.low, d.doc_id)) AS component_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id"""


def urls_sql() -> str:
    """The walks are unrolled, one step after the other."""
    rule = "CAST(NULL AS VARCHAR)"
    for text, _ in sorted(url_graph.RULES, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}')"
        rule = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END"
    verdict = "CASE rule " + " ".join(f"WHEN '{text}' THEN '{v}'" for text, v in url_graph.RULES) + " END"
    give = url_graph.DAMPING
    steps = ["s0 AS (SELECT walk, host, seed AS score FROM seeds)"]
    for k in range(url_graph.ITERATIONS):
        steps.append(f"""g{k} AS MATERIALIZED (
          SELECT e.walk, e.dst AS host, sum(s.score * (1 / o.degree)) AS got FROM edges e
          JOIN degrees o ON o.walk = e.walk AND o.src = e.src JOIN s{k} s ON s.walk = e.walk AND s.host = e.src GROUP BY ALL
        ), s{k + 1} AS MATERIALIZED (
          SELECT walk, host, sum(part) AS score FROM (
            SELECT s.walk, s.host, s.seed * (1 - {give} * coalesce(p.passed, 0.0)) AS part
            FROM seeds s LEFT JOIN (SELECT walk, sum(got) AS passed FROM g{k} GROUP BY walk) p ON p.walk = s.walk
            UNION ALL SELECT walk, host, {give} * got FROM g{k}) GROUP BY ALL
        )""")
    last = url_graph.ITERATIONS
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    link = r"""(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)"""
    return f"""
        WITH p AS (
          SELECT page_id, html, {lower("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages
        ), ruled0 AS (SELECT *, {rule} AS rule FROM p
        ), ruled AS (SELECT *, {verdict} AS by_rule FROM ruled0
        ), weights AS (
          SELECT * FROM (
            SELECT 'trust' AS walk, host, count(*) FILTER (by_rule = 'allow') AS weight FROM ruled WHERE rule IS NOT NULL GROUP BY host
            UNION ALL
            SELECT 'distrust', host, count(*) FILTER (by_rule = 'block' AND instr(rule, '/') = length(rule))
            FROM ruled WHERE rule IS NOT NULL GROUP BY host) WHERE weight > 0
        ), seeds AS (SELECT walk, host, weight / sum(weight) OVER (PARTITION BY walk) AS seed FROM weights
        ), links AS (
          SELECT DISTINCT host AS src, {lower("h")} AS dst
          FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS h FROM ruled)
          WHERE host <> '' AND h <> '' AND host <> {lower("h")}
        ), edges AS (
          SELECT 'trust' AS walk, src, dst FROM links UNION ALL SELECT 'distrust', dst, src FROM links
        ), degrees AS (SELECT walk, src, count(*) AS degree FROM edges GROUP BY ALL
        ), {", ".join(steps)}, scores AS (
          SELECT host, coalesce(sum(score) FILTER (walk = 'trust'), 0.0) AS trust,
            coalesce(sum(score) FILTER (walk = 'distrust'), 0.0) AS distrust FROM s{last} GROUP BY host
        ), judged AS (
          SELECT page_id, host, path, rule, by_rule, coalesce(trust, 0.0) AS trust, coalesce(distrust, 0.0) AS distrust
          FROM ruled LEFT JOIN scores USING (host)
        )
        SELECT page_id, host, path, rule,
          coalesce(by_rule, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
          trust, distrust
        FROM judged"""


def ranked_sql() -> str:
    """Every document that shares a term with an item, scored in whole numbers."""
    found = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {found} AS terms FROM documents
        ), i AS (SELECT row_number() OVER () AS item, item_id, unnest(list_distinct({found})) AS term FROM benchmark
        ), totals AS (
          SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d WHERE len(terms) > 0
        ), tf AS (
          SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY ALL
        ), weights AS (
          SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term
        ), lengths AS (SELECT rid, doc_id, 100 - 90 + (90 * len(terms) * n) // l AS m FROM d, totals WHERE len(terms) > 0
        ), scores AS (
          SELECT item, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
          FROM i JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (rid) GROUP BY ALL
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, rid) AS rank FROM scores WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


def negatives_sql() -> str:
    """All anchors against all rows."""
    return """
        WITH v AS (
          SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS x
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
        ), scores AS (
          SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
            CAST(coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
          FROM v a JOIN v b ON a.rid <> b.rid AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0
        ), positives AS (
          SELECT anchor, anchor_id, rid, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= 5
        ), negatives AS (
          SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY s.score DESC, s.vec_id, s.rid) AS rank
          FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
          WHERE 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM negatives WHERE rank <= 5"""


def secrets_sql() -> str:
    """Every rule on its own: the text between matches tells where they are."""
    letters = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    names = "|".join(letters(w) for w in ("password", "passwd", "secret", "token")) + f"|{letters('api')}_?{letters('key')}"
    # Kind, what is searched for, what a match must be.
    assign = f"(?:{names})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]"
    rules = [
        ("assign", assign + "+", assign + "{8,}"),
        ("access", "AKIA[A-Z0-9]+", ".{16,}"),
        ("hex", "[0-9a-f]{32,}", ".+"),
        ("github", "gh[pousr]_[A-Za-z0-9]+", ".{40,}"),
        ("slack", "xox[abeoprs]-[A-Za-z0-9-]+", ".{15,}"),
        ("google", "AIza[A-Za-z0-9_-]+", ".{39,}"),
        ("stripe", "[rs]k_(?:live|test)_[A-Za-z0-9]+", ".{24,}"),
        ("jwt", "eyJ[A-Za-z0-9_.-]+", ".{43,}"),
        ("key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", ".+"),
    ]
    quoted = [tuple(x.replace("'", "''") for x in rule) for rule in rules]
    each = " UNION ALL ".join(
        f"""SELECT rid, {k} AS rule, '{kind}' AS kind, '{good}' AS good,
          regexp_extract_all(t, '{search}') AS ms, string_split_regex(t, '{search}') AS rest FROM d"""
        for k, (kind, search, good) in enumerate(quoted)
    )
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{kind}') AS BIGINT) AS n_{kind}" for kind, _, _ in rules[:3])
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
        ), found AS ({each}
        ), places AS (
          SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM found WHERE len(ms) > 0
        ), spans AS (
          SELECT rid, rule, kind, length(array_to_string(rest[1:k], '')) + length(array_to_string(ms[1:k - 1], '')) AS a, length(ms[k]) AS n
          FROM places WHERE regexp_full_match(ms[k], good)
        ), lines AS (SELECT rid, rule, kind, a, kind || ':' || a || ':' || (a + n) AS line FROM spans
        ), told AS (
          SELECT rid, {counts}, string_agg(line, ',' ORDER BY a, rule) FILTER (rule < 3) AS base,
            string_agg(line, ',' ORDER BY a, rule) AS spans
          FROM lines GROUP BY rid
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
          sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN told USING (rid)"""


ORACLES: dict[str, str] = {
    "op5_quality_ledger": quality_sql(),
    "quality_ablations": ablations_sql(),
    "op6_sorted_projections": vectors_sql(),
    "op9_url_graph": urls_sql(),
    "op10_shingle_tiles": shingles_sql(),
    "op11_k2_treap": ranked_sql(),
    "op12_anchor_tree": negatives_sql(),
    "op13_secret_automaton": secrets_sql(),
}
