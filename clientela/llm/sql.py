"""SQL for the queries of this package whose result is determined."""

from __future__ import annotations

from clientela.llm.licenses import TEMPLATES, ScanConfig
from clientela.llm.mixing import NONE, MixConfig
from clientela.llm.queries import BLOCKED_HOSTS, URL_RULES
from clientela.llm.urlfilter import UPPER

ORACLES: dict[str, str] = {}


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, null for null: a step per byte, and one per bit of it."""
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
        string_split({text}, ''),
        lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                          ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

LOWER = f"'{UPPER}', '{UPPER.lower()}'"
SPACE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))


def _url_filter() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    hosts = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
    return f"""
    WITH rests AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0
                             THEN substr(url, strpos(url, '://') + 3) END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), {LOWER}), '') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM rests
    ), rules(verdict, rule_host, rule_path) AS (VALUES {rules}),
    blocked(blocked_host) AS (VALUES {hosts}),
    fits AS (
        SELECT page_id, rule_host || rule_path AS rule, verdict,
               row_number() OVER (PARTITION BY page_id
                                  ORDER BY length(rule_host || rule_path) DESC) AS place
        FROM parts JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host))
         AND starts_with(path, rule_path)
    ), listed AS (
        SELECT DISTINCT page_id FROM parts JOIN blocked
          ON host = blocked_host OR ends_with(host, '.' || blocked_host)
    )
    SELECT p.page_id, p.host, p.path, f.rule,
           coalesce(f.verdict, CASE WHEN l.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM parts p
    LEFT JOIN (SELECT * FROM fits WHERE place = 1) f ON p.page_id = f.page_id
    LEFT JOIN listed l ON p.page_id = l.page_id
    """


def _line_dedup() -> str:
    return f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, translate(trim(line, {SPACE}), {LOWER}) AS line_key FROM lines
    ), shared AS (
        SELECT line_key AS shared_key, max(doc_id) AS top FROM keyed
        WHERE length(line_key) >= 40
        GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5
    ), judged AS (
        SELECT doc_id, line, pos, coalesce(doc_id < top, false) AS dropped
        FROM keyed LEFT JOIN shared ON line_key = shared_key
    )
    SELECT doc_id, count(*) AS n_lines,
           count(CASE WHEN dropped THEN 1 END) AS n_dropped,
           sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY pos),
                           '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """


def _near_duplicates() -> str:
    return f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(
            regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[ \\t-\\r]+'),
            lambda w: length(w) > 0) AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh
        FROM words WHERE len(w) > 0
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id
        JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, p.n, q.n
        HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
    ), reach(x, y) AS (
        SELECT x, y FROM links
        UNION
        SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
    ), roots AS (
        SELECT x, min(y) AS root FROM reach GROUP BY x
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
           least(d.doc_id, coalesce(r.root, d.doc_id)) AS component_id,
           d.doc_id = least(d.doc_id, coalesce(r.root, d.doc_id)) AS kept
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN roots r ON r.x = d.doc_id
    """


def _license_scan() -> str:
    cfg = ScanConfig()
    rows = ", ".join(
        f"('{t.name}', {len(t.words())}, {t.shingles(cfg.shingle)}, {t.least(cfg)})"
        for t in TEMPLATES
    )
    return f"""
    WITH templates(license, m, parts, least) AS (VALUES {rows}),
    words AS (
        SELECT doc_id, list_filter(
            regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[ \\t-\\r]+'),
            lambda w: length(w) > 0) AS w
        FROM documents
    ), starts AS (
        SELECT doc_id, license, m, parts, least, w, unnest(range(0, len(w), m)) AS start
        FROM words, templates
    ), windows AS (
        SELECT doc_id, license, parts, least, start, w[start + 1 : start + 2 * m] AS x FROM starts
    ), held AS (
        SELECT doc_id, license, parts, least, start, list_distinct(list_transform(
            range(1, greatest(len(x) - 1, 1)),
            lambda k: x[k] || ' ' || x[k + 1] || ' ' || x[k + 2])) AS sh
        FROM windows WHERE len(x) >= 3
    ), counted AS (
        SELECT doc_id, license, start, least, len(parts) AS n_template,
               len(list_filter(parts, lambda p: list_contains(sh, p))) AS n
        FROM held
    )
    SELECT doc_id, license, max(n) AS n_found, max(n_template) AS n_template,
           min(start) AS first_word, count(DISTINCT start) AS n_windows,
           round(max(n) / max(n_template), 6) AS containment
    FROM counted WHERE n >= least GROUP BY doc_id, license
    """


#: Rounds of raking in SQL. Where it ends does not depend on how many more there are.
RAKING_ROUNDS = 60


def _mixture() -> str:
    """Target shares straight from token counts; probabilities from rounds that only SQL takes."""
    cfg = MixConfig()
    names = list(cfg.targets)
    keys = ", ".join(names)
    most = 1 / cfg.budget
    steps = [
        f"""docs AS (
            SELECT doc_id, source, lang,
                   CASE WHEN text LIKE '% | %' THEN 'table' WHEN text LIKE '%!!%' THEN 'shout'
                        WHEN n < 150 THEN 'short' WHEN n >= 1000 THEN 'long' ELSE 'prose'
                   END AS topic, n AS n_tokens
            FROM (SELECT *, len(list_filter(
                      regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'),
                      lambda w: length(w) > 0)) AS n
                  FROM documents)
        )""",
        f"cells AS (SELECT {keys}, sum(n_tokens) AS tokens FROM docs GROUP BY {keys})",
        """based AS (SELECT *, coalesce(tokens / nullif(sum(tokens) OVER (), 0), 0) AS base
                     FROM cells)""",
    ]
    for name, target in cfg.targets.items():
        # A value gets what it asks for or all it has. In the order of what it has against what it
        # asks for, the first are those that get all; the others share what these leave.
        steps.append(
            f"""asked_{name} AS (
                SELECT *, CASE WHEN wish > 0 THEN limited / wish END AS ratio
                FROM (SELECT {name}, sum(base) * {most} AS limited,
                             CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {target.power})
                                  ELSE 0 END AS wish
                      FROM based GROUP BY {name})
            ),
            level_{name} AS (
                SELECT max(level) AS level FROM (
                    SELECT ratio, (1 - coalesce(sum(limited) OVER before, 0)) /
                                  (sum(wish) OVER () - coalesce(sum(wish) OVER before, 0)) AS level
                    FROM asked_{name} WHERE wish > 0
                    WINDOW before AS (ORDER BY ratio, {name} NULLS FIRST
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                WHERE level <= ratio
            ),
            target_{name} AS (
                SELECT {name}, least(limited, coalesce(wish * level, limited)) AS share
                FROM asked_{name}, level_{name}
            )"""
        )
    inner = "raked"
    for name in names:
        inner = f"""(
            SELECT c.* EXCLUDE (m, high, low), m * CASE
                       WHEN high + low = 0 THEN 1 WHEN share <= high THEN share / (high + low)
                       WHEN low > 0 THEN (share - high) / low ELSE 1 END AS m
            FROM (SELECT *,
                         sum(CASE WHEN m >= {most} THEN base * {most} ELSE 0 END)
                             OVER (PARTITION BY {name}) AS high,
                         sum(CASE WHEN m < {most} THEN base * m ELSE 0 END)
                             OVER (PARTITION BY {name}) AS low
                  FROM {inner}) c
            JOIN (SELECT {name} AS at, share FROM target_{name}) t
              ON c.{name} IS NOT DISTINCT FROM t.at)"""
    steps.append(
        f"""raked AS (
            SELECT {keys}, tokens, base, 0 AS k, 1.0::DOUBLE AS m FROM based
            UNION ALL
            SELECT {keys}, tokens, base, k + 1, m FROM {inner} WHERE k < {RAKING_ROUNDS}
        )"""
    )
    steps.append(
        f"""chances AS (
            SELECT {keys}, CASE WHEN tokens > 0 THEN least(1.0, m * {cfg.budget}) ELSE 0 END AS p
            FROM raked WHERE k = {RAKING_ROUNDS}
        )"""
    )
    shares = ", ".join(f"round(t_{n}.share, 6) AS {n}_share" for n in names)
    targets = " ".join(
        f"JOIN target_{n} t_{n} ON d.{n} IS NOT DISTINCT FROM t_{n}.{n}" for n in names
    )
    same = " AND ".join(f"d.{n} IS NOT DISTINCT FROM c.{n}" for n in names)
    return f"""
    WITH RECURSIVE {", ".join(steps)}
    SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(p, 6) AS probability,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '{NONE}') || ':{cfg.seed}'),
                               1, 13) AS BIGINT) / {float(1 << 52)!r} < p AS kept,
           {shares}
    FROM docs d JOIN chances c ON {same} {targets}
    """


def _merkle() -> str:
    def row(n_chars: str) -> str:
        fields = ("doc_id", "source", "lang", n_chars, "text")
        parts = [
            f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"
            for f in fields
        ]
        return f"sha256({' || '.join(parts)})"

    return f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, lang, {row("n_chars")} AS leaf,
               CASE WHEN crc % 7 = 0 THEN {row("(n_chars + 1)")} ELSE {row("n_chars")} END AS seen
        FROM (SELECT *, {crc32('CAST(doc_id AS VARCHAR)')} AS crc FROM documents)
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY lang
                                     ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
        FROM leaves
    ), nodes(lang, level, place, node, size) AS (
        SELECT lang, 0, place, leaf, count(*) OVER (PARTITION BY lang) FROM placed
        UNION ALL
        SELECT lang, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)),
               (any_value(size) + 1) // 2
        FROM nodes WHERE size > 1 GROUP BY lang, level, place // 2
    ), subroots AS (
        SELECT lang, level AS height, node AS subroot,
               row_number() OVER (ORDER BY lang COLLATE C NULLS FIRST) - 1 AS tree,
               count(*) OVER () AS trees
        FROM nodes WHERE size = 1
    ), tops(level, place, node, size) AS (
        SELECT 0, tree, subroot, trees FROM subroots
        UNION ALL
        SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)),
               (any_value(size) + 1) // 2
        FROM tops WHERE size > 1 GROUP BY level, place // 2
    ), root AS (
        SELECT level AS top_height, node AS root FROM tops WHERE size = 1
    ), walk(lang, start, level, place, tree, folded, proof) AS (
        SELECT p.lang, p.place, 0, p.place, s.tree, p.seen, ''
        FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
        UNION ALL
        SELECT w.lang, w.start, w.level + 1, w.place // 2, w.tree,
               sha256(CASE WHEN w.place % 2 = 1 THEN n.node ELSE '' END || w.folded
                      || CASE WHEN w.place % 2 = 0 THEN coalesce(n.node, '') ELSE '' END),
               w.proof || coalesce(n.node, '')
        FROM walk w JOIN subroots s ON w.lang IS NOT DISTINCT FROM s.lang AND w.level < s.height
        LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM w.lang AND n.level = w.level
                         AND n.place = xor(w.place, 1)
    ), climb(lang, start, level, place, folded, proof) AS (
        SELECT w.lang, w.start, 0, w.tree, w.folded, w.proof
        FROM walk w JOIN subroots s ON w.lang IS NOT DISTINCT FROM s.lang AND w.level = s.height
        UNION ALL
        SELECT c.lang, c.start, c.level + 1, c.place // 2,
               sha256(CASE WHEN c.place % 2 = 1 THEN t.node ELSE '' END || c.folded
                      || CASE WHEN c.place % 2 = 0 THEN coalesce(t.node, '') ELSE '' END),
               c.proof || coalesce(t.node, '')
        FROM climb c JOIN root r ON c.level < r.top_height
        LEFT JOIN tops t ON t.level = c.level AND t.place = xor(c.place, 1)
    )
    SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(c.proof) AS proof_sha256,
           c.folded AS folded_root, c.folded = r.root AS verified
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
    JOIN root r ON true
    JOIN climb c ON c.lang IS NOT DISTINCT FROM p.lang AND c.start = p.place
                AND c.level = r.top_height
    """


def _conversation_trie() -> str:
    head = f"CAST({crc32('CAST(conv_id AS VARCHAR)')} % 9 AS BIGINT)"
    return f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (
                   PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                          || coalesce(text, ''))) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT *, conv_id - conv_id % 5 AS head_id, {head} AS taken
        FROM (SELECT DISTINCT conv_id FROM turns)
    ), rebuilt AS (
        SELECT c.conv_id, t.place, t.role, t.text
        FROM convs c JOIN turns t ON t.conv_id = c.head_id AND t.place <= c.taken
        UNION ALL
        SELECT c.conv_id, c.taken + t.place, t.role, t.text
        FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.taken
    ), sequences AS (
        SELECT conv_id,
               list(sha256(strlen(role) || ':' || role || text) ORDER BY place) AS seq,
               list(strlen(text) ORDER BY place) AS sizes
        FROM rebuilt GROUP BY conv_id
        UNION ALL
        SELECT conv_id, [], [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM rebuilt)
    ), prefixes AS (
        SELECT conv_id, len(seq) AS size, unnest(range(len(seq) + 1)) AS depth,
               unnest(list_transform(range(len(seq) + 1),
                                     lambda d: sha256(array_to_string(seq[1:d], ',')))) AS node,
               unnest(list_transform(range(len(seq) + 1),
                                     lambda d: CASE WHEN d = 0 THEN 0 ELSE sizes[d] END)) AS bytes
        FROM sequences
    ), nodes AS (
        SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
               coalesce(string_agg(CASE WHEN size = depth THEN CAST(conv_id AS VARCHAR) END, ','
                                   ORDER BY conv_id), '') AS ends
        FROM prefixes GROUP BY depth, node
    ), linked AS (
        SELECT n.*, p.node AS parent, q.conv_id AS parent_conv_id
        FROM nodes n
        LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
        LEFT JOIN nodes q ON q.depth = p.depth AND q.node = p.node
    ), heirs AS (
        SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children
        FROM linked WHERE depth > 0 GROUP BY parent, depth
    ), counted AS (
        SELECT l.*, coalesce(h.n_children, 0) AS n_children
        FROM linked l LEFT JOIN heirs h ON h.depth = l.depth AND h.node = l.node
    ), subtrees AS (
        SELECT p.depth, p.node, count(CASE WHEN u.n_children = 0 THEN 1 END) AS n_leaves,
               sum((u.n_convs - 1) * u.bytes) AS saved_tokens
        FROM counted u JOIN prefixes p ON p.conv_id = u.conv_id AND p.depth <= u.depth
        GROUP BY p.depth, p.node
    )
    SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves,
           CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
    FROM counted c JOIN subtrees s ON s.depth = c.depth AND s.node = c.node
    """


ORACLES["op2_license_scan"] = _license_scan()
ORACLES["op4_source_mixture"] = _mixture()
ORACLES["op3_near_duplicates"] = _near_duplicates()
ORACLES["op8_line_dedup"] = _line_dedup()
ORACLES["op10_url_filter"] = _url_filter()
ORACLES["op13_merkle_manifest"] = _merkle()
ORACLES["op11_conversation_trie"] = _conversation_trie()
