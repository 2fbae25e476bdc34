"""The same results in DuckDB's SQL, for those operators that SQL can express."""

from shardlog.llm import hosts, licences, negatives, quality, quantise

BLANK = r"[\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def exact_dedup() -> str:
    return rf"""
    WITH n AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g') AS norm FROM documents
    )
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST)
    """


def quality_rules() -> str:
    value = {
        "symbols": "1000 * n_symbols // nullif(word_chars, 0)",
        "dup_lines": "1000 * n_dup_lines // nullif(n_lines, 0)",
        "repeats": "1000 * n_repeat_words // nullif(n_words, 0)",
        "capitals": "1000 * n_capitals // nullif(word_chars, 0)",
        "shouts": "1000 * n_shouts // nullif(word_chars, 0)",
    }
    path = ", ".join(f"('{name}', {j}, {c})" for name, cuts in quality.PATH.items() for j, c in enumerate(cuts))
    each = " UNION ALL ".join(f"SELECT rid, lang, doc_id, '{n}' AS signal, coalesce({v}, 0) AS value FROM counts" for n, v in value.items())
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
    split AS (
        SELECT *, list_filter(string_split_regex(t, '{BLANK}+'), lambda x: x <> '') AS words,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM d
    ),
    windows AS (
        SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
        FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split)
    ),
    met AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, w) AS c FROM windows) WHERE c > 1),
    covered AS (
        SELECT rid, count(*) AS n FROM (
            SELECT rid, i FROM met UNION SELECT rid, i + 1 FROM met UNION SELECT rid, i + 2 FROM met
        ) GROUP BY rid
    ),
    counts AS (
        SELECT rid, doc_id, lang, len(words) AS n_words,
               length(regexp_replace(t, '{BLANK}', '', 'g')) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
               length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
               length(t) - length(replace(t, '!', '')) AS n_shouts,
               coalesce(c.n, 0) AS n_repeat_words
        FROM split LEFT JOIN covered c USING (rid)
    ),
    signals AS ({each}),
    path(signal, j, cutoff) AS (VALUES {path}),
    over AS (SELECT rid, min(j) AS level FROM signals JOIN path USING (signal) WHERE value > cutoff GROUP BY rid),
    marked AS (
        SELECT c.lang, l.quality = 1 AS good, CASE WHEN n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words
               THEN {quality.LEVELS} ELSE coalesce(o.level, {quality.LEVELS}) END AS level
        FROM counts c JOIN labels l USING (doc_id) LEFT JOIN over o USING (rid) WHERE c.lang IS NOT NULL AND l.quality IS NOT NULL
    ),
    strata AS (SELECT count(DISTINCT lang) AS strata FROM marked),
    tried AS (
        SELECT lang, j, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS m,
               count(*) FILTER (good AND level <= j) AS k, count(*) FILTER (NOT good AND level <= j) AS caught
        FROM marked, range({quality.LEVELS}) AS r(j) GROUP BY ALL
    ),
    tested AS (
        SELECT *, CASE WHEN k < n * {quality.ALPHA} THEN list_sum(list_transform(range(0, k + 1), lambda i:
                   exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality.ALPHA}) + (n - i) * ln(1 - {quality.ALPHA})))) ELSE 1 END
                   <= {quality.DELTA} / strata AS passed,
               coalesce(caught / nullif(m, 0), 0) - {quality.COST} * k / nullif(n, 0) AS gain
        FROM tried, strata
    ),
    sure AS (
        SELECT *, coalesce(min(CASE WHEN NOT passed THEN j END) OVER (PARTITION BY lang), {quality.LEVELS}) AS failed FROM tested
    ),
    levels AS (
        SELECT lang, j FROM sure WHERE j < failed AND gain > 0
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY gain DESC, j) = 1
    ),
    beyond AS (SELECT rid FROM counts c JOIN over o USING (rid) JOIN levels v ON c.lang = v.lang AND o.level <= v.j),
    based AS (
        SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND b.rid IS NULL AS kept
    FROM based LEFT JOIN beyond b USING (rid)
    """


def license_scan() -> str:
    def canonical(text: str) -> str:
        made = f"regexp_replace(lower({text}), {_quoted(licences.COPYRIGHT.replace('(?md)', '(?m)'))}, ' ', 'g')"
        made = rf"(' ' || regexp_replace({made}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ')"
        for variant, put in licences.EQUIVALENT:
            made = f"replace({made}, {_quoted(variant)}, {_quoted(put)})"
        pattern, put = licences.VERSION
        return f"trim(regexp_replace({made}, {_quoted(pattern)}, {_quoted(put.replace('$', chr(92)))}, 'g'))"

    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licences.KNOWN)
    return f"""
    WITH known AS (
        SELECT c, min(license) AS license FROM (SELECT license, {canonical('text')} AS c FROM (VALUES {rows}) k(license, text))
        WHERE c <> '' GROUP BY c
    ),
    d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    whole AS (SELECT rid, doc_id, {canonical('text')} AS c FROM d),
    lines AS (SELECT rid, {canonical('line')} AS c FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)),
    found AS (
        SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS names, count(*) AS n FROM lines JOIN known USING (c) GROUP BY rid
    )
    SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS text_digest, license,
           coalesce(names, '') AS line_licenses, coalesce(n, 0) AS n_license_lines
    FROM whole LEFT JOIN known USING (c) LEFT JOIN found USING (rid)
    """


def url_filter(rules: list[tuple[str, str]]) -> str:
    """Every host of the given tables lies under a suffix of one label and is a plain name."""
    table = ", ".join(f"({_quoted(v)}, {_quoted(r)}, {_quoted(r.partition('/')[0])}, {_quoted('/' + r.partition('/')[2])})" for v, r in rules)

    def shrunk(name: str, mean: str) -> str:
        return f"""(
            SELECT *, x + s * {mean} AS a, n - x + s * (1 - {mean}) AS b
            FROM {name}, (
                SELECT 1 / CASE WHEN coalesce(possible, 0) = 0 THEN 0.001 ELSE least(0.999, greatest(0.001, beyond / possible)) END - 1 AS s
                FROM (SELECT sum(pow(x - n * {mean}, 2) - n * {mean} * (1 - {mean})) AS beyond,
                             sum(n * (n - 1) * {mean} * (1 - {mean})) AS possible FROM {name})
            )
        )"""

    return rf"""
    WITH p AS (
        SELECT row_number() OVER () AS rid, page_id,
               translate(coalesce(regexp_extract(url, '{hosts.PARTS}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '{hosts.PARTS}', 2), '') AS path
        FROM pages
    ),
    outcomes AS (
        SELECT page_id, count(*) AS n, sum((quality = 0 OR toxic = 1)::BIGINT) AS x
        FROM (SELECT DISTINCT page_id, TRY_CAST(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT) AS doc_id FROM p) JOIN labels USING (doc_id)
        WHERE (quality = 0 OR toxic = 1) IS NOT NULL AND page_id IS NOT NULL GROUP BY page_id
    ),
    host0 AS (
        SELECT host, string_split(host, '.') AS l, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(x), 0)::DOUBLE AS x
        FROM p LEFT JOIN outcomes USING (page_id) GROUP BY host
    ),
    host2 AS (SELECT host, n, x, array_to_string(l[-2:], '.') AS domain, array_to_string(l[-1:], '.') AS suffix FROM host0),
    suffix0 AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM host2 GROUP BY suffix),
    suffix1 AS (SELECT *, (SELECT (coalesce(sum(x), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM suffix0) AS m FROM suffix0),
    domain1 AS (
        SELECT domain, d.n, d.x, a / (a + b) AS m
        FROM (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM host2 GROUP BY ALL) d JOIN {shrunk('suffix1', 'm')} s USING (suffix)
    ),
    host3 AS (SELECT host, h.n, h.x, a / (a + b) AS m FROM host2 h JOIN {shrunk('domain1', 'm')} d USING (domain)),
    known AS (SELECT host, a / (a + b) AS mean, a + b AS size FROM {shrunk('host3', 'm')}),
    rules(verdict, rule, host, start) AS (VALUES {table}),
    fits AS (
        SELECT rid, r.rule, r.verdict FROM p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.start)
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(r.rule) DESC, r.rule) = 1
    )
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN
           mean - {hosts.DEVIATIONS} * sqrt(mean * (1 - mean) / (size + 1)) > {hosts.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
    FROM p JOIN known USING (host) LEFT JOIN fits USING (rid)
    """


def _whole_vectors(factor: int) -> str:
    """``embeddings`` numbered, its vectors as integers, without those that have gaps."""
    return f"""
        SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({factor} * x::DOUBLE)) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    """


def hard_negatives() -> str:
    return f"""
    WITH e AS (
        SELECT * REPLACE (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label)
        FROM ({_whole_vectors(negatives.FACTOR)}) WHERE vec_id IS NOT NULL AND label IS NOT NULL
    ),
    pairs AS MATERIALIZED (
        SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS alike,
               CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.rid <> b.rid
    ),
    liked AS (
        SELECT * FROM pairs WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= {negatives.POSITIVES}
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM liked p JOIN pairs n ON p.anchor = n.anchor AND NOT n.alike AND 80 * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY rank <= {negatives.NEGATIVES}
    """


def vector_codes() -> str:
    parts, entries, rounds = quantise.PARTS, quantise.ENTRIES, quantise.ROUNDS

    def assigned(n: int) -> str:
        """The nearest entry of each part, as its distance and index in one number."""
        return f"""near{n} AS MATERIALIZED (
            SELECT rid, part, min(d * {entries} + entry) AS best
            FROM (SELECT rid, part, entry, sum((v - c) * (v - c)) AS d FROM x JOIN book{n} USING (part, pos) GROUP BY ALL) GROUP BY ALL
        )"""

    def moved(n: int) -> str:
        return f"""book{n + 1} AS MATERIALIZED (
            SELECT part, entry, pos, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN (
                SELECT part, best % {entries} AS entry, pos, CAST(floor(sum(v) / count(*)) AS BIGINT) AS c
                FROM x JOIN near{n} USING (rid, part) GROUP BY ALL
            ) m USING (part, entry, pos)
        )"""

    steps = ",\n".join(f"{assigned(n)},\n{moved(n)}" for n in range(rounds))
    return f"""
    WITH e AS MATERIALIZED ({_whole_vectors(quantise.FACTOR)}),
    x AS MATERIALIZED (
        SELECT rid, (i - 1) // (n // {parts}) AS part, (i - 1) % (n // {parts}) AS pos, CAST(q[i] AS BIGINT) AS v
        FROM (SELECT rid, q, len(q) AS n, unnest(range(1, len(q) + 1)) AS i FROM e)
    ),
    first AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e QUALIFY entry < {entries}),
    book0 AS MATERIALIZED (SELECT part, entry, pos, v AS c FROM x JOIN first USING (rid)),
    {steps},
    {assigned(rounds)},
    coded AS (
        SELECT rid, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code,
               CAST(sum(best // {entries}) AS BIGINT) AS error
        FROM near{rounds} GROUP BY rid
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
    FROM coded JOIN e USING (rid)
    """
