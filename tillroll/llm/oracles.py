"""DuckDB counterparts of the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .line_cleaning import BOILERPLATE
from .url_filter import PATTERNS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    split = f"regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+')"
    return f"list_filter({split}, lambda w: w <> '')"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _shingled(table: str, key: str, n: int) -> str:
    """Distinct (key, shingle) of a table; fewer words than n are one shingle."""
    return f"""
        SELECT DISTINCT {key}, unnest(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {n} + 2),
                                lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END) AS shingle
        FROM (SELECT {key}, {_words(_lowered("text"))} AS w FROM {table})
    """


def op10() -> str:
    return f"""
        WITH d AS ({_shingled("documents", "doc_id", 5)}),
        i AS ({_shingled("benchmark", "item_id", 5)}),
        sizes AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id)
        SELECT doc_id, item_id, item_shingles, count(*) AS shared,
               count(*) / item_shingles AS containment
        FROM d JOIN i USING (shingle) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id, item_shingles
        HAVING 100 * count(*) >= 80 * item_shingles
    """


def op6() -> str:
    return """
        WITH t AS (
            SELECT conv_id, turn, min(struct_pack(role := coalesce(role, 'user'),
                                                  text := coalesce(text, ''))) AS said
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
            GROUP BY conv_id, turn),
        answers AS (
            SELECT conv_id, max(turn) AS last, arg_max(said.text, turn) AS answer
            FROM t WHERE said.role = 'assistant' GROUP BY conv_id),
        swaps AS (
            SELECT conv_id, last, coalesce(lead(answer) OVER (ORDER BY conv_id),
                                           first_value(answer) OVER (ORDER BY conv_id)) AS other
            FROM answers QUALIFY count(*) OVER () > 1),
        sides AS (
            SELECT conv_id AS pair_id, turn, said.role AS role, said.text AS chosen,
                   CASE WHEN turn = last THEN other ELSE said.text END AS rejected
            FROM t JOIN swaps USING (conv_id) WHERE turn <= last),
        forks AS (
            SELECT pair_id, min(turn) FILTER (chosen <> rejected) AS fork FROM sides GROUP BY pair_id),
        placed AS (
            SELECT *, fork IS NULL OR turn < fork AS prompt FROM sides JOIN forks USING (pair_id)),
        parts AS (
            SELECT pair_id, turn, role, 'prompt' AS section, chosen AS text FROM placed WHERE prompt
            UNION ALL
            SELECT pair_id, turn, role, 'chosen', chosen FROM placed WHERE NOT prompt
            UNION ALL
            SELECT pair_id, turn, role, 'rejected', rejected FROM placed WHERE NOT prompt),
        lengths AS (
            SELECT pair_id, count(*) FILTER (prompt) AS prompt_turns FROM placed GROUP BY pair_id)
        SELECT pair_id, section, turn,
               '<|turn|>' || role || chr(10) || text || '<|end|>' || chr(10) AS rendered,
               prompt_turns, section <> 'prompt' AND role = 'assistant' AS train
        FROM parts JOIN lengths USING (pair_id)
    """


def op7() -> str:
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    phrases = " OR ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
    count = lambda text, chars: f"(length({text}) - length(translate({text}, '{chars}', '')))"
    ended = "regexp_matches(l, '[.!?…]')"
    fails = f"""
        ({count("l", "|")} >= 3 AND {count("l", "|")} * 100 >= length(l) * 4)
        OR {count("l", "#*$%&<>")} * 100 > length(l) * 8
        OR ({count("l", "!")} >= 4 AND {count("l", "!")} * 100 > length(l) * 8)
        OR (length(l) >= 400 AND NOT {ended})
        OR (length(l) <= 200 AND ({phrases}))
    """
    chars = lambda text: f"length(translate({text}, {space}, ''))"
    return f"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT r, doc_id, text, {_words("text")} AS w,
                     list_filter(string_split(text, chr(10)), lambda l: {chars("l")} > 0) AS live
              FROM t),
        l AS (SELECT *, list_filter(live, lambda l: NOT ({fails})) AS rest FROM w),
        places AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
        windows AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM places),
        twice AS (SELECT r, i FROM (
            SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
        spans AS (SELECT r, least(5, coalesce(
            lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS n FROM twice),
        again AS (SELECT r, sum(n)::BIGINT AS n FROM spans GROUP BY r),
        counts AS (
            SELECT doc_id, len(w) AS n_words, {chars("text")} AS word_chars,
                   {count("text", "#*$%&|<>")} AS n_symbols,
                   len(live) - len(list_distinct(live)) AS n_dup_lines,
                   coalesce(again.n, 0) AS n_repeat_words, len(live) AS n_lines,
                   len(live) - len(rest) AS n_failed_lines,
                   coalesce({chars("array_to_string(rest, '')")}, 0) AS kept_chars
            FROM l LEFT JOIN again USING (r)),
        judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
                   FROM counts)
        SELECT *, NOT base_failed AND NOT (word_chars - kept_chars) * 100 > word_chars * 50 AS kept
        FROM judged
    """


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text, bit by bit."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i::INTEGER + 1, 2))::UBIGINT"
    bits = "[0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]"
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END"
    return f"""xor(4294967295::UBIGINT, list_reduce(
        list_concat([4294967295::UBIGINT],
                    list_transform(range(0, octet_length(encode({text}))), lambda i: {byte})),
        lambda c, b: list_reduce(list_concat([xor(c, b)], {bits}), lambda x, y: {step})))"""


def op11() -> str:
    return f"""
        WITH t AS (
            SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes, turn,
                   coalesce(role, '') AS role,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '')
                          || coalesce(text, '')) AS said
            FROM conversations WHERE conv_id IS NOT NULL),
        p AS (SELECT *, row_number() OVER (PARTITION BY conv_id
                                           ORDER BY turn NULLS FIRST, role, said) AS pos FROM t),
        c AS (SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base,
                     {_crc32("conv_id::VARCHAR")} % 9 AS h
              FROM (SELECT DISTINCT conv_id FROM t)),
        parts AS (
            SELECT c.conv_id, 0 AS side, pos, said, bytes FROM c JOIN p ON p.conv_id = base
            WHERE pos <= h
            UNION ALL
            SELECT conv_id, 1, pos, said, bytes FROM c JOIN p USING (conv_id) WHERE pos > h),
        whole AS (SELECT conv_id, list(said ORDER BY side, pos) AS said,
                         list(bytes ORDER BY side, pos) AS bytes FROM parts GROUP BY conv_id),
        convs AS (SELECT conv_id, coalesce(said, []) AS said, coalesce(bytes, []) AS bytes
                  FROM c LEFT JOIN whole USING (conv_id)),
        steps AS (SELECT conv_id, d, array_to_string(said[1:d], ',') AS path, d = len(said) AS ended,
                         CASE WHEN d > 0 THEN array_to_string(said[1:d - 1], ',') END AS above,
                         CASE WHEN d > 0 THEN bytes[d] ELSE 0 END AS bytes
                  FROM (SELECT *, unnest(range(0, len(said) + 1)) AS d FROM convs)),
        nodes AS (SELECT path, d, min(conv_id) AS conv_id, min(above) AS above, min(bytes) AS bytes,
                         count(*) AS n_convs,
                         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                                         FILTER (ended), '')) AS ends
                  FROM steps GROUP BY path, d),
        kids AS (SELECT above AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0
                 GROUP BY above, d),
        valued AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
                          (n_convs - 1) * bytes AS saved,
                          CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf
                   FROM nodes LEFT JOIN kids USING (path, d)),
        lines AS (SELECT v.saved, v.leaf, s.path, s.d
                  FROM valued v JOIN steps s ON s.conv_id = v.conv_id AND s.d <= v.d),
        sums AS (SELECT path, d, sum(saved)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves
                 FROM lines GROUP BY path, d)
        SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children,
               sums.leaves AS n_leaves, sums.saved AS saved_tokens, v.ends AS ends_sha256
        FROM valued v JOIN sums USING (path, d)
             LEFT JOIN nodes up ON up.path = v.above AND up.d = v.d - 1
    """


def op12() -> str:
    found = f"regexp_extract_all({_lowered('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    noise = "('0x' || substr(sha256('2024:' || doc_id), 1, 8))::UBIGINT"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {found} AS w FROM documents),
        f AS (SELECT r, unnest(w) AS w FROM d),
        b AS (SELECT unnest({found}) AS w FROM benchmark),
        hashed AS (SELECT w, {_crc32("w")} % 10000 AS bucket
                   FROM (SELECT w FROM f UNION SELECT w FROM b)),
        source AS (SELECT bucket, count(*) AS n FROM f JOIN hashed USING (w) GROUP BY bucket),
        target AS (SELECT bucket, count(*) AS n FROM b JOIN hashed USING (w) GROUP BY bucket),
        sums AS (SELECT coalesce((SELECT sum(n) FROM source), 0)::DOUBLE AS s,
                        coalesce((SELECT sum(n) FROM target), 0)::DOUBLE AS t),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * (s + 10000)
                   / ((source.n + 1)::DOUBLE * (t + 10000))))::BIGINT AS gain
            FROM source LEFT JOIN target USING (bucket), sums),
        weights AS (SELECT r, sum(gain)::BIGINT AS weight
                    FROM f JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY r),
        scored AS (
            SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(({noise} + 0.5::DOUBLE)
                                                / 4294967296)))::BIGINT AS score
            FROM d LEFT JOIN weights USING (r)),
        pool AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id, n_features, r) AS rank,
                        count(*) OVER () AS n
                 FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL)
        SELECT doc_id, scored.n_features, scored.weight, scored.score,
               CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
        FROM scored LEFT JOIN (SELECT r, rank, n FROM pool) USING (r)
    """


def op13() -> str:
    """Every rule is tried on every URL."""
    sites = [("net", "/", "block"), ("example.net", "/en/", "allow")]
    sites += [("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    site_rows = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in sites)
    pattern_rows = ", ".join(f"('{r.action}', '{r.text}', '{r.regex()}')" for r in PATTERNS)
    low = lambda text: f"translate({text}, '{_UPPER}', '{_LOWER}')"
    return f"""
        WITH u AS (
            SELECT row_number() OVER () AS r, page_id,
                   CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
                        ELSE '' END AS rest
            FROM pages),
        h AS (SELECT r, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
        p AS (
            SELECT r, page_id, {low("raw")} AS host, {low("rest")} AS low,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM h),
        sites(rule_host, rule_path, action) AS (VALUES {site_rows}),
        fit AS (
            SELECT r, max(struct_pack(n := length(rule_host || rule_path),
                                      allow := action = 'allow',
                                      text := rule_host || rule_path)) AS best
            FROM p JOIN sites ON (host = rule_host OR ends_with(host, '.' || rule_host))
                             AND starts_with(path, rule_path)
            GROUP BY r),
        patterns(action, text, regex) AS (VALUES {pattern_rows}),
        alike AS (
            SELECT r, max(struct_pack(n := length(text), allow := action = 'allow',
                                      text := text)) AS best
            FROM p JOIN patterns ON regexp_matches(low, regex)
            GROUP BY r)
        SELECT page_id, host, path, fit.best.text AS rule,
               CASE WHEN fit.best IS NULL THEN alike.best.text END AS pattern,
               CASE WHEN coalesce(fit.best.allow, alike.best.allow, true)
                    THEN 'allow' ELSE 'block' END AS verdict
        FROM p LEFT JOIN fit USING (r) LEFT JOIN alike USING (r)
    """


def llm_oracles() -> dict[str, str]:
    return {
        "op6_preferences": op6(),
        "op7_line_cleaning": op7(),
        "op10_decontamination": op10(),
        "op11_prefix_trie": op11(),
        "op12_importance": op12(),
        "op13_url_filters": op13(),
    }
