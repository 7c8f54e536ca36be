"""SQL twins of the text operators, where SQL can express them."""

from __future__ import annotations

from sitescore.llm.repetition import BASE_WINDOW, Limits

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, {LOWERED} AS t FROM documents),
g AS (SELECT *, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place
      FROM d WINDOW w AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_rules() -> str:
    """Counts of n-grams and lines, and the limits of the operator on them."""
    limits = Limits()
    sizes = sorted({*limits.top, *limits.again, BASE_WINDOW})
    ctes = [
        f"d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents)",
        "base AS (SELECT doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, "
        "CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM d)",
        "line AS (SELECT doc_id, x, count(*) AS k FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) "
        r"WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id, x)",
        "lines AS (SELECT doc_id, CAST(sum(k) AS BIGINT) AS n_lines, CAST(sum(k - 1) AS BIGINT) AS n_dup_lines, CAST(sum(k * length(x)) AS BIGINT) AS line_chars, "
        "CAST(sum((k - 1) * length(x)) AS BIGINT) AS dup_line_chars FROM line GROUP BY doc_id)",
    ]
    counts = []
    for n in sizes:
        ctes.append(f"""gram{n} AS (
SELECT doc_id, i, g, count(*) OVER (PARTITION BY doc_id, g) AS k, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS nth
FROM (SELECT doc_id, i, list_slice(w, i, i + {n - 1}) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d)))""")
        held = f"SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS j FROM gram{n} WHERE k > 1"
        if n == BASE_WINDOW:
            counts.append("n_repeat_words")
            ctes.append(f"c_n_repeat_words AS (SELECT doc_id, count(*) AS v FROM ({held}) GROUP BY doc_id)")
        if n in limits.again:
            counts.append(f"again_{n}")
            ctes.append(f"c_again_{n} AS (SELECT doc_id, CAST(sum(length(w[j])) AS BIGINT) AS v FROM ({held} AND nth > 1) JOIN d USING (doc_id) GROUP BY doc_id)")
        if n in limits.top:
            counts.append(f"top_{n}")
            ctes.append(f"c_top_{n} AS (SELECT doc_id, max(k * length(array_to_string(g, ''))) AS v FROM gram{n} WHERE k > 1 GROUP BY doc_id)")
    values = ", ".join(f"coalesce(c_{c}.v, 0) AS {c}" for c in counts)
    joins = " ".join(f"LEFT JOIN c_{c} ON c_{c}.doc_id = base.doc_id" for c in counts)
    of_lines = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("n_lines", "n_dup_lines", "line_chars", "dup_line_chars"))
    ctes.append(f"found AS (SELECT base.*, {of_lines}, {values} FROM base LEFT JOIN lines ON lines.doc_id = base.doc_id {joins})")
    ctes.append(f"judged AS (SELECT *, n_words < {limits.words} OR 100 * n_repeat_words > {limits.base} * n_words AS base_failed FROM found)")
    over = [f"100 * n_dup_lines > {limits.lines} * n_lines", f"100 * dup_line_chars > {limits.line_chars} * line_chars"]
    over += [f"100 * top_{n} > {m} * word_chars" for n, m in limits.top.items()] + [f"100 * again_{n} > {m} * word_chars" for n, m in limits.again.items()]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT *, NOT (base_failed OR {' OR '.join(over)}) AS kept FROM judged"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: eight shifts for each byte."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(h, b), CAST(range(8) AS BIGINT[])), lambda c, i: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda h, b: {byte}), 4294967295)"


def _climb(name: str, levels: int) -> list[str]:
    """Nodes of each level of ``name``0 (tree, place, digest): runs of 16 until a tree has one node left."""
    ctes = []
    for k in range(1, levels + 1):
        ctes.append(f"""{name}{k} AS (
SELECT tree, place // 16 AS place, CASE WHEN any_value(n) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k - 1}) GROUP BY tree, place // 16)""")
    return ctes


def _siblings(name: str, levels: int) -> list[str]:
    """The digests before and after each node in its run, at each level."""
    return [
        f"""{name}_s{k} AS (
SELECT tree, place, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
       coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a, count(*) OVER (PARTITION BY tree) AS n
FROM {name}{k} WINDOW w AS (PARTITION BY tree, place // 16 ORDER BY place))"""
        for k in range(levels)
    ]


def _merkle_manifest(levels: int = 6, top_levels: int = 3) -> str:
    """A tree of up to 16 ** levels leaves for each of up to 16 ** top_levels sources."""
    field = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    own = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"""l AS (
SELECT doc_id, source AS tree, sha256({own} || {field('text')}) AS digest,
       sha256({own} || CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {field(lower)} ELSE {field('text')} END) AS changed
FROM documents)""",
        "leaf AS (SELECT doc_id, coalesce('1' || tree, '0') AS tree, digest, changed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM l)",
        "u0 AS (SELECT tree, place, digest FROM leaf)",
        *_climb("u", levels),
        *_siblings("u", levels),
        f"r0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, digest, tree AS source FROM u{levels})",
        *_climb("r", top_levels),
        *_siblings("r", top_levels),
    ]
    ways = [(f"s{k}", f"u_s{k}", f"s{k}.tree = leaf.tree AND s{k}.place = leaf.place // {16**k}") for k in range(levels)]
    ways += [(f"t{k}", f"r_s{k}", f"t{k}.place = r0.place // {16**k}") for k in range(top_levels)]
    joins = " ".join(f"JOIN {cte} {alias} ON {on}" for alias, cte, on in ways)
    proof = " || ".join(f"CASE WHEN {a}.n > 1 THEN {a}.b || {a}.a ELSE '' END" for a, *_ in ways)
    ctes.append(f"w0 AS (SELECT leaf.doc_id, leaf.digest AS leaf, r0.digest AS subroot, r{top_levels}.digest AS root, sha256({proof}) AS proof_sha256, leaf.changed AS held, "
                + ", ".join(f"{a}.b AS {a}_b, {a}.a AS {a}_a, {a}.n AS {a}_n" for a, *_ in ways)
                + f" FROM leaf JOIN r0 ON r0.source = leaf.tree {joins} CROSS JOIN r{top_levels})")
    for k, (a, *_) in enumerate(ways):
        ctes.append(f"w{k + 1} AS (SELECT * REPLACE (CASE WHEN {a}_n > 1 THEN sha256({a}_b || held || {a}_a) ELSE held END AS held) FROM w{k})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, held AS folded_root, held = root AS verified FROM w{len(ways)}"


ORACLES = {"op8_exact_dedup": EXACT_DEDUP, "op11_quality_rules": _quality_rules(), "op12_merkle_manifest": _merkle_manifest()}
