"""DuckDB statements equal to registered queries, where SQL can express them."""

from __future__ import annotations

from .secret_scan import BASE_RULES, RULES, Rule


def _portable(rule: Rule) -> str:
    """The rule's pattern with letters in either case spelt out: the ``(?i)`` of other engines folds beyond ASCII."""
    if not rule.pattern.startswith("(?i:"):
        return rule.pattern
    end = rule.pattern.rindex(")(")
    out, in_class, escaped = "", False, False
    for c in rule.pattern[4:end]:
        in_class = (in_class or c == "[") and c != "]"
        out += f"[{c.upper()}{c}]" if c.isalpha() and not in_class and not escaped else c
        escaped = c == "\\"
    return out + rule.pattern[end + 1 :]


def secret_scan_sql() -> str:
    """Offsets follow from cutting the text at the matches, as in the query."""
    found = []
    for k, r in enumerate(RULES):
        p = _portable(r).replace("'", "''")
        found.append(
            f"SELECT doc_id, {k} AS rank, '{r.kind}' AS kind, {r.least} AS least, regexp_split_to_array(t, '{p}') AS p, regexp_extract_all(t, '{p}') AS w, regexp_extract_all(t, '{p}', {r.group}) AS v FROM d WHERE regexp_matches(t, '{p}')"
        )
    base = f"rank < {len(BASE_RULES)}"
    counts = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)
    sums = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    span = "kind || ':' || s || ':' || (s + n)"
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), "
        f"m AS ({' UNION ALL '.join(found)}), "
        "e AS (SELECT m.*, unnest(range(1, len(w) + 1)) AS i FROM m), "
        "f AS (SELECT doc_id, rank, kind, list_sum([length(x) for x in p[1:i]]) + coalesce(list_sum([length(x) for x in w[1:i - 1]]), 0) AS s, length(w[i]) AS n FROM e WHERE length(v[i]) >= least), "
        f"g AS (SELECT doc_id, {sums}, string_agg({span}, ',' ORDER BY s, rank) FILTER (WHERE {base}) AS b, string_agg({span}, ',' ORDER BY s, rank) AS a FROM f GROUP BY doc_id) "
        f"SELECT d.doc_id, {counts}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans FROM d LEFT JOIN g USING (doc_id)"
    )


ORACLE_SQL = {"op7_secret_scan": secret_scan_sql()}
