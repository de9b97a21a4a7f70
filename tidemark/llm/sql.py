"""SQL of operators whose statements are long enough to be put together from parts. DuckDB's words."""

from __future__ import annotations

from .secret_scan import BARE, BASE, OWNERS

#: Unsigned CRC-32 of the decimal doc_id, byte by byte and bit by bit.
_CRC = """
xor(list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda acc, c: list_reduce(
    list_concat([xor(acc, c)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
), 4294967295::BIGINT)
"""


def _leaf(text: str) -> str:
    def part(c: str) -> str:
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, k: int, arity: int) -> str:
    """Level k + 1 of the trees over nodes name{k}(grp, pos, h, cnt); run: the nodes below."""
    return f"""{name}{k + 1} AS (
  SELECT grp, pos // {arity} AS pos, CASE WHEN cnt > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h,
         CASE WHEN cnt > 1 THEN (cnt + {arity - 1}) // {arity} ELSE cnt END AS cnt, list(h ORDER BY pos) AS run, cnt AS below
  FROM (SELECT grp, pos, h, cnt FROM {name}{k}) GROUP BY grp, pos // {arity}, cnt)"""


def _steps(name: str, before: str, grp: str, pos: str, k: int, arity: int, out: str) -> str:
    """One level up for each leaf: its proof grows by the run's others, its digest is folded among them."""
    at = f"({pos} // {arity ** k}) % {arity}"
    left = f"array_to_string(t.run[1:{at}], '')"
    right = f"array_to_string(t.run[{at} + 2:], '')"
    return f"""{out} AS (
  SELECT f.* EXCLUDE (proof, folded),
         CASE WHEN t.below > 1 THEN f.proof || {left} || {right} ELSE f.proof END AS proof,
         CASE WHEN t.below > 1 THEN sha256({left} || f.folded || {right}) ELSE f.folded END AS folded
  FROM {before} f JOIN {name}{k + 1} t ON t.grp = {grp} AND t.pos = {pos} // {arity ** (k + 1)})"""


def merkle(levels: int = 6, above: int = 4, arity: int = 16) -> str:
    """levels and above bound the trees of a source and over sources: 16 ** 6 rows a source, 16 ** 4 sources."""
    parts = [f"""made AS (
  SELECT doc_id, coalesce('+' || source, '') AS grp, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf("low")} END AS changed
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS cnt FROM made
), low0 AS (SELECT grp, pos, leaf AS h, cnt FROM leaves)"""]
    parts += [_levels("low", k, arity) for k in range(levels)]
    parts.append(f"""subroots AS (SELECT grp AS name, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place FROM low{levels}),
top0 AS (SELECT '' AS grp, place AS pos, subroot AS h, count(*) OVER () AS cnt FROM subroots)""")
    parts += [_levels("top", k, arity) for k in range(above)]
    parts.append(f"""s0 AS (
  SELECT l.doc_id, l.grp, l.pos, l.leaf, s.subroot, s.place, t.h AS root, '' AS proof, coalesce(l.changed, l.leaf) AS folded
  FROM leaves l JOIN subroots s ON s.name = l.grp, top{above} t)""")
    for k in range(levels):
        parts.append(_steps("low", f"s{k}", "f.grp", "f.pos", k, arity, f"s{k + 1}"))
    for k in range(above):
        parts.append(_steps("top", f"s{levels + k}", "''", "f.place", k, arity, f"s{levels + k + 1}"))
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM s{levels + above}"""


def secrets(owners: int = OWNERS) -> str:
    kinds = (*BASE, BARE)
    random = """regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]') AND len(regexp_extract_all(val, '[0-9]')) >= 3
      AND regexp_matches(val, '[0-9][^0-9]+[0-9]')
      AND len(regexp_extract_all(val, '[a-z][A-Z0-9]|[A-Z][a-z0-9]|[0-9][A-Za-z]')) * 4 >= length(val)"""
    found = []
    for i, k in enumerate(kinds):
        p = k.pattern.replace("'", "''")
        ok = random if k is BARE else f"length(val) >= {k.least}"
        found.append(f"""SELECT rid, owner, {i} AS kind, '{k.name}' AS name, val, before, size, n, {ok} AS ok FROM (
      SELECT rid, owner, n, length(pieces[n]) AS before, length(wholes[n]) AS size, vals[n] AS val FROM (
        SELECT rid, owner, string_split_regex(body, '{p}') AS pieces, regexp_extract_all(body, '{p}', 0) AS wholes, regexp_extract_all(body, '{p}', {k.group}) AS vals
        FROM docs) AS x, unnest(range(1, len(wholes) + 1)) AS u(n))""")
    union = "\n    UNION ALL ".join(found)
    bare = len(BASE)
    return f"""WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('+' || source, '') AS owner, coalesce(text, '') AS body FROM documents
), matches AS (
    {union}
), hits AS (
  SELECT * FROM (SELECT *, CAST(sum(before + size) OVER (PARTITION BY rid, kind ORDER BY n) AS BIGINT) AS stop FROM matches) WHERE ok
), placed AS (SELECT *, stop - size AS start FROM hits
), held AS (SELECT val, count(DISTINCT owner) AS owners FROM hits GROUP BY val
), told AS (
  SELECT h.* FROM placed h JOIN held o USING (val)
  WHERE h.kind < {bare} OR (o.owners <= {owners} AND NOT EXISTS (
    SELECT 1 FROM placed b WHERE b.rid = h.rid AND b.kind < {bare} AND b.start < h.stop AND b.stop > h.start))
), each AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < {bare}) AS base,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
  FROM told GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN each USING (rid)"""
