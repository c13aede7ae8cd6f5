"""SQL twins, for DuckDB on the same tables, of the operators that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def _components(nodes: str, links: str) -> str:
    """Tables reach(id, other) and part(id, low) of an undirected table of links (a, b)."""
    return f"""
edges AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
reach AS (
  SELECT id, id AS other FROM {nodes}
  UNION
  SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.other
),
part AS (SELECT id, min(other) AS low FROM reach GROUP BY id)"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _levels(name: str, key: str, levels: int) -> str:
    """Tables {name}0, {name}1, ... of a tree's nodes by `key`, each with what stands left and right of it in its run.

    A key of one node keeps it; four levels hold 65,536 nodes.
    """
    out = []
    for k in range(levels + 1):
        if k:
            out.append(f"""
{name}{k}_n AS (
  SELECT {key}, i // 16 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE max(d) END AS d
  FROM {name}{k - 1} GROUP BY {key}, i // 16
)""")
        out.append(f"""
{name}{k} AS (
  SELECT *, count(*) OVER (PARTITION BY {key}) AS n,
         coalesce(string_agg(d, '') OVER (PARTITION BY {key}, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(d, '') OVER (PARTITION BY {key}, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}_n
)""")
    return ",".join(out)


def _folds(name: str, key: str, levels: int, start: str) -> str:
    """Tables {name}_f1, ...: digest x and proof p of every document after each level, from table `start` (place i, x, p)."""
    out = []
    for k in range(levels):
        below = f"{name}_f{k}" if k else start
        out.append(f"""
{name}_f{k + 1} AS (
  SELECT f.* REPLACE (CASE WHEN t.n > 1 THEN sha256(t.l || f.x || t.r) ELSE f.x END AS x, f.p || t.l || t.r AS p, f.i // 16 AS i)
  FROM {below} f JOIN {name}{k} t ON t.{key} = f.{key} AND t.i = f.i
)""")
    return ",".join(out)


# crc32 of a text of ASCII characters: bytes are xored in, -1 stands for a shift by one bit
CRC = """list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(t) + 1),
  lambda i: [CAST(ascii(t[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"""
DIGEST_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


ORACLE: dict[str, str] = {
    "op3_minhash": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)
), nodes AS (SELECT doc_id AS id FROM documents), {_components("nodes", "links")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, low AS component_id, doc_id = low AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN part ON part.id = doc_id""",
    "op7_chat": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1
                + length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g'))) AS BIGINT) AS formatted_chars,
       regexp_full_match(string_agg(role || ',', '' ORDER BY turn, role, text),
                         '(system,)?user,assistant,((user|tool(,tool)*),assistant,)*') AS valid
FROM turns GROUP BY conv_id""",
    "op8_winnowing": f"""
WITH items AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))
), found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, win)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op9_vectors": f"""
WITH RECURSIVE units AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y ON x.vec_id < y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.95
), nodes AS (SELECT vec_id AS id FROM embeddings), {_components("nodes", "links")},
degree AS (SELECT a AS id, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, low AS component_id, vec_id = low AS kept
FROM embeddings JOIN part ON part.id = vec_id LEFT JOIN degree ON degree.id = vec_id""",
    "op13_merkle": f"""
WITH hashed AS (
  SELECT doc_id, coalesce('s' || source, '-') AS k, sha256({DIGEST_FIELDS} || {_field("text")}) AS d,
         CASE WHEN xor({CRC.replace("len(t)", "len(CAST(doc_id AS VARCHAR))").replace("t[i]", "CAST(doc_id AS VARCHAR)[i]")}, 4294967295) % 5 = 0
              THEN sha256({DIGEST_FIELDS} || {_field(TAMPERED)}) END AS tampered
  FROM documents
), leaves0_n AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM hashed
), {_levels("leaves", "k", 4)},
sources0_n AS (SELECT 1 AS one, k, d, row_number() OVER (ORDER BY k) - 1 AS i FROM leaves4),
{_levels("sources", "one", 2)},
start AS (SELECT doc_id, k, d AS leaf, i, coalesce(tampered, d) AS x, '' AS p FROM leaves0),
{_folds("leaves", "k", 4, "start")},
middle AS (
  SELECT f.doc_id, f.leaf, s.d AS subroot, f.x, f.p, s.i, 1 AS one FROM leaves_f4 f JOIN sources0 s ON s.k = f.k
),
{_folds("sources", "one", 2, "middle")}
SELECT doc_id, leaf, subroot, (SELECT d FROM sources2) AS root, sha256(p) AS proof_sha256, x AS folded_root,
       x = (SELECT d FROM sources2) AS verified
FROM sources_f2""",
}
