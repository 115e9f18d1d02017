"""The registered query of each training-data operator, over its whole table."""

from __future__ import annotations

from .chat import q_chat
from .classifier import q_classifier
from .decontam import q_decontam
from .html_text import q_html
from .katz import q_katz
from .licenses import q_licenses
from .merkle import q_merkle
from .packing import q_packing
from .prefix_trie import q_trie
from .quality import q_quality
from .records import q_records
from .simhash import q_simhash
from .substring import q_substring

QUERIES = {
    "op1_decontam": q_decontam,
    "op2_katz": q_katz,
    "op3_html": q_html,
    "op4_packing": q_packing,
    "op5_quality": q_quality,
    "op6_licenses": q_licenses,
    "op7_chat": q_chat,
    "op8_classifier": q_classifier,
    "op9_substring": q_substring,
    "op10_simhash": q_simhash,
    "op11_trie": q_trie,
    "op12_merkle": q_merkle,
    "op13_records": q_records,
}

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}')"


def _crc32(ids: str) -> str:
    """CTEs ``crcs(id, crc)``: unsigned CRC-32 of the decimal text of the integers ``ids`` (a query with one column ``id``)."""
    return f"""crc_bits(n, c, k) AS (
  SELECT range, CAST(range AS BIGINT), 0 FROM range(256) UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT n, c FROM crc_bits WHERE k = 8),
crc_run(id, s, i, c) AS (
  SELECT DISTINCT id, CAST(id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM ({ids}) WHERE id IS NOT NULL UNION ALL
  SELECT r.id, r.s, r.i + 1, xor(r.c >> 8, t.c) FROM crc_run r JOIN crc_table t ON t.n = xor(r.c, ascii(substr(r.s, r.i + 1, 1))) & 255
  WHERE r.i < length(r.s)),
crcs AS (SELECT id, xor(c, 4294967295) AS crc FROM crc_run WHERE i = length(s))"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: DuckDB SQL of the operators that it can express; the others are checked by brute force in tests/llm
ORACLE_SQL: dict[str, str] = {
    "op1_decontam": f"""
WITH d AS (SELECT doc_id, {_words(_LOWER.format("text"), _ALNUM)} AS w FROM documents),
it AS (SELECT item_id, {_words(_LOWER.format("text"), _ALNUM)} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + 9], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM it WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, lens WHERE len(w) >= m)),
hits AS (SELECT dw.doc_id, dw.i, dw.m, iw.item_id FROM dw JOIN iw ON iw.win = dw.win AND iw.m = dw.m),
hw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hw.n, 0) AS n_hit, coalesce(hi.n, 0) AS n_items,
       sha256(coalesce(hi.ids, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id""",
    "op9_substring": f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')", _SPACED)} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
early AS (SELECT s, min(doc_id) AS doc FROM win GROUP BY s),
gone AS (SELECT DISTINCT win.doc_id, unnest(generate_series(i, i + 12)) AS p
         FROM win JOIN early ON early.s = win.s WHERE early.doc < win.doc_id),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS text, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d) x
         LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.p = x.p WHERE g.p IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    "op12_merkle": f"""
WITH RECURSIVE {_crc32("SELECT doc_id AS id FROM documents")},
leaves AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf("n_chars")} AS leaf,
                  CASE WHEN crc % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed
           FROM documents LEFT JOIN crcs ON crcs.id = doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes(lang, l, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM placed UNION ALL
  SELECT lang, l + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, l, pos // 2, n),
subs AS (SELECT lang, l AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
         FROM nodes WHERE n = 1),
tops(l, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM subs UNION ALL
  SELECT l + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY l, pos // 2, n),
whole AS (SELECT l AS height, h AS root FROM tops WHERE n = 1),
steps AS (
  SELECT p.r, k.l AS step, (p.pos >> k.l) & 1 AS side, s.h
  FROM placed p JOIN (SELECT DISTINCT lang, l FROM nodes WHERE n > 1) k ON k.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.l = k.l AND s.pos = xor(p.pos >> k.l, 1)
  UNION ALL
  SELECT p.r, u.height + k.l, (u.pos >> k.l) & 1, s.h
  FROM placed p JOIN subs u ON u.lang IS NOT DISTINCT FROM p.lang JOIN (SELECT DISTINCT l FROM tops WHERE n > 1) k ON true
  LEFT JOIN tops s ON s.l = k.l AND s.pos = xor(u.pos >> k.l, 1)),
proofs AS (SELECT r, string_agg(h, '' ORDER BY step) AS proof FROM steps GROUP BY r),
folds(r, step, h) AS (
  SELECT r, 0, claimed FROM leaves UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN s.side = 1 THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END)
  FROM folds f JOIN steps s ON s.r = f.r AND s.step = f.step),
folded AS (SELECT r, arg_max(h, step) AS h FROM folds GROUP BY r)
SELECT p.doc_id, p.leaf, u.subroot, w.root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.h AS folded_root, f.h = w.root AS verified
FROM placed p JOIN subs u ON u.lang IS NOT DISTINCT FROM p.lang JOIN whole w ON true JOIN folded f ON f.r = p.r
LEFT JOIN proofs q ON q.r = p.r""",
    "op11_trie": f"""
WITH RECURSIVE {_crc32("SELECT conv_id AS id FROM conversations")},
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT conv_id, turn, substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS code, len({_words("text", _SPACED)}) AS words FROM t),
own AS (SELECT conv_id, code, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) - 1 AS p FROM u),
c AS (SELECT id, id - id % 20 AS base, crc % 4 AS h FROM crcs),
made AS (SELECT c.id, 0 AS part, o.p, o.code, o.words FROM c JOIN own o ON o.conv_id = c.base AND o.p < c.h UNION ALL
         SELECT c.id, 1, o.p, o.code, o.words FROM c JOIN own o ON o.conv_id = c.id AND o.p >= c.h),
pre AS (SELECT id, words, row_number() OVER w AS depth, string_agg(code, '') OVER w AS path FROM made WINDOW w AS (PARTITION BY id ORDER BY part, p)
        UNION ALL SELECT id, 0, 0, '' FROM c),
nodes AS (SELECT path, any_value(depth) AS depth, any_value(words) AS words, min(id) AS conv_id, count(*) AS n_convs FROM pre GROUP BY path),
kids AS (SELECT substr(path, 1, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
each AS (SELECT n.path, n.depth, n.conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, (n.n_convs - 1) * n.words AS saved
         FROM nodes n LEFT JOIN kids k ON k.path = n.path),
sums AS (SELECT substr(path, 1, 32 * d) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
         FROM (SELECT *, unnest(generate_series(0, depth)) AS d FROM each) GROUP BY 1),
ends AS (SELECT path, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
         FROM (SELECT id, arg_max(path, depth) AS path FROM pre GROUP BY id) GROUP BY path)
SELECT e.conv_id, CAST(e.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, e.n_convs, e.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(x.ids, '')) AS ends_sha256
FROM each e JOIN sums s ON s.path = e.path LEFT JOIN ends x ON x.path = e.path
LEFT JOIN each up ON e.depth > 0 AND up.path = substr(e.path, 1, length(e.path) - 32)""",
}
