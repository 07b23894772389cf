"""SQL equivalents of the queries on training text, where SQL can express them.

Scores of a learned model, merges of a vocabulary and fingerprints by a hash that SQL lacks have
none; the tests hold those against plain versions, round trips and held-out accuracy.
"""

from __future__ import annotations

from tallybook.llm.sharding import ROUNDS, round_keys

SHARD_SEED = 20_261_204

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = (r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_CONTROLS = ("<s>", "[INST]", "[SAY]", "[/INST]", "</s>")
_KINDS = " || ".join(f"CASE WHEN contains(r, '{c}') OR contains(x, '{c}') THEN '{k}' ELSE '' END"
                     for k, c in enumerate(_CONTROLS))


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\_')"
    for k, c in enumerate(_CONTROLS):
        out = f"replace({out}, '{c}', '\\{k}')"
    return f"CASE WHEN kinds = '' THEN {column} ELSE {out} END"


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                  (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
kinded AS (SELECT *, {_KINDS} AS kinds FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x))
    AS turns_sha256,
  CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN r = 'assistant' THEN x ELSE '' END, ''
                    ORDER BY turn NULLS FIRST, r, x)) AS loss_sha256,
  CAST(sum(4 + length(kinds) + length({_escaped('r')}) + length({_escaped('x')})
           + CASE WHEN r = 'assistant' THEN 9 ELSE 13 END) AS BIGINT) AS formatted_chars,
  CAST(sum(CASE WHEN kinds = '' THEN 0 ELSE 1 END) AS BIGINT) AS n_escaped
FROM kinded GROUP BY conv_id
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {1 + 10 * part}, 10)"
    f" AS BIGINT) >> {shift}) & 31 AS BIGINT) + 1, 1)"
    for part in range(4) for shift in range(35, -1, -5))

WARC = f"""
WITH records AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
hashed AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS h,
                  max(page_id) OVER (PARTITION BY body) AS last FROM records)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last = page_id THEN NULL ELSE last END AS refers_to
FROM hashed
"""

REPEATS = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
keyed AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 49 <= len(w)
            THEN sha256(array_to_string(w[i:i + 49], ' ')) END AS k FROM places),
earlier AS (SELECT *, CASE WHEN k IS NOT NULL AND min(doc_id) OVER (PARTITION BY k) < doc_id
              THEN 1 ELSE 0 END AS again FROM keyed),
covered AS (SELECT *, max(again) OVER (PARTITION BY doc_id ORDER BY i
              ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM earlier),
kept AS (SELECT doc_id, count(*) AS n, sum(gone) AS g,
           string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS rest
         FROM covered GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words,
  CAST(coalesce(g, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)
"""

CONTAMINATION = f"""
WITH items AS (SELECT item_id, {_NORMAL.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items
        WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_NORMAL.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
sizes AS (SELECT DISTINCT n FROM windows),
found AS (SELECT doc_id, i, p.n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM places, sizes
        WHERE i + n - 1 <= len(w)) p JOIN windows USING (n, k)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM found))
  GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found
        WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs
        WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.doc_id, CAST(coalesce(max(s.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id,
  CAST(coalesce(max(l.n), 0) AS BIGINT) AS n_links
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = r.doc_id GROUP BY r.doc_id
"""



def _crc32(column: str) -> str:
    """The checksum of a text's bytes, one byte after another, by a table of 256 remainders."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    numbers = (f"list_transform(regexp_extract_all(hex(encode({column})), '..'), "
               "lambda x: CAST('0x' || x AS UINTEGER))")
    return (f"CAST(xor(list_reduce({numbers}, lambda c, b: xor(c >> 8, "
            f"({table}::UINTEGER[])[(xor(c, b) & 255) + 1]), 4294967295::UINTEGER), "
            "4294967295::UINTEGER) AS BIGINT)")


def _mixed(half: str, key: str) -> str:
    low = "4294967295::UBIGINT"
    x = f"(({half} + {key}) & {low})"
    for by, shift in ((None, 16), (0x85EBCA6B, 13), (0xC2B2AE35, 16)):
        x = x if by is None else f"(({x} * {by}::UBIGINT) & {low})"
        x = f"(list_transform([{x}], lambda x{shift}: xor(x{shift}, x{shift} >> {shift}))[1])"
    return x


# A number goes through all rounds again until it lands below n.
SHARDS = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce(text, '') AS x,
    row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS place FROM documents),
size AS (SELECT count(*) AS n, CAST(greatest(1, ceil(log2(count(*)) / 2)) AS INTEGER) AS h FROM rows),
walk AS (
  SELECT place, CAST(place >> h AS UBIGINT) AS l,
    CAST(place AS UBIGINT) & CAST((1 << h) - 1 AS UBIGINT) AS r, 0 AS k, n, h FROM rows, size
  UNION ALL
  SELECT place, CASE WHEN k = {ROUNDS} THEN l ELSE r END,
    CASE WHEN k = {ROUNDS} THEN r ELSE xor(l, {_mixed("r", f"({round_keys(SHARD_SEED)}::UBIGINT[])[k + 1]")}
      & CAST((1 << h) - 1 AS UBIGINT)) END,
    CASE WHEN k = {ROUNDS} THEN 0 ELSE k + 1 END, n, h
  FROM walk WHERE k < {ROUNDS} OR (l << h) + r >= n)
SELECT doc_id, CAST(octet_length(encode(x)) + 1 AS BIGINT) AS size, {_crc32("x")} AS text_crc32,
  'rows' AS law, CAST(((l << h) + r) % 8 AS INTEGER) AS shard,
  CAST(((l << h) + r) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM rows JOIN walk USING (place) WHERE k = {ROUNDS} AND (l << h) + r < n
"""



def _repairs() -> str:
    """All cheapest ways to each of four states (1: none yet, 2: system, 3: user, 4: assistant), turn
    by turn; of equal cost the least letters."""
    follows = {1: 3, 2: 3, 3: 4, 4: 3}
    names = {2: "s", 3: "u", 4: "a"}
    ways: dict[int, list[str]] = {k: [] for k in follows}
    for state in follows:
        for inserted in range(3):
            at, letters, lines = state, "I" * inserted, ""
            for _ in letters:
                at = follows[at]
                lines += chr(10) + {3: "user:", 4: "assistant:"}[at]
            there = f"st[{state}]"

            def way(to: int, when: str, letter: str, cost: str, line: str,
                    there: str = there, letters: str = letters, lines: str = lines) -> None:
                ways[to].append(
                    f"CASE WHEN {there} IS NOT NULL AND {when} THEN {{'c': {there}.c + "
                    f"{2 * len(letters)} + {cost}, 'a': {there}.a || '{letters}{letter}', "
                    f"'t': {there}.t || '{lines}' || {line}}} END")

            way(at, "true", "D", "3", "''")
            to = follows[at]
            new = {3: "user:", 4: "assistant:"}[to]
            way(to, "NOT gone", "R", "2 + cut", f"chr(10) || '{new}' || x")
            for kept in {to, 2} if at == 1 else {to}:
                way(kept, f"NOT gone AND i = '{names[kept]}'", "K", "cut",
                    "chr(10) || r || ':' || x")
    return ", ".join("list_min(list_filter([" + ", ".join(w) + "], lambda y: y IS NOT NULL))"
                     for w in ways.values())


REPAIR = f"""
WITH RECURSIVE faulty AS (
  SELECT conv_id, turn, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f,
    coalesce(role, ' ') AS r, coalesce(text, ' ') AS x FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE r END AS r,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x,
    unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM faulty WHERE f <> 0),
placed AS (
  SELECT *, substr(r, 1, 1) AS i, md5(CAST(length(r) AS VARCHAR) || ':' || r || x) AS m,
    NOT regexp_matches(x, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(x, '[.!?][\x20\x09-\x0D]*\\z') AS open FROM rows),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m, copy) AS place,
    row_number() OVER (PARTITION BY conv_id, m ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM placed),
turns AS (
  SELECT *, blank OR again AS gone, CASE WHEN open AND NOT blank THEN 1 ELSE 0 END AS cut,
    lag(i) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM judged),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (open AND NOT gone) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
    max(place) AS n FROM turns GROUP BY conv_id),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k,
    CAST([{{'c': 0, 'a': '', 't': ''}}, NULL, NULL, NULL]
         AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)[]) AS st FROM faults
  UNION ALL
  SELECT w.conv_id, place, CAST([{_repairs()}] AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)[])
  FROM walk w JOIN turns t ON t.place = w.k + 1 AND t.conv_id IS NOT DISTINCT FROM w.conv_id),
ended AS (
  SELECT conv_id, list_min(list_filter([st[1],
    CASE WHEN st[2] IS NOT NULL THEN {{'c': st[2].c + 4, 'a': st[2].a || 'II',
      't': st[2].t || chr(10) || 'user:' || chr(10) || 'assistant:'}} END,
    CASE WHEN st[3] IS NOT NULL THEN {{'c': st[3].c + 2, 'a': st[3].a || 'I',
      't': st[3].t || chr(10) || 'assistant:'}} END, st[4]], lambda y: y IS NOT NULL)) AS best
  FROM walk JOIN faults f USING (conv_id) WHERE k = n)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f USING (conv_id) LEFT JOIN ended e USING (conv_id)
"""

SQL: dict[str, str] = {
    "op1_chat_format": CHAT,
    "op3_warc": WARC,
    "op6_substring_dedup": REPEATS,
    "op7_decontaminate": CONTAMINATION,
    "op10_ngram_jaccard": JACCARD,
    "op12_conversation_repair": REPAIR,
    "op13_sharding": SHARDS,
}
