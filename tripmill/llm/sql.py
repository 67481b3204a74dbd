"""SQL of the registered queries that SQL can express, for DuckDB."""

OP2 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
places AS (SELECT n, words, unnest(range(greatest(len(words) - 34, 0))) AS i FROM docs),
windows AS (SELECT n, i, array_to_string(words[i + 1:i + 35], ' ') AS t FROM places),
repeated AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY t) AS times FROM windows) WHERE times > 1),
gone AS (SELECT DISTINCT n, unnest(range(i, i + 35)) AS p FROM repeated),
kept AS (
  SELECT n, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT n, unnest(words) AS word, unnest(range(len(words))) AS p FROM docs) ANTI JOIN gone USING (n, p) GROUP BY n),
removed AS (SELECT n, count(*) AS removed FROM gone GROUP BY n)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (n) LEFT JOIN removed USING (n)
"""

OP10 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
sets AS (
  SELECT n, doc_id, CASE WHEN len(words) >= 3
    THEN list_distinct(list_transform(range(len(words) - 2), lambda i: array_to_string(words[i + 1:i + 3], ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles FROM docs),
shingles AS (SELECT n, len(shingles) AS size, unnest(shingles) AS s FROM sets),
links AS (
  SELECT a.n AS a, b.n AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.n <> b.n
  GROUP BY a.n, b.n, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))),
reached(n, m) AS (SELECT n, n FROM docs UNION SELECT r.n, l.b FROM reached r JOIN links l ON l.a = r.m),
names AS (SELECT r.n, min(d.doc_id) AS component_id FROM reached r JOIN docs d ON d.n = r.m GROUP BY r.n)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id FROM sets JOIN names USING (n)
"""

OP8 = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
urls AS (
  SELECT page_id, coalesce(translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(r, length(h) + 1), '^[^?#]*'), '') AS path, row_number() OVER () AS n
  FROM parts),
fitting AS (
  SELECT u.n, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM urls u JOIN rules r ON (u.host = r.host OR u.host LIKE '%.' || r.host) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fitting f ON f.n = u.n AND f.place = 1
"""

OP5 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


def _crc32(blob: str) -> str:
    """The unsigned CRC of a blob, byte by byte and bit by bit."""
    return f"""xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex({blob}), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, e: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295)"""


def _merkle(levels: int = 6) -> str:
    """``levels`` suffice for 16 ** levels documents of a source, and as many sources."""
    from tripmill.llm import merkle

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def leaf(changed: str) -> str:
        values = [f"({changed if c == 'text' else c})::VARCHAR" for c in merkle.COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"

    def tree(name: str, leaves: str) -> str:
        """Levels of nodes (grp, i, n, d): in every group with more than one, runs of 16 join."""
        steps = [f"{name}0 AS (SELECT grp, i, count(*) OVER (PARTITION BY grp) AS n, d FROM {leaves})"]
        for k in range(1, levels + 1):
            steps.append(f"""{name}{k} AS (
  SELECT grp, i // 16 AS i, ceil(any_value(n) / 16)::BIGINT AS n, sha256(string_agg(d, '' ORDER BY i)) AS d
  FROM {name}{k - 1} WHERE n > 1 GROUP BY grp, i // 16)""")
        union = " UNION ALL ".join(f"SELECT grp, d FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
        steps.append(f"{name}_tops AS ({union})")
        return ",\n".join(steps)

    def climb(name: str, start: str, from_: str) -> str:
        """From rows (r, grp, i, folded, proof), level by level, with the siblings of each."""
        steps = [f"{from_}0 AS ({start})"]
        for k in range(levels):
            steps.append(f"""{from_}{k + 1} AS (
  SELECT r, grp, i // 16 AS i, sha256(l || folded || h) AS folded, proof || l || h AS proof FROM (
    SELECT c.r, c.grp, c.i, c.folded, c.proof,
           coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (WHERE s.i < c.i), '') AS l,
           coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (WHERE s.i > c.i), '') AS h
    FROM {from_}{k} c JOIN {name}{k} s ON s.grp = c.grp AND s.i // 16 = c.i // 16 AND s.n > 1 GROUP BY ALL)
  UNION ALL SELECT c.* FROM {from_}{k} c WHERE NOT EXISTS (SELECT 1 FROM {name}{k} s WHERE s.grp = c.grp AND s.n > 1))""")
        return ",\n".join(steps)

    first_up = climb("a", "SELECT r, grp, i, folded, '' AS proof FROM leaves", "up")
    second_up = climb("b", f"SELECT r, 1 AS grp, p.i, folded, proof FROM up{levels} u JOIN names p ON p.grp = u.grp", "over")
    return f"""
WITH docs AS (
  SELECT *, row_number() OVER () AS r, coalesce('=' || source, '') AS grp, {leaf("text")} AS d,
         {_crc32("encode(doc_id::VARCHAR)")} % 5 = 0 AS hit, {leaf(f"translate(text, '{upper}', '{lower}')")} AS altered FROM documents),
leaves AS (
  SELECT r, doc_id, grp, d, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, d, r) - 1 AS i,
         CASE WHEN hit THEN altered ELSE d END AS folded FROM docs),
{tree("a", "leaves")},
names AS (SELECT grp, d, row_number() OVER (ORDER BY encode(grp)) - 1 AS i FROM a_tops),
{tree("b", "(SELECT 1 AS grp, i, d FROM names)")},
{first_up},
{second_up}
SELECT doc_id, leaves.d AS leaf, a_tops.d AS subroot, b_tops.d AS root, sha256(o.proof) AS proof_sha256,
       o.folded AS folded_root, o.folded = b_tops.d AS verified, leaves.i AS place
FROM leaves JOIN a_tops ON a_tops.grp = leaves.grp JOIN b_tops ON true JOIN over{levels} o ON o.r = leaves.r
"""


def _sharding() -> str:
    from tripmill.llm import sharding as sh

    n, whole = sh.SHARDS, sh.WHOLE
    return f"""
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
sized AS (
  SELECT doc_id, (octet_length(b) + 1)::BIGINT AS size, {_crc32("b")} AS text_crc32,
         ('0x' || substr(sha256(b), 1, 15))::BIGINT AS g, row_number() OVER () AS r FROM docs),
sums AS (
  SELECT *, sum(size) OVER (ORDER BY g, doc_id NULLS FIRST, r ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER (PARTITION BY g) AS together, sum(size) OVER () AS total, max(size) OVER () AS largest FROM sized),
spans AS (SELECT *, min(before) OVER (PARTITION BY g) AS first, together <= greatest(largest, total // {n * whole}) AS kept FROM sums),
placed AS (
  SELECT *, ((2 * CASE WHEN kept THEN first ELSE before END + CASE WHEN kept THEN together ELSE size END) * {n} // (2 * total))::INT AS shard
  FROM spans)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY g, doc_id NULLS FIRST, r) - 1 AS slot, NULL::INT AS grown_shard
FROM placed
"""


def _license_scan() -> str:
    from tripmill.llm import license_scan as ls

    sentences = ", ".join(f"('{s}', {ls.NUMBER[name]})" for name, s in ls.SENTENCES.items())
    rules = ", ".join(
        f"({rank}, '{licence}', {len(names)}, {k}, {ls.NUMBER[name]})"
        for rank, (licence, names) in enumerate(ls.RULES)
        for k, name in enumerate(names)
    )
    return f"""
WITH known(sentence, num) AS (VALUES {sentences}),
rules(rank, licence, len, k, num) AS (VALUES {rules}),
docs AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(list_transform(regexp_split_to_array(text, '{ls.ENDS}'),
           lambda s: trim(regexp_replace(translate(s, '{ls.UPPER}', '{ls.LOWER}'), '{ls.NOT_IN_WORDS}', ' ', 'g'))), lambda s: s <> '') AS list
  FROM documents),
sentences AS (SELECT n, doc_id, unnest(list) AS sentence, unnest(range(len(list))) AS pos FROM docs),
hits AS (SELECT n, doc_id, pos, num FROM sentences JOIN known USING (sentence)),
matches AS (
  SELECT n, doc_id, rank, licence, len, pos - k AS start FROM hits JOIN rules USING (num)
  GROUP BY ALL HAVING count(*) = len),
placed AS (
  SELECT *, max(start + len) OVER (PARTITION BY n ORDER BY start, len DESC, rank
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM matches)
SELECT doc_id, start::INT AS first_sentence, len::INT AS n_sentences, licence FROM placed
WHERE before IS NULL OR start + len > before
"""


def _decontaminate() -> str:
    from tripmill.llm import decontaminate as dc

    units, slots = (", ".join(f"'{x}'" for x in some) for some in (dc.UNITS, dc.SLOTS))

    def words(table: str, key: str) -> str:
        return f"SELECT row_number() OVER () AS n, {key}, regexp_extract_all(text, '{dc.TOKEN}') AS raw FROM {table} WHERE text IS NOT NULL"

    template = f"""list_transform(raw, lambda w, i: CASE WHEN substr(w, 1, 1) BETWEEN '0' AND '9' THEN '#'
      WHEN lower(w) IN ({units}) AND i > 1 AND substr(raw[i - 1], 1, 1) BETWEEN '0' AND '9' THEN '%'
      WHEN substr(w, 1, 1) <> lower(substr(w, 1, 1)) THEN '@' ELSE lower(w) END)"""
    w, run = dc.WINDOW, dc.RUN
    low = "list_transform(raw, lambda x: lower(x))"

    def hashes(words: str, length: str) -> str:
        return f"list_transform(range(greatest(len({words}) - {length} + 1, 0)), lambda i: hash(array_to_string({words}[i + 1:i + {length}], ' ')))"

    def distinct(fields: str, words: str) -> str:
        return f"len(list_distinct(list_transform({words}, lambda x: {{{', '.join(f'{f}: x.{f}' for f in fields.split())}}})))"

    # words of the tables are none of the scripts that are cut letter by letter
    return f"""
WITH d AS (SELECT *, {low} AS low, {template} AS tpl FROM ({words("documents", "doc_id")})),
b AS (SELECT *, {low} AS low, {template} AS tpl, len(raw) AS m, least({run}, len(raw)) AS need, least({w}, len(raw)) AS win
      FROM ({words("benchmark", "item_id")}) WHERE len(raw) > 0),
lengths AS (SELECT DISTINCT win FROM b),
dw AS (
  SELECT n, win AS kind, unnest({hashes("low", "win")}) AS h, unnest(range(greatest(len(low) - win + 1, 0))) AS p FROM d, lengths
  UNION ALL SELECT n, 0, unnest({hashes("tpl", str(w))}), unnest(range(greatest(len(tpl) - {w - 1}, 0))) FROM d),
bw AS (
  SELECT item_id, win AS kind, unnest({hashes("low", "win")}) AS h, unnest(range(m - win + 1)) AS q FROM b
  UNION ALL SELECT item_id, 0, unnest({hashes("tpl", str(w))}), unnest(range(m - {w - 1})) FROM b WHERE m >= {w}),
shifts AS (SELECT DISTINCT n, item_id, p - q AS shift FROM dw JOIN bw USING (kind, h)),
pairs AS (
  SELECT s.n, b.item_id, b.m, b.need, b.win, list_transform(range(b.m), lambda k: {{
    kind: b.tpl[k + 1], theirs: b.low[k + 1],
    ours: CASE WHEN shift + k >= 0 THEN d.low[shift + k + 1] END,
    alike: coalesce(shift + k >= 0 AND d.tpl[shift + k + 1] = b.tpl[k + 1], false),
    equal: coalesce(shift + k >= 0 AND d.low[shift + k + 1] = b.low[k + 1], false)}}) AS words
  FROM shifts s JOIN d USING (n) JOIN b USING (item_id)),
passages AS (
  SELECT * FROM pairs WHERE len(list_filter(range(m - need + 1), lambda s:
    len(list_filter(words[s + 1:s + need], lambda x: NOT x.equal)) = 0
    OR (m >= {w} AND len(list_filter(words[s + 1:s + need], lambda x: NOT x.alike)) = 0
        AND {distinct("kind theirs", f"list_filter(words[s + 1:s + need], lambda x: x.kind IN ({slots}))")}
          = {distinct("kind theirs ours", f"list_filter(words[s + 1:s + need], lambda x: x.kind IN ({slots}))")}
        AND {distinct("kind ours", f"list_filter(words[s + 1:s + need], lambda x: x.kind IN ({slots}))")}
          = {distinct("kind theirs ours", f"list_filter(words[s + 1:s + need], lambda x: x.kind IN ({slots}))")}
        AND len(list_filter(range(need - {w - 1}), lambda j:
          len(list_filter(words[s + j + 1:s + j + {w}], lambda x: x.kind NOT IN ({slots}))) >= {dc.LITERALS})) > 0))) > 0),
places AS (SELECT row_number() OVER () AS a, * FROM passages),
same AS (
  SELECT a, n, item_id, m, win, k, words[k + 1] AS x, k - row_number() OVER (PARTITION BY a ORDER BY k) AS run
  FROM (SELECT *, unnest(range(m)) AS k FROM places) WHERE words[k + 1].alike OR words[k + 1].equal),
runs AS (SELECT *, count(*) OVER (PARTITION BY a, run) AS length FROM same),
measured AS (
  SELECT n, item_id, m, max(length) AS longest_run, count(*) FILTER (WHERE length >= win) AS matched_words,
    count(DISTINCT (x.kind, x.theirs, x.ours)) FILTER (WHERE length >= win AND x.kind IN ({slots}) AND x.theirs <> x.ours) AS changed_slots
  FROM runs GROUP BY a, n, item_id, m),
best AS (
  SELECT d.doc_id, a.*, row_number() OVER (PARTITION BY d.doc_id, item_id
                                           ORDER BY longest_run DESC, matched_words DESC, m DESC, changed_slots DESC) AS place
  FROM measured a JOIN d USING (n))
SELECT doc_id, item_id, longest_run::INT AS longest_run, matched_words::INT AS matched_words, m::INT AS item_words,
       changed_slots::INT AS changed_slots FROM best WHERE place = 1
"""


SQL: dict[str, str] = {
    "op2_substring_dedup": OP2,
    "op5_warc": OP5,
    "op6_decontaminate": _decontaminate(),
    "op8_url_filter": OP8,
    "op9_license_scan": _license_scan(),
    "op10_ngram_join": OP10,
    "op11_merkle": _merkle(),
    "op12_sharding": _sharding(),
}
