"""SQL for DuckDB that gives the rows of the queries SQL can express."""

from __future__ import annotations

from cyclerlake.llm import collocations, licences, mixing

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def seeded_sql(*parts: str) -> str:
    text = " || '/' || ".join([f"'{mixing.SEED}'", *(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def sainte_lague_sql(units: str, group: str, unit: str, weight: str, seats: str) -> str:
    """Highest quotients, all listed that can win."""
    by = f"PARTITION BY {group}" if group else ""
    parted = f"PARTITION BY {group} " if group else ""
    return f"""
SELECT * EXCLUDE (exact, slack, sure, remaining, seat, won, all_weight, n_units), first(sure) + sum(won) AS quota FROM (
  SELECT *, CASE WHEN {weight} > 0 AND row_number() OVER ({parted}ORDER BY {weight} / (2 * seat + 1) DESC, {unit} NULLS LAST, seat) <= remaining
    THEN 1 ELSE 0 END AS won FROM (
    SELECT *, unnest(range(sure, exact + slack + 1)) AS seat FROM (
      SELECT *, {seats} - sum(sure) OVER ({by}) AS remaining FROM (
        SELECT *, greatest(0, exact - slack) AS sure FROM (
          SELECT *, CAST(floor({seats} * CASE WHEN all_weight > 0 THEN {weight} / all_weight ELSE 0 END) AS BIGINT) AS exact,
            CAST(ceil(n_units * CASE WHEN all_weight > 0 THEN {weight} / all_weight ELSE 0 END * 1.5) AS BIGINT) + 2 AS slack FROM (
            SELECT *, sum({weight}) OVER ({by}) AS all_weight, count(*) OVER ({by}) AS n_units FROM ({units}) u0) u1) u2) u3) u4) u5) u6
GROUP BY ALL"""


def mix_sql() -> str:
    m = mixing
    weight = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END"
    sources = sainte_lague_sql("SELECT source, source_size, target, shards, seats FROM targets", "", "source", "target", "seats")
    districts = sainte_lague_sql(
        "SELECT source, district, quota AS seats, CAST(sum(words) AS DOUBLE) AS words FROM shards GROUP BY source, district, quota", "source", "district", "words", "seats"
    )
    quotas = sainte_lague_sql(
        """SELECT s.source, s.district, s.shard, CAST(s.words AS DOUBLE) AS words, d.quota AS seats
FROM shards s JOIN districts d ON s.source IS NOT DISTINCT FROM d.source AND s.district = d.district""",
        "source, district",
        "shard",
        "words",
        "seats",
    )
    return rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(greatest(1, ceil(sum(size) / {m.SHARD_WORDS}), ceil(count(*) / {m.SHARD_ROWS})) AS BIGINT) AS shards FROM sized GROUP BY source),
weighed AS (
  SELECT *, {weight} AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total, source_size * {m.LIMIT} AS cap FROM sources),
rooms AS (SELECT *, cap / weight AS room FROM weighed),
levels AS (
  SELECT *, row_number() OVER (ORDER BY room, source NULLS LAST) AS place,
    (total - (sum(cap) OVER (ORDER BY room, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap))
      / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM rooms),
targets AS (
  SELECT source, source_size, shards, least(weight * (SELECT arg_min(level, place) FROM levels WHERE level <= room), CAST(cap AS DOUBLE)) AS target,
    CAST(round(total / {m.BLOCK_WORDS}) AS BIGINT) AS seats FROM levels),
planned AS ({sources}),
placed AS (
  SELECT z.doc_id, z.source, z.size, p.source_size, p.target, p.quota, {seeded_sql('z.doc_id')} AS spin,
    {seeded_sql('z.doc_id')} % p.shards AS shard FROM sized z JOIN planned p ON z.source IS NOT DISTINCT FROM p.source),
shards AS (
  SELECT source, quota, shard, CAST(sum(size) AS BIGINT) AS words, shard // {m.DISTRICT} AS district FROM placed GROUP BY source, quota, shard),
districts AS ({districts}),
quotas AS ({quotas}),
ended AS (
  SELECT p.*, CAST(sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY p.spin, CAST(p.doc_id AS VARCHAR) NULLS LAST, p.size
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ends,
    CAST(q.words AS BIGINT) AS words, least(q.quota * {m.BLOCK_WORDS}, CAST(q.words AS BIGINT) * {m.LIMIT}) AS won
  FROM placed p JOIN quotas q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard),
chosen AS (
  SELECT *, won // greatest(1, words) AS passes, won % greatest(1, words) AS run,
    {seeded_sql("'first'", 'source', 'shard')} % CAST(ceil(greatest(1, words) / {m.BLOCK_WORDS}) AS BIGINT) * {m.BLOCK_WORDS} AS first_word FROM ended)
SELECT doc_id, size, source_size, target, CAST(passes * size
  + greatest(0, least(ends, first_word + run) - greatest(ends - size, first_word))
  + greatest(0, least(ends, first_word + run - words) - (ends - size)) AS BIGINT) AS taken
FROM chosen"""


MIX = mix_sql()

NEIGHBOURS = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


def licences_sql() -> str:
    rows = ", ".join(f"('{name}', '{pair}', {n})" for name, pair, n in licences.template_bigrams(licences.EVERY))
    t = licences.THRESHOLD
    return rf"""
WITH known(license, bigram, m) AS (VALUES {rows}),
words AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w
  FROM documents),
pairs AS (SELECT rid, doc_id, unnest(range(1, len(w))) AS p, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM words),
met AS (SELECT rid, doc_id, license, m, p, bigram FROM pairs JOIN known USING (bigram)),
able AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY rid, license) AS n FROM met) x WHERE n >= {t} / (2 - {t}) * m - 1e-9),
passages AS (
  SELECT *, last - p + 1 AS length FROM (
    SELECT a.rid, a.doc_id, a.license, a.m, a.p, count(DISTINCT b.bigram) AS shared, max(b.p) AS last
    FROM able a JOIN able b ON a.rid = b.rid AND a.license = b.license AND b.p BETWEEN a.p AND a.p + a.m - 1 GROUP BY ALL) g),
ranked AS (
  SELECT *, 2 * shared / (length + m) AS dice, row_number() OVER (PARTITION BY rid, license ORDER BY 2 * shared / (length + m) DESC, p) AS place FROM passages),
best AS (SELECT * FROM ranked WHERE place = 1 AND dice >= {t})
SELECT doc_id, license, dice, CAST(p AS INTEGER) AS first_word, CAST(length + 1 AS INTEGER) AS n_words FROM best h WHERE NOT EXISTS (
  SELECT 1 FROM best g WHERE g.rid = h.rid AND g.p < h.p + h.length AND h.p < g.p + g.length
    AND (g.shared > h.shared OR g.shared = h.shared AND (g.dice > h.dice OR g.dice = h.dice AND g.license < h.license)))"""


LICENCES = licences_sql()

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
told AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS best
  FROM (SELECT page_id, payload FROM payloads) p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to
FROM (SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS INTEGER) * (16 >> CAST(j AS INTEGER)))) AS BIGINT), 1)),
  'string_agg', '') AS payload_digest
  FROM (SELECT *, CAST(CAST(unhex(digest) AS BIT) AS VARCHAR) AS bits FROM told) t) u"""

URLS = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
  SELECT page_id, row_number() OVER () AS rid,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
fits AS (
  SELECT p.rid, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.rid
    ORDER BY len(string_split(r.host, '.')) DESC, length(r.path) DESC) AS place
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (rid)"""

DEDUP = rf"""
WITH told AS (
  SELECT doc_id, row_number() OVER () AS rid, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, rid) = 1 AS kept, text_sha256 FROM told"""


COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(CAST(lang AS VARCHAR), 'und') AS lang, coalesce(text, '') AS text FROM documents) d),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest(range(1, {collocations.MAX_WORDS} + 1)) AS size FROM worded),
placed AS (SELECT lang, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS i FROM sized),
counted AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, CAST(size AS BIGINT) AS size, count(*) AS f FROM placed GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= {collocations.MIN_COUNT}),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1) o),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = c.first JOIN often y ON y.lang = c.lang AND y.phrase = c.rest JOIN total t ON t.lang = c.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
held AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longer FROM (
    SELECT lang, w, f, s, unnest(range(1, CAST(size - s + 2 AS BIGINT))) AS i FROM (
      SELECT lang, w, f, size, unnest(range(2, size)) AS s FROM often WHERE size > 2) o1) o2 GROUP BY ALL),
ranked AS (
  SELECT l.lang, l.phrase, a, l, r, n, score, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, a DESC, l.phrase) AS rank
  FROM lowest l LEFT JOIN held h ON h.lang = l.lang AND h.phrase = l.phrase WHERE place = 1 AND (longer IS NULL OR 100 * longer < 100 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {collocations.TOP}"""
