"""The queries of the operators, over the whole tables of one folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    conversations,
    decontaminate,
    langid,
    licenses,
    lines,
    packing,
    periodic,
    repeats,
    secrets,
    simhash,
    substring,
    toxicity,
    vectors,
)
from shelfmark.llm.common import table, unpacked

# Scores from which a document counts as toxic.
THRESHOLD = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus)), F.lit(-1))


@query
def op1_secret_scan(spark, sf_dir):
    found = secrets.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def secret_sql() -> str:
    """Windows are judged one by one here, from the counts of their characters."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    patterns = [p for _, p, _, _ in secrets.BASE] + [c.pattern for c in secrets.CLASSES]
    groups = [g for _, _, g, _ in secrets.BASE] + [0] * len(secrets.CLASSES)
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {kind} AS kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(v) AS v, unnest(gaps[1:len(m)]) AS gap
        FROM (SELECT doc_id, regexp_extract_all(t, {quote(p)}) AS m, regexp_extract_all(t, {quote(p)}, {g}) AS v,
          string_split_regex(t, {quote(p)}) AS gaps FROM texts)"""
        for kind, (p, g) in enumerate(zip(patterns, groups))
    )
    least = " ".join(f"WHEN {kind} THEN {n}" for kind, (_, _, _, n) in enumerate(secrets.BASE))
    first = len(secrets.BASE)
    allowed = " OR ".join(f"regexp_matches(m, {quote(a)})" for a in secrets.ALLOWED)
    hot = " UNION ALL ".join(
        f"""SELECT doc_id, kind, i, lo, s, {c.window} AS w FROM (
          SELECT doc_id, kind, i, lo, unnest(range(1, length(m) - {c.window - 2})) AS s, m FROM candidates WHERE kind = {kind})
        WHERE list_sum(list_transform(map_values(list_aggregate(string_split(substr(m, s, {c.window}), ''), 'histogram')),
          lambda n: {c.table[1:]}[CAST(n AS BIGINT)])) <= {c.most}"""
        for kind, c in enumerate(secrets.CLASSES, first)
    )
    names = ", ".join(quote(k) for k in secrets.KINDS)
    return f"""
WITH
texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (SELECT *, hi - length(m) AS lo FROM (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS hi FROM found)),
base AS (SELECT doc_id, kind, lo, hi FROM placed WHERE kind < {first} AND length(v) >= CASE kind {least} END),
cut AS (SELECT doc_id, kind, i, lo, string_split_regex(m, {quote(secrets.PLACEHOLDER)}) AS parts,
  regexp_extract_all(m, {quote(secrets.PLACEHOLDER)}) AS words FROM placed WHERE kind >= {first}),
pieces AS (SELECT doc_id, kind, i * 1000000 + k AS i, parts[k] AS m,
  lo + coalesce(list_sum(list_transform(list_concat(parts[1:k - 1], words[1:k - 1]), lambda x: length(x))), 0) AS lo
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM cut)),
candidates AS (SELECT * FROM pieces WHERE NOT ({allowed})),
hot AS ({hot}),
islands AS (SELECT *, sum(CASE WHEN s <= before + w THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, kind, i ORDER BY s) AS island
  FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id, kind, i ORDER BY s) AS before FROM hot)),
merged AS (SELECT doc_id, kind, lo + min(s) - 1 AS lo, lo + max(s) - 1 + w AS hi FROM islands GROUP BY doc_id, kind, i, lo, w, island),
added AS (SELECT * FROM merged m WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.lo <= m.lo AND b.hi >= m.hi)),
every AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM added),
told AS (SELECT *, [{names}][kind + 1] || ':' || CAST(lo AS BIGINT) || ':' || CAST(hi AS BIGINT) AS name FROM every),
joined AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex, string_agg(name, ',' ORDER BY lo, kind, hi) FILTER (is_base) AS base,
  string_agg(name, ',' ORDER BY lo, kind, hi) AS spans FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (doc_id)
"""


ORACLE["op1_secret_scan"] = secret_sql()


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 3) == 1
    network = langid.fit(docs, learn=~held_out)
    found = langid.with_language(docs, network, keep=["doc_id"])
    return unpacked(found, "lang_pred", "score").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op3_license_scan(spark, sf_dir):
    found = licenses.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_sentences",
        F.array_join(F.transform("known", lambda k: F.concat_ws(":", k["place"].cast("string"), k["id"])), ",").alias("sentences"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def license_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    sentences = licenses.known_sentences()
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in sentences.items())
    opening = ", ".join(f"({quote(s)})" for s in licenses.openings(sentences))
    spdx = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in licenses.spdx_names().items())
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for pattern, by in licenses.REPLACED:
        lowered = f"regexp_replace({lowered}, {quote(pattern)}, {quote(by.replace('{1}', chr(92) + '1'))}, 'g')"
    chain = "sequence"
    for number, (_, ids) in enumerate(licenses.EVERY_RULE):
        chain = f"replace({chain}, {quote(';' + ';;'.join(ids) + ';')}, ';#{number};')"
    names = ", ".join(quote(name) for name, _ in licenses.EVERY_RULE)
    tag = licenses.SPDX_TAG
    # These expressions cannot look ahead: the letter or digit behind a label is put back instead.
    label = licenses.LABEL.replace("(?=[a-z0-9])", "([a-z0-9])")
    return rf"""
WITH RECURSIVE
sentences(sentence, id) AS (VALUES {known}),
openings(opening) AS (VALUES {opening}),
spdx(name, id) AS (VALUES {spdx}),
lowered AS (SELECT doc_id, {lowered} AS t FROM documents),
-- The blanks behind a mark become a line break, since these expressions cannot look behind.
cut AS (SELECT row_number() OVER () AS doc, doc_id, string_split_regex(regexp_replace(t, '([.;:!?])[\x20\x09]+', '\1' || chr(10), 'g'),
  '[\x0A\x0D]+') AS raw FROM lowered),
plain AS (SELECT doc, doc_id, list_filter(list_transform(raw, lambda r: {{
    'words': trim(regexp_replace(regexp_replace(r, '{label}', '\1'), '[^a-z0-9]+', ' ', 'g')),
    'stop': regexp_matches(r, '{licenses.ENDED}')}}), lambda s: s.words <> '') AS s FROM cut),
each AS (SELECT doc, unnest(range(0, len(s))) AS place, unnest(s).words AS words, unnest(s).stop AS stop FROM plain),
-- Runs of pieces, as long as they open a known sentence; known ones have an id.
runs AS (
  SELECT doc, place, 1 AS n, words AS run, (NOT stop AND opening IS NOT NULL) AS goes_on, id
  FROM each LEFT JOIN sentences ON words = sentence LEFT JOIN openings ON words = opening
  WHERE id IS NOT NULL OR (NOT stop AND opening IS NOT NULL)
  UNION ALL
  SELECT r.doc, r.place, r.n + 1, r.run || ' ' || e.words, (NOT e.stop AND o.opening IS NOT NULL), k.id
  FROM runs r JOIN each e ON e.doc = r.doc AND e.place = r.place + r.n
  LEFT JOIN sentences k ON k.sentence = r.run || ' ' || e.words LEFT JOIN openings o ON o.opening = r.run || ' ' || e.words
  WHERE r.goes_on),
longest AS (SELECT doc, place, max(n) AS n, arg_max(id, n) AS id FROM runs WHERE id IS NOT NULL GROUP BY doc, place),
before AS (SELECT *, max(place + n) OVER (PARTITION BY doc ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
  FROM longest),
followed AS (SELECT doc, place, words, lead(words) OVER (PARTITION BY doc ORDER BY place) AS next FROM each),
tags AS (SELECT doc, place, string_split_regex(replace(CASE WHEN suffix(words, '{tag}') THEN next
    ELSE substr(words, {len(tag) + 2}) END, ' or later', ' orlater'), '{licenses.OPERATOR}') AS parts
  FROM followed WHERE suffix(words, '{tag}') OR prefix(words, '{tag} ')),
named AS (SELECT doc, place, unnest(parts) AS name, unnest(range(1, len(parts) + 1)) AS part FROM tags),
every AS (SELECT doc, place, 0 AS part, id FROM before WHERE upto IS NULL OR upto < place + n
  UNION ALL SELECT doc, place, part, id FROM named JOIN spdx USING (name)),
known AS (SELECT doc, string_agg(place || ':' || id, ',' ORDER BY place, part) AS sentences,
  ';' || string_agg(id, ';;' ORDER BY place, part) || ';' AS sequence FROM every GROUP BY doc),
taken AS (SELECT doc, sentences, regexp_extract_all({chain}, '#([0-9]+);', 1) AS rules FROM known)
SELECT doc_id, len(s) AS n_sentences, coalesce(sentences, '') AS sentences,
  coalesce(array_to_string(list_transform(rules, lambda n: [{names}][CAST(n AS INTEGER) + 1]), ','), '') AS licenses
FROM plain LEFT JOIN taken USING (doc)
"""


ORACLE["op3_license_scan"] = license_sql()


@query
def op4_substring_dedup(spark, sf_dir):
    found = substring.without_repeats(table(spark, sf_dir, "documents"), width=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op4_substring_dedup"] = r"""
WITH
dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM dw WHERE len(w) >= 13)),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM grams GROUP BY gram HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS place
  FROM grams JOIN firsts USING (gram) WHERE doc_id > first_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM dw),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (doc_id)
"""


@query
def op5_line_dedup(spark, sf_dir):
    found = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_lines=2, long_line=40)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLE["op5_line_dedup"] = r"""
WITH
parts AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
every AS (SELECT doc_id, unnest(range(0, len(parts))) AS i, unnest(parts) AS line FROM parts),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM every
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (SELECT *, lead(line) OVER w AS line2, lead(i) OVER w AS upto FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
firsts1 AS (SELECT line, min((doc_id, k)) AS f FROM numbered GROUP BY line HAVING count(*) > 1),
firsts2 AS (SELECT line, line2, min((doc_id, k)) AS f FROM pairs WHERE line2 IS NOT NULL GROUP BY line, line2 HAVING count(*) > 1),
cuts AS (
  SELECT doc_id, i, i AS upto FROM numbered JOIN firsts1 USING (line)
  WHERE length(line) >= 40 AND (f[1] <> doc_id OR f[2] + 1 <= k)
  UNION ALL
  SELECT doc_id, i, upto FROM pairs JOIN firsts2 USING (line, line2) WHERE f[1] <> doc_id OR f[2] + 2 <= k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, upto + 1)) AS i FROM cuts),
runs AS (SELECT doc_id, count(*) AS n_runs FROM gone g
  WHERE NOT EXISTS (SELECT 1 FROM gone p WHERE p.doc_id = g.doc_id AND p.i = g.i - 1) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM every ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM numbered GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n_removed FROM numbered SEMI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN runs USING (doc_id)
  LEFT JOIN removed USING (doc_id)
"""


@query
def op6_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op6_benchmark_decontamination"] = r"""
WITH
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS gram, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM dw, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, s, p.size FROM places p JOIN windows USING (gram, size)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op7_nearest_neighbours(spark, sf_dir):
    found = vectors.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query
def op8_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    found = unpacked(toxicity.with_toxicity(docs, model, keep=["doc_id"]), "score", "evidence")
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence"
    )


@query
def op10_simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, shingle=3, max_bits=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations without nulls but in ids and turns, some dropped, emptied, cut, repeated or given another role."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    every = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return every.select("conv_id", "turn", role.alias("role"), changed.alias("text"), copies.alias("copy")).drop("copy")


@query
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.repaired(damaged(rows)).withColumnRenamed("conv_id", "id")
    every = rows.select("conv_id").distinct()
    number = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id",
        number(F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps"),
        *[number(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def conversation_sql() -> str:
    """The cheapest edits of the rows from each one on, from the last to the first, by state."""
    add = lambda x, cost, label: f"(printf('%08d', CAST({x}[:8] AS BIGINT) + ({cost})) || '{label}' || {x}[9:])"
    more = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
    stays = "fault NOT IN ('blank', 'duplicate')"
    following = {"f0": {"u": "fu", "s": "fs"}, "fs": {"u": "fu"}, "fu": {"a": "fa"}, "fa": {"u": "fu"}}
    one = {}
    for state, after in following.items():
        options = [add(f"f.{state}", 2, "D")]
        for initial, to in after.items():
            options.append(f"CASE WHEN {stays} AND role[:1] = '{initial}' THEN {add(f'f.{to}', more, 'K')} END")
            if initial != "s":
                options.append(f"CASE WHEN {stays} THEN {add(f'f.{to}', '1 + ' + more, 'R')} END")
        one["g" + state[1]] = f"least({', '.join(options)})"
    ways = {"f0": ("g0", "gu", "ga"), "fs": ("gs", "gu", "ga"), "fu": ("gu", "ga", "gu"), "fa": ("ga", "gu", "ga")}
    best = ", ".join(f"least({a}, {add(b, 5, 'I')}, {add(c, 10, 'II')}) AS {state}" for state, (a, b, c) in ways.items())
    singles = ", ".join(f"{e} AS {n}" for n, e in one.items())
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return rf"""
WITH RECURSIVE
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(key)} % 20 AS kind FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
-- Equal rows have no order but this number, so it decides which of them comes first.
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS times,
  lead(role[:1]) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM numbered),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN times > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE 'fine' END AS fault FROM placed),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (following IS NOT NULL AND role[:1] || following NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
f AS (SELECT conv_id, n + 1 AS i, '00000000' AS f0, '00000010II' AS fs, '00000005I' AS fu, '00000000' AS fa FROM counts
  UNION ALL
  SELECT conv_id, i, {best} FROM (SELECT j.conv_id, j.i, {singles} FROM f JOIN judged j ON j.conv_id IS NOT DISTINCT FROM f.conv_id AND j.i = f.i - 1)),
told AS (SELECT conv_id, CAST(f0[:8] AS BIGINT) AS cost, f0[9:] AS audit FROM f WHERE i = 1),
edits AS (SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS i
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(1, length(audit) + 1)) AS p FROM told WHERE audit <> '')),
lines AS (SELECT e.conv_id, e.p, CASE WHEN e = 'K' THEN j.role WHEN sum(CASE WHEN e.e = 'K' AND j.role[:1] = 's' THEN 0 ELSE 1 END)
    OVER (PARTITION BY e.conv_id ORDER BY e.p) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE j.text END AS line
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i WHERE e <> 'D'),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS text FROM lines GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(r.text, '')) AS repaired_sha256
FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def with_periodic_tails(text: Column) -> Column:
    """Every tenth document's words, by the crc32 of its id, go over into repeats of a few of them."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies)), F.lit(1), n - a)
    repeating = F.concat_ws(" ", F.slice(words, F.lit(1), a), tail)
    return F.when((h % 10 == 0) & (n > 0), repeating).otherwise(F.coalesce(text, F.lit("")))


@query
def op12_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", with_periodic_tails(F.col("text")).alias("text"))
    found = periodic.with_runs(docs, least=24, periods=3, keep=["doc_id"])
    best = F.get("runs", F.col("strongest"))
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def periodic_sql(levels: int = 16) -> str:
    """Blocks of 16 words and twice, four times ... as many; nearest earlier equal blocks; stretches of one lag."""
    size = 16
    blocks = [f"""b{size} AS (SELECT doc_id, i, dense_rank() OVER (ORDER BY doc_id, block) AS r FROM (
  SELECT doc_id, i, array_to_string(w[i + 1:i + {size}], ' ') AS block
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - {size - 1})) AS i FROM dw WHERE len(w) >= {size}))
  QUALIFY count(*) OVER (PARTITION BY doc_id, block) > 1)"""]
    lags = []
    for level in range(levels):
        above = 0 if level == 0 else size // 2
        lags.append(f"""SELECT doc_id, q, min(i) - q AS start, max(i) + {size} - min(i) + q AS length FROM (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
  FROM (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS q FROM b{size})
  WHERE q > {above} AND q <= {size}) GROUP BY doc_id, q, island""")
        blocks.append(f"""b{2 * size} AS (SELECT doc_id, i, r FROM (
  SELECT a.doc_id, a.i, dense_rank() OVER (ORDER BY a.r, b.r) AS r FROM b{size} a JOIN b{size} b ON b.doc_id = a.doc_id AND b.i = a.i + {size})
  QUALIFY count(*) OVER (PARTITION BY r) > 1)""")
        size *= 2
    every = " UNION ALL ".join(lags)
    return rf"""
WITH
plain AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
dw AS (SELECT doc_id, CASE WHEN crc % 10 = 0 AND n > 0 THEN list_transform(range(0, n),
    lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (crc // 10) % 8)) ELSE i END]) ELSE w END AS w
  FROM (SELECT *, CASE WHEN n > 0 THEN (crc // 10) % n END AS a FROM (SELECT doc_id, w, len(w) AS n, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS crc FROM plain))),
{", ".join(blocks)},
runs AS (SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(q AS BIGINT) AS period
  FROM ({every}) WHERE length >= greatest(24, 3 * q)),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id
  ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
listed AS (SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM dw),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM dw LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def crc32_sql(text: str) -> str:
    """The CRC-32 of a short ASCII text, bit by bit."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = "xor(c, b)"
    bits = f"list_reduce(list_prepend({byte}, range(0, 8)), lambda c, k: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits}), 4294967295)"


ORACLE["op11_conversation_repair"] = conversation_sql()
ORACLE["op12_periodic_runs"] = periodic_sql()


@query
def op13_suffix_array_dedup(spark, sf_dir):
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), width=100)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


# Bytes are written as two hexadecimal digits, since texts cannot be cut between bytes.
ORACLE["op13_suffix_array_dedup"] = r"""
WITH
texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
windows AS (SELECT doc_id, s, md5_number(substr(t, 2 * s + 1, 200)) AS w
  FROM (SELECT doc_id, t, unnest(range(0, length(t) // 2 - 99)) AS s FROM texts WHERE length(t) >= 200)),
firsts AS (SELECT w, min((doc_id, s)) AS f FROM windows GROUP BY w HAVING count(*) > 1),
later AS (SELECT doc_id, s FROM windows JOIN firsts USING (w) WHERE (doc_id, s) > f),
islands AS (SELECT *, sum(CASE WHEN s <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS island
  FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM later)),
spans AS (SELECT doc_id, min(s) AS lo, max(s) + 100 AS hi FROM islands GROUP BY doc_id, island),
pieces AS (SELECT doc_id, lo, substr(t, 2 * upto + 1, 2 * (lo - upto)) AS piece FROM (
  SELECT doc_id, lo, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS upto
  FROM (SELECT doc_id, lo, hi FROM spans UNION ALL SELECT doc_id, length(t) // 2, NULL FROM texts)) JOIN texts USING (doc_id)),
kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY lo) AS t FROM pieces GROUP BY doc_id),
removed AS (SELECT doc_id, sum(hi - lo) AS n, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, length(texts.t) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.t, ''))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""
