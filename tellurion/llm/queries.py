"""Registered queries of the operators, over whole tables and whole texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.llm import (
    chat, decontam, huffman, jaccard, langid, packing, quality, repeats, rules, secrets, spelling,
    vectorcodes, warc,
)
from tellurion.llm.common import Query, staged, table
from tellurion.session import run_folder

TOKENIZER = "byte_bpe_50k.json"


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, read back from the Huffman-coded files."""
    folder = run_folder(spark, "huffman")
    docs = table(spark, sf_dir, "documents")
    huffman.write(docs, folder, public_tokenizers.path(TOKENIZER), end_id=2)
    return huffman.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, read back by offset from archives with one member per record."""
    folder = run_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(warc.records(pages), f"{folder}/whole")
    members = warc.index(archives, f"{folder}/members")
    return warc.read_records(members).select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


OP2_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id,
    payload_bytes >= 1000 AS large FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN large AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN large AND page_id <> first_id THEN first_id END AS refers_to
FROM m
"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out()))
    return langid.identify(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of thresholds per language and source."""
    found = rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def _op4_sql() -> str:
    measures = {
        "word_length": "if(n_words > 0, 10000 * word_chars // n_words, 0)",
        "symbols": "if(n_words > 0, 10000 * n_symbols // n_words, 0)",
        "dup_lines": "if(n_lines > 0, 10000 * n_dup_lines // n_lines, 0)",
        "repeats": "if(n_words > 0, 10000 * n_repeat_words // n_words, 0)",
    }
    values = ", ".join(f"{e} AS {m}" for m, e in measures.items())
    least = " ".join(f"WHEN '{m}' THEN {v}" for m, v in rules.MEASURES.items())
    pairs = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {m} AS value FROM v WHERE NOT base_failed"
        for m in rules.MEASURES
    )

    def cutoffs(keys: str) -> str:
        part = f"PARTITION BY {keys + ', ' if keys else ''}measure"
        group = f"{keys + ', ' if keys else ''}measure"
        return f"""SELECT {group}, any_value(total) AS total,
            any_value(low) - {rules.WIDTH} * greatest(any_value(high) - any_value(low), CASE measure {least} END) AS low,
            any_value(high) + {rules.WIDTH} * greatest(any_value(high) - any_value(low), CASE measure {least} END) AS high
          FROM (SELECT *, min(CASE WHEN 4 * below >= total THEN bucket END) OVER ({part}) AS low,
              min(CASE WHEN 4 * below >= 3 * total THEN bucket END) OVER ({part}) AS high
            FROM (SELECT *, count(*) OVER ({part} ORDER BY bucket) AS below,
              count(*) OVER ({part}) AS total FROM b)) GROUP BY {group}"""

    within = " AND ".join(
        f"({m} <= max(CASE WHEN c.measure = '{m}' THEN c.high END)"
        + (f" AND {m} >= max(CASE WHEN c.measure = '{m}' THEN c.low END)" if m in rules.TWO_SIDED else "")
        + ")"
        for m in rules.MEASURES
    )
    columns = ", ".join(f"v.{c}" for c in ("doc_id", *rules.COUNTS, "base_failed", *rules.MEASURES))
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT d.doc_id, lang, source, len(ws) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d JOIN w USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
v AS (SELECT *, n_words < {rules.MIN_WORDS}
    OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed, {values} FROM f),
b AS (SELECT lang, source, measure,
    (value >> greatest(length(bin(value)) - 5, 0)) << greatest(length(bin(value)) - 5, 0) AS bucket
  FROM ({pairs})),
own AS ({cutoffs("lang, source")}),
by_lang AS ({cutoffs("lang")}),
every AS ({cutoffs("")}),
c AS (SELECT own.lang, own.source, own.measure,
    CASE WHEN own.total >= {rules.MIN_ROWS} THEN own.low WHEN by_lang.total >= {rules.MIN_ROWS}
      THEN by_lang.low ELSE every.low END AS low,
    CASE WHEN own.total >= {rules.MIN_ROWS} THEN own.high WHEN by_lang.total >= {rules.MIN_ROWS}
      THEN by_lang.high ELSE every.high END AS high
  FROM own JOIN by_lang ON own.lang IS NOT DISTINCT FROM by_lang.lang AND own.measure = by_lang.measure
  JOIN every ON own.measure = every.measure)
SELECT v.doc_id, v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed,
  NOT v.base_failed AND coalesce({within}, true) AS kept
FROM v LEFT JOIN c ON v.lang IS NOT DISTINCT FROM c.lang AND v.source IS NOT DISTINCT FROM c.source
GROUP BY {columns}
"""


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = staged(quality.measured(docs), "statistics")
    model = quality.train(stats, labels.where(~held_out()))
    return quality.classify(stats, model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted"
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, read back from the written blocks."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    blocks = staged(chat.format_chats(turns.unionByName(extra)), "chats")
    return chat.digests(blocks)


def _op6_sql() -> str:
    def escaped(column: str) -> str:
        text = f"replace({column}, '\\', '\\\\')"
        for mark in chat.CONTROL:
            text = f"replace({text}, '{mark}', '{mark[0]}\\{mark[1:]}')"
        return text

    marks = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    said = "</s>[INST] ok [/INST]"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}')),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
    sum({marks} + length({escaped("role")}) + length({escaped("text")}))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM c
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items within an edit similarity of 0.8 of a passage of a document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.find(docs, items)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate class of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s AS a JOIN s AS b ON a.k = b.k AND a.doc_id <> b.doc_id
  JOIN n AS x ON x.doc_id = a.doc_id JOIN n AS y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS v, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(r.c), d.doc_id) AS component_id
FROM documents AS d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.v = d.doc_id
GROUP BY d.doc_id, n.n
"""


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    marked = repeats.mark_repeats(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack(docs, public_tokenizers.path(TOKENIZER), end_id=0)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans and candidates that few owners hold."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "owned")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(k) for k in secrets.KINDS),
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def _op11_sql() -> str:
    assign = "".join(
        f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)"
    ) + secrets.ASSIGN.split(")", 1)[1].replace("'", "''")
    patterns = [assign, secrets.ACCESS, secrets.HEX, secrets.CANDIDATE]
    found = " UNION ALL ".join(
        f"SELECT r, {k} AS kind, regexp_extract_all(t, '{p}') AS f, regexp_split_to_array(t, '{p}') AS p FROM d"
        for k, p in enumerate(patterns)
    )
    names = " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(secrets.KINDS))
    counts = ", ".join(
        f"count(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate(secrets.KINDS)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM ({found}) WHERE len(f) > 0),
m AS (SELECT r, kind, f[i] AS m, CASE kind WHEN 0 THEN regexp_extract(f[i], '{assign}', 2) ELSE f[i] END AS value,
    (list_sum(list_transform(p[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s FROM f),
k AS (SELECT r, kind, value, s, s + length(m) AS e FROM m WHERE CASE kind
  WHEN 0 THEN length(value) >= {secrets.LEAST_VALUE}
  WHEN {secrets.OWNED} THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')
    AND len(list_distinct(string_split(m, ''))) >= {secrets.LEAST_DIFFERENT}
  ELSE true END),
c AS (SELECT * FROM k WHERE kind < {secrets.OWNED} UNION ALL
  SELECT * FROM k WHERE kind = {secrets.OWNED} AND NOT EXISTS (
    SELECT 1 FROM k AS b WHERE b.r = k.r AND b.kind < {secrets.OWNED} AND b.s < k.e AND k.s < b.e)),
o AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (source, doc_id)) AS repositories
  FROM c JOIN d USING (r) GROUP BY value),
a AS (SELECT r, kind, s, CASE kind {names} END || ':' || s || ':' || e AS w,
    owners <= {secrets.MAX_OWNERS} AND repositories <= {secrets.MAX_REPOSITORIES} AS live FROM c JOIN o USING (value)),
g AS (SELECT r, {counts}, count(*) FILTER (live) AS n_live,
    string_agg(w, ',' ORDER BY s, kind) FILTER (kind < {secrets.OWNED}) AS base,
    string_agg(w, ',' ORDER BY s, kind) AS spans
  FROM a WHERE kind < {secrets.OWNED} OR live GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (r)
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all frequent words of the documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE b AS (SELECT list(v ORDER BY i) AS tbl FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
o AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{6,}')) AS w FROM documents),
g AS (SELECT w, count(*) AS n, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
  lambda x: unicode(x)) AS u FROM o GROUP BY doc_id, w),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(u, lambda c:
    CASE WHEN c < 128 THEN [c::BIGINT] ELSE [(192 | (c >> 6))::BIGINT, (128 | (c & 63))::BIGINT] END))),
  lambda c, x: xor(c >> 8, tbl[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM g, b),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
p AS (SELECT word, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT DISTINCT a.word AS a, v.word AS b FROM p AS a JOIN v ON a.l || a.r = v.word),
near AS (SELECT a, b FROM e UNION SELECT b, a FROM e
  UNION SELECT x.word, y.word FROM p AS x JOIN p AS y ON x.l || '*' || x.r = y.l || '*' || y.r AND x.word <> y.word),
t AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n
  FROM near JOIN v ON v.word = b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form,
  CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM v LEFT JOIN t ON t.a = v.word),
r AS (SELECT word, word AS root FROM f UNION ALL
  SELECT r.word, f.form FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM f JOIN r ON r.word = f.word JOIN f AS last ON last.word = r.root WHERE last.form IS NULL
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and errors by label of all vectors, under learned codebooks."""
    codes, model = vectorcodes.compress(table(spark, sf_dir, "embeddings"))
    return vectorcodes.label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(model.digest()).alias("codebooks_sha256")
    )


def _op13_sql() -> str:
    parts, entries, scale = vectorcodes.PARTS, vectorcodes.ENTRIES, vectorcodes.SCALE
    steps = []
    for k in range(vectorcodes.ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min(dist * {entries} + e) AS m FROM (
    SELECT q.r, q.p, q.x, c.e, list_sum(list_transform(range(1, len(q.x) + 1),
      lambda j: (q.x[j] - c.x[j]) * (q.x[j] - c.x[j])))::BIGINT AS dist FROM q JOIN c{k} AS c ON c.p = q.p)
  GROUP BY r, p)""")
        if k < vectorcodes.ROUNDS:
            steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.x, c.x) AS x FROM c{k} AS c LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM (
      SELECT p, m % {entries} AS e, j, sum(x[j])::BIGINT AS s, count(*) AS n
      FROM (SELECT p, m, x, unnest(range(1, len(x) + 1)) AS j FROM a{k}) GROUP BY ALL)
    GROUP BY p, e) AS n USING (p, e))""")
    last = vectorcodes.ROUNDS
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding AS x,
    len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
q AS MATERIALIZED (SELECT r, p, list_transform(x[p * w + 1:(p + 1) * w], lambda c: floor({scale} * c)::BIGINT) AS x
  FROM (SELECT *, unnest(range({parts})) AS p FROM v)),
c0 AS MATERIALIZED (SELECT p, r AS e, x FROM q WHERE r < {entries}),
{", ".join(steps)},
s AS (SELECT r, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error
  FROM a{last} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c{last}) AS codebooks_sha256
FROM s JOIN v USING (r)
"""


QUERIES: dict[str, Query] = {
    "op1_token_ids": op1_token_ids,
    "op2_warc": op2_warc,
    "op3_language": op3_language,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality": op5_quality,
    "op6_chat": op6_chat,
    "op7_decontamination": op7_decontamination,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_repeats": op9_repeats,
    "op10_packing": op10_packing,
    "op11_secrets": op11_secrets,
    "op12_spelling": op12_spelling,
    "op13_vector_codes": op13_vector_codes,
}

CHECKS: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op4_quality_rules": _op4_sql(),
    "op6_chat": _op6_sql(),
    "op8_ngram_jaccard": OP8_SQL,
    "op11_secrets": _op11_sql(),
    "op12_spelling": OP12_SQL,
    "op13_vector_codes": _op13_sql(),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
