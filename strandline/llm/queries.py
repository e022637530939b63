"""The opN queries and their SQL. Each is thin: the operator does the work, the query derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, fingerprints, html_text, language_id, licenses, line_dedup, media, minhash, mixing, ngram_join, periodic_runs, resampling, token_files
from strandline.llm.common import new_path, table

# Names of the vocabulary files; the functions below take paths.
WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    profiles = language_id.train(docs.filter(~F.col("held_out")))
    out = language_id.predict(docs.select("doc_id", "held_out", "text"), profiles, "lang_pred", "score")
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    taken = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - taken), F.substring("next_text", F.lit(1), taken))
    rows = rows.select("*", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprints.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(WORD_VOCABULARY))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store(table(spark, sf_dir, "documents"), "text", "doc_id")
    return media.inspect(stored, "doc_id").select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media_type"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(BYTE_VOCABULARY))
    return token_files.with_starts(token_files.token_offsets(token_files.read_tokens(spark, path)))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def looped(docs: DataFrame) -> DataFrame:
    """docs with every tenth text, by crc32 of its doc_id, made to say a stretch of its words again and again to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def loop(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - F.lit(1).cast("long")), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bound = F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, loop(ws)).otherwise(F.lit(""))), 0)
    return docs.withColumn("text", F.when(h % 10 == 0, bound).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(looped(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = periodic_runs.longest()
    length = -best["l"]
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=80, size=2)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"), keep_text=False).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_main_text": op2_main_text,
    "op3_ngram_join": op3_ngram_join,
    "op4_licenses": op4_licenses,
    "op5_language_id": op5_language_id,
    "op6_fingerprints": op6_fingerprints,
    "op7_bpe": op7_bpe,
    "op8_media": op8_media,
    "op9_token_files": op9_token_files,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_minhash": op12_minhash,
    "op13_resampling": op13_resampling,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _values(rows: list[tuple]) -> str:
    def one(x) -> str:
        return "[" + ", ".join(map(one, x)) + "]" if isinstance(x, list) else str(x) if isinstance(x, int) else f"'{x}'"

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def _license_sql() -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    phrases = _values([(p.split(), len(p.split()), label) for p, label in licenses.PHRASES.items()])
    sets = [(label, licenses.template_words(t), licenses.window_words(t)) for label, t in licenses.TEMPLATES]
    templates = _values([(k, label, own, licenses._needed(len(own), licenses.THRESHOLD), width) for k, (label, own, width) in enumerate(sets)])
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
w AS (SELECT doc_id, regexp_extract_all(low, {word}) AS ws FROM d), phrases(parts, n, label) AS (VALUES {phrases}), templates(number, label, ts, needed, width) AS (VALUES {templates}),
p AS (SELECT doc_id, i - 1 AS start, label FROM w, unnest(range(1, len(ws) + 1)) AS g(i), phrases WHERE ws[i:i + n - 1] = parts),
x AS (SELECT number, label, needed, width, len(ts) AS size, unnest(ts) AS t FROM templates),
v AS (SELECT doc_id, number, label, needed, width, size, i, t FROM (SELECT doc_id, i, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) AS g(i)) JOIN x ON t = word),
e AS (SELECT doc_id, number FROM v GROUP BY doc_id, number, needed HAVING count(DISTINCT t) >= needed),
c AS (SELECT a.doc_id, a.label, a.needed, a.size, count(DISTINCT b.t) AS k FROM v a JOIN e ON e.doc_id = a.doc_id AND e.number = a.number JOIN v b ON b.doc_id = a.doc_id AND b.number = a.number AND b.i >= a.i AND b.i < a.i + a.width GROUP BY a.doc_id, a.number, a.label, a.needed, a.size, a.i),
h AS (SELECT doc_id, label, k / CAST(size AS DOUBLE) AS held FROM c WHERE k >= needed),
pl AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(held) AS held FROM (SELECT doc_id, label, 1.0 AS held FROM p UNION ALL SELECT * FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(held, 0.0) AS score
FROM w LEFT JOIN pl ON pl.doc_id = w.doc_id LEFT JOIN al ON al.doc_id = w.doc_id
"""


def _join_sql(size: int, percent: int, more: str = "") -> str:
    """Shingles of `size` words, links of at least that similarity, components by recursion."""
    shingle = " || ' ' || ".join(f"ws[i + {k}]" for k in range(size))
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= {size} THEN list_distinct(list_transform(range(1, len(ws) - {size - 2}), lambda i: {shingle}))
                                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= {percent} * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(reached) AS component_id{more} FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


#: The table of the 32-bit cyclic redundancy check by byte, for _crc().
CRC_TABLE = "SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs"


def _crc(octets: str) -> str:
    """SQL for the unsigned crc32 of a list of bytes, where a column crcs holds CRC_TABLE."""
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(crcs[xor(c & 255, b) + 1], c >> 8)), 4294967295)"


RUNS_SQL = rf"""
WITH tab AS ({CRC_TABLE}),
o AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_crc("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} AS h FROM documents, tab),
g AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS loops, h // 10 AS g FROM o),
a AS (SELECT *, CASE WHEN loops THEN g % n END AS a, CASE WHEN loops THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
w AS (SELECT doc_id, n, i, ws[1 + CASE WHEN loops AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM a, unnest(range(0, n)) AS u(i)),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
e AS (SELECT doc_id, q, min(i) AS lo, max(i) + 1 + q AS hi FROM s GROUP BY doc_id, q, island HAVING max(i) + 1 + q - min(i) >= greatest(6, 4 * q)),
r AS (SELECT doc_id, lo AS start, hi - lo AS length, min(q) AS period FROM e GROUP BY doc_id, lo, hi),
b AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := start, l := length, p := period), struct_pack(a := -length, b := start, c := period)) AS best,
  string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
k AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS stay FROM w WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length) GROUP BY w.doc_id)
SELECT o.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(stay, '')) AS collapsed_sha256
FROM o LEFT JOIN b ON b.doc_id = o.doc_id LEFT JOIN k ON k.doc_id = o.doc_id
"""

RESAMPLING_SQL = rf"""
WITH tab AS ({CRC_TABLE}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
fd AS (SELECT doc_id, array_to_string(ws[i:i + k - 1], ' ') AS f FROM d, unnest(range(1, len(ws) + 1)) AS g(i), (VALUES (1), (2), (3)) AS o(k) WHERE i + k - 1 <= len(ws)),
fb AS (SELECT array_to_string(ws[i:i + k - 1], ' ') AS f FROM b, unnest(range(1, len(ws) + 1)) AS g(i), (VALUES (1), (2), (3)) AS o(k) WHERE i + k - 1 <= len(ws)),
n AS (SELECT f, sum(s) AS s, sum(t) AS t FROM (SELECT f, 1 AS s, 0 AS t FROM fd UNION ALL SELECT f, 0, 1 FROM fb) GROUP BY f),
c AS (SELECT f, s, t, {_crc("list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: CAST('0x' || x AS BIGINT))")} % 10000 AS bucket FROM n, tab),
k AS (SELECT bucket, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM c GROUP BY bucket),
a AS (SELECT CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM n),
w AS (SELECT bucket, CAST(floor(1000 * ln((k.t + 1) * (a.s + 10000) / ((k.s + 1) * (a.t + 10000)))) AS BIGINT) AS gain FROM k, a),
g AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM fd JOIN c ON c.f = fd.f JOIN w ON w.bucket = c.bucket GROUP BY doc_id),
h AS (SELECT d.doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN g ON g.doc_id = d.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM h WHERE n_words >= 20)
SELECT h.doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM h LEFT JOIN r ON r.doc_id = h.doc_id
"""

SQL = {
    "op13_resampling": RESAMPLING_SQL,
    "op11_periodic_runs": RUNS_SQL,
    "op3_ngram_join": _join_sql(3, 90),
    "op12_minhash": _join_sql(2, 80, ", r.doc_id = min(reached) AS kept"),
    "op4_licenses": _license_sql(),
    "op1_line_dedup": r"""
WITH l AS (
  SELECT doc_id, g.i AS pos, lines[g.i] AS line,
         translate(trim(lines[g.i], chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) d,
       unnest(range(1, len(lines) + 1)) AS g(i)
), k AS (
  SELECT key, min(doc_id) AS first_doc FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (k.first_doc <> l.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (k.key IS NULL OR k.first_doc = l.doc_id), '')) AS kept_sha256
FROM l LEFT JOIN k ON l.key = k.key
GROUP BY l.doc_id
""",
}
