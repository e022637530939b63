"""Registered queries of the engine's operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions import arrays, scalars
from strandline.operators import catalog, cues, frames, reference, search, segments, signal, tokens
from strandline.plans import alignment, fixtures
from strandline.plans.fixtures import BLANK, CUES, ENERGIES, SCORES, table
from strandline.sources import readers, writers
from strandline.sources.shared import new_folder
from strandline.streaming import chunks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# frames


@query(f"WITH {SCORES} SELECT rec, t, CAST(best AS INT) AS id, round(CAST(list_sort(lp, 'DESC')[1] AS DOUBLE) - CAST(list_sort(lp, 'DESC')[2] AS DOUBLE), 5) AS margin FROM greedy")
def w13_greedy_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = fixtures.scores(spark, sf_dir).withColumn("lp", F.col("lp").cast("array<double>"))
    return frames.greedy(scores).withColumn("margin", F.round("margin", 5))


@query(f"""WITH {SCORES}, s AS (SELECT *, lag(id, 1, 0) OVER (PARTITION BY rec ORDER BY t) AS before FROM symbols)
SELECT rec, t, id FROM s WHERE id <> 0 AND id <> before""")
def w1_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.collapse(fixtures.symbols(spark, sf_dir), BLANK)


@query(f"""WITH {SCORES}, s AS (SELECT *, lag(id, 1, 0) OVER (PARTITION BY rec ORDER BY t) AS before FROM symbols)
SELECT rec, t, id, CAST(sum(CASE WHEN id <> 0 AND id <> before THEN 1 ELSE 0 END) OVER (PARTITION BY rec ORDER BY t) AS BIGINT) AS n_tokens FROM s""")
def w4_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.prefix_counts(fixtures.symbols(spark, sf_dir), BLANK)


@query(f"""WITH {SCORES}, s AS (SELECT *, lag(id, 1, 0) OVER (PARTITION BY rec ORDER BY t) AS before FROM symbols),
c AS (SELECT rec, t, id, sum(CASE WHEN id <> 0 AND id <> before THEN 1 ELSE 0 END) OVER (PARTITION BY rec ORDER BY t) AS n FROM s)
SELECT rec, t, id, CAST(CASE WHEN id = 0 THEN 2 * n ELSE 2 * n - 1 END AS BIGINT) AS state FROM c""")
def w3_label_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.label_states(fixtures.symbols(spark, sf_dir), BLANK)


@query(f"""WITH {SCORES}, s AS (SELECT *, CASE WHEN id <> lag(id) OVER (PARTITION BY rec ORDER BY t) THEN 1 WHEN t = 0 THEN 1 ELSE 0 END AS new FROM symbols),
r AS (SELECT *, sum(new) OVER (PARTITION BY rec ORDER BY t) - 1 AS run_no FROM s)
SELECT rec, CAST(run_no AS BIGINT) AS run_no, id, min(t) AS first, max(t) AS last, count(*) AS frames FROM r GROUP BY rec, run_no, id""")
def w16_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.runs(fixtures.symbols(spark, sf_dir))


@query(f"""WITH {SCORES}, seen AS (SELECT rec, id AS state, min(t) AS first_seen, max(t) AS last_seen FROM symbols GROUP BY rec, id),
states AS (SELECT DISTINCT rec, s.state FROM symbols, (SELECT unnest(range(0, 6)) AS state) s)
SELECT st.rec, st.state, coalesce(first_seen, -1) AS first_seen, coalesce(last_seen, -1) AS last_seen FROM states st LEFT JOIN seen USING (rec, state)""")
def agg1_state_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.symbols(spark, sf_dir).withColumnRenamed("id", "state")
    states = path.select("rec").distinct().select("rec", F.explode(F.lit([0, 1, 2, 3, 4, 5]).cast("array<long>")).alias("state"))
    return frames.state_spans(path, states)


@query(f"""WITH {SCORES}, seen AS (SELECT rec, id AS state, min(t) AS first_seen, max(t) AS last_seen FROM symbols GROUP BY rec, id),
tokens AS (SELECT DISTINCT rec, w.word_no, w.pos FROM symbols, (VALUES (0, 0), (1, 1), (2, 0), (2, 1), (3, 5)) w(word_no, pos)),
j AS (SELECT t.rec, t.word_no, t.pos, s.first_seen, s.last_seen FROM tokens t LEFT JOIN seen s ON s.rec = t.rec AND s.state = 2 * t.pos + 1)
SELECT rec, word_no, min(first_seen) AS start_frame, max(last_seen) AS end_frame, count(*) AS n_spans FROM j GROUP BY rec, word_no HAVING count(*) = count(first_seen)""")
def agg2_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.symbols(spark, sf_dir).withColumnRenamed("id", "state")
    words = F.explode(F.lit([[0, 0], [1, 1], [2, 0], [2, 1], [3, 5]])).alias("w")
    tokens = path.select("rec").distinct().select("rec", words).select("rec", F.col("w")[0].alias("word_no"), F.col("w")[1].alias("pos"))
    got = frames.token_spans(frames.state_spans(path), tokens)
    return got.select("rec", "word_no", "start_frame", "end_frame", F.size("token_frame_spans").cast("long").alias("n_spans"))


@query(f"""WITH {SCORES}, n AS (SELECT rec, count(*) AS n_frames FROM scores GROUP BY rec),
k AS (SELECT rec, n_frames, CASE WHEN n_frames <= 10 THEN 1 ELSE 1 + CAST(ceil((n_frames - 10) / 7.0) AS INT) END AS c FROM n)
SELECT rec, CAST(g.i AS INT) AS chunk, CAST(g.i * 7 AS INT) AS first_frame, least(g.i * 7 + 10, n_frames) - 1 AS last_frame,
  g.i * 7 + 10 - least(g.i * 7 + 10, n_frames) AS padding FROM k, unnest(range(0, c)) AS g(i)""")
def w17_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = fixtures.scores(spark, sf_dir).groupBy("rec").agg(F.count("*").alias("n_frames"))
    return frames.chunks(lengths, window=10, hop=7)


@query(f"""WITH {SCORES}, n AS (SELECT rec, count(*) AS n_frames, CASE WHEN count(*) <= 10 THEN 1 ELSE 1 + CAST(ceil((count(*) - 10) / 7.0) AS INT) END AS c FROM scores GROUP BY rec),
s AS (SELECT rec, 0 AS chunk FROM n UNION SELECT rec, 3 FROM n), e AS (SELECT s.rec, chunk, n_frames, coalesce(lead(chunk) OVER (PARTITION BY s.rec ORDER BY chunk), c) AS end_chunk FROM s JOIN n USING (rec))
SELECT rec, CAST(row_number() OVER (PARTITION BY rec ORDER BY chunk) - 1 AS INT) AS segment, chunk AS first_chunk, end_chunk, greatest(0, chunk - 2) * 7 AS first_row,
  least((end_chunk - 1) * 7 + 10, n_frames) AS end_row, chunk - greatest(0, chunk - 2) AS skip FROM e""")
def dp18_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = fixtures.scores(spark, sf_dir).groupBy("rec").agg(F.count("*").alias("n_frames"))
    return frames.segments(lengths, lengths.select("rec", F.lit(3).alias("chunk")), warmup=2, window=10, hop=7)


@query(f"""WITH {SCORES}, pieces(segment, first_chunk, end_chunk, skip) AS (VALUES (0, 0, 3, 0), (1, 3, 5, 2)), o AS (SELECT DISTINCT rec, p.*, r.row FROM scores, pieces p, (SELECT unnest(range(0, 40)) AS row) r)
SELECT rec, segment, row, first_chunk * 6 + row - skip * 6 AS t FROM o WHERE row - skip * 6 >= 0 AND row - skip * 6 < (end_chunk - first_chunk) * 6""")
def dp18_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = fixtures.scores(spark, sf_dir).select("rec").distinct()
    p = F.explode(F.lit([[0, 0, 3, 0], [1, 3, 5, 2]]))
    pieces = recs.select("rec", p.alias("p")).select("rec", *[F.col("p")[k].alias(n) for k, n in enumerate(["segment", "first_chunk", "end_chunk", "skip"])])
    outputs = pieces.select("rec", "segment", F.explode(F.sequence(F.lit(0), F.lit(39)).cast("array<long>")).alias("row"))
    return frames.stitch(outputs, pieces, per_chunk=6)


@query(f"""WITH {SCORES}, sm AS (SELECT rec, t, list_transform(lp, lambda x: CAST(x AS DOUBLE) - CAST(list_max(lp) AS DOUBLE)) AS d FROM scores),
n AS (SELECT rec, t, d, ln(list_sum(list_transform(d, lambda x: exp(x)))) AS z FROM sm)
SELECT rec, t, round(d[1] - z, 6) AS first, round(list_sum(list_transform(d, lambda x: exp(x - z))), 6) AS total FROM n""")
def ce_log_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fixtures.scores(spark, sf_dir).select("rec", "t", arrays.log_softmax(F.col("lp")).alias("x"))
    total = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + F.exp(v))
    return got.select("rec", "t", F.round(F.get("x", 0), 6).alias("first"), F.round(total, 6).alias("total"))


@query(f"""WITH {SCORES}, p AS (SELECT rec, t, unnest(range(0, len(lp))) AS i, unnest(lp) AS v, best FROM greedy),
r AS (SELECT rec, t, i, row_number() OVER (PARTITION BY rec, t ORDER BY v DESC, i) AS k FROM p WHERE i <> best)
SELECT rec, t, CAST(i AS INT) AS id, CAST(k AS INT) AS rank FROM r WHERE k <= 3""")
def st3_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fixtures.scores(spark, sf_dir).select("rec", "t", F.posexplode(arrays.top_k(F.col("lp"), 3, arrays.argmax(F.col("lp")))).alias("k", "a"))
    return got.select("rec", "t", F.col("a.index").alias("id"), (F.col("k") + 1).alias("rank"))


@query(f"""WITH {SCORES}, pr AS (SELECT rec, t, [list_sum(list_transform(lp[1:21], lambda x: exp(x::DOUBLE))), list_sum(list_transform(lp[22:42], lambda x: exp(x::DOUBLE))), list_sum(list_transform(lp[43:64], lambda x: exp(x::DOUBLE)))] AS e FROM scores),
p AS (SELECT rec, t, list_transform(e, lambda x: x / list_sum(e)) AS p FROM pr), b AS (SELECT rec, t, p, list_position(p, list_max(p)) - 1 AS id FROM p),
s AS (SELECT *, CASE WHEN id <> lag(id) OVER (PARTITION BY rec ORDER BY t) OR t = 0 THEN 1 ELSE 0 END AS new FROM b), r AS (SELECT *, sum(new) OVER (PARTITION BY rec ORDER BY t) - 1 AS run_no FROM s)
SELECT rec, CAST(run_no AS BIGINT) AS run_no, CAST(id AS INT) AS id, round(avg(p[id + 1]), 4) AS confidence, round(max(p[id + 1]), 4) AS confidence_peak, round(min(t) * 4e-2, 3) AS start, round((max(t) + 1) * 4e-2, 3) AS "end", count(*) AS frames
FROM r WHERE id <> 0 GROUP BY rec, run_no, id""")
def agg13_run_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mass(a: int, n: int):
        return F.aggregate(F.slice("lp", a, n), F.lit(0.0), lambda acc, v: acc + F.exp(v.cast("double")))

    got = fixtures.scores(spark, sf_dir).select("rec", "t", F.array(mass(1, 21), mass(22, 21), mass(43, 22)).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda acc, v: acc + v)
    got = frames.run_confidence(got.select("rec", "t", F.transform("e", lambda v: v / total).alias("p")), blank=0)
    return got.select("rec", "run_no", "id", "confidence", "confidence_peak", "start", "end", "frames")


@query(f"""WITH {SCORES}, voc(id, token) AS (VALUES (1, 'a'), (2, 'b'), (3, 'c')), early AS (SELECT * FROM symbols WHERE t < 250), s AS (SELECT *, lag(id, 1, 0) OVER (PARTITION BY rec ORDER BY t) AS before FROM early),
x AS (SELECT rec, string_agg(token, '' ORDER BY t) AS text FROM s JOIN voc USING (id) WHERE s.id <> 0 AND s.id <> before GROUP BY rec)
SELECT e.rec, count(*) >= 30 AND coalesce(any_value(contains(x.text, 'abcab') OR contains(x.text, 'cbcb')), FALSE) AS preamble FROM early e LEFT JOIN x USING (rec) GROUP BY e.rec""")
def dp19_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, token string")
    return frames.has_preamble(fixtures.symbols(spark, sf_dir), vocabulary, BLANK, ["abcab", "cbcb"])


@query(f"""WITH {SCORES} SELECT s.rec, s.t, round(CAST(g.lp[s.id + 1] AS DOUBLE), 5) AS lp FROM symbols s JOIN scores g USING (rec, t)""")
def jn1_path_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.symbols(spark, sf_dir).select("rec", "t", F.col("id").alias("state"))
    states = path.select("rec", "state").distinct().withColumn("symbol", F.col("state"))
    return frames.path_scores(fixtures.scores(spark, sf_dir), path, states).select("rec", "t", F.round(F.col("lp").cast("double"), 5).alias("lp"))


# cues


@query(f"""WITH {CUES}, w AS (SELECT *, lead(start) OVER o AS nxt, row_number() OVER o - 1 AS position FROM cues WINDOW o AS (PARTITION BY rec ORDER BY start, cue_no)),
l AS (SELECT *, greatest("end", start + 0.15) AS lifted FROM w)
SELECT rec, cue_no, CAST(position AS INT) AS position, round(start, 6) AS start, round(greatest(CASE WHEN nxt IS NULL THEN lifted ELSE least(lifted, nxt) END, start), 6) AS "end" FROM l""")
def w2_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cues.clamp(fixtures.cues(spark, sf_dir))
    return got.select("rec", "cue_no", "position", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(f"""WITH {CUES}, w AS (SELECT *, lead(start) OVER o AS nxt FROM cues WINDOW o AS (PARTITION BY rec ORDER BY start, cue_no)), l AS (SELECT *, greatest(CASE WHEN nxt IS NULL THEN greatest("end", start + 0.15) ELSE least(greatest("end", start + 0.15), nxt) END, start) AS e FROM w),
m AS (SELECT *, CAST(round_even(start * 1000, 0) AS BIGINT) AS a, CAST(round_even(e * 1000, 0) AS BIGINT) AS b, row_number() OVER (PARTITION BY rec ORDER BY start, cue_no) AS i FROM l WHERE aya <> 0)
SELECT rec, CAST(i AS INT) AS index, i || chr(10) || printf('%02d:%02d:%02d,%03d', a // 3600000, a // 60000 % 60, a // 1000 % 60, a % 1000) || ' --> ' || printf('%02d:%02d:%02d,%03d', b // 3600000, b // 60000 % 60, b // 1000 % 60, b % 1000) || chr(10) || word || CASE WHEN is_repeat THEN ' [repeat]' ELSE '' END || chr(10) AS block FROM m""")
def snk1_srt_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.srt_blocks(cues.clamp(fixtures.cues(spark, sf_dir)), keep_preamble=False)


@query(f"""WITH {CUES} SELECT rec, cue_no, CAST(round_even(start * 1000, 0) AS BIGINT) AS start_ms, CAST(round_even("end" * 1000, 0) AS BIGINT) AS end_ms, word || CASE WHEN is_repeat THEN ' [repeat]' ELSE '' END AS word FROM cues""")
def src12_srt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = cues.srt_blocks(fixtures.cues(spark, sf_dir).withColumn("position", F.col("cue_no")))
    files = blocks.groupBy("rec").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "block"))), lambda b: b["block"]), "\n").alias("value"))
    got = readers.parse_srt(files)
    return got.select("rec", F.col("cue_no").cast("long").alias("cue_no"), F.round(F.col("start") * 1000).cast("long").alias("start_ms"), F.round(F.col("end") * 1000).cast("long").alias("end_ms"), "word")


@query(f"""WITH {CUES} SELECT rec, cue_no, '{{"word":"' || word || '","avg":' || CASE WHEN aya = 3 THEN 'null' ELSE CAST(aya AS VARCHAR) || '.5' END || ',"is_repeat":' || CASE WHEN is_repeat THEN 'true' ELSE 'false' END || '}}' AS json FROM cues""")
def snk3_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fixtures.cues(spark, sf_dir).withColumn("avg", F.when(F.col("aya") == 3, F.lit(float("-inf"))).otherwise(F.col("aya") + 0.5)).withColumn("position", F.col("cue_no"))
    return cues.json_records(got, ["word", "avg", "is_repeat"]).select("rec", F.col("position").alias("cue_no"), "json")


@query(f"""WITH {CUES}, w AS (SELECT *, lead(start) OVER o AS nxt FROM cues WINDOW o AS (PARTITION BY rec ORDER BY start, cue_no)), l AS (SELECT *, greatest(CASE WHEN nxt IS NULL THEN greatest("end", start + 0.15) ELSE least(greatest("end", start + 0.15), nxt) END, start) AS e FROM w)
SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY start, cue_no) - 1 AS cue_no, CAST(round_even(start * 1000, 0) AS BIGINT) AS start_ms, CAST(round_even(e * 1000, 0) AS BIGINT) AS end_ms, word || CASE WHEN is_repeat THEN ' [repeat]' ELSE '' END AS word FROM l WHERE aya <> 0""")
def snk1_srt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a recording, written and read back."""
    where = new_folder(spark, "srt")
    writers.write_srt(cues.clamp(fixtures.cues(spark, sf_dir)), where, keep_preamble=False)
    got = readers.parse_srt(writers.read_files(spark, where, ".srt"))
    return got.select(F.col("rec").cast("long").alias("rec"), F.col("cue_no").cast("long").alias("cue_no"), F.round(F.col("start") * 1000).cast("long").alias("start_ms"), F.round(F.col("end") * 1000).cast("long").alias("end_ms"), "word")


@query(f"""WITH {CUES} SELECT rec, cue_no, word, round(start, 6) AS start, round("end", 6) AS "end", CAST(aya AS INT) AS aya, is_repeat FROM cues""")
def snk3_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a recording, written and read back."""
    where = new_folder(spark, "json")
    writers.write_json(fixtures.cues(spark, sf_dir).withColumn("position", F.col("cue_no")), where, ["word", "start", "end", "aya", "sura", "is_repeat"])
    got = readers.parse_records(writers.read_files(spark, where, ".json"))
    return got.select(F.col("rec").cast("long").alias("rec"), F.col("cue_no").cast("long").alias("cue_no"), "word", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "aya", "is_repeat")


@query(f"""WITH {CUES}, s AS (SELECT *, sum(CASE WHEN is_repeat AND NOT coalesce(p, FALSE) THEN 1 ELSE 0 END) OVER (PARTITION BY rec ORDER BY cue_no) - 1 AS site FROM (SELECT *, lag(is_repeat) OVER (PARTITION BY rec ORDER BY cue_no) AS p FROM cues))
SELECT rec, CAST(site AS BIGINT) AS site, arg_min(aya, cue_no) AS aya, string_agg(word, ' ' ORDER BY cue_no) AS phrase, count(*) AS n_words, round(arg_min(start, cue_no), 6) AS start, round(arg_max("end", cue_no) - arg_min(start, cue_no), 6) AS duration FROM s WHERE is_repeat GROUP BY rec, site""")
def w10_repeat_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cues.repeat_sites(fixtures.cues(spark, sf_dir))
    return got.select("rec", "site", "aya", "phrase", "n_words", F.round("start", 6).alias("start"), F.round("duration", 6).alias("duration"))


MAPPED = f"""{CUES}, c AS (SELECT *, sum(CASE WHEN is_repeat THEN 0 ELSE 1 END) OVER (PARTITION BY rec ORDER BY cue_no) AS cursor FROM cues),
f AS (SELECT r.rec, r.cue_no, max(k.cursor - 1) AS found FROM c r JOIN c k ON r.rec = k.rec AND r.word = k.word AND r.aya = k.aya AND NOT k.is_repeat AND k.cursor - 1 < r.cursor AND k.cursor - 1 >= r.cursor - 30 WHERE r.is_repeat GROUP BY r.rec, r.cue_no),
mapped AS (SELECT c.rec, c.cue_no, c.start, CAST(CASE WHEN is_repeat THEN coalesce(found, greatest(0, cursor - 1)) ELSE cursor - 1 END AS BIGINT) AS slot FROM c LEFT JOIN f ON c.rec = f.rec AND c.cue_no = f.cue_no)"""


@query(f"WITH {MAPPED} SELECT rec, cue_no, slot FROM mapped")
def jn7_display_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.display_mapping(fixtures.cues(spark, sf_dir)).select("rec", "cue_no", "slot")


@query(f"WITH {MAPPED} SELECT rec, slot, round(arg_min(start, cue_no), 6) AS start FROM mapped GROUP BY rec, slot")
def jn8_slot_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.slot_starts(cues.display_mapping(fixtures.cues(spark, sf_dir))).withColumn("start", F.round("start", 6))


@query(f"""WITH {CUES}, times AS (SELECT DISTINCT rec, round(start + 3, 3) AS time FROM cues), starts AS (SELECT DISTINCT rec, start AS s FROM cues),
h AS (SELECT t.rec, t.time, s FROM times t ASOF LEFT JOIN starts ON t.rec = starts.rec AND t.time >= starts.s)
SELECT h.rec, h.time, coalesce(max(c.cue_no) FILTER (h.time < c."end"), -1) AS cue_no FROM h LEFT JOIN cues c ON c.rec = h.rec AND c.start = h.s GROUP BY h.rec, h.time""")
def jn6_words_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.cues(spark, sf_dir)
    return cues.words_at(own, own.select("rec", F.round(F.col("start") + 3, 3).alias("time")).distinct())


@query(f"""WITH {CUES}, s AS (SELECT *, sum(CASE WHEN is_repeat AND NOT coalesce(p, FALSE) THEN 1 ELSE 0 END) OVER (PARTITION BY rec ORDER BY cue_no) - 1 AS site FROM (SELECT *, lag(is_repeat) OVER (PARTITION BY rec ORDER BY cue_no) AS p FROM cues)),
sites AS (SELECT rec, site, arg_min(start, cue_no) AS start FROM s WHERE is_repeat GROUP BY rec, site), times AS (SELECT rec, start AS time FROM cues)
SELECT t.rec, round(t.time, 6) AS time, round(greatest(0, coalesce(min(s.start) FILTER (s.start > t.time + 0.5), min(s.start)) - 5), 6) AS next_seek, round(greatest(0, coalesce(max(s.start) FILTER (s.start < t.time - 1), max(s.start)) - 5), 6) AS prev_seek
FROM times t JOIN sites s USING (rec) GROUP BY t.rec, t.time""")
def jn9_repeat_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.cues(spark, sf_dir)
    got = cues.repeat_jumps(cues.repeat_sites(own), own.select("rec", F.col("start").alias("time")))
    got = got.filter("next_seek IS NOT NULL").distinct()
    return got.select("rec", *[F.round(c, 6).alias(c) for c in ("time", "next_seek", "prev_seek")])


@query(f"""WITH {CUES}, e AS (SELECT *, lag("end") OVER (PARTITION BY rec ORDER BY cue_no) AS p FROM cues)
SELECT rec, count(*) AS n_cues, count(*) FILTER (NOT is_repeat) AS n_unique, count(*) FILTER (p > start) AS n_violations FROM e GROUP BY rec""")
def agg15_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.monotone_violations(fixtures.cues(spark, sf_dir))


@query(f"""WITH {CUES}, n AS (SELECT *, CAST(floor(start) AS BIGINT) % 40 AS start_frame, CAST(floor(start) AS BIGINT) % 40 + CAST(floor(value) AS BIGINT) AS end_frame FROM cues), d AS (SELECT *, end_frame - start_frame AS duration FROM n),
m AS (SELECT rec, median(duration) AS median FROM d GROUP BY rec)
SELECT d.rec, d.cue_no, d.duration, m.median, m.median > 0 AND (d.duration < 0.15 * m.median OR d.duration > 3.0 * CASE WHEN aya = 6 THEN 1.5 ELSE 1.0 END * m.median) AS is_anomalous FROM d JOIN m USING (rec)""")
def prj12_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.floor("start") % 40
    own = fixtures.cues(spark, sf_dir).select("rec", "cue_no", start.alias("start_frame"), (start + F.floor("value")).alias("end_frame"), (F.col("aya") == 6).alias("is_ayah_final"))
    return cues.flag_anomalies(own).select("rec", "cue_no", "duration", "median", "is_anomalous")


@query("""WITH c AS (SELECT l_suppkey AS rec, l_orderkey, l_linenumber, l_partkey, -l_quantity AS avg_logprob, l_tax * 20 AS m, l_returnflag = 'R' AS spliced FROM lineitem),
b AS (SELECT rec, median(avg_logprob) AS base FROM c WHERE NOT spliced GROUP BY rec)
SELECT c.rec, count(*) AS n, count(*) FILTER (avg_logprob < coalesce(base, 0) - 1 OR m < 0.5) AS n_low FROM c LEFT JOIN b USING (rec) GROUP BY c.rec""")
def agg8_low_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("rec"), (-F.col("l_quantity")).alias("avg_logprob"), (F.col("l_tax") * 20).alias("min_decision_margin"), (F.col("l_returnflag") == "R").alias("spliced")
    )
    got = cues.flag_low_confidence(own, spliced=F.col("spliced"))
    return got.groupBy("rec").agg(F.count("*").alias("n"), F.count_if(F.col("low_confidence")).alias("n_low"))


@query(f"""WITH {ENERGIES}, w AS (SELECT rec, t // 5 AS cue_no, min(t) AS start_frame, max(t) AS end_frame FROM energies GROUP BY rec, t // 5)
SELECT w.rec, w.cue_no, round(avg(e.energy), 6) AS avg_logprob, min(e.energy) AS min_decision_margin FROM w JOIN energies e ON e.rec = w.rec AND e.t BETWEEN w.start_frame AND w.end_frame GROUP BY w.rec, w.cue_no""")
def agg4_span_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.energies(spark, sf_dir)
    words = own.groupBy("rec", F.floor(F.col("t") / 5).alias("cue_no")).agg(F.min("t").alias("start_frame"), F.max("t").alias("end_frame"))
    got = cues.span_scores(words, own.select("rec", "t", F.col("energy").alias("lp"), F.col("energy").alias("margin")))
    return got.select("rec", "cue_no", F.round("avg_logprob", 6).alias("avg_logprob"), "min_decision_margin")


@query(f"""WITH {ENERGIES}, w AS (SELECT rec, t // 7 AS cue_no, greatest(0, min(t) - 2) AS start_frame, max(t) AS end_frame FROM energies GROUP BY rec, t // 7)
SELECT w.rec, w.cue_no, round(avg(e.energy), 6) AS avg_logprob, min(e.energy) AS min_decision_margin FROM w JOIN energies e ON e.rec = w.rec AND e.t BETWEEN w.start_frame AND w.end_frame GROUP BY w.rec, w.cue_no""")
def agg5_overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.energies(spark, sf_dir)
    words = own.groupBy("rec", F.floor(F.col("t") / 7).alias("cue_no")).agg(F.greatest(F.lit(0), F.min("t") - 2).alias("start_frame"), F.max("t").alias("end_frame"))
    got = cues.span_margins(cues.span_means(words, own.withColumnRenamed("energy", "lp")), own.withColumnRenamed("energy", "margin"))
    return got.select("rec", "cue_no", F.round("avg_logprob", 6).alias("avg_logprob"), "min_decision_margin")


@query(f"""WITH {CUES}, i AS (SELECT *, sum(CASE WHEN aya // 3 = p THEN 0 ELSE 1 END) OVER (PARTITION BY rec ORDER BY cue_no) AS island FROM (SELECT *, lag(aya // 3) OVER (PARTITION BY rec ORDER BY cue_no) AS p FROM cues))
SELECT rec, cue_no, CAST(row_number() OVER (PARTITION BY rec, island ORDER BY cue_no) AS INT) AS words_back FROM i""")
def w12_words_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.cues(spark, sf_dir).withColumn("aya", F.floor(F.col("aya") / 3))
    return cues.words_back_in_verse(own).select("rec", "cue_no", "words_back")


@query(f"""WITH {CUES} SELECT rec, cue_no, lead(cue_no) OVER (PARTITION BY rec, sura, aya ORDER BY cue_no) IS NULL AS is_ayah_final FROM cues""")
def w18_ayah_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.cues(spark, sf_dir).withColumnRenamed("cue_no", "word_no")
    return cues.ayah_final(own).select("rec", F.col("word_no").alias("cue_no"), "is_ayah_final")


@query("""WITH s AS (SELECT o_orderkey AS rec, 0 AS word_no, 0 AS a, length(o_orderpriority) // 2 AS b FROM orders UNION ALL SELECT o_orderkey, 1, length(o_orderpriority) // 2 + 1, length(o_orderpriority) FROM orders),
p AS (SELECT o_orderkey AS rec, unnest(range(0, length(o_orderpriority))) AS pos FROM orders)
SELECT p.rec, CAST(p.pos AS INT) AS pos, s.word_no FROM p LEFT JOIN s ON s.rec = p.rec AND s.a <= p.pos AND p.pos < s.b""")
def jn4_assign_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("o_orderpriority")
    half = F.floor(n / 2).cast("int")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rec"), n.alias("n"), half.alias("half"))
    spans = orders.select("rec", F.explode(F.array(F.struct(F.lit(0).alias("word_no"), F.lit(0).alias("span_start"), F.col("half").alias("span_end")), F.struct(F.lit(1).alias("word_no"), (F.col("half") + 1).alias("span_start"), F.col("n").alias("span_end")))).alias("s")).select("rec", "s.*")
    return cues.assign_words(spans, orders.select("rec", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos")))


# signals


@query(f"""WITH {ENERGIES}, l AS (SELECT rec, quantile_cont(energy, 0.3) AS q FROM energies GROUP BY rec), s AS (SELECT e.*, t - row_number() OVER (PARTITION BY e.rec ORDER BY t) AS island FROM energies e JOIN l USING (rec) WHERE energy <= q),
r AS (SELECT rec, min(t) AS i, max(t) + 1 AS j FROM s GROUP BY rec, island)
SELECT rec, (i + j) // 2 * 160 + 200 AS midpoint_sample, j - i AS frames FROM r WHERE j - i >= 3""")
def w6_silence_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.silence_runs(fixtures.energies(spark, sf_dir), percentile=0.3, least=3)


@query(f"""WITH {ENERGIES}, w AS (SELECT rec, t, avg(energy * energy) OVER o AS m, row_number() OVER (PARTITION BY rec ORDER BY t) AS n FROM energies WINDOW o AS (PARTITION BY rec ORDER BY t ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
SELECT rec, t, round(sqrt(greatest(0, m) + 1e-12), 6) AS energy FROM w WHERE n >= 8""")
def w7_moving_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.moving_rms(fixtures.energies(spark, sf_dir), "energy", 8).withColumn("energy", F.round("energy", 6))


@query(f"""WITH {ENERGIES}, n AS (SELECT rec, (count(*) - 1) * 160 + 400 AS n_samples FROM energies GROUP BY rec), k AS (SELECT *, CAST(round_even(n_samples / 16000.0 / 0.5, 0) AS INT) AS n FROM n WHERE n_samples / 16000.0 > 0.6),
g AS (SELECT rec, n_samples, unnest(range(1, n)) AS target_no FROM k), w AS (SELECT *, greatest(0, target_no * 8000 - 2000) // 160 AS a, least(n_samples - 400, target_no * 8000 + 2000) // 160 AS b FROM g),
m AS (SELECT w.rec, target_no, e.t, row_number() OVER (PARTITION BY w.rec, target_no ORDER BY e.energy, e.t) AS k FROM w JOIN energies e ON e.rec = w.rec AND e.t >= w.a AND e.t < w.b)
SELECT rec, CAST(target_no AS INT) AS target_no, t * 160 + 200 AS sample FROM m WHERE k = 1""")
def w8_balanced_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.energies(spark, sf_dir)
    lengths = own.groupBy("rec").agg(((F.count("*") - 1) * 160 + 400).alias("n_samples"))
    return signal.balanced_splits(own, lengths, target_sec=0.5)


@query("""WITH b AS (SELECT user_id AS rec, value * value / 1e4 AS energy FROM events), l AS (SELECT *, -0.691 + 10 * log10(greatest(energy, 1e-12)) AS l FROM b),
g AS (SELECT rec, -0.691 + 10 * log10(greatest(avg(energy), 1e-12)) AS gamma FROM l WHERE l > -70 GROUP BY rec)
SELECT l.rec, round(-0.691 + 10 * log10(greatest(avg(energy), 1e-12)), 6) AS lufs FROM l JOIN g USING (rec) WHERE l > -70 AND l > gamma - 10 GROUP BY l.rec""")
def w14_gated_loudness(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "events").select(F.col("user_id").alias("rec"), (F.col("value") * F.col("value") / 1e4).alias("energy"))
    return signal.gated_loudness(blocks).withColumn("lufs", F.round("lufs", 6))


@query("""WITH x AS (SELECT vec_id AS rec, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT rec, round(20 * log10(greatest(sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v)), 1e-6)) - 0.691, 6) AS lufs, round(20 * log10(greatest(list_max(list_transform(v, lambda x: abs(x))), 1e-6)), 6) AS peak_db FROM x""")
def ln_plain_loudness(spark: SparkSession, sf_dir: str) -> DataFrame:
    pcm = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rec"), F.col("embedding").alias("pcm"))
    return signal.plain_loudness(pcm).select("rec", F.round("lufs", 6).alias("lufs"), F.round("peak_db", 6).alias("peak_db"))


@query(f"""WITH RECURSIVE {ENERGIES}, l AS (SELECT rec, quantile_cont(energy, 0.3) AS q FROM energies GROUP BY rec), s AS (SELECT e.*, t - row_number() OVER (PARTITION BY e.rec ORDER BY t) AS island FROM energies e JOIN l USING (rec) WHERE energy <= q),
r AS (SELECT rec, min(t) AS i, max(t) + 1 AS j FROM s GROUP BY rec, island), runs AS (SELECT rec, (i + j) // 2 * 160 + 200 AS p, j - i AS frames FROM r WHERE j - i >= 2),
g AS (SELECT rec, list(p ORDER BY frames DESC, p) AS ps FROM runs GROUP BY rec),
c(rec, ps, chosen) AS (SELECT rec, ps, CAST([] AS BIGINT[]) FROM g WHERE len(ps) > 5 UNION ALL
  SELECT rec, list_filter(ps[2:], lambda x: abs(x - ps[1]) >= 1600), list_append(chosen, ps[1]) FROM c WHERE len(ps) > 0 AND len(chosen) < 5)
SELECT rec, unnest(ps) AS midpoint_sample FROM g WHERE len(ps) <= 5 UNION ALL SELECT rec, unnest(chosen) FROM c WHERE len(chosen) = 5 OR len(ps) = 0""")
def w9_spaced_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = signal.silence_runs(fixtures.energies(spark, sf_dir), percentile=0.3, least=2)
    return signal.spaced_runs(runs, most=5, gap=1600)


# catalog, resume, reports


@query("""WITH c AS (SELECT n_regionkey, n_nationkey, CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE 'http://x/' || n_name END AS url FROM nation)
SELECT CAST(n_regionkey AS VARCHAR) AS slug, n_nationkey AS surah, url FROM c WHERE url IS NOT NULL""")
def prj4_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    url = F.when(F.col("n_nationkey") % 4 != 3, F.concat(F.lit("http://x/"), "n_name"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), F.struct(url.alias("mp3_url")))))
    rows = nation.groupBy(F.col("n_regionkey").cast("string").alias("slug")).agg(F.first("n_name").alias("name"), entries.alias("surahs"))
    return catalog.explode_catalog(rows).select("slug", "surah", "url")


@query("SELECT s_suppkey AS idx, CAST(s_suppkey AS VARCHAR) AS slug, s_name AS name FROM supplier WHERE s_suppkey IN (2, 5) OR CAST(s_suppkey AS VARCHAR) = '7' OR lower(s_name) = 'supplier#000000003'")
def prj3_choose(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("idx"), F.col("s_suppkey").cast("string").alias("slug"), F.col("s_name").alias("name"))
    return catalog.choose(rows, indexes=[2, 5], slugs=["7", " Supplier#000000003 "])


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def jn10_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return catalog.remaining(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def jn11_downloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return catalog.downloaded(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), files, ["c_custkey"])


@query("""SELECT l_suppkey AS slug, l_partkey AS surah FROM lineitem WHERE (l_returnflag = 'A' AND l_quantity > 10) OR (l_returnflag = 'N' AND l_quantity > 20) GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) = 2""")
def prj14_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("slug"), F.col("l_partkey").alias("surah"), F.col("l_returnflag").alias("kind"), F.col("l_quantity").alias("length"))
    return catalog.finished(files, {"A": 10, "N": 20})


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_items FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 4")
def agg14_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.complete(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", 4)


@query("""WITH m AS (SELECT o_orderpriority AS reciter, o_orderstatus <> 'P' AS ok, round(o_totalprice) AS audio, o_custkey AS wall, o_orderkey % 9 AS w, o_orderkey % 3 AS r FROM orders),
s AS (SELECT reciter, grouping(reciter) AS is_total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, sum(audio) AS audio_sec, sum(wall) AS wall_sec, sum(w) AS n_words, sum(r) AS n_repeats FROM m GROUP BY ROLLUP (reciter))
SELECT reciter, CAST(is_total AS INT) AS is_total, succeeded, failed, CAST(audio_sec AS BIGINT) AS audio_sec, CAST(wall_sec AS BIGINT) AS wall_sec, CAST(n_words AS BIGINT) AS n_words, CAST(n_repeats AS BIGINT) AS n_repeats, round(wall_sec / audio_sec, 6) AS rtf, round(audio_sec / wall_sec, 6) AS speedup FROM s""")
def agg9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("reciter"), (F.col("o_orderstatus") != "P").alias("ok"), F.round("o_totalprice").cast("long").alias("audio"), F.col("o_custkey").alias("wall"), (F.col("o_orderkey") % 9).alias("n_words"), (F.col("o_orderkey") % 3).alias("n_repeats")
    )
    return catalog.report(metrics, "reciter").withColumns({"rtf": F.round("rtf", 6), "speedup": F.round("speedup", 6)})


@query(f"""WITH {CUES}, n AS (SELECT rec, count(*) AS n_words, count(*) FILTER (is_repeat) AS n_repeats, max("end") AS audio FROM cues GROUP BY rec)
SELECT rec, n_words, n_repeats, round(10.0 / greatest(audio, 0.001), 8) AS rtf FROM n""")
def agg10_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.cues(spark, sf_dir)
    runs = own.groupBy("rec").agg(F.max("end").alias("audio")).withColumn("wall", F.lit(10.0))
    return catalog.run_metrics(own, runs).select("rec", "n_words", "n_repeats", F.round("rtf", 8).alias("rtf"))


@query("""WITH e AS (SELECT p_brand AS source, levenshtein(p_name, p_type) AS e, length(p_type) AS n FROM part)
SELECT source, CAST(grouping(source) AS INT) AS is_total, count(*) AS n, CAST(sum(e) AS BIGINT) AS errors, CAST(sum(n) AS BIGINT) AS length, round(avg(CASE WHEN e = 0 THEN 1.0 ELSE 0.0 END), 6) AS exact, round(sum(e) / sum(n), 6) AS rate FROM e GROUP BY ROLLUP (source)""")
def agg12_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), F.col("p_name").alias("hypothesis"), F.col("p_type").alias("reference"))
    return catalog.error_rate(rows, "source").withColumns({"exact": F.round("exact", 6), "rate": F.round("rate", 6)})


@query("""SELECT p_partkey AS surah, CASE WHEN p_partkey % 6 = 0 THEN 'd/' || pad || '.mp3' WHEN p_partkey % 3 = 0 THEN 'd/' || pad || '.opus' WHEN p_partkey % 5 = 0 THEN 'd/' || p_partkey || '.wav' WHEN p_partkey % 7 = 1 THEN 'd/' || pad || '_x.mp3' END AS path
FROM (SELECT p_partkey, printf('%03d', p_partkey) AS pad FROM part)""")
def src4_find_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("surah"))
    padded = F.format_string("%03d", "surah")
    names = F.array(
        F.when(F.col("surah") % 3 == 0, F.concat(padded, F.lit(".opus"))), F.when(F.col("surah") % 6 == 0, F.concat(padded, F.lit(".mp3"))),
        F.when(F.col("surah") % 5 == 0, F.concat(F.col("surah").cast("string"), F.lit(".wav"))), F.when(F.col("surah") % 7 == 1, F.concat(padded, F.lit("_x.mp3"))),
    )
    files = part.select(F.explode(F.array_compact(names)).alias("file")).select("file", F.concat(F.lit("d/"), "file").alias("path"))
    return catalog.find_files(files, part).select(F.col("surah").cast("long").alias("surah"), "path")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_tax, l_discount) - 1) // 4 AS INT) AS chunk_no FROM lineitem")
def st6_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax", "l_discount"]
    return catalog.chunked(table(spark, sf_dir, "lineitem"), 4, order, ["l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "chunk_no")


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 5 AS done, c_custkey % 3 AS ok, c_custkey % 4 AS failed, c_custkey % 6 AS files FROM customer)
SELECT k, CASE WHEN done >= 4 THEN 'already_completed' WHEN files = 0 THEN 'failed_download' WHEN failed = 0 THEN 'ok' WHEN ok > 0 THEN 'partial' ELSE 'failed' END AS status FROM c""")
def bs_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("k"), catalog.status(F.lit(4), k % 5, k % 3, k % 4, k % 6).alias("status"))


# scalar and array functions


@query("""SELECT o_orderkey, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS srt,
  CASE WHEN s // 3600 > 0 THEN printf('%dh %02dm %02ds', s // 3600, s // 60 % 60, s % 60) ELSE printf('%02dm %02ds', s // 60 % 60, s % 60) END AS clock, printf('%d:%02d', s // 60, s % 60) AS minutes,
  translate(CAST(o_custkey AS VARCHAR), '0123456789', '٠١٢٣٤٥٦٧٨٩') AS digits FROM (SELECT *, CAST(round_even(o_totalprice / 16 * 1000, 0) AS BIGINT) AS ms, CAST(floor(o_totalprice / 16) AS BIGINT) AS s FROM orders)""")
def sf_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_totalprice") / 16
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.srt_time(s).alias("srt"), scalars.clock(s).alias("clock"), scalars.minutes(s).alias("minutes"), scalars.arabic_digits(F.col("o_custkey")).alias("digits"))


@query("""SELECT o_orderkey, array_to_string(CASE WHEN o_orderkey % 2 = 0 THEN range(CAST(o_orderkey % 5 AS BIGINT), CAST(o_orderkey % 5 + 4 AS BIGINT)) ELSE [o_orderkey % 5, o_orderkey % 7] END, ',') AS items FROM orders""")
def prj1_number_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    ranged = F.concat((k % 5).cast("string"), F.lit("-"), (k % 5 + 3).cast("string"))
    listed = F.concat(F.lit(" "), (k % 5).cast("string"), F.lit(", "), (k % 7).cast("string"), F.lit(" ,"))
    got = scalars.number_list(F.when(k % 2 == 0, ranged).otherwise(listed))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(got.cast("array<string>"), ",").alias("items"))


@query("""SELECT page_id, sha256(url || '_' || CAST(length(html) AS VARCHAR) || '_' || CAST(page_id AS VARCHAR)) AS key FROM pages""")
def src5_cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", scalars.cache_key(F.col("url"), F.length("html"), F.col("page_id")).alias("key"))


@query("""WITH s AS (SELECT p_partkey, [p_size, p_size % 3, p_size % 3 + 1] AS ids FROM part), x AS (SELECT p_partkey, [0, ids[1], 0, ids[2], 0, ids[3], 0] AS states FROM s)
SELECT p_partkey, array_to_string(states, ',') AS states, array_to_string([FALSE, FALSE, FALSE, states[4] <> states[2], FALSE, states[6] <> states[4], FALSE], ',') AS skip FROM x""")
def dp1_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    got = table(spark, sf_dir, "part").select("p_partkey", arrays.interleave(F.array(s, s % 3, s % 3 + 1), 0).alias("path"))
    return got.select("p_partkey", F.array_join(F.col("path").cast("array<string>"), ",").alias("states"), F.array_join(arrays.skip_mask(F.col("path")).cast("array<string>"), ",").alias("skip"))


@query("""SELECT p_partkey, round(1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type)), 6) AS ratio FROM part""")
def dp12_edit_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.round(arrays.edit_ratio(F.col("p_name"), F.col("p_type")), 6).alias("ratio"))


#: Tokens of order priorities, the longer of two that begin alike first where that matters to a pattern.
PRIORITY_TOKENS = {t: k for k, t in enumerate(["medium", "high", "urgent", "not", "specified", "low", "-", " ", "1", "2", "3", "4", "5"])}


@query("""WITH o AS (SELECT o_orderkey, regexp_extract_all(lower(o_orderpriority), 'medium|high|urgent|not|specified|low|-| |1|2|3|4|5') AS ts FROM orders)
SELECT o_orderkey, CAST(i - 1 AS INT) AS pos, CAST(coalesce(list_sum(list_transform(ts[1:i - 1], lambda t: length(t))), 0) AS INT) AS start, ts[i] AS token FROM o, unnest(range(1, len(ts) + 1)) AS g(i)""")
def dp16_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.lower("o_orderpriority").alias("text"))
    return tokens.tokenize(texts, PRIORITY_TOKENS).select("o_orderkey", "pos", "start", "token")


@query("""WITH a AS (SELECT o_orderkey, [CAST(o_orderkey % 3 AS VARCHAR), CAST(o_orderkey % 5 AS VARCHAR), 'x'] AS j, [CAST(o_orderkey % 3 AS VARCHAR), 'x'] AS i FROM orders)
SELECT o_orderkey, CASE WHEN j[2] <> j[1] THEN j[2] END AS extra FROM a""")
def so2_joint_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (F.col("o_orderkey") % 3).cast("string"), (F.col("o_orderkey") % 5).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(arrays.joint_only(F.array(a, b, F.lit("x")), F.array(a, F.lit("x"))), ",").alias("extra"))


@query("""WITH c AS (SELECT o_orderkey, o_orderkey % 3 AS a FROM orders)
SELECT o_orderkey, CAST(i AS INT) AS i, CASE WHEN i = 0 THEN 0 WHEN i = a AND a > 0 THEN 2 END AS start, CASE WHEN i = 0 AND a = 0 THEN 3 WHEN i = 0 THEN 1 WHEN i = a THEN 3 END AS "end",
  CASE WHEN i = 0 AND a = 0 THEN 'pq' WHEN i = 0 THEN 'p' WHEN i = a THEN 'q' ELSE '' END AS phonemes FROM c, (SELECT unnest(range(0, 3)) AS i)""")
def cells_letter_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    def cell(char, phoneme: str, start: int, end: int):
        return F.struct(char.alias("char"), F.lit(phoneme).alias("phoneme"), F.lit(start).alias("start"), F.lit(end).alias("end"))

    cells = F.array(cell(F.lit(0).cast("long"), "p", 0, 1), cell(F.col("o_orderkey") % 3, "q", 2, 3))
    tier = arrays.letter_cells(F.array(F.lit("a"), F.lit("b"), F.lit("c")), cells)
    got = table(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(tier).alias("i", "x"))
    return got.select("o_orderkey", "i", "x.start", "x.end", F.array_join(F.transform("x.phonemes", lambda p: p["phoneme"]), "").alias("phonemes"))


@query("""SELECT conv_id, turn, trim(text) AS word, turn * 2e0 AS start, turn * 2e0 + 0.5 AS "end" FROM conversations WHERE length(trim(text)) > 0""")
def prj9_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("rec"), F.col("turn").alias("cue_no"), "text", (F.col("turn") * 2.0).alias("start_sec"))
    return readers.normalize_records(rows).select(F.col("rec").alias("conv_id"), F.col("cue_no").alias("turn"), "word", "start", "end")


@query("""SELECT DISTINCT event_type AS token, CAST(length(event_type) AS INT) AS id FROM events""")
def src1_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit(" "), F.length("event_type").cast("string")).alias("value"))
    return readers.parse_vocabulary(lines.unionByName(lines.select(F.lit("  ").alias("value")))).distinct()


# smaller ones


@query("""SELECT o_orderkey, ['auto', 'yes', 'no', 'no', 'auto'][o_orderkey % 5 + 1] AS preamble, CASE WHEN o_orderkey % 4 = 3 THEN 'srt' WHEN o_orderkey % 3 = 0 THEN 'json' WHEN o_orderkey % 3 = 1 THEN 'srt' ELSE 'both' END AS format FROM orders""")
def prj5_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    choice = F.get(F.lit(["auto", " YES", "0", "n", "Default"]), (k % 5).cast("int"))
    path = F.get(F.lit(["a/x.JSON", "b.srt", "c.txt"]), (k % 3).cast("int"))
    fmt = scalars.output_format(F.when(k % 4 == 3, "srt").otherwise("auto"), path)
    return table(spark, sf_dir, "orders").select(k, scalars.preamble_choice(choice).alias("preamble"), fmt.alias("format"))


@query(f"""WITH {CUES}, w AS (SELECT *, lead(start) OVER (PARTITION BY rec ORDER BY start, cue_no) AS nxt FROM cues)
SELECT rec, cue_no, round(greatest(CASE WHEN nxt IS NULL THEN greatest("end", start + 0.15) ELSE least(greatest("end", start + 0.15), nxt) END, start), 6) AS "end" FROM w WHERE aya <> 0""")
def prj6_strip_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.strip_preamble(cues.clamp(fixtures.cues(spark, sf_dir))).select("rec", "cue_no", F.round("end", 6).alias("end"))


SLOTS = "slots AS (SELECT o_custkey AS rec, o_orderkey AS word_no, o_orderkey % 3 AS aya, 2 * o_orderkey AS p FROM orders)"


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("rec"), k.alias("word_no"), (k % 3).alias("aya"), F.array(2 * k, 2 * k + 1).alias("token_positions"))


@query(f"WITH {SLOTS} SELECT rec, word_no, p - min(p) OVER (PARTITION BY rec) AS first FROM slots WHERE aya <> 0")
def prj7_reference_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.reference_without_preamble(_slots(spark, sf_dir)).select("rec", "word_no", F.get("token_positions", 0).alias("first"))


@query(f"WITH {SLOTS} SELECT rec, word_no FROM slots WHERE p + 1 < least(4000, greatest(10, rec * 30 // 6))")
def prj8_whole_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = _slots(spark, sf_dir)
    frames_ = slots.select("rec").distinct().select("rec", (F.col("rec") * 30).alias("n_frames"), F.lit(4000).alias("n_tokens"))
    return cues.whole_words(slots, frames_).select("rec", "word_no")


@query("""WITH t AS (SELECT o_orderkey, o_custkey % 50 AS target FROM orders), e AS (SELECT t.*, b.i, b.e, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(b.e - target), b.i) AS k FROM t, (VALUES (1, 7), (2, 20), (3, 22), (4, 40)) b(i, e))
SELECT o_orderkey, target, e AS boundary FROM e WHERE k = 1""")
def jn12_nearest_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("target"), F.lit([7, 20, 22, 40]).alias("ends"))
    return cues.nearest_boundary(rows).select("o_orderkey", "target", "boundary")


@query("""SELECT p_brand, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM nation WHERE 'NATION_' || (p_partkey % 40) = n_name)) AS misses FROM part GROUP BY p_brand""")
def jn13_lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_brand", F.concat(F.lit(" NATION_"), F.col("p_partkey") % 40, F.lit("  ")).alias("raw"))
    rows = rows.select("p_brand", scalars.normalize_text(F.col("raw")).alias("n_name"))
    return cues.lookup_misses(rows, table(spark, sf_dir, "nation"), "n_name", "p_brand")


@query("""WITH c AS (SELECT n_regionkey AS slug, n_nationkey AS surah FROM nation) SELECT slug, surah, r_name FROM c JOIN region ON slug = r_regionkey WHERE surah IN (1, 2, 3, 7, 11)""")
def jn14_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = nation.groupBy(F.col("n_regionkey").alias("slug")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name"))).alias("surahs")).withColumn("name", F.lit("x"))
    wanted = spark.range(1).select(F.explode(scalars.number_list(F.lit("1,2, 3,7,11"))).alias("surah"))
    got = catalog.downloaded(catalog.explode_catalog(rows), wanted, ["surah"])
    return got.join(table(spark, sf_dir, "region"), F.col("slug") == F.col("r_regionkey")).select("slug", "surah", "r_name")


@query(f"""WITH {SCORES}, s AS (SELECT *, CASE WHEN id <> lag(id) OVER (PARTITION BY rec ORDER BY t) OR t = 0 THEN 1 ELSE 0 END AS new FROM symbols), r AS (SELECT *, sum(new) OVER (PARTITION BY rec ORDER BY t) - 1 AS run_no FROM s),
g AS (SELECT rec, CAST(run_no AS BIGINT) AS run_no, count(*) AS frames FROM r GROUP BY rec, run_no), k AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY frames DESC, run_no) AS rank FROM g)
SELECT rec, run_no, frames, CAST(rank AS INT) AS rank FROM k WHERE rank <= 3""")
def st4_longest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.longest_runs(frames.runs(fixtures.symbols(spark, sf_dir)), 3).select("rec", "run_no", "frames", "rank")


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 5")
def st5_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey").limit(5)


@query(f"""WITH {CUES}, c AS (SELECT rec, cue_no, cue_no * 10 AS start_frame, cue_no * 10 + 8 AS end_frame, FALSE AS is_repeat FROM cues),
b AS (SELECT * FROM c WHERE cue_no % 4 <> 1 UNION ALL SELECT rec, cue_no, start_frame, start_frame + 3, FALSE FROM c WHERE cue_no % 4 = 1 UNION ALL SELECT rec, cue_no, start_frame + 5, start_frame + 8, TRUE FROM c WHERE cue_no % 4 = 1)
SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY start_frame, end_frame, cue_no) - 1 AS cue_no, start_frame, end_frame, is_repeat FROM b""")
def so1_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("cue_no")
    own = fixtures.cues(spark, sf_dir).select("rec", "cue_no", (k * 10).alias("start_frame"), (k * 10 + 8).alias("end_frame"), F.lit(False).alias("is_repeat"))
    odd = own.filter(k % 4 == 1)
    first = odd.withColumn("end_frame", F.col("start_frame") + 3).withColumn("replaces", k)
    second = odd.withColumn("start_frame", F.col("start_frame") + 5).withColumn("is_repeat", F.lit(True)).withColumn("replaces", k)
    return cues.splice(own, first.unionByName(second)).withColumn("cue_no", F.col("cue_no").cast("long"))


@query("""SELECT DISTINCT user_id AS rec, event_id % 90 // 4 AS frame FROM events WHERE event_id % 90 // 4 > 0 AND event_id % 90 // 4 < 20""")
def so3_output_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("rec"), (F.col("event_id") % 90).alias("feature_frame"))
    return cues.output_frames(rows, rows.select("rec").distinct().withColumn("n_frames", F.lit(20)))


@query("""SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations""")
def sf_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", scalars.normalize_text(F.col("text")).alias("text"))


@query("""WITH c AS (SELECT o_custkey, o_totalprice, o_orderstatus, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 8 AS batch FROM orders)
SELECT o_custkey, CAST(batch AS INT) AS batch, count(*) FILTER (o_orderstatus <> 'P') AS succeeded, CAST(sum(round(o_totalprice)) AS BIGINT) AS wall FROM c GROUP BY o_custkey, batch""")
def agg11_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.chunked(table(spark, sf_dir, "orders"), 8, ["o_orderkey"], ["o_custkey"])
    return rows.groupBy("o_custkey", F.col("chunk_no").alias("batch")).agg(F.count_if(F.col("o_orderstatus") != "P").alias("succeeded"), F.sum(F.round("o_totalprice")).cast("long").alias("wall"))


@query("""SELECT o_orderkey, round(o_custkey / 1500e0 * 100, 6) AS "left", round(greatest(0.3, (o_orderkey % 20) / 1500e0 * 100), 6) AS width FROM orders""")
def ux_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scalars.timeline(F.col("o_custkey"), F.col("o_orderkey") % 20, F.lit(1500.0))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(place["left"], 6).alias("left"), F.round(place["width"], 6).alias("width"))


# kernels: those without SQL are compared with brute force in the tests


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda k: (k * 7 + F.col("rec")) % 60 + 1)
    return fixtures.scores(spark, sf_dir).select("rec").distinct().select("rec", ids.alias("ids"))


#: The best path as SQL: rows of scores forward (r, by state from 1), then the states backward (i), by recursion.
BEST_PATH = f"""{SCORES}, refs AS (SELECT rec, list_transform(range(0, 17), lambda s: CASE WHEN s % 2 = 0 THEN 0 ELSE ((s // 2 + 1) * 7 + rec) % 60 + 1 END) AS st FROM (SELECT DISTINCT rec FROM scores)),
f(rec, t, r) AS (SELECT rec, t, list_transform(range(1, 18), lambda s: CASE WHEN s <= 2 THEN CAST(lp[st[s] + 1] AS DOUBLE) ELSE CAST('-Infinity' AS DOUBLE) END) FROM scores JOIN refs USING (rec) WHERE t = 0
  UNION ALL SELECT f.rec, s.t, list_transform(range(1, 18), lambda i: greatest(f.r[i], CASE WHEN i > 1 THEN f.r[i - 1] ELSE CAST('-Infinity' AS DOUBLE) END, CASE WHEN i % 2 = 0 AND i > 2 THEN f.r[i - 2] ELSE CAST('-Infinity' AS DOUBLE) END) + CAST(s.lp[st[i] + 1] AS DOUBLE))
  FROM f JOIN scores s ON s.rec = f.rec AND s.t = f.t + 1 JOIN refs ON refs.rec = f.rec),
m AS (SELECT rec, t + 1 AS t, i, [r[i], CASE WHEN i > 1 THEN r[i - 1] ELSE CAST('-Infinity' AS DOUBLE) END, CASE WHEN i % 2 = 0 AND i > 2 THEN r[i - 2] ELSE CAST('-Infinity' AS DOUBLE) END] AS moves FROM f, (SELECT unnest(range(1, 18)) AS i)),
e AS (SELECT rec, max(t) AS t, arg_max(CASE WHEN r[16] > r[17] THEN 16 ELSE 17 END, t) AS i FROM f GROUP BY rec),
g(rec, t, i) AS (SELECT rec, t, CAST(i AS BIGINT) FROM e UNION ALL SELECT g.rec, g.t - 1, g.i - (list_position(moves, list_max(moves)) - 1) FROM g JOIN m ON m.rec = g.rec AND m.t = g.t AND m.i = g.i WHERE g.t > 0),
path AS (SELECT g.rec, g.t, g.i - 1 AS state, CASE WHEN isfinite(list_sort(moves, 'DESC')[2]) THEN list_max(moves) - list_sort(moves, 'DESC')[2] END AS margin FROM g LEFT JOIN m ON m.rec = g.rec AND m.t = g.t AND m.i = g.i)"""
PATH_SQL = f"WITH RECURSIVE {BEST_PATH} SELECT rec, t, state, round(margin, 6) AS margin, CAST(NULL AS VARCHAR) AS error FROM path"


def _best_path(spark: SparkSession, sf_dir: str, engine: str) -> DataFrame:
    got = search.align(fixtures.scores(spark, sf_dir), _references(spark, sf_dir), BLANK, engine)
    return got.withColumn("margin", F.round(scalars.finite(F.col("margin")), 6))


@query(PATH_SQL)
def dp5_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_path(spark, sf_dir, "direct")


@query(PATH_SQL)
def dp7_align_checkpointed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_path(spark, sf_dir, "checkpointed")


@query(f"WITH RECURSIVE {BEST_PATH} SELECT rec, t, state FROM path")
def dp10_align_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass that keeps two bits a cell; no margins."""
    return search.align(fixtures.scores(spark, sf_dir), _references(spark, sf_dir), BLANK, "packed").select("rec", "t", "state")


#: Pieces by silences (runs of frames of which one score is near zero), then the best path of every piece.
SEGMENTS_SQL = f"""WITH RECURSIVE {SCORES}, n AS (SELECT rec, count(*) AS frames FROM scores GROUP BY rec),
en AS (SELECT rec, t, abs(CAST(lp[4] AS DOUBLE)) AS energy FROM scores), lim AS (SELECT rec, quantile_cont(energy, 0.3) AS threshold FROM en GROUP BY rec),
isl AS (SELECT rec, t, t - row_number() OVER (PARTITION BY rec ORDER BY t) AS island FROM en JOIN lim USING (rec) WHERE energy <= threshold),
si AS (SELECT DISTINCT rec, (min(t) + max(t) + 1) // 2 AS t FROM isl GROUP BY rec, island HAVING (min(t) + max(t) + 1) // 2 > 0),
sb AS (SELECT rec, t, best <> 0 AND best IS DISTINCT FROM lag(best) OVER (PARTITION BY rec ORDER BY t) AS begins FROM greedy),
sd AS (SELECT rec, t, sum(CAST(begins AS INT)) OVER (PARTITION BY rec ORDER BY t) AS said FROM sb), tot AS (SELECT rec, max(said) AS total FROM sd GROUP BY rec),
ca AS (SELECT si.rec, si.t, CAST(floor(said * (8.0e0 / total)) AS BIGINT) AS share FROM si JOIN sd ON sd.rec = si.rec AND sd.t = si.t JOIN tot ON tot.rec = si.rec WHERE total > 0),
mk AS (SELECT rec, list({{t: t, lab: list_sort(list_transform([2, 4, 6, 8], lambda e: {{o: abs(e - share), e: CAST(e AS BIGINT)}}))[1].e}} ORDER BY t) AS ms FROM ca GROUP BY rec HAVING count(*) > 1),
ac AS (SELECT n.rec, frames, list_reduce(list_prepend([{{t: CAST(0 AS BIGINT), lab: CAST(0 AS BIGINT)}}], list_transform(coalesce(ms, []), lambda m: [m])), lambda a, m: CASE WHEN m[1].t - a[-1].t >= 8 AND frames - m[1].t >= 8
  AND m[1].lab > a[-1].lab AND m[1].lab < 8 AND m[1].t - a[-1].t >= m[1].lab - a[-1].lab + 2 THEN list_concat(a, m) ELSE a END) AS kept FROM n LEFT JOIN mk ON mk.rec = n.rec),
en2 AS (SELECT rec, list_append(kept, {{t: frames, lab: CAST(8 AS BIGINT)}}) AS ends FROM ac),
pc AS (SELECT rec, CAST(i - 1 AS INT) AS seg, ends[i].t AS t0, ends[i + 1].t AS t1, ends[i].lab AS l0, ends[i + 1].lab AS l1 FROM en2, unnest(range(1, len(ends))) AS g(i)),
un AS (SELECT rec FROM pc GROUP BY rec HAVING bool_or(t1 - t0 < l1 - l0)),
pq AS (SELECT * FROM pc WHERE rec NOT IN (SELECT rec FROM un) UNION ALL SELECT rec, 0, 0, frames, 0, 8 FROM n WHERE rec IN (SELECT rec FROM un)),
st AS (SELECT *, list_transform(range(0, 2 * (l1 - l0) + 1), lambda s: CASE WHEN s % 2 = 0 THEN 0 ELSE ((l0 + s // 2 + 1) * 7 + rec) % 60 + 1 END) AS st FROM pq),
f(rec, seg, t, r) AS (SELECT st.rec, seg, t, list_transform(range(1, len(st) + 1), lambda s: CASE WHEN s <= 2 THEN CAST(lp[st[s] + 1] AS DOUBLE) ELSE CAST('-Infinity' AS DOUBLE) END) FROM scores JOIN st ON st.rec = scores.rec AND t = t0
  UNION ALL SELECT f.rec, f.seg, s.t, list_transform(range(1, len(st.st) + 1), lambda i: greatest(f.r[i], CASE WHEN i > 1 THEN f.r[i - 1] ELSE CAST('-Infinity' AS DOUBLE) END, CASE WHEN i % 2 = 0 AND i > 2 THEN f.r[i - 2] ELSE CAST('-Infinity' AS DOUBLE) END) + CAST(s.lp[st.st[i] + 1] AS DOUBLE))
  FROM f JOIN st ON st.rec = f.rec AND st.seg = f.seg JOIN scores s ON s.rec = f.rec AND s.t = f.t + 1 WHERE s.t < st.t1),
m AS (SELECT rec, seg, t + 1 AS t, i, [r[i], CASE WHEN i > 1 THEN r[i - 1] ELSE CAST('-Infinity' AS DOUBLE) END, CASE WHEN i % 2 = 0 AND i > 2 THEN r[i - 2] ELSE CAST('-Infinity' AS DOUBLE) END] AS moves FROM f, unnest(range(1, len(r) + 1)) AS g(i)),
e AS (SELECT rec, seg, max(t) AS t, arg_max(CASE WHEN len(r) > 1 AND r[len(r) - 1] > r[len(r)] THEN len(r) - 1 ELSE len(r) END, t) AS i FROM f GROUP BY rec, seg),
g(rec, seg, t, i) AS (SELECT rec, seg, t, CAST(i AS BIGINT) FROM e UNION ALL SELECT g.rec, g.seg, g.t - 1, g.i - (list_position(moves, list_max(moves)) - 1) FROM g JOIN st ON st.rec = g.rec AND st.seg = g.seg JOIN m ON m.rec = g.rec AND m.seg = g.seg AND m.t = g.t AND m.i = g.i WHERE g.t > st.t0)
SELECT g.rec, g.seg AS segment, g.t, g.i - 1 + 2 * st.l0 AS state, CASE WHEN g.t > st.t0 AND isfinite(list_sort(moves, 'DESC')[2]) THEN round(list_max(moves) - list_sort(moves, 'DESC')[2], 6) END AS margin, CAST(NULL AS VARCHAR) AS error
FROM g JOIN st ON st.rec = g.rec AND st.seg = g.seg LEFT JOIN m ON m.rec = g.rec AND m.seg = g.seg AND m.t = g.t AND m.i = g.i"""


@query(SEGMENTS_SQL)
def dp11_align_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = fixtures.scores(spark, sf_dir)
    quiet = scores.select("rec", "t", F.abs(F.get("lp", F.lit(3)).cast("double")).alias("energy"))
    silences = signal.silence_runs(quiet, 0.3, least=1, hop=4, frame=0).select("rec", F.col("midpoint_sample").alias("frame"))
    refs = _references(spark, sf_dir).select("rec", "ids", F.lit([2, 4, 6, 8]).alias("word_ends"))
    got = segments.align(scores, refs, silences, BLANK, segments.SegmentParams(least=8, slack=2))
    return got.withColumn("margin", F.round(scalars.finite(F.col("margin")), 6))


@query(f"""WITH RECURSIVE {ENERGIES}, q AS (SELECT rec, t * 24 AS frame FROM energies WHERE energy <= 5),
r AS (SELECT rec, max(frame) // 48 AS n, list_sort(list_distinct(list(frame // 48))) AS cs FROM q GROUP BY rec),
g(rec, cs, a, b, pick) AS (SELECT rec, cs, CAST(0 AS BIGINT), n, list_sort(list_transform(list_filter(cs, lambda c: c >= 4 AND c <= n - 4), lambda c: {{o: abs(c - n // 2), c: c}}))[1].c FROM r
  UNION ALL SELECT rec, cs, h.x, h.y, list_sort(list_transform(list_filter(cs, lambda c: c >= h.x + 4 AND c <= h.y - 4), lambda c: {{o: abs(c - (h.x + h.y) // 2), c: c}}))[1].c
  FROM (SELECT rec, cs, unnest([{{x: a, y: pick}}, {{x: pick, y: b}}]) AS h FROM g WHERE pick IS NOT NULL)),
k AS (SELECT rec, pick, row_number() OVER (PARTITION BY rec ORDER BY b - a DESC, a) AS k FROM g WHERE pick IS NOT NULL)
SELECT rec, pick AS chunk FROM k WHERE k <= 6""")
def dp17_split_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    silences = fixtures.energies(spark, sf_dir).filter("energy <= 5").select("rec", (F.col("t") * 24).alias("frame"))
    lengths = silences.groupBy("rec").agg(F.floor(F.max("frame") / 48).alias("n_chunks"))
    return search.split_chunks(silences, lengths, warmup=4, most=6)


@query()
def dp13_detect_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fixtures.scores(spark, sf_dir).groupBy("rec").agg(F.count("*").alias("n"))
    start = F.col("k") * 4
    words = n.select("rec", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.col("n") / 4) - 1))).alias("k"))
    words = words.select(
        "rec", F.col("k").cast("long").alias("cue_no"), start.alias("start_frame"), F.when(F.col("k") % 5 == 4, start + 20).otherwise(start + 3).alias("end_frame"),
        F.array((F.col("k") * 7 + F.col("rec")) % 60 + 1).cast("array<long>").alias("tokens"), F.lit(1).alias("sura"), F.floor(F.col("k") / 10).cast("int").alias("aya"), F.lit(False).alias("is_ayah_final"), F.lit(0.0).alias("avg_logprob"),
    )
    return search.detect_repeats(words, fixtures.scores(spark, sf_dir), BLANK)


def _slots_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _references(spark, sf_dir).select("rec", F.posexplode("ids").alias("word_no", "id"))
    return rows.select(
        "rec", "word_no", F.concat(F.lit("w"), F.col("word_no")).alias("word"), F.lit(1).alias("sura"), F.floor(F.col("word_no") / 4).cast("int").alias("aya"), (F.col("word_no") % 4 == 3).alias("is_ayah_final"), F.array(F.col("id").cast("long")).alias("tokens")
    )


@query()
def pl_align_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(fixtures.scores(spark, sf_dir), _slots_of(spark, sf_dir))[0]


@query(f"""WITH RECURSIVE {BEST_PATH}, w AS (SELECT p.rec, p.state // 2 AS cue_no, min(p.t) AS start_frame, max(p.t) AS end_frame, avg(CAST(s.lp[refs.st[p.state + 1] + 1] AS DOUBLE)) AS a, min(coalesce(margin, CAST('Infinity' AS DOUBLE))) AS m
  FROM path p JOIN scores s ON s.rec = p.rec AND s.t = p.t JOIN refs ON refs.rec = p.rec WHERE p.state % 2 = 1 GROUP BY p.rec, p.state // 2),
b AS (SELECT *, median(a) OVER (PARTITION BY rec) AS base, lead(start_frame) OVER (PARTITION BY rec ORDER BY start_frame) AS nxt, greatest(end_frame * 0.04e0, start_frame * 0.04e0 + 0.15e0) AS lifted FROM w)
SELECT rec, cue_no, 'w' || cue_no AS word, start_frame, end_frame, round(a, 6) AS avg_logprob, CASE WHEN isfinite(m) THEN round(m, 6) END AS min_decision_margin, a < base - 1 OR m < 0.5 AS low_confidence,
  round(start_frame * 0.04e0, 6) AS start, round(greatest(CASE WHEN nxt IS NULL THEN lifted ELSE least(lifted, nxt * 0.04e0) END, start_frame * 0.04e0), 6) AS "end" FROM b""")
def pl_align_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan without the search for repeats, which SQL can state."""
    got = alignment.align(fixtures.scores(spark, sf_dir), _slots_of(spark, sf_dir), alignment.AlignParams(repeats=None))[0]
    margin = F.round(scalars.finite(F.col("min_decision_margin")), 6).alias("min_decision_margin")
    return got.select("rec", "cue_no", "word", "start_frame", "end_frame", F.round("avg_logprob", 6).alias("avg_logprob"), margin, "low_confidence", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(f"""WITH {SCORES}, x AS (SELECT g.rec, g.t, s.id, list_sort(lp, 'DESC') AS d, lp[s.id + 1] AS c FROM greedy g JOIN symbols s USING (rec, t))
SELECT rec, t, id, CASE WHEN t = 0 THEN NULL WHEN c = d[1] THEN round(CAST(d[1] AS DOUBLE) - CAST(d[2] AS DOUBLE), 5) ELSE round(CAST(c AS DOUBLE) - CAST(d[1] AS DOUBLE), 5) END AS margin FROM x""")
def w13_decision_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = fixtures.scores(spark, sf_dir).select("rec", "t", F.col("lp").cast("array<double>").alias("lp"), (arrays.argmax(F.col("lp")) % 4).cast("long").alias("id"))
    return frames.decision_margin(chosen).withColumn("margin", F.round(scalars.finite(F.col("margin")), 5))


@query("""WITH x AS (SELECT p_partkey, string_split(p_type, '') AS u FROM part)
SELECT p_partkey, array_to_string(list_filter(list_transform(range(1, len(u) + 1), lambda i: CASE WHEN i = 1 OR u[i] <> u[i - 1] THEN u[i] END), lambda x: x IS NOT NULL), '') AS units FROM x""")
def w15_collapse_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(arrays.collapse_units(F.split("p_type", "")), "").alias("units"))


@query("""SELECT o_orderkey AS rec, CAST(i AS BIGINT) AS out_pos, CAST(i // 2 AS BIGINT) AS text_pos FROM orders, unnest(range(0, 2 * length(o_orderpriority))) AS g(i)""")
def jn5_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rec"), F.length("o_orderpriority").alias("n"))
    mapping = orders.select("rec", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("text_pos")).select("rec", "text_pos", (2 * F.col("text_pos")).alias("start"), (2 * F.col("text_pos") + 2).alias("end"))
    return reference.scatter(mapping, orders.select("rec", (2 * F.col("n")).alias("n")))


# streams


@query(f"""WITH {SCORES}, n AS (SELECT rec, count(*) AS n FROM scores GROUP BY rec),
w AS (SELECT rec, c AS chunk, r AS "row", 8 * c + 3 * r AS first FROM n, unnest(range(0, CASE WHEN n <= 12 THEN 1 ELSE 1 + CAST(ceil((n - 12) / 8e0) AS BIGINT) END)) AS g(c), (VALUES (0), (1), (2), (3)) AS p(r)),
x AS (SELECT rec, t, k, CAST(lp[k + 1] AS DOUBLE) AS v FROM scores, unnest(range(0, len(lp))) AS g(k)), dims AS (SELECT DISTINCT k FROM x)
SELECT w.rec, w.chunk, w."row", dims.k, round(coalesce(sum(v), 0) / 3, 6) AS v FROM w CROSS JOIN dims LEFT JOIN x ON x.rec = w.rec AND x.k = dims.k AND x.t >= w.first AND x.t < w.first + 3 GROUP BY w.rec, w.chunk, w."row", dims.k""")
def ss1_stream_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of three batches of the scores, through the framing with the stand-in model, from a folder into a folder."""
    chunks.state_in_rocksdb(spark)
    where = new_folder(spark, "stream")
    scores = fixtures.scores(spark, sf_dir)
    ends = scores.groupBy("rec").agg((F.max("t") + 1).alias("n"))
    rows = scores.join(ends, "rec").select("rec", "t", F.col("lp").cast("array<double>").alias("feat"), (F.col("t") == F.col("n") - 1).alias("last"), F.floor(3 * F.col("t") / F.col("n")).cast("int").alias("part"))
    rows.write.partitionBy("part").parquet(f"{where}/parts")
    schema = rows.drop("part").schema
    for part in range(3):  # a new query for each batch that comes: what the one before leaves behind is its checkpoint
        spark.read.schema(rows.schema).parquet(f"{where}/parts").filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(schema).parquet(f"{where}/in")
        out = chunks.frame_chunks(stream, chunks.mean_model(4), 12, 8).writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/state")
        out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{where}/out")
    return got.select("rec", "chunk", "row", F.posexplode("out").alias("k", "v")).withColumn("v", F.round("v", 6))


# references


def letter_rules(text: str) -> list[list[str]]:
    """A toy phonetiser: the last letter of a text is `final`, one that the next letter equals is `double`."""
    letters = [k for k, c in enumerate(text) if c != " "]
    after = dict(zip(letters, letters[1:], strict=False))
    return [[*(["final"] if letters and k == letters[-1] else []), *(["double"] if k in after and text[after[k]] == c else [])] for k, c in enumerate(text)]


@query("""WITH v AS (SELECT conv_id, turn, list_filter(string_split(lower(text), ' '), lambda w: w <> '') AS ws FROM conversations),
w AS (SELECT conv_id, turn, i, ws[i] AS word, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) - 1 AS word_no FROM v, unnest(range(1, len(ws) + 1)) AS g(i)),
p AS (SELECT conv_id, turn, word_no, word, lead(word) OVER o AS nxt, lead(turn) OVER o AS later FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY word_no))
SELECT conv_id AS rec, CAST(word_no AS BIGINT) AS word_no, CAST(length(word) - 1 AS INT) AS char_idx, CASE WHEN right(word, 1) = left(nxt, 1) THEN 'double' ELSE '' END AS rules FROM p WHERE nxt IS NOT NULL AND later IS DISTINCT FROM turn""")
def ref_boundary_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), " "), lambda w: w != "")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("rec"), F.col("turn").alias("verse"), F.posexplode(words).alias("i", "word"))
    number = F.row_number().over(Window.partitionBy("rec").orderBy("verse", "i")) - 1
    rows = rows.select("rec", "verse", number.cast("long").alias("word_no"), "word")
    return reference.boundary_rules(rows, letter_rules).withColumn("rules", F.array_join("rules", ","))


@query("""WITH v AS (SELECT o_custkey AS rec, o_orderkey AS verse, lower(o_orderpriority) AS t FROM orders),
x AS (SELECT rec, verse, regexp_extract_all(t, 'medium|high|urgent|not|specified|low|-| |1|2|3|4|5') AS ts FROM v),
k AS (SELECT rec, verse, i - 1 AS pos, ts[i] AS token, len(list_filter(ts[1:i - 1], lambda t: t = ' ')) AS word, coalesce(list_sum(list_transform(ts[1:i - 1], lambda t: length(t))), 0) AS start FROM x, unnest(range(1, len(ts) + 1)) AS g(i)),
q AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY verse, pos) - 1 AS gp FROM k), z AS (SELECT rec, verse, word, token, gp, start - min(start) OVER (PARTITION BY rec, verse, word) AS idx FROM q WHERE token <> ' '),
s AS (SELECT rec, verse, word, string_agg(token, '' ORDER BY gp) AS text, string_agg(gp, ',' ORDER BY gp) AS token_positions, string_agg(idx, ',' ORDER BY gp) AS token_char_idx FROM z GROUP BY rec, verse, word)
SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY verse, word) - 1 AS word_no, text AS word, verse, word = max(word) OVER (PARTITION BY rec, verse) AS is_verse_final, token_positions, token_char_idx FROM s""")
def ref_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities as verses of a customer, their parts between spaces as words."""
    verses = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("rec"), F.col("o_orderkey").alias("verse"), F.lower("o_orderpriority").alias("text"))
    found = tokens.with_tokens(verses, PRIORITY_TOKENS).withColumn("spans", reference.word_offsets(F.col("text"), F.split("text", " ")))

    def word(span: Column, i: Column) -> Column:
        inside = F.filter("tokens", lambda t: (t["start"] >= span["start"]) & (t["start"] < span["end"]))
        own = F.transform(inside, lambda t: F.struct(t["pos"].alias("pos"), (t["start"] - span["start"]).alias("char_idx")))
        return F.struct(i.cast("long").alias("word"), span["word"].alias("text"), F.lit(None).cast("string").alias("letters"), own.alias("own"))

    ids = F.transform("tokens", lambda t: t["id"]).alias("ids")
    rows = found.select("rec", "verse", F.size("spans").alias("n_words"), F.size("tokens").alias("n_tokens"), ids, F.transform("spans", word).alias("words"))
    _, slots = reference.combined_verses(rows)
    return slots.select("rec", "word_no", "word", "verse", "is_verse_final", F.array_join("token_positions", ",").alias("token_positions"), F.array_join("token_char_idx", ",").alias("token_char_idx"))


# loudness

TAPS = [row.tolist() for row in signal.interpolator()]


@query(f"""WITH {ENERGIES}, x AS (SELECT rec, list_concat(list_transform(range(24), lambda z: 0e0), list_concat(list(energy - 25e0 ORDER BY t), list_transform(range(24), lambda z: 0e0))) AS xs FROM energies GROUP BY rec),
y AS (SELECT rec, max(abs(list_inner_product(xs[i + 1:i + 48], CAST(h AS DOUBLE[])))) AS top FROM x, unnest(range(0, len(xs) - 47)) AS g(i), (SELECT unnest({TAPS}) AS h) GROUP BY rec) SELECT rec, round(20 * log10(greatest(top, 1e-6)), 6) AS true_peak_db FROM y""")
def ln_true_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.energies(spark, sf_dir).groupBy("rec").agg(F.array_sort(F.collect_list(F.struct("t", (F.col("energy") - 25.0).cast("double").alias("v")))).alias("x"))
    pcm = rows.select("rec", F.transform("x", lambda x: x["v"]).alias("pcm"))
    return signal.true_peaks(pcm).withColumn("true_peak_db", F.round("true_peak_db", 6))
