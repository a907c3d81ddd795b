"""The ten operators and the pipeline as queries, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clicksieve.llm.common import documents, held_out
from clicksieve.llm.id_store import scan_store, write_store
from clicksieve.llm.language_id import fit_languages, identify_language
from clicksieve.llm.licence_scan import scan_licences
from clicksieve.llm.line_crf import fit_on_labels, quality_score
from clicksieve.llm.line_dedup import MIN_CONSTANT, MIN_DOCS, SHORT_PERCENT, SHORT_TIMES, drop_recurring_lines
from clicksieve.llm.merkle_manifest import audit
from clicksieve.llm.mixing import mix_sources
from clicksieve.llm.near_dedup import near_duplicates
from clicksieve.llm.prefix_trie import conversation_turns, prefix_trie, share_heads
from clicksieve.llm.quality_rules import fit_ratio, judge, trusted_ids
from clicksieve.llm.repeated_windows import remove_repeated
from clicksieve.llm.sentencepiece_codec import encode_documents
from clicksieve.llm.vantage_points import nearest
from clicksieve.queries.base import query
from clicksieve.session import scratch_path

OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) line,
         generate_subscripts(string_split(text, chr(10)), 1) pos
  FROM documents),
tokens AS (
  SELECT doc_id, pos, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') raw,
         regexp_extract_all(regexp_replace(line,
           '[^\\x20\\x09-\\x0D]*[0-9@][^\\x20\\x09-\\x0D]*', '<*>', 'g'), '[^\\x20\\x09-\\x0D]+') t
  FROM lines),
cut AS (
  SELECT doc_id, pos, raw, t, len(t) n, len(list_filter(t, lambda x: x <> '<*>')) constant, array_to_string(t[1:3], ' ') leaf,
         [array_to_string(t[4 + (n - 3) * i // 4 : 3 + (n - 3) * (i + 1) // 4], ' ') FOR i IN [0, 1, 2, 3]] p
  FROM tokens WHERE len(t) >= 1),
keys AS (
  SELECT DISTINCT doc_id, pos, unnest(CASE
    WHEN constant < n * {MIN_CONSTANT} THEN [{{'short': n <= 3, 'of': concat('u|', array_to_string(raw, ' '))}}]
    WHEN n <= 3 THEN [{{'short': true, 'of': concat('w|', array_to_string(t, ' '))}}]
    ELSE [{{'short': false, 'of': concat('w|', array_to_string(t, ' '))}},
          {{'short': n < 11, 'of': concat('0|', n, '|', leaf, '|', p[2], '|', p[3], '|', p[4])}},
          {{'short': n < 11, 'of': concat('1|', n, '|', leaf, '|', p[1], '|', p[3], '|', p[4])}},
          {{'short': n < 11, 'of': concat('2|', n, '|', leaf, '|', p[1], '|', p[2], '|', p[4])}},
          {{'short': n < 11, 'of': concat('3|', n, '|', leaf, '|', p[1], '|', p[2], '|', p[3])}}] END) key
  FROM cut),
recurring AS (
  SELECT key, min(doc_id) first FROM keys GROUP BY key HAVING count(DISTINCT doc_id) >= CASE WHEN key.short
    THEN greatest({SHORT_TIMES * MIN_DOCS}, (SELECT (count(doc_id) * {SHORT_PERCENT} + 99) // 100 FROM documents)) ELSE {MIN_DOCS} END),
gone AS (
  SELECT DISTINCT doc_id, pos FROM keys JOIN recurring USING (key) WHERE doc_id > first)
SELECT l.doc_id, CAST(count(*) AS INT) n_lines, CAST(count(g.pos) AS INT) n_dropped,
       coalesce(string_agg(CASE WHEN g.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') text
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
GROUP BY l.doc_id"""


@query("op1_line_dedup", OP1_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_recurring_lines(documents(spark, folder)).select("doc_id", "n_lines", "n_dropped", "text")


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE [concat(w[i], ' ', w[i + 1]) FOR i IN range(1, len(w))] END) s
  FROM words),
sizes AS (SELECT doc_id, count(*) n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id x, b.doc_id y, count(*) common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id x, doc_id y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) n_shingles, min(y) component_id, d.doc_id = min(y) kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = d.doc_id
GROUP BY d.doc_id, n"""


@query("op2_minhash_near_dedup", OP2_SQL)
def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(documents(spark, folder), width=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) words, row_number() OVER (ORDER BY source IS NULL, encode(source)) k
  FROM sized GROUP BY source),
weighed AS (
  SELECT source, words, k, CAST([5, 2, 1][1 + (k - 1) % 3] AS DOUBLE) w, words * 2.0::DOUBLE cap FROM sources),
leveled AS (
  SELECT *, (sum(words) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)) /
            (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) lvl
  FROM weighed WINDOW before AS (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT arg_min(lvl, (cap / w, k)) lvl FROM leveled WHERE cap > lvl * w)
SELECT doc_id, size, words source_size,
       CASE WHEN cap > leveled.lvl * w THEN (SELECT lvl FROM final) * w ELSE cap END target
FROM sized JOIN leveled ON sized.source IS NOT DISTINCT FROM leveled.source"""


@query("mix_targets", OP5_SQL)
def mix_targets(spark: SparkSession, folder: str) -> DataFrame:
    """What SQL can say of op5_mixing: sizes, the words of the sources and their targets."""
    return mix_sources(documents(spark, folder)).select("doc_id", "size", "source_size", "target")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "rate", "copies", "taken")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_documents(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return coded.select("doc_id", "n_tokens", "ids", same.alias("round_trip"))


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    field = fit_on_labels(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), field).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op3_repeated_windows")
def op3_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated(documents(spark, folder)).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = identify_language(F.col("text"), fit_languages(docs))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    ratio = fit_ratio(docs, trusted_ids(spark.read.parquet(f"{folder}/labels.parquet")))
    return judge(docs, ratio).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "ratio_score", "kept")


@query("op8_id_store")
def op8_id_store(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "id-store")
    write_store(documents(spark, folder), path, public_tokenizers.path("word_bpe_49k.json"))
    return scan_store(spark, path).withColumnRenamed("id", "doc_id")


OP9_SQL = """
WITH rows AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id query_id, c.vec_id vec_id,
         sqrt(list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b)) score
  FROM rows q JOIN rows c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) "rank" FROM pairs)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 10"""


@query("op9_vantage_points", OP9_SQL)
def op9_vantage_points(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10, factor=1.0)


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a decimal number's text, bit by bit, as DuckDB SQL."""
    step = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce([xor(c, b)] || [0::BIGINT FOR i IN range(8)], lambda x, y: {step})"
    codes = f"[CAST(ascii(d) AS BIGINT) FOR d IN string_split({text}, '')]"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {byte}), 4294967295)"


def _leaf_sql(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', {c}) END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256(concat({', '.join(parts)}))"


OP11_SQL = rf"""
WITH RECURSIVE bent AS (
  SELECT *, CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END other
  FROM documents),
leaves AS (
  SELECT doc_id, {_leaf_sql("text")} leaf, {_leaf_sql("other")} changed,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 tree FROM bent),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 place,
         count(*) OVER (PARTITION BY tree) n FROM leaves),
sized AS (SELECT *, CAST(ceil(round(log(n) / log(16), 9)) AS INT) height FROM placed),
nodes AS (
  SELECT 0 lvl, tree, place, leaf digest, height FROM sized
  UNION ALL
  SELECT lvl + 1, tree, place // 16, sha256(string_agg(digest, '' ORDER BY place)), height FROM nodes
  WHERE lvl < height GROUP BY lvl, tree, place // 16, height),
subroots AS (SELECT tree, digest FROM nodes WHERE lvl = height),
tops AS (
  SELECT 0 lvl, tree place, digest, (SELECT CAST(ceil(round(log(count(*)) / log(16), 9)) AS INT) FROM subroots) height FROM subroots
  UNION ALL
  SELECT lvl + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), height FROM tops
  WHERE lvl < height GROUP BY lvl, place // 16, height),
root AS (SELECT digest, height FROM tops WHERE lvl = height),
segs AS (
  SELECT lvl, tree, place,
         coalesce(string_agg(digest, '') OVER (PARTITION BY lvl, tree, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') l,
         coalesce(string_agg(digest, '') OVER (PARTITION BY lvl, tree, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') r
  FROM (SELECT lvl, tree, place, digest FROM nodes WHERE lvl < height
        UNION ALL SELECT lvl, -1, place, digest FROM tops WHERE lvl < height)),
steps AS (
  SELECT s.tree, s.place, lvl step, l, r FROM sized s JOIN segs ON segs.tree = s.tree AND lvl < height AND segs.place = s.place // CAST(pow(16, lvl) AS BIGINT)
  UNION ALL
  SELECT s.tree, s.place, s.height + lvl, l, r FROM sized s JOIN segs ON segs.tree = -1 AND segs.place = s.tree // CAST(pow(16, lvl) AS BIGINT)),
proofs AS (SELECT tree, place, sha256(string_agg(concat(l, r), '' ORDER BY step)) proof FROM steps GROUP BY tree, place),
folds AS (
  SELECT tree, place, 0 step, changed acc FROM sized
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(concat(l, acc, r)) FROM folds f JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.step = f.step)
SELECT doc_id, leaf, subroots.digest subroot, root.digest root, coalesce(proof, sha256('')) proof_sha256, acc folded_root,
       acc = root.digest verified
FROM sized s JOIN subroots ON subroots.tree = s.tree CROSS JOIN root LEFT JOIN proofs p ON p.tree = s.tree AND p.place = s.place
JOIN folds f ON f.tree = s.tree AND f.place = s.place AND f.step = s.height + root.height"""


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return audit(documents(spark, folder)).drop("tampered")


OP13_SQL = rf"""
WITH turns AS (
  SELECT conv_id c, coalesce(role, '') role, coalesce(text, '') txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 base, {_crc32_sql("CAST(c AS VARCHAR)")} % 6 h, count(*) n FROM turns GROUP BY c),
heads AS (SELECT v.*, least(v.h, coalesce(w.n, 0)) m FROM convs v LEFT JOIN convs w ON w.c = v.base),
rebuilt AS (
  SELECT v.c, t.p d, role, txt FROM heads v JOIN turns t ON t.c = v.base AND t.p <= v.h
  UNION ALL
  SELECT v.c, t.p - v.h + v.m, role, txt FROM heads v JOIN turns t ON t.c = v.c AND t.p > v.h),
paths AS (
  SELECT c, d, length(txt) chars,
         string_agg(concat(length(role), ':', role, '|', md5(txt)), '#') OVER (PARTITION BY c ORDER BY d) id
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
lengths AS (SELECT c, max(d) len FROM paths GROUP BY c),
nodes AS (
  SELECT id, d, min(c) rep, count(*) n, any_value(chars) chars,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = len), '') ends
  FROM paths JOIN lengths USING (c) GROUP BY id, d),
links AS (SELECT nodes.id, nodes.d, p.id pid FROM nodes JOIN paths p ON p.c = rep AND p.d = nodes.d - 1),
kids AS (SELECT pid id, count(*) k FROM links GROUP BY pid),
totals AS (
  SELECT p.id, sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END) leaves, sum((n - 1) * w.chars) saved
  FROM nodes w LEFT JOIN kids USING (id) JOIN paths p ON p.c = w.rep AND p.d <= w.d GROUP BY p.id)
SELECT n.rep conv_id, n.d depth, u.rep parent_conv_id, n.n n_convs, coalesce(k, 0) n_children,
       CAST(leaves AS BIGINT) n_leaves, CAST(saved AS BIGINT) saved_tokens, sha256(n.ends) ends_sha256
FROM nodes n JOIN totals USING (id) LEFT JOIN kids USING (id)
LEFT JOIN links ON links.id = n.id AND n.d > 0 LEFT JOIN nodes u ON u.id = links.pid AND u.d = n.d - 1"""


@query("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    return prefix_trie(share_heads(conversation_turns(rows)))


@query("op12_licence_scan")
def op12_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = documents(spark, folder).select("doc_id", scan_licences(F.col("text")).alias("f"))
    return found.select(
        "doc_id", "f.n_words", "f.n_base", "f.first_word", "f.last_word", F.array_join("f.base_labels", ",").alias("base_labels"),
        F.array_join("f.labels", ",").alias("labels"), "f.score")
