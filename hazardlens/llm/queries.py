"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hazardlens.llm import (
    blocknames, chat, hostrules, jaccard, langid, manifest, mixing, packing, repair, secretscan, shards, toxicity, vptree,
)
from hazardlens.llm.common import checkpointed, table
from hazardlens.session import scratch_path


def _count_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secretscan.scan(docs, secretscan.learn(docs))
    named = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("spans", lambda s: s.kind != "random")
    return found.select(
        "doc_id", _count_kind("assign"), _count_kind("access"), _count_kind("hex"),
        F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
        _count_kind("random"))


def op2_language_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = langid.remainder(F.col("doc_id"), 3) == 1
    model = langid.learn(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, folder, "documents"))


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "'</s>[INST] ok [/INST]' AS text"
    probe = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, {said} "
                      f"UNION ALL SELECT -1L, 1L, 'assistant', {said}")
    turns = table(spark, folder, "conversations").select(*probe.columns).unionByName(probe)
    formatted = chat.format_conversations(turns)
    back = formatted.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"))


def op6_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return hostrules.judge(table(spark, folder, "documents"), F.col("source")).drop("host_rate")


def op7_training_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    shards.write_shards(table(spark, folder, "documents"), path)
    return shards.read_shards(spark, path)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = langid.remainder(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs.where(~held_out), labels)
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model, spans="sentences")
    spans = F.array_join(F.transform("sentences", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string"))), ",")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), spans.alias("sentences"))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.plan_mix(table(spark, folder, "documents"))
    return mix.plan.select("doc_id", "size", "source_size", "target", "taken")


def op10_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return blocknames.exact_duplicates(table(spark, folder, "documents"))


def op11_audit_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_summary(repair.damaged(table(spark, folder, "conversations")), present_col="present")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    doc_id, chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("decimal(38,0)")
    leaf = lambda n: manifest.leaf_digest(doc_id, F.col("source"), F.col("lang"), n, F.col("text"))
    tampered = (F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0) & chars.isNotNull()
    built = manifest.build(docs, F.col("lang"), doc_id, leaf(chars), F.struct(
        doc_id.alias("doc_id"), F.when(tampered, leaf(chars + 1)).alias("tampered")))
    proofs = manifest.prove(built).select("tree", "digest", "path", "payload.*")
    root = F.lit(built.root)
    found = proofs.join(built.trees.select("tree", F.col("digest").alias("subroot")), "tree").select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), manifest.path_digest(F.col("path")).alias("proof_sha256"),
        manifest.folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    index = checkpointed(vptree.build_index(table(spark, folder, "embeddings")))
    return vptree.search(index, index.where(F.col("vec_id") % 50 == 0)).select("query_id", "rank", "vec_id", "score")


OP4_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER w AS pos, role IS DISTINCT FROM lag(role) OVER w AS fresh,
             length(regexp_replace(text, 'PATTERN', '\0+', 'g')) AS text_chars,
             length(regexp_replace(role, 'PATTERN', '\0+', 'g')) AS role_chars
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS said,
             coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum(text_chars + CASE WHEN fresh THEN role_chars + BLOCK ELSE NEXT END)::BIGINT AS formatted_chars
      FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars FROM g
""".replace("PATTERN", chat.ESCAPE_PATTERN).replace(
    "BLOCK", str(len(chat.BEGIN + chat.BODY + chat.END))).replace("NEXT", str(len(chat.NEXT)))

OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 7], ' ') AS win
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS pos FROM d)),
again AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows),
rep AS (SELECT doc_id, count(DISTINCT word) AS n_repeat_words
        FROM (SELECT doc_id, unnest(generate_series(pos, pos + 7)) AS word FROM again WHERE n > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS failed FROM f GROUP BY source),
s AS (SELECT sum(n)::DOUBLE AS total, count(*) AS k, sum(n::DOUBLE * n) AS squares,
             least(greatest(sum(failed) / sum(n), 0.5 / sum(n)), 1 - 0.5 / sum(n)) AS mean FROM h),
v AS (SELECT any_value(mean) AS mean, least(greatest(
          (sum(n * power(failed / n - mean, 2)) / any_value(mean * (1 - mean)) - any_value(k - 1))
          / any_value(total - squares / total - (k - 1)), 1e-3), 0.999) AS within FROM h, s),
r AS (SELECT source, (failed + mean * (1 / within - 1)) / (n + (1 / within - 1)) AS rate FROM h, v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""

#: The mix of a table ``docs`` (doc_id, source, text) as in :mod:`hazardlens.llm.mixing`; gives ``mix`` (doc_id,
#: size, source_size, target, taken). Of the awards only those around a source's fair share are listed: a divisor rule
#: leaves it by less than the number of sources.
MIX_CTES = r"""
sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 md5('mix:0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size) AS mixed FROM docs),
per_source AS (SELECT source, sum(size)::BIGINT AS s, count(*) AS n,
                      row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM sized GROUP BY source),
weighed AS (SELECT *, source_no % 3 + 1 AS w, sum(s) OVER ()::BIGINT AS total, sum(n) OVER ()::BIGINT AS docs
            FROM per_source),
filling AS (SELECT *, sum(3 * s) OVER o AS held, sum(w) OVER () - sum(w) OVER o AS rest,
                   lead(3 * s / w) OVER (ORDER BY 3 * s / w, source_no) AS next_full FROM weighed
            WINDOW o AS (ORDER BY 3 * s / w, source_no ROWS UNBOUNDED PRECEDING)),
shares AS (SELECT 0 AS j, total::BIGINT / sum(w)::DOUBLE AS share, min(3 * s / w) > total / sum(w) AS fits FROM weighed
           GROUP BY total
           UNION ALL
           SELECT row_number() OVER (ORDER BY 3 * s / w, source_no), (total - held)::BIGINT / rest::DOUBLE,
                  next_full > (total - held)::BIGINT / rest::DOUBLE
           FROM filling WHERE rest > 0),
share AS (SELECT arg_min(share, j) AS share FROM shares WHERE fits),
aimed AS (SELECT *, least((3 * s)::DOUBLE, share * w) AS target FROM weighed, share),
size_of AS (SELECT greatest(1, least(4096, (SELECT floor(min(target))::BIGINT // 256 FROM aimed WHERE target > 0)))::BIGINT
            AS block, max(total) AS total, count(*) AS margin, sum(target) AS aim FROM aimed),
seats AS (SELECT *, floor(total / block + 0.5)::BIGINT AS seats FROM size_of),
edges AS (SELECT source_no, target, ceil(3 * s / block)::BIGINT AS most,
                 greatest(0, least(most, floor(target * seats / aim)::BIGINT) - margin) AS low,
                 least(most, ceil(target * seats / aim)::BIGINT + margin) AS high FROM aimed, seats WHERE aim > 0),
awards AS (SELECT source_no, k, target / (2 * k + 1) AS quotient
           FROM (SELECT source_no, target, unnest(generate_series(low, high - 1)) AS k FROM edges)),
placed_awards AS (SELECT source_no, row_number() OVER (ORDER BY quotient DESC, source_no, k) AS place FROM awards),
won AS (SELECT source_no, max(low) + count(place) AS quota FROM edges LEFT JOIN (
            SELECT * FROM placed_awards WHERE place <= (SELECT max(seats) FROM seats) - (SELECT sum(low) FROM edges))
        USING (source_no) GROUP BY source_no),
rings AS (SELECT source, source_no, s, target, least(coalesce(quota, 0) * block, 3 * s) AS run,
                 ('0x' || substr(md5('mix:0:source:' || source_no::VARCHAR), 1, 15))::BIGINT
                 % greatest(1, s // block) * block AS start
          FROM aimed LEFT JOIN won USING (source_no), size_of),
placed AS (SELECT d.doc_id, d.size, r.s, r.target, r.run, d.source,
                  (((sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mixed, d.size ROWS UNBOUNDED PRECEDING)
                     - d.size - r.start)::BIGINT % greatest(r.s, 1)) + greatest(r.s, 1)) % greatest(r.s, 1) AS first
           FROM sized d JOIN rings r ON d.source IS NOT DISTINCT FROM r.source),
mix AS (SELECT doc_id, size, s AS source_size, target,
               (TURNS)::BIGINT AS taken FROM placed)
""".replace("TURNS", " + ".join(f"greatest(0, least(run, first + s * {turn} + size) - greatest(0, first + s * {turn}))"
                                for turn in (-1, 0, 1, 2, 3)))
OP9_SQL = f"""
WITH docs AS (SELECT doc_id, source, text FROM documents), {MIX_CTES}
SELECT doc_id, size, source_size, target, taken FROM mix
"""

OP10_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

#: Unsigned CRC-32 of an ASCII string, bit by bit; fixed value: the polynomial.
_CRC32_SQL = """xor(list_reduce(list_transform(range(0, 8 * length(SUBJECT)), lambda i: (ascii(SUBJECT[i // 8 + 1]) >> (i % 8)::INTEGER) & 1),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT), 4294967295)"""

#: Repair states 0 to 3: nothing yet, after system, after user, after assistant. ``fit`` leads from each to the next.
OP11_SQL = r"""
WITH RECURSIVE fit(state, next) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
convs AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
given AS (SELECT conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
          FROM conversations c JOIN convs ON c.conv_id IS NOT DISTINCT FROM convs.conv_id),
marked AS (SELECT *, CRC32 % 20 AS kind FROM given),
damaged AS (SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM marked, range(2) r(i) WHERE kind <> 0 AND (i = 0 OR kind = 3)),
o AS (SELECT *, row_number() OVER w AS k, lag(role[1]) OVER w || role[1] AS pair, count(*) OVER (PARTITION BY conv) AS n
      FROM damaged WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                     WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 'd'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM o),
facts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                 count(*) FILTER (fault = 't') AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv),
dp AS (SELECT conv, 0 AS k, state, best FROM convs, (VALUES (0, {'cost': 0, 'audit': ''}), (2, {'cost': 2, 'audit': 'I'}),
                                                           (3, {'cost': 4, 'audit': 'II'})) s(state, best)
       UNION ALL
       SELECT conv, k + 1, state, min(best) FROM (
           SELECT conv, k, unnest([to_state, a.next, b.next]) AS state,
                  unnest([{'cost': cost, 'audit': audit}, {'cost': cost + 2, 'audit': audit || 'I'},
                          {'cost': cost + 4, 'audit': audit || 'II'}]) AS best
           FROM (SELECT dp.conv, dp.k, e.state AS to_state, best.cost + e.cost + CASE WHEN e.edit <> 'D' AND fault = 't' THEN 1 ELSE 0 END AS cost,
                        best.audit || e.edit AS audit
                 FROM dp JOIN f ON f.conv = dp.conv AND f.k = dp.k + 1 JOIN fit USING (state), LATERAL (
                     SELECT 'D' AS edit, dp.state AS state, 3 AS cost
                     UNION ALL SELECT 'R', fit.next, 2 WHERE fault NOT IN ('b', 'd')
                     UNION ALL SELECT 'K', CASE WHEN role[1] = 's' THEN 1 ELSE fit.next END, 0 WHERE fault NOT IN ('b', 'd')
                         AND (role[1] = 's' AND dp.state = 0 OR role[1] = CASE fit.next WHEN 2 THEN 'u' ELSE 'a' END)) e) moved
           JOIN fit a ON a.state = to_state JOIN fit b ON b.state = a.next) GROUP BY conv, k, state),
done AS (SELECT conv, min(best) AS best FROM dp JOIN (SELECT conv, coalesce(max(n), 0) AS k FROM convs LEFT JOIN o USING (conv)
                                                      GROUP BY conv) USING (conv, k) WHERE state IN (0, 3) GROUP BY conv),
letters AS (SELECT conv, i, best.audit[i] AS edit, length(replace(best.audit[:i], 'I', '')) AS k,
                   length(replace(best.audit[:i], 'D', '')) - length(replace(best.audit, 'D', '')) % 2 AS place
            FROM done, LATERAL (SELECT unnest(range(1, length(best.audit) + 1)) AS i)),
repaired AS (SELECT l.conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                                       || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS said
             FROM letters l LEFT JOIN f ON f.conv = l.conv AND f.k = l.k WHERE edit <> 'D' GROUP BY l.conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
       sha256(coalesce(said, '')) AS repaired_sha256
FROM convs LEFT JOIN facts USING (conv) LEFT JOIN done USING (conv) LEFT JOIN repaired USING (conv)
""".replace("CRC32", _CRC32_SQL.replace("SUBJECT", "key"))

OP12_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, lang, n_chars, coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                            AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
h AS (SELECT doc_id, lang, sha256(ID || head || N0 || tail) AS leaf, CASE WHEN CRC32 % 7 = 0 THEN sha256(ID || head || N1 || tail) END AS given FROM d),
trees AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) AS n FROM h GROUP BY lang),
leaves AS (SELECT doc_id, leaf, coalesce(given, leaf) AS given, tree, n,
                  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
           FROM h JOIN trees ON h.lang IS NOT DISTINCT FROM trees.lang),
nodes AS (SELECT tree, 0 AS level, pos, leaf AS node, n FROM leaves
          UNION ALL SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
          FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
tops AS (SELECT 0 AS level, tree AS pos, node, (SELECT count(*) FROM trees) AS n FROM nodes WHERE n = 1
         UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
         FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
way AS (SELECT tree, pos AS rank, 0 AS level, given AS node, n, '' AS path FROM leaves
        UNION ALL SELECT w.tree, w.rank, w.level + 1,
                  sha256(CASE WHEN (w.rank >> w.level) % 2 = 1 THEN s.node || w.node ELSE w.node || coalesce(s.node, '') END),
                  (w.n + 1) // 2, w.path || coalesce(s.node, '')
        FROM way w LEFT JOIN nodes s ON s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.rank >> w.level, 1) WHERE w.n > 1),
up AS (SELECT tree, rank, 0 AS level, node, (SELECT count(*) FROM trees) AS n, path FROM way WHERE n = 1
       UNION ALL SELECT w.tree, w.rank, w.level + 1,
                 sha256(CASE WHEN (w.tree >> w.level) % 2 = 1 THEN s.node || w.node ELSE w.node || coalesce(s.node, '') END),
                 (w.n + 1) // 2, w.path || coalesce(s.node, '')
       FROM up w LEFT JOIN tops s ON s.level = w.level AND s.pos = xor(w.tree >> w.level, 1) WHERE w.n > 1)
SELECT doc_id, leaf, t.node AS subroot, r.node AS root, sha256(up.path) AS proof_sha256, up.node AS folded_root, up.node = r.node AS verified
FROM leaves l JOIN up ON up.tree = l.tree AND up.rank = l.pos AND up.n = 1
JOIN tops t ON t.level = 0 AND t.pos = l.tree JOIN tops r ON r.n = 1
""".replace("ID", "coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')").replace(
    "N0", "coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')").replace(
    "N1", "coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-')").replace(
    "CRC32", _CRC32_SQL.replace("SUBJECT", "(doc_id::VARCHAR)"))



def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    known = (op1_secret_scan, op2_language_filters, op3_jaccard_join, op4_chat_format, op5_best_fit_packing, op6_host_rules,
             op7_training_shards, op8_toxicity, op9_source_mixing, op10_block_naming, op11_audit_repair,
             op12_merkle_manifest, op13_vantage_trees)
    return {f.__name__: f for f in known} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    known = {"op4_chat_format": OP4_SQL, "op6_host_rules": OP6_SQL, "op9_source_mixing": OP9_SQL, "op10_block_naming": OP10_SQL,
             "op11_audit_repair": OP11_SQL, "op12_merkle_manifest": OP12_SQL,
             "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in known.items() if sql}
