"""The operators over the given tables, with the parameters a production run would use."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bytecnn, collocations, language, line_dedup, mixing, packing, postings, prefix_trie, records, rules, simhash, spots, warczip
from tablewright.llm.common import fold_key, table
from tablewright.session import materialise, scratch_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), keep={"doc_id": F.col("doc_id")})
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(fold_key(F.col("doc_id")), F.lit(4)) == 2
    return language.identify(docs, docs.where(~held_out), keep={"doc_id": F.col("doc_id"), "held_out": held_out})


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-records")
    records.write_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return records.digests(spark, path).withColumnRenamed("id", "doc_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc-packages")
    manifest = warczip.write_packages(table(spark, sf_dir, "pages"), path)
    return warczip.read_packages(spark, path, manifest, payloads=False).drop("url")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packed.drop("ids").withColumnRenamed("id", "doc_id")


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spots.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        spots.fingerprint(F.col("signatures")).alias("fingerprint"),
                        spots.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"), "near_edited", "near_next")


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(fold_key(F.col("doc_id")), F.lit(3)) == 1
    scored = bytecnn.classify_quality(docs, table(spark, sf_dir, "labels"), train_on=F.pmod(fold_key(F.col("id")), F.lit(3)) != 1)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = postings.build_index(table(spark, sf_dir, "documents"))
    found = postings.contamination(index, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    own = materialise(prefix_trie.conversations(table(spark, sf_dir, "conversations")), "conversations")
    rebuilt = prefix_trie.with_heads(own, base=conv - conv % 20, n_turns=F.crc32(conv.cast("string")) % 4, most=3)
    return prefix_trie.prefix_trie(rebuilt)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language": op2_language,
    "op3_token_records": op3_token_records,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc_zip": op5_warc_zip,
    "op6_packing": op6_packing,
    "op7_spotsigs": op7_spotsigs,
    "op8_byte_cnn": op8_byte_cnn,
    "op9_simhash": op9_simhash,
    "op10_mix_sources": op10_mix_sources,
    "op11_decontamination": op11_decontamination,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT doc_id, place, line,
    translate(trim(line, concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
frequent AS (
  SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT k.doc_id, k.place, k.line, f.line_key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f USING (line_key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op5_warc_zip": """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM payloads),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts""",
    "op11_decontamination": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (
  SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM sized),
lengths AS (
  SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n),
hits AS (
  SELECT p.r, p.i, p.n, w.item
  FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM places) p JOIN windows w USING (n, phrase)),
covered AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)""",
    "op12_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, turn, sha256(concat(CAST(length(role) AS VARCHAR), ':', role, text)) AS k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(n ORDER BY turn NULLS FIRST, k) AS ns FROM turns GROUP BY conv_id),
sized AS (
  SELECT *, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)) END)) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.ks[1:s.h], []), s.ks[s.h + 1:]) AS ks, list_concat(coalesce(b.ns[1:s.h], []), s.ns[s.h + 1:]) AS ns
  FROM sized s LEFT JOIN own b ON b.conv_id = s.base),
members AS (
  SELECT conv_id, ks, ns, unnest(range(0, len(ks) + 1)) AS depth FROM rebuilt),
placed AS (
  SELECT conv_id, depth, ks, md5(array_to_string(ks[1:depth], '')) AS path, CASE WHEN depth > 0 THEN md5(array_to_string(ks[1:depth - 1], '')) END AS parent,
    CASE WHEN depth > 0 THEN ns[depth] ELSE 0 END AS n, len(ks) = depth AS is_end FROM members),
nodes AS (
  SELECT path, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(ks) AS ks, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM placed GROUP BY path, depth),
counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN (SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent) c ON n.path = c.parent),
above AS (
  SELECT md5(array_to_string(ks[1:e], '')) AS path, saved, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf
  FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM counted)),
summed AS (
  SELECT path, CAST(sum(saved) AS BIGINT) AS saved_tokens, CAST(sum(leaf) AS BIGINT) AS n_leaves FROM above GROUP BY path)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN summed s USING (path) LEFT JOIN nodes p ON p.path = c.parent""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k),
phrases AS (
  SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM grams)
  GROUP BY lang, k, phrase HAVING count(*) >= 30),
candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k >= 2),
cuts AS (
  SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, a, w, j, unnest(range(1, k - j + 2)) AS i FROM candidates, (SELECT unnest(range(2, 4)) AS j) WHERE k > j),
around AS (
  SELECT lang, phrase, max(a) AS around FROM (SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS phrase FROM inside) GROUP BY lang, phrase),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE around IS NULL OR CAST(100 AS HUGEINT) * around < CAST(80 AS HUGEINT) * a)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t USING (lang) WHERE r.rank <= 2000""",
}
