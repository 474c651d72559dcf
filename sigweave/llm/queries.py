"""The queries of these operators, each over its whole table, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, fim, html_extract, matroska, mixing, packing, secrets, sharding, simhash, toxicity, variants, warc
from .common import read


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"), ["doc_id"])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read(spark, sf_dir, "pages"), ["page_id", "url"])


def op5_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.digests(read(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(read(spark, sf_dir, "documents"), ["doc_id"])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.forms(variants.vocabulary(read(spark, sf_dir, "documents")))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(read(spark, sf_dir, "documents"), ["doc_id"], with_ids=False))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.fill_in_middle(read(spark, sf_dir, "documents"), ["doc_id"])
    back = fim.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5_matroska says of payloads read back, without the columns that SQL cannot make."""
    return op5_matroska(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def shard_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: rows, bytes, shards, groups of equal texts in several shards, slots that are missing or repeated, and shards over 1% from the mean in bytes."""
    rows = op9_sharding(spark, sf_dir).join(read(spark, sf_dir, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")), "doc_id")
    of_group = rows.groupBy("text_md5").agg(F.countDistinct("shard").alias("n")).agg(F.sum((F.col("n") > 1).cast("bigint")).alias("split_groups"))
    shards = rows.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("top"), F.sum("size").alias("bytes"))
    gaps = F.sum((F.col("n") - F.col("slots")).cast("bigint") + F.abs(F.col("top") + 1 - F.col("n")))
    sums = shards.agg(F.sum("n").alias("n_rows"), F.sum("bytes").alias("bytes"), F.count("*").alias("shards"), gaps.alias("slot_gaps"), F.collect_list("bytes").alias("all"))
    uneven = F.size(F.filter("all", lambda x: F.abs(x * F.col("shards") / F.col("bytes") - 1) > 0.01)).cast("bigint")
    return sums.withColumn("uneven_shards", uneven).drop("all").join(of_group, F.lit(True))


def packing_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: documents, sequences that are too long, sequences with gaps or overlaps, pieces cut short after the first, and sequences beyond 1% over the fewest possible."""
    rows = op12_best_fit(spark, sf_dir)
    flag = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))
    seqs = rows.groupBy("sequence_id").agg(F.sum("length").alias("filled"), F.max(F.col("offset") + F.col("length")).alias("end"), F.count("*").alias("n"), F.countDistinct("offset").alias("starts"), F.sum((F.col("piece") == 0).cast("bigint")).alias("docs"), flag((F.col("piece") > 0) & (F.col("length") < 2048)).alias("cut"))
    broken = (F.col("filled") != F.col("end")) | (F.col("n") != F.col("starts"))
    sums = seqs.agg(F.sum("docs").alias("n_docs"), flag(F.col("filled") > 2048).alias("overfull"), flag(broken).alias("broken"), F.sum("cut").alias("cut_short"), F.count("*").alias("sequences"), F.sum("filled").alias("tokens"))
    spare = F.greatest(F.lit(0).cast("bigint"), F.col("sequences") - F.floor(F.ceil(F.col("tokens") / 2048) * 1.01) - 1)
    return sums.select("n_docs", "overfull", "broken", "cut_short", spare.cast("bigint").alias("beyond"))


def queries() -> dict:
    ops = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return ops | {"media_payloads": media_payloads, "shard_laws": shard_laws, "packing_laws": packing_laws}


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), b AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(text) AS text_md5 FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM b GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS bound FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY bound / w, source NULLS LAST) AS n, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS everything, sum(w) OVER () AS w_all FROM w
), r AS (
  SELECT *, (everything - coalesce(sum(bound) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (w_all - coalesce(sum(w) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rate FROM o
), f AS (
  SELECT *, min(CASE WHEN rate * w <= bound THEN n END) OVER () AS first_free FROM r
), c AS (
  SELECT *, min(CASE WHEN n = first_free THEN rate END) OVER () AS common FROM f
), t AS (
  SELECT source, source_size, CASE WHEN n < coalesce(first_free, n + 1) THEN bound ELSE common * w END AS target FROM c
), g AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::BIGINT AS whole FROM t
), h AS (
  SELECT *, round(target - whole * source_size)::BIGINT AS rest FROM g
), i AS (
  SELECT source, length(bin(size))::DOUBLE AS digits, sum(size)::DOUBLE AS words FROM b WHERE size > 0 GROUP BY ALL
), j AS (
  SELECT i.*, (h.rest - coalesce(sum(words) OVER (PARTITION BY i.source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
    sum(digits * words) OVER (PARTITION BY i.source ORDER BY digits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c
  FROM i JOIN h ON i.source IS NOT DISTINCT FROM h.source
), k AS (
  SELECT source, max(digits) AS top, arg_max(c, digits) AS c FROM j WHERE c * digits < 1 GROUP BY source
), p AS (
  SELECT b.*, h.source_size, h.target, h.whole, h.rest,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || text_md5), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u,
    CASE WHEN k.top IS NULL OR length(bin(b.size)) > k.top THEN 1.0::DOUBLE ELSE k.c * length(bin(b.size))::DOUBLE END AS p
  FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.source LEFT JOIN k ON b.source IS NOT DISTINCT FROM k.source
), q AS (
  SELECT *, CASE WHEN size = 0 THEN 1.0 WHEN p >= 1 THEN 0.0 ELSE (u * (1 - p)) / (u * (1 - p) + p * (1 - u)) END AS q FROM p
), x AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, text_md5, doc_id ROWS UNBOUNDED PRECEDING) - size AS before FROM q
)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(rest - before, size)))::BIGINT AS taken FROM x
"""


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""


OP11_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), low AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), runs AS (
  SELECT id, unnest(regexp_extract_all(text, '[a-z\x{C0}-\x{FF}]{6,}')) AS run FROM low
), each AS (
  SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run
), crc AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM each, tab
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n FROM crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, n, unnest(range(length(word))) AS i FROM words
), less AS (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, (i + 2)::INT) AS rest FROM cuts
), pairs AS (
  SELECT a.word, b.word AS v, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), near AS (
  SELECT word, count(*) AS n_near, arg_min(v, (-n, v)) AS v, max(n) AS form_n FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN v END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN near USING (word)
), follow AS (
  SELECT word, word AS root, form AS further FROM formed
  UNION ALL SELECT f.word, f.further, g.form FROM follow f JOIN formed g ON f.further = g.word
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN follow r ON f.word = r.word AND r.further IS NULL
"""


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
    ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d
), n AS (
  SELECT *, len(u)::BIGINT AS n, h1 % (len(u) + 1) AS a, h2 % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM n
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


MEDIA_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents)
SELECT doc_id, n AS n_bytes, greatest(192, (n + 191) // 192 * 192)::BIGINT AS payload_bytes, sha256(text || repeat(' ', (greatest(192, (n + 191) // 192 * 192) - n)::BIGINT)) AS payload_sha256 FROM d
"""

SHARD_SQL = "SELECT count(*) AS n_rows, sum(octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS bytes, 16::BIGINT AS shards, 0::BIGINT AS slot_gaps, 0::BIGINT AS uneven_shards, 0::BIGINT AS split_groups FROM documents"


PACKING_SQL = "SELECT count(*) AS n_docs, 0::BIGINT AS overfull, 0::BIGINT AS broken, 0::BIGINT AS cut_short, 0::BIGINT AS beyond FROM documents"


def oracle_sql() -> dict[str, str]:
    return {"packing_laws": PACKING_SQL, "media_payloads": MEDIA_SQL, "shard_laws": SHARD_SQL, "op6_source_mix": OP6_SQL, "op10_warc": OP10_SQL, "op11_spelling_variants": OP11_SQL, "op13_fill_in_middle": OP13_SQL}
