"""Registered queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.llm import chat, decontaminate, infill, jaccard, language_model, mixing, nearest, packing, quality_rules, sharding, warc, weak_quality
from entityforge.llm.columns import let
from entityforge.llm.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 contiguous shards of equal bytes."""
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    packed = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), 2048, 0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1, repeating."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"), (5, 2, 1), 3)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 5-word shingle Jaccard of 0.8 or more."""
    return jaccard.similar_components(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the classifier that weak labels of all documents trained."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = weak_quality.classify_texts(docs, weak_quality.fit_weak(docs)[0])
    return judged.select("doc_id", "quality.*")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the interpolated bigram model of the training documents."""
    return language_model.score_texts(_table(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the base rules and the calibrated model of the labelled rows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge_texts(docs, quality_rules.fit_rules(docs, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "rules.*")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, read back and assembled."""
    scratch = Scratch(spark, "op9")
    warc.write_archives(_table(spark, sf_dir, "pages"), scratch.path("archives"), 0)
    captures = warc.assemble(warc.read_archives(spark, scratch.path("archives"), with_payload=False))
    slim = captures.select(
        F.col("metadata.page_id").alias("page_id"), "main.payload_bytes", "main.payload_digest",
        F.col("main.type").alias("record_type"), "main.record_id", F.col("main.refers_to").alias("target"),
    )
    read = scratch.write(slim, "captures")
    scratch.drop("archives")
    wanted = read.select("target").distinct()
    targets = read.filter("record_type = 'response'").groupBy("record_id").agg(F.max("page_id").alias("refers_to"))
    targets = targets.join(wanted, targets["record_id"] == wanted["target"], "left_semi").withColumnRenamed("record_id", "_id")
    found = read.join(targets, read["target"] == targets["_id"], "left")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 formatted, and read back from the output.

    Turns come as records of three layouts in turn, which their fingerprints tell apart; a role that a
    list layout would rename stays in the flat one.
    """
    hard = "\\### Assistant: </turn> ok"
    own = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    whole = {"ignoreNullFields": "false"}
    flat = F.to_json(F.struct("role", "text"), whole)
    messages = F.to_json(F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")), whole)
    conversations = F.to_json(F.struct(F.array(F.struct(F.col("role").alias("from"), F.col("text").alias("value"))).alias("conversations")), whole)
    kind = F.when(F.coalesce(F.col("role").isin(*chat.ROLES), F.lit(False)), 0).otherwise(F.coalesce(F.pmod("turn", F.lit(3)), F.lit(0)))
    records = rows.select("conv_id", "turn", F.when(kind == 1, messages).when(kind == 2, conversations).otherwise(flat).alias("record"))
    return chat.read_back(chat.format_turns(chat.canonical_turns(records)))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 50th embedding among all embeddings."""
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what they share with the items of the benchmark: spans of ten words, or whole shorter items."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, (F.col("n_hit") > 0).alias("contaminated"), "items")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged for filling in their middle, and restored from the output."""
    made = infill.rearrange(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    both = let(F.col("output"), lambda o: F.struct(digest(o).alias("output_sha256"), digest(infill.restored(F.col("form"), o)).alias("restored_sha256")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", both.alias("both")).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "both.*")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name → (spark, sf_dir) → DataFrame."""
    return {"op1_sharding": op1_sharding, "op2_jaccard": op2_jaccard, "op3_packing": op3_packing, "op4_chat": op4_chat, "op5_quality": op5_quality, "op6_language_model": op6_language_model, "op7_rules": op7_rules, "op8_mixing": op8_mixing, "op9_warc": op9_warc, "op10_nearest": op10_nearest, "op11_decontaminate": op11_decontaminate, "op12_infill": op12_infill}


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"

_OP2 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.c) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, len(s.s)"""

#: The table of CRC-32 by its rule, and the checksum of a text by it.
_CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, list_transform(range(8), lambda k: 0::BIGINT)), "
    "lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"
)
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)), "
    "lambda a, b: xor(a >> 8, c.t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"
)
_OP1 = f"""WITH c AS MATERIALIZED (SELECT {_CRC_TABLE} AS t), d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, octet_length(encode(text)) + 1 AS size, {_CRC} AS crc FROM d, c),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size, crc ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS whole FROM s),
p AS (SELECT *, (8 * (2 * before + size) // (2 * whole))::INT AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, crc) - 1 AS slot, NULL::INT AS grown_shard FROM p"""

_HARD = "'\\### Assistant: </turn> ok'"
_ESCAPED = "replace(replace(replace(text, '\\', '\\\\'), '</turn>', '<\\/turn>'), '### ', '\\#\\#\\# ')"

_OP4 = f"""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', {_HARD} UNION ALL SELECT -7, 1, 'assistant', {_HARD})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
sum(length('### ' || role || ':' || chr(10) || {_ESCAPED} || chr(10) || '</turn>' || chr(10)))::BIGINT AS formatted_chars FROM t GROUP BY conv_id"""

_OP9 = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), d AS (SELECT *, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d"""


_LEAK_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP11 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LEAK_WORDS} AS w FROM documents), i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_LEAK_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda k: array_to_string(w[k:k + 9], ' '))) AS t FROM i WHERE len(w) > 0),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS t FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS p FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT DISTINCT r, n, p, item FROM dw JOIN iw USING (n, t)),
c AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r),
s AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AS contaminated, coalesce(items, []) AS items FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)"""


_OP12 = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, list_transform(range(4), lambda k: ('0x' || substr(h, 8 * k + 1, 8))::BIGINT) AS x FROM d),
c AS (SELECT *, len(u) AS n, least(x[1] % (len(u) + 1), x[2] % (len(u) + 1)) AS a, greatest(x[1] % (len(u) + 1), x[2] % (len(u) + 1)) AS b,
CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 90 THEN 'plain' WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle, coalesce(array_to_string(u[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
sha256(text) AS restored_sha256 FROM p"""


def oracle_sql() -> dict[str, str]:
    """Name → DuckDB SQL. The others rest on fits, random draws, tokenizers or checksums that SQL lacks."""
    return {"op1_sharding": _OP1, "op2_jaccard": _OP2, "op4_chat": _OP4, "op9_warc": _OP9, "op11_decontaminate": _OP11, "op12_infill": _OP12}
