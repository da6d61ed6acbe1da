"""The registered queries of the text operators, and SQL twins where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.context import scratch_path

from . import chat, decontaminate, exact_dedup, fill_middle, hard_negatives, html_text, language_id, line_dedup, packing, quality, secret_scan, simhash, warc
from .common import table

Q, SQL = {}, {}


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op3_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN s USING (doc_id)
"""


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


SQL["op4_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
g AS (SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""


def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    path, pages = scratch_path(spark, "warc"), table(spark, folder, "pages")
    warc.write_archives(pages, path)
    id_type = pages.schema["page_id"].dataType
    # A response counts as read back only if its digest is that of the bytes read; a revisit has the headers alone.
    intact = F.col("verified") | (F.col("record_type") == "revisit")
    records = warc.read_archives(spark, path, record_type=["response", "revisit"])
    return records.select(
        F.nullif(F.col("record_id"), F.lit("")).cast(id_type).alias("page_id"),  # a null id is written as an empty one
        F.coalesce(F.length("payload").cast("long"), F.col("payload_length")).alias("payload_bytes"),
        F.when(intact, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest"),
        "record_type",
        F.nullif(F.col("refers_to"), F.lit("")).cast(id_type).alias("refers_to"),
    )


SQL["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS sha, max(page_id) OVER (PARTITION BY html) AS last_id FROM p),
g AS (SELECT *, unnest(generate_series(0, 3)) AS i FROM d),
c AS (SELECT page_id, n, last_id, i, CAST('0x' || substr(sha, CAST(10 * i + 1 AS BIGINT), 10) AS UBIGINT) AS x FROM g)
SELECT page_id, n AS payload_bytes,
       string_agg((SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> (35 - 5 * k)) & 31 AS BIGINT) + 1, 1), '' ORDER BY k) FROM range(8) AS r(k)), '' ORDER BY i) AS payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM c GROUP BY page_id, n, last_id
"""


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(table(spark, folder, "documents"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    template = chat.DIALOGUE
    read = chat.format_conversations(turns, template).select(
        "conv_id",
        chat.read_back(F.col("formatted"), template).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"], template)), "").alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.col("bad_position").cast("long").alias("bad_position"),
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
        "bad_position",
    )


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, '{chat.DIALOGUE.escape}', '{chat.DIALOGUE.escape}0')"
    for i, control in enumerate(chat.DIALOGUE.controls, 1):
        out = f"replace({out}, '{control}', '{chat.DIALOGUE.escape}{i}')"
    return out


SQL["op9_chat_format"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT conv_id, role, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY conv_id) AS n, coalesce(lag(role) OVER w, 'start') AS state
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
m(state, role) AS (VALUES ('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')),
b AS (SELECT conv_id, coalesce(min(CASE WHEN m.role IS NULL THEN place END), max(CASE WHEN place = n - 1 AND o.role <> 'assistant' THEN n END)) AS bad_position
      FROM o LEFT JOIN m ON m.state = o.state AND m.role = o.role GROUP BY conv_id)
SELECT conv_id, any_value(bad_position) IS NULL AS valid, any_value(bad_position) AS bad_position, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|') + length({_escaped_sql("role")}) + length('|>' || chr(10)) + length({_escaped_sql("text")}) + length('<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM t JOIN b USING (conv_id) GROUP BY conv_id
"""


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


SQL["op11_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, folder, "documents")).drop("kept_text")


SQL["op12_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM l),
r AS (SELECT body, max(doc_id) AS stays FROM k WHERE length(body) >= 20 GROUP BY body HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, stays IS NOT NULL AND doc_id <> stays AS gone FROM k LEFT JOIN r USING (body))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_in_middle(table(spark, folder, "documents"))


SQL["op13_fill_middle"] = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
x AS (SELECT *, CAST('0x' || h[1:8] AS UBIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS UBIGINT) % (n + 1) AS c2,
             CAST('0x' || h[17:24] AS UBIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS UBIGINT) % 100 AS h4 FROM h),
f AS (SELECT *, CAST(least(c1, c2) AS BIGINT) AS a, CAST(greatest(c1, c2) AS BIGINT) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
                        ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""


_REGISTERED = (
    op1_html_text, op2_quality, op3_decontaminate, op4_exact_dedup, op5_pack, op6_simhash, op7_warc, op8_secret_scan, op9_chat_format, op10_language_id,
    op11_hard_negatives, op12_line_dedup, op13_fill_middle,
)
Q.update({f.__name__: f for f in _REGISTERED})


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict:
    return dict(SQL)
