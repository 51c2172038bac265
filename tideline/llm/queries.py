"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    chat,
    decontaminate,
    html_text,
    importance,
    language_id,
    mixing,
    near_duplicates,
    quality_classifier,
    quality_rules,
    secrets,
    spelling,
    toxicity,
    warc,
)
from tideline.llm.samples import held_out
from tideline.llm.workers import importable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; the nearest one also where the operator rejects."""
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "distance", "rejected")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds."""
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.find_matches(docs, items)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return near_duplicates.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archive, in the order of the merged index."""
    index = warc.archive_index(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts and digest of the known forms, and all spans."""
    docs = _table(spark, sf_dir, "documents")
    found = secrets.find(docs.select("doc_id", "text"), secrets.fit(docs))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    known = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(known), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of every document and what the rules make of it."""
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    counts = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    return judged.select("doc_id", *counts, "base_failed", "kept", "posterior")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.main_text(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels)
    scored = quality_classifier.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, its form and its root."""
    counted = spelling.count_words(_table(spark, sf_dir, "documents"))
    return spelling.group_variants(counted).select("word", "form", "root", "n", "n_near", "form_n")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and its rank if it is drawn."""
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back of every conversation, and of one whose texts look like a template."""
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.render_log(chat.log_of(rows)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_decontaminate,
        op3_toxicity,
        op4_mixing,
        op5_warc,
        op6_secrets,
        op7_quality_rules,
        op8_html_text,
        op9_quality_classifier,
        op10_near_duplicates,
        op11_spelling,
        op12_importance,
        op13_chat,
    )
}

# 40 bits of the digest make 8 characters of base32
_BASE32 = "||".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(sha, {1 + 10 * g}, 10))::UBIGINT >> {35 - 5 * i}"
    "& 31)::INT + 1, 1)"
    for g in range(4)
    for i in range(8)
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# the checksum of a list of bytes, by the table of its polynomial
_CRC_TABLE = (
    "crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"
)


def _crc32(listed: str) -> str:
    step = "xor(c >> 8, t[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {listed}), lambda c, b: {step}), 4294967295)"


def _utf8(text: str) -> str:
    """Bytes of a text."""
    return (
        f"flatten(list_transform(list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT), lambda u: "
        "CASE WHEN u < 128 THEN [u] WHEN u < 2048 THEN [192 + (u >> 6), 128 + (u & 63)] "
        "WHEN u < 65536 THEN [224 + (u >> 12), 128 + ((u >> 6) & 63), 128 + (u & 63)] "
        "ELSE [240 + (u >> 18), 128 + ((u >> 12) & 63), 128 + ((u >> 6) & 63), 128 + (u & 63)] END))"
    )


ORACLES: dict[str, str] = {
    "op11_spelling": rf"""
        WITH RECURSIVE {_CRC_TABLE}, runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id,
                   unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
            FROM documents
        ), grouped AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
        checked AS (SELECT run, n, {_crc32(_utf8("id || ':' || run"))} AS h FROM grouped, crc_table),
        v AS (
            SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT)
                             || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
            FROM checked GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
        ), cut AS (
            SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
        ), near AS (
            SELECT DISTINCT a.word, b.word AS other, b.n AS m
            FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.rest, a.word, a.n FROM cut a SEMI JOIN v ON a.rest = v.word
            UNION SELECT a.word, v.word, v.n FROM cut a JOIN v ON a.rest = v.word
        ), best AS (
            SELECT word, count(*)::BIGINT AS n_near,
                   first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m
            FROM near GROUP BY word
        ), formed AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN m >= 2 * v.n THEN other END AS form, CASE WHEN m >= 2 * v.n THEN m END AS form_n
            FROM v LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
        ), depth AS (
            SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN depth USING (word)""",
    "op4_mixing": r"""
        WITH d AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   CASE WHEN length(text) > 0
                        THEN (length(text) - length(translate(text, '#*$%&|<>!{}[]^~=@_', '')))::DOUBLE / length(text)
                        ELSE 1.0::DOUBLE END AS share
            FROM documents
        ), k AS (
            SELECT doc_id, source, size,
                   -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
                       / 4503599627370496::DOUBLE)
                   / (greatest(1, least(10, ceil(10::DOUBLE * (1::DOUBLE - 4::DOUBLE * share))::INT))::DOUBLE
                      / 10::DOUBLE) AS key
            FROM d
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source
        ), w AS (
            SELECT *, (3 * source_size)::DOUBLE AS cap,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM s
        ), t AS (
            SELECT *, ((sum(source_size) OVER ())::DOUBLE
                       - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
            FROM w
        ), g AS (
            SELECT source, source_size,
                   least(cap, weight * max(CASE WHEN share <= cap / weight THEN share END) OVER ()) AS target
            FROM t
        ), e AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM g
        ), r AS (
            SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
                   floor(e.target)::BIGINT - e.epochs * e.source_size AS budget,
                   coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
        )
        SELECT doc_id, size, source_size, target,
               (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken
        FROM r""",
    "op12_importance": rf"""
        WITH {_CRC_TABLE}, runs AS (
            SELECT d, w FROM (
                SELECT row_number() OVER () AS d, text FROM documents
            ), unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x(w)
        ), wanted AS (
            SELECT unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
        ), hashed AS (
            SELECT w, {_crc32(_utf8("w"))} % 10000 AS bucket
            FROM (SELECT w FROM runs UNION SELECT w FROM wanted), crc_table
        ), own AS (SELECT bucket, count(*) AS n FROM runs JOIN hashed USING (w) GROUP BY bucket),
        other AS (SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (w) GROUP BY bucket),
        gain AS (
            SELECT bucket, floor(1000::DOUBLE * ln(
                       ((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM runs) + 10000))::DOUBLE
                       / ((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM wanted) + 10000))::DOUBLE))::BIGINT AS gain
            FROM own s FULL JOIN other t USING (bucket)
        ), found AS (
            SELECT d, count(*)::BIGINT AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM runs JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY d
        ), scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000::DOUBLE * ln(-ln((
                       ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE
                       + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM (SELECT row_number() OVER () AS d, doc_id FROM documents) LEFT JOIN found USING (d)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST,
                                         n_features, weight) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) AS n
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
        FROM ranked""",
    "op13_chat": rf"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]'
            FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(turn, role)
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum({sum(map(len, (chat.START, chat.END))) + 2} + length(role) + length(text)
                   + len(regexp_extract_all(role, '{chat._MARKED_ROLE.pattern}'))
                   + len(regexp_extract_all(text, '{chat._MARKED.pattern}')))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
    "op5_warc": f"""
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                   sha1(coalesce(html, '')) AS sha
            FROM pages
        ), g AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS last_id FROM p)
        SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM last_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
        FROM g""",
}
