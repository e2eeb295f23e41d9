"""One query for each operator, over its whole table with the operator's own settings, and its SQL where there is one."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm import (
    ann,
    bpe,
    decontam,
    langid,
    line_dedup,
    mixing,
    quality,
    repair,
    simhash,
    spelling,
    suffix_dedup,
    token_counts,
    toxicity,
)
from ringledger.llm.common import held_out, remainder

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = quality.fit_quality(docs, table(spark, folder, "labels"), remainder("doc_id", 5) != 0)
    scored = quality.score_documents(docs, field)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, langid.fit_languages(docs, remainder("doc_id", 4) != 2))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"))


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), PIECES)


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def encoded_digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoded_digests(bpe.encode_documents(table(spark, folder, "documents"), WORD_BPE))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, learn = table(spark, folder, "documents"), remainder("doc_id", 4) != 2
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"), learn, learn)
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.words_of(table(spark, folder, "documents"), errors=True))


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.reports(repair.damaged(table(spark, folder, "conversations")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_line_dedup,
        op3_language,
        op4_neighbours,
        op5_repeats,
        op6_token_counts,
        op7_simhash,
        op8_bpe,
        op9_toxicity,
        op10_decontamination,
        op11_mixing,
        op12_spelling,
        op13_repair,
    )
}

_CASE = f"'{line_dedup.UPPER}', '{line_dedup.LOWER}'"

#: Words of a table's texts; shingles of a given number of words.
_SPLIT = """
    SELECT {id}, list_filter(
        string_split_regex(translate(coalesce(text, ''), {case}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM {table}
"""
_GRAMS = "unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS shingle"


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text of characters below U+0800, bit by bit from the reversed polynomial."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    table_ = f"list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: {step}, i))"
    code = "list_transform(string_split({0}, ''), lambda x: unicode(x))".format(text)
    utf8 = f"flatten(list_transform({code}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))"
    return f"""(SELECT xor(list_reduce({utf8}, lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)
        FROM (SELECT {table_} AS crc) t)"""


def _add(state: str, cost: str, edits: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{edits}'}} END"


def _least(*candidates: str) -> str:
    return f"list_min(list_filter([{', '.join(candidates)}], lambda x: x IS NOT NULL))"


def _when(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN {value} END"


ORACLES: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
        lines AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) AS pos FROM parts),
        keys AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_CASE}) AS key
                 FROM lines),
        shared AS (SELECT key, min(doc_id) AS keeper FROM keys WHERE length(key) >= 10
                   GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        judged AS (SELECT doc_id, line, pos, coalesce(doc_id <> keeper, false) AS gone
                   FROM keys LEFT JOIN shared USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op10_decontamination": f"""
        WITH i AS (SELECT item_id, k, {_GRAMS}
                   FROM (SELECT *, least(5, len(w)) AS k FROM ({_SPLIT.format(id="item_id", table="benchmark", case=_CASE)}))
                   WHERE k > 0),
        d AS (SELECT doc_id, k, {_GRAMS}
              FROM ({_SPLIT.format(id="doc_id", table="documents", case=_CASE)}), (SELECT DISTINCT k FROM i) WHERE len(w) >= k),
        sizes AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
        shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (k, shingle) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
        FROM shared JOIN sizes USING (item_id) WHERE n_shared * 5 >= n_shingles * 4
    """,
    "op12_spelling": f"""
        WITH RECURSIVE said AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS n
            FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '{spelling.RUN}')), {_CASE}) AS run FROM documents)
            GROUP BY doc_id, run),
        hashed AS (SELECT run, n, {_crc32("id || ':' || run")} AS h FROM said),
        words AS (
            SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM hashed),
        vocabulary AS (
            SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cuts AS (
            SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
        pairs AS (
            SELECT DISTINCT c.word AS a, c.n AS a_n, v.word AS b, v.n AS b_n
            FROM cuts c JOIN vocabulary v ON v.word = c.head || c.tail
            UNION ALL
            SELECT c.word, c.n, d.word, d.n FROM cuts c JOIN cuts d ON c.head = d.head AND c.tail = d.tail AND c.word < d.word),
        near AS (SELECT a AS word, a_n AS n, b AS near, b_n AS near_n FROM pairs UNION ALL SELECT b, b_n, a, a_n FROM pairs),
        best AS (
            SELECT word, any_value(n) AS n, count(*) AS n_near, max(near_n) AS near_n,
                   min({{'minus': -near_n, 'form': near}}).form AS form
            FROM near GROUP BY word),
        judged AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN form END AS form,
                   CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
            FROM vocabulary v LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS root FROM judged
            UNION ALL
            SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.root WHERE j.form IS NOT NULL),
        ends AS (SELECT c.word, c.root FROM chain c JOIN judged j ON j.word = c.root WHERE j.form IS NULL)
        SELECT word, n, n_near, form, form_n, root FROM judged JOIN ends USING (word)
    """,
    "op13_repair": f"""
        WITH RECURSIVE damage AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
            FROM conversations),
        dealt AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM damage WHERE kind <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS r
            FROM dealt),
        judged AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
                   lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair
            FROM placed),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) AS n,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id),
        steps AS (
            SELECT conv_id, n, 0::BIGINT AS i, {{'cost': 0::BIGINT, 'audit': ''}} AS s0, NULL::STRUCT(cost BIGINT, audit VARCHAR) AS s1,
                   NULL::STRUCT(cost BIGINT, audit VARCHAR) AS s2, NULL::STRUCT(cost BIGINT, audit VARCHAR) AS s3 FROM counted
            UNION ALL
            SELECT p.conv_id, p.n, p.i + 1, {_add("s0", "3", "D")},
                   {_least(_add("s1", "3", "D"), _when("good AND r = 's'", _add("s0", "late", "K")))},
                   {_least(_add("i2", "3", "D"), *[_when("good AND r = 'u'", _add(s, "late", "K")) for s in ("s0", "s1", "i3")],
                           *[_when("good", _add(s, "2 + late", "R")) for s in ("s0", "s1", "i3")])},
                   {_least(_add("i3", "3", "D"), _when("good AND r = 'a'", _add("i2", "late", "K")),
                           _when("good", _add("i2", "2 + late", "R")))}
            FROM (SELECT *, {_least("s3", _add("s2", "2", "I"), _add("s0", "4", "II"), _add("s1", "4", "II"))} AS i3,
                         {_least("s2", _add("s0", "2", "I"), _add("s1", "2", "I"), _add("s3", "2", "I"))} AS i2 FROM steps) p
            JOIN (SELECT conv_id, i, r, fault NOT IN ('blank', 'duplicate') AS good, (fault = 'truncated')::INT AS late
                  FROM judged) j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1),
        ends AS (
            SELECT conv_id, unnest({_least("s0", "s3", _add("s2", "2", "I"), _add("s1", "4", "II"))})
            FROM steps WHERE i = n),
        letters AS (
            SELECT conv_id, pos, edit, count(*) FILTER (edit <> 'I') OVER upto AS i, count(*) FILTER (edit <> 'D') OVER upto AS number
            FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS pos
                  FROM ends WHERE audit <> '')
            WINDOW upto AS (PARTITION BY conv_id ORDER BY pos)),
        lines AS (
            SELECT l.conv_id, number, edit, j.role, j.text,
                   coalesce(max(CASE WHEN number = 1 AND edit = 'K' AND j.r = 's' THEN 1 ELSE 0 END)
                            OVER (PARTITION BY l.conv_id), 0) AS system
            FROM letters l LEFT JOIN judged j ON l.conv_id IS NOT DISTINCT FROM j.conv_id AND l.i = j.i AND edit <> 'I'
            WHERE edit <> 'D'),
        repaired AS (
            SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (number - system) % 2 = 1 THEN 'user'
                     ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY number) AS text
            FROM lines GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
