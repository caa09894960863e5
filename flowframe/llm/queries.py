"""The operators on the test tables, with the same statement in SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from flowframe.llm.base import Query, table, written
from flowframe.llm.bpe import bpe_decode, bpe_encode
from flowframe.llm.chat import rotate
from flowframe.llm.collocations import best, collocations
from flowframe.llm.exact_dedup import exact_dedup
from flowframe.llm.even_packing import pack_even
from flowframe.llm.html_text import html_text
from flowframe.llm.jaccard_join import jaccard_groups
from flowframe.llm.language import identify, learn, learnable
from flowframe.llm.packing import pack
from flowframe.llm.repair import damaged, digests, faults, judged_rows, repair, texts_of
from flowframe.llm.sharding import shard
from flowframe.llm.topk import top_k
from flowframe.llm.url_filter import rule_table, url_filter

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op3_hypergeometric_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return shard(table(spark, sf_dir, "documents"), ["doc_id"], shards=40).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_bpe_codec")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    decoded = bpe_decode(encoded.select("doc_id", "ids"), path, pattern)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query(
    "op6_url_rules",
    """
    WITH parts AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '(?s)^[^?#]*') ELSE '' END AS rest
      FROM pages
    ), split AS (
      SELECT page_id, translate(split_part(coalesce(rest, ''), '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        substr(coalesce(rest, ''), length(split_part(coalesce(rest, ''), '/', 1)) + 1) AS path FROM parts
    ), rules(verdict, h, p) AS (
      VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
             ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
    ), fits AS (
      SELECT page_id, host, path, h || p AS rule, verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS k
      FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter(table(spark, sf_dir, "pages"), rule_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    "op7_threshold_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    ), r AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
    )
    SELECT * FROM r WHERE rank <= 5
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@query(
    "op10_golomb_dedup",
    """
    WITH d AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    )
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
      doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query(
    "op2_partition_jaccard",
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS g FROM d
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
    ), links AS (
      SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
    ), reach AS (
      SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
    )
    SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query(
    "op1_perspective_rotation",
    r"""
    WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, turn // 256 AS part FROM conversations),
    p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system' AND role <> ''),
    m AS (
      SELECT t.conv_id, perspective, part, turn, role, text, role = perspective AS own,
        '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
          WHEN coalesce(role, '') = '' THEN 'user' ELSE 'user name=' || regexp_replace(role, '[\s<>|]+', '_', 'g') END || chr(10) AS head,
        text || '<|im_end|>' || chr(10) AS body
      FROM t JOIN p USING (conv_id)
    ), o AS (
      SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn, role, text
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins FROM m
    )
    SELECT conv_id, perspective, part, CAST(count(*) AS INT) AS n_turns, string_agg(head || body, '' ORDER BY turn, role, text) AS text,
      coalesce(string_agg(CASE WHEN own THEN CAST(begins AS BIGINT) || '-' || CAST(begins + length(body) AS BIGINT) END, ',' ORDER BY turn, role, text), '') AS mask
    FROM o GROUP BY conv_id, perspective, part
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return rotated.withColumn("mask", F.array_join(spans, ","))


@query("op4_layout_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text")


#: Sequence lengths that packing may use, in characters with an end mark for each piece.
SEQUENCES = (2048, 4096, 8192, 16384, 32768)


@query("op8_variable_best_fit")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), F.length("text"), capacities=SEQUENCES)


@query("op9_zstd_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(learnable()))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (~F.coalesce(learnable(), F.lit(True))).alias("held_out"), "lang_pred", "score", "rejected"
    )


def _repair_sql() -> str:
    """A search forward over the four states, row by row: an entry is its cost, its audit and its lines."""

    def entry(of: str, cost: str, mark: str, line: str | None = None) -> str:
        text = f"{of}.t" if line is None else f"CASE WHEN {of}.t = '' THEN '' ELSE {of}.t || chr(10) END || {line}"
        return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{mark}', 't': {text}}}"

    def least(*entries: str) -> str:
        return f"list_sort([{', '.join(entries)}])[1]"

    def keep(of: str, initial: str) -> str:
        return entry(of, f"(CASE WHEN i = '{initial}' THEN extra ELSE 1000000 END)", "K", "(role || ':' || text)")

    def rename(of: str, role: str) -> str:
        return entry(of, "(1 + extra)", "R", f"('{role}:' || text)")

    def insert(of: str, role: str) -> str:
        return entry(of, "5", "I", f"'{role}:'")

    user = least("s2", insert("s0", "user"), insert("s1", "user"), insert("s3", "user"))
    assistant = least("s3", insert("e2", "assistant"))
    after = [
        entry("s0", "2", "D"),
        least(entry("s1", "2", "D"), keep("s0", "s")),
        least(entry("e2", "2", "D"), *[f(s, x) for s in ("s0", "s1", "e3") for f, x in ((keep, "u"), (rename, "user"))]),
        least(entry("e3", "2", "D"), keep("e2", "a"), rename("e2", "assistant")),
    ]
    nothing = "{'c': 100000000, 'a': '', 't': ''}"
    # DuckDB has no crc32: one byte after the other, bit by bit.
    name = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    by_bit = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce([4294967295] || list_transform(split({name}, ''), lambda c: ord(c)::BIGINT), lambda a, b: {by_bit}), 4294967295)"
    return rf"""
    WITH RECURSIVE lots AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc} % 20 AS lot FROM conversations
    ), kept AS (
      SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN lot = 1 THEN '' WHEN lot = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy FROM lots WHERE lot <> 0
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM kept
    ), judged AS (
      SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
          WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
      FROM numbered
    ), priced AS (
      SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM judged
    ), facts AS (
      SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM judged GROUP BY conv_id
    ), dp AS (
      SELECT conv_id, 0::BIGINT AS pos, {{'c': 0, 'a': '', 't': ''}} AS s0, {nothing} AS s1, {nothing} AS s2, {nothing} AS s3
      FROM (SELECT DISTINCT conv_id FROM conversations)
      UNION ALL
      SELECT conv_id, pos, {', '.join(f'{x} AS s{k}' for k, x in enumerate(after))}
      FROM (SELECT *, {assistant} AS e3 FROM (
        SELECT dp.conv_id, p.pos, s0, s1, s2, s3, i, role, text, extra, {user} AS e2
        FROM dp JOIN priced p ON p.conv_id IS NOT DISTINCT FROM dp.conv_id AND p.pos = dp.pos + 1))
    ), ended AS (
      SELECT conv_id, pos, {least('s0', 'e3')} AS best FROM (SELECT *, {assistant} AS e3 FROM (SELECT *, {user} AS e2 FROM dp))
    )
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
      sha256(best.t) AS repaired_sha256
    FROM ended e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.pos = coalesce(f.n, 0)
    """


@query("op13_prefix_doubling_repair", _repair_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    given = damaged(conversations)
    rows = written(judged_rows(given), "judged")
    edits, costs = repair(rows, texts_of(given))
    found = faults(rows).withColumnRenamed("conv", "key")
    costs = costs.withColumnRenamed("conv", "cost_key")
    done = digests(edits).withColumnRenamed("conv", "done_key")
    every = conversations.select("conv_id").distinct()
    all_facts = (
        every.join(found, F.col("conv_id").eqNullSafe(F.col("key")), "left")
        .join(costs, F.col("conv_id").eqNullSafe(F.col("cost_key")), "left")
        .join(done, F.col("conv_id").eqNullSafe(F.col("done_key")), "left")
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_facts.select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query("op12_differencing_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_even(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query(
    "op11_tiled_collocations",
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents
    ), w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
    grams AS (
      SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS lengths(k) WHERE len(w) >= k
    ), f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
    n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, a, split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
    cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
    scored AS (
      SELECT c.*, l.a AS l, r.a AS r, (1000000 * c.a::HUGEINT * c.a::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT) AS score
      FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:len(c.w)], ' ')
    ), lowest AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS first FROM scored) WHERE first = 1
    ), kept AS (
      SELECT * FROM lowest s WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3) t
        WHERE s.k = 2 AND t.lang = s.lang AND t.part = s.phrase AND 100 * t.a >= 50 * s.a)
    ), placed AS (
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
      FROM kept JOIN n USING (lang)
    )
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best(collocations(table(spark, sf_dir, "documents")), 2000)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
