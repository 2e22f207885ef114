"""The registered queries of the text operators and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import (
    chat,
    decontamination,
    html_extract,
    language_id,
    mixing,
    nearest,
    ngram_join,
    packing,
    prefix_trie,
    substring_dedup,
    token_counts,
    url_filter,
    vector_codes,
)

#: The rules of the URL query.
URL_RULES = (
    url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/"),
)
#: A conversation whose texts hold what templates are made of.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), ids=False, added=True)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, model, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    control = spark.range(2).select(F.lit(-7).cast("long"), "id", role, F.lit(CONTROL_TEXT))
    formatted = chat.conversations(chat.thread(said.union(control)))
    turns = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select(
        F.col("tree").alias("conv_id"), "formatted", F.array_join(turns, "").alias("turns"),
        F.size(chat.read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    return read.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", language_id.held_out(F.col("doc_id")).alias("held_out")
    )
    model = language_id.train(docs.where("not held_out"))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, html_extract.train()).withColumn("n_chars", F.length("text").cast("long"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.branched(turns))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), added=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_url_filter": op4_url_filter,
    "op5_nearest": op5_nearest,
    "op6_chat": op6_chat,
    "op7_ngram_join": op7_ngram_join,
    "op8_language_id": op8_language_id,
    "op9_html_extract": op9_html_extract,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_mixing": op13_mixing,
}

def vector_codes_sql(rounds: int) -> str:
    """The same fit over single components, comparing everything with everything."""

    def assigned(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
            SELECT vec_id, part, entry, d FROM (
                SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS d FROM comps JOIN {book} USING (part, i)
                GROUP BY vec_id, part, entry)
            QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""

    steps = []
    for n in range(rounds):
        steps += [assigned(f"taken{n}", f"book{n}"), f"""book{n + 1} AS MATERIALIZED (
            SELECT part, entry, i, coalesce(m, c) AS c FROM book{n} LEFT JOIN (
                SELECT part, entry, i, floor(sum(x) / count(*))::BIGINT AS m
                FROM taken{n} JOIN comps USING (vec_id, part) GROUP BY part, entry, i) USING (part, entry, i))"""]
    return f"""
        WITH kept AS (
            SELECT vec_id, label, embedding, len(embedding) // 8 AS width FROM embeddings
            WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
        comps AS MATERIALIZED (
            SELECT vec_id, i // width AS part, i % width AS i, floor(embedding[i + 1]::DOUBLE * 4096)::BIGINT AS x
            FROM (SELECT *, unnest(range(len(embedding))) AS i FROM kept)),
        book0 AS MATERIALIZED (
            SELECT part, entry, i, x AS c FROM comps
            JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 16) USING (vec_id)),
        {", ".join(steps)},
        {assigned("taken", f"book{rounds}")},
        coded AS (
            SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM taken GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(c, ',' ORDER BY part, entry, i)) FROM book{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)"""


ORACLES: dict[str, str] = {
    "op11_prefix_trie": r"""
        WITH said AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS position, id, bytes
            FROM (SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
                         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS id
                  FROM conversations WHERE conv_id IS NOT NULL)),
        convs AS (  -- crc32, bit by bit
            SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n, xor(list_reduce(
                [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
                lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) % 9 AS h
            FROM said GROUP BY conv_id),
        turns AS (
            SELECT c.conv_id, position, id, bytes FROM convs c JOIN said s ON s.conv_id = c.base WHERE position <= h
            UNION ALL
            SELECT c.conv_id, position - c.h + least(c.h, coalesce(b.n, 0)), id, bytes
            FROM convs c JOIN said s USING (conv_id) LEFT JOIN convs b ON b.conv_id = c.base WHERE position > c.h),
        paths AS (
            SELECT conv_id, position AS depth, bytes, md5(string_agg(id, '') OVER upto) AS key
            FROM turns WINDOW upto AS (PARTITION BY conv_id ORDER BY position)
            UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
        nodes AS (
            SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM paths GROUP BY key, depth),
        linked AS (
            SELECT n.*, p.key AS parent, m.conv_id AS parent_conv_id
            FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
            LEFT JOIN nodes m ON m.key = p.key AND m.depth = p.depth),
        children AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY ALL),
        subtrees AS (  -- every node counts at each node above it, found on the path of its smallest member
            SELECT p.key, p.depth, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.bytes) AS saved
            FROM linked d LEFT JOIN children c ON c.key = d.key AND c.depth = d.depth
            JOIN paths p ON p.conv_id = d.conv_id AND p.depth <= d.depth GROUP BY p.key, p.depth),
        ends AS (
            SELECT key, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths
            WHERE depth = (SELECT max(q.depth) FROM paths q WHERE q.conv_id = paths.conv_id) GROUP BY key, depth)
        SELECT l.conv_id::BIGINT AS conv_id, l.depth::BIGINT AS depth, l.parent_conv_id::BIGINT AS parent_conv_id,
               l.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
               s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM linked l JOIN subtrees s USING (key, depth) LEFT JOIN children c USING (key, depth) LEFT JOIN ends e USING (key, depth)""",
    "op12_vector_codes": vector_codes_sql(vector_codes.ROUNDS),
    "op1_substring_dedup": r"""
        WITH lists AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents),
        placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM lists),
        windows AS (
            SELECT doc_id, word, i,
                   CASE WHEN count(*) OVER following = 50 THEN md5(string_agg(word, ' ') OVER following) END AS key
            FROM placed
            WINDOW following AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
        judged AS (
            SELECT doc_id, word, i, key IS NOT NULL AND min(doc_id) OVER (PARTITION BY key) < doc_id AS repeats
            FROM windows),
        covered AS (
            SELECT doc_id, word, i, max(repeats::INT) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone
            FROM judged),
        kept AS (
            SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
            FROM covered GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM lists LEFT JOIN kept USING (doc_id)""",
    "op6_chat": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        sized AS (
            SELECT *, 22 + sum_of.role_size + sum_of.text_size AS size FROM said, LATERAL (
                SELECT length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS role_size,
                       length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS text_size) AS sum_of)
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(size)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op13_mixing": r"""
        WITH docs AS (
            SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size
            FROM documents),
        sources AS (
            SELECT source, source_size, 3 * source_size AS cap,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)),
        ranked AS (  -- those with the lowest cap for their weight are capped first
            SELECT *, row_number() OVER by_cap AS n, sum(cap) OVER by_cap - cap AS spent,
                   sum(weight) OVER () - sum(weight) OVER by_cap + weight AS free, (SELECT sum(size) FROM docs) AS total
            FROM sources WINDOW by_cap AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
        level AS (SELECT * FROM ranked WHERE weight * (total - spent) <= cap * free ORDER BY n LIMIT 1),
        targets AS (
            SELECT r.source, r.source_size,
                   CASE WHEN r.n < l.n THEN r.cap::DOUBLE
                        ELSE (r.weight * (l.total - l.spent))::DOUBLE / l.free::DOUBLE END AS target
            FROM ranked r, level l),
        placed AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR)[1:15], d.doc_id, d.size
                                     ROWS UNBOUNDED PRECEDING) - d.size AS start
            FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (SELECT sum(greatest(0, least(p * source_size + start + size, quota) - (p * source_size + start)))
                FROM range(3) AS passes(p))::BIGINT AS taken
        FROM placed""",
}
