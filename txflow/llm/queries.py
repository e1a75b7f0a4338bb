"""The operators over the given tables, with their production parameters, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm import bpe, byte_dedup, conversations, decontaminate, language, line_dedup, near_dedup, toxicity, warc, word_dedup
from txflow.llm.common import stored, table, text_or_empty
from txflow.llm.exact_dedup import exact_classes
from txflow.llm.sharding import assign_shards
from txflow.llm.spelling import spelling_variants
from txflow.session import scratch_dir


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_dedup.drop_repeated_bytes(table(spark, sf_dir, "documents"), digests=True)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), shards=16)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), name="found")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def ranks_file() -> str:
    """The public rank file that the contract names; it stays where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_rows(docs: DataFrame, ranks: str) -> DataFrame:
    """Digests of the token ids of each text, and of what they decode to."""
    vocab = bpe.vocabulary(ranks)
    done = docs.select("doc_id", bpe.round_trip(text_or_empty("text"), vocab).alias("done"))
    return done.select(
        "doc_id", F.size("done.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("done.ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("done.bytes", 256).alias("decoded_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(table(spark, sf_dir, "documents"), ranks_file())


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_dir(spark, "archives")
    warc.write_archives(warc.plan_records(pages), folder)
    chunks = warc.read_archives(spark, folder, with_data=False)
    kind = pages.schema["page_id"].dataType
    return chunks.where("last").select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_dedup.drop_repeated_words(table(spark, sf_dir, "documents"), digests=True)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = stored(conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations"))), "repaired")
    return conversations.text_digests(repaired).select("conv_id", "report.*", "repaired_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_decontaminate": op4_decontaminate,
    "op5_language_id": op5_language_id,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_near_dedup": op7_near_dedup,
    "op8_warc": op8_warc,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_conversations": op12_conversations,
    "op13_spelling_variants": op13_spelling_variants,
}

def _crc32(listed: str) -> str:
    """The unsigned CRC-32 of a list of byte values; ``crc`` (see _CRC) has to be joined."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], {listed}),
                lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"""


#: The table of remainders.
_CRC = """crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _edit(path: str, cost: str, letter: str) -> str:
    """A path is the cost in nine digits, then the edits: the least string is the best path."""
    return f"printf('%09d', ({path})[1:9]::INT + {cost}) || ({path})[10:] || '{letter}'"


def _repair_sql() -> str:
    user = f"least(p2, {_edit('p0', '3', 'I')}, {_edit('p1', '3', 'I')}, {_edit('p3', '3', 'I')})"
    assistant = f"least(p3, {_edit('u', '3', 'I')})"
    late = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"

    def taken(path: str, initial: str) -> str:
        return (f"CASE WHEN fault IN ('blank', 'duplicate') THEN NULL WHEN initial = '{initial}' THEN {_edit(path, late, 'K')} "
                f"ELSE {_edit(path, '3 + ' + late, 'R')} END")

    system = f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = 's' THEN {_edit('p0', late, 'K')} END"
    return rf"""
        WITH RECURSIVE {_CRC},
        keyed AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        kinds AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc32("list_transform(string_split(k, ''), lambda x: unicode(x)::BIGINT)")} % 20 AS kind FROM keyed, crc),
        damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                    FROM kinds, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS s(copy) WHERE kind <> 0),
        placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                                left(role, 1) AS initial FROM damaged),
        judged AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
                      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                      WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault,
                      lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
        paths AS (
            SELECT conv_id, 0::BIGINT AS i, '000000000' AS p0, NULL::VARCHAR AS p1, NULL::VARCHAR AS p2, NULL::VARCHAR AS p3
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT conv_id, i + 1, {_edit('p0', '4', 'D')}, least({_edit('p1', '4', 'D')}, {system}),
                   least({_edit('p2', '4', 'D')}, {taken('least(p0, p1, a)', 'u')}), least({_edit('p3', '4', 'D')}, {taken('u', 'a')})
            FROM (SELECT *, {assistant} AS a FROM (
                  SELECT p.*, j.initial, j.fault, {user} AS u FROM paths p JOIN judged j ON j.conv_id = p.conv_id AND j.i = p.i + 1))),
        best AS MATERIALIZED (SELECT conv_id, least(p0, {assistant}) AS path FROM (SELECT *, {user} AS u FROM paths)
                              QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
        letters AS (SELECT conv_id, p, path[9 + p] AS e FROM best, unnest(generate_series(1, length(path) - 9)) AS s(p)),
        edits AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS place
                  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
        found AS (SELECT e.*, j.role, j.text, max(e = 'K' AND place = 1 AND initial = 's') OVER (PARTITION BY e.conv_id) AS led
                  FROM edits e LEFT JOIN judged j ON j.conv_id = e.conv_id AND j.i = e.i AND e <> 'I' WHERE e <> 'D'),
        made AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place + led::INT) % 2 = 1 THEN 'user'
                     ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired
                 FROM found GROUP BY conv_id),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                       count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                       count(*) FILTER (fault = 'truncated') AS truncated,
                       count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
        SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, path[1:9]::BIGINT AS cost,
               path[10:] AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM best LEFT JOIN counts USING (conv_id) LEFT JOIN made USING (conv_id)"""


ORACLES: dict[str, str] = {
    "op2_line_dedup": r"""
        WITH d AS MATERIALIZED (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
             w AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(l[i:i + 2], chr(10))) AS run
                   FROM d, unnest(generate_series(1, len(l) - 2)) AS s(i)),
             later AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1),
             gone AS (SELECT DISTINCT doc_id, i + k AS p FROM later, unnest([0, 1, 2]) AS s(k)),
             counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
             kept AS (SELECT d.doc_id, string_agg(d.l[p], chr(10) ORDER BY p) AS text
                      FROM d JOIN counts USING (doc_id), unnest(generate_series(1, len(d.l))) AS s(p)
                      WHERE (d.doc_id, p) NOT IN (SELECT doc_id, p FROM gone) GROUP BY d.doc_id)
        SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed,
               CASE WHEN n IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text
        FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    # Windows of every length that items have; documents' runs of words of the same lengths are joined to them.
    "op4_decontaminate": r"""
        WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             item_windows AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), 10) AS n,
                   array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
                   FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s(i) WHERE len(w) > 0),
             lengths AS (SELECT DISTINCT n FROM item_windows),
             runs AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
                      FROM d, lengths, unnest(generate_series(1, len(w) - n + 1)) AS s(i) WHERE len(w) >= n),
             hits AS MATERIALIZED (SELECT doc_id, i, n, item_id FROM runs JOIN item_windows USING (n, run)),
             words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                       FROM hits, unnest(generate_series(i, i + n - 1)) AS s(p) GROUP BY doc_id),
             items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
                       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_warc": r"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
                   FROM pages),
             q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
        FROM q""",
    "op9_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op12_conversations": _repair_sql(),
    # Words one letter apart agree when it is cut out of both; words with one letter more become the other when it is cut out.
    "op13_spelling_variants": rf"""
        WITH RECURSIVE {_CRC},
        runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
                 FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
        hashed AS (SELECT w, n, {_crc32("""flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda x:
                       CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                       ELSE [192 + (unicode(x)::BIGINT >> 6), 128 + (unicode(x)::BIGINT & 63)] END))""")} AS h FROM runs, crc),
        words AS MATERIALIZED (SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w) + 2)::INT)
                                      ELSE w END AS word, sum(n)::BIGINT AS n
                               FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
        cuts AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
                              FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
        pairs AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
                  UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON w.word = c.rest
                  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest),
        best AS (SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
                 QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
        forms AS MATERIALIZED (SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 2 * n),
        chains AS (SELECT word, form AS root, 1 AS steps FROM forms
                   UNION ALL SELECT c.word, f.form, steps + 1 FROM chains c JOIN forms f ON f.word = c.root),
        ends AS (SELECT word, max_by(root, steps) AS root FROM chains GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, w.n, coalesce(n_near, 0) AS n_near, form_n
        FROM words w LEFT JOIN (SELECT word, n_near FROM best) USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)""",
}
