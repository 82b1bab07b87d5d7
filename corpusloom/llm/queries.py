"""Named queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    chat,
    decontaminate,
    fair_queue,
    hard_negatives,
    importance,
    licenses,
    order_minhash,
    packing,
    range_coder,
    relative_lz,
    simhash,
    token_scan,
    toxicity,
)
from corpusloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_chat_format(spark, sf):
    return chat.format_chats(table(spark, sf, "conversations"))


@query
def op2_simhash_near_dedup(spark, sf):
    near = simhash.near_components(table(spark, sf, "documents"), shingle=3, max_bits=2)
    return near.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_order_minhash(spark, sf):
    return order_minhash.compare_edits(table(spark, sf, "documents"))


@query
def op4_token_counts(spark, sf):
    """Document lengths in tokens, from flat token files without an index."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_scan.document_token_counts(table(spark, sf, "documents"), path)


@query
def op5_best_fit_packing(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf, "documents"), path, end_id=1, capacity=4096)


@query
def op6_license_scan(spark, sf):
    return licenses.scan_documents(table(spark, sf, "documents"))


@query
def op7_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score_documents(docs, model)


@query
def op8_token_files(spark, sf):
    """Documents written to range-coded files in doc_id order, then read from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    files = range_coder.write_token_files(table(spark, sf, "documents"), path, end_id=0)
    return range_coder.read_token_files(files)


@query
def op9_decontaminate(spark, sf):
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query
def op10_substring_dedup(spark, sf):
    cut = relative_lz.remove_repeats(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_hard_negatives(spark, sf):
    """Every hundredth embedding against all others; a seventh of the labels is moved on by one."""
    rows = hard_negatives.integer_rows(table(spark, sf, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


@query
def op12_fair_mix(spark, sf):
    mixed = fair_queue.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op13_importance_resampling(spark, sf):
    return importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DOC_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op1_chat_format": """
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations),
        c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS turns, count(*) AS n FROM t GROUP BY conv_id),
        p AS (SELECT DISTINCT turns[1:i] AS turns FROM (SELECT turns, unnest(range(1, n)) AS i FROM c)),
        kept AS (SELECT min(conv_id) AS conv_id FROM c ANTI JOIN p ON c.turns = p.turns GROUP BY c.turns)
        SELECT conv_id, (pos - 1) // 64 AS part, count(*) AS n_turns,
            string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY pos) AS text
        FROM t SEMI JOIN kept ON t.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL""",
    "op9_decontaminate": f"""
        WITH i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
        iw AS (SELECT DISTINCT item_id, w[k:k+12] AS s FROM
            (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
        d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT len(s) AS m FROM iw),
        dw AS (SELECT doc_id, k, w[k:k+m-1] AS s FROM
            (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, sizes)),
        hit AS (SELECT DISTINCT doc_id, k, len(dw.s) AS m, item_id FROM dw JOIN iw ON dw.s = iw.s),
        n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
            (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hit) GROUP BY doc_id),
        who AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM
            (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN who USING (doc_id)""",
    "op10_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_DOC_WORDS} AS w FROM documents),
        s AS (SELECT doc_id, k, array_to_string(w[k:k+34], ' ') AS s FROM
            (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d)),
        twice AS (SELECT s FROM s GROUP BY s HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM s SEMI JOIN twice ON s.s = twice.s),
        per AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
        left_ AS (SELECT d.doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM
            (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) d
            ANTI JOIN gone ON d.doc_id = gone.doc_id AND d.p = gone.p GROUP BY d.doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN per USING (doc_id) LEFT JOIN left_ USING (doc_id)""",
    "op11_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                list_inner_product(a.v, b.v)::BIGINT AS score
            FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score,
            score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10""",
    "op12_fair_mix": f"""
        WITH d AS (SELECT doc_id, source, len({_DOC_WORDS}) AS size FROM documents),
        src AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
            FROM d GROUP BY source),
        w AS (SELECT *, (rank % 3 + 1)::DOUBLE AS weight, 3.0::DOUBLE * n AS lim FROM src),
        f AS (SELECT *, lim * (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))
                <= weight * (sum(n) OVER () - coalesce(sum(lim) OVER o, 0)) AS stops
            FROM w WINDOW o AS (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, rank, n, CASE WHEN stops THEN lim ELSE weight
                * (sum(n) OVER () - coalesce(sum(lim) FILTER (stops) OVER (), 0))::DOUBLE
                / greatest(sum(weight) OVER () - coalesce(sum(weight) FILTER (stops) OVER (), 0), 1) END AS target FROM f),
        q AS (SELECT d.doc_id, d.size, t.rank, t.n, t.target, row_number() OVER o AS place,
                (sum(size) OVER o - size)::BIGINT AS sent
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
            WINDOW o AS (PARTITION BY t.rank ORDER BY md5('2024:' || coalesce(d.doc_id::VARCHAR, '')),
                d.doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        pk AS (SELECT *, least(1024, size - 1024 * part) AS words,
                (turn * n + sent + least(1024 * (part + 1), size))::DOUBLE / target AS finish
            FROM (SELECT *, unnest(range((size + 1023) // 1024)) AS part FROM q), range(3) r(turn) WHERE target > 0),
        st AS (SELECT rank, place, words, (sum(words) OVER (ORDER BY finish, rank, turn, place, part
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - words)::BIGINT AS before FROM pk),
        got AS (SELECT rank, place, sum(least(words, b - before))::BIGINT AS taken
            FROM st, (SELECT sum(n) AS b FROM src) WHERE before < b GROUP BY rank, place)
        SELECT doc_id, size, n AS source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN got USING (rank, place)""",
    "op13_importance_resampling": f"""
        WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
        f AS (SELECT r AS r, unnest(w) AS word FROM d UNION ALL
            SELECT 0 AS r, unnest({_ITEM_WORDS}) AS word FROM benchmark),
        b AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(word)),
                lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT word FROM f), crc),
        n AS (SELECT bucket, count(*) FILTER (r > 0) AS s, count(*) FILTER (r = 0) AS t FROM f JOIN b USING (word) GROUP BY bucket),
        g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)
            / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000))))::BIGINT AS gain FROM n),
        wt AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE r > 0 GROUP BY r),
        sc AS (SELECT r, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
                (('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM d LEFT JOIN wt USING (r)),
        k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank,
            10 * count(*) OVER () // 100 AS drawn FROM sc WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM sc LEFT JOIN k USING (r)""",
}
