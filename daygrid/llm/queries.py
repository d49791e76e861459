"""Registered queries of the operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm import (
    bpe,
    chat,
    edit_counts,
    exact_dedup,
    fill_middle,
    knn,
    langid,
    merkle,
    ngram_join,
    packing,
    pii,
    quality,
    substring_dedup,
)
from daygrid.llm.common import prepare, table
from daygrid.session import apply_settings

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_SPECIALS = {"<|endoftext|>": 50256}
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(build):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return build(prepare(apply_settings(spark)), root)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return keep


@query(
    "op1_voronoi_knn",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p : p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def voronoi_knn(spark, root):
    return knn.top_k(table(spark, root, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op2_ngram_join")
def ngram(spark, root):
    return ngram_join.near_groups(table(spark, root, "documents"))


@query("op3_pii")
def personal(spark, root):
    return pii.report(table(spark, root, "documents"))


@query("op4_chat_format")
def chat_format(spark, root):
    rows = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts hold another template's control strings.
    tricky = spark.range(2, numPartitions=1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    messages = rows.unionByName(tricky).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    done = chat.format_messages(messages)
    back = done.withColumns({
        "read": chat.read_back(F.col("formatted")), "learned": chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    })
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def held_out(modulus: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


@query("op5_language")
def language(spark, root):
    docs = table(spark, root, "documents")
    model = langid.fit(docs.where(~held_out(3, 1)))
    out = langid.predict(docs, model)
    return out.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


@query("op6_edit_counts")
def edits(spark, root):
    docs = table(spark, root, "documents")
    return edit_counts.count_edits(docs, BYTE_RANKS, public_tokenizers.PATTERN, BYTE_SPECIALS)


@query("op7_packing")
def packed(spark, root):
    docs = table(spark, root, "documents")
    return packing.pack(docs, BYTE_RANKS, public_tokenizers.PATTERN, BYTE_SPECIALS)


@query("op8_quality")
def quality_scores(spark, root):
    docs = table(spark, root, "documents")
    labels = table(spark, root, "labels").select("doc_id", "quality").where(~held_out(5, 0))
    model = quality.fit(docs.select("doc_id", "text").join(labels, "doc_id"))
    return quality.score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query("op9_bpe")
def bpe_codes(spark, root):
    return bpe.encode_texts(table(spark, root, "documents"), WORD_FILE)


@query(
    "op10_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
            AS text_sha256 FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def exact(spark, root):
    return exact_dedup.dedup(table(spark, root, "documents"))


#: CRC-32 of decimal ids: a table made by its rule, and one step per digit.
CRC_SQL = """
    crc_table AS (
        SELECT list(list_reduce(list_prepend(i, range(8)),
                                lambda c, b : CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
        FROM range(256) t(i)
    ), checked AS (
        SELECT doc_id, xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(1, 1 + length(CAST(doc_id AS VARCHAR))),
                                                    lambda k : CAST(ascii(CAST(doc_id AS VARCHAR)[k]) AS BIGINT))),
            lambda c, b : xor(c >> 8, crc[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) AS crc32
        FROM (SELECT DISTINCT doc_id FROM documents) d, crc_table
    )"""


@query(
    "op11_merkle_manifest",
    f"""
    WITH RECURSIVE {CRC_SQL}, given AS (
        SELECT doc_id, source, concat_ws('', {", ".join(
            f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
            for c in ("doc_id", "source", "lang", "n_chars"))}) AS head, text,
            CASE WHEN crc32 % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS read_text
        FROM documents JOIN checked USING (doc_id)
    ), leaves AS (
        SELECT doc_id, coalesce('s' || source, '-') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
               sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
               sha256(head || CASE WHEN read_text IS NULL THEN '-' ELSE strlen(read_text) || ':' || read_text END) AS read_leaf
        FROM given
    ), nodes AS (
        SELECT 0 AS level, tree, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
        UNION ALL
        SELECT level, tree, pos, digest, count(*) OVER (PARTITION BY tree) AS n
        FROM (SELECT level + 1 AS level, tree, pos // 3 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
              FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 3)
    ), subroots AS (
        SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM nodes WHERE n = 1
    ), tops AS (
        SELECT 0 AS level, pos, subroot AS digest, count(*) OVER () AS n FROM subroots
        UNION ALL
        SELECT level, pos, digest, count(*) OVER () AS n
        FROM (SELECT level + 1 AS level, pos // 3 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
              FROM tops WHERE n > 1 GROUP BY level, pos // 3)
    ), sides AS (
        SELECT c.level, c.tree, c.pos, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < c.pos), '') AS l,
               coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > c.pos), '') AS r
        FROM nodes c JOIN nodes s ON c.level = s.level AND c.tree = s.tree AND c.pos // 3 = s.pos // 3
        WHERE c.n > 1 GROUP BY c.level, c.tree, c.pos
    ), top_sides AS (
        SELECT c.level, c.pos, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < c.pos), '') AS l,
               coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > c.pos), '') AS r
        FROM tops c JOIN tops s ON c.level = s.level AND c.pos // 3 = s.pos // 3
        WHERE c.n > 1 GROUP BY c.level, c.pos
    ), climb AS (
        SELECT doc_id, tree, 0 AS level, pos, read_leaf AS digest, '' AS proof FROM leaves
        UNION ALL
        SELECT doc_id, k.tree, k.level + 1, k.pos // 3, sha256(s.l || k.digest || s.r), k.proof || s.l || s.r
        FROM climb k JOIN sides s ON k.tree = s.tree AND k.level = s.level AND k.pos = s.pos
    ), reached AS (
        SELECT doc_id, tree, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM climb GROUP BY doc_id, tree
    ), climb_top AS (
        SELECT doc_id, 0 AS level, s.pos, digest, proof FROM reached JOIN subroots s USING (tree)
        UNION ALL
        SELECT doc_id, k.level + 1, k.pos // 3, sha256(s.l || k.digest || s.r), k.proof || s.l || s.r
        FROM climb_top k JOIN top_sides s ON k.level = s.level AND k.pos = s.pos
    ), ends AS (
        SELECT doc_id, arg_max(digest, level) AS folded_root, arg_max(proof, level) AS proof FROM climb_top GROUP BY doc_id
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM leaves JOIN subroots USING (tree) JOIN ends USING (doc_id), (SELECT digest AS root FROM tops WHERE n = 1)
    """,
)
def merkle_manifest(spark, root):
    return merkle.report(table(spark, root, "documents"))


@query(
    "op12_substring_dedup",
    r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), starts AS (
        SELECT doc_id, k, sha256(array_to_string(words[k : k + 49], ' ')) AS run
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS k FROM w)
    ), repeated AS (
        SELECT doc_id, k FROM (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY run) AS first FROM starts) WHERE first < doc_id
    ), each AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w
    ), marked AS (
        SELECT e.doc_id, e.k, e.word,
               coalesce(max(r.k) OVER (PARTITION BY e.doc_id ORDER BY e.k), -99) + 49 >= e.k AS gone
        FROM each e LEFT JOIN repeated r ON e.doc_id = r.doc_id AND e.k = r.k
    ), kept AS (
        SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS text
        FROM marked GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """,
)
def substrings(spark, root):
    return substring_dedup.dedup(table(spark, root, "documents"))


@query(
    "op13_fill_middle",
    r"""
    WITH h AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
               regexp_extract_all(coalesce(text, ''), '[^
]*
|[^
]+') AS units FROM documents
    ), k AS (
        SELECT doc_id, text, units, len(units) AS n, list_transform(range(4),
            lambda i : CAST('0x' || substring(h, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS h FROM h
    ), c AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100
                    THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k
    ), p AS (
        SELECT doc_id, text, n, form,
               coalesce(array_to_string(list_filter(units, lambda u, i : i <= a), ''), '') AS prefix,
               coalesce(array_to_string(list_filter(units, lambda u, i : i > a AND i <= b), ''), '') AS middle,
               coalesce(array_to_string(list_filter(units, lambda u, i : i > b), ''), '') AS suffix FROM c
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
    """,
)
def fill_in_middle(spark, root):
    return fill_middle.report(table(spark, root, "documents"))
