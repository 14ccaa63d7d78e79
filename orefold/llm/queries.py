"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import (
    cotraining, fmindex, huffman, imatch, lexical, licences, merkle, packing, pieces, rules, simhash, suffixes, warc)
from orefold.llm.common import documents

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), WORD_VOCABULARY)


def op2_co_training(spark: SparkSession, folder: str) -> DataFrame:
    found = cotraining.classify(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    return found.select("doc_id", "content_score", "metadata_score", "score", "kept")


def op3_fm_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fmindex.remove_repeats(documents(spark, folder)).drop("spans", "text_sha")


def op4_simhash_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op5_huffman_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return huffman.round_trip(documents(spark, folder), BYTE_VOCABULARY).drop("file")


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, folder)).drop("spans")


def op7_sentencepiece_offsets(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.encode_documents(documents(spark, folder), PIECE_MODEL)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.array_max("ends"), F.lit(0)).cast("bigint").alias("n_bytes"))


def op8_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judge(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    return found.select("doc_id", *rules.BASE, "base_failed", "kept", "rule")


def op9_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.derive(warc.responses(spark.read.parquet(f"{folder}/pages.parquet")))
    return records.select(*[c for c in records.columns if c not in ("block", "extra_headers")],
                          F.col("block").cast("string").alias("block"))


def op10_imatch_subsets(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprint_documents(documents(spark, folder))


def op11_ranked_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(documents(spark, folder))
    base = F.array_sort(F.array_distinct(F.transform("base_phrases", lambda p: F.element_at(
        F.create_map(*[F.lit(x) for pair in licences.BASE_PHRASES.items() for x in pair]), p))))
    return found.select(
        "doc_id", "n_words", F.size("base_places").cast("bigint").alias("n_base"), F.array_min("base_places").alias("first_word"),
        F.array_max("base_places").alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
        F.array_join(F.transform("expressions", lambda e: e["text"]), "; ").alias("expressions"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.check_tampering(documents(spark, folder))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                        "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_co_training, op3_fm_index_dedup,
                                  op4_simhash_anchors, op5_huffman_token_files,
                                  op6_suffix_array_dedup, op7_sentencepiece_offsets, op8_decision_list,
                                  op9_warc_derivatives, op10_imatch_subsets, op11_ranked_lexical_search,
                                  op12_license_scans, op13_merkle_manifest)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _hashed(text: str) -> str:
    """Digest of a row of documents with ``text`` in place of its text."""
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END"
             for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return "sha256(" + " || ".join(parts) + ")"


#: crc32 of the decimal doc_id: a bit at a time, eight for each digit (the polynomial is a fixed value).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k:
    CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


def _tree(name: str, first: str) -> str:
    """Recursive SQL from numbered nodes (tree, pos, node) to the roots, and each node's siblings in ``name``_sides."""
    run = "OVER (PARTITION BY tree, level, pos // 8 ORDER BY pos ROWS BETWEEN"
    return f"""{name} AS (
      SELECT 0 AS level, tree, pos, node, count(*) OVER (PARTITION BY tree) AS total FROM ({first})
      UNION ALL
      SELECT level + 1, tree, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), CAST((any_value(total) + 7) // 8 AS BIGINT)
      FROM {name} WHERE total > 1 GROUP BY level, tree, pos // 8),
    {name}_sides AS (SELECT *, coalesce(string_agg(node, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
      coalesce(string_agg(node, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name})"""


def _climb(name: str, first: str, sides: str) -> str:
    return f"""{name} AS (SELECT 0 AS level, id, tree, pos, proof, node FROM ({first})
      UNION ALL SELECT c.level + 1, c.id, c.tree, c.pos // 8, c.proof || s.b || s.a, sha256(s.b || c.node || s.a)
      FROM {name} c JOIN {sides}_sides s ON c.level = s.level AND c.tree = s.tree AND c.pos = s.pos WHERE s.total > 1),
    {name}_top AS (SELECT id, tree, proof, node FROM {name} QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1)"""


ORACLE: dict[str, str] = {
    "op3_fm_index_dedup": r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
      words AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d),
      grams AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d),
      windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g FROM grams),
      firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
      hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (g) WHERE least < doc_id),
      gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(13) t(k)),
      kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS body, count(*) AS n FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
      SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(body, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_ranked_lexical_search": f"""WITH
      d AS (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE len({_TERMS}) > 0),
      held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
      sizes AS (SELECT doc_id, len(terms) AS n, (SELECT count(*) FROM d) AS docs, (SELECT sum(len(terms)) FROM d)::BIGINT AS total FROM d),
      weights AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT count(*) FROM d) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM held GROUP BY term),
      asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
      scored AS (SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))
        AS BIGINT) AS score FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id)
      SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM scored WHERE score > 0 QUALIFY rank <= 20""",
    "op13_merkle_manifest": f"""WITH RECURSIVE
      leaves AS (SELECT doc_id, lang, {_hashed('text')} AS leaf,
        CASE WHEN {_CRC} % 3 = 0 THEN {_hashed(_LOWER.format('text'))} ELSE {_hashed('text')} END AS found FROM documents),
      placed AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
        dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
      {_tree('low', 'SELECT tree, pos, leaf AS node FROM placed')},
      {_tree('high', 'SELECT 0 AS tree, tree AS pos, node FROM low WHERE total = 1')},
      {_climb('up', "SELECT id, tree, pos, '' AS proof, found AS node FROM placed", 'low')},
      {_climb('over', 'SELECT id, 0 AS tree, tree AS pos, proof, node FROM up_top', 'high')}
      SELECT p.doc_id, p.leaf, l.node AS subroot, h.node AS root, sha256(o.proof) AS proof_sha256, o.node AS folded_root,
        o.node = h.node AS verified
      FROM placed p JOIN low l ON l.tree = p.tree AND l.total = 1 JOIN over_top o ON o.id = p.id JOIN high h ON h.total = 1""",
}
