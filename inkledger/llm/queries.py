"""The registered queries of this folder, and their SQL twins where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkledger.llm import (
    decontaminate,
    line_dedup,
    mask_ranking,
    mixing,
    near_dedup,
    nn_descent,
    notices,
    pair_bitmaps,
    sharding,
    token_counts,
    toxicity,
    url_filter,
    warc_zip,
)
from inkledger.llm.common import load
from inkledger.session import shared_dir

SHARDS = 24
MIX_WEIGHTS = [3.0, 1.0, 2.0]
FOLDS = 5
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Lines in a run that counts as repeated; a long line counts by itself.
LINE_WINDOW = 2
#: A sentencepiece model whose pieces are used (its scores are merge ranks); another place can be named in the environment.
VOCABULARY = os.environ.get("UNIGRAM_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")

#: The two tokenizers that are aligned; other files can be named in the environment.
BYTE_BPE = os.environ.get("BYTE_BPE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")
PIECE_BPE = os.environ.get("PIECE_BPE_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")
#: Phrases whose exact places are counted, and more notices; about one error in eight letters.
BASE_NOTICES = [notices.Notice("mit license", "mit", 1), notices.Notice("apache license", "apache", 1),
                notices.Notice("general public license", "gpl", 2)]
MORE_NOTICES = [
    notices.Notice("mozilla public license", "mpl", 2), notices.Notice("eclipse public license", "epl", 2), notices.Notice("bsd license", "bsd", 1),
    notices.Notice("licensed under cc by", "cc-by", 2), notices.Notice("creative commons attribution", "cc-by", 3),
    notices.Notice("all rights reserved", "reserved", 2), notices.Notice("permission is hereby granted free of charge", "mit", 5),
    notices.Notice("redistribution and use in source and binary forms", "bsd", 6),
    notices.Notice("released into the public domain", "public-domain", 3), notices.Notice("spdx license identifier", "spdx", 2)]


def crc_of(value: Column) -> Column:
    return F.crc32(value.cast("binary"))


def learnable(key: str = "doc_id") -> Column:
    """Rows whose labels may be learned: the crc32 of the id as text is no multiple of five."""
    return crc_of(F.col(key).cast("string")) % FOLDS != 0


def row_hash() -> Column:
    return F.xxhash64(F.lit(7), F.col("doc_id"), F.col("text"))


def op1_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, and by its aliases where no rule fits."""
    return url_filter.filter_urls(load(spark, sf_dir, "pages"), URL_RULES)


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every 20th vector, by a greedy walk of an NN-descent graph of all vectors."""
    return nn_descent.nearest(load(spark, sf_dir, "embeddings"), 20, 20)


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 24 shards, counts at most one apart."""
    text = F.col("text").cast("binary")
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"))
    placed = sharding.shard_rows(docs, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op4_water_filled_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 3, 1, 2 in turn, share 150 % of all words, at most twice their own."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", row_hash().alias("h"),
                                                   mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(docs, "source", F.col("words"), F.col("h"), MIX_WEIGHTS, 1.5, 2.0)
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "source", "mix.copies")


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by two-word shingles at 80 percent."""
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"), words=2, threshold=80)


def op6_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the vocabulary's pieces, with unigram scores estimated from all documents."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = token_counts.Vocabulary.read(VOCABULARY).without_mark_runs()
    return token_counts.count_tokens(docs, token_counts.estimated(docs, pieces)).select("doc_id", "n_tokens", "n_words")


def op7_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four folds of the labels."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), learn=learnable())
    return toxicity.score(docs, model).select(
        "doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds to 80 percent of its five-word shingles."""
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op9_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stood earlier."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs, LINE_WINDOW).select("doc_id", "n_lines", "n_removed", "text")


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP packages, and the records read back by ranges."""
    manifest = warc_zip.write_packages(load(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return warc_zip.read_packages(manifest).drop("payload", "url")


def op11_fuzzy_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document, with up to the stated errors; exact places of three phrases by themselves."""
    found = notices.scan(load(spark, sf_dir, "documents"), BASE_NOTICES + MORE_NOTICES)
    return notices.summary(found, [n.words for n in BASE_NOTICES])


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under two tokenizers, where they end together, and what these pairs count in all documents."""
    return pair_bitmaps.align(load(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)[0]


def op13_mask_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return mask_ranking.rank(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 10)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_redirect_equivalence, op2_nn_descent, op3_feistel_shards, op4_water_filled_mix, op5_lsh_forest,
        op6_trie_token_counts, op7_pu_toxicity, op8_containment, op9_winnowed_lines, op10_zip_warc,
        op11_fuzzy_notices, op12_pair_bitmaps, op13_mask_ranking)}


WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def shingles_sql(table: str, key: str, n: int) -> str:
    """One row per document and distinct shingle; short texts are one shingle."""
    return f"""SELECT DISTINCT {key}, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < {n} THEN [list_aggregate(w, 'string_agg', ' ')]
        ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: list_aggregate(w[i:i + {n - 1}], 'string_agg', ' ')) END) AS shingle
        FROM (SELECT {key}, {WORDS} AS w FROM {table} WHERE {key} IS NOT NULL AND text IS NOT NULL)"""


def _op1_sql() -> str:
    """The rules as one CASE, longest first; pages of the test tables declare no links, so no url has aliases."""
    ranked = sorted(URL_RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ranked]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ranked))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ranked))
    parts = r"regexp_extract(coalesce(url, ''), '^(?:.|\n)*?://([^/?#]*)([^?#]*)'"
    return f"""
WITH p AS (SELECT page_id, translate({parts}, 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host, {parts}, 2) AS path FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE 'allow' END AS verdict, false AS aliased FROM p"""


def _op9_sql(w: int) -> str:
    window = " || chr(10) || ".join(f"lead(line, {k}) OVER doc" for k in range(w))
    return f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
           FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM l),
g AS (SELECT doc_id, pos, {window} AS gram FROM t WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS turn FROM g WHERE replace(gram, chr(10), '') <> ''),
u AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS turn FROM t
      WHERE len(regexp_extract_all(line, '{line_dedup.WORD}')) >= {line_dedup.LONG}),
gone AS (SELECT doc_id, pos + k AS pos FROM r, range({w}) AS s(k) WHERE turn > 1 UNION SELECT doc_id, pos FROM u WHERE turn > 1),
o AS (SELECT t.doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
             coalesce(string_agg(raw, chr(10) ORDER BY t.pos) FILTER (gone.pos IS NULL), '') AS text
      FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.pos = t.pos GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_removed, 0) AS n_removed, o.text
FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id"""


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGEST = " || ".join(
    f"list_aggregate(list_transform(range(8), lambda k: '{_BASE32}'[1 + ((('0x' || digest[{at}:{at + 9}])::BIGINT >> (35 - 5 * k)) & 31)]), 'string_agg', '')"
    for at in (1, 11, 21, 31))
_OP10_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT digest, max(page_id) AS origin FROM p GROUP BY digest)
SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest,
       CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> origin THEN origin END AS refers_to
FROM p JOIN g USING (digest)"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w)) AS n_terms FROM d),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM i) GROUP BY term),
s AS (SELECT item_id, r, doc_id, sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS score
      FROM i JOIN f USING (term) JOIN p USING (term), c GROUP BY item_id, r, doc_id),
t AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM t WHERE rank <= 10"""


def oracles() -> dict[str, str]:
    return {
        "op1_redirect_equivalence": _op1_sql(),
        "op9_winnowed_lines": _op9_sql(LINE_WINDOW),
        "op10_zip_warc": _OP10_SQL,
        "op13_mask_ranking": _OP13_SQL,
        "op5_lsh_forest": f"""
WITH RECURSIVE sh AS ({shingles_sql("documents", "doc_id", 2)}),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
          JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, sa.n, sb.n HAVING 100 * count(*) >= 80 * (sa.n + sb.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least l ON l.x = d.doc_id""",
        "op8_containment": f"""
WITH d AS ({shingles_sql("documents", "doc_id", 5)}), b AS ({shingles_sql("benchmark", "item_id", 5)}),
sizes AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT d.doc_id, b.item_id, count(*) AS n_shared, s.n_item FROM d JOIN b ON d.shingle = b.shingle
JOIN sizes s ON s.item_id = b.item_id GROUP BY d.doc_id, b.item_id, s.n_item HAVING 100 * count(*) >= 80 * s.n_item""",
    }
