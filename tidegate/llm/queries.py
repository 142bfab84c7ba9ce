"""One query per operator, on the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    decontam,
    hardneg,
    jaccard,
    kneser,
    langid,
    lines,
    merkle,
    mixture,
    nearest,
    pseudonyms,
    shards,
    tokens,
    warc,
)
from tidegate.llm.work import table
from tidegate.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
    return fn


@query
def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict on it."""
    judged = lines.line_quality(spark, table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", *lines.COUNTS, "base_failed", "kept", "n_removed_lines", "n_removed_words"
    )


_LINE_SQL = r"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
base AS (
  SELECT doc_id, source, w, text, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM texts),
raw AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM base),
worded AS (
  SELECT doc_id, source, line,
         regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS lw
  FROM raw),
real_lines AS (SELECT * FROM worded WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM real_lines GROUP BY doc_id),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, n_words - 3)) AS i FROM base WHERE n_words >= 5)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
rep AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice WHERE c > 1) GROUP BY doc_id),
norm AS (
  SELECT doc_id, source, array_to_string(lw, ' ') AS line, sum(len(lw)) AS words
  FROM real_lines GROUP BY ALL),
host AS (SELECT source, 10 + length(bin(count(*))) AS most FROM documents GROUP BY source),
common AS (
  SELECT n.source, n.line, min(n.doc_id) AS keeper
  FROM norm n JOIN host h ON n.source IS NOT DISTINCT FROM h.source
  GROUP BY n.source, n.line, h.most HAVING count(*) > h.most),
gone AS (
  SELECT n.doc_id, count(*) AS n_removed_lines, sum(n.words) AS n_removed_words
  FROM norm n JOIN common c ON n.source IS NOT DISTINCT FROM c.source AND n.line = c.line
  WHERE n.doc_id <> c.keeper GROUP BY n.doc_id),
counts AS (
  SELECT b.doc_id, b.n_words::BIGINT AS n_words, b.word_chars::BIGINT AS word_chars,
         b.n_symbols::BIGINT AS n_symbols, coalesce(d.n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(g.n_removed_lines, 0)::BIGINT AS n_removed_lines,
         coalesce(g.n_removed_words, 0)::BIGINT AS n_removed_words
  FROM base b LEFT JOIN dup d USING (doc_id) LEFT JOIN rep r USING (doc_id) LEFT JOIN gone g USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 10
          AND n_words - n_removed_words >= 0.2 * n_words AS kept
FROM judged
"""
ORACLES["op4_line_quality"] = _LINE_SQL


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count, component and number of links."""
    return jaccard.jaccard_join(spark, table(spark, sf_dir, "documents"))


ORACLES["op5_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number_lower(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
prints AS MATERIALIZED (SELECT doc_id, md5(string_agg(g::VARCHAR, ',' ORDER BY g)) AS p FROM grams GROUP BY doc_id),
reps AS MATERIALIZED (SELECT p, min(doc_id) AS rep, count(*) AS copies FROM prints GROUP BY p),
rare AS MATERIALIZED (
  SELECT g, doc_id FROM grams WHERE doc_id IN (SELECT rep FROM reps)),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach(a, b) AS (
  SELECT rep, rep FROM reps UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (
  SELECT l.a, sum(r.copies) AS d FROM links l JOIN reps r ON r.rep = l.b GROUP BY l.a)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
       coalesce(c.c, w.doc_id) AS component_id,
       coalesce(r.copies - 1 + coalesce(d.d, 0), 0)::BIGINT AS n_links
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN prints p USING (doc_id)
LEFT JOIN reps r ON r.p = p.p LEFT JOIN least_of c ON c.a = r.rep LEFT JOIN degree d ON d.a = r.rep
"""


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the run of words."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.find_leaks(spark, docs, benchmark).drop("row")


@query
def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's size, its source's size and target, and the words the mix takes of it."""
    return mixture.mix(spark, table(spark, sf_dir, "documents")).drop("row")


@query
def op7_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 24, its place there, and its shard among 25."""
    placed = shards.shard_documents(spark, table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place among all ids, its number of ids and their check sum, from the files."""
    path = tokenizer_file("word_bpe_49k.json")
    return tokens.token_round_trip(spark, table(spark, sf_dir, "documents"), path)


@query
def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    return warc.page_round_trip(spark, table(spark, sf_dir, "pages")).drop("url")


ORACLES["op3_warc_archives"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language."""
    return langid.identify(spark, table(spark, sf_dir, "documents"))


@query
def op8_perplexity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's perplexity under a model of the documents labelled good and not toxic."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return kneser.quality(spark, table(spark, sf_dir, "documents"), trusted).drop("row")


#: The key of the tests and queries; a user passes a secret one.
PSEUDONYM_KEY = "not a secret"


@query
def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and counts of what was replaced."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every 50th row and each of its positives the hardest negatives; every 7th row's label is moved on."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hardneg.hard_negatives(spark, rows, F.col("vec_id") % 50 == 0)


ORACLES["op11_hard_negatives"] = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and the root folded from a text that may have lost its line ends."""
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.leaf(*fields, F.col("text")).alias("leaf"),
        merkle.leaf(*fields, tampered).alias("claimed"),
    )
    return merkle.manifest(spark, leaves)


#: The unsigned crc32 of a document's id in decimal; the number is the reversed polynomial of the checksum.
_CRC_SQL = """xor(4294967295, list_reduce(
  [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda crc, b: list_reduce([xor(crc, b)] || range(8),
    lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))))"""


def _merkle_sql(levels: int = 20) -> str:
    """The tree level by level: nodes and, per row, the node above, its siblings and the folded digest."""

    def tree(name: str, base: str, group: str) -> list[str]:
        # (group, place, h) of each level; a lone node goes up as it is.
        out = [f"{name}0 AS ({base})"]
        for k in range(levels):
            out.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT {group}, place // 3 AS place, "
                f"CASE WHEN any_value(alone) THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY place)) END AS h "
                f"FROM (SELECT *, count(*) OVER (PARTITION BY {group}) = 1 AS alone FROM {name}{k}) GROUP BY {group}, place // 3)"
            )
        return out

    def climb(name: str, nodes: str, group: str, base: str) -> list[str]:
        # Per row: place, siblings so far, folded digest.
        out = [f"{name}0 AS ({base})"]
        for k in range(levels):
            out.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (l, r, alone) REPLACE (place // 3 AS place, "
                f"proof || coalesce(l, '') || coalesce(r, '') AS proof, "
                f"CASE WHEN alone THEN folded ELSE sha256(coalesce(l, '') || folded || coalesce(r, '')) END AS folded) "
                f"FROM ("
                f"SELECT p.*, s.l, s.r, s.alone FROM {name}{k} p JOIN ("
                f"SELECT {group}, place, count(*) OVER (PARTITION BY {group}) = 1 AS alone, "
                f"string_agg(h, '') OVER (PARTITION BY {group}, place // 3 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, "
                f"string_agg(h, '') OVER (PARTITION BY {group}, place // 3 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r "
                f"FROM {nodes}{k}) s ON p.{group} = s.{group} AND p.place = s.place))"
            )
        return out

    part = lambda c: f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')"
    digest = lambda text: "sha256(" + " || ".join(map(part, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    hit = f"(SELECT doc_id AS i, {_CRC_SQL} % 2 = 0 AS hit FROM documents)"
    steps = [
        f"hits AS {hit}",
        "docs AS MATERIALIZED (SELECT d.*, coalesce('1' || source, '0') AS src, "
        f"{digest('text')} AS leaf, CASE WHEN hit THEN {digest("replace(text, chr(10), '')")} ELSE {digest('text')} END AS claimed "
        "FROM documents d LEFT JOIN hits ON i = doc_id)",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM docs)",
        *tree("n", "SELECT src, place, leaf AS h FROM placed", "src"),
        *climb("c", "n", "src", "SELECT doc_id, source, src, leaf, place, '' AS proof, claimed AS folded, place AS first FROM placed"),
        f"subs AS MATERIALIZED (SELECT src, h AS subroot, 0 AS g, row_number() OVER (ORDER BY src) - 1 AS place FROM n{levels})",
        *tree("t", "SELECT g, place, subroot AS h FROM subs", "g"),
        *climb("u", "t", "g", "SELECT c.* REPLACE (s.place AS place), s.g, s.subroot "
               f"FROM c{levels} c JOIN subs s ON c.src = s.src"),
    ]
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, source, leaf, first AS place, subroot, "
        f"h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified FROM u{levels}, t{levels}"
    )


ORACLES["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every 20th row the 20 nearest others."""
    return nearest.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
