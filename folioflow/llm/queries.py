"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm import collocations, decontaminate, group_join, hilbert, html_extract, line_dedup, mixing, perplexity, prefix_trie, quality, secret_scan, simhash, token_blocks
from folioflow.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    base = [k.name for k in secret_scan.KINDS[:3]]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *map(count, base),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@_query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


@_query
def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = hilbert.shard(_table(spark, sf_dir, "documents"), ["source", "lang", "n_chars"], shards=8, law="rows")
    text = F.coalesce("row.text", F.lit(""))
    return sharded.select(
        "row.doc_id", "size", F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    """The public tokenizer file; executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = cut_lineage(token_blocks.encode(_table(spark, sf_dir, "documents"), tokenizer_path()))
    return token_blocks.read(segments)


MIX_SEED = 2024


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square-root weights: the hot source is thinned and the small ones are repeated."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), temperature=0.5, seed=MIX_SEED)
    return mixed.select(
        "row.doc_id", "row.source", "copy", F.octet_length(F.coalesce("row.text", F.lit(""))).cast("bigint").alias("size"),
        F.md5(F.coalesce("row.text", F.lit(""))).alias("text_md5"),
    )


ORACLES["op10_mixing"] = f"""
WITH sized AS (
    SELECT source, doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) AS size FROM documents
), sources AS (
    SELECT source, sum(size)::DOUBLE AS bytes, pow(sum(size)::DOUBLE, 0.5) AS weight FROM sized GROUP BY source
), rates AS (
    SELECT source, CASE WHEN bytes > 0
        THEN sum(bytes) OVER () * weight / sum(CASE WHEN bytes > 0 THEN weight END) OVER () / bytes
        ELSE 1.0 END AS rate FROM sources
), parts AS (
    SELECT d.*, r.rate / greatest(1, ceil(r.rate / {mixing.PART})) AS mean,
        unnest(range(1, greatest(1, ceil(r.rate / {mixing.PART}))::BIGINT + 1)) AS part,
        coalesce(d.doc_id::VARCHAR, '') || ':' || md5(d.text) AS identity
    FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), drawn AS (
    SELECT *, ('0x' || substr(md5('{MIX_SEED}:' || part || ':' || identity), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM parts
), counted AS (
    SELECT doc_id, source, size, text, sum(list_sum(list_transform(range(0, {mixing._TERMS}), lambda k: CASE WHEN u >=
        list_sum(list_transform(range(0, k + 1), lambda j: exp(j * ln(mean) - mean - lgamma(j + 1)))) THEN 1 ELSE 0 END)
    ))::BIGINT AS n
    FROM drawn GROUP BY doc_id, source, size, text, identity
)
SELECT doc_id, source, unnest(range(1, n + 1))::INT AS copy, size, md5(text) AS text_md5 FROM counted
"""


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("content")


_TRIMMED = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
ORACLES["op7_line_dedup"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), split AS (
    SELECT r, doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM docs
), keyed AS (
    SELECT *, translate(trim(line, {_TRIMMED}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split
), shared AS (
    SELECT key AS gone FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared ON key = gone GROUP BY r, doc_id
"""


@_query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(_table(spark, sf_dir, "pages"), "page_id", "html", "url")
    return pages.select(F.col("doc_id").alias("page_id"), "url", "text", "n_chars")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learned from the labelled rows of ``docs`` that are not held out."""
    return quality.fit(quality.labels_of(docs, _table(spark, sf_dir, "labels")))


@_query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(
        docs, quality_model(spark, docs, sf_dir), "doc_id", "text", quality.held_out(F.col("doc_id")).alias("held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@_query
def op9_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *perplexity.COUNTS, "base_failed", "kept", "lang", "bits")


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), starts AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), spans AS (
    SELECT lang, words[i:i + m - 1] AS w FROM starts, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(words)
), f AS (
    SELECT lang, w, count(*) AS f FROM spans GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(w) = 1 GROUP BY lang
), candidates AS (
    SELECT lang, w, f AS a FROM f WHERE len(w) > 1 AND f >= 30
), cuts AS (
    SELECT c.*, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, len(w))) AS k FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1:]
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), within AS (
    SELECT lang, w[i:i + m - 1] AS w, max(a) AS longer
    FROM (SELECT *, unnest(range(1, len(w))) AS i FROM candidates) c, (SELECT unnest([2, 3]) AS m)
    WHERE m < len(w) AND i + m - 1 <= len(w) GROUP BY ALL
), ranked AS (
    SELECT s.*, array_to_string(s.w, ' ') AS phrase,
        row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(s.w, ' ')) AS rank
    FROM scored s LEFT JOIN within b ON b.lang = s.lang AND b.w = s.w
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.with_shared_heads(prefix_trie.turns(_table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(convs).drop("node")


_CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))"""
ORACLES["op12_prefix_trie"] = f"""
WITH said AS (
    SELECT conv_id, turn, sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS key,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, list(key ORDER BY turn NULLS FIRST, left(key, 32)) AS keys, list(words ORDER BY turn NULLS FIRST, left(key, 32)) AS words,
        any_value({_CRC32.format("conv_id::VARCHAR")} % 4) AS h
    FROM said GROUP BY conv_id
), built AS (
    SELECT c.conv_id, list_concat(coalesce(b.keys[1:c.h], []), c.keys[c.h + 1:]) AS keys,
        list_concat(coalesce(b.words[1:c.h], []), c.words[c.h + 1:]) AS words
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
), steps AS (
    SELECT *, unnest(range(0, len(keys) + 1)) AS depth FROM built
), nodes AS (
    SELECT array_to_string(keys[1:depth], '') AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(CASE WHEN depth > 0 THEN words[depth] ELSE 0 END) AS own,
        sha256(coalesce(string_agg(CASE WHEN depth = len(keys) THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM steps GROUP BY 1, 2
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, 64 * (n.depth - 1)::INT)
), children AS (
    SELECT left(node, 64 * (depth - 1)::INT) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), above AS (
    SELECT n.n_convs, n.own, (c.node IS NULL)::INT AS leaf, left(n.node, 64 * k::INT) AS node
    FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM nodes) n LEFT JOIN children c ON c.node = n.node
), below AS (
    SELECT node, sum(leaf)::BIGINT AS n_leaves, sum((n_convs - 1) * own)::BIGINT AS saved_tokens FROM above GROUP BY node
)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, l.ends_sha256
FROM linked l LEFT JOIN children c ON c.node = l.node JOIN below b ON b.node = l.node
"""


@_query
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.similar(_table(spark, sf_dir, "documents")).drop("digest")


ORACLES["op13_ngram_jaccard_join"] = """
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(1, len(words) - 2) + 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS s
    FROM docs
), tokens AS (
    SELECT r, len(s) AS n, unnest(s) AS token FROM sets
), linked AS (
    SELECT a.r AS a, b.r AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.r <> b.r
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
    SELECT r, r AS s FROM sets UNION SELECT reach.r, linked.b AS s FROM reach JOIN linked ON linked.a = reach.s
)
SELECT x.doc_id, len(x.s)::BIGINT AS n_shingles, min(y.doc_id) AS component_id
FROM sets x JOIN reach ON reach.r = x.r JOIN sets y ON y.r = reach.s GROUP BY x.r, x.doc_id, x.s
"""
