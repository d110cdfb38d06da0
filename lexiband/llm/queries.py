"""The queries of the operators, with the SQL that DuckDB checks them by where it can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiband.llm import (
    chat,
    content_sort,
    html,
    manifest,
    mixing,
    packing,
    phrases,
    quality,
    sharding,
    simhash,
    sketches,
    token_counts,
    toxicity,
)

ALPHA, SHARDS = 0.9, 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixing_dimensions() -> dict[str, Column]:
    """Source, language, and a topic told by what a text has in it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    topic = (
        F.when(text.rlike("[Ll]icensed? under"), "license")
        .when(text.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]|\(\d{3}\) \d{3}-\d{4}|\d+\.\d+\.\d+\.\d+"), "contact")
        .when(text.rlike("&&&|###|\\*\\*\\*|!!"), "symbols")
        .otherwise("prose")
    )
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = mixing_dimensions()
    # Its SQL divides by the largest ratio.
    columns = ["doc_id", "source", "lang"]
    drawn = mixing.mixed(_table(spark, sf_dir, "documents"), dims, alpha=ALPHA, exact=True, keep=columns)
    return drawn.select(
        "doc.doc_id",
        "doc.source",
        "doc.lang",
        "tokens",
        F.round("weight", 4).alias("weight"),
        F.round("probability", 8).alias("probability"),
        "kept",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.duplicate_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What copies of one text have in common, so that they stay together where they can.
    bytes_a_char = F.octet_length(F.col("text")) / F.greatest(F.char_length(F.col("text")), F.lit(1))
    dims = {
        "chars": sharding.quantity(F.char_length(F.col("text"))),
        "lang": sharding.ordinal(F.col("lang")),
        "script": sharding.quantity(bytes_a_char),
    }
    dealt = sharding.shards(_table(spark, sf_dir, "documents"), dims, SHARDS)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_likeness(_table(spark, sf_dir, "documents"))


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = chat.perspectives(_table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return seen.withColumn("mask", F.array_join(spans, " "))


def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.section_tokens(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op11_fm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_merkle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.document_proofs(_table(spark, sf_dir, "documents"))


def op13_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = [
    op1_mix_sources,
    op2_simhash,
    op3_content_sort,
    op4_best_two_fit,
    op5_kd_shards,
    op6_site_templates,
    op7_bottom_k,
    op8_perspectives,
    op9_compression_toxicity,
    op10_section_tokens,
    op11_fm_phrases,
    op12_merkle_rollup,
    op13_ftrl_quality,
]


def _mixing_sql() -> str:
    """The same sweeps, written out one after the other."""
    steps, last = [], "w0"
    for i in range(mixing.SWEEPS):
        for key in ("source", "lang", "topic"):
            step = f"w{i}_{key}"
            steps.append(
                f"{step} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN held > 0"
                f" THEN weight * (SELECT share FROM s_{key} WHERE s_{key}.k = {key}) / held ELSE 0 END AS weight"
                f" FROM (SELECT *, sum(weight) OVER (PARTITION BY {key}) AS held FROM {last}))"
            )
            last = step
    shares = [
        f"s_{key} AS MATERIALIZED (SELECT k, raised / sum(raised) OVER () AS share FROM (SELECT {key} AS k,"
        f" pow(CAST(sum(tokens) AS DOUBLE), CAST({ALPHA} AS DOUBLE)) AS raised FROM cells GROUP BY 1))"
        for key in ("source", "lang", "topic")
    ]
    joined = ",\n".join([*shares, "w0 AS (SELECT *, CAST(tokens AS DOUBLE) AS weight FROM cells)", *steps])
    return rf"""
    WITH docs AS MATERIALIZED (
      SELECT doc_id, source, lang,
             CASE WHEN regexp_matches(text, '[Ll]icensed? under') THEN 'license'
                  WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9]|\(\d{{3}}\) \d{{3}}-\d{{4}}|\d+\.\d+\.\d+\.\d+')
                    THEN 'contact'
                  WHEN regexp_matches(text, '&&&|###|\*\*\*|!!') THEN 'symbols' ELSE 'prose' END AS topic,
             CAST(len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')) AS BIGINT) AS tokens,
             CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':mix'), 1, 13) AS BIGINT) AS DOUBLE)
               / 4503599627370496.0 AS draw
      FROM documents),
    cells AS MATERIALIZED (
      SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL),
    {joined},
    raked AS MATERIALIZED (
      SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM {last}),
    chances AS (SELECT *, ratio / max(ratio) OVER () AS probability FROM raked)
    SELECT doc_id, source, lang, d.tokens, round(weight, 4) AS weight,
           round(probability, 8) AS probability, draw < probability AS kept
    FROM docs d JOIN chances c USING (source, lang, topic)"""


def _manifest_sql(levels: int = 7, group_levels: int = 3) -> str:
    """The levels of the two trees, written out one after the other."""

    def written(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(written, ['doc_id', 'source', 'lang', 'n_chars', text]))})"

    def tree(name: str, nodes: str, key: str, count: int) -> str:
        steps, last = [], nodes
        for i in range(count):
            steps.append(
                f"{name}{i} AS MATERIALIZED (SELECT {key}, i, digest, n,"
                f" CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING"
                f" AND 1 PRECEDING), '') END AS before,"
                f" CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND"
                f" UNBOUNDED FOLLOWING), '') END AS after FROM"
                f" (SELECT {key}, i, digest, count(*) OVER (PARTITION BY {key}) AS n FROM {last})"
                f" WINDOW run AS (PARTITION BY {key}, i // 8 ORDER BY i))"
            )
            steps.append(
                f"{name}{i}_up AS MATERIALIZED (SELECT {key}, i // 8 AS i, CASE WHEN max(n) > 1"
                f" THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE max(digest) END AS digest"
                f" FROM {name}{i} GROUP BY {key}, i // 8)"
            )
            last = f"{name}{i}_up"
        return ",\n".join(steps)

    places = [f"l{i}" for i in range(levels)] + [f"g{i}" for i in range(group_levels)]
    joins = "\n".join(
        [f"JOIN l{i} ON l{i}.lang_key = r.lang_key AND l{i}.i = r.i // {8**i}" for i in range(levels)]
        + [f"JOIN g{i} ON g{i}.i = s.i // {8**i}" for i in range(group_levels)]
    )
    proof = " || ".join(f"coalesce({place}.before || {place}.after, '')" for place in places)
    folds, fold = [], "coalesce(r.forged, r.digest)"
    for place in places:
        step = f"sha256({place}.before || {fold} || {place}.after)"
        folds.append(f"CASE WHEN {place}.before IS NULL THEN {fold} ELSE {step} END AS f_{place}")
        fold = f"f_{place}"
    return f"""
    WITH docs AS MATERIALIZED (
      SELECT doc_id, coalesce('=' || lang, '') AS lang_key, {leaf('text')} AS digest,
             CASE WHEN xor(4294967295, list_reduce(
                    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                                    lambda c: ascii(c)::BIGINT)),
                    lambda held, byte: list_reduce([xor(held, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                      lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))) % 3 = 0
                  THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
             END AS forged
      FROM documents),
    r AS MATERIALIZED (
      SELECT *, row_number() OVER (PARTITION BY lang_key ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM docs),
    {tree('l', 'r', 'lang_key', levels)},
    subroots AS MATERIALIZED (
      SELECT lang_key, digest, row_number() OVER (ORDER BY lang_key) - 1 AS i, 0 AS whole FROM l{levels - 1}_up),
    {tree('g', 'subroots', 'whole', group_levels)}
    SELECT doc_id, leaf, subroot, root, proof_sha256, {fold} AS folded_root, {fold} = root AS verified
    FROM (
      SELECT r.doc_id, r.digest AS leaf, s.digest AS subroot, (SELECT digest FROM g{group_levels - 1}_up) AS root,
             sha256({proof}) AS proof_sha256, {', '.join(folds)}
      FROM r JOIN subroots s ON s.lang_key = r.lang_key
      {joins})"""


def _phrases_sql() -> str:
    """All phrases of two and three words are counted; products are of 128 bits."""
    square = "1000000 * CAST(a AS HUGEINT) * CAST(a AS HUGEINT)"
    return rf"""
    WITH pieces AS MATERIALIZED (
      SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
    places AS MATERIALIZED (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
    n AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
    f1 AS MATERIALIZED (SELECT lang, w[i] AS x, count(*) AS f FROM places GROUP BY ALL),
    f2 AS MATERIALIZED (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM places WHERE i < len(w) GROUP BY ALL),
    f3 AS MATERIALIZED (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM places
                        WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10),
    covered AS (SELECT lang, x, y, max(f) AS longer FROM (
                  SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
    cuts AS (
      SELECT lang, x || ' ' || y AS phrase, c.f AS a, 1 AS k, l.f AS l, r.f AS r
      FROM f2 c JOIN f1 l USING (lang, x) JOIN f1 r ON r.lang = c.lang AND r.x = c.y
      LEFT JOIN covered USING (lang, x, y) WHERE c.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * c.f)
      UNION ALL
      SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 1, l.f, r.f
      FROM f3 c JOIN f1 l USING (lang, x) JOIN f2 r ON r.lang = c.lang AND r.x = c.y AND r.y = c.z
      UNION ALL
      SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 2, l.f, r.f
      FROM f3 c JOIN f2 l USING (lang, x, y) JOIN f1 r ON r.lang = c.lang AND r.x = c.z),
    scored AS (SELECT *, CAST(({square}) // (CAST(l AS HUGEINT) * CAST(r AS HUGEINT)) AS BIGINT) AS score FROM cuts),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""


ORACLE_SQL = {
    "op11_fm_phrases": _phrases_sql(),
    "op12_merkle_rollup": _manifest_sql(),
    "op1_mix_sources": _mixing_sql(),
    "op3_content_sort": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        WINDOW same AS (PARTITION BY norm)""",
    "op8_perspectives": r"""
        WITH said AS (
          SELECT conv_id, replace(role, '<|', '< |') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place
          FROM conversations),
        pieces AS (
          SELECT conv_id, seen_by, CAST(place // 64 AS INTEGER) AS segment, place, speaker = seen_by AS own, head,
                 head || body || '<|end|>' || chr(10) AS piece
          FROM (SELECT s.conv_id, s.place, s.speaker, s.body, p.seen_by,
                       CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10)
                            WHEN speaker = seen_by THEN '<|assistant|>' || chr(10)
                            ELSE '<|user name=' || speaker || '|>' || chr(10) END AS head
                FROM said s JOIN (SELECT DISTINCT conv_id, speaker AS seen_by FROM said
                                  WHERE speaker <> 'system') p USING (conv_id))),
        placed AS (
          SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, seen_by, segment ORDER BY place) AS upto
          FROM pieces)
        SELECT conv_id, seen_by AS speaker, segment, count(*) AS n_turns,
               string_agg(piece, '' ORDER BY place) AS text,
               coalesce(string_agg((upto - length(piece) + length(head)) || '-' || upto, ' ' ORDER BY place)
                        FILTER (WHERE own), '') AS mask
        FROM placed GROUP BY conv_id, seen_by, segment""",
}
