"""Queries over the given tables, each with the SQL that DuckDB checks it by."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lexiband.__main__ import run as run_job  # noqa: E402
from lexiband.operators import bands, frequency, measurements, tokenize
from lexiband.operators.ranking import by_frequency, with_letter_rank
from lexiband.plans.measurement_report import measurement_report
from lexiband.plans.report import word_and_letter_bands, write_report
from lexiband.session import new_shared_path, with_settings
from lexiband.sources.csv import execution_columns, read_bands, read_measurements, write_bands, write_measurements
from lexiband.sources.tables import read_lines, read_text_table

# The operators for training text are added if they, and what they import, are there.
llm_queries, llm_sql = [], {}
try:
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import pipeline
    from lexiband.llm.queries import ORACLE_SQL as LLM_SQL
    from lexiband.llm.queries import QUERIES as LLM_QUERIES
except ImportError as missing:
    print(f"without the operators for training text: {missing}", file=sys.stderr)
else:
    llm_queries = [*LLM_QUERIES, pipeline]
    llm_sql = {**LLM_SQL, **({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})}

Query = Callable[[SparkSession, str], DataFrame]

# Stand-in for a table of repeated measurements: `lineitem`.
IDS = ["l_orderkey", "l_linenumber", "l_returnflag"]
MEASURES = ["l_quantity", "l_discount", "l_tax"]


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_text_table(spark, f"{sf_dir}/documents.parquet", [*columns, "text"])


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text_table(spark, f"{sf_dir}/pages.parquet", ["html"])


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text_table(spark, f"{sf_dir}/conversations.parquet", ["text"])


def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.line_rows(documents(spark, sf_dir, "doc_id"), keep=["doc_id"])


def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "texts")
    documents(spark, sf_dir).write.text(path)
    return read_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.token_rows(documents(spark, sf_dir, "doc_id"), keep=["doc_id"])


def word_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.word_rows(documents(spark, sf_dir, "doc_id"), keep=["doc_id"])


def letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize.letter_rows(documents(spark, sf_dir, "doc_id"), keep=["doc_id"])
    return rows.groupBy("doc_id", "letter").agg(F.count("*").alias("n"))


def tagged_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize.tagged_tokens(documents(spark, sf_dir, "doc_id"), keep=["doc_id"])
    return rows.groupBy("doc_id", "type").agg(F.count("*").alias("n"))


def tagged_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize.tagged_tokens(documents(spark, sf_dir))
    return rows.groupBy("type", "token").agg(F.count("*").alias("frequency"))


def tagged_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokenize.tagged_tokens(documents(spark, sf_dir), tags=["w"])
    return words.groupBy("token").agg(F.count("*").alias("frequency"))


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.word_frequency(documents(spark, sf_dir))


def letter_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.letter_frequency(documents(spark, sf_dir))


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.distinct_counts(documents(spark, sf_dir))


def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.corpus_totals(documents(spark, sf_dir))


def word_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.band_thresholds(word_frequency(spark, sf_dir))


def letter_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.band_thresholds(letter_frequency(spark, sf_dir))


def word_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.word_rank(documents(spark, sf_dir))


def letter_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.letter_rank(documents(spark, sf_dir))


def word_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.word_bands(documents(spark, sf_dir))


def letter_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.letter_bands(documents(spark, sf_dir))


def page_word_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.word_bands(pages(spark, sf_dir), "html")


def page_letter_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = frequency.letters_of_counts(frequency.token_counts(pages(spark, sf_dir), "html"))
    return bands.banded(with_letter_rank(letters, by_frequency("letter")), "letter")


def conversation_word_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_and_letter_bands(conversations(spark, sf_dir))[0]


def word_bands_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "word-bands")
    write_bands(word_bands(spark, sf_dir), path)
    return read_bands(spark, path, "word")


def letter_bands_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "letter-bands")
    write_bands(letter_bands(spark, sf_dir), path)
    return read_bands(spark, path, "letter")


def _report(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Text files from the table, then the whole job on those files."""
    source = new_shared_path(spark, "texts")
    documents(spark, sf_dir).write.text(source)
    return write_report(spark, source, new_shared_path(spark, "report"))


def report_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bands(spark, _report(spark, sf_dir)[0], "word")


def report_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bands(spark, _report(spark, sf_dir)[1], "letter")


def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command's work, from its arguments to both outputs, in a session with the job's settings."""
    session = with_settings(spark.newSession())
    source, out = new_shared_path(session, "texts"), new_shared_path(session, "job")
    documents(session, sf_dir).write.text(source)
    words, letters = run_job(session, ["-i", f"{source}/part-*", "-o", out])
    return _both(read_bands(spark, words, "word"), read_bands(spark, letters, "letter"))


def _both(words: DataFrame, letters: DataFrame) -> DataFrame:
    rest = ["rank", "category", "frequency"]
    return words.select(F.lit("word").alias("kind"), F.col("word").alias("token"), *rest).unionByName(
        letters.select(F.lit("letter").alias("kind"), F.col("letter").alias("token"), *rest)
    )


def measure_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*IDS, *MEASURES)
    return measurements.unpivot_measures(wide, IDS, MEASURES, "measure", "value")


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


def measure_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", *MEASURES)
    return _rounded(measurements.mean_and_deviation_of(wide, ["l_returnflag"], MEASURES))


def measure_pooled_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", *MEASURES)
    long = measurements.unpivot_measures(wide, ["l_returnflag"], MEASURES)
    stats = measurements.mean_and_deviation(long, ["l_returnflag"])
    return stats.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


def word_bands_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other bands are written first, to the path that the bands of the words then replace."""
    path = new_shared_path(spark, "bands")
    write_bands(bands.word_bands(conversations(spark, sf_dir)), path)
    write_bands(word_bands(spark, sf_dir), path)
    return read_bands(spark, path, "word")


def measure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over measurement files in a folder for each return flag, keyed by the flag."""
    path = new_shared_path(spark, "measurements")
    times = execution_columns(len(MEASURES))
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    wide = lineitem.select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linenumber").alias("Workers"),
        *(F.col(old).alias(new) for old, new in zip(MEASURES, times)),
    )
    write_measurements(wide, path, "flag", len(MEASURES))
    return _rounded(measurement_report(spark, path, len(MEASURES), key="flag")).withColumnRenamed("flag", "folder")


def measure_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "measurements")
    times = execution_columns(len(MEASURES))
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    wide = lineitem.select(
        F.col("l_linenumber").alias("Workers"), *(F.col(old).alias(new) for old, new in zip(MEASURES, times))
    )
    wide.write.option("header", True).option("lineSep", "\r\n").csv(path)
    long = measurements.unpivot_measures(read_measurements(spark, path), ["Workers"], times)
    stats = measurements.mean_and_deviation(long, ["Workers"])
    return stats.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


def entry(spark: SparkSession) -> DataFrame:
    return word_bands(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    registered = [
        line_scan,
        file_lines,
        token_rows,
        word_rows,
        letter_rows,
        tagged_tokens,
        tagged_token_counts,
        tagged_words,
        word_frequency,
        letter_frequency,
        distinct_counts,
        corpus_totals,
        word_thresholds,
        letter_thresholds,
        word_rank,
        letter_rank,
        word_bands,
        letter_bands,
        page_word_bands,
        page_letter_bands,
        conversation_word_bands,
        word_bands_csv,
        letter_bands_csv,
        word_bands_replaced,
        report_words,
        report_letters,
        report_job,
        measure_unpivot,
        measure_stats,
        measure_pooled_stats,
        measure_report,
        measure_file_stats,
    ]
    return {query.__name__: query for query in [*registered, *llm_queries]}


def _tables(table: str = "documents", text: str = "text") -> str:
    """Common table expressions: pieces, word and letter counts, ranks. RE2's \\s lacks \\x0B."""
    return rf"""
    WITH tok AS (
      SELECT doc, raw FROM (
        SELECT doc, unnest(string_split_regex(body, '[\s\x0B,.;:?!"()\[\]{{}}!_-]+')) AS raw
        FROM (SELECT row_number() OVER () AS doc, {text} AS body FROM {table}))
      WHERE raw <> ''),
    w AS (
      SELECT lower(raw) AS word, count(*) AS frequency FROM tok
      WHERE regexp_full_match(raw, '[a-zA-Z]+') GROUP BY 1),
    l AS (
      SELECT letter, count(*) AS frequency FROM (
        SELECT unnest(string_split(lower(regexp_replace({text}, '[^a-zA-Z]', '', 'g')), '')) AS letter
        FROM {table})
      WHERE letter <> '' GROUP BY 1),
    wr AS (
      SELECT row_number() OVER (ORDER BY frequency DESC, word) AS rank, word, frequency,
             count(*) OVER () AS n FROM w),
    lr AS (
      SELECT row_number() OVER (ORDER BY frequency DESC, letter) AS rank, letter, frequency,
             count(*) OVER () AS n FROM l)
    """


def _bands(token: str, table: str = "documents", text: str = "text") -> str:
    return _tables(table, text) + f"""
    SELECT rank, {token}, category, frequency FROM (
      SELECT *, CASE
        WHEN rank <= ceil(CAST(0.05 AS DOUBLE) * n) THEN 'popular'
        WHEN rank >= floor(CAST(0.95 AS DOUBLE) * n) THEN 'rare'
        WHEN rank BETWEEN floor(CAST(0.475 AS DOUBLE) * n)
                      AND ceil(CAST(0.525 AS DOUBLE) * n) THEN 'common' END AS category
      FROM {token[0]}r)
    WHERE category IS NOT NULL"""


def _limits(prefix: str = "", n: str = "n") -> str:
    return f"""CAST(ceil(CAST(0.05 AS DOUBLE) * {n}) AS BIGINT) AS {prefix}popular,
      CAST(floor(CAST(0.475 AS DOUBLE) * {n}) AS BIGINT) AS {prefix}common_lo,
      CAST(ceil(CAST(0.525 AS DOUBLE) * {n}) AS BIGINT) AS {prefix}common_hi,
      CAST(floor(CAST(0.95 AS DOUBLE) * {n}) AS BIGINT) AS {prefix}rare"""


def oracle_sql() -> dict[str, str]:
    pieces = r"""
    (SELECT doc_id, unnest(string_split_regex(text, '[\s\x0B,.;:?!"()\[\]{}!_-]+')) AS raw
     FROM documents)"""
    letters = """
    (SELECT doc_id, unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z]', '', 'g')), '')) AS letter
     FROM documents)"""
    stats = """
    SELECT l_returnflag, measure, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd
    FROM (SELECT l_returnflag, l_quantity, l_discount, l_tax FROM lineitem)
    UNPIVOT (value FOR measure IN (l_quantity, l_discount, l_tax))
    GROUP BY l_returnflag, measure"""
    return {
        "line_scan": r"""
            SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line
            FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
                  FROM (SELECT doc_id, string_split_regex(
                          regexp_replace(text, '(?:\r\n|[\r\n])\z', ''), '\r\n|[\r\n]') AS parts
                        FROM documents WHERE text <> ''))""",
        "file_lines": r"""
            SELECT value, count(*) AS n
            FROM (SELECT unnest(string_split_regex(text, '\r\n|[\r\n]')) AS value FROM documents)
            GROUP BY value""",
        "token_rows": f"SELECT doc_id, raw FROM {pieces} WHERE raw <> ''",
        "word_rows": f"""
            SELECT doc_id, lower(raw) AS word FROM {pieces}
            WHERE regexp_full_match(raw, '[a-zA-Z]+')""",
        "letter_rows": f"""
            SELECT doc_id, letter, count(*) AS n FROM {letters}
            WHERE letter <> '' GROUP BY doc_id, letter""",
        "tagged_tokens": f"""
            SELECT doc_id, 'w' AS type, count(*) AS n FROM {pieces}
            WHERE regexp_full_match(raw, '[a-zA-Z]+') GROUP BY doc_id
            UNION ALL
            SELECT doc_id, 'l' AS type, count(*) AS n FROM {letters}
            WHERE letter <> '' GROUP BY doc_id""",
        "tagged_token_counts": _tables() + """
            SELECT 'w' AS type, word AS token, frequency FROM w
            UNION ALL SELECT 'l' AS type, letter AS token, frequency FROM l""",
        "tagged_words": _tables() + "SELECT word AS token, frequency FROM w",
        "word_frequency": _tables() + "SELECT word, frequency FROM w",
        "letter_frequency": _tables() + "SELECT letter, frequency FROM l",
        "distinct_counts": _tables() + """
            SELECT 'word' AS kind, count(*) AS n FROM w
            UNION ALL SELECT 'letter' AS kind, count(*) AS n FROM l""",
        "corpus_totals": _tables() + f"""
            SELECT total_words, distinct_words, {_limits('word_', 'distinct_words')},
                   distinct_letters, {_limits('letter_', 'distinct_letters')}
            FROM (SELECT (SELECT CAST(sum(frequency) AS BIGINT) FROM w) AS total_words,
                         (SELECT count(*) FROM w) AS distinct_words,
                         (SELECT count(*) FROM l) AS distinct_letters)""",
        "word_thresholds": _tables() + f"SELECT n, {_limits()} FROM (SELECT count(*) AS n FROM w)",
        "letter_thresholds": _tables() + f"SELECT n, {_limits()} FROM (SELECT count(*) AS n FROM l)",
        "word_rank": _tables() + "SELECT rank, word, frequency FROM wr",
        "letter_rank": _tables() + "SELECT rank, letter, frequency FROM lr",
        "word_bands": _bands("word"),
        "letter_bands": _bands("letter"),
        "page_word_bands": _bands("word", "pages", "html"),
        "page_letter_bands": _bands("letter", "pages", "html"),
        "conversation_word_bands": _bands("word", "conversations"),
        "word_bands_csv": _bands("word"),
        "letter_bands_csv": _bands("letter"),
        "word_bands_replaced": _bands("word"),
        "report_words": _bands("word"),
        "report_letters": _bands("letter"),
        "report_job": f"""
            SELECT 'word' AS kind, word AS token, rank, category, frequency FROM ({_bands("word")})
            UNION ALL
            SELECT 'letter' AS kind, letter AS token, rank, category, frequency FROM ({_bands("letter")})""",
        "measure_unpivot": """
            SELECT l_orderkey, l_linenumber, l_returnflag, measure, value
            FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_discount, l_tax
                  FROM lineitem)
            UNPIVOT INCLUDE NULLS (value FOR measure IN (l_quantity, l_discount, l_tax))""",
        "measure_stats": stats,
        "measure_pooled_stats": """
            SELECT l_returnflag, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd
            FROM (SELECT l_returnflag, l_quantity, l_discount, l_tax FROM lineitem)
            UNPIVOT (value FOR measure IN (l_quantity, l_discount, l_tax))
            GROUP BY l_returnflag""",
        "measure_report": """
            SELECT l_returnflag AS folder, l_linenumber AS "Workers", round(avg(value), 6) AS mean,
                   round(stddev_samp(value), 6) AS sd
            FROM (SELECT l_returnflag, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
            UNPIVOT (value FOR measure IN (l_quantity, l_discount, l_tax))
            GROUP BY l_returnflag, l_linenumber""",
        "measure_file_stats": """
            SELECT l_linenumber AS "Workers", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd
            FROM (SELECT l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
            UNPIVOT (value FOR measure IN (l_quantity, l_discount, l_tax))
            GROUP BY l_linenumber""",
        **llm_sql,
    }
