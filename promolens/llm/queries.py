"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.session import configure

from .collocation import collocations, first_of_each
from .common import columns_of, ship
from .exact_dedup import exact_dedup
from .imatch import fingerprints
from .langid import languages
from .mixing import mix
from .near_dedup import near_dedup
from .packing import pack
from .periodic import periodic_runs
from .pii import personal_data
from .quality import grade_of_labels, quality_scores
from .suffix_dedup import remove_repeats
from .wordpiece import token_counts
from .wrappers import main_text


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def languages_as_domains(docs: DataFrame) -> DataFrame:
    return columns_of(docs, "doc_id", "lang").withColumnRenamed("lang", "domain")


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mix(docs, languages_as_domains(docs), vocabulary("byte_bpe_50k.json"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def graded(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", grade_of_labels(labels["quality"], labels["toxic"]).alias("grade"))


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), graded(_table(spark, sf_dir, "labels")))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op5_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op9_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = first_of_each(collocations(_table(spark, sf_dir, "documents")), 2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the contract: a tenth of the texts repeats a stretch to its end."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or n == 0 or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_table(spark, sf_dir, "documents"), arrange=planted_period)
    longest = F.reduce("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(
        r["length"] > best["length"], r).otherwise(best))  # runs go by start, then period
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    digest = F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), digest.alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_soft_mixing, op2_token_counts, op3_ordinal_quality, op4_personal_data,
        op5_imatch_fingerprints, op6_best_fit_packing, op7_minhash_near_dedup, op8_exact_dedup, op9_byte_gru_language, op10_suffix_dedup,
        op11_phrase_collocations, op12_periodic_runs, op13_html_wrappers)}

ORACLE: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t""",
    "op11_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (
            SELECT lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] AS ws FROM pieces),
        totals AS (SELECT lang, sum(len(ws)) AS n FROM words GROUP BY lang),
        grams AS (
            SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) AS phrase
            FROM words, unnest([1, 2, 3, 4, 5]) AS sizes(k)),
        frequent AS (
            SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
        cuts AS (
            SELECT lang, k, phrase, a, cut, string_split(phrase, ' ') AS ws
            FROM frequent, unnest([1, 2, 3, 4]) AS places(cut) WHERE cut < k),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, t.n::HUGEINT AS n,
                   (1000::HUGEINT * c.a * t.n::HUGEINT) // (l.a * r.a) AS score
            FROM cuts c JOIN totals t USING (lang)
            JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
            JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
        best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (
            SELECT lang, a, unnest(flatten([[array_to_string(string_split(phrase, ' ')[i:i + size - 1], ' ')
                   for i in range(1, k - size + 2)] for size in range(2, k)])) AS phrase
            FROM frequent WHERE k > 2),
        held AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank,
               b.phrase, b.a::BIGINT AS a, b.l::BIGINT AS l, b.r::BIGINT AS r, b.n::BIGINT AS n, b.score::BIGINT AS score
        FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
        WHERE h.most IS NULL OR 100 * h.most < 100 * b.a
        QUALIFY rank <= 2000""",
}

ship(__name__)
