"""Each operator applied to its whole table, with production parameters."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclerlake.llm import collocations, exact_dedup, html_text, licences, mixing, neighbours, oracles, packing, runs, simhash, token_counts, toxicity, url_filter, warc
from cyclerlake.llm.common import landed, table, word_count

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def planted(key: int | None, n: int) -> np.ndarray | None:
    """Every tenth document, by the checksum of its id, repeats a stretch of its words to the end."""
    if key is None or not n or (h := zlib.crc32(str(key).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % (1 + (n - a) // (3 + g % 8)), at)


def shared_folder(spark: SparkSession) -> None:
    """Sets a checkpoint folder where a local session, as in tests, has none."""
    context = spark.sparkContext
    if not (context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()) and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cyclerlake-"))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            shared_folder(spark)
            return run(spark, folder)

        QUERIES[name] = prepared
        if sql:
            ORACLES[name] = sql
        return prepared

    return register


@query("op1_mix", oracles.MIX)
def mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = landed(docs.select("doc_id", "source", word_count("text").alias("size")), "mix-sizes")
    mixed = mixing.mix(sized, F.col("size"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


@query("op2_neighbours", oracles.NEIGHBOURS)
def nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_pack")
def pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query("op4_licences", oracles.LICENCES)
def scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.find(table(spark, folder, "documents"))


@query("op5_html")
def extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query("op6_simhash")
def near(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op7_warc", oracles.WARC)
def round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query("op8_urls", oracles.URLS)
def judge(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), RULES)


@query("op9_dedup", oracles.DEDUP)
def dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, folder, "documents"))


@query("op10_toxicity")
def toxic(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


@query("op11_collocations", oracles.COLLOCATIONS)
def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


@query("op12_runs")
def periodic(spark: SparkSession, folder: str) -> DataFrame:
    return runs.scan(table(spark, folder, "documents"), rewrite=planted, texts=False)


@query("op13_tokens")
def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count(table(spark, folder, "documents"), tokenizer_path(WORD_TOKENIZER))
