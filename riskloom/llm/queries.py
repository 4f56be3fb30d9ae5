"""The registered queries of this package: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import chosenpath, disclosure, divergence, guesscost, hostpaths, imatch, languages, merkle, packing, pareto, repair, sql, suffixes, tokenfile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op2_best_fit_packing")
def op2(spark, folder):
    docs = documents(spark, folder)
    return packing.best_fit(docs, classes=packing.near_copies(docs))


@query("op10_pareto_mix", pareto.ORACLE)
def op10(spark, folder):
    out = pareto.mix_sources(documents(spark, folder))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op3_guess_cost_secrets")
def op3(spark, folder):
    return guesscost.scan_secrets(documents(spark, folder))


@query("op4_mixture_language_id")
def op4(spark, folder):
    docs = documents(spark, folder)
    names, model = languages.train(docs.where(~languages.held_out()), F.col("lang"))
    return languages.detect(docs, names, model)


@query("op6_disclosure_pii")
def op6(spark, folder):
    out = disclosure.scan_personal(documents(spark, folder))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", disclosure.spans_column().alias("spans"), F.coalesce(F.size("added"), F.lit(0)).alias("n_terms"))


@query("op1_chosen_path_join")
def op1(spark, folder):
    return chosenpath.similarity_classes(documents(spark, folder))


@query("op7_rans_token_file")
def op7(spark, folder):
    import public_tokenizers

    return tokenfile.round_trip(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_imatch_fingerprints")
def op9(spark, folder):
    return imatch.fingerprints(documents(spark, folder))


@query("op8_two_stage_suffix_dedup")
def op8(spark, folder):
    return suffixes.remove_repeats(documents(spark, folder))


@query("op5_divergence_quality")
def op5(spark, folder):
    return divergence.judge(documents(spark, folder))


@query("op13_persistent_audit_repair", sql.REPAIR)
def op13(spark, folder):
    return repair.repair(spark.read.parquet(f"{folder}/conversations.parquet"))


@query("op12_path_copying_manifest", sql.MANIFEST)
def op12(spark, folder):
    return merkle.manifest(documents(spark, folder), merkle.tampered_leaf())


@query("op11_consensus_host_paths", sql.MAIN_TEXT)
def op11(spark, folder):
    return hostpaths.main_text(spark.read.parquet(f"{folder}/pages.parquet")).select("page_id", "url", "text", "n_chars")
